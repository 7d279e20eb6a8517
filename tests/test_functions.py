import datetime as dt

import pytest
from pyspark.sql import functions as F

from fundsift.functions import columns as fc
from fundsift.functions import quotes

from .conftest import rows


def test_cnpj_both_ways(spark):
    df = spark.createDataFrame([("07.408.147/0001-64",), ("10705306000105",)], "raw string")
    parsed = df.select(fc.cnpj_to_numeric("raw").alias("cnpj"))
    assert rows(parsed) == [(7408147000164,), (10705306000105,)]
    shown = parsed.select(fc.cnpj_to_formatted("cnpj"))
    assert rows(shown) == [("07.408.147/0001-64",), ("10.705.306/0001-05",)]


def test_id_without_digits_is_an_error(spark):
    df = spark.createDataFrame([("n/a",)], "raw string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.select(fc.cnpj_to_numeric("raw")).collect()


@pytest.mark.parametrize(
    ("label", "name"),
    [
        ("Duração Média (Soberano)", "is_duracao_media_soberano"),
        ("Renda Fixa", "is_renda_fixa"),
        ("Crédito-Livre 2", "is_credito_livre_2"),
    ],
)
def test_safe_names(spark, label, name):
    df = spark.createDataFrame([(label,)], "label string")
    assert df.select(fc.safe_label("label")).first()[0] == name


def test_clip_and_finite_keep_null_apart(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(None,), (nan,), (inf,), (-5.0,), (0.5,)], "x double")
    got = df.select(
        fc.is_finite("x"), fc.clip(F.col("x"), 0.0, 1.0).isNull(), fc.nan_to_null("x").isNull()
    ).collect()
    assert [tuple(r) for r in got] == [
        (False, True, True),
        (False, False, True),
        (False, False, False),
        (True, False, False),
        (True, False, False),
    ]


def test_periods(spark):
    df = spark.createDataFrame([(202312,), (202401,), (202402,)], "period int")
    got = df.select(fc.month_index("period"), fc.period_end(F.col("period"))).collect()
    assert [r[0] - got[0][0] for r in got] == [0, 1, 2]
    assert [r[1] for r in got] == [
        dt.date(2023, 12, 31),
        dt.date(2024, 1, 31),
        dt.date(2024, 2, 29),
    ]


def test_lenient_dates(spark):
    df = spark.createDataFrame([("2024-02-30",), ("2024-02-03",), (None,), ("x",)], "d string")
    assert [r[0] for r in df.select(fc.as_date(df, "d")).collect()] == [
        None,
        dt.date(2024, 2, 3),
        None,
        None,
    ]


QUOTE_CASES = [
    # line, redundant, malformed, after dropping odd quotes, after doubling even ones
    ('a;DECK",;b', True, False, "a;DECK,;b", 'a;DECK",;b'),
    ('""x;"""', True, False, '""x;""', '""x;"""'),
    ('a "2";z', False, True, 'a "2";z', 'a ""2"";z'),
    ('"abc"', False, True, '"abc"', '""abc""'),
    ("plain;line", False, False, "plain;line", "plain;line"),
    ('""', False, False, '""', '""'),
    ('x"";"y"z";w', True, False, 'x"";"y"z";w'.replace('"y"z"', "yz"), 'x"";"y"z";w'),
    ('a"b;c"d"e', True, True, 'ab;c"d"e', 'a"b;c""d""e'),
    (";;", False, False, ";;", ";;"),
]


@pytest.mark.parametrize("case", QUOTE_CASES)
def test_quote_repair(spark, case):
    line, odd, even, dropped, doubled = case
    df = spark.createDataFrame([(line,)], "line string")
    col = F.col("line")
    got = df.select(
        quotes.has_redundant_quotes(col),
        quotes.has_malformed_quotes(col),
        quotes.fix_redundant_quotes(col),
        quotes.fix_malformed_quotes(col),
    ).first()
    assert tuple(got) == (odd, even, dropped, doubled)


def test_quote_repair_against_plain_python(spark):
    import random

    random.seed(7)
    lines = ["".join(random.choice('";ab') for _ in range(random.randint(0, 14))) for _ in range(400)]

    def rewrite(line, wanted, single):
        out = []
        for field in line.split(";"):
            n = field.replace('""', "").count('"')
            if wanted(n):
                pieces = field.split('""')
                field = '""'.join(p.replace('"', single) for p in pieces)
            out.append(field)
        return ";".join(out)

    df = spark.createDataFrame([(x,) for x in lines], "line string")
    got = df.select(
        "line",
        quotes.fix_redundant_quotes(F.col("line")),
        quotes.fix_malformed_quotes(F.col("line")),
    ).collect()
    for line, dropped, doubled in got:
        assert dropped == rewrite(line, lambda n: n % 2 == 1, "")
        assert doubled == rewrite(line, lambda n: n > 0 and n % 2 == 0, '""')
