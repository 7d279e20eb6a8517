import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from fundsift.config import Settings
from fundsift.operators import primary, registry, scope

from .conftest import rows

NAV = "TP_FUNDO string, CNPJ_FUNDO string, DENOM_SOCIAL string, DT_COMPTC string, VL_PATRIM_LIQ double"
REG = "`CNPJ do Fundo` long, `Categoria ANBIMA` string, `Tipo de Investidor` string"


@pytest.fixture
def nav(spark):
    return spark.createDataFrame(
        [
            ("FI", "00.000.000/0000-01", "one", "2024-02-29", 5.0),
            ("FI", "00.000.000/0000-01", "one", "2024-02-29", 6.0),
            ("FI", "00.000.000/0000-02", "zero at the end", "2024-02-29", 0.0),
            ("FI", "00.000.000/0000-02", "zero at the end", "2024-01-31", 9.0),
            ("FI", "00.000.000/0000-03", "negative before", "2024-01-31", -5.0),
            ("FI", "00.000.000/0000-03", "negative before", "2024-02-29", 5.0),
            ("FI", "00.000.000/0000-04", "negative, not last day", "2024-02-28", -5.0),
            ("FACFIF", "00.000.000/0000-05", "other type", "2024-02-29", 5.0),
            ("CLASSES - FIF", "00.000.000/0000-06", "unlisted", "2024-02-29", 5.0),
            ("FI", None, "no id", "2024-02-29", 5.0),
        ],
        NAV,
    )


@pytest.fixture
def registry_rows(spark):
    ok = "Não Há Restrição"
    return spark.createDataFrame(
        [(i, "Renda Fixa", ok) for i in (1, 1, 2, 3, 5)]
        + [(4, "Renda Fixa", "Não há Restrição"), (6, "Ações", ok), (7, "Renda Fixa", "x")],
        REG,
    )


def test_nonpositive_nav(nav):
    from fundsift.sources.files import unify_names

    kept = scope.exclude_nonpositive_nav(unify_names(nav), 202402)
    assert {r[0][-2:] for r in rows(kept, "CNPJ_FUNDO_CLASSE")} == {"01", "03", "04", "05", "06"}


def test_funds_in_scope(nav, registry_rows):
    s = Settings()
    assert rows(scope.funds_in_scope(nav, registry_rows, 202402, s)) == [(1,), (3,), (4,)]
    lax = replace(s, remove_funds_w_negative_nav=False)
    nav = nav.filter("CNPJ_FUNDO is not null")
    assert rows(scope.funds_in_scope(nav, registry_rows, 202402, lax)) == [(1,), (2,), (3,), (4,)]


def test_filter_fixed_income(nav, registry_rows):
    nav = nav.withColumn("period", F.date_format(F.to_date("DT_COMPTC"), "yyyyMM").cast("int"))
    got = scope.filter_fixed_income(nav, registry_rows, 202402, Settings())
    assert rows(got.nav, "cnpj", "DT_COMPTC", "VL_PATRIM_LIQ") == [
        (1, "2024-02-29", 6.0),
        (3, "2024-01-31", -5.0),
        (3, "2024-02-29", 5.0),
        (4, "2024-02-28", -5.0),
    ]
    assert rows(got.registry, "cnpj") == [(1,), (1,), (3,), (4,)]
    latest = scope.filter_fixed_income(
        nav, registry_rows, 202402, replace(Settings(), num_period_months=1)
    )
    assert rows(latest.nav, "cnpj", "DT_COMPTC") == [
        (1, "2024-02-29"),
        (3, "2024-02-29"),
        (4, "2024-02-28"),
    ]


def test_normalize_holdings(spark):
    ids = spark.createDataFrame([(1,)], "cnpj long")
    old = spark.createDataFrame(
        [("FI", "01", "202401", 1.0), ("FI", "02", "202401", 2.0)],
        "TP_FUNDO string, CNPJ_FUNDO string, period string, V double",
    )
    new = spark.createDataFrame([("FI", "1", "A")], "TP_FUNDO_CLASSE string, CNPJ_FUNDO_CLASSE string, X string")
    got = scope.normalize_holdings({"blc_1": old, "blc_5": new}, ids)
    assert rows(got, "cnpj", "blc_type", "V", "X") == [(1, "blc_1", 1.0, None), (1, "blc_5", None, "A")]


QUOTA = "cnpj long, DT_COMPTC string, VL_QUOTA double, VL_PATRIM_LIQ double, ID_SUBCLASSE string"


def test_valid_quotas(spark):
    bad = [None, float("nan"), float("inf"), 0.0, -1.0]
    df = spark.createDataFrame([(1, "2024-01-01", q, 1.0, None) for q in [*bad, 2.0]], QUOTA)
    assert rows(primary.valid_quotas(df), "VL_QUOTA") == [(2.0,)]


def test_primary_class_is_chosen_on_the_latest_date(spark):
    df = spark.createDataFrame(
        [
            (1, "2024-01-01", 1.0, 99.0, "A"),
            (1, "2024-01-01", 2.0, 1.0, "B"),
            (1, "2024-01-02", 3.0, 10.0, "A"),
            (1, "2024-01-02", 4.0, 20.0, "B"),
            (2, "2024-01-02", 5.0, 7.0, "A"),
            (2, "2024-01-02", 6.0, None, "B"),
        ],
        QUOTA,
    )
    got = primary.primary_share_class(df)
    assert rows(got, "cnpj", "DT_COMPTC", "VL_QUOTA") == [
        (1, "2024-01-01", 2.0),
        (1, "2024-01-02", 4.0),
        (2, "2024-01-02", 6.0),
    ]


def test_daily_nav(spark):
    df = spark.createDataFrame(
        [
            (1, "2024-01-01", 1.0, 5.0, None),
            (1, "2024-01-01", 1.5, 9.0, None),
            (1, "2024-01-02", 2.0, 5.0, None),
            (1, "2024-01-02", 3.0, 1.0, "A"),
            (1, "2024-01-03", 4.0, 2.0, "A"),
            (1, "2024-01-03", 5.0, 1.0, "B"),
            (1, "2024-01-04", -1.0, 1.0, None),
            (2, "2024-01-01", 7.0, None, None),
            (2, "2024-01-01", 8.0, 3.0, None),
        ],
        QUOTA,
    )
    want = [
        (1, dt.date(2024, 1, 1), 202401, 1.5),
        (1, dt.date(2024, 1, 2), 202401, 3.0),
        (1, dt.date(2024, 1, 3), 202401, 4.0),
        (2, dt.date(2024, 1, 1), 202401, 7.0),
    ]
    assert rows(primary.daily_nav(df)) == want
    assert rows(primary.daily_nav(df.repartition(5))) == want
    alone = primary.dedup_highest_nav(df)
    assert rows(alone, "cnpj", "DT_COMPTC", "VL_QUOTA") == [
        (1, "2024-01-01", 1.5),
        (1, "2024-01-02", 2.0),
        (1, "2024-01-04", -1.0),
        (2, "2024-01-01", 7.0),
    ]


def test_daily_returns_share_the_layout_of_daily_nav(spark):
    df = spark.createDataFrame([(1, "2024-01-01", 1.0, 5.0, None)], QUOTA)
    nav = primary.daily_nav(df)
    plan = primary.daily_returns(nav)._jdf.queryExecution().executedPlan().toString()
    base = nav._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hash") == base.count("Exchange hash")
    assert plan.count("Sort [") == base.count("Sort [")


def test_daily_returns(spark, day):
    nav = spark.createDataFrame(
        [(1, day(i), 202401, q) for i, q in zip((0, 1, 4, 5), (100.0, 101.0, 100.5, 102.0))],
        "cnpj long, date date, period int, quota_value double",
    )
    got = rows(primary.daily_returns(nav), "date", "daily_return", "date_rank")
    assert [(d, pytest.approx(r, abs=1e-10), k) for d, r, k in got] == [
        (day(1), 0.01, 3),
        (day(4), -0.0049504950, 2),
        (day(5), 0.0149253731, 1),
    ]


def test_monthly_returns(spark):
    nav = spark.createDataFrame(
        [
            (1, 202312, 10.0),
            (1, 202401, 11.0),
            (1, 202403, 12.0),
            (1, 202404, 0.0),
            (1, 202405, 3.0),
            (2, 202401, 1.0),
        ],
        "cnpj long, period int, price double",
    )
    got = rows(primary.monthly_returns(nav), "period", "price_previous", "monthly_return", "period_rank")
    assert got == [(202401, 10.0, pytest.approx(0.1), 4), (202404, 12.0, -1.0, 2)]


def test_monthly_nav(spark):
    nav = spark.createDataFrame(
        [(1, "2024-01-31", 5.0), (1, "2024-01-31", 5.0), (1, "bad", 6.0)],
        "cnpj long, DT_COMPTC string, VL_PATRIM_LIQ double",
    )
    assert rows(primary.monthly_nav(nav)) == [(1, None, 6.0), (1, 202401, 5.0)]


@pytest.fixture
def full_registry(spark):
    from fundsift.sources.schemas import REGISTRY

    def row(cnpj, level_1, level_3, manager, days, status, since):
        return (cnpj, "Renda Fixa", level_1, "x", level_3, "Geral", "s", "a", manager, f"n{since}",
                days, status, since)

    return spark.createDataFrame(
        [
            row(1, "Ativo", "Duração Alta", "M", 3.0, "Ativo", "2020-05-01"),
            row(1, "Later", "Duração Alta", "M", 5.0, "Ativo", "2021-05-01"),
            row(2, "Ativo", None, "M", None, "Ativo", "2019-01-01"),
            row(2, None, "Livre", None, 2.0, "Encerrado", None),
            row(3, "Passivo", "ativo", "M", 1.0, "Ativo", "2018-01-01"),
            row(9, "Out", "Out", "M", 1.0, "Ativo", "2018-01-01"),
        ],
        REGISTRY,
    )


def test_characteristics(spark, full_registry):
    ids = spark.createDataFrame([(1,), (2,), (3,), (4,)], "cnpj long")
    got = registry.fund_characteristics(full_registry, ids)
    assert rows(got, "cnpj", "inception_date", "redemption_days", "is_active") == [
        (1, "2020-05-01", 3.0, 1),
        (2, None, 2.0, 0),
        (3, "2018-01-01", 1.0, 1),
        (4, None, 90.0, None),
    ]
    long = registry.category_flags(got)
    categories = [registry.Category(*r) for r in rows(long.select("level", "label", "flag").distinct())]
    wide = registry.one_hot_categories(got, categories)
    # "Ativo" on level 1 and "ativo" on level 3 share a flag; level 3 wins.
    assert rows(wide, "cnpj", "is_ativo", "is_passivo", "is_duracao_alta", "is_livre") == [
        (1, 0, 0, 1, 0),
        (2, 0, None, 0, 1),
        (3, 1, 1, 0, 0),
        (4, None, None, None, None),
    ]
    managers = registry.fund_managers(got)
    assert rows(managers) == [("M", 2, dt.date(2018, 1, 1), dt.date(2020, 5, 1))]


def test_months_with_several_prices(spark):
    nav = [(1, 202301, 10.0), (1, 202301, 20.0), (1, 202302, 30.0), (1, 202304, 5.0)]
    got = primary.monthly_returns(spark.createDataFrame(nav, "cnpj long, period int, price double"))
    assert rows(got, "period", "price", "price_previous", "monthly_return", "period_rank") == [
        (202302, 30.0, 10.0, 2.0, 2),
        (202302, 30.0, 20.0, 0.5, 3),
    ]


def test_daily_nav_needs_one_scan_and_two_exchanges(spark, tmp_path):
    path = str(tmp_path / "quotas")
    data = [(k % 5, f"2024-01-0{1 + k % 9}", 1.0 + k, 2.0, "A" if k % 2 else None) for k in range(90)]
    spark.createDataFrame(data, QUOTA).write.parquet(path)
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = primary.daily_nav(spark.read.parquet(path))
        got.collect()
        plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert plan.count("FileScan") == 1
        assert plan.count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)


def test_assert_unique(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "cnpj long")
    assert registry.assert_unique(df) is df
    assert rows(registry.unique_key_report(df)) == [(3, 3)]
    with pytest.raises(ValueError, match="1 values of cnpj share 2 rows"):
        registry.assert_unique(df.union(spark.createDataFrame([(None,)], "cnpj long")))


def test_daily_nav_against_plain_python_with_one_huge_fund(spark):
    import random

    random.seed(11)
    data = []
    for i in range(6000):
        fund = 1 if i % 3 == 0 else random.randint(2, 300)
        date = dt.date(2024, 1, 1) + dt.timedelta(days=random.randint(0, 9))
        nav = random.choice([None, float(random.randint(1, 50))])
        quota = random.choice([float(random.randint(1, 1000)), 0.0, float("nan")])
        data.append((fund, date.isoformat(), quota, nav, random.choice([None, "A", "B", "C"])))

    def highest(row):  # null NAV first, then by NAV, then by quota
        return (row[3] is None, row[3] or 0.0, row[2])

    valid = [r for r in data if r[2] > 0]
    primary_class = {}
    for fund in {r[0] for r in valid}:
        classed = [r for r in valid if r[0] == fund and r[4] is not None]
        if classed:
            last = max(r[1] for r in classed)
            best = max(highest(r) for r in classed if r[1] == last)
            primary_class[fund] = min(r[4] for r in classed if r[1] == last and highest(r) == best)
    want = {}
    for row in valid:
        if row[4] is not None and row[4] != primary_class[row[0]]:
            continue
        key, rank = (row[0], dt.date.fromisoformat(row[1])), (row[4] is not None, highest(row))
        if key not in want or rank > want[key][0]:
            want[key] = (rank, row[2])
    got = primary.daily_nav(spark.createDataFrame(data, QUOTA).repartition(6)).collect()
    assert {(r.cnpj, r.date): r.quota_value for r in got} == {k: q for k, (_, q) in want.items()}
    assert len(got) == len(want)
