import datetime as dt
import gzip
import random

import pytest
from pyspark.sql import functions as F

from fundsift.functions.columns import as_date
from fundsift.operators import repair
from fundsift.sources import files, schemas, sinks

from .conftest import rows

OLD = "TP_FUNDO;CNPJ_FUNDO;DENOM_SOCIAL;DT_COMPTC;VL_PATRIM_LIQ"
NEW = OLD.replace("TP_FUNDO", "TP_FUNDO_CLASSE").replace("CNPJ_FUNDO", "CNPJ_FUNDO_CLASSE")
MIXED = 'FACFIF;07.408.147/0001-64;FUNDO DAS SERRAS PLUS "9";2023-04-30;22317.32'
ODD = 'FI;50.095.878/0001-26;FUNDO DO PLANALTO RENDA",;2023-12-31;8171565.36'
PLAIN = "FI;10.705.306/0001-05;FUNDO DO LITORAL AÇÕES;2023-06-30;-184655.57"


def put(folder, name, lines, end="\n"):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes((end.join(lines) + end).encode("latin1"))


@pytest.fixture
def nav_folder(tmp_path):
    folder = tmp_path / "pl"
    put(folder, "202304.csv", [OLD, MIXED, ""])
    put(folder, "202306.csv", [OLD, PLAIN], end="\r\n")
    put(folder, "202312.csv", [NEW, ODD])
    put(folder, "notes.csv", [NEW])
    return str(folder)


def test_periods_from_names(spark, nav_folder):
    assert files.max_period(spark, nav_folder) == 202312
    found = files.months(spark, nav_folder)
    assert [files.file_period(f) for f in files.recent_months(found, 2)] == [202306, 202312]
    assert files.file_period("/x/period=202401/part-0.csv") == 202401
    assert files.file_period("/x/202401.csv/part-0.csv") == 202401
    assert files.file_period("/202401/other.csv") is None


def test_scan(spark, tmp_path):
    folder = tmp_path / "pl"
    put(folder, "202306.csv", [OLD, PLAIN])
    put(folder, "202312.csv", [NEW, ODD.replace('"', "")])
    got = files.scan_partitioned_csv(spark, str(folder), schemas.MONTHLY_NAV)
    assert rows(got, "CNPJ_FUNDO_CLASSE", "DENOM_SOCIAL", "VL_PATRIM_LIQ", "period", "file_name") == [
        ("10.705.306/0001-05", "FUNDO DO LITORAL AÇÕES", -184655.57, 202306, "202306.csv"),
        ("50.095.878/0001-26", "FUNDO DO PLANALTO RENDA,", 8171565.36, 202312, "202312.csv"),
    ]
    assert files.scan_partitioned_csv(spark, str(folder), schemas.MONTHLY_NAV, 1).count() == 1


@pytest.mark.parametrize("bad", ["FI;1;x;2023-06-30;notanumber", "FI;1;x;2023-06-30", "FI;1;x;2023-06-30;1.0;9"])
def test_bad_rows_fail_the_scan(spark, tmp_path, bad):
    put(tmp_path / "pl", "202306.csv", [OLD, PLAIN, bad])
    got = files.scan_partitioned_csv(spark, str(tmp_path / "pl"), schemas.MONTHLY_NAV)
    with pytest.raises(Exception, match="MALFORMED_RECORD|malformed"):
        got.collect()
    if "notanumber" not in bad:  # a line of the wrong length fails whatever is read
        with pytest.raises(Exception, match="MALFORMED_RECORD|malformed"):
            got.select("CNPJ_FUNDO_CLASSE").collect()
    [(header, lines)] = files.raw_lines(spark, str(tmp_path / "pl")).items()
    with pytest.raises(Exception, match="MALFORMED_RECORD|malformed"):
        files.parse_lines(lines, header, schemas.MONTHLY_NAV).collect()


def test_columns_follow_the_header_not_the_schema(spark, tmp_path):
    put(tmp_path / "q", "202306.csv", ["VL_QUOTA;CNPJ_FUNDO;EXTRA", "1.5;7;e"])
    got = files.scan_partitioned_csv(spark, str(tmp_path / "q"), schemas.DAILY_QUOTAS)
    assert rows(got, "VL_QUOTA", "CNPJ_FUNDO_CLASSE", "EXTRA", "ID_SUBCLASSE") == [(1.5, "7", "e", None)]


def test_repair_then_parse(spark, nav_folder):
    parsed = files.drift_union(
        [
            files.parse_lines(repair.repair(lines), header, schemas.MONTHLY_NAV)
            for header, lines in files.raw_lines(spark, nav_folder).items()
        ]
    )
    assert rows(parsed, "DENOM_SOCIAL", "VL_PATRIM_LIQ", "period") == [
        ('FUNDO DAS SERRAS PLUS ""9""', 22317.32, 202304),
        ("FUNDO DO LITORAL AÇÕES", -184655.57, 202306),
        ("FUNDO DO PLANALTO RENDA,", 8171565.36, 202312),
    ]


def test_empty_first_part_does_not_hide_the_rest(spark, tmp_path):
    folder = tmp_path / "pl" / "202306.csv"
    put(folder, "part-00001.csv", [OLD, PLAIN])
    (folder / "part-00000.csv").write_bytes(b"")
    got = files.scan_partitioned_csv(spark, str(tmp_path / "pl"), schemas.MONTHLY_NAV)
    assert got.count() == 1


def test_parts_with_other_headers_fail(spark, tmp_path):
    folder = tmp_path / "pl" / "202306.csv"
    put(folder, "part-00000.csv", [OLD, PLAIN])
    swapped = ";".join([OLD.split(";")[1], OLD.split(";")[0], *OLD.split(";")[2:]])
    put(folder, "part-00001.csv", [swapped, PLAIN])
    got = files.scan_partitioned_csv(spark, str(tmp_path / "pl"), schemas.MONTHLY_NAV)
    with pytest.raises(Exception, match="header|Header"):
        got.collect()


def test_unknown_checks_are_errors(spark):
    lines = spark.createDataFrame([("f", 0, 0, False, "a")], "file string, block long, seq long, is_header boolean, line string")
    with pytest.raises(ValueError, match="check_redundant"):
        repair.repair(lines, {"check_redundant": repair.FIX})


def test_line_numbers_across_splits(spark, tmp_path):
    """A file read in many pieces still gets the line numbers of the whole file."""
    random.seed(3)
    lines = [OLD]
    for _ in range(3000):
        kind = random.random()
        lines.append("" if kind < 0.02 else 'a;b"c' if kind < 0.1 else 'a;"b"' if kind < 0.2 else "a;b")
    put(tmp_path / "pl", "202306.csv", lines)
    put(tmp_path / "pl", "202307.csv", [OLD, "a;b", 'x"'])
    keep = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        [text] = files.raw_lines(spark, str(tmp_path / "pl")).values()
        assert text.select("block").distinct().count() > 5
        result = repair.raw_validation(text, "pl")
        odd = [i + 1 for i, x in enumerate(lines) if x == 'a;b"c']
        even = [i + 1 for i, x in enumerate(lines) if x == 'a;"b"']
        listed = {(r.dataset_name, r.validation_name): r for r in result.report.collect()}
        assert set(listed) == {
            ("pl/202306.csv", "check_redundant_quotes"),
            ("pl/202306.csv", "check_malformed_quotes"),
            ("pl/202307.csv", "check_redundant_quotes"),
        }
        first = listed["pl/202306.csv", "check_redundant_quotes"]
        assert (first.status, first.affected_lines_count, first.fixes_applied) == ("fixed", len(odd), len(odd))
        got = rows(result.affected, name(), "validation_name", "line_no")
        assert got == sorted(
            [("202306.csv", "check_redundant_quotes", n) for n in odd]
            + [("202306.csv", "check_malformed_quotes", n) for n in even]
            + [("202307.csv", "check_redundant_quotes", 3)]
        )
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", keep)


def test_line_numbers_of_a_compressed_file(spark, tmp_path):
    lines = [OLD, *['a;b"c' if i % 7 == 0 else "a;b" for i in range(500)]]
    (tmp_path / "pl").mkdir()
    with gzip.open(tmp_path / "pl" / "202306.csv.gz", "wb") as f:
        f.write(("\n".join(lines) + "\n").encode("latin1"))
    [text] = files.raw_lines(spark, str(tmp_path / "pl")).values()
    found = repair.flagged_line_numbers(text, "check_redundant_quotes")
    assert [r[0] for r in rows(found, "line_no")] == [i + 1 for i, x in enumerate(lines) if '"' in x]


def test_headers_and_blank_lines_are_left_alone(spark, tmp_path):
    put(tmp_path / "pl", "202306.csv", ['A;"B', "1;2", "", 'x";y'])
    [text] = files.raw_lines(spark, str(tmp_path / "pl")).values()
    assert rows(repair.flagged_line_numbers(text, "check_redundant_quotes"), "line_no") == [(4,)]
    assert {r[0] for r in rows(repair.repair(text), "line")} == {'A;"B', "1;2", "", "x;y"}
    dropped = repair.drop_affected_lines(text, "check_redundant_quotes")
    assert {r[0] for r in rows(dropped, "line")} == {'A;"B', "1;2"}


@pytest.fixture
def lossy(spark, tmp_path):
    put(tmp_path / "pl", "202301.csv", [OLD, 'a"', 'b"', 'c"', "d"])
    put(tmp_path / "pl", "202302.csv", [OLD, 'a"', 'b"', 'c"', "d", "e", "f"])
    put(tmp_path / "pl", "202303.csv", [OLD, "a", "", "b"])
    [text] = files.raw_lines(spark, str(tmp_path / "pl")).values()
    return text


def name(col="file"):
    return F.element_at(F.split(col, "/"), -1)


def test_a_step_that_loses_too_much_is_undone(lossy):
    loss = repair.line_loss(lossy, "check_redundant_quotes")
    assert rows(loss.select(name().alias("f"), "lines_before", "lines_after", "accepted")) == [
        ("202301.csv", 5, 2, False),
        ("202302.csv", 7, 4, True),
        ("202303.csv", 4, 4, True),
    ]
    steps = {"check_redundant_quotes": "ignore", "check_malformed_quotes": "fix"}
    kept = repair.repair(lossy, steps).groupBy(name().alias("f")).count()
    assert rows(kept) == [("202301.csv", 5), ("202302.csv", 4), ("202303.csv", 4)]
    result = repair.raw_validation(lossy, "pl", steps, include_passed=True)
    got = rows(result.report, "dataset_name", "validation_name", "status", "affected_lines_count", "fixes_applied")
    assert got == [
        ("pl/202301.csv", "check_malformed_quotes", "passed", 0, 0),
        ("pl/202301.csv", "check_redundant_quotes", "failed", 3, 0),
        ("pl/202302.csv", "check_malformed_quotes", "passed", 0, 0),
        ("pl/202302.csv", "check_redundant_quotes", "fixed", 3, 3),
        ("pl/202303.csv", "check_malformed_quotes", "passed", 0, 0),
        ("pl/202303.csv", "check_redundant_quotes", "passed", 0, 0),
    ]
    affected = [(f"20230{i}.csv", "check_redundant_quotes", n) for i in (1, 2) for n in (2, 3, 4)]
    assert rows(result.affected, name(), "validation_name", "line_no") == affected
    assert rows(repair.summary(result.report)) == [
        ("status", "failed", 1),
        ("status", "fixed", 1),
        ("status", "passed", 4),
        ("validation_name", "check_malformed_quotes", 3),
        ("validation_name", "check_redundant_quotes", 3),
    ]
    assert rows(repair.failures(result.report), "dataset_name") == [("pl/202301.csv",)]


def test_repairing_twice_changes_nothing_more_for_odd_quotes(lossy):
    once = repair.repair(lossy, {"check_redundant_quotes": "fix"})
    twice = repair.repair(once, {"check_redundant_quotes": "fix"})
    assert rows(once, "file", "seq", "line") == rows(twice, "file", "seq", "line")


def test_repair_only_is_a_projection(lossy):
    plan = repair.repair(lossy)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", None), (2, None, 1.5)], "period int, s string, x double")
    back = sinks.write_table(df, str(tmp_path / "t"), "period")
    assert rows(back.select("period", "s", "x")) == rows(df)
    assert (tmp_path / "t" / "period=1").exists()
    sinks.write_report(df.coalesce(1), str(tmp_path / "r"))
    [part] = (tmp_path / "r").glob("part-*")
    assert part.read_text().splitlines() == ["period;s;x", "1;a;", "2;;1.5"]


def test_recent_periods_prune_partitions(spark, tmp_path):
    df = spark.createDataFrame([(p, 1) for p in (202312, 202401, 202402)], "period int, x int")
    stored = sinks.write_table(df, str(tmp_path / "t"), "period")
    recent = files.recent_periods(stored, 2)
    assert rows(recent, "period") == [(202401,), (202402,)]
    assert "PartitionFilters: [period" in recent._jdf.queryExecution().executedPlan().toString()
    assert files.recent_periods(stored, None) is stored


def test_max_ref_date(spark):
    df = spark.createDataFrame(
        [(202401, "2024-01-31"), (202402, "2024-02-05"), (202402, "2024-02-03")], "period int, DT_COMPTC string"
    )
    assert rows(files.max_ref_date(df, 202402)) == [(dt.date(2024, 2, 5),)]
    assert df.select(as_date(df, "DT_COMPTC")).schema[0].dataType.typeName() == "date"


def test_registry_source(spark, tmp_path):
    (tmp_path / "r.csv").write_text(
        "CNPJ do Fundo;Status;Prazo Pagamento Resgate em dias;Other\n7408147000164;Ativo;30.0;x\n8;;;\n"
    )
    got = files.registry_source(spark, str(tmp_path / "r.csv"), schemas.REGISTRY)
    assert rows(got, "CNPJ do Fundo", "Status", "Prazo Pagamento Resgate em dias", "Gestor Principal") == [
        (8, None, None, None),
        (7408147000164, "Ativo", 30.0, None),
    ]
    got.write.parquet(str(tmp_path / "r.parquet"))
    assert files.registry_source(spark, str(tmp_path / "r.parquet"), schemas.REGISTRY).count() == 2


def test_a_period_filter_leaves_other_files_unread(spark, tmp_path):
    for month in (202301, 202302, 202303):
        put(tmp_path / "pl", f"{month}.csv", [OLD, PLAIN])
    put(tmp_path / "pl", "202304.csv", [OLD, PLAIN.replace("-184655.57", "broken")])
    table = files.scan_partitioned_csv(spark, str(tmp_path / "pl"), schemas.MONTHLY_NAV)
    assert table.filter("period = 202302").collect()[0].VL_PATRIM_LIQ == -184655.57
    [(header, lines)] = files.raw_lines(spark, str(tmp_path / "pl")).items()
    parsed = files.parse_lines(lines, header, schemas.MONTHLY_NAV)
    assert parsed.filter("period = 202302").collect()[0].VL_PATRIM_LIQ == -184655.57
