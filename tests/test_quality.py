import pytest
from pyspark.sql import functions as F

from fundsift.operators import quality as q
from fundsift.session import materialize
from fundsift.sources import sinks

from .conftest import rows


@pytest.fixture
def table(spark):
    return spark.createDataFrame(
        [("f1", 1, "a", 5.0), ("f1", 1, "a", -1.0), ("f2", 1, "a", None), ("f2", None, "b", 9.0), ("f2", None, "b", 9.0), ("f2", 2, None, 0.0)],
        "file_name string, k int, s string, x double",
    )


def report(v):
    return rows(v.report, "dataset_name", "passed", "error_count", "affected_groups_count")


def test_uniqueness(table):
    v = q.validate_uniqueness(table, "t", ["k", "s"])
    assert report(v) == [("t", False, 2, 2)]
    assert rows(v.affected, "affected", "rows") == [('{"k":1,"s":"a"}', 3), ('{"k":null,"s":"b"}', 2)]
    assert report(q.validate_uniqueness(table.limit(0), "t", ["k"])) == [("t", True, 0, 0)]
    per_file = q.validate_uniqueness(table, "t", ["k", "x"], by="file_name")
    assert report(per_file) == [("t/f1", True, 0, 0), ("t/f2", False, 1, 1)]


def test_bounds(table):
    v = q.validate_bounds(table, "t", "x", "k", lower_bound=0)
    assert report(v) == [("t", False, 1, 1)]
    assert rows(v.affected, "affected") == [('{"k":1,"x":-1.0}',)]
    assert report(q.validate_bounds(table, "t", "x", lower_bound=-1, upper_bound=9)) == [("t", True, 0, 0)]
    assert report(q.validate_bounds(table, "t", "x", upper_bound=4)) == [("t", False, 3, 3)]
    assert report(q.validate_bounds(table, "t", "x")) == [("t", True, 0, 0)]


def test_allowed_values(table):
    v = q.validate_allowed_values(table, "t", "s", ["a"])
    assert report(v) == [("t", False, 2, 1)]
    assert rows(v.affected, "affected", "rows") == [('{"s":"b"}', 2)]
    assert report(q.validate_allowed_values(table, "t", "s", ["a", "b"])) == [("t", True, 0, 0)]
    per_file = q.validate_allowed_values(table, "t", "s", ["a"], by="file_name")
    assert report(per_file) == [("t/f1", True, 0, 0), ("t/f2", False, 2, 1)]


def test_missing_columns(table):
    for v in (
        q.validate_uniqueness(table, "t", ["k", "nope"]),
        q.validate_bounds(table, "t", "nope"),
        q.validate_allowed_values(table, "t", "nope", []),
        q.validate_time_completeness(table, "t", "nope", "k"),
        q.validate_time_completeness(table, "t", "k", "nope"),
    ):
        assert report(v) == [("t", False, 1, 0)]
        assert rows(v.affected) == []


def test_monthly_gaps(spark):
    months = [m for m in range(202301, 202313)] + [202401, 202402, 202403]
    df = spark.createDataFrame([("g", m) for m in months if m != 202307] + [("h", 202401)] * 2, "k string, period int")
    assert rows(q.completeness(df, "period", "k")) == [("g", 15, 14, 1), ("h", 1, 1, 0)]
    assert report(q.validate_time_completeness(df, "t", "period", "k")) == [("t", False, 1, 1)]


def test_daily_gaps_follow_the_table_calendar(spark):
    df = spark.createDataFrame(
        [("a", f"2024-01-0{i}") for i in (1, 3)] + [("b", f"2024-01-0{i}") for i in (1, 2, 3, 5)] + [("c", "2024-01-05")],
        "k string, d string",
    )
    got = q.completeness(df, "d", "k", "%Y-%m-%d")
    assert rows(got) == [("a", 3, 2, 1), ("b", 4, 4, 0), ("c", 1, 1, 0)]
    v = q.validate_time_completeness(df, "t", "d", "k", "%Y-%m-%d")
    assert report(v) == [("t", False, 1, 1)]
    assert rows(v.affected, "affected", "rows") == [('{"k":"a"}', 1)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_daily_gaps_per_file(spark):
    df = spark.createDataFrame(
        [("f", "a", "2024-01-01"), ("f", "a", "2024-01-03"), ("f", "b", "2024-01-02"), ("g", "a", "2024-01-01"), ("g", "a", "2024-01-03")],
        "file_name string, k string, d string",
    )
    v = q.validate_time_completeness(df, "t", "d", "k", "%Y-%m-%d", by="file_name")
    assert report(v) == [("t/f", False, 1, 1), ("t/g", True, 0, 0)]


def test_report(table):
    checks = {
        "validate_uniqueness": {"group_columns": ["k"]},
        "validate_bounds": {"value_column": "x"},
    }
    results = q.run_checks(table, "t", checks)
    failed = rows(q.validation_report(results), "dataset_name", "validation_name", "status", "error_count")
    assert failed == [("t", "validate_uniqueness", "failed", 2)]
    assert q.validation_report(results, include_passed=True).count() == 2
    assert q.validation_report(results[1:]).count() == 0
    assert q.affected_report(results).count() == 2
    with pytest.raises(ValueError, match="validate_bound"):
        q.run_checks(table, "t", {"validate_bound": {}})


WATCHED = {
    "validate_bounds": {"value_column": "x", "identifier_column": "id", "lower_bound": 0},
    "validate_allowed_values": {"value_column": "kind", "allowed_values": ["a", "b"]},
    "validate_uniqueness": {"group_columns": ["id"]},
}


@pytest.mark.parametrize(
    "data",
    [[], [(1, 1.0, "a"), (2, None, None)], [(1, -1.0, "a"), (1, 2.0, "z"), (3, -5.0, "y"), (4, 0.0, "z")]],
)
def test_watched_checks_equal_those_of_the_stored_table(spark, tmp_path, data):
    table = spark.createDataFrame(data, "id long, x double, kind string")
    watched = q.Watched(table, "t", WATCHED)
    assert "CollectMetrics" in watched.table._jdf.queryExecution().executedPlan().toString()
    stored = sinks.write_table(watched.table, str(tmp_path / "t"))
    found, expected = watched.results(stored), q.run_checks(stored, "t", WATCHED)
    for name in ("validation_report", "affected_report"):
        merge = getattr(q, name)
        together = [merge(r, **({"include_passed": True} if name == "validation_report" else {})).drop("timestamp") for r in (found, expected)]
        assert rows(together[0]) == rows(together[1])


def test_watched_checks_name_missing_columns(spark, tmp_path):
    table = spark.createDataFrame([(1,)], "id long")
    watched = q.Watched(table, "t", {"validate_bounds": {"value_column": "no", "lower_bound": 0}})
    (result,) = watched.results(sinks.write_table(watched.table, str(tmp_path / "t")))
    assert result.report.first().details == "column not found: no"
    with pytest.raises(ValueError, match="unknown checks"):
        q.Watched(table, "t", {"no_such_check": {}})


def test_passed_row_checks_read_nothing_again(spark, tmp_path):
    table = spark.range(10).withColumn("x", F.lit(1.0))
    watched = q.Watched(table, "t", {"validate_bounds": {"value_column": "x", "lower_bound": 0}})
    (result,) = watched.results(sinks.write_table(watched.table, str(tmp_path / "t")))
    plan = result.report._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan and result.affected.count() == 0


def test_kept_checks_group_their_table_once(spark):
    """Results are the same, but reports and rows at fault come from what was stored, not from the table."""
    rows = [(1, "a", "2024-01-01"), (1, "a", "2024-01-01"), (2, "x", "2024-01-03"), (2, "y", "2024-01-05"), (3, None, "2024-01-03"), (None, "a", None)]
    table = spark.createDataFrame(rows, "k int, v string, d string")
    checks = {
        "validate_uniqueness": {"group_columns": ["k", "v"]},
        "validate_allowed_values": {"value_column": "v", "allowed_values": ["a"]},
        "validate_time_completeness": {"time_column": "d", "group_column": "k", "date_format": "%Y-%m-%d"},
    }
    stored = []

    def keep(df):
        stored.append(df)
        return materialize(df)

    for source in (table, table.filter("k = 3 AND v = 'a'")):
        kept, plain = q.run_checks(source, "t", checks, keep=keep), q.run_checks(source, "t", checks)
        for one, other in zip(kept, plain, strict=True):
            for a, b in zip(one, other, strict=True):
                assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
                assert all("/table-" in name for name in a.inputFiles())
                assert "ExistingRDD" not in a._jdf.queryExecution().optimizedPlan().toString() and "LogicalRDD" not in a._jdf.queryExecution().optimizedPlan().toString()
    assert len(stored) == 6
