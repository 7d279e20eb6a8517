import datetime as dt
import random
import statistics
import uuid
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundsift.config import Settings
from fundsift.functions import quantile
from fundsift.functions.columns import one_of
from fundsift.operators import arrivals, features, keys, moments, primary
from fundsift.plans import storage_catalog
from fundsift.plans.bindings import LARGEST_SPLIT, SPLITS, Tables, small_splits, split_size
from fundsift.plans.catalog import QUERIES
from fundsift.session import materialize
from fundsift.sources import files, periods, records, sinks

from .conftest import rows

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("note", T.StringType()), T.StructField("x", T.DoubleType())])


def quoted(value):
    return '"' + value.replace('"', '""') + '"'


def put(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(text.encode("latin1"))


@pytest.mark.parametrize(("size", "end"), [(150, "\n"), (933, "\r\n"), (10_000, "\n")])
def test_records_across_blocks(spark, tmp_path, size, end):
    dice = random.Random(size)
    expected = []
    for period in (202401, 202402):
        lines = ["id;note;x"]
        for k in range(120):
            note = dice.choice(["plain", "", 'a "quoted" word', "two\nlines", "\n\n\nblank ones\n", "end;\nafter", "é" * dice.randint(0, 90), "many\n" * dice.randint(0, 30), '"\n"'])
            expected.append((k, note or None, k / 2, period))  # an empty field is null, quoted or not
            lines.append(f"{k};{quoted(note)};{k / 2}")
            if k % 17 == 0:
                lines.append("")
        put(tmp_path / "in", f"{period}.csv", end.join(x.replace("\n", end) for x in lines) + end)
    with small_splits(spark, size):
        table = records.scan_quoted_csv(spark, str(tmp_path / "in"), SCHEMA)
        lines = next(iter(files.raw_lines(spark, str(tmp_path / "in")).values()))
        assert lines.select("file", "block").distinct().count() >= (2 if size > 5000 else 10)
        found = [tuple(r) for r in table.select("id", "note", "x", "period").collect()]
        assert Counter(found) == Counter(expected)


def test_parts_of_files_do_not_grow_in_number(spark, tmp_path):
    for name, n in (("small", 100), ("large", 60_000)):
        put(tmp_path / name, "202401.csv", "line\n" + "a line of text\n" * n)
    assert split_size(spark, str(tmp_path / "small"), 400) == 400
    size = split_size(spark, str(tmp_path / "large"), 400)
    assert 400 < size <= LARGEST_SPLIT
    with small_splits(spark, size):
        lines = next(iter(files.raw_lines(spark, str(tmp_path / "large")).values()))
        assert 10 < lines.rdd.getNumPartitions() <= SPLITS + 1


@pytest.mark.parametrize("name", ["multiline_records", "affected_lines_in_blocks"])
def test_queries_over_files_in_parts(spark, tmp_path, monkeypatch, name):
    sizes = []
    monkeypatch.setattr("fundsift.plans.storage_catalog.small_splits", lambda s, size: sizes.append(size) or small_splits(s, size))
    docs = [(k, "en", "".join(f"a k b, number {i}\n" for i in range(700)), "web", 1) for k in range(360)]
    spark.createDataFrame(docs, "doc_id long, lang string, text string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    QUERIES[name].run(spark, str(tmp_path))
    assert sizes[0] > 50_000


def test_records_keep_file_and_line_of_their_start(spark, tmp_path):
    put(tmp_path / "in", "202401.csv", 'id;note;x\n1;"a\nb\nc";2\n2;d;3\n3;"e\n";4\n')
    lines = next(iter(files.raw_lines(spark, str(tmp_path / "in")).values()))
    found = records.records(lines).orderBy("seq").collect()
    assert [(r.is_header, r.line) for r in found] == [(True, "id;note;x"), (False, '1;"a\nb\nc";2'), (False, "2;d;3"), (False, '3;"e\n";4')]
    assert [r.seq - found[0].seq for r in found] == [0, 1, 4, 5]


def test_stray_quotes_are_errors(spark, tmp_path):
    put(tmp_path / "a", "202401.csv", 'id;note;x\n1;"a;2\n' + "2;b;3\n" * 30 + '3;c";4\n')
    lines = next(iter(files.raw_lines(spark, str(tmp_path / "a")).values()))
    assert records.records(lines).count() == 2
    with pytest.raises(ValueError, match="more than 20 lines"):
        records.records(lines, max_lines=20)
    put(tmp_path / "b", "202401.csv", 'id;note;x\n1;"a;2\n2;b;3\n')
    with pytest.raises(ValueError, match="never closed"):
        records.records(next(iter(files.raw_lines(spark, str(tmp_path / "b")).values())))


def test_blocks_without_open_quotes_are_not_sorted(spark, tmp_path):
    put(tmp_path / "in", "202401.csv", "id;note;x\n" + "1;plain;2\n" * 50)
    lines = next(iter(files.raw_lines(spark, str(tmp_path / "in")).values()))
    assert records.records(lines).count() == 51


# -- periods


def months(spark, data):
    return spark.createDataFrame(data, "id long, period int, x double")


def test_periods_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "t")
    periods.write_periods(months(spark, [(1, 202401, 1.0), (2, 202402, 2.0), (3, 202403, 3.0)]), path)
    assert periods.stored_periods(spark, path) == [202401, 202402, 202403]
    periods.write_periods(months(spark, [(4, 202402, 4.0), (5, 202404, 5.0)]), path)
    assert rows(periods.read_periods(spark, path), "id", "period") == [(1, 202401), (3, 202403), (4, 202402), (5, 202404)]
    assert rows(periods.read_periods(spark, path, 2), "id", "period") == [(3, 202403), (5, 202404)]
    assert {p: n for p, (_, n) in periods.manifest(spark, path).items()} == dict.fromkeys([202401, 202402, 202403, 202404], 1)
    periods.write_periods(months(spark, []), path, periods=[202403])
    assert periods.stored_periods(spark, path) == [202401, 202402, 202404]


def test_a_broken_run_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    periods.write_periods(months(spark, [(1, 202401, 1.0), (2, 202402, 2.0)]), path)
    before = rows(periods.read_periods(spark, path))
    periods.write_data(months(spark, [(9, 202402, 9.0), (9, 202409, 9.0)]), path, periods.next_version(spark, path))
    assert rows(periods.read_periods(spark, path)) == before
    failing = months(spark, [(7, 202402, 1.0)]).withColumn("x", F.raise_error(F.lit("broken")).cast("double"))
    with pytest.raises(Exception, match="broken"):
        periods.write_periods(failing, path)
    assert rows(periods.read_periods(spark, path)) == before
    # A manifest whose writing did not end does not count either, and its number is not used again.
    (tmp_path / "t" / "manifest" / "2").mkdir()
    assert rows(periods.read_periods(spark, path)) == before
    periods.write_periods(months(spark, [(8, 202402, 8.0)]), path)
    assert rows(periods.read_periods(spark, path), "id") == [(1,), (8,)]


def test_only_the_valid_version_of_a_period_is_read(spark, tmp_path):
    path = str(tmp_path / "t")
    for k in range(3):
        periods.write_periods(months(spark, [(k, 202401, 0.0), (k, 202402 + k, 0.0)]), path)
    table = periods.read_periods(spark, path)
    assert table.filter("period = 202401").count() == 1
    assert sorted(f.rsplit("/", 3)[1:3] for f in table.inputFiles()) == [
        ["period=202401", "version=3"], ["period=202402", "version=1"], ["period=202403", "version=2"], ["period=202404", "version=3"]
    ]
    assert periods.expire(spark, path) == 4
    assert rows(periods.read_periods(spark, path), "id", "period") == [(0, 202402), (1, 202403), (2, 202401), (2, 202404)]
    assert periods.expire(spark, path) == 0


def test_rows_outside_the_periods_are_errors(spark, tmp_path):
    path = str(tmp_path / "t")
    periods.write_periods(months(spark, [(1, 202401, 1.0)]), path)
    for data in ([(2, 202402, 2.0)], [(2, None, 2.0)]):
        with pytest.raises(ValueError, match="outside the periods"):
            periods.write_periods(months(spark, data), path, periods=[202401])
    with pytest.raises(ValueError, match="outside the periods"):
        periods.write_periods(months(spark, [(2, None, 2.0)]), path)
    assert rows(periods.read_periods(spark, path), "id") == [(1,)]
    with pytest.raises(ValueError, match="no periods"):
        periods.read_periods(spark, str(tmp_path / "other"))


def test_new_columns_of_a_later_period(spark, tmp_path):
    path = str(tmp_path / "t")
    periods.write_periods(months(spark, [(1, 202401, 1.0)]), path)
    periods.write_periods(months(spark, [(2, 202402, 1.0)]).withColumn("class", F.lit("A")), path)
    assert rows(periods.read_periods(spark, path, merge_schema=True), "id", "class") == [(1, None), (2, "A")]


# -- buckets


@pytest.fixture
def nav(spark, day):
    dice = random.Random(3)
    data = [(c, day(n), 100 + dice.random() * (c + 1)) for c in range(23) for n in range(0, 400, 1 + c % 3)]
    table = spark.createDataFrame(data, "cnpj long, date date, quota_value double")
    return materialize(table.withColumn("period", (F.year("date") * 100 + F.month("date")).cast("int")))


def test_bucketed_nav_needs_no_exchange(spark, nav, tmp_path):
    name = f"t_{uuid.uuid4().hex}"
    stored = sinks.write_bucketed(nav, name, str(tmp_path / "nav"), "cnpj", ["cnpj", "date"], 4)
    settings = Settings()
    returns = primary.daily_returns(stored)
    risk = features.volatility(returns, 202501, settings)
    both = risk.hint("merge").join(features.sharpe_ratio(returns, 202501, settings), "cnpj")
    for df in (returns, risk, both):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in primary.daily_returns(nav)._jdf.queryExecution().executedPlan().toString()
    assert rows(returns) == rows(primary.daily_returns(nav))
    again = sinks.open_bucketed(spark, name + "_2", str(tmp_path / "nav"), stored.schema, "cnpj", ["cnpj", "date"], 4)
    assert "Exchange" not in primary.daily_returns(again)._jdf.queryExecution().executedPlan().toString()
    assert rows(again) == rows(nav, *again.columns)
    assert len(list((tmp_path / "nav").glob("*.parquet"))) <= 4


# -- moments


def test_moments_merge(spark):
    dice = random.Random(1)
    for left, right in [([], []), ([1.5], []), ([], [2.0, 4.0]), (dice.choices(range(100), k=7), dice.choices(range(5), k=30)), ([1e9, 1e9 + 1], [1e9 + 2])]:
        some = spark.createDataFrame([([float(v) for v in left], [float(v) for v in right])], "a array<double>, b array<double>")
        of = lambda c: F.aggregate(c, moments.nothing(), moments.with_value)
        found = some.select(moments.merged(of("a"), of("b")).alias("m")).first().m
        every = [*left, *right]
        assert found.n == len(every)
        if every:
            assert found.mean == pytest.approx(statistics.fmean(every))
            assert found.m2 == pytest.approx(statistics.pvariance(every) * len(every), abs=1e-9)


def test_risk_of_every_month_equals_that_for_each_reference_date(spark, nav):
    settings = Settings(trading_days_12m=30, trading_days_3m=7)
    returns = materialize(primary.daily_returns(nav))
    table = moments.monthly_moments(returns)
    found = {(r.cnpj, r.period): r for r in moments.by_month(table, settings).collect()}
    assert len(found) == returns.select("cnpj", "period").distinct().count()
    names = ["volatility", "volatility_12m", "volatility_3m", "sharpe_12m", "sharpe_3m"]
    for period in (202401, 202402, 202405, 202412):
        risk = features.volatility(returns, period, settings).join(features.sharpe_ratio(returns, period, settings), "cnpj")
        checked = 0
        for r in risk.collect():
            if (r.cnpj, period) in found:
                for name in names:
                    assert found[r.cnpj, period][name] == (None if r[name] is None else pytest.approx(r[name], rel=1e-9)), name
                checked += 1
        assert checked == 23


def test_windows_merge_only_their_own_months(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(moments, "_last", lambda days, *_, f=moments._last: asked.append(days) or f(days, *_))
    days = [(1, dt.date(2024, 1 + m, d), 202401 + m, m * d / 10) for m in range(6) for d in range(1, 4 + m)]
    table = moments.monthly_moments(spark.createDataFrame(days, "cnpj long, date date, period int, daily_return double"))
    settings = replace(Settings(), trading_days_12m=9, trading_days_3m=4)
    found = {r.period: r for r in moments.with_windows(table, settings).collect()}
    assert asked == [9, 4]
    for period, row in found.items():
        values = [x for _, _, p, x in days if p <= period]
        for name, n in (("long", 9), ("short", 4)):
            last = values[-n:]
            assert (row[name].n, row[name].mean) == (len(last), pytest.approx(statistics.fmean(last)))
            assert row[name].m2 == pytest.approx(statistics.pvariance(last) * len(last), abs=1e-12)
    plan = moments.with_windows(table, settings)._jdf.queryExecution().optimizedPlan().toString()
    assert "filter(counts" in plan


def test_moments_of_odd_returns(spark):
    data = [(1, dt.date(2024, 1, 2), 202401, 0.5), (1, dt.date(2024, 3, 1), 202403, None), (1, dt.date(2024, 5, 1), 202405, 0.1), (2, dt.date(2024, 1, 5), 202401, None)]
    returns = spark.createDataFrame(data, "cnpj long, date date, period int, daily_return double")
    found = moments.by_month(moments.monthly_moments(returns), Settings())
    assert [(r.cnpj, r.period, r.volatility is None) for r in found.orderBy("period").collect()] == [(1, 202401, True), (1, 202405, False)]
    assert moments.by_month(moments.monthly_moments(returns.limit(0)), Settings()).count() == 0


# -- months that arrive


def test_months_that_arrive_give_the_returns_of_all(spark, nav, tmp_path):
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    parts = [nav.filter("period <= 202403"), nav.filter("period = 202404 OR period = 202405"), nav.filter("period > 202405")]
    counts = []
    for part in parts:
        part.repartition(3).write.mode("append").parquet(source)
        table = arrivals.add_arrived(spark, source, target, progress)
        counts.append(table.count())
        assert arrivals.add_arrived(spark, source, target, progress).count() == counts[-1]
    assert counts == sorted(counts) and counts[0] < counts[-1]
    expected = primary.daily_returns(nav).drop("date_rank")
    assert rows(table, *expected.columns) == rows(expected)


def test_zero_and_single_quotas_that_arrive(spark, tmp_path):
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    day = dt.date(2024, 1, 2)
    for n, data in enumerate([[(1, 0.0), (2, 5.0)], [(1, 4.0), (3, 1.0)], [(1, 6.0), (2, 10.0)]]):
        when = day + dt.timedelta(days=31 * n)
        spark.createDataFrame([(c, when, 202401 + n, v) for c, v in data], arrivals.NAV).write.mode("append").parquet(source)
        table = arrivals.add_arrived(spark, source, target, progress)
    assert rows(table, "cnpj", "period", "daily_return") == [(1, 202403, 0.5), (2, 202403, 1.0)]


def test_a_row_that_arrives_late_is_an_error(spark, tmp_path):
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    for day in (dt.date(2024, 2, 1), dt.date(2024, 1, 1)):
        spark.createDataFrame([(1, day, 202401, 1.0)], arrivals.NAV).write.mode("append").parquet(source)
        if day.month == 2:
            arrivals.add_arrived(spark, source, target, progress)
    with pytest.raises(Exception, match="arrived after"):
        arrivals.add_arrived(spark, source, target, progress)


def test_shares_of_rows_by_period(spark, monkeypatch):
    nav = spark.createDataFrame([(p,) for p in [202401] * 3 + [202402] * 2 + [202404] * 5 + [None] * 9], "period int")
    assert storage_catalog._periods_at(nav, [0.3, 0.4, 0.5, 0.8]) == [202401, 202402, 202402, 202404]

    def refused(*_):
        raise AssertionError("all rows in a summary of the driver")

    day = dt.date(1995, 1, 31)
    items = [(k, k % 2, 1, day + dt.timedelta(days=9 * k), 100.0 + k, "O", "N") for k in range(1, 21)]
    columns = "l_orderkey long, l_suppkey long, l_linenumber int, l_shipdate date, l_extendedprice double, l_linestatus string, l_returnflag string"
    table = spark.createDataFrame(items, columns)
    monkeypatch.setattr(Tables, "read", lambda self, name: table)
    monkeypatch.setattr(type(table), "approxQuantile", refused)
    assert QUERIES["returns_month_by_month"].run(spark, "nowhere").count() == 18


# -- sketches and spelling


@pytest.mark.parametrize("max_pick", [50, 100_000])
def test_quantiles_from_sketches(spark, max_pick):
    dice = random.Random(2)
    data = [(k % 7, dice.choice([None, float("nan"), dice.gauss(0, 1), 1.0, 1.0]), float(k % 3), None) for k in range(5000)]
    table = materialize(spark.createDataFrame(data, "period int, x double, y double, z double"))
    columns, shares = ["x", "y", "z"], [0.0, 0.01, 0.33, 0.5, 0.99, 1.0]
    sketches = materialize(quantile.sketches_by(table, columns))
    found = quantile.nearest_quantiles(table, columns, shares, max_pick=max_pick, sketches=sketches)
    assert found == quantile.nearest_quantiles(table, columns, shares)
    assert found["z"] == [None] * 6


def test_sketches_of_other_rows_are_an_error(spark):
    table = spark.range(1000).select(F.lit(1).alias("period"), F.col("id").cast("double").alias("x"))
    sketches = quantile.sketches_by(table.filter("x < 900"), ["x"])
    with pytest.raises(ValueError, match="1000 values, its sketches 900"):
        quantile.nearest_quantiles(table, ["x"], [0.5], max_pick=10, sketches=sketches)
    none = quantile.nearest_quantiles(table.limit(0), ["x"], [0.5], sketches=quantile.sketches_by(table.limit(0), ["x"]))
    assert none == {"x": [None]}


def test_spelling_by_collation(spark):
    texts = ["Não há Restrição", "NAO HA RESTRICAO", "não  há restrição", "Restrito", None]
    table = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r.t for r in table.filter(one_of("t", ["nao ha restricao"], "UNICODE_CI_AI")).collect()] == texts[:2]
    assert [r.t for r in table.filter(one_of("t", ["Não há Restrição"])).collect()] == texts[:1]


# -- scans by key


def test_ranges_of_keys(spark):
    ids = spark.createDataFrame([(k,) for k in [5, 6, 7, 90, 91, 4000, None, 5]], "k long")
    assert keys.key_ranges(ids, "k") == [(5, 7), (90, 91), (4000, 4000)]
    assert keys.key_ranges(ids, "k", 1) == [(5, 4000)]
    assert keys.key_ranges(ids.limit(0), "k") == keys.key_ranges(ids.filter("k IS NULL"), "k") == []
    assert keys.key_ranges(spark.createDataFrame([(-(1 << 60),), (1 << 60,)], "k long"), "k", 4) == [(-(1 << 60), -(1 << 60)), (1 << 60, 1 << 60)]


def scanned_rows(df):
    """Rows that the scan of a plan with one scan gave to its filter, after the plan has run."""
    plan = df._jdf.queryExecution().executedPlan()
    return plan.collectLeaves().head().metrics().apply("numOutputRows").value()


def test_scans_skip_what_is_outside_the_scope(spark, tmp_path):
    facts = spark.range(300_000).select((F.col("id") % 1000).alias("cnpj"), (F.col("id") % 2 + 202401).cast("int").alias("period"), F.rand(1).alias("x"))
    stored = sinks.write_table(facts.coalesce(1), str(tmp_path / "t"), "period", sort_by=["cnpj"])
    ids = materialize(spark.createDataFrame([(k,) for k in [10, 11, 500]], "cnpj long"))
    kept = keys.keep_stored_keys(stored, ids, "cnpj")
    assert rows(kept, "cnpj", "x") == rows(facts.filter("cnpj IN (10, 11, 500)"), "cnpj", "x")
    inside = stored.filter(" OR ".join(f"cnpj BETWEEN {a} AND {b}" for a, b in keys.key_ranges(ids, "cnpj")))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        inside.collect()
        assert 900 <= scanned_rows(inside) < 150_000
        one = stored.filter("period = 202401 AND cnpj = 10")
        one.collect()
        assert scanned_rows(one) < 60_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert keys.keep_stored_keys(stored, ids.limit(0), "cnpj").count() == 0
