import random

import pytest
from pyspark.sql import functions as F

from fundsift.operators.keys import match_keys
from fundsift.operators.ranking import rank_within, top_n

from .conftest import rows


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_rank_within(spark, partitions):
    random.seed(partitions)
    data = [
        (g, i, random.choice([0.5, 0.5, None, random.random()]))
        for g in ("a", "b", "c")
        for i in range(300 if g == "b" else 7)
    ]
    df = spark.createDataFrame(data, "g string, id long, s double").repartition(6)
    ranked = rank_within(
        df, "g", [F.desc_nulls_last("s"), F.asc("id")], "rank", partitions=partitions
    )
    want = {}
    for g in "abc":
        group = [d for d in data if d[0] == g]
        group.sort(key=lambda d: (d[2] is None, -(d[2] or 0), d[1]))
        want |= {(g, d[1]): i + 1 for i, d in enumerate(group)}
    assert {(r.g, r.id): r.rank for r in ranked.collect()} == want
    assert ranked.columns == ["g", "id", "s", "rank"]


def test_rank_within_has_no_window_per_group(spark):
    df = spark.range(100).select(F.lit("p").alias("g"), F.col("id"), F.rand(1).alias("s"))
    ranked = rank_within(df, "g", [F.desc("s"), F.asc("id")], "rank", partitions=4)
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "row_number" not in plan


def test_top_n_cuts_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", i) for i in range(50)] + [("b", 1)], "g string, v int")
    best = top_n(df, ["g"], [F.desc("v")], 2)
    assert rows(best) == [("a", 48), ("a", 49), ("b", 1)]
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


DATA = [("hot", i) for i in range(100)] + [(f"k{i}", i) for i in range(50)] + [(None, 0)]


@pytest.mark.parametrize("how", ["left_semi", "left_anti"])
@pytest.mark.parametrize("wanted", [["hot", "k3", "k9"], ["k3"], ["hot"], []])
def test_match_keys(spark, how, wanted):
    df = spark.createDataFrame(DATA, "k string, v int")
    keys = spark.createDataFrame([(w,) for w in wanted], "k string")
    got = match_keys(df, keys, ["k"], how)
    keep = (lambda k: k in wanted) if how == "left_semi" else (lambda k: k not in wanted)
    assert rows(got) == sorted(
        ((k, v) for k, v in DATA if keep(k)), key=lambda t: (t[0] is not None, t)
    )
