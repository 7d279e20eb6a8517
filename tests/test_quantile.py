import math
import random

import pytest

from fundsift.functions.quantile import nearest_quantiles


def brute(values, share):
    kept = sorted(v for v in values if v is not None and not math.isnan(v))
    return kept[math.floor((len(kept) - 1) * share + 0.5)] if kept else None


def frame(spark, **columns):
    names = list(columns)
    return spark.createDataFrame(
        list(zip(*columns.values())), ", ".join(f"{n} double" for n in names)
    ).repartition(5)


@pytest.mark.parametrize(("n", "low", "high"), [(1, 0, 0), (7, 0, 6), (98, 5, 92), (101, 5, 95)])
def test_ranks(spark, n, low, high):
    df = frame(spark, x=[float(i) for i in range(n)])
    assert nearest_quantiles(df, ["x"], [0.05, 0.95])["x"] == [low, high]


def test_no_values(spark):
    df = frame(spark, x=[None, float("nan")], y=[1.0, None])
    assert nearest_quantiles(df, ["x", "y"], [0.5]) == {"x": [None], "y": [1.0]}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_narrowing_is_exact(spark, seed):
    """A tiny pick budget and a coarse sketch force several passes, repeats included."""
    random.seed(seed)
    n = 4000
    spread = [random.gauss(0, 1) for _ in range(n)]
    lumpy = [random.choice([0.0, 0.0, 0.0, 1.0, random.random()]) for _ in range(n)]
    holes = [None if random.random() < 0.3 else random.randint(0, 9) / 2 for _ in range(n)]
    edge = [float(i) if i < 190 else 500.0 for i in range(n)]
    columns = {"spread": spread, "lumpy": lumpy, "holes": holes, "edge": edge}
    df = frame(spark, **columns).cache()
    shares = [0.0, 0.047, 0.05, 0.5, 0.95, 1.0]
    got = nearest_quantiles(df, list(columns), shares, max_pick=20, accuracy=50)
    for name, values in columns.items():
        assert got[name] == [brute(values, s) for s in shares], name
