"""Distributed merge sort of long keys that never compares a known common prefix again.

Map tasks sort bounded runs and cut them at common splitters. A run travels front-coded:
per key the length of the prefix it shares with the key before, and only the rest. A
reducer merges the runs of its range with a loser tree that keeps, for every run, the
length of the prefix shared with the last key put out; keys are compared from there on.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys of one run, and the keys a range should have.
RUN = 50_000
RANGE = 50_000

#: Sampled keys per range that splitters are chosen from.
SAMPLED = 20


def common_prefix(x: bytes, y: bytes, start: int = 0) -> int:
    """Length of the common prefix, of which ``start`` bytes are known."""
    n = min(len(x), len(y))
    while start < n:
        a, b = x[start : start + 32], y[start : start + 32]
        if a != b:
            m = min(len(a), len(b))
            differs = int.from_bytes(a[:m], "big") ^ int.from_bytes(b[:m], "big")
            return start + m - (differs.bit_length() + 7) // 8
        start += 32
    return n


def front_coded(keys: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """Shared prefix lengths and rests of sorted keys."""
    shared = [0] * len(keys)
    for k in range(1, len(keys)):
        shared[k] = common_prefix(keys[k - 1], keys[k])
    return np.array(shared, np.int32), [key[n:] for key, n in zip(keys, shared, strict=True)]


def decoded(shared: list[int], rests: list[bytes]) -> Iterator[tuple[int, bytes]]:
    key = b""
    for n, rest in zip(shared, rests, strict=True):
        key = key[:n] + rest
        yield n, key


class LoserTree:
    """Merges sorted runs of (shared prefix with the key before, key)."""

    def __init__(self, runs: list[Iterator[tuple[int, bytes]]]):
        self.runs = runs
        self.size = 1 << max(0, len(runs) - 1).bit_length()
        self.keys: list[bytes | None] = [None] * self.size
        self.shared = [0] * self.size
        for k in range(len(runs)):
            self._advance(k)
        self.shared = [0] * self.size
        self.losers = [-1] * self.size
        self.winner = self._build(1)

    def _advance(self, k: int) -> None:
        self.shared[k], self.keys[k] = next(self.runs[k], (0, None)) if k < len(self.runs) else (0, None)

    def _play(self, a: int, b: int) -> tuple[int, int]:
        """Winner and loser; both prefixes are shared with the key that was put out last."""
        x, y = self.keys[a], self.keys[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        known, other = self.shared[a], self.shared[b]
        if known != other:
            return (a, b) if known > other else (b, a)
        n = common_prefix(x, y, known)
        if n == len(x) or (n < len(y) and x[n] < y[n]):
            self.shared[b] = n
            return a, b
        self.shared[a] = n
        return b, a

    def _build(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        winner, self.losers[node] = self._play(self._build(2 * node), self._build(2 * node + 1))
        return winner

    def __iter__(self) -> Iterator[tuple[int, int, bytes]]:
        """Run, prefix shared with the key before, and key, in order."""
        while (key := self.keys[self.winner]) is not None:
            k = self.winner
            yield k, self.shared[k], key
            self._advance(k)
            node = (k + self.size) // 2
            while node:
                k, self.losers[node] = self._play(k, self.losers[node])
                node //= 2
            self.winner = k


def _sampled_keys(key_of: Callable[[dict], list[bytes]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(key_of(batch.to_pydict()), pa.binary())], ["key"])

    return run


def _picked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One of ``SAMPLED`` sorted keys, beginning at a place that differs between partitions."""
    at = TaskContext.get().partitionId() * 7 % SAMPLED
    for batch in batches:
        yield batch.take(pa.array(range(at, batch.num_rows, SAMPLED), pa.int64()))
        at = (at - batch.num_rows) % SAMPLED


def shortened(splitters: list[bytes]) -> list[bytes]:
    """Each sorted splitter up to the first byte that tells it from the one before."""
    found, last = [], b""
    for splitter in splitters:
        found.append(splitter[: common_prefix(last, splitter) + 1])
        last = splitter
    return found


def splitters_of(sample: DataFrame, key_of: Callable[[dict], list[bytes]]) -> list[bytes]:
    """Sorted splitters, one of ``SAMPLED`` sampled keys.

    The sample is sorted by Spark; only the splitters reach the driver, and a few bytes of each go to the tasks.
    """
    keys = sample.mapInArrow(_sampled_keys(key_of), "key binary").distinct()
    ordered = keys.repartitionByRange("key").sortWithinPartitions("key")
    return shortened(sorted(bytes(r.key) for r in ordered.mapInArrow(_picked, "key binary").collect()))


def _runs(splitters, key_of: Callable[[dict], list[bytes]], carried: list[str]):
    def emit(columns: dict[str, list]) -> Iterator[pa.RecordBatch]:
        keys = key_of(columns)
        order = sorted(range(len(keys)), key=keys.__getitem__)
        ordered = [keys[i] for i in order]
        cuts = [0, *(bisect_left(ordered, s) for s in splitters.value), len(ordered)]
        for part, (start, stop) in enumerate(zip(cuts, cuts[1:], strict=False)):
            if start < stop:
                shared, rests = front_coded(ordered[start:stop])
                rows = [part, shared, rests, *([columns[c][i] for i in order[start:stop]] for c in carried)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v]) for v in rows[:1]] + [pa.array([v]) for v in rows[1:]],
                    ["part", "shared", "rests", *carried],
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        for batch in batches:
            for start in range(0, batch.num_rows, RUN):
                piece = batch.slice(start, RUN)
                for name in piece.schema.names:
                    held.setdefault(name, []).extend(piece[name].to_pylist())
                if len(held[carried[0]]) >= RUN:
                    yield from emit(held)
                    held = {}
        if held and held[carried[0]]:
            yield from emit(held)

    return run


def sort_ranges(
    records: DataFrame,
    key_of: Callable[[dict], list[bytes]],
    carried: dict[str, str],
    reduce: Callable[[int, Iterator[tuple[dict, int, bytes]]], pa.Table],
    schema: str,
) -> DataFrame:
    """Sort ``records`` by ``key_of`` and hand each range, in order, to ``reduce``.

    ``key_of`` makes keys of columns given as lists; ``carried`` names the long columns
    that go along. ``reduce`` gets the number of the range and (carried values, prefix
    shared with the record before in the range, key) per record. Every range but the first
    has the record that its splitter was made of, so no range between two others is empty. The
    splitters are sampled evenly by hash; their number is about that of the ranges.
    """
    spark = records.sparkSession
    total = records.count()
    ranges = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), total // 1000), total // RANGE)
    name = F.xxhash64(*carried)
    share = min(1.0, SAMPLED * ranges / max(total, 1))
    sample = records.filter(F.pmod(name, F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) + 1))
    splitters = spark.sparkContext.broadcast(splitters_of(sample, key_of) if ranges > 1 else [])
    names = list(carried)
    lists = ", ".join(f"{c} array<{kind}>" for c, kind in carried.items())
    runs = records.mapInArrow(_runs(splitters, key_of, names), f"part long, shared array<int>, rests array<binary>, {lists}")

    def merged(key: tuple, table: pa.Table) -> pa.Table:
        columns = {c: table[c].to_pylist() for c in ("shared", "rests", *names)}
        tree = LoserTree([decoded(s, r) for s, r in zip(columns["shared"], columns["rests"], strict=True)])
        at = [0] * table.num_rows

        def rows() -> Iterator[tuple[dict, int, bytes]]:
            for k, shared, found in tree:
                yield {c: columns[c][k][at[k]] for c in names}, shared, found
                at[k] += 1

        return reduce(key[0].as_py(), rows())

    return runs.groupBy("part").applyInArrow(merged, schema)
