"""SimHash near-duplicates: exact tiled comparison of all fingerprints.

Distinct fingerprints lie in cells by the number of bits set in each of their four quarters,
and a cell is cut into tiles. Two fingerprints differ in at least as many bits as the counts of
their quarters do together, so a tile meets only the tiles of cells within the radius, once
each; all other pairs of tiles are skipped unseen. A pair of tiles is compared with exclusive-or
and bit counts, and gives the edges of a forest over its links, never all of them.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundsift.llm.common import stage
from fundsift.llm.components import components
from fundsift.llm.words import words

#: Words of a shingle, seed of its hash, and the most bits in which linked fingerprints differ.
WIDTH = 4
SEED = 42
RADIUS = 4

#: Fingerprints of a tile, on average at most, and rows of it compared at a time.
TILE = 1024
STRIP = 64

#: Parts of a fingerprint that are counted apart, bits of each, and room for a count in a cell's number.
PARTS = 4
BITS = 64 // PARTS
ROOM = 64


def shingle_hashes(found: list[bytes], width: int) -> np.ndarray:
    """XXH64 of each run of ``width`` words, joined by spaces."""
    raw = b" ".join(found)
    stops = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate([[0], stops[:-1] + 1])[: len(found) - width + 1].tolist()
    stops = stops[width - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(raw[a:b], SEED) for a, b in zip(starts, stops, strict=True)), np.uint64, len(starts))


def _set_bits(hashes: np.ndarray) -> np.ndarray:
    """How many hashes have each of the 64 bits set."""
    total = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 4096):
        some = np.ascontiguousarray(hashes[k : k + 4096]).view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return total


def fingerprint(text: str | None, width: int = WIDTH) -> int:
    """The signed 64-bit fingerprint; 0 without words."""
    ones, n, tail = np.zeros(64, np.int64), 0, []
    for chunk in words(text):
        tail = tail + chunk
        if len(tail) >= width:
            hashes = shingle_hashes(tail, width)
            ones += _set_bits(hashes)
            n += len(hashes)
            tail = tail[len(tail) - width + 1 :]
    if not n and tail:
        hashes, n = shingle_hashes(tail, len(tail)), 1
        ones = _set_bits(hashes)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(text: Column, width: int = WIDTH) -> Column:
    """Fingerprint of each whole text as a long; null counts as empty. Row by row."""

    @F.arrow_udf("long")
    def found(batch: pa.Array) -> pa.Array:
        return pa.array([fingerprint(value.as_py(), width) for value in batch], pa.int64())

    return found(text)


def _meeting(radius: int) -> list[int]:
    """Differences of cell numbers within the radius: zero, and one of each pair of opposite ones."""
    near = []
    for steps in itertools.product(range(-radius, radius + 1), repeat=PARTS):
        if sum(map(abs, steps)) <= radius and steps >= (0,) * PARTS:
            near.append(sum(step * ROOM**k for k, step in enumerate(reversed(steps))))
    return near


def _cell(fp: Column, radius: int) -> Column:
    """A number for the counts of the quarters, with room so that differences add up."""
    if 2 * radius + BITS >= ROOM:
        raise ValueError(f"the radius must be below {(ROOM - BITS) // 2}")
    cell = F.lit(0).cast("long")
    for k in range(PARTS):
        part = F.shiftrightunsigned(fp, BITS * k).bitwiseAND(F.lit((1 << BITS) - 1))
        cell = cell + (F.bit_count(part) + radius) * F.lit(ROOM**k)
    return cell


def forest(i: np.ndarray, j: np.ndarray, size: int) -> np.ndarray:
    """The least node of each node's component, for edges (i, j) among ``size`` nodes."""
    label = np.arange(size)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def linked(x: np.ndarray, y: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the pairs of two tiles that differ in at most ``radius`` bits."""
    rows, columns = [], []
    for k in range(0, len(x), STRIP):
        i, j = np.nonzero(np.bitwise_count(x[k : k + STRIP, None] ^ y[None, :]) <= radius)
        rows.append(i + k)
        columns.append(j)
    return np.concatenate(rows), np.concatenate(columns)


def _compare(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for left, right in zip(batch["x"], batch["y"], strict=True):
                x, y = (side.values.to_numpy().view(np.uint64) for side in (left, right))
                i, j = linked(x, y, radius)
                if not len(i):
                    continue
                nodes, place = np.unique(np.concatenate([x[i], y[j]]).view(np.int64), return_inverse=True)
                roots = nodes[forest(place[: len(i)], place[len(i) :], len(nodes))]
                moved = roots != nodes
                a.append(nodes[moved])
                b.append(roots[moved])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

    return run


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (a, b) that connect all fingerprints (distinct, column ``fp``) within ``radius`` bits.

    Every linked pair is connected by the edges; pairs that others connect anyway may have none.
    """
    placed = prints.select("fp", _cell(F.col("fp"), radius).alias("cell"))
    counts = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    counts = stage(counts, "cells")  # at most (BITS + 1) ** PARTS rows: small enough for every task
    cut = F.pmod(F.xxhash64("fp"), F.ceil(F.col("n") / TILE))
    tiles = placed.join(F.broadcast(counts), "cell").groupBy("cell", cut.alias("tile"))
    tiles = stage(tiles.agg(F.collect_list("fp").alias("x")), "tiles")
    steps = F.array(*[F.lit(d).cast("long") for d in _meeting(radius)])
    guests = tiles.select("tile", F.col("x").alias("y"), "cell", F.explode(steps).alias("step"))
    guests = guests.select((F.col("cell") + F.col("step")).alias("cell"), "step", F.col("tile").alias("guest"), "y")
    guests = guests.join(F.broadcast(counts.select("cell")), "cell", "left_semi")
    met = tiles.join(guests, "cell").filter("step != 0 OR guest <= tile").select("x", "y")
    return met.mapInArrow(_compare(radius), "a long, b long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, radius: int = RADIUS) -> DataFrame:
    """One row per input row: ``key``, fingerprint (16 hexadecimal digits), component_id.

    Shingles of ``width`` words count as often as they occur; a shorter text is one shingle as
    a whole. Null, empty and blank texts have fingerprint zero, which is linked like any other.
    ``component_id`` is the smallest key that can be reached over fingerprints at most
    ``radius`` bits apart; null keys do not count for it, and a component of null keys only has
    a null one. Repeated rows stay. An empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(F.col(key).alias("key"), fingerprints(F.col(text), width).alias("fp"))
    rows = stage(rows, "fingerprints")
    prints = stage(rows.groupBy("fp").agg(F.min("key").alias("least")), "prints")
    found = components(stage(links(prints, radius), "links"))
    named = prints.join(found, F.col("fp") == F.col("node"), "left")
    named = stage(named.select("fp", "least", F.coalesce("component", "fp").alias("component")), "named")
    least = stage(named.groupBy("component").agg(F.min("least").alias("component_id")), "least")
    named = stage(named.join(least, "component").select("fp", "component_id"), "named")
    return rows.join(named, "fp").select(
        F.col("key").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
