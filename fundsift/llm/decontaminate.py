"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment of words."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundsift.llm.common import stage
from fundsift.llm.words import WordIds, plain_words, shingles

#: Words of a seed; an item with fewer words is one seed as a whole.
WIDTH = 3

#: Alignment: a match, a mismatch or a gap of one word, and the share of a perfect
#: alignment's score from which a document counts as contaminated.
MATCH, MISMATCH, GAP = 2, -1, 1
THRESHOLD = 0.6

#: Words of a passage that an alignment from ``THRESHOLD`` on has at most, as a share of the
#: item's length: a full copy and as many edits as its score can pay for.
MOST_WORDS = 1 + MATCH * (1 - THRESHOLD) / min(-MISMATCH, GAP)

#: Largest map of seed slots, in bytes, and most seeds that are broadcast themselves: the
#: proven bound of what is broadcast. A larger benchmark fills the map more, which lets more
#: n-grams through to the exact join.
MAX_SLOTS = 1 << 26
MAX_EXACT = 1 << 20


def numbers(text: str | None, ids: WordIds) -> np.ndarray:
    """Numbers of the words of a whole text, in order."""
    parts = [ids.of(chunk) for chunk in plain_words(text)]
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def _hashes(n: np.ndarray, width: int) -> np.ndarray:
    return shingles(n, width) + np.uint64(width)


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids = WordIds()
    for batch in batches:
        for item, text in zip(batch["item"], batch["text"].to_pylist(), strict=True):
            n = numbers(text, ids)
            if len(n):
                width = min(WIDTH, len(n))
                found = np.unique(_hashes(n, width)).view(np.int64)
                k = len(found)
                arrays = [pa.array([item.as_py()] * k, item.type), pa.array([width] * k, pa.int32()), pa.array([len(n)] * k, pa.int64()), pa.array(found)]
                yield pa.RecordBatch.from_arrays(arrays, ["item", "width", "n_words", "hash"])


class Slots:
    """Which hashes may be seeds and how far around them their items reach, and the widths that occur.

    A map of fixed size has for each slot the bits of the longest item's words; few seeds are held themselves.
    """

    def __init__(self, grams: DataFrame):
        count, widths = grams.agg(F.count_distinct("hash"), F.collect_set("width")).first()
        self.widths = sorted(widths)
        self.bits = min(int(math.log2(MAX_SLOTS)), max(16, math.ceil(math.log2(64 * max(count, 1)))))
        self.map = np.zeros(1 << self.bits, np.uint8)
        self.exact = None
        longest = F.max("n_words").alias("n")
        if count <= MAX_EXACT:
            found = grams.groupBy("hash").agg(longest).toPandas()
            hashes = found["hash"].to_numpy(np.int64).view(np.uint64)
            order = np.argsort(hashes)
            self.exact, self.words = hashes[order], found["n"].to_numpy(np.int64)[order]
            self.map[self.exact >> np.uint64(64 - self.bits)] = 1
        else:
            slot = F.shiftrightunsigned("hash", 64 - self.bits).alias("slot")
            found = grams.groupBy(slot).agg(longest).toPandas()
            words = found["n"].to_numpy(np.int64)
            self.map[found["slot"].to_numpy(np.int64)] = np.frexp(words)[1]

    def hits(self, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positions of n-grams that may be seeds, in order, their hashes, and the words to look at around them."""
        at, found, reach = ([np.empty(0, kind)] for kind in (np.int64, np.uint64, np.int64))
        for width in self.widths:
            hashes = _hashes(n, width)
            slots = self.map[hashes >> np.uint64(64 - self.bits)]
            here = np.flatnonzero(slots)
            words = (1 << slots[here].astype(np.int64)) - 1
            if self.exact is not None and len(here):
                place = np.minimum(np.searchsorted(self.exact, hashes[here]), len(self.exact) - 1)
                same = self.exact[place] == hashes[here]
                here, words = here[same], self.words[place[same]]
            at.append(here)
            found.append(hashes[here])
            reach.append(np.ceil(MOST_WORDS * words).astype(np.int64))
        at, found, reach = map(np.concatenate, (at, found, reach))
        order = np.argsort(at, kind="stable")
        return at[order], found[order], reach[order]


def runs(at: np.ndarray, reach: np.ndarray, n: int) -> Iterator[tuple[int, int, int, int]]:
    """Hits first to stop, and words start to end around them: each hit with what its own items reach.

    Hits farther apart than either reaches begin a new run, so a long item widens only the passages
    with seeds of its own.
    """
    if not len(at):
        return
    apart = np.diff(at) > np.maximum(reach[1:], reach[:-1])
    cuts = np.concatenate([[0], np.flatnonzero(apart) + 1])
    starts = np.maximum(np.minimum.reduceat(at - reach, cuts), 0)
    ends = np.minimum(np.maximum.reduceat(at + WIDTH + reach, cuts), n)
    yield from zip(cuts.tolist(), [*cuts[1:].tolist(), len(at)], starts.tolist(), ends.tolist(), strict=True)


def _passages(shared):
    """Runs of hits with the words around them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = WordIds()
        for batch in batches:
            rows, starts, inside, found = [], [], [], []
            for row, text in enumerate(batch["text"]):
                n = numbers(text.as_py(), ids)
                at, hashes, reach = shared.value.hits(n)
                for first, stop, start, end in runs(at, reach, len(n)):
                    rows.append(row)
                    starts.append(start)
                    inside.append(n[start:end])
                    found.append(np.unique(hashes[first:stop]))
            arrays = [batch["key"].take(pa.array(rows, pa.int64())), pa.array(starts, pa.int64()), _lists(inside), _lists(found)]
            yield pa.RecordBatch.from_arrays(arrays, ["key", "start", "words", "hashes"])

    return run


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, parts)])
    values = np.concatenate(parts) if parts else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values.view(np.int64)))


def _best(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """Best local alignment score, and the passage word after its end."""
    steps = np.arange(len(passage) + 1) * GAP
    row = np.zeros(len(passage) + 1, np.int64)
    best, end = 0, 0
    for word in item:
        step = np.where(passage == word, MATCH, MISMATCH)
        new = np.zeros_like(row)
        np.maximum(row[:-1] + step, row[1:] - GAP, out=new[1:])
        np.maximum(new, 0, out=new)
        row = np.maximum.accumulate(new + steps) - steps
        if (top := int(row.max())) > best:
            best, end = top, int(row.argmax())
    return best, end


def align(item: np.ndarray, passage: np.ndarray) -> tuple[float, int, int]:
    """Share of a perfect score, and the aligned words [start, end) of the passage."""
    best, end = _best(item, passage)
    _, back = _best(item[::-1], passage[:end][::-1])
    return best / (MATCH * len(item)), end - back, end


def _may_align(item: np.ndarray, passage: np.ndarray) -> bool:
    """Whether some part of the passage has enough words of the item to reach ``THRESHOLD``."""
    inside = np.cumsum(np.concatenate([[0], np.isin(passage, item)]))
    width = min(len(passage), math.ceil(MOST_WORDS * len(item)))
    return int((inside[width:] - inside[: len(inside) - width]).max()) / len(item) >= THRESHOLD


def _found(item: np.ndarray, passage: np.ndarray) -> tuple[float, int, int]:
    return align(item, passage) if _may_align(item, passage) else (0.0, 0, 0)


def _aligned(text: Column, passage: Column) -> Column:
    @F.arrow_udf("struct<score: double, start: long, stop: long>")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        ids = WordIds()
        for texts, passages in batches:
            found = [_found(numbers(t.as_py(), ids), p.values.to_numpy().view(np.uint64)) for t, p in zip(texts, passages, strict=True)]
            columns = list(zip(*found, strict=True)) or [(), (), ()]
            arrays = [pa.array(c, k) for c, k in zip(columns, (pa.float64(), pa.int64(), pa.int64()), strict=True)]
            yield pa.StructArray.from_arrays(arrays, ["score", "start", "stop"])

    return run(text, passage)


def contaminated(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """One row per document and item it contains: ``key``, ``item``, score, start_word, end_word.

    Words are runs of letters, digits and underscores of any script, compared without regard to
    case; of scripts without spaces each character is a word. A document
    contains an item when a local alignment of some passage reaches ``THRESHOLD`` of the
    score of a full copy; the best passage counts. Every n-gram of an item is a seed, however
    many documents have it: an alignment is found if it has one of them. Null and empty texts
    and items without words match nothing, repeated rows and equal items are one, null keys
    are a key like others. Empty tables give no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    items = benchmark.select(F.col(item).alias("item"), F.col(item_text).alias("text")).distinct()
    schema = items.select("item").schema.add("width", "integer").add("n_words", "long").add("hash", "long")
    seeds = stage(items.mapInArrow(_grams, schema).distinct(), "seeds")

    seeded = spark.sparkContext.broadcast(Slots(seeds))
    schema = rows.select("key").schema.add("start", "long").add("words", T.ArrayType(T.LongType())).add("hashes", T.ArrayType(T.LongType()))
    made = rows.mapInArrow(_passages(seeded), schema)
    passages = stage(made.withColumn("passage", F.monotonically_increasing_id()), "passages")

    hits = passages.select("passage", F.explode("hashes").alias("hash"))
    pairs = hits.join(seeds.select("hash", "item"), "hash").select("passage", "item").distinct()
    pairs = pairs.join(passages.select("passage", "key", "start", "words"), "passage")
    pairs = pairs.join(items.withColumnRenamed("item", "_item"), F.col("item").eqNullSafe(F.col("_item")))
    scored = pairs.select("key", "item", F.col("start").alias("offset"), _aligned(F.col("text"), F.col("words")).alias("found"))
    start, end = F.col("offset") + F.col("found.start"), F.col("offset") + F.col("found.stop")
    best = F.struct(F.col("found.score").alias("score"), (-start).alias("start"), end.alias("end"))
    near = scored.filter(F.col("found.score") >= THRESHOLD).select("key", "item", best.alias("best"))
    top = near.groupBy("key", "item").agg(F.max("best").alias("best"))
    return top.select(
        F.col("key").alias(key),
        F.col("item").alias(item),
        F.col("best.score").alias("score"),
        (-F.col("best.start")).alias("start_word"),
        F.col("best.end").alias("end_word"),
    )
