"""Removal of repeated passages: bytes that a 200-byte string covers which also starts elsewhere.

Two equal strings of 200 bytes have their smallest 24-byte hash at the same place: their
anchor. So a string is only compared with strings around anchors of equal content. Per
anchor there is one record, the stretch of all 200-byte strings that have it as theirs.
Stretches that are equal as a whole are repeated as a whole. Of the others each is sorted
once by what follows the anchor and once, backwards, by what precedes it, with the
prefix-aware merge sort. Neighbours in either order show repeated strings and bound what
else may be repeated; the few strings left open in between are compared by content.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundsift.llm.common import discard, shuffles_freed, stage, whole
from fundsift.llm.merge_sort import common_prefix, sort_ranges

#: Bytes of a repeated string, of an anchor, and the places an anchor may have in a string.
LENGTH = 200
ANCHOR = 24
PLACES = LENGTH - ANCHOR + 1

#: Strings looked at together, which bounds memory for very long texts.
CHUNK = 1 << 18

#: Records that are stored and sorted at the same time, as a share of all anchors, and open strings for each record.
SORTED = 0.2
OPEN = 2

#: So many records, or open strings, always go together.
LEAST = 1 << 20

_MIX = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def _hashes(raw: np.ndarray) -> np.ndarray:
    """A hash of the ``ANCHOR`` bytes from each position."""
    n = len(raw) - ANCHOR + 1
    words = np.ndarray(len(raw) - 7, np.uint64, np.ascontiguousarray(raw), strides=(1,))
    mixed = words[:n] * _MIX[0]
    mixed ^= mixed >> np.uint64(29)
    mixed += words[8 : n + 8] * _MIX[1]
    mixed *= _MIX[3]
    mixed ^= mixed >> np.uint64(31)
    mixed += words[16 : n + 16] * _MIX[2]
    mixed *= _MIX[3]
    return mixed ^ (mixed >> np.uint64(32))


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` values in a row, by prefix and suffix minima of blocks."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    shaped = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(shaped, axis=1).ravel()
    behind = np.minimum.accumulate(shaped[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def _anchors_of_chunk(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash and position of each anchor, and the first and last string that has it."""
    hashes = _hashes(raw)
    least = _sliding_min(hashes, PLACES)
    first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    last = np.append(first[1:] - 1, len(least) - 1)
    same = hashes[first[:, None] + np.arange(PLACES)] == least[first][:, None]
    at = first + same.argmax(axis=1)
    tied = np.flatnonzero(last > at)
    if len(tied):
        # The smallest hash occurs again: each occurrence has the strings that start after the one before.
        keep = np.ones(len(at), bool)
        keep[tied] = False
        parts = [(at[keep], first[keep], last[keep])]
        for k in tied:
            places = first[k] + np.flatnonzero(hashes[first[k] : last[k] + PLACES] == least[first[k]])
            starts = np.concatenate([[first[k]], places[:-1] + 1])
            used = starts <= last[k]
            parts.append((places[used], starts[used], np.minimum(places[used], last[k])))
        at, first, last = (np.concatenate([p[i] for p in parts]) for i in range(3))
    return hashes[at], at, first, last


def anchors(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hashes, positions, first and last strings of a whole text."""
    data = np.frombuffer(raw, np.uint8)
    found = []
    for start in range(0, max(0, len(data) - LENGTH + 1), CHUNK):
        hashes, at, first, last = _anchors_of_chunk(data[start : start + CHUNK + LENGTH - 1])
        found.append((hashes, at + start, first + start, last + start))
    if not found:
        return (np.empty(0, np.uint64), *[np.empty(0, np.int64)] * 3)
    return tuple(np.concatenate([f[i] for f in found]) for i in range(4))


def _pack(at: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    return at << 16 | (at - first) << 8 | (last - first)


#: Parts of a packed place: anchor position, bytes before it, and strings less one.
_AT, _BEFORE, _SPAN = "shiftright(place, 16)", "(shiftright(place, 8) & 255)", "(place & 255)"


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns: list[list[np.ndarray]] = [[] for _ in range(5)]
        for h1, h2, text in zip(batch["h1"].to_numpy(), batch["h2"].to_numpy(), batch["text"], strict=True):
            raw = text.as_py().encode("utf-8", "surrogatepass")
            hashes, at, first, last = anchors(raw)
            digest = xxhash.xxh3_64_intdigest
            names = (digest(raw[i : j + LENGTH], a - i) for a, i, j in zip(at.tolist(), first.tolist(), last.tolist(), strict=True))
            columns[0].append(hashes.view(np.int64))
            columns[1].append(np.fromiter(names, np.uint64, len(at)).view(np.int64))
            columns[2].append(np.full(len(at), h1))
            columns[3].append(np.full(len(at), h2))
            columns[4].append(_pack(at, first, last))
        arrays = [pa.array(np.concatenate(c) if c else np.empty(0, np.int64)) for c in columns]
        yield pa.RecordBatch.from_arrays(arrays, ["anchor", "stretch", "h1", "h2", "place"])


def _packed(text: Column) -> Column:
    """Texts compressed for the shuffle."""

    @F.arrow_udf("binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            yield pa.array([packer.compress(t.as_py().encode("utf-8", "surrogatepass")) for t in batch], pa.binary())

    return run(text)


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut the wanted stretches out of the texts."""
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        rows: list[tuple] = []
        for packed, wanted in zip(batch["packed"], batch["wanted"].to_pylist(), strict=True):
            raw = unpack(packed.as_py())
            for w in wanted:
                at, before, span = w["place"] >> 16, w["place"] >> 8 & 255, w["place"] & 255
                rows.append((w["anchor"], w["stretch"], before, w["copies"], raw[at - before : at - before + span + LENGTH]))
        columns = list(zip(*rows, strict=True)) or [()] * 5
        kinds = [pa.int64()] * 4 + [pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["anchor", "stretch", "before", "copies", "bytes"]
        )


def _sides(columns: dict) -> tuple[list[bytes], list[bytes]]:
    """What follows from the anchor on, and what precedes it, backwards."""
    pairs = list(zip(columns["bytes"], columns["before"], strict=True))
    return [b[n:] for b, n in pairs], [b[:n][::-1] for b, n in pairs]


def _forward(columns: dict) -> list[bytes]:
    ahead, behind = _sides(columns)
    return [a.ljust(LENGTH, b"\0") + b for a, b in zip(ahead, behind, strict=True)]


def _backward(columns: dict) -> list[bytes]:
    ahead, behind = _sides(columns)
    return [b.ljust(PLACES - 1, b"\0") + a for a, b in zip(ahead, behind, strict=True)]


_CARRIED = {"anchor": "long", "stretch": "long", "before": "long", "ahead": "long"}
_NEIGHBOUR = "anchor long, stretch long, forward boolean, bound long, low long, high long"
_EDGE = "part long, first boolean, key binary, before long, ahead long"


def _compare(forward: bool, x: dict, y: dict, kx: bytes, ky: bytes, shared: int) -> tuple[int, int, int]:
    """What two neighbours show: the shared length of the sorted side, and which strings are equal.

    A string is named by the bytes it has before the anchor; those from low to high are.
    """
    width = LENGTH if forward else PLACES - 1
    bound = min(shared, width)
    rest = shared - width if shared >= width else common_prefix(kx[width:], ky[width:])
    ahead, behind = (bound, rest) if forward else (rest, bound)
    ahead = min(ahead, x["ahead"], y["ahead"])
    behind = min(behind, x["before"], y["before"])
    return bound, LENGTH - ahead, behind


def _neighbours(forward: bool):
    names = [f.split()[0] for f in _NEIGHBOUR.split(", ")] + ["part", "first", "key", "own_before", "own_ahead"]
    kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.int64(), pa.int64()]

    def reduce(part: int, records: Iterator[tuple[dict, int, bytes]]) -> pa.Table:
        rows: list[tuple] = []
        last = None
        for row, shared, key in records:
            if last is None:
                rows.append((row["anchor"], row["stretch"], forward, 0, 1, 0, part, True, key, row["before"], row["ahead"]))
            else:
                seen = _compare(forward, last[0], row, last[1], key, shared)
                for r in (last[0], row):
                    rows.append((r["anchor"], r["stretch"], forward, *seen, None, None, None, None, None))
            last = row, key
        row, key = last
        rows.append((row["anchor"], row["stretch"], forward, 0, 1, 0, part, False, key, row["before"], row["ahead"]))
        columns = zip(*rows, strict=True)
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    schema = f"{_NEIGHBOUR}, part long, first boolean, key binary, own_before long, own_ahead long"
    return reduce, schema


def _across_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last record of a range beside the first of the next."""
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            x, y = ({"before": r[f"{s}_before"], "ahead": r[f"{s}_ahead"]} for s in "xy")
            shared = common_prefix(r["x_key"], r["y_key"])
            seen = _compare(r["forward"], x, y, r["x_key"], r["y_key"], shared)
            rows += [(r[f"{s}_anchor"], r[f"{s}_stretch"], r["forward"], *seen) for s in "xy"]
        columns = list(zip(*rows, strict=True)) or [()] * 6
        kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["anchor", "stretch", "forward", "bound", "low", "high"]
        )


def _compared(records: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Per record and neighbour in either order what the two show, and the staged tables that it reads."""
    found, read = [], []
    with_ahead = records.withColumn("ahead", F.octet_length("bytes") - F.col("before"))
    for forward, key_of in ((True, _forward), (False, _backward)):
        reduce, schema = _neighbours(forward)
        ranges = stage(sort_ranges(with_ahead, key_of, _CARRIED, reduce, schema), "neighbours")
        read.append(ranges)
        edges = ranges.filter("part IS NOT NULL")
        picked = ["anchor", "stretch", "key", F.col("own_before").alias("before"), F.col("own_ahead").alias("ahead")]
        ends = ["anchor", "stretch", "key", "before", "ahead"]
        x = edges.filter("NOT first").select((F.col("part") + 1).alias("part"), "forward", *picked)
        y = edges.filter("first").select("part", *picked)
        x = x.select("part", "forward", *[F.col(c).alias(f"x_{c}") for c in ends])
        y = y.select("part", *[F.col(c).alias(f"y_{c}") for c in ends])
        between = x.join(y, "part").mapInArrow(_across_ranges, _NEIGHBOUR)
        found += [ranges.filter("part IS NULL").select("anchor", "stretch", "forward", "bound", "low", "high"), between]
    return found[0].unionByName(found[1]).unionByName(found[2]).unionByName(found[3]), read


def _decide(before: int, ahead: int, most_ahead: int, most_behind: int, equal: list[dict]) -> tuple[list, list, int, int]:
    """Strings known to be repeated, as intervals, strings still open, and the first and last that may be repeated."""
    known = sorted((e["low"], e["high"]) for e in equal if e["low"] <= e["high"])
    first, last = max(LENGTH - min(most_ahead, ahead), 0), min(most_behind, before)
    open_, at = [], first
    for low, high in known:
        open_ += range(at, min(low, last + 1))
        at = max(at, high + 1)
    open_ += range(at, last + 1)
    return [{"low": a, "high": b} for a, b in known], open_, first, last


def _decided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    interval = pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))
    for batch in batches:
        d = batch.to_pydict()
        found = [_decide(*v) for v in zip(d["before"], d["ahead"], d["most_ahead"], d["most_behind"], d["equal"], strict=True)]
        kinds = [interval, pa.list_(pa.int64()), pa.int64(), pa.int64()]
        arrays = [batch["anchor"], batch["stretch"], *(pa.array([f[i] for f in found], k) for i, k in enumerate(kinds))]
        yield pa.RecordBatch.from_arrays(arrays, ["anchor", "stretch", "equal", "open", "first", "last"])


def _equal_strings(records: DataFrame, decided: DataFrame) -> list[DataFrame]:
    """(anchor, stretch, low, high), staged: strings that are open for some record and equal those of another.

    Compared are only strings that may be repeated as far as their own record shows. They are
    dealt out by anchor and offset, and about ``OPEN`` for each record are stored at a time.
    """
    offsets = decided.select("anchor", F.explode("open").alias("offset"))
    offsets = stage(offsets.groupBy("anchor").agg(F.collect_set("offset").alias("offsets")), "open")
    may_be = F.expr("filter(offsets, o -> o BETWEEN first AND last)").alias("offsets")
    looked_at = decided.filter("first <= last").join(offsets, "anchor").select("anchor", "stretch", may_be)
    looked_at = stage(looked_at.filter(F.size("offsets") > 0), "looked-at")
    total = looked_at.agg(F.sum(F.size("offsets"))).first()[0] or 0
    discard(offsets)
    slices = -(-total // max(LEAST, OPEN * records.count()))
    settled = []
    for k in range(slices):
        own = F.expr(f"filter(offsets, o -> pmod(xxhash64(anchor, o), {slices}) = {k})")
        part = looked_at.select("anchor", "stretch", own.alias("offsets")).filter(F.size("offsets") > 0)
        strings = records.join(part, ["anchor", "stretch"]).select("anchor", "stretch", "before", "bytes", F.explode("offsets").alias("offset"))
        string = F.expr(f"substring(bytes, CAST(before - offset + 1 AS INT), {LENGTH})").alias("string")
        strings = stage(strings.select("anchor", "stretch", "offset", string), "strings")
        equal = strings.groupBy("anchor", "offset", "string").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
        equal = stage(equal, "equal-strings")
        same = strings.join(equal, ["anchor", "offset", "string"])
        settled.append(stage(same.select("anchor", "stretch", F.col("offset").alias("low"), F.col("offset").alias("high")), "settled"))
        discard(strings, equal)
    discard(looked_at)
    return settled


def _repeated_inside(records: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(anchor, stretch, low, high): strings of stretches that another stretch has too; and the staged tables that it reads."""
    seen, read = _compared(records)
    seen = seen.groupBy("anchor", "stretch").agg(
        F.coalesce(F.max(F.when(F.col("forward"), F.col("bound"))), F.lit(0)).alias("most_ahead"),
        F.coalesce(F.max(F.when(~F.col("forward"), F.col("bound"))), F.lit(0)).alias("most_behind"),
        F.collect_list(F.when(F.col("low") <= F.col("high"), F.struct("low", "high"))).alias("equal"),
    )
    sized = records.select("anchor", "stretch", "before", (F.octet_length("bytes") - F.col("before")).cast("long").alias("ahead"))
    schema = "anchor long, stretch long, equal array<struct<low: long, high: long>>, open array<long>, first long, last long"
    decided = stage(sized.join(seen, ["anchor", "stretch"]).mapInArrow(_decided, schema), "decided")
    discard(*read)
    settled = _equal_strings(records, decided)
    shown = decided.select("anchor", "stretch", F.explode("equal").alias("e")).select("anchor", "stretch", "e.low", "e.high")
    return reduce(DataFrame.union, settled, shown), [decided, *settled]


def remove(raw: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """What is left of ``raw``, the bytes removed, and the number of maximal removed runs."""
    kept, at, runs, removed = [], 0, 0, 0
    end = -1
    for start, stop in sorted(spans):
        if start > end:
            runs += 1
            kept.append(raw[at:start])
            removed += stop - start
            at = end = stop
        elif stop > end:
            removed += stop - end
            at = end = stop
    kept.append(raw[at:])
    return b"".join(kept), removed, runs


def _cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        rows = []
        for packed, spans in zip(batch["packed"], batch["spans"].to_pylist(), strict=True):
            raw = unpack(packed.as_py())
            left, removed, runs = remove(raw, [(s["start"], s["stop"]) for s in spans or ()])
            rows.append((len(raw), removed, runs, left))
        columns = list(zip(*rows, strict=True)) or [()] * 4
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        arrays = [batch["key"], *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))]
        yield pa.RecordBatch.from_arrays(arrays, ["key", "n_bytes", "n_removed", "n_spans", "kept"])


def _by_text(spans: DataFrame, name: str) -> DataFrame:
    """(h1, h2, spans), staged: the distinct byte ranges of each text."""
    return stage(spans.distinct().groupBy("h1", "h2").agg(F.collect_list(F.struct("start", "stop")).alias("spans")), name)


def _records(docs: DataFrame, copies: DataFrame) -> DataFrame:
    """The bytes of stretches, each cut out of one text that has it; staged."""
    wanted = copies.select("anchor", "stretch", "copies", "of.h1", "of.h2", "of.place")
    wanted = wanted.groupBy("h1", "h2").agg(F.collect_list(F.struct("anchor", "stretch", "copies", "place")).alias("wanted"))
    texts = docs.select("h1", "h2", "key", _packed(F.col("text")).alias("packed"))
    some = docs.groupBy("h1", "h2").agg(F.min("key").alias("_key"))
    sources = wanted.join(some, ["h1", "h2"]).join(texts, ["h1", "h2"]).filter(F.col("key").eqNullSafe(F.col("_key")))
    cut = sources.select("packed", "wanted").mapInArrow(_stretches, "anchor long, stretch long, before long, copies long, bytes binary")
    return stage(cut.dropDuplicates(["anchor", "stretch"]), "records")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(h1, h2, spans): byte ranges to remove, by the two hashes of a text.

    Each table on the way is deleted once the tables made of it are written, so that the
    disk holds what one step reads and writes, not what all steps do. Where records or open
    strings would be many times the texts, they are made and compared in slices, one after another.
    """
    with shuffles_freed(docs.sparkSession):
        return _repeated_spans(docs)


def _repeated_spans(docs: DataFrame) -> DataFrame:
    rows = stage(docs.mapInArrow(_anchor_rows, "anchor long, stretch long, h1 long, h2 long, place long"), "rows")
    again = rows.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor")
    again = stage(again, "shared-anchors")
    shared = stage(rows.join(again, "anchor"), "anchors")
    anchors_in_all = rows.count()
    discard(rows, again)
    copies = shared.groupBy("anchor", "stretch").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("h1", "h2", "place")).alias("of"))
    copies = stage(copies, "stretches")
    several = copies.filter("copies > 1").select("anchor", "stretch")
    whole_ones = shared.join(several, ["anchor", "stretch"]).selectExpr(
        "h1", "h2", f"{_AT} - {_BEFORE} AS start", f"{_AT} - {_BEFORE} + {_SPAN} + {LENGTH} AS stop"
    )
    whole_ones = _by_text(whole_ones, "whole-stretches")
    discard(shared)

    variants = stage(copies.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "varied-anchors")
    slices = -(-(variants.agg(F.sum("n")).first()[0] or 0) // max(LEAST, int(SORTED * anchors_in_all)))
    single = copies.filter("copies = 1").selectExpr("anchor", "stretch", "of.h1", "of.h2", "of.place")
    found = [whole_ones]
    for k in range(slices):
        records = _records(docs, copies.join(variants.filter(F.pmod("anchor", F.lit(slices)) == k).select("anchor"), "anchor"))
        inside, read = _repeated_inside(records)
        parts = inside.join(single, ["anchor", "stretch"])
        parts = parts.selectExpr("h1", "h2", f"{_AT} - high AS start", f"{_AT} - low + {LENGTH} AS stop")
        found.append(_by_text(parts, "parts"))
        discard(records, *read)
    discard(copies, variants)
    spans = reduce(DataFrame.union, found).groupBy("h1", "h2").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    spans = stage(spans, "spans")
    discard(*found)
    return spans


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``key``, n_bytes, n_removed, n_spans, kept (the bytes left).

    Removed is every byte that lies in a string of 200 bytes which also starts anywhere
    else in the table, the same text included; strings never cross texts. Null counts as
    empty, and texts under 200 bytes stay whole. Repeated rows are texts like others, so
    all their copies go. An empty table gives no rows; other columns are ignored.
    """
    known = whole(F.col(text))
    rows = docs.select(F.col(key).alias("key"), known.alias("text"), F.xxhash64(known).alias("h1"), F.xxhash64(F.lit(1), known).alias("h2"))
    spans = repeated_spans(rows)
    packed = rows.select("key", "h1", "h2", _packed(F.col("text")).alias("packed"))
    joined = packed.join(spans, ["h1", "h2"], "left").select("key", "packed", "spans")
    schema = rows.select("key").schema.add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("kept", "binary")
    return joined.mapInArrow(_cleaned, schema).withColumnRenamed("key", key)
