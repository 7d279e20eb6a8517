"""Near-duplicate documents: universal-hash minima, banding, verified links, components.

Documents with equal shingle sets are one node. Every node gets 128 minima, cut into 32
bands. Nodes that share a band are compared in three steps; in each, signatures decide which
pairs to look at, and full shingle sets which of them are links.

1. With the band's hub, the member that shares its bands with most others. That joins a
   large group of copies with one comparison each. Nodes whose signatures are like those of
   their hubs, linked or not, form clusters.
2. Within a cluster that is not yet one component: all pairs between its components, in
   blocks of bounded size that hold the sets; a pair meets once, whatever bands it shares,
   and only links leave the task.
3. Between clusters that meet in a band: blocks of signatures give candidates, which are then
   verified like those of the first step.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundsift.llm.common import stage
from fundsift.llm.components import components
from fundsift.llm.words import WordIds, scramble, shingles, words

#: 32 bands of 4 rows miss a pair with similarity 0.8 with probability 5e-8.
BANDS = 32
ROWS = 4
HASHES = BANDS * ROWS

#: Links: 100 * intersection >= PERCENT * union.
PERCENT = 80

#: Signatures that agree in fewer rows are not looked at: five standard deviations below 0.8.
LEAST_AGREEMENT = 79

#: Nodes of one block when a group is searched for further links, and shingles it may hold. Pairs of
#: blocks are what the join makes and what skewed ones are split into, so blocks are not small.
BLOCK = 256
BLOCK_SIZE = 1 << 18

_RANDOM = np.random.default_rng(20240229)
_FACTORS = _RANDOM.integers(0, 1 << 63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RANDOM.integers(0, 1 << 63, HASHES, np.uint64)


def shingle_set(text: str | None, width: int, ids: WordIds) -> np.ndarray:
    """Sorted numbers of the distinct shingles; a shorter text is one shingle as a whole."""
    found, tail, n = [], np.empty(0, np.uint64), 0
    for chunk in words(text):
        numbers = np.concatenate([tail, ids.of(chunk)])
        found.append(np.unique(shingles(numbers, width)))
        tail = numbers[max(0, len(numbers) - width + 1) :]
        n += len(chunk)
    if not n:
        return tail
    if n < width:
        return scramble(shingles(tail, n) + np.uint64(n))
    return np.unique(np.concatenate(found)) if len(found) > 1 else found[0]


def signature(numbers: np.ndarray) -> np.ndarray:
    """Minima of 128 multiply-shift hashes."""
    low = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    halves = (numbers >> np.uint64(32))[:, None]
    for start in range(0, len(halves), 512):
        hashed = halves[start : start + 512] * _FACTORS
        hashed += _SHIFTS
        hashed >>= np.uint64(32)
        low = np.minimum(low, hashed.min(axis=0).astype(np.uint32))
    return low


def _features(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = WordIds()
        for batch in batches:
            sizes, digests, signatures = [], [], []
            for text in batch["text"]:
                numbers = shingle_set(text.as_py(), width, ids)
                sizes.append(len(numbers))
                digests.append(xxhash.xxh3_128_digest(numbers.tobytes()) if len(numbers) else None)
                signatures.append(signature(numbers).tobytes() if len(numbers) else None)
            arrays = [batch["key"], pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(signatures, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["key", "n_shingles", "digest", "signature"])

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = WordIds()
        for batch in batches:
            for text in batch["text"]:
                numbers = shingle_set(text.as_py(), width, ids)
                if len(numbers):
                    digest = pa.array([xxhash.xxh3_128_digest(numbers.tobytes())], pa.binary())
                    values = pa.array([numbers.view(np.int64)], pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays([digest, values], ["digest", "shingles"])

    return run


def _agreement(a: Column, b: Column) -> Column:
    @F.arrow_udf("int")
    def count(x: pa.Array, y: pa.Array) -> pa.Array:
        left, right = (np.frombuffer(b"".join(v.to_pylist()), np.uint32).reshape(-1, HASHES) for v in (x, y))
        return pa.array((left == right).sum(axis=1).astype(np.int32))

    return count(a, b)


def _near(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) with like signatures."""
    for side in ("a", "b"):
        pairs = pairs.join(nodes.select(F.col("node").alias(side), F.col("signature").alias(f"s{side}")), side)
    return pairs.filter(_agreement(F.col("sa"), F.col("sb")) >= LEAST_AGREEMENT).select("a", "b")


def _verified(near: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are links by their full sets."""
    for side in ("a", "b"):
        near = near.join(sets.select(F.col("node").alias(side), F.col("shingles").alias(f"s{side}")), side)
    common = F.size(F.array_intersect("sa", "sb"))
    counted = near.select("a", "b", common.alias("i"), (F.size("sa") + F.size("sb") - common).alias("u"))
    return counted.filter(100 * F.col("i") >= PERCENT * F.col("u")).select("a", "b")


def _block_pairs(members: DataFrame, payload: DataFrame) -> DataFrame:
    """Pairs of blocks (x, y) of a group whose members may lie in different parts.

    ``members`` has group, node, part and size (of what the payload holds for the node). A
    part that fills a block has blocks of its own, and two blocks of one part never meet.
    """
    units = F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("size") / BLOCK_SIZE)
    parts = members.groupBy("group", "part").agg(units.alias("k"))
    mixed = parts.groupBy("group").agg(F.sum("k").alias("m"), F.count(F.lit(1)).alias("parts"))
    mixed = mixed.filter("parts > 1").select("group", "m")
    sized = stage(parts.join(mixed, "group"), "parts")
    own = F.col("k") >= 1
    placed = members.join(sized, ["group", "part"]).select(
        "group",
        "node",
        "part",
        F.when(own, F.col("part")).otherwise(-1).alias("own"),
        F.pmod(F.xxhash64("node"), F.ceil(F.when(own, F.col("k")).otherwise(F.col("m")))).alias("cut"),
    )
    blocks = placed.join(payload, "node").groupBy("group", "own", "cut")
    blocks = blocks.agg(F.collect_list(F.struct("node", "part", *[c for c in payload.columns if c != "node"])).alias("block"))
    x, y = (blocks.select("group", *[F.col(c).alias(f"{s}{c}") for c in ("own", "cut")], F.col("block").alias(s)) for s in "xy")
    order = "(xown < yown OR xown = yown AND xcut <= ycut) AND NOT (xown >= 0 AND xown = yown)"
    return x.join(y, "group").filter(order).select("x", "y")


class _Block:
    def __init__(self, members: pa.StructArray):
        self.node, self.part = (members.field(c).to_numpy() for c in ("node", "part"))
        self.signatures = np.frombuffer(b"".join(members.field("signature").to_pylist()), np.uint32).reshape(-1, HASHES)

    def candidates(self, other: _Block) -> tuple[np.ndarray, np.ndarray]:
        """Members of both blocks in different parts with like signatures."""
        near = np.empty((len(self.node), len(other.node)), bool)
        for k, one in enumerate(self.signatures):
            same = np.packbits(other.signatures == one, axis=1).view(np.uint64)
            near[k] = np.bitwise_count(same).sum(axis=1) >= LEAST_AGREEMENT
        return np.nonzero(near & (self.part[:, None] != other.part[None, :]))


def _blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.StructArray, pa.StructArray]]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch["x"][k].values, batch["y"][k].values


def _ends(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])


def _candidates_in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for x, y in _blocks_of(batches):
        one, two = _Block(x), _Block(y)
        i, j = one.candidates(two)
        yield _ends(one.node[i], two.node[j])


def _links_in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between parts of two blocks, one for each two parts."""
    for x, y in _blocks_of(batches):
        one, two = _Block(x), _Block(y)
        i, j = one.candidates(two)
        left, right = ([s.values.to_numpy().view(np.uint64) for s in m.field("shingles")] for m in (x, y))
        found: dict[tuple[int, int], tuple[int, int]] = {}
        for k in np.unique(i):
            others = [o for o in j[i == k] if (one.part[k], two.part[o]) not in found]
            if not others:
                continue
            sizes = np.array([len(right[o]) for o in others])
            every = np.concatenate([right[o] for o in others])
            at = np.minimum(np.searchsorted(left[k], every), len(left[k]) - 1)
            common = np.add.reduceat(left[k][at] == every, np.cumsum(sizes) - sizes, dtype=np.int64)
            for o in np.flatnonzero(100 * common >= PERCENT * (len(left[k]) + sizes - common)):
                found.setdefault((one.part[k], two.part[others[o]]), (one.node[k], two.node[others[o]]))
        ends = np.array(list(found.values()), np.int64).reshape(-1, 2)
        yield _ends(ends[:, 0], ends[:, 1])


def _links_in_clusters(clusters: DataFrame, found: DataFrame, nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """Step 2: ``clusters`` and ``found`` have the cluster and the component of each node."""
    members = clusters.select("node", F.col("component").alias("group")).join(found, "node", "left")
    members = members.select("group", "node", F.coalesce("component", "node").alias("part"))
    several = members.groupBy("group").agg(F.min("part").alias("low"), F.max("part").alias("high"))
    several = stage(several.filter("low < high").select("group"), "clusters")
    members = stage(members.join(several, "group").join(sets.select("node", F.size("shingles").alias("size")), "node"), "members")
    wanted = members.select("node").distinct()
    payload = nodes.select("node", "signature").join(wanted, "node", "left_semi").join(sets, "node")
    return _block_pairs(members, payload).mapInArrow(_links_in_blocks, "a long, b long")


def _candidates_across(crowded: DataFrame, clusters: DataFrame, nodes: DataFrame) -> DataFrame:
    """Step 3: like signatures in different clusters that meet in a band."""
    members = crowded.select("node", F.col("band").alias("group")).join(clusters, "node", "left")
    members = members.select("group", "node", F.coalesce("component", "node").alias("part"), F.lit(1).alias("size"))
    several = members.groupBy("group").agg(F.min("part").alias("low"), F.max("part").alias("high"))
    several = stage(several.filter("low < high").select("group"), "mixed-bands")
    members = stage(members.join(several, "group"), "members")
    return _block_pairs(members, nodes.select("node", "signature")).mapInArrow(_candidates_in_blocks, "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 2
) -> DataFrame:
    """One row per input row: ``key``, n_shingles, component_id, kept.

    A text's set has its distinct shingles of ``width`` words, or the whole text as one
    shingle if it has fewer words. Null and empty texts have no shingles and are linked
    with nothing: ``component_id`` is their own key. Rows with equal sets are linked, so
    repeated rows share a component. ``component_id`` is the smallest key of the
    component, ``kept`` says that the row has it; null keys are ignored for the minimum,
    and a component of null keys only has a null ``component_id`` and is kept. An empty
    table gives no rows; other columns are ignored.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = rows.select("key").schema.add("n_shingles", "long").add("digest", "binary").add("signature", "binary")
    features = stage(rows.mapInArrow(_features(width), schema), "features")
    nodes = stage(
        features.filter("digest IS NOT NULL")
        .groupBy("digest")
        .agg(F.min("key").alias("sample"), F.min("signature").alias("signature"))
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    cuts = [F.xxhash64(F.substring("signature", 4 * ROWS * k + 1, 4 * ROWS), F.lit(k)) for k in range(BANDS)]
    bands = nodes.select("node", F.explode(F.array(*cuts)).alias("band"))
    shared = bands.groupBy("band").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    shared = stage(shared, "shared-bands")
    crowded = stage(bands.join(shared, "band"), "bands")

    near = crowded.select("node").distinct()
    wanted = nodes.join(near, "node", "left_semi").select("digest", "node", "sample")
    sampled = wanted.select(F.col("sample").alias("_sample")).distinct()
    texts = rows.join(sampled, F.col("key").eqNullSafe(F.col("_sample")), "left_semi").select("text")
    made = texts.mapInArrow(_sets(width), "digest binary, shingles array<long>")
    sets = stage(made.join(wanted, "digest").select("node", "shingles").dropDuplicates(["node"]), "sets")

    central = crowded.groupBy("node").agg(F.sum("members").alias("weight"))
    hubs = crowded.join(central, "node").groupBy("band").agg(F.max(F.struct("weight", "node")).alias("hub"))
    hubs = stage(hubs, "hubs")
    stars = crowded.join(hubs.select("band", F.col("hub.node").alias("hub")), "band").filter("node != hub")
    pairs = stars.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
    near = stage(_near(pairs, nodes), "near-pairs")
    clusters = stage(components(near), "clusters")
    links = stage(_verified(near, sets), "links")
    found = stage(components(links), "components")
    inside = stage(_links_in_clusters(clusters, found, nodes, sets), "links")
    across = stage(_candidates_across(crowded, clusters, nodes), "near-pairs")
    joined = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
    found = stage(components(joined.union(inside).union(_verified(across, sets))), "components")

    real = features.filter("digest IS NOT NULL").join(nodes.select("digest", "node"), "digest")
    real = real.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = stage(real.groupBy("component").agg(F.min("key").alias("least")), "least")
    real = real.join(least, "component").select("key", "n_shingles", F.col("least").alias("component_id"))
    alone = features.filter("digest IS NULL").select("key", "n_shingles", F.col("key").alias("component_id"))
    return real.union(alone).select(
        F.col("key").alias(key),
        "n_shingles",
        "component_id",
        F.col("key").eqNullSafe(F.col("component_id")).alias("kept"),
    )
