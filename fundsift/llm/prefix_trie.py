"""The trie of conversation prefixes: splitter skeleton, local shards, partial aggregates.

A conversation's path has 16 bytes a turn, so paths sort like the sequences of turns. Splitters
from a sample cut the sorted paths into ranges. Only proper prefixes of a splitter can have
members in several ranges: these nodes, the skeleton, are broadcast. Each shard walks its
paths in order and finishes all other nodes by itself; of a skeleton node it gives what
it has, and those parts are added up afterwards.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fundsift.llm.common import stage, whole

#: Bytes of a turn in a path.
TOKEN = 16

#: Sampled paths for each shard; the splitters are the quantiles of the sample.
SAMPLED = 20

#: Most turns that a conversation takes from its base conversation.
LONGEST_HEAD = 8

#: Ids of a path that are joined to one text: those that agree but for so many low bits.
ID_BITS = 10

#: Rows of an output batch.
ROWS = 8192

NO_ENDS = hashlib.sha256(b"").hexdigest()

_NODE = (
    "part int, seq long, depth long, skeleton int, parent int, conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, last_bytes long, ends_sha256 string"
)
_FIELDS = [f.split()[0] for f in _NODE.split(", ")]
_ARROW = pa.schema([(n, {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}[t]) for n, t in map(str.split, _NODE.split(", "))])
_OUT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1 by turn, null first; ties by role and text), token, size (bytes of the text)."""
    role, digest = whole(F.col("role")), F.sha2(whole(F.col("text")), 256)
    rows = conversations.filter("conv_id IS NOT NULL").select(
        "conv_id",
        "turn",
        role.alias("role"),
        digest.alias("digest"),
        F.substring(F.sha2(F.concat(digest, role), 256), 1, 2 * TOKEN).alias("token"),
        F.octet_length(whole(F.col("text"))).alias("size"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "digest")
    return rows.select("conv_id", F.row_number().over(order).alias("pos"), "token", "size")


def paths_of(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """conv_id, path, sizes for every conversation of ``ids``, from ``turns`` rows."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", "token", "size")))
    told = rows.groupBy("conv_id").agg(ordered.alias("t"))
    told = told.select("conv_id", F.unhex(F.array_join("t.token", "")).alias("path"), F.col("t.size").alias("sizes"))
    told = ids.select("conv_id").join(told, "conv_id", "left")
    empty = F.array().cast("array<int>")
    return told.select("conv_id", F.coalesce("path", F.lit(b"")).alias("path"), F.coalesce("sizes", empty).alias("sizes"))


def with_shared_heads(rows: DataFrame, head: Column) -> tuple[DataFrame, DataFrame]:
    """Turns and ids of conversations that begin with turns of conversation c - c % 5.

    The first ``head`` turns (a column over conv_id, at most ``LONGEST_HEAD``) come from there,
    as far as there are; a conversation's own turns follow from its next one on.
    """
    rows = stage(rows, "turns")
    ids = rows.select("conv_id").distinct().withColumn("head", head)
    bases = rows.filter(F.col("pos") <= LONGEST_HEAD).withColumnRenamed("conv_id", "base")
    named = ids.withColumn("base", F.col("conv_id") - F.col("conv_id") % 5)
    heads = named.join(bases, "base").filter("pos <= head").select("conv_id", "pos", "token", "size")
    own = rows.withColumn("head", head).filter("pos > head").select("conv_id", "pos", "token", "size")
    return heads.union(own), ids.select("conv_id")


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (path_id, n, least, ids) in order: for each path its number of ids, the least, and their digest."""
    names = ["path_id", "n", "least", "ends_sha256"]
    now, n, least, digest = None, 0, 0, hashlib.sha256()
    for batch in batches:
        done: list[tuple] = []
        for path_id, some, first, ids in zip(*(batch[c].to_pylist() for c in ("path_id", "n", "least", "ids")), strict=True):
            if path_id != now:
                if n:
                    done.append((now, n, least, digest.hexdigest()))
                now, n, least, digest = path_id, 0, first, hashlib.sha256()
            digest.update(("," + ids if n else ids).encode())
            n += some
        yield _record(done, names)
    if n:
        yield _record([(now, n, least, digest.hexdigest())], names)


def _record(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.binary(), pa.int64(), pa.int64(), pa.string()]
    columns = list(zip(*rows, strict=True)) or [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def distinct_paths(paths: DataFrame) -> DataFrame:
    """One row per path: path, sizes, n (conversations that end there), least id, ends_sha256.

    Neighbouring ids of a path are first joined to one text, in parallel however many end there. Only
    the digest, which takes bytes in order, is left to one task a path; the texts stream by it.
    """
    path_id = F.unhex(F.substring(F.sha2("path", 256), 1, 32))
    named = paths.select(path_id.alias("path_id"), F.shiftright("conv_id", ID_BITS).alias("cell"), "conv_id")
    ordered = F.array_sort(F.collect_list("conv_id")).cast("array<string>")
    cells = named.groupBy("path_id", "cell").agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least"), F.array_join(ordered, ",").alias("ids")
    )
    dealt = cells.repartition("path_id").sortWithinPartitions("path_id", "cell")
    ends = dealt.mapInArrow(_ends, "path_id binary, n long, least long, ends_sha256 string")
    return ends.join(paths, ends["least"] == paths["conv_id"]).select("path", "sizes", "n", "least", "ends_sha256")


class Skeleton:
    """The trie of all proper prefixes of some splitters, the root included."""

    def __init__(self, splitters: list[bytes]):
        self.cuts = self._shortened(splitters)
        self.children: list[dict[bytes, int]] = [{}]
        self.parent = [-1]
        self.depth = [0]
        for cut in self.cuts:
            at = 0
            for k in range(0, len(cut) - TOKEN, TOKEN):
                token = cut[k : k + TOKEN]
                if token not in self.children[at]:
                    self.children[at][token] = len(self.children)
                    self.children.append({})
                    self.parent.append(at)
                    self.depth.append(self.depth[at] + 1)
                at = self.children[at][token]

    @staticmethod
    def _shortened(splitters: list[bytes]) -> list[bytes]:
        """Each splitter up to the first turn that tells it from the one before."""
        cuts, last = [], b""
        for splitter in splitters:
            if splitter > last:
                shared = len(commonprefix([last, splitter])) // TOKEN
                cuts.append(splitter[: (shared + 1) * TOKEN])
                last = splitter
        return cuts

    def part(self, path: bytes) -> int:
        return bisect_right(self.cuts, path)


class _Open:
    """A node whose subtree is still being walked."""

    __slots__ = ("children", "ends", "last", "leaves", "least", "n", "saved", "skeleton", "token")

    def __init__(self, token: bytes, last: int, skeleton: int):
        self.token, self.last, self.skeleton = token, last, skeleton
        self.n = self.children = self.leaves = self.saved = 0
        self.least = self.ends = None

    def add(self, n: int, least: int) -> None:
        self.n += n
        self.least = least if self.least is None else min(self.least, least)


class _Walk:
    """Nodes of one shard in post-order, its paths being added in order."""

    def __init__(self, part: int, skeleton: Skeleton):
        self.part, self.skeleton, self.seq = part, skeleton, 0
        self.open = [_Open(b"", 0, 0)]

    def close(self, depth: int) -> Iterator[tuple]:
        """Finish the open nodes below ``depth``."""
        while len(self.open) > depth + 1:
            yield self._closed(self.open.pop(), self.open[-1])

    def end(self) -> Iterator[tuple]:
        yield from self.close(0)
        yield self._closed(self.open.pop(), None)

    def _closed(self, node: _Open, above: _Open | None) -> tuple:
        own = node.skeleton < 0
        if own:
            node.leaves += not node.children
            node.saved += (node.n - 1) * node.last
        if above is not None:
            above.add(node.n, node.least)
            above.children += own
            above.leaves += node.leaves
            above.saved += node.saved
        self.seq += 1
        parent = above.skeleton if above is not None else -1
        return (self.part, self.seq, len(self.open), node.skeleton, parent, node.least, node.n, node.children, node.leaves, node.saved, node.last, node.ends)

    def add(self, path: bytes, sizes: list[int], n: int, least: int, ends: str) -> Iterator[tuple]:
        tokens = [path[k : k + TOKEN] for k in range(0, len(path), TOKEN)]
        shared = 0
        while shared < len(tokens) and shared + 1 < len(self.open) and self.open[shared + 1].token == tokens[shared]:
            shared += 1
        yield from self.close(shared)
        for token, size in zip(tokens[shared:], sizes[shared:], strict=True):
            above = self.open[-1].skeleton
            known = self.skeleton.children[above].get(token, -1) if above >= 0 else -1
            self.open.append(_Open(token, size, known))
        self.open[-1].add(n, least)
        self.open[-1].ends = ends


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def _walked(shared) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def nodes() -> Iterator[tuple]:
            walk = None
            for part, *path in _rows(batches):
                if walk is None or walk.part != part:
                    if walk:
                        yield from walk.end()
                    walk = _Walk(part, shared.value)
                yield from walk.add(*path)
            if walk:
                yield from walk.end()

        yield from _batches(nodes(), _ARROW)

    return run


def _with_parents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes with the parent's least id, where it is no skeleton node; parents come first."""

    def nodes() -> Iterator[tuple]:
        above: list[int] = []
        for row in _rows(batches):
            depth, parent, least = row[2], row[4], row[5]
            del above[depth:]
            above.append(least)
            yield (*row, above[depth - 1] if depth and parent < 0 else None)

    yield from _batches(nodes(), _ARROW.append(pa.field("parent_conv_id", pa.int64())))


def _splitters(paths: DataFrame, shards: int) -> list[bytes]:
    """At most ``shards`` - 1 quantiles of a sample by hash of the paths; only they reach the driver."""
    n = paths.count()
    wanted = 1 << 40
    limit = wanted if n <= SAMPLED * shards else wanted * SAMPLED * shards // n
    sample = paths.select("path").filter(F.pmod(F.xxhash64("path"), F.lit(wanted)) < limit)
    at = F.row_number().over(Window.orderBy("path"))
    ranked = sample.select("path", at.alias("at"), F.count(F.lit(1)).over(Window.partitionBy(F.lit(0))).alias("all"))
    step = F.greatest(F.ceil(F.col("all") / shards), F.lit(1))
    return sorted(bytes(r.path) for r in ranked.filter(F.col("at") % step == 0).select("path").collect())


def _rolled_up(spark: SparkSession, partials: DataFrame, skeleton: Skeleton) -> DataFrame:
    """Skeleton nodes from their parts: sums by Spark, and then from the deepest to the root."""
    sums = partials.groupBy("skeleton").agg(
        F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max("last_bytes").alias("last_bytes"),
        F.max("ends_sha256").alias("ends_sha256"),
    )
    found = {r.skeleton: r.asDict() for r in sums.collect()}
    own = dict.fromkeys(found, 0)
    for k in sorted(found, key=lambda k: -skeleton.depth[k]):
        row, above = found[k], skeleton.parent[k]
        own[k] += (row["n_convs"] - 1) * row["last_bytes"]
        row["saved_tokens"] += own[k]
        row["n_leaves"] += row["n_children"] == 0  # a root that is the only node
        if above >= 0:
            own[above] += own[k]
            found[above]["n_children"] += 1
    rows = [
        (k, r["conv_id"], skeleton.depth[k], found[skeleton.parent[k]]["conv_id"] if k else None,
         r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"], r["ends_sha256"])
        for k, r in found.items()
    ]
    schema = "skeleton int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
    return spark.createDataFrame(rows, schema)


def trie(paths: DataFrame) -> DataFrame:
    """One row per distinct prefix of ``paths`` (conv_id, path, sizes), the empty one included.

    Columns: conv_id (the smallest member), depth, parent_conv_id (null at the root), n_convs,
    n_children, n_leaves, saved_tokens (over the subtree, bytes of a node's last text times its
    members but one), ends_sha256 (over the ids that end at the node, in ascending order). No
    path gives no rows. Ids must not repeat. A shard holds one path at a time; what is broadcast
    and rolled up is bounded by the number of shards times the longest prefix that two
    neighbouring splitters share.
    """
    spark = paths.sparkSession
    ends = stage(distinct_paths(paths), "distinct-paths")
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    skeleton = Skeleton(_splitters(ends, shards))
    shared = spark.sparkContext.broadcast(skeleton)

    @F.arrow_udf("int")
    def part_of(path: pa.Array) -> pa.Array:
        return pa.array([shared.value.part(p.as_py()) for p in path], pa.int32())

    placed = ends.select(part_of("path").alias("part"), "path", "sizes", "n", "least", "ends_sha256")
    walked = placed.repartition(shards, "part").sortWithinPartitions("part", "path").mapInArrow(_walked(shared), _NODE)
    known = walked.sortWithinPartitions("part", F.desc("seq")).mapInArrow(_with_parents, _NODE + ", parent_conv_id long")
    nodes = stage(known, "nodes")
    top = _rolled_up(spark, nodes.filter("skeleton >= 0"), skeleton)
    above = F.broadcast(top.select(F.col("skeleton").alias("parent"), F.col("conv_id").alias("_above")))
    rest = nodes.filter("skeleton < 0").join(above, "parent", "left")
    rest = rest.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_above"))
    every = rest.select(_OUT).union(top.select(_OUT))
    return every.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS)))


def prefix_trie(conversations: DataFrame, head: Column | None = None) -> DataFrame:
    """The trie of all conversations (conv_id, turn, role, text), see ``trie``.

    With ``head``, conversations are first rebuilt by ``with_shared_heads``. Turns are ordered by
    turn, null first, ties by role and text; repeated rows are turns of their own. Null roles
    and texts are empty ones. Rows without conv_id belong to no conversation and are left out. An
    empty table gives no rows; other columns are ignored. A conversation's path is one row of 20
    bytes a turn.
    """
    rows = turns(conversations)
    if head is None:
        rows = stage(rows, "turns")
        ids = rows.select("conv_id").distinct()
    else:
        rows, ids = with_shared_heads(rows, head)
    return trie(stage(paths_of(rows, ids), "paths"))
