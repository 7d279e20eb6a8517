"""Exact deduplication by content-defined chunk recipes, with built-in functions only.

Each text is cut where its own content says so. Equal chunks meet once, map side first, and
are compared by content: a chunk hash shared by different chunks is ambiguous. A document
is then only its recipe, the ordered list of its chunk identifiers, plus the content of
ambiguous chunks; documents are grouped by comparing recipes, and their texts stay where
they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundsift.llm.common import WHITE_SPACE, stage, whole

#: A chunk ends at a vowel before a space, 256 to 2048 characters after the last cut.
CHUNK = r"(?s).{256,2046}?(?:[aeiou] |\z)|.{1,2048}"

#: Ambiguous 64-bit hashes that a run may meet before it stops with an error.
MAX_AMBIGUOUS = 100_000


def normalised(text: Column) -> Column:
    """Null as empty, every run of white space as one space."""
    return F.regexp_replace(whole(text), WHITE_SPACE, " ")


def chunks(text: Column) -> Column:
    """The chunks of a text in order; joined they are the text again, empty text has none."""
    return F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0))


def ambiguous_hashes(docs: DataFrame, text: str) -> list[int]:
    """Hashes that stand for more than one chunk content: none in practice."""
    pieces = docs.select(F.explode(chunks(normalised(F.col(text)))).alias("chunk"))
    distinct = pieces.select(F.xxhash64("chunk").alias("hash"), "chunk").distinct()
    clashes = distinct.groupBy("hash").count().filter("count > 1").select("hash")
    found = [r.hash for r in clashes.limit(MAX_AMBIGUOUS + 1).collect()]
    if len(found) > MAX_AMBIGUOUS:
        raise ValueError(f"more than {MAX_AMBIGUOUS} chunk hashes are ambiguous")
    return found


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``key``, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical after every run of white space has become one
    space; null counts as empty. ``keep_id`` is the smallest key of the equal texts and
    ``kept`` says that this row has it. A null key comes after all others: it is kept only
    where all keys of the group are null. Repeated rows with the smallest key are all kept,
    since they are the same document (``unique`` returns it once). An empty table gives no
    rows; other columns are ignored.
    """
    clashes = ambiguous_hashes(docs, text)
    cut = docs.select(F.col(key), normalised(F.col(text)).alias("_text"))
    cut = cut.withColumn("_chunks", chunks(F.col("_text")))
    unclear = F.filter("_chunks", lambda c: F.xxhash64(c).isin(clashes)) if clashes else F.array().cast("array<string>")
    recipes = stage(
        cut.select(
            key,
            F.transform("_chunks", lambda c: F.xxhash64(c)).alias("_recipe"),
            unclear.alias("_unclear"),
            F.sha2("_text", 256).alias("text_sha256"),
        ),
        "recipes",
    )
    found = recipes.groupBy("_recipe", "_unclear").agg(
        F.min(key).alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    found = stage(found, "recipe-groups")
    joined = recipes.join(found, ["_recipe", "_unclear"])
    return joined.select(
        key, "keep_id", "group_size", F.col(key).eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def unique(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, each text once, with the columns of ``docs``.

    Of repeated rows with one key and one text any is returned, and only that case moves
    texts.
    """
    kept = groups(docs, key, text).filter("kept")
    kept = kept.groupBy(F.col(key).alias("id"), F.col("text_sha256").alias("sha"))
    kept = kept.agg(F.count(F.lit(1)).alias("copies"))
    rows = docs.select(
        F.struct("*").alias("row"), F.col(key).alias("row_id"), F.sha2(normalised(F.col(text)), 256).alias("row_sha")
    )
    found = rows.join(kept, F.col("row_id").eqNullSafe(F.col("id")) & (F.col("row_sha") == F.col("sha")))
    once = found.filter("copies = 1").select("row")
    repeated = found.filter("copies > 1").dropDuplicates(["row_id", "row_sha"]).select("row")
    return once.union(repeated).select("row.*")
