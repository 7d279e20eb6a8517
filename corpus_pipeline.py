"""Corpus preparation: documents through five stages, each stored before the next reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundsift.llm import byte_bpe, decontaminate, exact_dedup, language, minhash
from fundsift.llm.common import small_batches, stage, table, whole

#: Words of a shingle in the search for near copies.
SHINGLE = 5

#: Stands for a missing document id, so that it comes after all others.
LAST_ID = (1 << 63) - 1


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Predict every document's language: ``und`` goes, and a missing ``lang`` is filled in.

    The model learns from all rows with a ``lang``. Null texts and texts without a letter are
    ``und``; a document with letters stays whatever its language. Where no row has a ``lang``,
    nothing can be predicted: letters alone decide, and ``lang`` stays null.
    """
    model = language.train(docs)
    if not model.languages:
        return docs.filter(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    rows = docs.select(F.struct("*").alias("row"), language.predict(spark, F.col("text"), model).alias("found"))
    known = rows.filter(F.col("found.lang_pred") != language.UNKNOWN)
    filled = F.coalesce("row.lang", "found.lang_pred").alias("lang")
    return known.select(*[filled if c == "lang" else F.col(f"row.`{c}`") for c in docs.columns])


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the smallest id stays."""
    return exact_dedup.unique(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked near copies, the document with the smallest id stays.

    Rows are told apart by id and text, so missing or repeated ids do not mix documents.
    """
    name = F.struct(F.coalesce("doc_id", F.lit(LAST_ID)).alias("id"), F.sha2(whole(F.col("text")), 256).alias("sha"))
    rows = docs.select(F.struct("*").alias("row"), name.alias("name"), F.col("text"))
    kept = minhash.near_duplicates(rows, key="name", width=SHINGLE).filter("kept").select("name")
    return rows.join(kept, "name", "left_semi").select("row.*")


def drop_benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents with a passage of a benchmark item; the text alone decides."""
    rows = docs.select(F.struct("*").alias("row"), F.sha2(whole(F.col("text")), 256).alias("sha"), F.col("text"))
    found = decontaminate.contaminated(rows, table(spark, sf_dir, "benchmark"), key="sha").select("sha").distinct()
    return rows.join(found, "sha", "left_anti").select("row.*")


def encode_and_decode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Add token_ids, n_tokens, and round_trip: whether the ids decode to the text's bytes.

    Null text counts as empty and has no ids. Columns of these names are replaced.
    """
    small_batches(spark)
    kept = [F.col(f"row.`{c}`") for c in docs.columns if c not in ("token_ids", "n_tokens", "round_trip")]
    rows = docs.select(F.struct("*").alias("row"), byte_bpe.round_trip(F.col("text")).alias("found"))
    same = F.col("found.decoded") == whole(F.col("row.text")).cast("binary")
    return rows.select(*kept, F.col("found.ids").alias("token_ids"), F.size("found.ids").alias("n_tokens"), same.alias("round_trip"))


STAGES = [
    ("language_id", keep_known_languages),
    ("exact_dedup", drop_exact_copies),
    ("minhash_near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark_copies),
    ("byte_bpe", encode_and_decode),
]

#: Signatures, alignments and merges cannot be written as SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
