"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundsift.llm.common import stage

#: Hash buckets of n-grams, and the longest n-gram in characters.
BUCKETS = 1 << 15
LONGEST = 3

#: Cells (languages x buckets) of one block of a model: 64 MB of float32 to broadcast.
MAX_CELLS = 1 << 24

#: Characters hashed at a time, and languages whose counts one task holds before it passes them on.
CHUNK = 1 << 20
HELD = 64

UNKNOWN = "und"


class Model(NamedTuple):
    languages: list[str]
    #: log P(bucket | language), one row per bucket.
    log_p: np.ndarray
    log_prior: np.ndarray
    #: Blocks of further languages, in alphabetical order, where one block cannot hold all.
    more: tuple[Model, ...] = ()


def buckets_of(text: str) -> Iterator[np.ndarray]:
    """Buckets of all character n-grams of the lower-cased text, chunk by chunk."""
    for start in range(0, len(text), CHUNK):
        lead = text[max(0, start - LONGEST + 1) : start].lower()
        part = lead + text[start : start + CHUNK].lower()
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        mixed, found = np.zeros(len(codes) + 1, np.uint32), []
        for n in range(1, LONGEST + 1):
            if len(codes) < n:
                break
            mixed = (mixed[: len(codes) - n + 1] * np.uint32(0x01000193)) ^ codes[n - 1 :]
            spread = (mixed + np.uint32(n)) * np.uint32(2654435761)
            # Those that end in the lead belong to the chunk before.
            found.append(spread[max(0, len(lead) - n + 1) :] >> np.uint32(32 - BUCKETS.bit_length() + 1))
        if found:
            yield np.concatenate(found)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    docs: dict[str, int] = {}

    def rows() -> Iterator[pa.RecordBatch]:
        for lang, n in counts.items():
            used = np.flatnonzero(n)
            # bucket -1 has the number of documents
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * (len(used) + 1)),
                    pa.array(np.append(used, -1).astype(np.int32)),
                    pa.array(np.append(n[used], docs[lang]).astype(np.int64)),
                ],
                ["lang", "bucket", "n"],
            )

    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
            if lang not in counts:
                if len(counts) >= HELD:
                    yield from rows()
                    counts, docs = {}, {}
                counts[lang] = np.zeros(BUCKETS, np.int64)
                docs[lang] = 0
            docs[lang] += 1
            for found in buckets_of(text or ""):
                counts[lang] += np.bincount(found, minlength=BUCKETS)
    yield from rows()


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", smoothing: float = 0.5) -> Model:
    """Count n-grams per language over every labelled row and smooth them.

    Rows without a language are skipped, null text counts as empty. Tasks count in dense
    vectors and send a row per used bucket, so a hot language is summed before it is
    shuffled. Languages are taken in blocks of at most ``MAX_CELLS`` numbers, one after another:
    512 as a rule, so that more than one block is rare. No labelled row gives a model without languages.
    """
    rows = labelled.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    counted = rows.filter("lang IS NOT NULL").mapInArrow(_count, "lang string, bucket int, n long")
    summed = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    summed = stage(summed, "language-counts")
    docs = {r.lang: r.n for r in summed.filter("bucket = -1").select("lang", "n").collect()}
    languages, most = sorted(docs), max(MAX_CELLS // BUCKETS, 1)
    blocks = [_block(summed, languages[k : k + most], docs, smoothing) for k in range(0, max(len(languages), 1), most)]
    return blocks[0]._replace(more=tuple(blocks[1:]))


def _block(summed: DataFrame, languages: list[str], docs: dict[str, int], smoothing: float) -> Model:
    counts = np.full((BUCKETS, len(languages)), smoothing)
    if languages:
        inside = F.col("lang").between(languages[0], languages[-1])
        found = summed.filter(inside & (F.col("bucket") >= 0)).toPandas()
        place = {name: k for k, name in enumerate(languages)}
        counts[found["bucket"].to_numpy(), found["lang"].map(place).to_numpy(np.int64)] += found["n"].to_numpy(np.float64)
    log_p = np.log(counts) - np.log(counts.sum(axis=0))
    rates = np.array([docs[name] for name in languages], np.float64) / max(sum(docs.values()), 1)
    return Model(languages, log_p.astype(np.float32), np.log(rates))


def _joint(model: Model, text: str | None) -> tuple[str, float, float]:
    """The best language of a block, and the logs of its joint probability with the text and of the block's sum."""
    if not text or not model.languages or not any(map(str.isalpha, text)):
        return UNKNOWN, 0.0, 0.0
    total = model.log_prior.copy()
    for found in buckets_of(text):
        total += model.log_p[found].sum(axis=0, dtype=np.float64)
    best = int(total.argmax())
    return model.languages[best], float(total[best]), float(total[best] + np.log(np.exp(total - total[best]).sum()))


def _predict_one(model: Model, text: str | None) -> tuple[str, float]:
    name, best, whole = _joint(model, text)
    return name, float(np.exp(best - whole)) if name != UNKNOWN else 0.0


def predict(spark: SparkSession, text: Column, model: Model) -> Column:
    """Struct of ``lang_pred`` and ``score``, the posterior of the predicted language.

    Null text, text without a letter, and any text if nothing was learned, give ``und``
    and 0. Ties go to the first language in alphabetical order.
    """
    parts = [_in_block(spark, text, block) for block in (model._replace(more=()), *model.more)]
    best = parts[0]
    for part in parts[1:]:
        best = F.when(part["best"] > best["best"], part).otherwise(best)
    shares = reduce(lambda a, b: a + b, [F.exp(part["whole"] - best["best"]) for part in parts])
    score = F.when(best["lang_pred"] == UNKNOWN, 0.0).otherwise(1 / shares)
    return F.struct(best["lang_pred"].alias("lang_pred"), score.alias("score"))


def _in_block(spark: SparkSession, text: Column, block: Model) -> Column:
    shared = spark.sparkContext.broadcast(block)

    @F.arrow_udf("struct<lang_pred: string, best: double, whole: double>")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = list(zip(*(_joint(shared.value, t.as_py()) for t in batch), strict=True)) or [(), (), ()]
            kinds = (pa.string(), pa.float64(), pa.float64())
            yield pa.StructArray.from_arrays([pa.array(f, k) for f, k in zip(found, kinds, strict=True)], ["lang_pred", "best", "whole"])

    return scored(text)
