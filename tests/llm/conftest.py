from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, word string, n long, _key string, count long"


def odd_texts() -> list[str | None]:
    """Null, empty and blank texts, ties, copies, near copies, shared passages, one long text."""
    dice = random.Random(7)
    names = ["".join(dice.choice("abcdefgh") for _ in range(dice.randint(1, 7))) for _ in range(300)]

    def prose(n: int) -> list[str]:
        return [dice.choice(names) for _ in range(n)]

    base, passage = prose(80), " ".join(prose(60))
    texts: list[str | None] = [None, "", " \t\n", "one", "Two  words", "two words", "1234 !!", "ÀÉ ñandú 東京 \U0001f600"]
    texts += [" ".join(base), " ".join(base), "\n".join(base).upper(), " " + " ".join(base)]
    for k in range(12):
        copy = list(base)
        copy[5 * k] = f"changed{k}"
        texts.append(" ".join(copy))
    for _ in range(10):
        texts.append(" ".join(prose(40)) + " " + passage + " " + " ".join(prose(40)))
    texts += [passage, passage * 3, "a" * 700, "ab" * 400, " ".join(prose(30_000)), "x" * 5000 + " end"]
    texts += [" ".join(prose(dice.randint(1, 120))) for _ in range(40)]
    return texts


@pytest.fixture(scope="session")
def odd_rows() -> list[tuple]:
    """Documents with missing and repeated ids, and columns whose names clash with inner ones."""
    texts = odd_texts()
    rows = [(i, t, "en" if i % 2 else "fr", "s" if i % 3 else None, None, "k", "w", 1, "x", 2) for i, t in enumerate(texts)]
    return [*rows, rows[8], rows[8], (None, texts[8], None, "s", 1, None, None, None, None, None), (None, "only without an id here", None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("odd") / "documents.parquet")
    spark.createDataFrame(odd_rows, SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
