"""Word-piece counts by greedy longest match, with an automaton that never looks back.

A trie holds the pieces that start a word and, below a second root, those that continue
one. Every trie node has a failure link and the number of pieces that are complete once
the link is followed, both worked out beforehand, so counting a word is one walk over its
bytes; no piece is ever built.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Rank file whose tokens are the pieces, unless another one is named.
VOCABULARY = "byte_bpe_multi_50k.tiktoken"

#: Words remembered per Python worker, and matches handled at a time.
CACHED = 300_000
MATCHES = 200_000

#: What a word counts that cannot be cut into pieces.
UNKNOWN = 1

_NONE = -1


class PieceCounter:
    """The automaton of one vocabulary; texts and pieces are bytes."""

    def __init__(self, starting: Iterable[bytes], continuing: Iterable[bytes]):
        self.next: list[dict[int, int]] = [{}, {}]
        self.whole = [False, False]
        self.root, self.inner = 0, 1
        for root, pieces in ((self.root, starting), (self.inner, continuing)):
            for piece in pieces:
                if piece:
                    self._insert(root, piece)
        self._link()

    def _insert(self, node: int, piece: bytes) -> None:
        for byte in piece:
            if (child := self.next[node].get(byte)) is None:
                child = self.next[node][byte] = len(self.next)
                self.next.append({})
                self.whole.append(False)
            node = child
        self.whole[node] = True

    def _link(self) -> None:
        """Failure links and popped-piece counts, breadth first.

        At a piece's end the piece itself is popped and matching goes on below the second
        root. Elsewhere the parent's pieces are popped, and links are followed, popping
        more, until some node takes the byte.
        """
        size = len(self.next)
        self.fail, self.popped = [_NONE] * size, [0] * size
        level = [self.root, self.inner]
        while level:
            below = []
            for node in level:
                for byte, child in self.next[node].items():
                    below.append(child)
                    if self.whole[child]:
                        self.fail[child], self.popped[child] = self.inner, 1
                        continue
                    at, popped = self.fail[node], self.popped[node]
                    while at != _NONE and byte not in self.next[at]:
                        popped += self.popped[at]
                        at = self.fail[at]
                    if at != _NONE:
                        self.fail[child], self.popped[child] = self.next[at][byte], popped
            level = below

    def count(self, word: bytes) -> int:
        """Pieces of a word, ``UNKNOWN`` if it cannot be cut; an empty word has none."""
        step, fail, popped = self.next, self.fail, self.popped
        node, n = self.root, 0
        for byte in word:
            while (child := step[node].get(byte)) is None:
                n += popped[node]
                node = fail[node]
                if node == _NONE:
                    return UNKNOWN
            node = child
        while node not in (self.root, self.inner):
            n += popped[node]
            node = fail[node]
            if node == _NONE:
                return UNKNOWN
        return n


class _Counts(dict):
    def __init__(self, counter: PieceCounter):
        super().__init__()
        self.counter = counter

    def __missing__(self, word: str) -> int:
        found = self[word] = self.counter.count(word.encode("utf-8", "surrogatepass"))
        return found


@lru_cache(maxsize=2)
def _load(name: str):
    import public_tokenizers

    path = name if "/" in name else public_tokenizers.path(name)
    with open(path, "rb") as lines:
        pieces = [base64.b64decode(line.split()[0]) for line in lines if line.strip()]
    return regex.compile(public_tokenizers.PATTERN), _Counts(PieceCounter(pieces, pieces))


def count_text(text: str | None, pattern, counts: _Counts) -> tuple[int, int]:
    """Words and pieces of a whole text."""
    n_words = n_pieces = 0
    held: list[str] = []

    def flush() -> int:
        if len(counts) > CACHED:
            counts.clear()
        return sum(map(counts.__getitem__, held))

    text = text or ""
    if len(text) <= MATCHES:
        held = pattern.findall(text)
        return len(held), flush()
    for match in pattern.finditer(text):
        held.append(match.group())
        if len(held) == MATCHES:
            n_words, n_pieces = n_words + MATCHES, n_pieces + flush()
            held = []
    return n_words + len(held), n_pieces + flush()


def token_counts(text: Column, vocabulary: str = VOCABULARY) -> Column:
    """Struct of ``n_words`` (matches of the public pattern) and ``n_tokens`` (their pieces).

    Each word is cut greedily into the longest piece of the vocabulary at each place. Null
    and empty text have 0 of both. Row by row: repeated rows, ties and other columns do
    not matter.
    """

    @F.arrow_udf("struct<n_words: long, n_tokens: long>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pattern, counts = _load(vocabulary)
        for batch in batches:
            found = [count_text(t.as_py(), pattern, counts) for t in batch]
            arrays = [pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)]
            yield pa.StructArray.from_arrays(arrays, ["n_words", "n_tokens"])

    return run(text)
