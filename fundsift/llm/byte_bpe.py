"""Byte-level BPE encoding and decoding with a rank queue.

All pre-tokens of some texts that are not yet known are laid end to end and merged
together. Adjacent pairs wait, by merge rank, in buckets of linked-list positions; a bitmap
marks the buckets that are not empty, so the lowest ranks are one find-first-set away
whatever the length of a pre-token. Long pre-tokens have a bucket for every rank, and all its
positions merge at once in numpy. Short ones do not touch each other, so their buckets span
a few neighbouring ranks and each pre-token takes its own lowest one. Merging relinks the
neighbours in the doubly linked list of positions; an entry whose position has meanwhile been
merged or has got another rank is stale and skipped.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Rank file and pattern of the tokenizer used unless another one is named.
VOCABULARY = "byte_bpe_multi_50k.tiktoken"

#: Neighbouring merge ranks that share a bucket for short pre-tokens, as a power of two.
BUCKET_BITS = 6

#: Bytes from which a pre-token is long: its ranks have a bucket each.
LONG = 1 << 10

#: Buckets that share a word of the bitmap's lower level, as a power of two.
WORD_BITS = 5

#: Pre-tokens remembered per Python worker, and their longest; twice as many at most are held.
CACHED = 150_000
LONGEST_CACHED = 64

#: Bits of a token id in the key of a pair.
SHIFT = 20

#: Characters of texts, or matches of one very long text, that are handled together.
GROUP = 1 << 19
MATCHES = 200_000


class RankQueue:
    """Positions by merge rank, in buckets; a two-level bitmap finds the lowest bucket."""

    def __init__(self, ranks: int, bits: int):
        self.bits = bits
        buckets = (ranks >> bits) + 1
        self.buckets: list[list[np.ndarray]] = [[] for _ in range(buckets)]
        self.words = [0] * ((buckets >> WORD_BITS) + 1)
        self.summary = 0

    def push(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        which = (ranks >> self.bits).astype(np.uint32)
        order = np.argsort(which, kind="stable")
        which, positions = which[order], positions[order]
        cuts = np.flatnonzero(which[1:] != which[:-1]) + 1
        starts = [0, *cuts.tolist(), len(which)]
        for bucket, start, stop in zip(which[starts[:-1]].tolist(), starts, starts[1:], strict=False):
            self.put(bucket, positions[start:stop])

    def put(self, bucket: int, positions: np.ndarray) -> None:
        self.buckets[bucket].append(positions)
        word = bucket >> WORD_BITS
        self.words[word] |= 1 << (bucket & (1 << WORD_BITS) - 1)
        self.summary |= 1 << word

    def take(self) -> tuple[int, np.ndarray] | None:
        """Remove and return the lowest bucket that has positions."""
        if not self.summary:
            return None
        word = (self.summary & -self.summary).bit_length() - 1
        bits = self.words[word]
        bucket = (word << WORD_BITS) + (bits & -bits).bit_length() - 1
        self.words[word] = bits & bits - 1
        if not self.words[word]:
            self.summary &= self.summary - 1
        held, self.buckets[bucket] = self.buckets[bucket], []
        return bucket, held[0] if len(held) == 1 else np.concatenate(held)


class ByteBpe:
    """One vocabulary: token bytes by rank, and the rank of every pair that merges."""

    def __init__(self, rank_of: dict[bytes, int], pattern: str):
        self.rank_of = rank_of
        ranks = max(rank_of.values()) + 1
        self.bytes_of = [b""] * ranks
        self.ids = list(range(ranks))  # one object per id, which all known pieces share
        for token, rank in rank_of.items():
            self.bytes_of[rank] = token
        pair_rank: dict[int, int] = {}
        #: Ranks whose merge may bring about a pair of lower rank.
        self.falling = np.zeros(ranks, bool)
        for token, rank in rank_of.items():
            for cut in range(1, len(token)):
                left, right = rank_of.get(token[:cut]), rank_of.get(token[cut:])
                if left is not None and right is not None:
                    pair_rank[left << SHIFT | right] = rank
                    for part in (left, right):
                        self.falling[part] |= part > rank
        keys = np.fromiter(pair_rank.keys(), np.int64, len(pair_rank))
        order = np.argsort(keys)
        last = np.iinfo(np.int64).max
        self.pairs = np.append(keys[order], last)
        self.pair_ranks = np.append(np.fromiter(pair_rank.values(), np.int64, len(pair_rank))[order], -1)
        self.byte_rank = np.array([rank_of[bytes([b])] for b in range(256)])
        two = np.arange(1 << 16)
        self.first_rank = self.rank_of_pairs(self.byte_rank[two >> 8], self.byte_rank[two & 255])
        self.pattern = regex.compile(pattern)
        plain = pattern.replace(r"\p{L}\p{N}", "A-Za-z0-9").replace(r"\p{L}+", "[A-Za-z]+").replace(r"\p{N}+", "[0-9]+")
        #: The same pattern for texts in ASCII only.
        self.plain = self.pattern if r"\p" in plain else re.compile(plain, re.ASCII)
        self.few, self.each = RankQueue(ranks, BUCKET_BITS), RankQueue(ranks, 0)
        self.known = Pieces()

    def rank_of_pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of token ids, -1 where they do not merge."""
        keys = left << SHIFT | right
        at = np.searchsorted(self.pairs, keys)
        return np.where(self.pairs[at] == keys, self.pair_ranks[at], -1)

    def _chosen(self, positions: np.ndarray, waiting: np.ndarray, piece: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Which of the sorted positions merge now: of each piece the lowest rank.

        All places with that rank merge at once, of overlapping ones every other from the
        left; only the leftmost merges where a lower rank may follow from it.
        """
        ranks, pieces = waiting[positions], piece[positions]
        starts = np.flatnonzero(np.concatenate([[True], pieces[1:] != pieces[:-1]]))
        lowest = np.minimum.reduceat(ranks, starts)
        sizes = np.diff(np.append(starts, len(positions)))
        found = np.flatnonzero(ranks == np.repeat(lowest, sizes))
        at, owner = positions[found], pieces[found]
        fresh = np.concatenate([[True], owner[1:] != owner[:-1]])
        touching = np.concatenate([[False], after[at[:-1]] == at[1:]])
        if touching.any():
            run = np.maximum.accumulate(np.where(touching, 0, np.arange(len(at))))
            even = (np.arange(len(at)) - run) % 2 == 0
        else:
            even = ~touching
        now = np.zeros(len(positions), bool)
        now[found[np.where(self.falling[ranks[found]], fresh, even)]] = True
        return now

    def _leading(self, at: np.ndarray, rank: int, piece: np.ndarray, token: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Which of the sorted places of one rank merge now: every other one of overlapping ones.

        A place after which a lower rank may follow in its piece is the last that merges there now.
        """
        touching = np.concatenate([[False], after[at[:-1]] == at[1:]])
        run = np.maximum.accumulate(np.where(touching, 0, np.arange(len(at))))
        now = (np.arange(len(at)) - run) % 2 == 0
        if not self.falling[rank]:
            return now
        here = at[now]
        back, beyond = before[here], after[after[here]]
        # The neighbour on the left has just been merged where it ends the place before.
        merged = np.concatenate([[False], after[here[:-1]] == back[1:]]) & (back >= 0)
        left = np.where(merged, rank, token[back])
        low = (back >= 0) & self._falls(left, rank, rank)
        low |= (beyond >= 0) & self._falls(rank, token[beyond], rank)
        if low.any():
            owner = piece[here]
            fresh = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            seen = np.cumsum(low) - low
            keep = seen == np.repeat(seen[fresh], np.diff(np.append(fresh, len(here))))
            now[np.flatnonzero(now)[~keep]] = False
        return now

    def _falls(self, left: np.ndarray | int, right: np.ndarray | int, rank: int) -> np.ndarray:
        found = self.rank_of_pairs(*np.broadcast_arrays(left, right))
        return (found >= 0) & (found < rank)

    def merge(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """Token ids of each piece, every piece merged on its own."""
        long = [k for k, piece in enumerate(pieces) if len(piece) >= LONG]
        if not long or len(long) == len(pieces):
            return self._merge(pieces, self.each if long else self.few)
        found = dict(zip(long, self._merge([pieces[k] for k in long], self.each), strict=True))
        rest = iter(self._merge([piece for piece in pieces if len(piece) < LONG], self.few))
        return [found[k] if k in found else next(rest) for k in range(len(pieces))]

    def _merge(self, pieces: list[bytes], queue: RankQueue) -> list[tuple[int, ...]]:
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        stops = np.cumsum(sizes)
        piece = np.repeat(np.arange(len(pieces)), sizes)
        links = np.arange(len(raw))
        after, before = links + 1, links - 1  # where the neighbours start, or -1
        after[stops - 1] = -1
        before[stops - sizes] = -1
        token = self.byte_rank[raw]  # of the token that starts here
        alive = np.ones(len(raw), bool)
        waiting = np.full(len(raw), -1)  # rank of the pair that starts here, or -1
        waiting[:-1] = self.first_rank[raw[:-1].astype(np.int64) << 8 | raw[1:]]
        waiting[stops - 1] = -1
        pairs = np.flatnonzero(waiting >= 0)
        if len(pairs):
            queue.push(waiting[pairs], pairs)
        while (taken := queue.take()) is not None:
            bucket, positions = taken
            positions = np.sort(positions[waiting[positions] >> queue.bits == bucket])  # the others are stale
            if not len(positions):
                continue
            positions = positions[np.concatenate([[True], positions[1:] != positions[:-1]])]
            if queue.bits:
                now = self._chosen(positions, waiting, piece, after)
            else:
                now = self._leading(positions, bucket, piece, token, before, after)
            if not now.all():
                queue.put(bucket, positions[~now])
            here = positions[now]
            gone = after[here]
            token[here] = waiting[here]
            waiting[gone], alive[gone] = -1, False
            beyond = after[gone]
            after[here] = beyond
            waiting[here] = -1
            left, right = here[beyond >= 0], beyond[beyond >= 0]
            before[right] = left
            back = before[here]
            left = np.concatenate([left, back[back >= 0]])
            right = np.concatenate([right, here[back >= 0]])
            ranks = self.rank_of_pairs(token[left], token[right])
            waiting[left] = ranks
            merging = ranks >= 0
            if merging.any():
                queue.push(ranks[merging], left[merging])
        found = list(map(self.ids.__getitem__, token[alive].tolist()))
        ends = np.cumsum(np.bincount(piece[alive], minlength=len(pieces))).tolist()
        return [tuple(found[start:stop]) for start, stop in zip([0, *ends], ends, strict=False)]

    def split(self, text: str) -> list[str]:
        return (self.plain if text.isascii() else self.pattern).findall(text)

    def learn(self, pieces: Iterable[str]) -> dict[str, tuple[int, ...]]:
        """Ids of pieces that are not in the cache; those of long ones are not put there."""
        rest, found = [], {}
        for piece in pieces:
            if not self.known.revive(piece):
                raw = piece.encode("utf-8")
                if (whole := self.rank_of.get(raw)) is not None:
                    found[piece] = (whole,)
                else:
                    rest.append((piece, raw))
        if rest:
            found.update(zip((p for p, _ in rest), self.merge([r for _, r in rest]), strict=True))
        self.known.update((p, ids) for p, ids in found.items() if len(p) <= LONGEST_CACHED)
        return {p: ids for p, ids in found.items() if len(p) > LONGEST_CACHED}

    def ids_of(self, texts: list[list[str]]) -> Iterator[np.ndarray]:
        """Ids of texts given as lists of pieces."""
        self.known.turn()
        missing: set[str] = set()
        for pieces in texts:
            missing.update(pieces)
        missing.difference_update(self.known)
        long = self.learn(missing)
        ids = self.known.__getitem__ if not long else lambda piece: long[piece] if piece in long else self.known[piece]
        for pieces in texts:
            yield np.fromiter(chain.from_iterable(map(ids, pieces)), np.int32)

    def encode_arrays(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """Ids of each text; short texts are handled together, very long ones in parts."""
        held: list[list[str]] = []
        size = 0
        for text in texts:
            if len(text) > GROUP:
                yield from self.ids_of(held)
                held, size = [], 0
                matches = (m.group() for m in self.pattern.finditer(text))
                parts = iter(lambda matches=matches: list(islice(matches, MATCHES)), [])
                yield np.concatenate([ids for part in parts for ids in self.ids_of([part])])
                continue
            held.append(self.split(text))
            size += len(text)
            if size >= GROUP:
                yield from self.ids_of(held)
                held, size = [], 0
        yield from self.ids_of(held)

    def encode_all(self, texts: Iterable[str]) -> Iterator[list[int]]:
        return (ids.tolist() for ids in self.encode_arrays(texts))

    def encode(self, text: str) -> list[int]:
        return next(self.encode_all([text]))

    def decode(self, ids: np.ndarray | list[int]) -> bytes:
        some = (np.asarray(ids[k : k + MATCHES]).tolist() for k in range(0, len(ids), MATCHES))
        return b"".join(b"".join(map(self.bytes_of.__getitem__, part)) for part in some)


class Pieces(dict):
    """Known pre-tokens in two generations: those unused for a whole generation go."""

    def __init__(self):
        super().__init__()
        self.older: dict[str, tuple[int, ...]] = {}

    def turn(self) -> None:
        if len(self) > CACHED:
            self.older = dict(self)
            self.clear()

    def revive(self, piece: str) -> bool:
        if (ids := self.older.get(piece)) is None:
            return False
        self[piece] = ids
        return True


@lru_cache(maxsize=2)
def load(name: str) -> ByteBpe:
    """The vocabulary file ``name`` of the installed public tokenizers, or a path."""
    import public_tokenizers

    path = name if "/" in name else public_tokenizers.path(name)
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
    return ByteBpe(ranks, public_tokenizers.PATTERN)


def encode(text: Column, vocabulary: str = VOCABULARY) -> Column:
    """Token ids of each whole text, without special tokens, as ``array<int>``.

    Every match of the public pattern is encoded on its own. Null and empty text give an
    empty array. Row by row: repeated rows, ties and other columns do not matter.
    """

    @F.arrow_udf("array<int>")
    def ids_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = load(vocabulary)
        for batch in batches:
            yield _lists(list(bpe.encode_arrays(value.as_py() or "" for value in batch)))

    return ids_of(text)


def decode(ids: Column, vocabulary: str = VOCABULARY) -> Column:
    """The bytes that token ids stand for; null ids give empty bytes."""

    @F.arrow_udf("binary")
    def bytes_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = load(vocabulary)
        for batch in batches:
            yield pa.array([bpe.decode(v.values.to_numpy() if v.is_valid else ()) for v in batch], pa.binary())

    return bytes_of(ids)


def round_trip(text: Column, vocabulary: str = VOCABULARY) -> Column:
    """Struct of ``ids``, as by ``encode``, and ``decoded``, the bytes they stand for.

    Both ways in one pass, so that a worker holds one vocabulary and one cache.
    """

    @F.arrow_udf("ids array<int>, decoded binary")
    def there_and_back(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = load(vocabulary)
        for batch in batches:
            ids = list(bpe.encode_arrays(value.as_py() or "" for value in batch))
            decoded = pa.array((bpe.decode(one) for one in ids), pa.binary())
            yield pa.StructArray.from_arrays([_lists(ids), decoded], ["ids", "decoded"])

    return there_and_back(text)


def _lists(ids: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
    values = np.concatenate(ids) if ids else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))
