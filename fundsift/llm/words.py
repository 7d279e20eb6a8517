"""Words of a text as numbers, chunk by chunk, for tasks that work on word shingles."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import xxhash

#: Bytes or characters split into words at a time, and words remembered per Python worker.
CHUNK = 1 << 20
REMEMBERED = 300_000

_SPACE = re.compile(rb"[\x20\x09-\x0d]")
_OTHER = re.compile(r"\W")

#: Bytes in lower case: A-Z only.
LOWER = bytes(range(256)).lower()

#: The same for texts that are ASCII only, with all but letters, digits and underscores as spaces.
_PLAIN = bytes(b if chr(b).isalnum() or b == ord("_") else ord(" ") for b in LOWER[:128]) + b" " * 128

#: Code points of scripts written without spaces, where each character is a word: Thai to
#: Lao, Myanmar, Khmer, kana, and Han with its extensions.
_ALONE = [(0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3005, 0x3007), (0x3021, 0x3029), (0x3040, 0x30FF), (0x31F0, 0x31FF),
          (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9D), (0x1B000, 0x1B16F), (0x20000, 0x323AF)]


@cache
def _kinds() -> np.ndarray:
    """By code point: 0 between words, 1 in a word, 2 a word of its own."""
    kinds = np.fromiter((chr(c).isalnum() or c == ord("_") for c in range(0x110000)), np.uint8, 0x110000)
    for first, last in _ALONE:
        kinds[first : last + 1] *= 2
    return kinds


def _spaced(text: str) -> bytes:
    """Words of any script in lower case, with spaces between them."""
    if text.isascii():
        return text.encode().translate(_PLAIN)
    points = np.frombuffer(text.casefold().encode("utf-32-le", "surrogatepass"), "<u4")
    kinds = _kinds()[points]
    points = np.where(kinds > 0, points, np.uint32(ord(" ")))
    alone = kinds == 2
    if alone.any():
        at = np.flatnonzero(alone)
        points = np.insert(points, np.concatenate([at, at + 1]), ord(" "))
    return points.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")


def _pieces(raw: bytes) -> Iterator[bytes]:
    start = 0
    while start < len(raw):
        gap = _SPACE.search(raw, start + CHUNK)
        stop = gap.start() if gap else len(raw)
        yield raw[start:stop]
        start = stop


def _split(raw: bytes) -> Iterator[list[bytes]]:
    for piece in _pieces(raw):
        if found := piece.split():
            yield found


def lowered(text: str | None) -> Iterator[bytes]:
    """A whole text in UTF-8 and lower case (A-Z), cut between words into pieces of bounded size."""
    return _pieces((text or "").encode("utf-8", "surrogatepass").translate(LOWER))


def words(text: str | None) -> Iterator[list[bytes]]:
    """Lower-cased (A-Z) words of a whole text in UTF-8, some at a time; no chunk is empty."""
    return _split((text or "").encode("utf-8", "surrogatepass").translate(LOWER))


def plain_words(text: str | None) -> Iterator[list[bytes]]:
    r"""Words (``\w+``) of a whole text without regard to case, some at a time; no chunk is empty.

    Of scripts without spaces each character is a word.
    """
    text = text or ""
    start = 0
    while start < len(text):
        gap = _OTHER.search(text, start + CHUNK)
        stop = gap.start() if gap else len(text)
        yield from _split(_spaced(text[start:stop]))
        start = stop


class WordIds(dict):
    """64-bit numbers of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found

    def of(self, found: list[bytes]) -> np.ndarray:
        if len(self) > REMEMBERED:
            self.clear()
        return np.fromiter(map(self.__getitem__, found), np.uint64, len(found))


_GAP = np.isin(np.arange(256), list(b"\x20\x09\x0a\x0b\x0c\x0d"))
_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
)


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def word_hashes(raw: bytes, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of UTF-8 text begin, and XXH64 of each, as Spark's ``xxhash64`` has it.

    Words of a length below 32 bytes are hashed together; nothing is remembered, so new words cost no more.
    """
    gap = np.concatenate([[True], _GAP[np.frombuffer(raw, np.uint8)], [True]])
    edges = np.flatnonzero(gap[1:] != gap[:-1])
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    padded = raw + bytes(8)
    ones = np.frombuffer(padded, np.uint8)
    fours = np.ndarray(len(raw), "<u4", padded, strides=(1,))
    eights = np.ndarray(len(raw), "<u8", padded, strides=(1,))
    found = np.empty(len(starts), np.uint64)
    kinds = np.minimum(lengths, 32).astype(np.uint8)
    order = np.argsort(kinds, kind="stable")
    ends = np.cumsum(np.bincount(kinds, minlength=33))
    for n in range(1, 32):
        some = order[ends[n - 1] : ends[n]]
        if not len(some):
            continue
        at = starts[some]
        h = np.full(len(some), np.uint64((seed + int(_P5) + n) % (1 << 64)))
        for _ in range(n // 8):
            h = _turned(h ^ (_turned(eights[at] * _P2, 31) * _P1), 27) * _P1 + _P4
            at = at + 8
        if n % 8 >= 4:
            h = _turned(h ^ (fours[at] * _P1), 23) * _P2 + _P3
            at = at + 4
        for _ in range(n % 4):
            h = _turned(h ^ (ones[at] * _P5), 11) * _P1
            at = at + 1
        h = (h ^ (h >> np.uint64(33))) * _P2
        h = (h ^ (h >> np.uint64(29))) * _P3
        found[some] = h ^ (h >> np.uint64(32))
    for k in order[ends[31] :].tolist():
        found[k] = xxhash.xxh64_intdigest(raw[starts[k] : starts[k] + lengths[k]], seed)
    return starts, found


def scramble(x: np.ndarray) -> np.ndarray:
    """A one-to-one mix of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(ids: np.ndarray, n: int) -> np.ndarray:
    """Numbers of all runs of ``n`` words, in order; none if there are fewer words."""
    if len(ids) < n:
        return np.empty(0, np.uint64)
    mixed = ids[: len(ids) - n + 1]
    for k in range(1, n):
        mixed = scramble(mixed) + ids[k : len(ids) - n + 1 + k]
    return scramble(mixed)
