"""Words of whole texts as numpy arrays, for use inside Spark tasks.

A batch of texts is cut into pieces of about ``PIECE`` bytes, so what a task holds beside its
Arrow batch stays small whatever the batch; one longer text is a piece of its own.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

PIECE = 1 << 18

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2^64
_INVERSE = pow(_BASE, -1, 1 << 64)

#: Bytes that part words under the contract ``[^\x20\x09-\x0D]+``. All are ASCII, so cutting
#: UTF-8 bytes there gives the words that the pattern gives on characters.
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True

#: Bytes that part words of letters and digits in ``plain`` texts, where all others are of letters.
PUNCTUATION = np.ones(256, bool)
PUNCTUATION[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on every input bit."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_CODES = mix(np.arange(1, 257, dtype=U64))
_powers = [np.ones(1, U64), np.ones(1, U64)]


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, PIECE)
        for i, base in enumerate((_BASE, _INVERSE)):
            table = np.full(size, base, U64)
            table[0] = 1
            _powers[i] = np.multiply.accumulate(table)
    return _powers[0][:n], _powers[1][:n]


class Words(NamedTuple):
    """Words of some texts: byte ``data``, word i is ``data[start[i]:end[i]]``, and the words
    of text t are ``first[t]`` up to ``first[t + 1]``; its bytes begin at ``offset[t]``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    offset: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def split_words(texts: list[bytes], parting: np.ndarray = SPACES) -> Words:
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    apart = parting[data].view(np.int8)
    edge = np.diff(apart, prepend=np.int8(1))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    offset = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=offset[1:])
    return Words(data, start, end, np.searchsorted(start, offset), offset)


def word_hashes(words: Words) -> np.ndarray:
    """A 64-bit hash of each word, the same for equal words in any text."""
    out = np.empty(len(words.start), U64)
    lo = 0
    while lo < len(out):
        # Blocks of whole words bound the memory of a very long text.
        base = words.start[lo]
        hi = max(lo + 1, int(np.searchsorted(words.end, base + PIECE, "right")))
        up, down = _powers_to(int(words.end[hi - 1] - base) + 1)
        prefix = np.zeros(len(up), U64)
        codes = _CODES[words.data[base : words.end[hi - 1]]]
        codes *= up[:-1]
        np.cumsum(codes, out=prefix[1:])
        start, end = words.start[lo:hi] - base, words.end[lo:hi] - base
        out[lo:hi] = (prefix[end] - prefix[start]) * down[start]
        lo = hi
    return mix(out)


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each ``size`` consecutive entries; empty if there are fewer."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, U64)
    out = hashes[:n].copy()
    for i in range(1, size):
        out *= U64(_BASE)
        out += hashes[i : i + n]
    return mix(out)


# Characters that part no words and are seen by no reader: soft hyphens, joiners, marks of order.
_UNSEEN = dict.fromkeys([0xAD, *range(0x200B, 0x2010), 0x2060, 0xFEFF])
# All but letters and digits of any alphabet, and ends of lines.
_APART = re.compile(r"[^\w\n]|_")


def plain(text: str | None) -> bytes:
    """The text in lower case, for cutting into words at ``PUNCTUATION``.

    Words are runs of letters and digits of any alphabet. Forms of one character (full width,
    ligatures, composed or not) are made alike, and other punctuation and spaces become blanks.
    """
    text = (text or "").lower()
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text.translate(_UNSEEN)).lower()
        text = _APART.sub(" ", text)
    return text.encode("utf-8", "replace")


def encoded(column: pa.Array | pa.ChunkedArray, lower: bool = False) -> list[bytes]:
    """The texts as UTF-8, or ``plain``; a null is an empty text."""
    if lower:
        return [plain(t) for t in column.to_pylist()]
    return [b if b is not None else b"" for b in column.cast(pa.binary()).to_pylist()]


def pieces(sizes: Iterable[int], limit: int = PIECE) -> Iterator[slice]:
    """Slices over texts of the given sizes, each of at most ``limit`` bytes or of one text."""
    lo = total = 0
    hi = -1
    for hi, size in enumerate(sizes):
        if total and total + size > limit:
            yield slice(lo, hi)
            lo, total = hi, 0
        total += size + 1
    if hi >= 0:
        yield slice(lo, hi + 1)


def per_piece(
    work: Callable[[pa.RecordBatch], pa.RecordBatch | None], text: str = "text"
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For ``mapInArrow``: ``work`` over slices of each batch, cut by the size of ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pa.compute.binary_length(batch.column(text).cast(pa.binary()))
            for part in pieces(sizes.fill_null(0).to_pylist()):
                out = work(batch.slice(part.start, part.stop - part.start))
                if out is not None and out.num_rows:
                    yield out

    return run
