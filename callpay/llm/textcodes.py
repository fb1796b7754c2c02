"""Words of Arrow text columns as 64-bit codes, computed over whole batches.

A code is a polynomial over the word's bytes, mixed; equal words have equal codes. Texts are worked off
in blocks of about a megabyte cut between words, so that memory follows the number of words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 20
_P = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

_BYTES = np.arange(256)
#: ASCII capitals to small letters, other bytes as they are.
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
#: Bytes of words `[^\x20\x09-\x0D]+`; bytes of words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing.
NOT_BLANK = ~((_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13)))
ALPHANUMERIC = (_BYTES >= 128) | ((_BYTES >= 48) & (_BYTES <= 57)) | ((_BYTES >= 97) & (_BYTES <= 122))

_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit codes evenly (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x *= _A
    x ^= x >> np.uint64(27)
    x *= _B
    x ^= x >> np.uint64(31)
    return x


def _power(kind: str, base: np.uint64, n: int) -> np.ndarray:
    if kind not in _powers or len(_powers[kind]) < n:
        steps = np.full(max(n, BLOCK + 1), base, np.uint64)
        steps[0] = 1
        _powers[kind] = np.cumprod(steps)
        if n > 4 * BLOCK:
            return _powers.pop(kind)[:n]
    return _powers[kind][:n]


def batches_of(batch: pa.RecordBatch, column: str = "text", limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes of text each."""
    sizes = np.asarray(pc.binary_length(batch.column(column)).fill_null(0), np.int64)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + limit, "right")))
        yield batch.slice(at, to - at)
        at = to


def word_codes(texts: pa.Array, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all words in order, and the offsets of the texts in them (one more than texts). NULL: no words."""
    plain = texts.fill_null("").cast(pa.large_binary())
    _, offsets, data = plain.buffers()
    offsets = np.frombuffer(offsets, np.int64)[plain.offset : plain.offset + len(plain) + 1]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    codes, starts = [], []
    at = 0
    while at < len(raw):
        to = min(len(raw), at + BLOCK)
        table = is_word[LOWER[raw[at:to]]]
        if to < len(raw):  # cut where no word is cut
            gaps = np.flatnonzero(~table)
            if len(gaps):
                to = at + int(gaps[-1]) + 1
            else:
                step = np.flatnonzero(~is_word[LOWER[raw[to:]]])[:1]
                to = to + int(step[0]) + 1 if len(step) else len(raw)
        c, s = _block(raw[at:to], offsets, at, is_word)
        codes.append(c)
        starts.append(s)
        at = to
    code = np.concatenate(codes) if codes else np.zeros(0, np.uint64)
    start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    return code, np.searchsorted(start, offsets, "left")


def _block(raw: np.ndarray, offsets: np.ndarray, at: int, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = LOWER[raw]
    inside = is_word[low]
    n = len(raw)
    edge = offsets[np.searchsorted(offsets, at, "left") : np.searchsorted(offsets, at + n, "left")] - at
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    opens[edge] = inside[edge]
    closes[:-1] &= ~inside[1:]
    ends = edge[edge > 0] - 1
    closes[ends] = inside[ends]
    first, last = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((low.astype(np.uint64) + np.uint64(1)) * _power("up", _P, n), out=sums[1:])
        code = (sums[last] - sums[first]) * _power("down", _INVERSE, n + 1)[first]
        return mix(code + (last - first).astype(np.uint64) * _B), first + at


def id_codes(ids: pa.Array) -> pa.Array:
    """Mixed codes of integer ids (NULL like 0), for Bloom filters."""
    return pa.array(mix(np.asarray(ids.fill_null(0), np.int64).view(np.uint64) + np.uint64(1)).view(np.int64))


def grams(codes: np.ndarray, k: int) -> np.ndarray:
    """A code for each run of ``k`` words, at its first word; runs past the end are not returned."""
    if len(codes) < k:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = codes[: len(codes) - k + 1].copy()
        for i in range(1, k):
            out = out * _P + codes[i : len(codes) - k + 1 + i]
        return mix(out + np.uint64(k))


def bloom_has(filled: bytes, codes: np.ndarray) -> np.ndarray:
    """Whether mixed codes may be among the keys of ``shared.bloom_bits``."""
    words = np.frombuffer(filled, np.uint64)
    mask = np.uint64(len(words) * 64 - 1)
    found = np.ones(len(codes), bool)
    for s in (codes & mask, (codes >> np.uint64(24)) & mask):
        found &= ((words[s >> np.uint64(6)] >> (s & np.uint64(63))) & np.uint64(1)).astype(bool)
    return found


#: Kinds of bytes, one bit each: capitals, small letters, digits, symbols, exclamation, punctuation, beyond ASCII, other.
KINDS = np.full(256, 128, np.uint8)
KINDS[65:91], KINDS[97:123], KINDS[48:58], KINDS[128:] = 1, 2, 4, 64
KINDS[[ord(c) for c in "#*$%&|<>"]] = 8
KINDS[ord("!")] = 16
KINDS[[ord(c) for c in ".,;:?"]] = 32


def word_masks(texts: pa.Array, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each word, the kinds of bytes it has, and its length in bytes; words as in :func:`word_codes`."""
    plain = texts.fill_null("").cast(pa.large_binary())
    _, offsets, data = plain.buffers()
    offsets = np.frombuffer(offsets, np.int64)[plain.offset : plain.offset + len(plain) + 1]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    inside = np.concatenate([is_word[LOWER[raw]], [False]])
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    opens[offsets] = inside[offsets]
    closes[:-1] &= ~inside[1:]
    ends = offsets[offsets > 0] - 1
    closes[ends] = inside[ends]
    first, last = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    if not len(first):
        return np.zeros(0, np.uint8), np.zeros(0, np.int64)
    kinds = np.concatenate([np.where(inside[:-1], KINDS[raw], 0), [0]]).astype(np.uint8)
    return np.bitwise_or.reduceat(kinds, first), last - first
