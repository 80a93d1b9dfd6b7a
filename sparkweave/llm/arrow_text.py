"""Whole texts as bytes: vectorised word hashing over Arrow columns, with bounded working memory."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 19  # bytes of text worked on at once

U = np.uint64
_TABLE = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
_TABLE[65:91] = _TABLE[97:123]  # A-Z count as a-z
WORD_BYTE = np.ones(256, dtype=bool)
WORD_BYTE[[9, 10, 11, 12, 13, 32]] = False
_BASE = 0x9E3779B97F4A7C15 | 1
#: Odd 64-bit numbers for hash families.
PLACE = np.random.default_rng(21).integers(1, 2**63, 64, dtype=np.uint64) * U(2) + U(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


#: Powers already computed by this worker, by name and number; plain values, so functions that use them can travel.
_KEPT: dict[tuple[str, int], tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if ("wide", n) not in _KEPT:
        up, down = np.full(n, _BASE, dtype=np.uint64), np.full(n, pow(_BASE, -1, 2**64), dtype=np.uint64)
        up[:1] = down[:1] = 1
        _KEPT["wide", n] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _KEPT["wide", n]


# -- word hashes: polynomials modulo a prime, so no two words of a structure agree for every base

PRIME = (1 << 61) - 1
PRIME_BASE = 0x1D2F5A7C3B9E6481 % PRIME
_CODE = np.arange(1, 257, dtype=np.uint64)
_CODE[65:91] = _CODE[97:123]  # A-Z count as a-z
_LOW31, _LOW30, _P = U((1 << 31) - 1), U((1 << 30) - 1), U(PRIME)


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & _P) + (x >> U(61))
    return np.where(x >= _P, x - _P, x)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo ``PRIME`` of values below it, by halves of 31 bits."""
    ah, al, bh, bl = a >> U(31), a & _LOW31, b >> U(31), b & _LOW31
    middle, low = ah * bl + al * bh, al * bl
    return _reduced(U(2) * (ah * bh) + (middle >> U(30)) + ((middle & _LOW30) << U(31)) + (low & _P) + (low >> U(61)))


def _prime_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo ``PRIME``."""
    if ("prime", n) not in _KEPT:
        both = []
        for base in (PRIME_BASE, pow(PRIME_BASE, -1, PRIME)):
            out = np.ones(n, dtype=np.uint64)
            k = 1
            while k < n:  # doubling: the second half is the first one times a power
                m = min(k, n - k)
                out[k : k + m] = _times(out[:m], np.full(m, pow(base, k, PRIME), dtype=np.uint64))
                k += m
            both.append(out)
        _KEPT["prime", n] = both[0], both[1]
    return _KEPT["prime", n]


def span_values(buf: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The polynomial of the bytes of each span modulo ``PRIME``, A-Z as a-z; the buffer has ``CHUNK`` bytes at most.

    Both halves of the powers are summed without a reduction: a code is at most 2**8, a half below 2**31, and there are
    at most 2**20 bytes, so sums stay below 2**60. Only spans, not bytes, are reduced.
    """
    n = len(buf)
    up, down = _prime_powers(1 << max(n, 1).bit_length())
    code = _CODE[buf]
    high, low = np.zeros(n + 1, dtype=np.uint64), np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(code * (up[:n] >> U(31)), out=high[1:])
    np.cumsum(code * (up[:n] & _LOW31), out=low[1:])
    h, x = high[ends] - high[begins], low[ends] - low[begins]
    return _times(_reduced((h >> U(30)) + ((h & _LOW30) << U(31)) + x), down[begins])


def word_hash(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return mix(values + lengths.astype(np.uint64) * PLACE[40])


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and where each text begins (one more entry than texts); null counts as empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, at, data = texts.buffers()
    at = np.frombuffer(at, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, dtype=np.int64)
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)), at


def chunks(at: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``CHUNK`` bytes together; a longer text is alone."""
    i, n = 0, len(at) - 1
    while i < n:
        j = min(max(i + 1, int(np.searchsorted(at, at[i] + CHUNK, side="right")) - 1), n)
        yield i, j
        i = j


def word_bounds(buf: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of every word; ``first`` holds the beginnings of the texts in the buffer, which part words."""
    inside = WORD_BYTE[buf]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    at = first[(first > 0) & (first < len(buf))]
    begins[at] = inside[at]
    ends[at - 1] = inside[at - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def running_hash(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``run, down``: ``(run[e] - run[b]) * down[b]`` is the polynomial hash of bytes ``b`` to ``e``, A-Z as a-z."""
    n = len(buf)
    up, down = _powers(max(CHUNK, 1 << max(n - 1, 1).bit_length()))
    run = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_TABLE[buf] * up[:n], out=run[1:])
    return run, down


def hash_words(buf: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a buffer, and for each entry of ``first`` the number of words before it."""
    begins, ends = word_bounds(buf, first)
    return word_hash(span_values(buf, begins, ends), ends - begins), np.searchsorted(begins, first)


def _long_word(buf: np.ndarray) -> np.ndarray:
    """The hash of one word of any length: its polynomial is summed over pieces."""
    total = 0
    for at in range(0, len(buf), CHUNK):
        piece = buf[at : at + CHUNK]
        value = span_values(piece, np.zeros(1, dtype=np.int64), np.array([len(piece)]))[0]
        total = (total + int(value) * pow(PRIME_BASE, at, PRIME)) % PRIME
    return word_hash(np.array([total], dtype=np.uint64), np.array([len(buf)]))


def _long_text(buf: np.ndarray) -> np.ndarray:
    """Word hashes of one text of any length, in pieces that end between words."""
    out, at = [], 0
    while at < len(buf):
        end = min(at + CHUNK, len(buf))
        if end < len(buf):
            gaps = np.flatnonzero(~WORD_BYTE[buf[at:end]])
            if not len(gaps):  # one word of a chunk or more
                while end < len(buf):
                    gaps = np.flatnonzero(~WORD_BYTE[buf[end : end + CHUNK]])
                    end += int(gaps[0]) if len(gaps) else min(CHUNK, len(buf) - end)
                    if len(gaps):
                        break
                out.append(_long_word(buf[at:end]))
                at = end
                continue
            end = at + int(gaps[-1]) + 1
        out.append(hash_words(buf[at:end], np.zeros(1, dtype=np.int64))[0])
        at = end
    return np.concatenate(out) if out else np.empty(0, dtype=np.uint64)


def each_words(texts: pa.Array) -> Iterator[np.ndarray]:
    """The word hashes of each text of an Arrow column, in order."""
    data, at = text_bytes(texts)
    for i, j in chunks(at):
        buf = data[at[i] : at[j]]
        if j == i + 1 and len(buf) > CHUNK:
            yield _long_text(buf)
        elif not len(buf):
            yield from (np.empty(0, dtype=np.uint64) for _ in range(j - i))
        else:
            words, before = hash_words(buf, at[i : j + 1] - at[i])
            for k in range(j - i):
                yield words[before[k] : before[k + 1]]


def word_counts(texts: pa.Array) -> np.ndarray:
    """Number of words of each text."""
    data, at = text_bytes(texts)
    out = np.zeros(len(texts), dtype=np.int64)
    for i, j in chunks(at):
        lead = False  # does a word reach over from the piece before
        for lo in range(int(at[i]), max(int(at[j]), int(at[i]) + 1), 4 * CHUNK):
            buf = data[lo : min(lo + 4 * CHUNK, int(at[j]))]
            if not len(buf):
                continue
            first = at[i : j + 1] - lo
            begins, _ = word_bounds(buf, first)
            counts = np.diff(np.searchsorted(begins, first))
            if lead and WORD_BYTE[buf[0]] and j == i + 1:
                counts[0] -= 1
            out[i:j] += counts
            lead = bool(WORD_BYTE[buf[-1]])
    return out
