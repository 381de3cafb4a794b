"""Vectorised word scanning: numpy over code points instead of loops over words.

A word is a maximal run of letters, digits and underscores; its hash is taken
from the lower-cased code points and is the same on every machine.
"""

from __future__ import annotations

from functools import cache

import numpy as np

U64 = np.uint64
#: Code points handled at a time; longer texts are cut between words.
PIECE = 1 << 20
#: Planes above this hold ideographs and symbols: word characters without case.
TABLE = 0x20000
_R = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


@cache
def char_tables() -> tuple[np.ndarray, np.ndarray]:
    """Lower-case code point and word-character flag, by code point."""
    lower, word = np.arange(TABLE, dtype=np.uint32), np.zeros(TABLE, dtype=bool)
    for i in range(TABLE):
        c = chr(i)
        if len(low := c.lower()) == 1:
            lower[i] = ord(low)
        word[i] = c.isalnum() or c == "_"
    return lower, word


@cache
def _powers() -> list[np.ndarray]:
    return [np.ones(1, dtype=U64), np.ones(1, dtype=U64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """R**i and R**-i modulo 2**64 for i < n."""
    held = _powers()
    if len(held[0]) < n:
        size = max(n, PIECE + 65536)
        inverse = pow(_R, -1, 1 << 64)
        for k, base in enumerate((_R, inverse)):
            steps = np.full(size, U64(base), dtype=U64)
            steps[0] = 1
            held[k] = np.multiply.accumulate(steps)
    return held[0][:n], held[1][:n]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def lower_and_kind(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points and which of them are word characters."""
    lower, word = char_tables()
    if points.size and int(points.max()) >= TABLE:
        far = points >= TABLE
        near = np.where(far, 0, points)
        return np.where(far, points, lower[near]), word[near] | far
    return lower[points], word[points]


def _scan(piece: str, prefix_of: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends of the words of a piece; with prefix_of, hashes of so many first letters."""
    points, word = lower_and_kind(code_points(piece))
    n = len(points)
    edge = np.flatnonzero(np.diff(np.concatenate(([False], word, [False])).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    up, down = powers(n + 1)
    prefix = np.zeros(n + 1, dtype=U64)
    np.cumsum((points.astype(U64) + U64(0x51ED270B)) * up[:n], out=prefix[1:])
    upto = np.minimum(ends, starts + prefix_of) if prefix_of else ends
    return mix((prefix[upto] - prefix[starts]) * down[starts] + U64(0x632BE59BD9B4E019)), starts, ends


def _cut(text: str) -> list[str]:
    """Pieces of about PIECE characters, cut where a word ends (a longer word stays whole)."""
    out, at = [], 0
    while len(text) - at > PIECE:
        end = at + PIECE
        while end < len(text) and (text[end - 1].isalnum() or text[end - 1] == "_") and (text[end].isalnum() or text[end] == "_"):
            end += 1
        out.append(text[at:end])
        at = end
    out.append(text[at:])
    return out


def words(texts: list[str], prefix_of: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, and the bounds of each text in them (one more than there are texts).

    With prefix_of, words of the same first letters have the same hash.
    """
    hashes, counts = [], np.zeros(len(texts) + 1, dtype=np.int64)
    at = 0
    while at < len(texts):
        if len(texts[at]) > PIECE:
            parts = [_scan(x, prefix_of)[0] for x in _cut(texts[at])]
            hashes += parts
            counts[at + 1] = sum(map(len, parts))
            at += 1
            continue
        end, size = at, 0
        while end < len(texts) and size + len(texts[end]) <= PIECE:
            size += len(texts[end]) + 1
            end += 1
        found, starts, _ = _scan("\n".join(texts[at:end]), prefix_of)
        begins = np.cumsum([0, *(len(x) + 1 for x in texts[at:end])])
        hashes.append(found)
        counts[at + 1 : end + 1] = np.diff(np.searchsorted(starts, begins))
        at = end
    return (np.concatenate(hashes) if hashes else np.zeros(0, dtype=U64)), np.cumsum(counts)


def owners(bounds: np.ndarray) -> np.ndarray:
    """For each position the number of the text that holds it."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def shingles(hashes: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words, with bounds by text.

    A text of fewer words has one shingle, of all its words; one without words has none.
    """
    counts = np.diff(bounds)
    n = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    out_bounds = np.concatenate(([0], np.cumsum(n)))
    total = int(out_bounds[-1])
    first = np.arange(total) - np.repeat(out_bounds[:-1] - bounds[:-1], n)
    last = np.minimum(first + width, np.repeat(bounds[1:], n))
    acc = np.zeros(total, dtype=U64)
    factor = 1
    for k in range(width):
        factor = factor * 0xD1342543DE82EF95 + 1 & (1 << 64) - 1
        at = first + k
        if (inside := at < last).all():
            acc += hashes[at] * U64(factor)
        else:
            acc[inside] += hashes[at[inside]] * U64(factor)
    return mix(acc + (last - first).astype(U64)), out_bounds


def sequence_keys(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit keys of each text's word sequence."""
    n = len(hashes)
    place = np.arange(n) - np.repeat(bounds[:-1], np.diff(bounds))
    out = []
    for salt in (0x2545F4914F6CDD1D, 0x9FB21C651E98DF25):
        each = mix(hashes + mix((place + 1).astype(U64) * U64(salt)))
        prefix = np.concatenate((np.zeros(1, dtype=U64), np.cumsum(each, dtype=U64)))
        out.append(mix(prefix[bounds[1:]] - prefix[bounds[:-1]] + np.diff(bounds).astype(U64) * U64(salt)))
    return out[0], out[1]
