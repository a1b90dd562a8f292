"""Vectorised word tables over UTF-8 bytes.

Both word definitions used here only ask about ASCII: every byte of 0x80 and
above belongs to a word. So words can be cut, lower-cased (A-Z) and hashed on
the bytes with numpy, without a Python object per word.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np

#: Bytes handled together; longer texts are cut at word ends, so temporaries stay bounded.
PIECE = 1 << 18

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Word bytes of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` (after lower-casing).
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

#: Word bytes of `[^\x20\x09-\x0D]+`.
NONSPACE = np.ones(256, dtype=bool)
NONSPACE[[0x20, *range(0x09, 0x0E)]] = False

_RNG = np.random.default_rng(20_240_601)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_RNG.integers(1, 2**62)) * 2 + 1
_UNBASE = pow(_BASE, -1, 2**64)
_GRAM = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 2 * PIECE), base, dtype=np.uint64)
        steps[0] = 1
        have = np.cumprod(steps, dtype=np.uint64)
        if len(have) <= 8 * PIECE:
            _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64-bit values."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(32))


@dataclass
class Words:
    """Words of some texts: hash and byte place of each, and where each text's words begin."""

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # len(texts) + 1
    lower: bytes

    def joined(self, a: int, b: int) -> bytes:
        """Words a..b-1, joined by one space."""
        return b" ".join(self.lower[self.start[i] : self.end[i]] for i in range(a, b))


def _one(buf: np.ndarray, isword: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(buf)
    if not n:
        none = np.zeros(0, dtype=np.int64)
        return none.astype(np.uint64), none, none
    inside = np.zeros(n + 2, dtype=np.int8)
    inside[1:-1] = isword[buf]
    step = np.diff(inside)
    start, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTE[buf] * _power(_BASE, n), out=total[1:])
    return mix((total[end] - total[start]) * _power(_UNBASE, n)[start]), start, end


def words(texts: list[bytes], isword: np.ndarray) -> Words:
    """Words of all texts; a newline, a word byte of no table, keeps neighbours apart."""
    raw = b"\n".join(texts)
    lower = LOWER[np.frombuffer(raw, dtype=np.uint8)]
    begin = np.zeros(len(texts) + 1, dtype=np.int64)
    begin[1:] = np.cumsum([len(t) + 1 for t in texts])
    hashes, starts, ends, at = [], [], [], 0
    while at < len(lower):
        to = min(len(lower), at + PIECE)
        while to < len(lower) and isword[lower[to]]:  # up to the end of the word
            gap = np.flatnonzero(~isword[lower[to : to + PIECE]])
            to = to + int(gap[0]) if len(gap) else min(len(lower), to + PIECE)
        h, s, e = _one(lower[at:to], isword)
        hashes.append(h)
        starts.append(s + at)
        ends.append(e + at)
        at = to
    start = np.concatenate(starts) if starts else np.zeros(0, dtype=np.int64)
    return Words(
        np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64),
        start,
        np.concatenate(ends) if ends else start,
        np.searchsorted(start, begin),
        lower.tobytes(),
    )


def pieces(texts: Iterable[str | None], limit: int = PIECE) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of consecutive texts of about `limit` bytes: (index of the first, their UTF-8)."""
    at, held, size = 0, [], 0
    for t in texts:
        b = t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b""
        if held and size + len(b) > limit:
            yield at, held
            at, held, size = at + len(held), [], 0
        held.append(b)
        size += len(b)
    if held:
        yield at, held


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k words; the last k-1 places have none, so the result is shorter."""
    n = max(0, len(h) - k + 1)
    out = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        out += h[j : j + n] * _GRAM[j]
    return mix(out + np.uint64(k))
