"""Word hashes and packed rows for operators that compare word sequences.

Words are runs of bytes other than blanks (``[^\\x20\\x09-\\x0D]+`` in UTF-8).
Hashes are polynomials modulo 2**64: of words over prefix sums of a slice of
bytes, of windows of words by doubling, so that no table grows with the text."""

from __future__ import annotations

import numpy as np

#: Bytes hashed together.
BYTES_AT_ONCE = 1 << 18
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


#: Powers kept by a Python worker for a base (8 MB with their inverses); longer
#: inputs (a word beyond a slice) compute their own.
KEPT_POWERS = 1 << 19
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64, for n values of i at least."""
    kept = _POWERS.get(base)
    if kept is not None and len(kept[0]) >= n:
        return kept
    size = 1 << max(16, int(n).bit_length())
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.full(size, b, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p))
    if size <= KEPT_POWERS:
        _POWERS[base] = (out[0], out[1])
    return out[0], out[1]


def prefix_sums(values: np.ndarray, base: int) -> np.ndarray:
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values.astype(np.uint64) * powers(base, len(values))[0][:len(values)], out=out[1:])
    return out


def between(sums: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Hash of the values in [start, end), the same wherever they stand."""
    return (sums[end] - sums[start]) * powers(base, len(sums))[1][start]


def window_hash(values: np.ndarray, k: int, base: int) -> np.ndarray:
    """Hash of the k values from each place on, as ``between`` gives it."""
    n = len(values) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, covered = np.zeros(n, np.uint64), 0
    run, length = values.astype(np.uint64), 1  # runs of ``length`` values
    while True:
        if k & length:
            out += run[covered:covered + n] * np.uint64(pow(base, covered, 1 << 64))
            covered += length
        if covered == k:
            return out
        run = run[:-length] + run[length:] * np.uint64(pow(base, length, 1 << 64))
        length *= 2


class Words:
    """Words of several texts: hash, text, and bytes span of each word."""

    def __init__(self, texts: list[str], lower: bool = False):
        encoded = [t.encode("utf-8", "surrogatepass") for t in texts]
        joined = b"\n".join(encoded) + b"\n"
        self.raw = joined
        data = np.frombuffer(joined, np.uint8)
        found = [self._scan(data[a:b], a, lower) for a, b in self._cuts(data)]
        self.start, self.end, self.hash = (np.concatenate(x) for x in zip(*found))
        text_start = np.cumsum([0] + [len(e) + 1 for e in encoded])
        self.first = np.searchsorted(self.start, text_start)  # first word of each text, and the total
        self.n = np.diff(self.first)
        self.text = np.repeat(np.arange(len(texts), dtype=np.int32), self.n)
        self.place = (np.arange(len(self.start)) - np.repeat(self.first[:-1], self.n)).astype(np.int32)  # of a word in its text

    @staticmethod
    def _cuts(data: np.ndarray):
        """Ranges of about ``BYTES_AT_ONCE`` bytes that end after a separator."""
        at = 0
        while at < len(data):
            end = min(at + BYTES_AT_ONCE, len(data))
            while end < len(data) and not _SEPARATOR[data[end - 1]]:
                after = np.flatnonzero(_SEPARATOR[data[end:end + BYTES_AT_ONCE]])
                end = end + int(after[0]) + 1 if len(after) else min(end + BYTES_AT_ONCE, len(data))
            yield at, end
            at = end

    @staticmethod
    def _scan(data: np.ndarray, base: int, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        inside = ~_SEPARATOR[data]
        edge = np.diff(inside.astype(np.int8), prepend=0)
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        sums = prefix_sums(_LOWER[data] if lower else data, BYTE_BASE)
        hashed = between(sums, start, end, BYTE_BASE)
        return start + base, end + base, mix(hashed + (end - start).astype(np.uint64) * np.uint64(WORD_BASE))

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """First word (index) and hash of every run of ``k`` words of a text."""
        at = np.flatnonzero(self.place + k <= np.repeat(self.n, self.n))
        return at, mix(window_hash(self.hash, k, WORD_BASE)[at])


def part_of(h: np.ndarray, parts: int) -> np.ndarray:
    """Part of a hash; parts are ranges, so sorted hashes have sorted parts."""
    return (((h >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


def unpack(cells: list[bytes], kind) -> np.ndarray:
    return np.concatenate([np.frombuffer(c, kind) for c in cells]) if cells else np.zeros(0, kind)


def runs(*sorted_keys: np.ndarray) -> np.ndarray:
    """Whether each row starts a new run of equal keys."""
    n = len(sorted_keys[0])
    new = np.ones(n, bool)
    if n:
        new[1:] = False
        for k in sorted_keys:
            new[1:] |= k[1:] != k[:-1]
    return new
