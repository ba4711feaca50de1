"""Word shingles of texts as 64-bit numbers, many texts at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

WIDTH = 5
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse
LETTER = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)


class Powers:
    """Powers of an odd base and of its inverse modulo 2^64, as many as the longest text so far needed."""

    def __init__(self, base: int) -> None:
        self.steps = (np.uint64(base), np.uint64(pow(base, -1, 1 << 64)))
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def reach(self, n: int) -> None:
        if n > len(self.up):
            size = max(n, 2 * len(self.up))
            self.up, self.down = (np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, s)]), dtype=np.uint64)
                                  for s in self.steps)


POWERS = Powers(BASE)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Hashes:
    """Hashes of stretches of a byte array in constant time each."""

    def __init__(self, data: np.ndarray) -> None:
        POWERS.reach(len(data) + 1)
        self.total = np.concatenate([np.zeros(1, np.uint64),
                                     np.cumsum(LETTER[data] * POWERS.up[:len(data)], dtype=np.uint64)])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.total[ends] - self.total[starts]) * POWERS.down[starts] + (ends - starts).astype(np.uint64))


def chunked(texts: list[str | bytes | None], most: int = 1 << 20) -> Iterator[tuple[int, list[bytes]]]:
    """Neighbouring texts of up to `most` bytes together, or one longer text: (place of the first, their bytes)."""
    first, held, size = 0, [], 0
    for i, text in enumerate(texts):
        raw = text if isinstance(text, bytes) else (text or "").encode("utf-8", "surrogatepass")
        if held and size + len(raw) > most:
            yield first, held
            first, held, size = i, [], 0
        held.append(raw)
        size += len(raw)
    if held:
        yield first, held


def word_hashes(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, number of words of each text). A-Z count as a-z; words stand between ASCII white space."""
    data = np.frombuffer(b" ".join(raws).lower() + b" ", dtype=np.uint8)
    POWERS.reach(len(data) + 1)
    space = SPACE[data]
    change = np.flatnonzero(np.diff(space, prepend=True))
    starts, ends = change[0::2], change[1::2]
    total = np.cumsum(LETTER[data] * POWERS.up[:len(data)], dtype=np.uint64)
    before = np.where(starts > 0, total[starts - 1], np.uint64(0))
    words = mix((total[ends - 1] - before) * POWERS.down[starts])
    limits = np.cumsum([len(r) + 1 for r in raws])
    return words, np.diff(np.searchsorted(starts, limits), prepend=0)


def shingle_sets(texts: list[str | None], width: int = WIDTH) -> Iterator[np.ndarray]:
    """For each text the sorted set of its shingles: `width` words in a row, or the whole of a shorter text.
    A text without words has the empty set."""
    weights = POWERS
    for _, raws in chunked(texts):
        words, counts = word_hashes(raws)
        weights.reach(width + 1)
        joined = words[:max(0, len(words) - width + 1)] * weights.up[1]
        for i in range(1, width):
            joined = joined + words[i:len(joined) + i] * weights.up[i + 1]
        joined = mix(joined)
        at = 0
        for n in counts.tolist():
            if n >= width:
                found = np.sort(joined[at:at + n - width + 1])
                yield found[np.concatenate([[True], found[1:] != found[:-1]])] if len(found) > 1 else found
            elif n:
                part = (words[at:at + n] * weights.up[1:n + 1]).sum(dtype=np.uint64)
                yield mix(np.array([part + np.uint64(n)], dtype=np.uint64))
            else:
                yield np.empty(0, dtype=np.uint64)
            at += n


def set_key(found: np.ndarray) -> int:
    """A number for the whole set, as a signed long."""
    return int(mix(found ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).astype(np.int64))
