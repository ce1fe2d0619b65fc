"""Hashed word shingles of whole texts, vectorised over the bytes of an Arrow batch."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: White space that separates words: bytes 0x20 and 0x09 to 0x0D, none of which occurs inside a UTF-8 character.
SPACES = [0x20, *range(0x09, 0x0E)]
#: Bytes that are hashed at once.
SPAN = 1 << 20

_RANDOM = np.random.default_rng(20_260_101)
_LETTER = _RANDOM.integers(0, 2**64, 256, dtype=np.uint64)
_LETTER[ord("A") : ord("Z") + 1] = _LETTER[ord("a") : ord("z") + 1]  # A-Z count as a-z
_BASE, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)
_IS_SPACE = np.isin(np.arange(256), SPACES)
_powers = {"up": np.ones(1, dtype=np.uint64), "down": np.ones(1, dtype=np.uint64)}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of each value over its 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's powers 0..n-1 and their inverses, modulo 2^64."""
    if len(_powers["up"]) < n:
        n = max(n, SPAN + 1)
        inverse = np.uint64(pow(int(_BASE), -1, 2**64))
        for name, factor in (("up", _BASE), ("down", inverse)):
            values = np.full(n, factor, dtype=np.uint64)
            values[0] = 1
            _powers[name] = np.cumprod(values)
    return _powers["up"], _powers["down"]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word data[start:end], A-Z taken as a-z."""
    out, i = np.empty(len(starts), dtype=np.uint64), 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + SPAN, "right")))
        a, b = int(starts[i]), int(ends[j - 1])
        up, down = _power(b - a + 1)
        total = np.zeros(b - a + 1, dtype=np.uint64)
        np.cumsum(_LETTER[data[a:b]] * up[: b - a], out=total[1:])
        out[i:j] = (total[ends[i:j] - a] - total[starts[i:j] - a]) * down[starts[i:j] - a]
        i = j
    return mix(out)


def words(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts, starts and ends of their words, and the text each word belongs to."""
    wide = pa.types.is_large_string(texts.type)
    raw = np.frombuffer(texts.buffers()[1], dtype=np.int64 if wide else np.int32)
    places = raw[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    data, places = data[places[0] : places[-1]], places - places[0]
    if not len(data):
        none = np.empty(0, dtype=np.int64)
        return data, none, none, none
    space = _IS_SPACE[data]
    opens = np.zeros(len(data) + 1, dtype=bool)  # a text begins here
    opens[places] = True
    before = np.concatenate(([True], space[:-1])) | opens[:-1]
    after = np.concatenate((space[1:], [True])) | opens[1:]
    starts, ends = np.flatnonzero(~space & before), np.flatnonzero(~space & after) + 1
    owner = np.searchsorted(places, starts, "right") - 1
    return data, starts, ends, owner


def shingle_sets(texts: pa.StringArray, width: int = 5) -> Iterator[np.ndarray]:
    """For each text its distinct shingles, as ascending 64-bit hashes.

    A text of fewer words than `width` has its whole word sequence as one shingle; one without
    words has none.
    """
    data, starts, ends, owner = words(texts)
    hashes = word_hashes(data, starts, ends)
    counts = np.bincount(owner, minlength=len(texts)) if len(owner) else np.zeros(len(texts), dtype=np.int64)
    first = np.concatenate(([0], np.cumsum(counts)))

    def joined(at: np.ndarray, n: int) -> np.ndarray:
        total = np.full(len(at), n, dtype=np.uint64)
        for k in range(n):
            total = total * _STEP + hashes[at + k]
        return mix(total)

    whole = joined(np.arange(max(0, len(hashes) - width + 1)), width)
    for k, n in enumerate(counts):
        if n >= width:
            yield np.unique(whole[first[k] : first[k + 1] - width + 1])
        elif n:
            yield joined(first[k : k + 1], int(n))
        else:
            yield whole[:0]


def signature(shingles: np.ndarray) -> int:
    """A 64-bit hash of a set, as a signed integer."""
    total = np.add.reduce(mix(shingles ^ _BASE), dtype=np.uint64, keepdims=True)
    total = total + np.full(1, len(shingles), dtype=np.uint64) * _STEP
    return int(mix(total)[0].astype(np.int64))
