"""Word hashes and sets of word shingles of whole texts, by numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Bytes whose words are hashed at once; a longer text is cut between words.
BLOCK_BYTES = 2_000_000

_RNG = np.random.default_rng(5477)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTE[ord("A"):ord("Z") + 1] = _BYTE[ord("a"):ord("z") + 1]
_STEP = int(_RNG.integers(1, 1 << 62)) * 2 + 1
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_powers = {"table": np.ones(1, dtype=np.uint64)}


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power_table(n: int) -> np.ndarray:
    table = _powers["table"]
    if len(table) < n:
        n = max(n, 2 * len(table), 64)
        steps = np.full(n, _STEP, dtype=np.uint64)
        steps[0] = 1
        table = np.cumprod(steps, dtype=np.uint64)
        _powers["table"] = table
    return table


def word_hashes(data: bytes, gaps: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every word of a block; A-Z count as a-z, ``gaps`` tells
    the bytes between words."""
    x = np.frombuffer(data, dtype=np.uint8)
    inside = ~gaps[x]
    if not inside.any():
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    lengths = ends - starts
    own = np.flatnonzero(inside)
    place = np.cumsum(lengths) - lengths
    offset = np.arange(len(own)) - np.repeat(place, lengths)
    values = _BYTE[x[own]] * _power_table(int(lengths.max()))[offset]
    return mixed(np.add.reduceat(values, place) + lengths.astype(np.uint64)), starts


def _blocks(text: bytes) -> Iterator[bytes]:
    at = 0
    while at < len(text):
        end = at + BLOCK_BYTES
        while end < len(text) and text[end:end + 1] not in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r"):
            end += 1
        yield text[at:end]
        at = end


def words_of(texts: list[bytes], gaps: np.ndarray = _SPACE) -> list[np.ndarray]:
    """Word hashes of every text; short texts are hashed together."""
    out: list[np.ndarray] = [np.zeros(0, dtype=np.uint64)] * len(texts)
    held, size = [], 0

    def flush() -> None:
        ends = np.cumsum([len(texts[i]) + 1 for i in held])
        hashes, starts = word_hashes(b" ".join([texts[i] for i in held]), gaps)
        for i, part in zip(held, np.split(hashes, np.searchsorted(starts, ends[:-1]))):
            out[i] = part

    for i, text in enumerate(texts):
        if len(text) > BLOCK_BYTES:
            out[i] = np.concatenate([word_hashes(b, gaps)[0] for b in _blocks(text)])
            continue
        held.append(i)
        size += len(text)
        if size > BLOCK_BYTES:
            flush()
            held, size = [], 0
    if held:
        flush()
    return out


def shingle_row(words: np.ndarray, k: int) -> np.ndarray:
    """Shingles of k words in the order of the text; none if it has fewer words."""
    n = max(0, len(words) - k + 1)
    total = np.full(n, np.uint64(k))
    for j in range(k):
        total = mixed(total + words[j:j + n])
    return total


def shingle_set(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct shingles of k words; the whole text if it has fewer."""
    if not len(words):
        return words
    total = shingle_row(words, min(k, len(words)))
    n = len(total)
    total.sort()
    keep = np.ones(n, dtype=bool)
    np.not_equal(total[1:], total[:-1], out=keep[1:])
    return total[keep]
