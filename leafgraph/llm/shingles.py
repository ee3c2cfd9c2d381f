"""Vectorised word and shingle hashing over batches of texts.

A batch of texts is laid out as one byte buffer.  A running polynomial sum over the buffer (modulo 2**64) gives the
hash of any byte range by one subtraction and one multiplication, so words are hashed without a Python object per word.
Only ASCII letters are lower-cased and only ASCII white space (0x20, 0x09-0x0D) separates words, as ``bytes.lower`` and
the byte table below define them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

#: Odd multiplier of the running polynomial and its inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
#: Bytes handled at once: longer texts are cut between words, and a longer word is summed up in parts.
_CHUNK = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_powers: dict[str, np.ndarray] = {}


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _powers or len(_powers["up"]) < n:
        n = max(n, _CHUNK + 4096)
        for name, base in (("up", _BASE), ("down", _BASE_INV)):
            table = np.full(n, base, dtype=np.uint64)
            table[0] = 1
            _powers[name] = np.cumprod(table, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values (murmur3's finaliser)."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


_GAP = re.compile(rb"[\x20\x09-\x0D]")


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of every text, and the number of words of each text."""
    found, counts = [], []
    for first, run in batches(texts):
        if len(run) == 1 and len(run[0]) > 2 * _CHUNK:
            hashes = [h for part in _parts(run[0]) for h in part]
            found += hashes
            counts.append(np.array([sum(map(len, hashes))]))
        else:
            hashes, n = _hashes(run)
            found.append(hashes)
            counts.append(n)
    if not found:
        return np.empty(0, dtype=np.uint64), np.zeros(len(texts), dtype=np.int64)
    return np.concatenate(found), np.concatenate(counts)


def _parts(text: bytes) -> Iterator[list[np.ndarray]]:
    """The word hashes of a long text, about ``_CHUNK`` bytes at a time."""
    at = 0
    while at < len(text):
        gap = _GAP.search(text, min(at + _CHUNK, len(text)))
        end = gap.start() if gap else len(text)
        part = text[at:end]
        if len(part) <= 2 * _CHUNK:
            yield [_hashes([part])[0]]
        else:  # it ends in a long word
            begin = max(part.rfind(bytes([c]), 0, _CHUNK) for c in b" \t\n\x0b\x0c\r") + 1
            yield [_hashes([part[:begin]])[0], _long_hash(part[begin:])]
        at = end


def _long_hash(word: bytes) -> np.ndarray:
    up, _ = _power_table(_CHUNK)
    total = 0
    for at in range(0, len(word), _CHUNK):
        raw = np.frombuffer(word[at : at + _CHUNK].lower(), dtype=np.uint8).astype(np.uint64) + np.uint64(1)
        total += int(np.add.reduce(raw * up[: len(raw)])) * pow(_BASE, at, 1 << 64)
    return mix64(np.array([(total + len(word)) & (1 << 64) - 1], dtype=np.uint64))


def _hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    buffer = b" ".join(texts) + b" "
    raw = np.frombuffer(buffer.lower(), dtype=np.uint8)
    up, down = _power_table(len(raw) + 1)
    space = _SPACE[raw]
    running = np.empty(len(raw) + 1, dtype=np.uint64)
    running[0] = 0
    # +1 so that a NUL byte counts as well
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=running[1:])
    inside = ~space
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside)).astype(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    hashes = mix64((running[ends] - running[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    counts = np.diff(np.concatenate(([0], np.searchsorted(starts, text_ends))))
    return hashes, counts


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """The sorted distinct ``width``-word shingle hashes of each text.

    Fewer words than ``width``: the whole sequence is the one shingle.  No words: an empty set.
    """
    hashes, counts = word_hashes(texts)
    out: list[np.ndarray] = []
    powers, _ = _power_table(width + 2)
    rolled = np.zeros(max(0, len(hashes) - width + 1), dtype=np.uint64)
    for k in range(width if len(rolled) else 0):
        rolled += hashes[k : len(hashes) - width + 1 + k] * powers[k + 1]
    rolled = mix64(rolled)
    at = 0
    for n in counts.tolist():
        if n >= width:
            x = np.sort(rolled[at : at + n - width + 1])
            if len(x) > 1:
                keep = np.empty(len(x), dtype=bool)
                keep[0] = True
                np.not_equal(x[1:], x[:-1], out=keep[1:])
                x = x[keep]
        elif n:
            x = hashes[at : at + n] * powers[1 : n + 1]
            x = mix64(np.array([np.add.reduce(x) + np.uint64(n)], dtype=np.uint64))
        else:
            x = np.empty(0, dtype=np.uint64)
        out.append(x)
        at += n
    return out


def batches(texts: list[bytes], limit: int = _CHUNK):
    """Runs of consecutive texts of about ``limit`` bytes: (first index, texts)."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield first, texts[first:i]
            first, size = i, 0
        size += len(t) + 1
    if first < len(texts):
        yield first, texts[first:]
