"""Vectorised words and word shingles as 64-bit hashes."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
BASE = 0x9E3779B97F4A7C15
BLOCK = 1 << 20
LETTERS = bytes(range(65, 91))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * MIX1
    x = x ^ (x >> np.uint64(27))
    x = x * MIX2
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
    values[32] = 0  # the separator adds nothing
    return values


_powers: dict[str, np.ndarray] = {}


def _power(kind: str, n: int) -> np.ndarray:
    """Powers of the base, or of its inverse, modulo 2**64."""
    have = _powers.get(kind)
    if have is None or len(have) < n:
        base = BASE if kind == "up" else pow(BASE, -1, 1 << 64)
        have = np.full(max(n, BLOCK + 1024), base & (2**64 - 1), dtype=np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        _powers[kind] = have
    return have[:n]


def separators(inside: bytes) -> bytes:
    """Translation table: A-Z lowered, every byte not in ``inside`` becomes the separator."""
    out = bytearray(32 for _ in range(256))
    for b in inside:
        out[b] = b
    for b in LETTERS:
        if b in inside or b + 32 in inside:
            out[b] = b + 32
    return bytes(out)


#: Words are what lies between white space.
SPACED = separators(bytes(b for b in range(256) if b not in (32, 9, 10, 11, 12, 13)))
#: Words are ASCII letters, digits and everything beyond ASCII.
ALNUM = separators(bytes([*range(48, 58), *range(97, 123), *range(128, 256)]))


def hash_block(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each word of already translated bytes."""
    arr = np.frombuffer(block, dtype=np.uint8)
    inside = np.empty(len(arr) + 1, dtype=np.int8)
    inside[0] = 0
    np.not_equal(arr, 32, out=inside[1:].view(bool))
    starts = np.flatnonzero(np.diff(inside) == 1)
    if not len(starts):
        return np.empty(0, np.uint64), starts
    values = _byte_values()[arr] * _power("up", len(arr))
    return mix(np.add.reduceat(values, starts) * _power("down", len(arr))[starts]), starts


def word_hashes(texts: list[bytes], table: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of ``texts`` in order, and how many words each text has.

    Long texts go block by block, cut between words, so memory follows the words and not the bytes.
    """
    hashes, counts = [], np.zeros(len(texts), dtype=np.int64)
    held, first = [], 0

    def flush(upto: int) -> None:
        nonlocal held, first
        if held:
            joined = b" ".join(held) + b" "
            h, starts = hash_block(joined)
            ends = np.cumsum([len(t) + 1 for t in held])
            upto_words = np.searchsorted(starts, ends)
            counts[first:upto] = np.diff(np.concatenate([[0], upto_words]))
            hashes.append(h)
        held, first = [], upto

    size = 0
    for i, text in enumerate(texts):
        text = (text or b"").translate(table)
        if len(text) > BLOCK:
            flush(i)
            size, at = 0, 0
            while at < len(text):
                end = len(text) if at + BLOCK >= len(text) else text.rfind(b" ", at, at + BLOCK)
                if end <= at:  # one word fills the block
                    end = text.find(b" ", at + BLOCK)
                    end = len(text) if end < 0 else end
                h, _ = hash_block(text[at:end])
                hashes.append(h)
                counts[i] += len(h)
                at = end + 1
            first = i + 1
            continue
        if size + len(text) > BLOCK:
            flush(i)
            size = 0
        held.append(text)
        size += len(text) + 1
    flush(len(texts))
    return (np.concatenate(hashes) if hashes else np.empty(0, np.uint64)), counts


def combined(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` word hashes; the order of the words counts."""
    n = max(len(hashes) - width + 1, 0)
    factors = mix(np.arange(1, width + 1, dtype=np.uint64) * np.uint64(BASE)) | np.uint64(1)
    total = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        total += hashes[k:k + n] * factors[k]
    return mix(total + np.uint64(width))


def shingle_sets(texts: list[bytes], table: bytes, width: int) -> list[np.ndarray]:
    """Per text the sorted distinct shingles of ``width`` words as signed 64-bit hashes.

    A text of fewer words has its whole word sequence as the one shingle; without words the set is empty.
    """
    hashes, counts = word_hashes(texts, table)
    whole = combined(hashes, width).view(np.int64) if len(hashes) >= width else np.empty(0, np.int64)
    ends = np.cumsum(counts)
    out = []
    for n, end in zip(counts.tolist(), ends.tolist()):
        if n >= width:
            out.append(np.unique(whole[end - n:end - width + 1]))
        elif n:
            out.append(combined(hashes[end - n:end], n).view(np.int64))
        else:
            out.append(np.empty(0, np.int64))
    return out
