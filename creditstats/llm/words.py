"""Words of texts as hash arrays, and hashes of word windows, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .common import worker_state

KEPT_WORDS = 400_000
U = np.uint64
# Odd constants (the golden ratio and its followers in 64 bits).
K1, K2, K3 = U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F), U(0x165667B19E3779F9)


class WordHashes(dict):
    """Word (bytes) to 64-bit hash, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= KEPT_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def word_hashes() -> WordHashes:
    """The worker's word hashes, kept from task to task."""
    return worker_state("words", WordHashes)


def words(text: str | None) -> list[bytes]:
    """Maximal runs without space and ASCII controls 9 to 13 (what
    bytes.split takes as white space)."""
    return (text or "").encode().split()


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * K1 + (b ^ (b >> U(29))) * K2
    x ^= x >> U(32)
    x *= K3
    x ^= x >> U(29)
    return x


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of every `size` consecutive word hashes; windows of lengths that
    are powers of two are built by doubling and joined."""
    n = len(h) - size + 1
    if n <= 0:
        return np.empty(0, U)
    out, used, level, length = None, 0, h, 1
    while True:
        if size & length:
            part = level[used:used + n]
            out = part if out is None else mix(out, part)
            used += length
        if used == size:
            return out
        level = mix(level[:-length], level[length:])
        length *= 2


def batches_of(batches: Iterator[pa.RecordBatch], text_column: int, limit: int = 4 << 20) -> Iterator[list[tuple]]:
    """Rows in lists of about `limit` characters of text."""
    rows, held = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, 128):
            for row in zip(*(c.to_pylist() for c in batch.slice(at, 128).columns)):
                rows.append(row)
                held += len(row[text_column] or "")
                if held >= limit:
                    yield rows
                    rows, held = [], 0
    if rows:
        yield rows


def runs(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(begin of each run of equal keys, number of each row's run)."""
    new = np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]) if len(sorted_keys) else np.empty(0, bool)
    return np.flatnonzero(new), np.cumsum(new) - 1
