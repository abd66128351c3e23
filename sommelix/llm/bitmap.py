"""Bitmaps of bounded size that tell which 64-bit keys occur often enough in a whole DataFrame.

Tasks pack their keys by ranges (buckets), four bytes for each key; each bucket sets its own bits, so a bitmap is made
without gathering keys. The number of buckets follows the number of keys, so a bucket's keys fit a task at every size of
the input. A key that occurs often enough always has its bit; others may have it by chance.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from sommelix.llm.hashing import mix

#: At most so many bits; a bitmap is sent to all executors.
BITS = 1 << 27
#: Different keys a bucket holds, about: keys are mixed first, so any keys, smallest hashes as well, spread evenly.
BUCKET_KEYS = 1 << 21
PACKED = "bucket int, keys binary"


def _power(n: int) -> int:
    return 1 << max(0, int(n) - 1).bit_length()


def n_buckets(n_keys: int) -> int:
    """Enough buckets for so many keys."""
    return max(1 << 10, _power(-(-n_keys // BUCKET_KEYS)))


def n_bits(n_keys: int, most: int = BITS) -> int:
    """Bits for so many keys: few by-chance hits while ``most`` allows."""
    return min(most, max(1 << 18, _power(4 * n_keys)))


def _split(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """A key's bucket, and the 32 bits that follow the bucket's own."""
    n = np.uint64(buckets.bit_length() - 1)
    return keys >> (np.uint64(64) - n), ((keys << n) >> np.uint64(32)).astype(np.uint32)


def _slot(low: np.ndarray, slots: int) -> np.ndarray:
    return ((low.astype(np.uint64) * np.uint64(slots)) >> np.uint64(32)).astype(np.int64)


def pack(arrays: Iterator[np.ndarray], buckets: int, most: int = 2, flush: int = 500_000) -> Iterator[pd.DataFrame]:
    """Rows of PACKED; keys that occur more than ``most`` times among about ``flush`` keys are written so many times."""
    held: list[np.ndarray] = []
    n = 0

    def written() -> pd.DataFrame:
        keys = np.sort(np.concatenate(held))
        keys = keys[np.append(np.ones(min(most, len(keys)), bool), keys[most:] != keys[:-most])]
        high, low = _split(keys, buckets)
        ends = np.searchsorted(high, np.arange(buckets, dtype=np.uint64), "right")
        parts = [(b, low[s:e].tobytes()) for b, (s, e) in enumerate(zip(np.append(0, ends[:-1]), ends)) if e > s]
        return pd.DataFrame(parts, columns=["bucket", "keys"])

    for keys in arrays:
        if len(keys):
            held.append(mix(keys))
            n += len(keys)
        if n >= flush:
            yield written()
            held.clear()
            n = 0
    if held:
        yield written()


def bitmaps(packed: DataFrame, buckets: int, wanted: tuple[tuple[int, int], ...]) -> list[np.ndarray]:
    """For each (times, bits) a bitmap, buckets x bytes, of the keys that occur at least so many times. The driver gets no
    more than the bits, compressed."""
    slots = [max(8, bits // buckets) for _, bits in wanted]

    def mark(rows: pd.DataFrame) -> pd.DataFrame:
        keys = np.sort(np.frombuffer(b"".join(rows["keys"]), np.uint32))
        made = []
        for (times, _), n in zip(wanted, slots):
            on = np.zeros(n, bool)
            last = keys[times - 1 :]  # a key that equals the one times - 1 places before
            on[_slot(last[last == keys[: len(last)]], n)] = True
            made.append(np.packbits(on).tobytes())
        return pd.DataFrame({"bucket": [rows["bucket"].iloc[0]], "bits": [zlib.compress(b"".join(made), 1)]})

    out = [np.zeros((buckets, n // 8), np.uint8) for n in slots]
    ends = np.cumsum([n // 8 for n in slots])[:-1]
    for r in packed.groupBy("bucket").applyInPandas(mark, "bucket int, bits binary").collect():
        for bitmap, part in zip(out, np.split(np.frombuffer(zlib.decompress(r["bits"]), np.uint8), ends)):
            bitmap[r["bucket"]] = part
    return out


def bitmap(packed: DataFrame, buckets: int, at_least: int, bits: int = BITS) -> np.ndarray:
    return bitmaps(packed, buckets, ((at_least, bits),))[0]


def present(keys: DataFrame, buckets: int, bits: int = BITS) -> np.ndarray:
    """Bitmap of the values of a DataFrame's only column, a bigint."""

    def packing(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from pack((b.iloc[:, 0].to_numpy(np.int64).view(np.uint64) for b in batches), buckets)

    return bitmap(keys.mapInPandas(packing, PACKED), buckets, 1, bits)


def known(seen: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys have their bit."""
    bucket, low = _split(mix(keys), len(seen))
    slot = _slot(low, seen.shape[1] * 8)
    return (seen[bucket.astype(np.int64), slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 == 1
