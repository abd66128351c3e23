"""Bitmaps of keys of any kind: buckets stay even, and no key is missed."""

import numpy as np

from sommelix.llm import bitmap


def test_smallest_hashes_spread_evenly():
    keys = np.random.default_rng(0).integers(0, 2**63, size=(100_000, 24), dtype=np.uint64).min(axis=1)
    packed = next(bitmap.pack(iter([keys]), 1024))
    sizes = packed["keys"].map(len)
    assert len(sizes) == 1024 and sizes.max() < 2 * sizes.mean()


def test_frequent_keys_have_their_bits(spark):
    keys = np.repeat(np.arange(1, 301, dtype=np.uint64), np.arange(1, 301))  # key k occurs k times
    rows = spark.createDataFrame([(keys[i::7].tobytes(),) for i in range(7)], "k binary").repartition(3)

    def packing(batches):
        yield from bitmap.pack((np.frombuffer(k, np.uint64) for b in batches for k in b["k"]), 1024, 128)

    levels = bitmap.bitmaps(rows.mapInPandas(packing, bitmap.PACKED), 1024, ((2, 1 << 18), (32, 1 << 16), (128, 1 << 16)))
    every = np.arange(1, 301, dtype=np.uint64)
    for least, bits in zip((2, 32, 128), levels):
        on = bitmap.known(bits, every)
        assert on[least - 1 :].all() and on[: least - 1].mean() < 0.1
