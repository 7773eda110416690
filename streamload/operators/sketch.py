"""A Bloom filter of the batch's keys, for batches whose keys are too many to be broadcast (JN-1).

Above the broadcast bound the lookback keys would all be shuffled to the anti join, although most of them cannot match.
A sketch of the batch's keys has a bounded size, however many there are: two bitmaps, one for each of two hashes, that
together take no more than the bound, and no more than the keys need.  It is built by Spark's bitmap aggregates, one row per 32,768 bits, broadcast, and
every stored key whose bits are not both set is dropped in the scan's own stage.  A key that is dropped is certainly not in
the batch; one that stays by accident is settled by the exact join that follows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import quote_path
from .dedup import free_prefix

# Fixed value: bits of one bitmap of Spark's bitmap functions.
BITMAP_BITS = 32_768
#: Bits of one hash for each key: some 1 in 270 foreign keys pass. More would be sent and broadcast for little.
BITS_PER_KEY = 16
#: A sketch that would keep more than this share of foreign keys is not worth its pass.
MAX_KEPT = 0.5


class KeySketch(NamedTuple):
    """Bitmaps by number: those of the first hash from 0, those of the second from ``n_maps``.

    Each hash has its own frame: a lookup reads the batch for its own bits, and fetches no others.
    """

    by_hash: tuple[DataFrame, DataFrame]  # for each hash: _map long, _bits binary
    n_maps: int                           # of one hash

    @property
    def maps(self) -> DataFrame:
        return self.by_hash[0].unionByName(self.by_hash[1])


def sketch_maps(limit_bytes: int) -> int:
    """Bitmaps for each hash, so that both take at most ``limit_bytes``; 0 if not even one fits."""
    fit = limit_bytes // (2 * (BITMAP_BITS // 8 + 64))
    return 0 if fit < 1 else 1 << int(math.log2(fit))


def share_kept(n_keys: int, n_maps: int) -> float:
    """Expected share of foreign keys that pass."""
    return (1 - math.exp(-n_keys / (n_maps * BITMAP_BITS))) ** 2 if n_maps else 1.0


def _bits(keys: Sequence[str], n_maps: int) -> list[Column]:
    """The bit number of a key for each hash; the second hash's follow all of the first's."""
    size = n_maps * BITMAP_BITS
    columns = [F.col(quote_path(k)) for k in keys]
    return [F.pmod(F.xxhash64(F.lit(i), *columns), F.lit(size)) + F.lit(i * size) for i in (0, 1)]


def build_sketch(batch_keys: DataFrame, keys: Sequence[str], limit_bytes: int, n_keys: int | None = None) -> KeySketch | None:
    """The sketch of the batch's keys; None where the bound leaves no room for one.

    ``n_keys``, the number of the keys or more, makes it no larger than they need.
    """
    n_maps = sketch_maps(limit_bytes)
    if not n_maps:
        return None
    if n_keys is not None:
        n_maps = min(n_maps, 1 << math.ceil(math.log2(max(1.0, n_keys * BITS_PER_KEY / BITMAP_BITS))))
    # Spark's bitmap functions count values and bitmaps from 1
    def maps(bit: Column) -> DataFrame:
        return batch_keys.select((bit + 1).alias("_bit")).groupBy((F.bitmap_bucket_number("_bit") - 1).alias("_map")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("_bit")).alias("_bits"))
    first, second = _bits(keys, n_maps)
    return KeySketch((maps(first), maps(second)), n_maps)


def sketch_keys(existing: DataFrame, sketch: KeySketch, keys: Sequence[str]) -> DataFrame:
    """The rows of ``existing`` whose key may be in the batch: two lookups in the broadcast bitmaps."""
    out = existing
    for bit, maps in zip(_bits(keys, sketch.n_maps), sketch.by_hash):
        p = free_prefix(out, "_s")
        found = maps.select(F.col("_map").alias(f"{p}map"), F.col("_bits").alias(f"{p}bits"))
        # n_maps bitmaps of 4 kB for each hash: at most the bound they were made for
        joined = out.withColumn(f"{p}at", bit).join(F.broadcast(found), F.expr(f"{p}at DIV {BITMAP_BITS} = {p}map"))
        byte = F.expr(f"conv(hex(substring({p}bits, CAST({p}at % {BITMAP_BITS} DIV 8 + 1 AS INT), 1)), 16, 10)").cast("int")
        out = joined.filter(F.getbit(byte, F.expr(f"CAST({p}at % 8 AS INT)")) == 1).select(*[F.col(quote_path(c)) for c in existing.columns])
    return out
