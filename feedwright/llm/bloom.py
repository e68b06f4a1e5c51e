"""Blocked Bloom filters made and probed by DataFrame functions alone.

A filter is a table of slots, each with two bitmaps of 32768 bits.  A 64-bit key
has one slot and one bit in either bitmap.  What travels to build it are
bitmaps; its size is bounded, which is why it may be broadcast.  Beyond that
size a filter lets more rows pass, and no result depends on who passes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedwright.llm.common import materialize

SLOT_BITS = 32768
#: Largest filter: 2**11 slots of two 4 kB bitmaps are 16 MB.
MAX_SLOTS = 1 << 11
#: Bits per key in each bitmap, up to that size.
BITS_PER_KEY = 8


def slots_for(keys: int, limit: int = MAX_SLOTS) -> int:
    n = 1
    while n * SLOT_BITS < BITS_PER_KEY * keys and n < limit:
        n *= 2
    return n


def slot(key: str, slots: int) -> str:
    return f"(shiftrightunsigned({key}, 44) & {slots - 1}L)"


def built(keys: DataFrame, slots: int, key: str = "key", **sets: str) -> DataFrame:
    """slot and, for each set, two bitmaps (every1, every2 of `every`) over the keys for which its condition
    holds; keys are well mixed longs."""
    bits = lambda only, shift: F.bitmap_construct_agg(F.expr(f"CASE WHEN {only} THEN shiftrightunsigned({key}, {shift}) & {SLOT_BITS - 1}L END"))
    made = [bits(only, 15 * i).alias(f"{name}{i + 1}") for name, only in sets.items() for i in (0, 1)]
    return keys.groupBy(F.expr(slot(key, slots)).alias("slot")).agg(*made)


def either(a: DataFrame, b: DataFrame) -> DataFrame:
    """Filters of as many slots as one."""
    names = [c for c in a.columns if c != "slot"]
    return a.unionByName(b).groupBy("slot").agg(*[F.bitmap_or_agg(c).alias(c) for c in names])


def as_words(bitmap: str) -> Column:
    """A bitmap as 64-bit words: one look at an array tests a bit."""
    return F.expr(f"transform(sequence(0, {SLOT_BITS // 64 - 1}), i -> cast(conv(hex(substring({bitmap}, i * 8 + 1, 8)), 16, -10) AS bigint))")


def bit_is_set(words: str, position: str) -> str:
    """Byte j of a bitmap holds the positions from 8 j, the lowest bit first; words are big-endian."""
    within = f"cast({position} AS int)"
    return f"coalesce(bit_get(get({words}, shiftright({within}, 6)), (7 - (shiftright({within}, 3) & 7)) * 8 + ({within} & 7)) = 1, false)"


def probed(rows: DataFrame, table: DataFrame, slots: int, key: str = "key", which: str = "every") -> DataFrame:
    """rows with a boolean `may`: may the key be in the set?"""
    side = table.select(F.col("slot").alias("_slot"), as_words(f"{which}1").alias("_w1"), as_words(f"{which}2").alias("_w2"))
    met = rows.join(F.broadcast(side), F.expr(f"{slot(key, slots)} = _slot"), "left")
    test = " AND ".join(bit_is_set(f"_w{i + 1}", f"shiftrightunsigned({key}, {15 * i}) & {SLOT_BITS - 1}L") for i in (0, 1))
    return met.withColumn("may", F.expr(test)).drop("_slot", "_w1", "_w2")


def probed_in(rows: DataFrame, keys: DataFrame, key: str, max_slots: int = MAX_SLOTS) -> DataFrame:
    """rows with `may`, by a filter over the column `key` of keys."""
    slots = slots_for(keys.count(), max_slots)
    return probed(rows, materialize(built(keys, slots, every="true"), "filter"), slots, key)


def where_in(rows: DataFrame, keys: DataFrame, key: str, max_slots: int = MAX_SLOTS) -> DataFrame:
    return probed_in(rows, keys, key, max_slots).where("may").drop("may")
