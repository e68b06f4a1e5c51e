"""Exact de-duplication: two-pass Bloom filtering finds the hashes that may repeat.

Pass one sets, for each text fingerprint, two bits of a filter in which a bit
survives only if at least two rows set it.  Pass two lets every row whose bits
did not both survive go straight to the output; only the rest is shuffled.
The filter decides nothing but who travels, so its size never changes a result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedwright.llm.common import materialize

#: Bits in one row of the filter table (what bitmap_construct_agg builds).
_ROW_BITS = 32768
#: Largest filter that is broadcast: 2**27 bits are 16 MB.
MAX_FILTER_BITS = 1 << 27
#: Filter bits per row of input, up to that size.
BITS_PER_ROW = 16
#: Ways a group of copies is split before its rows meet.
SALTS = 64


def _filter_bits(rows: int, limit: int) -> int:
    bits = _ROW_BITS
    while bits < BITS_PER_ROW * rows and bits < limit:
        bits *= 2
    return bits


def _positions(fingerprint: Column, bits: int) -> list[Column]:
    h = F.xxhash64(fingerprint)
    return [h.bitwiseAND(F.lit(bits - 1)),
            F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(bits - 1))]


def _as_words(bitmap: str) -> Column:
    """A bitmap as 64-bit words: one look at an array tests a bit."""
    return F.expr(f"transform(sequence(0, {_ROW_BITS // 64 - 1}), i -> cast(conv(hex(substring({bitmap}, i * 8 + 1, 8)), 16, -10) AS bigint))")


def _bit_is_set(words: str, position: str) -> Column:
    """Byte j of a bitmap holds the positions from 8 j, the lowest bit first; words are big-endian."""
    within = f"cast(pmod({position}, {_ROW_BITS}) AS int)"
    return F.expr(f"coalesce(bit_get(get({words}, shiftright({within}, 6)), (7 - (shiftright({within}, 3) & 7)) * 8 + ({within} & 7)) = 1, false)")


def repeated_filter(fingerprints: DataFrame, bits: int) -> DataFrame:
    """(slot, bitmap) rows: the bits that two rows or more have set."""
    positions = fingerprints.select(F.explode(F.array(*_positions(F.col("fp"), bits))).alias("p"))
    twice = positions.groupBy("p").count().where("count > 1")
    return twice.groupBy(F.expr(f"p div {_ROW_BITS}").alias("slot")).agg(
        F.bitmap_construct_agg(F.pmod("p", F.lit(_ROW_BITS))).alias("bitmap")
    )


def exact_dedup(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_filter_bits: int = MAX_FILTER_BITS
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical, unchanged; null counts as empty, so null and
    empty texts form one group.  The largest id of a group stays.  A row that is
    repeated with its id can't be told from its twin: both carry the same flags
    and both count in group_size.  A null id never wins over another; a group
    that has only null ids keeps them.  Other columns are ignored, whatever
    their names.  An empty table gives an empty result.
    """
    rows = df.select(
        F.col(id_col).alias("doc_id"), F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)).alias("fp")
    )
    rows = materialize(rows, "fingerprints")  # the texts are read once
    bits = _filter_bits(rows.count(), max_filter_bits)
    bloom = materialize(repeated_filter(rows, bits), "repeated")

    # The filter is at most max_filter_bits / 8 bytes, which is why it may be broadcast.
    first, second = _positions(F.col("fp"), bits)
    probed = rows.withColumns({"p1": first, "p2": second})
    for n in ("1", "2"):
        side = bloom.select(F.col("slot").alias(f"slot{n}"), _as_words("bitmap").alias(f"bitmap{n}"))
        probed = probed.join(F.broadcast(side), F.expr(f"p{n} div {_ROW_BITS}") == F.col(f"slot{n}"), "left")
    suspect = _bit_is_set("bitmap1", "p1") & _bit_is_set("bitmap2", "p2")
    sha = F.lower(F.hex("fp")).alias("text_sha256")
    straight = probed.where(~suspect).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), sha
    )

    # Groups of copies are counted in salted parts, and the answer goes back to the parts that exist:
    # no task sees more than a part of a group.
    travellers = probed.where(suspect).select(
        "doc_id", "fp", F.pmod(F.xxhash64(F.col("doc_id"), F.lit(1)), F.lit(SALTS)).cast("int").alias("salt")
    )
    parts = travellers.groupBy("fp", "salt").agg(F.max("doc_id").alias("top"), F.count("*").alias("n"))
    groups = parts.groupBy("fp").agg(
        F.max("top").alias("keep_id"), F.sum("n").alias("group_size"), F.collect_set("salt").alias("salts")
    )
    answer = groups.select(
        "fp", "keep_id", "group_size", F.explode("salts").alias("salt")
    )
    met = travellers.join(answer, ["fp", "salt"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), sha
    )
    return straight.unionByName(met)
