"""Temperature mixing of sources, realised as budgeted block permutations.

A source's weight is its token share to the power of an exponent, normalised.
The exponent is bisected until the weights have a target entropy, or until no
source is repeated more often than a limit.  A source then gives its documents
in permutations: as many whole ones as its budget allows, and the first part of
one more.  Its stream is cut where the tokens fill its part of a block, so each
block holds the sources by weight.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedwright.llm.common import discard, materialize

#: Most repetitions of a document, on average over its source.
MAX_REPEATS = 1.5
#: Tokens of a block of the mixture.
BLOCK_TOKENS = 1_000_000
#: Exponents that one pass over the source totals tries: four bisections.
POINTS = 16
PASSES = 8
#: Source tables up to this many rows are broadcast; larger ones are shuffled.
BROADCAST_SOURCES = 100_000
#: Rows that one bucket of a permutation is meant to hold.
BUCKET_ROWS = 50_000
#: Uses of one row that a task lists at most.
TASK_COPIES = 10_000
#: Parts that the rows at a source's last place are counted in.
EDGE_PARTS = 64
#: A place in its unsigned order.
_UNSIGNED = "place ^ (-9223372036854775807L - 1)"
WORD = r"[^\x20\x09-\x0D]+"


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


@dataclass
class Mixture:
    """exponent and budget (tokens), and per source: source, tokens, weight, repeats, whole, rest (tokens of the last part)."""

    exponent: float
    budget: float
    sources: DataFrame


def _try(totals: DataFrame, exponents: list[float], budget: float | None) -> list[tuple[float, float]]:
    """(entropy, most repeats) of the mixture at each exponent, in one pass over the totals.

    Exponents are data, not columns of their own: each call runs the same small plan and the same code."""
    raised = totals.select("share", "tokens", F.posexplode(F.array(*map(F.lit, exponents))).alias("i", "exponent"))
    raised = raised.withColumn("power", F.pow("share", F.col("exponent")))
    met = raised.join(F.broadcast(raised.groupBy("i").agg(F.sum("power").alias("z"))), "i")
    w = F.col("weight")
    seen = met.withColumn("weight", F.col("power") / F.col("z")).groupBy("i").agg(
        F.sum(-w * F.log(w)).alias("e"), F.max(w / F.col("tokens")).alias("m"), F.max(F.col("tokens") / w).alias("b")
    )
    return [(r.e, r.m * (budget if budget is not None else r.b)) for r in sorted(seen.collect(), key=lambda r: r.i)]


def mixture(rows: DataFrame, budget: float | None = None, max_repeats: float | None = MAX_REPEATS, entropy: float | None = None) -> Mixture:
    """rows: (source, tokens), one per document.

    Bisects the exponent between 0 (equal weights) and 1 (shares): with
    `entropy`, to that share of the largest possible entropy; else to the least
    exponent at which no source repeats more than max_repeats.  Without a budget
    it is the least one that uses every document once or more.  Without tokens
    the exponent is 1 and every document is used once.
    """
    totals = rows.groupBy("source").agg(F.sum("tokens").alias("tokens"))
    totals = materialize(totals, "sources")
    full = totals.where("tokens > 0").agg(F.sum("tokens").alias("t"), F.count("*").alias("n")).first()
    exponent = 1.0
    shares = totals.where("tokens > 0").withColumn("share", F.col("tokens") / F.lit(float(full.t or 1)))
    if full.n:
        low, high = 0.0, 1.0
        goal = None if entropy is None else entropy * math.log(full.n)
        for _ in range(PASSES):
            points = [low + (high - low) * i / POINTS for i in range(POINTS + 1)]
            # Entropy falls and repeats fall as the exponent rises: the first point that is low enough.
            fine = [e <= goal if goal is not None else r <= max_repeats for e, r in _try(shares, points, budget)]
            at = fine.index(True) if True in fine else POINTS
            low, high = points[max(at - 1, 0)], points[at]
        exponent = high
        z = shares.agg(F.sum(F.pow("share", F.lit(exponent)))).first()[0]
        weighted = shares.withColumn("weight", F.pow("share", F.lit(exponent)) / F.lit(z))
        budget = budget if budget is not None else weighted.agg(F.max(F.col("tokens") / F.col("weight"))).first()[0]
    else:
        weighted, budget = shares.withColumn("weight", F.lit(0.0)), 0.0
    # Within a billionth of a whole number, a source has whole permutations only.
    repeats = F.col("weight") * F.lit(float(budget)) / F.col("tokens")
    told = weighted.withColumn("repeats", F.when(F.abs(repeats - F.round(repeats)) < 1e-9, F.round(repeats)).otherwise(repeats)).select(
        "source", "tokens", "weight", "repeats", F.floor("repeats").cast("int").alias("whole"),
        ((F.col("repeats") - F.floor("repeats")) * F.col("tokens")).alias("rest"),
    )
    none = totals.where("tokens = 0").select(
        "source", "tokens", F.lit(0.0).alias("weight"), F.lit(1.0).alias("repeats"), F.lit(1).alias("whole"), F.lit(0.0).alias("rest")
    )
    return Mixture(exponent, float(budget), materialize(told.unionByName(none), "mixture"))


def _with_source(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Add the mixture's columns by source; null is a source."""
    side = sources.withColumnRenamed("source", "of_source").withColumnRenamed("tokens", "of_tokens")
    if sources.count() <= BROADCAST_SOURCES:
        side = F.broadcast(side)
    return rows.join(side, F.col("source").eqNullSafe(F.col("of_source"))).drop("of_source")


def place(key: Column, epoch: Column) -> Column:
    """Where a permutation puts a document: a hash of its key and the epoch."""
    return F.xxhash64(key, epoch, F.lit(97))


def _token_rows(df: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(doc_id, source, key, tokens): key is a hash of id and text."""
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.col(text_col).alias("_text"))
    key = F.xxhash64(F.col("doc_id"), F.col("doc_id").isNull(), F.col("_text"), F.col("_text").isNull())
    return materialize(rows.select("doc_id", "source", key.alias("key"), token_count(F.col("_text")).alias("tokens")), "tokens")


def block_permutations(rows: DataFrame, mixed: Mixture, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """doc_id, source, epoch, block, place, n_tokens: the mixture, one row per use of a document.

    A block is read in the order of place (without its sign), then the key, which mixes its sources.

    rows: (doc_id, source, key, tokens).  A document is used if its tokens begin inside its source's budget.  Rows
    that are equal are one with a number of copies, next to each other in a permutation, so they are
    interchangeable and the result doesn't depend on how rows are dealt.  Running sums are taken per bucket
    of a permutation and over the sums of the buckets, so no source, however large, is one task's work.
    """
    different = rows.groupBy("doc_id", "source", "key", "tokens").agg(F.count("*").alias("copies"))
    used = _with_source(different, mixed.sources)
    used = used.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("whole") - F.when(F.col("rest") > 0, 0).otherwise(1)))).where(
        "whole > 0 OR rest > 0"
    )
    most = rows.count() // BUCKET_ROWS + 1
    n_buckets = 1 << max(8, (most - 1).bit_length())
    used = used.withColumn("place", place(F.col("key"), F.col("epoch"))).withColumn(
        "bucket", F.shiftrightunsigned("place", 64 - (n_buckets.bit_length() - 1)).cast("int")
    )
    keys = ["source", "epoch", "bucket"]
    own = F.col("tokens") * F.col("copies")
    sums = used.groupBy(*keys).agg(F.sum(own).alias("in_bucket"))
    ahead = F.sum("in_bucket").over(Window.partitionBy("source", "epoch").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    ahead = sums.select(F.col("source").alias("s"), F.col("epoch").alias("e"), F.col("bucket").alias("b"), F.coalesce(ahead, F.lit(0)).alias("ahead"))
    inside = F.sum(own).over(Window.partitionBy(*keys).orderBy(F.expr(_UNSIGNED), "key", "doc_id", "tokens").rowsBetween(Window.unboundedPreceding, -1))
    met = used.withColumn("inside", F.coalesce(inside, F.lit(0))).join(
        ahead, F.col("source").eqNullSafe(F.col("s")) & (F.col("epoch") == F.col("e")) & (F.col("bucket") == F.col("b"))
    )
    before = F.col("ahead") + F.col("inside")
    left = F.col("rest") - before
    begun = F.when(left <= 0, 0).when(F.col("tokens") == 0, F.col("copies")).otherwise(F.least("copies", F.ceil(left / F.greatest("tokens", F.lit(1)))))
    met = met.withColumn("before", before).withColumn("uses", F.when(F.col("epoch") < F.col("whole"), F.col("copies")).otherwise(begun).cast("long")).where("uses > 0")
    few = met.where(F.col("uses") <= TASK_COPIES).withColumn("from", F.lit(0).cast("long"))
    # A row with very many copies is dealt out before they are listed.
    many = met.where(F.col("uses") > TASK_COPIES).withColumn("from", F.explode(F.expr(f"sequence(0L, uses - 1, {TASK_COPIES}L)"))).repartition("key", "epoch", "from")
    listed = few.unionByName(many).withColumn("copy", F.explode(F.expr(f"sequence(from, least(uses, from + {TASK_COPIES}L) - 1)")))
    share = F.col("weight") * F.lit(float(block_tokens))
    at = F.col("epoch") * F.col("of_tokens") + F.col("before") + F.col("copy") * F.col("tokens")
    return listed.select("doc_id", "source", "epoch", F.when(share > 0, F.floor(at / share)).otherwise(0).cast("long").alias("block"), "place", F.col("tokens").alias("n_tokens"))


def mix_sources(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", budget: float | None = None,
                max_repeats: float | None = MAX_REPEATS, entropy: float | None = None, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """doc_id, source, epoch, block, place, n_tokens: one row for each time the mixture uses a document.

    Tokens are words (runs without space or the controls 9 to 13) of the whole
    text, however long; null has none.  A null source is a source of its own.  A
    source without tokens is used once, in block 0.  Rows of one id, or without
    one, that differ in text are different documents with places of their own; a
    row that is repeated whole is a document of its own, next to its twin in
    every permutation (their places tie, and they are alike).  Other columns are
    ignored.  An empty table gives an empty result.  See mixture() for the
    exponent and the budget.
    """
    rows = _token_rows(df, id_col, text_col, source_col)
    return block_permutations(rows, mixture(rows, budget, max_repeats, entropy), block_tokens)


def _first_at_the_end(edge: DataFrame) -> DataFrame:
    """Of the rows at each source's last place, which are alike, the first `take`: they are counted in salted parts, and each
    part gives what is left for it."""
    edge = materialize(edge.withColumn("part", F.pmod(F.monotonically_increasing_id(), F.lit(EDGE_PARTS)).cast("int")), "edge")
    sizes = edge.groupBy("source", "part").agg(F.count("*").alias("n"))
    ahead = F.sum("n").over(Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select(F.col("source").alias("s"), F.col("part").alias("p"), F.coalesce(ahead, F.lit(0)).alias("ahead"))
    placed = edge.withColumn("n", F.row_number().over(Window.partitionBy("source", "part").orderBy("key")))
    met = placed.join(sizes, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")))
    return met.withColumn("last", (F.col("ahead") + F.col("n") <= F.col("take")).cast("int")).drop("part", "n", "s", "p", "ahead")


def mixed_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The rows of df, each as often as mix_sources() uses it, in the order of the mixture.

    What the last, partial permutation of a source takes is a range of places:
    its end is one value per source, and so is how many of the rows there it
    takes.  A use stands where its source's stream is at it, as a share of the
    whole stream, so any run of rows holds the sources by weight.  Nulls, empty
    and very long texts, repeated rows, ties and empty tables as in
    mix_sources(); columns are unchanged.
    """
    row = df.select(F.struct("*").alias("row"))
    rows = _token_rows(df, id_col, text_col, source_col)
    mixed = mixture(rows, how.get("budget"), how.get("max_repeats", MAX_REPEATS), how.get("entropy"))
    ordered = F.expr(_UNSIGNED)
    last = block_permutations(rows, mixed).join(
        mixed.sources.where("rest > 0").select(F.col("source").alias("s"), "whole"), F.col("source").eqNullSafe(F.col("s"))
    ).where("epoch = whole")
    places = last.groupBy("source", "place").agg(F.count("*").alias("n"))
    ends = places.groupBy("source").agg(F.max(ordered).alias("end"), F.max_by("n", ordered).alias("take"))
    sources = mixed.sources.alias("m").join(ends.alias("e"), F.expr("m.source <=> e.source"), "left").select("m.*", "e.end", "e.take")
    sources = materialize(sources, "ends")
    # ids and sources are read from the packed row: no name of df can clash.
    text, doc_id = F.col("row")[text_col], F.col("row")[id_col]
    named = row.withColumn("source", F.col("row")[source_col]).withColumn("key", F.xxhash64(doc_id, doc_id.isNull(), text, text.isNull()))
    known = _with_source(named, sources).withColumn("place", place(F.col("key"), F.col("whole")))
    there = F.coalesce(ordered == F.col("end"), F.lit(False))
    inner = known.where(~there).withColumn("last", F.coalesce(ordered < F.col("end"), F.lit(False)).cast("int"))
    every = inner.unionByName(_first_at_the_end(known.where(there)))
    copies = F.col("whole") + F.col("last")
    uses = every.withColumn("copies", copies).where("copies > 0").select("row", "key", "repeats", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("epoch"))
    signed = place(F.col("key"), F.col("epoch")).cast("double") / float(1 << 64)
    uses = uses.withColumn("at", (F.col("epoch") + signed + F.when(signed < 0, 1.0).otherwise(0.0)) / F.greatest("repeats", F.lit(1e-9)))
    # Rows that are alike have one place; a number of their own lets a range of it be cut.
    uses = uses.withColumn("own", F.monotonically_increasing_id())
    discard(rows)
    return uses.repartitionByRange("at", "key", "own").sortWithinPartitions("at", "key").select("row.*")
