"""Operators on ordered feeds: prefixes, caps, first-wins and the fold of all three.

A feed is rows of (outlet_id, section, section_ord, pos, link, ...); pos 0 is the
newest.  Order is data here, never the order of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _over(keys: Sequence[str], order: Sequence[Column | str] = ()):
    w = Window.partitionBy(*[F.col(k) for k in keys])
    return w.orderBy(*order) if order else w


def met(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """left join right on keys in which a null equals a null; each key is there once, first."""
    other = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & left[k].eqNullSafe(other[f"_r_{k}"])
    joined = left.join(other, same, how)
    if how in ("left_semi", "left_anti"):
        return joined
    both = [(F.coalesce(k, f"_r_{k}") if how == "full" else F.col(k)).alias(k) for k in keys]
    return joined.select(*both, *[c for c in left.columns if c not in keys], *[c for c in right.columns if c not in keys])


def boundary_reason(norm: Column, checkpoint: Column, known: Column) -> Column:
    """checkpoint, known_previous or null."""
    return F.when(F.coalesce(norm == checkpoint, F.lit(False)), "checkpoint").when(F.coalesce(known, F.lit(False)), "known_previous")


def until_boundary(feed: DataFrame, is_boundary: Column, keys: Sequence[str], order: str = "pos") -> DataFrame:
    """The rows of each feed before its first boundary; all of them without one.

    The boundary is an aggregate joined back, not a window over the rows: a
    feed's rows are combined before the shuffle, and aren't sorted.  A null in a
    key is a key like any other.
    """
    stop = feed.where(is_boundary).groupBy(*keys).agg(F.min(order).alias("_stop"))
    return met(feed, stop, keys, "left").where(F.col("_stop").isNull() | (F.col(order) < F.col("_stop"))).drop("_stop")


def until_global_boundary(feed: DataFrame, is_boundary: Column, order: Sequence[str]) -> DataFrame:
    """One boundary halts all later pages: order is compared as a tuple."""
    place = F.struct(*order)
    stop = feed.where(is_boundary).agg(F.min(place).alias("_stop"))
    return feed.crossJoin(F.broadcast(stop)).where(F.col("_stop").isNull() | (place < F.col("_stop"))).drop("_stop")  # one row


def skip_known(feed: DataFrame, known: DataFrame, key: str) -> DataFrame:
    return feed.join(known.select(key).distinct(), key, "left_anti")


def cap(feed: DataFrame, keys: Sequence[str], order: Sequence[Column | str], limit: int) -> DataFrame:
    return feed.withColumn("_n", F.row_number().over(_over(keys, order))).where(F.col("_n") <= limit).drop("_n")


def first_wins(rows: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    return cap(rows, keys, order, 1)


def promo_links(feed: DataFrame, link: str = "norm", section: str = "section", pos: str = "pos", window: int = 10, min_sections: int = 2) -> DataFrame:
    """Links in the first `window` positions of at least `min_sections` sections, with the count."""
    top = feed.where((F.col(pos) < window) & (F.col(link) != ""))
    return top.groupBy(link).agg(F.countDistinct(section).alias("n_sections")).where(F.col("n_sections") >= min_sections)


def without_promos(feed: DataFrame, link: str = "norm", **how) -> DataFrame:
    """Promos go from every position of every section."""
    return feed.join(promo_links(feed, link, **how).select(link), link, "left_anti")


def fold_candidates(feed: DataFrame, limit: int, outlet: str = "outlet_id") -> DataFrame:
    """(outlet, section_ord, pos, norm): the rows that emit_fold() has to look at.

    Those before their section's boundary that are valid and have a key, each key at its first place in the section;
    of an outlet's s-th section the first limit * s of them: the earlier sections emit at most limit * (s - 1) keys
    that this one may have to pass over.  So an outlet of n sections keeps at most limit * n * (n + 1) / 2 rows,
    however long its lists are."""
    place = [outlet, "section_ord"]
    plain = feed.select(outlet, "section_ord", "pos", "norm", F.coalesce("boundary", F.lit(False)).alias("boundary"), F.coalesce("valid", F.lit(False)).alias("valid"))
    firsts = until_boundary(plain, F.col("boundary"), place).where("valid AND norm IS NOT NULL").groupBy(*place, "norm").agg(F.min("pos").alias("pos"))
    sections = firsts.groupBy(outlet).agg(F.array_sort(F.collect_set("section_ord")).alias("_all"))
    ranked = firsts.withColumn("_n", F.row_number().over(_over(place, ["pos"])))
    wanted = met(ranked, sections, [outlet]).where(F.col("_n") <= limit * F.array_position("_all", F.col("section_ord")))
    return wanted.select(*place, "pos", "norm")


def emit_fold(feed: DataFrame, limit: int, outlet: str = "outlet_id") -> DataFrame:
    """What a run emits: sections in order; each until its boundary or `limit` emitted rows; a link
    emitted before, or an invalid row, is passed over and doesn't count.

    feed: (outlet, section_ord, pos, norm, boundary, valid).  A row without a key,
    or of unknown validity, is passed over; an unknown boundary is none.  Whether a
    link counts in a section depends on what earlier sections emitted, so this is a
    fold over an outlet's sorted rows, not a window; fold_candidates() bounds them.
    """
    row = "struct<section_ord:int,pos:int,norm:string>"
    few = fold_candidates(feed, limit, outlet)
    sorted_rows = few.groupBy(outlet).agg(F.sort_array(F.collect_list(F.struct(F.col("section_ord").cast("int"), F.col("pos").cast("int"), F.col("norm").cast("string")).cast(row))).alias("rows"))
    start = f"named_struct('em', cast(array() AS array<{row}>), 'so', -1, 'n', 0)"
    step = f"""
      CASE WHEN if(x.section_ord = c.so, c.n, 0) >= {limit} OR exists(c.em, e -> e.norm = x.norm) THEN c
           ELSE named_struct('em', concat(c.em, array(x)), 'so', x.section_ord, 'n', if(x.section_ord = c.so, c.n, 0) + 1) END"""
    return sorted_rows.select(outlet, F.inline(F.expr(f"aggregate(rows, {start}, (c, x) -> {step}, c -> c.em)")))


def consecutive_outside_stop(rows: DataFrame, keys: Sequence[str], order: str, inside: Column, k: int, hard_stop: Column | None = None,
                             neutral: Column | None = None) -> DataFrame:
    """The inside rows up to the k-th outside row in a run; an inside row ends a run.

    neutral rows neither count nor end a run.  hard_stop ends the list at its row.
    The row at which the list stops is the last that is looked at.
    """
    neutral = F.coalesce(neutral, F.lit(False)) if neutral is not None else F.lit(False)
    marked = rows.withColumn("_in", F.coalesce(inside, F.lit(False)) & ~neutral).withColumn("_out", (~F.col("_in") & ~neutral).cast("int"))
    w = _over(keys, [order]).rowsBetween(Window.unboundedPreceding, 0)
    marked = marked.withColumn("_island", F.sum(F.col("_in").cast("int")).over(w))
    run = F.sum("_out").over(_over([*keys, "_island"], [order]).rowsBetween(Window.unboundedPreceding, 0))
    ends = F.col("_run") >= k
    if hard_stop is not None:
        ends = ends | F.coalesce(hard_stop, F.lit(False))
    marked = marked.withColumn("_run", run).withColumn("_ends", ends)
    stop = F.min(F.when(F.col("_ends"), F.col(order))).over(_over(keys))
    return marked.withColumn("_stop", stop).where(F.col("_in") & (F.col("_stop").isNull() | (F.col(order) <= F.col("_stop")))).drop(
        "_in", "_out", "_island", "_run", "_ends", "_stop"
    )


def page_level_stop(rows: DataFrame, keys: Sequence[str], page: str, inside: Column, k: int, newer: Column | None = None) -> DataFrame:
    """The rows of the pages up to the k-th page in a run without an inside row; a page that
    has a row newer than the range doesn't count."""
    newer = newer if newer is not None else F.lit(False)
    pages = rows.groupBy(*keys, page).agg(F.bool_or(F.coalesce(inside, F.lit(False))).alias("_hit"), F.bool_or(F.coalesce(newer, F.lit(False))).alias("_newer"))
    w = _over(keys, [page]).rowsBetween(Window.unboundedPreceding, 0)
    pages = pages.withColumn("_island", F.sum(F.col("_hit").cast("int")).over(w))
    run = F.sum((~F.col("_hit") & ~F.col("_newer")).cast("int")).over(_over([*keys, "_island"], [page]).rowsBetween(Window.unboundedPreceding, 0))
    pages = pages.withColumn("_run", run)
    stop = pages.where(F.col("_run") >= k).groupBy(*keys).agg(F.min(page).alias("_stop"))
    return rows.join(stop, list(keys), "left").where(F.col("_stop").isNull() | (F.col(page) <= F.col("_stop"))).drop("_stop")


def newest_by_date(feed: DataFrame, keys: Sequence[str], date: str = "date", pos: str = "pos") -> DataFrame:
    """Number a feed by its date strings, the latest first; equal and missing dates keep their order, missing ones last."""
    order = [F.desc(F.coalesce(date, F.lit(""))), F.asc(pos)]
    return feed.withColumn(pos, (F.row_number().over(_over(keys, order)) - 1).cast(feed.schema[pos].dataType))


#: Links that a list page gives at most.
LIST_LIMIT = 40


def list_head(links: DataFrame, keys: Sequence[str], pos: str = "pos", limit: int = LIST_LIMIT) -> DataFrame:
    return cap(links, keys, [pos], limit)


def distinct_raw_links(rows: DataFrame, keys: Sequence[str], order: Sequence[Column | str], link: str = "link") -> DataFrame:
    """The first of each link as it is written, across the pages of a date-range run."""
    return first_wins(rows, [*keys, link], order)


def newest_first(feed: DataFrame, keys: Sequence[str], ident: str, pos: str = "pos") -> DataFrame:
    """Number an oldest-first feed the other way round: its first id is below its last, neither is 0, and there are two rows or more."""
    ends = feed.groupBy(*keys).agg(F.min_by(ident, pos).alias("_first"), F.max_by(ident, pos).alias("_last"), F.count("*").alias("_n"), F.max(pos).alias("_max"))
    turn = (F.col("_n") >= 2) & (F.col("_first") != 0) & (F.col("_last") != 0) & (F.col("_first") < F.col("_last"))
    return feed.join(ends, list(keys)).withColumn(pos, F.when(turn, F.col("_max") - F.col(pos)).otherwise(F.col(pos))).drop("_first", "_last", "_n", "_max")


def recent_ids(rows: DataFrame, ident: str, span: int = 800) -> DataFrame:
    """Rows whose id is at most `span` below the largest."""
    top = rows.agg(F.max(ident).alias("_top"))
    return rows.crossJoin(F.broadcast(top)).where(F.col(ident) >= F.col("_top") - span).drop("_top")  # one row


def advance_checkpoint(feed: DataFrame, emitted: DataFrame, old: DataFrame, boundary: Column, keys: Sequence[str], rule: str = "boundary") -> DataFrame:
    """(keys, link): each section's checkpoint after a run.

    rule `boundary`: the boundary that stopped the section; else the head if
    anything was emitted; else the old one; else the head.  rule `first_new`: the
    first emitted link, else the old one.  rule `head`: the head of the list.
    feed: keys, pos, link; emitted: keys, pos, link; old: keys, checkpoint.
    """
    k = list(keys)
    heads = feed.groupBy(*k).agg(F.min_by("link", "pos").alias("_head"), F.min_by(F.when(boundary, F.col("link")), F.when(boundary, F.col("pos"))).alias("_stopped"))
    new = emitted.groupBy(*k).agg(F.min_by("link", "pos").alias("_new"))
    every = met(met(heads, new, k, "full"), old.select(*k, F.col("checkpoint").alias("_old")), k, "full")
    if rule == "head":
        out = F.coalesce("_head", "_old")
    elif rule == "first_new":
        out = F.coalesce("_new", "_old")
    else:
        out = F.coalesce("_stopped", F.when(F.col("_new").isNotNull(), F.col("_head")), "_old", "_head")
    return every.select(*k, out.alias("link")).where("link IS NOT NULL AND link <> ''")


def caught_up(feed: DataFrame, boundary: Column, keys: Sequence[str]) -> DataFrame:
    """(keys, caught_up): the head of the list is a boundary, so the section has no news and keeps its checkpoint."""
    return feed.groupBy(*keys).agg(F.coalesce(F.min_by(boundary, "pos"), F.lit(False)).alias("caught_up"))


def listed_cards_left(cards: DataFrame, processed: DataFrame, key: str = "link") -> DataFrame:
    """Cards that weren't processed on an earlier look at the page."""
    return cards.join(processed.select(key).distinct(), key, "left_anti")


def range_counts(rows: DataFrame, keys: Sequence[str], inside: Column, image: Column | None = None) -> DataFrame:
    """(keys, in_range, out_of_range, with_image)."""
    hit = F.coalesce(inside, F.lit(False))
    return rows.groupBy(*keys).agg(F.count_if(hit).alias("in_range"), F.count_if(~hit).alias("out_of_range"),
                                   F.count_if(F.coalesce(image, F.lit("")) != "").alias("with_image") if image is not None else F.lit(0).cast("long").alias("with_image"))
