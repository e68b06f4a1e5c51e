"""Checkpoint state: one row per (outlet_id, section) and one global row per outlet (section null).

Columns: outlet_id, section, link, title, updated_at."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedwright.functions.text import article_id, first_filled, normalize_link

CHECKPOINT = ("last_scraped_link string, last_scraped_title string, updated_at string, "
              "sections map<string,struct<last_scraped_link:string,last_scraped_title:string>>")


def state_rows(documents: DataFrame) -> DataFrame:
    """Checkpoint documents (outlet_id and the CHECKPOINT columns) as state rows."""
    whole = documents.select("outlet_id", F.lit(None).cast("string").alias("section"), F.col("last_scraped_link").alias("link"), F.col("last_scraped_title").alias("title"), "updated_at")
    parts = documents.select("outlet_id", "updated_at", F.explode("sections").alias("section", "s")).select(
        "outlet_id", "section", F.col("s.last_scraped_link").alias("link"), F.col("s.last_scraped_title").alias("title"), "updated_at")
    return whole.unionByName(parts)


def _sections(state: DataFrame) -> DataFrame:
    return state.where("section IS NOT NULL")


def _globals(state: DataFrame) -> DataFrame:
    return state.where("section IS NULL")


def migrate_global(state: DataFrame, keys: DataFrame) -> DataFrame:
    """Give the global link to every section key (outlet_id, section) of an outlet none of whose sections has a link."""
    having = _sections(state).where("coalesce(link, '') <> ''").select("outlet_id").distinct()
    source = _globals(state).where("coalesce(link, '') <> ''").join(having, "outlet_id", "left_anti")
    new = keys.select("outlet_id", "section").join(source.drop("section"), "outlet_id").select(*state.columns)
    return state.join(new.select("outlet_id", "section"), ["outlet_id", "section"], "left_anti").unionByName(new)


def migrate_by_url(state: DataFrame, section: Column) -> DataFrame:
    """Give an outlet that has no section yet the one that its global link's address names.

    section: of the column `link`, null where the address names none."""
    having = _sections(state).select("outlet_id").distinct()
    source = _globals(state).where("coalesce(link, '') <> ''").join(having, "outlet_id", "left_anti")
    new = source.withColumn("section", section).where("section IS NOT NULL")
    return state.unionByName(new.select(*state.columns))


def clear_global_bleed(state: DataFrame) -> DataFrame:
    """Drop the sections that repeat the global link, where two or more do."""
    g = _globals(state).select("outlet_id", normalize_link(F.col("link")).alias("_g")).where("_g <> ''")
    same = _sections(state).join(g, "outlet_id").where(normalize_link(F.coalesce("link", F.lit(""))) == F.col("_g")).select("outlet_id", "section")
    many = same.groupBy("outlet_id").count().where("count >= 2").select("outlet_id")
    return state.join(same.join(many, "outlet_id", "left_semi"), ["outlet_id", "section"], "left_anti")


def prune_sections(state: DataFrame, canonical: DataFrame) -> DataFrame:
    """Keep the global rows and the canonical (outlet_id, section) keys."""
    kept = _sections(state).join(canonical.select("outlet_id", "section").distinct(), ["outlet_id", "section"], "left_semi")
    return _globals(state).unionByName(kept.select(*state.columns))


def merge_updates(state: DataFrame, updates: DataFrame, as_of: Column) -> DataFrame:
    """updates: outlet_id, section, link, title.  Updates without a link are ignored; others replace, stamped as_of."""
    new = updates.where("coalesce(link, '') <> ''").select("outlet_id", "section", "link", "title", as_of.cast("string").alias("updated_at"))
    keys = new.select(F.col("outlet_id").alias("o"), F.col("section").alias("s"))
    kept = state.join(keys, (state.outlet_id == F.col("o")) & state.section.eqNullSafe(F.col("s")), "left_anti")
    return kept.unionByName(new)


def missing_sections(keys: DataFrame, updates: DataFrame) -> DataFrame:
    return keys.select("outlet_id", "section").join(updates.select("outlet_id", "section"), ["outlet_id", "section"], "left_anti")


def global_checkpoint(state: DataFrame, batch: DataFrame) -> DataFrame:
    """(outlet_id, link): the state's global link, else the first row of the outlet's batch (outlet_id, pos, link); none means bootstrap."""
    g = _globals(state).select("outlet_id", F.nullif("link", F.lit("")).alias("_g"))
    first = batch.groupBy("outlet_id").agg(F.min_by("link", "pos").alias("_b"))
    return g.join(first, "outlet_id", "full").select("outlet_id", F.coalesce("_g", "_b").alias("link")).where("link IS NOT NULL")


def is_bootstrap(state: DataFrame) -> DataFrame:
    """(outlet_id, bootstrap): no section has a link; an outlet that only has a global row has none."""
    given = F.col("section").isNotNull() & (F.coalesce(F.col("link"), F.lit("")) != "")
    return state.groupBy("outlet_id").agg((~F.bool_or(given)).alias("bootstrap"))


def date_key(link: Column) -> Column:
    """yyyymmdd of a dated path as a number; null without one."""
    part = lambda i: F.regexp_extract(link, r"/(20\d{2})/(\d{1,2})/(\d{1,2})(?:/|$)", i).try_cast("int")
    return part(1) * 10000 + part(2) * 100 + part(3)


def sync_global(state: DataFrame, preferred: Sequence[str] = ()) -> DataFrame:
    """(outlet_id, link, title): the section link with the largest article id; else the latest dated
    path; else the first preferred section, then the first by name.  The first of equals wins."""
    place = F.coalesce(F.array_position(F.array(*map(F.lit, preferred)), F.col("section")), F.lit(0)) if preferred else F.lit(0)
    order = F.struct(F.when(place > 0, place).otherwise(1 << 30).alias("p"), F.col("section"))
    ranked = _sections(state).where("coalesce(link, '') <> ''").select(
        "outlet_id", F.struct("link", "title").alias("v"), article_id(F.col("link")).alias("i"), date_key(F.col("link")).alias("d"), order.alias("o"))
    best = lambda key: F.min_by("v", F.when(F.col(key) > 0, F.struct(-F.col(key), F.col("o"))))
    return ranked.groupBy("outlet_id").agg(F.coalesce(best("i"), best("d"), F.min_by("v", "o")).alias("v")).select("outlet_id", "v.*")


def seed_from_heads(keys: DataFrame, state: DataFrame, heads: DataFrame) -> DataFrame:
    """(outlet_id, section, link): a section without a checkpoint starts at its current head, so its first run emits nothing."""
    k = ["outlet_id", "section"]
    old = _sections(state).select(*k, F.nullif("link", F.lit("")).alias("_old"))
    return keys.select(*k).join(old, k, "left").join(heads.select(*k, F.col("link").alias("_head")), k, "left").select(*k, F.coalesce("_old", "_head").alias("link")).where("link IS NOT NULL")


def repair_links(state: DataFrame, repaired: Column) -> DataFrame:
    """Replace links by their canonical form (of a redirect, say)."""
    return state.withColumn("link", F.coalesce(repaired, F.col("link")))


def checkpoint_title(links: DataFrame, emitted: DataFrame, sections: DataFrame, stored: DataFrame) -> DataFrame:
    """links (norm) with a title: from the new rows, then the section's own, then the stored batch (each norm, title
    and, if it has an order, pos: the first title of a link wins, without an order the least)."""
    out = links
    for i, side in enumerate((emitted, sections, stored)):
        out = out.join(side.groupBy("norm").agg(F.min_by("title", F.when(F.col("title").isNotNull(), F.col("pos") if "pos" in side.columns else F.col("title"))).alias(f"_t{i}")), "norm", "left")
    return out.withColumn("title", first_filled(F.col("_t0"), F.col("_t1"), F.col("_t2"))).drop("_t0", "_t1", "_t2")


def known_links(batch: DataFrame, archive: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Distinct normalised links of the previous batch, the archive and the checkpoints (each has link)."""
    every = batch.select("link").union(archive.select("link")).union(checkpoints.select("link"))
    return every.select(normalize_link(F.col("link")).alias("norm")).where("norm <> ''").distinct()
