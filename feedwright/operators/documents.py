"""Checkpoint documents as they are stored: one row per outlet, its sections a map from end to end.

Columns: outlet_id and those of state.CHECKPOINT.  What a run does to its
checkpoint is an expression on that one row, so nothing is shuffled but where
two sets of documents meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedwright.functions.text import normalize_link
from feedwright.operators.state import CHECKPOINT

_SECTION = "struct<last_scraped_link:string,last_scraped_title:string>"
_SECTIONS = f"map<string,{_SECTION}>"
_NONE = f"cast(map() AS {_SECTIONS})"


def _sections() -> Column:
    return F.coalesce("sections", F.expr(_NONE))


def _given(link: Column) -> Column:
    return F.coalesce(link, F.lit("")) != ""


def documents_of(state: DataFrame) -> DataFrame:
    """State rows (see operators.state) as documents: the row without a section is the outlet's own.  Of rows of one key the
    last updated stands, of those the largest link."""
    rows = state.groupBy("outlet_id", "section").agg(F.max_by(F.struct(F.col("link").alias("last_scraped_link"), F.col("title").alias("last_scraped_title")), F.struct("updated_at", "link")).cast(_SECTION).alias("c"), F.max("updated_at").alias("at"))
    own = F.max(F.when(F.col("section").isNull(), F.col("c")))
    parts = F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("section").isNotNull(), F.struct("section", "c")))))
    docs = rows.groupBy("outlet_id").agg(own.alias("g"), F.max("at").alias("updated_at"), parts.alias("sections"))
    return docs.select("outlet_id", "g.*", "updated_at", F.col("sections").cast(_SECTIONS).alias("sections"))


def merged(old: DataFrame, new: DataFrame) -> DataFrame:
    """old documents with what new ones give: a link that is given replaces, one that isn't keeps what was there.  Outlets
    of either side stay; updated_at is the new document's where it gives anything."""
    left, right = old.alias("o"), new.alias("n")
    met = left.join(right, F.col("o.outlet_id").eqNullSafe(F.col("n.outlet_id")), "full")
    gives = _given(F.col("n.last_scraped_link"))
    part = lambda c: F.when(gives, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c)
    either = F.map_zip_with(F.coalesce("o.sections", F.expr(_NONE)), F.coalesce("n.sections", F.expr(_NONE)), lambda _, a, b: F.when(_given(b["last_scraped_link"]), b).otherwise(F.coalesce(a, b)))
    some = gives | F.exists(F.map_values(F.coalesce("n.sections", F.expr(_NONE))), lambda s: _given(s["last_scraped_link"]))
    at = F.when(F.coalesce(some, F.lit(False)), F.coalesce("n.updated_at", "o.updated_at")).otherwise(F.coalesce("o.updated_at", "n.updated_at"))
    return met.select(F.coalesce("o.outlet_id", "n.outlet_id").alias("outlet_id"), part("last_scraped_link"), part("last_scraped_title"), at.alias("updated_at"), either.alias("sections"))


def migrated(docs: DataFrame, keys: Column) -> DataFrame:
    """Documents none of whose sections has a link give their own link to each section of `keys` (an array)."""
    none = ~F.exists(F.map_values(_sections()), lambda s: _given(s["last_scraped_link"]))
    fill = F.map_from_entries(F.transform(F.array_distinct(keys), lambda k: F.struct(k, F.struct("last_scraped_link", "last_scraped_title").cast(_SECTION))))
    others = F.map_filter(_sections(), lambda k, _: ~F.array_contains(keys, k))
    return docs.withColumn("sections", F.when(none & _given(F.col("last_scraped_link")), F.map_concat(others, fill)).otherwise(_sections()))


def pruned(docs: DataFrame, keys: Column) -> DataFrame:
    """Only the sections of `keys` stay."""
    return docs.withColumn("sections", F.map_filter(_sections(), lambda k, _: F.array_contains(keys, k)))


def cleared(docs: DataFrame) -> DataFrame:
    """Sections that repeat the document's own link go, where two or more do."""
    own = normalize_link(F.col("last_scraped_link"))
    kept = F.map_filter(_sections(), lambda _, s: ~F.coalesce((normalize_link(s["last_scraped_link"]) == F.col("_own")) & (F.col("_own") != ""), F.lit(False)))
    many = F.size("_kept") <= F.size(_sections()) - 2
    return docs.withColumn("_own", own).withColumn("_kept", kept).withColumn("sections", F.when(many, F.col("_kept")).otherwise(_sections())).drop("_own", "_kept")


def bootstraps(docs: DataFrame, keys: Column) -> DataFrame:
    """(outlet_id, bootstrap): none of the sections of `keys` has a link, also where there is no section at all.  Ask after
    migrated()."""
    asked = F.map_filter(_sections(), lambda k, s: F.array_contains(keys, k) & _given(s["last_scraped_link"]))
    return docs.select("outlet_id", (F.size(asked) == 0).alias("bootstrap"))


def write_documents(docs: DataFrame, path: str) -> None:
    """One JSON document per outlet, in a folder of its own; only the folders of these outlets are replaced.  Sections
    without a link, and null values, aren't written.  Outlets must differ; one without an id isn't written."""
    given = F.map_filter(_sections(), lambda _, s: _given(s["last_scraped_link"]))
    body = F.to_json(F.struct("last_scraped_link", "last_scraped_title", "updated_at", given.alias("sections")))
    rows = docs.where("outlet_id IS NOT NULL").select("outlet_id", body.alias("value"))
    rows.repartition("outlet_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("outlet_id").text(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """What write_documents() wrote."""
    rows = spark.read.schema("value string, outlet_id string").text(path)
    return rows.select("outlet_id", F.from_json("value", CHECKPOINT).alias("c")).select("outlet_id", "c.*")
