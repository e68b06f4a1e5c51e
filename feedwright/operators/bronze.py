"""Bronze rows: normalised, hashed, de-duplicated articles and their audits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedwright.functions.dates import parse_published, written
from feedwright.functions.text import content_hash, default_text, filled_or_null, first_filled, normalize_link, strip
from feedwright.operators.feeds import first_wins


def bronze_rows(articles: DataFrame, scraped_at: Column, run_id: str | None = None) -> DataFrame:
    """articles: outlet_id and the ARTICLE columns.  Rows without a URL go; a blank title is
    `(no title)`, a blank summary is the description; other blanks are null."""
    title, description = default_text(F.col("title"), "(no title)"), filled_or_null(F.col("description"))
    summary = first_filled(strip(F.col("summary")), description)
    return articles.select(
        normalize_link(F.col("link")).alias("url"), "outlet_id", title.alias("title"), F.nullif(summary, F.lit("")).alias("summary"), description.alias("description"),
        parse_published(F.col("date")).alias("published_at"), filled_or_null(F.col("image_url")).alias("image_url"), filled_or_null(F.col("date_source")).alias("date_source"),
        scraped_at.alias("scraped_at"), F.lit(run_id).cast("string").alias("scrape_run_id"), content_hash(title, summary).alias("content_hash"),
        *[c for c in ("raw_payload", "outlet_ord", "pos") if c in articles.columns],
    ).where("url <> ''")


def first_url_wins(rows: DataFrame, order: Sequence[str] = ("outlet_ord", "pos")) -> DataFrame:
    return first_wins(rows, ["url"], list(order))


def has_content(title: Column, summary: Column, description: Column) -> Column:
    """A title, or a summary or description, that isn't blank."""
    return (strip(F.coalesce(title, F.lit(""))) != "") | (strip(first_filled(summary, description)) != "")


def article_from_content(rows: DataFrame, as_of: Column) -> DataFrame:
    """(title, link, content, image_url, at, label) as article rows: no date is as_of; the summary is the description too."""
    return rows.select(*[c for c in rows.columns if c not in ("content", "at", "label")], F.col("content").alias("summary"), F.col("content").alias("description"),
                       written(F.col("at"), as_of).alias("date"), F.coalesce("label", F.lit("Incremental scrape")).alias("date_source"))


def article_from_metadata(rows: DataFrame, as_of: Column, local: bool = False) -> DataFrame:
    """Rows with full_content, description, summary, at: the text is the first that is filled; a local run falls back to the summary for the description as well."""
    text = first_filled(F.col("full_content"), F.col("description"), F.col("summary"))
    short = first_filled(F.col("description"), *([F.col("summary")] if local else []))
    return rows.withColumns({"summary": text, "description": short, "date": written(F.col("at"), as_of)}).drop("full_content", "at")


def with_hints(links: DataFrame, hints: DataFrame) -> DataFrame:
    """links (norm, story_id, title, description, image_url, at) filled from list-page hints of the URL, else of the
    story; date_source says which.  Of several hints the longest description wins, then the later."""
    value = F.struct(F.length(F.coalesce("list_description", F.lit(""))).alias("n"), F.col("hint_ord"))
    best = lambda key: hints.where(F.col(key).isNotNull() & (F.col(key).cast("string") != "0")).groupBy(key).agg(F.max_by(F.struct("title", "list_description", "list_image", "at"), value).alias("_h"))
    by_url = best("norm").withColumnRenamed("_h", "_u")
    by_story = best("story_id").withColumnRenamed("_h", "_s")
    met = links.join(by_url, "norm", "left").join(by_story, "story_id", "left").withColumn("_h", F.coalesce("_u", "_s"))
    source = F.when(F.col("at").isNotNull(), "Article page").when(F.col("_h.at").isNotNull(), "List page fallback").otherwise("Incremental scrape")
    return met.withColumns({
        "title": first_filled(F.col("title"), F.col("_h.title")), "description": first_filled(F.col("description"), F.col("_h.list_description")),
        "image_url": first_filled(F.col("image_url"), F.col("_h.list_image")), "date_source": source, "at": F.coalesce("at", "_h.at"),
    }).drop("_u", "_s", "_h")


def with_feed_rows(links: DataFrame, feed: DataFrame, short: int = 200) -> DataFrame:
    """links (norm) with the feed's row of the same URL; refetch says that its text is missing or short."""
    side = feed.withColumn("norm", normalize_link(F.col("link"))).groupBy("norm").agg(F.max_by(F.struct("title", "summary", "date", "image_url"), -F.col("pos")).alias("f"))
    return links.join(side, "norm", "left").select(links["*"], "f.*", (F.length(F.coalesce("f.summary", F.lit(""))) < short).alias("refetch"))


def changed_rows(bronze: DataFrame, new: DataFrame) -> DataFrame:
    """New versions of known URLs whose content hash differs."""
    return new.join(bronze.select("url", F.col("content_hash").alias("_old")), "url").where("content_hash <> _old").drop("_old")


def run_totals(articles: DataFrame, bronze: DataFrame) -> DataFrame:
    """articles_in, articles_out in one row."""
    return articles.agg(F.count("*").alias("articles_in")).crossJoin(bronze.agg(F.count("*").alias("articles_out")))  # one row each


def constraint_audit(table: str, rows: DataFrame, required: Sequence[str] = (), unique: Sequence[str] = (), allowed: dict[str, Sequence[str]] | None = None,
                     references: dict[str, tuple[DataFrame, str]] | None = None) -> DataFrame:
    """(table_name, check_name, violations): NOT NULL, CHECK IN, UNIQUE and foreign keys (null refers to nothing)."""
    out = []
    flat = [F.count_if(F.col(c).isNull()).alias(f"not_null:{c}") for c in required] + [F.count_if(~F.col(c).isin(*v)).alias(f"check:{c}") for c, v in (allowed or {}).items()]
    if flat:
        one = rows.agg(*flat)
        pairs = ", ".join(f"'{c}', `{c}`" for c in one.columns)
        out.append(one.select(F.expr(f"stack({len(one.columns)}, {pairs}) AS (check_name, violations)")))
    for c in unique:
        out.append(rows.where(F.col(c).isNotNull()).groupBy(c).count().agg(F.count_if(F.col("count") > 1).alias("violations")).select(F.lit(f"unique:{c}").alias("check_name"), "violations"))
    for c, (other, key) in (references or {}).items():
        lost = rows.where(F.col(c).isNotNull()).join(other.select(F.col(key).alias(c)).distinct(), c, "left_anti")
        out.append(lost.agg(F.count("*").alias("violations")).select(F.lit(f"foreign_key:{c}").alias("check_name"), "violations"))
    every = out[0]
    for more in out[1:]:
        every = every.unionByName(more)
    return every.select(F.lit(table).alias("table_name"), "check_name", F.col("violations").cast("long").alias("violations"))
