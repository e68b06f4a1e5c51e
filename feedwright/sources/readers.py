"""Readers of landed feeds: JSON batches, checkpoints, RSS, post APIs and page grids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedwright.functions.dates import parse_rfc822, written
from feedwright.functions.html import first_image_src, unescape, until_promo, without_boilerplate
from feedwright.functions.text import feed_link, first_filled, strip
from feedwright.operators.state import CHECKPOINT
from feedwright.sources.registry import NO_BATCH, Outlet

ARTICLE = ("title string, link string, summary string, description string, date string, image_url string, date_source string, "
           "section string, author string, rss_categories array<string>, guid string")
_ARTICLE_ROW = f"array<struct<{', '.join(f.replace(' ', ':', 1) for f in ARTICLE.split(', '))}>>"
POSTS = ("array<struct<id:bigint,title:struct<rendered:string>,link:string,date:string,excerpt:struct<rendered:string>,"
         "content:struct<rendered:string>,jetpack_featured_media_url:string>>")


def articles_in(documents: DataFrame, body: str = "body") -> DataFrame:
    """Article rows with pos from JSON-array texts; what isn't an array, and elements that aren't objects, give no rows."""
    keep = [c for c in documents.columns if c != body]
    is_list = F.rlike(F.col(body), F.lit(r"^\s*\["))
    parts = documents.where(is_list).select(*keep, F.posexplode(F.from_json(body, "array<string>")).alias("pos", "_one"))
    objects = parts.where(F.rlike("_one", F.lit(r"^\s*\{")))
    return objects.select(*keep, "pos", F.from_json("_one", _ARTICLE_ROW[6:-1]).alias("_a"), F.col("_one").alias("raw_payload")).select(*keep, "pos", "_a.*", "raw_payload")


def batch_rejects(documents: DataFrame, body: str = "body") -> DataFrame:
    """pos, reason, record of what articles_in() leaves out: texts that are no arrays (pos null), elements that are no
    objects or can't be read."""
    keep = [c for c in documents.columns if c != body]
    parts = F.from_json(body, "array<string>")
    whole = documents.where(~F.coalesce(F.rlike(F.col(body), F.lit(r"^\s*\[")) & parts.isNotNull(), F.lit(False))).select(*keep, F.lit(None).cast("int").alias("pos"), F.lit("no array").alias("reason"), F.col(body).alias("record"))
    each = documents.where(F.rlike(F.col(body), F.lit(r"^\s*\["))).select(*keep, F.posexplode(parts).alias("pos", "record"))
    unread = F.from_json("record", f"{ARTICLE}, _malformed string", {"columnNameOfCorruptRecord": "_malformed"})["_malformed"].isNotNull()
    reason = F.when(~F.coalesce(F.rlike("record", F.lit(r"^\s*\{")), F.lit(False)), "no object").when(unread, "malformed")
    return whole.unionByName(each.select(*keep, "pos", reason.alias("reason"), "record").where("reason IS NOT NULL"))


def read_batches(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Article rows of batch files, each file one JSON array; unreadable ones give no rows."""
    files = spark.read.text(paths, wholetext=True).select(F.col("value").alias("body"), F.col("_metadata.file_name").alias("data_file"))
    return articles_in(files)


def read_checkpoints(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row per checkpoint file; what isn't a JSON object gives no row."""
    files = spark.read.text(paths, wholetext=True).where(F.rlike("value", F.lit(r"^\s*\{")))
    return files.select(F.col("_metadata.file_name").alias("data_file"), F.from_json("value", CHECKPOINT).alias("c")).select("data_file", "c.*")


def recovered_rss(body: Column) -> Column:
    """The feed inside a page that a browser rendered around it."""
    whole = F.regexp_extract(body, r"(?is)(<\?xml.*</rss>)", 1)
    return first_filled(whole, F.regexp_extract(body, r"(?is)(<rss.*)$", 1))


#: An RSS item; the names are those of RSS 2.0 and its usual namespaces.
_ITEM = ("title string, link string, description string, `content:encoded` string, pubDate string, `media:thumbnail` struct<_url:string>, `media:content` array<struct<_url:string>>, "
         "enclosure struct<_url:string,_type:string>, `dc:creator` string, category array<string>, guid string, _malformed string")


def _item_texts(documents: DataFrame, body: str) -> DataFrame:
    keep = [c for c in documents.columns if c != body]
    items = F.regexp_extract_all(F.coalesce(body, F.lit("")), F.lit(r"(?is)(<item[\s/>].*?</item\s*>)"), 1)
    return documents.select(*keep, F.posexplode(items).alias("pos", "_i"))


def read_rss(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """data_file, pos, body: the items of landed feeds, one a row.

    Files are cut at the ends of items, so a feed of any length is read in splits and never stands in one row."""
    lines = spark.read.option("lineSep", "</item>").text(paths)
    rows = lines.select(F.col("_metadata.file_name").alias("data_file"), F.col("_metadata.file_block_start").alias("_at"), F.monotonically_increasing_id().alias("_n"),
                        F.concat(F.regexp_extract("value", r"(?s)(<item[\s/>].*)$", 1), F.lit("</item>")).alias("body")).where("body <> '</item>'")
    w = Window.partitionBy("data_file").orderBy("_at", "_n")
    return rows.select("data_file", (F.row_number().over(w) - 1).alias("pos"), "body")


def _parsed_items(items: DataFrame) -> DataFrame:
    """Items (_i) as _p, a struct of _ITEM; one that is no XML has its text in _p._malformed."""
    return items.withColumn("_p", F.from_xml("_i", _ITEM, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_malformed"}))


def rss_rejects(documents: DataFrame, body: str = "body") -> DataFrame:
    """pos, reason, record of the items that rss_items() leaves out: malformed ones, and those without a link."""
    items = _parsed_items(_item_texts(documents, body))
    reason = F.when(F.col("_p._malformed").isNotNull(), "malformed").when(feed_link(F.coalesce("_p.link", F.lit(""))) == "", "no link")
    return items.withColumn("reason", reason).where("reason IS NOT NULL").withColumnRenamed("_i", "record").drop("_p")


def rss_items(documents: DataFrame, body: str = "body", as_of: Column | None = None) -> DataFrame:
    """Rows of RSS 2.0 texts (whole feeds, or the items of read_rss()), fields paired within each item; malformed items and
    those without a link are dropped (see rss_rejects).

    Items are read as XML: CDATA, entities, attributes, nested markup and namespaced names as it has them.  The pubDate's
    zone is dropped; without a date it is as_of."""
    keep = [c for c in documents.columns if c not in (body, "pos")]
    rows = _parsed_items(_item_texts(documents.drop("pos") if "pos" not in documents.columns else documents.withColumnRenamed("pos", "_pos"), body))
    rows = rows.where("_p._malformed IS NULL")
    pos = F.col("_pos") if "_pos" in rows.columns else F.col("pos")
    text_of = lambda name: strip(F.coalesce(F.col(f"_p.`{name}`"), F.lit("")))
    picture = F.when(F.startswith("_p.enclosure._type", F.lit("image")), F.col("_p.enclosure._url"))
    content, short, at = text_of("content:encoded"), text_of("description"), parse_rfc822(text_of("pubDate"))
    plain = lambda markup: without_boilerplate(F.regexp_replace(until_promo(markup), r"(?s)<[^>]*>", " "))
    return rows.select(
        *keep, pos.alias("pos"), strip(unescape(text_of("title"))).alias("title"), feed_link(text_of("link")).alias("link"),
        plain(first_filled(content, short)).alias("summary"), plain(first_filled(short, content)).alias("description"), written(at, as_of).alias("date"),
        first_filled(F.col("_p.`media:thumbnail`._url"), F.get(F.col("_p.`media:content`._url"), 0), picture, first_image_src(content), first_image_src(short)).alias("image_url"),
        F.when(at.isNotNull(), "RSS: pubDate").otherwise("RSS: missing").alias("date_source"), F.nullif(strip(unescape(text_of("dc:creator"))), F.lit("")).alias("author"),
        F.transform(F.coalesce("_p.category", F.array().cast("array<string>")), strip).alias("rss_categories"), F.nullif(text_of("guid"), F.lit("")).alias("guid"),
    ).where("link <> ''")


def post_items(documents: DataFrame, body: str = "body", as_of: Column | None = None) -> DataFrame:
    """Rows of a post API's JSON arrays (nested rendered fields); posts without a link are dropped."""
    keep = [c for c in documents.columns if c != body]
    rows = documents.select(*keep, F.posexplode(F.from_json(body, POSTS)).alias("pos", "p"))
    plain = lambda c: without_boilerplate(unescape(F.regexp_replace(until_promo(F.coalesce(c, F.lit(""))), r"(?s)<[^>]*>", " ")))
    at = F.try_to_timestamp(F.col("p.date"), F.lit("yyyy-M-d'T'H:m:s"))
    return rows.select(
        *keep, "pos", plain(F.col("p.title.rendered")).alias("title"), feed_link(F.col("p.link")).alias("link"),
        first_filled(plain(F.col("p.content.rendered")), plain(F.col("p.excerpt.rendered"))).alias("summary"),
        first_filled(plain(F.col("p.excerpt.rendered")), plain(F.col("p.content.rendered"))).alias("description"),
        written(at, as_of).alias("date"), first_filled(F.col("p.jetpack_featured_media_url"), first_image_src(F.col("p.content.rendered"))).alias("image_url"),
        F.when(at.isNotNull(), "WP-API: date").otherwise("WP-API: missing").alias("date_source"),
    ).where("link <> ''")


def existing_batches(spark: SparkSession, folder: str, names: Sequence[str]) -> list[str]:
    """The paths of those files that are there; missing ones are skipped, and so are files that are no batches."""
    jvm = spark._jvm
    out = []
    for name in names:
        path = jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{name}")
        named = name.endswith(".json") and not any(part in name for part in NO_BATCH)
        if named and path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(path):
            out.append(str(path))
    return out


def read_outlets(spark: SparkSession, folder: str, targets: Sequence[Outlet]) -> DataFrame:
    """Article rows of the outlets' batch files with outlet_id and outlet_ord, the order of the targets."""
    paths = existing_batches(spark, folder, [o.data_file for o in targets])
    if not paths:
        return spark.createDataFrame([], "data_file string, pos int, " + ARTICLE + ", raw_payload string, outlet_id string, outlet_ord int")
    by_file = spark.createDataFrame([(o.data_file, o.id, i) for i, o in enumerate(targets)], "data_file string, outlet_id string, outlet_ord int")
    return read_batches(spark, paths).join(F.broadcast(by_file), "data_file")  # a row per outlet


def source_order(ci: bool) -> tuple[str, str]:
    """Which reading of a feed comes first: the feed itself on CI, list pages elsewhere; the other is the fallback."""
    return ("feed", "pages") if ci else ("pages", "feed")


def by_preference(feed: DataFrame, pages: DataFrame, ci: bool, keys: Sequence[str] = ("outlet_id",)) -> DataFrame:
    named = {"feed": feed, "pages": pages}
    return preferred_source(*[named[n] for n in source_order(ci)], keys=keys)


def preferred_source(*sources: DataFrame, keys: Sequence[str] = ("outlet_id",)) -> DataFrame:
    """Of several readings of the same feeds, each feed's first that has rows."""
    every = None
    for i, s in enumerate(sources):
        tagged = s.withColumn("_prio", F.lit(i))
        every = tagged if every is None else every.unionByName(tagged, allowMissingColumns=True)
    best = every.groupBy(*keys).agg(F.min("_prio").alias("_best"))
    return every.join(best, list(keys)).where("_prio = _best").drop("_prio", "_best")


def date_grid(spark: SparkSession, start: str, end: str, categories: Sequence[str], base: str, newest_first: bool = False) -> DataFrame:
    """date_ord, cat_ord, day, category, url: every day of the range in every category; /yymmdd/category addresses."""
    days = spark.range(1).select(F.posexplode(F.expr(f"sequence(date'{start}', date'{end}')")).alias("date_ord", "day"))
    if newest_first:
        days = days.select((F.datediff(F.lit(end), "day")).alias("date_ord"), "day")
    grid = days.crossJoin(F.broadcast(spark.createDataFrame(list(enumerate(categories)), "cat_ord int, category string")))  # days x categories, both given
    return grid.select("date_ord", "cat_ord", "day", "category", F.concat(F.lit(base.rstrip("/") + "/"), F.date_format("day", "yyMMdd"), F.lit("/"), "category").alias("url"))


def page_urls(feeds: DataFrame, pages: int, style: str = "path", step: int = 30) -> DataFrame:
    """Add page and page_url to feeds (url): /page/N/, ?page=N, or /N*step for `offset`; the first page is the url."""
    n = F.explode(F.sequence(F.lit(1), F.lit(pages)))
    url = F.regexp_replace("url", r"/+$", "")
    shape = {"path": F.concat(url, F.lit("/page/"), F.col("page"), F.lit("/")), "query": F.concat(url, F.lit("?page="), F.col("page")), "offset": F.concat(url, F.lit("/"), (F.col("page") - 1) * step)}[style]
    return feeds.withColumn("page", n).withColumn("page_url", F.when(F.col("page") == 1, F.col("url")).otherwise(shape))


#: Pages that a paginated list is followed for at most, by the shape of its addresses (fixed values).
MAX_PAGES = {"query": 8, "offset": 10, "path": 20}


def paginated(feeds: DataFrame, style: str) -> DataFrame:
    """page_urls() up to the most pages of that shape."""
    return page_urls(feeds, MAX_PAGES[style], style)
