"""The registered queries and their SQL twins.

Stand-ins of the feeds in the driver's tables: an outlet is `documents.source`, an
article is a document (title: its first line), a feed is a user's events of one
type, newest first; a sectioned list is a conversation.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedwright.functions import dates, html, text
from feedwright.operators import bronze, feeds, state, stories
from feedwright.sources import readers, registry, sinks
from feedwright.sources.keyed import KeyedTable

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_NORM = r"""lower(regexp_extract({0}, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) || '://' || lower(regexp_extract({0}, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1))
  || coalesce(nullif(regexp_replace(regexp_replace(regexp_extract({0}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), ';[^/]*$', ''), '/+$', ''), ''), '/')"""
_N = _NORM.format("url")

# --- URLs ---------------------------------------------------------------------------------


@query(f"SELECT page_id, {_N} AS norm FROM pages")
def normalize_links(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.normalize_link(F.col("url")).alias("norm"))


@query(r"""SELECT page_id, regexp_replace(url, '^http://', 'https://') AS https,
  regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', '') || '/' AS feed_link FROM pages""")
def canonical_https(spark, sf):
    url = F.col("url")
    return table(spark, sf, "pages").select("page_id", text.https_variant(url).alias("https"), text.feed_link(url).alias("feed_link"))


_IDS = "'https://x.example/a/' || (page_id % 7) || '-' || page_id"


@query(rf"""WITH u AS (SELECT page_id, {_IDS} AS story, 'https://x.example/article/' || page_id || '/t' AS art, regexp_replace(url, '[?#].*$', '') AS url FROM pages)
  SELECT page_id, coalesce(try_cast(nullif(regexp_extract(story, '/(\d+)-(\d+)$', 2), '') AS BIGINT), 0) AS story_id,
    coalesce(try_cast(nullif(regexp_extract(art, '/article/(\d+)', 1), '') AS BIGINT), 0) AS article_id,
    coalesce(try_cast(nullif(regexp_extract(story || '/', '-(\d+)/?$', 1), '') AS BIGINT), 0) AS post_id,
    coalesce(try_cast(nullif(regexp_extract(url, '/article/(\d+)', 1), '') AS BIGINT), 0) AS none_id FROM u""")
def url_ids(spark, sf):
    p = table(spark, sf, "pages").withColumn("story", F.concat(F.lit("https://x.example/a/"), F.col("page_id") % 7, F.lit("-"), F.col("page_id")))
    return p.select("page_id", text.story_id(F.col("story")).alias("story_id"),
                    text.article_id(F.concat(F.lit("https://x.example/article/"), "page_id", F.lit("/t"))).alias("article_id"),
                    text.post_id(F.concat("story", F.lit("/"))).alias("post_id"), text.article_id(F.regexp_replace("url", r"[?#].*$", "")).alias("none_id"))


SECTION_HINTS = (("/en/", "english"), ("/de/", "german"), ("/fr/", "french"), ("/es/", "spanish"))


@query(r"""WITH u AS (SELECT page_id, url, lower(regexp_extract(url, '^[^:]*://[^/]*/([^/?#]+)', 1)) AS seg FROM pages)
  SELECT page_id, CASE WHEN contains(url, '/en/') THEN 'english' WHEN contains(url, '/de/') THEN 'german' WHEN contains(url, '/fr/') THEN 'french'
    WHEN contains(url, '/es/') THEN 'spanish' END AS section, CASE WHEN seg IN ('en', 'de') THEN seg END AS slug FROM u""")
def url_sections(spark, sf):
    dated = F.concat(F.lit("https://x.example/2026/06/4/"), F.regexp_extract("url", r"^[^:]*://[^/]*/([^/?#]+)", 1), F.lit("/1/"))
    return table(spark, sf, "pages").select("page_id", text.needle_section(F.col("url"), SECTION_HINTS).alias("section"), text.dated_path_section(dated, ("en", "de")).alias("slug"))


@query(f"""WITH r AS (SELECT page_id, url, html, {_N} AS norm FROM pages), f AS (SELECT *, row_number() OVER (PARTITION BY norm ORDER BY page_id) AS n FROM r)
  SELECT regexp_extract(norm, '://([^/]*)', 1) AS host, count(*) AS n_pages, min(sha256(norm || chr(10) || coalesce(html, ''))) AS first_hash FROM f WHERE n = 1 GROUP BY 1""")
def pages_per_host(spark, sf):
    p = table(spark, sf, "pages").select("page_id", "html", text.normalize_link(F.col("url")).alias("norm"))
    kept = feeds.first_wins(p.withColumn("h", text.content_hash(F.col("norm"), F.col("html"))).drop("html"), ["norm"], ["page_id"])
    return kept.groupBy(F.regexp_extract("norm", "://([^/]*)", 1).alias("host")).agg(F.count("*").alias("n_pages"), F.min("h").alias("first_hash"))


@query(r"""SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'https://news.example/plain/' || page_id ELSE regexp_replace(url, '^https?://[^/]*', 'https://www.outlet.example') END AS target FROM pages""")
def redirect_targets(spark, sf):
    """Links wrapped as a redirect's base64url payload, and unwrapped again; other links stay what they are."""
    clean = F.regexp_replace("url", r"^https?://[^/]*", "https://www.outlet.example")
    payload = F.translate(F.base64(F.encode(F.concat(F.lit("\x08\x13\""), clean), "UTF-8")), "+/=\r\n", "-_")
    wrapped = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("https://news.example/plain/"), "page_id")).otherwise(F.concat(F.lit("https://news.example/rss/articles/"), payload, F.lit("?oc=5")))
    return table(spark, sf, "pages").select("page_id", text.redirect_target(wrapped, "outlet.example").alias("target"))


# --- texts --------------------------------------------------------------------------------


def _articles(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", "source", "lang", "text", F.regexp_extract("text", r"^([^\n]*)", 1).alias("title"))


_TITLE = r"regexp_extract(text, '^([^\n]*)', 1)"


@query(f"SELECT doc_id, sha256({_TITLE} || chr(10) || text) AS content_hash FROM documents")
def content_hashes(spark, sf):
    return _articles(spark, sf).select("doc_id", text.content_hash(F.col("title"), F.col("text")).alias("content_hash"))


@query(rf"""SELECT doc_id, lower(trim({_TITLE})) AS key, CASE WHEN source = 'src0' THEN 'url:https://outlet.example/' || doc_id
  WHEN trim({_TITLE}) <> '' THEN 'title:' || lower(trim({_TITLE})) ELSE 'url:https://other.example/' || doc_id END AS composite FROM documents""")
def title_keys(spark, sf):
    a = _articles(spark, sf).withColumn("suffixed", F.concat("title", F.lit(" | Outlet Name")))
    link = F.concat(F.when(F.col("source") == "src0", "https://outlet.example/").otherwise("https://other.example/"), F.col("doc_id"))
    return a.select("doc_id", text.title_key(F.col("suffixed"), "Outlet Name").alias("key"), text.composite_key(link, F.col("suffixed"), "outlet.example", "Outlet Name").alias("composite"))


@query("""SELECT doc_id, CASE WHEN length(text) > 500 THEN substr(text, 1, 500) ELSE text END AS short, CASE WHEN length(text) > 2000 THEN substr(text, 1, 2000) || '...' ELSE text END AS marked,
  regexp_replace(text, '[^\\x00-\\x7F]', '', 'g') AS ascii FROM documents""".replace("\\\\", "\\"))
def truncate_bodies(spark, sf):
    t = F.col("text")
    return table(spark, sf, "documents").select("doc_id", text.truncate(t, 500).alias("short"), text.truncate(t, 2000, "...").alias("marked"), text.ascii_only(t).alias("ascii"))


@query(f"""SELECT doc_id, coalesce(nullif(trim(CASE WHEN doc_id % 3 = 0 THEN '  ' ELSE {_TITLE} END), ''), '(no title)') AS title FROM documents
  WHERE trim(CASE WHEN doc_id % 3 = 0 THEN '  ' ELSE {_TITLE} END) <> '' OR trim(CASE WHEN doc_id % 2 = 0 THEN '' ELSE text END, chr(10) || ' ') <> ''""")
def blank_filter(spark, sf):
    title = F.when(F.col("doc_id") % 3 == 0, "  ").otherwise(F.col("title"))
    summary = F.when(F.col("doc_id") % 2 == 0, "").otherwise(F.col("text"))
    return _articles(spark, sf).where(bronze.has_content(title, summary, F.lit(None).cast("string"))).select("doc_id", text.default_text(title, "(no title)").alias("title"))


# --- dates --------------------------------------------------------------------------------

_FORMS = ("MMMM d, yyyy", "d MMMM yyyy", "yyyy-MM-dd", "dd-MM-yyyy", "MM/dd/yyyy")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 5 THEN NULL ELSE date_trunc('day', o_orderdate)::TIMESTAMP END AS generic,
  date_trunc('second', o_orderdate)::TIMESTAMP AS published, date_trunc('minute', o_orderdate)::TIMESTAMP AS listed,
  date_trunc('minute', o_orderdate)::TIMESTAMP AS barred, date_trunc('second', o_orderdate)::TIMESTAMP AS rfc FROM orders""")
def parse_dates(spark, sf):
    at, k = F.col("o_orderdate"), F.col("o_orderkey") % 6
    form = F.lit("Unknown")
    for i, p in enumerate(_FORMS):
        form = F.when(k == i, F.date_format(at, p)).otherwise(form)
    fmt = lambda p: F.date_format(at, p)
    return table(spark, sf, "orders").select(
        "o_orderkey", dates.parse_generic(form).alias("generic"), dates.parse_published(F.concat(fmt("yyyy-MM-dd'T'HH:mm:ss"), F.lit("+05:30"))).alias("published"),
        dates.parse_weekday_time(F.concat(F.lit("Monday, "), fmt("d MMMM yyyy HH:mm"))).alias("listed"), dates.parse_bar_date(fmt("dd MMM, yyyy '|' hh:mm a")).alias("barred"),
        dates.parse_rfc822(F.concat(F.lit("Tue, "), fmt("dd MMM yyyy HH:mm:ss"), F.lit(" +0530"))).alias("rfc"))


_AS_OF = "2024-02-01 00:00:00"


@query(f"""WITH e AS (SELECT event_id, event_id % 40 + 1 AS n, event_id % 6 AS u FROM events)
  SELECT event_id, TIMESTAMP '{_AS_OF}' - to_seconds(n * CASE u WHEN 0 THEN 60 WHEN 1 THEN 3600 WHEN 2 THEN 86400 WHEN 3 THEN 604800 WHEN 4 THEN 2592000 ELSE 31536000 END) AS relative,
    CASE WHEN u < 5 THEN TIMESTAMP '{_AS_OF}' - to_seconds(n * CASE u WHEN 0 THEN 60 WHEN 1 THEN 3600 WHEN 2 THEN 86400 WHEN 3 THEN 604800 ELSE 2592000 END) END AS sinhala FROM e""")
def relative_dates(spark, sf):
    units = F.array(*map(F.lit, dates.UNITS))
    sinhala = F.array(*[F.lit(n) for n, _ in dates.SINHALA_UNITS], F.lit("?"))
    n, u, as_of = F.col("event_id") % 40 + 1, (F.col("event_id") % 6).cast("int"), F.lit(_AS_OF).cast("timestamp")
    written = F.concat(n, F.lit(" "), F.get(units, u), F.lit("s ago"))
    return table(spark, sf, "events").select("event_id", dates.relative_date(written, as_of).alias("relative"),
                                             dates.sinhala_relative_date(F.concat(F.get(sinhala, u), F.lit("තු "), n), as_of).alias("sinhala"))


_DATED = "CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderdate END"


@query(f"""SELECT o_orderkey, coalesce(({_DATED})::DATE BETWEEN DATE '1995-01-01' AND DATE '1996-12-31', false) AS strict,
  coalesce(({_DATED})::DATE BETWEEN DATE '1995-01-01' AND DATE '1996-12-31', true) AS lenient FROM orders""")
def date_ranges(spark, sf):
    at = F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderdate"))
    low, high = F.lit("1995-01-01").cast("date"), F.lit("1996-12-31").cast("date")
    return table(spark, sf, "orders").select("o_orderkey", dates.in_range(at, low, high).alias("strict"), dates.in_range(at, low, high, undated=True).alias("lenient"))


# --- bronze -------------------------------------------------------------------------------


@query(rf"""SELECT 'https://' || source || '.example/a/' || doc_id AS url, source AS outlet_id, coalesce(nullif(trim({_TITLE}), ''), '(no title)') AS title, doc_id,
  sha256(coalesce(nullif(trim({_TITLE}), ''), '(no title)') || chr(10) || trim(CASE WHEN doc_id % 2 = 0 THEN '' ELSE lang END || CASE WHEN doc_id % 2 = 0 THEN source ELSE '' END)) AS content_hash,
  CASE WHEN doc_id % 5 = 0 THEN NULL ELSE (DATE '2024-01-01' + (doc_id % 28)::INTEGER)::TIMESTAMP END AS published_at FROM documents""")
def bronze_rows(spark, sf):
    a = _articles(spark, sf).select(
        "doc_id", F.col("source").alias("outlet_id"), F.concat(F.lit("HTTPS://"), "source", F.lit(".Example/a/"), "doc_id", F.lit("/?x=1#f")).alias("link"), "title",
        F.when(F.col("doc_id") % 2 == 0, " ").otherwise(F.col("lang")).alias("summary"), F.col("source").alias("description"),
        F.when(F.col("doc_id") % 5 == 0, "Unknown").otherwise(F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 28).cast("int")), "yyyy-MM-dd")).alias("date"),
        F.lit("").alias("image_url"), F.lit("RSS: pubDate").alias("date_source"), F.col("doc_id").alias("pos"))
    rows = bronze.bronze_rows(a, F.lit("2024-02-01").cast("timestamp"))
    return rows.select("url", "outlet_id", "title", F.col("pos").alias("doc_id"), "content_hash", "published_at")


@query(f"""WITH u AS (SELECT 0 AS o, page_id, url FROM pages UNION ALL SELECT 1, page_id, regexp_replace(url, '[?#].*$', '') || '?again=1' FROM pages),
  n AS (SELECT o, page_id, {_N} AS url FROM u), f AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY o, page_id) AS k FROM n) SELECT url, o AS outlet_ord, page_id AS pos FROM f WHERE k = 1""")
def bronze_dedupe(spark, sf):
    p = table(spark, sf, "pages").select(F.lit(0).alias("outlet_ord"), F.col("page_id").alias("pos"), "url")
    again = p.select(F.lit(1).alias("outlet_ord"), "pos", F.concat(F.regexp_replace("url", r"[?#].*$", ""), F.lit("?again=1")).alias("url"))
    return bronze.first_url_wins(p.unionByName(again).withColumn("url", text.normalize_link(F.col("url")))).select("url", "outlet_ord", "pos")


@query("SELECT source AS outlet_id, count(*) AS articles, count(*) FILTER (WHERE length(text) > 1000) AS long_articles, count(DISTINCT lang) AS languages FROM documents GROUP BY 1")
def outlet_counts(spark, sf):
    return table(spark, sf, "documents").groupBy(F.col("source").alias("outlet_id")).agg(F.count("*").alias("articles"), F.count_if(F.length("text") > 1000).alias("long_articles"), F.countDistinct("lang").alias("languages"))


@query("SELECT (SELECT count(*) FROM documents) AS articles_in, (SELECT count(DISTINCT text) FROM documents) AS articles_out")
def run_totals(spark, sf):
    d = table(spark, sf, "documents")
    return bronze.run_totals(d, d.select(F.sha2("text", 256).alias("h")).distinct())


@query("""SELECT language, outlet, n FROM (SELECT lang AS language, source AS outlet, count(*) AS n FROM documents GROUP BY ROLLUP (lang, source))""")
def dashboard_rollup(spark, sf):
    return table(spark, sf, "documents").rollup(F.col("lang").alias("language"), F.col("source").alias("outlet")).agg(F.count("*").alias("n"))


@query("""WITH v AS (SELECT doc_id AS k, 0 AS run, text FROM documents UNION ALL SELECT doc_id, 1, lang FROM documents WHERE doc_id % 3 = 0 UNION ALL SELECT doc_id + 10000000, 1, source FROM documents WHERE doc_id % 5 = 0),
  r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY run DESC) AS n FROM v) SELECT k AS url_id, run, sha256(text) AS hash FROM r WHERE n = 1""")
def upsert_last_wins(spark, sf):
    d = table(spark, sf, "documents")
    old = d.select(F.col("doc_id").alias("url_id"), F.lit(0).alias("run"), F.sha2("text", 256).alias("hash"))
    new = d.where("doc_id % 3 = 0").select(F.col("doc_id").alias("url_id"), F.lit(1).alias("run"), F.sha2("lang", 256).alias("hash")).unionByName(
        d.where("doc_id % 5 = 0").select((F.col("doc_id") + 10000000).alias("url_id"), F.lit(1).alias("run"), F.sha2("source", 256).alias("hash")))
    return sinks.upserted(old, new, "url_id", ["run"])


@query("""WITH a AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id DESC) - 1 AS pos FROM documents), fresh AS (SELECT source, doc_id, pos, 0 AS b FROM a WHERE pos < 10),
  every AS (SELECT * FROM fresh UNION ALL SELECT source, doc_id, pos, 1 FROM a WHERE pos >= 5 AND doc_id NOT IN (SELECT doc_id FROM fresh)),
  r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY b, pos) AS n FROM every) SELECT source, doc_id, n - 1 AS pos FROM r WHERE n <= 2000""")
def merge_archive(spark, sf):
    w = Window.partitionBy("source").orderBy(F.desc("doc_id"))
    a = table(spark, sf, "documents").select("source", "doc_id", F.concat(F.lit("https://x.example/"), "doc_id").alias("link"), (F.row_number().over(w) - 1).alias("pos"))
    return sinks.merged_archive(a.where("pos < 10"), a.where("pos >= 5"), ["source"]).select("source", "doc_id", F.col("pos").cast("long").alias("pos"))


@query("""SELECT 'customer' AS table_name, c AS check_name, v AS violations FROM (
  SELECT 'not_null:c_name' AS c, count(*) FILTER (WHERE c_name IS NULL) AS v FROM customer UNION ALL SELECT 'check:c_mktsegment', count(*) FILTER (WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')) FROM customer
  UNION ALL SELECT 'unique:c_custkey', count(*) FROM (SELECT c_custkey FROM customer GROUP BY 1 HAVING count(*) > 1)
  UNION ALL SELECT 'foreign_key:c_nationkey', count(*) FROM customer WHERE c_nationkey IS NOT NULL AND c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 4))""")
def fk_audit(spark, sf):
    nation = table(spark, sf, "nation").where("n_regionkey < 4")
    return bronze.constraint_audit("customer", table(spark, sf, "customer"), ["c_name"], ["c_custkey"], {"c_mktsegment": ["BUILDING", "MACHINERY"]}, {"c_nationkey": (nation, "n_nationkey")})


# --- feeds --------------------------------------------------------------------------------


def _feed(spark: SparkSession, sf: str) -> DataFrame:
    w = Window.partitionBy("user_id", "event_type").orderBy(F.desc("ts"), F.desc("event_id"))
    e = table(spark, sf, "events").withColumn("pos", F.row_number().over(w) - 1)
    return e.select(F.col("user_id").alias("outlet_id"), F.col("event_type").alias("section"), "pos", "event_id", "ts", F.concat(F.lit("https://feed.example/article/"), "event_id").alias("link"))


_FEED = """f AS (SELECT user_id AS outlet_id, event_type AS section, event_id, ts, 'https://feed.example/article/' || event_id AS link,
  (row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) - 1)::INTEGER AS pos FROM events)"""


@query(f"""WITH {_FEED}, s AS (SELECT *, min(pos) FILTER (WHERE event_id % 17 = 0) OVER (PARTITION BY outlet_id, section) AS stop FROM f)
  SELECT outlet_id, section, pos, event_id FROM s WHERE stop IS NULL OR pos < stop""")
def feed_until_checkpoint(spark, sf):
    return feeds.until_boundary(_feed(spark, sf), F.col("event_id") % 17 == 0, ["outlet_id", "section"]).select("outlet_id", "section", "pos", "event_id")


@query(f"WITH {_FEED} SELECT outlet_id, section, pos, event_id FROM f WHERE event_id NOT IN (SELECT doc_id FROM labels)")
def feed_skip_known(spark, sf):
    known = table(spark, sf, "labels").select(F.col("doc_id").alias("event_id"))
    return feeds.skip_known(_feed(spark, sf), known, "event_id").select("outlet_id", "section", "pos", "event_id")


@query(f"""WITH {_FEED}, c AS (SELECT outlet_id, section, max(event_id) FILTER (WHERE event_id % 5 = 0) AS cp FROM f GROUP BY 1, 2),
  s AS (SELECT f.*, min(pos) FILTER (WHERE cp > 0 AND event_id > 0 AND event_id <= cp) OVER (PARTITION BY f.outlet_id, f.section) AS stop FROM f JOIN c ON f.outlet_id = c.outlet_id AND f.section = c.section)
  SELECT outlet_id, section, pos, event_id FROM s WHERE stop IS NULL OR pos < stop""")
def feed_stop_numeric_id(spark, sf):
    f = _feed(spark, sf)
    cp = f.groupBy("outlet_id", "section").agg(F.max(F.when(F.col("event_id") % 5 == 0, F.col("event_id"))).alias("cp"))
    met = f.join(cp, ["outlet_id", "section"]).withColumn("id", text.article_id(F.col("link")))
    return feeds.until_boundary(met, F.expr("cp > 0 AND id > 0 AND id <= cp"), ["outlet_id", "section"]).select("outlet_id", "section", "pos", "event_id")


@query("""WITH s AS (SELECT conv_id, turn, role FROM conversations), b AS (SELECT conv_id AS c, turn AS t FROM s WHERE conv_id % 50 = 49 AND turn >= 1 ORDER BY 1, 2 LIMIT 1)
  SELECT conv_id, turn, role FROM s WHERE NOT EXISTS (SELECT 1 FROM b) OR EXISTS (SELECT 1 FROM b WHERE (conv_id, turn) < (c, t))""")
def feed_global_stop(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", "turn", "role")
    return feeds.until_global_boundary(c, (F.col("conv_id") % 50 == 49) & (F.col("turn") >= 1), ["conv_id", "turn"])


@query(f"WITH {_FEED} SELECT outlet_id, section, pos, event_id FROM f WHERE pos < 15")
def section_cap(spark, sf):
    return feeds.cap(_feed(spark, sf), ["outlet_id", "section"], ["pos"], 15).select("outlet_id", "section", "pos", "event_id")


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY lower(text) ORDER BY conv_id, turn) AS n FROM conversations) SELECT conv_id, turn, role FROM r WHERE n = 1""")
def first_wins_run(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", "turn", "role", F.sha2(F.lower("text"), 256).alias("norm"))
    return feeds.first_wins(c, ["norm"], ["conv_id", "turn"]).select("conv_id", "turn", "role")


@query(r"""WITH RECURSIVE r AS (SELECT conv_id // 10 AS o, (conv_id % 10)::INTEGER AS so, turn::INTEGER AS pos, lower(regexp_extract(text, '(\S+)\s*$', 1)) AS norm, length(text) % 11 = 0 AS b, length(text) % 7 <> 0 AS v,
    row_number() OVER (PARTITION BY conv_id // 10 ORDER BY conv_id % 10, turn) AS k FROM conversations),
  f AS (SELECT DISTINCT o, 0::BIGINT AS k, CAST([] AS VARCHAR[]) AS seen, -1 AS so, false AS stop, 0 AS n, false AS out, 0 AS pos, '' AS norm FROM r UNION ALL
    SELECT o, k, CASE WHEN emit THEN list_append(seen, norm) ELSE seen END, so, CASE WHEN skip OR b THEN true WHEN emit THEN n0 + 1 >= 3 ELSE false END, n0 + emit::INTEGER, emit, pos, norm FROM (
      SELECT *, NOT skip AND NOT b AND v AND NOT list_contains(seen, norm) AS emit FROM (
        SELECT r.*, f.seen, r.so = f.so AND f.stop AS skip, CASE WHEN r.so = f.so THEN f.n ELSE 0 END AS n0 FROM f JOIN r ON r.o = f.o AND r.k = f.k + 1)))
  SELECT o AS outlet_id, so AS section_ord, pos, norm FROM f WHERE out""")
def fold_emit(spark, sf):
    """Conversations as sectioned lists of an outlet (their first role and length), links by their last word."""
    c = table(spark, sf, "conversations").select(
        F.floor(F.col("conv_id") / 10).alias("outlet_id"), (F.col("conv_id") % 10).cast("int").alias("section_ord"), F.col("turn").cast("int").alias("pos"),
        F.lower(F.regexp_extract("text", r"(\S+)\s*$", 1)).alias("norm"), (F.length("text") % 11 == 0).alias("boundary"), (F.length("text") % 7 != 0).alias("valid"))
    return feeds.emit_fold(c, 3)


_PROMO = "c AS (SELECT conv_id, turn, lower(regexp_extract(text, '^(\\S+)', 1)) AS norm FROM conversations)"


@query(f"WITH {_PROMO} SELECT norm, count(DISTINCT conv_id) AS n_sections FROM c WHERE turn < 10 AND norm <> '' GROUP BY 1 HAVING count(DISTINCT conv_id) >= 2")
def promo_links(spark, sf):
    return feeds.promo_links(_lists(spark, sf), "norm", "conv_id", "turn")


@query(f"""WITH {_PROMO}, p AS (SELECT norm FROM c WHERE turn < 10 AND norm <> '' GROUP BY 1 HAVING count(DISTINCT conv_id) >= 2) SELECT conv_id, turn, norm FROM c WHERE norm NOT IN (SELECT norm FROM p)""")
def promo_free_lists(spark, sf):
    return feeds.without_promos(_lists(spark, sf), "norm", section="conv_id", pos="turn").select("conv_id", "turn", "norm")


def _lists(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "conversations").select("conv_id", "turn", F.lower(F.regexp_extract("text", r"^(\S+)", 1)).alias("norm"))


@query("""WITH o AS (SELECT o_custkey, o_orderkey, o_orderdate::DATE AS d, (o_orderdate::DATE BETWEEN DATE '1994-01-01' AND DATE '1999-12-31')::INTEGER AS inr FROM orders),
  i AS (SELECT *, sum(inr) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) AS isl FROM o),
  r AS (SELECT *, sum(1 - inr) OVER (PARTITION BY o_custkey, isl ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) AS run FROM i),
  s AS (SELECT *, min(o_orderkey) FILTER (WHERE run >= 2) OVER (PARTITION BY o_custkey) AS stop FROM r) SELECT o_custkey, o_orderkey FROM s WHERE inr = 1 AND (stop IS NULL OR o_orderkey <= stop)""")
def consecutive_outside_stop(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    inside = dates.in_range(F.col("o_orderdate"), F.lit("1994-01-01").cast("date"), F.lit("1999-12-31").cast("date"))
    return feeds.consecutive_outside_stop(o, ["o_custkey"], "o_orderkey", inside, 2).select("o_custkey", "o_orderkey")


@query("""WITH o AS (SELECT o_custkey, o_orderkey, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 3 AS page, year(o_orderdate) AS y FROM orders),
  p AS (SELECT o_custkey, page, bool_or(y BETWEEN 1994 AND 1995) AS hit, bool_or(y > 1999) AS newer FROM o GROUP BY 1, 2),
  i AS (SELECT *, sum(hit::INTEGER) OVER (PARTITION BY o_custkey ORDER BY page ROWS UNBOUNDED PRECEDING) AS isl FROM p),
  r AS (SELECT *, sum((NOT hit AND NOT newer)::INTEGER) OVER (PARTITION BY o_custkey, isl ORDER BY page ROWS UNBOUNDED PRECEDING) AS run FROM i),
  s AS (SELECT o_custkey, min(page) AS stop FROM r WHERE run >= 2 GROUP BY 1) SELECT o.o_custkey, o_orderkey, page FROM o LEFT JOIN s ON o.o_custkey = s.o_custkey WHERE stop IS NULL OR page <= stop""")
def page_level_stop(spark, sf):
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", F.year("o_orderdate").alias("y"), F.floor((F.row_number().over(w) - 1) / 3).alias("page"))
    return feeds.page_level_stop(o, ["o_custkey"], "page", F.col("y").between(1994, 1995), 2, F.col("y") > 1999).select("o_custkey", "o_orderkey", "page")


@query("""WITH l AS (SELECT conv_id, turn, length(text) AS id FROM conversations), e AS (SELECT conv_id, arg_min(id, turn) AS f, arg_max(id, turn) AS l, count(*) AS n, max(turn) AS m FROM l GROUP BY 1)
  SELECT l.conv_id, l.turn AS original, CASE WHEN n >= 2 AND f <> 0 AND e.l <> 0 AND f < e.l THEN m - turn ELSE turn END AS pos FROM l JOIN e ON l.conv_id = e.conv_id""")
def orient_feed(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", F.col("turn").alias("original"), F.col("turn").alias("pos"), F.length("text").alias("id"))
    return feeds.newest_first(c, ["conv_id"], "id").select("conv_id", "original", "pos")


@query("SELECT doc_id, source FROM documents WHERE doc_id >= (SELECT max(doc_id) FROM documents) - 800")
def recency_by_id(spark, sf):
    return feeds.recent_ids(table(spark, sf, "documents").select("doc_id", "source"), "doc_id")


@query("WITH r AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id DESC) AS n FROM documents) SELECT source, doc_id, n::INTEGER AS n FROM r WHERE n <= 10")
def latest_per_outlet(spark, sf):
    w = Window.partitionBy("source").orderBy(F.desc("doc_id"))
    return table(spark, sf, "documents").select("source", "doc_id", F.row_number().over(w).alias("n")).where("n <= 10")


_STATE = f"""{_FEED}, o AS (SELECT outlet_id, section, max_by(link, pos) AS cp FROM f WHERE pos <= 8 GROUP BY 1, 2 HAVING section <> 'view')"""
_ADVANCE = f"""WITH {_STATE}, m AS (SELECT f.*, cp, f.event_id % 13 = 0 AS b FROM f LEFT JOIN o ON f.outlet_id = o.outlet_id AND f.section = o.section),
  s AS (SELECT *, min(pos) FILTER (WHERE b) OVER (PARTITION BY outlet_id, section) AS stop FROM m), e AS (SELECT * FROM s WHERE (stop IS NULL OR pos < stop) AND pos < 4)"""


def _advance(spark: SparkSession, sf: str, rule: str) -> DataFrame:
    f = _feed(spark, sf)
    k = ["outlet_id", "section"]
    old = f.where("pos <= 8 AND section <> 'view'").groupBy(*k).agg(F.max_by("link", "pos").alias("checkpoint"))
    hit = F.col("event_id") % 13 == 0
    emitted = feeds.until_boundary(f, hit, k).where("pos < 4")
    return feeds.advance_checkpoint(f, emitted, old, hit, k, rule)


@query(_ADVANCE + """, h AS (SELECT outlet_id, section, arg_min(link, pos) AS head, arg_min(link, pos) FILTER (WHERE b) AS stopped, max(cp) AS old FROM s GROUP BY 1, 2),
  n AS (SELECT outlet_id, section, count(*) AS c FROM e GROUP BY 1, 2) SELECT h.outlet_id, h.section, coalesce(stopped, CASE WHEN c > 0 THEN head END, old, head) AS link
  FROM h LEFT JOIN n ON h.outlet_id = n.outlet_id AND h.section = n.section""")
def advance_checkpoint(spark, sf):
    return _advance(spark, sf, "boundary")


@query(_ADVANCE + """, h AS (SELECT outlet_id, section, max(cp) AS old FROM s GROUP BY 1, 2), n AS (SELECT outlet_id, section, arg_min(link, pos) AS new FROM e GROUP BY 1, 2)
  SELECT h.outlet_id, h.section, coalesce(new, old) AS link FROM h LEFT JOIN n ON h.outlet_id = n.outlet_id AND h.section = n.section WHERE coalesce(new, old) IS NOT NULL""")
def first_new_checkpoint(spark, sf):
    return _advance(spark, sf, "first_new")


@query(f"WITH {_FEED} SELECT outlet_id, section, arg_min(link, pos) AS link FROM f GROUP BY 1, 2")
def head_checkpoint(spark, sf):
    return _advance(spark, sf, "head")


# --- state --------------------------------------------------------------------------------


def _state(spark: SparkSession, sf: str) -> DataFrame:
    """One outlet per user; a section's link is its newest event; every third user's sections repeat the global link."""
    f = _feed(spark, sf).where("pos = 0")
    g = f.groupBy("outlet_id").agg(F.max_by("link", "event_id").alias("g"))
    parts = f.join(g, "outlet_id").select(F.col("outlet_id").cast("string").alias("outlet_id"), "section", F.when(F.col("outlet_id") % 3 == 0, F.col("g")).when(F.col("outlet_id") % 5 == 1, "").otherwise(F.col("link")).alias("link"))
    whole = g.select(F.col("outlet_id").cast("string").alias("outlet_id"), F.lit(None).cast("string").alias("section"), F.col("g").alias("link"))
    return whole.unionByName(parts).withColumn("title", F.lit("t")).withColumn("updated_at", F.lit("2024-01-01T00:00:00+00:00"))


_ST = f"""{_FEED}, h AS (SELECT * FROM f WHERE pos = 0), g AS (SELECT outlet_id, max_by(link, event_id) AS g FROM h GROUP BY 1),
  st AS (SELECT outlet_id::VARCHAR AS outlet_id, NULL AS section, g AS link FROM g UNION ALL SELECT h.outlet_id::VARCHAR, section,
    CASE WHEN h.outlet_id % 3 = 0 THEN g WHEN h.outlet_id % 5 = 1 THEN '' ELSE link END FROM h JOIN g ON h.outlet_id = g.outlet_id)"""


@query(f"""WITH {_ST}, x AS (SELECT s.outlet_id, s.section FROM st s JOIN st g ON s.outlet_id = g.outlet_id AND g.section IS NULL AND s.section IS NOT NULL AND s.link = g.link),
  m AS (SELECT outlet_id FROM x GROUP BY 1 HAVING count(*) >= 2)
  SELECT outlet_id, section, link FROM st WHERE section IS NULL OR outlet_id NOT IN (SELECT outlet_id FROM m) OR (outlet_id, section) NOT IN (SELECT outlet_id, section FROM x)""")
def clear_bleed(spark, sf):
    return state.clear_global_bleed(_state(spark, sf)).select("outlet_id", "section", "link")


@query(f"""WITH {_ST}, k AS (SELECT DISTINCT outlet_id, section FROM st WHERE section IS NOT NULL), w AS (SELECT DISTINCT outlet_id FROM st WHERE section IS NOT NULL AND link <> ''),
  n AS (SELECT k.outlet_id, k.section, st.link FROM k JOIN st ON k.outlet_id = st.outlet_id AND st.section IS NULL WHERE k.outlet_id NOT IN (SELECT outlet_id FROM w))
  SELECT outlet_id, section, link FROM st WHERE section IS NULL OR (outlet_id, section) NOT IN (SELECT outlet_id, section FROM n) UNION ALL SELECT * FROM n""")
def migrate_global(spark, sf):
    s = _state(spark, sf)
    return state.migrate_global(s, s.where("section IS NOT NULL").select("outlet_id", "section").distinct()).select("outlet_id", "section", "link")


@query(f"""WITH {_ST}, i AS (SELECT outlet_id, section, link, try_cast(nullif(regexp_extract(link, '/article/(\\d+)', 1), '') AS BIGINT) AS id FROM st WHERE section IS NOT NULL AND link <> '')
  SELECT outlet_id, link FROM (SELECT *, row_number() OVER (PARTITION BY outlet_id ORDER BY id DESC, section) AS n FROM i) WHERE n = 1""")
def max_id_checkpoint(spark, sf):
    return state.sync_global(_state(spark, sf)).select("outlet_id", "link")


@query(f"WITH {_ST} SELECT outlet_id, section, CASE WHEN section = 'click' THEN 'https://new.example/' || outlet_id ELSE link END AS link FROM st WHERE section IS NULL OR section IN ('click', 'purchase')")
def state_merge(spark, sf):
    s = _state(spark, sf)
    kept = state.prune_sections(s, s.where("section IN ('click', 'purchase')").select("outlet_id", "section"))
    new = s.where("section = 'click'").select("outlet_id", "section", F.concat(F.lit("https://new.example/"), "outlet_id").alias("link"), "title")
    return state.merge_updates(kept, new, F.lit("2024-02-01T00:00:00+00:00")).select("outlet_id", "section", "link")


@query("""SELECT 'known' AS kind, k AS id FROM (SELECT doc_id AS k FROM labels UNION SELECT event_id FROM events) UNION ALL SELECT 'missing', doc_id FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels)""")
def state_set_ops(spark, sf):
    ids = table(spark, sf, "labels").select(F.col("doc_id").alias("id"))
    known = ids.union(table(spark, sf, "events").select("event_id")).distinct()
    missing = table(spark, sf, "documents").select(F.col("doc_id").alias("id")).exceptAll(ids).distinct()
    return known.select(F.lit("known").alias("kind"), "id").unionByName(missing.select(F.lit("missing").alias("kind"), "id"))


# --- sources ------------------------------------------------------------------------------


@query("""SELECT strftime(d, '%Y-%m-%d') AS day, c.c AS category, 'https://x.example/' || strftime(d, '%y%m%d') || '/' || c.c AS url FROM generate_series(DATE '2024-01-30', DATE '2024-02-02', INTERVAL 1 DAY) t(d), (SELECT DISTINCT event_type AS c FROM events) c""")
def date_grid(spark, sf):
    kinds = [r[0] for r in table(spark, sf, "events").select("event_type").distinct().orderBy("event_type").collect()]  # a handful of types
    return readers.date_grid(spark, "2024-01-30", "2024-02-02", kinds, "https://x.example/").select(F.col("day").cast("string").alias("day"), "category", "url")


@query("SELECT event_id, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_props(spark, sf):
    return table(spark, sf, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query(r"""SELECT doc_id // 50 AS outlet_id, (row_number() OVER (PARTITION BY doc_id // 50 ORDER BY doc_id) - 1)::INTEGER AS pos, doc_id, sha256(text) AS text_hash FROM documents""")
def json_batches(spark, sf):
    """Documents packed into JSON arrays, 50 to a batch, and read back as article rows."""
    d = table(spark, sf, "documents").select(F.floor(F.col("doc_id") / 50).alias("outlet_id"), F.struct("doc_id", F.to_json(F.struct(F.col("doc_id").cast("string").alias("guid"), F.col("text").alias("summary"))).alias("j")).alias("s"))
    packed = d.groupBy("outlet_id").agg(F.concat(F.lit("["), F.array_join(F.transform(F.array_sort(F.collect_list("s")), lambda s: s["j"]), ","), F.lit(", 7, null]")).alias("body"))
    a = readers.articles_in(packed)
    return a.select("outlet_id", "pos", F.col("guid").cast("long").alias("doc_id"), F.sha2("summary", 256).alias("text_hash"))


# --- pages --------------------------------------------------------------------------------


#: Entities in the pages, & last; tags parted from text.
_PLAIN = "{0}"
for _entity, _char in (("&copy;", "©"), ("&middot;", "·"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#x27;", "''"), ("&#39;", "''"), ("&amp;", "&")):
    _PLAIN = f"replace({_PLAIN}, '{_entity}', '{_char}')"
_PIECES = r"list_filter(list_transform(string_split(regexp_replace({0}, '(?s)<[^>]*>', chr(1), 'g'), chr(1)), lambda t: trim(" + _PLAIN.format("t") + r", chr(10) || ' ')), lambda t: t <> '')"
_HEADING = r"regexp_replace(trim(" + _PLAIN.format(r"regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)") + r"), '\s+', ' ', 'g')"
_WITHOUT = r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?s)<script.*?</script>', chr(2), 'g'), '(?s)<style.*?</style>', chr(2), 'g'), '(?s)<title>.*?</title>', chr(2), 'g'), '(?s)<!--.*?-->', chr(2), 'g')"


@query(rf"SELECT page_id, {_HEADING} AS title, html LIKE '%<meta property=%' AS has_meta FROM pages")
def html_titles(spark, sf):
    return table(spark, sf, "pages").select("page_id", html.title_of(F.col("html")).alias("title"), F.coalesce(html.page_meta("html")["og:title"].isNotNull(), F.lit(False)).alias("has_meta"))


@query(rf"""WITH a AS (SELECT page_id, html, list_filter(list_transform(string_split(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '<p>')[2:],
    lambda p: array_to_string({_PIECES.format("regexp_replace(p, '(?s)</p>.*$', '')")}, ' ')), lambda p: p IS NOT NULL) AS p FROM pages),
  b AS (SELECT *, array_to_string(list_filter(p, lambda x, i: list_position(p, x) = i), chr(10) || chr(10)) AS joined,
    array_to_string(list_filter(string_split(array_to_string({_PIECES.format("replace(" + _WITHOUT + ", chr(2), '<x>')")}, chr(10)), chr(10)), lambda x: length(x) > 20), chr(10) || chr(10)) AS lines FROM a)
  SELECT page_id, {_HEADING} AS heading, p AS paragraphs, CASE WHEN length(joined) > 100 THEN joined WHEN length(lines) > 100 THEN lines ELSE '' END AS body FROM b""")
def html_text_blocks(spark, sf):
    """Heading, paragraphs and body text from the document's structure; script and chrome don't count."""
    p = table(spark, sf, "pages")
    return p.select("page_id", html.page_heading("html").alias("heading"), html.paragraphs_in(F.col("html"), ("article",)).alias("paragraphs"), html.body_text(F.col("html")).alias("body"))


@query(r"""WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href, generate_subscripts(regexp_extract_all(html, '<a href="([^"]*)"', 1), 1) - 1 AS pos FROM pages)
  SELECT page_id, pos::INTEGER AS pos, href FROM l""")
def html_links(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.inline(html.page_links("html"))).select("page_id", "pos", "href")


@query(r"""WITH a AS (SELECT page_id, len(regexp_extract_all(html, '<a href="', 0)) AS n, list_transform(regexp_extract_all(regexp_replace(regexp_replace(regexp_replace(html,
    '(?s)<nav.*?</nav>', '', 'g'), '(?s)<footer.*?</footer>', '', 'g'), '(?s)<header.*?</header>', '', 'g'), '<a href="([^"]*)"', 1), lambda x: regexp_replace(x, '(?s)[?#].*$', '')) AS l FROM pages)
  SELECT page_id, list_filter(l, lambda x, i: list_position(l, x) = i) AS links, n::INTEGER AS all_links FROM a""")
def html_content_links(spark, sf):
    return table(spark, sf, "pages").select("page_id", html.content_links(F.col("html")).alias("links"), F.size(html.page_links("html")).alias("all_links"))


@query("""SELECT page_id, length(html) < 2000 OR contains(lower(substr(html, 1, 8000)), 'just a moment') OR contains(lower(substr(html, 1, 8000)), 'enable javascript and cookies') AS blocked,
  length(html) >= 500 AND contains(substr(html, 1, 8000), '<?xml') AS xml FROM pages""")
def block_page_flag(spark, sf):
    return table(spark, sf, "pages").select("page_id", html.is_block_page(F.col("html"), 2000).alias("blocked"), html.valid_body(F.col("html"), "xml").alias("xml"))


# --- stories ------------------------------------------------------------------------------


def _stories(spark: SparkSession, sf: str) -> DataFrame:
    return _articles(spark, sf).select(F.col("doc_id").alias("id"), F.col("lang").alias("language"), F.col("doc_id").alias("at"), "title", "source")


_WORDS = r"list_sort(list_distinct(list_filter(regexp_split_to_array(lower(regexp_extract(text, '^([^\n]*)', 1)), '[^\p{L}\p{N}]+'), lambda w: w <> '')))"
_PAIRS = rf"""d AS (SELECT doc_id AS id, lang, source, {_WORDS} AS w FROM documents),
  p AS (SELECT a.id AS a, b.id AS b, len(list_intersect(a.w, b.w)) AS s, len(a.w) + len(b.w) AS n FROM d a JOIN d b ON a.lang = b.lang AND a.id < b.id AND b.id - a.id <= 48 WHERE len(a.w) > 0 AND len(b.w) > 0),
  j AS (SELECT a, b, s / (n - s) AS jaccard FROM p WHERE s / (n - s) >= 0.5)"""


@query(f"WITH {_PAIRS} SELECT a, b, jaccard FROM j")
def jaccard_pairs(spark, sf):
    return stories.similar_titles(_stories(spark, sf))


@query(rf"""WITH RECURSIVE {_PAIRS}, e AS (SELECT a, b FROM j UNION SELECT b, a FROM j), r(id, low) AS (SELECT id, id FROM d UNION SELECT e.b, r.low FROM r JOIN e ON r.id = e.a WHERE r.low < e.b),
  g AS (SELECT id, min(low) AS story_id FROM r GROUP BY 1)
  SELECT story_id, max(coalesce(quality, 0) + 1) + count(DISTINCT source) - 1 AS importance, min(lang) AS language FROM g JOIN d ON g.id = d.id LEFT JOIN labels ON doc_id = d.id GROUP BY 1""")
def story_importance(spark, sf):
    a = _stories(spark, sf)
    base = table(spark, sf, "labels").select(F.col("doc_id").alias("id"), (F.coalesce("quality", F.lit(0)) + 1).alias("base_importance"))
    grouped = stories.title_groups(a).join(base, "id", "left")
    return stories.merged_stories(grouped).select("story_id", "importance", "language")


@query("WITH r AS (SELECT doc_id, lang, length(text) AS score, row_number() OVER (PARTITION BY lang ORDER BY length(text) DESC, doc_id) AS rank FROM documents) SELECT doc_id, lang, score, rank::INTEGER AS rank FROM r WHERE rank <= 7")
def top7_by_language(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang", F.length("text").cast("long").alias("score"))
    return stories.top_stories(d, 7, "lang", "score", "doc_id")


# --- registry, batches, streams -----------------------------------------------------------


@query("""WITH o(ord, id, language, runs_on) AS (VALUES (0, 'sundaytimes', 'English', 'shared'), (1, 'dailynews', 'English', 'local'), (2, 'ceylontoday', 'English', 'local'), (3, 'dailymirror', 'English', 'shared'),
  (4, 'ftlk', 'English', 'local'), (5, 'economynext', 'English', 'local'), (6, 'morning', 'English', 'shared'), (7, 'sundayobserver', 'English', 'local'), (8, 'divaina', 'Sinhala', 'shared'), (9, 'lankadeepa', 'Sinhala', 'shared'),
  (10, 'aruna', 'Sinhala', 'shared'), (11, 'mawbima', 'Sinhala', 'shared'), (12, 'virakesari', 'Tamil', 'shared'), (13, 'thinakaran', 'Tamil', 'local'), (14, 'thamilan', 'Tamil', 'shared'), (15, 'island', 'English', 'local'), (16, 'dinamina', 'Sinhala', 'local'))
  SELECT 'all' AS choice, ord AS target_ord, id, language FROM o UNION ALL SELECT runs_on, ord, id, language FROM o UNION ALL SELECT 'picked', CASE id WHEN 'island' THEN 0 WHEN 'ftlk' THEN 1 END, id, language FROM o WHERE id IN ('island', 'ftlk')""")
def registry_targets(spark, sf):
    """All outlets, those of either kind of worker, and a list in its own order by other names."""
    choices = {"all": {}, "local": {"runs_on": "local"}, "shared": {"runs_on": "shared"}, "picked": {"ids": ["Island", "ft"]}}
    out = None
    for name, how in choices.items():
        one = registry.resolve_targets(spark, **how).select(F.lit(name).alias("choice"), "target_ord", "id", "language")
        out = one if out is None else out.unionByName(one)
    return out


@query(f"WITH {_FEED} SELECT outlet_id, section, pos, (floor(pos / 25) + 1)::BIGINT AS batch FROM f")
def upsert_batches(spark, sf):
    return _feed(spark, sf).select("outlet_id", "section", "pos", text.batch_number(F.col("pos") + 1).alias("batch"))


@query("""WITH r AS (SELECT user_id, event_type, event_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS n FROM events)
  SELECT 'https://feed.example/' || user_id || '/' || event_type AS url, event_id FROM r WHERE n = 1""")
def stream_upsert(spark, sf):
    """The events as a stream of articles, upserted on their URL; what the table holds when the stream has ended.

    The path is a pattern, so it may be a file or a folder."""
    import uuid

    from feedwright.storage import shared_dir
    from feedwright.streaming import stream

    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    root = f"{shared_dir(spark)}/feedwright/stream-{uuid.uuid4().hex}"
    rows = spark.readStream.schema(schema).parquet(f"{sf}/events.parque[t]").select(
        text.normalize_link(F.concat(F.lit("HTTPS://Feed.example/"), "user_id", F.lit("/"), "event_type", F.lit("/?e="), "event_id")).alias("url"), "event_id", "ts")
    bronze_table = KeyedTable(spark, f"{root}/bronze", "url string, event_id bigint, ts timestamp", "url", ("ts", "event_id"))
    stream.run_once(spark, stream.upsert_batches(rows, bronze_table, "events", f"{root}/progress"))
    return bronze_table.read().select("url", "event_id")


@query(r"""SELECT page_id, regexp_matches(url, '/(?:article|news|story)/\d+') AS numbered, length(p) - length(replace(p, '/', '')) >= 2 AND length(p) > 6 AND NOT contains(url, 'author') AS likely
  FROM (SELECT page_id, url, regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1) AS p FROM pages)""")
def article_links(spark, sf):
    url = F.col("url")
    return table(spark, sf, "pages").select("page_id", text.is_article_link(url, "numbered").alias("numbered"), text.looks_like_article(url, 2, 6, ("author",)).alias("likely"))


@query(f"WITH {_FEED} SELECT outlet_id, section, arg_min(event_id % 7 = 0, pos) AS caught_up FROM f GROUP BY 1, 2")
def caught_up_sections(spark, sf):
    return feeds.caught_up(_feed(spark, sf), F.col("event_id") % 7 == 0, ["outlet_id", "section"])


@query("""SELECT o_custkey, count(*) FILTER (WHERE year(o_orderdate) = 1995) AS in_range, count(*) FILTER (WHERE year(o_orderdate) <> 1995) AS out_of_range,
  count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS with_image FROM orders GROUP BY 1""")
def range_counters(spark, sf):
    return feeds.range_counts(table(spark, sf, "orders"), ["o_custkey"], F.year("o_orderdate") == 1995, F.when(F.col("o_orderpriority") == "1-URGENT", "x"))


@query("""SELECT c.c_nationkey, n_name, count(*) AS n FROM customer c JOIN nation ON c.c_nationkey = n_nationkey GROUP BY 1, 2""")
def outlet_dimension_join(spark, sf):
    """Facts joined to a dimension: the fact side is counted before it meets the names."""
    facts = table(spark, sf, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n"))
    return facts.join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("c_nationkey", "n_name", "n")


@query(r"""WITH old AS (SELECT doc_id, sha256(text) AS h FROM documents), new AS (SELECT doc_id, sha256(CASE WHEN doc_id % 4 = 0 THEN text || '!' ELSE text END) AS h FROM documents)
  SELECT 'https://x.example/' || new.doc_id AS url, new.h AS content_hash FROM new JOIN old ON new.doc_id = old.doc_id WHERE new.h <> old.h""")
def changed_articles(spark, sf):
    d = table(spark, sf, "documents").withColumn("url", F.concat(F.lit("https://x.example/"), "doc_id"))
    old = d.select("url", F.sha2("text", 256).alias("content_hash"))
    return bronze.changed_rows(old, d.select("url", F.sha2(F.when(F.col("doc_id") % 4 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text")), 256).alias("content_hash")))
