"""The registered queries of this subpackage: each applies its operator to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedwright.llm.bpe import round_trip
from feedwright.llm.common import table
from feedwright.llm.conversations import damaged, repair_conversations
from feedwright.llm.divergence import source_divergence
from feedwright.llm.exact_dedup import exact_dedup
from feedwright.llm.jaccard_join import jaccard_join
from feedwright.llm.labelled import fold
from feedwright.llm.line_dedup import line_dedup
from feedwright.llm.mixing import mix_sources
from feedwright.llm.packing import pack_documents
from feedwright.llm.quality import score_quality
from feedwright.llm.substring_dedup import substring_dedup
from feedwright.llm.topk_search import quantised, top_k
from feedwright.llm.toxicity import score_toxicity
from feedwright.llm.url_filter import Rule, filter_urls

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: The rules of the URL filter query (fixed values).
URL_RULES = (
    Rule.parse("block", "com/en/"),
    Rule.parse("allow", "example.com/en/7"),
    Rule.parse("allow", "net/de/"),
    Rule.parse("block", "example.net/de/8"),
    Rule.parse("block", "org/es/"),
)


#: Edits between near lines, by the least length of the shorter one.
LINE_EDITS = ((20, 1), (40, 2), (100, 3))


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup(table(spark, sf_dir, "documents"), edits=LINE_EDITS)
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), fold("doc_id", 3) != 1)
    return scored.select("doc_id", F.coalesce(fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score", "predicted")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    return scored.select("doc_id", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"))


def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = quantised(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return top_k(vectors.where(F.col("vec_id") % 100 == 0), vectors, k=10)


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "kept")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), tokenizer_path())


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(damaged(table(spark, sf_dir, "conversations")))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


QUERIES: dict[str, Query] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_url_filter": op2_url_filter,
    "op3_line_dedup": op3_line_dedup,
    "op4_toxicity": op4_toxicity,
    "op5_quality": op5_quality,
    "op6_source_mixing": op6_source_mixing,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_exact_topk": op8_exact_topk,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_bpe": op10_bpe,
    "op11_source_divergence": op11_source_divergence,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_packing": op13_packing,
}

#: DuckDB's distance counts bytes: the tables' letters beyond ASCII are given one byte each for it.
_LETTERS = "ÄÇÈÉÊÍÑÓÖÜßäçèéêíñóöü"
_ONE_BYTE = "".join(map(chr, (*range(1, 9), *range(14, 27))))
#: Components of links (a, b) among the ids of d, by least ids.
_COMPONENTS = """e AS (SELECT a, b FROM links UNION SELECT b, a FROM links), r(id, low) AS (SELECT id, id FROM d UNION SELECT e.b, r.low FROM r JOIN e ON r.id = e.a WHERE r.low < e.b),
  label AS (SELECT id, min(low) AS low FROM r GROUP BY id)"""


def _more(path: str, cost: str, edit: str) -> str:
    """SQL: a path (its cost in twelve digits, then its edits) with one more edit; null where there is none."""
    return f"printf('%012d', left({path}, 12)::BIGINT + {cost}) || substr({path}, 13) || '{edit}'"


def _cheapest_edits() -> str:
    """SQL: the least path to each state after each row of a conversation; what is inserted next is already in it."""
    extra = "CASE WHEN t.fault = 'truncated' THEN 5 ELSE 0 END"
    may = lambda path, when: f"CASE WHEN t.fault NOT IN ('blank', 'duplicate') AND {when} THEN {path} END"
    kept = lambda path, initial: may(_more(path, extra, "K"), f"t.initial = '{initial}'")
    other = lambda path: may(_more(path, f"1 + {extra}", "R"), "true")
    gone = lambda path: _more(path, "2", "D")
    to_user = ", ".join([*(kept(f"p.{q}", "u") for q in ("b", "s", "a")), *(other(f"p.{q}") for q in ("b", "s", "a"))])
    return f"""SELECT conv_id, i, b, s, u, least(a, {_more("u", "5", "I")}) AS a FROM (
            SELECT conv_id, i, b, s, least(u, {_more("b", "5", "I")}, {_more("s", "5", "I")}, {_more("a", "5", "I")}) AS u, a FROM (
              SELECT t.conv_id, t.i, {gone("p.b")} AS b, least({gone("p.s")}, {kept("p.b", "s")}) AS s, least({gone("p.u")}, {to_user}) AS u,
                least({gone("p.a")}, {kept("p.u", "a")}, {other("p.u")}) AS a
              FROM p JOIN t ON t.conv_id IS NOT DISTINCT FROM p.conv_id AND t.i = p.i + 1))"""


ORACLES: dict[str, str] = {
    "op3_line_dedup": f"""
        WITH RECURSIVE o AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents),
        p AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos FROM o),
        q AS (SELECT doc_id, pos, line FROM p WHERE trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) <> ''),
        d AS (SELECT line, translate(line, '{_LETTERS}', '{_ONE_BYTE}') AS plain, length(line) AS n, row_number() OVER (ORDER BY line) AS id FROM (SELECT DISTINCT line FROM q)),
        links AS (SELECT x.id AS a, y.id AS b FROM d x JOIN d y ON x.id <> y.id AND x.n >= 20 AND y.n BETWEEN x.n AND x.n + CASE WHEN x.n >= 100 THEN 3 WHEN x.n >= 40 THEN 2 ELSE 1 END
          AND levenshtein(x.plain, y.plain) <= CASE WHEN x.n >= 100 THEN 3 WHEN x.n >= 40 THEN 2 ELSE 1 END),
        {_COMPONENTS},
        s AS (SELECT q.doc_id, q.pos, row_number() OVER (PARTITION BY low ORDER BY q.doc_id, q.pos) AS turn FROM q JOIN d ON q.line = d.line JOIN label ON d.id = label.id),
        g AS (SELECT doc_id, pos FROM s WHERE turn > 1),
        k AS (SELECT p.doc_id, string_agg(p.line, chr(10) ORDER BY p.pos) AS t FROM p ANTI JOIN g ON p.doc_id = g.doc_id AND p.pos = g.pos GROUP BY 1),
        c AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1)
        SELECT o.doc_id, coalesce(len(o.l), 0)::BIGINT AS n_lines, coalesce(c.n, 0)::BIGINT AS n_removed, sha256(coalesce(k.t, '')) AS text_sha256
        FROM o LEFT JOIN k ON o.doc_id = k.doc_id LEFT JOIN c ON o.doc_id = c.doc_id""",
    "op7_substring_dedup": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        u AS (SELECT r, unnest(w) AS x, generate_subscripts(w, 1) AS j FROM d),
        h AS (SELECT r, j, count(*) OVER v AS n, md5(string_agg(x, ' ') OVER v) AS h FROM u WINDOW v AS (PARTITION BY r ORDER BY j ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)),
        c AS (SELECT h FROM h WHERE n = 35 GROUP BY h HAVING count(*) > 1),
        g AS (SELECT DISTINCT r, j + k AS j FROM h SEMI JOIN c ON h.h = c.h, (SELECT unnest(range(0, 35)) AS k) WHERE n = 35),
        k AS (SELECT u.r, string_agg(x, ' ' ORDER BY u.j) AS t FROM u ANTI JOIN g ON u.r = g.r AND u.j = g.j GROUP BY 1),
        m AS (SELECT r, count(*) AS n FROM g GROUP BY 1)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(m.n, 0)::BIGINT AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256 FROM d LEFT JOIN k ON d.r = k.r LEFT JOIN m ON d.r = m.r""",
    "op9_jaccard_join": r"""
        WITH RECURSIVE d AS (SELECT doc_id AS id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        u AS (SELECT id, unnest(w) AS x, generate_subscripts(w, 1) AS j FROM d),
        v AS (SELECT id, count(*) OVER f AS n, md5(string_agg(x, ' ') OVER f) AS h FROM u WINDOW f AS (PARTITION BY id ORDER BY j ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)),
        s AS (SELECT DISTINCT id, h FROM v WHERE n = 5 UNION SELECT id, md5(array_to_string(w, ' ')) FROM d WHERE len(w) < 5),
        z AS (SELECT id, count(*) AS n FROM s GROUP BY 1),
        i AS (SELECT a.id AS a, b.id AS b, count(*) AS m FROM s a JOIN s b ON a.h = b.h AND a.id < b.id GROUP BY 1, 2),
        links AS (SELECT a, b FROM i JOIN z x ON i.a = x.id JOIN z y ON i.b = y.id WHERE 9 * m >= 4 * (x.n + y.n)),
        {_COMPONENTS},
        n AS (SELECT id, count(*) AS n FROM (SELECT a AS id FROM links UNION ALL SELECT b FROM links) GROUP BY 1)
        SELECT label.id AS doc_id, low AS class_id, coalesce(n.n, 0)::BIGINT AS n_links, label.id = low AS kept FROM label LEFT JOIN n ON label.id = n.id""".replace("{_COMPONENTS}", _COMPONENTS),
    "op1_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY t)""",
    "op2_url_filter": """
        WITH rules(verdict, host, path) AS (VALUES ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'),
          ('allow', 'net', '/de/'), ('block', 'example.net', '/de/8'), ('block', 'org', '/es/')),
        u AS (SELECT page_id,
            translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages)
        SELECT page_id, u.host, u.path, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
               coalesce(arg_max(r.verdict, length(r.host || r.path)), 'allow') AS verdict
        FROM u LEFT JOIN rules r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
        GROUP BY page_id, u.host, u.path""",
    "op8_exact_topk": """
        WITH v AS (
          SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
          WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
          SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
          FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
        SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 10""",
    "op12_conversation_repair": f"""
        WITH RECURSIVE crc AS MATERIALIZED (SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, k: xor(c >> 1, 3988292384 * (c & 1)), n)) AS l),
        k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
        h AS (SELECT conv_id, turn, role, text, xor(list_reduce(list_transform(string_split(key, ''), lambda x: ascii(x)::BIGINT), lambda c, b: xor(c >> 8, l[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 20 AS kind FROM k, crc),
        d AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
          FROM h, (SELECT unnest(range(2)) AS copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)),
        e AS (SELECT *, left(role, 1) AS initial, right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS last,
            row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS seen FROM d),
        t AS MATERIALIZED (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, seen) AS i, turn, role, text, initial, CASE WHEN last = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate' WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
            lag(initial) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, seen) AS before FROM e),
        c AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
            count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM t GROUP BY 1),
        p(conv_id, i, b, s, u, a) AS (SELECT DISTINCT conv_id, 0::BIGINT, '000000000000', NULL::VARCHAR, '000000000005I', '000000000010II' FROM t UNION ALL {_cheapest_edits()}),
        w AS (SELECT c.*, left(least(b, a), 12)::BIGINT AS cost, substr(least(b, a), 13) AS audit FROM c JOIN p ON c.conv_id IS NOT DISTINCT FROM p.conv_id AND c.n = p.i),
        x AS (SELECT conv_id, string_split(audit, '') AS l FROM w WHERE audit <> ''),
        y AS (SELECT conv_id, unnest(l) AS edit, generate_subscripts(l, 1) AS j FROM x),
        z AS (SELECT conv_id, edit, j, count(*) FILTER (edit <> 'I') OVER f AS i, count(*) FILTER (edit <> 'D') OVER f AS o FROM y WINDOW f AS (PARTITION BY conv_id ORDER BY j)),
        r AS (SELECT z.conv_id, z.j, z.edit, z.o, t.role, CASE WHEN z.edit = 'I' THEN '' ELSE t.text END AS text,
            max(CASE WHEN z.o = 1 AND z.edit = 'K' AND t.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY z.conv_id) AS led FROM z LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM z.conv_id AND t.i = z.i),
        s AS (SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (o - led) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY j) AS whole FROM r WHERE edit <> 'D' GROUP BY 1)
        SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
          coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN w ON w.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM o.conv_id""",
    "op11_source_divergence": r"""
        WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
            regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
        u AS (SELECT r, lang, source, unnest(w) AS term FROM d),
        k AS (SELECT lang, term, count(*) AS total FROM u GROUP BY 1, 2 HAVING count(DISTINCT r) >= 10),
        v AS (SELECT lang, count(*) AS v, sum(total) AS n FROM k GROUP BY 1),
        c AS (SELECT u.lang, source, u.term, count(*) AS n FROM u SEMI JOIN k ON u.lang = k.lang AND u.term = k.term GROUP BY 1, 2, 3),
        g AS (SELECT lang, source, coalesce(m.n, 0) AS n FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN (SELECT lang, source, sum(n) AS n FROM c GROUP BY 1, 2) m USING (lang, source)),
        p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.n + 2 * v.v)::HUGEINT AS p,
            1 + (1000000000::HUGEINT * (k.total + 2)) // (v.n + 2 * v.v)::HUGEINT AS q
          FROM g JOIN k ON g.lang = k.lang JOIN v ON g.lang = v.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
        f AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
        o AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
          UNION ALL SELECT lang, source, 'term', term, (((p - q) * (p - q)) // (p + q))::BIGINT FROM p WHERE n > 0 AND p > q),
        z AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM o)
        SELECT lang, source, part, item, value, rank FROM z WHERE part = 'pair' OR rank <= 10""",
}
