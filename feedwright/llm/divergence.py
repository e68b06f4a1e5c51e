"""Which sources of a language write differently: divergences of their term distributions.

Terms are counted by source, the kept terms of a language are dealt into blocks,
and each block becomes a dense matrix of groups by terms.  Broadcasting all pairs
of rows over such a tile gives a partial pair matrix; Spark sums these.  Each
tile also gives every group its highest terms, and these short lists are merged.
A tile holds at most GROUPS_PER_TILE sources on either side and about
TERMS_PER_BLOCK terms, whatever the corpus holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedwright.llm.common import materialize, text_slices
from feedwright.llm.wordhash import flat_utf8, word_spans

#: Documents of a language that a kept term stands in, at least.
MIN_DOCS = 10
#: Terms reported per group.
TOP_TERMS = 10
#: Probabilities are whole parts of this many.
SCALE_DIGITS = 9
TERMS_PER_BLOCK = 1024
GROUPS_PER_TILE = 64
#: Elements of one broadcast of pairs by terms: 16 MB.
PAIR_ELEMENTS = 1 << 21
COUNT_BYTES = 8_000_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
#: All of ASCII but letters; bytes of other characters are letters.
_SEPARATOR = np.ones(256, bool)
_SEPARATOR[0x80:] = _SEPARATOR[0x41:0x5B] = _SEPARATOR[0x61:0x7B] = False

_COUNTS = "lang string, source string, term string, n long, docs long"
_TILES = "part string, lang string, source string, item string, value long"


def _strings(lengths: np.ndarray, data: np.ndarray) -> pa.Array:
    offsets = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    return pa.LargeStringArray.from_buffers(len(lengths), pa.py_buffer(offsets), pa.py_buffer(data))


def _count_slice(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Counts and document counts of (lang, source, term); a null term tells that the group occurs."""
    data, offsets = flat_utf8(batch.column("text"))
    starts, ends, first = word_spans(data, offsets, _SEPARATOR)
    words = _strings(ends - starts, _LOWER[data[~_SEPARATOR[data]]]).dictionary_encode()
    size = max(len(words.dictionary), 1)
    langs, sources = (batch.column(c).dictionary_encode() for c in ("lang", "source"))
    group_of = langs.indices.to_numpy().astype(np.int64) * len(sources.dictionary) + sources.indices.to_numpy()
    groups, group_of = np.unique(group_of, return_inverse=True)
    document = np.repeat(np.arange(batch.num_rows), np.diff(first))
    in_document, n = np.unique(document * size + words.indices.to_numpy(), return_counts=True)
    cell, at = np.unique(group_of[in_document // size] * size + in_document % size, return_inverse=True)
    counts = np.bincount(at, n, len(cell)).astype(np.int64)
    docs = np.bincount(at, minlength=len(cell))
    none = np.zeros(len(groups), np.int64)
    of = groups[np.concatenate([cell // size, np.arange(len(groups))])]
    terms = pa.concat_arrays([words.dictionary.take(pa.array(cell % size)).cast(pa.string()), pa.nulls(len(groups), pa.string())])
    columns = [langs.dictionary.take(pa.array(of // len(sources.dictionary))), sources.dictionary.take(pa.array(of % len(sources.dictionary))), terms]
    return pa.RecordBatch.from_arrays([*columns, pa.array(np.concatenate([counts, none])), pa.array(np.concatenate([docs, none]))], ["lang", "source", "term", "n", "docs"])


def term_counts(df: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term in each group; a row with a
    null term for every group, also one without terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text", COUNT_BYTES):
            if part.num_rows:
                yield _count_slice(part)

    texts = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    return texts.mapInArrow(run, _COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def scaled(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(10**SCALE_DIGITS * counts / total), exactly, for 0 < counts <= total: long division by digits.
    Nothing overflows below totals of 9 * 10**17; beyond, Python's own integers are used."""
    if total.max(initial=0) >= 9 * 10**17:
        counts, total = counts.astype(object), total.astype(object)
    out = counts // total
    rest = counts - out * total
    for _ in range(SCALE_DIGITS):
        digit = rest * 10 // total
        rest = rest * 10 - digit * total
        out = out * 10 + digit
    return (1 + out).astype(np.int64)


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // (p + q)


def _tile(key: tuple, cells: pa.Table, groups: pa.Table) -> pa.Table:
    """Partial pair values and highest terms of one block of terms and one pair of blocks of groups."""
    lang, block, a, b = (k.as_py() for k in key)
    out: dict[str, list] = {c: [] for c in ("part", "source", "item", "value")}

    def put(part: str, source: str, item: str, value: int) -> None:
        for c, v in zip(out, (part, source, item, value), strict=True):
            out[c].append(v)

    held = groups["held"][0].as_py() if groups.num_rows else 0
    if groups.num_rows and (held or block == 0):
        order = np.argsort(np.array(groups["source"].to_pylist(), object), kind="stable")
        groups = groups.take(pa.array(order))
        sources, side = groups["source"].to_pylist(), groups["side"].to_numpy()
        total = groups["n"].to_numpy() + 2 * groups["v"].to_numpy()
        place = {s: i for i, s in enumerate(sources)}
        terms = sorted(set(cells["term"].to_pylist()))
        column = {t: i for i, t in enumerate(terms)}
        counts, of_lang = np.zeros((len(sources), len(terms)), np.int64), np.zeros(len(terms), np.int64)
        at = np.array([column[t] for t in cells["term"].to_pylist()], np.int64)
        counts[[place[s] for s in cells["source"].to_pylist()], at] = cells["n"].to_numpy()
        of_lang[at] = cells["total"].to_numpy()
        p = scaled(counts + 2, total[:, None])
        left, right = np.flatnonzero(side == a), np.flatnonzero(side == b)
        absent = scaled(np.full(len(sources), 2), total) if held else total
        # Kept terms of the block that no group of this tile has: each pair has one value for all of them.
        pairs = (held - len(terms)) * divergence(absent[left, None], absent[None, right]) if held else np.zeros((len(left), len(right)), np.int64)
        step = max(1, PAIR_ELEMENTS // max(pairs.size, 1))
        for i in range(0, len(terms), step):
            pairs += divergence(p[left, None, i : i + step], p[None, right, i : i + step]).sum(2)
        for i, x in enumerate(left):
            for j, y in enumerate(right):
                if a < b or x < y:
                    put("pair", sources[x], sources[y], int(pairs[i, j]))
        if a == b and terms:
            q = scaled(of_lang + 2, groups["lang_n"].to_numpy()[:1] + 2 * groups["v"].to_numpy()[:1])
            for i, s in enumerate(sources):
                over = np.flatnonzero((counts[i] > 0) & (p[i] > q))
                value = divergence(p[i, over], q[over])
                for k in np.lexsort((over, -value))[:TOP_TERMS]:
                    put("term", s, terms[over[k]], int(value[k]))
    columns = {"part": pa.array(out["part"], pa.string()), "lang": pa.array([lang] * len(out["part"]), pa.string())}
    columns |= {c: pa.array(out[c], pa.string()) for c in ("source", "item")} | {"value": pa.array(out["value"], pa.int64())}
    return pa.table(columns)


def _met(rows: DataFrame, blocks: int) -> DataFrame:
    """rows once for each block of groups that theirs meets: (a, b) with a <= b, and the own one as `side`."""
    rows = rows.withColumn("side", F.pmod(F.xxhash64("source"), F.lit(blocks)).cast("int"))
    other = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return other.select("*", F.least("side", "_other").alias("a"), F.greatest("side", "_other").alias("b")).drop("_other")


def source_divergence(df: DataFrame, min_docs: int = MIN_DOCS, terms_per_block: int = TERMS_PER_BLOCK, groups_per_tile: int = GROUPS_PER_TILE) -> DataFrame:
    """lang, source, part, item, value, rank: how each source differs from the others of its language.

    df: lang, source, text.  Nulls count as ''; other columns are ignored.  Terms are runs of ASCII letters and of
    characters beyond ASCII, A-Z in lower case; a language keeps those in at least `min_docs` of its documents
    (rows: repeated ones count each).  With c the occurrences of a term in a group, N those of all kept terms and V
    their number, p = 1 + floor(10^9 (c + 2) / (N + 2 V)).  Part `pair` has every other source of the language with
    the sum of floor((p - q)^2 / (p + q)) over the kept terms; part `term` the ten terms that the group has and
    uses more than its language, by the same value.  Ranks are by value from the highest, then by item.

    A group without kept terms takes part (all its counts are 0); where a language keeps no term all pairs are 0 and
    there are no terms.  An empty table has no rows.  Texts of any length are read whole.
    """
    counts = term_counts(df)
    of_term = Window.partitionBy("lang", "term")
    kept = counts.select(
        "lang", "source", "term", "n", F.sum("n").over(of_term).alias("total"), F.sum("docs").over(of_term).alias("_docs"),
        (F.col("source") == F.min("source").over(of_term)).alias("once"),
    ).where(F.col("term").isNull() | (F.col("_docs") >= min_docs)).drop("_docs")
    cells = materialize(kept, "cells")
    own = cells.groupBy("lang", "source").agg(F.coalesce(F.sum(F.when(F.col("term").isNotNull(), F.col("n"))), F.lit(0)).alias("n"), F.count_if(F.col("once") & F.col("term").isNotNull()).alias("_v"))
    of_lang = Window.partitionBy("lang")
    groups = materialize(own.select("lang", "source", "n", F.sum("_v").over(of_lang).alias("v"), F.sum("n").over(of_lang).alias("lang_n"), F.count("*").over(of_lang).alias("s")), "groups")
    most = groups.agg(F.max("v").alias("v"), F.max("s").alias("s")).first()
    blocks = max(1, -(-(most.v or 0) // terms_per_block))
    sides = max(1, -(-(most.s or 0) // groups_per_tile))
    key = ("lang", "block", "a", "b")
    dealt = cells.where("term IS NOT NULL").withColumn("block", F.pmod(F.xxhash64("term"), F.lit(blocks)).cast("int"))
    held = dealt.where("once").groupBy("lang", "block").agg(F.count("*").alias("held"))
    everywhere = groups.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    left = _met(dealt.drop("once"), sides)
    right = _met(everywhere.join(held, ["lang", "block"], "left").fillna(0, ["held"]), sides)
    tiles = materialize(left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_tile, _TILES), "tiles")
    pairs = tiles.where("part = 'pair'").groupBy("part", "lang", "source", "item").agg(F.sum("value").alias("value"))
    both = pairs.union(pairs.select("part", "lang", "item", "source", "value"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = tiles.where("part = 'term'").withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= TOP_TERMS)
    ranked = both.withColumn("rank", F.row_number().over(by_value)).unionByName(terms)
    return ranked.select("lang", "source", "part", "item", "value", "rank")
