"""URL allow and block rules through a cascade of Bloom filters.

Level 1 of a cascade encodes the listed keys; level 2 those keys of the corpus
that level 1 mistakes for listed ones; level 3 the listed keys that level 2
mistakes, and so on until a level mistakes nothing.  The levels are built
against every key that the corpus can ask for, so the answer (the parity of the
first level that says no) is exact for the corpus, without a join.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from feedwright.llm.common import materialize
from feedwright.llm.wordhash import mix

#: Bits for each encoded key, hash functions, and the largest level that is broadcast (2**27 bits: 16 MB).
BITS_PER_KEY, HASHES, MAX_LEVEL_BITS = 12, 4, 1 << 27
MAX_LEVELS = 40
_ROW_BITS = 32768


@dataclass(frozen=True)
class Rule:
    """A rule fits its host and all subdomains, if the url's path starts with the rule's."""

    verdict: str
    host: str
    path: str

    @classmethod
    def parse(cls, verdict: str, text: str) -> Rule:
        host, slash, rest = text.partition("/")
        return cls(verdict, host, slash + rest)

    @property
    def key(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Level:
    bits: int
    filled: np.ndarray
    seed: int

    def positions(self, hashes: np.ndarray) -> Iterator[np.ndarray]:
        step = mix(hashes + np.uint64(self.seed * 2 + 1)) | np.uint64(1)
        for i in range(HASHES):
            yield mix(hashes + np.uint64(i) * step + np.uint64(self.seed)) & np.uint64(self.bits - 1)

    def says(self, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes), bool)
        for at in self.positions(hashes):
            out &= (self.filled[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return out


def build_level(keys: DataFrame, n: int, seed: int, max_bits: int = MAX_LEVEL_BITS, bits_per_key: int = BITS_PER_KEY) -> Level:
    """Encode the hashes in column `h`.  Bits are set on the executors; what comes back has at most max_bits."""
    bits = _ROW_BITS
    while bits < bits_per_key * n and bits < max_bits:
        bits *= 2
    empty = Level(bits, np.zeros(0, np.uint8), seed)

    def positions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            h = pdf["h"].to_numpy(np.int64).view(np.uint64)
            yield pd.DataFrame({"p": np.unique(np.concatenate(list(empty.positions(h)))).view(np.int64)})

    rows = keys.select("h").mapInPandas(positions, "p long").groupBy(F.shiftright("p", 15).alias("slot")).agg(
        F.bitmap_construct_agg(F.col("p").bitwiseAND(F.lit(_ROW_BITS - 1))).alias("bitmap")
    )
    filled = np.zeros((bits // _ROW_BITS, _ROW_BITS // 8), np.uint8)
    for row in rows.toLocalIterator():
        filled[row.slot] = np.frombuffer(row.bitmap, np.uint8)
    return Level(bits, filled.ravel(), seed)


class Cascade:
    def __init__(self, levels: Sequence[Level]):
        self.levels = tuple(levels)

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        inside = np.zeros(len(hashes), bool)
        asking = np.arange(len(hashes))
        for depth, level in enumerate(self.levels):
            asking = asking[level.says(hashes[asking])]
            inside[asking] = depth % 2 == 0
        return inside

    @classmethod
    def build(cls, listed: DataFrame, universe: DataFrame, max_bits: int = MAX_LEVEL_BITS, bits_per_key: int = BITS_PER_KEY) -> Cascade:
        """listed, universe: (key, h).  Only the keys that a level mistakes are ever kept or shuffled."""
        listed = materialize(listed.dropDuplicates(["key"]), "listed")
        levels: list[Level] = []
        inner, others = listed, None
        while len(levels) < MAX_LEVELS:
            n = inner.count()
            if not n:
                return cls(levels)
            levels.append(build_level(inner, n, len(levels), max_bits, bits_per_key))
            says = _tester(universe, levels[-1].says)
            if others is None:
                # Build time: the few keys that level 1 passes are told from the listed ones by name.
                others = universe.where(says("h")).dropDuplicates(["key"]).join(listed.select("key"), "key", "left_anti")
            else:
                others = others.where(says("h"))
            inner, others = materialize(others, "mistaken"), inner
        raise ValueError("two keys share a hash, or the levels are too small for the corpus")


def _tester(df: DataFrame, test):
    shared = df.sparkSession.sparkContext.broadcast(test)

    @F.pandas_udf(BooleanType())
    def said(h: pd.Series) -> pd.Series:
        return pd.Series(shared.value(h.to_numpy(np.int64).view(np.uint64)))

    return said


def url_host(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; empty without ://."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to ? # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def candidate_keys(host: str, path: str, shapes: Sequence[tuple[int, int]]) -> Column:
    """The keys that a rule of each shape (labels of the host, length of the path) would have to fit this url."""
    found = []
    for labels, length in shapes:
        found.append(
            f"CASE WHEN size(split({host}, '[.]', -1)) >= {labels} AND length({path}) >= {length} "
            f"THEN concat(substring_index({host}, '.', -{labels}), substring({path}, 1, {length})) END"
        )
    return F.array_compact(F.expr(f"array({', '.join(found)})"))


def filter_urls(df: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url", default: str = "allow",
                max_bits: int = MAX_LEVEL_BITS, bits_per_key: int = BITS_PER_KEY) -> DataFrame:
    """page_id, host, path, rule, verdict of every row.

    The longest rule that fits wins (host and path together; of equally long
    ones that with the longer host); without one, rule is null and the verdict
    is `default`.  A null url, or one without ://, has an empty host and path,
    which no rule fits.  Rows keep their number and ids; other columns are
    ignored.  Only filters of bounded size are broadcast.
    """
    spark = df.sparkSession
    urls = df.select(F.col(id_col).alias("page_id"), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))
    if not rules:
        return urls.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    shapes = sorted({(r.host.count(".") + 1, len(r.path)) for r in rules}, key=lambda s: (-s[0], -s[1]))
    keyed = urls.withColumn("keys", candidate_keys("host", "path", shapes))
    universe = keyed.select(F.explode("keys").alias("key")).withColumn("h", F.xxhash64("key"))
    cascades = {}
    for verdict in sorted({r.verdict for r in rules}):
        listed = spark.createDataFrame([(r.key,) for r in rules if r.verdict == verdict], "key string").withColumn("h", F.xxhash64("key"))
        cascades[verdict] = Cascade.build(listed, universe, max_bits, bits_per_key)
    names = list(cascades)
    shared = spark.sparkContext.broadcast([cascades[v] for v in names])

    @F.pandas_udf("array<int>")
    def judged(hashes: pd.Series) -> pd.Series:
        """For each key its place in `names`, or -1."""
        sizes = hashes.map(len).to_numpy()
        flat = np.concatenate([np.zeros(0, np.int64), *hashes]).astype(np.int64).view(np.uint64)
        of = np.full(len(flat), -1, np.int32)
        for i, cascade in enumerate(shared.value):
            of[cascade.contains(flat)] = i
        return pd.Series(np.split(of, np.cumsum(sizes)[:-1]) if len(sizes) else [])

    asked = keyed.withColumn("of", judged(F.transform("keys", lambda k: F.xxhash64(k))))
    fitting = F.filter(F.zip_with("keys", "of", lambda k, v: F.struct(F.length(k).alias("n"), k.alias("key"), v.alias("v"))), lambda x: x.v >= 0)
    # Keys come with the longer host first; a strict comparison keeps the earlier of equal lengths.
    best = F.aggregate(fitting, F.expr("named_struct('n', -1, 'key', cast(null AS string), 'v', -1)"), lambda s, x: F.when(x.n > s.n, x).otherwise(s))
    said = F.element_at(F.array(*[F.lit(v) for v in names]), F.col("best.v") + 1)
    return asked.withColumn("best", best).select(
        "page_id", "host", "path", F.col("best.key").alias("rule"), F.when(F.col("best.v") >= 0, said).otherwise(F.lit(default)).alias("verdict")
    )
