"""Exact top-k inner-product search by pivot-table elimination.

Every vector stores its distances to the same pivots.  By the triangle
inequality |d(q,p) - d(x,p)| bounds d(q,x) from below for each pivot p; the
largest of these bounds gives an upper bound of the inner product.  A query
evaluates candidates in the order of that bound and stops when the bound of the
next one is below its k-th score, so the answer is exact.

Vectors near the same pivot share a block, and a block knows the range of its
distances to every pivot.  A first pass over the block that lies nearest gives
each query a k-th score to begin with; a block that can't beat the least of
them, for any query of a query block, never meets that query block.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedwright.llm.common import discard, materialize

PIVOTS = 64
#: Vectors that pivots are chosen from: a bounded sample, by a hash of the id.
PIVOT_SAMPLE = 4096
SCALE = 1024
QUERY_BLOCK = 2048
CANDIDATE_BLOCK = 8192
#: Candidates that a query evaluates before its first look at its k-th score; each look waits for twice as many.
STEP = 512
#: Sums below this are exact in double precision.
_EXACT_DOUBLE = 1 << 53


def quantised(df: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """(vec_id, v array<long>) of the usable vectors: floor(scale * x) of each component as double.

    Rows without id, without vector, or with a null or non-finite component take no part.  A component that no long holds
    (of 2^53 or more, at a scale of 1024) counts as the nearest long, so such components may tie."""
    x = F.col(vector_col)
    usable = df.where(
        F.col(id_col).isNotNull() & x.isNotNull()
        & ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    )
    return usable.select(
        F.col(id_col).alias("vec_id"), F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long")).alias("v")
    )


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squared = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(squared, 0))


def spread_out(v: np.ndarray, n: int) -> np.ndarray:
    """n rows of v, each the farthest from those before it."""
    chosen, far = [0], np.full(len(v), np.inf)
    while len(chosen) < min(n, len(v)):
        far = np.minimum(far, _distances(v, v[chosen[-1:]])[:, 0])
        if far.max() <= 0:
            break
        chosen.append(int(far.argmax()))
    return v[chosen]


def choose_pivots(vectors: DataFrame, n: int = PIVOTS) -> dict[int, np.ndarray]:
    """Per dimension, n vectors of a sample of PIVOT_SAMPLE that lie far from each other.

    Pivots only shape the bounds; any choice, or none for a rare dimension, gives the same result."""
    picked = vectors.select(F.size("v").alias("dim"), F.xxhash64("vec_id", F.lit(7)).alias("h"), "v").orderBy("h", "v").limit(PIVOT_SAMPLE).collect()
    by_dim: dict[int, list] = {}
    for r in picked:
        by_dim.setdefault(r.dim, []).append(r.v)
    return {d: spread_out(np.array(v, dtype=np.float64).reshape(len(v), d), n) for d, v in by_dim.items()}


def scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products of the rows of x with q, exact whatever their size.

    Doubles are used where every partial sum is exact in them, longs where none overflows, else
    Python's integers."""
    top = int(max(abs(int(q.max(initial=0))), abs(int(q.min(initial=0))))) * int(max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))) * max(len(q), 1)
    if top < _EXACT_DOUBLE:
        return (x.astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
    if top < 1 << 63:
        return (x * q).sum(1)
    return x.astype(object) @ q.astype(object) if len(q) else np.zeros(len(x), np.int64)


def upper_bounds(q: np.ndarray, qp: np.ndarray, x: np.ndarray, xp: np.ndarray, scale: float) -> np.ndarray:
    """At least the inner product of each row of x with q, by the pivots and by the norms.

    Distances and norms are rounded; the slack, relative to the largest of them, is more than they can be off."""
    slack = 1e-5 * scale + 1e-3  # tables hold float32
    qq, xx = float((q * q).sum()), (x * x).sum(1)
    lower = np.abs(xp - qp).max(1, initial=0)
    lower = np.maximum(lower - slack, 0)
    by_pivots = (qq + xx - lower * lower) / 2
    return np.minimum(by_pivots, np.sqrt(qq * xx)) + slack * (slack + np.sqrt(qq) + np.sqrt(xx))


def _tolerance(score: int) -> float:
    """What a score may lose where it is compared as a double."""
    return 1e-12 * abs(float(score)) + 1e-3


def search_block(qid, q, qp, least, xid, x, xp, k: int) -> tuple[list[tuple[int, int, int]], int]:
    """(query, candidate, score) of each query's k best in a block of candidates, and how many were evaluated.

    least: for each query a score that its k-th is known to reach, or None."""
    out, evaluated = [], 0
    x_float = x.astype(np.float64)
    norm = max(float(np.sqrt((x_float * x_float).sum(1).max(initial=0))), float(xp.max(initial=0)), float(qp.max(initial=0)))
    for i in range(len(qid)):
        q_float = q[i].astype(np.float64)
        upper = upper_bounds(q_float, qp[i], x_float, xp, max(norm, float(np.sqrt((q_float * q_float).sum()))))
        order = np.argsort(-upper, kind="stable")
        order = order[xid[order] != qid[i]]
        ids, best, at, step = np.zeros(0, np.int64), np.zeros(0, np.int64), 0, STEP
        while at < len(order):
            known = [int(b) for b in (best[k - 1] if len(best) >= k else None, least[i]) if b is not None]
            part = order[at : at + step]
            at, step = at + step, 2 * step
            if known:  # an equal bound goes on: a tie may have a smaller id
                part = part[upper[part] >= float(max(known)) - _tolerance(max(known))]
                if not len(part):
                    break
            evaluated += len(part)
            ids, best = np.concatenate([ids, xid[part]]), np.concatenate([best, scores(q[i], x[part])])
            top = np.lexsort((ids, -best))[:k] if best.dtype != object else np.array(sorted(range(len(ids)), key=lambda j: (-best[j], ids[j]))[:k], np.int64)
            ids, best = ids[top], best[top]
        out += [(int(qid[i]), int(c), int(s)) for c, s in zip(ids, best, strict=True)]
    return out, evaluated


#: Parts that the candidates' blocks are dealt into where they meet the queries' blocks.
PARTS = 16
_LONGS = (-(1 << 63), (1 << 63) - 1)
#: Cells up to this number are broadcast to the rows that lie in them.
BROADCAST_CELLS = 100_000
#: Scores travel as decimals of 38 digits.
_WIDEST = 10**38 - 1
_VECTORS = "vec_id long, v array<long>, dim int, pd array<float>, cell int"
_FOUND = "query_id long, vec_id long, score decimal(38,0), evaluated long"


def _stack(frame: pd.DataFrame, column: str, kind) -> np.ndarray:
    return np.stack(frame[column].to_numpy()).astype(kind).reshape(len(frame), -1) if len(frame) else np.zeros((0, 0), kind)


def top_k(
    queries: DataFrame, vectors: DataFrame, k: int = 10, n_pivots: int = PIVOTS,
    query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK, report: dict | None = None,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest inner products of each query.

    Both sides are (vec_id, v array<long>) as quantised() makes them.  A query
    never meets its own id; ties go to the smaller vec_id; fewer than k
    candidates give fewer rows.  Vectors of another length than the query's are
    no candidates of it.  A query row that is repeated whole counts once; a
    candidate row that is repeated is as many candidates.  Columns besides these two
    are ignored, whatever their names.  Scores are exact
    integers; one that no long holds is ranked by its exact value, up to 38
    digits, and given as the nearest long.  Empty tables give an empty result.  Work is cut in pairs
    of a query block and a candidate block, of sizes that don't depend on the
    data; `report` is filled with the candidates that the queries evaluated and
    those that there were.
    """
    pivots = choose_pivots(vectors, n_pivots)

    def prepared(df: DataFrame, block: int) -> DataFrame:
        """Adds the distances to the pivots, and the block: vectors nearest to one of the first pivots."""
        cells = max(1, min(n_pivots, -(-df.count() // block)))

        def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for dim, part in pdf.groupby("dim", sort=False):
                    v = _stack(part, "v", np.float64).reshape(len(part), dim)
                    p = pivots.get(dim, np.zeros((0, dim)))
                    d = _distances(v, p).astype(np.float32)
                    yield part.assign(pd=list(d), cell=d[:, :cells].argmin(1).astype(np.int32) if d.shape[1] else np.int32(0))

        rows = df.select("vec_id", "v", F.size("v").alias("dim")).mapInPandas(add, _VECTORS)
        rows = materialize(rows, "pivots")
        sizes = rows.groupBy("dim", "cell").agg(F.count("*").alias("of"))
        sizes = F.broadcast(sizes) if sizes.count() <= BROADCAST_CELLS else sizes
        # A crowded cell is cut by a hash: no block is larger, on average, than asked for.
        placed = rows.join(sizes, ["dim", "cell"]).withColumn("part", F.pmod(F.xxhash64("vec_id"), F.ceil(F.col("of") / block)).cast("int")).drop("of")
        return placed.select("vec_id", "v", "pd", F.struct("dim", "cell", "part").alias("block"))

    left = materialize(prepared(queries.dropDuplicates(["vec_id", "v"]), query_block), "queries")
    right = materialize(prepared(vectors, candidate_block), "candidates")
    summary = "dim int, cell int, part int, low array<float>, high array<float>, norm double, scale double"

    def ranges(block: pd.DataFrame) -> pd.DataFrame:
        d, v = _stack(block, "pd", np.float32), _stack(block, "v", np.float64)
        norm = float(np.sqrt((v * v).sum(1).max(initial=0)))
        return pd.DataFrame({"dim": [block["dim"].iloc[0]], "cell": [block["cell"].iloc[0]], "part": [block["part"].iloc[0]],
                             "low": [d.min(0)], "high": [d.max(0)], "norm": [norm], "scale": [max(norm, float(d.max(initial=0)))]})

    def summaries(df: DataFrame) -> DataFrame:
        told = df.select("block.*", "v", "pd").groupBy("dim", "cell", "part").applyInPandas(ranges, summary)
        return materialize(told.select(F.struct("dim", "cell", "part").alias("block"), "low", "high", "norm", "scale"), "ranges")

    q_blocks, x_blocks = summaries(left), summaries(right)
    # The distance of two blocks is at least the gap between their ranges, for any pivot.  These are
    # blocks against blocks, thousands of vectors each.
    a, b = q_blocks.select(*[F.col(c).alias(f"q_{c}") for c in q_blocks.columns]), x_blocks.select(*[F.col(c).alias(f"x_{c}") for c in x_blocks.columns])
    gaps = "transform(sequence(0, size(q_low) - 1), i -> greatest(q_low[i] - x_high[i], x_low[i] - q_high[i]))"
    slack = "(1e-5D * greatest(q_scale, x_scale) + 1e-3D)"
    gap = f"greatest(CASE WHEN size(q_low) = 0 THEN 0D ELSE cast(array_max({gaps}) AS double) END - {slack}, 0D)"
    # Most tables have one dimension: without parts it would be the only key.
    a = a.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    b = b.withColumn("x_part", F.pmod(F.xxhash64("x_block"), F.lit(PARTS)).cast("int"))
    met = a.join(b, F.expr("q_block.dim = x_block.dim AND part = x_part")).select("q_block", "x_block", "q_norm", "x_norm", "q_scale", "x_scale", F.expr(gap).alias("gap"))
    met = met.withColumn("most", F.expr(f"least((q_norm * q_norm + x_norm * x_norm - gap * gap) / 2, q_norm * x_norm) + {slack} * ({slack} + q_norm + x_norm)"))
    met = materialize(met, "pairs")
    first = materialize(met.groupBy("q_block").agg(F.min_by("x_block", F.struct("gap", -F.col("most"), "x_block")).alias("x_block")), "nearest")

    def meet(qs: pd.DataFrame, xs: pd.DataFrame) -> pd.DataFrame:
        if not len(qs) or not len(xs):
            return pd.DataFrame({c: pd.Series([], dtype=object) for c in ("query_id", "vec_id", "score", "evaluated")})
        found, evaluated = search_block(
            qs["vec_id"].to_numpy(np.int64), _stack(qs, "v", np.int64), _stack(qs, "pd", np.float64), [None if s is None else int(s) for s in qs["least"]],
            xs["vec_id"].to_numpy(np.int64), _stack(xs, "v", np.int64), _stack(xs, "pd", np.float64), k)
        # The last row tells how many candidates were evaluated.
        return pd.DataFrame({
            "query_id": [q for q, _, _ in found] + [int(qs["vec_id"].iloc[0])], "vec_id": pd.array([c for _, c, _ in found] + [None], dtype="Int64"),
            "score": pd.Series([Decimal(min(max(s, -_WIDEST), _WIDEST)) for _, _, s in found] + [None], dtype=object), "evaluated": [0] * len(found) + [evaluated]})

    def search(pairs: DataFrame, known: DataFrame | None) -> DataFrame:
        qs = left if known is None else left.join(known, "vec_id", "left")
        qs = qs.withColumn("least", F.lit(None).cast("decimal(38,0)")) if known is None else qs
        one = qs.join(pairs.select("q_block", "x_block"), F.col("block") == F.col("q_block")).select("vec_id", "v", "pd", "least", F.col("q_block").alias("qa"), F.col("x_block").alias("xa"))
        two = right.join(pairs.select("q_block", "x_block"), F.col("block") == F.col("x_block")).select("vec_id", "v", "pd", F.col("q_block").alias("qb"), F.col("x_block").alias("xb"))
        return materialize(one.groupBy("qa", "xa").cogroup(two.groupBy("qb", "xb")).applyInPandas(meet, _FOUND), "found")

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = lambda df: df.where("vec_id IS NOT NULL").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    seeded = search(first, None)
    known = best(seeded).where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("least"))
    floors = left.join(known, "vec_id", "left").groupBy(F.col("block").alias("q_block")).agg(F.min(F.coalesce("least", F.lit("-" + "9" * 38).cast("decimal(38,0)"))).alias("least"))
    others = met.join(first.select("q_block", F.col("x_block").alias("seed")), "q_block").where("x_block <> seed").join(floors, "q_block").where("most >= cast(least AS double) - 1e-12D * abs(cast(least AS double)) - 1e-3D")
    more = search(materialize(others.select("q_block", "x_block"), "open"), known)
    found = seeded.unionByName(more)
    if report is not None:
        report["evaluated"] = found.agg(F.coalesce(F.sum("evaluated"), F.lit(0)).alias("n")).first().n
        report["pairs"] = left.join(right.select(F.col("vec_id").alias("x_id"), F.col("block.dim").alias("dim")).groupBy("dim").count(), F.col("block.dim") == F.col("dim")).agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n")).first().n
    discard(met)
    low, high = (F.lit(str(x)).cast("decimal(38,0)") for x in _LONGS)
    long = F.least(F.greatest("score", low), high).cast("long")
    return best(found).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", long.alias("score"))

