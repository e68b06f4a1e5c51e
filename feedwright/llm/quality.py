"""Quality by Bradley-Terry pairwise ranking.

From all labelled documents come preference pairs: a good one is preferred to a
bad one.  The chance of a preference is the logistic function
of the difference of two scores, each linear in the documents' features, so the
weights are a logistic regression on feature differences.  The features are
statistics of form, and what the text says: shares of hashed words and of
hashed four-byte pieces.  A quantile of the labelled documents' scores, at the share of
bad documents, is the threshold.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedwright.llm.common import SMALL_SLICE_BYTES, bounded_batches, discard, materialize, text_slices
from feedwright.llm.labelled import maybe_labelled
from feedwright.llm.wordhash import flat_utf8, mix, word_hashes, word_spans

#: Pairs that a labelled document of the larger class is in.
PARTNERS = 4
#: Labelled documents of a part, about, and how many of the rarer class it has at least on average.
PART_ROWS, PART_LEAST = 1024, 32
#: Ranks that a quantile is told by: exact up to as many rows, then off by that share of all ranks.
RANKS = 1_000_000
#: Steps of the search for the weights.
STEPS = 40
#: Quantile bins of a feature; each has a weight of its own beside the slope.
BINS = 8
#: Buckets that words, and pieces of PIECE bytes, are hashed into.
BUCKETS = 512
PIECE = 4
FEATURES = ("words", "word_length", "symbols", "exclaim", "upper", "digits", "pipes", "distinct", "repeats", "lines", "line_words",
            "repeated_lines", "letterless", "ends", "marked", "shouted", "top_word")


def features(column: pa.Array) -> np.ndarray:
    """Documents x FEATURES, from bytes, words and lines; a fixed number of passes over a slice."""
    data, offsets = flat_utf8(column)
    start, end, first = word_spans(data, offsets)
    n, n_bytes, n_words = len(offsets) - 1, np.diff(offsets), np.diff(first)
    of = np.repeat(np.arange(n), n_words)
    words = word_hashes(data, start, end)

    def total(mask: np.ndarray) -> np.ndarray:
        running = np.r_[0, np.cumsum(mask)]
        return running[offsets[1:]] - running[offsets[:-1]]

    def words_with(mask: np.ndarray) -> np.ndarray:
        running = np.r_[0, np.cumsum(mask)]
        return np.bincount(of, running[end] > running[start], n)

    letter = ((data | 0x20) >= 0x61) & ((data | 0x20) <= 0x7A) | (data >= 0x80)
    upper = (data >= 0x41) & (data <= 0x5A)
    digit = (data >= 0x30) & (data <= 0x39)
    space = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    symbol = ~(letter | digit | space | np.isin(data, np.frombuffer(b".,'\"-", np.uint8)))
    per_byte, per_word = np.maximum(n_bytes, 1), np.maximum(n_words, 1)
    again = np.r_[False, (words[1:] == words[:-1]) & (of[1:] == of[:-1])][: len(words)]
    order = np.lexsort((words, of))
    new = np.ones(len(words), bool)
    new[1:] = (words[order][1:] != words[order][:-1]) | (of[order][1:] != of[order][:-1])
    runs = np.diff(np.r_[np.flatnonzero(new), len(words)])
    top = np.zeros(n)
    np.maximum.at(top, of[order][new], runs)
    # A line's hash is the sum of its words' hashes, each mixed with its place.
    breaks = np.r_[0, np.cumsum(data == 0x0A)]
    line = breaks[start] + of if len(start) else np.zeros(0, np.int64)
    begins = np.flatnonzero(np.r_[True, np.diff(line) > 0][: len(line)])
    line_hash = np.add.reduceat(mix(words + np.arange(len(words), dtype=np.uint64) - np.repeat(begins, np.diff(np.r_[begins, len(words)])).astype(np.uint64)), begins) if len(begins) else np.zeros(0, np.uint64)
    line_of = of[begins]
    line_order = np.lexsort((line_hash, line_of))
    twice = np.zeros(len(line_hash), bool)
    twice[1:] = (line_hash[line_order][1:] == line_hash[line_order][:-1]) & (line_of[line_order][1:] == line_of[line_order][:-1])
    n_lines = np.bincount(line_of, minlength=n)
    last = np.zeros(n, bool)
    full = n_bytes > 0
    last[full] = np.isin(data[offsets[1:][full] - 1], np.frombuffer(b".!?\n", np.uint8))
    return np.stack([
        np.log1p(n_words), np.bincount(of, end - start, n) / per_word, total(symbol) / per_byte, total(data == 0x21) / per_byte,
        total(upper) / per_byte, total(digit) / per_byte, total(data == 0x7C) / per_byte, np.bincount(of[order], new, n) / per_word,
        np.bincount(of, again, n) / per_word, np.log1p(n_lines), n_words / np.maximum(n_lines, 1),
        np.bincount(line_of[line_order], twice, n) / np.maximum(n_lines, 1), (n_words - words_with(letter)) / per_word, last.astype(float),
        words_with(symbol) / per_word, words_with(upper & np.r_[upper[1:], False]) / per_word, top / per_word,
    ], 1)


def lexical(column: pa.Array) -> np.ndarray:
    """Documents x 2 BUCKETS: square roots of the shares of a document's words and pieces in each bucket."""
    data, offsets = flat_utf8(column)
    start, end, first = word_spans(data, offsets)
    n, n_words, n_bytes = len(offsets) - 1, np.diff(first), np.diff(offsets)
    of = np.repeat(np.arange(n), n_words)
    words = (word_hashes(data, start, end) >> np.uint64(55)).astype(np.int64)
    by_word = np.bincount(of * BUCKETS + words, minlength=n * BUCKETS).reshape(n, BUCKETS)
    m = max(len(data) - PIECE + 1, 0)
    code = np.zeros(m, np.uint32)
    for i in range(PIECE):
        code = code << np.uint32(8) | data[i : i + m]
    piece = ((code * np.uint32(2654435761)) >> np.uint32(23)).astype(np.int64)
    doc = np.repeat(np.arange(n), n_bytes)[:m]
    whole = np.arange(m) + PIECE <= offsets[1:][doc]  # pieces don't cross documents
    by_piece = np.bincount(doc[whole] * BUCKETS + piece[whole], minlength=n * BUCKETS).reshape(n, BUCKETS)
    shares = [np.sqrt(c / np.maximum(c.sum(1, keepdims=True), 1)) for c in (by_word, by_piece)]
    return np.hstack(shares).astype(np.float32)


@dataclass
class QualityModel:
    mean: np.ndarray
    spread: np.ndarray
    cuts: np.ndarray  # FEATURES x (BINS - 1)
    weights: np.ndarray
    threshold: float
    at_threshold: float

    def design(self, x: np.ndarray, said: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -5, 5)
        bins = (x[:, :, None] > self.cuts[None]).reshape(len(x), -1)
        return np.hstack([z, bins, said])

    def raw(self, x: np.ndarray, said: np.ndarray) -> np.ndarray:
        return self.design(x, said) @ self.weights

    def score(self, x: np.ndarray, said: np.ndarray) -> np.ndarray:
        """Between 0 and 1; at_threshold exactly where the raw score is at the threshold."""
        base = np.log(self.at_threshold / (1 - self.at_threshold))
        return 1 / (1 + np.exp(-np.clip(self.raw(x, said) - self.threshold + base, -40, 40)))


def preferences(x: np.ndarray, better: np.ndarray, worse: np.ndarray, w: np.ndarray) -> tuple[float, np.ndarray]:
    """Sum over the pairs of -log of the chance that x[better] @ w beats x[worse] @ w, and its gradient.  Differences of
    rows are never formed, only the scores of all rows and what each row won or lost beyond its chance."""
    s, n = x @ w, len(x)
    lead = s[better] - s[worse]
    won = 1 / (1 + np.exp(np.clip(lead, -500, 500)))
    return float(np.logaddexp(0, -lead).sum()), x.T @ (np.bincount(worse, won, n) - np.bincount(better, won, n))


def likeliest(value: Callable[[np.ndarray], tuple[float, np.ndarray]], m: int, steps: int) -> np.ndarray:
    """The least point of a smooth convex function of m weights, by L-BFGS; value(w) gives the function and its gradient."""
    w, past = np.zeros(m), []
    f, g = value(w)
    for _ in range(steps):
        d, told = g.copy(), []
        for a, b in reversed(past):
            told.append(a @ d / (a @ b))
            d -= told[-1] * b
        d *= past[-1][0] @ past[-1][1] / (past[-1][1] @ past[-1][1]) if past else 1 / (np.abs(g).sum() + 1e-30)
        for (a, b), t in zip(past, reversed(told), strict=True):
            d += (t - b @ d / (a @ b)) * a
        step, slope = 1.0, g @ d
        while True:
            to, (f1, g1) = w - step * d, value(w - step * d)
            if f1 <= f - 1e-4 * step * slope or step < 1e-6:
                break
            step /= 2
        if f1 >= f:
            break
        a, b, gained = to - w, g1 - g, f - f1
        w, f, g = to, f1, g1
        if a @ b > 0:
            past = [*past, (a, b)][-10:]
        if gained < 1e-7 * max(f, 1e-3) or np.abs(g).max() < 1e-8:
            break
    return w


def bradley_terry(x: np.ndarray, better: np.ndarray, worse: np.ndarray, ridge: float | np.ndarray = 1e-3, steps: int = 400) -> np.ndarray:
    """Weights w of the greatest penalised likelihood that x[better] @ w beats x[worse] @ w."""
    def value(w: np.ndarray) -> tuple[float, np.ndarray]:
        f, g = preferences(x, better, worse, w)
        return f / max(len(better), 1) + float(np.sum(ridge * w * w)) / 2, g / max(len(better), 1) + ridge * w

    return likeliest(value, x.shape[1], steps)


def pairs_of(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(better, worse): each row of the larger class PARTNERS times, against the rows of the other in turn."""
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    n = max(len(good), len(bad))
    turn = np.concatenate([np.arange(n) + k * (1 + min(len(good), len(bad)) // PARTNERS) for k in range(PARTNERS)])
    one = np.tile(np.arange(n), PARTNERS)
    return (good[one], bad[turn % len(bad)]) if len(good) >= len(bad) else (good[turn % len(good)], bad[one])


def _merged(at: int, y: list[bytes], x: list[bytes], said: list[bytes]) -> pa.Table:
    return pa.table({"part": pa.array([at], pa.int64()), "y": pa.array([b"".join(y)], pa.binary()), "x": pa.array([b"".join(x)], pa.binary()), "said": pa.array([b"".join(said)], pa.binary())})


def _packed(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, y, x, said): the features of the labelled of the rows (doc_id, x, said) in parts by a hash of the id, a row each;
    labels: (doc_id, y), an id once.  Features meet labels in their part, so they travel once and texts don't.  If
    both classes are there at all, every part has both."""
    told = {r.y: r["count"] for r in labels.groupBy("y").count().collect()}
    parts = 1
    while 2 * parts <= min(2 * sum(told.values()) // PART_ROWS, min(told.get(0, 0), told.get(1, 0)) // PART_LEAST):
        parts *= 2
    part = F.pmod(F.xxhash64("doc_id", F.lit(23)), F.lit(parts)).alias("part")
    kind = "part long, y binary, x binary, said binary"

    def pack(rows: pa.Table, labels: pa.Table) -> pa.Table:
        of = rows.column("doc_id").to_numpy()
        ids, order = np.unique(labels.column("doc_id").to_numpy(), return_index=True)
        known = np.isin(of, ids)
        if not known.any():
            return pa.table({"part": pa.array([], pa.int64()), **{c: pa.array([], pa.binary()) for c in ("y", "x", "said")}})
        y = labels.column("y").to_numpy().astype(np.int8)[order][np.searchsorted(ids, of[known])]
        rows = rows.filter(pa.array(known)).append_column("y", pa.array(y)).sort_by([("doc_id", "ascending"), ("x", "ascending"), ("said", "ascending")])
        return _merged(rows.column("part")[0].as_py(), [rows.column("y").to_numpy().tobytes()], rows.column("x").to_pylist(), rows.column("said").to_pylist())

    packed = rows.select(part, "doc_id", "x", "said").groupBy("part").cogroup(labels.select(part, "doc_id", "y").groupBy("part"))
    packed = materialize(packed.applyInArrow(pack, kind), "parts")
    # Labels may have no document, so a part may lack a class: then parts are joined in twos.
    classes = lambda p: packed.select(F.pmod("part", F.lit(p)).alias("part"), F.expr("instr(hex(y), '00') > 0").alias("bad"), F.expr("instr(hex(y), '01') > 0").alias("good"))
    fewer = parts
    while fewer > 1 and not classes(fewer).groupBy("part").agg(F.max("bad").alias("bad"), F.max("good").alias("good")).where("NOT (bad AND good)").isEmpty():
        fewer //= 2
    if fewer == parts:
        return packed

    def merge(some: pa.Table) -> pa.Table:
        some = some.sort_by("of")
        return _merged(some.column("part")[0].as_py(), *(some.column(c).to_pylist() for c in ("y", "x", "said")))

    joined = packed.select(F.pmod("part", F.lit(fewer)).alias("part"), F.col("part").alias("of"), "y", "x", "said").groupBy("part").applyInArrow(merge, kind)
    joined = materialize(joined, "parts")
    discard(packed)
    return joined


def train(docs: DataFrame, at_threshold: float, steps: int = STEPS, labels: DataFrame | None = None) -> QualityModel:
    """docs: (doc_id, text, y), or (doc_id, text), labelled or not, with labels (doc_id, y), an id once; of any number, every
    labelled row counts.  Tasks sum what their rows say; the driver gets sums."""
    m = len(FEATURES)
    labels = docs.select("doc_id", "y").distinct() if labels is None else labels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text", SMALL_SLICE_BYTES):
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([r.tobytes() for r in features(part.column("text"))], pa.binary()),
                 pa.array([r.tobytes() for r in lexical(part.column("text")).astype(np.float16)], pa.binary())], ["doc_id", "x", "said"]
            )

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for y, x in zip(batch.column("y").to_pylist(), batch.column("x").to_pylist(), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(y, np.int8).astype(np.int32)), pa.array(list(np.frombuffer(x).reshape(-1, m)), pa.list_(pa.float64()))], ["y", "v"])

    packed = _packed(docs.select("doc_id", "text").mapInArrow(run, "doc_id long, x binary, said binary"), labels)
    rows = packed.select("y", "x").mapInArrow(unpacked, "y int, v array<double>")
    counts = {r.y: r["count"] for r in rows.groupBy("y").count().collect()}
    n, n_bad = sum(counts.values()), counts.get(0, 0)
    width = m * BINS + 2 * BUCKETS
    if len(counts) < 2:
        discard(packed)
        share = float(np.clip(counts.get(1, 0) / max(n, 1), 1e-6, 1 - 1e-6))
        level = np.log(at_threshold / (1 - at_threshold)) - np.log(share / (1 - share))
        return QualityModel(np.zeros(m), np.ones(m), np.zeros((m, BINS - 1)), np.zeros(width), level, at_threshold)
    quantiles = [*(k / BINS for k in range(1, BINS - 1)), 0.97]
    each = [f(F.col("v")[k]) for k in range(m) for f in (F.avg, F.stddev_pop, lambda c: F.percentile_approx(c, quantiles, RANKS))]
    told = list(rows.agg(*[c.alias(f"c{k}") for k, c in enumerate(each)]).first())
    model = QualityModel(np.array(told[::3]), np.array(told[1::3]) + 1e-9, np.array(told[2::3]), np.zeros(width), 0.0, at_threshold)
    parts = packed.rdd
    # Buckets hold many words each, so their weights are held back more than those of the statistics.
    ridge = np.r_[np.full(m * BINS, 1e-3), np.full(2 * BUCKETS, 1e-2)]

    def value(w: np.ndarray) -> tuple[float, np.ndarray]:
        def told(at: int, some) -> Iterator[tuple]:
            pairs, loss, slope = 0, 0.0, np.zeros(width)
            for part in some:
                y, x = np.frombuffer(part.y, np.int8), np.frombuffer(part.x).reshape(-1, m)
                better, worse = pairs_of(y)
                f, g = preferences(model.design(x, np.frombuffer(part.said, np.float16).reshape(len(y), -1).astype(np.float32)), better, worse, w)
                pairs, loss, slope = pairs + len(better), loss + f, slope + g
            yield at, pairs, loss, slope

        sums = sorted(parts.mapPartitionsWithIndex(told).collect(), key=lambda t: t[0])  # a gradient for each task
        pairs = sum(t[1] for t in sums)
        return sum(t[2] for t in sums) / pairs + float(np.sum(ridge * w * w)) / 2, sum(t[3] for t in sums) / pairs + ridge * w

    model.weights = likeliest(value, width, steps)

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, said in zip(batch.column("x").to_pylist(), batch.column("said").to_pylist(), strict=True):
                x = np.frombuffer(x).reshape(-1, m)
                yield pa.RecordBatch.from_arrays([pa.array(model.raw(x, np.frombuffer(said, np.float16).reshape(len(x), -1).astype(np.float32)))], ["s"])

    ends = packed.select("x", "said").mapInArrow(scores, "s double").agg(F.percentile_approx("s", [n_bad / n, min(1.0, (n_bad + 1) / n)], RANKS)).first()[0]
    model.threshold = ends[0] + (1 - n_bad / n) * (ends[1] - ends[0])
    discard(packed)
    return model


def score_quality(docs: DataFrame, labels: DataFrame, learnable, id_col: str = "doc_id", text_col: str = "text",
                  threshold: float = 0.3) -> DataFrame:
    """doc_id, score, predicted of every row: how likely a whole text is a good one.

    Learns from all rows of labels (doc_id, quality) for which `learnable` holds; labels, ids and other
    columns are no inputs of a score.  The score is `threshold` at the quantile that parts the labelled documents'
    good from their bad ones in number.  Null counts as empty; an empty text
    has a score like any other.  Without labels of both classes the score is
    their share, or 0.  Rows keep their number and ids; equal texts get equal
    scores.
    """
    rows = bounded_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    may, clean = maybe_labelled(rows, labels, "quality", learnable)
    shared = docs.sparkSession.sparkContext.broadcast(train(may, threshold, labels=clean))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text", SMALL_SLICE_BYTES):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(shared.value.score(features(part.column("text")), lexical(part.column("text"))))], ["doc_id", "score"])

    return rows.mapInArrow(run, "doc_id long, score double").withColumn("predicted", (F.col("score") >= threshold).cast("int"))
