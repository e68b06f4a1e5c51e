"""Toxicity by weak supervision.

Lexicons are mined from a bounded sample of labelled documents: words and word
stems that stand out in toxic ones, and such that stand out in clean ones.
They are dealt into many voters of either polarity, beside one that says clean
where all toxic lexicons are silent, and pattern voters for shouting and junk.  A generative model, which doesn't see the labels, estimates how
often each voter votes which way in either class, and how it does so given the
vote of the voter that it depends on most beyond the class: these pairwise
factors form a forest.  Its posterior labels train a linear classifier on the
single words, stems and patterns; that classifier scores every document.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedwright.llm.common import bounded_batches, discard, text_slices
from feedwright.llm.labelled import labelled_sample
from feedwright.llm.wordhash import flat_utf8, mix, phrase_hashes, word_hashes, word_spans

#: Labelled documents to learn from.
MAX_LABELLED = 8000
STEMS = (4, 5, 6, 7)
#: Least likelihood-ratio statistic, rate ratio and precision of a word that enters a lexicon.
LEAST_G2, LEAST_RATIO, LEAST_PRECISION = 16.0, 8.0, 0.8
VOTERS_PER_KIND = 8
#: Least correlation beyond the class that makes a pairwise factor.
STRONG = 0.2
#: Random projections that tell near copies in the sample from different documents.
COPY_HASHES = 16
#: Separators of the words here: every ASCII character but letters and digits.
_LETTERS = np.ones(256, bool)
_LETTERS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
PATTERNS = ("upper", "exclaim", "symbols", "digits", "repeats", "pipes")


@dataclass
class Units:
    """Hashed words and stems of a slice, each once per document, and patterns of the documents."""

    document: np.ndarray
    unit: np.ndarray
    kind: np.ndarray
    patterns: np.ndarray
    copies: np.ndarray | None


def units_of(column: pa.Array, wanted: np.ndarray | None = None, sketch: bool = False) -> Units:
    """wanted: sorted hashes; others are left out before documents are told apart."""
    plain = pc.fill_null(column.cast(pa.large_string()), "")
    raw, offsets = flat_utf8(plain)
    lowered, low_offsets = flat_utf8(pc.utf8_lower(plain))
    start, end, first = word_spans(lowered, low_offsets, _LETTERS)
    n_words = np.diff(first)
    of = np.repeat(np.arange(len(n_words)), n_words)
    words = word_hashes(lowered, start, end)
    found = []
    for kind, stem in enumerate((0, *STEMS)):
        long = np.ones(len(start), bool) if not stem else end - start >= stem
        h = words if not stem else word_hashes(lowered, start[long], start[long] + stem)
        h, d = mix(h ^ np.uint64(kind * 2 + 1)), of[long]
        if wanted is not None:
            place = np.minimum(np.searchsorted(wanted, h), max(len(wanted) - 1, 0))
            hit = wanted[place] == h if len(wanted) else np.zeros(len(h), bool)
            h, d = h[hit], d[hit]
        if len(h):
            order = np.lexsort((h, d))
            h, d = h[order], d[order]
            new = np.r_[True, (h[1:] != h[:-1]) | (d[1:] != d[:-1])]
            found.append((d[new], h[new], np.full(int(new.sum()), kind, np.int8)))
    pieces = [np.concatenate([f[i] for f in found]) if found else np.zeros(0, t) for i, t in enumerate((np.int64, np.uint64, np.int8))]

    def share(mask: np.ndarray) -> np.ndarray:
        total = np.r_[0, np.cumsum(mask)]
        return (total[offsets[1:]] - total[offsets[:-1]]) / np.maximum(np.diff(offsets), 1)

    again = np.r_[False, (words[1:] == words[:-1]) & (of[1:] == of[:-1])]
    repeats = np.bincount(of, again, len(n_words)) / np.maximum(n_words, 1)
    is_upper = (raw >= 0x41) & (raw <= 0x5A)
    symbol = (raw < 0x80) & _LETTERS[raw] & ~np.isin(raw, np.frombuffer(b" \t\n\r.,'\"-", np.uint8))
    patterns = np.stack([share(is_upper), share(raw == 0x21), share(symbol), share((raw >= 0x30) & (raw <= 0x39)), repeats, share(raw == 0x7C)], 1)
    copies = None
    if sketch:
        flips = mix(np.arange(1, COPY_HASHES + 1, dtype=np.uint64))
        shingles = phrase_hashes(words, 5)
        copies = np.zeros((len(n_words), COPY_HASHES), np.uint64)
        for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
            own = shingles[a : max(b - 4, a)] if b - a >= 5 else words[a:b]
            copies[i] = [mix(own ^ f).min() for f in flips] if len(own) else 0
    return Units(*pieces, patterns, copies)


def different(sketches: np.ndarray, alike: int = COPY_HASHES // 2) -> np.ndarray:
    """True for rows that share fewer than `alike` sketch values with each earlier row that is kept:
    near copies count once."""
    seen: list[dict] = [{} for _ in range(sketches.shape[1])]
    keep = np.zeros(len(sketches), bool)
    for i, row in enumerate(sketches.tolist()):
        shared = Counter(j for v, s in zip(row, seen, strict=True) for j in s.get(v, ()))
        if max(shared.values(), default=0) < alike:
            keep[i] = True
            for v, s in zip(row, seen, strict=True):
                s.setdefault(v, []).append(i)
    return keep


def spanning_forest(beyond: np.ndarray) -> np.ndarray:
    """parent[j], or -1: the forest of the strongest dependences, each tree from its first voter on."""
    m = len(beyond)
    parent, left = np.full(m, -1), set(range(m))
    while left:
        tree = [min(left)]
        left.discard(tree[0])
        while left:
            rest = sorted(left)
            strength = beyond[np.ix_(tree, rest)]
            i, j = np.unravel_index(int(strength.argmax()), strength.shape)
            if strength[i, j] <= 0:
                break
            parent[rest[j]] = tree[i]
            tree.append(rest[j])
            left.discard(rest[j])
    return parent


@dataclass
class LabelModel:
    """chance[j, y, v]: how often voter j says v (0 nothing, 1 toxic, 2 clean) in class y; factor[j, y, u, v]: the
    same where the voter parent[j], the one that it depends on most beyond the class, says u (parent -1: none);
    prior: share of class 1; weight[j]: what a vote counts before the model is fitted."""

    chance: np.ndarray
    factor: np.ndarray
    parent: np.ndarray
    weight: np.ndarray
    prior: float
    correlation: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        m = votes.shape[1]
        if not m:
            return np.full(len(votes), self.prior)
        above = np.where(self.parent >= 0, votes[:, self.parent], 0)
        gain = [np.log(self.factor[np.arange(m), y, above, votes]).sum(1) for y in (0, 1)]
        odds = gain[1] - gain[0] + np.log(self.prior / (1 - self.prior))
        return 1 / (1 + np.exp(-np.clip(odds, -60, 60)))

    def learn(self, votes: np.ndarray, p: np.ndarray) -> None:
        """The likeliest parameters if p says how likely each row is of class 1."""
        n, m = votes.shape
        counts = np.zeros((m, 2, 3, 3))
        above = np.where(self.parent >= 0, votes[:, self.parent], 0)
        for y, weight in enumerate((1 - p, p)):
            for j in range(m):
                counts[j, y] = np.bincount(above[:, j] * 3 + votes[:, j], weight, 9).reshape(3, 3)
        own = counts.sum(2)
        self.chance = (own + 0.5) / (own.sum(2, keepdims=True) + 1.5)
        # A pair of votes that is rare in a class falls back to the voter's own rate there.
        self.factor = (counts + 2 * self.chance[:, :, None, :]) / (counts.sum(3, keepdims=True) + 2)

    @classmethod
    def fit(cls, votes: np.ndarray, prior: float | None = None, steps: int = 10, sums: tuple[int, ...] = ()) -> LabelModel:
        """The forest of correlations first, then expectation-maximisation over the votes alone.

        If voters depended on each other through the class only, the correlation of two would be
        the product of each one's own with the class; triples of voters give these (the median
        over triples bears a few dependent ones).  What a correlation has beyond the product is a
        dependence; the strongest ones form the forest whose factors the model has.  A known
        share of class 1 is given as prior and kept.  Voters named in sums say what others say
        together; they take no part in the forest."""
        n, m = votes.shape
        signed = np.where(votes == 2, -1, votes).astype(float)
        centred = signed - signed.mean(0)
        spread = np.sqrt((centred**2).mean(0)) + 1e-9
        c = (centred.T @ centred) / max(n, 1) / np.outer(spread, spread)
        own = np.zeros(m)
        for j in range(m):
            others = np.delete(np.arange(m), j)
            k, l = (others[i] for i in np.triu_indices(len(others), 1))  # noqa: E741
            sure = np.abs(c[k, l]) > 0.02
            if sure.any():
                own[j] = np.sqrt(np.clip(np.median(np.abs(c[j, k] * c[j, l] / np.where(sure, c[k, l], 1))[sure]), 0, 1))
        beyond = np.maximum(c - np.outer(own, own) - 0.1, 0)
        np.fill_diagonal(beyond, 0)
        strong = np.where(beyond > STRONG, beyond, 0)
        strong[list(sums)] = strong[:, list(sums)] = 0
        model = cls(np.full((m, 2, 3), 1 / 3), np.full((m, 2, 3, 3), 1 / 3), spanning_forest(strong), 1 / (1 + beyond.sum(1)), 0.5, c)
        p = np.clip(0.5 + 0.45 * np.sign(signed @ model.weight), 0.05, 0.95)
        for _ in range(steps):
            model.learn(votes, p)
            model.prior = float(np.clip(p.mean() if prior is None else prior, 0.01, 0.99))
            p = model.posterior(votes)
        return model


@dataclass
class Hits:
    """Which units each document has: units[start[i] : start[i+1]], each once."""

    start: np.ndarray
    units: np.ndarray
    width: int

    @classmethod
    def of(cls, rows: list, width: int) -> Hits:
        sizes = np.array([len(r) for r in rows], np.int64)
        return cls(np.r_[0, np.cumsum(sizes)], np.concatenate([np.zeros(0, np.int64), *rows]).astype(np.int64), width)

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.start) - 1), np.diff(self.start))

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.units], len(self.start) - 1)

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.units, r[self.row], self.width)

    def any_of(self, chosen: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, chosen[self.units], len(self.start) - 1) > 0


def logistic(x: Hits, dense: np.ndarray, y: np.ndarray, penalty: np.ndarray, steps: int = 300) -> np.ndarray:
    """Weights (units, dense columns, intercept) of a ridge logistic regression on soft labels y, by accelerated gradients."""
    n = len(y)
    d = np.hstack([dense, np.ones((n, 1))])
    penalty = np.r_[penalty, 0]
    # A diagonal that majorises the curvature: rare features, in rows with few others, take long steps.
    size = np.diff(x.start) + np.abs(d).sum(1)
    curve = 0.25 * np.r_[x.back(size.astype(float)), np.abs(d).T @ size] / n + penalty / n + 1e-9
    w = v = np.zeros(x.width + d.shape[1])
    for t in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x.times(v[: x.width]) + d @ v[x.width :], -30, 30)))
        new = v - (np.r_[x.back(p - y), d.T @ (p - y)] / n + penalty * v / n) / curve
        w, v = new, new + t / (t + 3) * (new - w)
    return w


@dataclass
class ToxicityModel:
    units: np.ndarray
    weights: np.ndarray
    pattern_cuts: np.ndarray
    pattern_weights: np.ndarray
    intercept: float

    def score(self, column: pa.Array) -> np.ndarray:
        found = units_of(column, self.units)
        total = np.full(len(column), self.intercept)
        if len(found.unit):
            total += np.bincount(found.document, self.weights[np.searchsorted(self.units, found.unit)], len(column))
        total += (found.patterns > self.pattern_cuts) @ self.pattern_weights
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def constant(share: float) -> ToxicityModel:
    share = min(max(share, 1e-6), 1 - 1e-6)
    return ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), np.zeros(len(PATTERNS)), np.zeros(len(PATTERNS)), float(np.log(share / (1 - share))))


def train(sample: DataFrame) -> ToxicityModel:
    """sample: (doc_id, text, y), bounded.  Only hashes, counts and votes of it come to the driver."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text"):
            copies = units_of(part.column("text"), np.zeros(0, np.uint64), sketch=True).copies
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("y"), pa.array([r.tobytes() for r in copies], pa.binary())], ["doc_id", "y", "sketch"])

    rows = sorted(sample.mapInArrow(sketch, "doc_id long, y int, sketch binary").collect(), key=lambda r: (r.doc_id, r.y))
    y = np.array([r.y for r in rows])
    if len(set(y.tolist())) < 2:
        return constant(float(y.mean()) if len(y) else 0.0)
    kept = different(np.stack([np.frombuffer(r.sketch, np.uint64) for r in rows]))
    ids = {r.doc_id for r, k in zip(rows, kept.tolist(), strict=True) if k}
    n_toxic, n_clean = int(y[kept].sum()), int((1 - y[kept]).sum())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text"):
            chosen = part.filter(pa.array([i in ids for i in part.column("doc_id").to_pylist()]))
            if chosen.num_rows:
                found = units_of(chosen.column("text"))
                unit, place = np.unique(found.unit, return_inverse=True)
                toxic = np.bincount(place, chosen.column("y").to_numpy()[found.document], len(unit)).astype(np.int64)
                total = np.bincount(place, minlength=len(unit))
                kind = np.zeros(len(unit), np.int32)
                kind[place] = found.kind
                yield pa.RecordBatch.from_arrays([pa.array(unit.view(np.int64)), pa.array(kind), pa.array(toxic), pa.array(total - toxic)], ["unit", "kind", "toxic", "clean"])

    counted = sample.mapInArrow(count, "unit long, kind int, toxic long, clean long").groupBy("unit", "kind").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b"))
    all_, share = n_toxic + n_clean, n_toxic / (n_toxic + n_clean)
    g2 = f"2 * (a * ln(greatest(a, 0.5) / ((a + b) * {share})) + b * ln(greatest(b, 0.5) / ((a + b) * {1 - share})))"
    ratio = f"((a + 0.5) / {n_toxic + 1}) / ((b + 0.5) / {n_clean + 1})"
    toxic_unit = f"a >= 4 AND {ratio} >= {LEAST_RATIO} AND a >= {LEAST_PRECISION} * (a + b)"
    # What is left is bounded by the sample: no unit is in fewer than four of its documents.
    lexicon = counted.withColumn("toxic", F.expr(toxic_unit)).where(f"toxic OR (b >= 4 AND {ratio} <= {1 / LEAST_RATIO})").where(F.expr(g2) >= LEAST_G2)
    lexicon = sorted(lexicon.select("unit", "kind", "toxic").collect(), key=lambda r: np.uint64(r.unit % 2**64))
    toxic = np.array([r.toxic for r in lexicon], bool)
    if not toxic.any():  # nothing stands out: patterns alone say nothing of toxicity
        return constant(float(y.mean()))
    every = np.array([r.unit for r in lexicon], np.int64).view(np.uint64)
    kinds = np.array([r.kind for r in lexicon], np.int64)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text"):
            chosen = part.filter(pa.array([i in ids for i in part.column("doc_id").to_pylist()]))
            if chosen.num_rows:
                found = units_of(chosen.column("text"), every)
                order = np.argsort(found.document, kind="stable")
                cuts = np.searchsorted(found.document[order], np.arange(1, chosen.num_rows))
                hits = [h.tolist() for h in np.split(np.searchsorted(every, found.unit)[order], cuts)]
                yield pa.RecordBatch.from_arrays(
                    [chosen.column("doc_id"), pa.array(hits, pa.list_(pa.int64())), pa.array(found.patterns.tolist(), pa.list_(pa.float64()))], ["doc_id", "hits", "patterns"]
                )

    learned = sorted(sample.mapInArrow(features, "doc_id long, hits array<long>, patterns array<double>").collect(), key=lambda r: r.doc_id)
    x = Hits.of([r.hits for r in learned], len(every))
    patterns = np.array([r.patterns for r in learned])
    cuts = np.quantile(patterns, 0.95, axis=0)
    shouts = patterns > cuts
    voters = kinds * VOTERS_PER_KIND + (every % np.uint64(VOTERS_PER_KIND)).astype(np.int64)
    votes = [np.where(x.any_of(toxic & (voters == g)), 1, 0) for g in np.unique(voters[toxic])]
    votes += [np.where(x.any_of(~toxic & (kinds == k)) & ~x.any_of(toxic), 2, 0) for k in np.unique(kinds[~toxic])]
    silence = len(votes)
    votes += [np.where(x.any_of(toxic), 1, 2)]  # nothing in any lexicon says clean
    votes += [s.astype(int) for s in shouts.T]
    model = LabelModel.fit(np.stack(votes, 1), share, sums=(silence,))
    target = model.posterior(np.stack(votes, 1))
    # The classifier's words are the toxic ones: it rejects for what is there, not for what is missing.
    numbers = np.cumsum(toxic) - 1
    toxic_hits = Hits.of([numbers[np.array([u for u in r.hits if toxic[u]], np.int64)] for r in learned], int(toxic.sum()))
    w = logistic(toxic_hits, shouts.astype(float), target, np.r_[np.full(toxic_hits.width, 0.02), np.full(len(cuts), 50.0)])
    n = toxic_hits.width
    return ToxicityModel(every[toxic], w[:n], cuts, w[n:-1], float(w[-1]))


def score_toxicity(docs: DataFrame, labels: DataFrame, learnable, id_col: str = "doc_id", text_col: str = "text",
                   threshold: float = 0.7, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """doc_id, score, predicted of every row: the chance that a whole text is toxic.

    Learns from at most about max_labelled rows of labels (doc_id, toxic) for
    which `learnable` holds; labels, ids and other columns are no inputs of a
    score.  Null counts as empty; an empty text has a score like any other.
    Without labels of both classes the score is their share, or 0.  Rows keep
    their number and ids; equal texts get equal scores.
    """
    rows = bounded_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sample = labelled_sample(rows, labels, "toxic", learnable, max_labelled)
    shared = docs.sparkSession.sparkContext.broadcast(train(sample))
    discard(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(shared.value.score(part.column("text")))], ["doc_id", "score"])

    return rows.mapInArrow(run, "doc_id long, score double").withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def documents_without_toxic(docs: DataFrame, labels: DataFrame, learnable, id_col: str = "doc_id", text_col: str = "text",
                            threshold: float = 0.7, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """The rows of docs whose text score_toxicity() scores below the threshold, unchanged and not shuffled."""
    rows = bounded_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sample = labelled_sample(rows, labels, "toxic", learnable, max_labelled)
    shared = docs.sparkSession.sparkContext.broadcast(train(sample))
    discard(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, text_col):
            yield part.filter(pa.array(shared.value.score(part.column(text_col)) < threshold))

    return docs.mapInArrow(run, docs.schema)
