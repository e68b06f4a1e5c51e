"""N-gram Jaccard join by a MinHash LSH forest with exact verification.

Each tree of the forest orders the documents by a path of MinHash values, a
trie.  Documents that share a path's first d steps in any tree are candidates.
Every document begins with long prefixes and shortens its own: it is done at
the depth at which the weakest of the partners it was found to have, or one at
the threshold where it has none, is found by the target chance; until then it
looks again, one step less deep, and what it shares there with any document,
done or not, is a candidate.

Candidates are never listed as pairs.  Groups of connected candidates are cut
into blocks of bounded size, by bands of set sizes: only blocks of the same or
of neighbouring bands can hold similar sets.  Two such blocks at a time meet in
one task, which counts shared shingles exactly and returns sums and a spanning
forest.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedwright.llm.common import SMALL_SLICE_BYTES, bounded_batches, discard, materialize, own_key, text_slices
from feedwright.llm.wordhash import flat_utf8, mix, phrase_hashes, phrase_mask, word_hashes, word_spans
from feedwright.llm.bloom import probed_in
from feedwright.operators.graph import components
from feedwright.operators.skew import dealt

WORDS = 5
THRESHOLD = 0.8
TREES = 20
#: The chance of being found that a document's weakest partner must have before it stops shortening.
RECALL = 0.995
#: Chance of finding a pair at the threshold at the first and the last depth.
FIRST_CHANCE, LAST_CHANCE = 0.99, 0.9995
BLOCK_SHINGLES = 1_000_000
BLOCK_DOCUMENTS = 400
SALTS = 64
MAX_FILTER_BITS = 1 << 27
_ROW_BITS = 32768


def chance(similarity, depth: int, trees: int):
    """Chance that a pair shares the first `depth` steps in any of the trees."""
    return 1 - (1 - np.asarray(similarity, float) ** depth) ** trees


def deepest(threshold: float, trees: int, least: float) -> int:
    depth = 1
    while chance(threshold, depth + 1, trees) >= least and depth < 16:
        depth += 1
    return depth


def shingle_sets(column: pa.Array, n: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each document.

    A text of fewer than n words, none included, has one shingle: all its words."""
    data, offsets = flat_utf8(column)
    start, end, first = word_spans(data, offsets)
    words = word_hashes(data, start, end)
    shingles, whole = phrase_hashes(words, n), phrase_mask(first, n, len(words))
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= n:
            out.append(np.unique(shingles[a:b][whole[a:b]]))
        else:
            out.append(mix(phrase_hashes(words[a:b], b - a, 1) if b > a else np.zeros(1, np.uint64)))
    return out


def _functions(count: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.Generator(np.random.PCG64(8128))
    draw = lambda: r.integers(0, 2**32, count, dtype=np.uint32)
    return draw() | np.uint32(1), draw()


def signature(shingles: np.ndarray, multiply: np.ndarray, flip: np.ndarray) -> np.ndarray:
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(multiply), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 2048):
        np.minimum(least, ((x[at : at + 2048, None] ^ flip) * multiply).min(axis=0), out=least)
    return least


def set_hash(shingles: np.ndarray) -> tuple[int, int]:
    two = [int(mix(shingles ^ np.uint64(c)).sum(dtype=np.uint64).view(np.int64)) for c in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
    return two[0], two[1]


def prefixes(labels: np.ndarray, depth: int) -> np.ndarray:
    """One number for the first `depth` steps of each tree; labels: documents x trees x steps."""
    out = np.zeros(labels.shape[:2], np.uint64)
    for d in range(depth):
        out = mix(out * np.uint64(31) + labels[:, :, d].astype(np.uint64) + np.uint64(1))
    return mix(out + np.arange(labels.shape[1], dtype=np.uint64))


def _share(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.zeros((len(a), len(b)), bool)
    for tree in range(a.shape[1]):
        out |= a[:, tree][:, None] == b[:, tree][None, :]
    return out


def intersections(sets_a: list[np.ndarray], sets_b: list[np.ndarray], wanted: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the wanted pairs: one at a time if few, else by
    products of the incidence of those shingles that occur in both blocks."""
    out = np.zeros(wanted.shape, np.int64)
    pairs = np.argwhere(wanted)
    if not len(pairs):
        return out
    a, b = np.concatenate(sets_a), np.concatenate(sets_b)
    common, n = np.unique(np.concatenate([np.unique(a), np.unique(b)]), return_counts=True)
    common = common[n > 1]
    one_by_one = len(pairs) * (5e-6 + 4e-8 * (len(a) + len(b)) / (len(sets_a) + len(sets_b)))
    if one_by_one < wanted.size * len(common) * 1e-10:
        for i, j in pairs.tolist():
            out[i, j] = _merged(sets_a[i], sets_b[j])
        return out
    incidence = []
    for sets, flat in ((sets_a, a), (sets_b, b)):
        place = np.minimum(np.searchsorted(common, flat), max(len(common) - 1, 0))
        there = common[place] == flat if len(common) else np.zeros(len(flat), bool)
        incidence.append((np.repeat(np.arange(len(sets)), [len(s) for s in sets])[there], place[there]))
    for at in range(0, len(common), 4096):
        width = min(4096, len(common) - at)
        part = []
        for sets, (row, place) in zip((sets_a, sets_b), incidence, strict=True):
            here = (place >= at) & (place < at + width)
            m = np.zeros((len(sets), width), np.float32)
            m[row[here], place[here] - at] = 1
            part.append(m)
        out += np.rint(part[0] @ part[1].T).astype(np.int64)
    return out


def _merged(a: np.ndarray, b: np.ndarray) -> int:
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def links_between(labels_a, labels_b, sets_a, sets_b, open_a, open_b, depth: int, before: int | None, threshold: Fraction, same: bool):
    """(linked, similarity): the new verified pairs of two blocks at this depth.

    One of a pair must still be looking.  Pairs that the forest found at the depth before are left
    out; so is, in a block with itself, everything on or below the diagonal."""
    wanted = _share(prefixes(labels_a, depth), prefixes(labels_b, depth)) & (open_a[:, None] | open_b[None, :])
    if before is not None:
        wanted &= ~_share(prefixes(labels_a, before), prefixes(labels_b, before))
    if same:
        wanted &= np.triu(np.ones(wanted.shape, bool), 1)
    size_a, size_b = np.array([len(s) for s in sets_a]), np.array([len(s) for s in sets_b])
    small, large = np.minimum(size_a[:, None], size_b), np.maximum(size_a[:, None], size_b)
    wanted &= small * threshold.denominator >= large * threshold.numerator
    shared = intersections(sets_a, sets_b, wanted)
    union = size_a[:, None] + size_b - shared
    linked = wanted & (shared * threshold.denominator >= union * threshold.numerator)
    return linked, shared / np.maximum(union, 1)


def _roots(linked: np.ndarray) -> np.ndarray:
    """The first member of each member's connected group."""
    root = np.arange(len(linked))
    while True:
        near = np.where(linked, root[None, :], len(linked)).min(axis=1, initial=len(linked))
        lower = np.minimum(root, near)
        lower = lower[lower]
        if (lower == root).all():
            return root
        root = lower


def jaccard_join(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, threshold: float = THRESHOLD,
    trees: int = TREES, recall: float = RECALL,
) -> DataFrame:
    """doc_id, class_id, n_links, kept of every row; own, a key of the row's id and text.

    Two rows are linked if the Jaccard similarity of their sets of shingles of
    `words` consecutive words (runs without space or the controls 9 to 13,
    unchanged) is at least `threshold`; n_links counts a row's linked rows,
    copies included.  A class is a connected group of linked rows, named by its
    smallest id; the row that has it stays.  Null counts as empty; texts
    without words are alike, and a text of fewer words than a shingle has one
    shingle.  Rows of one id with different texts are different documents: of
    those that would both stay in a class, one does.  A row that is repeated
    with its id and text links to its twin, and both carry the same flags.  A
    row without id counts like another, after all ids; a class of such rows has
    no name, and one of them stays.  Other columns are ignored.  An empty table
    gives an empty result.  A text of any length is one row's work.
    """
    exact = Fraction(str(threshold))
    first, last = deepest(threshold, trees, FIRST_CHANCE), deepest(threshold, trees, LAST_CHANCE)
    multiply, flip = _functions(trees * first)
    docs = bounded_batches(df).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    docs = docs.withColumn("own", own_key("doc_id", "text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text", SMALL_SLICE_BYTES):
            sets = shingle_sets(part.column("text"), words)
            hashes = [set_hash(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("own"), pa.array([h for h, _ in hashes], pa.int64()), pa.array([h for _, h in hashes], pa.int64()),
                 pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([signature(s, multiply, flip).tobytes() for s in sets], pa.binary())],
                ["doc_id", "own", "h1", "h2", "size", "labels"],
            )

    signed = materialize(docs.mapInArrow(sign, "doc_id long, own long, h1 long, h2 long, size long, labels binary"), "signatures")

    # Rows with the same set are one representative, counted in salted parts.
    members = signed.select("doc_id", "own", "h1", "h2", F.pmod(F.xxhash64("own", F.lit(1)), F.lit(SALTS)).cast("int").alias("salt"))
    lead = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "own")
    parts = members.groupBy("h1", "h2", "salt").agg(F.min(lead).alias("lead"), F.count("*").alias("n"))
    groups = parts.groupBy("h1", "h2").agg(F.min("lead").alias("lead"), F.sum("n").alias("copies"), F.collect_set("salt").alias("salts"))
    # Written once, so the numbers of the sets stay what they are.
    groups = materialize(groups.withColumn("node", F.monotonically_increasing_id()), "sets")
    reps = signed.select("own", "h1", "h2", "size", "labels").join(
        groups.select("h1", "h2", F.col("lead.own").alias("own"), "node", "copies"), ["h1", "h2", "own"]
    )
    reps = materialize(reps.dropDuplicates(["node"]).withColumn("looks", F.lit(True)), "representatives")

    rounds: list[DataFrame] = []
    for depth in range(first, last - 1, -1):
        rounds.append(_verify_round(docs, reps, words, trees, first, depth, None if depth == first else depth + 1, exact))
        if depth == last or chance(threshold, depth, trees) >= recall:
            break  # whoever still looks has met the target here
        weakest = rounds[0].select("node", "weakest")
        for more in rounds[1:]:
            weakest = weakest.unionByName(more.select("node", "weakest"))
        weakest = weakest.groupBy("node").agg(F.min("weakest").alias("weakest"))
        missed = F.pow(1 - F.pow(F.coalesce("weakest", F.lit(threshold)), F.lit(depth)), F.lit(trees))
        again = reps.join(weakest, "node", "left").withColumn("looks", F.col("looks") & (1 - missed < F.lit(recall))).drop("weakest")
        again = materialize(again, "representatives")
        discard(reps)
        reps = again
        if reps.where("looks").isEmpty():
            break
    found = rounds[0]
    for more in rounds[1:]:
        found = found.unionByName(more)

    labels = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = groups.select("node", "lead").join(labels, "node")
    leads = named.groupBy("label").agg(F.min("lead").alias("class"))
    classes = dealt(labels, leads, ["label"], "node").select("node", "class")
    answer = (
        groups.join(links, "node", "left").join(classes, "node", "left")
        .select("h1", "h2", F.coalesce("class", "lead").alias("class"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.explode("salts").alias("salt"))
    )
    return members.join(answer, ["h1", "h2", "salt"]).select(
        "doc_id", F.col("class.doc_id").alias("class_id"), "n_links",
        (F.col("doc_id").eqNullSafe(F.col("class.doc_id")) & (F.col("own") == F.col("class.own"))).alias("kept"), "own"
    )


def _block(band, part):
    return band.cast("long") * (1 << 32) + part


def _placed(sized: DataFrame) -> DataFrame:
    """Adds large, block, and other, the blocks that a row's block must meet.

    A group that is too large for one block is cut by bands of sizes and then by a hash; sets of
    bands that aren't neighbours differ too much in size to be similar."""
    whole = sized.groupBy("label").agg(F.sum("size").alias("total"), F.count("*").alias("n"))
    whole = whole.select("label", F.expr(f"total > {BLOCK_SHINGLES} OR n > {BLOCK_DOCUMENTS}").alias("large"))
    rows = dealt(sized, whole, ["label"], "node")
    banded = rows.withColumn("band", F.when(F.col("large"), F.col("band")).otherwise(0))
    bands = banded.groupBy("label", "band").agg(F.sum("size").alias("total"), F.count("*").alias("n"), F.first("large").alias("large"))
    parts = F.when(F.col("large"), F.greatest(F.ceil(F.col("total") / BLOCK_SHINGLES), F.ceil(F.col("n") / BLOCK_DOCUMENTS))).otherwise(1).cast("int")
    bands = bands.select("label", "band", parts.alias("parts"))
    near = lambda step: bands.select("label", (F.col("band") - step).alias("band"), F.col("parts").alias(f"parts{step}"))
    bands = bands.join(near(1), ["label", "band"], "left").join(near(-1), ["label", "band"], "left")
    met = dealt(banded, bands, ["label", "band"], "node")
    own = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")

    def blocks(parts: str, step: int):
        n, at = F.coalesce(F.col(parts), F.lit(0)), F.col("band") + step
        return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: _block(at, i))).otherwise(F.array().cast("array<bigint>"))

    others = F.concat(blocks("parts", 0), blocks("parts1", 1), blocks("parts-1", -1))
    return met.withColumn("block", _block(F.col("band"), own)).withColumn("other", F.explode(others)).drop("band", "parts", "parts1", "parts-1")


def _verify_round(docs: DataFrame, reps: DataFrame, words: int, trees: int, steps: int, depth: int, before: int | None, exact: Fraction) -> DataFrame:
    """(node, root, links, weakest): new links of each representative at one depth, and its least similarity."""
    spark = docs.sparkSession

    def paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blob = b"".join(batch.column("labels").to_pylist())
            keys = prefixes(np.frombuffer(blob, np.uint32).reshape(-1, trees, steps), depth)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(batch.column("node").to_numpy(), trees)), pa.array(np.repeat(batch.column("looks").to_numpy(zero_copy_only=False), trees)),
                 pa.array(keys.ravel().view(np.int64))], ["node", "looks", "key"]
            )

    leaves = reps.select("node", "looks", "labels").mapInArrow(paths, "node long, looks boolean, key long")
    nodes = leaves.groupBy("key").agg(F.min("node").alias("hub"), F.count("*").alias("n"), F.bool_or("looks").alias("asked")).where("n > 1 AND asked").select("key", "hub")
    edges = dealt(leaves, nodes, ["key"], "node", 4).where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    crowd = components(edges)
    sized = reps.select("node", "own", "h1", "h2", "size", "copies", "labels", "looks").join(crowd, "node")
    sized = materialize(sized.withColumn("band", F.floor(F.log("size") / float(-np.log(float(exact))) + 1e-9).cast("int")), "candidates")
    total = sized.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("s")).first().s
    bundles = max(64, 2 * total // BLOCK_SHINGLES)

    bits, n_bits = id_filter(sized.select("own"), MAX_FILTER_BITS)
    shared = spark.sparkContext.broadcast(bits)

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = mix(batch.column("own").to_numpy().view(np.uint64)) & np.uint64(n_bits - 1)
            hit = (shared.value[(ids >> np.uint64(3)).astype(np.int64)] >> (ids & np.uint64(7)).astype(np.uint8)) & 1 == 1
            for part in text_slices(iter([batch.filter(pa.array(hit))]), "text", SMALL_SLICE_BYTES):
                sets = shingle_sets(part.column("text"), words)
                hashes = [set_hash(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column("own"), pa.array([h for h, _ in hashes], pa.int64()), pa.array([h for _, h in hashes], pa.int64()),
                     pa.array([s.tobytes() for s in sets], pa.binary())],
                    ["own", "h1", "h2", "shingles"],
                )

    texts = docs.select("own", "text").mapInArrow(shingles, "own long, h1 long, h2 long, shingles binary").dropDuplicates(["own", "h1", "h2"])
    tasks = sized.select("node", "own", "h1", "h2").join(texts, ["own", "h1", "h2"]).select("node", "shingles").join(
        _placed(sized.drop("own", "h1", "h2")), "node"
    ).select(
        "node", "copies", "labels", "looks", "shingles", "label", "block", "large", F.least("block", "other").alias("b1"), F.greatest("block", "other").alias("b2"),
        F.when(F.col("large"), F.col("label")).otherwise(F.pmod(F.xxhash64("label"), F.lit(bundles))).alias("bundle"),
    )

    def verify(group: pa.Table) -> pa.Table:
        label, block = group.column("label").to_numpy(), group.column("block").to_numpy()
        node, copies = group.column("node").to_numpy(), group.column("copies").to_numpy()
        looks = group.column("looks").to_numpy().astype(bool)
        labels = np.frombuffer(b"".join(group.column("labels").to_pylist()), np.uint32).reshape(-1, trees, steps)
        sets = [np.frombuffer(b, np.uint64) for b in group.column("shingles").to_pylist()]
        order = np.lexsort((node, block, label))
        same = group.column("b1")[0].as_py() == group.column("b2")[0].as_py()
        out: dict[str, list] = {"node": [], "root": [], "links": [], "weakest": []}
        cuts = np.flatnonzero(np.r_[True, np.diff(label[order]) != 0, True])
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            at = order[a:b]
            sides = [at[block[at] == x] for x in np.unique(block[at])]
            if len(sides) == 1 and not same:
                continue  # the other block has no member
            i, j = sides[0], sides[-1]
            linked, similarity = links_between(
                labels[i], labels[j], [sets[x] for x in i], [sets[x] for x in j], looks[i], looks[j], depth, before, exact, same
            )
            if not linked.any():
                continue
            least = np.where(linked, similarity, 2.0)
            if same:
                whole, of, weakest = linked | linked.T, i, np.minimum(least.min(0), least.min(1))
            else:
                whole, of, weakest = np.zeros((len(i) + len(j),) * 2, bool), np.concatenate([i, j]), np.concatenate([least.min(1), least.min(0)])
                whole[: len(i), len(i) :], whole[len(i) :, : len(i)] = linked, linked.T
            some = np.flatnonzero(whole.any(1))
            out["node"].append(node[of[some]])
            out["root"].append(node[of[_roots(whole)[some]]])
            out["links"].append((whole @ copies[of].astype(np.float64))[some].astype(np.int64))
            out["weakest"].append(weakest[some])
        weakest = pa.array(np.concatenate([np.zeros(0), *out.pop("weakest")]))
        columns = {k: pa.array(np.concatenate([np.zeros(0, np.int64), *v]).astype(np.int64)) for k, v in out.items()}
        return pa.table({**columns, "weakest": weakest})

    checked = tasks.groupBy("large", "bundle", "b1", "b2").applyInArrow(verify, "node long, root long, links long, weakest double")
    checked = materialize(checked, "links")
    discard(sized)
    return checked


def id_filter(ids: DataFrame, max_bits: int) -> tuple[np.ndarray, int]:
    """A Bloom filter, of bounded size, over the only column of ids (mixed by mix())."""
    name = ids.columns[0]
    n, bits = ids.count(), _ROW_BITS
    while bits < 16 * n and bits < max_bits:
        bits *= 2

    def positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = mix(batch.column(0).to_numpy().view(np.uint64)) & np.uint64(bits - 1)
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(at).view(np.int64))], ["p"])

    rows = ids.select(name).mapInArrow(positions, "p long").groupBy(F.shiftright("p", 15).alias("slot")).agg(
        F.bitmap_construct_agg(F.col("p").bitwiseAND(F.lit(_ROW_BITS - 1))).alias("bitmap")
    )
    out = np.zeros((bits // _ROW_BITS, _ROW_BITS // 8), np.uint8)
    for row in rows.toLocalIterator():  # at most max_bits / 8 bytes in all
        out[row.slot] = np.frombuffer(row.bitmap, np.uint8)
    return out.ravel(), bits


def documents_without_near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of df, one of each class of jaccard_join(): that of the smallest id.

    Rows without a near copy stay, whatever their id is shared with; of rows repeated with id and
    text one stays; so does one of the rows without words, and one of a class of rows without id.
    An empty table gives an empty result; columns are unchanged.  Only rows that may go are shuffled."""
    decided = jaccard_join(df, id_col=id_col, text_col=text_col, **how)
    decided = decided.groupBy("own", "doc_id").agg(F.bool_or("kept").alias("stays"), F.count("*").alias("n")).where("NOT stays OR n > 1")
    decided = materialize(decided, "decided").select(F.col("own").alias("key"), F.col("doc_id").alias("decided_id"), "stays")
    row = df.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("own_id"), F.col(text_col).cast("string").alias("own_text"))
    row = row.select("row", "own_id", own_key("own_id", "own_text").alias("own"))
    asked = probed_in(row, decided.select("key"), "own")
    # A name that tells rows apart isn't there, so a repeated row's twins are one row here.
    met = asked.where("may").join(decided, F.expr("own = key AND own_id <=> decided_id"), "left")
    twins = met.where("stays").dropDuplicates(["own", "own_id"])
    out = asked.where("NOT may").select("row").unionByName(met.where("stays IS NULL").select("row")).unionByName(twins.select("row"))
    return out.select("row.*")
