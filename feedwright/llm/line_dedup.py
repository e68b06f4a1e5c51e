"""Line de-duplication with a segment-partition edit join.

Lines at most k edits apart are near; k grows with the length of the shorter
line.  A line is split into threshold-plus-one, k + 1, segments; k edits spare
one of them.  Segment indexes are kept by line length: a line is indexed under
its own length, and probes the indexes of its own length and of the lengths
down to k below with the substrings that can match there, shifted by what the
edits before and after a segment allow.  Keys that meet nothing are turned away
by Bloom filters, so what travels beside them are the index keys themselves,
without texts.  Lines that share a key are verified by a banded bit-parallel
edit distance, after common ends are taken off; counts of characters and a
thresholded distance turn most pairs away before.  In a bucket with many lines those near its hub are
linked to it, and only the others are compared with all.  A crowded one isn't
enumerated: what its hub leaves is split again by what the shared segment
leaves over, until the buckets are small enough.  Two lines that agree with
the hub in one segment meet in that segment's bucket, so in the buckets of
later segments they are passed over.

Everything here is DataFrame functions.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedwright.llm import bloom
from feedwright.llm.common import discard, materialize, own_key
from feedwright.operators.graph import components
from feedwright.operators.skew import dealt

#: Edits between near lines, by the least length of the shorter one; below the first, lines are only equal.
ONE_EDIT = ((20, 1),)
#: Lines of a bucket that are compared pair by pair.
FEW_LINES = 8
#: Lines of a bucket that are compared after those near its hub are linked to it; a larger one is split again.
LISTED_LINES = 1024
#: Characters whose counts turn pairs of such a bucket away.
COUNTED = "etaonishrdlugwc."


def _within_edits_sql(a: str, b: str, k: int) -> str:
    """True if the strings a and b (column names) are at most k edits apart.

    Banded bit-parallel simulation: bit o of r_e says that a[: j+o-k] turns into
    b[: j] with at most e edits; only the 2k+1 diagonals of the band have bits.
    """
    mask = (1 << (2 * k + 1)) - 1
    hits = " | ".join(f"if(coalesce(get(w.a, j + {o - k}) = c, false), {1 << o}, 0)" for o in range(2 * k + 1))
    matches = f"transform(w.b, (c, j) -> {hits})"
    start = [sum(1 << o for o in range(k, k + e + 1)) for e in range(k + 1)]
    zero = "named_struct(" + ", ".join(f"'r{e}', {start[e]}" for e in range(k + 1)) + ")"
    steps = ["s.r0 & m"]
    for e in range(1, k + 1):
        steps.append(f"((s.r{e} & m) | s.r{e - 1} | shiftright(s.r{e - 1}, 1) | shiftleft({steps[-1]}, 1)) & {mask}")
    step = "named_struct(" + ", ".join(f"'r{e}', {x}" for e, x in enumerate(steps)) + ")"
    last = f"aggregate({matches}, {zero}, (s, m) -> {step}, s -> s.r{k})"
    last = f"get(transform(array(named_struct('a', split({a}, ''), 'b', split({b}, ''))), w -> {last}), 0)"  # each is split once
    apart = f"length({a}) - length({b})"
    return (
        f"CASE WHEN abs({apart}) > {k} THEN false WHEN {b} = '' OR {a} = '' THEN true "
        f"ELSE bit_get({last}, {apart} + {k}) = 1 END"
    )


def within_edits(a: str, b: str, k: int) -> Column:
    return F.expr(_within_edits_sql(a, b, k))


def near(a: str, b: str, k: str, most: int) -> Column:
    """True if the strings in a and b are at most k edits apart, k a column of 1 to `most`.

    Nearly all pairs are turned away by Spark's own distance, which costs much less.  What both
    share at an end doesn't change their distance and is taken off first, in pieces of halving
    size; the banded distance looks at what is left of them."""
    state = "named_struct('a', {}, 'b', {})".format
    pieces = "array(" + ", ".join(str(1 << e) for e in range(20, -1, -1)) + ")"
    front = f"CASE WHEN length(u.a) >= j AND length(u.b) >= j AND substring(u.a, 1, j) = substring(u.b, 1, j) THEN {state('substring(u.a, j + 1)', 'substring(u.b, j + 1)')} ELSE u END"
    back = (f"CASE WHEN length(u.a) >= j AND length(u.b) >= j AND right(u.a, j) = right(u.b, j) THEN "
            f"{state('substring(u.a, 1, length(u.a) - j)', 'substring(u.b, 1, length(u.b) - j)')} ELSE u END")
    cut = f"aggregate({pieces}, aggregate({pieces}, {state(a, b)}, (u, j) -> {front}), (u, j) -> {back})"
    cases = " ".join(f"WHEN {k} = {n} THEN {_within_edits_sql('x.a', 'x.b', n)}" for n in range(1, most + 1))
    return F.expr(f"levenshtein({a}, {b}, {k}) >= 0 AND get(transform(array({cut}), x -> CASE {cases} ELSE x.a = x.b END), 0)")


def _edits(n: str, edits) -> str:
    """The edits that are allowed where the shorter line has n characters."""
    cases = " ".join(f"WHEN {n} >= {least} THEN {k}" for least, k in sorted(edits, reverse=True))
    return f"(CASE {cases} ELSE 0 END)"


def keyed(lines: DataFrame, edits, moved: bool) -> DataFrame:
    """The index entries of lines, or with `moved` their probes that aren't index entries too.

    Adds key, d, k, at and size: the line under the index of the length d below its own, where k edits
    are allowed; characters at + 1 to at + size are the segment.  Segment i of that length may have
    moved by s: by at most i edits before it, and so that at most k - i come after it."""
    most, shortest = max(k for _, k in edits), min(least for least, k in edits if k)
    ways = [(k, d, i, s) for k in {k for _, k in edits if k} for d in (range(k + 1) if moved else [0]) for i in range(k + 1)
            for s in (range(max(-i, d - k + i), min(i, d + k - i) + 1) if moved else [0]) if not moved or d or s]
    # Four bytes a character, so that a segment is found without a look at what stands before it.
    rows = lines.withColumn("m", F.length("line")).where(F.col("m") >= shortest).withColumn("chars", F.encode("line", "UTF-32"))
    rows = rows.withColumn("way", F.explode(F.array(*[F.struct(*[F.lit(x).alias(c) for c, x in zip("kdis", way, strict=True)]) for way in ways])))
    rows = rows.select(*lines.columns, "m", "chars", "way.*").withColumn("n", F.expr("m - d")).where("k = " + _edits("n", edits))
    rows = rows.withColumn("p", F.expr("cast(n * i div (k + 1) AS int)")).withColumn("size", F.expr("cast(n * (i + 1) div (k + 1) AS int) - p"))
    rows = rows.withColumn("at", F.expr("p + s")).where("at >= 0 AND at + size <= m")
    rows = rows.withColumn("key", F.expr("xxhash64(n, i, substring(chars, 4 * at + 1, 4 * size))"))
    return rows.select(*lines.columns, "d", "k", "size", "at", "key")


def _rest_segments() -> Column:
    """Entries of a rest, under the key it is in, the same way.

    mask has a bit for each earlier segment, of this and of the levels before, in which the rest
    agrees with its bucket's hub (hub_rest): lines that share a bit share that segment's bucket."""
    start = lambda i: f"cast(u.n * ({i}) div (k + 1) AS int)"
    moves = lambda i: f"filter(sequence(greatest(-{i}, d - k + {i}), least({i}, d + k - {i})), s -> g.p + s >= 0 AND g.p + s + g.z <= u.n + d)"
    segment = lambda i: f"array(named_struct('p', {start(i)}, 'z', {start(i + ' + 1')} - {start(i)}))"
    agrees = f"transform(sequence(0, k), j -> exists({segment('j')}, g -> exists({moves('j')}, s -> substring(rest, g.p + s + 1, g.z) = substring(hub_rest, g.p + 1, g.z))))"
    before = "aggregate(sequence(0, k), 0L, (m, j) -> CASE WHEN j < i AND v.agrees[j] THEN m | shiftleft(1L, j) ELSE m END)"
    entry = ("named_struct('key', xxhash64(key, u.n, i, substring(rest, g.p + s + 1, g.z)), 'at', g.p + s, 'size', g.z, 'own', own AND s = 0, "
             f"'mask', (shiftleft(mask, k + 1) | {before}) & {(1 << 62) - 1}L)")
    moved = f"flatten(transform({segment('i')}, g -> transform({moves('i')}, s -> {entry})))"
    with_n = "array(named_struct('n', length(rest) - d))"
    told = f"flatten(transform({with_n}, u -> flatten(transform(array(named_struct('agrees', {agrees})), v -> flatten(transform(sequence(0, k), i -> {moved}))))))"
    return F.explode(F.expr(told))


def _without(line: str) -> Column:
    """What a line's shared segment leaves over."""
    return F.expr(f"concat(substring({line}, 1, at), substring({line}, at + size + 1))").alias("rest")


def _dealt(rows: DataFrame, answer: DataFrame, keys: list[str]) -> DataFrame:
    return dealt(rows, answer, keys, "id")


def line_id(line: str = "line") -> Column:
    return F.unhex(F.md5(line))


def _pairs(rows: DataFrame, most: int, counted: str = "") -> DataFrame:
    """(a, b): rows of one key that are near, each index entry with all others; tied ones are connected already.

    A changed character changes two of the counts of the characters `counted` by one, one more or less changes one."""
    rows = rows.withColumn("n", F.length("line")).withColumns({f"n{i}": F.expr(f"octet_length(line) - octet_length(replace(line, '{c}', ''))") for i, c in enumerate(counted)})
    side = lambda x: [F.col(c).alias(f"{c}_{x}") for c in ("line", "tied", "mask", "n", *(f"n{i}" for i in range(len(counted))))]
    a = rows.where("own").select("key", "k", F.col("id").alias("a"), *side("a"))
    b = rows.select("key", F.col("id").alias("b"), F.col("own").alias("own_b"), *side("b"))
    pairs = a.join(b, "key").where("a <> b AND (NOT own_b OR a < b) AND NOT (tied_a AND tied_b) AND (mask_a & mask_b) = 0")
    if counted:
        pairs = pairs.where(" + ".join(f"abs(n{i}_a - n{i}_b)" for i in range(len(counted))) + " + abs(n_a - n_b) <= 2 * k")
    return pairs.where(near("line_a", "line_b", "k", most)).select("a", "b")


def _alignments(k: int, n: int, d: int) -> list[tuple[tuple[int, ...], tuple[int, ...]]]:
    """(places in a string of n characters, places in one of n + d): the ways to match characters that
    leave at most k edits."""
    out = []
    for c in range(n + 1):
        for x in combinations(range(n), c):
            for y in combinations(range(n + d), c):
                ends = zip([-1, *x], [*x, n], [-1, *y], [*y, n + d], strict=True)
                if sum(max(b - a - 1, f - e - 1) for a, b, e, f in ends) <= k:
                    out.append((x, y))
    return out


def _tiny_keys(most: int) -> Column:
    """For rests whose index length n is at most k: keys that a probe and an index entry share if they are near.

    A key says which characters stand where in the index entry.  If it stands for an alignment of few
    edits with one entry, it does so with every entry that has the key, so one of them is enough."""
    cases = []
    spelt = lambda x, y: "concat_ws('.', " + ", ".join([f"'{','.join(map(str, x))}'", *(f"hex(substring(rest, {p + 1}, 1))" for p in y)]) + ")"
    for k in range(1, most + 1):
        for n in range(k + 1):
            places = [x for c in range(n + 1) for x in combinations(range(n), c)]
            cases.append((k, n, 0, "own", [spelt(x, x) for x in places]))
            cases += [(k, n, d, "NOT own", [spelt(x, y) for x, y in _alignments(k, n, d)]) for d in range(k + 1)]
    whens = " ".join(f"WHEN {own} AND k = {k} AND length(rest) - d = {n} AND d = {d} THEN array({', '.join(keys)})" for k, n, d, own, keys in cases if keys)
    return F.explode(F.array_distinct(F.expr(f"CASE {whens} END")))


def near_lines(lines: DataFrame, edits=ONE_EDIT, max_slots: int = bloom.MAX_SLOTS, n_lines: int | None = None) -> DataFrame:
    """(a, b): links between the ids of different lines, at least enough that connected lines stay
    connected.  lines: (line), repeated or not; ids are line_id(); edits: (least length of the shorter line, edits);
    n_lines: about how many there are, if that is known."""
    most = max(k for _, k in edits)
    slots = bloom.slots_for((most + 1) * (lines.count() if n_lines is None else n_lines), max_slots)
    lines = lines.select("line")
    index = keyed(lines, edits, False).select("key", F.xxhash64("line").alias("h"))
    seen = index.groupBy("key").agg(F.min("h").alias("a"), F.max("h").alias("b"))
    table = materialize(bloom.built(seen, slots, every="true", shared="a <> b"), "segmentfilter")
    entry = [line_id().alias("id"), F.xxhash64("line").alias("h"), "key", "d", "k", "at", "size"]  # of the few lines that may share a key
    probes = bloom.probed(keyed(lines, edits, True), table, slots, which="every").where("may").select(entry).dropDuplicates(["key", "id", "d", "at"])
    probes = materialize(probes, "probes")
    asked = bloom.either(table.select("slot", F.col("shared1").alias("every1"), F.col("shared2").alias("every2")), bloom.built(probes, slots, every="true"))
    met = bloom.probed(keyed(lines, edits, False), materialize(asked, "askedfilter"), slots, which="every").where("may").select(entry).dropDuplicates(["key", "id", "d", "at"])
    level = materialize(probes.withColumn("own", F.lit(False)).unionByName(met.withColumn("own", F.lit(True))), "entries")
    shared = level.groupBy("key").agg(F.count("*").alias("c"), F.bool_or("own").alias("any_own")).where("c > 1 AND any_own").select("key")
    # Joins to written tables of one row a key: adaptive execution splits them where a key has many rows.
    level = materialize(level.join(materialize(shared, "keys"), "key"), "shared")
    discard(probes)
    discard(table)
    if level.isEmpty():
        return level.select(F.col("id").alias("a"), F.col("id").alias("b"))
    # Only now are texts needed: those of lines that share a key with another.
    found = bloom.where_in(lines.withColumn("_h", F.xxhash64("line")), level.select(F.col("h").alias("key")).distinct(), "_h", max_slots)
    texts = materialize(found.select(line_id().alias("id"), "line").dropDuplicates(["id"]), "texts")
    level = level.join(texts, "id").select("id", "line", "key", "d", "k", "own", _without("line"), F.lit(False).alias("tied"), F.lit(0).cast("long").alias("mask"))
    level = materialize(level, "bucket")
    links: list[DataFrame] = []
    while True:
        sizes = level.groupBy("key").agg(
            F.count("*").alias("c"), F.bool_or("own").alias("any_own"), F.min("tied").alias("all_tied"), F.bit_and("mask").alias("met"), F.max(F.length("rest") - F.col("d") - F.col("k")).alias("over")
        )
        sizes = materialize(sizes.where("c > 1 AND any_own AND NOT all_tied AND met = 0").drop("any_own", "all_tied", "met"), "sizes")
        crowded = not sizes.where(f"c > {FEW_LINES}").isEmpty()
        sized = materialize(level.join(sizes, "key"), "sized")
        discard(level)
        discard(sizes)
        few, tiny = F.expr(f"c <= {FEW_LINES}"), F.expr(f"c > {FEW_LINES} AND over <= 0")
        small, many = sized.where(few), sized.where(~few & ~tiny)
        pairs = _pairs(small, most)
        if not crowded:
            links.append(materialize(pairs.distinct(), "near"))
            discard(sized)
            break
        # So little is left that all index entries are near each other; a probe needs one of them.
        left = sized.where(tiny)
        index = left.where("own")
        stars = _dealt(index, index.groupBy("key").agg(F.min("id").alias("b")), ["key"]).where("id <> b").select(F.col("id").alias("a"), "b")
        spelt = left.select("key", "id", "line", "k", "own", _tiny_keys(most).alias("spelt"))
        firsts = spelt.where("own").groupBy("key", "spelt").agg(F.min(F.struct("id", "line")).alias("b"))
        longer = _dealt(spelt.where("NOT own"), firsts, ["key", "spelt"]).where("id <> b.id").select(F.col("id").alias("a"), F.col("b.id").alias("b"), F.col("line").alias("line_a"), F.col("b.line").alias("line_b"), "k")
        longer = longer.dropDuplicates(["a", "b", "k"]).where(near("line_a", "line_b", "k", most)).select("a", "b")
        hubs = materialize(many.where("own").groupBy("key").agg(F.min(F.struct(F.expr("NOT tied").alias("loose"), "id", "line", "rest")).alias("hub")), "hub")
        met = many.join(hubs, "key").select("key", "id", "line", "d", "k", "own", "rest", "tied", "mask", F.col("hub.rest").alias("hub_rest"), F.col("hub.id").alias("hub"), F.col("hub.line").alias("hub_line"), F.col("hub.loose").alias("loose"), "c")
        met = met.withColumn("by_hub", (F.col("id") == F.col("hub")) | near("hub_line", "line", "k", most))
        met = materialize(met.select("key", "id", "line", "d", "k", "own", "rest", "hub_rest", "mask", "hub", "by_hub", F.expr("by_hub OR (tied AND NOT loose)").alias("tied"), "c"), "hubs")
        spokes = met.where("by_hub AND id <> hub").select(F.col("id").alias("a"), F.col("hub").alias("b"))
        listed = _pairs(met.where(f"c <= {LISTED_LINES}"), most, COUNTED)
        links.append(materialize(pairs.unionByName(stars).unionByName(longer).unionByName(spokes).unionByName(listed).distinct(), "near"))
        discard(sized)
        discard(hubs)
        met_again = met.where(f"c > {LISTED_LINES}")
        if met_again.isEmpty():
            discard(met)
            break
        open_keys = met_again.groupBy("key").agg(F.min("tied").alias("done")).where("NOT done").select("key")
        below = _dealt(met_again, open_keys, ["key"]).select("id", "line", "tied", "rest", "d", "k", _rest_segments().alias("e"))
        below = below.select("id", "line", "rest", "d", "k", "e.*", "tied").select("id", "line", "key", "d", "k", "own", _without("rest"), "tied", "mask").dropDuplicates(["key", "id", "d", "own", "rest"])
        below = materialize(below, "bucket")
        discard(met)
        level = below
        if level.isEmpty():
            break
    links_of = links[0]
    for more in links[1:]:
        links_of = links_of.unionByName(more)
    return links_of


def line_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False, edits=ONE_EDIT) -> DataFrame:
    """doc_id, text, n_lines, n_removed: every row with the repeated lines removed;
    with carry also `row`, a struct of the row's own columns.

    Lines end at \\n.  Lines that aren't blank form classes: equal lines, lines few edits apart, and
    what these connect; `edits` says how many, as (least length of the shorter line, edits) pairs;
    shorter lines are only compared for equality.  Of each class one line stays, the first in the
    corpus: smallest id (null last), then a hash of the text, then position.  Blank lines, of space
    characters or of nothing, are layout and stay.  A null text stays null and has no lines; an empty
    text has one empty line.  Rows keep their number and ids, and a row may be left without any text.
    Rows of one id with different texts are different documents; a row that is repeated with its id
    and text is one document with its twin, and both keep the same lines.  Other columns are ignored,
    whatever their names.  An empty table gives an empty result; a text of any length is one row's work.
    """
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                     *([F.struct("*").alias("row")] if carry else []))
    docs = docs.withColumn("own", own_key("doc_id", "text"))
    split = docs.where("text IS NOT NULL").select("doc_id", "own", F.split("text", "\n", -1).alias("lines"))
    placed = split.select("doc_id", "own", F.posexplode("lines").alias("pos", "line")).where(F.ltrim("line", F.lit(" \t\r\x0b\x0c")) != "")
    # Lines are read several times; they are split from the texts once.
    placed = materialize(placed.select("doc_id", "own", "pos", line_id().alias("id"), "line"), "places")
    places = placed.drop("line")

    labels = components(near_lines(placed.select("line"), edits, n_lines=places.count()))
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "own", "pos")
    equal = places.groupBy("id").agg(F.count("*").alias("n"), F.min(place).alias("first"))
    tagged = equal.join(labels.withColumnRenamed("node", "id"), "id", "left").where("n > 1 OR label IS NOT NULL")
    tagged = materialize(tagged.withColumn("class", F.coalesce("label", "id")).select("id", "class", "n", "first"), "classes")
    classes = tagged.groupBy("class").agg(F.sum("n").alias("of"), F.min("first").alias("stays")).where("of > 1")
    answer = materialize(tagged.select("id", "class").join(materialize(classes, "stays"), "class").select("id", "stays"), "answer")
    # Lines that occur once, which are most, don't travel.
    may = bloom.where_in(places.withColumn("_h", F.xxhash64("id")), answer.select(F.xxhash64("id").alias("key")), "_h").drop("_h")
    hits = may.join(answer, "id").where(~(place.eqNullSafe(F.col("stays"))))
    gone = materialize(hits.groupBy("doc_id", "own").agg(F.collect_set("pos").alias("gone")), "gone")

    may = bloom.probed_in(docs, gone.select(F.col("own").alias("key")), "own")
    out = lambda rows, text, lost: rows.select(
        "doc_id", text.alias("text"), F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n", -1))).cast("long").alias("n_lines"),
        lost.cast("long").alias("n_removed"), *(["row"] if carry else []))
    whole = out(may.where("NOT may"), F.col("text"), F.lit(0))
    side = gone.select(F.col("doc_id").alias("_doc"), F.col("own").alias("_own"), "gone")
    met = may.where("may").join(side, F.expr("own = _own AND doc_id <=> _doc"), "left").withColumn("lines", F.split("text", "\n", -1))
    kept = F.expr("array_join(transform(array_except(sequence(0, size(lines) - 1), gone), i -> lines[i]), '\n')")
    cut = out(met, F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept), F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")))
    return whole.unionByName(cut)


def documents_without_repeated_lines(df: DataFrame, **how) -> DataFrame:
    """The rows of df with text and n_chars (if there) after line_dedup(); none is left out.

    Nulls, empty texts, repeated rows and ids, and empty tables as in line_dedup(); n_chars stays where
    the text is null; the other columns stay as they are."""
    done = line_dedup(df, carry=True, **how)
    row = F.col("row").withField("text", F.col("text"))
    if "n_chars" in df.columns:
        row = row.withField("n_chars", F.coalesce(F.length("text"), F.col("row.n_chars")).cast(df.schema["n_chars"].dataType))
    return done.select(row.alias("row")).select("row.*")
