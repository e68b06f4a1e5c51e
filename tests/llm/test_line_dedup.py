import random
from itertools import combinations, product
from os.path import commonprefix

import pytest
from pyspark.sql import functions as F

from feedwright.llm import line_dedup as ld
from feedwright.llm.line_dedup import documents_without_repeated_lines, line_dedup, near, near_lines, within_edits
from feedwright.llm.queries import LINE_EDITS, op3_line_dedup


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def within(a, b, k):
    """Whether a and b are at most k edits apart: common beginnings cost nothing, then each edit is tried."""
    if abs(len(a) - len(b)) > k:
        return False
    p = len(commonprefix([a, b]))
    a, b = a[p:], b[p:]
    if not a or not b or not k:
        return max(len(a), len(b)) <= k
    return within(a[1:], b, k - 1) or within(a, b[1:], k - 1) or within(a[1:], b[1:], k - 1)


def allowed(a, b, edits):
    return max(k for least, k in ((0, 0), *edits) if min(len(a), len(b)) >= least)


def components_of(nodes, linked):
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def edited(r, line, n):
    for _ in range(n):
        p = r.randint(0, len(line))
        line = r.choice([line[:p] + r.choice("xyé🙂") + line[p:], line[:p] + line[p + 1 :], line[:p] + "q" + line[p + 1 :]])
    return line


def some_lines(seed):
    r = random.Random(seed)
    lines = []
    for _ in range(12):
        base = "".join(r.choice("abc dé🙂") for _ in range(r.choice([20, 21, 40, 90])))
        lines += [edited(r, base, r.choice([0, 1, 1, 2, 3])) for _ in range(r.choice([1, 3, 25]))]
    lines += ["counter value is now %03d exactly" % i for i in range(0, 60, 3)] + ["z" * n for n in range(20, 30)]
    return [x for x in lines if len(x) >= 20]


@pytest.mark.parametrize("k", [1, 2, 3])
def test_banded_distance(spark, k):
    r = random.Random(k)
    rows = []
    for _ in range(150):
        a = "".join(r.choice("abé🙂") for _ in range(r.randint(0, 14)))
        rows.append((a, edited(r, a, r.randint(0, k + 2))))
    df = spark.createDataFrame(rows, "a string, b string").withColumn("near", within_edits("a", "b", k))
    assert all(x.near == (distance(x.a, x.b) <= k) for x in df.collect())


@pytest.mark.parametrize("k", [1, 2, 3])
def test_narrowed_distance(spark, k):
    r = random.Random(8)
    rows = [("", "", k), ("a", "", k), ("", "ab", k), ("ab", "ba", k), ("a" * 90, "a" * 91, k)]
    for _ in range(200):
        a = "".join(r.choice("abé🙂") for _ in range(r.randint(0, 60)))
        rows.append((a, edited(r, a, r.randint(0, 4)), k))
    df = spark.createDataFrame(rows, "a string, b string, k int").withColumn("near", near("a", "b", "k", 3))
    assert all(x.near == (distance(x.a, x.b) <= k) for x in df.collect())


@pytest.mark.parametrize("few,edits", [(1, ((0, 1),)), (2, ((20, 1), (25, 2), (40, 3))), (8, ((20, 2),))])
def test_links_connect_what_brute_force_connects(spark, monkeypatch, few, edits):
    monkeypatch.setattr(ld, "FEW_LINES", few)
    lines = [x for x in some_lines(few + len(edits)) if len(x) < 60] + ["count %02d of a list with dates" % i for i in range(0, 90, 4)]
    lines += [edited(random.Random(i), "a longer line 2024-01-31 that has a date in it", i % 5) for i in range(20)]
    of = lambda a, b: allowed(a, b, edits)
    df = spark.createDataFrame([(x,) for x in lines], "line string").select(F.unhex(F.md5("line")).alias("id"), "line")
    name = {bytes(r.id): r.line for r in df.collect()}
    links = [(name[bytes(r.a)], name[bytes(r.b)]) for r in near_lines(df, edits).collect()]
    assert all(1 <= distance(a, b) <= of(a, b) for a, b in links)
    nodes = sorted(set(lines))
    true = [(a, b) for a in nodes for b in nodes if a < b and within(a, b, of(a, b))]
    assert components_of(nodes, links) == components_of(nodes, true)


@pytest.mark.parametrize("listed", [6, 1024])
def test_crowded_lines_are_split_or_listed(spark, monkeypatch, listed):
    """Many lines share all segments but one, and few are near: they are listed at once, or their buckets are split again."""
    monkeypatch.setattr(ld, "FEW_LINES", 2)
    monkeypatch.setattr(ld, "LISTED_LINES", listed)
    r = random.Random(listed)
    fixed = "".join(r.choice("mnopé🙂 ") for _ in range(60))
    lines = sorted({fixed[:30] + "".join(r.choice("abet") for _ in range(r.randint(4, 7))) + fixed[30:] for _ in range(40)} | {edited(r, fixed, 2) for _ in range(4)})
    rounds, made = [], ld.materialize
    monkeypatch.setattr(ld, "materialize", lambda df, tag: (rounds.append(tag), made(df, tag))[1])
    df = spark.createDataFrame([(x,) for x in lines], "line string").select(ld.line_id().alias("id"), "line")
    name = {bytes(x.id): x.line for x in df.collect()}
    links = [(name[bytes(x.a)], name[bytes(x.b)]) for x in near_lines(df, ((20, 2),)).collect()]
    assert all(within(a, b, 2) for a, b in links)
    assert components_of(lines, links) == components_of(lines, [(a, b) for a in lines for b in lines if a < b and within(a, b, 2)])
    assert rounds.count("hubs") == 1 if listed == 1024 else rounds.count("hubs") > 1


@pytest.mark.parametrize("k", [1, 2])
def test_crowded_lines_that_differ_in_few_places(spark, monkeypatch, k):
    """One bucket holds hundreds of lines; what is left of them is down to k characters."""
    monkeypatch.setattr(ld, "FEW_LINES", 2)
    r = random.Random(k)
    fixed = "".join(r.choice("mnopq") for _ in range(24))
    lines = sorted({fixed[:7] + "".join(r.choice("abcdefghij") for _ in range(r.randint(0, 2 * k + 1))) + fixed[7:] for _ in range(40)})
    df = spark.createDataFrame([(x,) for x in lines], "line string").select(F.unhex(F.md5("line")).alias("id"), "line")
    name = {bytes(x.id): x.line for x in df.collect()}
    links = [(name[bytes(x.a)], name[bytes(x.b)]) for x in near_lines(df, ((0, k),)).collect()]
    assert all(within(a, b, k) for a, b in links)
    assert components_of(lines, links) == components_of(lines, [(a, b) for a in lines for b in lines if a < b and within(a, b, k)])


@pytest.mark.parametrize("k", [1, 2, 3])
def test_alignments_say_what_is_near(k):
    spelt = lambda text, x, y: (x, tuple(text[p] for p in y))
    for n in range(k + 1):
        for d in range(k + 1):
            pairs = ld._alignments(k, n, d)
            places = [x for c in range(n + 1) for x in combinations(range(n), c)]
            for a in product("abc", repeat=n):
                for b in product("abc", repeat=n + d):
                    share = {spelt(a, x, x) for x in places} & {spelt(b, x, y) for x, y in pairs}
                    assert bool(share) == within("".join(a), "".join(b), k)


def brute_force(rows, edits=ld.ONE_EDIT):
    """Every class of equal and near lines keeps its first line in the corpus; blank lines stay."""
    blank = lambda x: not x.strip(" \t\r\x0b\x0c")
    nodes = sorted({x for _, t in rows if t is not None for x in t.split("\n") if not blank(x)}, key=len)
    linked = []
    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if len(b) - len(a) > 3:
                break
            if allowed(a, b, edits) and within(a, b, allowed(a, b, edits)):
                linked.append((a, b))
    label = components_of(nodes, linked)
    first = {}
    for i, t in rows:
        for p, x in enumerate((t or "").split("\n")):
            if not blank(x):
                first[label[x]] = min(first.get(label[x], (i, p)), (i, p))
    out = {}
    for i, t in rows:
        if t is None:
            out[i] = (None, 0, 0)
            continue
        lines = t.split("\n")
        kept = [x for p, x in enumerate(lines) if blank(x) or first[label[x]] == (i, p)]
        out[i] = ("\n".join(kept), len(lines), len(lines) - len(kept))
    return out


@pytest.mark.parametrize("edits", [ld.ONE_EDIT, LINE_EDITS])
def test_documents_equal_brute_force(spark, edits):
    r = random.Random(9)
    pool = some_lines(3)[:40] + ["", "short", "another short", " \t", "short "]
    texts = [None, "", "\n", "\n\n"] + ["\n".join(r.choice(pool) for _ in range(r.randint(1, 9))) for _ in range(40)]
    texts += texts[20:24]
    rows = list(enumerate(texts))
    df = spark.createDataFrame([(i, t, "x", [1], "y") for i, t in rows], "doc_id long, text string, line string, lines array<int>, own string")
    got = {x.doc_id: (x.text, x.n_lines, x.n_removed) for x in line_dedup(df.repartition(3), edits=edits).collect()}
    assert got == brute_force(rows, edits)


def test_null_ids_and_repeated_rows(spark):
    t = "a line that is long enough\nand a second line, long enough"
    df = spark.createDataFrame([(None, t), (1, t), (1, t), (None, t)], "doc_id long, text string")
    assert sorted((x.doc_id or 9, x.n_removed) for x in line_dedup(df).collect()) == [(1, 0), (1, 0), (9, 2), (9, 2)]
    assert [x.n_removed for x in line_dedup(df.where("doc_id IS NULL")).collect()] == [0, 0]


def test_rows_of_one_id_with_different_texts(spark):
    rows = [(1, "x\nx"), (1, "head\nunique line"), (None, "null\nhead"), (None, "only here")]
    got = sorted((x.text, x.n_removed) for x in line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [("head\nunique line", 0), ("null", 1), ("only here", 0), ("x", 1)]


def test_short_lines_that_repeat(spark):
    rows = [(i, "short line %d\nRead more\n\nRead more" % i) for i in range(3)]
    got = {x.doc_id: x.text for x in line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {0: "short line 0\nRead more\n", 1: "short line 1\n", 2: "short line 2\n"}


def test_documents_keep_their_columns(spark):
    rows = [(2, None, 7, "a", "s"), (1, "x y\nx y", 7, "b", None), (1, "x y\nz", 3, "c", "s"), (3, "", 0, "d", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, row string, source string")
    got = documents_without_repeated_lines(df)
    assert got.columns == df.columns
    texts = sorted((r.doc_id, r.text or "", r.n_chars, r.row, r.source) for r in got.collect())
    assert texts in (sorted([(1, "x y", 3, "b", None), (1, "z", 1, "c", "s"), (2, "", 7, "a", "s"), (3, "", 0, "d", "s")], key=lambda t: t[:2]),
                     sorted([(1, "", 0, "b", None), (1, "x y\nz", 5, "c", "s"), (2, "", 7, "a", "s"), (3, "", 0, "d", "s")], key=lambda t: t[:2]))
    assert documents_without_repeated_lines(df.limit(0)).count() == 0


def test_a_very_long_text(spark):
    r = random.Random(4)
    lines = ["".join(r.choice("abcdef ") for _ in range(90)) for _ in range(4000)]
    rows = [(0, "\n".join(lines)), (1, "\n".join([lines[17] + "!", "z" * 300_000, lines[9], "z" * 300_001]))]
    got = {x.doc_id: (x.n_lines, x.n_removed) for x in line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {0: (4000, 0), 1: (4, 3)}


def test_keys_of_a_few_lines_are_not_repeated(spark, monkeypatch):
    plans = []
    written = ld.materialize
    monkeypatch.setattr(ld, "materialize", lambda df, tag: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), written(df, tag))[1])
    rows = [(i, f"line {i // 2} of the text, number {i // 2 * 7919:09d}, end{'s' * (i % 2)}") for i in range(60)]
    got = {x.doc_id: x.n_removed for x in line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: i % 2 for i in range(60)}
    assert plans and not [p for p in plans if "_salt" in p]


def test_texts_are_split_into_lines_once(spark, tmp_path, monkeypatch):
    plans = []
    written = ld.materialize
    monkeypatch.setattr(ld, "materialize", lambda df, tag: (plans.append((tag, df._jdf.queryExecution().optimizedPlan().toString())), written(df, tag))[1])
    rows = [(i, f"line {i} alone here\nthe same line in all of them") for i in range(20)]
    got = {x.doc_id: x.n_removed for x in line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: int(i > 0) for i in range(20)}
    assert [tag for tag, p in plans if "split(" in p] == ["places"]


def test_empty_table(spark):
    assert line_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_every_repeated_line_goes_wherever_it_stands(spark):
    footer = ["first line of the repeated footer", "second line of the repeated footer", "third line of the repeated footer"]
    rows = [(i, "\n".join([f"{i} " + chr(97 + i) * 25, *footer])) for i in range(3)]
    rows += [(10, "a line that only two documents share"), (11, "a line that only two documents share"), (12, rows[0][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {x.doc_id: (x.text, x.n_lines, x.n_removed) for x in line_dedup(df).collect()}
    assert got == brute_force(rows)
    assert [got[i][2] for i in (0, 1, 2, 10, 11, 12)] == [0, 3, 3, 0, 1, 4]


def test_query_removes_lines_of_two_documents(spark, tmp_path):
    rows = [(i, "a line that only two documents share\n" + chr(97 + i) * 25) for i in range(2)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {x.doc_id: x.n_removed for x in op3_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {0: 0, 1: 1}


def test_query_joins_lines_with_another_number(spark, tmp_path):
    rows = [(i, "this line of the corpus was printed on day %02d of the month" % n) for i, n in enumerate([17, 25])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert {x.doc_id: x.n_removed for x in op3_line_dedup(spark, str(tmp_path)).collect()} == {0: 0, 1: 1}
