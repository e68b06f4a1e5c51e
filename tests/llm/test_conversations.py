import hashlib
import itertools
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedwright.llm.conversations import Automaton, damaged, repair_conversations
from feedwright.llm.queries import ORACLES

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def plain_damage(rows):
    for conv_id, turn, role, text in rows:
        key = ":".join(" " if x is None else str(x) for x in (conv_id, turn))
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        for _ in range(2 if kind == 3 else kind != 0):
            yield conv_id, turn, role, text


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        said = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def plain_repair(rows):
    """The least (cost, audit) over all edit sequences, by dynamic programming over written initials' states."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    faults = faults_of(rows)
    follow = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    best = {"": (0, "", ())}

    def better(table, state, found):
        if state not in table or found[:2] < table[state][:2]:
            table[state] = found
            return True
        return False

    def inserts(table):
        while any(
            better(table, r, (c + 5, e + "I", w + (({"u": "user", "a": "assistant"}[r] + ":"),)))
            for state, (c, e, w) in list(table.items()) for r in follow[state] if r != "s"
        ):
            pass
        return table

    best = inserts(best)
    for (_, role, text), fault in zip(rows, faults, strict=True):
        after = {}
        for state, (c, e, w) in best.items():
            better(after, state, (c + 2, e + "D", w))
            if fault not in ("blank", "duplicate"):
                extra = 5 * (fault == "truncated")
                if role[:1] in follow[state]:
                    better(after, role[:1], (c + extra, e + "K", (*w, f"{role}:{text}")))
                for name in ("user", "assistant"):
                    if name[0] in follow[state]:
                        better(after, name[0], (c + 1 + extra, e + "R", (*w, f"{name}:{text}")))
        best = inserts(after)
    cost, audit, written = min(best[s] for s in ("", "a") if s in best)
    turns = {r[0] for r in rows if r[0] is not None}
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(written).encode()).hexdigest()


def expected(rows):
    of = {r[0]: [] for r in rows}
    for conv_id, *rest in plain_damage(rows):
        of[conv_id].append(tuple(rest))
    return {c: plain_repair(r) for c, r in of.items()}


def run(spark, rows, parts=3):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    found = repair_conversations(damaged(df)).select("conv_id", *COLUMNS).collect()
    assert len(found) == len({r[0] for r in found})
    return {r[0]: tuple(r)[1:] for r in found}


@pytest.fixture(scope="module")
def rows():
    rng = np.random.Generator(np.random.PCG64(8))
    roles = ["user", "assistant", "system", "tool", "", None, "users", "assist"]
    texts = ["Yes.", "No!", "And so", "", " \t\n", None, "Why?  ", "Wer. ", "Same.", "Same."]
    out = []
    for conv in range(400):
        for i in range(int(rng.integers(1, 9))):
            turn = None if rng.random() < 0.05 else int(i if rng.random() < 0.9 else rng.integers(0, 12))
            role = str(rng.choice(["user", "assistant"])) if rng.random() < 0.5 else rng.choice(np.array(roles, object))
            out.append((conv, turn, role, rng.choice(np.array(texts, object))))
    out += [(None, t, "user", f"{t}.") for t in range(4)] + [(None, None, None, None)]
    return out


def test_equals_plain_version(spark, rows):
    assert run(spark, rows) == expected(rows)


def test_long_conversations_and_repeated_rows(spark, rows):
    hot = [(5000, t, ("user", "assistant", "assistant")[t % 3], f"text {t}" + "." * (t % 7 > 0)) for t in range(2500)]
    more = rows[:200] + rows[:200] + hot + [(5001, 1, "user", "x" * 200_000 + "."), (5001, 2, "assistant", "y" * 200_000)]
    assert run(spark, more, 5) == expected(more)


def test_all_rows_gone_and_empty_table(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert run(spark, [(gone, 0, "user", "Hi.")]) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert run(spark, []) == {}


def test_other_columns_do_not_matter(spark, rows):
    df = spark.createDataFrame(rows[:100], SCHEMA).withColumns({c: F.lit("x") for c in ("gone", "seen", "fault", "initial", "ahead", "cost", "_copy")})
    found = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in repair_conversations(damaged(df)).collect()}
    assert found == expected(rows[:100])


def test_states_stay_few(spark, rows):
    """The lazily made automaton has few states however many conversations it reads."""
    from feedwright.llm.conversations import END, Row

    automaton, rng = Automaton(), np.random.Generator(np.random.PCG64(2))
    kinds = [Row(i, f) for i in ("s", "u", "a", "") for f in ("", "blank", "duplicate", "truncated")]
    for _ in range(3000):
        ahead = END
        for k in rng.integers(0, len(kinds), 30):
            ahead, _ = automaton.step(ahead, kinds[k])
    assert len({v for v, _ in automaton.transitions}) < 200


def test_sql_says_the_same(spark, rows):
    import duckdb

    conversations = spark.createDataFrame(rows, SCHEMA).toPandas().astype({"turn": "Int64", "conv_id": "Int64"})
    with duckdb.connect() as c:
        c.register("conversations", conversations)
        found = c.sql(ORACLES["op12_conversation_repair"]).select("conv_id", *COLUMNS).fetchall()
    assert {r[0]: r[1:] for r in found} == expected(rows)
