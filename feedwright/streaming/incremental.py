"""Incremental runs as a stream: an outlet's checkpoints and known links are the stream's state.

Each outlet is a key.  Its state, in parts that are read and written whole, is its
sections' checkpoints and the links that it has emitted, of which one is forgotten
some time after it was last listed.  A micro-batch brings the lists of one run or several; what they emit is
what plans.jobs.incremental_run() would, with the checkpoints and known links of
the runs before.  State lies in Spark's state store and is committed with the
batch, so a run that is replayed after a failure emits the same.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any
from zlib import crc32

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from feedwright.functions.text import normalize_link, title_key
from feedwright.plans.jobs import CAP_RUN, feed_key, numeric_id, title_suffix
from feedwright.sources.registry import Outlet

#: Days after which a link that is no longer listed is forgotten.
FORGET_DAYS = 90
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
EMITTED = "outlet_id string, run long, section string, section_ord int, pos int, link string, title string"
#: Columns of a run's lists besides outlet_id, run, section, section_ord, pos, link, title and valid.
_KEYS = ("norm", "number", "said")


@dataclass(frozen=True)
class Rules:
    """What of an outlet's configuration decides a run."""

    stop_on_known: bool
    one_list: bool
    rule: str

    @classmethod
    def of(cls, outlet: Outlet) -> Rules:
        return cls(outlet.on_known != "skip", outlet.capped == "run", outlet.rule)


def keyed(lists: DataFrame, outlets: Sequence[Outlet]) -> DataFrame:
    """lists with what their links are known by: norm, number (0: none; null: not numbered) and said, the key of a title
    that stops a list (null where titles don't).

    Outlets whose links are known in the same way share an expression, so the plan doesn't grow with the outlets."""
    kinds: dict[tuple, list[Outlet]] = {}
    for o in outlets:
        kinds.setdefault((o.key, o.id) if o.key == "composite" else (o.key,), []).append(o)

    def of_kind(value, kind: str) -> Column:
        out = F.lit(None).cast(kind)
        for same in kinds.values():
            if (v := value(same[0])) is not None:
                out = F.when(F.col("outlet_id").isin(*(o.id for o in same)), v.cast(kind)).otherwise(out)
        return out

    said = lambda o: F.nullif(title_key(F.coalesce("title", F.lit("")), title_suffix(o)), F.lit("")) if o.key == "composite" else None
    rows = lists.withColumn("_norm", normalize_link(F.col("link")))
    return rows.withColumns({
        "norm": of_kind(lambda o: feed_key(o, F.col("_norm")), "string"), "number": of_kind(lambda o: numeric_id(o, F.col("link")), "bigint"), "said": of_kind(said, "string"),
    }).drop("_norm")


@dataclass(frozen=True)
class Checkpoint:
    link: str
    norm: str | None
    number: int | None
    said: str | None

    def stops(self, row: Any) -> bool:
        if row.norm == self.norm or row.number and self.number and row.number <= self.number:
            return True
        return self.said is not None and row.said == self.said


def one_run(rows: list[Any], checkpoints: dict[str | None, Checkpoint], known: Any, rules: Rules, limit: int) -> tuple[list[Any], dict[str | None, Checkpoint]]:
    """(emitted rows, the checkpoints that change) of one outlet's lists, sorted by section and place.

    known(norm) tells whether a link was emitted by an earlier run.  rows have section, section_ord, pos, link, valid
    and the keys; a number of 0 never stops a list."""
    emitted, taken, changed = [], set(), {}
    lists: dict[Any, list[Any]] = {}
    for row in rows:
        lists.setdefault(row.section, []).append(row)
    hits = {}
    for section, listed in lists.items():
        old = checkpoints.get(section)
        for row in listed:
            was = row.norm is not None and known(row.norm)
            hit = row.number != 0 and (old is not None and old.stops(row) or was and rules.stop_on_known)
            hits[id(row)] = hit, was
    parts = [rows] if rules.one_list else lists.values()
    for listed in parts:
        n = 0
        for row in listed:
            hit, was = hits[id(row)]
            if was and not rules.stop_on_known:
                continue
            if hit or n == limit:
                break
            if row.norm is None or not row.valid or row.norm in taken:
                continue
            taken.add(row.norm)
            emitted.append(row)
            n += 1
    emitted_by: dict[Any, list[Any]] = {}
    for row in emitted:
        emitted_by.setdefault(row.section, []).append(row)
    for section, listed in lists.items():
        listed = [r for r in listed if rules.stop_on_known or not hits[id(r)][1]]
        if not listed or hits[id(listed[0])][0] and section in checkpoints:
            continue  # nothing listed, or caught up
        stopped = next((r for r in listed if hits[id(r)][0]), None)
        new = emitted_by.get(section, [])
        head, first = listed[0], new[0] if new else None
        if rules.rule == "head":
            to = head
        elif rules.rule == "first_new":
            to = first
        else:
            to = stopped or (head if new else None) or (None if section in checkpoints else head)
        if to is not None and to.link:
            changed[section] = Checkpoint(to.link, to.norm, to.number, to.said)
    return emitted, changed


def _values(column: pd.Series) -> list[Any]:
    """A column's values, null as None."""
    return column.astype(object).where(column.notna(), None).tolist()


def _whole(column: pd.Series) -> list[int | None]:
    return [None if v is None else int(v) for v in _values(column)]


@dataclass(slots=True)
class _Row:
    section: str | None
    section_ord: int
    pos: int
    link: str | None
    title: str | None
    valid: bool | None
    norm: str | None
    number: int | None
    said: str | None


def _rows(part: pd.DataFrame) -> list[_Row]:
    columns = [(_whole if c in ("section_ord", "pos", "number") else _values)(part[c]) for c in ("section", "section_ord", "pos", "link", "title", "valid", *_KEYS)]
    return [_Row(*values) for values in zip(*columns, strict=True)]


#: Parts that an outlet's state is kept in: each is read and written whole, so a run asks the store for parts, not for links.
PARTS = 64


def _part(name: str | None) -> int:
    return crc32((name or "").encode()) % PARTS


class OutletRuns(StatefulProcessor):
    """The state of one outlet, and its runs."""

    def __init__(self, rules: dict[str, Rules], limit: int, forget_days: int):
        self.rules, self.limit, self.forget = rules, limit, forget_days * 86_400_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.checkpoints = handle.getMapState("checkpoints", "part int", "sections array<string>, links array<string>, norms array<string>, numbers array<bigint>, saids array<string>")
        # A part that isn't written for so long has no link that was listed since.
        self.known = handle.getMapState("known", "part int", "norms array<string>, seen array<bigint>", self.forget)

    def _sections(self, sections: Iterable[str | None]) -> dict[str | None, Checkpoint]:
        """The checkpoints of all parts that hold any of the sections."""
        out = {}
        for part in {_part(s) for s in sections}:
            if (kept := self.checkpoints.getValue((part,))) is not None:
                out |= {section: Checkpoint(*c) for section, *c in zip(*kept, strict=True)}
        return out

    def _keep(self, sections: dict[str | None, Checkpoint], changed: Iterable[str | None]) -> None:
        """Writes the parts of the changed sections; `sections` has all that these parts hold."""
        parts = {_part(s): [] for s in changed}
        for section, c in sections.items():
            if (part := _part(section)) in parts:
                parts[part].append((section, c.link, c.norm, c.number, c.said))
        for part, kept in parts.items():
            self.checkpoints.updateValue((part,), tuple(map(list, zip(*kept, strict=True))))

    def _links(self, norms: Iterable[str], now: int) -> dict[str, int]:
        """When each link of all parts that hold any of the norms was last listed, without those to forget."""
        out = {}
        for part in {_part(n) for n in norms}:
            if (kept := self.known.getValue((part,))) is not None:
                out |= {norm: seen for norm, seen in zip(*kept, strict=True) if now - seen < self.forget}
        return out

    def _remember(self, known: dict[str, int], changed: Iterable[str]) -> None:
        parts = {_part(n): ([], []) for n in changed}
        for norm, seen in known.items():
            if (kept := parts.get(_part(norm))) is not None:
                kept[0].append(norm)
                kept[1].append(seen)
        for part, kept in parts.items():
            self.known.updateValue((part,), kept)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        """State rows (see operators.state) of checkpoints and, with a null `given`, of known links."""
        now = timerValues.getCurrentProcessingTimeInMs()
        known = initialState["known"].fillna(False).astype(bool)
        norms, rows = _values(initialState["norm"][known]), initialState[~known]
        if norms:
            self._remember(self._links(norms, now) | dict.fromkeys(norms, now), norms)
        if len(rows):
            columns = [_values(rows["link"]), _values(rows["norm"]), _whole(rows["number"]), _values(rows["said"])]
            given = {section: Checkpoint(*c) for section, *c in zip(_values(rows["section"]), *columns, strict=True)}
            self._keep(self._sections(given) | given, given)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        outlet, now, runs = key[0], timerValues.getCurrentProcessingTimeInMs(), {}
        for part in rows:
            for run, row in zip(_whole(part["run"]), _rows(part), strict=True):
                runs.setdefault(run, []).append(row)
        rules, out = self.rules[outlet], []
        checkpoints = self._sections({r.section for listed in runs.values() for r in listed})
        known = self._links({r.norm for listed in runs.values() for r in listed if r.norm is not None}, now)
        moved, listed_again = set(), set()
        for run in sorted(runs):
            listed = sorted(runs[run], key=lambda r: (0 if rules.one_list else r.section_ord, r.pos))
            emitted, changed = one_run(listed, checkpoints, known.__contains__, rules, self.limit)
            checkpoints |= changed
            moved |= changed.keys()
            # What is listed again is remembered longer.
            here = {r.norm for r in listed if r.norm in known} | {r.norm for r in emitted}
            known |= dict.fromkeys(here, now)
            listed_again |= here
            out += [(outlet, run, r.section, r.section_ord, r.pos, r.link, r.title) for r in emitted]
        self._keep(checkpoints, moved)
        self._remember(known, listed_again)
        yield pd.DataFrame(out, columns=[f.split()[0] for f in EMITTED.split(", ")])

    def close(self) -> None:
        pass


def initial_state(outlets: Sequence[Outlet], checkpoints: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """What a stream starts from: checkpoints (outlet_id, section, link and, if known, title) and links known before
    (outlet_id, link and, if known, title)."""
    titled = lambda df: df if "title" in df.columns else df.withColumn("title", F.lit(None).cast("string"))
    columns = ["outlet_id", "section", "link", *_KEYS, "known"]
    rows = keyed(titled(checkpoints), outlets).where("coalesce(link, '') <> ''").withColumn("known", F.lit(False)).select(*columns)
    if known is not None:
        rows = rows.unionByName(keyed(titled(known).withColumn("section", F.lit(None).cast("string")), outlets).where("norm IS NOT NULL").withColumn("known", F.lit(True)).select(*columns))
    return rows


def incremental_stream(lists: DataFrame, outlets: Sequence[Outlet], initial: DataFrame | None = None, limit: int = CAP_RUN, forget_days: int = FORGET_DAYS) -> DataFrame:
    """What the runs of a stream of lists emit, with the columns of EMITTED; its output mode is Append or Update.

    lists: outlet_id, run, section, section_ord, pos, link, title, valid; a run of an outlet comes in one micro-batch,
    and a micro-batch may hold several.  Rows of outlets that aren't listed are left out, promos aren't looked for, and a
    link or validity that is null is never emitted.  initial: the rows of initial_state().  The session needs the
    settings of stateful()."""
    rules = {o.id: Rules.of(o) for o in outlets}
    state = initial.groupBy("outlet_id") if initial is not None else None
    rows = keyed(lists.where(F.col("outlet_id").isin(*rules)), outlets)
    return rows.groupBy("outlet_id").transformWithStateInPandas(OutletRuns(rules, limit, forget_days), EMITTED, "Append", "ProcessingTime", state)


def stateful(spark: SparkSession) -> None:
    """Streams that start from now on keep their state in RocksDB, and end when their input does: a batch without lists has
    nothing to do but forget, and the next run's batch does that too."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
