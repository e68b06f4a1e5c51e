"""The generic incremental run: an outlet's configuration instead of an outlet's code."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedwright.functions.text import article_id, composite_key, normalize_link, story_id, title_key
from feedwright.operators import feeds
from feedwright.sources.registry import Outlet

CAP_BOOTSTRAP, CAP_RUN = 5, 15


@dataclass
class Run:
    """What a run emits, and the checkpoints after it; without anything listed both are as before and
    nothing is to be written."""

    emitted: DataFrame
    checkpoints: DataFrame
    write: bool = True


def numeric_id(outlet: Outlet, link: Column) -> Column | None:
    """The number of a link, 0 if it has none; null where an outlet's links aren't numbered."""
    return {"story_id": story_id, "article_id": article_id}[outlet.key](link) if outlet.key in ("story_id", "article_id") else None


def title_suffix(outlet: Outlet) -> str:
    return outlet.display_name.replace(" ", "")


def feed_key(outlet: Outlet, norm: Column | None = None) -> Column:
    """What a link is known by.  A link without a number is known by its address, so two of them are two articles.
    norm: the normalised link, if it is at hand."""
    link, title = F.col("link"), F.coalesce(F.col("title"), F.lit(""))
    norm = normalize_link(link) if norm is None else norm
    number = numeric_id(outlet, link)
    if number is not None:
        return F.when(number > 0, number.cast("string")).otherwise(norm)
    if outlet.key == "composite":
        return composite_key(link, title, outlet.homepage_url.split("://")[1].removeprefix("www."), title_suffix(outlet), norm)
    return norm


def _titled(df: DataFrame) -> DataFrame:
    return df if "title" in df.columns else df.withColumn("title", F.lit(None).cast("string"))


def incremental_run(outlet: Outlet, feed: DataFrame, checkpoints: DataFrame, known: DataFrame, bootstrap: bool = False) -> Run:
    """feed: outlet_id, section, section_ord, pos, link, title, valid; checkpoints: outlet_id, section, link
    and, if known, title; known: link and, if known, title.  Boundaries, promos, first-wins and caps as
    the outlet is configured; numeric keys also stop at ids below the checkpoint's (0 is no id and never
    stops); composite keys also stop at the checkpoint's title.  A section whose head is a boundary has
    caught up and keeps its checkpoint.  A null section is a section like any other."""
    rows = feed.withColumn("norm", feed_key(outlet))
    if outlet.capped == "run":  # one list: sections don't matter
        rows = rows.withColumn("section_ord", F.lit(0))
    if outlet.promos:
        rows = feeds.without_promos(rows)
    keyed = _titled(checkpoints).select("outlet_id", "section", feed_key(outlet).alias("cp"), F.col("link").alias("cp_link"), F.col("title").alias("cp_title"))
    seen = _titled(known).select(feed_key(outlet).alias("norm")).distinct().withColumn("is_known", F.lit(True))
    rows = feeds.met(rows, keyed, ["outlet_id", "section"], "left")
    if outlet.on_known == "skip":
        rows = rows.join(seen, "norm", "left_anti").withColumn("is_known", F.lit(None).cast("boolean"))
    else:
        rows = rows.join(seen, "norm", "left")
    hit = feeds.boundary_reason(F.col("norm"), F.col("cp"), F.col("is_known")).isNotNull()
    n = numeric_id(outlet, F.col("link"))
    if n is not None:
        at = numeric_id(outlet, F.col("cp_link"))
        hit = (n > 0) & (hit | F.coalesce((at > 0) & (n <= at), F.lit(False)))
    if outlet.key == "composite":
        said = F.coalesce("cp_title", F.lit(""))
        hit = hit | ((said != "") & (title_key(F.col("title"), title_suffix(outlet)) == title_key(said, title_suffix(outlet))))
    rows = rows.withColumn("boundary", F.coalesce(hit, F.lit(False)))
    limit = CAP_BOOTSTRAP if bootstrap else CAP_RUN
    folded = feeds.emit_fold(rows, limit)
    place = ["outlet_id", "section_ord", "pos", "norm"]
    emitted = rows.join(folded, place, "left_semi")
    k = ["outlet_id", "section"]
    old = checkpoints.select(*k, F.col("link").alias("checkpoint"))
    advanced = feeds.advance_checkpoint(rows, emitted, old, F.col("boundary"), k, outlet.rule)
    kept = feeds.caught_up(rows, F.col("boundary"), k).where("caught_up").select(*k)
    kept = feeds.met(kept, old, k)
    advanced = feeds.met(advanced, kept.withColumnRenamed("checkpoint", "_kept"), k, "left").select(*k, F.coalesce("_kept", "link").alias("link"))
    return Run(emitted.select(*feed.columns), advanced)


def interleaved_run(outlet: Outlet, feed: DataFrame, section: Column, sections: Sequence[str], checkpoints: DataFrame, known: DataFrame, bootstrap: bool = False) -> Run:
    """incremental_run() of one feed whose links tell their sections: each section stops and is capped on
    its own, in the order of the feed; links of no section are dropped.

    feed: outlet_id, pos, link, title, valid."""
    place = F.array_position(F.array(*map(F.lit, sections)), F.col("section")) - 1
    rows = feed.withColumn("section", section).where(F.col("section").isin(*sections)).withColumn("section_ord", place.cast("int"))
    return incremental_run(outlet, rows, checkpoints, known, bootstrap)


def run_or_keep(outlet: Outlet, feed: DataFrame, checkpoints: DataFrame, known: DataFrame, bootstrap: bool = False) -> Run:
    """incremental_run(), unless all lists are empty, which is a failure: then state and data stay as they are."""
    if feed.isEmpty():
        return Run(feed, checkpoints.select("outlet_id", "section", "link"), write=False)
    return incremental_run(outlet, feed, checkpoints, known, bootstrap)


@dataclass
class Outcome:
    outlet_id: str
    count: int
    error: str | None = None


def run_outlets(outlets: Sequence[Outlet], run: Callable[[Outlet], int], start_from: str | None = None) -> list[Outcome]:
    """Run outlet by outlet, from one on if asked; a failure stays its outlet's own.  An unknown start runs nothing."""
    names = [o.id for o in outlets]
    begin = 0 if start_from is None else names.index(start_from) if start_from in names else len(names)
    out = []
    for o in outlets[begin:]:
        try:
            out.append(Outcome(o.id, run(o)))
        except Exception as e:  # noqa: BLE001  whatever an outlet's run raises
            out.append(Outcome(o.id, 0, f"{type(e).__name__}: {e}"))
    return out


def run_concurrently(spark: SparkSession, outlets: Sequence[Outlet], run: Callable[[Outlet], int], at_once: int = 4, timeout: float | None = None) -> list[Outcome]:
    """Run outlets side by side, in their order of start and of the result; a failure stays its outlet's own.

    Each outlet's jobs have a tag, and a scheduler pool of their own (fair where the cluster's scheduler is).  One
    that takes more than `timeout` seconds from its own start fails: its jobs are interrupted by their tag, and the others
    go on.  run() must not swallow an interrupted job, and should not wait for anything but Spark."""
    context, began = spark.sparkContext, {}

    def work(o: Outlet) -> Outcome:
        tag = f"outlet-{o.id}"
        began[o.id] = time.monotonic()
        context.addJobTag(tag)
        context.setInterruptOnCancel(True)
        context.setLocalProperty("spark.scheduler.pool", o.id)
        try:
            return Outcome(o.id, run(o))
        except Exception as e:  # noqa: BLE001  whatever an outlet's run raises
            return Outcome(o.id, 0, f"{type(e).__name__}: {str(e)[:500]}")
        finally:
            context.removeJobTag(tag)
            context.setInterruptOnCancel(False)
            context.setLocalProperty("spark.scheduler.pool", None)

    done: dict[str, Outcome] = {}
    pool = ThreadPoolExecutor(at_once, "outlet")
    waiting = {pool.submit(inheritable_thread_target(spark)(work), o): o for o in outlets}
    late: set[str] = set()
    while waiting:
        ended, _ = wait(waiting, timeout=0.2, return_when=FIRST_COMPLETED)
        for future in ended:
            outcome = future.result()
            o = waiting.pop(future)
            done[o.id] = Outcome(o.id, 0, f"TimeoutError: more than {timeout} s") if o.id in late else outcome
        for o in list(waiting.values()):
            if timeout is not None and time.monotonic() - began.get(o.id, float("inf")) > timeout:
                late.add(o.id)
                context.cancelJobsWithTag(f"outlet-{o.id}")  # again until its jobs have ended: it may start another
    pool.shutdown()
    return [done[o.id] for o in outlets]


def run_dates(outlets: Sequence[Outlet], command: Callable[[Outlet, str, str], int], start: str, end: str, names: Sequence[str] | None = None) -> list[Outcome]:
    """A date-range run, each outlet in a process or session of its own: command gives an exit code, and
    one that isn't 0 is that outlet's failure."""
    chosen = [o for o in outlets if not names or o.id in names]
    out = []
    for o in chosen:
        code = command(o, start, end)
        out.append(Outcome(o.id, 0, None if code == 0 else f"exit code {code}"))
    return out


def summary(outcomes: Sequence[Outcome]) -> tuple[list[str], list[str], int]:
    """Succeeded ids, failed ids and the exit code: 0 only if none failed."""
    failed = [o.outlet_id for o in outcomes if o.error is not None]
    return [o.outlet_id for o in outcomes if o.error is None], failed, int(bool(failed))
