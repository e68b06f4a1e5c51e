"""Outlets: the registry that everything joins through, and how each feed is run."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Outlet:
    """runs_on: `local` or `shared` workers.  key: what identifies a link; on_known: what a known link
    does; capped: per section or per run; rule: how a checkpoint advances (see operators.feeds)."""

    id: str
    display_name: str
    language: str
    homepage_url: str
    data_file: str
    runs_on: str
    key: str = "url"
    on_known: str = "stop"
    capped: str = "section"
    promos: bool = False
    rule: str = "boundary"


# Ids, names, languages, addresses and files of the feeds, and how each is run.
OUTLETS = (
    Outlet("sundaytimes", "Sunday Times", "English", "https://www.sundaytimes.lk", "sundaytimes_latest_news.json", "shared", on_known="skip", rule="head"),
    Outlet("dailynews", "Daily News", "English", "https://dailynews.lk", "dailynews_latest_news.json", "local", promos=True),
    Outlet("ceylontoday", "Ceylon Today", "English", "https://ceylontoday.lk", "ceylontoday_finance.json", "local", promos=True),
    Outlet("dailymirror", "Daily Mirror", "English", "https://www.dailymirror.lk", "dailymirror_latest_news.json", "shared", key="story_id", capped="run", rule="head"),
    Outlet("ftlk", "FT.lk", "English", "https://www.ft.lk", "ftlk_latest_news.json", "local", on_known="skip", rule="head"),
    Outlet("economynext", "Economy Next", "English", "https://economynext.com", "economynext_latest_news.json", "local", key="composite", capped="run", rule="head"),
    Outlet("morning", "The Morning", "English", "https://www.themorning.lk", "themorning_latest_news.json", "shared", rule="head"),
    Outlet("sundayobserver", "Sunday Observer", "English", "https://www.sundayobserver.lk", "sundayobserver_latest_news.json", "local", promos=True),
    Outlet("divaina", "Divaina", "Sinhala", "https://www.divaina.lk", "divaina_latest_news.json", "shared", promos=True),
    Outlet("lankadeepa", "Lankadeepa", "Sinhala", "https://www.lankadeepa.lk", "lankadeepa_latest_news.json", "shared", rule="head"),
    Outlet("aruna", "Aruna", "Sinhala", "https://www.aruna.lk", "aruna_latest_news.json", "shared"),
    Outlet("mawbima", "Mawbima", "Sinhala", "https://mawbima.lk", "mawbima_latest_news.json", "shared", promos=True),
    Outlet("virakesari", "Virakesari", "Tamil", "https://www.virakesari.lk", "virakesari_latest_news.json", "shared", key="article_id", rule="first_new"),
    Outlet("thinakaran", "Thinakaran", "Tamil", "https://www.thinakaran.lk", "thinakaran_latest_news.json", "local", rule="first_new"),
    Outlet("thamilan", "Thamilan", "Tamil", "https://www.thamilan.lk", "thamilan_latest_news.json", "shared", promos=True),
    Outlet("island", "The Island", "English", "https://island.lk", "island_latest_news.json", "local", rule="head"),
    Outlet("dinamina", "Dinamina", "Sinhala", "https://www.dinamina.lk", "dinamina_latest_news.json", "local", rule="head"),
)
BY_ID = {o.id: o for o in OUTLETS}
#: Names that are no batches, though they lie beside them (fixed values).
NO_BATCH = ("_checkpoint", "_translated_en", "_archive", "discarded_links")


#: Other names of outlets (fixed values).
ALIASES = {"ft": "ftlk", "observer": "sundayobserver"}


def canonical_name(name: str) -> str:
    """The id that a name on a command line stands for: any case, with or without the endings of a script."""
    key = name.lower().removesuffix(".py").removesuffix("_selenium_json")
    return ALIASES.get(key, key)


def unknown_names(names: Sequence[str]) -> list[str]:
    return [n for n in names if canonical_name(n) not in BY_ID]


def aliases(spark: SparkSession) -> DataFrame:
    """(alias, id): every outlet under its id and its other names."""
    rows = [(o.id, o.id) for o in OUTLETS] + sorted(ALIASES.items())
    return spark.createDataFrame(rows, "alias string, id string")


def outlets(spark: SparkSession) -> DataFrame:
    """The outlet dimension, 17 rows: small by construction, so joins may broadcast it."""
    rows = [(i, o.id, o.display_name, o.language, o.homepage_url, True, o.data_file, o.runs_on) for i, o in enumerate(OUTLETS)]
    return spark.createDataFrame(rows, "ord int, id string, display_name string, language string, homepage_url string, is_active boolean, data_file string, runs_on string")


def resolve_targets(spark: SparkSession, ids: list[str] | None = None, runs_on: str | None = None) -> DataFrame:
    """An explicit list, in its order, beats runs_on, which beats all; unknown ids are left out, with a warning."""
    if ids:
        if lost := unknown_names(ids):
            warnings.warn(f"no outlets of these names: {', '.join(lost)}", stacklevel=2)
        ids = [canonical_name(i) for i in ids]
        wanted = spark.createDataFrame([(i, x) for i, x in enumerate(dict.fromkeys(ids))], "target_ord int, id string")
        return outlets(spark).join(F.broadcast(wanted), "id")
    every = outlets(spark).withColumn("target_ord", F.col("ord"))
    return every.where(F.col("runs_on") == runs_on) if runs_on else every


def seed(existing: DataFrame, rows: DataFrame, key: str = "id") -> DataFrame:
    """Insert the rows whose key isn't there yet."""
    return existing.unionByName(rows.join(existing.select(key), key, "left_anti").select(*existing.columns))


def is_batch_name(name):
    """Column predicate on a file's name."""
    out = F.endswith(name, F.lit(".json"))
    for part in NO_BATCH:
        out = out & ~F.contains(name, F.lit(part))
    return out
