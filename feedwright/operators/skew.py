"""Joins that no frequent key can crowd into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Parts that a key's rows are dealt into.
SALTS = 16


def dealt(rows: DataFrame, answers: DataFrame, keys: Sequence[str], by: str, salts: int = SALTS) -> DataFrame:
    """rows joined to the answers of their keys (one row each, or few), in salted parts.

    The answers are repeated once per part, so a key's rows, however many, meet theirs in `salts`
    tasks; `by` is a column that tells the rows of a key apart."""
    parts = answers.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(salts)).cast("int")).join(parts, [*keys, "_salt"]).drop("_salt")
