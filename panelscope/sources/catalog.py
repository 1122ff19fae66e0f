"""Schema and catalog checks."""

from __future__ import annotations

import uuid

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class MissingColumns(ValueError):
    pass


def require_columns(df: DataFrame, required: Sequence[str]) -> None:
    """Fail fast when a required column is absent."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise MissingColumns(f"missing required columns: {missing}; available: {df.columns}")


def pick_column(df: DataFrame, candidates: Sequence[str], required: bool = True) -> str | None:
    """First candidate present in the frame."""
    for c in candidates:
        if c in df.columns:
            return c
    if required:
        raise MissingColumns(f"none of {list(candidates)} in {df.columns}")
    return None


def table_exists(spark: SparkSession, name: str) -> bool:
    """Case-insensitive table / view check."""
    return spark.catalog.tableExists(name)


def require_tables(spark: SparkSession, names: Sequence[str]) -> None:
    missing = [n for n in names if not table_exists(spark, n)]
    if missing:
        raise LookupError(f"required tables missing: {missing}")


def first_table(spark: SparkSession, names: Sequence[str]) -> str:
    """Preferred table, else the next."""
    for n in names:
        if table_exists(spark, n):
            return n
    raise LookupError(f"none of the tables exist: {list(names)}")


def register(df: DataFrame, name: str) -> DataFrame:
    """Make a frame queryable by name, no driver round trip."""
    df.createOrReplaceTempView(name)
    return df


def describe_columns(df: DataFrame) -> DataFrame:
    """Column name, type and position (S16), as ``DESCRIBE`` gives them."""
    rows = [(i + 1, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "ordinal_position int, column_name string, data_type string, "
                                                 "nullable boolean")


def is_empty(df: DataFrame) -> bool:
    """Stop-if-empty guard (S17): reads at most one row."""
    return df.isEmpty()


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach a row count to a frame without an extra job (S18): the count is
    filled in when the frame is next executed."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


class StepCounts:
    """Row counts after each step of a path, without a job of their own.

    ``step`` marks a frame; when the path's last frame is executed, every mark
    on the way is filled in.  ``table`` is then (place, step, rows, lost): rows
    after the step and rows fewer than after the one before (negative where a
    step adds some).  A step that was not executed is an error, not a wait."""

    def __init__(self):
        self._marks: list[tuple[str, Observation]] = []

    def step(self, df: DataFrame, name: str) -> DataFrame:
        marked, mark = counted(df, f"{name}-{uuid.uuid4().hex}")
        self._marks.append((name, mark))
        return marked

    def table(self, spark: SparkSession) -> DataFrame:
        rows, before = [], None
        for place, (name, mark) in enumerate(self._marks):
            n = mark.get.get("rows")
            if n is None:
                raise ValueError(f"step {name} was not executed")
            rows.append((place, name, n, 0 if before is None else before - n))
            before = n
        return spark.createDataFrame(rows, "place int, step string, rows bigint, lost bigint")


def completeness(df: DataFrame, col: str) -> DataFrame:
    """Total, non-null, null and non-null share (0 when empty) of a column."""
    return df.agg(F.count(F.lit(1)).alias("total"), F.count(col).alias("non_null")).select(
        "total", "non_null", (F.col("total") - F.col("non_null")).alias("null_count"),
        F.when(F.col("total") > 0, F.col("non_null") / F.col("total")).otherwise(F.lit(0.0)).alias("share"))
