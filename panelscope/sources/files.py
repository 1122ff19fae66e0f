"""File sources and sinks.

Readers take explicit paths and return string-typed, explicitly typed or, on
request, inferred DataFrames.
"""

from __future__ import annotations

import csv
import io
import itertools
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.clean import na_to_null, pad_code


def read_csv_strings(spark: SparkSession, paths: str | Sequence[str], na_tokens: bool = True,
                     encoding: str = "UTF-8", sep: str = ",") -> DataFrame:
    """Header CSV, every column a string (S2).  With ``na_tokens`` the
    cells a pandas string read treats as missing become null."""
    df = (spark.read.option("header", True).option("inferSchema", False).option("encoding", encoding)
          .option("sep", sep).csv(list(paths) if not isinstance(paths, str) else paths))
    if na_tokens:
        df = df.select(*[na_to_null(F.col(f"`{c}`")).alias(c) for c in df.columns])
    return df


def read_csv_typed(spark: SparkSession, paths: str | Sequence[str], schema: StructType | str,
                   pad: Mapping[str, int] | None = None, encoding: str = "UTF-8") -> DataFrame:
    """Header CSV with a declared schema (a StructType or DDL string) (S3);
    codes that a typed read would turn into numbers are re-padded (P12)."""
    df = (spark.read.option("header", True).option("encoding", encoding).schema(schema)
          .csv(list(paths) if not isinstance(paths, str) else paths))
    for c, width in (pad or {}).items():
        df = df.withColumn(c, pad_code(c, width))
    return df


def read_csv_latin1(spark: SparkSession, paths: str | Sequence[str], schema: StructType | None = None) -> DataFrame:
    """Single-byte encoded CSV."""
    if schema is not None:
        return read_csv_typed(spark, paths, schema, encoding="ISO-8859-1")
    return read_csv_strings(spark, paths, na_tokens=False, encoding="ISO-8859-1")


def _paths(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def _records(content: bytes, skip: int, sep: str, encoding: str) -> Iterator[list[str]]:
    """The records of a CSV file after its first ``skip`` lines, empty lines
    left out; a quoted cell may hold a newline."""
    csv.field_size_limit(1 << 30)
    lines = io.TextIOWrapper(io.BytesIO(content), encoding="utf-8-sig" if encoding.upper() == "UTF-8" else encoding, newline="")
    for _ in range(skip):
        lines.readline()
    return (r for r in csv.reader(lines, delimiter=sep) if r)


def read_csv_files(spark: SparkSession, paths: str | Sequence[str], skip: int = 0, *, columns: Sequence[str] | None = None,
                   file_column: str | None = None, sep: str = ",", encoding: str = "UTF-8", na_tokens: bool = False) -> DataFrame:
    """CSV files below ``paths``, each with a header of its own after ``skip``
    lines, as one scan of string columns stacked by name (S1, S2, S6).

    The columns are all names that occur, by their place in the headers, then
    by name; one job over all files finds them, none if ``columns`` says them.
    Whatever the number of files, the plan is one scan and one parse: a file is
    parsed by one task as a stream of records.  ``file_column`` adds the file's
    path.  Empty and missing cells are null, surplus ones are dropped, and with
    ``na_tokens`` so are the cells a string read treats as missing.  A name that
    a header repeats is its first column.  A file without a header line is an
    error."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(_paths(paths)).select("path", "content")

    def heads(batches):
        for batch in batches:
            path, place, name = [], [], []
            for p, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                head = next(_records(content.as_py(), skip, sep, encoding), None)
                for i, n in enumerate([None] if head is None else head):
                    path, place, name = [*path, p], [*place, i], [*name, n if n is None else n.strip()]
            yield pa.RecordBatch.from_arrays([pa.array(path, pa.string()), pa.array(place, pa.int32()), pa.array(name, pa.string())],
                                             names=["path", "place", "name"])

    if columns is None:
        found = files.mapInArrow(heads, "path string, place int, name string").groupBy("name").agg(
            F.min("place").alias("place"), F.min("path").alias("path")).collect()
        if not found:
            raise ValueError("no input files")
        for r in found:
            if r["name"] is None:
                raise ValueError(f"no header line found in {r['path']}")
        columns = [r["name"] for r in sorted(found, key=lambda r: (r["place"], r["name"]))]
    columns = list(columns)
    names = columns + ([file_column] if file_column else [])

    def parse(batches):
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                records = _records(content.as_py(), skip, sep, encoding)
                head = [n.strip() for n in next(records, [])]
                at = [head.index(c) if c in head else -1 for c in columns]
                while rows := list(itertools.islice(records, 8192)):
                    cells = [pa.array([(r[i] or None) if 0 <= i < len(r) else None for r in rows], pa.string()) for i in at]
                    yield pa.RecordBatch.from_arrays(cells + [pa.array([path] * len(rows), pa.string())] * bool(file_column), names=names)

    df = files.mapInArrow(parse, StructType([StructField(n, StringType()) for n in names]))
    if na_tokens:
        df = df.select(*[na_to_null(F.col(f"`{c}`")).alias(c) for c in columns], *names[len(columns):])
    return df


def read_csv_banner(spark: SparkSession, paths: str | Sequence[str], skip: int = 1, **options) -> DataFrame:
    """CSV files whose first ``skip`` lines precede the header (S1); see
    :func:`read_csv_files`."""
    return read_csv_files(spark, paths, skip, **options)


def period_of_file(file: str | Column, pattern: str) -> Column:
    """The period that a file's path names (S6, P7): the first group of
    ``pattern``, as an integer, null where the path has none."""
    return F.regexp_extract(file, pattern, 1).try_cast("int")


#: Ranks of the type lattice: null < int < bigint < double < string.
TYPES = ["string", "int", "bigint", "double", "string"]


def infer_types(df: DataFrame) -> list[tuple[str, str]]:
    """(column, type) of string columns, from all rows in one aggregate (S3):
    the least of int < bigint < double < string that every cell of a column
    reads as.  A column of nulls is a string.  Numbers may have spaces around
    them and a sign; ``1e5`` is a double, as are integers beyond 64 bits."""

    def rank(c):
        cell = F.trim(F.col(f"`{c}`"))
        whole = cell.rlike(r"^[+-]?[0-9]+$")
        return (F.when(F.col(f"`{c}`").isNull(), 0).when(whole & cell.try_cast("int").isNotNull(), 1)
                .when(whole & cell.try_cast("bigint").isNotNull(), 2)
                .when(cell.rlike(r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"), 3).otherwise(4))

    if not df.columns:
        return []
    row = df.agg(*[F.coalesce(F.max(rank(c)), F.lit(0)).alias(f"t{i}") for i, c in enumerate(df.columns)]).first()
    return [(c, TYPES[row[i]]) for i, c in enumerate(df.columns)]


def apply_types(df: DataFrame, types: Sequence[tuple[str, str]]) -> DataFrame:
    """Cast string columns to the types of :func:`infer_types`."""
    return df.select(*[F.col(f"`{c}`").alias(c) if t == "string" else F.trim(F.col(f"`{c}`")).cast(t).alias(c) for c, t in types])


def read_csv_inferred(spark: SparkSession, paths: str | Sequence[str], **options) -> DataFrame:
    """Header CSV files with the types that their cells agree on (S3)."""
    raw = read_csv_files(spark, paths, na_tokens=True, **options)
    return apply_types(raw, infer_types(raw))


def read_header_rows_json(spark: SparkSession, paths: str | Sequence[str], file_column: str | None = None) -> DataFrame:
    """JSON documents shaped as an array of string arrays, header first (S5):
    ``[["NAME","A","B"],["x","1","2"],...]`` -> one row per data array.

    A row is named by the header of its own document; the columns are all
    names that occur, sorted by their place in the documents.  One document
    per file (a JSON document is not splittable); all files are one scan, and
    ``file_column`` adds a row's path."""
    raw = spark.read.option("recursiveFileLookup", True).text(_paths(paths), wholetext=True)
    docs = raw.select(F.col("_metadata.file_path").alias("path"), F.from_json("value", "array<array<string>>").alias("a")).select(
        "path", F.get("a", F.lit(0)).alias("h"), "a")
    names = docs.select(F.posexplode("h").alias("at", "name")).groupBy("name").agg(F.min("at").alias("at")).orderBy("at", "name")
    columns = [r["name"] for r in names.collect()]
    if not columns:
        raise ValueError("payload has no header row")
    rows = docs.select("path", "h", F.posexplode("a").alias("pos", "row")).filter(F.col("pos") > 0)
    m = rows.select("path", F.map_from_arrays("h", "row").alias("m"))
    return m.select(*[F.col("m")[F.lit(c)].alias(c) for c in columns], *([F.col("path").alias(file_column)] if file_column else []))


def read_by_year(frames: Mapping[int, DataFrame], col: str = "year") -> DataFrame:
    """One frame per year, the year as a literal column, stacked by name."""
    out = None
    for year, df in frames.items():
        part = df.withColumn(col, F.lit(int(year)))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise ValueError("no input frames")
    return out


def write_csv(df: DataFrame, path: str, single_file: bool = False, sep: str = ",",
              encoding: str = "UTF-8", partition_by: Sequence[str] = ()) -> None:
    """Header CSV sink (S13, S14), in a folder for each value of
    ``partition_by``.  ``single_file`` coalesces to one part and is meant for
    report-sized tables only."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).option("sep", sep).option("encoding", encoding).partitionBy(*partition_by).csv(path)


def save_table(df: DataFrame, name: str, partition_by: Sequence[str] | None = None,
               path: str | None = None, buckets: int | None = None, bucket_by: Sequence[str] = ()) -> None:
    """Create-or-replace a table (S9, S10): Parquet, optionally partitioned
    (e.g. by period, for partition pruning), as a path or a catalog table.

    A catalog table may be bucketed and sorted on ``bucket_by``: the rows are
    shuffled once into one file a bucket, and joins and groups on these columns
    then read it without an exchange."""
    if buckets:
        df = df.repartition(buckets, *bucket_by)
    w = df.write.mode("overwrite").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if buckets:
        w = w.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    if path:
        w.save(path)
    else:
        w.saveAsTable(name)


def create_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    """``CREATE SCHEMA IF NOT EXISTS`` (S12), its tables below ``location``."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{place}")
