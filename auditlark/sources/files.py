"""Many files in one scan, each with a status row: a broken file costs its own rows, never the scan.

CSV files may have any header each. Headers are read as data (the first line of a file), so files of different layouts are rows of one
DataFrame with their cells in an array. A record is one line; RFC quotes are understood.
"""

from __future__ import annotations

import dataclasses

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LENIENT = {"recursiveFileLookup": "true", "ignoreCorruptFiles": "true", "ignoreMissingFiles": "true"}
NOT_FOUND = "File not found"
MAGIC_SEARCH_BYTES = 16_000_000


@dataclasses.dataclass
class Files:
    """``rows`` of the readable files, and ``status``: ``source, n_bytes, n_rows, n_bad_rows, header, error`` of every file."""
    rows: DataFrame
    status: DataFrame


def _relative(folder: str) -> Column:
    """A file's path below ``folder``."""
    tail = "/" + folder.rstrip("/").rsplit("/", 1)[-1] + "/"
    path = F.col("_metadata.file_path")
    return F.substring(path, F.instr(path, F.lit(tail)) + len(tail), F.length(path))


def listed(spark: SparkSession, folder: str) -> DataFrame:
    """``source, n_bytes`` of the files below a folder, from the listing that Spark keeps for every scan; no content is read."""
    tail = "/" + folder.rstrip("/").rsplit("/", 1)[-1] + "/"
    found = spark.read.format("binaryFile").options(recursiveFileLookup="true").load(folder)
    names = pa.table({"source": pa.array([f[f.index(tail) + len(tail):] for f in found.inputFiles()], pa.string())})
    sizes = found.select(_relative(folder).alias("source"), F.col("_metadata.file_size").alias("n_bytes"))  # empty files have no row here
    return spark.createDataFrame(names).join(sizes, "source", "left").select("source", F.coalesce("n_bytes", F.lit(0)).cast("bigint").alias("n_bytes"))


def _with_missing(status: DataFrame, expected: list[str] | None) -> DataFrame:
    """Status rows also of the files that should be there and are not."""
    if not expected:
        return status
    wanted = status.sparkSession.createDataFrame([(e,) for e in expected], "source string").join(status.select("source"), "source", "left_anti")
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in status.schema.fields if f.name not in ("source", "error")]
    return status.unionByName(wanted.select("source", *empty, F.lit(NOT_FOUND).alias("error")))


# --- CSV ---------------------------------------------------------------------------------------------------

def _n_cells(line: Column) -> Column:
    """Cells of a CSV line; separators inside quotes do not count."""
    outside = F.regexp_replace(line, '"[^"]*"', "")
    return F.length(outside) - F.length(F.replace(outside, F.lit(","), F.lit(""))) + 1


def _names(header: Column) -> Column:
    """The cells of a header line without quotes."""
    cells = F.regexp_extract_all(F.concat(F.lit(","), F.regexp_replace(header, "^﻿", "")), F.lit(r',("(?:[^"]|"")*"|[^,]*)'), F.lit(1))
    return F.transform(cells, lambda c: F.replace(F.regexp_replace(c, '^"|"$', ""), F.lit('""'), F.lit('"')))


def read_csv_files(spark: SparkSession, folder: str, expected: list[str] | None = None) -> Files:
    """All CSV files below a folder: ``rows`` are ``source, cells``, the cells as texts in the order of the file's header, empty ones null.

    A file is an error as a whole if it has no header, if a line has more cells than the header, or holds bytes that are no text. Lines equal to
    the header, and empty ones, are no rows; short lines are filled up with nulls. ``expected`` names files that should be there.
    """
    lines = spark.read.options(**LENIENT).text(folder).select(
        _relative(folder).alias("source"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place"), F.col("value").alias("line"))
    first = lines.where((F.col("block") == 0) & (F.col("line") != "")).groupBy("source").agg(F.min(F.struct("place", "line")).alias("first"))
    headers = first.select("source", F.col("first.line").alias("header_line"), _names(F.col("first.line")).alias("header"))
    records = lines.join(headers, "source").where((F.col("line") != F.col("header_line")) & (F.col("line") != "")).select("source", "line", "header")
    broken = (_n_cells(F.col("line")) > F.size("header")) | ~F.is_valid_utf8("line") | F.contains("line", F.lit("\0"))
    counted = records.groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(broken).alias("n_bad_rows"))

    status = listed(spark, folder).join(headers.select("source", "header"), "source", "left").join(counted, "source", "left")
    no_text = ~F.coalesce(F.forall("header", lambda h: F.is_valid_utf8(h) & ~F.contains(h, F.lit("\0"))), F.lit(True))
    error = (
        F.when(F.col("header").isNull() & (F.col("n_bytes") > 0), "Could not read CSV: no readable line")
        .when(F.col("header").isNull(), "Could not read CSV: no columns")
        .when(no_text, "Could not read CSV: not a text file")
        .when(F.col("n_bad_rows") > 0, F.format_string("Could not read CSV: %d malformed rows", "n_bad_rows")))
    zero = F.lit(0).cast("bigint")
    status = status.select(
        "source", "n_bytes", F.coalesce("n_rows", zero).alias("n_rows"), F.coalesce("n_bad_rows", zero).alias("n_bad_rows"), F.when(~no_text, F.col("header")).alias("header"),
        error.alias("error"))

    widest = headers.agg(F.max(F.size("header"))).first()[0] or 1  # one number
    schema = ", ".join(f"c{i} string" for i in range(widest))
    parsed = F.from_csv("line", schema, {"escape": '"', "mode": "PERMISSIVE"})
    good = status.where(F.col("error").isNull()).select("source")
    rows = records.join(good, "source").select("source", "header", F.explode(F.array(parsed)).alias("c"))
    rows = rows.select("source", F.slice(F.array(*(F.col(f"c.c{i}") for i in range(widest))), F.lit(1), F.size("header")).alias("cells"))
    return Files(rows, _with_missing(status, expected))


def position(header: Column, names: list[str] | tuple[str, ...]) -> Column:
    """Where the first of ``names`` that a header has stands, from 0; null where it has none."""
    wanted = F.array(*(F.lit(n) for n in names))
    present = F.filter(wanted, lambda n: F.array_contains(header, n))
    return F.when(F.size(present) > 0, F.array_position(header, F.get(present, F.lit(0))) - 1).cast("int")


# --- Parquet -----------------------------------------------------------------------------------------------

def read_parquet_files(spark: SparkSession, folder: str, schema: str | T.StructType, expected: list[str] | None = None) -> Files:
    """All Parquet files of one layout below a folder: ``rows`` have ``source`` and the columns of ``schema``.

    Footers tell how many rows a file should have. A file without a footer, and one whose pages break during the scan (it gives fewer rows), is an error row; the others
    are read all the same. Rows of broken files are left out.
    """
    every = spark.read.options(**LENIENT).schema(schema).parquet(folder)
    names = every.columns
    rows = every.select(_relative(folder).alias("source"), *(F.col(f"`{c}`") for c in names))
    promised = every.select(_relative(folder).alias("source")).groupBy("source").agg(F.count(F.lit(1)).alias("promised"))  # reads footers only
    # What a scan of all columns gives: the hash makes it read every page, where a mere count would not.
    given = rows.groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"), F.bit_xor(F.xxhash64(*(F.col(f"`{c}`") for c in names))).alias("mark"))
    status = listed(spark, folder).join(promised, "source", "left").join(given.select("source", "n_rows", "mark"), "source", "left")
    tails = spark.read.format("binaryFile").options(recursiveFileLookup="true").load(folder).where(F.col("length") <= MAGIC_SEARCH_BYTES)
    tails = tails.select(_relative(folder).alias("source"), (F.substring("content", -4, 4) == F.lit("PAR1").cast("binary")).alias("whole"))
    # Only files without any row are opened again: a file that is empty by right is small and ends with the format's mark.
    silent = status.where(F.coalesce("n_rows", F.lit(0)) == 0).select("source")
    status = status.join(tails.join(silent, "source", "left_semi"), "source", "left")
    error = (
        F.when((F.coalesce("n_rows", F.lit(0)) < F.coalesce("promised", F.lit(0))) | (F.col("mark").isNull() & (F.col("n_rows") > 0)), "Could not read table: pages are broken")
        .when(F.col("n_rows").isNull() & ~F.coalesce("whole", F.lit(False)), "Could not read table: no footer"))
    zero = F.lit(0).cast("bigint")
    status = status.select("source", "n_bytes", F.coalesce("n_rows", zero).alias("n_rows"), zero.alias("n_bad_rows"),
                           F.array(*(F.lit(c) for c in names)).alias("header"), error.alias("error"))
    good = status.where(F.col("error").isNull()).select("source")
    return Files(rows.join(good, "source", "left_semi"), _with_missing(status, expected))
