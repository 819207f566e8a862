"""Readers (A1-A5): delimited directories and Parquet, typed at read.

A delimited file is read as lines, so each record keeps its text, its file and the place in it (``records``): columns are found by
name in the file's header, and what does not fit the header or a type is listed by ``read_rejects`` and never changed unseen.
A record is malformed when

* ``short`` or ``long``: it has fewer or more cells than its header.  The table holds it with nulls for missing cells and
  without the cells beyond the header;
* ``quote``: a quoted cell is not closed on its line, or goes on behind its closing quote.

``malformed`` says what a table does with them: ``keep`` (the default, as Spark's own reader reads them), ``drop`` or ``raise``.
A line that repeats its file's header is taken for one, wherever it stands (files that were put together); blank lines are skipped.
"""

from __future__ import annotations

import csv
import re
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from skyledger.sources import schemas

TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
MALFORMED = ("keep", "drop", "raise")


def data_files(spark: SparkSession, paths: str | list[str]) -> list:
    """The files with content of files or folders, as Hadoop paths; names that start with ``_`` or ``.`` are no data, as for Spark's own listing."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    files = []
    for path in [paths] if isinstance(paths, str) else paths:
        root = jvm.org.apache.hadoop.fs.Path(path)
        fs = root.getFileSystem(conf)
        pending = [fs.getFileStatus(root)]
        while pending:
            status = pending.pop()
            for child in fs.listStatus(status.getPath()) if status.isDirectory() else [status]:
                if child.getPath().getName().startswith(("_", ".")) and child.getPath() != root:
                    continue
                if child.isDirectory():
                    pending.append(child)
                elif child.getLen() > 0:
                    files.append(child.getPath())
    return files


def layouts(spark: SparkSession, path: str | list[str]) -> dict[str, list[str]]:
    """Header line -> files that begin with it, for delimited files or folders.

    Only the first line of each file is read, by a few threads of the driver.  Compressed files are read through their codec.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    files = data_files(spark, path)
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def header(file) -> str:
        stream, codec = file.getFileSystem(conf).open(file), codecs.getCodec(file)
        lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
        try:
            return (lines.readLine() or "").removeprefix("\ufeff")  # as Spark's line reader does
        finally:
            lines.close()

    found: dict[str, list[str]] = {}
    with ThreadPoolExecutor(16) as pool:
        for line, file in zip(pool.map(header, files), files, strict=True):
            found.setdefault(line, []).append(file.toString())
    return dict(sorted(found.items()))


def header_names(line: str, sep: str) -> tuple[str, ...]:
    """The column names of a header line."""
    return tuple(next(csv.reader([line], delimiter=sep), []))


def _broken(line: Column, cells: Column, sep: str) -> Column:
    """Why a line is malformed, or null."""
    s = re.escape(sep)
    quoted = '"(?:[^"]++|"")*+"'
    cell = f'(?:{quoted}|[^{s}"][^{s}]*+|)'
    well_quoted = line.rlike(f"^{cell}(?:{s}{cell})*+$") | ~line.contains('"')
    bare = F.when(line.contains('"'), F.regexp_replace(line, f"(^|{s}){quoted}", "$1")).otherwise(line)
    count = F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit(""))) + 1
    return F.when(~well_quoted, "quote").when(count < cells, "short").when(count > cells, "long")


def records(spark: SparkSession, path: str | list[str], columns: list[str], sep: str = ";") -> DataFrame:
    """Every record: file, block (where the part of the file begins that a task read), line (its text), broken (why it is malformed), row (the named cells as text).

    Files of different layouts in one folder are read layout by layout, whatever else they hold and in whatever order (A1, A3).
    A layout without one of the columns, or with one twice, raises.
    """
    parts = []
    for header, files in layouts(spark, path).items():
        names = header_names(header, sep)
        missing = [c for c in columns if names.count(c) != 1]
        if missing:
            raise ValueError(f"{files[0]}: the header {list(names)} must hold each of {missing} once")
        lines = spark.read.text(files).where((F.col("value") != header) & (F.trim("value") != "")) \
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"))
        cells = F.from_csv("line", F.lit(", ".join(f"c{i} string" for i in range(len(names)))), {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE"})
        parsed = lines.withColumn("__cells", cells)
        row = F.struct(*[F.col("__cells")[f"c{names.index(c)}"].alias(c) for c in columns])
        parts.append(parsed.select("file", "block", "line", _broken(F.col("line"), F.lit(len(names)), sep).alias("broken"), row.alias("row")))
    if not parts:
        row_type = StructType([StructField(c, StringType()) for c in columns])
        return spark.createDataFrame([], "file string, block long, line string, broken string").withColumn("row", F.lit(None).cast(row_type))
    return reduce(DataFrame.unionByName, parts)


def read_texts(spark: SparkSession, path: str | list[str], columns: list[str], sep: str = ";", malformed: str = "keep") -> DataFrame:
    """The named columns as text (A1, A3)."""
    if malformed not in MALFORMED:
        raise ValueError(f"malformed must be one of {MALFORMED}, not {malformed!r}")
    found = records(spark, path, columns, sep)
    if malformed == "drop":
        found = found.where(F.col("broken").isNull())
    elif malformed == "raise":
        message = F.concat(F.lit("malformed record ("), "broken", F.lit(") in "), "file", F.lit(": "), "line")
        found = found.where(F.when(F.col("broken").isNull(), True).otherwise(F.raise_error(message).cast("boolean")))
    return found.select(*[F.col("row")[c].alias(c) for c in columns])


def _typed(field: StructField, text: Column | None = None) -> Column:
    c = F.col(f"`{field.name}`") if text is None else text
    return c if isinstance(field.dataType, StringType) else F.trim(c).try_cast(field.dataType)


def read_delimited(spark: SparkSession, path: str | list[str], schema: StructType | None = None, sep: str = ";",
                   header: bool = True, infer: bool = False, malformed: str = "keep") -> DataFrame:
    """A file, files or a directory of delimited files as one table (A1, A2, A3).

    With a schema its columns are found by name in each file's header, read as text and cast; a cell that does not
    fit its type is null here and listed by ``read_rejects``, as are malformed records.  ``infer=True`` is kept for ad-hoc use
    and costs one extra scan; like a read without a header it is Spark's own reader.
    """
    if schema is not None and header:
        return read_texts(spark, path, schema.names, sep, malformed).select(*[_typed(f).alias(f.name) for f in schema.fields])
    r = (spark.read.option("sep", sep).option("header", header).option("mode", "PERMISSIVE")
         .option("quote", '"').option("escape", '"').option("timestampNTZFormat", TS_FORMAT))
    if schema is not None:
        r = r.schema(schema)
    elif infer:
        r = r.option("inferSchema", True).option("timestampFormat", TS_FORMAT)
    return r.csv(path)


def read_rejects(spark: SparkSession, path: str | list[str], schema: StructType, sep: str = ";") -> DataFrame:
    """What ``read_delimited`` cannot take as it stands: file, block, line, reason, column, value, and the row as a map of texts.

    One row per malformed record (reason short, long or quote; column and value null), and one per cell of the other
    records that does not fit its type (reason type).
    """
    def cell(f: StructField) -> Column:
        return F.col("row")[f.name]
    bad = [F.when((F.trim(cell(f)) != "") & _typed(f, cell(f)).isNull(), F.struct(F.lit("type").alias("reason"), F.lit(f.name).alias("column"), cell(f).alias("value")))
           for f in schema.fields if not isinstance(f.dataType, StringType)]
    whole = F.struct(F.col("broken").alias("reason"), F.lit(None).cast("string").alias("column"), F.lit(None).cast("string").alias("value"))
    row = F.create_map(*[x for c in schema.names for x in (F.lit(c), F.col("row")[c])])
    cells = F.array_compact(F.array(*bad)) if bad else F.array().cast("array<struct<reason: string, column: string, value: string>>")
    found = records(spark, path, schema.names, sep)
    found = found.select("file", "block", "line", F.explode(F.when(F.col("broken").isNull(), cells).otherwise(F.array(whole))).alias("bad"), row.alias("row"))
    return found.select("file", "block", "line", "bad.reason", "bad.column", "bad.value", "row")


def read_reference(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A small comma-separated lookup table with header (A4)."""
    return read_delimited(spark, path, schema=schema, sep=",")


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet scan (A5); filters and projections are pushed by Catalyst."""
    return spark.read.parquet(*paths)


# ---- the named raw sources --------------------------------------------------------

def read_sessions(spark, path: str) -> DataFrame:
    return read_delimited(spark, path, schemas.SESSIONS, sep=";")


def read_rates(spark, path: str) -> DataFrame:
    return read_delimited(spark, path, schemas.RATES, sep=";")


def read_magnitudes(spark, path: str) -> DataFrame:
    return read_delimited(spark, path, schemas.MAGNITUDES, sep=";")


def read_weather(spark, path: str) -> DataFrame:
    return read_delimited(spark, path, schemas.WEATHER, sep=",")


def read_addresses(spark, path: str) -> DataFrame:
    return read_reference(spark, path, schemas.ADDRESSES)


def read_locations(spark, path: str) -> DataFrame:
    return read_reference(spark, path, schemas.LOCATIONS)


def read_weather_codes(spark, path: str) -> DataFrame:
    return read_reference(spark, path, schemas.WEATHER_CODES)


def read_shower_list(spark, path: str) -> DataFrame:
    return read_reference(spark, path, schemas.SHOWER_LIST)
