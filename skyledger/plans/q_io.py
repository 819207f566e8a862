"""Registry: sources and sinks (A1-A8, F1) as write-then-read round trips.

Every write goes to a fresh folder under the session's shared checkpoint
folder; what comes back is read with the reader under test.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from skyledger.session import scratch_path
from skyledger.sources.readers import read_delimited, read_parquet, read_rejects
from skyledger.sources.sinks import export_csv, write_parquet, write_sorted
from skyledger.plans.registry import register
from skyledger.plans.tables import Tables


@register("csv_roundtrip", "A1 A3 A7", sql="SELECT * FROM customer")
def csv_roundtrip(spark, d):
    cust = Tables(spark, d).customer
    path = scratch_path(spark, "csv_roundtrip")
    # the reader must take the folder's part files as one table
    cust.write.option("sep", ";").option("header", True).csv(path)
    return read_delimited(spark, path, schema=cust.schema, sep=";")


@register("csv_layouts", "A1 A3 A7", sql="SELECT * FROM orders")
def csv_layouts(spark, d):
    """Two layouts of one table in one folder: columns in reverse order, and with an extra column in front."""
    orders = Tables(spark, d).orders
    path = scratch_path(spark, "csv_layouts")
    even = F.col("o_orderkey") % 2 == 0
    text = [F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) if t.startswith("timestamp") else F.col(c) for c, t in orders.dtypes]
    out = {"header": True, "sep": ";"}
    orders.where(even).select(*reversed(text)).write.options(**out).csv(path)
    orders.where(~even).select(F.lit("x;\"y\"").alias("User ID"), *text, F.lit(6.1).alias("Lmg")).write.options(**out, escape='"').mode("append").csv(path)
    return read_delimited(spark, path, schema=orders.schema, sep=";")


# Records by rule of the order key: cells that do not fit their type, and records that do not fit the header.
_BAD_RECORDS = {19: ("quote", "o_orderkey || ';\"' || o_custkey || ';7'"), 17: ("long", "o_orderkey || ';' || o_custkey || ';7;extra'"), 13: ("short", "o_orderkey || ';' || o_custkey")}
_REASON = "CASE " + " ".join(f"WHEN o_orderkey % {k} = 0 THEN '{why}'" for k, (why, _) in _BAD_RECORDS.items()) + " END"
_LINE = "CASE " + " ".join(f"WHEN o_orderkey % {k} = 0 THEN {line}" for k, (_, line) in _BAD_RECORDS.items()) + \
    " ELSE o_orderkey || ';' || CASE WHEN o_orderkey % 11 = 0 THEN '12x' ELSE CAST(o_custkey AS VARCHAR(20)) END || ';' || " \
    "CASE WHEN o_orderkey % 7 = 0 THEN o_orderkey || ' n/a' ELSE '7' END END"


@register("csv_rejects", "A1 A3 B4 (rejects)", sql=f"""
WITH rows AS (SELECT *, {_REASON} AS reason, {_LINE} AS line FROM orders)
SELECT true AS known_file, reason, NULL::VARCHAR AS "column", NULL::VARCHAR AS value, line FROM rows WHERE reason IS NOT NULL
UNION ALL SELECT true, 'type', 'o_number', o_orderkey || ' n/a', line FROM rows WHERE reason IS NULL AND o_orderkey % 7 = 0
UNION ALL SELECT true, 'type', 'o_custkey', '12x', line FROM rows WHERE reason IS NULL AND o_orderkey % 11 = 0
""")
def csv_rejects(spark, d):
    """Cells that do not fit their type and short, long and open-quote records, written by rule, must all be listed with file and text."""
    orders = Tables(spark, d).orders
    path = scratch_path(spark, "csv_rejects")
    # written as one column without quoting, whose name is the header line
    orders.select(F.expr(_LINE).alias("o_orderkey;o_custkey;o_number")).write.options(header=True, sep="\x01", quote="").csv(path)
    schema = StructType([StructField("o_orderkey", LongType()), StructField("o_custkey", LongType()), StructField("o_number", LongType())])
    found = read_rejects(spark, path, schema, sep=";")
    return found.select(F.col("file").rlike("/csv_rejects-[^/]+/part-[^/]+[.]csv$").alias("known_file"), "reason", "column", "value", "line")


@register("csv_malformed_dropped", "A1 A3 (malformed records)", sql=f"""
SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_custkey END AS o_custkey FROM orders WHERE {_REASON} IS NULL
""")
def csv_malformed_dropped(spark, d):
    """The same records as a table without the malformed ones; cells of another type are null."""
    orders = Tables(spark, d).orders
    path = scratch_path(spark, "csv_malformed")
    orders.select(F.expr(_LINE).alias("o_orderkey;o_custkey;o_number")).write.options(header=True, sep="\x01", quote="").csv(path)
    schema = StructType([StructField("o_orderkey", LongType()), StructField("o_custkey", LongType())])
    return read_delimited(spark, path, schema, sep=";", malformed="drop")


@register("csv_inferred", "A2", sql="""
SELECT o_orderkey::INTEGER AS o_orderkey, o_custkey::INTEGER AS o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       o_orderkey + 10000000000 AS big, o_orderkey % 2 = 0 AS even,
       'o_orderkey int, o_custkey int, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string, big bigint, even boolean' AS types
FROM orders
""")
def csv_inferred(spark, d):
    """The inferred types themselves: int, bigint, double, timestamp, boolean and text, spelt out in a column; the instant alone is shown without a zone."""
    orders = Tables(spark, d).orders
    path = scratch_path(spark, "csv_inferred")
    day = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("o_orderdate")
    orders.select(*[day if c == "o_orderdate" else F.col(c) for c in orders.columns], (F.col("o_orderkey") + 10_000_000_000).alias("big"),
                  (F.col("o_orderkey") % 2 == 0).alias("even")).write.option("header", True).csv(path)
    back = read_delimited(spark, path, sep=",", infer=True)
    types = ", ".join(f"{name} {kind}" for name, kind in back.dtypes)
    return back.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz")).withColumn("types", F.lit(types))


@register("csv_export", "A8", sql="SELECT * FROM supplier")
def csv_export(spark, d):
    supp = Tables(spark, d).supplier
    path = scratch_path(spark, "csv_export")
    export_csv(supp, path)
    return read_delimited(spark, path, schema=supp.schema, sep=",")


@register("parquet_roundtrip", "A5 A6", sql="""
SELECT *, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders WHERE year(o_orderdate) = 1997
""")
def parquet_roundtrip(spark, d):
    orders = Tables(spark, d).orders
    path = scratch_path(spark, "parquet_roundtrip")
    write_parquet(orders.withColumn("year", F.year("o_orderdate")), path, partition_by=["year"],
                  sort_within=["o_orderkey"])
    # the year filter prunes folders; only year=1997 is listed and read
    return read_parquet(spark, path).where(F.col("year") == 1997)


@register("sorted_export", "F1 A6", sql="SELECT * FROM part")
def sorted_export(spark, d):
    part = Tables(spark, d).part
    path = scratch_path(spark, "sorted_export")
    write_sorted(part, path, ["p_type", "p_partkey"])
    return read_parquet(spark, path)


# ---- incremental ingest (Structured Streaming, availableNow) ----------------------

@register("csv_stream_staging", "A7 A1 A3 (incremental)", sql="SELECT * FROM customer")
def csv_stream_staging(spark, d):
    from skyledger.streaming.staging import stage_stream
    cust = Tables(spark, d).customer
    root = scratch_path(spark, "csv_stream_staging")
    src = f"{root}/incoming"
    # two arrivals, one run after each: the second must only add the new files
    even = F.col("c_custkey") % 2 == 0
    for part in (cust.where(even), cust.where(~even)):
        part.write.option("sep", ";").option("header", True).mode("append").csv(src)
        staged = stage_stream(spark, src, f"{root}/staged", cust.schema, f"{root}/_checkpoint")
    return staged


@register("csv_stream_layouts", "A7 A1 A3 (incremental)", sql="SELECT * FROM orders")
def csv_stream_layouts(spark, d):
    """The layouts of ``csv_layouts`` as arrivals of a stream: reversed columns first, then an extra column in front."""
    from skyledger.streaming.staging import stage_stream
    orders = Tables(spark, d).orders
    root = scratch_path(spark, "csv_stream_layouts")
    even = F.col("o_orderkey") % 2 == 0
    text = [F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) if t.startswith("timestamp") else F.col(c) for c, t in orders.dtypes]
    for part in (orders.where(even).select(*reversed(text)), orders.where(~even).select(F.lit("x;\"y\"").alias("User ID"), *text, F.lit(6.1).alias("Lmg"))):
        part.write.options(header=True, sep=";", escape='"').mode("append").csv(f"{root}/incoming")
        staged = stage_stream(spark, f"{root}/incoming", f"{root}/staged", orders.schema, f"{root}/_checkpoint")
    return staged


def _gazetteer_sql():
    from skyledger.plans.sql_parts import ADDRESSES
    return f"WITH {ADDRESSES.strip()}\nSELECT * FROM gazetteer"


@register("gazetteer_stream", "K12 C8 G3 (incremental)", sql=_gazetteer_sql())
def gazetteer_stream(spark, d):
    from pyspark.sql.types import DoubleType, StructField, StructType

    from skyledger.plans import roles
    from skyledger.streaming.staging import stream_new_locations
    t = Tables(spark, d)
    root = scratch_path(spark, "gazetteer_stream")
    src = f"{root}/sessions"
    # session files arrive over two runs
    places = roles.customer_places(t)
    even = F.floor(F.col("Latitude")) % 2 == 0
    schema = StructType([StructField(c, DoubleType()) for c in ("Latitude", "Longitude", "Elevation")])
    for part in (places.where(even), places.where(~even)):
        part.write.option("sep", ";").option("header", True).mode("append").csv(src)
        grown = stream_new_locations(spark, src, schema, roles.known_locations(t), roles.addresses(t),
                                     f"{root}/gazetteer", f"{root}/_checkpoint")
    return grown
