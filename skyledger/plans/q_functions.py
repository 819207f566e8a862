"""Registry: column functions on whole test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyledger.functions.calendar import parse_timestamp
from skyledger.functions.casts import text_to_int
from skyledger.functions.geo import haversine_km
from skyledger.functions.text import (VALID_PLACE_PATTERN, collapse_spaces, default_if_blank, first_present, normalize_name,
                                      normalize_text_trim, nth_piece, strip_accents, transliterate, valid_or_unknown, with_normalized)
from skyledger.operators.lookup import maybe_broadcast
from skyledger.operators.nearby import nearest_place
from skyledger.plans.registry import register
from skyledger.plans.tables import Tables


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_transliterate(expr: str) -> str:
    """Accents off by DuckDB's own rule, and the Latin letters that have none to take off (those that the test tables may hold)."""
    e = f"strip_accents({expr})"
    for k, v in (("ß", "ss"), ("ẞ", "SS"), ("æ", "ae"), ("Æ", "AE"), ("œ", "oe"), ("Œ", "OE"), ("ø", "o"), ("Ø", "O")):
        e = f"replace({e}, '{k}', '{v}')"
    return e


def sql_initcap(expr: str) -> str:
    """Upper first letter after a space, rest lower (DuckDB has no initcap)."""
    return f"array_to_string(list_transform(string_split(lower({expr}), ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ')"


@register("cast_chain", "B4", sql="""
SELECT event_id, CAST(trunc(CAST(CAST(value AS VARCHAR) AS DOUBLE)) AS INTEGER) AS code
FROM events
""")
def cast_chain(spark, d):
    e = Tables(spark, d).events
    return e.select("event_id", text_to_int(F.col("value").cast("string")).alias("code"))


@register("validate_text", "B9", sql=f"""
SELECT doc_id,
  CASE WHEN regexp_matches(lang, {_sql_str(VALID_PLACE_PATTERN)}) THEN lang ELSE 'Unknown' END AS lang_valid,
  CASE WHEN regexp_matches(source, {_sql_str(VALID_PLACE_PATTERN)}) THEN source ELSE 'Unknown' END AS source_valid,
  CASE WHEN regexp_matches(text, {_sql_str(VALID_PLACE_PATTERN)}) THEN text ELSE 'Unknown' END AS text_valid
FROM documents
""")
def validate_text(spark, d):
    docs = Tables(spark, d).documents
    return docs.select("doc_id", valid_or_unknown("lang").alias("lang_valid"),
                       valid_or_unknown("source").alias("source_valid"), valid_or_unknown("text").alias("text_valid"))


@register("default_fill", "B10 H15 H16", sql="""
WITH c AS (
  SELECT c_custkey,
         nullif(c_mktsegment, 'BUILDING') AS city,
         CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN '' ELSE c_name END AS town,
         c_name
  FROM customer)
SELECT c_custkey,
       coalesce(nullif(town, ''), nullif(city, ''), 'Unknown') AS place,
       CASE WHEN town IS NULL OR town = '' THEN 'Unknown' ELSE town END AS town_filled,
       upper(substring(lower(c_name), 1, 8)) AS code
FROM c
""")
def default_fill(spark, d):
    c = Tables(spark, d).customer.select(
        "c_custkey", "c_name",
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("city"),
        F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), F.lit("")).otherwise(F.col("c_name")).alias("town"))
    return c.select("c_custkey", first_present("town", "city").alias("place"),
                    default_if_blank("town", "Unknown").alias("town_filled"),
                    F.upper(F.substring(F.lower(F.col("c_name")), 1, 8)).alias("code"))


@register("strip_accents", "I1", sql="""
SELECT doc_id, strip_accents(text) AS text FROM documents
""")
def strip_accents_q(spark, d):
    docs = Tables(spark, d).documents
    return docs.select("doc_id", strip_accents("text").alias("text"))


@register("normalize_text", "H9 H10 H19 I1", sql=f"""
SELECT doc_id, text AS raw_text,
       regexp_replace({sql_initcap(sql_transliterate('text'))}, '\\s+', ' ', 'g') AS text
FROM documents
""")
def normalize_text(spark, d):
    docs = Tables(spark, d).documents.select("doc_id", "text")
    out = with_normalized(docs, "text", normalize_name)
    return out.select("doc_id", "raw_text", "text")


_CASED_RE = r"\p{Lu}\p{Ll}\p{Lt}"


@register("normalize_text_trim", "H11", sql=f"""
WITH n AS (
  SELECT doc_id, trim(regexp_replace(lower({sql_transliterate('text')}), '[\\s\\x{{0B}}\\x{{85}}\\p{{Z}}]+', ' ', 'g')) AS s
  FROM documents)
SELECT doc_id, coalesce(array_to_string(list_transform(
         regexp_extract_all(s, '[{_CASED_RE}]+|[^{_CASED_RE}]'), lambda t: upper(t[1]) || t[2:]), ''), 'Unknown') AS text
FROM n
""")
def normalize_text_trim_q(spark, d):
    docs = Tables(spark, d).documents
    return docs.select("doc_id", normalize_text_trim("text").alias("text"))


# Ten letters of a script each, in place of the digits 0 to 9 of a name, and how they are read.
_READINGS = {
    "han": ("零一二三四五六七八九", ["Ling ", "Yi ", "Er ", "San ", "Si ", "Wu ", "Liu ", "Qi ", "Ba ", "Jiu "]),
    "hangul": ("영일이삼사오육칠팔구", ["yeong", "il", "i", "sam", "sa", "o", "yug", "chil", "pal", "gu"]),
    "kana": ("あいうえおかきくけこ", ["a", "i", "u", "e", "o", "ka", "ki", "ku", "ke", "ko"]),
    "cyrillic": ("бвгджзклмщ", ["b", "v", "g", "d", "zh", "z", "k", "l", "m", "shch"]),
    "georgian": ("აბგდევზილმ", ["a", "b", "g", "d", "e", "v", "z", "i", "l", "m"]),
    "arabic": ("بتدرسفكلمن", ["b", "t", "d", "r", "s", "f", "k", "l", "m", "n"]),
    "devanagari": ("कगजतदनपबमस", ["ka", "ga", "ja", "ta", "da", "na", "pa", "ba", "ma", "sa"]),
}


def _read_out(letters: list[str]) -> str:
    """DuckDB: a name with each digit replaced by its reading."""
    e = "c_name"
    for i, reading in enumerate(letters):
        e = f"replace({e}, '{i}', '{reading}')"
    return e


@register("romanise_scripts", "I1 H9 (other scripts)", sql="SELECT c_custkey, " + ", ".join(f"{_read_out(r)} AS {k}" for k, (_, r) in _READINGS.items()) + " FROM customer")
def romanise_scripts(spark, d):
    """Customer names whose digits are written in seven scripts, romanised."""
    # a file with few row groups is few tasks: the names are dealt out before the work
    c = Tables(spark, d).customer.select("c_custkey", "c_name").repartition("c_custkey")
    return c.select("c_custkey", *[transliterate(F.translate("c_name", "0123456789", letters)).alias(k) for k, (letters, _) in _READINGS.items()])


@register("split_name", "H8", sql="""
SELECT 'part' AS src, p_partkey AS k, string_split(p_name, ' ')[1] AS first_piece,
       string_split(p_name, ' ')[2] AS second_piece FROM part
UNION ALL
SELECT 'nation', CAST(n_nationkey AS BIGINT), string_split(n_name, ' ')[1], string_split(n_name, ' ')[2] FROM nation
""")
def split_name(spark, d):
    t = Tables(spark, d)
    p = t.part.select(F.lit("part").alias("src"), F.col("p_partkey").alias("k"), F.col("p_name").alias("name"))
    n = t.nation.select(F.lit("nation").alias("src"), F.col("n_nationkey").cast("long").alias("k"),
                        F.col("n_name").alias("name"))
    both = p.unionByName(n)
    return both.select("src", "k", nth_piece("name", " ", 0).alias("first_piece"),
                       nth_piece("name", " ", 1).alias("second_piece"))


@register("parse_ts", "H12 H13", sql="""
SELECT event_id, date_trunc('second', ts) AS start_date FROM events
""")
def parse_ts(spark, d):
    e = Tables(spark, d).events
    quoted = F.concat(F.lit('"'), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit('"'))
    return e.select("event_id", parse_timestamp(quoted).alias("start_date"))


@register("haversine", "H14", sql="""
SELECT n.n_nationkey,
  round(6371.0 * 2 * atan2(
    sqrt(pow(sin(radians((r.r_regionkey * 15.0 - 30) - (n.n_nationkey * 3.5 - 40)) / 2), 2)
       + cos(radians(n.n_nationkey * 3.5 - 40)) * cos(radians(r.r_regionkey * 15.0 - 30))
         * pow(sin(radians((r.r_regionkey * 30.0 - 60) - (n.n_nationkey * 7.0 - 80)) / 2), 2)),
    sqrt(1 - (pow(sin(radians((r.r_regionkey * 15.0 - 30) - (n.n_nationkey * 3.5 - 40)) / 2), 2)
       + cos(radians(n.n_nationkey * 3.5 - 40)) * cos(radians(r.r_regionkey * 15.0 - 30))
         * pow(sin(radians((r.r_regionkey * 30.0 - 60) - (n.n_nationkey * 7.0 - 80)) / 2), 2)))), 6) AS distance_km
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
""")
def haversine(spark, d):
    t = Tables(spark, d)
    n, r = t.nation, maybe_broadcast(t.region)
    j = n.join(r, n["n_regionkey"] == r["r_regionkey"])
    dist = haversine_km(F.col("n_nationkey") * 3.5 - 40, F.col("n_nationkey") * 7.0 - 80,
                        F.col("r_regionkey") * 15.0 - 30, F.col("r_regionkey") * 30.0 - 60)
    return j.select("n_nationkey", F.round(dist, 6).alias("distance_km"))


_NEAR_KM = 400.0
_POINT = "(c_custkey * 7919 % 18001) / 100.0 - 90 AS lat, (c_custkey * 104729 % 36001) / 100.0 - 180 AS lon"
_PLACE = "(s_suppkey * 7907 % 18001) / 100.0 - 90 AS plat, (s_suppkey * 15485863 % 36001) / 100.0 - 180 AS plon"
_CHORD = "least(1.0, pow(sin(radians(plat - lat) / 2), 2) + cos(radians(lat)) * cos(radians(plat)) * pow(sin(radians(plon - lon) / 2), 2))"


@register("nearest_place", "H14 K12 C4 (radius)", sql=f"""
WITH points AS (SELECT DISTINCT CAST(lat AS DOUBLE) AS lat, CAST(lon AS DOUBLE) AS lon FROM (SELECT {_POINT} FROM customer)),
places AS (SELECT DISTINCT CAST(plat AS DOUBLE) AS plat, CAST(plon AS DOUBLE) AS plon FROM (SELECT {_PLACE} FROM supplier)),
pairs AS (SELECT *, 6371.0 * 2 * atan2(sqrt({_CHORD}), sqrt(1 - {_CHORD})) AS km FROM points, places)
SELECT lat AS "Latitude", lon AS "Longitude", round(min(km), 6) AS distance_km FROM pairs GROUP BY lat, lon HAVING min(km) <= {_NEAR_KM}
""")
def nearest_place_q(spark, d):
    """Points all over the globe and the nearest of other points within 400 km, against all pairs."""
    t = Tables(spark, d)
    def degrees(k, a, b):
        return [((F.col(k) * m % n) / 100.0 - o).cast("double").alias(c) for m, n, o, c in ((a, 18001, 90, "Latitude"), (b, 36001, 180, "Longitude"))]
    found = nearest_place(t.customer.select(*degrees("c_custkey", 7919, 104729)), t.supplier.select(*degrees("s_suppkey", 7907, 15485863)), _NEAR_KM)
    return found.select("Latitude", "Longitude", F.round("distance_km", 6).alias("distance_km"))


# ---- dirty input, made from the tables by rule --------------------------------------

@register("casts_dirty", "B4 H12 (bad values)", sql="""
SELECT event_id,
  CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(trunc(value) AS INTEGER) END AS code,
  CASE WHEN event_id % 7 IN (0, 1, 2) THEN NULL ELSE date_trunc('second', ts) END AS start_date
FROM events
""")
def casts_dirty(spark, d):
    e = Tables(spark, d).events
    k, ts = F.col("event_id"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    number = F.when(k % 10 == 0, F.lit("")).when(k % 10 == 5, F.concat(F.lit("n"), F.col("value").cast("string"))).otherwise(F.col("value").cast("string"))
    text = F.when(k % 7 == 0, F.lit("2024-13-45 00:00:00")).when(k % 7 == 1, F.lit("")).when(k % 7 == 2, F.lit(None)).otherwise(ts)
    return e.select("event_id", text_to_int(number).alias("code"), parse_timestamp(text).alias("start_date"))


@register("collapse_dirty", "H10 (white space runs)", sql="""
SELECT doc_id, regexp_replace(replace(replace(text, ' ', CASE WHEN doc_id % 2 = 0 THEN '  ' ELSE ' ' || chr(9) || ' ' END), chr(10), chr(10) || chr(10)), '\\s+', ' ', 'g') AS text
FROM documents
""")
def collapse_dirty(spark, d):
    docs = Tables(spark, d).documents
    gap = F.when(F.col("doc_id") % 2 == 0, F.lit("  ")).otherwise(F.lit(" \t "))
    dirty = F.replace(F.replace(F.col("text"), F.lit(" "), gap), F.lit("\n"), F.lit("\n\n"))
    return docs.select("doc_id", collapse_spaces(dirty).alias("text"))
