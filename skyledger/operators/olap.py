"""OLAP building blocks and the five warehouse questions (Q1-Q5).

Blocks: slice + roll-up sum (B6, D1, D8, F2), histogram weighted mean with a
group filter (D3, D4, H17), drill-across on a conformed grain (C11) and a
pivot over a fixed value list (D5).

Drill-across is computed without the row-level fan-out: each side is first
aggregated to the conformed grain (left: sum of the measure; right: rows per
group value, or one row per value for the conformed variant), the two small
tables are joined on the grain, and ``sum(left_sum * right_rows)`` is exactly
the sum the row-level join would produce.  A hot grain collapses to one row
per side before any shuffle, so skew cannot pile up in the join.

Sums and means of floating point measures are exact (``functions/exact.py``): they do not depend on the order of rows,
tasks or files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions._util import as_col
from skyledger.functions.calendar import key_in_month, key_in_month_of_years, key_in_year
from skyledger.functions.exact import exact_mean, exact_sum, fixed_point, rounded_ratio, shown, type_of
from skyledger.operators.dims import CLOCK_BOUND
from skyledger.operators.lookup import maybe_broadcast
from skyledger.sources.schemas import MAGNITUDE_BINS


def rollup_sum(df: DataFrame, by: Sequence, measure, alias: str, digits: int | None = None,
               descending: bool = True) -> DataFrame:
    """``group by`` a dimension level, sum a measure, order by the sum."""
    c = as_col(measure)
    out = df.groupBy(*by).agg(exact_sum(c, type_of(df, c), digits).alias(alias))
    # group columns break ties: a deterministic total order
    return out.orderBy(F.col(alias).desc() if descending else F.col(alias), *[as_col(b) for b in by])


def mean_by(df: DataFrame, by: Sequence, measure, alias: str, digits: int = 2) -> DataFrame:
    """Average per group, rounded half away from zero."""
    c = as_col(measure)
    return df.groupBy(*by).agg(exact_mean(c, type_of(df, c), digits).alias(alias))


def histogram_terms(bins: Sequence[tuple[str, int]]) -> tuple[Column, Column]:
    """(sum of count*value, sum of counts) over the bin columns of one row (D3).

    A null cell makes the row's terms null, so the row drops out of both
    sums, as plain SQL arithmetic does (S19).
    """
    weighted = None
    total = None
    for name, value in bins:
        c = F.col(name)
        weighted = c * F.lit(value) if weighted is None else weighted + c * F.lit(value)
        total = c if total is None else total + c
    return weighted, total


def weighted_mean_by(df: DataFrame, by: Sequence, bins: Sequence[tuple[str, int]], alias: str,
                     min_total: float | None = None, digits: int = 2) -> DataFrame:
    """Σ(count·value)/Σ(count) per group, null on a zero total, groups with total > min_total."""
    weighted, total = histogram_terms(bins)
    agg = df.groupBy(*by).agg(F.sum(fixed_point(weighted, type_of(df, weighted))).alias("__w"), F.sum(fixed_point(total, type_of(df, total))).alias("__t"))
    if min_total is not None:
        agg = agg.where(F.col("__t") > F.lit(min_total))
    out = agg.select(*[as_col(b) for b in by],
                     rounded_ratio(F.col("__w"), F.col("__t"), digits).alias(alias))
    return out.orderBy(F.col(alias).desc_nulls_last(), *[as_col(b) for b in by])


def drill_across(left: DataFrame, right: DataFrame, grain: Sequence[str], group: str, measure: str,
                 alias: str, conformed: bool = False, digits: int | None = None,
                 group_filter: Column | None = None, right_rows: str | None = None) -> DataFrame:
    """Sum the left measure by a right attribute over matching grain.

    ``left`` has the grain columns and ``measure``; ``right`` has the grain
    columns and ``group``.  Plain mode equals the row-level join then sum
    (fan-out included, S8); ``conformed=True`` counts each right value once
    per grain.  ``right_rows`` names a column with the rows that a row of an
    already summed ``right`` stands for.
    """
    g = list(grain)
    kind = type_of(left, F.col(measure))
    lsum = (left.where(F.col(measure).isNotNull())
            .groupBy(*g).agg(F.sum(fixed_point(F.col(measure), kind)).alias("__lsum")))
    r = right.where(group_filter) if group_filter is not None else right
    if conformed:
        rcnt = r.select(*g, group).distinct().withColumn("__rcnt", F.lit(1).cast("long"))
    else:
        rcnt = r.groupBy(*g, group).agg((F.sum(right_rows) if right_rows else F.count(F.lit(1))).alias("__rcnt"))
    joined = lsum.join(rcnt, g)
    return joined.groupBy(group).agg(shown(F.sum(F.col("__lsum") * F.col("__rcnt")), kind, digits).alias(alias))


def pivot_sum(df: DataFrame, pivot_col: str, values: Sequence[str], measure: str,
              by: Sequence[str] = (), digits: int | None = None) -> DataFrame:
    """One column per listed value holding the sum of ``measure``.

    The value list is given, so no job is spent finding the values; a listed
    value with no rows gives null.
    """
    kind = type_of(df, F.col(measure))
    out = df.groupBy(*by).pivot(pivot_col, list(values)).agg(F.sum(fixed_point(F.col(measure), kind)))
    return out.select(*by, *[shown(F.col(f"`{v}`"), kind, digits).alias(v) for v in values])


# ---- the five questions on the warehouse tables -----------------------------------

def _year_partition(fact: DataFrame, year: int) -> DataFrame:
    """Add a partition-column filter when the fact was written ``partitionBy("year")``."""
    return fact.where(F.col("year") == year) if "year" in fact.columns else fact


def q1_meteors_in_month(fact_observations: DataFrame, dim_shower: DataFrame, shower: str = "QUA",
                        month: int = 1, dim_date: DataFrame | None = None) -> DataFrame:
    """Meteors of one shower counted in a month of any year (slice, roll-up).

    With ``dim_date`` the month slice is also written as one key range per
    year present in the calendar (a bounded list), which the Parquet reader
    uses to skip row groups of other months.
    """
    d = maybe_broadcast(dim_shower.where(F.col("IAU_code") == shower).select("sk_shower", "IAU_code"))
    f = fact_observations.where(key_in_month("fk_start_date", month))
    if dim_date is not None:
        # one range a year between the first and the last of the dimension, which the scan can use; a fact of another
        # year is looked at row by row, so none depends on the dimension's years
        r = dim_date.where(F.col("year") > 0).agg(F.min("year").alias("first"), F.max("year").alias("last")).first()
        if r["first"] is not None:
            key = F.col("fk_start_date")
            f = f.where(key_in_month_of_years("fk_start_date", month, list(range(r["first"], r["last"] + 1)))
                        | (key < r["first"] * 10000) | (key >= (r["last"] + 1) * 10000))
    j = f.join(d, f["fk_shower"] == d["sk_shower"])
    return rollup_sum(j.withColumnRenamed("IAU_code", "Shower"), ["Shower"], "cnt_meteor", "meteors_counted")


def q2_meteors_by_precipitation(fact_observations: DataFrame, dim_time: DataFrame, dim_local: DataFrame,
                                fact_weather: DataFrame, conformed: bool = False) -> DataFrame:
    """Meteors by the precipitation of the same hour and place (drill-across, S8, S9)."""
    t = maybe_broadcast(dim_time.select("sk_time", "hour"), bound_rows=CLOCK_BOUND + 1)
    loc = maybe_broadcast(dim_local.select("sk_local", "latitude", "longitude"))
    # sums on the facts' own keys first; the dimensions join what is left
    obs = fact_observations.groupBy("fk_start_date", "fk_start_time", "fk_local").agg(F.sum("cnt_meteor").alias("cnt_meteor"))
    obs = (obs.join(t, obs["fk_start_time"] == t["sk_time"]).join(loc, obs["fk_local"] == loc["sk_local"])
           .select(F.col("fk_start_date").alias("date"), "hour", "latitude", "longitude", "cnt_meteor"))
    wx = fact_weather.where(F.col("precipitation").isNotNull()).groupBy("fk_date", "fk_time", "fk_local", "precipitation").agg(F.count(F.lit(1)).alias("rows"))
    wx = (wx.join(t, wx["fk_time"] == t["sk_time"]).join(loc, wx["fk_local"] == loc["sk_local"])
          .select(F.col("fk_date").alias("date"), "hour", "latitude", "longitude", "precipitation", "rows"))
    out = drill_across(obs, wx, ["date", "hour", "latitude", "longitude"], "precipitation", "cnt_meteor",
                       "meteors_counted", conformed=conformed, right_rows="rows")
    return out.orderBy("precipitation")


def q3_magnitude_mean_by_shower(fact_magnitude: DataFrame, dim_shower: DataFrame, year: int = 2022,
                                min_total: float = 50) -> DataFrame:
    """Mean magnitude per shower in one year, showers with more than ``min_total`` meteors."""
    d = maybe_broadcast(dim_shower.select("sk_shower", F.col("IAU_code").alias("Meteor_Shower")))
    f = _year_partition(fact_magnitude, year).where(key_in_year("fk_start_date", year))
    j = f.join(d, f["fk_shower"] == d["sk_shower"])
    bins = [(name, value) for _, name, value in MAGNITUDE_BINS]
    return weighted_mean_by(j, ["Meteor_Shower"], bins, "magnitude_mean", min_total=min_total)


# The weather types pivoted by the fourth question, as the code table spells them.
Q4_WEATHER_TYPES = ["Clear sky", "Overcast", "Mainly clear", "Drizzle (light intensity)",
                    "Drizzle (moderate intensity)", "Rain (slight intensity)", "Rain (moderate intensity)"]


def q4_meteors_by_weather_type(fact_observations: DataFrame, dim_time: DataFrame, fact_weather: DataFrame,
                               dim_weather_code: DataFrame, year: int = 2022,
                               types: Sequence[str] = tuple(Q4_WEATHER_TYPES)) -> DataFrame:
    """Meteors per weather type in one year, one column per type (drill-across, pivot)."""
    t = maybe_broadcast(dim_time.select("sk_time", "hour"), bound_rows=CLOCK_BOUND + 1)
    codes = maybe_broadcast(dim_weather_code.select("sk_weather_code", F.col("description").alias("weather_type")))
    obs = (_year_partition(fact_observations, year).where(key_in_year("fk_start_date", year))
           .join(t, F.col("fk_start_time") == t["sk_time"])
           .select("fk_local", F.col("fk_start_date").alias("fk_date"), "hour", "cnt_meteor"))
    wx = (_year_partition(fact_weather, year).where(key_in_year("fk_date", year))
          .join(t, F.col("fk_time") == t["sk_time"])
          .join(codes, F.col("fk_weather_code") == codes["sk_weather_code"])
          .select("fk_local", "fk_date", "hour", "weather_type"))
    per_type = drill_across(obs, wx, ["fk_local", "fk_date", "hour"], "weather_type", "cnt_meteor",
                            "meteor_count", group_filter=F.col("weather_type").isin(list(types)))
    return pivot_sum(per_type, "weather_type", types, "meteor_count")


def q5_temperature_by_month(fact_weather: DataFrame, dim_time: DataFrame, dim_date: DataFrame,
                            first_hour: int = 6, last_hour: int = 8) -> DataFrame:
    """Mean temperature per month name over the hours ``first_hour..last_hour`` (roll-up, slice)."""
    t = maybe_broadcast(dim_time.where(F.col("hour").between(first_hour, last_hour)).select("sk_time"),
                        bound_rows=CLOCK_BOUND + 1)
    d = maybe_broadcast(dim_date.select("pk_date", F.col("month_name").alias("month")))
    j = (fact_weather.join(t, fact_weather["fk_time"] == t["sk_time"])
         .join(d, fact_weather["fk_date"] == d["pk_date"]))
    return mean_by(j, ["month"], "temperature_2m", "mean_temperature")
