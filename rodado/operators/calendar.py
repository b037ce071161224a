"""Occurrences of event series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Week days as numbers, Monday 0.
DAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")


def recurrences(series: DataFrame) -> DataFrame:
    """(series_id, date) of weekly and biweekly series in their season, both ends included.

    series: (series_id, recurrence, recurrence_day, season_start, season_end, skip_dates array<date>). The first date
    is the first such week day from the season's start; a biweekly series counts from there. Skipped dates are left
    out; other recurrences, missing days and reversed seasons give nothing.
    """
    day = F.array_position(F.array(*map(F.lit, DAYS)), F.lower(F.trim("recurrence_day"))) - 1
    first = F.date_add("season_start", F.pmod(day.cast("int") - F.weekday("season_start"), F.lit(7)))
    gap = F.when(F.col("recurrence") == "weekly", 7).when(F.col("recurrence") == "biweekly", 14)
    s = series.withColumns({"_first": first, "_gap": gap}).where((day >= 0) & F.col("_gap").isNotNull() & (F.col("_first") <= F.col("season_end")))
    weeks = F.floor(F.date_diff("season_end", "_first") / F.col("_gap")).cast("int")
    dates = F.transform(F.sequence(F.lit(0), weeks), lambda k: F.date_add(F.col("_first"), k * F.col("_gap")))
    kept = F.array_except(dates, F.coalesce("skip_dates", F.array().cast("array<date>")))
    return s.select("series_id", F.explode(kept).alias("date"))


def scheduled(series: DataFrame) -> DataFrame:
    """(series_id, date, ...) of explicit schedules: series has (series_id, schedule array<struct<date,...>>)."""
    return series.select("series_id", F.explode("schedule").alias("_o")).select("series_id", "_o.*").where("date is not null")


def with_overrides(dates: DataFrame, overrides: DataFrame, series: DataFrame, fields: list[str]) -> DataFrame:
    """Each occurrence with ``fields`` from its override, else from its series, and cancelled (false by default).

    overrides: (series_id, date, cancelled, fields...), the first by field order if a date has several. An override
    of a date outside the cadence adds nothing.
    """
    o = overrides.groupBy("series_id", "date").agg(F.max("cancelled").alias("cancelled"), *(F.min(f).alias(f"_{f}") for f in fields))
    base = series.select("series_id", *fields)
    j = dates.join(o, ["series_id", "date"], "left").join(base, "series_id")
    return j.select("series_id", "date", *(F.coalesce(f"_{f}", f).alias(f) for f in fields), F.coalesce("cancelled", F.lit(False)).alias("cancelled"))


def merge_duplicates(events: DataFrame, key: list[str], slug: str, date: str) -> DataFrame:
    """One row for events of equal (trimmed) key: the slug of the earliest, its date, the last date, the number."""
    t = events.select(*(F.trim(F.col(k)).alias(k) for k in key), slug, date)
    return t.groupBy(*key).agg(
        F.min_by(slug, F.struct(date, slug)).alias(slug), F.min(date).alias("first_date"), F.max(date).alias("end_date"), F.count("*").alias("occurrences")
    )


def once_per_uid(events: DataFrame, uid: str, newest: str) -> DataFrame:
    """The newest row of each uid; rows without one all stay."""
    n = F.row_number().over(Window.partitionBy(uid).orderBy(F.col(newest).desc()))
    known = events.where(F.col(uid).isNotNull()).withColumn("_n", n).where("_n = 1").drop("_n")
    return known.unionByName(events.where(F.col(uid).isNull()))


def minutes(hhmm):
    """Minutes since midnight of 'HH:MM'; null for anything else, hours may pass 24."""
    m = F.regexp_extract(hhmm, r"^(\d{1,3}):([0-5]\d)$", 1)
    return F.when(m != "", m.cast("int") * 60 + F.regexp_extract(hhmm, r"^(\d{1,3}):([0-5]\d)$", 2).cast("int"))


def ranked_results(results: DataFrame, by: str, time: str, limit_minutes: str) -> DataFrame:
    """Adds minutes, in_time and place (null for results without a time or over the limit)."""
    r = results.withColumn("minutes", minutes(F.col(time)))
    r = r.withColumn("in_time", F.coalesce(F.col("minutes") <= F.col(limit_minutes), F.lit(False)))
    return r.withColumn("place", F.when(F.col("in_time"), F.rank().over(Window.partitionBy(by, "in_time").orderBy("minutes"))))
