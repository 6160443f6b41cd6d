"""File names, dates and request parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The prefix of forecast files, their two name formats, and the suffixes of pyramid folders.
PREFIX = "ldas_fcst_"
WORD_FORMAT = r"(?i)^ldas_fcst_(\d{4}_[a-z]{3}\d{2})\.nc$"
DIGIT_FORMAT = r"(?i)^ldas_fcst_(\d{8})\.nc$"
STEM_MARKS = ("_tercile_probability_max_", "_tercile_prob_max_")


def init_date(name: Column) -> Column:
    """The date in a forecast file's name (``..._2024_dec01.nc`` or ``..._20241201.nc``); NULL if there is none, or no such day."""
    word = F.regexp_replace(F.regexp_extract(name, WORD_FORMAT, 1), r"^(\d{4})_(\w{3})(\d{2})$", "$1-$2-$3")
    digits = F.regexp_extract(name, DIGIT_FORMAT, 1)
    month = F.array_position(F.array(*[F.lit(m) for m in ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")]), F.lower(F.substring(word, 6, 3)))
    number = F.when(month > 0, F.concat(F.substring(word, 1, 4), F.lpad(month.cast("string"), 2, "0"), F.substring(word, 10, 2)))
    return F.coalesce(F.try_to_date(number, "yyyyMMdd"), F.try_to_date(F.nullif(digits, F.lit("")), "yyyyMMdd"))


def required_init_date(name: Column) -> Column:
    """:func:`init_date`, or an error that names the file."""
    return F.coalesce(init_date(name), F.raise_error(F.concat(F.lit("no forecast file name: "), name)).cast("date"))


def init_tag(date: Column) -> Column:
    """A date's tag, as 2026_apr."""
    return F.lower(F.date_format(date, "yyyy_MMM"))


def iso(time: Column) -> Column:
    """A time to the second, as 2026-04-30T00:00:00."""
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss")


def cache_key(*parts: Column) -> Column:
    """The MD5 of the parts joined by underscores."""
    return F.md5(F.concat_ws("_", *[p.cast("string") for p in parts]).cast("binary"))


def stale(name: Column, tag: Column) -> Column:
    """Whether a folder entry belongs to another run: it lacks the tag and is no JSON file."""
    return ~F.contains(name, tag) & ~F.endswith(name, F.lit(".json"))


def resolved_times(requests: DataFrame, times: DataFrame, request: str = "request") -> DataFrame:
    """``requests(request)`` with time_idx, or an error text, against ``times(time_idx, time)``.

    A number is an index as it is; else an exact ISO time; else the first ten characters are a day
    that must have exactly one time.  Quotes and spaces around a request are ignored.
    """
    text = F.regexp_replace(F.trim(F.col(request)), "^['\"]+|['\"]+$", "")
    asked = requests.select(request, text.alias("_text")).distinct()
    known = times.select("time_idx", iso(F.col("time")).alias("_iso"))
    days = known.groupBy(F.substring("_iso", 1, 10).alias("_day")).agg(F.count("*").alias("_n"), F.min("time_idx").alias("_of_day"))
    exact = known.groupBy("_iso").agg(F.min("time_idx").alias("_exact"))
    listed = known.agg(F.array_join(F.array_sort(F.collect_set(F.substring("_iso", 1, 10))), ", ").alias("_days"))
    number = F.when(F.col("_text").rlike(r"^-*\d+$"), F.expr("try_cast(_text AS int)"))
    joined = (
        asked.join(exact, F.col("_text") == F.col("_iso"), "left")
        .join(days, F.substring("_text", 1, 10) == F.col("_day"), "left")
        .crossJoin(F.broadcast(listed))
    )
    index = F.coalesce(number, F.col("_exact"), F.when(F.col("_n") == 1, F.col("_of_day")))
    problem = F.when(index.isNotNull(), None).when(F.col("_n") > 1, F.concat(F.lit("ambiguous day: "), "_text")).otherwise(F.concat(F.lit("unknown time: "), F.col("_text"), F.lit("; days: "), "_days"))
    return joined.select(request, index.cast("int").alias("time_idx"), problem.alias("error"))


def stems(requests: DataFrame, folders: DataFrame, init: str | None, variable: str = "variable") -> DataFrame:
    """``requests(variable)`` with the stem of its pyramid.

    A name with ``_tercile_`` is a stem itself; else the first folder name (in text order) that ends in a
    known suffix; else the stem of the run ``init``; NULL if there is none.
    """
    own = F.when(F.contains(F.col(variable), F.lit("_tercile_")), F.col(variable))
    marked = folders.select("name", F.explode(F.array(*[F.lit(m) for m in STEM_MARKS])).alias("_mark")).where(F.contains(F.col("name"), F.col("_mark")))
    # everything after the mark is the variable's name, so this is an equi-join
    known = marked.select("name", F.expr("substring(name, instr(name, _mark) + length(_mark))").alias("_v")).groupBy("_v").agg(F.min("name").alias("_found"))
    fallback = F.concat(F.lit(f"{init}_tercile_prob_max_"), F.col(variable)) if init else F.lit(None).cast("string")
    return requests.join(known, F.col(variable) == F.col("_v"), "left").select(variable, F.coalesce(own, "_found", fallback).alias("stem"))
