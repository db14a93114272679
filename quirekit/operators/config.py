"""Settings of provider profiles from several places, and checks of a run's settings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirekit.functions.text import lines, strip

#: Places of settings; the first that has a value wins. Fields that a usable profile needs.
PRECEDENCE = ("named", "section", "legacy")
FIELDS = ("base_url", "api_key", "model")


def profile_name(c: Column) -> Column:
    """Letters, digits and underscores; other runs as one underscore, none at the ends."""
    return F.regexp_replace(F.regexp_replace(strip(F.coalesce(c, F.lit(""))), "[^A-Za-z0-9_]+", "_"), "^_+|_+$", "")


def secrets(df: DataFrame, text: str = "text") -> DataFrame:
    """Settings of a secrets text: profile (``default`` before any section), key, value without quotes."""
    rows = df.select(F.posexplode(lines(F.col(text))).alias("i", "line"))
    name = F.regexp_extract("line", r"^\s*\[([^\]]+)\]\s*$", 1)
    section = F.last(F.nullif(profile_name(name), F.lit("")), True).over(Window.orderBy("i").rowsBetween(Window.unboundedPreceding, 0))
    pair = r"""^\s*([A-Za-z_]\w*)\s*=\s*["']?(.*?)["']?\s*$"""
    out = rows.select(F.coalesce(section, F.lit("default")).alias("profile"), F.lower(F.regexp_extract("line", pair, 1)).alias("key"), F.regexp_extract("line", pair, 2).alias("value"))
    return out.where("key <> '' and key <> 'profiles'")


def profiles(settings: DataFrame) -> DataFrame:
    """One row a profile with base_url, api_key, model and usable, from settings (profile, place, key, value).

    A field's value is that of the first place in PRECEDENCE which has one that isn't empty."""
    rank = F.array_position(F.array(*map(F.lit, PRECEDENCE)), F.col("place"))
    known = settings.where(strip(F.coalesce("value", F.lit(""))) != "").where(rank > 0)
    value = lambda k: F.coalesce(F.min_by(F.when(F.col("key") == k, strip(F.col("value"))), F.when(F.col("key") == k, rank)), F.lit(""))
    out = known.groupBy(profile_name(F.col("profile")).alias("profile")).agg(*[value(k).alias(k) for k in FIELDS])
    return out.withColumn("usable", F.greatest(*[(F.col(k) == "").cast("int") for k in FIELDS]) == 0)


def listed(df: DataFrame) -> DataFrame:
    """Profiles for display: no key, only whether there is one."""
    return df.select("profile", "base_url", "model", (F.col("api_key") != "").alias("has_key"), "usable")


def setting_errors(max_tokens: Column, jpeg_quality: Column) -> Column:
    """What is wrong with a run's settings."""
    rules = {"max_tokens below 256": max_tokens < 256, "jpeg_quality not in 1 to 100": ~jpeg_quality.between(1, 100)}
    return F.array_compact(F.array(*[F.when(bad, e) for e, bad in rules.items()]))


def prompt_or(text: Column, default: str) -> Column:
    """A prompt without outer white space, or the default if that leaves nothing."""
    return F.coalesce(F.nullif(strip(F.coalesce(text, F.lit(""))), F.lit("")), F.lit(default))
