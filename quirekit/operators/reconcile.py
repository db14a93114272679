"""Reconciling page inputs, outputs and sidecars: coverage, staleness, gaps, progress, resume."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def missing(wanted: DataFrame, present: DataFrame, key: str | list[str]) -> DataFrame:
    """Rows of ``wanted`` without one of equal key in ``present``."""
    return wanted.join(present, key, "left_anti")


def coverage_report(images: DataFrame, outputs: DataFrame, key: str) -> DataFrame:
    """Counts of inputs, outputs, missing and extra ones in one row; ok if nothing is missing or extra."""
    sides = images.select(key, F.lit(1).alias("i"), F.lit(0).alias("o")).unionAll(outputs.select(key, F.lit(0).alias("i"), F.lit(1).alias("o")))
    per = sides.groupBy(key).agg(F.max("i").alias("i"), F.max("o").alias("o"))
    count = lambda c, name: F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0)).alias(name)
    i, o = F.col("i") == 1, F.col("o") == 1
    out = per.agg(count(i, "n_images"), count(o, "n_outputs"), count(i & ~o, "n_missing"), count(o & ~i, "n_extra"))
    return out.withColumn("ok", (F.col("n_missing") == 0) & (F.col("n_extra") == 0))


def stale_reasons(pages: DataFrame) -> DataFrame:
    """Adds booleans and the ordered list of what doesn't fit: status, image, prompt, output hash.

    ``pages``: status, image_sha, meta_image_sha, prompt_sha, meta_prompt_sha, output_sha, meta_output_sha. The image is
    compared only where there is one, the prompt only where its hash is known.
    """
    differs = lambda now, then: F.coalesce(~now.eqNullSafe(then), F.lit(True))
    checks = {
        "status": ~F.col("status").eqNullSafe(F.lit("ok")),
        "image": F.col("image_sha").isNotNull() & differs(F.col("image_sha"), F.col("meta_image_sha")),
        "prompt": F.col("prompt_sha").isNotNull() & differs(F.col("prompt_sha"), F.col("meta_prompt_sha")),
        "output": differs(F.col("output_sha"), F.col("meta_output_sha")),
    }
    out = pages.withColumns({f"{k}_mismatch": c for k, c in checks.items()})
    return out.withColumn("reasons", F.array_compact(F.array(*[F.when(F.col(f"{k}_mismatch"), k) for k in checks])))


def is_valid(structure_errors: Column, trust_existing: bool = False) -> Column:
    """A page is valid if its text isn't empty, its sidecar fits (see ``stale_reasons``) and its structure has no errors."""
    fits = (F.size("reasons") == 0) & F.col("validated").eqNullSafe(F.lit(True))
    if trust_existing:
        fits = fits | F.col("status").isNull()
    return (F.length(F.coalesce("text", F.lit(""))) > 0) & fits & ~structure_errors


def gaps(units: DataFrame, group: str, number: str) -> DataFrame:
    """Numbers between the first and last of each group that are missing."""
    ends = units.groupBy(group).agg(F.min(number).alias("lo"), F.max(number).alias("hi"))
    every = ends.select(group, F.explode(F.sequence("lo", "hi")).alias(number))
    return missing(every, units.select(group, number), [group, number])


def recent_intervals(times: DataFrame, group: str, at: str, *, last: int = 20, under: float = 3600.0) -> DataFrame:
    """Median of the last ``last`` intervals in seconds between 0 and ``under``, by group: n_intervals, median_seconds."""
    micros = F.unix_micros(F.col(at).cast("timestamp"))
    order = Window.partitionBy(group).orderBy("_t")
    steps = times.select(group, micros.alias("_t")).withColumn("_d", (F.col("_t") - F.lag("_t").over(order)) / 1e6)
    used = steps.where((F.col("_d") > 0) & (F.col("_d") < under))
    recent = used.withColumn("_r", F.row_number().over(Window.partitionBy(group).orderBy(F.desc("_t")))).where(F.col("_r") <= last)
    return recent.groupBy(group).agg(F.count("*").alias("n_intervals"), F.median("_d").alias("median_seconds"))


def eta_seconds(median_seconds: Column, remaining: Column, buffer: float = 1.15) -> Column:
    """Seconds until the remaining units are done."""
    return median_seconds * remaining * F.lit(buffer)


def resume_state(outputs: DataFrame, totals: DataFrame, group: str) -> DataFrame:
    """Where to go on: in the highest output if it isn't complete, else at the next one.

    ``outputs``: group, index, done. ``totals``: group, index, total. Returns max_idx, done, total, next_idx, next_para.
    """
    top = outputs.groupBy(group).agg(F.max(F.struct("index", "done")).alias("m")).select(group, F.col("m.index").alias("max_idx"), F.col("m.done").alias("done"))
    both = top.join(totals.withColumnRenamed("index", "max_idx"), [group, "max_idx"], "left").withColumn("total", F.coalesce("total", F.lit(0)))
    inside = F.col("done") < F.col("total")
    return both.withColumn("next_idx", F.when(inside, F.col("max_idx")).otherwise(F.col("max_idx") + 1)).withColumn("next_para", F.when(inside, F.col("done")).otherwise(0))


def unprocessed(pages: DataFrame, done: DataFrame, key: list[str]) -> DataFrame:
    """Pages whose key, hashes included, has no finished output: what a rerun has to do."""
    return missing(pages, done, key)
