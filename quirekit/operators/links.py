"""Integrity of packaged books: links, manifest, spine, entry order, chapter names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirekit.functions.text import FIGURE_MARK, REFUSED_MARK

HREF = r"""(?:href|src)\s*=\s*"([^"]*)\""""


def resolve(base: Column, href: Column) -> Column:
    """Path of a link inside the package, from the folder of ``base``; null for empty and outside links."""
    raw = F.trim(href)
    path = F.regexp_extract(raw, r"^[^?#]*", 0)
    outside = raw.rlike("^(https?://|data:|mailto:)") | (path == "")
    folder = F.when(path.startswith("/"), "").otherwise(F.regexp_extract(base, r"^(.*)/[^/]*$", 1))
    parts = F.filter(F.split(F.concat_ws("/", folder, path), "/"), lambda p: ~p.isin("", "."))
    up = lambda a: F.when(F.size(a) > 0, F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0)))).otherwise(a)
    folded = F.aggregate(parts, F.array().cast("array<string>"), lambda a, p: F.when(p == "..", up(a)).otherwise(F.concat(a, F.array(p))))
    return F.when(outside, None).otherwise(F.try_url_decode(F.replace(F.array_join(folded, "/"), F.lit("+"), F.lit("%2B"))))


def page_links(df: DataFrame, key: str, html: str) -> DataFrame:
    """Every link of a page, one row each."""
    return df.select(key, F.explode(F.regexp_extract_all(F.col(html), F.lit(HREF), F.lit(1))).alias("href"))


def unresolved(links: DataFrame, names: DataFrame) -> DataFrame:
    """Links (resolved) that no entry (name) answers."""
    return links.where("resolved is not null").join(names.select(F.col("name").alias("resolved")), "resolved", "left_anti")


def manifest_missing(manifest: DataFrame, entries: DataFrame) -> DataFrame:
    """Manifest items whose file isn't an entry of their book."""
    return manifest.join(entries.select("book", F.col("name").alias("href")), ["book", "href"], "left_anti")


def spine_dangling(spine: DataFrame, manifest: DataFrame) -> DataFrame:
    """Spine references that name no manifest item."""
    return spine.join(manifest.select("book", F.col("id").alias("idref")), ["book", "idref"], "left_anti")


def cover_duplicates(manifest: DataFrame) -> DataFrame:
    """Books with more than one cover item."""
    covers = F.count_if(F.array_contains(F.split(F.coalesce("properties", F.lit("")), " "), "cover-image"))
    return manifest.groupBy("book").agg(covers.alias("covers")).where("covers > 1")


def entry_errors(entries: DataFrame) -> DataFrame:
    """Per book: whether ``mimetype`` comes first, stored and with the right content; counts of entries and left marks."""
    first = F.min(F.struct("ord", "name", "stored", F.trim("content").alias("content")))
    marks = F.sum(F.regexp_count("content", F.lit(f"{FIGURE_MARK}|{REFUSED_MARK}")))
    out = entries.groupBy("book").agg(F.count("*").alias("n_entries"), first.alias("_f"), marks.cast("long").alias("n_marks"))
    good = (F.col("_f.name") == "mimetype") & F.col("_f.stored") & (F.col("_f.content") == "application/epub+zip")
    return out.select("book", "n_entries", good.alias("mimetype_ok"), "n_marks")


def slug(label: Column, most: int = 48) -> Column:
    """A chapter label as a file name stem."""
    tidy = F.regexp_replace(F.regexp_replace(F.coalesce(label, F.lit("")), r'[\\/:*?"<>|#%&\s]+', "-"), r"^[-.]+|[-.]+$", "")
    return F.coalesce(F.nullif(F.substring(tidy, 1, most), F.lit("")), F.lit("chapter"))


def slug_names(labels: DataFrame, most: int = 48) -> DataFrame:
    """Adds ``file``: the label's slug, with -2, -3 … for repeats in order. A repeat whose name another label has is numbered on
    its own base, so names are unique unless a label itself ends in such a number."""
    n = F.row_number().over(Window.partitionBy("book", "_slug").orderBy("ord"))
    out = labels.withColumn("_slug", slug(F.col("label"), most)).withColumn("_n", n)
    return out.withColumn("file", F.concat("_slug", F.when(F.col("_n") > 1, F.concat(F.lit("-"), F.col("_n"))).otherwise(""), F.lit(".xhtml"))).drop("_slug", "_n")
