"""Figures and files that page texts name, and names inside packaged books."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIGURE_TOKEN = "\U0001f004️?\\s*([^\\s]+\\.(?:jpg|jpeg|png|webp))"


def materialize_figures(pages: DataFrame, files: DataFrame, book: str = "book_id", page: str = "page_no", text: str = "md") -> DataFrame:
    """Figure tokens whose file exists as image links; others stay. Adds ``fallback``: a full-page image stood in.

    ``files``: book, name, path, priority (smallest wins), full_page. The names are looked up by join; a page gets the
    replacements of its own tokens only, as one array.
    """
    named = pages.select(book, page, F.explode(F.array_distinct(F.regexp_extract_all(F.col(text), F.lit(FIGURE_TOKEN), F.lit(1)))).alias("name"))
    best = files.groupBy(book, "name").agg(F.min_by(F.struct("path", "full_page"), "priority").alias("f"))
    found = named.join(best, [book, "name"]).groupBy(book, page).agg(F.sort_array(F.collect_list(F.struct("name", "f.path", "f.full_page")), asc=False).alias("_f"))
    link = lambda f: F.concat(F.lit("![]("), f["path"], F.lit(")"))
    put = lambda t, f: F.regexp_replace(t, F.concat(F.lit("\U0001f004️?\\s*\\Q"), f["name"], F.lit("\\E")), F.regexp_replace(link(f), r"([\\$])", r"\\$1"))
    out = pages.join(found, [book, page], "left")
    done = F.aggregate(F.coalesce("_f", F.array().cast("array<struct<name:string,path:string,full_page:boolean>>")), F.col(text), put)
    return out.withColumn(text, done).withColumn("fallback", F.coalesce(F.exists("_f", lambda f: f["full_page"]), F.lit(False))).drop("_f")


def number_tokens(text: Column, names: Column) -> Column:
    """The i-th figure token becomes the i-th name; tokens beyond the names stay."""
    parts = F.split(text, FIGURE_TOKEN.replace("(", "(?:", 1))
    tokens = F.regexp_extract_all(text, F.lit(FIGURE_TOKEN), F.lit(0))
    between = F.transform(tokens, lambda t, i: F.coalesce(F.concat(F.lit("\U0001f004️ "), F.get(names, i)), t))
    return F.array_join(F.flatten(F.zip_with(parts, between, lambda p, t: F.filter(F.array(p, t), lambda x: x.isNotNull()))), "")


def rename_entries(entries: DataFrame, names: DataFrame) -> DataFrame:
    """Entries of a package under new names, and the links to them in text entries rewritten at once.

    ``names``: book, old, new (base names). Each link is looked up by its own old name, so a new name that equals another
    old one isn't renamed twice.
    """
    mapping = names.groupBy("book").agg(F.map_from_entries(F.collect_list(F.struct("old", "new"))).alias("_m"))
    both = entries.join(mapping, "book", "left")
    base = F.regexp_extract("name", "[^/]*$", 0)
    moved = F.concat(F.regexp_extract("name", "^(.*/)?", 0), F.coalesce(F.try_element_at("_m", base), base))
    pieces = F.regexp_extract_all("content", F.lit(r'(?s)((?:href|src)\s*=\s*"(?:[^"#?]*/)?)([^"/#?]+)|(.)'), F.lit(0))
    split = lambda p: F.concat(F.regexp_extract(p, r'(?s)^((?:href|src)\s*=\s*"(?:[^"#?]*/)?)?', 0), F.coalesce(F.try_element_at("_m", F.regexp_extract(p, r'([^"/#?]+)$', 1)), F.regexp_extract(p, r'([^"/#?]+)$', 1)))
    rewritten = F.array_join(F.transform(pieces, lambda p: F.when(p.rlike(r'^(?:href|src)\s*='), split(p)).otherwise(p)), "")
    return both.withColumn("content", F.when(F.col("content").isNull() | F.col("_m").isNull(), F.col("content")).otherwise(rewritten)).withColumn("name", moved).drop("_m")
