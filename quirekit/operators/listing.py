"""Listings of page folders as tables of names: what belongs to a run, in which order, and what stands in its way."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirekit.functions.text import number_key

IMAGE_SUFFIXES = ("jpg", "jpeg", "png", "bmp", "tif", "tiff", "webp")
#: Number of a file whose name doesn't begin with one (fixed value).
UNNUMBERED = 10**9


def suffix(name: Column) -> Column:
    """Lower-case extension, empty if there is none."""
    return F.lower(F.regexp_extract(name, r"\.([^./]+)$", 1))


def numeric_stem(name: Column) -> Column:
    """Value of a stem of digits, else null."""
    return F.regexp_extract(name, r"^([0-9]+)(?:\.[^.]*)?$", 1).try_cast("long")


def leading_number(name: Column) -> Column:
    """Value of the digits before the first dot, UNNUMBERED if the name doesn't begin with such."""
    return F.coalesce(F.regexp_extract(name, r"^([0-9]+)\.", 1).try_cast("long"), F.lit(UNNUMBERED))


def image_listing(files: DataFrame, first: int | None = None, last: int | None = None) -> DataFrame:
    """Image files (column name) with page_no, in natural order; with a range only pages in it. FileNotFoundError if none is left."""
    out = files.where(suffix(F.col("name")).isin(*IMAGE_SUFFIXES)).withColumn("page_no", numeric_stem(F.col("name")))
    if first is not None:
        out = out.where(F.col("page_no") >= first)
    if last is not None:
        out = out.where(F.col("page_no") <= last)
    if out.isEmpty():
        raise FileNotFoundError("no page image in the range")
    return out.orderBy(*number_key(F.col("name")))


def numeric_pages(files: DataFrame, suffixes: tuple[str, ...] = ("md",)) -> DataFrame:
    """Files of the suffixes whose stem is a number, with page_no."""
    return files.where(suffix(F.col("name")).isin(*suffixes)).withColumn("page_no", numeric_stem(F.col("name"))).where("page_no is not null")


def numbered_markdown(files: DataFrame) -> DataFrame:
    """Section files: a number without leading zero, a title and ``.md``; adds section_no."""
    return files.where(F.col("name").rlike(r"^[1-9][0-9]*\..*\.md$")).withColumn("section_no", leading_number(F.col("name")))


def result_files(files: DataFrame) -> DataFrame:
    """Text files whose name begins with digits; adds file_no."""
    number = F.regexp_extract("name", r"^([0-9]+)", 1).try_cast("long")
    return files.where(suffix(F.col("name")) == "md").withColumn("file_no", number).where("file_no is not null")


def range_errors(first: Column, last: Column, count: Column) -> Column:
    """What is wrong with an inclusive page range of a document of ``count`` pages; empty if nothing."""
    rules = {"first page below 0": first < 0, "last page before the first": last < first, "last page beyond the document": last >= count}
    return F.array_compact(F.array(*[F.when(bad, e) for e, bad in rules.items()]))


def stale_images(files: DataFrame, expected: DataFrame) -> DataFrame:
    """Numbered images that a full render wouldn't write (``expected``: page_no): left from another run."""
    return image_pages(files).join(expected.select(F.col("page_no").cast("long").alias("page_no")), "page_no", "left_anti")


def image_pages(files: DataFrame) -> DataFrame:
    """Images whose stem is a number, with page_no."""
    return numeric_pages(files, IMAGE_SUFFIXES)


def highest_output(files: DataFrame) -> DataFrame:
    """Highest number among outputs ``N.md`` and ``N.fail.md``, -1 if there is none."""
    return files.agg(F.coalesce(F.max(F.regexp_extract("name", r"^([0-9]+)(?:\.fail)?\.md$", 1).try_cast("long")), F.lit(-1)).alias("highest"))


def heading_gate(books: DataFrame, book: str = "book_id", text: str = "md") -> DataFrame:
    """Headings of level one of each book and whether it may be packaged: it needs one at least."""
    count = F.regexp_count(text, F.lit(r"(?m)^# "))
    return books.select(book, count.alias("n_h1"), (count > 0).alias("ok"))
