"""A book of pages as one text: gate, cleaning, joining over page breaks, figures, order; and the validation of a book's outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirekit.functions.text import FIGURE_MARK, clean_page, strip, strip_page_numbers
from quirekit.operators import assets, pages, paragraphs
from quirekit.operators.reconcile import missing, stale_reasons

SUP_BLOCK = r"(?is)<sup>.*?</sup>"


def rough_text(book_pages: DataFrame, failed: DataFrame, files: DataFrame, *, allow_missing: bool = False, join_tables: bool = True, figures: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Texts of books (book_id, md), their reports, and what stood against them (book_id, page_no, problem).

    ``book_pages``: book_id, page_no, md. ``files``: see ``materialize_figures``. A book with problems isn't merged unless
    ``allow_missing``; then they are warnings. The report has n_pages, first_page, last_page, n_joined and n_problems.
    """
    problems = pages.merge_gate(book_pages, failed)
    cleaned = book_pages.withColumn("md", clean_page(F.col("md")))
    merged = pages.merge_pages(cleaned) if join_tables else cleaned.withColumn("kind", F.lit(None).cast("string"))
    done = assets.materialize_figures(merged, files) if figures else merged
    left = done.where(F.col("md").contains(FIGURE_MARK)).select("book_id", "page_no", F.lit("figure without file").alias("problem"))
    problems = problems.where("problem <> 'mark'").unionByName(left)
    kept = done if allow_missing else missing(done, problems.select("book_id").distinct(), "book_id")
    text = paragraphs.ordered_text(kept.where("md <> ''"), "book_id", "page_no", "md")
    text = text.withColumn("md", F.concat(F.regexp_replace("md", r"\s+$", ""), F.lit("\n")))
    n_joined = F.count_if(F.col("kind").isNotNull()).alias("n_joined")
    report = kept.groupBy("book_id").agg(F.count("*").alias("n_pages"), F.min("page_no").alias("first_page"), F.max("page_no").alias("last_page"), n_joined)
    counts = problems.groupBy("book_id").agg(F.count("*").alias("n_problems"))
    return text, report.join(counts, "book_id", "left").na.fill(0, ["n_problems"]), problems


def book_findings(images: DataFrame, outputs: DataFrame, metas: DataFrame, others: DataFrame, *, prompt_sha: str | None = None) -> DataFrame:
    """Everything that keeps a book from being valid: rows (finding, page_no, detail); none means valid.

    ``images``: page_no, sha256. ``outputs``: page_no, md, output_sha256. ``metas``: page_no, status, validated and the three
    hashes. ``others``: name of files beside the pages, of which failures and partial texts count. The findings are missing,
    extra, invalid, stale, no metadata, failed and partial; the counts of images and outputs are the caller's.
    """
    row = lambda df, finding, detail=None: df.select(F.lit(finding).alias("finding"), F.col("page_no").cast("long").alias("page_no"), (F.lit(None).cast("string") if detail is None else detail).alias("detail"))
    out = row(missing(images, outputs.select("page_no"), "page_no"), "missing").unionByName(row(missing(outputs, images.select("page_no"), "page_no"), "extra"))
    out = out.unionByName(row(missing(outputs, metas.select("page_no"), "page_no"), "no metadata"))
    bad = outputs.select("page_no", F.explode(pages.page_errors(F.col("md"))).alias("e"))
    out = out.unionByName(row(bad, "invalid", F.col("e")))
    known = outputs.join(metas.select("page_no", "status", "validated", F.col("image_sha256").alias("meta_image_sha"), F.col("prompt_sha256").alias("meta_prompt_sha"), F.col("output_sha256").alias("meta_output_sha")), "page_no")
    known = known.join(images.select("page_no", F.col("sha256").alias("image_sha")), "page_no", "left").withColumn("prompt_sha", F.lit(prompt_sha).cast("string")).withColumnRenamed("output_sha256", "output_sha")
    known = known.withColumn("status", F.when(F.col("validated").eqNullSafe(F.lit(True)), F.col("status")))
    out = out.unionByName(row(stale_reasons(known).where(F.size("reasons") > 0), "stale", F.array_join("reasons", ",")))
    number = F.regexp_extract("name", r"^([0-9]+)\.", 1).try_cast("long")
    for ending, finding in ((".fail.json", "failed"), (".partial.md", "partial")):
        out = out.unionByName(row(others.where(F.col("name").endswith(ending)).withColumn("page_no", number), finding, F.col("name")))
    return out


def cleanup(c: Column) -> Column:
    """Lines inside a raised note as one line, then page numbers out; prose is never taken for a repeat."""
    notes = F.regexp_extract_all(c, F.lit(SUP_BLOCK), F.lit(0))
    between = F.split(c, SUP_BLOCK)
    joined = lambda x: F.array_join(F.filter(F.transform(F.split(x, "\n"), lambda y: strip(y)), lambda y: y != ""), " ")
    flat = F.transform(notes, lambda x: F.regexp_replace(F.regexp_replace(joined(x), r"(?i)^<sup>\s+", "<sup>"), r"(?i)\s+</sup>$", "</sup>"))
    return strip_page_numbers(F.array_join(F.flatten(F.zip_with(between, flat, lambda a, b: F.filter(F.array(a, b), lambda x: x.isNotNull()))), ""))


def typeset(books: DataFrame, *, repair: bool = False) -> DataFrame:
    """Books (book_id, md) split at their headings, each section cleaned and set in paragraphs, and put together again."""
    parts = paragraphs.sections(books, "md").withColumn("md", pages.reflow(cleanup(F.col("body"))))
    return final_text(parts, repair=repair)


def final_text(sections: DataFrame, order: str = "section_no", text: str = "md", *, repair: bool = False) -> DataFrame:
    """Sections of a book in order as one text (book_id, md), with function words put right between wide characters if ``repair``."""
    rows = sections.withColumn(text, pages.repair_inline(F.col(text))["text"]) if repair else sections
    out = paragraphs.ordered_text(rows.withColumn(text, strip(F.col(text))).where(F.col(text) != ""), "book_id", order, text)
    return out.withColumn(text, F.concat(text, F.lit("\n")))
