"""Checks of bilingual output against its source, and the bilingual merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirekit.functions.text import is_heading, lines, normal_content, strip

SEPARATOR = r"^\s*---\s*$"


def blocks(df: DataFrame, key: str, text: str = "output") -> DataFrame:
    """Blocks of an output between separator lines: block_no from 1, kept (non-blank lines), closed (ends in a separator)."""
    rows = df.select(key, F.posexplode(lines(F.coalesce(text, F.lit("")))).alias("line_no", "line")).withColumn("sep", F.col("line").rlike(SEPARATOR))
    before = F.coalesce(F.sum(F.col("sep").cast("int")).over(Window.partitionBy(key).orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    kept = F.when(~F.col("sep") & (strip("line") != ""), F.struct("line_no", "line"))
    got = rows.withColumn("block_no", before + 1).groupBy(key, "block_no").agg(F.max("sep").alias("closed"), F.array_sort(F.collect_list(kept)).alias("_k"))
    return got.select(key, F.col("block_no").cast("int").alias("block_no"), "closed", F.transform("_k", lambda x: x["line"]).alias("kept"))


def block_structure(df: DataFrame, key: str, text: str = "output") -> DataFrame:
    """Per output: sep_count, first_bad_block (of other than two lines; null if none), bad_lines, dangling, has_blank."""
    b = blocks(df, key, text)
    n = F.size("kept")
    bad = F.min(F.when(F.col("closed") & (n != 2), F.struct("block_no", n.alias("n"))))
    out = b.groupBy(key).agg(F.count_if("closed").alias("sep_count"), bad.alias("_b"), F.coalesce(F.max(~F.col("closed") & (n > 0)), F.lit(False)).alias("dangling"))
    # a last line that is empty is the end of the text, not a blank line
    body = F.regexp_replace(F.coalesce(text, F.lit("")), r"\n$", "")
    blank = df.select(key, F.exists(lines(body), lambda x: strip(x) == "").alias("has_blank"))
    return out.join(blank, key).select(key, "sep_count", F.col("_b.block_no").alias("first_bad_block"), F.col("_b.n").alias("bad_lines"), "dangling", "has_blank")


def structure_details(df: DataFrame, key: str, expected: str, text: str = "output", most: int = 5) -> DataFrame:
    """What is wrong with the blocks of each output, the first ``most`` findings in order: detail_no, kind, block_no, n_lines, from_para, to_para.

    A block of an even number of lines over two holds several paragraphs (merged), one of fewer than two lacks a line (short),
    any other is split wrongly (split). A total other than ``expected`` is the last finding (too_few, too_many).
    """
    b = blocks(df, key, text).where("closed").select(key, "block_no", F.size("kept").alias("n_lines"))
    n = F.col("n_lines")
    held = F.when(n == 0, 0).when(n % 2 == 0, n / 2).otherwise(1).cast("int")
    before = Window.partitionBy(key).orderBy("block_no").rowsBetween(Window.unboundedPreceding, -1)
    b = b.withColumn("from_para", (F.coalesce(F.sum(held).over(before), F.lit(0)) + 1).cast("int"))
    merged = (n > 2) & (n % 2 == 0)
    bad = b.where(n != 2).select(key, F.when(merged, "merged").when(n < 2, "short").otherwise("split").alias("kind"), "block_no", "n_lines", F.when(merged, F.col("from_para")).alias("from_para"), F.when(merged, F.col("from_para") + (n / 2).cast("int") - 1).alias("to_para"))
    count = F.regexp_count(F.coalesce(text, F.lit("")), F.lit("(?m)" + SEPARATOR))
    total = df.withColumn("_n", count).where(F.col("_n") != F.col(expected)).select(key, F.when(F.col("_n") < F.col(expected), "too_few").otherwise("too_many").alias("kind"), F.lit(None).cast("int").alias("block_no"), F.col("_n").alias("n_lines"), *[F.lit(None).cast("int").alias(c) for c in ("from_para", "to_para")])
    number = F.row_number().over(Window.partitionBy(key).orderBy(F.col("block_no").asc_nulls_last()))
    return bad.unionByName(total).withColumn("detail_no", number).where(F.col("detail_no") <= most)


def retry_feedback(output: Column, reasons: Column) -> Column:
    """What is added to a request that is made again: the refused output and the numbered reasons; empty without either."""
    out = strip(F.coalesce(output, F.lit("")))
    said = F.filter(F.transform(F.coalesce(reasons, F.array().cast("array<string>")), lambda x: strip(x)), lambda x: x != "")
    listed = F.array_join(F.transform(said, lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x)), "\n")
    parts = F.array_compact(F.array(F.lit("The last output was refused:"), F.nullif(out, F.lit("")), F.when(F.size(said) > 0, F.concat(F.lit("Reasons:\n"), listed)), F.lit("Give two lines for each paragraph, source and > target, then ---, without blank lines.")))
    return F.when((out == "") & (F.size(said) == 0), "").otherwise(F.array_join(parts, "\n"))


def looks_merged(out: Column, first: Column, second: Column) -> Column:
    """Whether an output holds two expected paragraphs, punctuation and spaces apart."""
    o, a, b = normal_content(out), normal_content(first), normal_content(second)
    return (o != "") & (a != "") & (b != "") & o.contains(a) & o.contains(b)


def source_fidelity(expected: DataFrame, made: DataFrame, key: str) -> DataFrame:
    """Status of each expected paragraph: ok, merged (with the next one), mismatch or missing.

    ``expected``: key, para_no, para. ``made``: key, para_no, source."""
    ahead = expected.withColumn("_next", F.lead("para").over(Window.partitionBy(key).orderBy("para_no")))
    both = ahead.join(made.select(key, "para_no", "source", F.lit(True).alias("_made")), [key, "para_no"], "left")
    same = normal_content(F.col("source")) == normal_content(F.col("para"))
    merged = F.col("_next").isNotNull() & looks_merged(F.col("source"), F.col("para"), F.col("_next"))
    status = F.when(F.col("_made").isNull(), "missing").when(same, "ok").when(merged, "merged").otherwise("mismatch")
    return both.select(key, "para_no", status.alias("status"))


def heading_errors(expected: DataFrame, made: DataFrame, key: str) -> DataFrame:
    """Heading paragraphs whose source line lost its mark or whose translation has one (source_lost, target_has)."""
    both = expected.where(is_heading(F.col("para"))).join(made, [key, "para_no"])
    out = both.select(key, "para_no", (~is_heading(F.col("source"))).alias("source_lost"), is_heading(F.col("target"), quoted=True).alias("target_has"))
    return out.where("source_lost or target_has")


def swap_headings(c: Column) -> Column:
    """A heading followed by its quoted translation: the translation becomes the heading, the source the quote; pairs go left to right."""
    pair = r"(?m)^([ \t]*)(#{1,6})[ \t]+([^\n]+)\n([ \t]*)>[ \t]*([^\n]+)$"
    return F.regexp_replace(c, pair, "$1$2 $5\n$4> $3")


def blank_before_quotes(c: Column) -> Column:
    """One blank line before a quote line that follows a non-blank line that isn't one."""
    quoted = lambda x: F.ltrim(x).startswith(">")
    start = F.struct(F.lit(None).cast("string").alias("last"), F.array().cast("array<string>").alias("out"))

    def step(a: Column, x: Column) -> Column:
        add = quoted(x) & a["last"].isNotNull() & (a["last"] != "") & ~quoted(a["last"])
        return F.struct(x.alias("last"), F.concat(a["out"], F.when(add, F.array(F.lit(""), x)).otherwise(F.array(x))).alias("out"))

    return F.array_join(F.aggregate(lines(c), start, step, lambda a: a["out"]), "\n")


def blank_around_dividers(c: Column) -> Column:
    """Divider lines with a blank line before (unless they are first) and after."""
    body = F.regexp_replace(c, r"\n$", "")
    start = F.struct(F.lit(False).alias("due"), F.array().cast("array<string>").alias("out"))

    def step(a: Column, x: Column) -> Column:
        divider = F.trim(x) == "---"
        owed = F.when(a["due"] & (x != ""), F.concat(a["out"], F.array(F.lit("")))).otherwise(a["out"])
        lead = F.when(divider & (F.size(owed) > 0) & (F.element_at(F.concat(F.array(F.lit("")), owed), -1) != ""), F.concat(owed, F.array(F.lit("")))).otherwise(owed)
        return F.struct(divider.alias("due"), F.concat(lead, F.array(x)).alias("out"))

    done = F.aggregate(lines(body), start, step, lambda a: F.when(a["due"], F.concat(a["out"], F.array(F.lit("")))).otherwise(a["out"]))
    return F.concat(F.array_join(done, "\n"), F.when(c.endswith("\n"), "\n").otherwise(""))
