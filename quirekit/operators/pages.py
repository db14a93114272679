"""Page operators that need Python on a text: rules, tables, notes, layout, long paragraphs, and folds over a book's pages."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirekit.functions import markup
from quirekit.functions.text import TABLE_BLOCK

STRINGS = T.ArrayType(T.StringType())
#: Bytes of texts that are Python objects at a time; a longer text is alone.
PORTION = 1 << 20


def portions(texts: pa.Array, most: int = PORTION) -> Iterator[pa.Array]:
    """The texts of a batch in slices of at most ``most`` bytes, or of one text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64) + np.arange(1, len(texts) + 1)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + most, "right")))
        yield texts.slice(i, j - i)
        i = j


def of_texts(kind: T.DataType, read: Callable[[str | None], object]) -> Callable[[Column], Column]:
    """A column function that has ``read``'s value of each text; a tuple is a row of a struct.

    A batch of Spark's has up to 10,000 texts. It stays in Arrow, and only a portion of it is strings and results, so a worker's
    memory doesn't grow with the batch's rows.
    """

    @F.arrow_udf(kind)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            if not len(texts):
                yield pa.array([], _arrow(kind))
            for part in portions(texts):
                got = [read(t) for t in part.to_pylist()]
                if isinstance(kind, T.StructType):
                    got = [dict(zip(kind.names, row, strict=True)) for row in got]
                yield pa.array(got, _arrow(kind))

    return run


def _or_errors(block: str | None) -> tuple[str | None, str | None]:
    errors, out = markup.read_table(block or "")
    return None if errors else out, "; ".join(errors) or None


def _page_or_error(text: str | None) -> tuple[str | None, str | None]:
    try:
        return markup.sanitized_page(text or ""), None
    except ValueError as e:
        return None, str(e)


HTML_OR_ERROR = T.StructType().add("html", "string").add("error", "string")
PAGE_OR_ERROR = T.StructType().add("md", "string").add("error", "string")
#: What is wrong with a page's text; null counts as empty.
page_errors = of_texts(STRINGS, lambda t: markup.page_errors(t or ""))
#: What is wrong with an HTML table block.
table_errors = of_texts(STRINGS, lambda t: markup.read_table(t or "")[0])
#: The block written anew, or why it can't be.
sanitize_table = of_texts(HTML_OR_ERROR, _or_errors)
#: A page with its tables written anew, or why one can't be.
sanitize_page = of_texts(PAGE_OR_ERROR, _page_or_error)
_extract_notes = of_texts(T.StructType().add("md", "string").add("n_notes", T.IntegerType()), lambda t: markup.extract_notes(t or ""))
#: A section's lines as paragraphs.
reflow = of_texts(T.StringType(), lambda t: markup.reflow(t or ""))
#: English function words between full-width characters put right.
repair_inline = of_texts(T.StructType().add("text", "string").add("n", T.IntegerType()), lambda t: markup.repair_inline(t or ""))
#: Paragraphs with long ones cut after sentence ends.
typeset_paragraphs = of_texts(STRINGS, lambda t: markup.typeset_paragraphs(t or ""))
#: Header of the last table of a page, empty if there is none.
last_header = of_texts(T.StringType(), lambda t: markup.last_header(t or ""))
#: Places of the marks after which a long paragraph may be cut.
sentence_ends = of_texts(T.ArrayType(T.IntegerType()), lambda t: markup.sentence_ends(t or ""))


def split_long(text: Column, most: int = 250, slack: int = 200) -> Column:
    """One paragraph cut after sentence ends; short ones don't go to Python."""
    cut = of_texts(STRINGS, lambda t: None if t is None else markup.split_long(t, most, slack))
    return F.coalesce(cut(F.when(F.length(text) > most + slack, text)), F.array(F.coalesce(text, F.lit(""))))


def extract_notes(pages: DataFrame, text: str = "md") -> DataFrame:
    """Pages with the notes of table cells moved below their tables, and n_notes; pages without a note don't go to Python."""
    may = F.col(text).contains("【") & (F.col(text).contains("|") | F.col(text).rlike(r"(?i)<t[dh]\b"))
    done = _extract_notes(F.when(may, F.col(text)))
    return pages.withColumn("_d", done).withColumn(text, F.when(may, F.col("_d.md")).otherwise(F.col(text))).withColumn("n_notes", F.when(may, F.col("_d.n_notes")).otherwise(0)).drop("_d")


def html_tables(pages: DataFrame, key: list[str], text: str = "md") -> DataFrame:
    """HTML table blocks of pages, numbered from 1."""
    return pages.select(*key, F.posexplode(F.regexp_extract_all(F.col(text), F.lit(TABLE_BLOCK), F.lit(0))).alias("i", "block")).withColumn("table_no", F.col("i") + 1).drop("i")


def fold_pages(pages: DataFrame, book: str, page: str, text: str, extra: list[T.StructField], start: Callable[[], object], step: Callable) -> DataFrame:
    """An ordered fold over the pages of each book: ``step(state, row)`` gives rows; ``row`` None ends a book.

    A book is one task, since a page's result needs the one before; its pages are streamed sorted, so memory holds
    the state and one batch. Parallelism is the number of books.
    """
    rows = pages.select(book, page, text)
    schema = T.StructType([*rows.schema.fields, *extra])
    kind = pa.schema([pa.field(f.name, _arrow(f.dataType)) for f in schema.fields])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, last, out = None, object(), []
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if row[0] != last:
                    out += step(state, None) if state is not None else []
                    state, last = start(), row[0]
                out += step(state, row)
            if len(out) > 500:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kind.types, strict=True)], schema=kind)
                out = []
        out += step(state, None) if state is not None else []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kind.types, strict=True)], schema=kind)

    return rows.repartition(book).sortWithinPartitions(book, page).mapInArrow(fold, schema)


def _arrow(t: T.DataType) -> pa.DataType:
    if isinstance(t, T.StructType):
        return pa.struct([pa.field(f.name, _arrow(f.dataType)) for f in t.fields])
    if isinstance(t, T.ArrayType):
        return pa.list_(_arrow(t.elementType))
    return {"string": pa.string(), "long": pa.int64(), "bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}[t.simpleString()]


def merge_pages(pages: DataFrame, book: str = "book_id", page: str = "page_no", text: str = "md", *, transitive: bool = False) -> DataFrame:
    """Pages of a book with notes and tables joined where they go on over a page break: adds merged_into and kind.

    Each pair of neighbours is handled once, in order, the first as the pair before left it. So a page taken up whole ends a run
    of continuations, and a table over four pages becomes two, unless ``transitive`` keeps the page that took it up as the
    neighbour of the next.
    """

    class State:
        held: list | None = None

    def step(s: State, row: tuple | None) -> list[tuple]:
        if row is None:
            return [tuple(s.held)] if s.held else []
        key, number, md = row
        if s.held is None:
            s.held = [key, number, md or "", None, None]
            return []
        before, after, kinds = markup.merge_pair(s.held[2], md or "")
        s.held[2] = before
        mine = [key, number, after, s.held[1] if kinds else None, ",".join(kinds) or None]
        if transitive and kinds and not after.strip():
            return [tuple(mine)]
        done, s.held = tuple(s.held), mine
        return [done]

    return fold_pages(pages, book, page, text, [T.StructField("merged_into", pages.schema[page].dataType), T.StructField("kind", T.StringType())], State, step)


def merge_gate(pages: DataFrame, failed: DataFrame, book: str = "book_id", page: str = "page_no", text: str = "md") -> DataFrame:
    """What stands against merging a book: rows (book, page, problem) for gaps, failed pages, invalid pages and left marks."""
    ends = pages.groupBy(book).agg(F.min(page).alias("lo"), F.max(page).alias("hi"))
    gap = ends.select(book, F.explode(F.sequence("lo", "hi")).alias(page)).join(pages.select(book, page), [book, page], "left_anti").withColumn("problem", F.lit("missing"))
    bad = pages.where(F.size(page_errors(F.col(text))) > 0).select(book, page, F.lit("invalid").alias("problem"))
    fail = failed.select(book, page, F.lit("failed").alias("problem"))
    marks = pages.where(F.col(text).contains("\U0001f004") | F.col(text).contains("__PROHIBITED_CONTENT__")).select(book, page, F.lit("mark").alias("problem"))
    return gap.unionByName(bad).unionByName(fail).unionByName(marks)
