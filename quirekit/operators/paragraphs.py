"""Splitting books into lines, paragraphs, sections and tables, and packing them."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirekit.functions.text import is_pipe_line, lines, strip


def split_lines(df: DataFrame, text: str = "text", name: str = "line") -> DataFrame:
    """One row a line with its number from 0."""
    return df.select("*", F.posexplode(lines(F.col(text))).alias(f"{name}_no", name)).drop(text)


def split_paragraphs(df: DataFrame, text: str = "text", *, drop_blank: bool = False) -> DataFrame:
    """Paragraphs between blank lines, numbered from 0; with ``drop_blank`` only those with content, numbered anew."""
    parts = F.split(strip(F.regexp_replace(text, "\r\n", "\n")), r"\n\s*\n")
    if drop_blank:
        parts = F.filter(parts, lambda x: strip(x) != "")
    return df.select("*", F.posexplode(parts).alias("para_no", "para")).drop(text)


def sections(df: DataFrame, text: str = "text") -> DataFrame:
    """Sections at level-one headings: section_no from 1, title, body; what stands before the first heading joins section 1.

    Books without a heading have no sections; ``heading_gate`` tells them."""
    pieces = F.split(F.concat(F.lit("\n"), F.regexp_replace(text, "\r\n", "\n")), r"\n(?=#[ \t]+)")
    rows = df.withColumn("_pieces", pieces).where(F.size("_pieces") > 1)
    body = lambda i: F.when(i == 1, F.concat(F.substring(F.col("_pieces")[0], 2, 1 << 30), F.when(F.length(F.col("_pieces")[0]) > 1, "\n").otherwise(""), F.get("_pieces", i))).otherwise(F.get("_pieces", i))
    title = lambda i: strip(F.regexp_extract(F.get("_pieces", i), r"^#[ \t]+([^\n]*)", 1))
    made = F.transform(F.sequence(F.lit(1), F.size("_pieces") - 1), lambda i: F.struct(i.alias("section_no"), title(i).alias("title"), body(i).alias("body")))
    return rows.select("*", F.inline(made)).drop("_pieces", text)


def pipe_tables(df: DataFrame, group: str, text: str = "text") -> DataFrame:
    """Pipe-table blocks, runs of adjacent table lines: start_line from 1 and rows (lines in order)."""
    rows = split_lines(df, text).where(is_pipe_line(F.col("line")))
    island = F.col("line_no") - F.row_number().over(Window.partitionBy(group).orderBy("line_no"))
    ordered = F.array_sort(F.collect_list(F.struct("line_no", "line")))
    blocks = rows.withColumn("_island", island).groupBy(group, "_island").agg(ordered.alias("_rows"))
    return blocks.select(group, (F.col("_rows")[0]["line_no"] + 1).alias("start_line"), F.transform("_rows", lambda r: r["line"]).alias("rows"))


LONGS = T.ArrayType(T.LongType())


class Chains:
    """Greedy packing of a run of units for every state in which it may be entered.

    A run is entered with ``used`` characters in an open chunk. All that ``used`` decides is which unit is the first to begin a
    chunk; each unit that may be it starts a chain of chunks, and chains that begin a chunk at the same unit are one from there.
    """

    def __init__(self, most: int, gap: int) -> None:
        self.most, self.gap, self.total = most, gap, 0
        self.reach: list[int] = []  # running size at each possible first unit
        self.chain: list[int] = []  # chain of each possible first unit, and chunks it has begun more than its chain
        self.more: list[int] = []
        self.used: dict[int, int] = {}
        self.begun: dict[int, int] = {}

    def add(self, n: int) -> None:
        over = [c for c, u in self.used.items() if u + self.gap + n > self.most]
        for c in self.used:
            self.used[c] += self.gap + n
        into = over[0] if over else None
        for c in over[1:]:  # they begin a chunk here as well
            lag = self.begun[c] - self.begun[into]
            self.chain = [into if x == c else x for x in self.chain] if lag == 0 else self._moved(c, into, lag)
            del self.used[c], self.begun[c]
        if into is not None:
            self.used[into], self.begun[into] = n, self.begun[into] + 1
        if self.total <= self.most:  # this unit may be the first to begin a chunk
            self.reach.append(self.total + self.gap + n)
            if into is None:
                into = len(self.chain)
                self.used[into], self.begun[into] = n, 1
            self.chain.append(into)
            self.more.append(1 - self.begun[into])
        self.total += self.gap + n

    def _moved(self, c: int, into: int, lag: int) -> list[int]:
        self.more = [m + lag if x == c else m for x, m in zip(self.chain, self.more, strict=True)]
        return [into if x == c else x for x in self.chain]

    def result(self) -> tuple[list[int], list[int], list[int], int]:
        """For each possible first unit: running size there, chunks begun and used at the end; and the size of all units."""
        return self.reach, [self.begun[c] + m for c, m in zip(self.chain, self.more, strict=True)], [self.used[c] for c in self.chain], self.total


def entered(used: int | None, reach: list[int], begun: list[int], left: list[int], total: int, most: int) -> tuple[int, int]:
    """Chunks that a run begins and ``used`` at its end, if it is entered with ``used`` (None: nothing is open, at a book's start)."""
    first = 0 if used is None else bisect_right(reach, most - used)
    return (begun[first], left[first]) if first < len(reach) else (0, (used or 0) + total)


def pack_greedily(units: DataFrame, book: str, order: list[str], size: str, most: int, gap: int = 2, *, runs: int | None = None) -> DataFrame:
    """Adds chunk_no (from 1): units of a book in order fill a chunk while its size, with ``gap`` between units, is within ``most``.

    A unit over the limit makes a chunk of its own. The rule looks back at all earlier units of the book, so books are cut into
    ``runs`` runs by equal ranges of the first order column, if that is a number: each run is packed for all states it can be
    entered in, the states are passed on over the few runs of a book, and then each run is numbered from its own. So the work
    on a long book is spread over tasks; rows are streamed in order, and a task holds two numbers, or one for each unit of a chunk.
    """
    kind = units.schema[order[0]].dataType
    if isinstance(kind, T.NumericType):
        runs = runs or int(units.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        ends = units.agg(F.min(order[0]).cast("double").alias("a"), F.max(order[0]).cast("double").alias("b")).first()
        width = max(ends.b - ends.a, 1.0) / runs if ends.a is not None else 1.0
        run = F.coalesce(F.floor((F.col(order[0]).cast("double") - F.lit(ends.a or 0.0)) / width).cast("int"), F.lit(0))
    else:
        run = F.lit(0)
    rows = units.withColumn("_run", run)
    ordered = lambda df, *first: df.repartition(book, "_run").sortWithinPartitions(book, "_run", *first, *order)
    key = units.schema[book].dataType
    ways = T.StructType().add("book", key).add("run", T.IntegerType()).add("reach", LONGS).add("begun", LONGS).add("left", LONGS).add("total", T.LongType())

    def explore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, chains, kind = None, None, None
        made = lambda: pa.RecordBatch.from_arrays([pa.array([at[0]], kind), pa.array([at[1]], pa.int32()), *(pa.array([x], pa.list_(pa.int64())) for x in chains.result()[:3]), pa.array([chains.total], pa.int64())], names=ways.names)
        for b in batches:
            kind = b.schema.types[0]
            for k, r, n in zip(*(c.to_pylist() for c in b.columns[:3]), strict=True):
                if chains is None or (k, r) != at:
                    if chains is not None:
                        yield made()
                    at, chains = (k, r), Chains(most, gap)
                chains.add(n)
        if chains is not None:
            yield made()

    def pass_on(pdf: pd.DataFrame) -> pd.DataFrame:
        used, chunk, out = None, 0, []
        for r in pdf.sort_values("run").itertuples():
            out.append((r.book, r.run, -1 if used is None else used, chunk))
            more, used = entered(used, list(r.reach), list(r.begun), list(r.left), r.total, most)
            chunk += more
        return pd.DataFrame(out, columns=["book", "run", "used", "chunk"])

    found = ordered(rows.select(book, "_run", size, *[c for c in order if c not in (book, size)])).mapInArrow(explore, ways)
    state = found.groupBy("book").applyInPandas(pass_on, T.StructType().add("book", key).add("run", T.IntegerType()).add("used", T.LongType()).add("chunk", T.LongType()))
    heads = state.select(F.col("book").alias(book), F.col("run").alias("_run"), F.lit(True).alias("_head"), F.col("used").alias("_used"), F.col("chunk").alias("_chunk"))
    both = rows.withColumn("_head", F.lit(False)).unionByName(heads, allowMissingColumns=True)
    names, kept = both.columns, [*units.columns, "chunk_no"]
    head, held, used_at, chunk_at = (names.index(c) for c in ("_head", size, "_used", "_chunk"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used, chunk = -1, 0
        for b in batches:
            numbers = []
            for is_head, n, u, c in zip(*(b.column(i).to_pylist() for i in (head, held, used_at, chunk_at)), strict=True):
                if is_head:
                    used, chunk = u, c
                elif used >= 0 and used + gap + n <= most:
                    used += gap + n
                else:
                    chunk, used = chunk + 1, n
                numbers.append(chunk)
            whole = pa.RecordBatch.from_arrays([*b.columns, pa.array(numbers, pa.int64())], names=[*names, "chunk_no"])
            yield whole.filter(pc.invert(b.column(head))).select(kept)

    out = T.StructType([*units.schema.fields, T.StructField("chunk_no", T.LongType())])
    return ordered(both, F.desc("_head")).mapInArrow(number, out)


def batch_number(number: Column, size: int = 5) -> Column:
    """Number of the batch of ``size`` that a unit falls in."""
    return F.floor(number / size).cast("long")


def ordered_text(df: DataFrame, book: str, order: str, text: str, between: str = "\n\n") -> DataFrame:
    """The texts of a book in order, joined; a book must fit in one row."""
    return df.groupBy(book).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda x: x[text]), between).alias(text))
