"""Stage status of books, and translation in batches by an injected provider."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirekit.operators.providers import Provider


def stage_status(log: DataFrame) -> DataFrame:
    """The newest status of each stage of each book from an append-only log (book_id, stage, status, updated_at)."""
    return log.groupBy("book_id", "stage").agg(F.max_by("status", "updated_at").alias("status"), F.max("updated_at").alias("updated_at"))


def runnable(log: DataFrame, stages: list[str]) -> DataFrame:
    """The first stage of each book that isn't done; books with all stages done aren't listed."""
    done = stage_status(log).where("status = 'done'").groupBy("book_id").agg(F.collect_set("stage").alias("d"))
    books = log.select("book_id").distinct().join(done, "book_id", "left")
    first = F.get(F.filter(F.array(*map(F.lit, stages)), lambda x: ~F.coalesce(F.array_contains("d", x), F.lit(False))), F.lit(0))
    return books.select("book_id", first.alias("stage")).where("stage is not null")


def parse_blocks(output: str) -> list[tuple[str, str]] | None:
    """Source and target lines of an output's blocks; None if a block hasn't two lines or the last one isn't closed."""
    parts = [[line for line in p.split("\n") if line.strip()] for p in (output + "\n").replace("\n---\n", "\n\x00\n").split("\x00")]
    if parts[-1] or any(len(p) != 2 for p in parts[:-1]):
        return None
    return [(a, b) for a, b in parts[:-1]]


def _bare(text: str) -> str:
    return "".join(c for c in text if c.isalnum())


def translate(paragraphs: DataFrame, provider: Provider, *, key: str = "file_no", order: str = "para_no", text: str = "para", batch: int = 5, attempts: int = 4) -> DataFrame:
    """Paragraphs of a file translated in order, ``batch`` at a time: target, status (ok or failed) and tries.

    A batch whose output lacks a block or changes a source is tried again with one paragraph less; a paragraph that fails
    alone after ``attempts`` tries becomes a dead letter and the rest goes on. Files are streamed sorted, one batch held.
    """
    rows = paragraphs.select(key, order, text)
    schema = T.StructType([*rows.schema.fields, T.StructField("target", T.StringType()), T.StructField("status", T.StringType()), T.StructField("tries", T.IntegerType())])

    def send(held: list[tuple]) -> list[tuple]:
        out, size = [], len(held)
        tries = 0
        while held:
            part = held[:size]
            tries += 1
            try:
                got = parse_blocks(provider("\n\n".join(r[2] or "" for r in part)).text)
            except Exception:  # any provider's trouble counts as a failed try
                got = None
            if got and len(got) == len(part) and all(_bare(a) == _bare(r[2] or "") for (a, _), r in zip(got, part, strict=True)):
                out += [(*r, b.removeprefix(">").strip(), "ok", tries) for r, (_, b) in zip(part, got, strict=True)]
            elif size > 1:
                size -= 1
                continue
            elif tries < attempts:
                continue
            else:
                out.append((*part[0], None, "failed", tries))
            held, size, tries = held[len(part) :], max(1, min(batch, len(held) - len(part))), 0
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        kind = None
        for b in batches:
            out, kind = [], b.schema
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if held and (row[0] != held[0][0] or len(held) == batch):
                    out += send(held)
                    held = []
                held.append(row)
            if out:
                yield _batch(out, kind)
        if held:
            yield _batch(send(held), kind)

    return rows.repartition(key).sortWithinPartitions(key, order).mapInArrow(run, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    types = [*schema.types, pa.string(), pa.string(), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=[*schema.names, "target", "status", "tries"])
