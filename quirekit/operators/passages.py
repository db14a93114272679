"""Passages that documents hold whole, by hashes of runs of characters."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A passage is looked for by its first 2^k characters, for the largest k up to RUN_BITS that it has so many of.
RUN_BITS = 5
#: Characters of a text handled at a time.
SLICE = 1 << 20
#: Passages, and their characters, that are broadcast at a time.
SENT_ROWS, SENT_CHARS = 1 << 18, 1 << 25
_M = np.uint64(0x9E3779B97F4A7C15)


def _runs(text: str) -> Iterator[np.ndarray]:
    """Hashes of all runs of 1, 2, 4, ... characters, by place."""
    h = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) * _M
    for k in range(RUN_BITS + 1):
        if k:
            half = 1 << (k - 1)
            h = (h[:-half] ^ (h[:-half] >> np.uint64(29))) * _M + (h[half:] ^ (h[half:] >> np.uint64(31)))
        if not len(h):
            return
        yield h ^ np.uint64(k)


def anchor(passage: str) -> int:
    """Hash of the passage's first run; 0 for an empty one, which every text holds."""
    runs = [h[0] for h in _runs(passage[: 1 << RUN_BITS])]
    return int(runs[-1].astype(np.int64)) if runs else 0


def anchors_in(text: str, known: list[np.ndarray]) -> np.ndarray:
    """Those of the sorted ``known`` anchors (by k) whose run the text holds, and 0."""
    out = [np.zeros(1, np.int64)]
    for at in range(0, len(text), SLICE):
        for h, want in zip(_runs(text[at : at + SLICE + (1 << RUN_BITS) - 1]), known, strict=False):
            if len(want):
                h = h.astype(np.int64)
                out.append(want[np.isin(want, h[np.isin(h, want)])])
    return np.unique(np.concatenate(out))


def passages_in(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """Rows of ``docs`` (text) joined with those of ``passages`` (passage) that the text contains; nulls hold and are in none.

    Every pair that contains the passage shares the passage's anchor. Passages are broadcast, in as many slices of at most about
    SENT_ROWS rows and SENT_CHARS characters as it takes, so texts are never shuffled."""
    size = passages.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("passage")), F.lit(0)).alias("chars")).first()
    slices = max(1, -(-size.n // SENT_ROWS), -(-size.chars // SENT_CHARS))
    slice_of = F.pmod(F.xxhash64("passage"), F.lit(slices))
    return reduce(DataFrame.unionByName, [_holding(docs, passages.where(slice_of == k)) for k in range(slices)])


def _holding(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """The pairs of one slice."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(b.schema.names.index("passage")).to_pylist()
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([anchor(t) for t in texts], pa.int64()), pa.array([min(len(t).bit_length() - 1, RUN_BITS) for t in texts], pa.int32())], names=[*b.schema.names, "_anchor", "_k"])

    marked = passages.where("passage is not null")
    marked = marked.mapInArrow(mark, T.StructType([*marked.schema.fields, T.StructField("_anchor", T.LongType()), T.StructField("_k", T.IntegerType())]))
    got = marked.select("_k", "_anchor").distinct().toPandas()
    shared = docs.sparkSession.sparkContext.broadcast([np.sort(got["_anchor"][got["_k"] == k].to_numpy(np.int64)) for k in range(RUN_BITS + 1)])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for b in batches:
            found = [anchors_in(t, known) for t in b.column(b.schema.names.index("text")).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, pa.list_(pa.int64()))], names=[*b.schema.names, "_found"])

    texts = docs.where("text is not null")
    texts = texts.mapInArrow(find, T.StructType([*texts.schema.fields, T.StructField("_found", T.ArrayType(T.LongType()))]))
    hits = texts.withColumn("_anchor", F.explode("_found")).join(F.broadcast(marked.drop("_k")), "_anchor")
    return hits.where(F.col("text").contains(F.col("passage"))).drop("_found", "_anchor")
