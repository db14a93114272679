"""Pieces that several operators of this subpackage share."""

from __future__ import annotations

import string
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, as the contracts spell it.
WORD = r"[^\x20\x09-\x0D]+"
#: Keys with over one in HOT_SHARE of the rows are salted; there can be at most HOT_SHARE of them.
HOT_SHARE = 1000
SALTS = 32
#: Pairs of rows held at a time.
PAIRS = 1 << 18


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z; other letters stay."""
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder under ``spark.checkpoint.dir``; only where that is unset, in local mode, a temporary one is set."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="quirekit-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/quirekit-{uuid.uuid4().hex}"
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


def written(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder: lineage ends there, and a lost executor loses nothing of it."""
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Tables:
    """Tables of one computation in the shared folder, deleted as soon as nothing reads them any more."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, {}

    def put(self, df: DataFrame, *done: DataFrame) -> DataFrame:
        """``df`` as a table; the tables ``done`` aren't needed after it."""
        path = shared_dir(self.spark)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (path, out)
        self.drop(*done)
        return out

    def drop(self, *done: DataFrame) -> None:
        """Deletes tables; the collection makes Spark's cleaner free the shuffles that led to them."""
        for df in done:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop(id(df))[0])
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        if done:
            self.spark._jvm.System.gc()

    def clear(self) -> None:
        """Deletes all tables that are left, once what was made of them is written."""
        self.drop(*[df for _, df in self.paths.values()])


def salted_join(left: DataFrame, right: DataFrame, key: str, rows: str, total: int, salt: Column, salts: int = SALTS) -> DataFrame:
    """``left`` with the columns of ``right`` (unique per ``key``), hot keys split.

    ``rows`` is the column of ``right`` with the number of ``left`` rows of a key and ``total`` their sum. Keys with more
    than ``total / HOT_SHARE`` rows are at most HOT_SHARE, so the list of them can be broadcast; their rows are
    spread over ``salts`` copies of the ``right`` row by ``salt``. Other keys hold too few rows to matter.
    """
    hot = F.col(rows) * HOT_SHARE > total
    split = F.broadcast(right.where(hot).select(key, F.lit(True).alias("_hot")))
    a = left.join(split, key, "left").withColumn("_salt", F.when(F.col("_hot"), F.pmod(salt, F.lit(salts)).cast("int")).otherwise(0)).drop("_hot")
    b = right.withColumn("_salt", F.explode(F.when(hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
    return a.join(b, [key, "_salt"], "left").drop("_salt")


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a batch, null as empty."""
    return [x or "" for x in batch.column(batch.schema.get_field_index(name)).to_pylist()]


def small(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``rows`` rows, so that what is made of one stays small."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def whole_runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of sorted batches, cut where ``key`` changes: no run of equal keys is in two; the caller bounds the runs."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        k = b.column(b.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(k[1:] != k[:-1]) + 1
        first = held[-1].column(b.schema.get_field_index(key))[-1].as_py() if held else k[0]
        cut = int(cuts[-1]) if len(cuts) else 0
        if first != k[0]:
            yield pa.Table.from_batches(held)
            held = []
        if cut:
            yield pa.Table.from_batches([*held, b.slice(0, cut)])
            held = []
        held.append(b.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def pairs_of(side: np.ndarray, run: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs to compare, in portions, of rows sorted by run and side: all of side 0, and each of side 1 with each of side 2."""
    if not len(run):
        return
    new = np.concatenate([[True], (run[1:] != run[:-1]) | (side[1:] != side[:-1])])
    first = np.flatnonzero(new)
    part = np.cumsum(new) - 1
    end = np.append(first[1:], len(run))
    row = np.arange(len(run))
    # of a row of side 0 the later ones of its part; of one of side 1 the next part, if it is the run's side 2
    nxt = np.minimum(part + 1, len(first) - 1)
    has = (side == 1) & (part + 1 < len(first)) & (run[first[nxt]] == run) & (side[first[nxt]] == 2)
    begin = np.where(side == 0, row + 1, first[nxt])
    count = np.where(side == 0, end[part] - row - 1, np.where(has, end[nxt] - first[nxt], 0))
    total = np.cumsum(count)
    i = 0
    while i < len(row):
        j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + PAIRS, "right")))
        c = count[i:j]
        p = np.repeat(row[i:j], c)
        yield p, np.arange(len(p)) - np.repeat(np.cumsum(c) - c, c) + np.repeat(begin[i:j], c)
        i = j


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """One table for each run of equal ``key`` in sorted batches, across batch ends; the caller bounds the runs."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        k = b.column(b.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(k[1:] != k[:-1]) + 1
        ends = [0, *cuts.tolist(), b.num_rows]
        for i, j in zip(ends, ends[1:]):
            if held and k[i] != last:
                yield pa.Table.from_batches(held)
                held = []
            last = k[i]
            held.append(b.slice(i, j - i))
    if held:
        yield pa.Table.from_batches(held)


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Components of an undirected graph: ``edges`` has columns a, b (long); returns id, component (the smallest id).

    Alternates the two star operations (Kiveris et al., 2014): each vertex links its larger neighbours, then its
    smaller neighbours, to the smallest vertex around it. Every round is a table in the shared folder, so nothing
    is gathered on the driver and a lost executor repeats one round at most. Vertices without edges aren't listed.
    Minima are pre-aggregated; AQE splits the join that brings them back where one vertex has very many neighbours.
    """

    def least(e: DataFrame) -> DataFrame:
        return e.groupBy("a").agg(F.min("b").alias("m"))

    def large_star(e: DataFrame) -> DataFrame:
        both = e.select("a", "b").unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        m = least(both).select("a", F.least("a", "m").alias("m"))
        return both.join(m, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))

    def small_star(e: DataFrame) -> DataFrame:
        down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        m = least(down)
        hung = down.join(m, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        return hung.unionAll(m.select("a", F.col("m").alias("b")))

    tables = Tables(edges.sparkSession)
    now = tables.put(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = None
    for _ in range(rounds):
        now = tables.put(small_star(large_star(now)).where("a <> b").distinct(), now)
        new = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.pmod(F.xxhash64("b", "a"), F.lit(1 << 31)))).first()
        if tuple(new) == mark:
            break
        mark = tuple(new)
    else:
        raise RuntimeError("components didn't settle")
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionAll(now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
