"""Near-duplicate embeddings through randomly rotated binary codes with stored correction factors."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirekit.llm.common import Tables, connected_components, pairs_of, runs, salted_join, whole_runs

#: Rows of a bucket that one task compares with as many others.
BLOCK = 512
#: Bits of a code at least.
LEAST_BITS = 256
#: A pair at the threshold shares a band with this probability; closer pairs with a higher one.
RECALL = 0.999
#: Width of the confidence bounds in deviations of the estimate.
EPSILON = 4.5
#: Bytes of a code that go to the buckets, however wide vectors and codes are.
SENT = LEAST_BITS // 8


def plan_bands(rows: int, threshold: float, recall: float = RECALL) -> tuple[int, int]:
    """Bits of a band and number of bands: buckets hold a few dozen unrelated rows at any number of rows."""
    bits = min(max(4, round(math.log2(max(rows, 1) / 32))), 40)
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - same))


def rotation(dims: int, bits: int, seed: int) -> np.ndarray:
    """A random isometry from ``dims`` to ``bits`` dimensions (rows: output)."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((max(bits, dims), dims)))
    return q * np.sign(np.diag(r))


def encode(unit: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sign bits of the rotated unit vectors, and the inner product of each with its code (the correction factor)."""
    turned = unit @ turn.T
    return turned >= 0, np.abs(turned).sum(1) / math.sqrt(turn.shape[0])


def estimate(query: np.ndarray, bits: np.ndarray, factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unbiased estimates of inner products of rotated unit vectors with coded ones, and the deviation for each code."""
    d = bits.shape[1]
    signs = np.where(bits, 1.0, -1.0).astype(np.float32)
    est = (query.astype(np.float32) @ signs.T) / (math.sqrt(d) * factor[None, :].astype(np.float32))
    return est, np.sqrt(np.maximum(1 - factor**2, 0) / (factor**2 * (d - 1)))


def most_different(bits: int, threshold: float) -> int:
    """Places at which the signs of ``bits`` random projections differ, at most, for a pair at the threshold: by the angle, with the bounds' width."""
    p = math.acos(threshold) / math.pi
    return math.ceil(bits * p + EPSILON * math.sqrt(bits * p * (1 - p)))


def _bands(bits: np.ndarray, width: int, bands: int) -> np.ndarray:
    weights = 1 << np.arange(width, dtype=np.int64)
    return bits[:, : width * bands].reshape(len(bits), bands, width) @ weights


def _vectors(column: pa.Array) -> tuple[list[bytes | None], np.ndarray]:
    """Raw doubles of each usable vector (else None)."""
    out = []
    for v in column.to_pylist():
        a = None
        if v and None not in v:
            a = np.asarray(v, np.float64)
            if not np.isfinite(a).all() or not a.any():
                a = None
        out.append(a)
    return out


def _unit(raw: np.ndarray) -> np.ndarray:
    scaled = raw / np.abs(raw).max(1, keepdims=True)  # else squares of very large or small components overflow
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        got = _vectors(b.column(1))
        raw = [None if v is None else v.tobytes() for v in got]
        key = [None if r is None else xxhash.xxh3_128_hexdigest(r) for r in raw]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(key, pa.string()), pa.array(raw, pa.binary())], names=["vec_id", "copy_key", "raw"])


def compare_block(ids: np.ndarray, copies: np.ndarray, raw: np.ndarray, bits: np.ndarray, factor: np.ndarray, left: np.ndarray, right: np.ndarray, band: int, plan: tuple[int, int], turn: np.ndarray, threshold: float) -> tuple[list, list]:
    """Links between the rows ``left`` and ``right`` of one bucket: counts (id, links) and edges that span their components.

    A pair is rejected if the upper confidence bound of its estimate is below the threshold; every other one is
    computed exactly in double precision. A pair that met in an earlier band was handled there.
    """
    unit = _unit(raw)
    est, deviation = estimate(unit[left] @ turn.T, bits[right], factor[right])
    open_ = est + (EPSILON * deviation).astype(np.float32)[None, :] >= threshold
    same_block = len(left) == len(right) and (left == right).all()
    if same_block:
        open_ &= np.triu(np.ones(open_.shape, bool), 1)
    open_ &= ids[left][:, None] != ids[right][None, :]
    rows, cols = open_.any(1), open_.any(0)
    if not rows.any():
        return [], []
    left, right, open_ = left[rows], right[cols], open_[rows][:, cols]
    linked = open_ & (unit[left] @ unit[right].T >= threshold)
    if linked.any() and band:
        bl, br = _bands(bits[left], *plan), _bands(bits[right], *plan)
        for t in range(band):
            linked &= bl[:, t][:, None] != br[:, t][None, :]
    if not linked.any():
        return [], []
    n_left, n_right = linked @ copies[right], copies[left] @ linked
    counts = [(int(i), int(n)) for i, n in [*zip(ids[left], n_left), *zip(ids[right], n_right)] if n]
    a, b = np.nonzero(linked)
    if len(a) <= 2 * (len(left) + len(right)):
        return counts, list(zip(ids[left[a]].tolist(), ids[right[b]].tolist()))
    # labels spread over the dense block until they stay: one edge a row is enough to keep its components together
    far = np.iinfo(np.int64).max
    la, lb = ids[left].copy(), ids[right].copy()
    own_a, own_b = ids[left], ids[right]
    while True:
        na = np.minimum(la, np.where(linked, lb[None, :], far).min(1))
        nb = np.minimum(lb, np.where(linked, na[:, None], far).min(0))
        if same_block:  # a row stands on both sides
            where = {int(i): k for k, i in enumerate(own_b)}
            for k, i in enumerate(own_a.tolist()):
                j = where.get(i)
                if j is not None:
                    na[k] = nb[j] = min(na[k], nb[j])
        if (na == la).all() and (nb == lb).all():
            break
        la, lb = na, nb
    return counts, [(int(i), int(m)) for i, m in [*zip(own_a, la), *zip(own_b, lb)] if i != m]


def link_vectors(vectors: DataFrame, *, threshold: float = 0.9, seed: int = 1) -> DataFrame:
    """Links of near-duplicate vectors by cosine.

    ``vectors``: vec_id (long), embedding (array of numbers). Returns vec_id, n_links, component_id, kept, one row per input row.
    Equal vectors are collapsed first and counted. Codes of rotated sign bits are cut into bands; vectors that share a
    band are candidates, and a pair at the threshold shares one with probability RECALL (of all pairs at or over it, far
    more). Only the first SENT bytes of codes go to the buckets, where the bits that differ bound the angle; the vectors with an
    open pair are fetched by key for their block. There, estimates from code and correction factor reject candidates whose upper
    bound is under the threshold; the rest is computed exactly, so no pair below it is linked. Buckets are compared
    block by block, each pair counted in the first band it shares; no list of pairs is made. Null, zero, empty and non-finite vectors, and null ids, link
    with nothing; vectors of different lengths don't either; rows that share an id are one node, whose links are added; repeated rows are
    copies of each other; labels and further columns are ignored; an empty table gives none.
    """
    tables = Tables(vectors.sparkSession)
    keyed = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(_keyed, "vec_id long, copy_key string, raw binary")
    usable = keyed.where("vec_id is not null and copy_key is not null")
    groups = usable.groupBy("copy_key").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"), F.min("raw").alias("raw"))
    groups = tables.put(groups.withColumn("dims", (F.length("raw") / 8).cast("int")).withColumn("key", F.xxhash64("copy_key")))
    edges, counts, total = None, None, 0
    for dims, n, rows in sorted(tuple(r) for r in groups.groupBy("dims").agg(F.count("*"), F.sum("copies")).collect()):
        total += rows
        found = tables.put(_links(tables, groups.where(F.col("dims") == dims), dims, n, threshold, seed))
        e = found.where("b is not null").select("a", "b")
        c = found.where("b is null").groupBy("a").agg(F.sum("n").alias("n"))
        edges, counts = (e, c) if edges is None else (edges.unionAll(e), counts.unionAll(c))
    if edges is None:
        return keyed.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    components = connected_components(edges)
    counts = counts.groupBy("a").agg(F.sum("n").alias("n"))
    known = groups.select("copy_key", "id", "copies").join(counts.withColumnRenamed("a", "id"), "id", "left").join(components, "id", "left")
    known = tables.put(known.select("copy_key", "copies", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id")), groups)
    # a row without a key gets one of its own, so that such rows don't meet
    key = F.coalesce("copy_key", F.concat(F.lit("none:"), F.monotonically_increasing_id().cast("string")))
    out = salted_join(keyed.select("vec_id", key.alias("copy_key")), known, "copy_key", "copies", total, F.xxhash64("vec_id"))
    own = F.coalesce(F.when(F.col("vec_id").isNotNull(), F.col("component_id")), F.col("vec_id"))
    return out.select("vec_id", F.when(F.col("vec_id").isNull(), 0).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"), own.alias("component_id"), F.coalesce(F.col("vec_id") == own, F.lit(True)).alias("kept"))


def _links(tables: Tables, groups: DataFrame, dims: int, n: int, threshold: float, seed: int) -> DataFrame:
    width, bands = plan_bands(n, threshold)
    bits = max(LEAST_BITS, -(-width * bands // 64) * 64)
    most = most_different(8 * SENT, threshold)

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = rotation(dims, bits, seed)
        for b in batches:
            if b.num_rows:
                raw = np.frombuffer(b"".join(b.column(3).to_pylist()), np.float64).reshape(-1, dims)
                code, factor = encode(_unit(raw), turn)
                packed = np.packbits(code, axis=1)
                bucket = _bands(code, width, bands) | (np.arange(bands, dtype=np.int64) << 40)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array([r.tobytes() for r in packed], pa.binary()), pa.array(factor), pa.array(bucket.tolist(), pa.list_(pa.int64()))], names=["key", "id", "copies", "raw", "code", "factor", "buckets"])

    coded = tables.put(groups.select("key", "id", "copies", "raw").mapInArrow(codes, "key long, id long, copies long, raw binary, code binary, factor double, buckets array<long>"))
    sizes = tables.put(coded.select(F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1"))
    rows = coded.select("key", F.substring("code", 1, SENT).alias("sent"), F.explode("buckets").alias("bucket"))
    rows = salted_join(rows, sizes, "bucket", "size", n * bands, F.col("key")).where("size is not null")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    rows = rows.withColumn("own", F.pmod("key", blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    rows = rows.withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other")).withColumn("run", F.xxhash64("bucket", "lo", "hi"))
    side = F.when(F.col("lo") == F.col("hi"), 0).when(F.col("own") == F.col("lo"), 1).otherwise(2)
    rows = rows.select("run", side.alias("side"), F.shiftright("bucket", 40).cast("int").alias("band"), "key", "sent")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_runs(batches, "run"):
            sent = np.frombuffer(b"".join(t.column("sent").to_pylist()), np.uint64).reshape(t.num_rows, -1)
            open_ = np.zeros(t.num_rows, bool)
            for p, q in pairs_of(t.column("side").to_numpy(), t.column("run").to_numpy()):
                near = np.bitwise_count(sent[p] ^ sent[q]).sum(1, dtype=np.int64) <= most
                open_[p[near]] = open_[q[near]] = True
            yield from t.select(["run", "side", "band", "key"]).filter(pa.array(open_)).combine_chunks().to_batches()

    asked = rows.repartition("run").sortWithinPartitions("run", "side").mapInArrow(look, "run long, side int, band int, key long")
    rows = tables.put(asked).join(coded.drop("buckets"), "key").repartition("run").sortWithinPartitions("run")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = rotation(dims, bits, seed)
        out: list[tuple] = []
        for t in runs(batches, "run"):
            c = {k: t.column(k).to_numpy() for k in ("side", "band", "id", "copies", "factor")}
            raw = np.frombuffer(b"".join(t.column("raw").to_pylist()), np.float64).reshape(-1, dims)
            code = np.unpackbits(np.frombuffer(b"".join(t.column("code").to_pylist()), np.uint8).reshape(len(raw), -1), axis=1).astype(bool)
            left, right = np.flatnonzero(c["side"] < 2), np.flatnonzero(c["side"] != 1)
            counts, edges = compare_block(c["id"], c["copies"], raw, code, c["factor"], left, right, int(c["band"][0]), (width, bands), turn, threshold)
            out += [(a, None, n) for a, n in counts] + [(a, b, 0) for a, b in edges]
            if len(out) > 100_000:
                yield _out(out)
                out = []
        if out:
            yield _out(out)

    return rows.mapInArrow(compare, "a long, b long, n long")


def _out(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["a", "b", "n"])


def op6_rotated_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``embeddings``, linked from cosine 0.9 on."""
    return link_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


#: The same by all pairs.
ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.9
), r AS (SELECT DISTINCT a AS vec_id, a AS other FROM l UNION SELECT r.vec_id, l.b FROM r JOIN l ON l.a = r.other
), c AS (SELECT vec_id, min(other) AS c FROM r GROUP BY 1
), n AS (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY 1)
SELECT x.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, coalesce(c.c, x.vec_id) AS component_id, coalesce(c.c, x.vec_id) = x.vec_id AS kept FROM embeddings x LEFT JOIN n USING (vec_id) LEFT JOIN c USING (vec_id)
"""
