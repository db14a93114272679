"""Mixing sources to target weights by a low-discrepancy slot schedule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quirekit.llm.common import HOT_SHARE, WORD, written

#: floor(2^32 / golden ratio), made odd: multiples of it modulo 2^32 are the golden-ratio points in integers.
GOLDEN = 2654435769
UNIT = 1 << 32
#: Slots whose ranks are taken together.
CHUNK = 1 << 12
#: Shares are looked up by the top 12 bits of a point; the points fill these cells evenly.
CELL_SHIFT = 20
#: Hexadecimal digits of the shuffling hash that make a bucket of a source's stream.
BUCKET_DIGITS = 3


def word_count(text: Column) -> Column:
    """Number of words, null as none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, cycle: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """Target of each source (columns source, source_size; one row per source), capped at ``most`` times its size.

    Sources in code-point order, null last, weigh ``cycle`` repeating and share the total of all sizes by weight; a
    source stops at its cap and its excess is reshared by weight until none is above. That end state has a closed
    form: in the order of cap over weight the capped sources are a prefix, so two running sums find it.
    Adds ``place`` (from 0), ``weight`` and ``target`` (double).
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    q = F.col("cap") / F.col("weight")
    w = Window.orderBy("q", "place")
    every = Window.partitionBy()
    rows = sizes.withColumn("place", F.row_number().over(by_name) - 1)
    rows = rows.withColumn("weight", F.element_at(F.array(*map(F.lit, cycle)), (F.col("place") % len(cycle) + 1).cast("int")).cast("double"))
    rows = rows.withColumn("cap", (F.col("source_size") * most).cast("double")).withColumn("q", q)
    rows = rows.withColumn("before", F.coalesce(F.sum("cap").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    rows = rows.withColumn("left", F.sum("weight").over(w.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    rows = rows.withColumn("total", F.sum("source_size").over(every).cast("double"))
    rows = rows.withColumn("level", (F.col("total") - F.col("before")) / F.col("left")).withColumn("free", F.col("level") < F.col("q"))
    level = F.min(F.when(F.col("free"), F.struct("q", "place", "level"))).over(every)["level"]
    return rows.withColumn("target", F.when(F.col("free"), F.col("weight") * level).otherwise(F.col("cap"))).select("source", "source_size", "place", "weight", "target")


def slot_schedule(spark: SparkSession, shares: DataFrame, slots: int) -> DataFrame:
    """``slots`` slots dealt to sources: columns slot, place and rank (of the slot within its source, from 0).

    ``shares``: place, upto (cumulative share in [0, 2^32], exclusive end) and start. The golden-ratio point of a slot
    falls in one source's share, found through the cells of the unit interval that the share covers. Ranks come from counts of slots per run of CHUNK slots, summed over the runs,
    and a ranking within the run, so no source has to pass through one task.
    """
    point = F.pmod(F.pmod(F.col("slot") + 1, F.lit(UNIT)) * GOLDEN, F.lit(UNIT))
    cells = shares.withColumn("cell", F.explode(F.sequence(F.shiftright("start", CELL_SHIFT), F.shiftright(F.col("upto") - 1, CELL_SHIFT))))
    dealt = spark.range(slots).withColumnRenamed("id", "slot").withColumn("point", point).withColumn("cell", F.shiftright("point", CELL_SHIFT)).withColumn("chunk", F.floor(F.col("slot") / CHUNK))
    dealt = dealt.join(cells, "cell").where("start <= point AND point < upto").select("slot", "chunk", "place")
    counts = dealt.groupBy("place", "chunk").agg(F.count("*").alias("n"))
    before = counts.select("place", "chunk", (F.sum("n").over(Window.partitionBy("place").orderBy("chunk")) - F.col("n")).alias("before"))
    within = dealt.withColumn("r", F.row_number().over(Window.partitionBy("chunk", "place").orderBy("slot")) - 1)
    return within.join(before, ["place", "chunk"]).select("slot", "place", (F.col("before") + F.col("r")).alias("rank"))


def mix_sources(docs: DataFrame, *, size: Column | None = None, cycle: tuple[int, ...] = (1, 2, 3), most: int = 3, block: int = 64, seed: int = 7) -> DataFrame:
    """Words that a mix takes from each document.

    ``docs``: doc_id, text, source. Returns doc_id, size (words), source, source_size, target, taken. A slot is
    one block of ``block`` words; golden-ratio points deal slots to sources in proportion to their targets
    (see ``source_targets``), so any run of slots is near the wanted proportions. A source's documents, shuffled by a
    seeded hash, form an endless stream that repeats; its slot of rank r is the r-th block of that stream, and its
    last block ends at the target. A document is thus taken at most ``most`` times and reruns agree.
    Null texts count no words; a null source is a source of its own, after the others; repeated ids are
    separate documents; further columns are ignored; an empty table, or one without words, takes nothing.
    The stream of a source is cut by the first digits of the hash into buckets whose sums are accumulated first, so
    a source with most of the rows isn't one task. The table of sources is the only one that one task sees whole.
    """
    spark = docs.sparkSession
    key = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("n_row")).cast("binary"))
    sized = docs.select("doc_id", "source", (word_count(F.col("text")) if size is None else size.cast("long")).alias("size"))
    # repeated rows: their order doesn't matter as long as it is one, so equal rows are numbered
    once = sized.groupBy("doc_id", "source", "size").agg(F.count("*").alias("copies"))
    rows = once.select("doc_id", "source", "size", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("n_row"))
    rows = written(rows.withColumn("key", key).withColumn("bucket", F.substring("key", 1, BUCKET_DIGITS)))
    parts = written(rows.groupBy("source", "bucket").agg(F.sum("size").alias("n")))
    targets = written(source_targets(parts.groupBy("source").agg(F.sum("n").alias("source_size")), cycle, most))
    total = targets.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    slots = -(-total // block)
    # integer ends of the shares: the same in every engine
    upto = F.round(F.sum("target").over(Window.orderBy("place")) / F.sum("target").over(Window.partitionBy()) * UNIT).cast("long")
    shares = targets.where("target > 0").withColumn("upto", upto)
    shares = shares.withColumn("start", F.coalesce(F.lag("upto").over(Window.orderBy("place")), F.lit(0)))
    schedule = slot_schedule(spark, shares, slots)
    # where each document's words lie in its source's stream
    same = F.col("a.source").eqNullSafe(F.col("b.source"))
    first = parts.withColumn("before", F.sum("n").over(Window.partitionBy("source").orderBy("bucket")) - F.col("n")).drop("n")
    placed = first.alias("a").join(targets.alias("b"), same).select("a.source", "a.bucket", "a.before", "b.source_size", "b.place", "b.target")
    inner = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "n_row")
    here = rows.withColumn("at", F.sum("size").over(inner) - F.col("size"))
    here = here.alias("a").join(placed.alias("b"), same & (F.col("a.bucket") == F.col("b.bucket")))
    docs_at = here.select("a.doc_id", "a.n_row", "a.size", "a.source", "a.key", "b.source_size", "b.place", "b.target", (F.col("a.at") + F.col("b.before")).alias("at"))
    # a document's words in each block, once for each time the stream comes round
    limit = F.floor("target").cast("long")
    times = F.sequence(F.lit(0), F.lit(most - 1))
    laps = docs_at.where("size > 0").withColumn("lap", F.explode(times)).withColumn("lo", F.col("at") + F.col("lap") * F.col("source_size"))
    laps = laps.withColumn("hi", F.least(F.col("lo") + F.col("size"), limit)).where("lo < hi")
    pieces = laps.withColumn("rank", F.explode(F.sequence(F.floor(F.col("lo") / block), F.floor((F.col("hi") - 1) / block))))
    words = F.least("hi", (F.col("rank") + 1) * block) - F.greatest("lo", F.col("rank") * block)
    taken = pieces.select("doc_id", "n_row", "source", "size", "place", "rank", words.alias("words")).join(schedule.select("place", "rank"), ["place", "rank"])
    taken = taken.groupBy("doc_id", "n_row", "source", "size").agg(F.sum("words").alias("taken"))
    out = docs_at.alias("a").join(taken.alias("b"), (F.col("a.doc_id").eqNullSafe(F.col("b.doc_id"))) & (F.col("a.n_row") == F.col("b.n_row")) & F.col("a.source").eqNullSafe(F.col("b.source")) & (F.col("a.size") == F.col("b.size")), "left")
    return out.select("a.doc_id", "a.size", "a.source", "a.source_size", "a.target", F.coalesce("b.taken", F.lit(0)).alias("taken"))


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` mixed by weights 1, 2, 3, repeating."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
), rows_ AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, source, size) AS n_row FROM sized
), keyed AS (
  SELECT *, md5('7:' || coalesce(doc_id::VARCHAR, '') || ':' || n_row) AS key FROM rows_
), stream AS (
  SELECT *, (sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, n_row ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS at FROM keyed
), s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY 1
), s1 AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM s0
), s2 AS (
  SELECT *, (place % 3 + 1)::DOUBLE AS weight, (source_size * 3)::DOUBLE AS cap, (source_size * 3)::DOUBLE / (place % 3 + 1)::DOUBLE AS q FROM s1
), s3 AS (
  SELECT *, coalesce(sum(cap) OVER (ORDER BY q, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    sum(weight) OVER (ORDER BY q, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest, sum(source_size) OVER ()::DOUBLE AS total FROM s2
), s4 AS (SELECT *, (total - before) / rest AS level FROM s3
), lv AS (SELECT arg_min(level, (q, place)) AS level FROM s4 WHERE level < q
), targets AS (
  SELECT source, source_size, place, CASE WHEN s4.level < q THEN weight * lv.level ELSE cap END AS target FROM s4 LEFT JOIN lv ON true
), shares AS (
  SELECT place, target, round(sum(target) OVER (ORDER BY place ROWS UNBOUNDED PRECEDING) / sum(target) OVER () * 4294967296)::BIGINT AS upto FROM targets WHERE target > 0
), ends AS (SELECT *, coalesce(lag(upto) OVER (ORDER BY place), 0) AS start FROM shares
), slots AS (
  SELECT i AS slot, ((i + 1) % 4294967296 * 2654435769) % 4294967296 AS point
  FROM range(0, (SELECT ceil(coalesce(sum(source_size), 0) / 64.0)::BIGINT FROM s0)) t(i)
), schedule AS (
  SELECT place, row_number() OVER (PARTITION BY place ORDER BY slot) - 1 AS rank FROM slots JOIN ends ON start <= point AND point < upto
), laps AS (
  SELECT k.doc_id, k.n_row, k.source, k.size, t.place, k.at + lap * t.source_size AS lo, least(k.at + lap * t.source_size + k.size, floor(t.target)::BIGINT) AS hi
  FROM stream k JOIN targets t ON k.source IS NOT DISTINCT FROM t.source, range(0, 3) r(lap) WHERE k.size > 0
), pieces AS (
  SELECT doc_id, n_row, source, size, place, lo, hi, unnest(range((lo // 64)::BIGINT, ((hi - 1) // 64)::BIGINT + 1)) AS rank FROM laps WHERE lo < hi
), taken AS (
  SELECT doc_id, n_row, source, size, sum(least(hi, (rank + 1) * 64) - greatest(lo, rank * 64))::BIGINT AS taken FROM pieces JOIN schedule USING (place, rank) GROUP BY ALL
)
SELECT k.doc_id, k.size::BIGINT AS size, t.source_size, t.target, coalesce(x.taken, 0)::BIGINT AS taken
FROM stream k JOIN targets t ON k.source IS NOT DISTINCT FROM t.source
LEFT JOIN taken x ON x.doc_id IS NOT DISTINCT FROM k.doc_id AND x.n_row = k.n_row AND x.source IS NOT DISTINCT FROM k.source AND x.size = k.size
"""
