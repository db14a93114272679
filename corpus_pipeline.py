"""A training corpus from ``documents``: quality, near duplicates, personal data, source mix, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirekit.llm.common import Tables, shared_dir
from quirekit.llm.ordinal_quality import model_for, score_quality
from quirekit.llm.power_pack import default_tokenizer, pack
from quirekit.llm.prefix_join import jaccard_components
from quirekit.llm.skip_chain_pii import find_personal_data, redact, train
from quirekit.llm.source_mix import mix_sources, word_count


#: Ids, of eight bytes each, that may be broadcast.
SENT_IDS = 1 << 20


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose best grade is less likely than not.

    Null and empty texts are judged as texts without words; repeated rows are judged alike, so all or none of them stay; a probability
    of exactly one half stays; an empty table stays empty.
    """
    scored = score_quality(docs, model_for(spark, docs, sf_dir))
    return scored.where("keep").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, that of the smallest id, of each component of 5-word likeness 0.8 or more.

    Of rows that share an id and a text one stays; texts without words and rows without an id have no duplicates; an empty table
    stays empty. Only rows of repeated ids are shuffled with their texts, and the others only if the ids that go are too many to send.
    """
    tables, kept = Tables(spark), Tables(spark)
    components = jaccard_components(docs.select("doc_id", "text"), width=5, percent=80, tables=tables)
    gone = kept.put(components.where("doc_id is not null and doc_id <> component_id").select("doc_id").distinct())
    tables.clear()
    twice = kept.put(docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"))
    sent = lambda ids: F.broadcast(ids) if ids.count() <= SENT_IDS else ids
    left = docs.join(sent(gone), "doc_id", "left_anti")
    once = left.join(sent(twice), "doc_id", "left_anti")
    return once.unionByName(left.join(sent(twice), "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])).select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind in angle brackets and renews n_chars.

    Null and empty texts stay as they are; repeated rows are changed alike; overlapping spans are replaced together; an empty table
    stays empty. Another column named spans doesn't get in the way.
    """
    out = redact(find_personal_data(docs, train(docs)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or drops documents as the source mix takes their words, to whole documents: taken / size, rounded.

    A document without words, null or empty, is never taken. Rows that share id, source and size are repeated alike; null
    ids and sources count as values of their own; an empty table stays empty.
    """
    taken = mix_sources(docs).where("size > 0").groupBy("doc_id", "source", "size").agg((F.round(F.sum("taken") / F.sum("size"))).cast("int").alias("times")).where("times > 0")
    rows = docs.select(F.struct(*docs.columns).alias("row"), word_count(F.col("text")).alias("size"))
    same = F.col("d.row.doc_id").eqNullSafe(F.col("t.doc_id")) & F.col("d.row.source").eqNullSafe(F.col("t.source")) & (F.col("d.size") == F.col("t.size"))
    return rows.alias("d").join(taken.alias("t"), same).select("d.row", F.explode(F.sequence(F.lit(1), F.col("t.times")))).select("row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens, each a power of two and of one document.

    Null and empty texts are one end token; repeated rows are packed each; an empty table gives no sequences.
    """
    return pack(docs, *default_tokenizer())


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("personal_data", personal_data), ("mix", mix), ("packing", packing)]

#: Three stages are not expressible in SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is a Parquet table in the shared folder, read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{shared_dir(spark)}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
