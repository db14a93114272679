"""Queries over the tables read as books: reconciliation, progress, splitting, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirekit.functions.text import normal_content
from quirekit.operators import pages as pg
from quirekit.operators import paragraphs as pp
from quirekit.operators import providers, reconcile
from quirekit.plans import fixtures as fx
from quirekit.session import table

#: Characters of a chunk in the packing queries.
CHUNK_CHARS = 4000


def coverage_missing(s: SparkSession, d: str) -> DataFrame:
    return reconcile.missing(table(s, d, "documents").select("doc_id"), table(s, d, "labels"), "doc_id")


def coverage_extra(s: SparkSession, d: str) -> DataFrame:
    return reconcile.missing(table(s, d, "labels").select("doc_id"), table(s, d, "documents"), "doc_id")


def coverage_report(s: SparkSession, d: str) -> DataFrame:
    return reconcile.coverage_report(table(s, d, "documents"), table(s, d, "labels"), "doc_id")


def _sidecars(s: SparkSession, d: str) -> DataFrame:
    """Documents with hashes now and, perturbed by id, then."""
    t = table(s, d, "documents").select("doc_id", "text", "source", "lang")
    sha = lambda c: F.sha2(c, 256)
    old = lambda c, n: F.when(F.col("doc_id") % n == 0, sha(F.concat(c, F.lit("~")))).otherwise(sha(c))
    return t.select(
        "doc_id", "text", F.when(F.col("doc_id") % 11 == 0, "failed").otherwise("ok").alias("status"), (F.col("doc_id") % 13 != 0).alias("validated"),
        sha(F.col("source")).alias("image_sha"), old(F.col("source"), 7).alias("meta_image_sha"), sha(F.col("lang")).alias("prompt_sha"), old(F.col("lang"), 5).alias("meta_prompt_sha"),
        sha(F.col("text")).alias("output_sha"), old(F.col("text"), 3).alias("meta_output_sha"),
    )


def stale_reasons(s: SparkSession, d: str) -> DataFrame:
    out = reconcile.stale_reasons(_sidecars(s, d)).where(F.size("reasons") > 0)
    return out.select("doc_id", "image_mismatch", "prompt_mismatch", "output_mismatch", F.size("reasons").alias("n_reasons"), F.array_join("reasons", ",").alias("reasons"))


def page_is_valid_flags(s: SparkSession, d: str) -> DataFrame:
    fences = F.regexp_count("text", F.lit("```")) % 2 == 1
    return reconcile.stale_reasons(_sidecars(s, d)).select("doc_id", reconcile.is_valid(fences).alias("valid"))


def page_gaps(s: SparkSession, d: str) -> DataFrame:
    units = table(s, d, "conversations").where("turn % 3 <> 1").select("conv_id", "turn")
    return reconcile.gaps(units, "conv_id", "turn").select("conv_id", F.col("turn").alias("missing_turn"))


def page_bounds(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "conversations").groupBy("conv_id").agg(F.min("turn").alias("first"), F.max("turn").alias("last"), F.count("*").alias("n"))


def progress_status(s: SparkSession, d: str) -> DataFrame:
    both = table(s, d, "documents").select("doc_id").join(table(s, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    out = both.agg(F.count("*").alias("total"), F.count_if(F.col("quality") == 1).alias("validated"))
    left = F.col("total") - F.col("validated")
    return out.select("total", "validated", left.alias("remaining"), ((F.col("total") > 0) & (left == 0)).alias("complete"))


def interval_median_last20(s: SparkSession, d: str) -> DataFrame:
    return reconcile.recent_intervals(table(s, d, "events"), "user_id", "ts", under=86400.0)


def eta_seconds(s: SparkSession, d: str) -> DataFrame:
    left = table(s, d, "events").groupBy("user_id").agg(F.greatest(F.lit(100) - F.count("*"), F.lit(0)).alias("remaining"))
    both = interval_median_last20(s, d).join(left, "user_id")
    return both.select("user_id", "remaining", reconcile.eta_seconds(F.col("median_seconds"), F.col("remaining")).alias("eta_seconds"))


def resume_state(s: SparkSession, d: str) -> DataFrame:
    c = table(s, d, "conversations")
    outputs = c.where("conv_id % 3 <> 0 OR turn < 3").groupBy("conv_id", F.floor(F.col("turn") / 2).alias("index")).agg(F.count_if(F.col("conv_id") % 2 == 0).alias("done"))
    totals = c.groupBy("conv_id", F.floor(F.col("turn") / 2).alias("index")).agg(F.count("*").alias("total"))
    return reconcile.resume_state(outputs, totals, "conv_id")


def paragraph_split(s: SparkSession, d: str) -> DataFrame:
    rows = pp.split_lines(table(s, d, "documents").select("doc_id", "text"), name="para")
    return rows.select("doc_id", "para_no", F.length("para").alias("n_chars"), F.sha2("para", 256).alias("para_sha"))


def paragraph_split_blank(s: SparkSession, d: str) -> DataFrame:
    rows = pp.split_paragraphs(fx.BOOKS.df(s), "md", drop_blank=True)
    return rows.select("book_id", "para_no", F.length("para").alias("n_chars"))


def h1_sections(s: SparkSession, d: str) -> DataFrame:
    return pp.sections(fx.BOOKS.df(s), "md").select("book_id", "section_no", "title", F.length("body").alias("n_chars"))


def batch_slices(s: SparkSession, d: str) -> DataFrame:
    rows = pp.split_lines(table(s, d, "documents").select("doc_id", "text"), name="para")
    return rows.groupBy("doc_id", pp.batch_number(F.col("para_no")).alias("batch_no")).agg(F.count("*").alias("n_paras"))


def _chunks(s: SparkSession, d: str) -> DataFrame:
    rows = pp.split_lines(table(s, d, "documents").select("source", "doc_id", "text"), name="para")
    sized = rows.select("source", "doc_id", "para_no", F.length("para").alias("n"))
    return pp.pack_greedily(sized, "source", ["doc_id", "para_no"], "n", CHUNK_CHARS)


def book_chunks(s: SparkSession, d: str) -> DataFrame:
    n = F.count("*")
    return _chunks(s, d).groupBy("source", "chunk_no").agg(n.alias("n_paras"), (F.sum("n") + 2 * (n - 1)).alias("n_chars"))


def chunk_stats(s: SparkSession, d: str) -> DataFrame:
    return book_chunks(s, d).groupBy("source").agg(F.count("*").alias("chunks"), F.max("n_chars").alias("largest"), F.sum("n_paras").alias("n_paras"))


def largest_paragraph(s: SparkSession, d: str) -> DataFrame:
    rows = pp.split_lines(table(s, d, "documents").select("source", "text"), name="para")
    return rows.groupBy("source").agg(F.max(F.length("para")).alias("largest"))


def content_hash(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").select("doc_id", F.sha2("text", 256).alias("sha"))


def content_normalize(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").select("doc_id", F.sha2(normal_content(F.col("text")), 256).alias("sha"), F.length(normal_content(F.col("text"))).alias("n"))


def ordered_concat(s: SparkSession, d: str) -> DataFrame:
    out = pp.ordered_text(table(s, d, "conversations"), "conv_id", "turn", "text")
    return out.select("conv_id", F.length("text").alias("n_chars"), F.sha2("text", 256).alias("sha"))


def long_paragraph_split(s: SparkSession, d: str) -> DataFrame:
    rows = pp.split_lines(table(s, d, "documents").select("doc_id", "text"), name="para")
    cut = rows.select("doc_id", "para_no", F.posexplode(pg.split_long(F.col("para"))).alias("piece_no", "piece"))
    return cut.select("doc_id", "para_no", "piece_no", F.length("piece").alias("n_chars"), F.sha2("piece", 256).alias("piece_sha"))


def split_conservation(s: SparkSession, d: str) -> DataFrame:
    """Hash of a document put together from the pieces of its paragraphs, white space apart: nothing else is lost by splitting."""
    rows = table(s, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("para_no", "para"))
    bare = F.regexp_replace(F.array_join(pg.split_long(F.col("para")), ""), r"(?U)\s", "")
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("para_no", "bare"))), lambda x: x["bare"]), "")
    return rows.select("doc_id", "para_no", bare.alias("bare")).groupBy("doc_id").agg(F.sha2(whole, 256).alias("bare_sha"))


def ocr_resume(s: SparkSession, d: str) -> DataFrame:
    """Documents that a rerun sends again: those without an ok result, or changed since."""
    t = table(s, d, "documents").select("doc_id", "text")
    done = t.where("doc_id % 2 = 0").select("doc_id", F.when(F.col("doc_id") % 10 == 0, "failed").otherwise("ok").alias("status"), F.sha2(F.when(F.col("doc_id") % 6 == 0, F.concat("text", F.lit("~"))).otherwise(F.col("text")), 256).alias("input_sha256"))
    return providers.pending(t, done, ["doc_id"], "text").select("doc_id")


def stub(request: str) -> providers.Answer:
    """A provider that echoes requests, refuses some and cuts some off."""
    if len(request) % 17 == 0:
        return providers.Answer("__PROHIBITED_CONTENT__")
    if len(request) % 13 == 0:
        return providers.Answer(request[:10], "MAX_TOKENS")
    if len(request) % 11 == 0:
        raise TimeoutError("timed out")
    return providers.Answer(request)


def dead_letter(s: SparkSession, d: str) -> DataFrame:
    got = providers.recognise(table(s, d, "documents").select("doc_id", "text"), ["doc_id"], "text", stub, check=lambda t: [])
    return got.where("status <> 'ok'").select("doc_id", "status", "error", "attempts")


QUERIES = {
    f.__name__: f
    for f in (
        coverage_missing, coverage_extra, coverage_report, stale_reasons, page_is_valid_flags, page_gaps, page_bounds, progress_status, interval_median_last20, eta_seconds, resume_state, paragraph_split, paragraph_split_blank,
        h1_sections, batch_slices, book_chunks, chunk_stats, largest_paragraph, content_hash, content_normalize, ordered_concat, long_paragraph_split, split_conservation, ocr_resume, dead_letter,
    )
}

_LINES = "(SELECT doc_id, source, unnest(string_split(text, chr(10))) AS para, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS para_no FROM documents)"
_MEDIAN = """
WITH t AS (SELECT user_id, epoch_us(ts) AS t FROM events), d AS (SELECT user_id, t, (t - lag(t) OVER (PARTITION BY user_id ORDER BY t)) / 1e6::DOUBLE AS d FROM t),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY t DESC) AS r FROM d WHERE d > 0 AND d < 86400),
m AS (SELECT user_id, count(*) AS n_intervals, median(d) AS median_seconds FROM r WHERE r <= 20 GROUP BY 1)
"""
_CHUNKS = f"""
WITH RECURSIVE p AS (
  SELECT source, length(para) AS n, row_number() OVER (PARTITION BY source ORDER BY doc_id, para_no) AS i FROM {_LINES}
), f AS (
  SELECT source, i, n, 1::BIGINT AS chunk_no, n::BIGINT AS used FROM p WHERE i = 1
  UNION ALL
  SELECT p.source, p.i, p.n, CASE WHEN f.used + 2 + p.n <= {CHUNK_CHARS} THEN f.chunk_no ELSE f.chunk_no + 1 END,
    CASE WHEN f.used + 2 + p.n <= {CHUNK_CHARS} THEN f.used + 2 + p.n ELSE p.n END
  FROM f JOIN p ON p.source = f.source AND p.i = f.i + 1
), c AS (SELECT source, chunk_no, count(*) AS n_paras, (sum(n) + 2 * (count(*) - 1))::BIGINT AS n_chars FROM f GROUP BY 1, 2)
"""
_STALE = """
WITH t AS (SELECT doc_id, text, CASE WHEN doc_id % 11 = 0 THEN 'failed' ELSE 'ok' END AS status, doc_id % 13 <> 0 AS validated,
  doc_id % 7 = 0 AS image_mismatch, doc_id % 5 = 0 AS prompt_mismatch, doc_id % 3 = 0 AS output_mismatch FROM documents),
r AS (SELECT *, list_filter([CASE WHEN status <> 'ok' THEN 'status' END, CASE WHEN image_mismatch THEN 'image' END, CASE WHEN prompt_mismatch THEN 'prompt' END, CASE WHEN output_mismatch THEN 'output' END], lambda x: x IS NOT NULL) AS reasons FROM t)
"""
ORACLES = {
    "coverage_missing": "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "coverage_extra": "SELECT doc_id FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)",
    "coverage_report": """SELECT i::BIGINT AS n_images, o::BIGINT AS n_outputs, m::BIGINT AS n_missing, e::BIGINT AS n_extra, m = 0 AND e = 0 AS ok FROM (
      SELECT (SELECT count(DISTINCT doc_id) FROM documents) AS i, (SELECT count(DISTINCT doc_id) FROM labels) AS o,
        (SELECT count(DISTINCT doc_id) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) AS m, (SELECT count(DISTINCT doc_id) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)) AS e)""",
    "stale_reasons": _STALE + "SELECT doc_id, image_mismatch, prompt_mismatch, output_mismatch, len(reasons)::INTEGER AS n_reasons, array_to_string(reasons, ',') AS reasons FROM r WHERE len(reasons) > 0",
    "page_is_valid_flags": _STALE + "SELECT doc_id, length(text) > 0 AND len(reasons) = 0 AND validated AND len(regexp_extract_all(text, '```')) % 2 = 0 AS valid FROM r",
    "page_gaps": """WITH u AS (SELECT conv_id, turn FROM conversations WHERE turn % 3 <> 1), e AS (SELECT conv_id, unnest(generate_series(min(turn), max(turn))) AS missing_turn FROM u GROUP BY 1)
      SELECT e.conv_id, missing_turn FROM e WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.conv_id = e.conv_id AND u.turn = missing_turn)""",
    "page_bounds": "SELECT conv_id, min(turn) AS first, max(turn) AS last, count(*) AS n FROM conversations GROUP BY 1",
    "progress_status": """SELECT total, validated, total - validated AS remaining, total > 0 AND total = validated AS complete FROM (
      SELECT count(*) AS total, count(*) FILTER (quality = 1) AS validated FROM documents LEFT JOIN labels USING (doc_id))""",
    "interval_median_last20": _MEDIAN + "SELECT * FROM m",
    "eta_seconds": _MEDIAN + ", l AS (SELECT user_id, greatest(100 - count(*), 0) AS remaining FROM events GROUP BY 1) SELECT user_id, remaining, median_seconds * remaining * 1.15::DOUBLE AS eta_seconds FROM m JOIN l USING (user_id)",
    "resume_state": """WITH c AS (SELECT *, turn // 2 AS index FROM conversations), o AS (SELECT conv_id, index, count(*) FILTER (conv_id % 2 = 0) AS done FROM c WHERE conv_id % 3 <> 0 OR turn < 3 GROUP BY 1, 2),
      t AS (SELECT conv_id, index, count(*) AS total FROM c GROUP BY 1, 2), m AS (SELECT conv_id, max(index) AS max_idx, arg_max(done, index) AS done FROM o GROUP BY 1), j AS (SELECT m.*, coalesce(total, 0) AS total FROM m LEFT JOIN t ON t.conv_id = m.conv_id AND t.index = max_idx)
      SELECT conv_id, max_idx, done, total, CASE WHEN done < total THEN max_idx ELSE max_idx + 1 END AS next_idx, CASE WHEN done < total THEN done ELSE 0 END AS next_para FROM j""",
    "paragraph_split": f"SELECT doc_id, para_no::INTEGER AS para_no, length(para)::INTEGER AS n_chars, sha256(para) AS para_sha FROM {_LINES}",
    "paragraph_split_blank": f"""WITH p AS (SELECT book_id, list_filter(regexp_split_to_array(trim(replace(md, chr(13) || chr(10), chr(10)), ' ' || chr(10) || chr(9)), '\\n\\s*\\n'), lambda x: trim(x) <> '') AS ps FROM {fx.BOOKS.sql()})
      SELECT book_id, (generate_subscripts(ps, 1) - 1)::INTEGER AS para_no, length(unnest(ps))::INTEGER AS n_chars FROM p""",
    "h1_sections": f"""WITH l AS (SELECT book_id, unnest(string_split(replace(md, chr(13) || chr(10), chr(10)), chr(10))) AS line, generate_subscripts(string_split(replace(md, chr(13) || chr(10), chr(10)), chr(10)), 1) AS i FROM {fx.BOOKS.sql()}),
      s AS (SELECT *, sum(CASE WHEN regexp_matches(line, '^#[ \\t]+') THEN 1 ELSE 0 END) OVER (PARTITION BY book_id ORDER BY i) AS k, max(CASE WHEN regexp_matches(line, '^#[ \\t]+') THEN 1 ELSE 0 END) OVER (PARTITION BY book_id) AS has FROM l)
      SELECT book_id, greatest(k, 1)::INTEGER AS section_no, trim(regexp_extract(max(line) FILTER (k >= 1 AND i = i0), '^#[ \\t]+(.*)$', 1)) AS title, length(string_agg(line, chr(10) ORDER BY i))::INTEGER AS n_chars
      FROM (SELECT *, min(i) FILTER (regexp_matches(line, '^#[ \\t]+')) OVER (PARTITION BY book_id, greatest(k, 1)) AS i0 FROM s WHERE has = 1) GROUP BY 1, 2""",
    "batch_slices": f"SELECT doc_id, (para_no // 5)::BIGINT AS batch_no, count(*) AS n_paras FROM {_LINES} GROUP BY 1, 2",
    "book_chunks": _CHUNKS + "SELECT * FROM c",
    "chunk_stats": _CHUNKS + "SELECT source, count(*) AS chunks, max(n_chars) AS largest, sum(n_paras)::BIGINT AS n_paras FROM c GROUP BY 1",
    "largest_paragraph": f"SELECT source, max(length(para))::INTEGER AS largest FROM {_LINES} GROUP BY 1",
    "content_hash": "SELECT doc_id, sha256(text) AS sha FROM documents",
    "content_normalize": r"SELECT doc_id, sha256(regexp_replace(text, '[\p{P}\s]', '', 'g')) AS sha, length(regexp_replace(text, '[\p{P}\s]', '', 'g'))::INTEGER AS n FROM documents",
    "ordered_concat": "SELECT conv_id, length(t)::INTEGER AS n_chars, sha256(t) AS sha FROM (SELECT conv_id, string_agg(text, chr(10) || chr(10) ORDER BY turn) AS t FROM conversations GROUP BY 1)",
    "split_conservation": "SELECT doc_id, sha256(regexp_replace(text, '\\s', '', 'g')) AS bare_sha FROM documents",
    "ocr_resume": "SELECT doc_id FROM documents WHERE doc_id % 2 <> 0 OR doc_id % 10 = 0 OR doc_id % 6 = 0",
}
