"""Queries over listings, sidecars, settings, lines and names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quirekit.functions import providers as pv
from quirekit.functions import text as tx
from quirekit.operators import config, listing, pages, paragraphs, providers, stages
from quirekit.plans import fixtures as fx
from quirekit.plans.fixtures import FIGURE, Fixture
from quirekit.session import table
from quirekit.sources import files as sources

FILES = Fixture(
    "name string",
    (("10.jpg",), ("2.JPG",), ("007.webp",), ("cover.png",), ("3.md",), ("12.md",), ("12.fail.md",), ("14.fail.md",), ("1.Intro.md",), ("02.Old.md",), ("20.The end.md",), ("notes.md",), ("5b.md",), ("33",), ("a.tiff",), ("4.meta.json",), ("15.partial.md",)),
)
RANGES = Fixture("id int, first int, last int, pages int", ((1, 0, 9, 10), (2, -1, 3, 10), (3, 5, 4, 10), (4, 0, 10, 10), (5, -2, -3, 1)))
METAS = Fixture(
    "page_no int, meta string",
    ((1, '{"status": "ok", "validated": true, "output_sha256": "aa"}'), (2, "{broken"), (3, '{"status": "failed", "validated": false}'), (4, "[]"), (5, ""), (6, '{"status": "ok", "validated": true, "model": "m1", "more": 1}')),
)
POINTERS = Fixture("id int, text string", ((1, "\n  \n /data/book one \nnext"), (2, "x"), (3, " \n\t\n"), (4, "a\r\nb")))
SECRETS = Fixture("text string", (("model = \"top\"\nprofiles = main,backup\n[main]\nbase_url = 'https://a.example'\napi_key = k1\nmodel = \"m 1\"\n\n[back-up]\nbase_url = https://b.example\napi_key=\n",),))
SETTINGS = Fixture(
    "profile string, place string, key string, value string",
    (("main", "section", "base_url", "https://a.example"), ("main", "named", "base_url", " https://n.example "), ("main", "section", "api_key", "k1"), ("main", "legacy", "model", "m0"), ("main", "named", "model", ""), ("back-up", "section", "api_key", "k2"), ("default", "legacy", "base_url", "https://l.example"), ("default", "legacy", "api_key", "k3"), ("default", "legacy", "model", "m3"), ("other", "elsewhere", "model", "x")),
)
RUNS = Fixture("id int, max_tokens int, jpeg_quality int", ((1, 256, 92), (2, 255, 1), (3, 8192, 0), (4, 1, 101), (5, 300, 100)))
PROMPTS = Fixture("id int, text string", ((1, "  do it \n"), (2, " \n "), (3, None), (4, "x")))
LINES = Fixture(
    "id int, line string",
    ((1, "| a | b |"), (2, "|---|---|"), (3, " --- | :---: "), (4, "a | b | c"), (5, "这是一段很长的中文文字 | b | c"), (6, "plain"), (7, "<table class='x'>"), (8, "  </TR>"), (9, '<div class="table-wrap">'), (10, "</div>"), (11, "<div>x</div>"), (12, "<td>a"), (13, "<thing>"), (14, "x" * 41 + " | b | c"), (15, "|"), (16, "a|b")),
)
WORDS = Fixture("id int, text string", ((1, "  a  b\n c "), (2, "x" * 60), (3, ""), (4, None), (5, "y" * 50), (6, "What? A/b:c*"), (7, " ? "), (8, "a\tb|c")))
RESETS = Fixture(
    "id int, text string",
    ((1, '{\\"retryDelay\\": \\"1m1.2s\\"}'), (2, '"quotaResetTimeStamp": "2024-05-01T00:01:30Z"'), (3, '{\\"quotaResetTimeStamp\\":\\"2024-05-01T01:00:00+00:00\\"}'), (4, '"quotaResetTimeStamp": "2024-04-30T23:59:00Z"'), (5, '"quotaResetTimeStamp": "soon"'), (6, '{\\"quotaResetDelay\\":\\"2h\\"} "retryDelay": "bad"'), (7, "reset after 3.5s"), (8, '"retryDelay": "x" "quotaResetTimeStamp": "2024-05-01T00:00:00.5Z"')),
)
REASON_TEXTS = Fixture("id int, text string", ((1, 'err {"finishReason" : "FinishReason.SAFETY"}'), (2, "{'finishReason': 'stop'}"), (3, "finishReason=MAX_TOKENS, x"), (4, "no reason"), (5, None)))
TRIES = Fixture("attempt int, trouble boolean", tuple((i, t) for i in range(1, 6) for t in (True, False)))
FIGURES = Fixture("page_no int, md string", ((1, f"a {FIGURE}️ 12.jpg b {FIGURE} figures/3-1.jpg"), (2, f"{FIGURE}️ img\\7.png"), (3, "none"), (4, f"{FIGURE}️ figures\\4-1.jpg"), (5, f"{FIGURE}️ x/y.webp {FIGURE}️ figures/8.jpg")))
LOG = Fixture("book_id string, stage string, status string, updated_at long", (("a", "scan", "done", 1), ("a", "read", "failed", 2), ("a", "read", "done", 3), ("b", "scan", "done", 1), ("b", "merge", "done", 9), ("c", "scan", "failed", 1), ("d", "scan", "done", 1), ("d", "read", "done", 1), ("d", "merge", "done", 1)))


def image_listing(s: SparkSession, d: str) -> DataFrame:
    rows = listing.image_listing(FILES.df(s))
    return rows.select("name", "page_no", F.row_number().over(Window.orderBy(*tx.number_key(F.col("name")))).alias("place"))


def image_range(s: SparkSession, d: str) -> DataFrame:
    return listing.image_listing(FILES.df(s), 3, 10).select("name", "page_no")


def numeric_pages(s: SparkSession, d: str) -> DataFrame:
    return listing.numeric_pages(FILES.df(s)).select("name", "page_no")


def numbered_markdown(s: SparkSession, d: str) -> DataFrame:
    return listing.numbered_markdown(FILES.df(s)).select("name", "section_no")


def result_files(s: SparkSession, d: str) -> DataFrame:
    return listing.result_files(FILES.df(s)).select("name", "file_no")


def file_numbers(s: SparkSession, d: str) -> DataFrame:
    return FILES.df(s).select("name", listing.leading_number(F.col("name")).alias("number"), listing.numeric_stem(F.col("name")).alias("stem"))


def highest_output(s: SparkSession, d: str) -> DataFrame:
    return listing.highest_output(FILES.df(s))


def range_errors(s: SparkSession, d: str) -> DataFrame:
    return RANGES.df(s).select("id", F.explode(listing.range_errors(F.col("first"), F.col("last"), F.col("pages"))).alias("error"))


def stale_images(s: SparkSession, d: str) -> DataFrame:
    return listing.stale_images(FILES.df(s), s.range(2, 8).withColumnRenamed("id", "page_no")).select("name", "page_no")


def heading_gate(s: SparkSession, d: str) -> DataFrame:
    return listing.heading_gate(fx.BOOKS.df(s))


def sidecar_fields(s: SparkSession, d: str) -> DataFrame:
    m = sources.sidecar(F.col("meta"))
    return METAS.df(s).select("page_no", m["status"].alias("status"), m["validated"].alias("validated"), m["model"].alias("model"), m["output_sha256"].alias("output_sha256"))


def pointer_targets(s: SparkSession, d: str) -> DataFrame:
    return POINTERS.df(s).select("id", sources.first_filled_line(F.col("text")).alias("target"))


def secret_settings(s: SparkSession, d: str) -> DataFrame:
    return config.secrets(SECRETS.df(s))


def provider_profiles(s: SparkSession, d: str) -> DataFrame:
    return config.listed(config.profiles(SETTINGS.df(s)))


def setting_errors(s: SparkSession, d: str) -> DataFrame:
    return RUNS.df(s).select("id", F.explode(config.setting_errors(F.col("max_tokens"), F.col("jpeg_quality"))).alias("error"))


def prompt_defaults(s: SparkSession, d: str) -> DataFrame:
    return PROMPTS.df(s).select("id", config.prompt_or(F.col("text"), "read the page").alias("prompt"))


def line_kinds(s: SparkSession, d: str) -> DataFrame:
    c = F.col("line")
    return LINES.df(s).select("id", tx.is_pipe_line(c).alias("pipe"), tx.is_tableish(c).alias("tableish"), tx.is_table_markup(c).alias("markup"))


def preview_lines(s: SparkSession, d: str) -> DataFrame:
    return WORDS.df(s).select("id", tx.preview(F.col("text")).alias("preview"), tx.safe_name(F.col("text")).alias("file"))


def chunk_preview(s: SparkSession, d: str) -> DataFrame:
    """The first five paragraphs of each document, cut to 60 characters."""
    rows = paragraphs.split_lines(table(s, d, "documents").select("doc_id", "text"), name="para").where("para_no < 5")
    return rows.select("doc_id", "para_no", F.substring("para", 1, 60).alias("preview"))


def mime_types(s: SparkSession, d: str) -> DataFrame:
    return FILES.df(s).select("name", pv.mime_type(F.col("name")).alias("mime"))


def reset_delay(s: SparkSession, d: str) -> DataFrame:
    now = F.lit("2024-05-01 00:00:00").cast("timestamp") if s.conf.get("spark.sql.session.timeZone") == "UTC" else F.timestamp_seconds(F.lit(1714521600))
    return RESETS.df(s).select("id", pv.retry_delay(F.col("text"), now).alias("seconds"))


def reason_in_error(s: SparkSession, d: str) -> DataFrame:
    return REASON_TEXTS.df(s).select("id", pv.reason_in(F.col("text")).alias("reason"))


def backoff(s: SparkSession, d: str) -> DataFrame:
    return TRIES.df(s).select("attempt", "trouble", pv.backoff_seconds(F.col("attempt"), F.col("trouble")).alias("seconds"))


def crop_needs(s: SparkSession, d: str) -> DataFrame:
    from quirekit.operators import assets, figures

    tokens = F.regexp_extract_all(F.col("md"), F.lit(assets.FIGURE_TOKEN), F.lit(1))
    return FIGURES.df(s).where(F.col("md").contains(FIGURE)).select("page_no", F.explode(figures.needs_crop(tokens)).alias("token"))


def page_requests(s: SparkSession, d: str) -> DataFrame:
    """What is sent for each page of the tables: prompt, name and the header of the table on the page before."""
    rows = providers.table_context(fx.TABLES.df(s).withColumn("book_id", F.lit("b")), "book_id", "page_no", "md")
    return rows.select("page_no", "context", tx.join_prompt(F.lit(" read it "), F.format_string("%d.jpg", F.col("page_no")), F.col("context")).alias("request"))


def stage_state(s: SparkSession, d: str) -> DataFrame:
    return stages.runnable(LOG.df(s), ["scan", "read", "merge"])


def latest_records(s: SparkSession, d: str) -> DataFrame:
    return providers.latest(LOG.df(s), ["book_id", "stage"], "updated_at").select("book_id", "stage", "status")


def missing_sidecar(s: SparkSession, d: str) -> DataFrame:
    from quirekit.operators import reconcile

    return reconcile.missing(table(s, d, "documents").where("doc_id % 2 = 0").select("doc_id"), table(s, d, "labels").where("quality = 1"), "doc_id")


def dead_letter_status(s: SparkSession, d: str) -> DataFrame:
    """Status and attempts of each document with the stub provider, worked out by the same rule in SQL."""
    from quirekit.plans.books import stub

    return providers.recognise(table(s, d, "documents").select("doc_id", "text"), ["doc_id"], "text", stub, check=lambda t: []).select("doc_id", "status", "attempts", "output_sha256")


def table_blocks(s: SparkSession, d: str) -> DataFrame:
    return pages.html_tables(fx.CONTINUED.df(s), ["book_id", "page_no"]).select("book_id", "page_no", "table_no", F.length("block").alias("n_chars"))


QUERIES = {
    f.__name__: f
    for f in (
        image_listing, image_range, numeric_pages, numbered_markdown, result_files, file_numbers, highest_output, range_errors, stale_images, heading_gate, sidecar_fields, pointer_targets, secret_settings, provider_profiles, setting_errors,
        prompt_defaults, line_kinds, preview_lines, chunk_preview, mime_types, reset_delay, reason_in_error, backoff, crop_needs, page_requests, stage_state, latest_records, missing_sidecar, dead_letter_status, table_blocks,
    )
}

_STEM = "TRY_CAST(nullif(regexp_extract(name, '^([0-9]+)(\\.[^.]*)?$', 1), '') AS BIGINT)"
_EXT = "lower(regexp_extract(name, '\\.([^./]+)$', 1))"
_IMAGES = f"(SELECT name, {_STEM} AS page_no FROM {FILES.sql()} WHERE {_EXT} IN ('jpg', 'jpeg', 'png', 'bmp', 'tif', 'tiff', 'webp'))"
_VALUE = lambda k: f"""nullif(regexp_extract(text, '(?i)\\\\?"{k}\\\\?"\\s*:\\s*\\\\?"([^"\\\\]+)\\\\?"', 1), '')"""
_SECONDS = lambda c: f"""CASE WHEN regexp_matches({c}, '[0-9][hms]') THEN greatest(1, ceil(coalesce(TRY_CAST(nullif(regexp_extract({c}, '([0-9.]+)h', 1), '') AS DOUBLE), 0) * 3600 + coalesce(TRY_CAST(nullif(regexp_extract({c}, '([0-9.]+)m', 1), '') AS DOUBLE), 0) * 60 + coalesce(TRY_CAST(nullif(regexp_extract({c}, '([0-9.]+)s', 1), '') AS DOUBLE), 0))) END"""
_TRIM = lambda c: f"trim({c}, ' ' || chr(9) || chr(10) || chr(13))"
ORACLES = {
    "image_listing": f"SELECT name, page_no, row_number() OVER (ORDER BY page_no IS NULL, coalesce(page_no, 0), lower(name))::INTEGER AS place FROM {_IMAGES}",
    "image_range": f"SELECT name, page_no FROM {_IMAGES} WHERE page_no BETWEEN 3 AND 10",
    "numeric_pages": f"SELECT name, {_STEM} AS page_no FROM {FILES.sql()} WHERE regexp_full_match(name, '[0-9]+\\.md')",
    "numbered_markdown": f"SELECT name, string_split(name, '.')[1]::BIGINT AS section_no FROM {FILES.sql()} WHERE regexp_full_match(name, '[1-9][0-9]*\\..*\\.md')",
    "result_files": f"SELECT name, regexp_extract(name, '^[0-9]+')::BIGINT AS file_no FROM {FILES.sql()} WHERE regexp_matches(name, '^[0-9].*\\.md$')",
    "file_numbers": f"SELECT name, coalesce(TRY_CAST(nullif(regexp_extract(name, '^([0-9]+)\\.', 1), '') AS BIGINT), 1000000000)::BIGINT AS number, {_STEM} AS stem FROM {FILES.sql()}",
    "highest_output": f"SELECT coalesce(max(replace(replace(name, '.md', ''), '.fail', '')::BIGINT), -1)::BIGINT AS highest FROM {FILES.sql()} WHERE regexp_full_match(name, '[0-9]+(\\.fail)?\\.md')",
    "range_errors": f"SELECT id, 'first page below 0' AS error FROM {RANGES.sql()} WHERE first < 0 UNION ALL SELECT id, 'last page before the first' FROM {RANGES.sql()} WHERE last < first UNION ALL SELECT id, 'last page beyond the document' FROM {RANGES.sql()} WHERE last >= pages",
    "stale_images": f"SELECT name, page_no FROM {_IMAGES} WHERE page_no NOT BETWEEN 2 AND 7",
    "heading_gate": f"SELECT book_id, n::INTEGER AS n_h1, n > 0 AS ok FROM (SELECT book_id, len(list_filter(string_split(md, chr(10)), lambda x: starts_with(x, '# '))) AS n FROM {fx.BOOKS.sql()})",
    "sidecar_fields": f"""WITH j AS (SELECT page_no, CASE WHEN json_valid(meta) AND starts_with(meta, '{{') THEN meta::JSON END AS m FROM {METAS.sql()})
      SELECT page_no, m->>'$.status' AS status, (m->>'$.validated')::BOOLEAN AS validated, m->>'$.model' AS model, m->>'$.output_sha256' AS output_sha256 FROM j""",
    "pointer_targets": f"SELECT id, list_filter(list_transform(string_split(replace(text, chr(13), ''), chr(10)), lambda x: {_TRIM('x')}), lambda x: x <> '')[1] AS target FROM {POINTERS.sql()}",
    "secret_settings": f"""WITH l AS (SELECT unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM {SECRETS.sql()}),
      n AS (SELECT *, last_value(replace(nullif(regexp_extract(line, '^\\[(.+)\\]$', 1), ''), '-', '_') IGNORE NULLS) OVER (ORDER BY i ROWS UNBOUNDED PRECEDING) AS section FROM l)
      SELECT coalesce(section, 'default') AS profile, trim(split_part(line, '=', 1)) AS key, trim(trim(split_part(line, '=', 2)), chr(39) || '"') AS value FROM n WHERE contains(line, '=') AND NOT starts_with(line, 'profiles')""",
    "provider_profiles": f"""WITH k AS (SELECT replace(profile, '-', '_') AS profile, key, trim(value) AS v, CASE place WHEN 'named' THEN 1 WHEN 'section' THEN 2 WHEN 'legacy' THEN 3 END AS r FROM {SETTINGS.sql()} WHERE trim(value) <> ''),
      p AS (SELECT profile, coalesce(arg_min(v, r) FILTER (key = 'base_url'), '') AS base_url, coalesce(arg_min(v, r) FILTER (key = 'api_key'), '') AS api_key, coalesce(arg_min(v, r) FILTER (key = 'model'), '') AS model FROM k WHERE r IS NOT NULL GROUP BY 1)
      SELECT profile, base_url, model, api_key <> '' AS has_key, base_url <> '' AND api_key <> '' AND model <> '' AS usable FROM p""",
    "setting_errors": f"SELECT id, 'max_tokens below 256' AS error FROM {RUNS.sql()} WHERE max_tokens < 256 UNION ALL SELECT id, 'jpeg_quality not in 1 to 100' FROM {RUNS.sql()} WHERE jpeg_quality NOT BETWEEN 1 AND 100",
    "prompt_defaults": f"SELECT id, coalesce(nullif({_TRIM('text')}, ''), 'read the page') AS prompt FROM {PROMPTS.sql()}",
    "line_kinds": f"""WITH t AS (SELECT id, trim(line) AS b, len(regexp_extract_all(line, '\\|')) AS n FROM {LINES.sql()}), c AS (SELECT *, list_transform(string_split(trim(b, '|'), '|'), lambda x: trim(x)) AS cells FROM t)
      SELECT id, starts_with(b, '|') AND n >= 2 AS pipe,
        (starts_with(b, '|') AND n >= 2) OR (n >= 1 AND regexp_full_match(replace(b, ' ', ''), '\\|?(:?-{{3,}}:?\\|)+(:?-{{3,}}:?)?')) OR (n >= 2 AND len(list_filter(cells, lambda x: length(x) > 40)) = 0 AND NOT regexp_matches(cells[1], '[\\x{{4e00}}-\\x{{9fff}}]{{8}}')) AS tableish,
        regexp_matches(lower(b), '^</?(table|thead|tbody|tr|th|td)\\b') OR b = '</div>' OR regexp_matches(b, '<div\\b[^>]*table-wrap') AS markup FROM c""",
    "preview_lines": f"""WITH t AS (SELECT id, text, trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g')) AS line FROM {WORDS.sql()})
      SELECT id, CASE WHEN length(line) > 50 THEN substr(line, 1, 47) || '...' ELSE line END AS preview, coalesce(nullif(trim(translate(text, '\\/:*?"<>|' || chr(10), '__________')), ''), 'untitled') AS file FROM t""",
    "chunk_preview": "SELECT doc_id, (g - 1)::INTEGER AS para_no, substr(p[g], 1, 60) AS preview FROM (SELECT doc_id, string_split(text, chr(10)) AS p, unnest(range(1, least(len(string_split(text, chr(10))), 5) + 1)) AS g FROM documents)",
    "mime_types": f"SELECT name, CASE WHEN {_EXT} IN ('png', 'webp', 'bmp') THEN 'image/' || {_EXT} WHEN {_EXT} IN ('tif', 'tiff') THEN 'image/tiff' ELSE 'image/jpeg' END AS mime FROM {FILES.sql()}",
    "reset_delay": f"""WITH v AS (SELECT id, text, {_VALUE('retryDelay')} AS a, {_VALUE('quotaResetDelay')} AS b, nullif(regexp_extract(text, 'reset after ([0-9hms.]+)', 1), '') AS c, TRY_CAST({_VALUE('quotaResetTimeStamp')} AS TIMESTAMPTZ) AS t FROM {RESETS.sql()}),
      w AS (SELECT *, (epoch_us(t) - epoch_us(TIMESTAMPTZ '2024-05-01 00:00:00+00')) / 1e6 AS wait FROM v)
      SELECT id, coalesce({_SECONDS('a')}, {_SECONDS('b')}, {_SECONDS('c')}, CASE WHEN wait > 0 THEN ceil(wait) END)::INTEGER AS seconds FROM w""",
    "reason_in_error": f"""SELECT id, upper(string_split(regexp_extract(coalesce(text, ''), '(?i)[''"]?finishReason[''"]?\\s*[:=]\\s*[''"]?([A-Za-z0-9_.]+)', 1), '.')[-1]) AS reason FROM {REASON_TEXTS.sql()}""",
    "backoff": f"SELECT attempt, trouble, least(2 ** attempt, CASE WHEN trouble THEN 12 ELSE 8 END)::INTEGER AS seconds FROM {TRIES.sql()}",
    "crop_needs": f"""WITH t AS (SELECT page_no, unnest(regexp_extract_all(md, '{FIGURE}\\x{{fe0f}}?\\s*([^\\s]+\\.(?:jpg|jpeg|png|webp))', 1)) AS token FROM {FIGURES.sql()}), p AS (SELECT *, replace(token, '\\', '/') AS path FROM t)
      SELECT page_no, token FROM p WHERE regexp_full_match(string_split(path, '/')[-1], '[0-9]+\\.(jpg|jpeg|png|webp)') OR NOT contains(path, 'figures/')""",
    # headers worked out by hand: a separator needs three dashes in each cell, and one line may stand above it as a title
    "page_requests": f"""WITH x AS (SELECT page_no, replace(c, '/', chr(10)) AS context FROM (VALUES (1, ''), (2, ''), (3, '| a | b |/| --- | --- |'), (4, ''), (5, 'text/  | r | s |/|:---|---:|')) v(page_no, c))
      SELECT t.page_no, x.context, 'read it' || chr(10) || chr(10) || 'Page: ' || t.page_no || '.jpg' || CASE WHEN x.context <> '' THEN chr(10) || chr(10) || 'The page before ends in a table with this header:' || chr(10) || x.context ELSE '' END AS request
      FROM {fx.TABLES.sql()} t JOIN x USING (page_no)""",
    "stage_state": f"""WITH l AS (SELECT book_id, stage, arg_max(status, updated_at) AS status FROM {LOG.sql()} GROUP BY 1, 2), s AS (SELECT b.book_id, v.stage, v.k, l.status FROM (SELECT DISTINCT book_id FROM {LOG.sql()}) b, (VALUES ('scan', 1), ('read', 2), ('merge', 3)) v(stage, k) LEFT JOIN l ON l.book_id = b.book_id AND l.stage = v.stage)
      SELECT book_id, arg_min(stage, k) AS stage FROM s WHERE status IS DISTINCT FROM 'done' GROUP BY 1""",
    "latest_records": f"SELECT book_id, stage, arg_max(status, updated_at) AS status FROM {LOG.sql()} GROUP BY 1, 2",
    "missing_sidecar": "SELECT doc_id FROM documents WHERE doc_id % 2 = 0 AND doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)",
    "dead_letter_status": """WITH t AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n FROM documents)
      SELECT doc_id, CASE WHEN n % 17 = 0 THEN 'prohibited' WHEN n % 13 = 0 OR n % 11 = 0 THEN 'failed' ELSE 'ok' END AS status, CASE WHEN n % 17 <> 0 AND (n % 13 = 0 OR n % 11 = 0) THEN 3 ELSE 1 END AS attempts,
        CASE WHEN n % 17 <> 0 AND n % 13 <> 0 AND n % 11 <> 0 THEN sha256(text) END AS output_sha256 FROM t""",
    "table_blocks": f"SELECT book_id, page_no, 1 AS table_no, length(regexp_extract(md, '(?s)<table.*</table>\\s*'))::INTEGER AS n_chars FROM {fx.CONTINUED.sql()} WHERE contains(md, '<table')",
}
