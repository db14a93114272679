"""Queries over calls of providers: responses, outcomes, chains, renders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirekit.functions import providers as pv
from quirekit.operators import pages, providers, stages
from quirekit.plans import fixtures as fx
from quirekit.plans.fixtures import Fixture
from quirekit.session import table
from quirekit.sources import files as sources

RESPONSES = Fixture(
    "id int, response string",
    (
        (1, '{"choices": [{"finish_reason": "stop", "message": {"content": " text "}}]}'), (2, '{"choices": [{"finishReason": "MAX_TOKENS", "message": {"content": [{"type": "text", "text": "one"}, {"type": "x"}, {"text": "two"}]}}]}'), (3, '{"choices": []}'),
        (4, "not json"), (5, '{"choices": [{"message": {"content": null}}, {"finish_reason": "x", "message": {"content": "second"}}]}'), (6, '{"error": 1}'),
    ),
)
HTML_PAGES = Fixture("page_no int, md string", ((1, "a\n<TABLE class='table-dense'><tr><td>1 < 2</td></tr></TABLE>\nb"), (2, "<table><tr><td>a</tr></table>"), (3, "plain <b>"), (4, "<div class='table-wrap'><table><!-- c --><tr><th>x</th></tr></table></div>\n\nend")))
CHAIN = Fixture("book_id string, page_no int, md string", (("a", 1, "| a | b |\n| --- | --- |\n| 1 | 2 |"), ("a", 2, "plain"), ("a", 3, "next"), ("b", 1, "| c | d |\n| --- | --- |\n| 1 | 2 |"), ("b", 3, "after a gap"), ("c", 1, "refuse"), ("c", 2, "last")))
SIZES = Fixture("id int, w int, h int", ((1, 3000, 1500), (2, 100, 4000), (3, 800, 600), (4, 1600, 1600), (5, 1601, 3), (6, 100000, 1)))
BATCH = Fixture("file_no int, para_no int, para string", tuple((f, i, f"{f} para {i}" if (f, i) != (1, 4) else "refuse me") for f in (1, 2) for i in range(1, 8)))


def response_texts(s: SparkSession, d: str) -> DataFrame:
    return RESPONSES.df(s).select("id", pv.parse_response(F.col("response")).alias("r")).select("id", "r.*")


def sanitized_pages(s: SparkSession, d: str) -> DataFrame:
    return HTML_PAGES.df(s).select("page_no", pages.sanitize_page(F.col("md")).alias("p")).select("page_no", "p.*")


def upper_stub(request: str) -> providers.Answer:
    """Echoes a request, but ends one that says so with a filter's reason."""
    return providers.Answer(request, "CONTENT_FILTER" if "refuse" in request else "stop")


def read_in_order(s: SparkSession, d: str) -> DataFrame:
    return providers.recognise_in_order(CHAIN.df(s), upper_stub, check=lambda t: []).select("book_id", "page_no", "status", "context", "text")


def page_records(s: SparkSession, d: str) -> DataFrame:
    """The record of each document read by the stub: hashes, model, profile, finish reason."""
    got = providers.recognise(table(s, d, "documents").where("text is not null").select("doc_id", "text"), ["doc_id"], "text", upper_stub, check=lambda t: [], prompt="read it", model="m1", profile="main")
    return got.select("doc_id", "status", "finish_reason", "input_sha256", "output_sha256", "prompt_sha256", "model", "profile")


def rejected_outputs(s: SparkSession, d: str) -> DataFrame:
    """Outputs that were refused, kept beside their error."""
    got = providers.recognise(fx.TABLES.df(s), ["page_no"], "md", lambda r: providers.Answer(r), attempts=2)
    return got.where("status = 'failed'").select("page_no", "error", "attempts", "rejected")


def scaled_sizes(s: SparkSession, d: str) -> DataFrame:
    return SIZES.df(s).select("id", sources.scaled(F.col("w"), F.col("h"), 1600).alias("z")).select("id", "z.*")


def translate_stub(request: str) -> providers.Answer:
    """Two lines a paragraph; whole batches that hold a paragraph to refuse fail."""
    if "refuse" in request:
        raise TimeoutError("timed out")
    return providers.Answer("".join(f"{p}\n> T {p}\n---\n" for p in request.split("\n\n")))


def translated(s: SparkSession, d: str) -> DataFrame:
    return stages.translate(BATCH.df(s), translate_stub).select("file_no", "para_no", "target", "status")


def translated_documents(s: SparkSession, d: str) -> DataFrame:
    """Turns of conversations translated in batches by the stub."""
    turns = table(s, d, "conversations").where("text is not null").select("conv_id", "turn", F.regexp_replace("text", r"\s+", " ").alias("text")).where(F.trim("text") != "")
    return stages.translate(turns, translate_stub, key="conv_id", order="turn", text="text").select("conv_id", "turn", "target", "status")


QUERIES = {f.__name__: f for f in (response_texts, sanitized_pages, read_in_order, page_records, rejected_outputs, scaled_sizes, translated, translated_documents)}

_NL = lambda c: f"replace({c}, '~', chr(10))"
ORACLES = {
    "response_texts": f"""WITH j AS (SELECT id, CASE WHEN json_valid(response) THEN response::JSON END AS j FROM {RESPONSES.sql()}), c AS (SELECT id, j->'$.choices[0]' AS c FROM j)
      SELECT id, trim(coalesce(CASE WHEN json_type(c, '$.message.content') = 'ARRAY' THEN array_to_string(list_filter(c->>'$.message.content[*].text', lambda x: x IS NOT NULL), chr(10)) ELSE c->>'$.message.content' END, '')) AS text,
        coalesce(c->>'$.finish_reason', c->>'$.finishReason', '') AS finish_reason FROM c""",
    "page_records": """SELECT doc_id, CASE WHEN contains(text, 'refuse') THEN 'prohibited' ELSE 'ok' END AS status, CASE WHEN contains(text, 'refuse') THEN 'CONTENT_FILTER' ELSE 'stop' END AS finish_reason, sha256(text) AS input_sha256,
      CASE WHEN NOT contains(text, 'refuse') THEN sha256(text) END AS output_sha256, sha256('read it') AS prompt_sha256, 'm1' AS model, 'main' AS profile FROM documents WHERE text IS NOT NULL""",
    "scaled_sizes": f"SELECT id, greatest(1, floor(w * f))::INTEGER AS width, greatest(1, floor(h * f))::INTEGER AS height FROM (SELECT *, least(1.0::DOUBLE, 1600::DOUBLE / w, 1600::DOUBLE / h) AS f FROM {SIZES.sql()})",
    "translated": f"SELECT file_no, para_no, CASE WHEN NOT contains(para, 'refuse') THEN 'T ' || para END AS target, CASE WHEN contains(para, 'refuse') THEN 'failed' ELSE 'ok' END AS status FROM {BATCH.sql()}",
    "translated_documents": "SELECT conv_id, turn, 'T ' || regexp_replace(text, '\\s+', ' ', 'g') AS target, 'ok' AS status FROM conversations WHERE trim(regexp_replace(text, '\\s+', ' ', 'g')) <> ''",
    # fixed results worked out by hand; ~ stands for a line end
    "sanitized_pages": f"""SELECT page_no, {_NL('md')} AS md, error FROM (VALUES (1, 'a~<table class="table-dense"><tr><td>1 &lt; 2</td></tr></table>~b', NULL), (2, NULL, '</tr> doesn''t close <td>'), (3, 'plain <b>', NULL),
      (4, '<div class="table-wrap"><table><tr><th>x</th></tr></table></div>~~end', NULL)) AS v(page_no, md, error)""",
    "read_in_order": f"""SELECT book_id, page_no, status, {_NL('context')} AS context, {_NL('t')} AS text FROM (VALUES ('a', 1, 'ok', '', '| a | b |~| --- | --- |~| 1 | 2 |'), ('a', 2, 'ok', '| a | b |~| --- | --- |', 'plain~~| a | b |~| --- | --- |'), ('a', 3, 'ok', '| a | b |~| --- | --- |', 'next~~| a | b |~| --- | --- |'),
      ('b', 1, 'ok', '', '| c | d |~| --- | --- |~| 1 | 2 |'), ('b', 3, 'ok', '', 'after a gap'), ('c', 1, 'prohibited', '', NULL), ('c', 2, 'ok', '', 'last')) AS v(book_id, page_no, status, context, t)""",
    "rejected_outputs": f"SELECT t.page_no, v.error, 2 AS attempts, t.md AS rejected FROM {fx.TABLES.sql()} t JOIN (VALUES (1, 'line 2: no separator in the second row'), (2, 'line 1: rows of 1, 2 cells; line 5: pipe table of one row'), (4, 'line 1: no separator in the second row')) v(page_no, error) USING (page_no)",
}
