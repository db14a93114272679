"""Queries over page texts, tables, translations and packages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirekit.functions import providers as pv
from quirekit.functions import text as tx
from quirekit.operators import figures, links, paragraphs, passages, translation
from quirekit.operators import pages as pg
from quirekit.plans import fixtures as fx
from quirekit.session import table


def natural_order(s: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    text, number, name = tx.number_key(F.col("name"))
    return fx.NAMES.df(s).select("name", F.row_number().over(Window.orderBy(text, number, name)).alias("place"))


def max_index(s: SparkSession, d: str) -> DataFrame:
    text, number, _ = tx.number_key(F.col("name"))
    return fx.NAMES.df(s).agg(F.coalesce(F.max(F.when(~text, number)), F.lit(-1)).alias("max_index"))


def error_class(s: SparkSession, d: str) -> DataFrame:
    return fx.ERRORS.df(s).select("id", pv.error_class(F.col("status"), F.col("message")).alias("class"))


def retry_delay(s: SparkSession, d: str) -> DataFrame:
    return fx.DELAYS.df(s).select("id", pv.retry_delay(F.col("text")).alias("seconds"))


def finish_reason_flags(s: SparkSession, d: str) -> DataFrame:
    return fx.REASONS.df(s).select("id", pv.finish_reason(F.col("reason")).alias("reason"), pv.is_truncated(F.col("reason")).alias("truncated"))


def gfm_blocks(s: SparkSession, d: str) -> DataFrame:
    return paragraphs.pipe_tables(fx.TABLES.df(s), "page_no", "md").select("page_no", "start_line", F.size("rows").alias("n_rows"))


def gfm_shape_errors(s: SparkSession, d: str) -> DataFrame:
    b = paragraphs.pipe_tables(fx.TABLES.df(s), "page_no", "md").withColumn("cells", F.transform("rows", tx.pipe_cells))
    few = F.size("rows") < 2
    uneven = ~few & (F.size(F.array_distinct(F.transform("cells", F.size))) > 1)
    return b.select("page_no", "start_line", few.alias("too_few"), uneven.alias("uneven"), (~few & ~tx.is_separator(F.get("cells", F.lit(1)))).alias("bad_separator"))


def separator_rows(s: SparkSession, d: str) -> DataFrame:
    rows = paragraphs.split_lines(fx.TABLES.df(s), "md").where(tx.is_pipe_line(F.col("line")))
    return rows.where(tx.is_separator(tx.pipe_cells(F.col("line")))).select("page_no", (F.col("line_no") + 1).alias("line_no"))


def active_html(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "pages").select("page_id", F.col("html").rlike(tx.ACTIVE_HTML).alias("has_active"))


def page_rules(s: SparkSession, d: str) -> DataFrame:
    """The page rules that SQL can express, one flag each."""
    md = F.col("md")
    closed = F.regexp_replace(md, tx.TABLE_BLOCK, "")
    marks = F.array_join(F.array_compact(F.array(*[F.when(md.contains(m), F.lit(str(i))) for i, m in enumerate(tx.UNRESOLVED_MARKS)])), ",")
    return fx.PAGES.df(s).select(
        "page_no", (tx.strip(md) == "").alias("is_empty"), (F.regexp_count(md, F.lit("```")) % 2 == 1).alias("odd_fences"), closed.rlike(r"(?i)<table\b").alias("unclosed_table"),
        F.regexp_replace(closed, r"(?is)</?sup\b[^>]*>", "").rlike(tx.ACTIVE_HTML).alias("has_active"), marks.alias("marks"),
    )


def page_errors(s: SparkSession, d: str) -> DataFrame:
    both = fx.PAGES.df(s).unionByName(fx.TABLES.df(s).withColumn("page_no", F.col("page_no") + 100))
    return both.select("page_no", F.explode(pg.page_errors(F.col("md"))).alias("error"))


def strip_page_marks(s: SparkSession, d: str) -> DataFrame:
    return fx.MARKED.df(s).select("page_no", tx.strip_page_numbers(F.col("md")).alias("md"))


def clean_page(s: SparkSession, d: str) -> DataFrame:
    return fx.PAGES.df(s).select("page_no", tx.clean_page(F.col("md")).alias("md"))


def merge_suspect(s: SparkSession, d: str) -> DataFrame:
    """Documents that hold a benchmark passage, both without punctuation and white space."""
    normal = lambda name: F.when(F.col("text").isNotNull(), tx.normal_content(F.col("text"))).alias(name)
    found = passages.passages_in(table(s, d, "documents").select("doc_id", normal("text")), table(s, d, "benchmark").select("item_id", normal("passage")))
    return found.select("doc_id", "item_id")


def _two_line(s: SparkSession) -> DataFrame:
    b = translation.blocks(fx.OUTPUTS.df(s), "file_no").where("closed")
    return b.select("file_no", F.col("block_no").alias("para_no"), F.get("kept", F.lit(0)).alias("source"), F.get("kept", F.lit(1)).alias("target"))


def block_structure(s: SparkSession, d: str) -> DataFrame:
    return translation.block_structure(fx.OUTPUTS.df(s), "file_no")


def source_fidelity(s: SparkSession, d: str) -> DataFrame:
    return translation.source_fidelity(fx.EXPECTED.df(s), _two_line(s), "file_no")


def heading_tag_errors(s: SparkSession, d: str) -> DataFrame:
    return translation.heading_errors(fx.EXPECTED.df(s), _two_line(s), "file_no")


def heading_swap(s: SparkSession, d: str) -> DataFrame:
    return fx.BILINGUAL.df(s).select("id", translation.swap_headings(F.col("text")).alias("text"))


def quote_spacing(s: SparkSession, d: str) -> DataFrame:
    return fx.BILINGUAL.df(s).select("id", translation.blank_before_quotes(F.col("text")).alias("text"))


def divider_spacing(s: SparkSession, d: str) -> DataFrame:
    return fx.BILINGUAL.df(s).select("id", translation.blank_around_dividers(F.col("text")).alias("text"))


def link_resolve(s: SparkSession, d: str) -> DataFrame:
    return fx.LINKS.df(s).select("base", "href", links.resolve(F.col("base"), F.col("href")).alias("resolved"))


def missing_links(s: SparkSession, d: str) -> DataFrame:
    found = links.page_links(table(s, d, "pages"), "page_id", "html").withColumn("resolved", links.resolve(F.lit("site/index.html"), F.col("href")))
    names = table(s, d, "pages").select(F.regexp_extract("url", "://[^/]*/([^?#]*)", 1).alias("name")).distinct()
    return links.unresolved(found, names).select("page_id", "href", "resolved")


def marker_counts(s: SparkSession, d: str) -> DataFrame:
    count = lambda p: F.sum(F.regexp_count("text", F.lit(p))).cast("long")
    return table(s, d, "documents").groupBy("source").agg(count(r"\|").alias("pipes"), count("!!").alias("bangs"), count("@").alias("ats"), count(f"{tx.FIGURE_MARK}|{tx.BLANK_MARK}").alias("marks"))


def manifest_missing(s: SparkSession, d: str) -> DataFrame:
    return links.manifest_missing(fx.MANIFEST.df(s), fx.ENTRIES.df(s)).select("book", "id")


def spine_dangling(s: SparkSession, d: str) -> DataFrame:
    return links.spine_dangling(fx.SPINE.df(s), fx.MANIFEST.df(s)).select("book", F.col("idref").alias("id"))


def cover_dup(s: SparkSession, d: str) -> DataFrame:
    return links.cover_duplicates(fx.MANIFEST.df(s))


def entry_errors(s: SparkSession, d: str) -> DataFrame:
    return links.entry_errors(fx.ENTRIES.df(s))


def slug_names(s: SparkSession, d: str) -> DataFrame:
    return links.slug_names(fx.LABELS.df(s)).select("book", "ord", "file")


def merge_sequence(s: SparkSession, d: str) -> DataFrame:
    out = pg.merge_pages(fx.CONTINUED.df(s))
    return out.select("book_id", "page_no", F.sha2("md", 256).alias("md_sha"), "merged_into", "kind")


def merge_transitive(s: SparkSession, d: str) -> DataFrame:
    return pg.merge_pages(fx.CONTINUED.df(s), transitive=True)


def merge_gate(s: SparkSession, d: str) -> DataFrame:
    failed = fx.CONTINUED.df(s).where("book_id = 'note' and page_no = 2")
    return pg.merge_gate(fx.CONTINUED.df(s), failed)


def extract_notes(s: SparkSession, d: str) -> DataFrame:
    return pg.extract_notes(fx.NOTED.df(s))


def table_grid_errors(s: SparkSession, d: str) -> DataFrame:
    return fx.GRIDS.df(s).select("id", F.explode(pg.table_errors(F.col("block"))).alias("error"))


def sanitize_table(s: SparkSession, d: str) -> DataFrame:
    return fx.GRIDS.df(s).select("id", pg.sanitize_table(F.col("block")).alias("t")).select("id", "t.*")


def layout_reflow(s: SparkSession, d: str) -> DataFrame:
    return fx.SECTIONS.df(s).select("id", pg.reflow(F.col("text")).alias("text"))


def inline_token_repair(s: SparkSession, d: str) -> DataFrame:
    return fx.INLINE.df(s).select("id", pg.repair_inline(F.col("text")).alias("r")).select("id", "r.*")


def typeset_paragraphs(s: SparkSession, d: str) -> DataFrame:
    out = table(s, d, "documents").select("doc_id", F.posexplode(pg.typeset_paragraphs(F.regexp_replace("text", "\n", "\n\n"))).alias("para_no", "para"))
    return out.select("doc_id", "para_no", F.length("para").alias("n_chars"))


def table_headers(s: SparkSession, d: str) -> DataFrame:
    return fx.TABLES.df(s).select("page_no", pg.last_header(F.col("md")).alias("header"))


def figure_boxes(s: SparkSession, d: str) -> DataFrame:
    """One dark rectangle, (80, 120) to (320, 360), on a white page of 400 by 600."""
    px = F.transform(F.sequence(F.lit(0), F.lit(400 * 600 - 1)), lambda i: F.when(((i % 400) >= 80) & ((i % 400) < 320) & (i >= 120 * 400) & (i < 360 * 400), 0).otherwise(255))
    return figures.find_figures(s.range(1).select(F.col("id"), F.lit(400).alias("w"), F.lit(600).alias("h"), px.alias("px")))


QUERIES = {
    f.__name__: f
    for f in (
        natural_order, max_index, error_class, retry_delay, finish_reason_flags, gfm_blocks, gfm_shape_errors, separator_rows, active_html, page_rules, page_errors, strip_page_marks, clean_page, merge_suspect,
        block_structure, source_fidelity, heading_tag_errors, heading_swap, quote_spacing, divider_spacing, link_resolve, missing_links, marker_counts, manifest_missing, spine_dangling, cover_dup, entry_errors,
        slug_names, merge_sequence, merge_transitive, merge_gate, extract_notes, table_grid_errors, sanitize_table, layout_reflow, inline_token_repair, typeset_paragraphs, table_headers, figure_boxes,
    )
}

_NAMES = f"(SELECT name, regexp_replace(name, '\\.[^.]*$', '') AS stem FROM {fx.NAMES.sql()})"
_PIPES = f"""(SELECT page_no, i, line FROM (SELECT page_no, unnest(string_split(md, chr(10))) AS line, generate_subscripts(string_split(md, chr(10)), 1) AS i FROM {fx.TABLES.sql()})
  WHERE starts_with(trim(line), '|') AND len(regexp_extract_all(line, '\\|')) >= 2)"""
_BLOCKS = f"""l AS (SELECT page_no, i, string_split(regexp_replace(replace(trim(line), '\\|', chr(1)), '^\\||\\|$', '', 'g'), '|') AS cells, i - row_number() OVER (PARTITION BY page_no ORDER BY i) AS g FROM {_PIPES} p),
  c AS (SELECT *, list_filter(cells, lambda x: NOT regexp_full_match(trim(x), ':?-{{3,}}:?')) AS other FROM l),
  b AS (SELECT page_no, min(i)::INTEGER AS start_line, count(*)::INTEGER AS n_rows, count(DISTINCT len(cells)) AS widths, list(len(other) ORDER BY i)[2] AS second FROM c GROUP BY page_no, g)"""
_OUT = f"""l AS (SELECT file_no, unnest(string_split(output, chr(10))) AS line, generate_subscripts(string_split(output, chr(10)), 1) AS i FROM {fx.OUTPUTS.sql()}),
  q AS (SELECT *, regexp_full_match(line, '\\s*---\\s*') AS sep FROM l),
  n AS (SELECT *, coalesce(sum(sep::INTEGER) OVER (PARTITION BY file_no ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::INTEGER + 1 AS block_no FROM q),
  b AS (SELECT file_no, block_no, bool_or(sep) AS closed, coalesce(list(line ORDER BY i) FILTER (NOT sep AND trim(line) <> ''), []) AS kept FROM n GROUP BY 1, 2)"""
_NORMAL = lambda c: f"regexp_replace({c}, '[\\p{{P}}\\s]', '', 'g')"
_WORDS = lambda words: "|".join(words)
ORACLES = {
    "natural_order": f"SELECT name, row_number() OVER (ORDER BY NOT regexp_full_match(stem, '[0-9]+'), coalesce(TRY_CAST(stem AS BIGINT), 0), lower(name))::INTEGER AS place FROM {_NAMES}",
    "max_index": f"SELECT coalesce(max(TRY_CAST(stem AS BIGINT)), -1) AS max_index FROM {_NAMES}",
    "error_class": f"""SELECT id, CASE WHEN code IN (402, 403) THEN 'exhaust' WHEN code IN (408, 429, 500, 502, 503, 504) THEN 'transient'
      WHEN regexp_matches(lower(message), '{_WORDS(pv.EXHAUSTED_WORDS)}') THEN 'exhaust' WHEN regexp_matches(lower(message), '{_WORDS(pv.TRANSIENT_WORDS)}') THEN 'transient' END AS class
      FROM (SELECT *, coalesce(status, TRY_CAST(nullif(regexp_extract(message, '\\b([45]\\d\\d)\\b', 1), '') AS INTEGER)) AS code FROM {fx.ERRORS.sql()})""",
    "retry_delay": f"""WITH p AS (SELECT id, [nullif(regexp_extract(text, '(?i)"retryDelay"\\s*:\\s*"([^"]+)"', 1), ''), nullif(regexp_extract(text, '(?i)"quotaResetDelay"\\s*:\\s*"([^"]+)"', 1), ''), nullif(regexp_extract(text, '(?i)reset after\\s+([0-9hms.]+)', 1), '')] AS found FROM {fx.DELAYS.sql()}),
      q AS (SELECT id, unnest(found) AS s, generate_subscripts(found, 1) AS k FROM p),
      r AS (SELECT id, k, CASE WHEN regexp_matches(s, '[0-9][hms]') THEN list_sum(list_transform(regexp_extract_all(s, '([0-9]+(\\.[0-9]+)?)h', 1), lambda x: x::DOUBLE * 3600) || list_transform(regexp_extract_all(s, '([0-9]+(\\.[0-9]+)?)m', 1), lambda x: x::DOUBLE * 60) || list_transform(regexp_extract_all(s, '([0-9]+(\\.[0-9]+)?)s', 1), lambda x: x::DOUBLE))
        WHEN regexp_full_match(s, '[0-9]+(\\.[0-9]+)?') THEN s::DOUBLE END AS v FROM q),
      t AS (SELECT id, arg_min(greatest(ceil(v), 1), k) FILTER (v IS NOT NULL) AS seconds FROM r GROUP BY 1)
      SELECT d.id, t.seconds::INTEGER AS seconds FROM {fx.DELAYS.sql()} d LEFT JOIN t USING (id)""",
    "finish_reason_flags": f"SELECT id, string_split(upper(trim(coalesce(reason, ''))), '.')[-1] AS reason, regexp_matches(upper(coalesce(reason, '')), 'LENGTH|MAX_TOKEN|MAX_OUTPUT') AS truncated FROM {fx.REASONS.sql()}",
    "gfm_blocks": f"WITH {_BLOCKS} SELECT page_no, start_line, n_rows FROM b",
    "gfm_shape_errors": f"WITH {_BLOCKS} SELECT page_no, start_line, n_rows < 2 AS too_few, n_rows >= 2 AND widths > 1 AS uneven, n_rows >= 2 AND second > 0 AS bad_separator FROM b",
    "separator_rows": f"WITH {_BLOCKS} SELECT page_no, i::INTEGER AS line_no FROM c WHERE len(other) = 0",
    "active_html": r"SELECT page_id, regexp_matches(html, '(?is)<\s*(script|iframe|object|embed|style|link|meta)\b|\son\w+\s*=') AS has_active FROM pages",
    "page_rules": f"""WITH t AS (SELECT *, regexp_replace(md, '(?is)<table\\b.*?</table>', '', 'g') AS rest FROM {fx.PAGES.sql()})
      SELECT page_no, trim(md, ' ' || chr(10)) = '' AS is_empty, len(regexp_extract_all(md, '```')) % 2 = 1 AS odd_fences, regexp_matches(rest, '(?i)<table\\b') AS unclosed_table,
        regexp_matches(regexp_replace(rest, '(?is)</?sup\\b[^>]*>', '', 'g'), '(?is)<\\s*(script|iframe|object|embed|style|link|meta)\\b|\\son\\w+\\s*=') AS has_active,
        array_to_string(list_filter([CASE WHEN contains(md, '{tx.FIGURE_MARK}') THEN '0' END, CASE WHEN contains(md, '{tx.BLANK_MARK}') THEN '1' END, CASE WHEN contains(md, '{tx.REFUSED_MARK}') THEN '2' END], lambda x: x IS NOT NULL), ',') AS marks FROM t""",
    "strip_page_marks": f"""WITH l AS (SELECT page_no, unnest(string_split(md, chr(10))) AS line, generate_subscripts(string_split(md, chr(10)), 1) AS i FROM {fx.MARKED.sql()}),
      k AS (SELECT *, regexp_replace(line, '[·•‧・．][ \\t\\x{{3000}}]*[0-9０-９]{{1,4}}[ \\t\\x{{3000}}]*[·•‧・．]', '', 'g') AS cut FROM l WHERE NOT regexp_full_match(trim(line), '[·•‧・．][ \\t\\x{{3000}}]*[0-9０-９]{{1,4}}[ \\t\\x{{3000}}]*[·•‧・．]')),
      o AS (SELECT page_no, i, line, regexp_extract(cut, '^[ \\t\\x{{3000}}]*') AS lead, cut FROM k),
      z AS (SELECT page_no, i, line, rtrim(lead || regexp_replace(substr(cut, length(lead) + 1), '[ \\t\\x{{3000}}]{{2,}}', ' ', 'g')) AS out FROM o),
      j AS (SELECT page_no, string_agg(out, chr(10) ORDER BY i) AS md FROM z WHERE NOT (out = '' AND trim(line) <> '') GROUP BY 1)
      SELECT m.page_no, regexp_replace(coalesce(j.md, ''), '\\n{{3,}}', chr(10) || chr(10), 'g') AS md FROM {fx.MARKED.sql()} m LEFT JOIN j USING (page_no)""",
    "clean_page": f"""WITH l AS (SELECT page_no, unnest(string_split(md, chr(10))) AS line, generate_subscripts(string_split(md, chr(10)), 1) AS i FROM {fx.PAGES.sql()}),
      j AS (SELECT page_no, string_agg(CASE WHEN trim(line) = '' THEN '' ELSE line END, chr(10) ORDER BY i) FILTER (NOT contains(line, '{tx.BLANK_MARK}')) AS md FROM l GROUP BY 1)
      SELECT page_no, trim(regexp_replace(coalesce(md, ''), '\\n{{3,}}', chr(10) || chr(10), 'g'), ' ' || chr(10)) AS md FROM j""",
    "merge_suspect": f"SELECT doc_id, item_id FROM documents d, benchmark b WHERE contains({_NORMAL('d.text')}, {_NORMAL('b.text')})",
    "block_structure": f"""WITH {_OUT} SELECT file_no, count(*) FILTER (closed) AS sep_count, min(block_no) FILTER (closed AND len(kept) <> 2) AS first_bad_block, arg_min(len(kept), block_no) FILTER (closed AND len(kept) <> 2)::INTEGER AS bad_lines,
      coalesce(bool_or(NOT closed AND len(kept) > 0), false) AS dangling, (SELECT bool_or(trim(x) = '') FROM (SELECT unnest(string_split(regexp_replace(o.output, '\\n$', ''), chr(10))) AS x FROM {fx.OUTPUTS.sql()} o WHERE o.file_no = b.file_no)) AS has_blank FROM b GROUP BY 1""",
    "source_fidelity": f"""WITH {_OUT}, m AS (SELECT file_no, block_no AS para_no, kept[1] AS source FROM b WHERE closed), e AS (SELECT *, lead(para) OVER (PARTITION BY file_no ORDER BY para_no) AS nxt FROM {fx.EXPECTED.sql()}),
      j AS (SELECT e.*, m.para_no IS NOT NULL AS made, {_NORMAL("coalesce(m.source, '')")} AS o, {_NORMAL('e.para')} AS a, {_NORMAL('e.nxt')} AS b FROM e LEFT JOIN m USING (file_no, para_no))
      SELECT file_no, para_no, CASE WHEN NOT made THEN 'missing' WHEN o = a THEN 'ok' WHEN b <> '' AND o <> '' AND a <> '' AND contains(o, a) AND contains(o, b) THEN 'merged' ELSE 'mismatch' END AS status FROM j""",
    "heading_tag_errors": f"""WITH {_OUT}, m AS (SELECT file_no, block_no AS para_no, kept[1] AS source, kept[2] AS target FROM b WHERE closed), j AS (
      SELECT file_no, para_no, NOT regexp_matches(source, '^\\s*#{{1,6}}(\\s|$)') AS source_lost, regexp_matches(target, '^\\s*(>+\\s*)?#{{1,6}}(\\s|$)') AS target_has FROM {fx.EXPECTED.sql()} e JOIN m USING (file_no, para_no) WHERE regexp_matches(para, '^\\s*#{{1,6}}(\\s|$)'))
      SELECT * FROM j WHERE source_lost OR target_has""",
    "heading_swap": f"SELECT id, regexp_replace(text, '(?m)^([ \\t]*)(#{{1,6}})[ \\t]+([^\\n]+)\\n([ \\t]*)>[ \\t]*([^\\n]+)$', '\\1\\2 \\5' || chr(10) || '\\4> \\3', 'g') AS text FROM {fx.BILINGUAL.sql()}",
    "quote_spacing": f"""WITH l AS (SELECT id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM {fx.BILINGUAL.sql()}), p AS (SELECT *, lag(x) OVER (PARTITION BY id ORDER BY i) AS b FROM l)
      SELECT id, string_agg(CASE WHEN starts_with(ltrim(x), '>') AND b <> '' AND NOT starts_with(ltrim(b), '>') THEN chr(10) || x ELSE x END, chr(10) ORDER BY i) AS text FROM p GROUP BY 1""",
    "missing_links": """WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, '(?:href|src)\\s*=\\s*"([^"]*)"', 1)) AS href FROM pages),
      p AS (SELECT *, regexp_extract(trim(href), '^[^?#]*') AS path FROM l), r AS (SELECT *, CASE WHEN path = '' OR regexp_matches(trim(href), '^(https?://|data:|mailto:)') THEN NULL WHEN starts_with(path, '/') THEN regexp_replace(path, '^/+|/+$', '', 'g') ELSE 'site/' || path END AS resolved FROM p)
      SELECT page_id, href, resolved FROM r WHERE resolved IS NOT NULL AND resolved NOT IN (SELECT regexp_extract(url, '://[^/]*/([^?#]*)', 1) FROM pages)""",
    "marker_counts": f"""SELECT source, sum(len(regexp_extract_all(text, '\\|')))::BIGINT AS pipes, sum(len(regexp_extract_all(text, '!!')))::BIGINT AS bangs, sum(len(regexp_extract_all(text, '@')))::BIGINT AS ats,
      sum(len(regexp_extract_all(text, '{tx.FIGURE_MARK}|{tx.BLANK_MARK}')))::BIGINT AS marks FROM documents GROUP BY 1""",
    "manifest_missing": f"SELECT book, id FROM {fx.MANIFEST.sql()} m WHERE NOT EXISTS (SELECT 1 FROM {fx.ENTRIES.sql()} e WHERE e.book = m.book AND e.name = m.href)",
    "spine_dangling": f"SELECT book, idref AS id FROM {fx.SPINE.sql()} s WHERE NOT EXISTS (SELECT 1 FROM {fx.MANIFEST.sql()} m WHERE m.book = s.book AND m.id = s.idref)",
    "cover_dup": f"SELECT book, count(*) AS covers FROM {fx.MANIFEST.sql()} WHERE list_contains(string_split(coalesce(properties, ''), ' '), 'cover-image') GROUP BY 1 HAVING count(*) > 1",
    "entry_errors": f"""WITH e AS (SELECT * FROM {fx.ENTRIES.sql()}) SELECT book, count(*) AS n_entries, arg_min(name = 'mimetype' AND stored AND trim(content) = 'application/epub+zip', ord) AS mimetype_ok,
      sum(len(regexp_extract_all(content, '{tx.FIGURE_MARK}|{tx.REFUSED_MARK}')))::BIGINT AS n_marks FROM e GROUP BY 1""",
    "slug_names": f"""WITH t AS (SELECT book, ord, coalesce(nullif(substr(regexp_replace(regexp_replace(coalesce(label, ''), '[\\\\/:*?"<>|#%&\\s]+', '-', 'g'), '^[-.]+|[-.]+$', '', 'g'), 1, 48), ''), 'chapter') AS s FROM {fx.LABELS.sql()}),
      n AS (SELECT *, row_number() OVER (PARTITION BY book, s ORDER BY ord) AS n FROM t) SELECT book, ord, s || CASE WHEN n > 1 THEN '-' || n ELSE '' END || '.xhtml' AS file FROM n""",
    "link_resolve": f"SELECT l.base, l.href, v.resolved FROM {fx.LINKS.sql()} l JOIN (VALUES ('ch2.xhtml#a', 'OPS/ch2.xhtml'), ('../img/a%20b.png?x=1', 'OPS/img/a b.png'), ('https://a.example/x', NULL), ('#top', NULL), ('../../b.xhtml', 'b.xhtml'), ('./x/./y.css', 'OPS/x/y.css'), ('mailto:a@b.example', NULL), ('/root/z.png', 'root/z.png')) v(href, resolved) ON v.href = l.href",
    # fixed results worked out by hand
    "inline_token_repair": "SELECT * FROM (VALUES (1, '中和文', 1), (2, 'a and b', 0), (3, '他of 的or中', 0), (4, '中 he', 0)) AS v(id, text, n)",
    "divider_spacing": """SELECT id, replace(t, '/', chr(10)) AS text FROM (VALUES (1, '# Title/> Titel/body/> Text//---//next/> naechst'), (2, 'a//> b//---//c//---/'), (3, '## A b/  > C d/# E/> F/'), (4, '---//x'), (5, 'plain')) AS v(id, t)""",
    "merge_gate": "SELECT * FROM (VALUES ('gfm', 3, 'missing'), ('note', 2, 'failed')) AS v(book_id, page_no, problem)",
    "table_grid_errors": """SELECT * FROM (VALUES (2, '</tr> doesn''t close <td>'), (3, 'rowspan=''0'' of <td> isn''t allowed'), (4, 'onclick=''x'' of <td> isn''t allowed'), (4, 'row 2: width 1 of 2'), (5, 'tag <p> isn''t allowed'), (5, 'tag </p> isn''t allowed')) AS v(id, error)""",
    "figure_boxes": "SELECT 0::BIGINT AS id, 1 AS box_no, 77 AS x0, 117 AS y0, 323 AS x1, 363 AS y1",
}
