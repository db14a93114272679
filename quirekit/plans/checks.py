"""Queries that put whole books, packages and translations to the test, and over notes, sentences and figures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirekit.functions.text import strip
from quirekit.operators import assets, config, figures, package, pages, paragraphs, rough, translation
from quirekit.plans import fixtures as fx
from quirekit.plans.fixtures import BLANK, FIGURE, Fixture
from quirekit.session import table

SHA_A, SHA_B = "a" * 64, "b" * 64
IMAGES = Fixture("page_no int, sha256 string", tuple((i, SHA_A) for i in (1, 2, 3, 4, 5, 7)))
OUTPUT_PAGES = Fixture("page_no int, md string, output_sha256 string", ((1, "fine", SHA_A), (2, "stale", SHA_A), (3, "```\nopen", SHA_A), (4, " ", SHA_A), (6, "extra", SHA_A), (7, "odd", SHA_A)))
PAGE_METAS = Fixture(
    "page_no int, status string, validated boolean, image_sha256 string, prompt_sha256 string, output_sha256 string",
    ((1, "ok", True, SHA_A, SHA_A, SHA_A), (2, "ok", True, SHA_B, SHA_B, SHA_B), (3, "ok", False, SHA_A, SHA_A, SHA_A), (6, "failed", True, SHA_B, SHA_A, SHA_A), (7, "ok", True, SHA_A, None, SHA_A)),
)
BESIDE = Fixture("name string", (("8.fail.json",), ("9.partial.md",), ("1.meta.json",), ("notes.txt",)))
ROUGH = Fixture(
    "book_id string, page_no int, md string",
    (("ok", 3, f"start {FIGURE}️ 3.jpg\n{BLANK}\n\n\n\nmore"), ("ok", 4, "| a | b |\n| --- | --- |\n| 1 | 2 |"), ("ok", 5, "| a | b |\n| --- | --- |\n| 3 | 4 |\n\nend"), ("gap", 1, "one"), ("gap", 3, "three"), ("bad", 1, "```"), ("lost", 1, f"see {FIGURE}️ no.png")),
)
ROUGH_FILES = Fixture("book_id string, name string, path string, priority int, full_page boolean", (("ok", "3.jpg", "images/3.jpg", 2, True), ("ok", "3.jpg", "figures/3-1.jpg", 1, False)))
CONTAINER = '<container xmlns="urn:c"><rootfiles><rootfile full-path="OPS/book.opf"/></rootfiles></container>'
OPF = '<package xmlns="urn:o"><manifest><item id="a" href="a.xhtml" properties="nav cover-image"/><item id="b" href="b%20c.xhtml"/><item id="p" href="p.png" properties="cover-image"/><item id="z" href="gone.css"/></manifest><spine><itemref idref="a"/><itemref idref="nope"/></spine></package>'
PACKAGES = Fixture(
    "book string, ord int, name string, stored boolean, content string, bad boolean",
    (
        ("x", 0, "mimetype", True, "application/epub+zip", False), ("x", 1, "META-INF/container.xml", False, CONTAINER, False), ("x", 2, "OPS/book.opf", False, OPF, False),
        ("x", 3, "OPS/a.xhtml", False, f'<html xmlns="h"><a href="b%20c.xhtml#t">x</a><img src="q.png"/><a href="https://a.example">y</a><table/><table/>{FIGURE}</html>', False), ("x", 4, "OPS/b c.xhtml", False, "<html><p>⬇️ ⬇️</p></html>", False), ("x", 5, "OPS/p.png", False, None, True),
        ("y", 0, "OPS/a.xhtml", False, "<html><p>open</html>", False), ("y", 1, "mimetype", True, "application/epub+zip", False), ("z", 0, "mimetype", False, "application/epub+zip", False), ("z", 1, "META-INF/container.xml", False, CONTAINER, False), ("z", 2, "OPS/book.opf", False, "<package><manifest/><spine/></package>", False),
    ),
)
CHAPTERS = Fixture("book string, ord int, label string", (("x", 1, "One <b>day</b>"), ("x", 2, "One day-2"), ("x", 3, "One day"), ("x", 4, "One  day"), ("x", 5, " ?*: "), ("x", 6, None), ("y", 1, "One day"), ("y", 2, "w" * 60), ("y", 3, "w" * 50)))
RENAMED = Fixture("book string, ord int, name string, content string", (("x", 1, "OPS/a.xhtml", '<a href="b c.xhtml#t">a.xhtml</a>'), ("x", 2, "OPS/b c.xhtml", '<a href="../OPS/a.xhtml">x</a><img src="p.png"/>'), ("x", 3, "OPS/p.png", None), ("y", 1, "a.xhtml", '<a href="a.xhtml"/>')))
COUNTS = Fixture("file_no int, output string, expected int", ((1, "a\n> b\n---\nc\n> d\ne\n> f\n---\nlone\n---\n", 4), (2, "a\n> b\n---\n", 1), (3, "a\n> b\n\nc\n---\n---\nx\n> y\n> z\nw\n> v\nu\n---\n", 2), (4, "---\n" * 7, 9), (5, "", 2)))
RETRIES = Fixture("id int, output string, reasons string", ((1, " a\n> b ", "too long| |merged"), (2, "", ""), (3, None, "one"), (4, "x", "")))
SENTENCES = Fixture(
    "id int, text string",
    ((1, "See J. Smith here. Done."), (2, "The U.S. army won. Yes"), (3, "Wait... no. more"), (4, "Dr. Who? cf. this. Mme. X."), (5, "He asked (really?) and left! (A long one? [nested?])"), (6, "好。吗？是！"), (7, "<sup>a. B?</sup> c. ![x. y](z.png) D."), (8, "A." + " " * 300 + "b. C" + "." * 2), (9, "no mark"), (10, "x" * 300 + ". Next")),
)
NOTE_CELLS = Fixture(
    "page_no int, md string",
    ((1, "| a | b |\n| --- | --- |\n| x<sup>【 one  note；】</sup> | y②<sup>【two】</sup> |\n| 【5.5%】 | 【means this】 |\n| 【短】 | 【指短】 |"), (2, "| a<sup>【only row】</sup> |"), (3, "<table><tr><td>v<sup>【in html】</sup></td><td>w<sup>【in html】</sup></td></tr></table>"), (4, "| h |\n| --- |\n| a<sup>【】</sup> |"), (5, "plain 【aside words】")),
)
CLEANUPS = Fixture("id int, text string", ((1, "see<sup>first\n line\n</sup> on\n·12·\nword word word"), (2, "<sup>a</sup>\n\n\n\n<sup>b\n\nc</sup> ·3· d   e"), (3, "同同同 同同同"), (4, "")))
FINALS = Fixture("book_id string, section_no int, md string", (("p", 10, " last \n"), ("p", 2, "中 and 文"), ("p", 3, "  "), ("q", 1, "x and y")))
DRAFTS = Fixture("book_id string, md string", (("p", "---\ntitle: x\n---\nbefore the first heading\n\n# One\n<div>kept</div>\na line that goes on for long enough to be joined with the next\none.\n·12·\n# Two\n  indented text\n"), ("q", "# Only\nshort line\nsame same same")))
FIGURE_PAGES = Fixture("page_no int, md string", ((7, f"before\n\n{FIGURE}️ 7.jpg\n\nafter"), (8, "no token"), (9, f"{FIGURE}️ 9.jpg")))
BOXES = Fixture("id int, w int, h int, box_no int, x0 int, y0 int, x1 int, y1 int", ((1, 400, 600, 1, 80, 120, 320, 360), (1, 400, 600, 2, 0, 5, 395, 300), (2, 100, 100, 1, 2, 2, 98, 98), (3, 50, 40, 1, 20, 10, 30, 35)))
CROPPED = Fixture("page_no int, box_no int, file string", ((1, 2, "figures/1-2.jpg"), (1, 1, "figures/1-1.jpg"), (3, 1, "figures/3-1.jpg"), (4, 1, "figures/4-1.jpg")))
TOKENS = Fixture("page_no int, md string", ((1, f"a {FIGURE}️ 1.jpg b {FIGURE}️ 1.jpg c {FIGURE}️ 1.jpg"), (2, f"{FIGURE}️ 2.jpg"), (3, "none"), (4, f"{FIGURE}️ figures/4-1.jpg")))


def book_findings(s: SparkSession, d: str) -> DataFrame:
    return rough.book_findings(IMAGES.df(s), OUTPUT_PAGES.df(s), PAGE_METAS.df(s), BESIDE.df(s), prompt_sha=SHA_A)


def _rough(s: SparkSession, allow_missing: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    return rough.rough_text(ROUGH.df(s), ROUGH.df(s).where("false"), ROUGH_FILES.df(s), allow_missing=allow_missing)


def rough_merge(s: SparkSession, d: str) -> DataFrame:
    return _rough(s, False)[0]


def rough_merge_lenient(s: SparkSession, d: str) -> DataFrame:
    return _rough(s, True)[0]


def rough_report(s: SparkSession, d: str) -> DataFrame:
    return _rough(s, True)[1]


def rough_problems(s: SparkSession, d: str) -> DataFrame:
    return _rough(s, False)[2]


def rough_documents(s: SparkSession, d: str) -> DataFrame:
    """Documents as pages of books: each source's clean pages in order, as one text."""
    book = table(s, d, "documents").where("text is not null").select(F.col("source").alias("book_id"), F.col("doc_id").alias("page_no"), F.col("text").alias("md"))
    files = s.createDataFrame([], "book_id string, name string, path string, priority int, full_page boolean")
    text = rough.rough_text(book, book.where("false"), files, allow_missing=True, join_tables=False, figures=False)[0]
    return text.select("book_id", F.length("md").alias("n_chars"), F.sha2("md", 256).alias("sha"))


def merged_pages(s: SparkSession, d: str) -> DataFrame:
    return pages.merge_pages(fx.CONTINUED.df(s))


def package_problems(s: SparkSession, d: str) -> DataFrame:
    return package.package_problems(PACKAGES.df(s))


def package_metrics(s: SparkSession, d: str) -> DataFrame:
    return package.package_metrics(PACKAGES.df(s), package.package_problems(PACKAGES.df(s)))


def chapter_files(s: SparkSession, d: str) -> DataFrame:
    return package.free_names(CHAPTERS.df(s))


def renamed_entries(s: SparkSession, d: str) -> DataFrame:
    """Entries under new names; a name that another entry gives up isn't renamed twice."""
    names = s.createDataFrame([("x", "a.xhtml", "b c.xhtml"), ("x", "b c.xhtml", "new.xhtml")], "book string, old string, new string")
    return assets.rename_entries(RENAMED.df(s), names).select("book", "name", "content")


def structure_details(s: SparkSession, d: str) -> DataFrame:
    return translation.structure_details(COUNTS.df(s), "file_no", "expected")


def retry_feedback(s: SparkSession, d: str) -> DataFrame:
    reasons = F.when(F.col("reasons") != "", F.split("reasons", r"\|"))
    return RETRIES.df(s).select("id", translation.retry_feedback(F.col("output"), reasons).alias("feedback"))


def sentence_places(s: SparkSession, d: str) -> DataFrame:
    return SENTENCES.df(s).select("id", F.array_join(pages.sentence_ends(F.col("text")), ",").alias("places"))


def sentence_counts(s: SparkSession, d: str) -> DataFrame:
    """Places in each document after which a paragraph may be cut."""
    return table(s, d, "documents").select("doc_id", F.size(pages.sentence_ends(F.coalesce("text", F.lit("")))).alias("n"))


def noted_tables(s: SparkSession, d: str) -> DataFrame:
    return pages.extract_notes(NOTE_CELLS.df(s))


def note_totals(s: SparkSession, d: str) -> DataFrame:
    out = pages.extract_notes(NOTE_CELLS.df(s))
    return out.agg(F.count_if(F.col("n_notes") > 0).alias("changed_pages"), F.sum("n_notes").alias("n_notes"))


def cleanup_text(s: SparkSession, d: str) -> DataFrame:
    return CLEANUPS.df(s).select("id", rough.cleanup(F.col("text")).alias("text"))


def final_book(s: SparkSession, d: str) -> DataFrame:
    return rough.final_text(FINALS.df(s), repair=True)


def typeset_books(s: SparkSession, d: str) -> DataFrame:
    return rough.typeset(DRAFTS.df(s))


def figure_pages(s: SparkSession, d: str) -> DataFrame:
    """A page of 400 by 600 with a dark rectangle, and two without a figure or a token."""
    px = F.transform(F.sequence(F.lit(0), F.lit(400 * 600 - 1)), lambda i: F.when((F.col("page_no") < 9) & ((i % 400) >= 80) & ((i % 400) < 320) & (i >= 120 * 400) & (i < 360 * 400), 0).otherwise(255))
    images = FIGURE_PAGES.df(s).select("page_no", F.lit(400).alias("w"), F.lit(600).alias("h"), px.alias("px"))
    return figures.crop_pages(FIGURE_PAGES.df(s), images)[0]


def crop_boxes(s: SparkSession, d: str) -> DataFrame:
    return figures.crops(BOXES.df(s))


def cropped_pixels(s: SparkSession, d: str) -> DataFrame:
    """Grey values of the crops of pages whose pixel at (x, y) is (x + 3 * y) % 256."""
    px = F.transform(F.sequence(F.lit(0), F.col("w") * F.col("h") - 1), lambda i: (i % F.col("w") + 3 * F.floor(i / F.col("w"))) % 256)
    box = figures.crops(BOXES.df(s).where("w < 300")).withColumn("px", px)
    cut = figures.cut(F.col("px"), *map(F.col, ("w", "x0", "y0", "x1", "y1")))
    return box.select("id", "box_no", F.size(cut).alias("n"), F.aggregate(cut, F.lit(0).cast("long"), lambda a, x: a + x).alias("total"))


def figure_tokens(s: SparkSession, d: str) -> DataFrame:
    return figures.place_crops(TOKENS.df(s), CROPPED.df(s))


def paragraph_split_raw(s: SparkSession, d: str) -> DataFrame:
    """Paragraphs between runs of blank lines, not trimmed."""
    rows = paragraphs.split_paragraphs(fx.BOOKS.df(s), "md")
    return rows.select("book_id", "para_no", "para")


def prompt_hash(s: SparkSession, d: str) -> DataFrame:
    """Hash of the prompt that a page's sidecar names; outer white space doesn't count."""
    return table(s, d, "benchmark").select("item_id", F.sha2(config.prompt_or(F.col("text"), ""), 256).alias("prompt_sha256"), (strip("text") == "").alias("empty"))


QUERIES = {
    f.__name__: f
    for f in (
        book_findings, rough_merge, rough_merge_lenient, rough_report, rough_problems, rough_documents, merged_pages, package_problems, package_metrics, chapter_files, renamed_entries, structure_details, retry_feedback, sentence_places, sentence_counts,
        noted_tables, note_totals, cleanup_text, final_book, typeset_books, figure_pages, crop_boxes, cropped_pixels, figure_tokens, paragraph_split_raw, prompt_hash,
    )
}

_NL = lambda c: f"replace({c}, '~', chr(10))"
_MARK = f"{FIGURE}️"


def _ends(source: str, *key: str) -> str:
    """SQL of ``ends``: places (i, from 1) of the marks that end a sentence in the texts of a table."""
    k = ", ".join(key)
    return f"""chars AS (SELECT {k}, i, substr(text, i, 1) AS c, CASE WHEN i > 1 THEN substr(text, i - 1, 1) ELSE '' END AS p, substr(text, i + 1, 40) AS after, CASE WHEN i > 1 THEN substr(text, greatest(i - 12, 1), least(12, i - 1)) ELSE '' END AS b
        FROM {source}, range(1, length(coalesce(text, '')) + 1) r(i)),
      stops AS (SELECT *, ltrim(after, ' ' || chr(10)) AS rest, regexp_extract(b, '\\pL+$') AS word FROM chars WHERE c IN ('.', '?', '!', '。', '？', '！')),
      ends AS (SELECT {k}, i FROM stops WHERE c <> '.' OR NOT (p = '.' OR starts_with(after, '.') OR regexp_matches(rest, '^\\p{{Ll}}') OR (regexp_matches(p, '[A-Z]') AND regexp_matches(rest, '^[A-Z][\\p{{Ll}}''-]')) OR word IN ('M', 'Mme', 'Mlle', 'Dr', 'Pr', 'Mr', 'Ms', 'St', 'cf', 'etc')
        OR (regexp_full_match(word, '[A-Z]') AND (substr(b, greatest(length(b) - 1, 1), 1) = '.' OR regexp_matches(after, '^\\pL\\.')))))"""


#: Paragraphs (table lines: doc_id, para_no, text) over 450 characters cut again and again at the end nearest to 250, s and e being where a piece begins and ends.
_PIECES = f"""long AS (SELECT * FROM lines WHERE length(text) > 450), {_ends('long', 'doc_id', 'para_no')},
      marked AS (SELECT l.doc_id, l.para_no, any_value(l.text) AS text, coalesce(list(e.i ORDER BY e.i) FILTER (e.i IS NOT NULL), []) AS marks FROM long l LEFT JOIN ends e USING (doc_id, para_no) GROUP BY 1, 2),
      cuts AS (SELECT doc_id, para_no, text, marks, 0::BIGINT AS s, length(text)::BIGINT AS e, false AS done FROM marked
        UNION ALL SELECT doc_id, para_no, text, marks, CASE WHEN k = 1 THEN s ELSE cut END, CASE WHEN k = 2 OR NOT fits THEN e ELSE length(rtrim(substr(text, 1, cut)))::BIGINT END, NOT fits FROM (
          SELECT *, cut < e AS fits, unnest(CASE WHEN cut < e THEN [1, 2] ELSE [1] END) AS k FROM (
            SELECT *, coalesce(m + length(regexp_extract(substr(text, m + 1, 200), '^\\s*[›»”’）)】\\]]*\\s*')), e) AS cut FROM (
              SELECT *, list_min(list_transform(list_filter(marks, lambda x: x > s AND x <= e), lambda x: abs(x - s - 250) * 1000000 + x)) % 1000000 AS m FROM cuts WHERE NOT done AND e - s > 450)))),
      pieces AS (SELECT doc_id, para_no, s, substr(text, s + 1, e - s) AS piece FROM cuts WHERE done OR e - s <= 450 UNION ALL SELECT doc_id, para_no, 0, text FROM lines WHERE length(text) <= 450)"""
_MERGED = f"""(VALUES ('gfm', 1, 'intro~~| a | b |~| --- | --- |~| 1 | 2 |~| 3 | 4 |', NULL, NULL), ('gfm', 2, 'after', 1, 'gfm'), ('gfm', 4, 'gap', NULL, NULL),
      ('html', 1, '<table>{fx.THEAD}<tbody>~<tr><td>1</td><td>2</td></tr>~<tr><td>3</td><td>4</td></tr>~</tbody></table>', NULL, NULL), ('html', 2, 'end', 1, 'html'), ('note', 1, 'text<sup>【leftright】</sup>', NULL, NULL), ('note', 2, 'next', 1, 'footnote'),
      ('long', 1, '| a | b |~| --- | --- |~| 1 | 1 |~| 2 | 2 |', NULL, NULL), ('long', 2, '', 1, 'gfm'), ('long', 3, '| a | b |~| --- | --- |~| 3 | 3 |~| 4 | 4 |', NULL, NULL), ('long', 4, '', 3, 'gfm')) AS v(book_id, page_no, md, merged_into, kind)"""
ORACLES = {
    "book_findings": f"""WITH i AS (SELECT * FROM {IMAGES.sql()}), o AS (SELECT * FROM {OUTPUT_PAGES.sql()}), m AS (SELECT * FROM {PAGE_METAS.sql()}), j AS (SELECT o.page_no, i.sha256, m.*, o.output_sha256 AS own FROM o JOIN m USING (page_no) LEFT JOIN i USING (page_no))
      SELECT 'missing' AS finding, page_no::BIGINT AS page_no, NULL::VARCHAR AS detail FROM i WHERE page_no NOT IN (SELECT page_no FROM o)
      UNION ALL SELECT 'extra', page_no, NULL FROM o WHERE page_no NOT IN (SELECT page_no FROM i) UNION ALL SELECT 'no metadata', page_no, NULL FROM o WHERE page_no NOT IN (SELECT page_no FROM m)
      UNION ALL SELECT 'invalid', page_no, CASE WHEN trim(md) = '' THEN 'empty output' ELSE 'odd number of code fences' END FROM o WHERE trim(md) = '' OR len(regexp_extract_all(md, '```')) % 2 = 1
      UNION ALL SELECT 'stale', page_no, r FROM (SELECT page_no, array_to_string(list_filter([CASE WHEN status <> 'ok' OR NOT validated THEN 'status' END, CASE WHEN sha256 IS NOT NULL AND image_sha256 IS DISTINCT FROM sha256 THEN 'image' END,
        CASE WHEN prompt_sha256 IS DISTINCT FROM '{SHA_A}' THEN 'prompt' END, CASE WHEN output_sha256 IS DISTINCT FROM own THEN 'output' END], lambda x: x IS NOT NULL), ',') AS r FROM j) WHERE r <> ''
      UNION ALL SELECT 'failed', split_part(name, '.', 1)::BIGINT, name FROM {BESIDE.sql()} WHERE name LIKE '%.fail.json' UNION ALL SELECT 'partial', split_part(name, '.', 1)::BIGINT, name FROM {BESIDE.sql()} WHERE name LIKE '%.partial.md'""",
    "rough_documents": f"""WITH l AS (SELECT source, doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents WHERE text IS NOT NULL),
      p AS (SELECT source, doc_id, string_agg(CASE WHEN trim(line) = '' THEN '' ELSE line END, chr(10) ORDER BY i) FILTER (NOT contains(line, '{BLANK}')) AS md FROM l GROUP BY 1, 2),
      c AS (SELECT source, doc_id, trim(regexp_replace(md, '\\n{{3,}}', chr(10) || chr(10), 'g'), ' ' || chr(10)) AS md FROM p), b AS (SELECT source AS book_id, rtrim(string_agg(md, chr(10) || chr(10) ORDER BY doc_id), ' ' || chr(10)) || chr(10) AS md FROM c WHERE md <> '' GROUP BY 1)
      SELECT book_id, length(md)::INTEGER AS n_chars, sha256(md) AS sha FROM b""",
    "package_metrics": f"""WITH e AS (SELECT *, regexp_matches(lower(name), '\\.(xhtml|html|opf|ncx|xml|svg)$') AS xml, regexp_matches(lower(name), '\\.x?html$') AS page FROM {PACKAGES.sql()})
      SELECT book, count(*) AS entries, count(*) FILTER (xml AND NOT contains(content, '<p>open')) AS xml_documents, count(*) FILTER (name LIKE '%.xhtml') AS xhtml_documents, coalesce(sum(len(regexp_extract_all(content, '<table'))) FILTER (page), 0)::BIGINT AS tables,
        max(CASE book WHEN 'x' THEN 7 WHEN 'y' THEN 3 ELSE 2 END)::BIGINT AS errors, max(CASE book WHEN 'x' THEN 1 ELSE 0 END)::BIGINT AS warnings FROM e GROUP BY 1""",
    "structure_details": f"""WITH l AS (SELECT file_no, expected, unnest(string_split(output, chr(10))) AS line, generate_subscripts(string_split(output, chr(10)), 1) AS i FROM {COUNTS.sql()}), q AS (SELECT *, line = '---' AS sep FROM l),
      n AS (SELECT *, coalesce(sum(sep::INTEGER) OVER (PARTITION BY file_no ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::INTEGER + 1 AS block_no FROM q),
      b AS (SELECT file_no, block_no, (count(*) FILTER (NOT sep AND trim(line) <> ''))::INTEGER AS n FROM n GROUP BY 1, 2 HAVING bool_or(sep)),
      c AS (SELECT *, (coalesce(sum(CASE WHEN n % 2 = 0 THEN n // 2 ELSE 1 END) OVER (PARTITION BY file_no ORDER BY block_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 1)::INTEGER AS cursor FROM b),
      t AS (SELECT file_no, expected, (SELECT count(*) FROM b WHERE b.file_no = o.file_no)::INTEGER AS k FROM {COUNTS.sql()} o),
      d AS (SELECT file_no, CASE WHEN n < 2 THEN 'short' WHEN n % 2 = 0 THEN 'merged' ELSE 'split' END AS kind, block_no, n AS n_lines, CASE WHEN n > 2 AND n % 2 = 0 THEN cursor END AS from_para, CASE WHEN n > 2 AND n % 2 = 0 THEN (cursor + n // 2 - 1)::INTEGER END AS to_para FROM c WHERE n <> 2
        UNION ALL SELECT file_no, CASE WHEN k < expected THEN 'too_few' ELSE 'too_many' END, NULL, k, NULL, NULL FROM t WHERE k <> expected),
      r AS (SELECT *, row_number() OVER (PARTITION BY file_no ORDER BY block_no NULLS LAST)::INTEGER AS detail_no FROM d)
      SELECT * FROM r WHERE detail_no <= 5""",
    "retry_feedback": f"""WITH t AS (SELECT id, trim(coalesce(output, ''), ' ' || chr(10)) AS o, list_filter(list_transform(string_split(coalesce(reasons, ''), '|'), lambda x: trim(x)), lambda x: x <> '') AS r FROM {RETRIES.sql()})
      SELECT id, CASE WHEN o = '' AND len(r) = 0 THEN '' ELSE array_to_string(list_filter(['The last output was refused:', nullif(o, ''), CASE WHEN len(r) > 0 THEN 'Reasons:' || chr(10) || array_to_string(list_transform(r, lambda x, i: i || '. ' || x), chr(10)) END,
        'Give two lines for each paragraph, source and > target, then ---, without blank lines.'], lambda x: x IS NOT NULL), chr(10)) END AS feedback FROM t""",
    "sentence_counts": f"WITH {_ends('documents', 'doc_id')} SELECT d.doc_id, count(e.i)::INTEGER AS n FROM documents d LEFT JOIN ends e USING (doc_id) GROUP BY 1",
    "long_paragraph_split": f"""WITH RECURSIVE lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS text, (generate_subscripts(string_split(text, chr(10)), 1) - 1)::INTEGER AS para_no FROM documents), {_PIECES}
      SELECT doc_id, para_no, (row_number() OVER (PARTITION BY doc_id, para_no ORDER BY s) - 1)::INTEGER AS piece_no, length(piece)::INTEGER AS n_chars, sha256(piece) AS piece_sha FROM pieces""",
    "typeset_paragraphs": f"""WITH RECURSIVE parts AS (SELECT doc_id, trim(unnest(string_split(text, chr(10)))) AS text, generate_subscripts(string_split(text, chr(10)), 1)::INTEGER AS para_no FROM documents), lines AS (SELECT * FROM parts WHERE text <> ''), {_PIECES}
      SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY para_no, s) - 1)::INTEGER AS para_no, length(piece)::INTEGER AS n_chars FROM pieces""",
    "dead_letter": """WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS n FROM documents)
      SELECT doc_id, CASE WHEN n % 17 = 0 THEN 'prohibited' ELSE 'failed' END AS status, CASE WHEN n % 17 = 0 THEN 'provider refused' WHEN n % 13 = 0 THEN 'cut off: MAX_TOKENS' ELSE 'TimeoutError: timed out' END AS error, CASE WHEN n % 17 = 0 THEN 1 ELSE 3 END AS attempts
      FROM t WHERE n % 17 = 0 OR n % 13 = 0 OR n % 11 = 0""",
    "merge_sequence": f"SELECT book_id, page_no, sha256({_NL('md')}) AS md_sha, merged_into, kind FROM {_MERGED}",
    "merged_pages": f"SELECT book_id, page_no, {_NL('md')} AS md, merged_into, kind FROM {_MERGED}",
    "merge_transitive": f"""SELECT book_id, page_no, {_NL('md')} AS md, merged_into, kind FROM {_MERGED} WHERE book_id <> 'long'
      UNION ALL SELECT 'long', page_no, {_NL("CASE page_no WHEN 1 THEN '| a | b |~| --- | --- |~| 1 | 1 |~| 2 | 2 |~| 3 | 3 |~| 4 | 4 |' ELSE '' END")}, CASE WHEN page_no > 1 THEN 1 END, CASE WHEN page_no > 1 THEN 'gfm' END FROM range(1, 5) r(page_no)""",
    "crop_boxes": f"""WITH g AS (SELECT id, w, h, box_no, greatest(x0 - 12, 0) AS x0, greatest(y0 - 12, 0) AS y0, least(x1 + 12, w) AS x1, least(y1 + 12, h) AS y1 FROM {BOXES.sql()})
      SELECT *, 'figures/' || id || '-' || box_no || '.jpg' AS file FROM g WHERE (x1 - x0) * (y1 - y0) / (w * h) < 0.9""",
    "cropped_pixels": f"""WITH g AS (SELECT id, w, h, box_no, greatest(x0 - 12, 0) AS x0, greatest(y0 - 12, 0) AS y0, least(x1 + 12, w) AS x1, least(y1 + 12, h) AS y1 FROM {BOXES.sql()} WHERE w < 300)
      SELECT id, box_no, count(*)::INTEGER AS n, sum((x + 3 * y) % 256)::BIGINT AS total FROM g, range(0, 100) a(x), range(0, 100) b(y) WHERE (x1 - x0) * (y1 - y0) / (w * h) < 0.9 AND x >= x0 AND x < x1 AND y >= y0 AND y < y1 GROUP BY 1, 2""",
    "paragraph_split_raw": f"""WITH p AS (SELECT book_id, regexp_split_to_array(trim(replace(md, chr(13) || chr(10), chr(10)), ' ' || chr(10) || chr(9)), '\\n\\s*\\n') AS ps FROM {fx.BOOKS.sql()})
      SELECT book_id, (generate_subscripts(ps, 1) - 1)::INTEGER AS para_no, unnest(ps) AS para FROM p""",
    "prompt_hash": "SELECT item_id, sha256(trim(text, ' ' || chr(10))) AS prompt_sha256, trim(text, ' ' || chr(10)) = '' AS empty FROM benchmark",
    "note_totals": "SELECT 2::BIGINT AS changed_pages, 6::BIGINT AS n_notes",
    # fixed results worked out by hand from the rules; ~ stands for a line end
    "rough_merge": f"SELECT 'ok' AS book_id, {_NL("'start ![](figures/3-1.jpg)~~more~~| a | b |~| --- | --- |~| 1 | 2 |~| 3 | 4 |~~end~'")} AS md",
    "rough_merge_lenient": f"SELECT book_id, {_NL('md')} AS md FROM (VALUES ('ok', 'start ![](figures/3-1.jpg)~~more~~| a | b |~| --- | --- |~| 1 | 2 |~| 3 | 4 |~~end~'), ('gap', 'one~~three~'), ('bad', '```~'), ('lost', 'see {_MARK} no.png~')) AS v(book_id, md)",
    "rough_report": "SELECT book_id, n_pages::BIGINT AS n_pages, first_page, last_page, n_joined::BIGINT AS n_joined, n_problems::BIGINT AS n_problems FROM (VALUES ('ok', 3, 3, 5, 1, 0), ('gap', 2, 1, 3, 0, 1), ('bad', 1, 1, 1, 0, 1), ('lost', 1, 1, 1, 0, 1)) AS v(book_id, n_pages, first_page, last_page, n_joined, n_problems)",
    "rough_problems": "SELECT * FROM (VALUES ('gap', 2, 'missing'), ('bad', 1, 'invalid'), ('lost', 1, 'figure without file')) AS v(book_id, page_no, problem)",
    "page_errors": """SELECT * FROM (VALUES (1, 'empty output'), (2, 'empty output'), (3, 'odd number of code fences'), (5, 'line 1: table isn''t closed'), (8, 'active HTML'), (9, 'active HTML'), (101, 'line 2: no separator in the second row'), (102, 'line 1: rows of 1, 2 cells'),
      (102, 'line 5: pipe table of one row'), (104, 'line 1: no separator in the second row')) AS v(page_no, error)""",
    "sanitize_table": """SELECT * FROM (VALUES (1, '<div class="table-wrap"><table class="table-dense"><tr><th rowspan="2">a</th><th colspan="2">b</th></tr><tr><th>c</th><th>d</th></tr><tr><td>1</td><td>2</td><td>3</td></tr></table></div>', NULL), (2, NULL, '</tr> doesn''t close <td>'), (3, NULL, 'rowspan=''0'' of <td> isn''t allowed'),
      (4, NULL, 'onclick=''x'' of <td> isn''t allowed; row 2: width 1 of 2'), (5, NULL, 'tag <p> isn''t allowed; tag </p> isn''t allowed')) AS v(id, html, error)""",
    "extract_notes": f"""SELECT page_no, {_NL('md')} AS md, n_notes FROM (VALUES (1, 'Table 1~~| a | b |~| --- | --- |~| x② | y① |~| 【5.5%】 | ③ |~~  <sup>【②a first note】</sup>~  <sup>【①second】</sup>~  <sup>【③means this】</sup>~~Source: us', 3), (2, 'no notes', 0),
      (3, '<table><tr><td>v①</td></tr></table>~~  <sup>【①in html】</sup>~', 1)) AS v(page_no, md, n_notes)""",
    "table_headers": f"SELECT page_no, {_NL('h')} AS header FROM (VALUES (1, ''), (2, '| a | b |~| --- | --- |'), (3, ''), (4, 'text~  | r | s |~|:---|---:|'), (5, '| a \\| b | c |~| --- | --- |')) AS v(page_no, h)",
    "layout_reflow": f"""SELECT id, {_NL('t')} AS text FROM (VALUES (1, '# Head~~  first line of the paragraph that is quite long and goes on here~~and continues with hyphenated words.~~| a | b |~| --- | --- |~~中文段落没有结束所以继续写下去直到一行很长很长很长很长很长很长很长很长很长很长很长很长很长很长很长下一行。~'),
      (2, '---~title: x~---~~body text is short~~1999 dated line~~<sup>a note</sup>~')) AS v(id, t)""",
    "package_problems": f"""SELECT * FROM (VALUES ('x', 'error', 'checksum', 'OPS/p.png'), ('x', 'error', 'mark {FIGURE} is left', '1'), ('x', 'warning', 'mark ⬇️ is left', '2'), ('x', 'error', 'missing resource', 'q.png'), ('x', 'error', 'missing resource', 'gone.css'), ('x', 'error', 'manifest item missing', 'z'),
      ('x', 'error', 'spine item unknown', 'nope'), ('x', 'error', 'several covers', '2'), ('y', 'error', 'mimetype isn''t first', 'mimetype'), ('y', 'error', 'malformed XML', 'OPS/a.xhtml'), ('y', 'error', 'no content list', 'META-INF/container.xml'), ('z', 'error', 'mimetype is compressed', 'mimetype'), ('z', 'error', 'empty spine', 'OPS/book.opf')) AS v(book, severity, kind, item)""",
    "chapter_files": "SELECT book, ord, file || '.xhtml' AS file FROM (VALUES ('x', 1, 'One-day'), ('x', 2, 'One-day-2'), ('x', 3, 'One-day-3'), ('x', 4, 'One-day-4'), ('x', 5, 'chapter'), ('x', 6, 'chapter-2'), ('y', 1, 'One-day'), ('y', 2, repeat('w', 48)), ('y', 3, repeat('w', 48) || '-2')) AS v(book, ord, file)",
    "renamed_entries": """SELECT * FROM (VALUES ('x', 'OPS/b c.xhtml', '<a href="new.xhtml#t">a.xhtml</a>'), ('x', 'OPS/new.xhtml', '<a href="../OPS/b c.xhtml">x</a><img src="p.png"/>'), ('x', 'OPS/p.png', NULL), ('y', 'a.xhtml', '<a href="a.xhtml"/>')) AS v(book, name, content)""",
    "sentence_places": "SELECT * FROM (VALUES (1, '17,23'), (2, '17'), (3, ''), (4, '7,17,25'), (5, '27'), (6, '1,3,5'), (7, '18,36'), (8, '303'), (9, ''), (10, '300')) AS v(id, places)",
    "noted_tables": f"""SELECT page_no, {_NL('md')} AS md, n_notes FROM (VALUES (1, '| a | b |~| --- | --- |~| x① | y② |~| 【5.5%】 | ③ |~| 【短】 | ④ |~~  <sup>【①one note】</sup>~  <sup>【②two】</sup>~  <sup>【③means this】</sup>~  <sup>【④指短】</sup>~', 4), (2, '| a<sup>【only row】</sup> |', 0),
      (3, '<table><tr><td>v①</td><td>w②</td></tr></table>~~  <sup>【①in html】</sup>~  <sup>【②in html】</sup>~', 2), (4, '| h |~| --- |~| a<sup>【】</sup> |', 0), (5, 'plain 【aside words】', 0)) AS v(page_no, md, n_notes)""",
    "cleanup_text": f"SELECT id, {_NL('t')} AS text FROM (VALUES (1, 'see<sup>first line</sup> on~word word word'), (2, '<sup>a</sup>~~<sup>b c</sup> d e'), (3, '同同同 同同同'), (4, '')) AS v(id, t)",
    "final_book": f"SELECT book_id, {_NL('t')} AS md FROM (VALUES ('p', '中和文~~last~'), ('q', 'x and y~')) AS v(book_id, t)",
    "figure_pages": f"SELECT page_no, {_NL('md')} AS md, changed FROM (VALUES (7, 'before~~{_MARK} figures/7-1.jpg~~after', true), (8, 'no token', false), (9, '{_MARK} 9.jpg', false)) AS v(page_no, md, changed)",
    "typeset_books": f"SELECT book_id, {_NL('t')} AS md FROM (VALUES ('p', '---~title: x~---~~before the first heading~~# One~~  <div>kept</div> a line that goes on for long enough to be joined with the next one.~~# Two~~  indented text~'), ('q', '# Only~~  short line~~same same same~')) AS v(book_id, t)",
    "figure_tokens": f"SELECT * FROM (VALUES (1, 'a {_MARK} figures/1-1.jpg b {_MARK} figures/1-2.jpg c {_MARK} figures/1-2.jpg', true), (2, '{_MARK} 2.jpg', false), (3, 'none', false), (4, '{_MARK} figures/4-1.jpg', false)) AS v(page_no, md, changed)",
}
