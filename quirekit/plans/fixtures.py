"""Small inline tables that both engines read."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

SQL_TYPES = {"int": "INTEGER", "long": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE"}


@dataclass(frozen=True)
class Fixture:
    """Rows with a schema like ``a long, b string``."""

    schema: str
    rows: tuple

    def df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.rows), self.schema)

    def sql(self) -> str:
        """A table expression for DuckDB."""
        names, types = zip(*(c.split() for c in self.schema.split(", ")), strict=True)
        cell = lambda v: "NULL" if v is None else "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)
        values = ", ".join("(" + ", ".join(map(cell, r)) + ")" for r in self.rows)
        cast = ", ".join(f"CAST({n} AS {SQL_TYPES[t]}) AS {n}" for n, t in zip(names, types, strict=True))
        return f"(SELECT {cast} FROM (VALUES {values}) AS v({', '.join(names)}))"


FIGURE, BLANK = "\U0001f004", "\U0001f233"
NAMES = Fixture("name string", (("cover.jpg",), ("10.jpg",), ("2.jpg",), ("Back.png",), ("007.webp",), ("a1.jpg",), ("33",)))
ERRORS = Fixture(
    "id int, status int, message string",
    ((1, 402, "payment"), (2, 403, None), (3, 429, "slow down"), (4, 503, "quota gone"), (5, None, "Your quota is used up"), (6, None, "Model is overloaded, wait"), (7, None, "error code 502 from host"), (8, None, "what a day"), (9, 404, "upstream timeout"), (10, 400, "insufficient funds"), (11, None, None)),
)
DELAYS = Fixture(
    "id int, text string",
    ((1, 'x "retryDelay": "23m32.6s" y'), (2, '{"quotaResetDelay" : "1h2m3s"}'), (3, "quota will reset after 45s."), (4, '"retryDelay":"17"'), (5, "no delay"), (6, '"retryDelay": "soon", reset after 2m'), (7, '"retryDelay": "0.2s"'), (8, "")),
)
REASONS = Fixture("id int, reason string", ((1, "stop"), (2, "FinishReason.MAX_TOKENS"), (3, "length "), (4, None), (5, "max_output_reached"), (6, "SAFETY"), (7, " a.b.Stop ")))
BOOKS = Fixture(
    "book_id string, md string",
    (("b1", "before\n\n# One\ntext a\n\n# Two: x/y\nbody\n## Two point one\nmore"), ("b2", "# Only\n\nparagraph one\n\nparagraph two\n \n\n  indented\n"), ("b3", "no heading at all"), ("b4", "# A\n# B\r\nline\n")),
)
TABLES = Fixture(
    "page_no int, md string",
    ((1, "x\n| a | b |\n|---|:--:|\n| 1 | 2 |\ny"), (2, "| a | b |\n| --- | --- |\n| 1 |\n\n| c | d |"), (3, "none here"), (4, "| p | q |\n| - | - |\n| 1 | 2 |\ntext\n  | r | s |\n|:---|---:|"), (5, r"| a \| b | c |" + "\n| --- | --- |")),
)
PAGES = Fixture(
    "page_no int, md string",
    ((1, ""), (2, "  \n "), (3, "```\ncode\n"), (4, "```\ncode\n```"), (5, "<table><tr><td>a</td></tr>"), (6, f"left {FIGURE}️ 1.jpg"), (7, f"a\n{BLANK} blank\n\n\n\nb"), (8, "<script>x</script>"), (9, '<p onclick = "x">'), (10, "__PROHIBITED_CONTENT__"), (11, "plain <sup>note</sup>")),
)
MARKED = Fixture(
    "page_no int, md string",
    ((1, "one\n·12·\ntwo"), (2, "• 6 •\n\n\n\nkept"), (3, "a ·3· b   c"), (4, "  lead ・64・  word  x"), (5, "·12·"), (6, "  \nplain  text here"), (7, "·12345·"), (8, "１·２３· end   ")),
)
OUTPUTS = Fixture(
    "file_no int, output string",
    ((1, "s one\n> t one\n---\ns two\n> t two\n---\n"), (2, "s one\n> t one\ns two\n> t two\n---\n"), (3, "s one\n---\n\ns two\n> t two\n---\nrest"), (4, ""), (5, "# Head\n> # Kopf\n---\nHead two\n> Kopf zwei\n---\nThird one. fourth\n> x\n---")),
)
EXPECTED = Fixture(
    "file_no int, para_no int, para string",
    ((1, 1, "s, one."), (1, 2, "s two"), (2, 1, "s one"), (2, 2, "s two"), (5, 1, "# Head"), (5, 2, "# Head two"), (5, 3, "Third one"), (5, 4, "fourth"), (3, 1, "s one")),
)
BILINGUAL = Fixture("id int, text string", ((1, "# Title\n> Titel\nbody\n> Text\n---\nnext\n> naechst"), (2, "a\n\n> b\n---\n\nc\n---"), (3, "## A b\n  > C d\n# E\n> F\n"), (4, "---\nx"), (5, "plain")))
ENTRIES = Fixture(
    "book string, ord int, name string, stored boolean, content string",
    (("x", 0, "mimetype", True, "application/epub+zip"), ("x", 1, "OPS/ch1.xhtml", False, "<p>a</p>"), ("x", 2, "OPS/ch2.xhtml", False, f"<p>{FIGURE}</p>"), ("y", 0, "OPS/a.xhtml", False, "<p/>"), ("y", 1, "mimetype", True, "application/epub+zip")),
)
MANIFEST = Fixture(
    "book string, id string, href string, properties string",
    (("x", "c1", "OPS/ch1.xhtml", None), ("x", "c2", "OPS/ch2.xhtml", "nav"), ("x", "c3", "OPS/ch3.xhtml", None), ("x", "i", "OPS/cover.jpg", "cover-image"), ("y", "a", "OPS/a.xhtml", "cover-image"), ("y", "b", "OPS/b.xhtml", "scripted cover-image")),
)
SPINE = Fixture("book string, idref string", (("x", "c1"), ("x", "c9"), ("y", "a"), ("y", "zz")))
LABELS = Fixture("book string, ord int, label string", (("x", 1, "Chapter one"), ("x", 2, "Chapter one"), ("x", 3, 'What? A "test"'), ("x", 4, ""), ("x", 5, None), ("y", 1, "Chapter one"), ("y", 2, "a" * 60)))
LINKS = Fixture(
    "base string, href string",
    (("OPS/ch1.xhtml", "ch2.xhtml#a"), ("OPS/text/ch1.xhtml", "../img/a%20b.png?x=1"), ("OPS/ch1.xhtml", "https://a.example/x"), ("OPS/ch1.xhtml", "#top"), ("a.xhtml", "../../b.xhtml"), ("OPS/ch1.xhtml", "./x/./y.css"), ("OPS/ch1.xhtml", "mailto:a@b.example"), ("OPS/ch1.xhtml", "/root/z.png")),
)
THEAD = "<thead><tr><th>h1</th><th>h2</th></tr></thead>"
CONTINUED = Fixture(
    "book_id string, page_no int, md string",
    (
        ("gfm", 1, "intro\n\n| a | b |\n| --- | --- |\n| 1 | 2 |"), ("gfm", 2, "| a | b |\n| --- | --- |\n| 3 | 4 |\n\nafter"), ("gfm", 4, "gap"),
        ("html", 1, f"<table>{THEAD}<tbody><tr><td>1</td><td>2</td></tr></tbody></table>"), ("html", 2, f"<table>{THEAD}<tbody><tr><td>3</td><td>4</td></tr></tbody></table>\nend"),
        ("note", 1, "text<sup>【left ⬇️】</sup>"), ("note", 2, "<sup>⬆️ right】</sup>\nnext"),
        *(("long", i, f"| a | b |\n| --- | --- |\n| {i} | {i} |") for i in range(1, 5)),
    ),
)
NOTED = Fixture("page_no int, md string", ((1, "Table 1\n\n| a | b |\n| --- | --- |\n| x<sup>【a first note】</sup> | y①<sup>【second】</sup> |\n| 【5.5%】 | 【means this】 |\n\nSource: us"), (2, "no notes"), (3, "<table><tr><td>v<sup>【in html】</sup></td></tr></table>")))
GRIDS = Fixture(
    "id int, block string",
    ((1, '<div class="table-wrap"><table class="table-dense"><tr><th rowspan="2">a</th><th colspan="2">b</th></tr><tr><th>c</th><th>d</th></tr><tr><td>1</td><td>2</td><td>3</td></tr></table></div>'), (2, "<table><tr><td>a<td>b</tr></table>"), (3, '<table><tr><td rowspan="0">a</td></tr></table>'), (4, '<table><tr><td>a</td><td>b</td></tr><tr><td onclick="x">c</td></tr></table>'), (5, "<p>x</p>")),
)
SECTIONS = Fixture("id int, text string", ((1, "# Head\nfirst line of the paragraph that is quite long and goes on here\nand continues with hyphen-\nated words.\n·12·\n| a | b |\n| --- | --- |\n中文段落没有结束所以继续写下去直到一行很长很长很长很长很长很长很长很长很长很长很长很长很长很长很长\n下一行。"), (2, "---\ntitle: x\n---\nbody text is short\n1999 dated line\n<sup>a\nnote</sup>")))
INLINE = Fixture("id int, text string", ((1, "中 and 文"), (2, "a and b"), (3, "他of 的or中"), (4, "中 he")))
