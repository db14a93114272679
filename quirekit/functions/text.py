"""Text predicates and transforms as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Marks and patterns of the page format.
FIGURE_MARK = "\U0001f004"
BLANK_MARK = "\U0001f233"
REFUSED_MARK = "__PROHIBITED_CONTENT__"
UNRESOLVED_MARKS = (FIGURE_MARK, BLANK_MARK, REFUSED_MARK)
SPACES = r"[ \t\x{3000}]"
DOT = "[·•‧・．]"
PAGE_NUMBER = DOT + SPACES + "*[0-9０-９]{1,4}" + SPACES + "*" + DOT
SEPARATOR_CELL = "^:?-{3,}:?$"
ACTIVE_HTML = r"(?is)<\s*(script|iframe|object|embed|style|link|meta)\b|\son\w+\s*="
TABLE_BLOCK = r"""(?is)(?:<div\b[^>]*class=["'][^"']*\btable-wrap\b[^"']*["'][^>]*>\s*)?<table\b.*?</table>\s*(?:</div>)?"""


def strip(c: Column) -> Column:
    """Without white space of any script at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def squeeze(c: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def normal_content(c: Column) -> Column:
    """Without punctuation and white space; symbols stay."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)[\p{P}\s]", "")


def lines(c: Column) -> Column:
    """Lines of a text; CRLF counts as LF."""
    return F.split(F.regexp_replace(c, "\r\n", "\n"), "\n")


def is_heading(c: Column, quoted: bool = False) -> Column:
    """Starts with one to six # and then white space or the end, after a quote mark if ``quoted``."""
    return c.rlike(r"^\s*(?:>+\s*)?#{1,6}(?:\s|$)" if quoted else r"^\s*#{1,6}(?:\s|$)")


def is_pipe_line(c: Column) -> Column:
    """A line of a pipe table: starts with a pipe and has two at least."""
    return strip(c).startswith("|") & (F.regexp_count(c, F.lit(r"\|")) >= 2)


def pipe_cells(c: Column) -> Column:
    """Trimmed cells of a pipe-table line; a pipe after one backslash belongs to its cell."""
    inner = F.regexp_replace(strip(c), r"^\||(?<!\\)\|$", "")
    return F.transform(F.split(inner, r"(?<!\\)\|"), lambda x: F.trim(x))


def is_separator(cells: Column) -> Column:
    """All cells are dashes, three at least, with colons at most at the ends."""
    return (F.size(cells) > 0) & F.forall(cells, lambda x: x.rlike(SEPARATOR_CELL))


def clean_page(c: Column) -> Column:
    """Without lines that hold the blank-page mark, blank runs as one blank line, stripped."""
    kept = F.filter(lines(c), lambda x: ~x.contains(BLANK_MARK))
    return strip(F.regexp_replace(F.array_join(F.transform(kept, lambda x: F.when(x.rlike(r"(?U)^\s*$"), "").otherwise(x)), "\n"), "\n{3,}", "\n\n"))


def strip_page_numbers(c: Column) -> Column:
    """Without printed page numbers: lines of one alone go, inside lines they are cut out and double spaces closed."""
    kept = F.filter(lines(c), lambda x: ~strip(x).rlike(f"^{PAGE_NUMBER}$"))

    def tidy(x: Column) -> Column:
        cut = F.regexp_replace(x, PAGE_NUMBER, "")
        lead = F.regexp_extract(cut, f"^({SPACES}*)", 1)
        body = F.regexp_replace(F.substring(cut, F.length(lead) + 1, F.length(cut)), SPACES + "{2,}", " ")
        out = F.regexp_replace(F.concat(lead, body), r"(?U)\s+$", "")
        # a line that held more than white space before, and none after, goes as well
        return F.when((out == "") & (strip(x) != ""), None).otherwise(out)

    return F.regexp_replace(F.array_join(F.transform(kept, tidy), "\n"), "\n{3,}", "\n\n")


def safe_name(c: Column) -> Column:
    """A title as a file name: reserved characters as _, ``untitled`` if nothing is left."""
    return F.coalesce(F.nullif(F.trim(F.regexp_replace(c, r'[\\/:*?"<>|\n]', "_")), F.lit("")), F.lit("untitled"))


def number_key(name: Column) -> tuple[Column, Column, Column]:
    """Sort key of file names: whole-number stems by value, then the others by lower case."""
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    number = F.when(stem.rlike("^[0-9]+$"), stem.try_cast("long"))
    return number.isNull(), F.coalesce(number, F.lit(0)), F.lower(name)


def is_tableish(c: Column) -> Column:
    """A looser test for pipe-table lines: a piped line, a bare separator, or short cells between two pipes that don't start as prose."""
    bare = strip(c)
    cells = F.transform(F.split(F.regexp_replace(bare, r"^\||\|$", ""), r"\|"), lambda x: strip(x))
    prose = F.get(cells, F.lit(0)).rlike(r"[\x{4e00}-\x{9fff}]{8}")
    loose = (F.regexp_count(bare, F.lit(r"\|")) >= 2) & F.forall(cells, lambda x: F.length(x) <= 40) & ~prose
    return is_pipe_line(c) | bare.rlike(r"^\|?\s*:?-{3,}:?\s*(\|\s*:?-{3,}:?\s*)+\|?$") | loose


def is_table_markup(c: Column) -> Column:
    """A line of HTML table markup: a table tag, a table wrapper or a closing div."""
    return strip(c).rlike(r"(?i)^</?(table|thead|tbody|tr|th|td)\b|<div\b[^>]*table-wrap|^</div>$")


def preview(c: Column, most: int = 50) -> Column:
    """One line of a text, cut to ``most`` characters with an ellipsis of three dots."""
    line = squeeze(F.coalesce(c, F.lit("")))
    return F.when(F.length(line) > most, F.concat(F.substring(line, 1, most - 3), F.lit("..."))).otherwise(line)


def join_prompt(prompt: Column, name: Column, context: Column) -> Column:
    """A page's request: the prompt, the page's name, and the table header that it may go on with."""
    more = F.when(F.coalesce(context, F.lit("")) != "", F.concat(F.lit("The page before ends in a table with this header:\n"), context))
    return F.concat_ws("\n\n", strip(prompt), F.concat(F.lit("Page: "), name), more)
