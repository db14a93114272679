"""Packaged books: their XML, content list, reading order and links, checked by joins over entries."""

from __future__ import annotations

from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirekit.functions.text import UNRESOLVED_MARKS
from quirekit.operators.links import resolve

XML_SUFFIX = r"(?i)\.(xhtml|html|opf|ncx|xml|svg)$"
ARROWS = ("⬆️", "⬇️")
_ATTRIBUTES = ("id", "href", "src", "properties", "idref", "full-path")
PARSED = T.StructType().add("error", "string").add("tags", T.ArrayType(T.StructType([T.StructField("tag", T.StringType()), *[T.StructField(a.replace("-", "_"), T.StringType()) for a in _ATTRIBUTES]])))


def local_name(tag: str) -> str:
    """A tag without its namespace."""
    return tag[tag.rfind("}") + 1 :]


@F.pandas_udf(PARSED)
def parse_xml(content: pd.Series) -> pd.DataFrame:
    """Tags with the attributes that checks need, in document order; or why the text isn't XML."""
    rows = []
    for text in content:
        try:
            found = [x for x in ElementTree.fromstring((text or "").encode()).iter() if isinstance(x.tag, str)]
            rows.append((None, [(local_name(x.tag), *(x.attrib.get(a) for a in _ATTRIBUTES)) for x in found if x.attrib or local_name(x.tag) == "spine"]))
        except ElementTree.ParseError as e:
            rows.append((str(e), None))
    return pd.DataFrame(rows, columns=["error", "tags"])


def package_problems(entries: DataFrame, *, strict_marks: bool = True, strict_arrows: bool = False) -> DataFrame:
    """Problems of packaged books: book, severity (error or warning), kind, item.

    ``entries``: book, ord, name, stored, content, bad (checksum doesn't fit). Books are checked side by side: each rule is a
    filter or an anti-join over the entries and the tags of the XML ones.
    """
    xml = entries.where(F.col("name").rlike(XML_SUFFIX)).select("book", "name", parse_xml("content").alias("x"))
    tags = xml.select("book", "name", F.posexplode("x.tags").alias("i", "t")).select("book", "name", "i", "t.*")
    names = entries.select("book", F.col("name").alias("resolved")).distinct()
    problem = lambda df, kind, item, severity="error": df.select("book", F.lit(severity).alias("severity"), F.lit(kind).alias("kind"), F.col(item).cast("string").alias("item"))
    first = entries.groupBy("book").agg(F.min_by(F.struct("name", "stored", "content"), "ord").alias("f"))
    kind = F.when(F.col("f.name") != "mimetype", "mimetype isn't first").when(~F.col("f.stored"), "mimetype is compressed").when(F.col("f.content") != "application/epub+zip", "mimetype is wrong")
    found = [first.select("book", F.lit("error").alias("severity"), kind.alias("kind"), F.lit("mimetype").alias("item")).where("kind is not null")]
    found += [problem(entries.where("bad"), "checksum", "name"), problem(xml.where("x.error is not null"), "malformed XML", "name")]
    pages = entries.where(F.col("name").rlike(r"(?i)\.x?html$")).select("book", "content")
    for marks, strict in ((UNRESOLVED_MARKS, strict_marks), (ARROWS, strict_arrows)):
        for m in marks:
            left = pages.groupBy("book").agg(F.sum(F.regexp_count("content", F.lit(m))).alias("n")).where("n > 0")
            found.append(problem(left, f"mark {m} is left", "n", "error" if strict else "warning"))
    links = tags.select("book", "name", F.explode(F.array_compact(F.array("href", "src"))).alias("href")).withColumn("resolved", resolve(F.col("name"), F.col("href")))
    found.append(problem(links.where("resolved is not null").join(names, ["book", "resolved"], "left_anti"), "missing resource", "href"))
    books = entries.select("book").distinct()
    opf = tags.where("name = 'META-INF/container.xml' and tag = 'rootfile'").groupBy("book").agg(F.min_by("full_path", "i").alias("opf"))
    opf = opf.join(xml.where("x.error is null").select("book", F.col("name").alias("opf")), ["book", "opf"])
    found.append(problem(books.join(opf, "book", "left_anti").withColumn("item", F.lit("META-INF/container.xml")), "no content list", "item"))
    own = tags.join(opf, "book").where("name = opf")
    items = own.where("tag = 'item' and id is not null and href is not null").withColumn("resolved", resolve(F.col("opf"), F.col("href")))
    found.append(problem(items.where("resolved is not null").join(names, ["book", "resolved"], "left_anti"), "manifest item missing", "id"))
    spine = own.where("tag = 'itemref' and idref is not null").select("book", "idref")
    found.append(problem(spine.join(items.select("book", F.col("id").alias("idref")), ["book", "idref"], "left_anti"), "spine item unknown", "idref"))
    found.append(problem(opf.join(spine, "book", "left_anti"), "empty spine", "opf"))
    covers = items.where(F.array_contains(F.split(F.coalesce("properties", F.lit("")), r"\s+"), "cover-image")).groupBy("book").agg(F.count("*").alias("n")).where("n > 1")
    found.append(problem(covers, "several covers", "n"))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def package_metrics(entries: DataFrame, problems: DataFrame) -> DataFrame:
    """Per book: entries, XML documents that parse, page documents, tables in pages, errors, warnings."""
    xml = F.when(F.col("name").rlike(XML_SUFFIX), parse_xml("content"))
    page = F.col("name").rlike(r"(?i)\.x?html$")
    tables = F.sum(F.when(page, F.regexp_count("content", F.lit("<table"))).otherwise(0))
    counts = entries.withColumn("_x", xml).groupBy("book").agg(
        F.count("*").alias("entries"), F.count_if(F.col("name").rlike(XML_SUFFIX) & F.col("_x.error").isNull()).alias("xml_documents"),
        F.count_if(F.col("name").endswith(".xhtml")).alias("xhtml_documents"), tables.cast("long").alias("tables"),
    )
    per = problems.groupBy("book").agg(F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings"))
    return counts.join(per, "book", "left").na.fill(0, ["errors", "warnings"])


def free_names(labels: DataFrame, most: int = 48) -> DataFrame:
    """Adds ``file``: a label without tags and reserved characters, cut, with the first number that leaves it unique in its book.

    A name depends on all that were given before, so a book is one task; its labels are streamed to it in order."""

    def name(pdf: pd.DataFrame) -> pd.DataFrame:
        used: set[str] = set()
        out = []
        for s in pdf.sort_values("ord")["_stem"]:
            n = 1
            while (got := s if n == 1 else f"{s}-{n}") in used:
                n += 1
            used.add(got)
            out.append(f"{got}.xhtml")
        return pdf.sort_values("ord").assign(file=out)[["book", "ord", "file"]]

    bare = F.trim(F.regexp_replace(F.regexp_replace(F.coalesce("label", F.lit("")), "<[^>]+>", ""), r'[\\/:*?"<>|]', ""))
    stem = F.coalesce(F.nullif(F.substring(F.regexp_replace(bare, r"\s+", "-"), 1, most), F.lit("")), F.lit("chapter"))
    return labels.select("book", "ord", stem.alias("_stem")).groupBy("book").applyInPandas(name, "book string, ord int, file string")
