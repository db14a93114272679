"""Scans of page folders: images, texts, sidecars, manifests, packaged books."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quirekit.functions.text import strip

IMAGE_GLOB = "*.{jpg,jpeg,png,bmp,tif,tiff,webp}"
MANIFEST = """version int, source_pdf string, source_pdf_sha256 string, source_pages int, first_page int, last_page int, dpi int, format string,
jpeg_quality int, max_dim int, created_at string, pages array<struct<pdf_page int, output_index int, file string, width int, height int, sha256 string>>"""
SIDECAR = "status string, validated boolean, image_sha256 string, prompt_sha256 string, output_sha256 string, profile string, model string, finish_reason string, created_at string"
FAILURE = "status string, validated boolean, error string, created_at string, finish_reason string"


def page_number(path: Column) -> Column:
    """Number of a file whose stem is one, else null."""
    return F.regexp_extract(path, r"(?:^|/)([0-9]+)\.[^/]*$", 1).try_cast("int")


def images(spark: SparkSession, folder: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """Page images: path, page_no, length, sha256; a page range is pushed to the listing's rows before contents are hashed."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", IMAGE_GLOB).load(folder).withColumn("page_no", page_number(F.col("path")))
    for bound, test in ((first, lambda b: F.col("page_no") >= b), (last, lambda b: F.col("page_no") <= b)):
        df = df if bound is None else df.where(test(bound))
    return df.select("path", "page_no", "length", F.sha2("content", 256).alias("sha256"))


def page_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Page texts ``N.md``: page_no, md, output_sha256; other files are left out."""
    df = spark.read.option("pathGlobFilter", "*.md").text(folder, wholetext=True).withColumn("page_no", page_number(F.input_file_name()))
    return df.where("page_no is not null").select("page_no", F.col("value").alias("md"), F.sha2("value", 256).alias("output_sha256"))


def sidecars(spark: SparkSession, folder: str, suffix: str = "meta", schema: str = SIDECAR) -> DataFrame:
    """Sidecars ``N.<suffix>.json``; one that can't be parsed has null fields."""
    df = spark.read.option("pathGlobFilter", f"*.{suffix}.json").text(folder, wholetext=True).withColumn("page_no", F.regexp_extract(F.input_file_name(), rf"/([0-9]+)\.{suffix}\.json$", 1).try_cast("int"))
    return df.where("page_no is not null").select("page_no", sidecar(F.col("value"), schema).alias("m")).select("page_no", "m.*")


def sidecar(value: Column, schema: str = SIDECAR) -> Column:
    """Fields of a sidecar's text, all null if it can't be parsed."""
    return F.from_json(value, schema, {"mode": "PERMISSIVE"})


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Pages of a manifest, one row each, with the render's settings."""
    df = spark.read.schema(MANIFEST).json(path, multiLine=True)
    return df.select("source_pdf", "source_pdf_sha256", "dpi", "format", F.inline("pages"))


def scaled(width: Column, height: Column, most: int | None) -> Column:
    """Size of a page image within ``most`` pixels a side, as struct(width, height); smaller ones and ``most`` None stay."""
    if most is None:
        return F.struct(width.alias("width"), height.alias("height"))
    factor = F.least(F.lit(1.0), F.least(F.lit(float(most)) / width, F.lit(float(most)) / height))
    fit = lambda n: F.greatest(F.lit(1), F.floor(n * factor)).cast("int")
    return F.struct(fit(width).alias("width"), fit(height).alias("height"))


def manifest_of(rendered_pages: DataFrame, settings: dict) -> dict:
    """The manifest of a render: its settings and its pages (pdf_page, output_index, file, width, height, sha256) in order.

    One book's pages fit the driver, as its manifest is one file; ``manifest`` reads it back, ``write_json`` writes it."""
    names = ("pdf_page", "output_index", "file", "width", "height", "sha256")
    return {"version": 1, **settings, "pages": [r.asDict() for r in rendered_pages.select(*names).orderBy("pdf_page").collect()]}


def first_line(spark: SparkSession, path: str) -> DataFrame:
    """The first line that isn't blank of each text file: an indirection to another path."""
    df = spark.read.text(path, wholetext=True)
    return df.select(F.input_file_name().alias("file"), first_filled_line(F.col("value")).alias("target"))


def first_filled_line(value: Column) -> Column:
    """The first line of a text that isn't blank, without outer white space."""
    return F.try_element_at(F.filter(F.transform(F.split(value, r"\r?\n"), lambda x: strip(x)), lambda x: x != ""), F.lit(1))


def epub_entries(spark: SparkSession, folder: str) -> DataFrame:
    """Entries of packaged books: book, ord, name, stored, content (text entries only), bad (checksum doesn't fit)."""

    def unzip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([("book", pa.string()), ("ord", pa.int32()), ("name", pa.string()), ("stored", pa.bool_()), ("content", pa.string()), ("bad", pa.bool_())])
        for b in batches:
            for path, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                rows = []
                try:
                    with zipfile.ZipFile(io.BytesIO(data)) as z:
                        for i, info in enumerate(z.infolist()):
                            try:
                                raw, bad = z.read(info), False
                            except (zipfile.BadZipFile, OSError, ValueError):
                                raw, bad = b"", True
                            is_text = info.filename == "mimetype" or info.filename.lower().endswith((".xhtml", ".html", ".opf", ".ncx", ".xml", ".svg", ".css"))
                            rows.append((path, i, info.filename, info.compress_type == zipfile.ZIP_STORED, raw.decode("utf-8", "replace") if is_text else None, bad))
                except zipfile.BadZipFile:
                    rows.append((path, 0, None, None, None, True))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kind.types, strict=True)], schema=kind)

    df = spark.read.format("binaryFile").option("pathGlobFilter", "*.epub").load(folder).select("path", "content")
    return df.mapInArrow(unzip, "book string, ord int, name string, stored boolean, content string, bad boolean")


def rendered(books: DataFrame, render, *, key: str = "path") -> DataFrame:
    """Pages of documents by an injected renderer: bytes to (page_no, width, height, image bytes) rows, hashed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                rows = [(name, *r) for r in render(data)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.binary()), strict=True)], names=[key, "page_no", "width", "height", "image"])

    return books.select(key, "content").mapInArrow(run, f"{key} string, page_no int, width int, height int, image binary").withColumn("sha256", F.sha2("image", 256))
