"""Writing chunks, sections, whole books, reports, packages and images."""

from __future__ import annotations

import json
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import IO

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F


def write_parts(df: DataFrame, path: str, book: str = "book_id") -> None:
    """Rows by book; a rerun replaces the books it holds whole, so no older part is left behind."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(book).parquet(path)


def write_book(df: DataFrame, path: str, order: str, text: str, keep_old: bool = True) -> None:
    """One book as a text file: rows stream to the driver in order and a temporary file takes the old one's place at the end.

    With ``keep_old`` the file before stays as ``.bak``."""
    with replaced(path, keep_old=keep_old) as f:
        for i, row in enumerate(df.orderBy(order).select(F.coalesce(text, F.lit("")).alias("t")).toLocalIterator()):
            f.write(("\n\n" if i else "") + row["t"].rstrip("\n"))
        f.write("\n")


@contextmanager
def replaced(path: str, mode: str = "w", *, keep_old: bool = False) -> Iterator[IO]:
    """A file that takes the place of the one at ``path`` when it is complete and on disk; after an error nothing changes."""
    folder = os.path.dirname(os.path.abspath(path))
    f = tempfile.NamedTemporaryFile(mode, encoding=None if "b" in mode else "utf-8", dir=folder, delete=False)
    try:
        yield f
        f.flush()
        os.fsync(f.fileno())
        f.close()
        if keep_old and os.path.exists(path):
            os.replace(path, f"{path}.bak")
        os.replace(f.name, path)
    finally:
        f.close()
        if os.path.exists(f.name):
            os.unlink(f.name)


def write_json(value: object, path: str) -> None:
    """A report as JSON with sorted keys, indented by two, non-ASCII letters as they are."""
    with replaced(path) as f:
        f.write(json.dumps(value, ensure_ascii=False, indent=2, sort_keys=True) + "\n")


def write_package(entries: DataFrame, path: str) -> None:
    """A packaged book from its entries (ord, name, content, and data for entries that aren't text): ``mimetype`` first and stored."""
    data = F.col("data") if "data" in entries.columns else F.lit(None).cast("binary")
    rows = entries.select((F.col("name") != "mimetype").alias("later"), "ord", "name", "content", data.alias("data")).orderBy("later", "ord")
    with replaced(path, "wb") as f, zipfile.ZipFile(f, "w", zipfile.ZIP_DEFLATED) as z:
        for r in rows.toLocalIterator():
            kind = zipfile.ZIP_DEFLATED if r["later"] else zipfile.ZIP_STORED
            z.writestr(zipfile.ZipInfo(r["name"]), bytes(r["data"]) if r["data"] is not None else (r["content"] or "").encode(), kind)


def write_images(images: DataFrame, folder: str, *, overwrite: bool = False, encode: Callable[[Row], bytes] = lambda r: bytes(r["image"])) -> DataFrame:
    """Images (name, and what ``encode`` needs) as files of a folder that executors share: name, written.

    A file of the same size stays unless ``overwrite``; each file appears whole or not at all."""

    def put(rows: Iterator) -> Iterator:
        import pyarrow as pa

        for b in rows:
            names, done = b.column(b.schema.names.index("name")).to_pylist(), []
            for r in b.to_pylist():
                path, data = os.path.join(folder, r["name"]), encode(Row(**r))
                os.makedirs(os.path.dirname(path), exist_ok=True)
                due = overwrite or not os.path.exists(path) or os.path.getsize(path) != len(data)
                if due:
                    with replaced(path, "wb") as f:
                        f.write(data)
                done.append(due)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(done, pa.bool_())], names=["name", "written"])

    return images.mapInArrow(put, "name string, written boolean")
