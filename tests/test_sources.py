import hashlib
import json
import zipfile

import numpy as np
import pytest

from quirekit.operators import figures, providers
from quirekit.sources import files, sinks
from quirekit.streaming import resume


def test_page_folder(spark, tmp_path):
    for n in (2, 10):
        (tmp_path / f"{n}.jpg").write_bytes(bytes([n]))
        (tmp_path / f"{n}.md").write_text(f"page {n}\n")
    (tmp_path / "cover.jpg").write_bytes(b"c")
    (tmp_path / "2.meta.json").write_text(json.dumps({"status": "ok", "validated": True}))
    (tmp_path / "10.meta.json").write_text("{broken")
    got = {r.page_no: r.sha256 for r in files.images(spark, str(tmp_path)).collect()}
    assert set(got) == {2, 10, None} and got[2] == hashlib.sha256(b"\x02").hexdigest()
    assert [r.page_no for r in files.images(spark, str(tmp_path), first=3, last=10).collect()] == [10]
    assert {r.page_no: r.md for r in files.page_texts(spark, str(tmp_path)).collect()} == {2: "page 2\n", 10: "page 10\n"}
    side = {r.page_no: r.status for r in files.sidecars(spark, str(tmp_path)).collect()}
    assert side == {2: "ok", 10: None}


def test_manifest_and_indirection(spark, tmp_path):
    (tmp_path / "manifest.json").write_text(json.dumps({"version": 1, "source_pdf": "a.pdf", "dpi": 144, "pages": [{"pdf_page": 0, "output_index": 0, "file": "0.jpg", "width": 3, "height": 4, "sha256": "x"}, {"pdf_page": 1, "file": "1.jpg"}]}, indent=1))
    assert [(r.file, r.width) for r in files.manifest(spark, str(tmp_path / "manifest.json")).orderBy("file").collect()] == [("0.jpg", 3), ("1.jpg", None)]
    (tmp_path / "path.txt").write_text("\n  \n /a/b \nother\n")
    assert files.first_line(spark, str(tmp_path / "path.txt")).first().target == "/a/b"


def test_epub(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.epub", "w") as z:
        z.writestr(zipfile.ZipInfo("mimetype"), "application/epub+zip")
        z.writestr("OPS/a.xhtml", "<p>a</p>")
    (tmp_path / "b.epub").write_bytes(b"no zip")
    rows = files.epub_entries(spark, str(tmp_path)).orderBy("book", "ord").collect()
    assert [(r.name, r.stored, r.bad) for r in rows] == [("mimetype", True, False), ("OPS/a.xhtml", True, False), (None, None, True)]


def test_render(spark):
    df = spark.createDataFrame([("x", bytearray(b"ab"))], "path string, content binary")
    rows = files.rendered(df, lambda data: [(i, 1, 1, bytes([c])) for i, c in enumerate(data)]).collect()
    assert [(r.page_no, r.sha256) for r in rows] == [(i, hashlib.sha256(c).hexdigest()) for i, c in enumerate((b"a", b"b"))]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("b", 2, "two\n"), ("b", 1, "one")], "book_id string, n int, md string")
    path = tmp_path / "book.md"
    path.write_text("old")
    sinks.write_book(df, str(path), "n", "md")
    assert path.read_text() == "one\n\ntwo\n" and (tmp_path / "book.md.bak").read_text() == "old"
    sinks.write_parts(df, str(tmp_path / "parts"))
    sinks.write_parts(df.where("n = 1"), str(tmp_path / "parts"))
    assert spark.read.parquet(str(tmp_path / "parts")).count() == 1


def test_figure():
    page = np.full((600, 400), 255)
    page[120:360, 80:320] = 0
    (box,) = figures.figure_boxes(page)
    assert box[0] <= 80 and box[1] <= 120 and box[2] >= 320 and box[3] >= 360
    assert figures.figure_boxes(np.full((50, 50), 255)) == []
    assert figures.overlap((0, 0, 2, 2), (1, 0, 3, 2)) == 1 / 3


def test_provider_results(spark):
    def provider(text):
        if text == "bad":
            raise TimeoutError("timed out")
        return providers.Answer("__PROHIBITED_CONTENT__" if text == "no" else text, "MAX_TOKENS" if text == "long" else "STOP")

    df = spark.createDataFrame([(1, "fine"), (2, "bad"), (3, "no"), (4, "long"), (5, None)], "page_no int, request string")
    got = {r.page_no: (r.status, r.attempts) for r in providers.recognise(df, ["page_no"], "request", provider).collect()}
    assert got == {1: ("ok", 1), 2: ("failed", 3), 3: ("prohibited", 1), 4: ("failed", 3), 5: ("failed", 3)}
    done = providers.recognise(df, ["page_no"], "request", provider)
    assert {r.page_no for r in providers.pending(df, done, ["page_no"], "request").collect()} == {2, 3, 4, 5}


def test_latest_record(spark):
    df = spark.createDataFrame([(1, "failed", 1), (1, "ok", 2), (2, "failed", 3)], "page_no int, status string, at int")
    assert {r.page_no: r.status for r in providers.latest(df, ["page_no"], "at").collect()} == {1: "ok", 2: "failed"}


def test_table_context_skips_gaps(spark):
    head = "| a | b |\n| --- | --- |"
    df = spark.createDataFrame([("b", 1, head + "\n| 1 | 2 |"), ("b", 2, "x"), ("b", 4, "y")], "book_id string, page_no int, md string")
    got = {r.page_no: r.context for r in providers.table_context(df, "book_id", "page_no", "md").collect()}
    assert got == {1: "", 2: head, 4: ""}


def test_stream_resumes(spark, tmp_path):
    schema = "page_no int, request string"
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    work = lambda df: providers.recognise(df, ["page_no"], "request", providers.Answer)
    run = lambda: resume.process_new(spark, src, schema, out, ck, ["page_no"], "request", work).awaitTermination()
    spark.createDataFrame([(1, "a"), (2, "b")], schema).write.parquet(src)
    run()
    spark.createDataFrame([(2, "b"), (2, "new"), (3, "c")], schema).write.mode("append").parquet(src)
    run()
    assert sorted((r.page_no, r.text) for r in spark.read.parquet(out).collect()) == [(1, "a"), (2, "b"), (2, "new"), (3, "c")]


def test_files_are_replaced_whole(tmp_path):
    path = tmp_path / "r.json"
    sinks.write_json({"b": 1, "a": ["é"]}, str(path))
    assert path.read_text() == '{\n  "a": [\n    "é"\n  ],\n  "b": 1\n}\n'
    with pytest.raises(RuntimeError), sinks.replaced(str(path)) as f:
        f.write("half")
        raise RuntimeError
    assert '"b": 1' in path.read_text() and [p.name for p in tmp_path.iterdir()] == ["r.json"]


def test_package_round_trip(spark, tmp_path):
    rows = [("b", 0, "OPS/a.xhtml", "<p>é</p>", None), ("b", 1, "mimetype", "application/epub+zip", None), ("b", 2, "OPS/p.png", None, b"\x00\x01")]
    sinks.write_package(spark.createDataFrame(rows, "book string, ord int, name string, content string, data binary"), str(tmp_path / "b.epub"))
    back = files.epub_entries(spark, str(tmp_path)).orderBy("ord").collect()
    assert [(r.name, r.stored, r.content, r.bad) for r in back] == [("mimetype", True, "application/epub+zip", False), ("OPS/a.xhtml", False, "<p>é</p>", False), ("OPS/p.png", False, None, False)]


def test_images_are_written_once(spark, tmp_path):
    df = spark.createDataFrame([("f/1.jpg", b"abc"), ("2.jpg", b"de")], "name string, image binary")
    assert {r.written for r in sinks.write_images(df, str(tmp_path)).collect()} == {True}
    assert (tmp_path / "f" / "1.jpg").read_bytes() == b"abc"
    assert {r.written for r in sinks.write_images(df, str(tmp_path)).collect()} == {False}
