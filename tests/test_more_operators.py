import numpy as np
import pytest
from pyspark.sql import functions as F

from quirekit.functions import text as tx
from quirekit.operators import assets, links, pages, paragraphs, passages, stages
from quirekit.operators.providers import Answer


def test_lines(spark):
    rows = ["| a | b |", "a | b | c", "--- | ---", "prose without pipes", "</div>", "<td>x", "text <b>"]
    got = [(r.a, r.b) for r in spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "i int, x string").orderBy("i").select(tx.is_tableish(F.col("x")).alias("a"), tx.is_table_markup(F.col("x")).alias("b")).collect()]
    assert got == [(True, False), (True, False), (True, False), (False, False), (False, True), (False, True), (False, False)]
    r = spark.range(1).select(tx.preview(F.lit("a  b\n" + "c" * 60)).alias("p"), tx.join_prompt(F.lit(" do "), F.lit("1.jpg"), F.lit("")).alias("q")).first()
    assert len(r.p) == 50 and r.p.startswith("a b c") and r.q == "do\n\nPage: 1.jpg"


def test_figures(spark):
    df = spark.createDataFrame([("b", 1, "x \U0001f004️ 1.jpg y \U0001f004 2.png"), ("b", 2, "none")], "book_id string, page_no int, md string")
    files = spark.createDataFrame([("b", "1.jpg", "figures/1-1.jpg", 1, False), ("b", "1.jpg", "images/1.jpg", 2, True)], "book_id string, name string, path string, priority int, full_page boolean")
    got = {r.page_no: (r.md, r.fallback) for r in assets.materialize_figures(df, files).collect()}
    assert got == {1: ("x ![](figures/1-1.jpg) y \U0001f004 2.png", False), 2: ("none", False)}
    r = df.where("page_no = 1").select(assets.number_tokens(F.col("md"), F.array(F.lit("figures/1-1.jpg"))).alias("t")).first()
    assert r.t == "x \U0001f004️ figures/1-1.jpg y \U0001f004 2.png"


def test_rename(spark):
    df = spark.createDataFrame([("b", "OPS/a.xhtml", '<a href="b.xhtml#x">b</a> <img src="img/a.png"/>'), ("b", "OPS/b.xhtml", '<a href="a.xhtml">a</a>'), ("b", "c.png", None)], "book string, name string, content string")
    names = spark.createDataFrame([("b", "a.xhtml", "b.xhtml"), ("b", "b.xhtml", "c.xhtml")], "book string, old string, new string")
    got = sorted((r.name, r.content) for r in assets.rename_entries(df, names).collect())
    assert got == [("OPS/b.xhtml", '<a href="c.xhtml#x">b</a> <img src="img/a.png"/>'), ("OPS/c.xhtml", '<a href="b.xhtml">a</a>'), ("c.png", None)]


def test_stages(spark):
    log = spark.createDataFrame([("a", "ocr", "failed", 1), ("a", "ocr", "done", 2), ("b", "ocr", "done", 1), ("b", "merge", "done", 2)], "book_id string, stage string, status string, updated_at int")
    assert {r.book_id: r.stage for r in stages.runnable(log, ["ocr", "merge"]).collect()} == {"a": "merge"}


def test_translate(spark):
    calls = []

    def provider(request):
        calls.append(request)
        parts = request.split("\n\n")
        if "never" in parts and len(parts) > 0:
            return Answer("nothing")
        return Answer("".join(f"{p}\n> T {p}\n---\n" for p in parts))

    assert stages.parse_blocks("a\n> b\n---\n") == [("a", "> b")] and stages.parse_blocks("a\n---\n") is None and stages.parse_blocks("a\n> b") is None
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate(["one", "two", "never", "four"])] + [(2, 0, "five")], "file_no int, para_no int, para string")
    got = {(r.file_no, r.para_no): (r.target, r.status) for r in stages.translate(df, provider, batch=3).collect()}
    assert got == {(1, 0): ("T one", "ok"), (1, 1): ("T two", "ok"), (1, 2): (None, "failed"), (1, 3): ("T four", "ok"), (2, 0): ("T five", "ok")}


def test_entry_rules_and_slugs(spark):
    df = spark.createDataFrame([("b", 1, "One/Two"), ("b", 2, "One Two"), ("b", 3, "")], "book string, ord int, label string")
    assert [r.file for r in links.slug_names(df).orderBy("ord").collect()] == ["One-Two.xhtml", "One-Two-2.xhtml", "chapter.xhtml"]


def test_four_page_table(spark):
    df = spark.createDataFrame([("b", i, f"| a | b |\n| --- | --- |\n| {i} | {i} |") for i in range(1, 5)], "book_id string, page_no int, md string")
    plain = [r.md for r in pages.merge_pages(df).orderBy("page_no").collect()]
    assert [bool(x) for x in plain] == [True, False, True, False]
    joined = [r.md for r in pages.merge_pages(df, transitive=True).orderBy("page_no").collect()]
    assert [bool(x) for x in joined] == [True, False, False, False] and joined[0].count("| a | b |") == 1


def test_passages_are_found_in_the_normal_form(spark, tmp_path):
    from quirekit.plans import pages

    docs = ["It said: one, two-three \u2013 four five six; seven (eight).", "one two", "one two three four five six seven", "", None, "\u00e9\U0001f600 long " * 9, "x" * 70, "one two"]
    items = ["one two three four five six seven eight", "two", "One", "one two three four five six", "", None, "\U0001f600long\u00e9\U0001f600", "x" * 33, "x" * 71, "e", "one two"]
    spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    plain = lambda t: "".join(c for c in t if c not in " :,-\u2013;().")
    want = [(i, j) for i, t in enumerate(docs) for j, p in enumerate(items) if t is not None and p is not None and plain(p) in plain(t)]
    assert sorted((r.doc_id, r.item_id) for r in pages.merge_suspect(spark, str(tmp_path)).collect()) == want


@pytest.mark.parametrize("runs", [1, 7, 40])
def test_packing_in_runs_equals_one_fold(spark, runs):
    rng = np.random.default_rng(runs)
    rows = [(f"b{k % 4}" if k % 4 else None, k, int(n)) for k, n in enumerate(rng.choice([0, 1, 3, 10, 18, 19, 20, 21, 50], 900))]
    want, state = {}, {}
    for b, k, n in rows:
        chunk, used = state.get(b, (0, None))
        chunk, used = (chunk, used + 2 + n) if used is not None and used + 2 + n <= 20 else (chunk + 1, n)
        state[b] = chunk, used
        want[b, k] = chunk
    df = spark.createDataFrame(rows, "book string, at long, n int").repartition(5)
    got = paragraphs.pack_greedily(df, "book", ["at"], "n", 20, runs=runs)
    assert got.columns == ["book", "at", "n", "chunk_no"]
    assert {(r.book, r["at"]): r.chunk_no for r in got.collect()} == want
    assert paragraphs.pack_greedily(df.where("false"), "book", ["at"], "n", 20).count() == 0
    named = df.selectExpr("book", "lpad(at, 5, '0') as at", "n")
    assert {(r.book, int(r["at"])): r.chunk_no for r in paragraphs.pack_greedily(named, "book", ["at"], "n", 20).collect()} == want


def test_passages_in_slices_equal_one(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "".join(chr(97 + (i * k) % 26) for k in range(200))) for i in range(40)] + [(99, None)], "doc_id int, text string")
    wanted = docs.where("text is not null").selectExpr("doc_id as item", "substr(text, 20, 5 + doc_id) as passage")
    pairs = lambda: sorted((r.doc_id, r["item"]) for r in passages.passages_in(docs, wanted).collect())
    whole = pairs()
    texts, parts = docs.collect(), wanted.collect()
    assert whole == sorted((d.doc_id, p["item"]) for d in texts for p in parts if d.text and p.passage in d.text)
    monkeypatch.setattr(passages, "SENT_ROWS", 7)
    assert pairs() == whole
