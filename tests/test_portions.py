import tracemalloc

import pyarrow as pa
from pyspark.sql import functions as F

from quirekit.functions import markup
from quirekit.operators import pages as pg

LINE = "One two three goes on. Then four (five?) follows, and M. Smith said so! " * 12


def test_portions_hold_every_text_once_and_few_bytes():
    texts = pa.array(["", None, "ab", "é" * 5, "x" * 50, "", *["abc"] * 9, None])
    for most in (1, 7, 12, 1000):
        parts = list(pg.portions(texts, most))
        assert [t for p in parts for t in p.to_pylist()] == texts.to_pylist()
        assert all(len(p) == 1 or sum(len((t or "").encode()) + 1 for t in p.to_pylist()) <= most for p in parts)
    assert [p.to_pylist() for p in pg.portions(texts.slice(4, 3), 5)] == [["x" * 50], ["", "abc"]] and not list(pg.portions(texts.slice(0, 0)))


def test_typesetting_a_batch_holds_one_portion():
    texts = pa.array(["\n\n".join([LINE, *["word " * 60] * 20])] * 1500)
    tracemalloc.start()
    n = sum(len(out) for out in pg.typeset_paragraphs.func(iter([texts])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 1500 and peak < 6 << 20 < texts.nbytes


def test_texts_of_several_portions_equal_those_of_one(spark):
    texts = [None, "", " \n\n ", "<sup>x\n\ny</sup>", "é" * 600_000, *["\n\n".join([LINE] * (i % 7)) for i in range(300)]]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string").coalesce(1)
    got = df.select("id", pg.typeset_paragraphs(F.col("t")).alias("p"), pg.sentence_ends(F.col("t")).alias("e"), pg.repair_inline(F.col("t")).alias("r"), pg.split_long(F.col("t")).alias("s")).collect()
    for r in got:
        t = texts[r.id]
        assert (r.p, r.e, tuple(r.r)) == (markup.typeset_paragraphs(t or ""), markup.sentence_ends(t or ""), markup.repair_inline(t or ""))
        assert r.s == markup.split_long(t or "")
    assert len(got) == len(texts)
    assert df.where("id < 0").select(pg.typeset_paragraphs(F.col("t"))).collect() == []
