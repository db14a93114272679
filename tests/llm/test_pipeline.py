"""The pipeline's stages against their decisions worked out plainly, on hard rows."""

import math

import duckdb
import numpy as np
import pandas as pd
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as cp
from quirekit.llm import ordinal_quality, power_pack, registry, skip_chain_pii, source_mix
from quirekit.llm.common import connected_components

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = np.random.default_rng(4)
    top = tmp_path_factory.mktemp("sf")
    vocabulary = [f"w{i}" for i in range(400)]
    rows, labels = [], []
    for i in range(240):
        words = rng.choice(vocabulary, 80).tolist()
        grade = i % 6
        if grade == 0:
            words = [f"{w}###" for w in words]
        elif grade == 1:
            words[5] = words[40] = "loser"
        rows.append((i, " ".join(words), "en", f"s{i % 3}" if i % 10 else None))
        labels.append((i, int(grade != 0), int(grade == 1)))
    rows += [(500 + i, rows[2][1] + " x", "en", "s1") for i in range(30)] + [(2, *rows[2][1:])]
    rows += [(600, "write to a.b@c.example.com at once " + rows[3][1], None, "s0"), (601, None, None, None), (602, "", "en", "s2"), (None, "no id " + rows[4][1], "en", "s2")]
    spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(top / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(top / "labels.parquet"))
    return str(top)


def test_stages_take_effect(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    clean = cp.quality(spark, docs, folder)
    assert clean.columns == COLUMNS
    kept = {r.doc_id for r in clean.collect()}
    good = {i for i in range(240) if i % 6 > 1}
    assert len(kept & good) > 0.97 * len(good) and len(kept & (set(range(240)) - good)) < 0.15 * 80
    alone = cp.near_duplicates(spark, docs, folder)
    assert alone.columns == COLUMNS
    ids = [r.doc_id for r in alone.collect()]
    assert ids.count(2) == 1 and not any(i and 500 <= i < 530 for i in ids) and ids.count(None) == 1 and {601, 602} <= set(ids) and 600 not in ids and len(ids) == 243
    bare = {r.doc_id: r for r in cp.personal_data(spark, docs, folder).collect()}
    assert bare[600].text.startswith("write to <email> at once ") and bare[600].n_chars == len(bare[600].text) and bare[601].text is None
    mixed = cp.mix(spark, docs, folder)
    assert mixed.columns == COLUMNS
    times = {}
    for r in mixed.collect():
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    assert max(times.values()) <= 6 and 601 not in times and sum(times.values()) > 100


def _plain_run(spark, rows, labels):
    """The five stages in plain Python, but for the fitted weights and, for the mix, its SQL."""
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    # quality
    grades = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = ordinal_quality.train(frame(rows), ordinal_quality.graded(grades), 3)
    features = ordinal_quality.Features()
    best = lambda t: 1 / (1 + math.exp(float(model.thresholds[-1]) - float(model.weights[features.of(t or "")].sum())))
    rows = [r for r in rows if best(r[1]) >= 0.5]
    # near duplicates
    sets = {}
    for r in rows:
        w = (r[1] or "").lower().split()
        if r[0] is not None and w:
            sets.setdefault(r[0], []).append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))})
    root = {i: i for i in sets}
    while True:
        new = {i: min(root[j] for j in sets if any(100 * len(a & b) >= 80 * len(a | b) for a in sets[i] for b in sets[j])) for i in sets}
        if new == root:
            break
        root = new
    rows = [r for r in rows if root.get(r[0], r[0]) == r[0]]
    rows = list({(r[0], r[1]): r for r in rows if r[0] is not None}.values()) + [r for r in rows if r[0] is None]
    # personal data
    field, out = skip_chain_pii.train(frame(rows)), []
    for r in rows:
        text = r[1]
        if text is not None:
            base, added = skip_chain_pii.tag([text], field)[0]
            hidden = {}
            for s, e, kind in sorted((s, -e, k) for k, *v in zip(skip_chain_pii.KINDS, base, added) for x in v for s, e in x):
                at = next((x for x in hidden if s < hidden[x][0] and x <= s), s)
                hidden[at] = (max(-e, hidden.get(at, (0, 0))[0]), hidden.get(at, (0, kind))[1])
            for s in sorted(hidden, reverse=True):
                text = f"{text[:s]}<{hidden[s][1]}>{text[hidden[s][0] :]}"
        out.append((r[0], text, *r[2:4], None if text is None else len(text)))
    # mix
    con = duckdb.connect()
    documents = pd.DataFrame(out, columns=COLUMNS).astype({"doc_id": "Int64"})  # noqa: F841
    con.sql("create table documents as select * from documents")
    con.sql(f"create table mixed as {source_mix.ORACLE.replace('SELECT k.doc_id, k.size', 'SELECT k.source, k.doc_id, k.size')}")
    times = {tuple(x[:3]): int(x[3] + 0.5) for x in con.sql("select doc_id, source, size, sum(taken) / sum(size) from mixed where size > 0 group by all").fetchall()}
    rows = [r for r in out for _ in range(times.get((r[0], r[3], len((r[1] or "").split())), 0))]
    # packing
    plain = Tokenizer.from_file(power_pack.default_tokenizer()[0])
    pieces = []
    for r in rows:
        ids = np.array([*plain.encode(r[1] or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        while at < len(ids):
            n = min(2048, 1 << ((len(ids) - at).bit_length() - 1))
            pieces.append((str(r[0]), at, n, ids[at : at + n].tobytes()))
            at += n
    return pieces


def test_run_equals_plain_stages(spark, folder):
    read = lambda t, *c: [tuple(r) for r in spark.read.parquet(f"{folder}/{t}.parquet").select(*c).collect()]
    want = _plain_run(spark, read("documents", *COLUMNS), read("labels", "doc_id", "quality", "toxic"))
    got = [(str(r.doc_id), r.start, r.length, bytes(r.ids)) for r in cp.run(spark, folder).collect()]
    assert len(cp.STAGES) == 5 and len(got) > 200 and "pipeline" in registry.queries()
    assert sorted(got) == sorted(want)


def test_stages_without_rows_and_with_clashing_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    clash = docs.selectExpr("*", "1 as size", "2 as _size", "'x' as row", "'y' as times", "'z' as spans", "3 as keep", "4 as component_id")
    for name, stage in cp.STAGES:
        assert stage(spark, docs.where("false"), folder).count() == 0
        got = stage(spark, clash, folder)
        assert name == "packing" or got.columns == clash.columns
        if name in ("quality", "near_duplicates", "mix"):
            assert got.count() == stage(spark, docs, folder).count() and {(r.size, r._size, r.row, r.times, r.spans) for r in got.collect()} == {(1, 2, "x", "y", "z")}


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 6), (6, 5), (20, 21), (20, 22), (20, 23), (3, 1), (4, 4)]
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 9: 5, 8: 5, 7: 5, 6: 5, 5: 5, 20: 20, 21: 20, 22: 20, 23: 20}
    chain = spark.range(300).selectExpr("id as a", "id + 1 as b")
    assert {r.component for r in connected_components(chain).collect()} == {0}
    assert connected_components(chain.where("false")).count() == 0
