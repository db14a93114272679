"""Quality by ordinal cumulative-link regression on graded ratings over hashed text."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirekit.llm.common import small, texts_of

#: Hashed features; weights are shared by all grades.
BITS = 18
SLOTS = 1 << BITS
#: Most labelled rows that a model is fitted on, always whole ones, and their features; a row of over a hundredth of these isn't
#: sampled.
SAMPLE_ROWS, SAMPLE_FEATURES = 6000, 6_000_000
#: Features in fewer sampled rows than this keep the weight zero.
LEAST_ROWS = 10
EDGE = re.compile(r"\W*")
#: Words of a generation that a Python worker remembers; those of the generation before are kept as long as they occur.
CACHED = 50_000


def _slot(kind: str, value: str) -> int:
    return xxhash.xxh32_intdigest(f"{kind}\0{value}".encode("utf-8", "surrogatepass")) & (SLOTS - 1)


class Features:
    """Slots of a text: its distinct words without case and edge marks, the marks, and shares of shapes in steps."""

    def __init__(self) -> None:
        self.known: dict[str, tuple[int, int, int, int]] = {}
        self.older: dict[str, tuple[int, int, int, int]] = {}

    def _word(self, w: str) -> tuple[int, int, int, int]:
        begin = EDGE.match(w).end()
        end = max(begin, len(w) - EDGE.match(w[::-1]).end())
        head, core, tail = w[:begin], w[begin:end], w[end:]
        upper = len(core) > 1 and core.isupper()
        marks = _slot("mark", head + " " + tail) if len(tail) > 1 or head or not core else -1
        return _slot("word", core.lower()) if core else -1, marks, int(upper), int(marks >= 0)

    def of(self, text: str) -> np.ndarray:
        words = text.split()
        if len(self.known) > CACHED:
            self.known, self.older = {}, self.known
        known, distinct, n = self.known, set(words), len(words)
        for w in distinct:
            if w not in known:
                known[w] = self.older.get(w) or self._word(w)
        slots = {x for w in distinct for x in known[w][:2]}
        slots.discard(-1)
        if n:
            upper = sum(known[w][2] for w in distinct) / len(distinct)
            marked = sum(known[w][3] for w in distinct) / len(distinct)
            slots.add(_slot("upper", str(round(upper * 8))))
            slots.add(_slot("marked", str(round(marked * 8))))
            slots.add(_slot("repeats", str(round(len(distinct) / n * 8) if n > 20 else 8)))
        slots.add(_slot("words", str(min(n.bit_length(), 12))))
        return np.fromiter(sorted(slots), np.int32, len(slots))


@dataclass(frozen=True)
class OrdinalModel:
    """P(grade > j) = sigmoid(sum of weights - threshold_j), thresholds ascending; grades 0 .. len(thresholds)."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, slots: np.ndarray) -> np.ndarray:
        s = float(self.weights[slots].sum())
        return 1 / (1 + np.exp(np.clip(self.thresholds - s, -40, 40)))


def fit(rows: list[np.ndarray], grades: np.ndarray, classes: int, *, epochs: int = 30, rate: float = 0.3, l2: float = 3e-3, least_rows: int = LEAST_ROWS) -> OrdinalModel:
    """Maximum likelihood by AdaGrad over mini-batches in a fixed order.

    Thresholds are a first one and positive steps, so they stay in order. Without rows, or with one grade only, the
    weights stay zero and the thresholds follow the (smoothed) grade shares.
    """
    n = len(rows)
    held = np.zeros(SLOTS, np.int64)
    for r in rows:
        held[r] += 1
    rows = [r[held[r] >= least_rows] for r in rows]
    share = np.array([(np.sum(grades > j) + 0.5) / (n + 1) for j in range(classes - 1)])
    theta = -np.log(share / (1 - share))
    steps = np.log(np.maximum(np.diff(theta), 1e-2))
    w = np.zeros(SLOTS)
    seen_w, seen_t = np.full(SLOTS, 1e-6), np.full(classes - 1, 1e-6)
    free = np.concatenate([theta[:1], steps])
    sizes = np.array([len(r) for r in rows], np.int64)
    flat = np.concatenate([r for r in rows]) if n else np.zeros(0, np.int32)
    starts = np.concatenate([[0], np.cumsum(sizes)]) if n else np.zeros(1, np.int64)
    rng = np.random.default_rng(11)

    def ends() -> np.ndarray:
        return np.cumsum(np.concatenate([free[:1], np.exp(free[1:])]))

    for _ in range(epochs if len(set(grades.tolist())) > 1 else 0):
        order = rng.permutation(n)
        for k in range(0, n, 64):
            pick = order[k : k + 64]
            idx = np.concatenate([flat[starts[i] : starts[i + 1]] for i in pick])
            owner = np.repeat(np.arange(len(pick)), sizes[pick])
            s = np.bincount(owner, weights=w[idx], minlength=len(pick))
            th = ends()
            hi = np.concatenate([th, [np.inf]])[grades[pick]]
            lo = np.concatenate([[-np.inf], th])[grades[pick]]
            sig = lambda x: 1 / (1 + np.exp(-np.clip(x, -40, 40)))
            a, b = sig(hi - s), sig(lo - s)
            p = np.maximum(a - b, 1e-9)
            da, db = a * (1 - a), b * (1 - b)
            ds = (db - da) / p  # of log p, by score
            gw = np.bincount(idx, weights=np.repeat(ds, sizes[pick]), minlength=0)
            at = np.unique(idx)
            g = gw[at] / len(pick) - l2 * w[at]
            seen_w[at] += g * g
            w[at] += rate * g / np.sqrt(seen_w[at])
            gth = np.zeros(classes - 1)
            np.add.at(gth, grades[pick][grades[pick] < classes - 1], (da / p)[grades[pick] < classes - 1])
            np.add.at(gth, grades[pick][grades[pick] > 0] - 1, -(db / p)[grades[pick] > 0])
            gf = np.concatenate([[gth.sum()], [gth[j:].sum() * np.exp(free[j]) for j in range(1, classes - 1)]]) / len(pick)
            seen_t += gf * gf
            free = free + 0.1 * gf / np.sqrt(seen_t)
    return OrdinalModel(w.astype(np.float32), ends())


def train(docs: DataFrame, ratings: DataFrame, classes: int, *, most: int = SAMPLE_ROWS, most_features: int = SAMPLE_FEATURES) -> OrdinalModel:
    """Model from ``ratings`` (doc_id, grade): the ``most`` rated rows of smallest hash, as far as they have ``most_features``
    features together; the worst grade where ratings of a row disagree, one text where texts do."""
    rated = ratings.where("grade is not null and doc_id is not null").groupBy("doc_id").agg(F.min("grade").alias("grade"))
    chosen = rated.orderBy(F.xxhash64(F.lit(5), "doc_id"), "doc_id").limit(most)
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Features()
        for b in small(batches):
            got = [f.of(t) for t in texts_of(b)]
            n = pa.array([len(x) for x in got], pa.int32())
            slots = pa.array([x.tobytes() if len(x) * 100 <= most_features else None for x in got], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2).cast(pa.int32()), n, slots], names=["doc_id", "grade", "n", "slots"])

    got = sample.mapInArrow(features, "doc_id long, grade int, n int, slots binary").where("slots is not null")
    # rows of one id count once; ``most`` ids at most
    got = got.groupBy("doc_id").agg(F.min(F.struct("slots", "n", "grade")).alias("x")).select("doc_id", "x.*")
    upto = F.sum("n").over(Window.orderBy(F.xxhash64(F.lit(5), "doc_id"), "doc_id"))
    got = got.withColumn("_upto", upto).where(F.col("_upto") <= most_features).toPandas().sort_values("doc_id")
    return fit([np.frombuffer(x, np.int32) for x in got["slots"]], got["grade"].to_numpy(np.int64), classes)


def score_quality(docs: DataFrame, model: OrdinalModel, *, least: float = 0.5) -> DataFrame:
    """Adds expected_grade, tail (probability of the best grade) and keep (tail >= ``least``) to ``docs``.

    ``docs`` needs text; null and empty texts are scored as texts without words; repeated rows get equal scores; all other
    columns stay as they are, and columns of those three names are replaced. An empty table stays empty. The model
    (one float per slot) is broadcast; nothing is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in docs.columns if c not in ("expected_grade", "tail", "keep")]
    out = docs.select(*keep)
    at = keep.index("text")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f, m = Features(), shared.value
        for b in small(batches):
            tails = [m.tails(f.of(x or "")) for x in b.column(at).to_pylist()]
            e = pa.array([float(t.sum()) for t in tails], pa.float64())
            last = pa.array([float(t[-1]) for t in tails], pa.float64())
            kept = pa.array([bool(t[-1] >= least) for t in tails], pa.bool_())
            yield pa.RecordBatch.from_arrays([*b.columns, e, last, kept], names=[*b.schema.names, "expected_grade", "tail", "keep"])

    more = [T.StructField(n, k) for n, k in (("expected_grade", T.DoubleType()), ("tail", T.DoubleType()), ("keep", T.BooleanType()))]
    return out.mapInArrow(score, T.StructType([*out.schema.fields, *more]))


def graded(labels: DataFrame) -> DataFrame:
    """Grades from ``labels``: 0 toxic, 1 of low quality, 2 neither."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    return labels.select("doc_id", grade.alias("grade"))


def model_for(spark: SparkSession, docs: DataFrame, sf_dir: str) -> OrdinalModel:
    """The production model: three grades from the ``labels`` of a folder."""
    return train(docs, graded(spark.read.parquet(f"{sf_dir}/labels.parquet")), 3)


def op7_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` with their scores."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return score_quality(docs, model_for(spark, docs, sf_dir)).select("doc_id", "expected_grade", "tail", "keep")
