"""Personal data by patterns and a skip-chain conditional random field over the tokens that could hold some."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirekit.llm.common import small, texts_of

KINDS = ("email", "ip", "card", "phone")
#: Labels of the field: other, then the kinds.
LABELS = 1 + len(KINDS)
EMAIL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a run of digits can only begin a match at its first digit, and looking from there alone keeps long runs linear
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
#: Tokens that could hold personal data: runs without white space that hold a digit or @, without outer marks.
TOKEN = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*")
OUTER = " \t\n\r\f\v,;:!?\"'<>[]{}|"
#: Documents that weights are fitted on at most, always whole ones, and their tokens; one of over a twentieth of these isn't sampled.
SAMPLE_ROWS, SAMPLE_TOKENS = 2000, 200_000
#: One in so many sampled documents is held out to choose the threshold; the share of its tags there that must be right.
HELD_OUT, PRECISION = 4, 0.98
#: Thresholds to choose from.
THRESHOLDS = (0.7, 0.75, 0.8, 0.85, 0.9, 0.95, 0.98)
#: Texts whose fields are worked out together.
TOGETHER = 500
#: Largest change of a message that counts as settled.
SETTLED = 1e-6
#: Prior mean of the skip potential of two equal labels, and the rows of data that it is worth.
SKIP_PRIOR, SKIP_WORTH = 2.0, 2.0


def luhn(digits: str) -> bool:
    """Whether the digits pass the Luhn check."""
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses, found from each @ so that long runs without one cost nothing."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        i = at
        while i > last and text[i - 1] in EMAIL_CHARS:
            i -= 1
        m = EMAIL_DOMAIN.match(text, at + 1) if i < at else None
        if m:
            out.append((i, m.end()))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    return out


def base_spans(text: str) -> list[list[tuple[int, int]]]:
    """Spans of each kind by pattern and check, leftmost and non-overlapping within a kind; failing matches are dropped."""
    out = [emails(text) if "@" in text else [], [], [], []]
    if DIGIT.search(text):
        out[1] = [m.span() for m in IP.finditer(text) if all(len(n := p.lstrip("0")) <= 3 and int(n or 0) <= 255 for p in m[0].split("."))]
        for m in CARD.finditer(text):
            d = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(d) <= 19 and luhn(d):
                out[2].append(m.span())
        if "+" in text:
            out[3] = [m.span() for m in PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


@dataclass
class Document:
    """Candidate tokens of a text: spans, features, label by pattern (0: none), and skip links."""

    spans: list[tuple[int, int]]
    features: np.ndarray
    labels: np.ndarray
    skips: np.ndarray
    starts: np.ndarray | None = None


def together(docs: list[Document]) -> Document:
    """Several documents as one, without links between them; ``starts``: the first tokens."""
    at = np.cumsum([0] + [len(d.spans) for d in docs])
    skips = [d.skips + i for d, i in zip(docs, at)]
    return Document([x for d in docs for x in d.spans], np.concatenate([d.features for d in docs]), np.concatenate([d.labels for d in docs]), np.concatenate(skips), at[:-1])


FEATURES = 28


def _features(token: str, before: str, gap: int) -> np.ndarray:
    f = np.zeros(FEATURES, np.float32)
    number = "".join(DIGIT.findall(token))
    digits = len(number)
    f[0] = 1
    f[1 + min(digits, 10)] = 1
    f[12] = "@" in token
    f[13] = token.count(".") == 3
    f[14] = token.startswith("+")
    f[15] = digits == len(token)
    f[16] = any(c.isalpha() for c in token)
    f[17] = "-" in token
    f[18] = "(" in token or ")" in token
    f[19] = before.endswith("+") or before.startswith("+")
    f[20] = gap == 1
    f[21] = 13 <= digits <= 19
    f[22] = "=" in token or '"' in token
    f[23] = digits > 19
    f[24] = 13 <= digits <= 19 and luhn(number)
    f[25] = token.count(".") == 3 and all(p.isdecimal() and len(p) <= 3 and int(p) <= 255 for p in token.split("."))
    f[26] = "@" in token[1:] and "." in token.rpartition("@")[2][1:-1]
    f[27] = before.endswith(")")
    return f


def alike_keys(token: str) -> list[str]:
    """Tokens that share a key are joined: equal but for case, of equal digits (seven or more), or of as many digits (eight or
    more) with an equal first or last half, as a number and a slip of it have."""
    number = "".join(DIGIT.findall(token))
    keys = [token.lower()]
    if len(number) >= 7:
        keys.append(number)
    if 8 <= len(number) <= 19:
        half = len(number) // 2
        keys += [f"{len(number)}<{number[:half]}", f"{len(number)}>{number[half:]}"]
    return list(dict.fromkeys(keys))


def document(text: str, base: list[list[tuple[int, int]]]) -> Document:
    """Tokens that could hold personal data; skip links join each to the last one before it that shares one of ``alike_keys``."""
    spans, feats, labels, links = [], [], [], []
    last: dict[str, int] = {}
    at, before, end = [0] * len(base), "", -9
    for m in TOKEN.finditer(text):
        raw = m[0]
        token = raw.strip(OUTER).rstrip(".")
        if not token:
            continue
        s = m.start() + raw.index(token)
        e = s + len(token)
        label, first = 0, None
        for k, marks in enumerate(base):  # of each kind the first span that ends after the token's start
            while at[k] < len(marks) and marks[at[k]][1] <= s:
                at[k] += 1
            if at[k] < len(marks) and marks[at[k]][0] < e and (first is None or marks[at[k]] < first):
                label, first = k + 1, marks[at[k]]
        i = len(spans)
        spans.append((s, e))
        feats.append(_features(token, before, s - end))
        labels.append(label)
        for key in alike_keys(token):
            if key in last:
                links.append((last[key], i))
            last[key] = i
        before, end = token, e
    return Document(spans, np.array(feats, np.float32).reshape(-1, FEATURES), np.array(labels, np.int64), np.array(sorted(set(links)), np.int64).reshape(-1, 2))


@dataclass(frozen=True)
class Field:
    """Weights: unary (features x labels), chain and skip (labels x labels, symmetric for skip); ``least``: the threshold."""

    unary: np.ndarray
    chain: np.ndarray
    skip: np.ndarray
    least: float = 0.9


def _edges(d: Document) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(d.spans)
    chain = np.stack([np.arange(n - 1), np.arange(1, n)], 1) if n > 1 else np.zeros((0, 2), np.int64)
    if d.starts is not None:  # no chain from one text to the next
        chain = chain[~np.isin(chain[:, 1], d.starts)]
    e = np.concatenate([chain, d.skips])
    return e[:, 0], e[:, 1], np.arange(len(e)) >= len(chain)


def fit(docs: list[Document], steps: int = 200, rate: float = 0.3, l2: float = 1e-3) -> Field:
    """Maximum pseudo-likelihood: each token given its neighbours' labels along the chain and the skip links.

    Skip weights have a Gaussian prior around SKIP_PRIOR for equal labels, the others around zero."""
    docs = [d for d in docs if len(d.spans)]
    prior = SKIP_PRIOR * np.eye(LABELS)
    u, c, s = np.zeros((FEATURES, LABELS)), np.zeros((LABELS, LABELS)), prior.copy()
    if not docs:
        return Field(u, c, s)
    x = np.concatenate([d.features for d in docs]).astype(np.float64)
    y = np.concatenate([d.labels for d in docs])
    n = len(y)
    left, right, hop = np.zeros((n, LABELS)), np.zeros((n, LABELS)), np.zeros((n, LABELS))
    at = 0
    for d in docs:
        a, b, skip = _edges(d)
        one = np.eye(LABELS)[d.labels]
        np.add.at(left, at + b[~skip], one[a[~skip]])
        np.add.at(right, at + a[~skip], one[b[~skip]])
        np.add.at(hop, at + b[skip], one[a[skip]])
        np.add.at(hop, at + a[skip], one[b[skip]])
        at += len(d.spans)
    target = np.eye(LABELS)[y]
    seen = [np.full_like(w, 1e-8) for w in (u, c, s)]
    for _ in range(steps):
        z = x @ u + left @ c + right @ c.T + hop @ s
        z -= z.max(1, keepdims=True)
        p = np.exp(z)
        p /= p.sum(1, keepdims=True)
        g = (target - p) / n
        gs = hop.T @ g
        pull = SKIP_WORTH / n * (prior - s)
        for w, gw, h in zip((u, c, s), (x.T @ g - l2 * u, left.T @ g + g.T @ right - l2 * c, gs + gs.T + pull), seen, strict=True):
            h += gw * gw
            w += rate * gw / np.sqrt(h)
    return Field(u, c, s)


def marginals(d: Document, field: Field, rounds: int | None = None) -> np.ndarray:
    """Loopy belief propagation on chain and skip edges together; labels found by pattern are evidence.

    Messages pass until they settle, or ``rounds`` times, so evidence reaches any number of links far. A round looks only
    at edges beside a change. Steps of an edge that doesn't settle are halved again and again, so that passing ends."""
    n = len(d.spans)
    theta = d.features @ field.unary
    fixed = d.labels > 0
    theta[fixed] = np.where(np.eye(LABELS)[d.labels[fixed]] > 0, 0.0, -30.0)
    a, b, skip = _edges(d)
    pair = np.where(skip[:, None, None], field.skip[None], field.chain[None])
    to_b, to_a = np.zeros((len(a), LABELS)), np.zeros((len(a), LABELS))
    ends = np.concatenate([a, b])
    by_end = np.argsort(ends, kind="stable") % max(len(a), 1)
    first = np.searchsorted(np.sort(ends), np.arange(n + 1))
    belief = theta.astype(np.float64)
    passed, calm = np.zeros(len(a), np.int64), 100 + 10 * int(n**0.5)
    e, done = np.arange(len(a)), 0
    while len(e) and (rounds is None or done < rounds):
        new_b = np.logaddexp.reduce((belief[a[e]] - to_a[e])[:, :, None] + pair[e], axis=1)
        new_a = np.logaddexp.reduce((belief[b[e]] - to_b[e])[:, None, :] + pair[e], axis=2)
        new_b -= np.logaddexp.reduce(new_b, axis=1, keepdims=True)
        new_a -= np.logaddexp.reduce(new_a, axis=1, keepdims=True)
        step = 0.5 ** (1 + np.maximum(passed[e] - calm, 0) // 10)[:, None]
        more_b, more_a = step * (new_b - to_b[e]), step * (new_a - to_a[e])
        to_b[e] += more_b
        to_a[e] += more_a
        np.add.at(belief, b[e], more_b)
        np.add.at(belief, a[e], more_a)
        passed[e] += 1
        moved_b, moved_a = np.abs(more_b).max(1) >= SETTLED, np.abs(more_a).max(1) >= SETTLED
        at = np.unique(np.concatenate([b[e][moved_b], a[e][moved_a]]))
        held = first[at + 1] - first[at]
        e = np.unique(by_end[np.repeat(first[at] - np.cumsum(held) + held, held) + np.arange(held.sum())])
        done += 1
    belief -= np.logaddexp.reduce(belief, axis=1, keepdims=True)
    return np.exp(belief)


def tag(texts: list[str], field: Field) -> list[tuple[list[list[tuple[int, int]]], list[list[tuple[int, int]]]]]:
    """For each text, spans of each kind by pattern, and those that the field adds: tokens that no pattern took and whose
    probability of a kind reaches the threshold; neighbours of one kind, a space apart, are one span."""
    base = [base_spans(t) for t in texts]
    docs = [document(t, b) for t, b in zip(texts, base, strict=True)]
    out = [(b, [[] for _ in KINDS]) for b in base]
    open_ = [i for i, d in enumerate(docs) if (d.labels == 0).any()]
    if not open_:
        return out
    whole = together([docs[i] for i in open_])
    p = marginals(whole, field)
    kind = np.where((whole.labels == 0) & (p[:, 1:].max(1) >= field.least), p[:, 1:].argmax(1), -1)
    at = 0
    for i in open_:
        last, until = -1, -9
        for (s, e), k in zip(docs[i].spans, kind[at : at + len(docs[i].spans)].tolist(), strict=True):
            if k >= 0:
                mine = out[i][1][k]
                if k == last and s - until == 1:
                    mine[-1] = (mine[-1][0], e)
                else:
                    mine.append((s, e))
            last, until = k, e
        at += len(docs[i].spans)
    return out


def threshold(docs: list[Document], field: Field, precision: float = PRECISION) -> float:
    """The lowest of THRESHOLDS from which on tags agree with the patterns' labels, hidden from the field, to ``precision``."""
    docs = [d for d in docs if len(d.spans)]
    if not docs:
        return THRESHOLDS[-1]
    whole = together(docs)
    truth, whole.labels = whole.labels, np.zeros_like(whole.labels)
    p = marginals(whole, field)
    best, sure = p[:, 1:].argmax(1) + 1, p[:, 1:].max(1)
    least = THRESHOLDS[-1]
    for t in reversed(THRESHOLDS):
        said = sure >= t
        if not said.any() or (best[said] == truth[said]).mean() < precision:
            break
        least = t
    return least


def train(docs: DataFrame, *, most: int = SAMPLE_ROWS, most_tokens: int = SAMPLE_TOKENS) -> Field:
    """Weights and threshold from the patterns' labels on the ``most`` documents of smallest hash among those that hold a digit or
    @, whole ones, as far as they have ``most_tokens`` tokens together; one in HELD_OUT of them chooses the threshold."""

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches, TOGETHER):
            got = [document(t, base_spans(t)) for t in texts_of(b)]
            got = [d if len(d.spans) <= most_tokens // 20 else document("", []) for d in got]
            columns = [pa.array([x.tobytes() for x in v], pa.binary()) for v in zip(*((d.features, d.labels, d.skips) for d in got), strict=True)] or [pa.array([], pa.binary())] * 3
            yield pa.RecordBatch.from_arrays([b.column(0), *columns, pa.array([len(d.spans) for d in got], pa.int32())], names=["h", "f", "y", "k", "n"])

    key = F.xxhash64(F.lit(3), "text")
    chosen = docs.where(F.col("text").rlike("[0-9@]")).select(key.alias("h")).distinct().orderBy("h").limit(most)
    sample = docs.select(key.alias("h"), "text").join(F.broadcast(chosen), "h").mapInArrow(prepare, "h long, f binary, y binary, k binary, n int")
    once = sample.where("n > 0").groupBy("h").agg(*(F.first(c).alias(c) for c in ("f", "y", "k", "n")))  # ``most`` rows at most
    got = once.withColumn("_upto", F.sum("n").over(Window.orderBy("h"))).where(F.col("_upto") <= most_tokens).toPandas().sort_values("h")
    rows = [Document([(0, 0)] * r.n, np.frombuffer(r.f, np.float32).reshape(-1, FEATURES), np.frombuffer(r.y, np.int64), np.frombuffer(r.k, np.int64).reshape(-1, 2)) for r in got.itertuples()]
    fitted = fit([d for i, d in enumerate(rows) if i % HELD_OUT])
    return replace(fitted, least=threshold(rows[::HELD_OUT], fitted))


SPANS = T.ArrayType(T.StructType().add("kind", "string").add("start", "long").add("end", "long").add("base", "boolean"))


def find_personal_data(docs: DataFrame, field: Field) -> DataFrame:
    """Adds ``spans`` to ``docs``: kind, start, end (code points, end exclusive) and base (found by pattern).

    Spans come by kind (email, ip, card, phone) and then by start. The patterns' spans always stay; the field adds tokens
    whose probability of a kind reaches its threshold. Null and empty texts have none;
    repeated rows get equal spans; ``docs`` needs text, keeps its other columns, and a column named spans is replaced. An
    empty table stays empty. Time and memory are linear in a text's length; nothing is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)
    out = docs.select(*[c for c in docs.columns if c != "spans"])
    at = out.columns.index("text")
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for b in small(batches, TOGETHER):
            rows = []
            for base, added in tag([t or "" for t in b.column(at).to_pylist()], w):
                rows.append([{"kind": k, "start": s, "end": e, "base": own} for k, x, y in zip(KINDS, base, added, strict=True) for s, e, own in sorted([(*v, True) for v in x] + [(*v, False) for v in y])])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(rows, kind)], names=[*b.schema.names, "spans"])

    return out.mapInArrow(find, T.StructType([*out.schema.fields, T.StructField("spans", SPANS)]))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` (text, spans) with each span replaced by its kind in angle brackets; overlapping spans are replaced together, by the kind of the first."""
    first = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("s"), (-s["end"]).alias("e"), s["kind"].alias("k"))))
    begin = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("done"))

    def step(acc, x):
        more = F.concat(acc["done"], F.substring("text", acc["at"].cast("int") + 1, (x["s"] - acc["at"]).cast("int")), F.lit("<"), x["k"], F.lit(">"))
        return F.struct(F.greatest(-x["e"], acc["at"]).alias("at"), F.when(x["s"] >= acc["at"], more).otherwise(acc["done"]).alias("done"))

    text = F.aggregate(first, begin, step, lambda acc: F.concat(acc["done"], F.substring(F.col("text"), acc["at"].cast("int") + 1, F.length("text"))))
    return docs.withColumn("text", F.when(F.size("spans") > 0, text).otherwise(F.col("text")))


def op2_skip_chain_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_personal_data(docs, train(docs))
    base = F.filter("spans", lambda s: s["base"])
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda k: F.size(F.filter(base, lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *map(count, KINDS), F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
