"""Language-model scores by context-tree weighting over binary-decomposed bytes."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirekit.llm.common import small, texts_of, whole_runs, written

#: Bytes of context. A text is preceded by DEPTH bytes EDGE and followed by one, which UTF-8 never holds.
DEPTH, EDGE = 4, 0xFF
#: Contexts are handled in whole sets that share so many last bytes: at most 256^(DEPTH - KEPT + 1) grams a set.
KEPT = 3
#: What a counted key is: a byte after its context, a word, the end of a text.
GRAM, TOKEN, END, DOC = 0, 1, 2, 3
#: At most so many keys of each kind are frequent: those with over 1 in so many of all occurrences.
FREQUENT = {GRAM: 1 << 21, TOKEN: 1 << 20}
#: Text bytes handled at a time, and partial counts held before they are merged and sent on.
PART, HELD = 1 << 20, 1 << 18
LOG_HALF = np.log(0.5)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for x > 0 (Stirling's series after eight steps up)."""
    y = x + 8
    product = np.ones_like(x)
    for i in range(8):
        product *= np.where(x < 1e6, x + i, 1.0)
    s = np.where(x < 1e6, y, x)
    r = 1 / (s * s)
    series = (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r / 1680))) / s
    return (s - 0.5) * np.log(s) - s + 0.5 * np.log(2 * np.pi) + series - np.log(product)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a sequence with these counts."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1) - np.log(np.pi)


def dense_bits(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Zeros and ones at the 256 places of the binary decomposition (place 0 unused) from counts of the 256 bytes."""
    zeros, ones = np.zeros(256), np.zeros(256)
    for b in range(8):
        c = counts.reshape(1 << b, 2, -1).sum(-1)
        zeros[1 << b : 2 << b], ones[1 << b : 2 << b] = c[:, 0], c[:, 1]
    return zeros, ones


def mixed(zeros: np.ndarray, ones: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log weighted probability of a node, the weight of its own estimate, and that estimate of a one.

    ``below``: sum of the children's log weighted probabilities."""
    own = log_kt(zeros, ones)
    both = np.logaddexp(LOG_HALF + own, LOG_HALF + below)
    return both, np.exp(LOG_HALF + own - both), (ones + 0.5) / (zeros + ones + 1)


class Chunk:
    """Whole sets of grams that share their last three context bytes, KEPT in all. ``grams``: sorted codes, last context byte first, then the byte."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray) -> None:
        x = grams & 255
        self.lasts, self.of = np.unique(grams >> (8 * (DEPTH - 1)), return_inverse=True)
        size = 256 * len(self.lasts)
        self.counts = np.bincount(256 * self.of + x, weights=counts, minlength=size).reshape(-1, 256)
        self.below = np.zeros(size)  # sums of log weighted probabilities at depth KEPT, by last two bytes and place
        self.places = []  # for each bit: place, bit, probability of a one at depth KEPT
        for b in range(8):
            bit = (x >> (7 - b)) & 1
            step = (x >> (8 - b)) | (1 << b)
            child = child_first = p = log_child = None
            levels = []
            for d in range(DEPTH, KEPT - 1, -1):
                node = (grams >> (8 + 8 * (DEPTH - d))) << 8 | step
                first, ids = np.unique(node, return_index=True, return_inverse=True)[1:]
                zeros = np.bincount(ids, weights=np.where(bit == 0, counts, 0.0))
                ones = np.bincount(ids, weights=np.where(bit == 1, counts, 0.0))
                if d == DEPTH:
                    log_w, p = log_kt(zeros, ones), (ones + 0.5) / (zeros + ones + 1)
                    p = p[ids]
                else:
                    under = np.bincount(ids[child_first], weights=log_child, minlength=len(first))
                    log_w, w, own = mixed(zeros, ones, under)
                    levels.append((w[ids], own[ids]))
                child_first, log_child = first, log_w
            for w, own in levels:
                p = w * own + (1 - w) * p
            self.below += np.bincount(256 * self.of[first] + step[first], weights=log_w, minlength=size)
            self.places.append((step, bit, p))
        self.below = self.below.reshape(-1, 256)

    def log10(self, weight: np.ndarray, estimate: np.ndarray, own: np.ndarray, rest: np.ndarray) -> np.ndarray:
        """Log10 probability of each gram, from tables by ``lasts`` and place: the mixture at depth 2, and own + rest * (what
        is at depth 2) as that at depth 0."""
        total = np.zeros(len(self.of))
        for step, bit, p in self.places:
            at = self.of, step
            two = weight[at] * estimate[at] + (1 - weight[at]) * p
            one = own[at] + rest[at] * two
            total += np.log10(np.where(bit == 1, one, 1 - one))
        return total


class Lookup:
    """Vectorised hash table from 64-bit keys to values: at most half full, linear probing."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -(1 << 62), np.int64)
        self.values = np.zeros(1 << self.bits, np.float64)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.keys[slot] == -(1 << 62)
            at, which = np.unique(slot[free], return_index=True)
            won = left[free][which]
            self.keys[at], self.values[at] = keys[won], values[won]
            stay = self.keys[slot] != keys[left]
            left, slot = left[stay], (slot[stay] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values (0 where absent) and whether each key is there."""
        slot = self._slot(keys)
        here = self.keys[slot]
        found = here == keys
        values = np.where(found, self.values[slot], 0.0)
        open_ = np.flatnonzero(~found & (here != -(1 << 62)))
        slot = slot[open_]
        while len(open_):
            slot = (slot + 1) & ((1 << self.bits) - 1)
            here, want = self.keys[slot], keys[open_]
            hit = here == want
            found[open_[hit]] = True
            values[open_[hit]] = self.values[slot[hit]]
            stay = ~hit & (here != -(1 << 62))
            open_, slot = open_[stay], slot[stay]
        return values, found


class Words:
    """64-bit keys of words, remembered."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def keys(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > HELD:
            known.clear()
        out = []
        for w in words:
            k = known.get(w)
            if k is None:
                k = known[w] = word_key(w)
            out.append(k)
        return np.array(out, np.int64)


def word_key(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word) >> 1


def normal(text: str) -> bytes:
    """UTF-8 with A-Z lower-cased."""
    return text.encode("utf-8", "replace").lower()


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of every byte and its context in all texts, one after another, and where each text's codes start."""
    edge = bytes([EDGE])
    whole = np.frombuffer(b"".join([edge * DEPTH + t + edge for t in texts]), np.uint8)
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    starts = np.cumsum(sizes) - sizes
    own = np.arange(sizes.sum()) + np.repeat(DEPTH * np.arange(1, len(texts) + 1), sizes)
    code = whole[own].astype(np.int64)
    for d in range(1, DEPTH + 1):
        code |= whole[own - d].astype(np.int64) << (8 * (DEPTH + 1 - d))
    return code, starts


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, list[bytes]]]:
    """Rows in parts of about PART bytes of text."""
    for b in small(batches):
        texts = texts_of(b)
        cols = {n: b.column(i).to_pylist() for i, n in enumerate(b.schema.names) if n != "text"}
        i, held = 0, 0
        for j, t in enumerate(texts):
            held += len(t)
            if held >= PART or j == len(texts) - 1:
                yield {n: c[i : j + 1] for n, c in cols.items()}, [normal(x) for x in texts[i : j + 1]]
                i, held = j + 1, 0


def _merge(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    keys = np.concatenate([p[0] for p in parts])
    u, at = np.unique(keys, return_inverse=True)
    return u, *(np.bincount(at, weights=np.concatenate([p[i] for p in parts]), minlength=len(u)).astype(np.int64) for i in (1, 2))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of grams and words in a partition: kind, key, in training texts, in all."""

    def send(kind: int, keys: np.ndarray, train: np.ndarray, every: np.ndarray) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(keys), 1 << 17):
            s = slice(i, i + (1 << 17))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys[s]), kind, np.int8)), pa.array(keys[s]), pa.array(train[s]), pa.array(every[s])], names=["kind", "key", "train", "every"])

    parts: list = []
    seen: dict[bool, Counter] = {False: Counter(), True: Counter()}
    docs = {False: 0, True: 0}

    def words() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        got = []
        for held, c in seen.items():
            k, n = np.fromiter(map(word_key, c), np.int64, len(c)), np.fromiter(c.values(), np.int64, len(c))
            got.append((k, n * (not held), n))
            c.clear()
        return _merge(got)

    for cols, texts in _parts(batches):
        for held in (False, True):
            own = [t for t, h in zip(texts, cols["held_out"], strict=True) if h == held]
            if own:
                docs[held] += len(own)
                u, n = np.unique(grams(own)[0], return_counts=True)
                parts.append((u, n * (not held), n))
                for t in own:
                    seen[held].update(t.split())
        if sum(len(p[0]) for p in parts) > 4 * HELD:
            parts = [_merge(parts)]
            if len(parts[0][0]) > HELD:
                yield from send(GRAM, *parts.pop())
        if len(seen[False]) + len(seen[True]) > HELD // 2:
            yield from send(TOKEN, *words())
    if parts:
        yield from send(GRAM, *_merge(parts))
    yield from send(TOKEN, *words())
    n = np.array([docs[False]], np.int64)
    yield from send(END, np.zeros(1, np.int64), n, n + docs[True])


def count_keys(docs: DataFrame) -> DataFrame:
    """Kind, key, train and every over all texts (columns text, held_out), as a written table."""
    counted = docs.select("text", "held_out").mapInArrow(_count, "kind tinyint, key long, train long, every long")
    return written(counted.groupBy("kind", "key").agg(F.sum("train").alias("train"), F.sum("every").alias("every")))


def weigh_tree(counts: DataFrame) -> DataFrame:
    """Log10 probability (column log10) of each byte after its context under the weighted tree of training counts.

    Every place of the binary decomposition of a byte has its own tree, whose nodes are the contexts of 0 to DEPTH
    bytes; a node mixes its estimate half and half with the product of its children's. Grams are streamed in order, in whole
    sets that share their last KEPT bytes, so a task's memory is bounded; what they give to the nodes of two last bytes is
    summed; the two levels above have at most 257 nodes and meet on the driver. A second pass takes the mixtures down again.
    """
    grams = counts.where(F.col("kind") == GRAM).select("key", "train", "every", F.shiftright("key", 8 * (DEPTH - 1)).alias("last"))
    ordered = lambda df: df.withColumn("set", F.shiftright("key", 8 * (DEPTH - KEPT + 1))).repartition("last").sortWithinPartitions("last", "key")
    vectors = "last long, counts binary, below binary"

    def bottom(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_runs(batches, "set"):
            c = Chunk(t.column("key").to_numpy(), t.column("train").to_numpy().astype(np.float64))
            yield pa.RecordBatch.from_arrays([pa.array(c.lasts), *(pa.array([x.tobytes() for x in v], pa.binary()) for v in (c.counts, c.below))], names=["last", "counts", "below"])

    def total_of(pdf: pd.DataFrame, column: str) -> np.ndarray:
        return np.sum([np.frombuffer(x) for x in pdf[column]], axis=0)

    def second(pdf: pd.DataFrame) -> pd.DataFrame:
        n = total_of(pdf, "counts")
        both, weight, estimate = mixed(*dense_bits(n), total_of(pdf, "below"))
        return pd.DataFrame({"last": pdf["last"].iloc[:1], "counts": [n.tobytes()], "below": [both.tobytes()], "weight": [weight.tobytes()], "estimate": [estimate.tobytes()]})

    def first(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"last": pdf["last"].iloc[:1], "counts": [total_of(pdf, "counts").tobytes()], "below": [total_of(pdf, "below").tobytes()]})

    deep = ordered(grams).mapInArrow(bottom, vectors)
    nodes2 = written(deep.groupBy("last").applyInPandas(second, vectors + ", weight binary, estimate binary"))
    rows = nodes2.select(F.shiftright("last", 8).alias("last"), "counts", "below").groupBy("last").applyInPandas(first, vectors).collect()
    nodes = {r["last"]: (np.frombuffer(r["counts"]), mixed(*dense_bits(np.frombuffer(r["counts"])), np.frombuffer(r["below"]))) for r in sorted(rows)}
    total = np.sum([c for c, _ in nodes.values()], axis=0) if nodes else np.zeros(256)
    _, w0, p0 = mixed(*dense_bits(total), np.sum([m[0] for _, m in nodes.values()], axis=0) if nodes else np.zeros(256))
    # the probability at the root as a linear function of that at depth 2, for each last byte
    lines = {k: (w0 * p0 + (1 - w0) * w1 * p1, (1 - w0) * (1 - w1)) for k, (_, (_, w1, p1)) in nodes.items()}
    shared = counts.sparkSession.sparkContext.broadcast(lines)

    def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the row of a node of two last bytes comes before its grams
        tables: dict[int, tuple[np.ndarray, ...]] = {}
        for t in whole_runs(batches, "set"):
            head = t.filter(pc.is_valid(t.column("weight")))
            tables.update({k: (np.frombuffer(w), np.frombuffer(e), *shared.value[k >> 8]) for k, w, e in zip(*(head.column(i).to_pylist() for i in ("last", "weight", "estimate")), strict=True)})
            t = t.filter(pc.is_null(t.column("weight")))
            if t.num_rows:
                c = Chunk(t.column("key").to_numpy(), t.column("train").to_numpy().astype(np.float64))
                tables = {k: v for k, v in tables.items() if k >= c.lasts[0]}
                log10 = c.log10(*(np.stack([tables[k][i] for k in c.lasts.tolist()]) for i in range(4)))
                yield pa.RecordBatch.from_arrays([t.column("key").combine_chunks(), t.column("every").combine_chunks(), pa.array(log10)], names=["key", "every", "log10"])

    heads = nodes2.select(F.lit(-1).cast("long").alias("key"), F.lit(0).cast("long").alias("train"), F.lit(0).cast("long").alias("every"), "last", "weight", "estimate")
    return written(ordered(grams.unionByName(heads, allowMissingColumns=True)).mapInArrow(top, "key long, every long, log10 double"))


def score_texts(docs: DataFrame) -> DataFrame:
    """Scores of all texts under a model of the training ones.

    ``docs``: doc_id, text, held_out. Returns doc_id, held_out, n_bytes, n_tokens, n_known, train_tokens, base_score, score. ``score`` is the log10
    probability of the UTF-8 bytes (A-Z lower-cased) and an end mark under the context tree (``weigh_tree``), which
    stays as trained; -score * log2(10) / (n_bytes + 1) is the code length per byte. Tokens are words and one end; base_score is
    their add-one unigram log10 probability. Null texts are empty, with the end alone; repeated rows count each time; held-out
    texts never change counts; without training texts all counts are zero; further columns are ignored.
    Counts cover all texts. Keys with over one in FREQUENT of all occurrences, so at most that many, are broadcast as
    arrays; the remaining occurrences are joined to the counts by key, in which no key can be hot.
    """
    spark = docs.sparkSession
    counts = count_keys(docs)
    tree = weigh_tree(counts)
    sums = {r["kind"]: r for r in counts.groupBy("kind").agg(F.sum("train").alias("train"), F.sum("every").alias("every"), F.sum((F.col("train") > 0).cast("long")).alias("distinct")).collect()}
    total = lambda kind, what: int(sums[kind][what] or 0) if kind in sums else 0
    n_train = total(TOKEN, "train") + total(END, "train")
    n_distinct = total(TOKEN, "distinct") + (total(END, "train") > 0)
    floor = n_train + n_distinct + 1
    token = F.log10((F.col("train") + 1) / F.lit(float(floor)))
    tokens = counts.where(F.col("kind") == TOKEN).select("kind", "key", "every", token.alias("log10"), (F.col("train") > 0).alias("known"))
    table = tree.select(F.lit(GRAM).cast("tinyint").alias("kind"), "key", "every", "log10", F.lit(False).alias("known")).unionByName(tokens)
    least = F.when(F.col("kind") == GRAM, total(GRAM, "every") // FREQUENT[GRAM]).otherwise(total(TOKEN, "every") // FREQUENT[TOKEN])
    often = table.where(F.col("every") > least).select("kind", "key", "log10", "known").toArrow()
    kind, key, log10, known = (often.column(i).to_numpy() for i in range(4))
    # a word's value: its log10, shifted up where the word is unknown, so that one number tells both
    arrays = {GRAM: (key[kind == GRAM], log10[kind == GRAM]), TOKEN: (key[kind == TOKEN], np.where(known, log10, log10 + 1000)[kind == TOKEN])}
    shared = spark.sparkContext.broadcast(arrays)
    end_log, end_known = float(np.log10((total(END, "train") + 1) / floor)), int(total(END, "train") > 0)

    fields = "row long, kind tinyint, key long, times int, doc_id long, held_out boolean, n_bytes long, n_tokens long, n_known long, base_score double, score double"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = {k: Lookup(*v) for k, v in shared.value.items()}
        words = Words()

        def rare(rows: np.ndarray, kind: int, owner: np.ndarray, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
            if not len(keys):
                return
            order = np.lexsort((keys, owner))
            owner, keys = owner[order], keys[order]
            first = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (keys[1:] != keys[:-1])]))
            times = np.diff(np.append(first, len(keys))).astype(np.int32)
            n = len(first)
            none = [pa.nulls(n, t) for t in (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())]
            yield pa.RecordBatch.from_arrays([pa.array(rows[owner[first]]), pa.array(np.full(n, kind, np.int8)), pa.array(keys[first]), pa.array(times), *none], names=names)

        names = ["row", "kind", "key", "times", "doc_id", "held_out", "n_bytes", "n_tokens", "n_known", "base_score", "score"]
        for cols, texts in _parts(batches):
            rows = np.array(cols["row"], np.int64)
            code, starts = grams(texts)
            value, found = tables[GRAM].get(code)
            owner = np.repeat(np.arange(len(texts)), np.diff(np.append(starts, len(code))))
            points = np.bincount(owner, weights=value, minlength=len(texts))
            yield from rare(rows, GRAM, owner[~found], code[~found])
            split = [t.split() for t in texts]
            sizes = np.array([len(s) for s in split], np.int64)
            keys = words.keys([w for s in split for w in s])
            value, found = tables[TOKEN].get(keys)
            strange = value > 500
            value = np.where(strange, value - 1000, value)
            owner = np.repeat(np.arange(len(texts)), sizes)
            base = np.bincount(owner, weights=value, minlength=len(texts)) + end_log
            n_known = np.bincount(owner, weights=found & ~strange, minlength=len(texts)).astype(np.int64) + end_known
            yield from rare(rows, TOKEN, owner[~found], keys[~found])
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows), pa.array(np.full(len(rows), DOC, np.int8)), pa.array(rows), pa.array(np.ones(len(rows), np.int32)), pa.array(cols["doc_id"], pa.int64()), pa.array(cols["held_out"], pa.bool_()),
                 pa.array([len(t) for t in texts], pa.int64()), pa.array(sizes + 1), pa.array(n_known), pa.array(base), pa.array(points)], names=names)

    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "text")
    parts = numbered.mapInArrow(score, fields)
    rest = table.where(F.col("every") <= least).select("kind", "key", F.col("log10").alias("_log10"), F.col("known").alias("_known"))
    got = parts.join(rest, ["kind", "key"], "left")
    add = F.coalesce(F.col("times") * F.col("_log10"), F.lit(0.0))
    is_token = F.col("kind") == TOKEN
    got = got.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.max("n_bytes").alias("n_bytes"), F.max("n_tokens").alias("n_tokens"),
        (F.max("n_known") + F.sum(F.when(is_token & F.col("_known"), F.col("times")).otherwise(0))).alias("n_known"), F.lit(n_train).cast("long").alias("train_tokens"),
        (F.max("base_score") + F.sum(F.when(is_token, add).otherwise(0.0))).alias("base_score"), (F.max("score") + F.sum(F.when(is_token, 0.0).otherwise(add))).alias("score"),
    )
    return got.drop("row")


def op5_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents``; a seventh of them, by the crc32 of the id, is held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    crc = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    out = score_texts(docs.select("doc_id", "text", (crc % 7 == 2).alias("held_out")))
    return out.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes")
