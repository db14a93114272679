"""Exact n-gram Jaccard join by prefixes, with documents of equal prefix and size handled as one group."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirekit.llm.common import Tables, connected_components, pairs_of, salted_join, small, texts_of, whole_runs
from quirekit.llm.context_tree import Words, normal

#: Shingles are ordered by how often their cell of a histogram of 2^CELL_BITS cells occurs, then by hash. Any order gives
#: the same links; this one keeps frequent shingles out of prefixes. The histogram has a fixed size.
CELL_BITS, STRIPE_BITS = 22, 14
COUNT_TYPES = (np.uint8, np.uint16, np.uint32, np.int64)
#: Bits of a set's mark at least; a mark has as many as the set has shingles, rounded up to a power of two.
LEAST_MARK = 256
#: Rows of a list that are compared with as many others at a time, and bytes of marks held at a time.
BLOCK, MARK_BYTES = 512, 8 << 20
#: Rows of eight bytes each that may be broadcast.
BROADCAST_ROWS = 1 << 18
_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _M2
    h = (h ^ (h >> np.uint64(27))) * _M3
    return h ^ (h >> np.uint64(31))


def shingle_set(keys: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``width`` words (of all words, if there are fewer) from the words' hashes."""
    k = keys.astype(np.uint64)
    if not len(k):
        return np.zeros(0, np.uint64)
    w = min(width, len(k))
    h = np.full(len(k) - w + 1, w, np.uint64)
    for i in range(w):
        h = _mix(h * _M1 + k[i : len(k) - w + 1 + i])
    return np.unique(h)


class Shingler:
    """Shingle sets of texts."""

    def __init__(self, width: int) -> None:
        self.width, self.words = width, Words()

    def of(self, text: str) -> np.ndarray:
        return shingle_set(self.words.keys(normal(text).split()), self.width)


def prefix_length(n: int, percent: int) -> int:
    """Two sets of likeness ``percent`` or more share one of their first so many elements, in any common order."""
    return n - -(-n * percent // 100) + 1


def _narrow(counts: np.ndarray) -> bytes:
    """The counts in the narrowest type that holds them."""
    return counts.astype(next(t for t in COUNT_TYPES if counts.max() <= np.iinfo(t).max)).tobytes()


def _counts(held: bytes) -> np.ndarray:
    """A stripe's counts as ``_narrow`` left them."""
    return np.frombuffer(held, {np.dtype(t).itemsize: t for t in COUNT_TYPES}[len(held) >> STRIPE_BITS])


def _histogram(docs: DataFrame, width: int) -> dict[int, bytes]:
    """How many documents' sets hold a shingle of each cell: stripes of cells, each in its narrowest type."""
    stripes = 1 << (CELL_BITS - STRIPE_BITS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, total = Shingler(width), np.zeros(1 << CELL_BITS, np.uint32)
        for b in small(batches):
            held = [s.of(t) for t in texts_of(b)]
            if held:
                np.add.at(total, (np.concatenate(held) >> np.uint64(64 - CELL_BITS)).astype(np.int64), 1)
        parts = [_narrow(p) for p in total.reshape(stripes, -1)]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(stripes, dtype=np.int32)), pa.array(parts, pa.binary())], names=["stripe", "counts"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(1 << STRIPE_BITS, np.int64)
        for x in pdf["counts"]:
            total += _counts(x)
        return pd.DataFrame({"stripe": pdf["stripe"].iloc[:1], "counts": [_narrow(total)]})

    got = docs.select("text").mapInArrow(count, "stripe int, counts binary").groupBy("stripe").applyInPandas(add, "stripe int, counts binary").collect()
    return {r["stripe"]: r["counts"] for r in got}


def _ranks(docs: DataFrame, width: int) -> np.ndarray:
    """For each cell the place of its count among all counts that occur: places fit a narrower type than counts.

    The driver takes one stripe after another, so it never holds all counts in full width nor sorts them."""
    held, cells = _histogram(docs, width), 1 << STRIPE_BITS
    values = np.zeros(0, np.int64)
    for x in held.values():
        values = np.union1d(values, _counts(x).astype(np.int64))
    ranks = np.zeros(1 << CELL_BITS, np.uint16 if len(values) <= 1 << 16 else np.uint32)
    for stripe in list(held):
        ranks[stripe * cells : (stripe + 1) * cells] = np.searchsorted(values, _counts(held.pop(stripe)).astype(np.int64))
    return ranks


def mark_of(h: np.ndarray) -> bytes:
    """For each bit whether an odd number of the set's shingles fall on it: as many bits as two marks differ in, so many
    shingles at least are in one of the sets only."""
    bits = max(LEAST_MARK, 1 << (len(h) - 1).bit_length())
    odd = np.bincount((h & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def mark_matrix(marks: list[bytes], size: int) -> np.ndarray:
    """Marks of ``size`` bytes or more as rows of words; of longer ones the halves are laid on each other."""
    out = np.empty((len(marks), size), np.uint8)
    for i, m in enumerate(marks):
        row = np.frombuffer(m, np.uint8)
        out[i] = row if len(row) == size else np.bitwise_xor.reduce(row.reshape(-1, size))
    return out.view(np.uint64)


def least_shared(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Shingles that sets of n and m must share to be as alike as ``percent``."""
    return -(-percent * (n + m) // (100 + percent))


def marks_fit(n: np.ndarray, marks: list[bytes], p: np.ndarray, q: np.ndarray, percent: int) -> np.ndarray:
    """Whether the marks of the rows p and q leave it open that their sets are as alike as ``percent``."""
    size = np.array([len(x) for x in marks], np.int64)
    least, most = np.minimum(size[p], size[q]), n[p] + n[q] - 2 * least_shared(n[p], n[q], percent)
    fit = np.zeros(len(p), bool)
    for z in np.unique(least):
        of = np.flatnonzero(least == z)
        step = max(1, MARK_BYTES // int(z))
        for i in range(0, len(of), step):
            at = of[i : i + step]
            rows, place = np.unique(np.concatenate([p[at], q[at]]), return_inverse=True)
            m = mark_matrix([marks[r] for r in rows], int(z))
            fit[at] = np.bitwise_count(m[place[: len(at)]] ^ m[place[len(at) :]]).sum(1, dtype=np.int64) <= most[at]
    return fit


def _prefixes(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, n (size of the set), set_key (of the whole set, 16 bytes), group (of size and prefix), prefix and mark.

    Sets so small that none but equal ones can be as alike have neither prefix nor mark."""
    shared = docs.sparkSession.sparkContext.broadcast(_ranks(docs, width))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, rank = Shingler(width), shared.value
        for b in small(batches):
            n, key, group, prefix, mark = [], [], [], [], []
            for t in texts_of(b):
                h = s.of(t)
                n.append(len(h))
                whole = xxhash.xxh3_128_digest(h.tobytes()) if len(h) else None
                key.append(whole)
                if 100 * len(h) < percent * (len(h) + 1):
                    group.append(whole and int.from_bytes(whole[:8], "little", signed=True)), prefix.append(None), mark.append(None)
                    continue
                p = prefix_length(len(h), percent)
                r = rank[(h >> np.uint64(64 - CELL_BITS)).astype(np.int64)]
                first = h[np.lexsort((h, r))[:p]].astype(np.int64)
                group.append(int.from_bytes(xxhash.xxh3_64_digest(len(h).to_bytes(8, "little") + first.tobytes()), "little", signed=True))
                prefix.append(first)
                mark.append(mark_of(h))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int32()), pa.array(key, pa.binary()), pa.array(group, pa.int64()), pa.array(prefix, pa.list_(pa.int64())), pa.array(mark, pa.binary())],
                names=["doc_id", "n", "set_key", "group", "prefix", "mark"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(find, "doc_id long, n int, set_key binary, group long, prefix array<long>, mark binary")


def _size_class(percent: int):
    """Classes of the size n such that sets that may link are of one class or of neighbouring ones."""
    return F.floor(F.log("n") / (math.log(100 / percent) * 1.0001 if percent < 100 else 1.0)).cast("int")


def _sizes_meet():
    """Whether of a list (listed, sizes: the bits of its groups' classes modulo 60) any two groups may link by size."""
    turned = (F.shiftleft("sizes", 1).bitwiseOR(F.shiftrightunsigned("sizes", 59))).bitwiseAND(F.lit((1 << 60) - 1))
    return (F.bit_count("sizes") < F.col("listed")) | (F.col("sizes").bitwiseAND(turned) != 0)


def _may_link(n: str, m: str, i: str, j: str, percent: int):
    """Sizes n, m and the places i, j of the first common element still allow the likeness."""
    small, large = F.least(n, m), F.greatest(n, m)
    need = F.ceil(F.lit(percent) * (F.col(n) + F.col(m)) / (100 + percent))
    return (small * 100 >= large * percent) & (F.least(F.col(n) - F.col(i), F.col(m) - F.col(j)) >= need)


def _open_pairs(pairs: DataFrame, marks: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) that their marks leave open."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches, 4096):
            n = np.concatenate([b.column(i).to_numpy() for i in (2, 4)]).astype(np.int64)
            k = np.arange(b.num_rows)
            fit = marks_fit(n, b.column(3).to_pylist() + b.column(5).to_pylist(), k, k + len(k), percent)
            yield b.select(["a", "b"]).filter(pa.array(fit))

    one, two = (marks.select(F.col("id").alias(i), F.col("n").alias(f"n{i}"), F.col("mark").alias(f"m{i}")) for i in "ab")
    return pairs.join(one, "a").join(two, "b").select("a", "b", "na", "ma", "nb", "mb").mapInArrow(look, "a long, b long")


def _verified(pairs: DataFrame, docs: DataFrame, tables: Tables, width: int, percent: int) -> DataFrame:
    """Those of the pairs (a, b; a table) whose sets are as alike as ``percent``, exactly.

    The sets are made of the texts again and meet once: those of all b of an a, or of up to about BLOCK of them, come to the set of a.
    """
    per = pairs.groupBy("a").agg(F.count("*").alias("rows")).withColumn("parts", F.ceil(F.col("rows") / BLOCK).cast("int"))
    heads = per.select(F.col("a").alias("id"), "a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("member"))
    rest = salted_join(pairs, per, "a", "rows", pairs.count(), F.xxhash64("b")).select(F.col("b").alias("id"), "a", F.pmod(F.xxhash64("b"), "parts").cast("int").alias("part"), F.lit(1).alias("member"))
    wanted = tables.put(heads.unionAll(rest))
    few = wanted.count() <= BROADCAST_ROWS

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Shingler(width)
        for b in small(batches):
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array([s.of(t).tobytes() for t in texts_of(b)], pa.binary())], names=["id", "a", "part", "member", "shingles"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, heads = None, []
        for b in small(batches):
            out = []
            for i, a, part, member, shingles in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (a, part) != at:
                    at, heads = (a, part), []
                own = np.frombuffer(shingles, np.uint64)
                if not member:
                    heads.append(own)
                    continue
                for h in heads:
                    both = int((h[np.minimum(np.searchsorted(h, own), len(h) - 1)] == own).sum())
                    if 100 * both >= percent * (len(h) + len(own) - both):
                        out.append((min(a, i), max(a, i)))
                        break
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["a", "b"])

    texts = docs.where("text is not null").select(F.col("doc_id").cast("long").alias("id"), "text").join(F.broadcast(wanted) if few else wanted, "id").select("id", "a", "part", "member", "text")
    made = texts.mapInArrow(sets, "id long, a long, part int, member int, shingles binary").where("length(shingles) > 0")
    return tables.put(made.repartition("a", "part").sortWithinPartitions("a", "part", "member").mapInArrow(meet, "a long, b long").distinct(), wanted)


def _late_pairs(rest: DataFrame, tables: Tables, percent: int) -> DataFrame:
    """Pairs (a < b) of rows of one list that may link and have different labels, not both the list's main one.

    ``rest``: list, group, id, n, i, label, main, mark. Lists of more than BLOCK rows are cut into classes of sizes that can't link
    beyond the next class, and those into blocks; no pair is a row before it has passed every test.
    """
    rest = rest.withColumn("size", _size_class(percent))
    per = rest.groupBy("list", "size").agg(F.count("*").alias("rows"))
    # a list has some hundred classes at most
    blocks_of = F.map_from_entries(F.collect_list(F.struct("size", F.ceil(F.col("rows") / BLOCK).cast("int"))))
    per = tables.put(per.groupBy("list").agg(F.sum("rows").alias("rows"), blocks_of.alias("blocks")))
    large = F.col("rows") > BLOCK
    lists = salted_join(rest, per, "list", "rows", rest.count(), F.xxhash64("id"))
    size = F.col("size")
    blocks = lambda k: F.coalesce(F.element_at("blocks", k), F.lit(0))
    upto = lambda n: F.filter(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda x: x < n)
    cell = lambda low, lo, hi, side: F.struct(low.alias("low"), lo.alias("lo"), hi.alias("hi"), side.cast("int").alias("side"))
    lists = lists.withColumn("own", F.pmod(F.xxhash64("id"), blocks(size)).cast("int"))
    o = F.col("own")
    within = F.transform(upto(blocks(size)), lambda x: cell(size * 2, F.least(o, x), F.greatest(o, x), F.when(o == x, 0).when(o < x, 1).otherwise(2)))
    above = F.transform(upto(blocks(size + 1)), lambda x: cell(size * 2 + 1, o, x, F.lit(1)))
    below = F.transform(upto(blocks(size - 1)), lambda x: cell(size * 2 - 1, x, o, F.lit(2)))
    cells = F.when(large, F.concat(within, above, below)).otherwise(F.array(cell(F.lit(-2), F.lit(0), F.lit(0), F.lit(0))))
    rows = lists.withColumn("c", F.explode(cells)).select(F.xxhash64("list", "c.low", "c.lo", "c.hi").alias("run"), F.col("c.side").alias("side"), "group", "id", "n", "i", "label", "main", "mark")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_runs(batches, "run"):
            c = {k: t.column(k).to_numpy().astype(np.int64) for k in ("run", "side", "group", "id", "n", "i", "label", "main")}
            marks = t.column("mark").to_pylist()
            for p, q in pairs_of(c["side"], c["run"]):
                n, m = c["n"][p], c["n"][q]
                ok = (c["label"][p] != c["label"][q]) & ((c["label"][p] != c["main"][p]) | (c["label"][q] != c["main"][q]))
                ok &= (c["group"][p] != c["group"][q]) & (np.minimum(n, m) * 100 >= np.maximum(n, m) * percent)
                ok &= np.minimum(n - c["i"][p], m - c["i"][q]) >= least_shared(n, m, percent)
                p, q = p[ok], q[ok]
                fit = marks_fit(c["n"], marks, p, q, percent)
                a, b = c["id"][p[fit]], c["id"][q[fit]]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    return rows.repartition("run").sortWithinPartitions("run", "side").mapInArrow(compare, "a long, b long").where("a <> b").distinct()


def jaccard_components(docs: DataFrame, *, width: int = 3, percent: int = 90, tables: Tables | None = None) -> DataFrame:
    """Components of the documents whose sets of word shingles have a Jaccard likeness of ``percent`` / 100 or more.

    ``docs``: doc_id, text. Words are runs without ASCII white space, A-Z lower-cased; a set holds the distinct runs of ``width``
    words, or all words as one run if there are fewer. Returns doc_id, n_shingles, component_id (the smallest doc_id that
    links reach), one row per input row. Null and empty texts have empty sets and link with nothing; neither do null ids;
    repeated rows link as copies do; rows that share an id are one node; further columns are ignored; an empty table gives none.
    The result reads tables that ``tables`` holds; a caller that has written it may clear them.

    Documents of equal sets collapse first, then those of equal prefix and size into groups. Groups that share a prefix
    shingle, fit by size and by its places are candidates; groups are expanded and members verified on whole sets. Of
    candidates, those with the most central document of each shingle's list come first; once components are known, the
    remaining pairs are only those of different components, so a group of near copies isn't compared pair by pair. No
    candidate that could join two components is left out: the result is exact (sets are of 64-bit hashes). Lists are compared in
    blocks by sizes, places and marks of the sets, so a shingle of many unrelated documents makes no table of pairs.
    """
    tables = tables or Tables(docs.sparkSession)
    found = tables.put(_prefixes(docs, width, percent))
    usable = found.where("doc_id is not null and n > 0")
    # one document of each set, which its copies follow; a group is known by its smallest document
    once = tables.put(usable.groupBy("set_key").agg(F.min("doc_id").alias("id"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("group").alias("group"), F.first("mark").alias("mark")))
    groups = usable.where("prefix is not null").groupBy("group").agg(F.min("doc_id").alias("head"), F.first("n").alias("n"), F.first("prefix").alias("prefix"))
    groups = tables.put(groups)
    single = once.where("mark is not null")
    sizes = single.groupBy("group").agg(F.count("*").alias("members"), F.min("id").alias("head"))
    rows = once.count()
    members = tables.put(salted_join(single.select("group", "id", "n"), sizes, "group", "members", rows, F.xxhash64("id")))
    marks = single.select("id", "n", "mark")
    places = groups.select("head", "n", F.posexplode("prefix").alias("i", "shingle"))
    # lists stay in which two groups fit by size and, if there are but two, by place: chance makes most lists, but few of these
    bit = F.expr("shiftleft(1L, pmod(_class, 60))")
    often = places.withColumn("_class", _size_class(percent)).groupBy("shingle").agg(F.count("*").alias("listed"), F.bit_or(bit).alias("sizes"), F.min(F.col("n") - F.col("i")).alias("_rest"), F.sum("n").alias("_n"))
    pair = (F.col("listed") > 2) | (F.col("_rest") >= F.ceil(F.lit(percent) * F.col("_n") / (100 + percent)))
    often = often.where((F.col("listed") > 1) & pair & _sizes_meet())
    often = tables.put(often.select("shingle", "listed"))
    total = groups.agg(F.coalesce(F.sum(F.size("prefix")), F.lit(0))).first()[0]
    lists = tables.put(salted_join(places, often, "shingle", "listed", total, F.xxhash64("head")).where("listed is not null"), groups, often)
    central = lists.groupBy("head").agg(F.sum("listed").alias("central"))
    leaders = lists.join(central, "head").groupBy("shingle").agg(F.max(F.struct("central", "head", "n", "i")).alias("l"), F.count("*").alias("listed"))
    leaders = tables.put(leaders.select("shingle", "listed", F.col("l.head").alias("leader"), F.col("l.n").alias("m"), F.col("l.i").alias("j")))
    near = salted_join(lists.drop("listed"), leaders, "shingle", "listed", lists.count(), F.xxhash64("head")).where(_may_link("n", "m", "i", "j", percent)).select("leader", "head").distinct()
    stars = near.join(members, "head").select(F.col("leader").alias("a"), F.col("id").alias("b")).unionAll(members.select(F.col("head").alias("a"), F.col("id").alias("b"))).where("a <> b").distinct()
    checked = tables.put(_open_pairs(stars, marks, percent), leaders)
    edges = _verified(checked, docs, tables, width, percent)
    labels = tables.put(connected_components(edges), edges)
    # lists that still hold several components; the pairs of a list's most frequent component needn't be looked at
    own = members.where("members > 1").select(F.xxhash64("group", F.lit(1)).alias("list"), F.col("id").alias("group"), "id", "n", F.lit(0).alias("i"))
    placed = lists.select("shingle", "head", "i").join(members, "head").select(F.col("shingle").alias("list"), F.col("head").alias("group"), "id", "n", "i").unionAll(own)
    placed = tables.put(placed.join(labels, "id", "left").select("list", "group", "id", "n", "i", F.coalesce("component", "id").alias("label")), lists, members)
    per_label = placed.groupBy("list", "label").agg(F.count("*").alias("rows"))
    main = per_label.groupBy("list").agg(F.max(F.struct("rows", "label")).alias("x"), F.count("*").alias("labels")).where("labels > 1").select("list", F.col("x.label").alias("main"))
    rest = tables.put(placed.join(main, "list").join(marks.drop("n"), "id"), placed)
    more = _late_pairs(rest, tables, percent).join(checked.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti")
    late = _verified(tables.put(more, rest), docs, tables, width, percent)
    if not late.isEmpty():
        # only the components that these links join take part in another search
        of = lambda c: labels.select(F.col("id").alias(c), F.col("component").alias(f"_{c}"))
        between = late.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b"))
        joined = tables.put(connected_components(between)).withColumnRenamed("component", "root")
        known_ids = labels.join(joined.withColumnRenamed("id", "component"), "component", "left").select("id", F.coalesce("root", "component").alias("component"))
        labels = known_ids.unionAll(joined.join(labels, "id", "left_anti").select("id", F.col("root").alias("component")))
    known = tables.put(once.join(labels, "id", "left").select("set_key", "copies", F.coalesce("component", "id").alias("component_id")), once)
    total = known.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    key = F.when(F.col("doc_id").isNotNull() & F.col("set_key").isNotNull(), F.col("set_key")).otherwise(F.concat(F.lit("none:"), F.monotonically_increasing_id().cast("string")).cast("binary"))
    out = salted_join(found.select("doc_id", F.col("n").cast("long").alias("n_shingles"), key.alias("set_key")), known, "set_key", "copies", total, F.xxhash64("doc_id"))
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def op9_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents``: sets of three words, likeness 0.9."""
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: The same by all pairs that share a shingle.
ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, row_number() OVER () AS k, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), g AS (
  SELECT k, doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM w WHERE len(w) > 0
), s AS (SELECT DISTINCT k, doc_id, array_to_string(w[i:i + 2], ' ') AS shingle FROM g
), n AS (SELECT k, count(*) AS n FROM s GROUP BY 1
), p AS (
  SELECT a.k AS ka, b.k AS kb, a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.shingle = b.shingle AND a.k < b.k WHERE a.doc_id IS NOT NULL AND b.doc_id IS NOT NULL GROUP BY ALL
), l AS (
  SELECT a, b FROM p JOIN n x ON x.k = ka JOIN n y ON y.k = kb WHERE 100 * shared >= 90 * (x.n + y.n - shared)
), e AS (SELECT a, b FROM l UNION SELECT b, a FROM l
), r AS (SELECT DISTINCT a AS doc_id, a AS other FROM e UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.other
), c AS (SELECT doc_id, min(other) AS c FROM r GROUP BY 1)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, CASE WHEN n.n > 0 THEN coalesce(c.c, w.doc_id) ELSE w.doc_id END AS component_id FROM w LEFT JOIN n USING (k) LEFT JOIN c ON c.doc_id = w.doc_id
"""
