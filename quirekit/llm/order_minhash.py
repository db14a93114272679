"""Order MinHash document fingerprints, in column expressions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Low bits of an element hold its place in the text, the rest its hash.
PLACE_BITS = 26
LOW = (1 << PLACE_BITS) - 1
HIGH = -1 - LOW
#: The top bits of an element's hash name one of the 2^BIN_BITS places of the hash circle where signature entries start.
BIN_BITS = 6
ENTRIES = 1 << BIN_BITS
ENTRY_MASK = (1 << 24) - 1
TURNED = 37


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _at(a: Column, i: Column) -> Column:
    return F.coalesce(F.get(a, i), F.lit(0).cast("long"))


def _hash_part(x: Column) -> Column:
    return F.shiftrightunsigned(x, PLACE_BITS)


def _same(a: Column, i: Column) -> Column:
    return (i > 0) & (_hash_part(_at(a, i)) == _hash_part(_at(a, i - 1)))


def _numbered(s: Column) -> Column:
    """Sorted elements with each repetition's hash replaced by that of (k-mer, occurrence number)."""

    def renumber(again: Column) -> Column:
        def groups(starts: Column) -> Column:
            def one(j0: Column, r: Column) -> Column:
                last = F.coalesce(F.get(starts, r + 1), F.size(again)) - 1

                def key(j: Column) -> Column:
                    x = _at(s, F.get(again, j))
                    return F.xxhash64(_hash_part(x), j - j0 + 1).bitwiseAND(F.lit(HIGH)).bitwiseOR(x.bitwiseAND(F.lit(LOW)))

                return F.transform(F.sequence(j0, last), key)

            return F.flatten(F.transform(starts, one))

        starts = F.filter(F.sequence(F.lit(0), F.size(again) - 1), lambda j: (j == 0) | (F.get(again, j) != F.get(again, j - 1) + 1))
        firsts = F.filter(s, lambda x, i: (i == 0) | (_hash_part(x) != _hash_part(_at(s, i - 1))))
        return F.when(F.size(again) == 0, s).otherwise(F.sort_array(F.concat(firsts, let(starts, groups))))

    return let(F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: _same(s, i)), renumber)


def _signature(a: Column, tuple_size: int) -> Column:
    """For each start on the hash circle the next ``tuple_size`` elements, in text order, hashed."""

    def bin_(x: Column) -> Column:
        return (F.shiftright(x, 64 - BIN_BITS) + ENTRIES // 2).cast("int")

    def entry(i: Column) -> Column:
        def turned(r: Column) -> Column:
            x = _at(a, (i + r) % F.size(a))
            return F.shiftleft(x.bitwiseAND(F.lit(LOW)), TURNED).bitwiseOR(F.shiftrightunsigned(x, 64 - TURNED))

        chosen = F.sort_array(F.transform(F.sequence(F.lit(0), F.least(F.lit(tuple_size), F.size(a)) - 1), turned))
        return F.xxhash64(F.transform(chosen, lambda y: y.bitwiseAND(F.lit((1 << TURNED) - 1)))).bitwiseAND(F.lit(ENTRY_MASK)).cast("int")

    new = F.filter(F.sequence(F.lit(0), F.size(a) - 1), lambda i: (i == 0) | (bin_(_at(a, i)) != bin_(_at(a, i - 1))))
    starts = F.transform(new, lambda i: F.array_repeat(i, bin_(_at(a, i)) - F.when(i == 0, F.lit(-1)).otherwise(bin_(_at(a, i - 1)))))
    rest = F.array_repeat(F.lit(0), ENTRIES - 1 - bin_(_at(a, F.size(a) - 1)))
    return F.transform(F.concat(F.flatten(starts), rest), entry)


def order_minhash(text: Column, k: int = 3, tuple_size: int = 2) -> Column:
    """Order MinHash of a text: ENTRIES integers, or null for a text without words (and a null text).

    The k-mers are runs of ``k`` words (the whole text if it has fewer), each numbered by its occurrence. One random
    64-bit hash places the numbered k-mers on a circle; the permutation of entry j reads the circle from j/ENTRIES
    on. Its ``tuple_size`` smallest k-mers (all, if there are fewer) are put back into text order and hashed as a
    tuple, so an entry changes when k-mers appear, vanish or swap. The share of equal entries estimates the order
    Jaccard likeness. Sorting the elements once serves all permutations. Places are kept modulo 2^26 words.
    """
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def of(w: Column) -> Column:
        grams = F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - k + 1, F.lit(1))), lambda i: F.xxhash64(F.slice(w, i, F.lit(k))).bitwiseAND(F.lit(HIGH)).bitwiseOR(i.cast("long").bitwiseAND(F.lit(LOW))))
        return F.when(F.size(w) > 0, let(let(F.sort_array(grams), _numbered), lambda a: _signature(a, tuple_size)))

    return let(words, of)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal entries, 0 to 1; two texts without words are alike, one without words is unlike any other."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x)) / F.lit(float(ENTRIES))
    return F.when(a.isNull() & b.isNull(), 1.0).when(a.isNull() | b.isNull(), 0.0).otherwise(same)


def as_string(entries: Column) -> Column:
    """Six hexadecimal digits an entry; the empty string without words."""
    return F.coalesce(F.array_join(F.transform(entries, lambda x: F.lpad(F.hex(x), 6, "0")), ""), F.lit(""))


def with_next(df: DataFrame, order: str, tie: str, columns: list[str]) -> DataFrame:
    """Adds ``next_<c>``: columns of the row after each in ascending ``order`` (null first, then ``tie``); the last one gets the first.

    The rows are cut into ranges of near-equal counts at values of ``order`` itself; the rows at a cut also go, as
    a sentinel, to the range before it (those of the first range to the last). So each range finds its successors
    alone: the rows are shuffled once and no window spans the table.
    """
    spark = df.sparkSession
    key = F.coalesce(F.col(order).cast("long"), F.lit(-(1 << 63)))
    wanted = min(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), 10_000)
    got = df.select(key.alias("k")).agg(F.min("k"), F.percentile_approx("k", [i / wanted for i in range(1, wanted)], 10 * wanted) if wanted > 1 else F.array()).first()
    cuts = sorted({got[0], *(got[1] or [])} - {None}) or [0]
    step = max(1, int(len(cuts) ** 0.5))
    literal = lambda xs: F.split(F.lit(",".join(map(str, xs))), ",").cast("array<bigint>")
    coarse, fine = literal(cuts[::step]), literal(cuts)
    block = F.size(F.filter(coarse, lambda c: c <= F.col("_k"))) - 1
    place = block * step + F.size(F.filter(F.slice(fine, block * step + 1, F.lit(step)), lambda c: c <= F.col("_k"))) - 1
    rows = df.withColumn("_k", key).withColumn("_range", place)
    at_cut = F.array_contains(F.slice(fine, F.col("_range") + 1, F.lit(1)), F.col("_k"))
    before = F.pmod(F.col("_range") - 1, F.lit(len(cuts)))
    own = F.struct(F.col("_range").alias("r"), F.lit(False).alias("sentinel"))
    rows = rows.withColumn("_to", F.explode(F.when(at_cut, F.array(own, F.struct(before.alias("r"), F.lit(True).alias("sentinel")))).otherwise(F.array(own))))
    rows = rows.withColumn("_range", F.col("_to.r")).withColumn("_sentinel", F.col("_to.sentinel")).drop("_to")
    w = Window.partitionBy("_range").orderBy("_sentinel", "_k", tie)
    rows = rows.withColumns({f"next_{c}": F.lead(c).over(w) for c in columns})
    return rows.where(~F.col("_sentinel")).drop("_k", "_range", "_sentinel")


def fingerprint_edits(docs: DataFrame, k: int = 3, tuple_size: int = 2) -> DataFrame:
    """Fingerprint of each text, of an edited text, and its likeness to that and to the next document's.

    ``docs``: doc_id, text. The edited text has its last quarter (floor of the code points / 4) replaced by as many first code
    points of the next document in ascending doc_id. Null texts count as empty; null ids come first; rows of one id follow
    each other by text; a single row is its own next one; further columns are ignored; an empty table gives none.
    """
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("print", order_minhash(F.col("text"), k, tuple_size))
    n = F.length("text")
    cut = F.floor(n / 4).cast("int")
    paired = with_next(base, "doc_id", "text", ["text", "print"])
    edited = F.concat(F.substring("text", F.lit(1), n - cut), F.substring("next_text", F.lit(1), cut))
    rows = paired.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "print", "next_print")
    rows = rows.withColumn("edited_print", order_minhash(F.col("edited"), k, tuple_size))
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), as_string(F.col("print")).alias("fingerprint"), as_string(F.col("edited_print")).alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited_print")).alias("near_edited"), likeness(F.col("print"), F.col("next_print")).alias("near_next"),
    )


def op4_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents``."""
    return fingerprint_edits(spark.read.parquet(f"{sf_dir}/documents.parquet"))
