"""Packing by power-of-two decomposition: every sequence is one piece of one document."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirekit.llm.common import small, texts_of

#: Runs without white space, or of it, from here on go to the slower library, whose time doesn't grow with their square.
LONG_RUN = re.compile(r"\S{1000}|\s{1000}")
#: Bytes of ids that are sent back at a time.
SENT = 4 << 20


def ranks(vocab: dict[str, int]) -> dict[bytes, int]:
    """The vocabulary of a byte-level BPE file by bytes: printable Latin-1 stands for itself, the other bytes for 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in own)}
    return {bytes(letters[c] for c in token): i for token, i in vocab.items() if all(c in letters for c in token)}


class Encoder:
    """Ids of whole texts, equal to those of the tokenizers library on the file at ``path``.

    tiktoken takes a fifth of that library's time for the same vocabulary, which it gets from the same file; texts
    with very long runs, and texts that hold the string of an added token, go to the library itself.
    """

    def __init__(self, path: str, pattern: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.slow = Tokenizer.from_file(path)
        special = {t.content for t in self.slow.get_added_tokens_decoder().values()}
        self.added = re.compile("|".join(map(re.escape, sorted(special))) or "(?!)")
        self.fast = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks({k: v for k, v in self.slow.get_vocab(False).items() if k not in special}), special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        if LONG_RUN.search(text) or self.added.search(text):
            return np.asarray(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.asarray(self.fast.encode_to_numpy(text, disallowed_special=()), np.uint32)


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    """One per Python worker."""
    return Encoder(path, pattern)


def lengths(n: int, most: int) -> list[int]:
    """``n`` as pieces of ``most`` and then the binary digits of the rest, largest first."""
    rest = n % most
    return [most] * (n // most) + [1 << b for b in range(most.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(docs: DataFrame, tokenizer_path: str, pattern: str, *, most: int = 2048, end_id: int = 1) -> DataFrame:
    """Documents as pieces whose lengths are powers of two; each piece is a sequence of the bucket of its length.

    ``docs``: doc_id, text. ``most`` is a power of two. Returns per piece: doc_id, start, length, ids (binary,
    little-endian unsigned 32-bit), doc_tokens, sequence_id, offset (0: a sequence is one piece, so none crosses documents),
    bucket (its length). No token is padding. Ids are those of the byte-level BPE file at ``tokenizer_path``, which splits
    texts by ``pattern`` first, and ``end_id`` after each document. Null and empty texts are one piece, of the end id alone; repeated rows are packed each; long texts take
    memory in proportion; further columns are ignored; an empty table gives no pieces. Nothing is shuffled: sequence_id
    tells the place in the input's partitions, the same in every run over the same files and split sizes.
    """
    if most & (most - 1):
        raise ValueError("most must be a power of two")
    end = np.asarray([end_id], "<u4").tobytes()
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64())])

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path, pattern)
        rows, held = [], 0
        for b in small(batches):
            ids = b.column(0).to_pylist()
            for doc_id, text in zip(ids, texts_of(b), strict=True):
                got = enc.encode(text).astype("<u4").tobytes() + end
                n, at = len(got) // 4, 0
                for size in lengths(n, most):
                    rows.append((doc_id, at, size, got[4 * at : 4 * (at + size)], n))
                    at += size
                held += len(got)
                if held >= SENT:
                    yield batch(rows)
                    rows, held = [], 0
        if rows:
            yield batch(rows)

    pieces = docs.select("doc_id", "text").mapInArrow(cut, "doc_id long, start long, length long, ids binary, doc_tokens long")
    return pieces.withColumn("sequence_id", F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long")).withColumn("bucket", F.col("length"))


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Sequences as Parquet, one folder for each bucket of equal length."""
    pieces.write.partitionBy("bucket").parquet(path)


def default_tokenizer() -> tuple[str, str]:
    """Path and pattern of the tokenizer that the production queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN


def op3_power_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents``, 2048 tokens at most a sequence."""
    p = pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), *default_tokenizer())
    return p.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket")
