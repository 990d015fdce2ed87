"""Packing by power-of-two decomposition.

Each document becomes pieces whose lengths are powers of two (whole sequences first, then the binary
digits of the rest). A piece is a training sequence of its own, and pieces of one length form a bucket,
so no sequence crosses documents, none is padded, and a batch drawn from one bucket is rectangular.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.llm.common import fresh, lean, text_groups
from claimloom.sources.scratch import scratch_path

MAX_LENGTH = 1024
END_ID = 0
VOCABULARY = "byte_bpe_50k"
_GROUP_CHARS = 2_000_000


def piece_lengths(tokens: int, max_length: int = MAX_LENGTH) -> list[int]:
    """Whole sequences first, then the binary digits of what is left, largest first."""
    whole, rest = divmod(tokens, max_length)
    return [max_length] * whole + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


class Encoder:
    """The ids that ``tokenizers`` gives for a public byte-level vocabulary, special tokens not added.

    ``tiktoken`` gives the same ids several times faster and does the work, but for texts that hold the string of a
    special token, and for some runs of a million like characters on which its pattern matcher gives up.
    """

    def __init__(self, vocabulary: str = VOCABULARY):
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, f)}
        self.fast = tiktoken.Encoding(
            vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.path = public_tokenizers.path(f"{vocabulary}.json")
        with open(self.path, encoding="utf-8") as f:
            self.special = [token["content"] for token in json.load(f).get("added_tokens", [])]
        self.tokenizer = None

    def slow(self, text: str) -> list[int]:
        if self.tokenizer is None:
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_file(self.path)
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def __call__(self, text: str) -> list[int]:
        if any(token in text for token in self.special):
            return self.slow(text)
        try:
            return self.fast.encode_ordinary(text)
        except BaseException as error:  # its failures in native code do not derive from Exception
            if isinstance(error, (KeyboardInterrupt, SystemExit, MemoryError)):
                raise
            return self.slow(text)


def pack(
    docs: DataFrame,
    *,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    max_length: int = MAX_LENGTH,
    vocabulary: str = VOCABULARY,
    end_id: int = END_ID,
) -> DataFrame:
    """One row per piece: the ``keep`` columns, then ``start``, ``length``, ``ids`` (little-endian unsigned
    32-bit), ``doc_tokens``, ``sequence_id`` and ``offset``.

    A null or empty text is the end id alone: one piece of length 1. Repeated rows are packed once each.
    Null ids are kept as they are. An empty table gives no rows. Columns not in ``keep`` are not read, so
    their names cannot clash. One narrow pass without a shuffle: tokens go from the task that made
    them straight to the sink, and a lost task makes the same pieces again. ``sequence_id`` is unique
    for the result; its numbering depends on how the input is split.
    """
    if max_length & (max_length - 1) or max_length < 1:
        raise ValueError("max_length must be a power of two")
    read = fresh(docs, "pack_text")
    source = docs.select(*keep, F.col(text).alias(read))
    kept = docs.select(*keep)
    schema = kept.schema.add("start", "long").add("length", "long").add("ids", "binary").add("doc_tokens", "long")

    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(vocabulary)
        for part, texts in text_groups(batches, read, _GROUP_CHARS):
            rows: list[int] = []
            starts: list[int] = []
            lengths: list[int] = []
            totals: list[int] = []
            raw: list[bytes] = []
            for row, one in enumerate(texts):
                ids = encode(one)
                ids.append(end_id)
                data = np.array(ids, dtype="<u4").tobytes()
                start = 0
                for length in piece_lengths(len(ids), max_length):
                    rows.append(row)
                    starts.append(start)
                    lengths.append(length)
                    totals.append(len(ids))
                    raw.append(data[4 * start : 4 * (start + length)])
                    start += length
            index = pa.array(rows, pa.int64())
            columns = [part.column(i).take(index) for i in range(len(keep))]
            columns += [pa.array(x, pa.int64()) for x in (starts, lengths)]
            columns += [pa.array(raw, pa.binary()), pa.array(totals, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "start", "length", "ids", "doc_tokens"])

    return (
        source.mapInArrow(lean(pieces), schema)
        .withColumn("sequence_id", F.monotonically_increasing_id())
        .withColumn("offset", F.lit(0).cast("long"))
    )


def write_buckets(packed: DataFrame, path: str) -> None:
    """Write the pieces of ``pack`` with a folder ``bucket=<length>`` for each length.

    A reader of one folder gets sequences of one length only. Tasks write their own files, without a shuffle. Pieces
    that repeat are written each; an empty table writes no folder. A column named ``bucket`` is replaced.
    """
    packed.withColumn("bucket", F.col("length")).write.partitionBy("bucket").parquet(path)


def read_buckets(spark: SparkSession, path: str, schema: T.StructType, lengths: Sequence[int] | None = None) -> DataFrame:
    """The pieces in ``path`` (of some lengths), with the columns of ``schema`` and ``bucket``, the length as a long."""
    whole = T.StructType([f for f in schema.fields if f.name != "bucket"]).add("bucket", "long")
    rows = spark.read.schema(whole).parquet(path)
    return rows if lengths is None else rows.where(F.col("bucket").isin(list(lengths)))


def pack_in_buckets(docs: DataFrame, *, keep: tuple[str, ...] = ("doc_id",), **options) -> DataFrame:
    """The rows of ``pack`` (same arguments), read back from buckets of equal lengths in the shared folder."""
    packed = pack(docs, keep=keep, **options)
    path = scratch_path(docs.sparkSession, "buckets")
    write_buckets(packed, path)
    return read_buckets(docs.sparkSession, path, packed.schema)
