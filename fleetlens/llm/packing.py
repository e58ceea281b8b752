"""Packing without padding: documents cut into pieces of power-of-two length.

A document of n tokens becomes n // size full pieces and the binary digits of
the rest, longest first (612 = 512 + 64 + 32 + 4). Every piece is a sequence of
its own: no sequence crosses documents, none is padded, and sequences of one
length form a bucket from which equal batches are drawn.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.shared import ByteTokens, encoder, slices

SEQUENCE = 1024
END_ID = 0

_SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
    ("doc_tokens", pa.int64()), ("ids", pa.binary()),
])


def binary_lengths(tokens: int, size: int) -> list[int]:
    """Lengths of a document's pieces; their sum is ``tokens``."""
    rest = tokens % size
    digits = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    return [size] * (tokens // size) + digits


def pack(docs: DataFrame, vocabulary: str, size: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """One row per sequence: doc_id, start, length, doc_tokens, ids, sequence_id, offset, bucket.

    ``vocabulary`` is the path of a byte-level ``tokenizers`` file. ``docs``
    needs doc_id and text; other columns are ignored, whatever their names. ``ids`` holds little-endian unsigned 32-bit token ids. A null or
    empty text is the end token alone: one piece of length 1. Repeated rows are
    packed each. An empty table gives no rows. ``size`` must be a power of two.

    Rows are independent, so there is no shuffle. ``sequence_id`` numbers rows
    by partition and position in it: unique, not dense, and the same again
    when a lost task is run anew.
    """
    if size < 1 or size & (size - 1):
        raise ValueError("the sequence length must be a power of two")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(ByteTokens, vocabulary).encode, np.array([end_id], dtype="<u4").tobytes()
        for batch in slices(batches):
            out = [[], [], [], [], []]
            encoded = encode([t or "" for t in batch.column("text").to_pylist()])
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encoded):
                ids += end
                tokens, start = len(ids) // 4, 0
                for length in binary_lengths(tokens, size):
                    for column, value in zip(out, (doc, start, length, tokens, ids[4 * start:4 * (start + length)])):
                        column.append(value)
                    start += length
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, _SCHEMA)], schema=_SCHEMA)

    pieces = docs.select("doc_id", "text").mapInArrow(
        cut, "doc_id long, start long, length long, doc_tokens long, ids binary")
    return pieces.withColumns({
        "sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long"),
        "bucket": F.col("length").cast("int"),
    })


def write_buckets(sequences: DataFrame, path: str) -> None:
    """Store sequences in one folder per length, for readers that draw equal batches."""
    sequences.write.partitionBy("bucket").parquet(path)
