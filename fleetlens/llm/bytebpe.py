"""Byte-level BPE by a shuffle of distinct words.

* Texts are cut into pre-tokens. Documents of about CHUNK_CHARS make a chunk,
  which holds its distinct words once and, for every document, the words'
  numbers by position.
* The words of all chunks are shuffled by ranges of their hashes; where a range
  meets, each of its words is encoded once.
* The ids go back to the chunks, joined by chunk and range, and documents are
  put together by position.

A word travels once a chunk, however often it occurs, and words travel packed:
one row holds those of a chunk in a range. Chunks are written in buckets by
their number: the ids come to them, and the positions never travel.

Decoding joins ids with the table of token bytes, which has the size of the
vocabulary.
"""

from __future__ import annotations

import base64
import uuid
from array import array
from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.shared import encoder, scratch_path, slices

#: Characters of text in a chunk; a longer text ends one by itself.
CHUNK_CHARS = 16 << 20
#: Ranges of word hashes. A task holds the distinct words of one range at a time.
WORD_RANGES = 4096
#: Longer texts are cut into pre-tokens piece by piece, at a blank behind a word.
PIECE_CHARS = 1 << 20

_CHUNKS = pa.schema([("chunk", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())),
                     ("positions", pa.binary()), ("dealt", pa.binary()), ("lengths", pa.binary()), ("letters", pa.binary())])
_ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class PreTokens:
    """Cuts texts by the pattern of a vocabulary."""

    def __init__(self, pattern: str):
        self.find = regex.compile(pattern).findall
        # White space never follows within a match what is not white space,
        # and no match looks back: a text may be cut there.
        self.gap = regex.compile(r"(?<=\S)\s")

    def pieces(self, text: str) -> Iterator[list[str]]:
        start = 0
        while start < len(text):
            gap = self.gap.search(text, start + PIECE_CHARS)
            end = gap.start() if gap else len(text)
            yield self.find(text[start:end])
            start = end


class Numbers(dict):
    """Words numbered as they first appear."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


class WordEncoder:
    """Token ids of one pre-token."""

    def __init__(self, ranks_path: str, pattern: str):
        ranks = read_ranks(ranks_path)
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, word: bytes) -> list[int]:
        # Pre-tokens need no pattern, which long runs of blanks would exhaust.
        return self.encoding._encode_single_piece(word)


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers byte plane by byte plane, as many as the largest needs: they compress better."""
    planes = max(1, (int(numbers.max(initial=0)).bit_length() + 7) // 8)
    return bytes([planes]) + np.ascontiguousarray(numbers, dtype="<u4").view(np.uint8).reshape(-1, 4).T[:planes].tobytes()


def _unpacked(packed: bytes) -> np.ndarray:
    held = np.frombuffer(packed, dtype=np.uint8, offset=1).reshape(packed[0], -1)
    out = np.zeros((held.shape[1], 4), dtype=np.uint8)
    out[:, :packed[0]] = held.T
    return out.view("<u4").ravel()


def _squeezed(data: bytes) -> bytes:
    """Compressed in the worker: a chunk's positions are most of what its row weighs everywhere else."""
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def _unsqueezed(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)


def _ends(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])


def _chunk(chunk: int, doc_ids: list, sizes: list, words: Numbers, positions: array) -> pa.RecordBatch:
    """Words are numbered anew so that those of a range are neighbours."""
    utf8 = [w.encode() for w in words]
    ranges = np.fromiter(map(crc32, utf8), dtype=np.int64, count=len(utf8)) % WORD_RANGES
    order = np.argsort(ranges, kind="stable")
    number = np.empty(len(order), dtype=np.uint32)
    number[order] = np.arange(len(order))
    utf8 = [utf8[i] for i in order]
    columns = ([chunk], [doc_ids], [sizes], [_squeezed(_packed(number[np.frombuffer(positions, dtype=np.uint32)]))],
               [_packed(np.bincount(ranges, minlength=WORD_RANGES))],
               [_packed(np.fromiter(map(len, utf8), dtype=np.int64, count=len(utf8)))], [b"".join(utf8)])
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _CHUNKS)], schema=_CHUNKS)


def _chunks(docs: DataFrame, pattern: str) -> DataFrame:
    """One row a chunk (see _CHUNKS) as a stored table in buckets by chunk."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(PreTokens, pattern)
        chunk, filled = TaskContext.get().partitionId() << 32, 0
        doc_ids, sizes, words, positions = [], [], Numbers(), array("I")
        for batch in slices(batches):
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                before = len(positions)
                for found in own.pieces(text or ""):
                    positions.extend(map(words.__getitem__, found))
                doc_ids.append(doc)
                sizes.append(len(positions) - before)
                filled += len(text or "")
                if filled >= CHUNK_CHARS:
                    yield _chunk(chunk, doc_ids, sizes, words, positions)
                    chunk, filled = chunk + 1, 0
                    doc_ids, sizes, words, positions = [], [], Numbers(), array("I")
        if doc_ids:
            yield _chunk(chunk, doc_ids, sizes, words, positions)

    spark = docs.sparkSession
    # As many buckets as shuffles have partitions, else the join would deal chunks anew.
    name, buckets = f"pretokens_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        cut, "chunk long, doc_ids array<long>, sizes array<long>, positions binary, dealt binary, lengths binary, letters binary")
    found.write.bucketBy(buckets, "chunk").option("path", scratch_path(spark, "pretokens")).option(
        "compression", "zstd").saveAsTable(name)
    return spark.table(name)


def _encoded_words(chunks: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """chunk, place, counts, ids: the ids of a chunk's words, range by range.

    A row that travels holds the words of one chunk in one range of word
    hashes. A range meets in one task, which encodes each of its words once.
    """
    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, dealt, lengths, letters in zip(*(batch.column(c) for c in ("chunk", "dealt", "lengths", "letters"))):
                lengths, letters = _unpacked(lengths.as_py()), letters.as_py()
                bounds, at = _ends(_unpacked(dealt.as_py())), _ends(lengths)
                own = np.flatnonzero(np.diff(bounds))
                lows, highs = bounds[own], bounds[own + 1]
                yield pa.RecordBatch.from_arrays([
                    pa.array(own, pa.int32()), pa.array(np.full(len(own), chunk.as_py()), pa.int64()),
                    pa.array([_packed(lengths[a:b]) for a, b in zip(lows, highs)], pa.binary()),
                    pa.array([letters[at[a]:at[b]] for a, b in zip(lows, highs)], pa.binary())],
                    names=["place", "chunk", "lengths", "letters"])

    def encode_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_word = encoder(WordEncoder, ranks, pattern).encode
        place, known = None, {}
        for batch in batches:
            counts, ids = [], []
            for at, lengths, letters in zip(*(batch.column(c).to_pylist() for c in ("place", "lengths", "letters"))):
                if at != place:
                    place, known = at, {}
                ends = _ends(_unpacked(lengths)).tolist()
                words = [letters[a:b] for a, b in zip(ends, ends[1:])]
                for word in words:
                    if word not in known:
                        known[word] = array("I", encode_word(word))
                found = [known[w] for w in words]
                counts.append(_packed(np.fromiter(map(len, found), dtype=np.int64, count=len(found))))
                ids.append(_packed(np.frombuffer(b"".join(found), dtype="<u4")))
            yield pa.RecordBatch.from_arrays([batch.column("chunk"), batch.column("place"), pa.array(counts, pa.binary()),
                                              pa.array(ids, pa.binary())], names=["chunk", "place", "counts", "ids"])

    dealt = chunks.select("chunk", "dealt", "lengths", "letters").mapInArrow(
        deal, "place int, chunk long, lengths binary, letters binary")
    return dealt.repartition("place").sortWithinPartitions("place").mapInArrow(
        encode_words, "chunk long, place int, counts binary, ids binary")


def encode(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id, ids (array of int): the token ids of every text.

    ``ranks`` is the path of a rank file, ``pattern`` cuts texts into
    pre-tokens. ``docs`` needs doc_id and text; other columns are ignored,
    whatever their names. A null or empty text has no ids. Rows are independent:
    repeated rows and null or repeated ids give a row each. An empty table
    gives no rows.
    """
    chunks = _chunks(docs, pattern)
    # A row a chunk: its size is that of a chunk's words.
    known = _encoded_words(chunks, ranks, pattern).groupBy("chunk").agg(
        F.sort_array(F.collect_list(F.struct("place", "counts", "ids"))).alias("known"))

    def assemble(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                known = row.column("known").flatten()
                counts = [_unpacked(c) for c in known.field("counts").to_pylist()]
                ids = [_unpacked(c).astype(np.int32) for c in known.field("ids").to_pylist()]
                nothing = [np.zeros(0, dtype=np.int32)]
                words = pa.LargeListArray.from_arrays(pa.array(_ends(np.concatenate(counts or nothing))), pa.array(np.concatenate(ids or nothing)))
                taken = words.take(pa.array(_unpacked(_unsqueezed(row.column("positions")[0].as_py()))))
                sizes = row.column("sizes").flatten().to_numpy(zero_copy_only=False)
                bounds = taken.offsets.to_numpy()[_ends(sizes)] if len(taken) else np.zeros(len(sizes) + 1, dtype=np.int64)
                flat = taken.values if len(taken) else pa.array([], pa.int32())
                yield from _rows(row.column("doc_ids").flatten(), pa.LargeListArray.from_arrays(pa.array(bounds), flat))

    held = chunks.select("chunk", "doc_ids", "sizes", "positions").join(known, "chunk", "left")
    return held.select("doc_ids", "sizes", "positions", F.coalesce(
        "known", F.array().cast("array<struct<place:int,counts:binary,ids:binary>>")).alias("known")).mapInArrow(
            assemble, "doc_id long, ids array<int>")


def _rows(docs: pa.Array, lists: pa.LargeListArray, at_once: int = 1024) -> Iterator[pa.RecordBatch]:
    for low in range(0, len(docs), at_once):
        part = lists.slice(low, at_once).cast(pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([docs.slice(low, at_once), part], schema=_ENCODED)


def decode(encoded: DataFrame, ranks: str) -> DataFrame:
    """doc_id, ids and ``bytes``, what the ids stand for.

    ``encoded`` needs doc_id and ids; an id outside the vocabulary or a null
    one adds nothing, null ids are no bytes.

    The token-byte table, as large as the vocabulary, goes to every task as a
    constant array, and ids meet it by position.
    """
    by_id = {rank: token.hex() for token, rank in read_ranks(ranks).items()}
    table = F.split(F.lit(",".join(by_id.get(i, "") for i in range(max(by_id) + 1))), ",")
    digits = F.array_join(F.transform("ids", lambda i: F.coalesce(F.get(table, i), F.lit(""))), "")
    return encoded.select("doc_id", "ids", F.unhex(F.coalesce(digits, F.lit(""))).alias("bytes"))
