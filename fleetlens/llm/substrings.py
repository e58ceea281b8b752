"""Exact repeats of 20 words: fixed-block anchors.

Every document is cut into reference blocks of 10 words. Any window of 20 words
holds a whole block, so two equal windows meet twice: a rolling 10-word window
of either one equals a reference block of the other.

1. Every rolling 10-word window probes the index of reference blocks. Hashes
   travel packed: a chunk of documents sends one row to each bucket of hashes,
   every different hash once, and gets one answer bit for each.
2. Where anchors hit, they are extended to windows of 20 words. The first
   holder of each such window (smallest doc_id, then position) is found the
   same way; only these windows travel, under a hash of 64 bits and the bits of
   an independent one that choose the bucket.
3. Windows that are not the first of their kind form runs: the maximal exact
   repeats. Their words go.

Documents are dealt to chunks by doc_id in one shuffle that all steps read.
Chunks and buckets have a bounded share of the bytes; a hash that a third of
all documents hold arrives once from each chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 20
BLOCK = WINDOW // 2
CHUNK_BYTES = 2 << 20
BUCKET_BYTES = 64 << 20

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_BYTE, _WORD, _WORD2 = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93
_NO_ID = -(1 << 63)
_powers: list[np.ndarray] = []


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the byte multiplier and of its inverse modulo 2**64, n of each at least."""
    if not _powers or len(_powers[0]) < n:
        size = 1 << n.bit_length()
        _powers[:] = [np.multiply.accumulate(np.append(np.uint64(1), np.full(size - 1, f, dtype=np.uint64)))
                      for f in (_BYTE, pow(_BYTE, -1, 1 << 64))]
    return _powers[0], _powers[1]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class _Words:
    """Words of a chunk's documents in the order of doc_id, hashed."""

    def __init__(self, table: pa.Table):
        ids, texts = table.column("doc_id").to_pylist(), table.column("text").to_pylist()
        rows = sorted(zip((_NO_ID if d is None else d for d in ids), ((t or "").encode("utf-8", "surrogatepass") for t in texts), ids))
        self.ids = [r[2] for r in rows]
        self.order = np.array([r[0] for r in rows], dtype=np.int64)
        self.texts = [r[1] for r in rows]
        data = np.frombuffer(b" ".join(self.texts) + b" ", dtype=np.uint8)
        blank = _BLANK[data]
        edge = np.flatnonzero(np.diff(blank, prepend=True))
        starts, ends = edge[::2], edge[1::2]
        sizes = np.fromiter(map(len, self.texts), dtype=np.int64, count=len(rows)) + 1
        self.doc = np.searchsorted(np.cumsum(sizes), starts, side="right")
        self.first = np.searchsorted(self.doc, np.arange(len(rows) + 1))
        self.place = np.arange(len(starts)) - self.first[self.doc]
        up, down = _power(len(data))
        running = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=running[1:])
        self.hash = _mix((running[ends] - running[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(_WORD2))

    def rolling(self, size: int, factor: int) -> np.ndarray:
        """Hash of the ``size`` words from each word on; only where ``inside`` it means anything."""
        n, out = len(self.hash) - size + 1, np.zeros(len(self.hash), dtype=np.uint64)
        if n > 0:
            h = np.zeros(n, dtype=np.uint64)
            for k in range(size):
                h = h * np.uint64(factor) + self.hash[k:k + n]
            out[:n] = h
        return out

    def inside(self, size: int) -> np.ndarray:
        """Words from which ``size`` words of one document go on."""
        n = len(self.doc) - size + 1
        return np.flatnonzero(self.doc[:max(n, 0)] == self.doc[size - 1:]) if n > 0 else np.empty(0, dtype=np.int64)


def _bits(rows: pa.Table, kind: int) -> Iterator[tuple[int, int, bytes]]:
    rows = rows.filter(pa.compute.equal(rows.column("kind"), kind))
    yield from sorted(zip(rows.column("bucket").to_pylist(), rows.column("n").to_pylist(), rows.column("data").to_pylist()))


def _unpack(data: bytes, n: int, fields: int) -> list[np.ndarray]:
    """``fields`` runs of n bits."""
    bits = np.unpackbits(np.frombuffer(data, dtype=np.uint8)).astype(bool).reshape(fields, -1)
    return [row[:n] for row in bits]


class _Anchors:
    """The different 10-word hashes of a chunk, by bucket."""

    def __init__(self, words: _Words, buckets: int):
        self.at = words.inside(BLOCK)
        h = _mix(words.rolling(BLOCK, _WORD)[self.at])
        self.hash, self.which, times = np.unique(h, return_inverse=True, return_counts=True)
        self.twice = times > 1
        self.block = np.zeros(len(self.hash), dtype=bool)
        self.block[self.which[words.place[self.at] % BLOCK == 0]] = True
        self.bucket = ((self.hash >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


class _Long:
    """The different 20-word windows among a chunk's candidates, by bucket."""

    def __init__(self, words: _Words, candidate: np.ndarray, buckets: int):
        self.at = np.flatnonzero(candidate)
        first, other = words.rolling(BLOCK, _WORD), words.rolling(BLOCK, _WORD2)
        h = _mix(first[self.at] * np.uint64(pow(_WORD, BLOCK, 1 << 64)) + first[self.at + BLOCK])
        route = _mix(other[self.at] * np.uint64(pow(_WORD2, BLOCK, 1 << 64)) + other[self.at + BLOCK])
        self.hash, self.earliest, self.which = np.unique(h, return_index=True, return_inverse=True)
        bucket = ((route[self.earliest] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        self.by_bucket = np.argsort(bucket, kind="stable")
        self.bucket = bucket[self.by_bucket]


_ROW = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("kind", pa.int32()), ("n", pa.int32()), ("data", pa.binary())])
_ROW_SQL = "bucket int, chunk long, kind int, n int, data binary"
_ANCHOR, _WINDOW, _MEMO = 0, 1, 2


def _rows(out: list[tuple]) -> pa.Table:
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * 5, _ROW)], schema=_ROW)


def _dealt(bucket: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Buckets in use and their part of a sorted array."""
    used, starts = np.unique(bucket, return_index=True)
    for b, start, end in zip(used.tolist(), starts, np.append(starts[1:], len(bucket))):
        yield b, slice(start, end)


def _candidates(words: _Words, anchors: _Anchors, answers: pa.Table) -> np.ndarray:
    """Words from which a 20-word window may also stand elsewhere."""
    n = len(words.hash)
    hit, shared = np.zeros(n + 1, dtype=np.int64), np.zeros(n, dtype=bool)
    told = [_unpack(data, size, 2) for _, size, data in _bits(answers, _ANCHOR)]
    if told:
        hit[anchors.at] = np.concatenate([t[0] for t in told])[anchors.which]
        shared[anchors.at] = np.concatenate([t[1] for t in told])[anchors.which]
    before = np.concatenate([[0], np.cumsum(hit[:n])])
    candidate, at = np.zeros(n, dtype=bool), words.inside(WINDOW)
    own = at + (-words.place[at]) % BLOCK  # the first whole reference block
    candidate[at] = shared[own] & (before[at + BLOCK + 1] > before[at])
    return candidate


def _probe(buckets: int):
    def send(key: tuple, docs: pa.Table) -> pa.Table:
        anchors, chunk = _Anchors(_Words(docs), buckets), key[0].as_py()
        return _rows([
            (b, chunk, _ANCHOR, s.stop - s.start, anchors.hash[s].astype("<u4").tobytes()
             + np.packbits(np.array([anchors.block[s], anchors.twice[s]]), axis=1).tobytes())
            for b, s in _dealt(anchors.bucket)])

    return send


def _groups(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorting order, starts of runs of equal values in it, run of each sorted value."""
    order = np.argsort(values)
    new = np.append(True, values[order][1:] != values[order][:-1])
    return order, np.flatnonzero(new), np.cumsum(new) - 1


def _answer_anchors(key: tuple, rows: pa.Table) -> pa.Table:
    """For each hash: does it equal a reference block elsewhere; does it occur elsewhere at all."""
    chunks, sizes, data = (rows.column(c).to_pylist() for c in ("chunk", "n", "data"))
    hashes = np.concatenate([np.frombuffer(d, dtype="<u4", count=n) for d, n in zip(data, sizes)])
    flags = [_unpack(d[4 * n:], n, 2) for d, n in zip(data, sizes)]
    block, twice = (np.concatenate([f[k] for f in flags]) for k in (0, 1))
    order, starts, run = _groups(hashes)
    blocks = np.add.reduceat(block[order].astype(np.int64), starts)[run]
    times = np.add.reduceat(1 + twice[order].astype(np.int64), starts)[run]
    hit, shared = np.empty(len(hashes), dtype=bool), np.empty(len(hashes), dtype=bool)
    hit[order] = blocks > np.where(twice[order], 0, block[order])
    shared[order] = times > 1
    ends = np.cumsum(sizes)
    return _rows([(key[0].as_py(), c, _ANCHOR, n, np.packbits(np.array([hit[e - n:e], shared[e - n:e]]), axis=1).tobytes())
                  for c, n, e in zip(chunks, sizes, ends)])


def _extend(buckets: int):
    def send(key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
        words, chunk = _Words(docs), key[0].as_py()
        candidate = _candidates(words, _Anchors(words, buckets), answers)
        long = _Long(words, candidate, buckets)
        doc = words.order[words.doc[long.at[long.earliest]]] if len(long.at) else np.empty(0, dtype=np.int64)
        out = [(chunk % buckets, chunk, _MEMO, len(candidate), np.packbits(candidate).tobytes())]
        for b, s in _dealt(long.bucket):
            own = long.by_bucket[s]
            out.append((b, chunk, _WINDOW, len(own), long.hash[own].tobytes() + doc[own].tobytes()))
        return _rows(out)

    return send


def _answer_windows(key: tuple, rows: pa.Table) -> pa.Table:
    """For each window: is its document the first that holds it. Memos pass."""
    memo = rows.filter(pa.compute.equal(rows.column("kind"), _MEMO)).select(_ROW.names).cast(_ROW)
    rows = rows.filter(pa.compute.equal(rows.column("kind"), _WINDOW))
    chunks, sizes, data = (rows.column(c).to_pylist() for c in ("chunk", "n", "data"))
    if not chunks:
        return memo
    hashes = np.concatenate([np.frombuffer(d, dtype=np.uint64, count=n) for d, n in zip(data, sizes)])
    doc = np.concatenate([np.frombuffer(d, dtype=np.int64, offset=8 * n) for d, n in zip(data, sizes)])
    order, starts, run = _groups(hashes)
    first = np.empty(len(hashes), dtype=bool)
    first[order] = doc[order] == np.minimum.reduceat(doc[order], starts)[run]
    ends = np.cumsum(sizes)
    return pa.concat_tables([memo, _rows([
        (key[0].as_py(), c, _WINDOW, n, np.packbits(first[e - n:e]).tobytes()) for c, n, e in zip(chunks, sizes, ends)])])


_RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("text", pa.string()),
                     ("repeats", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])


def _remove(buckets: int):
    def cut(key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
        words = _Words(docs)
        n = len(words.hash)
        candidate = np.zeros(n, dtype=bool)
        for _, size, data in _bits(answers, _MEMO):
            candidate = _unpack(data, size, 1)[0]
        long = _Long(words, candidate, buckets)
        first = np.zeros(len(long.hash), dtype=bool)
        told = [_unpack(data, size, 1)[0] for _, size, data in _bits(answers, _WINDOW)]
        if told:
            first[long.by_bucket] = np.concatenate(told)
        stays = first[long.which] & (np.arange(len(long.at)) == long.earliest[long.which])
        again = long.at[~stays]
        depth = np.bincount(again, minlength=n + WINDOW) - np.bincount(again + WINDOW, minlength=n + WINDOW)
        gone = np.cumsum(depth)[:n] > 0
        out = []
        for i, doc in enumerate(words.ids):
            own, text = gone[words.first[i]:words.first[i + 1]], words.texts[i].split()
            edges = np.flatnonzero(np.diff(own, prepend=False, append=False)).tolist()
            kept = [w for w, g in zip(text, own.tolist()) if not g] if edges else text
            out.append((doc, len(text), int(own.sum()), b" ".join(kept).decode("utf-8", "surrogatepass"),
                        [{"start": a, "end": b} for a, b in zip(edges[::2], edges[1::2])]))
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * 5, _RESULT)], schema=_RESULT)

    return cut


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, text, repeats: one row per row of ``docs``.

    A word goes if a 20-word window over it also starts earlier: in a document
    of smaller doc_id, or before it in its own. Windows are judged on the input.
    ``text`` holds the words left, joined by single blanks; ``repeats`` the runs
    removed (start, end of words, end exclusive).

    Null and empty texts have no words. A null doc_id counts as the smallest.
    Rows that repeat a doc_id are read one after the other, in the order of
    their texts, as parts of one document between which no window runs. Other
    columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    held = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    total = held.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(partitions, -(-total // BUCKET_BYTES))
    chunks = max(1, -(-total // CHUNK_BYTES))
    # One shuffle of the texts; the three steps that group by chunk reuse it.
    dealt = held.withColumn("chunk", F.pmod(F.xxhash64("doc_id"), F.lit(chunks))).repartition(partitions, "chunk")

    def per_chunk(answers: DataFrame):
        return dealt.groupBy("chunk").cogroup(answers.groupBy("chunk"))

    probes = dealt.groupBy("chunk").applyInArrow(_probe(buckets), _ROW_SQL)
    anchors = probes.groupBy("bucket").applyInArrow(_answer_anchors, _ROW_SQL)
    windows = per_chunk(anchors).applyInArrow(_extend(buckets), _ROW_SQL)
    firsts = windows.groupBy("bucket").applyInArrow(_answer_windows, _ROW_SQL)
    return per_chunk(firsts).applyInArrow(
        _remove(buckets),
        "doc_id long, n_words long, n_removed long, text string, repeats array<struct<start:int,end:int>>")
