"""Token files: all documents as one run of ids, cut into equal-length sequences.

A file is an Arrow IPC file (a stream with a footer) of uncompressed record
batches, so a reader maps it and reaches any sequence without copying:

    ids   fixed-size list of uint16   ``length`` token ids; uint32 for over 65,536 ids
    mask  fixed-size list of bool     false on padding
    docs  list of int64               ids of the documents that end in the sequence
    ends  list of int32               where in the sequence their last token is

Files follow each other in ascending doc_id; a document lies in one file. Only
a file's last sequence is padded. A manifest table names the files in order.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlens.llm.shared import WordTokens, encoder, slices

LENGTH = 2048
END_ID = 2
#: Sequences in a record batch.
_BATCH = 256

_MANIFEST = "part int, first_doc long, path string, n_docs long, n_tokens long"


def _open(uri: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(uri if ":/" in uri else f"file://{uri}")


def _schema(length: int, ids: int) -> pa.Schema:
    kind = pa.uint16() if ids <= 1 << 16 else pa.uint32()
    return pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length)),
                      ("docs", pa.list_(pa.int64())), ("ends", pa.list_(pa.int32()))])


class _Writer:
    """One file; holds at most a batch of sequences and one document."""

    def __init__(self, uri: str, length: int, ids: int):
        self.fs, path = _open(uri)
        self.fs.create_dir(path.rpartition("/")[0])
        self.schema, self.length = _schema(length, ids), length
        self.sink = self.fs.open_output_stream(path)
        self.out = pa.ipc.new_file(self.sink, self.schema)
        self.ids, self.held, self.ends, self.docs = [], 0, [], []

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        self.ids.append(ids)
        self.held += len(ids)
        self.ends.append(self.held - 1)
        self.docs.append(doc)
        if self.held >= self.length * _BATCH:
            self._flush(self.held // self.length)

    def _flush(self, sequences: int) -> None:
        size = sequences * self.length
        ids = np.concatenate(self.ids)
        ends = np.array(self.ends, dtype=np.int64)
        kind = self.schema.field("ids").type.value_type
        done = int(np.searchsorted(ends, size))
        cuts = np.searchsorted(ends[:done], np.arange(sequences + 1) * self.length)
        for at in range(0, sequences, _BATCH):  # a long document fills many batches
            to = min(sequences, at + _BATCH)
            part = ids[at * self.length:to * self.length]
            mask = np.arange((to - at) * self.length) < len(part)
            if len(part) < len(mask):  # the file's end
                part = np.pad(part, (0, len(mask) - len(part)))
            inside = slice(cuts[at], cuts[to])
            offsets = pa.array(cuts[at:to + 1] - cuts[at], pa.int32())
            self.out.write_batch(pa.RecordBatch.from_arrays([
                pa.FixedSizeListArray.from_arrays(pa.array(part.astype(kind.to_pandas_dtype())), self.length),
                pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length),
                pa.ListArray.from_arrays(offsets, pa.array(self.docs[inside], pa.int64())),
                pa.ListArray.from_arrays(offsets, pa.array(ends[inside] % self.length, pa.int32())),
            ], schema=self.schema))
        self.ids, self.held = [ids[size:]], max(0, self.held - size)
        self.ends, self.docs = [e - size for e in self.ends[done:]], self.docs[done:]

    def close(self) -> None:
        if self.held:
            self._flush(-(-self.held // self.length))
        self.out.close()
        self.sink.close()


def write_token_files(docs: DataFrame, vocabulary: str, path: str, length: int = LENGTH,
                      end_id: int = END_ID) -> DataFrame:
    """Encode doc_id and text of ``docs`` into files below ``path``; return the manifest.

    A null or empty text is the end id alone. Repeated doc_ids follow each
    other, a null doc_id comes first. Other columns are ignored, whatever their
    names; an empty table makes an empty manifest.

    A task writes its range of documents to a file of a new name and only then
    reports it: the manifest lists files of finished tasks, and what a lost
    task left behind is never read.
    """
    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        uri, end = f"{path}/tokens-{part:06d}-{uuid.uuid4().hex[:12]}.arrow", np.array([end_id], dtype=np.uint32)
        writer, first, n_docs, n_tokens = None, None, 0, 0
        words = encoder(WordTokens, vocabulary)
        for batch in slices(batches):
            ids = batch.column("doc_id").to_pylist()
            if writer is None:
                writer, first = _Writer(uri, length, max(end_id + 1, words.size)), ids[0]
            for doc, raw in zip(ids, words.encode([t or "" for t in batch.column("text").to_pylist()])):
                tokens = np.concatenate([np.frombuffer(raw, dtype="<u4"), end])
                writer.add(doc, tokens)
                n_docs += 1
                n_tokens += len(tokens)
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "first_doc": pa.array([first], pa.int64()), "path": [uri],
                "n_docs": [n_docs], "n_tokens": [n_tokens]})

    ordered = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    ordered.mapInArrow(encode, _MANIFEST).write.parquet(f"{path}/manifest")
    return docs.sparkSession.read.schema(_MANIFEST).parquet(f"{path}/manifest")


def sequences(uri: str) -> pa.Table:
    """A file's sequences; mapped, not copied, where the file system is local."""
    fs, path = _open(uri)
    if isinstance(fs, pa.fs.LocalFileSystem):
        return pa.ipc.open_file(pa.memory_map(path)).read_all()
    return pa.ipc.open_file(fs.open_input_file(path)).read_all()


def _documents(uri: str) -> Iterator[tuple[int | None, np.ndarray]]:
    """(doc_id, ids with the end id) in the order of the file, a batch in memory at a time."""
    fs, path = _open(uri)
    with fs.open_input_file(path) as source:
        reader, rest = pa.ipc.open_file(source), np.empty(0, dtype=np.uint32)
        for k in range(reader.num_record_batches):
            batch = reader.get_batch(k)
            ids = np.concatenate([rest, batch.column("ids").flatten().to_numpy().astype(np.uint32)])
            first = np.repeat(np.arange(batch.num_rows) * batch.column("ids").type.list_size,
                              batch.column("ends").value_lengths().to_numpy())
            ends = first + batch.column("ends").flatten().to_numpy() + len(rest) + 1
            start = 0
            for doc, end in zip(batch.column("docs").flatten().to_pylist(), ends):
                yield doc, ids[start:end]
                start = end
            rest = ids[start:]


def read_documents(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Documents as the files hold them: doc_id, start, n_tokens, ids.

    ``start`` counts the ids of all documents before. Offsets of files are
    running sums over the manifest, which has a row per file.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("long")))

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, start in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist()):
                rows, size = ([], [], [], []), 0

                def out():
                    return pa.RecordBatch.from_arrays([
                        pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.int64()),
                        pa.array(rows[3], pa.binary())], names=["doc_id", "start", "n_tokens", "ids"])

                for doc, ids in _documents(uri):
                    for column, value in zip(rows, (doc, start, len(ids), ids.tobytes())):
                        column.append(value)
                    start += len(ids)
                    size += len(ids)
                    if size > 1 << 20:
                        yield out()
                        rows, size = ([], [], [], []), 0
                if rows[0]:
                    yield out()

    # A number of its own: the manifest is small, what its rows stand for is not.
    files = placed.select("path", "base").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path")
    return files.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


