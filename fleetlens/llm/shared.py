"""What several training-data operators need: scratch tables, batches, cached encoding."""

from __future__ import annotations

import os
import re
import uuid
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from fleetlens.session import scratch_root

#: Characters that separate words in the shingle and window operators.
WORD_SPLIT = r"[\x20\x09-\x0D]+"

#: Python side: texts handled at once. Long texts make smaller batches, so a
#: worker's memory follows this bound and the longest single text.
BATCH_BYTES = 4 << 20


def scratch_path(spark: SparkSession, what: str) -> str:
    """A new path below the shared folder named in ``spark.checkpoint.dir``."""
    return f"{scratch_root(spark)}/{what}-{uuid.uuid4().hex[:8]}"


#: Whether Spark drops the shuffle files of an execution as soon as it ends.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, what: str, compression: str = "snappy") -> DataFrame:
    """Write a frame to the shared folder and go on from the written table.

    Nothing reads the shuffles of the write again. They go with its end: else
    those of all steps pile up until the driver collects garbage.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, what)
    before = spark.conf.get(DROP_SHUFFLES, "false")
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        df.write.parquet(path, compression=compression)
    finally:
        spark.conf.set(DROP_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def slices(batches: Iterable[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut record batches so that the text column of a piece has about BATCH_BYTES."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(column).cast(pa.large_string())
        ends = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:][: len(texts) + 1]
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(ends, ends[start] + BATCH_BYTES, side="right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


#: Distinct pieces a worker remembers; beyond, those unused lately are dropped.
CACHE_PIECES = 700_000

_encoders: dict[tuple, object] = {}


#: Longer pieces are encoded each time: what is remembered stays small.
CACHE_CHARS = 256


class CachedPieces:
    """Encodes texts piece by piece, every distinct piece of a worker once.

    Encoding the same word again and again would be most of the work.
    """

    def __init__(self):
        self.known: dict[str, bytes] = {}
        self.lately: set[str] = set()

    def _cut(self, text: str) -> list[str]:
        """Pieces whose ids, put together, are the text's."""
        raise NotImplementedError

    def _fresh(self, pieces: list[str]) -> list[bytes]:
        raise NotImplementedError

    def encode(self, texts: list[str]) -> list[bytes]:
        """Token ids as little-endian unsigned 32-bit bytes."""
        cut = [self._cut(t) for t in texts]
        used = set().union(*cut)
        known = self.known
        new = [p for p in used if p not in known]
        if len(known) + len(new) > CACHE_PIECES:
            keep = self.lately | used
            known = self.known = {p: ids for p, ids in known.items() if p in keep}
            self.lately = set()
        if len(self.lately) < CACHE_PIECES // 2:
            self.lately |= used
        known.update(zip(new, self._fresh(new)))
        ids = known.__getitem__
        out = [b"".join(map(ids, pieces)) for pieces in cut]
        for p in new:
            if len(p) > CACHE_CHARS:
                del known[p]
                self.lately.discard(p)
        return out


def _tokenizer(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # their strings are ordinary text
    return tokenizer


class ByteTokens(CachedPieces):
    """Byte-level BPE by the ``tokenizers`` library.

    Within a match of its pattern, white space never follows what is not white
    space, a stop or comma never follows a letter, and no match looks back:
    texts may be cut there. A word of plain letters needs no splitter and goes
    to the library's model at once.
    """

    _space = r"\t\n\v\f\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
    #: White space besides blanks and line ends.
    rare = re.compile(f"[{_space}]".replace(r"\n", "").replace(" ", "")).search
    pieces = re.compile(r"[ \n]*[A-Za-z]+(?=[ \n.,]|\Z)|[ \n]*[^ \n]+|[ \n]+").findall
    all_pieces = re.compile(f"[{_space}]*[^{_space}]+|[{_space}]+").findall
    word = re.compile(" ?[A-Za-z]+").fullmatch

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = _tokenizer(path)

    def _cut(self, text: str) -> list[str]:
        return self.all_pieces(text) if self.rare(text) else self.pieces(text)

    def _fresh(self, pieces: list[str]) -> list[bytes]:
        tokens, out, slow = self.tokenizer.model.tokenize, {}, []
        for p in pieces:
            if self.word(p):
                out[p] = array("I", [t.id for t in tokens(p.replace(" ", "\u0120"))]).tobytes()  # how byte-level writes a blank
            else:
                slow.append(p)
        for p, e in zip(slow, self.tokenizer.encode_batch_fast(slow, add_special_tokens=False)):
            out[p] = array("I", e.ids).tobytes()
        return [out[p] for p in pieces]


class WordTokens(CachedPieces):
    """BPE over lower-cased words, white space dropped, by the ``tokenizers`` library.

    White space separates words for good, so texts are cut at blanks. A piece
    of letters alone needs no normaliser or splitter and goes to the library's
    model at once.
    """

    #: Full stops or commas beside other marks, which the tokenizer keeps together.
    runs = re.compile(r"[.,](?:[^\w\s]|_)|(?:[^\w\s]|_)[.,]").search
    plain = frozenset(" \n.,")

    def __init__(self, path: str):
        from tokenizers.pre_tokenizers import ByteLevel

        super().__init__()
        self.tokenizer = _tokenizer(path)
        self.model, self.size = self.tokenizer.model, self.tokenizer.get_vocab_size()
        # How the library writes the UTF-8 bytes of Latin letters.
        by_library = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.written = {c: by_library(chr(c))[0][0] for c in range(256) if chr(c).isalpha()}

    def _cut(self, text: str) -> list[str]:
        # Lower case and marks set apart, where that is sure to change no id,
        # make far fewer distinct pieces.
        if _latin(text):
            marks = {c for c in set(text) if not c.isalnum()}
            odd = not marks <= self.plain or ".." in text or ",," in text or ".," in text or ",." in text
            if not odd or not self.runs(text):
                text = text.replace(".", " . ").replace(",", " , ")
            text = text.lower()
        return text.replace("\n", " ").split(" ")

    def _fresh(self, pieces: list[str]) -> list[bytes]:
        tokens, slow = self.model.tokenize, []
        out = {}
        for p in pieces:
            if p.isalpha() and _latin(p):
                out[p] = array("I", [t.id for t in tokens(p.lower().translate(self.written))]).tobytes()
            else:
                slow.append(p)
        for p, e in zip(slow, self.tokenizer.encode_batch_fast(slow, add_special_tokens=False)):
            out[p] = array("I", e.ids).tobytes()
        return [out[p] for p in pieces]


def _latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def encoder(kind: type, *args):
    """This worker's encoder of that kind, made once."""
    if (kind, *args) not in _encoders:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _encoders[(kind, *args)] = kind(*args)
    return _encoders[(kind, *args)]
