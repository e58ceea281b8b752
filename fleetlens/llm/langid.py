"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased and everything but letters counts as a blank. Runs of two
and three characters that begin at a letter, or at the blank before one, are
hashed into a fixed number of columns. Training counts columns per language on
Spark; the matrix of log probabilities (languages x columns) is broadcast, its
size checked, and texts are scored in batches with numpy.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.shared import slices

#: Hashed columns; a power of two.
COLUMNS = 1 << 15
#: Expected number of training documents at most, drawn by a hash of doc_id.
MAX_TRAINING_DOCS = 20_000
#: The matrix is broadcast: languages x columns x 4 bytes stay below this.
MAX_MODEL_BYTES = 64 << 20
SMOOTHING = 0.5
UNKNOWN = "und"
#: Code points scored at once.
_CHUNK = 1 << 20


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def _codes(text: str) -> np.ndarray:
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return np.where(_letters()[codes], codes, np.uint32(32))


def _grams(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed columns of the runs of two and of three characters, -1 where none begins.

    ``codes`` ends with two blanks, so no run reaches over the end.
    """
    shift = np.uint64(64 - COLUMNS.bit_length() + 1)
    c = codes.astype(np.uint64)
    pair = c[:-1] * np.uint64(0x9E3779B97F4A7C15) + c[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
    triple = pair[:-1] + c[2:] * np.uint64(0x165667B19E3779F9)
    visible = codes != 32
    begins = visible[:-1] | visible[1:]
    both = []
    for value, at in ((pair, begins), (triple * np.uint64(0xD6E8FEB86659FD93), begins[:-1])):
        column = ((value ^ (value >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> shift).astype(np.int32)
        column[~at[: len(column)]] = -1
        both.append(column)
    return both[0], both[1]


def _joined(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(documents, code points, document starts) for runs of texts, two blanks after each."""
    held, docs, size = [], [], 0
    blanks = np.full(2, 32, dtype=np.uint32)

    def out():
        starts = np.cumsum([0, *(len(h) for h in held)])[:-1]
        return np.array(docs), np.concatenate(held), starts

    for i, text in enumerate(texts):
        codes = np.concatenate([blanks[:1], _codes(text or ""), blanks])
        held.append(codes)
        docs.append(i)
        size += len(codes)
        if size >= _CHUNK:
            yield out()
            held, docs, size = [], [], 0
    if held:
        yield out()


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        langs, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
        for lang in sorted(set(langs)):
            total = np.zeros(COLUMNS, dtype=np.int64)
            for _, codes, _ in _joined([t for t, of in zip(texts, langs) if of == lang]):
                for column in _grams(codes):
                    total += np.bincount(column[column >= 0], minlength=COLUMNS)
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([lang] * len(used), pa.string()),
                "column": pa.array(used, pa.int32()), "n": pa.array(total[used], pa.int64())})


@dataclass(frozen=True)
class Model:
    """``weights[l, c]``: log probability of column c in language l; ``prior`` likewise."""

    languages: list[str]
    weights: np.ndarray
    prior: np.ndarray


def train(docs: DataFrame, max_docs: int = MAX_TRAINING_DOCS) -> Model:
    """Learn from rows with doc_id, text and lang; rows with a null text or lang are left out.

    With more than ``max_docs`` usable rows those with the smallest hashes of
    doc_id are used, about ``max_docs`` of them. No usable row: a model that
    knows no language.
    """
    usable = docs.select("doc_id", "text", "lang").where("text is not null and lang is not null")
    n = usable.count()
    if n > max_docs:
        usable = usable.where(F.pmod(F.xxhash64(F.lit("train"), "doc_id"), F.lit(1 << 30)) < int((1 << 30) * max_docs / n))
    kept = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(kept)
    if len(languages) * COLUMNS * 4 > MAX_MODEL_BYTES:
        raise ValueError(f"{len(languages)} languages make a matrix over {MAX_MODEL_BYTES} bytes; use fewer columns")
    counts = usable.mapInArrow(_count, "lang string, column int, n long").groupBy("lang", "column").agg(F.sum("n").alias("n"))
    table = np.full((len(languages), COLUMNS), SMOOTHING)
    found = counts.toPandas()
    if len(found):
        table[found["lang"].map({lang: i for i, lang in enumerate(languages)}), found["column"]] += found["n"]
    weights = np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32) if languages else table
    prior = np.log(np.array([kept[lang] for lang in languages], dtype=float) / max(1, sum(kept.values())))
    return Model(languages, weights, prior)


def _score(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    labels, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    for docs, codes, starts in _joined(texts):
        total = np.tile(model.prior, (len(docs), 1))
        for column in _grams(codes):
            at = np.flatnonzero(column >= 0)
            # Sums over a document's columns as differences of running sums.
            cuts = np.searchsorted(at, np.append(starts, len(codes)))
            for i, row in enumerate(model.weights):
                running = np.concatenate([[0.0], np.cumsum(row[column[at]], dtype=np.float64)])
                total[:, i] += running[cuts[1:]] - running[cuts[:-1]]
        seen = np.add.reduceat((codes != 32).astype(np.int64), starts) > 0
        best = total.argmax(axis=1)
        share = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        for j in np.flatnonzero(seen):
            labels[docs[j]], scores[docs[j]] = model.languages[best[j]], share[j]
    return labels, scores


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs``: doc_id, lang_pred, score; only the text is looked at.

    Null texts and texts without a letter are ``und`` with score 0, and so are
    all texts where the model knows no language. Ties take the language that
    sorts first. ``score`` is the probability of the predicted language. Other
    columns are ignored, whatever their names; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def label(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            labels, scores = _score(shared.value, texts) if shared.value.languages else (
                [UNKNOWN] * len(texts), np.zeros(len(texts)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(labels, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(label, "doc_id long, lang_pred string, score double")


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the quarter of documents that no model learns from; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))
