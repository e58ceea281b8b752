"""SimHash near-duplicates: fingerprints that meet in the middle of a Hamming ball.

Two fingerprints that differ in at most three bits share a point within half
that distance. Of the points between them one has an even number of set bits,
so a fingerprint only emits its even variants: an even one itself and all with
two bits flipped, an odd one all with one bit flipped (half of 3, rounded up
and down). Fingerprints are shuffled on variants - by a few of their bits; the
other bits are flipped where the variants meet, so a fingerprint travels some
dozen times and not two thousand times.

At a meeting point, a fingerprint at most one bit away (a hub) is within three
bits of all others there, so one link each to a hub joins everyone: no group
is ever expanded to pairs, and none is cut. Two that both come from two bits
away are either four bits apart, or meet again at each other's own point.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.components import components
from fleetlens.llm.shared import slices, stored

BITS = 64
SHINGLE = 3
SEED = 42
#: Fingerprints at a route whose variants are expanded at once.
_AT_ONCE = 8192


def _fingerprint(text: str, shingle: int) -> int:
    words = text.encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z, ASCII blanks
    if not words:
        return 0
    digest = xxhash.xxh64_digest
    runs = zip(*(words[i:] for i in range(shingle))) if len(words) >= shingle else [words]
    hashes = b"".join([digest(b" ".join(run), SEED) for run in runs])
    rows = np.frombuffer(hashes, dtype=np.uint8).reshape(-1, 8)
    set_bits = sum(np.unpackbits(rows[i:i + 4096], axis=1).sum(axis=0, dtype=np.int64) for i in range(0, len(rows), 4096))
    return int.from_bytes(np.packbits(2 * set_bits > len(rows)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, body: Column | None = None) -> DataFrame:
    """doc_id, body and fp (64 bits as a signed long), one row per row of ``docs``.

    ``body`` is any number that tells texts apart, 0 if not given.

    A text of fewer words than a shingle is one shingle; a null text, or one
    without words, has fingerprint 0. Other columns are ignored.
    """
    def of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            fps = [_fingerprint(t or "", shingle) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("body"), pa.array(fps, pa.int64())], names=["doc_id", "body", "fp"])

    rows = docs.select(F.col("doc_id").cast("long"), "text", (F.lit(0) if body is None else body).cast("long").alias("body"))
    return rows.mapInArrow(of, "doc_id long, body long, fp long")


def hex_digits(fp: str = "fp") -> Column:
    """A fingerprint as 16 lower-case hex digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def _masks(bits: range | list[int], flips: int) -> np.ndarray:
    sets = [sum(1 << b for b in chosen) for chosen in combinations(bits, flips)]
    return np.array(sets, dtype=np.uint64)


def _free_flips(odd: bool, used: int) -> list[int]:
    """Flips left to reach an even point after ``used`` flips: one in all from an odd, none or two from an even one."""
    return [total - used for total in ([1] if odd else [0, 2]) if total >= used]


def _routes(bits: int) -> Column:
    """Flips of the lowest ``bits`` bits: all variants an even, and an odd, fingerprint emits there."""
    low = range(bits)

    def flips(most: int) -> Column:
        masks = [int(m) for k in range(most + 1) for m in _masks(low, k)]
        return F.array(*[F.lit(m).cast("long") for m in masks])

    return F.when(F.bit_count("fp") % 2 == 0, flips(2)).otherwise(flips(1))


def _joined(fps: np.ndarray, used: np.ndarray, bits: int, route: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between fingerprints of one route: every one with the smallest it is connected with here.

    ``used``: bits of the lowest ``bits`` that differ from the route's.
    """
    if len(fps) > _AT_ONCE and bits < BITS - 8:
        # A crowded route is split by further bits, as the shuffle did before.
        step, a, b = 6, [], []
        low = np.uint64((1 << (bits + step)) - 1)
        for more in range(1 << step):
            deeper = route | more << bits
            now = np.bitwise_count((fps ^ np.uint64(deeper)) & low).astype(np.int64)
            near = now <= np.where(np.bitwise_count(fps) % 2 == 0, 2, 1)
            if near.any():
                x, y = _joined(fps[near], now[near], bits + step, deeper)
                a.append(x)
                b.append(y)
        return np.concatenate(a), np.concatenate(b)
    odd = np.bitwise_count(fps) % 2 == 1
    low = np.uint64((1 << bits) - 1)
    at_route = (fps & ~low) | np.uint64(route)
    points, owners, hubs = [], [], []
    for is_odd in (False, True):
        for u in (0, 1, 2):
            mine = np.flatnonzero((odd == is_odd) & (used == u))
            for free in _free_flips(is_odd, u) if len(mine) else []:
                masks = _masks(range(bits, BITS), free)
                points.append((at_route[mine][:, None] ^ masks).ravel())
                owners.append(np.repeat(mine, len(masks)))
                hubs.append(np.full(len(points[-1]), u + free < 2))
    points, owners, hubs = (np.concatenate(x) if x else np.empty(0, dtype=np.int64) for x in (points, owners, hubs))
    order = np.argsort(points, kind="stable")
    points, owners, hubs = points[order], owners[order], hubs[order]
    starts = np.flatnonzero(np.append(True, points[1:] != points[:-1])) if len(points) else np.empty(0, dtype=np.int64)
    sizes = np.diff(np.append(starts, len(points)))
    none = len(fps)
    hub = np.minimum.reduceat(np.where(hubs, owners, none), starts) if len(starts) else starts
    linked = np.repeat((sizes > 1) & (hub < none), sizes)
    left, right = np.repeat(hub, sizes)[linked], owners[linked]
    # Components of the route, so that a dense family leaves one link a member.
    label = np.arange(len(fps))
    while len(left):
        low_label = np.minimum(label[left], label[right])
        before = label.copy()
        np.minimum.at(label, left, low_label)
        np.minimum.at(label, right, low_label)
        label = label[label]
        if (label == before).all():
            break
    moved = np.flatnonzero(label != np.arange(len(fps)))
    return fps[moved], fps[label[moved]]


def fingerprint_links(fps: DataFrame) -> DataFrame:
    """``a, b``: links that connect all fingerprints (column fp, distinct) within three bits.

    Pairs further apart appear only where a chain of such links joins them.
    """
    n = fps.count()
    bits = max(0, min(24, n.bit_length() - 7))
    routed = fps.select("fp", F.explode(_routes(bits)).alias("flip")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("flip")).bitwiseAND((1 << bits) - 1).alias("route"),
        F.bit_count("flip").alias("used"))

    def join(key: tuple, rows: pa.Table) -> pa.Table:
        own = rows.column("fp").to_numpy().view(np.uint64)
        a, b = _joined(own, rows.column("used").to_numpy().astype(np.int64), bits, key[0].as_py())
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return routed.groupBy("route").applyInArrow(join, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp, component_id for every row of ``docs``.

    Fingerprints within three bits are linked; component_id is the smallest
    doc_id reachable over links. Equal fingerprints are one node, so exact
    copies cost nothing. Texts without words share fingerprint 0 and are linked
    like any other. A null doc_id takes part but never names a component that
    has another. An empty table gives no rows.
    """
    rows = stored(fingerprints(docs, shingle), "fingerprints")
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    labels = components(fingerprint_links(distinct.select("fp")))
    placed = distinct.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("label", "fp").alias("label"))
    placed = stored(placed, "placed")
    named = placed.groupBy("label").agg(F.min("first").alias("component_id"))
    ids = placed.join(named, "label").select("fp", "component_id")
    return rows.join(ids, "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One row of ``docs`` for each group of near-duplicates, columns as they are.

    The row of the smallest doc_id stays (of several with that id, the text with
    the smallest hash). A row is known by its id and its text's hash, so
    repeated rows are one document, and different texts under one id are two.
    Rows without doc_id are named by their text alone.
    """
    body = F.xxhash64("text")
    rows = stored(fingerprints(docs, shingle, body), "fingerprints")
    labels = components(fingerprint_links(rows.select("fp").distinct()))
    placed = rows.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select(
        F.struct("doc_id", "body").alias("row"), F.coalesce("label", "fp").alias("label"))
    # A null id sorts first in a struct; it must not win over an id.
    first = F.min(F.when(F.col("row.doc_id").isNotNull(), F.col("row")))
    keep = placed.groupBy("label").agg(F.coalesce(first, F.min("row")).alias("keep")).select(
        F.col("keep.doc_id").alias("keep_id"), F.col("keep.body").alias("keep_body"))
    kept = docs.join(keep, F.col("doc_id").cast("long").eqNullSafe(F.col("keep_id")) & (body == F.col("keep_body")), "left_semi")
    repeated = rows.groupBy("doc_id", "body").count().where("count > 1").select(
        F.col("doc_id").alias("twice_id"), F.col("body").alias("twice_body"))
    if repeated.isEmpty():
        return kept
    twice = F.col("doc_id").cast("long").eqNullSafe(F.col("twice_id")) & (body == F.col("twice_body"))
    return kept.join(repeated, twice, "left_anti").unionByName(
        kept.join(repeated, twice, "left_semi").dropDuplicates(["doc_id", "text"]))
