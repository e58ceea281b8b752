"""Quality rules: an ordered list of threshold conjunctions, learned from labels.

Sequential covering on labelled statistics: a rule is grown condition by
condition on two thirds of the rows that no earlier rule covers (FOIL gain),
pruned from its end on the other third, and kept while it stays precise there.
The list is emitted as one ordered Spark conditional, so it can be read, stored
and applied without Python.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.llm.shared import slices

#: Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

#: Expected number of labelled rows at most that rules are learned from.
MAX_LABELLED = 20_000
#: A rule must be this precise on the rows it was not grown on.
MIN_PRECISION = 0.9
MIN_COVER = 5
MAX_CONDITIONS = 4
THRESHOLDS = 64

STATISTICS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper_words"]
FEATURES = ["n_words", "mean_word", "symbol_rate", "dup_line_rate", "repeat_rate", "upper_rate"]


def _repeat_words(words: list[bytes]) -> int:
    """Words inside three-word windows that the text holds twice or more."""
    if len(words) < 4:
        return 0
    number: dict[bytes, int] = {}
    at = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    if len(number) == len(words):
        return 0
    pairs = np.unique(at[:-1] * len(number) + at[1:], return_inverse=True)[1]
    windows = pairs[:-1] * len(number) + at[2:]
    _, which, times = np.unique(windows, return_inverse=True, return_counts=True)
    twice = times[which] > 1
    covered = np.zeros(len(words), dtype=bool)
    for shift in range(3):
        covered[shift:shift + len(twice)] |= twice
    return int(covered.sum())


def _statistics(text: str) -> tuple[int, ...]:
    words = text.encode("utf-8", "surrogatepass").split()  # bytes split at exactly BLANKS
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    return (
        len(words), len(text) - sum(text.count(c) for c in BLANKS), sum(text.count(c) for c in SYMBOLS),
        len(lines), len(lines) - len(set(lines)), _repeat_words(words), sum(map(bytes.isupper, words)),
    )


def _measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        rows = [_statistics(t or "") for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in zip(*rows))], names=["doc_id", *STATISTICS])


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, STATISTICS and FEATURES, one row per row of ``docs``.

    A null or empty text has no words and all statistics 0; rates of a text
    without words are 0. Repeated rows give repeated rows, an empty table none,
    and other columns are ignored, whatever their names.
    """
    measured = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _measure, ", ".join(["doc_id long", *(f"{c} long" for c in STATISTICS)]))

    return measured.withColumns(_rates())


def _rates() -> dict[str, Column]:
    def rate(part: str, whole: str) -> Column:
        return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(0.0)

    return {"mean_word": rate("word_chars", "n_words"), "symbol_rate": rate("n_symbols", "n_words"),
            "dup_line_rate": rate("n_dup_lines", "n_lines"), "repeat_rate": rate("n_repeat_words", "n_words"),
            "upper_rate": rate("n_upper_words", "n_words")}


def base_failed() -> Column:
    """Too few words, or too many of them in repeated windows."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, rows: pd.DataFrame) -> np.ndarray:
        value = rows[self.feature].to_numpy()
        return value > self.threshold if self.above else value <= self.threshold

    def column(self) -> Column:
        c = F.col(self.feature)
        return c > F.lit(self.threshold) if self.above else c <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]
    precision: float
    covered: int

    def holds(self, rows: pd.DataFrame) -> np.ndarray:
        held = np.ones(len(rows), dtype=bool)
        for condition in self.conditions:
            held &= condition.holds(rows)
        return held

    def column(self) -> Column:
        held = F.lit(True)
        for condition in self.conditions:
            held = held & condition.column()
        return held

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions))


def _candidates(rows: pd.DataFrame) -> Iterator[Condition]:
    """Thresholds midway between neighbouring values, spread by quantiles."""
    for feature in FEATURES:
        values = np.unique(rows[feature])
        if len(values) < 2:
            continue
        middle = (values[:-1] + values[1:]) / 2
        spread = np.quantile(rows[feature], np.linspace(0, 1, THRESHOLDS + 1)[1:-1])
        at = np.clip(np.searchsorted(values, spread, side="right") - 1, 0, len(middle) - 1)
        for threshold in middle[np.unique(at)]:
            for above in (False, True):
                yield Condition(feature, above, float(threshold))


def _grow(rows: pd.DataFrame, bad: np.ndarray) -> list[Condition]:
    """Conditions in the order of their gain, until no good row is covered."""
    rule, held = [], np.ones(len(rows), dtype=bool)
    while len(rule) < MAX_CONDITIONS and (held & ~bad).any():
        p, n = (held & bad).sum(), (held & ~bad).sum()
        best, gain = None, 1e-9
        for condition in _candidates(rows[held]):
            now = held & condition.holds(rows)
            p1, n1 = (now & bad).sum(), (now & ~bad).sum()
            if p1 < MIN_COVER:
                continue
            g = p1 * (np.log2(p1 / (p1 + n1)) - np.log2(p / (p + n)))
            if g > gain:
                best, gain = condition, g
        if best is None:
            break
        rule.append(best)
        held &= best.holds(rows)
    return rule


def _prune(rule: list[Condition], rows: pd.DataFrame, bad: np.ndarray) -> Rule | None:
    """The prefix of a rule that is worth most on rows it was not grown on."""
    best = None
    for size in range(1, len(rule) + 1):
        held = Rule(tuple(rule[:size]), 0, 0).holds(rows)
        p, n = int((held & bad).sum()), int((held & ~bad).sum())
        if p and (best is None or (p - n) / (p + n) > best[0]):
            best = (p - n) / (p + n), Rule(tuple(rule[:size]), p / (p + n), p)
    return best[1] if best else None


def learn_rules(rows: pd.DataFrame) -> list[Rule]:
    """Rules for bad rows, in order. ``rows``: FEATURES, ``quality`` (0 bad, 1 good), ``part`` (0..2).

    Parts 0 and 1 grow a rule, part 2 prunes it. Without bad rows, or where no
    precise rule is found, the list is empty and keeps everything.
    """
    rules: list[Rule] = []
    left = rows.reset_index(drop=True)
    while True:
        bad = (left["quality"] == 0).to_numpy()
        grown_on = (left["part"] < 2).to_numpy()
        if (bad & grown_on).sum() < MIN_COVER:
            return rules
        grown = _grow(left[grown_on], bad[grown_on])
        rule = _prune(grown, left[~grown_on], bad[~grown_on]) if grown else None
        if rule is None or rule.precision < MIN_PRECISION:
            return rules
        rules.append(rule)
        left = left[~rule.holds(left)].reset_index(drop=True)


def labelled(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_LABELLED) -> pd.DataFrame:
    """Features and quality of labelled documents, about ``max_rows`` of them at most.

    With more labels those with the smallest hashes of doc_id are taken. Null
    ids and null labels are left out, and so are documents that fail the base
    rules; a document labelled twice counts twice.
    """
    usable = labels.select(F.col("doc_id").cast("long"), "quality").where("doc_id is not null and quality is not null")
    n = usable.count()
    if n > max_rows:
        usable = usable.where(
            F.pmod(F.xxhash64(F.lit("labels"), "doc_id"), F.lit(1 << 30)) < int((1 << 30) * max_rows / n))
    # Two numbers a row and about max_rows rows: small whatever the tables' size.
    wanted = F.broadcast(usable)
    chosen = docs.select(F.col("doc_id").cast("long"), "text").join(wanted.select("doc_id").distinct(), "doc_id", "left_semi")
    part = F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(3)).alias("part")
    # What the base rules reject needs no learned rule.
    return statistics(chosen).where(~base_failed()).join(wanted, "doc_id").select(*FEATURES, "quality", part).toPandas()


def decision(rules: list[Rule]) -> Column:
    """Number of the first rule that holds, counted from 1; 0 where none does."""
    chain = F
    for k, rule in enumerate(rules, 1):
        chain = chain.when(rule.column(), k)
    return chain.otherwise(0) if rules else F.lit(0)


def judge(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """``statistics`` with base_failed, rule (0: none) and kept."""
    judged = statistics(docs).withColumns({"base_failed": base_failed(), "rule": decision(rules)})
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))


def keep_good(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rows of ``docs`` that neither the base rules nor a learned rule reject, columns as they are.

    Statistics are taken where the text is: no join and no shuffle.
    """
    names = docs.columns
    held = docs.select(F.struct(*(docs[c] for c in names)).alias("row"), docs["text"])

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [_statistics(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), *(pa.array(c, pa.int64()) for c in zip(*rows))], names=["row", *STATISTICS])

    fields = [held.schema["row"], *(T.StructField(c, T.LongType()) for c in STATISTICS)]
    measured = held.mapInArrow(measure, T.StructType(fields)).withColumns(_rates())
    return measured.where(~base_failed() & (decision(rules) == 0)).select("row.*")
