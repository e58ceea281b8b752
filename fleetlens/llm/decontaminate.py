"""Benchmark decontamination by a positional inverted index.

Benchmark items are cut into windows of words. Counting the benchmark's terms
in the training texts tells each window's rarest terms; a window with a term
that never occurs is dropped at once. The index stores the positions of those
rarest terms only (term, doc_id, position); lists are shifted by the term's
place in the window and intersected, rarest first. What survives is compared
with the text word for word.

DataFrame functions only.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.shared import stored

WINDOW = 13
#: Words that a proximity match's words may lie off their places.
SLACK = 1
#: Terms of a window whose posting lists are intersected.
RAREST = 3
#: Distinct terms up to which the benchmark's vocabulary is broadcast (some
#: 40 bytes each); a larger one is joined by shuffling.
BROADCAST_TERMS = 200_000

#: Fixed value: characters that separate words once A-Z are lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text; none for a null one. Only A-Z are lower-cased."""
    low = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
    return F.array_remove(F.split(F.coalesce(low, F.lit("")), SEPARATORS), "")


def benchmark_windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """win (its words, blank-separated), item_id: the distinct windows of every item.

    An item of fewer words is one window, one without words has none.
    """
    held = items.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - size + 1))
    return held.select("item_id", F.explode(F.transform(
        starts, lambda s: F.array_join(F.slice("w", s, size), " "))).alias("win")).distinct()


def _small(terms: DataFrame, n: int) -> DataFrame:
    return F.broadcast(terms) if n <= BROADCAST_TERMS else terms


def rarest_terms(docs: DataFrame, windows: DataFrame, terms: int = RAREST) -> DataFrame:
    """win, rank (from 1), term, place: a window's rarest terms, rarest first.

    Windows with a term that no document holds are left out: they can't occur.
    A term that a window repeats stands for its first place only.
    """
    parts = windows.select("win").distinct().select("win", F.posexplode(F.split("win", " ")).alias("place", "term"))
    parts = parts.groupBy("win", "term").agg(F.min("place").alias("place"))
    vocabulary = stored(parts.select("term").distinct(), "terms")
    counts = (docs.select(F.explode(words(F.col("text"))).alias("term"))
              .join(_small(vocabulary, vocabulary.count()), "term").groupBy("term").agg(F.count("*").alias("n")))
    order = Window.partitionBy("win").orderBy(F.coalesce("n", F.lit(0)), "place")
    ranked = parts.join(counts, "term", "left").withColumn("rank", F.row_number().over(order))
    least = F.min(F.coalesce("n", F.lit(0))).over(Window.partitionBy("win"))
    return ranked.withColumn("least", least).where(f"rank <= {terms} and least > 0").select("win", "rank", "term", "place")


def positional_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """term, doc_id, pos of every occurrence of the listed terms, as a stored table."""
    wanted = terms.select("term").distinct()
    postings = docs.select("doc_id", F.posexplode(words(F.col("text"))).alias("pos", "term")).join(
        _small(wanted, wanted.count()), "term")
    return stored(postings.select("term", "doc_id", "pos"), "postings")


def intersect(index: DataFrame, rarest: DataFrame, slack: int = 0) -> DataFrame:
    """win, doc_id, start: where all of a window's listed terms lie in place.

    With ``slack`` every further term may lie that many words off its place: a
    proximity match. Lists are joined rarest first on (term, document, place),
    so a common term is only looked up where the rarer ones are.
    """
    lists = {r: rarest.where(F.col("rank") == r).select("win", "term", "place") for r in range(1, RAREST + 1)}
    found = lists[1].join(index, "term").select("win", "doc_id", (F.col("pos") - F.col("place")).alias("start"))
    found = found if slack else found.where("start >= 0")
    width = 2 * slack + 1
    for r in range(2, RAREST + 1):
        # Windows of few distinct terms have no term of this rank and pass.
        here = found.join(lists[r], "win", "left")
        at = F.col("start") + F.col("place")
        cells = F.array_distinct(F.array(F.floor((at - slack) / width), F.floor((at + slack) / width)))
        probe = here.where("term is not null").select("*", at.alias("at"), F.explode(cells).alias("cell"))
        listed = index.select("term", F.col("doc_id").alias("in_doc"), "pos", F.floor(F.col("pos") / width).alias("cell"))
        near = probe.join(listed, (probe["term"] == listed["term"]) & (probe["cell"] == listed["cell"])
                          & probe["doc_id"].eqNullSafe(listed["in_doc"]) & (F.abs(probe["at"] - listed["pos"]) <= slack))
        passed = near.select(probe["win"], "doc_id", "start")
        passed = passed.distinct() if slack else passed
        found = passed.union(here.where("term is null").select("win", "doc_id", "start"))
    return found


def _in_place(c: Column, slack: int) -> Column:
    """Whether every term of a window lies in the text's words ``w`` at most ``slack`` off its place."""
    def lies(term: Column, place: Column) -> Column:
        near = F.lit(False)
        for off in range(-slack, slack + 1):
            # F.get gives null outside the text.
            near = near | F.coalesce(F.get("w", c["start"] + place + off) == term, F.lit(False))
        return near

    return F.forall(F.transform(F.split(c["win"], " "), lies), lambda held: held)


def phrase_matches(docs: DataFrame, found: DataFrame, slack: int = 0) -> DataFrame:
    """Every row of ``docs`` as row (its columns), n_words and ``matches`` (start, len, win) found word for word.

    With ``slack`` a match's words may each lie that far off their places; its
    start may then be before the text's.

    The candidates of a document are fewer than its words times the windows
    that share a rarest term; documents with equal ids are compared each.
    """
    per_doc = found.groupBy(F.col("doc_id").alias("in_doc")).agg(F.collect_set(F.struct("start", "win")).alias("found"))
    held = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row")).join(
        per_doc, F.col("row.doc_id").eqNullSafe(F.col("in_doc")), "left")
    held = held.select("row", words(F.col("row.text")).alias("w"), "found")
    sized = F.transform(F.coalesce("found", F.array().cast("array<struct<start:int,win:string>>")), lambda c: F.struct(
        c["start"].alias("start"), F.size(F.split(c["win"], " ")).alias("len"), c["win"].alias("win")))
    same = F.filter(sized, lambda c: F.array_join(F.slice("w", c["start"] + 1, c["len"]), " ") == c["win"])
    if slack:
        same = F.filter(sized, lambda c: _in_place(c, slack))
    return held.select("row", F.size("w").cast("long").alias("n_words"), same.alias("matches"))


def hit_words(matches: Column) -> Column:
    """Number of a document's words inside any match, of which ``n_words`` bounds the end."""
    spans = F.transform(matches, lambda m: F.sequence(
        F.greatest(F.lit(0), m["start"]), F.least(F.col("n_words").cast("int"), m["start"] + m["len"]) - 1))
    return F.size(F.array_distinct(F.flatten(spans))).cast("long")


def contaminated(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, items (sorted ids as strings), contaminated; one row per row of ``docs``.

    A document word inside any occurrence of a benchmark window is hit; a
    document is contaminated where a twentieth of its words or more are. Null
    and empty texts have no words and no hits; an item without words never
    occurs. Equal item texts are different items. Repeated rows and null ids
    are judged by their own text, and rows with the same id share their items.
    Other columns are ignored; empty tables give no rows, or no hits.
    """
    windows = stored(benchmark_windows(items, size), "windows")
    matched = _matched(docs.select("doc_id", "text"), windows).select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "n_hit", F.col("matches.win").alias("wins"))
    matched = stored(matched, "matched")
    wins = matched.where("n_hit > 0").select("doc_id", F.explode("wins").alias("win")).distinct()
    by_doc = wins.join(windows, "win").select(F.col("doc_id").alias("of"), F.col("item_id").cast("string")).groupBy("of").agg(
        F.array_sort(F.collect_set("item_id")).alias("items"))
    none = F.array().cast("array<string>")
    return matched.join(by_doc, F.expr("doc_id <=> of"), "left").select(
        "doc_id", "n_words", "n_hit",
        F.when(F.col("n_hit") > 0, F.coalesce("items", none)).otherwise(none).alias("items"),
        _too_many().alias("contaminated"))


def proximity_matches(docs: DataFrame, items: DataFrame, slack: int = SLACK, size: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_near, items (sorted ids as strings); one row per row of ``docs``.

    Like ``contaminated``, for windows each of whose words lies at most ``slack``
    words off its place: a passage with a word put in or moved. Exact matches are
    among them. ``n_near`` counts the words where such windows lie.
    """
    windows = stored(benchmark_windows(items, size), "windows")
    matched = stored(_matched(docs.select("doc_id", "text"), windows, slack).select(
        F.col("row.doc_id").alias("doc_id"), "n_words", F.col("n_hit").alias("n_near"), F.col("matches.win").alias("wins")), "matched")
    wins = matched.select("doc_id", F.explode("wins").alias("win")).distinct()
    by_doc = wins.join(windows, "win").select(F.col("doc_id").alias("of"), F.col("item_id").cast("string")).groupBy("of").agg(
        F.array_sort(F.collect_set("item_id")).alias("items"))
    none = F.array().cast("array<string>")
    return matched.join(by_doc, F.expr("doc_id <=> of"), "left").select(
        "doc_id", "n_words", "n_near", F.when(F.size("wins") > 0, F.coalesce("items", none)).otherwise(none).alias("items"))


def _matched(docs: DataFrame, windows: DataFrame, slack: int = 0) -> DataFrame:
    rarest = stored(rarest_terms(docs, windows), "rarest")
    found = intersect(positional_index(docs, rarest), rarest, slack)
    return phrase_matches(docs, found, slack).withColumn("n_hit", hit_words(F.col("matches")))


def _too_many() -> Column:
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def drop_contaminated(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """Rows of ``docs`` that are not contaminated, columns as they are."""
    matched = _matched(docs, stored(benchmark_windows(items, size), "windows"))
    return matched.where(~_too_many()).select("row.*")
