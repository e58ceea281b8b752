"""Personal data: fixed patterns, and contexts learned from what they find.

The base patterns find e-mail addresses, IP addresses, card and phone numbers.
What they find seeds a graph between lexical patterns (the one or two words
before an entity) and instances (the entity's text). Scores go round between
the two: a pattern is as good as the share of its occurrences in the corpus
that lead to a known instance, an instance as good as the patterns it follows.
Identifier-like tokens that base patterns miss are reported where a
high-confidence pattern leads to them.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.shared import stored

# Kinds and their patterns, in the order in which equal starts
# are listed. Possessive quantifiers and the look at the character before keep
# the matches of the plain patterns and make long runs linear: inside a run
# that failed no later start can match.
_MAIL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_MAIL})){_MAIL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without this can't hold the kind.
_NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"

#: Identifier-like tokens: with a digit, of 6 to 64 characters.
TOKEN = r"(?<!\S)(?=[^\s0-9]{0,63}[0-9])\S{6,64}(?!\S)"
MARKS = ".,;:!?\"'()[]<>"

#: A pattern needs so many different known instances, ...
MIN_SUPPORT = 3
#: ... so large a share of its occurrences leading to one, ...
MIN_PRECISION = 0.6
#: ... and an instance so high a score to count as known.
MIN_SCORE = 0.8
#: Patterns up to which they are broadcast for counting (some 50 bytes each).
BROADCAST_PATTERNS = 200_000


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def step(total: Column, i: Column) -> Column:
        d = F.substr(digits, F.length(digits) - i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    digits = _digits(value)
    return {
        "email": F.lit(True),
        "ip": value.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"),
        "card": F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False),
        "phone": F.length(digits).between(10, 15),
    }[kind]


def _check(kind: str):
    return lambda match: _valid(kind, match["value"])


def _matches(text: Column, pattern: str) -> Column:
    """Matches of a pattern: start, end (code points), value, left (two words before).

    The text between matches gives their places.
    """
    found, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    begin = F.struct(F.lit(0).alias("at"), F.array().cast(
        "array<struct<start:int,end:int,value:string,left:array<string>>>").alias("out"))

    def step(acc: Column, pair: Column) -> Column:
        start = acc["at"] + F.length(pair["gap"])
        end = start + F.length(pair["value"])
        before = F.array_remove(F.split(F.lower(F.right(pair["gap"], F.lit(80))), r"\s+"), "")
        left = F.slice(before, F.greatest(F.lit(1), F.size(before) - 1), 2)
        return F.struct(end.alias("at"), F.array_append(acc["out"], F.struct(
            start.alias("start"), end.alias("end"), pair["value"].alias("value"), left.alias("left"))).alias("out"))

    pairs = F.zip_with(F.slice(between, 1, F.size(found)), found, lambda gap, value: F.struct(
        gap.alias("gap"), value.alias("value")))
    return F.when(F.size(found) > 0, F.aggregate(pairs, begin, step, lambda acc: acc["out"])).otherwise(
        F.array().cast("array<struct<start:int,end:int,value:string,left:array<string>>>"))


_SPAN = "struct<start:int,rank:int,end:int,kind:string,value:string,left:array<string>>"


def _spans(kind: str, rank: int, matches: Column) -> Column:
    return F.transform(matches, lambda m: F.struct(
        m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end"), F.lit(kind).alias("kind"),
        m["value"].alias("value"), m["left"].alias("left")))


def base_entities(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with ``base``: valid matches of all kinds by start, then kind, and ``others``.

    ``others`` are identifier-like tokens that overlap no valid match.
    """
    held = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    none = F.array().cast(f"array<{_SPAN}>")
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        possible = F.contains("text", F.lit(_NEEDS[kind])) & (F.lit(kind == "email") | F.col("text").rlike("[0-9]"))
        spans = _spans(kind, rank, F.filter(_matches(F.col("text"), pattern), _check(kind)))
        held = held.withColumn(kind, F.when(possible, spans).otherwise(none))
    held = held.withColumn("base", F.array_sort(F.concat(*PATTERNS)))
    tokens = F.when(F.col("text").rlike("[0-9]"), _spans("token", len(PATTERNS), _matches(F.col("text"), TOKEN))).otherwise(none)
    return held.withColumn("others", F.filter(tokens, lambda t: ~F.exists(
        "base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"]))))


def _contexts(left: Column) -> Column:
    """Patterns of a context: its last word, and its last two."""
    return F.when(F.size(left) == 2, F.array(F.get(left, F.lit(1)), F.array_join(left, " "))).otherwise(left)


def graph(found: DataFrame) -> DataFrame:
    """pattern, instance, kind (null for other tokens): occurrences of entities behind their contexts."""
    spans = found.select(F.explode(F.concat("base", "others")).alias("s"))
    value = F.lower(F.btrim("s.value", F.lit(MARKS)))
    return spans.select(
        F.explode(_contexts(F.col("s.left"))).alias("pattern"), value.alias("instance"),
        F.when(F.col("s.kind") != "token", F.col("s.kind")).alias("kind"))


def pattern_totals(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """pattern, total: how often each stands before any word at all."""
    w = F.array_remove(F.split(F.lower("text"), r"\s+"), "")
    ahead = F.slice(F.col("w"), 1, F.greatest(F.lit(0), F.size("w") - 1))
    pairs = F.zip_with(F.slice(ahead, 1, F.greatest(F.lit(0), F.size(ahead) - 1)), F.slice(ahead, 2, F.greatest(F.lit(0), F.size(ahead) - 1)),
                       lambda a, b: F.concat_ws(" ", a, b))
    n = patterns.count()
    wanted = F.broadcast(patterns) if n <= BROADCAST_PATTERNS else patterns
    seen = docs.where("text is not null").select(w.alias("w")).select(F.explode(F.concat(ahead, pairs)).alias("pattern"))
    return seen.join(wanted, "pattern").groupBy("pattern").agg(F.count("*").alias("total"))


def learn_patterns(docs: DataFrame, found: DataFrame) -> DataFrame:
    """pattern, kind, precision: contexts that lead to personal data with confidence, as a stored table.

    Pattern and instance scores are renewed in turn until no instance becomes
    known. Patterns with fewer than MIN_SUPPORT
    different instances can never qualify and are not counted.
    """
    edges = stored(graph(found).groupBy("pattern", "instance", "kind").agg(F.count("*").alias("n")), "edges")
    wide = edges.groupBy("pattern").agg(F.count_distinct("instance").alias("m")).where(F.col("m") >= MIN_SUPPORT)
    totals = stored(pattern_totals(docs, stored(wide.select("pattern"), "patterns")), "totals")
    edges = stored(edges.join(totals, "pattern"), "edges")
    # An instance of a base kind is known from the start and stays so.
    known = stored(edges.where("kind is not null").select("instance", "kind").distinct(), "known")
    n_known = known.count()
    while True:  # ends: known instances only grow, and are those of the edges
        patterns = stored(
            edges.drop("kind").join(known, "instance").groupBy("pattern", "kind").agg(
                (F.sum("n") / F.first("total")).alias("precision"), F.count_distinct("instance").alias("support"))
            .where((F.col("support") >= MIN_SUPPORT) & (F.col("precision") >= MIN_PRECISION)), "scores")
        doubt = F.sum(F.log(F.greatest(F.lit(1e-9), 1 - F.col("precision"))))
        scored = edges.where("kind is null").select("pattern", "instance").distinct().join(patterns, "pattern").groupBy(
            "instance", "kind").agg((1 - F.exp(doubt)).alias("score"))
        known = stored(known.union(scored.where(F.col("score") >= MIN_SCORE).select("instance", "kind")).distinct(), "known")
        now = known.count()
        if now == n_known:
            break
        n_known = now
    return patterns.select("pattern", "kind", "precision")


def find(docs: DataFrame) -> DataFrame:
    """doc_id, base, spans (arrays of start, rank, end, kind, value, left) for every row of ``docs``.

    ``spans`` holds all base spans and those found by context, whose kind is
    ``found_`` and the kind they look like; both are ordered by start, then by
    the order of kinds, found ones last. Offsets are code points, ends
    exclusive. A null text counts as empty and has none; repeated rows are
    searched each; other columns are ignored; an empty table gives no rows.
    """
    found = stored(base_entities(docs).withColumn("row", F.monotonically_increasing_id()).drop("text"), "entities")
    patterns = learn_patterns(docs, found)
    tokens = found.select("row", F.explode("others").alias("s")).withColumn("pattern", F.explode(_contexts(F.col("s.left"))))
    scored = tokens.join(patterns, "pattern").groupBy("row", "s", "kind").agg(
        (1 - F.exp(F.sum(F.log(F.greatest(F.lit(1e-9), 1 - F.col("precision")))))).alias("score"))
    kinds = F.array(*[F.lit(k) for k in PATTERNS])
    best = scored.where(F.col("score") >= MIN_SCORE).groupBy("row", "s").agg(F.max_by("kind", F.struct("score", "kind")).alias("kind"))
    more = best.select("row", F.struct(
        F.col("s.start").alias("start"), (F.lit(len(PATTERNS)) + F.array_position(kinds, F.col("kind")).cast("int")).alias("rank"),
        F.col("s.end").alias("end"), F.concat(F.lit("found_"), "kind").alias("kind"), F.col("s.value").alias("value"),
        F.col("s.left").alias("left")).alias("span")).groupBy("row").agg(F.collect_list("span").alias("more"))
    return found.join(more, "row", "left").select("doc_id", "base", F.array_sort(F.concat(
        "base", F.coalesce("more", F.array().cast(f"array<{_SPAN}>")))).alias("spans"))


def is_kind(kind: str):
    return lambda found: found == kind


def written(spans: Column) -> Column:
    """kind:start:end of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
