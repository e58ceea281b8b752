"""What the queries' digests do not show: texts, files, windows, links, rules."""

from __future__ import annotations

import math
import random

import brute
import corpus_pipeline
import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
from conftest import SF_DIR, TURNS
from pyspark.sql import functions as F

from fleetlens.llm import chat, decontaminate, langid, lines, packing, pii, quality, shared, simhash, substrings, tokenfiles
from fleetlens.llm.components import components

DOCS = "doc_id long, text string"


def test_rules_are_learned_and_readable():
    n = 600
    bad = np.arange(n) % 5 == 0
    rows = pd.DataFrame({f: np.linspace(0, 1, n) for f in quality.FEATURES})
    rows["symbol_rate"] = np.where(bad, 0.5, 0.0) + np.linspace(0, 0.01, n)
    rows = rows.assign(quality=np.where(bad, 0, 1), part=np.arange(n) // 5 % 3)
    rules = quality.learn_rules(rows)
    assert [r.conditions[0].feature for r in rules] == ["symbol_rate"] and rules[0].precision == 1
    assert "symbol_rate > 0." in str(rules[0])
    assert quality.learn_rules(rows.assign(quality=1)) == []


def test_good_rows_keep_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "word " * 3, 5, "a"), (2, " ".join(f"w{i}" for i in range(80)), 6, None)],
                                 DOCS + ", n_words int, row string")
    kept = quality.keep_good(docs, [])
    assert kept.dtypes == docs.dtypes and [r["doc_id"] for r in kept.collect()] == [2]


def test_contexts_discover_what_patterns_miss(spark):
    known = [(i, f"Please contact mail user{i}@example.org today, thanks.") for i in range(30)]
    unseen = [(100, "Please contact mail jane77(at)example today."), (101, "Order part jane88(at)example today.")]
    spans = {r["doc_id"]: r["spans"] for r in pii.find(spark.createDataFrame(known + unseen, DOCS)).collect()}
    found = [s for s in spans[100] if s["kind"] == "found_email"]
    assert len(found) == 1 and unseen[0][1][found[0]["start"]:found[0]["end"]] == "jane77(at)example"
    assert spans[101] == [] and all([s["kind"] for s in spans[i]] == ["email"] for i in range(30))


def test_repeats_are_maximal_runs(spark):
    words = [f"w{i}" for i in range(100)]
    rows = [(1, " ".join(words)), (2, " ".join(["a", *words[10:50], "b", *words[60:79]])), (3, " ".join(words[30:50]))]
    got = {r["doc_id"]: r for r in substrings.remove_repeats(spark.createDataFrame(rows, DOCS)).collect()}
    assert got[1]["repeats"] == [] and [tuple(x) for x in got[2]["repeats"]] == [(1, 41)]
    assert got[2]["text"].split() == ["a", "b", *words[60:79]] and got[3]["text"] == ""


def test_dense_families_are_one_group(spark):
    fps = [0b1011 << 20] + [(0b1011 << 20) ^ (1 << a) ^ (1 << b) for a in range(0, 60, 4) for b in range(a + 1, 64, 9)]
    frame = spark.createDataFrame([(f if f < 1 << 63 else f - (1 << 64),) for f in set(fps)] + [(-1,)], "fp long")
    labels = components(simhash.fingerprint_links(frame)).collect()
    assert len(labels) == len(set(fps)) and len({r["label"] for r in labels}) == 1


def test_crowded_routes_are_split(monkeypatch):
    rng = np.random.default_rng(3)
    fps = np.unique(np.concatenate([rng.integers(0, 1 << 62, 60, dtype=np.uint64), np.uint64(7) ^ (np.uint64(1) << np.arange(60, dtype=np.uint64))]))
    used = np.zeros(len(fps), dtype=np.int64)

    def groups(a, b):
        label = {int(f): int(f) for f in fps}
        for _ in range(len(fps)):
            for x, y in zip(a.tolist(), b.tolist()):
                label[x] = label[y] = min(label[x], label[y])
        return label

    whole = groups(*simhash._joined(fps, used, 0, 0))
    monkeypatch.setattr(simhash, "_AT_ONCE", 8)
    assert groups(*simhash._joined(fps, used, 0, 0)) == whole


def test_one_row_of_each_group_stays(spark):
    text = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(3, text, 1), (2, text, 2), (2, text, 2), (9, "other words entirely here", 3), (None, "alone", 4)],
                                 DOCS + ", label int")
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0, r["label"]) for r in kept.collect()) == [(0, 4), (2, 2), (9, 3)]


def test_contexts_are_followed_to_the_end(spark):
    # Behind each context stand instances of the one before, and the next ones once.
    texts = [f"see ctx0 user{i}@example.org end" for i in range(16)]
    for k in range(1, 7):
        for i in range(4):
            texts += [f"see ctx{k - 1} token{k}x{i} end"] + [f"see ctx{k} token{k}x{i} end"] * 5
    found = pii.find(spark.createDataFrame(list(enumerate(texts)), DOCS)).select(F.explode("spans").alias("s")).select("s.kind", "s.value").collect()
    assert {r["value"] for r in found if r["kind"] == "found_email"} == {f"token{k}x{i}" for k in range(1, 7) for i in range(4)}


def test_proximity_matches(spark):
    phrase = [f"term{i}" for i in range(13)]
    docs = spark.createDataFrame([(1, " ".join(phrase)), (2, " ".join([*phrase[:6], "extra", *phrase[6:]])), (3, "term1 term2")], DOCS)
    items = spark.createDataFrame([(1, " ".join(phrase))], "item_id long, text string")
    windows = decontaminate.benchmark_windows(items)
    # Terms 0, 5 and 12 stand for the rarest; with a word more between, the last is a place off.
    far = decontaminate.rarest_terms(docs, windows).withColumn("place", F.expr("array(0, 5, 12)[rank - 1]"))
    far = far.withColumn("term", F.concat(F.lit("term"), "place"))
    index = decontaminate.positional_index(docs, far)
    assert {r["doc_id"] for r in decontaminate.intersect(index, far).collect()} == {1}
    assert {r["doc_id"] for r in decontaminate.intersect(index, far, slack=1).collect()} == {1, 2}


def test_proximity_matches_are_checked_word_by_word(spark):
    phrase = [f"term{i}" for i in range(40)]
    every = [w for i, t in enumerate(phrase) for w in ([t, "extra"] if i % 12 == 5 else [t])]
    loose = [t if i % 6 in (0, 3) else f"other{i}" for i, t in enumerate(phrase)]
    rest = [f"own{i}" for i in range(20)]
    docs = spark.createDataFrame([(1, " ".join(phrase + rest)), (2, " ".join(every + rest)), (3, " ".join(loose)), (4, None),
                                  (5, " ".join(["extra", *phrase[1:14]]))], DOCS)
    items = spark.createDataFrame([(7, " ".join(phrase))], "item_id long, text string")
    got = {r["doc_id"]: r for r in decontaminate.proximity_matches(docs, items).collect()}
    assert {d for d, r in got.items() if r["items"] == ["7"]} == {1, 2, 5} and got[3]["n_near"] == got[4]["n_near"] == 0
    assert got[1]["n_near"] >= 40 and got[2]["n_near"] > 20
    exact = {r["doc_id"]: r["n_hit"] for r in decontaminate.contaminated(docs, items).collect()}
    assert exact == {1: 40, 2: 0, 3: 0, 4: 0, 5: 13}


def _edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_line_groups_are_complete(spark):
    held = lines.distinct_lines(spark.read.parquet(f"{SF_DIR}/documents.parquet"))
    rows = held.collect()
    fps = np.array([r["fp"] for r in rows], dtype=np.int64).view(np.uint64)
    group = list(range(len(rows)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    blocks = [np.uint64(m) for m in lines._blocks()]
    for i in range(len(rows)):
        agree = sum(((fps[:i] ^ fps[i]) & m == 0).astype(int) for m in blocks)
        for j in np.flatnonzero(agree >= lines.BLOCKS - lines.RADIUS):
            a, b = rows[i]["sig"], rows[j]["sig"]
            longest = max(len(a), len(b))
            if _edits(a, b) <= longest - math.ceil(longest * lines.SIMILARITY - 1e-9):
                group[root(i)] = root(int(j))
    label = {r["node"]: r["label"] for r in components(lines.line_links(held)).collect()}
    got, want = {}, {}
    for i, r in enumerate(rows):
        got.setdefault(label.get(r["key"], r["key"]), set()).add(i)
        want.setdefault(root(i), set()).add(i)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_changed_lines_are_found(spark):
    # Lines with 5, 10 and 20 % of their words changed; none of the operator's own constants.
    rng, rows, kind = random.Random(11), [], {}
    for n in (5, 8, 10, 20, 22, 24, 50, 200):
        for part in (1 / n, 0.1, 0.2):
            for _ in range(20):
                line = [f"v{rng.randrange(5000)}" for _ in range(n)]
                other = list(line)
                for at in rng.sample(range(n), max(1, int(part * n + 1e-9))):
                    other[at] = f"new{rng.randrange(10**6)}"
                kind[len(rows) // 2] = part == 0.2
                rows += [(len(rows), " ".join(line)), (len(rows) + 1, " ".join(other))]
    gone = {r["doc_id"] for r in lines.repeated_lines(spark.createDataFrame(rows, DOCS)).collect()}
    assert all(d % 2 for d in gone)
    for at_limit, floor in ((False, 0.97), (True, 0.9)):
        pairs = [k for k, v in kind.items() if v == at_limit]
        assert sum(2 * k + 1 in gone for k in pairs) >= floor * len(pairs)


def test_equal_lines_of_all_kinds_go(spark):
    kinds = ["a1\tb2\tc3\td4\te5\tf6", "Read more here", "Home page", "この文章は何度も出てくる",
             "สวัสดีชาวโลก", "n1\u00a0n2\u3000n3\u2003n4 n5", "one, two; three (four) five!"]
    again = [*kinds[:-1], "One two three four five"]
    docs = spark.createDataFrame([(1, "\n".join(kinds)), (2, "\n".join(["", *again, "---", "own"])), (3, "\n---\nown")], DOCS)
    got = {r["doc_id"]: r["text"] for r in lines.dedupe_lines(docs).collect()}
    assert got == {1: "\n".join(kinds), 2: "\n---\nown", 3: "\n---"}


def test_long_lines_of_any_kind_are_cut(spark):
    for words, blank in (([f"w{i}" for i in range(9000)], "\t"), ([chr(0x4e00 + i * 7919 % 20000) for i in range(9000)], "")):
        line = blank.join(words)
        docs = spark.createDataFrame([(1, line), (2, line), (3, blank.join([*words[:4096], *(f"x{i} " for i in range(20))]))], DOCS)
        got = {r["doc_id"]: r for r in lines.dedupe_lines(docs).collect()}
        assert got[1]["text"] == line and got[2]["text"] == "" and got[2]["n_removed"] == 3
        assert got[3]["n_removed"] == 1 and got[3]["text"].startswith("x0 ")


def test_words_of_one_code_differ(spark):
    # Words that share a signature's character, in lines with two of five (three of ten) words unlike.
    named = spark.range(200_000).select(F.concat(F.lit("w"), "id").alias("w")).withColumn("code", F.expr("pmod(xxhash64(w), 1920)"))
    same = [sorted(r["ws"]) for r in named.groupBy("code").agg(F.collect_list("w").alias("ws")).limit(12).collect()]
    rows = []
    for n, unlike in ((5, 2), (10, 3)):
        line = [ws[0] for ws in same[:n]]
        rows += [" ".join(line), " ".join([ws[1] for ws in same[:unlike]] + line[unlike:]), " ".join([same[0][1], *line[1:]])]
    gone = lines.repeated_lines(spark.createDataFrame(list(enumerate(rows)), DOCS)).collect()
    # The third line is 0.8 like both; alone, the first two are not alike.
    alone = lines.repeated_lines(spark.createDataFrame([(i, rows[i]) for i in (0, 1, 3, 4)], DOCS)).collect()
    assert {r["doc_id"] for r in gone} == {1, 2, 4, 5} and not alone


def test_lines_keep_their_first_occurrence(spark):
    long = " ".join(f"w{i}" for i in range(2 * lines.PART_WORDS + 10))
    rows = [(2, "One two three four five six\nshort\nown words of this very line"), (1, "head\none two THREE four five six\nshort"),
            (3, None), (4, ""), (5, "One two three four five six"), (6, long), (7, long + " tail")]
    docs = spark.createDataFrame([(*r, 7) for r in rows], DOCS + ", no int")
    got = {r["doc_id"]: r for r in lines.dedupe_lines(docs).collect()}
    assert got[1]["text"] == rows[1][1] and got[2]["text"] == "own words of this very line"
    assert got[3]["text"] is None and got[4]["text"] == "" and got[5]["text"] == "" and got[5]["no"] == 7
    assert got[6]["text"] == long and got[7]["text"] == "" and got[7]["n_removed"] == 3  # the rests share ten of eleven words


def test_chat_windows(spark):
    turns = [(1, 0, "system", "be brief")] + [(1, i, ("assistant", "user")[i % 2], "some words here " * 40) for i in range(1, 30)]
    got = chat.windows(spark.createDataFrame(turns, TURNS), budget=600, history=150).orderBy("high", "low", "window").collect()
    assert len(got) > 5 and all(w["tokens"] <= 600 and not w["over_budget"] for w in got)
    assert all(w["text"].startswith("### system: be brief</turn>\n") for w in got)
    assert got[0]["n_repeated"] == 0 and all(w["n_repeated"] == 2 for w in got[1:])
    for w in got:
        masked = [w["text"][s["start"]:s["start"] + s["length"]] for s in w["loss"]]
        assert all(m == "some words here " * 40 for m in masked)
    assert sum(len(w["loss"]) for w in got) == 14


def test_chat_history_goes_over_block_edges(spark):
    # 600 turns number by number, and one turn in each block of numbers.
    turns = [(c, i * step, ("user", "assistant")[i % 2] if i else "system", f"turn {i} of words")
             for c, step, n in ((1, 1, 600), (2, 300, 12)) for i in range(n)]
    got = chat.windows(spark.createDataFrame(turns, TURNS), budget=60, history=12).orderBy("conv_id", "high", "low", "window").collect()
    done = {}
    for w in got:
        numbers = [int(t.split()[3]) for t in w["text"].split("</turn>\n")[:-1]]
        first = done.get(w["conv_id"], 0)
        want = list(range(max(0, first - 3), first))
        want = want if want[:1] == [0] or not first else [0, *want]
        assert numbers[:w["n_repeated"]] == want and numbers[w["n_repeated"]] == first
        done[w["conv_id"]] = numbers[-1] + 1
    assert done == {1: 600, 2: 12} and not any(w["over_budget"] for w in got)


def test_binary_lengths_and_buckets(spark, tmp_path):
    assert packing.binary_lengths(612, 1024) == [512, 64, 32, 4] and packing.binary_lengths(2049, 1024) == [1024, 1024, 1]
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([], DOCS), "", size=1000)
    packed = packing.pack(spark.read.parquet(f"{SF_DIR}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
    packing.write_buckets(packed, f"{tmp_path}/buckets")
    assert spark.read.parquet(f"{tmp_path}/buckets").where("octet_length(ids) <> 4 * bucket").isEmpty()


def test_packing_of_long_runs(spark):
    """Runs that exhaust a pattern's stack or a slow merge; the pipeline's stage packs them as well."""
    texts = [" " * 2_000_000, "a\n" + "\n" * 2_000_000 + "b", "x" * 2_000_000, " \t" * 1_000_000 + "y", "once more"]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], DOCS + ", lang string, source string, n_chars long")
    packed = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
    counts = {r["doc_id"]: r["n"] for r in packed.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert counts == {i: len(ids) for i, ids in enumerate(brute.token_ids("byte_bpe_50k.json", texts, 0))}
    assert corpus_pipeline.pack(spark, docs, SF_DIR).agg(F.sum("length")).first()[0] == sum(counts.values())


def test_pieces_give_the_ids_of_whole_texts():
    rng = random.Random(8)
    own = shared.ByteTokens(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["".join(rng.choice(["a", " ", "\n", "'s", "1", ".", "é", "\u3000", "\x1c", "\u0301", "\t", "\xa0", "\u200b", "\x85", "<|endoftext|>", "Zap", ",", "ß"])
                     for _ in range(40)) for _ in range(400)]
    texts += [t.translate(str.maketrans("", "", "\u3000\t\xa0\x85")) for t in texts]
    for text, ids in zip(texts, brute.token_ids("byte_bpe_50k.json", texts, 0)):
        assert own.encode([text])[0] == ids[:-1].tobytes()


def test_token_files_are_mapped(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    manifest = tokenfiles.write_token_files(docs, public_tokenizers.path("word_bpe_49k.json"), f"{tmp_path}/tokens", length=128)
    before = pa.total_allocated_bytes()
    for r in manifest.collect():
        table = tokenfiles.sequences(r["path"])
        assert pa.total_allocated_bytes() - before < 1 << 16  # mapped, not read
        assert table.schema.field("ids").type == pa.list_(pa.uint16(), 128)
        assert sum(map(sum, table.column("mask").to_pylist())) == r["n_tokens"]
        assert len(table.column("docs").combine_chunks().flatten()) == r["n_docs"]


def test_cached_pieces_give_the_library_s_ids(monkeypatch):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    texts = ["", " a  b ", "a§.b c.§ d", "x\xady .z", "Don't STOP. 12 a,b.c ..", "ΟΔΟΣ. İx é.", "tab\tin, it\n\nend"] * 2
    monkeypatch.setattr(shared, "CACHE_PIECES", 3)
    cached = shared.WordTokens(path)
    for text in texts:
        assert np.frombuffer(cached.encode([text])[0], dtype="<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_language_of_nothing(spark):
    model = langid.train(spark.createDataFrame([(1, "abc", None)], DOCS + ", lang string"))
    rows = langid.predict(spark.createDataFrame([(1, "words"), (2, None)], DOCS), model).collect()
    assert [(r["lang_pred"], r["score"]) for r in rows] == [("und", 0.0)] * 2
