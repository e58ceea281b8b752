"""Queries op1 to op10 against their definitions, on test tables and on odd rows."""

from __future__ import annotations

from collections import Counter

import brute
import corpus_pipeline
import pytest
from conftest import SF_DIR

from fleetlens.llm import queries as q


@pytest.fixture(params=["tables", "odd rows"])
def folder(request, edge_dir):
    return SF_DIR if request.param == "tables" else edge_dir


def documents(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    return sorted(((r["doc_id"], r["text"]) for r in rows), key=lambda r: (r[0], r[1] or ""))


def rows(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


def test_op1(spark, folder):
    got = q.op1_quality_rules(spark, folder)
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert rows(got, *columns) == Counter((d, *brute.statistics(t)) for d, t in documents(spark, folder))
    assert got.where("base_failed and kept").isEmpty()


def test_op1_learns(spark):
    got = q.op1_quality_rules(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged = {(r["quality"], r["kept"]): r["count"] for r in got.where("not base_failed").join(labels, "doc_id").groupBy("quality", "kept").count().collect()}
    assert judged[0, False] > 20 * judged.get((0, True), 0)
    assert judged[1, True] > 100 * judged.get((1, False), 0)


def test_op2(spark, folder):
    want = Counter()
    for d, t in documents(spark, folder):
        spans = brute.base_spans(t)
        want[(d, *(sum(s[3] == k for s in spans) for k in brute.PII), brute.sha(",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)))] += 1
    got = q.op2_pii(spark, folder)
    assert rows(got, "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256") == want


def test_op3(spark, folder):
    got = q.op3_substring_dedup(spark, folder)
    assert rows(got, "doc_id", "n_words", "n_removed", "kept_sha256") == Counter(brute.without_repeats(documents(spark, folder)))


def test_op4(spark, folder):
    docs = documents(spark, folder)
    fps = [brute.fingerprint(t) for _, t in docs]
    groups = brute.near_groups(fps)
    first = {}
    for (d, _), g in zip(docs, groups):
        first[g] = min(d, first.get(g, d))
    want = Counter((d, f"{f:016x}", first[g]) for (d, _), f, g in zip(docs, fps, groups))
    assert rows(q.op4_simhash(spark, folder), "doc_id", "fingerprint", "component_id") == want


def test_op5(spark, folder):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    got = q.op5_decontamination(spark, folder)
    assert rows(got, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == Counter(
        brute.contamination(documents(spark, folder), items))


def _far(a, b):
    """Edit distance over words."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def _lines_gone(docs):
    """(doc_id, line number) of lines that are not the first of their group, by comparing all lines."""
    places = {}
    for d, t in docs:
        for no, line in enumerate((t or "").split("\n")):
            words = tuple(w for w in (v.strip(".,;:!?\"'()[]") for v in line.lower().split()) if w)
            if t is not None and any(c.isalnum() for w in words for c in w):
                places.setdefault(words, []).append((d, no))
    different = list(places)
    counts, group = [Counter(w) for w in different], list(range(len(different)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, a in enumerate(different):
        for j, b in enumerate(different[:i]):
            longest = max(len(a), len(b))
            room = longest // 5
            if abs(len(a) - len(b)) <= room and len(a) >= 5 and (counts[i] & counts[j]).total() >= longest - room and _far(a, b) <= room:
                group[root(i)] = root(j)
    members = {}
    for i, words in enumerate(different):
        members.setdefault(root(i), []).extend(places[words])
    return {at for of in members.values() for at in of if at != min(of)}


def test_op6(spark):
    docs = documents(spark, SF_DIR)
    want = _lines_gone(docs)
    gone = Counter(d for d, _ in want)
    got = {r["doc_id"]: r for r in q.op6_line_dedup(spark, SF_DIR).collect()}
    stage = {r["doc_id"]: r["text"] for r in corpus_pipeline.line_dedup(spark, spark.read.parquet(f"{SF_DIR}/documents.parquet"), SF_DIR).collect()}
    assert all(r["n_removed"] <= gone[d] for d, r in got.items())
    assert sum(r["n_removed"] for r in got.values()) >= 0.99 * len(want)
    for d, t in docs:
        if got[d]["n_removed"] == gone[d]:
            left = "\n".join(x for no, x in enumerate(t.split("\n")) if (d, no) not in want)
            assert got[d]["kept_sha256"] == brute.sha(left)
            assert stage.get(d) == left if left.strip() or not gone[d] else d not in stage


def test_op7(spark, folder):
    turns = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    odd = "\\### Assistant: </turn> ok"
    turns = [((-1 << 60) if t[0] is None else t[0], *t[1:]) for t in [*turns, (-7, 0, "user", odd), (-7, 1, "assistant", odd)]]
    got = {(-1 << 60) if r["conv_id"] is None else r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"])
           for r in q.op7_chat_format(spark, folder).collect()}
    assert got == brute.chats(turns)


def test_op8(spark, folder):
    docs = documents(spark, folder)
    got = {}
    for r in q.op8_packing(spark, folder).collect():
        assert r["length"] & (r["length"] - 1) == 0 and r["length"] <= 1024 and r["offset"] == 0
        got.setdefault(r["doc_id"], []).append(r)
    assert len({r["sequence_id"] for rs in got.values() for r in rs}) == sum(map(len, got.values()))
    assert set(got) == {d for d, _ in docs}
    for (d, _), ids in zip(docs, brute.token_ids("byte_bpe_50k.json", [t for _, t in docs], 0)):
        at = 0
        for r in sorted(got[d], key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids))
            assert r["ids_crc32"] == brute.crc(ids[at:at + r["length"]])
            at += r["length"]
        assert at == len(ids)


def test_op9(spark, folder):
    docs, want, start = documents(spark, folder), Counter(), 0
    for (d, _), ids in zip(docs, brute.token_ids("word_bpe_49k.json", [t for _, t in docs], 2)):
        want[d, start, len(ids), brute.crc(ids)] += 1
        start += len(ids)
    assert rows(q.op9_token_files(spark, folder), "doc_id", "start", "n_tokens", "ids_crc32") == want


def test_op10(spark):
    got = q.op10_language_id(spark, SF_DIR).collect()
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    held = [r for r in got if r["held_out"]]
    assert held and sum(r["lang_pred"] == langs[r["doc_id"]] for r in held) >= 0.95 * len(held)


def test_op10_odd_rows(spark, edge_dir):
    got = {r["doc_id"]: r for r in q.op10_language_id(spark, edge_dir).collect()}
    for d, t in documents(spark, edge_dir):
        known = any(c.isalpha() for c in t or "")
        assert (got[d]["lang_pred"] in ("en", "de")) == known and 0 <= got[d]["score"] <= 1


@pytest.mark.parametrize("name", sorted(q.queries()))
def test_empty_tables(spark, empty_dir, name):
    assert q.queries()[name](spark, empty_dir).count() == (name == "op7_chat_format")


def test_pipeline(spark, edge_dir, empty_dir):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_duplicates", "decontamination", "packing"]
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        done = stage(spark, docs, edge_dir)
        assert done.dtypes == docs.dtypes
        assert done.select("doc_id").subtract(docs.select("doc_id")).isEmpty()
    assert corpus_pipeline.run(spark, edge_dir).count() > 0
    assert corpus_pipeline.run(spark, empty_dir).count() == 0
