"""op11 to op13: queries and operators against plain re-implementations."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter

import brute
import duckdb
import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from compare import mismatch
from conftest import SF_DIR, TURNS

from fleetlens.llm import bytebpe, clustering, langid, repair
from fleetlens.llm import queries as q
from fleetlens.llm import shared
from fleetlens.llm.oracle import oracle_sql

VECTORS = "vec_id long, embedding array<double>"


def _plain_lloyd(rows, k, rounds):
    """[(vec_id, whole numbers)] -> [(vec_id, cluster, distance)], centroids."""
    order = sorted(rows, key=lambda r: (hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]) if r[0] is not None else ("~", r[1]))
    centroids = [list(x) for _, x in order[:k]]

    def near(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), i) for i, c in enumerate(centroids))

    for _ in range(rounds):
        chosen = [near(x)[1] for _, x in rows]
        for c in range(len(centroids)):
            own = [x for (_, x), i in zip(rows, chosen) if i == c]
            if own:
                centroids[c] = [sum(column) // len(own) for column in zip(*own)]
    return sorted((str(v), near(x)[1], near(x)[0]) for v, x in rows), centroids


def _clustered(spark, vectors, **options):
    found, centroids = clustering.cluster(vectors, **options)
    return sorted((str(r["vec_id"]), r["cluster"], r["distance"]) for r in found.collect()), centroids.tolist()


def test_op11_is_exact_lloyd(spark):
    vectors = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    rows = [(r["vec_id"], [math.floor(1024 * x) for x in r["embedding"]]) for r in vectors.collect()]
    assert _clustered(spark, vectors) == _plain_lloyd(rows, 8, 10)


@pytest.mark.parametrize("dimensions, rounds, scale", [(3, 4, 1), (70, 3, 16)])
def test_clusters_of_odd_vectors(spark, monkeypatch, dimensions, rounds, scale):
    # Ties, repeated and null ids, equal vectors, huge components, several blocks and shards.
    rng = random.Random(dimensions)
    monkeypatch.setattr(clustering, "BLOCK_ROWS", 16)
    plain = [[rng.randrange(-3, 4) for _ in range(dimensions)] for _ in range(60)]
    huge = [[float(rng.randrange(-(1 << 60), 1 << 60)) for _ in range(dimensions)] for _ in range(3)] if dimensions == 3 else []
    rows = [(i % 50 if i % 9 else None, [float(x) for x in v]) for i, v in enumerate(plain + plain[:5] + huge)]
    bad = [(900, None), (901, [1.0] * (dimensions - 1)), (902, [math.nan] * dimensions), (903, [math.inf] * dimensions), (904, [None] * dimensions)]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows + bad], VECTORS + ", block int, cluster string").repartition(5)
    got, centroids = _clustered(spark, frame, k=5, rounds=rounds, dimensions=dimensions, scale=scale)
    want, plain_centroids = _plain_lloyd([(v, [math.floor(scale * x) for x in e]) for v, e in rows], 5, rounds)
    assert got == sorted((v, c, min(d, (1 << 63) - 1)) for v, c, d in want) and centroids == plain_centroids


def test_fewer_vectors_than_centroids(spark):
    frame = spark.createDataFrame([(1, [1.0] * 64), (2, [2.0] * 64)], VECTORS)
    rows = clustering.with_inertia(*clustering.cluster(frame)).collect()
    assert len({r["cluster"] for r in rows}) == 2 and all(r["inertia"] == 0 for r in rows)
    assert clustering.with_inertia(*clustering.cluster(frame.limit(0))).count() == 0


def _all_audits(rows):
    """Least (cost, audit, turns) by trying every string of edits: [(role, text, fault)]."""
    def legal(roles):
        rest = roles[1:] if roles[:1] == "s" else roles
        return not roles or (rest and rest == "ua" * (len(rest) // 2))

    best = None
    gaps = ["", "I", "II"]
    for inserts in itertools.product(gaps, repeat=len(rows) + 1):
        for edits in itertools.product("KRD", repeat=len(rows)):
            if any(e != "D" and f in ("blank", "duplicate") for e, (_, _, f) in zip(edits, rows)):
                continue
            cost = sum(map(len, inserts)) * 3 + sum({"K": 0, "R": 3, "D": 4}[e] + 3 * (e != "D" and f == "truncated") for e, (_, _, f) in zip(edits, rows))
            audit = "".join(i + e for i, e in zip(inserts, edits)) + inserts[-1]
            if best and (cost, audit) >= best[:2]:
                continue
            slots = []
            for i, e, (role, text, _) in zip(inserts, edits, rows):
                slots += ["?:"] * len(i) + ([f"{role}:{text}"] if e == "K" else [f"?:{text}"] if e == "R" else [])
            slots += ["?:"] * len(inserts[-1])
            start = 1 if slots and slots[0][0] == "s" else 0
            turns = [s if s[0] != "?" else ("user", "assistant")[(n - start) % 2] + s[1:] for n, s in enumerate(slots)]
            if legal("".join(t[0] for t in turns)):
                best = (cost, audit, turns)
    return best


def _fault(text, seen):
    held = text.strip(" \t\n\v\f\r")
    return "blank" if not held else "duplicate" if seen else "truncated" if held[-1] not in ".!?" else ""


def test_cheapest_repair_against_all_edits(spark):
    rng, turns, want = random.Random(4), [], {}
    for conv in range(120):
        rows, seen = [], set()
        for turn in range(rng.randrange(1, 5)):
            role = rng.choice(["user", "assistant", "system", "user", "assistant", "other", "ua:x"])
            text = rng.choice(["Yes.", "No", " ", f"t{turn}!", "Yes."])
            turns.append((conv, turn, role, text))
            rows.append((role, text, _fault(text, (role, text) in seen)))
            seen.add((role, text))
        cost, audit, said = _all_audits(rows)
        want[conv] = cost, audit, brute.sha("\n".join(said))
    frame = spark.createDataFrame(turns, TURNS)
    got = {r["conv_id"]: (r["cost"], r["audit"], r["repaired_sha256"]) for r in repair.summaries(frame).collect()}
    assert got == want
    edits = {}
    for r in sorted(repair.repaired(frame).collect(), key=lambda r: (r["conv_id"], r["place"])):
        edits.setdefault(r["conv_id"], []).append(r)
    for conv, (_, audit, digest) in want.items():
        assert "".join(r["edit"] for r in edits[conv]) == audit
        assert brute.sha("\n".join(f"{r['role']}:{r['text']}" for r in edits[conv] if r["edit"] != "D")) == digest


def _plain_viterbi(rows):
    """Like the operator, with whole strings for histories: [(initial, fault)] -> (cost, audit)."""
    held = {0: (0, "")}
    for initial, fault in rows:
        new = {}
        for before, to, cost, edits in repair.steps(initial, fault):
            if before in held:
                offer = (held[before][0] + cost, held[before][1] + edits)
                new[to] = min(offer, new.get(to, offer))
        held = new
    ends = {0: "", 1: "II", 2: "I", 3: ""}
    return min((c + 3 * len(ends[s]), a + ends[s]) for s, (c, a) in held.items())


@pytest.mark.parametrize("roles", ["ua", "uuuuuua", "x", "sux", "uaX"])
def test_survivors_emit_early_and_agree_with_whole_strings(roles):
    rng = random.Random(len(roles))
    for n in (1, 2, 7, 300):
        rows = [(rng.choice(roles), rng.choice(["", "", "", "truncated", "blank"])) for _ in range(n)]
        if roles == "ua":  # an ordinary conversation with a few faults
            rows = [("ua"[i % 2], "blank" if i % 17 == 3 else "") for i in range(n)]
        search, done, most = repair.Search(), b"", 0
        for row in rows:
            done += search.add(*row)[0]
            most = max(most, search.tree.open_edits())
        cost, state, last = search.end()
        assert (cost, (done + search.tree.rest(state)).decode() + last) == _plain_viterbi(rows)
        assert roles != "ua" or most < 24  # its survivors soon share their history


def test_op12_on_odd_rows(spark, edge_dir, empty_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{edge_dir}/conversations.parquet/*.parquet' ")
    assert mismatch(q.op12_conversation_repair(spark, edge_dir), con, oracle_sql()["op12_conversation_repair"]) is None


def test_op12_damage(spark):
    rows = [(c, t, "assistant", "One. Two! Three") for c in range(40) for t in (0, 1, None)] + [(None, 0, None, None)]
    got = {}
    for r in repair.damaged(spark.createDataFrame(rows, TURNS)).collect():
        got.setdefault((r["conv_id"], r["turn"]), []).append((r["present"], r["role"], r["text"]))
    for c, t, _, _ in rows:
        hit = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = ("assistant", "One. Two! Three") if c is not None else (" ", " ")
        want = [(hit != 0, "user" if hit == 4 else role, "" if hit == 1 else text.translate(str.maketrans("", "", ".!?")) if hit == 2 else text)]
        assert got[c, t] == want * (2 if hit == 3 else 1)


def test_op13(spark, edge_dir):
    ranks = bytebpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for folder in (SF_DIR, edge_dir):
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        want = sorted((r["doc_id"], len(ids := library.encode_ordinary(r["text"] or "")), brute.sha(" ".join(map(str, ids))), brute.sha(r["text"] or ""))
                      for r in docs.collect())
        assert sorted(tuple(r) for r in q.op13_byte_bpe(spark, folder).collect()) == want


def test_pre_tokens_of_long_texts_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(bytebpe, "PIECE_CHARS", 7)
    own, whole = bytebpe.PreTokens(public_tokenizers.PATTERN), regex.compile(public_tokenizers.PATTERN)
    rng = random.Random(2)
    for _ in range(300):
        text = "".join(rng.choice(["a", " ", "\n", "'s", "1", ".", "é", "　", "\x1c", "́"]) for _ in range(60))
        assert [w for part in own.pieces(text) for w in part] == whole.findall(text)
    monkeypatch.undo()
    monkeypatch.setattr(bytebpe, "CHUNK_CHARS", 50)
    long = [(1, " " * 2_000_000), (2, "x" * 300_000 + "\n" * 1_500_000 + " y"), (None, "a b"), (4, None), (4, "a b"), (5, "b a " * 40)]
    encoded = bytebpe.encode(spark.createDataFrame(long, "doc_id long, text string").coalesce(1), *q.BYTE_RANKS)
    back = bytebpe.decode(encoded, q.BYTE_RANKS[0]).collect()
    assert sorted((r["doc_id"] or 0, bytes(r["bytes"]).decode()) for r in back) == sorted((d or 0, t or "") for d, t in long)
    odd = spark.createDataFrame([(1, [0, None, 10**6, -5, 1]), (2, None), (3, [])], "doc_id long, ids array<int>")
    assert [bytes(r["bytes"]) for r in bytebpe.decode(odd, q.BYTE_RANKS[0]).orderBy("doc_id").collect()] == [b'!"', b"", b""]


def test_packed_numbers():
    for numbers in ([], [0], [0, 1, 255], [256, 70000, 1], [1 << 31, 5]):
        assert bytebpe._unpacked(bytebpe._packed(np.array(numbers, dtype=np.int64))).tolist() == numbers


def _plain_columns(text):
    """Hashed runs of two and three characters, with whole numbers of Python."""
    mask, shift = (1 << 64) - 1, 64 - (langid.COLUMNS.bit_length() - 1)
    c = [32, *(ord(x) if x.isalpha() else 32 for x in text.lower()), 32, 32]
    for i in range(len(c) - 1):
        if c[i] == 32 and c[i + 1] == 32:
            continue
        pair = (c[i] * 0x9E3779B97F4A7C15 + c[i + 1] * 0xC2B2AE3D27D4EB4F) & mask
        values = [pair]
        if i + 2 < len(c):
            values.append((pair + c[i + 2] * 0x165667B19E3779F9) * 0xD6E8FEB86659FD93 & mask)
        for v in values:
            yield ((v ^ v >> 29) * 0xBF58476D1CE4E5B9 & mask) >> shift


def test_op10_is_naive_bayes(spark, edge_dir):
    """Labels and scores against counting in plain Python."""
    for folder in (SF_DIR, edge_dir):
        docs = [(r["doc_id"], r["text"], r["lang"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
        train = [(t, lang) for d, t, lang in docs if t is not None and lang is not None and zlib.crc32(str(d).encode()) % 4 != 2]
        counts = {lang: Counter() for lang in sorted({lang for _, lang in train})}
        for t, lang in train:
            counts[lang].update(_plain_columns(t))
        prior = Counter(lang for _, lang in train)
        smooth = langid.SMOOTHING
        whole = {lang: sum(n.values()) + smooth * langid.COLUMNS for lang, n in counts.items()}
        got = {(r["doc_id"], r["lang_pred"]): r["score"] for r in q.op10_language_id(spark, folder).collect()}
        for d, t, _ in docs:
            if not any(x.isalpha() for x in t or ""):
                assert got[d, "und"] == 0
                continue
            columns = Counter(_plain_columns(t))
            score = {lang: math.log(prior[lang] / len(train)) + sum(k * math.log((n[c] + smooth) / whole[lang]) for c, k in columns.items())
                     for lang, n in counts.items()}
            best = max(score, key=score.get)
            share = 1 / sum(math.exp(max(-700.0, s - score[best])) for s in score.values())
            assert got[d, best] == pytest.approx(share, abs=2e-3)


def test_a_stored_frame_leaves_no_shuffle_files(spark):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}

    before = shuffled()
    rows = spark.range(20_000).groupBy("id").count()
    table = shared.stored(rows, "counted")
    assert not shuffled() - before and table.count() == 20_000 == rows.count()
    assert spark.conf.get(shared.DROP_SHUFFLES) == "false"
