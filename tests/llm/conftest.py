from __future__ import annotations

import random

import pytest

SF_DIR = "/root/testdata/sf0.001"
EMBEDDINGS = "vec_id long, embedding array<float>"
TURNS = "conv_id long, turn long, role string, text string"


def _edge_documents():
    """Nulls, empty and very long texts, ties, repeated rows and odd characters."""
    rng = random.Random(5)
    vocabulary = [f"{a}{b}" for a in "bcdfgklmnprst" for b in ("a", "en", "or", "ist", "um", "ück", "été")]

    def prose(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    passage, shared = prose(60), prose(25)
    long = "\n".join(prose(300) for _ in range(12)) + " " + prose(6000)
    texts = [
        None, "", " \t\n\x0b\f\r ", "one", "one two", "One TWO", "...", passage, passage, passage.upper(),
        passage + "\n" + prose(80), prose(40) + " " + passage, f"{prose(30)} {shared} {prose(30)}", f"{shared} {prose(50)}",
        "ab " * 200, "x" * 5000, "1 2 3 4-5 " * 800, "a@b.c_d@e.f x@y z@" + "w." * 2000 + "w", "1.2.3.4.5.6.7.8 999.1.1.1 001.02.3.4",
        "card 4111 1111 1111 1111, 4111-1111-1111-1112; +1 (555) 010-9999. +49.30.123456-78",
        long, long + " end", "don't we're 'S ªº µ ß x   ý İΣ ς <|endoftext|> \U0001f600 e\x1cf", prose(70) + " ### | $$ %",
        "\n".join([prose(9)] * 4 + ["", prose(8), ""]),
    ]
    rows = [(i * 7 % 101, t) for i, t in enumerate(texts)]
    near = passage.split()
    near[30] = "changed"
    return [*rows, (500, " ".join(near)), (501, passage + " tail"), (2**40, passage)]


@pytest.fixture(scope="session")
def edge_rows():
    return _edge_documents()


@pytest.fixture(scope="session")
def edge_dir(spark, edge_rows, tmp_path_factory):
    """Tables as a folder; documents have extra columns named like the operators' own."""
    folder = str(tmp_path_factory.mktemp("edge"))
    docs = spark.createDataFrame(
        [(d, t, ["en", "de", None][i % 3], "s", len(t or ""), i, "x", 1.5, True) for i, (d, t) in enumerate(edge_rows)],
        "doc_id long, text string, lang string, source string, n_chars long, n_words int, label string, bucket double, kept boolean")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(d, i % 2, 0) for i, (d, _) in enumerate(edge_rows)] + [(None, 1, 0), (7, None, 0)],
                          "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    words = (edge_rows[7][1] or "").split()
    spark.createDataFrame([(1, " ".join(words[5:40])), (2, " ".join(words[5:40]).upper()), (3, None), (4, "?!"), (5, "one two"),
                           (10, " ".join(words[:14]))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    turns = [(1, 0, "system", "Be # <brief> \\h"), (1, 1, "user", None), (1, 2, "assistant", ""), (2, 5, None, "x"), (2, 5, None, "x"),
             (2, 5, "assistant", "</turn>\n### user: hi"), (3, None, "assistant", "\\l\\\\b:"), (None, 0, "assistant", "a"),
             *((4, i, ("user", "assistant")[i % 2], f"turn {i} " + "word " * (i % 50)) for i in range(600)),
             (5, 0, "assistant", "long " * 3000), (5, 1, "assistant", "b"), (6, 0, "a:b", "colon")]
    spark.createDataFrame(turns, TURNS).write.parquet(f"{folder}/conversations.parquet")
    spark.createDataFrame([(1, [0.5] * 64), (1, [0.5] * 64), (None, [-0.25] * 64), (3, None), (4, [1.0]), (5, [float("nan")] * 64)],
                          EMBEDDINGS).write.parquet(f"{folder}/embeddings.parquet")
    return folder


@pytest.fixture(scope="session")
def empty_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    for name, schema in {"documents": "doc_id long, text string, lang string, source string, n_chars long",
                         "labels": "doc_id long, quality int, toxic int", "benchmark": "item_id long, text string",
                         "conversations": TURNS, "embeddings": EMBEDDINGS}.items():
        spark.createDataFrame([], schema).write.parquet(f"{folder}/{name}.parquet")
    return folder
