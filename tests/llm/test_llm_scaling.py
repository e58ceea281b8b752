"""Work of training-data operators that must not grow with partitions or with the square of a group."""

from __future__ import annotations

import random

from pyspark import RDD

from fleetlens.llm import clustering, lines


def _tasks(spark, work) -> int:
    """Tasks that ``work`` ran."""
    sc = spark.sparkContext
    sc.setJobGroup("counted", "counted")
    try:
        work()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    sc._jsc.sc().listenerBus().waitUntilEmpty()
    tracker = sc.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup("counted") for s in tracker.getJobInfo(j).stageIds}
    return sum(info.numCompletedTasks for s in stages if (info := tracker.getStageInfo(s)))


def test_clustering_starts_no_tasks_for_empty_partitions(spark, monkeypatch):
    dealt, many = RDD.partitionBy, 40
    monkeypatch.setattr(RDD, "partitionBy", lambda self, n, *more: dealt(self, max(n, many), *more))
    rng = random.Random(1)
    frame = spark.createDataFrame([(i, [rng.random() for _ in range(64)]) for i in range(30)], "vec_id long, embedding array<double>").coalesce(1)
    rounds = 4
    # Once a round the reduce of distances; the rest by column blocks, of which there are two.
    assert _tasks(spark, lambda: clustering.cluster(frame, rounds=rounds)) < many * (rounds + 3)


def test_lines_of_an_unlike_first_member_are_not_all_paired(spark, monkeypatch):
    # Near copies whose group's first member may be unlike them, and unlike lines that share four words.
    rng = random.Random(4)
    base = [f"w{rng.randrange(10**6)}" for _ in range(24)]
    near = [" ".join(base[:i % 24] + [f"x{i}"] + base[i % 24 + 1:]) for i in range(60)]
    unlike = [" ".join(base[:4] + [f"y{rng.randrange(10**9)}" for _ in range(20)]) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(near + unlike)), "doc_id long, text string")
    sizes = []
    keep = lines.stored
    monkeypatch.setattr(lines, "stored", lambda df, what, *more: _counted(keep(df, what, *more), what, sizes))
    gone = {r["doc_id"] for r in lines.repeated_lines(docs).collect()}
    assert gone == set(range(1, 60))  # the first near copy and all unlike lines stay
    # Before: one pair for each two of the lines that are not linked with their first.
    assert sum(n for what, n in sizes if what == "pairs") < 120


def _counted(df, what, sizes):
    sizes.append((what, df.count()))
    return df
