"""Cell windows and range totals against plain windows."""

import random
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetlens.operators.features import build_features
from fleetlens.plans.cells import cell_of, event_parts, numbered, over_cells, trailing_rows
from fleetlens.plans.prefix import running_totals
from fleetlens.plans.whole import deviation, rounded


def _hot_rows(spark, n=600):
    rng = random.Random(3)
    rows = [("hot" if i % 3 else f"m{i % 7}", rng.randrange(-400, 400), i, float(rng.randrange(50))) for i in range(n)]
    df = spark.createDataFrame(rows, "machineid string, u long, id long, x double")
    return df.withColumn("cell", cell_of(F.col("u"), 16))


def test_cell_floors_before_1970(spark):
    cells = spark.createDataFrame([(-1,), (-16,), (0,), (15,)], "u long").select(cell_of(F.col("u"), 16).alias("c"))
    assert [r["c"] for r in cells.collect()] == [-16, -16, 0, 0]


def test_trailing_rows_cross_cells(spark):
    rows = _hot_rows(spark)

    def build(w):
        return [F.sum("x").over(w.rowsBetween(-2, 0)).alias("s"), F.count("x").over(w.rowsBetween(-2, 0)).alias("n")]

    got = trailing_rows(rows, ["u", "id"], 2, build).select("id", "s", "n")
    want = rows.select("id", *build(Window.partitionBy("machineid").orderBy("u", "id")))
    assert sorted(got.collect()) == sorted(want.collect())


def test_lag_crosses_cells(spark):
    rows = _hot_rows(spark)
    got = trailing_rows(rows, ["u", "id"], 1, lambda w: [F.lag("u").over(w).alias("p")]).select("id", "p")
    want = rows.select("id", F.lag("u").over(Window.partitionBy("machineid").orderBy("u", "id")).alias("p"))
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)


def test_numbered(spark):
    rows = _hot_rows(spark)
    got = numbered(rows, ["u", "id"], "n").select("id", "n")
    want = rows.select("id", F.row_number().over(Window.partitionBy("machineid").orderBy("u", "id")).alias("n"))
    assert sorted(got.collect()) == sorted(want.collect())


def test_running_totals_for_any_split(spark):
    rows = _hot_rows(spark).select("machineid", "id", "x")
    order = Window.partitionBy("machineid").orderBy("x", "id")
    want = sorted(rows.select(
        "id", F.sum("x").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("c"), F.lag("x").over(order).alias("p"),
    ).collect(), key=str)
    for splits in (1, 7, 256):
        got = running_totals(rows, {"v": F.col("x"), "id": F.col("id")}, ["x"], ["machineid"], splits, previous=True)
        assert sorted(got.select("id", "cum_x", "prev_v").collect(), key=str) == [tuple(r) for r in want]


def test_windows_over_cells(spark):
    """Against brute force: a hot, a rare and a null key, times before 1970, events between readings."""
    rng = random.Random(5)
    keys = ["hot", "hot", "hot", "rare", None]
    readings = sorted({(rng.choice(keys), rng.randrange(-200, 200)) for _ in range(260)}, key=str)
    happened = [(rng.choice(keys), rng.randrange(-200, 200)) for _ in range(60)]
    spine = spark.createDataFrame([(*r, 1, (i * 37) % 90 - 40 if i % 7 else None) for i, r in enumerate(readings)],
                                  "machineid string, u long, k long, x long")
    events = {"e": event_parts("e", spark.createDataFrame(happened, "machineid string, u long"), None)}
    got = over_cells(
        [spine], events, {"k": "sum", "e_n": "sum", "x": "min"},
        lambda w: [f"{w.back('e_n', 9)} AS b", f"{w.ahead('e_n', 7)} AS a", f"{w.total('e_n')} AS t", f"{w.total('e_n', strict=True)} AS s",
                   f"{w.last('e')} AS l", f"{w.last('e', strict=True)} AS m", f"{w.extreme('min', 'x', 5)} AS x"],
        carry=["e"], lookback=9, lookahead=7, cell=16)

    value = {(r["machineid"], r["u"]): r["x"] for r in spine.collect()}

    def expected(key, t):
        times = [u for k, u in happened if k == key]
        low = [x for (k, u), x in value.items() if k == key and t - 5 < u <= t and x is not None]
        return (key, t, sum(t - 9 < u <= t for u in times), sum(t < u <= t + 7 for u in times), sum(u <= t for u in times), sum(u < t for u in times),
                max((u for u in times if u <= t), default=None), max((u for u in times if u < t), default=None),
                Decimal(min(low)) / 10_000 if low else None)

    found = [tuple(r) for r in got.select("machineid", "u", "b", "a", "t", "s", "l", "m", "x").collect()]
    assert sorted(found, key=str) == sorted((expected(*r) for r in readings), key=str)


def test_one_window_operator_for_all_features(spark):
    """Only the carry rows still take a window operator; the rest is one array pass over sorted cells."""
    def table(columns):
        return spark.createDataFrame([], f"datetime timestamp_ntz, machineid string, {columns}")

    machines = spark.createDataFrame([], "machineid string, model string, age int")
    readings = table(", ".join(f"{c} decimal(8,4)" for c in ("volt", "rotate", "pressure", "vibration")))
    features = build_features(machines, readings, table("errorid string"), table("comp string"), table("failure string"))
    plan = features._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1 and plan.count("MapInArrow") == 1
    assert features.collect() == []


def test_rounding_is_that_of_decimals():
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.integers(-10**7, 10**7, 3000) / rng.integers(1, 40, 3000) / 10_000, np.arange(-300, 300) / 20_000,
                        np.arange(1, 400) / 10_000 + 0.00005 - 0.00000000005, [0.0, 9999.9999, 0.12345, 2.00005]])
    want = [int((Decimal(repr(float(v))).quantize(Decimal("1e-10"), ROUND_HALF_UP) * 10_000).quantize(Decimal(1), ROUND_HALF_UP)) for v in x]
    assert rounded(x).tolist() == want


def test_deviation_of_sums_beyond_64_bits():
    """Half the readings at the top, half at the bottom, so many that the products do not fit."""
    n, top = 200_000, 99_999_999
    sums = [np.array([v], dtype=np.int64) for v in (n, n // 2 * top, n // 2 * (top * top // 100_000_000), n // 2 * (top * top % 100_000_000))]
    assert deviation(*sums).to_pylist() == [Decimal("5000.0000")]
