"""Edges, leakage and hot machines."""

from datetime import datetime, timedelta
from decimal import Decimal

import pytest

from fleetlens.functions.columns import DAY
from fleetlens.operators import features as ft
from fleetlens.schemas import FEATURES

T0 = datetime(2024, 1, 10)


def at(hours):
    return T0 + timedelta(hours=hours)


def readings(spark, rows):
    rows = [(i, at(h), m, *[Decimal(str(v)) if v is not None else None] * 4) for i, (m, h, v) in enumerate(rows)]
    return spark.createDataFrame(
        rows, "id long, datetime timestamp_ntz, machineid string, volt decimal(8,4), rotate decimal(8,4),"
              " pressure decimal(8,4), vibration decimal(8,4)")


def events(spark, kind, rows):
    return spark.createDataFrame([(i, at(h), m, v) for i, (m, h, v) in enumerate(rows)],
                                 f"id long, datetime timestamp_ntz, machineid string, {kind} string")


def machines(spark):
    return spark.createDataFrame([("a", "model1", 2), ("b", "model2", 6)], "machineid string, model string, age int")


def fleet(spark, errors=(), maintenance=(), failures=()):
    return (events(spark, "errorid", errors), events(spark, "comp", maintenance), events(spark, "failure", failures))


def build(spark, telemetry, errors=(), maintenance=(), failures=(), **how):
    e, m, f = fleet(spark, errors, maintenance, failures)
    rows = ft.build_features(machines(spark), readings(spark, telemetry), e, m, f, **how).collect()
    return {(r["machineid"], r["observation_time"]): r for r in rows}


def test_lower_bound_is_exclusive_and_upper_inclusive(spark):
    out = build(spark, [("a", 0, 100), ("a", 3, 110), ("a", 12, 50), ("a", 27, 10)])
    assert out["a", at(3)]["voltage_mean_3h"] == Decimal("110.0000")
    assert out["a", at(3)]["voltage_mean_12h"] == Decimal("105.0000")
    assert out["a", at(12)]["voltage_mean_12h"] == Decimal("80.0000")
    assert out["a", at(27)]["voltage_mean_24h"] == Decimal("30.0000")
    assert out["a", at(3)]["voltage_std_12h"] == Decimal("5.0000")


def test_event_bounds(spark):
    out = build(spark, [("a", 0, 1), ("a", 24, 1), ("a", 25, 1)], errors=[("a", 0, "e1")], failures=[("a", 24, "c1")])
    assert [out["a", at(h)]["error_count_24h"] for h in (0, 24, 25)] == [1, 0, 0]
    assert out["a", at(25)]["hours_since_last_error"] == Decimal("25.00")
    assert [out["a", at(h)]["label"] for h in (0, 24, 25)] == [1, 0, 0]
    # A failure at t is history at t, not a label.
    assert [out["a", at(h)]["total_prior_failures"] for h in (0, 24, 25)] == [0, 1, 1]


def test_no_history_gives_null_recency_and_zero_counts(spark):
    row = build(spark, [("a", 0, 1)])["a", at(0)]
    assert row["hours_since_last_error"] is row["days_since_last_maintenance"] is row["days_since_last_failure"] is None
    assert (row["error_count_24h"], row["distinct_error_types"], row["component_diversity"]) == (0, 0, 0)


def test_copies_of_a_reading_multiply_plain_counts(spark):
    given = dict(telemetry=[("a", 5, 1), ("a", 5, 3)], errors=[("a", 4, "e1"), ("a", 5, "e2")], failures=[("a", 1, "c1")])
    row = build(spark, **given)["a", at(5)]
    assert (row["error_count_24h"], row["distinct_error_types"], row["total_prior_failures"]) == (4, 2, 2)
    assert row["voltage_mean_3h"] == Decimal("2.0000") and row["voltage_std_3h"] == Decimal("1.0000")
    row = build(spark, **given, dedupe=True)["a", at(5)]
    assert (row["error_count_24h"], row["total_prior_failures"]) == (2, 1)


def test_null_sensor_and_unknown_machine(spark):
    out = build(spark, [("z", 0, None), ("z", 1, 5), ("a", 0, 1)])
    assert out["z", at(0)]["voltage_mean_3h"] is None and out["z", at(0)]["voltage_std_3h"] is None
    assert out["z", at(1)]["voltage_mean_3h"] == Decimal("5.0000")
    assert out["z", at(1)]["model"] is None and out["z", at(1)]["age_category"] is None
    assert out["a", at(0)]["age_category"] == "new"


def test_constant_readings_have_no_spread(spark):
    out = build(spark, [("a", h, "123.4567") for h in range(30)])
    assert {r["voltage_std_24h"] for r in out.values()} == {Decimal("0.0000")}


def busy(spark, hours=240):
    """Machine a owns most rows, with repeated keys, gaps and events at reading times."""
    telemetry = [("a", h, 100 + h * 7 % 13) for h in range(hours) if h % 17] + [("a", h, 90) for h in range(0, hours, 5)]
    telemetry += [("b", h, 50 + h % 3) for h in range(0, hours, 31)]
    errors = [("a", h, f"e{h % 4}") for h in range(0, hours, 7)] + [("b", 3, "e1")]
    services = [("a", h, f"c{h % 3}") for h in range(11, hours, 60)]
    failures = [("a", h, f"c{h % 5}") for h in range(40, hours, 45)] + [("b", 100, "c1")]
    return telemetry, errors, services, failures


@pytest.mark.parametrize("cell", [DAY, 30 * DAY])
def test_cell_width_does_not_matter(spark, cell):
    given = busy(spark)
    assert build(spark, *given, cell=cell) == build(spark, *given)


def test_future_rows_change_no_feature(spark):
    """Only labels of the last 24 hours may react to what comes later."""
    telemetry, errors, services, failures = busy(spark)
    cut = 120
    past = [[e for e in rows if e[1] <= cut] for rows in (telemetry, errors, services, failures)]
    before, after = build(spark, *past), build(spark, telemetry, errors, services, failures)
    assert before and set(before) <= set(after)
    for key, row in before.items():
        assert all(row[c] == after[key][c] for c in FEATURES)
        if key[1] <= at(cut - 24):
            assert row["label"] == after[key]["label"]


def test_checks_of_a_feature_table(spark):
    e, m, f = fleet(spark, failures=[("a", 5, "c1")])
    table = ft.build_features(machines(spark), readings(spark, [("a", 0, 1), ("b", 1, None)]), e, m, f)
    assert ft.total_rows(table).first()["total_rows"] == 2
    assert {r["label"]: r["count"] for r in ft.class_balance(table).collect()} == {0: 1, 1: 1}
    assert ft.non_null_share(table).first()["pct_non_null"] == 50.0
    assert ft.time_range(table).first()["unique_machines"] == 2
