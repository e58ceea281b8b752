"""Small column helpers shared by all operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOUR = 3_600_000_000
DAY = 24 * HOUR


def rnd(x: Column, digits: int) -> Column:
    """Round half away from zero after fixing ten decimals.

    Going through a decimal first makes the result independent of the last
    bits of a double, so sums taken in another order round alike.
    """
    return F.round(x.cast("decimal(20,10)"), digits)


def rnd_sql(x: str, digits: int) -> str:
    """``rnd`` as SQL text."""
    return f"round(CAST({x} AS DECIMAL(20,10)), {digits})"


def num_sql(x: str, digits: int) -> str:
    return f"CAST({rnd_sql(x, digits)} AS DOUBLE)"


def num(x: Column, digits: int) -> Column:
    """``rnd`` as a double, for query results."""
    return rnd(x, digits).cast("double")


def pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """Share of ``whole`` in percent, null when there is no whole."""
    return num(100.0 * part / F.nullif(whole, F.lit(0)), digits)


def micros(ts: Column) -> Column:
    """Zone-less timestamp as epoch microseconds."""
    return F.unix_micros(ts.cast("timestamp"))


def from_micros(us: Column) -> Column:
    return F.timestamp_micros(us).cast("timestamp_ntz")


def month(ts: Column) -> Column:
    return F.date_trunc("month", ts).cast("timestamp_ntz")


def plain(df: DataFrame) -> DataFrame:
    """Decimal columns as doubles, everything else unchanged."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if f.dataType.typeName() == "decimal"
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def key_hash(*cols: Column, seed: int = 42) -> Column:
    """Well-mixed 52-bit number of a row key.

    Built on md5 so that any SQL engine can reproduce a split or a sample.
    """
    digest = F.md5(F.concat_ws("|", *[c.cast("string") for c in cols], F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint")
