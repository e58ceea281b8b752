"""The five base tables, derived from the star-schema test parquet.

Every row of ``supplier`` is a machine and every row of ``events`` a reading;
events of some types are also errors, services or failures. Times are cut to
the hour, which yields readings on window edges, events at reading times and
repeated (machine, time) keys. Three neighbouring users share one machine, so
some machines have no readings and some readings have no machine.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from fleetlens.session import configure

# ``{S}`` is the engine's name for the text type.
TABLE_SQL = {
    "machines": """
        SELECT CAST(s_suppkey AS {S}) AS machineid,
               CONCAT('model', CAST(s_nationkey % 4 + 1 AS {S})) AS model,
               CAST(s_suppkey % 21 AS INT) AS age
        FROM supplier""",
    "telemetry": """
        SELECT event_id AS id, {HOUR} AS datetime,
               CAST(user_id - user_id % 3 AS {S}) AS machineid,
               CASE WHEN event_id % 97 = 0 THEN NULL
                    ELSE CAST(150 + value / 10.0 AS DECIMAL(8,4)) END AS volt,
               CAST(400 + (event_id * 37 % 1000) / 10.0 AS DECIMAL(8,4)) AS rotate,
               CAST(90 + (event_id * 53 % 200) / 10.0 AS DECIMAL(8,4)) AS pressure,
               CAST(35 + (event_id * 71 % 150) / 10.0 AS DECIMAL(8,4)) AS vibration
        FROM events""",
    "errors": """
        SELECT event_id AS id, {HOUR} AS datetime,
               CAST(user_id - user_id % 3 AS {S}) AS machineid,
               CONCAT('error', CAST(event_id % 5 + 1 AS {S})) AS errorid
        FROM events WHERE event_type = 'error'""",
    "maintenance": """
        SELECT event_id AS id, {HOUR} AS datetime,
               CAST(user_id - user_id % 3 AS {S}) AS machineid,
               CONCAT('comp', CAST(event_id % 4 + 1 AS {S})) AS comp
        FROM events WHERE event_type = 'signup'""",
    "failures": """
        SELECT event_id AS id, {HOUR} AS datetime,
               CAST(user_id - user_id % 3 AS {S}) AS machineid,
               CONCAT('comp', CAST(event_id % 4 + 1 AS {S})) AS failure
        FROM events WHERE event_type = 'purchase' AND value > 100""",
    # A score and a label per event, for metrics without a trained model.
    "scored": """
        SELECT event_id, event_type,
               LEAST(0.99, ROUND(value * 100, 0) / 20000.0) AS score,
               CASE WHEN event_id * 7919 % 500 < value THEN 1 ELSE 0 END AS label
        FROM events""",
    "requests": """
        SELECT event_id, ts, event_type AS handler, value AS latency_ms,
               CASE WHEN user_id % 20 = 0 THEN 500 ELSE 200 END AS status
        FROM events""",
    # Feature values as observed (first half of the month: training baseline) ...
    "baseline": """
        SELECT event_id, {K} AS k, CAST(value AS DOUBLE) AS value, event_type,
               CAST(event_id % 20 AS DOUBLE) AS age, CAST(1 AS DOUBLE) AS flat
        FROM events WHERE ts < {HALF}""",
    # ... and as logged with predictions: one feature shifted, one never logged,
    # one constant and moved. Drift compares the second half of the month.
    "prediction_log": """
        SELECT event_id, ts,
               CONCAT('{{"k": ', CAST(CAST({K} * 1.5 AS DECIMAL(12,2)) AS {S}),
                      ', "value": ', CAST(CAST(value AS DECIMAL(12,2)) AS {S}), ', "flat": 2',
                      ', "event_type": "', event_type, '"}}') AS features
        FROM events""",
    # Untidy text as it would land from CSV.
    "staging_machines": """
        SELECT CONCAT(' ', CAST(s_suppkey AS {S}), ' ') AS machineid,
               CASE WHEN s_suppkey % 9 = 4 THEN NULL
                    ELSE CONCAT('model', CAST(s_nationkey % 4 + 1 AS {S}), ' ') END AS model,
               CONCAT(' ', CAST(s_suppkey % 21 AS {S})) AS age
        FROM supplier""",
    "staging_telemetry": """
        SELECT CAST({HOUR} AS {S}) AS datetime,
               CASE WHEN event_id % 211 = 0 THEN NULL
                    ELSE CONCAT(' ', CAST(user_id - user_id % 3 AS {S}), ' ') END AS machineid,
               CASE WHEN event_id % 97 = 0 THEN ' '
                    ELSE CONCAT(CAST(CAST(150 + value / 10.0 AS DECIMAL(8,4)) AS {S}), ' ') END AS volt,
               CONCAT(' ', CAST(CAST(400 + (event_id * 37 % 1000) / 10.0 AS DECIMAL(8,4)) AS {S})) AS rotate,
               CASE WHEN event_id % 89 = 0 THEN ''
                    ELSE CAST(CAST(90 + (event_id * 53 % 200) / 10.0 AS DECIMAL(8,4)) AS {S}) END AS pressure,
               CAST(CAST(35 + (event_id * 71 % 150) / 10.0 AS DECIMAL(8,4)) AS {S}) AS vibration
        FROM events""",
    "staging_errors": """
        SELECT CONCAT(CAST({HOUR} AS {S}), ' ') AS datetime,
               CASE WHEN event_id % 211 = 0 THEN NULL
                    ELSE CONCAT(' ', CAST(user_id - user_id % 3 AS {S})) END AS machineid,
               CASE WHEN event_id % 83 = 0 THEN NULL
                    ELSE CONCAT(' error', CAST(event_id % 5 + 1 AS {S})) END AS errorid
        FROM events WHERE event_type = 'error'""",
    "staging_maintenance": """
        SELECT CONCAT(' ', CAST({HOUR} AS {S})) AS datetime,
               CONCAT(CAST(user_id - user_id % 3 AS {S}), ' ') AS machineid,
               CASE WHEN event_id % 83 = 0 THEN NULL
                    ELSE CONCAT('comp', CAST(event_id % 4 + 1 AS {S}), ' ') END AS comp
        FROM events WHERE event_type = 'signup'""",
    "staging_failures": """
        SELECT CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST({HOUR} AS {S}) END AS datetime,
               CASE WHEN event_id % 11 = 0 THEN ' '
                    ELSE CAST(user_id - user_id % 3 AS {S}) END AS machineid,
               CONCAT('comp', CAST(event_id % 4 + 1 AS {S})) AS failure
        FROM events WHERE event_type = 'purchase' AND value > 100""",
}

# Staging text in which some values cannot be read: words, impossible dates, numbers out of range.
_SPOILT = {
    "machines": ["machineid", "model", "CASE WHEN age LIKE '%3' THEN CONCAT(age, ' years') ELSE age END AS age"],
    "telemetry": ["CASE WHEN datetime LIKE '%13:00:00%' THEN 'soon' ELSE datetime END AS datetime", "machineid", "volt",
                  "CASE WHEN rotate LIKE '%7000' THEN CONCAT(rotate, 'x') ELSE rotate END AS rotate",
                  "CASE WHEN pressure LIKE '101%' THEN '123456.7' ELSE pressure END AS pressure", "vibration"],
    "errors": ["CASE WHEN datetime LIKE '%-07 %' THEN '2024-13-45 00:00:00' ELSE datetime END AS datetime", "machineid", "errorid"],
    "maintenance": ["CASE WHEN datetime LIKE '% 05:00:00%' THEN '' ELSE datetime END AS datetime", "machineid", "comp"],
    "failures": ["datetime", "machineid", "CASE WHEN failure = 'comp3' THEN NULL ELSE failure END AS failure"],
}
TABLE_SQL |= {f"spoilt_{name}": f"SELECT {', '.join(columns)} FROM ({TABLE_SQL[f'staging_{name}']}) s"
              for name, columns in _SPOILT.items()}
# Log rows as batches send them; some ids come again and some rows break a rule.
TABLE_SQL["log_rows"] = """
        SELECT event_id AS prediction_id, ts AS predicted_at, CAST(user_id - user_id % 3 AS {S}) AS machineid,
               CAST(value / 400.0 AS DOUBLE) AS failure_probability, CAST(event_id % 2 AS INT) AS predicted_label
        FROM events"""


def duck_sql(table: str) -> str:
    """The same mapping in DuckDB's dialect, as a parenthesised subquery."""
    return "(" + TABLE_SQL[table].format(
        S="VARCHAR", HOUR="date_trunc('hour', ts)", HALF="TIMESTAMP '2024-01-16 00:00:00'",
        K="CAST(json_extract_string(props, '$.k') AS DOUBLE)",
    ) + ")"


@dataclass(frozen=True)
class Fleet:
    """Base tables of one test-data folder."""

    spark: SparkSession
    sf_dir: str

    def parquet(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def stream(self, name: str, **options) -> DataFrame:
        """A table derived from ``events``, as its files arrive."""
        events = self.spark.readStream.schema(self.parquet("events").schema).options(**options)
        events.parquet(f"{self.sf_dir}/events.parque[t]").createOrReplaceTempView("fixture_arriving")  # a file or a folder of files
        return self.spark.sql(self._sql(name).replace("FROM events", "FROM fixture_arriving"))

    def _sql(self, name: str) -> str:
        return TABLE_SQL[name].format(
            S="STRING", HOUR="CAST(date_trunc('hour', ts) AS TIMESTAMP_NTZ)",
            HALF="TIMESTAMP_NTZ '2024-01-16 00:00:00'",
            K="CAST(get_json_object(props, '$.k') AS DOUBLE)",
        )

    def table(self, name: str) -> DataFrame:
        sql = self._sql(name)
        source = "supplier" if "FROM supplier" in sql else "events"
        self.parquet(source).createOrReplaceTempView(f"fixture_{source}")
        return self.spark.sql(sql.replace(f"FROM {source}", f"FROM fixture_{source}"))

    @property
    def machines(self) -> DataFrame:
        return self.table("machines")

    @property
    def telemetry(self) -> DataFrame:
        return self.table("telemetry")

    @property
    def errors(self) -> DataFrame:
        return self.table("errors")

    @property
    def maintenance(self) -> DataFrame:
        return self.table("maintenance")

    @property
    def failures(self) -> DataFrame:
        return self.table("failures")

    @property
    def scored(self) -> DataFrame:
        return self.table("scored")

    @property
    def requests(self) -> DataFrame:
        return self.table("requests")


def fleet(spark: SparkSession, sf_dir: str) -> Fleet:
    return Fleet(configure(spark), sf_dir)
