"""Run tracking as append-only tables: metrics, parameters and artifacts of every run.

A run logs a few dozen values on the driver; they become rows when the run ends. Reports over all
runs are ordinary queries.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

METRICS_SCHEMA = (
    "run_id STRING, run_seq INT, phase STRING, metric STRING, value DOUBLE, status STRING, recorded_at TIMESTAMP_NTZ"
)
PARAMS_SCHEMA = "run_id STRING, run_seq INT, name STRING, value STRING"
ARTIFACTS_SCHEMA = (
    "run_id STRING, run_seq INT, layer STRING, name STRING, path STRING, row_count BIGINT, column_count INT, "
    "columns STRING, size_mb DOUBLE"
)
RUN = "RUN"


class RunLog:
    """Collects what one run reports; ``save`` appends it to the three run tables."""

    def __init__(self, run_seq: int, run_id: str | None = None):
        self.run_seq = run_seq
        self.run_id = run_id or uuid.uuid4().hex
        self.errors: list[dict[str, str]] = []
        self.status = "INITIALIZED"
        self.started = time.time()
        self._metrics: list[tuple] = []
        self._params: list[tuple] = []
        self._artifacts: list[tuple] = []

    def metrics(self, phase: str, values: Mapping[str, object], status: str = "SUCCESS") -> None:
        """Record the numbers among the values under the phase."""
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        for name, value in values.items():
            if isinstance(value, (int, float)) and not isinstance(value, bool):
                self._metrics.append((self.run_id, self.run_seq, phase, name, float(value), status, now))

    def value(self, phase: str, name: str) -> float:
        """The last value recorded for a metric of this run."""
        return next(m[4] for m in reversed(self._metrics) if m[2:4] == (phase, name))

    def params(self, values: Mapping[str, object]) -> None:
        self._params += [(self.run_id, self.run_seq, name, str(value)) for name, value in values.items()]

    def artifact(
        self, layer: str, name: str, path: str, row_count: int, columns: Sequence[str], size_mb: float | None = None
    ) -> None:
        self._artifacts.append(
            (self.run_id, self.run_seq, layer, name, path, int(row_count), len(columns), ",".join(columns), size_mb)
        )

    @contextmanager
    def phase(self, name: str) -> Iterator[dict]:
        """Time a phase. Numbers put into the yielded dict are recorded with duration and throughput
        (``row_count`` per second); an error is recorded with what there is by then, and raised again."""
        values: dict = {}
        start = time.time()
        self.status = "RUNNING"
        try:
            yield values
        except Exception as error:
            self.status = "FAILED"
            self.errors.append({"phase": name, "error": str(error)})
            self.metrics(name, {"row_count": 0, **values, "duration_seconds": time.time() - start}, "FAILED")
            raise
        seconds = time.time() - start
        rows = values.get("row_count")
        if rows is not None:
            values["records_per_second"] = rows / seconds if seconds > 0 else 0.0
        self.metrics(name, {**values, "duration_seconds": seconds})

    def finish(self, status: str = "SUCCESS") -> None:
        self.status = status
        self.metrics(RUN, {"duration_seconds": time.time() - self.started, "errors": len(self.errors)}, status)
        self.params({"final_status": status})
        self._params += [(self.run_id, self.run_seq, "error", f"{e['phase']}: {e['error']}") for e in self.errors]

    def save(self, spark: SparkSession, path: str) -> None:
        """Append to the run tables, side by side: each is one small file."""
        tables = [
            ("run_metrics", METRICS_SCHEMA, self._metrics),
            ("run_params", PARAMS_SCHEMA, self._params),
            ("run_artifacts", ARTIFACTS_SCHEMA, self._artifacts),
        ]

        def append(table: str, schema: str, rows: list[tuple]) -> None:
            types = dict(column.split() for column in schema.split(", "))
            cells = pa.table([list(column) for column in zip(*rows)], names=list(types))
            frame = spark.createDataFrame(cells).select(*[F.col(c).cast(t).alias(c) for c, t in types.items()])
            frame.coalesce(1).write.mode("append").parquet(f"{path.rstrip('/')}/{table}")

        task = inheritable_thread_target(spark)(lambda table: append(*table))
        with ThreadPoolExecutor(max_workers=len(tables)) as pool:
            list(pool.map(task, [t for t in tables if t[2]]))


def quality_metrics(report: DataFrame, layer: str, run_id: str, run_seq: int) -> DataFrame:
    """A quality report in the layout of the metrics table, ready to append."""
    return report.where(F.col("value").isNotNull()).select(
        F.lit(run_id).alias("run_id"),
        F.lit(run_seq).alias("run_seq"),
        F.lit(f"QUALITY_{layer.upper()}").alias("phase"),
        F.concat_ws("_", "subject", "metric").alias("metric"),
        "value",
        "status",
        F.lit(None).cast("timestamp_ntz").alias("recorded_at"),
    )


def _key() -> Column:
    return F.concat_ws("_", F.lower("phase"), "metric")


def phase_metrics(metrics: DataFrame) -> DataFrame:
    """One row per run and metric; the metric's key starts with the phase."""
    return metrics.select("run_seq", _key().alias("metric_key"), "value", "status")


def throughput(metrics: DataFrame) -> DataFrame:
    """Rows per second of every phase that reports rows; 0 when it took no time. Reruns count once."""
    metrics = latest_runs(metrics)
    value = {m: F.max(F.when(F.col("metric") == m, F.col("value"))) for m in ("row_count", "duration_seconds")}
    per_phase = metrics.groupBy("run_id", "run_seq", "phase").agg(*[c.alias(m) for m, c in value.items()])
    rate = F.try_divide(F.col("row_count"), F.col("duration_seconds"))
    return per_phase.where(F.col("row_count").isNotNull()).withColumn(
        "records_per_second", F.coalesce(rate, F.lit(0.0))
    )


def latest_runs(metrics: DataFrame) -> DataFrame:
    """The metrics of the latest run of every sequence number: tables of a rerun replace the earlier ones."""
    ends = metrics.groupBy("run_seq", "run_id").agg(F.max("recorded_at").alias("at"))
    latest = ends.groupBy("run_seq").agg(F.max(F.struct("at", "run_id"))["run_id"].alias("run_id"))
    return metrics.join(latest.select("run_id"), "run_id", "left_semi")


def of_latest_runs(rows: DataFrame, metrics: DataFrame) -> DataFrame:
    """Rows of another run table that belong to the latest run of every sequence number."""
    return rows.join(latest_runs(metrics).select("run_id").distinct(), "run_id", "left_semi")


def run_report(
    metrics: DataFrame, keys: Sequence[str], params: DataFrame | None = None, names: Sequence[str] = ()
) -> DataFrame:
    """One row per run, one column per metric key, with the run's own status (quality checks have theirs).

    The keys are given, so that pivoting needs no job of its own to find them; the same goes for the ``names`` of
    parameters, which follow as columns where ``params`` is given. A rerun replaces the run before it.
    """
    metrics = latest_runs(metrics)
    status = F.max(F.when(F.col("phase") == RUN, F.col("status"))).over(Window.partitionBy("run_id"))
    report = (
        metrics.withColumns({"metric_key": _key(), "status": status})
        .groupBy("run_id", "run_seq", "status")
        .pivot("metric_key", list(keys))
        .agg(F.max("value"))
    )
    if params is None:
        return report
    shown = params.groupBy("run_id").pivot("name", list(names)).agg(F.max("value"))
    return report.join(shown, "run_id", "left")


def failed_phases(metrics: DataFrame) -> DataFrame:
    """Phases that failed, the run itself left out, with the rows they are recorded with."""
    failed = metrics.where((F.col("status") == "FAILED") & (F.col("phase") != RUN) & (F.col("metric") == "row_count"))
    return failed.select("run_id", "run_seq", "phase", "status", F.col("value").cast("bigint").alias("row_count"))


def run_delta(metrics: DataFrame) -> DataFrame:
    """Every metric beside its value in the run before, per metric, with the change.

    Reruns count once, and a failed run is never the run before.
    """
    failed = F.max((F.col("phase") == RUN) & (F.col("status") == "FAILED")).over(Window.partitionBy("run_id"))
    metrics = latest_runs(metrics).withColumn("__failed", failed)
    earlier = Window.partitionBy("metric_key").orderBy("run_seq").rowsBetween(Window.unboundedPreceding, -1)
    previous = F.last(F.when(~F.col("__failed"), F.col("value")), ignorenulls=True).over(earlier)
    return (
        metrics.withColumn("metric_key", _key())
        .select("run_seq", "metric_key", "value", previous.alias("previous_value"))
        .withColumn("delta", F.col("value") - F.col("previous_value"))
        .withColumn("changed", F.coalesce(F.col("delta") != 0, F.lit(False)))
    )


def run_summary(metrics: DataFrame, params: DataFrame) -> DataFrame:
    """One row per run: final status, phases, failed phases and seconds of work. Reruns count once."""
    metrics = latest_runs(metrics)
    phase = F.when(F.col("phase") != RUN, F.col("phase"))
    failed = F.when(F.col("status") == "FAILED", phase)
    seconds = F.when((F.col("phase") == RUN) & (F.col("metric") == "duration_seconds"), F.col("value"))
    per_run = metrics.groupBy("run_id", "run_seq").agg(
        F.count_distinct(phase).alias("phases"),
        F.count_distinct(failed).alias("failed_phases"),
        F.max(seconds).alias("total_seconds"),
    )
    status = params.where(F.col("name") == "final_status").select("run_id", F.col("value").alias("final_status"))
    return per_run.join(status, "run_id", "left")


def _median(values: Column) -> Column:
    ordered, n = F.array_sort(values), F.size(values)
    low, high = F.floor((n - 1) / 2).cast("int"), F.floor(n / 2).cast("int")
    return (F.get(ordered, low) + F.get(ordered, high)) / 2


def run_alerts(
    metrics: DataFrame, directions: Mapping[str, int], *, runs: int = 30, least_runs: int = 4, width: float = 4.0
) -> DataFrame:
    """Metrics beside the band of the successful runs before, with ``alert`` where they are worse.

    ``directions`` says per metric key which way is worse: 1 up, -1 down, 0 both. The band is the median of up to ``runs``
    earlier values and ``width`` times their median distance from it (scaled to a standard deviation); a spread of
    zero makes any change on the worse side an alert. Failed runs are never in the band, and there is no alert before
    ``least_runs`` runs. Reruns count once; a metric's history is one row a run.
    """
    failed = F.max((F.col("phase") == RUN) & (F.col("status") == "FAILED")).over(Window.partitionBy("run_id"))
    worse = F.element_at(F.create_map(*[F.lit(x) for pair in directions.items() for x in pair]), F.col("metric_key"))
    watched = (
        latest_runs(metrics)
        .withColumns({"__failed": failed, "metric_key": _key()})
        .where(F.col("metric_key").isin(list(directions)))
    )
    good = F.when(~F.col("__failed"), F.col("value"))
    earlier = Window.partitionBy("metric_key").orderBy("run_seq").rowsBetween(Window.unboundedPreceding, -1)
    history = F.collect_list(good).over(earlier)  # nulls, the failed runs, are not collected
    recent = F.slice(history, F.greatest(F.size(history) - (runs - 1), F.lit(1)), F.lit(runs))
    offset = F.col("value") - F.col("median")
    away = F.when(F.col("worse") == 0, F.abs(offset)).otherwise(offset * F.col("worse"))
    return (
        watched.select("run_seq", "metric_key", "value", worse.alias("worse"), recent.alias("recent"))
        .withColumn("earlier_runs", F.size("recent"))
        .withColumn("median", F.when(F.col("earlier_runs") > 0, _median(F.col("recent"))))
        .withColumn("spread", _median(F.transform("recent", lambda x: F.abs(x - F.col("median")))) * 1.4826)
        .withColumn("alert", (F.col("earlier_runs") >= least_runs) & F.coalesce(away > width * F.col("spread"), F.lit(False)))
        .drop("recent", "worse")
    )
