"""Lake-table, partitioned and CSV sinks, and tables kept run by run."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.java_gateway import JavaObject
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

RUN_COLUMN = "_run_seq"


def observed(df: DataFrame, *metrics: Column) -> tuple[DataFrame, Observation]:
    """Attach metrics to the job that will consume the frame, instead of running a second one."""
    observation = Observation()
    return df.observe(observation, F.count(F.lit(1)).alias("row_count"), *metrics), observation


def write_table(
    df: DataFrame, path: str, *, fmt: str = "parquet", mode: str = "overwrite", metrics: Sequence[Column] = ()
) -> dict:
    """Write a lake table; the returned metrics (at least ``row_count``) come from the write itself."""
    df, observation = observed(df, *metrics)
    df.write.format(fmt).mode(mode).save(path)
    return observation.get


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], *, fmt: str = "parquet") -> dict:
    """Write one folder per value of ``by``.

    The rebalance hint gathers the rows of a folder, so that not every task writes every folder,
    and lets adaptive execution cut a folder that holds most of the rows over several tasks.
    """
    balanced = df.hint("rebalance", *[F.col(c) for c in by])
    balanced, observation = observed(balanced)
    balanced.write.format(fmt).mode("overwrite").partitionBy(*by).save(path)
    return observation.get


def export_csv(df: DataFrame, path: str) -> dict:
    """Write CSV with a header, one file per task, texts unchanged."""
    df, observation = observed(df)
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return observation.get


def run_path(path: str, run_seq: int) -> str:
    return f"{path.rstrip('/')}/{RUN_COLUMN}={int(run_seq)}"


def write_run(df: DataFrame, path: str, run_seq: int, *, metrics: Sequence[Column] = ()) -> dict:
    """Write the state after one run beside the earlier ones; a rerun replaces only itself."""
    return write_table(df, run_path(path, run_seq), metrics=metrics)


def _folder(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """The folder and its file system, as Spark's own readers find it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds, from one listing; none if there is no such folder."""
    folder, system = _folder(spark, path)
    return [status.getPath().getName() for status in system.listStatus(folder)] if system.exists(folder) else []


def runs_of(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the runs that wrote the table, ascending: one listing of folder names, no file is looked at."""
    mark = f"{RUN_COLUMN}="
    return sorted(int(name.removeprefix(mark)) for name in folder_names(spark, path) if name.startswith(mark))


def read_as_of_run(
    spark: SparkSession, path: str, run_seq: int | None = None, *, merge_schema: bool = False
) -> DataFrame:
    """The table as the latest run up to ``run_seq`` left it (a run may have left no rows).

    Only the wanted run's folder is opened. With ``merge_schema`` columns that other runs have are null.
    When no run is that early, the table is empty; where no run has written anything, there is no table to read.
    """
    runs = runs_of(spark, path)
    if not runs:
        raise FileNotFoundError(f"no run has written to {path}")
    found = [n for n in runs if run_seq is None or n <= run_seq]
    read = spark.read.option("basePath", path)
    state = read.parquet(run_path(path, found[-1] if found else runs[0]))
    if merge_schema:
        others = [read.parquet(run_path(path, n)).limit(0) for n in runs]
        state = append_batches(state, *others)
    return state if found else state.where(F.lit(False))


def append_batches(*batches: DataFrame) -> DataFrame:
    """Union by name; a column that a batch does not have yet is null there."""
    first, *rest = batches
    for batch in rest:
        first = first.unionByName(batch, allowMissingColumns=True)
    return first


def sizes_mb(spark: SparkSession, paths: Sequence[str]) -> dict[str, float]:
    """Size of each folder from the file system's own summary; no job, no file is opened."""
    sizes = {}
    for path in paths:
        folder, system = _folder(spark, path)
        sizes[path] = system.getContentSummary(folder).getLength() / 2**20
    return sizes
