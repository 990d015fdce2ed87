"""A table of current rows, one per key, kept in hash buckets that loads rewrite one by one.

Every merge writes the buckets that its rows fall into as a new generation; the others stay as they are. The state is, for
each bucket, the newest finished generation that holds it, so a merge that fails half-way leaves no trace in it. Nothing is
overwritten while it is read, and a bucket's earlier generations can be dropped later.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.sources.writers import folder_names, observed

GENERATION, BUCKET = "_generation", "_bucket"


@dataclass(frozen=True)
class Buckets:
    """The state in the folder ``path``: rows of one ``key`` column in ``count`` buckets, fixed once and for all.

    ``latest`` brings several versions of keys down to one row each. It must not depend on their order or on
    versions it dropped before; then loads may come in any order and more than once.
    """

    path: str
    key: str
    latest: Callable[[DataFrame], DataFrame]
    count: int = 256

    def generations(self, spark: SparkSession) -> list[int]:
        """Numbers of the finished merges, ascending."""
        return [n for n in _numbers(spark, self.path, GENERATION) if "_SUCCESS" in folder_names(spark, self._folder(n))]

    def current(self, spark: SparkSession) -> dict[int, int]:
        """The generation of each bucket that has rows: listings of folder names, no file is opened."""
        newest: dict[int, int] = {}
        for n in self.generations(spark):
            newest |= dict.fromkeys(_numbers(spark, self._folder(n), BUCKET), n)
        return newest

    def read(self, spark: SparkSession, buckets: set[int] | None = None) -> DataFrame | None:
        """The current rows (of some buckets); none before the first merge, or where the buckets have no rows."""
        paths = [
            f"{self._folder(n)}/{BUCKET}={b}"
            for b, n in sorted(self.current(spark).items())
            if buckets is None or b in buckets
        ]
        if not paths:
            return None
        return spark.read.option("basePath", self.path).parquet(*paths).drop(GENERATION, BUCKET)

    def merge(self, load: DataFrame) -> dict[str, int]:
        """Bring a load into the state; tells the generation, the buckets rewritten and the rows that these hold.

        A load with the state's own columns and types meets it as it is, so that ``latest`` shuffles once; any other is brought
        to them by ``latest`` first. What reaches the driver is the list of touched buckets, ``count`` at most. Rows without a
        key are left out. An empty load changes nothing.
        """
        spark = load.sparkSession
        bucket = F.pmod(F.xxhash64(self.key), F.lit(self.count)).cast("int")
        keyed = load.where(F.col(self.key).isNotNull())
        touched = {r[0] for r in keyed.select(bucket).distinct().collect()}
        generation = max(_numbers(spark, self.path, GENERATION), default=0) + 1
        if not touched:
            return {"generation": generation - 1, "buckets": 0, "rows": 0}
        old = self.read(spark, touched)
        if old is None:
            merged = self.latest(keyed)
        else:
            new = keyed if sorted(keyed.dtypes) == sorted(old.dtypes) else self.latest(keyed)
            merged = self.latest(old.unionByName(new, allowMissingColumns=True))
        rows, seen = observed(merged.withColumn(BUCKET, bucket).hint("rebalance", F.col(BUCKET)))
        rows.write.partitionBy(BUCKET).parquet(self._folder(generation))
        return {"generation": generation, "buckets": len(touched), "rows": seen.get["row_count"]}

    def changes(self, spark: SparkSession, generation: int) -> tuple[DataFrame | None, DataFrame]:
        """Rows of the buckets that a merge rewrote, as they were before it (none: there were no rows) and after it."""
        now = set(_numbers(spark, self._folder(generation), BUCKET))
        before: dict[int, int] = {}
        for n in self.generations(spark):
            if n < generation:
                before |= {b: n for b in _numbers(spark, self._folder(n), BUCKET) if b in now}
        read = spark.read.option("basePath", self.path)
        old = [f"{self._folder(n)}/{BUCKET}={b}" for b, n in sorted(before.items())]
        after = read.parquet(self._folder(generation)).drop(GENERATION, BUCKET)
        return (read.parquet(*old).drop(GENERATION, BUCKET) if old else None), after

    def _folder(self, generation: int) -> str:
        return f"{self.path.rstrip('/')}/{GENERATION}={generation}"


def _numbers(spark: SparkSession, path: str, name: str) -> list[int]:
    mark = f"{name}="
    return sorted(int(x.removeprefix(mark)) for x in folder_names(spark, path) if x.startswith(mark))
