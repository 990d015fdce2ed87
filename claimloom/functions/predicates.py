"""Row conditions shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F


def all_present(columns: Iterable[str]) -> Column:
    """No column is null. Plain null tests reach the Parquet scan; those of ``dropna`` do not."""
    return reduce(and_, (F.col(c).isNotNull() for c in columns), F.lit(True))
