"""Money totals that do not depend on row order.

Adding doubles gives another last digit for every task layout, so a retried task or another
number of partitions would change a published total. An amount is split into parts that add up exactly
inside generated code: whole cents in two bigints (so that no group overflows), and what is left
over in units of 10^-8, which is 0 for any amount with two decimals. The few amounts whose cents a double no
longer holds add up as decimals. Decimals for all would be exact too, at three to four times the cost.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Below this the cents of a double are whole numbers it holds exactly; from here on it has no cents of its own.
_CENTS_BELOW = 1e13
# Below this a sum of 10^10 amounts fits a decimal(38,2). Larger ones, which no currency has, add up as doubles.
_DECIMAL_BELOW = 1e26
_LOW_BITS = 20
_FINE = 1e8

#: The columns that ``partial_sums`` makes and ``total_of`` reads.
PARTS = {
    "cents_high": "bigint", "cents_low": "bigint", "fine": "bigint", "large": "decimal(38,2)", "huge": "double",
}


def _parts(amount: Column) -> dict[str, Column]:
    size = F.abs(amount)
    small = size < F.lit(_CENTS_BELOW)
    cents = F.when(small, F.rint(amount * 100)).cast("bigint")
    rest = amount - cents / F.lit(100.0)
    return {
        "cents_high": F.shiftright(cents, _LOW_BITS),
        "cents_low": cents.bitwiseAND(F.lit((1 << _LOW_BITS) - 1).cast("bigint")),
        "fine": F.rint(rest * F.lit(_FINE)).cast("bigint"),
        "large": F.when(~small & (size < F.lit(_DECIMAL_BELOW)), amount.cast("decimal(38,2)")),
        "huge": F.when(size >= F.lit(_DECIMAL_BELOW), amount),
    }


def partial_sums(amount: Column, times: Column | None = None) -> list[Column]:
    """First level: the sums of the parts, under the names of ``PARTS``; a row counts so many ``times``."""
    parts = _parts(amount)
    if times is not None:
        parts = {name: (part * times).cast(PARTS[name]) for name, part in parts.items()}
    return [F.sum(part).alias(name) for name, part in parts.items()]


def _joined(sums: dict[str, Column]) -> Column:
    """Parts to one double; null where there was no amount at all."""
    cents = sums["cents_high"] * F.lit(1 << _LOW_BITS).cast("decimal(7,0)") + sums["cents_low"]
    zero = F.lit(0).cast("decimal(38,2)")
    whole = F.coalesce((cents * F.lit("0.01").cast("decimal(2,2)")).cast("decimal(38,2)"), zero)
    fine = sums["fine"] * F.lit(f"{1 / _FINE:.8f}").cast("decimal(8,8)")
    total = (whole + F.coalesce(sums["large"], zero)).cast("double")
    total = total + F.coalesce(fine.cast("double"), F.lit(0.0)) + F.coalesce(sums["huge"], F.lit(0.0))
    return F.when(F.coalesce(sums["cents_low"].cast("double"), sums["large"].cast("double"), sums["huge"]).isNotNull(), total)


def _wide(part: Column, name: str) -> Column:
    return part.cast("decimal(19,0)") if PARTS[name] == "bigint" else part


def total_of() -> Column:
    """Roll partial sums up into one double; decimals here, since few rows are left."""
    return _joined({name: F.sum(_wide(F.col(name), name)) for name in PARTS})


def total(amount: Column) -> Column:
    """Single-level form of the same sum."""
    return _joined({name: _wide(F.sum(part), name) for name, part in _parts(amount).items()})
