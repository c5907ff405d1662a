"""Column expressions shared by the operators (all JVM built-ins)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_enum(c: str | Column, values: Sequence[str], type_name: str) -> Column:
    """Keep a value of a closed set; fail the job on anything else (null passes)."""
    c = col(c)
    return (F.when(c.isNull() | c.isin(*values), c)
            .otherwise(F.raise_error(F.concat(F.lit(f"No enum constant {type_name}."), c))))


def enum_ordinal(c: str | Column, values: Sequence[str]) -> Column:
    """Position of a value in its declared enum, null when unknown."""
    expr = F.lit(None).cast("int")
    for i, v in reversed(list(enumerate(values))):
        expr = F.when(col(c) == v, F.lit(i)).otherwise(expr)
    return expr


def exact(amount: str | Column) -> Column:
    """A finite double as an exact decimal (ten places), 0 for anything else: sums of it do not
    depend on their order, and neither price nor product is rounded to cents."""
    c = col(amount).cast("double")
    return F.coalesce(F.when(c.between(-1e17, 1e17), c).try_cast("decimal(28,10)"),
                      F.lit(0).cast("decimal(28,10)"))


def order_value(price: str = "price", quantity: str = "quantity") -> Column:
    """quantity * price as an exact decimal (finite part)."""
    return (exact(price) * col(quantity).cast("decimal(10,0)")).cast("decimal(38,10)")


def odd_amounts(price: str = "price", quantity: str = "quantity") -> dict[str, Column]:
    """What :func:`order_value` leaves out, in columns that add up exactly: ``big``, whole amounts of prices
    beyond 1e17 (double precision has no fraction there), and counters of what is no finite amount -- ``nan``,
    and ``high`` and ``low`` for infinities (products beyond 1e28 count as such)."""
    p, q = col(price).cast("double"), col(quantity)
    v = p * q
    nan = F.isnan(p) | F.isnan(v)
    high, low = ~nan & (v > 1e28), ~nan & (v < -1e28)
    big = F.when(~nan & ~high & ~low & ~p.between(-1e17, 1e17), v)
    return {"big": F.coalesce(big.try_cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)")),
            **{n: F.coalesce(c.cast("bigint"), F.lit(0).cast("bigint")) for n, c in (("nan", nan), ("high", high), ("low", low))}}


def amount(dec: str | Column, big: str | Column, nan: str | Column, high: str | Column, low: str | Column) -> Column:
    """A double from exact sums and the counters: NaN stays NaN, infinities stay infinite."""
    n, h, l = col(nan), col(high), col(low)
    return (F.when((n > 0) | ((h > 0) & (l > 0)), F.lit(float("nan")))
            .when(h > 0, F.lit(float("inf"))).when(l > 0, F.lit(float("-inf")))
            .otherwise(col(dec).cast("double") + col(big).cast("double")))


def amount_text(dec: str | Column, big: str | Column, nan: str | Column, high: str | Column, low: str | Column) -> Column:
    """One amount as text, exact: what a Python decimal reads."""
    n, h, l = col(nan), col(high), col(low)
    return (F.when(n > 0, "NaN").when(h > 0, "Infinity").when(l > 0, "-Infinity")
            .when(col(big) != 0, col(big).cast("string")).otherwise(col(dec).cast("string")))


def limit_branch(value: str | Column, limit: float | Column, above: str = "FAIL",
                 below: str = "PASS") -> Column:
    """Ordered first-match branching ``>= limit`` then ``< limit``, no default.

    NaN satisfies neither comparison in the reference (IEEE), but Spark orders
    NaN above every number; the guard keeps NaN in "neither" (null).
    """
    v = col(value)
    lim = limit if isinstance(limit, Column) else F.lit(limit)
    ok = v.isNotNull() & ~F.isnan(v)
    return F.when(ok & (v >= lim), F.lit(above)).when(ok & (v < lim), F.lit(below))


def interval(spec: str) -> Column:
    """A day-time interval literal such as '5 minutes'."""
    return F.expr(f"INTERVAL {_interval_sql(spec)}")


def _interval_sql(spec: str) -> str:
    n, unit = spec.split()
    unit = unit.upper().rstrip("S")
    return f"'{n}' {unit}"


def interval_seconds(spec: str) -> float:
    n, unit = spec.split()
    unit = unit.lower().rstrip("s")
    mult = {"microsecond": 1e-6, "millisecond": 1e-3, "second": 1, "minute": 60, "hour": 3600,
            "day": 86400}[unit]
    return float(n) * mult


def micros(ts: str | Column) -> Column:
    """Timestamp as epoch microseconds (exact integer arithmetic on time)."""
    return F.unix_micros(col(ts).cast("timestamp"))


def interval_micros(spec: str) -> int:
    return int(round(interval_seconds(spec) * 1_000_000))
