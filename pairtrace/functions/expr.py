"""Column helpers with the rounding, clipping and null rules the scores rely on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairtrace.functions.shared import materialize

WINDOW_KEY = ["window_id"]
PAIR_KEY = ["window_id", "driver_id", "customer_id"]


def np_round(c: Column | str, digits: int) -> Column:
    """Half-even rounding of the scaled double."""
    c = F.col(c) if isinstance(c, str) else c
    return F.rint(c * float(10**digits)) / float(10**digits)


def clip(c: Column, low: float = 0.0, high: float = 1.0) -> Column:
    """Null counts as ``low``."""
    return F.greatest(F.lit(low), F.least(F.coalesce(c, F.lit(low)), F.lit(high)))


def ratio(n: Column, d: Column) -> Column:
    """n / d as double; 0 where d is 0 or either is null."""
    return F.coalesce(F.try_divide(n.cast("double"), d.cast("double")), F.lit(0.0))


def truth(c: Column) -> Column:
    """Null predicates are false."""
    return F.coalesce(c, F.lit(False))


def pair_key() -> Column:
    return F.concat_ws("||", F.trim("driver_id"), F.trim("customer_id"))


def numeric_or_default(df: DataFrame, name: str, default: float) -> Column:
    """Column as double, ``default`` where it is missing, null or not a number."""
    if name not in df.columns:
        return F.lit(default)
    return F.coalesce(F.nanvl(F.col(name).try_cast("double"), F.lit(None).cast("double")), F.lit(default))


#: Doubles count in sums as whole billionths, which add up alike in any order.
UNITS = 9


def _whole(c: Column | str, units: int) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.rint(c.cast("double") * float(10**units)).cast("decimal(28,0)")


def exact_ratio(top: Column, bottom: Column, digits: int) -> Column:
    """top / bottom of whole numbers as double, rounded half-even once at ``digits``; null where bottom is 0."""
    whole = lambda c: c.cast("decimal(38,0)")
    a, b = whole(whole(top) * F.lit(10**digits).cast("decimal(18,0)")), F.nullif(whole(bottom), F.lit(0).cast("decimal(38,0)"))
    quotient = F.call_function("div", a, b)
    twice = F.abs(2 * (a - whole(quotient * b))) - F.abs(b)
    up = (twice > 0) | ((twice == 0) & (quotient % 2 != 0))
    return (quotient + F.when(up, F.signum(a).cast("long")).otherwise(0)) / float(10**digits)


def exact_sum(c: Column | str, units: int = UNITS) -> Column:
    """Aggregate: the sum as double, of values at ``units`` digits, the same in any order of the rows; null without values."""
    return F.sum(_whole(c, units)).cast("double") / float(10**units)


def exact_mean(c: Column | str, digits: int, units: int = UNITS) -> Column:
    """Aggregate: the mean of values at ``units`` digits, rounded half-even once at ``digits``, the same in any order of the rows."""
    return exact_ratio(F.sum(_whole(c, units)), F.count(c) * F.lit(10**units).cast("decimal(18,0)"), digits)


def exact_blend(weights: dict[str, int], percent: int, digits: int, units: int = UNITS) -> Column:
    """Aggregate: means of columns without nulls, weighted in parts of ``percent``, rounded half-even once at ``digits``."""
    top = sum((F.sum(_whole(c, units)).cast("decimal(36,0)") * w for c, w in weights.items()), F.lit(0).cast("decimal(38,0)"))
    return exact_ratio(top, F.count("*") * F.lit(percent * 10**units).cast("decimal(18,0)"), digits)


def distinct_counts(rows: DataFrame, keys: list[str], counts: dict[str, tuple[str, ...]]) -> DataFrame:
    """``keys`` with the number of distinct values of each name's columns; a single column's nulls don't count.

    The distinct rows of all columns are written once, then each count has two grouped steps over
    that table, combined map-side. No row is repeated for the sake of another count, and no
    group's values meet in one task. Without keys there is one row.
    """
    columns = sorted({c for cs in counts.values() for c in cs})
    base = materialize(rows.select(*keys, *columns).distinct(), "distinct-rows")
    found = base.select(*keys).distinct().select(*keys, F.lit(None).cast("string").alias("__of"), F.lit(0).cast("long").alias("__n")) if keys else None
    for name, cs in counts.items():
        seen = base.filter(F.col(cs[0]).isNotNull()) if len(cs) == 1 else base
        one = seen.select(*keys, *cs).distinct().groupBy(*keys).agg(F.count("*").alias("__n")).select(*keys, F.lit(name).alias("__of"), "__n")
        found = one if found is None else found.unionAll(one)
    number = lambda name: F.coalesce(F.max(F.when(F.col("__of") == name, F.col("__n"))), F.lit(0).cast("long")).alias(name)
    return found.groupBy(*keys).agg(*[number(name) for name in counts])


def running_total(rows: DataFrame, keys: list[str], order: list[Column], amount: Column, out: str) -> DataFrame:
    """``rows`` with the running sum of ``amount`` inside ``keys`` in the total order ``order``.

    Rows are dealt to ranges of (keys, order); a range adds its own rows to the total of the
    ranges before it, so no key meets in one task. ``rows`` are written once.
    """
    dealt = rows.withColumn("__amount", amount).repartitionByRange(*[F.col(k) for k in keys], *order).withColumn("__part", F.spark_partition_id())
    dealt = materialize(dealt, "ranges")
    totals = dealt.groupBy(*keys, "__part").agg(F.sum("__amount").alias("__t"))  # at most a row for each key and range that meet
    before = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("__before", F.coalesce(F.sum("__t").over(before), F.lit(0))).drop("__t")
    joined = dealt.join(offsets, [*keys, "__part"])
    inside = Window.partitionBy(*keys, "__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return joined.withColumn(out, F.sum("__amount").over(inside) + F.col("__before")).drop("__amount", "__part", "__before")


def cumulative_share(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """cume_dist of ``value`` inside ``keys`` through running totals of its histogram, so no group meets in one task.

    Nulls get 0 and don't count. Keys are not null.
    """
    hist = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("__n"))
    hist = running_total(hist, keys, [F.col(value)], F.col("__n"), "__run")
    total = hist.groupBy(*keys).agg(F.max("__run").alias("__all"))
    hist = hist.join(total, keys).withColumn(out, F.col("__run") / F.col("__all")).drop("__n", "__run", "__all")
    names = {k: f"__k{i}" for i, k in enumerate([*keys, value])}
    hist = hist.select(*[F.col(k).alias(n) for k, n in names.items()], F.col(out).alias("__share"))
    cond = F.lit(True)
    for k, n in names.items():
        cond = cond & F.col(k).eqNullSafe(F.col(n))
    return df.join(hist, cond, "left").withColumn(out, F.coalesce("__share", F.lit(0.0))).drop("__share", *names.values())
