"""Exact order statistics of each key without a sort of the key: radix selection.

A number's bits, turned so that they order as the number does, are read in DIGITS from the highest on. Values are counted
once; each round counts the next digit of those that agree with what is known of a wanted value so far, and picks the digit in which
its rank falls. So a task holds at most 2^22 counts of digits, whatever the number of values of a key, and a key's values lie over all tasks.
Nulls are left out; NaN is the greatest; zeros are equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bits that each round reads.
DIGITS = (22, 21, 21)
#: Values of a key that are ordered in one task.
MOST = 1 << 20
_SIGN, _REST = -(1 << 63), (1 << 63) - 1


def _turned(bits: Column) -> Column:
    """Of a negative number all bits but the sign, the other way round; doing it twice undoes it."""
    return bits.bitwiseXOR(F.shiftright(bits, 63).bitwiseAND(F.lit(_REST)))


def sortable(c: Column) -> Column:
    """64 bits of a double, which order as unsigned numbers as the doubles do."""
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), c.cast("double") + F.lit(0.0)).cast("long")
    return _turned(bits).bitwiseXOR(F.lit(_SIGN))


def restored(bits: Column) -> Column:
    """The double of sortable() bits."""
    return F.java_method(F.lit("java.lang.Double"), F.lit("longBitsToDouble"), _turned(bits.bitwiseXOR(F.lit(_SIGN)))).cast("double")


def _joined(a: DataFrame, b: DataFrame, columns: list[str]) -> DataFrame:
    """a with the further columns of b where the columns are equal, nulls too."""
    mine = b.select(*[F.col(c).alias(f"_j_{c}") if c in columns else F.col(c) for c in b.columns])
    on = F.lit(True)
    for c in columns:
        on = on & F.col(c).eqNullSafe(F.col(f"_j_{c}"))
    return a.join(mine, on).drop(*[f"_j_{c}" for c in columns])


def at_ranks(df: DataFrame, keys: list[str], value: str, ranks) -> DataFrame:
    """(keys, n, columns of ranks, value): ranks(n) is an array of structs with a place `_k`, from 0, among the n values of a key."""
    counts = df.where(F.col(value).isNotNull()).select(*keys, sortable(F.col(value)).alias("_u")).groupBy(*keys, "_u").agg(F.count("*").alias("_c"))
    wanted = counts.groupBy(*keys).agg(F.sum("_c").alias("n")).where("n > 0").select(*keys, "n", F.explode(ranks(F.col("n"))).alias("_r")).select(*keys, "n", "_r.*", F.lit(0).cast("long").alias("_known"))
    left = 64
    for width in DIGITS:
        left -= width
        known = F.shiftrightunsigned("_u", left + width) if left + width < 64 else F.lit(0).cast("long")
        x = counts.select(*keys, known.alias("_known"), F.shiftrightunsigned("_u", left).bitwiseAND(F.lit((1 << width) - 1)).alias("_d"), "_c")
        if left + width < 64:
            x = _joined(x, wanted.select(*keys, "_known").distinct(), [*keys, "_known"])
        x = x.groupBy(*keys, "_known", "_d").agg(F.sum("_c").alias("_c"))
        x = x.withColumn("_upto", F.sum("_c").over(Window.partitionBy(*keys, "_known").orderBy("_d")))
        found = _joined(wanted, x, [*keys, "_known"]).where((F.col("_upto") > F.col("_k")) & (F.col("_upto") - F.col("_c") <= F.col("_k")))
        wanted = found.withColumns({"_k": F.col("_k") - (F.col("_upto") - F.col("_c")), "_known": F.shiftleft("_known", width).bitwiseOR(F.col("_d"))}).drop("_d", "_c", "_upto")
    return wanted.withColumn("value", restored(F.col("_known"))).drop("_k", "_known")


def percentiles(df: DataFrame, keys: list[str], value: str, points) -> DataFrame:
    """(keys, p, n, value): percentiles by linear interpolation between the two nearest of n values."""
    place = lambda n, p: F.lit(float(p)) * (n - 1)

    def ranks(n: Column) -> Column:
        one = lambda p, at, side: F.struct(F.lit(float(p)).alias("p"), at(place(n, p)).cast("long").alias("_k"), F.lit(side).alias("_side"))
        return F.array(*[one(p, at, side) for p in points for side, at in enumerate((F.floor, F.ceil))])

    two = at_ranks(df, keys, value, ranks).groupBy(*keys, "p", "n").agg(*[F.max(F.when(F.col("_side") == k, F.col("value"))).alias(c) for k, c in enumerate(("_lo", "_hi"))])
    at = F.col("p") * (F.col("n") - 1)
    low = F.floor(at)
    return two.select(*keys, "p", "n", F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).otherwise((low + 1 - at) * F.col("_lo") + (at - low) * F.col("_hi")).alias("value"))


def nearest_ranks(df: DataFrame, keys: list[str], value: str, points) -> DataFrame:
    """(keys, p, n, value): the value at the sorted place round-half-even(p * (n - 1))."""
    return at_ranks(df, keys, value, lambda n: F.array(*[F.struct(F.lit(float(p)).alias("p"), F.bround(F.lit(float(p)) * (n - 1)).cast("long").alias("_k")) for p in points]))


def medians(df: DataFrame, keys: list[str], value: str, most: int = MOST) -> DataFrame:
    """(keys, median): of keys with more than `most` values by radix selection, of all others by Spark's own aggregate, which holds a key's values in a task."""
    x = df.where(F.col(value).isNotNull()).select(*keys, value)
    large = x.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > most).drop("_n")  # at most one key for each `most` rows
    mine = large.select(*[F.col(k).alias(f"_j_{k}") for k in keys])
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_j_{k}"))
    small = x.join(mine, on, "left_anti").groupBy(*keys).agg(F.median(value).alias("median"))
    return small.unionByName(percentiles(x.join(mine, on, "left_semi"), keys, value, (0.5,)).select(*keys, F.col("value").alias("median")))
