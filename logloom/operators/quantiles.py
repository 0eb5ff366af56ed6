"""Interpolated percentiles per group, for groups of any size: exact ones of whole numbers and of doubles, and sketched ones."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..scratch import Scratch

# Values are found in two steps: their upper bits select a bucket, then the
# bucket is searched. No window sees more rows of a group than this many.
BUCKET_BITS = 16


def percentiles(
    counts: DataFrame, keys: Sequence[str], value: str, count: str, fractions: dict[str, float]
) -> DataFrame:
    """Per group the percentiles named in `fractions`; groups with NULL values only are left out.

    `counts` has one row per group and distinct integer value, with the number
    of its occurrences. It is read twice and should be a written table.
    """
    group = F.struct(*keys).alias("group")  # compares equal where a key is NULL
    counted = counts.where(F.col(value).isNotNull()).select(
        group,
        F.shiftright(value, BUCKET_BITS).alias("bucket"),
        F.col(value).alias("value"),
        F.col(count).alias("count"),
    )
    of_group = Window.partitionBy("group")
    earlier = of_group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = counted.groupBy("group", "bucket").agg(F.sum("count").alias("inside"))
    buckets = buckets.select(
        "group",
        "bucket",
        "inside",
        F.coalesce(F.sum("inside").over(earlier), F.lit(0)).alias("before"),
        F.sum("inside").over(of_group).alias("total"),
    )

    places = {name: F.lit(fraction) * (F.col("total") - 1) for name, fraction in fractions.items()}
    wanted = [index for place in places.values() for index in (F.floor(place), F.ceil(place))]

    def holds(index: Column, start: str, size: str) -> Column:
        return (index >= F.col(start)) & (index < F.col(start) + F.col(size))

    hit = reduce(lambda a, b: a | b, [holds(index, "before", "inside") for index in wanted])
    in_bucket = Window.partitionBy("group", "bucket").orderBy("value")
    smaller = F.sum("count").over(in_bucket.rowsBetween(Window.unboundedPreceding, -1))
    placed = counted.join(buckets.where(hit), ["group", "bucket"]).withColumn(
        "start", F.col("before") + F.coalesce(smaller, F.lit(0))
    )
    ends = [
        F.max(F.when(holds(bound(place), "start", "count"), F.col("value"))).alias(f"{side}_{name}")
        for name, place in places.items()
        for side, bound in (("low", F.floor), ("high", F.ceil))
    ]
    found = placed.groupBy("group").agg(F.first("total").alias("total"), *ends)

    def between(name: str, place: Column) -> Column:
        low, high = F.col(f"low_{name}"), F.col(f"high_{name}")
        return (low + (place - F.floor(place)) * (high - low)).cast("double").alias(name)

    return found.select("group.*", *[between(name, place) for name, place in places.items()])


# -- doubles -------------------------------------------------------------------

_MANTISSA = 1 << 52
_NOT_A_NUMBER = (2047 << 52) + 1  # after infinity, where Spark sorts it


def ordered_bits(value: Column) -> Column:
    """A 64-bit whole number per double, in the order of the doubles: the bits of its size, negative below zero.

    Both zeros are 0, every NaN is one number after infinity, NULL stays NULL.
    """
    size = F.abs(value.cast("double"))
    # the logarithm may be off by one next to a power of two
    guess = F.floor(F.log2(size)).cast("int")
    power = F.when(F.pow(F.lit(2.0), guess) > size, guess - 1).when(F.pow(F.lit(2.0), guess + 1) <= size, guess + 1).otherwise(guess)
    fraction = ((size / F.pow(F.lit(2.0), power) - 1) * _MANTISSA).cast("long")
    normal = (power + 1023).cast("long") * _MANTISSA + fraction
    half = F.pow(F.lit(2.0), F.lit(537))
    bits = F.when(size == float("inf"), F.lit(2047 << 52)).when(size < F.pow(F.lit(2.0), F.lit(-1022)), (size * half * half).cast("long"))
    bits = bits.otherwise(normal)
    return F.when(F.isnan(value), F.lit(_NOT_A_NUMBER)).when(value < 0, -bits).otherwise(bits)


def double_of(bits: Column) -> Column:
    """The double of `ordered_bits`; its zero is positive."""
    size = F.abs(bits)
    power = F.shiftright(size, 52)
    half = F.pow(F.lit(2.0), F.lit(-537))
    normal = (1 + size.bitwiseAND(F.lit(_MANTISSA - 1)).cast("double") / _MANTISSA) * F.pow(F.lit(2.0), power - 1023)
    value = F.when(power == 0, size.cast("double") * half * half).when(size == 2047 << 52, F.lit(float("inf"))).otherwise(normal)
    return F.when(bits == _NOT_A_NUMBER, F.lit(float("nan"))).when(bits < 0, -value).otherwise(value)


def percentiles_of_doubles(
    rows: DataFrame, keys: Sequence[str], value: str, fractions: dict[str, float], scratch: Scratch
) -> DataFrame:
    """Per group the percentiles named in `fractions` of any doubles, exactly; groups with NULL values only are left out.

    The wanted places are found in four rounds, each of which reads 16 more
    bits of the values: values are counted by these bits where they are read,
    and the next round keeps only values whose bits so far hold a wanted
    place. So no window holds more than 65,536 rows, however large or hot a
    group is, and after the first round few of its values are left. NaN comes
    after infinity; a percentile next to an infinite value or NaN is what
    their arithmetic gives.
    """
    counted = rows.where(F.col(value).isNotNull()).groupBy(F.struct(*keys).alias("group"), ordered_bits(F.col(value)).alias("bits"))
    left = scratch.keep(counted.agg(F.count("*").alias("n")), "values")
    totals = scratch.keep(left.groupBy("group").agg(F.sum("n").alias("total")), "totals")
    sides = {f"{side}_{name}": bound(F.lit(f) * (F.col("total") - 1)) for name, f in fractions.items() for side, bound in (("low", F.floor), ("high", F.ceil))}
    places = F.array(*[F.struct(F.lit(name).alias("name"), place.cast("long").alias("rest")) for name, place in sides.items()])
    # the bits so far, of all values at first, and the place among the values that share them
    wanted = totals.select("group", F.lit(None).cast("long").alias("prefix"), F.explode(places).alias("place")).select("group", "prefix", "place.*")

    in_order = Window.partitionBy("group", "prefix").orderBy("bucket")
    for shift in (48, 32, 16, 0):
        prefix = F.shiftright("bits", shift + 16) if shift < 48 else F.lit(None).cast("long")
        buckets = left.groupBy("group", prefix.alias("prefix"), F.shiftright("bits", shift).alias("bucket")).agg(F.sum("n").alias("inside"))
        until = F.sum("inside").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        buckets = buckets.withColumn("until", until).select(F.col("group").alias("of"), F.col("prefix").alias("under"), "bucket", "inside", "until")
        within = (F.col("rest") >= F.col("until") - F.col("inside")) & (F.col("rest") < F.col("until"))
        same = F.col("group").eqNullSafe(F.col("of")) & F.col("prefix").eqNullSafe(F.col("under"))
        found = wanted.join(buckets, same & within)
        rest = F.col("rest") - (F.col("until") - F.col("inside"))
        wanted = scratch.keep(found.select("group", F.col("bucket").alias("prefix"), "name", rest.alias("rest")), "wanted")
        if shift:
            hit = wanted.select(F.col("group").alias("of"), F.col("prefix").alias("under")).distinct()
            same = F.col("group").eqNullSafe(F.col("of")) & (F.shiftright("bits", shift) == F.col("under"))
            left = scratch.keep(left.join(hit, same, "left_semi"), "values-left")

    ends = [F.max(F.when(F.col("name") == name, F.col("prefix"))).alias(name) for name in sides]
    found = wanted.groupBy("group").agg(*ends).withColumnRenamed("group", "of")
    found = totals.join(found, F.col("group").eqNullSafe(F.col("of")))

    def between(name: str, fraction: float) -> Column:
        low, high = double_of(F.col(f"low_{name}")), double_of(F.col(f"high_{name}"))
        place = F.lit(fraction) * (F.col("total") - 1)
        part = place - F.floor(place)
        return F.when(F.col(f"low_{name}") == F.col(f"high_{name}"), low).otherwise(low + part * (high - low)).alias(name)

    return found.select("group.*", *[between(name, fraction) for name, fraction in fractions.items()])


# -- sketches ------------------------------------------------------------------


def sketches(rows: DataFrame, keys: Sequence[str], value: str, size: int = 800) -> DataFrame:
    """Per group a mergeable sketch of the values: some kilobytes, whatever the number of rows.

    A percentile read from it is off by a rank of some 2.3 / size**0.9 of all
    values with 99% probability, 0.6% for 800.
    """
    return rows.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(size)).alias("sketch"))


def merged_sketches(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The sketches of parts, like days, put together per group; a group has one row a part."""
    listed = parts.groupBy(*keys).agg(F.collect_list("sketch").alias("parts"))
    rest = F.slice("parts", 2, F.size("parts"))
    return listed.select(*keys, F.aggregate(rest, F.col("parts")[0], F.kll_sketch_merge_double).alias("sketch"))


def sketched_percentiles(parts: DataFrame, keys: Sequence[str], fractions: dict[str, float]) -> DataFrame:
    """Per group the percentiles named in `fractions` as the sketch has them."""
    found = [F.kll_sketch_get_quantile_double("sketch", F.lit(f)).alias(name) for name, f in fractions.items()]
    return parts.select(*keys, *found)
