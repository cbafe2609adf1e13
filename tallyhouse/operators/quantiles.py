"""Exact percentiles of large groups by radix selection.

Spark's exact ``percentile`` keeps all distinct values of a group in the memory of one task. Here each value becomes a whole
number whose order is the order of the values, and the wanted ranks are found 16 bits at a time: values are counted per
leading digit, the digit that holds a rank is kept with the rank inside it, and the next pass counts only the values that
begin with a kept prefix. Four passes fix all 64 bits. Nothing is sorted, a window sees at most 65,536
digits, counts are combined before the shuffle, and all measures and targets share the passes. The answer
is exact for any distribution: linear interpolation between the two neighbouring values, as ``percentile`` and SQL's ``quantile_cont`` give.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_DIGIT = 16
_SHIFTS = (48, 32, 16, 0)
# The layout of a double: 52 bits of fraction under 11 bits of exponent.
_ONE = float(1 << 52)


def order_bits(value: Column) -> Column:
    """A whole number per double, in the same order; equal doubles share it. Zero is 0, NaN the largest, NULL stays.

    The bits of the absolute value, negated for negative numbers, put together from exponent and fraction with exact
    scalings by powers of two.
    """
    size = F.abs(value)
    # The rounded logarithm can be one off at a power of two.
    guess = F.floor(F.log2(size))
    e = guess + F.when(size >= F.pow(F.lit(2.0), guess + 1), 1).when(size < F.pow(F.lit(2.0), guess), -1).otherwise(0)
    # Two factors, as 2 to the 1074 is no double.
    half = F.floor(e / 2)
    fraction = size * F.pow(F.lit(2.0), -half) * F.pow(F.lit(2.0), half - e) - 1.0
    normal = (e + 1023).cast("long") * F.lit(1 << 52) + (fraction * _ONE).cast("long")
    small = (size * 2.0**537 * 2.0**537).cast("long")
    bits = (F.when(F.isnan(value), F.lit((2047 << 52) + 1)).when(size == float("inf"), F.lit(2047 << 52))
            .when(size < 2.0**-1022, small).otherwise(normal))
    return F.when(value < 0, -bits).otherwise(bits)


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right[f"__k_{key}"])
    return condition


def exact_percentiles(df: DataFrame, keys: list[str],
                      targets: list[tuple[str, str, float]]) -> DataFrame:
    """One row per key with a column per target ``(name, column, p)``.

    NULL values are ignored; a group with no value gives NULL. The frame is read once per pass: stage it if it is costly.
    """
    columns = list(dict.fromkeys(column for _, column, _ in targets))
    bits = F.array(*[F.struct(F.lit(i).alias("__m"), order_bits(F.col(c).cast("double")).alias("__b"),
                              F.col(c).cast("double").alias("__v")) for i, c in enumerate(columns)])
    values = (df.select(*keys, F.explode(bits).alias("__x")).select(*keys, "__x.*")
              .where(F.col("__b").isNotNull()))

    # First the ranks: a 0-based position h per target, its neighbours are at floor and ceil.
    wanted = F.array(*[F.struct(F.lit(i).alias("target"), F.lit(columns.index(c)).alias("m"), F.lit(float(p)).alias("p"))
                       for i, (_, c, p) in enumerate(targets)])
    names = [*keys, "__m"]
    chosen = None
    for shift in _SHIFTS:
        digit = F.shiftright("__b", shift)
        if chosen is None:
            counts = values.groupBy(*names, digit.alias("__d")).agg(F.count(F.lit(1)).alias("__n"))
            total = F.sum("__n").over(Window.partitionBy(*names))
            ranks = F.transform(F.filter(wanted, lambda t: t["m"] == F.col("__m")), lambda t: F.struct(
                t["target"].alias("target"), ((F.col("__total") - 1) * t["p"]).alias("h")))
            ranks = F.flatten(F.transform(ranks, lambda t: F.array(
                F.struct(t["target"].alias("target"), F.lit(False).alias("upper"), (t["h"] - F.floor(t["h"])).alias("part"),
                         F.floor(t["h"]).alias("rank")),
                F.struct(t["target"].alias("target"), F.lit(True).alias("upper"), F.lit(0.0).alias("part"),
                         F.ceil(t["h"]).alias("rank")))))
            counts = counts.withColumn("__total", total).select(*names, "__d", "__n", ranks.alias("__r"))
            within = Window.partitionBy(*names)
        else:
            # Only values that begin with a kept prefix go on, with the ranks asked of that prefix.
            match = _same(values, chosen, names) & (F.shiftright(values["__b"], shift + _DIGIT) == chosen["__prefix"])
            kept = values.join(chosen, match)
            counts = kept.groupBy(*names, digit.alias("__d"), "__prefix").agg(
                F.count(F.lit(1)).alias("__n"), F.first("__r").alias("__r"), F.max("__v").alias("__v"))
            within = Window.partitionBy(*names, "__prefix")
        upto = F.sum("__n").over(within.orderBy("__d").rowsBetween(Window.unboundedPreceding, 0))
        inside = F.filter("__r", lambda r: (r["rank"] < F.col("__upto")) & (r["rank"] >= F.col("__upto") - F.col("__n")))
        found = counts.withColumn("__upto", upto).withColumn("__r", F.transform(
            inside, lambda r: r.withField("rank", r["rank"] - F.col("__upto") + F.col("__n")))).where(F.size("__r") > 0)
        chosen = found.select(*[F.col(k).alias(f"__k_{k}") for k in names], F.col("__d").alias("__prefix"), "__r",
                              *(["__v"] if shift == 0 else []))

    def at(i: int, upper: bool) -> Column:
        return F.max(F.when((F.col("r.target") == i) & (F.col("r.upper") == upper), F.col("__v")))

    picked = chosen.select(*[f"__k_{k}" for k in keys], "__v", F.explode("__r").alias("r"))
    cuts = picked.groupBy(*[f"__k_{k}" for k in keys]).agg(*[F.struct(
        at(i, False).alias("a"), at(i, True).alias("b"),
        F.max(F.when(F.col("r.target") == i, F.col("r.part"))).alias("part")).alias(f"__c_{i}") for i in range(len(targets))])
    groups = df.select(*keys).distinct()
    # Neighbours that are equal, infinite ones too, are the answer as they are.
    return groups.join(cuts, _same(groups, cuts, keys), "left").select(*keys, *[
        F.when(F.col(f"__c_{i}.a") == F.col(f"__c_{i}.b"), F.col(f"__c_{i}.a")).otherwise(
            F.col(f"__c_{i}.a") + (F.col(f"__c_{i}.b") - F.col(f"__c_{i}.a")) * F.col(f"__c_{i}.part")).alias(name)
        for i, (name, _, _) in enumerate(targets)])
