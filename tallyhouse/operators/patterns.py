"""Ordered regular expressions over many names, tried only where their literals occur.

Every pattern that matches contains one of a few literal pieces that can be read off it. Names are indexed by their
three-letter grams; a pattern is filed under the rarest gram of each of its literals, so one join finds the (name, pattern)
pairs that can match at all and only these are tried. The cost follows the pairs, not names times patterns. Patterns without a
literal of three letters are tried on every name.
"""

from __future__ import annotations

import re
import warnings
from re import _constants as kind
from re import _parser as parser

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_GRAM = 3
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def folded(text: str | Column):
    """A-Z in lower case, nothing else: what occurs in a text still occurs in it when both are folded."""
    if isinstance(text, str):
        return text.translate(str.maketrans(_UPPER, _LOWER))
    return F.translate(text, _UPPER, _LOWER)


def needed_literals(pattern: str) -> list[str] | None:
    """Folded pieces of which every match holds at least one; None if the pattern has none of three letters."""
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("error")
            tree = parser.parse(pattern)
    except (re.error, Warning, RecursionError):
        return None
    ignore_case = bool(tree.state.flags & re.IGNORECASE)
    if tree.state.flags & re.VERBOSE or "\\Q" in pattern:
        return None
    found = _best(tree, ignore_case)
    return sorted(found) if found else None


def _inline(items):
    """The parts with plain groups opened; flags inside a group may make its letters match others, so it stays closed."""
    for op, value in items:
        if op is kind.SUBPATTERN and not value[1] and not value[2]:
            yield from _inline(value[3])
        else:
            yield op, value


def _best(items, ignore_case: bool) -> set[str] | None:
    """The alternatives whose shortest literal is longest, among the parts that every match goes through."""
    options: list[set[str]] = []
    run = ""

    def close():
        nonlocal run
        if len(run) >= _GRAM:
            options.append({folded(run)})
        run = ""

    for op, value in _inline(items):
        if op is kind.LITERAL and not (ignore_case and value > 127):
            run += chr(value)
            continue
        close()
        inner = None
        if op in (kind.MAX_REPEAT, kind.MIN_REPEAT) and value[0] > 0:
            inner = _best(value[2], ignore_case)
        elif op is kind.BRANCH:
            parts = [_best(part, ignore_case) for part in value[1]]
            inner = set().union(*parts) if all(parts) else None
        if inner:
            options.append(inner)
    close()
    return max(options, key=lambda o: (min(map(len, o)), -len(o)), default=None)


def _grams(text: Column) -> Column:
    n = F.length(text) - _GRAM + 1
    return F.when(n > 0, F.array_distinct(F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(text, i, F.lit(_GRAM)))))


def matching_rules(names: DataFrame, patterns: list[str], name: str = "name") -> DataFrame:
    """``name, rule``: every place in ``patterns`` whose pattern is found in the name, NULL names in none.

    ``names`` has one row per name. Patterns are in Spark's dialect.
    """
    spark = names.sparkSession
    literals = [needed_literals(p) for p in patterns]
    filed = [(i, p, piece) for i, (p, pieces) in enumerate(zip(patterns, literals, strict=True)) for piece in pieces or []]
    free = [(i, p) for i, (p, pieces) in enumerate(zip(patterns, literals, strict=True)) if pieces is None]
    known = names.where(F.col(name).isNotNull()).select(name, folded(F.col(name)).alias("__f"))
    out = None
    if filed:
        rules = spark.createDataFrame(filed, "rule int, pattern string, literal string")
        grams = known.select(name, "__f", F.explode(_grams(F.col("__f"))).alias("__g"))
        common = grams.groupBy("__g").agg(F.count(F.lit(1)).alias("__n"))
        # A literal's gram that no name has sorts first: such a pattern meets no name.
        rarest = rules.select("*", F.explode(_grams(F.col("literal"))).alias("__g")).join(common, "__g", "left").groupBy(
            "rule", "pattern", "literal").agg(F.min_by("__g", F.struct(F.coalesce("__n", F.lit(0)), "__g")).alias("__g"))
        hits = grams.join(rarest, "__g").where(F.col("__f").contains(F.col("literal")))
        out = hits.where(F.rlike(F.col(name), F.col("pattern"))).select(name, "rule").distinct()
    if free:
        tried = F.array(*[F.struct(F.lit(i).alias("rule"), F.lit(p).alias("pattern")) for i, p in free])
        found = F.filter(tried, lambda r: F.rlike(F.col(name), r["pattern"]))
        rest = known.select(name, F.explode(F.transform(found, lambda r: r["rule"])).alias("rule"))
        out = rest if out is None else out.unionByName(rest)
    return out if out is not None else names.select(name, F.lit(0).alias("rule")).limit(0)


def fold_rules(names: DataFrame, rules: list[tuple[str, str]], name: str = "name", settled: str = "settled") -> DataFrame:
    """``name, settled`` for every name: ordered ``(pattern, replacement)`` rules, each seeing what those before made of the name.

    Only the first rule that matches depends on the name; what later rules make of its replacement is the same for all names and
    worked out once per rule, as one small job.
    """
    spark: SparkSession = names.sparkSession
    if not rules:
        return names.select(name, F.col(name).alias(settled))
    patterns, replacements = [p for p, _ in rules], [r for _, r in rules]
    made = spark.createDataFrame([(r,) for r in sorted(set(replacements))], "name string")
    later: dict[str, list[int]] = {}
    for r in matching_rules(made, patterns).collect():  # at most one row per pair of rules that can follow one another
        later.setdefault(r["name"], []).append(r["rule"])
    final = list(replacements)
    for i in range(len(rules) - 1, -1, -1):
        following = [j for j in later.get(replacements[i], []) if j > i]
        if following:
            final[i] = final[min(following)]
    ends = spark.createDataFrame(list(enumerate(final)), f"__first int, {settled} string")
    first = matching_rules(names, patterns, name).groupBy(name).agg(F.min("rule").alias("__first")).join(ends, "__first")
    first = first.select(F.col(name).alias("__name"), settled)
    return names.join(first, names[name] == F.col("__name"), "left").select(
        name, F.coalesce(settled, F.col(name)).alias(settled))
