"""Ordered patterns with a literal index against trying every pattern on every name."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from tallyhouse.functions.brand import apply_brand_rules
from tallyhouse.operators.patterns import fold_rules, matching_rules, needed_literals


@pytest.mark.parametrize(("pattern", "literals"), [
    ("ABC", ["abc"]), ("AB", None), ("^FOO(BAR|BAZES)$", ["fooba"]), ("F(BAR|BAZES)$", ["fba"]), ("F(BAR|GAZES)$", ["bar", "gazes"]), ("X*LONG?ER", ["lon"]),
    ("(ONE|TWO)(THREE)", ["three"]), ("(?i)Café bar", [" bar"]), ("[ABC]DEF+", None), ("a|bcd", None), ("(?:HELLO)+ ?", ["hello"]),
    ("(?:HELLO)?", None), ("broken(", None), ("x\\.y\\$z", ["x.y$z"]), ("(?=LOOK)x", None), ("AB.CDE", ["cde"]), ("(?i:HELLO)", None)])
def test_needed_literals(pattern, literals):
    got = needed_literals(pattern)
    assert got == (sorted(literals) if literals else None)


def test_rules_fold_like_one_after_the_other(spark):
    rng = random.Random(6)
    words = ["KIVA", "STIIIZY", "PLUS", "CANNA", "HEMP CO", "$VENDOR", "A", "GOLD FLORA", "café", "X-Y", "NINE"]
    names = sorted({" ".join(rng.choice(words) for _ in range(rng.randint(1, 4))) for _ in range(200)} | {"", " "})
    rules = []
    for _ in range(60):
        w = rng.choice(words)
        p = rng.choice([re.escape(w).replace("\\ ", " "), f"^{w[:4]}".replace("$", "\\$"), f"(?i){w.lower()}".replace("$", "\\$"), f"{w[:2]}.", "(KIVA|PLUS)$", "N[IE]+",
                        "HEMP|GOLD FL", "^$"])
        rules.append((p, rng.choice(words)))
    df = spark.createDataFrame([(n,) for n in names] + [(None,)], "name string")
    want = {r["name"]: r["w"] for r in df.select("name", apply_brand_rules(F.col("name"), rules).alias("w")).collect()}
    got = fold_rules(df, rules).select("name", F.when(F.col("settled").startswith("$"), "HOUSE").otherwise(F.col("settled")).alias("w"))
    assert {r["name"]: r["w"] for r in got.collect()} == want and len(want) == len(names) + 1
    assert fold_rules(df, []).where("not (name <=> settled)").count() == 0
    assert matching_rules(df, []).count() == 0 and fold_rules(df.limit(0), rules).count() == 0


def test_cost_follows_matches_not_rules(spark):
    names = spark.range(3000).select(F.concat(F.lit("BRAND "), F.md5(F.col("id").cast("string"))).alias("name"))
    took, tried = {}, {}
    for size in (50, 5000):
        rules = [(f"^PRODUCT {i:05d}X (ONE|TWO)", f"P{i}") for i in range(size - 1)] + [("BRAND 0{2}", "ZERO")]
        start = time.perf_counter()
        got = fold_rules(names, rules).groupBy("settled").count().where("settled = 'ZERO'").collect()
        took[size], tried[size] = time.perf_counter() - start, got
    assert tried[50] == tried[5000] and tried[50][0]["count"] > 0
    # 15 million regular expressions would take minutes; a hundred times the rules cost a little more planning.
    assert took[5000] < 6 * took[50] + 5
