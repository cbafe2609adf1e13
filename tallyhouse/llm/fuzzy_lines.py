"""Fuzzy line dedup with DataFrame functions only: SimHash, pigeonhole blocks, edit similarity, connected groups.

A line is normalised (lower case, runs of white space to one blank, trimmed) and equal lines collapse in an aggregation
before anything else, so the number of copies of a line costs nothing later. A line's SimHash has 64 bits, each the
strict majority of its different words' hashes at that bit. The words are exploded and counted by sums of packed counters:
16 bits a counter for lines of up to 16,383 different words, 32 bits for longer ones; both give the same majority.

Two lines are candidates if their SimHashes differ in at most ``distance`` bits: with the bits cut into ``distance + 2``
blocks, two blocks at least agree, so candidates share a bucket of a pair of blocks. They are linked if
``1 - levenshtein / longer length`` is at least ``similarity``. Of each connected group of lines, equal lines included,
only the occurrence with the smallest (key, place) stays. Groups need connections, not all links: first each bucket's
members are compared with its smallest member only, then the pairs of lines that are not yet connected; no pair of lines
that are connected already is made. The lines' texts are not kept: those of pairs to be verified are read again from
the documents of their first occurrences.

Defined results: a null text stays null and has no lines; blank lines are never dropped; rows equal in key and text are
one occurrence (both keep or lose a line together); a null key sorts last; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import row_key, shared_folder, stored
from tallyhouse.llm.components import components

_NARROW = 2 ** 14 - 1  # different words that 16-bit counters packed in a signed long can count, and be compared in
_WORDS = r"[^\p{L}\p{N}]+"


def normalized(line: Column) -> Column:
    low = F.lower(line)
    # Few lines have anything to replace; looking for that is much cheaper than the expression.
    some = reduce(lambda a, b: a | b, [low.contains(x) for x in ("  ", "\t", "\n", "\x0b", "\f", "\r")])
    return F.trim(F.when(some, F.regexp_replace(low, r"\s+", " ")).otherwise(low))


def _packed(width: int) -> list[Column]:
    """Sums of the bits of ``_h``, ``64 / width`` counters of ``width`` bits in each of ``width`` longs."""
    ones = sum(1 << at for at in range(0, 64, width))
    return [F.sum(F.shiftright("_h", i).bitwiseAND(F.lit(ones))).alias(f"s{i}") for i in range(width)]


def _narrow_majority() -> Column:
    lanes, out = 0x0001000100010001, F.lit(0).cast("long")
    missing = (F.lit(_NARROW) - F.expr("n div 2")) * F.lit(lanes)  # to the first counter with bit 14
    for i in range(16):
        above = F.shiftright(F.col(f"s{i}") + missing, 14).bitwiseAND(F.lit(lanes))
        out = out.bitwiseOR(F.shiftleft(above, i))
    return out


def _wide_majority() -> Column:
    half, out = F.expr("n div 2"), F.lit(0).cast("long")
    for i in range(32):
        low, high = F.col(f"s{i}").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(f"s{i}", 32)
        for counts, bit in ((low, i), (high, 32 + i)):
            out = out.bitwiseOR(F.shiftleft((counts > half).cast("long"), bit))
    return out


def simhashes(lines: DataFrame, keys: list[str], long_lines: DataFrame | None = None) -> DataFrame:
    """``keys, sim`` of different lines (``keys, line``); ``long_lines`` is a smaller table with all lines of many words."""
    # A word counts once: rulers and separators say nothing.
    words = F.array_distinct(F.split("line", _WORDS))
    # So many words need so many characters: only such lines are split once more to be counted.
    long = F.length("line") >= 2 * _NARROW
    narrow = lines.where(~long | (F.size(words) <= _NARROW)).select(*keys, words.alias("words"))
    wide = (long_lines or lines).where(long & (F.size(words) > _NARROW)).select(*keys, words.alias("words"))

    def counted(part: DataFrame, width: int, majority: Column) -> DataFrame:
        hashes = part.select(*keys, F.explode("words").alias("word")).select(*keys, F.xxhash64("word").alias("_h"))
        return hashes.groupBy(*keys).agg(F.count("*").alias("n"), *_packed(width)).select(*keys, majority.alias("sim"))

    return counted(narrow, 16, _narrow_majority()).unionByName(counted(wide, 32, _wide_majority()))


def _block_masks(distance: int) -> list[Column]:
    """The bits of every pair of the ``distance + 2`` blocks."""
    n = distance + 2
    cuts = [round(i * 64 / n) for i in range(n + 1)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:], strict=False)]
    signed = lambda m: m - (1 << 64) if m >= 1 << 63 else m
    return [F.lit(signed(masks[i] | masks[j])) for i, j in combinations(range(n), 2)]


def shared_buckets(lines: DataFrame, distance: int, some: range | None = None) -> DataFrame:
    """Lines (``id, sim``) in buckets with others: ``t`` (pair of blocks), ``low, low_sim`` (the bucket's smallest line).

    ``some`` gives the pairs of blocks to look at. A bucket of two lines that are not near each other is none.
    """
    keys = F.array(*[F.struct(F.lit(i).alias("t"), F.col("sim").bitwiseAND(m).alias("bits"))
                     for i, m in enumerate(_block_masks(distance)) if some is None or i in some])
    dealt = lines.select("id", "sim", F.explode(keys).alias("k")).select("id", "sim", "k.t", "k.bits")
    apart = F.bit_count(F.bit_or("sim").bitwiseXOR(F.bit_and("sim")))  # of two lines, the bits that differ
    first = dealt.groupBy("t", "bits").agg(F.min("id").alias("low"), F.count("*").alias("n"), apart.alias("apart"))
    first = first.where((F.col("n") > 2) | ((F.col("n") == 2) & (F.col("apart") <= distance))).select("t", "bits", "low")
    low = lines.select(F.col("id").alias("low"), F.col("sim").alias("low_sim"))
    return dealt.join(first, ["t", "bits"]).select("t", "low", "id", "sim").join(low, "low")


def star_pairs(buckets: DataFrame, distance: int) -> DataFrame:
    """``a, b``: each bucket's smallest line with the members near it."""
    near = F.bit_count(F.col("sim").bitwiseXOR(F.col("low_sim"))) <= distance
    return buckets.where((F.col("id") != F.col("low")) & near).select(F.col("low").alias("a"), F.col("id").alias("b")).distinct()


def open_pairs(buckets: DataFrame, groups: DataFrame, distance: int) -> DataFrame:
    """``a, b``: pairs near each other and in different groups (``node, root``), each at its first agreeing blocks only."""
    masks = _block_masks(distance)
    members = buckets.join(groups, F.col("id") == F.col("node"), "left").select(
        "t", "low", "id", "sim", F.coalesce("root", "id").alias("of"))
    mixed = members.groupBy("t", "low").agg(F.min("of").alias("x"), F.max("of").alias("y")).where("x <> y").select("t", "low")
    members = members.join(mixed, ["t", "low"], "left_semi")
    a, b = members.alias("a"), members.alias("b")
    apart = F.col("a.sim").bitwiseXOR(F.col("b.sim"))
    first = F.coalesce(*[F.when(apart.bitwiseAND(m) == 0, F.lit(i)) for i, m in enumerate(masks)])
    # What the stars have compared already is left out.
    joined = a.join(b, (F.col("a.t") == F.col("b.t")) & (F.col("a.low") == F.col("b.low")) & (F.col("a.id") < F.col("b.id"))
                    & (F.col("a.of") != F.col("b.of")) & (F.col("a.id") != F.col("a.low"))
                    & (F.bit_count(apart) <= distance) & (first == F.col("a.t")))
    return joined.select(F.col("a.id").alias("a"), F.col("b.id").alias("b"))


def texts_of(pairs: DataFrame, distinct: DataFrame, rows: DataFrame) -> DataFrame:
    """``id, id2, line`` of the lines in ``pairs``, read from the documents that hold their first occurrences (``one``)."""
    need = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    wanted = distinct.join(need, "id", "left_semi").groupBy("one.k1", "one.k2").agg(
        F.collect_list(F.struct("id", "id2", F.col("one.at").alias("at"))).alias("w"))
    once = rows.select("k1", "k2", "text").join(wanted, ["k1", "k2"]).select(
        F.split("text", "\n").alias("all"), F.explode("w").alias("w"))
    return once.select("w.id", "w.id2", normalized(F.get("all", F.col("w.at"))).alias("line")).dropDuplicates(["id", "id2"])


def linked(pairs: DataFrame, held: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose lines (``id, line``) are similar enough, as edges ``u, v``."""
    both = pairs.join(held.select(F.col("id").alias("a"), F.col("line").alias("x")), "a").join(
        held.select(F.col("id").alias("b"), F.col("line").alias("y")), "b")
    longer = F.greatest(F.length("x"), F.length("y"))
    limit = F.floor((1 - F.lit(similarity)) * longer + 1e-9).cast("int")
    near = both.withColumn("most", limit).where("abs(length(x) - length(y)) <= most and levenshtein(x, y, most) >= 0")
    return near.select(F.col("a").alias("u"), F.col("b").alias("v"))


def drop_similar_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", distance: int = 3,
                       similarity: float = 0.8) -> DataFrame:
    """The documents without repeated lines, with ``n_lines`` and ``n_dropped`` (which replace columns of these names); other columns stay."""
    folder = shared_folder(docs.sparkSession)
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    rows = docs.select(*row_key(key, text), F.col(key).alias("key"), F.col(text).alias("text")).where("text is not null")
    # The number tells the occurrences apart while their words are counted: equal rows would add up.
    def split_up(part: DataFrame) -> DataFrame:
        out = part.select("k1", "k2", "key", F.posexplode(F.split("text", "\n")).alias("at", "line")).select(
            "k1", "k2", "key", "at", normalized(F.col("line")).alias("line"), F.monotonically_increasing_id().alias("place"))
        return out.where("line <> ''").select("k1", "k2", "key", "at", "place", "line", F.xxhash64("line").alias("id"),
                                              F.xxhash64(F.lit("second"), "line").alias("id2"))

    # A letter has two in lower case at most.
    lines = simhashes(split_up(rows), ["k1", "k2", "key", "at", "place", "id", "id2"],
                      split_up(rows.where(F.length("text") >= _NARROW)))
    lines = stored(lines.drop("place"), folder, "lines")
    place = F.struct(F.col("key").isNull().alias("none"), "key", "k1", "k2", "at")
    distinct = stored(lines.groupBy("id", "id2").agg(F.min(place).alias("one"), F.count("*").alias("n"), F.min("sim").alias("sim")),
                      folder, "distinct")
    sims = stored(distinct.groupBy("id").agg(F.min("sim").alias("sim")), folder, "sims")
    # Each line has a row for every pair of blocks; they are shuffled a few pairs at a time, so that less lies on disk at once.
    n = len(_block_masks(distance))
    buckets = reduce(DataFrame.unionByName, [stored(shared_buckets(sims, distance, range(at, min(at + 4, n))), folder, f"buckets_{at}")
                                             for at in range(0, n, 4)])

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        pairs = stored(pairs, folder, f"{name}_pairs")
        held = stored(texts_of(pairs, distinct, rows), folder, f"{name}_texts")
        return stored(linked(pairs, held, similarity), folder, name)

    groups = stored(components(verified(star_pairs(buckets, distance), "stars"), f"{folder}/star_groups"), folder, "grouped")
    edges = groups.where("node <> root").select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(
        verified(open_pairs(buckets, groups, distance), "others"))
    groups = components(edges, f"{folder}/groups")
    placed = distinct.join(groups, F.col("id") == F.col("node"), "left").select(
        "id", "id2", "one", "n", "root", F.coalesce("root", "id").alias("group"))
    keep = placed.where("root is not null").groupBy("group").agg(F.min("one").alias("kept"))
    placed = placed.where("n > 1 or root is not null").join(keep, "group", "left").select(
        "id", "id2", F.coalesce("kept", "one").alias("kept"))
    gone = lines.join(placed, ["id", "id2"]).where(
        "not (k1 = kept.k1 and k2 = kept.k2 and at = kept.at)").select("k1", "k2", "at").distinct()
    gone = stored(gone.groupBy("k1", "k2").agg(F.collect_list("at").alias("_gone")), folder, "gone")
    keyed = docs.select(F.struct(*names).alias("_doc"), *row_key(key, text)).hint("merge").join(gone, ["k1", "k2"], "left")
    # The document stays a struct: its columns may be named like the helpers here.
    whole = F.col(f"_doc.`{text}`")
    parts = F.split(whole, "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("_gone"))
    left = F.array_join(F.transform(stay, lambda i: F.get(parts, i)), "\n")
    return keyed.select(*[F.when(F.col("_gone").isNull(), whole).otherwise(left).alias(c) if c == text
                          else F.col(f"_doc.`{c}`").alias(c) for c in names],
                        F.when(whole.isNull(), 0).otherwise(F.size(parts)).cast("long").alias("n_lines"),
                        F.when(F.col("_gone").isNull(), 0).otherwise(F.size("_gone")).cast("long").alias("n_dropped"))
