"""N-gram Jaccard join: a MinHash LSH forest finds candidates, exact verification, groups and link counts.

1. Every text becomes its set of word n-grams (64-bit hashes; a text of fewer words is one n-gram). Texts with equal
   sets are copies; they meet at once as equal sets, so the size of a group of copies costs nothing later.
2. Each set gets a label of ``depth`` MinHash values (16 bits of each) in every one of ``trees`` prefix tries. A trie is its labels in sorted
   order: one range sort puts all tries in order, and each label's longest matched prefixes are those with its neighbours. A
   neighbour pair with a common prefix is an edge of that length; a trie node's sets are a run of edges, so a node of any size is
   linked by one edge per set. Ranges are cut anywhere, their ends are put together from two rows a range.
3. Matching starts with whole labels: sets connected by edges of full length are candidate groups, verified as below. Then
   prefixes are shortened as far as the links found so far ask for, and in groups that grew the pairs not compared yet are
   verified, until the recall is reached. A verified link
   of similarity s would have been met at length d by 1 - (1 - s^d)^trees of such pairs, so each stands for
   so many missed ones; the estimate of all missed links decides (chance meetings through third sets only make it too
   cautious). The shortest length ever needed is the one at which links at the threshold itself are met with that recall.
4. Inside a candidate group all sets are compared exactly, in pairs of blocks of at most ``block`` sets, so that no task
   holds a group. A block pair gives each set's number of links and a spanning forest of the links: rows stay in
   proportion to sets and blocks. The links' components are the classes.

Defined results: texts without words (null, empty) are never linked, each row is its own class; repeated rows are
copies; the class id is the smallest key in the class (a null key never is, unless all are null); links count the other
different sets with similarity of at least the threshold; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import giving_back, row_key, shared_folder, stored
from tallyhouse.llm.components import components

_WORD = re.compile(r"\w+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, n: int, known: dict[str, int]) -> np.ndarray:
    """Sorted distinct hashes of the text's word n-grams (lower case, runs of word characters)."""
    found = _WORD.findall(text.lower()) if text else []
    if not found:
        return np.zeros(0, np.uint64)
    h = np.fromiter((known.get(w) or _word_hash(w, known) for w in found), np.uint64, len(found))
    size = min(n, len(h))
    out = np.full(len(h) - size + 1, size, np.uint64)
    for k in range(size):
        out = _scramble(out * _MIX + h[k:len(h) - size + 1 + k])
    return np.unique(out)


def _word_hash(word: str, known: dict[str, int]) -> int:
    import xxhash
    if len(known) > 300_000:
        known.clear()
    known[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass")) | 1
    return known[word]


def level(threshold: float, trees: int, depth: int, recall: float) -> int:
    """Longest label prefix at which sets of similarity ``threshold`` meet in a tree with probability ``recall``."""
    for d in range(depth, 0, -1):
        if 1 - (1 - threshold ** d) ** trees >= recall:
            return d
    raise ValueError("more trees are needed for this recall")


def _signatures(n: int, trees: int, depth: int, seed: int = 3):
    """Per text: set digest (two longs), set size, and its label in each tree, two bytes a value."""
    values = _scramble(np.arange(1, trees * depth + 1, dtype=np.uint64) * _MIX + np.uint64(seed)) | np.uint64(1)

    def run(batches):
        known: dict[str, int] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                rows, labels = [], []
                for text in part.column(part.num_columns - 1):
                    s = shingles(text.as_py(), n, known)
                    if not len(s):
                        rows.append((None, None, 0, 0))
                        continue
                    low = np.full(len(values), np.iinfo(np.uint64).max, np.uint64)
                    for a in range(0, len(s), 256):  # minima of products with odd numbers, a cache-sized piece at a time
                        low = np.minimum(low, (s[a:a + 256, None] * values).min(0))
                    labels.append((_scramble(low) >> np.uint64(48)).astype(">u2").tobytes())
                    digest = _scramble(s), _scramble(s * _MIX + np.uint64(7))
                    one, two = (int(np.add.reduce(x, dtype=np.uint64).astype(np.int64)) for x in digest)
                    rows.append((one, two, len(s), trees))
                s1, s2, size, counts = zip(*rows, strict=True)
                flat = pa.Array.from_buffers(pa.binary(2 * depth), trees * len(labels), [None, pa.py_buffer(b"".join(labels))])
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)], pa.int32()), flat.cast(pa.binary()))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(s1, pa.int64()), pa.array(s2, pa.int64()), pa.array(size, pa.int64()), lists],
                    names=[*part.schema.names[:-1], "s1", "s2", "n_grams", "labels"])
    return run


def _neighbours(depth: int, least: int):
    """Edges between neighbours of sorted (tree, label, id) rows: ``u, v, common`` for ``common`` of at least ``least`` values.

    The first and the last row of the partition come out too, for the edges between partitions.
    """
    def run(batches):
        from pyspark import TaskContext
        part, last = TaskContext.get().partitionId(), None
        for batch in batches:
            tree, ids = batch.column(0).to_numpy().astype(np.int64), batch.column(2).to_numpy()
            label = np.frombuffer(b"".join(batch.column(1).to_pylist()), ">u2").reshape(-1, depth)
            if last is None and len(ids):
                yield _ends(part, 1, tree[0], label[0], ids[0])
            elif len(ids):
                tree, label, ids = np.r_[last[0], tree], np.concatenate([last[1], label]), np.r_[last[2], ids]
            if not len(ids):
                continue
            same = (tree[1:] == tree[:-1])[:, None] & (label[1:] == label[:-1])
            common = np.cumprod(same, axis=1).sum(1)
            keep = (common >= least) & (ids[1:] != ids[:-1])
            u, v = ids[1:][keep], ids[:-1][keep]
            none = pa.nulls(len(u))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.maximum(u, v)), pa.array(np.minimum(u, v)), pa.array(common[keep].astype(np.int32)),
                none.cast(pa.int32()), none.cast(pa.int32()), none.cast(pa.int32()), none.cast(pa.binary())], names=_EDGE_NAMES)
            last = tree[-1:], label[-1:], ids[-1:]
        if last is not None:
            yield _ends(part, 2, last[0][0], last[1][0], last[2][0])
    return run


_EDGES = "u long, v long, common int, part int, place int, tree int, label binary"
_EDGE_NAMES = ["u", "v", "common", "part", "place", "tree", "label"]


def _ends(part, place, tree, label, set_id) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array([set_id], pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), pa.array([part], pa.int32()),
        pa.array([place], pa.int32()), pa.array([tree], pa.int32()), pa.array([label.tobytes()], pa.binary())], names=_EDGE_NAMES)


def forest(member: DataFrame, depth: int, least: int, folder: str) -> DataFrame:
    """``u, v, common``: the edges of the sorted prefix tries of ``id, labels``, with the most values in common."""
    rows = member.select("id", F.posexplode("labels").alias("tree", "label")).select("tree", "label", "id")
    order = ("tree", "label", "id")
    raw = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_neighbours(depth, least), _EDGES),
                 folder, "tries")
    # Two rows a partition, in order: the last row of one and the first of the next are neighbours.
    w = Window.orderBy("part", "place")
    ends = raw.where("place is not null").select(
        "place", "u", "tree", "label", F.lag("u").over(w).alias("v"), F.lag("tree").over(w).alias("_t"), F.lag("label").over(w).alias("_l"))
    common = sum((F.when(F.substring("label", 1, 2 * d) == F.substring("_l", 1, 2 * d), 1).otherwise(0)
                  for d in range(1, depth + 1)), F.lit(0))
    between = ends.where("place = 1 and tree = _t and u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"), common.cast("int").alias("common")).where(F.col("common") >= least)
    edges = raw.where("place is null").select("u", "v", "common").unionByName(between)
    return stored(edges.groupBy("u", "v").agg(F.max("common").alias("common")), folder, "trie_edges")


def _compare(threshold: float, n: int, trees: int, lengths: list[int]):
    """Exact links between the sets of one pair of blocks, those with the same ``old`` group left out: (id, top, links, missed).

    ``missed`` is the number of links that those found here stand for, were they met at each prefix length.
    """
    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        known: dict[str, int] = {}
        ids, side, old = (rows.column(c).to_numpy() for c in ("id", "side", "old"))
        same = bool(rows.column("same")[0].as_py())
        sets = [shingles(t.as_py(), n, known) for t in rows.column("text")]
        size = np.array([len(s) for s in sets])
        flat = np.concatenate(sets)
        _, code = np.unique(flat, return_inverse=True)
        ends = np.cumsum(size)
        codes = [code[e - k:e] for e, k in zip(ends, size, strict=True)]
        right = np.arange(len(ids)) if same else np.flatnonzero(side == 1)
        left = right if same else np.flatnonzero(side == 0)
        links, group, missed = np.zeros(len(ids), np.int64), np.arange(len(ids)), np.zeros((len(ids), len(lengths)))
        if len(left) and len(right):
            held = np.concatenate([codes[j] for j in right])
            begin = np.cumsum(size[right]) - size[right]
            mark = np.zeros(int(code.max()) + 1, bool)
            for i in left:
                mark[codes[i]] = True
                both = np.add.reduceat(mark[held].astype(np.int64), begin)
                mark[codes[i]] = False
                union = size[i] + size[right] - both
                near = (both >= threshold * union - 1e-9) & (old[right] != old[i])
                if same:
                    near &= right > i
                alike = both[near] / union[near]
                for k, length in enumerate(lengths):
                    lost = (1 - alike ** length) ** trees
                    missed[i, k] += (lost / (1 - lost)).sum()
                near = right[near]
                links[i] += len(near)
                links[near] += 1
                met = np.unique(group[np.r_[i, near]])
                if len(met) > 1:
                    group[np.isin(group, met)] = met[0]
        tops = group
        some = links > 0
        return pa.table({"id": pa.array(ids[some]), "top": pa.array(ids[tops[some]]), "links": pa.array(links[some]),
                         "missed": pa.array(list(missed[some]), pa.list_(pa.float64()))})
    return run


def linked(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 5, threshold: float = 0.8,
           trees: int = 32, depth: int = 8, recall: float = 0.99999, block: int = 200) -> DataFrame:
    """Every row's ``k1, k2`` (see ``row_key``), ``key``, ``n_grams``, ``class_id`` and ``links``."""
    found = _classed(docs, key, text, n, threshold, trees, depth, recall, block)
    # Written, so that the join deals both sides itself and splits a class of very many rows.
    lowest = stored(found.where("_class is not null").groupBy(F.col("_class").alias("_of")).agg(F.min("key").alias("_lowest")),
                    shared_folder(docs.sparkSession), "lowest")
    out = found.join(lowest, F.col("_class") == F.col("_of"), "left")
    return out.select("k1", "k2", "key", "n_grams", F.when(F.col("_class").isNull(), F.col("key")).otherwise(
        F.col("_lowest")).alias("class_id"), F.coalesce("links", F.lit(0)).cast("long").alias("links"))


def _classed(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 5, threshold: float = 0.8,
             trees: int = 32, depth: int = 8, recall: float = 0.99999, block: int = 200) -> DataFrame:
    """Every row's ``k1, k2, key, n_grams, links`` and ``_class``, the smallest set id of its class (null without words).

    Keys do not name classes: they may be null or repeat with other texts.
    """
    spark = docs.sparkSession
    folder = shared_folder(spark)
    least = level(threshold, trees, depth, recall)
    id_type = docs.schema[key].dataType.simpleString()
    rows = docs.select(*row_key(key, text), F.col(key).alias("key"), F.col(text).alias("text"))
    marked = rows.mapInArrow(giving_back(_signatures(n, trees, depth), ()), f"k1 long, k2 long, key {id_type}, s1 long, s2 long, "
                             "n_grams long, labels array<binary>")
    marked = stored(marked, folder, "signatures")
    # A set's id is a hash of its digest: copies share it.
    member = marked.where("n_grams > 0").select(F.xxhash64("s1", "s2").alias("id"), "k1", "k2", "labels")
    edges = forest(member, depth, least, folder)
    one = stored(member.join(edges.select(F.explode(F.array("u", "v")).alias("id")).distinct(), "id", "left_semi").groupBy(
        "id").agg(F.min(F.struct("k1", "k2")).alias("k")).select("id", "k.*"), folder, "representatives")
    links = before = None
    lengths = list(range(depth, least - 1, -1))
    turn, done = 0, False
    while not done:
        length, place = lengths[turn], f"{folder}/length_{lengths[turn]}"
        groups = stored(components(edges.where(F.col("common") >= length).select("u", "v"), f"{place}/candidates").withColumnRenamed(
            "node", "id"), place, "groups")
        if before is None:
            grown = groups.withColumn("old", F.col("id"))
        else:
            # A group with the same smallest set and as many sets has not changed; in the others only sets that were in different
            # groups are compared.
            sizes, known = (g.groupBy("root").agg(F.count("*").alias("sets")) for g in (groups, before))
            grown = groups.join(sizes.join(known, ["root", "sets"], "left_anti"), "root", "left_semi").join(
                before.select("id", F.col("root").alias("_was")), "id", "left").select("id", "root", F.coalesce("_was", "id").alias("old"))
        before = groups
        fresh = _links(docs, one, grown, key, text, n, threshold, block, trees, lengths, place)
        links = fresh if links is None else links.unionByName(fresh)
        found, *missed = links.agg(F.coalesce(F.sum("links"), F.lit(0)) / 2, *[
            F.coalesce(F.sum(F.get("missed", F.lit(k))), F.lit(0.0)) for k in range(len(lengths))]).first()
        # The longest prefixes that reach the recall for links like those found; nothing found yet tells nothing.
        enough = next((k for k in range(turn, len(lengths)) if found and missed[k] <= (1 - recall) * found), len(lengths) - 1)
        turn, done = enough, enough == turn
    classes = components(links.select(F.col("id").alias("u"), F.col("top").alias("v")), f"{folder}/classes")
    degree = links.groupBy(F.col("id").alias("node")).agg(F.sum("links").alias("links"))
    found = stored(degree.join(classes, "node", "left"), folder, "classes_of_sets")
    out = marked.withColumn("_id", F.when(F.col("n_grams") > 0, F.xxhash64("s1", "s2"))).drop("labels", "s1", "s2")
    out = out.join(found, F.col("_id") == F.col("node"), "left")
    return out.select("k1", "k2", "key", "n_grams", "links", F.coalesce("root", "_id").alias("_class"))


def _links(docs, one, groups, key, text, n, threshold, block, trees, lengths, folder) -> DataFrame:
    """``id, top, links, missed`` from exact comparison, in pairs of blocks, of the sets of each group (``id, root, old``) with
    the sets of other old groups.

    An old group of more than ``block`` sets has blocks of its own, which do not meet one another again.
    """
    old = groups.groupBy("root", "old").agg(F.count("*").alias("n"))
    old = old.withColumn("part", F.when(F.col("n") > block, F.col("old")))
    parts = old.groupBy("root", "part").agg(F.ceil(F.sum("n") / block).cast("long").alias("blocks"))
    w = Window.partitionBy("root")  # one row per large old group
    parts = parts.select("root", "part", "blocks", F.sum("blocks").over(w).alias("all"), (F.sum("blocks").over(
        w.orderBy(F.col("part").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)) - F.col("blocks")).alias("first"))
    large = old.where("part is not null").select("root", "old", "part")
    placed = groups.join(large, ["root", "old"], "left")
    placed = placed.join(parts.withColumnsRenamed({"root": "_root", "part": "_part"}), (
        F.col("root") == F.col("_root")) & F.col("part").eqNullSafe(F.col("_part"))).drop("_root", "_part")
    inside = stored(placed.join(one, "id"), folder, "inside")
    # The texts of candidates only; one row stands for each set.
    texts = docs.select(*row_key(key, text), F.col(text).alias("text"))
    # Shuffled at every size: how many candidates there are does not choose the plan.
    texts = inside.join(texts.hint("merge"), ["k1", "k2"]).dropDuplicates(["id"])
    mine = F.col("first") + F.pmod(F.xxhash64("id", F.lit(1)), F.col("blocks"))
    own = F.col("part").isNotNull()
    others = F.filter(F.sequence(F.lit(0).cast("long"), F.col("all") - 1), lambda x: ~(
        own & (x >= F.col("first")) & (x < F.col("first") + F.col("blocks"))))
    dealt = texts.withColumn("mine", mine).withColumn("other", F.explode(others)).select(
        "id", "old", "text", "root", F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b"),
        (F.col("mine") > F.col("other")).cast("int").alias("side"), (F.col("mine") == F.col("other")).alias("same"))
    return stored(dealt.groupBy("root", "a", "b").applyInArrow(
        _compare(threshold, n, trees, lengths), "id long, top long, links long, missed array<double>"), folder, "links")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of each class, with its own columns: the one with the smallest key, text and other columns."""
    names = docs.columns
    found = _classed(docs, key, text, **options)
    chosen = found.groupBy(F.col("_class").alias("c"), F.when(F.col("n_grams") == 0, F.struct("k1", "k2")).alias("e")).agg(
        F.min(F.struct(F.col("key").isNull().alias("none"), "key", "k1", "k2")).alias("k")).select("k.k1", "k.k2")
    keyed = docs.select(F.struct(*names).alias("_doc"), *row_key(key, text))
    return keyed.hint("merge").join(chosen, ["k1", "k2"]).select("k1", "k2", "_doc").dropDuplicates(["k1", "k2"]).select("_doc.*")
