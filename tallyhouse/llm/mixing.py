"""Mixing sources to target weights with balanced sampling by the cube method.

Every source gets a target number of words: a weighted share of ``share`` times all words, capped at ``most`` times the
source's own words, what the caps leave over being shared again by weight. The ratio of target to size is each
document's expected number of copies; its whole part is taken outright and the fraction is the inclusion probability
of one more copy. The cube method draws those copies: the vector of probabilities moves inside the null space of the
balancing constraints (documents and words of the source) until every coordinate but at most two is 0 or 1, so both
totals of the sample equal their expectations up to that rest.

The flight runs in bounded blocks: a source's documents are dealt to blocks of about ``block`` rows by a hash of the
row, each block flies alone and leaves at most two fractional documents, and those meet in the next round's blocks, and
so on until one block holds a source's rest, where the landing drops the document total and then settles the last
document by its probability. No task ever holds a source. Random numbers come from the seed and the block's rows, so
reruns agree.

Defined results: a null or empty text has size 0; the null source is a source, last in order; an empty table gives no
rows; rows equal in key, source and text are drawn as one unit and get the same number of copies; sources of size 0 have target 0 and take
nothing.
"""

from __future__ import annotations

import random
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import row_key, shared_folder, stored

_EDGE = 1e-9
_STATE = "k1 long, k2 long, source string, size long, p double"


def word_count(text: str = "text"):
    """Number of runs of characters that are no ASCII white space; 0 for null."""
    return F.coalesce(F.expr(f"regexp_count(`{text}`, '[^\\\\x20\\\\x09-\\\\x0D]+')"), F.lit(0)).cast("long")


def targets(sizes: dict[str | None, int], weights: tuple[float, ...], share: float, most: float) -> dict[str | None, float]:
    """Target of each source; sources in code-point order, null last, take the weights in turn."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out: dict[str | None, float] = {}
    free, rest = list(order), share * sum(sizes.values())
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if rest * weight[s] / total > most * sizes[s]]
        if not over:
            out |= {s: rest * weight[s] / total for s in free}
            break
        out |= {s: most * float(sizes[s]) for s in over}
        rest = max(0.0, rest - sum(out[s] for s in over))
        free = [s for s in free if s not in out]
    return out


def fly(p: list[float], sizes: list[int], rng: random.Random) -> list[int]:
    """Move ``p`` in place until at most two coordinates are fractional; returns their places.

    Three open documents have a direction that leaves both the sum of probabilities and the sum of size times
    probability unchanged; a step along it, one way or the other with the odds that keep every expectation, ends when
    a coordinate reaches 0 or 1.
    """
    open_: list[int] = []
    for i in range(len(p)):
        if not _EDGE < p[i] < 1 - _EDGE:
            p[i] = float(round(p[i]))
            continue
        open_.append(i)
        while len(open_) == 3:
            _step(p, open_, _direction([sizes[j] for j in open_]), rng)
            open_ = [j for j in open_ if 0.0 < p[j] < 1.0]
    return open_


def _direction(x: list[int]) -> list[float]:
    u = [float(x[1] - x[2]), float(x[2] - x[0]), float(x[0] - x[1])]  # at right angles to (1,1,1) and the sizes
    top = max(map(abs, u))
    return [v / top for v in u] if top else [1.0, -1.0, 0.0]


def _step(p: list[float], at: list[int], u: list[float], rng: random.Random) -> None:
    ahead = min((1 - p[j]) / v if v > 0 else p[j] / -v for j, v in zip(at, u, strict=True) if v)
    back = min(p[j] / v if v > 0 else (1 - p[j]) / -v for j, v in zip(at, u, strict=True) if v)
    step = ahead if rng.random() * (ahead + back) < back else -back
    for j, v in zip(at, u, strict=True):
        q = p[j] + step * v
        p[j] = 0.0 if q < _EDGE else 1.0 if q > 1 - _EDGE else q


def land(p: list[float], open_: list[int], sizes: list[int], rng: random.Random) -> None:
    """Settle the last fractional documents: keep the word total as long as two are open, then draw the last."""
    while len(open_) >= 2:
        a, b = open_[:2]
        u = [float(sizes[b]), -float(sizes[a])] if sizes[a] or sizes[b] else [1.0, -1.0]
        top = max(map(abs, u))
        _step(p, [a, b], [v / top for v in u], rng)
        open_ = [j for j in open_ if 0.0 < p[j] < 1.0]
    for j in open_:
        p[j] = 1.0 if rng.random() < p[j] else 0.0


def _flight(seed: int, last: bool):
    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("k1", "ascending"), ("k2", "ascending")])
        k1, k2, source, size, p = (rows.column(c).to_pylist() for c in ("k1", "k2", "source", "size", "p"))
        rng = random.Random(zlib.crc32(f"{seed} {last} {k1[0]} {k2[-1]} {len(k1)}".encode()))
        turn = sorted(range(len(p)), key=lambda i: (zlib.crc32(f"{seed} {k1[i]}".encode()), i))
        x, q = [size[i] for i in turn], [p[i] for i in turn]
        open_ = fly(q, x, rng)
        if last:
            land(q, open_, x, rng)
        return pa.table({"k1": pa.array([k1[i] for i in turn], pa.int64()), "k2": pa.array([k2[i] for i in turn], pa.int64()),
                         "source": pa.array([source[i] for i in turn], pa.string()),
                         "size": pa.array(x, pa.int64()), "p": pa.array(q, pa.float64())})
    return run


def cube_sample(rows: DataFrame, seed: int = 7, block: int = 4000, folder: str | None = None) -> DataFrame:
    """Draw 0 or 1 for each row of ``(k1, k2, source, size, p)``: the same rows with ``p`` settled.

    Each round reads only what the round before left open; the number of rounds grows with the logarithm of the rows.
    """
    spark = rows.sparkSession
    folder = folder or shared_folder(spark)
    done, open_, turn = None, rows, 0
    fractional = (F.col("p") > 0) & (F.col("p") < 1)
    while True:
        counts = open_.where(fractional).groupBy("source").count().collect()  # one row a source
        blocks = [(r["source"], max(1, -(-r["count"] // block))) for r in counts]
        last = all(n == 1 for _, n in blocks)
        known = spark.createDataFrame(blocks, "_s string, _n long")
        dealt = open_.join(known, F.col("source").eqNullSafe(F.col("_s")), "left").withColumn(
            "_block", F.pmod(F.xxhash64("k1", "k2", F.lit(seed + turn)), F.coalesce("_n", F.lit(1))))
        # Settled rows (whole probabilities) need no flight and stay out of the shuffle.
        moved = dealt.where(fractional).groupBy("source", "_block").applyInArrow(_flight(seed + turn, last), _STATE)
        moved = stored(moved.unionByName(open_.where(~fractional).select("k1", "k2", "source", "size", "p")),
                       folder, f"flight_{turn}")
        settled = moved if last else moved.where(~fractional)
        done = settled if done is None else done.unionByName(settled)
        if last:
            return done
        open_, turn = moved.where(fractional), turn + 1


def draws(docs: DataFrame, keep: tuple[str, ...] = (), key: str = "doc_id", text: str = "text", source: str = "source",
          weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: int = 7,
          block: int = 4000) -> DataFrame:
    """``k1, k2`` (see ``row_key``), the ``keep`` columns, ``size, source_size, target, copies`` of every document.

    The totals of the sources (one row each) go through the driver; documents do not.
    """
    spark = docs.sparkSession
    folder = shared_folder(spark)
    light = docs.select(*keep, *row_key(key, source, text), F.col(source).cast("string").alias("_source"),
                        word_count(text).alias("_size"))
    light = stored(light, folder, "sizes")
    totals = {r[0]: r[1] for r in light.groupBy("_source").agg(F.sum("_size")).collect()}
    aim = targets(totals, weights, share, most)
    rates = spark.createDataFrame([(s, n, aim[s], aim[s] / n if n else 0.0) for s, n in totals.items()],
                                  "_s string, source_size long, target double, _rate double")
    units = light.groupBy("k1", "k2", F.col("_source").alias("source")).agg(F.sum("_size").alias("size"))
    units = units.join(rates, F.col("source").eqNullSafe(F.col("_s")), "left")
    drawn = cube_sample(units.select("k1", "k2", "source", "size", (F.col("_rate") % 1).alias("p")), seed, block, folder)
    out = light.join(rates, F.col("_source").eqNullSafe(F.col("_s")), "left").join(
        drawn.select("k1", "k2", F.col("p").alias("_p")), ["k1", "k2"], "left")
    copies = F.floor("_rate") + F.coalesce(F.col("_p"), F.lit(0.0))
    return out.select("k1", "k2", *keep, F.col("_size").alias("size"), "source_size", "target",
                      copies.cast("int").alias("copies"))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mixed collection: every document as many times as it is drawn, with its own columns."""
    names = docs.columns
    drawn = draws(docs, key=key, text=text, source=source, **options).where("copies > 0")
    drawn = drawn.groupBy("k1", "k2").agg(F.max("copies").alias("_copies"))
    keyed = docs.select(F.struct(*names).alias("_doc"), *row_key(key, source, text))
    taken = keyed.hint("merge").join(drawn, ["k1", "k2"])
    return taken.select("_doc", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select("_doc.*")
