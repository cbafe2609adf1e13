"""Benchmark decontamination: find the documents' words that repeat a test item's n-grams.

``contamination`` normalises both sides (A-Z lower-cased, words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``), cuts each
benchmark item into windows of ``n`` words (an item with fewer words, but not none, is one window) and scans every
document's windows against a hash set of them. A candidate is verified word by word, so hash collisions do no harm.

The set is broadcast while its item texts are proven to fit ``broadcast_bytes``. A larger benchmark is cut into as many
blocks as keep each under the bound; the documents are scanned once a block and the hits of all blocks are merged.

Defined results: null or word-less texts have no words, no hits and are not contaminated; null or word-less items never
occur; repeated items all count (the number counts distinct ids, a null id counts as none); repeated documents are
each judged alone; an empty benchmark marks nothing. Columns of other names pass through unchanged; the columns added
replace input columns of the same names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.common import giving_back, row_key, shared_folder, stored, text_bytes

# A-Z to a-z; every ASCII byte that is no word character to a space. Bytes from 0x80 on are word characters.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 else 32
              for b in range(256))
_SPANS = T.ArrayType(T.StructType([T.StructField("first_word", T.LongType()), T.StructField("end_word", T.LongType())]))
ADDED = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())), T.StructField("spans", _SPANS)])


def words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class NgramSet:
    """The windows of some items: word numbers, window hashes by length, and the exact windows for verification."""

    def __init__(self, items: list[tuple[str | None, bytes]], n: int):
        self.number: dict[bytes, int] = {}
        self.windows: dict[int, dict[bytes, set[str | None]]] = {}
        for item_id, text in items:
            ids = np.array([self.number.setdefault(w, len(self.number)) for w in words(text)], np.int64)
            if not len(ids):
                continue
            size = min(n, len(ids))
            for i in range(len(ids) - size + 1):
                self.windows.setdefault(size, {}).setdefault(ids[i:i + size].tobytes(), set()).add(item_id)
        self.hashes = {size: np.unique(np.array([_hash(np.frombuffer(w, np.int64)[None])[0] for w in found]))
                       for size, found in self.windows.items()}

    def scan(self, text: bytes) -> tuple[int, np.ndarray, set[str]]:
        """Number of words, the mask of hit words, ids of the items with an occurring window."""
        found = words(text)
        get, unknown = self.number.get, -1
        ids = np.fromiter((get(w, unknown) for w in found), np.int64, len(found))
        hit, items = np.zeros(len(ids), bool), set()
        gaps = np.flatnonzero(ids < 0)
        starts, ends = np.r_[0, gaps + 1], np.r_[gaps, len(ids)]
        for size, windows in self.windows.items():
            # Only runs of at least `size` benchmark words in a row can hold a window of that length.
            for a, b in zip(*(x[ends - starts >= size] for x in (starts, ends)), strict=True):
                run = np.lib.stride_tricks.sliding_window_view(ids[a:b], size)
                at = np.flatnonzero(np.isin(_hash(run), self.hashes[size]))
                for i in at:
                    if (of := windows.get(run[i].tobytes())) is not None:
                        hit[a + i:a + i + size] = True
                        items |= of
        return len(ids), hit, items - {None}


def _hash(rows: np.ndarray) -> np.ndarray:
    out = np.zeros(len(rows), np.uint64)
    for k in range(rows.shape[1]):
        out = (out ^ rows[:, k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def _spans(mask: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.r_[0, mask.astype(np.int8), 0]))
    return [{"first_word": int(a), "end_word": int(b)} for a, b in edge.reshape(-1, 2)]


def _scan(docs: DataFrame, text: str, broadcast) -> DataFrame:
    names = [c for c in docs.columns if c not in ADDED.names]
    schema = T.StructType([docs.schema[c] for c in names] + ADDED.fields)

    def run(batches):
        grams = broadcast.value
        for batch in batches:
            got = [grams.scan(t) for t in text_bytes(batch.column(batch.schema.get_field_index(text)))]
            added = [pa.array([g[0] for g in got], pa.int64()), pa.array([int(g[1].sum()) for g in got], pa.int64()),
                     pa.array([sorted(g[2]) for g in got], pa.list_(pa.string())),
                     pa.array([_spans(g[1]) for g in got],
                              pa.list_(pa.struct([("first_word", pa.int64()), ("end_word", pa.int64())])))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)) for c in names] + added, names=names + ADDED.names)

    return docs.select(names).mapInArrow(giving_back(run, ()), schema)


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", n: int = 13, per_hit: int = 20,
                  broadcast_bytes: int = 32 << 20) -> DataFrame:
    """Add ``n_words``, ``n_hit``, ``items`` (sorted ids as strings), ``spans`` (hit word runs) and ``contaminated``.

    A document is contaminated if it has hits and ``per_hit * n_hit >= n_words``. With several blocks (see above) the
    documents keep one row each: equal rows are counted and given back as often.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_id).cast("string").alias("item_id"), F.col(item_text).alias("text"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).first()[0]
    blocks = max(1, -(-size // broadcast_bytes))
    rows = docs.drop(*ADDED.names)
    if blocks > 1:
        rows = rows.withColumns(dict(zip(_KEYS, row_key(text), strict=True)))
    parts = []
    for block in range(blocks):
        mine = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        grams = NgramSet([(r[0], (r[1] or "").encode()) for r in mine.toLocalIterator()], n)
        parts.append(_scan(rows if not parts else rows.select(text, *_KEYS), text, spark.sparkContext.broadcast(grams)))
    out = parts[0] if blocks == 1 else _merged(parts)
    bad = (F.col("n_hit") > 0) & (per_hit * F.col("n_hit") >= F.col("n_words"))
    return out.withColumn("contaminated", bad)


#: Two hashes that stand for a text while the hits of several blocks are put together.
_KEYS = ("first key of the text", "second key of the text")


def _merged(parts: list[DataFrame]) -> DataFrame:
    """Add the hits that the further blocks of items have on the same text.

    Hits depend on the text alone: rows go through the first scan as they are and take the other blocks' hits by its key. Copies
    of a text give one and the same entry, removed before the shuffle.
    """
    out, others = parts[0], None
    for i, part in enumerate(parts[1:], 1):
        hits = part.where("n_hit > 0").select(*_KEYS, F.struct(F.lit(i).alias("block"), "items", "spans").alias("_h"))
        others = hits if others is None else others.unionByName(hits)
    folder = shared_folder(out.sparkSession)
    others = stored(others.groupBy(*_KEYS).agg(F.collect_set("_h").alias("hits of other blocks")), folder, "hits")
    found = out.join(others, list(_KEYS), "left").withColumn("hits of other blocks", F.coalesce("hits of other blocks", F.array()))
    spans = F.array_sort(F.flatten(F.concat(F.array("spans"), F.transform("hits of other blocks", lambda h: h["spans"]))))

    def add(done, s):
        last = F.element_at(done, -1)
        longer = F.struct(last["first_word"].alias("first_word"), F.greatest(last["end_word"], s["end_word"]).alias("end_word"))
        return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end_word"] >= s["first_word"]), F.concat(
            F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(longer))).otherwise(F.concat(done, F.array(s)))

    found = found.withColumns({
        "spans": F.aggregate(spans, F.array().cast(_SPANS), add),
        "items": F.array_sort(F.array_distinct(F.flatten(F.concat(F.array("items"), F.transform("hits of other blocks", lambda h: h["items"])))))})
    words = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end_word"] - s["first_word"])
    return found.withColumn("n_hit", words).drop("hits of other blocks", *_KEYS).select(*[c for c in out.columns if c not in _KEYS])


def without_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    names = docs.columns
    found = contamination(docs.withColumn("_doc", F.struct(*names)), benchmark, **options)
    return found.where(~F.col("contaminated")).select("_doc.*")
