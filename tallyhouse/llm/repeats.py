"""Exact substring dedup: find every byte covered by a ``length``-byte string that starts anywhere else too.

Texts are UTF-8 bytes and strings never cross documents. The classes of equal strings are refined in rounds, and what
is alone in its class leaves after each round:

1. *Anchors.* In every window of ``length`` bytes the hash-smallest ``anchor``-byte string (leftmost on ties) is the
   window's home. Equal windows have equal homes at equal offsets, so a window whose home string occurs once in the
   collection is not repeated. Anchors are about one per 140 bytes.
2. *Units.* The windows of a home are cut into units of ``UNIT`` neighbouring offsets. The bytes that all windows of a
   unit share (core) and the bytes that they cover together (hull) are hashed. A core that occurs once: no window of
   the unit is repeated. A hull that occurs twice: all are.
3. *Windows.* Only the windows of the remaining units, at the edges of repeated passages, are hashed and counted.

Counts are aggregations that reduce before their shuffle, so a passage shared by any number of documents never meets in
one task, and hashes that decide (hulls, windows) have 128 bits. Texts move only for documents that hold a repeated
anchor. See the README for why this stands in place of merging shard Burrows-Wheeler transforms.

Defined results: null and short texts have no windows and lose nothing; repeated rows are occurrences of their own (two
equal documents of at least ``length`` bytes are removed whole, both); an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import row_key, shared_folder, stored, text_bytes

UNIT = 32
_CHUNK = 1 << 20
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03))  # odd, so that they have inverses


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    return np.random.default_rng(20240229).integers(1, 2 ** 63, (2, 256), dtype=np.uint64)


@lru_cache(maxsize=8)
def _powers(n: int, which: int, inverse: bool) -> np.ndarray:
    base = int(_BASES[which])
    base = pow(base, -1, 1 << 64) if inverse else base
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class Hashes:
    """64-bit hashes of any substring of a buffer, from prefix sums of byte values times powers (modulo 2^64)."""

    def __init__(self, data: np.ndarray, which: int):
        self.room = 1 << max(16, int(len(data) + 1).bit_length())
        self.which = which
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_byte_values()[which][data] * _powers(self.room, which, False)[:len(data)], out=self.sums[1:])

    def at(self, start: np.ndarray, size) -> np.ndarray:
        return _mix((self.sums[start + size] - self.sums[start]) * _powers(self.room, self.which, True)[start])

    def all(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return _mix((self.sums[size:] - self.sums[:n]) * _powers(self.room, self.which, True)[:n])


def homes(h: np.ndarray, width: int) -> np.ndarray:
    """For each start the place of the smallest value among the next ``width``, the leftmost on ties."""
    best, reach = np.arange(len(h), dtype=np.int32), 1
    while reach < width:
        step = min(reach, width - reach)
        a, b = best[:-step], best[step:]
        best = np.where(h[b] < h[a], b, a)
        reach += step
    return best


class Chunk:
    """Some documents' bytes end to end, and the windows that lie inside one document."""

    def __init__(self, texts: list[bytes], length: int, anchor: int):
        sizes = np.array([len(t) for t in texts], np.int64)
        self.start = np.cumsum(sizes) - sizes
        data = np.frombuffer(b"".join(texts), np.uint8)
        self.length = length
        counts = np.maximum(sizes - length + 1, 0)
        self.doc = np.repeat(np.arange(len(texts)), counts)  # of each window
        self.window = np.repeat(self.start - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        self.one = Hashes(data, 0)
        if len(self.window):
            self.home = homes(self.one.all(anchor), length - anchor + 1)[self.window].astype(np.int64)
        else:
            self.home = self.window
        self.data = data

    def two(self) -> Hashes:
        return Hashes(self.data, 1)


def _chunks(batch: pa.RecordBatch, text: int):
    """Slices of a batch with about ``_CHUNK`` bytes of text, at least one row each."""
    texts = list(text_bytes(batch.column(text)))
    at, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > _CHUNK:
            yield batch.slice(at, i - at), texts[at:i]
            at, held = i, 0
        held += len(t)
    if texts[at:]:
        yield batch.slice(at), texts[at:]


def _lists(values: np.ndarray, doc: np.ndarray, n: int, kind=None) -> pa.ListArray:
    ends = np.searchsorted(doc, np.arange(n + 1))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values.astype(kind or np.int64)))


def _anchors(length: int, anchor: int):
    """Each document's anchors: hashes and places (k1, k2, hash list, place list)."""
    def run(batches):
        for batch in batches:
            for part, texts in _chunks(batch, 2):
                c = Chunk(texts, length, anchor)
                new = np.r_[True, (np.diff(c.home) != 0) | (np.diff(c.doc) != 0)] if len(c.home) else np.zeros(0, bool)
                home, doc = c.home[new], c.doc[new]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), _lists(c.one.at(home, anchor), doc, len(texts)),
                     _lists(home - c.start[doc], doc, len(texts))], names=["k1", "k2", "h", "at"])
    return run


def _units(length: int, anchor: int):
    """The units of repeated anchors: core, hull (two hashes), first window and number of windows."""
    def run(batches):
        for batch in batches:
            for part, texts in _chunks(batch, 2):
                c, hot = Chunk(texts, length, anchor), np.zeros(sum(map(len, texts)) + 1, bool)
                for i, places in enumerate(part.column(3).to_pylist()):
                    hot[c.start[i] + np.array(places, np.int64)] = True
                use = hot[c.home]
                window, home, doc = c.window[use], c.home[use], c.doc[use]
                level = (home - window) // UNIT
                new = np.flatnonzero(np.r_[True, (np.diff(home) != 0) | (np.diff(level) != 0) | (np.diff(doc) != 0)]
                                     ) if len(home) else np.zeros(0, np.int64)
                n = np.diff(np.r_[new, len(home)])
                first, home, level, doc = window[new], home[new], level[new], doc[new]
                two = c.two()
                core = c.one.at(home - level * UNIT, length - UNIT + 1)
                span = n + length - 1
                cols = [core, c.one.at(first, span), two.at(first, span), first - c.start[doc]]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *[_lists(x, doc, len(texts)) for x in cols],
                     _lists(n, doc, len(texts), np.int32)], names=["k1", "k2", "core", "h1", "h2", "at", "n"])
    return run


def _windows(length: int):
    """128-bit hashes of the windows of open units."""
    def run(batches):
        for batch in batches:
            for part, texts in _chunks(batch, 2):
                start = np.cumsum([0, *map(len, texts)])
                data = np.frombuffer(b"".join(texts), np.uint8)
                places, doc = [], []
                for i, units in enumerate(part.column(3).to_pylist()):
                    got = np.concatenate([np.arange(u["at"], u["at"] + u["n"]) for u in units])
                    places.append(got)
                    doc.append(np.full(len(got), i))
                place, doc = np.concatenate(places), np.concatenate(doc)
                at = place + start[doc]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(doc)), part.column(1).take(pa.array(doc)),
                     pa.array(Hashes(data, 0).at(at, length).astype(np.int64)),
                     pa.array(Hashes(data, 1).at(at, length).astype(np.int64)), pa.array(place)],
                    names=["k1", "k2", "h1", "h2", "at"])
    return run


def _report(length: int):
    """Removed spans and what is kept of each document, from its repeated runs of windows."""
    def run(batches):
        for batch in batches:
            rows = []
            for text, runs in zip(text_bytes(batch.column(2)), batch.column(3).to_pylist(), strict=True):
                edge = np.zeros(len(text) + 1, np.int64)
                first = np.array([r["at"] for r in runs])
                np.add.at(edge, first, 1)
                np.add.at(edge, first + np.array([r["n"] for r in runs]) + length - 1, -1)
                gone = np.cumsum(edge[:-1]) > 0
                ends = np.flatnonzero(np.diff(np.r_[0, gone.astype(np.int8), 0])).reshape(-1, 2)
                kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
                rows.append(([{"start": int(a), "end": int(b)} for a, b in ends], int(gone.sum()),
                             hashlib.sha256(kept).hexdigest()))
            spans, removed, digest = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                 pa.array(removed, pa.int64()), pa.array(digest, pa.string())],
                names=["k1", "k2", "spans", "n_removed", "kept_sha256"])
    return run


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 400,
                   anchor: int = 128) -> DataFrame:
    """``k1, k2`` (see ``row_key``), ``spans``, ``n_removed``, ``kept_sha256`` of documents that lose bytes.

    One row for each different (key, text); spans are half-open byte ranges, maximal and in order. ``anchor`` is at
    most ``length - UNIT + 1``.
    """
    folder = shared_folder(docs.sparkSession)
    if not UNIT <= anchor <= length - UNIT + 1:
        raise ValueError("anchor must lie between the unit and what a unit's windows share")
    rows = docs.select(*row_key(key, text), F.col(text).alias("text")).where(F.octet_length("text") >= length)
    found = stored(rows.mapInArrow(_anchors(length, anchor), "k1 long, k2 long, h array<long>, at array<long>"),
                   folder, "anchors")
    each = found.select("k1", "k2", F.explode(F.arrays_zip("h", "at")).alias("a")).select("k1", "k2", "a.h", "a.at")
    twice = each.groupBy("h").agg(F.count("*").alias("c")).where("c > 1").select("h")
    hot = each.join(twice, "h").groupBy("k1", "k2").agg(F.collect_set("at").alias("places"))
    # Equal rows carry equal places; `times` keeps the number of their occurrences for the counts that follow.
    times = found.groupBy("k1", "k2").agg(F.count("*").alias("times")).where("times > 1")
    hot = stored(hot.join(times, ["k1", "k2"], "left"), folder, "hot")
    texts = rows.join(hot, ["k1", "k2"]).dropDuplicates(["k1", "k2"]).select(
        "k1", "k2", "text", "places", F.coalesce("times", F.lit(1)).alias("times"))
    texts = stored(texts, folder, "candidates")
    many = texts.where("times > 1").select("k1", "k2", "times")

    fields = "core array<long>, h1 array<long>, h2 array<long>, at array<long>, n array<int>"
    units = texts.select("k1", "k2", "text", "places").mapInArrow(_units(length, anchor), f"k1 long, k2 long, {fields}")
    units = stored(units, folder, "units").join(many, ["k1", "k2"], "left").select(
        "k1", "k2", F.coalesce("times", F.lit(1)).alias("times"),
        F.explode(F.arrays_zip("core", "h1", "h2", "at", "n")).alias("u")).select("k1", "k2", "times", "u.*")
    hulls = units.groupBy("core", "h1", "h2").agg(
        F.sum("times").alias("hull"), F.min(F.struct("k1", "k2", "at", "n")).alias("one"))
    hulls = stored(hulls, folder, "hulls")
    cores = hulls.groupBy("core").agg(F.sum("hull").alias("seen"), F.min("hull").alias("least")).where("seen > 1")
    state = stored(hulls.join(cores, "core").select(
        "core", "h1", "h2", "one", "least", (F.col("hull") > 1).alias("whole")), folder, "state")
    judged = stored(units.join(state, ["core", "h1", "h2"]).select("k1", "k2", "at", "n", "whole"), folder, "judged")

    run = F.struct("at", "n")
    # Of repeated hulls that share their core with an open unit one occurrence is hashed too, as a partner to meet.
    asking = judged.where("not whole").select("k1", "k2", "at", "n").unionByName(
        state.where("whole and least = 1").select("one.*"))
    open_ = asking.groupBy("k1", "k2").agg(F.collect_list(run).alias("units"))
    asked = texts.join(open_, ["k1", "k2"]).select("k1", "k2", "text", "units").mapInArrow(
        _windows(length), "k1 long, k2 long, h1 long, h2 long, at long")
    asked = stored(asked, folder, "windows")
    again = asked.groupBy("h1", "h2").agg(F.count("*").alias("c")).where("c > 1").select("h1", "h2")
    single = asked.join(again, ["h1", "h2"]).select("k1", "k2", "at", F.lit(1).alias("n"))
    runs = judged.where("whole").select("k1", "k2", "at", "n").unionByName(single).groupBy("k1", "k2").agg(
        F.collect_list(run).alias("runs"))
    out = texts.join(runs, ["k1", "k2"]).select("k1", "k2", "text", "runs").mapInArrow(
        _report(length), "k1 long, k2 long, spans array<struct<start:long,end:long>>, n_removed long, kept_sha256 string")
    return stored(out, folder, "spans")


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents with the repeated bytes cut out of their text (broken characters become U+FFFD)."""
    names = docs.columns
    spans = repeated_spans(docs, key, text, **options).select("k1", "k2", "spans")
    keyed = docs.select(F.struct(*names).alias("_doc"), *row_key(key, text)).join(spans, ["k1", "k2"], "left")
    # The document stays a struct: its columns may be named like the helpers here.
    whole = F.col(f"_doc.`{text}`")
    starts = F.concat(F.array(F.lit(0).cast("long")), F.transform("spans", lambda s: s["end"]))
    ends = F.concat(F.transform("spans", lambda s: s["start"]), F.array(F.octet_length(whole).cast("long")))
    parts = F.transform(F.arrays_zip(starts.alias("a"), ends.alias("b")), lambda p: F.substring(
        F.encode(whole, "UTF-8"), (p["a"] + 1).cast("int"), (p["b"] - p["a"]).cast("int")))
    cut = F.decode(F.aggregate(parts, F.encode(F.lit(""), "UTF-8"), lambda x, y: F.concat(x, y)), "UTF-8")
    return keyed.select(*[F.when(F.col("spans").isNull(), whole).otherwise(cut).alias(c) if c == text
                          else F.col(f"_doc.`{c}`").alias(c) for c in names])
