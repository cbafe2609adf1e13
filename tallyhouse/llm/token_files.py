"""Token-id output: Parquet list columns of token ids, written in document order, readable column by column.

``write_tokens`` sorts the documents by key over range partitions, encodes each whole text with a tokenizer of the
``tokenizers`` library, appends the end id and writes ``(key, n_tokens, offset in the file, tokens, + metadata columns)`` through
Spark's Parquet writer: data page version 2, small metadata columns with dictionaries, token lists delta-encoded (or with a
dictionary), row groups and pages of a stated size, and the column and page indexes that let a reader skip pages by key.
The files of one write are in ascending key order by the task number in their names. ``read_tokens`` reads them back and derives the global start
of each document from file totals and the offset stored with it, so a reader can ask for starts without reading
the token column, or for the tokens of a key range without reading the other pages.

Defined results: a null text is the empty text (just the end id); an empty table writes no rows; rows repeating a key
all stay, in an order fixed by their text; null keys come first; metadata columns clashing with ``n_tokens``, ``offset`` or ``tokens`` are
left out, other columns can be asked for with ``keep``.
"""

from __future__ import annotations

import itertools
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.common import give_back, giving_back, kept, shared_folder, small_batches

# Characters that no tokenizer rule counts as white space start a piece after a blank or a line break.
_CUT = re.compile(r" (?=[^\s\x00-\x20\x7f-\xa0])")
_PLAIN = r"^\n?[^\x00-\x20\x7f-\xa0\s\p{Z}]"
# A word and the punctuation after it are separate tokens; a quote may start a contraction.
_STOPS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")
_STEM = "[0-9A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]$"
_FIRST = "\x01"  # marks pieces that no blank precedes
_SLICE = 1 << 21  # bytes of text encoded at a time


def _long(piece: str) -> bool:
    """Whether a piece is too long to be remembered."""
    return len(piece) > 100


class Encoder:
    """Encode texts piece by piece with a byte-level BPE, remembering the ids of up to ``memory`` pieces.

    Such a tokenizer never joins what precedes a blank or a line break with the word after it, so a text's ids are the ids
    of its pieces, cut before blanks and line breaks that a visible character follows. Arrow cuts many texts at once and
    lists their different pieces; those not remembered go through the tokenizer, many in one string, and the byte lengths
    of the ids tell where each piece ends. Texts with other white space are cut one by one.
    """

    def __init__(self, path: str, memory: int = 400_000):
        from tokenizers import Tokenizer
        self.tokenizer, self.memory = Tokenizer.from_file(path), memory
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.sizes[i] = len(token)  # byte-level: a character of the token's name is a byte
        self.known: dict[str, int] = {}  # places in `at` and `size`
        self.ids = np.zeros(1 << 16, "<i4")  # the ids of all remembered pieces, one after the other
        self.at, self.size = np.zeros(1 << 14, np.int32), np.zeros(1 << 14, np.int32)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def plain(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<i4")

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces, all in one array, and where each one's end."""
        text = "".join([w if w[0] == "\n" else " " + w for w in words])
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<i4")
        ends = np.cumsum([len(w.encode()) + (w[0] != "\n") for w in words])
        return ids, np.searchsorted(np.cumsum(self.sizes[ids]), ends) + 1

    def _store(self, n: int, ids: np.ndarray, sizes: np.ndarray, used: int) -> int:
        """Put pieces behind the first ``n`` ones, which take ``used`` ids; the ids then used."""
        grown = lambda x, m: x if m <= len(x) else np.r_[x, np.zeros(max(m, 2 * len(x)) - len(x), x.dtype)]
        self.ids = grown(self.ids, used + len(ids))
        self.at, self.size = grown(self.at, n + len(sizes)), grown(self.size, n + len(sizes))
        self.ids[used:used + len(ids)] = ids
        self.at[n:n + len(sizes)] = used + np.cumsum(sizes) - sizes
        self.size[n:n + len(sizes)] = sizes
        return used + len(ids)

    def _learn(self, pieces: list[str]) -> dict[str, int]:
        """Places of unseen pieces. What exceeds the memory is put behind it, for this call only."""
        bare = sorted((p for p in pieces if p[0] == _FIRST), key=_long)
        rest = sorted((p for p in pieces if p[0] != _FIRST), key=_long)
        n = len(self.known)
        used = int(self.at[n - 1] + self.size[n - 1]) if n else 0
        if rest:
            ids, ends = self._encode(rest)
            used = self._store(n, ids, np.diff(ends, prepend=0), used)
        if bare:
            parts = [self.plain(p[1:]) for p in bare]
            self._store(n + len(rest), np.concatenate(parts), np.array(list(map(len, parts)), np.int64), used)
        order = rest + bare
        place = dict(zip(order, range(n, n + len(order)), strict=True))
        room = min(self.memory - n, next((i for i, p in enumerate(order) if _long(p)), len(order)))
        self.known.update(place if room >= len(place) else list(place.items())[:max(room, 0)])
        return place

    def _gather(self, words: pa.Array, which: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of rows of pieces (``which`` of the different ``words``), all in one array, and each row's number of ids."""
        stems = pc.ascii_rtrim(words, characters=_STOPS)
        stems = pc.if_else(pc.match_substring_regex(stems, _STEM), stems, words)
        starts = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1]
        both = np.empty(2 * len(words) + 1, np.int32)  # stem and tail in turn, over the bytes of the words
        both[::2] = starts
        both[1::2] = starts[:-1] + pc.binary_length(stems).to_numpy()
        tails = pa.StringArray.from_buffers(2 * len(words), pa.py_buffer(both), words.buffers()[2]).take(
            pa.array(np.arange(1, 2 * len(words), 2)))
        stems, tails = stems.dictionary_encode(), tails.dictionary_encode()
        keys = stems.dictionary.to_numpy(zero_copy_only=False).tolist() + [_FIRST + t for t in tails.dictionary.to_pylist()]
        places = list(map(self.known.get, keys))
        if lost := dict.fromkeys(k for k, place in zip(keys, places, strict=True) if place is None):
            found = self._learn(list(lost))
            places = [found[k] if place is None else place for k, place in zip(keys, places, strict=True)]
        places, two = np.array(places, np.int32), np.empty((len(words), 2), np.int32)
        two[:, 0] = places[stems.indices.to_numpy()]
        two[:, 1] = places[len(stems.dictionary) + tails.indices.to_numpy().astype(np.int64)]
        place = two[which].ravel()
        sizes = self.size[place]
        ends = np.cumsum(sizes, dtype=np.int64)
        take = np.repeat(self.at[place] - (ends - sizes).astype(np.int32), sizes)
        take += np.arange(len(take), dtype=np.int32)
        return self.ids[take], np.diff(np.r_[0, ends][2 * offsets])

    def encode(self, texts: pa.Array) -> pa.ListArray:
        """The ids of each text (no nulls)."""
        if not len(texts):
            return pa.array([], pa.list_(pa.int32()))
        # The first piece gets its mark; a line break starts a piece as a blank does, and stays in it.
        pieces = pc.split_pattern(pc.replace_substring(pc.binary_join_element_wise(_FIRST, texts, ""), "\n", " \n"), " ")
        offsets, cut = pieces.offsets.to_numpy().astype(np.int64), pieces.flatten().dictionary_encode()
        words, which = cut.dictionary, cut.indices.to_numpy()
        odd = ~pc.match_substring_regex(words, _PLAIN).to_numpy(zero_copy_only=False)[which]
        odd[offsets[:-1]] = False
        odd = np.add.reduceat(odd, offsets[:-1], dtype=np.int64) > 0
        special = np.zeros(len(texts), bool)  # special strings are cut out before any other rule
        for a in self.added:
            special |= pc.match_substring(texts, a).to_numpy(zero_copy_only=False)
        odd |= special
        if not odd.any():
            values, sizes = self._gather(words, which, offsets)
            return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), pa.array(values))
        rows = [self.plain(t) if s else None for t, s in zip(texts.to_pylist(), special.tolist(), strict=True)]
        counts = np.diff(offsets)
        used, which = np.unique(which[np.repeat(~odd, counts)], return_inverse=True)
        care = [_CUT.split(t) for t in texts.filter(pa.array(odd & ~special)).to_pylist()]
        flat = pa.array([p for x in care for p in (_FIRST + x[0], *x[1:])], pa.string()).dictionary_encode()
        for at, words, which, n in (
                (~odd, words.take(pa.array(used)), which, counts[~odd]),
                (odd & ~special, flat.dictionary, flat.indices.to_numpy(), np.array(list(map(len, care)), np.int64))):
            values, sizes = self._gather(words, which, np.r_[0, np.cumsum(n)].astype(np.int64))
            for i, ids in zip(np.flatnonzero(at).tolist(), np.split(values, np.cumsum(sizes)), strict=False):
                rows[i] = ids
        sizes = np.array(list(map(len, rows)), np.int64)
        return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), pa.array(np.concatenate(rows)))


def _encoder(path: str) -> Encoder:
    """One encoder a worker process; it outlives a task."""
    return kept(_tag(path), lambda: Encoder(path))


def _tag(path: str) -> str:
    return f"tokens {path}"


def write_tokens(docs: DataFrame, tokenizer: str, path: str | None = None, key: str = "doc_id", text: str = "text",
                 end_id: int = 0, keep: tuple[str, ...] = (), row_group_bytes: int = 32 << 20,
                 page_rows: int = 1000, encoding: str = "delta", partitions: int | None = None) -> str:
    """Write the token files of ``docs`` and return their folder (a fresh shared one by default)."""
    spark = docs.sparkSession
    path = path or f"{shared_folder(spark)}/tokens"
    keep = [c for c in keep if c in docs.columns and c not in (key, "n_tokens", "offset", "tokens")]
    rows = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("_text"), *keep)
    # Ranges are found from a sample of these values on the driver: a hash stands there for the text.
    order = [F.col(key).asc_nulls_first(), F.xxhash64("_text").asc()]
    rows = (rows.repartitionByRange(partitions, *order) if partitions else rows.repartitionByRange(*order))
    rows = rows.sortWithinPartitions(*order, F.col("_text"))
    schema = T.StructType([docs.schema[key], T.StructField("n_tokens", T.LongType(), False),
                           T.StructField("offset", T.LongType(), False),
                           T.StructField("tokens", T.ArrayType(T.IntegerType(), False), False),
                           *[docs.schema[c] for c in keep]])

    def encode(batches):
        encoder, offset = _encoder(tokenizer), 0
        for batch in batches:
            size = np.cumsum(pc.binary_length(batch.column(1)).to_numpy()) // _SLICE
            for at, stop in itertools.pairwise([0, *(np.flatnonzero(np.diff(size)) + 1).tolist(), batch.num_rows]):
                part = batch.slice(at, stop - at)
                lists = encoder.encode(part.column(1))
                sizes = np.diff(lists.offsets.to_numpy()).astype(np.int64) + 1
                ends = np.cumsum(sizes)
                values = np.insert(lists.values.to_numpy(), ends - np.arange(1, len(ends) + 1), end_id)
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(values))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes), pa.array(offset + ends - sizes), lists, *part.columns[2:]],
                    names=schema.names)
                offset += int(sizes.sum())
            give_back()

    with small_batches(spark, 2 * _SLICE):
        (rows.mapInArrow(giving_back(encode, (_tag(tokenizer),)), schema).write
         .option("compression", "zstd").option("parquet.writer.version", "PARQUET_2_0")
         .option("parquet.enable.dictionary", "true")
         .option("parquet.enable.dictionary#tokens.list.element", str(encoding == "dictionary").lower())
         .option("parquet.block.size", str(row_group_bytes)).option("parquet.page.row.count.limit", str(page_rows))
         .parquet(path))
    return path


def read_tokens(spark, path: str, *columns: str, broadcast_files: int = 100_000) -> DataFrame:
    """The rows of token files with ``start``: the number of ids before the row in the whole collection.

    ``columns`` names what else to read (all but the helper column by default); a reader that leaves ``tokens`` out
    does not touch its pages. One total a file gives each file's base; that table is broadcast while it has at most
    ``broadcast_files`` rows and joined otherwise.
    """
    rows = spark.read.parquet(path)
    names = list(columns) or [c for c in rows.columns if c != "offset"]
    at = F.col("_metadata.file_path").alias("_file")
    rows = rows.select(*names, "offset", at)
    light = spark.read.parquet(path).select("n_tokens", "offset", at)
    totals = light.groupBy("_file").agg(F.sum("n_tokens").alias("_ids"), F.min("offset").alias("_first"))
    # One row per file. Key order is the order of the tasks' numbers in the names (as numbers: 100000 comes after 99999).
    number = lambda pattern: F.regexp_extract("_file", pattern, 1).try_cast("long")
    before = Window.orderBy(number(r"part-(\d+)[^/]*$"), number(r"-c(\d+)\.[^/]*$"), "_file").rowsBetween(
        Window.unboundedPreceding, -1)
    totals = totals.select("_file", (F.coalesce(F.sum("_ids").over(before), F.lit(0)) - F.col("_first")).alias("_base"))
    if len(rows.inputFiles()) <= broadcast_files:
        totals = F.broadcast(totals)
    return rows.join(totals, "_file").select(*names, (F.col("_base") + F.col("offset")).alias("start"))


@F.arrow_udf(T.LongType())
def token_crc(tokens: pa.Array) -> pa.Array:
    """Unsigned CRC-32 of each row's ids as little-endian unsigned 32-bit integers."""
    values, at = tokens.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False), tokens.offsets.to_pylist()
    return pa.array([zlib.crc32(values[a:b]) for a, b in itertools.pairwise(at)], pa.int64())
