"""Byte-level BPE: encode whole texts by a priority queue of merge ranks, decode by concatenating vocabulary strings.

A text is cut at the tokenizer's added tokens, then into the pieces of its pre-tokenizer. The byte symbols of a piece form a
doubly linked list. A heap holds ``(rank, position)`` of every adjacent pair that has a merge; the smallest entry is
popped, entries whose pair is no longer there are skipped, and a merge pushes the two pairs it makes. Ties of rank go to the left.
Decoding looks up the byte string of each id and joins them.

Workers read the tokenizer file once and remember the ids of a bounded number of different pieces, so text that repeats
costs a lookup; what is not remembered is merged anew and gives the same ids. Nothing is shuffled: both functions are one
pass over Arrow batches, and a lost task is simply run again.

Defined results: a null text is the empty text and has no ids; null ids decode to the empty text; texts of any length are read
whole; repeated rows each get their own result; an empty table gives an empty table; columns of the input called like a result
(``tokens``, ``n_tokens``; ``decoded``) are replaced by it, all other columns stay.
"""

from __future__ import annotations

import json
import re
from array import array
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Before a blank that a visible character follows, every pre-tokenizer of this kind starts a piece.
_VISIBLE = re.compile(r"[^\s\x00-\x20\x7f-\xa0]")
_BLANK = re.compile(r" (?=[^\s\x00-\x20\x7f-\xa0])")


def byte_characters() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable bytes stand for themselves, the
    others for the characters from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Ids and their byte strings, as a ``tokenizers`` file of a byte-level BPE states them."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            self.spec = spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("byte_fallback") or model.get("dropout") or model.get("ignore_merges") \
                or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix") or spec.get("normalizer"):
            raise ValueError("a plain byte-level BPE is needed")
        self.ids: dict[str, int] = model["vocab"]
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        bytes_of = byte_characters()
        names = {i: t for t, i in (*self.ids.items(), *self.added.items())}
        self.strings = [b""] * (max(names) + 1)
        for i, name in names.items():
            plain = all(c in bytes_of for c in name)
            self.strings[i] = bytes(bytes_of[c] for c in name) if plain else name.encode()

    def decode(self, ids: list[int]) -> str:
        """The concatenated strings of the ids; bytes that are no UTF-8 become replacement characters."""
        known = self.strings
        return b"".join([known[i] for i in ids]).decode("utf-8", "replace")


class Encoder:
    """The merges of a vocabulary, and a bounded memory of pieces (``memory`` entries of at most 64 characters)."""

    def __init__(self, path: str, memory: int = 400_000):
        from tokenizers import Tokenizer
        vocabulary = Vocabulary(path)
        self.ids, self.added, self.memory = vocabulary.ids, vocabulary.added, memory
        self.cut = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        none: dict[int, int] = {}
        self.ranks = [none] * len(vocabulary.strings)  # by left symbol: right symbol to rank
        self.merged: list[int] = []
        for rank, pair in enumerate(vocabulary.spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            if self.ranks[self.ids[left]] is none:
                self.ranks[self.ids[left]] = {}
            self.ranks[self.ids[left]][self.ids[right]] = rank
            self.merged.append(self.ids[left + right])
        self.words: dict[str, bytes] = {}  # pieces of the pre-tokenizer
        self.chunks: dict[str, bytes] = {}  # what stands between two blanks
        added = sorted(self.added, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, added)) + ")") if added else None

    def merge(self, symbols: list[int]) -> list[int]:
        """Apply the merges to one piece, the lowest rank first, the leftmost pair first among equals."""
        ranks, merged, n = self.ranks, self.merged, len(symbols)
        # Rank of the pair that starts at each position now; an entry of the queue with another rank is stale.
        now = [ranks[a].get(b, -1) for a, b in zip(symbols, symbols[1:], strict=False)]
        # An entry is one number, rank before position; short pieces keep it small.
        shift = 8 if n <= 256 else 32
        mask = (1 << shift) - 1
        queue = [(r << shift) | i for i, r in enumerate(now) if r >= 0]
        if not queue:
            return symbols
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        now.append(-1)
        heapify(queue)
        while queue:
            entry = heappop(queue)
            at, rank = entry & mask, entry >> shift
            if now[at] != rank:
                continue
            right, left = after[at], before[at]
            new = symbols[at] = merged[rank]
            symbols[right] = now[right] = -1
            after[at] = follower = after[right]
            if follower < n:
                before[follower] = at
                now[at] = r = ranks[new].get(symbols[follower], -1)
                if r >= 0:
                    heappush(queue, (r << shift) | at)
            else:
                now[at] = -1
            if left >= 0:
                now[left] = r = ranks[symbols[left]].get(new, -1)
                if r >= 0:
                    heappush(queue, (r << shift) | left)
        return [s for s in symbols if s >= 0]

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids of parts of a text that no piece crosses, as little-endian 32-bit integers."""
        words, ids, out, parts, chunk = self.words, self.ids, [], [], 0
        ends = list(accumulate(map(len, chunks)))
        for word, (_, stop) in self.cut("".join(chunks)):
            found = words.get(word)
            if found is None:
                found = array("I", self.merge([ids[c] for c in word])).tobytes()
                if len(word) <= 64 and len(words) < self.memory:
                    words[word] = found
            parts.append(found)
            if stop == ends[chunk]:
                out.append(b"".join(parts))
                parts, chunk = [], chunk + 1
        return out

    def _segment(self, text: str) -> bytes:
        """Ids of a text without added tokens."""
        pieces = text.split(" ")
        get, chunks = self.chunks.get, self.chunks
        values = [b"", *map(get, pieces[1:])]
        if None in values:
            fresh = {p for p, v in zip(pieces, values, strict=True) if v is None}
            if not all(map(_VISIBLE.match, fresh)):  # runs of white space: cut only before visible characters
                pieces = _BLANK.split(text)
                fresh = {p for p in pieces[1:] if p not in chunks}
            fresh = list(fresh)
            found = dict(zip(fresh, self._chunks([" " + p for p in fresh]), strict=True))
            values = [b"", *[found[p] if (v := get(p)) is None else v for p in pieces[1:]]]
            for p in fresh:
                if len(chunks) >= self.memory:
                    break
                if len(p) <= 64:
                    chunks[p] = found[p]
        if pieces[0]:
            values[0] = b"".join(self._chunks([pieces[0]]))
        return b"".join(values)

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian 32-bit integers."""
        if self.special is None or not self.special.search(text):
            return self._segment(text) if text else b""
        parts = self.special.split(text)  # text and added token in turn
        return b"".join(np.array([self.added[p]], "<u4").tobytes() if i % 2 else self._segment(p)
                        for i, p in enumerate(parts) if p)


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


@lru_cache(maxsize=2)
def _vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _with(batch: pa.RecordBatch, names: list[str], **columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [columns[n] if n in columns else batch.column(batch.schema.get_field_index(n)) for n in names], names=names)


def encode_texts(docs: DataFrame, tokenizer: str, text: str = "text", keep: tuple[str, ...] | None = None,
                 slice_rows: int = 256) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``tokens`` and ``n_tokens`` of the whole text; ``tokenizer`` is a path."""
    kept = [c for c in (docs.columns if keep is None else keep) if c not in ("tokens", "n_tokens")]
    schema = T.StructType([*[docs.schema[c] for c in kept], T.StructField("tokens", T.ArrayType(T.IntegerType(), False), False),
                           T.StructField("n_tokens", T.LongType(), False)])

    def run(batches):
        encoder = _encoder(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, slice_rows):
                part = batch.slice(at, slice_rows)
                ids = [encoder.encode(x or "") for x in part.column(part.num_columns - 1).to_pylist()]
                sizes = np.array([len(x) // 4 for x in ids], np.int64)
                tokens = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()),
                                                  pa.array(np.frombuffer(b"".join(ids), "<i4")))
                yield _with(part, schema.names, tokens=tokens, n_tokens=pa.array(sizes))

    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(text).alias("_text of the row"))
    return rows.mapInArrow(run, schema)


def decode_tokens(rows: DataFrame, tokenizer: str, tokens: str = "tokens", slice_rows: int = 256) -> DataFrame:
    """``rows`` with ``decoded``: the text that the ids of column ``tokens`` stand for."""
    kept = [c for c in rows.columns if c != "decoded"]
    schema = T.StructType([*[rows.schema[c] for c in kept], T.StructField("decoded", T.StringType(), False)])

    def run(batches):
        vocabulary = _vocabulary(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, slice_rows):
                part = batch.slice(at, slice_rows)
                ids = part.column(part.schema.get_field_index(tokens))
                flat, ends = ids.flatten().to_numpy(zero_copy_only=False).tolist(), np.cumsum(pc.fill_null(
                    pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)).tolist()
                texts = pa.array([vocabulary.decode(flat[a:b]) for a, b in zip([0, *ends], ends, strict=False)], pa.string())
                yield _with(part, schema.names, decoded=texts)

    return rows.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(run, schema)
