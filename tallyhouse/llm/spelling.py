"""Spelling variants: words that differ by one code point, found with a bidirectional FM-index, and the form each belongs to.

``word_counts`` counts the words of whole texts: a task counts its documents' words in a bounded table and sends partial
counts, which Spark adds up. ``near_words`` finds all pairs one edit apart. One edit leaves the left or the right half
of a word as it is, so a word asks only the words that share a half: every word is filed under the halves that a
word of its own length or one more or less could share with it, halves are dealt to buckets of bounded size, and
each bucket builds an index of its vocabulary and answers its words' questions. The index is the suffix order of the text
``$word$word...`` and of its reversal (Burrows-Wheeler transforms held as wavelet matrices); a match is a pair of suffix-rank
intervals kept in step, which one more symbol on either side narrows. Two searches cover all edits: the left half is matched exactly, from the
middle to the delimiter before the word, and extended to the right with one error to the delimiter behind it; and
the mirror image. Symbols tried as errors are only those that the interval holds.

A half that very many words share is split: its words are dealt to parts of at most ``part_words``, and each of its
questions goes to all parts, so no index outgrows a task and no pair is lost. ``forms`` picks each word's form and follows the forms to
the root in a logarithmic number of joins.

Defined results: a null text has no words, an empty table no rows; a null document id counts as the empty text in the checksum that
damages words; repeated documents count each time; ties go to the smaller word in code-point order; extra columns are ignored; words and
texts of any length are taken whole.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import shared_folder, stored

# Latin-1 bytes that are letters (A-Z in lower case), all others as blanks.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 192 else 32 for b in range(256))


def word_counts(docs: DataFrame, text: str = "text", key: str = "doc_id", min_length: int = 6, min_count: int = 5,
                damage: int | None = None, table_words: int = 200_000) -> DataFrame:
    """``word, n``: words of at least ``min_length`` code points that occur ``min_count`` times or more.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF with A-Z in lower case. With ``damage``, a word loses one code
    point in every document where ``damage`` divides the CRC-32 ``h`` of ``<key>:<word>``: the one at ``h`` modulo its length.
    """
    def run(batches: Iterator[pa.RecordBatch]):
        counts: Counter = Counter()

        def flush():
            # One byte is one code point here.
            out = pa.RecordBatch.from_pydict({"word": pa.array([w.decode("latin-1") for w in counts], pa.string()),
                                              "n": pa.array(list(counts.values()), pa.int64())})
            counts.clear()
            return out

        for batch in batches:
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not value:
                    continue
                start = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for w, k in Counter(value.encode("latin-1", "replace").translate(_LETTERS).split()).items():
                    if len(w) < min_length:
                        continue
                    if damage:
                        h = zlib.crc32(w if w.isascii() else w.decode("latin-1").encode(), start)
                        if h % damage == 0:
                            w = w[:(at := h % len(w))] + w[at + 1:]
                            if len(w) < min_length:
                                continue
                    counts[w] += k
                if len(counts) >= table_words:
                    yield flush()
        if counts:
            yield flush()

    parts = docs.select(F.col(key), F.col(text)).mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


class Wavelet:
    """A sequence of symbols that counts a symbol, and the smaller ones, in any interval: bit by bit, vectorised."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.ones, self.zeros = bits, [], []
        for level in range(bits - 1, -1, -1):
            bit = (symbols >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]).astype(np.int32))
            self.zeros.append(int(len(bit) - bit.sum()))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])
        sizes = np.bincount(symbols, minlength=1 << bits)
        self.before = np.concatenate([[0], np.cumsum(sizes)[:-1]])  # symbols of the text smaller than c
        place = np.zeros(1 << bits, np.int64)  # where c's occurrences begin in the last level's order
        for level, ones, zeros in zip(range(bits - 1, -1, -1), self.ones, self.zeros, strict=True):
            up = (np.arange(1 << bits) >> level) & 1 == 1
            place = np.where(up, zeros + ones[place], place - ones[place])
        self.place = place

    def step(self, low: np.ndarray, high: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First suffix rank and number of the occurrences of ``c`` in ``[low, high)``, and the number of smaller symbols there."""
        less = np.zeros(len(low), np.int64)
        for level, ones, zeros in zip(range(self.bits - 1, -1, -1), self.ones, self.zeros, strict=True):
            up = (c >> level) & 1 == 1
            a, b = ones[low].astype(np.int64), ones[high].astype(np.int64)
            less += np.where(up, (high - low) - (b - a), 0)
            low, high = np.where(up, zeros + a, low - a), np.where(up, zeros + b, high - b)
        return self.before[c] + low - self.place[c], high - low, less

    def symbols(self, low: np.ndarray, high: np.ndarray):
        """Every different symbol of every interval: (interval, symbol, first rank, number, smaller symbols)."""
        of, c, less = np.arange(len(low)), np.zeros(len(low), np.int64), np.zeros(len(low), np.int64)
        for ones, zeros in zip(self.ones, self.zeros, strict=True):
            a, b = ones[low].astype(np.int64), ones[high].astype(np.int64)
            falls = (high - low) - (b - a)
            down, up = falls > 0, b > a
            of, c, less, low, high = (
                np.concatenate([of[down], of[up]]), np.concatenate([2 * c[down], 2 * c[up] + 1]),
                np.concatenate([less[down], (less + falls)[up]]), np.concatenate([(low - a)[down], (zeros + a)[up]]),
                np.concatenate([(high - b)[down], (zeros + b)[up]]))
        return of, c, self.before[c] + low - self.place[c], high - low, less


def rotation_order(text: np.ndarray) -> np.ndarray:
    """Start positions of the rotations of a text without a period, in order; ranks by prefixes of doubling length."""
    n, size = len(text), 1
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    while True:
        pair = rank * n + np.roll(rank, -size)
        order = np.argsort(pair, kind="stable")
        fresh = np.concatenate([[False], np.diff(pair[order]) > 0])
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(fresh)
        if rank[order[-1]] == n - 1:
            return order
        size *= 2


class Direction:
    """The transform of one reading direction: narrows matches by the symbol before them."""

    def __init__(self, text: np.ndarray, bits: int):
        self.order = rotation_order(text)
        self.wavelet = Wavelet(text[self.order - 1], bits)


class BidirectionalIndex:
    """Suffix-rank intervals over ``$word$word...`` and its reversal, for a list of different words."""

    def __init__(self, words: list[str]):
        joined = np.frombuffer(("\0" + "\0".join(words)).encode("utf-32-le"), "<u4")
        self.alphabet = np.unique(joined)  # the delimiter is symbol 0
        text = np.searchsorted(self.alphabet, joined).astype(np.int64)
        self.bits = max(1, int(len(self.alphabet) - 1).bit_length())
        self.forward, self.backward = Direction(text, self.bits), Direction(text[::-1].copy(), self.bits)
        self.size, self.starts = len(text), np.nonzero(text == 0)[0]

    def symbols(self, word: str) -> np.ndarray:
        """The symbols of a word; -1 for a code point that the vocabulary lacks."""
        points = np.frombuffer(word.encode("utf-32-le"), "<u4")
        place = np.minimum(np.searchsorted(self.alphabet, points), len(self.alphabet) - 1)
        return np.where(self.alphabet[place] == points, place, -1)

    def one_error_behind(self, queries: list[str], halves: np.ndarray, mirrored: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) pairs: words that share the query's first ``halves`` symbols and differ behind by one edit.

        ``mirrored`` reads everything from right to left: the shared symbols are the last ones.
        """
        left, right = (self.backward, self.forward) if mirrored else (self.forward, self.backward)
        listed = [self.symbols(w)[::-1] if mirrored else self.symbols(w) for w in queries]
        length = np.array([len(x) for x in listed])
        flat, start = np.concatenate(listed), np.concatenate([[0], np.cumsum(length)[:-1]])

        def at(q, j):  # the query's symbol at j, the delimiter behind its end
            return np.where(j < length[q], flat[np.minimum(start[q] + j, len(flat) - 1)], 0)

        # The exact half, from its last symbol back to the delimiter in front of the word.
        q = np.arange(len(queries))
        low, rlow, size = np.zeros_like(q), np.zeros_like(q), np.full(len(q), self.size)
        for back in range(int(halves.max()) + 1):
            go = halves[q] >= back
            j = halves[q] - 1 - back
            c = np.where(j >= 0, at(q, np.maximum(j, 0)), 0)
            there = go & (c >= 0)
            first, count, less = left.wavelet.step(low[there], low[there] + size[there], c[there])
            low[there], rlow[there], size[there] = first, rlow[there] + less, count
            alive = (size > 0) & (~go | (c >= 0))
            q, low, rlow, size = q[alive], low[alive], rlow[alive], size[alive]
        # Behind it: states without an error at position j of the query, and states that have had theirs.
        j, found = halves[q], []
        late: list[np.ndarray] = [np.zeros(0, np.int64)] * 5
        while len(q) or len(late[0]):
            fresh = []
            if len(q):
                of, c, first, count, less = right.wavelet.symbols(rlow, rlow + size)
                cq, cj, clow = q[of], j[of], low[of] + less
                want, inner = at(cq, cj), c != 0
                same, within = c == want, cj < length[cq]
                for mask, ahead in ((inner & ~same & within, 1), (inner, 0)):  # another symbol; one symbol more
                    fresh.append((cq[mask], cj[mask] + ahead, clow[mask], first[mask], count[mask]))
                skip = j < length[q]  # one symbol less
                fresh.append((q[skip], j[skip] + 1, low[skip], rlow[skip], size[skip]))
                go = same & within
                q, j, low, rlow, size = cq[go], cj[go] + 1, clow[go], first[go], count[go]
            if len(late[0]):
                lq, lj, llow, lrlow, lsize = late
                c = at(lq, lj)
                known = c >= 0
                lq, lj, llow, lrlow, lsize, c = (x[known] for x in (lq, lj, llow, lrlow, lsize, c))
                first, count, less = right.wavelet.step(lrlow, lrlow + lsize, c)
                alive = count > 0
                done = alive & (lj == length[lq])
                found.append((lq[done], (llow + less)[done]))
                go = alive & ~done
                fresh.append((lq[go], lj[go] + 1, (llow + less)[go], first[go], count[go]))
            late = [np.concatenate(x) for x in zip(*fresh, strict=True)]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        q, rank = (np.concatenate(x) for x in zip(*found, strict=True))
        place = left.order[rank]  # of the delimiter in front, in the reading direction
        if mirrored:
            # The delimiter read first is the one behind the word, cyclically the next word's.
            word = (np.searchsorted(self.starts, self.size - 1 - place) - 1) % len(self.starts)
        else:
            word = np.searchsorted(self.starts, place)
        both = np.unique(q * len(self.starts) + word)
        return both // len(self.starts), both % len(self.starts)


def _search(rows: pd.DataFrame, block: int = 20_000) -> pd.DataFrame:
    """The near pairs of a bucket: its filed words against its asking words.

    A bucket holds words of many halves, and a split half may have several parts here: a pair counts where its second word
    is filed under the half that the first one asks for, which is in one bucket only.
    """
    filed = rows[rows["filed"]]
    place = filed.drop_duplicates("word")
    words, counts = place["word"].tolist(), place["n"].to_numpy()
    out = []
    if words:
        index, code = BidirectionalIndex(words), {w: i for i, w in enumerate(words)}
        here = {(h, code[w]) for h, w in zip(filed["h"].tolist(), filed["word"].tolist(), strict=True)}
        vocabulary = np.array(words, object)
        for side, asking in rows[rows["asks"]].drop_duplicates(["side", "word"]).groupby("side"):
            for at in range(0, len(asking), block):
                part = asking.iloc[at:at + block]
                queries, keys = part["word"].tolist(), part["h"].tolist()
                q, v = index.one_error_behind(queries, part["half"].to_numpy(), mirrored=bool(side))
                # A word that shares the left half too was found by the other search.
                good = [(keys[a], b) in here and not (side and words[b].startswith(queries[a][:len(queries[a]) // 2]))
                        for a, b in zip(q.tolist(), v.tolist(), strict=True)]
                q, v = q[good], v[good]
                out.append(pd.DataFrame({"word": part["word"].to_numpy()[q], "n": part["n"].to_numpy()[q],
                                         "near": vocabulary[v], "near_n": counts[v]}))
    if not out:
        return pd.DataFrame({"word": pd.Series(dtype=object), "n": pd.Series(dtype="int64"),
                             "near": pd.Series(dtype=object), "near_n": pd.Series(dtype="int64")})
    return pd.concat(out)


def near_words(vocabulary: DataFrame, bucket_symbols: int = 500_000, part_words: int = 20_000) -> DataFrame:
    """``word, n, near, near_n``: every pair of words of ``vocabulary`` (``word, n``; words differ) one edit apart, both ways round.

    The table is read several times; pass a written one.
    """
    vocabulary = vocabulary.where(F.length("word") > 1)
    total = vocabulary.agg(F.sum(F.length("word") + 1)).first()[0] or 0
    buckets = max(1, -(-4 * total // bucket_symbols))
    m = F.length("word")
    # A word of length m is asked for by halves of the lengths that m - 1, m and m + 1 have; its own half asks.
    left = F.array_distinct(F.transform(F.array(m - 1, m, m + 1), lambda x: F.floor(x / 2).cast("int")))
    right = F.array_distinct(F.transform(F.array(m, m + 1, m + 2), lambda x: F.floor(x / 2).cast("int")))
    sides = F.array(F.struct(F.lit(0).alias("side"), left.alias("halves"), F.floor(m / 2).cast("int").alias("own")),
                    F.struct(F.lit(1).alias("side"), right.alias("halves"), F.floor((m + 1) / 2).cast("int").alias("own")))
    rows = vocabulary.select("word", "n", F.explode(sides).alias("s")).select(
        "word", "n", "s.side", F.explode("s.halves").alias("half"), "s.own")
    rows = rows.where("half > 0").select("word", "n", "side", "half", (F.col("half") == F.col("own")).alias("asks"), F.xxhash64(
        "side", F.when(F.col("side") == 0, F.expr("substring(word, 1, half)")).otherwise(F.expr("right(word, half)"))).alias("h"))
    crowded = rows.groupBy("h").count().where(F.col("count") > part_words).select(
        "h", F.ceil(F.col("count") / part_words).cast("int").alias("parts"))
    rows = rows.join(crowded, "h", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    every = F.when(F.col("asks"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(own))
    rows = rows.withColumn("part", F.explode(every)).withColumn("filed", F.col("part") == own)
    bucket = F.pmod(F.xxhash64("h", "part"), F.lit(buckets)).alias("bucket")
    rows = rows.select("word", "n", "side", "half", "h", "asks", "filed", bucket)
    return rows.groupBy("bucket").applyInPandas(lambda part: _search(part), "word string, n long, near string, near_n long")


def forms(vocabulary: DataFrame, near: DataFrame, ratio: int = 5, folder: str | None = None) -> DataFrame:
    """``word, n, form, form_n, n_near, root`` for each word of ``vocabulary``.

    The form is the most frequent near word if it has at least ``ratio`` times the word's occurrences, else null; the root
    is where following the forms ends. ``ratio`` must be over 1, so that no chain returns.
    """
    folder = folder or shared_folder(vocabulary.sparkSession)
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct(
        (-F.col("near_n")).alias("rank"), "near")).alias("best"))
    rows = vocabulary.join(best, "word", "left")
    fits = -F.col("best.rank") >= ratio * F.col("n")
    rows = stored(rows.select("word", "n", F.when(fits, F.col("best.near")).alias("form"),
                              F.when(fits, -F.col("best.rank")).alias("form_n"),
                              F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near")), folder, "forms")
    links = rows.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    turn = 0
    while True:
        # Every round doubles the length of the followed chains.
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        links = stored(links.join(ahead, "root", "left").select(
            "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), folder, f"roots_{turn}")
        if links.where("moved").isEmpty():
            break
        links, turn = links.select("word", "root"), turn + 1
    return rows.join(links.select("word", "root"), "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_forms(docs: DataFrame, text: str = "text", key: str = "doc_id", min_length: int = 6, min_count: int = 5,
                   damage: int | None = None, ratio: int = 5) -> DataFrame:
    """Words of ``docs`` with their spelling forms: counts, near words and forms in turn."""
    folder = shared_folder(docs.sparkSession)
    vocabulary = stored(word_counts(docs, text, key, min_length, min_count, damage), folder, "vocabulary")
    return forms(vocabulary, stored(near_words(vocabulary), folder, "near"), ratio, folder)
