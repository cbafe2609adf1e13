"""Byte-pair encoding, spelling variants and whitening against the library, brute force and dense linear algebra."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import bpe, spelling, token_files, whitening
from tallyhouse.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
TINY = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH)


def odd_texts():
    random.seed(3)
    alphabet = [*" \n\t'abcdefstLvre.,!0129é ß 　日́🙂\x1c\x85", "<|endoftext|>", "the ", "\r\n"]
    made = ["".join(random.choice(alphabet) for _ in range(random.randint(0, 60))) for _ in range(3000)]
    return made + ["", " ", "  ", "a  b", "a \n b\t c\n\n", "it's they'LL we've  ", "x" * 5000, "ab" * 3000 + " " + "the " * 999,
                   "日本語 テキスト", "\x00 \x1c a \x1f b"]


def test_bpe_equals_library(library):
    encoder, vocabulary = bpe.Encoder(PATH, memory=50), bpe.Vocabulary(PATH)
    for text in odd_texts():
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == ids, text
        assert vocabulary.decode(ids) == library.decode(ids, skip_special_tokens=False)
    for ids in ([], [0], [220, 50256], list(range(128, 256)), [447, 247, 447], list(range(0, 50257, 97))):
        assert vocabulary.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_token_encoder_equals_library(library):
    """Arrays of texts at once, with and without room to remember, in slices of an array, beside odd white space."""
    texts = odd_texts() + ["", "\n", "\n a", "a\n", "a \nb", "\x01a b", "a \x01b", "Don't stop.\nThe end... \"x\"\nof it,,\nall's 'so'",
                           *(f"word{i}ab ouble*** thein,\nIn{i}er d'e. é{i % 7}ßch## " * 3 + "end." for i in range(300))]
    want = [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)]
    whole = pa.array(texts, pa.string())
    for memory in (0, 50, 100_000):
        encoder = token_files.Encoder(PATH, memory=memory)
        for step in (7, len(texts)):
            got = [ids for at in range(0, len(texts), step) for ids in encoder.encode(whole.slice(at, step)).to_pylist()]
            assert got == want
        assert len(encoder.known) <= memory
    assert token_files.Encoder(PATH).encode(pa.array([], pa.string())).to_pylist() == []


def test_workers_forget_what_other_stages_left(monkeypatch):
    """Scorers and encoders outlive tasks of their own stage, not a task of the next one."""
    from tallyhouse.llm import common
    monkeypatch.setattr(common, "_KEPT", {})
    monkeypatch.setattr(common, "_ASKED", set())
    made = []
    make = lambda: made.append(1) or len(made)
    using = common.giving_back(lambda batches: (common.kept("scorer", make) + b for b in batches))
    assert list(using([1, 2])) == [2, 3] and list(using([5])) == [6] and len(made) == 1
    assert list(common.giving_back(lambda batches: iter(batches))([4])) == [4]
    assert common._KEPT == {} and list(using([1])) == [3]


def test_workers_forget_before_the_first_batch(monkeypatch):
    """What another stage left is gone when a task begins; what the task itself will ask for stays."""
    from tallyhouse.llm import common
    monkeypatch.setattr(common, "_KEPT", {"tokens": 1, "scorer": 2})
    monkeypatch.setattr(common, "_ASKED", set())
    seen = []
    run = lambda batches: (seen.append(dict(common._KEPT)) or common.kept("scorer", int) + b for b in batches)
    assert list(common.giving_back(run, ("scorer",))([5, 6])) == [7, 8]
    assert seen == [{"scorer": 2}, {"scorer": 2}] and common._KEPT == {"scorer": 2}


def test_long_pieces_are_not_remembered():
    encoder = token_files.Encoder(PATH)
    encoder.encode(pa.array(["a" * 500 + " short " + "é" * 300, "word"]))
    assert encoder.known and max(map(len, encoder.known)) <= 100


def test_token_batches_are_bounded(spark):
    """Small batches while the files are written; the session's setting comes back."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before, sizes = spark.conf.get(name), "n long"
    from tallyhouse.llm.common import small_batches
    rows = spark.range(0, 4000, 1, 1).select(F.repeat(F.lit("x"), 1000).alias("text"))
    count = lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["n"]) for b in batches)
    with small_batches(spark, 200_000):
        assert max(r.n for r in rows.mapInArrow(count, sizes).collect()) < 1000
    assert spark.conf.get(name) == before


def test_bpe_tables(spark, odd_docs, library):
    rows = odd_docs.withColumn("tokens", F.lit("other")).withColumn("decoded", F.lit(1))
    out = bpe.decode_tokens(bpe.encode_texts(rows, PATH), PATH)
    assert out.columns == ["doc_id", "text", "lang", "source", "size", "tokens", "n_tokens", "decoded"]
    got = out.collect()
    assert len(got) == odd_docs.count()
    for r in got:
        assert r.tokens == library.encode(r.text or "", add_special_tokens=False).ids
        assert r.n_tokens == len(r.tokens) and r.decoded == (r.text or "")
    assert bpe.encode_texts(rows.limit(0), PATH).count() == 0
    assert bpe.decode_tokens(spark.createDataFrame([(None,)], "tokens array<int>"), PATH).first().decoded == ""


def brute_counts(docs, damage=199):
    counts = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            if damage and h % damage == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            counts[w] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def brute_near(words):
    """Pairs one edit apart, by what is left when one code point is deleted or masked."""
    buckets, words = defaultdict(set), set(words)
    for w in words:
        for i in range(len(w)):
            buckets[w[:i] + "\0" + w[i + 1:]].add(w)
    near = defaultdict(set)
    for group in buckets.values():
        for a in group:
            near[a] |= group - {a}
    for w in words:
        for i in range(len(w)):
            if (short := w[:i] + w[i + 1:]) in words:
                near[w].add(short)
                near[short].add(w)
    return near


def brute_forms(counts):
    near = brute_near(counts)
    form = {}
    for w in counts:
        if near[w]:
            best = min(near[w], key=lambda v: (-counts[v], v))
            if counts[best] >= 5 * counts[w]:
                form[w] = best
    out = set()
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(near[w]), counts[form[w]] if w in form else None))
    return out


def test_spelling_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{TINY}/documents.parquet").collect()]
    got = QUERIES["op12_spelling_variants"](spark, TINY).collect()
    want = brute_forms(brute_counts(docs))
    assert len(got) == len(want) and {tuple(r) for r in got} == want and any(r.form for r in got)


def test_spelling_near_words_split_and_whole(spark):
    random.seed(5)
    words = {"".join(random.choice("abé") for _ in range(random.randint(1, 9))) for _ in range(400)}
    words |= {"shared" + "".join(random.choice("xyz") for _ in range(random.randint(4, 6))) for _ in range(300)}
    words |= {"q" * 5000, "q" * 2000 + "r" + "q" * 2999, "q" * 5001, "\U0001f642abc", "\U0001f642abd"}
    vocabulary = spark.createDataFrame([(w, len(w)) for w in sorted(words)], "word string, n long")
    near = brute_near(words - {w for w in words if len(w) < 2})
    want = {(a, b) for a in near for b in near[a]}
    for setting in ({}, {"bucket_symbols": 3000, "part_words": 7}):
        got = [(r.word, r.near) for r in spelling.near_words(vocabulary, **setting).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    assert spelling.near_words(vocabulary.limit(0)).count() == 0


def test_spelling_odd_rows(spark, odd_docs):
    want = brute_forms(brute_counts([(r.doc_id, r.text) for r in odd_docs.collect()]))
    assert {tuple(r) for r in spelling.spelling_forms(odd_docs.withColumn("word", F.lit(1)), damage=199).select(
        "word", "form", "root", "n", "n_near", "form_n").collect()} == want
    assert spelling.spelling_forms(odd_docs.limit(0)).count() == 0
    counts = {"abcdef" + "g" * i: 5 ** (i + 1) for i in range(6)} | {"zzabcde": 5, "zzabcdf": 25, "zzabcdg": 25}  # chains and ties
    vocabulary = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = spelling.forms(vocabulary, spelling.near_words(vocabulary)).select("word", "form", "root", "n", "n_near", "form_n")
    assert {tuple(r) for r in got.collect()} == brute_forms(counts)


def spectrum_of(x, lanes=1):
    s = whitening.Spectrum(lanes, x.shape[1])
    for at in range(0, len(x), lanes):
        s.add(x[at:at + lanes])
    return s.one()


@pytest.mark.parametrize(("n", "d", "lanes"), [(40, 5, 1), (9, 12, 4), (300, 12, 8), (1, 3, 1)])
def test_rank_one_updates_give_the_scatter_spectrum(n, d, lanes):
    rng = np.random.default_rng(n)
    x = np.floor(1024 * rng.normal(size=(n, d)) * rng.uniform(.01, .3, size=d)) + 100000
    x[:, 2] = x[:, 1]  # equal poles and a null direction
    x[n // 2:] = x[n // 2]  # repeated rows
    s, c = spectrum_of(x, lanes), x - x.mean(0)
    scale = max(np.abs(c.T @ c).max(), 1)
    assert np.abs(s.vectors[0] * s.values[0] @ s.vectors[0].T - c.T @ c).max() < 1e-11 * scale
    assert np.abs(s.vectors[0].T @ s.vectors[0] - np.eye(d)).max() < 1e-11 and s.n[0] == n


def check_whitening(got, vectors):
    """Rows of the operator against a dense decomposition with the same definitions."""
    x = np.array([[int(np.floor(1024.0 * float(c))) + 100000 for c in v] for v in vectors.values()], object)
    n, s = len(x), x.sum(0)
    c = np.array((x * n - s) / n, float)
    cov = c.T @ c / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1], u[:, ::-1]
    deviation = dict(zip(vectors, (((x * n - s) ** 2).sum(1)), strict=True))
    rows = defaultdict(dict)
    for r in got:
        rows[r.vec_id][r.component] = r
        assert r.n == n and r.deviation == deviation[r.vec_id] and r.identity_error < 1e-6
        assert abs(r.explained - e[r.component - 1] / e.sum()) < 1e-9
    k = min(8, x.shape[1])
    white = np.array([[rows[i][j].whitened for j in range(1, k + 1)] for i in vectors])
    want = c @ u[:, :k] / np.sqrt(e[:k])
    white *= np.sign((white * want).sum(0))
    assert len(got) == n * k and np.abs(white - want).max() < 1e-7


def test_whitening_query(spark):
    table = spark.read.parquet(f"{TINY}/embeddings.parquet").collect()
    check_whitening(QUERIES["op13_embedding_whitening"](spark, TINY).collect(), {r.vec_id: r.embedding for r in table})


def test_whitening_many_partitions(spark):
    rng = np.random.default_rng(1)
    vectors = {i: [float(v) for v in rng.normal(size=6) * [3, .1, .5, 1, 2, .01]] for i in range(3000)}
    rows = spark.createDataFrame([(i, v) for i, v in vectors.items()], "vec_id long, embedding array<double>").repartition(9)
    check_whitening(whitening.whiten(rows, fan=2).collect(), vectors)


def test_whitening_odd_rows(spark):
    schema = "vec_id long, embedding array<float>, n string, whitened int"
    rows = [(i, [float(i), float(i * i % 7), 2.0], "x", 1) for i in range(9)]
    odd = [(20, None, None, None), (21, [1.0, None, 1.0], "x", 1), (22, [float("nan"), 1.0, 1.0], "x", 1),
           (23, [float("inf"), 0.0, 0.0], "x", 1), (24, [], "x", 1), (25, [1.0, 2.0], "x", 1), (None, [1.0, 1.0, 2.0], "x", 1),
           (3, rows[3][1], "x", 1)]
    got = whitening.whiten(spark.createDataFrame(rows + odd, schema)).collect()
    assert len(got) == 3 * 11 and {r.vec_id for r in got} == {*range(9), None} and {r.n for r in got} == {11}
    # The last component has no variance.
    assert all((r.whitened is None) == (r.component == 3) and r.identity_error < 1e-9 for r in got)
    assert whitening.whiten(spark.createDataFrame(odd[:5], schema)).count() == 0
    one = whitening.whiten(spark.createDataFrame(rows[:1], schema)).collect()
    assert len(one) == 3 and all(r.whitened is None and r.explained is None and r.deviation == 0 for r in one)
    same = whitening.whiten(spark.createDataFrame([(i, [1.0, 2.0], "", 0) for i in range(5)], schema)).collect()
    assert len(same) == 10 and all(r.whitened is None for r in same)
    big = whitening.whiten(spark.createDataFrame([(1, [3e12, 0.0], "", 0), (2, [-3e12, 0.0], "", 0)], schema)).collect()
    assert all(r.deviation is None for r in big)
    long = [(i, [float((i * j) % 11 + (i % 3)) for j in range(150)], "", 0) for i in range(30)]
    assert len(whitening.whiten(spark.createDataFrame(long, schema)).collect()) == 30 * 8


def test_line_hashes_at_every_width_of_counter(spark):
    """The majority of lines about the bounds of the packed counters; no generated method is too long to be compiled."""
    import re

    from pyspark.sql import functions as F
    from tallyhouse.llm import fuzzy_lines
    sizes = [1, 2, 127, 128, 255, 3000, 2 ** 14 - 2, 2 ** 14 - 1, 2 ** 14, 2 ** 15 + 1]
    lines = spark.createDataFrame([(n, " ".join(chr(0x4E00 + i) if i < 20_000 else f"w{i}" for i in range(n))) for n in sizes],
                                  "h long, line string")
    hashes = lines.select("h", F.explode(F.split("line", " ")).alias("w")).select("h", F.xxhash64("w").alias("x")).collect()
    sims = fuzzy_lines.simhashes(lines, ["h"])
    got = {r["h"]: r["sim"] & (2 ** 64 - 1) for r in sims.collect()}
    for n in sizes:
        xs = np.array([r["x"] for r in hashes if r["h"] == n], np.int64).view(np.uint64)
        assert got[n] == sum(1 << b for b in range(64) if 2 * int(((xs >> np.uint64(b)) & np.uint64(1)).sum()) > n), n
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        short = fuzzy_lines.simhashes(lines, ["h"])._jdf.queryExecution().executedPlan()
        code = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenString(short)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # The counters of ordinary lines; HotSpot leaves methods of more than 8,000 bytes interpreted.
    assert sorted(int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", code))[-2] < 8000


def test_texts_of_lines_are_not_kept(spark, odd_docs, monkeypatch):
    """Only the lines of pairs to be verified are stored as text; no table holds a bucket row for every line and block."""
    from tallyhouse.llm import fuzzy_lines
    seen = {}
    real = fuzzy_lines.stored
    monkeypatch.setattr(fuzzy_lines, "stored", lambda df, folder, name: seen.setdefault(name, real(df, folder, name)))
    docs = odd_docs.where("doc_id is null or doc_id not in (5, 6)").unionByName(spark.createDataFrame(
        [(100 + i, f"only here {i} stands a line of its own number {i * 7919}", "en", "a", 1) for i in range(50)], odd_docs.schema))
    fuzzy_lines.drop_similar_lines(docs).collect()
    texts = [n for n, df in seen.items() if "line" in df.columns or "text" in df.columns]
    assert sorted(texts) == ["others_texts", "stars_texts"]
    assert all(seen[n].count() <= 2 * seen[n.replace("texts", "pairs")].count() for n in texts)
    assert seen["stars_texts"].count() < seen["sims"].count() / 2
