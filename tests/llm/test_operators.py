"""The dealt operators against brute force, round trips, held-out accuracy and odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from tallyhouse.llm import (
    decontaminate,
    fuzzy_lines,
    jaccard,
    licenses,
    mixing,
    repeats,
    token_files,
    topk,
    toxicity,
    warc,
)
from tallyhouse.llm.components import components

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def small(spark, name):
    return spark.read.parquet(f"{SMALL}/{name}.parquet")


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (60, 50), (60, 55)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 60: 50, 50: 50, 55: 50}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_warc_round_trip_with_odd_pages(spark):
    same = "<p>" + "x" * 200 + "</p>"
    tricky = "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n é" * 3
    pages = spark.createDataFrame([(3, "u3", same), (1, None, same), (2, "u 2", same), (4, "u", "tiny"), (5, "u", "tiny"),
                                   (6, None, None), (7, "u", tricky), (None, "n", "z" * 300)], "page_id long, url string, html string")
    path = warc.write_captures(pages)
    records = warc.read_records(spark, path)
    assert Counter(r["warc_type"] for r in records.select("warc_type").collect()) == {
        "request": 8, "metadata": 8, "response": 6, "revisit": 2}
    for payloads in (True, False):
        rows = {r["capture_id"]: r for r in warc.transactions(records, payloads).collect()}
        assert len(rows) == 8 and all(len(r["requests"]) == len(r["metadata"]) == 1 for r in rows.values())
        for i, html in ((1, same), (2, same), (3, same), (4, "tiny"), (6, ""), (7, tricky)):
            r = rows[f"urn:capture:page:{i}"]["response"]
            assert (r["payload_bytes"], r["payload_digest"]) == (
                len(html.encode()), hashlib.sha256(html.encode()).hexdigest())
            assert r["record_type"] == ("revisit" if i in (2, 3) else "response")
            if payloads:
                assert bytes(r["payload"]) == html.encode()
    empty = warc.write_captures(pages.limit(0))
    assert empty and pages.limit(0).count() == 0


def test_warc_repeated_ids_keep_every_payload(spark):
    a, b = "a" * 200, "b" * 150
    rows = [(1, a), (2, a), (2, "own"), (3, a), (3, b), (4, b), (5, "x"), (5, "x"), (5, a), (None, "p"), (None, "q"), (1, b)]
    pages = spark.createDataFrame([(i, f"u{n}", t) for n, (i, t) in enumerate(rows)], "page_id long, url string, html string")
    records = warc.read_records(spark, warc.write_captures(pages))
    assert records.count() == records.select("record_id").distinct().count() == 3 * len(rows)
    got = warc.transactions(records).collect()
    assert all(len(r["requests"]) == len(r["metadata"]) == 1 for r in got)
    assert Counter((r["response"]["target_uri"], bytes(r["response"]["payload"]).decode()) for r in got) == Counter(
        (f"u{n}", t) for n, (_, t) in enumerate(rows))
    assert sorted(r["response"]["target_uri"] for r in got if r["response"]["record_type"] == "revisit") == ["u1", "u3", "u4", "u5", "u8"]


def test_warc_links_through_other_records(spark):
    record = lambda i, kind, to: (i, kind, to)
    rows = [record("r1", "response", ["q2"]), record("q1", "request", ["r1"]), record("q2", "request", []),
            record("m1", "metadata", ["q1"]), record("lost", "metadata", ["nowhere"])]
    frame = spark.createDataFrame(rows, "record_id string, warc_type string, concurrent_to array<string>").selectExpr(
        "*", "'u' target_uri", "'d' date", "cast(null as string) refers_to", "'text/plain' content_type",
        "cast(null as string) declared_digest", "0 body_at", "cast('x' as binary) block")
    got = {r["capture_id"]: r for r in warc.transactions(frame).collect()}
    assert {x["record_id"] for x in got["r1"]["requests"]} == {"q1", "q2"}
    assert [x["record_id"] for x in got["r1"]["metadata"]] == ["m1"]
    assert got["lost"]["response"] is None


def brute_hits(text, items, n=13):
    fold = lambda t: WORD.findall((t or "").encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))))
    w = fold(text)
    hit, found = set(), set()
    for item, t in items:
        v = fold(t)
        k = min(n, len(v))
        grams = {tuple(v[i:i + k]) for i in range(len(v) - k + 1)} if v else set()
        for i in range(len(w) - k + 1):
            if k and tuple(w[i:i + k]) in grams:
                hit |= set(range(i, i + k))
                found.add(str(item))
    return len(w), len(hit), sorted(found)


@pytest.mark.parametrize("broadcast", [32 << 20, 2000])
def test_contamination_against_brute_force(spark, odd_docs, broadcast):
    docs = small(spark, "documents").select("doc_id", "text", "lang", "source").unionByName(odd_docs.drop("size"))
    bench = small(spark, "benchmark").unionByName(spark.createDataFrame(
        [(900, "short"), (901, None), (902, "..."), (903, "Theta IOTA kappa"), (903, "Theta IOTA kappa")], "item_id long, text string"))
    items = [tuple(r) for r in bench.collect()]
    rows = decontaminate.contamination(docs, bench, broadcast_bytes=broadcast).collect()
    assert len(rows) == docs.count()
    for r in rows:
        n, hit, found = brute_hits(r["text"], items)
        assert (r["n_words"], r["n_hit"], list(r["items"])) == (n, hit, found)
        assert r["contaminated"] == (hit > 0 and 20 * hit >= n)
        assert sum(s["end_word"] - s["first_word"] for s in r["spans"]) == hit
    kept = decontaminate.without_contaminated(odd_docs, bench)
    assert kept.columns == odd_docs.columns
    # Rows pass through as they are, whatever the number of blocks: equal texts with times a microsecond apart stay two rows.
    twins = spark.sql("SELECT 'theta iota kappa and more' AS text, timestamp_micros(1000000 + id) AS at, 1 AS n_hit, id AS `_hits` FROM range(2)")
    got = decontaminate.contamination(twins, bench, broadcast_bytes=broadcast)
    assert {r["at"].microsecond for r in got.collect()} == {0, 1} and got.columns[:3] == ["text", "at", "_hits"]
    assert decontaminate.contamination(odd_docs.limit(0), bench.limit(0)).count() == 0


def brute_repeats(texts, length):
    where = defaultdict(int)
    for t in texts:
        for i in range(len(t) - length + 1):
            where[t[i:i + length]] += 1
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if where[t[i:i + length]] > 1:
                gone[i:i + length] = True
        yield int(gone.sum()), hashlib.sha256(np.frombuffer(t, np.uint8)[~gone].tobytes()).hexdigest()


def test_repeated_bytes_against_brute_force(spark, odd_docs):
    rng = random.Random(4)
    passage = "".join(rng.choice("abcdé ") for _ in range(900))
    made = []
    for i in range(60):
        own = "".join(rng.choice("abcde \n") for _ in range(rng.randrange(300)))
        a = rng.randrange(500)
        made.append((100 + i, own + passage[a:a + rng.randrange(380, 900)] + own[::-1]))
    made += [(300, "ab" * 700), (301, passage), (301, passage), (302, passage + passage), (303, None), (None, passage[:400])]
    docs = spark.createDataFrame(made, "doc_id long, text string").unionByName(
        small(spark, "documents").select("doc_id", "text")).unionByName(odd_docs.select("doc_id", "text").where("doc_id not in (5, 6)"))
    rows = docs.collect()
    want = Counter()
    for r, w in zip(rows, brute_repeats([(r["text"] or "").encode() for r in rows], 400), strict=True):
        if w[0]:
            want[(r["doc_id"], *w)] += 1
    spans = repeats.repeated_spans(docs)
    keyed = docs.select("doc_id", *repeats.row_key("doc_id", "text")).join(spans, ["k1", "k2"])
    got = Counter((r["doc_id"], r["n_removed"], r["kept_sha256"]) for r in keyed.collect() if r["n_removed"])
    assert got == want
    clash = docs.selectExpr("*", "1 AS spans", "2 AS `_doc`", "3 AS k1")
    cut = repeats.without_repeats(clash)
    assert cut.columns == clash.columns
    cut = {r["doc_id"]: (r["text"], r["spans"], r["_doc"], r["k1"]) for r in cut.collect()}
    assert cut[301] == ("", 1, 2, 3) and cut[303] == (None, 1, 2, 3)
    assert repeats.repeated_spans(docs.limit(0)).count() == 0


def test_mix_balances_and_agrees(spark, odd_docs):
    docs = small(spark, "documents")
    rows = mixing.draws(docs, keep=("doc_id", "source"), block=10).collect()
    assert len(rows) == docs.count()
    again = mixing.draws(docs.repartition(5), keep=("doc_id",), block=10).collect()
    assert {r["doc_id"]: r["copies"] for r in rows} == {r["doc_id"]: r["copies"] for r in again}
    taken, most = Counter(), Counter()
    for r in rows:
        assert r["copies"] in (0, 1, 2)
        taken[r["source"]] += r["copies"] * r["size"]
        most[r["source"]] = max(most[r["source"]], r["size"])
    for r in rows:
        assert abs(taken[r["source"]] - r["target"]) <= 2 * most[r["source"]]
    sizes = {r["source"]: r["source_size"] for r in rows}
    assert abs(sum({r["source"]: r["target"] for r in rows}.values()) - min(1.5 * sum(sizes.values()), 2 * sum(sizes.values()))) < 1e-6
    odd = mixing.draws(odd_docs.drop("size"), keep=("doc_id",)).collect()
    assert len(odd) == odd_docs.count()
    assert mixing.mix(odd_docs).columns == odd_docs.columns
    assert mixing.draws(odd_docs.limit(0), keep=("doc_id",)).count() == 0


def test_targets_reshare_the_excess():
    got = mixing.targets({"a": 10, "b": 100, None: 100}, (3, 1, 2), 1.5, 2.0)
    assert got == {"a": 20.0, "b": pytest.approx(295 / 3), None: pytest.approx(590 / 3)}
    assert mixing.targets({"z": 0}, (3, 1, 2), 1.5, 2.0) == {"z": 0.0}


def test_cube_keeps_totals_and_probabilities():
    sizes = [random.Random(1).randrange(1, 400) for _ in range(300)]
    mean = np.zeros(300)
    for seed in range(200):
        p = [0.3 + 0.001 * i for i in range(300)]
        before = sum(p), sum(a * b for a, b in zip(p, sizes, strict=True))
        rng = random.Random(seed)
        open_ = mixing.fly(p, sizes, rng)
        assert len(open_) <= 2
        assert (sum(p), sum(a * b for a, b in zip(p, sizes, strict=True))) == pytest.approx(before)
        mixing.land(p, open_, sizes, rng)
        assert set(p) <= {0.0, 1.0}
        mean += p
    assert abs(mean / 200 - (0.3 + 0.001 * np.arange(300))).mean() < 0.05


def lev(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        last, row[0] = row[0], i + 1
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], min(row[j + 1] + 1, row[j] + 1, last + (x != y))
    return row[-1]


def test_simhash_counts_majorities(spark):
    lines = ["one", "a b", "a b c d e", " ".join(f"w{i}" for i in range(127)),
             " ".join(f"w{i}" for i in range(128)), " ".join(f"w{i}" for i in range(700))]
    from pyspark.sql import functions as F
    rows = spark.createDataFrame([(x,) for x in lines], "line string").select(
        F.transform(F.split("line", " "), lambda w: F.xxhash64(w)).alias("h"), "line")
    rows = fuzzy_lines.simhashes(rows, ["h"]).collect()
    assert len(rows) == len(lines)
    major = lambda hs: sum(1 << b for b in range(64) if 2 * sum((h >> b) & 1 for h in hs) > len(hs))
    for r in rows:
        hs = [h & (2 ** 64 - 1) for h in r["h"]]
        assert r["sim"] & (2 ** 64 - 1) == major(hs)


def test_lines_against_brute_force(spark, odd_docs):
    docs = small(spark, "documents").select("doc_id", "text").where("doc_id < 60").unionByName(
        odd_docs.select("doc_id", "text").where("doc_id is null or doc_id not in (5, 6)"))
    from pyspark.sql import functions as F
    rows = docs.collect()
    norm = lambda x: re.sub(r"\s+", " ", x.lower()).strip()
    occurrences = sorted({((r["doc_id"] is None, r["doc_id"] or 0), i, norm(x), r["text"]) for r in rows if r["text"] is not None
                          for i, x in enumerate(r["text"].split("\n")) if norm(x)}, key=lambda o: o[:2])
    distinct = sorted({o[2] for o in occurrences})
    sims = {r["name"]: r["sim"] for r in fuzzy_lines.simhashes(
        spark.createDataFrame([(x,) for x in distinct], "line string").select(F.col("line").alias("name"), "line"),
        ["name"]).collect()}
    group = {x: x for x in distinct}
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if bin((sims[a] ^ sims[b]) & (2 ** 64 - 1)).count("1") <= 3 and lev(a, b) <= 0.2 * max(len(a), len(b)) + 1e-9:
                old, new = group[a], group[b]
                group = {k: new if v == old else v for k, v in group.items()}
    kept, want = set(), Counter()
    for key, at, line, text in occurrences:
        if group[line] in kept:
            want[(key, text)] += 1
        kept.add(group[line])
    out = fuzzy_lines.drop_similar_lines(docs.withColumns({"old": F.col("text"), "_gone": F.lit(7), "n_lines": F.lit("x")})).collect()
    assert len(out) == len(rows) and all(r["_gone"] == 7 for r in out)
    for r in out:
        if r["old"] is None:
            assert r["text"] is None and r["n_lines"] == 0
        elif r["doc_id"] is not None:
            assert r["n_dropped"] == want[((False, r["doc_id"]), r["old"])], r["doc_id"]
            assert len(r["text"].split("\n")) == max(1, r["n_lines"] - r["n_dropped"])
    assert fuzzy_lines.drop_similar_lines(docs.limit(0)).count() == 0


def test_token_files_round_trip(spark, odd_docs):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    docs = small(spark, "documents").select("doc_id", "text", "lang").unionByName(odd_docs.select("doc_id", "text", "lang")).unionByName(
        spark.createDataFrame([(50_000 + i, t, None) for i, t in enumerate(
            ["  a", "a  b", "\n\n x y", " a\n b", "\x1c a \x1c b", "<|endoftext|> x", "don't 's .. ,,a. b.' \t x  \n", " "])],
            "doc_id long, text string, lang string"))
    for encoding in ("delta", "dictionary"):
        rows = token_files.read_tokens(spark, token_files.write_tokens(docs, path, keep=("lang",), partitions=5, encoding=encoding)).collect()
        rows.sort(key=lambda r: r["start"])
        keys = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in rows]
        assert keys == sorted(keys)
        start, want = 0, Counter((r["doc_id"], tuple(plain.encode(r["text"] or "", add_special_tokens=False).ids)) for r in docs.collect())
        for r in rows:
            assert r["start"] == start and r["tokens"][-1] == 0 and r["n_tokens"] == len(r["tokens"])
            start += r["n_tokens"]
        assert Counter((r["doc_id"], tuple(r["tokens"][:-1])) for r in rows) == want
    empty = token_files.write_tokens(docs.limit(0), path)
    assert token_files.read_tokens(spark, empty).count() == 0


def test_token_files_of_very_many_tasks(spark, tmp_path):
    """Files are in the order of their tasks' numbers, also beyond the five digits that Spark pads them to."""
    names = ["part-99999-x-c000.zstd.parquet", "part-99999-x-c001.zstd.parquet", "part-99999-x-c1000.zstd.parquet",
             "part-100000-x-c000.zstd.parquet", "part-1000000-x-c000.zstd.parquet"]
    (tmp_path / "tokens").mkdir()
    for i, name in enumerate(names):
        pq.write_table(pa.table({"doc_id": pa.array([i], pa.int64()), "n_tokens": pa.array([i + 1], pa.int64()), "offset": pa.array([0], pa.int64()),
                                 "tokens": pa.array([[7] * (i + 1)], pa.list_(pa.int32()))}), str(tmp_path / "tokens" / name))
    rows = token_files.read_tokens(spark, str(tmp_path / "tokens")).orderBy("doc_id").collect()
    assert [r["start"] for r in rows] == [0, 1, 3, 6, 10]


def test_licenses(spark, odd_docs):
    noise = "thing ouble erent the of and anre tion shea "
    rows = [(1, noise + "\nReleased under the MIT License.", "mit"), (2, "This work is licensed under the GNU General Public License, version 3.", "gpl"),
            (3, noise * 30, "unknown"), (4, "Licensed under CC BY-NC 4.0. " + noise * 20, "cc-by-nc"),
            (5, "the license of this public general work", "unknown"), (6, noise + "Licensed under the Apache License, Version 2.0.", "apache-2.0"),
            (7, None, "unknown"), (8, "", "unknown"), (9, "public general version licensed gnu the this 3 under work license is", "unknown")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, want string")
    model = licenses.fit(small(spark, "documents"))
    for r in licenses.scan_licenses(frame, model).collect():
        assert r["family"] == r["want"], r
    assert licenses.scan_licenses(odd_docs.withColumnRenamed("lang", "family"), model).count() == odd_docs.count()
    assert licenses.scan_licenses(odd_docs.limit(0), licenses.fit(odd_docs.limit(0))).count() == 0


def test_licenses_across_lines():
    model = licenses.train([f"thing{i} ouble erent and anre tion shea".split() for i in range(200)])
    wrapped = "This work is licensed under the GNU\nGeneral Public License, version 3."
    filler = "thing ouble erent and anre tion shea\n"
    found = lambda text: sorted(model.find(text))
    assert found(wrapped.replace("\n", " ")) == [(0, "gpl")]
    assert found(wrapped) == found(wrapped.replace("\n", "\n * ")) == [(0, "gpl")]
    assert found(filler * 3 + wrapped + "\n" + filler * 3) == [(3, "gpl")]
    assert found(filler * 40 + wrapped + "\n" + filler * 40) == [(40, "gpl")]
    assert found(filler.strip() + " " + (filler.replace("\n", " ") * 12) + wrapped + " " + filler.replace("\n", " ") * 12) == [(0, "gpl")]
    assert found("Licensed under the\nApache License,\nVersion 2.0.\nReleased under the MIT License.") == [(0, "apache-2.0"), (3, "mit")]
    assert found("Licensed under the\nApache License,\nVersion 2.0.\nReleased under\nthe MIT License.") == [(0, "apache-2.0"), (3, "mit")]
    assert found(wrapped.replace("\n", "\n\n")) == found(filler * 20) == found(None) == found("") == []


def test_gradients_of_the_network():
    rng = np.random.default_rng(0)
    p = {"W0": rng.normal(size=(4, 9)), "W1": rng.normal(size=(4, 9)), "U0": rng.normal(size=(3, 9)), "U1": rng.normal(size=(3, 9)),
         "a0": rng.normal(size=9), "a1": rng.normal(size=9), "c0": rng.normal(size=3), "c1": rng.normal(size=3),
         "v": rng.normal(size=6), "w": rng.normal(size=6), "b": np.zeros(1)}
    x, y = rng.normal(size=(5, 6, 4)), np.array([0, 1, 1, 0, 1, 0.0])
    mask = np.ones((5, 6), bool)
    mask[3:, 2] = False
    g, dx, _ = toxicity._gradients(x, mask, y, p)
    loss = lambda: toxicity._gradients(x, mask, y, p)[2]
    for name, at in (("W0", (1, 2)), ("U1", (2, 5)), ("U0", (0, 8)), ("c1", (1,)), ("v", (4,)), ("w", (2,)), ("a0", (7,)), ("b", (0,))):
        p[name][at] += 1e-5
        up = loss()
        p[name][at] -= 2e-5
        assert g[name][at] == pytest.approx((up - loss()) / 2e-5, abs=1e-6)
        p[name][at] += 1e-5
    x[1, 2, 3] += 1e-5
    up = loss()
    x[1, 2, 3] -= 2e-5
    assert dx[1, 2, 3] == pytest.approx((up - loss()) / 2e-5, abs=1e-6)


def test_toxicity_on_unseen_texts(spark, odd_docs):
    rng = random.Random(3)
    plain = ["".join(rng.choice(["an", "the", "re", "on", "st", "ou"]) for _ in range(rng.randrange(1, 4))) for _ in range(300)]
    made = []
    for i in range(500):
        w = [rng.choice(plain) for _ in range(rng.randrange(20, 150))]
        if i % 3 == 0:
            for _ in range(3):
                w[rng.randrange(len(w))] = rng.choice(["zkarg", "blorp", "zkargish"])
        made.append((i, " ".join(w), int(i % 3 == 0)))
    docs = spark.createDataFrame(made, "doc_id long, text string, toxic int")
    model = toxicity.fit(docs.drop("toxic"), docs.select("doc_id", "toxic"), steps=120)
    rows = toxicity.score_toxicity(docs, model).collect()
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert sum(r["predicted"] == r["toxic"] for r in held) >= 0.95 * len(held)
    odd = toxicity.score_toxicity(odd_docs.withColumnRenamed("size", "score"), model).collect()
    assert len(odd) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in odd)
    assert toxicity.fit(docs.drop("toxic"), docs.select("doc_id", "toxic").limit(0)) is None
    assert toxicity.score_toxicity(odd_docs.limit(0), None).count() == 0
    assert toxicity.starts(33) == [0, 1] and toxicity.starts(32) == [0] and toxicity.starts(100)[-1] == 68


def test_toxicity_reads_long_runs_whole(spark):
    for n in (39, 40, 41, 60, 61, 250):
        run = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(n))
        parts = toxicity.words(f"short {run} end")
        assert parts[0] == "short" and parts[-1] == "end" and max(map(len, parts)) <= 40
        assert {run[i:i + 20] for i in range(n - 19)} <= {p[i:i + 20] for p in parts for i in range(len(p) - 19)}
    rng = random.Random(2)
    plain = ["".join(rng.choices(["an", "the", "re", "stone", "ul"], k=3)) for _ in range(60)]
    docs = [" ".join(rng.choices(plain, k=30)) + (f" zkarg{rng.choice(plain)} blorp{rng.choice(plain)}" if i % 3 == 0 else "") for i in range(240)]
    scorer = toxicity.Scorer(toxicity.train(docs, [int(i % 3 == 0) for i in range(240)], steps=100))
    around = "_".join(["the", "stone"] * 12)
    clean, bad = scorer.scores([f"{around}_{term}_{around}" for term in ("stone_stone", "zkarg_blorp")])
    assert bad > clean


def brute_sets(text, n=5):
    w = re.findall(r"\w+", (text or "").lower())
    return frozenset(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))) if w else None


def test_jaccard_against_brute_force(spark, odd_docs):
    rng = random.Random(8)
    base = [f"w{rng.randrange(5000)}" for _ in range(200)]
    made = []
    for i in range(80):
        w = list(base)
        for _ in range(rng.randrange(1, 9)):
            w[rng.randrange(len(w))] = f"v{rng.randrange(9999)}"
        made.append((1000 + i, " ".join(w)))
    docs = small(spark, "documents").select("doc_id", "text").unionByName(spark.createDataFrame(made, "doc_id long, text string")).unionByName(
        odd_docs.select("doc_id", "text"))
    rows = docs.collect()
    sets = {s: i for i, s in enumerate({brute_sets(r["text"]) for r in rows} - {None})}
    order = list(sets)
    root, degree = list(range(len(order))), [0] * len(order)
    for i, a in enumerate(order):
        for j in range(i):
            if min(len(a), len(order[j])) >= 0.8 * max(len(a), len(order[j])) and len(a & order[j]) >= 0.8 * len(a | order[j]) - 1e-9:
                degree[i] += 1
                degree[j] += 1
                old, new = root[i], root[j]
                root = [new if x == old else x for x in root]
    low = {}
    for r in rows:
        if (s := brute_sets(r["text"])) is not None and r["doc_id"] is not None:
            c = root[sets[s]]
            low[c] = min(low.get(c, 10 ** 9), r["doc_id"])
    want = Counter()
    for r in rows:
        s = brute_sets(r["text"])
        want[(r["doc_id"], r["doc_id"] if s is None else low.get(root[sets[s]]), 0 if s is None else degree[sets[s]])] += 1
    got = jaccard.linked(docs, block=16).collect()
    assert Counter((r["key"], r["class_id"], r["links"]) for r in got) == want
    kept = jaccard.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect())
    assert {3, 4, 5, 7, 8, 10} <= set(ids) and 6 not in ids and 9 not in ids and ids.count(1) == 1
    assert jaccard.linked(docs.limit(0)).count() == 0


def test_keep_one_with_null_and_repeated_ids(spark):
    text = lambda name: " ".join(f"{name}{i}" for i in range(40))
    rows = [(None, text("a")), (None, text("b")), (None, text("b")), (7, text("c")), (7, text("d")), (7, text("d") + " end"),
            (8, text("e")), (None, text("e")), (9, None), (None, "")]
    kept = jaccard.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    near = Counter((r["doc_id"], (r["text"] or "")[:3]) for r in kept)
    assert near == Counter([(None, "a0 "), (None, "b0 "), (7, "c0 "), (7, "d0 "), (8, "e0 "), (9, ""), (None, "")])


def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=12) * (1 + i % 3)]) for i in range(300)]
    rows += [(300, None), (301, [1.0, None]), (302, [float("nan")] * 12), (303, [float("inf")] * 12), (304, [1e12] * 12), (305, [])]
    rows += [(400 + i, rows[20][1]) for i in range(30)] + [(40, rows[40][1]), (None, rows[3][1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").select("vec_id", topk.integer_components("embedding").alias("v"))
    held = [(i, np.floor(64 * np.array(v)).astype(object)) for i, v in rows if i is not None and v is not None
            and all(x is not None and np.isfinite(x) for x in v)]
    asked = {i: v for i, v in held if i % 20 == 0}
    dot = lambda a, b: int(sum(int(x) * int(y) for x, y in zip(a, b, strict=False)))
    for block in (8192, 37):
        got = defaultdict(list)
        for r in topk.top_k(frame.where("vec_id % 20 = 0"), frame, k=20, query_block=7, candidate_block=block).orderBy("query_id", "rank").collect():
            got[r["query_id"]].append((r["vec_id"], r["score"]))
        assert set(got) == set(asked)
        for q, v in asked.items():
            assert got[q] == sorted(((i, dot(v, c)) for i, c in held if i != q), key=lambda x: (-x[1], x[0]))[:20]
    assert topk.top_k(frame.limit(0), frame).count() == 0
