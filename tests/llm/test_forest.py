"""The sorted prefix tries against brute force, and how far prefixes are shortened."""

import random
from collections import defaultdict

import pytest

from tallyhouse.llm import jaccard
from tallyhouse.llm.common import shared_folder

DEPTH, TREES = 4, 3


def groups_of(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for u, v in edges:
        root[find(u)] = find(v)
    out = defaultdict(set)
    for x in list(root):
        out[find(x)].add(x)
    return {frozenset(g) for g in out.values() if len(g) > 1}


@pytest.mark.parametrize("partitions", ["3", "40"])
def test_trie_edges_connect_what_shares_a_prefix(spark, partitions):
    rng = random.Random(4)
    rows = []
    for i in range(300):
        # One label that very many sets share, common prefixes, and lone labels.
        labels = [bytes(16) if i % 3 == 0 and t == 0 else b"".join(rng.choice([b"\x00\x01", b"\x00\x02", b"\x01\x00"]) if d < 3 else rng.randbytes(2)
                                                                   for d in range(DEPTH)) for t in range(TREES)]
        rows.append((i * 7 - 500, [x[:2 * DEPTH] for x in labels]))
    rows.append((rows[0][0], rows[0][1]))  # a copy
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        member = spark.createDataFrame(rows, "id long, labels array<binary>").repartition(5)
        edges = jaccard.forest(member, DEPTH, 2, shared_folder(spark)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert all(e["u"] > e["v"] and 2 <= e["common"] <= DEPTH for e in edges) and len({(e["u"], e["v"]) for e in edges}) == len(edges)
    for length in (2, 3, 4):
        want = defaultdict(list)
        for i, labels in rows:
            for t, x in enumerate(labels):
                want[t, x[:2 * length]].append(i)
        pairs = [(a, b) for g in want.values() for a, b in zip(g, g[1:], strict=False)]
        assert groups_of((e["u"], e["v"]) for e in edges if e["common"] >= length) == groups_of(pairs)
    assert jaccard.forest(member.limit(0), DEPTH, 2, shared_folder(spark)).count() == 0


@pytest.mark.parametrize(("changed", "fewest"), [(1, True), (18, False)])
def test_prefixes_are_shortened_as_far_as_needed(spark, monkeypatch, changed, fewest):
    """Links far above the threshold are met by whole labels; links at the threshold need the shortest prefixes."""
    rng, lengths = random.Random(2), []
    rows = []
    for i in range(40):
        w = [f"d{i}w{j}" for j in range(900)]
        rows.append((2 * i, " ".join(w)))
        for k in range(changed):
            w[k * 900 // changed] = f"x{rng.random()}"
        rows.append((2 * i + 1, " ".join(w)))
    links = jaccard._links
    monkeypatch.setattr(jaccard, "_links", lambda *a: lengths.append(len(lengths)) or links(*a))
    got = jaccard.linked(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["key"], r["class_id"], r["links"]) for r in got} == {(i, i - i % 2, 1) for i in range(80)}
    least = jaccard.level(0.8, 32, 8, 0.99999)
    assert len(lengths) == (1 if fewest else 2) and least < 8
