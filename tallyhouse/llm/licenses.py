"""License scans: a trained paragraph classifier with a calibrated unknown class, confirmed against templates.

Each line is judged alone (longer ones as overlapping windows of words), then what crosses line ends inside a paragraph
(lines up to a blank one): runs of neighbouring lines of at most ``WINDOW`` words, and overlapping windows of the whole
paragraph. A notice found across lines is reported at its first line, unless its family is found on these lines already.
All these pieces become sparse binary word 1- to 3-grams over the
vocabulary of the licence templates, without those that ordinary text holds too. A multinomial logistic regression over
licence families and ``unknown`` is fitted in numpy on variants of the templates (words dropped, replaced and surrounded
by ordinary words) and on ordinary paragraphs: a bounded sample of the collection and scrambled templates. The lowest
probability at which held-out ordinary paragraphs stay unknown sets the cut-off. A prediction counts only if the
paragraph also holds at least ``confirm`` of the word pairs of one of the family's templates.

Defined results: null and empty texts have no paragraphs and the family ``unknown``; repeated rows get equal results;
an empty table gives no rows; with no ordinary paragraphs to learn from, scrambled templates alone stand for them.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.common import row_key

_WORD = re.compile(r"[a-z0-9][a-z0-9.+\-]*[a-z0-9+]|[a-z0-9]")
UNKNOWN = "unknown"
WINDOW, STRIDE = 60, 30

# Short notices by which works name their licence, by family.
TEMPLATES: dict[str, list[str]] = {
    "agpl": ["licensed under the gnu affero general public license version 3",
             "released under the agpl-3.0 license",
             "you can redistribute it and/or modify it under the terms of the gnu affero general public license"],
    "apache-2.0": ["licensed under the apache license version 2.0",
                   "released under the apache 2.0 license",
                   "you may not use this file except in compliance with the license you may obtain a copy of the license",
                   "spdx-license-identifier apache-2.0"],
    "bsd": ["released under the bsd license", "licensed under the bsd 3-clause license",
            "licensed under the bsd 2-clause license", "spdx-license-identifier bsd-3-clause",
            "redistribution and use in source and binary forms with or without modification are permitted"],
    "cc-by": ["licensed under cc by 4.0", "licensed under a creative commons attribution 4.0 international license",
              "this work is licensed under cc-by-4.0"],
    "cc-by-nc": ["licensed under cc by-nc 4.0",
                 "licensed under a creative commons attribution-noncommercial 4.0 international license",
                 "this work is licensed under cc-by-nc-4.0"],
    "cc-by-nd": ["licensed under cc by-nd 4.0",
                 "licensed under a creative commons attribution-noderivatives 4.0 international license"],
    "cc-by-sa": ["licensed under cc by-sa 4.0",
                 "licensed under a creative commons attribution-sharealike 4.0 international license",
                 "this text is available under the creative commons attribution-sharealike license"],
    "gpl": ["this work is licensed under the gnu general public license version 3",
            "released under the gnu general public license version 2", "released under the gpl-3.0 license",
            "you can redistribute it and/or modify it under the terms of the gnu general public license"],
    "isc": ["released under the isc license", "spdx-license-identifier isc"],
    "lgpl": ["licensed under the gnu lesser general public license version 3",
             "released under the lgpl-2.1 license"],
    "mit": ["released under the mit license", "licensed under the mit license", "spdx-license-identifier mit",
            "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"],
    "mpl": ["licensed under the mozilla public license version 2.0", "released under the mpl-2.0 license"],
    "proprietary": ["all rights reserved", "all rights reserved no part may be reproduced without written permission",
                    "proprietary and confidential unauthorized copying is strictly prohibited"],
    "public-domain": ["dedicated to the public domain", "released into the public domain",
                      "cc0 1.0 universal public domain dedication", "this is free and unencumbered software released"],
}


def tokens(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def grams(words: list[str]) -> set[str]:
    return {" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)}


def paragraphs(text: str | None):
    """(line number, words) of each line, longer lines as overlapping windows that end with the line."""
    for at, line in enumerate(text.split("\n") if text else ()):
        for words in windows(tokens(line)):
            yield at, words


def windows(words: list) -> list[list]:
    """The words if they are few (none give no window), else overlapping windows that end with them."""
    if len(words) <= WINDOW:
        return [words] if words else []
    return [words[a:a + WINDOW] for a in [*range(0, len(words) - WINDOW, STRIDE), len(words) - WINDOW]]


def crossing(lines: list[list[str]], marked: list[bool]):
    """(line of each word, words) of what crosses line ends, runs of lines before windows, shorter runs first.

    ``marked`` tells the lines with a template's word pair, the pair across their end included. A run must start with a
    marked line and hold a pair in or before its last line: all pairs of another run are in a shorter one.
    """
    size = [len(words) for words in lines]
    runs = []
    for i in range(len(lines)):
        total, j = size[i], i + 1
        while marked[i] and j < len(lines) and (total := total + size[j]) <= WINDOW:
            if marked[j] or marked[j - 1]:
                runs.append((j - i, i, j))
            j += 1
    for _, i, j in sorted(runs):
        yield [k for k in range(i, j + 1) for _ in lines[k]], [w for words in lines[i:j + 1] for w in words]
    if any(marked) and sum(size) > WINDOW:
        numbered = windows([(k, w) for k, words in enumerate(lines) for w in words])
        for window in numbered:
            of = [k for k, _ in window]
            if of[0] < of[-1] and any(marked[of[0]:of[-1] + 1]):
                yield of, [w for _, w in window]


@dataclass
class Model:
    families: list[str]
    columns: dict[str, int]
    weights: np.ndarray
    cut: float
    pairs: dict[str, list[set[tuple[str, str]]]]
    confirm: float

    def __post_init__(self):
        # A paragraph without a vocabulary word is unknown whatever else it holds.
        self.words = {w for g in self.columns for w in g.split(" ")}
        self.any_pair = set().union(*(t for templates in self.pairs.values() for t in templates))

    def probabilities(self, words: list[str]) -> np.ndarray | None:
        """Of the families; None if the paragraph holds no gram of the vocabulary (then it is unknown)."""
        at = [i for g in grams(words) if (i := self.columns.get(g)) is not None]
        return _softmax(self.weights[at].sum(0)[None] + self.weights[-1])[0] if at else None

    def judge(self, words: list[str]) -> tuple[str, float] | None:
        if (p := self.probabilities(words)) is None:
            return None
        best = int(np.argmax(p))
        family = self.families[best]
        if family == UNKNOWN or p[best] < self.cut:
            return None
        mine = set(zip(words, words[1:], strict=False))
        shared = max(len(mine & t) / len(t) for t in self.pairs[family])
        return (family, float(p[best])) if shared >= self.confirm else None

    def find(self, text: str | None) -> dict[tuple[int, str], float]:
        """Probability by (line, family)."""
        best: dict[tuple[int, str], float] = {}
        block: list[tuple[int, list[str]]] = []
        for at, line in enumerate(text.split("\n") if text else ()):
            words = tokens(line)
            for window in windows(words):
                if not self.words.isdisjoint(window) and (hit := self.judge(window)):
                    best[at, hit[0]] = max(best.get((at, hit[0]), 0.0), hit[1])
            if words:
                block.append((at, words))
            elif not line.strip():
                self._across(block, best)
                block = []
        self._across(block, best)
        return best

    def _across(self, block: list[tuple[int, list[str]]], best: dict[tuple[int, str], float]) -> None:
        """Add what is found across the line ends of one paragraph."""
        if len(block) < 2:
            return
        lines = [words for _, words in block]
        marked = [not self.any_pair.isdisjoint(zip(words, (*words[1:], *after[:1]), strict=False))
                  for words, after in zip(lines, (*lines[1:], ()), strict=True)]
        taken = [(family, line, line) for line, family in best]
        for of, words in crossing(lines, marked):
            if (hit := self.judge(words)) is None:
                continue
            # The lines that hold the pairs of the template that fits best.
            mine = list(zip(words, words[1:], strict=False))
            template = max(self.pairs[hit[0]], key=lambda t: len(t.intersection(mine)) / len(t))
            at = [i for i, pair in enumerate(mine) if pair in template]
            a, b = block[of[at[0]]][0], block[of[at[-1] + 1]][0]
            if not any(f == hit[0] and low <= b and a <= high for f, low, high in taken):
                taken.append((hit[0], a, b))
                best[a, hit[0]] = hit[1]


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train(ordinary: list[list[str]], variants: int = 60, rounds: int = 300, rate: float = 0.5, decay: float = 1e-4,
          confirm: float = 0.6, common: float = 0.01, seed: int = 11) -> Model:
    """Fit on variants of the templates against ordinary paragraphs."""
    rng = np.random.default_rng(seed)
    families = [*sorted(TEMPLATES), UNKNOWN]
    split = [t for f in sorted(TEMPLATES) for t in map(tokens, TEMPLATES[f])]
    seen: dict[str, int] = {}
    for words in ordinary:
        for g in grams(words):
            seen[g] = seen.get(g, 0) + 1
    vocabulary = sorted({g for t in split for g in grams(t) if seen.get(g, 0) <= common * len(ordinary)})
    columns = {g: i for i, g in enumerate(vocabulary)}
    pool = [w for p in ordinary for w in p] or ["lorem", "ipsum", "dolor", "sit", "amet"]
    draw = lambda n: [pool[i] for i in rng.integers(0, len(pool), n)]
    rows: list[tuple[list[str], int]] = []
    for f, family in enumerate(sorted(TEMPLATES)):
        for template in map(tokens, TEMPLATES[family]):
            for _ in range(variants):
                keep = [w if rng.random() > 0.04 else draw(1)[0] for w in template if rng.random() > 0.04]
                rows.append((draw(int(rng.integers(0, 20))) + keep + draw(int(rng.integers(0, 20))), f))
                # The same words without their order say nothing.
                loose = [w for w in rng.permutation(template).tolist() if rng.random() > 0.6]
                rows.append((draw(10) + [x for w in loose for x in (w, *draw(3))], len(families) - 1))
    rows += [(p, len(families) - 1) for p in ordinary]
    order = rng.permutation(len(rows))
    held, fitted = order[:len(order) // 5], order[len(order) // 5:]

    def matrix(which):
        at = [[columns[g] for g in grams(rows[i][0]) if g in columns] for i in which]
        x = np.zeros((len(which), len(columns) + 1), np.float32)
        x[:, -1] = 1
        x[np.repeat(np.arange(len(which)), [len(a) for a in at]), np.array([c for a in at for c in a], np.int64)] = 1
        return x, np.array([rows[i][1] for i in which])

    x, y = matrix(fitted)
    weights = np.zeros((x.shape[1], len(families)), np.float32)
    target = np.eye(len(families), dtype=np.float32)[y]
    squares = np.zeros_like(weights)
    for _ in range(rounds):
        g = x.T @ (_softmax(x @ weights) - target) / len(x) + decay * weights
        squares += g * g
        weights -= rate * g / (np.sqrt(squares) + 1e-6)
    hx, hy = matrix(held)
    p = _softmax(hx @ weights)[:, :-1].max(1)
    ordinary_p = np.sort(p[hy == len(families) - 1])
    cut = max(0.5, float(ordinary_p[int(0.999 * (len(ordinary_p) - 1))])) if len(ordinary_p) else 0.5
    pairs = {f: [set(zip(t, t[1:], strict=False)) for t in map(tokens, TEMPLATES[f])] for f in TEMPLATES}
    return Model(families, columns, weights, min(cut, 0.95), pairs, confirm)


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", sample: int = 400, lines: int = 4000, **options) -> Model:
    """Train with the first ``lines`` paragraphs of ``sample`` documents (shorter than 20,000 characters, lowest by a
    hash of the key) as ordinary text; those that hold a template's words in order are left out."""
    # Rows are chosen by their hashes; only the chosen ones send their text.
    named = docs.where(F.length(text) < 20_000).select(F.col(text).alias("t"), F.xxhash64(
        F.col(key).cast("string"), F.lit("license")).alias("o"), *row_key(key, text))
    chosen = named.select("o", "k1", "k2").orderBy("o", "k1", "k2").limit(sample)
    rows = named.select("k1", "k2", "t").join(F.broadcast(chosen), ["k1", "k2"]).dropDuplicates(["k1", "k2"]).orderBy("o", "k1").collect()
    ordinary = [w for r in rows for _, w in paragraphs(r["t"])][:lines]
    known = [set(zip(t, t[1:], strict=False)) for f in TEMPLATES for t in map(tokens, TEMPLATES[f])]
    free = [w for w in ordinary if all(len(k & set(zip(w, w[1:], strict=False))) < 0.5 * len(k) for k in known)]
    return train(free, **options)


_SCHEMA = T.StructType([
    T.StructField("family", T.StringType()), T.StructField("probability", T.DoubleType()),
    T.StructField("licenses", T.ArrayType(T.StructType([
        T.StructField("line", T.IntegerType()), T.StructField("family", T.StringType()),
        T.StructField("probability", T.DoubleType())])))])
_HIT = pa.list_(pa.struct([("line", pa.int32()), ("family", pa.string()), ("probability", pa.float64())]))


def scan_licenses(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``family`` (the most probable found, else ``unknown``), its ``probability`` and all findings by line."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # a fixed size: the templates' vocabulary
    names = [c for c in docs.columns if c not in _SCHEMA.names]
    schema = T.StructType([docs.schema[c] for c in names] + _SCHEMA.fields)
    where = names.index(text)

    def run(batches):
        m = sent.value
        for batch in batches:
            found = []
            for value in batch.column(where):
                best = m.find(value.as_py())
                found.append([{"line": k[0], "family": k[1], "probability": p} for k, p in sorted(best.items())])
            top = [max(f, key=lambda h: (h["probability"], h["family"])) if f else None for f in found]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([t["family"] if t else UNKNOWN for t in top], pa.string()),
                 pa.array([t["probability"] if t else 0.0 for t in top], pa.float64()), pa.array(found, _HIT)],
                names=schema.names)

    return docs.select(names).mapInArrow(run, schema)
