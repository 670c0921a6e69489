"""Ranked search against brute force on odd rows, with bounds that never fall below a score."""

import collections
import math
import random
import re

import numpy as np
import pytest

from stratum.llm import ranked_search
from stratum.llm.ranked_search import Queries, digest, search, signature_index, terms_of

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute(docs, items, k=10):
    lower = lambda t: TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    rows = [(i, collections.Counter(w), len(w)) for i, t in docs if (w := lower(t))]
    n_docs, n_terms = len(rows), sum(n for _, _, n in rows)
    df = collections.Counter(t for _, c, _ in rows for t in c)
    made = []
    for item, text in items:
        scores = []
        for i, c, n in rows:
            m = 10 + 90 * n * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(lower(text)) if c[t])
            if s > 0:
                scores.append((-s, i is None, i or 0))
        made += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scores)[:k])]
    return made


def _made(seed):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["É", "the", "THE", "中文"]
    text = lambda n: " ".join(r.choice(words[:r.choice([5, 64])]) + r.choice(["", ",", "."]) for _ in range(n))
    docs = [(i, text(r.choice([0, 1, 3, 10, 200]))) for i in range(120)]
    docs += [(500 + i, docs[7][1] + " w1 w2 w3") for i in range(40)]  # copies
    docs += [(3, None), (4, ""), (None, "w1 w2 w59"), (None, "w1 w2 w59"), (9, " ... "), (10, "the " * 5000 + "w40"), (11, docs[11][1]), (11, docs[11][1])]
    items = [(i, text(12)) for i in range(8)] + [(1, "w1 w2 w59"), (None, "w1 w2 w59"), (20, None), (21, ""), (22, "absent"), (23, "the the W40")]
    return docs, items


def _rows(spark, docs, items):
    return (spark.createDataFrame([(t, i, 0) for i, t in docs], "text string, doc_id long, score int").repartition(5),
            spark.createDataFrame([(i, t, "clash") for i, t in items], "item_id long, text string, doc_id string"))


def test_search_against_brute_force(spark):
    docs, items = _made(1)
    d, i = _rows(spark, docs, items)
    got = search(d, i)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute(docs, items), key=repr)
    assert search(d.limit(0), i).count() == search(d, i.limit(0)).count() == 0


def test_search_in_several_chunks_and_flushes(spark, monkeypatch):
    """Small limits: several chunks of queries, texts joined by a shuffle."""
    monkeypatch.setattr(ranked_search, "CHUNK_TERMS", 30)
    monkeypatch.setattr(ranked_search, "CANDIDATES_MB", 0)
    docs, items = _made(2)
    assert sorted(map(tuple, search(*_rows(spark, docs, items), k=3).collect()), key=repr) == sorted(brute(docs, items, 3), key=repr)


def test_bounds_hold_and_are_tight(spark):
    docs, items = _made(3)
    d, _ = _rows(spark, docs, items)
    index = signature_index(d.select("doc_id", "text"))
    rows = {digest(t): collections.Counter(terms_of(t)) for _, t in docs if terms_of(t)}
    blocks = index.filter("size IS NOT NULL").collect()
    assert sum(len(b.ids) for b in blocks) == sum(1 for _, t in docs if terms_of(t))
    df = collections.Counter()
    for r in index.filter("term IS NOT NULL").collect():
        df[bytes(r.term)] += r.df
    assert df == collections.Counter(w for _, t in docs for w in set(terms_of(t)))
    asked = [(q, w) for q, (_, t) in enumerate(items) for w in set(terms_of(t))]
    queries = Queries([q for q, _ in asked], [w for _, w in asked], [7] * len(asked), 150, 9000)
    slack = []
    for b in blocks:
        cells = np.frombuffer(bytes(b.slices), dtype=np.uint8).reshape(b.size, -1)
        for first, bounds in queries.bounds(b.size, np.array(b.lengths), cells):
            for row, q in enumerate(queries.names):
                for j, bound in enumerate(bounds[row].tolist()):
                    score = queries.score(q, rows[bytes(b.digests[first + j])], b.lengths[first + j])
                    assert bound >= score
                    slack.append(bound > 1.3 * score)
    assert sum(slack) < 0.15 * len(slack)
