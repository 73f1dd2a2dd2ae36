"""Ranked search against scoring of every document, and against SQL."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from wirelens.llm import lexical, queries

DOCS = "doc_id long, text string, item_id long, score string, n int"
ITEMS = "item_id long, text string, doc_id string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def wanted(docs, items, k):
    lists = [(i, words(t)) for i, t in docs]
    held = [(i, x) for i, x in lists if x]
    n_docs, n_terms = len(held), sum(len(x) for _, x in held)
    df = Counter(t for _, x in held for t in set(x))
    out = []
    for item, text in items:
        if text is None:
            continue
        scores = []
        for i, x in held:
            tf, m = Counter(x), 50 + 50 * len(x) * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * tf[t] // (1000 * tf[t] + 20 * m)) for t in set(words(text)) if t in tf)
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def zipf(r, n):
    return " ".join(f"w{int(r.paretovariate(0.7)) % 3000}" for _ in range(n))


@pytest.fixture(params=[(1 << 21, 128, 64), (3000, 16, 8), (500, 4, 0)])
def sizes(request, monkeypatch):
    for name, value in zip(("BLOCK_POSTINGS", "RANGE", "SHORT"), request.param):
        monkeypatch.setattr(lexical, name, value)


def blocks_search(docs, items, k):
    """The task's part without Spark, so that block sizes can be set."""
    vocabulary = {}
    queries_ = [np.unique(np.array([vocabulary.setdefault(t, len(vocabulary)) for p in lexical.terms(x) for t in p], np.int64)) for _, x in items]
    rows = [(i, Counter(t for p in lexical.terms(x) for t in p)) for i, x in docs]
    rows = [(i, c) for i, c in rows if c]
    df = np.zeros(len(vocabulary), np.int64)
    for _, c in rows:
        for t in c:
            if t in vocabulary:
                df[vocabulary[t]] += 1
    total = sum(sum(c.values()) for _, c in rows)
    best, visited, ranges = lexical.Best(k, len(items)), 0, 0
    step = max(1, lexical.BLOCK_POSTINGS // 30)
    for at in range(0, len(rows), step):
        part = rows[at : at + step]
        lists = [sorted((vocabulary[t], n) for t, n in c.items() if t in vocabulary) for _, c in part]
        flat = np.array([x for y in lists for x in y], np.int64).reshape(-1, 2)
        block = lexical.Block(np.array([i for i, _ in part]), np.array([sum(c.values()) for _, c in part]), np.array([len(x) for x in lists]), flat[:, 0], flat[:, 1], lexical.weights(len(rows), df), len(rows), total)
        for q, x in enumerate(queries_):
            visited += block.search(q, x, best)
            ranges += block.ranges
    out = [(items[q][0], r, d, s) for q in range(len(items)) for r, (d, s) in enumerate(zip(best.ids[q].tolist(), best.scores[q].tolist()), 1)]
    return sorted(out, key=str), visited, ranges


def test_blocks_equal_all_scores(sizes):
    r = random.Random(7)
    docs = [(i, zipf(r, r.randrange(1, 60))) for i in range(2000)] + [(3000 + i, "w1 w2 rare") for i in range(300)]
    r.shuffle(docs)
    items = [(i, zipf(r, r.randrange(1, 25))) for i in range(12)] + [(20, "rare w1"), (21, "w1"), (22, "none at all")]
    got, visited, ranges = blocks_search(docs, items, 10)
    assert got == wanted(docs, items, 10)
    assert visited < ranges


def test_ranges_are_skipped():
    """A few documents hold a rare term; ranges of common terms alone can't reach the threshold."""
    r = random.Random(1)
    docs = [(i, "common often " + zipf(r, 5) + (" gem gem" if i % 500 == 7 else "")) for i in range(20_000)]
    got, visited, ranges = blocks_search(docs, [(0, "common often gem")], 10)
    assert got == wanted(docs, [(0, "common often gem")], 10) and visited <= 40 < ranges


def test_search_with_odd_rows(spark, tmp_path):
    r = random.Random(3)
    docs = [(i, zipf(r, 20)) for i in range(200)] + [(900, None), (901, ""), (902, " ..\n"), (None, "w1 w2 w5"), (None, "w1 w2 w5"), (903, "W1 é É_w2-w3"), (904, "w9 " * 100_000), (905, "x" * 50_000), (3, "w1 w2 w3 w4"), (3, "w1 w2 w3 w4")]
    items = [(i, zipf(r, 12)) for i in range(5)] + [(6, "é É W2 w2"), (7, None), (8, "..."), (None, "w1 w9"), (9, "w1 w2"), (9, "w3")]
    spark.createDataFrame([(*x, 1, "s", 2) for x in docs], DOCS).repartition(5).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(*x, "d") for x in items], ITEMS).write.parquet(str(tmp_path / "benchmark.parquet"))
    got = sorted(map(tuple, queries.op12_lexical(spark, str(tmp_path)).collect()), key=str)
    assert got == wanted(docs, items, 50)


def test_groups_of_items_and_empty_tables(spark, monkeypatch):
    r = random.Random(4)
    docs, items = [(i, zipf(r, 15)) for i in range(100)], [(i, zipf(r, 8)) for i in range(9)]
    d, q = spark.createDataFrame([(*x, 1, "s", 2) for x in docs], DOCS), spark.createDataFrame([(*x, "d") for x in items], ITEMS)
    monkeypatch.setattr(lexical, "GROUP_BYTES", 100)
    monkeypatch.setattr(lexical, "PIECE_BYTES", 16)
    assert sorted(map(tuple, lexical.search(d, q, 7).collect()), key=str) == wanted(docs, items, 7)
    assert lexical.search(d.limit(0), q).count() == 0 and lexical.search(d, q.limit(0)).count() == 0


def test_query_equals_sql(spark, sf):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = con.execute(queries.ORACLES["op12_lexical"]).fetchall()
    assert sorted(map(tuple, queries.op12_lexical(spark, sf).select("item_id", "rank", "doc_id", "score").collect())) == sorted(want)
