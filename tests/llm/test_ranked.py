"""Ranked search against the formula, row by row, and its defined edge cases."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest

from fulluse.llm import ranked
from tests.llm.brute import FOLD
from tests.llm.conftest import SF

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute(docs, items, k):
    """docs: (doc_id, text) in rows; items: id to texts."""
    held = [(d, Counter(TERM.findall((t or "").translate(FOLD)))) for d, t in docs]
    held = [(d, c) for d, c in held if c]
    n_docs, total = len(held), sum(c.total() for _, c in held)
    df = Counter(w for _, c in held for w in c)
    out = {}
    for item, texts in items.items():
        terms = {w for t in texts for w in TERM.findall((t or "").translate(FOLD)) if w in df}
        weights = {w: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) for w in terms}
        scores = []
        for d, c in held:
            m = 50 + 50 * c.total() * n_docs // total
            score = sum(w * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t, w in weights.items() if t in c)
            if score > 0:
                scores.append((-score, d if d is not None else -math.inf))
        out[item] = [(i + 1, None if d == -math.inf else d, -s) for i, (s, d) in enumerate(sorted(scores)[:k])]
    return {item: rows for item, rows in out.items() if rows}


def found(df):
    out = {}
    for r in df.orderBy("item_id", "rank").collect():
        out.setdefault(r["item_id"], []).append((r["rank"], r["doc_id"], r["score"]))
    return out


@pytest.mark.parametrize("k,block", [(3, 8), (50, 1 << 16)])
def test_ranked(spark, docs, corpus, scratch, monkeypatch, k, block):
    monkeypatch.setattr(ranked, "BLOCK", block)
    texts = [t for _, t in corpus if t]
    items = [(i, " ".join(t.split()[:9])) for i, t in enumerate(sorted(texts, key=len)[-20:])]
    items += [(20, None), (21, "..."), (22, "nowhere1 nowhere2"), (23, "Short, DON'T re"), (None, "日 short é"), (0, "short")]
    table = spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id long, text string, terms string, n long")
    by_item = {}
    for i, t in items:
        by_item.setdefault(i, []).append(t)
    assert found(ranked.search(docs, table, scratch, k=k)) == brute(corpus, by_item, k)


def test_ranked_on_given_tables(spark, scratch):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()], {r["item_id"]: [r["text"]] for r in items.collect()}, 10)
    assert found(ranked.search(docs, items, scratch, k=10)) == want


def test_items_in_groups(spark, docs, scratch, monkeypatch):
    items = spark.createDataFrame([(i, f"short x y {i}") for i in range(9)], "item_id long, text string")
    whole = found(ranked.search(docs, items, scratch))
    few = ranked.item_groups
    monkeypatch.setattr(ranked, "item_groups", lambda items, scratch: few(items, scratch, 30))
    assert found(ranked.search(docs, items, scratch)) == whole


def test_accumulators_stop(monkeypatch):
    """A frequent term behind a rare one makes no accumulators once k documents are ahead, and scores stay exact."""
    n = 1000
    ids = np.arange(n)
    terms = [np.array([0, 1] if d < 10 else [1], np.int32) for d in range(n)]
    counts = np.array([len(t) for t in terms])
    block = ranked.Block(ids, ids, np.full(n, 5), counts, np.concatenate(terms), np.ones(counts.sum(), np.int32), n, 2, 5 * n, 50)
    seen = []
    monkeypatch.setattr(block, "of", lambda t, of=block.of: seen.append(t) or of(t))
    rows, scores = ranked.best(block, [(0, 5000), (1, 10)], 5, 0)
    every = ranked.best(block, [(0, 5000), (1, 10)], n, 0)
    assert seen[:2] == [0, 1] and rows.tolist() == list(range(10)) and len(every[0]) == n
    assert scores.tolist() == every[1][:10].tolist()


def test_ranked_of_nothing(spark, docs, scratch):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "short")], "item_id long, text string")
    assert ranked.search(docs, none, scratch).count() == 0
    assert ranked.search(docs.limit(0), some, scratch).count() == 0
    twice = spark.createDataFrame([(7, "short"), (7, "short"), (None, "short")], "doc_id long, text string")
    rows = ranked.search(twice.union(spark.createDataFrame([(8, "long")] * 9, twice.schema)), some, scratch).collect()
    assert [r["doc_id"] for r in sorted(rows, key=lambda r: r["rank"])] == [None, 7, 7]
