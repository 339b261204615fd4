"""Packing: plans against all multisets, pieces against the whole ids, defined edge cases."""

from __future__ import annotations

import itertools
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fulluse.llm import packing

WORDS = public_tokenizers.path("word_bpe_49k.json")


def word_ids(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORDS).encode(text, add_special_tokens=False).ids


@given(st.dictionaries(st.integers(1, 12), st.integers(1, 4), min_size=1, max_size=5))
@settings(max_examples=200, deadline=None)
def test_fill_is_closest_to_capacity(counts):
    sizes = sorted(counts)
    used = packing.fill(counts, sizes, 12)
    assert used[sizes[-1]] >= 1 and all(n <= counts[s] for s, n in used.items())
    ways = itertools.product(*(range(n + 1) for n in counts.values()))
    sums = [sum(s * k for s, k in zip(counts, way, strict=True)) for way in ways if way[list(counts).index(sizes[-1])]]
    assert sum(s * n for s, n in used.items()) == max(x for x in sums if x <= 12)


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 200), max_size=12))
@settings(max_examples=200, deadline=None)
def test_plan_places_each_token_once(counts):
    plan = packing.plan(counts, 64)
    parts, windows = defaultdict(list), defaultdict(list)
    for lots in plan.lots:
        for size, first, end, shift, length, window, per, before, at in lots:
            for rank in range(first, end):
                k = rank - first + before
                parts[size, rank].append((shift, length))
                windows[window + k // per].append((at + k % per * length, length))
    assert set(parts) == {(s, k) for s, n in counts.items() for k in range(n)}
    for (size, _), own in parts.items():
        assert [a for a, _ in sorted(own)] == [0, *np.cumsum([n for _, n in sorted(own)])[:-1]]
        assert sum(n for _, n in own) == size
    assert sorted(windows) == list(range(plan.windows))
    sizes = []
    for own in windows.values():
        assert [a for a, _ in sorted(own)] == [0, *np.cumsum([n for _, n in sorted(own)])[:-1]]
        sizes.append(sum(n for _, n in own))
    assert all(n <= 64 and not n & n - 1 for n in sizes)  # 64 is one itself
    assert sum(n < 64 for n in sizes) <= 6


def test_plan_does_not_grow_with_the_counts():
    counts = {s: 1 + s * 7919 % 50 for s in range(1, 4097)}
    small, large = packing.plan(counts), packing.plan({s: n * 10**6 for s, n in counts.items()})
    assert sum(map(len, large.lots)) < 3 * sum(map(len, small.lots)) < 200_000
    hot = packing.plan({3000: 10**9, 4096: 10**9, 1: 1})
    assert sum(map(len, hot.lots)) < 1000


@pytest.mark.parametrize("capacity", [4096, 50])
def test_pieces(docs, corpus, scratch, capacity):
    packed = packing.pack(docs, scratch, WORDS, capacity=capacity)
    rows = packing.digests(packed).collect()
    windows, found = defaultdict(list), defaultdict(list)
    for r in rows:
        windows[r["sequence_id"]].append((r["offset"], r["length"]))
        found[r["doc_id"]].append(r)
    for d, text in corpus:
        ids, at = [*word_ids(text or ""), 2], 0
        for r in sorted(found.pop(d), key=lambda r: r["start"]):
            own = np.array(ids[at : at + r["length"]], "<u4")
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(own.tobytes()))
            at += r["length"]
        assert at == len(ids)
    assert not found and sorted(windows) == list(range(len(windows)))
    sizes = Counter()
    for own in windows.values():
        assert [a for a, _ in sorted(own)] == [0, *np.cumsum([n for _, n in sorted(own)])[:-1]]
        sizes[sum(n for _, n in own)] += 1
    assert all(n == capacity or not n & n - 1 for n in sizes) and max(sizes) <= capacity
    whole = packing.sequences(packed).collect()
    assert sum(len(r["ids"]) for r in whole) == 4 * sum(n * k for n, k in sizes.items())
    assert all(len(r["ids"]) == 4 * r["length"] == 4 * r["ends"][-1] for r in whole)


def test_packing_edges(spark, scratch):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert packing.digests(packing.pack(none, scratch, WORDS)).count() == 0
    same = spark.createDataFrame([(None, "a b c"), (1, None), (1, None), (2, "a b c"), (2, "a b c")] * 3, "doc_id long, text string")
    rows = packing.digests(packing.pack(same, scratch, WORDS)).collect()
    assert sum(r["length"] for r in rows) == 3 * (4 + 1 + 1 + 4 + 4)
    assert {r["doc_id"] for r in rows} == {None, 1, 2}
