"""Hard negatives against all pairs, and their defined edge cases."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fulluse.llm import negatives

SHAPE = "vec_id long, embedding array<float>, label int, anchor string, score long"


def brute(rows, every, k=5, low=80, high=100):
    valid = [
        (v, g, [math.floor(256 * x) for x in e]) for v, e, g in rows
        if v is not None and g is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)
    ]
    out = set()
    for a, label, q in valid:
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, e, strict=False)), v, g) for v, g, e in valid if v != a)
        for p, v, _ in [s for s in scored if s[2] == label][:k]:
            fit = [(s, w) for s, w, g in scored if g != label and low * -p <= 100 * -s <= high * -p][:k]
            out |= {(a, v, i + 1, w, -p, -s) for i, (s, w) in enumerate(fit)}
    return out


def vectors(rng, n, dim, spread, labels=3):
    import struct

    def narrow(x):
        return struct.unpack("f", struct.pack("f", x))[0]

    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(4)]
    return [
        (k, [narrow(c + rng.gauss(0, spread)) for c in rng.choice(centres)], rng.randrange(labels)) for k in range(n)
    ]


@pytest.mark.parametrize("spread,bucket", [(0.3, 16), (1.5, 40)])
def test_negatives(spark, scratch, monkeypatch, spread, bucket):
    monkeypatch.setattr(negatives, "BUCKET", bucket)
    rng = random.Random(5)
    rows = vectors(rng, 300, 8, spread)
    rows += [(300 + k, rows[10][1], k % 3) for k in range(40)]  # copies
    rows += [(400, None, 1), (401, [1.0] * 8, None), (402, [1.0, None], 1), (410, [math.nan] * 8, 1), (403, [math.inf] * 8, 0)]
    rows += [(404, [], 1), (405, [0.0] * 8, 1), (420, [2.0, -1.0, 0.5], 2), (406, [1.0] * 30, 0), (None, [1.0] * 8, 1)]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], SHAPE).repartition(4)
    found = negatives.mine(table, F.col("vec_id") % 10 == 0, scratch, group=9)
    assert {tuple(r) for r in found.collect()} == brute(rows, 10)


def test_coordinates_prune():
    rng = random.Random(2)
    rows = [(k, x, 0) for k, x, _ in vectors(rng, 400, 6, 0.2)]
    data = negatives.matrix([np.array([math.floor(256 * x) for x in e], "<i8").tobytes() for _, e, _ in rows], 6)
    lengths = np.sqrt((data.astype(float) ** 2).sum(1))
    bucket = negatives.Bucket({
        "most": lengths.max(), "dim": 6, "ids": np.arange(400).astype("<i8").tobytes(),
        "labels": np.zeros(400, "<i8").tobytes(), "data": data.tobytes(),
        "orders": np.argsort(negatives.units(data), axis=0, kind="stable").T.astype("<u2").tobytes(),
    })
    fewer = 0
    for k in range(0, 400, 7):
        anchor = negatives.Anchor({"vec_id": k, "label": 0, "length": lengths[k], "data": data[k].tobytes()})
        exact = data @ data[k]
        least = float(sorted(exact)[-20])
        rows_found = bucket.candidates(anchor, least)
        chosen = np.arange(400)[rows_found]
        assert set(np.flatnonzero(exact >= least)) <= set(chosen)
        assert (bucket.scores(anchor, rows_found) == exact[rows_found]).all()
        fewer += len(chosen) < 200
    assert fewer > 29  # for most anchors less than half of the rows are compared


def test_large_components_and_nothing(spark, scratch):
    none = spark.createDataFrame([], SHAPE)
    assert negatives.mine(none, F.col("vec_id") % 2 == 0, scratch).count() == 0
    big = 2.0**35
    rows = [(0, [big, 1.0], 0), (1, [big, 2.0], 0), (2, [big, 0.5], 1), (3, [1e38, 1.0], 1)]
    table = spark.createDataFrame([(*r, None, None) for r in rows], SHAPE)
    found = {tuple(r) for r in negatives.mine(table, F.col("vec_id") == 0, scratch).collect()}
    most = 2**63 - 1
    assert found == {(0, 1, 1, 2, most, most), (0, 1, 2, 3, most, most)}
    lonely = spark.createDataFrame([(0, [1.0], 0, None, None), (0, [1.0], 1, None, None)], SHAPE)
    assert negatives.mine(lonely, F.col("vec_id") == 0, scratch).count() == 0
