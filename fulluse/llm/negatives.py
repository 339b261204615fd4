"""Hard negatives by coordinate pruning over length buckets.

Vectors are sorted by length and dealt into buckets; a bucket holds, for each coordinate, its rows in the order of that
coordinate of the unit vectors. An anchor that looks for inner products of at least t meets a bucket whose longest
vector has length m only if t / (own length * m), the cosine needed, is at most 1. A coordinate of the anchor's unit
vector at angle a then confines the same coordinate of a match to angles a - d to a + d, where d is the angle of that
cosine. The anchor's largest coordinates are its focus: their ranges are cut out of the sorted lists, rows in all of
them are candidates, and only those are compared, in whole numbers. The ranges are a little wider than they need be, so
rounding loses nothing.

Positives first: t is the fifth best of the anchor's label so far. Their scores then give each positive's band of
scores, and t for the negatives is the least lower end of a band that still wants rows.

The index is written once. Anchors are taken in groups of about ``ANCHORS``, each against all buckets, so neither the
driver nor a task holds more than one group.

Defined cases: rows with a null vec_id, label or vector, or any null or non-finite component, take no part; a zero or
empty vector has the score 0 with every other; vectors of unequal length are compared over the components both have;
equal scores go by vec_id; each of several rows of one vec_id counts, but none is a partner of an anchor of that id, and
an anchor id that repeats is searched once, with its smallest label and vector; very long vectors make small buckets;
scores beyond 64 bits end at the limit; an empty table gives no row; other columns are left behind.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fulluse.llm.common import Scratch

ANCHORS, BUCKET, BUCKET_BYTES, FOCUS, MARGIN = 4096, 2048, 1 << 22, 3, 1e-6
LONGEST = 2**63 - 1

ROWS = "vec_id long, label long, anchor boolean, length double, dim int, data binary"
INDEX = "most double, dim int, ids binary, labels binary, data binary, orders binary"


def quantised(vectors: DataFrame, is_anchor: Column, scale: int) -> DataFrame:
    """The rows that take part, with components floor(scale * x) as little-endian 64-bit numbers, and their length."""
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("v")
            values = lists.flatten()
            flat = values.fill_null(np.nan).to_numpy(zero_copy_only=False)
            cuts = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy())))
            bad = np.concatenate(([0], np.cumsum(~np.isfinite(flat))))
            rows = np.flatnonzero(bad[cuts[1:]] == bad[cuts[:-1]])
            with np.errstate(invalid="ignore"):
                ints = np.clip(np.floor(scale * flat), -(2.0**62), 2.0**62).astype("<i8")
            kept = batch.take(pa.array(rows))
            own = [ints[cuts[r] : cuts[r + 1]] for r in rows]
            lengths = [float(np.sqrt(x.astype(float) @ x.astype(float))) for x in own]
            yield pa.RecordBatch.from_pydict({
                "vec_id": kept.column("vec_id"), "label": kept.column("label"), "anchor": kept.column("anchor"),
                "length": pa.array(lengths, pa.float64()), "dim": pa.array([len(x) for x in own], pa.int32()),
                "data": pa.array([x.tobytes() for x in own], pa.binary()),
            })

    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"), F.col("embedding").cast("array<double>").alias("v"),
    )
    return rows.filter("vec_id is not null and label is not null and v is not null").mapInArrow(whole, ROWS)


def matrix(data: list[bytes], dim: int) -> np.ndarray:
    out = np.zeros((len(data), dim), np.int64)
    for k, x in enumerate(data):
        own = np.frombuffer(x, "<i8")
        out[k, : len(own)] = own
    return out


def units(rows: np.ndarray) -> np.ndarray:
    lengths = np.sqrt((rows.astype(float) ** 2).sum(1))
    return rows / np.where(lengths > 0, lengths, 1)[:, None]


def indexed(rows: DataFrame) -> DataFrame:
    """Buckets of rows of like length: ids, labels, vectors, and for each coordinate the order of its values."""
    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        dim = 0

        def bucket() -> pa.RecordBatch:
            data = matrix([r[4] for r in held], dim)
            orders = np.argsort(units(data), axis=0, kind="stable").T.astype("<u2")
            return pa.RecordBatch.from_pydict({
                "most": pa.array([max(r[2] for r in held)], pa.float64()), "dim": pa.array([dim], pa.int32()),
                "ids": pa.array([np.array([r[0] for r in held], "<i8").tobytes()], pa.binary()),
                "labels": pa.array([np.array([r[1] for r in held], "<i8").tobytes()], pa.binary()),
                "data": pa.array([data.astype("<i8").tobytes()], pa.binary()),
                "orders": pa.array([orders.tobytes()], pa.binary()),
            })

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("vec_id", "label", "length", "dim", "data")), strict=True):
                if held and (len(held) == BUCKET or (len(held) + 1) * max(dim, row[3]) * 8 > BUCKET_BYTES):
                    yield bucket()
                    held, dim = [], 0
                held.append(row)
                dim = max(dim, row[3])
        if held:
            yield bucket()

    # The id parts rows of equal length, so that copies of one vector do not meet in one task.
    order = (F.desc("length"), "vec_id")
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(dealt, INDEX)


class Bucket:
    def __init__(self, row: dict):
        self.most, self.dim = row["most"], row["dim"]
        self.ids, self.labels = (np.frombuffer(row[c], "<i8") for c in ("ids", "labels"))
        self.data = np.frombuffer(row["data"], "<i8").reshape(len(self.ids), self.dim)
        self.exact = self.data.astype(float)
        self.orders = np.frombuffer(row["orders"], "<u2").reshape(self.dim, len(self.ids))
        self.units = np.take_along_axis(units(self.data).T, self.orders.astype(np.int64), 1)

    def candidates(self, anchor: Anchor, least: float) -> np.ndarray | slice:
        """Rows whose inner product with the anchor may be ``least`` or more."""
        if least <= 0:
            return slice(None)
        reach = anchor.length * self.most
        if reach <= 0 or least / reach > 1 + MARGIN:
            return np.zeros(0, np.int64)
        angle = np.arccos(min(1.0, least / reach))
        marks, used = np.zeros(len(self.ids), np.uint8), 0
        for f in anchor.focus:
            if f >= self.dim:
                continue
            low = np.cos(min(anchor.angles[f] + angle, np.pi)) - MARGIN
            high = np.cos(max(anchor.angles[f] - angle, 0.0)) + MARGIN
            a, b = np.searchsorted(self.units[f], (low, high))
            if b - a < len(marks):
                marks[self.orders[f, a:b]] += 1
                used += 1
        return np.flatnonzero(marks == used) if used else slice(None)

    def scores(self, anchor: Anchor, rows: np.ndarray | slice) -> np.ndarray:
        """Exact inner products: sums of doubles while they stay below 2**53, else whole numbers of any size."""
        dim = min(self.dim, len(anchor.vector))
        if anchor.length * self.most < 2.0**52:
            return (self.exact[rows, :dim] @ anchor.exact[:dim]).astype(np.int64)
        big = self.data[rows, :dim].astype(object) @ anchor.vector[:dim].astype(object)
        return np.array([min(max(int(x), -LONGEST), LONGEST) for x in big], np.int64)


class Anchor:
    def __init__(self, row: dict):
        self.id, self.label, self.length = row["vec_id"], row["label"], row["length"]
        self.vector = np.frombuffer(row["data"], "<i8")
        self.exact = self.vector.astype(float)
        unit = self.exact / (self.length or 1)
        self.angles = np.arccos(np.clip(unit, -1, 1))
        self.focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS]


class Top:
    """The best ``k`` so far, by score and then by id."""

    def __init__(self, k: int, low: int = -LONGEST - 1, high: int = LONGEST):
        self.k, self.low, self.high = k, low, high
        self.scores = self.ids = np.zeros(0, np.int64)

    @property
    def least(self) -> int:
        """What a row must reach to count."""
        return max(self.low, int(self.scores[-1])) if len(self.scores) == self.k else self.low

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        own = (scores >= self.least) & (scores <= self.high)
        if own.any():
            scores, ids = np.append(self.scores, scores[own]), np.append(self.ids, ids[own])
            order = np.lexsort((ids, -scores))[: self.k]
            self.scores, self.ids = scores[order], ids[order]


def scanned(index: DataFrame, anchors: list[dict], wanted: list[list[tuple[int, Top]]], same: bool) -> DataFrame:
    """anchor (its number), slot, vec_id, score: what each task found best for each of an anchor's searches.

    ``wanted`` has (slot, empty top) for each anchor; ``same`` looks among rows of its label, else among the others.
    """
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [Anchor(a) for a in anchors]
        tops = [[(slot, Top(t.k, t.low, t.high)) for slot, t in own] for own in wanted]
        for batch in batches:
            for k in range(batch.num_rows):
                bucket = Bucket(batch.slice(k, 1).to_pylist()[0])
                for anchor, own in zip(known, tops, strict=True):
                    if not own:
                        continue
                    rows = bucket.candidates(anchor, min(t.least for _, t in own))
                    ids, labels = bucket.ids[rows], bucket.labels[rows]
                    if not len(ids):
                        continue
                    right = ((labels == anchor.label) == same) & (ids != anchor.id)
                    scores = bucket.scores(anchor, rows)[right]
                    for _, top in own:
                        top.add(scores, ids[right])
        out: dict[str, list] = {k: [] for k in ("anchor", "slot", "vec_id", "score")}
        for number, own in enumerate(tops):
            for slot, top in own:
                out["anchor"] += [number] * len(top.ids)
                out["slot"] += [slot] * len(top.ids)
                out["vec_id"] += top.ids.tolist()
                out["score"] += top.scores.tolist()
        yield pa.RecordBatch.from_pydict(out, pa.schema([
            ("anchor", pa.int32()), ("slot", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64()),
        ]))

    return index.mapInArrow(found, "anchor int, slot int, vec_id long, score long")


def first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(vectors: DataFrame, is_anchor: Column, scratch: Scratch, positives: int = 5, negatives: int = 5, low: int = 80,
         high: int = 100, of: int = 100, scale: int = 256, group: int = ANCHORS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    An anchor's positives are its best rows of the same label. A negative of theirs has another label and a score with
    low * positive_score <= of * score <= high * positive_score.
    """
    rows = scratch.save(quantised(vectors, is_anchor, scale), "vectors")
    index = scratch.save(indexed(rows), "buckets")
    chosen = rows.filter("anchor").groupBy("vec_id").agg(F.min(F.struct("label", "data", "length")).alias("a"))
    chosen = scratch.save(chosen.select("vec_id", "a.*"), "anchors")
    groups = -(-chosen.count() // group)
    out = []
    for k in range(groups):
        own = chosen.filter(F.pmod(F.xxhash64("vec_id"), F.lit(groups)) == k).orderBy("vec_id")
        anchors = [r.asDict() for r in own.collect()]
        if not anchors:
            continue
        best = first(scanned(index, anchors, [[(0, Top(positives))] for _ in anchors], True), positives).collect()
        wanted: list[list[tuple[int, Top]]] = [[] for _ in anchors]
        pairs = []
        for r in best:
            p = r["score"]
            band = -(-low * p // of), high * p // of
            if band[0] <= band[1]:
                wanted[r["anchor"]].append((r["rank"], Top(negatives, *(min(max(x, -LONGEST), LONGEST) for x in band))))
                pairs.append((r["anchor"], r["rank"], anchors[r["anchor"]]["vec_id"], r["vec_id"], p))
        if not pairs:
            continue
        names = vectors.sparkSession.createDataFrame(
            pairs, "anchor int, slot int, anchor_id long, positive_id long, positive_score long"
        )
        found = scratch.save(first(scanned(index, anchors, wanted, False), negatives), "found")
        out.append(found.join(names, ["anchor", "slot"]).select(
            "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score"),
        ))
    if not out:
        return vectors.sparkSession.createDataFrame(
            [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        )
    whole = out[0]
    for more in out[1:]:
        whole = whole.union(more)
    return whole
