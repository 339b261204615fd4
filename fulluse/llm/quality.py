"""Quality by co-training: a text-content and a page-metadata classifier teach each other.

Both are logistic regressions, fitted on the driver on a bounded number of rows: at most ``labelled`` labelled documents,
chosen by a hash of doc_id, and what the rounds add. In each round Spark scores every document outside that sample with
both views; each view names the documents it is surest of, of those it has not taught yet, and the other learns them as
labels. At most ``per_round`` enter a view's fit in a round, dealt over the classes as they are among the labels and over
sources (in turn: the surest of each source, then the next of each), so that a rare source is heard. A quarter of the
labelled rows is kept apart to calibrate both views and their combination. All documents are scored where they are read,
with weights of fixed size.

* Content: hashed byte trigrams of the text, as log counts of unit length.
* Metadata: source, language, and the page's measures: length, lines, line lengths, shares of character classes.

Defined cases: null and empty texts have no trigrams and zero measures, null source or language is a value of its own; a
text of any length is read whole; labels of null, repeated labels of one doc_id (the smallest counts) and labels of
unknown documents do no harm; labelled documents beyond the sample count as unlabelled; with fewer than ``LEAST``
labelled rows or one class alone nothing can be learned: scores are null and everything is kept; a score at the
threshold is kept; equally sure documents go by a hash of the text and then by doc_id; an empty table gives no row; rows
that repeat are scored each; columns named like the scores are replaced, others stay.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fulluse.llm.common import pieces

BUCKETS, SOURCES, LANGS, LEAST = 2048, 64, 16, 40
#: Bytes of text whose features are held at once: a row's are some times as large as a short text.
PIECE = 1 << 18

_CLASS = np.full(256, 5)
_CLASS[[9, 10, 11, 12, 13, 32]] = 0
_CLASS[48:58], _CLASS[65:91], _CLASS[97:123], _CLASS[128:] = 1, 2, 3, 4
N_META = SOURCES + LANGS + 4 + 6


def content(text: bytes) -> np.ndarray:
    out = np.zeros(BUCKETS, np.float32)
    if len(text) > 2:
        b = np.frombuffer(text, np.uint8).astype(np.uint32)
        h = (b[:-2] * np.uint32(0x9E3779B1) ^ b[1:-1] * np.uint32(0x85EBCA6B) ^ b[2:] * np.uint32(0xC2B2AE35)) >> np.uint32(21)
        out[:] = np.log1p(np.bincount(h, minlength=BUCKETS))
        out /= np.sqrt(out @ out)
    return out


def metadata(text: bytes, source: str | None, lang: str | None) -> np.ndarray:
    out = np.zeros(N_META, np.float32)
    out[zlib.crc32(repr(source).encode()) % SOURCES] = 1
    out[SOURCES + zlib.crc32(repr(lang).encode()) % LANGS] = 1
    b = np.frombuffer(text, np.uint8)
    breaks = np.flatnonzero(b == 10)
    lengths = np.diff(np.concatenate(([-1], breaks, [len(b)]))) - 1
    out[SOURCES + LANGS :][:4] = np.log1p([len(b), len(lengths), lengths.mean(), lengths.max()])
    out[SOURCES + LANGS + 4 :] = np.bincount(_CLASS[b], minlength=6) / max(len(b), 1)
    return out


@dataclass
class View:
    """A logistic regression over standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) / self.scale @ self.weights + self.bias


def fit_view(parts: list[np.ndarray], y: np.ndarray, ridge: float = 1e-3, steps: int = 150, rate: float = 0.5) -> View:
    """``parts``: rows of features in blocks of any float type; one copy of them is made, and standardised in place."""
    z, at = np.empty((len(y), parts[0].shape[1]), np.float32), 0
    for part in parts:
        z[at : at + len(part)] = part
        at += len(part)
    mean = z.mean(0, dtype=np.float64).astype(np.float32)
    z -= mean
    squares = sum((z[k : k + 256].astype(np.float64) ** 2).sum(0) for k in range(0, len(z), 256))
    scale = (np.maximum(np.sqrt(squares / len(z)), 1e-3) * np.sqrt(z.shape[1] / 16)).astype(np.float32)
    z /= scale
    w, m, v = np.zeros(z.shape[1] + 1), 0.0, 0.0
    w[-1] = np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3))
    for t in range(1, steps + 1):  # Adam over the whole batch
        gap = 1 / (1 + np.exp(-(z @ w[:-1].astype(np.float32) + w[-1]))) - y
        g = np.concatenate((z.T @ gap.astype(np.float32) / len(y) + ridge * w[:-1], [gap.mean()]))
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= rate * 0.2 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return View(mean, scale, w[:-1], float(w[-1]))


def fit_scale(z: np.ndarray, y: np.ndarray, steps: int = 50) -> np.ndarray:
    """Weights and bias that turn logits into calibrated ones, by Newton's method with a little ridge."""
    x = np.column_stack((z, np.ones(len(y))))
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w))
        w -= np.linalg.solve(hess, x.T @ (p - y) + 1e-2 * w)
    return w


@dataclass
class Model:
    content: View
    metadata: View
    by_content: np.ndarray
    by_metadata: np.ndarray
    both: np.ndarray

    def scores(self, c: np.ndarray, m: np.ndarray) -> np.ndarray:
        """Calibrated probabilities of good quality: content, metadata, combined."""
        views = [
            np.column_stack((z, np.ones(len(z)))) @ w
            for z, w in ((self.content.logit(c), self.by_content), (self.metadata.logit(m), self.by_metadata))
        ]
        both = np.column_stack((*views, np.ones(len(c)))) @ self.both
        return 1 / (1 + np.exp(-np.clip(np.column_stack((*views, both)), -30, 30)))


#: Who teaches whom.
PUPIL = {"content": "metadata", "metadata": "content"}

#: Of one pupil: labels, content features and metadata features of the rows it is taught.
Lesson = tuple[np.ndarray, np.ndarray, np.ndarray]


def teach(c, m, y, apart, propose: Callable[[dict[str, View]], dict[str, Lesson]], rounds: int) -> Model:
    """c, m, y: features and labels; apart: rows kept for calibration; ``propose`` finds what each view is taught next."""
    learn = ~apart
    parts, labels = {"content": [c[learn]], "metadata": [m[learn]]}, {name: [y[learn]] for name in PUPIL}
    for turn in range(rounds + 1):
        views = {name: fit_view(parts[name], np.concatenate(labels[name])) for name in PUPIL}
        found = propose(views) if turn < rounds else {}
        if not any(len(own) for own, _, _ in found.values()):
            break
        for pupil, (own, *features) in found.items():
            labels[pupil].append(own)
            parts[pupil].append(features[pupil == "metadata"])
    zc, zm = views["content"].logit(c[apart]), views["metadata"].logit(m[apart])
    by_c, by_m = fit_scale(zc, y[apart]), fit_scale(zm, y[apart])
    calibrated = np.column_stack([np.column_stack((z, np.ones(len(z)))) @ w for z, w in ((zc, by_c), (zm, by_m))])
    return Model(views["content"], views["metadata"], by_c, by_m, fit_scale(calibrated, y[apart]))


def sureness(view: View, x: np.ndarray) -> np.ndarray:
    """How sure the view is of each row's being good; one less that, of its being bad."""
    return 1 / (1 + np.exp(-np.clip(view.logit(x), -30, 30)))


def quotas(y: np.ndarray, per_round: int) -> dict[int, int]:
    """How many rows of each class a view is taught in a round."""
    return {1: round(per_round * float(y.mean())), 0: round(per_round * float(1 - y.mean()))}


def co_train(c, m, y, apart, pool_c, pool_m, rounds: int = 4, share: float = 0.1, sure: float = 0.95) -> Model:
    """Co-training over a pool in memory."""
    taught = {name: set() for name in PUPIL}
    most = quotas(y[~apart], round(share * len(pool_c)))

    def propose(views: dict[str, View]) -> dict[str, Lesson]:
        out = {}
        for (teacher, pupil), x in zip(PUPIL.items(), (pool_c, pool_m), strict=True):
            p, rows, labels = sureness(views[teacher], x) if len(x) else np.zeros(0), [], []
            for label, sureness_of in ((1, p), (0, 1 - p)):
                order = [k for k in np.argsort(-sureness_of, kind="stable").tolist() if k not in taught[pupil] and sureness_of[k] >= sure]
                rows += order[: most[label]]
                labels += [label] * len(order[: most[label]])
            taught[pupil].update(rows)
            out[pupil] = np.array(labels, float), pool_c[rows], pool_m[rows]
        return out

    return teach(c, m, y, apart, propose, rounds)


def inputs(docs: DataFrame) -> DataFrame:
    def known(name: str):
        return docs[name].cast("string") if name in docs.columns else F.lit(None).cast("string")

    return docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"),
        known("source").alias("source"), known("lang").alias("lang"),
    )


def features(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    rows = zip(*(batch.column(k).to_pylist() for k in ("text", "source", "lang")), strict=True)
    found = [(content(b := t.encode()), metadata(b, s, g)) for t, s, g in rows]
    return np.stack([f[0] for f in found]), np.stack([f[1] for f in found])


def featured(rows: DataFrame) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    """The rows, some thousands at most, at the driver: their other columns, content and metadata features."""
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, PIECE):
                c, m = features(batch)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(k) for k in keys), pa.array([r.astype(np.float16).tobytes() for r in c], pa.binary()),
                        pa.array([r.tobytes() for r in m], pa.binary()),
                    ],
                    names=[*keys, "c", "m"],
                )

    kinds = {k: t for k, t in rows.dtypes if k not in ("text", "source", "lang")}
    keys = list(kinds)
    shape = ", ".join(f"{k} {t}" for k, t in kinds.items())
    got = rows.mapInArrow(found, f"{shape}, c binary, m binary").toArrow().sort_by([(k, "ascending") for k in keys])
    c, m = np.empty((len(got), BUCKETS), np.float16), np.empty((len(got), N_META), np.float32)
    for out, name in ((c, "c"), (m, "m")):
        for k, value in enumerate(got.column(name)):
            out[k] = np.frombuffer(value.as_buffer(), out.dtype)
    return got.drop_columns(["c", "m"]), c, m


def surest(rows: DataFrame, views: dict[str, View], known: set[int], taught: dict[str, set], sure: float, most: dict[int, int],
           each: int) -> DataFrame:
    """pupil, label, doc_id, tag: what each view teaches the other next, from all rows.

    ``known`` are doc_ids of the labelled sample, ``taught`` the (doc_id, tag) that each pupil has been taught. A task
    passes on its ``each`` surest of a class and source, and those meet again by source and then by turns.
    """
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple, list] = {}
        for whole in batches:
            for batch in pieces(whole, PIECE):
                c, m = features(batch)
                ids, tags = (batch.column(k).to_pylist() for k in ("doc_id", "tag"))
                groups = [zlib.crc32(repr(s).encode()) % SOURCES for s in batch.column("source").to_pylist()]
                for (teacher, pupil), x in zip(PUPIL.items(), (c, m), strict=True):
                    p = sureness(views[teacher], x)
                    for label, own in ((1, p), (0, 1 - p)):
                        for k in np.flatnonzero(own >= sure).tolist():
                            if ids[k] in known or (ids[k], tags[k]) in taught[pupil]:
                                continue
                            rows = best.setdefault((pupil, label, groups[k]), [])
                            rows.append((-float(own[k]), tags[k], ids[k]))
                            if len(rows) > 4 * each:
                                rows[:] = sorted(set(rows))[:each]
        out = [(*key, -s, t, d) for key, rows in best.items() for s, t, d in sorted(set(rows))[:each]]
        yield pa.RecordBatch.from_pylist(
            [dict(zip(kinds.names, row, strict=True)) for row in out], kinds
        )

    kinds = pa.schema([
        ("pupil", pa.string()), ("label", pa.int32()), ("source", pa.int32()), ("p", pa.float64()), ("tag", pa.int64()), ("doc_id", pa.int64()),
    ])
    asked = rows.filter("doc_id is not null").mapInArrow(found, "pupil string, label int, source int, p double, tag long, doc_id long")
    order = (F.desc("p"), "tag", "doc_id")
    by_source = Window.partitionBy("pupil", "label", "source").orderBy(*order)
    turns = asked.distinct().withColumn("turn", F.row_number().over(by_source)).filter(F.col("turn") <= max(most.values()))
    placed = turns.withColumn("place", F.row_number().over(Window.partitionBy("pupil", "label").orderBy("turn", *order)))
    enough = F.when(F.col("label") == 1, most[1]).otherwise(most[0])
    return placed.filter(F.col("place") <= enough).select("pupil", "label", "doc_id", "tag")


def train(docs: DataFrame, labels: DataFrame, labelled: int = 4000, per_round: int = 1000, rounds: int = 3, sure: float = 0.95,
          each: int = 64, target: str = "quality") -> Model | None:
    rows = inputs(docs).withColumn("tag", F.xxhash64("text"))
    known = labels.filter(F.col(target).isNotNull() & F.col("doc_id").isNotNull()).groupBy(
        F.col("doc_id").cast("long").alias("doc_id")
    ).agg(F.min(target).cast("int").alias("y"))
    ids = rows.select("doc_id").filter("doc_id is not null").distinct()
    chosen = ids.join(known, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled)
    got, c, m = featured(rows.drop("tag").join(chosen, "doc_id").dropDuplicates(["doc_id"]))
    own, ids = got.column("y").to_numpy().astype(float), got.column("doc_id").to_pylist()
    if len(own) < LEAST or len(set(own)) < 2:
        return None
    apart = np.array([zlib.crc32(str(i).encode()) % 4 == 0 for i in ids])
    if len(set(own[apart])) < 2 or len(set(own[~apart])) < 2:
        apart = np.arange(len(own)) % 2 == 0  # too few rows of one class for the usual split
        if len(set(own[apart])) < 2 or len(set(own[~apart])) < 2:
            return None
    taught: dict[str, set] = {name: set() for name in PUPIL}
    most = quotas(own[~apart], per_round)

    def propose(views: dict[str, View]) -> dict[str, Lesson]:
        named = surest(rows, views, set(ids), taught, sure, most, each).collect()
        if not named:
            return {}
        wanted = docs.sparkSession.createDataFrame([(r["doc_id"], r["tag"]) for r in named], "doc_id long, tag long").distinct()
        table, own_c, own_m = featured(rows.join(F.broadcast(wanted), ["doc_id", "tag"]).dropDuplicates(["doc_id", "tag"]))
        place = {key: k for k, key in enumerate(zip(*(table.column(k).to_pylist() for k in ("doc_id", "tag")), strict=True))}
        out = {}
        for pupil in PUPIL.values():
            lessons = sorted((place[r["doc_id"], r["tag"]], r["label"]) for r in named if r["pupil"] == pupil)
            at = [k for k, _ in lessons]
            out[pupil] = np.array([label for _, label in lessons], float), own_c[at], own_m[at]
            taught[pupil].update((r["doc_id"], r["tag"]) for r in named if r["pupil"] == pupil)
        return out

    return teach(c, m, own, apart, propose, rounds)


def score(docs: DataFrame, model: Model | None, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` with p_content, p_metadata, quality_score and kept; clashing columns are replaced."""
    added = ("p_content", "p_metadata", "quality_score")
    base = docs.drop(*added, "kept")
    if model is None:
        return base.withColumns({c: F.lit(None).cast("double") for c in added}).withColumn("kept", F.lit(True))

    # Only what the views read goes to Python and only scores come back; whole rows stay where they are.
    @F.arrow_udf(f"{added[0]} double, {added[1]} double, {added[2]} double")
    def scored(columns: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for text, source, lang in columns:
            whole = pa.RecordBatch.from_arrays([text, source, lang], names=["text", "source", "lang"])
            p = np.concatenate([np.zeros((0, 3)), *(model.scores(*features(batch)) for batch in pieces(whole, PIECE))])
            yield pa.StructArray.from_arrays([pa.array(p[:, k]) for k in range(3)], names=list(added))

    given = (base[c].cast("string") if c in base.columns else F.lit(None).cast("string") for c in ("source", "lang"))
    found = base.select(
        F.struct(*base.columns).alias("row"),
        # A filter on a score must not have it made twice.
        scored.asNondeterministic()(F.coalesce(base["text"].cast("string"), F.lit("")), *given).alias("scores"),
    ).select("row.*", "scores.*")
    return found.withColumn("kept", F.col("quality_score") >= threshold)

