"""Ranked lexical search, a term at a time with limited accumulators.

One pass over the texts keeps, for each document, its length in terms and the occurrences of query terms; document
frequencies and lengths are summed over all documents. The search runs over that small table in blocks of documents. In
a block each item takes its terms rarest first. A term adds its part to the accumulators of its documents and makes new
ones, until the bounds of the terms still to come, summed, are below the k-th best partial score: then no document
without an accumulator can be among the best, and the rest of the terms only update those there are, exactly; those that
the remaining bounds cannot lift to the k-th score are left out on the way. A task carries its best k of each item from
block to block, so that later blocks stop sooner; the tasks' best are ranked at the end.

Words are found by a 64-bit hash and then compared byte by byte with the query's term. Items are taken in groups of at
most ``ITEM_BYTES`` of text, one pass for each, so what a task holds of the queries is bounded.

Defined cases: a null or empty text, or one without a term, is no result and does not count in N; an item without text
or terms has no result; rows that repeat an item_id are one item with the terms of all; rows that repeat doc_id or text
are ranked each, equal scores by doc_id (null first) and then by a hash of the text; a text of any length is read whole,
by pieces of a batch of at least one row; empty tables give no row; other columns of both tables are left behind.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fulluse.llm.common import LOWER_BYTES, Scratch, keyed, pieces, shown_id, span_hashes

ITEM_BYTES, BLOCK, POSTINGS = 1 << 22, 1 << 16, 1 << 22
SALTS, SIEVE_BITS = 64, 20

#: Bytes of terms: digits, letters, and all bytes of characters beyond ASCII.
_TERM = np.zeros(256, bool)
_TERM[48:58] = _TERM[65:91] = _TERM[97:123] = _TERM[128:] = True


def spans(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All texts as lower-case bytes, starts and ends of their terms, and each text's first term and end."""
    data = np.frombuffer((b" ".join([*texts, b""]) or b" ").translate(LOWER_BYTES), np.uint8)
    inside = np.concatenate(([False], _TERM[data], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    bounds = np.concatenate(([0], np.cumsum([len(x) + 1 for x in texts], dtype=np.int64)))
    return data, starts, ends, np.searchsorted(starts, bounds)


class Vocabulary:
    """The query's terms, found among the spans of texts."""

    def __init__(self, terms: list[bytes]):
        data, starts, ends, _ = spans(terms)
        hashes = span_hashes(data, starts, ends)
        self.order = np.argsort(hashes, kind="stable")
        self.hashes, self.data, self.starts, self.sizes = hashes[self.order], data, starts, ends - starts
        self.sieve = np.zeros(1 << SIEVE_BITS, bool)
        self.sieve[hashes >> np.uint64(64 - SIEVE_BITS)] = True

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which spans are terms, and which terms they are."""
        hashes = span_hashes(data, starts, ends)
        at = np.flatnonzero(self.sieve[hashes >> np.uint64(64 - SIEVE_BITS)])
        place = np.minimum(np.searchsorted(self.hashes, hashes[at]), len(self.hashes) - 1)
        term = self.order[place]
        same = (self.hashes[place] == hashes[at]) & (self.sizes[term] == (ends - starts)[at])
        at, term = at[same], term[same]
        sizes = self.sizes[term]
        upto = np.cumsum(sizes)
        step = np.arange(upto[-1] if len(upto) else 0) - np.repeat(upto - sizes, sizes)
        equal = data[np.repeat(starts[at], sizes) + step] == self.data[np.repeat(self.starts[term], sizes) + step]
        wrong = np.unique(np.repeat(np.arange(len(at)), sizes)[~equal])
        return np.delete(at, wrong), np.delete(term, wrong)


def postings(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """doc_id, tag, n (terms of the document), terms (numbers of the query's terms in it), tfs."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Vocabulary(terms)
        for whole in batches:
            for batch in pieces(whole):
                data, starts, ends, firsts = spans([x.encode() for x in batch.column("text").to_pylist()])
                n = np.diff(firsts)
                at, term = known.find(data, starts, ends)
                row = np.searchsorted(firsts, at, "right") - 1
                pairs, tfs = np.unique(row * len(terms) + term, return_counts=True)
                offsets = pa.array(np.searchsorted(pairs, np.arange(batch.num_rows + 1) * len(terms)), pa.int32())
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column("doc_id"), "tag": batch.column("tag"), "n": pa.array(n, pa.int64()),
                    "terms": pa.ListArray.from_arrays(offsets, pa.array(pairs % len(terms), pa.int32())),
                    "tfs": pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int32())),
                })

    return keyed(docs).mapInArrow(counted, "doc_id long, tag long, n long, terms array<int>, tfs array<int>")


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Block:
    """Postings of some documents by term, as contributions before weighting."""

    def __init__(self, ids, tags, n, counts, terms, tfs, n_docs: int, n_terms: int, total: int, slope: int):
        self.ids, self.tags = ids, tags
        m = 100 - slope + slope * n * n_docs // total
        row = np.repeat(np.arange(len(ids)), counts)
        tf = tfs.astype(np.int64)
        part = 1_000_000_000 * tf // (1000 * tf + 20 * m[row])
        order = np.argsort(terms, kind="stable")
        self.row, self.part = row[order], part[order]
        self.cuts = np.searchsorted(terms[order], np.arange(n_terms + 1))
        self.most = {t: int(self.part[a:b].max()) for t in np.unique(terms).tolist() for a, b in [self.cuts[t : t + 2]]}

    def of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.cuts[term : term + 2]
        return self.row[a:b], self.part[a:b]


def kth(scores: np.ndarray, k: int) -> int:
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0


def best(block: Block, terms: list[tuple[int, int]], k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the block and their scores: all that may be among the best k of an item.

    ``terms`` are (term, weight), rarest first; ``least`` is a score that k other documents have already.
    """
    terms = [(t, w) for t, w in terms if t in block.most and w > 0]
    bounds = [w * block.most[t] for t, w in terms]
    rest = [0, *np.cumsum(bounds[::-1]).tolist()][::-1]
    scores, done, j = np.zeros(len(block.ids), np.int64), 0, 0
    while j < len(terms):
        # A partial score is at most the bounds so far; before those exceed the rest nothing can stop.
        if done >= rest[j] and least <= rest[j]:
            least = max(least, kth(scores[scores > 0], k))
        if rest[j] < least:
            break
        rows, parts = block.of(terms[j][0])
        scores[rows] += terms[j][1] * parts
        done, j = done + bounds[j], j + 1
    alive = np.flatnonzero(scores)
    for j in range(j, len(terms)):
        alive = alive[scores[alive] + rest[j] >= least]
        rows, parts = block.of(terms[j][0])
        if len(alive) * 8 < len(rows):
            at = np.minimum(np.searchsorted(rows, alive), len(rows) - 1)
            hit = rows[at] == alive
            scores[alive[hit]] += terms[j][1] * parts[at[hit]]
        else:
            chosen = np.zeros(len(scores), bool)
            chosen[alive] = True
            hit = chosen[rows]
            scores[rows[hit]] += terms[j][1] * parts[hit]
        least = max(least, kth(scores[alive], k))
    alive = alive[scores[alive] >= max(least, kth(scores[alive], k), 1)]
    return alive, scores[alive]


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches together, up to a number of documents and of postings."""
    held, rows, size = [], 0, 0
    for whole in batches:
        for at in range(0, whole.num_rows, BLOCK):
            batch = whole.slice(at, BLOCK)
            own = len(batch.column("terms").flatten())
            if held and (rows + batch.num_rows > BLOCK or size + own > POSTINGS):
                yield pa.Table.from_batches(held)
                held, rows, size = [], 0, 0
            held.append(batch)
            rows, size = rows + batch.num_rows, size + own
    if held:
        yield pa.Table.from_batches(held)


def item_groups(items: DataFrame, scratch: Scratch, size: int = ITEM_BYTES) -> Iterator[dict[int | None, set[bytes]]]:
    """The items and their terms in groups of about ``size`` bytes, one item at least."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    rows = scratch.save(rows.filter("text is not null").distinct(), "items")
    total = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    groups = -(-total // size)
    for group in range(groups):
        out: dict[int | None, set[bytes]] = {}
        own = rows.filter(F.pmod(F.xxhash64("item_id"), F.lit(groups)) == group)
        for r in own.collect():
            data, starts, ends, _ = spans([r["text"].encode()])
            raw = data.tobytes()
            out.setdefault(r["item_id"], set()).update(raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True))
        yield {item: found for item, found in out.items() if found}


def search(docs: DataFrame, items: DataFrame, scratch: Scratch, k: int = 50, slope: int = 50) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each item."""
    found = [_search(docs, group, scratch, k, slope) for group in item_groups(items, scratch) if group]
    if not found:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def _search(docs: DataFrame, items: dict[int | None, set[bytes]], scratch: Scratch, k: int, slope: int) -> DataFrame:
    terms = sorted(set().union(*items.values()))
    table = scratch.save(postings(docs, terms), "postings")
    sums = table.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    n_docs, total = sums["docs"], sums["terms"]
    # At most one number for each term of the group.
    df = {r["t"]: r["n"] for r in table.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n")).collect()}
    number = {t: i for i, t in enumerate(terms)}
    queries = [
        (item, sorted(((i, weight(n_docs, df[i])) for i in map(number.get, own) if i in df), key=lambda x: (df[x[0]], x[0])))
        for item, own in items.items()
    ]
    n_terms = len(terms)

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops = [(np.zeros(0, np.int64),) * 3 for _ in queries]
        for table in blocks(batches):
            ids, tags, n = (table.column(c).to_numpy() for c in ("doc_id", "tag", "n"))
            lists, tfs = (table.column(c).combine_chunks() for c in ("terms", "tfs"))
            counts = lists.value_lengths().to_numpy()
            if not counts.any():
                continue
            block = Block(ids, tags, n, counts, lists.flatten().to_numpy(), tfs.flatten().to_numpy(), n_docs, n_terms, total, slope)
            for q, (_, own) in enumerate(queries):
                score, doc, tag = tops[q]
                rows, scores = best(block, own, k, int(score[-1]) if len(score) == k else 0)
                if len(rows):
                    score, doc, tag = np.append(score, scores), np.append(doc, ids[rows]), np.append(tag, tags[rows])
                    order = np.lexsort((tag, doc, -score))[:k]
                    tops[q] = score[order], doc[order], tag[order]
        part = TaskContext.get().partitionId()
        for (item, _), (score, doc, tag) in zip(queries, tops, strict=True):
            if len(score):
                yield pa.RecordBatch.from_pydict({
                    "item_id": pa.array([item] * len(score), pa.int64()), "part": pa.array([part] * len(score), pa.int32()),
                    "doc_id": pa.array(doc), "tag": pa.array(tag), "score": pa.array(score),
                })

    found = table.mapInArrow(ranked, "item_id long, part int, doc_id long, tag long, score long")
    order = (F.desc("score"), "doc_id", "tag")
    # The tasks' best meet in two steps, so that no task gets what all tasks found for an item.
    salted = Window.partitionBy("item_id", F.col("part") % SALTS).orderBy(*order)
    found = found.withColumn("rank", F.row_number().over(salted)).filter(F.col("rank") <= k).drop("rank")
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order)))
    return found.filter(F.col("rank") <= k).select("item_id", "rank", shown_id(), "score")
