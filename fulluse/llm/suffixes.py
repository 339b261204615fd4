"""Repeated byte strings by deep-shallow suffix sorting.

A byte goes if a string of ``length`` bytes over it also starts earlier, in a document with a smaller id or before it in
the same one. To find such strings, suffixes (as far as they count) are sorted; equal ones are neighbours.

Which suffixes meet: the smallest hash among the short strings inside a window of ``length`` bytes names the window, so
equal windows have equal names wherever they stand. Windows next to each other mostly share their name and place; such a
run of windows is shipped once, as one string, to the bucket of its name. Each bucket sorts twice:

1. the strings of whole runs: those equal to an earlier one go whole;
2. the windows of runs that are left under a name that several different runs have.

Each sort is deep-shallow: a multikey quicksort takes eight bytes as one character and all groups of a depth at once,
down to ``SHALLOW`` bytes; groups that still agree are compared with their first member, and what differs from it goes
into a blind trie, which looks at branching bytes only and then checks one leaf.

Hot names: names under which very many different runs stand (a line that a third of all documents has) are found by
counting beforehand; windows with such names are dealt by a hash of the whole window, one by one, so they spread over
all buckets. Copies inside a piece of some megabytes are combined before the shuffle.

Defined cases: null and empty texts have no bytes; texts shorter than ``length`` stay; a null doc_id comes before all
others; rows that repeat doc_id and text are one document, given twice; rows that repeat doc_id alone are ordered by a
hash of the text; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fulluse.llm.common import Scratch, keyed, mix, pieces, shown_id, span_hashes, window_hashes

LENGTH, SEED, SHALLOW = 100, 16, 32
#: A name is hot from this many runs on, and from this share of all runs: at most 200,000 names are.
HOT_RUNS, HOT_SHARE = 50_000, 200_000
BUCKET_BYTES = 24 << 20
PIECE = 1 << 21


# Sorting -----------------------------------------------------------------------------------------------------------


class BlindTrie:
    """Strings of one length, told apart by their branching bytes alone."""

    def __init__(self, string: bytes, leaf: int):
        self.strings, self.root = {leaf: string}, leaf

    def add(self, string: bytes, leaf: int) -> int:
        """The leaf that has this string: ``leaf``, or the one that was there."""
        node = self.root
        while isinstance(node, tuple):
            depth, branches = node
            node = branches.get(string[depth], next(iter(branches.values())))
        other = self.strings[node]
        differ = int.from_bytes(string, "big") ^ int.from_bytes(other, "big")
        if not differ:
            return node
        common = len(string) - (differ.bit_length() + 7) // 8
        above, node = None, self.root
        while isinstance(node, tuple) and node[0] < common:
            above, node = node, node[1][string[node[0]]]
        if isinstance(node, tuple) and node[0] == common:
            node[1][string[common]] = leaf
        else:
            split = (common, {other[common]: node, string[common]: leaf})
            if above:
                above[1][string[above[0]]] = split
            else:
                self.root = split
        self.strings[leaf] = string
        return leaf


def character(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, depth: int) -> np.ndarray:
    """Bytes depth to depth + 8 of each string as one number, zero bytes after its end. data has 8 bytes to spare."""
    # Eight bytes from any place are read as one big-endian number.
    words = np.ndarray(len(data) - 7, ">u8", np.ascontiguousarray(data), strides=(1,))
    word = words[np.minimum(starts + depth, len(data) - 8)].astype(np.uint64)
    if depth + 8 <= lengths.min(initial=depth + 8):
        return word
    over = np.clip(depth + 8 - lengths, 0, 8)
    return np.where(over < 8, (word >> (8 * np.minimum(over, 7)).astype(np.uint64)) << (8 * np.minimum(over, 7)).astype(np.uint64), 0)


def equal_classes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, groups: np.ndarray) -> np.ndarray:
    """A number for each string; strings of one group and length have the same number if and only if they are equal."""
    n = len(starts)
    out = np.arange(n)
    order = np.lexsort((lengths, groups))
    g, ln = groups[order], lengths[order]
    fresh = np.concatenate(([True], (g[1:] != g[:-1]) | (ln[1:] != ln[:-1]))) if n else np.zeros(0, bool)
    rank = np.cumsum(fresh) - 1
    for depth in range(0, SHALLOW, 8):
        order, rank = _tied(order, rank)
        if not len(order):
            return out
        word = character(data, starts[order], lengths[order], depth)
        by = np.lexsort((word, rank))
        order, rank, word = order[by], rank[by], word[by]
        rank = np.cumsum(np.concatenate(([False], (rank[1:] != rank[:-1]) | (word[1:] != word[:-1]))))
    order, rank = _tied(order, rank)
    if not len(order):
        return out
    first = np.concatenate(([True], rank[1:] != rank[:-1]))
    leader = order[np.flatnonzero(first)][np.cumsum(first) - 1]
    same = np.ones(len(order), bool)
    for depth in range(SHALLOW, int(lengths[order].max()), 8):
        at = np.flatnonzero(same)
        own = character(data, starts[order[at]], lengths[order[at]], depth)
        same[at] = own == character(data, starts[leader[at]], lengths[order[at]], depth)
    out[order[same]] = leader[same]
    tries: dict[int, BlindTrie] = {}
    raw = memoryview(np.ascontiguousarray(data))
    for k in np.flatnonzero(~same).tolist():
        own, head = int(order[k]), int(leader[k])
        if head not in tries:
            tries[head] = BlindTrie(bytes(raw[starts[head] : starts[head] + lengths[head]]), head)
        out[own] = tries[head].add(bytes(raw[starts[own] : starts[own] + lengths[own]]), own)
    return out


def _tied(order: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Without strings that are alone in their group."""
    new = np.concatenate(([True], rank[1:] != rank[:-1], [True]))
    keep = ~(new[1:] & new[:-1])
    return order[keep], rank[keep]


# Runs --------------------------------------------------------------------------------------------------------------


def runs(data: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Name, text number, first window and number of windows of each run. bounds: where texts begin, and the end."""
    sizes = np.diff(bounds)
    none = np.zeros(0, np.int64)
    if not len(data) or sizes.max(initial=0) < length:
        return none.astype(np.uint64), none, none, none
    seed = min(SEED, length)
    names = window_hashes(data, seed)
    low = (names & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(names), dtype=np.uint64)
    width, step = length - seed + 1, 1
    while step * 2 <= width:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    if width > step:
        low = np.minimum(low[: len(low) - (width - step)], low[width - step :])
    place = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
    text = np.repeat(np.arange(len(sizes)), sizes)[: len(place)]
    good = np.arange(len(place)) + length <= bounds[text + 1]
    new = good.copy()
    new[1:] &= (place[1:] != place[:-1]) | (text[1:] != text[:-1]) | ~good[:-1]
    first = np.flatnonzero(new)
    stop = good & np.concatenate((~good[1:] | new[1:], [True]))
    return names[place[first]], text[first], first, np.flatnonzero(stop) - first + 1


def gathered(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The spans one after another."""
    ends = np.cumsum(lengths)
    return data[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)]


def texts_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    texts = [t.encode() for t in batch.column("text").to_pylist()]
    return np.frombuffer(b"".join(texts), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in texts])))


def first_runs(data, bounds, length, docs, tags):
    """Runs of a piece with all but the earliest of equal ones set apart: runs, and which are later copies."""
    name, text, first, count = runs(data, bounds, length)
    order = np.lexsort((first - bounds[text], tags[text], docs[text]))
    name, text, first, count = name[order], text[order], first[order], count[order]
    spare = np.concatenate((data, np.zeros(8, np.uint8)))
    sorted_names = np.argsort(name, kind="stable")
    ordered = name[sorted_names]
    again = np.concatenate(([False], ordered[1:] == ordered[:-1]))[: len(name)]
    some = sorted_names[again | np.concatenate((again[1:], [False]))[: len(name)]]
    classes = np.arange(len(name))
    if len(some):
        some = np.sort(some)
        own = equal_classes(spare, first[some], count[some] + length - 1, name[some])
        classes[some] = some[_earliest(own)]
    return name, text, first, count, classes


def _earliest(classes: np.ndarray) -> np.ndarray:
    """For each item the smallest item of its class; items are in the order of their places."""
    least = np.full(classes.max(initial=-1) + 1, len(classes))
    np.minimum.at(least, classes, np.arange(len(classes)))
    return least[classes]


#: What travels with a run. 32 bits of a name are enough: they only choose what is compared, byte by byte.
FIELDS = (("name", "<u4"), ("doc", "<i8"), ("tag", "<u4"), ("at", "<u4"), ("size", "<u4"))
SPANS = "doc_id long, tag long, first long, stop long"


def spans(doc, tag, first, stop) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"doc_id": doc, "tag": tag, "first": first, "stop": stop})


def sorted_bucket(columns: dict[str, np.ndarray], data: np.ndarray, length: int) -> pa.RecordBatch:
    """Spans of the bucket's documents that also start earlier."""
    size = columns["size"]
    start = np.cumsum(size) - size
    order = np.lexsort((columns["at"], columns["tag"], columns["doc"]))
    name, doc, tag, at, size = (columns[k][order] for k, _ in FIELDS)
    start = start[order]
    _, group, rows = np.unique(name, return_inverse=True, return_counts=True)
    many = np.flatnonzero(rows[group] > 1)
    name, doc, tag, at, size, start, group = (x[many] for x in (name, doc, tag, at, size, start, group))
    data = np.concatenate((data, np.zeros(8, np.uint8)))

    def later(lead: np.ndarray, d, t, a) -> np.ndarray:
        return (d != d[lead]) | (t != t[lead]) | (a != a[lead])

    lead = _earliest(equal_classes(data, start, size, group))
    gone = later(lead, doc, tag, at)
    found = [(doc[gone], tag[gone], at[gone], at[gone] + size[gone])]
    # What is left is one run of each text; only names with several of those can share single windows.
    left = np.flatnonzero(lead == np.arange(len(lead)))
    several = np.bincount(group[left], minlength=group.max(initial=0) + 1)[group[left]] > 1
    left = left[several]
    # Windows are sorted in parts of some megabytes, cut between names.
    left = left[np.argsort(group[left], kind="stable")]
    cuts = np.flatnonzero(np.diff(group[left], prepend=-1))
    weight = np.cumsum(size[left])
    begin = 0
    while begin < len(left):
        want = np.searchsorted(weight, weight[begin] + (4 << 20))
        end = int(cuts[np.searchsorted(cuts, want)]) if want < len(left) and np.searchsorted(cuts, want) < len(cuts) else len(left)
        part = left[begin:end]
        begin = end
        windows = size[part] - length + 1
        of = np.repeat(part, windows)
        shift = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
        by = np.lexsort((at[of] + shift, tag[of], doc[of]))
        of, shift = of[by], shift[by]
        own = _earliest(equal_classes(data, start[of] + shift, np.full(len(of), length), group[of]))
        place = at[of] + shift
        gone = later(own, doc[of], tag[of], place)
        found.append((doc[of][gone], tag[of][gone], place[gone], place[gone] + length))
    doc, tag, first, stop = (np.concatenate(x) for x in zip(*found, strict=True))
    return spans(*merged(doc, tag, first, stop))


def merged(doc, tag, first, stop):
    """Spans of one document that touch or overlap become one."""
    order = np.lexsort((first, tag, doc))
    doc, tag, first, stop = doc[order], tag[order], first[order], stop[order]
    if not len(doc):
        return doc, tag, first, stop
    own = np.concatenate(([True], (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])))
    number = np.cumsum(own)
    # Each document's places are lifted above those of the one before, so one running maximum serves all.
    lift = number * (int(stop.max()) + 1)
    reach = np.maximum.accumulate(stop + lift)
    new = np.concatenate(([True], (first + lift)[1:] > reach[:-1]))
    at = np.flatnonzero(new)
    last = np.concatenate((at[1:] - 1, [len(doc) - 1]))
    return doc[at], tag[at], first[at], (reach - lift)[last]


# The job -----------------------------------------------------------------------------------------------------------


def own_rows(docs: DataFrame) -> DataFrame:
    """doc_id, tag, text; 32 bits of the tag keep rows of one doc_id apart and travel with every run."""
    return keyed(docs).withColumn("tag", F.col("tag").bitwiseAND(F.lit(0xFFFFFFFF)))


def repeats(docs: DataFrame, scratch: Scratch, length: int = LENGTH, hot_runs: int = HOT_RUNS,
            bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """doc_id, tag, spans: for each document with repeats, the bytes that go, as pieces that may overlap."""
    rows = own_rows(docs)
    long = rows.filter(F.octet_length("text") >= length)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, PIECE):
                data, bounds = texts_of(batch)
                name, _, first, count = runs(data, bounds, length)
                if not len(name):
                    continue
                # Equal runs count once here; runs that stand alone in the piece weigh in the total only.
                pairs = np.unique(np.stack((name, span_hashes(data, first, first + count + length - 1))), axis=1)[0]
                names, n = np.unique(pairs, return_counts=True)
                often = n >= 4
                yield pa.RecordBatch.from_pydict({
                    "name": np.concatenate((names[often].astype(np.int64), [0])), "n": np.concatenate((n[often], [len(pairs)])),
                    "total": np.concatenate((np.zeros(int(often.sum()), bool), [True])),
                    "bytes": np.concatenate((np.zeros(int(often.sum()), np.int64), [int((count + length + 40).sum())])),
                })

    seen = scratch.save(
        long.select("text").mapInArrow(counted, "name long, n long, total boolean, bytes long")
        .groupBy("total", "name").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes")), "names"
    )
    total = seen.filter("total").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes")).first()
    least = max(hot_runs, (total["n"] or 0) // HOT_SHARE)
    hot = np.sort(np.array([r["name"] for r in seen.filter("not total").filter(F.col("n") >= least).select("name").collect()], np.int64))
    buckets = max(int(scratch.spark.conf.get("spark.sql.shuffle.partitions")), (total["bytes"] or 0) // bucket_bytes + 1)

    def shipped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=5)
        for whole in batches:
            for batch in pieces(whole, PIECE):
                data, bounds = texts_of(batch)
                docs_, tags = batch.column("doc_id").to_numpy(), batch.column("tag").to_numpy()
                name, text, first, count, classes = first_runs(data, bounds, length, docs_, tags)
                place = first - bounds[text]
                gone = classes != np.arange(len(classes))
                gone &= (docs_[text] != docs_[text[classes]]) | (tags[text] != tags[text[classes]]) | (place != place[classes])
                kept = classes == np.arange(len(classes))
                d, t, f, s = merged(docs_[text[gone]], tags[text[gone]], place[gone], place[gone] + count[gone] + length - 1)
                out = [(-1, np.stack((d, t, f, s)).astype("<i8").tobytes())] if len(d) else []
                name, text, first, count = name[kept], text[kept], first[kept], count[kept]
                spread = np.isin(name.astype(np.int64), hot)
                if spread.any():
                    of = np.repeat(np.flatnonzero(spread), count[spread])
                    shift = np.arange(len(of)) - np.repeat(np.cumsum(count[spread]) - count[spread], count[spread])
                    starts = first[of] + shift
                    name = np.concatenate((name[~spread], mix(span_hashes(data, starts, starts + length))))
                    text = np.concatenate((text[~spread], text[of]))
                    first = np.concatenate((first[~spread], starts))
                    count = np.concatenate((count[~spread], np.ones(len(of), np.int64)))
                bucket = (mix(name) % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                edges = np.searchsorted(bucket[order], np.arange(buckets + 1)) if buckets < len(bucket) else np.append(np.flatnonzero(np.diff(bucket[order], prepend=-1)), len(order))
                for a, b in zip(edges[:-1], edges[1:], strict=True):
                    if a == b:
                        continue
                    at = order[a:b]
                    size = count[at] + length - 1
                    head = (name[at], docs_[text[at]], tags[text[at]], first[at] - bounds[text[at]], size)
                    parts = [x.astype(kind).tobytes() for x, (_, kind) in zip(head, FIELDS, strict=True)]
                    body = gathered(data, first[at], size).tobytes()
                    out.append((int(bucket[at[0]]), press.compress(b"".join((np.int64(len(at)).tobytes(), *parts, body)))))
                yield pa.RecordBatch.from_pydict(
                    {"bucket": [b for b, _ in out], "packed": [p for _, p in out]},
                    pa.schema([("bucket", pa.int64()), ("packed", pa.binary())]),
                )

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress, heads, bodies, current = zstandard.ZstdDecompressor(), [], [], None

        def close() -> pa.RecordBatch:
            columns = {k: np.concatenate(x).astype(np.int64) for (k, _), x in zip(FIELDS, zip(*heads, strict=True), strict=True)}
            return sorted_bucket(columns, np.concatenate(bodies), length)

        for batch in batches:
            for bucket, packed in zip(batch.column("bucket").to_pylist(), batch.column("packed").to_pylist(), strict=True):
                if bucket < 0:
                    yield spans(*np.frombuffer(packed, "<i8").reshape(4, -1))
                    continue
                if bucket != current and heads:
                    yield close()
                    heads, bodies = [], []
                current = bucket
                raw = unpress.decompress(packed)
                n, at, head = int(np.frombuffer(raw, "<i8", 1)[0]), 8, []
                for _, kind in FIELDS:
                    head.append(np.frombuffer(raw, kind, n, at))
                    at += head[-1].nbytes
                heads.append(head)
                bodies.append(np.frombuffer(raw, np.uint8, -1, at))
        if heads:
            yield close()

    # Spans that a piece has found itself are dealt over all tasks beside the buckets.
    task = F.when(F.col("bucket") >= 0, F.col("bucket")).otherwise(F.xxhash64("packed"))
    packed = long.mapInArrow(shipped, "bucket long, packed binary").withColumn("task", task)
    found = packed.repartition(buckets, "task").sortWithinPartitions("bucket").select("bucket", "packed").mapInArrow(met, SPANS)
    return found.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("first", "stop")).alias("spans"))


def remove(docs: DataFrame, scratch: Scratch, length: int = LENGTH, **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the bytes that stay)."""
    found = repeats(docs, scratch, length, **options)

    def pressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for whole in batches:
            for batch in pieces(whole):
                packed = pa.array([press.compress(t.encode()) for t in batch.column("text").to_pylist()], pa.binary())
                yield batch.drop_columns(["text"]).append_column("packed", packed)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        for whole in batches:
            for first_row in range(0, whole.num_rows, 500):
                batch = whole.slice(first_row, 500)
                out: dict[str, list] = {k: [] for k in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept")}
                for doc, packed, gone in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "packed", "spans")), strict=True):
                    raw, at, parts, n = unpress.decompress(packed), 0, [], 0
                    for first, stop in sorted((s["first"], s["stop"]) for s in gone or ()):
                        if first > at or not n:
                            n += 1
                            parts.append(raw[at:first])
                        at = max(at, stop)
                    parts.append(raw[at:])
                    kept = b"".join(parts)
                    for name, value in (("doc_id", doc), ("n_bytes", len(raw)), ("n_removed", len(raw) - len(kept)), ("n_spans", n), ("kept", kept)):
                        out[name].append(value)
                yield pa.RecordBatch.from_pydict(out, pa.schema([
                    ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary()),
                ]))

    # Texts meet their spans by shuffle, each pressed where it is read.
    rows = own_rows(docs).mapInArrow(pressed, "doc_id long, tag long, packed binary")
    joined = rows.join(found, ["doc_id", "tag"], "left").select("doc_id", "packed", "spans")
    done = joined.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
    return done.select(shown_id(), "n_bytes", "n_removed", "n_spans", "kept")


def digests(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))

