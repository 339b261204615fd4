"""Documents whose sets of word n-grams overlap, joined by a blocked sparse matrix product.

The rows of the incidence matrix are documents, its columns n-grams (64-bit hashes of runs of words).

1. Equal rows are one class, known by a 128-bit hash of the sorted columns; one document stands for it.
2. Columns are dealt by hash into so many blocks that two rows over the threshold differ in fewer columns than there are
   blocks: the number follows from the sizes. Such rows agree in one of their fullest blocks whole; all other pairs are
   discarded unseen. A block's content is a key. Keys are counted where they meet, and of each row those that most rows
   have are left out, as many as the bound allows: any order that all rows follow keeps a common key. Rows meet at the
   smallest document of each key that is left, never pair by pair.
3. Rows that hang together by keys are a cluster. In one of more than ``BLOCK`` rows the keys are counted (in ``SLOTS``
   sums) and chosen anew, the rarest first: any order that all rows follow keeps a common key, and passages that many
   documents share then hold no rows together. What still hangs together are the clusters of such rows.
4. In a cluster overlaps are accumulated as a product of blocks of rows, and pairs whose overlap is below the bound that
   their sizes set are discarded. A cluster of more than ``BLOCK`` rows first meets its smallest document and about
   ``ANCHORS`` others that a hash picks. What these join is mostly one component; after that only rows outside the
   largest one meet others, block by block. A task emits a spanning forest of the links it finds, not all of them.
5. Links become components; a class has the component of its representative.

Defined cases: null and empty texts have no n-gram, size 0 and are linked with nothing; fewer words than ``width`` are
one n-gram; rows that repeat doc_id and text are copies; rows that repeat doc_id alone are different documents, whose
component shows the same doc_id; texts of any length are read whole; an empty table gives no row; ``kept_rows`` returns
all columns whatever their names, ``join`` only its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fulluse.llm.common import LOWER_BYTES, NO_ID, Scratch, components, keyed, mix, pieces, shingle_hashes, shown_id, sifted, word_hashes

BLOCK, COLUMNS, ANCHORS, SLOTS = 256, 2048, 16, 1 << 20
#: Bytes of text hashed at once: hashing holds about forty times as many.
PIECE = 1 << 19
#: Bytes of keys that meet at once where they are dealt, and in a bucket: joining them holds some ten times as many.
KEYS, BUCKET = 1 << 21, 1 << 23


def levels(num: int, den: int, most: int) -> list[int]:
    """Upper sizes of levels such that sizes which may link are at most one level apart."""
    out = [1]
    while out[-1] < most:
        out.append(max(out[-1] + 1, out[-1] * den // num))
    return [*out, max(out[-1] + 1, out[-1] * den // num)]


def level_keys(columns: np.ndarray, num: int, den: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """For a row's own level and the next: keys of its column blocks, columns in each, and how many keys may differ."""
    tops = levels(num, den, len(columns))
    own = int(np.searchsorted(tops, len(columns)))
    for level in (own, own + 1):
        # Two sizes up to top with the wanted similarity differ in at most so many columns, so in no more blocks.
        most = 2 * tops[level] * (den - num) // (den + num)
        blocks = max(most + 1, 3 * most // 2)
        spread = mix(columns + np.uint64(2 * level + 1))
        at = ((spread >> np.uint64(33)) % np.uint64(blocks)).astype(np.int64)
        sums = np.zeros(blocks, np.uint64)
        np.add.at(sums, at, mix(spread))
        place = np.arange(blocks, dtype=np.uint64) + np.uint64((level + 1) << 40)
        yield level, mix(sums + mix(place)), np.bincount(at, minlength=blocks), most


def slots(keys: np.ndarray) -> np.ndarray:
    return (keys % np.uint64(SLOTS)).astype(np.int64)


def block_keys(columns: np.ndarray, num: int, den: int, seen: np.ndarray) -> np.ndarray:
    """The keys of a row, at its own level and the next; ``seen`` says how frequent the keys of each slot are."""
    out = []
    for _, keys, filled, most in level_keys(columns, num, den):
        # At most ``most`` of a row's keys are not the other row's. In any order that both rows follow, their first
        # most + 1 keys so have one in common. Rare keys go first, then full blocks, which rows rarely share by chance.
        out.append(keys[np.lexsort((keys, -filled, seen[slots(keys)]))[: most + 1]])
    return np.concatenate(out)


def counted_keys(columns: np.ndarray, num: int, den: int) -> tuple[np.ndarray, int]:
    """The keys of a row that are counted before ``most + 1`` of each level are chosen, and how many the choice leaves out.

    Blocks with columns are counted, empty ones follow only where these do not suffice; an order by that, then by
    counts, is one that all rows follow. A key has 47 bits and its level's parity, in which a row's two levels differ;
    keys that are equal by chance only let more rows meet. The number left out is kept by parity, 32 bits each.
    """
    out, spare = [], 0
    for level, keys, filled, most in level_keys(columns, num, den):
        count = max(int((filled > 0).sum()), most + 1)
        keys = keys[np.lexsort((keys, -filled))[:count]] >> np.uint64(16)
        out.append(keys & ~np.uint64(1) | np.uint64(level & 1))
        spare |= (count - most - 1) << (32 * (level & 1))
    return np.concatenate(out), spare


def rows_of(texts: list[str], width: int) -> list[np.ndarray]:
    """The rows of the incidence matrix: each text's distinct n-grams."""
    words, bounds = word_hashes([t.encode().translate(LOWER_BYTES) for t in texts])
    return [shingle_hashes(words[a:b], width) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def incidence(docs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """doc_id, tag, n, s1, s2 (hash of the whole set), keys and spare (how many of them may be left out)."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, PIECE):
                n, s1, s2, keys, spare = [], [], [], [], []
                for found in rows_of(batch.column("text").to_pylist(), width):
                    place = np.arange(len(found), dtype=np.uint64)
                    n.append(len(found))
                    for out, salt in ((s1, 1), (s2, 2)):
                        out.append(int(mix(mix(found + np.uint64(salt)) + place).sum(dtype=np.uint64).astype(np.int64)))
                    own, left = counted_keys(found, num, den) if len(found) else (place, 0)
                    keys.append(own.astype("<u8").tobytes())
                    spare.append(left)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column("doc_id"), "tag": batch.column("tag"), "n": pa.array(n, pa.int64()),
                    "s1": pa.array(s1, pa.int64()), "s2": pa.array(s2, pa.int64()), "keys": pa.array(keys, pa.binary()),
                    "spare": pa.array(spare, pa.int64()),
                })

    return keyed(docs).mapInArrow(rows, "doc_id long, tag long, n long, s1 long, s2 long, keys binary, spare long")


def frequencies(rows: DataFrame, width: int, num: int, den: int) -> np.ndarray:
    """How many keys of all rows fall into each slot, as eighths of a power of two at most 255: always SLOTS bytes."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, np.int64)
        for whole in batches:
            for batch in pieces(whole, PIECE):
                for found in rows_of(batch.column("text").to_pylist(), width):
                    if len(found):
                        for _, keys, _, _ in level_keys(found, num, den):
                            np.add.at(total, slots(keys), 1)
        slot = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"slot": slot, "n": total[slot]})

    sums = rows.select("text").mapInArrow(counted, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    steps = F.least(F.floor(8 * F.log2("n")), F.lit(255)).cast("int")
    got = sums.select(F.col("slot").cast("int"), steps.alias("step")).toArrow()
    out = np.zeros(SLOTS, np.uint8)
    out[got.column("slot").to_numpy()] = got.column("step").to_numpy()
    return out


def rarest_keys(rows: DataFrame, seen: np.ndarray, width: int, num: int, den: int) -> DataFrame:
    """doc_id, keys: the rarest keys of each row."""
    shared = rows.sparkSession.sparkContext.broadcast(seen)

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, PIECE):
                found = rows_of(batch.column("text").to_pylist(), width)
                keys = [block_keys(f, num, den, shared.value).astype("<i8").tobytes() if len(f) else b"" for f in found]
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "keys": pa.array(keys, pa.binary())})

    return rows.select("doc_id", "text").mapInArrow(chosen, "doc_id long, keys binary")


PACKED = pa.schema([("bucket", pa.int64()), ("packed", pa.binary())])


def packed(bucket: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
    """Rows of 64-bit numbers as one compressed piece for each bucket, in the order they are in."""
    press, out = zstandard.ZstdCompressor(level=3), []
    order = np.argsort(bucket, kind="stable")
    cuts = np.append(np.flatnonzero(np.diff(bucket[order].astype(np.int64), prepend=-1)), len(order))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        at = order[a:b]
        # The first column ascends, so its steps have zero bytes on top; planes of bytes press better than numbers.
        rows = [c[at].astype(np.uint64) for c in columns]
        rows[0] = np.diff(rows[0], prepend=np.uint64(0))
        planes = np.ascontiguousarray(np.stack(rows).view(np.uint8).reshape(-1, 8).T)
        out.append((int(bucket[at[0]]), press.compress(planes.tobytes())))
    return pa.RecordBatch.from_pydict({"bucket": [x for x, _ in out], "packed": [x for _, x in out]}, PACKED)


def unpacked(piece: bytes, columns: int) -> np.ndarray:
    """The columns of a packed piece."""
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(piece), np.uint8).reshape(8, -1)
    rows = np.ascontiguousarray(planes.T).view("<u8").reshape(columns, -1)
    rows[0] = np.cumsum(rows[0], dtype=np.uint64)
    return rows


def by_bucket(batches: Iterator[pa.RecordBatch], *columns: int) -> Iterator[list[np.ndarray]]:
    """The rows of each bucket, of pieces that come in order of buckets; of several kinds if they have several widths."""
    held: dict[int, list[np.ndarray]] = {}
    current = None

    def close() -> list[np.ndarray]:
        return [np.concatenate([np.zeros((n, 0), np.uint64), *held.get(k, [])], axis=1) for k, n in enumerate(columns)]

    for batch in batches:
        kinds = batch.column("kind").to_pylist() if len(columns) > 1 else [0] * batch.num_rows
        for bucket, kind, piece in zip(batch.column("bucket").to_pylist(), kinds, batch.column("packed").to_pylist(), strict=True):
            if bucket != current and held:
                yield close()
                held = {}
            current = bucket
            held.setdefault(kind, []).append(unpacked(piece, columns[kind]))
    if held:
        yield close()


def kept_keys(heads: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """heads: doc, spare; shared: doc, key, how many rows have it. Docs and their shared keys without the most frequent.

    Rows that repeat a doc_id keep all.
    """
    order = np.argsort(heads[0], kind="stable")
    docs, first, copies = np.unique(heads[0][order], return_index=True, return_counts=True)
    spare = np.where(copies > 1, 0, heads[1][order][first])
    doc, key, n = shared
    if not len(doc):
        return doc, key
    odd = key & np.uint64(1)
    order = np.lexsort((key, n, odd, doc))
    doc, key, odd = doc[order], key[order], odd[order]
    alone = np.ones(len(doc), bool)
    alone[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])
    doc, key, odd = doc[alone], key[alone], odd[alone]
    starts = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (odd[1:] != odd[:-1]))))
    ends = np.append(starts[1:], len(doc))
    left = np.repeat(ends, ends - starts) - np.arange(len(doc)) - 1
    own = spare[np.searchsorted(docs, doc)] >> (odd * np.uint64(32)) & np.uint64(0xFFFFFFFF)
    kept = left >= own.astype(np.int64)
    return doc[kept], key[kept]


def rare_keys(rows: DataFrame, buckets: int) -> DataFrame:
    """rows: doc_id, keys, spare. doc_id, keys: the keys that another row has too, without the most frequent ``spare``.

    Every row's keys meet once, and what comes back for the choice are those that are shared.
    """
    count = np.uint64(buckets)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(pieces(whole, KEYS, "keys") for whole in batches):
            lists = [np.frombuffer(k, "<u8") for k in batch.column("keys").to_pylist()]
            doc = np.repeat(batch.column("doc_id").to_numpy(), [len(x) for x in lists])
            key = np.concatenate(lists)
            order = np.argsort(key, kind="stable")
            yield packed((key[order] >> np.uint64(16)) % count, key[order], doc[order])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ((key, doc),) in by_bucket(batches, 2):
            _, place, n = np.unique(key, return_inverse=True, return_counts=True)
            n = n[place]
            some = np.flatnonzero(n > 1)
            some = some[np.argsort(doc[some], kind="stable")]
            yield packed((mix(doc[some]) >> np.uint64(33)) % count, doc[some], key[some], n[some])

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc = batch.column("doc_id").to_numpy().astype(np.uint64)
            order = np.argsort(doc, kind="stable")
            spare = batch.column("spare").to_numpy()
            yield packed((mix(doc[order]) >> np.uint64(33)) % count, doc[order], spare[order])

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, shared in by_bucket(batches, 2, 3):
            doc, key = kept_keys(own, shared)
            docs, first = np.unique(doc, return_index=True)
            keys = [x.astype("<u8").tobytes() for x in np.split(key, first[1:])] if len(docs) else []
            yield pa.RecordBatch.from_pydict({"doc_id": pa.array(docs.astype(np.int64)), "keys": pa.array(keys, pa.binary())})

    kind = "bucket long, packed binary"
    met = rows.select("doc_id", "keys").mapInArrow(dealt, kind).repartition(buckets, "bucket").sortWithinPartitions("bucket")
    shared = met.mapInArrow(counted, kind).withColumn("kind", F.lit(1))
    own = rows.select("doc_id", "spare").mapInArrow(heads, kind).withColumn("kind", F.lit(0))
    both = own.union(shared).repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return both.mapInArrow(chosen, "doc_id long, keys binary")


def shared_keys(rows: DataFrame, buckets: int) -> DataFrame:
    """rows: doc_id, keys. Edges a, b: each row to the smallest doc_id that has one of its keys, over one step more.

    A task joins the rows that it sees of a key to the smallest of them and ships the key once, so a key that a third of
    all rows have is a row for each piece of ``KEYS`` bytes.
    """
    def joined(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct keys, the smallest doc of each, and the edges from there as two rows."""
        order = np.lexsort((doc, key))
        key, doc = key[order], doc[order]
        first = np.concatenate(([True], key[1:] != key[:-1]))[: len(key)]
        lead = doc[np.flatnonzero(first)][np.cumsum(first) - 1] if len(key) else doc
        other = lead != doc
        return key[first], doc[first], np.unique(np.stack((lead[other], doc[other])), axis=1)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(pieces(whole, KEYS, "keys") for whole in batches):
            lists = [np.frombuffer(k, "<u8") for k in batch.column("keys").to_pylist()]
            ids = np.repeat(batch.column("doc_id").to_numpy(), [len(x) for x in lists])
            key, doc, edges = joined(np.concatenate(lists), ids)
            if edges.size:
                yield pa.RecordBatch.from_pydict({"bucket": [-1], "packed": [edges.astype("<i8").tobytes()]}, PACKED)
            yield packed((key >> np.uint64(16)) % np.uint64(buckets), key, doc)

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, current = [], None

        def close() -> pa.RecordBatch:
            key, doc = np.concatenate(held, axis=1)
            edges = joined(key, doc.astype(np.int64))[2]
            return pa.RecordBatch.from_pydict({"a": edges[0], "b": edges[1]})

        for batch in batches:
            for bucket, piece in zip(batch.column("bucket").to_pylist(), batch.column("packed").to_pylist(), strict=True):
                if bucket < 0:
                    a, b = np.frombuffer(piece, "<i8").reshape(2, -1)
                    yield pa.RecordBatch.from_pydict({"a": a, "b": b})
                    continue
                if bucket != current and held:
                    yield close()
                    held = []
                current = bucket
                held.append(unpacked(piece, 2))
        if held:
            yield close()

    task = F.when(F.col("bucket") >= 0, F.col("bucket")).otherwise(F.xxhash64("packed"))
    made = rows.mapInArrow(dealt, "bucket long, packed binary").withColumn("task", task)
    grouped = made.repartition(buckets, "task").sortWithinPartitions("bucket").select("bucket", "packed")
    return grouped.mapInArrow(met, "a long, b long")


def overlaps(xs: list[np.ndarray], ys: list[np.ndarray]) -> np.ndarray:
    """The product of two blocks of rows: how many columns each x and y share, accumulated over blocks of columns."""
    total = np.zeros((len(xs), len(ys)))
    rows = np.repeat(np.arange(len(xs) + len(ys)), [len(r) for r in [*xs, *ys]])
    columns, at = np.unique(np.concatenate([*xs, *ys]), return_inverse=True)
    x, y = at[rows < len(xs)], at[rows >= len(xs)]
    both = np.zeros(len(columns), bool)
    both[np.intersect1d(x, y)] = True
    names = np.cumsum(both) - 1
    keep = both[at]
    rows, at = rows[keep], names[at[keep]]
    order = np.argsort(at, kind="stable")
    rows, at = rows[order], at[order]
    for first in range(0, int(both.sum()), COLUMNS):
        lo, hi = np.searchsorted(at, (first, first + COLUMNS))
        block = np.zeros((len(xs) + len(ys), COLUMNS), np.float32)
        block[rows[lo:hi], at[lo:hi] - first] = 1
        total += block[: len(xs)] @ block[len(xs) :].T
    return total


def links(xs: list, ys: list, width: int, num: int, den: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between rows of xs and ys, or among xs if there is no y; places in xs + ys."""
    everyone = [*xs, *ys]
    sets = rows_of(everyone, width)
    x, y = sets[: len(xs)], sets[len(xs) :] or sets
    sizes = np.array([len(s) for s in sets])
    left, right = sizes[: len(xs), None], (sizes[None, len(xs) :] if ys else sizes[None, :])
    linked = overlaps(x, y).astype(np.int64) * (num + den) >= num * (left + right)
    linked &= (left > 0) & (right > 0)
    if not ys:
        linked = np.triu(linked, 1)
    parent = list(range(len(everyone)))

    def top(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    out = []
    for a, b in np.argwhere(linked).tolist():
        b = b + len(xs) if ys else b
        if (p := top(a)) != (q := top(b)):
            parent[q] = p
            out.append((a, b))
    return out


def product(rows: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """rows: cluster, i, j (a pair of blocks of rows), side 0 or 1, doc_id, tag, text. Returns links a, b (structs)."""
    node = pa.struct([("doc_id", pa.int64()), ("tag", pa.int64())])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def close() -> pa.RecordBatch:
            unique = {(r["side"], r["doc_id"], r["tag"]): r for r in held}
            ordered = [unique[k] for k in sorted(unique)]
            xs, ys = ([r["text"] for r in ordered if r["side"] == s] for s in (0, 1))
            pairs = links(xs, ys, width, num, den) if xs and len(ordered) > 1 else []
            ends = [{k: r[k] for k in ("doc_id", "tag")} for r in ordered]
            return pa.RecordBatch.from_arrays(
                [pa.array([ends[p[k]] for p in pairs], node) for k in (0, 1)], names=["a", "b"]
            )

        for batch in batches:
            for row in batch.to_pylist():
                if held and any(row[c] != held[0][c] for c in ("cluster", "i", "j")):
                    yield close()
                    held = []
                held.append(row)
        if held:
            yield close()

    group = ["cluster", "i", "j"]
    dealt = rows.select(*group, "side", "doc_id", "tag", "text").repartition(*group).sortWithinPartitions(*group)
    both = "struct<doc_id:bigint,tag:bigint>"
    return dealt.mapInArrow(found, f"a {both}, b {both}")


def clustered(owners: DataFrame, edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """doc_id, tag, cluster of the owners that edges between documents hold together with others."""
    # doc_id alone names a row here: one that repeats with other texts makes its cluster larger, which the product mends.
    clusters = components(edges.distinct(), scratch, name)
    members = owners.join(clusters.withColumnRenamed("node", "doc_id"), "doc_id").withColumnRenamed("root", "cluster")
    repeated = owners.groupBy("doc_id").agg(F.count(F.lit(1)).alias("k")).filter("k > 1")
    own = owners.join(repeated, "doc_id", "left_semi").join(members, ["doc_id", "tag"], "left_anti")
    return scratch.save(members.union(own.select("doc_id", "tag", F.col("doc_id").alias("cluster"))), f"{name}-members")


def join(docs: DataFrame, scratch: Scratch, width: int = 5, num: int = 80, den: int = 100, block: int = BLOCK) -> DataFrame:
    """doc_id, tag, n_shingles, component_id, root_tag: documents link when den * intersection >= num * union."""
    sets = scratch.save(incidence(docs, width, num, den), "sets")
    classes = sets.filter("n > 0").groupBy("s1", "s2").agg(F.min(F.struct("doc_id", "tag")).alias("node"))
    classes = scratch.save(classes, "classes")
    # Two levels of keys, of eight bytes each.
    total = (sets.agg(F.sum("n")).first()[0] or 0) * 2 * 2 * (den - num) // (den + num) * 8
    buckets = max(int(scratch.spark.conf.get("spark.sql.shuffle.partitions")), total // BUCKET + 1)
    owners = classes.select("node.doc_id", "node.tag")
    chosen = rare_keys(sets.filter("n > 0").select("doc_id", "keys", "spare"), buckets)
    members = clustered(owners, shared_keys(chosen, buckets), scratch, "clusters")
    sizes = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("rows"))
    # Most documents are in no cluster; their texts stay where they are.
    inside, _ = sifted(keyed(docs), members, ["doc_id", "tag"])
    text = inside.join(members.join(sizes, "cluster"), ["doc_id", "tag"])
    text = scratch.save(text.select("cluster", "rows", "doc_id", "tag", "text"), "texts")
    small, wide = text.filter(F.col("rows") <= block), text.filter(F.col("rows") > block)
    keys = rarest_keys(wide, frequencies(wide, width, num, den), width, num, den)
    members = clustered(wide.select("doc_id", "tag").distinct(), shared_keys(keys, buckets), scratch, "rarest")
    # Documents of a large cluster that meet all others of it: the first one and some that a hash picks.
    picked = F.pmod(F.xxhash64("doc_id", "tag"), F.greatest(F.ceil(F.col("rows") / ANCHORS), F.lit(1))) == 0
    sizes = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("rows"), F.min(F.struct("doc_id", "tag")).alias("first"))
    text = scratch.save(
        wide.select("doc_id", "tag", "text").join(members.join(sizes, "cluster"), ["doc_id", "tag"]).select(
            "cluster", "rows", "doc_id", "tag", "text",
            ((F.struct("doc_id", "tag") == F.col("first")) | picked).alias("is_anchor"),
        ), "wide",
    )

    def side(rows: DataFrame, which: int, i, j) -> DataFrame:
        return rows.select("cluster", i.alias("i"), j.alias("j"), F.lit(which).alias("side"), "doc_id", "tag", "text")

    def dealt(count) -> F.Column:
        return F.pmod(F.xxhash64("tag", "doc_id"), F.ceil(count / block)).cast("int")

    def every(count) -> F.Column:
        return F.explode(F.sequence(F.lit(0), (F.ceil(count / block) - 1).cast("int")))

    zero = F.lit(0)
    small = small.union(text.filter(F.col("rows") <= block).select(*small.columns))
    large = text.filter(F.col("rows") > block)
    # The anchors go to each block of their cluster, so no task holds a cluster.
    ahead = large.filter("is_anchor").withColumn("i", every(F.col("rows")))
    met = side(ahead, 0, F.col("i"), F.lit(-1)).union(side(large, 1, dealt(F.col("rows")), F.lit(-1)))
    found = scratch.save(product(side(small, 0, zero, zero), width, num, den), "links")
    with_anchors = scratch.save(product(met, width, num, den), "with_anchors")
    found = found.union(with_anchors)
    # What the anchors joined is one component of most large clusters. Rows outside the largest one meet all others, in
    # pairs of blocks; rows within it are known to belong together.
    node = F.struct("doc_id", "tag")
    named = components(with_anchors, scratch, "ahead")
    own = large.select("cluster", node.alias("node")).join(named, "node", "left")
    own = scratch.save(own.select("cluster", "node", F.coalesce("root", "node").alias("root")), "own")
    main = own.groupBy("cluster", "root").agg(F.count(F.lit(1)).alias("k")).groupBy("cluster").agg(
        F.max(F.struct("k", "root")).alias("most")
    )
    linked = own.join(main, "cluster").select("cluster", "node.*", (F.col("root") == F.col("most.root")).alias("linked"))
    rest = large.filter("not is_anchor").join(linked, ["cluster", "doc_id", "tag"])
    counts = rest.groupBy("cluster").agg(
        F.sum(F.when(~F.col("linked"), 1).otherwise(0)).alias("loose"), F.sum(F.when(F.col("linked"), 1).otherwise(0)).alias("firm")
    ).filter("loose > 0")
    rest = rest.join(scratch.save(counts, "counts"), "cluster")
    loose = rest.filter("not linked").withColumn("own", dealt(F.col("loose"))).withColumn("other", every(F.col("loose")))
    firm = rest.filter("linked").withColumn("own", dealt(F.col("firm")))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    within = loose.select("cluster", low.alias("i"), high.alias("j"), F.when(F.col("own") == low, 0).otherwise(1).alias("side"), "doc_id", "tag", "text")
    # Blocks of loose rows against blocks of linked ones; j counts down from -2 there.
    facing = rest.filter("not linked and firm > 0").withColumn("own", dealt(F.col("loose"))).withColumn("other", every(F.col("firm")))
    across = side(facing, 0, F.col("own"), -2 - F.col("other")).union(
        side(firm.withColumn("other", every(F.col("loose"))), 1, F.col("other"), -2 - F.col("own"))
    )
    more = product(within.union(across), width, num, den)
    roots = components(found.union(more), scratch, "components")
    named = scratch.save(
        classes.join(roots, "node", "left").select("s1", "s2", F.coalesce("root", "node").alias("root")), "named"
    )
    alone = F.struct("doc_id", "tag")
    out = sets.select("doc_id", "tag", "n", "s1", "s2").join(named, ["s1", "s2"], "left")
    out = out.withColumn("root", F.when(F.col("n") > 0, F.col("root")).otherwise(alone))
    return out.select(
        shown_id(), "tag", F.col("n").alias("n_shingles"), F.nullif("root.doc_id", F.lit(NO_ID)).alias("component_id"),
        F.col("root.tag").alias("root_tag"),
    )


def kept_rows(docs: DataFrame, scratch: Scratch, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the row with the smallest doc_id, once."""
    found = join(docs, scratch, width, num, den)
    stays = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("tag") == F.col("root_tag"))
    key = ["doc_id", "tag"]
    # Rows that repeat a document share its component, so all of them stay or none.
    touched = found.groupBy(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "tag").agg(
        F.bool_and(stays).alias("stays"), F.count(F.lit(1)).alias("copies")
    )
    touched = scratch.save(touched.filter("not stays or copies > 1").select(*key, "stays"), "touched")
    # The columns travel as one, so that none can have a name used here.
    rows = docs.select(F.struct(*docs.columns).alias("row")).select(
        "row", F.coalesce(F.col("row.doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"),
        F.xxhash64(F.coalesce(F.col("row.text").cast("string"), F.lit(""))).alias("tag"),
    )
    # Most rows stay and are the only ones of their document: they need no exchange.
    doubtful, clear = sifted(rows, touched, key)
    alone = doubtful.join(touched, key, "left_anti")
    again = doubtful.join(touched.filter("stays"), key, "left_semi").dropDuplicates(key)
    return clear.unionByName(alone).unionByName(again).select("row.*")
