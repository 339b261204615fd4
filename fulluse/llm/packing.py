"""Packing by minimum bin slack: windows of fixed capacity filled from the histogram of piece lengths.

Each document is encoded once and cut into full windows and a rest. What is left to place is then a histogram: how many
rests there are of each length, at most ``capacity`` numbers whatever the corpus. The plan is made from it alone. Each
step takes the longest length left, finds with a bitset subset-sum the multiset of remaining lengths that fills the
window closest to capacity, backtracks how often each length is used, and repeats that window as often as the counts
allow. Where no multiset reaches capacity, the head of one more piece fills the slack and its tail goes back to the
histogram. The last tokens, fewer than a window, become windows of powers of two. The plan is a list of lots: the pieces
of one length from one rank to another, and the windows they go to. Its size depends on the number of lengths and not on
the documents, so it is made on the driver and sent to every task.

Ranks among pieces of one length are places within the task that encoded them plus the counts of the tasks before it.

Defined cases: a null or empty text has the end id only; a null doc_id stays null; rows that repeat doc_id or text are
packed each; a text of any length is encoded whole and becomes windows of its own and a rest; pieces of equal length are
interchangeable, which of them goes where follows from where they were read; an empty table gives no piece; columns
other than doc_id and text are left behind.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import deque
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fulluse.llm.common import Scratch, keyed, shown_id

CAPACITY, TEXT_BYTES, ROWS = 4096, 1 << 22, 512
#: Bits for a rank beside its length in one number.
RANK_BITS = 48


def fill(left: Mapping[int, int], sizes: list[int], capacity: int) -> dict[int, int]:
    """How often each length is used in a window with the longest one: the multiset with the least slack.

    ``sizes`` has the lengths of ``left`` in ascending order. Counts enter as powers of two, each one shift of a bitset
    of reachable sums; the sums before each shift are kept to walk back from the best one.
    """
    longest = sizes[-1]
    room = capacity - longest
    reach, full, steps = 1, (1 << room + 1) - 1, []
    for k in range(bisect_left(sizes, room + 1) - 1, -1, -1):
        size = sizes[k]
        count, unit = min(left[size] - (size == longest), room // size), 1
        while count > 0 and not reach >> room & 1:
            take = min(unit, count)
            steps.append((size, take, reach))
            reach |= reach << size * take & full
            count, unit = count - take, unit * 2
        if reach >> room & 1:
            break
    best, used = reach.bit_length() - 1, {longest: 1}
    for size, take, before in reversed(steps):
        if not before >> best & 1:
            used[size] = used.get(size, 0) + take
            best -= size * take
    return used


@dataclass
class Plan:
    """Lots by generation: a piece that is cut has its next part one generation later.

    A lot is (length of the piece before any cut, first rank, end of ranks, tokens before, tokens used, first window,
    pieces of the lot's length in a window, pieces before the lot, place of the first in the window).
    """

    capacity: int
    lots: list[list[tuple[int, ...]]] = field(default_factory=list)
    windows: int = 0

    def arrays(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each generation the sorted keys of its lots, and the lots."""
        out = []
        for lots in self.lots:
            rows = np.array(sorted(lots), np.int64)
            out.append((rows[:, 0] << RANK_BITS | rows[:, 1], rows))
        return out


def plan(counts: Mapping[int, int], capacity: int = CAPACITY) -> Plan:
    """The windows for so many pieces of each length, 1 to ``capacity``."""
    out = Plan(capacity)
    left = {size: n for size, n in counts.items() if n > 0}
    stock = {size: deque([(size, 0, n, 0, 0)]) for size, n in left.items()}
    sizes = sorted(left)

    def take(size: int, count: int, length: int, per: int, at: int) -> None:
        """``count`` pieces of ``size``, ``per`` of them in each window, with their first ``length`` tokens."""
        left[size] -= count
        if not left[size]:
            del sizes[bisect_left(sizes, size)]
        before = 0
        while before < count:
            own, first, end, shift, generation = stock[size].popleft()
            stop = min(end, first + count - before)
            if stop < end:
                stock[size].appendleft((own, stop, end, shift, generation))
            while len(out.lots) <= generation:
                out.lots.append([])
            out.lots[generation].append((own, first, stop, shift, length, out.windows, per, before, at))
            if rest := size - length:
                stock.setdefault(rest, deque()).append((own, first, stop, shift + length, generation + 1))
                if not left.get(rest):
                    left[rest] = 0
                    insort(sizes, rest)
                left[rest] += stop - first
            before += stop - first

    while sizes:
        used = fill(left, sizes, capacity)
        filled = sum(size * n for size, n in used.items())
        cut = next((s for s in reversed(sizes) if left[s] > used.get(s, 0)), None) if filled < capacity else None
        if filled < capacity and cut is None:
            break
        # One more piece of the longest length with any to spare: all are longer than the slack, or it would be less.
        times = min(left[s] // (n + (s == cut)) for s, n in (used if cut is None else {cut: 0} | used).items())
        at = 0
        for size, n in used.items():
            take(size, times * n, size, n, at)
            at += size * n
        if cut is not None:
            take(cut, times, capacity - filled, 1, at)
        out.windows += times
    rest = sum(size * left[size] for size in sizes)
    window, at = 1 << rest.bit_length() - 1 if rest else 0, 0
    while sizes:
        length = min(sizes[-1], window - at)
        take(sizes[-1], 1, length, 1, at)
        at, rest = at + length, rest - length
        if at == window:
            out.windows += 1
            window, at = 1 << rest.bit_length() - 1 if rest else 0, 0
    return out


def encoded(docs: DataFrame, scratch: Scratch, tokenizer_file: str, end_id: int, capacity: int, width: int) -> DataFrame:
    """part, size, k, doc_id, start, doc_tokens, ids: every document in pieces of at most ``capacity`` ids.

    ``part`` is the task that wrote the piece and ``k`` its number there among those of its size.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from fulluse.llm.common import pieces
        from fulluse.llm.id_files import encoder

        encode, end = encoder(tokenizer_file, width), np.array([end_id], f"<u{width}").tobytes()
        part, seen = TaskContext.get().partitionId(), [0] * (capacity + 1)
        for whole in batches:
            for batch in pieces(whole, TEXT_BYTES):
                ids, cuts = encode(batch.column("text"))
                raw, cuts = ids.tobytes(), cuts.tolist()
                out: dict[str, list] = {k: [] for k in ("size", "k", "doc_id", "start", "doc_tokens", "ids")}
                for d, doc in enumerate(batch.column("doc_id").to_pylist()):
                    own = raw[cuts[d] * width : cuts[d + 1] * width] + end
                    total = len(own) // width
                    for start in range(0, total, capacity):
                        piece = own[start * width : (start + capacity) * width]
                        size = len(piece) // width
                        for name, value in zip(out, (size, seen[size], doc, start, total, piece), strict=True):
                            out[name].append(value)
                        seen[size] += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(out["k"]), pa.int32()), *(pa.array(v, kinds.field(k).type) for k, v in out.items())],
                    schema=kinds,
                )

    kinds = pa.schema([
        ("part", pa.int32()), ("size", pa.int32()), ("k", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()),
        ("doc_tokens", pa.int64()), ("ids", pa.binary()),
    ])
    found = keyed(docs).select("doc_id", "text").mapInArrow(
        cut, "part int, size int, k long, doc_id long, start long, doc_tokens long, ids binary"
    )
    return scratch.save(found, "pieces")


def pack(docs: DataFrame, scratch: Scratch, tokenizer_file: str, end_id: int = 2, capacity: int = CAPACITY, width: int = 2) -> DataFrame:
    """doc_id, start, length, doc_tokens, sequence_id, offset, ids: each piece of a document and its place.

    ``ids`` are the piece's ids as little-endian 32-bit numbers. Until they are placed they take ``width`` bytes each;
    2 serves vocabularies under 65,536 ids.
    """
    rows = encoded(docs, scratch, tokenizer_file, end_id, capacity, width)
    counts = scratch.save(rows.groupBy("size", "part").agg(F.count(F.lit(1)).alias("n")), "counts")
    histogram = {r["size"]: r["n"] for r in counts.groupBy("size").agg(F.sum("n").alias("n")).collect()}
    generations = plan(histogram, capacity).arrays()
    before = Window.partitionBy("size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("size", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = rows.join(base, ["size", "part"]).select(
        "size", (F.col("base") + F.col("k")).alias("rank"), "doc_id", "start", "doc_tokens", "ids"
    )

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(k, ROWS) for whole in batches for k in range(0, whole.num_rows, ROWS)):
            size, rank = (batch.column(c).to_numpy().astype(np.int64) for c in ("size", "rank"))
            row = np.arange(batch.num_rows)
            for keys, lots in generations:
                if not len(row):
                    break
                own = lots[np.maximum(np.searchsorted(keys, size[row] << RANK_BITS | rank[row], "right") - 1, 0)].T
                known = (own[0] == size[row]) & (own[1] <= rank[row]) & (rank[row] < own[2])
                row, (_, first, _, shift, length, window, per, skipped, at) = row[known], own[:, known]
                if not len(row):
                    break
                index = rank[row] - first + skipped
                found, rows_of = batch.take(pa.array(row)), zip(shift.tolist(), length.tolist(), strict=True)
                ids = [
                    np.frombuffer(x, f"<u{width}", n, a * width).astype("<u4").tobytes()
                    for x, (a, n) in zip(found.column("ids").to_pylist(), rows_of, strict=True)
                ]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": found.column("doc_id"), "start": pa.array(found.column("start").to_numpy() + shift),
                    "length": pa.array(length), "doc_tokens": found.column("doc_tokens"),
                    "sequence_id": pa.array(window + index // per), "offset": pa.array(at + index % per * length),
                    "ids": pa.array(ids, pa.binary()),
                })

    found = ranked.mapInArrow(
        placed, "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
    )
    return found.withColumn("doc_id", shown_id())


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, length, ids, ends: each window whole, with the ends of its pieces; at most ``capacity`` pieces meet."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "length", "ids")))
    found = packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("parts"))
    return found.select(
        "sequence_id", "length",
        F.unhex(F.array_join(F.transform("parts", lambda p: F.hex(p["ids"])), "")).alias("ids"),
        F.transform("parts", lambda p: p["offset"] + p["length"]).alias("ends"),
    )


def digests(packed: DataFrame) -> DataFrame:
    """The pieces with the crc32 of their ids instead of the ids."""
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
