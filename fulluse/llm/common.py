"""What the operators share: document keys, written intermediate tables, hashing of words, components.

A document is known inside the operators by ``doc_id`` and ``tag``, a hash of its text, so that rows that repeat a
``doc_id`` with another text stay apart. A null ``doc_id`` orders before all others and comes back as null.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NO_ID = -(2**63)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LOWER_BYTES = bytes.maketrans(UPPER.encode(), LOWER.encode())


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id (never null), tag, text (never null); other columns are left behind."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    return docs.select(
        F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID)).alias("doc_id"),
        F.xxhash64(text).alias("tag"),
        text.alias("text"),
    )


def shown_id(column: str = "doc_id") -> Column:
    return F.nullif(F.col(column), F.lit(NO_ID)).alias(column)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case; a text of ASCII alone takes the faster way to the same result."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


class Scratch:
    """Intermediate tables in a new folder of the shared one (``spark.checkpoint.dir``, else the warehouse).

    A written table cuts the lineage: a lost executor costs a reread of Parquet.
    """

    def __init__(self, spark: SparkSession):
        root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
        self.spark, self.folder, self.tables = spark, f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}", 0

    def save(self, df: DataFrame, name: str) -> DataFrame:
        self.tables += 1
        path = f"{self.folder}/{name}-{self.tables}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


#: Bits of a sieve of keys, whatever the tables: 2 MB, or 2^18 longs by their places.
SIEVE = 1 << 24


def sifted(rows: DataFrame, wanted: DataFrame, on: list[str]) -> tuple[DataFrame, DataFrame]:
    """The rows that may have a partner in ``wanted`` by these keys, never null, and the rows that have none.

    The hash of a key is one bit of a bitmap that is broadcast. An exact join of the first follows, so that only few rows
    without a partner travel for it; more keys than bits only sieve less.
    """
    place = F.pmod(F.xxhash64(*on), F.lit(SIEVE))
    word, bit = F.shiftright(place, 6).cast("int"), place.bitwiseAND(F.lit(63)).cast("int")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    bits = wanted.groupBy(word.alias("_word")).agg(F.bit_or(one).alias("_bits"))
    met = rows.select("*", word.alias("_word"), bit.alias("_bit")).join(F.broadcast(bits), "_word", "left")
    hit = F.coalesce(F.getbit("_bits", "_bit") == 1, F.lit(False))
    return met.filter(hit).select(*rows.columns), met.filter(~hit).select(*rows.columns)


# Hashing of words in whole batches -------------------------------------------------------------------------------

_RNG = np.random.default_rng(20240501)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's powers and their inverses modulo 2**64, up to n."""
    if "up" not in _powers or len(_powers["up"]) <= n:
        size = max(n + 1, 1 << 16)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; equal bytes have equal hashes wherever they stand."""
    up, down = _power(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=sums[1:])
    own = (sums[ends] - sums[starts]) * down[starts]
    return mix(own + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def window_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """What ``span_hashes`` gives the ``width`` bytes from each place on."""
    up, down = _power(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=sums[1:])
    own = sums[width:] - sums[: len(sums) - width]
    own *= down[: len(own)]
    own += np.array(width, np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return mix(own)


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (between spaces and \\x09-\\x0D) of all texts, and each text's first word and end."""
    data = np.frombuffer(b" ".join([*texts, b""]) or b" ", np.uint8)
    inside = np.concatenate(([False], ~_SPACE[data], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    bounds = np.concatenate(([0], np.cumsum([len(x) + 1 for x in texts])))
    return span_hashes(data, starts, ends), np.searchsorted(starts, bounds)


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """The distinct hashes of runs of ``width`` words, sorted; fewer words are one run; no word, no hash."""
    if not len(words):
        return words
    if len(words) < width:
        out = np.array([len(words)], np.uint64)
        for w in words:
            out = mix(out * np.uint64(3) + w)
        return out
    out = words[: len(words) - width + 1].copy()
    for k in range(1, width):
        out = mix(out) + words[k : len(words) - width + 1 + k]
    return np.unique(mix(out))


def pieces(batch: pa.RecordBatch, size: int = 1 << 21, of: str = "text") -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about ``size`` bytes of text, or of another column, one row at least."""
    text = batch.column(of)
    wide = pa.types.is_large_string(text.type) or pa.types.is_large_binary(text.type)
    offsets = np.frombuffer(text.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[text.offset : text.offset + len(text) + 1]
    first = 0
    while first < batch.num_rows:
        stop = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        stop = min(max(stop, first + 1), batch.num_rows)
        yield batch.slice(first, stop - first)
        first = stop


# Components -----------------------------------------------------------------------------------------------------


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Connected components of edges (a, b) of longs: one row (node, root) for each node on an edge, root the
    smallest node of its component.

    Each round every node links the neighbours above it, and then those below it, to the smallest one it knows. Long
    chains halve, groups of any size need no pair but to their smallest node, and the minima are combined before the
    shuffle. The edges are written each round; the driver sees one number.
    """
    def both(e: DataFrame) -> DataFrame:
        return e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a"))

    current = scratch.save(
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(),
        f"{name}-0",
    )
    state, turn = None, 0
    while True:
        turn += 1
        smallest = both(current).groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both(current).join(smallest, "u").filter("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))
        large = large.filter("a < b").distinct()
        down = large.select(F.col("b").alias("u"), F.col("a").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).union(
            least.select(F.col("m").alias("a"), F.col("u").alias("b"))
        )
        current = scratch.save(small.filter("a < b").distinct(), f"{name}-{turn}")
        # Done when all edges lead from smallest nodes: then no round changes them.
        seen = current.agg(F.count("a").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if (seen["n"], seen["h"]) == state:
            break
        state = (seen["n"], seen["h"])
    stars = current.groupBy("b").agg(F.min("a").alias("root")).withColumnRenamed("b", "node")
    return stars.union(stars.select(F.col("root").alias("node"), "root").distinct())
