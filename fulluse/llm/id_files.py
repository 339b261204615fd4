"""Token ids in bit-plane files: write documents in id order, read ids back.

A file set is a folder of chunks. A chunk holds a fixed number of ids (the last of a shard may hold fewer), transposed
into bit planes (or byte planes), each plane one zstandard frame behind a small index of plane lengths. Beside its
payload a chunk's row has its place: shard, number, first id in the shard, and the documents in it. These rows are the
chunk index. The container is Parquet, so that Spark's committer decides which attempt of a task counts.

Shards are ranges of doc_id, so ids of the whole set are in ascending doc_id order, shard by shard.

Defined cases: a null or empty text has the end id only; a null doc_id comes first; rows with one doc_id are ordered by
a hash of the text and each keeps its own place; an empty table has no chunk and reads back as no row.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fulluse.llm.common import Scratch, keyed, shown_id

MAGIC = b"IDP1"
BLOCK, TEXT_BYTES = 65_536, 1 << 22
TOGETHER, MARK = 64, "<|endoftext|>"
CHUNKS = (
    "shard int, chunk int, first_id long, n_ids int, first_row long, doc_ids array<long>, doc_n array<int>,"
    " payload binary"
)


def pack(ids: np.ndarray, planes: str = "bit", level: int = 3) -> bytes:
    """One chunk: magic, id width in bytes, plane kind, count, plane lengths, planes."""
    width = ids.dtype.itemsize
    data = np.ascontiguousarray(ids, ids.dtype.newbyteorder("<")).view(np.uint8).reshape(len(ids), width)
    rows = [np.ascontiguousarray(data[:, k]) for k in range(width)]
    if planes == "bit":
        rows = [np.packbits(r & np.uint8(1 << k), bitorder="little") for r in rows for k in range(8)]
    press = zstandard.ZstdCompressor(level=level)
    frames = [press.compress(r.tobytes()) for r in rows]
    head = struct.pack("<4sBBHI", MAGIC, width, planes == "bit", len(frames), len(ids))
    return head + struct.pack(f"<{len(frames)}I", *map(len, frames)) + b"".join(frames)


def unpack(payload: bytes) -> np.ndarray:
    magic, width, bit, count, n = struct.unpack_from("<4sBBHI", payload)
    if magic != MAGIC:
        raise ValueError("not a chunk of ids")
    lengths = struct.unpack_from(f"<{count}I", payload, 12)
    at, rows, unpress = 12 + 4 * count, [], zstandard.ZstdDecompressor()
    for length in lengths:
        rows.append(np.frombuffer(unpress.decompress(payload[at : at + length]), np.uint8))
        at += length
    data = np.zeros((n, width), np.uint8)
    for k, row in enumerate(rows):
        if bit:
            data[:, k // 8] |= np.unpackbits(row, count=n, bitorder="little") << np.uint8(k % 8)
        else:
            data[:, k] = row
    return data.reshape(-1).view(f"<u{width}")


_known: dict[str, bytes] = {}
#: Letters below U+0250 that no normal form changes, between ASCII marks which the pre-tokenizer keeps together.
PLAIN = re.compile(r"""([!"#$%&()*+,\-./:;=>?@[\\\]^`{|}~]*)([a-z\u00df-\u00f6\u00f8-\u00ff]+)([!"#$%&()*+,\-./:;=>?@[\\\]^`{|}~]*)""")


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: printable ones stand for themselves, all others
    follow from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(sorted({*range(256)} - {*shown}))}


def encoder(tokenizer_file: str, width: int, keep: int = 500_000):
    """An Arrow array of texts -> ids of all texts after one another, and where each text's ids start and end.

    Blanks and newlines always end a pre-token of this tokenizer and case is ignored, so each distinct run between them
    is encoded once in a batch, and a bounded table answers the repeats of later batches. A run of plain letters between
    marks is known by its parts, which are pre-tokens as they stand. Other runs take the whole tokenizer, many in one
    call; what may hold a special token is encoded by itself.
    """
    from tokenizers import Tokenizer

    tokenizer, kind = Tokenizer.from_file(tokenizer_file), f"<u{width}"
    mark, model, letters = tokenizer.token_to_id(MARK), tokenizer.model, byte_letters()
    packed = [k.to_bytes(width, "little") for k in range(tokenizer.get_vocab_size())]

    def part(word: str) -> bytes:
        """Ids of one pre-token that is not empty, kept if it is met again."""
        if (ids := _known.get(word)) is None:
            shown = word if word.isascii() else word.encode().decode("latin-1").translate(letters)
            ids = _known[word] = b"".join([packed[t.id] for t in model.tokenize(shown)])
        return ids

    def learn(words: list[str]) -> None:
        others = []
        for w in words:
            if "<|" in w:
                _known[w] = np.array(tokenizer.encode(w, add_special_tokens=False).ids, kind).tobytes()
            elif found := PLAIN.fullmatch(w):
                before, word, after = found.groups()
                ids = part(word)
                if before or after:
                    _known[w] = (part(before) if before else b"") + ids + (part(after) if after else b"")
            else:
                others.append(w)
        groups = [others[k : k + TOGETHER] for k in range(0, len(others), TOGETHER)]
        # A special token between runs shows in the ids where one ends.
        for group, e in zip(groups, tokenizer.encode_batch_fast([MARK.join(g) for g in groups], add_special_tokens=False), strict=True):
            ids = np.array(e.ids, kind)
            ends = [*np.flatnonzero(ids == mark).tolist(), len(ids)]
            raw, first = ids.tobytes(), 0
            for w, end in zip(group, ends, strict=True):
                _known[w] = raw[first * width : end * width]
                first = end + 1

    def encode(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        lowered = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
        split = pc.split_pattern(pc.replace_substring(lowered, "\n", " "), " ")
        runs = split.values.dictionary_encode()
        words = runs.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(_known) > keep:
            _known.clear()
        if new := [w for w in words if w not in _known]:
            learn(new)
        own = [_known[w] for w in words]
        # Each run's ids stand once in ``flat``; the batch is gathered from there.
        sizes = np.fromiter(map(len, own), np.int64, len(own)) // width
        flat, firsts, at = np.frombuffer(b"".join(own), kind), np.cumsum(sizes) - sizes, runs.indices.to_numpy()
        upto = np.concatenate(([0], np.cumsum(sizes[at])))
        ids = flat[np.repeat(firsts[at] - upto[:-1], sizes[at]) + np.arange(upto[-1])]
        return ids, upto[split.offsets.to_numpy()]

    return encode


def write(docs: DataFrame, scratch: Scratch, name: str, tokenizer_file: str, end_id: int = 1, block: int = BLOCK,
          planes: str = "bit", width: int = 2) -> DataFrame:
    """Encodes whole texts, end id after each, and writes the chunks; returns them as read back.

    ``width`` is the bytes an id takes; 2 serves vocabularies under 65,536 ids.
    """
    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from fulluse.llm.common import pieces

        encode, end = encoder(tokenizer_file, width), np.array([end_id], f"<u{width}").tobytes()
        shard, number, first_id, row = TaskContext.get().partitionId(), 0, 0, 0
        held, size, owners, first_row = [], 0, [], 0

        def flush() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), f"<u{width}")
            return pa.RecordBatch.from_pylist(
                [{
                    "shard": shard, "chunk": number, "first_id": first_id, "n_ids": len(ids), "first_row": first_row,
                    "doc_ids": [d for d, _ in owners], "doc_n": [n for _, n in owners], "payload": pack(ids, planes),
                }],
                pa.schema([
                    ("shard", pa.int32()), ("chunk", pa.int32()), ("first_id", pa.int64()), ("n_ids", pa.int32()),
                    ("first_row", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("doc_n", pa.list_(pa.int32())),
                    ("payload", pa.binary()),
                ]),
            )

        for whole in batches:
            for batch in pieces(whole, TEXT_BYTES):
                found, cuts = encode(batch.column("text"))
                for k, doc in enumerate(batch.column("doc_id").to_pylist()):
                    ids = found[cuts[k] : cuts[k + 1]].tobytes() + end
                    at = 0
                    while at < len(ids):
                        part = ids[at : at + (block - size) * width]
                        held.append(part)
                        owners.append((doc, len(part) // width))
                        size += len(part) // width
                        at += len(part)
                        if size == block:
                            yield flush()
                            number, first_id = number + 1, first_id + size
                            first_row = row if at < len(ids) else row + 1
                            held, size, owners = [], 0, []
                    row += 1
        if size:
            yield flush()

    placed = keyed(docs).repartitionByRange("doc_id", "tag").sortWithinPartitions("doc_id", "tag")
    return scratch.save(placed.select("doc_id", "text").mapInArrow(chunks, CHUNKS), name)


def joined_crc(first: int, second: int, length: int) -> int:
    """The crc32 of two byte strings after each other, of their crc32 and the second's length.

    crc32 is linear over GF(2): the first value is moved on by ``length`` zero bytes by squaring the one-bit step.
    """
    def times(matrix: list[int], vector: int) -> int:
        out, k = 0, 0
        while vector:
            if vector & 1:
                out ^= matrix[k]
            vector >>= 1
            k += 1
        return out

    step, bits = [0xEDB88320] + [1 << k for k in range(31)], 8 * length
    while bits:
        if bits & 1:
            first = times(step, first)
        bits >>= 1
        step = [times(step, x) for x in step]
    return first ^ second


def read(chunks: DataFrame) -> DataFrame:
    """doc_id, start (ids before it in the set), n_tokens, ids_crc32 of each document, from the chunks alone."""
    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("shard", "row", "doc_id", "at", "chunk", "n", "crc")}
            for c in batch.to_pylist():
                ids, at = unpack(c["payload"]).astype("<u4"), 0
                for k, (doc, n) in enumerate(zip(c["doc_ids"], c["doc_n"], strict=True)):
                    for name, value in (
                        ("shard", c["shard"]), ("row", c["first_row"] + k), ("doc_id", doc), ("at", c["first_id"] + at),
                        ("chunk", c["chunk"]), ("n", n), ("crc", zlib.crc32(ids[at : at + n].tobytes())),
                    ):
                        out[name].append(value)
                    at += n
            yield pa.RecordBatch.from_pydict(out, pa.schema([
                ("shard", pa.int32()), ("row", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int64()),
                ("chunk", pa.int32()), ("n", pa.int64()), ("crc", pa.int64()),
            ]))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crcs = []
            for found in batch.column("parts").to_pylist():
                crc = found[0]["crc"]
                for p in found[1:]:
                    crc = joined_crc(crc, p["crc"], 4 * p["n"])
                crcs.append(crc)
            yield batch.drop_columns(["parts"]).append_column("ids_crc32", pa.array(crcs, pa.int64()))

    # One row for each shard; each shard's ids start after those of the shards before it.
    totals = chunks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    base = totals.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("base"))
    spread = chunks.mapInArrow(parts, "shard int, row long, doc_id long, at long, chunk int, n long, crc long")
    found = spread.groupBy("shard", "row").agg(
        F.first("doc_id").alias("doc_id"), F.min("at").alias("at"), F.sum("n").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("chunk", "n", "crc"))).alias("parts"),
    )
    done = found.mapInArrow(whole, "shard int, row long, doc_id long, at long, n_tokens long, ids_crc32 long")
    return done.join(base, "shard").select(
        shown_id(), (F.col("at") + F.col("base")).alias("start"), "n_tokens", "ids_crc32"
    )
