"""Byte-level BPE by overlapping chunks, and decoding by concatenation of bytes.

A text of up to ``chunk`` characters is one chunk, scanned and stitched where it is read. A longer one is cut into chunks
that overlap, which are dealt over all tasks, pre-tokenised and encoded apart. Whether a pre-token starts at a place depends only on the text from there on, so once the scan of a
chunk and that of the next one share a boundary in the overlap, both go on alike. The chunks are cut there. Where an
overlap has no common boundary (one pre-token longer than it), the earlier scan goes on into the next chunk until they
meet.

Defined cases: null and empty texts have no ids; a text of any length is encoded whole; repeated rows are encoded each;
an empty table gives an empty result; other columns are left behind.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fulluse.llm.common import keyed, pieces, shown_id

CHUNK, OVERLAP, KNOWN = 32_768, 512, 200_000
#: A scan of a cut text is not trusted this near its end: the longest fixed pre-token of the pattern, with room.
MARGIN = 8
RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, ids binary"


@functools.cache
def load(rank_file: str):
    import public_tokenizers
    import tiktoken

    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@functools.cache
def _pattern():
    import public_tokenizers
    import regex

    return regex.compile(public_tokenizers.PATTERN)


@functools.cache
def _written(n: int) -> list[str]:
    return [f"{i} " for i in range(n)]


def digest(ids: list[int]) -> str:
    text = _written(1 << 16)
    return hashlib.sha256("".join(map(text.__getitem__, ids))[:-1].encode()).hexdigest()


class Known(dict):
    """The ids of pre-tokens, made where one is first met."""

    def __init__(self, rank_file: str):
        self.encode = load(rank_file).encode_ordinary

    def __missing__(self, piece: str) -> list[int]:
        own = self[piece] = self.encode(piece)
        return own


def encode_chunk(text: str, rank_file: str, known: Known | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ends of the pre-tokens in the chunk, ids up to each end, ids. ``known`` keeps the ids of pre-tokens, some at most."""
    known = Known(rank_file) if known is None else known
    if len(known) > KNOWN:
        known.clear()
    found = _pattern().findall(text)  # every character is in one of them
    own = list(map(known.__getitem__, found))
    places, upto = (np.cumsum(np.fromiter(map(len, x), "<i4", len(x)), dtype="<i4") for x in (found, own))
    return places, upto, np.array(list(chain.from_iterable(own)), "<u4")


def stitch(texts: list[str], scans: list[tuple[np.ndarray, np.ndarray, np.ndarray]], chunk: int, rank_file: str) -> list[int]:
    """Ids of the whole text, of its chunks in order (chunk k starts at k * chunk) and their scans."""
    if len(scans) == 1:
        return scans[0][2].tolist()
    whole = "".join([t[:chunk] for t in texts[:-1]] + texts[-1:])
    out: list[int] = []
    at = 0  # a true boundary; the ids of all text before it are out
    for k, (places, upto, ids) in enumerate(scans):
        last = k + 1 == len(scans)
        own, counts = np.concatenate(([0], places)) + k * chunk, np.concatenate(([0], upto))
        limit = k * chunk + len(texts[k]) - (0 if last else MARGIN)
        begin = int(np.searchsorted(own, at))
        while at <= limit and at < len(whole) and (begin == len(own) or own[begin] != at):
            end = _pattern().match(whole, at).end()  # no common boundary yet: the true scan goes on
            out += load(rank_file).encode_ordinary(whole[at:end])
            at = end
            begin = int(np.searchsorted(own, at))
        if at > limit or at == len(whole):
            continue
        stop = int(np.searchsorted(own, limit, "right")) - 1
        if not last:
            following = np.concatenate(([0], scans[k + 1][0])) + (k + 1) * chunk
            common = np.intersect1d(own[begin : stop + 1], following)
            stop = int(np.searchsorted(own, common[0])) if len(common) else stop
        out += ids[counts[begin] : counts[stop]].tolist()
        at = int(own[stop])
    return out


def encode(docs: DataFrame, rank_file: str, with_ids: bool = False, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each row; with_ids adds ids as packed little-endian 32-bit numbers.

    Chunks of long texts are dealt over all tasks; only the ids and the text of one document come together again.
    """
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()),
        ("ids", pa.binary()),
    ])

    def result(rows: list[tuple[int, list[int]]]) -> dict[str, list]:
        encoding = load(rank_file)
        return {
            "doc_id": [d for d, _ in rows],
            "n_tokens": [len(ids) for _, ids in rows],
            "ids_sha256": [digest(ids) for _, ids in rows],
            "decoded_sha256": [hashlib.sha256(encoding.decode_bytes(ids)).hexdigest() for _, ids in rows],
            "ids": [np.array(ids, "<u4").tobytes() if with_ids else None for _, ids in rows],
        }

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known(rank_file)
        for whole in batches:
            for batch in pieces(whole):
                rows = [
                    (d, stitch([t], [encode_chunk(t, rank_file, known)], chunk, rank_file))
                    for d, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True)
                ]
                yield pa.RecordBatch.from_pydict(result(rows), schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, g, t in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "tag", "text")), strict=True):
                at = range(0, len(t), chunk)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": [d] * len(at), "tag": [g] * len(at), "i": list(range(len(at))),
                    "text": [t[x : x + chunk + overlap] for x in at],
                }, pa.schema([("doc_id", pa.int64()), ("tag", pa.int64()), ("i", pa.int32()), ("text", pa.string())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known(rank_file)
        for whole in batches:
            for batch in pieces(whole):
                found = [[x.tobytes() for x in encode_chunk(t, rank_file, known)] for t in batch.column("text").to_pylist()]
                for name, values in zip(("places", "upto", "ids"), zip(*found, strict=True), strict=True):
                    batch = batch.append_column(name, pa.array(values, pa.binary()))
                yield batch

    def meet(table: pa.Table) -> pa.Table:
        rows = table.sort_by("i").to_pylist()
        copies = sum(r["i"] == 0 for r in rows)
        rows = rows[::copies]
        scans = [tuple(np.frombuffer(r[c], t) for c, t in (("places", "<i4"), ("upto", "<i4"), ("ids", "<u4"))) for r in rows]
        ids = stitch([r["text"] for r in rows], scans, chunk, rank_file)
        return pa.Table.from_pydict(result([(rows[0]["doc_id"], ids)] * copies), schema)

    rows = keyed(docs)
    long = F.char_length("text") > chunk
    chunks = rows.filter(long).mapInArrow(cut, "doc_id long, tag long, i int, text string")
    scanned = chunks.repartition("doc_id", "tag", "i").mapInArrow(
        scan, "doc_id long, tag long, i int, text string, places binary, upto binary, ids binary"
    )
    whole = scanned.groupBy("doc_id", "tag").applyInArrow(meet, RESULT)
    done = rows.filter(~long).select("doc_id", "text").mapInArrow(short, RESULT).union(whole)
    shown = done.select(shown_id(), "n_tokens", "ids_sha256", "decoded_sha256", "ids")
    return shown if with_ids else shown.drop("ids")


def decode(ids: bytes, rank_file: str) -> bytes:
    """The bytes that packed ids stand for: those of each id after one another."""
    return load(rank_file).decode_bytes(np.frombuffer(ids, "<u4").tolist())
