"""Each operator against its contract, row by row."""

from __future__ import annotations

import functools
import hashlib
import random
import tracemalloc
from pathlib import Path
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fulluse.llm import bpe, exact_dedup, id_files, jaccard, lengths, line_dedup, suffixes
from fulluse.llm.common import Scratch, sifted, span_hashes, window_hashes
from tests.llm import brute

WORDS, RANKS = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.tiktoken"))


def by_id(df, *columns):
    rows = df.select("doc_id", *columns).collect()
    out = {r["doc_id"]: tuple(r[c] for c in columns) for r in rows}
    assert len(out) == len(rows)
    return out


@functools.cache
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORDS)


def word_ids(text):
    return tokenizer().encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("planes,block", [("bit", 65_536), ("byte", 50)])
def test_ids(docs, corpus, scratch, planes, block):
    chunks = id_files.write(docs, scratch, "ids", WORDS, block=block, planes=planes)
    sizes = {r["n_ids"] for r in chunks.collect()}
    assert max(sizes) <= block
    assert by_id(id_files.read(chunks), "start", "n_tokens", "ids_crc32") == brute.ids_file(corpus, word_ids)


@given(st.lists(st.integers(0, 65_535), max_size=300), st.sampled_from(["bit", "byte"]), st.sampled_from(["<u2", "<u4"]))
@settings(max_examples=60, deadline=None)
def test_planes_round_trip(ids, planes, kind):
    array = np.array(ids, kind)
    assert id_files.unpack(id_files.pack(array, planes)).tolist() == ids


@given(st.lists(st.text(alphabet="aB.*ÿ_ \n\t's1é\u0301İß日<|>\u3000Σ", max_size=40), min_size=1, max_size=8))
@settings(max_examples=150, deadline=None)
def test_runs_are_encoded_as_the_whole(texts):
    texts = [*texts, "x<|endoftext|>Y <|STARTOFTEXT|> z"]
    ids, cuts = id_files.encoder(WORDS, 2)(pa.array(texts, pa.string()))
    found = [ids[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    assert [np.frombuffer(f, "<u2").tolist() for f in found] == [word_ids(t) for t in texts]


def test_plain_runs_look_up_no_empty_parts(monkeypatch):
    """op1_id_files: a run of letters alone is one pre-token, its empty marks cost nothing."""
    monkeypatch.setattr(id_files, "_known", {})
    texts = ["alpha beta, alpha", "(gamma) beta"]
    ids, cuts = id_files.encoder(WORDS, 2)(pa.array(texts, pa.string()))
    assert "" not in id_files._known and {"alpha", "beta,", "beta", ",", "(gamma)"} <= set(id_files._known)
    assert [ids[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:], strict=True)] == [word_ids(t) for t in texts]


def test_eight_bytes_are_read_at_once():
    """op3_suffix_dedup: a character of eight bytes is one gather, whatever stands behind a string's end."""
    rng = np.random.default_rng(5)
    data = np.concatenate((rng.integers(0, 256, 3000).astype(np.uint8), np.zeros(8, np.uint8)))
    starts, lengths = rng.integers(0, 2900, 500), rng.integers(1, 100, 500)
    raw, gathers = data.tobytes(), []

    class Bytes(np.ndarray):
        def __getitem__(self, at):
            gathers.append(at)
            return np.ndarray.__getitem__(self, at)

    for depth in (0, 8, 24, 96):
        own = [int.from_bytes(raw[s + depth : s + min(depth + 8, n)].ljust(8, b"\0"), "big") if n > depth else 0 for s, n in zip(starts.tolist(), lengths.tolist(), strict=True)]
        assert suffixes.character(data, starts, lengths, depth).tolist() == own
    suffixes.character(data.view(Bytes), starts, lengths, 8)
    assert len(gathers) <= 1
    for width in (1, 16):
        at = np.arange(len(data) - width + 1)
        assert (window_hashes(data, width) == span_hashes(data, at, at + width)).all()


def test_keys_are_dealt_in_small_pieces(spark):
    """pipeline, jaccard_join: the memory of a task that deals keys does not follow the size of its batches."""
    class Rows:
        def mapInArrow(self, step, schema):
            raise Taken(step)

    class Taken(Exception):
        pass

    with pytest.raises(Taken) as caught:
        jaccard.shared_keys(Rows(), 8)
    rng = np.random.default_rng(3)
    keys = [rng.integers(0, 1 << 62, 200).astype("<i8").tobytes() for _ in range(10_000)]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(10_000), pa.int64()), "keys": pa.array(keys, pa.binary())})
    del keys
    tracemalloc.start()
    for out in caught.value.args[0](iter([batch])):
        assert out.num_rows
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 48 << 20, peak


def test_rows_are_hashed_in_small_pieces():
    """pipeline, jaccard_join: the memory of a task does not follow the size of its batches."""
    class Rows:
        def select(self, *columns):
            return self

        def mapInArrow(self, step, schema):
            raise Taken(step)

    class Taken(Exception):
        pass

    with pytest.raises(Taken) as caught:
        jaccard.frequencies(Rows(), 5, 80, 100)
    texts = [" ".join(f"w{k * j}" for j in range(400)) for k in range(2000)]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})
    tracemalloc.start()
    list(caught.value.args[0](iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 << 20, peak


def test_passages_hold_no_rows_together(spark, scratch):
    """pipeline, jaccard_join: rows that share a passage and little else are no cluster; near copies among them are."""
    rng = np.random.default_rng(11)
    passage = " ".join(f"p{k}" for k in range(120))
    texts = [passage + "".join(f" w{x}" for x in rng.integers(0, 1 << 40, 180)) for _ in range(200)]
    texts += [f"{t} end" for t in texts[:5]]
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    found = by_id(jaccard.join(docs, scratch), "component_id")
    assert {d: c for d, (c,) in found.items()} == {d: d - 200 if d >= 200 else d for d in range(205)}
    members = spark.read.parquet(f"{scratch.folder}/clusters-members-*")
    assert members.count() < 80


@pytest.mark.parametrize("num,den", [(80, 100), (90, 100), (50, 100)])
def test_chosen_keys_meet(num, den):
    """Two rows over the threshold keep a common key, whatever other rows make frequent; a repeated doc_id keeps all."""
    rng = np.random.default_rng(num)
    rows = [np.unique(rng.integers(0, 1 << 62, n, dtype=np.uint64)) for n in (1, 2, 7, 40, 300)]
    pairs = []
    for row in rows:
        most = len(row) * (den - num) // (den + num)
        other = np.unique(np.concatenate((row[most:], rng.integers(0, 1 << 62, most, dtype=np.uint64))))
        shared = len(np.intersect1d(row, other))
        assert shared * den >= num * (len(row) + len(other) - shared)
        pairs += [row, other]
    # Others share parts of these rows, so that many of their keys are frequent.
    rows = pairs + [np.unique(np.concatenate((r[: len(r) * k // 8], rng.integers(0, 1 << 62, 50, dtype=np.uint64)))) for r in pairs for k in range(1, 8)]
    made = [jaccard.counted_keys(r, num, den) for r in rows]
    key = np.concatenate([k for k, _ in made])
    doc = np.repeat(np.arange(len(rows), dtype=np.uint64), [len(k) for k, _ in made])
    _, place, n = np.unique(key, return_inverse=True, return_counts=True)
    some = n[place] > 1
    shared = np.stack((doc[some], key[some], n[place][some].astype(np.uint64)))
    heads = np.stack((np.arange(len(rows), dtype=np.uint64), np.array([s for _, s in made], np.uint64)))
    docs, keys = jaccard.kept_keys(heads, shared)
    for a in range(0, len(pairs), 2):
        assert len(np.intersect1d(keys[docs == a], keys[docs == a + 1]))
    assert num == 50 or len(keys) < len(np.unique(shared[:2], axis=1).T)
    again = jaccard.kept_keys(np.concatenate((heads, heads), axis=1), shared)
    assert len(again[1]) == len(np.unique(shared[:2], axis=1).T)


@given(st.binary(max_size=50), st.binary(max_size=50))
def test_joined_crc(a, b):
    import zlib

    assert id_files.joined_crc(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


@pytest.mark.parametrize("chunk,overlap", [(32_768, 512), (300, 20), (40, 5)])
def test_byte_bpe(docs, corpus, chunk, overlap):
    found = by_id(bpe.encode(docs, RANKS, chunk=chunk, overlap=overlap), "n_tokens", "ids_sha256", "decoded_sha256")
    encoding = bpe.load(RANKS)
    for d, t in corpus:
        ids = encoding.encode_ordinary(t or "")
        assert found[d] == (len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(t or ""))


@given(st.text(alphabet="ab1 \n'tslv.é　", max_size=200), st.integers(9, 40), st.integers(0, 30))
@settings(max_examples=300, deadline=None)
def test_stitch(text, chunk, overlap):
    cut = [text[x : x + chunk + overlap] for x in range(0, len(text), chunk)]
    scans = [bpe.encode_chunk(t, RANKS) for t in cut]
    assert bpe.stitch(cut, scans, chunk, RANKS) == bpe.load(RANKS).encode_ordinary(text)


@pytest.mark.parametrize("length,hot", [(100, 50_000), (30, 2)])
def test_suffixes(docs, corpus, scratch, length, hot):
    found = suffixes.digests(suffixes.remove(docs, scratch, length, hot_runs=hot))
    want = brute.repeated_bytes(corpus, length)
    assert by_id(found, "n_bytes", "n_removed", "n_spans", "kept_sha256") == want
    assert sum(w[1] for w in want.values()) > 5000


@given(st.lists(st.text(alphabet="ab", min_size=40, max_size=44), min_size=1, max_size=30), st.integers(1, 2))
@settings(max_examples=100, deadline=None)
def test_equal_classes(strings, groups):
    strings = [("a" * 30 + s[:14]) for s in strings]
    raw = [s.encode() for s in strings]
    lengths_ = np.array([len(r) for r in raw])
    starts = np.cumsum(lengths_) - lengths_
    of = np.arange(len(raw)) % groups
    data = np.concatenate((np.frombuffer(b"".join(raw), np.uint8), np.zeros(8, np.uint8)))
    found = suffixes.equal_classes(data, starts, lengths_, of).tolist()
    for a in range(len(raw)):
        for b in range(len(raw)):
            assert (found[a] == found[b]) == (raw[a] == raw[b] and of[a] == of[b])


@pytest.mark.parametrize("width,num,den,block,anchors", [(3, 90, 100, 256, 16), (5, 80, 100, 3, 1), (2, 60, 100, 4, 5)])
def test_jaccard(docs, corpus, scratch, monkeypatch, width, num, den, block, anchors):
    monkeypatch.setattr(jaccard, "ANCHORS", anchors)
    found = by_id(jaccard.join(docs, scratch, width, num, den, block=block), "n_shingles", "component_id")
    assert found == brute.jaccard(corpus, width, num, den)
    kept = jaccard.kept_rows(docs, scratch, width, num, den)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(d for d, (_, c) in found.items() if c == d)


def test_a_passage_of_many_documents_holds_no_cluster_together(spark, scratch):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(4000)]
    passage = " ".join(rng.choice(words) for _ in range(60))
    rows = [(k, passage + " " + " ".join(rng.choice(words) for _ in range(80))) for k in range(300)]
    rows += [(1000 + k, text + " one word more") for k, text in rows[:40]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = by_id(jaccard.join(docs, scratch, block=32), "component_id")
    assert {d: c for d, (c,) in found.items()} == {d: d % 1000 for d, _ in rows}
    folders = sorted(Path(unquote(urlparse(scratch.folder).path)).iterdir())
    held, left = (next(f for f in folders if f.name.startswith(f"{name}-")) for name in ("texts", "wide"))
    assert spark.read.parquet(str(held)).filter("rows > 32").count() > 250
    assert spark.read.parquet(str(left)).filter("rows > 32").count() == 0



def test_lines(docs, corpus, scratch):
    found = line_dedup.dedup(docs, scratch)
    rows = {d: (n, k, brute.sha(t)) for d, (n, k, t) in by_id(found, "n_lines", "n_dropped", "text").items()}
    assert rows == brute.lines(corpus, 40, 5)
    assert sum(r[1] for r in rows.values()) > 5


def test_exact(docs, corpus, scratch):
    found = by_id(exact_dedup.refine(docs, scratch, digest_all=True), "keep_id", "group_size", "kept", "text_sha256")
    assert found == brute.exact(corpus)
    kept = exact_dedup.kept_rows(docs, scratch)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(d for d, r in found.items() if r[2])
    plan = exact_dedup.refine(docs, scratch)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_lengths(docs, corpus):
    n = sorted(len(bpe.load(RANKS).encode_ordinary(t or "")) for _, t in corpus)
    table = lengths.suffix_sums(lengths.histogram(docs, RANKS))
    rows = {r["n_tokens"]: r for r in table.collect()}
    assert sorted(rows) == sorted(set(n))
    for limit, r in rows.items():
        assert r["n_documents"] == n.count(limit)
        assert r["documents_at_least"] == sum(x >= limit for x in n)
        assert r["tokens_at_least"] == sum(x for x in n if x >= limit)
        assert r["tokens_when_cut"] == sum(min(x, limit) for x in n)
    for limit in (0, 7, 100, 1500, 10**9):
        assert lengths.cut_total(table, limit).first()["tokens"] == sum(min(x, limit) for x in n)
    for q in (0.01, 0.5, 0.9, 1.0):
        want = next(x for k, x in enumerate(n) if k + 1 >= q * len(n))
        assert lengths.quantile(table, q).first()["n_tokens"] == want


ROWS = [(7, "One two three four five six seven. " * 6), (None, None), (None, "Another text of several words here"), (9, "")]


def test_repeated_rows_and_nulls(spark, scratch):
    """Rows twice, and a doc_id with two texts."""
    docs = spark.createDataFrame([*ROWS, *ROWS, (7, "something else")], "doc_id long, text string")
    n = docs.count()
    chunks = id_files.write(docs, scratch, "twice", WORDS)
    starts = sorted((r["start"], r["n_tokens"]) for r in id_files.read(chunks).collect())
    assert len(starts) == n and all(a + k == b for (a, k), (b, _) in zip(starts, starts[1:], strict=False))
    assert bpe.encode(docs, RANKS, chunk=20, overlap=4).count() == n
    cut = suffixes.remove(docs, scratch).collect()
    # A row given twice is one document: it loses what it repeats itself, not what its twin has.
    assert len(cut) == n and len({(r["doc_id"], r["n_bytes"], r["n_removed"]) for r in cut}) == 5
    assert line_dedup.dedup(docs, scratch).count() == n
    found = jaccard.join(docs, scratch).collect()
    assert len(found) == n and all(r["component_id"] == r["doc_id"] for r in found)
    rows = exact_dedup.refine(docs, scratch).collect()
    assert len(rows) == n and sum(r["kept"] for r in rows) == 4
    assert exact_dedup.kept_rows(docs, scratch).count() == 4
    assert jaccard.kept_rows(docs, scratch).count() == len({(d, t or "") for d, t in [*ROWS, (7, "something else")]})


def test_empty_tables(spark, scratch):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert id_files.read(id_files.write(docs, scratch, "none", WORDS)).count() == 0
    assert bpe.encode(docs, RANKS).count() == 0
    assert suffixes.remove(docs, scratch).count() == 0
    assert jaccard.join(docs, scratch).count() == 0
    assert line_dedup.dedup(docs, scratch).count() == 0
    assert exact_dedup.refine(docs, scratch).count() == 0
    table = lengths.suffix_sums(lengths.histogram(docs, RANKS))
    assert table.count() == 0 and lengths.cut_total(table, 5).first()["tokens"] == 0
    assert lengths.quantile(table, 0.5).first()["n_tokens"] is None


def test_decode(docs):
    for r in bpe.encode(docs, RANKS, with_ids=True).collect():
        assert hashlib.sha256(bpe.decode(r["ids"], RANKS)).hexdigest() == r["decoded_sha256"]


def test_components(spark):
    import random

    rng = random.Random(3)
    edges = [(k, k + 1) for k in range(100, 160)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(40)]
    from fulluse.llm.common import components

    found = components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark), "c").collect()
    root = {r["node"]: r["root"] for r in found}
    assert len(root) == len(found)
    parent = {x: x for e in edges for x in e}
    for _ in parent:
        for a, b in edges:
            parent[a] = parent[b] = min(parent[a], parent[b])
    assert all(root.get(k, k) == p for k, p in parent.items())


def test_pre_tokens_are_encoded_once(monkeypatch):
    """A pre-token that is known is looked up, and a text of one chunk is not searched for common boundaries."""
    known, asked = bpe.Known(RANKS), []
    encode = known.encode
    known.encode = lambda piece: asked.append(piece) or encode(piece)
    text = "it's one, one  one 12 12\n" * 3
    scan = bpe.encode_chunk(text, RANKS, known)
    bpe.encode_chunk(text, RANKS, known)
    assert sorted(asked) == sorted(set(bpe._pattern().findall(text)))
    monkeypatch.setattr(bpe.np, "searchsorted", None)
    assert bpe.stitch([text], [scan], bpe.CHUNK, RANKS) == bpe.load(RANKS).encode_ordinary(text)


def test_sifted_rows(spark):
    """No row with a partner is lost, and few others pass."""
    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), (F.col("id") * 3).alias("tag"), F.lit("x").alias("text"))
    may, none = sifted(rows, rows.filter("doc_id % 400 = 7"), ["doc_id", "tag"])
    assert {r["doc_id"] for r in may.filter("doc_id % 400 = 7").collect()} == set(range(7, 20_000, 400))
    assert may.count() < 100 and may.count() + none.count() == 20_000
    assert none.join(rows.filter("doc_id % 400 = 7"), ["doc_id", "tag"]).count() == 0


def test_texts_outside_clusters_do_not_travel(spark, scratch, monkeypatch):
    """Only documents that share a key, and few others, meet their cluster by an exchange."""
    found, sieve = [], jaccard.sifted
    monkeypatch.setattr(jaccard, "sifted", lambda rows, *more: found.append(sieve(rows, *more)) or found[-1])
    text = F.concat_ws(" ", *(F.concat(F.lit(f"w{k}-"), "doc_id") for k in range(12)))
    docs = spark.range(300).select(F.when(F.col("id") > 289, 290).otherwise(F.col("id")).alias("doc_id")).withColumn("text", text)
    near = docs.filter("doc_id < 5").select((F.col("doc_id") + 1000).alias("doc_id"), F.concat("text", F.lit(" more")).alias("text"))
    kept = jaccard.kept_rows(docs.union(near), scratch, width=3, num=80, den=100)
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(291))
    (inside, _), (doubtful, clear) = found
    assert 10 <= inside.count() < 40 and 15 <= doubtful.count() < 40 and clear.count() > 260
