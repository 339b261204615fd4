"""The corpus pipeline against its stages row by row, on a small folder."""

from __future__ import annotations

import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from fulluse.llm import exact_dedup, jaccard
from tests.llm import brute


def folder_of(spark, path, docs, items, labels=()):
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def holds(text, item):
    words, run = text.split(), item.split()
    return any(words[k : k + len(run)] == run for k in range(len(words) - len(run) + 1))


def test_pipeline(spark, docs, corpus, tmp_path):
    """Without labels all quality is kept; of copies the largest doc_id stays, of near copies the smallest; leaks go."""
    import base64

    import public_tokenizers

    leak = " ".join(dict(corpus)[33].split()[3:40])
    odd = docs.withColumns({"_id": F.lit("x"), "_own": F.lit(1), "_tag": F.col("doc_id"), "row": F.lit(None).cast("int"), "id": F.lit(2.5)})
    found = corpus_pipeline.run(spark, folder_of(spark, tmp_path, odd, [(1, leak), (2, None)])).collect()
    exact = brute.exact(corpus)
    rows = [(d, t) for d, t in corpus if exact[d][2]]
    near = brute.jaccard(rows, 5, 80, 100)
    rows = [(d, t or "") for d, t in rows if near[d][1] == d and not holds(t or "", leak)]
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {d: (len(encoding.encode_ordinary(t)), brute.sha(t)) for d, t in rows}
    assert 0 < len(want) < len(corpus)
    assert {r["doc_id"]: (r["n_tokens"], r["decoded_sha256"]) for r in found} == want and len(found) == len(want)


def test_pipeline_of_nothing(spark, docs, tmp_path):
    found = corpus_pipeline.run(spark, folder_of(spark, tmp_path, docs.limit(0), [(1, "an item of some words that nobody has")]))
    assert found.count() == 0


def test_stages_keep_columns_whatever_their_names(spark, scratch):
    """Copies of one doc_id, other texts under one doc_id, null ids, and names that the operators use inside."""
    rows = [(1, "a b c d e f g", "x"), (1, "a b c d e f g", "y"), (1, "other words under the same id here", "z"), (2, "A B c d e f g", "u"),
            (None, "a b c d e f g", "v"), (None, None, "w"), (3, "", "t"), (4, "alone", "s")]
    names = ("id", "sha", "_id", "_own", "_tag", "tag", "copies", "row")
    table = spark.createDataFrame([(d, t, *[m] * len(names)) for d, t, m in rows], "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    kept = exact_dedup.kept_rows(table, scratch)
    assert kept.columns == table.columns
    # Equal texts of the ids null, 1 and 2: the row of 2 stays; the empty ones: the row of 3.
    assert sorted(r["_tag"] for r in kept.collect()) == ["s", "t", "u", "z"]
    found = exact_dedup.refine(table, scratch).collect()
    assert sum(r["kept"] for r in found) == 4 and len(found) == len(rows)
    kept = jaccard.kept_rows(table, scratch)
    assert kept.columns == table.columns
    texts = sorted(r["text"] or "" for r in kept.collect())
    assert texts == ["", "", "a b c d e f g", "alone", "other words under the same id here"]
