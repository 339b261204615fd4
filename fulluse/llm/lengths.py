"""Exact histogram of encoded lengths, and what its suffix sums answer for every context limit.

Defined cases: null and empty texts have length 0 and count as documents; repeated rows count each; an empty table has
an empty histogram, whose totals are 0 and quantiles null.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fulluse.llm.bpe import load

STEP = 1024


def histogram(docs: DataFrame, rank_file: str) -> DataFrame:
    """n_tokens, n_documents: each task counts its own documents before the shuffle."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, seen = load(rank_file), Counter()
        for batch in batches:
            for text in batch.column("text"):
                seen[len(encoding.encode_ordinary(text.as_py() or ""))] += 1
        yield pa.RecordBatch.from_pydict(
            {"n_tokens": list(seen), "n": list(seen.values())},
            pa.schema([("n_tokens", pa.int64()), ("n", pa.int64())]),
        )

    text = docs.select(docs["text"].cast("string").alias("text"))
    return text.mapInArrow(counted, "n_tokens long, n long").groupBy("n_tokens").agg(F.sum("n").alias("n_documents"))


def suffix_sums(counts: DataFrame) -> DataFrame:
    """For each length L: documents and tokens of length L or more, and the tokens left when texts are cut at L.

    Summed within steps of lengths, then over steps, so that one task holds at most the step totals: one row for each
    1,024 tokens that the longest document has.
    """
    step = F.floor(F.col("n_tokens") / STEP)
    rows = counts.select("n_tokens", "n_documents", step.alias("step"))
    tokens = F.col("n_tokens") * F.col("n_documents")
    after = Window.orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, -1)
    steps = rows.groupBy("step").agg(F.sum("n_documents").alias("d"), F.sum(tokens).alias("t"))
    steps = steps.select(
        "step",
        F.coalesce(F.sum("d").over(after), F.lit(0)).alias("d_after"),
        F.coalesce(F.sum("t").over(after), F.lit(0)).alias("t_after"),
        F.sum("d").over(Window.partitionBy()).alias("d_all"),
        F.sum("t").over(Window.partitionBy()).alias("t_all"),
    )
    within = Window.partitionBy("step").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    own = rows.select(
        "step", "n_tokens", "n_documents", F.sum("n_documents").over(within).alias("d"), F.sum(tokens).over(within).alias("t")
    )
    at_least, long_tokens = F.col("d") + F.col("d_after"), F.col("t") + F.col("t_after")
    return own.join(steps, "step").select(
        "n_tokens", "n_documents",
        at_least.alias("documents_at_least"),
        long_tokens.alias("tokens_at_least"),
        (F.col("t_all") - long_tokens + F.col("n_tokens") * at_least).alias("tokens_when_cut"),
        "d_all", "t_all",
    )


def cut_total(table: DataFrame, limit: int) -> DataFrame:
    """tokens: what is left when every document is cut at ``limit``, for any limit, from the suffix sums."""
    above = F.col("n_tokens") > limit
    return table.agg(
        F.coalesce(
            F.sum(F.when(above, F.lit(limit) * F.col("n_documents")).otherwise(F.col("n_tokens") * F.col("n_documents"))),
            F.lit(0),
        ).alias("tokens")
    )


def quantile(table: DataFrame, q: float) -> DataFrame:
    """n_tokens: the smallest length that a share ``q`` of the documents do not exceed."""
    up_to = F.col("d_all") - F.col("documents_at_least") + F.col("n_documents")
    return table.filter(up_to >= F.lit(q) * F.col("d_all")).agg(F.min("n_tokens").alias("n_tokens"))
