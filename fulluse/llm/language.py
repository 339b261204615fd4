"""Language of pages and documents: evidence of text, declared language, address suffix and host, fused by Bayes' rule.

* Text: a naive Bayes model of byte trigrams, fitted on whole texts of a bounded number of labelled documents
  (``per_language`` for each language, chosen by a hash of doc_id). Its log likelihoods are tempered, because the
  trigrams of one text depend on each other.
* Declared language and suffix: likelihoods from tables of soft counts, summed over all rows with add-one smoothing.
* Host: a prior from soft counts of all rows, smoothed down the levels all rows, domain, host: each level adds ``kappa``
  rows of the level above. A host with few rows has its domain's prior, and a host with none the general one.

Soft counts are partial sums before the shuffle, so a host with a third of all rows is a few rows per task.

Defined cases: null and empty texts have no text evidence; a null, empty or unknown declared language, suffix or host is
a value of its own; rows repeat as they are; without any labelled document the result is null languages.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fulluse.llm.common import Scratch, pieces

BUCKETS, TEMPER, LEAST = 1 << 15, 0.05, 1e-9


def trigrams(text: bytes) -> np.ndarray:
    """A bucket for each run of three bytes of the text, A-Z in lower case, with a blank at both ends."""
    b = np.frombuffer(b" " + text.lower() + b" ", np.uint8).astype(np.uint32)
    return ((b[:-2] * np.uint32(0x9E3779B1) ^ b[1:-1] * np.uint32(0x85EBCA6B) ^ b[2:] * np.uint32(0xC2B2AE35)) >> 17) % BUCKETS


class Model:
    """Log likelihoods of trigram buckets, one row a language."""

    def __init__(self, languages: list[str], logs: np.ndarray):
        self.languages, self.logs = languages, logs.astype(np.float32)

    def scores(self, text: str) -> list[float]:
        if not text:
            return [0.0] * len(self.languages)
        found = np.bincount(trigrams(text.encode()), minlength=BUCKETS)
        at = np.flatnonzero(found)
        return (TEMPER * (self.logs[:, at] @ found[at])).tolist()


def fit(labelled: DataFrame, per_language: int = 1000) -> Model:
    """labelled: doc_id, text, lang. Counts of the chosen texts are summed by Spark; the driver gets one row for each
    language and bucket."""
    from pyspark.sql import Window

    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = labelled.filter("lang is not null and text is not null").select("doc_id", "text", "lang")
    chosen = chosen.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= per_language)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
                sums[lang] += np.bincount(trigrams(text.encode()), minlength=BUCKETS)
        for lang, found in sums.items():
            at = np.flatnonzero(found)
            yield pa.RecordBatch.from_pydict({"lang": [lang] * len(at), "bucket": at, "n": found[at]})

    counted = chosen.select("lang", "text").mapInArrow(count, "lang string, bucket long, n long")
    rows = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(rows["lang"].unique())
    table = np.full((len(languages), BUCKETS), 0.1)
    for k, lang in enumerate(languages):
        own = rows[rows["lang"] == lang]
        table[k, own["bucket"].to_numpy(int)] += own["n"].to_numpy(float)
    return Model(languages, np.log(table / table.sum(1, keepdims=True)) if languages else table)


def from_pages(pages: DataFrame) -> DataFrame:
    """id, declared, suffix, domain, host, text of pages (page_id, url, html)."""
    url, html = F.coalesce("url", F.lit("")), F.coalesce("html", F.lit(""))
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", 1))
    parts = F.split(host, r"\.")
    text = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    return pages.select(
        F.col("page_id").cast("long").alias("id"),
        F.lower(F.regexp_extract(html, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]+)", 1)).alias("declared"),
        F.element_at(parts, -1).alias("suffix"),
        F.when(F.size(parts) > 2, F.concat_ws(".", F.slice(parts, -3, 3))).otherwise(host).alias("domain"),
        host.alias("host"),
        text.alias("text"),
    )


def from_documents(docs: DataFrame) -> DataFrame:
    """The same of documents: their source stands for the host; nothing is declared and there is no address."""
    source = F.coalesce(docs["source"].cast("string"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("id"), F.lit("").alias("declared"), F.lit("").alias("suffix"),
        F.lit("").alias("domain"), source.alias("host"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def identify(rows: DataFrame, model: Model, scratch: Scratch, name: str, kappa: float = 20.0) -> DataFrame:
    """id, lang, confidence, text_lang: fused language with its posterior, and what the text alone says."""
    languages = model.languages
    if not languages:
        return rows.select("id", F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("confidence"),
                           F.lit(None).cast("string").alias("text_lang"))
    size = len(languages)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole):
                found = [model.scores(t or "") for t in batch.column("text").to_pylist()]
                yield batch.drop_columns(["text"]).append_column("ll", pa.array(found, pa.list_(pa.float64())))

    fields = "id long, declared string, suffix string, domain string, host string, ll array<double>"
    scored = scratch.save(rows.mapInArrow(score, fields), f"{name}-scored")

    def softmax(logs: Column, of: DataFrame) -> DataFrame:
        out = of.withColumn("_top", F.array_max(logs)).withColumn("_e", F.transform(logs, lambda x: F.exp(x - F.col("_top"))))
        total = F.aggregate("_e", F.lit(0.0), lambda a, x: a + x)
        return out.withColumn("post", F.transform("_e", lambda x: x / total)).drop("_top", "_e")

    soft = softmax(F.col("ll"), scored)
    sums = [F.sum(F.when(F.size("ll") > 0, F.col("post")[k])).alias(f"s{k}") for k in range(size)]
    each = [F.col(f"s{k}") for k in range(size)]
    # One row of sums for each language reaches the driver.
    every = soft.agg(*sums).first()
    weight = sum(every[k] or 0.0 for k in range(size))
    general = [(every[k] or 0.0) / weight if weight else 1.0 / size for k in range(size)]

    def log_share(top: Column, bottom: Column) -> Column:
        return F.log(F.greatest(top / bottom, F.lit(LEAST)))

    def evidence(column: str, alias: str) -> DataFrame:
        """log P(value | language), add-one smoothed over the column's values."""
        counts = soft.groupBy(column).agg(*sums)
        totals = counts.agg(*[F.sum(c) for c in each], F.count(F.lit(1))).first()
        below = [float((totals[k] or 0.0) + totals[size]) for k in range(size)]
        return counts.select(column, F.array(*[log_share(c + 1.0, F.lit(below[k])) for k, c in enumerate(each)]).alias(alias))

    def row_sum(values: list[Column]) -> Column:
        return sum(values[1:], values[0])

    by_domain = soft.groupBy("domain").agg(*sums).select(
        "domain", F.array(*[(c + kappa * general[k]) / (row_sum(each) + kappa) for k, c in enumerate(each)]).alias("p1")
    )
    by_host = soft.groupBy("domain", "host").agg(*sums).join(by_domain, "domain").select(
        "domain", "host",
        F.array(*[F.log(F.greatest((c + kappa * F.col("p1")[k]) / (row_sum(each) + kappa), F.lit(LEAST))) for k, c in enumerate(each)]).alias("prior"),
    )
    # The counts are one row for each value; written, Spark sees how small they are.
    prior = scratch.save(by_host, f"{name}-hosts")
    declared = scratch.save(evidence("declared", "d"), f"{name}-declared")
    suffix = scratch.save(evidence("suffix", "x"), f"{name}-suffix")
    joined = scored.join(prior, ["domain", "host"]).join(declared, "declared").join(suffix, "suffix")
    fused = F.array(*[F.col("ll")[k] + F.col("prior")[k] + F.col("d")[k] + F.col("x")[k] for k in range(size)])
    final = softmax(fused, joined)
    names = F.array(*[F.lit(x) for x in languages])
    best = F.array_position("post", F.array_max("post")).cast("int")
    return final.select(
        "id", F.element_at(names, best).alias("lang"), F.array_max("post").alias("confidence"),
        F.when(F.array_max("ll") > F.array_min("ll"), F.element_at(names, F.array_position("ll", F.array_max("ll")).cast("int"))).alias("text_lang"),
    )
