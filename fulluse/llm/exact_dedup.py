"""Exact duplicates by progressive refinement: length, then a hash of the beginning, then the hash of the whole text.

Lengths and hashes of beginnings of all rows are counted with partial sums. Only rows whose (length, beginning) another
row has too are hashed whole; all others are alone in their group. Texts are equal when they are identical after A-Z
are lower-cased. DataFrame functions only.

Defined cases: null counts as the empty text; a null doc_id comes before all others; rows that repeat both doc_id and
text count each in group_size, and of those with the largest doc_id one is kept; different texts under one doc_id are
apart; a text of any length is compared whole; an empty table gives no row; ``kept_rows`` returns all columns whatever
their names, ``refine`` only its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fulluse.llm.common import NO_ID, Scratch, lower_ascii, shown_id

PREFIX = 64


def refine(docs: DataFrame, scratch: Scratch, digest_all: bool = False, prefix: int = PREFIX) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row for each row.

    text_sha256 is the hash of the whole normalised text where the refinement had to read it, else null;
    ``digest_all`` states it for every row.
    """
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = docs.select(F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID)).alias("doc_id"), text.alias("text"))
    rows = rows.select(
        "doc_id", "text", F.octet_length("text").alias("n"),
        F.xxhash64(lower_ascii(F.substring("text", 1, prefix))).alias("p"),
    )
    lengths = rows.groupBy("n").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    lengths = scratch.save(lengths.select("n"), "lengths")
    # Beginnings are hashed only where the length is shared; both counts are partial before the shuffle.
    pairs = rows.join(lengths, "n", "left_semi").groupBy("n", "p").agg(F.count(F.lit(1)).alias("rows"))
    survivors = scratch.save(pairs.filter("rows > 1").select("n", "p", F.lit(True).alias("more")), "survivors")
    sha = F.sha2(lower_ascii(F.col("text")), 256)
    read = rows.join(survivors, ["n", "p"], "left").select(
        "doc_id", "n", "p",
        F.when(F.col("more"), sha).alias("full"),
        *([sha.alias("text_sha256")] if digest_all else []),
    )
    if not digest_all:
        read = read.withColumn("text_sha256", F.col("full"))
    # A row that is alone keeps itself. Equal rows of one doc_id are one row with a count until the end.
    read = scratch.save(read.groupBy("doc_id", "n", "p", "full", "text_sha256").agg(F.count(F.lit(1)).alias("rows")), "read")
    alone, rest = read.filter("full is null"), read.filter("full is not null")
    groups = rest.groupBy("full").agg(F.max("doc_id").alias("keep_id"), F.sum("rows").alias("group_size"))
    found = rest.join(groups, "full").select("doc_id", "keep_id", "group_size", "rows", "text_sha256").union(
        alone.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long"), "rows", "text_sha256")
    )
    one = F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))).alias("copy")
    return found.select("doc_id", "keep_id", "group_size", "text_sha256", one).select(
        shown_id(),
        shown_id("keep_id"),
        "group_size",
        ((F.col("doc_id") == F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        "text_sha256",
    )


def kept_rows(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns: of equal texts one row of the largest doc_id."""
    found = scratch.save(refine(docs, scratch).filter("group_size > 1"), "found")
    found = found.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.col("text_sha256").alias("sha"), "kept")
    losing = found.filter("not kept").select("id", "sha").distinct()
    # The columns travel as one, so that none can have a name used here.
    text, id_of = F.coalesce(F.col("row.text").cast("string"), F.lit("")), F.col("row.doc_id").cast("long")
    rows = docs.select(F.struct(*docs.columns).alias("row")).select("row", F.coalesce(id_of, F.lit(NO_ID)).alias("id"))
    ids = losing.select("id").distinct()
    # A doc_id that loses one row may keep another one: its rows are looked at by text, equal ones counted down to one.
    again = rows.join(ids, "id", "left_semi").withColumn("sha", F.sha2(lower_ascii(text), 256))
    others = again.join(losing, ["id", "sha"], "left_anti")
    staying = found.filter("kept").select("id", "sha").join(losing, ["id", "sha"], "left_semi")
    one = again.join(staying, ["id", "sha"], "left_semi").dropDuplicates(["id", "sha"])
    return rows.join(ids, "id", "left_anti").select("row.*").union(others.select("row.*")).union(one.select("row.*"))
