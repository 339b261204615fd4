"""Lines that many documents share lose all copies but those in the newest document.

Lines are exploded and hashed where they are read; only hash, document and position are shuffled. Documents per hash
are counted with partial sums, so a line in a third of all documents is a few rows per task. The lines to drop are
joined to their hashes and come back to the text by position.

Defined cases: a null or empty text is one empty line; rows that repeat doc_id and text count as one document; rows
that repeat doc_id alone count as different documents, of which the one with the largest hash of its text is last; a
null doc_id comes before all others; an empty table gives no row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fulluse.llm.common import Scratch, keyed, lower_ascii, shown_id

BLANKS = " \t\n\x0b\x0c\r"


def dedup(docs: DataFrame, scratch: Scratch, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """doc_id, n_lines, n_dropped, text (what stays, joined by newlines)."""
    rows = keyed(docs)
    line = F.btrim("line", F.lit(BLANKS))
    lines = (
        rows.select("doc_id", "tag", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
        .filter(F.octet_length("line") >= min_chars)
        .select("doc_id", "tag", "pos", line.alias("key"))
        .filter(F.char_length("key") >= min_chars)
        .select("doc_id", "tag", "pos", lower_ascii(F.col("key")).alias("key"))
        # Two hashes of 64 bits stand for the line.
        .select("doc_id", "tag", "pos", F.xxhash64("key").alias("h"), F.xxhash64(F.lit(1), "key").alias("g"))
    )
    lines = scratch.save(lines, "lines")
    # One row a document and key before documents are counted; the tasks that read a document do this among themselves.
    owners = lines.groupBy("h", "g", "doc_id", "tag").agg(F.lit(1).alias("one"))
    shared = owners.groupBy("h", "g").agg(
        F.sum("one").alias("n"), F.max(F.struct("doc_id", "tag")).alias("last")
    ).filter(F.col("n") >= min_docs)
    lost = (
        lines.join(shared.select("h", "g", "last"), ["h", "g"])
        .filter(F.struct("doc_id", "tag") != F.col("last"))
        .groupBy("doc_id", "tag").agg(F.collect_set("pos").alias("lost"))
    )
    found = rows.join(lost, ["doc_id", "tag"], "left").withColumn("split", F.split("text", "\n", -1))
    split = F.col("split")
    # Positions that stay, by one pass over a set of those that go, and their lines in order.
    staying = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), "lost")
    kept = F.when(F.col("lost").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(staying, lambda i: F.get(split, i)), "\n")
    )
    return found.select(
        shown_id(),
        F.size(split).cast("long").alias("n_lines"),
        F.when(F.col("lost").isNull(), 0).otherwise(F.size("lost")).cast("long").alias("n_dropped"),
        kept.alias("text"),
    )
