"""The operators over the given tables, one query each, with production parameters; SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fulluse.llm import (
    bpe, decontaminate, exact_dedup, id_files, jaccard, language, lengths, line_dedup, negatives, packing, quality,
    ranked, suffixes,
)
from fulluse.llm.common import Scratch, documents


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = id_files.write(documents(spark, sf_dir), Scratch(spark), "ids", _tokenizer("word_bpe_49k.json"))
    return id_files.read(chunks)


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(documents(spark, sf_dir), _tokenizer("byte_bpe_50k.tiktoken"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digests(suffixes.remove(documents(spark, sf_dir), Scratch(spark)))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.join(documents(spark, sf_dir), Scratch(spark), width=3, num=90, den=100)
    return found.select("doc_id", "n_shingles", "component_id")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages and documents, each row with its table: a page's id is page_id, a document's doc_id."""
    docs, scratch = documents(spark, sf_dir), Scratch(spark)
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    model = language.fit(docs)
    columns = ("lang", "confidence", "text_lang")
    of_docs = language.identify(language.from_documents(docs), model, scratch, "documents")
    of_pages = language.identify(language.from_pages(pages), model, scratch, "pages")
    none = F.lit(None).cast("long")
    return of_docs.select(F.col("id").alias("doc_id"), none.alias("page_id"), *columns).union(
        of_pages.select(none, F.col("id"), *columns)
    )


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup(documents(spark, sf_dir), Scratch(spark))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op7_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = lengths.histogram(documents(spark, sf_dir), _tokenizer("byte_bpe_50k.tiktoken"))
    return lengths.suffix_sums(Scratch(spark).save(counts, "histogram")).drop("d_all", "t_all")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, model).select("doc_id", "p_content", "p_metadata", "quality_score", "kept")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.refine(documents(spark, sf_dir), Scratch(spark), digest_all=True)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.matches(documents(spark, sf_dir), benchmark, Scratch(spark))
    return found.drop("tag", "shift")


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(documents(spark, sf_dir), Scratch(spark), _tokenizer("word_bpe_49k.json"))
    return packing.digests(packed)


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), Scratch(spark))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").withColumn("label", label)
    return negatives.mine(vectors, F.col("vec_id") % 100 == 0, Scratch(spark))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_id_files, op2_byte_bpe, op3_suffix_dedup, op4_jaccard_join, op5_language, op6_line_dedup, op7_lengths,
        op8_quality, op9_exact_dedup, op10_decontaminate, op11_packing, op12_ranked_search, op13_hard_negatives,
    )
}

SQL: dict[str, str] = {
    "op6_line_dedup": r"""
        WITH lines AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
            FROM documents
        ), stripped AS (
            SELECT doc_id, pos, line, translate(
                trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM lines
        ), shared AS (
            SELECT key, max(doc_id) AS last FROM stripped WHERE length(key) >= 40
            GROUP BY key HAVING count(DISTINCT doc_id) >= 5
        ), marked AS (
            SELECT s.doc_id, s.pos, s.line, h.last IS NOT NULL AND h.last <> s.doc_id AS gone
            FROM stripped s LEFT JOIN shared h ON s.key = h.key
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY doc_id
    """,
    "op9_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
            FROM documents
        )
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
        FROM t WINDOW g AS (PARTITION BY norm)
    """,
    "op12_ranked_search": r"""
        WITH terms AS (
            SELECT doc_id, row_number() OVER () AS row, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
            FROM documents
        ), sums AS (
            SELECT count(*) AS n_docs, sum(len(words))::BIGINT AS total FROM terms WHERE len(words) > 0
        ), wanted AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS word
            FROM benchmark
        ), held AS (
            SELECT row, doc_id, n, word, count(*) AS tf
            FROM (SELECT row, doc_id, len(words) AS n, unnest(words) AS word FROM terms)
            WHERE word IN (SELECT word FROM wanted) GROUP BY row, doc_id, n, word
        ), weights AS (
            SELECT word, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT AS w
            FROM (SELECT word, count(*) AS df FROM held GROUP BY word), sums
        ), scored AS (
            SELECT item_id, row, doc_id,
                   sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * n_docs) // total)))))::BIGINT AS score
            FROM wanted JOIN held USING (word) JOIN weights USING (word), sums GROUP BY item_id, row, doc_id
        ), placed AS (
            SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
            FROM scored WHERE score > 0
        )
        SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM placed WHERE rank <= 50
    """,
    "op13_hard_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
                  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), pairs AS (
            SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
                   list_inner_product(a.e, b.e)::BIGINT AS score
            FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
        ), positives AS (
            SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM pairs WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
        )
        SELECT anchor_id, positive_id,
               row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank,
               other_id AS negative_id, positive_score, score AS negative_score
        FROM positives JOIN pairs USING (anchor_id)
        WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
        QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) <= 5
    """,
}
