"""A corpus pipeline from the operators in ``rastro.llm``: STAGES, run() and ORACLE_SQL.

Every stage takes (spark, docs, sf_dir), works on all rows that the stage before it kept, and its
decisions take effect. All stages but the last return the columns of ``documents``.

Defined results, for all stages: an empty table gives an empty table; null ids, languages and sources are carried along; columns
beyond those of ``documents``, whatever their names, stay but for the last stage.
"""

import public_tokenizers
from pyspark.sql import functions as F

from rastro.llm.bpe import decode_documents, encode_documents
from rastro.llm.decontamination import judge_contamination
from rastro.llm.quality import judge_quality
from rastro.llm.secrets import mask_secrets
from rastro.llm.simhash import keep_one_of_each
from rastro.session import scratch_path

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def quality_rules(spark, docs, sf_dir):
    """Documents that the quality rules reject go.

    A null or empty text has no words and goes. Repeated rows are judged alike, and stay or go together.
    """
    rows = docs.select(F.struct("*").alias("row"), "text")
    return judge_quality(rows).where("kept").select("row.*")


def simhash_near_dedup(spark, docs, sf_dir):
    """Of each group of documents with linked fingerprints the one with the smallest id stays.

    Shingle length and bit distance are those of operator 7. Null and empty texts have fingerprint zero and are one group. Of
    repeated rows one stays.
    """
    return keep_one_of_each(docs)


def benchmark_decontamination(spark, docs, sf_dir):
    """Documents that hold a window of a benchmark item go.

    A null or empty text holds none and stays; repeated rows stay or go together; without benchmark items all stay.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return judge_contamination(docs, benchmark).where("not contaminated").select("row.*")


def secret_scans(spark, docs, sf_dir):
    """Secrets are masked; no document goes. ``n_chars`` follows the text.

    A null text stays null, with ``n_chars`` null. Overlapping spans are masked as one.
    """
    masked = mask_secrets(docs)
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def byte_bpe(spark, docs, sf_dir):
    """The token ids of every text, and whether they decode to it.

    A null text counts as empty, with no ids. Repeated rows give equal rows.
    """
    rows = docs.select("doc_id", "lang", "source", F.coalesce("text", F.lit("")).alias("text"))
    encoded = encode_documents(rows, VOCABULARY, public_tokenizers.PATTERN, drop_text=False)
    return decode_documents(encoded, VOCABULARY).select(
        "doc_id",
        "lang",
        "source",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        (F.col("decoded") == F.col("text").cast("binary")).alias("round_trip"),
    )


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("byte-level BPE", byte_bpe),
]

#: Stages fit a model by iteration, hash with XXH64 and number components; SQL does not express them.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            folder = scratch_path(spark, f"stage-{number}")
            docs.write.parquet(folder)
            docs = spark.read.parquet(folder)
    return docs
