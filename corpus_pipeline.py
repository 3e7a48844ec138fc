"""The corpus pipeline: stages from raw documents to tokenised training text.

Each stage works on all that its predecessor kept and takes the columns of ``documents``
(doc_id, text, lang, source, n_chars); all but the last give them back. ``n_chars`` follows
the text. Further columns pass through these stages, whatever their names; the last one returns
four columns of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm import bpe, decontamination, line_dedup, quality, simhash
from marketlake.llm.queries import byte_bpe_file
from marketlake.llm.tables import Scratch, column, read


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents that the classifier rejects or finds toxic go (those without text among them)."""
    whole = F.struct(*(column(c) for c in docs.columns)).alias("whole_row")  # out of reach of the classifier's column names
    seen = docs.select("doc_id", "text", "lang", "source", "n_chars", whole)
    return quality.classify(seen, read(spark, sf_dir, "labels")).where("keep AND NOT is_toxic").select("whole_row.*")


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: lines that stand earlier in the corpus go from the texts. All documents
    stay, also those that lose all their lines: as empty texts they are near-duplicates of
    each other for the next stage."""
    found = line_dedup.dedup_lines(docs, Scratch(spark, "pipeline-lines"), removed_col=None,
                                   bands=line_dedup.BANDS, equal_from=line_dedup.EQUAL_FROM)
    return found.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in found.columns else found


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: of each group of near-duplicates, the document of the smallest id stays."""
    return simhash.keep_one(docs, Scratch(spark, "pipeline-simhash"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents that hold a passage of a benchmark item go."""
    return decontamination.keep_clean(docs, read(spark, sf_dir, "benchmark"), Scratch(spark, "pipeline-clean"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: token ids of each text, decoded again; ``exact`` tells whether the round trip
    gives the text back."""
    plain = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    back = bpe.encode_and_decode(plain, byte_bpe_file())
    return back.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), (F.col("decoded") == F.col("text")).alias("exact"))


STAGES = [
    ("quality", quality_filter),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("bpe", tokenise),
]

#: The classifier, XXH64 and byte-pair merging are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table, each written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
