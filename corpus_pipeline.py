"""Documents to packed sequences: language, quality, near copies, personal data, packing.

Each stage reads what its predecessor wrote; all but the last return the columns of ``documents``. The last
one's pieces refer to the redacted documents that were kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import language_id, minhash_dedup, packing, pii, quality_rules
from corpusmill.session import materialized

# A text is rejected if no language has this share of its bytes.
LEAST_LANGUAGE_SCORE = 0.3


def _beside(docs: DataFrame) -> DataFrame:
    """Every document as one column next to its text, so that operators carry it without knowing its columns."""
    return docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("_doc"), F.col("text").alias("_plain"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined; those without letters or a clear language go."""
    model = language_id.train(language_id.training_sample(docs))
    known = language_id.identify(_beside(docs), model, "_doc", "_plain")
    # Without a labelled document nothing can be told apart, and only texts without letters go.
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    clear = (F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= LEAST_LANGUAGE_SCORE)
    return known.where(clear).select("_doc.*")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the newest policy."""
    entries = quality_rules.ledger(_beside(docs), "_doc", "_plain")
    return quality_rules.apply_policy(entries, quality_rules.POLICIES["v3"]).where("kept").select("_doc.*")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles), that of the smallest id, null ids first.

    A document is known by its id and its text's digest: different texts of one id are judged apart, and rows that
    repeat both are one document, of which one row stays. Texts without words are alike to none.
    """
    digests = [F.xxhash64("_plain").alias("t1"), F.xxhash64(F.lit(1), F.col("_plain")).alias("t2")]
    keyed = _beside(docs).select("_doc", "_plain", F.struct(F.col("_doc.doc_id").alias("id"), *digests).alias("_key"))
    judged = minhash_dedup.dedup(keyed, "_key", "_plain").groupBy("_key").agg(
        F.first("kept").alias("kept"), F.count("*").alias("n")
    )
    judged = materialized(judged.where("not kept or n > 1"), "judged")
    gone, repeated = judged.where("not kept").select("_key"), judged.where("kept and n > 1").select("_key")
    # Those that go grow with the table: the plan for a large one is the plan at every size.
    rest = keyed.join(gone.hint("merge"), "_key", "left_anti")
    if not repeated.isEmpty():
        once = rest.join(repeated, "_key", "left_semi").dropDuplicates(["_key"])
        rest = rest.join(repeated, "_key", "left_anti").unionByName(once)
    return rest.select("_doc.*")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind; ``n_chars`` follows the text."""
    redacted = pii.redact(docs)
    if "n_chars" in redacted.columns:
        redacted = redacted.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return redacted


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return packing.pack(docs)


STAGES = [
    ("language", language),
    ("quality", quality),
    ("near_copies", near_copies),
    ("personal_data", personal_data),
    ("packed", packed),
]

# Trained models and tokenizers have no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialized(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
