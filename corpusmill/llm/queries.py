"""The registered queries of the operators, thin over each operator's own interface."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import (
    embedding_dedup,
    language_id,
    license_scan,
    merkle_manifest,
    minhash_dedup,
    packing,
    periodic_runs,
    piece_sampling,
    pii,
    positional_index,
    quality_rules,
    toxicity,
    url_filter,
    words,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
POLICY = "v3"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet").select(*columns)


def _number(text: Column, modulus: int) -> Column:
    """A number below ``modulus`` from the first 28 bits of a text's MD5, as the SQL has it too."""
    return F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("bigint") % modulus


def url_list(pages: DataFrame) -> DataFrame:
    """A dated list derived from the pages' hosts: additions, removals and new additions of three kinds of pattern."""
    host, path = url_filter.url_parts("url")
    seen = pages.select(host.alias("host"), F.split(path, "/")[1].alias("first")).where("host <> ''").distinct()
    hosts = seen.groupBy("host").agg(F.min("first").alias("first"))
    pick = lambda name, modulus: _number(F.concat_ws(":", F.lit(name), F.col("host")), modulus)
    kind = pick("kind", 3)
    chosen = hosts.where(pick("listed", 4) > 0).select(
        F.element_at(F.array(F.lit("adult"), F.lit("ads"), F.lit("fraud")), pick("listed", 4).cast("int")).alias(
            "list_name"
        ),
        F.element_at(F.array(*map(F.lit, url_filter.KINDS)), (kind + 1).cast("int")).alias("kind"),
        F.when(kind == 0, F.substring_index("host", ".", -2))
        .when(kind == 1, F.col("host"))
        .otherwise(F.concat_ws("/", "host", "first"))
        .alias("pattern"),
        pick("day", 365).alias("day"),
        pick("events", 3).alias("events"),
    )
    dates = F.transform(
        F.sequence(F.lit(0), F.col("events").cast("int")),
        lambda k: F.struct(
            F.date_add(F.lit("2024-01-01").cast("date"), (F.col("day") + k * 40).cast("int")).alias("listed_at"),
            F.when(k % 2 == 0, "add").otherwise("remove").alias("action"),
        ),
    )
    return chosen.select("list_name", "kind", "pattern", F.inline(dates))


@query
def op1_url_filters(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages", "page_id", "url")
    day = _number(F.concat_ws(":", F.lit("fetch"), F.col("page_id").cast("string")), 365)
    captures = pages.withColumn("fetched_at", F.date_add(F.lit("2024-01-01").cast("date"), day.cast("int")))
    return url_filter.evaluate(captures, url_filter.intervals(url_list(pages)), "page_id", "url", "fetched_at")


@query
def op2_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents", "doc_id", "text"))


@query
def op3_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents", "doc_id", "text")
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, sf, "labels", "doc_id", "toxic")))
    return scored.select(
        "doc_id",
        language_id.is_held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@query
def op4_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    entries = quality_rules.ledger(table(spark, sf, "documents", "doc_id", "text"))
    return quality_rules.apply_policy(entries, quality_rules.POLICIES[POLICY]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "failed_bits",
    )


@query
def op5_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents", "doc_id", "text", "lang")
    model = language_id.train(language_id.training_sample(docs))
    return language_id.identify(docs, model).select(
        "doc_id", language_id.is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )


@query
def op6_license_scans(spark: SparkSession, sf: str) -> DataFrame:
    return license_scan.scan(table(spark, sf, "documents", "doc_id", "text"))


@query
def op7_piece_sampling(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations", "conv_id", "turn", "text")
    sampled = piece_sampling.sample_segmentations(turns, ["conv_id", "turn"])
    back = piece_sampling.decode_segmentations(sampled)
    return back.select(
        "conv_id", "turn", "sample_no", F.size("ids").alias("n_ids"),
        F.crc32(F.array_join("ids", ",")).alias("ids_crc32"), "log_prob", "perturbed", "inclusion",
        F.md5("decoded").alias("decoded_md5"),
    )


@query
def op8_pii(spark: SparkSession, sf: str) -> DataFrame:
    found = pii.find_spans(table(spark, sf, "documents", "doc_id", "text"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS)],
        F.sha2(pii.joined(F.col("base")), 256).alias("base_sha256"),
        pii.joined(F.col("spans")).alias("spans"),
    )


@query
def op9_embedding_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return embedding_dedup.dedup(table(spark, sf, "embeddings", "vec_id", "embedding", "label"))


@query
def op10_minhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return minhash_dedup.dedup(table(spark, sf, "documents", "doc_id", "text"), width=4)


@query
def op11_benchmark_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents", "doc_id", "text")
    found = positional_index.decontaminate(docs, table(spark, sf, "benchmark", "item_id", "text"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


@query
def op12_merkle_dataset_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Leaves whose key's checksum is a multiple of seven are presented with one more character counted."""
    docs = table(spark, sf, "documents", "doc_id", "source", "lang", "n_chars", "text")
    leaf = lambda n_chars: merkle_manifest.leaf_digest(
        F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text")
    )
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, leaf(F.col("n_chars") + 1))
    manifest = merkle_manifest.build(docs, "doc_id", "lang", leaf(F.col("n_chars")), tampered)
    proofs = merkle_manifest.prove(manifest).withColumn(
        "folded_root", merkle_manifest.folded(F.coalesce("presented", "leaf"), F.col("path"))
    )
    return proofs.select(
        F.col("key").alias("doc_id"), "leaf", "subroot", "root",
        merkle_manifest.proof_digest(F.col("path")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def planted_runs(docs: DataFrame) -> DataFrame:
    """The documents, of which a tenth repeat their words from a place on; place and period follow from the id."""
    checksum = F.crc32(F.col("doc_id").cast("string"))
    g = F.call_function("div", checksum, F.lit(10))
    rows = words.words_of(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "text")
    n = F.size("_words")
    start = (g % n).cast("int")
    period = F.lit(1) + F.call_function("div", n - start, F.lit(3) + g % 8).cast("int")
    placed = rows.select("doc_id", "text", "_words", ((checksum % 10 == 0) & (n > 0)).alias("_chosen"))
    placed = placed.withColumns({"_a": F.when(F.col("_chosen"), start), "_p": F.when(F.col("_chosen"), period)})
    source = lambda i: F.when(i < F.col("_a"), i).otherwise(F.col("_a") + (i - F.col("_a")) % F.col("_p"))
    repeated = F.transform("_words", lambda word, i: F.get(F.col("_words"), source(i)))
    return placed.select("doc_id", F.when(F.col("_chosen"), F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


@query
def op13_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    found = periodic_runs.detect(planted_runs(table(spark, sf, "documents", "doc_id", "text")))
    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    # Runs come by start and period, so of equal exponents the first stays.
    longer = lambda best, r: F.when(
        best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r
    ).otherwise(best)
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.transform("runs", lambda r: F.concat(line(r), F.lit("\n")))
    best = found.withColumn("_best", F.aggregate("runs", none, longer))
    return best.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "_best.start", "_best.length", "_best.period",
        F.call_function("div", 1000 * F.col("_best.length"), F.col("_best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
