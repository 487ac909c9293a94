"""The registered queries: every operator over the given tables, whole tables and whole texts."""

from __future__ import annotations

import gzip
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions import names, text, tokens
from corpusmill.functions.frames import frame, framed_size
from corpusmill.functions.wikitext import strip_markup
from corpusmill.operators import batches, ordering, overlap, redundancy, replicate, sizes
from corpusmill.plans import code, measure, staged, wiki
from corpusmill.session import dealt, file_system, materialized, qualified, shuffles_removed, spread, work_folder
from corpusmill.sinks import append, chunks, jsonl, rejects, store
from corpusmill.sources import files, mediawiki, spans
from corpusmill.sources import text as text_source
from corpusmill.sources.tables import read_table, record_stream
from corpusmill.streaming import blockstore, ingest
from corpusmill.streaming import chunks as stream_chunks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Parameters of the registered queries, shared with their SQL.
ROWS_PER_CHUNK = 100
SHARD_LAYOUT = {"rows_per_file": 20, "files_per_folder": 5, "folders": 3}
MILESTONE_TARGET = 10 * 1024**2
SMALL_BLOCK = 256
SPARSE_LENGTH = 4  # start mark, two words, end mark
PLANTED_COPIES = 1_000_000
OVERLAP_BLOCK, OVERLAP_SIMILARITY = 64, 20
PATH_PREFIX = "https://mirror.example.org/"
TALK_SOURCE, REDIRECT_SOURCE, BLANKED_LANG, BROKEN_LANG = "src3", "src7", "de", "fr"

# Text wrapped in markup that exercises every cleaning rule; {name} stands for a column.
WRAPPED = [
    "{{Infobox|name=", "{lang}", "|x={{nested}}}}'''", "{source}", "''' ''italic''\n[[File:pic.png|thumb|",
    "{lang}", "]] [[", "{source}", "|label ", "{lang}", "]] [[", "{lang}", "]] <!-- note --> <!-- two\nlines -->"
    " [http://example.org/a site ", "{source}", "] [https://example.org]\n== Heading ", "{lang}", " ==\n",
    "{text}", "\n<ref name=\"n\">cite ", "{source}", "</ref><ref name='m' /><ref>multi\nline</ref>"
    " <br/> end {{open [[open <open",
]


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def wrapped() -> Column:
    return F.concat(*[F.col(p[1:-1]) if p.startswith("{") and p.endswith("}") else F.lit(p) for p in WRAPPED])


def documents(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    return read_table(spark, sf, "documents", *columns)


def size_of(column: str) -> Column:
    return F.octet_length(column).cast("bigint")


def half_of(df: DataFrame, size: Column) -> int:
    """Half the total: a budget that grows with the table."""
    return df.agg(F.sum(size)).first()[0] // 2


# ---- cleaning ---------------------------------------------------------------------------------------


@query
def clean_pages(spark: SparkSession, sf: str) -> DataFrame:
    return wiki.clean_table(read_table(spark, sf, "pages", "page_id", "html"), "html")


@query
def clean_wrapped_documents(spark: SparkSession, sf: str) -> DataFrame:
    table = spread(documents(spark, sf, "doc_id", "lang", "source", "text"))
    return table.select("doc_id", strip_markup(wrapped()).alias("text"))


@query
def short_text_filter(spark: SparkSession, sf: str) -> DataFrame:
    table = documents(spark, sf, "doc_id", "text")
    return table.where(text.long_enough(F.col("text"))).select("doc_id", size_of("text").alias("n_bytes"))


@query
def truncate_bytes(spark: SparkSession, sf: str) -> DataFrame:
    cut = documents(spark, sf, "doc_id", "text").select("doc_id", text.truncate_bytes(F.col("text")).alias("text"))
    return cut.withColumn("n_bytes", size_of("text"))


@query
def article_json(spark: SparkSession, sf: str) -> DataFrame:
    line = text.article_json(F.col("doc_id").cast("string"), F.col("source"), F.col("text"))
    return documents(spark, sf, "doc_id", "source", "text").select("doc_id", line.alias("json"))


@query
def article_count(spark: SparkSession, sf: str) -> DataFrame:
    return clean_pages(spark, sf).agg(F.count("*").alias("articles"), F.sum("n_bytes").alias("total_bytes"))


# ---- dumps ------------------------------------------------------------------------------------------


def _escaped(column: Column) -> Column:
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        column = F.replace(column, F.lit(plain), F.lit(entity))
    return column


def _dump(spark: SparkSession, sf: str, revisions: list[Column], broken: Column | None = None) -> str:
    """The documents written as a bz2 page dump; ``broken`` tells which of them get a malformed page."""
    redirect = F.when(F.col("source") == REDIRECT_SOURCE, '<redirect title="elsewhere" />').otherwise("")
    ns = F.when(F.col("source") == TALK_SOURCE, "1").otherwise("0")
    texts = [
        F.concat(F.lit('<revision><id>1</id><text bytes="1" xml:space="preserve">'), _escaped(r), F.lit("</text></revision>"))
        for r in revisions
    ]
    page = F.concat(
        F.lit("  <page>\n<title>Doc &amp; "), F.col("doc_id"), F.lit("</title><ns>"), ns,
        F.lit("</ns><id>"), F.col("doc_id"), F.lit("</id>"), redirect, *texts, F.lit("</page>"),
    )
    if broken is not None:
        page = F.when(broken, F.concat(F.lit("<page><id>"), F.col("doc_id"), F.lit("</title></page>"))).otherwise(page)
    folder = work_folder(spark, "dump")
    pages = spread(documents(spark, sf, "doc_id", "lang", "source", "text")).select(page.alias("value"))
    pages.write.option("compression", "bzip2").text(folder)
    return folder


@query
def wiki_xml_extract(spark: SparkSession, sf: str) -> DataFrame:
    return wiki.extract(spark, _dump(spark, sf, [wrapped()]))


@query
def history_last_revision(spark: SparkSession, sf: str) -> DataFrame:
    later = F.when(F.col("lang") == BLANKED_LANG, "").otherwise(F.concat("text", F.lit(" "), "lang"))
    pages = mediawiki.read_pages(spark, _dump(spark, sf, [F.col("source"), F.col("text"), later]))
    return mediawiki.articles(pages)


@query
def rejected_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages of one language are malformed: articles and rejects from one pass over the dump."""
    dump = _dump(spark, sf, [F.col("text")], F.col("lang").eqNullSafe(F.lit(BROKEN_LANG)))
    parted = wiki.extract_with_rejects(spark, dump)
    size = F.coalesce(F.sum(size_of("text")), F.lit(0))
    kept = parted.kept.select(F.lit("kept").alias("status"), "text")
    rejected = parted.rejected.select("cause", F.lit(None).cast("string").alias("text"))
    return kept.unionByName(rejected.withColumnRenamed("cause", "status")).groupBy("status").agg(
        F.count("*").alias("pages"), size.alias("n_bytes")
    )


# ---- order, budgets, chunks, shards -----------------------------------------------------------------


@query
def byte_budget_prefix(spark: SparkSession, sf: str) -> DataFrame:
    sized = documents(spark, sf, "doc_id", "text").select(
        "doc_id", framed_size(F.col("text").cast("binary")).alias("framed_bytes")
    )
    size = F.col("framed_bytes")
    return ordering.within_budget(sized, "doc_id", size, half_of(sized, size))


@query
def byte_prefix_cut(spark: SparkSession, sf: str) -> DataFrame:
    table = documents(spark, sf, "doc_id", "text")
    prefix = ordering.byte_prefix(table, "doc_id", "text", half_of(table, size_of("text") + 1))
    return prefix.select("doc_id", size_of("piece").alias("kept_bytes"), F.md5("piece").alias("piece_md5"))


@query
def progress_milestones(spark: SparkSession, sf: str) -> DataFrame:
    table = documents(spark, sf, "doc_id", "text")
    return ordering.milestones(table, "doc_id", framed_size(F.col("text").cast("binary")), MILESTONE_TARGET)


@query
def chunk_assignment(spark: SparkSession, sf: str) -> DataFrame:
    placed = ordering.with_position(documents(spark, sf, "doc_id"), "doc_id")
    return placed.withColumns(ordering.chunk_columns("pos", ROWS_PER_CHUNK))


@query
def shard_assignment(spark: SparkSession, sf: str) -> DataFrame:
    return jsonl.place_in_shards(documents(spark, sf, "doc_id"), "doc_id", **SHARD_LAYOUT)


@query
def first_n_by_order(spark: SparkSession, sf: str) -> DataFrame:
    value = F.regexp_replace("url", "^https?://[^/]+/", "")
    lines = read_table(spark, sf, "pages", "page_id", "url").select(F.col("page_id").alias("pos"), value.alias("value"))
    return text_source.path_list(lines, PATH_PREFIX)


@query
def seeded_shuffle(spark: SparkSession, sf: str) -> DataFrame:
    return ordering.seeded_shuffle(documents(spark, sf, "doc_id"), "doc_id", batches.SEED)


@query
def concatenated_gzip_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Documents written as gzip text files in order, read back as one numbered line stream."""
    found = spans.spans_of(spark, _gzip_text(spark, sf))
    return spans.with_position(spark, found).select("pos", F.col("value").alias("line"))


@query
def tolerant_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Two damaged files among the documents' gzip files: the lines read, and each damaged file with its cause."""
    folder = _gzip_text(spark, sf)
    for name, raw in (("zz-cut.txt.gz", gzip.compress(b"lost")[:12]), ("zz-plain.txt.gz", b"not compressed")):
        system, root = file_system(qualified(spark, folder))
        with system.open_output_stream(f"{root}/{name}", compression=None) as out:
            out.write(raw)
    found = spans.spans_of(spark, folder)
    lines = spans.read_spans(spark, found, tolerant=True)
    parted = rejects.part(lines.join(F.broadcast(spans.files_of(spark, found)), "part"), "lines")
    good = parted.kept.agg(F.lit("").alias("name"), F.count("*").alias("lines"), F.sum(size_of("value")).alias("n_bytes"))
    cause = F.substring_index("cause", ":", 1)
    bad = parted.rejected.select(names.basename(F.col("path")).alias("name"), F.lit(0).alias("lines"), F.lit(0).alias("n_bytes"), cause.alias("cause"))
    return good.withColumn("cause", F.lit(None).cast("string")).unionByName(bad)


@query
def stream_head_bytes(spark: SparkSession, sf: str) -> DataFrame:
    table = documents(spark, sf, "text")
    found = spans.spans_of(spark, _gzip_text(spark, sf))
    head = spans.head_bytes(spark, found, half_of(table, size_of("text") + 1))
    return head.select("pos", F.hex("piece").alias("piece"))


def _gzip_text(spark: SparkSession, sf: str) -> str:
    folder = work_folder(spark, "gzip-text")
    ordered = documents(spark, sf, "doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    ordered.select("text").write.option("compression", "gzip").text(folder)
    return folder


# ---- sizes, inventories, names ----------------------------------------------------------------------


@query
def category_size_rollup(spark: SparkSession, sf: str) -> DataFrame:
    sized = documents(spark, sf, "source", "text").select("source", size_of("text").alias("size"))
    return sizes.size_rollup(sized, "source", "size")


@query
def size_gate(spark: SparkSession, sf: str) -> DataFrame:
    return sizes.at_least_gib(documents(spark, sf, "text"), size_of("text"), sizes.WEB_GATE_GIB)


@query
def size_gate_open(spark: SparkSession, sf: str) -> DataFrame:
    """The gate over as many copies of the texts as it takes to pass it."""
    return sizes.at_least_gib(documents(spark, sf, "text"), size_of("text") * PLANTED_COPIES, sizes.WIKI_GATE_GIB)


@query
def human_size(spark: SparkSession, sf: str) -> DataFrame:
    sized = documents(spark, sf, "doc_id", "text").select("doc_id", size_of("text").alias("n_bytes"))
    squared = F.col("n_bytes") * F.col("n_bytes")
    return sized.withColumns(
        {"shown": names.human_size(F.col("n_bytes")), "shown_squared": names.human_size(squared)}
    )


@query
def nonempty_check(spark: SparkSession, sf: str) -> DataFrame:
    return sizes.present(documents(spark, sf, "text"), size_of("text"))


@query
def file_inventory(spark: SparkSession, sf: str) -> DataFrame:
    folder = work_folder(spark, "inventory")
    documents(spark, sf, "source", "text").write.partitionBy("source").text(folder)
    found = files.inventory(spark, folder, "*.txt")
    return sizes.size_rollup(found, "category", "length").select(
        "category", "is_total", "total_bytes", (F.col("files") > 0).alias("has_files")
    )


@query
def exclude_by_extension(spark: SparkSession, sf: str) -> DataFrame:
    extension = (
        F.when(F.col("lang") == "en", "txt").when(F.col("lang") == "de", "md").when(F.col("lang") == "fr", "h5").otherwise("bin")
    )
    path = F.concat("source", F.lit("/doc_"), "doc_id", F.lit("."), extension)
    return documents(spark, sf, "doc_id", "source", "lang").select("doc_id", path.alias("path")).where(
        files.without_extensions(F.col("path"))
    )


@query
def manifest_parse(spark: SparkSession, sf: str) -> DataFrame:
    entry = F.concat("source", F.lit("/"), "doc_id", F.lit("|"), "lang", F.lit(" | "), "n_chars")
    identifier, description, folder = files.parse_manifest(F.col("entry"))
    return documents(spark, sf, "doc_id", "source", "lang", "n_chars").select("doc_id", entry.alias("entry")).select(
        "doc_id", identifier.alias("identifier"), description.alias("description"), folder.alias("folder")
    )


@query
def path_names(spark: SparkSession, sf: str) -> DataFrame:
    url = F.col("url")
    return read_table(spark, sf, "pages", "page_id", "url").select(
        "page_id",
        names.basename(url).alias("base"),
        names.dirname(url).alias("dir"),
        names.safe_name(url).alias("safe"),
        names.epoch_name(F.col("page_id")).alias("epoch_file"),
    )


@query
def rejects_report(spark: SparkSession, sf: str) -> DataFrame:
    """Sources were written as folders; languages were asked for too and are reported."""
    folder = work_folder(spark, "rejects")
    table = documents(spark, sf, "source", "lang", "text")
    table.select("source", "text").write.partitionBy("source").text(folder)
    found = files.inventory(spark, folder, "*.txt").select(F.url_decode(F.replace(F.substring_index("category", "=", -1), F.lit("+"), F.lit("%2B"))).alias("name"))
    requested = table.select(F.col("source").alias("name")).unionByName(table.select(F.col("lang").alias("name")))
    return text_source.rejects(requested.distinct(), found)


@query
def ledger_anti_join(spark: SparkSession, sf: str) -> DataFrame:
    done = read_table(spark, sf, "labels", "doc_id")
    return text_source.not_done(documents(spark, sf, "doc_id", "source"), done, "doc_id")


@query
def concatenate_sources(spark: SparkSession, sf: str) -> DataFrame:
    parts = [("documents", "doc_id"), ("conversations", "conv_id"), ("benchmark", "item_id")]
    tables = [
        read_table(spark, sf, name, key, "text").select(
            F.lit(name).alias("origin"), F.col(key).alias("id"), size_of("text").alias("n_bytes"), F.md5("text").alias("digest")
        )
        for name, key in parts
    ]
    whole = tables[0]
    for table in tables[1:]:
        whole = whole.unionByName(table)
    return whole


# ---- planted redundancy -----------------------------------------------------------------------------


@query
def hot_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    base = documents(spark, sf, "doc_id", "text").select(
        "doc_id", size_of("text").alias("n_bytes"), F.md5("text").alias("digest")
    )
    return replicate.exact_copies(base)


def _variants(table: DataFrame, with_base: bool = False) -> DataFrame:
    blocks = redundancy.split_blocks(table, "text", ["doc_id"])
    key = F.concat_ws(":", "doc_id", "block_no")
    return replicate.near_copies(blocks.where("block_no IS NOT NULL"), "block", key, with_base=with_base)


@query
def near_duplicate_flips(spark: SparkSession, sf: str) -> DataFrame:
    return _variants(spread(documents(spark, sf, "doc_id", "text"))).select(
        "doc_id",
        F.col("block_no").cast("bigint").alias("block_no"),
        F.col("variant").cast("bigint").alias("variant"),
        "flips",
        F.md5("flipped").alias("digest"),
    )


@query
def near_duplicate_overlap(spark: SparkSession, sf: str) -> DataFrame:
    """Each variant against its document; dealt by document before they are cut, blocks stay where they arise.

    The blocks of all variants take many times the text they come from, so a partition holds a share of it only.
    """
    varied = _variants(dealt(documents(spark, sf, "doc_id", "text"), F.octet_length("text"), "doc_id"), with_base=True)
    pieces = redundancy.split_blocks(varied, "flipped", ["doc_id", "variant"], OVERLAP_BLOCK)
    pieces = pieces.select("doc_id", F.col("variant").cast("bigint").alias("variant"), redundancy.fingerprint(F.col("block")).alias("fp"))
    return redundancy.overlap_with_base(pieces, "doc_id", "variant", replicate.VARIANTS)


@query
def block_overlap(spark: SparkSession, sf: str) -> DataFrame:
    """Each document's links to any others that share a fifth of their byte blocks."""
    table = spread(documents(spark, sf, "doc_id", "text"))
    return overlap.block_overlap(table, "doc_id", "text", OVERLAP_BLOCK, OVERLAP_SIMILARITY)


@query
def line_overlap(spark: SparkSession, sf: str) -> DataFrame:
    """The same over lines."""
    table = spread(documents(spark, sf, "doc_id", "text"))
    return overlap.block_overlap(table, "doc_id", "text", None, OVERLAP_SIMILARITY)


@query
def append_logs(spark: SparkSession, sf: str) -> DataFrame:
    logs = replicate.append_logs(documents(spark, sf, "doc_id", "text"), "doc_id", "text")
    return logs.select(
        F.col("log").cast("bigint").alias("log"),
        "file",
        F.col("part").cast("bigint").alias("part"),
        "seq",
        F.md5("line").alias("digest"),
    )


# ---- redundancy measurement -------------------------------------------------------------------------


@query
def exact_duplicate_groups(spark: SparkSession, sf: str) -> DataFrame:
    return redundancy.exact_duplicates(documents(spark, sf, "doc_id", "text"), "doc_id", "text")


@query
def block_dedup_stats(spark: SparkSession, sf: str) -> DataFrame:
    table = spread(documents(spark, sf, "source", "text"))
    return redundancy.block_statistics(table, "source", "text", SMALL_BLOCK)


@query
def line_dedup_stats(spark: SparkSession, sf: str) -> DataFrame:
    table = spread(documents(spark, sf, "source", "text"))
    return redundancy.block_statistics(table, "source", "text", None)


@query
def planted_dedup_stats(spark: SparkSession, sf: str) -> DataFrame:
    """What the store makes of ten exact copies of every document, per document source."""
    copies = replicate.numbered(documents(spark, sf, "source", "text"), replicate.COPIES, "copy", start=0)
    return redundancy.block_statistics(copies, "source", "text")


@query
def stats_json(spark: SparkSession, sf: str) -> DataFrame:
    folder = work_folder(spark, "stats")
    stats = redundancy.block_statistics(documents(spark, sf, "source", "text"), "source", "text")
    append.write_statistics(stats, folder)
    return spark.read.schema(stats.schema).json(folder)


@query
def dedup_store_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    folder = work_folder(spark, "store")
    store.write_store(spread(documents(spark, sf, "doc_id", "text")), "doc_id", "text", folder, SMALL_BLOCK)
    back = store.restored_records(spark, folder, "doc_id")
    return back.select("doc_id", size_of("content").alias("n_bytes"), F.md5("content").alias("digest"))


@query
def dedup_group_stores(spark: SparkSession, sf: str) -> DataFrame:
    folder = work_folder(spark, "stores")
    table = spread(documents(spark, sf, "source", "doc_id", "text"))
    store.write_group_stores(table, "source", "doc_id", "text", folder, SMALL_BLOCK)
    return store.group_store_sizes(spark, folder, "source")


@query
def compression_compare(spark: SparkSession, sf: str) -> DataFrame:
    table = spread(documents(spark, sf, "source", "text"))
    return measure.compare(table, "source", "text", work_folder(spark, "packs"))


@query
def compression_gain(spark: SparkSession, sf: str) -> DataFrame:
    """The comparison without the compressor's own byte counts, which only it can tell."""
    smaller = F.col("gz_bytes") < F.col("raw_bytes")
    return compression_compare(spark, sf).select(
        "grp", "is_total", "files", "raw_bytes", "stored_bytes", "stored_share", smaller.alias("smaller"),
        (F.col("members") > 0).alias("packed"),
    )


# ---- frames, chunk files, shards, appends -----------------------------------------------------------


@query
def frame_records(spark: SparkSession, sf: str) -> DataFrame:
    content = text.encodable_bytes(F.col("text"))
    return documents(spark, sf, "doc_id", "text").select("doc_id", F.hex(frame(content)).alias("frame"))


def _records(spark: SparkSession, sf: str) -> DataFrame:
    records = record_stream(spark, f"{sf.rstrip('/')}/documents.parquet", "text", "doc_id")
    return ordering.with_position(records.withColumnRenamed("pos", "doc_id"), "doc_id").select("pos", "content")


def _chunk_rows(spark: SparkSession, folder: str) -> DataFrame:
    return chunks.read_chunks(spark, folder).select(
        "chunk_file", "row_in_chunk", size_of("content").alias("n_bytes"), F.md5("content").alias("digest")
    )


@query
def chunk_files_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    folder = work_folder(spark, "chunks")
    code.build(spark, _records(spark, sf), folder, rows_per_chunk=ROWS_PER_CHUNK)
    return _chunk_rows(spark, folder)


@query
def chunk_files_resumed(spark: SparkSession, sf: str) -> DataFrame:
    """A run stopped by a small budget, then one that goes on after it: the same files as one run."""
    folder = work_folder(spark, "resumed")
    records = _records(spark, sf)
    half = half_of(documents(spark, sf, "text"), size_of("text") + 8)
    code.build(spark, records, folder, half, ROWS_PER_CHUNK)
    code.build(spark, records, folder, rows_per_chunk=ROWS_PER_CHUNK)
    return _chunk_rows(spark, folder)


@query
def resume_offset(spark: SparkSession, sf: str) -> DataFrame:
    """Rows from the middle of the stream on, the offset being a subquery over the table."""
    table = documents(spark, sf, "doc_id", "source")
    middle = table.agg(F.call_function("div", F.max("doc_id"), F.lit(2))).scalar()
    return ordering.resume_from(table, "doc_id", middle)


@query
def sharded_json_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    folder = work_folder(spark, "shards")
    table = documents(spark, sf, "doc_id", "source", "text").select(
        F.col("doc_id").cast("string").alias("id"), F.col("source").alias("title"), F.col("text").alias("markup")
    )
    cleaned = mediawiki.clean_articles(spread(table), "markup").withColumn("_key", jsonl.numeric_key("id"))
    cleaned = materialized(cleaned, "articles")
    jsonl.write_shards(cleaned, folder, "_key", ("id",), **SHARD_LAYOUT)
    return jsonl.read_shards(spark, folder).select("dir", "file", "id", "title", F.md5("text").alias("digest"))


@query
def append_sink(spark: SparkSession, sf: str) -> DataFrame:
    folder = work_folder(spark, "append")
    for name in ("documents", "conversations"):
        append.append_text(read_table(spark, sf, name, "text"), folder, "text")
    return _line_counts(text_source.read_lines(spark, folder), "value")


def _line_counts(lines: DataFrame, column: str) -> DataFrame:
    return lines.groupBy(F.md5(column).alias("digest")).agg(F.count("*").alias("copies"))


# ---- language-model batches -------------------------------------------------------------------------


def _tokenized(spark: SparkSession, sf: str, max_length: int = tokens.MAX_LENGTH) -> DataFrame:
    return batches.tokenize(spread(documents(spark, sf, "doc_id", "text")), "text", max_length)


def _joined(column: str) -> Column:
    return F.array_join(F.col(column).cast("array<string>"), ",").alias(column)


@query
def tokenize_truncate(spark: SparkSession, sf: str) -> DataFrame:
    return _tokenized(spark, sf).select("doc_id", _joined("input_ids"))


@query
def mlm_mask(spark: SparkSession, sf: str) -> DataFrame:
    masked = batches.mask(_tokenized(spark, sf), "doc_id")
    return masked.select("doc_id", _joined("input_ids"), _joined("labels"))


@query
def batch_assign(spark: SparkSession, sf: str) -> DataFrame:
    return batches.into_batches(documents(spark, sf, "doc_id"), "doc_id")


def _batched(spark: SparkSession, sf: str, max_length: int = tokens.MAX_LENGTH) -> DataFrame:
    return batches.into_batches(batches.mask(_tokenized(spark, sf, max_length), "doc_id"), "doc_id")


@query
def pad_to_longest(spark: SparkSession, sf: str) -> DataFrame:
    padded = batches.pad(_batched(spark, sf))
    return padded.select(
        "doc_id", "batch", F.col("length").cast("bigint").alias("length"),
        _joined("input_ids"), _joined("labels"), _joined("attention_mask"),
    )


@query
def valid_batches(spark: SparkSession, sf: str) -> DataFrame:
    return batches.valid_batches(_batched(spark, sf))


@query
def valid_sparse_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Texts cut to two words: some batches have no target, and are left out."""
    return batches.valid_batches(_batched(spark, sf, SPARSE_LENGTH))


@query
def sparse_batch_mean(spark: SparkSession, sf: str) -> DataFrame:
    return _mean_targets(_batched(spark, sf, SPARSE_LENGTH))


@query
def batch_mean_all(spark: SparkSession, sf: str) -> DataFrame:
    return _mean_targets(_batched(spark, sf))


def _mean_targets(batched: DataFrame) -> DataFrame:
    """Mean targets per row over all batches; batches without targets count in the divisor only."""
    per_batch = batches.batch_targets(batched)
    value = F.when(F.col("valid"), F.col("targets") / F.col("rows"))
    return batches.mean_over_all(per_batch.select(value.alias("loss")), F.col("loss"))


@query
def nonfinite_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Infinities are planted for one label: the table itself holds none."""
    planted = F.when(
        F.col("label") == 2, F.concat("embedding", F.array(F.lit(float("-inf")).cast("float")))
    ).otherwise(F.col("embedding"))
    table = read_table(spark, sf, "embeddings", "vec_id", "label", "embedding").withColumn("embedding", planted)
    found = batches.non_finite(table, "embedding")
    return found.withColumns({c: F.col(c).cast("double") for c in ("lowest", "highest")})


def _count_words(frame: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"doc_id": frame["doc_id"], "n_words": frame["text"].str.split().str.len().astype("int64")})


@query
def mapped_batches(spark: SparkSession, sf: str) -> DataFrame:
    """The hook for a user's own tokenizer, here one that counts words."""
    table = spread(documents(spark, sf, "doc_id", "text"))
    return batches.map_batches(table, _count_words, "doc_id BIGINT, n_words BIGINT")


def _summarize_batch(frame: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame(
        {"batch": frame["batch"].iloc[:1], "rows": [len(frame)], "longest": [int(frame["n_tokens"].max())]}
    )


@query
def collated_batches(spark: SparkSession, sf: str) -> DataFrame:
    """The hook for a user's own collation, here one that reports each batch."""
    sized = _tokenized(spark, sf).select("doc_id", F.size("input_ids").alias("n_tokens"))
    placed = batches.into_batches(sized, "doc_id")
    return batches.collate_batches(placed, _summarize_batch, "batch BIGINT, rows BIGINT, longest BIGINT")


# ---- streams and staged builds ----------------------------------------------------------------------


@query
def incremental_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """New files are taken in once: documents, nothing on a re-run, then conversations."""
    folder, target, checkpoint = (work_folder(spark, f"ingest-{n}") for n in ("in", "out", "state"))
    for name in ("documents", None, "conversations"):
        if name:
            read_table(spark, sf, name, "text").write.mode("append").option("compression", "gzip").text(folder)
        ingest.append_new(ingest.new_lines(spark, folder, "*.gz"), target, checkpoint)
    return _line_counts(spark.read.schema("file STRING, value STRING").json(target), "value")


@query
def streaming_progress(spark: SparkSession, sf: str) -> DataFrame:
    folder, target, rows, checkpoint = (work_folder(spark, f"progress-{n}") for n in ("in", "out", "rows", "state"))
    spread(documents(spark, sf, "text")).write.text(folder)
    lines = ingest.new_lines(spark, folder, "*.txt", files_per_batch=2)
    ingest.append_counted(lines, target, rows, checkpoint)
    return spark.read.schema("records BIGINT, bytes BIGINT").parquet(rows).agg(
        F.sum("records").alias("records"), F.sum("bytes").alias("bytes")
    )


def _document_stream(spark: SparkSession, sf: str) -> DataFrame:
    folder = work_folder(spark, "documents")
    table = documents(spark, sf, "doc_id", "text")
    spread(table).write.parquet(folder)
    return spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 2).parquet(folder)


@query
def streaming_block_store(spark: SparkSession, sf: str) -> DataFrame:
    folder, checkpoint = work_folder(spark, "grown"), work_folder(spark, "grown-state")
    blockstore.grow_store(_document_stream(spark, sf), "doc_id", "text", folder, checkpoint, SMALL_BLOCK)
    blocks = blockstore.read_blocks(spark, folder).agg(
        F.count("*").alias("unique_blocks"), F.sum(size_of("block")).alias("stored_bytes")
    )
    used = blockstore.read_recipe(spark, folder).agg(F.count("*").alias("total_blocks"))
    return blocks.select("unique_blocks", "stored_bytes", used.scalar().alias("total_blocks"))


@query
def streaming_chunks(spark: SparkSession, sf: str) -> DataFrame:
    folder, checkpoint = work_folder(spark, "chunk-stream"), work_folder(spark, "chunk-stream-state")
    stream_chunks.write_stream(_document_stream(spark, sf), "doc_id", "text", folder, checkpoint, ROWS_PER_CHUNK)
    rows = chunks.read_chunks(spark, folder)
    return rows.groupBy(F.md5("content").alias("digest")).agg(
        F.count("*").alias("copies"), F.sum(size_of("content")).alias("total_bytes")
    )


def _built(spark: SparkSession, sf: str) -> staged.Build:
    """All stages from inputs derived from the tables, one of them restarted; one of two listed models is missing."""
    models = work_folder(spark, "models")
    with shuffles_removed(spark):
        documents(spark, sf, "text").write.text(f"{models}/owner_model")
        inputs = staged.Inputs(
            web=_gzip_text(spark, sf),
            dump=_dump(spark, sf, [wrapped()]),
            records=_records(spark, sf),
            models=models,
            manifest=["owner/model|A model", "other|Another model"],
            rows_per_chunk=ROWS_PER_CHUNK,
        )
    build = staged.Build(spark, work_folder(spark, "build"), inputs)
    build.run()
    build.restart("append_logs")
    build.run()
    return build


@query
def staged_build_counts(spark: SparkSession, sf: str) -> DataFrame:
    """What SQL can tell of a build: which categories have files, and the bytes of the framed records."""
    report = _built(spark, sf).report()
    code_bytes = F.when(F.col("category") == "code", F.col("total_bytes"))
    return report.select("category", "is_total", (F.col("files") > 0).alias("has_files"), code_bytes.alias("code_bytes"))


@query
def staged_build_report(spark: SparkSession, sf: str) -> DataFrame:
    return _built(spark, sf).report()
