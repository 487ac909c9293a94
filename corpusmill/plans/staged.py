"""The staged corpus build: each stage runs once, after the stages it needs, and can be restarted.

Stages that do not need each other run side by side. A stage without its input is not run, nor is one that needs it; a
stage that fails keeps its dependants from running, while the others go on, and is raised at the end.
"""

from __future__ import annotations

from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass, field
from graphlib import TopologicalSorter

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.operators import ordering, redundancy, replicate, sizes
from corpusmill.plans import code, wiki
from corpusmill.plans.ledger import DONE, FAILED, Ledger
from corpusmill.session import PACKED, shuffles_removed
from corpusmill.sinks import copies
from corpusmill.sources import files, text
from corpusmill.streaming import ingest

BASE_BYTES = 100 * 1024**2  # fixed value: size of the duplicated base


@dataclass
class Inputs:
    """Where the raw material lies; a stage without its input is not run."""

    web: str | None = None
    dump: str | None = None
    records: DataFrame | None = None  # (pos, content)
    models: str | None = None
    manifest: list[str] = field(default_factory=list)
    base_bytes: int = BASE_BYTES
    target_bytes: int | None = None  # all records
    web_gate_gib: int = sizes.WEB_GATE_GIB  # web text and articles of at least so much are taken as they are
    wiki_gate_gib: int = sizes.WIKI_GATE_GIB
    rows_per_chunk: int = ordering.ROWS_PER_CHUNK


class Build:
    """Stages below ``root``: web, wiki, code, hot duplicates, near duplicates, append logs, models."""

    # stage -> the stage whose output it starts from
    NEEDS = {
        "web": None,
        "wiki": None,
        "code": None,
        "hot_duplicates": "web",
        "near_duplicates": "hot_duplicates",
        "append_logs": "web",
        "models": None,
    }

    def __init__(self, spark: SparkSession, root: str, inputs: Inputs):
        self.spark = spark
        self.root = root.rstrip("/")
        self.inputs = inputs
        self.ledger = Ledger(spark, f"{self.root}/_ledger")

    def run(self) -> list[str]:
        """Run what is not done and has its input; returns the stages that ran, in the order of ``NEEDS``."""
        order = TopologicalSorter({stage: [needed] if needed else [] for stage, needed in self.NEEDS.items()})
        order.prepare()
        ran, failed, there = set(), {}, set()
        running: dict[Future, str] = {}
        with shuffles_removed(self.spark), ThreadPoolExecutor(len(self.NEEDS)) as pool:
            while order.is_active():
                for stage in order.get_ready():
                    if self.ledger.is_done(stage):
                        there.add(stage)
                        order.done(stage)
                    elif (needed := self.NEEDS[stage]) and needed not in there:
                        order.done(stage)
                    else:
                        running[pool.submit(getattr(self, f"_{stage}"))] = stage
                if not running:
                    continue
                for future in wait(running, return_when=FIRST_COMPLETED).done:
                    stage = running.pop(future)
                    if future.exception() is not None:
                        failed[stage] = future.exception()
                    elif future.result():
                        self.ledger.mark(stage)
                        ran.add(stage)
                        there.add(stage)
                    order.done(stage)
        if failed:
            raise RuntimeError(f"failed: {', '.join(sorted(failed))}") from next(iter(failed.values()))
        return [stage for stage in self.NEEDS if stage in ran]

    def restart(self, stage: str) -> None:
        self.ledger.reset(stage)

    @property
    def _combined(self) -> str:
        return f"{self.root}/web/combined"

    def _web(self) -> bool:
        """New web files, once each, as lines that keep their file and place."""
        if self.inputs.web is None:
            return False
        if self._large_enough("web", self.inputs.web_gate_gib):
            return True
        ingest.collect_lines(
            ingest.new_lines(self.spark, self.inputs.web, full_path=True), self._combined, f"{self.root}/_checkpoints/web"
        )
        if self._web_lines().isEmpty():
            raise RuntimeError("the web stage produced no text")
        return True

    def _large_enough(self, category: str, gib: int) -> bool:
        """Whether what lies in a category's folder already is enough to be taken as it is."""
        return self._reports(category, gib).first()["reuse"]

    def _reports(self, category: str, gib: int) -> DataFrame:
        try:
            found = files.inventory(self.spark, f"{self.root}/{category}")
        except AnalysisException:  # there is no such folder yet
            found = self.spark.createDataFrame([], "length BIGINT")
        return sizes.at_least_gib(found, F.col("length"), gib)

    def _web_lines(self) -> DataFrame:
        """(file, block, seq, value) as ``sources.text`` orders streams; a file is read by one batch."""
        return self.spark.read.schema(ingest.COLLECTED_SCHEMA).parquet(self._combined)

    def _wiki(self) -> bool:
        if self.inputs.dump is None:
            return False
        if self._large_enough("wiki", self.inputs.wiki_gate_gib):
            return True
        parted = wiki.build(self.spark, self.inputs.dump, f"{self.root}/wiki", rejected=f"{self.root}/_rejects/wiki")
        parted.remove()  # shards and rejects are written
        if parted.n_rejected:
            self.ledger.mark("rejected", "wiki", str(parted.n_rejected))
        if files.inventory(self.spark, f"{self.root}/wiki", "*.json").isEmpty():
            raise RuntimeError("the dump held no article")
        return True

    def _code(self) -> bool:
        if self.inputs.records is None:
            return False
        code.build(
            self.spark, self.inputs.records, f"{self.root}/code", self.inputs.target_bytes, self.inputs.rows_per_chunk
        )
        return True

    @property
    def _base(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/synthetic/hot_duplicates/file=base.txt")

    def _hot_duplicates(self) -> bool:
        """The base prefix once as bytes, then its copies: the files a copying loop would leave."""
        folder = f"{self.root}/synthetic/hot_duplicates"
        base = text.head_bytes(self._web_lines(), self.inputs.base_bytes, written=True)
        base.write.mode("overwrite").options(**PACKED).parquet(f"{folder}/file={replicate.BASE_NAME}")
        copies = replicate.exact_copies(self._base).where("copy > 0").select("file", "pos", "piece")
        copies.write.mode("overwrite").options(**PACKED).option("partitionOverwriteMode", "dynamic").partitionBy("file").parquet(folder)
        return True

    def _near_duplicates(self) -> bool:
        blocks = redundancy.split_blocks(self._base, "piece", ["pos"])
        key = F.concat_ws(":", "pos", "block_no")
        varied = replicate.near_copies(blocks.where("block_no IS NOT NULL"), "block", key)
        name = F.format_string(replicate.VARIANT_NAME, "variant")
        varied.select(name.alias("file"), "pos", "block_no", F.col("flipped").alias("piece"), "flips").write.mode(
            "overwrite"
        ).options(**PACKED).partitionBy("file").parquet(f"{self.root}/synthetic/near_dupes")
        return True

    def _append_logs(self) -> bool:
        """Every line of every log, as one table with the log's file name as a column.

        A line's copies lie side by side, where the codec finds them; in a folder per log each would be packed anew.
        """
        lines = text.with_line_position(self._web_lines(), written=True)
        logs = replicate.append_logs(lines, "pos", "value")
        logs.write.mode("overwrite").options(**PACKED).parquet(f"{self.root}/synthetic/append_logs")
        return True

    def _models(self) -> bool:
        """Place the files of the listed models that are present; a missing one is recorded as failed, not done."""
        if not self.inputs.manifest:
            return False
        entries = self.spark.createDataFrame([(e,) for e in self.inputs.manifest], "entry string")
        identifier, description, folder = files.parse_manifest(F.col("entry"))
        wanted = entries.select(identifier.alias("id"), description.alias("description"), folder.alias("folder"))
        held = self.spark.createDataFrame([], "target STRING, copied BIGINT")
        if self.inputs.models:
            present = files.inventory(self.spark, self.inputs.models).where(files.without_extensions(F.col("path")))
            chosen = present.join(wanted.select(F.col("folder").alias("category")).distinct(), "category", "left_semi")
            held = copies.copy_files(chosen.withColumn("target", F.col("inside")), f"{self.root}/models")
        placed = held.groupBy(F.substring_index("target", "/", 1).alias("folder")).agg(
            F.count("*").alias("files"), F.sum("copied").alias("bytes")
        )
        listed = wanted.join(placed, "folder", "left").na.fill(0, ["files", "bytes"])
        listed.write.mode("overwrite").json(f"{self.root}/_models")
        status = F.when(F.col("files") > 0, DONE).otherwise(FAILED)
        self.ledger.mark_all(listed.select(F.lit("model").alias("stage"), F.col("folder").alias("key"), status.alias("status")))
        return True

    def report(self) -> DataFrame:
        """Bytes and files per category and in total."""
        found = files.inventory(self.spark, self.root).where(F.col("category").isin(*sizes.CATEGORIES))
        return sizes.with_all_categories(sizes.size_rollup(found, "category", "length"))
