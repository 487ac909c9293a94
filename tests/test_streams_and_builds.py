import bz2
import gzip
import hashlib
import pathlib
import random
import time

import pytest
from pyspark.sql import functions as F

from corpusmill.plans import staged, wiki
from corpusmill.plans.ledger import Ledger
from corpusmill.session import SHUFFLES_GO, shared_root, shuffles_removed, work_folder
from corpusmill.sinks import chunks
from corpusmill.streaming import blockstore, ingest
from corpusmill.streaming import chunks as stream_chunks


def put(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(gzip.compress("".join(f"{line}\n" for line in lines).encode()))


def test_each_file_is_taken_in_once(spark, tmp_path):
    source, target, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    put(source, "a.gz", ["1", "2"])

    def run():
        ingest.append_new(ingest.new_lines(spark, str(source), "*.gz"), target, state)
        return sorted((r.file, r.value) for r in spark.read.schema("file STRING, value STRING").json(target).collect())

    assert run() == [("a.gz", "1"), ("a.gz", "2")]
    assert run() == [("a.gz", "1"), ("a.gz", "2")]
    put(source, "b.gz", ["3"])
    put(source, "ignored.txt", ["4"])
    assert run() == [("a.gz", "1"), ("a.gz", "2"), ("b.gz", "3")]


def documents(spark, rows):
    return spark.createDataFrame(rows, "id BIGINT, text STRING")


def stored(spark, folder):
    blocks = sorted((bytes(r.block), bytes(r.fp) == hashlib.sha256(bytes(r.block)).digest()) for r in blockstore.read_blocks(spark, folder).collect())
    return blocks, blockstore.read_recipe(spark, folder).count()


def test_block_store_keeps_only_unseen_blocks(spark, tmp_path):
    source, folder, state = str(tmp_path / "in"), work_folder(spark, "grown"), str(tmp_path / "state")
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema("id BIGINT, text STRING").option("maxFilesPerTrigger", 1).parquet(source)
    for rows, blocks, used in (
        ([(1, "a\nb\n"), (2, "a\n")], [b"a\n", b"b\n"], 3),
        ([(3, "b\nc\n"), (4, ""), (5, None)], [b"a\n", b"b\n", b"c\n"], 5),
        ([(6, "hot\n" * 9000)], [b"a\n", b"b\n", b"c\n", b"hot\n"], 9005),
    ):
        documents(spark, rows).coalesce(1).write.mode("append").parquet(source)
        for _ in range(2):  # the second run finds nothing new
            blockstore.grow_store(stream, "id", "text", folder, state, None)
            assert stored(spark, folder) == ([(b, True) for b in blocks], used)


def test_block_store_survives_the_replay_of_a_batch(spark, tmp_path):
    """A batch whose commit was lost runs again: its blocks are neither lost nor stored twice."""
    source, folder, state = str(tmp_path / "in"), work_folder(spark, "replayed"), tmp_path / "state"
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema("id BIGINT, text STRING").option("maxFilesPerTrigger", 1).parquet(source)
    for rows in ([(1, "a\nb\n")], [(2, "b\nc\n")]):
        documents(spark, rows).coalesce(1).write.mode("append").parquet(source)
        blockstore.grow_store(stream, "id", "text", folder, str(state), None)
    for query in ("blocks", "recipe"):
        commits = state / query / "commits"
        last = max((int(p.name) for p in commits.iterdir() if p.name.isdigit()))
        for name in (str(last), f".{last}.crc"):
            (commits / name).rename(tmp_path / f"{query}-{name}")
    documents(spark, [(3, "c\nd\n")]).coalesce(1).write.mode("append").parquet(source)
    blockstore.grow_store(stream, "id", "text", folder, str(state), None)
    assert stored(spark, folder) == ([(b, True) for b in (b"a\n", b"b\n", b"c\n", b"d\n")], 6)


def test_no_batch_reads_the_stored_blocks(spark, tmp_path):
    """The only files in the plan are the stream's."""
    source = str(tmp_path / "in")
    documents(spark, [(1, "a\n")]).write.parquet(source)
    stream = spark.readStream.schema("id BIGINT, text STRING").parquet(source)
    plan = blockstore.unseen_blocks(stream, "text", None)._jdf.queryExecution().analyzed().toString()
    assert plan.count("StreamingRelation") == 1 and "Join" not in plan and "Deduplicate" in plan


def test_chunk_stream_replay_changes_nothing(spark):
    folder = work_folder(spark, "stream")
    batch = documents(spark, [(i, f"text {i}") for i in range(25)])
    for _ in range(2):
        stream_chunks.add_batch(batch, 0, "id", "text", folder, 10)
    got = chunks.read_chunks(spark, folder).orderBy("chunk_file", "row_in_chunk").collect()
    assert [bytes(r.content).decode() for r in got] == [f"text {i}" for i in range(25)]
    assert got[-1].chunk_file == "batch_00000/stream_00002.bin"


def test_ledger_remembers_the_latest_event(spark):
    ledger = Ledger(spark, work_folder(spark, "ledger"))
    assert not ledger.is_done("web")
    ledger.mark("web")
    ledger.mark("model", "a_b", "failed")
    assert ledger.is_done("web") and ledger.is_done("model", "a_b") and not ledger.is_done("model")
    ledger.reset("web")
    assert not ledger.is_done("web")
    assert [(r.stage, r.key, r.status) for r in ledger.state().collect()] == [("model", "a_b", "failed")]


@pytest.fixture
def inputs(spark, tmp_path):
    put(tmp_path / "web", "a.wet.gz", [f"web line {i}" for i in range(200)])
    put(tmp_path / "web", "b.wet.gz", ["last"])
    pages = "".join(
        f"<page><title>T{i}</title><ns>0</ns><id>{i}</id><revision><text>{'word ' * 30}{i}</text></revision></page>"
        for i in range(30)
    )
    (tmp_path / "dump.xml.bz2").write_bytes(bz2.compress(f"<m>{pages}</m>".encode()))
    (tmp_path / "models" / "owner_model").mkdir(parents=True)
    (tmp_path / "models" / "owner_model" / "w.bin").write_bytes(b"x" * 9)
    (tmp_path / "models" / "owner_model" / "r.md").write_bytes(b"x")
    return staged.Inputs(
        web=str(tmp_path / "web"),
        dump=str(tmp_path / "dump.xml.bz2"),
        records=spark.range(40).select(F.col("id").alias("pos"), F.concat(F.lit("code "), "id").alias("content")),
        models=str(tmp_path / "models"),
        manifest=["owner/model|A model", "gone/model|Missing"],
        base_bytes=1_000,
        rows_per_chunk=15,
    )


def test_stages_run_once_restart_alone_and_report(spark, inputs):
    build = staged.Build(spark, work_folder(spark, "build"), inputs)
    assert build.run() == list(staged.Build.NEEDS)
    assert build.run() == []
    failed = build.ledger.state().where("status = 'failed'").collect()
    assert [(r.stage, r.key) for r in failed] == [("model", "gone_model")]
    base = build._base.orderBy("pos").collect()
    stream = "".join(f"web line {i}\n" for i in range(200)).encode()
    assert b"".join(bytes(r.piece) for r in base) == stream[:1_000]
    copies = spark.read.parquet(f"{build.root}/synthetic/hot_duplicates")
    assert copies.select("file").distinct().count() == 11 and copies.count() == 11 * len(base)
    variants = spark.read.parquet(f"{build.root}/synthetic/near_dupes")
    assert variants.select("file").distinct().count() == 5
    logs = spark.read.parquet(f"{build.root}/synthetic/append_logs")
    assert logs.count() == 5 * (201 + 10)

    def contents():
        read = {n: spark.read.parquet(f"{build.root}/synthetic/{n}") for n in ("hot_duplicates", "near_dupes", "append_logs")}
        counts = {n: df.groupBy("file").count().orderBy("file").collect() for n, df in read.items()}
        return counts, spark.read.parquet(build._combined).count(), spark.read.json(f"{build.root}/wiki").count()

    before = contents()
    build.restart("append_logs")
    assert build.run() == ["append_logs"]
    for stage in ("web", "wiki", "code", "hot_duplicates"):
        build.restart(stage)
    assert build.run() == ["web", "wiki", "code", "hot_duplicates"]
    assert contents() == before
    report = {r.category: (r.total_bytes, r.files) for r in build.report().collect()}
    assert report["code"] == (sum(8 + len(f"code {i}") for i in range(40)), 3)
    assert report["wiki"][1] == 1 and all(report[c][1] > 0 for c in report)
    assert report["ALL"][0] == sum(v[0] for c, v in report.items() if c != "ALL")


def test_tables_of_whole_texts_are_packed(spark, inputs):
    """A build writes its text many times over, so its tables are written with the denser codec."""
    build = staged.Build(spark, work_folder(spark, "build"), inputs)
    build.run()
    root = pathlib.Path(build.root.removeprefix("file://"))
    for folder in ("web/combined", "synthetic/hot_duplicates", "synthetic/near_dupes", "synthetic/append_logs"):
        parts = list((root / folder).rglob("*.parquet"))
        assert parts and all(p.name.endswith(".zstd.parquet") for p in parts)


def test_append_logs_are_whole_and_take_the_room_of_about_one(spark, inputs, tmp_path):
    """Each log holds all lines of the web and what was appended; their copies are packed together."""
    generator = random.Random(5)
    lines = ["".join(generator.choices("0123456789abcdef", k=generator.randint(0, 400))) for _ in range(4_000)]
    put(tmp_path / "long", "a.gz", lines[:2_500])
    put(tmp_path / "long", "b.gz", lines[2_500:])
    inputs.web, inputs.dump, inputs.records, inputs.models = str(tmp_path / "long"), None, None, None
    build = staged.Build(spark, work_folder(spark, "build"), inputs)
    build.run()
    for _ in range(2):
        logs = spark.read.parquet(f"{build.root}/synthetic/append_logs")
        found = {}
        for r in logs.orderBy("file", "part", "seq").collect():
            found.setdefault((r.log, r.file), []).append(r.line)
        expected = lines + [f"LOG ENTRY {j}" for j in range(1, 11)]
        assert found == {(i, f"log_{i}.txt"): expected for i in range(1, 6)}
        root = pathlib.Path(build.root.removeprefix("file://"))
        size = {n: sum(p.stat().st_size for p in (root / n).rglob("*.parquet")) for n in ("web/combined", "synthetic/append_logs")}
        assert size["synthetic/append_logs"] < 2 * size["web/combined"]
        build.restart("append_logs")
        assert build.run() == ["append_logs"]


def shuffle_files(spark):
    found = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    names = (found.apply(i).getName() for i in range(found.size()))
    return {name for name in names if name.startswith("shuffle_") and name.endswith(".data")}


def test_a_build_leaves_no_shuffle_files(spark, inputs):
    before = shuffle_files(spark)
    build = staged.Build(spark, work_folder(spark, "build"), inputs)
    assert build.run() == list(staged.Build.NEEDS)
    until = time.time() + 20  # they are removed behind the query's back
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    frame = spark.range(100).groupBy((F.col("id") % 7).alias("k")).count()
    assert spark.conf.get(SHUFFLES_GO) == "false"
    with shuffles_removed(spark):
        assert len(frame.collect()) == len(frame.collect()) == frame.count() == 7
    spark.conf.set(SHUFFLES_GO, "true")
    with pytest.raises(ZeroDivisionError), shuffles_removed(spark):
        1 / 0  # noqa: B018
    assert spark.conf.get(SHUFFLES_GO) == "true"
    spark.conf.set(SHUFFLES_GO, "false")


def test_a_build_keeps_its_articles_as_shards_only(spark, inputs):
    """The table that shards and rejects are written from is gone after that, and only that one."""
    shared = pathlib.Path(shared_root(spark).removeprefix("file://"))
    before = set(shared.iterdir())
    build = staged.Build(spark, work_folder(spark, "build"), inputs)
    build.run()
    assert not [p for p in set(shared.iterdir()) - before if p.name.startswith("articles-")]
    assert before <= set(shared.iterdir())
    shards = spark.read.json(f"{build.root}/wiki").collect()
    assert sorted((r.id, r.text) for r in shards) == sorted((str(i), "word " * 30 + str(i)) for i in range(30))
    parted = wiki.build(spark, inputs.dump, f"{build.root}/again")
    assert parted.kept.count() == parted.n_kept == 30  # a caller's own


def test_partial_builds_run_what_has_its_input(spark, inputs):
    web, inputs.web = inputs.web, None
    build = staged.Build(spark, work_folder(spark, "build"), inputs)
    assert build.run() == ["wiki", "code", "models"]
    assert build.run() == []
    inputs.web = web
    assert build.run() == ["web", "hot_duplicates", "near_duplicates", "append_logs"]


def test_a_failed_stage_keeps_only_its_dependants_back(spark, inputs, tmp_path):
    put(tmp_path / "empty", "a.gz", [])
    inputs.web = str(tmp_path / "empty")
    build = staged.Build(spark, work_folder(spark, "build"), inputs)
    with pytest.raises(RuntimeError, match="failed: web") as raised:
        build.run()
    assert "no text" in str(raised.value.__cause__)
    done = {r.stage for r in build.ledger.state().where("status = 'done' AND key = ''").collect()}
    assert done == {"wiki", "code", "models"}
    put(tmp_path / "empty", "b.gz", ["some", "text"])
    assert build.run() == ["web", "hot_duplicates", "near_duplicates", "append_logs"]


def test_model_files_are_placed_whole(spark, inputs, tmp_path):
    inputs.web = inputs.dump = inputs.records = None
    (tmp_path / "models" / "owner_model" / "deep").mkdir()
    (tmp_path / "models" / "owner_model" / "deep" / "v.bin").write_bytes(bytes(range(256)) * 1000)
    (tmp_path / "models" / "owner_model" / "z.gz").write_bytes(gzip.compress(b"kept as it is"))
    (tmp_path / "models" / "unlisted").mkdir()
    (tmp_path / "models" / "unlisted" / "w.bin").write_bytes(b"y")
    build = staged.Build(spark, work_folder(spark, "build"), inputs)
    assert build.run() == ["models"]
    root = pathlib.Path(build.root.removeprefix("file://")) / "models"
    placed = {str(p.relative_to(root)): p.read_bytes() for p in root.rglob("*") if p.is_file() and p.suffix != ".crc"}
    zipped = placed.pop("owner_model/z.gz")
    assert gzip.decompress(zipped) == b"kept as it is"
    assert placed == {"owner_model/w.bin": b"x" * 9, "owner_model/deep/v.bin": bytes(range(256)) * 1000}
    report = {r.category: (r.total_bytes, r.files) for r in build.report().collect()}
    assert report["models"] == report["ALL"] == (256_009 + len(zipped), 3)


def test_a_category_that_is_large_enough_is_taken_as_it_is(spark, inputs):
    inputs.web_gate_gib = inputs.wiki_gate_gib = 0  # whatever is there will do
    build = staged.Build(spark, work_folder(spark, "build"), inputs)
    inputs.web = None
    documents(spark, [(1, "kept")]).write.json(f"{build.root}/wiki")
    assert "wiki" in build.run()
    assert [r.text for r in spark.read.json(f"{build.root}/wiki").collect()] == ["kept"]


def test_malformed_pages_are_counted_and_reported(spark, inputs, tmp_path):
    good = f"<page><title>T</title><ns>0</ns><id>1</id><revision><text>{'word ' * 30}</text></revision></page>"
    (tmp_path / "bad.xml").write_text(f"<m>{good}<page><id>2</title></page>{good.replace('>1<', '>3<')}<page><title>T</m></page>")
    parted = wiki.build(spark, str(tmp_path / "bad.xml"), str(tmp_path / "out"), rejected=str(tmp_path / "rejects"))
    assert (parted.n_kept, parted.n_rejected) == (2, 2)
    assert sorted(r.id for r in spark.read.json(str(tmp_path / "out")).collect()) == ["1", "3"]
    found = spark.read.json(str(tmp_path / "rejects")).collect()
    assert len(found) == 2 and all(r.file.endswith("bad.xml") and r.cause == "malformed page" for r in found)
    assert any("<id>2</title>" in r.raw for r in found)


def test_counted_batches_keep_every_batch(spark, tmp_path):
    for k in range(6):  # the setting below keeps two progress updates only
        path = tmp_path / "in" / f"{k:03d}.txt"
        path.parent.mkdir(exist_ok=True)
        path.write_text("ab\ncde\n")
    lines = ingest.new_lines(spark, str(tmp_path / "in"), files_per_batch=1)
    out, rows = str(tmp_path / "out"), str(tmp_path / "rows")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    for _ in range(2):  # the second run finds nothing new
        ingest.append_counted(lines, out, rows, str(tmp_path / "state"))
        total = spark.read.parquet(rows).selectExpr("count(*)", "sum(records)", "sum(bytes)").first()
        assert tuple(total) == (6, 12, 30) and spark.read.json(out).count() == 12
    spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
