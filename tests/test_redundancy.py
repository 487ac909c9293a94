import hashlib
import random

from pyspark.sql import functions as F

from corpusmill import session
from corpusmill.functions.corruption import flip_low_bits
from corpusmill.operators import redundancy, replicate, skew
from corpusmill.operators.skew import join_per_key
from corpusmill.plans import catalog
from corpusmill.session import work_folder
from corpusmill.sinks import store


def python_blocks(text: str, size: int | None) -> list[bytes]:
    raw = text.encode()
    if size is None:
        return raw.splitlines(keepends=True) if b"\r" not in raw else [p for p in raw.split(b"\n")]
    return [raw[i : i + size] for i in range(0, len(raw), size)]


def corpus(seed: int = 1) -> list[tuple[int, str, str]]:
    random.seed(seed)
    words = ["aé", "漢字", "line\n", "same ", "\n", "x"]
    rows = [(i, f"g{i % 3}", "".join(random.choices(words, k=random.randint(0, 60)))) for i in range(60)]
    hot = "boilerplate " * 40
    return rows + [(100 + i, "g0", hot) for i in range(30)] + [(200, "g1", ""), (201, "empty", "")]


def test_blocks_and_statistics_match_brute_force(spark):
    rows = corpus()
    frame = spark.createDataFrame(rows, "id BIGINT, grp STRING, text STRING")
    for size in (7, 64, None):
        got = redundancy.block_statistics(frame.withColumnRenamed("grp", "g"), "g", "text", size)
        got = {r.grp: r for r in got.collect()}
        groups = {g: [t for _, gg, t in rows if gg == g] for g in {r[1] for r in rows}}
        groups["ALL"] = [t for _, _, t in rows]
        assert set(got) == set(groups)
        for name, texts in groups.items():
            blocks = [b for t in texts for b in python_blocks(t, size)]
            row = got[name]
            assert row.files == len(texts)
            assert row.raw_bytes == sum(len(t.encode()) for t in texts)
            assert (row.total_blocks, row.unique_blocks) == (len(blocks), len(set(blocks)))
            assert row.stored_bytes == sum(len(b) for b in set(blocks))


def test_copies_add_nothing_and_logs_little(spark):
    base = "".join(random.Random(2).choices("abcdefgh\n", k=50_000))
    frame = spark.createDataFrame([(0, base)], "id BIGINT, text STRING")
    alone = redundancy.block_statistics(frame.withColumn("g", F.lit("a")), "g", "text").where("grp = 'ALL'").first()
    copies = replicate.exact_copies(frame).withColumn("g", F.lit("a"))
    assert copies.count() == 11
    with_copies = redundancy.block_statistics(copies, "g", "text").where("grp = 'ALL'").first()
    assert with_copies.stored_bytes == alone.stored_bytes and with_copies.raw_bytes == 11 * alone.raw_bytes
    logs = replicate.append_logs(frame, "id", "text")
    assert logs.where("part = 1").count() == 50
    assert logs.where("log = 3").orderBy("part", "seq").select("line").collect()[-1][0] == "LOG ENTRY 10"
    stats = redundancy.block_statistics(logs.withColumn("g", F.lit("a")), "g", "line").where("grp = 'ALL'").first()
    assert stats.stored_bytes < stats.raw_bytes / 4.9


def python_flip(data: bytes, key: str, seed: int) -> tuple[bytes, int]:
    out, touched = bytearray(data), {}
    for k in range(1, len(data) // 100 + 1):
        at = int(hashlib.md5(f"{seed}:{key}:{k}".encode()).hexdigest()[:15], 16) % len(data)
        out[at] ^= 1
        touched[at] = touched.get(at, 0) + 1
    return bytes(out), sum(n % 2 for n in touched.values())


def test_flips_match_brute_force(spark):
    random.seed(4)
    rows = [(i, bytearray(random.randbytes(n))) for i, n in enumerate([0, 1, 99, 100, 101, 250, 4096, 4096, 9_000])]
    frame = spark.createDataFrame(rows, "id BIGINT, data BINARY").withColumn("seed", F.lit(43))
    flipped = flip_low_bits(frame, "data", F.col("id").cast("string"), F.col("seed")).collect()
    for row in flipped:
        assert (bytes(row.flipped), row.flips) == python_flip(bytes(rows[row.id][1]), str(row.id), 43)


def test_near_copies_share_small_blocks_but_no_large_ones(spark):
    text = "".join(random.Random(6).choices("abcdefghij ", k=80_000))
    frame = spark.createDataFrame([(1, text)], "id BIGINT, text STRING")
    blocks = redundancy.split_blocks(frame, "text", ["id"])
    varied = replicate.near_copies(blocks, "block", F.concat_ws(":", "id", "block_no"))

    def overlap(size: int) -> list:
        base = redundancy.split_blocks(frame, "text", ["id"], size)
        base = base.select("id", redundancy.fingerprint(F.col("block")).alias("fp"))
        pieces = redundancy.split_blocks(varied, "flipped", ["id", "variant"], size)
        pieces = pieces.select("id", "variant", redundancy.fingerprint(F.col("block")).alias("fp"))
        return redundancy.variant_overlap(base, pieces, "id", "variant", replicate.VARIANTS).collect()

    small, large = overlap(32), overlap(4096)
    assert len(small) == len(large) == 5
    assert all(0.4 < r.jaccard < 0.8 for r in small)
    assert all(r.shared_blocks <= 1 for r in large)


def test_variant_overlap_takes_any_number_of_variants(spark, monkeypatch):
    monkeypatch.setattr(redundancy, "VARIANT_BITS", 2)
    base = spark.createDataFrame([(1, b"a"), (1, b"b")], "id BIGINT, fp BINARY")
    rows = [(1, v, b"a") for v in range(1, 6)] + [(1, 5, b"b"), (1, 4, b"c")]
    variants = spark.createDataFrame(rows, "id BIGINT, variant BIGINT, fp BINARY")
    got = redundancy.variant_overlap(base, variants, "id", "variant", 5).orderBy("variant").collect()
    assert [(r.variant, r.variant_blocks, r.shared_blocks) for r in got] == [
        (1, 1, 1), (2, 1, 1), (3, 1, 1), (4, 2, 1), (5, 2, 2),
    ]


def test_variant_overlap_counts(spark):
    base = spark.createDataFrame([(1, b"a"), (1, b"b"), (1, b"b"), (2, b"a")], "id BIGINT, fp BINARY")
    variants = spark.createDataFrame(
        [(1, 1, b"a"), (1, 1, b"c"), (1, 2, b"a"), (1, 2, b"b"), (2, 1, b"z"), (2, 2, b"a"), (2, 2, b"a")],
        "id BIGINT, variant BIGINT, fp BINARY",
    )
    got = {
        (r.id, r.variant): (r.base_blocks, r.variant_blocks, r.shared_blocks, r.jaccard)
        for r in redundancy.variant_overlap(base, variants, "id", "variant", 2).collect()
    }
    assert got == {
        (1, 1): (2, 2, 1, 0.333333), (1, 2): (2, 2, 2, 1.0), (2, 1): (1, 1, 0, 0.0), (2, 2): (1, 1, 1, 1.0),
    }


def test_exact_duplicates(spark):
    rows = [(1, "a"), (2, "b"), (3, "a"), (4, "a"), (5, "ccc"), (6, "ccc"), (7, None), (8, None)]
    frame = spark.createDataFrame(rows, "id BIGINT, text STRING")
    got = {r.first_id: (r.copies, r.total_bytes, r.surplus_bytes, r.digest) for r in redundancy.exact_duplicates(frame, "id", "text").collect()}
    assert got == {
        1: (3, 3, 2, hashlib.sha256(b"a").hexdigest()), 5: (2, 6, 3, hashlib.sha256(b"ccc").hexdigest()),
    }


def test_salted_join_keeps_every_row_of_hot_keys(spark):
    rows = spark.range(30_000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    counts = rows.groupBy("k").agg(F.count("*").alias("n"))
    joined = join_per_key(rows, counts, "k", "n", ("id",), hot_keys=5, least_share=1_000)
    assert joined.count() == 30_000
    assert joined.where("k = 0").agg(F.count("*"), F.min("n"), F.max("n")).first() == (10_000, 10_000, 10_000)


def test_store_restores_every_record(spark):
    rows = corpus(9)
    frame = spark.createDataFrame(rows, "id BIGINT, grp STRING, text STRING")
    for size in (16, None):
        folder = work_folder(spark, "store")
        store.write_store(frame, "id", "text", folder, size)
        got = {r.id: bytes(r.content) for r in store.restored_records(spark, folder, "id").collect()}
        assert got == {i: t.encode() for i, _, t in rows}


def test_salts_follow_the_weight(spark):
    """Keys of a third, a tenth and a hundredth of all rows are dealt in shares of about the same size."""
    rows = spark.range(100_000).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 'third' WHEN id % 10 = 1 THEN 'tenth' WHEN id % 100 = 2 THEN 'few' ELSE string(id) END AS k"
    )
    counts = rows.groupBy("k").agg(F.count("*").alias("n"))
    joined = join_per_key(rows, counts, "k", "n", ("id",), hot_keys=100, least_share=10)
    dealt, keys = skew._salted(rows, counts, "k", "n", ("id",), 100, 10)
    held = dealt.groupBy("k", "_salt").agg(F.count("*").alias("n")).collect()
    assert max(r.n for r in held) < 1_200 and sum(r.n for r in held) == 100_000
    assert {r.k: r.s for r in keys.where("length(k) < 6 AND k > 'a'").groupBy("k").agg(F.count("*").alias("s")).collect()} == {
        "third": 34, "tenth": 7, "few": 1,
    }
    assert joined.groupBy("k").agg(F.count("*").alias("c"), F.max("n").alias("n")).where("c <> n").count() == 0
    assert joined.count() == 100_000
    empty = join_per_key(rows.limit(0), counts.limit(0), "k", "n", ("id",))
    assert empty.count() == 0


def test_group_stores_and_the_whole(spark):
    rows = [*corpus(3), (300, None, "null group\n")]
    frame = spark.createDataFrame(rows, "id BIGINT, grp STRING, text STRING")
    folder = work_folder(spark, "stores")
    store.write_group_stores(frame, "grp", "id", "text", folder, None)
    sizes = {(r.grp, r.is_total): (r.unique_blocks, r.stored_bytes) for r in store.group_store_sizes(spark, folder, "grp").collect()}
    for group in {r[1] for r in rows} - {"empty"}:
        blocks = {b for _, g, t in rows if g == group for b in python_blocks(t, None)}
        assert sizes[group, False] == (len(blocks), sum(map(len, blocks)))
    blocks = {b for *_, t in rows for b in python_blocks(t, None)}
    assert sizes["ALL", True] == (len(blocks), sum(map(len, blocks)))
    got = {r.id: bytes(r.content) for r in store.restored_records(spark, f"{folder}/whole", "id").collect()}
    assert got == {i: t.encode() for i, _, t in rows}


def test_a_task_compares_the_variants_of_a_bounded_share(spark, tmp_path, monkeypatch):
    """More text makes more partitions, not larger ones."""
    text = F.concat_ws(" ", *[F.sha2(F.concat_ws("-", "id", F.lit(k)), 512) for k in range(8)])
    spark.range(600).select(F.col("id").alias("doc_id"), text.alias("text")).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(session, "DEALT_BYTES", 20_000)
    found = catalog.near_duplicate_overlap(spark, str(tmp_path))
    found.write.parquet(f"{tmp_path}/out")
    assert found.rdd.getNumPartitions() >= 600 * 1031 // 20_000
    assert spark.read.parquet(f"{tmp_path}/out").count() == 600 * replicate.VARIANTS
