import pandas as pd
from pyspark.sql import functions as F

from corpusmill.functions import tokens
from corpusmill.operators import batches
from corpusmill.session import spread


def frame(spark):
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(i % 90))) for i in range(203)]
    return rows, spark.createDataFrame(rows, "id BIGINT, text STRING")


def test_tokens_are_marked_and_limited(spark):
    df = spark.createDataFrame([("  Hello\n wORLD ",), ("",), ("a " * 500,)], "text STRING")
    ids = [r.input_ids for r in batches.tokenize(df, "text").collect()]
    assert [len(i) for i in ids] == [4, 2, 64]
    assert all(i[0] == tokens.CLS and i[-1] == tokens.SEP for i in ids)
    lower = spark.createDataFrame([("hello world",)], "text STRING")
    assert batches.tokenize(lower, "text").first().input_ids == ids[0]
    assert "text" not in batches.tokenize(df, "text").columns


def test_masking_hides_about_fifteen_percent_and_labels_only_that(spark):
    _, df = frame(spark)
    plain = {r.id: r.input_ids for r in batches.tokenize(df, "text").collect()}
    chosen = total = hidden = kept = 0
    for r in batches.mask(batches.tokenize(df, "text"), "id").collect():
        for before, after, label in zip(plain[r.id], r.input_ids, r.labels, strict=True):
            if before in (tokens.CLS, tokens.SEP):
                assert label == tokens.IGNORED and after == before
                continue
            total += 1
            if label == tokens.IGNORED:
                assert after == before
            else:
                assert label == before
                chosen += 1
                hidden += after == tokens.MASK
                kept += after == before
    assert 0.12 < chosen / total < 0.18
    assert 0.7 < hidden / chosen < 0.9 and 0.05 < kept / chosen < 0.16


def test_batches_are_padded_to_their_longest(spark):
    _, df = frame(spark)
    placed = batches.into_batches(batches.mask(batches.tokenize(df, "text"), "id"), "id")
    padded = batches.pad(placed).collect()
    by_batch = {}
    for r in padded:
        by_batch.setdefault(r.batch, []).append(r)
        assert len(r.input_ids) == len(r.labels) == len(r.attention_mask) == r.length
        used = sum(r.attention_mask)
        assert r.input_ids[used - 1] == tokens.SEP and set(r.input_ids[used:]) <= {tokens.PAD}
        assert set(r.labels[used:]) <= {tokens.IGNORED}
    assert sorted(len(v) for v in by_batch.values()) == [3] + [8] * 25
    assert all(max(sum(r.attention_mask) for r in rows) == rows[0].length for rows in by_batch.values())


def test_batches_without_targets_are_skipped_but_counted(spark):
    rows = [(0, [-100, 5]), (0, [-100]), (1, [-100, -100]), (2, [7, 8])]
    df = spark.createDataFrame(rows, "batch BIGINT, labels ARRAY<INT>")
    assert {r.batch: (r.rows, r.targets) for r in batches.valid_batches(df).collect()} == {0: (2, 1), 2: (1, 2)}
    losses = spark.createDataFrame([(3.0,), (None,), (6.0,)], "loss DOUBLE")
    assert batches.mean_over_all(losses, F.col("loss")).first() == (3, 2, 3.0)


def test_non_finite_values_are_found(spark):
    rows = [(0, [1.0, 2.0]), (1, [float("nan")]), (2, [float("inf"), 0.0]), (3, [float("-inf")])]
    df = spark.createDataFrame(rows, "id BIGINT, v ARRAY<FLOAT>")
    got = {r.id: r for r in batches.non_finite(df, "v").collect()}
    assert [got[i].non_finite for i in range(4)] == [False, True, True, True]
    assert (got[0].lowest, got[0].highest) == (1.0, 2.0)


def test_user_functions(spark):
    rows, df = frame(spark)

    def count(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"id": part["id"], "text": part["text"], "n": part["text"].str.len()})

    mapped = batches.map_batches(df, count, "id BIGINT, text STRING, n BIGINT", drop=("text",))
    assert {r.id: r.n for r in mapped.collect()} == {i: len(t) for i, t in rows}

    def total(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"batch": part["batch"].iloc[:1], "n": [len(part)]})

    collated = batches.collate_batches(batches.into_batches(df.drop("text"), "id"), total, "batch BIGINT, n BIGINT")
    assert sorted(r.n for r in collated.collect()) == [3] + [8] * 25


def test_collated_batches_are_carried_over_arrow_batches(spark):
    """Whatever an Arrow batch holds, the function sees each batch whole and once, by one narrow pass after the sort."""
    rows = spark.range(5000).selectExpr("id", "id % 7 * 1000 + id % 90 AS batch")
    want = {r.batch: r.n for r in rows.groupBy("batch").agg(F.count("*").alias("n")).collect()}

    def whole(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"batch": part["batch"].iloc[:1], "n": [len(part)], "kinds": [part["batch"].nunique()]})

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "13")
    collated = batches.collate_batches(rows, whole, "batch BIGINT, n BIGINT, kinds BIGINT")
    got = collated.collect()
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {r.batch: r.n for r in got} == want and len(got) == len(want) and {r.kinds for r in got} == {1}
    plan = collated._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" in plan and "FlatMapGroups" not in plan
    assert batches.collate_batches(rows.limit(0), whole, "batch BIGINT, n BIGINT, kinds BIGINT").count() == 0


def test_rows_of_one_row_group_are_dealt_to_all_cores(spark, tmp_path):
    """Spark cuts the file into more splits than cores, of which one reads all rows."""
    spark.range(4000).selectExpr("id AS doc_id", "sha2(string(id), 512) AS text").coalesce(1).write.parquet(f"{tmp_path}/one")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        for folder, moved in ((f"{tmp_path}/one", True), (None, False)):
            table = spark.read.parquet(folder) if folder else spark.range(4000, numPartitions=40)
            assert table.rdd.getNumPartitions() >= 8
            dealt = spread(table)
            rows = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
            assert sum(rows) == 4000 and max(rows) <= 2 * 4000 / 8 and (dealt is table) != moved
            assert dealt.distinct().count() == 4000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
