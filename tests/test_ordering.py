import random

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import ordering


def table(spark, keys, seed=3):
    random.seed(seed)
    rows = [(k, random.randint(0, 50)) for k in keys]
    shuffled = random.sample(rows, len(rows))
    return rows, spark.createDataFrame(shuffled, "k BIGINT, size BIGINT").repartition(5)


KEYS = {
    "dense": list(range(300)),
    "gaps": sorted(random.Random(1).sample(range(10**6), 400)),
    "wide": sorted(random.Random(2).sample(range(2**50), 300)),
    "negative": list(range(-200_000, 200_000, 1_000)),
    "mixed": list(range(70_000, 70_200)) + list(range(200_000, 220_000, 100)),
}


@pytest.mark.parametrize("kind", KEYS)
def test_positions_and_totals(spark, kind):
    rows, frame = table(spark, KEYS[kind])
    rows.sort()
    positions = {r.k: r.pos for r in ordering.with_position(frame, "k").collect()}
    assert positions == {k: i for i, (k, _) in enumerate(rows)}
    totals = {r.k: r.before_b for r in ordering.running_totals(frame, "k", {"b": F.col("size")}).collect()}
    before, expected = 0, {}
    for k, size in rows:
        expected[k] = before
        before += size
    assert totals == expected


@pytest.mark.parametrize("keys", [[1, 1, 3, None], [1, 2, None], [1, 1, 3], [1, 1, 3, 4], [5, 5, 5, 90_000]])
def test_null_and_repeated_keys_are_refused(spark, keys):
    frame = spark.createDataFrame([(k,) for k in keys], "k BIGINT")
    with pytest.raises(Exception, match="null order key" if None in keys else "repeated order key"):
        ordering.with_position(frame, "k").collect()
    with pytest.raises(Exception, match="null order key" if None in keys else "repeated order key"):
        ordering.running_totals(frame, "k", {"rows": F.lit(1)}).collect()


def exchanges_with(plan, column):
    """Exchanges of a physical plan that move a column."""
    if plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.initialPlan()
    children = plan.children()
    below = sum(exchanges_with(children.apply(i), column) for i in range(children.size()))
    return below + (plan.nodeName() == "Exchange" and f"{column}#" in plan.output().mkString(","))


@pytest.mark.parametrize("unit", [1, 7])
@pytest.mark.parametrize("kind", [*KEYS, "one", "none"])
def test_groups_hold_whole_units_of_ranked_rows_that_moved_once(spark, kind, unit):
    rows, frame = table(spark, KEYS.get(kind, [5] if kind == "one" else [])) if kind != "none" else ([], spark.createDataFrame([], "k BIGINT, size BIGINT"))
    found = ordering.in_groups(frame, "k", unit=unit)
    got = found.withColumn("part", F.spark_partition_id()).collect()
    assert {r.k: (r.pos, r.size) for r in got} == {k: (i, s) for i, (k, s) in enumerate(sorted(rows))}
    assert len(got) == len(rows)
    parts, groups = {}, {}
    for r in got:
        parts.setdefault(r.group, set()).add(r.part)
        groups.setdefault(r.pos // unit, set()).add(r.group)
    assert all(len(p) == 1 for p in parts.values()) and all(len(g) == 1 for g in groups.values())
    assert len(parts) == (0 if kind == "none" else 1) or len(parts) > 20
    wide = ordering.in_groups(frame.repartition(3, "k").withColumn("text", F.col("k").cast("string")), "k", unit=unit)
    assert exchanges_with(wide._jdf.queryExecution().executedPlan(), "text") == 1


def test_groups_part_keys_that_only_their_ties_tell_apart(spark):
    rows = [(k, f"t{t:02d}") for k in (3, 3_000_000) for t in range(90)] + [(7, None)]
    frame = spark.createDataFrame(random.Random(4).sample(rows, len(rows)), "k BIGINT, t STRING").repartition(5)
    got = ordering.in_groups(frame, "k", ("t",), 2).collect()
    assert {(r.k, r.t): r.pos for r in got} == {r: i for i, r in enumerate(sorted(rows, key=lambda r: (r[0], r[1] or "")))}
    assert len({r.group for r in got}) > 20


@pytest.mark.parametrize("keys", [[1, 2, None], [1, 1, 3]])
def test_groups_refuse_null_and_repeated_keys(spark, keys):
    frame = spark.createDataFrame([(k,) for k in keys], "k BIGINT")
    with pytest.raises(Exception, match="null order key" if None in keys else "repeated order key"):
        ordering.in_groups(frame, "k").collect()


def test_ties_are_broken_by_the_further_columns(spark):
    frame = spark.createDataFrame([(1, "b"), (1, "a"), (0, "z"), (1, "c")], "k BIGINT, t STRING")
    got = {r.t: r.pos for r in ordering.with_position(frame, "k", ("t",)).collect()}
    assert got == {"z": 0, "a": 1, "b": 2, "c": 3}


@pytest.mark.parametrize("kind", ["dense", "wide", "mixed"])
def test_budget_is_the_minimal_prefix(spark, kind):
    rows, frame = table(spark, KEYS[kind])
    rows.sort()
    total = sum(s for _, s in rows)
    for budget in (0, total // 3, total, total + 5):
        expected, before = [], 0
        for k, size in rows:
            if before >= budget:
                break
            expected.append(k)
            before += size
        got = sorted(r.k for r in ordering.within_budget(frame, "k", F.col("size"), budget).collect())
        assert got == expected, budget


def test_budget_may_be_overshot_by_the_last_record(spark):
    frame = spark.createDataFrame([(i, 30) for i in range(10)], "k BIGINT, size BIGINT")
    got = ordering.within_budget(frame, "k", F.col("size"), 100)
    assert sorted(r.k for r in got.collect()) == [0, 1, 2, 3]


def test_budget_on_a_written_table_is_a_pushed_down_filter(spark, tmp_path):
    spark.range(1000).withColumn("size", F.lit(8)).write.parquet(str(tmp_path / "t"))
    kept = ordering.within_budget(spark.read.parquet(str(tmp_path / "t")), "id", F.col("size"), 800)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(id,99)" in plan and "Exchange" not in plan


def test_byte_prefix_is_byte_exact(spark):
    lines = ["añ", "", "bcd", "漢字", "end"]
    stream = "".join(line + "\n" for line in lines).encode()
    frame = spark.createDataFrame(list(enumerate(lines)), "k BIGINT, t STRING")
    for n in (0, 2, 5, 11, len(stream), len(stream) + 3):
        pieces = ordering.byte_prefix(frame, "k", "t", n).orderBy("k").collect()
        assert b"".join(bytes(p.piece) for p in pieces) == stream[:n]


def test_milestones(spark):
    frame = spark.createDataFrame([(i, 1024**2) for i in range(250)], "k BIGINT, size BIGINT")
    got = ordering.milestones(frame, "k", F.col("size"), 512 * 1024**2).orderBy("pos").collect()
    assert [(r.pos, r.total_bytes, r.gib, r.percent) for r in got] == [
        (0, 1024**2, 0.0, 0.2), (100, 101 * 1024**2, 0.1, 19.7), (200, 201 * 1024**2, 0.2, 39.3),
    ]


def test_shards_wrap_into_the_last_folder(spark):
    pos = [0, 99, 100, 9_999, 10_000, 259_999, 260_000, 270_150]
    frame = spark.createDataFrame([(p,) for p in pos], "pos BIGINT").withColumns(ordering.shard_columns())
    got = [(r.dir, r.file) for r in frame.orderBy("pos").collect()]
    assert got == [
        ("AA", "wiki_00"), ("AA", "wiki_00"), ("AA", "wiki_01"), ("AA", "wiki_99"), ("BB", "wiki_00"),
        ("ZZ", "wiki_99"), ("ZZ", "wiki_00"), ("ZZ", "wiki_01"),
    ]


def test_shuffle_is_a_permutation_that_ignores_partitioning(spark):
    one = ordering.seeded_shuffle(spark.range(500).repartition(1), "id", 42)
    many = ordering.seeded_shuffle(spark.range(500).repartition(13), "id", 42)
    order = {r.id: r.pos for r in one.collect()}
    assert order == {r.id: r.pos for r in many.collect()}
    assert sorted(order.values()) == list(range(500)) and order != {i: i for i in range(500)}
    other = {r.id: r.pos for r in ordering.seeded_shuffle(spark.range(500), "id", 43).collect()}
    assert other != order


def records_read(spark, group, work):
    """Rows that the tasks of a piece of work read from files."""
    context = spark.sparkContext
    context.setJobGroup(group, group)
    result = work()
    tracker, store = context.statusTracker(), context._jsc.sc().statusStore()
    stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
    read = 0
    for stage in stages:
        try:
            read += store.lastStageAttempt(stage).inputRecords()
        except Exception:  # a skipped stage has no attempt
            continue
    context.setLocalProperty("spark.jobGroup.id", None)
    return result, read


def test_a_budget_reads_about_what_it_takes(spark, tmp_path, monkeypatch):
    """The same budget on tables of 200,000 and 800,000 rows reads the same number of rows."""
    monkeypatch.setattr(ordering, "PROBE_KEYS", 1000)
    counts = {}
    for n in (200_000, 800_000):
        path = str(tmp_path / str(n))
        spark.range(0, n, 1, n // 5000).selectExpr("id AS k", "id % 50 + 1 AS size").write.parquet(path)
        table = spark.read.parquet(path)
        for start, budget in ((0, 300_000), (100_000, 300_000)):
            rest = table.where(F.col("k") >= start)
            name = f"budget-{n}-{start}"
            cut, counts[n, start] = records_read(spark, name, lambda: ordering.budget_cut(rest, "k", F.col("size"), budget, start))  # noqa: B023
            total, expected = 0, start - 1
            while total < budget:
                expected += 1
                total += expected % 50 + 1
            assert cut == ordering.Cut(expected, total - expected % 50 - 1)
    taken = 300_000 / 25.5
    assert all(read < 6 * taken + 10 * 5000 for read in counts.values()), counts
    assert counts[800_000, 0] <= counts[200_000, 0] + 20_000 and counts[800_000, 100_000] <= counts[200_000, 100_000] + 20_000
    everything = ordering.within_budget(table, "k", F.col("size"), 10**9)
    assert everything.count() == 800_000
