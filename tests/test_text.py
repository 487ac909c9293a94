import random

from pyspark.sql import functions as F

from corpusmill.functions import frames, names, text


def python_truncate(value: str, limit: int) -> str:
    raw = value.encode()[:limit]
    return raw.decode(errors="ignore")


def test_truncation_keeps_characters_whole(spark):
    random.seed(1)
    values = ["".join(random.choices("aé漢😀", k=random.randint(0, 30))) for _ in range(500)]
    frame = spark.createDataFrame([(v,) for v in values], "t STRING")
    for limit in (4, 5, 6, 7, 20):
        for row in frame.select("t", text.truncate_bytes(F.col("t"), limit).alias("c")).collect():
            assert row.c == python_truncate(row.t, limit)
            assert len(row.c.encode()) <= limit and row.t.startswith(row.c)


def test_minimum_counts_bytes(spark):
    frame = spark.createDataFrame([("é" * 50,), ("e" * 99,)], "t STRING")
    assert [r[0] for r in frame.select(text.long_enough(F.col("t"))).collect()] == [True, False]


def test_malformed_bytes_are_dropped_and_replacement_characters_kept(spark):
    raws = [b"ok", b"a\xffb", b"\xef\xbf\xbd", b"x\xef\xbf\xbd\xc3y\xef\xbf\xbd", b"", "é漢".encode(), b"\x01b\xff\x01a"]
    frame = spark.createDataFrame([(bytearray(r),) for r in raws], "b BINARY")
    got = [bytes(r[0]) for r in frame.select(text.encodable_bytes(F.col("b").cast("string"))).collect()]
    assert got == [r.decode("utf-8", errors="ignore").encode() for r in raws]


def test_frame_header(spark):
    for content in (b"", b"hi", bytes(range(256)) * 300):
        frame = spark.createDataFrame([(bytearray(content),)], "b BINARY")
        row = frame.select(frames.frame(F.col("b")), frames.framed_size(F.col("b"))).first()
        assert bytes(row[0]) == len(content).to_bytes(8, "little") + content
        assert row[1] == len(content) + 8


def test_names(spark):
    paths = {"a/b": ("b", "a"), "a": ("a", "."), "/a": ("a", "/"), "/a/b/": ("b", "/a"), "a//b": ("b", "a"), "/": ("/", "/")}
    frame = spark.createDataFrame([(p,) for p in paths], "p STRING")
    for row in frame.select("p", names.basename(F.col("p")).alias("b"), names.dirname(F.col("p")).alias("d")).collect():
        assert (row.b, row.d) == paths[row.p], row.p


def test_human_sizes_round_up(spark):
    expected = {
        0: "0", 1023: "1023", 1024: "1.0K", 1025: "1.1K", 10 * 1024: "10K", 10 * 1024 + 1: "11K",
        1024**2 - 1: "1.0M", 5 * 1024**3: "5.0G", 1024**5: "1.0P",
    }
    frame = spark.createDataFrame([(n,) for n in expected], "n BIGINT")
    for row in frame.select("n", names.human_size(F.col("n")).alias("s")).collect():
        assert row.s == expected[row.n], row.n
