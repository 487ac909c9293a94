import bz2
import gzip
import random

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import sizes
from corpusmill.plans import wiki
from corpusmill.sources import files, mediawiki, tables, text

LONG = "word " * 30


def page(title, page_id, body, ns="0", extra="", text_open="<text bytes='1' xml:space='preserve'>"):
    return (
        f"  <page>\n    <title>{title}</title>\n    <ns>{ns}</ns>\n    <id>{page_id}</id>\n    {extra}"
        f"<revision><id>9{page_id}</id><contributor><id>77</id></contributor>{text_open}{body}</text></revision>\n  </page>\n"
    )


PAGES = [
    page("Plain", 1, LONG),
    page("Self-closing redirect", 2, LONG, extra='<redirect title="Plain" />\n'),
    page("Talk", 3, LONG, ns="1"),
    page("Empty", 4, ""),
    page("A &amp; B", 5, f"&lt;ref&gt;cite&lt;/ref&gt;{LONG} &quot;q&quot; &amp;amp; x"),
    page("Short", 6, "x" * 99),
    page("Just enough", 7, "x" * 100),
    page("Multibyte cut", 8, "x" * 9_999 + "漢字" * 10),
    page("Template", 9, "{{a{{b}}}}" + LONG, text_open="<text>"),
    page("Comment", 10, f"&lt;!-- one\nline --&gt;{LONG}"),
    page("Bytes count", 11, "é" * 50),
]


@pytest.fixture(params=["plain", "bz2"])
def dump(request, tmp_path):
    xml = "<mediawiki>\n<siteinfo><sitename>S</sitename></siteinfo>\n" + "".join(PAGES) + "</mediawiki>\n"
    path = tmp_path / ("dump.xml" if request.param == "plain" else "dump.xml.bz2")
    path.write_bytes(xml.encode() if request.param == "plain" else bz2.compress(xml.encode()))
    return str(path)


def test_dump_pages_and_articles(spark, dump):
    pages = mediawiki.read_pages(spark, dump)
    assert pages.count() == len(PAGES)
    assert mediawiki.malformed(pages).count() == 0
    assert sorted(int(r.id) for r in mediawiki.articles(pages).collect()) == [1, 5, 6, 7, 8, 9, 10, 11]
    got = {r.id: r for r in wiki.extract(spark, dump).collect()}
    assert set(got) == {"1", "5", "7", "8", "9", "10", "11"}
    assert got["5"].title == "A & B" and got["5"].text == LONG + '"q" &amp; x'
    assert got["8"].text == "x" * 9_999
    assert got["9"].text == "}}" + LONG.strip()
    assert got["1"].text == LONG.strip()


def test_last_revision_with_text_wins(spark, tmp_path):
    revisions = "".join(f"<revision><id>{i}</id><text>{t}</text></revision>" for i, t in enumerate(["old", "new", ""]))
    (tmp_path / "d.xml").write_text(f"<m><page><title>T</title><ns>0</ns><id>1</id>{revisions}</page></m>")
    assert mediawiki.read_pages(spark, str(tmp_path / "d.xml")).first().text == "new"


def test_malformed_pages_are_counted_not_fatal(spark, tmp_path):
    bad = "<page><title>bad</titel><ns>0</ns><id>5</id></page>"
    (tmp_path / "d.xml").write_text("<m>" + PAGES[0] + bad + PAGES[6] + "</m>")
    pages = mediawiki.read_pages(spark, str(tmp_path / "d.xml"))
    assert mediawiki.malformed(pages).count() == 1
    assert mediawiki.articles(pages).count() == 2


@pytest.mark.parametrize("packed", [False, True])
@pytest.mark.parametrize("split_bytes", [20_011, 50_000])
def test_dump_is_read_in_parallel_and_whole(spark, tmp_path, packed, split_bytes):
    """Split points fall anywhere, also into the separator; bzip2 blocks end anywhere too."""
    generator = random.Random(split_bytes)
    bodies = ["".join(generator.choices("abcdefgh ", k=generator.randint(100, 6_000))) for _ in range(700)]
    xml = ("<m>" + "".join(page(f"P{i}", i, body) for i, body in enumerate(bodies)) + "</m>").encode()
    path = tmp_path / ("d.xml.bz2" if packed else "d.xml")
    path.write_bytes(bz2.compress(xml, 1) if packed else xml)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    try:
        pages = mediawiki.read_pages(spark, str(path))
        assert pages.rdd.getNumPartitions() > 4
        got = {int(r.id): r.text for r in pages.select("id", "text").collect()}
        assert pages.count() == 700 and got == dict(enumerate(bodies))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_cleaning_rules_appear_once_in_the_plan(spark, dump):
    plan = wiki.extract(spark, dump)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("(?Ud)") == 12 and plan.count("from_xml") <= 1 and plan.count("XmlToStructs") <= 1


def lines_of(path_bytes: bytes) -> list[str]:
    parts = path_bytes.split(b"\n")
    return [p.decode() for p in (parts[:-1] if parts[-1] == b"" else parts)]


def test_stream_order_positions_and_head(spark, tmp_path):
    """Plain files split at small blocks, and a gzip file of two members."""
    contents = [
        b"".join(f"file0 line {i} \xc3\xa9\r\n".encode("latin-1") for i in range(300)),
        b"second\n\nthird\n",
        b"".join(f"file2 {i}\n".encode() for i in range(200)),
    ]
    (tmp_path / "a.txt").write_bytes(contents[0])
    (tmp_path / "b.txt.gz").write_bytes(gzip.compress(contents[1][:7]) + gzip.compress(contents[1][7:]))
    (tmp_path / "c.txt").write_bytes(contents[2])
    stream = b"".join(contents)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        lines = text.read_lines(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 5
        got = [r.value for r in text.with_line_position(lines).orderBy("pos").collect()]
        assert got == lines_of(stream)
        positions = [r.pos for r in text.with_line_position(lines).orderBy("pos").collect()]
        assert positions == list(range(len(got)))
        for n in (0, 1, 1_500, 6_321, len(stream) - 1, len(stream), len(stream) + 10):
            pieces = text.head_bytes(lines, n).orderBy("pos").collect()
            assert b"".join(bytes(p.piece) for p in pieces) == stream[:n]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_no_line_is_lost_when_the_files_would_be_split_differently_later(spark, tmp_path):
    """Also two files of one name, and a file that arrives after the lines were placed."""
    contents = {"x/part.txt": "x", "y/part.txt": "y", "z.txt": "z"}
    for name, letter in contents.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("".join(f"{letter}{i}\n" for i in range(20_000)))
    paths = [str(tmp_path / name) for name in contents]
    setting = "spark.sql.files.minPartitionNum"
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    spark.conf.set(setting, "3")
    try:
        placed = text.with_line_position(text.read_lines(spark, *paths))
        spark.conf.set(setting, "29")
        got = placed.orderBy("pos").collect()
    finally:
        spark.conf.unset(setting)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [r.pos for r in got] == list(range(60_000))
    assert [r.value for r in got] == [f"{letter}{i}" for letter in "xyz" for i in range(20_000)]


def test_path_list_takes_the_first(spark, tmp_path):
    (tmp_path / "paths.gz").write_bytes(gzip.compress("".join(f"crawl/seg/{i:04d}.wet.gz\n" for i in range(250)).encode()))
    lines = text.with_line_position(text.read_lines(spark, str(tmp_path / "paths.gz")))
    got = text.path_list(lines, "https://h/").orderBy("pos").collect()
    assert len(got) == 100 and got[99].url == "https://h/crawl/seg/0099.wet.gz" and got[99].name == "0099.wet.gz"


def test_unreadable_inputs_are_skipped_and_reported(spark, tmp_path):
    (tmp_path / "good.gz").write_bytes(gzip.compress(b"a\nb\n"))
    (tmp_path / "bad.gz").write_bytes(b"\x1f\x8b not gzip at all")
    assert sorted(r.value for r in text.read_lines(spark, str(tmp_path), tolerant=True).collect()) == ["a", "b"]
    wanted = spark.createDataFrame([("good.gz",), ("gone.gz",)], "name STRING")
    found = files.inventory(spark, str(tmp_path)).select(F.substring_index("path", "/", -1).alias("name"))
    assert [r.name for r in text.rejects(wanted, found).collect()] == ["gone.gz"]
    done = spark.createDataFrame([("good.gz",)], "name STRING")
    assert [r.name for r in text.not_done(wanted, done, "name").collect()] == ["gone.gz"]


def test_inventory_categories_sizes_and_exclusions(spark, tmp_path):
    for name, n in {"web/a.txt": 10, "web/deep/b.md": 20, "models/m/x.h5": 5, "models/m/y.bin": 7, "top.txt": 1}.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"x" * n)
    found = files.inventory(spark, str(tmp_path))
    assert "content" not in found._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]
    got = {r.category: (r.total_bytes, r.files) for r in sizes.with_all_categories(sizes.size_rollup(found, "category", "length")).collect()}
    assert got == {"web": (30, 2), "wiki": (0, 0), "code": (0, 0), "synthetic": (0, 0), "models": (12, 2), "ALL": (43, 5)}
    kept = found.where(files.without_extensions(F.col("path"))).select("inside").collect()
    assert sorted(r.inside for r in kept) == ["models/m/y.bin", "top.txt", "web/a.txt"]
    assert files.inventory(spark, str(tmp_path), "*.txt").count() == 2


def test_manifest_keeps_further_separators(spark):
    identifier, description, folder = files.parse_manifest(F.col("e"))
    df = spark.createDataFrame([("owner/model|A|B",), ("plain",)], "e STRING")
    assert [tuple(r) for r in df.select(identifier, description, folder).collect()] == [
        ("owner/model", "A|B", "owner_model"), ("plain", "", "plain"),
    ]


def test_size_gate_counts_whole_gib(spark):
    df = spark.createDataFrame([(2**30,), (2**30 - 1,)], "n BIGINT")
    assert sizes.at_least_gib(df, F.col("n"), 1).first() == (2**31 - 1, 1, True)
    assert sizes.at_least_gib(df, F.col("n"), 2).first().reuse is False
    assert sizes.at_least_gib(df.limit(0), F.col("n"), 1).first() == (0, 0, False)
    assert sizes.present(df.limit(0), F.col("n")).first() == (False, False)
    assert sizes.present(df, F.lit(0)).first() == (True, False)


def test_record_stream_reads_one_field(spark, tmp_path):
    spark.range(5).selectExpr("id AS n", "'c' AS body", "'unused' AS other").write.parquet(str(tmp_path / "t"))
    stream = tables.record_stream(spark, str(tmp_path / "t"), "body", "n")
    assert stream.columns == ["pos", "content"] and stream.count() == 5
    assert "other" not in stream._jdf.queryExecution().executedPlan().toString()
