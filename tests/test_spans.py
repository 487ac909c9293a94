"""Text files read as fixed spans, against Python's own reading."""

import gzip
import random

import pytest

from corpusmill.sources import spans
from corpusmill.session import work_folder


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    """Plain and gzip files with empty lines, long lines, no last newline, several members."""
    folder, rng = tmp_path_factory.mktemp("lines"), random.Random(1)
    text = lambda n: b"\n".join(b"x\xc3\xa9" * rng.randint(0, 40) for _ in range(n))
    contents = {
        "a.txt": text(300) + b"\n", "b.txt.gz": text(200) + b"\n", "c.txt": b"", "d.txt": text(5) + b"\n\n" + b"L" * 5000,
        "e.txt.gz": b"no end", "f.txt": b"\n", "g h%20+é.txt": b"one\n", "i#j?.txt.gz": b"two\nthree\n",
    }
    for name, raw in contents.items():
        half = len(raw) // 2
        (folder / name).write_bytes(gzip.compress(raw[:half]) + gzip.compress(raw[half:]) if name.endswith("gz") else raw)
    lines = [line for _, raw in sorted(contents.items()) for line in raw.removesuffix(b"\n").split(b"\n") if raw]
    return folder, lines


@pytest.mark.parametrize("span_bytes", [7, 100, 1 << 20])
def test_positions_do_not_depend_on_the_spans(spark, files, monkeypatch, span_bytes):
    monkeypatch.setattr(spans, "BLOCK_BYTES", 64)
    folder, lines = files
    found = spans.spans_of(spark, f"file://{folder}", span_bytes=span_bytes)
    rows = spans.with_position(spark, found).collect()
    assert [r.value.encode() for r in sorted(rows, key=lambda r: r.pos)] == lines
    assert sorted(r.pos for r in rows) == list(range(len(lines)))


@pytest.mark.parametrize("span_bytes", [50, 1 << 20])
def test_the_head_is_exact_and_stops(spark, files, span_bytes):
    folder, lines = files
    whole = b"".join(line + b"\n" for line in lines)
    found = spans.spans_of(spark, f"file://{folder}", span_bytes=span_bytes)
    for n in (0, 1, 77, len(whole) // 3, len(whole) - 1, len(whole), len(whole) + 10):
        pieces = sorted((r.pos, bytes(r.piece)) for r in spans.head_bytes(spark, found, n).collect())
        assert b"".join(p for _, p in pieces) == whole[:n] and [p for p, _ in pieces] == list(range(len(pieces)))


def test_a_span_reads_no_more_than_asked(files, monkeypatch):
    """The reader stops within a block of what the head needs."""
    folder, _ = files
    monkeypatch.setattr(spans, "BLOCK_BYTES", 32)
    for name in ("a.txt", "b.txt.gz"):
        got = [line for part in spans._lines(spans.Span(0, f"file://{folder}/{name}", 0, None, 100)) for line in part]
        assert 100 <= sum(len(line) + 1 for line in got) < 250


def test_the_files_beyond_the_head_are_not_opened(spark, tmp_path):
    """Damaged files behind the head don't matter, at either number of files."""
    for n_files in (4, 16):
        folder = tmp_path / str(n_files)
        folder.mkdir()
        for k in range(n_files):
            raw = gzip.compress(random.Random(k).randbytes(3000).hex().encode() + b"\n")
            (folder / f"{k:02d}.gz").write_bytes(raw if k < 3 else b"damaged" + raw[7:])
        found = spans.spans_of(spark, f"file://{folder}")
        assert sum(len(r.piece) for r in spans.head_bytes(spark, found, 6005).collect()) == 6005


def test_tolerant_reading_reports_what_is_damaged(spark, tmp_path):
    whole = gzip.compress(b"".join(b"line %d\n" % k for k in range(50_000)), mtime=0)
    (tmp_path / "cut.gz").write_bytes(whole[: len(whole) // 2])
    (tmp_path / "good.gz").write_bytes(gzip.compress(b"fine\n"))
    (tmp_path / "no.gz").write_bytes(b"not gzip at all")
    found = spans.spans_of(spark, f"file://{tmp_path}")
    rows = spans.read_spans(spark, found, tolerant=True).collect()
    causes = {found[r.part].path.rsplit("/", 1)[1]: r.cause for r in rows if r.cause}
    assert set(causes) == {"cut.gz", "no.gz"} and "EOFError" in causes["cut.gz"] and "BadGzipFile" in causes["no.gz"]
    read = [bytes(r.value) for r in rows if r.cause is None and found[r.part].path.endswith("cut.gz")]
    assert 0 < len(read) < 50_000 and read == [b"line %d" % k for k in range(len(read))]
    with pytest.raises(Exception, match="EOFError|BadGzipFile"):
        spans.read_spans(spark, found).collect()


def test_nothing_to_read(spark):
    folder = work_folder(spark, "no-lines")
    spark.range(0).selectExpr("cast(id as string)").write.text(folder)
    found = spans.spans_of(spark, folder)
    assert spans.with_position(spark, found).count() == 0 and spans.head_bytes(spark, found, 5).count() == 0
