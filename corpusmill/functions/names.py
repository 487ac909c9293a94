"""Path, file-name and size formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Output naming and units.
CHUNK_NAME = "stream_%05d.bin"
SHARD_NAME = "wiki_%02d"
EPOCH_NAME = "epoch_%03d.pt"
GIB = 1024**3
SIZE_UNITS = ("K", "M", "G", "T", "P")


def _no_trailing_slash(path: Column) -> Column:
    return F.regexp_replace(path, "(?<=.)/++$", "")


def basename(path: Column) -> Column:
    """Last path component; trailing slashes do not count, and ``/`` is its own name."""
    return F.regexp_replace(_no_trailing_slash(path), "^.*/(?=.)", "")


def dirname(path: Column) -> Column:
    """Everything before the last component, or ``.`` when there is nothing before it."""
    cut = _no_trailing_slash(path)
    parent = F.regexp_replace(cut, "(?<=.)/++[^/]++$", "")
    return (
        F.when(~cut.contains("/"), ".")
        .when(cut.rlike("^/++[^/]*$"), "/")
        .otherwise(parent)
    )


def with_prefix(prefix: str, path: Column) -> Column:
    return F.concat(F.lit(prefix), path)


def safe_name(name: Column) -> Column:
    return F.replace(name, F.lit("/"), F.lit("_"))


def chunk_name(chunk: Column) -> Column:
    return F.format_string(CHUNK_NAME, chunk)


def shard_name(file_no: Column) -> Column:
    return F.format_string(SHARD_NAME, file_no)


def epoch_name(epoch: Column) -> Column:
    return F.format_string(EPOCH_NAME, epoch)


def double_letter(index: Column) -> Column:
    """0 -> AA, 1 -> BB, ..."""
    letter = F.char(F.lit(ord("A")) + index)
    return F.concat(letter, letter)


def whole_gib(n_bytes: Column) -> Column:
    return F.call_function("div", n_bytes, F.lit(GIB))


def gib(n_bytes: Column) -> Column:
    return F.round(n_bytes / GIB, 2)


def percent_of(n_bytes: Column, target_bytes: int | Column) -> Column:
    return F.round(n_bytes * 100 / target_bytes, 1)


def human_size(n_bytes: Column) -> Column:
    """Rounded up to one decimal below ten units, to a whole number above, as ``du -h`` prints."""
    shown = F.when(n_bytes < 1024, n_bytes.cast("string"))
    for power, unit in enumerate(SIZE_UNITS, start=1):
        size = 1024**power
        tenths = _divided_up(n_bytes * 10, size)
        whole = _divided_up(n_bytes, size)
        decimal = F.concat(
            F.call_function("div", tenths, F.lit(10)).cast("string"), F.lit("."), (tenths % 10).cast("string")
        )
        fits = whole < 1024 if power < len(SIZE_UNITS) else F.lit(True)
        shown = shown.when(fits & (tenths < 100), F.concat(decimal, F.lit(unit)))
        shown = shown.when(fits, F.concat(whole.cast("string"), F.lit(unit)))
    return shown


def _divided_up(n: Column, size: int) -> Column:
    return F.call_function("div", n + (size - 1), F.lit(size))
