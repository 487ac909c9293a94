"""URL filters by a temporal list join.

A list is a log of dated entries: on ``listed_at``, ``pattern`` was added to or removed from a list. The entries of a
(list, kind, pattern) become validity intervals, each ending where the next entry begins, and every capture is
evaluated as of its fetch time against the intervals of the patterns it can match: its host and the domains above
it (``domain``), the host alone (``host``), and the host with each leading part of its path (``prefix``).

A capture is exploded into a bounded number of keys (as many as its URL has labels and path parts), without its page.
The join is an equality on the key with the interval as a condition, so that a host with a large share of all
captures is split by the skew join; its matches are combined per capture before the next shuffle.

Host names are compared in lower case, paths as they are written.

Defined results: a null or unparsable URL or a null fetch time matches nothing; entries with a null field are ignored;
of entries with the same pattern and time a removal wins, and repeated ones count once; repeated captures give a row
each; empty tables give an empty or an unmatched result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KINDS = ("domain", "host", "prefix")


def intervals(entries: DataFrame) -> DataFrame:
    """(list_name, kind, pattern, valid_from, valid_to) in which a pattern is listed; an open end is null.

    ``entries`` has list_name, kind, pattern, listed_at and action (``add`` or ``remove``). Host names are lowered before
    the entries of a pattern are put together, so a removal ends what an addition in another case began.
    """
    named = entries.select("list_name", "kind", normal_pattern("pattern").alias("pattern"), "listed_at", "action")
    known = named.dropna().where(
        F.col("kind").isin(*KINDS) & F.col("action").isin("add", "remove")
    )
    dated = known.groupBy("list_name", "kind", "pattern", "listed_at").agg(F.max("action").alias("action"))
    order = Window.partitionBy("list_name", "kind", "pattern").orderBy("listed_at")
    ended = dated.withColumn("valid_to", F.lead("listed_at").over(order))
    return ended.where("action = 'add'").select(
        "list_name", "kind", "pattern", F.col("listed_at").alias("valid_from"), "valid_to"
    )


def normal_pattern(pattern: str) -> F.Column:
    """A pattern with its host in lower case; the case of a path counts."""
    host = F.lower(F.substring_index(pattern, "/", 1))
    return F.concat(host, F.substring(F.col(pattern), F.length(F.substring_index(pattern, "/", 1)) + 1, F.length(pattern)))


def url_parts(url: str) -> tuple[F.Column, F.Column]:
    """Host (lower case, without user and port) and path (without query and fragment) of a URL column."""
    rest = F.regexp_extract(F.col(url), r"\A[A-Za-z][A-Za-z0-9+.-]*://([^?#]*)", 1)
    host = F.lower(F.regexp_extract(rest, r"\A(?:[^/@]*@)?([^/:]+)", 1))
    path = F.regexp_extract(rest, r"\A[^/]*(/.*)\z", 1)
    return host, path


def evaluate(captures: DataFrame, listed: DataFrame, id_col: str, url_col: str, time_col: str) -> DataFrame:
    """Per capture its id, fetch time, ``n_matches``, the ``lists`` it is on (sorted, distinct) and ``blocked``."""
    host, path = url_parts("_url")
    rows = captures.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), F.col(time_col).alias("_at"))
    split = rows.distinct().withColumn("_host", host).withColumn(
        "_parts", F.filter(F.split(path, "/"), lambda p: p != "")
    )
    labels = F.split("_host", r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    prefixes = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size("_parts"), F.lit(1))),
        lambda i: F.concat_ws("/", F.col("_host"), F.slice("_parts", F.lit(1), i)),
    )
    keyed = lambda kind, values: F.transform(values, lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("pattern")))
    keys = F.array_distinct(
        F.concat(keyed("domain", domains), keyed("host", F.array("_host")), keyed("prefix", prefixes))
    )
    exploded = split.where("_host <> '' and _at is not null").select("_id", "_url", "_at", F.inline(keys))
    matched = exploded.join(
        listed,
        (exploded["kind"] == listed["kind"])
        & (exploded["pattern"] == listed["pattern"])
        & (F.col("_at") >= F.col("valid_from"))
        & (F.col("valid_to").isNull() | (F.col("_at") < F.col("valid_to"))),
    )
    found = matched.groupBy("_id", "_url", "_at").agg(
        F.count("*").alias("n_matches"), F.array_join(F.sort_array(F.collect_set("list_name")), ",").alias("lists")
    )
    own = found.select(*[F.col(c).alias(f"f{c}") for c in ("_id", "_url", "_at")], "n_matches", "lists")
    same = F.lit(True)
    for c in ("_id", "_url", "_at"):
        same = same & F.col(c).eqNullSafe(F.col(f"f{c}"))
    return rows.join(own, same, "left").select(
        F.col("_id").alias(id_col),
        F.col("_at").alias(time_col),
        F.coalesce("n_matches", F.lit(0)).cast("bigint").alias("n_matches"),
        F.coalesce("lists", F.lit("")).alias("lists"),
        F.col("n_matches").isNotNull().alias("blocked"),
    )
