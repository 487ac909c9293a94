"""Near-duplicate vectors by NN-descent.

1. Equal vectors of a label form one class; only classes are compared, and a class's size counts for its links.
2. First neighbour lists: tables of sign codes of random planes put the vectors of a label in orders in which similar
   ones are close; blocks of ``BLOCK`` consecutive vectors, half overlapping, are compared. There are as many tables as
   a pair at the threshold needs to meet in one with probability 1 - ``MISSED``, by the size of the largest label.
3. NN-descent: the vectors in a node's list and those that have it in theirs meet at the node and are compared;
   every vector keeps the ``NEIGHBOURS`` best. A node that very many lists name meets them in groups of ``GROUP``.
   A round ends with the components of the pairs at or above the threshold, its links.
4. Each round is audited: a bounded sample of ``AUDITED`` vectors is compared with all others of their label, and the
   share of the links found there whose ends are in one component is the recall. Rounds go on until it reaches
   ``RECALL``. One that changes less than ``STOP_SHARE`` of the list entries without reaching it is followed by further
   tables, as many as there have been. They bring pairs together that no neighbour has in common, and where lists are
   full of closer neighbours, each vector's best link to another component is kept beside them.
5. A list all of whose entries are links is saturated: it may be too short. Such lists are enlarged to the whole
   component: its members are compared in blocks of ``BLOCK``, and every member counts its links, so no pair is
   written and no task holds a component.

Vectors are scaled by their largest component before their length is taken, so that neither overflows nor vanishes.

Cosines are in double precision. Vectors that are null, zero, hold null or non-finite components, or whose label is
null link with nothing, nor do vectors of different lengths. Repeated ids give a row each. An empty table gives an
empty result. Only the named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.components import components
from corpusmill.session import materialized, ship_package

THRESHOLD = 0.93
NEIGHBOURS, CODE_BITS, BLOCK, GROUP = 8, 24, 256, 32
STOP_SHARE, EMIT, SEED = 0.002, 3, 11
AUDITED, RECALL, MISSED = 4096, 0.999, 0.05
# Cosines this close to the threshold may come out on either side of it, by the order of additions.
ROUNDING = 1e-9
LIST_SCHEMA = "src bigint, dst bigint, sim double"


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column whose lists are equally long as rows of unit vectors."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return _units(values.reshape(len(column), -1))


def _units(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _top(ids: np.ndarray, sims: np.ndarray, k: int, floor: np.ndarray | None = None) -> list[np.ndarray]:
    """(src, dst, sim) of each row's ``k`` best other members, if above the row's ``floor``."""
    n = len(ids)
    if n < 2:
        return []
    np.fill_diagonal(sims, -2.0)
    k = min(k, n - 1)
    best = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    value = np.take_along_axis(sims, best, axis=1)
    keep = np.ones_like(value, bool) if floor is None else value > floor[:, None]
    rows = np.nonzero(keep)[0]
    return [ids[rows], ids[best[keep]], value[keep]]


def _rows(found: list[list[np.ndarray]]) -> pa.RecordBatch:
    found = [f for f in found if f]
    columns = [np.concatenate([f[i] for f in found]) if found else np.zeros(0) for i in range(3)]
    types = [pa.int64(), pa.int64(), pa.float64()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c.astype(t.to_pandas_dtype()), t) for c, t in zip(columns, types, strict=True)],
        names=["src", "dst", "sim"],
    )


def _usable(vec: str, label: str) -> F.Column:
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(label).isNotNull() & F.col(vec).isNotNull() & finite & F.exists(vec, lambda x: x != 0)


def _first_lists(nodes: DataFrame, tables: range, threshold: float) -> DataFrame:
    """(src, dst, sim): neighbours of ``nodes`` (cid, label, vec, component) in the orders of these tables.

    A vector's best link to another component comes beside its best neighbours.
    """

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.diff(batch.column(2).offsets.to_numpy())
            for size in np.unique(lengths):
                part = batch.filter(pa.array(lengths == size))
                x = _matrix(part.column(2))
                for t in tables:
                    planes = np.random.default_rng([SEED, t]).normal(size=(int(size), CODE_BITS))
                    code = ((x @ planes > 0) @ (1 << np.arange(CODE_BITS)[::-1])).astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column(0),
                            pa.array(np.full(len(x), f"{t}:{size}:"), pa.string()),
                            part.column(1),
                            pa.array(code, pa.int64()),
                            part.column(2),
                            part.column(3),
                        ],
                        names=["cid", "part", "label", "code", "vec", "component"],
                    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        last = None

        def block() -> list[list[np.ndarray]]:
            ids, component, x = (np.array([h[k] for h in held]) for k in range(3))
            sims = x @ x.T
            apart = np.where(component[:, None] == component[None], -2.0, sims)
            other = apart.argmax(axis=1)
            best = apart[np.arange(len(ids)), other]
            far = best >= threshold
            return [_top(ids, sims, NEIGHBOURS), [ids[far], ids[other[far]], best[far]]]

        for batch in batches:
            found = []
            for cid, part, vec, component in zip(
                *(batch.column(k).to_pylist() for k in (0, 1)), batch.column(2), batch.column(3).to_pylist(), strict=True
            ):
                if part != last or len(held) == BLOCK:
                    if len(held) > 1:
                        found += block()
                    held = held[BLOCK // 2 :] if part == last else []
                    last = part
                x = vec.values.to_numpy(zero_copy_only=False).astype(np.float64)
                held.append((cid, component, _units(x[None])[0]))
            yield _rows(found)
        if len(held) > 1:
            yield _rows(block())

    kind = nodes.schema["vec"].dataType.simpleString()
    coded = nodes.select("cid", F.col("label").cast("string"), "vec", "component").mapInArrow(
        codes, f"cid bigint, part string, label string, code bigint, vec {kind}, component bigint"
    )
    ordered = coded.select("cid", F.concat("part", "label").alias("part"), "code", "vec", "component").repartitionByRange(
        "part", "code", "cid"
    )
    return ordered.sortWithinPartitions("part", "code", "cid").select("cid", "part", "vec", "component").mapInArrow(
        compare, LIST_SCHEMA
    )


def _tables(nodes: DataFrame, threshold: float) -> int:
    """How many tables a pair at the threshold needs to share a block, 1 - ``MISSED`` of the time, in the largest label."""
    largest = nodes.groupBy("label").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    # Of the bits that tell a block apart each agrees with this probability.
    agrees = 1 - math.acos(min(threshold, 1.0)) / math.pi
    together = min(agrees ** max(math.log2(max(largest, 1) / BLOCK), 0.0), 0.95)
    return math.ceil(math.log(MISSED) / math.log(1 - together))


def _best(lists: DataFrame) -> DataFrame:
    lists = lists.groupBy("src", "dst").agg(F.max("sim").alias("sim"))
    rank = F.row_number().over(Window.partitionBy("src").orderBy(F.desc("sim"), "dst"))
    return lists.withColumn("_rank", rank).where(F.col("_rank") <= NEIGHBOURS).drop("_rank")


def _round(lists: DataFrame, nodes: DataFrame) -> DataFrame:
    """Candidates from vectors that meet at a common neighbour."""
    worst = lists.groupBy("src").agg(
        F.when(F.count("*") < NEIGHBOURS, -1.0).otherwise(F.min("sim")).alias("floor")
    )
    named = lists.groupBy("dst").agg(F.ceil(F.count("*") / GROUP).alias("groups"))
    own = lists.select(F.col("src").alias("at"), F.col("dst").alias("cid"), F.lit(True).alias("own"))
    back = lists.select(F.col("dst").alias("at"), F.col("src").alias("cid"), F.lit(False).alias("own"))
    # A node's own list joins each group of those that name it.
    own = own.join(named, own["at"] == named["dst"], "left").select(
        "at", "cid", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("groups"), F.lit(1)).cast("int") - 1)).alias("g")
    )
    back = back.join(named, back["at"] == named["dst"]).select(
        "at", "cid", F.pmod(F.xxhash64("cid"), F.col("groups")).cast("int").alias("g")
    )
    members = own.unionByName(back).distinct()
    with_vectors = members.join(nodes.join(worst, nodes["cid"] == worst["src"], "left").drop("src"), "cid").select(
        "at", "g", F.struct("cid", F.coalesce("floor", F.lit(-1.0)).alias("floor"), "vec").alias("m")
    )
    met = with_vectors.groupBy("at", "g").agg(F.collect_list("m").alias("m")).where(F.size("m") > 1).select("m")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            offsets, flat = column.offsets.to_numpy(), column.values
            ids = flat.field("cid").to_numpy(zero_copy_only=False)
            floor = flat.field("floor").to_numpy(zero_copy_only=False)
            vecs, found = flat.field("vec"), []
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                x = _matrix(vecs.slice(a, b - a))
                found.append(_top(ids[a:b], x @ x.T, EMIT, floor[a:b]))
            yield _rows(found)

    return met.mapInArrow(compare, LIST_SCHEMA)


def _recall(nodes: DataFrame, found: DataFrame, threshold: float) -> float:
    """The share of the sample's links whose ends are in one component; 1 if there are none."""
    placed = nodes.join(found, nodes["cid"] == found["node"], "left").select(
        "cid", F.col("label").cast("string").alias("label"), "vec", F.coalesce("component", "cid").alias("component")
    )
    # A bounded sample, the same in each round.
    sample = placed.orderBy(F.xxhash64("cid"), "cid").limit(AUDITED).collect()
    groups: dict[tuple, list] = {}
    for r in sample:
        groups.setdefault((r["label"], len(r["vec"])), []).append(r)
    queries = {
        key: (np.array([r["cid"] for r in rows]), np.array([r["component"] for r in rows]),
              _units(np.array([r["vec"] for r in rows], np.float64)))
        for key, rows in groups.items()
    }

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        there = joined = 0
        for batch in batches:
            labels = np.array(batch.column(1).to_pylist(), object)
            lengths = np.diff(batch.column(2).offsets.to_numpy())
            cid, component = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 3))
            for (label, length), (ids, components_, x) in queries.items():
                own = np.flatnonzero((labels == label) & (lengths == length))
                if len(own):
                    close = x @ _matrix(batch.column(2).take(pa.array(own))).T >= threshold + ROUNDING
                    close &= ids[:, None] != cid[own][None]
                    there += int(close.sum())
                    joined += int((close & (components_[:, None] == component[own][None])).sum())
        yield pa.RecordBatch.from_pydict({"there": [there], "joined": [joined]})

    total = placed.mapInArrow(compare, "there bigint, joined bigint").agg(F.sum("there"), F.sum("joined")).first()
    return 1.0 if not total[0] else total[1] / total[0]


def linked(nodes: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[DataFrame, float]:
    """The components (node, component) of the links among ``nodes`` (cid, label, vec), and their recall."""
    ends = lambda rows: rows.where(F.col("sim") >= threshold).select(F.col("src").alias("a"), F.col("dst").alias("b"))
    tables = _tables(nodes, threshold)
    met = materialized(_first_lists(nodes.withColumn("component", F.col("cid")), range(tables), threshold), "met")
    lists, links = materialized(_best(met), "lists"), ends(met)
    while True:
        met = materialized(_round(lists, nodes), "met")
        new = materialized(_best(lists.unionByName(met)), "lists")
        changed, size = new.join(lists, ["src", "dst"], "left_anti").count(), new.count()
        lists, links = new, links.unionByName(ends(met))
        found = materialized(components(links), "components")
        reached = _recall(nodes, found, threshold)
        if reached >= recall:
            return found, reached
        if changed <= STOP_SHARE * size:
            placed = nodes.join(found, nodes["cid"] == found["node"], "left").select(
                "cid", "label", "vec", F.coalesce("component", "cid").alias("component")
            )
            met = materialized(_first_lists(placed, range(tables, 2 * tables), threshold), "met")
            lists, links = materialized(_best(lists.unionByName(met)), "lists"), links.unionByName(ends(met))
            tables *= 2


def _counts(members: DataFrame, threshold: float) -> DataFrame:
    """Per member (cid) its links to the other vectors of its component, by comparing blocks of members."""
    # A component's members are numbered by hash into blocks of about BLOCK vectors; each pair of blocks is one row.
    sizes = members.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    placed = members.join(sizes, "component").withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    # Dealt by block: left to itself, Spark would keep a component together as it was counted.
    blocks = placed.repartition("component", "block").groupBy("component", "block", "blocks").agg(
        F.collect_list(F.struct("cid", "size", "vec")).alias("m")
    )
    left = blocks.select("component", F.col("block").alias("x"), F.col("m").alias("mx"))
    right = blocks.select(
        "component", F.col("m").alias("my"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("x")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cids, counts = [], []
            for row in range(batch.num_rows):
                mx, my = (batch.column(c)[row].values for c in (0, 1))
                ids = mx.field("cid").to_numpy(zero_copy_only=False)
                close = _matrix(mx.field("vec")) @ _matrix(my.field("vec")).T >= threshold
                close &= ids[:, None] != my.field("cid").to_numpy(zero_copy_only=False)[None, :]
                cids.append(ids)
                counts.append(close @ my.field("size").to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c) if c else np.zeros(0, int), pa.int64()) for c in (cids, counts)],
                names=["cid", "links"],
            )

    pairs = left.join(right, ["component", "x"]).select("mx", "my")
    return pairs.mapInArrow(compare, "cid bigint, links bigint").groupBy("cid").agg(F.sum("links").alias("links"))


def dedup(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Per row its id, ``n_links``, ``component_id`` and ``kept``."""
    return audited_dedup(vectors, id_col, vec_col, label_col, threshold)[0]


def audited_dedup(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    threshold: float = THRESHOLD,
) -> tuple[DataFrame, float]:
    """The result of :func:`dedup` and the recall that the search reached on its sample."""
    ship_package()
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec"), F.col(label_col).alias("label"))
    rows = rows.withColumn("usable", F.coalesce(_usable("vec", "label") & F.col("id").isNotNull(), F.lit(False)))
    classes = rows.where("usable").groupBy("label", "vec").agg(F.min("id").cast("bigint").alias("cid"), F.count("*").alias("size"))
    nodes = materialized(classes, "vectors")
    found, reached = linked(nodes.select("cid", "label", "vec"), threshold)
    members = nodes.join(found, nodes["cid"] == found["node"]).select("cid", "size", "component", "vec")
    counts = materialized(_counts(members, threshold), "counts")
    per_class = (
        nodes.join(found.withColumnRenamed("node", "cid"), "cid", "left")
        .join(counts, "cid", "left")
        .select(
            "label",
            "vec",
            F.coalesce("component", "cid").alias("component_id"),
            (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("links"),
        )
    )
    # Only rows in a link need their class again; the join keeps the rest.
    alike = per_class.where("links > 0")
    out = rows.join(alike, (F.col("usable")) & (rows["label"] == alike["label"]) & (rows["vec"] == alike["vec"]), "left")
    component = F.coalesce("component_id", "id")
    result = out.select(
        F.col("id").alias(id_col),
        F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        (component == F.col("id")).alias("kept"),
    )
    return result, reached


def audit(
    vectors: DataFrame,
    result: DataFrame,
    every: int = 20,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    threshold: float = THRESHOLD,
) -> float:
    """The share of the queries' links, counted against all vectors, that the result has; 1 if there are none.

    Queries are the vectors whose id is divisible by ``every``. For an audit of a table that fits a session.
    """
    rows = vectors.where(_usable(vec_col, label_col)).select(
        F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vec_col).alias("vec")
    )
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    rows = rows.withColumn("norm", norm("vec"))
    q = rows.where(F.col("id") % every == 0).select(*[F.col(c).alias(f"q_{c}") for c in rows.columns])
    dot = F.aggregate(
        F.zip_with("q_vec", "vec", lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x
    )
    near = q.join(rows, (F.col("q_label") == F.col("label")) & (F.col("q_id") != F.col("id")))
    near = near.where(dot / (F.col("q_norm") * F.col("norm")) >= threshold).groupBy("q_id").count()
    both = near.join(result, near["q_id"] == result[id_col]).agg(F.sum("count"), F.sum("n_links")).first()
    return 1.0 if not both[0] else float(both[1]) / float(both[0])
