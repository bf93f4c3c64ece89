"""Near-duplicate vectors by NN-descent on a neighbour graph that Spark holds.

Lists of neighbours start from windows over rows sorted by random-hyperplane codes. Rounds then
join each node's neighbours with each other: neighbours of neighbours replace worse entries.
Entries at the threshold or above link nodes to groups, and every group is compared with itself
chunk by chunk, so that its links are exact. An audit compares some nodes with all rows; further
orders and rounds follow until enough of the audit's links are within groups.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchlake.llm.graph import components
from matchlake.llm.shared import Scratch
from matchlake.llm.vectors import matrix, unit, usable, usable_vectors

THRESHOLD = 0.98
NEIGHBOURS = 12
#: Orders by code of one pass, bits of a code, and rows compared around a place of an order.
ORDERS = 5
CODE_BITS = 32
WINDOW = 192
#: Nodes of a task of a round, and rows of a chunk of a group.
NODES = 512
CHUNK = 1024
#: Nodes the audit compares with all rows, and the recall of links and of linked nodes it asks for.
AUDITED = 1024
RECALL = 0.995
#: Rounds after which a missed audit is an error.
ROUNDS = 20
SEED = 31

FOUND = "u long, v long, s double"
_EMPTY = (np.array([], np.int64), np.array([], np.int64), np.array([], np.float64))


def _table(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    columns = [np.concatenate(x) for x in zip(*(parts or [_EMPTY]))]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["u", "v", "s"])


def best_of(ids: np.ndarray, close: np.ndarray, keep: int) -> tuple:
    """The ``keep`` closest others of each row."""
    close = close.copy()
    np.fill_diagonal(close, -np.inf)
    keep = min(keep, len(ids) - 1)
    if keep < 1:
        return _EMPTY
    at = np.argpartition(-close, keep - 1, axis=1)[:, :keep]
    scores = np.take_along_axis(close, at, axis=1)
    return np.repeat(ids, keep), ids[at].ravel(), scores.ravel()


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbours within overlapping windows of rows sorted by (turn, label, code)."""
    held: list[pa.Table] = []

    def flush(table: pa.Table) -> pa.RecordBatch:
        ids = table.column("c").to_numpy()
        rows = unit(matrix(table.column("vector")))
        group = list(zip(table.column("turn").to_pylist(), table.column("label").to_pylist()))
        parts = []
        cuts = [0, *(i for i in range(1, len(group)) if group[i] != group[i - 1]), len(group)]
        for low, high in zip(cuts, cuts[1:]):
            for start in range(low, max(low + 1, high - WINDOW // 2), WINDOW // 2):
                end = min(start + WINDOW, high)
                close = rows[start:end] @ rows[start:end].T
                parts.append(best_of(ids[start:end], close, NEIGHBOURS))
        return _table(parts)

    size = 0
    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        size += batch.num_rows
        if size >= 8 * WINDOW:
            table = pa.concat_tables(held)
            yield flush(table)
            held = [table.slice(size - WINDOW)]
            size = WINDOW
    if held:
        yield flush(pa.concat_tables(held))


def orders_for(total: int) -> int:
    """Orders to start from, so that a lone pair at the threshold shares a window of one of them.

    A bit of two codes differs with probability angle / pi; a pair shares a window if it agrees in
    the bits that leave half a window of rows. The chance to miss all orders is kept within what
    the audit allows, so the orders grow with the rows.
    """
    bits = min(CODE_BITS, math.log2(max(2.0, 2.0 * total / WINDOW)))
    meets = (1 - math.acos(THRESHOLD) / math.pi) ** bits
    return max(ORDERS, math.ceil(math.log(1 - RECALL) / math.log(1 - meets)))


def _first_lists(nodes: DataFrame, size: int, turn: int) -> DataFrame:
    """Entries from ``ORDERS`` orders; each ``turn`` has orders of its own."""
    planes = np.random.default_rng([SEED, turn]).normal(size=(ORDERS, CODE_BITS, size))

    @F.arrow_udf("array<long>")
    def codes(vectors: pa.Array) -> pa.Array:
        rows = unit(matrix(vectors))
        powers = 1 << np.arange(CODE_BITS, dtype=np.int64)
        made = [((rows @ p.T) > 0) @ powers for p in planes]
        return pa.array(np.stack(made, axis=1).tolist(), pa.list_(pa.int64()))

    coded = nodes.withColumn("codes", codes("vector")).select(
        "c", "label", "vector", F.posexplode("codes").alias("turn", "code")
    )
    order = ["turn", "label", "code", "c"]
    return (
        coded.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("c", "turn", "label", "vector")
        .mapInArrow(_windows, FOUND)
    )


def _top(found: DataFrame, keep: int) -> DataFrame:
    """The best ``keep`` entries of each list, entries found twice once."""
    order = Window.partitionBy("u").orderBy(F.desc("s"), "v")
    # Equal pairs can differ in the last bits of their score, so one of them is taken.
    once = found.groupBy("u", "v").agg(F.max("s").alias("s"))
    return once.withColumn("k", F.row_number().over(order)).where(F.col("k") <= keep)


def _local_join(rows: pa.Table) -> pa.Table:
    """Pairs of neighbours of one node that are closer than the worst entry of either list."""
    order = np.argsort(rows.column("w").to_numpy(), kind="stable")
    owner = rows.column("w").to_numpy()[order]
    ids, worst = rows.column("x").to_numpy()[order], rows.column("worst").to_numpy()[order]
    vectors = unit(matrix(rows.column("vector")))[order]
    starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
    parts = []
    for low, high in zip(starts, [*starts[1:], len(owner)]):
        close = vectors[low:high] @ vectors[low:high].T
        np.fill_diagonal(close, -np.inf)
        i, j = np.nonzero(close > worst[low:high][:, None])
        parts.append((ids[low:high][i], ids[low:high][j], close[i, j]))
    return pa.Table.from_batches([_table(parts)])


def _round(lists: DataFrame, nodes: DataFrame, total: int) -> DataFrame:
    """Entries that one join of neighbours of neighbours finds; a list gives and is given."""
    there = lists.select(F.col("u").alias("w"), F.col("v").alias("x"), "s")
    back = lists.select(F.col("v").alias("w"), F.col("u").alias("x"), "s")
    near = Window.partitionBy("w").orderBy(F.desc("s"), "x")
    around = (
        there.unionByName(back)
        .groupBy("w", "x")
        .agg(F.max("s").alias("s"))
        .withColumn("k", F.row_number().over(near))
        .where(F.col("k") <= 2 * NEIGHBOURS)
        .select("w", "x")
    )
    worst = lists.groupBy("u").agg(F.min("s").alias("worst"))
    known = nodes.join(worst, F.col("c") == F.col("u"), "left").select(
        F.col("c").alias("x"), "vector", F.coalesce("worst", F.lit(-2.0)).alias("worst")
    )
    tasks = max(1, -(-total // NODES))
    block = F.pmod(F.xxhash64("w"), F.lit(tasks)).alias("block")
    return around.join(known, "x").groupBy(block).applyInArrow(_local_join, FOUND)


def _audit(nodes: DataFrame, total: int) -> DataFrame:
    """All links of some nodes, by comparing them with every row of their label."""
    share = min(1 << 32, (AUDITED << 32) // max(1, total))
    chosen = nodes.where(F.pmod(F.xxhash64(F.lit(13), "c"), F.lit(1 << 32)) < share)
    rows = chosen.select("c", "label", "vector").orderBy("c").collect()
    ids = np.array([r["c"] for r in rows], np.int64)
    labels = np.array([str(r["label"]) for r in rows])
    vectors = unit(np.array([r["vector"] for r in rows], np.float64))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            other = batch.column("c").to_numpy()
            same = labels[:, None] == np.array(list(map(str, batch.column("label").to_pylist())))
            close = vectors @ unit(matrix(batch.column("vector"))).T if len(ids) else same
            i, j = np.nonzero(same & (close >= THRESHOLD) & (ids[:, None] != other))
            yield _table([(ids[i], other[j], close[i, j].astype(np.float64))])

    return nodes.select("c", "label", "vector").mapInArrow(compare, FOUND)


def _links(found: DataFrame) -> DataFrame:
    """Undirected links (u < v) among list entries."""
    good = found.where(F.col("s") >= THRESHOLD)
    return good.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def _unfound(truth: DataFrame, label_of: DataFrame) -> DataFrame:
    """The audit's entries whose ends are not in one group."""
    ours = label_of.withColumnsRenamed({"node": "u", "component": "from"})
    other = label_of.withColumnsRenamed({"node": "v", "component": "to"})
    apart = F.coalesce(F.col("from") != F.col("to"), F.lit(True))
    return truth.join(ours, "u", "left").join(other, "v", "left").where(apart)


def _counts(truth: DataFrame) -> tuple[int, int]:
    """Links, and linked audited nodes."""
    row = truth.agg(F.count(F.lit(1)), F.count_distinct("u")).first()
    return row[0], row[1]


def _small_degrees(rows: pa.Table) -> pa.Table:
    """Links of each row into the rest of its group, by number of rows, for whole groups."""
    group = rows.column("component").to_numpy()
    order = np.argsort(group, kind="stable")
    group, ids = group[order], rows.column("c").to_numpy()[order]
    mult = rows.column("mult").to_numpy()[order].astype(np.int64)
    vectors = unit(matrix(rows.column("vector")))[order]
    starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    parts = []
    for low, high in zip(starts, [*starts[1:], len(group)]):
        linked = vectors[low:high] @ vectors[low:high].T >= THRESHOLD
        np.fill_diagonal(linked, False)
        parts.append(linked @ mult[low:high])
    return pa.table({"c": ids, "n": np.concatenate(parts)})


def _group_degrees(left: pa.Table, right: pa.Table) -> pa.Table:
    """Links of each row of one chunk into another chunk of its group, by number of rows."""
    a, b = left.column("c").to_numpy(), right.column("other").to_numpy()
    if not len(a) or not len(b):
        return pa.table({"c": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
    close = unit(matrix(left.column("vector"))) @ unit(matrix(right.column("towards"))).T
    linked = (close >= THRESHOLD) & (a[:, None] != b)
    return pa.table({"c": a, "n": linked @ right.column("mult").to_numpy().astype(np.int64)})


def _complete(members: DataFrame, total: int) -> DataFrame:
    """Exact links of every row of every group, (c, n).

    ``members`` holds (c, vector, mult, component). Groups of more than ``CHUNK`` rows are dealt
    into chunks of about that and compared chunk against chunk; smaller ones share tasks, whole.
    What leaves a task is one number per row, not its links.
    """
    sizes = members.groupBy("component").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(CHUNK)).cast("int").alias("chunks")
    )
    sized = members.join(sizes, "component")
    tasks = max(1, -(-total // NODES))
    block = F.pmod(F.xxhash64("component"), F.lit(tasks)).alias("block")
    small = (
        sized.where("chunks = 1")
        .select("c", "vector", "mult", "component", block)
        .groupBy("block")
        .applyInArrow(_small_degrees, "c long, n long")
    )
    dealt = sized.where("chunks > 1").withColumn(
        "chunk", F.pmod(F.xxhash64("c"), "chunks").cast("int")
    )
    every = F.explode(F.expr("sequence(0, chunks - 1)"))
    # The two sides come from one table, so each names its columns anew.
    left = dealt.select(
        F.col("component").alias("g"),
        F.col("chunk").alias("i"),
        every.alias("j"),
        F.col("c").alias("c"),
        F.col("vector").alias("vector"),
    )
    right = dealt.select(
        F.col("component").alias("h"),
        every.alias("i"),
        F.col("chunk").alias("j"),
        F.col("c").alias("other"),
        F.col("vector").alias("towards"),
        F.col("mult").alias("mult"),
    )
    large = (
        left.groupBy("g", "i", "j")
        .cogroup(right.groupBy("h", "i", "j"))
        .applyInArrow(_group_degrees, "c long, n long")
        .groupBy("c")
        .agg(F.sum("n").alias("n"))
    )
    return small.unionByName(large)


def near_vectors(
    table: DataFrame,
    id_col: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """Links of cosine ``THRESHOLD`` or more between vectors of equal label.

    Returns one row per input row: (vec_id, n_links, component_id, kept). Equal vectors of one
    label are one node, whatever their number, and are linked to each other. Rows without label,
    and vectors that are null, zero, of an odd length or hold null or non-finite parts, have no
    links: they are their own component, and so is a row without id (component null, kept).
    Rows that repeat an id count as rows of their own.
    """
    spark = table.sparkSession
    scratch = Scratch(spark, "nn-descent")
    rows = scratch.put(usable_vectors(table, id_col, vector, label), "rows")
    nodes = scratch.put(
        rows.groupBy("label", "h1", "h2").agg(
            F.min("vec_id").alias("c"),
            F.count(F.lit(1)).alias("mult"),
            F.any_value("vector").alias("vector"),
        ),
        "nodes",
    )
    ids = table.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"))
    first = nodes.select(F.size("vector")).first()
    if first is None:
        return _as_rows(
            ids.withColumns({"n_links": F.lit(0).cast("long"), "component": F.col("vec_id")})
        )
    total = nodes.count()
    truth = scratch.put(_audit(nodes, total), "audit")
    wanted, audited = _counts(truth)

    def more_lists(lists: DataFrame | None, turn: int) -> DataFrame:
        """The lists with what further orders find."""
        fresh = _first_lists(nodes, first[0], turn)
        if lists is not None:
            fresh = fresh.unionByName(lists.select("u", "v", "s"))
        return scratch.put(_top(fresh, NEIGHBOURS), f"begun-{turn}")

    lists, turns = None, -(-orders_for(total) // ORDERS)
    for turn in range(turns):
        lists = more_lists(lists, turn)
    for step in range(1, ROUNDS + 1):
        found = lists.select("u", "v", "s").unionByName(_round(lists, nodes, total))
        lists = scratch.put(_top(found, NEIGHBOURS), f"lists-{step}")
        if step > 1:
            scratch.drop(f"lists-{step - 1}")
        links = scratch.put(_links(lists), f"links-{step}")
        label_of = components(links.select(F.col("u").alias("a"), F.col("v").alias("b")), scratch)
        label_of = scratch.put(label_of, f"components-{step}")
        # Groups are completed below, so a link is found if its ends are in one group.
        lost, short = _counts(_unfound(truth, label_of))
        if lost <= (1 - RECALL) * wanted and short <= (1 - RECALL) * audited:
            break
        if step == ROUNDS:
            raise RuntimeError(
                f"near_vectors: after {ROUNDS} rounds the audit still misses {lost} of {wanted} "
                f"links, at {short} of {audited} nodes"
            )
        lists = more_lists(lists, turns + step)
    links = scratch.put(
        links.unionByName(_links(truth)).distinct().select(F.col("u").alias("a"), F.col("v").alias("b")),
        "links",
    )
    label_of = components(links, scratch)
    grouped = scratch.put(
        nodes.join(label_of, F.col("c") == F.col("node")).select("c", "vector", "mult", "component"),
        "grouped",
    )
    degrees = _complete(grouped, total)
    figures = scratch.put(
        nodes.join(degrees, "c", "left")
        .join(grouped.select("c", "component"), "c", "left")
        .select(
            "label", "h1", "h2",
            (F.coalesce("n", F.lit(0)) + F.col("mult") - 1).alias("n_links"),
            F.coalesce("component", "c").alias("component"),
        ),
        "figures",
    )
    linked = rows.join(figures, ["label", "h1", "h2"]).select("vec_id", "n_links", "component")
    return _as_rows(linked.unionByName(_apart(table, rows, id_col, vector, label)))


def _apart(
    table: DataFrame, rows: DataFrame, id_col: str, vector: str, label: str
) -> DataFrame:
    """Rows that take no part, with no links."""
    size = rows.select(F.size("vector").alias("d")).first()["d"]
    named = table.select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"),
        F.col(f"`{label}`").alias("label"),
        F.col(f"`{vector}`").cast("array<double>").alias("vector"),
    )
    takes = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable("vector")
    return named.where(~takes | (F.size("vector") != size)).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component")
    )


def _as_rows(figures: DataFrame) -> DataFrame:
    return figures.select(
        "vec_id",
        "n_links",
        F.col("component").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.col("component"), F.lit(True)).alias("kept"),
    )
