"""Hard negatives by angular triangle filtering.

Every row keeps its angles to a few reference directions. The angle between two rows lies between
the largest difference and the smallest sum of their angles to a reference, so its cosine, times
both norms, bounds their score from both sides. Rows whose bounds miss the window of scores that
is asked for are dropped unscored; only what overlaps it gets an exact integer score. Rows lie in
cells by their nearest reference, and the same bounds over a whole cell leave out cells.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlake.llm.shared import Scratch
from matchlake.llm.vectors import matrix, unit

REFERENCES = 16
#: The bound of the sample the reference directions are chosen from.
SAMPLE = 4096
#: Rows of a cell, and anchors, that meet in one task at a time; anchors bounded at once.
CHUNK_ROWS = 4096
BLOCK_ANCHORS = 1024
AT_ONCE = 64
#: Angles are right to this much, and bounds to this share of the product of norms.
SLACK = 1e-6
ROUNDING = 1e-12
#: Sums of products below this are exact in double precision.
EXACT = 2.0**53
HIGHEST = 2**63 - 1
LOWEST = -HIGHEST
SEED = 41


def usable(vector: Column) -> Column:
    """Whether a vector has integer parts: not null, no null or non-finite component."""
    finite = F.forall(vector, lambda e: e.isNotNull() & (F.abs(e) < float("inf")))
    return F.coalesce(finite, F.lit(False))


def whole(rows: np.ndarray, scale: float) -> np.ndarray:
    """The integer parts, as doubles, which hold whole numbers of any size exactly."""
    with np.errstate(over="ignore"):
        return np.floor(np.nan_to_num(scale * rows))


def references(sample: np.ndarray, size: int) -> np.ndarray:
    """``REFERENCES`` directions: sampled rows far from each other, then random ones."""
    chosen: list[np.ndarray] = []
    rows = unit(sample[np.any(sample != 0, axis=1)]) if len(sample) else sample
    closest = np.full(len(rows), -1.0)
    while len(chosen) < REFERENCES and len(rows) and closest.min() < 1 - 1e-9:
        chosen.append(rows[closest.argmin()])
        closest = np.maximum(closest, rows @ chosen[-1])
    rng = np.random.default_rng([SEED, size])
    spare = rng.normal(size=(REFERENCES - len(chosen), size))
    return np.concatenate([np.reshape(chosen, (len(chosen), size)), unit(spare)])


def angles(rows: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Angle of every row to every direction; a row of zeros has right angles."""
    out = np.full((len(rows), len(directions)), np.pi / 2)
    some = np.any(rows != 0, axis=1)
    if rows.shape[1]:
        out[some] = np.arccos(np.clip(unit(rows[some]) @ directions.T, -1, 1))
    return out


def norms(rows: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.sqrt((rows * rows).sum(axis=1))


def bounds(
    angles_a: np.ndarray, norms_a: np.ndarray, angles_b: np.ndarray, norms_b: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest score of each row of a with each row of b, safe against rounding."""
    near = np.zeros((len(angles_a), len(angles_b)))
    far = np.full(near.shape, np.pi)
    for a, b in zip(angles_a.T, angles_b.T):
        np.maximum(near, np.abs(a[:, None] - b), out=near)
        both = a[:, None] + b
        np.minimum(far, np.minimum(both, 2 * np.pi - both), out=far)
    size = norms_a[:, None] * norms_b
    margin = 1 + size * ROUNDING
    low = size * np.cos(np.minimum(far + SLACK, np.pi)) - margin
    high = size * np.cos(np.maximum(near - SLACK, 0)) + margin
    # Beyond exact doubles nothing is ruled out.
    exact = size < EXACT
    return np.where(exact, low, -np.inf), np.where(exact, high, np.inf)


def scores(anchor: np.ndarray, rows: np.ndarray, largest: float) -> np.ndarray:
    """Integer inner products; ``largest`` bounds their size. They saturate at a long's range."""
    if largest < EXACT:
        return (rows @ anchor).astype(np.int64)
    whole = [int(x) for x in anchor]
    exact = [sum(a * int(x) for a, x in zip(whole, row)) for row in rows]
    return np.array([min(max(s, LOWEST), HIGHEST) for s in exact], np.int64)


def window(score: int, low: int, high: int) -> tuple[int, int]:
    """The scores from ``low`` to ``high`` percent of a positive score, both ends in."""
    return -(-low * score // 100), high * score // 100


class _Side:
    """Columns of one side of a block as arrays."""

    def __init__(self, table: pa.Table):
        self.uid = table.column("uid").to_numpy()
        self.vec_id = table.column("vec_id").to_numpy()
        self.label = table.column("code").to_numpy()
        self.rows = matrix(table.column("ints")) if len(self.uid) else np.zeros((0, 0))
        self.angles = matrix(table.column("angles"))
        self.norms = table.column("norm").to_numpy()


FOUND = "a long, asked long, uid long, vec_id long, score long"


def _answer(parts: list[tuple]) -> pa.Table:
    names = [f.split()[0] for f in FOUND.split(", ")]
    columns = [np.concatenate([np.zeros(0, np.int64), *p]) for p in zip(*parts)] if parts else None
    columns = columns or [np.zeros(0, np.int64)] * len(names)
    return pa.table([pa.array(c.astype(np.int64)) for c in columns], names=names)


def _best(picked: np.ndarray, score: np.ndarray, ids: np.ndarray, keep: int) -> np.ndarray:
    return picked[np.lexsort((ids, -score))[:keep]]


def _scan(same_label: bool, keep: int, low: int, high: int):
    """Compares the anchors of a block with the rows of a chunk.

    Of the same label: the ``keep`` best rows per anchor, none below its ``worst``. Of others:
    the ``keep`` best rows in the window of each of the positive scores in ``wanted``.
    """

    def work(rows: pa.Table, asked: pa.Table) -> pa.Table:
        if not rows.num_rows or not asked.num_rows:
            return _answer([])
        side, anchors = _Side(rows), _Side(asked)
        limits = asked.column("worst" if same_label else "wanted").to_pylist()
        out = []
        for label in np.unique(anchors.label):
            mine = np.flatnonzero(side.label == label if same_label else side.label != label)
            block = np.flatnonzero(anchors.label == label)
            for start in range(0, len(block) if len(mine) else 0, AT_ONCE):
                part = block[start : start + AT_ONCE]
                lowest, highest = bounds(
                    anchors.angles[part], anchors.norms[part], side.angles[mine], side.norms[mine]
                )
                for n, i in enumerate(part):
                    largest = anchors.norms[i] * side.norms[mine].max()
                    if same_label:
                        worst = LOWEST if limits[i] is None else limits[i]
                        at = mine[highest[n] >= worst]
                        at = at[side.uid[at] != anchors.uid[i]]
                        score = scores(anchors.rows[i], side.rows[at], largest)
                        best = _best(np.arange(len(at)), score, side.vec_id[at], keep)
                        out.append(_rows(anchors.uid[i], 0, side, at[best], score[best]))
                        continue
                    spans = {p: window(p, low, high) for p in limits[i]}
                    some = np.zeros(len(mine), bool)
                    for least, most in spans.values():
                        some |= (highest[n] >= least) & (lowest[n] <= most) & (least <= most)
                    at = mine[some]
                    score = scores(anchors.rows[i], side.rows[at], largest)
                    for positive, (least, most) in spans.items():
                        inside = np.flatnonzero((score >= least) & (score <= most))
                        best = _best(inside, score[inside], side.vec_id[at[inside]], keep)
                        out.append(_rows(anchors.uid[i], positive, side, at[best], score[best]))
        return _answer(out)

    return work


def _rows(anchor: int, asked: int, side: _Side, at: np.ndarray, score: np.ndarray) -> tuple:
    size = len(at)
    return np.full(size, anchor), np.full(size, asked), side.uid[at], side.vec_id[at], score


def prepared(
    table: DataFrame, id_col: str, vector: str, label: str, anchor: Column, scale: float, scratch: Scratch
) -> DataFrame:
    """The rows that take part, with integer parts, norm, angles, cell and chunk; written.

    The reference directions come from a bounded sample, a set for each length of vectors.
    """
    x = F.col("vector")
    rows = (
        table.select(
            F.col(f"`{id_col}`").cast("long").alias("vec_id"),
            F.xxhash64(F.col(f"`{label}`")).alias("code"),
            F.col(f"`{label}`").isNotNull().alias("labelled"),
            F.col(f"`{vector}`").cast("array<double>").alias("vector"),
            F.coalesce(anchor, F.lit(False)).alias("anchor"),
        )
        .where(F.col("labelled") & F.col("vec_id").isNotNull() & usable(x))
        .select(F.monotonically_increasing_id().alias("uid"), "vec_id", "code", "anchor", "vector")
    )
    rows = scratch.put(rows, "rows")
    total = rows.count()
    share = min(1 << 32, (SAMPLE << 32) // max(1, total))
    sample = rows.where(F.pmod(F.xxhash64(F.lit(5), "uid"), F.lit(1 << 32)) < share)
    by_size: dict[int, list] = {}
    for row in sample.select("uid", "vector").orderBy("uid").collect():
        by_size.setdefault(len(row["vector"]), []).append(row["vector"])
    chosen = {
        size: references(whole(np.array(some, float).reshape(len(some), size), scale), size)
        for size, some in by_size.items()
    }

    @F.arrow_udf("struct<ints:array<double>,norm:double,angles:array<double>,cell:int>")
    def measured(vectors: pa.Array) -> pa.Array:
        sizes = np.array([len(v) for v in vectors])
        parts = [None] * len(sizes)
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            ints = whole(matrix(vectors.take(pa.array(at))).reshape(len(at), size), scale)
            directions = chosen.get(int(size))
            if directions is None:
                directions = references(np.zeros((0, size)), int(size))
            turned, length = angles(ints, directions), norms(ints)
            for n, i in enumerate(at):
                parts[i] = {
                    "ints": ints[n],
                    "norm": length[n],
                    "angles": turned[n],
                    "cell": int(turned[n].argmin()),
                }
        kind = pa.struct(
            [
                ("ints", pa.list_(pa.float64())),
                ("norm", pa.float64()),
                ("angles", pa.list_(pa.float64())),
                ("cell", pa.int32()),
            ]
        )
        return pa.array(parts, kind)

    placed = rows.withColumn("m", measured("vector")).select(
        "uid", "vec_id", "code", "anchor", F.size("vector").alias("size"), "m.*"
    )
    return scratch.put(placed, "placed")


def hard_negatives(
    table: DataFrame,
    anchor: Column,
    id_col: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    scale: float = 256.0,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
) -> DataFrame:
    """Hard negatives of the rows for which ``anchor`` holds.

    A component x counts as floor(``scale`` * x) and a row's score is its integer inner product
    with the anchor; higher scores come first, ties by smaller id. An anchor's positives are its
    first ``positives`` other rows of its label; for each, the first ``negatives`` rows of other
    labels with a score from ``low`` to ``high`` percent of the positive's. Returns (anchor_id,
    positive_id, rank, negative_id, positive_score, negative_score).

    Rows without id or label, or whose vector is null or holds null or non-finite components,
    take no part. Vectors of zeros do, with scores of zero; vectors meet those of their length
    only. Rows that repeat an id are rows of their own. Scores beyond a long saturate. An empty
    table gives an empty result.

    The result is exact at every size. Anchors come in blocks that lie in one cell and are only
    sent to cells whose bounds allow a wanted score, chunk by chunk; a positive's search starts in
    the anchor's own cell, whose results bound what other cells must offer.
    """
    scratch = Scratch(table.sparkSession, "angle-negatives")
    rows = prepared(table, id_col, vector, label, anchor, scale, scratch)
    place = ["size", "cell"]
    n = F.count(F.lit(1))
    cells = scratch.put(
        rows.groupBy(*place).agg(
            F.ceil(n / F.lit(CHUNK_ROWS)).cast("int").alias("chunks"),
            F.ceil(F.count_if("anchor") / F.lit(BLOCK_ANCHORS)).cast("int").alias("blocks"),
            F.min("norm").alias("shortest"),
            F.max("norm").alias("longest"),
            *[F.min(F.col("angles")[r]).alias(f"low_{r}") for r in range(REFERENCES)],
            *[F.max(F.col("angles")[r]).alias(f"high_{r}") for r in range(REFERENCES)],
        ).select(
            *place, "chunks", "blocks", "shortest", "longest",
            F.array(*[F.col(f"low_{r}") for r in range(REFERENCES)]).alias("lows"),
            F.array(*[F.col(f"high_{r}") for r in range(REFERENCES)]).alias("highs"),
        ),
        "cells",
    )
    told = ["uid", "vec_id", "code", "ints", "angles", "norm"]
    spread = F.pmod(F.xxhash64("uid"), F.lit(1 << 30))
    shelves = rows.join(cells.select(*place, "chunks"), place).select(
        *told, *place, (spread % F.col("chunks")).cast("int").alias("chunk")
    )
    asked = rows.where("anchor").join(cells.select(*place, "blocks"), place).select(
        *told, "size", F.col("cell").alias("home"), (spread % F.col("blocks")).cast("int").alias("block")
    )

    def probe(probes: DataFrame, extra: str, scan, name: str) -> DataFrame:
        """``probes`` are anchors with a ``cell`` to visit and the column ``extra``."""
        blocks = probes.select(*place, "home", "block").distinct()
        copies = shelves.join(blocks, place)
        sent = probes.join(cells.select(*place, "chunks"), place).select(
            *told, *place, "home", "block", extra, F.explode(F.expr("sequence(0, chunks - 1)")).alias("chunk")
        )
        # Both sides come from one table, so one of them gets columns of its own.
        sent = sent.select(*[F.col(c).alias(c) for c in sent.columns])
        key = [*place, "chunk", "home", "block"]
        found = copies.groupBy(*key).cogroup(sent.groupBy(*key)).applyInArrow(scan, FOUND)
        return scratch.put(found, name)

    def first(found: DataFrame, by: list[str], keep: int) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id", "uid")
        return found.withColumn("k", F.row_number().over(order)).where(F.col("k") <= keep)

    scan = _scan(True, positives, low, high)
    own = asked.withColumns({"cell": F.col("home"), "worst": F.lit(None).cast("long")})
    near = probe(own, "worst", scan, "near")
    full = first(near, ["a"], positives).where(F.col("k") == positives)
    bounded = asked.join(
        full.select(F.col("a").alias("uid"), F.col("score").alias("worst")), "uid", "left"
    )
    elsewhere = _with_cells(bounded, cells).where(
        (F.col("cell") != F.col("home")) & (F.col("worst").isNull() | (F.col("highest") >= F.col("worst")))
    )
    more = probe(elsewhere, "worst", scan, "more")
    chosen = scratch.put(
        first(near.unionByName(more), ["a"], positives).select(
            "a", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
        ),
        "positives",
    )
    wanted = chosen.groupBy(F.col("a").alias("uid")).agg(
        F.collect_set("positive_score").alias("wanted")
    )
    least = F.array_min("wanted") * F.lit(low / 100.0) - 1
    most = F.array_max("wanted") * F.lit(high / 100.0) + 1
    visits = _with_cells(asked.join(wanted, "uid"), cells).where(
        (F.array_max("wanted") >= 0) & (F.col("highest") >= F.least(least, F.lit(0.0))) & (F.col("lowest") <= most)
    )
    found = probe(visits, "wanted", _scan(False, negatives, low, high), "negatives")
    ranked = first(found, ["a", "asked"], negatives).select(
        "a",
        F.col("asked").alias("positive_score"),
        F.col("k").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"),
        F.col("score").alias("negative_score"),
    )
    anchors = rows.where("anchor").select(F.col("uid").alias("a"), F.col("vec_id").alias("anchor_id"))
    return (
        chosen.join(ranked, ["a", "positive_score"])
        .join(anchors, "a")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )


def _with_cells(asked: DataFrame, cells: DataFrame) -> DataFrame:
    """Each anchor beside every cell of its length, with bounds for the scores in it.

    There are at most ``REFERENCES`` cells to a length.
    """
    both = asked.join(cells.select("size", "cell", "shortest", "longest", "lows", "highs"), "size")
    near = F.expr(
        "array_max(zip_with(zip_with(angles, highs, (t, h) -> t - h), "
        "zip_with(lows, angles, (l, t) -> l - t), (x, y) -> greatest(x, y, 0D)))"
    )
    far = F.expr(
        "array_min(transform(zip_with(angles, highs, (t, h) -> t + h), s -> least(s, pi())))"
    )
    size = F.col("norm") * F.col("longest")
    margin = 1 + size * ROUNDING
    exact = size < EXACT

    def reach(cosine: Column, positive: str, negative: str) -> Column:
        length = F.when(cosine < 0, F.col(negative)).otherwise(F.col(positive))
        return F.col("norm") * length * cosine

    highest = reach(F.cos(F.greatest(near - SLACK, F.lit(0.0))), "longest", "shortest") + margin
    lowest = reach(F.cos(F.least(far + SLACK, F.lit(np.pi))), "shortest", "longest") - margin
    infinite = F.lit(float("inf"))
    return both.withColumns(
        {
            "highest": F.when(exact, highest).otherwise(infinite),
            "lowest": F.when(exact, lowest).otherwise(-infinite),
        }
    ).drop("shortest", "longest", "lows", "highs")
