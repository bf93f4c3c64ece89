"""Nearest neighbours by an inverted file whose lists are scanned with adaptive dimensions.

Vectors are scaled to length one and turned by a random rotation, so any block of columns is a
sample of all of a difference's squared length. A list is scanned block of columns by block: a
candidate is given up as soon as its partial distance, scaled up, is so far above the best
distances found that a hypothesis test rejects that it could be among them. What survives all
blocks is scored exactly on the original vectors.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchlake.llm.shared import Scratch
from matchlake.llm.vectors import cosines, matrix, unit, usable_vectors

NEAREST = 5
QUERY_STEP = 50
#: The bound of the sample that the index is fitted on, and of its lists.
SAMPLE = 16_384
MAX_LISTS = 256
ROUNDS = 8
#: Share of true neighbours that the probed lists must hold, on the sample.
COVERED = 0.97
CHECKED = 256
#: Columns of a block, and the test's width: larger keeps more candidates.
COLUMNS = 16
WIDTH = 2.5
#: Rows of a list, and queries, that meet in one task at a time.
CHUNK_ROWS = 4096
QUERY_ROWS = 2048
SEED = 23

FOUND = "q long, c long, score double"


@dataclass(frozen=True)
class Index:
    """A rotation, the centres of lists in rotated space, and how many lists to probe."""

    rotation: np.ndarray
    centres: np.ndarray
    probes: int

    def turned(self, vectors: np.ndarray) -> np.ndarray:
        return unit(vectors) @ self.rotation

    def near_lists(self, turned: np.ndarray) -> np.ndarray:
        """Lists by falling closeness of their centre, a row per vector."""
        return np.argsort(-(turned @ self.centres.T), axis=1, kind="stable")


def fit(sample: np.ndarray, total: int) -> Index:
    """Index for ``total`` vectors from a sample of at most about ``SAMPLE`` of them.

    The number of probes is the least that covers ``COVERED`` of the true neighbours of some
    sampled vectors among all sampled ones.
    """
    rng = np.random.default_rng(SEED)
    size = sample.shape[1]
    rotation, _ = np.linalg.qr(rng.normal(size=(size, size)))
    turned = unit(sample) @ rotation
    lists = int(max(1, min(MAX_LISTS, round(total**0.5 / 2), len(turned) // 8)))
    centres = turned[rng.choice(len(turned), lists, replace=False)]
    for _ in range(ROUNDS):
        owner = (turned @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, owner, turned)
        filled = np.linalg.norm(sums, axis=1) > 1e-12
        centres = centres.copy()
        centres[filled] = unit(sums[filled])
    index = Index(rotation, centres, lists)
    owner = (turned @ centres.T).argmax(axis=1)
    picked = rng.choice(len(turned), min(CHECKED, len(turned)), replace=False)
    closeness = turned[picked] @ turned.T
    closeness[np.arange(len(picked)), picked] = -np.inf
    near = np.argsort(-closeness, axis=1)[:, : min(NEAREST, max(1, len(turned) - 1))]
    order = np.argsort(index.near_lists(turned[picked]), axis=1)
    ranks = np.sort(np.take_along_axis(order, owner[near], axis=1).ravel())
    needed = int(ranks[min(len(ranks) - 1, int(COVERED * len(ranks)))]) + 1
    return Index(rotation, centres, min(lists, needed))


def scan(
    rows: np.ndarray, turned: np.ndarray, query: np.ndarray, query_turned: np.ndarray,
    worst: float, keep: int,
) -> tuple[np.ndarray, np.ndarray]:
    """The best ``keep`` rows of a list for one query that a bound ``worst`` allows, and scores.

    ``worst`` is the cosine of the query's ``keep``-th best so far. Without one, the first rows
    are scored in full to get one.
    """
    size = turned.shape[1]
    bound = 2.0 - 2.0 * worst
    if not np.isfinite(bound):
        head = turned[: 8 * keep]
        distances = ((head - query_turned) ** 2).sum(axis=1)
        if len(distances) >= keep:
            bound = float(np.partition(distances, keep - 1)[keep - 1])
    alive, partial = np.arange(len(turned)), np.zeros(len(turned))
    for start in range(0, size, COLUMNS):
        end = min(start + COLUMNS, size)
        gap = turned[alive, start:end] - query_turned[start:end]
        partial += (gap * gap).sum(axis=1)
        if np.isfinite(bound):
            slack = (1 + WIDTH / np.sqrt(end)) ** 2 if end < size else 1 + 1e-9
            stays = partial * (size / end) <= bound * slack + 1e-12
            alive, partial = alive[stays], partial[stays]
        if not len(alive):
            break
    scores = cosines(rows[alive], np.broadcast_to(query, (len(alive), size)))
    if len(alive) > keep:
        least = np.partition(scores, len(scores) - keep)[len(scores) - keep]
        best = scores >= least
        alive, scores = alive[best], scores[best]
    return alive, scores


def _scanner(index: Index, keep: int):
    def work(rows: pa.Table, queries: pa.Table) -> pa.Table:
        ids = rows.column("c").to_numpy()
        vectors = matrix(rows.column("vector"))
        out_q, out_c, out_s = [], [], []
        if len(ids) and queries.num_rows:
            turned = index.turned(vectors)
            asked = matrix(queries.column("vector"))
            asked_turned = index.turned(asked)
            for i, (q, worst) in enumerate(
                zip(queries.column("q").to_pylist(), queries.column("worst").to_pylist())
            ):
                bound = -np.inf if worst is None else worst
                at, scores = scan(vectors, turned, asked[i], asked_turned[i], bound, keep)
                out_q.append(np.full(len(at), q))
                out_c.append(ids[at])
                out_s.append(scores)
        parts = [np.concatenate(x) if x else np.array([]) for x in (out_q, out_c, out_s)]
        return pa.table(
            [
                pa.array(parts[0].astype(np.int64)),
                pa.array(parts[1].astype(np.int64)),
                pa.array(parts[2].astype(np.float64)),
            ],
            names=["q", "c", "score"],
        )

    return work


def _best(found: DataFrame, keep: int) -> DataFrame:
    order = Window.partitionBy("q").orderBy(F.desc("score"), "c")
    return found.withColumn("k", F.row_number().over(order)).where(F.col("k") <= keep)


def search(
    table: DataFrame,
    id_col: str = "vec_id",
    vector: str = "embedding",
    nearest: int = NEAREST,
    query_step: int = QUERY_STEP,
) -> DataFrame:
    """The ``nearest`` rows found for every row whose id is divisible by ``query_step``.

    Returns (query_id, rank, vec_id, score), nearest first by cosine of the original vectors in
    double precision, ties to the smaller id, the query's own row left out. Vectors that are
    null, zero, of an odd length or hold null or non-finite parts take no part, nor do rows
    without id. Equal vectors are one to the search and keep only their ``nearest`` + 1 lowest
    ids, as no answer can name another; equal queries are asked once. Lists are cut into chunks
    and queries into blocks, so no task holds a whole list or all queries. A query for which the
    probed lists hold too few rows goes on through all lists, so it gets ``nearest`` rows, or all
    there are. Rows that repeat an id are ranked each.
    """
    spark = table.sparkSession
    scratch = Scratch(spark, "ads-search")
    keep = nearest + 1
    rows = scratch.put(usable_vectors(table, id_col, vector, None), "rows")
    lowest = F.row_number().over(Window.partitionBy("h1", "h2").orderBy("vec_id"))
    nodes = scratch.put(
        rows.withColumn("k", lowest)
        .where(F.col("k") <= keep)
        .groupBy("h1", "h2")
        .agg(
            F.min("vec_id").alias("c"),
            F.array_sort(F.collect_list("vec_id")).alias("ids"),
            F.any_value("vector").alias("vector"),
        ),
        "nodes",
    )
    total = nodes.count()
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    share = min(1 << 32, (SAMPLE << 32) // total)
    sample = nodes.where(F.pmod(F.xxhash64(F.lit(9), "c"), F.lit(1 << 32)) < share)
    sampled = sample.select("c", "vector").orderBy("c").toPandas()
    if sampled.empty:
        sampled = nodes.select("c", "vector").orderBy("c").limit(1).toPandas()
    index = fit(np.stack(sampled["vector"].to_list()), total)

    @F.arrow_udf("array<int>")
    def lists_of(vectors: pa.Array) -> pa.Array:
        return pa.array(index.near_lists(index.turned(matrix(vectors))).tolist(), pa.list_(pa.int32()))

    placed = scratch.put(
        nodes.select("c", "vector", lists_of("vector")[0].alias("list")), "placed"
    )
    asking = rows.where(F.pmod("vec_id", F.lit(query_step)) == 0).select(
        F.col("vec_id").alias("query_id"), "h1", "h2"
    )
    asked = scratch.put(
        nodes.join(asking.select("h1", "h2").distinct(), ["h1", "h2"], "left_semi").select(
            F.col("c").alias("q"), "vector", lists_of("vector").alias("near")
        ),
        "asked",
    )
    blocks = max(1, -(-asked.count() // QUERY_ROWS))
    sizes = placed.groupBy("list").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(CHUNK_ROWS)).cast("int").alias("chunks")
    )
    chunks = F.broadcast(spark.createDataFrame(sizes.collect(), "list int, chunks int"))
    spread = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    key = ["list", "chunk", "block"]
    shelves = placed.join(chunks, "list").select(
        "c", "vector", "list", F.pmod(F.xxhash64("c"), "chunks").cast("int").alias("chunk"), spread
    )

    def probe(first: int, count: int, queries: DataFrame) -> DataFrame:
        wanted = F.explode(F.slice("near", first, count)).alias("list")
        probes = (
            queries.select("q", "vector", "worst", wanted)
            .join(chunks, "list")
            .select(
                "q", "vector", "worst", "list",
                F.explode(F.expr("sequence(0, chunks - 1)")).alias("chunk"),
                F.pmod(F.xxhash64("q"), F.lit(blocks)).cast("int").alias("block"),
            )
        )
        grouped = shelves.groupBy(*key).cogroup(probes.groupBy(*key))
        return grouped.applyInArrow(_scanner(index, keep), FOUND)

    first = _best(probe(1, 1, asked.withColumn("worst", F.lit(None).cast("double"))), keep)
    found = first = scratch.put(first, "first")
    if index.probes > 1:
        bound = first.where(F.col("k") == keep).select("q", F.col("score").alias("worst"))
        rest = probe(2, index.probes - 1, asked.join(bound, "q", "left"))
        found = first.select("q", "c", "score").unionByName(rest)
    found = scratch.put(_best(found.select("q", "c", "score"), keep), "found")
    # Where the probed lists hold too few rows, all others are scanned as well.
    held = found.groupBy("q").agg(F.count(F.lit(1)).alias("n"))
    short = scratch.put(
        asked.join(held, "q", "left").where(F.coalesce("n", F.lit(0)) < min(keep, total)).drop("n"),
        "short",
    )
    lists = len(index.centres)
    if lists > index.probes and short.head(1):
        every = short.withColumn("worst", F.lit(None).cast("double"))
        more = probe(index.probes + 1, lists - index.probes, every)
        found = scratch.put(
            _best(found.select("q", "c", "score").unionByName(more), keep), "completed"
        )
    named = (
        found.select("q", "c", "score")
        .join(nodes.select("c", "ids"), "c")
        .select("q", "score", F.explode("ids").alias("vec_id"))
    )
    top = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    named = scratch.put(
        named.withColumn("k", F.row_number().over(top)).where(F.col("k") <= keep), "named"
    )
    own = asking.join(nodes.select("h1", "h2", F.col("c").alias("q")), ["h1", "h2"])
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        own.select("query_id", "q")
        .distinct()
        .join(named, "q")
        .where("vec_id != query_id")
        .withColumn("rank", F.row_number().over(place))
        .where(F.col("rank") <= nearest)
        .select("query_id", "rank", "vec_id", "score")
    )

