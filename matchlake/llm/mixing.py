"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks."""

from __future__ import annotations

import heapq
import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from matchlake.llm.shared import Scratch

#: Fixed: a word of a text.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
#: Words of a block, the unit that sources are given.
BLOCK = 128
#: Words expected in a shard, the unit of work; a source spreads over shards by its size.
SHARD_WORDS = 1 << 18
SPREAD_WORDS = 1 << 13
SEED = 17


def words(text: str) -> Column:
    """Number of words of a whole text; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: dict[str | None, int],
    weights: Sequence[float] = WEIGHTS,
    share: float = 1.0,
    max_repeats: float = MAX_REPEATS,
) -> dict[str | None, float]:
    """Words each source should give.

    Sources by code point, null last, weigh ``weights`` in turn and share ``share`` of all
    words. A target above ``max_repeats`` times its source stops there; the excess is shared
    among the others by weight, until none is above.
    """
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, targets = share * sum(sizes.values()), list(order), dict.fromkeys(order, 0.0)
    while open_:
        total = sum(weight[s] for s in open_)
        full = [s for s in open_ if left * weight[s] / total > max_repeats * sizes[s]]
        if not full:
            targets |= {s: left * weight[s] / total for s in open_}
            break
        for s in full:
            targets[s] = float(max_repeats * sizes[s])
        left -= sum(targets[s] for s in full)
        open_ = [s for s in open_ if s not in full]
    return targets


def apportion(shares: Sequence[float], limits: Sequence[int], seats: int) -> list[int]:
    """Seats by the highest quotients share / (2 k + 1), never more than a limit each.

    Ties go to the earlier party. Returns fewer seats in all if the limits end them.
    """
    given = [0] * len(shares)
    queue = [(-x, i) for i, x in enumerate(shares) if x > 0 and limits[i] > 0]
    heapq.heapify(queue)
    for _ in range(seats):
        if not queue:
            break
        _, i = queue[0]
        given[i] += 1
        if given[i] < limits[i]:
            heapq.heapreplace(queue, (-shares[i] / (2 * given[i] + 1), i))
        else:
            heapq.heappop(queue)
    return given


def source_quotas(shares: Sequence[float], limits: Sequence[int], block: int) -> list[int]:
    """Words each source gives: whole blocks by the highest quotients, then a last, partial block.

    No source gets a block that its share does not fill. What all of them are short of their
    shares is given word by word, again by the highest quotients, so that a source smaller than a
    block has its part too.
    """
    whole = [min(int(s // block), limit // block) for s, limit in zip(shares, limits)]
    given = apportion(shares, whole, sum(whole))
    left = [s - block * g for s, g in zip(shares, given)]
    most = [limit - block * g for limit, g in zip(limits, given)]
    words = apportion(left, most, round(sum(shares)) - block * sum(given))
    return [block * g + w for g, w in zip(given, words)]


def take_blocks(
    sizes: np.ndarray, quota: int, block: int, draw: np.random.Generator
) -> tuple[int, np.ndarray, np.ndarray]:
    """Whole passes over documents in a row, and the word ranges of a last, partial pass.

    The documents' words are cut into blocks. After the whole passes that ``quota`` words make,
    blocks in seeded order give the remaining words, the last of them in part.
    """
    total = int(sizes.sum())
    passes, rest = divmod(quota, total)
    count = -(-total // block)
    starts = draw.permutation(count).astype(np.int64) * block
    lengths = np.minimum(block, total - starts)
    before = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    used = before < rest
    starts, lengths, before = starts[used], lengths[used], before[used]
    ends = starts + np.minimum(lengths, rest - before)
    order = np.argsort(starts)
    return passes, starts[order], ends[order]


@dataclass(frozen=True)
class Mix:
    """A mix decided for all sources: target and size by source number, and its parameters."""

    targets: dict[int, float]
    sizes: dict[int, int]
    block: int
    max_repeats: float
    seed: int


@dataclass
class Taken:
    """Rows of one shard in seeded order, and what each of them gives."""

    order: np.ndarray
    taken: np.ndarray
    repeats: np.ndarray
    ranges: list[tuple[list[int], list[int]]]


def mix_shard(rows: pa.Table, plan: Mix) -> Taken:
    """Give one shard's blocks to its sources, then each source's words to its documents."""
    columns = {c: rows.column(c).to_numpy() for c in ("_source_no", "_draw", "_size", "_shard")}
    order = np.lexsort((columns["_size"], columns["_draw"], columns["_source_no"]))
    source, size = columns["_source_no"][order], columns["_size"][order]
    names, at = np.unique(source, return_index=True)
    sums = np.add.reduceat(size, at)
    shares = [plan.targets[int(s)] * int(n) / plan.sizes[int(s)] for s, n in zip(names, sums)]
    quotas = source_quotas(shares, [int(plan.max_repeats * int(n)) for n in sums], plan.block)
    taken, repeats, ranges = np.zeros(len(size), np.int64), np.zeros(len(size), np.int32), []
    for name, low, high, quota in zip(names, at, [*at[1:], len(size)], quotas):
        draw = np.random.default_rng([plan.seed, int(columns["_shard"][0]), int(name)])
        passes, starts, ends = take_blocks(size[low:high], quota, plan.block, draw)
        last = np.cumsum(size[low:high])
        first = last - size[low:high]
        begin, end = np.searchsorted(ends, first, "right"), np.searchsorted(starts, last, "left")
        repeats[low:high] = passes
        for i in range(high - low):
            a = np.maximum(starts[begin[i] : end[i]], first[i]) - first[i]
            b = np.minimum(ends[begin[i] : end[i]], last[i]) - first[i]
            taken[low + i] = passes * int(size[low + i]) + int((b - a).sum())
            ranges.append((a.tolist(), b.tolist()))
    return Taken(order, taken, repeats, ranges)


def _dealt(
    rows: DataFrame,
    sizes: dict[str | None, int],
    weights: Sequence[float],
    share: float,
    max_repeats: float,
    block: int,
    shard_words: int,
    seed: int,
) -> tuple[DataFrame, Mix]:
    """Rows (_id, _source, _size, ...) with their source's figures and their shard."""
    targets = source_targets(sizes, weights, share, max_repeats)
    shards = max(1, -(-sum(sizes.values()) // shard_words))
    table = rows.sparkSession.createDataFrame(
        [
            (s, i, min(shards, max(1, sizes[s] // SPREAD_WORDS)), sizes[s], float(t))
            for i, (s, t) in enumerate(targets.items())
        ],
        "_key string, _source_no int, _spread long, _source_size long, _target double",
    )
    draw = F.xxhash64(F.lit(seed), F.col("_id"))
    start = F.pmod(F.xxhash64(F.lit(seed), F.col("_source")), F.lit(shards))
    dealt = (
        rows.join(F.broadcast(table), F.col("_source").eqNullSafe(F.col("_key")))
        .withColumn("_draw", draw)
        .withColumn("_shard", F.pmod(start + F.pmod("_draw", "_spread"), F.lit(shards)))
    )
    plan = Mix(
        {i: float(t) for i, t in enumerate(targets.values())},
        {i: sizes[s] for i, s in enumerate(targets)},
        block,
        max_repeats,
        seed,
    )
    return dealt, plan


def _totals(rows: DataFrame) -> dict[str | None, int]:
    """Words per source: the one thing that reaches the driver, a row for each source."""
    return {r[0]: r[1] for r in rows.groupBy("_source").agg(F.sum("_size")).collect()}


def mix(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    id_col: str = "doc_id",
    weights: Sequence[float] = WEIGHTS,
    share: float = 1.0,
    max_repeats: int = MAX_REPEATS,
    block: int = BLOCK,
    shard_words: int = SHARD_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """What the mix takes of every document.

    Returns one row per input row: (doc_id, source, size, source_size, target, taken, repeats,
    starts, ends). ``taken`` counts words with repeats: ``repeats`` whole copies and the words
    in the ranges [start, end). Documents are dealt over shards of about ``shard_words`` words
    by the hash of their id; a source spreads over as many shards as its size allows, so a hot
    source is in all of them and a small one in one. Within a shard the blocks go to sources by
    the highest quotients and are drawn in seeded order, so no task holds more than a shard and
    equal input gives equal results. Rows without words take no part and give nothing; null text
    has no words, a null source is a source of its own, repeated rows count each, and an empty
    table gives an empty one.
    """
    rows = Scratch(docs.sparkSession, "mixing").put(
        docs.select(
            F.col(f"`{id_col}`").alias("_id"),
            F.col(f"`{source}`").alias("_source"),
            words(f"`{text}`").alias("_size"),
        ),
        "sizes",
    )
    dealt, plan = _dealt(
        rows, _totals(rows), weights, share, max_repeats, block, shard_words, seed
    )
    made = "_taken long, _repeats int, _starts array<long>, _ends array<long>"
    schema = StructType(dealt.schema.fields + StructType.fromDDL(made).fields)

    def work(shard: pa.Table) -> pa.Table:
        out = mix_shard(shard, plan)
        table = shard.take(out.order)
        for name, values, kind in (
            ("_taken", out.taken, pa.int64()),
            ("_repeats", out.repeats, pa.int32()),
            ("_starts", [a for a, _ in out.ranges], pa.list_(pa.int64())),
            ("_ends", [b for _, b in out.ranges], pa.list_(pa.int64())),
        ):
            table = table.append_column(name, pa.array(values, kind))
        return table

    none = F.array().cast("array<long>")
    idle = dealt.where("_size = 0").select(
        "*",
        F.lit(0).cast("long").alias("_taken"),
        F.lit(0).alias("_repeats"),
        none.alias("_starts"),
        none.alias("_ends"),
    )
    given = dealt.where("_size > 0").groupBy("_shard").applyInArrow(work, schema)
    return given.unionByName(idle).select(
        F.col("_id").alias("doc_id"),
        F.col("_source").alias("source"),
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        F.col("_taken").alias("taken"),
        F.col("_repeats").alias("repeats"),
        F.col("_starts").alias("starts"),
        F.col("_ends").alias("ends"),
    )


def cut_words(text: str, starts: Sequence[int], ends: Sequence[int]) -> str:
    """The words of the ranges [start, end), with the white space between them as it is."""
    spans = [m.span() for m in re.finditer(WORD, text)]
    return " ".join(text[spans[a][0] : spans[b - 1][1]] for a, b in zip(starts, ends))


def mixed_documents(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    id_col: str = "doc_id",
    weights: Sequence[float] = WEIGHTS,
    share: float = 1.0,
    max_repeats: int = MAX_REPEATS,
    block: int = BLOCK,
    shard_words: int = SHARD_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """The mix as documents, with the columns of ``docs``.

    A document comes once for each whole copy the mix takes; a document taken in part comes
    (once more) with the text of the words taken. Documents of which nothing is taken go, also
    those without words.
    """
    rows = docs.select(
        F.col(f"`{id_col}`").alias("_id"),
        F.col(f"`{source}`").alias("_source"),
        words(f"`{text}`").alias("_size"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
    )
    dealt, plan = _dealt(
        rows, _totals(rows.drop("_row")), weights, share, max_repeats, block, shard_words, seed
    )
    needed = dealt.where("_size > 0").select(
        "_shard", "_source_no", "_draw", "_size", F.col("_row").getField(text).alias("_text"), "_row"
    )
    made = StructType.fromDDL("_part string")
    schema = StructType([needed.schema["_row"], *made.fields])

    def work(shard: pa.Table) -> pa.Table:
        out = mix_shard(shard, plan)
        texts = shard.column("_text")
        at, parts = [], []
        for i, repeats, (starts, ends) in zip(out.order, out.repeats, out.ranges):
            at += [i] * int(repeats)
            parts += [None] * int(repeats)
            if starts:
                at.append(i)
                parts.append(cut_words(texts[int(i)].as_py(), starts, ends))
        picked = shard.select(["_row"]).take(pa.array(at, pa.int64()))
        return picked.append_column("_part", pa.array(parts, pa.string()))

    mixed = needed.groupBy("_shard").applyInArrow(work, schema)
    return mixed.select(
        *[
            (
                F.coalesce("_part", F.col("_row").getField(c))
                if c == text
                else F.col("_row").getField(c)
            ).alias(c)
            for c in docs.columns
        ]
    )
