"""Joins and ordered scans that survive a key holding a large share of all rows.

A key is *hot* when it has more rows than a task should hold, ``rows_per_task``, whatever the
size of the table. A table has at most one hot key per ``rows_per_task`` rows, so everything
keyed by hot keys is that much smaller than the table: at 2,000,000 rows to a task, a trillion
rows have at most 500,000 of them, which a broadcast bears. Without hot keys every function
here is the plain join or window.

Hot keys only decide how the work is split. The result never depends on them.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from matchlake.functions.search import count_before
from matchlake.session import pinned

ROWS_PER_TASK = 2_000_000
#: Rows a task of a spread scan gets, unless one key has more, and slices the rows are counted in.
ROWS_AT_ONCE = 64_000
COUNTED_IN = 16
#: Quantiles asked of a hot key for every piece it is cut into, at least, and their accuracy.
STEPS_PER_PIECE = 4
LEAST_STEPS = 1000
ACCURACY_PER_STEP = 10
LOWEST = -(2**63)
HIGHEST = 2**63 - 1


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


@dataclass(frozen=True)
class HotKeys:
    """Row counts of the hot values of ``keys``, by key hash, and ``total`` rows of all keys.

    A total of 0 is not known.
    """

    keys: tuple[str, ...]
    rows: Mapping[int, int] = field(default_factory=dict)
    rows_per_task: int = ROWS_PER_TASK
    total: int = 0

    def __bool__(self) -> bool:
        return bool(self.rows)

    def is_hot(self) -> Column:
        if not self.rows:
            return F.lit(False)
        return key_hash(self.keys).isin(list(self.rows))

    def check(self, keys: Sequence[str]) -> None:
        if self.rows and tuple(keys) != self.keys:
            raise ValueError(f"hot keys of {self.keys}, but the work is keyed by {tuple(keys)}")

    def pieces(self) -> dict[int, int]:
        """Into how many pieces each hot key is cut."""
        return {h: -(-n // self.rows_per_task) for h, n in self.rows.items()}

    def spread(self, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        """``df`` by ``keys`` over as many partitions as its rows ask for.

        Rows of one key look alike and compress well, so partitions merged by their bytes hold
        far more of them than a task should sort.
        """
        number = -(-self.total // ROWS_AT_ONCE)
        return df.repartition(number, *keys) if number > 1 else df


def find_hot_keys(
    df: DataFrame, keys: Sequence[str], rows_per_task: int = ROWS_PER_TASK
) -> HotKeys:
    """The keys with more than ``rows_per_task`` rows, counted exactly."""
    return find_all_hot_keys(df, [keys], rows_per_task)[0]


def find_all_hot_keys(
    df: DataFrame, key_sets: Sequence[Sequence[str]], rows_per_task: int = ROWS_PER_TASK
) -> list[HotKeys]:
    """``find_hot_keys`` for several keys of one table, in one pass over the key columns.

    Rows are counted before they are shuffled, and the counts are spread over all tasks by the
    key's hash; only the hot ones, fewer than rows / ``rows_per_task``, reach the driver, and the
    number of all rows in ``COUNTED_IN`` parts.
    """
    hashes = F.array(
        *[
            F.struct(F.lit(i).alias("keys"), key_hash(keys).alias("hash"))
            for i, keys in enumerate(key_sets)
        ]
    )
    many = (
        df.select(F.explode(hashes).alias("_k"))
        .groupBy("_k.keys", "_k.hash")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("keys", F.pmod("hash", F.lit(COUNTED_IN)))
        .agg(
            F.sum("n").alias("total"),
            F.collect_list(F.when(F.col("n") > rows_per_task, F.struct("hash", "n"))).alias("hot"),
        )
        .collect()
    )
    return [
        HotKeys(
            tuple(keys),
            {h["hash"]: h["n"] for r in many if r["keys"] == i for h in r["hot"]},
            rows_per_task,
            sum(r["total"] for r in many if r["keys"] == i),
        )
        for i, keys in enumerate(key_sets)
    ]


NO_HOT_KEYS = HotKeys(())


# --- joins -------------------------------------------------------------------


def spread_join(
    many: DataFrame,
    one: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    hot: HotKeys = NO_HOT_KEYS,
    how: str = "inner",
) -> DataFrame:
    """Join ``many`` to ``one`` (at most one row per key) on ``keys``.

    Rows of a hot key are dealt over several pieces by the hash of ``spread_by``, and
    the single matching row is repeated for each piece.
    """
    if not hot:
        return many.join(one, list(keys), how)
    hot.check(keys)
    pieces = F.broadcast(_per_hash(many.sparkSession, hot.pieces(), "_pieces int"))
    dealt = (
        many.withColumn("_hash", key_hash(keys))
        .join(pieces, "_hash", "left")
        .withColumn(
            "_piece",
            F.when(
                F.col("_pieces").isNotNull(),
                F.pmod(F.xxhash64(*spread_by), F.col("_pieces")).cast("int"),
            ).otherwise(0),
        )
        .drop("_hash", "_pieces")
    )
    repeated = (
        one.withColumn("_hash", key_hash(keys))
        .join(pieces, "_hash", "left")
        .withColumn(
            "_piece", F.explode(F.sequence(F.lit(0), F.coalesce("_pieces", F.lit(1)) - 1))
        )
        .drop("_hash", "_pieces")
    )
    return dealt.join(repeated, [*keys, "_piece"], how).drop("_piece")


def _per_hash(spark: SparkSession, values: Mapping[int, object], ddl: str) -> DataFrame:
    return spark.createDataFrame(list(values.items()), f"_hash bigint, {ddl}")


# --- ordered scans -----------------------------------------------------------


@dataclass(frozen=True)
class Scan:
    """One running value: its kind and the column it runs over.

    ``sum``, ``min``, ``max`` and ``last`` (last non-null) include the current row,
    ``lag`` is the previous row's value, ``total`` the sum and ``lowest`` the minimum over
    the whole key. ``fit`` takes points ``struct(y, x)`` and gives their count, means and
    centred sums; points should be near zero, as partial means of far ones are not exact.
    """

    kind: str
    value: Column

    def local(self, ordered: WindowSpec, frame: WindowSpec, whole: WindowSpec) -> Column:
        value = self.value
        match self.kind:
            case "sum":
                return F.sum(value).over(frame)
            case "min":
                return F.min(value).over(frame)
            case "max":
                return F.max(value).over(frame)
            case "last":
                return F.last(value, ignorenulls=True).over(frame)
            case "lag":
                return F.lag(F.struct(value.alias("v"))).over(ordered)
            case "total":
                return F.sum(value).over(whole)
            case "lowest":
                return F.min(value).over(whole)
            case "fit":
                return F.struct(*[a.over(frame).alias(n) for n, a in _fit(value).items()])
        raise ValueError(f"unknown scan {self.kind!r}")

    def summary(self, order: Column) -> Column:
        """The value one piece of a key hands on to the next pieces."""
        value = self.value
        match self.kind:
            case "sum" | "total":
                return F.sum(value)
            case "min" | "lowest":
                return F.min(value)
            case "max":
                return F.max(value)
            case "last":
                return F.max_by(value, F.when(value.isNotNull(), order))
            case "lag":
                return F.max_by(F.struct(value.alias("v")), order)
            case "fit":
                return F.struct(*[a.alias(n) for n, a in _fit(value).items()])
        raise ValueError(f"unknown scan {self.kind!r}")

    def carry(self, summary: Column, earlier: WindowSpec, whole: WindowSpec) -> Column:
        match self.kind:
            case "sum":
                return F.sum(summary).over(earlier)
            case "min":
                return F.min(summary).over(earlier)
            case "max":
                return F.max(summary).over(earlier)
            case "total":
                return F.sum(summary).over(whole)
            case "lowest":
                return F.min(summary).over(whole)
            case "fit":
                return _fit_of_fits(summary, earlier, whole)
        return F.last(summary, ignorenulls=True).over(earlier)

    def merge(self, carry: Column, local: Column) -> Column:
        match self.kind:
            case "sum":
                return F.coalesce(carry + local, carry, local)
            case "min":
                return F.least(carry, local)
            case "max":
                return F.greatest(carry, local)
            case "total" | "lowest":
                return carry
            case "fit":
                return merged_fit(carry, local)
        return F.coalesce(local, carry)

    def result(self, merged: Column) -> Column:
        return merged["v"] if self.kind == "lag" else merged


Scans = Mapping[str, Scan]


def _fit(point: Column) -> dict[str, Column]:
    y, x = point["y"], point["x"]
    return {
        "n": F.regr_count(y, x),
        "mx": F.regr_avgx(y, x),
        "my": F.regr_avgy(y, x),
        "sxx": F.regr_sxx(y, x),
        "sxy": F.regr_sxy(y, x),
    }


def _fit_of_fits(fit: Column, window: WindowSpec, whole: WindowSpec) -> Column:
    """The fits of several pieces as one.

    Means are taken relative to the key's lowest ones, so the level of a series cancels before
    anything is squared and only its spread over the pieces is left.
    """

    def total(value: Column) -> Column:
        return F.sum(value).over(window)

    n = total(fit["n"])
    x0, y0 = F.min(fit["mx"]).over(whole), F.min(fit["my"]).over(whole)
    dx, dy = fit["mx"] - x0, fit["my"] - y0
    mx, my = total(fit["n"] * dx) / n, total(fit["n"] * dy) / n
    return F.struct(
        n.alias("n"),
        (x0 + mx).alias("mx"),
        (y0 + my).alias("my"),
        (total(fit["sxx"] + fit["n"] * dx * dx) - n * mx * mx).alias("sxx"),
        (total(fit["sxy"] + fit["n"] * dx * dy) - n * mx * my).alias("sxy"),
    )


def merged_fit(a: Column, b: Column) -> Column:
    """The fit of two disjoint sets of points together."""
    n = a["n"] + b["n"]
    dx, dy = b["mx"] - a["mx"], b["my"] - a["my"]
    weight = a["n"] * b["n"] / n
    joint = F.struct(
        n.alias("n"),
        ((a["n"] * a["mx"] + b["n"] * b["mx"]) / n).alias("mx"),
        ((a["n"] * a["my"] + b["n"] * b["my"]) / n).alias("my"),
        (a["sxx"] + b["sxx"] + dx * dx * weight).alias("sxx"),
        (a["sxy"] + b["sxy"] + dx * dy * weight).alias("sxy"),
    )
    empty_a, empty_b = F.coalesce(a["n"], F.lit(0)) == 0, F.coalesce(b["n"], F.lit(0)) == 0
    return F.when(empty_a, b).when(empty_b, a).otherwise(joint)


def running(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    tie: str | None,
    scans: Scans | Sequence[Scans],
    hot: HotKeys = NO_HOT_KEYS,
    spread: bool = False,
) -> DataFrame:
    """Add running values per key, in the order of the bigint columns ``pos, tie``.

    Given several groups of scans, later ones may use the values of earlier ones. Without
    ``tie``, rows of equal ``pos`` are peers and see each other's values. Hot keys are cut
    at quantiles of their own order, scanned piece by piece, and the pieces' summaries (one
    row each) are scanned and added back. With ``spread`` the other keys go to as many tasks as
    their rows ask for.
    """
    steps = [scans] if isinstance(scans, Mapping) else list(scans)
    light = df.where(~hot.is_hot()) if hot else df
    if spread:
        light = hot.spread(light, keys)
    for step in steps:
        light = _scan_plain(light, keys, pos, tie, step)
    if not hot:
        return light
    hot.check(keys)
    heavy = _cut(pinned(df.where(hot.is_hot())), keys, pos, tie, hot)
    for step in steps:
        heavy = _scan_pieces(heavy, keys, pos, tie, step)
    return light.unionByName(heavy.drop("_piece"))


def _windows(
    keys: Sequence[str], pos: str, tie: str | None
) -> tuple[WindowSpec, WindowSpec, WindowSpec]:
    whole = Window.partitionBy(*keys)
    ordered = whole.orderBy(*([pos] if tie is None else [pos, tie]))
    first, current = Window.unboundedPreceding, Window.currentRow
    frame = (
        ordered.rangeBetween(first, current) if tie is None
        else ordered.rowsBetween(first, current)
    )
    return ordered, frame, whole


def _scan_plain(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    tie: str | None,
    scans: Scans,
) -> DataFrame:
    windows = _windows(keys, pos, tie)
    return df.select(
        "*", *[s.result(s.local(*windows)).alias(name) for name, s in scans.items()]
    )


def _scan_pieces(
    cut: DataFrame, keys: Sequence[str], pos: str, tie: str | None, scans: Scans
) -> DataFrame:
    windows = _windows([*keys, "_piece"], pos, tie)
    order = F.struct(pos) if tie is None else F.struct(pos, tie)
    local = cut.select(
        "*", *[s.local(*windows).alias(f"_local_{n}") for n, s in scans.items()]
    )
    whole = Window.partitionBy(*keys)
    earlier = whole.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        cut.groupBy(*keys, "_piece")
        .agg(*[s.summary(order).alias(f"_sum_{n}") for n, s in scans.items()])
        .select(
            *[F.col(k).alias(f"_k_{k}") for k in keys],
            F.col("_piece").alias("_k_piece"),
            *[
                s.carry(F.col(f"_sum_{n}"), earlier, whole).alias(f"_carry_{n}")
                for n, s in scans.items()
            ],
        )
    )
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    same.append(F.col("_piece") == F.col("_k_piece"))
    joined = local.join(F.broadcast(carried), reduce(Column.__and__, same), "left")
    return joined.select(
        *cut.columns,
        *[
            s.result(s.merge(F.col(f"_carry_{n}"), F.col(f"_local_{n}"))).alias(n)
            for n, s in scans.items()
        ],
    )


def _cut(
    heavy: DataFrame, keys: Sequence[str], pos: str, tie: str | None, hot: HotKeys
) -> DataFrame:
    """Add ``_piece``: the number of cut points of the key before the row."""
    spark = heavy.sparkSession
    hashed = heavy.withColumn("_hash", key_hash(keys))
    points = _cut_points(hashed, pos, tie, hot.pieces())
    longest = max((len(p) for p in points.values()), default=0)
    table = _per_hash(spark, points, "_cuts array<struct<pos bigint, tie bigint>>")
    here = F.struct(
        F.col(pos).cast("bigint").alias("pos"),
        (F.lit(HIGHEST) if tie is None else F.col(tie).cast("bigint")).alias("tie"),
    )
    piece = count_before(
        F.coalesce("_cuts", F.array().cast("array<struct<pos:bigint,tie:bigint>>")),
        longest,
        lambda point: point < here,
    )
    if tie is None:
        piece = count_before(
            F.coalesce("_cuts", F.array().cast("array<struct<pos:bigint,tie:bigint>>")),
            longest,
            lambda point: point["pos"] < here["pos"],
        )
    return (
        hashed.join(F.broadcast(table), "_hash", "left")
        .withColumn("_piece", piece)
        .drop("_hash", "_cuts")
    )


def _cut_points(
    hashed: DataFrame, pos: str, tie: str | None, pieces: Mapping[int, int]
) -> dict[int, list[tuple[int, int]]]:
    """Cut points per hot key, fixed here so that every branch cuts alike.

    A position that fills whole pieces by itself is cut further by ``tie``.
    """
    by_pos = _quantiles(hashed, ["_hash"], pos, {(h,): n for h, n in pieces.items()})
    points: dict[int, list[tuple[int, int]]] = {}
    crowded: dict[tuple[int, int], int] = {}
    for (key,), cuts in by_pos.items():
        points[key] = [(p, HIGHEST) for p in sorted(set(cuts))]
        if tie is not None:
            crowded |= {(key, p): cuts.count(p) for p in set(cuts) if cuts.count(p) > 1}
    if crowded:
        instants = hashed.withColumn("_pos", F.col(pos).cast("bigint"))
        wanted = hashed.sparkSession.createDataFrame(
            list(crowded), "_hash bigint, _pos bigint"
        )
        instants = instants.join(F.broadcast(wanted), ["_hash", "_pos"])
        by_tie = _quantiles(
            instants, ["_hash", "_pos"], tie, {k: n + 1 for k, n in crowded.items()}
        )
        for (key, p), cuts in by_tie.items():
            points[key] += [(p, LOWEST), *[(p, c) for c in set(cuts)]]
            points[key] = sorted(set(points[key]))
    return points


def _quantiles(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    pieces: Mapping[tuple[int, ...], int],
) -> dict[tuple[int, ...], list[int]]:
    steps = max(LEAST_STEPS, STEPS_PER_PIECE * max(pieces.values(), default=1))
    grid = [i / steps for i in range(1, steps)]
    accuracy = ACCURACY_PER_STEP * steps
    rows: Iterable = (
        df.groupBy(*group)
        .agg(F.percentile_approx(F.col(value).cast("bigint"), grid, accuracy).alias("q"))
        .collect()  # one row per hot key; all quantiles are a few per piece
    )
    cuts: dict[tuple[int, ...], list[int]] = {}
    for row in rows:
        key = tuple(row[g] for g in group)
        n = pieces.get(key, 1)
        cuts[key] = [row["q"][i * steps // n - 1] for i in range(1, n)]
    return cuts
