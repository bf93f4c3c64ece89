"""Operators against plain Python on random input, with and without hot keys."""

import random
import re
from bisect import bisect_right
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from matchlake.operators import asof, metrics, rank_history, replay, skew
from matchlake.operators.skew import Scan, find_hot_keys, running, spread_join

T0 = datetime(2026, 1, 1)
KEYS = 6


def skewed_key(rng):
    """A third of all rows go to key 0."""
    return 0 if rng.random() < 0.4 else rng.randrange(1, KEYS)


@pytest.fixture(params=[False, True], ids=["plain", "hot"])
def split(request):
    """Find hot keys at a tiny threshold, or none."""

    def find(df, keys):
        hot = find_hot_keys(df, keys, 10 if request.param else skew.ROWS_PER_TASK)
        assert bool(hot) == request.param
        return hot

    return find


def test_hot_keys_are_the_large_ones(spark):
    df = spark.createDataFrame([(0,)] * 50 + [(i,) for i in range(1, 40)], "k int")
    hot = find_hot_keys(df, ["k"], 10)
    assert list(hot.rows.values()) == [50]
    assert hot.pieces() == {next(iter(hot.rows)): 5}
    assert df.where(hot.is_hot()).count() == 50
    assert not find_hot_keys(df, ["k"], 50)
    assert not find_hot_keys(df.where("false"), ["k"], 10)


@pytest.mark.parametrize("how, expected", [("inner", 90), ("left_anti", 10)])
def test_spread_join_loses_and_repeats_nothing(spark, split, how, expected):
    many = spark.range(100).withColumn("k", F.when(F.col("id") < 50, 0).otherwise(F.col("id")))
    one = spark.range(90).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    if how == "left_anti":
        one = one.drop("v")
    joined = spread_join(many, one, ["k"], ["id"], split(many, ["k"]), how)
    assert joined.count() == expected
    assert joined.select("id").distinct().count() == expected


def walk_rows(seed, instants):
    rng = random.Random(seed)
    return [(skewed_key(rng), rng.randrange(instants), i, rng.randint(-9, 9)) for i in range(400)]


# With one instant, a hot key can only be cut by its tie-breaker.
@pytest.mark.parametrize("instants", [200, 3, 1])
def test_running_values(spark, split, instants):
    rows = walk_rows(1, instants)
    df = spark.createDataFrame(rows, "k int, at bigint, i bigint, v int")
    v = F.col("v")
    scans = {
        "s": Scan("sum", v),
        "lo": Scan("min", v),
        "hi": Scan("max", v),
        "last": Scan("last", F.when(v > 0, v)),
        "lag": Scan("lag", v),
        "all": Scan("total", v),
    }
    found = running(df, ["k"], "at", "i", scans, split(df, ["k"])).collect()
    got = {r.i: (r.s, r.lo, r.hi, r.last, r.lag, r.all) for r in found}
    assert len(found) == len(rows)
    for key in range(KEYS):
        mine = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2]))
        values = [r[3] for r in mine]
        for n, row in enumerate(mine):
            upto = values[: n + 1]
            positive = [x for x in upto if x > 0]
            assert got[row[2]] == (
                sum(upto),
                min(upto),
                max(upto),
                positive[-1] if positive else None,
                values[n - 1] if n else None,
                sum(values),
            )


def test_running_values_of_peers(spark, split):
    rows = walk_rows(2, 40)
    df = spark.createDataFrame(rows, "k int, at bigint, i bigint, v int")
    scans = {"s": Scan("sum", F.col("v"))}
    found = running(df, ["k"], "at", None, scans, split(df, ["k"])).collect()
    for r in found:
        assert r.s == sum(x[3] for x in rows if x[0] == r.k and x[1] <= r["at"])


def rank_rows(seed, n=300, instants=60):
    rng = random.Random(seed)
    return [
        (
            skewed_key(rng),
            "gold",
            1,
            i,
            0,
            0,
            T0 + timedelta(milliseconds=rng.randrange(instants)),
            i,
            T0 + timedelta(milliseconds=rng.randrange(200)),
        )
        for i in range(n)
    ]


RANKS = (
    "player_id bigint, rank_tier string, rank_division int, rank_points int, wins int, "
    "losses int, updated_at timestamp, seq bigint, arrival_ts timestamp"
)


def fact_rows(seed, n=300):
    rng = random.Random(seed)
    return [
        (i, skewed_key(rng), T0 + timedelta(milliseconds=rng.randrange(-5, 65)), rng.randrange(210))
        for i in range(n)
    ]


def epoch_ms(t):
    return round((t - datetime(1970, 1, 1)).total_seconds() * 1000)


@pytest.mark.parametrize("join", [asof.rank_as_of, asof.rank_as_of_broadcast])
def test_as_of_join(spark, split, join):
    ranks, facts = rank_rows(3), fact_rows(4)
    versions = spark.createDataFrame(ranks, RANKS)
    df = spark.createDataFrame(
        [f[:3] for f in facts], "id bigint, player_id bigint, started_at timestamp"
    )
    hot = split(versions, ["player_id"])
    got = {
        r.id: (r.found, r.rank_points_at_match_start)
        for r in join(df, versions, "seq", "found", "id", hot).collect()
    }
    for i, player, start, _ in facts:
        past = [(r[6], r[7], r[3]) for r in ranks if r[0] == player and r[6] <= start]
        assert got[i] == ((True, max(past)[2]) if past else (False, 0))


def test_two_clocks(spark, split):
    ranks, facts = rank_rows(5), fact_rows(6)
    base = epoch_ms(T0)
    versions = spark.createDataFrame(ranks, RANKS)
    df = spark.createDataFrame(
        [(i, p, s, base + f) for i, p, s, f in facts],
        "id bigint, player_id bigint, started_at timestamp, fire_ms bigint",
    )
    hot = split(versions, ["player_id"])
    rows = replay.rank_on_two_clocks(df, versions, hot).collect()
    got = {r.id: (r.rank_tier_at_match_start, r.rank_points_at_match_start) for r in rows}
    assert len(rows) == len(facts)
    late = 0
    for i, player, start, fire in facts:
        past = [
            (r[6], r[8], r[7], r[3])
            for r in ranks
            if r[0] == player and r[6] <= start and epoch_ms(r[8]) <= base + fire
        ]
        assert got[i] == (("gold", max(past)[3]) if past else ("bronze", 0))
        late += bool(past) != any(r[0] == player and r[6] <= start for r in ranks)
    assert late


def test_points_history(spark, split):
    rng = random.Random(7)
    rows = [
        (skewed_key(rng), T0 + timedelta(milliseconds=rng.randrange(90)), i, rng.choice("wlll"))
        for i in range(400)
    ]
    rows = [(p, t, i, "win" if r == "w" else "loss") for p, t, i, r in rows]
    df = spark.createDataFrame(
        rows, "player_id bigint, updated_at timestamp, seq bigint, result string"
    )
    found = rank_history.points_history(df, split(df, ["player_id"])).collect()
    got = {r.seq: (r.rank_points, r.wins, r.losses) for r in found}
    floors = 0
    for player in range(KEYS):
        points = wins = losses = 0
        for _, _, i, result in sorted((r for r in rows if r[0] == player), key=lambda r: r[1:3]):
            won = result == "win"
            floors += not won and points < 15
            points = max(0, points + (30 if won else -15))
            wins, losses = wins + won, losses + (not won)
            assert got[i] == (points, wins, losses)
    assert floors


def sample_rows(seed, n=400):
    rng = random.Random(seed)
    seen, rows = set(), []
    while len(rows) < n:
        key, at = skewed_key(rng), rng.randrange(4000)
        if (key, at) not in seen:
            seen.add((key, at))
            rows.append((f"m{key}", "s", at * metrics.SECOND, float(rng.randrange(1000))))
    return rows


SAMPLE = "name string, series string, pos bigint, value double"


def test_trailing_sum_and_increase(spark, split):
    rows = sample_rows(8)
    df = spark.createDataFrame(rows, SAMPLE)
    hot = split(df, metrics.SERIES)
    got = {(r.name, r.pos): r.increase for r in metrics.increase(df, 300, hot=hot).collect()}
    for name in {r[0] for r in rows}:
        mine = sorted((r[2], r[3]) for r in rows if r[0] == name)
        steps = [(t, u, b if b < a else b - a) for (t, a), (u, b) in zip(mine, mine[1:])]
        for at, _ in mine:
            window = [s for t, u, s in steps if at - 300 * metrics.SECOND <= t and u <= at]
            assert got[name, at] == (pytest.approx(sum(window)) if window else None)


def test_all_rows_are_counted(spark):
    df = spark.createDataFrame([(0,)] * 50 + [(i,) for i in range(1, 40)] + [(None,)], "k int")
    for rows_per_task in (10, 50):
        assert find_hot_keys(df, ["k"], rows_per_task).total == 90
    assert find_hot_keys(df.where("false"), ["k"], 10).total == 0


def spread_over(df, key):
    """The numbers of partitions that shuffles by ``key`` go to."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return {int(n) for n in re.findall(rf"hashpartitioning\([^)]*{key}#\d+L?, (\d+)\)", plan)}


def test_growth_is_spread_by_rows(spark, monkeypatch):
    """Steps by series, then sums by slice, in as many tasks as the rows ask for."""
    rows = sample_rows(13)
    df = spark.createDataFrame(rows, SAMPLE)
    hot = find_hot_keys(df, metrics.SERIES)
    whole = metrics.increase(df, 300, hot=hot)
    monkeypatch.setattr(skew, "ROWS_AT_ONCE", 40)
    spread = metrics.increase(df, 300, hot=hot)
    assert spread_over(spread, "series") == {-(-len(rows) // 40)}
    assert spread_over(spread, "_slice") == {-(-2 * len(rows) // 40)}
    assert sorted(spread.collect()) == sorted(whole.collect())


def test_slopes_are_spread_by_rows(spark, monkeypatch):
    rows = sample_rows(14)
    df = spark.createDataFrame(rows, SAMPLE)
    hot = find_hot_keys(df, metrics.SERIES)
    whole = {(r.name, r.pos): r.slope for r in metrics.deriv(df, 300, hot=hot).collect()}
    monkeypatch.setattr(skew, "ROWS_AT_ONCE", 40)
    spread = metrics.deriv(df, 300, hot=hot)
    assert spread_over(spread, "_slice") == {-(-2 * len(rows) // 40)}
    got = {(r.name, r.pos): r.slope for r in spread.collect()}
    assert got.keys() == whole.keys()
    for k in got:
        assert got[k] == (whole[k] if whole[k] is None else pytest.approx(whole[k]))


@pytest.mark.parametrize("partitions", [1, 8, 16])
@pytest.mark.parametrize("level", [0.0, 1e9, 1e12])
def test_slopes_do_not_depend_on_the_plan(spark, level, partitions):
    """A series far above zero, whole and cut into pieces, from any number of partitions."""
    rows = [("m", "s", i * 15 * metrics.SECOND, level + i) for i in range(4000)]
    random.Random(partitions).shuffle(rows)
    df = spark.createDataFrame(rows, SAMPLE).repartition(partitions)
    for rows_per_task in (skew.ROWS_PER_TASK, 300):
        hot = find_hot_keys(df, metrics.SERIES, rows_per_task)
        assert bool(hot) == (rows_per_task == 300)
        slopes = [r.slope for r in metrics.deriv(df, 100_000, hot=hot).collect()]
        assert max(abs(s * 15 - 1) for s in slopes if s is not None) < 1e-9


def test_grid_against_plain_python(spark, split):
    rows = sample_rows(12)
    df = spark.createDataFrame(
        [(n, s, p + i % 997, v, T0) for i, (n, s, p, v) in enumerate(rows)],
        SAMPLE + ", ts timestamp",
    )
    hot = split(df, metrics.SERIES)
    got = {(r.name, r.pos): r.value for r in metrics.on_grid(df, 15, 60, hot=hot).collect()}
    want, tick = {}, 15 * metrics.SECOND
    for name in {r[0] for r in rows}:
        mine = sorted((p + i % 997, v) for i, (n, _, p, v) in enumerate(rows) if n == name)
        for t in range(0, 4200 * metrics.SECOND, tick):
            seen = [(p, v) for p, v in mine if t - 60 * metrics.SECOND <= p <= t]
            if seen:
                want[name, t] = seen[-1][1]
    assert got == want


def test_trailing_slope(spark, split):
    rows = sample_rows(9)
    df = spark.createDataFrame(rows, SAMPLE)
    hot = split(df, metrics.SERIES)
    got = {(r.name, r.pos): r.slope for r in metrics.deriv(df, 300, hot=hot).collect()}
    for name, _, at, _ in rows:
        window = [
            (r[2] / metrics.SECOND, r[3])
            for r in rows
            if r[0] == name and at - 300 * metrics.SECOND <= r[2] <= at
        ]
        n = len(window)
        mx, my = sum(x for x, _ in window) / n, sum(y for _, y in window) / n
        sxx = sum((x - mx) ** 2 for x, _ in window)
        sxy = sum((x - mx) * (y - my) for x, y in window)
        assert got[name, at] == (pytest.approx(sxy / sxx) if n > 1 else None)


def test_hold_with_long_series(spark, split):
    rows = sample_rows(10)
    df = spark.createDataFrame(rows, SAMPLE)
    hot = split(df, metrics.SERIES)
    held = metrics.hold(df, F.col("value") > 200, 60, hot=hot).collect()
    got = {(r.name, r.pos): r.state for r in held}
    for name in {r[0] for r in rows}:
        since = None
        for at, value in sorted((r[2], r[3]) for r in rows if r[0] == name):
            since = None if value <= 200 else at if since is None else since
            state = (
                "inactive"
                if since is None
                else "firing"
                if at - since >= 60 * metrics.SECOND
                else "pending"
            )
            assert got[name, at] == state


def test_sessions(spark, split):
    rng = random.Random(11)
    people = [(i, skewed_key(rng), i, rng.randrange(400)) for i in range(300)]
    base = datetime(1970, 1, 1)
    participants = spark.createDataFrame(
        [(i, m, p, base + timedelta(milliseconds=a)) for i, m, p, a in people],
        "id bigint, match_id bigint, player_id bigint, arrival_ts timestamp",
    )
    event_log = spark.createDataFrame(
        [(m, "x", base + timedelta(milliseconds=100 * m)) for m in range(KEYS)],
        "id bigint, map_name string, arrival_ts timestamp",
    )
    hot = split(participants, ["match_id"])
    arrivals = replay.match_arrivals(participants, event_log, 3, hot)
    got = {
        (r.match_id, r.session_start): (r.participants, r.events, r.fire_ms)
        for r in replay.quiet_sessions(arrivals, 3).collect()
    }
    expected = {}
    for match in range(KEYS):
        mine = sorted([(a, 1, 0) for _, m, _, a in people if m == match] + [(100 * match, 0, 1)])
        start = last = None
        for at, p, e in mine:
            if last is None or at - last > 3:
                start = at
            was = expected.get((match, start), (0, 0, 0))
            expected[match, start] = (was[0] + p, was[1] + e, at + 3)
            last = at
    assert got == expected


def test_binary_search(spark):
    from matchlake.functions.search import count_before

    cases = [([], 1), ([1], 0), ([1], 1), ([1, 2, 2, 5], 2), (list(range(33)), 31)]
    df = spark.createDataFrame(cases, "xs array<int>, x int")
    found = df.select(
        count_before(F.col("xs"), 33, lambda v: v <= F.col("x")).alias("n")
    ).collect()
    assert [r.n for r in found] == [bisect_right(xs, x) for xs, x in cases]


def test_absent_groups_read_as_zero(spark):
    """Each group has every tick of the grid, in one row, and zero where it has no value."""
    step = 15 * metrics.SECOND
    rng = random.Random(4)
    kept = {(g, t): float(rng.randrange(9)) for g in "ab" for t in range(700) if rng.random() < 0.5}
    kept |= {(None, 5): 2.0, ("c", 699): 1.0, ("a", 0): 3.0}
    ticks = spark.createDataFrame(
        [(g, t * step, v) for (g, t), v in kept.items()], "topic string, pos bigint, value double"
    )
    filled = metrics.or_zero_on_grid(ticks, labels=["topic"]).collect()
    assert {(r.topic, r.pos // step): r.value for r in filled} == {
        (g, t): kept.get((g, t), 0.0) for g in ("a", "b", "c", None) for t in range(700)
    }
    assert len(filled) == 4 * 700
    alone = ticks.where("topic = 'a'").select("pos", "value")
    got = {r.pos // step: r.value for r in metrics.or_zero_on_grid(alone).collect()}
    last = max(t for g, t in kept if g == "a")
    assert got == {t: kept.get(("a", t), 0.0) for t in range(last + 1)}
    assert metrics.or_zero_on_grid(ticks.where("false"), labels=["topic"]).collect() == []
