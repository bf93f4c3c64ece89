"""Every registered query against its SQL."""

import pytest
from oracle import compare, connect

from __spark_entry__ import entry, oracle_sql, queries
from matchlake.operators import joins
from matchlake.plans.oracles import ORACLES
from matchlake.plans.queries import BUILDERS, QUERIES
from matchlake.sources.testdata import bind

NAMES = sorted(QUERIES)

# Queries whose work is split by hot keys.
SPLIT = [
    "player_lookup",
    "lookup_misses",
    "roster_join",
    "rank_as_of",
    "rank_as_of_broadcast",
    "match_facts",
    "quiet_sessions",
    "arrival_replay",
    "rank_points_history",
    "wins_losses_history",
    "metric_increase",
    "metric_deriv",
    "alert_hold",
    "alert_report",
]


@pytest.fixture(scope="module")
def duck(small):
    return connect(small)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() == 47


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, small, name):
    assert compare(queries()[name](spark, small), duck, oracle_sql()[name]) == []


@pytest.mark.parametrize("name", SPLIT)
def test_query_with_every_key_hot(spark, duck, small, name):
    """With seven rows to a task nearly every player, match and series is split."""
    inputs = bind(spark, small, rows_per_task=7)
    assert inputs.hot_players and inputs.hot_matches and inputs.hot_series
    assert compare(BUILDERS[name](inputs), duck, oracle_sql()[name]) == []


@pytest.fixture(scope="module")
def skewed(small, tmp_path_factory):
    """The small tables, but a third of all events belong to one known player."""
    folder = tmp_path_factory.mktemp("skewed")
    con = connect(small)
    con.execute(
        "COPY (SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 7 ELSE user_id END AS user_id) "
        f"FROM events) TO '{folder}/events.parquet'"
    )
    con.execute(f"COPY (SELECT * FROM customer) TO '{folder}/customer.parquet'")
    return str(folder)


@pytest.mark.parametrize(
    "name",
    ["player_lookup", "match_facts", "rank_as_of_broadcast", "arrival_replay", "current_rank"],
)
def test_one_player_holds_a_third_of_all_rows(spark, skewed, name):
    inputs = bind(spark, skewed, rows_per_task=100)
    assert len(inputs.hot_players.rows) == 1
    assert compare(BUILDERS[name](inputs), connect(skewed), oracle_sql()[name]) == []


@pytest.mark.parametrize(
    "name, rows",
    [
        ("lookup_misses", 885),
        ("match_facts", 3288),
        ("hero_win_rate", 50),
        ("map_results", 7),
        ("player_leaderboard", 136),
        ("rank_as_of_mix", 11),
        ("rank_vs_result", 6),
        ("quiet_sessions", 894),
        ("arrival_replay", 3000),
    ],
)
def test_known_sizes(spark, medium, name, rows):
    assert queries()[name](spark, medium).count() == rows


def test_rosters_of_orders_and_lines(spark, medium):
    """A second binding: an order is a match, its lines are the participants."""
    read = lambda t: spark.read.parquet(f"{medium}/{t}.parquet")
    lines = read("lineitem").selectExpr(
        "l_orderkey * 100 + l_linenumber AS id",
        "l_orderkey AS match_id",
        "cast(l_suppkey AS bigint) AS player_id",
        "0 AS team",
        "l_linestatus AS hero_played",
        "1 AS kills",
        "2 AS deaths",
        "3 AS healing",
        "l_returnflag AS result",
    )
    orders = read("orders").selectExpr(
        "o_orderkey AS id",
        "o_orderpriority AS map_name",
        "500 AS match_duration_seconds",
        "cast(o_orderdate AS timestamp) AS started_at",
        "cast(o_orderdate AS timestamp) AS ended_at",
        "1 AS winning_team",
    )
    names = read("supplier").selectExpr(
        "cast(s_suppkey AS bigint) AS id", "s_name AS account_name"
    )
    con = connect(medium)
    for size in (12, 5):
        looked = joins.player_lookup(lines, names)
        found = joins.roster_join(looked, orders, size).groupBy("match_id").count()
        expected = con.sql(
            "SELECT l_orderkey, count(*) AS n FROM lineitem JOIN supplier ON s_suppkey = l_suppkey "
            f"JOIN orders ON o_orderkey = l_orderkey GROUP BY l_orderkey HAVING n = {size}"
        ).fetchall()
        assert expected
        assert sorted(tuple(r) for r in found.collect()) == sorted(expected)


def test_every_rule_is_exercised(spark, medium):
    rows = queries()["alert_report"](spark, medium).collect()
    fired = {r.alert for r in rows if r.firings}
    assert len({r.alert for r in rows}) == 11
    assert len(fired) >= 10
