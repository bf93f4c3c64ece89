"""Angular triangle filtering against scoring everything, and its bounds against true scores."""

import math
import sys
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

from matchlake.llm import angle_negatives, queries  # noqa: E402

SCHEMA = "vec_id long, embedding array<double>, label int, uid long, angles string, norm int, a int, score int"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, 3, 4) for r in rows], SCHEMA)


def plain(rows, step):
    live = [
        (k, [math.floor(256 * x) for x in v], g)
        for k, v, g in rows
        if k is not None and g is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for n, (k, v, g) in enumerate(live):
        if k % step:
            continue
        scored = [
            (-max(min(sum(x * y for x, y in zip(v, w)), 2**63 - 1), 1 - 2**63), j, h)
            for m, (j, w, h) in enumerate(live)
            if m != n and len(w) == len(v)
        ]
        negatives = sorted(s for s in scored if s[2] != g)
        for p, j, _ in sorted(s for s in scored if s[2] == g)[:5]:
            inside = [s for s in negatives if 50 * -p <= 100 * -s[0] <= 95 * -p][:3]
            out += [(k, j, r, i, -p, -s) for r, (s, i, _) in enumerate(inside, 1)]
    return out


def check(spark, rows, step=5):
    found = angle_negatives.hard_negatives(frame(spark, rows), F.pmod("vec_id", F.lit(step)) == 0)
    assert found.columns == COLUMNS
    want = plain(rows, step)
    assert sorted(map(tuple, found.collect())) == sorted(want)
    return want


def clustered(seed, count=400, size=12, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, size))
    return [
        (i, (centres[i % 6] + rng.normal(size=size) * 0.7).tolist(), int(rng.integers(labels)))
        for i in range(count)
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, monkeypatch, seed):
    """Small chunks and blocks, so that every cell is cut."""
    monkeypatch.setattr(angle_negatives, "CHUNK_ROWS", 17)
    monkeypatch.setattr(angle_negatives, "BLOCK_ANCHORS", 7)
    assert len(check(spark, clustered(seed))) > 500


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = clustered(3, 60) + [
        (100, None, 1),
        (105, [], 1),
        (110, [], 2),
        (115, [0.0] * 12, 1),
        (120, [nan] * 12, 1),
        (125, [inf] * 12, 1),
        (130, [None] * 12, 1),
        (135, [1.0] * 12, None),
        (None, [1.0] * 12, 1),
        (140, [1.0] * 3, 1),
        (145, [2.0] * 3, 2),
        (150, [1.0] * 3, 1),
        (155, [0.7] * 3, 2),
        (160, [1e12] * 12, 1),
        (165, [9e11] * 12, 2),
        (170, [1e12] * 12, 1),
        (175, [1e300] * 3, 1),
        (180, [-0.001] * 3, 2),
        # Repeated rows, and one id with other content.
        *[(200, [0.5] * 12, 1)] * 7,
        *[(205, [0.4] * 12, 2)] * 5,
        (200, [0.3] * 12, 3),
    ]
    want = check(spark, rows)
    assert any(r[0] == 200 for r in want) and any(r[0] == 140 for r in want)


def test_ties_go_to_smaller_ids(spark):
    rows = [(i, [1.0, 1.0], 1) for i in range(20)] + [(i, [0.8, 0.8], 2) for i in range(20, 50)]
    want = check(spark, rows)
    assert {r[3] for r in want if r[0] == 0} == {20, 21, 22}


def test_empty_and_single_label(spark):
    assert check(spark, []) == []
    assert check(spark, [(i, [1.0, float(i)], 1) for i in range(10)]) == []


def test_bounds_hold(spark):
    rng = np.random.default_rng(7)
    a = np.floor(256 * rng.normal(size=(60, 9)))
    b = np.floor(256 * rng.normal(size=(80, 9)) * rng.choice([0.01, 1, 50], size=(80, 1)))
    b[:20] = a[:20] * 3
    b[20:25] = 0
    to = angle_negatives.references(b, 9)
    low, high = angle_negatives.bounds(
        angle_negatives.angles(a, to), angle_negatives.norms(a),
        angle_negatives.angles(b, to), angle_negatives.norms(b),
    )
    true = a @ b.T
    assert (low <= true).all() and (true <= high).all()
    assert (high - low < 2 * np.outer(angle_negatives.norms(a), angle_negatives.norms(b)) - 1).mean() > 0.5


def test_query_against_sql(spark, small):
    found = queries.op11_angle_negatives(spark, small)
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS FROM read_parquet('{small}/embeddings.parquet')")
    want = db.execute(queries.ORACLES["op11_angle_negatives"])
    names = [d[0] for d in want.description]
    order = [names.index(c) for c in found.columns]
    assert sorted(map(tuple, found.collect())) == sorted(tuple(r[i] for i in order) for r in want.fetchall())
