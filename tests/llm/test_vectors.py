"""NN-descent and adaptive search against brute force."""

import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))

from matchlake.llm import ads_search, graph, nn_descent, queries  # noqa: E402
from matchlake.llm.shared import Scratch  # noqa: E402

SCHEMA = "vec_id long, embedding array<float>, label int, c long, vector string, h1 int, q int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], SCHEMA)


def good(vector):
    return vector is not None and len(vector) and None not in vector and np.isfinite(vector).all() and any(vector)


def brute_links(rows):
    """{row number: (links, component)} by all pairs."""
    size = max((len(v) for _, v, _ in rows if good(v)), default=0)
    live = [
        i for i, (k, v, g) in enumerate(rows) if k is not None and g is not None and good(v) and len(v) == size
    ]
    out = {i: (0, rows[i][0]) for i in range(len(rows))}
    if not live:
        return out
    x = np.float32([rows[i][1] for i in live]).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([rows[i][2] for i in live])
    linked = (x @ x.T >= 0.98) & (label[:, None] == label)
    np.fill_diagonal(linked, False)
    component = np.array([rows[i][0] for i in live])
    while True:
        new = np.array([min(c, component[a].min()) if a.any() else c for c, a in zip(component, linked)])
        if (new == component).all():
            break
        component = new
    for n, i in enumerate(live):
        out[i] = (int(linked[n].sum()), int(component[n]))
    return out


def check_links(spark, rows):
    got = nn_descent.near_vectors(frame(spark, rows)).collect()
    want = brute_links(rows)
    expected = [(rows[i][0], n, c, rows[i][0] is None or c == rows[i][0]) for i, (n, c) in want.items()]
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)


def planted(rng, singles=300, size=24):
    """Vectors of two labels, with pairs, a group larger than any list, and equal vectors."""
    rows = [(i, rng.normal(size=size), i % 2) for i in range(singles)]
    for i in range(40):
        rows.append((1000 + i, rows[i][1] + rng.normal(size=size) * 0.02, rows[i][2]))
    centre = rng.normal(size=size)
    rows += [(2000 + i, centre + rng.normal(size=size) * 0.06, 0) for i in range(60)]
    rows += [(3000 + i, rows[5][1], 1) for i in range(50)]
    rows += [(4000 + i, rows[5][1], 0) for i in range(5)]
    return [(i, np.float32(v).tolist(), g) for i, v, g in rows]


AWKWARD = [
    (9001, None, 1),
    (9002, [], 1),
    (9003, [0.0] * 24, 1),
    (9004, [float("nan")] + [1.0] * 23, 1),
    (9005, [float("inf")] + [1.0] * 23, 1),
    (9006, [None] + [1.0] * 23, 1),
    (9007, [1.0] * 24, None),
    (9008, [1.0] * 5, 1),
    (None, [1.0] * 24, 1),
    (9050, [1.0] * 24, 1),
    (9050, [1.0] * 24, 1),
    (9100, [3e38] * 24, 1),
    (9150, [2e-38] * 24, 1),
]


def test_links_of_planted_vectors(spark):
    check_links(spark, planted(np.random.default_rng(5)) + AWKWARD)


def test_links_of_few_vectors(spark):
    check_links(spark, [])
    check_links(spark, AWKWARD[:8])
    check_links(spark, [(1, [1.0, 0.0], 0), (2, [1.0, 0.1], 0), (3, [0.0, 1.0], 0)])


def test_chunks_of_saturated_groups(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "CHUNK", 16)
    check_links(spark, planted(np.random.default_rng(6)))


def chain_of_entries(nodes, *_):
    """Each node of the group listed with the next one only."""
    return nodes.where("c < 6").selectExpr("c AS u", "c + 1 AS v", "1D AS s")


def no_entries(nodes, *_):
    return nodes.where("false").selectExpr("c AS u", "c AS v", "1D AS s")


def test_links_of_unsaturated_groups_are_completed(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "AUDITED", 0)
    monkeypatch.setattr(nn_descent, "_first_lists", chain_of_entries)
    monkeypatch.setattr(nn_descent, "_round", lambda lists, nodes, total: no_entries(nodes))
    rng = np.random.default_rng(3)
    centre = rng.normal(size=24)
    close = [(i, np.float32(centre + rng.normal(size=24) * 0.03).tolist(), 0) for i in range(7)]
    lone = [(50 + i, np.float32(rng.normal(size=24)).tolist(), 0) for i in range(5)]
    check_links(spark, close + lone)


def test_missed_audit_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "ROUNDS", 2)
    monkeypatch.setattr(nn_descent, "_first_lists", no_entries)
    monkeypatch.setattr(nn_descent, "_round", lambda lists, nodes, total: no_entries(nodes))
    with pytest.raises(RuntimeError, match="audit"):
        check_links(spark, planted(np.random.default_rng(5), singles=60))


def test_orders_grow_with_the_rows():
    assert [nn_descent.orders_for(n) for n in (2, 500, 200_000)] == [5, 5, 9]
    counts = [nn_descent.orders_for(10**n) for n in range(3, 10)]
    assert counts == sorted(counts) and counts[-1] > counts[0]


def test_query_of_links(spark, medium):
    rows = [tuple(r) for r in spark.read.parquet(f"{medium}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    want = brute_links(rows)
    got = {r["vec_id"]: r for r in queries.op5_nn_descent(spark, medium).collect()}
    assert {i: (r["n_links"], r["component_id"]) for i, r in got.items()} == {
        rows[i][0]: x for i, x in want.items()
    }


def brute_nearest(rows, step=50, nearest=5):
    size = max((len(v) for _, v, _ in rows if good(v)), default=0)
    live = [(k, v) for k, v, _ in rows if k is not None and good(v) and len(v) == size]
    x = np.float32([v for _, v in live]).astype(float)
    unit = x / np.abs(x).max(axis=1, keepdims=True)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    ids = np.array([k for k, _ in live])
    out = {}
    for n, q in enumerate(ids):
        if q % step == 0:
            score = unit @ unit[n]
            order = [i for i in np.lexsort((ids, -np.round(score, 12))) if ids[i] != q]
            out[int(q)] = [(int(ids[i]), score[i]) for i in order[:nearest]]
    return out


def recall(got, want):
    found = total = 0
    for q, near in want.items():
        rows = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == list(range(1, len(near) + 1))
        scores = [r["score"] for r in rows]
        assert scores == sorted(scores, reverse=True)
        assert len({r["vec_id"] for r in rows}) == len(rows) and q not in {r["vec_id"] for r in rows}
        # Equal scores are told apart by id, so ranks of copies are compared too.
        found += sum(any(abs(s - r["score"]) < 1e-9 for _, s in near) for r in rows)
        total += len(near)
    return found / total


def test_query_of_neighbours(spark, medium):
    rows = [tuple(r) for r in spark.read.parquet(f"{medium}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = queries.op6_adaptive_scan(spark, medium).collect()
    assert recall(got, brute_nearest(rows)) >= 0.9


def test_neighbours_of_planted_vectors(spark):
    rows = planted(np.random.default_rng(8)) + AWKWARD[:8] + AWKWARD[9:10]
    got = ads_search.search(frame(spark, rows)).collect()
    want = brute_nearest(rows)
    assert {r["query_id"] for r in got} == set(want)
    assert recall(got, want) >= 0.9
    # Copies of one vector: the lowest ids first, the query's own row left out.
    copies = [r["vec_id"] for r in sorted((r for r in got if r["query_id"] == 3000), key=lambda r: r["rank"])]
    assert copies == [5, 3001, 3002, 3003, 3004]


def test_neighbours_of_few_vectors(spark):
    assert ads_search.search(frame(spark, [])).count() == 0
    assert ads_search.search(frame(spark, AWKWARD[:8])).count() == 0
    assert ads_search.search(frame(spark, [(50, [1.0, 2.0], 0)])).count() == 0
    three = [(50, [1.0, 0.0], 0), (7, [1.0, 0.1], 0), (3, [0.0, 1.0], None)]
    got = [(r["rank"], r["vec_id"]) for r in ads_search.search(frame(spark, three)).collect()]
    assert sorted(got) == [(1, 7), (2, 3)]


def test_short_answers_go_on_through_all_lists(spark, monkeypatch):
    """Lists of a few rows each, of which one is probed: five neighbours all the same."""
    monkeypatch.setattr(ads_search, "COVERED", 0.0)
    rng = np.random.default_rng(12)
    centres = rng.normal(size=(60, 16))
    rows = [(i * 10, np.float32(centres[i % 60] + rng.normal(size=16) * 0.01).tolist(), 0) for i in range(240)]
    index = ads_search.fit(np.array([v for _, v, _ in rows]), len(rows))
    assert index.probes == 1 and len(index.centres) > 1
    got = ads_search.search(frame(spark, rows)).collect()
    want = brute_nearest(rows)
    assert {r["query_id"] for r in got} == set(want)
    assert len(got) == 5 * len(want)
    # The three others of a query's cluster are always found.
    for q, near in want.items():
        assert {i for i, _ in near[:3]} <= {r["vec_id"] for r in got if r["query_id"] == q}


def test_abandoned_candidates_are_no_neighbours():
    rng = np.random.default_rng(2)
    rows = rng.normal(size=(3000, 64))
    index = ads_search.fit(rows[:500], 3000)
    turned = index.turned(rows)
    hits = 0
    for q in rng.normal(size=(40, 64)):
        at, scores = ads_search.scan(rows, turned, q, index.turned(q[None])[0], -np.inf, 6)
        true = rows @ q / np.linalg.norm(rows, axis=1) / np.linalg.norm(q)
        hits += len(set(at) & set(np.argsort(-true)[:6]))
        assert np.allclose(scores, true[at])
    assert hits >= 0.98 * 240


@pytest.mark.parametrize("shape", ["chain", "star", "ring", "none"])
def test_components(spark, shape):
    n = 40
    pairs = {
        "chain": [(i + 1, i) for i in range(n)],
        "star": [(7, i) for i in range(n) if i != 7],
        "ring": [(i, (i + 1) % n + (100 if i % 9 == 0 else 0)) for i in range(n)],
        "none": [],
    }[shape]
    label = {x: x for p in pairs for x in p}
    for _ in range(n + 5):
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    links = spark.createDataFrame(pairs, "a long, b long")
    got = graph.components(links, Scratch(spark, "graph-test")).collect()
    assert sorted(map(tuple, got)) == sorted(label.items())
