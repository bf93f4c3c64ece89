"""The corpus pipeline, stage by stage, and the registered queries of the operators."""

import re
import sys
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
from fixtures import AWKWARD, documents  # noqa: E402
from test_text import brute_classes, brute_lines, brute_targets  # noqa: E402

import corpus_pipeline  # noqa: E402
from __spark_entry__ import oracle_sql, queries  # noqa: E402


def test_every_operator_is_registered():
    names = [n for n in queries() if re.match(r"op\d+_", n)]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14))
    assert queries()["pipeline"] is corpus_pipeline.run
    assert set(oracle_sql()) <= set(queries())


@pytest.fixture(scope="module")
def stages(spark, medium):
    """What each stage was given and what it made of it."""
    docs, out = spark.read.parquet(f"{medium}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, medium).cache()
        out.append((name, docs, made))
        docs = made
    return out


def test_columns_of_stages(stages):
    assert [name for name, _, _ in stages] == [name for name, _ in corpus_pipeline.STAGES]
    for _, given, made in stages[:-1]:
        assert made.columns == corpus_pipeline.COLUMNS
        assert [t for _, t in made.dtypes] == [t for _, t in given.select(*made.columns).dtypes]
    for _, _, made in stages[1:-1]:
        assert made.where("n_chars != length(text)").count() == 0


def test_language_stage_keeps_prose(stages):
    _, given, made = stages[0]
    kept = {r["doc_id"] for r in made.select("doc_id").collect()}
    gone = [r for r in given.collect() if r["doc_id"] not in kept]
    assert len(gone) < 0.03 * given.count()
    for r in gone:
        words = Counter(re.findall(r"[^\W\d_]+", r["text"].lower()))
        assert len(words) < 40


def test_line_stage(stages):
    _, given, made = stages[1]
    rows = [(r["doc_id"], r["text"]) for r in given.collect()]
    assert {(r["doc_id"], r["text"]) for r in made.collect()} == {
        r[:2] for r in brute_lines(rows)
    }


def test_near_copy_stage(stages):
    _, given, made = stages[2]
    classes = brute_classes([(r["doc_id"], r["text"]) for r in given.collect()])
    assert sorted(r["doc_id"] for r in made.collect()) == sorted(set(classes.values()))


def test_mixing_stage(stages):
    _, given, made = stages[3]
    words = lambda df: df.selectExpr(
        "source", r"regexp_count(text, '[^\\x20\\x09-\\x0D]+') AS n"
    ).groupBy("source").sum("n").collect()
    targets = brute_targets({s: n for s, n in words(given) if n})
    got = dict(words(made))
    for source, target in targets.items():
        assert got.get(source, 0) == pytest.approx(target, rel=0.05, abs=400)


def test_last_stage_and_run(spark, medium, stages):
    _, given, made = stages[4]
    assert made.count() == given.count()
    again = corpus_pipeline.run(spark, medium)
    assert sorted(map(str, again.collect())) == sorted(map(str, made.collect()))


def test_stages_on_awkward_and_empty_tables(spark, medium):
    for rows in (AWKWARD, []):
        for _, stage in corpus_pipeline.STAGES:
            made = stage(spark, documents(spark, rows), medium)
            assert made.count() <= 3 * max(1, len(rows))
