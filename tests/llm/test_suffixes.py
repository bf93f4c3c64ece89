"""External induced sorting and suffix dedup against plain comparison."""

import hashlib
import random
import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))

from fixtures import AWKWARD, documents  # noqa: E402
from matchlake.llm import induced_sort, queries, suffix_dedup  # noqa: E402


def texts(seed):
    rng = random.Random(seed)
    kind = seed % 4
    if kind == 0:
        body = [rng.randrange(1, 4) for _ in range(rng.randrange(1, 300))]
    elif kind == 1:
        body = [1 + (i // rng.randrange(1, 5)) % 2 for i in range(200)]
    elif kind == 2:
        piece = [rng.randrange(1, 30) for _ in range(rng.randrange(1, 40))]
        body = (piece * 9)[: rng.randrange(5, 200)] + [rng.randrange(1, 30) for _ in range(20)] + piece
    else:
        body = [rng.choice([1, 1, 1, 2]) for _ in range(250)] + [2] * 30 + [1] * 30
    return np.array([*body, 0], np.int64)


def common(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


@pytest.mark.parametrize("seed", range(40))
@pytest.mark.parametrize("block,base,room", [(1 << 16, 1 << 21, 1 << 20), (3, 4, 40)])
def test_suffixes_in_order(tmp_path, monkeypatch, seed, block, base, room):
    """With small blocks everything is on disk and names are sorted by recursion."""
    monkeypatch.setattr(induced_sort, "BLOCK", block)
    monkeypatch.setattr(induced_sort, "SORTED_IN_MEMORY", base)
    text = texts(seed)
    files = induced_sort.Files(str(tmp_path), room)
    parts = list(induced_sort.falling(text, int(text.max()) + 1, 1000, files))
    places = [int(p) for b, _ in parts for p in b]
    shared = [int(c) for _, b in parts for c in b]
    plain = [int(x) for x in text]
    want = sorted(range(len(plain) - 1), key=lambda i: plain[i:], reverse=True)
    assert places == want
    assert shared == [0] + [common(plain[a:], plain[b:]) for a, b in zip(want, want[1:])]
    assert not list(tmp_path.iterdir())
    # Capped values hold for whatever order ties come in.
    capped = list(induced_sort.falling(text, int(text.max()) + 1, 5, files))
    places = [int(p) for b, _ in capped for p in b]
    assert sorted(places) == list(range(len(plain) - 1))
    assert [plain[i : i + 5] for i in places] == [plain[i : i + 5] for i in want]
    got = [int(c) for _, b in capped for c in b]
    assert got == [0] + [min(5, common(plain[a:], plain[b:])) for a, b in zip(places, places[1:])]


# --- documents ---------------------------------------------------------------


def plain(texts, length):
    """(n_bytes, n_removed, n_spans, kept digest) per text, by a table of all strings."""
    data = [(t or "").encode() for t in texts]
    seen = {}
    for d in data:
        for i in range(len(d) - length + 1):
            w = d[i : i + length]
            seen[w] = seen.get(w, 0) + 1
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(d)))
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((len(d), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def compare(spark, rows, length=suffix_dedup.LENGTH, **limits):
    found = suffix_dedup.drop_repeated_bytes(documents(spark, rows), length=length, **limits)
    assert set(found.columns) == {"row", "kept", "n_bytes", "n_removed", "n_spans"}
    got = [
        (r.row.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest())
        for r in found.collect()
    ]
    want = [(r[0], *p) for r, p in zip(rows, plain([r[1] for r in rows], length))]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    return want


def passages(seed, count=60):
    """Texts that share passages at their edges and inside, some within one text."""
    rng = random.Random(seed)

    def words(n):
        return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 8))) for _ in range(n))

    shared = [words(rng.randrange(20, 120)) for _ in range(6)]
    rows = []
    for i in range(count):
        parts = [words(rng.randrange(1, 80)) for _ in range(3)]
        parts.insert(rng.randrange(3), rng.choice(shared))
        if i % 3 == 0:
            whole = rng.choice(shared)
            cut = rng.randrange(len(whole))
            parts.append(whole[cut:])
        if i % 7 == 0:
            parts += [parts[0], parts[0]]
        rows.append((i, " ".join(parts), "en", "s"))
    return rows


AGAIN = [
    (50, "a" * 700, "en", "s"),
    (51, "ab" * 400, "en", "s"),
    (52, "ba" * 100, "en", "s"),
    (53, "x" * 199, "en", "s"),
    (54, "x" * 199, "en", "s"),
    (55, "y" * 100 + "z" * 100, "en", "s"),
    (56, "y" * 100 + "z" * 100, "en", "s"),
    (57, "é" * 150, "en", "s"),
    (58, "q" + "é" * 150, "en", "s"),
    (59, None, "en", "s"),
]


def test_awkward_texts(spark):
    assert any(n for _, _, n, _, _ in compare(spark, AWKWARD + AGAIN))


@pytest.mark.parametrize("seed", [1, 2])
def test_shared_passages(spark, seed):
    want = compare(spark, passages(seed))
    assert sum(w[2] > 0 for w in want) > 30 and sum(w[3] > 1 for w in want) > 3


def test_large_groups_are_halved(spark):
    """Every group too large, down to single windows, and every join dealt out."""
    compare(spark, passages(3, 40) + AGAIN, group=1, rows_per_task=2)
    compare(spark, passages(3, 40) + AGAIN, group=5, rows_per_task=3, shard_bytes=3000, at_once=500)


def test_shards_larger_than_memory(spark):
    compare(spark, passages(4), room=100, at_once=1 << 30)


def test_short_windows(spark):
    compare(spark, passages(5, 30), length=40, gram=8)


def test_segments(spark, monkeypatch):
    """Texts cut into segments have the contexts of uncut ones."""
    rows = passages(6, 10)
    data = " ".join(r[1] for r in rows).encode()
    whole = suffix_dedup.Anchors(200, 64).of(data)
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 300)
    cut = suffix_dedup.Anchors(200, 64).of(data)
    assert all((a == b).all() for a, b in zip(whole, cut))
    assert whole[3].sum() == len(data) - 199 and len(whole[0]) < len(data) / 40


def test_empty_table(spark):
    assert suffix_dedup.drop_repeated_bytes(documents(spark, [])).collect() == []


def test_query(spark, small):
    rows = queries.op13_induced_suffixes(spark, small).collect()
    texts = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    want = [(r.doc_id, *p) for r, p in zip(texts, plain([r.text for r in texts], 200))]
    assert sorted(map(tuple, rows)) == sorted(want)
