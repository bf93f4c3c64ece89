"""Language ID, line runs, mixing, near copies, licences and pages against brute force."""

import html
import re
import sys
import time
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
sys.path.insert(0, str(Path(__file__).parents[1]))
from fixtures import AWKWARD, LONG, documents  # noqa: E402
from oracle import compare, connect  # noqa: E402

from matchlake.llm import (  # noqa: E402
    dart_minhash,
    html_crf,
    license_scan,
    line_runs,
    mixing,
    queries,
    zstd_langid,
)


def texts_of(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet").collect()


# Line runs


def brute_lines(rows, min_docs=10, min_chars=1):
    def key(line):
        line = line.strip(" \t\n\x0b\x0c\r")
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line)

    count = Counter()
    for _, text in rows:
        count.update({key(x) for x in (text or "").split("\n")})
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < min_chars or count[key(x)] < min_docs]
        out.append((doc_id, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def run_lines(docs, **more):
    kept = line_runs.drop_repeated_lines(docs, **more)
    rows = kept.select("row.doc_id", "kept", "n_lines", "n_dropped").collect()
    return sorted(map(tuple, rows), key=repr)


def test_lines_as_sql(spark, medium):
    sql = queries.ORACLES["op7_line_runs"]
    assert compare(queries.op7_line_runs(spark, medium), connect(medium), sql) == []


@pytest.mark.parametrize("batches", [1, 2, 9])
def test_lines_in_any_number_of_batches(spark, batches):
    rows = [(i, f" Common LINE\t\nÉcole\nécole\n\nown {i}\nrare {i % 7}", "en", "s") for i in range(23)]
    rows += [*AWKWARD, (50, "common line", "en", "s"), (50, "common line", "en", "s")]
    got = run_lines(documents(spark, rows), batches=batches)
    assert got == sorted(brute_lines([r[:2] for r in rows]), key=repr)


def test_lines_of_no_documents(spark):
    assert run_lines(documents(spark, [])) == []


def test_many_lines_in_one_document(spark):
    """A hundred thousand lines, all but a thousand of them distinct, in seconds."""
    many = "\n".join(f"own line {i}" if i % 100 else "shared" for i in range(100_000))
    rows = [(0, many, "en", "s"), *[(i, f"Shared \nother {i}", "en", "s") for i in range(1, 12)]]
    begun = time.monotonic()
    got = run_lines(documents(spark, rows))
    assert time.monotonic() - begun < 60
    assert got == sorted(brute_lines([r[:2] for r in rows]), key=repr)


def test_merges_of_runs_shuffle_nothing(spark):
    runs = line_runs.LineRuns(spark, min_docs=2)
    for i in range(3):
        runs.add(documents(spark, [(i, f"same\nown {i}", "en", "s")]))
    merged = runs._merged(runs._names())
    assert merged.count() == 4
    assert "Exchange" not in merged._jdf.queryExecution().executedPlan().toString()


def test_runs_are_levelled_and_settled(spark):
    runs = line_runs.LineRuns(spark, min_docs=2)
    for i in range(5):
        runs.add(documents(spark, [(i, f"same\nown {i}\npair {i // 2}", "en", "s")]))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert runs.repeated().count() == 3


# Language ID


def test_language_of_held_out_documents(spark, medium):
    truth = {r["doc_id"]: r["lang"] for r in texts_of(spark, medium)}
    rows = queries.op10_zstd_langid(spark, medium).collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(truth)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1
    right = sum(truth[r["doc_id"]] == r["lang_pred"] for r in held)
    assert right >= 0.97 * len(held)
    again = {r["doc_id"]: r for r in queries.op10_zstd_langid(spark, medium).collect()}
    assert all(again[r["doc_id"]] == r for r in rows)


def test_language_of_awkward_documents(spark, medium):
    model = zstd_langid.train(spark.read.parquet(f"{medium}/documents.parquet"))
    docs = documents(spark, AWKWARD)
    rows = docs.select("text", zstd_langid.language("text", model).alias("a")).collect()
    for text, answer in rows:
        unknown = text is None or not any(map(str.isalpha, text))
        assert (answer["lang"] == "und") == unknown
    none = zstd_langid.train(documents(spark, []))
    assert {
        r["a"]["lang"] for r in docs.select(zstd_langid.language("text", none).alias("a")).collect()
    } == {"und"}
    assert documents(spark, []).select(zstd_langid.language("text", model)).count() == 0


def test_training_never_sees_held_out_text(spark):
    rows = [(i, "alpha beta gamma delta", "xx", "s") for i in range(60)]
    rows = [
        (i, "forbidden words only" if zlib.crc32(str(i).encode()) % 3 == 1 else t, g, s)
        for i, t, g, s in rows
    ]
    docs = documents(spark, rows)
    model = zstd_langid.train(docs.where(~zstd_langid.held_out("doc_id")))
    assert b"forbidden" not in model.dictionaries["xx"] and b"alpha" in model.dictionaries["xx"]


# Mixing


def test_apportion_is_by_highest_quotients():
    shares, seats = [53.0, 24.0, 23.0, 0.0], 7
    quotients = sorted(
        ((-s / (2 * k + 1), i) for i, s in enumerate(shares) if s for k in range(seats))
    )[:seats]
    want = Counter(i for _, i in quotients)
    assert mixing.apportion(shares, [99] * 4, seats) == [want[i] for i in range(4)]
    assert mixing.apportion(shares, [1, 2, 99, 99], seats) == [1, 2, 4, 0]
    assert mixing.apportion(shares, [1, 1, 1, 9], 9) == [1, 1, 1, 0]


def brute_targets(sizes):
    order = sorted(x for x in sizes if x is not None) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    fixed = {}
    while True:
        rest = [s for s in order if s not in fixed]
        left = sum(sizes.values()) - sum(fixed.values())
        target = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        over = [s for s in rest if target[s] > 3 * sizes[s]]
        if not over:
            return target | fixed
        fixed |= {s: 3 * sizes[s] for s in over}


def check_mix(rows, texts):
    word = re.compile(r"[^\x20\x09-\x0D]+")
    size = [(r[0], r[2], len(word.findall(r[1] or ""))) for r in texts]
    assert sorted(((r["doc_id"], r["source"], r["size"]) for r in rows), key=repr) == sorted(
        size, key=repr
    )
    sizes, taken = defaultdict(int), defaultdict(int)
    for _, source, n in size:
        sizes[source] += n
    targets = brute_targets(sizes)
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"]
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(targets[r["source"]])
        parts = sum(b - a for a, b in zip(r["starts"], r["ends"]))
        assert r["taken"] == r["repeats"] * r["size"] + parts
        assert all(0 <= a < b <= r["size"] for a, b in zip(r["starts"], r["ends"]))
        taken[r["source"]] += r["taken"]
    return targets, taken


def test_mix_of_documents(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    texts = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    for shard_words in (1 << 18, 20_000):
        rows = mixing.mix(docs, shard_words=shard_words).collect()
        targets, taken = check_mix(rows, texts)
        for source, target in targets.items():
            # A word for each source and shard.
            assert taken[source] == pytest.approx(target, abs=1 + sum(targets.values()) // shard_words)
        moved = mixing.mix(docs.repartition(5), shard_words=shard_words)
        assert sorted(map(str, moved.collect())) == sorted(map(str, rows))


def test_small_sources_have_their_part(spark):
    """Sources of less than a block, alone and beside large ones."""
    for sizes in ([20, 40, 42], [100], [1, 2, 50_000], [30_000, 130, 5, 127, 128]):
        rows = [
            (100 * i + j, " ".join(["w"] * (n // 3 + (n % 3 > j))), "en", f"s{i}")
            for i, n in enumerate(sizes)
            for j in range(3)
        ]
        targets, taken = check_mix(mixing.mix(documents(spark, rows)).collect(), [(i, t, s) for i, t, _, s in rows])
        for source, target in targets.items():
            assert taken[source] == pytest.approx(target, abs=1)


def test_mix_of_awkward_documents(spark):
    docs = documents(spark, AWKWARD)
    check_mix(mixing.mix(docs).collect(), [(i, t, s) for i, t, _, s in AWKWARD])
    assert mixing.mix(documents(spark, [])).count() == 0


def test_mixed_documents_have_the_taken_words(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    want = {r["doc_id"]: r["taken"] for r in mixing.mix(docs).collect() if r["taken"]}
    got = Counter()
    for r in out.collect():
        got[r["doc_id"]] += len(r["text"].split())
    assert got == want
    assert mixing.cut_words(" a  b\tc d ", [0, 2], [2, 4]) == "a  b c d"
    awkward = documents(spark, AWKWARD)
    assert mixing.mixed_documents(awkward).columns == awkward.columns
    assert mixing.mixed_documents(documents(spark, [])).count() == 0


# Near copies


def bag(text):
    words = text.lower().split()
    n = min(5, len(words))
    return Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if n else Counter([()])


def brute_classes(rows):
    """Lowest id reachable by pairs of similarity 0.8, by comparing all pairs."""
    bags = {i: bag(t) for i, t in rows if i is not None and t is not None}
    parent = {i: i for i in bags}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(bags, key=lambda i: sum(bags[i].values()))
    total = {i: sum(b.values()) for i, b in bags.items()}
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if total[a] < 0.8 * total[b]:
                break
            shared = sum((bags[a] & bags[b]).values())
            if shared >= 0.8 * (total[a] + total[b] - shared):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: root(i) for i in bags}


def test_near_copies_of_documents(spark, medium):
    rows = [(r["doc_id"], r["text"]) for r in texts_of(spark, medium)]
    want = brute_classes(rows)
    got = {r["doc_id"]: r for r in queries.op2_dart_minhash(spark, medium).collect()}
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert all(r["kept"] == (want[i] == i) for i, r in got.items())
    assert len(set(want.values())) < len(want)


def test_signatures_estimate_weighted_similarity():
    known = dart_minhash.WordHashes()
    base = [f"w{i % 40}" for i in range(300)]
    other = base[:240] + [f"x{i % 9}" for i in range(120)]
    bags = [dart_minhash.shingles(" ".join(x), known) for x in (base, other, base)]
    sign = dart_minhash.signatures(bags)
    true = dart_minhash.similarity(bags[0], bags[1])
    a, b = bag(" ".join(base)), bag(" ".join(other))
    assert true == pytest.approx(sum((a & b).values()) / sum((a | b).values()))
    assert (sign[0] == sign[1]).mean() == pytest.approx(true, abs=0.15)
    assert (sign[0] == sign[2]).all() and (sign != 0).all()


def test_overlaps_of_whole_chunks(monkeypatch):
    import numpy as np

    monkeypatch.setattr(dart_minhash, "COLUMNS", 7)
    rng = np.random.default_rng(4)
    known = dart_minhash.WordHashes()
    texts = [" ".join(rng.choice(list("abc"), rng.integers(1, 60))) for _ in range(30)]
    bags = [dart_minhash.shingles(t, known) for t in texts]
    got = dart_minhash.overlaps(bags[:17], bags[17:])
    counts = [bag(t) for t in texts]
    want = [[sum((a & b).values()) for b in counts[17:]] for a in counts[:17]]
    assert (got == want).all()


@pytest.mark.parametrize("fair", [0.05, 2.0])
def test_near_copies_in_hot_groups(spark, monkeypatch, fair):
    """One group of copies and one of near copies with most rows, and texts that share parts."""
    monkeypatch.setattr(dart_minhash, "FAIR_SHARE", fair)
    monkeypatch.setattr(dart_minhash, "CHUNK", 16)
    body = [f"token{i}" for i in range(120)]
    rows = [(i, " ".join(body), "en", "s") for i in range(100, 160)]
    for i in range(60):
        words = list(body)
        words[2 * i] = f"changed{i}"
        rows.append((i, " ".join(words), "en", "s"))
    for i in range(200, 230):
        rows.append((i, " ".join(body[:70] + [f"own{i}x{j}" for j in range(60)]), "en", "s"))
    got = dart_minhash.near_duplicates(documents(spark, rows)).collect()
    want = brute_classes([r[:2] for r in rows])
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert set(want.values()) == {0, *range(200, 230)}


def test_near_copies_that_only_a_follower_links(spark, monkeypatch):
    """A text that leads its buckets, copies of it, and an edit of one copy below 0.8 to the leader."""
    monkeypatch.setattr(dart_minhash, "CHUNK", 4)
    rows = []
    for g in range(8):
        body = [f"g{g}token{i}" for i in range(400)]

        def edited(*places):
            return " ".join(f"{w}changed" if i in places else w for i, w in enumerate(body))

        texts = [edited(*range(20, 380, 45), 5), edited(5), edited(), *(edited(i) for i in range(30, 330, 30))]
        rows += [(100 * g + i, t, "en", "s") for i, t in enumerate(texts)]
    last, copy, lead = (bag(t) for _, t, *_ in rows[:3])
    assert sum((last & copy).values()) >= 0.8 * sum((last | copy).values())
    assert sum((last & lead).values()) < 0.8 * sum((last | lead).values())
    got = dart_minhash.near_duplicates(documents(spark, rows)).collect()
    want = brute_classes([r[:2] for r in rows])
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert set(want.values()) == {100 * g for g in range(8)}


def test_near_copies_of_awkward_documents(spark):
    rows = [*AWKWARD, (20, "\n\n", "en", "s"), (21, LONG + " more", "en", "s")]
    docs = documents(spark, rows)
    got = Counter(tuple(r)[:2] for r in dart_minhash.near_duplicates(docs).collect())
    want = brute_classes([r[:2] for r in rows])
    assert got == Counter((i, want.get(i, i)) for i, *_ in rows)
    assert want[2] == 1 and want[4] == 3 and want[21] == 6
    kept = dart_minhash.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert Counter(ids) == Counter([None, None, *{c for c in want.values()}, 0])
    assert dart_minhash.near_duplicates(documents(spark, [])).count() == 0


# Licences


def brute_base(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    places = []
    for phrase, label in license_scan.BASE.items():
        want = phrase.split()
        for i in range(len(words) - len(want) + 1):
            if words[i : i + len(want)] == want:
                places.append((i, label))
    return len(words), sorted(places)


def check_licences(rows, texts):
    assert len(rows) == len(texts)
    got = sorted((tuple(r)[:6] for r in rows), key=repr)
    want = []
    for doc_id, text in texts:
        n, places = brute_base(text)
        starts = [p for p, _ in places]
        labels = ",".join(sorted({x for _, x in places}))
        want.append(
            (doc_id, n, len(places), min(starts, default=None), max(starts, default=None), labels)
        )
    assert got == sorted(want, key=repr)
    for r in rows:
        assert 0 <= r["score"] <= 1
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))


def test_licences_of_documents(spark, medium):
    rows = queries.op4_license_scan(spark, medium).collect()
    texts = [(r["doc_id"], r["text"]) for r in texts_of(spark, medium)]
    check_licences(rows, texts)
    assert any(r["n_base"] for r in rows)


@pytest.mark.parametrize(
    "page",
    [
        "<" + "x" * 1_000_000 + " '",
        '<a "' * 250_001,
        "<a " * 300_000 + "'",
        "<a'" * 300_001,
        "<p title='1'>x" * 60_000,
    ],
    ids=["name", "tags", "unclosed", "quotes", "closed"],
)
def test_a_megabyte_of_tags_and_quotes(page):
    begun = time.monotonic()
    html_crf.leaf_blocks(page)
    assert time.monotonic() - begun < 20


def test_tags_end_outside_quotes():
    def texts(page):
        return [b.text for b in html_crf.leaf_blocks(page)]

    assert texts("<p title='a > b'>one<p title=\"it's\">two") == ["one", "two"]
    assert texts("<p title='open>one<p>two") == ["<p title='open>one", "two"]
    assert texts("a <b\"c>d") == ["a d"] and texts("x < y <3 <p") == ["x < y <3"]
    assert texts("<!-- <p>no</p> --><p>yes<!-- open <p>no") == ["yes"]


def test_edited_notices_near_each_other():
    """The closest of a window is found first, and the others before and after it all the same."""
    searched = license_scan.notices()

    def edits(text):
        return [(h["word"], h["edits"]) for h in license_scan.scan(text, searched)[1] if h["label"] == "mit"]

    two, one, none = "undr te mit license", "undr the mit license", "under the mit license"
    assert edits(f"x {two} and {one} z") == [(1, 2), (6, 1)]
    assert edits(f"x {one} and {two} z") == [(1, 1), (6, 2)]
    assert edits(f"{two} {one} {none} {one} {two}") == [(0, 2), (4, 1), (8, 0), (12, 1), (16, 2)]
    assert edits(" ".join([one, two] * 20)) == [(4 * i, 1 + i % 2) for i in range(40)]


def test_licences_with_edits_and_overlaps():
    searched = license_scan.notices()

    def hits(text):
        return [(h["label"], h["word"], h["edits"], h["base"]) for h in license_scan.scan(text, searched)[1]]

    assert hits("Under the MIT License. Under the MlT Licence!") == [
        ("mit", 0, 0, True),
        ("mit", 4, 2, False),
    ]
    assert hits("x Apache License, Version 2.0 apache license version 2") == [
        ("apache-2", 1, 0, True),
        ("apache-2", 6, 0, True),
    ]
    assert hits("cc by nc cc-by-nc cc by nd cc  by\nNC") == [
        ("cc-by-nc", 0, 0, True),
        ("cc-by-nc", 3, 0, True),
        ("cc-by-nc", 9, 0, True),
    ]
    assert hits("apache licence version 20") == [("apache-2", 0, 2, False)]
    assert hits("under the mitx license agreement") == [("mit", 0, 1, False)]


def test_licences_of_awkward_documents(spark):
    from pyspark.sql import functions as F

    rows = [*AWKWARD, (30, LONG + " under the MIT license " + LONG, "en", "s")]
    docs = documents(spark, rows)
    out = docs.select("doc_id", "text", license_scan.licences(F.col("text")).alias("s")).collect()
    for _, text, s in out:
        n, places = brute_base(text)
        assert s["n_words"] == n
        assert [(h["word"], h["label"]) for h in s["hits"] if h["base"]] == places
    assert documents(spark, []).select(license_scan.licences(F.col("text"))).count() == 0


# Pages


def test_pages_have_their_articles(spark, medium):
    rows = queries.op3_html_crf(spark, medium).collect()
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{medium}/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        page = pages[r["page_id"]]["html"]
        body = re.search(r"<article>(.*)</article>", page, re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", re.sub(r"<br>", " ", body))
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in parts]
        assert r["text"] == "\n\n".join(p for p in parts if p)
        assert r["n_chars"] == len(r["text"]) and r["url"] == pages[r["page_id"]]["url"]


def test_blocks_of_other_layouts():
    model = html_crf.trained()
    right = total = 0
    for blocks, labels in html_crf.page_examples(200, seed=4242):
        scores = [sum(model.weights.get(f, 0.0) for f in b) for b in blocks]
        right += sum(a == b for a, b in zip(model.decode(scores), labels))
        total += len(labels)
    assert right >= 0.96 * total


def test_viterbi_is_the_best_labelling():
    import itertools
    import random

    rng = random.Random(1)
    model = html_crf.Crf({}, (0.3, -0.2), ((0.5, -1.0), (-0.7, 0.9)))
    for n in range(1, 8):
        scores = [rng.uniform(-2, 2) for _ in range(n)]

        def value(labels):
            out = model.start[labels[0]] + sum(s for s, x in zip(scores, labels) if x)
            return out + sum(model.pairs[a][b] for a, b in zip(labels, labels[1:]))

        best = max(itertools.product([0, 1], repeat=n), key=value)
        assert model.decode(scores) == [bool(x) for x in best]
    assert model.decode([]) == []


def blocks(page):
    return [b.text for b in html_crf.leaf_blocks(page)]


def test_malformed_pages():
    assert blocks(None) == [] == blocks("") == blocks("<p></p><br>")
    assert blocks("<p>a<p>b</p>c</p>d") == ["a", "b", "c", "d"]
    assert blocks("<ul><li>a<li>b<ul><li>c</ul></ul>d") == ["a", "b", "c", "d"]
    assert blocks("x &amp; y&nbsp;&lt;b&gt; 1 < 2 <!-- <p>no</p> --> z") == ["x & y <b> 1 < 2 z"]
    assert blocks("<script>var a='</p><p>no'</script>a<style>b</style>") == ["a"]
    assert blocks("a<script>never closed <p>no") == ["a"]
    assert blocks("<td>a<td>b<tr><td>c") == ["a", "b", "c"]
    assert blocks("a<br>b<b>c</b>d</i></div>e") == ["a bcd", "e"]
    assert blocks("<P CLASS=x>A</P><DIV>b") == ["A", "b"]
    assert blocks("text <") == ["text <"]
    long = "<div>" * 3000 + "deep" + "</div>" * 3000
    assert blocks(long) == ["deep"]


def test_main_text_of_awkward_pages(spark):
    from pyspark.sql import functions as F

    rows = [(1, None), (2, ""), (3, "<nav><a href=x>home</a></nav>"), (4, "<p>" + LONG)]
    pages = spark.createDataFrame(rows, "page_id long, html string")
    out = dict(
        pages.select("page_id", html_crf.main_text(F.col("html"), html_crf.trained())).collect()
    )
    assert out[1] == "" == out[2] == out[3]
    assert out[4] == LONG

