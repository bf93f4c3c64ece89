"""Pair bitmaps against plain counting over the two tokenizers' own output."""

import hashlib
import sys
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))

from fixtures import AWKWARD, documents  # noqa: E402
from matchlake.llm import pair_bitmaps, queries  # noqa: E402
from matchlake.llm.trie_bpe import byte_letters  # noqa: E402

A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def plain(texts):
    """The columns per text, link by link."""
    tok_a, tok_b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    tok_a.encode_special_tokens = True
    letters = byte_letters()

    def bytes_b(i):
        piece = tok_b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if tok_b.is_byte(i) else piece.replace("▁", " ").encode()

    rows, corpus = [], Counter()
    for text in texts:
        a = tok_a.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = tok_b.encode(text) if text else []
        spelt_a = [bytes(letters[c] for c in tok_a.id_to_token(i)) for i in a]
        spelt_b = [bytes_b(i) for i in b]
        if not text or {b"".join(spelt_a), b"".join(spelt_b)} != {(" " + text).encode()}:
            rows.append((0, 0, "", []))
            continue
        links, groups, i, j, at_a, at_b, ga, gb = [], [], 0, 0, 0, 0, [], []
        while i < len(a) and j < len(b):
            links.append((a[i], b[j]))
            end_a, end_b = at_a + len(spelt_a[i]), at_b + len(spelt_b[j])
            if end_a <= end_b:
                ga.append(str(a[i]))
                i, at_a = i + 1, end_a
            if end_b <= end_a:
                gb.append(str(b[j]))
                j, at_b = j + 1, end_b
            if end_a == end_b:
                groups.append(",".join(ga) + "|" + ",".join(gb))
                ga, gb = [], []
        rows.append((len(a), len(b), ";".join(groups), links))
        corpus.update(links)
    best = defaultdict(int)
    for (_, y), n in corpus.items():
        best[y] = max(best[y], n)
    return [
        (
            na,
            nb,
            len(groups.split(";")) if groups else 0,
            len(links),
            sum(corpus[k] == best[k[1]] for k in links),
            sum(corpus[k] for k in links),
            hashlib.sha256(groups.encode()).hexdigest() if groups else "",
        )
        for na, nb, groups, links in rows
    ]


def compare(spark, rows):
    got = pair_bitmaps.aligned(documents(spark, rows), A, B)
    assert got.columns == ["doc_id", *COLUMNS]
    want = [(r[0], *p) for r, p in zip(rows, plain([r[1] for r in rows]))]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


ODD = [
    (20, "double  space\tand\r\nlines   end ", "en", "s"),
    (21, "▁ already ▁▁ there", "en", "s"),
    (22, "\x00\x01 bytes \x7f ​﻿  x", "en", "s"),
    (23, " leading space", "en", "s"),
    (24, "<s> </s> <unk> <0x41> <|endoftext|>", "en", "s"),
    (25, "ﬁ ½ ① Ａ combining é 가나다 हिन्दी", "en", "s"),
    (26, "　ideographic space\x1c\x1d\x85y", "en", "s"),
    (27, "z" * 70_000, "en", "s"),
    (28, " ", "en", "s"),
]


def test_awkward_texts(spark):
    compare(spark, AWKWARD + ODD)


def test_empty_table(spark):
    assert pair_bitmaps.aligned(documents(spark, []), A, B).collect() == []


def test_small_chunks_and_hot_pairs(spark, monkeypatch):
    """Many chunks, bitmaps that are dense and ones that are not, and every pair dealt out."""
    rows = [(i, "the cat and the hat, the end of " * (1 + i % 5) + str(i * i), "en", "s") for i in range(60)]
    monkeypatch.setattr(pair_bitmaps, "CHUNK_CHARS", 400)
    compare(spark, rows)
    monkeypatch.setattr(pair_bitmaps, "CHUNK_DOCS", 3)
    docs, postings = pair_bitmaps.index(documents(spark, rows), "doc_id", "text", A, B)
    assert docs.select("chunk").distinct().count() >= 20
    assert docs.groupBy("chunk").count().agg({"count": "max"}).first()[0] <= 3
    counts = pair_bitmaps.pair_counts(postings)
    even = pair_bitmaps.scores(postings, counts).collect()
    assert sorted(even) == sorted(pair_bitmaps.scores(postings, counts, rows_per_task=2).collect())


def test_document_counts(spark):
    texts = ["the the cat", "the dog", "a cat the the the", "dog"]
    _, postings = pair_bitmaps.index(
        documents(spark, [(i, t, "en", "s") for i, t in enumerate(texts)]), "doc_id", "text", A, B
    )
    got = {(r.a, r.b): (r.n_docs, r.n_links) for r in pair_bitmaps.pair_counts(postings).collect()}
    pair, docs, links = pair_bitmaps.Pair(A, B), defaultdict(set), Counter()
    for n, text in enumerate(texts):
        _, _, a, b = pair_bitmaps.align(pair, [text])
        for key in zip(a.tolist(), b.tolist()):
            docs[key].add(n)
            links[key] += 1
    assert got == {k: (len(docs[k]), links[k]) for k in links}


@pytest.mark.parametrize("room", [1, 8, 100, 4000])
def test_containers_keep_their_numbers(room):
    rng = np.random.default_rng(room)
    sets = [np.sort(rng.choice(room, rng.integers(1, room + 1), replace=False)) for _ in range(50)]
    starts = np.cumsum([0, *map(len, sets)])[:-1]
    card, dense, bits = pair_bitmaps.containers(np.concatenate(sets), starts, room)
    docs, sizes = pair_bitmaps.positions(dense, bits)
    assert card.tolist() == sizes.tolist() == [len(s) for s in sets]
    assert docs.tolist() == np.concatenate(sets).tolist()
    cut = bits.slice(10, 20)
    docs, sizes = pair_bitmaps.positions(dense[10:30], cut)
    assert docs.tolist() == np.concatenate(sets[10:30]).tolist()
    assert pa.types.is_binary(bits.type)


def test_query(spark, small):
    rows = queries.op12_pair_bitmaps(spark, small).collect()
    texts = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    want = [(r.doc_id, *p) for r, p in zip(texts, plain([r.text for r in texts]))]
    assert sorted(map(tuple, rows)) == sorted(want)
