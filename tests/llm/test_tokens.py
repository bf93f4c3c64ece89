"""Trie BPE and Simple-8b against the tokenizers library and exact round trips."""

import hashlib
import re
import sys
import unicodedata
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))
from fixtures import AWKWARD, documents  # noqa: E402

from matchlake.llm import queries, simple8b, trie_bpe  # noqa: E402

BYTE_PATH = public_tokenizers.path("byte_bpe_50k.json")
WORD_PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTE_PATH)


@pytest.fixture(scope="module")
def encoder():
    return trie_bpe.Encoder(BYTE_PATH)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=4))
def test_any_text_as_the_library(library, encoder, texts):
    ours = encoder.encode(texts)
    for text, ids in zip(texts, ours):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
        assert encoder.decode(ids) == library.decode(ids.tolist(), skip_special_tokens=False)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aehinort \n\t'sS.1", max_size=60))
def test_common_letters_as_the_library(library, encoder, text):
    assert encoder.encode([text])[0].tolist() == library.encode(text).ids


def test_every_character_in_context(library, encoder):
    """Classes of characters agree, for all that this Python's tables name."""
    letters = [chr(c) for c in range(0x30000) if unicodedata.category(chr(c)) not in ("Cn", "Cs")]
    texts = ["".join(f"a{c} {c}1{c}." for c in letters[i : i + 200]) for i in range(0, len(letters), 200)]
    for text, ids in zip(texts, encoder.encode(texts)):
        assert ids.tolist() == library.encode(text).ids


#: Letters beside what may and may not end a word.
EDGES = st.text(alphabet="abZéßÿÀ×÷ªµıſKǅʰ中́̈ͅ0²'\"sStTreEvVmMlLdD.,-_<|>!\t\n \u00a0\u2028", max_size=40)


@settings(max_examples=1000, deadline=None)
@given(EDGES)
def test_cuts_after_letters_as_the_library(library, encoder, text):
    [ids] = encoder.encode([text])
    assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


def test_words_are_remembered_without_what_follows(library):
    fresh = trie_bpe.Encoder(BYTE_PATH)
    text = "house house, house. house's house-boat (house) naïve; naïve\n\nhouse"
    assert fresh.encode([text])[0].tolist() == library.encode(text).ids
    assert {" house", " naïve"} <= set(fresh.pieces)
    assert not {" house,", " house.", " house's", " naïve;"} & set(fresh.pieces)


def test_ids_and_text_come_from_one_python_step(spark, medium):
    """Ids are not handed to a second worker to be decoded."""
    plan = queries.op9_trie_bpe(spark, medium)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"ArrowEvalPython \[", plan)) == 1


def test_memory_of_words_is_bounded(library, monkeypatch):
    monkeypatch.setattr(trie_bpe, "REMEMBERED", 20)
    small = trie_bpe.Encoder(BYTE_PATH)
    for i in range(30):
        text = " ".join(f"w{i}x{j}" for j in range(15))
        assert small.encode([text, text])[1].tolist() == library.encode(text).ids
        assert len(small.pieces) + len(small.pieces.old) <= 120
    long = "abc" * 40 + " " + "z" * 200
    assert small.encode([long, None, long])[2].tolist() == library.encode(long).ids
    assert max(map(len, [*small.pieces, *small.pieces.old])) <= trie_bpe.LONGEST


def test_query_over_documents(spark, medium, library):
    rows = {r["doc_id"]: r for r in queries.op9_trie_bpe(spark, medium).collect()}
    texts = spark.read.parquet(f"{medium}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(texts)
    for doc_id, text in texts:
        ids = library.encode(text or "", add_special_tokens=False).ids
        got = rows[doc_id]
        assert got["n_tokens"] == len(ids)
        assert got["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert got["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_awkward_documents(spark, library):
    rows = queries.token_digests(documents(spark, AWKWARD)).collect()
    want = []
    for doc_id, text, _, _ in AWKWARD:
        ids = library.encode(text or "").ids
        digest = hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode())
        want.append((doc_id, len(ids), digest.hexdigest()))
    got = [(r["doc_id"], r["n_tokens"], r["decoded_sha256"]) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert queries.token_digests(documents(spark, [])).count() == 0


@settings(max_examples=300, deadline=None)
@given(
    st.lists(
        st.one_of(
            st.integers(0, 1), st.integers(0, 50_000), st.integers(0, 2**64 - 1), st.just(0)
        ),
        max_size=400,
    ),
    st.integers(1, 12),
)
def test_round_trip_of_any_numbers(values, repeat):
    numbers = np.array(values * repeat, np.uint64)
    words, blocks = simple8b.pack(numbers)
    assert simple8b.unpack(words, blocks.astype(np.int64)).tolist() == numbers.tolist()


def test_blocks_are_read_alone():
    numbers = np.random.default_rng(3).integers(0, 49_408, 5000).astype(np.uint64)
    numbers[1500:3300] = 0
    words, blocks = simple8b.pack(numbers)
    ends = [*blocks[1:], len(words)]
    for i, (a, b) in enumerate(zip(blocks, ends)):
        part = simple8b.unpack(words[a:b], np.array([0]))
        assert part.tolist() == numbers[i * 1024 : (i + 1) * 1024].tolist()
    assert len(words) < len(numbers) / 3.4


def expected_files(rows):
    library = Tokenizer.from_file(WORD_PATH)
    library.no_truncation()
    start, out = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, queries.END_ID]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.fixture(scope="module")
def word_library():
    library = Tokenizer.from_file(WORD_PATH)
    library.no_truncation()
    return library


@pytest.fixture(scope="module")
def chunk_ids():
    return simple8b.ChunkIds(WORD_PATH)


@settings(max_examples=1000, deadline=None)
@given(st.lists(st.one_of(EDGES, st.text(max_size=30)), max_size=3))
def test_stretches_as_the_library(word_library, chunk_ids, texts):
    texts = [*texts, "a<|endoftext|>b C<|ENDOFTEXT|>d"]
    for text, ids in zip(texts, chunk_ids.encode(texts, queries.END_ID)):
        want = word_library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == [*want, queries.END_ID]


def test_stretches_are_words_without_what_follows(word_library):
    fresh = simple8b.ChunkIds(WORD_PATH)
    text = "House house, house. house's house-boat naïve; Naïve"
    want = word_library.encode(text, add_special_tokens=False).ids
    assert fresh.encode([text], 2)[0].tolist() == [*want, 2]
    assert {"house", "naïve", ",", ".", "'s", "-boat"} <= set(fresh.known)
    assert not {"house,", "house.", "house's", "naïve;"} & set(fresh.known)


def test_words_are_stretches_without_what_is_before_and_after(word_library):
    fresh = simple8b.ChunkIds(WORD_PATH)
    text = "(house, house) HOUSE-boats,\tT\u0308 (naïve)[Naïve] x1y2 don't'sam"
    want = word_library.encode(text, add_special_tokens=False).ids
    assert fresh.encode([text], 2)[0].tolist() == [*want, 2]
    # Signs stay with the word after them, never with the one before, and capitals of a text that
    # also holds a mark are folded.
    assert {"(house", "house", ",", "-boats", "(naïve", ")[naïve"} <= set(fresh.known)
    assert not [c for c in fresh.known if re.search(r"[a-zï][^a-zï\u0308]", c)]


def test_stretches_end_with_their_text(word_library):
    fresh = simple8b.ChunkIds(WORD_PATH)
    texts = ["<|endof", "text|>T", "\u0308 it'", None, "s", "", "<|endoftext|><|startoftext|>A"]
    column = pa.array(["left out", *texts]).slice(1)
    ids, ends = fresh.encode_column(column, 2)
    want = [[*word_library.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]
    assert ends.tolist() == np.cumsum([len(w) for w in want]).tolist()
    assert ids.tolist() == sum(want, [])
    assert fresh.encode([None, ""], 2) == [[2], [2]] and fresh.encode([], 2) == []


def test_segments_end_with_the_document_that_fills_them(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "ids")
    rows = [(i, "one two three " * (i % 7 * 40), "en", "s") for i in range(300)]
    rows.append((300, "four " * 140_000, "en", "s"))
    simple8b.write_ids(documents(spark, rows), folder, WORD_PATH, queries.END_ID, partitions=1)
    ends = [len(t.split()) + 1 for _, t, _, _ in rows]
    size, want = 0, []
    for n in ends:
        size += n
        if size >= simple8b.SEGMENT_IDS:
            want.append(size)
            size = 0
    found = spark.read.parquet(folder).orderBy("start").collect()
    assert [r["n_ids"] for r in found] == want + [size] * (size > 0)
    assert sum((r["doc_ids"] for r in found), []) == list(range(301))
    got = [tuple(r) for r in simple8b.read_ids(spark, folder, simple8b.crc32, "long").collect()]
    assert sorted(got) == expected_files([r[:2] for r in rows])


def test_files_over_documents(spark, medium):
    got = [tuple(r) for r in queries.op8_simple8b(spark, medium).collect()]
    texts = spark.read.parquet(f"{medium}/documents.parquet").select("doc_id", "text").collect()
    assert sorted(got) == expected_files([tuple(r) for r in texts])


def test_files_of_awkward_documents(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "ids")
    docs = documents(spark, AWKWARD)
    simple8b.write_ids(docs, folder, WORD_PATH, queries.END_ID, partitions=3)
    got = [tuple(r) for r in simple8b.read_ids(spark, folder, simple8b.crc32, "long").collect()]
    want = expected_files([(i, t) for i, t, _, _ in AWKWARD])
    assert sorted(got, key=lambda r: r[1]) == want


def test_no_documents(spark, tmp_path):
    folder = str(tmp_path / "none")
    simple8b.write_ids(documents(spark, []), folder, WORD_PATH, queries.END_ID)
    assert simple8b.read_ids(spark, folder, simple8b.crc32, "long").count() == 0
