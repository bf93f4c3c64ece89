"""Alignment of two tokenizers by an inverted index of token pairs.

Each document is encoded twice and the two token sequences are linked where their byte ranges
overlap. A pair of ids keeps a posting list: for every chunk of documents a compressed bitmap of
the documents that hold the pair, and multiplicity planes, bitmaps of the documents in whose link
count the bit 2**k is set. Bitmaps of different chunks are OR-merged by putting them side by side,
so popcounts add up: of the bitmaps to document counts, of the weighted planes to link counts.
The postings then carry the corpus-wide counts back to their documents as scores.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from matchlake.llm.shared import Scratch
from matchlake.llm.trie_bpe import WORDS, byte_letters
from matchlake.operators.skew import ROWS_PER_TASK, HotKeys, spread_join

#: Characters and documents that share a chunk, at most (one document may be longer).
CHUNK_CHARS = 1_500_000
CHUNK_DOCS = 1 << 15
DOC_BITS = 16
ID_BITS = 24
#: The plane that holds the documents themselves; planes from 0 on hold bits of the link count.
PRESENCE = -1

DOCUMENT = "chunk long, doc int, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
POSTING = "a int, b int, plane int, card int, dense boolean, bits binary"


class Pair:
    """The two tokenizers, the bytes of their tokens, and the tokens' numbers as text."""

    def __init__(self, path_a: str, path_b: str):
        with open(path_a, encoding="utf-8") as file:
            model = json.load(file)["model"]
        letters = byte_letters()
        made = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        numbers = [model["vocab"][token] for token in made]
        if numbers != sorted(numbers) or len({*made}) < len(made):
            raise ValueError("ids of merged tokens do not follow the order of the merges")
        ranks = {
            bytes(letters[c] for c in token): model["vocab"][token] for token in [*letters, *made]
        }
        self.a = tiktoken.Encoding("a", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a = {n: t for t, n in ranks.items()}
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        top = max(self.bytes_a) + 1
        if max(top, len(self.bytes_b)) >= 1 << ID_BITS:
            raise ValueError(f"ids need more than {ID_BITS} bits")
        self.size_a = np.zeros(top, np.int64)
        for n, token in self.bytes_a.items():
            self.size_a[n] = len(token)
        self.size_b = np.array([len(t) for t in self.bytes_b], np.int64)
        # By 2 * id, and one more where the token ends a group.
        self.text_a = np.array([f"{i}{s}" for i in range(top) for s in ",|"], object)
        self.text_b = np.array([f"{i}{s}" for i in range(len(self.bytes_b)) for s in ",;"], object)

    def _piece(self, i: int) -> bytes:
        if self.b.is_byte(i):
            return bytes([int(self.b.id_to_piece(i)[1:-1], 16)])
        return self.b.id_to_piece(i).replace("▁", " ").encode()

    def encode(self, text: str | None) -> tuple[list[int], list[int]]:
        """Ids of both tokenizers, or none where either does not spell the text."""
        if not text:
            return [], []
        whole = (" " + text).encode()
        a = self.a.encode_ordinary(" " + text)
        if b"".join(map(self.bytes_a.__getitem__, a)) != whole:
            return [], []
        b = self.b.encode(text)
        if b"".join(map(self.bytes_b.__getitem__, b)) != whole:
            return [], []
        return a, b


@lru_cache(maxsize=1)
def _pair(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


def align(pair: Pair, texts: list[str | None]) -> tuple[dict[str, list], np.ndarray, np.ndarray, np.ndarray]:
    """Counts and group digests per text, and the links as (text number, A id, B id).

    All texts are laid end to end: where a text ends, both sequences end, so nothing links
    across texts.
    """
    ids = [pair.encode(text) for text in texts]
    n_a = np.array([len(a) for a, _ in ids], np.int64)
    n_b = np.array([len(b) for _, b in ids], np.int64)
    a = np.array([i for x, _ in ids for i in x], np.int64)
    b = np.array([i for _, x in ids for i in x], np.int64)
    ends_a, ends_b = np.cumsum(pair.size_a[a]), np.cumsum(pair.size_b[b])
    shut_a, shut_b = _shared(ends_a, ends_b), _shared(ends_b, ends_a)
    doc_a = np.repeat(np.arange(len(texts)), n_a)
    # Between two neighbouring ends, of either side, lies one A token and one B token.
    cuts = np.sort(np.concatenate([ends_a, ends_b[~shut_b]]), kind="stable")
    link_a, link_b = np.searchsorted(ends_a, cuts), np.searchsorted(ends_b, cuts)
    digests = _digests(pair, a, b, shut_a, shut_b, n_a + n_b)
    counts = {
        "n_a": n_a.tolist(),
        "n_b": n_b.tolist(),
        "n_groups": np.bincount(doc_a[shut_a], minlength=len(texts)).tolist(),
        "n_links": np.bincount(doc_a[link_a], minlength=len(texts)).tolist(),
        "groups_sha256": digests,
    }
    return counts, doc_a[link_a], a[link_a], b[link_b]


def _shared(ends: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Whether each end is an end of the others too; both rise."""
    if not len(others):
        return np.zeros(len(ends), bool)
    at = np.minimum(np.searchsorted(others, ends), len(others) - 1)
    return others[at] == ends


def _digests(pair: Pair, a, b, shut_a, shut_b, sizes) -> list[str]:
    """Digest of each text's groups; a text without tokens has an empty one."""
    group_a = np.cumsum(shut_a) - shut_a
    group_b = np.cumsum(shut_b) - shut_b
    per_a, per_b = np.bincount(group_a), np.bincount(group_b)
    # A group's A tokens come before its B tokens and after all of the groups before.
    at_a = np.arange(len(a)) + (np.cumsum(per_b) - per_b)[group_a]
    at_b = np.arange(len(b)) + np.cumsum(per_a)[group_b]
    written = np.empty(len(a) + len(b), object)
    written[at_a] = pair.text_a[2 * a + shut_a]
    written[at_b] = pair.text_b[2 * b + shut_b]
    stops = np.cumsum(sizes)
    out = []
    for start, stop in zip(stops - sizes, stops):
        groups = "".join(written[start:stop].tolist())[:-1]
        out.append(hashlib.sha256(groups.encode()).hexdigest() if groups else "")
    return out


# --- postings ----------------------------------------------------------------


def containers(docs: np.ndarray, starts: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Cardinality, kind and bytes of the sorted document numbers from each start on.

    A set is held as 16-bit numbers, or as a bitmap of ``room`` bits where that is smaller.
    """
    card = np.diff(np.append(starts, len(docs)))
    width = -(-room // 8)
    dense = 2 * card > width
    raw, pieces, done = docs.astype("<u2"), [], 0
    for i in np.flatnonzero(dense):
        bits = np.zeros(8 * width, bool)
        bits[docs[starts[i] : starts[i] + card[i]]] = True
        pieces += [raw[done : starts[i]].tobytes(), np.packbits(bits).tobytes()]
        done = starts[i] + card[i]
    pieces.append(raw[done:].tobytes())
    offsets = np.concatenate(([0], np.cumsum(np.where(dense, width, 2 * card)))).astype(np.int32)
    buffers = [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(b"".join(pieces))]
    return card, dense, pa.Array.from_buffers(pa.binary(), len(card), buffers)


def positions(dense: np.ndarray, bits: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The documents of every container, one container after the other, and how many each has."""
    offsets = np.frombuffer(bits.buffers()[1], np.int32)[bits.offset :][: len(bits) + 1]
    data = np.frombuffer(bits.buffers()[2] or b"", np.uint8)
    sizes = np.diff(offsets) // 2
    parts, done = [], 0
    for i in np.flatnonzero(dense):
        docs = np.flatnonzero(np.unpackbits(data[offsets[i] : offsets[i + 1]]))
        parts += [_numbers(data, offsets[done], offsets[i]), docs]
        sizes[i], done = len(docs), i + 1
    if len(bits):
        parts.append(_numbers(data, offsets[done], offsets[-1]))
    return np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64), sizes


def _numbers(data: np.ndarray, start: int, stop: int) -> np.ndarray:
    return np.frombuffer(data[start:stop].tobytes(), "<u2")


def _postings(links: list[np.ndarray], room: int) -> Iterator[dict]:
    """Columns of the postings of one chunk, plane by plane."""
    codes, count = np.unique(np.concatenate(links), return_counts=True)
    more = count - 1
    for plane in range(PRESENCE, int(more.max()).bit_length()):
        mine = codes if plane == PRESENCE else codes[(more >> plane) & 1 == 1]
        if not len(mine):
            continue
        pairs = mine >> np.uint64(DOC_BITS)
        starts = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1]))
        docs = (mine & np.uint64((1 << DOC_BITS) - 1)).astype(np.int64)
        card, dense, bits = containers(docs, starts, room)
        heads = pairs[starts]
        yield {
            "a": (heads >> np.uint64(ID_BITS)).astype(np.int32),
            "b": (heads & np.uint64((1 << ID_BITS) - 1)).astype(np.int32),
            "plane": np.full(len(starts), plane, np.int32),
            "card": card.astype(np.int32),
            "dense": dense,
            "bits": bits,
        }


def _indexer(path_a: str, path_b: str, schema: pa.Schema):
    """Batches of (id, text) to rows of documents and rows of postings."""
    names = schema.names

    def rows(values: dict, size: int) -> pa.RecordBatch:
        columns = [
            values[f.name] if isinstance(values.get(f.name), pa.Array)
            else pa.nulls(size, f.type) if f.name not in values
            else pa.array(values[f.name], f.type)
            for f in schema
        ]
        return pa.RecordBatch.from_arrays(columns, names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(path_a, path_b)
        base = TaskContext.get().partitionId() << 32
        chunk, docs, chars, links = 0, 0, 0, []

        def shut() -> Iterator[pa.RecordBatch]:
            if links and sum(map(len, links)):
                for values in _postings(links, docs):
                    size = len(values["a"])
                    yield rows({"chunk": np.full(size, base + chunk), **values}, size)

        for batch in batches:
            texts = batch.column("text").to_pylist()
            start = 0
            while start < len(texts):
                # As many texts as the chunk still takes, one at least.
                stop, held = start, 0
                while stop < len(texts) and (
                    stop == start or held + len(texts[stop] or "") <= CHUNK_CHARS // 4
                ) and docs + stop - start < CHUNK_DOCS:
                    held += len(texts[stop] or "")
                    stop += 1
                counts, at, a, b = align(pair, texts[start:stop])
                code = a.astype(np.uint64) << np.uint64(ID_BITS + DOC_BITS)
                code |= b.astype(np.uint64) << np.uint64(DOC_BITS)
                links.append(code | (at + docs).astype(np.uint64))
                size = stop - start
                yield rows(
                    {
                        "id": batch.column("id").slice(start, size),
                        "chunk": np.full(size, base + chunk),
                        "doc": np.arange(docs, docs + size),
                        **counts,
                    },
                    size,
                )
                docs, chars, start = docs + size, chars + held, stop
                if chars >= CHUNK_CHARS or docs >= CHUNK_DOCS:
                    yield from shut()
                    chunk, docs, chars, links = chunk + 1, 0, 0, []
        yield from shut()

    return work


def index(docs: DataFrame, id_col: str, text_col: str, path_a: str, path_b: str) -> tuple[DataFrame, DataFrame]:
    """Documents with their counts, and the postings of all pairs; both are one written table.

    A chunk is numbered by its task, so the table is written before anything reads the numbers.
    """
    source = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    fields = StructType.fromDDL(f"{DOCUMENT}, {POSTING}").fields
    schema = StructType([source.schema["id"], *fields])
    work = _indexer(path_a, path_b, to_arrow_schema(schema))
    table = Scratch(docs.sparkSession, "pair-bitmaps").put(source.mapInArrow(work, schema), "index")
    documents = table.where(F.col("plane").isNull()).select(
        "id", "chunk", "doc", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"
    )
    return documents, table.where(F.col("plane").isNotNull()).select(
        "chunk", "a", "b", "plane", "card", "dense", "bits"
    )


def pair_counts(postings: DataFrame) -> DataFrame:
    """(a, b, n_docs, n_links, n_rows, best): popcounts of each pair's merged bitmaps.

    ``best`` tells whether no pair of the same B id has more links. Sums are taken within tasks
    before anything is shuffled.
    """
    card = F.col("card").cast("long")
    present = F.col("plane") == PRESENCE
    weight = F.when(present, F.lit(1)).otherwise(F.expr("shiftleft(1L, plane)"))
    counted = postings.groupBy("a", "b").agg(
        F.sum(F.when(present, card).otherwise(0)).alias("n_docs"),
        F.sum(card * weight).alias("n_links"),
        F.count(F.lit(1)).alias("n_rows"),
    )
    most = F.max("n_links").over(Window.partitionBy("b"))
    return counted.withColumn("best", F.col("n_links") == most)


def _scores(group: pa.Table) -> pa.Table:
    """Per document of one chunk: links of a best pair, and the counts of all its links' pairs."""
    group = group.combine_chunks()
    dense = group.column("dense").to_numpy()
    bits = group.column("bits").chunk(0) if group.num_rows else pa.array([], pa.binary())
    docs, sizes = positions(dense, bits)
    plane = group.column("plane").to_numpy()
    weight = np.where(plane == PRESENCE, 1, np.int64(1) << np.maximum(plane, 0))
    every = np.repeat(weight * group.column("n_links").to_numpy(), sizes)
    best = np.repeat(weight * group.column("best").to_numpy(), sizes)
    top = int(docs.max(initial=-1)) + 1
    n_best, count_sum = np.zeros(top, np.int64), np.zeros(top, np.int64)
    np.add.at(n_best, docs, best)
    np.add.at(count_sum, docs, every)
    held = np.unique(docs)
    chunk = np.full(len(held), group.column("chunk")[0].as_py() if group.num_rows else 0)
    return pa.table(
        [
            pa.array(chunk, pa.int64()),
            pa.array(held.astype(np.int32)),
            pa.array(n_best[held]),
            pa.array(count_sum[held]),
        ],
        names=["chunk", "doc", "n_best", "count_sum"],
    )


def scores(postings: DataFrame, counts: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """(chunk, doc, n_best, count_sum) of every document that has links.

    The counts join the postings by pair; a pair with more rows than a task should hold is dealt
    over pieces by chunk. Then each chunk's postings meet, which are as many as its documents'
    links at most.
    """
    keys = ["a", "b"]
    many = counts.where(F.col("n_rows") > rows_per_task).select(
        F.xxhash64(*keys).alias("hash"), "n_rows"
    )
    hot = HotKeys(tuple(keys), {r["hash"]: r["n_rows"] for r in many.collect()}, rows_per_task)
    known = counts.select("a", "b", "n_links", "best")
    joined = spread_join(postings, known, keys, ["chunk"], hot)
    grouped = joined.select("chunk", "plane", "dense", "bits", "n_links", "best").groupBy("chunk")
    return grouped.applyInArrow(_scores, "chunk long, doc int, n_best long, count_sum long")


def aligned(
    docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """How the tokens of two vocabularies align, per document and against the whole corpus.

    ``path_a`` is a byte-level BPE file, read on a space and the text; ``path_b`` a sentencepiece
    model, which adds that space itself. Returns the id and n_a, n_b, n_groups, n_links, n_best,
    count_sum and groups_sha256. Null and empty texts, and those whose tokens do not spell them
    again, have zeros and an empty digest. Every row counts, also rows that repeat an id or a
    text, and rows without an id; an empty table gives an empty result. Other columns are ignored.
    """
    documents, postings = index(docs, id_col, text_col, path_a, path_b)
    counts = Scratch(docs.sparkSession, "pair-counts").put(pair_counts(postings), "counts")
    found = scores(postings, counts)
    zero = F.lit(0).cast("long")
    return documents.join(found, ["chunk", "doc"], "left").select(
        F.col("id").alias(id_col),
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"),
        "groups_sha256",
    )
