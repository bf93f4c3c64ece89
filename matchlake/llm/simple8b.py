"""Token ids in Simple-8b: 64-bit words whose selectors pack varying numbers of ids.

Layout of a word: the selector in the top four bits, then ids from bit 0 up. Selectors 2 to 15
are listed in ``PACKS``; selector 0 is a run of ``RUN`` zeros, selector 1 an escape, after which
one whole word holds one value of up to 64 bits. Every block of ``BLOCK`` ids starts a word of
its own, and its first word is recorded, so blocks are decoded alone and all at once.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.llm.shared import LETTERS, Remembered

#: Fixed: (ids, bits of each) of selectors 2 to 15.
PACKS = [
    (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7),
    (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60),
]
RUN, RUN_SELECTOR, ESCAPE_SELECTOR = 120, 0, 1
BLOCK = 1024
#: A segment, one row of a file, ends with the document that brings it to so many ids.
SEGMENT_IDS = 1 << 17
#: Stretches of a generation that is remembered, and documents of a batch.
REMEMBERED = 400_000
BATCH = 512
#: Stretches encoded in one call.
JOINED = 512
SEGMENT = (
    "shard int, first_doc long, start long, n_ids long, words binary, block_words array<int>, "
    "doc_ids array<long>, doc_ends array<long>"
)


def _fitting(values: np.ndarray) -> np.ndarray:
    """Per position, the selector that packs most ids from there on within its block."""
    n = len(values)
    best = np.full(n, ESCAPE_SELECTOR, np.uint8)
    at = np.arange(n, dtype=np.int32)
    room = np.minimum(BLOCK - at % BLOCK, n - at)
    top = int(values.max(initial=0))
    if top < 1 << 32:
        values = values.astype(np.uint32)
    # From few large ids to many small ones, so that the last to fit stays.
    packs = [*reversed([*enumerate(PACKS, 2)]), (RUN_SELECTOR, (RUN, 0))]
    # Of how many packs an id is too large for the places.
    large = np.zeros(n, np.uint8)
    for _, (_, bits) in packs:
        if top >> bits:
            large += values >= values.dtype.type(1 << bits)
    # The largest of as many places from each on as ``wide``, a power of two, doubled as counts grow.
    wide, largest = 1, large
    for allowed, (number, (count, _)) in zip(range(len(packs) - 1, -1, -1), packs):
        if n < count:
            break
        while 2 * wide <= count:
            largest, wide = np.maximum(largest[:-wide], largest[wide:]), 2 * wide
        last = n + 1 - count
        most = np.maximum(largest[:last], largest[count - wide :][:last])
        np.putmask(best[:last], (most <= allowed) & (room[:last] >= count), np.uint8(number))
    return best


_COUNT = np.array([RUN, 1, *[count for count, _ in PACKS]])
_BITS = np.array([0, 0, *[bits for _, bits in PACKS]])


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of a run of ids, and the first word of each block."""
    values = values.astype(np.uint64)
    n = len(values)
    selector = _fitting(values)
    # No word goes beyond its block, so all blocks are gone through side by side.
    step, begins, at = _COUNT[selector], np.zeros(n, bool), np.arange(0, n, BLOCK)
    while len(at):
        begins[at] = True
        at = at + step[at]
        at = at[(at % BLOCK > 0) & (at < n)]
    starts = np.flatnonzero(begins)
    chosen = selector[starts]
    slots = 1 + (chosen == ESCAPE_SELECTOR)
    place = np.cumsum(slots) - slots
    words = np.zeros(int(slots.sum()), np.uint64)
    words[place] = chosen.astype(np.uint64) << np.uint64(60)
    for number, (count, bits) in enumerate(PACKS, 2):
        mine = np.flatnonzero(chosen == number)
        if not len(mine):
            continue
        first = starts[mine]
        packed = words[place[mine]]
        for i in range(count):
            packed |= values[first + i] << np.uint64(i * bits)
        words[place[mine]] = packed
    escaped = np.flatnonzero(chosen == ESCAPE_SELECTOR)
    words[place[escaped] + 1] = values[starts[escaped]]
    blocks = place[np.searchsorted(starts, np.arange(0, n, BLOCK))]
    return words, blocks.astype(np.int32)


def unpack(words: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """The ids of all words, every selector's words at once.

    Where an escape is, the word after it is no selector. Escapes are told apart by blocks: in a
    block without any, all words are selectors; only blocks with one are read word by word.
    """
    head = (words >> np.uint64(60)).astype(np.int64)
    is_head = np.ones(len(words), bool)
    ends = np.append(blocks[1:], len(words))
    if (head == ESCAPE_SELECTOR).any():
        hits = np.concatenate(([0], np.cumsum(head == ESCAPE_SELECTOR)))
        for block in np.flatnonzero(hits[ends] > hits[blocks]):
            at = int(blocks[block])
            while at < ends[block]:
                if head[at] == ESCAPE_SELECTOR:
                    is_head[at + 1] = False
                    at += 1
                at += 1
    at = np.flatnonzero(is_head)
    head = head[at]
    counts = _COUNT[head]
    last = np.cumsum(counts)
    first = last - counts
    out = np.zeros(int(last[-1]) if len(last) else 0, np.uint64)
    for number, (count, bits) in enumerate(PACKS, 2):
        mine = np.flatnonzero(head == number)
        if len(mine):
            shifts = (np.arange(count) * bits).astype(np.uint64)
            mask = np.uint64((1 << bits) - 1)
            out[first[mine][:, None] + np.arange(count)] = (words[at[mine]][:, None] >> shifts) & mask
    escaped = np.flatnonzero(head == ESCAPE_SELECTOR)
    out[first[escaped]] = words[at[escaped] + 1]
    return out


def _steps(normalizer: dict | None) -> list[dict]:
    """The normaliser's parts, or itself where it has none."""
    return (normalizer or {}).get("normalizers", [normalizer] if normalizer else [])


#: What a byte is to the cutting of texts; 0 is a byte of a character beyond ASCII.
SPACE, LETTER, SIGN = 1, 2, 3
_KIND = np.zeros(256, np.uint8)
_KIND[:128] = SIGN
_KIND[[*b"\t\n\r "]] = SPACE
_KIND[[*range(65, 91), *range(97, 123)]] = LETTER
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Second bytes, after C3, of the letters of two bytes in ``LETTERS``: without U+00D7 and U+00F7.
_LATIN = np.zeros(256, bool)
_LATIN[0x80:0xC0] = True
_LATIN[[0x97, 0xB7]] = False


class ChunkIds:
    """Ids of texts from the tokenizers library, each distinct stretch between spaces once.

    The vocabulary's words never hold white space and its normaliser works within them, so the
    ids of a text are those of its stretches one after another. A stretch also ends at a letter
    before ASCII that is no letter: words end there, and such a character never joins the letter
    before it. So most stretches are single words, whatever follows them. Added tokens are found
    before normalising and are stretches of their own.

    A batch's stretches are marked in its bytes and told apart by Arrow's dictionary encoding, so
    Python looks up each distinct one of a batch once.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.known = Remembered(REMEMBERED)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.marks = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        longest = sorted(map(str.encode, self.marks), key=len, reverse=True)
        self._mark = re.compile(b"|".join(map(re.escape, longest)) or rb"(?!)")
        spec = json.loads(self.tokenizer.to_str())
        # Added tokens are told by case; those with a sign after a letter are cut there, so that no
        # lower-cased stretch is one.
        cut = re.compile(r"[A-Za-z][!-@\[-`{-\x7f]").search
        self.folds = any(n["type"] == "Lowercase" for n in _steps(spec["normalizer"])) and all(
            map(cut, self.marks)
        )
        self._plain = re.compile("[a-z]+").fullmatch
        self._word = re.compile(f"[{LETTERS}]+").fullmatch
        # The ids that end a word, of which the last character carries a suffix.
        suffix = spec["model"].get("end_of_word_suffix") or "\0"
        vocab = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocab.values()) + 1, bool)
        self.ends_word[[i for token, i in vocab.items() if token.endswith(suffix)]] = True

    def _folded(self, data: np.ndarray) -> np.ndarray:
        """The bytes with A-Z lower-cased, as the vocabulary does anyway, so words come together.

        Other letters are left to the library, and so is a capital before what may be a mark: the
        library composes the two before it lower-cases, and a small letter may compose where the
        capital does not.
        """
        low = _LOWER[data]
        # The first byte of U+0300 and all after it.
        before = np.flatnonzero(data[1:] >= 0xCC)
        low[before] = data[before]
        return low

    def _stretches(self, data: np.ndarray, bounds: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """Stretches of joined texts with ``bounds``, and how many are before each bound."""
        kind = _KIND[data]
        kept, letter = kind != SPACE, kind == LETTER
        # Latin letters of two bytes, told by the second.
        second = np.flatnonzero(data == 0xC3) + 1
        letter[second] = _LATIN[data[second]]
        begins = np.ones(len(data), bool)
        begins[1:] = ~kept[:-1] | letter[:-1] & (kind[1:] == SIGN)
        begins[bounds[bounds < len(data)]] = True
        low = self._folded(data) if self.folds else data.copy()
        whole = data.tobytes()
        if self._mark.search(whole):
            for text, text_end in zip(bounds.tolist(), bounds[1:].tolist()):
                for hit in self._mark.finditer(whole, text, text_end):
                    a, b = hit.span()
                    low[a:b], kept[a:b], begins[a + 1 : b] = data[a:b], True, False
                    begins[a] = True
                    begins[b : b + 1] = True
        begins &= kept
        before = np.searchsorted(np.flatnonzero(begins), bounds)
        low = low[kept]
        offsets = np.append(np.flatnonzero(begins[kept]), len(low)).astype(np.int32)
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(low)]
        return pa.Array.from_buffers(pa.string(), len(offsets) - 1, buffers), before

    def _learn_plain(self, new: list[str]) -> None:
        """Words of a to z, which normalising and cutting leave as they are, by the model itself."""
        ids, cuts = [], [0]
        for chunk in new:
            ids += [token.id for token in self.model.tokenize(chunk)]
            cuts.append(len(ids) * 4)
        data = np.array(ids, "<u4").tobytes()
        for chunk, a, b in zip(new, cuts, cuts[1:]):
            self.known[chunk] = data[a:b]

    def _learn_words(self, new: list[str]) -> None:
        """Encode many stretches of letters in one call; each is a word and has one last id."""
        [done] = self.tokenizer.encode_batch_fast([" ".join(new)], add_special_tokens=False)
        ids = np.array(done.ids, "<u4")
        cuts = ((np.flatnonzero(self.ends_word[ids]) + 1) * 4).tolist()
        if len(cuts) != len(new):
            return self._learn(new)
        data = ids.tobytes()
        for chunk, a, b in zip(new, [0, *cuts], cuts):
            self.known[chunk] = data[a:b]

    def _learn(self, new: list[str]) -> None:
        """Encode many stretches in one call, a space between them.

        Where an id starts in the joined text tells which stretch it belongs to.
        """
        done = self.tokenizer.encode(" ".join(new), add_special_tokens=False)
        data = np.array(done.ids, "<u4").tobytes()
        begins = np.fromiter((start for start, _ in done.offsets), np.int64, len(done.ids))
        sizes = np.fromiter(map(len, new), np.int64, len(new)) + 1
        cuts = (np.searchsorted(begins, np.cumsum(sizes)) * 4).tolist()
        for chunk, a, b in zip(new, [0, *cuts], cuts):
            self.known[chunk] = data[a:b]

    def _learn_all(self, new: set[str]) -> None:
        plain = list(filter(self._plain, new)) if self.folds else []
        odd = new.intersection(self.marks)
        for chunk in odd:
            ids = self.tokenizer.encode(chunk, add_special_tokens=False).ids
            self.known[chunk] = np.array(ids, "<u4").tobytes()
        rest = new.difference(plain, odd)
        words = list(filter(self._word, rest))
        others = list(rest.difference(words))
        self._learn_plain(plain)
        for learn, some in ((self._learn_words, words), (self._learn, others)):
            for i in range(0, len(some), JOINED):
                learn(some[i : i + JOINED])

    def encode_column(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with the end id after it, and where each text's ids end."""
        texts = texts.fill_null("")
        first, n = texts.offset, len(texts)
        _, offsets, data = texts.buffers()
        bounds = np.frombuffer(offsets, np.int32)[first : first + n + 1].astype(np.int64)
        data = np.frombuffer(data or b"", np.uint8)[bounds[0] : bounds[-1]]
        stretches, before = self._stretches(data, bounds - bounds[0])
        stretches = stretches.dictionary_encode()
        distinct = stretches.dictionary.to_numpy(zero_copy_only=False).tolist()
        self._learn_all(self.known.missing(distinct))
        ids = [*map(self.known.__getitem__, distinct), np.array([end], "<u4").tobytes()]
        counts = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        ids = np.frombuffer(b"".join(ids), "<u4")
        # The end id follows the stretches of each text.
        which = np.insert(stretches.indices.to_numpy(), before[1:], len(distinct))
        sizes = counts[which]
        ends = np.cumsum(sizes)
        shift = (np.cumsum(counts) - counts)[which] - (ends - sizes)
        return ids[np.arange(sizes.sum()) + np.repeat(shift, sizes)], ends[before[1:] + np.arange(n)]

    def encode(self, texts: list[str | None], end: int) -> list[np.ndarray]:
        """Ids of each text with the end id after them; a null text has the end id alone."""
        if not texts:
            return []
        ids, ends = self.encode_column(pa.array(texts, pa.string()), end)
        return np.split(ids, ends[:-1])


@lru_cache(maxsize=2)
def _chunk_ids(path: str) -> ChunkIds:
    """One encoder per worker, as reading a vocabulary costs more than a small partition."""
    return ChunkIds(path)


def _segments(
    batches: Iterator[pa.RecordBatch], path: str, end: int, schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    """Sorted documents of one partition as segments, packed as they fill."""
    encoder, shard = _chunk_ids(path), TaskContext.get().partitionId()
    start, size, docs, parts, doc_ends = 0, 0, [], [], []

    def segment() -> pa.RecordBatch:
        words, blocks = pack(np.concatenate(parts))
        row = [shard, docs[0], start, size, words.tobytes(), blocks, docs, np.concatenate(doc_ends)]
        return pa.RecordBatch.from_arrays(
            [pa.array([x], field.type) for x, field in zip(row, schema)], schema=schema
        )

    for batch in batches:
        ids, texts = batch.column("doc_id"), batch.column("text")
        for i in range(0, len(texts), BATCH):
            made, ends = encoder.encode_column(texts.slice(i, BATCH), end)
            at, begin = 0, 0
            while at < len(ends):
                # Up to the document that fills the segment, or the last.
                full = int(np.searchsorted(ends, begin + SEGMENT_IDS - size)) + 1
                until = int(ends[at:full][-1])
                docs += ids.slice(i + at, len(ends[at:full])).to_pylist()
                parts.append(made[begin:until])
                doc_ends.append(ends[at:full] - begin + size)
                size += until - begin
                at, begin = full, until
                if size >= SEGMENT_IDS:
                    yield segment()
                    start, size, docs, parts, doc_ends = start + size, 0, [], [], []
    if docs:
        yield segment()


def write_ids(
    docs: DataFrame,
    folder: str,
    path: str,
    end: int,
    text: str = "text",
    id_col: str = "doc_id",
    partitions: int | None = None,
) -> None:
    """Encode whole texts in ascending id order and write them as Simple-8b segments.

    The files are Parquet tables of ``SEGMENT`` rows: packed words, the first word of each
    block, and the ids of the documents with the ends of their id runs. Null text is encoded as
    empty; null ids come first. Rows that repeat an id are documents of their own.
    """
    spark = docs.sparkSession
    number = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = pa.schema(
        [
            ("shard", pa.int32()),
            ("first_doc", pa.int64()),
            ("start", pa.int64()),
            ("n_ids", pa.int64()),
            ("words", pa.binary()),
            ("block_words", pa.list_(pa.int32())),
            ("doc_ids", pa.list_(pa.int64())),
            ("doc_ends", pa.list_(pa.int64())),
        ]
    )
    ordered = (
        docs.select(
            F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")
        )
        .repartitionByRange(number, "doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    ordered.mapInArrow(lambda x: _segments(x, path, end, schema), SEGMENT).write.mode(
        "overwrite"
    ).parquet(folder)


def read_ids(
    spark: SparkSession, folder: str, of: Callable[[np.ndarray], object], kind: str
) -> DataFrame:
    """Documents of written files as (doc_id, start, n_tokens, value).

    ``start`` counts the ids of all documents before; ``value`` is ``of`` the document's ids
    (little-endian unsigned 32-bit), of SQL type ``kind``. One row per file partition reaches
    the driver, to add up the starts.
    """
    segments = spark.read.schema(SEGMENT).parquet(folder)
    shards = (
        segments.groupBy("shard").agg(F.min("first_doc").alias("f"), F.sum("n_ids")).collect()
    )
    before, offsets = 0, []
    # A shard with a null id has the smallest ids, as nulls sort first.
    empty = {r[0] for r in segments.where("first_doc is null").select("shard").distinct().collect()}
    for shard, _, total in sorted(shards, key=lambda r: (r[0] not in empty, r[1] or 0)):
        offsets.append((shard, before))
        before += total
    table = spark.createDataFrame(offsets, "shard int, before long")

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words = np.frombuffer(row["words"], np.uint64)
                ids = unpack(words, np.array(row["block_words"], np.int64)).astype("<u4")
                ends = np.array(row["doc_ends"], np.int64)
                starts = np.concatenate(([0], ends[:-1]))
                values = [of(ids[a:b]) for a, b in zip(starts, ends)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array(row["doc_ids"], pa.int64()),
                        "start": pa.array(starts + row["start"] + row["before"], pa.int64()),
                        "n_tokens": pa.array(ends - starts, pa.int64()),
                        "value": pa.array(values),
                    }
                )

    joined = segments.join(F.broadcast(table), "shard")
    return joined.mapInArrow(
        documents, f"doc_id long, start long, n_tokens long, value {kind}"
    )


def crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.tobytes())
