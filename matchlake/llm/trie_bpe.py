"""Byte-pair encoding of whole texts by traversing a trie of their distinct words.

Byte-pair encoding has one last token for every prefix of a word, and the encoding of a word is
that token after the encoding of what precedes it. So the state of a prefix is one token. The
distinct words of a batch enter a trie; a depth-first walk gives each node the one token that
ends there and may follow the state where it starts. Prefixes that words share are walked once.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from matchlake.llm.shared import LETTERS, Remembered

#: Fixed: the pattern that cuts text into words before the merges.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Entries of a generation of remembered pieces, their characters at most, and documents of a batch.
REMEMBERED = 250_000
LONGEST = 48
PAIRS = 200_000
BATCH = 512
BYTES = 256
END = -1
#: Bytes at the end of a prefix that say how long a token ending there may be.
TAIL = 4
#: Bits of a token's number in a pair of tokens held as one integer.
PAIR_BITS = 32
MASK = (1 << PAIR_BITS) - 1


def byte_letters() -> dict[str, int]:
    """The letter a byte-level vocabulary writes for each byte, to that byte.

    Printable bytes stand for themselves; the others take the letters from 256 on, in order.
    """
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in printable}
    rest = [b for b in range(BYTES) if b not in printable]
    return letters | {chr(BYTES + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens numbered by the order in which merges make them; single bytes come first."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters, model = byte_letters(), spec["model"]
        if spec["pre_tokenizer"] | {"trim_offsets": True} != {
            "type": "ByteLevel",
            "add_prefix_space": False,
            "trim_offsets": True,
            "use_regex": True,
        } or spec["normalizer"] or model["type"] != "BPE":
            raise ValueError("not a plain byte-level BPE vocabulary")
        self.added = {}
        for token in spec["added_tokens"]:
            if token["single_word"] or token["lstrip"] or token["rstrip"]:
                raise ValueError(f"added token with context: {token}")
            self.added[token["content"]] = token["id"]
        vocab = model["vocab"]
        self.bytes = [bytes([b]) for b in range(BYTES)]
        by_letter = {b: letter for letter, b in letters.items()}
        self.ids = [vocab[by_letter[b]] for b in range(BYTES)]
        number = {by_letter[b]: b for b in range(BYTES)}
        self.left, self.right = list(range(BYTES)), list(range(BYTES))
        self.joined: dict[tuple[int, int], int] = {}
        for merge in model["merges"]:
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            if a + b in number:
                raise ValueError(f"two merges give {a + b!r}")
            number[a + b] = len(self.ids)
            self.joined[number[a], number[b]] = len(self.ids)
            self.left.append(number[a])
            self.right.append(number[b])
            self.bytes.append(self.bytes[number[a]] + self.bytes[number[b]])
            self.ids.append(vocab[a + b])
        self.reached = {
            self.bytes[t]: t for t in range(len(self.ids)) if t < BYTES or self._whole(t)
        }
        self.sizes = [len(data) for data in self.bytes]
        # How long a token of at least TAIL bytes may be, by its last bytes.
        self.longest_by_tail: dict[bytes, int] = {}
        for data in self.reached:
            tail = data[-TAIL:]
            self.longest_by_tail[tail] = max(len(data), self.longest_by_tail.get(tail, 0))
        self.text = {i: self.bytes[t] for t, i in enumerate(self.ids)}
        self.text |= {i: content.encode() for content, i in self.added.items()}

    def apart(self, a: int, b: int, but: int = END) -> bool:
        """Whether the merges of bytes leave token b apart from token a before it.

        Goes back in time: the later made of the two edge tokens is undone, and at each state
        the pair at the edge must not join before one of its tokens is used up. Of equal merges
        the left one comes first. ``but`` is a merge that does not count.
        """
        a_until = b_until = len(self.ids)
        while True:
            made = self.joined.get((a, b), a_until)
            if made != but and made < a_until and made <= b_until:
                return False
            if a < BYTES and b < BYTES:
                return True
            if a > b:
                a_until, a = a, self.right[a]
            else:
                b_until, b = b, self.left[b]

    def _whole(self, token: int) -> bool:
        """Whether the bytes of a token are encoded as that token."""
        return self.apart(self.left[token], self.right[token], but=token)


class Encoder:
    """Ids of texts as little-endian 32-bit bytes, with earlier pieces remembered up to a bound.

    A piece is a word, or a chunk of several words without white space inside. Long pieces are
    known for their batch only, so what is remembered is bounded in bytes as well.
    """

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.pieces = Remembered(REMEMBERED)
        self._apart: dict[int, bool] = {}
        self._word = regex.compile(WORDS)
        # Words never cross from other characters to a space or line feed, so a text whose only
        # white space is those may be cut before each run of them, and also after letters, before
        # ASCII that is no letter. What is left of a chunk then are mostly whole words.
        self._chunk = re.compile(
            rf"[ \n]*[{LETTERS}]++(?=[\0-@\[-`{{-\x7f]|\Z)|[ \n]*[^ \n]+|[ \n]+"
        )
        self._one_word = re.compile(f" ?[{LETTERS}]+").fullmatch
        self._odd_space = re.compile(r"[^\S \n]|[\x1c-\x1f]")
        names = sorted(self.vocabulary.added, key=len, reverse=True)
        self._added = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None

    def _walk(self, words: Iterable[str], into: dict[str, bytes]) -> None:
        """Encode new distinct words in one depth-first traversal of their trie.

        The trie is its words in order, which is the order of the traversal: a word shares with
        the one before it the path up to where they differ, and ``states`` holds the last tokens
        along the present path. Only the nodes below are new.
        """
        vocabulary, known = self.vocabulary, self._apart
        reached, longest = vocabulary.reached.get, vocabulary.longest_by_tail.get
        sizes, lookup = vocabulary.sizes, known.get

        def follows(pair: int) -> bool:
            if len(known) >= PAIRS:
                known.clear()
            fits = known[pair] = vocabulary.apart(pair >> PAIR_BITS, pair & MASK)
            return fits

        states, last = [END], b""
        for data, word in sorted((w.encode("utf-8", "replace"), w) for w in words):
            shared, most = 0, min(len(last), len(data))
            while shared < most and last[shared] == data[shared]:
                shared += 1
            del states[shared + 1 :]
            begin = shared - sizes[states[shared]] if shared else 0
            for depth in range(shared + 1, len(data) + 1):
                # One token that ends here may follow the state where it starts. Often it is
                # the last one grown by a byte, else they are tried by falling length.
                token = reached(data[begin:depth])
                if token is not None and begin:
                    pair = states[begin] << PAIR_BITS | token
                    fits = lookup(pair)
                    if not (follows(pair) if fits is None else fits):
                        token = None
                if token is None:
                    room = longest(data[depth - TAIL : depth], TAIL - 1) if depth >= TAIL else depth
                    for begin in range(depth - room if depth > room else 0, depth):
                        token = reached(data[begin:depth])
                        if token is None:
                            continue
                        if not begin:
                            break
                        pair = states[begin] << PAIR_BITS | token
                        fits = lookup(pair)
                        if follows(pair) if fits is None else fits:
                            break
                states.append(token)
            into[word] = self._ids(states)
            last = data

    def _ids(self, states: list[int]) -> bytes:
        """The ids that lead to the last state of a path."""
        ids, sizes, out, depth = self.vocabulary.ids, self.vocabulary.sizes, [], len(states) - 1
        while depth:
            token = states[depth]
            out.append(ids[token])
            depth -= sizes[token]
        return array("I", reversed(out)).tobytes()

    def _learn(self, chunks: set[str]) -> list[str]:
        """Know the ids of chunks: the new ones from those of their words. Names the long ones."""
        absent = self.pieces.missing(chunks)
        whole = set(filter(self._one_word, absent))
        cut = {c: self._word.findall(c) for c in absent.difference(whole)}
        words = {w for found in cut.values() for w in found}.difference(whole)
        words = self.pieces.missing(words, turn=False) | whole
        fresh: dict[str, bytes] = {}
        self._walk(words, fresh)
        known = self.pieces
        for chunk, found in cut.items():
            if chunk not in fresh:
                fresh[chunk] = b"".join([fresh[w] if w in fresh else known[w] for w in found])
        known.update(fresh)
        return [p for p in fresh if len(p) > LONGEST]

    def _chunks(self, text: str) -> list[str]:
        if self._odd_space.search(text):
            return self._word.findall(text)
        return self._chunk.findall(text)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text; a null text has none, like an empty one."""
        pieces = []
        for text in texts:
            parts = self._added.split(text) if text and self._added else [text or ""]
            # Every second part is an added token.
            pieces.append(
                [p if i % 2 else self._chunks(p) for i, p in enumerate(parts) if i % 2 or p]
            )
        distinct = set().union(*[p for parts in pieces for p in parts if isinstance(p, list)])
        long = self._learn(distinct)
        # The batch's own pieces are few beside all that is known, and so found sooner.
        ids = dict(zip(distinct, map(self.pieces.__getitem__, distinct))).__getitem__
        out = []
        for parts in pieces:
            data = [
                b"".join(map(ids, p))
                if isinstance(p, list)
                else array("I", [self.vocabulary.added[p]]).tobytes()
                for p in parts
            ]
            out.append(np.frombuffer(b"".join(data), np.uint32))
        for piece in long:
            del self.pieces[piece]
        return out

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids, special tokens included; bytes that are no UTF-8 become U+FFFD."""
        data = b"".join(map(self.vocabulary.text.__getitem__, ids.tolist()))
        return data.decode("utf-8", "replace")


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def as_lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.array([], np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


def token_ids(text: Column, path: str) -> Column:
    """Ids of a whole text as ``array<int>``; null and empty text have none.

    ``path`` names a byte-level BPE file; every executor reads it once per worker.
    """

    @F.arrow_udf("array<int>")
    def encode(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = _encoder(path)
        for part in parts:
            out = []
            for i in range(0, len(part), BATCH):
                out.extend(encoder.encode(part.slice(i, BATCH).to_pylist()))
            yield as_lists(out)

    return encode(text)


def token_ids_and_text(text: Column, path: str) -> Column:
    """``struct(ids, decoded)``: the ids of a whole text and the text these ids decode to.

    Both come from one worker, so ids are not handed back to Python to be decoded.
    """

    @F.arrow_udf("struct<ids:array<int>,decoded:string>")
    def encode(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = _encoder(path)
        for part in parts:
            ids, decoded = [], []
            for i in range(0, len(part), BATCH):
                made = encoder.encode(part.slice(i, BATCH).to_pylist())
                ids.extend(made)
                decoded.extend(map(encoder.decode, made))
            yield pa.StructArray.from_arrays(
                [as_lists(ids), pa.array(decoded, pa.string())], ["ids", "decoded"]
            )

    return encode(text)


def token_text(ids: Column, path: str) -> Column:
    """Text of ids; null ids give null."""

    @F.arrow_udf("string")
    def decode(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = _encoder(path)
        for part in parts:
            yield pa.array(
                [None if x.as_py() is None else encoder.decode(x.values.to_numpy()) for x in part],
                pa.string(),
            )

    return decode(ids)
