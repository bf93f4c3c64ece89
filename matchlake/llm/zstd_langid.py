"""Language identification by compression with one zstandard dictionary per language."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructType

#: The bound of the training sample: so many documents of a language are expected in it ...
SAMPLE_DOCS = 600
#: ... and so many normalised characters of each, from a place its text decides.
PIECE_CHARS = 400
DICTIONARY_BYTES = 64 * 1024
#: Fast levels find too few short matches in the dictionary to tell related languages apart.
LEVEL = 9
BLOCK_BYTES = 2048
#: A prediction whose smallest size is within this share of the next is rejected, if the text
#: compresses to enough bytes for a margin to say anything.
MIN_MARGIN = 0.002
TELLING_BYTES = 100
UNKNOWN = "und"
ANSWER = (
    StructType()
    .add("lang", StringType())
    .add("score", DoubleType())
    .add("accepted", BooleanType())
)
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def normalised(text: str) -> str:
    """Lower-case letters of the whole text, all else turned into single spaces."""
    return _NOT_LETTERS.sub(" ", text.lower()).strip()


@dataclass
class Model:
    """Raw-content dictionaries by language; the bytes are all that prediction needs."""

    dictionaries: dict[str, bytes] = field(default_factory=dict)
    documents: dict[str, int] = field(default_factory=dict)

    def compressors(self) -> list[tuple[str, zstandard.ZstdCompressor]]:
        """By falling number of learned documents, then name: the order that breaks ties."""
        made = []
        for lang in sorted(self.dictionaries, key=lambda x: (-self.documents[x], x)):
            content = zstandard.ZstdCompressionDict(
                self.dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT
            )
            content.precompute_compress(level=LEVEL)
            made.append(
                (
                    lang,
                    zstandard.ZstdCompressor(
                        level=LEVEL,
                        dict_data=content,
                        write_checksum=False,
                        write_content_size=False,
                        write_dict_id=False,
                    ),
                )
            )
        return made


def train(
    docs: DataFrame, text: str = "text", lang: str = "lang", id_col: str = "doc_id"
) -> Model:
    """Fit dictionaries on a bounded sample of the rows that have text and language.

    All rows are counted by language; a row is in the sample if the hash of its id is below the
    share that gives ``SAMPLE_DOCS`` rows of its language, so the sample is the same on every
    run and does not grow with the input. Equal pieces of copies enter a dictionary once.
    """
    rows = docs.select(
        F.col(f"`{text}`").alias("text"),
        F.col(f"`{lang}`").alias("lang"),
        F.pmod(F.xxhash64(F.lit(11), F.col(f"`{id_col}`")), F.lit(1 << 32)).alias("draw"),
    ).where("text is not null and lang is not null")
    counts = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}
    wanted = F.lit(False)
    for name, n in counts.items():
        below = min(1 << 32, (SAMPLE_DOCS << 32) // n)
        wanted = wanted | ((F.col("lang") == name) & (F.col("draw") < below))
    sample: dict[str, list[str]] = {name: [] for name in counts}
    pieces = rows.where(wanted).select("lang", "draw", _piece("text").alias("piece"))
    for row in pieces.orderBy("lang", "draw", "piece").collect():
        sample[row["lang"]].append(normalised(row["piece"]))
    model = Model(documents=counts)
    for name, parts in sample.items():
        content = " ".join(dict.fromkeys(p[:PIECE_CHARS] for p in parts if p))
        model.dictionaries[name] = (content or " ").encode()[-DICTIONARY_BYTES:]
    return model


def _piece(text: str) -> Column:
    """A stretch of the text that starts where its own hash says, so copies give one piece."""
    room = F.greatest(F.lit(1), F.length(text) - 2 * PIECE_CHARS)
    start = F.pmod(F.xxhash64(F.lit(5), F.col(text)), room) + 1
    return F.substr(F.col(text), start.cast("int"), F.lit(2 * PIECE_CHARS))


def _smallest(text: str | None, coders) -> tuple[str, float, bool]:
    if text is None or not coders or not any(map(str.isalpha, text)):
        return UNKNOWN, 0.0, False
    data = normalised(text).encode("utf-8", "replace")
    blocks = [data[i : i + BLOCK_BYTES] for i in range(0, len(data), BLOCK_BYTES)]
    sizes = [(sum(len(z.compress(b)) for b in blocks), i) for i, (_, z) in enumerate(coders)]
    sizes.sort()
    best = sizes[0]
    margin = 1.0 if len(sizes) == 1 else 1.0 - best[0] / max(1, sizes[1][0])
    return coders[best[1]][0], margin, margin >= MIN_MARGIN or best[0] < TELLING_BYTES


def language(text: str, model: Model) -> Column:
    """Struct (lang, score, accepted) of the language that compresses a whole text best.

    The text is normalised, cut into blocks of ``BLOCK_BYTES`` so that no block can learn the
    language from the text itself, and every block counts. The score is the share by which the
    smallest total is below the next. A prediction is accepted unless that margin is narrow;
    texts too short for a margin to tell are accepted. Null text, text without a letter and an
    empty model give ``und`` with score 0, which is not accepted. Ties go to the language with
    more learned documents, then by name.
    """

    @F.pandas_udf(ANSWER)
    def predict(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        coders = model.compressors()
        for part in parts:
            made = [_smallest(x, coders) for x in part]
            yield pd.DataFrame(made, columns=["lang", "score", "accepted"])

    return predict(F.col(f"`{text}`"))


def held_out(id_col: str) -> Column:
    """Documents no model may learn from: crc32 of the id as text leaves remainder 1 by 3."""
    check = F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary"))
    return F.coalesce(check % 3 == 1, F.lit(False))
