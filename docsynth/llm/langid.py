"""Language identification by compression.

For each language a raw-content dictionary is made from a bounded sample of labelled texts. A text is cut into pieces
(all of it, so that the dictionary keeps its weight in long texts), every piece is compressed with every dictionary, and
the language with the fewest bytes wins. Where the runner-up needs hardly more bytes the answer is marked as rejected.

Defined cases: a null text or one without a letter is ``und`` with score 0 and rejected, as is every text where nothing
was learned. Ties go to the language that sorts first, and are rejected. Other columns are kept, repeated rows get the
same answer, and an empty table gives an empty one. A text is compressed once for each language, so cost grows with them.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsynth.llm.arrays import map_text

#: Bound of the labelled sample: rows a language, and characters a row.
SAMPLE_ROWS, SAMPLE_CHARS = 96, 4096
#: Characters compressed at once.
PIECE = 2048
LEVEL = 3
#: Share of bytes by which the runner-up must be longer.
MARGIN = 0.004
UNKNOWN = "und"


@dataclass(frozen=True)
class Model:
    """Languages and the text of their dictionaries: SAMPLE_ROWS * SAMPLE_CHARS characters each at most."""

    languages: tuple[str, ...]
    content: tuple[bytes, ...]


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Dictionaries from text and language alone.

    The sample is the text of smallest hash in each of SAMPLE_ROWS buckets of a language: the same for every order and
    partitioning, merged before the shuffle, at most SAMPLE_ROWS texts a language. Texts up to SAMPLE_CHARS characters
    are preferred, longer ones give their first SAMPLE_CHARS. Repeated rows count once.
    """
    rows = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    order = F.xxhash64("text")
    short = F.length("text") > F.lit(SAMPLE_CHARS)
    bucket = F.pmod(F.shiftright(order, 20), F.lit(SAMPLE_ROWS))
    rows = rows.select("lang", bucket.alias("bucket"), F.struct(short.alias("long"), order.alias("order"), F.substring("text", 1, SAMPLE_CHARS).alias("text")).alias("row"))
    kept = rows.groupBy("lang", "bucket").agg(F.min("row").alias("row")).select("lang", "bucket", "row.text").collect()
    found: dict[str, list[tuple[int, str]]] = {}
    for r in kept:
        found.setdefault(r["lang"], []).append((r["bucket"], r["text"]))
    names = tuple(sorted(found))
    return Model(names, tuple("\n".join(t for _, t in sorted(found[n])).lower().encode() for n in names))


@lru_cache(maxsize=2)
def dictionaries(model: Model) -> list[zstandard.ZstdCompressor]:
    out = []
    for content in model.content:
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=LEVEL)
        out.append(zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))
    return out


def sizes(text: str, coders: list[zstandard.ZstdCompressor]) -> list[int]:
    """Bytes that the whole text takes with each dictionary."""
    text = text.lower()
    pieces = [text[i : i + PIECE].encode("utf-8", "surrogatepass") for i in range(0, len(text), PIECE)]
    return [sum(len(c.compress(p)) for p in pieces) for c in coders]


def judge(text: str, model: Model) -> tuple[str, float, bool]:
    """Language, score from 0 (tie) to 1, and whether the margin is too narrow."""
    if not model.languages or not any(map(str.isalpha, text)):
        return UNKNOWN, 0.0, True
    found = sizes(text, dictionaries(model))
    best = min(range(len(found)), key=found.__getitem__)
    rest = min((s for i, s in enumerate(found) if i != best), default=None)
    score = 1.0 if rest is None else (rest - found[best]) / rest
    return model.languages[best], score, score < MARGIN


def classify(docs: DataFrame, model: Model, text: str = "text", names: tuple[str, str, str] = ("lang_pred", "score", "rejected"), keep: bool = True) -> DataFrame:
    """Adds predicted language, score and rejection; reads nothing but the text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded, see Model

    def work(col: pa.Array) -> list:
        model = shared.value
        return list(zip(*(judge(t, model) for t in col.to_pylist()), strict=True)) or [[], [], []]

    fields = [T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType()), T.StructField(names[2], T.BooleanType())]
    return map_text(docs, text, fields, work, keep)


def held_out(ident: str = "doc_id") -> Column:
    """A third of the documents, by the checksum of their id; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(ident).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def predict(docs: DataFrame) -> DataFrame:
    """One row per document: held out or not, language and score by a model of the rows that are not."""
    model = fit(docs.where(~held_out()))
    made = classify(docs.select("doc_id", held_out().alias("held_out"), "text"), model, keep=False)
    return made.select("doc_id", "held_out", "lang_pred", "score", "rejected")
