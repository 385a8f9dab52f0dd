"""Byte-pair encoding with forced boundaries, and decoding.

Reads a ``tokenizers`` JSON file of the kind "BPE with word ends": normalised text is cut into words, each word's bytes
are written as printable letters, the last one marked as a word's end, and the best-ranked pair is merged until none is
left. Two neighbouring bytes that stand side by side in no vocabulary token can never be joined, so between them lies a
certain cut: the fragments on both sides are encoded apart (merging in the library's model, n log n steps) and put
together again. Words and fragments come back often, so each task keeps those it has seen, within a bound.

Texts of ASCII or Latin letters are normalised and split here, others by the file's own parts.

Defined cases: a null or empty text, or one of white space alone, has no ids and decodes to "". Texts of any length are
encoded whole. Equal rows give equal results; other columns are kept.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer, models

from docsynth.llm.arrays import map_text

#: Words kept by a task, twice at most: about 170 bytes each.
KEPT = 150_000

# Fixed values of the file format: words as the pre-tokenizer splits them, letters for bytes.
_ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"
_ASCII = re.compile(rf"[a-z]+|[0-9]|{_ENDINGS}|[^\t-\r a-z0-9]+")
#: For texts without a character above U+024F, where the letters are what ``\w`` has besides these digits and "_".
_DIGITS = "0-9²³¹¼½¾"
_LATIN = re.compile(rf"[^\W_{_DIGITS}]+|[{_DIGITS}]|{_ENDINGS}|(?:[^\w\t-\r \x85\xa0]|_)+")
_ABOVE = re.compile("[ɐ-\U0010ffff]")
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]


def byte_letters() -> list[str]:
    """Letter for each byte: itself where printable, else the next free one from 256 on."""
    spare = iter(range(256, 512))
    shown = set(_PRINTABLE)
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class Kept(dict):
    """Two generations of computed values: when the young one is full it becomes the old one."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class Bpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str, kept: int = KEPT):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        library = Tokenizer.from_file(path)
        # The library's own tables of Unicode decide where Python's are of another version.
        self.normalise, self.split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self.end = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
        self.last_model = models.BPE(self.vocab, merges, end_of_word_suffix=self.end or None)
        self.inner_model = models.BPE(self.vocab, merges)
        self.code = {i: i.to_bytes(4, "little") for i in self.vocab.values()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.names = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        self.letter = byte_letters()
        self.table = {i: c for i, c in enumerate(self.letter)}
        side_by_side = set()
        for token in self.vocab:
            letters = token[: -len(self.end)] if self.end and token.endswith(self.end) else token
            side_by_side.update(map(add, letters, letters[1:]))
        self.side_by_side = side_by_side
        alphabet = "abcdefghijklmnopqrstuvwxyz"
        apart = [x + y for x in alphabet for y in alphabet if x + y not in side_by_side]
        self.apart = re.compile("|".join(apart) or "(?!)").search
        self.inner = Kept(lambda f: self.merge(f, self.inner_model), kept // 8)
        self.words = Kept(self.encode_word, kept)
        self.lettered = Kept(self.encode_letters, kept // 4)

    def cut(self, letters: str) -> list[str]:
        """Fragments between certain cuts; the last one carries the word's end."""
        if letters.isascii() and letters.isalpha() and not self.apart(letters):
            return [letters]
        known = self.side_by_side
        cuts = [i for i, pair in enumerate(map(add, letters, letters[1:]), 1) if pair not in known]
        if not cuts:
            return [letters]
        return [letters[a:b] for a, b in zip([0, *cuts], [*cuts, len(letters)], strict=True)]

    def merge(self, letters: str, model: models.BPE) -> bytes:
        """Ids of one fragment as little-endian 32-bit integers."""
        return b"".join([self.code[t.id] for t in model.tokenize(letters)])

    def encode_word(self, word: str) -> bytes:
        return self.encode_letters(word if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(self.table))

    def encode_letters(self, letters: str) -> bytes:
        """Ids of a word whose bytes are written as letters."""
        found = self.cut(letters)
        return b"".join([*map(self.inner.__getitem__, found[:-1]), self.merge(found[-1], self.last_model)])

    def plain(self, text: str) -> bytes:
        if text.isascii():
            return b"".join(map(self.words.__getitem__, _ASCII.findall(text.lower())))
        if not _ABOVE.search(text):
            text = unicodedata.normalize("NFC", text).lower()
            return b"".join(map(self.words.__getitem__, _LATIN.findall(text)))
        return b"".join([self.lettered[word] for word, _ in self.split(self.normalise(text))])

    def encode(self, text: str) -> bytes:
        """Ids of a text, 4 bytes each; added tokens are recognised in the raw text."""
        if self.split_special is None or "<|" not in text:
            return self.plain(text)
        return b"".join(self.special[t].to_bytes(4, "little") if t in self.special else self.plain(t) for t in self.split_special.split(text) if t)

    def decode(self, ids: bytes) -> str:
        """Without a decoder in the file, tokens stand side by side with one space between them."""
        return " ".join(map(self.names.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def loaded(path: str, kept: int = KEPT) -> Bpe:
    """One encoder for a worker process."""
    return Bpe(path, kept)


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", count: str = "n_tokens") -> DataFrame:
    """Adds the ids of each whole text (binary, little-endian unsigned 32-bit) and their number."""

    def work(col: pa.Array) -> list:
        bpe = loaded(path)
        made = [bpe.encode(t) for t in col.to_pylist()]
        return [pa.array(made, pa.binary()), np.fromiter((len(m) // 4 for m in made), np.int64, len(made))]

    return map_text(docs, text, [T.StructField(ids, T.BinaryType()), T.StructField(count, T.LongType())], work)


def encode_decode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", count: str = "n_tokens", decoded: str = "decoded", keep: bool = True) -> DataFrame:
    """As :func:`encode`, with the text that the ids decode to, in one pass over the texts."""

    def work(col: pa.Array) -> list:
        bpe = loaded(path)
        made = [bpe.encode(t) for t in col.to_pylist()]
        return [pa.array(made, pa.binary()), np.fromiter((len(m) // 4 for m in made), np.int64, len(made)), [bpe.decode(m) for m in made]]

    fields = [T.StructField(ids, T.BinaryType()), T.StructField(count, T.LongType()), T.StructField(decoded, T.StringType())]
    return map_text(docs, text, fields, work, keep)


def decode(coded: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Adds the text of stored ids."""

    @F.pandas_udf(T.StringType())
    def back(col):
        bpe = loaded(path)
        return col.map(lambda m: bpe.decode(m) if m is not None else "")

    return coded.withColumn(decoded, back(ids))


def digest(docs: DataFrame, path: str) -> DataFrame:
    """One row per document: number of ids and digests of the ids and of the decoded text."""
    made = encode_decode(docs.select("doc_id", "text"), path, keep=False)
    return made.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


__all__ = ["Bpe", "decode", "digest", "encode", "encode_decode", "loaded"]
