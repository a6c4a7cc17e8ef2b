"""Byte-pair encoding and decoding of whole texts, cut where no token can go on.

Two bytes that follow each other inside no token of the vocabulary mark a
certain cut: no merge ever spans it. So a word is cut there, its fragments are
encoded on their own and the tokens put together again.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from functools import lru_cache
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import whole_text
from .merging import merge_few, merge_pairs

CACHED_WORDS = 300_000  # encodings that a task remembers, and as many older ones
CACHED_CHARS = 48
FEW = 48  # symbols up to which merges are found by looking through all pairs

# How the vocabulary's files split texts into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"
LATIN_WORDS = (  # the same for lower-case text below U+0250
    r"'s|'t|'re|'ve|'m|'ll|'d|[a-zª\xb5º\xdf-\xf6\xf8-\u024f]+|[0-9\xb2\xb3\xb9\xbc-\xbe]"
    r"|[^\t-\r \x85\xa0a-zª\xb5º\xdf-\xf6\xf8-\u024f0-9\xb2\xb3\xb9\xbc-\xbe]+"
)
ASCII_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+"  # the same, in lower case


def byte_signs() -> list[str]:
    """The sign that stands for each byte: itself if it is visible, else one from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(byte if byte in visible else next(spare)) for byte in range(256)]


class WordCodec(dict):
    """Encodes words of a lower-casing BPE vocabulary whose words have an end mark."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        self.older: dict[str, tuple[int, ...]] = {}
        self.ids = model["vocab"]
        self.end = model["end_of_word_suffix"]
        merges = [m if isinstance(m, str) else " ".join(m) for m in model["merges"]]
        self.ranks = {pair: rank for rank, pair in enumerate(merges)}
        self.signs = byte_signs()
        self.inside = {
            a + b for token in self.ids for a, b in pairwise(token.removesuffix(self.end))
        }
        self.special = {token["content"]: token["id"] for token in content["added_tokens"]}
        self.marks = regex.compile("|".join(map(regex.escape, self.special)) or r"(?!)")
        self.words = regex.compile(WORDS).findall
        self.ascii_words = re.compile(ASCII_WORDS).findall
        self.latin_words = re.compile(LATIN_WORDS).findall
        self.beyond_latin = re.compile(r"[^\x00-\u024f]").search
        numbers = self.ids | self.special
        self.tokens = [""] * (max(numbers.values()) + 1)
        for token, number in numbers.items():
            self.tokens[number] = token

    def fragments(self, word: str) -> list[str]:
        """The signs of the word's bytes, cut at pairs that are inside no token."""
        signs = word.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.signs)
        inside = self.inside
        cuts = [at for at in range(1, len(signs)) if signs[at - 1:at + 1] not in inside]
        return [signs[a:b] for a, b in pairwise([0, *cuts, len(signs)])] if cuts else [signs]

    def __missing__(self, word: str) -> tuple[int, ...]:
        if (known := self.older.get(word)) is not None:
            self[word] = known
            return known
        found, ranks, ids = [], self.ranks, self.ids
        fragments = self.fragments(word)
        for at, fragment in enumerate(fragments, 1):
            symbols = [*fragment]
            if at == len(fragments):
                symbols[-1] += self.end
            merge = merge_few if len(symbols) <= FEW else merge_pairs
            found += [ids[s] for s in merge(symbols, ranks, " ") if s in ids]
        found = tuple(found)
        if len(word) <= CACHED_CHARS:
            self[word] = found
        return found

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        at = 0
        for mark in self.marks.finditer(text):
            out += self._plain(text[at:mark.start()])
            out.append(self.special[mark[0]])
            at = mark.end()
        return out + self._plain(text[at:]) if out else self._plain(text[at:])

    def _plain(self, text: str) -> list[int]:
        if len(self) > CACHED_WORDS:  # what has not been used since goes at the next time
            self.older = dict(self)
            self.clear()
        if text.isascii():
            words = self.ascii_words(text.lower())
        else:
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
            words = (self.words if self.beyond_latin(text) else self.latin_words)(text)
        return list(chain.from_iterable(map(self.__getitem__, words)))

    def decode(self, ids) -> str:
        return " ".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=2)
def word_codec(path: str) -> WordCodec:
    return WordCodec(path)


def encoded(text: Column, path: str) -> Column:
    """The token ids of a text, as an array of int; `path` is the vocabulary file."""

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def encode(texts: pa.Array) -> pa.Array:
        codec = word_codec(path)
        parts, ends = [], [0]
        for text in texts:
            ids = codec.encode(text.as_py() or "")
            parts.append(np.asarray(array("i", ids)))
            ends.append(ends[-1] + len(ids))
        values = np.concatenate(parts) if parts else np.empty(0, np.int32)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))

    return encode(text)


def decoded(ids: Column, path: str) -> Column:
    """The text that token ids stand for, special tokens included."""

    @F.arrow_udf(T.StringType())
    def decode(lists: pa.Array) -> pa.Array:
        codec = word_codec(path)
        every, ends = lists.values.to_numpy(), lists.offsets.to_pylist()
        return pa.array([codec.decode(every[a:b].tolist()) for a, b in pairwise(ends)], pa.string())

    return decode(ids)


def bpe_round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (array of int) and decoded text for every row of `docs`.

    NULL counts as empty and has no ids. Rows stay as they are, repeated ones
    and NULL ids too; other columns are not looked at.
    """
    ids = docs.select("doc_id", encoded(whole_text("text"), path).alias("ids"))
    return ids.select("doc_id", "ids", decoded(F.col("ids"), path).alias("decoded"))


def bpe_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256, from `bpe_round_trip`."""
    return bpe_round_trip(docs, path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
