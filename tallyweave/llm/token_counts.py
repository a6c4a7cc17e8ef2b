"""Token counts of whole texts by merging alone: no identifier is made.

A text begins as its characters. The best adjacent pair merges again and again;
the tokens are the initial symbols minus the merges, where a character that the
vocabulary lacks counts as its bytes.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import pairwise

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import whole_text
from .merging import merge_pairs

SPACE = "▁"  # what the model writes for a space
MAX_TOKENS = 4096
CACHED_FRAGMENTS = 400_000  # counts that a task remembers; then it starts afresh
CACHED_CHARS = 48  # longer fragments are counted each time


class PieceCounter(dict):
    """Counts by fragment for a sentencepiece BPE model with byte fallback.

    Fragments end where no piece goes on, as the vocabulary shows: before a
    space sign that follows anything else, around line ends, and between a
    letter or digit and a mark, but for the few that some piece has together.
    """

    def __init__(self, model: str):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=model)
        kinds = (pieces.is_control, pieces.is_unknown, pieces.is_byte, pieces.is_unused)
        self.ranks = {
            pieces.id_to_piece(i): -pieces.get_score(i)
            for i in range(pieces.get_piece_size()) if not any(kind(i) for kind in kinds)
        }
        pairs = {pair for piece in self.ranks for pair in pairwise(piece)}
        if any(b == SPACE != a or "\n" in (a, b) for a, b in pairs):
            pattern = "(?s:.+)"
        else:
            marks = {c for piece in self.ranks for c in piece if not c.isalnum()} - {SPACE, "\n"}
            going_on = {a for a, b in pairs if b in marks and a not in marks | {SPACE}}
            own, onward = ("".join(map(re.escape, sorted(chars))) for chars in (marks, going_on))
            rest = f"[^{SPACE}\n{own}]"
            more = f"(?:(?<=[{onward}])[{own}]+{rest}*)*" if onward else ""
            pattern = f"{SPACE}*{rest}+{more}|{SPACE}+|\n"
            if marks:
                pattern = f"{SPACE}*[{own}]+{rest}*{more}|{pattern}"
        self.fragments = re.compile(pattern).findall

    def __missing__(self, fragment: str) -> int:
        ranks = self.ranks
        count = sum(
            1 if symbol in ranks else len(symbol.encode("utf-8", "surrogatepass"))
            for symbol in merge_pairs([*fragment], ranks)
        )
        if len(fragment) <= CACHED_CHARS:
            self[fragment] = count
        return count

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if len(self) > CACHED_FRAGMENTS:
            self.clear()
        return sum(map(self.__getitem__, self.fragments(SPACE + text.replace(" ", SPACE))))


@lru_cache(maxsize=2)
def piece_counter(model: str) -> PieceCounter:
    return PieceCounter(model)


def token_counts(docs: DataFrame, model: str, limit: int = MAX_TOKENS) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit for every row of `docs`.

    `model` is the path of the vocabulary file on every machine. Tokens are
    those of the whole text without begin or end; special strings in a text
    are ordinary text. NULL counts as empty: 0 bytes, 0 tokens. Rows stay as
    they are, repeated ones and NULL ids too; other columns are not looked at.
    """

    @F.pandas_udf(T.LongType())
    def counted(texts: pd.Series) -> pd.Series:
        count = piece_counter(model).count
        return pd.Series([count(text) for text in texts], dtype="int64")

    text = whole_text("text")
    return docs.select(
        "doc_id", F.octet_length(text).cast("long").alias("n_bytes"), counted(text).alias("n_tokens")
    ).withColumn("over_limit", F.col("n_tokens") > limit)
