"""Token counts and byte-pair encoding against the public libraries."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from conftest import rows
from tallyweave.llm.bpe import WordCodec, bpe_digests, bpe_round_trip
from tallyweave.llm.merging import merge_few, merge_pairs
from tallyweave.llm.token_counts import PieceCounter, token_counts

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, n_tokens string, ids long"
TEXTS = [
    None, "", " ", "  a  b ", "\n\n", "a\x00b", "▁▁x", "<s>hi</s><unk><0x0A>", "m².x² e.g. ...);",
    "日本語ゔ𝔘", "it's DON'T we'll", "<|startoftext|> a<|endoftext|><|endoftext|>b", "ΣΑΣ ΟΔΟΣ İstanbul",
    "café naïve", "\x1c\x85᠎​ x", "½Ⅷ٣ 12 345", "a" * 20_000, "ab! " * 30_000, "!?" * 5_000,
]


def noise(count):
    pick = random.Random(8)
    pool = [chr(c) for c in [*range(0, 0x180), *range(32, 127), *range(0x370, 0x3FF),
                             *range(0x2000, 0x2070), 0x3000, 0x301, 0x4E00, 0x1F600, 0xAC00, 0xFB01]]
    return ["".join(pick.choices(pool, k=pick.randint(0, 30))) for _ in range(count)]


def plain_merges(symbols, ranks):
    symbols = [*symbols]
    while True:
        found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a + b in ranks]
        if not found:
            return symbols
        at = min(found)[1]
        symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]


def test_merging():
    pick = random.Random(9)
    parts = ["a", "b", "c", "ab", "bc", "abc", "aa", "aaa", "ca", "cab"]
    ranks = {part: pick.randint(0, 5) for part in parts}
    for _ in range(500):
        symbols = pick.choices("abcd", k=pick.randint(0, 20))
        assert merge_pairs(symbols, ranks) == plain_merges(symbols, ranks)
        assert merge_few(symbols, ranks) == plain_merges(symbols, ranks)


@pytest.mark.parametrize("kind", ["given", "noise"])
def test_equal_to_the_libraries(kind):
    texts = [text or "" for text in TEXTS] if kind == "given" else noise(3000)
    pieces = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    words = Tokenizer.from_file(WORDS)
    counter, codec = PieceCounter(PIECES), WordCodec(WORDS)
    for text in texts:
        assert counter.count(text) == len(pieces.encode(text)), repr(text[:80])
        ids = codec.encode(text)
        assert ids == words.encode(text, add_special_tokens=False).ids, repr(text[:80])
        assert codec.decode(ids) == words.decode(ids, skip_special_tokens=False)


def test_cuts_are_inside_no_token():
    codec = WordCodec(WORDS)
    assert codec.fragments("hello") == ["hello"]
    assert "".join(codec.fragments("日本語")) == "".join(codec.signs[b] for b in "日本語".encode())
    assert len(codec.fragments("日本語日本語ゔゔ")) > 1


def data():
    return [*((i, text, "x", i) for i, text in enumerate(TEXTS)), (None, "a b", None, None), (3, "  a  b ", "x", 3)]


def test_counts(spark):
    pieces = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    expected = []
    for doc_id, text, *_ in data():
        n = len(pieces.encode(text or ""))
        expected.append((doc_id, len((text or "").encode()), n, n > 4096))
    got = token_counts(spark.createDataFrame(data(), SCHEMA), PIECES)
    assert rows(got) == sorted(expected, key=lambda r: tuple(map(str, r)))


def test_round_trip(spark):
    words = Tokenizer.from_file(WORDS)
    df = spark.createDataFrame(data(), SCHEMA)
    expected, digests = [], []
    for doc_id, text, *_ in data():
        ids = words.encode(text or "", add_special_tokens=False).ids
        back = words.decode(ids, skip_special_tokens=False)
        expected.append((doc_id, ids, back))
        sha = [hashlib.sha256(s.encode()).hexdigest() for s in (" ".join(map(str, ids)), back)]
        digests.append((doc_id, len(ids), *sha))
    assert rows(bpe_round_trip(df, WORDS)) == sorted(expected, key=lambda r: tuple(map(str, r)))
    assert rows(bpe_digests(df, WORDS)) == sorted(digests, key=lambda r: tuple(map(str, r)))


def test_no_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert token_counts(df, PIECES).count() == 0
    assert bpe_digests(df, WORDS).count() == 0
