import itertools
import random
import unicodedata
import zlib

import numpy as np
import pytest

from thalweg.llm import packing
from thalweg.llm.registry import tokenizer_path

R = random.Random(4)
TEXTS = [
    None, "", " \n", "Hello, World!", "it's été É İ ﬁ ẞ Σας", "a b c\u0085d᠎e", "x\x1cy\x1dz \x1f", "<|endoftext|> a<|startoftext|>b",
    "日本語 テキスト 123 ½²", "🙂🙂 ok‍", "word*** " * 40, "no" * 300 + " end", "Tab\tsep\r\nline  two", "don't we'll I'd THEY'RE 'S x's'", "ab́ ́c",
]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def test_encoder(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 10)
    monkeypatch.setattr(packing, "STEP", 50)
    own = packing.Encoder(tokenizer_path())
    texts = TEXTS + [" ".join(R.choice(["Ab", "cde,", "Über", "naïve.", "x1y2", "é***", "...", "it's!", "s'", "a|b||", "<|endoftext|>.", "½#", "e\u0301,", "日本&"]) for _ in range(60)) for _ in range(30)]
    for text in texts + texts[::-1]:
        assert np.frombuffer(own.encode(text or ""), own.kind).tolist() == ids_of(tokenizer, text)[:-1], text
    together = own.encode_all([t or "" for t in texts])
    assert [np.frombuffer(c, own.kind).tolist() for c in together] == [ids_of(tokenizer, t)[:-1] for t in texts]


def test_letters_before_punctuation(tokenizer):
    """Letters that the tokenizer takes apart may join what follows them; all of those, and a part of the others."""
    letters = [chr(i) for i in range(0x80, 0x30000) if chr(i).isalnum()]
    odd = [c for c in letters if unicodedata.normalize("NFC", c) != c or len(c.lower()) > 1]
    marks = packing._ENDS
    texts = [f"{c}{m} a{c}{m}{m}" for c in odd if not 0xF900 <= ord(c) <= 0xFAFF for m in marks]
    texts += [f"{c}{marks[i % len(marks)]} {c}" for i, c in enumerate(letters) if i % 11 == 0 or 0xF900 <= ord(c) <= 0xFAFF]
    own = packing.Encoder(tokenizer_path())
    assert own.encode("\u0130.") == np.array(tokenizer.encode("\u0130.", add_special_tokens=False).ids, own.kind).tobytes()
    for text, coded in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(own.encode(text), own.kind).tolist() == coded.ids, text


def test_added_tokens_in_capitals(tokenizer):
    """Only the written form of an added token is one; other texts of the same batch are lower-cased and parted as ever."""
    texts = ["a <|ENDOFTEXT|> b", "<|StartOfText|>x.<|startoftext|>", "<|endoftext|>.A,<|Endoftext|", "The end. The end, THE END"]
    own = packing.Encoder(tokenizer_path())
    assert [np.frombuffer(c, own.kind).tolist() for c in own.encode_all(texts)] == [ids_of(tokenizer, t)[:-1] for t in texts]


def test_chunks_are_learned_once(tokenizer):
    """A word is one chunk whatever its capitals and the punctuation after it."""
    own = packing.Encoder(tokenizer_path())
    text = "The cat, the CAT. cat; (the) cat.the"
    assert np.frombuffer(own.encode(text), own.kind).tolist() == ids_of(tokenizer, text)[:-1]
    assert set(own.new) == {"the", "cat", ",", ".", ";", "(the)"}


def test_chunks_at_random(tokenizer):
    pieces = [*"aZs9é'İΣ.,;:|#-<>=\u0301\u0338\u0307 \t\n\x0b\x0c\r\x1c\x85\xa0\u3000", "'s", "'RE", "H\u0331", "<|endoftext|>", "<|EndOfText|>", " ", " "]
    texts = ["".join(R.choices(pieces, k=R.randrange(12))) for _ in range(5000)]
    own = packing.Encoder(tokenizer_path())
    for text, coded, ids in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False), own.encode_all(texts)):
        assert np.frombuffer(ids, own.kind).tolist() == coded.ids, repr(text)


def test_hilbert(monkeypatch):
    monkeypatch.setattr(packing, "BITS", 2)
    cells = np.array(list(itertools.product(range(4), repeat=4)), np.int64)
    place = packing.hilbert(cells)
    assert sorted(place.tolist()) == list(range(256))
    walk = cells[np.argsort(place)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("part", [4_000_000, 3000])
def test_pack(spark, tokenizer, part, monkeypatch):
    monkeypatch.setattr(packing, "PART_TOKENS", part)
    docs = [(i, t, "c") for i, t in enumerate(TEXTS)] + [(100 + i, "same text here " * 30, "c") for i in range(60)]
    docs += [(200 + i, " ".join(R.choice(["alpha", "beta", "gamma"]) for _ in range(R.randrange(1, 400))), None) for i in range(60)] + [(300, "long " * 9000, ""), (None, "x", "")]
    df = spark.createDataFrame(docs, "doc_id long, text string, place string")
    got = sorted((r for r in packing.pack(df, tokenizer_path()).collect()), key=lambda r: (r.sequence_id, r.offset))
    by_doc: dict = {}
    at = {}
    for r in got:
        assert r.offset == at.get(r.sequence_id, 0)
        at[r.sequence_id] = r.offset + r.length
        by_doc.setdefault(r.doc_id, []).append(r)
    assert sorted(at) == list(range(len(at))) and all(n == 2048 for s, n in at.items() if s != len(at) - 1)
    for doc_id, text, _ in docs:
        ids, start = np.array(ids_of(tokenizer, text), "<u4"), 0
        for r in sorted(by_doc[doc_id], key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids[start : start + r.length].tobytes()))
            start += r.length
        assert start == len(ids)
    assert len(by_doc) == len(docs)


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b")], "doc_id long, text string")
    assert sorted((r.offset, r.length) for r in packing.pack(df, tokenizer_path()).collect()) == [(0, 2), (2, 2), (4, 2)]
    assert packing.pack(df.limit(0), tokenizer_path()).count() == 0
