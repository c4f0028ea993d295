"""Streaming byte-pair encoding against the tokenizers library, and round trips."""

import hashlib
import random
import unicodedata

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from blockpulse.llm import stream_bpe
from blockpulse.llm.queries import QUERIES

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


@pytest.fixture(scope="module")
def table():
    with open(VOCABULARY, "rb") as file:
        return stream_bpe.MergeTable(file.read())


@pytest.fixture(scope="module")
def encoder(table):
    return stream_bpe.Encoder(table)


def agrees(library, encoder, table, text):
    want = library.encode(text, add_special_tokens=False).ids
    pieces = list(encoder.encode(text))
    assert np.frombuffer(b"".join(pieces), "<u4").tolist() == want
    decoder = stream_bpe.Decoder(table, spaced=True)
    assert "".join(map(decoder.feed, pieces)) + decoder.finish() == library.decode(want, skip_special_tokens=False)


FIXED = ["", " ", "'s", "it's 'S DON'T !!'s", "<|endoftext|>a<|startoftext|>'ll <|endoftext", "é́ 각", "ſtrange K İSTANBUL ΑΣ ΑΣ. ß",
         "\x1c\x1d!!\x85\xa0x", "a" * 5000, "the" * 30000, "ab" * 70000, "!'" * 70000, "'s" * 70000, "é" * 70001, "中文" * 50000, "한" * 70000, "x" * 200_000]


@pytest.mark.parametrize("text", FIXED, ids=range(len(FIXED)))
def test_fixed_texts(library, encoder, table, text):
    agrees(library, encoder, table, text)


@pytest.mark.parametrize("window", [263, 1 << 16])
def test_random_texts(library, encoder, table, monkeypatch, window):
    monkeypatch.setattr(stream_bpe, "WINDOW", window)
    rng = random.Random(window)
    parts = ["a", "th", "in", " ", "'", "s", "!", "é", "1", "Σ", "\n", "é", "ing", "re", "<|endoftext|>", "ᄀ", "ᅡ", "?", "ll"]
    wide = [c for c in map(chr, range(32, 0x2E80)) if unicodedata.category(c)[0] != "C" and not unicodedata.combining(c)]
    for _ in range(150):
        size = rng.choice([3, 30, 300, 3000])
        agrees(library, encoder, table, "".join(rng.choices(parts, k=size)))
        agrees(library, encoder, table, "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=size)))
        agrees(library, encoder, table, "".join(rng.choices(["!", "'", "s", "l", "re", "?", "."], k=size)))
        agrees(library, encoder, table, "".join(rng.choices(wide, k=size)))


def test_lookahead_settles_tokens(table):
    """Whatever follows, tokens that end a lookahead before the end of a word stay the same."""
    rng, reach = random.Random(2), table.lookahead()
    for _ in range(60):
        head = rng.choices(b"aehinorst", k=reach + 60)
        fixed = []
        for tail in (b"", b"s" * 9, bytes(rng.choices(b"aehinorst", k=40))):
            tokens, end, kept = stream_bpe.merge([table.inner[b] for b in bytes(head) + tail], table.rank), 0, []
            for token in tokens:
                end += table.size(token)
                if end > 60:
                    break
                kept.append(token)
            fixed.append(kept)
        assert fixed[0] == fixed[1] == fixed[2]


def test_text_round_trip(encoder, table):
    decoder = stream_bpe.Decoder(table)
    for text in ["the cat sat on 1 2 3 mats !", "déjà vu 中文 ✓", "x" * 100_000]:
        assert ("".join(map(decoder.feed, encoder.encode(text))) + decoder.finish()).strip() == text


def test_query(spark, sf, library):
    got = {r.doc_id: r for r in QUERIES["op4_stream_bpe"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for doc in docs:
        ids = library.encode(doc.text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert got[doc.doc_id].n_tokens == len(ids)
        assert got[doc.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[doc.doc_id].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_edge_rows(spark, library):
    rows = [(1, None, "a"), (2, "", None), (None, "Hi there", "x"), (3, "Hi there", "x"), (3, "Hi there", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = stream_bpe.encode_documents(df, VOCABULARY, with_text=True).collect()
    ids = library.encode("Hi there", add_special_tokens=False).ids
    assert sorted(((r.id, r.n_tokens, list(r.ids), r.decoded) for r in got), key=str) == sorted(
        [(1, 0, [], ""), (2, 0, [], ""), *[(i, 2, ids, "hi there ") for i in (None, 3, 3)]], key=str
    )
    assert stream_bpe.encode_documents(df.where("doc_id > 5"), VOCABULARY).collect() == []


def test_merging_a_word_looks_up_only_new_pairs(table):
    class Counting(dict):
        looked = 0

        def get(self, *args):
            self.looked += 1
            return super().get(*args)

    rank = Counting(table.rank)
    word = b"incomprehensibilities"
    ids = stream_bpe.merge([*(table.inner[b] for b in word[:-1]), table.final[word[-1]]], rank)
    merges = len(word) - len(ids)
    assert merges > 3 and 0 < rank.looked <= len(word) - 1 + 2 * merges
