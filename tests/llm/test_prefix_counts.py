"""Prefix token counts against the sentencepiece library."""

import random
import unicodedata

import public_tokenizers
import pytest
import sentencepiece

from blockpulse.llm import prefix_counts
from blockpulse.llm.queries import QUERIES

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def counter():
    with open(MODEL, "rb") as file:
        return prefix_counts.Counter(file.read())


def agrees(library, counter, text, every=False):
    counts = counter.counts(text)
    assert counts.total == counter.total(text) == len(library.encode(text))
    for n in range(len(text) + 1) if every else (0, 1, len(text) // 3, len(text) // 2, len(text)):
        assert counts.at(n) == len(library.encode(text[:n]))


FIXED = ["", " ", "  ", " a", "a ", "a   b", "▁a▁▁ b", "<s></s><unk>", "<0x0A>\n\t", "é́中文한ß😀", "\0a", "The cat sat.\nOn 12 mats!!"]
LONG = ["a" * 5000, "=" * 3000, " " * 3000, "aaa bbb" * 30_000, "the" * 30_000, "x²." * 100]


@pytest.mark.parametrize("text", FIXED, ids=range(len(FIXED)))
def test_every_prefix(library, counter, text):
    agrees(library, counter, text, every=True)


@pytest.mark.parametrize("text", LONG, ids=range(len(LONG)))
def test_long_texts(library, counter, text):
    agrees(library, counter, text)


@pytest.mark.parametrize("kept", [50, 400_000])
def test_random_texts(library, monkeypatch, kept):
    monkeypatch.setattr(prefix_counts, "KEPT_PREFIXES", kept)
    with open(MODEL, "rb") as file:
        counter = prefix_counts.Counter(file.read())
    rng = random.Random(kept)
    parts = ["a", "th", "in", " ", "  ", "'", "s", "!", "é", "1", "\n", "ing", "<s>", "=", "--", "The", "."]
    wide = [c for c in map(chr, range(32, 0xD7FF)) if unicodedata.category(c)[0] != "C"]
    for _ in range(200):
        size = rng.choice([3, 20, 80])
        agrees(library, counter, "".join(rng.choices(parts, k=size)), every=size < 30)
        agrees(library, counter, "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=size)))
        agrees(library, counter, "".join(rng.choices(wide, k=size)))


def test_budget(library, counter):
    text = "Counting the pieces of a text, one prefix after another, without encoding it again."
    counts = counter.counts(text)
    for budget in range(counts.total + 2):
        want = max(n for n in range(len(text) + 1) if len(library.encode(text[:n])) <= budget)
        assert counts.fitting(budget) == want


def test_query(spark, sf, library):
    got = {r.doc_id: r for r in QUERIES["op10_prefix_token_counts"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for doc in docs:
        tokens = len(library.encode(doc.text or ""))
        row = got[doc.doc_id]
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len((doc.text or "").encode()), tokens, tokens > 4096)
        assert row.kept_tokens == len(library.encode(doc.text[: row.kept_chars])) <= 4096
        assert row.kept_chars == len(doc.text) or tokens > 4096


def test_edge_rows(spark):
    rows = [(1, None, 4), (2, "", 4), (None, "Hi", 4), (3, "é!", 4), (3, "é!", 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens long")
    got = prefix_counts.count_documents(df, MODEL, budget=1).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted([(1, 0, 0, 0, 0), (2, 0, 0, 0, 0), (None, 2, 1, 2, 1), (3, 3, 2, 1, 1), (3, 3, 2, 1, 1)], key=str)
    assert prefix_counts.count_documents(df.where("doc_id > 5"), MODEL).collect() == []


def test_stored_counts_answer_every_budget(spark):
    texts = ["", None, " a  b", "The cat sat.\nOn 12 mats!! " * 30, "the" * 400, "x" * 50]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    counted = prefix_counts.count_documents(docs, MODEL, budget=9, store=True)
    beside = counted.join(docs.withColumnRenamed("doc_id", "id"), "id")
    for budget in (0, 1, 9, 40, 1000):
        want = prefix_counts.count_documents(docs, MODEL, budget=budget).select("id", "fitting_chars", "fitting_tokens").collect()
        assert sorted(prefix_counts.stored_budget(beside, MODEL, budget).collect()) == sorted(want)
