"""The quality classifier: its parts, its accuracy on rows it never saw, and its edge cases."""

import zlib

import numpy as np
import pytest

from blockpulse.llm import nb_svm
from blockpulse.llm.queries import QUERIES


def test_ngrams():
    maker = nb_svm.NGrams()
    assert len(maker.of("")) == 0 and len(maker.of("a")) == 1 and len(maker.of("abab")) == 2 + 2 + 2
    plain, runs = set(maker.of("de de x")), set(maker.of("de de de x"))
    assert (1 << nb_svm.HASH_BITS) + 3 in runs - plain
    long = "abc " * 700_000
    assert set(maker.of(long)) >= set(maker.of("abc abc"))


def test_descent_satisfies_the_optimality_conditions(monkeypatch):
    monkeypatch.setattr(nb_svm, "PASSES", 2000)
    monkeypatch.setattr(nb_svm, "COST", 1.0)
    rng = np.random.default_rng(1)
    rows = [np.sort(rng.choice(30, 5, replace=False)) for _ in range(60)]
    sign = np.array([1.0 if 3 in r or rng.random() < 0.3 else -1.0 for r in rows])
    values = [np.full(5, 5**-0.5) for _ in rows]
    weights, bias = nb_svm.dual_coordinate_descent(rows, values, sign)

    def loss(w, b):
        return 0.5 * (w @ w + b * b) + sum(max(0, 1 - s * (w[r] @ v + b)) for r, v, s in zip(rows, values, sign))

    best = loss(weights, bias)
    for _ in range(300):
        step = np.zeros(nb_svm.FEATURES)
        step[:30] = rng.normal(size=30) * 0.02
        assert loss(weights + step, bias + rng.normal() * 0.02) >= best - 1e-3


def test_query_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in QUERIES["op6_nb_svm_quality"](spark, sf).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for i, r in rows.items())
    unseen = [(rows[i].predicted, q) for i, q in labels.items() if rows[i].held_out]
    assert sum(p == q for p, q in unseen) >= 0.97 * len(unseen)


def test_reruns_agree(spark, sf):
    one, two = ({r.doc_id: r.score for r in QUERIES["op6_nb_svm_quality"](spark, sf).collect()} for _ in range(2))
    assert one == two


def test_edge_rows(spark):
    docs = spark.createDataFrame(
        [(i, "good words here" if i % 2 else "BAD!! BAD!!", 1) for i in range(200)] + [(None, None, 0), (1, "good words here", 0), (900, "", 0), (901, "x" * 3_000_000, 0)],
        "doc_id long, text string, quality int",
    )
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(150)] + [(None, 1, 0), (7, None, 0), (8, 1, 0), (9, 5, 0)], "doc_id long, quality int, text int")
    model = nb_svm.train(docs, labels)
    scored = nb_svm.score_documents(docs, model).collect()
    assert len(scored) == 204 and all(0 <= r.score <= 1 for r in scored)
    by_id = {r.id: r.score for r in scored}
    assert by_id[199] > 0.5 > by_id[198]
    kept = nb_svm.keep_good(docs, model)
    assert kept.columns == docs.columns and kept.where("text = 'good words here'").count() == 101 and kept.where("text LIKE 'BAD%'").count() == 0
    empty = docs.where("doc_id > 5000")
    assert nb_svm.score_documents(empty, model).collect() == [] and nb_svm.keep_good(empty, model).collect() == []


@pytest.mark.parametrize("share, low, high", [([1] * 20, 0.9, 1.0), ([], 0.5, 0.5), ([0] * 20, 0.0, 0.1)])
def test_one_class(spark, share, low, high):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(30)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, q in enumerate(share)], "doc_id long, quality int")
    model = nb_svm.train(docs, labels)
    assert all(low <= r.score <= high for r in nb_svm.score_documents(docs, model).collect())


def test_descent_matches_a_plain_solver(monkeypatch):
    """The same dual, solved by projected gradient steps on a dense matrix, gives the same margins."""
    monkeypatch.setattr(nb_svm, "PASSES", 3000)
    rng = np.random.default_rng(6)
    rows = [np.sort(rng.choice(40, 6, replace=False)) for _ in range(80)]
    sign = np.array([1.0 if (3 in r) != (rng.random() < 0.1) else -1.0 for r in rows])
    values = [np.full(6, 6**-0.5) for _ in rows]
    weights, bias = nb_svm.dual_coordinate_descent(rows, values, sign)
    dense = np.zeros((80, 41))
    dense[:, 40] = 1  # the constant is a weight like the others
    for i, (r, v) in enumerate(zip(rows, values)):
        dense[i, r] = v
    signed = dense * sign[:, None]
    inner, duals = signed @ signed.T, np.zeros(80)
    step = 1 / np.linalg.eigvalsh(inner).max()
    for _ in range(200_000):
        duals = np.clip(duals + step * (1 - inner @ duals), 0, nb_svm.COST)
    want = dense @ (signed.T @ duals)
    got = np.array([weights[r] @ v + bias for r, v in zip(rows, values)])
    assert np.abs(got - want).max() < 0.02


def test_score_of_very_long_texts_and_the_threshold(spark):
    """Scores of whole texts against the model applied directly, and a tie at the threshold stays."""
    rng = np.random.default_rng(2)
    docs = [(i, " ".join(rng.choice(["good", "words", "junk", "!!", "zz"], 12))) for i in range(80)] + [(90, "good words " * 200_000), (91, "junk !! " * 200_000)]
    labels = [(i, int("good" in t)) for i, t in docs[:80]]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    model = nb_svm.train(df, spark.createDataFrame(labels, "doc_id long, quality int"))
    maker, got = nb_svm.NGrams(), {r.id: r.score for r in nb_svm.score_documents(df, model).collect()}
    for i, text in docs:
        grams = maker.of(text)
        norm = np.sqrt(model.squares[grams].astype(float).sum()) or 1.0
        margin = model.weights[grams].astype(float).sum() / norm + model.bias
        assert got[i] == pytest.approx(1 / (1 + np.exp(-(model.slope * margin + model.offset))), abs=1e-5)
    at = sorted(got.values())[40]
    kept = {r.doc_id for r in nb_svm.keep_good(df, model, threshold=at).collect()}
    assert kept == {i for i, s in got.items() if s >= at}
