"""The corpus pipeline stage by stage against direct versions of the decisions."""

import hashlib
import re
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
import corpus_pipeline
from blockpulse.llm import nb_svm
from test_secret_scan import slow_spans
from test_simhash import slow_components, slow_fingerprint
from test_source_mix import slow_mix


def test_stages(spark, tmp_path):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, frames = docs.columns, [docs]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, frames[-1], sf).write.parquet(f"{tmp_path}/{k}")
        frames.append(spark.read.parquet(f"{tmp_path}/{k}"))
        assert name == "tokens" or frames[-1].columns == columns
    start, good, single, clean, mixed, ids = [f.collect() for f in frames]

    model = nb_svm.train(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    maker = nb_svm.NGrams()
    assert {r.doc_id for r in good} == {r.doc_id for r in start if model.score(maker.of(r.text)) >= 0.3}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    kept = {r.doc_id for r in good}
    assert sum(i in kept for i, q in labels.items() if q == 1) >= 0.99 * sum(labels.values())
    assert sum(i in kept for i, q in labels.items() if q == 0) <= 0.05 * sum(q == 0 for q in labels.values())

    prints = {r.doc_id: slow_fingerprint(r.text) for r in good}
    roots, smallest = slow_components(sorted(set(prints.values()))), {}
    for i, p in prints.items():
        smallest[roots[p]] = min(i, smallest.get(roots[p], i))
    assert sorted(r.doc_id for r in single) == sorted(smallest.values())

    texts = {r.doc_id: r.text for r in single}
    assert {r.doc_id for r in clean} == set(texts) and len(clean) == len(single)
    for r in clean:
        assert r.n_chars == len(r.text) and not slow_spans(r.text)
        assert slow_spans(texts[r.doc_id]) or r.text == texts[r.doc_id]

    want = {i: copies for i, _, _, _, copies, _ in slow_mix([(r.doc_id, r.text, r.source) for r in clean]) if copies}
    assert Counter(r.doc_id for r in mixed) == want

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    by_id = {r.doc_id: r.text for r in mixed}
    assert Counter(r.doc_id for r in ids) == want
    for r in ids:
        expected = library.encode(by_id[r.doc_id], add_special_tokens=False).ids
        assert r.ids == expected and r.n_tokens == len(expected)
        assert r.ids_sha256 == hashlib.sha256(np.array(expected, "<u4").tobytes()).hexdigest()


def test_run_equals_its_stages(spark, sf):
    first, second = (sorted((r.doc_id, r.ids_sha256) for r in entry_points.queries()["pipeline"](spark, sf).collect()) for _ in range(2))
    assert first == second and first


def test_edge_rows(spark, tmp_path):
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0), (2, "token=abcdef and more words here", "en", None, 31), (3, "w " * 50_000, None, "b", 100_000)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in found} <= {None, 1, 2, 3} and all(r.n_tokens == len(r.ids) for r in found)


def test_stages_keep_whole_rows_of_repeated_ids(spark, tmp_path):
    """Rows go through the filtering stages whole: repeated ids, clashing column names, whole rows compared."""
    good = " ".join(f"word{k} tells of things" for k in range(40))
    more = " ".join(f"other{k} says it plainly" for k in range(40))
    third = " ".join(f"third{k} goes on and on" for k in range(40))
    names = "doc_id long, text string, lang string, source string, n_chars long, _rows long, _kept string, _row int, hash long, copies int, id long, fp long, mark string"

    def row(i, text, lang="en", source="a"):
        return (i, text, lang, source, len(text or ""), 1, "k", 2, 3, 4, 5, 6, "m")

    rows = [row(5, good), row(5, more), row(3, third), row(5, third), row(8, "short text here"), row(8, "short text here"), row(None, "no id in this row"), row(None, None), row(4, "")]
    docs = spark.createDataFrame(rows, names)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    first = stages["quality"](spark, docs, str(tmp_path))
    assert sorted(map(str, first.collect())) == sorted(map(str, docs.collect()))  # without labels nothing is rejected
    single = stages["near_duplicates"](spark, docs, str(tmp_path))
    # NULL and empty texts are one class; the row with an id stays.
    want = [rows[0], rows[1], rows[2], rows[4], rows[6], rows[8]]
    assert sorted((tuple(r) for r in single.collect()), key=str) == sorted(want, key=str) and single.columns == docs.columns
    clean = stages["secrets"](spark, single, str(tmp_path))
    assert sorted((tuple(r) for r in clean.collect()), key=str) == sorted(want, key=str) and clean.columns == docs.columns
    mixed = stages["mix"](spark, clean, str(tmp_path)).collect()
    taken = slow_mix([(r[0], r[1], r[3]) for r in want])
    assert Counter(r.doc_id for r in mixed) == Counter({i: n for i, n in _summed(taken).items() if n}) and {tuple(r) for r in mixed} <= set(want)


def _summed(taken):
    out = Counter()
    for i, _, _, _, copies, _ in taken:
        out[i] += copies
    return out


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_no_import_errors_are_swallowed():
    assert not re.search(r"except\s+(ImportError|ModuleNotFoundError|Exception)", open(corpus_pipeline.__file__).read())
