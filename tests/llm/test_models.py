"""Operators 2 and 7: held-out accuracy, and parts against plain computing."""

import math
import random
import zlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest

from tarnish.llm.language import Pieces, expected, fit, forward, predict_language, train_language
from tarnish.llm.quality import NGRAMS, features, keep_good, score_quality, train, train_quality

SF = "/root/testdata/sf0.01"
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def rank_sum(labels, scores):
    order = np.argsort(scores)
    rank = np.empty(len(scores))
    rank[order] = np.arange(len(scores))
    good = np.array(labels) == 1
    n = good.sum()
    return (rank[good].sum() - n * (n - 1) / 2) / (n * (~good).sum())


def test_features_count_words_pairs_and_ngrams():
    texts = ["ab cd ab", "", None, " x ", "é\nab"]
    feature, owner = features(texts)
    for i, t in enumerate(texts):
        words = (t or "").split()
        grams = sum(max(0, len(t or "") - k + 1) for k in NGRAMS)
        assert (owner == i).sum() == len(words) + max(0, len(words) - 1) + grams
    # The same word has the same feature wherever it stands.
    alone = set(features(["ab"], ())[0].tolist())
    assert alone <= set(features(["x ab"], ())[0].tolist()) & set(features(["y  ab z"], ())[0].tolist())


def test_features_do_not_depend_on_neighbours():
    r = random.Random(3)
    texts = ["".join(r.choice("ab é\n") for _ in range(r.randint(0, 30))) for _ in range(50)]
    feature, owner = features(texts)
    for i, t in enumerate(texts):
        assert sorted(feature[owner == i].tolist()) == sorted(features([t])[0].tolist())


def test_scores_are_the_softmax_of_the_mean_vector():
    rows = [(*np.unique(features([t])[0], return_counts=True), y) for t, y in (("good words here", 1), ("### $$$ ###", 0))] * 20
    model = train(rows, epochs=20)
    good, bad, none = model.scores(["good words", "$$$ ###", ""])
    assert good > 0.5 > bad and 0 < none < 1
    feature, _ = features(["good words"])
    assert math.isclose(good, 1 / (1 + math.exp(-(model.weights[feature].mean() + model.offset))), rel_tol=1e-9)


def test_quality_on_the_held_out_fold(spark, odd, odd_rows, empty):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = train_quality(docs, labels)
    scores = {r.doc_id: r.score for r in score_quality(docs, model).collect()}
    assert len(scores) == docs.count() and all(0 <= s <= 1 for s in scores.values())
    held = [(r.quality, scores[r.doc_id]) for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert rank_sum(*zip(*held, strict=True)) > 0.9
    kept = keep_good(docs, model)
    assert kept.schema == docs.schema and {r.doc_id for r in kept.collect()} == {d for d, s in scores.items() if s >= 0.5}
    assert score_quality(odd, model).count() == len(odd_rows) and score_quality(empty, model).collect() == []
    # Nothing to learn from.
    none = train_quality(docs, labels.limit(0))
    assert {r.score for r in score_quality(odd, none).collect()} == {0.5}


def test_labels_of_the_held_out_fold_are_not_learned(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    other = labels.selectExpr("doc_id", "CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 3 = 1 THEN 1 - quality ELSE quality END AS quality")
    assert (train_quality(docs, labels).weights == train_quality(docs, other).weights).all()


@pytest.fixture(scope="module")
def pieces():
    return Pieces(PIECES)


def test_forward_sums_all_segmentations(pieces):
    odds = np.random.default_rng(1).random((len(pieces.pieces) + 1, 2))
    words = ["the", "straße", "qéz", "a", "internationally"]
    sizes, grid = pieces.lattice(words)
    alpha = forward(sizes, grid, odds)
    for k, w in enumerate(words):
        w = "▁" + w

        @lru_cache(None)
        def total(i, w=w):
            if i == len(w):
                return np.ones(2)
            out = np.zeros(2)
            for j in range(i + 1, len(w) + 1):
                p = pieces.number.get(w[i:j], pieces.other if j == i + 1 else None)
                if p is not None:
                    out = out + odds[p] * total(j)
            return out

        assert np.allclose(alpha[sizes[k], k], total(0))


def test_expected_pieces_spell_the_words(pieces):
    odds = np.random.default_rng(2).random((len(pieces.pieces) + 1, 1))
    words = ["reading", "ring"]
    sizes, grid = pieces.lattice(words)
    used = expected(sizes, grid, odds, np.array([[3.0], [2.0]]))
    length = np.array([len(p) for p in pieces.pieces] + [1])
    assert math.isclose((used[:, 0] * length).sum(), 3 * 8 + 2 * 5)


def test_languages(spark, docs_of, odd, odd_rows, empty):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = train_language(docs, PIECES, docs_per_lang=60)
    got = {r.doc_id: r for r in predict_language(docs, model).collect()}
    held = [(r.lang, got[r.doc_id].lang_pred) for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert sum(a == b for a, b in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())
    rows = {r.doc_id: r for r in predict_language(odd, model).collect()}
    assert rows[1].lang_pred == rows[3].lang_pred == "und" and predict_language(odd, model).count() == len(odd_rows)
    some = docs_of([(1, "123 456 !?"), (2, "²³ ½"), (3, "12a"), (4, "z" * 5000)])
    found = {r.doc_id: r.lang_pred for r in predict_language(some, model).collect()}
    assert found[1] == found[2] == "und" and found[3] != "und" and found[4] != "und"
    assert predict_language(empty, model).collect() == []
    nothing = train_language(empty, PIECES)
    assert {r.lang_pred for r in predict_language(odd, nothing).collect()} == {"und"}


def test_fit_prefers_the_words_it_saw():
    model = fit(PIECES, {("en", "the"): 50, ("en", "thing"): 10, ("de", "der"): 50, ("de", "ding"): 10}, {"en": 1, "de": 1})
    assert model.predict(["the thing the", "der ding der", None])[0] == ["en", "de", "und"]
