"""Cross-entropy differences against brute force over whole tables, heavy keys or not."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from llm import lm_scoring
from test_operators import documents, labels, none  # noqa: F401

SF = "/root/testdata/sf0.001"


def folded(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    return [re.sub(rb"\xc3[\x80-\x96\x98-\x9e]", lambda m: m[0][:1] + bytes([m[0][1] | 32]), w.lower()) for w in words]


def slow_scores(rows, good, s=lm_scoring.Settings()):
    """(n_tokens, target loss, background loss) of each (id, text): every token by its formula."""

    counted = [(i is not None and i in good, folded(text)) for i, text in rows]

    def keys_of(words):
        events = [*words, None] if words else []
        return events, list(zip([None, *events], events))

    models = [Counter(), Counter()]
    sizes = [0, 0]
    for mine, words in counted:
        for model, taken in ((0, mine), (1, True)):
            if taken:
                events, pairs = keys_of(words)
                models[model].update(events)
                models[model].update(pairs)
                sizes[model] += len(words)
    scale = sizes[0] / max(1, sizes[1])
    for mine, words in counted:
        events, pairs = keys_of(words)
        own = Counter(events) + Counter(pairs)
        losses = []
        for model in (0, 1):
            removed = model == 1 or mine
            times = scale if model else 1

            def log(key):
                left = models[model][key] - (own[key] if removed else 0)
                return math.log(left * times + (s.pseudo_pairs if isinstance(key, tuple) else s.pseudo_words))

            size = math.log(max(0, sizes[model] - (len(words) if removed else 0)) * times + 1)
            total = 0.0
            for event, pair in zip(events, pairs):
                bigram = (size - log(pair)) - (size - log(pair[0]))
                total += s.unigram * (size - log(event)) + (1 - s.unigram) * bigram
            losses.append(total / len(events) if events else 0.0)
        yield len(words), *losses


def assert_scored(found, rows, good, settings=lm_scoring.Settings()):
    got = sorted((str(r.doc_id), r.n_tokens, r.target_loss, r.background_loss, r.score) for r in found.collect())
    expected = sorted((str(i), *score) for (i, _), score in zip(rows, slow_scores(rows, good, settings)))
    assert len(got) == len(expected)
    for a, b in zip(got, expected):
        assert a[:2] == b[:2]
        assert np.allclose(a[2:4], b[2:4], rtol=1e-5, atol=1e-5), (a, b)
        assert abs(a[4] - (a[2] - a[3])) < 1e-9


@pytest.mark.parametrize("heavy, bucket, summary", [(2e-6, 4_000_000, 1 << 18), (0.01, 700, 64), (2.0, 9_000, 4)])
def test_whole_table_against_brute_force(spark, heavy, bucket, summary):
    """All keys broadcast, few of them, and none; one bucket or many."""

    settings = lm_scoring.Settings(heavy=heavy, bucket=bucket, summary=summary, filter_bits=128)
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(3)
    marks = spark.read.parquet(f"{SF}/labels.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    good = {r.doc_id for r in marks.where("quality = 1").collect()}
    assert_scored(lm_scoring.score_documents(lm_scoring.fit_models(docs, marks, settings=settings)), rows, good, settings)


def test_odd_rows(spark, documents, labels):  # noqa: F811
    found = lm_scoring.score_documents(lm_scoring.fit_models(documents, labels))
    assert found.columns == ["doc_id", "n_tokens", "target_loss", "background_loss", "score"]
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert_scored(found, rows, {1, 2, 6})
    empty = {r.doc_id: r for r in found.collect()}[4]
    assert (empty.n_tokens, empty.score) == (0, 0.0)
    assert lm_scoring.score_documents(lm_scoring.fit_models(none(documents), none(labels))).count() == 0
    assert lm_scoring.score_documents(lm_scoring.fit_models(documents, none(labels))).count() == 11


def test_documents_that_occur_twice_are_scored_apart(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choices(["an", "ti", "or", "wh", "st", "ea"], k=rng.choice([1, 1, 2, 3, 4])))
    once = [" ".join(word() for _ in range(120)) for _ in range(400)]
    rows = [(i, text) for i, text in enumerate(once)] + [(1000 + i, once[i]) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(100, 400)], "doc_id long, quality int")
    scores = {r.doc_id: r.score for r in lm_scoring.score_documents(lm_scoring.fit_models(docs, marks)).collect()}
    twice = {*range(20), *range(1000, 1020)}
    bar = max(score for i, score in scores.items() if i not in twice)
    assert all(scores[i] > bar for i in twice)


def test_packed_arrays_come_back():
    rng = np.random.default_rng(1)
    for n in (0, 1, 1000):
        arrays = np.sort(rng.integers(0, 1 << 63, n).astype(np.uint64)), rng.integers(-5, 5, n).astype(np.int32), rng.random(n).astype(np.float32)
        back = lm_scoring._unpack(lm_scoring._pack(*arrays), n, np.uint64, np.int32, np.float32)
        assert all((a == b).all() for a, b in zip(arrays, back))
