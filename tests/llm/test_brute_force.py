"""Learned operators and the pipeline against plain Python: loops over words and windows, sets and sorting."""

import math
import re
import struct
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from test_operators import assert_packed, brute_documents

from llm import language_id, quality, toxicity
from llm.shipping import ready

SF = "/root/testdata/sf0.001"
ODD, ALL = 0x9E3779B97F4A7C15, (1 << 64) - 1
TEXTS = [
    "",
    " \n\t ",
    "One word. TWO words! three? four\nfive",
    "it's ÀÉÖ×Þß 汉字 and the the End 3rd e-mail x_y a.b",
    "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 9,
    "Überall sind Wörter, überall! " * 40,
    "\x00\x7f \x1c \x85   odd",
    "x" * 700,
]


def encoded(texts):
    parts = [text.encode() for text in texts]
    return np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0, *map(len, parts)])


def plain_mix(x):
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & ALL
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & ALL
    return x ^ x >> 31


def plain_hash(word):
    return plain_mix(sum((byte + 1) * pow(ODD, place, 1 << 64) for place, byte in enumerate(word)) & ALL)


def plain_fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" or ("À" <= c <= "Þ" and c != "×") else c for c in text)


def plain_language(net, text):
    """Mean log probabilities, window by window, position by position."""

    s, data, total = net.settings, plain_fold(text).encode(), np.zeros(len(net.languages))
    for low in range(0, len(data), s.window):
        part = data[low : low + s.window]
        window, hidden = part.ljust(s.window, b"\0"), []
        for width in s.widths:
            sums = [sum(net.tables[width][p][window[at + p]].astype(float) for p in range(width)) for at in range(s.window - width + 1)]
            hidden.extend(max(0.0, max(row[f] for row in sums) + net.biases[width][f]) for f in range(s.filters))
        logits = [sum(h * net.dense[i, k] for i, h in enumerate(hidden)) + net.offset[k] for k in range(len(net.languages))]
        norm = math.log(sum(math.exp(x) for x in logits))
        total += len(part) * np.array([x - norm for x in logits])
    return total / max(1, len(data))


def test_language_scores_of_a_network():
    net = language_id.ByteNetwork(["de", "en", "fr"], language_id.Settings(filters=5))
    net.start()
    rng = np.random.default_rng(3)
    for width in net.biases:
        net.biases[width][:] = rng.normal(0, 0.5, 5)
    net.offset[:] = rng.normal(0, 1, 3)
    got = net.scorer().texts(*encoded(TEXTS))
    for text, row in zip(TEXTS, got, strict=True):
        assert row == pytest.approx(plain_language(net, text), abs=1e-4)


def plain_logit(model, text):
    """Largest sum over the sentences; a sentence is cut every ``sentence_words`` words."""

    s, best = model.settings, None
    for sentence in re.split(r"[.!?\n]", text):
        words = re.findall(r"[0-9A-Za-z'\u0080-\U0010ffff]+", plain_fold(sentence))
        for low in range(0, len(words), s.sentence_words):
            total = 0.0
            for word in words[low : low + s.sentence_words]:
                for column, size in enumerate((None, 4, 5)):
                    salted = plain_hash(word.encode()[:size]) ^ (column + 1) * ODD & ALL
                    total += float(model.weights[salted >> 20 & (1 << s.bits) - 1])
            best = total if best is None else max(best, total)
    return (best or 0.0) + model.bias


def test_toxicity_scores_of_a_model():
    settings = toxicity.Settings(bits=12)
    model = toxicity.ToxicityModel(np.random.default_rng(5).normal(0, 0.2, 1 << 12).astype(np.float32), -0.7, settings)
    got = toxicity.document_logits(model, *encoded(TEXTS))
    assert got == pytest.approx([plain_logit(model, text) for text in TEXTS], abs=1e-3)


def plain_grams(text, settings):
    """Buckets of words, word pairs and triples of word shapes."""

    words = [part for part in re.split(rb"[\x20\x09-\x0d]+", (text or "").encode()) if part]
    hashes, shapes, found = [plain_hash(word) for word in words], [0, 0], Counter()
    for k, word in enumerate(words):
        found[hashes[k] % settings.word_buckets] += 1
        if k:
            found[plain_mix(hashes[k - 1] * ODD + hashes[k] & ALL) % settings.word_buckets] += 1
        kind = 0 if word[:1].islower() else 1 if word[:1].isupper() else 2 if word[0] >= 128 else 3
        capitals, digits = bool(re.search(rb"[A-Z]", word[1:])), bool(re.search(rb"[0-9]", word))
        symbols = min(2, len(re.findall(rb"[!-/:-@\[-`{-~]", word)))
        same = k > 0 and words[k - 1] == word
        size = 0 if len(word) < 4 else 1 if len(word) < 9 else 2
        shapes.append(((((kind * 2 + capitals) * 2 + digits) * 3 + symbols) * 2 + same) * 3 + size + 1)
        triple = (shapes[-1] * 1024 + shapes[-2]) * 1024 + shapes[-3]
        found[settings.word_buckets + plain_mix(triple) % settings.shape_buckets] += 1
    return found


def plain_quality(rows, marks, settings=quality.Settings()):
    """{id: (log weight, key, kept)} of rows (id, text) with unique ids; ``marks`` gives 1 or 0 by id."""

    grams = {i: plain_grams(text, settings) for i, text in rows}
    good = {i for i, mark in marks.items() if mark == 1}
    raw, target = Counter(), Counter()
    for i, own in grams.items():
        raw.update(own)
        target.update(own if i in good else {})
    weights = {}
    for i, own in grams.items():
        total = 0.0
        for is_word in (True, False):
            mine = {b: n for b, n in own.items() if (b < settings.word_buckets) == is_word}
            size = sum(mine.values())
            whole = [sum(n for b, n in model.items() if (b < settings.word_buckets) == is_word) for model in (raw, target)]
            scale = max(1, whole[1] - size * (i in good)) / max(1, whole[0] - size)
            for b, n in mine.items():
                counted, expected = target[b] - n * (i in good), (raw[b] - n) * scale
                ratio = math.log((counted + settings.shrink) / (expected + settings.shrink))
                total += n * (ratio if ratio >= 0 else min(0.0, ratio + settings.tolerance))
        weights[i] = total
    prior = len(good) / len(marks)
    k = round(sum(min(1.0, prior * math.exp(min(w, 50.0))) for w in weights.values()))
    keys = {i: w + plain_gumbel(i) for i, w in weights.items()}
    least = sorted(keys.values(), reverse=True)[k - 1]
    return {i: (w, keys[i], keys[i] >= least) for i, w in weights.items()}


def plain_gumbel(doc_id):
    seed = xxhash.xxh64_intdigest(b"gumbel", 42)
    low = xxhash.xxh64_intdigest(struct.pack("<q", doc_id), seed) & (1 << 30) - 1
    return -math.log(-math.log((low + 0.5) / (1 << 30)))


@pytest.fixture(scope="module")
def tables(spark):
    ready(spark)
    documents = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    marks = spark.read.parquet(f"{SF}/labels.parquet").where("quality is not null").select("doc_id", "quality")
    return [tuple(r) for r in documents.collect()], {r.doc_id: r.quality for r in marks.collect()}


def test_quality_weights_and_sample(spark, tables):
    rows, marks = tables
    rows = rows + [(10**9 + k, text) for k, text in enumerate([None, *TEXTS])]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(list(marks.items()), "doc_id long, quality int")
    expected = plain_quality(rows, marks)
    for r in quality.select_by_importance(documents, labels).collect():
        weight, key, kept = expected.pop(r.doc_id)
        assert (r.log_weight, r.sampling_key) == pytest.approx((weight, key), abs=1e-6) and r.kept == kept
    assert not expected


def test_pipeline_keeps_what_plain_code_keeps(spark, tables):
    import corpus_pipeline

    rows, marks = tables
    chosen = plain_quality(rows, marks)
    rows = [row for row in rows if chosen[row[0]][2]]
    good = spark.read.parquet(f"{SF}/documents.parquet").where(F.col("doc_id").isin([row[0] for row in rows]))
    model = toxicity.fit_toxicity(good, spark.read.parquet(f"{SF}/labels.parquet"))
    rows = [row for row in rows if plain_logit(model, row[1] or "") < 0]
    kept = {found[0] for found in brute_documents(rows) if found[3]}
    rows = [row for row in rows if row[0] in kept]
    packed = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in packed} == kept and 0 < len(kept) < len(chosen)
    assert_packed(rows, packed)
