"""The operators on odd rows, and against brute force, round trips or held-out labels."""

import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm import embedding_dedup, html_text, language_id, minhash, packing, piece_sampling, quality, toxicity, vector_search
from llm.shipping import ready
from llm.textbatch import crc_bucket

SF = "/root/testdata/sf0.001"
LONG = "sie und der " * 40_000
CLASH = "doc_id long, text string, lang string, source string, n_chars long, id long, score double, kept boolean, n long, key long, c0 string"


def odd_documents(spark):
    """Nulls in every column, empty, blank, very long and repeated texts, columns with clashing names."""

    rows = [
        (1, "the cat sat on the mat and then it ran", "en", "s", 1, 9, 0.5, True, 7, 3, "x"),
        (2, "The cat sat ON the mat and then it ran", "en", None, None, None, None, None, None, None, None),
        (2, "The cat sat ON the mat and then it ran", "en", None, None, None, None, None, None, None, None),
        (3, None, None, None, None, None, None, None, None, None, None),
        (4, "", "en", "s", 0, 1, 0.0, False, 0, 0, ""),
        (5, " \n\t ", "de", "s", 0, 1, 0.0, False, 0, 0, ""),
        (6, LONG, "de", "s", 0, 1, 0.0, False, 0, 0, ""),
        (7, "zwei Wörter", "de", "s", 0, 1, 0.0, False, 0, 0, ""),
        (8, "12345 !!! ???", "de", "s", 0, 1, 0.0, False, 0, 0, ""),
        (9, "▁ 汉字 \x00 it's", None, "s", 0, 1, 0.0, False, 0, 0, ""),
        (None, "no id at all", "en", "s", 0, 1, 0.0, False, 0, 0, ""),
    ]
    return spark.createDataFrame(rows, CLASH)


def odd_labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 1), (None, 1, 1), (3, None, None), (6, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def documents(spark):
    return odd_documents(spark).cache()


@pytest.fixture(scope="module")
def labels(spark):
    return odd_labels(spark).cache()


def none(df):
    return df.limit(0)


def test_language_id_odd_rows(spark, documents):
    net = language_id.fit_language_network(documents)
    found = language_id.identify_languages(documents, net)
    assert found.columns == ["doc_id", "lang_pred", "score"]
    rows = found.collect()
    assert len(rows) == 11
    by = {r.doc_id: r for r in rows}
    assert {by[i].lang_pred for i in (3, 4, 5, 8)} == {"und"}
    assert by[6].lang_pred == "de" and all(0 <= r.score <= 1 for r in rows)
    assert language_id.identify_languages(none(documents), net).count() == 0
    assert language_id.fit_language_network(none(documents)) is None
    assert {r.lang_pred for r in language_id.identify_languages(documents, None).collect()} == {"und"}


def test_language_id_held_out(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = crc_bucket(F.col("doc_id"), 3) == 1
    net = language_id.fit_language_network(documents.where(~held))
    found = language_id.identify_languages(documents, net).join(documents.where(held), "doc_id")
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97


def brute_ids():
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(packing.vocabulary_paths()[0])
    return lambda text: [*coder.encode(text or "", add_special_tokens=False).ids, 1]


def assert_packed(documents, rows, capacity=2048):
    ids = brute_ids()
    expected = Counter()
    for doc_id, text in documents:
        own = ids(text)
        expected[doc_id, tuple(own)] += 1
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for (doc_id, own), times in expected.items():
        pieces = sorted((r for r in by_doc[doc_id] if r.doc_tokens == len(own)), key=lambda r: r.start)
        assert sum(r.length for r in pieces) == times * len(own)
        for r in pieces:
            part = np.array(own[r.start : r.start + r.length], "<u4")
            assert len(part) == r.length and zlib.crc32(part.tobytes()) == r.ids_crc32
    for pieces in by_sequence.values():
        place = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == place
            place += r.length
        assert place <= capacity


def test_packing_odd_rows(spark, documents):
    rows = packing.pack_documents(documents).collect()
    assert_packed([(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()], rows)
    assert packing.pack_documents(none(documents)).count() == 0


def test_packing_whole_table(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet").repartition(7)
    packed = packing.pack_documents(documents, settings=packing.Settings(fan_in=2)).cache()
    assert_packed([(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()], packed.collect())
    used = packing.padding(packed).first()
    assert used.padding < 0.03 * used.ids


def test_packing_spelled_out_tokens(spark):
    """Added tokens in a text get their own ids, also beside plain rows, at row ends and across them."""

    token = "<|endoftext|>"
    texts = [token, f"a {token}b", "plain words", token * 3, f"汉字 {token}", "<|endof", "text|>", f"{token[:-1]} >", f"é\x85{token}", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    assert_packed(list(enumerate(texts)), packing.pack_documents(docs).collect())
    assert brute_ids()(token) == [50256, 1]


def test_cut_points_cover_every_length():
    settings = packing.Settings()
    for length in range(1, 5000):
        pieces = packing.cut_points(length, settings)
        assert sum(pieces) == length and max(pieces) <= settings.capacity and min(pieces) > 0


def odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0, 0.5], 1, "x"),
        (100, [1.0, 0.0, 0.5], 1, "x"),
        (1, [1.0, 0.01, 0.5], 1, "x"),
        (2, [1.0, 0.0, 0.5], 2, "x"),
        (3, [0.0, 0.0, 0.0], 1, "x"),
        (4, None, 1, "x"),
        (5, [1.0, None, 0.5], 1, "x"),
        (6, [nan, 0.0, 0.5], 1, "x"),
        (7, [inf, 0.0, 0.5], 1, "x"),
        (8, [1.0, 0.0, 0.5], None, "x"),
        (8, [1.0, 0.0, 0.5], None, "x"),
        (9, [2.0, 0.0, 1.0, 0.0], 1, "x"),
        (10, [], 1, "x"),
        (200, [-1.0, 0.0, 0.5], 1, "x"),
        (None, [1.0, 0.0, 0.5], 1, "x"),
    ]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, score string")


def usable(rows):
    return [r for r in rows if r.vec_id is not None and r.embedding and all(x is not None and np.isfinite(x) for x in r.embedding)]


def brute_top(rows, k=10):
    vectors = {r.vec_id: [int(np.floor(1024 * float(x))) for x in r.embedding] for r in usable(rows)}
    out = []
    for q, own in vectors.items():
        if q % 100 == 0:
            scores = sorted((-sum(a * b for a, b in zip(own, v, strict=True)), i) for i, v in vectors.items() if i != q and len(v) == len(own))
            out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("settings", [vector_search.Settings(), vector_search.Settings(queries=2, candidates=64, step=32, dense=0.9)])
def test_search_against_brute_force(spark, settings):
    for vectors in (odd_vectors(spark), spark.read.parquet(f"{SF}/embeddings.parquet")):
        found = vector_search.top_products(vectors, F.col("vec_id") % 100 == 0, settings=settings)
        assert sorted(tuple(r) for r in found.collect()) == brute_top(vectors.collect())
    assert vector_search.top_products(none(odd_vectors(spark)), F.col("vec_id") % 100 == 0).count() == 0


def test_search_of_huge_numbers(spark):
    vectors = spark.createDataFrame([(0, [1e6, 1234567.3]), (1, [999999.7, 1.5]), (2, [-1e6, 765432.1])], "vec_id long, embedding array<double>")
    found = vector_search.top_products(vectors, F.col("vec_id") % 100 == 0)
    assert sorted(tuple(r) for r in found.collect()) == brute_top(vectors.collect())


def test_segment_bounds_hold():
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=(40, 13)), rng.normal(size=(50, 13))
    for segments in (1, 4, 16):
        bound = vector_search.segment_statistics(a, segments) @ vector_search.segment_statistics(b, segments).T
        assert (bound >= a @ b.T - 1e-9).all()


def brute_vectors(rows, threshold=0.93):
    ids = sorted({r.vec_id for r in rows if r.vec_id is not None})
    vectors = {r.vec_id: (r.label, np.array(r.embedding, float)) for r in usable(rows) if r.label is not None and any(r.embedding)}
    linked = {i: set() for i in ids}
    for i, (label, v) in vectors.items():
        for j, (other, w) in vectors.items():
            if i != j and label == other and len(v) == len(w) and v @ w / (np.linalg.norm(v) * np.linalg.norm(w)) >= threshold:
                linked[i].add(j)
    return sorted((i, len(linked[i]), root, root == i) for i, root in roots(linked).items())


def roots(linked):
    found = {}
    for start in sorted(linked):
        if start not in found:
            todo = [start]
            while todo:
                node = todo.pop()
                if node not in found:
                    found[node] = start
                    todo += linked[node]
    return found


def test_embedding_dedup_against_brute_force(spark):
    rng = np.random.default_rng(5)
    centre = rng.normal(size=(4, 16))
    rows = [(i, (centre[i % 4] + rng.normal(size=16) * (0.05 + 0.3 * (i % 3))).tolist(), i % 2) for i in range(150)]
    rows += [(1000 + i, rows[0][1], 0) for i in range(30)]
    made = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    for settings in (embedding_dedup.Settings(), embedding_dedup.Settings(block=16, pairs=7)):
        found = embedding_dedup.near_vectors(made, settings=settings)
        assert sorted(tuple(r) for r in found.collect()) == brute_vectors(made.collect())
    odd = odd_vectors(spark)
    assert sorted(tuple(r) for r in embedding_dedup.near_vectors(odd).collect()) == brute_vectors(odd.collect())
    assert embedding_dedup.near_vectors(none(odd)).count() == 0


def test_int8_bound_loses_no_pair():
    rng = np.random.default_rng(9)
    one = rng.normal(size=(1, 32)) + 0.37 * rng.normal(size=(300, 32))
    unit = one / np.linalg.norm(one, axis=1)[:, None]
    exact = set(zip(*np.nonzero(np.triu(unit @ unit.T >= 0.93, 1)), strict=True))
    i, j, asked = embedding_dedup.linked_pairs(one, one, embedding_dedup.Settings(), True)
    assert set(zip(i, j, strict=True)) == exact and 0 < len(exact) <= asked < 300 * 299 / 2


def brute_documents(rows, percent=75):
    sets = {}
    for doc_id, text in rows:
        if doc_id is None:
            continue
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
        whole = [tuple(words)] if 0 < len(words) < 5 else [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
        sets[doc_id] = set(whole)
    linked = {i: set() for i in sets}
    for i, one in sets.items():
        for j, two in sets.items():
            if i < j and one and 100 * len(one & two) >= percent * len(one | two):
                linked[i].add(j)
                linked[j].add(i)
    return sorted((i, len(sets[i]), root, root == i) for i, root in roots(linked).items())


def near_copies(count, words, edits, seed):
    """Copies of one text with a few words replaced each, as in a large group of near copies."""

    rng = np.random.default_rng(seed)
    base = [f"w{i}" for i in rng.integers(0, 10_000, words)]
    out = []
    for i in range(count):
        own = list(base)
        for place in rng.integers(0, words, rng.integers(0, edits)):
            own[place] = f"x{rng.integers(0, 50)}"
        out.append((10_000 + i, " ".join(own)))
    return out


@pytest.mark.parametrize("settings", [minhash.Settings(), minhash.Settings(block=8)])
def test_minhash_against_brute_force(spark, documents, settings):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    rows += near_copies(150, 146, 16, 1) + [(20_000 + i, "one two three four five six seven eight") for i in range(40)]
    made = spark.createDataFrame(rows, "doc_id long, text string")
    found = minhash.near_duplicates(made, settings=settings)
    assert sorted(tuple(r) for r in found.collect()) == brute_documents(rows)


def test_minhash_of_hot_keys(spark, documents, monkeypatch):
    """All keys handled as hot ones give the same rows; one group of near copies is found as hot."""

    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    rows += near_copies(150, 146, 16, 1) + [(20_000 + i, "one two three four five six seven eight") for i in range(40)]
    made = spark.createDataFrame(rows, "doc_id long, text string")
    with monkeypatch.context() as patch:
        patch.setattr(minhash, "_hot_keys", lambda marks, _: marks.select(F.explode("bands").alias("key")).distinct())
        assert sorted(tuple(r) for r in minhash.near_duplicates(made).collect()) == brute_documents(rows)
    words = " ".join(f"w{i}" for i in range(120))
    copies = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit(words + " x"), "id").alias("text"))
    marks = minhash.signatures(copies, "doc_id", "text")
    assert minhash._hot_keys(marks, minhash.Settings()).count() > 0
    assert {r.component_id for r in minhash.near_duplicates(copies).select("component_id").distinct().collect()} == {0}


def test_minhash_links_short_texts_at_the_threshold(spark):
    """Pairs of 3 to 20 shingles whose sets have exactly three quarters of their union in common."""

    rows = []
    for union in (4, 8, 12, 16, 20):
        for cut in {0, union // 8}:
            for n in range(200):
                words = [f"w{union}x{cut}x{n}x{i}" for i in range(union + 4)]
                rows.append((len(rows), " ".join(words[: len(words) - cut])))
                rows.append((len(rows), " ".join(words[union // 4 - cut :])))
    made = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in minhash.near_duplicates(made).collect()}
    assert [pair for pair in range(0, len(rows), 2) if (found[pair], found[pair + 1]) != (pair, pair)] == []


def test_minhash_table_and_empty(spark, documents):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in table.collect()]
    assert sorted(tuple(r) for r in minhash.near_duplicates(table).collect()) == brute_documents(rows)
    assert minhash.near_duplicates(none(documents)).count() == 0


def test_quality(spark, documents, labels):
    found = quality.select_by_importance(documents, labels)
    assert found.count() == 11 and found.columns == ["doc_id", "log_weight", "n_grams", "expected", "sampling_key", "kept"]
    assert quality.select_by_importance(none(documents), labels).count() == 0
    assert quality.select_by_importance(documents, none(labels)).where("kept").count() == 11
    kept = quality.keep_important(documents, labels)
    assert kept.columns == documents.columns
    assert kept.count() == found.where("kept").count()
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    marks = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    right = quality.select_by_importance(table, marks).join(marks, "doc_id").agg(F.avg((F.col("kept") == (F.col("quality") == 1)).cast("int"))).first()[0]
    assert right > 0.97


def test_kth_largest(spark):
    values = [float(x) for x in np.random.default_rng(2).normal(size=500)] + [0.25] * 300
    df = spark.createDataFrame([(v,) for v in values], "x double")
    ordered = sorted(values, reverse=True)
    assert [quality.kth_largest(df, "x", k) for k in (1, 77, 250, 400, 800)] == [ordered[k - 1] for k in (1, 77, 250, 400, 800)]
    assert quality.kth_largest(df, "x", 801) is None and quality.kth_largest(df, "x", 0) is None


def test_toxicity_sample_is_bounded_by_document(spark):
    long = "the muslim man said so. " * 50_000
    docs = spark.createDataFrame([(1, long, 1), (2, "one. two. three", 0)], "id long, text string, y int")
    sample = docs.select("id", "y")
    settings = toxicity.Settings()
    rows = toxicity.training_rows(docs.select("id", "text"), sample, settings).toPandas()
    documents = rows[~rows["pair"]].set_index("id")
    assert len(documents.loc[1, "first"]) == 4 * settings.document_sentences and len(documents.loc[2, "first"]) == 4 * 3
    assert int(rows["pair"].sum()) == settings.document_sentences


def test_toxicity_odd_rows(spark, documents, labels):
    model = toxicity.fit_toxicity(documents, labels)
    found = toxicity.score_toxicity(documents, model)
    assert found.count() == 11 and found.where("score is null or score < 0 or score > 1").count() == 0
    assert toxicity.score_toxicity(none(documents), model).count() == 0
    assert toxicity.score_toxicity(documents, toxicity.fit_toxicity(documents, none(labels))).where("predicted = 1").count() == 0
    kept = toxicity.remove_toxic(documents, model)
    assert kept.columns == documents.columns and kept.count() == found.where("predicted = 0").count()


def test_toxicity_held_out(spark):
    documents = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    marks = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = crc_bucket(F.col("doc_id"), 5) == 0
    model = toxicity.fit_toxicity(documents, marks.where(~held))
    rows = toxicity.score_toxicity(documents, model).join(marks.where(held), "doc_id").select("toxic", "predicted").collect()
    hit = sum(r.predicted for r in rows if r.toxic == 1) / sum(r.toxic for r in rows)
    wrong = sum(r.predicted for r in rows if r.toxic == 0) / sum(r.toxic == 0 for r in rows)
    assert hit > 0.85 and wrong < 0.03


def test_counterfactual_pairs_lower_false_alarms(spark):
    rng = np.random.default_rng(4)
    plain = [f"w{i}" for i in range(60)]
    rows, marks = [], []
    for i in range(400):
        toxic = i % 2
        words = list(rng.choice(plain, 8))
        if toxic:
            words[3] = "vile"
        # the group is named in most toxic texts and in few others
        if rng.random() < (0.8 if toxic else 0.05):
            words[5] = "muslims"
        rows.append((i, " ".join(words) + "."))
        marks.append((i, toxic))
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    neutral = spark.createDataFrame([(1, "w1 w2 muslims w3 w4"), (2, "w1 w2 christians w3 w4"), (3, "vile w1 w2")], "doc_id long, text string")

    def scores(fairness):
        model = toxicity.fit_toxicity(documents, labels, settings=toxicity.Settings(fairness=fairness))
        return {r.doc_id: r.score for r in toxicity.score_toxicity(neutral, model).collect()}

    biased, fair = scores(0.0), scores(5.0)
    assert abs(fair[1] - fair[2]) < abs(biased[1] - biased[2]) and fair[1] < 0.5 < fair[3]


PAGE = (
    "<html><head><title>t</title></head><body><div class='nav'><ul><li>Home</li><li>About</li></ul></div>"
    "<div id='top'>Daily   Paper</div><div id='x'><h2>{title}</h2><p>{one}&amp; more<br>text<p>{two}<script>var a='</p>';</script></div>"
    "<div id='bottom'>All rights &copy;</div><form>mail</form></body></html>"
)


def test_wrappers_without_article_elements(spark):
    rows = [(i, f"http://news.example/{i}", PAGE.format(title=f"Title {i}", one=f"first {i} ", two=f"second\n {i}")) for i in range(8)]
    rows += [(100, None, None), (101, "http://news.example/x", ""), (None, "http://lone.example/", "<p>only &lt;this&gt; text</p>"), (0, rows[0][1], rows[0][2])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash"))
    found = html_text.main_text(pages)
    assert found.columns == ["page_id", "url", "text", "n_chars"] and found.count() == 12
    by = {r.page_id: r for r in found.collect()}
    assert by[3].text == "Title 3\n\nfirst 3 & more text\n\nsecond 3"
    assert by[100].text == by[101].text == "" and by[None].text == "only <this> text"
    assert all(r.n_chars == len(r.text) for r in by.values())
    assert html_text.main_text(none(pages)).count() == 0


def site_page(container, number, tagline):
    return (
        f"<html><body><div id='top'>{tagline}</div>{container[0]}<h2>Title {number}</h2><ul><li>point {number}</ul>"
        f"<p>body of {number} {'words ' * 30}</p>{container[1]}<div id='end'>{tagline} end</div></body></html>"
    )


def site_text(number):
    return f"Title {number}\n\npoint {number}\n\n" + f"body of {number} {'words ' * 30}".strip()


def texts_of(spark, rows):
    return {r.page_id: r.text for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def test_wrappers_of_hosts_with_several_templates(spark):
    kinds = [("<div class='post'>", "</div>"), ("<section class='story'><div>", "</div></section>"), ("<article class='sport'>", "</article>"), ("<article class='news'>", "</article>")]
    rows = [(i, f"http://two.example/{i}", site_page(kinds[0 if i % 4 else 1], i, "Daily")) for i in range(40)]
    rows += [(100 + i, f"http://blog.example/{i}", site_page(kinds[2 if i % 4 else 3], 100 + i, "Blog")) for i in range(20)]
    found = texts_of(spark, rows)
    assert {i: found[i] for i, _, _ in rows} == {i: site_text(i) for i, _, _ in rows}
    sites = [(i, None if i % 2 else f"site{i % 3}.example/{i}", site_page(kinds[i % 3], i, f"Site {i % 3}")) for i in range(30)]
    found = texts_of(spark, sites)  # the sites share one nameless host
    assert [i for i, _, _ in sites if site_text(i) not in found[i]] == []


def test_copies_and_bylines_are_no_template(spark):
    kind = ("<div class='post'>", "</div>")
    rows = [(i, f"http://copies.example/{i}", site_page(kind, max(0, i - 20), "Daily")) for i in range(26)]
    found = texts_of(spark, rows)
    assert [i for i, _, _ in rows if found[i] != site_text(max(0, i - 20))] == []
    for pages in (5, 60):
        rows = [(i, f"http://by{pages}.example/{i}", site_page((kind[0] + f"<h3>by author {i % 5}</h3>", kind[1]), i, "Daily")) for i in range(pages)]
        found = texts_of(spark, rows)
        assert [i for i, _, _ in rows if found[i] != f"by author {i % 5}\n\n{site_text(i)}"] == []


@pytest.mark.parametrize("pages", [1, 8])
def test_names_of_containers_are_no_furniture(spark, pages):
    kinds = {
        "div": ("<div class='content no-sidebar'>", "</div>"),
        "form": ("<form id='aspnetForm'><article>", "</article></form>"),
        "custom": ("<app-page class='layout has-sidebar'><div class='post with-comments'>", "</div></app-page>"),
    }
    rows = []
    for at, (name, (start, stop)) in enumerate(kinds.items()):
        extra = "<div class='share'>Share this {}</div><p class='x'>by <span class='menu'>pick</span> <math><mi>x</mi><annotation>TeX</annotation></math> <object>chart {}</object></p>"
        for i in range(pages):
            page = at * 100 + i
            rows.append((page, f"http://{name}.example/{i}", site_page((start, extra.format(i, i) + stop), page, "").replace("<div id='top'></div>", "").replace("<div id='end'> end</div>", "")))
    found = texts_of(spark, rows)
    assert [i for i, _, _ in rows if found[i] != f"{site_text(i)}\n\nby x chart {i % 100}"] == []


def test_pages_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = {r.page_id: r.text for r in html_text.main_text(pages).collect()}
    for row in pages.collect():
        assert html_text.Page(row.html).blocks and found[row.page_id]
        assert "<" not in found[row.page_id] and "©" not in found[row.page_id]


def test_piece_sampling_round_trip(spark, documents):
    found = piece_sampling.sample_pieces(documents)
    rows = found.collect()
    assert len(rows) == 11 and all(r.lossless is (None if r.pieces is None else True) for r in rows)
    by = {r.doc_id: r for r in rows}
    assert by[3].pieces is None and by[4].pieces == []
    back = Counter((r.doc_id, r.text) for r in piece_sampling.decode_pieces(found).collect())
    assert back == Counter((r.doc_id, r.text) for r in documents.select("doc_id", "text").collect())
    again = piece_sampling.sample_pieces(documents.repartition(5)).exceptAll(found)
    assert again.count() == 0
    assert piece_sampling.sample_pieces(none(documents)).count() == 0


def test_piece_sampling_follows_the_lattice():
    """Frequencies of sampled segmentations against all segmentations listed."""

    lattice = piece_sampling.PieceLattice(piece_sampling.vocabulary_path(), piece_sampling.Settings())
    word = b" hello"

    def listed(at):
        if at == len(word):
            yield (), 0.0
        for stop in range(at + 1, len(word) + 1):
            piece = lattice.known.get(word[at:stop])
            if piece is not None:
                for rest, weight in listed(stop):
                    yield (piece, *rest), weight + lattice.log[piece]

    weights = dict(listed(0))
    total = sum(np.exp(w) for w in weights.values())
    n = 20_000
    data = np.frombuffer(b"hello" * n, np.uint8)
    ids, bounds = lattice.sample(data, np.arange(n + 1) * 5, np.arange(n))
    seen = Counter(tuple(ids[bounds[i] : bounds[i + 1]].tolist()) for i in range(n))
    for pieces, weight in weights.items():
        share = np.exp(weight) / total
        assert abs(seen[pieces] / n - share) < 5 * (share * (1 - share) / n) ** 0.5 + 1e-3


def test_long_and_short_segments_agree():
    lattice = piece_sampling.PieceLattice(piece_sampling.vocabulary_path(), piece_sampling.Settings())
    data = np.frombuffer("straßenbahnhaltestelle汉字①".encode(), np.uint8)
    one = lattice.sample(data, np.array([0, len(data)]), np.array([3]))[0]
    other = piece_sampling.PieceLattice(piece_sampling.vocabulary_path(), piece_sampling.Settings(short=4))
    assert one.tolist() == other.sample(data, np.array([0, len(data)]), np.array([3]))[0].tolist()


def test_megabytes_without_spaces():
    """Segments of more than a block of positions: pieces don't depend on what stands beside them."""

    rng = np.random.default_rng(2)
    lattice = piece_sampling.PieceLattice(piece_sampling.vocabulary_path(), piece_sampling.Settings())
    latin = bytes(rng.choice(np.frombuffer(b"abcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8), 300_000))
    han = "".join(map(chr, rng.integers(0x4E00, 0x9000, 100_000))).encode()
    both = np.frombuffer(latin + han, np.uint8)
    offsets = np.array([0, len(latin), len(both)])
    started = time.monotonic()
    ids, bounds = lattice.sample(both, offsets, np.array([1, 2]))
    assert time.monotonic() - started < 30
    back, ends = lattice.decode(ids, bounds)
    assert np.array_equal(back, both) and np.array_equal(ends, offsets)
    alone = lattice.sample(np.frombuffer(han, np.uint8), np.array([0, len(han)]), np.array([2]))[0]
    assert alone.tolist() == ids[bounds[1] :].tolist()


def test_pipeline(spark, documents, tmp_path):
    import corpus_pipeline

    ready(spark)
    odd_documents(spark).write.parquet(f"{tmp_path}/documents.parquet")
    odd_labels(spark).write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, str(tmp_path))
        assert kept.columns == documents.columns, name
        assert stage(spark, none(docs), str(tmp_path)).count() == 0
    assert corpus_pipeline.run(spark, str(tmp_path)).columns[0] == "doc_id"
    packed = corpus_pipeline.run(spark, SF)
    table = spark.read.parquet(f"{SF}/documents.parquet")
    assert 0 < packed.select("doc_id").distinct().count() < table.count()
