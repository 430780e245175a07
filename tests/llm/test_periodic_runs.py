"""Periodic runs against brute force, on odd rows, and the query against its SQL."""

import hashlib
import random
import re
import time
import zlib
from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F

import check_oracle
from llm import periodic_runs, queries

SF = "/root/testdata/sf0.001"


def slow_runs(words):
    """(start, length, period): every stretch of equal words at every distance, smallest distance first."""

    found = {}
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted(((start, length, q) for (start, length), q in found.items()), key=lambda r: (r[0], r[2]))


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def slow_collapse(words, runs):
    dropped = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def random_words(rng):
    words = []
    for _ in range(rng.randrange(6)):
        size = rng.choice([1, 2, 3, 50])
        if rng.random() < 0.3:
            words += [rng.randrange(size) for _ in range(rng.randrange(30))]
        else:
            base = [rng.randrange(min(size, 4)) for _ in range(rng.randrange(1, 14))]
            words += (base * rng.randrange(1, 14))[: rng.randrange(1, 120)]
    return words


def test_runs_against_brute_force():
    rng = random.Random(2)
    for _ in range(1500):
        rows = [random_words(rng) for _ in range(rng.randrange(1, 4))]
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
        got = periodic_runs.runs_of_rows(np.array([w for r in rows for w in r], np.int32), offsets)
        assert got == [(k, *run) for k, words in enumerate(rows) for run in slow_runs(words)]


def test_positions_split_and_keep_order():
    rng = random.Random(4)
    values = rng.sample(range(100_000), 9_000)
    held = periodic_runs.Positions(values[0])
    for value in values[1:]:
        held.add(value)
    values.sort()
    assert list(held) == values
    for k in (0, 1, 1023, 1024, 5000, 8998, 8999):
        assert list(held.neighbours(values[k])) == values[max(k - 1, 0) : k] + values[k + 1 : k + 2]


def test_long_periodic_texts_end_in_time():
    began = time.time()
    fib = [[0], [0, 1]]
    while len(fib[-1]) < 100_000:
        fib.append(fib[-1] + fib[-2])
    for words in ([0] * 100_000, [i % 777 for i in range(100_000)], fib[-1]):
        assert periodic_runs.runs_of_rows(np.array(words, np.int32), np.array([0, len(words)]))
    assert time.time() - began < 60


def test_odd_rows(spark):
    run = "a b c " * 9
    rows = [
        (1, None, 1, "r"),
        (2, "", 2, None),
        (3, " \n\t ", 3, "r"),
        (4, run, 4, "r"),
        (4, run, 4, "r"),
        (None, f"x y {run} z", 5, "r"),
        (5, "x " + "w " * 200_000, 6, "r"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id long, runs string")
    got = periodic_runs.collapse_runs(docs)
    assert got.columns == ["doc_id", "runs", "collapsed"]
    found = sorted(((r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in got.collect()), key=str)
    expected = [
        (1, [], ""),
        (2, [], ""),
        (3, [], ""),
        (4, [(0, 27, 3)], "a b c"),
        (4, [(0, 27, 3)], "a b c"),
        (None, [(1, 27, 3)], "x y a b c z"),
        (5, [(1, 200_000, 1)], "x w"),
    ]
    assert found == sorted(expected, key=str)
    assert periodic_runs.collapse_runs(docs.limit(0)).count() == 0
    planted = periodic_runs.plant_periods(docs)
    assert planted.columns == ["doc_id", "text"] and planted.count() == 7 and planted.where("doc_id is null").first().text == rows[5][1]


def test_query_against_brute_force(spark):
    rows = {r.doc_id: r for r in queries.op12_periodic_runs(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    planted = 0
    for doc in docs:
        words, h = words_of(doc.text), zlib.crc32(str(doc.doc_id).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs, got = slow_runs(words), rows[doc.doc_id]
        planted += h % 10 == 0 and bool(runs)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        assert got.n_runs == len(runs)
        assert (got.start, got.length, got.period) == (best or (None,) * 3)
        assert got.exponent_milli == (1000 * best[1] // best[2] if best else None)
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        assert got.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert got.collapsed_sha256 == hashlib.sha256(slow_collapse(words, runs).encode()).hexdigest()
    assert planted > 3


def test_query_matches_sql(spark):
    ((_, problem, count, _),) = check_oracle.compare(spark, check_oracle.connect(SF), SF, ["op12_periodic_runs"])
    assert problem is None and count > 0


def test_strongest_prefers_the_earliest_of_equals(spark):
    df = spark.sql("select array(named_struct('start', 0L, 'length', 24L, 'period', 8L), named_struct('start', 5L, 'length', 48L, 'period', 12L), named_struct('start', 9L, 'length', 32L, 'period', 8L)) runs")
    assert tuple(df.select(periodic_runs.strongest(F.col("runs")).alias("b")).first().b) == (5, 48, 12)
