"""Connected components against plain code, and what one of their steps shuffles."""

import random

import pytest

from llm.graph import _large_star, _small_star, _tidy, components
from llm.minhash import _smaller_first


def roots_of(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {node: find(node) for edge in edges for node in edge if edge[0] != edge[1]}


@pytest.mark.parametrize("seed", range(2))
def test_components_match_plain_code(spark, seed):
    draw = random.Random(seed)
    path = [(k, k + 1) for k in range(1000, 1040)]
    star = [(2000, 2000 + k) for k in range(1, 200)]
    pairs = [(draw.randrange(400), draw.randrange(400)) for _ in range(260)]
    edges = path + star + [(b, a) for a, b in pairs] + pairs[:50] + [(5000, 5000)]
    draw.shuffle(edges)
    found = components(spark.createDataFrame(edges, "src long, dst long")).collect()
    assert len(found) == len({row["node"] for row in found})
    expected = roots_of(edges)
    expected.pop(5000, None)
    assert {row["node"]: row["root"] for row in found} == expected


def test_no_edges_give_no_rows(spark):
    assert components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_a_step_reads_its_edges_in_one_set_of_tasks(spark):
    """Every shuffle leaves files for every task, and a union has the tasks of both its sides."""

    current = _tidy(spark.createDataFrame([(2, 1), (3, 2)], "u long, v long")).checkpoint()
    plan = _tidy(_small_star(_large_star(current)))._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in plan


def test_pairs_do_not_depend_on_the_order_of_their_rows(spark):
    pairs = spark.createDataFrame([(7, 3), (3, 7), (1, 2)], "a long, b long")
    assert sorted(map(tuple, _smaller_first(pairs).collect())) == [(1, 2), (3, 7), (3, 7)]


def test_edges_between_steps_lie_in_no_more_partitions_than_asked_for(spark):
    """Every task over a step's edges leaves files, also where a shuffle has many more partitions than they need."""

    edges = spark.createDataFrame([(k, k + 1) for k in range(40)], "src long, dst long").repartition(16)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        found = components(edges, 2)
        assert found.rdd.getNumPartitions() <= 2 + 16
        assert {row["root"] for row in found.collect()} == {0}
        assert components(edges).rdd.getNumPartitions() > 2 + 16
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
