"""Positions against a plain sort: ties, missing keys, both directions, no rows."""

import pytest
from pyspark.sql import functions as F

from punctual.operators.ordering import with_rank


def brute(keys, descending):
    known = [k for k in keys if k is not None]
    before = {k: sum(other > k if descending else other < k for other in known) for k in known}
    return sorted((i, 1 + (len(known) if k is None else before[k])) for i, k in enumerate(keys))


@pytest.mark.parametrize("descending", [False, True])
def test_ranks_with_ties_and_missing_keys(spark, descending):
    keys = [None if i % 11 == 0 else (i * 37) % 90 - 45 for i in range(300)]
    rows = spark.createDataFrame(list(enumerate(keys)), "id long, key long").repartition(5)
    ranked = with_rank(rows, F.floor(F.col("key") / 10), F.col("key"), descending=descending)
    assert ranked.columns == ["id", "key", "position"]
    assert sorted((r.id, r.position) for r in ranked.collect()) == brute(keys, descending)
    assert with_rank(rows.limit(0), F.col("key"), F.col("key")).count() == 0


def test_deadline_history_sorted_for_display(spark):
    from punctual.plans.history import sla_history
    from punctual.sources import driver_tables as data

    folder = "/root/testdata/sf0.001"
    tables = data.sla_config(spark, folder), data.job_state(spark, folder), data.run_state(spark, folder)
    shown = [r.deadline_utc for r in sla_history(*tables, data.AS_OF, ordered=True).select("deadline_utc").collect()]
    assert shown and shown == sorted(shown)
