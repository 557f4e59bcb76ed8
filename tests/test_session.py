"""Scratch tables of batch jobs and their end."""

import os

import pytest

from trailguard.operators.numbering import number_rows
from trailguard.session import materialize, scratch_scope, shared_dir, stash


def tables(spark):
    root = f"{shared_dir(spark)}/trailguard"
    return set(os.listdir(root)) if os.path.isdir(root) else set()


def test_scope_deletes_what_it_wrote_and_nothing_else(spark):
    outside = materialize(spark.range(5), "outside")
    before = tables(spark)
    with scratch_scope(spark):
        df = number_rows(spark.range(40).selectExpr("id % 3 AS g", "id"), ["id"], ["g"])
        inner = stash(df, "inner")
        kept = materialize(inner, "kept", keep=True)
        with scratch_scope(spark):
            nested = materialize(spark.range(3), "nested")
            assert nested.count() == 3
        assert not any(t.startswith("nested") for t in tables(spark) - before)
        assert inner.count() == 40 and len(tables(spark) - before) == 3
    left = tables(spark)
    assert [t.partition("-")[0] for t in left - before] == ["kept"] and before <= left
    assert kept.count() == 40 and outside.count() == 5


def test_scope_ends_with_a_failed_job(spark):
    before = tables(spark)
    with pytest.raises(ZeroDivisionError), scratch_scope(spark):
        materialize(spark.range(3), "failed")
        1 / 0
    assert tables(spark) == before


def test_tables_derived_once_outlive_the_scope(spark):
    from trailguard.plans.catalog import all_queries
    sf = "/root/testdata/sf0.001"
    qs = all_queries()
    for name in ("global_txn_id", "model_features", "simple_cycles", "iforest_score"):
        n = []
        for _ in range(2):
            with scratch_scope(spark):
                n.append(qs[name](spark, sf).count())
        assert n[0] == n[1] > 0, name
