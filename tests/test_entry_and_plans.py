"""Driver contract and plan shape checks on the small tables."""

from conftest import SF_SMALL

import __spark_entry__ as ent

NO_PYTHON = ["word_count", "payment_sum", "win_sliding_30", "win_sliding_60", "subtract", "top_pages",
             "graph_out_degree", "bitmap_cardinality", "id_select", "id_rank"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_entry_smoke(spark):
    df = ent.entry(spark)
    rows = df.collect()
    assert len(rows) == 10 and df.columns == ["page", "pop"]


def test_every_query_has_oracle():
    from quarry.plans.registry import all_queries
    assert set(all_queries()) <= set(ent.oracle_sql()) <= set(ent.queries())


def test_hot_paths_stay_in_the_jvm(spark):
    qs = ent.queries()
    for name in NO_PYTHON:
        plan = _plan(qs[name](spark, SF_SMALL))
        assert "Python" not in plan and "ArrowEval" not in plan, name


def test_scans_prune_columns_and_push_filters(spark):
    qs = ent.queries()
    plan = _plan(qs["payment_sum"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,purchase)]" in plan
    assert "ReadSchema: struct<user_id:bigint,event_type:string,value:double>" in plan
    wc = _plan(qs["word_count"](spark, SF_SMALL))
    assert "ReadSchema: struct<text:string>" in wc


def test_top_pages_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in _plan(ent.queries()["top_pages"](spark, SF_SMALL))
