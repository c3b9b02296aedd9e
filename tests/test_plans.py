"""Plan checks over every registered query: Python only where user code or object
writes need it, and no single-task window in the ranking queries."""

import pytest

from cairn.plans import registry

SF_DIR = "/root/testdata/sf0.001"
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "PythonMapInArrow", "FlatMapGroupsInPandas")
# user transformation (D2) and the object writer (K3) run Python by design; the
# writer has already run when the query returns, so its plan is only a scan
PYTHON_ALLOWED = {"apply_transformation"}
RANKING = {"rfm_analysis", "rfm_as_of_window", "rfm_segment_counts", "rfm_step_chain", "ntile_distributed"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_plan_shape(spark, name):
    plan = _plan(registry.QUERIES[name](spark, SF_DIR))
    if name not in PYTHON_ALLOWED:
        assert not any(n in plan for n in PYTHON_NODES), plan
    if name in RANKING:
        assert "SinglePartition" not in plan, plan


def test_scan_prunes_and_pushes(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    q = registry.QUERIES
    plan = _plan(q["incremental_filter"](spark, SF_DIR))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in plan
    plan = _plan(q["remove_columns"](spark, SF_DIR))
    assert "l_tax" not in plan.split("ReadSchema:")[1]
    plan = _plan(q["filter_by_params"](spark, SF_DIR))
    assert "EqualTo(o_orderstatus,F)" in plan and "EqualTo(o_orderpriority,1-URGENT)" in plan
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_rfm_stores_once_and_sorts_nothing(spark, monkeypatch):
    """The per-customer rows are stored once, without a sort of them; the scores are
    comparisons over that table. At most six jobs run before the result is read."""
    from cairn.operators import boundaries

    seen, store = [], boundaries.materialize

    def watched(df, name="stage"):
        seen.append(_plan(df))
        return store(df, name)

    monkeypatch.setattr(boundaries, "materialize", watched)
    sc, group = spark.sparkContext, "rfm-jobs"
    sc.setJobGroup(group, "jobs of one RFM plan")
    try:
        out = registry.QUERIES["rfm_analysis"](spark, SF_DIR)
        jobs = len(sc.statusTracker().getJobIdsForGroup(group))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(seen) == 1 and "rangepartitioning" not in seen[0] and "Sort" not in seen[0], seen
    assert not any(x in _plan(out) for x in ("Exchange", "Sort", "Window", "Join"))
    assert jobs <= 6
