"""Plan shape: framing, classification and decoding are narrow and prune columns."""

from skytrace.plans import registry as R

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_decode_is_narrow_and_pruned(spark):
    df = R.queries()["decode_pvt"](spark, SF).select("device_id", "lon")
    plan = _plan(df)
    assert "Exchange" not in plan
    assert "ReadSchema: struct<device_id:bigint,protocol:string,body:binary,status:string>" in plan


def test_report_aggregates_partially(spark):
    plan = _plan(R.queries()["decode_quality"](spark, SF))
    assert plan.count("HashAggregate") >= 2  # partial (map side) + final


def test_latest_n_uses_group_limit(spark):
    plan = _plan(R.queries()["latest_n"](spark, SF))
    assert "WindowGroupLimit" in plan


def test_clustered_frames_need_no_exchange(spark):
    for name in ("elapsed_us_clustered", "latest_n_clustered"):
        plan = _plan(R.queries()[name](spark, SF))
        assert "Exchange" not in plan or "BroadcastExchange" in plan and "Exchange hashpartitioning" not in plan, name
        assert "Bucketed: true" in plan


def test_latest_state_decodes_once(spark):
    """The scan over physical ranges reads written rows; no window over frames, whatever their sequence numbers."""
    plan = _plan(R.queries()["latest_state_all"](spark, SF))
    assert "ArrowEvalPython" not in plan and "Exchange rangepartitioning" not in plan
