"""series_pivot: the rows of a message from its long signals, grouped after one exchange."""

from skytrace.operators.reshape import series_pivot


def test_pivot_groups_whole_rows_after_the_exchange(spark):
    """No table by field, and none before rows are spread by (device_id, idx)."""
    series = spark.createDataFrame([(d, "DOP", f, i, float(i) if f != "gDOP" else None) for d in (1, None) for i in range(20)
                                    for f in ("_timestamp", "gDOP", "pDOP")], "device_id long, message string, field string, idx long, value double")
    out = series_pivot(series, "NAV_DOP")
    got = {(r.device_id, r.idx): (r._timestamp, r.gDOP, r.pDOP, r.tDOP) for r in out.collect()}
    assert got == {(d, i): (float(i), None, float(i), None) for d in (1, None) for i in range(20)}
    plan = out._jdf.queryExecution().sparkPlan().toString()
    below = plan[plan.index("RepartitionByExpression"):] if "RepartitionByExpression" in plan else plan[plan.index("Exchange"):]
    assert "pivotfirst" not in plan.lower() and "Aggregate" not in below
