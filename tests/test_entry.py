"""Driver contract: entry() runs on sf0.001; every query has an oracle with the same key."""

import importlib.util
import os
import re

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _entry_module():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(HERE, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_keys_match():
    se = _entry_module()
    q, o = se.queries(), se.oracle_sql()
    own = {k for k in q if k != "pipeline" and not re.match(r"op\d+_", k)}  # the optional subpackage adds the others
    assert own == {k for k in o if k in own} and set(o) <= set(q) and len(own) >= 60


def test_entry_runs(spark):
    df = _entry_module().entry(spark)
    assert df.columns == ["device_id", "protocol", "message", "parse_result", "frames"]
    rows = df.collect()
    assert sum(r.frames for r in rows) == 1000
