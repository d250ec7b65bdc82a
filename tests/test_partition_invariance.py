"""Results do not depend on the number of shuffle partitions."""

from skytrace.plans import registry as R

SF = "/root/testdata/sf0.001"


def test_partition_invariance(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    res = {}
    try:
        for parts in ("1", "64"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            for name in ("decode_quality", "pack_sizes", "latest_state", "thin_48h", "buffer_readout"):
                df = R.queries()[name](spark, SF)
                res.setdefault(name, []).append(sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    for name, (a, b) in res.items():
        assert a == b and len(a) > 0, name
