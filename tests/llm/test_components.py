"""A node with very many edges."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from runlens.llm import components


@pytest.mark.parametrize("star", ["_large_star", "_small_star"])
def test_edges_of_one_node_can_be_split(spark, star):
    # node 0 or node 10**9 has nearly all edges
    hub = F.lit(0 if star == "_large_star" else 10**9).cast("long")
    edges = spark.range(1, 100_001, numPartitions=8).select(F.col("id").alias("u"), F.when(F.col("id") % 50 > 0, hub).otherwise(F.col("id") + 1).alias("v"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    conf |= {f"spark.sql.adaptive.{k}": v for k, v in (("skewJoin.skewedPartitionThresholdInBytes", "20k"), ("skewJoin.skewedPartitionFactor", "2"), ("advisoryPartitionSizeInBytes", "20k"), ("coalescePartitions.enabled", "false"))}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = getattr(components, star)(edges)
        out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
