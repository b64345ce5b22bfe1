"""Scratch output goes under the session's checkpoint folder."""

from __future__ import annotations

from quadra.session import fresh_path, scratch_root


def test_scratch_root_reads_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    root = scratch_root(spark)
    assert root
    if configured:
        assert root == configured.rstrip("/")
    a, b = fresh_path(spark, "x"), fresh_path(spark, "x")
    assert a != b and a.startswith(root + "/quadra/x-")
