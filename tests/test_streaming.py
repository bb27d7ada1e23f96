"""The streaming log preparation gives the same rows as the batch one."""

import tempfile

from riskfeat.functions.timeparts import with_time_parts
from riskfeat.sources import fixtures
from riskfeat.streaming import append_to_table, stream_log

SF = "/root/testdata/sf0.001"


def test_stream_matches_batch(spark):
    root = tempfile.mkdtemp(prefix="riskfeat-stream-")
    op = fixtures.op_log(spark, SF)
    op.write.parquet(f"{root}/in")
    q = append_to_table(stream_log(spark, f"{root}/in", op.schema), f"{root}/out", f"{root}/ckpt")
    q.awaitTermination(120)
    got = spark.read.parquet(f"{root}/out").select("row_id", "days_diff", "hour", "band")
    want = with_time_parts(op).select("row_id", "days_diff", "hour", "band")
    assert got.count() == want.count() == 1000
    assert got.exceptAll(want).count() == 0
