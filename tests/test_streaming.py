import json
import os
import tempfile

from cohortlens.operators import requests as rq
from cohortlens.streaming.stream import request_stream, write_available


def test_request_stream_matches_batch(spark):
    src = tempfile.mkdtemp()
    rows = [{"request_id": i, "prompt": p} for i, p in enumerate(
        ["Generate 12 male patients over age 40 with diabetes", "10 women under 30", "patients over 50"])]
    with open(os.path.join(src, "part-0.json"), "w") as f:
        f.write("\n".join(json.dumps(r) for r in rows))
    sink = tempfile.mkdtemp()
    write_available(request_stream(spark, src), sink, "req-test", checkpoint=tempfile.mkdtemp())
    got = {r["request_id"]: r for r in spark.read.parquet(sink).collect()}
    batch = spark.createDataFrame([(r["request_id"], r["prompt"]) for r in rows], "request_id bigint, prompt string")
    want = {r["request_id"]: r for r in rq.normalize_requests(rq.parse_requests(batch, "prompt")).collect()}
    assert got.keys() == want.keys()
    for k in got:
        assert got[k].asDict() == want[k].asDict()
