import pyarrow as pa

from citeloom.llm import common


def test_portions_hold_every_row_within_bounds():
    texts = ["x" * n for n in (5, 5, 30, 0, 4, 4, 4, 100, 1)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(10)), pa.array(texts)], ["i", "t"])
    parts = list(common.portions(batch, 3, 12))
    assert [x for p in parts for x in p.column(0).to_pylist()] == list(range(10))
    for p in parts:
        assert p.num_rows <= 3
        assert p.num_rows == 1 or sum(len(t or "") for t in p.column(1).to_pylist()) <= 12
    assert list(common.portions(batch.slice(0, 0), 3)) == []


def test_checkpoints_use_the_configured_folder(spark):
    common.ensure_checkpoints(spark)
    first = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    common.ensure_checkpoints(spark)
    assert spark.sparkContext._jsc.sc().getCheckpointDir().get() == first
    assert common.cut(spark.range(3)).count() == 3
