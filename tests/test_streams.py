"""A table that streams keep, over several runs."""

import shutil

from voxloom.streaming import resume


def test_runs_take_what_is_new(spark, tmp_path):
    source, target, checkpoint = (f"file://{tmp_path}/{x}" for x in ("in", "table", "stream"))
    schema, want = "k int, at int, v string", {}

    def run(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        for k, at, v in rows:
            want[k] = max(want.get(k, (-1, "")), (at, v))
        resume.take_new(spark, source, spark.createDataFrame([], schema).schema, target, checkpoint, ["k"], ["at"], buckets=8)
        assert {r.k: (r.at, r.v) for r in resume.current(spark, target).collect()} == want

    run([(i, 0, "a") for i in range(40)])
    run([(3, 2, "b"), (3, 1, "old"), (99, 0, "new")])
    run([(3, 1, "late")])
    resume.take_new(spark, source, spark.createDataFrame([], schema).schema, target, checkpoint, ["k"], ["at"], buckets=8)
    assert {r.k: (r.at, r.v) for r in resume.current(spark, target).collect()} == want
    # The last batch is lost, and runs again.
    for kind in ("commits",):
        last = max((tmp_path / "stream" / kind).iterdir(), key=lambda p: int(p.name) if p.name.isdigit() else -1)
        last.unlink()
        (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    run([(5, 9, "again")])
    versions = {p.name for p in (tmp_path / "table" / "list").iterdir()}
    assert len(versions) <= 2
    shutil.rmtree(tmp_path / "stream")
