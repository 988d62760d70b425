"""Single-pass jobs, batches that are broken off between sinks, and archives whose days are replaced."""

import json

import pytest
from pyspark.sql import functions as F

from secflow.operators.archive import write_archive
from secflow.operators.stats import filter_counts, filter_stats, pipeline_stats
from secflow.operators.scripts import apply_scripts
from secflow.plans.flows import filter_job, filter_rows, sent
from secflow.streaming.batches import Batch, batch_folder, deliver_stream
from secflow.streaming.jobs import Refreshing

SCRIPTS = [("odd", "return (event, event['n'] % 2 == 1)")]


def values(spark, n=20):
    rows = [json.dumps({"n": i}) if i % 5 else f"broken {i}" for i in range(n)]
    return spark.createDataFrame([(x,) for x in rows], "value string")


def test_scripts_run_once_in_the_plan(spark):
    result, _ = filter_job(values(spark), SCRIPTS, "ok")
    assert result._jdf.queryExecution().executedPlan().toString().count("MapInPandas") == 1
    rows = {(r["topic"], r["value"]) for r in result.collect()}
    assert ("ok", '{"n":1}') in rows and ("error", '{"raw":"broken 5","stacktrace":"JSONDecodeError: Expecting value: line 1 column 1 (char 0)"}') in rows
    assert len(rows) == 8 + 4
    marked, kept = filter_rows(values(spark), SCRIPTS, "ok"), apply_scripts(values(spark), SCRIPTS)
    assert filter_counts(marked).collect() == filter_stats(kept).collect()


def test_a_batch_broken_off_between_two_sinks(spark, tmp_path):
    """The job runs once, sinks that have ended get nothing twice, and all see the rows of the first run."""
    source, out = tmp_path / "in", str(tmp_path / "out")
    values(spark).coalesce(1).write.text(str(source))
    runs, calls, broken = [], [], {"search": True}

    def job(batch, version):
        runs.append(version)
        return filter_rows(batch, SCRIPTS, f"topic{version}")

    def first(rows, batch_id):
        calls.append("first")
        batch_folder(f"{out}/first", sent)(rows, batch_id)

    def second(rows, batch_id):
        calls.append("second")
        batch_folder(f"{out}/second", sent)(rows, batch_id)  # written, but broken off before it is marked
        if broken["search"]:
            raise RuntimeError("the sink is gone")

    versions = iter((1, 2))
    sinks = {"first": first, "second": second, "counts": batch_folder(f"{out}/counts", filter_counts)}

    def start():
        stream = spark.readStream.text(str(source))
        query = deliver_stream(stream, job, {"version": Refreshing(lambda: next(versions), ttl=0)}, sinks, f"{out}/log", f"{out}/checkpoint",
                               by="state", available_now=True)
        query.awaitTermination()

    with pytest.raises(Exception, match="the sink is gone"):
        start()
    broken["search"] = False
    start()
    assert runs == [1] and calls == ["first", "second", "second"]
    read = lambda name: spark.read.parquet(f"{out}/{name}").drop("batch")
    assert read("first").collect() and sorted(read("first").collect()) == sorted(read("second").collect())
    assert {r["topic"] for r in read("second").collect()} == {"topic1", "error"}
    assert [tuple(r) for r in read("counts").collect()] == [(8, 8)]


def test_a_step_that_never_ended_is_not_done(spark, tmp_path):
    batch = Batch(spark, str(tmp_path), 3)
    assert not batch.done("staged")
    batch.stage(lambda: spark.range(4).withColumn("state", F.when(F.col("id") < 3, "a").otherwise("b")), by="state")
    assert batch.done("staged") and Batch(spark, str(tmp_path), 3).rows().count() == 4
    seen = []
    for _ in range(2):
        batch.deliver("x", lambda rows, n: seen.append((n, rows.where("state = 'a'").count())))
    assert seen == [(3, 3)] and not Batch(spark, str(tmp_path), 4).done("staged")


def test_statistics_of_staged_states(spark, tmp_path):
    rows = spark.createDataFrame([("o", "d", "c", "s", "raw", "v1", 5), ("o", "d", "c", "s", "error", "vv", 5)],
                                 "organization string, dev_type string, collector_host string, source_host string, state string, value string, event_time long")
    batch = Batch(spark, str(tmp_path), 0)
    batch.stage(lambda: rows, by="state")
    wanted = sorted(map(tuple, pipeline_stats(rows, F.lit(3)).collect()))
    assert sorted(map(tuple, pipeline_stats(batch.rows(), F.lit(3)).collect())) == wanted


def test_a_day_archived_again_replaces_itself(spark, tmp_path):
    path, day = str(tmp_path), 86400
    rows = spark.range(300).select("id", F.concat(F.lit("o"), F.col("id") % 2).alias("org"), (F.col("id") % 3 * day + F.col("id")).alias("t"))
    for _ in range(2):
        write_archive(rows, path, "org", "t", "overwrite", "parquet")
    write_archive(rows.where(f"t >= {day} and t < {2 * day}").withColumn("id", F.col("id") + 1000), path, "org", "t", "overwrite", "parquet")
    back = spark.read.parquet(path)
    assert back.count() == 300 and back.where("id >= 1000").count() == back.where("sys_day = 2").count() == 100
    found = back.where("sys_day = 1 and t > 250")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(sys_day" in plan and "PushedFilters: [IsNotNull(t), GreaterThan(t,250)]" in plan
    # Sorted by time: the row groups of a file tell their range.
    import pyarrow.parquet as pq
    for file in tmp_path.rglob("*.parquet"):
        times = pq.read_table(file, columns=["t"], partitioning=None)["t"].to_pylist()
        assert times == sorted(times)
