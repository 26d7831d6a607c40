"""The stream of job states against the static query, over a restart."""

import pytest

from cliploom.streaming import jobs, state

FIELDS = ("state", "done", "error")


@pytest.fixture
def rocks(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, state.ROCKS)
    yield spark
    spark.conf.set(key, before)


def run(spark, source, checkpoint, seen, quiet=None):
    log = spark.readStream.schema("job string, at timestamp, state string, done string, error string").json(str(source))
    q = state.merged(log, FIELDS, quiet, late="1 second").writeStream.outputMode("update").option("checkpointLocation", str(checkpoint)).foreachBatch(lambda df, _: seen.extend(df.collect())).trigger(availableNow=True).start()
    q.awaitTermination(120)


def write(folder, name, rows):
    import json

    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in rows))


def test_same_rows_as_the_static_query_after_a_restart(rocks, tmp_path):
    at = lambda s: f"2024-01-01T00:00:{s:02d}.000Z"
    seen = []
    write(tmp_path / "in", "1.json", [{"job": "a", "at": at(1), "state": "loading"}, {"job": "a", "at": at(3), "done": "1"}, {"job": "b", "at": at(2), "state": "loading"}])
    run(rocks, tmp_path / "in", tmp_path / "check", seen)
    write(tmp_path / "in", "2.json", [{"job": "a", "at": at(2), "done": "0", "state": "running"}, {"job": "b", "at": at(9), "error": "no", "state": "error"}, {"job": "c", "at": at(4), "done": "7"}])
    run(rocks, tmp_path / "in", tmp_path / "check", seen)
    last = {r["job"]: tuple(r[f] for f in FIELDS) for r in seen}
    log = rocks.read.schema("job string, at timestamp, state string, done string, error string").json(str(tmp_path / "in"))
    assert last == {r["job"]: tuple(r[f] for f in FIELDS) for r in jobs.latest(log, FIELDS).collect()} == {"a": ("running", "1", None), "b": ("error", None, "no"), "c": (None, "7", None)}


def test_a_silent_job_is_lost(rocks, tmp_path):
    at = lambda m: f"2024-01-01T00:{m:02d}:00.000Z"
    seen = []
    for n, rows in enumerate([[{"job": "a", "at": at(1), "state": "running"}, {"job": "b", "at": at(1), "state": "done"}], [{"job": "c", "at": at(30), "state": "running"}], [{"job": "c", "at": at(31), "done": "1"}]]):
        write(tmp_path / "in", f"{n}.json", rows)
        run(rocks, tmp_path / "in", tmp_path / "check", seen, quiet="60")
    assert [r["job"] for r in seen if r["state"] == "lost"] == ["a"]
    assert {r["job"]: r["state"] for r in seen} == {"a": "lost", "b": "done", "c": "running"}
