"""Bookmarked runs: one batch of all sources, begun and committed as a whole."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from tidewright import Job
from tidewright.errors import JobError
from tidewright.sources.listing import list_files
from tidewright.streaming import ledger as ledgers
from tidewright.streaming.ledger import Ledger


def drop(spark, folder, start, end):
    spark.range(start, end).coalesce(1).write.mode("append").parquet(folder)


def two_sources(folder, broken=None, **sink):
    """A job that pairs two followed sources; ``broken`` is called with the frames before they are written."""

    def check(spark, frames):
        if broken:
            broken(frames)
        return frames["left"].select("id", F.lit("left").alias("of")).union(frames["right"].select("id", F.lit("right").alias("of")))

    return Job.from_dict({
        "sources": [{"name": n, "source_type": "file", "path": f"{folder}/{n}"} for n in ("left", "right")],
        "transforms": [{"transform_type": "custom", "function": check}],
        "sink": {"sink_type": "file", "path": f"{folder}/out", "mode": "append", **sink},
        "bookmark": "enabled", "state_path": f"{folder}/state",
    })


def written(spark, folder):
    return sorted((r.of, r.id) for r in spark.read.parquet(f"{folder}/out").collect())


def test_a_batch_of_two_sources_is_repeated_whole(spark, folder):
    drop(spark, f"{folder}/left", 0, 2)
    drop(spark, f"{folder}/right", 10, 12)
    with pytest.raises(ZeroDivisionError):
        two_sources(folder, lambda frames: 1 / 0).run(spark)
    # What arrives now is not part of the batch that was begun.
    drop(spark, f"{folder}/right", 12, 13)
    seen = []
    two_sources(folder, lambda frames: seen.append({n: sorted(r.id for r in f.collect()) for n, f in frames.items()})).run(spark)
    assert seen == [{"left": [0, 1], "right": [10, 11]}, {"left": [], "right": [12]}]
    assert written(spark, folder) == [("left", 0), ("left", 1), ("right", 10), ("right", 11), ("right", 12)]
    seen.clear()
    two_sources(folder, lambda frames: seen.append(1)).run(spark)
    assert seen == [] and Ledger(spark, f"{folder}/state").pending() is None


def test_a_run_cut_off_after_writing_writes_the_same_files_again(spark, folder, monkeypatch):
    drop(spark, f"{folder}/left", 0, 2)
    drop(spark, f"{folder}/right", 10, 11)

    def cut(self):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(Ledger, "commit", cut)
        with pytest.raises(KeyboardInterrupt):
            two_sources(folder, mode="overwrite").run(spark)
    drop(spark, f"{folder}/left", 5, 6)
    frames = []
    two_sources(folder, lambda f: frames.append(f["left"].count()), mode="overwrite").run(spark)
    assert frames == [2, 1] and written(spark, folder) == [("left", 5)]


def test_a_run_cut_off_before_its_batch_is_in_place_leaves_no_trace(spark, folder, monkeypatch):
    drop(spark, f"{folder}/left", 0, 1)
    drop(spark, f"{folder}/right", 1, 2)

    def cut(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(ledgers, "rename_once", cut)
        with pytest.raises(KeyboardInterrupt):
            two_sources(folder).run(spark)
    assert Ledger(spark, f"{folder}/state").pending() is None
    two_sources(folder).run(spark)
    assert written(spark, folder) == [("left", 0), ("right", 1)]


def test_two_runs_at_a_time_are_refused(spark, folder):
    files = spark.sql("select 's' as source, 'file:/a' as path, 1L as length, timestamp'2024-01-01' as modified")
    first, second = Ledger(spark, f"{folder}/state"), Ledger(spark, f"{folder}/state")
    assert first.begin(files).count() == 1
    with pytest.raises(JobError, match="another run"):
        second.begin(files)
    first.commit()
    with pytest.raises(Exception):
        second.commit()
    assert first.begin(files.where("false")) is None
    assert sorted(os.listdir(f"{folder}/state/done")) == ["run-1"]


def test_manifests_are_put_together(spark, folder, monkeypatch):
    monkeypatch.setattr(ledgers, "LOOSE_RUNS", 2)
    ledger = Ledger(spark, f"{folder}/state")
    for n in range(7):
        ledger.begin(spark.sql(f"select 's' as source, 'file:/{n}' as path, 1L as length, timestamp'2024-01-01' as modified"))
        ledger.commit()
        assert sorted(r.path for r in ledger.seen().collect()) == [f"file:/{i}" for i in range(n + 1)]
    assert len(os.listdir(f"{folder}/state/done")) <= 3


def test_listing(spark, folder):
    names = ["a/x.json", "a/b/y [1] {2}.json", "a/p=1%3A/z.csv", "a/_p=1/q.csv", "c.json", "a/ä ö.json"]
    for name in [*names, "a/.hidden", "a/_SUCCESS", "a/_temporary/0/part", ".h/x"]:
        os.makedirs(os.path.dirname(f"{folder}/in/{name}"), exist_ok=True)
        with open(f"{folder}/in/{name}", "w") as file:
            file.write("12345")
    rows = list_files(spark, f"{folder}/in").collect()
    assert sorted(r.path for r in rows) == sorted(f"file:{folder}/in/{name}" for name in names)
    assert {r.length for r in rows} == {5} and all(isinstance(r.modified, datetime.datetime) for r in rows)
    for glob, expected in [
        ("in/*.json", ["c.json"]), ("in/a", names[:4] + names[5:]), ("in/c.json", ["c.json"]), ("in/{a,c}/b", ["a/b/y [1] {2}.json"]),
        ("in/?/[a-cx].json", ["a/x.json"]), ("in/a/[!x]*.json", ["a/ä ö.json"]), ("in/*", names), ("in/a/p=1%3A", ["a/p=1%3A/z.csv"]),
    ]:
        found = sorted(r.path for r in list_files(spark, f"{folder}/{glob}").collect())
        assert found == sorted(f"file:{folder}/in/{name}" for name in expected), glob
    os.makedirs(f"{folder}/empty")
    assert list_files(spark, f"{folder}/empty").collect() == []


def test_listing_is_sparks_own_where_tasks_have_no_way_in(spark, folder, monkeypatch):
    drop(spark, f"{folder}/in", 0, 3)
    from tidewright.sources import listing

    own = [(r.path, r.length) for r in list_files(spark, f"{folder}/in").collect()]
    monkeypatch.setattr(listing, "_tasks_can_open", lambda path: False)
    assert [(r.path, r.length) for r in list_files(spark, f"{folder}/in").collect()] == own


def test_of_a_hundred_thousand_files_only_new_names_reach_the_driver(spark, folder, monkeypatch):
    """All but three are in the ledger already; the driver is handed those three."""
    os.makedirs(f"{folder}/in")
    for n in range(100_000):
        os.close(os.open(f"{folder}/in/{n}.json", os.O_CREAT | os.O_WRONLY))
    for n in (7, 50_000, 99_999):
        with open(f"{folder}/in/{n}.json", "w") as file:
            file.write(f'{{"n": {n}}}')
    ledger = Ledger(spark, f"{folder}/state")
    names = spark.range(100_000).where("id not in (7, 50000, 99999)")
    ledger.begin(names.selectExpr("'s' as source", f"concat('file:{folder}/in/', id, '.json') as path", "0L as length",
                                  "timestamp'2024-01-01' as modified"))
    ledger.commit()
    handed = []
    frame = type(spark.range(1))
    for method in ("collect", "toLocalIterator", "toPandas", "first"):
        def counted(self, *args, _own=getattr(frame, method), **kwargs):
            found = _own(self, *args, **kwargs)
            found = list(found) if not hasattr(found, "asDict") and found is not None else found
            handed.append(len(found) if isinstance(found, list) else 1)
            return iter(found) if _own.__name__ == "toLocalIterator" else found

        monkeypatch.setattr(frame, method, counted)
    Job.from_dict({
        "sources": [{"name": "s", "source_type": "file", "path": f"{folder}/in", "format": "json", "schema": "n int"}],
        "sink": {"sink_type": "file", "path": f"{folder}/out", "mode": "append"},
        "bookmark": "enabled", "state_path": f"{folder}/state",
    }).run(spark)
    monkeypatch.undo()
    assert sorted(r.n for r in spark.read.parquet(f"{folder}/out").collect()) == [7, 50_000, 99_999]
    assert sum(handed) < 20, handed
