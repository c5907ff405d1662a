"""Several outputs and the input position, all or none."""

import pytest
from pyspark.sql import functions as F

from orderflow.session import scratch_path
from orderflow.sinks import transaction
from orderflow.sinks.transaction import Ledger, atomic_batches
from orderflow.streaming.twins import run_available_now

SCHEMA = "id long"


def _split(batch):
    return {"even": batch.where("id % 2 = 0"), "odd": batch.where("id % 2 = 1")}


def _last(batch):
    return {"id": batch.agg(F.max("id")).first()[0]}


def _seen(ledger):
    return [sorted(r.id for r in ledger.read(n, SCHEMA).collect()) for n in ("even", "odd")]


def test_a_failure_between_two_writes_publishes_nothing_and_a_rerun_everything(spark):
    root = scratch_path(spark, "atomic")
    ledger = Ledger(spark, root)

    def dies(batch):
        out = _split(batch)
        return {"even": out["even"], "odd": out["odd"].withColumn("id", F.raise_error(F.lit("killed")).cast("long"))}

    atomic_batches(spark, root, _split, _last)(spark.range(4), 0)
    with pytest.raises(Exception, match="killed"):
        atomic_batches(spark, root, dies, _last)(spark.range(4, 10), 1)   # its first output is written already
    assert _seen(ledger) == [[0, 2], [1, 3]] and ledger.position() == {"id": 3}
    atomic_batches(spark, root, _split, _last)(spark.range(4, 10), 1)
    atomic_batches(spark, root, _split, _last)(spark.range(4, 10), 1)     # replayed
    assert _seen(ledger) == [[0, 2, 4, 6, 8], [1, 3, 5, 7, 9]] and ledger.position() == {"id": 9}


def test_a_failure_before_the_manifest_publishes_nothing(spark, monkeypatch):
    root = scratch_path(spark, "atomic-late")
    write = atomic_batches(spark, root, _split, _last)
    real = Ledger.publish
    monkeypatch.setattr(Ledger, "publish", lambda *a: (_ for _ in ()).throw(OSError("killed")))
    with pytest.raises(OSError):
        write(spark.range(6), 0)
    ledger = Ledger(spark, root)
    assert _seen(ledger) == [[], []] and ledger.position() is None
    monkeypatch.setattr(Ledger, "publish", real)
    write(spark.range(6), 0)
    assert _seen(ledger) == [[0, 2, 4], [1, 3, 5]]
    with pytest.raises(RuntimeError, match="another run"):
        ledger.publish(0, {}, {})


def test_readers_open_few_manifests(spark, monkeypatch):
    monkeypatch.setattr(transaction, "MERGE_EVERY", 4)
    root = scratch_path(spark, "atomic-many")
    ledger = Ledger(spark, root)
    for i in range(11):
        ledger.publish(i, {}, {"n": i})
    opened = []
    real = Ledger._read
    monkeypatch.setattr(Ledger, "_read", lambda self, b: opened.append(b) or real(self, b))
    assert [e["position"]["n"] for e in ledger.entries()] == list(range(11)) and len(opened) <= 4


def test_a_query_killed_between_two_writes_resumes(spark):
    src, root, ck = scratch_path(spark, "atomic-src"), scratch_path(spark, "atomic-q"), scratch_path(spark, "atomic-ck")
    for i in range(3):
        spark.range(10 * i, 10 * i + 10).coalesce(1).write.mode("append").parquet(src)
    alive = {"left": 1}

    def mortal(batch):
        if alive["left"] == 0:
            raise RuntimeError("killed")
        alive["left"] -= 1
        return _split(batch)

    def run():
        s = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
        run_available_now(s, "t-atomic", foreach=atomic_batches(spark, root, mortal, _last), checkpoint=ck)

    with pytest.raises(Exception, match="killed"):
        run()
    first = sum(_seen(Ledger(spark, root)), [])
    assert len(first) == 10
    alive["left"] = 100
    run()
    assert sorted(sum(_seen(Ledger(spark, root)), [])) == list(range(30))
