"""One commit for several targets, and server products kept up to date by runs
that read new batches and touched keys only."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from daypulse.operators import commerce, logs
from daypulse.plans import incremental
from daypulse.plans.jobs import landed_server_rows
from daypulse.sinks import commits
from daypulse.sources.streams import read_log_stream
from daypulse.streaming import ingest

DAY = dt.date(2024, 1, 1)


def line(day, **fields):
    return f"{DAY + dt.timedelta(days=day)} 00:00:00.000 " + json.dumps(fields)


def pay(number, day, price=1000, channel=2, paid=None):
    ms = None if paid is None else int((dt.datetime(2024, 1, 1) + dt.timedelta(days=paid) - dt.datetime(1970, 1, 1)).total_seconds() * 1000)
    return line(day, actionType="pay", purchaseNumber=number, totalPrice=price, payChannel=channel, payTime=ms)


class Landing:
    """Server lines through the landing stream, one file at a time."""

    def __init__(self, spark, tmp_dir):
        self.spark, self.dir, self.n = spark, tmp_dir, 0
        self.targets = ingest.IngestTargets(*[f"{tmp_dir}/{n}" for n in ("client", "pay", "ref", "stu", "sig")],
                                            manifest=f"{tmp_dir}/manifest", client_table=None)
        for name in ("server_in", "client_in"):
            os.makedirs(f"{tmp_dir}/{name}")

    def write(self, lines, folder="server_in"):
        self.n += 1
        with open(f"{self.dir}/{folder}/{self.n:03d}.txt", "w") as f:
            f.write("\n".join(lines) + "\n")

    def go(self, fails=False):
        streams = [read_log_stream(self.spark, "text", path=f"{self.dir}/{n}", max_per_trigger=1) for n in ("client_in", "server_in")]
        failed = []
        for q in ingest.start_ingest(*streams, self.targets, f"{self.dir}/ckpt", trigger={"availableNow": True}):
            try:
                q.awaitTermination(180)
            except Exception as e:  # noqa: BLE001 - the planted failure
                failed.append(str(e))
        assert bool(failed) == fails, failed

    def land(self, *files):
        for f in files:
            self.write(f)
        self.go()

    def seen(self, target, stream="server"):
        """What a reader of listed batches sees."""
        if not os.path.exists(target):
            return []
        return commits.committed(self.spark.read.parquet(target), commits.batches(self.spark, self.targets.manifest, stream)).collect()


def test_failure_between_targets_is_invisible_and_healed(spark, tmp_dir, monkeypatch):
    at = Landing(spark, tmp_dir)
    at.land([pay("p1", 0), line(0, actionType="refund_apply", purchaseId=1, money=100, purchaseMoney=900)])
    assert len(at.seen(at.targets.payment)) == len(at.seen(at.targets.refund)) == 1
    at.write([pay("p2", 1), line(1, actionType="refund_apply", purchaseId=2, money=100, purchaseMoney=900)])
    write = ingest.write_table

    def dies(rows, target, **options):
        if target == at.targets.refund:
            raise RuntimeError("lost between two targets")
        write(rows, target, **options)

    monkeypatch.setattr(ingest, "write_table", dies)
    at.go(fails=True)
    assert spark.read.parquet(at.targets.payment).count() == 2  # written, not listed
    assert [r.purchaseNumber for r in at.seen(at.targets.payment)] == ["p1"] and len(at.seen(at.targets.refund)) == 1
    monkeypatch.undo()
    at.go()
    assert sorted(r.purchaseNumber for r in at.seen(at.targets.payment)) == ["p1", "p2"]
    assert sorted(r.purchaseId for r in at.seen(at.targets.refund)) == [1, 2]
    assert commits.batches(spark, f"{tmp_dir}/none", "server").count() == 0


def test_two_targets_of_the_client_rows(spark, tmp_dir):
    at = Landing(spark, tmp_dir)
    at.targets.client_table = "client_rows_committed"
    at.write([json.dumps({"t": 1704067200000 + k, "_id": "s", "appId": 1, "url": "u", "uid": "x"}) for k in range(3)], "client_in")
    at.go()
    listed = commits.batches(spark, at.targets.manifest, "client")
    assert commits.committed(spark.table("client_rows_committed"), listed).count() == len(at.seen(at.targets.client, "client")) == 3
    spark.sql("DROP TABLE client_rows_committed")


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def assert_products(spark, job, at):
    """The products equal those of all landed rows."""
    of = {n: landed_server_rows(spark, t) for n, t in at.targets.server_routes().items()}
    for got, want in ((job.revenue(), commerce.revenue_by_channel(logs.landed_payments(of["payment"]))),
                      (job.students(), commerce.students_by_day(logs.landed_students(of["student"]))),
                      (job.refunds(), commerce.refund_by_status(logs.landed_refunds(of["refund"]))),
                      (job.signups(), commerce.signup_by_class(logs.landed_signups(of["signup"])))):
        assert rows(got, *want.columns) == rows(want, *want.columns)


def some_lines(seed):
    r = random.Random(seed)
    out = [pay(f"p{r.randrange(12)}", r.randrange(6), r.randrange(100, 9999), r.choice([2, 43, 1, 777]), r.choice([None, 0, 3, 5]))
           for _ in range(15)]
    out += [line(r.randrange(6), actionType="student_add", studentId=r.randrange(9)) for _ in range(8)]
    out += [line(r.randrange(6), actionType=r.choice(["refund_apply", "refund_success"]), purchaseId=k, money=150, purchaseMoney=990)
            for k in range(5)]
    return out + [line(1, actionType="signup_class", purchaseId=k, purchaseClassNames=["math", "art"][: k + 1]) for k in range(2)]


def test_three_runs_equal_one_full_run(spark, tmp_dir):
    at = Landing(spark, tmp_dir)
    job = incremental.IncrementalServer(spark, f"{tmp_dir}/job", buckets=16)
    assert job.run(at.targets.server_routes(), at.targets.manifest) == {} and job.revenue().collect() == []
    at.land(some_lines(1), some_lines(2))
    job.run(at.targets.server_routes(), at.targets.manifest)
    assert_products(spark, job, at)
    # 'moved' is paid on day 2, then again later: it leaves its day, where it was the greatest number
    at.land([pay("zz-moved", 2, 5000, 2, 2)])
    assert job.run(at.targets.server_routes(), at.targets.manifest)["payments"] == 1
    assert ("zz-moved",) in rows(job.revenue(), "purchase_number")
    at.land([pay("zz-moved", 4, 700, 1, 4), line(5, actionType="student_add", studentId=3)])
    replaced = job.run(at.targets.server_routes(), at.targets.manifest)
    assert replaced["payments"] == replaced["payments_share"] == replaced["students"] == 1  # one key, one bucket
    assert_products(spark, job, at)
    assert {r.date for r in job.revenue().where("purchase_number = 'zz-moved'").collect()} == {DAY + dt.timedelta(days=4)}
    assert job.run(at.targets.server_routes(), at.targets.manifest) == {}  # nothing new: nothing is read
    once = incremental.IncrementalServer(spark, f"{tmp_dir}/once", buckets=4)
    once.run(at.targets.server_routes(), at.targets.manifest)
    assert_products(spark, once, at)


def test_a_run_that_died_changes_nothing(spark, tmp_dir, monkeypatch):
    at = Landing(spark, tmp_dir)
    job = incremental.IncrementalServer(spark, f"{tmp_dir}/job", buckets=8)
    at.land(some_lines(3))
    job.run(at.targets.server_routes(), at.targets.manifest)
    before = rows(job.revenue(), "date", "pay_channel", "total_price")
    at.land(some_lines(4))
    monkeypatch.setattr(commits.Snapshots, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("died")))
    with pytest.raises(RuntimeError):
        job.run(at.targets.server_routes(), at.targets.manifest)
    monkeypatch.undo()
    assert rows(job.revenue(), "date", "pay_channel", "total_price") == before
    at.land(some_lines(5))
    job.run(at.targets.server_routes(), at.targets.manifest)
    assert_products(spark, job, at)


def test_a_run_reads_new_batches_and_touched_buckets(spark, tmp_dir):
    at = Landing(spark, tmp_dir)
    job = incremental.IncrementalServer(spark, f"{tmp_dir}/job", buckets=16)
    at.land(some_lines(6))
    job.run(at.targets.server_routes(), at.targets.manifest)
    listed = commits.Snapshots(spark, f"{tmp_dir}/job/commits")
    some = sorted(listed.parts("payments"))[:2]
    read = listed.read("payments", f"{tmp_dir}/job/payments", incremental.PAYMENT_STATE, some)
    assert {f.split("part=")[1].split("/")[0] for f in {r.f for r in read.select(F.input_file_name().alias("f")).collect()}} <= set(map(str, some))
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
