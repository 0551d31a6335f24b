"""Server products kept up to date run by run.

:func:`daypulse.plans.jobs.run_server_job` rebuilds every product from all
landed rows. Here a run reads the batches landed since the last one and the
state of the keys they touch:

* Payments and students: the latest row of each key is a state table in
  ``buckets`` parts by a hash of the key. A run merges the new rows into the
  buckets they fall into, and replaces these buckets' share of the product (sums
  by day and channel, counts by day): what a key added before is taken back and
  what it adds now is put in, so a purchase that moves to another day, or the
  greatest purchase number of a day, comes out as in a full run.
* Refunds and signups only add up: each run appends its sums as a part of its own.

Products are sums over shares, at most ``buckets`` rows a day and group. A run's
writes are new versions of parts, and one list (:class:`daypulse.sinks.commits.
Snapshots`) commits state, shares and the batches read at once: a run that died
changes nothing and is simply run again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daypulse.operators import commerce, logs
from daypulse.functions import labels
from daypulse.plans.jobs import landed_server_rows_of
from daypulse.sinks.commits import BATCH_COL, RUN_COL, Snapshots, batches, committed
from daypulse.sinks.tables import path_exists

PAYMENT_STATE = "purchase_number string, pay_channel string, total_price long, business_date date, date date, pay_time long"
STUDENT_STATE = "student_id long, date date"
REVENUE = "date date, pay_channel string, total_price long, purchase_number string"
STUDENTS = "date date, cnt long"
REFUNDS = "date date, status string, cnt long, refund_money long, purchase_money long"
SIGNUPS = "date date, class_name string, cnt long"


@dataclass
class IncrementalServer:
    """The tables of the job under one root, and its commits."""

    spark: SparkSession
    root: str
    buckets: int = 1024
    tz: str = "UTC"
    on_unknown: str = "label"

    def _at(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def _bucket(self, key: str):
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("long").alias("part")

    def run(self, landed: dict[str, str], manifest: str, stream: str = "server") -> dict[str, int]:
        """Take in what stage 1 has landed and listed in ``manifest`` since the
        last run. Returns how many buckets (and added parts) were replaced."""
        listed = Snapshots(self.spark, self._at("commits"))
        fresh = batches(self.spark, manifest, stream)
        done = listed.marks(stream)
        if done:
            last = F.create_map(*[F.lit(x) for r, b in done.items() for x in (r, b)])
            fresh = fresh.where(F.col(BATCH_COL) > F.coalesce(last[F.col(RUN_COL)], F.lit(-1)))
        marks = {(stream, r[RUN_COL]): r["b"] for r in fresh.groupBy(RUN_COL).agg(F.max(BATCH_COL).alias("b")).collect()}  # one row a run
        if not marks:
            return {}

        def new(route: str) -> DataFrame | None:
            return landed_server_rows_of(committed(self.spark.read.parquet(landed[route]), fresh)) if path_exists(
                self.spark, landed[route]) else None

        parts: dict[str, list[int]] = {}
        for route, step in (("payment", self._payments), ("student", self._students), ("refund", self._refunds), ("signup", self._signups)):
            rows = new(route)
            if rows is not None:
                parts |= step(listed, rows)
        listed.commit(parts, marks)
        return {t: len(p) for t, p in parts.items() if p}

    # -- keys whose latest row counts ------------------------------------
    def _merge(self, listed: Snapshots, name: str, schema: str, key: str, fresh: DataFrame, latest, share) -> dict[str, list[int]]:
        """Replace the touched buckets of a state table and of its shares."""
        fresh = fresh.withColumn("part", self._bucket(key))
        touched = [r["part"] for r in fresh.select("part").distinct().collect()]  # at most `buckets` numbers
        if not touched:
            return {}
        held = listed.read(name, self._at(name), schema, touched).withColumn("part", self._bucket(key))
        listed.write(latest(held.unionByName(fresh)), self._at(name))
        state = self.spark.read.schema(f"{schema}, part long, _version long").parquet(self._at(name)).where(
            (F.col("_version") == listed.version + 1) & F.col("part").isin(touched))
        listed.write(share(state), self._at(name + "_share"))
        return {name: touched, name + "_share": touched}

    def _payments(self, listed: Snapshots, rows: DataFrame) -> dict[str, list[int]]:
        fresh = logs.landed_payments(rows, self.tz).select(
            "purchase_number", labels.pay_channel_label("pay_channel", self.on_unknown).alias("pay_channel"),
            labels.cents_to_units("total_price").alias("total_price"), labels.business_date("pay_date", "date").alias("business_date"),
            "date", "pay_time")

        def latest(every: DataFrame) -> DataFrame:
            return commerce.latest_per_key(every, ["purchase_number", "part"], ("date", "pay_time"),
                                           ["pay_channel", "total_price", "business_date", "date", "pay_time"])

        def share(state: DataFrame) -> DataFrame:
            return state.groupBy("part", F.col("business_date").alias("date"), "pay_channel").agg(
                F.sum("total_price").alias("total_price"), F.max("purchase_number").alias("purchase_number"))

        return self._merge(listed, "payments", PAYMENT_STATE, "purchase_number", fresh, latest, share)

    def _students(self, listed: Snapshots, rows: DataFrame) -> dict[str, list[int]]:
        return self._merge(listed, "students", STUDENT_STATE, "student_id", logs.landed_students(rows),
                           lambda every: every.groupBy("student_id", "part").agg(F.max("date").alias("date")),
                           lambda state: state.groupBy("part", "date").agg(F.count("student_id").alias("cnt")))

    # -- sums that only grow ----------------------------------------------
    def _append(self, listed: Snapshots, name: str, found: DataFrame) -> dict[str, list[int]]:
        number = listed.version + 1
        listed.write(found.withColumn("part", F.lit(number).cast("long")), self._at(name))
        return {name: [number]}

    def _refunds(self, listed: Snapshots, rows: DataFrame) -> dict[str, list[int]]:
        return self._append(listed, "refunds", commerce.refund_by_status(logs.landed_refunds(rows), self.on_unknown))

    def _signups(self, listed: Snapshots, rows: DataFrame) -> dict[str, list[int]]:
        return self._append(listed, "signups", commerce.signup_by_class(logs.landed_signups(rows)))

    # -- products ------------------------------------------------------------
    def _read(self, name: str, schema: str) -> DataFrame:
        return Snapshots(self.spark, self._at("commits")).read(name, self._at(name), schema)

    def revenue(self) -> DataFrame:
        """A12, as ``revenue_by_channel`` of all landed payments."""
        return self._read("payments_share", REVENUE).groupBy("date", "pay_channel").agg(
            F.sum("total_price").alias("total_price"), F.max("purchase_number").alias("purchase_number"))

    def students(self) -> DataFrame:
        """A14, as ``students_by_day``."""
        return self._read("students_share", STUDENTS).groupBy("date").agg(F.sum("cnt").alias("cnt"))

    def refunds(self) -> DataFrame:
        """A11, as ``refund_by_status``."""
        return self._read("refunds", REFUNDS).groupBy("date", "status").agg(
            *[F.sum(c).alias(c) for c in ("cnt", "refund_money", "purchase_money")])

    def signups(self) -> DataFrame:
        """A13, as ``signup_by_class``."""
        return self._read("signups", SIGNUPS).groupBy("date", "class_name").agg(F.sum("cnt").alias("cnt"))
