"""Server-side facts: latest value per key (A7), refunds (A11), revenue
(A12), signups (A13), new students (A14), keep-one dedup (A16) and the
class relation star join (J6).

"Latest"/"first" always means a total order given by the caller (event
time, then unique tie-break columns), so results do not depend on the
order rows arrive in. They are grouped ``max``/``min`` over one row struct
(order fields first) — combined on the map side, so a key that holds a
third of all rows never lands whole in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daypulse.functions import labels


def _pick(df: DataFrame, keys, order, values, fn) -> DataFrame:
    # One struct (order..., values...) compared field by field: the order
    # decides, the values break any remaining tie, so the pick is total.
    row = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                   *[F.col(c).alias(f"_v{i}") for i, c in enumerate(values)])
    return (df.groupBy(*keys).agg(fn(row).alias("_r"))
            .select(*keys, *[F.col(f"_r._v{i}").alias(c) for i, c in enumerate(values)]))


def latest_per_key(df: DataFrame, keys, order, values) -> DataFrame:
    """The values of the row with the greatest ``order`` per key."""
    return _pick(df, keys, order, values, F.max)


def first_per_key(df: DataFrame, keys, order, values) -> DataFrame:
    """Keep one row per key — the one with the smallest ``order``."""
    return _pick(df, keys, order, values, F.min)


def revenue_by_channel(payments: DataFrame, order=("date", "pay_time"), on_unknown: str = "label") -> DataFrame:
    """Latest row per purchase (by ``order``), then revenue (whole units, truncated
    per row as P10) per business day and channel, with the greatest
    purchase number of the group as a sample."""
    rows = payments.select(
        "purchase_number", *order,
        labels.pay_channel_label("pay_channel", on_unknown).alias("pay_channel"),
        labels.cents_to_units("total_price").alias("total_price"),
        labels.business_date("pay_date", "date").alias("business_date"))
    latest = latest_per_key(rows, ["purchase_number"], order,
                            ["pay_channel", "total_price", "business_date"])
    return (latest.groupBy(F.col("business_date").alias("date"), "pay_channel")
            .agg(F.sum("total_price").alias("total_price"),
                 F.max("purchase_number").alias("purchase_number")))


def refund_by_status(refunds: DataFrame, on_unknown: str = "label") -> DataFrame:
    """A11 (+P3, P8, P10): refund rows per day and status label."""
    rows = refunds.filter(F.col("action_type").isin(*labels.REFUND_ACTIONS))
    return (rows.groupBy("date", labels.refund_action_status("action_type", on_unknown).alias("status"))
            .agg(F.count("purchase_id").alias("cnt"),
                 F.sum(labels.cents_to_units("money")).alias("refund_money"),
                 F.sum(labels.cents_to_units("purchase_money")).alias("purchase_money")))


def signup_by_class(signups: DataFrame, names_col: str = "class_names") -> DataFrame:
    """A13 (+P12): one row per class name of a signup, counted per day and
    class. A null or empty list gives no rows."""
    return (signups.select("date", "purchase_id", F.explode(names_col).alias("class_name"))
            .groupBy("date", "class_name").agg(F.count("purchase_id").alias("cnt")))


def students_by_day(students: DataFrame) -> DataFrame:
    """Each student counted once, on the last day seen."""
    last = students.groupBy("student_id").agg(F.max("date").alias("date"))
    return last.groupBy("date").agg(F.count("student_id").alias("cnt"))


def dedup_payments(payments: DataFrame, order=("date", "pay_time")) -> DataFrame:
    """One payment per purchase number (the first by ``order``)."""
    return first_per_key(payments, ["purchase_number"], order,
                         ["pay_channel", "total_price", "pay_date", "date"])


def dedup_refunds(refunds: DataFrame) -> DataFrame:
    """One refund row per (purchase, action); order by day, status and
    amounts, i.e. by the whole row, so equal keys pick the same row."""
    rows = refunds.filter(F.col("action_type").isin(*labels.REFUND_ACTIONS))
    return first_per_key(rows, ["purchase_id", "action_type"],
                         ["date", "status", "money", "purchase_money"],
                         ["status", "money", "purchase_money", "date"])


def class_relation(class_info: DataFrame, course: DataFrame, class_grade: DataFrame, grade: DataFrame,
                   subject: DataFrame, class_teacher: DataFrame, user: DataFrame) -> DataFrame:
    """Every class that is not deleted with its course, grades, subject
    and teachers; one row per (class, grade, teacher). Names are joined with
    the open code and the teacher's mobile number (null if a part is null).

    Which side is broadcast is left to AQE and the measured sizes; the filter
    and the column lists reach the scans.
    """
    ci = (class_info.filter(F.col("is_del") == 0)
          .select("id", "course_id", F.concat("name", "open_code").alias("class_name")))
    c = course.select(F.col("id").alias("course_id"), "subject_id", F.col("name").alias("course_name"), "year", "season")
    cg = class_grade.select(F.col("class_id").alias("id"), "grade_id")
    g = grade.select(F.col("id").alias("grade_id"), F.col("name").alias("grade_name"))
    s = subject.select(F.col("id").alias("subject_id"), F.col("name").alias("subject_name"))
    ct = class_teacher.select(F.col("class_id").alias("id"), "teacher_usr_id")
    u = user.select(F.col("id").alias("teacher_usr_id"), F.concat("name", "mobile").alias("teacher_name"))
    return (ci.join(c, "course_id").join(s, "subject_id").join(ct, "id").join(u, "teacher_usr_id")
            .join(cg, "id").join(g, "grade_id")
            .select("id", "class_name", "course_name", "grade_name", "year", "season", "subject_name", "teacher_name"))
