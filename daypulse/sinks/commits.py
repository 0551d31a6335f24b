"""One commit for several targets (K7, K9), and tables that runs replace in parts.

A reader of several tables must see either all that a run wrote or nothing.
Files alone cannot promise that, so the last write of a run is one small file
that lists what the run brought, and readers take listed parts only. A run
that died leaves files that no one reads; its replay writes them again.

* Landed batches: :func:`commit_batch` lists a (stream, run, batch) once all its
  targets are written; :func:`committed` reads a target's listed batches.
* Replaced parts: rows of a table are kept by ``part`` and ``_version``;
  :class:`Snapshots` lists the version that holds for each part of each table
  and how far each stream has been read. Every commit writes the whole list
  (parts are few: buckets, not keys) as one file of the next version, and the
  greatest version holds.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daypulse.sinks.tables import path_exists, write_table

BATCH_COL, RUN_COL = "_batch_id", "_run_id"
_BATCHES = f"listed int, stream string, {RUN_COL} string, {BATCH_COL} long"


def commit_batch(spark: SparkSession, manifest: str, stream: str, run_id: str, batch_id: int) -> None:
    """List a batch whose targets are all written (may be repeated)."""
    row = spark.createDataFrame([(1, stream, run_id, batch_id)], _BATCHES)
    write_table(row.coalesce(1), manifest, partition_by=["stream", RUN_COL, BATCH_COL], mode="overwrite")


def batches(spark: SparkSession, manifest: str, stream: str) -> DataFrame:
    """(run, batch) of the listed batches of a stream."""
    if not path_exists(spark, manifest):
        return spark.createDataFrame([], _BATCHES).select(RUN_COL, BATCH_COL)
    found = spark.read.schema(_BATCHES).parquet(manifest).where(F.col("stream") == stream)
    return found.select(RUN_COL, BATCH_COL).distinct()


def committed(rows: DataFrame, listed: DataFrame) -> DataFrame:
    """The rows of a landed target that belong to listed batches. The join is
    on partition columns, so other batches' files are not read."""
    return rows.join(listed, [RUN_COL, BATCH_COL], "left_semi")


_LIST = "kind string, name string, part long, version long"


class Snapshots:
    """The list of versions that hold, kept under ``path``."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        # One row for each part of each table, and each stream and run: bounded by buckets and runs.
        rows = self._read()
        self.version = max((r["_at"] for r in rows), default=0)
        self.rows = [(r["kind"], r["name"], r["part"], r["version"]) for r in rows if r["_at"] == self.version]

    def _read(self) -> list:
        if not path_exists(self.spark, self.path):
            return []
        every = self.spark.read.schema(_LIST + ", _at long").parquet(self.path)
        last = every.agg(F.max("_at")).scalar()
        return every.where(F.col("_at") == last).collect()

    def parts(self, table: str) -> dict[int, int]:
        """part -> version that holds."""
        return {p: v for kind, name, p, v in self.rows if kind == "part" and name == table}

    def marks(self, stream: str) -> dict[str, int]:
        """run -> last batch read of a stream."""
        return {name.split("|", 1)[1]: v for kind, name, _, v in self.rows if kind == "mark" and name.startswith(stream + "|")}

    def read(self, table: str, target: str, schema: str, only: list[int] | None = None) -> DataFrame:
        """The rows that hold of a table (of some parts only)."""
        held = [(p, v) for p, v in self.parts(table).items() if only is None or p in only]
        columns = [c.strip().split(" ")[0] for c in schema.split(",")]
        if not held:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(f"{schema}, part long, _version long").parquet(target)
        by: dict[int, list[int]] = {}
        for p, v in held:
            by.setdefault(v, []).append(p)
        wanted = reduce(lambda a, b: a | b, ((F.col("_version") == v) & F.col("part").isin(ps) for v, ps in by.items()))
        return rows.where(wanted).select(*columns)

    def write(self, rows: DataFrame, target: str) -> None:
        """New versions of the parts that ``rows`` (with ``part``) bring; not yet listed."""
        write_table(rows.withColumn("_version", F.lit(self.version + 1).cast("long")), target, partition_by=["part", "_version"],
                    mode="overwrite")

    def commit(self, parts: dict[str, list[int]], marks: dict[tuple[str, str], int]) -> None:
        """The last write of a run: parts of tables that now hold the next
        version, and marks (stream, run) -> batch. The others stay as they are."""
        kept = {(k, n, p): v for k, n, p, v in self.rows}
        kept |= {("part", t, p): self.version + 1 for t, ps in parts.items() for p in ps}
        kept |= {("mark", f"{s}|{r}", 0): b for (s, r), b in marks.items()}
        rows = self.spark.createDataFrame([(k, n, p, v) for (k, n, p), v in sorted(kept.items())], _LIST)
        write_table(rows.coalesce(1), f"{self.path}/_at={self.version + 1}", mode="replace")
        self.version += 1
        self.rows = [(k, n, p, v) for (k, n, p), v in kept.items()]
