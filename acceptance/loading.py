"""Whole loads into files, with a manifest."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acceptance.planning import MIXED_REQUEST, MIXED_SQL
from acceptance.registry import in_batch_sql, parts_counts_sql, query, shared_path, table, windows_sql
from batchload import BatchPlan, BatchRequest, build, tumbling
from batchload.operators.audit import BATCH_KEY, current
from batchload.operators.extract import assign_batches, within_days
from batchload.runner import LoadError, load, read_jobs, read_manifest
from batchload.sinks.files import read_batches, write_batches, written_counts
from batchload.sources import zones

DAY = 86400


class Job:
    """Loads of a table into files of their own; each load has a name, all share one manifest."""

    def __init__(self, spark: SparkSession, rows: DataFrame, time_col: str, partition_col: str):
        self.spark, self.rows = spark, rows
        self.time_col, self.partition_col = time_col, partition_col
        self.target, self.manifest = shared_path(spark, "loaded"), shared_path(spark, "manifest")

    def run(
        self,
        plan: BatchPlan,
        name: str,
        rows: DataFrame | None = None,
        fails_at: int | None = None,
        **options: object,
    ) -> None:
        """Load a plan; `rows` is what the source holds now, `fails_at` a batch whose job fails."""
        source = self.rows if rows is None else rows
        put = partial(write_batches, path=self.target, load_name=name)
        options.setdefault("time_col", self.time_col)

        def read(piece: BatchPlan) -> DataFrame:
            if fails_at is not None and piece.between(fails_at, fails_at).items:
                raise RuntimeError("the source is down")
            return assign_batches(source, piece, self.time_col, self.partition_col)

        count = partial(written_counts, self.spark, self.target, name)
        load(self.spark, plan, read, put, self.manifest, name, count=count, **options)

    def finished(self) -> DataFrame:
        return read_manifest(self.spark, self.manifest)

    def loaded(self, name: str, with_key: bool = False) -> DataFrame:
        fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in self.rows.schema)
        return read_batches(
            self.spark, self.target, self.finished(), name, fields, with_key
        )

    def checked(self, *names: str) -> DataFrame:
        """Rows of each batch of the loads in the target, and what the manifest says of it."""
        parts = []
        for name in names:
            rows = self.loaded(name, with_key=True).groupBy(*BATCH_KEY).count()
            said = current(self.finished()).where(F.col("load_name") == name)
            same = [said[key].eqNullSafe(rows[key]) for key in BATCH_KEY]
            parts.append(
                said.join(rows, same, "left").select(
                    "load_name",
                    *[said[key] for key in BATCH_KEY],
                    "n_rows",
                    F.coalesce("count", F.lit(0)).cast("bigint").alias("in_target"),
                )
            )
        return reduce(DataFrame.unionByName, parts)


def _events(spark: SparkSession, sf_dir: str) -> Job:
    return Job(spark, table(spark, sf_dir, "events"), "ts", "event_type")


def _load_events(spark: SparkSession, sf_dir: str) -> Job:
    """Load the mixed plan twice over, the second time as a resume that has nothing to do."""
    job, plan = _events(spark, sf_dir), build(spark, MIXED_REQUEST)
    job.run(plan, MIXED_REQUEST.name)
    job.run(plan, MIXED_REQUEST.name, num_jobs=2, resume=True)
    return job


@query(
    "load_files",
    f"""WITH w AS ({MIXED_SQL})
        SELECT events.*, batch_id
        FROM events JOIN w ON {in_batch_sql("ts", "event_type")}""",
)
def load_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _load_events(spark, sf_dir).loaded(MIXED_REQUEST.name)


@query(
    "load_manifest",
    f"""SELECT 'mixed' AS load_name, batch_id, start_ts, end_ts, partition,
               CAST(row_number() OVER (PARTITION BY start_ts, end_ts, partition
                                       ORDER BY batch_id) AS INTEGER) AS occurrence,
               n_rows, 'ok' AS status
        FROM ({parts_counts_sql(MIXED_SQL, "events", "ts", "event_type")})""",
)
def load_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _load_events(spark, sf_dir).finished().drop("finished_at", "attempt")


def _checked_sql(name: str, start: str, end: str, where: str = "TRUE") -> str:
    """What `Job.checked` gives for a load of daily batches."""
    return f"""
        SELECT '{name}' AS load_name, s AS start_ts, e AS end_ts,
               CAST(NULL AS VARCHAR) AS partition, 1 AS occurrence, n AS n_rows, n AS in_target
        FROM (SELECT s, e, (SELECT count(*) FROM events WHERE ts >= s AND ts < e AND {where}) AS n
              FROM ({windows_sql(start, end, DAY)}))"""


def _days(spark: SparkSession, start: str, end: str) -> BatchPlan:
    return tumbling(spark, start, end, "yyyyMMdd", DAY)


@query("resume_moved_range", _checked_sql("daily", "2024-01-01", "2024-01-20"))
def resume_moved_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rolling window: the second load starts later and numbers the same days anew."""
    job = _events(spark, sf_dir)
    job.run(_days(spark, "20240101", "20240112"), "daily", num_jobs=3)
    job.run(_days(spark, "20240106", "20240120"), "daily", num_jobs=2, resume=True)
    return job.checked("daily")


@query(
    "resume_two_jobs",
    _checked_sql("first", "2024-01-01", "2024-01-10")
    + " UNION ALL "
    + _checked_sql("second", "2024-01-05", "2024-01-15"),
)
def resume_two_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads with one manifest: what the first has loaded does not count for the second."""
    job = _events(spark, sf_dir)
    job.run(_days(spark, "20240101", "20240110"), "first")
    job.run(_days(spark, "20240105", "20240115"), "second", resume=True)
    return job.checked("first", "second")


@query(
    "resume_duplicate_items",
    """SELECT 'twice' AS load_name, CAST(NULL AS TIMESTAMP) AS start_ts,
              CAST(NULL AS TIMESTAMP) AS end_ts, 'click' AS partition, k AS occurrence,
              n AS n_rows, n AS in_target
       FROM (SELECT count(*) AS n FROM events WHERE event_type = 'click'),
            (SELECT CAST(unnest(range(1, 3)) AS INTEGER) AS k)""",
)
def resume_duplicate_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A plan that holds a partition twice; the job of the second fails and is resumed."""
    job = _events(spark, sf_dir)
    plan = build(spark, BatchRequest("twice", "yyyyMMdd", partitions="click,click"))
    try:
        job.run(plan, "twice", fails_at=1, num_jobs=2, on_error="continue")
    except LoadError:
        job.run(plan, "twice", num_jobs=2, resume=True)
    return job.checked("twice")


_GONE = "NOT (ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-05')"


@query("reload_emptied_batch", _checked_sql("daily", "2024-01-01", "2024-01-10", _GONE))
def reload_emptied_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load run again after the source has lost all rows of two days."""
    job, plan = _events(spark, sf_dir), _days(spark, "20240101", "20240110")
    job.run(plan, "daily")
    kept = _GONE.replace("TIMESTAMP '", "TIMESTAMP_NTZ'")
    job.run(plan, "daily", rows=job.rows.where(kept))
    return job.checked("daily")


@query(
    "resume_killed_job",
    f"""WITH w AS ({windows_sql("2024-01-01", "2024-01-13", DAY)})
        SELECT event_id, ts, batch_id FROM events JOIN w ON ts >= s AND ts < e""",
)
def resume_killed_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load whose driver is killed after the second job's rows are in the target and before they
    are recorded, resumed. The target is a plain folder that knows nothing of attempts."""
    job, plan = _events(spark, sf_dir), _days(spark, "20240101", "20240113")
    rows = job.rows.select("event_id", "ts")
    written: list[str] = []

    def put(tagged: DataFrame, attempt: str) -> None:
        tagged.write.mode("append").parquet(job.target)
        written.append(attempt)
        if len(written) == 2:
            raise KeyboardInterrupt

    def put_rest(tagged: DataFrame, attempt: str) -> None:
        there = spark.read.parquet(job.target).select("event_id")
        tagged.join(there, "event_id", "left_anti").write.mode("append").parquet(job.target)

    def read(piece: BatchPlan) -> DataFrame:
        return assign_batches(rows, piece, "ts")

    try:
        load(spark, plan, read, put, job.manifest, "killed", num_jobs=3)
    except KeyboardInterrupt:
        load(
            spark, plan, read, put, job.manifest, "killed", num_jobs=3, resume=True,
            rewrite=put_rest,
        )
    return spark.read.parquet(job.target)


_BAD_DAY = "ts >= TIMESTAMP '2024-01-17' AND ts < TIMESTAMP '2024-01-18'"


@query(
    "bisect_failed_job",
    f"""SELECT batch_id, s AS start_ts, e AS end_ts,
               CASE WHEN bad > 0 THEN 'failed' ELSE 'ok' END AS status,
               CASE WHEN bad > 0 THEN NULL ELSE n END AS n_rows
        FROM (SELECT *, (SELECT count(*) FROM events WHERE ts >= s AND ts < e) AS n,
                     (SELECT count(*) FROM events WHERE ts >= s AND ts < e AND {_BAD_DAY}) AS bad
              FROM ({windows_sql("2024-01-01", "2024-01-31", DAY)}))""",
)
def bisect_failed_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One job of thirty batches, one of which holds rows that cannot be read: all others are
    loaded."""
    job, plan = _events(spark, sf_dir), _days(spark, "20240101", "20240131")
    bad = F.expr(_BAD_DAY.replace("TIMESTAMP '", "TIMESTAMP_NTZ'"))
    unreadable = F.when(bad, F.raise_error(F.lit("unreadable"))).otherwise(F.col("props"))
    try:
        job.run(plan, "daily", rows=job.rows.withColumn("props", unreadable), on_error="bisect")
    except LoadError:
        pass
    return job.finished().select("batch_id", "start_ts", "end_ts", "status", "n_rows")


@query(
    "observed_metrics",
    f"""SELECT min(batch_id) AS first_batch_id, max(batch_id) AS last_batch_id,
               count(ts) AS n_rows, min(ts) AS least_ts, max(ts) AS greatest_ts, TRUE AS agree
        FROM ({windows_sql("2024-01-01", "2024-01-13", DAY)})
        LEFT JOIN events ON ts >= s AND ts < e GROUP BY batch_id // 3""",
)
def observed_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What passed by in the write of every job, against the rows that were read back."""
    job = _events(spark, sf_dir)
    job.run(_days(spark, "20240101", "20240113"), "daily", num_jobs=4)
    counted = job.finished().groupBy("attempt").agg(F.sum("n_rows").alias("in_target"))
    return read_jobs(spark, job.manifest).join(counted, "attempt").select(
        "first_batch_id",
        "last_batch_id",
        "n_rows",
        "least_ts",
        "greatest_ts",
        (F.col("n_rows") == F.col("in_target")).alias("agree"),
    )


@query("concurrent_jobs", _checked_sql("daily", "2024-01-01", "2024-01-31"))
def concurrent_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten jobs of a load, up to four of them at the same time."""
    job = _events(spark, sf_dir)
    job.run(_days(spark, "20240101", "20240131"), "daily", num_jobs=10, max_concurrent=4)
    return job.checked("daily")


@query(
    "extract_by_day",
    f"""WITH w AS ({windows_sql("2024-01-10", "2024-01-13", 6 * 3600)})
        SELECT events.*, batch_id FROM events JOIN w ON ts >= s AND ts < e""",
)
def extract_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A copy partitioned by day; the plan's range prunes its folders before rows are assigned."""
    path = shared_path(spark, "by_day")
    rows = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    rows.hint("rebalance", "day").write.partitionBy("day").parquet(path)
    return pruned_by_day(spark.read.parquet(path)).drop("day")


def pruned_by_day(by_day: DataFrame) -> DataFrame:
    plan = tumbling(by_day.sparkSession, "2024011000", "2024011300", "yyyyMMddHH", 6 * 3600)
    return assign_batches(within_days(by_day, "day", *plan.hull()), plan, "ts")


_SPANS = [("20240103", "20240104"), ("20240110", "20240113"), ("20240101", "20240131")]


@query(
    "extract_zone_map",
    """WITH f AS (SELECT min(ts) AS least, max(ts) AS greatest FROM events
                  GROUP BY CAST(ts AS DATE)) """
    + " UNION ALL ".join(
        f"""SELECT '{a}' AS first_day, (SELECT count(*) FROM f) AS n_files,
                   (SELECT count(*) FROM f WHERE greatest >= strptime('{a}', '%Y%m%d')
                    AND least < strptime('{b}', '%Y%m%d')) AS n_read,
                   (SELECT count(*) FROM events WHERE ts >= strptime('{a}', '%Y%m%d')
                    AND ts < strptime('{b}', '%Y%m%d')) AS n_rows"""
        for a, b in _SPANS
    ),
)
def extract_zone_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A copy with a file a day, read through its zone map: files read shrink with the range."""
    path, map_path = shared_path(spark, "zoned"), shared_path(spark, "zones")
    rows = table(spark, sf_dir, "events")
    days = rows.withColumn("day", F.to_date("ts")).repartition(8, "day")
    days.write.partitionBy("day").parquet(path)
    copy = spark.read.parquet(path)
    found = zones.update(spark, map_path, path, "ts")
    parts = []
    for first, last in _SPANS:
        plan = _days(spark, first, last)
        picked = zones.pick(copy, found, plan, path)
        counts = assign_batches(picked, plan, "ts").agg(F.count(F.lit(1)).alias("n_rows"))
        parts.append(
            counts.select(
                F.lit(first).alias("first_day"),
                F.lit(len(copy.inputFiles())).cast("bigint").alias("n_files"),
                F.lit(len(picked.inputFiles())).cast("bigint").alias("n_read"),
                "n_rows",
            )
        )
    return reduce(DataFrame.unionByName, parts)
