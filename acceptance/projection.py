"""Row shaping and positional mapping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acceptance.registry import query, shared_path, table
from batchload.operators import collapse, project
from batchload.sinks.files import insert_into


@query(
    "project_first_n", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders"
)
def project_first_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project.first_n(table(spark, sf_dir, "orders"), 4)


@query(
    "project_sign_version",
    """SELECT o_orderkey, o_orderpriority, o_orderdate, 1 AS sign, o_orderdate AS version
       FROM orders""",
)
def project_sign_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    return project.with_sign_version(rows, "o_orderdate")


@query(
    "project_stringify",
    """SELECT CAST(event_id AS VARCHAR) AS event_id, strftime(ts, '%Y%m%d%H%M%S') AS ts,
              CAST(user_id AS VARCHAR) AS user_id, event_type, CAST(value AS VARCHAR) AS value,
              props FROM events""",
)
def project_stringify(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events")
    return project.stringify(rows, timestamp_pattern="yyyyMMddHHmmss", plain_numbers=True)


@query(
    "project_null_to_empty",
    """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
              coalesce(nullif(o_orderstatus, 'F'), '') AS o_orderstatus,
              CAST(o_totalprice AS VARCHAR) AS o_totalprice,
              strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate,
              o_orderpriority FROM orders""",
)
def project_null_to_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders")
    rows = rows.withColumn("o_orderstatus", F.expr("nullif(o_orderstatus, 'F')"))
    return project.null_to_empty(rows, plain_numbers=True)


@query(
    "positional_insert",
    """SELECT o_orderkey AS id, o_orderpriority AS name, o_orderdate AS load_dt, 1 AS sign,
              o_orderdate AS version FROM orders""",
)
def positional_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "positional_insert")
    target = "batchload_" + path.rsplit("-", 1)[1]
    spark.sql(
        f"CREATE TABLE {target} (id BIGINT, name STRING, load_dt TIMESTAMP_NTZ, sign INT, "
        f"version TIMESTAMP_NTZ) USING parquet LOCATION '{path}'"
    )
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    insert_into(project.with_sign_version(rows, "o_orderdate"), target)
    schema = spark.table(target).schema
    spark.sql(f"DROP TABLE {target}")  # the files stay
    return spark.read.schema(schema).parquet(path)


# A change log of `orders`: every order once; a third of them changed, so cancelled and written anew;
# a fifth of them cancelled for good.
_CHANGES = """
    explode(filter(array(
        struct(1 AS sign, 1 AS version, o_orderstatus AS status),
        IF(o_orderkey % 3 = 0, struct(-1 AS sign, 1 AS version, o_orderstatus AS status), NULL),
        IF(o_orderkey % 3 = 0, struct(1 AS sign, 2 AS version, 'X' AS status), NULL),
        IF(o_orderkey % 5 = 0, struct(-1 AS sign, IF(o_orderkey % 3 = 0, 2, 1) AS version,
                                      NULL AS status), NULL)
    ), x -> x IS NOT NULL)) AS change"""


@query(
    "collapse_changes",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 2 ELSE 1 END AS version,
              CASE WHEN o_orderkey % 3 = 0 THEN 'X' ELSE o_orderstatus END AS status
       FROM orders WHERE o_orderkey % 5 <> 0""",
)
def collapse_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log in four batches, some of which cancel what comes later, folded one by one."""
    orders = table(spark, sf_dir, "orders")
    log = orders.selectExpr("o_orderkey", _CHANGES).select("o_orderkey", "change.*")
    batch = F.pmod(F.xxhash64("o_orderkey", "sign", "version"), F.lit(4))
    state = None
    for number in range(4):
        changes = log.where(batch == number)
        folded = collapse.net(changes, ["o_orderkey"]) if state is None else collapse.fold(
            state, changes, ["o_orderkey"]
        )
        path = shared_path(spark, "state")
        folded.write.parquet(path)
        state = spark.read.schema(folded.schema).parquet(path)
    return collapse.present(state, ["o_orderkey"])
