"""Mixing sources to target weights by entropy balancing.

Every document gets a rate, the expected number of its copies. Among all rates between 0 and a cap
that give each source its target of tokens, the ones nearest to one copy of everything (least
Kullback-Leibler divergence from the corpus as it is) are exponential tilts,
`rate = min(cap, exp(lambda_source * size / mean size))`; lambda solves the convex dual, whose
gradient is the tokens taken less the target. Newton steps find it: every step is one aggregation
over the histogram of document sizes, kept in a bracket, with one row per source as its state.

Rates become whole copies by systematic rounding in the order of size: copies differ from the rate
by less than one, and the tokens of a source from its target by no more than its longest document.
A few single copies are then moved, one document per source and round, to come nearer still.

Only DataFrame operations: no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from batchload.llm.common import WORD, stored

#: Documents of one source and size are ranked in so many separate buckets of their hash.
RANK_BUCKETS = 4096
#: Up to so many (source, size) rows the plan is broadcast; beyond, it is joined by shuffle.
BROADCAST_ROWS = 300_000
MAX_STEPS = 60
SETTLE_ROUNDS = 4
TOLERANCE = 1e-10


def sizes(
    docs: DataFrame, id_col: str, text_col: str, source_col: str, *others: str
) -> DataFrame:
    """(doc_id, source, size): the number of words of every row; 0 where the text is null."""
    return docs.select(
        *others,
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0))
        .cast("long")
        .alias("size"),
    )


def targets(by_source: DataFrame, weights: tuple, share: float, cap: float) -> DataFrame:
    """(source, source_size, target): weights dealt in turn to the sources by code point, null last.

    All targets together are `share` of all sizes. A target stops at `cap` times its source's size;
    what is above goes to the others by weight, until none is above: target = min(cap * size,
    weight * level). Sources in order of cap * size / weight reach their cap one after the other, so
    the level follows from running sums over one row per source.
    """
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (turn % len(weights) + 1).cast("int")
    )
    ranked = by_source.withColumn("weight", weight).withColumn(
        "limit", F.col("source_size") * float(cap)
    )
    ranked = ranked.withColumn("ratio", F.col("limit") / F.col("weight"))
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy(F.lit(0))) * float(share)
    capped = F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    level = (total - capped) / F.sum("weight").over(after)
    # The first source that the level leaves below its cap fixes the level of all that follow.
    solved = ranked.withColumn("level", F.when(level < F.col("ratio"), level))
    solved = solved.withColumn(
        "level", F.first("level", ignorenulls=True).over(Window.partitionBy(F.lit(0)).orderBy(
            F.col("level").isNull(), "ratio", F.col("source").asc_nulls_last()
        ).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    )
    return solved.select(
        "source",
        "source_size",
        F.when(F.col("level").isNull(), F.col("limit"))
        .otherwise(F.least("limit", F.col("weight") * F.col("level")))
        .alias("target"),
    )


def balance(histogram: DataFrame, goals: DataFrame, cap: float) -> DataFrame:
    """(source, size, n, rate) from (source, size, n) and (source, source_size, target).

    A source without words has rate 0 for its rows: there is nothing to take.
    """
    # Sources are compared with null as a value of its own.
    key = F.struct(F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")))
    histogram = stored(histogram.withColumn("key", key))
    least = histogram.where("size > 0").groupBy("key").agg(
        F.min("size").alias("least"), F.sum("n").alias("docs")
    )
    state = goals.withColumn("key", key).join(least, "key")
    state = state.withColumn("mean", F.col("source_size") / F.col("docs"))
    x_least = F.col("least") / F.col("mean")
    short = F.col("target") < F.col("source_size")
    state = stored(
        state.select(
            "key",
            "target",
            "mean",
            # At the low end every rate is small enough, at the high end every rate is capped.
            F.when(
                short,
                F.log(F.greatest("target", F.lit(1e-300)) / F.col("source_size")) / x_least,
            ).otherwise(0.0).alias("lo"),
            F.when(short, 0.0).otherwise(F.log(F.lit(float(cap))) / x_least).alias("hi"),
            F.when(
                F.col("target") >= F.col("source_size") * float(cap) * (1 - 1e-12),
                F.log(F.lit(float(cap))) / x_least,
            ).otherwise(0.0).alias("lam"),
        )
    )
    rate = F.least(F.lit(float(cap)), F.exp(F.col("lam") * F.col("size") / F.col("mean")))
    mass = F.col("n") * F.col("size") * rate
    slope = F.when(rate < float(cap), mass * F.col("size") / F.col("mean")).otherwise(0.0)
    for _ in range(MAX_STEPS):
        sums = histogram.where("size > 0").join(state, "key").groupBy("key").agg(
            F.sum(mass).alias("taken"), F.sum(slope).alias("slope")
        )
        gap = F.col("taken") - F.col("target")
        step = state.join(sums, "key").withColumn("gap", gap)
        step = step.withColumn("lo", F.when(F.col("gap") < 0, F.col("lam")).otherwise(F.col("lo")))
        step = step.withColumn("hi", F.when(F.col("gap") > 0, F.col("lam")).otherwise(F.col("hi")))
        step = step.withColumn(
            "newton", F.when(F.col("slope") > 0, F.col("lam") - F.col("gap") / F.col("slope"))
        )
        done = F.abs("gap") <= TOLERANCE * F.col("target")
        inside = F.col("newton").between(F.col("lo"), F.col("hi"))
        step = stored(
            step.select(
                "key",
                "target",
                "mean",
                "lo",
                "hi",
                F.when(done, F.col("lam"))
                .when(inside, F.col("newton"))
                .otherwise((F.col("lo") + F.col("hi")) / 2)
                .alias("lam"),
                done.alias("done"),
            )
        )
        state = step.drop("done")
        if step.where(~F.col("done")).limit(1).count() == 0:
            break
    solved = histogram.join(state, "key", "left")
    return solved.select(
        "source", "size", "n", F.when(F.col("size") > 0, rate).otherwise(0.0).alias("rate")
    )


def plan(rows: DataFrame, weights: tuple, share: float, cap: float) -> DataFrame:
    """(source, size, source_size, target, copies, last): how many copies documents of a size get.

    `copies` is what all of them get; those whose `rank_hash` is at most `last` get one more.
    """
    histogram = stored(rows.groupBy("source", "size").agg(F.count("*").alias("n")))
    goals = stored(
        targets(
            histogram.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size")),
            weights, share, cap,
        )
    )
    rated = balance(histogram, goals, cap)
    # Systematic rounding over the fractions, smallest documents first.
    part = F.col("rate") - F.floor("rate")
    upto = Window.partitionBy("source").orderBy("size")
    upto = upto.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rated = rated.withColumn("till", F.sum(F.col("n") * part).over(upto))
    total = F.floor("rate") * F.col("n") + F.floor(F.col("till") + 0.5)
    total = total - F.floor(F.col("till") - F.col("n") * part + 0.5)
    rated = rated.select("source", "size", "n", total.cast("long").alias("total"))
    rated = stored(
        rated.alias("r").join(goals.alias("g"), F.expr("r.source <=> g.source")).select(
            "r.source", "size", "n", "total", "source_size", "target"
        )
    )
    for _ in range(SETTLE_ROUNDS):
        rated = settle(rated, cap)
    rated = stored(
        rated.withColumn("copies", F.expr("total div n")).withColumn("more", F.expr("total % n"))
    )
    # The document ranked `more` by its hash is the last one to get another copy. Ranks are counted
    # within buckets of the hash, so that documents of one size are never sorted in one task.
    wanted = rated.where("more > 0").select("source", "size", "more")
    hashed = rows.where("size > 0").withColumn("h", rank_hash("doc_id"))
    hashed = hashed.withColumn("bucket", F.floor((F.col("h") / 2.0**63 + 1) / 2 * RANK_BUCKETS))
    counts = hashed.groupBy("source", "size", "bucket").agg(F.count("*").alias("in_bucket"))
    before = Window.partitionBy("source", "size").orderBy("bucket")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("in_bucket").over(before), F.lit(0))
    held = counts.withColumn("start", start).alias("c").join(
        wanted.alias("w"),
        F.expr("c.source <=> w.source AND c.size = w.size AND start < more "
               "AND start + in_bucket >= more"),
    ).select("c.source", "c.size", "bucket", (F.col("more") - F.col("start")).alias("k"))
    inside = Window.partitionBy("h.source", "h.size", "h.bucket").orderBy("h.h", "h.doc_id")
    last = hashed.alias("h").join(
        held.alias("k"),
        F.expr("h.source <=> k.source AND h.size = k.size AND h.bucket = k.bucket"),
    ).select("h.source", "h.size", "h.h", "k", F.row_number().over(inside).alias("place"))
    last = last.where("place = k").select("source", "size", F.col("h").alias("last"))
    return stored(
        rated.alias("r").join(
            last.alias("l"), F.expr("r.source <=> l.source AND r.size = l.size"), "left"
        ).select(
            "r.source", "r.size", "source_size", "target", "copies",
            "last",
        )
    )


def settle(rated: DataFrame, cap: float) -> DataFrame:
    """`rated` with one copy more or less of one document per source, where that comes nearer to
    the target: the document whose size is nearest to what is missing or too much."""
    by_source = rated.groupBy("source").agg(
        (F.first("target") - F.sum(F.col("total") * F.col("size"))).alias("missing")
    )
    open_rows = rated.alias("r").join(by_source.alias("s"), F.expr("r.source <=> s.source")).where(
        f"size > 0 AND abs(missing) > abs(abs(missing) - size) AND "
        f"(missing > 0 AND total < n * {int(cap)} OR missing < 0 AND total > 0)"
    )
    best = open_rows.groupBy("r.source").agg(
        F.min_by(F.struct("size", F.signum("missing").alias("sign")),
                 F.struct(F.abs(F.abs("missing") - F.col("size")), F.col("size"))).alias("best")
    )
    moved = F.coalesce(F.col("best.sign"), F.lit(0)).cast("long")
    return stored(
        rated.alias("r").join(
            best.alias("b"), F.expr("r.source <=> b.source AND r.size = b.best.size"), "left"
        ).select(
            "r.source", "r.size", "n", (F.col("total") + moved).alias("total"), "source_size",
            "target",
        )
    )


def rank_hash(id_col: str):
    """The order in which documents of one source and size get another copy."""
    return F.xxhash64(F.col(id_col).cast("string"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple = (5, 2, 1),
    share: float = 1.5,
    cap: float = 2.0,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies) for every row of `docs`.

    A null text has size 0, and a null source is a source of its own. Rows of size 0 get no copies.
    Rows that share id, source and size share one decision. An empty table gives no rows. Other
    columns of `docs` play no part. The result follows from the rows alone, so reruns agree.
    """
    rows = stored(sizes(docs, id_col, text_col, source_col))
    decided = plan(rows, weights, share, cap)
    return _decided(rows, decided).select(
        "doc_id", "source", "size", "source_size", "target", "copies"
    )


def repeated(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple = (5, 2, 1),
    share: float = 1.5,
    cap: float = 2.0,
) -> DataFrame:
    """`docs` with every row as often as the mix of the same parameters takes it.

    All columns stay as they are, whatever their names. See `mix` for what each case gives.
    """
    rows = sizes(docs, id_col, text_col, source_col)
    decided = plan(stored(rows), weights, share, cap)
    kept = F.struct("*").alias("row")
    whole = sizes(docs.select(id_col, text_col, source_col, kept), id_col, text_col, source_col, "row")
    taken = _decided(whole, decided).where("copies > 0")
    times = F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))
    return taken.select("row", times.alias("again")).select("row.*")


def _decided(rows: DataFrame, decided: DataFrame) -> DataFrame:
    """`rows` (doc_id, source, size, ...) with what the plan says of their source and size."""
    few = decided.count() <= BROADCAST_ROWS
    decided = decided.withColumnsRenamed({"source": "of_source", "size": "of_size"})
    decided = F.broadcast(decided) if few else decided
    joined = rows.join(
        decided,
        F.col("source").eqNullSafe(F.col("of_source")) & (F.col("size") == F.col("of_size")),
        "left",
    )
    more = F.coalesce(rank_hash("doc_id") <= F.col("last"), F.lit(False)).cast("long")
    copies = F.when(F.col("size") > 0, F.col("copies") + more).otherwise(F.lit(0)).cast("long")
    return joined.withColumn("copies", copies)
