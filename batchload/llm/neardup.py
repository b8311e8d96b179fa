"""Near-duplicate vectors by an inverted multi-index.

Two codebooks, one for each half of the vectors, span a grid of cells. A vector is listed in the cell
of its nearest codewords, and looks for partners in the cells nearest to it, in the order of the sum
of both distances (multi-sequence order). How many cells it visits follows from a target recall for
pairs that are just similar enough: it is measured on a sample with partners made at exactly the
threshold. Every pair that meets in a cell is verified by its cosine in double precision.

Equal vectors are one row of the index with a count. Cells are cut into blocks; a block stays in its
task while blocks of the vectors that visit its cells stream past it and are compared by matrix
products. Two blocks give one count per vector and a spanning forest of their links, never the links
themselves. Vectors of floats are sent as floats and made unit vectors of doubles where they arrive.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from batchload.llm.common import components, small_batches, stored

#: Vectors expected in the sample that fits the codebooks, whatever the size of the table.
SAMPLE = 20_000
ROUNDS = 12
#: Cells are made for so many vectors each, in the largest label; a codebook has at most so many words.
CELL_ROWS = 8
CODEWORDS = (4, 1024)
#: Partners made at the threshold to measure how many cells are to be visited.
PROBES = 4_000
#: Rows of a block, and rows compared at once.
BLOCK_ROWS = 4096
SLICE = 512
#: Blocks of visiting vectors that one copy of a block meets, and blocks that Python gets at once.
LANE_BLOCKS = 16
BLOCKS_AT_ONCE = 16


def codebook(half: np.ndarray, words: int, rng: np.random.Generator) -> np.ndarray:
    """Centres of `half` by Lloyd's rounds, in the order of their main direction."""
    words = min(words, len(half))
    centres = half[rng.choice(len(half), words, replace=False)].copy()
    for _ in range(ROUNDS):
        nearest = distances(half, centres).argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, half)
        n = np.bincount(nearest, minlength=words)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    spread = centres - centres.mean(axis=0)
    _, _, main = np.linalg.svd(spread, full_matrices=False)
    return centres[np.argsort(spread @ main[0], kind="stable")] if len(main) else centres


def distances(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, less the part that all centres share."""
    return (centres**2).sum(axis=1) - 2 * rows @ centres.T


class Grid:
    """The product of two codebooks."""

    def __init__(self, first: np.ndarray, second: np.ndarray, visits: int):
        self.first, self.second, self.visits = first, second, visits
        self.cut = first.shape[1]

    def ranked(self, rows: np.ndarray, visits: int) -> np.ndarray:
        """The nearest cells of every row, in multi-sequence order, as i * len(second) + j.

        The cell of the a-th and b-th nearest codewords (from 0) has (a + 1)(b + 1) - 1 cells before
        it at least, so that other places of the grid cannot be among the first `visits`.
        """
        one, two = distances(rows[:, : self.cut], self.first), distances(rows[:, self.cut :], self.second)
        order_one, order_two = np.argsort(one, axis=1), np.argsort(two, axis=1)
        places = [
            (a, b)
            for a in range(min(visits, len(self.first)))
            for b in range(min(visits // (a + 1), len(self.second)))
        ]
        a, b = np.array(places).T
        i, j = order_one[:, a], order_two[:, b]
        sums = np.take_along_axis(one, i, axis=1) + np.take_along_axis(two, j, axis=1)
        best = np.argsort(sums, axis=1, kind="stable")[:, :visits]
        cells = i * len(self.second) + j
        return np.take_along_axis(cells, best, axis=1).astype(np.int32)


def fit(sample: np.ndarray, words: int, threshold: float, recall: float) -> Grid:
    """A grid whose number of visits reaches `recall` for pairs at the threshold.

    A pair is found if either of its vectors visits the cell of the other.
    """
    rng = np.random.default_rng(7)
    cut = sample.shape[1] // 2
    grid = Grid(codebook(sample[:, :cut], words, rng), codebook(sample[:, cut:], words, rng), 1)
    probes = sample[rng.choice(len(sample), min(PROBES, len(sample)), replace=False)]
    away = rng.normal(size=probes.shape)
    away -= (away * probes).sum(axis=1)[:, None] * probes
    norm = np.linalg.norm(away, axis=1)[:, None]
    partners = threshold * probes + math.sqrt(max(0.0, 1 - threshold**2)) * away / np.where(
        norm > 0, norm, 1
    )
    most = len(grid.first) * len(grid.second)
    visits = min(16, most)
    while True:
        there, back = grid.ranked(probes, visits), grid.ranked(partners, visits)
        found = (there == back[:, :1]) | (back == there[:, :1])
        reached = np.maximum.accumulate(found, axis=1).mean(axis=0)
        enough = np.flatnonzero(reached >= recall)
        if len(enough) or visits == most:
            grid.visits = int(enough[0]) + 1 if len(enough) else most
            return grid
        visits = min(2 * visits, most)


def units(data: np.ndarray) -> np.ndarray:
    rows = data.astype(np.float64)
    # Scaled first: squares of very large or very small components would not be finite or not be 0.
    rows = rows / np.abs(rows).max(axis=1)[:, None]
    return rows / np.linalg.norm(rows, axis=1)[:, None]


def _valid(id_col, vector_col, label_col):
    vector = F.col(vector_col)
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    ok = finite & F.exists(vector, lambda x: x != 0) & F.col(label_col).isNotNull()
    return F.coalesce(ok & F.col(id_col).isNotNull(), F.lit(False))


def near_duplicates(
    vectors: DataFrame, threshold: float = 0.93, recall: float = 0.995,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row.

    Vectors of one label and length link when their cosine is at least `threshold`. n_links counts
    the other rows linked directly, component_id is the smallest id reachable. Vectors that are
    null or zero or hold null or non-finite components, and rows without label or id, link with
    nothing: n_links 0, component_id their own id, kept true. Repeated rows are rows of their own.
    Other columns play no part; an empty table gives no rows.
    """
    floats = isinstance(getattr(vectors.schema[vector_col].dataType, "elementType", None), FloatType)
    number = "float" if floats else "double"
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(vector_col).cast(f"array<{number}>").alias("vector"),
        F.col(label_col).alias("label"),
    ).withColumn("ok", _valid("vec_id", "vector", "label"))
    keys = [F.xxhash64("label", "vector").alias("k1"), F.xxhash64("vector", F.lit(1), "label").alias("k2")]
    distinct = stored(
        rows.where("ok").groupBy(*keys).agg(
            F.min("vec_id").alias("id"),
            F.count("*").alias("n"),
            F.first("vector").alias("vector"),
            F.first("label").cast("string").alias("label"),
        )
    )
    counts, edges = None, None
    for (dims,) in sorted(distinct.select(F.size("vector")).distinct().collect()):
        some = distinct.where(F.size("vector") == dims)
        linked = _links(some, dims, number, threshold, recall)
        one = linked.where("n_links IS NOT NULL").groupBy("id").agg(F.sum("n_links").alias("others"))
        two = linked.where("b IS NOT NULL").select(F.col("id").alias("a"), "b")
        counts = one if counts is None else counts.unionByName(one)
        edges = two if edges is None else edges.unionByName(two)
    if counts is None:
        return rows.select(
            "vec_id", F.lit(0).cast("long").alias("n_links"),
            F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"),
        )
    classes = (
        distinct.select("k1", "k2", "id", "n")
        .join(counts, "id", "left")
        .join(components(edges).withColumnRenamed("node", "id"), "id", "left")
        .select(
            "k1", "k2",
            (F.col("n") - 1 + F.coalesce("others", F.lit(0))).cast("long").alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
        )
    )
    classes = stored(classes)
    keyed = rows.select(
        "vec_id", *[F.when(F.col("ok"), key).alias(name) for key, name in zip(keys, ("k1", "k2"), strict=True)]
    )
    component = F.coalesce("component_id", "vec_id")
    return keyed.join(classes, ["k1", "k2"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


def _links(
    distinct: DataFrame, dims: int, number: str, threshold: float, recall: float
) -> DataFrame:
    """(id, n_links, b): shares of the number of links of vectors, and edges from id to b.

    `number` is the type of the components, float or double.
    """
    kind = np.dtype(np.float32 if number == "float" else np.float64)
    sizes = distinct.groupBy("label").count().agg(F.max("count"), F.sum("count")).first()
    words = math.ceil(math.sqrt(sizes[0] / CELL_ROWS))
    words = min(max(words, CODEWORDS[0]), CODEWORDS[1])
    share = min(1.0, SAMPLE / sizes[1])
    sample = distinct.where(F.pmod(F.col("k1"), F.lit(10**6)) < F.lit(max(1.0, share * 10**6)))
    sample = sample.select("vector").limit(2 * SAMPLE).toPandas()["vector"]
    if not len(sample):
        sample = distinct.select("vector").limit(1).toPandas()["vector"]
    grid = fit(units(np.stack(sample)), words, threshold, recall)
    spark = distinct.sparkSession
    shared = spark.sparkContext.broadcast(grid)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = kind.itemsize * dims
        for batch in batches:
            if not batch.num_rows:
                continue
            data = batch.column("vector").flatten().to_numpy().reshape(-1, dims)
            cells = shared.value.ranked(units(data), shared.value.visits)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("label"),
                    batch.column("n"),
                    pa.array((cells[:, 0] // len(shared.value.second)).astype(np.int32)),
                    pa.array(list(cells // len(shared.value.second)), pa.list_(pa.int32())),
                    pa.FixedSizeBinaryArray.from_buffers(
                        pa.binary(width), len(data), [None, pa.py_buffer(data.tobytes())]
                    ).cast(pa.binary()),
                    pa.array([row.tobytes() for row in cells], pa.binary()),
                ],
                names=["id", "label", "n", "i", "visited", "data", "cells"],
            )

    schema = "id long, label string, n long, i int, visited array<int>, data binary, cells binary"
    rows = stored(distinct.select("id", "label", "n", "vector").mapInArrow(placed, schema))
    # Neighbouring codewords of the first half share a bucket while they are small; large buckets are
    # cut into parts by a hash of the id.
    per_word = rows.groupBy("label", "i").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("label").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    words_of = per_word.withColumn(
        "bucket", F.floor(F.coalesce(F.sum("rows").over(before), F.lit(0)) / BLOCK_ROWS).cast("int")
    )
    # Per label an array of the buckets of all codewords; those that hold nothing have none.
    buckets = words_of.groupBy("label").agg(
        F.map_from_entries(F.collect_list(F.struct("i", "bucket"))).alias("buckets")
    )
    every = F.sequence(F.lit(0), F.lit(len(grid.first) - 1))
    buckets = stored(
        buckets.select("label", F.transform(every, lambda i: F.element_at("buckets", i)).alias("buckets"))
    )
    at_home = F.element_at("buckets", F.col("i") + 1)
    visited = F.array_distinct(F.transform("visited", lambda i: F.element_at("buckets", i + 1)))
    placed_rows = rows.join(buckets, "label")
    row = ["label", "id", "n", "data", "cells"]
    held = placed_rows.select(*row, at_home.alias("bucket"))
    visiting = placed_rows.select(*row, F.explode(visited).alias("bucket")).where("bucket IS NOT NULL")
    index, asked = _blocks(held, "part"), _blocks(visiting, "q")
    keys = ["label", "bucket"]
    shape = index.groupBy(*keys).agg((F.max("part") + 1).alias("parts")).join(
        asked.groupBy(*keys).agg(F.ceil(F.count("*") / LANE_BLOCKS).cast("int").alias("lanes")), keys
    )
    shape = stored(shape)
    place = [*keys, "part", "lane"]
    blocks = index.join(shape, keys).select(
        *keys, "part", F.explode(F.sequence(F.lit(0), F.col("lanes") - 1)).alias("lane"),
        F.lit(False).alias("asks"), "block",
    )
    queries = asked.join(shape, keys).select(
        *keys, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.pmod("q", "lanes").alias("lane"), F.lit(True).alias("asks"), "block",
    )
    met = blocks.unionByName(queries).repartition(*place).sortWithinPartitions(*place, "asks")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, block = None, None
        for batch in batches:
            for row in batch.to_pylist():
                here = tuple(row[name] for name in place)
                if not row["asks"]:
                    at, block = here, _read(row["block"], kind)
                elif at == here:  # a part may have no rows
                    yield _compared(block, _read(row["block"], kind), threshold)

    with small_batches(spark, BLOCKS_AT_ONCE):
        return stored(met.mapInArrow(compared, "id long, n_links long, b long"))


def _blocks(rows: DataFrame, name: str) -> DataFrame:
    """Rows of a bucket packed into blocks of about BLOCK_ROWS: label, bucket, `name`, block."""
    keys = ["label", "bucket"]
    parts = rows.groupBy(*keys).agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("parts"))
    dealt = rows.join(parts, keys).withColumn(name, F.pmod(F.xxhash64("id"), "parts").cast("int"))

    def pack(table: pa.Table) -> pa.Table:
        n = table.num_rows
        cells = b"".join(table.column("cells").to_pylist())
        head = np.array([n, len(cells) // 4 // n], np.int64)
        block = b"".join(
            [
                head.tobytes(),
                table.column("id").to_numpy().astype(np.int64).tobytes(),
                table.column("n").to_numpy().astype(np.int64).tobytes(),
                b"".join(table.column("data").to_pylist()),
                cells,
            ]
        )
        return pa.table(
            {
                "label": pa.array([table.column("label")[0].as_py()], pa.string()),
                "bucket": pa.array([table.column("bucket")[0].as_py()], pa.int32()),
                name: pa.array([table.column(name)[0].as_py()], pa.int32()),
                "block": pa.array([block], pa.binary()),
            }
        )

    packed = dealt.select(*keys, name, "id", "n", "data", "cells").groupBy(*keys, name)
    return stored(packed.applyInArrow(pack, f"label string, bucket int, {name} int, block binary"))


def _read(block: bytes, kind: np.dtype):
    """(ids, counts, vectors, cells) of a block."""
    n, visits = np.frombuffer(block, np.int64, 2)
    ids, counts = np.frombuffer(block, np.int64, 2 * n, 16).reshape(2, n)
    at = 16 + 16 * int(n)
    dims = (len(block) - at - 4 * int(n) * int(visits)) // (kind.itemsize * int(n))
    data = np.frombuffer(block, kind, int(n) * dims, at).reshape(n, dims)
    cells = np.frombuffer(block, np.int32, offset=at + data.nbytes).reshape(n, visits)
    return ids, counts, units(data), cells


def _compared(block, queries, threshold: float) -> pa.RecordBatch:
    """The links between the rows of a block and the queries that visit their cells.

    A pair of which each visits the other's cell meets twice; it counts where the query has the
    smaller id.
    """
    ids, counts, data, cells = block
    q_ids, q_counts, q_data, q_cells = queries
    order = np.argsort(cells[:, 0], kind="stable")
    homes, firsts = np.unique(cells[order, 0], return_index=True)
    bounds = [*firsts.tolist(), len(order)]
    at = np.searchsorted(homes, q_cells)
    at[at == len(homes)] = 0
    query, place = np.nonzero(homes[at] == q_cells)
    home = at[query, place]
    by_home = np.argsort(home, kind="stable")
    query = query[by_home]
    starts = np.searchsorted(home[by_home], np.arange(len(homes) + 1))
    links, q_links = np.zeros(len(ids), np.int64), np.zeros(len(q_ids), np.int64)
    edges: list[tuple[np.ndarray, np.ndarray]] = []
    for k in range(len(homes)):
        mine = order[bounds[k] : bounds[k + 1]]
        for s in range(starts[k], starts[k + 1], SLICE):
            asking = query[s : min(s + SLICE, starts[k + 1])]
            linked = q_data[asking] @ data[mine].T >= threshold
            linked &= q_ids[asking][:, None] != ids[mine][None, :]
            if not linked.any():
                continue
            own, which = np.unique(q_cells[asking, 0], return_inverse=True)
            visits_back = np.stack([(cells[mine] == cell).any(axis=1) for cell in own])[which]
            linked &= ~visits_back | (q_ids[asking][:, None] < ids[mine][None, :])
            if not linked.any():
                continue
            links[mine] += linked.T @ q_counts[asking]
            q_links[asking] += linked @ counts[mine]
            edges.append(_forest(linked, q_ids[asking], ids[mine]))
    some, q_some = np.flatnonzero(links), np.flatnonzero(q_links)
    a = np.concatenate([a for a, _ in edges] or [np.zeros(0, np.int64)])
    b = np.concatenate([b for _, b in edges] or [np.zeros(0, np.int64)])
    n = len(some) + len(q_some)
    return pa.RecordBatch.from_pandas(
        pd.DataFrame(
            {
                "id": np.concatenate([ids[some], q_ids[q_some], a]),
                "n_links": pd.array([*links[some], *q_links[q_some], *[None] * len(a)], "Int64"),
                "b": pd.array([*[None] * n, *b], "Int64"),
            }
        ),
        pa.schema([("id", pa.int64()), ("n_links", pa.int64()), ("b", pa.int64())]),
        preserve_index=False,
    )


def _forest(linked: np.ndarray, left: np.ndarray, right: np.ndarray):
    """Edges from every row and column with links to the smallest id of its component."""
    rows, columns = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
    linked, left, right = linked[np.ix_(rows, columns)], left[rows], right[columns]
    most = np.iinfo(np.int64).max
    a, b = left.copy(), right.copy()
    while True:
        a_new = np.minimum(a, np.where(linked, b[None, :], most).min(axis=1))
        b_new = np.minimum(b, np.where(linked, a_new[:, None], most).min(axis=0))
        if (a_new == a).all() and (b_new == b).all():
            return np.concatenate([left, right]), np.concatenate([a, b])
        a, b = a_new, b_new
