"""Exact top-k by inner product over a bit-sliced index.

Vectors are quantised to integers. The index cuts the rows into blocks and turns each component of a
block into bitmaps, one per binary digit, with one bit per row. The scores of all rows of a block come
from bitmap arithmetic alone: a query's weights say which slices are added at which binary place, and
full adders over whole bitmaps reduce every place to one slice. The top rows are selected from the
most significant slice of the sum downward; rows tied at the boundary are resolved by their id.

A block of the index stays in its task while blocks of queries stream past it. Where queries are so
many that this takes too long, or blocks so few that cores would idle, a block is sent to several
lanes, each with a part of the queries.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from batchload.llm.common import stored

#: A block of the index has so many components; at 64 a row these are 65,536 rows.
BLOCK_CELLS = 1 << 22
#: A block of queries has so many.
QUERY_CELLS = 1 << 15
#: Blocks of queries that one copy of a block of the index meets: at 64 a row 131,072 queries.
LANE_BLOCKS = 256
#: Copies of blocks with their queries wanted for every core, and tasks at most.
CELLS_A_CORE = 4
MOST_TASKS = 50_000

PACKED = "dims int, part int, ids binary, data binary"


class Slices:
    """The bitmaps of one block: rows in order of their id."""

    def __init__(self, ids: np.ndarray, low: np.ndarray, digits: np.ndarray, bitmaps: np.ndarray):
        self.ids, self.low, self.digits = ids, low, digits.tolist()
        self.n = len(ids)
        self.words = (self.n + 63) // 64
        rows = bitmaps.reshape(-1, self.words)
        ends = np.cumsum(digits)
        self.slices = [list(rows[e - d : e]) for e, d in zip(ends, digits, strict=True)]
        self.inverse = [[~row for row in slices] for slices in self.slices]
        self.all = self.bitmap(np.ones(self.n, np.int64))

    @classmethod
    def of(cls, ids: np.ndarray, values: np.ndarray) -> Slices:
        order = np.argsort(ids, kind="stable")
        values = values[order]
        low = values.min(axis=0)
        places = (np.packbits(_padded((column >> b) & 1), bitorder="little")
                  for column in (values - low).T for b in range(int(column.max()).bit_length()))
        digits = np.array([int(top).bit_length() for top in (values - low).max(axis=0)], np.int64)
        joined = np.concatenate([*places, np.zeros(0, np.uint8)])
        return cls(ids[order], low, digits, joined.view(np.uint64))

    @classmethod
    def read(cls, ids: bytes, data: bytes, dims: int) -> Slices:
        head = np.frombuffer(data, np.int64, 2 * dims)
        rest = np.frombuffer(data, np.uint64, offset=16 * dims)
        return cls(np.frombuffer(ids, np.int64), head[:dims], head[dims:], rest)

    def written(self) -> tuple[bytes, bytes]:
        """(ids, data) for `read`."""
        rows = [row.tobytes() for slices in self.slices for row in slices]
        head = np.concatenate([self.low, np.array(self.digits, np.int64)]).astype(np.int64)
        return self.ids.tobytes(), head.tobytes() + b"".join(rows)

    def bitmap(self, bits: np.ndarray) -> np.ndarray:
        return np.packbits(_padded(bits), bitorder="little").view(np.uint64)

    def sums(self, weights: list[int]) -> tuple[list[np.ndarray | None], int]:
        """The slices of the scores of all rows, lowest place first, and what to add to them."""
        places: list[list[np.ndarray]] = []
        base = sum(w * int(low) for w, low in zip(weights, self.low, strict=True))
        for j, weight in enumerate(weights):
            # A negative weight adds the complement of the component and takes off the constant.
            rows, size = (self.slices[j], weight) if weight > 0 else (self.inverse[j], -weight)
            if weight < 0:
                base += weight * ((1 << self.digits[j]) - 1)
            shift = 0
            while size:
                if size & 1:
                    while len(places) < shift + len(rows):
                        places.append([])
                    for b, row in enumerate(rows):
                        places[shift + b].append(row)
                size >>= 1
                shift += 1
        out: list[np.ndarray | None] = []
        at = 0
        while at < len(places):
            rows = places[at]
            if at + 1 == len(places) and len(rows) > 1:
                places.append([])
            while len(rows) > 2:
                a, b, c = rows.pop(), rows.pop(), rows.pop()
                x = a ^ b
                rows.append(x ^ c)
                places[at + 1].append((a & b) | (x & c))
            if len(rows) == 2:
                a, b = rows
                rows = [a ^ b]
                places[at + 1].append(a & b)
            out.append(rows[0] if rows else None)
            at += 1
        return out, base

    def top(self, weights: list[int], k: int, own: int) -> tuple[np.ndarray, list[int]]:
        """(ids, scores) of the k best rows, ties by id; rows with the id `own` are left out."""
        sums, base = self.sums(weights)
        open_, taken = self.all, np.zeros(self.words, np.uint64)
        first, last = np.searchsorted(self.ids, own), np.searchsorted(self.ids, own, side="right")
        if first < last:
            bits = np.ones(self.n, np.int64)
            bits[first:last] = 0
            open_ = self.bitmap(bits)
        short = k  # how many are still to be taken
        for row in reversed(sums):
            if row is None:
                continue
            ones = open_ & row
            n = int(np.bitwise_count(ones).sum())
            if n > short:
                open_ = ones
            else:
                taken |= ones
                open_ = open_ & ~row
                short -= n
                if not short:
                    break
        found = self.rows(taken)
        if short:
            found = np.concatenate([found, self.rows(open_)[:short]])
        word, bit = found >> 6, (found & 63).astype(np.uint64)
        scores = [base] * len(found)
        for place, row in enumerate(sums):
            if row is not None:
                digit = (row[word] >> bit) & np.uint64(1)
                scores = [s + (int(d) << place) for s, d in zip(scores, digit, strict=True)]
        return self.ids[found], scores

    def rows(self, bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def _padded(bits: np.ndarray) -> np.ndarray:
    """Bits as bytes, with zeros up to a whole number of words."""
    out = np.zeros((len(bits) + 63) // 64 * 64, np.uint8)
    out[: len(bits)] = bits
    return out


def narrowed(values: np.ndarray) -> np.ndarray:
    """Whole numbers in the narrowest signed type that holds them."""
    low, high = int(values.min(initial=0)), int(values.max(initial=0))
    for kind in (np.int8, np.int16, np.int32):
        if np.iinfo(kind).min <= low and high <= np.iinfo(kind).max:
            return values.astype(kind)
    return values


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """(id, vector, dims): vectors of longs; rows that take no part are left out."""
    vector = F.col(vector_col)
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.col(id_col).isNotNull() & vector.isNotNull() & finite).select(
        F.col(id_col).cast("long").alias("id"),
        F.transform(vector, lambda x: F.floor(x.cast("double") * float(scale)).cast("long")).alias(
            "vector"
        ),
        F.size(vector).alias("dims"),
    )


def _packed(rows: DataFrame, cells: int, sliced: bool) -> DataFrame:
    """Blocks of rows of one length as (dims, part, ids, data), dealt by a hash of the id.

    data is a matrix of whole numbers, as narrow as they allow, or the slices of the block.
    """
    sizes = rows.groupBy("dims").agg(F.count("*").alias("n")).collect()
    parts = F.lit(1)
    for row in sizes:  # one row per length of vectors
        n = max(1, math.ceil(row["n"] * max(1, row["dims"]) / cells))
        parts = F.when(F.col("dims") == row["dims"], n).otherwise(parts)
    part = F.pmod(F.xxhash64("id"), parts).cast("int")

    def pack(batch: pa.Table) -> pa.Table:
        ids = batch.column("id").to_numpy().astype(np.int64)
        values = batch.column("vector").combine_chunks().flatten().to_numpy().astype(np.int64)
        data = narrowed(values).tobytes()
        if sliced:
            ids, data = Slices.of(ids, values.reshape(len(ids), -1)).written()
        else:
            ids = ids.tobytes()
        return pa.table(
            {
                "dims": pa.array([batch.column("dims")[0].as_py()], pa.int32()),
                "part": pa.array([batch.column("part")[0].as_py()], pa.int32()),
                "ids": pa.array([ids], pa.binary()),
                "data": pa.array([data], pa.binary()),
            }
        )

    dealt = rows.withColumn("part", part)
    return dealt.groupBy("dims", "part").applyInArrow(pack, PACKED)


def _met(index: DataFrame, asked: DataFrame) -> tuple[DataFrame, int]:
    """(rows, tasks): per length of vectors, part and lane a block of the index and its queries.

    Queries are sent once for every part of the index, the index once for every lane.
    """
    parts = index.groupBy("dims").agg((F.max("part") + 1).alias("parts"))
    shape = parts.join(asked.groupBy("dims").agg(F.count("*").alias("blocks")), "dims").collect()
    cores = index.sparkSession.sparkContext.defaultParallelism
    lanes, sides, cells = F.lit(0), F.lit(0), 0
    for row in shape:  # one row per length of vectors
        wanted = max(row["blocks"] / LANE_BLOCKS, cores * CELLS_A_CORE / row["parts"])
        n = max(1, min(row["blocks"], math.ceil(wanted)))
        cells += n * row["parts"]
        lanes = F.when(F.col("dims") == row["dims"], n).otherwise(lanes)
        sides = F.when(F.col("dims") == row["dims"], row["parts"]).otherwise(sides)
    # Lengths of one side only have no lanes.
    blocks = index.where(lanes > 0).select(
        "dims", "part", F.explode(F.sequence(F.lit(0), lanes - 1)).alias("lane"),
        F.lit(False).alias("asks"), "ids", "data",
    )
    queries = asked.where(lanes > 0).select(
        "dims", F.explode(F.sequence(F.lit(0), sides - 1)).alias("part"),
        F.pmod("part", lanes).alias("lane"), F.lit(True).alias("asks"), "ids", "data",
    )
    return blocks.unionByName(queries), max(1, min(2 * cells, MOST_TASKS))


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    scale: float = 64.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query the k rows with the highest scores.

    The score is the inner product of the vectors, each component x being floor(scale * x); it must
    fit a long. Ties go to the smaller id. A query meets all vectors of its length but those with
    its own id; fewer than k give fewer rows. Vectors that are null or hold null or non-finite
    components take no part, nor do rows without an id. Repeated rows of `vectors` are rows of their
    own; repeated rows of `queries` are one query. An empty table gives no rows.
    """
    index = _packed(quantised(vectors, id_col, vector_col, scale).where("dims > 0"), BLOCK_CELLS, True)
    asked = _packed(
        quantised(queries, id_col, vector_col, scale).where("dims > 0").distinct(), QUERY_CELLS,
        False,
    )
    index, asked = stored(index), stored(asked)
    met, tasks = _met(index, asked)
    met = met.repartition(tasks, "dims", "part", "lane")
    met = met.sortWithinPartitions("dims", "part", "lane", "asks")

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, block = None, None
        for batch in batches:
            for row in batch.to_pylist():
                place = row["dims"], row["part"], row["lane"]
                if not row["asks"]:
                    at, block = place, Slices.read(row["ids"], row["data"], row["dims"])
                    continue
                if at != place:  # a part that no row of the index fell into
                    continue
                query_ids = np.frombuffer(row["ids"], np.int64)
                width = len(row["data"]) // (len(query_ids) * row["dims"])
                weights = np.frombuffer(row["data"], f"i{width}").reshape(len(query_ids), -1)
                found = [
                    (query, *block.top(weight.tolist(), k, query))
                    for query, weight in zip(query_ids.tolist(), weights, strict=True)
                ]
                yield pa.RecordBatch.from_pydict(
                    {
                        "query_id": [query for query, hits, _ in found for _ in hits],
                        "vec_id": [hit for _, hits, _ in found for hit in hits.tolist()],
                        "score": [score for _, _, scores in found for score in scores],
                    },
                    pa.schema(
                        [("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())]
                    ),
                )

    scored = met.mapInArrow(best, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
