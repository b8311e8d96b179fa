"""The prefix trie of rebuilt conversations, with the work of shared prefixes that a cache would save.

A node is a sequence of turns that some conversation starts with. It is known by a 128-bit digest:
turns hash together with their place, and the hashes of a prefix are summed, so a prefix's digest
comes from running sums, also where one conversation spans many tasks.

Most prefixes belong to one conversation only. A count-min sketch of all prefix digests is made
first: cells only ever count too much, so a prefix with a cell that counts one is proved to be
alone, and its node is written where it stands. Counts stop at two, as no more is asked. Only the
prefixes that the sketch cannot clear are shuffled and grouped, exactly. The sketch grows with the
number of prefixes up to a bound in bytes; beyond it fewer prefixes are cleared, and the result is
the same.

Sums over subtrees need no walk down the tree. The smallest member of a node is also that of its
nodes further down its path, so the nodes fall into chains, one for each member that is the smallest
somewhere. A chain's sums go to every prefix of its conversation above the chain, and running sums
along the chain give the rest.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from batchload.llm.common import mix64, stored
from batchload.llm.ranking import laid_out, piece, ranked, runs

#: Turns of another conversation that one may start with, at most; and conversations that share one.
MAX_HEAD = 5
FAMILY = 100
#: Rows of the count-min sketch, cells of a row for each prefix, and bytes of it at most. Only
#: whether a cell counts one or more is kept: a bit.
SKETCH_ROWS = 3
CELLS_PER_PREFIX = 4
SKETCH_BYTES = 32 << 20
#: Cells that are merged together.
SEGMENT = 1 << 16
#: Cells that a task holds before it passes them on.
HELD_CELLS = 4_000_000
#: A node with more than this part of all prefixes is heavy; there are fewer than that many.
HEAVY_PART = 1_000
#: Depths of a chain, and conversations by their number, that are summed or joined at once.
STRIDE = 4_096
_LANES = ("a", "b", "c", "d")


def _turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, h, n_chars): every turn with the digest of role and text."""
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("role", "text"))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.sha2(whole, 256).alias("h"),
        F.length(text).cast("long").alias("n_chars"),
    )


def _lanes(place: str) -> list[Column]:
    """Four hashes of a turn at its place, of 32 bits: sums of 2^31 of them fit a long."""
    both = [F.xxhash64(F.lit(seed), F.col(place).cast("long"), "h") for seed in (1, 2)]
    low = [one.bitwiseAND(F.lit(0xFFFFFFFF).cast("long")) for one in both]
    high = [F.shiftrightunsigned(one, 32) for one in both]
    return [lane.alias(name) for lane, name in zip([*low, *high], _LANES)]


def _key(sums: list[Column], depth: Column) -> list[Column]:
    """The digest of a prefix, two longs, from the sums of its turns' hashes and its depth."""
    return [F.xxhash64(F.lit(seed), *sums, depth.cast("long")) for seed in (3, 4)]


def rebuilt_prefixes(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, n_turns, k1, k2, p1, p2, n_chars): every prefix of every rebuilt
    conversation, with its digest, its parent's, and the length of its last text."""
    turns = stored(_turns(conversations))
    rows = laid_out(turns, ["conv_id", "turn", "h"])
    found = runs(rows, "conv_id")
    # The first turns of the conversations that others start with: a hundredth, five turns of each.
    base = F.col("conv_id") % FAMILY == 0
    first = ranked(rows.where(base), "conv_id", found.where(base)).where(f"rank < {MAX_HEAD}")
    heads = first.select("conv_id", "rank", "n_chars", *_lanes("rank")).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("rank", "n_chars", *_LANES))).alias("head")
    )
    convs = found.groupBy("conv_id").agg(F.max("total").alias("own"))
    skipped = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MAX_HEAD + 1)
    convs = convs.withColumn("skip", skipped.cast("int")).withColumn(
        "base", F.col("conv_id") - F.col("conv_id") % FAMILY
    )
    heads = heads.withColumnRenamed("conv_id", "base")
    convs = convs.join(heads, "base", "left").select(
        "conv_id",
        "skip",
        F.slice(F.coalesce("head", F.expr("array()")), 1, F.col("skip")).alias("head"),
        "own",
    )
    convs = stored(
        convs.withColumn("n_head", F.size("head").cast("long")).withColumn(
            "n_turns", F.col("n_head") + F.greatest(F.col("own") - F.col("skip"), F.lit(0))
        )
    )

    def head_sum(name: str, until: Column) -> Column:
        taken = F.slice("head", 1, until.cast("int"))
        return F.aggregate(taken, F.lit(0).cast("long"), lambda total, turn: total + turn[name])

    def prefix(sums: list[Column], last: list[Column]) -> list[Column]:
        above = F.col("depth") - 1
        parent = _key([s - l for s, l in zip(sums, last)], above)
        names = ("k1", "k2", "p1", "p2")
        return [c.alias(n) for c, n in zip([*_key(sums, F.col("depth")), *parent], names)]

    ids = ["conv_id", "depth", "n_turns"]
    places = convs.withColumn("depth", F.explode(F.expr("sequence(0L, n_head)")))
    last_turn = F.get("head", F.col("depth").cast("int") - 1)
    in_head = places.select(
        *ids,
        *prefix(
            [head_sum(name, F.col("depth")) for name in _LANES],
            [F.coalesce(last_turn[name], F.lit(0)) for name in _LANES],
        ),
        F.coalesce(last_turn["n_chars"], F.lit(0)).alias("n_chars"),
    )
    # A conversation's own turns, in the pieces that they lie in: sums within a piece, and what the
    # pieces before and the head add, known for each piece.
    shared = convs.select(
        "conv_id", "skip", "n_head", "n_turns", *[head_sum(n, F.col("n_head")).alias(f"head_{n}") for n in _LANES]
    )
    known = found.join(shared, "conv_id")
    own = rows.join(
        known.withColumnsRenamed({"conv_id": "c", "piece": "p"}),
        (F.col("conv_id") == F.col("c")) & (piece() == F.col("p")),
    ).withColumn("rank", F.col("at") - F.col("first"))
    own = own.where("rank >= skip").withColumn("place", F.col("rank") - F.col("skip") + F.col("n_head"))
    own = own.select(
        F.col("c").alias("conv_id"),
        "p",
        "at",
        "n_turns",
        "n_chars",
        (F.col("place") + 1).alias("depth"),
        *_lanes("place"),
        *[f"head_{name}" for name in _LANES],
    )
    so_far = Window.partitionBy("conv_id", "p").orderBy("at").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    summed = stored(
        own.select(
            "*", *[F.sum(name).over(so_far).alias(f"sum_{name}") for name in _LANES]
        )
    )
    # Only conversations over the edge of a piece have pieces before: one for each edge at most.
    over = found.groupBy("conv_id").agg(F.count(F.lit(1)).alias("pieces")).where("pieces > 1")
    ends = summed.join(F.broadcast(over), "conv_id").groupBy("conv_id", "p").agg(
        *[F.sum(name).alias(name) for name in _LANES]
    )
    before = Window.partitionBy("conv_id").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    carried = stored(
        ends.select("conv_id", "p", *[F.sum(n).over(before).alias(f"carry_{n}") for n in _LANES])
    )
    whole = summed.join(F.broadcast(carried), ["conv_id", "p"], "left")
    sums = [
        F.col(f"sum_{n}") + F.col(f"head_{n}") + F.coalesce(F.col(f"carry_{n}"), F.lit(0))
        for n in _LANES
    ]
    in_own = whole.select(*ids, *prefix(sums, [F.col(n) for n in _LANES]), "n_chars")
    return stored(in_head.unionByName(in_own))


def _cells(k1: np.ndarray, k2: np.ndarray, width: int) -> np.ndarray:
    """The cell of every digest in each row of the sketch, rows one after the other."""
    k1, k2 = k1.view(np.uint64), k2.view(np.uint64) | np.uint64(1)
    rows = [
        mix64(k1 + np.uint64(i) * k2) % np.uint64(width) + np.uint64(i * width)
        for i in range(SKETCH_ROWS)
    ]
    return np.concatenate(rows).astype(np.int64)


def _numbers(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64) for name in names]


_COUNTED = "segment long, cells binary, counts binary"


def _count(width: int):
    """What a task adds to the sketch: by segment, its cells and their counts, up to two."""

    def packed(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        cells, counts = np.unique(np.concatenate(held), return_counts=True)
        segments, starts = np.unique(cells // SEGMENT, return_index=True)
        ends = [*starts[1:], len(cells)]
        offsets, twos = (cells % SEGMENT).astype("<u2"), np.minimum(counts, 2).astype(np.uint8)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(segments, pa.int64()),
                pa.array([offsets[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                pa.array([twos[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
            ],
            ["segment", "cells", "counts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            held.append(_cells(*_numbers(batch, "k1", "k2"), width))
            if sum(map(len, held)) >= HELD_CELLS:
                yield from packed(held)
                held = []
        yield from packed(held)

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bits of the cells that count two or more, a row for each segment; input sorted by segment."""

    def bits(segment: int, counts: np.ndarray) -> pa.RecordBatch:
        packed = np.packbits(counts >= 2).tobytes()
        return pa.RecordBatch.from_arrays(
            [pa.array([segment], pa.int64()), pa.array([packed], pa.binary())], ["segment", "bits"]
        )

    now, counts = None, None
    for batch in batches:
        for segment, cells, added in zip(*(column.to_pylist() for column in batch.columns)):
            if segment != now:
                if now is not None:
                    yield bits(now, counts)
                now, counts = segment, np.zeros(SEGMENT, np.uint8)
            at = np.frombuffer(cells, "<u2")
            counts[at] = np.minimum(counts[at] + np.frombuffer(added, np.uint8), 2)
    if now is not None:
        yield bits(now, counts)


def sketch(prefixes: DataFrame, n_prefixes: int, most_bytes: int = SKETCH_BYTES) -> tuple[int, bytes]:
    """The width of the count-min sketch's rows, and for every cell a bit: does it count two or
    more?"""
    width = max(1, min(CELLS_PER_PREFIX * n_prefixes, most_bytes * 8 // SKETCH_ROWS))
    counted = prefixes.select("k1", "k2").mapInArrow(_count(width), _COUNTED)
    merged = counted.repartition("segment").sortWithinPartitions("segment")
    found = merged.mapInArrow(_merge, "segment long, bits binary").toPandas()
    whole = np.zeros(-(-SKETCH_ROWS * width // SEGMENT) * SEGMENT // 8, np.uint8)
    for segment, bits in zip(found["segment"], found["bits"]):
        start = int(segment) * SEGMENT // 8
        whole[start : start + SEGMENT // 8] = np.frombuffer(bits, np.uint8)
    return width, whole.tobytes()


def _alone(sent: Broadcast, k1: str, k2: str) -> Column:
    """Whether the sketch proves that a digest belongs to one prefix only."""

    @F.pandas_udf("boolean")
    def alone(a: pd.Series, b: pd.Series) -> pd.Series:
        width, bits = sent.value
        bits = np.frombuffer(bits, np.uint8)
        cells = _cells(a.to_numpy(np.int64), b.to_numpy(np.int64), width)
        more = (bits[cells >> 3] >> (7 - (cells & 7)).astype(np.uint8)) & 1
        return pd.Series(~more.reshape(SKETCH_ROWS, -1).astype(bool).all(axis=0))

    return alone(k1, k2)


def _ends(shared: DataFrame) -> DataFrame:
    """(k1, k2, ends_sha256): the conversations that end in a node, digested in numeric order.

    They are put together in blocks of STRIDE numbers, and a node's blocks then go through one hash
    in order, a block in memory at a time: such a digest has no parts that could be made apart.
    """
    block = F.shiftright("conv_id", STRIDE.bit_length() - 1)
    blocks = shared.where("depth = n_turns").groupBy("k1", "k2", block.alias("block")).agg(
        F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None

        def row() -> pa.RecordBatch:
            values = [[now[0]], [now[1]], [state.hexdigest()]]
            kinds = [pa.int64(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(values, kinds)], ["k1", "k2", "ends_sha256"]
            )

        for batch in batches:
            for k1, k2, ids in zip(*(batch.column(n).to_pylist() for n in ("k1", "k2", "ids"))):
                if (k1, k2) != now:
                    if now is not None:
                        yield row()
                    now, state = (k1, k2), sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
        if now is not None:
            yield row()

    in_order = blocks.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "block")
    return in_order.mapInArrow(digest, "k1 long, k2 long, ends_sha256 string")


def trie(conversations: DataFrame, sketch_bytes: int = SKETCH_BYTES) -> DataFrame:
    """One row for every node of the prefix trie of the rebuilt conversations.

    Turns are ordered by `turn`, null first; turns of one number by the digest of role and text, so
    that equal turns may stand for one another and the order of the rows plays no part. Null roles
    and texts are empty ones. Rows without a conversation belong to none and are left out. A table
    without conversations has no trie, not even a root. Columns besides conv_id, turn, role and text
    play no part, whatever their names. A conversation may have 2^31 turns.
    """
    spark = conversations.sparkSession
    prefixes = rebuilt_prefixes(conversations.select("conv_id", "turn", "role", "text"))
    n_prefixes = prefixes.count()
    sent = spark.sparkContext.broadcast(sketch(prefixes, n_prefixes, sketch_bytes))
    screened = prefixes.withColumn("alone", _alone(sent, "k1", "k2"))
    inner = (F.col("depth") > 0) & _alone(sent, "p1", "p2")
    shared = stored(screened.where("NOT alone").drop("alone"))
    # Nodes that the sketch has cleared. Only the first of a tail has a parent that is not its own.
    tails = stored(
        screened.where("alone").select(
            "conv_id", "depth", "n_turns", "p1", "p2", inner.alias("inner")
        )
    )
    nodes = stored(
        shared.groupBy("k1", "k2")
        .agg(
            F.min("conv_id").alias("conv_id"),
            F.max("depth").alias("depth"),
            F.count(F.lit(1)).alias("n_convs"),
            F.count_if(F.col("depth") == F.col("n_turns")).alias("n_ends"),
            F.max("n_chars").alias("n_chars"),
            F.max("p1").alias("p1"),
            F.max("p2").alias("p2"),
        )
        .withColumn("inner", inner)
        .withColumn("saved", (F.col("n_convs") - 1) * F.col("n_chars"))
    )
    sent.destroy()

    # Links to parents that are among the nodes: for their children, and for the parent's number.
    linked = ["conv_id", "depth", "p1", "p2"]
    links = stored(
        tails.where("NOT inner AND depth > 0").select(*linked).unionByName(
            nodes.where("NOT inner AND depth > 0").select(*linked)
        )
    )
    parents = nodes.select(
        F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent"), "n_convs"
    )
    limit = n_prefixes // HEAVY_PART
    heavy = F.broadcast(parents.where(F.col("n_convs") > limit).drop("n_convs"))
    light = parents.where(F.col("n_convs") <= limit).drop("n_convs")
    met = stored(
        links.join(heavy, ["p1", "p2"]).unionByName(
            links.join(heavy, ["p1", "p2"], "left_anti").join(light, ["p1", "p2"])
        )
    )

    # Chains: where a conversation becomes the smallest member, what its nodes save, its leaf.
    leaf = F.col("n_convs") == F.col("n_ends")
    chains = stored(
        nodes.select("conv_id", "depth", "saved", leaf.cast("long").alias("leaf"))
        .unionByName(
            tails.where("NOT inner").select(
                "conv_id",
                "depth",
                F.lit(0).cast("long").alias("saved"),
                F.lit(1).cast("long").alias("leaf"),
            )
        )
        .groupBy("conv_id")
        .agg(F.min("depth").alias("top"), F.sum("saved").alias("all"), F.max("leaf").alias("leaf"))
    )
    given = shared.select("conv_id", "depth", "k1", "k2").join(chains, "conv_id").where("depth < top")

    # Along a chain, from the end: strides of it first, then within each.
    stride = F.floor(F.col("depth") / STRIDE).alias("stride")
    down = nodes.select("conv_id", "depth", "k1", "k2", "n_convs", "n_ends", "saved", "inner", stride)
    ahead = Window.partitionBy("conv_id").orderBy(F.desc("stride")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    strides = down.groupBy("conv_id", "stride").agg(F.sum("saved").alias("here"))
    strides = strides.select("conv_id", "stride", F.coalesce(F.sum("here").over(ahead), F.lit(0)).alias("beyond"))
    rest = Window.partitionBy("conv_id", "stride").orderBy(F.desc("depth")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    along = (
        down.join(strides, ["conv_id", "stride"])
        .withColumn("saved", F.sum("saved").over(rest) + F.col("beyond"))
        .join(chains.select("conv_id", "leaf"), "conv_id")
    )

    def part(df: DataFrame, **values: Column) -> DataFrame:
        kinds = {
            "conv_id": "long", "depth": "long", "parent": "long", "n_convs": "long",
            "children": "long", "leaves": "long", "saved": "long", "ends": "string",
        }
        filled = [values.get(n, F.lit(None)).cast(k).alias(n) for n, k in kinds.items()]
        return df.select("k1", "k2", *filled)

    own_parent = F.when(F.col("inner"), F.col("conv_id"))
    parts = [
        part(
            along, conv_id=F.col("conv_id"), depth=F.col("depth"), parent=own_parent,
            n_convs=F.col("n_convs"), leaves=F.col("leaf"), saved=F.col("saved"),
        ),
        part(given, leaves=F.col("leaf"), saved=F.col("all")),
        part(links.withColumnsRenamed({"p1": "k1", "p2": "k2"}), children=F.lit(1)),
        part(
            met.join(nodes.select("conv_id", "depth", "k1", "k2"), ["conv_id", "depth"]),
            parent=F.col("parent"),
        ),
        part(_ends(shared), ends=F.col("ends_sha256")),
    ]
    whole = parts[0]
    for one in parts[1:]:
        whole = whole.unionByName(one)
    nobody = sha256(b"").hexdigest()
    exact = whole.groupBy("k1", "k2").agg(
        F.max("conv_id").alias("conv_id"),
        F.max("depth").alias("depth"),
        F.max("parent").alias("parent_conv_id"),
        F.max("n_convs").alias("n_convs"),
        F.coalesce(F.sum("children"), F.lit(0)).alias("n_children"),
        F.sum("leaves").alias("n_leaves"),
        F.sum("saved").alias("saved_tokens"),
        F.coalesce(F.max("ends"), F.lit(nobody)).alias("ends_sha256"),
    )
    # Tails: everything is known where they stand, but for the parent of their first node.
    ends_here = F.col("depth") == F.col("n_turns")
    first = tails.where("NOT inner").join(met.select("conv_id", "depth", "parent"), ["conv_id", "depth"], "left")
    cleared = first.select("conv_id", "depth", "n_turns", "parent").unionByName(
        tails.where("inner").select("conv_id", "depth", "n_turns", F.col("conv_id").alias("parent"))
    )
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    local = cleared.select(
        "conv_id",
        "depth",
        F.col("parent").alias("parent_conv_id"),
        one.alias("n_convs"),
        F.when(ends_here, none).otherwise(one).alias("n_children"),
        one.alias("n_leaves"),
        none.alias("saved_tokens"),
        F.when(ends_here, F.sha2(F.col("conv_id").cast("string"), 256))
        .otherwise(F.lit(nobody))
        .alias("ends_sha256"),
    )
    return exact.drop("k1", "k2").unionByName(local)
