"""N-gram Jaccard join: size-banded tiles, bitmap signatures, exact intersection.

Documents whose shingle sets are similar enough differ in few shingles, at most 3/37 of both sizes
together at a similarity of 0.85. The hash range is cut into more parts than that, their number
given by a band of sizes, so that both documents are equal in several parts. Each document lists the
parts it has (a key per part). Keys are dropped as far as the surplus of equal parts allows, the most
frequent ones first, so that text that very many documents share brings no large groups together.

Each key makes the smallest of its documents the hub of a star with all others. Comparing them with
the hub first joins near copies with few comparisons. Stars that still hold several components are cut
by size into tiles of bounded length, and tiles are compared with each other where their sizes permit:
the bits in which two hashed bitmap signatures differ bound the overlap from above, and what passes is
decided by exact intersection of sorted arrays. No pair of similar documents is left out, and pairs
within a component are not listed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from batchload.llm.common import components, mix64, small_batches, stored

#: Up to so many ids are broadcast to pick the texts of candidates; more are joined by shuffle.
BROADCAST_ROWS = 1_000_000
#: Rows of a tile at the comparison.
TILE = 1024
#: Rows compared with the other tile at once, and pairs of bitmaps.
CHUNK = 64
PAIRS = 4096
#: Pairs of whole sets that Python holds at once.
PAIR_BATCH = 500
#: A size band ends at this multiple of its start. Wider bands have more empty parts, narrower ones
#: have more sets that list keys of the next band too.
BAND = 1.8
LEVELS = 64
#: No set is as large: a string ends below this many bytes. The bands reach it with 60 levels at most.
LONGEST = 1 << 31
KEPT_WORDS = 100_000


@dataclass(frozen=True)
class Similarity:
    """Sets link when 100 * |intersection| >= percent * |union|."""

    percent: int = 85

    def most_different(self, sizes: int) -> int:
        """How many elements linked sets of together `sizes` elements differ in at most."""
        return sizes * (100 - self.percent) // (100 + self.percent)

    def largest(self, size: int) -> int:
        return size * 100 // self.percent

    def least(self) -> int:
        """The least size of a set that can link with another than itself."""
        n = 1
        while 100 * n < self.percent * (n + 1):
            n += 1
        return n


@dataclass(frozen=True)
class Level:
    """A band of sizes from `low` to `high`: parts, and how many keys can be dropped by frequency."""

    number: int
    low: int
    high: int
    parts: int
    spare: int

    # Made when a set of the band comes up: the bands of long texts have millions of parts.
    @cached_property
    def bounds(self) -> np.ndarray:
        """Where each part of the hash range ends."""
        ends = (((i + 1) << 64) // self.parts - 1 for i in range(self.parts))
        return np.fromiter(ends, np.uint64, self.parts)

    @cached_property
    def seeds(self) -> np.ndarray:
        return mix64(np.arange(self.parts, dtype=np.uint64) + np.uint64((self.number + 1) << 32))


@lru_cache(maxsize=8)
def levels(rule: Similarity) -> tuple[Level, ...]:
    out, low = [], rule.least()
    while len(out) < LEVELS and low < LONGEST:
        high = max(low + 1, int(low * max(BAND, 1.1 * 100 / rule.percent)) - 1)
        different = rule.most_different(2 * high)
        spare = max(4, -(-different // 10))
        out.append(Level(len(out), low, high, different + 1 + spare, spare))
        low = high + 1
    return tuple(out)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


class Shingler:
    """The shingle sets of texts: sorted arrays of 64-bit hashes of runs of n words.

    Words are runs of anything but ASCII white space, with A-Z in lower case. A text with fewer than
    n words has one shingle, the whole; one without words has none.
    """

    FACTORS = np.array([0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F], np.uint64)

    def __init__(self, n: int):
        self.n = n
        self.hashes = _Hashes()

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        if len(self.hashes) > KEPT_WORDS:
            self.hashes.clear()
        found = np.fromiter(map(self.hashes.__getitem__, words), np.uint64, len(words))
        width = min(self.n, len(words))
        total = found[: len(found) - width + 1] + np.uint64(width)
        for k in range(1, width):
            factor = self.FACTORS[k % 3] + np.uint64(2 * k)
            total = mix64(total * factor) + found[k : len(found) - width + 1 + k]
        return np.unique(mix64(total))


def set_hash(elements: np.ndarray) -> int:
    """A hash of a set, as a signed number."""
    total = mix64(elements ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return int(mix64(np.array([total + np.uint64(len(elements))]))[0].astype(np.int64))


def _of_levels(
    elements: np.ndarray, rule: Similarity
) -> Iterator[tuple[Level, np.ndarray, np.ndarray]]:
    """Level, keys, and which of them are of empty parts: for a set's own level and, as a smaller
    partner, the next one.

    A key holds its level in the last six bits. Of the keys of a level those with the smallest
    values are kept: enough that linked sets have `spare` + 1 of them in common.
    """
    size = len(elements)
    for level in levels(rule):
        largest = rule.largest(size)
        if level.low > largest:
            break
        if level.high < size:
            continue
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(mix64(elements + np.uint64(1)), out=sums[1:])
        ends = np.searchsorted(elements, level.bounds, side="right")
        upto = sums[ends]
        parts = np.diff(upto, prepend=np.uint64(0))
        keys = mix64(mix64(parts) + level.seeds)
        keys = (keys & ~np.uint64(63)) | np.uint64(level.number)
        empty = np.diff(ends, prepend=0) == 0
        kept = rule.most_different(size + min(level.high, largest)) + 1 + level.spare
        if kept < len(keys):
            at = np.argpartition(keys, kept - 1)[:kept]
            keys, empty = keys[at], empty[at]
        yield level, keys, empty


def keys_of(elements: np.ndarray, rule: Similarity) -> np.ndarray:
    """The keys of a set, of all its levels."""
    out = [keys for _, keys, _ in _of_levels(elements, rule)]
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def telling_keys(elements: np.ndarray, rule: Similarity) -> tuple[np.ndarray, list[int]]:
    """The keys of a set without those of empty parts, as far as `spare` allows; and for each level,
    in the last six bits, how many more may be dropped, by their frequency.

    Keys of empty parts say nothing, and very many sets have them. All keys are dropped by one
    order: of linked sets, the last key in it that they share is not among the first `spare` of
    either, so they still share that one.
    """
    out, quotas = [np.zeros(0, np.uint64)], []
    for level, keys, empty in _of_levels(elements, rule):
        at = np.flatnonzero(empty)
        at = at[np.argsort(keys[at])][::-1][: level.spare]
        out.append(np.delete(keys, at))
        quotas.append((level.spare - len(at)) << 6 | level.number)
    return np.concatenate(out), quotas


def signature(elements: np.ndarray) -> bytes:
    """A bitmap of one bit per element, by its last bits; at least 16 times as many bits as elements."""
    bits = max(64, 1 << (16 * max(1, len(elements)) - 1).bit_length())
    bitmap = np.zeros(bits, np.uint8)
    bitmap[(elements & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(bitmap, bitorder="little").tobytes()


def folded(bitmap: np.ndarray, words: int) -> np.ndarray:
    """A signature of fewer words: the one that hashing to fewer bits would have made."""
    while len(bitmap) > words:
        half = len(bitmap) // 2
        bitmap = bitmap[:half] | bitmap[half:]
    return bitmap


def described(docs: DataFrame, n: int, rule: Similarity) -> DataFrame:
    """(doc_id, n_shingles, node, quotas, keys) for every row of (doc_id, text).

    `node` is a hash of the set, so that equal sets are one node; null without shingles.
    """

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(n)
        for batch in batches:
            sizes, nodes, quotas, keys, offsets = [], [], [], [], [0]
            texts = batch.column(1)
            for row in range(batch.num_rows):
                elements = shingles(texts[row].as_py())
                sizes.append(len(elements))
                nodes.append(set_hash(elements) if len(elements) else None)
                found, quota = telling_keys(elements, rule)
                keys.append(found)
                quotas.append(quota)
                offsets.append(offsets[-1] + len(keys[-1]))
            flat = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(nodes, pa.int64()),
                    pa.array(quotas, pa.list_(pa.int64())),
                    pa.ListArray.from_arrays(
                        pa.array(offsets, pa.int32()), pa.array(flat.view(np.int64), pa.int64())
                    ),
                ],
                names=["doc_id", "n_shingles", "node", "quotas", "keys"],
            )

    schema = "doc_id long, n_shingles long, node long, quotas array<long>, keys array<long>"
    return docs.mapInArrow(describe, schema)


def listed(rows: DataFrame) -> DataFrame:
    """(key, node): the keys that several rows have, less those that can be dropped."""
    each = rows.select("node", F.explode("keys").alias("key"))
    shared = each.groupBy("key").agg(F.count("*").alias("rows")).where("rows > 1")
    held = each.join(shared, "key").groupBy("key", "node").agg(
        F.first("rows").alias("rows")
    )
    # How many keys of a node and level may still go: a row for each, the same for all copies.
    quotas = rows.select("node", F.explode("quotas").alias("quota")).distinct().select(
        "node", F.col("quota").bitwiseAND(F.lit(63)).alias("level"), F.shiftright("quota", 6).alias("quota")
    )
    held = held.withColumn("level", F.col("key").bitwiseAND(F.lit(63)))
    order = Window.partitionBy("node", "level").orderBy(F.desc("rows"), F.desc("key"))
    held = held.join(quotas, ["node", "level"]).withColumn("place", F.row_number().over(order))
    return stored(held.where(F.col("place") > F.col("quota")).select("key", "node"))


def sets_of(docs: DataFrame, classes: DataFrame, nodes: DataFrame, n: int) -> DataFrame:
    """(node, elements, bitmap): the shingle sets of some nodes, from the text of one document each."""
    wanted = stored(
        classes.join(nodes, "node", "left_semi").select("node", F.col("low").alias("doc_id"))
    )
    few = wanted.count() <= BROADCAST_ROWS
    ids = wanted.select("doc_id").distinct()
    texts = docs.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(n)
        for batch in batches:
            found = [shingles(text.as_py()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([set_hash(x) if len(x) else None for x in found], pa.int64()),
                    pa.array([x.tobytes() for x in found], pa.binary()),
                    pa.array([signature(x) for x in found], pa.binary()),
                ],
                names=["node", "elements", "bitmap"],
            )

    found = texts.mapInArrow(shingled, "node long, elements binary, bitmap binary")
    # An id that several rows share brings their other sets along; a set found twice is one.
    return stored(
        found.where("node IS NOT NULL").groupBy("node").agg(
            F.first("elements").alias("elements"), F.first("bitmap").alias("bitmap")
        )
    )


def verified(pairs: DataFrame, sets: DataFrame, rule: Similarity) -> DataFrame:
    """The pairs (a, b) of nodes whose sets link."""
    sets = sets.select("node", "elements")
    second = pairs.join(sets.withColumnsRenamed({"node": "b", "elements": "b_set"}), "b")
    both = second.join(sets.withColumnsRenamed({"node": "a", "elements": "a_set"}), "a")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("a_set"), batch.column("b_set"), strict=True):
                one, two = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
                if len(one) > len(two):
                    one, two = two, one
                at = np.minimum(np.searchsorted(two, one), len(two) - 1)
                common = int((two[at] == one).sum())
                union = len(one) + len(two) - common
                keep.append(100 * common >= rule.percent * union)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    with small_batches(both.sparkSession, PAIR_BATCH):
        return stored(both.select("a", "b", "a_set", "b_set").mapInArrow(check, "a long, b long"))


def stars(held: DataFrame) -> DataFrame:
    """(hub, node): every node with the smallest node of each of its keys."""
    hubs = held.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("z"))
    return stored(
        held.join(hubs.where("hub < z"), "key").where("node <> hub").select("hub", "node").distinct()
    )


def tiled(star: DataFrame, joined: DataFrame, sets: DataFrame, rule: Similarity) -> DataFrame:
    """(a, b): pairs of nodes in different components that may link.

    Nodes with a key in common are in the star of that key's hub, so each star is compared within
    itself, by size and by bitmap. Nodes come once per star, however many keys they share.
    """
    rest = star.unionByName(star.select("hub", F.col("hub").alias("node")).distinct())
    component = F.coalesce("component", "node").alias("component")
    rest = rest.join(joined, "node", "left").select("hub", "node", component)
    open_ = rest.groupBy("hub").agg(
        F.min("component").alias("low"), F.max("component").alias("high")
    ).where("low < high").select("hub")
    rest = rest.join(open_, "hub", "left_semi").join(
        sets.select("node", (F.octet_length("elements") / 8).cast("long").alias("size")), "node"
    )
    place = F.row_number().over(Window.partitionBy("hub").orderBy("size", "node"))
    rest = stored(rest.withColumn("tile", F.floor((place - 1) / TILE).cast("int")))
    sizes = rest.groupBy("hub", "tile").agg(
        F.min("size").alias("least"), F.max("size").alias("most")
    )
    x, y = sizes.alias("x"), sizes.alias("y")
    met = x.join(y, F.expr("x.hub = y.hub AND x.tile <= y.tile "
                           f"AND y.least * {rule.percent} <= x.most * 100")).select(
        "x.hub", F.col("x.tile").alias("one"), F.col("y.tile").alias("two")
    )
    met = stored(met)
    sides = rest.join(met.withColumn("tile", F.col("one")), ["hub", "tile"]).unionByName(
        rest.join(met.where("one < two").withColumn("tile", F.col("two")), ["hub", "tile"])
    )
    sides = sides.join(sets.select("node", "bitmap"), "node")
    dealt = sides.repartition("hub", "one", "two").sortWithinPartitions("hub", "one", "two", "tile")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_back, last = [], None
        for batch in batches:
            for row in batch.to_pylist():
                tiles = row["hub"], row["one"], row["two"]
                if last is not None and last != tiles:
                    yield _passing(held_back, rule)
                    held_back = []
                last = tiles
                held_back.append(row)
        if held_back:
            yield _passing(held_back, rule)

    return stored(dealt.mapInArrow(compare, "a long, b long").distinct())


def _passing(rows: list[dict], rule: Similarity) -> pa.RecordBatch:
    """Pairs of one tile with itself, or of two tiles, that size and bitmaps let pass.

    The bitmaps are compared folded to few words first, what passes then in full.
    """
    words = min(len(row["bitmap"]) for row in rows) // 8
    full = np.stack([folded(np.frombuffer(row["bitmap"], np.uint64), words) for row in rows])
    short = np.stack([folded(row, max(1, words // 8)) for row in full])
    size, node, component, tile = (
        np.array([row[name] for row in rows], np.int64)
        for name in ("size", "node", "component", "tile")
    )
    second = np.flatnonzero(tile != tile[0])
    across = len(second) > 0
    first = np.flatnonzero(tile == tile[0]) if across else np.arange(len(rows))
    second = second if across else first
    a_out, b_out = [], []

    def near(x: np.ndarray, y: np.ndarray, differ: np.ndarray) -> np.ndarray:
        overlap = (size[x] + size[y] - differ) // 2
        return 100 * overlap >= rule.percent * (size[x] + size[y] - overlap)

    for at in range(0, len(first), CHUNK):
        x = first[at : at + CHUNK]
        least, most = np.minimum.outer(size[x], size[second]), np.maximum.outer(size[x], size[second])
        ok = (100 * least >= rule.percent * most) & (component[x][:, None] != component[second])
        if not across:
            ok &= x[:, None] < second
        i, j = np.nonzero(ok)
        x, y = x[i], second[j]
        for bitmaps in (short, full):
            if len(x):
                differ = np.concatenate([
                    np.bitwise_count(bitmaps[x[k : k + PAIRS]] ^ bitmaps[y[k : k + PAIRS]])
                    .sum(axis=1, dtype=np.int64)
                    for k in range(0, len(x), PAIRS)
                ])
                passed = near(x, y, differ)
                x, y = x[passed], y[passed]
        a_out.append(np.minimum(node[x], node[y]))
        b_out.append(np.maximum(node[x], node[y]))
    empty = [np.zeros(0, np.int64)]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(a_out or empty)), pa.array(np.concatenate(b_out or empty))],
        names=["a", "b"],
    )


def similar_documents(
    docs: DataFrame, n: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of `docs`.

    Two documents link when their sets of n-word shingles have at least `percent` hundredths of
    their union in common. component_id is the smallest id reachable by links. A null or empty text
    has no shingles and links with nothing. Rows that repeat an id are one document, which links
    with whatever any of them links with; rows without an id keep a null component and link with
    nothing. Other columns play no part; an empty table gives no rows.
    """
    rule = Similarity(percent)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = stored(described(docs, n, rule))
    named = rows.where("doc_id IS NOT NULL AND node IS NOT NULL")
    held = listed(named)
    classes = stored(named.groupBy("node").agg(F.min("doc_id").alias("low")))
    sets = sets_of(docs, classes, held.select("node").distinct(), n)
    star = stars(held)
    links = verified(star.select(F.col("hub").alias("a"), F.col("node").alias("b")), sets, rule)
    more = tiled(star, components(links), sets, rule)
    links = links.unionByName(verified(more, sets, rule))
    # Components of nodes, named by their smallest document.
    doc_edges = (
        links.join(classes.withColumnsRenamed({"node": "a", "low": "x"}), "a")
        .join(classes.withColumnsRenamed({"node": "b", "low": "y"}), "b")
        .select(F.col("x").alias("a"), F.col("y").alias("b"))
    )
    # Rows that repeat an id with other text tie their sets together.
    ids = named.select("doc_id", "node").distinct()
    repeated = ids.groupBy("doc_id").agg(F.count("*").alias("k")).where("k > 1").select("doc_id")
    ties = ids.join(repeated, "doc_id").join(classes, "node").select(
        F.col("doc_id").alias("a"), F.col("low").alias("b")
    )
    reached = components(doc_edges.unionByName(ties)).withColumnRenamed("node", "low")
    classes = stored(
        classes.join(reached, "low", "left").select(
            "node", F.coalesce("component", "low").alias("component_id")
        )
    )
    own = F.when(F.col("doc_id").isNotNull(), F.col("node")).alias("node")
    return rows.select("doc_id", "n_shingles", own).join(classes, "node", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )
