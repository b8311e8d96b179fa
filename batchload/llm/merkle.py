"""A Merkle manifest of a table: a digest of every row, one root for all, and a proof for each row.

The rows of a partition (a language) in the order of their ids are the leaves of a tree whose nodes
have up to eight children; the roots of the partitions are the leaves of one more such tree. A
node's digest is that of its children's, as text. The proof of a leaf is the digests of its
siblings, level by level up to the root.

Digests travel by time-forward processing. Every node has a label, its level and its place; a
digest is a message to the parent's label, and nodes are worked off in the order of their labels
from one priority queue. The part of the queue that must be external is Spark's sorted shuffle: it
brings the messages of a block of neighbouring nodes together, 8 to the power of BLOCK_LEVELS at
most, whatever the size of the partition. Inside a block a heap does the same for three levels.
Only the top of a block goes on to the next layer, so layers shrink by that factor. The reversed
sweep takes the layers from the root down: every block gets the proof suffix of its top, works its
labels off in reverse order, and hands each of its nodes the suffix it needs.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchload.llm.common import stored
from batchload.llm.ranking import laid_out, ranked, runs

#: Children of a node.
FAN_OUT = 8
#: Levels that one block of nodes covers.
BLOCK_LEVELS = 3
BLOCK = FAN_OUT**BLOCK_LEVELS

#: One level of a proof: the own place among the children of the parent, and the other children.
PROOF = "array<struct<place:int,others:string>>"
_NODE = "tree long, rank long, total long, digest string"
_HANDED = f"tree long, rank long, digest string, proof {PROOF}, subroot string, root string"
_SAID = (
    "id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
)


def digest(*texts: str) -> str:
    return sha256("".join(texts).encode()).hexdigest()


def field(column: Column) -> Column:
    """A value as text that cannot run into the next one: `-`, or byte count, colon, value."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: list[Column]) -> Column:
    """The digest of a row."""
    return F.sha2(F.concat(*[field(column) for column in columns]), 256)


def fold(start: str, proof: list[tuple[int, str]]) -> str:
    """The root that a leaf and its proof lead to."""
    for place, others in proof:
        cut = 64 * place
        start = digest(others[:cut], start, others[cut:])
    return start


def sweep_up(first: int, digests: list[str], total: int) -> dict[tuple[int, int], list[str]]:
    """Children's digests of every inner node of a block, by label (level, place in the level).

    `first` is the place of the first node, `total` the nodes of its level in the whole tree. The
    block ends BLOCK_LEVELS above, or at the root.
    """
    height, left = 0, total
    while left > 1 and height < BLOCK_LEVELS:
        left = -(-left // FAN_OUT)
        height += 1
    queue = [(0, first + i, one) for i, one in enumerate(digests)]  # sorted, so a heap
    inbox: dict[tuple[int, int], list[str]] = {}
    while queue:
        level, place, one = heapq.heappop(queue)
        if level == height:
            inbox[height + 1, place] = [one]  # the top, in the place of a message to the next layer
            continue
        parent = (level + 1, place // FAN_OUT)
        inbox.setdefault(parent, []).append(one)
        last = place % FAN_OUT == FAN_OUT - 1 or not queue or queue[0][:2] > (level, place | 7)
        if last:
            heapq.heappush(queue, (*parent, digest(*inbox[parent])))
    return inbox


def sweep_down(
    first: int, digests: list[str], total: int, suffix: list[tuple[int, str]]
) -> Iterator[list[tuple[int, str]]]:
    """The proof of every node of a block, given that of its top."""
    inbox = sweep_up(first, digests, total)
    top = max(inbox)
    proofs = {(top[0] - 1, top[1]): suffix}
    del inbox[top]
    for level, place in sorted(inbox, reverse=True):
        above, children = proofs.pop((level, place)), inbox[level, place]
        whole = "".join(children)
        for i in range(len(children)):
            others = whole[: 64 * i] + whole[64 * i + 64 :]
            proofs[level - 1, place * FAN_OUT + i] = [(i, others), *above]
    for i in range(len(digests)):
        yield proofs[0, first + i]


def _climb(block: pd.DataFrame) -> pd.DataFrame:
    block = block.sort_values("rank")
    first, total = int(block["rank"].iloc[0]), int(block["total"].iloc[0])
    inbox = sweep_up(first, list(block["digest"]), total)
    (level, place), (one,) = max(inbox.items())
    for _ in range(level - 1):
        total = -(-total // FAN_OUT)
    return pd.DataFrame(
        {"tree": [block["tree"].iloc[0]], "rank": [place], "total": [total], "digest": [one]}
    )


def _pairs(proof: object) -> list[tuple[int, str]]:
    return [(int(level["place"]), level["others"]) for level in proof]


def _structs(proof: list[tuple[int, str]]) -> list[dict[str, object]]:
    return [{"place": place, "others": others} for place, others in proof]


def _proofs(block: pd.DataFrame, above: pd.DataFrame) -> Iterator[list[tuple[int, str]]]:
    first, total = int(block["rank"].iloc[0]), int(block["total"].iloc[0])
    return sweep_down(first, list(block["digest"]), total, _pairs(above["proof"].iloc[0]))


def _hand_down(block: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
    """Nodes of a layer, and what their block gets from above, to what each of them gets."""
    block = block.sort_values("rank")
    return pd.DataFrame(
        {
            "tree": block["tree"],
            "rank": block["rank"],
            "digest": block["digest"],
            "proof": [_structs(proof) for proof in _proofs(block, above)],
            "subroot": above["subroot"].iloc[0],
            "root": above["root"].iloc[0],
        }
    )


def _prove(block: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
    """Leaves, and what their block gets from above, to what is reported of them."""
    block = block.sort_values("rank")
    found = _proofs(block, above)
    said = [(digest(*[o for _, o in p]), fold(shown, p)) for shown, p in zip(block["shown"], found)]
    return pd.DataFrame(
        {
            "id": block["id"],
            "leaf": block["digest"],
            "subroot": above["subroot"].iloc[0],
            "root": above["root"].iloc[0],
            "proof_sha256": [one for one, _ in said],
            "folded_root": [root for _, root in said],
        }
    )


def _block() -> Column:
    return F.floor(F.col("rank") / BLOCK).cast("long").alias("block")


def _layers(nodes: DataFrame) -> list[DataFrame]:
    """The nodes of a forest, layer by layer, up to one node for each tree."""
    layers = [nodes]
    while layers[-1].where("total > 1").limit(1).count():
        blocks = layers[-1].select("tree", "rank", "total", "digest", _block())
        layers.append(stored(blocks.groupBy("tree", "block").applyInPandas(_climb, _NODE)))
    return layers


def _meet(nodes: DataFrame, above: DataFrame, function: object, schema: str) -> DataFrame:
    """Blocks of nodes with the one row that each gets from above. Neither is copied to the other
    on the way: a suffix is larger than the nodes."""
    blocks = nodes.withColumn("block", _block()).groupBy("tree", "block")
    return blocks.cogroup(above.groupBy("tree", "block")).applyInPandas(function, schema)


def _reverse(layers: list[DataFrame], tops: DataFrame) -> DataFrame:
    """What the blocks of the lowest layer get: (tree, block, proof, subroot, root), from the same of
    the trees' tops."""
    handed = tops.withColumn("block", F.lit(0).cast("long"))
    for layer in layers[-2:0:-1]:
        handed = stored(_meet(layer, handed, _hand_down, _HANDED)).withColumnRenamed("rank", "block")
    return handed


def manifest(
    table: DataFrame,
    columns: list[str],
    id_col: str = "doc_id",
    partition_col: str = "lang",
    shown: dict[str, Column] | None = None,
) -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root) for every row of a table.

    `columns` are digested, in this order. `shown` maps some of them to what a reader holds instead
    of the stored value: `folded_root` is the root that the reader's row and the proof lead to, and
    equals `root` if nothing has changed.

    Rows of a partition are in the order of their ids, null first; rows of equal ids in that of
    their digests, so that equal rows may stand for one another. Rows without a partition value are
    a partition of their own, before the others; those go by the bytes of their names. Null values
    are digested as `-`, which no text gives. A table without rows has no manifest rows. Other
    columns do not matter, whatever their names. Only digests leave the first scan, and blocks of
    BLOCK digests are the largest groups that meet in a task.
    """
    seen = [F.col(f"`{name}`") for name in columns]
    held = [(shown or {}).get(name, F.col(f"`{name}`")) for name in columns]
    own, reader = leaf(seen), leaf(held) if shown else F.lit(None).cast("string")
    thin = stored(
        table.select(
            F.col(f"`{partition_col}`").cast("string").alias("part"),
            F.col(f"`{id_col}`").alias("id"),
            own.alias("digest"),
            reader.alias("shown"),
        )
    )
    rows = laid_out(thin, ["part", "id", "digest"])
    # Trees go by number: the place of their partition among all, null first.
    parts = laid_out(thin.select("part").distinct().withColumn("all", F.lit(0)), ["part"])
    numbers = stored(
        ranked(parts, "all").select(F.col("part").alias("name"), F.col("rank").alias("tree"))
    )
    found = runs(rows, "part")
    found = found.join(numbers, found["part"].eqNullSafe(numbers["name"])).drop("name")
    leaves = stored(
        ranked(rows, "part", found).select(
            "tree",
            "rank",
            "total",
            F.col("id").cast("string").alias("id"),  # pandas would make a float of a null number
            "digest",
            F.coalesce("shown", "digest").alias("shown"),
        )
    )

    layers = _layers(leaves)
    subroots = stored(
        layers[-1].select(
            F.lit(0).cast("long").alias("tree"),
            F.col("tree").alias("rank"),
            F.lit(numbers.count()).cast("long").alias("total"),
            "digest",
        )
    )
    upper = _layers(subroots)
    start = upper[-1].select(
        "tree",
        F.array().cast(PROOF).alias("proof"),
        F.lit(None).cast("string").alias("subroot"),
        F.col("digest").alias("root"),
    )
    trees = stored(_meet(subroots, _reverse(upper, start), _hand_down, _HANDED))
    tops = trees.select(
        F.col("rank").alias("tree"), "proof", F.col("digest").alias("subroot"), "root"
    )
    said = _meet(leaves, _reverse(layers, tops), _prove, _SAID)
    return said.withColumn("id", F.col("id").cast(thin.schema["id"].dataType))
