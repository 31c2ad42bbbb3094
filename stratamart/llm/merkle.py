"""A Merkle manifest of a table: digests of rows, roots, and a proof for every row.

Rows are leaves of one tree per ``tree`` value, in a stated order. Every two consecutive nodes
become the digest of both (the last run of a level may be a single node, digested alone) until
one is left, the subroot; the subroots, ordered by tree, become the root in the same way.

Trees are cut into superblocks of ``2 ** BITS`` consecutive nodes. Going up, every superblock
is reduced to one node; those are cut again, so the number of steps grows with the logarithm
to the base ``2 ** BITS``. Going down, the nodes of a superblock are cogrouped with the one
outer node they need, the proof of their common top: ``applyInPandas`` finishes the local
reduction, joins local and outer proofs, and folds each row's claimed leaf up to a root.

No group is larger than a superblock. Numbering uses a range partitioning of the leaves (the
texts are read once, before) and one row per partition and tree. Working tables lie in the
shared folder, so a lost executor repeats a step's task.

Defined cases: nulls are digested as ``-``; a null tree is a tree of its own, the first; null
order values come first; rows tied in every digested column are interchangeable; an empty
table gives no rows. Names of the operator's own columns start with an underscore and only
the columns named are read, so others cannot clash.
"""

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from stratamart.llm.common import Steps, partitions_for

BITS = 12


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(value: Column) -> Column:
    """A value with its length, so that no two rows are written alike; null is ``-``."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field, values)).cast("binary"), 256)


def depth(nodes: int, bits: int) -> int:
    """Levels that one superblock of a level with so many nodes goes up."""
    return min(bits, max(0, nodes - 1).bit_length())


def reduced(nodes: list[str], levels: int) -> list[list[str]]:
    """The nodes of a superblock level by level; the last level is its top."""
    every = [nodes]
    for _ in range(levels):
        last = every[-1]
        every.append([digest("".join(last[i : i + 2])) for i in range(0, len(last), 2)])
    return every


def path(every: list[list[str]], at: int) -> tuple[str, str]:
    """Siblings of a node up to the top, and per level where the sibling stands: L, R or -."""
    proof, sides = [], []
    for level in every[:-1]:
        other = at ^ 1
        if other < len(level):
            proof.append(level[other])
        sides.append("-" if other >= len(level) else "L" if other < at else "R")
        at >>= 1
    return "".join(proof), "".join(sides)


def folded(node: str, proof: str, sides: str) -> str:
    """The root that a leaf and a proof lead to."""
    at = 0
    for side in sides:
        sibling = "" if side == "-" else proof[at : at + 64]
        at += len(sibling)
        node = digest(sibling + node if side == "L" else node + sibling)
    return node


def numbered(steps: Steps, name: str, rows: DataFrame, within: str, order: list[str]) -> DataFrame:
    """Rows with ``_pos``, their number within a group from 0, and ``_n``, the group's size.

    Also ``_group``, the group's own number in the order of groups. A partition of a range
    partitioning counts its rows per group; the counts, at most a row per partition and group,
    give each partition its offset.
    """
    spark = rows.sparkSession
    keys = [within, *order, "_salt"]
    spread = rows.withColumn("_salt", F.monotonically_increasing_id())
    ranged = spread.repartitionByRange(partitions_for(spark), *keys).sortWithinPartitions(*keys)
    placed = steps.store(name, ranged.drop("_salt").withColumn("_at", F.monotonically_increasing_id()))
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    runs = placed.groupBy("_part", within).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(within).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.select(
        "_part",
        within,
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(Window.partitionBy(within)).alias("_n"),
    )
    return placed.join(offsets, ["_part", within]).withColumn("_pos", F.col("_at") + F.col("_shift"))


NODE = "_tree long, _pos long, _n long, _digest string"
OUTER = "_tree long, _pos long, _proof string, _sides string, _subroot string, _root string"


def tops(nodes: DataFrame, bits: int) -> DataFrame:
    """One node per superblock: the level that many levels up."""

    def top(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("_pos")
        first = block.iloc[0]
        every = reduced(block["_digest"].tolist(), depth(int(first["_n"]), bits))
        row = first["_tree"], first["_pos"] >> bits, -(-first["_n"] >> bits), every[-1][0]
        return pd.DataFrame([row], columns=["_tree", "_pos", "_n", "_digest"])

    return nodes.select("_tree", "_pos", "_n", "_digest", F.shiftright("_pos", bits).alias("_block")).groupBy(
        "_tree", "_block"
    ).applyInPandas(top, NODE)


def exchanged(nodes: DataFrame, outer: DataFrame, bits: int, extra: str = "") -> DataFrame:
    """Nodes with their proofs up to the root, superblock by superblock.

    ``extra`` declares columns of ``nodes`` that are kept; of these ``_claimed`` is folded
    into ``_folded``.
    """
    kept = [c.split()[0] for c in extra.split(",") if c]
    fold = "_claimed" in kept

    def join(block: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("_pos", ignore_index=True)
        up = above.iloc[0]
        every = reduced(block["_digest"].tolist(), depth(int(block["_n"].iloc[0]), bits))
        paths = [path(every, i) for i in range(len(block))]
        out = block[["_tree", "_pos", *kept]].copy()
        out["_proof"] = [proof + up["_proof"] for proof, _ in paths]
        out["_sides"] = [sides + up["_sides"] for _, sides in paths]
        out["_subroot"] = up["_subroot"] if up["_subroot"] else block["_digest"]
        out["_root"] = up["_root"]
        if fold:
            out["_folded"] = [folded(*row) for row in zip(out["_claimed"], out["_proof"], out["_sides"])]
        return out

    keys = [F.shiftright("_pos", bits).alias("_block"), "_tree"]
    columns = dict.fromkeys(["_pos", "_n", "_digest", *kept])
    left = nodes.select(*keys, *columns).groupBy("_tree", "_block")
    right = outer.withColumnRenamed("_pos", "_block").groupBy("_tree", "_block")
    schema = ", ".join(["_tree long, _pos long", *([extra] if extra else []), OUTER.partition("_pos long, ")[2]])
    return left.cogroup(right).applyInPandas(join, schema + (", _folded string" if fold else ""))


def prove(rows: DataFrame, tree: str, order: str, leaf: str, claimed: str, bits: int = BITS) -> DataFrame:
    """``order, leaf, subroot, root, proof, sides, folded_root`` of every row.

    ``proof`` holds the siblings' digests from the leaf's level to the root, ``sides`` where
    each level's sibling stands. ``claimed`` is the leaf that is folded with them.
    """
    spark = rows.sparkSession
    steps = Steps(spark)
    kind = rows.schema[order].dataType.simpleString()
    key = F.coalesce(F.concat(F.lit("="), F.col(tree).cast("string")), F.lit("-"))  # null first
    leaves = steps.store(
        "leaves",
        rows.select(
            key.alias("_key"),
            F.col(order).alias("_order"),
            F.col(leaf).alias("_digest"),
            F.col(claimed).alias("_claimed"),
        ),
    )
    placed = numbered(steps, "placed", leaves, "_key", ["_order", "_digest", "_claimed"])
    sizes = placed.groupBy("_key").agg(F.max("_n").alias("_size")).withColumn("_all", F.lit(0))
    trees = steps.store(
        "trees",
        numbered(steps, "keys", sizes, "_all", ["_key"]).select(
            "_key", F.col("_pos").alias("_tree"), "_size", F.col("_n").alias("_trees")
        ),
    )
    steps.drop("leaves", "keys")
    most, count = trees.agg(F.max("_size"), F.max("_trees")).first()
    if most is None:
        none = [F.lit(None).cast("string").alias(c) for c in ("subroot", "root", "proof", "sides", "folded_root")]
        return rows.select(F.col(order), F.col(leaf).alias("leaf"), *none)
    base = placed.join(trees.drop("_trees"), "_key").select(
        "_tree", "_pos", "_n", "_digest", F.col("_order").cast("string").alias("_order"), "_claimed"
    )

    levels = [base]  # nodes to be cut into superblocks, the leaves first
    while most:
        levels.append(steps.store(f"level{len(levels)}", tops(levels[-1], bits)))
        most = -(-most >> bits) if most > 1 << bits else 0

    # the subroots are the last level's nodes; they are the leaves of the tree above all trees
    upper = [
        levels.pop().select(
            F.lit(0).cast("long").alias("_tree"),
            F.col("_tree").alias("_pos"),
            F.lit(count).cast("long").alias("_n"),
            "_digest",
        )
    ]
    while count > 1:
        upper.append(steps.store(f"upper{len(upper)}", tops(upper[-1], bits)))
        count = -(-count >> bits)

    empty = F.lit("")
    outer = upper[-1].select(
        "_tree",
        "_pos",
        empty.alias("_proof"),
        empty.alias("_sides"),
        F.col("_digest").alias("_subroot"),
        F.col("_digest").alias("_root"),
    )
    last = ""
    for number, nodes in reversed(list(enumerate(upper[:-1]))):
        last = f"outer_upper{number}"
        outer = steps.store(last, exchanged(nodes, outer.withColumn("_subroot", empty), bits))
    outer = outer.withColumn("_tree", F.col("_pos")).withColumn("_pos", F.lit(0).cast("long"))
    for number, nodes in reversed(list(enumerate(levels[1:], 1))):
        before, last = last, f"outer{number}"
        outer = steps.store(last, exchanged(nodes, outer, bits))
        steps.drop(before, f"level{number}")
    proved = exchanged(base, outer, bits, "_order string, _digest string, _claimed string")
    return proved.select(
        F.col("_order").cast(kind).alias(order),
        F.col("_digest").alias("leaf"),
        F.col("_subroot").alias("subroot"),
        F.col("_root").alias("root"),
        F.col("_proof").alias("proof"),
        F.col("_sides").alias("sides"),
        F.col("_folded").alias("folded_root"),
    )


#: What a leaf is digested from, in this order.
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def manifest(docs: DataFrame, claims: dict[str, Column] | None = None, bits: int = BITS) -> DataFrame:
    """The manifest of a documents table, one tree per language, ordered by id.

    ``claims`` gives columns of the rows to be verified that may differ from ``docs``; the
    proof of a changed row leads to another root.
    """
    claimed = {c: F.col(c) for c in COLUMNS} | (claims or {})
    changed = F.lit(False)
    for name in claims or ():
        changed = changed | ~claimed[name].eqNullSafe(F.col(name))
    own = leaf(*[F.col(c) for c in COLUMNS])
    rows = docs.select(
        "doc_id",
        "lang",
        own.alias("_leaf"),
        F.when(changed, leaf(*[claimed[c] for c in COLUMNS])).otherwise(own).alias("_claimed"),
    )
    return prove(rows, "lang", "doc_id", "_leaf", "_claimed", bits)
