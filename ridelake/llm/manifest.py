"""Merkle manifest of a dataset, its proofs gathered by a butterfly exchange.

A row is a leaf: the digest of its fields. The leaves of a group (a source) are
ordered by id and hashed in runs of ``FANOUT`` until one node is left, the
group's subtree root; these, ordered by group, are hashed likewise to the root.

Leaves are numbered by a range sort and dealt into aligned blocks of
``FANOUT ** LOCAL_LEVELS`` consecutive ones, a block being what one task hashes
on its own. Above the blocks there is no upward and downward pass but an
exchange among equals: in every round the blocks of ``FANOUT`` neighbouring
subtrees swap the roots they hold, each meeting one block of every
neighbour, and all of them hash the common ancestor, redundantly. So a block gains one
level of its proof a round and ends with the root. Where the last subtree
has fewer blocks than its neighbours, its blocks stand in for the missing ones
in turn. Subtrees of several groups meet in the same way, whatever their sizes.

Nothing but small rows moves: the text is hashed where it is read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

FANOUT = 16
LOCAL_LEVELS = 3            # a block is 16 ** 3 = 4,096 leaves
_INDEX_BITS = 33            # of monotonically_increasing_id: the rest is the partition


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field_bytes(value: Column) -> Column:
    """``-`` for null, else the UTF-8 length, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return digest(*[field_bytes(v) for v in values])


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf digest and its proof lead to."""
    return F.aggregate(proof, leaf, lambda at, level: digest(level["left"], at, level["right"]))


def proof_digest(proof: Column) -> Column:
    """Digest of all siblings, level by level, left to right."""
    return digest(F.array_join(F.transform(proof, lambda level: F.concat(level["left"], level["right"])), ""))


def ordered_places(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` sorted by range and staged, with ``_part`` and ``_index``, the place within that partition.

    Equal rows are told apart by where they were read, so a range holds no more of them than of others.
    """
    spread = df.withColumn("_spread", F.monotonically_increasing_id())
    keys = [F.col(c).asc_nulls_first() for c in order] + [F.col("_spread").asc()]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.monotonically_increasing_id()
    sorted_ = spread.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("_spread").withColumn("_place", place)
    return staged(sorted_.withColumn("_part", F.shiftright("_place", _INDEX_BITS)).withColumn(
        "_index", F.col("_place").bitwiseAND((1 << _INDEX_BITS) - 1)).drop("_place"), name)


def group_levels(groups: DataFrame, fanout: int, width: int) -> DataFrame:
    """``groups`` (``_group``, ``_leaves``) with ``rank``, ``blocks``, ``first`` (blocks before it) and ``upper``.

    ``upper`` has, for each level above the groups, the ``node`` they are under, its first block
    ``start``, its number of blocks ``own`` and the ``most`` blocks of any subtree it swaps with.
    """
    placed = ordered_places(groups, ["_group"], "manifest-groups")
    placed = placed.withColumn("blocks", F.ceil(F.col("_leaves") / width))
    in_order = Window.partitionBy("_part").orderBy("_index").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("_before", F.coalesce(F.sum("blocks").over(in_order), F.lit(0)))
    sums = placed.groupBy("_part").agg(F.count("*").alias("_n"), F.sum("blocks").alias("_b"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    sums = sums.select(F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_rank0"),
                       F.coalesce(F.sum("_b").over(earlier), F.lit(0)).alias("_first0"))
    ranked = placed.join(sums, F.col("_part") == F.col("_p")).select(
        "_group", "_leaves", "blocks", (F.col("_rank0") + F.col("_index")).alias("rank"),
        (F.col("_first0") + F.col("_before")).alias("first"), F.array().cast(
            "array<struct<node:bigint,start:bigint,own:bigint,most:bigint>>").alias("upper"))
    ranked = staged(ranked, "manifest-ranks")
    n, span = ranked.count(), 1
    while span < n:
        node, parent = F.floor(F.col("rank") / span), F.floor(F.col("rank") / (span * fanout))
        nodes = ranked.groupBy(node.alias("_node")).agg(F.min("first").alias("_start"), F.sum("blocks").alias("_own"))
        most = nodes.groupBy(F.floor(F.col("_node") / fanout).alias("_parent")).agg(F.max("_own").alias("_most"))
        level = F.struct(F.col("_node").alias("node"), F.col("_start").alias("start"), F.col("_own").alias("own"), F.col("_most").alias("most"))
        ranked = (ranked.join(nodes, node == F.col("_node")).join(most, parent == F.col("_parent"))
                  .select("_group", "_leaves", "blocks", "rank", "first", F.concat("upper", F.array(level)).alias("upper")))
        ranked = staged(ranked, "manifest-upper")
        span *= fanout
    return ranked


def _levels(nodes: list[str], fanout: int, most: int) -> list[list[str]]:
    """The nodes of each level, ``most`` levels up or, with ``most`` < 0, until one is left."""
    out = [nodes]
    while len(out) - 1 < most if most >= 0 else len(nodes) > 1:
        nodes = [hashlib.sha256("".join(nodes[i:i + fanout]).encode()).hexdigest() for i in range(0, len(nodes), fanout)]
        out.append(nodes)
    return out


def _local_levels(blocks: int, local: int) -> int:
    """Levels inside a block: all of a group's if it is the only one."""
    return local if blocks > 1 else -1


def block_roots(placed: DataFrame, fanout: int, local: int) -> DataFrame:
    """``rank``, ``block`` and ``digest`` of each block of leaves."""
    def work(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_pos")
        top = _levels(pdf["_leaf"].tolist(), fanout, _local_levels(int(pdf["_blocks"].iloc[0]), local))[-1]
        return pd.DataFrame({"rank": [key[0]], "block": [key[1]], "digest": top})

    return placed.select("rank", "block", "_pos", "_blocks", "_leaf").groupBy("rank", "block").applyInPandas(
        work, "rank long, block long, digest string")


_PROOF = "array<struct<left:string,right:string>>"


def butterfly(members: DataFrame, fanout: int, group_rounds: int, rounds: int) -> DataFrame:
    """``members`` (a row per block: ``rank, block, blocks, first, upper, digest``) after all rounds of the exchange.

    Adds ``subroot`` and ``proof``; ``digest`` is then the root. In a round the
    members of a node are numbered from 0; number ``i`` of ``own`` sends to
    ``i, i + own, i + 2 own, …`` below the size of the largest subtree that takes part, so each
    number meets exactly one member of every subtree, in a group of at most ``fanout`` rows.
    """
    kept = [c for c in members.columns if c != "digest"]
    state = members.withColumn("proof", F.array().cast(_PROOF))

    def swap(state: DataFrame, tree: Column, node: Column, number: Column, own: Column, most: Column, active: Column) -> DataFrame:
        """One round; members that are not active meet themselves alone and stay as they are."""
        sent = state.withColumn("_self", F.concat_ws("/", "rank", "block")).select(
            "*", tree.alias("_tree"), F.when(active, F.floor(node / fanout)).otherwise(F.lit(None)).alias("_parent"),
            F.when(active, node).alias("_node"), F.when(active, number.cast("string")).otherwise(F.col("_self")).alias("_number"),
            F.explode(F.when(active, F.transform(F.sequence(number, most - 1, own), lambda x: x.cast("string")))
                      .otherwise(F.array("_self"))).alias("_to"))
        mine = F.col("_to") == F.col("_number")
        carried = [c for c in state.columns if c != "digest"]
        met = sent.groupBy("_tree", "_parent", "_to").agg(F.sort_array(F.collect_list(F.struct(
            F.col("_node"), F.col("digest"), F.when(mine, F.struct(*carried)).alias("own")))).alias("_met"))
        text = lambda xs: F.array_join(F.transform(xs, lambda x: x["digest"]), "")
        one = met.select("_parent", "_met", F.explode("_met").alias("_one")).filter("_one.own IS NOT NULL")
        level = F.struct(text(F.filter("_met", lambda x: x["_node"] < F.col("_one._node"))).alias("left"),
                         text(F.filter("_met", lambda x: x["_node"] > F.col("_one._node"))).alias("right"))
        joined = F.col("_parent").isNotNull()
        return one.select(
            *[F.col(f"_one.own.{c}").alias(c) for c in carried if c != "proof"],
            F.when(joined, digest(text(F.col("_met")))).otherwise(F.col("_one.digest")).alias("digest"),
            F.when(joined, F.concat("_one.own.proof", F.array(level))).otherwise(F.col("_one.own.proof")).alias("proof"))

    span = 1
    for _ in range(group_rounds):  # within each group, until one subtree has all its blocks
        node, parent = F.floor(F.col("block") / span), F.floor(F.col("block") / (span * fanout))
        size = lambda at, width: F.least(F.lit(width), F.col("blocks") - at * width)
        state = swap(state, F.col("rank"), node, F.col("block") - node * span, size(node, span),
                     F.least(F.lit(span), F.col("blocks") - parent * span * fanout), F.col("blocks") > span)
        span *= fanout
    state = state.withColumn("subroot", F.col("digest"))
    for r in range(rounds):  # among groups
        at = F.col("upper")[r]
        state = swap(state, F.lit(-1), at["node"], F.col("first") + F.col("block") - at["start"], at["own"], at["most"], F.lit(True))
    return state.select(*kept, "subroot", "digest", "proof")


def _rounds(n: int, fanout: int) -> int:
    r = 0
    while fanout ** r < n:
        r += 1
    return r


def manifest(docs: DataFrame, id_col: str, group_col: str, leaf: Column, carry: dict[str, Column] | None = None,
             fanout: int = FANOUT, local_levels: int = LOCAL_LEVELS) -> DataFrame:
    """One row per input row: ``id_col``, ``leaf``, ``subroot``, ``root``, ``proof`` and the ``carry`` columns.

    ``leaf`` is the digest of a row (see ``leaf_digest``). ``proof`` lists, from
    the leaf's level upwards, the digests ``left`` and ``right`` of it in its run, joined;
    ``fold(leaf, proof)`` gives the root. Groups are ordered by their UTF-8 bytes, null
    first; the leaves of a group by id, null first, and those of equal ids by digest; rows wholly equal
    are leaves of their own. A single leaf is its group's root, a single group's root the root.
    Very long texts matter only to ``leaf``; an empty table gives no rows; other
    columns are ignored, whatever their names.
    """
    carry = carry or {}
    width = fanout ** local_levels
    rows = docs.select(docs[group_col].cast("string").alias("_group"), docs[id_col].alias("_id"), leaf.alias("_leaf"),
                       *[c.alias(f"_carry_{k}") for k, c in carry.items()])
    leaves = ordered_places(rows, ["_group", "_id", "_leaf"], "manifest-leaves")

    # where each group starts in each sorted partition: a row per partition and group it holds
    runs = staged(leaves.groupBy("_group", "_part").agg(F.min("_index").alias("_from"), F.count("*").alias("_n")), "manifest-runs")
    groups = group_levels(runs.groupBy("_group").agg(F.sum("_n").alias("_leaves")), fanout, width)
    earlier = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_offset", F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_from"))
    runs = runs.join(groups.select(F.col("_group").alias("_g"), "rank", "blocks"), F.col("_group").eqNullSafe(F.col("_g")))
    runs = staged(runs.select(F.col("_group").alias("_g"), F.col("_part").alias("_p"), "_offset", "rank", F.col("blocks").alias("_blocks")),
                  "manifest-offsets")
    pos = F.col("_index") + F.col("_offset")
    placed = staged(leaves.join(runs, (F.col("_part") == F.col("_p")) & F.col("_group").eqNullSafe(F.col("_g"))).select(
        "rank", F.floor(pos / width).alias("block"), pos.alias("_pos"), "_blocks", "_id", "_leaf", *[f"_carry_{k}" for k in carry]),
        "manifest-places")

    size = groups.agg(F.count("*"), F.max("blocks")).first()
    members = block_roots(placed, fanout, local_levels).join(
        groups.select(F.col("rank").alias("_r"), "blocks", "first", "upper"), F.col("rank") == F.col("_r")).drop("_r")
    met = staged(butterfly(members, fanout, _rounds(size[1] or 0, fanout), _rounds(size[0], fanout)), "manifest-proofs")

    carried = [f"_carry_{k}" for k in carry]

    def finish(key, left, right):
        import pyarrow as pa
        left, top = left.sort_by("_pos"), right.to_pylist()[0]
        levels = _levels(left["_leaf"].to_pylist(), fanout, _local_levels(left["_blocks"][0].as_py(), local_levels))
        n = left.num_rows
        sides: list[list[tuple[str, str]]] = []  # per level of the block, of each of its nodes
        for nodes in levels[:-1]:
            runs = [(i, i - i % fanout) for i in range(len(nodes))]
            sides.append([("".join(nodes[low:i]), "".join(nodes[i + 1:low + fanout])) for i, low in runs])
        sides += [[(x["left"], x["right"])] for x in top["proof"]]
        steps = [(s, fanout ** k if k < len(levels) - 1 else n) for k, s in enumerate(sides)]
        flat = [s[i // width] for i in range(n) for s, width in steps]
        proof = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * len(steps), pa.int32()), pa.StructArray.from_arrays(
            [pa.array([x[0] for x in flat], pa.string()), pa.array([x[1] for x in flat], pa.string())], ["left", "right"]))
        out = left.select(["_id", "_leaf", *carried])
        for name in ("subroot", "digest"):
            out = out.append_column(name, pa.array([top[name]] * n, pa.string()))
        return out.append_column("proof", proof)

    types = dict(placed.dtypes)
    schema = ", ".join(f"`{c}` {types[c]}" for c in ["_id", "_leaf", *carried])
    done = placed.groupBy("rank", "block").cogroup(met.select("rank", "block", "subroot", "digest", "proof").groupBy("rank", "block")) \
                 .applyInArrow(finish, f"{schema}, subroot string, digest string, proof {_PROOF}")
    return done.select(F.col("_id").alias(id_col), F.col("_leaf").alias("leaf"), "subroot", F.col("digest").alias("root"), "proof",
                       *[F.col(f"_carry_{k}").alias(k) for k in carry])
