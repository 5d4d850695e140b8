"""Hierarchical weighted hash tree: a key descends region, rack and shard by hash draws.

Every node draws -ln(u) / weight with u from a hash of the key and the node's name, and
the child with the smallest draw wins, so a child gets keys in proportion to its weight.
A draw depends on nothing but the key, the node and its weight: where the weight of a
subtree changes, keys move only into it (it grew) or out of it (it shrank).
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicklake.llm.common import hash_draw, key_text

ROWS_PER_GROUP = 4096
BASE_SHARDS, SHARDS_PER_RACK, RACKS_PER_REGION = 16, 2, 2


@dataclass
class Tree:
    """Regions of racks of shards: {region: {rack: {shard number: weight}}}."""

    regions: dict[str, dict[str, dict[int, float]]] = field(default_factory=dict)

    def children(self) -> dict[str, list[tuple[str, float]]]:
        """Node -> its children with their weights; the root's name is empty."""
        found: dict[str, list[tuple[str, float]]] = {"": []}
        for region, racks in self.regions.items():
            found[region] = []
            for rack, shards in racks.items():
                found[rack] = [(str(shard), float(weight)) for shard, weight in shards.items() if weight > 0]
                found[region].append((rack, math.fsum(w for _, w in found[rack])))
            found[region] = [(name, weight) for name, weight in found[region] if weight > 0]
            found[""].append((region, math.fsum(w for _, w in found[region])))
        found[""] = [(name, weight) for name, weight in found[""] if weight > 0]
        return {node: below for node, below in found.items() if below}


def tree(shards: int, base: int = BASE_SHARDS) -> Tree:
    """`shards` shards of weight 1. Those beyond the first `base` have a region each.

    A shard in a region of its own takes keys from all others and none of the
    others changes weight, so growth moves keys into the new shard alone.
    """
    regions: dict[str, dict[str, dict[int, float]]] = {}
    for shard in range(shards):
        if shard < base:
            rack = shard // SHARDS_PER_RACK
            region = rack // RACKS_PER_REGION
            regions.setdefault(f"region{region}", {}).setdefault(f"region{region}.rack{rack}", {})[shard] = 1.0
        else:
            regions[f"region+{shard}"] = {f"region+{shard}.rack": {shard: 1.0}}
    return Tree(regions)


def shard_of(key: Column, of: Tree) -> Column:
    """The shard of each key (text), by three levels of weighted hash draws."""
    below = of.children()
    entries: list[Column] = []
    for node, children in below.items():
        listed = [F.struct(F.lit(name).alias("name"), F.lit(weight).alias("weight")) for name, weight in children]
        entries += [F.lit(node), F.array(*listed)]
    lookup = F.create_map(*entries)

    def descend(node: Column) -> Column:
        drawn = F.transform(
            F.element_at(lookup, node),
            lambda child: F.struct(
                (-F.log(hash_draw(key, child["name"])) / child["weight"]).alias("draw"),
                child["name"].alias("name"),
            ),
        )
        return F.array_min(drawn)["name"]

    return descend(descend(descend(F.lit("")))).cast("int")


def assign_shards(docs: DataFrame, shards: int = BASE_SHARDS, grown: int | None = None) -> DataFrame:
    """Every row with its shard, its slot there, and its shard among `grown` shards.

    Adds size (UTF-8 bytes of the text and 1; a null text has none), text_crc32 (of
    a null text: 0), shard, slot and, with `grown`, grown_shard; columns of
    those names are replaced. Only doc_id and the number of shards decide the
    shard. A null doc_id is a key of its own; repeated rows go to the same shard. Slots
    are gapless from 0 in each shard.

    Slots are numbered in groups of about ROWS_PER_GROUP rows, cut by a hash
    of the row, and only the groups' counts are summed along a shard; no task holds a shard.
    """
    key = key_text(F.col("doc_id"))
    frame = docs.withColumns({
        "size": F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1,
        "text_crc32": F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")),
        "shard": shard_of(key, tree(shards)),
        **({"grown_shard": shard_of(key, tree(grown))} if grown else {}),
    })
    return number_slots(frame, "shard", ["doc_id", "text_crc32", "size"], docs.count() / shards)


def number_slots(frame: DataFrame, place: str, order: list[str], rows_in_place: float) -> DataFrame:
    """Adds slot: 0, 1, 2, ... in every place, in some order that the columns `order` decide.

    rows_in_place is about how many rows the fullest place may hold.
    """
    groups = max(1, math.ceil(rows_in_place / ROWS_PER_GROUP))
    cut = frame.drop("slot").withColumn("slot_group", F.pmod(F.xxhash64(*order), F.lit(groups)))
    counts = cut.groupBy(place, "slot_group").agg(F.count("*").alias("slot"))
    along = Window.partitionBy(place).orderBy("slot_group").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.withColumn("slot", F.coalesce(F.sum("slot").over(along), F.lit(0)))
    inside = F.row_number().over(Window.partitionBy(place, "slot_group").orderBy(*order))
    return (
        cut.withColumn("slot_inside", inside - 1).join(before, [place, "slot_group"])
        .withColumn("slot", (F.col("slot") + F.col("slot_inside")).cast("long"))
        .drop("slot_inside", "slot_group")
    )
