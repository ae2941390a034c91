"""Shards of near-equal size by best-fit-decreasing bin packing of indivisible groups.

Groups are rows of equal text. In order of falling size each group enters the bin whose remaining
capacity is the tightest that still holds it, found in a balanced search tree. A group above
1/`LARGE` of a shard's capacity is packed on the driver: there are at most shards x `LARGE` of these,
whatever the size of the table. All others are packed inside the tasks, `CHUNK` at a time, into that chunk's part of the
capacity left over, so every chunk fills the shards evenly.

Only a group larger than a shard's capacity is divided, by hash of the row's id: kept whole,
a group of copies holding a third of all bytes would leave no near-equal shards. All others stay whole.

Defined cases: a null text is the empty text, of size `OVERHEAD`; ties in size go by group; repeated rows
are rows of their own, with slots of their own; an empty table gives an empty result. Only id and text
are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlens.operators.ranking import place
from patronlens.workspace import materialize, small_table

SHARDS = 24
OVERHEAD = 8
LARGE = 1000
CHUNK = 50_000


class CapacityTree:
    """Bins by remaining capacity in a treap; a bin's priority is a mix of its number, so runs agree."""

    def __init__(self):
        self._root = None

    @staticmethod
    def _priority(bin_: int) -> int:
        return (bin_ + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF

    def _split(self, node, key):
        """Nodes below `key`, and the others. A node is [key, priority, left, right]."""
        if node is None:
            return None, None
        if node[0] < key:
            node[3], rest = self._split(node[3], key)
            return node, rest
        low, node[2] = self._split(node[2], key)
        return low, node

    def _merge(self, a, b):
        if a is None or b is None:
            return b if a is None else a
        if a[1] > b[1]:
            a[3] = self._merge(a[3], b)
            return a
        b[2] = self._merge(a, b[2])
        return b

    def add(self, left: int, bin_: int) -> None:
        low, high = self._split(self._root, (left, bin_))
        self._root = self._merge(self._merge(low, [(left, bin_), self._priority(bin_), None, None]), high)

    def remove(self, left: int, bin_: int) -> None:
        low, high = self._split(self._root, (left, bin_))
        _, high = self._split(high, (left, bin_ + 1))
        self._root = self._merge(low, high)

    def tightest(self, size: int) -> tuple[int, int] | None:
        """The smallest (capacity, bin) that holds `size`."""
        node, best = self._root, None
        while node is not None:
            if node[0][0] >= size:
                best, node = node[0], node[2]
            else:
                node = node[3]
        return best

    def widest(self) -> tuple[int, int] | None:
        node = self._root
        while node is not None and node[3] is not None:
            node = node[3]
        return node and node[0]


def best_fit_decreasing(sizes: list[int], capacities: list[int], new_bin: int | None = None) -> list[int]:
    """The bin of each item. What fits nowhere opens a bin of capacity `new_bin`, or without one enters the widest bin."""
    tree, left = CapacityTree(), list(capacities)
    for bin_, room in enumerate(left):
        tree.add(room, bin_)
    chosen = [0] * len(sizes)
    for at in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        found = tree.tightest(sizes[at])
        if found is None and new_bin is not None:
            left.append(max(new_bin, sizes[at]))
            found = (left[-1], len(left) - 1)
            tree.add(*found)
        room, bin_ = found or tree.widest()
        tree.remove(room, bin_)
        left[bin_] = room - sizes[at]
        tree.add(left[bin_], bin_)
        chosen[at] = bin_
    return chosen


def _pack_small(spare: list[int]):
    """Packs batches of (unit, bytes) into shares of the spare capacity, evened out from chunk to chunk."""
    total_spare = sum(spare)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filled, seen = [0] * len(spare), 0
        for batch in batches:
            for start in range(0, len(batch), CHUNK):
                part = batch.iloc[start:start + CHUNK].sort_values(["bytes", "unit"], ascending=[False, True])
                sizes = part["bytes"].tolist()
                seen += sum(sizes)
                room = [-(-seen * s // total_spare) - f for s, f in zip(spare, filled)]
                bins = best_fit_decreasing(sizes, room)
                for b, size in zip(bins, sizes):
                    filled[b] += size
                yield pd.DataFrame({"unit": part["unit"].to_numpy(), "shard": bins})

    return pack


def assign_shards(
    docs: DataFrame, shards: int = SHARDS, key: str = "doc_id", text: str = "text", overhead: int = OVERHEAD
) -> DataFrame:
    """One row per document: key, size, text_crc32, shard and slot, the row's place in its shard from 0."""
    held = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).alias("_key"),
        (F.octet_length(held) + overhead).cast("bigint").alias("size"),
        F.crc32(F.encode(held, "utf-8")).alias("text_crc32"),
        F.md5(held).alias("_group"),
    )
    rows = materialize(rows, "rows")
    groups = rows.groupBy("_group").agg(F.sum("size").alias("bytes"))
    groups = materialize(groups, "groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    capacity = -(-total // shards)

    # Fewer than `shards` groups can be above a shard's capacity.
    heavy = {r["_group"]: r["bytes"] for r in groups.where(F.col("bytes") > capacity).collect()}
    unit = F.col("_group")
    if heavy:
        spread = small_table(docs.sparkSession, [(g, -(-b * 8 // capacity)) for g, b in heavy.items()], "_heavy string, _parts bigint")
        rows = rows.join(F.broadcast(spread), rows["_group"] == spread["_heavy"], "left")
        piece = F.pmod(F.xxhash64(F.coalesce(F.col("_key").cast("string"), F.lit(""))), F.col("_parts")).cast("string")
        unit = F.when(F.col("_parts").isNull(), F.col("_group")).otherwise(F.concat_ws("-", "_group", piece))
        rows = materialize(rows.select("_key", "size", "text_crc32", "_group", unit.alias("unit")), "rows")
        units = materialize(rows.groupBy("unit").agg(F.sum("size").alias("bytes")), "units")
    else:
        rows, units = rows.withColumn("unit", unit), groups.withColumnRenamed("_group", "unit")

    # At most shards x LARGE units are above this bound.
    bound = capacity // LARGE
    large = sorted(((r["bytes"], r["unit"]) for r in units.where(F.col("bytes") > bound).collect()), key=lambda r: (-r[0], r[1]))
    bins = best_fit_decreasing([b for b, _ in large], [capacity] * shards)
    spare = [capacity] * shards
    for b, (size, _) in zip(bins, large):
        spare[b] -= size
    spare = [max(0, s) for s in spare]
    if not sum(spare):
        spare = [1] * shards
    small = units.where(F.col("bytes") <= bound).select("unit", "bytes").mapInPandas(_pack_small(spare), "unit string, shard int")
    driven = small_table(docs.sparkSession, [(u, b) for b, (_, u) in zip(bins, large)], "unit string, shard int")
    placed = rows.join(small.unionByName(driven), "unit").select("_key", "size", "text_crc32", "_group", "shard")
    return number_slots(placed, key)


def number_slots(placed: DataFrame, key: str) -> DataFrame:
    """Adds slot: the place of a row in its shard by id, over a range-partitioned sort; the driver sees one row per partition and shard."""
    ordered = place(placed.withColumn("_last", F.col("_key").isNull()), [("shard", True), ("_last", True), ("_key", True), ("_group", True)])
    runs = ordered.groupBy("_part", "shard").agg(F.count("*").alias("n"), F.min("_at").alias("first")).collect()
    offsets, filled = [], {}
    for run in sorted(runs, key=lambda r: r["first"]):
        offsets.append((run["_part"], run["shard"], filled.get(run["shard"], 0) - run["first"]))
        filled[run["shard"]] = filled.get(run["shard"], 0) + run["n"]
    shifts = small_table(placed.sparkSession, offsets, "_part bigint, shard int, _shift bigint")
    return ordered.join(shifts, ["_part", "shard"]).select(
        F.col("_key").alias(key), "size", "text_crc32", "shard", (F.col("_at") + F.col("_shift")).alias("slot")
    )


def write_shards(docs: DataFrame, assigned: DataFrame, path: str, key: str = "doc_id") -> None:
    """Write the documents in one folder per shard, in order of slot within each file. Ids must be unique."""
    joined = docs.join(assigned.select(key, "shard", "slot"), key)
    joined.repartition("shard", F.shiftright("slot", 17)).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
