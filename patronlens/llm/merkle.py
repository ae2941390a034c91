"""Merkle manifest of a table: leaf digests, a tree per part, a tree over the parts, and a proof for every row.

A parent's children are spread into slot columns by conditional aggregates: the digest of the
concatenated columns is the parent, and the columns without a child's own are that child's siblings.
One exchange pivots a subtree of several levels (at most `MOST_SLOTS` of its lowest nodes); the levels
in between are digests of neighbouring columns, so a table of n rows takes log16(n) exchanges of
shrinking node tables instead of one per level. Proofs come back down by joins on (tree, block), at
most 16 rows to a key, each round's siblings behind those of the round below.

H is the lowercase hex SHA-256 of its inputs concatenated as text; a missing child adds nothing, so
the last run of a level may be shorter, even one node.

Defined cases: a null in any field is written `-`; a null part comes before all others and is a part
of its own; null ids come first in their part, equal ids are ordered by leaf digest, and equal rows
have equal leaves at places of their own; a part of one row has that leaf as its root; a single part
has its root as the whole one; an empty table gives an empty result. Only the named fields are read,
so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from patronlens.operators.ranking import global_rank, place
from patronlens.workspace import materialize

FANOUT = 2
MOST_SLOTS = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_digest(*values: Column) -> Column:
    """H of the fields: `-` for null, else the number of UTF-8 bytes, a colon and the value as text."""
    said = []
    for value in values:
        text = value.cast("string")
        said.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*said), 256)


def _levels_above(n: Column, fanout: int) -> Column:
    """Levels from n nodes up to a single one, in whole numbers."""
    powers = [fanout**i for i in range(64) if fanout**i < 1 << 62]
    return F.size(F.filter(F.lit(powers).cast("array<bigint>"), lambda p: p < n))


def _levels_at_once(fanout: int) -> int:
    levels = 1
    while fanout ** (levels + 1) <= MOST_SLOTS:
        levels += 1
    return levels


def _child(nodes: Column, at: Column) -> Column:
    """The digest in a slot, nothing where there is no child."""
    return F.coalesce(F.get(nodes, at), F.lit(""))


def _parents(nodes: Column, width: int, fanout: int) -> Column:
    """One level up: the digest of each run of `fanout` neighbouring slots, null where the run has no child."""
    starts = F.lit([j for j in range(0, width, fanout)])

    def parent(first: Column) -> Column:
        return F.when(F.get(nodes, first).isNotNull(), F.sha2(F.concat(*[_child(nodes, first + k) for k in range(fanout)]), 256))

    return F.transform(starts, parent)


def _step(nodes: Column, own: Column, fanout: int) -> Column:
    """The slots of a node's run without its own: those before and those after it."""
    place = F.pmod(own, F.lit(fanout))
    others = [(F.lit(k), _child(nodes, own - place + k)) for k in range(fanout)]
    before = F.concat(*[F.when(k < place, digest).otherwise("") for k, digest in others])
    after = F.concat(*[F.when(k > place, digest).otherwise("") for k, digest in others])
    return F.struct(before.alias("before"), after.alias("after"))


def _pivot(nodes: DataFrame, fanout: int, carried: Sequence[str] = ()) -> DataFrame:
    """One round: (tree, at, rest, digest, members), a row per subtree.

    `nodes` has tree, at (from 0 without gaps), rest (levels still above it in its tree), digest and the
    `carried` columns. `members` lists the subtree's nodes: at, the carried columns, and the path
    of siblings from the node to the subtree's root.
    """
    levels = _levels_at_once(fanout)
    width = fanout**levels
    node = F.struct("at", *carried, "digest")
    slot = F.pmod("at", F.lit(width))
    spread = nodes.groupBy("tree", F.expr(f"at div {width}").alias("block"), "rest").agg(
        *[F.max(F.when(slot == j, node)).alias(f"c{j}") for j in range(width)]
    )
    slots = F.array(*[F.col(f"c{j}") for j in range(width)])
    grown = spread.select("tree", "block", "rest", slots.alias("slots"))
    grown = grown.withColumn("d0", F.transform("slots", lambda c: c["digest"]))
    for level in range(levels):
        # A tree that has come to its root already passes it on in slot 0.
        here = F.col(f"d{level}")
        up = F.when(F.col("rest") > level, _parents(here, width // fanout**level, fanout)).otherwise(here)
        grown = grown.withColumn(f"d{level + 1}", up)

    def member(j: Column) -> Column:
        at = F.get(F.col("slots"), j)
        steps = F.array(*[_step(F.col(f"d{level}"), F.floor(j / fanout**level).cast("int"), fanout) for level in range(levels)])
        path = F.slice(steps, 1, F.least("rest", F.lit(levels)))
        return F.struct(at["at"].alias("at"), *[at[c].alias(c) for c in carried], path.alias("path"))

    taken = F.filter(F.lit(list(range(width))), lambda j: F.get(F.col("slots"), j).isNotNull())
    # On its own, since a lambda would take `rest` for the new column of that name.
    grown = grown.withColumn("members", F.transform(taken, member))
    return grown.select(
        "tree", F.col("block").alias("at"), F.greatest(F.col("rest") - levels, F.lit(0)).alias("rest"),
        F.get(F.col(f"d{levels}"), F.lit(0)).alias("digest"), "members",
    )


def _grow(nodes: DataFrame, fanout: int, carried: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """All rounds over a forest: (tree, digest of its root), and (tree, carried columns, path) of every node."""
    rounds = [materialize(_pivot(nodes, fanout, carried), "subtrees")]
    while (rounds[-1].agg(F.max("rest").alias("rest")).first()["rest"] or 0) > 0:
        rounds.append(materialize(_pivot(rounds[-1].select("tree", "at", "rest", "digest"), fanout), "subtrees"))
    roots = rounds[-1].select("tree", "digest")
    above = rounds.pop().select("tree", F.explode("members").alias("_m")) if len(rounds) > 1 else None
    if above is None:
        return roots, rounds[0].select("tree", F.inline("members")).drop("at")
    above = above.select("tree", F.col("_m.at").alias("at"), F.col("_m.path").alias("_above"))
    while True:
        joined = rounds.pop().select("tree", "at", "members").join(above, ["tree", "at"]).select("tree", "_above", F.inline("members"))
        whole = joined.withColumn("path", F.concat("path", "_above")).drop("_above")
        if not rounds:
            return roots, whole.drop("at")
        above = whole.select("tree", "at", F.col("path").alias("_above"))


def _numbered(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes of all part trees in order, and (tree, part, n): the trees numbered from 0 by part.

    The rows are range-partitioned on part, id and leaf; a row per part and range gives the offsets.
    """
    placed = place(leaves, [("part", True), ("id", True), ("leaf", True)])
    runs = materialize(placed.groupBy("_part", "part").agg(F.count("*").alias("n"), F.min("_at").alias("_first")), "runs")
    parts = global_rank(runs.groupBy("part").agg(F.sum("n").alias("n")), [("part", True)], "_rank")
    parts = materialize(parts.select((F.col("_rank") - 1).alias("tree"), "part", "n"), "parts")
    # A part has at most as many runs as there are ranges.
    before = F.sum("n").over(Window.partitionBy("part").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    shifts = runs.select("_part", F.col("part").alias("_p"), (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"))
    shifts = shifts.join(parts.select("tree", F.col("part").alias("_q"), F.col("n").alias("_n")), F.col("_p").eqNullSafe(F.col("_q")))
    shifts = materialize(shifts.select(F.col("_part").alias("_r"), "_p", "tree", "_n", "_shift"), "shifts")
    joined = placed.join(shifts, (F.col("_part") == F.col("_r")) & F.col("part").eqNullSafe(F.col("_p")))
    return joined.withColumn("at", F.col("_at") + F.col("_shift")), parts


def manifest(
    docs: DataFrame, key: str = "doc_id", part: str = "lang", fields: Sequence[str] = FIELDS,
    carry: dict[str, Column] | None = None, fanout: int = FANOUT,
) -> DataFrame:
    """One row per document: key, leaf, subroot (of its part), root, path and the `carry` columns.

    `path` lists the siblings before and after the node on every level, from the leaf to the root.
    """
    extra = list(carry or {})
    leaf = leaf_digest(*[F.col(f"`{f}`") for f in fields])
    leaves = materialize(
        docs.select(F.col(key).alias("id"), F.col(part).alias("part"), leaf.alias("leaf"), *[c.alias(f"x_{n}") for n, c in (carry or {}).items()]), "leaves"
    )
    nodes, parts = _numbered(leaves)
    nodes = nodes.select("tree", "at", _levels_above(F.col("_n"), fanout).alias("rest"), F.col("leaf").alias("digest"), "id", "leaf", *[f"x_{n}" for n in extra])
    subroots, paths = _grow(nodes, fanout, ["id", "leaf", *[f"x_{n}" for n in extra]])

    n_parts = F.lit(parts.count()).cast("bigint")
    tops = subroots.select(
        F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("at"), _levels_above(n_parts, fanout).alias("rest"), "digest",
        F.col("tree").alias("part_tree"), F.col("digest").alias("subroot"),
    )
    roots, over = _grow(tops, fanout, ["part_tree", "subroot"])
    found = roots.first()
    root = F.lit(found["digest"] if found else None).cast("string")
    over = materialize(over.select(F.col("part_tree").alias("tree"), "subroot", F.col("path").alias("_over")), "over")
    return paths.join(over, "tree").select(
        F.col("id").alias(key), "leaf", "subroot", root.alias("root"), F.concat("path", "_over").alias("path"), *[F.col(f"x_{n}").alias(n) for n in extra]
    )


def proof_digest(path: Column) -> Column:
    """H of all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of its path lead to."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s["before"], h, s["after"]), 256))


def tampered_leaf(fields: Sequence[str] = FIELDS, key: str = "doc_id", count: str = "n_chars", every: int = 7) -> Column:
    """The leaf with one added to `count` where `every` divides the CRC-32 of the key as text; null elsewhere."""
    chosen = F.crc32(F.col(f"`{key}`").cast("string").cast("binary")) % every == 0
    changed = [F.col(f"`{f}`") + 1 if f == count else F.col(f"`{f}`") for f in fields]
    return F.when(chosen, leaf_digest(*changed))


def verify(proved: DataFrame, forged: str = "forged") -> DataFrame:
    """Adds proof_sha256, folded_root (from the `forged` leaf where there is one) and verified."""
    back = folded(F.coalesce(forged, "leaf"), F.col("path"))
    checked = proved.withColumns({"proof_sha256": proof_digest(F.col("path")), "folded_root": back})
    return checked.withColumn("verified", F.col("folded_root") == F.col("root"))
