"""Mix of sources to target weights by weighted fair queueing.

Each source is a queue of its documents in shuffled order, pass after pass. A document's virtual
finish time is the number of tokens its source has queued up to and with it, divided by the
source's target; the queues are merged by that time over a range-partitioned sort and cut at the
total budget. At time 1 every queue has given its target.

Defined cases: a null text has no words; a null source is a source of its own, last in order;
rows that agree in id, source and size are taken together, and each gets the same result;
if no text has a word, all targets are 0; an empty table gives an empty result. Only id, source
and text are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronlens.operators.ranking import global_rank, running_totals
from patronlens.workspace import materialize

WEIGHTS = (5, 2, 1)
SHARE = (3, 2)
PASSES = 2
SEED = 20

_WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("bigint")


def shuffle_key(seed: int, turn: Column, key: Column) -> Column:
    """60 bits of an MD5 over seed, pass and id, as SQL engines can also compute it."""
    said = F.concat_ws(":", F.lit(str(seed)), turn.cast("string"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(said), 1, 15), 16, 10).cast("bigint")


def source_targets(
    sized: DataFrame, weights: Sequence[int] = WEIGHTS, share: tuple[int, int] = SHARE, passes: int = PASSES
) -> tuple[DataFrame, int]:
    """Per source: its rank, size and target; and the budget, `share` of all sizes.

    Targets are in proportion to the weights and end at `passes` times the source's size; what
    is above is dealt out again by weight until none is above. A source is full when its weight's
    part exceeds its end, and that part only grows, so each round needs two sums and no list.
    """
    per_source = sized.groupBy("_source").agg(F.sum("_size").alias("_source_size"))
    per_source = per_source.withColumn("_last", F.col("_source").isNull())
    ranked = global_rank(materialize(per_source, "sources"), [("_last", True), ("_source", True)], "_rank")
    cycle = F.element_at(F.lit(list(weights)), ((F.col("_rank") - 1) % len(weights) + 1).cast("int")).cast("bigint")
    ranked = ranked.withColumns({"_weight": cycle, "_end": F.col("_source_size") * passes})
    ranked = materialize(ranked.drop("_last"), "sources")

    sums = ranked.agg(F.sum("_source_size").alias("all"), F.sum("_weight").alias("weight")).first()
    budget = (sums["all"] or 0) * share[0]
    above, below = budget, (sums["weight"] or 1) * share[1]
    whole = "decimal(38,0)"
    while True:
        full = F.col("_weight").cast(whole) * F.lit(above).cast("decimal(19,0)") > F.col("_end").cast("decimal(19,0)") * F.lit(below).cast("decimal(19,0)")
        kept = ranked.agg(
            F.sum(F.when(full, F.col("_end")).otherwise(0)).alias("ends"),
            F.sum(F.when(full, 0).otherwise(F.col("_weight"))).alias("weight"),
        ).first()
        left, open_weight = budget - share[1] * (kept["ends"] or 0), share[1] * (kept["weight"] or 0)
        if open_weight == 0 or (left, open_weight) == (above, below):
            break
        above, below = left, open_weight
    part = (F.col("_weight") * F.lit(above)).cast("double") / F.lit(below).cast("double")
    target = F.when(full, F.col("_end").cast("double")).otherwise(part)
    return ranked.withColumn("_target", target), budget // share[1]


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: Sequence[int] = WEIGHTS,
    share: tuple[int, int] = SHARE,
    passes: int = PASSES,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: key, source, size, source_size, target and taken, the words the mix takes."""
    sized = docs.select(F.col(key).alias("_key"), F.col(source).alias("_source"), word_count(F.col(text)).alias("_size"))
    sized = materialize(sized, "sized")
    targets, budget = source_targets(sized, weights, share, passes)

    unit = sized.groupBy("_key", "_source", "_size").agg(F.count("*").alias("_rows"))
    named = targets.select("_source", "_rank", "_target")
    queued = unit.join(named, unit["_source"].eqNullSafe(named["_source"])).drop(named["_source"])
    queued = queued.select("*", F.explode(F.sequence(F.lit(0), F.lit(passes - 1))).alias("_pass"))
    queued = queued.select(
        "_key", "_source", "_size", "_rank", "_target", "_pass",
        shuffle_key(seed, F.col("_pass"), F.col("_key")).alias("_shuffle"),
        (F.col("_size") * F.col("_rows")).alias("_tokens"),
    )
    ties = [("_rank", True), ("_pass", True), ("_shuffle", True), ("_key", True), ("_size", True)]
    ahead = running_totals(
        targets.select("_rank", (F.col("_end")).alias("_queue")), [("_rank", True)], {"_ahead": "_queue"}
    ).select("_rank", (F.col("_ahead") - F.col("_queue")).alias("_ahead"))
    summed = running_totals(queued, ties, {"_sum": "_tokens"}).drop("_sum_total").join(ahead, "_rank")
    finish = (F.col("_sum") - F.col("_ahead")).cast("double") / F.nullif(F.col("_target"), F.lit(0.0))
    timed = summed.withColumn("_finish", F.coalesce(finish, F.lit(0.0))).drop("_sum", "_ahead", "_target")
    merged = running_totals(timed, [("_finish", True), *ties], {"_sum": "_tokens"})
    chosen = merged.where(F.col("_sum") <= budget).groupBy("_key", "_source", "_size").agg(F.count("*").alias("_taken"))

    per_doc = sized.join(
        chosen.select(*[F.col(c).alias(f"{c}2") for c in ("_key", "_source", "_size")], "_taken"),
        F.col("_key").eqNullSafe(F.col("_key2")) & F.col("_source").eqNullSafe(F.col("_source2"))
        & (F.col("_size") == F.col("_size2")),
        "left",
    ).select("_key", "_source", "_size", "_taken")
    wide = targets.select(F.col("_source").alias("_named"), "_source_size", "_target")
    joined = per_doc.join(wide, F.col("_source").eqNullSafe(F.col("_named")))
    return joined.select(
        F.col("_key").alias(key),
        F.col("_source").alias(source),
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_size") * F.coalesce("_taken", F.lit(0))).alias("taken"),
        F.coalesce("_taken", F.lit(0)).cast("int").alias("passes_taken"),
    )


def take(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", **options) -> DataFrame:
    """The documents as the mix has them: a row for each time one is taken, with the columns of `docs`."""
    counts = mix(docs, key, source, text, **options).where("passes_taken > 0 and size > 0").select(
        F.col(key).alias("_key"), F.col(source).alias("_source"), F.col("size").alias("_size"), "passes_taken"
    ).distinct()
    # The document goes along as one struct, so that its columns cannot clash with others.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), word_count(F.col(text)).alias("_words"))
    same = F.col(f"doc.{key}").eqNullSafe(F.col("_key")) & F.col(f"doc.{source}").eqNullSafe(F.col("_source")) & (F.col("_words") == F.col("_size"))
    copies = F.explode(F.sequence(F.lit(1), F.col("passes_taken"))).alias("_copy")
    return rows.join(counts, same).select("doc", copies).select("doc.*")
