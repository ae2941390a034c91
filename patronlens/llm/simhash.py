"""Near duplicates by 64-bit SimHash and covering locality-sensitive hashing.

Bit i of a fingerprint gets a non-zero vector a(i) of r + 1 bits. For each non-zero vector v there
is a table keyed by the fingerprint under the mask of bits with <a(i), v> = 1. If two
fingerprints differ in r bits or fewer, their vectors span at most r dimensions, so some v is
orthogonal to all of them and the pair meets in that table: no pair within the radius is lost.

Buckets of up to `PAIRED` fingerprints are compared pair by pair. In a larger one every
fingerprint is filed under itself and its neighbours at half the radius inside the bucket; all that meet
there are within the radius, and all within the radius meet there, so linking each to the
smallest of its file loses no connection and makes no pairs.

Defined cases: a null or wordless text has fingerprint zero and is linked like any other; equal
texts and repeated rows share a fingerprint; rows with a null id take part, and a component that
has none but null ids has a null id; an empty table gives an empty result. Only id and text are
read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from patronlens.llm.components import components
from patronlens.workspace import materialize

SHINGLE = 3
RADIUS = 2
SEED = 42
PAIRED = 64

_CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Bits set in more than half of the XXH64 hashes of the text's word shingles, as a signed number."""
    # bytes.lower() changes A-Z only, and bytes.split() cuts at space and 0x09-0x0D only.
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    runs = zip(*(words[i:] for i in range(shingle))) if len(words) >= shingle else [words]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(b" ".join(run), seed) for run in runs), np.uint64)
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), _CHUNK):
        part = hashes[start:start + _CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprint_column(text: Column, shingle: int = SHINGLE, seed: int = SEED) -> Column:
    @F.pandas_udf(LongType())
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([fingerprint(t, shingle, seed) for t in batch], dtype="int64")

    return of(text)


def covering_masks(radius: int = RADIUS, bits: int = 64) -> list[int]:
    """One mask per non-zero v of radius + 1 bits; the vectors a(i) go round all non-zero values."""
    vectors = [i % ((1 << (radius + 1)) - 1) + 1 for i in range(bits)]
    return [
        sum(1 << i for i, a in enumerate(vectors) if (a & v).bit_count() % 2)
        for v in range(1, 1 << (radius + 1))
    ]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _flips(mask: int, radius: int) -> list[int]:
    """What to XOR to reach every value at half the radius (rounded up) that differs outside the mask."""
    free = [i for i in range(64) if not mask >> i & 1]
    return [
        _signed(sum(1 << i for i in chosen))
        for n in range((radius + 1) // 2 + 1)
        for chosen in combinations(free, n)
    ]


def fingerprint_links(prints: DataFrame, radius: int = RADIUS, paired: int = PAIRED) -> DataFrame:
    """Links (a, b) that connect all distinct values of `fp` within the radius of each other, directly or not.

    An even radius keeps every link of a large file within the radius; odd ones are checked there.
    """
    if radius % 2:
        raise ValueError("the radius must be even: files at half the radius must not reach beyond it")
    masks = covering_masks(radius)
    tables = F.array(*[
        F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
        for t, m in enumerate(masks)
    ])
    filed = prints.select("fp", F.explode(tables).alias("_b")).select("_b.t", "_b.key", "fp")
    sizes = filed.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
    met = materialize(filed.join(sizes, ["t", "key"]), "buckets")

    few = met.where(F.col("n") <= paired)
    one, other = few.select("t", "key", F.col("fp").alias("a")), few.select("t", "key", F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    pairs = one.join(other, (one["t"] == other["t"]) & (one["key"] == other["key"]) & (F.col("a") < F.col("b")) & near)

    around = F.element_at(F.lit([_flips(m, radius) for m in masks]), F.col("t") + 1)
    many = met.where(F.col("n") > paired).select("t", "fp", F.explode(around).alias("_flip"))
    many = many.select("t", "fp", F.col("fp").bitwiseXOR(F.col("_flip")).alias("z"))
    first = many.groupBy("t", "z").agg(F.min("fp").alias("b"), F.count("*").alias("n")).where("n > 1").drop("n")
    stars = many.join(first, ["t", "z"]).select(F.col("fp").alias("a"), "b").where("a <> b")
    return pairs.select("a", "b").unionByName(stars)


def simhash_classes(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS,
    keep: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per document: key, fp (signed), root (the component's smallest fp) and component_id, its smallest id.

    `keep` names further expressions over `docs` to carry along.
    """
    extra = [column.alias(name) for name, column in (keep or {}).items()]
    prints = docs.select(F.col(key).alias("_key"), *extra, fingerprint_column(F.col(text), shingle).alias("fp"))
    prints = materialize(prints, "fingerprints")
    distinct = materialize(prints.groupBy("fp").agg(F.min("_key").alias("_least")), "distinct")
    roots = components(fingerprint_links(distinct.select("fp"), radius)).withColumnRenamed("node", "fp")
    rooted = distinct.join(roots, "fp", "left").select("fp", "_least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("_least").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "root", "component_id")
    carried = list(keep or {})
    return prints.join(named, "fp").select(F.col("_key").alias(key), *carried, "fp", "root", "component_id")


def keep_representatives(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without near duplicates: of each component the row with the smallest id stays.

    Among rows of that id the one with the smallest row hash stays, of equal rows one.
    """
    # The document goes along as one struct, so that its columns cannot clash with others.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(key).alias("key"), F.col(text).alias("text"))
    rows = rows.withColumns({"row": F.xxhash64("doc"), "id": F.coalesce(F.col("key").cast("string"), F.lit("none"))})
    slim = simhash_classes(rows, "key", "text", keep={"row": F.col("row"), "id": F.col("id")})
    first = F.min(F.struct(F.col("key").isNull().alias("last"), "key", "row", "id")).alias("first")
    chosen = slim.groupBy("root").agg(first).select("first.row", "first.id")
    # Equal rows meet in the join already, so dropping all but one needs no further exchange.
    kept = rows.select("row", "id", "doc").join(chosen, ["row", "id"], "left_semi").dropDuplicates(["row", "id"])
    return kept.select("doc.*")


def hexadecimal(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
