"""Secret scan over an incremental blob ledger.

Every version of every path is addressed by the SHA-256 of its content. The ledger holds one
row per (blob, rule, rule version) that was ever scanned; a run scans only the pairs it lacks,
each blob once however many paths hold it, and joins the findings back to all paths.

Defined cases: a null content is the empty text; repeated rows each get their blob's findings;
an empty table gives an empty result; other columns of the input are not read, so their names
cannot clash. Rows may hold nulls in any path column.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from patronlens.workspace import materialize, new_path


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of `pattern`, kept if `group` has `least` characters or more."""

    kind: str
    version: int
    pattern: str
    least: int
    group: int = 0

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# The three kinds. For the last two a minimum in the pattern finds the same
# maximal runs as a check afterwards; an assignment that is too short hides what it covers.
RULES = (
    Rule(
        "assign", 1,
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        least=6, group=2,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}", least=20),
    Rule("hex", 1, r"[0-9a-f]{24,}", least=24),
)

LEDGER = (
    "blob_id binary, kind string, version int, pieces array<struct<gap:bigint,hit:bigint,kept:boolean>>"
)


def blob_id(content: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(content, F.lit("")), 256))


def _pieces(text: Column, hits: Column, rule: Rule) -> Column:
    """The text cut at its matches: length of the gap before each, of the match, and whether it counts."""
    cut = F.when(F.size(hits) > 0, F.split(text, rule.pattern, -1)).otherwise(F.array().cast("array<string>"))

    def piece(gap: Column, hit: Column) -> Column:
        measured = hit if rule.group == 0 else F.regexp_extract(hit, rule.pattern, rule.group)
        return F.struct(
            F.length(gap).cast("bigint").alias("gap"),
            F.length(hit).cast("bigint").alias("hit"),
            (F.length(measured) >= rule.least).alias("kept"),
        )

    return F.filter(F.zip_with(cut, hits, piece), lambda p: p["hit"].isNotNull())


def _exists(df: DataFrame, path: str) -> bool:
    spark = df.sparkSession
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def update_ledger(
    versions: DataFrame, paths: Sequence[str], content: str, ledger: str, rules: Sequence[Rule] = RULES
) -> DataFrame:
    """Scan what the ledger at the path `ledger` lacks and append it; returns the manifest (paths, blob_id).

    One version per blob is chosen by the smallest hash of its path; only that text is scanned.
    """
    spark = versions.sparkSession
    named = [F.col(p).alias(f"_p{i}") for i, p in enumerate(paths)]
    held = versions.select(*named, F.coalesce(F.col(content), F.lit("")).alias("_text"))
    held = held.withColumn("blob_id", blob_id(F.col("_text")))
    keys = [f"_p{i}" for i in range(len(paths))]
    manifest = materialize(held.select(*keys, "blob_id"), "manifest")

    row = F.xxhash64(*keys)
    wanted = [rule.key for rule in rules]
    pending = manifest.groupBy("blob_id").agg(F.min(row).alias("_row"))
    if _exists(versions, ledger):
        seen = spark.read.schema(LEDGER).parquet(ledger).groupBy("blob_id").agg(
            F.collect_set(F.concat_ws("@", "kind", F.col("version").cast("string"))).alias("_seen")
        )
        lacking = F.array_except(F.lit(wanted), F.coalesce("_seen", F.array().cast("array<string>")))
        pending = pending.join(seen, "blob_id", "left").select("blob_id", "_row", lacking.alias("_lacking"))
        pending = pending.where(F.size("_lacking") > 0)
    else:
        pending = pending.withColumn("_lacking", F.lit(wanted))
    texts = held.select("blob_id", row.alias("_row"), "_text")
    texts = texts.join(pending.hint("shuffle_hash"), ["blob_id", "_row"])

    found = texts.select(
        "blob_id", "_text", "_lacking",
        *[
            F.when(F.array_contains("_lacking", rule.key), F.regexp_extract_all("_text", F.lit(rule.pattern), F.lit(0)))
            .alias(f"_hits{i}")
            for i, rule in enumerate(rules)
        ],
    )
    scans = F.array(*[
        F.when(
            F.array_contains("_lacking", rule.key),
            F.struct(
                F.lit(rule.kind).alias("kind"),
                F.lit(rule.version).alias("version"),
                _pieces(F.col("_text"), F.col(f"_hits{i}"), rule).alias("pieces"),
            ),
        )
        for i, rule in enumerate(rules)
    ])
    scanned = found.select("blob_id", F.explode(scans).alias("_scan")).where("_scan is not null")
    scanned.select("blob_id", "_scan.*").write.mode("append").parquet(ledger)
    return manifest


def findings(df: DataFrame, ledger: str, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Spans of the given rule versions: blob_id, kind, start, end (code points, end exclusive)."""
    rows = df.sparkSession.read.schema(LEDGER).parquet(ledger)
    current = F.concat_ws("@", "kind", F.col("version").cast("string")).isin([rule.key for rule in rules])
    pieces = rows.where(current & (F.size("pieces") > 0)).select("blob_id", "kind", F.posexplode("pieces"))
    pieces = pieces.select("blob_id", "kind", F.col("pos").alias("_at"), "col.*").distinct()
    # One window holds the matches of one rule in one text.
    before = Window.partitionBy("blob_id", "kind").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    ends = pieces.withColumn("end", F.sum(F.col("gap") + F.col("hit")).over(before))
    return ends.where("kept").select("blob_id", "kind", (F.col("end") - F.col("hit")).alias("start"), "end")


def scan_secrets(
    versions: DataFrame,
    paths: Sequence[str] = ("doc_id",),
    content: str = "text",
    ledger: str | None = None,
    rules: Sequence[Rule] = RULES,
) -> DataFrame:
    """One row per version: its path columns, `blob_id` and `spans`, an array of (start, kind, end) in order.

    Without a `ledger` path a new one is begun in the shared folder.
    """
    ledger = ledger or new_path(versions.sparkSession, "blob-ledger")
    manifest = update_ledger(versions, paths, content, ledger, rules)
    order = F.array_position(F.lit([rule.kind for rule in rules]), F.col("kind"))
    span = F.struct("start", order.alias("_order"), "end", "kind")
    per_blob = findings(versions, ledger, rules).groupBy("blob_id").agg(F.sort_array(F.collect_list(span)).alias("_s"))
    none = F.array().cast("array<struct<start:bigint,kind:string,end:bigint>>")
    spans = F.transform("_s", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    return manifest.join(per_blob, "blob_id", "left").select(
        *[F.col(f"_p{i}").alias(p) for i, p in enumerate(paths)], "blob_id", F.coalesce(spans, none).alias("spans")
    )


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by [kind]; of overlapping spans the part not yet covered goes too."""
    def step(state: Column, span: Column) -> Column:
        gap = F.substring(text, (state["at"] + 1).cast("int"), (span["start"] - state["at"]).cast("int"))
        fresh = span["start"] >= state["at"]
        return F.struct(
            F.when(fresh, F.concat(state["out"], gap, F.lit("["), span["kind"], F.lit("]"))).otherwise(state["out"]).alias("out"),
            F.greatest(state["at"], span["end"]).alias("at"),
        )

    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at"))
    whole = F.aggregate(
        spans, start, step,
        lambda s: F.concat(s["out"], F.substring(text, (s["at"] + 1).cast("int"), F.length(text))),
    )
    return F.when(F.size(spans) == 0, text).otherwise(whole)


def digests(scanned: DataFrame) -> DataFrame:
    """Counts by kind and the joined spans of a scan over `documents`."""
    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["kind"].isin([rule.kind for rule in RULES]))
    kinds = F.transform("spans", lambda s: s["kind"])

    def count(kind: str) -> Column:
        return F.size(F.filter(kinds, lambda k: k == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [count(rule.kind) for rule in RULES]
    return scanned.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
