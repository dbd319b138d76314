"""Secret scans with an incremental ledger of blobs, in DataFrame functions alone.

Every version of every path is known by the SHA-256 of its text. The ledger lists the (blob, rule,
rule version) pairs that were scanned and the findings of each. A run scans only pairs that the
ledger lacks, each distinct text once however many paths hold it, and joins all findings, old
and new, back to all paths.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from stormgrid.llm.components import PART_ROWS, PART_TEXTS, few_parts, unused
from stormgrid.session import scratch
from stormgrid.sources.layers import exists


@dataclass(frozen=True)
class Rule:
    """``least``: characters that the match, or its group ``group``, must have."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int
    base: bool = False


# The first three are fixed by the contract of the query; the others are added by this scan.
RULES = (
    Rule("assign", 1, r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8, True),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 16, True),
    Rule("hex", 1, r"[0-9a-f]+", 0, 32, True),
    Rule("github", 1, r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40),
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
)
SPAN = "array<struct<start:int,ord:int,end:int>>"
SCANNED = T.StructType([T.StructField("blob", T.BinaryType()), T.StructField("rules", T.ArrayType(T.StringType()))])
FINDINGS = T.StructType(
    [
        T.StructField("blob", T.BinaryType()),
        T.StructField("rule", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("ord", T.IntegerType()),
        T.StructField("start", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
    ]
)


def rule_key(rule: Rule) -> str:
    return f"{rule.kind}/{rule.version}"


def spans(text: Column, rule: Rule, order: int) -> Column:
    """All spans of a rule in code points, leftmost first, without overlap among themselves.

    The text is cut at the matches: a match starts where the pieces and matches before it end.
    """
    pattern = F.lit(rule.pattern)
    # runs of hex are taken at their least length at once: a run is one match either way, and
    # the cut would otherwise have a piece for every letter a to f
    if rule.group == 0 and rule.kind == "hex":
        pattern = F.lit(f"[0-9a-f]{{{rule.least},}}")
    found = F.regexp_extract_all(text, pattern, 0)
    judged = F.regexp_extract_all(text, pattern, rule.group) if rule.group else found
    pieces = F.split(text, pattern, -1)
    steps = F.arrays_zip(
        F.transform(F.slice(pieces, 1, F.size(found)), F.length).alias("gap"),
        F.transform(found, F.length).alias("size"),
        F.transform(judged, F.length).alias("judged"),
    )
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + x["size"]
        span = F.array(F.struct(start.alias("start"), F.lit(order).alias("ord"), end.alias("end")))
        out = F.when(x["judged"] >= rule.least, F.concat(acc["out"], span)).otherwise(acc["out"])
        return F.struct(end.alias("at"), out.alias("out"))

    return F.aggregate(steps, zero, add, lambda acc: acc["out"])


def _hint(rule: Rule) -> str:
    """A pattern that every text with a finding has, cheaper to search for."""
    return {"hex": f"[0-9a-f]{{{rule.least}}}", "access": "AKIA[A-Z0-9]{12}"}.get(rule.kind, rule.pattern)


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    if exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def scan(paths: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(path, blob, spans) of every row of (path, text), after scanning what the ledger lacks.

    ``spans`` is an array of (start, ord, end, kind) by start and rule order, empty where there
    is nothing; a null text is empty. Rows may repeat a path: each is a version of its own.
    Findings are written before the pairs are listed as scanned, so a run that breaks in
    between scans those again, and findings are read as a set.
    """
    spark = paths.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    versions = paths.select("path", text.alias("text")).withColumn("blob", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    keys = [rule_key(r) for r in rules]
    scanned = _read(spark, f"{ledger}/scanned", SCANNED)
    wanted = F.array(*map(F.lit, keys))

    # unseen pairs, one row per blob: its rules without a scan, and one row that holds its text
    row = F.struct(F.col("path").isNull().alias("no_path"), "path")
    blobs = versions.groupBy("blob").agg(F.min(row)["path"].alias("path"))
    known = (
        scanned.select("blob", F.explode("rules").alias("rule"))
        .where(F.col("rule").isin(keys))
        .groupBy("blob")
        .agg(F.collect_set("rule").alias("known"))  # at most one entry per rule
    )
    pending = blobs.join(known, "blob", "left").select(
        "blob", "path", F.array_except(wanted, F.coalesce("known", F.array().cast("array<string>"))).alias("due")
    )
    pending = pending.where(F.size("due") > 0)
    texts = versions.withColumn("maybe", F.array_compact(F.array(*[F.when(F.col("text").rlike(_hint(r)), k) for r, k in zip(rules, keys)])))
    # only texts that a rule may match travel, the others are noted as scanned by their digest; and
    # they travel by blob and path, so that the copies of a blob do not meet in one task
    held = pending.select(F.col("blob").alias("held"), F.col("path").alias("holder"), "due")
    due = (
        texts.where(F.size("maybe") > 0)
        .join(held, (F.col("blob") == F.col("held")) & F.col("path").eqNullSafe(F.col("holder")))
        .withColumn("todo", F.array_intersect("due", "maybe"))
    )
    found = F.concat(
        *[
            F.when(F.array_contains("todo", k), spans(F.col("text"), r, i)).otherwise(F.array().cast(SPAN))
            for i, (r, k) in enumerate(zip(rules, keys))
        ]
    )
    fresh = due.select("blob", F.explode(found).alias("s"))
    names, kinds = F.array(*map(F.lit, keys)), F.array(*[F.lit(r.kind) for r in rules])
    run = scratch(spark, "scan").rsplit("/", 1)[-1]
    rows = paths.count()
    fresh.repartition(rows // PART_ROWS + 1).select(
        "blob",
        F.element_at(names, F.col("s.ord") + 1).alias("rule"),
        F.element_at(kinds, F.col("s.ord") + 1).alias("kind"),
        "s.ord",
        "s.start",
        "s.end",
    ).write.parquet(f"{ledger}/findings/run={run}")
    few_parts(pending, rows).select("blob", F.col("due").alias("rules")).write.parquet(f"{ledger}/scanned/run={run}")

    # a rule's place in the list may differ between runs: taken from this run's list
    place = F.array_position(names, F.col("rule")).cast("int") - 1
    per_blob = (
        _read(spark, f"{ledger}/findings", FINDINGS)
        .where(F.col("rule").isin(keys))
        .select("blob", F.struct("start", place.alias("ord"), "end", "kind").alias("span"))
        .groupBy("blob")
        .agg(F.array_sort(F.collect_set("span")).alias("spans"))  # of one text
    )
    empty = F.array().cast("array<struct<start:int,ord:int,end:int,kind:string>>")
    return versions.select("path", "blob").join(per_blob, "blob", "left").withColumn("spans", F.coalesce("spans", empty))


def joined(found: Column) -> Column:
    return F.array_join(
        F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def report(docs: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts and spans of every row of (doc_id, text)."""
    ledger = ledger or scratch(docs.sparkSession, "ledger")
    found = scan(docs.select(F.col("doc_id").alias("path"), "text"), ledger, rules)
    base_kinds = [r.kind for r in rules if r.base]
    base = F.filter("spans", lambda s: s["kind"].isin(base_kinds))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        F.col("path").alias("doc_id"),
        *[count(k).alias(f"n_{k}") for k in base_kinds],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def redact(docs: DataFrame, ledger: str, mark: str = "[secret]", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows with each stretch of found spans replaced by a mark and n_chars set anew; all
    other columns, and the texts without findings, stay as they are."""
    found = scan(docs.select(F.col("doc_id").alias("path"), "text"), ledger, rules)
    blob_, spans_, tail_ = (unused(c, docs.columns) for c in ("_blob", "_spans", "_tail"))
    marked = (
        found.where(F.size("spans") > 0)
        .groupBy("blob")
        .agg(F.first("spans").alias(spans_))  # equal for all paths of a blob
        .withColumnRenamed("blob", blob_)
    )
    blob = F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256))
    # few texts have findings; their digests are joined where small enough, else by shuffle
    rows = docs.withColumn(blob_, blob).join(marked, blob_, "left")
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def cut(acc: Column, s: Column) -> Column:
        gap = F.substring(F.col("text"), acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        add = F.when((s["start"] < acc["at"]) & (acc["at"] > 0), F.lit("")).otherwise(F.concat(gap, F.lit(mark)))
        return F.struct(F.greatest(s["end"], acc["at"]).alias("at"), F.concat(acc["out"], add).alias("out"))

    cleaned = F.aggregate(spans_, zero, cut, lambda acc: acc["out"])
    tail = F.aggregate(spans_, F.lit(0), lambda at, s: F.greatest(at, s["end"]))
    whole = F.concat(cleaned, F.substring(F.col("text"), F.col(tail_) + 1, F.length("text")))
    rows = rows.withColumn(tail_, tail)
    changed = F.col(spans_).isNotNull()
    out = rows.withColumn("text", F.when(changed, whole).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        size = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(changed, size).otherwise(F.col("n_chars")))
    return few_parts(out.select(*docs.columns), docs.count(), PART_TEXTS)
