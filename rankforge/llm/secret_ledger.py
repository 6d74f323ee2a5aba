"""Secret scans through an incremental blob ledger, DataFrame operations only.

Every version of a path is a blob named by the SHA-256 of its text. The ledger
is a written table of (blob, rule, rule version, findings), also for blobs without
findings. A scan takes the distinct blobs of the versions given, drops the
(blob, rule, version) triples the ledger has, runs the rules that are left on the
texts that are left, appends the outcome to the ledger, and joins the ledger's
findings back to every path. Copies are scanned once, and a raised rule version
scans everything again under that rule alone.

Spans are code points, end exclusive. They come from what lies between the
matches: the lengths of the pieces and the matches in turn add up to the places, a
running sum over the rows of a blob's matches. Redaction puts together the pieces that stay from
blocks of the text, so both take time in proportion to a text and its matches.

Nulls and edges: a null text is the empty blob. Null ids are passed through.
Repeated rows are one blob and stay as many rows. Overlapping spans of
several rules are all reported; redaction merges them. Empty tables give empty tables.
Only the id and text columns are read (``redact`` passes the others through).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankforge.llm.common import unused, written
from rankforge.session import scratch_path


@dataclass(frozen=True)
class Rule:
    kind: str
    version: int
    pattern: str  # Java
    least: int = 0  # characters of the group, at least
    group: int = 0


# The rules of the scan, in the order in which equal starts are listed.
RULES = (
    Rule("assign", 1, r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", 1, r"[0-9a-f]{24,}"),
)
MASK = "[REDACTED]"
#: Code points in a block of a text to redact: a piece costs at most two blocks to cut.
BLOCK = 1024


def blob_id(text_col: str) -> Column:
    return F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256)


def steps_of(rule: Rule, text: Column) -> Column:
    """array<struct<gap, len, keep>> of the rule's matches in a non-null text: characters since the match before, its own, whether it counts."""
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    steps = F.zip_with(found, F.slice(F.split(text, rule.pattern, -1), 1, F.size(found)), lambda m, before: F.struct(F.length(before).alias("gap"), F.length(m).alias("len")))
    kept = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), lambda g: F.length(g) >= rule.least)
    steps = F.zip_with(steps, kept, lambda s, k: F.struct(s["gap"].alias("gap"), s["len"].alias("len"), k.alias("keep")))
    # Most texts have no match: one search decides, and the rest of the work is for those that have.
    return F.when(text.rlike(rule.pattern), steps).otherwise(F.expr("cast(array() as array<struct<gap:int,len:int,keep:boolean>>)"))


def placed(scanned: DataFrame) -> DataFrame:
    """(blob, rule, version, steps) to (blob, rule, version, spans): array<struct<start, end>>, empty where nothing counts."""
    keys = ["blob", "rule", "version"]
    rows = scanned.select(*keys, F.posexplode_outer("steps").alias("pos", "s"))
    end = F.sum(F.col("s.gap") + F.col("s.len")).over(Window.partitionBy(*keys).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)).cast("int")
    rows = rows.withColumn("end", end)
    span = F.when(F.col("s.keep"), F.struct((F.col("end") - F.col("s.len")).alias("start"), F.col("end").alias("end")))
    return rows.groupBy(*keys).agg(F.sort_array(F.collect_list(span)).alias("spans"))


def pieces(findings: DataFrame) -> DataFrame:
    """(blob, found) to (blob, kept): array<struct<from, to>> of what stays around each maximal run of covered characters, the last ``to`` null."""
    rows = findings.select("blob", F.explode("found").alias("s")).select("blob", "s.start", "s.end")
    order = Window.partitionBy("blob").orderBy("start", "end")
    covered = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("covered", covered).withColumn("fresh", F.coalesce(F.col("start") >= F.col("covered"), F.lit(True)))
    # A run begins where nothing before reaches; what stays before it begins where all before it ends.
    rows = rows.groupBy("blob").agg(F.sort_array(F.collect_list(F.when(F.col("fresh"), F.struct(F.coalesce("covered", F.lit(0)).alias("from"), F.col("start").alias("to"))))).alias("k"),
                                    F.max("end").alias("last"))
    return rows.select("blob", F.concat("k", F.array(F.struct(F.col("last").alias("from"), F.lit(None).cast("int").alias("to")))).alias("kept"))


def redacted(blocks: Column, kept: Column) -> Column:
    """The pieces, ``MASK`` between them, from a text's blocks of ``BLOCK`` code points."""
    def block(i):
        return F.coalesce(F.get(blocks, i), F.lit(""))

    def cut(p):
        first, to = F.floor(p["from"] / BLOCK).cast("int"), F.coalesce(p["to"], F.size(blocks) * BLOCK)
        last, at = F.floor(to / BLOCK).cast("int"), p["from"] % BLOCK
        return F.when(first == last, F.substring(block(first), at + 1, to - p["from"])).otherwise(F.concat(
            F.substring(block(first), at + 1, F.lit(BLOCK)), F.array_join(F.slice(blocks, first + 2, F.greatest(last - first - 1, F.lit(0))), ""), F.substring(block(last), F.lit(1), to % BLOCK)))

    return F.array_join(F.transform(kept, cut), MASK)


class Ledger:
    """The table of scanned (blob, rule, version) at ``path``; every append is a folder of its own.

    On a path that holds commits already, the finished ones are taken up, and new ones are numbered past all of them.
    """

    def __init__(self, spark, path: str | None = None):
        self.spark, self.path = spark, path or scratch_path(spark, f"ledger-{uuid.uuid4().hex[:12]}")
        self.commits, self.next = self._found()

    def _found(self) -> tuple[list[str], int]:
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        names = sorted(x.getPath().getName() for x in fs.listStatus(root)) if fs.exists(root) else []
        names = [n for n in names if n.startswith("commit-") and n[7:].isdigit()]
        done = [f"{self.path}/{n}" for n in names if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{self.path}/{n}/_SUCCESS"))]
        return done, max((int(n[7:]) + 1 for n in names), default=0)

    def seen(self) -> DataFrame | None:
        return self.spark.read.parquet(*self.commits) if self.commits else None

    def append(self, outcome: DataFrame) -> None:
        path = f"{self.path}/commit-{self.next:06d}"
        self.next += 1
        outcome.write.parquet(path)
        self.commits.append(path)

    def scan(self, versions: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> None:
        """Scans what the ledger doesn't have yet of the blobs in ``versions``."""
        blobs = versions.select(blob_id(text_col).alias("blob"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        wanted = F.array(*(F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version")) for r in rules))
        seen = self.seen()
        if seen is None:
            blobs = blobs.dropDuplicates(["blob"]).withColumn("todo", wanted)
        else:
            have = seen.groupBy("blob").agg(F.collect_set(F.struct("rule", "version")).alias("have"))  # a few per blob: one per rule version
            blobs = (blobs.dropDuplicates(["blob"]).join(have, "blob", "left")
                     .withColumn("todo", F.array_except(wanted, F.coalesce("have", F.expr("cast(array() as array<struct<rule:string,version:int>>)")))).where(F.size("todo") > 0))
        outcome = blobs.select("blob", F.explode(F.array(*(
            F.when(F.array_contains(F.col("todo"), F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version"))),
                   F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version"), steps_of(r, F.col("text")).alias("steps")))
            for r in rules))).alias("x")).where("x is not null").select("blob", "x.rule", "x.version", "x.steps")
        self.append(placed(outcome))

    def findings(self, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """blob and ``found``: (start, ord, end, kind) of the given rule versions, sorted; only blobs with findings."""
        order = F.create_map(*(F.lit(x) for i, r in enumerate(rules) for x in (f"{r.kind}:{r.version}", i)))
        rows = self.seen().withColumn("ord", order[F.concat_ws(":", "rule", "version")]).where(F.col("ord").isNotNull() & (F.size("spans") > 0))
        flat = F.flatten(F.collect_list(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), F.col("ord").alias("ord"), s["end"].alias("end"), F.col("rule").alias("kind")))))
        return rows.groupBy("blob").agg(F.array_sort(flat).alias("found"))


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES, ledger: Ledger | None = None) -> DataFrame:
    """A row for each path: its id, ``blob`` and ``found`` (an empty array: nothing)."""
    ledger = ledger or Ledger(docs.sparkSession)
    ledger.scan(docs, text_col, rules)
    paths = docs.select(F.col(id_col), blob_id(text_col).alias("blob"))
    return paths.join(ledger.findings(rules), "blob", "left").select(id_col, "blob", F.coalesce("found", F.expr("cast(array() as array<struct<start:int,ord:int,end:int,kind:string>>)")).alias("found"))


def written_spans(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars", rules: tuple[Rule, ...] = RULES, ledger: Ledger | None = None) -> DataFrame:
    """All columns; each maximal run of covered characters becomes ``MASK``. Other texts stay as they are."""
    ledger = ledger or Ledger(docs.sparkSession)
    ledger.scan(docs, text_col, rules)
    blob, spans, blocks, new = (unused(docs, n) for n in ("_rf_blob", "_rf_kept", "_rf_blocks", "_rf_text"))
    found = written(pieces(ledger.findings(rules)), "findings").select(F.col("blob").alias(blob), F.col("kept").alias(spans))
    hit = F.col(spans).isNotNull()
    joined = docs.withColumn(blob, blob_id(text_col)).join(found, blob, "left")
    joined = joined.withColumn(blocks, F.when(hit, F.regexp_extract_all(F.col(f"`{text_col}`"), F.lit(f"(?s).{{1,{BLOCK}}}+"), F.lit(0))))
    out = joined.withColumn(new, F.when(hit, redacted(F.col(blocks), F.col(spans))).otherwise(F.col(f"`{text_col}`")))
    kept = {text_col: F.col(new)}
    if length_col in docs.columns:
        kept[length_col] = F.when(hit, F.length(new).cast(docs.schema[length_col].dataType)).otherwise(F.col(length_col))
    return out.select(*(kept.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns))
