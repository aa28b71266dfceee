"""Secret scans with an incremental blob ledger.

Method.  Every version of every path is content-addressed (SHA-256 of its
text).  The ledger keeps the (blob, rule version) pairs that were scanned with
the spans found, as Parquet batches in a shared folder.  An update scans each
unseen blob once, for the rule versions not yet run on it, and appends one
batch; the findings of all batches are joined back to all paths and versions
that hold the blob.
Everything on the data path is a DataFrame expression: matches come from
``regexp_extract_all`` and their positions from the lengths of the gaps that
``split`` leaves between them.

Defined cases: null text counts as empty; an empty table gives no rows;
repeated rows are all reported, and so are rows of one path with several texts
or of a null path; ties of spans go by start, then by the order of the rules;
texts of any length are scanned whole; extra columns are ignored.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """One pattern.  ``hint``: strings of which a match holds at least one,
    so that texts without them are not searched.  ``group``/``least``: the
    capture group that must have that many characters."""

    kind: str
    version: str
    regex: str
    hint: tuple[str, ...] = ()
    group: int = 0
    least: int = 0
    base: bool = True

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# The base patterns of the contract, in its order.
BASE_RULES = (
    Rule("assign", "1", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         hint=(":", "="), group=1, least=6),
    Rule("access", "1", r"AKIA[A-Z0-9]+", hint=("AKIA",), least=20),
    # A run of 24 or more is the base pattern's run that passes its length.
    Rule("hex", "1", r"[0-9a-f]{24,}"),
)
# Further well-known formats whose prefixes make false matches unlikely.
MORE_RULES = (
    Rule("vcs", "1", r"\bgh[pousr]_[A-Za-z0-9]{36,}", hint=("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), base=False),
    Rule("pem", "1", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", hint=("PRIVATE KEY",), base=False),
    Rule("jwt", "1", r"\beyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", hint=("eyJ",), base=False),
)
RULES = BASE_RULES + MORE_RULES

SPAN = "struct<rank:int,kind:string,from:bigint,to:bigint>"


def _spans(text: Column, rule: Rule, rank: int) -> Column:
    """All matches of the rule: array of (rank, kind, from, to), code points."""
    matches = F.regexp_extract_all(text, F.lit(rule.regex), F.lit(0))
    checked = F.regexp_extract_all(text, F.lit(rule.regex), F.lit(rule.group)) if rule.group else matches
    gaps = F.split(text, rule.regex, -1)
    # arrays_zip pads the last gap, which no match follows
    steps = F.filter(F.arrays_zip(gaps.alias("gap"), matches.alias("hit"), checked.alias("body")),
                     lambda s: s["hit"].isNotNull())
    start = F.struct(F.lit(0).cast("long").alias("at"),
                     F.array().cast(f"array<{SPAN}>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        begin = acc["at"] + F.length(s["gap"])
        end = begin + F.length(s["hit"])
        span = F.struct(F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"),
                        begin.alias("from"), end.alias("to"))
        return F.struct(end.alias("at"),
                        F.when(F.length(s["body"]) >= rule.least, F.concat(acc["out"], F.array(span)))
                        .otherwise(acc["out"]).alias("out"))

    return F.aggregate(steps, start, step, lambda acc: acc["out"])


def _may_match(text: Column, rule: Rule) -> Column:
    hit = F.lit(not rule.hint)
    for h in rule.hint:
        hit = hit | F.contains(text, F.lit(h))
    return hit & text.rlike(rule.regex)


def ledger_of(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Rows (blob, rule) to add to the ledger once the blobs were scanned."""
    return blobs.select("blob", F.explode(F.array(*[F.lit(r.key) for r in rules])).alias("rule"))


def versions(docs: DataFrame, path: str = "doc_id") -> DataFrame:
    """path, blob, text: every version, content-addressed."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col(path).alias("path"), F.sha2(text, 256).alias("blob"), text.alias("text"))


def scan(history: DataFrame, ledger: DataFrame | None = None,
         rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Findings per blob and the rules not yet run on it: blob, spans (only
    blobs with any).

    ``history`` has blob and text (see ``versions``), ``ledger`` the (blob,
    rule) pairs of earlier scans.  Copies of a blob collapse on the map side.
    """
    return _found(_due(history, ledger, rules), rules)


def _due(history: DataFrame, ledger: DataFrame | None, rules: tuple[Rule, ...]) -> DataFrame:
    """blob, text, todo: the rules of ``rules`` that each blob still needs."""
    blobs = history.select("blob", "text").distinct()
    wanted = F.array(*[F.lit(r.key) for r in rules])
    if ledger is None:
        return blobs.withColumn("todo", wanted)
    seen = ledger.groupBy("blob").agg(F.collect_set("rule").alias("seen"))
    return (blobs.join(seen, "blob", "left")
            .withColumn("todo", F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>"))))
            .filter(F.size("todo") > 0).select("blob", "text", "todo"))


def _found(due: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    text = F.col("text")
    none = F.array().cast(f"array<{SPAN}>")
    hits = due.withColumns({
        f"may_{i}": F.array_contains("todo", r.key) & _may_match(text, r) for i, r in enumerate(rules)})
    hits = hits.filter(" or ".join(f"may_{i}" for i in range(len(rules))))
    found = [F.when(F.col(f"may_{i}"), _spans(text, r, i)).otherwise(none) for i, r in enumerate(rules)]
    return hits.select("blob", F.concat(*found).alias("spans")).filter(F.size("spans") > 0)


#: One row for each blob and rule version that was scanned; spans is empty where
#: nothing was found.
LEDGER_SCHEMA = "blob string, rule string, spans array<struct<from:bigint,to:bigint>>"


class Ledger:
    """The kept ledger: Parquet files in a shared folder, one batch a scan.

    A batch is a folder of its own, written by Spark's committer and read only
    once its success file is there, so a scan that fails leaves no trace and
    is simply run again.  Batches are never changed.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def _fs(self):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def batches(self) -> list[str]:
        fs, at = self._fs()
        if not fs.exists(at):
            return []
        found = sorted(str(f.getPath()) for f in fs.listStatus(at))
        return [f for f in found if fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(f, "_SUCCESS"))]

    def read(self) -> DataFrame:
        """Every (blob, rule) pair scanned so far with its spans, once each (two
        scans at a time may both have written a pair)."""
        return self._rows().dropDuplicates(["blob", "rule"])

    def _rows(self) -> DataFrame:
        paths = self.batches()
        if not paths:
            return self.spark.createDataFrame([], LEDGER_SCHEMA)
        return self.spark.read.schema(LEDGER_SCHEMA).parquet(*paths)

    def update(self, history: DataFrame, rules: tuple[Rule, ...] = RULES) -> str | None:
        """Scan the unseen pairs of blobs and rule versions and append them in
        one batch; its folder, or None if there was nothing to scan."""
        paths = self.batches()
        due = _due(history, self.read().select("blob", "rule") if paths else None, rules)
        spans = [F.when(F.array_contains("todo", r.key) & _may_match(F.col("text"), r), _spans(F.col("text"), r, i))
                 .otherwise(F.array().cast(f"array<{SPAN}>")) for i, r in enumerate(rules)]
        each = F.filter(F.array(*[F.struct(F.lit(r.key).alias("rule"), F.transform(s, lambda x: F.struct(
            x["from"].alias("from"), x["to"].alias("to"))).alias("spans")) for r, s in zip(rules, spans)]),
            lambda e: F.array_contains("todo", e["rule"]))
        batch = f"{self.path.rstrip('/')}/batch-{len(paths):06d}-{uuid.uuid4().hex}"
        due.select("blob", F.explode(each).alias("e")).select("blob", "e.rule", "e.spans").write.parquet(batch)
        if self.spark.read.schema(LEDGER_SCHEMA).parquet(batch).limit(1).count():
            return batch
        at = self.spark._jvm.org.apache.hadoop.fs.Path(batch)
        self._fs()[0].delete(at, True)  # an empty batch of this call
        return None

    def findings(self, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """blob, spans of the blobs with any, by the current rule versions, in
        the form of ``scan``."""
        rank = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.key, F.struct(
            F.lit(i).alias("rank"), F.lit(r.kind).alias("kind")))])
        own = (self._rows().filter(F.col("rule").isin([r.key for r in rules]) & (F.size("spans") > 0))
               .dropDuplicates(["blob", "rule"]).withColumn("at", rank[F.col("rule")])
               .select("blob", F.transform("spans", lambda s: F.struct(
                   F.col("at.rank").alias("rank"), F.col("at.kind").alias("kind"), s["from"].alias("from"), s["to"].alias("to"))).alias("spans")))
        return own.groupBy("blob").agg(F.flatten(F.collect_list("spans")).alias("spans"))  # one list a rule


def findings(history: DataFrame, found: DataFrame) -> DataFrame:
    """Findings joined back to all paths: path, blob, spans (empty if none)."""
    return (history.select("path", "blob").join(found, "blob", "left")
            .withColumn("spans", F.coalesce("spans", F.array().cast(f"array<{SPAN}>"))))


def _joined(spans: Column) -> Column:
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["from"].alias("from"), s["rank"].alias("rank"), s["to"].alias("to"), s["kind"].alias("kind"))))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["from"], s["to"])), ",")


def digest(found: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, n_<base kind>, base_sha256, spans from ``findings`` rows."""
    spans = F.col("spans")
    base = [i for i, r in enumerate(rules) if r.base]

    def count(i: int) -> Column:  # a second parameter of the lambda would be the element's index
        return F.size(F.filter(spans, lambda s: s["rank"] == i)).cast("long").alias(f"n_{rules[i].kind}")

    counts = [count(i) for i in base]
    own = F.filter(spans, lambda s: s["rank"].isin(base))
    return found.select(F.col("path").alias("doc_id"), *counts,
                        F.sha2(_joined(own), 256).alias("base_sha256"), _joined(spans).alias("spans"))
