"""URL filters by a path-template tree.

Method.  Rules decide the urls they fit; those urls, and any labels given, are
the labelled examples of a template tree that judges the rest.  Per host, path
segments become typed tokens (numbers, hashes, dates), then the tree is walked
level by level.  A node most of whose urls have a child of their own gets one
wildcard child.  Other siblings merge when they are statistically alike: the
two-proportion test finds no difference between a branch and the rest of its
parent in how often it ends there and how often it goes on with a variable
segment, and none in the labels it has.  A branch without labels has none that
could differ, so it merges with labelled siblings of its shape.

A template's purity is its share of good labels, smoothed towards the purity of
its parent as if that were ``SMOOTHING`` further labels; the parent's is
smoothed towards its own parent's, up to the host, whose own is smoothed towards
1/2: labels of other hosts, which rules mostly block, are no evidence.  A
template is rejected when its purity falls under ``least_purity``, so one
without labels goes the way of its surroundings, and a host without any is
allowed.

Urls are first counted by (host, typed path), so the tree is built from a
table that numeric ids do not grow and a hot host reaches each reducer as
partial counts.

Defined cases: a null url, or one without ``://``, has empty host and path, no
rule, and is allowed; an empty path fits no rule; repeated rows are all reported; urls of any length are read whole, what is
deeper than ``DEPTH`` segments as one segment; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.llm.common import discard, lower_ascii, staged

# The rules of the contract, as (verdict, host and path).
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
#: Segments that get a tree level of their own; what is deeper is one segment.
DEPTH = 3
#: Smallest purity of a template that is not rejected.
LEAST_PURITY = 0.3
#: Labels that a parent's purity counts for.
SMOOTHING = 2.0
#: Distinct children a url, and the least urls, from which a node gets a wildcard.
WILD_RATE, WILD_URLS = 0.5, 4
#: Standard errors by which a branch must differ from its siblings to stand alone.
SIGMAS = 2.0


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substring_index(url, "://", 1))
    rest = F.when(rest.isNotNull(), F.substr(url, F.length(rest) + F.lit(4)))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + F.lit(1)), r"^[^?#]*", 0)
    return F.coalesce(lower_ascii(host), F.lit("")), F.coalesce(path, F.lit(""))


def rule_for(host: Column, path: Column, rules: tuple[tuple[str, str], ...] = RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null.

    The rules are a short policy list; they become one CASE expression.
    """
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        own, _, tail = rule.partition("/")
        fits = ((host == own) | F.endswith(host, F.lit("." + own))) & F.startswith(path, F.lit("/" + tail))
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _typed(segment: Column) -> Column:
    """Variable tokens of a segment replaced by their type."""
    s = F.lower(segment)
    s = F.regexp_replace(s, r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}", "<uuid>")
    s = F.regexp_replace(s, r"\b(?=[a-f]*[0-9])[0-9a-f]{12,}\b", "<hash>")
    s = F.regexp_replace(s, r"[0-9]{4}-[0-9]{2}-[0-9]{2}", "<date>")
    return F.regexp_replace(s, r"[0-9]+", "<n>")


def segments(path: Column, depth: int = DEPTH) -> Column:
    """Typed segments, at most ``depth`` + 1: the last holds all deeper ones."""
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    deep = F.array_join(F.slice(parts, depth + 1, F.greatest(F.size(parts), F.lit(1))), "/")
    return F.transform(F.when(F.size(parts) > depth, F.concat(F.slice(parts, 1, depth), F.array(deep)))
                       .otherwise(parts), _typed)


def _differs(hits: Column, of: Column, all_hits: Column, all_of: Column, sigmas: float) -> Column:
    """-1, 0 or 1: whether a part's rate is lower, alike or higher than that of
    the rest, by the two-proportion z test with one hit and one miss added."""
    rest_hits, rest = all_hits - hits, all_of - of
    pooled = (all_hits + 1) / (all_of + 2)
    error = F.sqrt(pooled * (1 - pooled) * (1 / F.greatest(of, F.lit(1)) + 1 / F.greatest(rest, F.lit(1))))
    z = (hits / F.greatest(of, F.lit(1)) - rest_hits / F.greatest(rest, F.lit(1))) / error
    return F.when((of == 0) | (rest == 0), F.lit(0)).when(z > sigmas, F.lit(1)).when(z < -sigmas, F.lit(-1)).otherwise(F.lit(0))


def template_tree(shapes: DataFrame, depth: int = DEPTH, wild_rate: float = WILD_RATE,
                  wild_urls: int = WILD_URLS, sigmas: float = SIGMAS) -> DataFrame:
    """The shapes (host, segs, n, lab, bad) with ``steps``, their template's
    tokens from the host down.

    One level a step; statistics are sums per (host, prefix, child), so hot
    hosts combine before the shuffle.
    """
    tree = shapes.withColumn("steps", F.array().cast("array<string>"))
    for d in range(depth + 1):
        seg, nxt = F.get("segs", F.lit(d)), F.get("segs", F.lit(d + 1))
        level = tree.withColumn("seg", seg)
        child = staged(level.filter(F.col("seg").isNotNull()).groupBy("host", "steps", "seg")
                       .agg(F.sum("n").alias("n"), F.sum("lab").alias("lab"), F.sum("bad").alias("bad"),
                            F.sum(F.when(nxt.isNull(), F.col("n")).otherwise(0)).alias("ends"),
                            F.sum(F.when(nxt.contains("<"), F.col("n")).otherwise(0)).alias("vars")))
        parent = child.groupBy("host", "steps").agg(
            F.count("*").alias("children"), *[F.sum(c).alias(f"all_{c}") for c in ("n", "lab", "bad", "ends", "vars")])
        both = child.join(parent, ["host", "steps"])
        wild = (F.col("all_n") >= wild_urls) & (F.col("children") > F.col("all_n") * F.lit(wild_rate)) & (F.col("children") > 1)
        kind = F.concat_ws("", *[F.element_at(F.array(F.lit("-"), F.lit("="), F.lit("+")), _differs(
            F.col(h), F.col(o), F.col(f"all_{h}"), F.col(f"all_{o}"), sigmas) + 2)
            for h, o in (("bad", "lab"), ("ends", "n"), ("vars", "n"))])
        both = both.withColumn("alike", F.when(wild, F.lit("*")).otherwise(F.concat(F.lit("~"), kind)))
        # a hot node's classes are few: counted with partial sums, joined back
        kinds = both.groupBy("host", "steps", "alike").agg(F.count("*").alias("members"))
        step = (both.join(kinds, ["host", "steps", "alike"])
                .select("host", "steps", "seg",
                        F.when((F.col("alike") == "*") | (F.col("members") > 1), F.col("alike"))
                        .otherwise(F.col("seg")).alias("token")))
        tree = staged(level.join(step, ["host", "steps", "seg"], "left")
                      .withColumn("steps", F.when(F.col("token").isNull(), F.col("steps"))
                                  .otherwise(F.concat("steps", F.array("token"))))
                      .drop("seg", "token"))
        discard(child)
    return tree


def purities(tree: DataFrame, depth: int = DEPTH, smoothing: float = SMOOTHING) -> DataFrame:
    """host, steps, purity of every template of a tree.

    The labels below every node of the tree are summed once; a template's purity
    is then worked out along its path, from the host down.
    """
    nodes = staged(tree.filter("lab > 0").select("host", "lab", "bad", F.explode(F.transform(
        F.sequence(F.lit(0), F.size("steps")), lambda i: F.slice("steps", 1, i))).alias("steps"))
        .groupBy("host", "steps").agg(F.sum("lab").alias("lab"), F.sum("bad").alias("bad")))
    found = tree.select("host", "steps").distinct().withColumn("purity", F.lit(0.5))
    for d in range(depth + 2):
        node = nodes.filter(F.size("steps") == d).withColumnRenamed("steps", "node")
        found = found.withColumn("node", F.when(F.size("steps") >= d, F.slice("steps", 1, d))).join(node, ["host", "node"], "left")
        good = F.coalesce(F.col("lab") - F.col("bad"), F.lit(0))
        found = found.withColumn("purity", (good + F.lit(smoothing) * F.col("purity")) / (F.coalesce("lab", F.lit(0)) + F.lit(smoothing))
                                 ).drop("node", "lab", "bad")
    return found


def judge(pages: DataFrame, labels: DataFrame | None = None, rules=RULES, depth: int = DEPTH,
          least_purity: float = LEAST_PURITY, key: str = "page_id") -> DataFrame:
    """page_id, host, path, rule, verdict, template, purity for every url.

    ``labels``: optional (key, bad 0/1) examples besides the urls that rules
    decide.
    """
    host, path = host_path(F.col("url"))
    urls = (pages.select(key, "url").withColumn("host", host).withColumn("path", path)
            .withColumn("fit", rule_for(F.col("host"), F.col("path"), rules))
            .withColumn("segs", segments(F.col("path"), depth)))
    seen = urls.withColumn("bad", F.when(F.col("fit").isNotNull(), (F.col("fit.verdict") == "block").cast("int")))
    if labels is not None:
        known = labels.groupBy(key).agg(F.max("bad").alias("known"))
        seen = seen.join(known, key, "left").withColumn("bad", F.coalesce("bad", "known"))
    shapes = staged(seen.groupBy("host", "segs").agg(
        F.count("*").alias("n"), F.count("bad").alias("lab"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")))
    tree = template_tree(shapes, depth)
    # segs holds the deepest level, so the same typed path has one template
    scored = tree.select("host", "segs", "steps").join(purities(tree, depth), ["host", "steps"]).select(
        "host", "segs", F.concat(F.lit("/"), F.array_join("steps", "/")).alias("template"), "purity")
    # AQE splits a hot host's shape: both sides of this join are its own shuffles
    out = urls.join(scored, ["host", "segs"], "left")
    verdict = F.when(F.col("fit").isNotNull(), F.col("fit.verdict")).when(
        F.col("purity") < least_purity, F.lit("block")).otherwise(F.lit("allow"))
    return out.select(key, "host", "path", F.col("fit.rule").alias("rule"), verdict.alias("verdict"),
                      "template", "purity")
