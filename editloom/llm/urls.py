"""URL filter by rules and by a path-template tree, in native expressions only.

Rules come first: a rule fits a host, its subdomains and the paths that start with its path; the longest wins. What no rule
judges is judged by its template. Per host, path segments that look like numbers, hashes or identifiers, and literal
segments too rare under their parent, become wildcards; that gives a tree of templates, as deep as the paths are. Labelled
pages (by default those that rules judge) are counted in every branch they lie in. From the leaves up, a branch whose share of
bad labels does not differ from its parent's by more than Z standard errors, or that has no labels, is merged into the
parent with its like siblings, on every level up to the host; a branch that differs stands for itself and for what is
merged into it. So labels reach the unlabelled branches beside them. A template is rejected if the share of bad labels of
its branch, smoothed towards that of all labels by PRIOR_WEIGHT pseudo-labels, reaches PURITY on MIN_LABELS labels or more.

The tree is built on counts per host and path shape, never on pages; the joins back to pages are on the full shape, so that
a hot host spreads over its templates and adaptive execution splits what is still large. Levels are walked as long as
MIN_ROWS pages share a branch; what is below is rare as a whole and becomes wildcards at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

RULES = (("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block"))
MIN_SHARE, MIN_ROWS = 0.01, 5
Z, PRIOR_WEIGHT, PURITY, MIN_LABELS = 1.96, 10.0, 0.85, 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for null and for what has no ``://``; only A-Z are lower-cased."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def rule_for(host: Column, path: Column, rules=RULES) -> Column:
    """struct (size, rule, verdict) of the longest rule that fits, else null. The rules are a short list, held in the plan."""
    if not rules:
        return F.lit(None).cast("struct<size:int,rule:string,verdict:string>")
    fits = [
        F.when(((host == h) | host.endswith(f".{h}")) & path.startswith(p), F.struct(F.lit(len(h + p)).alias("size"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")))
        for h, p, v in rules
    ]
    return F.array_max(F.array(*fits))


def shape(segment: Column) -> Column:
    return (
        F.when(segment.rlike(r"^[0-9]+(\.[A-Za-z0-9]{1,5})?\z"), F.regexp_replace(segment, "^[0-9]+", "<num>"))
        .when(segment.rlike(r"^[0-9a-fA-F-]{8,}\z"), "<hex>")
        .when(segment.rlike(r"[0-9]") & (F.length(segment) >= 12), "<id>")
        .otherwise(segment)
    )


def literal(segment: Column) -> Column:
    return ~segment.startswith("<") & (segment != "")


def templates(counted: DataFrame) -> DataFrame:
    """counted (host, g, n, labelled, bad), g the shapes of a path's segments joined by slashes, with t: the template, a slash
    before every segment, `*` for literals too rare under their parent."""
    rows = counted.withColumns({"parts": F.split("g", "/"), "t": F.lit("")})
    made, k = None, 1
    while True:
        rows = rows.withColumn("part", F.get("parts", F.lit(k - 1)))
        own = rows.groupBy("host", "t", "part").agg(F.sum("n").alias("own_n"))
        total = own.groupBy("host", "t").agg(F.sum("own_n").alias("all_n"))
        rare = (F.col("own_n") < F.greatest(F.lit(float(MIN_ROWS)), F.col("all_n") * MIN_SHARE)) & literal(F.col("part"))
        named = own.join(total, ["host", "t"]).select("host", "t", "part", F.when(rare, "*").otherwise(F.col("part")).alias("name"), (F.col("all_n") < MIN_ROWS).alias("few"))
        # whatever lies below fewer than MIN_ROWS pages is rare on every level
        rest = F.array_join(F.transform(F.slice("parts", F.lit(k), F.size("parts")), lambda s: F.when(literal(s), "*").otherwise(s)), "/")
        name = F.concat("t", F.lit("/"), F.when(F.col("few"), rest).otherwise(F.col("name")))
        level = rows.join(named, ["host", "t", "part"]).select("host", "g", "n", "labelled", "bad", "parts", name.alias("t"), (F.col("few") | (F.size("parts") == k)).alias("done"))
        level = materialise(level, "templates")  # read three times by the next
        done = level.filter("done").select("host", "g", "n", "labelled", "bad", "t")
        made = done if made is None else made.unionByName(done)
        rows = level.filter("not done").drop("done")
        if not rows.limit(1).count():
            return made
        k += 1


def branches(leaf: DataFrame) -> DataFrame:
    """leaf (host, t, labelled, bad) with depth and branch: the branch that a template is merged into, its host's root at 0."""
    parts = F.split(F.expr("substring(t, 2)"), "/")
    upto = lambda d: F.when(d > 0, F.concat(F.lit("/"), F.array_join(F.slice(F.col("parts"), 1, d), "/"))).otherwise("")
    # every branch that a template lies in, with the one above
    deep = leaf.withColumn("parts", parts).withColumn("depth", F.explode(F.sequence(F.lit(0), F.size("parts"))))
    deep = deep.select("host", "t", "labelled", "bad", "depth", upto(F.col("depth")).alias("branch"), F.when(F.col("depth") > 0, upto(F.col("depth") - 1)).alias("above"))
    node = deep.filter("labelled > 0").groupBy("host", "depth", "branch", "above").agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"))
    node = materialise(node, "nodes")
    parent = node.select("host", (F.col("depth") + 1).alias("depth"), F.col("branch").alias("above"), (F.col("bad") / F.col("labelled")).alias("rate"))
    differs = F.abs(F.col("bad") / F.col("labelled") - F.col("rate")) > Z * F.sqrt(F.col("rate") * (1 - F.col("rate")) / F.col("labelled"))
    apart = node.join(parent, ["host", "depth", "above"]).filter(differs).select("host", "depth", "branch")
    deepest = deep.join(apart, ["host", "depth", "branch"]).groupBy("host", "t").agg(F.max(F.struct("depth", "branch")).alias("own"))
    return leaf.join(deepest, ["host", "t"], "left").select("host", "t", "labelled", "bad", F.coalesce("own.depth", F.lit(0)).alias("depth"), F.coalesce("own.branch", F.lit("")).alias("branch"))


def filter_urls(pages: DataFrame, rules=RULES, labels: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, template, purity for every page row.

    labels (page_id, bad 0/1) replaces the rules' verdicts as labels. Null urls have an empty host and path and the
    template of those; urls of any length and depth are used whole. Repeated pages count as often as they come, and null
    page_ids stay; of rules of one length the one of the greater text wins. No labels at all: nothing is rejected by
    template. An empty table gives no rows. Columns beside page_id and url are not read, so none can clash.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn("hit", rule_for(F.col("host"), F.col("path"), rules))
    rows = rows.select("page_id", "host", "path", F.col("hit.rule").alias("rule"), F.col("hit.verdict").alias("ruled"))
    rows = rows.withColumn("g", F.array_join(F.transform(F.split(F.regexp_replace("path", "^/", ""), "/"), shape), "/"))
    if labels is None:
        rows = rows.withColumn("bad", F.when(F.col("ruled") == "block", 1).when(F.col("ruled") == "allow", 0))
    else:
        rows = rows.join(labels.groupBy("page_id").agg(F.max("bad").cast("int").alias("bad")), "page_id", "left")
    counted = materialise(rows.groupBy("host", "g").agg(F.count("*").alias("n"), F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")), "shapes")
    tree = templates(counted)
    leaf = branches(materialise(tree.groupBy("host", "t").agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad")), "leaves"))
    leaf = materialise(leaf, "leaves")
    pool = leaf.groupBy("host", "depth", "branch").agg(F.sum("labelled").alias("b_labelled"), F.sum("bad").alias("b_bad"))
    all_labels = counted.agg(F.sum("bad").alias("x"), F.sum("labelled").alias("y")).first()
    prior = all_labels["x"] / all_labels["y"] if all_labels["y"] else 0.5
    purity = (F.col("b_bad") + PRIOR_WEIGHT * prior) / (F.col("b_labelled") + PRIOR_WEIGHT)
    judged = leaf.join(pool, ["host", "depth", "branch"]).select("host", "t", purity.alias("purity"), (F.col("b_labelled") >= MIN_LABELS).alias("sure"))
    verdicts = tree.select("host", "g", "t").join(judged, ["host", "t"]).select("host", "g", F.concat("host", "t").alias("template"), "purity", "sure")
    verdict = F.coalesce("ruled", F.when(F.col("sure") & (F.col("purity") >= PURITY), "block").otherwise("allow"))
    return rows.join(verdicts, ["host", "g"]).select("page_id", "host", "path", "rule", verdict.alias("verdict"), "template", "purity")
