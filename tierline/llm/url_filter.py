"""URL filters by path-template trees (SQL functions only).

Every host has a tree of path templates:

1. digit runs inside a segment become ``#`` (``148.html`` -> ``#.html``);
   the rows are then counted per (host, segments), so the hot host is a few
   rows from here on;
2. level by level, each node looks at its own children.  A child with
   ``min_support`` pages or more keeps its literal segment, however large the
   node is.  The smaller ones become one wildcard ``*`` if they vary:
   ``min_support`` of them at least, with two pages each or fewer on average;
   else they keep their literals, too.  Below a node of fewer than
   ``min_support`` pages nothing can be told, and the rest of the path is one
   ``**``.  The tree is as deep as paths that so many pages share;
3. sibling branches (same host, same template but for the first literal
   segment) are merged when their labels do not tell them apart: each labelled
   branch is tested against the blocked share p of all labelled pages (score
   test of a proportion, ``z`` standard errors), and is blocked more often, less
   often, or neither; branches without labels are a class of their own, so no
   page gets its verdict from a branch that differs;
4. a template is rejected when it has at least ``min_labels`` labelled pages
   and its smoothed purity ``(blocked + k * p) / (labelled + k)`` exceeds
   ``cutoff``.

Labels come from explicit rules: a rule fits its host and all subdomains if
the path starts with the rule's path, and the longest rule wins; and from a
label column, where there is one.  A page's own rule or label always stands;
the templates judge the others.

Defined results: a null url, or one without ``://``, has empty host and path
and is judged like any other page of the empty host (no rule fits it).
Repeated rows each get the verdict of their url.  Extra columns are dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import stable

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Rule = tuple[str, str, str]      # host suffix, path prefix, verdict


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def apply_rules(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Adds ``rule`` (host + path of the longest rule that fits, else null)
    and ``label`` (its verdict).  The rules are joined on the suffixes of the
    distinct hosts, so their number does not widen the plan."""
    spark = pages.sparkSession
    rows = spark.createDataFrame([(h, p, h + p, v) for h, p, v in rules],
                                 "r_host string, r_path string, rule string, label string")
    hosts = (pages.select("host").distinct()
             .withColumn("parts", F.split("host", r"\."))
             .withColumn("i", F.explode(F.sequence(F.lit(1), F.size("parts"))))
             .select("host", F.array_join(F.expr("slice(parts, i, size(parts))"), ".").alias("r_host")))
    fits = (hosts.join(rows, "r_host")
            .groupBy("host").agg(F.sort_array(F.collect_list(F.struct(
                (-F.length("rule")).alias("o"), "rule", "r_path", "label"))).alias("fits")))
    first = F.expr("get(filter(fits, r -> startswith(path, r.r_path)), 0)")
    return (pages.join(fits, "host", "left")
            .withColumn("best", first)
            .withColumn("rule", F.col("best.rule")).withColumn("label", F.col("best.label"))
            .drop("fits", "best"))


def segments(path: Column) -> Column:
    """The path's segments with digit runs as ``#``."""
    return F.split(F.regexp_replace(F.regexp_replace(path, "^/", ""), "[0-9]+", "#"), "/")


def template_tree(shapes: DataFrame, min_support: int) -> DataFrame:
    """``shapes`` (host, segs, n, n_lab, n_block) with ``tpl``, the generalised
    segments.  Per level two aggregates and two joins on counted rows, which run
    once: each level is checkpointed, and the result only puts together what is
    done at each, so that no plan holds more than one level."""
    here = stable(shapes.withColumn("tpl", F.array().cast("array<string>")).withColumn("thin", F.lit(False)))
    done, d = [], 0
    while True:
        ends = F.col("thin") | (F.size("segs") <= d)
        done.append(here.filter(ends).drop("thin"))
        active = here.filter(~ends).drop("thin").withColumn("seg", F.get("segs", F.lit(d)))
        if active.isEmpty():
            break
        child = active.groupBy("host", "tpl", "seg").agg(F.sum("n").alias("n_child"))
        small = F.col("n_child") < min_support
        node = child.groupBy("host", "tpl").agg(F.sum("n_child").alias("n_node"), F.count_if(small).alias("kinds"),
                                                F.coalesce(F.sum(F.when(small, F.col("n_child"))), F.lit(0)).alias("pages"))
        varies = (F.col("kinds") >= min_support) & (2 * F.col("kinds") >= F.col("pages"))
        rule = (child.join(node, ["host", "tpl"])
                .select("host", "tpl", "seg", (F.col("n_node") < min_support).alias("thin"),
                        F.when(F.col("n_node") < min_support, F.lit("**")).when(small & varies, F.lit("*")).otherwise(F.col("seg")).alias("to")))
        here = stable(active.join(rule, ["host", "tpl", "seg"]).withColumn("tpl", F.concat("tpl", F.array("to"))).drop("seg", "to"))
        d += 1
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return stable(out)


def merge_branches(tpls: DataFrame, prior: float, z: float) -> DataFrame:
    """(host, tpl, n_lab, n_block) -> (host, tpl, merged): siblings with alike
    labels share one merged template, named by its smallest member."""
    at = F.expr("array_position(transform(tpl, t -> t not in ('*', '**') and not contains(t, '#')), true)").cast("int")
    off = F.col("n_block") - F.col("n_lab") * F.lit(prior)
    clear = off * off >= F.lit(z * z * prior * (1 - prior)) * F.col("n_lab")
    kind = (F.when(F.col("n_lab") == 0, "unlabelled").when(clear & (off > 0), "more").when(clear & (off < 0), "less").otherwise("neither"))
    t = (tpls.withColumn("at", at).withColumn("kind", kind)
         .withColumn("around", F.expr("transform(tpl, (t, i) -> if(i + 1 = at, '|', t))")))
    names = t.groupBy("host", "around", "kind").agg(F.min(F.array_join("tpl", "/")).alias("merged"),
                                                    F.sum("n_lab").alias("m_lab"), F.sum("n_block").alias("m_block"))
    return t.join(names, ["host", "around", "kind"]).select("host", "tpl", "merged", "m_lab", "m_block")


def judge_urls(pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url", label_col: str | None = None,
               min_support: int = 5, z: float = 1.96, min_labels: int = 5, k: int = 5, cutoff: float = 0.6) -> DataFrame:
    """One row per page: ``id_col, host, path, rule, template, verdict``.
    ``label_col``: verdicts (``block``, ``allow`` or null) known beside the rules."""
    host, path = split_url(F.col(url_col))
    known = F.col(label_col) if label_col else F.lit(None).cast("string")
    p = apply_rules(pages.select(F.col(id_col), host.alias("host"), path.alias("path"), known.alias("known")), rules)
    p = stable(p.withColumn("label", F.coalesce("label", "known")).withColumn("segs", segments(F.col("path"))))
    shapes = p.groupBy("host", "segs").agg(F.count(F.lit(1)).alias("n"), F.count("label").alias("n_lab"),
                                           F.count_if(F.col("label") == "block").alias("n_block"))
    tree = template_tree(shapes, min_support)
    tpls = tree.groupBy("host", "tpl").agg(F.sum("n_lab").alias("n_lab"), F.sum("n_block").alias("n_block"))
    total = tree.agg(F.coalesce(F.sum("n_lab"), F.lit(0)).alias("t_lab"),
                     F.coalesce(F.sum("n_block"), F.lit(0)).alias("t_block")).first()   # two numbers
    prior = total["t_block"] / total["t_lab"] if total["t_lab"] else 0.0
    purity = (F.col("m_block") + k * prior) / (F.col("m_lab") + k)
    judged = merge_branches(tpls, prior, z).select("host", "tpl", F.col("merged").alias("template"),
                                                   ((F.col("m_lab") >= min_labels) & (purity > cutoff)).alias("reject"))
    by_shape = tree.select("host", "segs", "tpl").join(judged, ["host", "tpl"]).drop("tpl")
    verdict = F.coalesce("label", F.when(F.col("reject"), "block").otherwise("allow"))
    return (p.join(by_shape, ["host", "segs"])
            .select(id_col, "host", "path", "rule", "template", verdict.alias("verdict")))
