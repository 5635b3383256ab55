"""URL filters by declared rules and a path-template tree with labelled purity.

A url's path is cut into segments.  Segments that vary (numbers, long or hexadecimal words, or
rare ones among many siblings) become wildcards, level by level, so that paths of a host fall
into a tree of templates.  Sibling branches whose labelled share of bad pages does not differ
significantly from that of their siblings together are merged.  A template's share of bad pages
is smoothed towards its host's, and that towards the whole table's; above a threshold the
template is rejected.  A declared rule that fits a url decides before the tree; the longest wins.

Urls are reduced to distinct (host, template) with counts before anything is shuffled, so a host
with a third of all urls is a few rows; verdicts are joined back by host and template, where a
frequent key is split by the skew join.  All DataFrame expressions.

Defined results: a url that is null or has no "://" has an empty host and path, and is judged by
the template of these; segments below ``DEPTH`` are one wildcard; a null label is no label;
of rules of equal length the one later in the alphabet wins; very long urls are split whole;
repeated rows get equal results; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.session import materialize

DEPTH = 4
#: A segment with less than this share of its parent, among at least so many siblings, is variable.
RARE_SHARE, MANY_SIBLINGS = 0.02, 30
#: Branches differ when their shares of bad pages are so many standard errors apart.
SIGNIFICANT = 1.96
#: Weight of the prior in labelled pages, and the share of bad pages above which a template is rejected.
PRIOR, REJECT = 5.0, 0.5

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
VARIABLE = r"^(?:[0-9]+|[0-9a-f-]{12,}|.*[0-9].*|.{32,})$"


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return f"{self.host}{self.path}"


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"^(?s).*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(rest, F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s).*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: tuple[UrlRule, ...], field: str) -> Column:
    """The field of the longest rule that fits, or null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):  # the last one set wins
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        found = F.when(fits, F.lit(getattr(rule, field))).otherwise(found)
    return found


def _level(k: int) -> str:
    return f"t{k}"


def _first_template(path: Column) -> list[Column]:
    """The first segments with evident variables as wildcards; what lies deeper is one wildcard."""
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    stem = lambda s: F.regexp_replace(s, r"\.[A-Za-z]{2,5}$", "")
    cut = F.transform(segments, lambda s: F.when(stem(s).rlike(VARIABLE), F.lit("*")).otherwise(s))
    levels = [F.coalesce(F.get(cut, F.lit(k)), F.lit("")).alias(_level(k)) for k in range(DEPTH)]
    return [*levels, F.when(F.size(cut) > DEPTH, F.lit("**")).otherwise(F.lit("")).alias(_level(DEPTH))]


def templates(urls: DataFrame) -> DataFrame:
    """From host, path and bad (boolean or null): host, the first template g0.., the tree's template, share, rejected."""
    levels = [_level(k) for k in range(DEPTH + 1)]
    firsts = [f"g{k}" for k in range(DEPTH + 1)]
    reduced = urls.select("host", "bad", *_first_template(F.col("path"))).groupBy("host", *levels).agg(
        F.count(F.lit(1)).alias("n"), F.count("bad").alias("labelled"), F.count_if(F.col("bad")).alias("bad"))
    tree = materialize(reduced.select("*", *[F.col(t).alias(g) for t, g in zip(levels, firsts)]), "templates")
    for k in range(DEPTH):  # rare ones among many siblings
        parent = ["host", *levels[:k]]
        children = tree.groupBy(*parent, levels[k]).agg(F.sum("n").alias("_n"))
        counted = children.groupBy(*parent).agg(F.sum("_n").alias("_all"), F.count(F.lit(1)).alias("_siblings"))
        rare = children.join(counted, parent).where(
            (F.col("_siblings") >= MANY_SIBLINGS) & (F.col("_n") < RARE_SHARE * F.col("_all")) & (F.col(levels[k]) != "")
        ).select(*parent, levels[k], F.lit(True).alias("_rare"))
        tree = tree.join(rare, [*parent, levels[k]], "left").withColumn(
            levels[k], F.when(F.col("_rare"), F.lit("*")).otherwise(F.col(levels[k]))).drop("_rare")
        tree = materialize(tree, "templates")
    for k in range(DEPTH):  # branches that don't differ from their siblings
        parent = ["host", *levels[:k]]
        children = tree.groupBy(*parent, levels[k]).agg(F.sum("labelled").alias("_labelled"), F.sum("bad").alias("_bad"))
        pooled = children.groupBy(*parent).agg(F.sum("_labelled").alias("_sum_labelled"), F.sum("_bad").alias("_sum_bad"), F.count(F.lit(1)).alias("_k"))
        others, rate = F.col("_sum_labelled") - F.col("_labelled"), F.col("_sum_bad") / F.col("_sum_labelled")
        gap = F.abs(F.col("_bad") / F.col("_labelled") - (F.col("_sum_bad") - F.col("_bad")) / others)
        error = F.sqrt(rate * (1 - rate) * (1 / F.col("_labelled") + 1 / others))
        differs = F.when((F.col("_labelled") > 0) & (others > 0), gap > SIGNIFICANT * error).otherwise(F.lit(False))
        merged = children.join(pooled, parent).where((F.col("_k") > 1) & (F.col(levels[k]) != "") & ~differs).select(
            *parent, levels[k], F.lit(True).alias("_merged"))
        tree = tree.join(merged, [*parent, levels[k]], "left").withColumn(
            levels[k], F.when(F.col("_merged"), F.lit("~")).otherwise(F.col(levels[k]))).drop("_merged")
        tree = materialize(tree, "templates")
    whole = tree.agg(F.sum("labelled").alias("_all_labelled"), F.sum("bad").alias("_all_bad"))  # one row
    hosts = tree.groupBy("host").agg(F.sum("labelled").alias("_host_labelled"), F.sum("bad").alias("_host_bad"))
    leaves = tree.groupBy("host", *levels).agg(F.sum("labelled").alias("_leaf_labelled"), F.sum("bad").alias("_leaf_bad"))
    base = F.when(F.col("_all_labelled") > 0, F.col("_all_bad") / F.col("_all_labelled")).otherwise(F.lit(0.0))
    host_share = (F.col("_host_bad") + PRIOR * F.col("_base")) / (F.col("_host_labelled") + PRIOR)
    share = (F.col("_leaf_bad") + PRIOR * F.col("_host")) / (F.col("_leaf_labelled") + PRIOR)
    smoothed = hosts.join(F.broadcast(whole)).withColumn("_base", base).withColumn("_host", host_share).select("host", "_host")
    judged = leaves.join(smoothed, "host").select("host", *levels, share.alias("bad_share"))
    return tree.join(judged, ["host", *levels]).select(
        "host", *firsts, F.concat(F.lit("/"), F.array_join(F.filter(F.array(*levels), lambda t: t != ""), "/")).alias("template"),
        "bad_share", (F.col("bad_share") > REJECT).alias("rejected"))


def judge(pages: DataFrame, rules: tuple[UrlRule, ...], id_col: str = "page_id", url_col: str = "url",
          bad_col: str = "bad") -> DataFrame:
    """Rows id, host, path, rule, verdict, template, bad_share: one for each row of pages."""
    urls = pages.select(F.col(id_col).alias("_id"), F.col(bad_col).cast("boolean").alias("bad"),
                        host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    known = templates(urls)
    firsts = [f"g{k}" for k in range(DEPTH + 1)]
    named = [c.alias(g) for c, g in zip(_first_template(F.col("path")), firsts)]
    joined = urls.select("_id", "host", "path", *named).join(known, ["host", *firsts], "left")
    host, path = F.col("host"), F.col("path")
    return joined.select(
        F.col("_id").alias(id_col), "host", "path", rule_for(host, path, rules, "name").alias("rule"),
        F.coalesce(rule_for(host, path, rules, "verdict"), F.when(F.col("rejected"), "block").otherwise("allow")).alias("verdict"),
        "template", "bad_share",
    )
