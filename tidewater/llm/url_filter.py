"""Operator 1, URL filters: path-template tree, in DataFrame functions only.

Urls are judged by rules (host and path prefix; the longest that fits wins).
The urls that a rule decides are the labels from which the tree learns to judge
the others of their host:

- Per host, paths are walked segment by segment. At a node, a segment is
  variable when it looks like an identifier, or when its node has many
  children, few urls take this one, and they aren't known to differ from its
  siblings' (fewer than TELLING labels, or urls, can't tell); it becomes a
  wildcard.
- Literal branches of a node with three children or more are merged into one
  wildcard branch when they are statistically similar to their pooled siblings:
  neither the share of blocked labels nor the share of urls whose next segment
  is an identifier differs (two-proportion z below ``z_merge``).
- A node's purity is its share of blocked labels, smoothed towards its
  parent's: (blocked + weight x parent) / (labelled + weight), from all urls
  over the domain (last two labels of the host) and the host down the template.
  A template whose purity reaches ``reject`` is rejected and its urls blocked.

Paths are walked to their last segment, whatever the depth. What all urls of a
node share is taken in one step (their least and greatest paths agree on it), so
the number of rounds is that of the branchings on a path. The tree works on
distinct (host, path) pairs with their counts, so repeated urls cost nothing;
each round writes its tables to the shared folder. Large hosts are split by the
skew handling of the joins; sums are pre-aggregated before each shuffle.

Defined cases: a null url, or one without ``://``, has an empty host and path,
fits no rule and gets the purity of all urls; empty tables give an empty
result; repeated rows are judged alike; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence, Tuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, saved

#: (verdict, rule): host up to the first slash, path from it on.
Rules = Sequence[Tuple[str, str]]
IDENTIFIER = r"^[0-9]+(\.[A-Za-z0-9]+)?$|[0-9].*[0-9].*[0-9]|^[0-9a-fA-F-]{8,}$|^.{40,}$"
MANY, FEW = 20, 0.02
#: Least labels, or urls, of a rare branch whose difference from its siblings counts.
TELLING = 5


def url_parts(url: Column) -> Tuple[Column, Column]:
    """Host and path: host after the first :// up to / ? # or the end, A-Z
    lower-cased; path from there up to ? # or the end."""
    text = F.coalesce(url, F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise("")
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    return ascii_lower(host), F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Rules) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null."""
    found = []
    for verdict, rule in sorted(rules, key=lambda r: -len(r[1])):
        at = rule.index("/")
        own = (host == rule[:at]) | host.endswith("." + rule[:at])
        found.append(F.when(own & path.startswith(rule[at:]), F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.coalesce(*found) if found else F.lit(None).cast("struct<rule:string,verdict:string>")


def _different(hits1: Column, n1: Column, hits: Column, n: Column) -> Column:
    """z of the shares hits1 / n1 and the rest of hits / n, one trial at the common share added to each."""
    p = (hits + 0.5) / (n + 1)
    p1, p2 = (hits1 + p) / (n1 + 1), (hits - hits1 + p) / (n - n1 + 1)
    return F.abs(p1 - p2) / F.sqrt(p * (1 - p) * (1 / (n1 + 1) + 1 / (n - n1 + 1)))


def _purity(state: DataFrame, keys: Sequence[str], weight: float) -> DataFrame:
    """``state`` with its purity renewed from the sums over ``keys``, smoothed towards the one it has."""
    sums = state.groupBy(*keys).agg(F.sum("labelled").alias("l"), F.sum("blocked").alias("b"))
    joined = state.join(sums, list(keys))
    return joined.withColumn("purity", (F.col("b") + weight * F.col("purity")) / (F.col("l") + weight)).drop("l", "b")


def path_templates(urls: DataFrame, z_merge: float = 1.96, weight: float = 4.0) -> DataFrame:
    """Saved (host, path, template, purity) of the distinct pairs in ``urls``
    (host, path, label: 1 blocked, 0 allowed, null unknown)."""
    seen = urls.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.count("label").alias("labelled"), F.coalesce(F.sum("label"), F.lit(0)).alias("blocked"))
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    named = F.transform(segments, lambda s: F.when(s.rlike(IDENTIFIER), "*").otherwise(s))
    state = saved(seen.select("host", "path", "n", "labelled", "blocked", named.alias("segments"), F.lit(0).alias("at"), F.lit("").alias("template")), "urls")
    labelled, blocked = state.agg(F.coalesce(F.sum("labelled"), F.lit(0)), F.coalesce(F.sum("blocked"), F.lit(0))).first()
    state = state.withColumn("purity", F.lit((blocked + 1.0) / (labelled + 2.0)))
    state = state.withColumn("domain", F.regexp_extract("host", r"([^.]*\.[^.]*)$|^([^.]*)$", 0))
    state = saved(_purity(_purity(state, ["domain"], weight), ["host"], weight).drop("domain"), "hosts")
    node, ended = ["host", "template"], F.col("at") >= F.size("segments")
    done, level = [state.filter(ended)], 0
    active = state.filter(~ended)
    while not active.isEmpty():
        level += 1
        # Segments that all urls of a node share: one step, however many they are.
        rest = F.slice("segments", F.col("at") + 1, F.size("segments"))
        sums = active.groupBy(*node).agg(F.sum("labelled").alias("l"), F.sum("blocked").alias("b"), F.min(rest).alias("lo"), F.max(rest).alias("hi"))
        first_other = F.array_position(F.zip_with("lo", "hi", lambda x, y: x.eqNullSafe(y)), False)
        sums = sums.select(*node, "l", "b", F.when(first_other > 0, first_other - 1).otherwise(F.size("lo")).cast("int").alias("k"))
        active = active.join(sums, node)
        # The smoothing towards the parent, k times with the same sums.
        share = F.col("b") / F.col("l")
        purity = F.when((F.col("k") == 0) | (F.col("l") == 0), F.col("purity")).otherwise(share + (F.col("purity") - share) * F.pow(weight / (F.col("l") + weight), F.col("k")))
        template = F.when(F.col("k") > 0, F.concat("template", F.lit("/"), F.array_join(F.slice("segments", F.col("at") + 1, F.col("k")), "/"))).otherwise(F.col("template"))
        active = active.withColumns({"purity": purity, "template": template}).withColumn("at", F.col("at") + F.col("k")).drop("l", "b", "k")
        active = saved(active, f"shared-{level}")
        done.append(active.filter(ended))
        active = active.filter(~ended)

        following = F.get("segments", F.col("at") + 1) == "*"
        active = active.withColumns({"branch": F.get("segments", F.col("at")), "next": F.when(F.coalesce(following, F.lit(False)), F.col("n")).otherwise(0)})
        branches = active.groupBy(*node, "branch").agg(*[F.sum(c).alias(c) for c in ("n", "labelled", "blocked", "next")])
        parents = branches.groupBy(*node).agg(F.count(F.lit(1)).alias("kids"), *[F.sum(c).alias(f"all_{c}") for c in ("n", "labelled", "blocked", "next")])
        b = branches.join(parents, node)
        rare = (F.col("kids") > MANY) & (F.col("n") < FEW * F.col("all_n"))
        same_labels = _different(F.col("blocked"), F.col("labelled"), F.col("all_blocked"), F.col("all_labelled")) < z_merge
        same_next = _different(F.col("next"), F.col("n"), F.col("all_next"), F.col("all_n")) < z_merge
        alike = (F.col("kids") >= 3) & same_labels & same_next
        rare = rare & (same_labels | (F.col("labelled") < TELLING)) & (same_next | (F.col("n") < TELLING))
        b = b.select(*node, "branch", F.when(rare | alike, "*").otherwise(F.col("branch")).alias("as"))
        active = active.join(b, node + ["branch"]).withColumns({"template": F.concat("template", F.lit("/"), "as"), "at": F.col("at") + 1}).drop("branch", "next", "as")
        active = saved(_purity(active, node, weight), f"level-{level}")
        done.append(active.filter(ended))
        active = active.filter(~ended)
    return saved(reduce(DataFrame.unionByName, [x.select("host", "path", "template", "purity") for x in done]), "templates")


def judge_urls(pages: DataFrame, rules: Rules, reject: float = 0.5, id_col: str = "page_id", url_col: str = "url", **options) -> DataFrame:
    """page_id, host, path, rule, verdict, template, purity; one row per page."""
    host, path = url_parts(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("found", rule_of(F.col("host"), F.col("path"), rules))
    label = F.when(F.col("found.verdict") == "block", 1).when(F.col("found.verdict") == "allow", 0)
    templates = path_templates(rows.select("host", "path", label.alias("label")), **options)
    verdict = F.coalesce(F.col("found.verdict"), F.when(F.col("purity") >= reject, "block").otherwise("allow"))
    return rows.join(templates, ["host", "path"]).select("page_id", "host", "path", F.col("found.rule").alias("rule"), verdict.alias("verdict"), "template", "purity")
