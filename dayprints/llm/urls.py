"""URL rules by a sort-merge sweep over canonical keys.

A key is the host with its labels reversed, then the path. A rule's path prefix is an interval of
keys: all that start with it. Rules and addresses are merged in key order per host; nested rules
are a stack, which each rule carries (its prefixes that are rules too). The last rule before an
address holds every rule that can enclose it, and the deepest one that does is the host's match.
A subdomain is judged at each of its parent domains that has rules; the longest match wins.

Only DataFrame functions are used. A host with many addresses is swept in several lanes, to each
of which its rules are repeated, so no host is sorted in one task.

Null or relative URLs have empty host and path and match nothing. Repeated rows are kept, extra
columns of the pages are ignored. Rules with a null field are ignored; of equal rules that
disagree, the verdict that sorts last wins. Without rules every page gets the default.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayprints.session import measured

LANE_ROWS = 200_000


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased and path, both '' for null or a url without ://."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    raw = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    host = F.translate(raw, ascii_uppercase, ascii_lowercase)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _reversed(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.")), ".")


def _domains(host: Column) -> Column:
    """Reversed keys of the host and of every parent domain."""
    labels = F.reverse(F.split(host, r"\."))
    return F.transform(F.sequence(F.lit(1), F.size(labels)),
                       lambda n: F.array_join(F.slice(labels, 1, n), "."))


def _stacks(rules: DataFrame) -> DataFrame:
    """Each rule with the rules that enclose it and itself, the shortest first."""
    clean = rules.select(
        _reversed(F.translate("host", ascii_uppercase, ascii_lowercase)).alias("domain"),
        F.col("path").alias("path"), F.concat("host", "path").alias("rule"), "verdict").dropna()
    clean = clean.groupBy("domain", "path").agg(
        F.max(F.struct("verdict", "rule")).alias("best")).select(
        "domain", "path", F.struct(F.length("path").alias("size"), F.col("path").alias("path"),
                                   F.col("best.rule").alias("rule"),
                                   F.col("best.verdict").alias("verdict")).alias("own"))
    prefixes = clean.select("domain", F.col("path").alias("start"), F.explode(
        F.transform(F.sequence(F.lit(0), F.length("path")),
                    lambda n: F.substring(F.col("path"), F.lit(1), n))).alias("path"))
    return (prefixes.join(clean, ["domain", "path"]).groupBy("domain", "start")
            .agg(F.array_sort(F.collect_list("own")).alias("stack"))
            .withColumnRenamed("start", "path"))


def matches(addresses: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, verdict) of the distinct addresses that a rule fits."""
    stacks = measured(_stacks(rules))  # its size is known: addresses stay where they are
    probes = addresses.select("host", "path", F.explode(_domains(F.col("host"))).alias("domain"))
    probes = probes.join(stacks.select("domain"), "domain", "left_semi")
    lanes = measured(probes.groupBy("domain").agg(
        F.ceil(F.count(F.lit(1)) / LANE_ROWS).cast("int").alias("lanes")))
    own = stacks.join(lanes, "domain").select(
        "domain", "path", F.lit(None).cast("string").alias("host"), "stack",
        F.explode(F.sequence(F.lit(0), F.col("lanes") - 1)).alias("lane"))
    seen = probes.join(lanes, "domain").select(
        "domain", "path", "host", F.lit(None).cast(stacks.schema["stack"].dataType).alias("stack"),
        F.pmod(F.xxhash64("host", "path"), F.col("lanes")).cast("int").alias("lane"))
    sweep = (Window.partitionBy("domain", "lane").orderBy("path", F.col("host").isNotNull())
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    swept = own.unionByName(seen).withColumn("stack", F.last("stack", ignorenulls=True).over(sweep))
    around = F.filter("stack", lambda r: F.col("path").startswith(r["path"]))
    hit = F.try_element_at(around, F.lit(-1))
    found = swept.where("host is not null").select("host", "path", hit.alias("hit"))
    longest = F.max(F.struct(F.length("hit.rule").alias("size"), F.length("hit.rule") -
                             F.col("hit.size"), F.col("hit.rule").alias("rule"),
                             F.col("hit.verdict").alias("verdict"))).alias("best")
    return (found.where("hit is not null").groupBy("host", "path").agg(longest)
            .select("host", "path", "best.rule", "best.verdict"))


def judge(pages: DataFrame, rules: DataFrame, page_id: str = "page_id", url: str = "url",
          default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of ``pages``.

    ``rules`` has host, path, verdict. ``rule`` is null where none fits; the verdict is then
    ``default``.
    """
    host, path = host_and_path(F.col(url))
    rows = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    found = matches(rows.select("host", "path").distinct(), rules)
    return rows.join(found, ["host", "path"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
