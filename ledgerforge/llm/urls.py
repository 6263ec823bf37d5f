"""URL filters: reversed-host keys, rule intervals, and a sorted sweep over nested rules.

A host becomes its labels in reverse order, each followed by a dot: `www.example.net` is
`net.example.www.`. All subdomains of a rule's host then lie in one interval of keys, from the
rule's own key up to that key with its last dot replaced by the next character. Intervals of two rules are nested or
apart. At the start and the end of each interval the stack of open rules is written down once;
a sweep over boundaries and hosts in key order gives each host the latest stack before it, and the host's urls take
from that stack the longest rule whose path begins theirs.

The sweep sees each distinct host once. Hosts are dealt over buckets by hash and the boundaries,
a bounded table (MOST_RULES, checked), are repeated in each bucket, so no domain is a hot key.
Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerforge.llm.columns import free_name
from ledgerforge.sources.staging import Staging

MOST_RULES = 100_000
HOSTS_PER_BUCKET = 1_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def url_host(url: Column) -> Column:
    """What stands between the first `://` and `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end; empty without `://`."""
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def _boundaries(rules: DataFrame) -> DataFrame:
    """(key, stack): the rules that are open from this key on, at each interval's start and end."""
    by_key = rules.groupBy(host_key(F.col("host")).alias("start")).agg(
        F.collect_set(F.struct("rule", "path", "action")).alias("own")
    )
    # The rules around an interval are those of its key's ancestors, found by equality.
    labels = F.split("start", r"\.", -1)
    around = by_key.select("start", labels.alias("labels"), (F.size(labels) - 1).alias("depth"))
    around = around.withColumn("n", F.explode(F.sequence(F.lit(1), F.col("depth"))))
    above = F.concat(F.array_join(F.slice("labels", F.lit(1), F.col("n")), "."), F.lit("."))
    stacks = (
        around.withColumn("above", above)
        .join(by_key.withColumnRenamed("start", "above"), "above")
        .groupBy("start")
        .agg(
            F.flatten(F.collect_list("own")).alias("opened"),
            F.flatten(F.collect_list(F.when(F.col("n") < F.col("depth"), F.col("own")))).alias("left_open"),
        )
    )
    after = F.concat(F.expr("substring(start, 1, char_length(start) - 1)"), F.lit("/"))  # "/" follows "."
    events = F.array(
        F.struct(F.col("start").alias("key"), F.col("opened").alias("stack")),
        F.struct(after.alias("key"), F.col("left_open").alias("stack")),
    )
    return stacks.select(F.inline(events))


def host_stacks(hosts: DataFrame, rules: DataFrame, buckets: int) -> DataFrame:
    """(host, stack) for the distinct hosts that lie inside some rule's interval."""
    points = hosts.select(
        F.pmod(F.xxhash64("host"), F.lit(buckets)).cast("int").alias("bucket"),
        host_key(F.col("host")).alias("key"),
        F.lit(1).alias("turn"),
        "host",
    )
    events = _boundaries(rules).select(
        F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket"), "key", F.lit(0).alias("turn"), "stack"
    )
    sweep = Window.partitionBy("bucket").orderBy("key", "turn").rowsBetween(Window.unboundedPreceding, 0)
    swept = points.unionByName(events, allowMissingColumns=True).withColumn(
        "stack", F.last("stack", ignorenulls=True).over(sweep)
    )
    return swept.filter("turn = 1 and size(stack) > 0").select("host", "stack")


def judge_urls(urls: DataFrame, rules: DataFrame, *, url="url", default="allow") -> DataFrame:
    """`urls` with host, path, rule and verdict (columns of these names are replaced).

    `rules` has host, path and action (`allow` or `block`). A rule fits its host and all
    subdomains if the url's path begins with the rule's; the longest host and path wins, of equally long ones a block,
    then the greater text. Rules with a null are left out, repeated rules count once. A url that
    is null, empty or lacks `://` has an empty host and path. No fitting rule: rule is null and the
    verdict is `default`. No row is dropped.
    """
    spark, columns = urls.sparkSession, urls.columns
    rules = rules.dropna(subset=["host", "path", "action"]).select(
        F.translate("host", UPPER, LOWER).alias("host"), "path", "action"
    )
    rules = rules.withColumn("rule", F.concat("host", "path")).distinct()
    if rules.limit(MOST_RULES + 1).count() > MOST_RULES:
        raise ValueError(f"More than {MOST_RULES} rules; split them by top-level domain.")
    own = {name: free_name(columns, f"_{name}") for name in ("host", "path", "stack", "best")}
    parsed = urls.withColumn(own["host"], url_host(F.col(url))).withColumn(own["path"], url_path(F.col(url)))
    hosts = parsed.select(F.col(own["host"]).alias("host")).distinct()
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Written, so that the join below has two plain sides and Spark may split a hot host.
    stacks = Staging(spark, "urls").keep(host_stacks(hosts, rules, buckets), "stacks")
    joined = parsed.join(
        stacks.select(F.col("host").alias(own["host"]), F.col("stack").alias(own["stack"])), own["host"], "left"
    )
    fitting = F.filter(own["stack"], lambda r: F.startswith(F.col(own["path"]), r["path"]))
    ranked = F.transform(
        fitting,
        lambda r: F.struct(
            F.char_length(r["rule"]).alias("size"), (r["action"] == "block").alias("block"), r["rule"], r["action"]
        ),
    )
    best = F.array_max(ranked)
    results = {
        "host": F.col(own["host"]),
        "path": F.col(own["path"]),
        "rule": F.col(own["best"])["rule"],
        "verdict": F.coalesce(F.col(own["best"])["action"], F.lit(default)),
    }
    kept = [F.col(name) for name in columns if name.lower() not in results]
    return joined.withColumn(own["best"], best).select(*kept, *[c.alias(name) for name, c in results.items()])
