"""URL filters as a sort-merge range join, with DataFrame functions only.

A rule (host, path, verdict) covers its host and every subdomain, for paths that start with the rule's path. Host
labels are reversed and each closed with a comma ("www.example.net" -> "net,example,www,"), so the hosts of a rule
are the keys that start with the rule's own key: the interval from key to key + U+10FFFF. Rules with the same path
form one sweep group; intervals of a group nest or are disjoint. The event at an interval's start says that this
rule is on top, the event at its end says which enclosing rule is on top again: the stack of active nested rules,
written out at each event. URLs and events are range-partitioned by (group, key) and sorted together; the last event
before a URL holds its rule, and a partition begins with the last event of the partitions before it. The row number
is the last part of the sort key, so a host that holds a third of all rows spreads over many partitions.

Longest wins: the rule with most characters in host and path together, then the longer host. Of equal rules with
two verdicts, block wins. A null URL or one without "://" has an empty host and path and fits no rule; where no rule
fits, the default verdict holds. Repeated page ids are separate rows. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions, written

#: Rules of the registered query: (host, path, verdict).
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
         ("org", "/fr/", "allow"))
DEFAULT = "allow"
#: Sorts after every text that continues a key.
_END = "\U0010ffff"


def rules_table(spark: SparkSession, rules=RULES) -> DataFrame:
    """A short list of (host, path, verdict) as a table."""
    return spark.range(1).select(F.inline(F.array(*[F.struct(
        F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in rules])))


def _lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(","))


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL; both empty without '://'."""
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce(url, F.lit(""))
    return _lower_ascii(F.regexp_extract(url, parts, 1)), F.regexp_extract(url, parts, 2)


def _rules(rules: DataFrame) -> DataFrame:
    """(grp, key, top) per distinct rule; the group of a rule path is the path behind '=', and '' has no rules."""
    return (rules.select(_lower_ascii(F.trim("host")).alias("host"), F.coalesce("path", F.lit("")).alias("path"),
                         F.lower("verdict").alias("verdict"))
            .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
            .select(F.concat(F.lit("="), "path").alias("grp"), _host_key(F.col("host")).alias("key"),
                    F.struct((F.length("host") + F.length("path")).alias("size"), F.length("host").alias("host_size"),
                             F.concat("host", "path").alias("rule"), "verdict").alias("top")))


def _stack_events(r: DataFrame) -> DataFrame:
    """(grp, key, state): from this key on, state.top is the innermost active rule, null for none."""
    # The rules around a rule stand at the label prefixes of its key: an equi-join finds the nearest.
    inner = (r.withColumn("n", F.explode(F.sequence(F.lit(1), F.size(F.split("key", ",")) - 1)))
             .select("grp", F.col("key").alias("own"), F.expr("concat(substring_index(key, ',', n), ',')").alias("key"))
             .filter("own <> key"))
    around = (inner.join(r, ["grp", "key"]).groupBy("grp", "own").agg(F.max_by("top", F.length("key")).alias("up"))
              .withColumnRenamed("own", "key"))
    ends = r.join(around, ["grp", "key"], "left").select("grp", F.concat("key", F.lit(_END)).alias("key"),
                                                         F.col("up").alias("top"))
    return r.unionByName(ends).select("grp", "key", F.struct("top").alias("state"))


def url_verdicts(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url",
                 default: str = DEFAULT) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict."""
    host, path = split_url(F.col(url))
    rows = pages.select(F.col(key).alias("page_id"), F.monotonically_increasing_id().alias("row"),
                        host.alias("host"), path.alias("path"))
    parts = shuffle_partitions(pages.sparkSession)
    r = _rules(rules)
    events = _stack_events(r)
    # A URL takes part in the sweep of every rule path that its own path starts with: an equi-join on its prefixes
    # of the lengths that occur. Group '' has no rules and carries every URL through.
    groups = r.select("grp").distinct().unionByName(pages.sparkSession.sql("SELECT '' AS grp"))
    sizes = groups.agg(F.collect_set(F.length("grp")).alias("sizes")).first()["sizes"]
    marked = F.concat(F.lit("="), "path")
    prefixes = F.filter(F.array(*[F.lit(n) for n in sorted(sizes)]), lambda n: n <= F.length(marked))
    points = (rows.withColumn("n", F.explode(prefixes)).withColumn("grp", F.expr("substring(concat('=', path), 1, n)"))
              .join(groups, "grp")
              .select("grp", _host_key(F.col("host")).alias("key"), "row", "page_id", "host", "path",
                      F.lit(None).cast(events.schema["state"].dataType).alias("state"))
              .unionByName(events.withColumn("row", F.lit(-1).cast("bigint")), allowMissingColumns=True))
    swept = written(points.repartitionByRange(parts, "grp", "key", "row")
                    .withColumn("part", F.spark_partition_id()), "url-sweep")
    # One row per partition: the last event before it.
    last = swept.filter("row = -1").groupBy("part").agg(F.max_by("state", F.struct("grp", "key")).alias("state"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = (swept.select("part").distinct().join(last, "part", "left")
              .withColumn("state", F.last("state", ignorenulls=True).over(before))
              .select("part", "state", F.lit("").alias("grp"), F.lit("").alias("key"), F.lit(-2).cast("bigint").alias("row")))
    sweep = Window.partitionBy("part").orderBy("grp", "key", "row").rowsBetween(Window.unboundedPreceding, 0)
    found = (swept.unionByName(begins, allowMissingColumns=True)
             .withColumn("top", F.last("state", ignorenulls=True).over(sweep)["top"])
             .filter("row >= 0")
             .groupBy("row", "page_id", "host", "path").agg(F.max("top").alias("top")))
    return found.select("page_id", "host", "path", F.col("top.rule").alias("rule"),
                        F.coalesce("top.verdict", F.lit(default)).alias("verdict"))
