"""URL filters [op 5]: a sort-merge range join of urls with nested rules, swept in key order.

A host's canonical key is its labels in reverse, each followed by a dot (``www.example.net`` gives
``net.example.www.``). A rule's host then is the interval of keys that begin with its own key: it opens at
``net.example.`` and closes at ``net.example/``, since ``/`` follows ``.``. Intervals nest or are disjoint.
Where an interval opens or closes, the stack of active rules changes; each event carries the whole stack
from there on. Urls and events are dealt into ranges of keys, sorted, and swept: every url takes the stack
of the last event before it, and of that stack the longest rule whose path begins its own.

Ranges are cut at quantiles of a bounded sample of keys. A key that fills several ranges (a hot host) is
dealt over all of them, and each of those ranges is given the stack that is active at its lower end, so no
key is held by one task. The stack of a host holds the rules of the host and of its parents in one row;
rule sets are expected to have at most some thousands of rules per host.

Defined results: a NULL url, or one without ``://``, has an empty host and path and gets the default
verdict. Empty tables of urls or rules are fine. Equal urls are judged alike; every row is returned. Rules
that are equal in host and path: block wins. Other columns of the input are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import below, let, partitions_for, smallest_hashes

# Keys of the sample that ranges are cut at.
SAMPLE_KEYS = 4096
# A sampled key is cut to whole labels within so many characters: a prefix is as good a cut.
SAMPLE_KEY_CHARS = 200
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for NULL or a text without ``://``."""
    rest = F.when(
        F.coalesce(F.instr(url, "://"), F.lit(0)) > 0, F.regexp_replace(url, r"(?s)\A.*?://", "")
    ).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"\A[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    return host, path


def host_key(host: Column) -> Column:
    return F.concat(F.concat_ws(".", F.reverse(F.split(host, r"\."))), F.lit("."))


def judge(urls: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``urls`` (page_id, url) with host, path, rule and verdict; ``rules`` has host, path, verdict."""
    spark = urls.sparkSession
    host, path = host_and_path(F.col("url"))
    keyed = urls.select("page_id", host.alias("host"), path.alias("path")).withColumn("key", host_key(F.col("host")))
    stacks = _stacks(rules)
    bounds = _bounds(keyed, partitions_for(spark))
    events = _events(stacks, bounds)
    low, high = below(bounds, F.col("key"), inclusive=False), below(bounds, F.col("key"), inclusive=True)
    dealt = keyed.select(
        "*", low.alias("low"), high.alias("high")
    ).select(
        (F.col("low") + F.pmod(F.xxhash64("page_id", "path"), F.col("high") - F.col("low") + 1)).cast("int").alias("block"),
        "key",
        F.lit(1).alias("kind"),
        F.lit(None).cast(events.schema["stack"].dataType).alias("stack"),
        "page_id",
        "host",
        "path",
    )
    none = [F.lit(None).cast(keyed.schema[c].dataType).alias(c) for c in ("page_id", "host", "path")]
    both = dealt.unionByName(events.select("block", "key", F.lit(0).alias("kind"), "stack", *none))
    in_order = Window.partitionBy("block").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    swept = both.withColumn("active", F.last("stack", ignorenulls=True).over(in_order)).filter("kind = 1")
    fitting = F.filter("active", lambda r: F.startswith(F.col("path"), r["path"]))
    best = swept.withColumn("best", F.array_max(F.transform(fitting, lambda r: F.struct(
        F.length(r["rule"]).alias("n"), r["host"].alias("h"), (r["verdict"] == "block").alias("b"),
        r["rule"].alias("rule"), r["verdict"].alias("verdict"),
    ))))
    return best.select(
        "page_id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )


def _prefix_keys(key: Column) -> Column:
    """All host keys that ``key`` begins with, itself included."""
    labels = F.split(F.regexp_replace(key, r"\.\z", ""), r"\.")
    return let(
        labels,
        lambda x: F.transform(
            F.sequence(F.lit(1), F.size(x)), lambda i: F.concat(F.concat_ws(".", F.slice(x, 1, i)), F.lit("."))
        ),
    )


def _stacks(rules: DataFrame) -> DataFrame:
    """For each host with rules: its key, the stack of its own and its parents' rules, and its parents' stack."""
    own = rules.select(
        host_key(F.col("host")).alias("key"),
        F.struct("host", "path", F.concat("host", "path").alias("rule"), "verdict").alias("rule"),
    )
    hosts = own.select("key").distinct().select("key", F.explode(_prefix_keys(F.col("key"))).alias("prefix"))
    found = hosts.join(own.withColumnRenamed("key", "prefix"), "prefix")
    above = F.when(F.col("prefix") != F.col("key"), F.col("rule"))
    return found.groupBy("key").agg(F.collect_list("rule").alias("stack"), F.collect_list(above).alias("parents"))


def _bounds(keyed: DataFrame, blocks: int) -> list[str]:
    """Quantiles of a bounded sample of keys: rows with the smallest hashes."""
    rows = keyed.select(
        F.regexp_replace(F.substring("key", 1, SAMPLE_KEY_CHARS), r"[^.]*\z", "").alias("key"),
        F.xxhash64("page_id", "path").alias("h"),
    )
    sample = smallest_hashes(rows, [F.col("h")], SAMPLE_KEYS, keyed.count()).collect()
    keys = sorted((r["key"] for r in sample), key=lambda k: k.encode())
    return [keys[len(keys) * i // blocks] for i in range(1, blocks)] if keys else []


def _events(stacks: DataFrame, bounds: list[str]) -> DataFrame:
    """Changes of the stack in every range they fall into, and the stack at each range's lower end."""
    spark = stacks.sparkSession
    upper = F.concat(F.regexp_replace("key", r"\.\z", ""), F.lit("/"))
    changes = stacks.select("key", "stack").unionByName(stacks.select(upper.alias("key"), F.col("parents").alias("stack")))
    low, high = below(bounds, F.col("key"), inclusive=False), below(bounds, F.col("key"), inclusive=True)
    placed = changes.select(F.explode(F.sequence(low, high)).alias("block"), "key", "stack")
    if not bounds:
        return placed
    starts = spark.createDataFrame([(i + 1, b) for i, b in enumerate(bounds)], "block int, key string")
    prefixes = starts.select("block", F.col("key").alias("start"), F.explode(_prefix_keys(F.col("key"))).alias("key"))
    begun = prefixes.join(stacks.select("key", "stack"), "key").groupBy("block", F.col("start").alias("key")).agg(
        F.max_by("stack", F.length("key")).alias("stack")
    )
    empty = F.array().cast(stacks.schema["stack"].dataType)
    first = starts.join(begun, ["block", "key"], "left").select("block", "key", F.coalesce("stack", empty).alias("stack"))
    return placed.unionByName(first)
