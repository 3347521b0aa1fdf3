"""URL filters with dated lists: what was listed when a page was fetched."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlens.llm.texts import unused

#: Length of a time bucket, in the unit of the times (seconds here: 30 days).
BUCKET = 30 * 86_400


#: Distinct listed patterns that are broadcast to pick the captures' keys; a longer list is
#: joined by a shuffle.
LISTED_PATTERNS = 500_000

ADDRESS = r"^(?:[0-9]{1,3}(?:[.][0-9]{1,3}){3}|\[.*)$"


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and final dot; empty if there is none.

    An IPv6 host keeps its brackets.
    """
    host = F.regexp_extract(
        F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:\[]+)", 1)
    return F.regexp_replace(host, r"[.]+$", "")


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def keys_of(url: Column, deepest: int | None = None) -> Column:
    """Every list pattern that covers a URL.

    Patterns are domains, which cover their subdomains, and a host with leading path
    segments, which covers what lies below. An address is one domain of its own. A URL
    without host has no keys. Each key repeats the segments before it; ``deepest``, the
    most segments that any listed pattern has, leaves out the keys that no list can hold,
    so that a URL of very many segments makes no quadratic text.
    """
    host = host_of(url)
    labels = F.split(host, "[.]")
    domains = F.when(F.rlike(host, F.lit(ADDRESS)), F.array(host)).otherwise(
        F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(
            F.slice(labels, i, F.size(labels)), ".")))
    segments = F.filter(F.split(path_of(url), "/"), lambda s: s != "")
    most = F.size(segments) if deepest is None else F.least(F.size(segments), F.lit(deepest))
    paths = F.transform(
        F.filter(F.sequence(F.lit(0), most), lambda i: i > 0),
        lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(segments, 1, i), "/")))
    keys = F.array_distinct(F.concat(domains, paths))
    return F.when(F.coalesce(host, F.lit("")) == "", F.array().cast("array<string>")).otherwise(keys)


def validity(feed: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Intervals (list_name, pattern, valid_from, valid_to) from dated list entries.

    ``feed`` has list_name, pattern, action (add or remove) and a numeric ``listed_at``. An entry
    holds from its ``add`` up to, not with, the next entry of the same list and pattern;
    ``valid_to`` is null when there is none. Of entries at one time a removal wins.
    Entries without list, pattern, time or a known action are left out.

    The next entry is looked for within a time bucket and, for a bucket's last entry, in
    a list of the first entries of each bucket, so a pattern with very many entries is
    spread over its buckets.
    """
    rows = (feed.where("list_name is not null and pattern is not null and listed_at is not null"
                       " and action in ('add', 'remove')")
            .groupBy("list_name", "pattern", "listed_at").agg(F.max("action").alias("action"))
            .withColumn("bucket", F.floor(F.col("listed_at") / bucket)))
    key = ["list_name", "pattern"]
    firsts = rows.groupBy(*key, "bucket").agg(F.min("listed_at").alias("first_at")).withColumn(
        "later", F.lead("first_at").over(Window.partitionBy(*key).orderBy("bucket"))
    ).drop("first_at")
    following = F.lead("listed_at").over(Window.partitionBy(*key, "bucket").orderBy("listed_at"))
    return (rows.withColumn("following", following).join(firsts, [*key, "bucket"])
            .where("action = 'add'")
            .select(*key, F.col("listed_at").alias("valid_from"),
                    F.coalesce("following", "later").alias("valid_to")))


def active_lists(captures: DataFrame, feed: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(url, fetched_at, list_name, pattern) of every entry active at a capture.

    ``captures`` has url and a numeric fetched_at; repeated ones count once. Captures and
    intervals meet on (pattern, time bucket), so a host with very many captures, or an
    entry with a long history, is spread over time; adaptive execution splits what is
    still skewed. An interval takes part once per bucket up to the last capture.

    A capture asks for the keys that some list holds. If the patterns of the feed are few
    enough to broadcast, which is counted first, all other keys end in the task that makes
    them; of a longer feed Spark's own runtime filter may drop some.
    """
    place = F.floor(F.col("fetched_at") / bucket)
    listed = feed.where("pattern is not null").select("pattern").distinct()
    size = listed.agg(F.count(F.lit(1)).alias("n"), F.max(
        F.size(F.split("pattern", "/")) - 1).alias("deepest")).first()
    few = size["n"] <= LISTED_PATTERNS
    asked = (captures.where("url is not null and fetched_at is not null")
             .select("url", "fetched_at").distinct()
             .select("url", "fetched_at", place.alias("bucket"),
                     F.explode(keys_of(F.col("url"), size["deepest"] or 0)).alias("pattern"))
             .join(F.broadcast(listed) if few else listed, "pattern", "left_semi"))
    first, last = captures.agg(F.min("fetched_at"), F.max("fetched_at")).first()
    low = F.floor(F.greatest("valid_from", F.lit(first)) / bucket)
    high = F.floor(F.least(F.coalesce("valid_to", F.lit(last)), F.lit(last)) / bucket)
    spread = validity(feed, bucket).where(low <= high).withColumn(
        "bucket", F.explode(F.sequence(low, high)))
    found = asked.join(spread, ["pattern", "bucket"]).where(
        (F.col("valid_from") <= F.col("fetched_at"))
        & (F.col("valid_to").isNull() | (F.col("fetched_at") < F.col("valid_to"))))
    return found.select("url", "fetched_at", "list_name", "pattern")


def filter_urls(captures: DataFrame, feed: DataFrame, allow: str = "allow",
                bucket: int = BUCKET) -> DataFrame:
    """``captures``, all rows and columns, with ``lists``, ``n_entries`` and ``blocked``.

    ``lists`` are the sorted names of the lists with an entry that covers the URL and was
    active when it was fetched, joined by commas; ``n_entries`` counts those entries. A
    capture is blocked if it has any and none is on the ``allow`` list. Without url, time
    or match: an empty text, zero, false. Columns of these names are replaced.
    """
    rows = captures.drop("lists", "n_entries", "blocked")
    at_url, at_time = unused("at_url", rows), unused("at_time", rows)
    names, n = unused("names", rows), unused("n", rows)
    verdicts = (active_lists(captures, feed, bucket).distinct().groupBy("url", "fetched_at")
                .agg(F.array_sort(F.collect_set("list_name")).alias(names),
                     F.count(F.lit(1)).alias(n))
                .withColumnsRenamed({"url": at_url, "fetched_at": at_time}))
    joined = rows.join(verdicts, (rows["url"] == verdicts[at_url])
                       & (rows["fetched_at"] == verdicts[at_time]), "left")
    found = F.coalesce(names, F.array().cast("array<string>"))
    return joined.select(
        *[rows[c] for c in rows.columns], F.array_join(found, ",").alias("lists"),
        F.coalesce(n, F.lit(0)).cast("bigint").alias("n_entries"),
        ((F.size(found) > 0) & ~F.array_contains(found, allow)).alias("blocked"))
