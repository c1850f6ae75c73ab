"""URL filters by dated lists: entries become validity intervals, and an as-of join evaluates every
capture against the entries active when it was fetched. DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Parts a pattern's captures are dealt out to, and copies of its intervals.
SALTS = 32
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def host_of(url: Column) -> Column:
    """The host in lower case without a final dot; empty where there is none or the URL is NULL."""
    return F.regexp_replace(F.lower(F.coalesce(F.regexp_extract(url, HOST, 1), F.lit(""))), r"\.$", "")


def suffixes(host: Column) -> Column:
    """The host and its parent domains of at least two labels."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    tails = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.array_join(F.slice(labels, i, n), "."))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(tails)


def intervals(entries: DataFrame) -> DataFrame:
    """(list, pattern, from, until) from rows (list, pattern, day, action): an entry holds from the day it
    is added to the day of the next action; `until` is NULL where none follows. Of several actions on a
    day a removal wins. Rows with a NULL are left out."""
    named = entries.dropna(subset=["list", "pattern", "day", "action"]).withColumn("pattern", F.lower("pattern"))
    daily = named.groupBy("list", "pattern", "day").agg(
        F.max((F.col("action") == "remove").cast("int")).alias("removed"))
    order = Window.partitionBy("list", "pattern").orderBy("day")
    return daily.withColumn("until", F.lead("day").over(order)).filter("removed = 0").select(
        "list", "pattern", F.col("day").alias("from"), "until")


def evaluate(captures: DataFrame, entries: DataFrame, salts: int = SALTS) -> DataFrame:
    """Per capture (page_id, url, fetched): the lists that hold its host or a parent domain on the day it
    was fetched, sorted and joined by commas, and whether there is any. Equal rows stay apart; a NULL day
    or URL matches nothing. Hot hosts are salted, and the intervals of a pattern copied to every salt.
    """
    rows = captures.select("page_id", "url", "fetched").groupBy("page_id", "url", "fetched").agg(F.count(F.lit(1)).alias("n"))
    rows = rows.withColumn("host", host_of(F.col("url")))
    asked = rows.select("page_id", "url", "fetched", F.explode(suffixes(F.col("host"))).alias("pattern"))
    asked = asked.withColumn("salt", F.pmod(F.xxhash64("page_id", "url", "fetched"), F.lit(salts)).cast("int"))
    held = intervals(entries).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    found = asked.join(held, ["pattern", "salt"]).filter(
        (F.col("from") <= F.col("fetched")) & (F.col("until").isNull() | (F.col("fetched") < F.col("until"))))
    lists = found.groupBy("page_id", "url", "fetched").agg(F.array_join(F.array_sort(F.collect_set("list")), ",").alias("lists"))
    lists = lists.toDF("_page", "_url", "_day", "lists")
    same = F.col("page_id").eqNullSafe(F.col("_page")) & F.col("url").eqNullSafe(F.col("_url")) & F.col("fetched").eqNullSafe(F.col("_day"))
    return rows.join(lists, same, "left").select(
        "page_id", "url", "host", "fetched", F.coalesce("lists", F.lit("")).alias("lists"), F.col("lists").isNotNull().alias("blocked"),
        F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy")).drop("copy")


def number(text: Column, at: int) -> Column:
    """A number from 0 to 65 535 out of the text's MD5."""
    return F.conv(F.substring(F.md5(text.cast("binary")), at, 4), 16, 10).cast("int")


def dated_captures(pages: DataFrame) -> DataFrame:
    """Pages with a day of fetching derived from their URL, in one year."""
    return pages.select("page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"), number(F.col("url"), 1) % 366).alias("fetched"))


def derived_lists(pages: DataFrame) -> DataFrame:
    """Dated entries of three lists, derived from the hosts of the pages: half of the hosts and of their parent
    domains with three labels are on one, are taken off later and partly put on again."""
    hosts = pages.select(host_of(F.col("url")).alias("host")).filter("host <> ''").distinct()
    parents = F.filter(suffixes(F.col("host")), lambda x: F.size(F.split(x, r"\.")) >= 3)
    patterns = hosts.select(F.explode(F.array_union(F.array("host"), parents)).alias("pattern")).distinct()
    p = F.col("pattern")
    drawn = patterns.filter(number(p, 5) % 2 == 0).withColumn("list", F.element_at(F.array(*map(F.lit, ("adult", "malware", "spam"))), number(p, 9) % 3 + 1))
    start = F.date_add(F.lit("2023-10-01").cast("date"), number(p, 13) % 366)
    dated = [("add", F.lit(0)), ("remove", F.lit(30) + number(p, 17) % 120), ("add", F.lit(180) + number(p, 21) % 60)]
    events = F.array(*[F.struct(F.lit(a).alias("action"), F.date_add(start, d).alias("day")) for a, d in dated])
    kept = F.filter(events, lambda e: (e["action"] == "remove") | (e["day"] == start) | (number(p, 25) % 2 == 0))
    return drawn.select("list", "pattern", F.explode(kept).alias("e")).select("list", "pattern", "e.day", "e.action")
