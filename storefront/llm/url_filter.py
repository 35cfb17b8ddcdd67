"""URL filters whose lists change over time.

Dated list entries (a rule is added to or removed from a list) become
validity intervals, and every capture is judged by the rules that were active
when it was fetched. A capture's keys (host, the domains above it, its URL, the
folders of its path) are joined with the names of the rules; each pair then
gets the rule's last interval begun by the fetch time from an as-of join, which
merges captures and intervals by time within a rule and day and carries on
what the day opens with. So the work grows with captures plus changes: no
capture meets the other intervals of its rule, and a rule that a third of the
captures match is spread over its days.

Distinct (URL, time) pairs are judged once and joined back to the captures.
Only as many domain and folder levels are made as the lists have, which loses
nothing and bounds the keys of very long URLs.

Defined results: of changes to a rule at the same moment an addition wins; a
rule that is added again while active stays active; a null or malformed URL,
or a null fetch time, matches no rule; entries with null fields are ignored;
repeated captures are each judged; without entries nothing is blocked; a
capture's other columns travel as one struct, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storefront.llm.shared import column, text_key, written
from storefront.operators.asof import as_of

SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?"
KINDS = ("host", "domain", "folder", "url")


def url_host(url: Column) -> Column:
    """Lower-case host of an absolute URL, without port; '' if there is none."""
    return F.lower(F.regexp_extract(url, SCHEME + r"([^/?#:]*)", 1))


def url_path(url: Column) -> Column:
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    return F.when(path == "", F.lit("/")).otherwise(path)


def url_keys(url: Column, labels: int, folders: int) -> Column:
    """Keys a rule can name: ``host:``, ``domain:`` for the host and the
    domains above it of up to ``labels`` labels, ``folder:`` for up to
    ``folders`` levels of its path, ``url:`` without fragment."""
    host, path = url_host(url), url_path(url)
    parts, steps = F.split(host, r"\.", -1), F.split(path, "/", -1)
    domains = F.transform(F.sequence(F.lit(1), F.least(F.size(parts), F.lit(max(1, labels)))), lambda n: F.concat(
        F.lit("domain:"), F.array_join(F.slice(parts, F.size(parts) - n + 1, n), ".")))
    levels = F.transform(F.sequence(F.lit(1), F.least(F.size(steps) - 1, F.lit(max(1, folders)))), lambda n: F.concat(
        F.lit("folder:"), host, F.array_join(F.slice(steps, 1, n), "/"), F.lit("/")))
    query = F.regexp_extract(url, r"^[^?#]*(\?[^#]*)", 1)
    made = F.concat(F.array(F.concat(F.lit("host:"), host)), domains, levels,
                    F.array(F.concat(F.lit("url:"), host, path, query)))
    return F.when(host != "", made).otherwise(F.array().cast("array<string>"))


def validity(entries: DataFrame) -> DataFrame:
    """(list, key, valid_from, valid_to) from dated changes ``entries`` (list,
    key, added, at): each lasts to the rule's next change; removals end.

    The next change is looked for among the rule's changes of the same day,
    then at its next day with changes, so a rule that changes very often is
    dealt by day and has one row a day where its days meet."""
    dated = entries.filter(F.col("list").isNotNull() & F.col("key").isNotNull() & F.col("added").isNotNull()
                           & F.col("at").isNotNull())
    changes = dated.groupBy("list", "key", "at").agg(F.max("added").alias("added"))
    rule, changes = ["list", "key"], changes.withColumn("day", F.to_date("at"))
    days = changes.groupBy(*rule, "day").agg(F.min("at").alias("start"))
    days = days.select(*rule, "day", F.lead("start").over(Window.partitionBy(*rule).orderBy("day")).alias("later"))
    today = F.lead("at").over(Window.partitionBy(*rule, "day").orderBy("at"))
    until = changes.withColumn("today", today).join(days, [*rule, "day"]).filter("added")
    return until.select(*rule, F.col("at").alias("valid_from"), F.coalesce("today", "later").alias("valid_to"))


def judge(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched") -> DataFrame:
    """(row, blocked, n_rules, lists) per row of ``captures``: the row as a
    struct, whether a rule active at its fetch time names it, how many do, and
    the lists that hold them, sorted and joined by commas."""
    active = written(validity(entries), "url-rules")
    body = F.regexp_replace("key", "^[a-z]+:", "")
    labels, folders = active.agg(
        F.max(F.when(F.col("key").startswith("domain:"), F.size(F.split(body, r"\.", -1)))),
        F.max(F.when(F.col("key").startswith("folder:"), F.size(F.split(body, "/", -1)) - 1))).first()
    rows = captures.select(F.struct(*[column(captures, c) for c in captures.columns]).alias("row"),
                           column(captures, url).alias("u"), column(captures, fetched).alias("t"))
    known = F.col("u").isNotNull() & F.col("t").isNotNull()
    asked = rows.filter(known).select("u", "t").distinct()
    keys = asked.select(*text_key(F.col("u"), F.col("t")), "t",
                        F.explode(F.array_distinct(url_keys(F.col("u"), labels or 0, folders or 0))).alias("key"))
    rule = F.struct(*text_key(F.col("list"), F.col("key"))).alias("rule")  # names stay behind: rules move as 16 bytes
    named = keys.join(written(active.select("list", "key").distinct(), "url-rule-names"), "key").select("_k1", "_k2", "t", "list", rule)
    begun = as_of(named, active.select(rule, "valid_from", "valid_to"), "rule", "t", "valid_from", ["valid_from", "valid_to"], days=1)
    hits = begun.filter(F.col("valid_from").isNotNull() & (F.col("valid_to").isNull() | (F.col("t") < F.col("valid_to"))))
    verdicts = hits.groupBy("_k1", "_k2").agg(F.count(F.lit(1)).alias("n_rules"),
                                              F.array_join(F.array_sort(F.collect_set("list")), ",").alias("lists"))
    # Written first: the join can then be split where one (URL, time) has most captures; captures without either go past it.
    found = rows.filter(known).select("row", *text_key(F.col("u"), F.col("t"))).join(written(verdicts, "url-verdicts"), ["_k1", "_k2"], "left")
    unknown = rows.filter(~known).select("row", F.lit(None).cast("long").alias("n_rules"), F.lit(None).cast("string").alias("lists"))
    return found.select("row", "n_rules", "lists").unionByName(unknown).select(
        "row", F.col("n_rules").isNotNull().alias("blocked"), F.coalesce("n_rules", F.lit(0)).alias("n_rules"),
        F.coalesce("lists", F.lit("")).alias("lists"))
