"""URL filters: given rules first, then association rules mined by Spark's FP-growth.

Tokens of a URL (parts of its host, registered name, path steps, query keys) and its label are items;
frequent combinations that imply the label `block` with enough confidence become rules, of which those
stay that hold no shorter rule, however many they are. A URL is matched by an inverted index from each
rule's rarest token: a rule holds when all its tokens are there. Where no labels are given, the pages that
the given rules block are the blocked ones among all pages: those that no rule fits count as not blocked,
so a mined rule needs nearly all pages of its tokens to be known as blocked, and can block at most a quarter
as many open pages as it has known ones. It must also be twice as sure as a page taken blindly.

A null URL, or one without "://", has an empty host and path, no tokens, and gets the verdict allow.
Repeated rows and null page_ids are judged each. Rules need the support of LEAST rows however small the
table, so small tables mine none. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: verdict, host, path
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
#: Share of the labelled rows, and rows at least, that hold a rule and are blocked; and the share of those it fits.
SUPPORT, LEAST, CONFIDENCE = 0.005, 20, 0.8
#: A rule's confidence over the share of blocked rows, at least, where pages without a label count too.
LIFT = 2.0


def parts(url: Column) -> tuple[Column, Column]:
    """Host, A-Z in lower case, and path of a URL."""
    whole = F.coalesce(url, F.lit(""))
    at = F.instr(whole, "://")
    rest = F.when(at > 0, whole.substr(at + 3, F.length(whole))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest.substr(F.length(host) + 1, F.length(rest)), r"^([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def fitting(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest rule that fits, as a struct (rule, verdict), or null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        found = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def tokens(pages: DataFrame) -> Column:
    """Distinct tokens of host and path and the query's keys."""
    labels = F.split("host", r"\.")
    suffix = F.slice(labels, F.greatest(F.lit(1), F.size(labels) - 1), 2)
    items = F.concat(
        F.transform(labels, lambda x: F.concat(F.lit("host:"), x)),
        F.array(F.concat(F.lit("site:"), F.array_join(suffix, "."))),
        F.transform(F.split("path", "/"), lambda x: F.concat(F.lit("path:"), F.when(x.rlike("^[0-9]+$"), F.lit("#")).otherwise(F.regexp_replace(x, "^[0-9]+", "#")))),
        F.transform(F.regexp_extract_all(F.coalesce("url", F.lit("")), F.lit(r"[?&]([^=&#]+)="), F.lit(1)), lambda x: F.concat(F.lit("query:"), x)),
    )
    return F.array_sort(F.array_distinct(F.filter(items, lambda x: ~x.isin("host:", "path:", "site:", "site:."))))


def _holding(sets: DataFrame, rows: DataFrame) -> DataFrame:
    """(needed, items, ...) for every set of tokens `needed` and every row of rows (items, ...) that holds all of it, by an inverted index from the set's rarest token."""
    often = rows.select(F.explode("items").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    first = sets.select("needed", F.explode("needed").alias("token")).join(often, "token").groupBy("needed").agg(F.min_by("token", F.struct("n", "token")).alias("token"))
    return rows.withColumn("token", F.explode("items")).join(first, "token").where(F.forall("needed", lambda x: F.array_contains("items", x))).drop("token")


def mine(labelled: DataFrame, support: float = SUPPORT, least: int = LEAST, confidence: float = CONFIDENCE, lift: float = 1.0) -> DataFrame:
    """(items, confidence): all rules that imply a block and hold no shorter such rule, from rows (items, blocked boolean).

    A rule's confidence is `lift` times the share of blocked rows at least, or 1 where that is more.

    FP-growth sees only what can be part of a longer rule: blocked rows, and of their tokens those that
    enough of them have and that aren't a rule alone. Of tokens that always stand together one is enough,
    so a long path that many rows share has one itemset, not one for each of its subsets."""
    kept = common.materialise(labelled.select("items", "blocked", F.monotonically_increasing_id().alias("row")), "labelled")
    seen = kept.agg(F.count(F.lit(1)).alias("n"), F.count_if("blocked").alias("blocked")).first()
    floor = max(least, ceil(support * seen["n"]))
    confidence = max(confidence, min(1.0, lift * seen["blocked"] / max(1, seen["n"])))
    tokens_ = kept.select(F.explode("items").alias("token"), "blocked", F.xxhash64("row").cast("decimal(38,0)").alias("row"))
    often = tokens_.groupBy("token").agg(F.count_if("blocked").alias("hits"), F.count(F.lit(1)).alias("freq"), F.sum("row").alias("rows")).where(F.col("hits") >= floor)
    often = common.materialise(often.withColumn("confidence", F.col("hits") / F.col("freq")), "often")
    alone = often.where(F.col("confidence") >= confidence)
    rules = [alone.select(F.array("token").alias("items"), "confidence")]
    # equal sets of rows have equal sums of the rows' hashes
    open_tokens = often.where(F.col("confidence") < confidence).groupBy("freq", "rows").agg(F.min("token").alias("token")).select("token")
    pairs = kept.where("blocked").select("row", F.explode("items").alias("token")).join(open_tokens, "token")
    baskets = common.materialise(pairs.groupBy("row").agg(F.collect_list("token").alias("items")).where(F.size("items") > 1), "baskets")
    n = baskets.count()
    if n >= floor:
        sets = FPGrowth(itemsCol="items", minSupport=(floor - 0.5) / n).fit(baskets).freqItemsets.where(F.size("items") > 1)
        sets = common.materialise(sets.select(F.array_sort("items").alias("needed"), F.col("freq").alias("hits")), "itemsets")
        freq = _holding(sets, kept.select("items")).groupBy("needed").agg(F.count(F.lit(1)).alias("freq"))
        sure = sets.join(freq, "needed").select(F.col("needed").alias("items"), (F.col("hits") / F.col("freq")).alias("confidence")).where(F.col("confidence") >= confidence)
        sure = common.materialise(sure, "rules")
        for size in range(2, (sure.agg(F.max(F.size("items"))).first()[0] or 1) + 1):
            now = sure.where(F.size("items") == size)
            if size > 2:
                shorter = reduce(DataFrame.unionByName, rules[1:]).select(F.col("items").alias("needed"))
                now = now.join(_holding(shorter, now).select("items").distinct(), "items", "left_anti")
            rules.append(common.materialise(now, "rules"))
    return reduce(DataFrame.unionByName, rules)


def judge(pages: DataFrame, labels: DataFrame | None = None, rules: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of pages.

    labels: (page_id, blocked boolean), of repeated ones a block counts; null ids and labels don't."""
    host, path = parts(F.col("url"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("fit", fitting(F.col("host"), F.col("path"), RULES if rules is None else rules)).withColumn("items", tokens(rows))
    if labels is None:
        lift = LIFT
        labelled = rows.select("items", F.coalesce(F.col("fit.verdict") == "block", F.lit(False)).alias("blocked"))
    else:
        lift = 1.0
        own = labels.where("page_id is not null and blocked is not null").groupBy(F.col("page_id").cast("long").alias("page_id")).agg(F.max("blocked").alias("blocked"))
        labelled = rows.join(own, "page_id").select("items", "blocked")
    found = mine(labelled.where(F.size("items") > 0), lift=lift).select(F.col("items").alias("needed"))
    # a verdict depends on a URL's tokens alone
    open_ = F.col("fit").isNull() & (F.size("items") > 0)
    hits = common.materialise(_holding(found, rows.where(open_).select("items").distinct()).select("items").distinct().withColumn("mined", F.lit(True)), "hits")
    method = rows.where(open_).join(hits, "items", "left").select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.when(F.col("mined"), "block").otherwise("allow").alias("verdict"))
    given = rows.where(~open_).select("page_id", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce("fit.verdict", F.lit("allow")).alias("verdict"))
    return given.unionByName(method)
