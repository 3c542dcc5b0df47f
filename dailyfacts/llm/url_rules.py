"""URL filters: listed rules first, then association rules mined by FP-growth.

A listed rule is ``host/path``: it fits its host and all subdomains where the url's path
starts with the rule's path, and the longest fitting rule decides. Urls that no rule
fits are judged by mined rules: sets of url tokens (scheme, host labels, path segments,
extension, query keys) whose pages are labelled bad with enough support and confidence.
Rules that a more general rule of at least the same confidence makes needless are
pruned. A mined rule is posted under its rarest token, a url looks its tokens up in that
inverted index, and the other tokens of the rules found are compared.

Bad pages may be rare, so what a rule must beat is their share among all labelled pages: on
two thirds of the labels its share of bad pages is ``LIFT`` times that and more than chance
explains (``SIGMAS`` deviations), and on the other third, which mining has not seen, it is
``LIFT`` times that again.

Mining counts every labelled page. Item sets are bounded by the support: a set of a
page's tokens counts once for that page, so there are at most (sets of a page) divided
by the support share.

Defined results: a null url, or one without ``://``, has an empty host and path, no
tokens and the verdict allow; repeated rows get equal results; without labels no rule
is mined; other columns of the pages are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dailyfacts.llm.common import kept

#: Listed rules and what they say.
LISTED = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)

#: Share of the bad pages that an item set must be in, and least number of bad pages.
SUPPORT = 0.01
LEAST_PAGES = 20
#: Share of the pages with the set that must be bad.
CONFIDENCE = 0.5
#: The same as a multiple of the share among all, how far beyond chance, and least pages to prove it on.
LIFT = 1.25
SIGMAS = 4.0
LEAST_HELD = 5

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def listed_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]] = LISTED) -> Column:
    """The longest fitting rule, else null."""
    choice = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: len(r[0])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        choice = F.when(fits, F.lit(rule)).otherwise(choice)
    return choice


def tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a url, each with a letter for its kind; numbers are one token."""
    def marked(kind: str, parts: Column) -> Column:
        return F.transform(F.array_remove(parts, ""), lambda p: F.concat(F.lit(f"{kind}:"), p))

    text = F.coalesce(url, F.lit(""))
    segments = F.regexp_replace(path, r"[0-9]+", "#")
    query = F.regexp_extract(text, r"(?s)\?([^#]*)", 1)
    keys = F.transform(F.split(query, "&"), lambda pair: F.split_part(pair, F.lit("="), F.lit(1)))
    both = F.concat(
        marked("s", F.array(F.regexp_extract(text, r"^([A-Za-z]+)://", 1))),
        marked("h", F.split(host, r"\.")),
        marked("p", F.split(segments, "/")),
        marked("q", keys),
        marked("f", F.array(F.when(text.contains("#"), F.lit("#")).otherwise(""))),
    )
    return F.when(host != "", F.array_distinct(both)).otherwise(F.array().cast("array<string>"))


def labelled_urls(pages: DataFrame, labels: DataFrame, url: str = "url") -> DataFrame:
    """``tokens, bad, held`` of the pages whose document is labelled.

    The document's number ends the path; it is bad when its quality is 0 or it is toxic. A
    third of the urls are held, to prove rules on.
    """
    address = F.col(url)
    numbered = pages.select(
        address.alias("url"),
        F.regexp_extract(path_of(address), r"/([0-9]{1,18})(?:\.[a-z]+|/)?$", 1).try_cast("long").alias("doc_id"),
    ).where("doc_id is not null")
    known = labels.select("doc_id", ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    joined = numbered.join(known.where("bad is not null"), "doc_id")
    return joined.select(
        tokens(F.col("url"), host_of(F.col("url")), path_of(F.col("url"))).alias("tokens"), "bad",
        (F.pmod(F.xxhash64("url"), F.lit(3)) == 0).alias("held"),
    )


def mine_rules(
    labelled: DataFrame,
    support: float = SUPPORT,
    confidence: float = CONFIDENCE,
    least_pages: int = LEAST_PAGES,
) -> DataFrame:
    """``rule_id, tokens, n, n_bad, confidence`` of the pruned rules.

    FP-growth runs over the bad pages, which the support refers to; how many of all
    pages have a set is counted through the same inverted index that matches urls.
    """
    rows = kept(labelled.select("tokens", "bad"), "url-labelled")
    labelled = rows.groupBy("tokens", "bad").agg(F.count(F.lit(1)).alias("n"))
    bad = rows.where("bad and size(tokens) > 0")
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence)
    sets = model.fit(bad.select(F.col("tokens").alias("items"))).freqItemsets.where(F.col("freq") >= least_pages)
    frequent = kept(
        sets.select(F.sort_array("items").alias("tokens"), F.col("freq").cast("long").alias("n_bad"))
        .withColumn("rule_id", F.xxhash64(F.array_join("tokens", "\n"))),
        "url-sets",
    )
    all_urls = labelled.groupBy("tokens").agg(F.sum("n").alias("n")).withColumnRenamed("tokens", "url_tokens")
    found = match_rules(all_urls, frequent, "url_tokens", ["n"])
    counted = frequent.join(found.groupBy("rule_id").agg(F.sum("n").alias("n")), "rule_id")
    sure = kept(
        counted.withColumn("confidence", F.col("n_bad") / F.col("n")).where(F.col("confidence") >= confidence),
        "url-rules",
    )
    return prune(sure)


def proven_rules(
    labelled: DataFrame, support: float = SUPPORT, lift: float = LIFT, sigmas: float = SIGMAS,
    least_pages: int = LEAST_PAGES, least_held: int = LEAST_HELD,
) -> DataFrame:
    """Mined rules that beat the share of bad pages, with ``held_n, held_bad`` of the held third."""
    share = labelled.where("not held").agg(F.avg(F.col("bad").cast("int"))).first()[0] or 0.0
    mined = mine_rules(labelled.where("not held"), support, min(1.0, lift * share), least_pages)
    chance = F.col("n") * share
    sure = mined.where(F.col("n_bad") - chance >= sigmas * F.sqrt(chance * (1 - share)))
    held = labelled.where("held").groupBy("tokens").agg(
        F.count(F.lit(1)).alias("held_n"), F.count_if("bad").alias("held_bad")
    ).withColumnRenamed("tokens", "url_tokens")
    met = match_rules(held, sure, "url_tokens", ["held_n", "held_bad"]).groupBy("rule_id").agg(
        F.sum("held_n").alias("held_n"), F.sum("held_bad").alias("held_bad")
    )
    enough = (F.col("held_n") >= least_held) & (F.col("held_bad") >= lift * share * F.col("held_n"))
    return kept(sure.join(met, "rule_id").where(enough), "url-proven")


def prune(rules: DataFrame) -> DataFrame:
    """Rules without a part that is itself a rule of at least their confidence."""
    parts = rules.select(F.col("rule_id"), "tokens", "confidence", "n", "n_bad")
    general = match_rules(
        parts.select(F.col("tokens").alias("has"), F.col("rule_id").alias("special"),
                     F.col("confidence").alias("special_confidence")),
        rules, "has", ["special", "special_confidence"], ["confidence"],
    )
    needless = general.where("rule_id != special and confidence >= special_confidence").select(
        F.col("special").alias("rule_id")
    )
    return rules.join(needless.distinct(), "rule_id", "left_anti")


def match_rules(
    urls: DataFrame, rules: DataFrame, column: str, keep: Sequence[str], rule_columns: Sequence[str] = ()
) -> DataFrame:
    """``rule_id`` and the ``keep`` columns for every url and rule whose tokens it has.

    The inverted index posts a rule under the token that fewest rules have.
    """
    own = rules.select("rule_id", "tokens", *rule_columns)
    used = own.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("uses"))
    posted = (
        own.select("rule_id", F.explode("tokens").alias("token"))
        .join(used, "token")
        .groupBy("rule_id")
        .agg(F.min(F.struct("uses", "token"))["token"].alias("token"))
        .join(own, "rule_id")
        .withColumnRenamed("tokens", "rule_tokens")
    )
    looked_up = urls.select(F.col(column), *keep, F.explode(column).alias("token"))
    found = looked_up.join(posted, "token").where(F.size(F.array_except("rule_tokens", column)) == 0)
    return found.select("rule_id", *keep, *rule_columns)


def judge(
    pages: DataFrame,
    mined: DataFrame,
    key: str = "page_id",
    url: str = "url",
    listed: Sequence[tuple[str, str]] = LISTED,
) -> DataFrame:
    """``key, host, path, rule, verdict, mined_rules`` for every page.

    Distinct urls without a listed rule are looked up once each.
    """
    rows = pages.select(F.col(key).alias(key), F.col(url).alias("_url"))
    split = rows.withColumns({"host": host_of(F.col("_url")), "path": path_of(F.col("_url"))})
    ruled = split.withColumn("rule", listed_rule(F.col("host"), F.col("path"), listed))
    open_urls = (
        ruled.where("rule is null and host != ''")
        .select("_url", "host", "path").distinct()
        .select(F.col("_url").alias("_blocked"), tokens(F.col("_url"), F.col("host"), F.col("path")).alias("_tokens"))
    )
    blocked = match_rules(open_urls, mined, "_tokens", ["_blocked"]).groupBy("_blocked").agg(
        F.count(F.lit(1)).alias("mined_rules")
    )
    says = F.lit(None).cast("string")
    for rule, verdict in listed:
        says = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(says)
    hits = F.when(F.col("rule").isNull(), F.coalesce("mined_rules", F.lit(0))).otherwise(0).cast("long")
    joined = ruled.join(blocked, F.col("_url") == F.col("_blocked"), "left").withColumn("mined_rules", hits)
    method = F.when(F.col("mined_rules") > 0, F.lit("block")).otherwise(F.lit("allow"))
    return joined.select(key, "host", "path", "rule", F.coalesce(says, method).alias("verdict"), "mined_rules")
