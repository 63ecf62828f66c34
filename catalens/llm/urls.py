"""URL filter: listed host rules, and association rules mined from labelled urls. DataFrame operations only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalens.staging import stage

#: Fixed values: (verdict, host and path) of the listed rules.
RULES = (
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALLOW, BLOCK = "=allow", "=block"  # class items; tokens hold no "="


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z in lower case; null or without ://: empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ? # or the end; null or without ://: empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def listed_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null: the host or a subdomain, and a path that starts alike."""
    found = []
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        own, _, start = rule.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith("/" + start)
        found.append(F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.coalesce(*found)


def tokens(host: Column, path: Column) -> Column:
    """Distinct tokens of a url: its host's labels (``h:``), the two last together, and the path's words but those of digits alone (``p:``)."""
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    site = F.when(F.size(labels) > 1, F.concat(F.lit("s:"), F.array_join(F.slice(labels, -2, 2), ".")))
    words = F.filter(F.split(F.translate(path, UPPER, LOWER), r"[^\p{L}\p{Nd}]+"), lambda x: (x != "") & ~x.rlike(r"^\p{Nd}+$"))
    tagged = F.concat(F.transform(labels, lambda x: F.concat(F.lit("h:"), x)), F.transform(words, lambda x: F.concat(F.lit("p:"), x)), F.array(site))
    return F.array_distinct(F.filter(tagged, lambda x: x.isNotNull() & ~F.contains(x, F.lit("="))))


def mine(labelled: DataFrame, min_support: float = 0.001, min_confidence: float = 0.6, min_lift: float = 1.1, min_rows: int = 5) -> DataFrame:
    """(antecedent array, verdict, confidence, support): rules of token combinations for a class.

    ``labelled``: (tokens array, verdict) of every labelled url. FP-growth counts all of them. Rules for a
    class stay above the confidence, the support and the lift, and rest on ``min_rows`` labelled urls at least; one that holds all tokens of a shorter rule
    for the same class without being surer says nothing new and goes.
    """
    items = stage(labelled.select(F.array_union("tokens", F.array(F.concat(F.lit("="), "verdict"))).alias("items")))
    n = items.count()
    floor = (min_rows - 0.5) / max(n, 1)
    # tokens rarer than the support can be in no rule: transactions shrink before they are shuffled
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, max(min_support, floor)), minConfidence=min_confidence).fit(items)
    rules = model.associationRules.filter(
        F.col("consequent")[0].isin(ALLOW, BLOCK) & (F.col("lift") >= min_lift) & (F.col("support") > floor) & ~F.arrays_overlap("antecedent", F.array(F.lit(ALLOW), F.lit(BLOCK)))
    ).select(F.array_sort("antecedent").alias("antecedent"), F.substring(F.col("consequent")[0], 2, 9).alias("verdict"), "confidence", "support")
    short = rules.select(F.col("antecedent").alias("short"), F.col("verdict").alias("short_verdict"), F.col("confidence").alias("short_confidence"))
    # an antecedent's subsets are among the rules that share its first or another token: an inverted index again
    implied = rules.select("*", F.explode("antecedent").alias("token")).join(
        short.withColumn("token", F.col("short")[0]), "token"
    ).filter(
        (F.size("short") < F.size("antecedent")) & (F.size(F.array_except("short", "antecedent")) == 0)
        & (F.col("verdict") == F.col("short_verdict")) & (F.col("short_confidence") >= F.col("confidence"))
    ).select("antecedent", "verdict").distinct()
    return rules.join(implied, ["antecedent", "verdict"], "left_anti")


def match(urls: DataFrame, rules: DataFrame, row_id: str) -> DataFrame:
    """(row_id, mined_verdict, mined_rule, mined_confidence): the surest rule whose tokens a url all has.

    Inverted index: a rule stands under one of its tokens, the rarest among the rules' antecedents, and only
    urls with that token are compared with it. Ties go to higher support, then block, then the tokens.
    """
    frequency = rules.select(F.explode("antecedent").alias("token")).groupBy("token").count()
    spread = rules.select("*", F.explode("antecedent").alias("token")).join(frequency, "token")
    index = spread.groupBy("antecedent", "verdict", "confidence", "support").agg(F.min(F.struct("count", "token")).alias("k")).select(
        F.col("k.token").alias("token"), "antecedent", "verdict", "confidence", "support"
    )
    met = urls.select(row_id, "tokens", F.explode("tokens").alias("token")).join(index, "token")
    met = met.filter(F.size(F.array_except("antecedent", "tokens")) == 0)
    best = F.max(F.struct("confidence", "support", F.col("verdict").alias("mined_verdict"), F.array_join("antecedent", " ").alias("mined_rule")))
    return met.groupBy(row_id).agg(best.alias("b")).select(row_id, "b.mined_verdict", "b.mined_rule", F.col("b.confidence").alias("mined_confidence"))


def judge_urls(pages: DataFrame, labels: DataFrame, row_id: str = "page_id", url: str = "url", label_id: str = "doc_id", rules: Sequence[tuple[str, str]] = RULES, **mining) -> DataFrame:
    """(row_id, host, path, rule, verdict, mined_rule, mined_confidence): a verdict for every url.

    The longest listed rule decides; else the surest mined rule; else allow. A url is labelled through the
    number in its path that names a document of ``labels``: block where that one is toxic (1) or of
    quality 0, else allow; urls without such a number or label are not mined. Null urls and those without
    :// have empty host and path, no rule, and verdict allow. Rows are told apart by url, so repeated rows
    and null ids all get their verdict; other columns are ignored.
    """
    own = pages.select(F.col(row_id), F.col(url).cast("string").alias("_url"))
    host, path = host_of(F.col("_url")), path_of(F.col("_url"))
    own = own.select(row_id, host.alias("host"), path.alias("path"))
    judged = own.select("*", listed_rule(F.col("host"), F.col("path"), rules).alias("listed"), tokens(F.col("host"), F.col("path")).alias("tokens"))
    number = F.expr("try_cast(regexp_extract(path, '/([0-9]{1,18})(?:[./]|$)', 1) as bigint)")
    marked = labels.groupBy(label_id).agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    marked = marked.filter("toxic is not null or quality is not null")
    bad = F.coalesce(F.col("toxic") == 1, F.lit(False)) | F.coalesce(F.col("quality") == 0, F.lit(False))
    labelled = judged.select("tokens", number.alias(label_id)).filter(F.col(label_id).isNotNull()).join(marked, label_id)
    mined = mine(labelled.select("tokens", F.when(bad, "block").otherwise("allow").alias("verdict")), **mining)
    # urls of the same tokens share a verdict: a hot host is one row here
    kinds = judged.filter("listed is null").select("tokens").distinct().withColumn("_kind", F.xxhash64("tokens"))
    verdicts = match(kinds, mined, "_kind")
    return (
        judged.withColumn("_kind", F.xxhash64("tokens")).join(verdicts, "_kind", "left")
        .withColumn("_open", F.col("listed").isNull())
        .select(
            row_id, "host", "path", F.col("listed.rule").alias("rule"),
            F.coalesce("listed.verdict", "mined_verdict", F.lit("allow")).alias("verdict"),
            F.when(F.col("_open"), F.col("mined_rule")).alias("mined_rule"),
            F.when(F.col("_open"), F.col("mined_confidence")).alias("mined_confidence"),
        )
    )
