"""URL filters: a short rule list first, association rules mined from its labels for the rest.

1. A listed rule (host, path) fits its host and all subdomains where the url's
   path starts with the rule's; the longest fitting rule gives the verdict.
2. Urls are turned into sets of tokens (the host's last one and two labels, words
   of the labels before them, path words, file type, query keys, scheme).  The urls that a listed rule has
   judged are the labelled transactions; Spark's FP-growth mines their frequent
   token combinations, and rules ``tokens -> verdict`` are kept by support and
   confidence, without those that a shorter rule already states as well.
3. Mined rules are matched by an inverted index token -> rule: each *distinct*
   token set looks up the rules of its tokens once and a rule fits when all its
   tokens were hit.  The best fitting rule (confidence, then support, then more
   tokens, then block before allow) gives the verdict; without one it is allow.

Everything is DataFrame code.  The number of mined rules is bounded by the
support (a token set below it is not frequent), not by the number of pages.

Cases: a null url or one without ``://`` has empty host and path and no tokens,
so it is allowed; repeated rows are judged each; with no labelled urls no rule
is mined; a url of any length is judged whole; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

# The listed rules, (verdict, host, path).
LISTED = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)

MIN_SUPPORT = 0.02
MIN_CONFIDENCE = 0.8
LABEL = "verdict:"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(urls: DataFrame) -> DataFrame:
    """Add ``host`` and ``path`` to ``urls(url)``."""
    at = F.instr("url", "://")
    rest = F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return (urls.withColumn("host", F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER))
            .withColumn("path", F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)))


def listed_rule(rules=LISTED):
    """Columns (rule, verdict) of the longest listed rule that fits host and path; null without one."""
    longest_first = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    rule = verdict = F.lit(None).cast("string")
    for kind, host, path in reversed(longest_first):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule = F.when(fits, F.lit(host + path)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def tokens():
    """Distinct tokens of (url, host, path), sorted: an array column."""
    labels = F.split("host", r"\.")
    suffixes = F.expr("transform(sequence(1, 2), i -> concat('host:', substring_index(host, '.', -i)))")
    words = F.expr("transform(filter(split(regexp_replace(host, '[.]?[^.]*[.]?[^.]*$', ''), '[.-]'), x -> x <> ''), "
                   "x -> concat('word:', x))")
    folders = F.expr("transform(filter(split(path, '/'), x -> x <> '' and not x rlike '[0-9]'), "
                     "x -> concat('path:', x))")
    kind = F.array(F.concat(F.lit("type:"), F.regexp_extract("path", r"\.([A-Za-z]+)$", 1)))
    keys = F.expr("transform(regexp_extract_all(url, '[?&]([^=&#]+)=', 1), x -> concat('query:', x))")
    scheme = F.array(F.concat(F.lit("scheme:"), F.expr("substring_index(url, '://', 1)")))
    found = F.array_sort(F.array_distinct(F.concat(suffixes, words, folders, kind, keys, scheme)))
    return F.when((F.col("host") != "") & labels.isNotNull(),
                  F.filter(found, lambda x: ~x.isin("type:", "host:", "scheme:"))) \
        .otherwise(F.array().cast("array<string>"))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT,
         min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rules ``(rule_id, items, verdict, confidence, support)`` of ``labelled(tokens, verdict)``."""
    baskets = labelled.select(F.array_union("tokens", F.array(F.concat(F.lit(LABEL), "verdict"))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    rules = (model.associationRules
             .where(F.col("consequent")[0].startswith(LABEL))
             .select(F.array_sort("antecedent").alias("items"),
                     F.substring_index(F.col("consequent")[0], ":", -1).alias("verdict"),
                     "confidence", "support")
             .where(~F.exists("items", lambda x: x.startswith(LABEL))))
    rules = stored(rules.withColumn("rule_id", F.xxhash64("items", "verdict")), "url-rules")
    # A rule goes when one with a single token less says the same at least as surely.
    shorter = (rules.where(F.size("items") > 1)
               .select("rule_id", "verdict", "confidence", "items", F.explode("items").alias("left_out"))
               .select("rule_id", "verdict", "confidence",
                       F.array_except("items", F.array("left_out")).alias("items"))
               .alias("x")
               .join(rules.select("items", "verdict", F.col("confidence").alias("c")), ["items", "verdict"])
               .where("c >= confidence").select("rule_id").distinct())
    return rules.join(shorter, "rule_id", "left_anti")


def match(token_sets: DataFrame, rules: DataFrame) -> DataFrame:
    """Best fitting rule of each distinct set: ``token_sets(tokens)`` -> (tokens, mined, verdict).

    Inverted index: a row per (token, rule); hits are counted per set and rule.
    """
    index = rules.select(F.explode("items").alias("token"), "rule_id", "verdict", "confidence", "support",
                         F.size("items").alias("need"), F.array_join("items", " ").alias("mined"))
    sets = token_sets.select("tokens").distinct()
    fits = (sets.select("tokens", F.explode("tokens").alias("token"))
            .join(index, "token")
            .groupBy("tokens", "rule_id", "verdict", "confidence", "support", "need", "mined").count()
            .where(F.col("count") == F.col("need")))
    best = F.max(F.struct("confidence", "support", "need", "verdict", "mined")).alias("best")
    return fits.groupBy("tokens").agg(best).select("tokens", "best.mined", "best.verdict")


def judge(pages: DataFrame, rules=LISTED, min_support: float = MIN_SUPPORT,
          min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Per row of ``pages(page_id, url)``: page_id, host, path, rule, verdict, mined."""
    rule, verdict = listed_rule(rules)
    parts = (split_url(pages.select("page_id", "url"))
             .withColumn("rule", rule).withColumn("listed", verdict).withColumn("tokens", tokens()))
    labelled = parts.where("listed is not null").select("tokens", F.col("listed").alias("verdict"))
    if labelled.isEmpty():
        return parts.select("page_id", "host", "path", "rule", F.lit("allow").alias("verdict"),
                            F.lit(None).cast("string").alias("mined"))
    mined = mine(labelled, min_support, min_confidence)
    best = match(parts.where("listed is null"), mined).withColumnRenamed("verdict", "found")
    open_ = parts.where("listed is null").join(best, "tokens", "left")
    done = parts.where("listed is not null")
    return (done.select("page_id", "host", "path", "rule", F.col("listed").alias("verdict"),
                        F.lit(None).cast("string").alias("mined"))
            .unionByName(open_.select("page_id", "host", "path", "rule",
                                      F.coalesce("found", F.lit("allow")).alias("verdict"), "mined")))
