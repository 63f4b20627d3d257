"""URL filtering by given host rules, then by mined association rules (DataFrame functions only)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talusflow.llm.common import written

# Verdict, host, path.
HOST_RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """The lower-cased text between the first `://` and `/`, `?`, `#` or the end; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def host_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]], pick: int) -> Column:
    """Of the longest rule that fits: its text (pick 1) or its verdict (pick 0), else null."""
    found = F.lit(None).cast("string")
    for verdict, name, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        found = F.when(fits, F.lit((verdict, name + start)[pick])).otherwise(found)
    return found


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """What a rule may name: at most eight tokens, one for each slot, so combinations are bounded.

    Digits become `#`, so counters in paths don't make tokens of their own.
    """
    blurred = F.regexp_replace(path, "[0-9]+", "#")
    keys = F.regexp_extract_all(F.regexp_extract(url, r"\?([^#]*)", 1), F.lit(r"(?:^|&)([^=&]*)"), F.lit(1))
    slots = {
        "scheme": F.regexp_extract(url, r"^([A-Za-z]+)://", 1),
        "domain": F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1),
        "sub": F.regexp_extract(host, r"^(.*)\.[^.]+\.[^.]+$", 1),
        "dir": F.regexp_extract(blurred, r"^/([^/]+)/", 1),
        "page": F.regexp_extract(blurred, r"([^/.]*)(?:\.[^/]*)?$", 1),
        "ext": F.regexp_extract(blurred, r"\.([^/.]+)$", 1),
        "keys": F.array_join(F.array_sort(F.array_distinct(keys)), "&"),
        "mark": F.when(F.contains(url, F.lit("#")), "yes").otherwise(""),
    }
    return F.array_compact(F.array(*[
        F.when(F.coalesce(text, F.lit("")) != "", F.concat(F.lit(f"{slot}="), text))
        for slot, text in slots.items()]))


def mine_rules(labelled: DataFrame, min_support: float = 0.005, min_confidence: float = 0.6,
               min_rows: int = 20) -> DataFrame:
    """Rules from `tokens` to `verdict`: rule_id, tokens, verdict, confidence, support.

    FP-growth runs over all labelled rows. A rule needs the support and confidence given, and must
    beat every rule that has one token less; the others would not change a verdict.
    """
    items = labelled.select(
        F.concat("tokens", F.array(F.concat(F.lit("verdict="), F.col("verdict")))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(items)
    sets = written(model.freqItemsets.select(F.array_sort("items").alias("items"), "freq"), "url-itemsets")
    is_mark = lambda x: x.startswith("verdict=")
    split = sets.select(
        F.filter("items", lambda x: ~is_mark(x)).alias("tokens"),
        F.get(F.filter("items", is_mark), F.lit(0)).alias("mark"), "freq")
    counted = split.where(F.col("mark").isNotNull()).join(
        split.where(F.col("mark").isNull() & (F.size("tokens") > 0)).select(
            "tokens", F.col("freq").alias("of")), "tokens")
    rules = written(counted.select(
        "tokens", F.substring("mark", len("verdict=") + 1, 9).alias("verdict"),
        (F.col("freq") / F.col("of")).alias("confidence"), F.col("freq").alias("support")
    ).where((F.col("confidence") >= min_confidence) & (F.col("support") >= min_rows)), "url-rules")
    shorter = rules.select(
        "tokens", "verdict", "confidence",
        F.explode(F.transform("tokens", lambda t: F.array_remove("tokens", t))).alias("part"))
    beaten = (
        shorter.join(rules.select(F.col("tokens").alias("part"), "verdict",
                                  F.col("confidence").alias("already")), ["part", "verdict"])
        .where(F.col("already") >= F.col("confidence")).select("tokens", "verdict").distinct())
    return rules.join(beaten, ["tokens", "verdict"], "left_anti").withColumn(
        "rule_id", F.xxhash64("tokens", "verdict"))


def matched(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """`tokens` and the verdict of the best rule, for each distinct set of tokens that any rule fits.

    The inverted index leads from a token to the rules that name it; a rule fits when all its
    tokens were met. The most confident rule decides, then the better supported, then block.
    """
    index = rules.select("rule_id", "verdict", "confidence", "support",
                         F.size("tokens").alias("needed"), F.explode("tokens").alias("token"))
    sets = urls.select("tokens").distinct().withColumn("set_id", F.xxhash64("tokens"))
    hits = (
        sets.select("set_id", "tokens", F.explode("tokens").alias("token")).join(index, "token")
        .groupBy("set_id", "tokens", "rule_id", "verdict", "confidence", "support", "needed")
        .agg(F.count(F.lit(1)).alias("met")).where(F.col("met") == F.col("needed")))
    best = F.max(F.struct("confidence", "support", F.col("verdict"), "rule_id"))
    return hits.groupBy("tokens").agg(best.alias("_best")).select(
        "tokens", F.col("_best.verdict").alias("mined"))


def filter_urls(pages: DataFrame, labels: DataFrame, id_col: str = "page_id", url_col: str = "url",
                label_id_col: str = "doc_id", rules: Sequence[tuple[str, str, str]] = HOST_RULES,
                default: str = "allow", **mining: float) -> DataFrame:
    """A verdict for every page: page_id, host, path, rule, verdict, mined.

    Given rules come first. Otherwise the mined rules decide, learnt from the pages whose label
    says low quality or toxic (block) or neither (allow); without a rule the verdict is `default`.
    Labels join on the page's id; null ids have no label, null flags count as not set. Null urls
    and urls without `://` have an empty host and path. Repeated rows are judged one by one; empty
    tables give empty results or no mined rules. Columns not named here are not read.
    """
    url = F.col("url")
    seen = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")).withColumn(
        "host", host_of(url)).withColumn("path", path_of(url)).withColumn(
        "tokens", F.array_sort(url_tokens(url, F.col("host"), F.col("path"))))
    bad = (F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)
    known = labels.select(F.col(label_id_col).alias("page_id"), bad.alias("bad")).groupBy(
        "page_id").agg(F.max("bad").alias("bad"))
    labelled = seen.join(known, "page_id").select(
        "tokens", F.when(F.col("bad"), "block").otherwise("allow").alias("verdict"))
    mined = matched(seen, mine_rules(labelled, **mining))
    given = host_rule(F.col("host"), F.col("path"), rules, 0)
    return seen.join(mined, "tokens", "left").select(
        "page_id", "host", "path",
        host_rule(F.col("host"), F.col("path"), rules, 1).alias("rule"),
        F.coalesce(given, F.col("mined"), F.lit(default)).alias("verdict"), "mined")
