"""URL filter: allow and block rules, and gradient-boosted trees where no rule fits.

The trees are trained from the URLs that a rule labels. Their features are lexical: lengths,
depth, digit ratio, entropy, parameter counts, and how often labelled URLs of the same host
suffix are blocked. All of it is SQL functions and the JVM's tree ensemble.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestweave.llm.storage import stage

#: Labelled URLs that the trees are fitted on at most, the first by a hash of the URL.
SAMPLE = 8192
TREES = 20
DEPTH = 4
#: Labelled URLs that a suffix's rate is smoothed by.
SMOOTHING = 20.0


@dataclass(frozen=True)
class Rule:
    """Allows or blocks a host, its subdomains, and the paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# The rules that the registered query judges by.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)

FEATURES = (
    "f_length",
    "f_host_length",
    "f_path_length",
    "f_depth",
    "f_labels",
    "f_digit_ratio",
    "f_hyphens",
    "f_entropy",
    "f_parameters",
    "f_parameter_length",
    "f_fragment",
    "f_secure",
    "f_top_rate",
    "f_site_rate",
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first '://', A-Z in lower case, and path up to '?' or '#'; '' without '://'."""
    plain = F.coalesce(url.cast("string"), F.lit(""))
    shape = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(plain, shape, 1), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(plain, shape, 2)


def matching_rule(rules: tuple[Rule, ...]) -> Column:
    """Text of the longest rule that fits columns host and path, or null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        fits = (F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)
        out = F.when(fits & F.col("path").startswith(rule.path), rule.text).otherwise(out)
    return out


def _entropy(text: Column) -> Column:
    """Bits a character, from how often each distinct character occurs."""
    size = F.length(text)
    share = F.transform(
        F.array_distinct(F.split(text, "")),
        lambda c: F.when(c == "", 0.0).otherwise(F.try_divide(size - F.length(F.replace(text, c, F.lit(""))), size)),
    )
    return F.aggregate(share, F.lit(0.0), lambda a, p: a - F.when(p > 0, p * F.log2(p)).otherwise(0.0))


def _count(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _lexical(urls: DataFrame) -> DataFrame:
    """The features that the URL alone gives."""
    url, host, path = F.col("plain"), F.col("host"), F.col("path")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    size = F.length(url)
    labels = F.split(host, r"\.")
    values = {
        "f_length": size,
        "f_host_length": F.length(host),
        "f_path_length": F.length(path),
        "f_depth": _count(path, "/"),
        "f_labels": F.size(labels),
        "f_digit_ratio": F.coalesce(F.try_divide(_count(url, string.digits), size), F.lit(0.0)),
        "f_hyphens": _count(host, "-"),
        "f_entropy": _entropy(url),
        "f_parameters": _count(query, "="),
        "f_parameter_length": F.length(query),
        "f_fragment": _count(url, "#"),
        "f_secure": F.startswith(url, F.lit("https")).cast("int"),
    }
    return urls.withColumns(
        {
            **{k: F.coalesce(v.cast("double"), F.lit(0.0)) for k, v in values.items()},
            "top": F.element_at(labels, -1),
            "site": F.array_join(F.slice(labels, F.greatest(F.lit(1), F.size(labels) - 1), F.lit(2)), "."),
        }
    )


def _with_rates(urls: DataFrame, labelled: DataFrame) -> DataFrame:
    """Rates of blocked URLs by host suffix, over all labelled URLs, smoothed to their parent's."""
    counts = stage(labelled.groupBy("top", "site").agg(F.sum("label").alias("bad"), F.count("*").alias("n")), "sites")
    bad, n = counts.agg(F.sum("bad"), F.sum("n")).first()
    overall = bad / n if n else 0.5
    tops = (
        counts.groupBy("top")
        .agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"))
        .select("top", ((F.col("bad") + SMOOTHING * overall) / (F.col("n") + SMOOTHING)).alias("f_top_rate"))
    )
    sites = counts.join(tops, "top").select(
        "site", ((F.col("bad") + SMOOTHING * F.col("f_top_rate")) / (F.col("n") + SMOOTHING)).alias("f_site_rate")
    )
    joined = urls.join(tops, "top", "left").join(sites, "site", "left")
    return joined.withColumn("f_top_rate", F.coalesce("f_top_rate", F.lit(0.5))).withColumn(
        "f_site_rate", F.coalesce("f_site_rate", "f_top_rate")
    )


def judge_urls(pages: DataFrame, url: str = "url", keep: tuple[str, ...] = ("page_id",), rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The columns ``keep`` of ``pages``, host, path, rule, verdict and score.

    ``rule`` is the longest fitting rule's text or null, ``verdict`` is the rule's or, without
    one, the trees': block at a score (probability) of 0.5 or more. Null URLs and those without
    '://' have an empty host and path and are judged by the trees. If no rule labels a URL, or all
    labels agree, there is nothing to learn: every other URL gets that verdict, or else
    allow. Columns named like a result are replaced; repeated rows are judged each.
    """
    names = [c for c in keep if c not in ("host", "path", "rule", "verdict", "score")]
    host, path = host_and_path(F.col(url))
    plain = pages.select(
        *(F.col(c).alias(f"_{k}") for k, c in enumerate(names)),
        F.coalesce(F.col(url).cast("string"), F.lit("")).alias("plain"),
        host.alias("host"),
        path.alias("path"),
    )
    blocked = [r.text for r in rules if r.verdict == "block"]
    ruled = plain.withColumn("rule", matching_rule(rules))
    ruled = ruled.withColumn("label", F.col("rule").isin(blocked).cast("double"))
    urls = _lexical(ruled)
    labelled = urls.where("rule is not null")
    featured = _with_rates(urls, labelled)
    sample = stage(
        featured.where("rule is not null")
        .select(*FEATURES, "label", F.xxhash64("plain").alias("place"))
        .orderBy("place", *FEATURES)
        .limit(SAMPLE),
        "sample",
    )
    seen = sample.agg(F.min("label"), F.max("label")).first()
    if seen[0] is None or seen[0] == seen[1]:
        scored = ruled.withColumn("score", F.lit(float(seen[0] or 0.0)))
    else:
        assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
        trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=7, featuresCol="features", labelCol="label")
        fitted = trees.fit(assembler.transform(sample))
        scored = fitted.transform(assembler.transform(featured))
        scored = scored.withColumn("score", vector_to_array("probability")[1])
    learned = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    by_rule = F.when(F.col("rule").isin(blocked), "block").otherwise("allow")
    return scored.select(
        *(F.col(f"_{k}").alias(c) for k, c in enumerate(names)),
        "host",
        "path",
        "rule",
        F.when(F.col("rule").isNull(), learned).otherwise(by_rule).alias("verdict"),
        "score",
    )
