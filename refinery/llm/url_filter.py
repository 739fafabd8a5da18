"""URL filter: rules, and gradient-boosted trees on lexical features for the rest.

Everything is DataFrame expressions and Spark ML.  A rule is written
``host/path``; it fits the host and its subdomains where the URL's path starts
with the rule's, and the longest rule that fits decides.  URLs that no rule
fits are judged by boosted trees over length, depth, digit ratio, entropy,
parameter counts and statistics of the host's suffix.  Suffix statistics count
all different labelled URLs; the trees are fitted on the ``FIT_ROWS`` of them,
half of each verdict, of smallest hash.  A URL in training does not see its own
verdict in its suffix's rate.  How often a URL is repeated changes nothing.

Defined results.  Null url, or none with ``://``: host and path are empty, no
rule fits.  No labelled URLs, or of one verdict only: that verdict, or allow.
Repeated rows: a row each.  Null page_id: kept.  Empty table: no row.  Other
columns are ignored.
"""

from __future__ import annotations

import string

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hash_sample, stored

FIT_ROWS = 10_000
TREES = 10
DEPTH = 4
SEED = 11
#: Strength of the overall block rate in a suffix's rate, in URLs.
PRIOR_ROWS = 20.0

FEATURES = ["length", "depth", "digit_ratio", "entropy", "n_params", "n_labels", "host_length", "path_length",
            "host_digit_ratio", "n_hyphens", "n_specials", "longest_segment", "suffix_share", "suffix_rate"]


def host() -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    found = F.regexp_extract(F.coalesce("url", F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, string.ascii_uppercase, string.ascii_lowercase)


def path() -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce("url", F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def with_rules(urls: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """Adds ``rule`` and ``rule_verdict``: the longest rule that fits, null if none does."""
    urls = urls.withColumn("host", host()).withColumn("path", path())
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, decision in sorted(rules, key=lambda r: len(r[0])):  # a longer one overrides
        rule_host, _, rule_path = name.partition("/")
        fits = (((F.col("host") == rule_host) | F.col("host").endswith("." + rule_host))
                & F.col("path").startswith("/" + rule_path))
        rule = F.when(fits, F.lit(name)).otherwise(rule)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return urls.withColumn("rule", rule).withColumn("rule_verdict", verdict)


def _count(text: Column, pattern: str) -> Column:
    """Characters of a class, by what is left without the others."""
    return F.length(F.regexp_replace(text, f"[^{pattern}]", ""))


def _share(n: Column, of: Column) -> Column:
    return F.when(of > 0, n / of).otherwise(0.0)


def _entropy(text: Column) -> Column:
    """Bits per character: over the distinct characters, counted by what their removal shortens."""
    n = F.length(text)

    def add(sum_: Column, c: Column) -> Column:
        p = (n - F.length(F.replace(text, c))) / n
        return sum_ - p * F.log2(p)

    letters = F.filter(F.array_distinct(F.split(text, "")), lambda c: c != "")
    return F.coalesce(F.aggregate(letters, F.lit(0.0), add), F.lit(0.0))


def lexical(urls: DataFrame) -> DataFrame:
    """Adds the lexical features and ``suffix``, the last two labels of the host."""
    url = F.coalesce("url", F.lit(""))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    segments = F.split("path", "/")
    n = F.length(url)
    return urls.select(
        "*", n.cast("double").alias("length"),
        F.size(F.filter(segments, lambda s: s != "")).cast("double").alias("depth"),
        _share(_count(url, "0-9"), n).alias("digit_ratio"), _entropy(url).alias("entropy"),
        F.size(F.filter(F.split(query, "&"), lambda s: s != "")).cast("double").alias("n_params"),
        F.size(F.split("host", r"\.")).cast("double").alias("n_labels"),
        F.length("host").cast("double").alias("host_length"), F.length("path").cast("double").alias("path_length"),
        _share(_count(F.col("host"), "0-9"), F.length("host")).alias("host_digit_ratio"),
        _count(url, r"\-").cast("double").alias("n_hyphens"),
        _count(url, r"_%~@+=&").cast("double").alias("n_specials"),
        F.array_max(F.transform(segments, F.length)).cast("double").alias("longest_segment"),
        F.substring_index("host", ".", -2).alias("suffix"))


class UrlModel:
    """Suffix statistics, as a table, and the boosted trees; ``trees`` is None where one verdict is all."""

    def __init__(self, suffixes: DataFrame, rows: int, rate: float, trees: GBTClassificationModel | None):
        self.suffixes, self.rows, self.rate, self.trees = suffixes, rows, rate, trees

    def features(self, urls: DataFrame) -> DataFrame:
        """``urls`` (with ``lexical``) and their suffix statistics; those with a ``label`` of the other URLs."""
        n, blocked = F.coalesce("suffix_n", F.lit(0)), F.coalesce("suffix_blocked", F.lit(0))
        if "label" in urls.columns:
            n, blocked = n - 1, blocked - F.col("label")
        return (urls.join(self.suffixes, "suffix", "left")
                .withColumn("suffix_share", n / F.lit(max(self.rows, 1)))
                .withColumn("suffix_rate", (blocked + PRIOR_ROWS * self.rate) / (n + PRIOR_ROWS)))

    def scored(self, urls: DataFrame) -> DataFrame:
        """Adds ``p_block``."""
        if self.trees is None:
            return urls.withColumn("p_block", F.lit(float(self.rate)))
        rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(self.features(urls))
        return self.trees.transform(rows).withColumn("p_block", vector_to_array("probability")[1])


def train(labelled: DataFrame) -> UrlModel:
    """A model from (url, host, path, verdict), verdict being allow or block."""
    rows = stored(labelled.filter(F.col("verdict").isin("allow", "block")).select(
        "url", "host", "path", (F.col("verdict") == "block").cast("double").alias("label")).distinct(), "url-labelled")
    suffixes = stored(lexical(rows).groupBy("suffix").agg(
        F.count(F.lit(1)).alias("suffix_n"), F.sum("label").alias("suffix_blocked")), "url-suffixes")
    n, blocked = suffixes.agg(F.sum("suffix_n"), F.sum("suffix_blocked")).first()
    if not n:
        return UrlModel(suffixes, 0, 0.0, None)
    model = UrlModel(suffixes, n, blocked / n, None)
    if blocked in (0, n):
        return model
    each = [hash_sample(rows.filter(F.col("label") == label), ["url"], FIT_ROWS // 2) for label in (0.0, 1.0)]
    sample = lexical(each[0].unionByName(each[1]))
    ready = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(
        model.features(sample)).select("features", "label")
    ready = stored(ready.repartition(4), "url-training")
    model.trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=SEED).fit(ready)
    return model


def judge(urls: DataFrame, rules: list[tuple[str, str]], model: UrlModel | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict, p_block) of (page_id, url).

    Without a model, one is trained from the URLs that the rules label.
    """
    ruled = with_rules(urls.select("page_id", "url"), rules)
    if model is None:
        model = train(ruled.filter("rule is not null").select("url", "host", "path", F.col("rule_verdict").alias("verdict")))
    scored = model.scored(lexical(ruled))
    by_method = F.when(F.col("p_block") > 0.5, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule",
                         F.coalesce("rule_verdict", by_method).alias("verdict"), "p_block")
