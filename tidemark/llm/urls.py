"""URL verdicts: rules by host and path, and gradient-boosted trees on lexical features for the rest.

Features: length, depth, share of digits, entropy of the characters, number of parameters, hyphens and labels, and
statistics of the host's suffix (its last two labels): how many URLs have it, and which share of them is blocked. That
share is taken from the other folds of the URLs, so that no label tells on itself, and URLs without a label count at the overall
share, so that a few labelled pages do not speak for a whole suffix. Only DataFrame functions and Spark's own trees are used.

Defined results: a null URL, or one without ``://``, has an empty host and path, fits no rule and is judged by its features
like any other. Among rules that fit, the longest wins; of equally long ones the first in the list. Without labelled
URLs of both kinds there is nothing to learn, and the verdict is that of most labelled URLs, or "allow". Repeated rows
are judged alike. Other columns are not looked at.
"""

from __future__ import annotations

import string

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import query, table
from tidemark.session import cut_lineage

#: The rules of the query, as (verdict, host and path).
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
FEATURES = ("f_length", "f_depth", "f_digits", "f_entropy", "f_parameters", "f_hyphens", "f_labels", "f_common", "f_blocked")
TREES, DEPTH = 15, 4
#: Folds of the URLs, and URLs that every suffix has besides its own, at the overall share.
FOLDS, PRIOR = 5, 20.0


def parsed(urls: DataFrame, url: str, host: str, path: str) -> DataFrame:
    """``urls`` with the host, A-Z in lower case, and the path of each URL."""
    found = F.locate("://", F.col(url))
    rest = F.when(found > 0, F.substr(F.col(url), found + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    lower = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return urls.withColumns({host: lower, path: F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)})


def best_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict; null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # Wrapped from the shortest to the longest, so the longest is tested first.
    for decision, text in sorted(reversed(rules), key=lambda entry: len(entry[1])):
        own, slash, rest = text.partition("/")
        fits = ((host == own) | F.endswith(host, F.lit("." + own))) & F.startswith(path, F.lit(slash + rest))
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(decision)).otherwise(verdict)
    return rule, verdict


def entropy(text: Column) -> Column:
    """Bits per character."""
    n = F.length(text)

    def share(total: Column, character: Column) -> Column:
        count = n - F.length(F.replace(text, character, F.lit("")))
        return total + F.when(count > 0, count * F.log2(count / n)).otherwise(0.0)

    different = F.array_remove(F.array_distinct(F.split(text, "")), "")
    return F.when(n > 0, -F.aggregate(different, F.lit(0.0), share) / n).otherwise(0.0)


def _count(text: Column, character: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(character), F.lit("")))).cast("double")


def suffix_of(host: Column) -> Column:
    return F.substring_index(host, ".", -2)


def lexical(urls: DataFrame, url: str, host: str, path: str) -> DataFrame:
    """``urls`` with the features that need no other rows."""
    text = F.coalesce(F.col(url), F.lit(""))
    n = F.length(text)
    digits = F.length(F.regexp_replace(text, "[^0-9]", ""))
    return urls.withColumns(
        {
            "f_length": n.cast("double"),
            "f_depth": _count(F.col(path), "/"),
            "f_digits": F.when(n > 0, digits / n).otherwise(0.0),
            "f_entropy": entropy(text),
            "f_parameters": _count(text, "="),
            "f_hyphens": _count(F.col(host), "-"),
            "f_labels": _count(F.col(host), "."),
        }
    )


def fold_of(url: Column) -> Column:
    """Equal URLs are in one fold."""
    return F.pmod(F.xxhash64(F.coalesce(url, F.lit(""))), F.lit(FOLDS)).cast("int")


def suffix_statistics(urls: DataFrame) -> DataFrame:
    """(suffix, fold, f_common, f_blocked) from (suffix, fold, label), where label is null for URLs without one.

    ``f_blocked`` of a fold is the share of blocked URLs of the suffix in the other folds, ``PRIOR`` URLs and those without a
    label counting at the overall share. Counts are summed by suffix and fold first, so a suffix that most URLs have is
    ``FOLDS`` rows.
    """
    counted = urls.groupBy("suffix", "fold").agg(F.count("*").alias("n"), F.count("label").alias("seen"), F.sum("label").alias("blocked"))
    counted = cut_lineage(counted.withColumn("blocked", F.coalesce("blocked", F.lit(0))))
    overall = counted.agg(F.sum("seen").alias("seen"), F.sum("blocked").alias("blocked")).first()
    base = ((overall["blocked"] or 0) + 0.5) / ((overall["seen"] or 0) + 1.0)
    total = counted.groupBy("suffix").agg(*(F.sum(name).alias(f"all_{name}") for name in ("n", "seen", "blocked")))
    n, seen, blocked = (F.col(f"all_{name}") - F.col(name) for name in ("n", "seen", "blocked"))
    share = (blocked + (n - seen + PRIOR) * base) / (n + PRIOR)
    return counted.join(total, "suffix").select("suffix", "fold", F.log1p("all_n").alias("f_common"), share.alias("f_blocked"))


def featured(urls: DataFrame, url: str, label: Column) -> DataFrame:
    """``urls`` (which have columns host, path) with all features, ``label`` (1 or 0 for labelled URLs, else null) and ``fold``."""
    marked = lexical(urls, url, "host", "path").withColumns({"suffix": suffix_of(F.col("host")), "label": label, "fold": fold_of(F.col(url))})
    statistics = cut_lineage(suffix_statistics(marked.select("suffix", "fold", "label")))
    return marked.join(statistics, ["suffix", "fold"]).withColumn("label", F.col("label").cast("double"))


def _sample(urls: DataFrame, url: str, rows: int) -> DataFrame:
    """At most ``rows`` labelled URLs, chosen by hash."""
    found = urls.where(F.col("label").isNotNull()).orderBy(F.xxhash64(url), url).limit(rows)
    return cut_lineage(found.select("label", "fold", *FEATURES))


def _gather() -> VectorAssembler:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features")


def grown(sample: DataFrame, trees: int = TREES):
    """Trees over labelled URLs of both kinds; None without both."""
    if len(sample.select("label").distinct().collect()) < 2:
        return None
    model = GBTClassifier(labelCol="label", maxIter=trees, maxDepth=DEPTH, maxBins=32, seed=7, predictionCol="blocked")
    return model.fit(_gather().transform(sample.coalesce(4)).select("features", "label"))


def judge(urls: DataFrame, url: str, label: Column, rows: int = 20_000, trees: int = TREES) -> DataFrame:
    """``urls`` (which have columns host, path) with a column ``blocked``: 1.0 if the trees say so.

    The trees are grown on at most ``rows`` labelled URLs; the suffix statistics are over all URLs.
    """
    full = featured(urls, url, label)
    sample = _sample(full, url, rows)
    model = grown(sample, trees)
    if model is None:
        only = sample.select("label").first()
        return urls.withColumn("blocked", F.lit(only["label"] if only else 0.0))
    return model.transform(_gather().transform(full)).select(*urls.columns, "blocked")


def held_out(urls: DataFrame, url: str, label: Column, rows: int = 20_000) -> tuple[float, dict[str, float]]:
    """How many labelled URLs of the first fold trees grown on the other folds judge rightly, and the share that each feature
    has in what these trees decide."""
    sample = _sample(featured(urls, url, label), url, rows)
    model = grown(sample.where("fold <> 0"))
    if model is None:
        return float("nan"), {}
    judged = model.transform(_gather().transform(sample.where("fold = 0")))
    right = judged.agg(F.avg((F.col("blocked") == F.col("label")).cast("double"))).first()[0]
    return right, dict(zip(FEATURES, model.featureImportances.toArray().tolist()))


def label_of(decided: Column) -> Column:
    return F.when(decided == "block", 1).when(decided == "allow", 0)


def verdicts(pages: DataFrame, rules=RULES, url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule and verdict. URLs that a rule decides are the labelled ones."""
    found = parsed(pages.select("page_id", F.col(url).alias("url")), "url", "host", "path")
    rule, verdict = best_rule(F.col("host"), F.col("path"), rules)
    found = found.withColumns({"rule": rule, "decided": verdict})
    judged = judge(found, "url", label_of(F.col("decided")))
    method = F.when(F.col("blocked") >= 0.5, "block").otherwise("allow")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("decided", method).alias("verdict"))


@query("op10_urls")
def op10_urls(spark: SparkSession, folder: str) -> DataFrame:
    return verdicts(table(spark, folder, "pages").select("page_id", "url"))
