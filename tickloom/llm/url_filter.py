"""URL verdicts: host and path rules first, a logistic regression on character n-grams for the rest."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import stored

BLOCK, ALLOW = "block", "allow"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """From after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Iterable[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls. ``rules``: verdict and host with path, as in ``net/``.

    The rules are few and fixed; their conditions become one expression,
    longest rule first, so no join is needed.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda item: (len(item[1]), item[1])):
        own_host, _, rest = text.partition("/")
        fits = ((host == own_host) | host.endswith("." + own_host)) & path.startswith("/" + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def grams(host: Column, path: Column, sizes: Iterable[int] = (3, 4, 5)) -> Column:
    """Character n-grams of host and path, each marked with the part it comes from; ``^`` and ``$`` mark the ends."""
    parts = []
    for mark, part in (("h", host), ("p", path)):
        framed = F.concat(F.lit("^"), part, F.lit("$"))
        for size in sizes:
            # A sequence must not run backwards, so short parts take the part itself.
            last = F.greatest(F.length(framed) - (size - 1), F.lit(1))
            parts.append(F.transform(F.sequence(F.lit(1), last), _gram(mark, framed, size)))
    return F.concat(*parts)


def _gram(mark: str, framed: Column, size: int):
    return lambda place: F.concat(F.lit(mark), framed.substr(place, F.lit(size)))


def featured(urls: DataFrame, dimensions: int) -> DataFrame:
    """Adds the hashed n-gram indicators of columns host and path."""
    return HashingTF(inputCol="_grams", outputCol="_features", numFeatures=dimensions, binary=True).transform(
        urls.withColumn("_grams", grams(F.col("host"), F.col("path")))).drop("_grams")


def labelled_sample(urls: DataFrame, bound: int) -> DataFrame:
    """At most ``bound`` distinct labelled (host, path, label) of each label, chosen by hash: a small table whatever the input."""
    parts = []
    for label in (0.0, 1.0):
        own = urls.where(F.col("label") == label).select("host", "path", "label").distinct()
        parts.append(own.orderBy(F.xxhash64("host", "path"), "host", "path").limit(bound))
    return parts[0].unionByName(parts[1])


def fit(sample: DataFrame, dimensions: int, regularization: float) -> LogisticRegressionModel | None:
    """The model, or None when the sample lacks a label."""
    if sample.select("label").distinct().count() < 2:
        return None
    return LogisticRegression(featuresCol="_features", labelCol="label", probabilityCol="_probability", rawPredictionCol="_raw",
                              predictionCol="_prediction", maxIter=50, regParam=regularization).fit(featured(sample, dimensions))


def judge(pages: DataFrame, rules: Iterable[tuple[str, str]], id_col: str = "page_id", url_col: str = "url",
          labelled: DataFrame | None = None, sample_bound: int = 2000, dimensions: int = 1 << 14,
          regularization: float = 1e-3, block_from: float = 0.5) -> DataFrame:
    """Verdict per URL: (id, host, path, rule, block_score, verdict).

    Where a rule fits, the longest decides. Elsewhere a logistic regression
    decides on hashed character n-grams of host and path: block from
    ``block_from`` on. It is fitted on a small labelled URL table (url, label;
    1 means block), by default the URLs that the rules themselves settle; at
    most ``sample_bound`` distinct URLs of each label take part, chosen by
    hash. Nothing else depends on the sample, and all rows are judged in the
    task that reads them.

    A null URL, or one without ``://``, has empty host and path and is
    judged by the model. When a label is missing from the table, every
    unruled URL is allowed. Repeated rows are judged each for itself, a null
    id stays null, other columns are ignored, no rows give no rows.
    """
    rules = list(rules)
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    rows = rows.select("id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "_ruled": verdict})
    if labelled is None:
        known = rows.where("_ruled is not null").select("host", "path", (F.col("_ruled") == BLOCK).cast("double").alias("label"))
    else:
        known = labelled.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), F.col("label").cast("double"))
    # Stored, so that the steps of the fit read the small table and not the pages.
    model = fit(stored(labelled_sample(known, sample_bound), "url-sample"), dimensions, regularization)
    if model is None:
        scored = rows.withColumn("block_score", F.lit(0.0))
    else:
        scored = model.transform(featured(rows, dimensions)).withColumn("block_score", vector_to_array("_probability")[1])
    method = F.when(F.col("block_score") >= block_from, F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return scored.select(F.col("id").alias(id_col), "host", "path", "rule", "block_score",
                         F.coalesce("_ruled", method).alias("verdict"))
