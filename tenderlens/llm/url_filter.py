"""URL filter: host and path rules, and logistic regression on hashed character n-grams (DataFrame functions only)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii

#: (verdict, host, path prefix)
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: At most so many distinct labelled urls train the classifier.
MAX_LABELLED = 4000


def host_of(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def match_rules(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, NULL without one. A rule fits its host and all subdomains."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def grams(chars: Column, sizes: Sequence[int] = (2, 3, 4)) -> Column:
    """Character n-grams of an array of characters (an attribute, not an expression); linear in its length."""
    places = F.transform(chars, lambda c, i: i)

    def windows(k: int) -> Column:
        starts = F.slice(places, F.lit(1), F.greatest(F.size(chars) - (k - 1), F.lit(0)))
        return F.transform(starts, lambda i: F.concat(*[F.get(chars, i + j) for j in range(k)]))

    return F.concat(*[windows(k) for k in sizes])


def _featurised(df: DataFrame, features: int) -> DataFrame:
    """Adds vector ``_x``. ``^host path$`` marks both ends, so the same letters differ in host and path."""
    marked = F.concat(F.lit("^"), F.col("_host"), F.lit(" "), F.col("_path"), F.lit("$"))
    out = df.withColumn("_chars", F.split(marked, "")).withColumn("_grams", grams(F.col("_chars")))
    return HashingTF(numFeatures=features, inputCol="_grams", outputCol="_x").transform(out).drop("_chars", "_grams")


def url_filter(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: Sequence[tuple[str, str, str]] = RULES,
    labelled: DataFrame | None = None,
    max_labelled: int = MAX_LABELLED,
    features: int = 1 << 12,
    threshold: float = 0.5,
) -> DataFrame:
    """One row per input row: id, ``host``, ``path``, ``rule``, ``verdict``, ``score`` (probability of block).

    The longest rule that fits decides. Other urls are judged by logistic regression over hashed character n-grams,
    trained on ``labelled`` (url, verdict) or, without it, on the urls of ``pages`` that rules decide: of their distinct
    (host, path, verdict), the ``max_labelled`` with the smallest hash. A NULL url or one without ``://`` has empty host
    and path and gets the model's verdict on them. With one class of label, that class is the verdict where no rule
    fits (``score`` 0 or 1); without labels it is allow. Repeated rows give repeated results; other columns are ignored.
    """
    rule, verdict = match_rules(F.col("_host"), F.col("_path"), rules)
    split = {"_host": host_of(F.col("_url")), "_path": path_of(F.col("_url"))}
    parsed = pages.select(F.col(id_col), F.col(url_col).cast("string").alias("_url")).withColumns(split)
    parsed = parsed.withColumns({"_rule": rule, "_verdict": verdict})
    if labelled is None:
        known = parsed.where("_verdict is not null")
    else:
        known = labelled.select(F.col("url").cast("string").alias("_url"), F.col("verdict").alias("_verdict")).withColumns(split)
        known = known.where(F.col("_verdict").isin("allow", "block"))
    order = [F.xxhash64("_host", "_path", "_verdict"), "_host", "_path", "_verdict"]
    # A stated, bounded sample (max_labelled urls of at most some hundred bytes), so it may be held as local rows.
    rows = known.select("_host", "_path", "_verdict").distinct().orderBy(*order).limit(max_labelled).collect()
    classes = {r["_verdict"] for r in rows}
    if len(classes) < 2:
        certain = 1.0 if classes == {"block"} else 0.0
        scored = parsed.withColumn("score", F.lit(certain))
    else:
        spark = pages.sparkSession
        sample = spark.createDataFrame(rows, "_host string, _path string, _verdict string").coalesce(1)
        sample = _featurised(sample, features).select("_x", (F.col("_verdict") == "block").cast("double").alias("_y"))
        fit = LogisticRegression(featuresCol="_x", labelCol="_y", maxIter=60, regParam=1e-3, standardization=False)
        model = fit.fit(sample)
        model.setFeaturesCol("_x").setProbabilityCol("_p").setRawPredictionCol("").setPredictionCol("")
        scored = model.transform(_featurised(parsed, features)).withColumn("score", vector_to_array("_p")[1]).drop("_p", "_x")
    judged = F.when(F.col("score") >= threshold, "block").otherwise("allow")
    return scored.select(
        F.col(id_col),
        F.col("_host").alias("host"),
        F.col("_path").alias("path"),
        F.col("_rule").alias("rule"),
        F.coalesce("_verdict", judged).alias("verdict"),
        "score",
    )
