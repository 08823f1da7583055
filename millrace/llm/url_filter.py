"""URL filter: host and path rules first, then logistic regression on hashed character n-grams.

Rules are few and stated by the caller (a handful to some hundred), so they compile to one CASE expression; the model is
trained on a small labelled URL table and applied with the same Spark ML stages. No shuffle: every row is judged where it is.

Defined results: a null url, or one without "://", has an empty host and path, fits no rule and gets the verdict of the
model on no features. Repeated rows are judged alike. Columns of the input named host, path, rule, verdict or score are
replaced; all others are kept. A very long url costs time in proportion to its length.
"""

from __future__ import annotations


from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import free_name

#: (verdict, rule): host, then path from its first slash.
RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]

#: The labelled URL table for training, 1 = block.
BLOCKED = """
https://casino-royale.example.com/en/12            http://www.online-casino.example.net/de/408
https://win-big-casino.example.org/fr/77?ref=x     http://m.poker-slots.example.com/en/5
https://www.free-slots.example.net/en/901.html     https://sports-bets.example.org/es/31
http://best-bets.example.com/en/66#top             https://free-bonus.example.net/en/213
https://lucky-win.example.com/de/18                http://jackpot-win.example.org/en/840
https://cheap-meds.example.com/en/3                https://www.cheap-watches.example.org/fr/590
http://buy-pills.example.net/en/71                 https://diet-pills.example.com/es/44
https://pills-online.example.org/en/333            http://cheap-loans.example.net/en/128
https://payday-loans.example.com/en/9              https://ads-server.example.net/en/650
http://banner-ads.example.com/en/21?page=2         https://click-track.example.org/en/92
https://pixel-track.example.net/de/704             http://ad-tracker.example.com/fr/8
https://link-farm.example.net/en/555               http://seo-farm.example.com/en/87
https://spam-links.example.org/es/260              https://mass-spam.example.com/en/14
http://www.spam-mail.example.net/en/499            https://free-money.example.com/en/1
http://free-gifts.example.org/en/370               https://hot-deals-cheap.example.com/en/62
"""
ALLOWED = """
https://blog.gardening.example.com/en/41           http://www.history.example.net/de/230
https://m.weather.example.org/en/77#top            https://library.example.com/fr/815
http://blog.thermal.example.net/en/960             https://www.therapy.example.com/en/148.html
https://museum.example.org/es/978?page=2           http://another.example.net/en/453
https://breathing.example.com/en/12                http://blog.mathematics.example.net/en/66
https://www.nations.example.org/en/901             https://stations.example.net/es/31
http://m.leather.example.com/en/5                  https://northern.example.org/en/213/
https://blog.southern.example.com/de/18            http://gathering.example.net/en/840
https://weathering.example.com/en/3                https://www.interior.example.org/fr/590
http://articles.example.net/en/71                  https://blog.thinking.example.com/es/44
https://lantern.example.org/en/333                 http://cooking.example.net/en/128?utm_source=feed
https://wiki.rivers.example.com/en/9               https://news.harbour.example.net/en/650
http://docs.tables.example.com/en/21               https://blog.stitching.example.org/en/92
https://theatre.example.net/de/704                 http://blog.earth.example.com/fr/8
https://www.reading.example.net/en/555             http://them.thoughts.example.com/en/87
"""

N_FEATURES = 1 << 15
SIZES = (3, 4)


def seed_urls(spark: SparkSession) -> DataFrame:
    """The labelled table (url, label) that ships with the filter: 60 rows."""
    listed = lambda text, label: spark.range(1).select(
        F.explode(F.split(F.lit(" ".join(text.split())), " ")).alias("url"), F.lit(label).alias("label")
    )
    return listed(BLOCKED, 1.0).unionByName(listed(ALLOWED, 0.0))


def url_host(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_column(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """struct(rule, verdict) of the longest rule that fits; fields null where none does."""
    chosen = F.struct(F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        at, slash, rest = rule.partition("/")
        fits = ((host == at) | host.endswith(f".{at}")) & path.startswith(slash + rest)
        chosen = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def _grams(text: Column, mark: str) -> Column:
    """Marked character n-grams of ^text$, found by an overlapping pattern in linear time."""
    framed = F.concat(F.lit("^"), text, F.lit("$"))
    found = [F.regexp_extract_all(framed, F.lit(f"(?s)(?=(.{{{k}}}))"), F.lit(1)) for k in SIZES]
    return F.transform(F.concat(*found), lambda g: F.concat(F.lit(mark), g))


def with_features(df: DataFrame, host: str, path: str, grams: str, out: str) -> DataFrame:
    empty = F.array().cast("array<string>")
    both = F.concat(
        F.when(F.col(host) != "", _grams(F.col(host), "h:")).otherwise(empty),
        F.when(F.col(path) != "", _grams(F.col(path), "p:")).otherwise(empty),
    )
    tf = HashingTF(inputCol=grams, outputCol=out, numFeatures=N_FEATURES, binary=True)
    return tf.transform(df.withColumn(grams, both))


def train(labelled: DataFrame, url_col: str = "url", label_col: str = "label") -> LogisticRegressionModel | None:
    """Fit on a small labelled table; null urls and labels are left out. None if it does not hold both labels."""
    rows = labelled.select(F.col(url_col).alias("url"), F.col(label_col).cast("double").alias("label")).dropna()
    if rows.select("label").distinct().limit(2).count() < 2:
        return None
    rows = rows.select("label", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path")).coalesce(1)
    rows = with_features(rows, "host", "path", "grams", "features")
    return LogisticRegression(maxIter=60, regParam=0.02, featuresCol="features", labelCol="label").fit(rows)


def filter_urls(
    df: DataFrame,
    labelled: DataFrame | None = None,
    rules: list[tuple[str, str]] = RULES,
    url_col: str = "url",
    threshold: float = 0.5,
) -> DataFrame:
    """df with host, path, rule, verdict and score (the model's probability that the url is to be blocked).

    The verdict is the longest fitting rule's, else block where score > threshold (no model: allow, score null).
    """
    model = train(labelled if labelled is not None else seed_urls(df.sparkSession))
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    hit = free_name(df, "_fit")
    out = df.withColumns({"host": url_host(url), "path": url_path(url)})
    out = out.withColumn(hit, rule_column(F.col("host"), F.col("path"), rules))
    if model is None:
        out = out.withColumn("score", F.lit(None).cast("double"))
    else:
        names = [free_name(out, n) for n in ("_grams", "_features", "_raw", "_probability", "_prediction")]
        model = model.setFeaturesCol(names[1]).setRawPredictionCol(names[2]).setProbabilityCol(names[3]).setPredictionCol(names[4])
        out = model.transform(with_features(out, "host", "path", names[0], names[1]))
        out = out.withColumn("score", F.get(vector_to_array(names[3]), 1)).drop(*names)
    blocked = F.when(F.col("score") > threshold, "block").otherwise("allow")
    return out.withColumns(
        {"rule": F.col(hit)["rule"], "verdict": F.coalesce(F.col(hit)["verdict"], blocked)}
    ).drop(hit)


