"""Mixing sources to target weights by repetition rates.

Words are counted per document and added up per source (map-side first, so a source with a third of all rows is no hot
task). The share of all words wanted is dealt to the sources by weight; no source is repeated more than `most` times, and
what is over that is dealt again by weight among the others until none is above. A source's rate is its target over its
size; each of its documents is taken floor(rate) times, and once more if a number in [0, 1) hashed from the seed and its
doc_id is under the rest. The seed is a parameter, so reruns agree, and equal rows are decided alike.

Defined results: a null text has no words and takes none; null is a source of its own, last in order; an empty table mixes
to an empty table; sources without words have target 0. plan() replaces columns of the input
with the names of its own, mix() keeps them as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import WORD, bounded_broadcast, free_name, materialize, set_aside

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
SEED = 20_240_601


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, weight, target) from (source, size).

    The level l at which sum(min(l * weight, most * size)) is the wanted total: with the sources in ascending order of
    size over weight, it is the first at which the words left, over the weights left, do not exceed the cap of the next.
    The windows run over one row for each source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    which = (F.row_number().over(order) - 1) % len(weights)
    per = per.withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), which))
    per = per.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    by = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    rest = by.rowsBetween(0, Window.unboundedFollowing)
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    wanted = F.sum("source_size").over(every) * F.lit(share)
    per = per.withColumn(
        "level", (wanted - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    ).withColumn("level", F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.col("level")))
    per = per.withColumn("level", F.max("level").over(every))
    target = F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("level") * F.col("weight")))
    return per.select("source", "source_size", "weight", target.alias("target"))


def uniform(key: Column, seed: int) -> Column:
    """A number in [0, 1) from the first 52 bits of md5(seed:key)."""
    digest = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))), 1, 13)
    return F.conv(digest, 16, 10).cast("double") / F.lit(float(1 << 52))


def plan(
    docs: DataFrame,
    weights: tuple = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    seed: int = SEED,
    id_col: str = "doc_id",
) -> DataFrame:
    """docs with size, source_size, target and copies (int). The texts stay where they are."""
    sizes = materialize(docs.select(F.col("source").cast("string").alias("source"), words(F.col("text")).alias("size")).groupBy("source").agg(F.sum("size").alias("size")))
    table = materialize(targets(sizes, weights, share, most))
    key = free_name(docs, "_source")
    table = table.select(F.col("source").alias(key), "source_size", "target")
    table = bounded_broadcast(table, table.count())
    out = docs.drop("size", "source_size", "target", "copies")
    out = out.join(table, out["source"].cast("string").eqNullSafe(table[key]), "left").drop(key)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(rate)
    copies = whole + (uniform(F.col(id_col), seed) < rate - whole).cast("int")
    return out.withColumns({"size": words(F.col("text")), "copies": copies.cast("int")})


def mix(docs: DataFrame, **how) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with the columns of docs."""
    own, back = set_aside(docs, ("size", "source_size", "target", "copies"))
    planned = plan(own, **how)
    n = free_name(planned, "_n")
    return back(planned.filter("copies > 0").withColumn(n, F.explode(F.sequence(F.lit(1), F.col("copies")))))
