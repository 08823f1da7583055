"""Canonical exact digest of a document, and exact grouping by it.

Canonical form: Unicode compatibility composition (NFKC), default case folding, then every run of white space to one
space, without spaces at either end. The fingerprint is two chained 64-bit xxhash values of it as 32 hex digits. Documents
of one fingerprint are compared byte for byte in canonical form with one member, so a collision never joins two texts.

Native: SQL functions only. The two Unicode steps are static methods of a library on Spark's class path, called with the
SQL function `reflect`; a text of ASCII characters alone skips them.

Defined results: a null text counts as empty; empty texts are equal. Null ids are allowed, sort last, and such rows are
grouped like others; a group whose ids are all null has a null group_id.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import bounded_broadcast, free_name, materialize, text_or_empty

NFKC = ("com.ibm.icu.text.Normalizer", "compose")
FOLD = ("com.ibm.icu.lang.UCharacter", "foldCase")
#: Rows that a bucket of next_document holds on average, and the most buckets (the boundaries are a literal of the plan).
BUCKET_ROWS, MOST_BUCKETS = 2_000, 65_536
#: Members of a group that meet its head in one place.
PART_ROWS = 256


def require_library(spark: SparkSession) -> None:
    """Fail at once, and plainly, where the Unicode library is not on Spark's class path."""
    try:
        spark.range(1).select(F.reflect(F.lit(FOLD[0]), F.lit(FOLD[1]), F.lit("A"), F.lit(True))).schema  # noqa: B018
    except Exception as e:
        raise RuntimeError(f"the canonical form needs the class {FOLD[0]}, which Spark's own jars hold (icu4j)") from e


def canonical(text: Column) -> Column:
    call = lambda method, value: F.reflect(F.lit(method[0]), F.lit(method[1]), value, F.lit(True))
    text = F.coalesce(text, F.lit(""))
    # folding can undo composition, so compose again after it
    folded = F.when(text.rlike(r"[^\x00-\x7F]"), call(NFKC, call(FOLD, call(NFKC, text)))).otherwise(F.lower(text))
    return F.trim(F.regexp_replace(folded, r"[\s\x{85}\p{Z}]+", " "))


def fingerprint_of(form: Column) -> Column:
    """32 hex digits of a canonical form."""
    part = lambda value: F.lpad(F.lower(F.hex(value)), 16, "0")
    return F.concat(part(F.xxhash64(form)), part(F.xxhash64(F.lit(1), form)))


def fingerprint(text: Column) -> Column:
    return fingerprint_of(canonical(text))


def exact_groups(docs: DataFrame, prints: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint, group_id, group_size) for each row; group_id is the smallest id of a byte-equal canonical text.

    Ids and fingerprints are aggregated map-side first; texts move only for members of fingerprints that occur more than
    once. Where those are few (checked) they are broadcast and no text is shuffled but theirs. prints: (id, fingerprint)
    of docs where it is at hand already.
    """
    i, t = F.col(id_col), text_or_empty(text_col)
    require_library(docs.sparkSession)
    if prints is None:
        prints = materialize(docs.select(i.alias("id"), fingerprint(t).alias("fingerprint")))
    seen = prints.groupBy("fingerprint").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    many = materialize(seen.filter("n > 1"))
    rows = many.count()
    few = bounded_broadcast(many, rows)
    heads = many.select(F.col("first").alias("id"), F.col("fingerprint").alias("head_of"))
    form = docs.select(i.alias("id"), canonical(t).alias("form"))
    first_form = form.join(bounded_broadcast(heads, rows), "id").groupBy("head_of").agg(F.min("form").alias("head_form"))
    members = form.withColumn("fingerprint", fingerprint_of(F.col("form"))).join(few, "fingerprint")
    # a large group is dealt over parts, each with the head's form, so that none is one task
    parts = F.ceil(F.col("n") / PART_ROWS).cast("int")
    members = members.withColumn("part", F.pmod(F.xxhash64("id"), parts).cast("int"))
    first_form = first_form.join(few.select(F.col("fingerprint").alias("head_of"), "n"), "head_of")
    first_form = first_form.select(F.col("head_of"), "head_form", F.explode(F.sequence(F.lit(0), parts - 1)).alias("head_part"))
    compared = members.join(first_form, (members["fingerprint"] == first_form["head_of"]) & (members["part"] == first_form["head_part"]), "left")
    # members that differ from the compared one: a collision, grouped exactly by their bytes
    odd = materialize(
        compared.filter(~F.col("form").eqNullSafe(F.col("head_form")) & F.col("first").isNotNull()).select("id", "fingerprint", "form")
    )
    out = prints.join(few, "fingerprint", "left").select(
        "id", "fingerprint", F.coalesce("first", "id").alias("group_id"), F.coalesce("n", F.lit(1)).alias("group_size")
    )
    if odd.isEmpty():
        return out.withColumnRenamed("id", id_col)
    apart = odd.groupBy("fingerprint", "form").agg(F.min("id").alias("own"), F.count(F.lit(1)).alias("own_n"))
    lost = apart.groupBy("fingerprint").agg(F.sum("own_n").alias("lost"))
    odd_ids = odd.join(apart, ["fingerprint", "form"]).select(F.col("id").alias("odd_id"), "own", "own_n", F.col("fingerprint").alias("odd_f")).distinct()
    out = out.join(lost, "fingerprint", "left").join(odd_ids, (out["id"] == F.col("odd_id")) & (out["fingerprint"] == F.col("odd_f")), "left")
    return out.select(
        F.col("id").alias(id_col), "fingerprint", F.coalesce("own", "group_id").alias("group_id"),
        F.coalesce("own_n", F.col("group_size") - F.coalesce("lost", F.lit(0))).alias("group_size"),
    )


def _bucket(key: Column, bounds: list[int]) -> Column:
    """How many of the ascending bounds are under key, by binary lifting over one literal array; null counts as lowest."""
    if not bounds:
        return F.lit(0)
    listed = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<bigint>")
    jumps = [1 << k for k in range(int(math.log2(len(bounds))), -1, -1)]
    found = F.aggregate(
        F.array(*map(F.lit, jumps)),
        F.lit(0),
        lambda at, jump: F.when((at + jump <= len(bounds)) & (F.get(listed, at + jump - 1) < key), at + jump).otherwise(at),
    )
    return F.when(key.isNull(), F.lit(0)).otherwise(found)


def next_document(docs: DataFrame, carry: list[str], id_col: str = "doc_id", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """docs with next_<c> for each column of carry: its value in the next row, descending id, the first row after the last.

    No total order in one task: quantiles of the ids bound buckets of about bucket_rows rows, a window runs within each,
    and the row at each bound is copied as a guest to the end of the bucket above it. Equal ids are ordered by the
    carried values.
    """
    n, most = docs.select(F.count(id_col), F.max(id_col)).first()
    buckets = min(MOST_BUCKETS, max(1, n // bucket_rows))
    bounds = []
    if n:
        cuts = [k / buckets for k in range(1, buckets)]
        found = docs.select(F.percentile_approx(id_col, F.array(*map(F.lit, cuts)), F.lit(max(10_000, 20 * buckets)))).first()[0] if cuts else []
        bounds = sorted({*found, most})
    b, guest = free_name(docs, "_bucket"), free_name(docs, "_guest")
    key = F.col(id_col)
    at = _bucket(key, bounds)
    rows = docs.withColumn(b, at)
    if bounds:
        # bound number k is the highest id of bucket k, so it follows the last row of bucket k + 1; that of the last bucket follows bucket 0
        inside = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<bigint>")
        above = F.when(F.col(b) == len(bounds) - 1, F.lit(0)).otherwise(F.col(b) + 1)
        is_bound = F.coalesce(F.get(inside, F.col(b)) == key, F.lit(False))
        both = F.array(F.struct(F.col(b).alias("b"), F.lit(0).alias("g")), F.struct(above.alias("b"), F.lit(1).alias("g")))
        rows = rows.withColumn(guest, F.explode(F.when(is_bound, both).otherwise(F.slice(both, 1, 1))))
        rows = rows.withColumns({b: F.col(guest)["b"], guest: F.col(guest)["g"]})
    else:
        rows = rows.withColumn(guest, F.lit(0))
    w = Window.partitionBy(b).orderBy(F.col(guest), key.desc_nulls_last(), *[F.col(c) for c in carry])
    ahead = {f"next_{c}": F.coalesce(F.lead(c).over(w), F.first(c).over(w)) for c in carry}
    return rows.withColumns(ahead).filter(F.col(guest) == 0).drop(b, guest)


def edited(text: Column, n_chars: Column, following: Column) -> Column:
    """text with its last floor(n_chars / 3) characters replaced by the first as many of the following text."""
    cut = F.floor(n_chars / 3).cast("int")
    return F.concat(F.substr(text, F.lit(1), n_chars.cast("int") - cut), F.substr(following, F.lit(1), cut))
