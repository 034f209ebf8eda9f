"""Mixing sources to target weights by weighted sampling without replacement (operator 2, DataFrame functions only).

Each document gets the exponential key ``-ln(u) / w``: ``u`` is a uniform number drawn from a hash of its id and the
seed, ``w`` its quality weight. In every source the documents with the smallest keys are taken first, which is
Efraimidis-Spirakis sampling. A target above a source's size is met by complete epochs of the source; what is left is
a budget of words that is filled along the keys.

The order is never built whole. Sizes are summed by source and key bucket (combined before the shuffle); running sums
over those buckets show the one bucket in which the budget ends, and only its documents are sorted. The outcome is one
row per source (a cut point), so documents themselves are not shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, cut, prepare, table

SEED, BUCKETS = 17, 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def letter_weight(text: Column) -> Column:
    """Default quality weight, 0.5 to 1.5: a half more than the share of letters in the text."""
    n = F.length(F.regexp_replace(text, r"[^\p{L}]+", ""))
    return F.coalesce(F.lit(0.5) + n.cast("double") / F.greatest(F.length(text), F.lit(1)), F.lit(0.5))


def _keyed(docs: DataFrame, weight: Column, seed: int, buckets: int) -> DataFrame:
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    u = (F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("double") + 0.5) / float(2 ** 52)
    return (docs.withColumn("_size", word_count(F.col("text")))
            .withColumn("_key", -F.log(u) / weight)
            .withColumn("_bucket", F.floor((1 - F.exp(-F.col("_key"))) * buckets)))


def source_targets(sizes: DataFrame, weights=(5, 2, 1), cap: float = 3.0) -> DataFrame:
    """Adds ``target`` to one row per source (source, source_size).

    Sources in code-point order, null last, weigh ``weights`` in turn and share the sum of all sizes. No target exceeds
    ``cap`` times its source; the excess goes to the others by weight. That water level has a closed form: sorted by
    size over weight, the first k sources are full, and the rest share what is left.
    """
    every = Window.partitionBy()
    order = every.orderBy(F.col("source").isNull(), "source")
    fill = every.orderBy("_ratio", F.col("source").isNull(), "source")
    done = fill.rowsBetween(Window.unboundedPreceding, -1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    left = F.sum("source_size").over(every) - F.coalesce(F.sum(F.col("source_size") * cap).over(done), F.lit(0.0))
    share = F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(done), F.lit(0.0))
    full = F.col("_level") >= F.col("_ratio")
    return (sizes.withColumn("_w", weight).withColumn("_ratio", F.col("source_size") * cap / F.col("_w"))
            .withColumn("_level", left / share)
            .withColumn("_open", F.min(F.when(~full, F.struct("_ratio", "_level"))).over(every)["_level"])
            .withColumn("target", F.when(full, F.col("source_size") * cap).otherwise(F.col("_open") * F.col("_w")))
            .select("source", "source_size", "target"))


def _plan(slim: DataFrame, weights, cap: float) -> DataFrame:
    """One row per source: its target, complete epochs and the point up to which the keys are taken once more."""
    sizes = slim.groupBy("source").agg(F.sum("_size").alias("source_size"))
    cap_n = int(cap)
    sources = cut(source_targets(sizes, weights, cap)
                  .withColumn("epochs", F.when(F.col("source_size") > 0, F.least(
                      F.floor(F.col("target") / F.col("source_size")), F.lit(cap_n))).otherwise(F.lit(0)).cast("long"))
                  .withColumn("_budget", F.when(F.col("epochs") >= cap, 0.0).otherwise(
                      F.col("target") - F.col("epochs") * F.col("source_size"))), "sources")
    by_bucket = slim.groupBy("source", "_bucket").agg(F.sum("_size").alias("_sum"))
    along = Window.partitionBy("source").orderBy("_bucket")
    here = (by_bucket.withColumn("_to", F.sum("_sum").over(along))
            .withColumnRenamed("source", "_s")
            .join(sources.select("source", "_budget"), F.col("_s").eqNullSafe(F.col("source")))
            .where("_to > _budget and _budget > 0").groupBy("_s")
            .agg(F.min(F.struct("_bucket", (F.col("_to") - F.col("_sum")).alias("_before"), "_budget")).alias("_b"))
            .select("_s", "_b.*").withColumnRenamed("_bucket", "_last"))
    here = cut(here, "ends")
    point = F.struct("_key", "doc_id", "_print")
    upto = Window.partitionBy("_s").orderBy("_key", "doc_id", "_print")
    peers = upto.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    alike = Window.partitionBy("_s", "_key", "doc_id", "_print")
    inside = (slim.join(here, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_bucket") == F.col("_last")))
              .withColumn("_mid", F.col("_before") + F.sum("_size").over(peers) - F.sum("_size").over(alike) / 2)
              .where("_mid <= _budget").groupBy("_s").agg(F.max(point).alias("_point")))
    ends = here.join(inside.withColumnRenamed("_s", "_t"), F.col("_s").eqNullSafe(F.col("_t")), "left")
    return cut(sources.join(ends.select("_s", "_last", "_point"), F.col("source").eqNullSafe(F.col("_s")), "left")
               .select(F.col("source").alias("_source"), "source_size", "target", "epochs", "_last", "_point"), "plan")


def _decided(docs: DataFrame, plan: DataFrame) -> DataFrame:
    point = F.struct("_key", "doc_id", "_print")
    once_more = ((F.col("_bucket") < F.col("_last"))
                 | ((F.col("_bucket") == F.col("_last")) & F.coalesce(point <= F.col("_point"), F.lit(False))))
    return (docs.join(plan, F.col("source").eqNullSafe(F.col("_source")))
            .withColumn("copies", F.col("epochs") + F.when(once_more, 1).otherwise(0)))


def mix(docs: DataFrame, weights=(5, 2, 1), cap: float = 3.0, weight: Column | None = None, seed: int = SEED,
        buckets: int = BUCKETS) -> DataFrame:
    """Per document of ``docs`` (doc_id, text, source): size, source_size, target, epochs, copies and taken words.

    A document is taken ``copies`` times, whole: once for every complete epoch, and once more if it lies within the
    fractional budget; the document at its end is taken if that brings the sum nearer. ``cap`` is a whole number.
    Sizes are words; null and empty texts have size 0 and change no sum. A null source is a source of its own, the last.
    Equal rows get equal decisions. Other columns are ignored. An empty table gives no rows. The weight must be
    positive; by default it is `letter_weight`.
    """
    prepare(docs.sparkSession)
    w = letter_weight(F.col("text")) if weight is None else weight
    slim = cut(_keyed(docs.select("doc_id", "text", "source"), w, seed, buckets)
               .select("doc_id", "source", "_size", "_key", "_bucket", F.xxhash64("text").alias("_print")), "keys")
    return (_decided(slim, _plan(slim, weights, cap))
            .select("doc_id", "source", F.col("_size").alias("size"), "source_size", "target", "epochs", "copies",
                    (F.col("copies") * F.col("_size")).alias("taken")))


def mix_documents(docs: DataFrame, weights=(5, 2, 1), cap: float = 3.0, seed: int = SEED,
                  buckets: int = BUCKETS) -> DataFrame:
    """The mixed corpus: every row of ``docs``, with its own columns, as often as `mix` takes it.

    Texts are read twice and not shuffled, unless the plan (a row per source) is too large for Spark to broadcast.
    """
    prepare(docs.sparkSession)
    w = letter_weight(F.col("text"))
    names = docs.columns
    slim = cut(_keyed(docs.select("doc_id", "text", "source"), w, seed, buckets)
               .select("doc_id", "source", "_size", "_key", "_bucket", F.xxhash64("text").alias("_print")), "keys")
    rows = docs.select("doc_id", "text", "source", F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"))
    rows = _keyed(rows, w, seed, buckets).withColumn("_print", F.xxhash64("text"))
    return (_decided(rows, _plan(slim, weights, cap)).where("copies > 0")
            .select("_row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("_row.*"))


def query(spark, sf_dir):
    return (mix(table(spark, sf_dir, "documents"))
            .select("doc_id", "size", "source_size", "target", "taken"))


SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         coalesce(0.5 + length(regexp_replace(text, '[^\p{L}]+', '', 'g'))::DOUBLE / greatest(length(text), 1), 0.5) AS w,
         (('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM documents),
k AS (SELECT *, -ln(u) / w AS key FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
             ([5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w
      FROM k GROUP BY source),
r AS (SELECT *, source_size * 3.0::DOUBLE / w AS ratio FROM s),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(source_size * 3.0::DOUBLE) OVER f, 0))
             / (sum(w) OVER () - coalesce(sum(w) OVER f, 0)) AS level
      FROM r WINDOW f AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
o AS (SELECT arg_min(level, ratio) AS open FROM l WHERE NOT level >= ratio),
t AS (SELECT source, source_size, CASE WHEN level >= ratio THEN source_size * 3.0::DOUBLE ELSE open * w END AS target
      FROM l LEFT JOIN o ON true),
e AS (SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3) ELSE 0 END::BIGINT AS epochs FROM t),
p AS (SELECT k.doc_id, k.size, e.source_size, e.target, e.epochs,
             CASE WHEN epochs >= 3 THEN 0 ELSE target - epochs * source_size END AS budget,
             sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id) - k.size / 2 AS mid
      FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
       (size * (epochs + CASE WHEN budget > 0 AND mid <= budget THEN 1 ELSE 0 END))::BIGINT AS taken
FROM p
"""
