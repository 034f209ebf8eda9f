"""Removal of lines that repeat across documents (operator 5, DataFrame functions only).

Lines are reduced to a 128-bit hash of their key before anything moves. The hashes are range-partitioned together with the
document, so a hash that a third of all lines carry spreads over many partitions, and sorted within each partition by hash,
document and position. A window streams the sorted run, in place, and lets the first occurrence in each (hash, document)
through; these are counted per hash, with the largest document, combined before their shuffle. Back come no texts but, per
document, a compressed bitmap: 64-bit words of dropped positions, with empty words left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import UPPER, WHITE, cut, prepare, table


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(WHITE)), UPPER, UPPER.lower())


def repeated_line_bitmaps(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """Per document that loses lines: doc_id, ``print`` (a hash of its text) and ``drops``, the compressed bitmap.

    A line's key is the line without ASCII white space at its ends, A-Z lower-cased. Keys of at least ``min_chars`` code
    points in at least ``min_docs`` documents lose all their lines but those in the largest doc_id that holds them.
    ``drops`` is an array of (word, bits): bit i of word w set means that line ``64 * w + i`` (from 0) goes; words
    without a set bit are absent. Null or empty texts are one empty line. Rows with one doc_id are one document when
    documents are counted; a null doc_id counts as a document below all others. Keys are compared by 128-bit hashes.
    """
    prepare(docs.sparkSession)
    text, key = F.col("text"), line_key(F.col("line"))
    lines = (docs.select("doc_id", F.xxhash64(text).alias("print"), F.posexplode(lines_of(text)).alias("pos", "line"))
             .where(F.length("line") >= min_chars).where(F.length(key) >= min_chars)
             .select("doc_id", "print", "pos", F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("line"), key).alias("h2")))
    lines = cut(lines, "lines")
    run = Window.partitionBy("h1", "h2", "doc_id").orderBy("pos")          # the range partitioning serves it as it is
    firsts = (lines.repartitionByRange("h1", "h2", "doc_id").select("h1", "h2", "doc_id", "pos")
              .withColumn("nth", F.row_number().over(run)).where("nth = 1"))
    common = (firsts.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("keeper"))
              .where(F.col("n_docs") >= min_docs))
    common = cut(common, "common")
    words = (lines.join(common, ["h1", "h2"]).where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
             .groupBy("doc_id", "print", F.floor(F.col("pos") / 64).cast("int").alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, pos % 64)")).alias("bits")))
    return words.groupBy("doc_id", "print").agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("drops"))


def keep_lines(lines: Column, drops: Column) -> Column:
    """The lines whose bit is not set in ``drops``."""
    by_word = F.map_from_entries(drops)

    def kept(line: Column, i: Column) -> Column:
        bits = F.coalesce(F.try_element_at(by_word, F.floor(i / 64).cast("int")), F.lit(0).cast("long"))
        return F.getbit(bits, i % 64) == 0

    return F.when(drops.isNull(), lines).otherwise(F.filter(lines, kept))


def drop_repeated_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """doc_id, ``lines`` (the array of all) and ``kept`` (the array of those that stay) per row of ``docs``."""
    maps = repeated_line_bitmaps(docs, min_chars, min_docs).select(F.col("doc_id").alias("_id"), F.col("print").alias("_print"), "drops")
    rows = docs.select("doc_id", "text").join(
        maps, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_print")), "left")
    return (rows.select("doc_id", lines_of(F.col("text")).alias("lines"), "drops")
            .select("doc_id", "lines", keep_lines(F.col("lines"), F.col("drops")).alias("kept")))


def query(spark, sf_dir):
    rows = drop_repeated_lines(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.size("lines").cast("long").alias("n_lines"),
                       (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"),
                       F.sha2(F.array_join("kept", "\n"), 256).alias("kept_sha256"))


SQL = r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                  generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
d AS (SELECT k.doc_id, k.pos, k.line, c.key IS NOT NULL AND k.doc_id <> c.keeper AS gone
      FROM k LEFT JOIN c ON k.key = c.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM d GROUP BY doc_id
"""
