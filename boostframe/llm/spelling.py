"""Grouping of spelling variants by pivotal grams (operator 11).

Two words are near if one inserted, deleted or replaced code point turns one into the other. One edit spoils at most one
of two disjoint bigrams, so one of a word's two pivots stands in every near word, moved by at most one place; and if the
pivots are taken from the three rarest bigrams of a word (its prefix) under one order of all bigrams, that pivot is also
in the near word's prefix, or the other way round (Deng, Li and Feng 2014, the pivotal prefix filter). Pivots are chosen by
dynamic programming for the least total frequency. Pivots and prefix grams of all words are joined on the gram, its place,
the word's length and, since an edit lies in one third of a word, the letters of the other two thirds at the places that
the edit gives them. These keys spread a frequent gram over as many keys as there are word frames. Pairs are then verified.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import UPPER, cut, prepare, table
from .conversation_repair import CRC_TABLE, sql_crc32

RUN = r"[A-Za-zÀ-ÿ]+"
#: Bigrams are counted by this many hash values, so their order is a table of fixed size whatever the alphabet.
GRAM_BUCKETS = 1 << 16
#: Parts of a word of which one holds the edit.
PARTS = 3


# ------------------------------------------------------------------------------------------------ signatures

def choose_pivots(places: list[int], weights: list[int], count: int = 2) -> list[int]:
    """``count`` of the bigrams at ``places`` (ascending) that share no letter, with the least total weight.

    Dynamic programming: the best choice of k among the first i grams either leaves the i-th out or adds it to the best
    choice of k - 1 among those that end before it. Ties go to the choice whose last gram comes first.
    """
    best = [[(0, ())] * (len(places) + 1)] + [[None] * (len(places) + 1) for _ in range(count)]
    for k in range(1, count + 1):
        for i in range(1, len(places) + 1):
            free = i - 1
            while free and places[free - 1] > places[i - 1] - 2:
                free -= 1
            left, before = best[k][i - 1], best[k - 1][free]
            took = None if before is None else (before[0] + weights[i - 1], (*before[1], places[i - 1]))
            best[k][i] = took if left is None or took is not None and took[0] < left[0] else left
    return list(best[count][-1][1])


def signature(word: str, weight) -> tuple[list[int], list[int]]:
    """Places of the prefix grams and of the pivots of ``word`` (four letters or more).

    The prefix is the three rarest bigrams by (weight, gram), with all places of the last one.
    """
    grams = sorted((*weight(word[i:i + 2]), i) for i in range(len(word) - 1))
    end = 3
    while end < len(grams) and grams[end][:2] == grams[2][:2]:
        end += 1
    prefix = sorted((g[2], g[0]) for g in grams[:end])
    places = [p for p, _ in prefix]
    return places, choose_pivots(places, [w for _, w in prefix])


def _gram_bucket(gram: Column) -> Column:
    return F.crc32(F.encode(gram, "UTF-8")) % GRAM_BUCKETS


def gram_weights(words: DataFrame) -> np.ndarray:
    """Number of places of each hash value of bigrams: at most GRAM_BUCKETS numbers."""
    places = F.sequence(F.lit(1), F.length("word") - 1)
    grams = words.where(F.length("word") > 1).select(
        F.explode(F.transform(places, lambda i: F.substring(F.col("word"), i, F.lit(2)))).alias("gram"))
    counts = grams.groupBy("gram").count().groupBy(_gram_bucket(F.col("gram")).alias("b")).agg(F.sum("count").alias("n"))
    weights = np.zeros(GRAM_BUCKETS, np.int64)
    for b, n in counts.toPandas().itertuples(index=False):
        weights[int(b)] = int(n)
    return weights


def _signatures(words: DataFrame) -> DataFrame:
    """word, n, prefix and pivots (arrays of places, from 0) of words of four letters or more."""
    shared = words.sparkSession.sparkContext.broadcast(gram_weights(words))

    def run(frames: Iterator[pd.DataFrame]):
        weights, known = shared.value, {}

        def weight(gram):
            if gram not in known:
                if len(known) >= GRAM_BUCKETS:
                    known.clear()
                known[gram] = (int(weights[zlib.crc32(gram.encode()) % GRAM_BUCKETS]), gram)
            return known[gram]

        for frame in frames:
            made = [signature(w, weight) for w in frame["word"]]
            yield frame.assign(prefix=[m[0] for m in made], pivots=[m[1] for m in made])

    out = words.where(F.length("word") >= 4).mapInPandas(run, "word string, n bigint, prefix array<int>, pivots array<int>")
    return cut(out, "signatures")


def _part(length: Column, j: Column) -> Column:
    return F.floor(length * j / PARTS).cast("int")


def _key(word: Column, place: Column, moved: Column, length: Column, j: Column, shift: Column) -> Column:
    """Hash of the gram, its place in the other word, that word's length, the part that holds the edit, and the letters
    outside of that part. ``length`` is the other word's; ``word`` is ``shift`` shorter."""
    a, b = _part(length, j), _part(length, j + 1) - shift
    frame = F.concat(F.substring(word, F.lit(1), a), F.lit("|"), F.substring(word, b + 1, F.length(word)))
    return F.xxhash64(F.substring(word, place + 1, F.lit(2)), moved, length, j, frame)


def _pivot_side(signatures: DataFrame) -> DataFrame:
    """A row per pivot and possible edit: a replaced letter (shift 0), or the other word one longer (1) or shorter (-1);
    grams before the edit keep their place, those behind it move by the shift."""
    cases = [F.struct(F.lit(shift).alias("shift"), F.lit(j).alias("j"), F.lit(move).alias("move"))
             for shift in (0, 1, -1) for j in range(PARTS) for move in ((0,) if shift == 0 else (0, shift))]
    rows = (signatures.select("word", "n", F.explode("pivots").alias("p"))
            .select("word", "n", "p", F.explode(F.array(*cases)).alias("c")).select("word", "n", "p", "c.*"))
    length = F.length("word") + F.col("shift")
    a, b = _part(length, F.col("j")), _part(length, F.col("j") + 1) - F.col("shift")
    before, behind = F.col("p") + 2 <= a, F.col("p") >= b
    rows = rows.where((~before | (F.col("move") == 0)) & (~behind | (F.col("move") == F.col("shift"))))
    return rows.select(_key(F.col("word"), F.col("p"), F.col("p") + F.col("move"), length, F.col("j"), F.col("shift")).alias("key"),
                       "word", "n")


def _prefix_side(signatures: DataFrame) -> DataFrame:
    rows = (signatures.select("word", "n", F.explode("prefix").alias("p"))
            .select("word", "n", "p", F.explode(F.array(*[F.lit(j) for j in range(PARTS)])).alias("j")))
    return rows.select(_key(F.col("word"), F.col("p"), F.col("p"), F.length("word"), F.col("j"), F.lit(0)).alias("key"),
                       F.col("word").alias("near"), F.col("n").alias("near_n"))


def near_words(words: DataFrame) -> DataFrame:
    """All pairs of near words of ``words`` (distinct word, n), in both directions: word, n, near, near_n.

    Words of under four letters are compared as well, by the words that one deletion leaves.
    """
    signatures = _signatures(words)
    pivots, grams = _pivot_side(signatures), _prefix_side(signatures)
    found = pivots.join(grams, "key").where(F.expr("levenshtein(word, near, 1)") == 1).select("word", "n", "near", "near_n")
    # a word of three letters has at most two bigrams, which share a letter, so the short ones go by their deletions
    small = words.where(F.length("word") <= 4)
    gone = F.sequence(F.lit(1), F.length("word"))
    left = small.where(F.length("word") > 0).select("word", "n", F.explode(F.array_union(
        F.transform(gone, lambda i: F.concat(F.substring(F.col("word"), F.lit(1), i - 1), F.substring(F.col("word"), i + 1, F.length("word")))),
        F.array("word"))).alias("rest"))
    left = left.union(small.where(F.length("word") == 0).select("word", "n", F.lit("").alias("rest")))
    right = left.select("rest", F.col("word").alias("near"), F.col("n").alias("near_n"))
    short = left.join(right, "rest").where(F.expr("levenshtein(word, near, 1)") == 1).select("word", "n", "near", "near_n")
    one_way = found.union(short).select(F.least("word", "near").alias("a"), F.greatest("word", "near").alias("b"),
                                        F.when(F.col("word") < F.col("near"), F.col("n")).otherwise(F.col("near_n")).alias("a_n"),
                                        F.when(F.col("word") < F.col("near"), F.col("near_n")).otherwise(F.col("n")).alias("b_n"))
    pairs = cut(one_way.distinct(), "near")
    return (pairs.select(F.col("a").alias("word"), F.col("a_n").alias("n"), F.col("b").alias("near"), F.col("b_n").alias("near_n"))
            .union(pairs.select("b", "b_n", "a", "a_n")))


# ------------------------------------------------------------------------------------------------ groups

def variant_groups(words: DataFrame, ratio: int = 10) -> DataFrame:
    """word, n, n_near, form, form_n and root of every row of ``words`` (distinct word, n).

    ``form`` is the near word of the largest n (ties: the least in code-point order) if that n is at least ``ratio`` (2 or
    more) times the word's; ``root`` is the last form on the way from the word, the word itself if it has none. Null words
    are left out; an empty table gives no rows; other columns are ignored. Long words are compared whole.
    """
    prepare(words.sparkSession)
    if ratio < 2:
        raise ValueError("ratio must be at least 2")
    words = words.where(F.col("word").isNotNull()).select("word", F.col("n").cast("long").alias("n"))
    links = near_words(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near"))).alias("top"))
    far = F.col("form_n") >= ratio * F.col("n")
    rows = (words.join(links, "word", "left")
            .select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("top.near").alias("form"),
                    (-F.col("top.minus")).alias("form_n"))
            .select("word", "n", "n_near", F.when(far, F.col("form")).alias("form"), F.when(far, F.col("form_n")).alias("form_n")))
    rows = cut(rows, "forms")
    steps = rows.where("form is not null").select("word", F.col("form").alias("root"))
    most = rows.agg(F.max("n")).first()[0] or 1
    longest = max(1, int(math.log(max(most, 1), ratio)) + 1)       # n grows by ``ratio`` from form to form
    for _ in range(math.ceil(math.log2(longest)) if longest > 1 else 0):
        on = steps.select(F.col("word").alias("w"), F.col("root").alias("next"))
        steps = cut(steps.join(on, F.col("root") == F.col("w"), "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
    return (rows.join(steps, "word", "left")
            .select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")))


def word_counts(docs: DataFrame, misprint: int = 31, min_chars: int = 7, min_count: int = 2) -> DataFrame:
    """word and n of the runs of letters in whole texts (null: none), A-Z lower-cased, that have at least ``min_chars``
    code points and occur ``min_count`` times or more, after misprints.

    With h the crc32 of ``<doc_id>:<run>`` (a null doc_id: nothing before the colon), a run loses its code point
    h % length (from 0) where ``misprint`` divides h; 0 makes none.
    """
    long_run = RUN[:-1] + "{%d,}" % min_chars
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(long_run), F.lit(0))).alias("run"))
    run = F.col("run")
    runs = runs.select("doc_id", F.translate(run, UPPER, UPPER.lower()).alias("run"))
    word = run
    if misprint:
        h = F.crc32(F.encode(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), run), "UTF-8"))
        at = (F.col("h") % F.length(run)).cast("int")
        runs = runs.select("run", h.alias("h"))
        word = F.when(F.col("h") % misprint == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
                      ).otherwise(run)
    return (runs.select(word.alias("word")).where(F.length("word") >= min_chars).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= min_count))


def query(spark, sf_dir):
    prepare(spark)
    return variant_groups(cut(word_counts(table(spark, sf_dir, "documents")), "words"))


SQL = rf"""
WITH RECURSIVE t AS MATERIALIZED {CRC_TABLE},
runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')),
                                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
each_ AS MATERIALIZED (SELECT doc_id, run, count(*) AS k FROM runs WHERE length(run) >= 7 GROUP BY ALL),
hashed AS (SELECT run, k, {sql_crc32("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM each_, t),
made AS (SELECT k, CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
         FROM hashed),
w AS MATERIALIZED (SELECT word, sum(k)::BIGINT AS n FROM made WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
d AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
                   FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM w)),
near AS (SELECT DISTINCT d.word, w.word AS near, w.n AS near_n FROM d JOIN w ON d.rest = w.word
         UNION SELECT w.word, d.word, d.n FROM d JOIN w ON d.rest = w.word
         UNION SELECT d.word, e.word, e.n FROM d JOIN d e ON d.rest = e.rest AND d.i = e.i AND d.word <> e.word),
top AS (SELECT word, count(*) AS n_near, min(struct_pack(minus := -near_n, near := near)) AS best FROM near GROUP BY word),
f AS MATERIALIZED (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.minus >= 10 * w.n THEN best.near END AS form,
      CASE WHEN -best.minus >= 10 * w.n THEN -best.minus END AS form_n FROM w LEFT JOIN top ON w.word = top.word),
walk AS (SELECT word, word AS root, form AS next FROM f
         UNION ALL SELECT walk.word, walk.next, f.form FROM walk JOIN f ON f.word = walk.next)
SELECT f.word, f.form, walk.root, f.n, f.n_near::BIGINT AS n_near, f.form_n::BIGINT AS form_n
FROM f JOIN walk ON walk.word = f.word AND walk.next IS NULL
"""
