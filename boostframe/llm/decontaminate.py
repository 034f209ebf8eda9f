"""Benchmark decontamination by template canonicalisation (operator 8, DataFrame functions only).

Names, numbers and units of a text become typed placeholders, the rest is lower-cased words: a template, in which a
question with other names or figures looks the same. Windows of five tokens of the documents' templates are hashed and
joined with those of the benchmark. A document that holds most of an item's windows is a candidate; on candidates alone
the slots are compared: each slot value of the item must stand for one value throughout an occurrence. Windows that break
this do not count unless they have the item's own values, so shared sentence patterns are told apart from re-parameterised
questions, and cannot outvote them from elsewhere in the text. Occurrences are runs of one alignment (place in the document
less place in the item), of neighbouring alignments (words put in or left out), or the whole document.

Names are found by their capitals, so a copy in other letter case has other templates. Windows of the text without case,
where names are plain words, are therefore hashed into the same join, and either form can hold an item.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, prepare, table

WINDOW, SHARE, LITERALS = 5, 0.8, 2
WHOLE = 3
#: Up to this many windows (at most some 10 MB) the benchmark's side of the join is broadcast; beyond, both are shuffled.
BROADCAST_WINDOWS = 200_000

#: Units of measure, behind a number.
UNITS = ("%", "°C", "°F", "km/h", "mph", "mm", "cm", "dm", "m", "km", "ft", "in", "inch", "inches", "feet", "yd", "yards", "mi",
         "mile", "miles", "meter", "meters", "metre", "metres", "kilometer", "kilometers", "kilometre", "kilometres", "g",
         "mg", "kg", "gram", "grams", "kilogram", "kilograms", "t", "ton", "tons", "oz", "ounce", "ounces", "lb", "lbs",
         "pound", "pounds", "l", "ml", "cl", "liter", "liters", "litre", "litres", "gallon", "gallons", "s", "sec", "second",
         "seconds", "min", "minute", "minutes", "h", "hour", "hours", "day", "days", "week", "weeks", "month", "months",
         "year", "years", "$", "€", "£", "dollar", "dollars", "cent", "cents", "euro", "euros", "usd", "eur", "degrees",
         "kw", "kwh", "w", "v", "hz", "mb", "gb", "tb", "percent")
_UNIT = "|".join(sorted((u.replace("$", r"\$") for u in UNITS), key=len, reverse=True))
#: The look ahead asks for the capital, ranges first: most characters are passed over by a comparison, without a look at
#: their category or at what stands before them.
_NAME = r"(?=[A-Z\x{80}-\x{10FFFF}&&\p{Lu}])(?<![\p{L}\p{N}\x02])\p{Lu}\p{Ll}[\p{L}\p{M}]*"
_NUMBER = r"\p{N}+(?:[.,]\p{N}+)*"
_BREAK = r"[^\p{L}\p{M}\p{N}\x01-\x04]+"
_NAME_MARK, _NUMBER_MARK, _UNIT_MARK, _POINT = "\x01", "\x02", "\x03", "\x04"
#: Behind a marked number, where units of the text and of its forms may differ: a unit that is a name, a name behind a unit
#: that is no word, and letters that become ASCII letters without case.
_APART = (rf"{_NUMBER_MARK}(?:\s+(?=\p{{Lu}}\p{{Ll}})(?i:{_UNIT})(?!\p{{L}})|\s*[%$€£]\p{{Lu}}"
          r"|\s*[A-Za-z/%$€£°]*[\x{130}\x{131}\x{17F}\x{345}\x{1E96}-\x{1E98}\x{212A}])")


def _bare(text: Column) -> Column:
    """The text without the characters that serve as marks; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\x01-\x04]+", "")


def _numbers(text: Column) -> Column:
    return F.regexp_replace(text, _NUMBER, _NUMBER_MARK)


def _names(text: Column) -> Column:
    return F.regexp_replace(text, _NAME, _NAME_MARK)


def _units(text: Column) -> Column:
    return F.regexp_replace(text, rf"{_NUMBER_MARK}(\s*)(?i:{_UNIT})(?!\p{{L}})", f"{_NUMBER_MARK}$1 {_UNIT_MARK}")


def _tokens(text: Column) -> Column:
    return F.array_remove(F.split(text, _BREAK), "")


def template(text: Column) -> Column:
    """The tokens of the canonical text: words in lower case, and one mark for each name, number and unit."""
    return _tokens(F.lower(_units(_names(_numbers(text)))))


def marked(text: Column) -> Column:
    """The same tokens, with the values behind the marks."""
    t = F.regexp_replace(text, _NAME, f"{_NAME_MARK}$0")
    t = F.regexp_replace(F.regexp_replace(t, _NUMBER, f"{_NUMBER_MARK}$0"), r"(?<=\p{N})[.,](?=\p{N})", _POINT)
    t = F.regexp_replace(t, rf"({_NUMBER_MARK}[\p{{N}}{_POINT}]+\s*)((?i:{_UNIT}))(?!\p{{L}})", f"$1 {_UNIT_MARK}$2")
    t = F.regexp_replace(t, rf"{_UNIT_MARK}([%°$€£][CFcf]?|(?i:km/h))", f"{_UNIT_MARK}u")
    return _tokens(F.lower(t))


def _caseless(text: Column) -> Column:
    """The text without case: ß, SS and ẞ are all ss."""
    return F.lower(F.replace(F.upper(text), F.lit("ẞ"), F.lit("SS")))


def _forms(text: Column) -> list[Column]:
    """The text as it is, for templates with names, and without case, for those without. Both are bare."""
    return [_bare(text), _bare(_caseless(text))]


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _window_hashes(h: Column, window: int) -> Column:
    starts = F.sequence(F.lit(0), F.greatest(F.size(h) - window, F.lit(0)))
    return F.when(F.size(h) == 0, F.array().cast("array<bigint>")).when(
        F.size(h) < window, F.array(F.xxhash64(h))).otherwise(
        F.transform(starts, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(window)])))


def _hashes(tokens: Column, window: int) -> Column:
    """Hash of every window; a shorter text is one window, an empty one none."""
    return _let(F.transform(tokens, lambda w: F.xxhash64(w)), lambda h: _window_hashes(h, window))


def _token_hashes(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, forms): hashes of the template's tokens, an array for each of `_forms`, out of one split of the text with its
    numbers and units marked.

    Case is taken from the words, and names are looked for in words with a capital. Texts in which a form could have other
    marks (`_APART`) or that hold a mark character or a sigma (its small form depends on what stands around) go the long way.
    Columns used more than once are projected first: they are computed once, and what follows reads them."""
    def ascii(w: Column) -> Column:
        return F.octet_length(w) == F.char_length(w)

    odd = F.lit(False)
    for c in "\x01\x02\x03\x04Σσς":
        odd = odd | F.contains("text", F.lit(c))
    df = df.select(*keys, F.coalesce(F.col("text"), F.lit("")).alias("text"))
    df = df.select(*keys, "text", ascii(F.col("text")).alias("plain"), odd.alias("odd"))
    df = df.select(*keys, "text", "plain", "odd", F.when(~F.col("odd"), _numbers(F.col("text"))).alias("n"))
    df = df.select(*keys, "text", "plain", "n", (F.col("odd") | F.rlike("n", F.lit(_APART))).alias("apart"))
    df = df.select(*keys, "text", "plain", "apart", F.when(~F.col("apart"), _tokens(_units(F.col("n")))).alias("words"))
    quick = [F.transform("words", lambda w: F.xxhash64(
                 F.when((w == F.lower(w)) & (F.col("plain") | ascii(w)), w).otherwise(F.lower(_names(w))))),
             F.transform("words", lambda w: F.xxhash64(
                 F.when(F.col("plain") | ascii(w), F.lower(w)).otherwise(F.lower(_names(_caseless(w))))))]
    return df.select(*keys, F.array(*[
        F.when(F.col("apart"), F.transform(template(form), lambda w: F.xxhash64(w))).otherwise(hashes)
        for form, hashes in zip(_forms(F.col("text")), quick)]).alias("forms"))


def _document_windows(df: DataFrame, keys: list[str], window: int, distinct: bool) -> DataFrame:
    """(keys, h): the windows' hashes in either form. Windows are cut by generated code, at less cost than in an array, and
    come as often as they stand there; ``distinct`` ones go through an array, for when they are shuffled."""
    made = _token_hashes(df, keys)
    if distinct:
        hs = F.flatten(F.transform("forms", lambda h: _window_hashes(h, window)))
        return made.select(*keys, F.array_distinct(hs).alias("hs")).select(*keys, F.explode_outer("hs").alias("h"))
    made = made.select(*keys, F.explode_outer("forms").alias("hs"))
    made = made.select(*keys, "hs", F.posexplode_outer("hs").alias("place", "_"))
    made = made.where(F.col("place") <= F.greatest(F.size("hs") - window, F.lit(0)))
    whole = F.xxhash64(*[F.get("hs", F.col("place") + k) for k in range(window)])
    return made.select(*keys, F.when(F.size("hs") < window, F.xxhash64("hs")).otherwise(whole).alias("h"))


def _windows(df: DataFrame, keys: list[str], window: int) -> DataFrame:
    """(keys, form, h, place, values): every window of either form with the marked tokens it is made of.

    The hashes are a column before they are rows (outer, or the optimizer computes them twice, to filter empty texts first):
    so the generator and what follows are one generated loop, which cuts values only out of windows that a join keeps."""
    made = df.select(*keys, F.posexplode(F.array(*_forms(F.col("text")))).alias("form", "text"))
    made = made.select(*keys, "form", _hashes(template(F.col("text")), window).alias("hs"), marked(F.col("text")).alias("m"))
    made = made.select(*keys, "form", "m", F.posexplode_outer("hs").alias("place", "h")).where("h IS NOT NULL")
    return made.select(*keys, "form", "h", "place", F.slice("m", F.col("place") + 1, F.lit(window)).alias("values"))


def _is_slot(token: Column) -> Column:
    return F.ascii(token).between(1, 3)


def _occurrences() -> Column:
    """(near, at) of every occurrence that a window's hit may be part of: by its alignments, by ranges of alignments as wide
    as the item (two that overlap by half), and the whole document."""
    def group(near: int, at: Column) -> Column:
        return F.struct(F.lit(near).alias("near"), at.cast("long").alias("at"))

    wide = F.greatest(F.col("n_windows"), F.lit(2))
    shifts = F.transform("asked_at", lambda a: F.col("place") - a)
    return F.array_distinct(F.concat(
        F.transform(shifts, lambda x: group(0, x)), F.transform(shifts, lambda x: group(1, F.floor(x / wide))),
        F.transform(shifts, lambda x: group(2, F.floor(x / wide + F.lit(0.5)))), F.array(group(WHOLE, F.lit(0)))))


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: float = SHARE,
                 broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """(doc_id, print, item_id, matched, n_windows, containment, verbatim) of each document that holds an item.

    An item is held if at least ``share`` of its distinct template windows occur in an occurrence with consistent slots
    or anywhere with the item's own values; the same goes for its windows without case (numbers and units as slots, names as
    words), and the figures are those of the better form and occurrence. ``verbatim`` says that all matched windows are there
    with the item's own values. ``print`` is a hash of the document's text. Only
    windows with at least `LITERALS` plain words count; if an item has none such, all do, with the item's own values alone. Null or empty texts and items
    hold and match nothing; a text or item under ``window`` tokens is one window, so it matches only as a whole. Rows
    repeated give one row. Null ids pass through as ids. Other columns are ignored; empty tables give no rows.
    """
    prepare(docs.sparkSession)
    items = _windows(benchmark.select("item_id", "text").distinct(), ["item_id"], window)
    items = items.withColumn("plain", F.size(F.filter("values", lambda v: ~_is_slot(v))) >= LITERALS)
    some = items.groupBy(F.col("item_id").alias("_i"), F.col("form").alias("_f")).agg(F.max("plain").alias("some"))
    of_item = F.col("item_id").eqNullSafe(F.col("_i")) & (F.col("form") == F.col("_f"))
    items = cut(items.join(some, of_item).where("plain OR NOT some").select("item_id", "form", "some", "h", "place", "values"), "items")
    per_item = items.groupBy(F.col("item_id").alias("_i"), F.col("form").alias("_f")).agg(F.count_distinct("h").alias("n_windows"))
    keys = cut(items.select("h", "item_id", "form").distinct().join(per_item, of_item).drop("_i", "_f"), "keys")
    small = keys.count() <= broadcast_windows
    keys = F.broadcast(keys) if small else keys

    rows = docs.select("doc_id", "text").withColumn("print", F.xxhash64("text"))
    found = (_document_windows(rows, ["doc_id", "print"], window, distinct=not small)
             .join(keys, "h").groupBy("doc_id", "print", "item_id", "form", "n_windows").agg(F.count_distinct("h").alias("held"))
             .where(F.col("held") >= share * F.col("n_windows")).drop("held"))
    found = cut(found, "candidates")

    # slots, on the candidates alone
    ids = ["doc_id", "print", "item_id", "form"]
    held = found.select(F.col("doc_id").alias("_d"), F.col("print").alias("_p"), "item_id", F.col("form").alias("_g"), "n_windows")
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("print") == F.col("_p"))
    texts = rows.dropDuplicates(["doc_id", "print"]).join(held.select("_d", "_p").distinct(), same, "left_semi")
    theirs = (items.groupBy(F.col("item_id").alias("_i"), F.col("form").alias("_f"), "some", F.col("h").alias("_h"),
                            F.col("values").alias("asked")).agg(F.collect_set("place").alias("asked_at")))
    theirs = F.broadcast(theirs) if small else theirs
    pairs = (_windows(texts, ["doc_id", "print"], window)
             .join(theirs, (F.col("h") == F.col("_h")) & (F.col("form") == F.col("_f"))).drop("_h", "_f")
             .join(held.withColumnRenamed("item_id", "_c"),
                   same & F.col("_i").eqNullSafe(F.col("_c")) & (F.col("form") == F.col("_g")), "inner")
             .select("doc_id", "print", F.col("_i").alias("item_id"), "form", "n_windows", "some", "h", "place", "asked", "asked_at", "values"))
    pairs = cut(pairs.withColumn("slots", F.filter(F.arrays_zip("asked", "values"), lambda z: _is_slot(z["asked"])))
                .withColumn("own", F.forall("slots", lambda s: s["asked"] == s["values"]))
                .withColumn("group", F.explode(_occurrences())).select(*ids, "n_windows", "some", "h", "slots", "own", "group.*"), "pairs")
    one = [*ids, "near", "at"]
    votes = (pairs.select(*one, F.explode("slots").alias("s")).groupBy(*one, "s.asked", "s.values")
             .agg(F.count(F.lit(1)).alias("votes")))
    chosen = (votes.groupBy(*one, "asked").agg(F.max(F.struct("votes", F.col("values") == F.col("asked"), "values")).alias("best"))
              .groupBy(*one).agg(F.map_from_entries(F.collect_list(F.struct("asked", "best.values"))).alias("slot_of")))
    chosen = chosen.toDF("_d", "_p", "_i", "_f", "_n", "_a", "slot_of")
    agrees = (F.col("some") | F.col("own")) & F.forall("slots", lambda s: F.element_at("slot_of", s["asked"]) == s["values"])
    kept = (pairs.join(chosen, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("print") == F.col("_p")) & of_item
                       & (F.col("near") == F.col("_n")) & (F.col("at") == F.col("_a")), "left")
            .groupBy(*one, "n_windows").agg(F.collect_set(F.when(agrees, F.col("h"))).alias("good"),
                                           F.collect_set(F.when(F.col("own"), F.col("h"))).alias("own"))
            .groupBy(*ids, "n_windows").agg(F.collect_list("good").alias("good"),
                                           F.flatten(F.collect_list(F.when(F.col("near") == WHOLE, F.col("own")))).alias("own")))
    enough = F.filter("good", lambda g: F.size(g) + F.size("own") >= share * F.col("n_windows"))
    kept = (kept.withColumn("matched", F.array_max(F.transform(enough, lambda g: F.size(F.array_union(g, "own")))))
            .withColumn("verbatim", F.size("own") >= F.col("matched")))
    best = F.max(F.struct((F.col("matched") / F.col("n_windows")).alias("containment"), "verbatim", -F.col("form"),
                          "matched", "n_windows")).alias("best")
    return (kept.where(F.col("matched") >= share * F.col("n_windows")).groupBy("doc_id", "print", "item_id").agg(best)
            .select("doc_id", "print", "item_id", "best.matched", "best.n_windows", "best.containment", "best.verbatim"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no item of the benchmark."""
    hits = cut(contaminated(docs, benchmark, **options).select(F.col("doc_id").alias("_d"), F.col("print").alias("_p")).distinct(), "hits")
    text = F.xxhash64(docs["text"])
    return docs.join(hits, docs["doc_id"].eqNullSafe(hits["_d"]) & (text == hits["_p"]), "left_anti")


def query(spark, sf_dir):
    hits = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return hits.drop("print")
