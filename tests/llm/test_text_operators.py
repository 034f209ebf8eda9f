"""Operators on documents against plain versions, with nulls, empty and long texts, ties, repeated rows, empty tables
and extra columns whose names clash with the operators' own."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from boostframe.llm import decontaminate, line_dedup, mixing, simhash, tokens, toxicity
from tests.conftest import spark  # noqa: F401

SCHEMA = "doc_id long, text string, source string, size int, h string, part string, _key string"


def make(spark, rows):  # noqa: F811
    return spark.createDataFrame([(i, t, s, 1, "x", "y", "z") for i, t, s in rows], SCHEMA)


WORD = re.compile(r"[^\x20\x09-\x0D]+")
LINE = "This line is long enough to be counted as common text"


def corpus():
    rng = np.random.default_rng(3)
    vocabulary = ["".join(rng.choice(list("abcdefgh"), rng.integers(1, 7))) for _ in range(300)]
    text = lambda n: " ".join(rng.choice(vocabulary, n))
    rows = [(i, text(int(rng.integers(1, 60))), f"s{i % 4}") for i in range(40)]
    rows += [(100 + i, rows[5][1] + (" x" if i % 2 else ""), "hot") for i in range(30)]       # copies, and a hot source
    rows += [(200 + i, f"{text(3)}\n  {LINE.upper() if i % 2 else LINE}\t\n{text(2)}", "s1") for i in range(6)]
    rows += [(300, None, None), (301, "", "s0"), (302, " \n\t ", None), (None, text(9), "s2"), (None, None, "s2"),
             (303, text(9000), "long"), (7, rows[7][1], "s3"), (7, rows[7][1], "s3"), (304, "ÀÉ ß x 한국어 😀", "s0"),
             (304, f"other text\n{LINE}\n{LINE}", "s0")]
    return rows


@pytest.fixture(scope="module")
def docs(spark):  # noqa: F811
    return make(spark, corpus()).repartition(5).cache()


@pytest.fixture(scope="module")
def nothing(spark):  # noqa: F811
    return make(spark, [])


# ------------------------------------------------------------------------------------------------ tokens

def test_tokens_round_trip(spark, docs, nothing, tmp_path):  # noqa: F811
    from tokenizers import Tokenizer
    reference = Tokenizer.from_file(tokens.default_tokenizer())
    path = str(tmp_path / "shards")
    tokens.write_shards(docs, path, tokens.default_tokenizer(), shard_tokens=500)
    got = sorted(map(tuple, tokens.read_documents(spark, path).select("start", "doc_id", "n_tokens", "ids_crc32").collect()))
    key = lambda r: (r[0] is not None, r[0] or 0)
    rows = sorted(corpus(), key=key)
    encoded = [(i, reference.encode(t or "", add_special_tokens=False).ids + [tokens.END_ID]) for i, t, _ in rows]
    assert [r[1] for r in got] == [i for i, _ in encoded]
    assert [r[0] for r in got] == list(np.cumsum([0] + [r[2] for r in got])[:-1])
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    per_id = lambda pairs: collections.Counter(pairs)
    assert per_id((i, len(x), crc(x)) for i, x in encoded) == per_id((r[1], r[2], r[3]) for r in got)
    shards = spark.read.parquet(path).collect()
    assert len(shards) > 3
    long = next(x for i, x in encoded if i == 303)
    for shard in shards:
        if 303 in shard["doc_ids"]:
            at = shard["doc_ids"].index(303)
            for a, b in ((0, 5), (4321, 4400), (8000, 10 ** 9), (5, 5), (-3, 2)):
                assert list(tokens.decode_range(shard.asDict(), at, a, b)) == long[max(0, a):b]
    assert tokens.store_tokens(nothing, tokens.default_tokenizer()).count() == 0


def test_units_encode_as_whole_texts():
    from tokenizers import Tokenizer
    import pyarrow as pa
    reference, encoder = Tokenizer.from_file(tokens.default_tokenizer()), tokens.WordEncoder(tokens.default_tokenizer())
    texts = ["", "Hello, WORLD!! don't <|endoftext|> <|ENDOFTEXT|> x<|startoftext|>y.", "ÉTUDE,, İstanbul. ΣΑΣ. 한국어!",
             "a1! I'LL. 'S !!! \x1c\x85x. ٣٤؟ 😀😀. ｆｕｌｌ! a̸.", "x" * 700 + ".", "<|endoftext|>.. q<"]
    ids, n = encoder.encode(pa.array(texts))
    for text, part in zip(texts, np.split(ids, np.cumsum(n)[:-1])):
        assert list(part) == reference.encode(text, add_special_tokens=False).ids + [tokens.END_ID]


def test_letters_that_normalise_to_marks():
    """Letters that become two characters keep their marks with the signs behind them, as in whole texts."""
    import random
    import unicodedata
    from tokenizers import Tokenizer
    import pyarrow as pa
    reference, encoder = Tokenizer.from_file(tokens.default_tokenizer()), tokens.WordEncoder(tokens.default_tokenizer())
    rng = random.Random(4)
    texts = ["İ.", "TARİHİ.", "EVİ, yeni", "İ!"] + ["".join(rng.choice("İiIabé.,;!? \n'ßΣσA\u0958x\u0301ড়") for _ in range(12)) for _ in range(3000)]
    letters = [chr(c) for c in range(0x30000) if unicodedata.category(chr(c))[0] == "L"]
    texts += [f"a{c}. {c}, b{c}c!" for c in rng.sample(letters, 4000) + [c for c in letters if len(unicodedata.normalize("NFC", c.lower())) > 1]]
    ids, n = encoder.encode(pa.array(texts))
    for text, part in zip(texts, np.split(ids, np.cumsum(n)[:-1])):
        assert list(part) == reference.encode(text, add_special_tokens=False).ids + [tokens.END_ID], ascii(text)


def test_grammar_goes_on_until_no_pair_is_frequent():
    rng = np.random.default_rng(0)
    phrase = rng.integers(2, 90, 400)
    ids = np.concatenate([np.concatenate([phrase, rng.integers(2, 90, 60), [1]]) for _ in range(40)]).astype(np.uint32)
    symbols, per_run, rules, lengths = tokens.repair(ids, np.flatnonzero(ids == 1) + 1, 100, pairs=20, min_count=16)
    assert (tokens.expand(symbols, rules, lengths, 100) == ids).all() and lengths.max() >= 200
    inside = np.ones(len(symbols), bool)
    inside[np.cumsum(per_run) - 1] = False
    pairs = collections.Counter(zip(symbols[:-1][inside[:-1]].tolist(), symbols[1:][inside[:-1]].tolist()))
    assert max(pairs.values()) < 16


def test_null_ids_spread_over_partitions(spark, tmp_path):  # noqa: F811
    frame = spark.createDataFrame([(None, f"text {i}") for i in range(4000)], "doc_id long, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tokens.write_shards(frame, str(tmp_path / "shards"), tokens.default_tokenizer(), shard_tokens=100)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert spark.read.parquet(str(tmp_path / "shards")).select("part").distinct().count() > 1


@pytest.mark.parametrize("ids", [[1], [5, 1], [5, 5, 5, 5, 5, 1] * 40, list(range(2, 40)) * 30 + [1], [1, 1, 1]])
def test_grammar_is_lossless(ids):
    ids = np.array(ids, np.uint32)
    ends = np.flatnonzero(ids == 1) + 1
    symbols, per_run, rules, lengths = tokens.repair(ids, ends, 50, rounds=6, pairs=8, min_count=2)
    assert (tokens.expand(symbols, rules, lengths, 50) == ids).all() and per_run.sum() == len(symbols)
    assert len(symbols) <= len(ids)


# ------------------------------------------------------------------------------------------------ mixing

def plain_mix(rows, weights=(5, 2, 1), cap=3):
    size = lambda t: len(WORD.findall(t or ""))
    total = collections.Counter()
    for _, t, s in rows:
        total[s] += size(t)
    names = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(total.values()))
    while open_:
        share = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / share >= cap * total[s]}
        if not over:
            target.update({s: left * weight[s] / share for s in open_})
            break
        target.update({s: cap * total[s] for s in over})
        left -= sum(cap * total[s] for s in over)
        open_ -= over
    return size, total, target


def test_mixing(docs, nothing):
    rows = corpus()
    size, total, target = plain_mix(rows)
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    taken = collections.Counter()
    for r in got:
        assert r["source_size"] == total[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]])
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3
        taken[r["source"]] += r["taken"]
    largest = collections.Counter()
    for _, t, s in rows:
        largest[s] = max(largest[s], size(t))
    for s, t in target.items():
        assert abs(taken[s] - t) <= 1.5 * largest[s] + 1                 # equal rows are decided together
    again = mixing.mix(docs.repartition(3)).collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter(map(tuple, again))
    assert mixing.mix(nothing).count() == 0 and mixing.mix_documents(nothing).count() == 0


def test_mixing_takes_the_smallest_keys(spark):  # noqa: F811
    rows = [(i, "w " * (1 + i % 7), "a" if i % 3 else "b") for i in range(400)]
    frame = make(spark, rows)
    got = {r["doc_id"]: r for r in mixing.mix(frame, buckets=16).collect()}
    size, total, target = plain_mix(rows)
    for s in "ab":
        def key(i, t):
            u = (int(hashlib.md5(f"{mixing.SEED}:{i}".encode()).hexdigest()[:13], 16) + 0.5) / 2 ** 52
            return -math.log(u) / (0.5 + sum(c.isalpha() for c in t) / len(t))
        budget = target[s] - min(3, target[s] // total[s]) * total[s]
        before = 0
        for k, i, t in sorted((key(i, t), i, t) for i, t, q in rows if q == s):
            more = 1 if before + size(t) / 2 <= budget and target[s] < 3 * total[s] else 0
            assert got[i]["copies"] - min(3, target[s] // total[s]) == more
            before += size(t)


def test_mixed_documents_keep_their_rows(docs):
    rows = collections.Counter({(r["doc_id"], r["text"]): 0 for r in docs.collect()})
    for r in mixing.mix(docs).collect():
        rows[r["doc_id"]] = rows.get(r["doc_id"], 0) + r["copies"]
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    got = collections.Counter(r["doc_id"] for r in mixed.collect())
    assert all(got[i] == n for i, n in rows.items() if not isinstance(i, tuple))


# ------------------------------------------------------------------------------------------------ toxicity

def test_toxicity_learns_words_and_scores_whole_texts(spark):  # noqa: F811
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(400)]
    bad = ["grobnak", "zumpfig"]
    rows, labels = [], []
    for i in range(400):
        text = list(rng.choice(words, 60))
        if i % 4 == 0:
            for w in bad:
                text[int(rng.integers(60))] = w + str(rng.choice(["", "en", "er", "!!"]))
        rows.append((i, " ".join(text), "s"))
        labels.append((i, 1, int(i % 4 == 0), "clash"))
    long = " ".join(rng.choice(words, 30_000)) + " grobnak zumpfig"
    rows += [(900, long, "s"), (901, None, "s"), (902, "", "s"), (None, rows[0][1], "s"), (903, rows[0][1], "s"), (903, rows[0][1], "s")]
    frame = make(spark, rows)
    known = spark.createDataFrame(labels + [(None, 1, 1, "n"), (2, 1, None, "n")], "doc_id long, quality int, toxic int, text string")
    model = toxicity.train(frame, known)
    got = [r.asDict() for r in toxicity.score(frame, model).collect()]
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    by = {r["doc_id"]: r["score"] >= 0.5 for r in got}
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([by[i] == (i % 4 == 0) for i in held]) > 0.95
    assert by[900] and by[903] and by[None] and not by[901] and not by[902]
    kept = toxicity.drop_toxic(frame, model)
    assert kept.columns == frame.columns and {r["doc_id"] for r in kept.collect()} == {i for i in by if not by[i]}
    empty = toxicity.train(frame, known.limit(0))
    assert {r["score"] for r in toxicity.score(frame, empty).collect()} == {0.0}
    assert toxicity.score(frame.limit(0), model).count() == 0


# ------------------------------------------------------------------------------------------------ lines

def plain_lines(rows, min_chars=40, min_docs=5):
    white = " \t\n\x0b\x0c\r"
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(white))
    held = collections.defaultdict(set)
    for i, t, _ in rows:
        for x in (t or "").split("\n"):
            held[key(x)].add(i)
    largest = lambda ids: max((i for i in ids if i is not None), default=None)
    gone = {k: largest(v) for k, v in held.items() if len(k) >= min_chars and len(v) >= min_docs}
    for i, t, _ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in gone or gone[key(x)] == i]
        yield i, len(lines), len(lines) - len(kept), "\n".join(kept)


def test_line_dedup(docs, nothing):
    got = line_dedup.drop_repeated_lines(docs).collect()
    made = collections.Counter((r["doc_id"], len(r["lines"]), len(r["lines"]) - len(r["kept"]), "\n".join(r["kept"])) for r in got)
    expected = collections.Counter(plain_lines(corpus()))
    assert made == expected and sum(r[2] for r in expected) >= 6
    assert line_dedup.drop_repeated_lines(nothing).count() == 0


def test_line_bitmaps_over_many_words(spark):  # noqa: F811
    common = [f"common line number {k} with more than forty characters" for k in range(150)]
    rows = [(i, "\n".join(x for k in range(150) for x in (common[k], f"own {i} {k}")), "s") for i in range(6)]
    got = {r["doc_id"]: r for r in line_dedup.drop_repeated_lines(make(spark, rows)).collect()}
    assert all(got[i]["kept"] == [f"own {i} {k}" for k in range(150)] for i in range(5))
    assert len(got[5]["kept"]) == 300


# ------------------------------------------------------------------------------------------------ simhash

def plain_simhash(text, k=4):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_groups(fps, radius=4):
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    fps = sorted(parent)
    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= radius:
                x, y = find(fps[a]), find(fps[b])
                parent[max(x, y)] = min(x, y)
    return {f: find(f) for f in fps}


@pytest.mark.parametrize("tile", [2048, 3])
def test_simhash(docs, nothing, tile):
    rows = corpus()
    got = simhash.simhash_groups(docs, tile=tile).collect()
    prints = {(i, t): plain_simhash(t) for i, t, _ in rows}
    root = plain_groups(prints.values())
    least = {}
    for (i, _), f in prints.items():
        if i is not None:
            least[root[f]] = min(least.get(root[f], i), i)
    expected = collections.Counter((i, f"{prints[i, t]:016x}", least.get(root[prints[i, t]])) for i, t, _ in rows)
    assert collections.Counter(map(tuple, got)) == expected
    assert simhash.simhash_groups(nothing).count() == 0


def test_links_of_random_words_with_small_tiles(spark):  # noqa: F811
    rng = np.random.default_rng(5)
    seeds = rng.integers(0, 2 ** 63, 40, dtype=np.int64)
    words = {int(s) for s in seeds}
    for s in seeds[:10]:                                                # chains and stars around some
        at = int(s)
        for _ in range(12):
            at ^= sum(1 << int(b) for b in rng.choice(63, int(rng.integers(1, 6)), replace=False))
            words.add(at)
    words |= {0, 1, 15, 31}
    frame = spark.createDataFrame([(w,) for w in words], "fp long")
    for tile in (2048, 4):
        parent = {w: w for w in words}

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x
        for u, v in simhash.fingerprint_links(frame, tile=tile).collect():
            parent[max(find(u), find(v))] = min(find(u), find(v))
        assert {w: find(w) for w in words} == plain_groups(words)


def test_toxicity_scores_are_plain_convolutions():
    """Every text scores as a plain convolution of its own words does, whatever stands beside it in the batch."""
    import pyarrow as pa
    rng = np.random.default_rng(0)
    words = [f"w{i}" for i in range(60)] + ["foul", "vile"]
    texts = [" ".join(rng.choice(words, size=rng.integers(0, 12))) for _ in range(300)]
    m = toxicity.fit(texts, np.array([int("foul" in t.split() or "vile" in t.split()) for t in texts]))

    def plain(text):
        index, _, buckets, _ = toxicity.words_of(pa.array([text]))
        vectors = [np.concatenate([m.tables[k][buckets[i, k]] for k in range(toxicity.TABLES)]).astype(float) for i in index]
        act = []
        for w, (width, taps) in enumerate(zip(toxicity.WIDTHS, m.filters)):
            row = vectors + [np.zeros(taps.shape[1])] * width
            maps = [sum(row[s + j] @ taps[j] for j in range(width)) for s in range(len(vectors) + 1)]
            act.append(np.maximum(np.max(maps, axis=0) + m.bias[w], 0))
        return float(np.concatenate(act) @ m.dense + m.offset)

    together = m.logits(*toxicity.words_of(pa.array(texts))[:3])
    assert np.abs(together - [plain(t) for t in texts]).max() < 1e-5
    some = rng.permutation(len(texts))[:77]
    assert np.abs(m.logits(*toxicity.words_of(pa.array([texts[i] for i in some]))[:3]) - together[some]).max() < 1e-5


# ------------------------------------------------------------------------------------------------ benchmark

ITEMS = [(1, "Anna has 12 apples and gives 5 of them to Peter who then walks 3 km home"),
         (2, "the quick brown fox jumps over the lazy dog near the old river bank"),
         (3, None), (4, ""), (5, "two words"), (None, "an item without any id but with enough words in it")]


def test_decontamination(spark, nothing):  # noqa: F811
    question = "Maria has 40 apples and gives 9 of them to Otto who then walks 7 miles home"
    mixed = "Maria has 40 apples and gives 9 of them to Otto"
    rows = [(10, f"Intro words here. {ITEMS[0][1]}. And more text after it.", "s"),
            (11, f"Some text before, {question}, and some after", "s"),
            (12, "Carl has 1 dog and some other text that shares nothing else with the item", "s"),
            (13, ITEMS[1][1].upper(), "s"), (14, "the quick brown fox jumps over a wall", "s"), (15, None, "s"), (16, "", "s"),
            (17, "two words", "s"), (18, "these two words stand inside a longer text", "s"), (19, mixed, "s"),
            (None, ITEMS[1][1], "s"), (20, ITEMS[5][1], "s"), (13, ITEMS[1][1].upper(), "s"),
            (21, "x " * 30_000 + ITEMS[1][1] + " y" * 30_000, "s")]
    items = spark.createDataFrame([(i, t, 1) for i, t in ITEMS], "item_id long, text string, h int")
    expected = {(10, 1, True), (11, 1, False), (13, 2, True), (17, 5, True), (None, 2, True), (20, None, True), (21, 2, True)}
    for bound in (10 ** 6, 0):                                          # either side of the broadcast's bound
        got = decontaminate.contaminated(make(spark, rows), items, broadcast_windows=bound).collect()
        assert {(r["doc_id"], r["item_id"], r["verbatim"]) for r in got} == expected and len(got) == len(expected)
    left = decontaminate.decontaminate(make(spark, rows), items)
    assert sorted(r["doc_id"] for r in left.collect()) == [12, 14, 15, 16, 18, 19]
    assert decontaminate.contaminated(nothing, items).count() == 0
    assert decontaminate.decontaminate(make(spark, rows), items.limit(0)).count() == len(rows)


def test_inconsistent_slots_do_not_count(spark):  # noqa: F811
    item = "if Anna meets Anna near the Danube then Anna tells Anna about the long Danube trip"
    broken = "if Berta meets Clara near the Tiber then Dora tells Emil about the long Rhone trip"
    renamed = item.replace("Anna", "Berta").replace("Danube", "Tiber")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = decontaminate.contaminated(make(spark, [(1, broken, "s"), (2, renamed, "s")]), items).collect()
    assert [(r["doc_id"], r["verbatim"]) for r in got] == [(2, False)]


def test_letter_case_hides_no_item(spark):  # noqa: F811
    item = "In 1945 Harry Truman met Josef Stalin in Potsdam near Berlin and 20 °C was the heat on the Straße to Weimar"
    around = "some text before. {} and some text after"
    rows = [(1, around.format(item.upper()), "s"), (2, around.format(item.lower()), "s"), (3, around.format(item.title()), "s"),
            (4, around.format(item), "s"), (5, item.swapcase(), "s"),
            (6, around.format(item.replace("Harry", "Carl").replace("Potsdam", "Jena")), "s"),
            (7, around.format("IN 1945 A MAN MET ANOTHER MAN NEAR THE TOWN AND 20 °C WAS THE HEAT ON THE ROAD"), "s")]
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    upper = spark.createDataFrame([(1, item.upper())], "item_id long, text string")
    got = decontaminate.contaminated(make(spark, rows), items).collect()
    assert {r["doc_id"]: (r["containment"], r["verbatim"]) for r in got} == {**dict.fromkeys(range(1, 6), (1.0, True)), 6: (1.0, False)}
    assert sorted(r["doc_id"] for r in decontaminate.contaminated(make(spark, rows), upper).collect()) == [1, 2, 3, 4, 5]


def test_windows_are_generated_code(spark):  # noqa: F811
    """Windows come from one generated loop that copies no tokens for a window, and templates are computed once."""
    rows = [(1, "Anna has 12 apples \x01and 5.5 KM", "s"), (2, "", "s"), (3, None, "s"), (4, "\U0001d400nd Zoë2Bob", "s")]
    made = decontaminate._windows(make(spark, rows), ["doc_id"], 5)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"\*\(\d+\) Generate posexplode\(hs", plan) and plan.count("(?i:kilo") == 2
    got = {(r["doc_id"], r["form"], r["place"]): r["values"] for r in made.collect()}
    assert got == {
        (1, 0, 0): ["\x01anna", "has", "\x0212", "apples", "and"], (1, 0, 1): ["has", "\x0212", "apples", "and", "\x025\x045"],
        (1, 0, 2): ["\x0212", "apples", "and", "\x025\x045", "\x03km"], (1, 1, 0): ["anna", "has", "\x0212", "apples", "and"],
        (1, 1, 1): ["has", "\x0212", "apples", "and", "\x025\x045"], (1, 1, 2): ["\x0212", "apples", "and", "\x025\x045", "\x03km"],
        (4, 0, 0): ["\x01\U0001d400nd", "\x01zoë\x022bob"], (4, 1, 0): ["\x01\U0001d400nd", "zoë\x022bob"]}


def test_one_split_gives_the_windows_of_both_forms(spark):  # noqa: F811
    """Windows of documents are those of the two templates, also where case, units and names meet; one split."""
    texts = [None, "", "one", "Anna has 12 apples and 5.5 KM to go", "\U0001d400nd Zoë2Bob 3 \U0001d400\U0001d41b",
             "5 Meters and 5 meters", "in 1995 Microsoft", "20 °Celsius 20 °C", "3 K\u212am", "3 \u212am", "5%Anna 5%anna 5 €Otto", "5 \u017f and 5 m\u0131n", "7 kw\u1e96", "12KM\u0345",
             "1.5°C\u0345", "ΑΣ5 ⅷΣ σας", "Stra\x01ße STRASSE Straẞe", "ŉ ǰ ﬁ ﬆ Ⓐ ⓐ ϒa ℂb Dž", "Жуков 5 км. 中文 ½ ٣", "a b c d e f g " * 3]
    rng = np.random.default_rng(3)
    bits = sorted({b for t in texts if t for b in re.findall(r"\w+?|\W", t)} | {"km", "Km", "Euro", "Anna", "12", " ", "°C", "%"})
    texts += ["".join(rng.choice(bits, rng.integers(1, 12))) for _ in range(4000)]
    rows = make(spark, [(i, t, "s") for i, t in enumerate(texts)])
    forms = [decontaminate._hashes(decontaminate.template(t), 5) for t in decontaminate._forms(F.col("text"))]
    expected = {r["doc_id"]: set(r["a"]) | set(r["b"]) for r in rows.select("doc_id", forms[0].alias("a"), forms[1].alias("b")).collect()}
    for distinct in (False, True):
        made = decontaminate._document_windows(rows, ["doc_id"], 5, distinct)
        got = {r["doc_id"]: set(r["hs"]) for r in made.groupBy("doc_id").agg(F.collect_set("h").alias("hs")).collect()}
        assert {i: got.get(i, set()) for i in expected} == expected
    plan = decontaminate._document_windows(rows, ["doc_id"], 5, False)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"\*\(\d+\) Generate posexplode\(hs", plan) and plan.count("split(") == 3     # two of them the long way


def test_frames_elsewhere_do_not_outvote_an_item(spark):  # noqa: F811
    item = "In 1945 Harry Truman was the President of the United States and signed the papers for the Bank of the West in Paris"
    frames = " then came the Battle of the Somme" * 8
    renamed = item.replace("Harry", "Carl").replace("States", "Kingdom").replace("Bank", "House").replace("West", "East")
    other = item.replace("Harry", "Otto").replace("States", "Nations").replace("Bank", "Port").replace("West", "North")
    tail = " where many people of the town had come to hear him speak about the plans for the coming years in peace"
    edited = renamed.replace("signed the", "signed all of the") + tail            # the alignment moves on the way
    rows = [(1, f"{frames}. {item}.{frames}", "s"), (2, f"{frames}. {renamed}.{frames}", "s"), (3, frames, "s"),
            (4, f"{renamed}. {other}. {item}. {other}. {renamed}", "s"), (5, f"{'x ' * 90}{edited}{' y' * 90}{frames}", "s"),
            (6, f"{item[:40]}.{frames}", "s")]
    items = spark.createDataFrame([(1, item), (2, item + tail)], "item_id long, text string")
    got = decontaminate.contaminated(make(spark, rows), items).collect()
    assert {(r["doc_id"], r["item_id"], r["containment"] == 1, r["verbatim"]) for r in got} == {
        (1, 1, True, True), (2, 1, True, False), (4, 1, True, True), (5, 2, False, False)} and len(got) == 4


def test_items_of_names_alone_match_literally(spark):  # noqa: F811
    items = spark.createDataFrame([(1, "Who Wrote The Great Gatsby")], "item_id long, text string")
    rows = [(1, "we read the New York Times Best Seller list again", "s"), (2, "asked: Who Wrote The Great Gatsby? he said", "s")]
    got = decontaminate.contaminated(make(spark, rows), items).collect()
    assert [(r["doc_id"], r["verbatim"]) for r in got] == [(2, True)]
