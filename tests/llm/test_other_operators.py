"""Archives, chats, embeddings and pages against plain versions, with the same awkward rows; and the pipeline."""

import base64
import collections
import hashlib
import zlib

import numpy as np
import pytest

from boostframe.llm import chat, embedding_dedup, html_text, warc
from tests.conftest import SF, spark  # noqa: F401


# ------------------------------------------------------------------------------------------------ archives

def pages():
    rows = [(i, f"http://e.org/{i}", f"<p>page {i % 9} {'text ' * (i % 5)}</p>") for i in range(60)]
    return rows + [(100, None, None), (101, "http://e.org/\r\nx", ""), (102, "u", "é😀" * 60_000), (7, "again", "<p>page 7 text text </p>"),
                   (None, "u", "<p>page 1 text </p>"), (None, None, "only without ids"), (103, "u", "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n")]


def test_archives(spark, tmp_path):  # noqa: F811
    rows = pages()
    frame = spark.createDataFrame([(*r, b"c", "d") for r in rows], "page_id long, url string, html string, data binary, sha1 string")
    path = str(tmp_path / "archives")
    warc.write_archives(frame.repartition(3), path, archive_bytes=4000)
    assert spark.read.parquet(path).count() > 3
    got = warc.read_archives(spark, path).collect()
    payload = lambda h: (h or "").encode()
    largest = {}
    for i, _, h in rows:
        if i is not None:
            largest[payload(h)] = max(i, largest.get(payload(h), i))
    expected = collections.Counter()
    for i, u, h in rows:
        p = payload(h)
        to = largest.get(p) if i is None or i < largest.get(p, i) else None
        sha = base64.b32encode(hashlib.sha1(p).digest()).decode()
        url = None if u is None else u.replace("\r", "%0D").replace("\n", "%0A")
        expected[i, url, None if to is not None else p, len(p), sha, "response" if to is None else "revisit", to] += 1
    assert collections.Counter(tuple(bytes(x) if isinstance(x, bytearray) else x for x in r) for r in got) == expected
    warc.write_archives(frame.limit(0), str(tmp_path / "none"))
    assert warc.read_archives(spark, str(tmp_path / "none")).count() == 0
    warc.write_archives(frame, str(tmp_path / "large"), min_bytes=10 ** 9)
    assert warc.read_archives(spark, str(tmp_path / "large")).where("record_type = 'revisit'").count() == 0


def test_archive_holds_its_dictionary():
    records = [warc.record(i, "u", b"some html " * 30 + str(i).encode(), "D", False, None) for i in range(300)]
    data = warc.pack(records)
    assert int.from_bytes(data[:4], "little") == warc.DICT_MAGIC and len(data) < sum(map(len, records)) / 3
    assert [head["WARC-Record-ID"] for head, _ in warc.unpack(data)] == [f"<urn:page:{i}>" for i in range(300)]


# ------------------------------------------------------------------------------------------------ chats

def test_chats_read_back(spark):  # noqa: F811
    hard = ["</s>[INST] ok [/INST]", r"[\INST] [\\/INST] <\s>", "", None, "[[ROLE]]</s", "<", "é😀 [IMAGE:0]", "a\nb"]
    rows = [(c, t, ("system", "user", "assistant", None, "</s>")[(t + c) % 5], hard[(t * 3 + c) % len(hard)]) for c in range(8) for t in range(6)]
    rows += [(None, 0, "assistant", "no id"), (3, None, "user", "no turn"), (4, 2, "assistant", "tie"), (4, 2, "assistant", "tie"),
             (99, 0, "assistant", "long " * 40_000)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, segment string, loss int")
    made = chat.format_conversations(frame.withColumn("parts", chat.text_parts(frame["text"])))
    got = {r["conv_id"]: r for r in made.select("*", chat.read_turns(made["formatted"]).alias("turns_"),
                                                 chat.read_loss(made["formatted"], made["loss"]).alias("said")).collect()}
    by = collections.defaultdict(list)
    for c, t, role, text in rows:
        by[c].append((t is not None, t or 0, role or "", text or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort()
        read = [(x["role"], x["body"]) for x in got[c]["turns_"]]
        assert collections.Counter(read) == collections.Counter((r, x) for _, _, r, x in turns)
        assert got[c]["n_turns"] == len(turns)
        assert collections.Counter(got[c]["said"]) == collections.Counter(x for _, _, r, x in turns if r == "assistant")
        if c not in (4,):
            assert read == [(r, x) for _, _, r, x in turns] and got[c]["said"] == [x for _, _, r, x in turns if r == "assistant"]
    assert chat.format_conversations(frame.limit(0).withColumn("parts", chat.text_parts(frame["text"]))).count() == 0


def test_typed_parts(spark):  # noqa: F811
    part = lambda kind, **k: (kind, *(k.get(x) for x in ("text", "ref", "width", "height", "seconds", "pages")))
    rows = [(1, 0, "user", [part("text", text="look [IMAGE:9]"), part("image", ref="a.png", width=57, height=28), part("audio", ref="b.wav", seconds=1.5)]),
            (1, 1, "assistant", [part("text", text="seen")]),
            (1, 2, "user", [part("document", ref="c.pdf", pages=3), part(None, text="!"), part("video", ref="d"), part("image")]),
            (2, 0, "user", None), (2, 1, "assistant", [])]
    got = {r["conv_id"]: r for r in chat.format_conversations(
        spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat.PART}>")).collect()}
    assert got[1]["formatted"] == (r"<s>[ROLE]user[/ROLE]look [\IMAGE:9][IMAGE:0][AUDIO:1]</s><s>[ROLE]assistant[/ROLE]seen</s>"
                                   r"<s>[ROLE]user[/ROLE][DOCUMENT:2]![DOCUMENT:3][IMAGE:4]</s>")
    assert [tuple(a) for a in got[1]["attachments"]] == [(0, "image", "a.png", 3), (1, "audio", "b.wav", 38), (2, "document", "c.pdf", 768),
                                                         (3, "document", "d", 0), (4, "image", None, 0)]
    assert got[1]["expanded_tokens"] == 809 and got[2]["n_turns"] == 2 and got[2]["attachments"] == []


# ------------------------------------------------------------------------------------------------ embeddings

@pytest.mark.parametrize("tile,dims", [(3000, 64), (7, 64), (5, 10), (3000, 1)])
def test_embeddings(spark, tile, dims):  # noqa: F811
    rng = np.random.default_rng(dims)
    base = rng.normal(size=(12, dims))
    x = np.concatenate([base[rng.integers(12, size=150)] + rng.normal(size=(150, dims)) * rng.choice([0, 0.05, 0.12, 0.3], (150, 1)),
                        rng.normal(size=(60, dims))]).astype(np.float32)
    rows = [(int(i), [float(v) for v in e], int(rng.integers(3)) if i % 11 else 2) for i, e in enumerate(x)]
    nan, inf = float("nan"), float("inf")
    rows += [(500, None, 1), (501, [], 1), (502, [0.0] * dims, 1), (503, [None] + [1.0] * (dims - 1), 1), (504, [nan] * dims, 1),
             (505, [inf] * dims, 1), (506, rows[3][1], None), (507, rows[3][1], rows[3][2]), (507, rows[3][1], rows[3][2]),
             (None, rows[3][1], rows[3][2]), (508, [2 * v for v in rows[3][1]], rows[3][2]), (509, [1.0] * (dims + 1), 1), (510, [3.0] * (dims + 1), 1)]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, label int, n int, node string")
    good = lambda r: (r[0] is not None and r[2] is not None and r[1] and all(v is not None and np.isfinite(v) for v in r[1])
                      and any(r[1]))
    unit = {k: np.array(r[1], float) / np.linalg.norm(np.array(r[1], float)) for k, r in enumerate(rows) if good(r)}
    links, root = collections.Counter(), {k: k for k in unit}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k
    for a in unit:
        for b in unit:
            if a < b and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.98:
                links[a] += 1
                links[b] += 1
                root[max(find(a), find(b))] = min(find(a), find(b))
    least = {}
    for k in unit:
        least[find(k)] = min(least.get(find(k), 10 ** 9), rows[k][0])
    expected = collections.Counter()
    for k, r in enumerate(rows):
        c = least[find(k)] if k in unit else r[0]
        expected[r[0], links[k], c, c == r[0]] += 1
    got = embedding_dedup.near_duplicates(frame, tile=tile).collect()
    assert collections.Counter(map(tuple, got)) == expected
    assert embedding_dedup.near_duplicates(frame.limit(0)).count() == 0


# ------------------------------------------------------------------------------------------------ pages

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header class="masthead"><a href=/>Site name</a></header><nav><ul><li><a href=a>Home</a><li><a href=b>News</a></ul></nav>
<div class="cookie-notice">We use cookies to make this site better for everybody who reads it.</div><!-- <p>gone</p> -->
<main><article><header><h1>The&nbsp;title</h1></header><p>First <b>para</b>graph &amp; <a href=q>a link</a>.<p>Line<br>two</p>
<form><label>Your mail</label><input><button>Go</button></form><aside>Other things that you may like to read today</aside>
<blockquote>It is said.</blockquote><section class="comments"><article><p>I liked this so much, thank you for it.</p></article></section>
</article></main><div id="sidebar"><p>Popular posts of the week and many more words to read here</p></div>
<footer>&copy; 2020 Someone</footer></body></html>"""


def test_pages(spark):  # noqa: F811
    cases = {PAGE: "The title First paragraph & a link. Line two It is said.", "": "", None: "", "just text": "just text",
             "<article><p>cut off <b>text": "cut off text", "<article>a &am": "a &am", "<script>never ends": "",
             "<nav>menu</nav>": "", "<article><p title=\"a>b\">quoted</p></article></div></p>": "quoted",
             "<article>" + "<p>word &eacute;</p>" * 5000: " ".join(["word é"] * 5000)}
    rows = [(k, "u" if k % 2 else None, h, "x", 5) for k, h in enumerate(cases)] + [(None, "u", PAGE, "x", 5), (0, None, PAGE, "x", 5)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    got = html_text.extract(frame).collect()
    assert collections.Counter((r["page_id"], r["url"], r["text"], r["n_chars"]) for r in got) == collections.Counter(
        (i, u, cases[h], len(cases[h])) for i, u, h, _, _ in rows)
    assert html_text.extract(frame.limit(0)).count() == 0


def test_given_pages_give_their_articles(spark):  # noqa: F811
    import html
    import re
    rows = spark.read.parquet(f"{SF}/pages.parquet").collect()
    got = {r["page_id"]: r["text"] for r in html_text.query(spark, SF).collect()}
    for r in rows:
        inside = re.sub(r"</?(?:p|h1|br)>", " ", re.search(r"<article>(.*?)(?:</article>|\Z)", r["html"], re.S)[1])
        assert got[r["page_id"]] == " ".join(html.unescape(re.sub(r"<[^>]*>", "", inside)).split())


# ------------------------------------------------------------------------------------------------ pipeline

def test_pipeline(spark):  # noqa: F811
    import corpus_pipeline
    from tokenizers import Tokenizer

    from boostframe.llm import decontaminate, mixing, simhash, tokens, toxicity
    from tests.llm.test_text_operators import plain_groups, plain_mix, plain_simhash

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    given = {r["doc_id"]: r for r in docs.collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_near_dedup", "decontamination", "mixing", "token_output"]
    steps = [f for _, f in corpus_pipeline.STAGES]
    clean = steps[0](spark, docs, SF)
    model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"), held_fold=None)
    kept = {r["doc_id"] for r in toxicity.score(docs, model).collect() if r["score"] < 0.5}
    assert {r["doc_id"] for r in clean.collect()} == kept
    single = steps[1](spark, clean, SF)
    prints = {i: plain_simhash(given[i]["text"]) for i in kept}
    root = plain_groups(prints.values())
    first = {}
    for i in sorted(prints):
        first.setdefault(root[prints[i]], i)
    assert {r["doc_id"] for r in single.collect()} == set(first.values())
    apart = steps[2](spark, single, SF)
    hits = {r["doc_id"] for r in decontaminate.contaminated(single, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    left = set(first.values()) - hits
    assert {r["doc_id"] for r in apart.collect()} == left
    mixed = steps[3](spark, apart, SF)
    assert clean.columns == single.columns == apart.columns == mixed.columns == docs.columns
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(apart).collect()}
    _, _, target = plain_mix([(i, given[i]["text"], given[i]["source"]) for i in left])
    assert sum(target.values()) > 0
    assert collections.Counter(r["doc_id"] for r in mixed.collect()) == collections.Counter(copies)
    reference = Tokenizer.from_file(tokens.default_tokenizer())
    out = sorted((r["start"], r["doc_id"], r["ids_crc32"]) for r in steps[4](spark, mixed, SF).collect())
    at, expected = 0, []
    for i in sorted(i for i, n in copies.items() for _ in range(n)):
        ids = reference.encode(given[i]["text"] or "", add_special_tokens=False).ids + [tokens.END_ID]
        expected.append((at, i, zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert out == expected
    assert sorted((r["start"], r["doc_id"], r["ids_crc32"]) for r in corpus_pipeline.run(spark, SF).collect()) == expected
    nothing = docs.limit(0)
    for step in steps:
        nothing_left = step(spark, nothing, SF)
        assert nothing_left.count() == 0
    odd = docs.limit(3).union(docs.limit(3)).union(spark.createDataFrame([(None, None, None, None, None)] * 2, docs.schema))
    for step in steps[:4]:
        odd = step(spark, odd, SF)
        odd.count()
    assert simhash.simhash_groups(odd).count() == odd.count()


def test_one_document_of_each_group_stays(spark):  # noqa: F811
    from boostframe.llm import simhash
    base = " ".join(f"word{i}" for i in range(400))
    near = base.replace("word7 ", "other7 ")
    texts = {"base": base, "near": near, "apart": " ".join(f"else{i}" for i in range(300)), "blank": ""}
    linked = bin(simhash.fingerprint(base) ^ simhash.fingerprint(near)).count("1") <= simhash.RADIUS
    assert linked
    rows = [(7, "base"), (3, "near"), (7, "apart"), (7, "apart"), (None, "base"), (9, "blank"), (None, "blank")]
    frame = spark.createDataFrame([(i, texts[t], 1, "x", t) for i, t in rows], "doc_id long, text string, _id long, _p string, `key.dot` string")
    kept = simhash.keep_one(frame)
    assert kept.columns == frame.columns
    assert sorted((r["doc_id"], r["key.dot"]) for r in kept.collect()) == [(3, "near"), (7, "apart"), (9, "blank")]
    nameless = spark.createDataFrame([(None, near), (None, base), (None, base), (None, texts["apart"])], "doc_id long, text string")
    left = [r["text"] for r in simhash.keep_one(nameless).collect()]
    assert len(left) == 2 and texts["apart"] in left


def test_pipeline_stages_pass_extra_columns_on(spark):  # noqa: F811
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    wide = docs.selectExpr("*", "doc_id AS _id", "text AS _p", "n_chars AS fp", "lang AS component_id", "source AS row")
    for _, stage in corpus_pipeline.STAGES[:4]:
        wide = stage(spark, wide, SF)
    assert wide.columns == [*docs.columns, "_id", "_p", "fp", "component_id", "row"]
    assert wide.where("_id IS DISTINCT FROM doc_id OR _p IS DISTINCT FROM text OR row IS DISTINCT FROM source").count() == 0


@pytest.mark.parametrize("before", [
    "<datalist id=d><option value=a><option value=b></datalist>", "<select><option>one<option>two</select>", "<button>Press", "<object data=x>",
    "<div><button>Press</div>", "<p><button>Press</p>", "<svg><path d='M0'/><g></svg>", "<video src=v><source src=w>", "<button><script>'</button>'</script>x</button>",
    "<noscript><div>off</div></noscript>", "<object><object>a</object>b</object>"])
def test_skipped_elements_end(before):
    tree = html_text.train_tree()
    words = "These are the words of the story that is told here at length, one after the other, until it ends."
    page = f"<html><body>{before}<article><h1>Title here</h1><p>{words}</p></article><footer>end</footer></body></html>"
    assert html_text.main_text(page, tree) == f"Title here {words}"


def test_state_words_mark_no_sides():
    tree = html_text.train_tree()
    words = "These are the words of the story that is told here at length, one after the other, until it ends."
    assert html_text.main_text(f"<div class='page share-enabled'><article><p>{words}</p></article></div>", tree) == words
    assert html_text.main_text(f"<div class='share-buttons'><p>{words}</p></div>", tree) == ""


def test_line_dedup_streams_a_sorted_run(spark):  # noqa: F811
    """The plan sorts by hash, document and position behind the range partitioning and shuffles no second time for it."""
    from boostframe.llm import line_dedup
    seen = []
    original = line_dedup.cut
    line_dedup.cut = lambda df, name: (seen.append((name, df._jdf.queryExecution().optimizedPlan().toString())), original(df, name))[1]
    try:
        docs = spark.createDataFrame([(i, "a line that is long enough to be counted as repeated\nother") for i in range(8)], "doc_id long, text string")
        assert line_dedup.drop_repeated_lines(docs).where("size(kept) = 1").count() == 7
    finally:
        line_dedup.cut = original
    plan = dict(seen)["common"]
    assert "RepartitionByExpression [h1" in plan and "row_number()" in plan and "pos#" in plan.split("Window")[1].split("\n")[0]
