"""Spelling variants, conversation repair and url filters against plain versions, with awkward rows."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from boostframe.llm import conversation_repair, spelling, url_filter
from tests.conftest import spark  # noqa: F401


# ------------------------------------------------------------------------------------------------ spelling variants

def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def plain_groups(counts, ratio=10):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = set()
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, counts[w], len(near[w]), form[w], counts.get(form[w]), root))
    return out


def vocabulary(rng):
    words = {"", "a", "ab", "ba", "abc", "abd", "bc", "éa", "aaaa", "aaaaa", "aaaaaa", "x" * 400, "x" * 401, "y" + "x" * 400}
    stems = ["".join(rng.choice("abée") for _ in range(rng.randint(3, 12))) for _ in range(60)]
    for stem in stems:
        words.add(stem)
        for _ in range(4):
            i = rng.randrange(len(stem))
            words.add(rng.choice([stem[:i] + stem[i + 1:], stem[:i] + "z" + stem[i:], stem[:i] + rng.choice("abé") + stem[i + 1:]]))
    return {w: rng.choice([1, 2, 3, 25, 40, 400, 5000]) for w in words}


def test_variant_groups(spark):  # noqa: F811
    counts = vocabulary(random.Random(3))
    frame = spark.createDataFrame([(w, n, "x", 1) for w, n in counts.items()] + [(None, 5, "x", 1)],
                                  "word string, n long, near string, root long")
    got = spelling.variant_groups(frame.repartition(5))
    rows = got.select("word", "n", "n_near", "form", "form_n", "root").collect()
    assert len(rows) == len(counts) and {tuple(r) for r in rows} == plain_groups(counts)
    assert spelling.variant_groups(frame.limit(0)).count() == 0
    with pytest.raises(ValueError, match="ratio"):
        spelling.variant_groups(frame, ratio=1)


def test_pivots_share_no_letter_and_are_the_rarest():
    rng = random.Random(1)
    for _ in range(300):
        places = sorted(rng.sample(range(12), rng.randint(3, 7)))
        weights = [rng.randint(0, 9) for _ in places]
        chosen = spelling.choose_pivots(places, weights)
        pairs = [(weights[i] + weights[j]) for i, j in itertools.combinations(range(len(places)), 2) if places[j] - places[i] >= 2]
        assert len(chosen) == 2 and chosen[1] - chosen[0] >= 2
        assert sum(weights[places.index(p)] for p in chosen) == min(pairs)


def test_every_near_pair_meets_on_a_pivot(spark):  # noqa: F811
    counts = {w: n for w, n in vocabulary(random.Random(8)).items() if len(w) >= 5}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = {(r["word"], r["near"]) for r in spelling.near_words(frame).collect()}
    assert found == {(a, b) for a in counts for b in counts if one_edit(a, b)}


def test_word_counts(spark):  # noqa: F811
    rows = [(1, "Straße ABCDEFGH abcdefgh, ABCDEFGH-x ÀÉîöüßÿ ÀÉîöüßÿ"), (2, None), (3, ""), (None, "abcdefgh short"), (4, "abcdefgh " * 9000),
            (4, "abcdefgh")] + [(i, "wordnumber other_wording") for i in range(100, 260)]
    got = {r["word"]: r["n"] for r in spelling.word_counts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    expected = collections.Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            expected[run[:h % len(run)] + run[h % len(run) + 1:] if h % 31 == 0 else run] += 1
    assert got == {w: n for w, n in expected.items() if n >= 2 and len(w) >= 7}
    assert any(len(w) == 9 for w in got)            # a misprint of "wordnumber" occurs


# ------------------------------------------------------------------------------------------------ conversation repair

def ordered(turns):
    return sorted(turns, key=lambda r: (r[0] is not None, r[0] or 0, " " if r[1] is None else r[1],
                                        hashlib.md5((" " if r[2] is None else r[2]).encode()).hexdigest()))


def plain_repair(turns):
    """All edit strings up to the cost of deleting everything, by exhaustive search."""
    rows, faults, seen = [], collections.Counter(), set()
    for _, role, text in ordered(turns):
        role, text = " " if role is None else role, " " if text is None else text
        body = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
        seen.add((role, text))
        faults[fault] += 1
        rows.append((role, text, fault))
    best = (3 * len(rows) + 1,)
    stack = [(0, "", "", [])]
    limit = min(3 * len(rows), 24)
    while stack:
        i, audit, roles, out = stack.pop()
        cost = sum({"K": 0, "R": 2, "D": 3, "I": 2}[e] for e in audit) + out.count("late")
        if cost > min(best[0], limit) or not re.fullmatch("(s?(ua)*u?)?", roles):
            continue
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", roles) and (cost, audit) < best[:2]:
            best = (cost, audit, [x for x in out if x != "late"])
        due = "assistant" if roles.endswith("u") else "user"
        if not audit.endswith("III"):
            stack.append((i, audit + "I", roles + due[0], out + [f"{due}:"]))
        if i < len(rows):
            role, text, fault = rows[i]
            late = ["late"] if fault == "truncated" else []
            stack.append((i + 1, audit + "D", roles, out))
            if fault not in ("blank", "duplicate"):
                stack.append((i + 1, audit + "R", roles + due[0], out + [f"{due}:{text}", *late]))
                if role[:1] in ("s", "u", "a"):
                    stack.append((i + 1, audit + "K", roles + role[0], out + [f"{role}:{text}", *late]))
    known = [t for t, _, _ in turns if t is not None]
    initials = [r[0][:1] for r in rows]
    return {"gaps": max(known) - min(known) + 1 - len(set(known)) if known else 0, "blank": faults["blank"],
            "duplicate": faults["duplicate"], "truncated": faults["truncated"],
            "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), "cost": best[0], "audit": best[1],
            "lines": best[2]}


def conversations():
    rng = random.Random(5)
    rows = []
    for c in range(120):
        for t in range(rng.randint(1, 6)):
            role = rng.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None, "ux"])
            rows.append((c, rng.choice([t, t, t, t + 3, None]), role, rng.choice(["Hi.", "Yes!", "no end", "", " \t", None, f"{t}?", "é\n.  "])))
    rows += [(500, 0, "system", "Only."), (501, 0, "assistant", "Hi."), (502, 0, "user", "x."), (502, 0, "user", "x."),
             (503, 5, "user", "long " * 30_000 + "."), (503, 6, "assistant", "ok."), (None, 1, "user", "a."), (None, 2, "assistant", "b.")]
    return rows


def test_conversation_repair(spark):  # noqa: F811
    rows = conversations()
    frame = spark.createDataFrame([(*r, "a", 1) for r in rows], "conv_id long, turn long, role string, text string, audit string, key long")
    by = collections.defaultdict(list)
    for c, *turn in rows:
        by[c].append(tuple(turn))
    expected = {c: plain_repair(turns) for c, turns in by.items()}
    for chunk in (conversation_repair.CHUNK, 2):
        plan = conversation_repair.repair_plan(frame.repartition(4), chunk=chunk)
        got = {r["conv_id"]: r.asDict() for r in plan.collect()}
        assert set(got) == set(expected)
        for c, e in expected.items():
            assert {k: v for k, v in got[c].items() if k != "conv_id"} == {k: v for k, v in e.items() if k != "lines"}, c
    turns = conversation_repair.repaired_turns(frame, plan).collect()
    said, digest = collections.defaultdict(dict), {}
    for r in turns:
        if r["pos"] is None:
            digest[r["conv_id"]] = r["sha256"]
        else:
            said[r["conv_id"]][r["pos"]] = f"{r['role']}:{r['text']}"
    for c, e in expected.items():
        lines = [said[c][i] for i in range(len(said[c]))]
        assert lines == e["lines"] and digest[c] == hashlib.sha256("\n".join(lines).encode()).hexdigest()
    assert conversation_repair.repair_plan(frame.limit(0)).count() == 0


def test_long_conversation_in_chunks(spark):  # noqa: F811
    frame = (spark.range(3000).select(F.lit("one").alias("conv_id"), F.col("id").alias("turn"),
                                      F.when(F.col("id") % 7 == 0, "system").when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
                                      F.concat(F.lit("t"), F.col("id"), F.lit(".")).alias("text")))
    whole, cut = (conversation_repair.repair_plan(frame, chunk=c).first() for c in (1 << 16, 250))
    assert whole == cut and len([e for e in cut["audit"] if e != "I"]) == 3000


def test_crc_in_sql():
    duckdb = pytest.importorskip("duckdb")
    for text in ("", "1:0", "né:€😀", "x" * 300):
        (got,), = duckdb.execute(f"SELECT {conversation_repair.sql_crc32('s')} FROM (SELECT ? AS s), {conversation_repair.CRC_TABLE}", [text]).fetchall()
        assert got == zlib.crc32(text.encode())


# ------------------------------------------------------------------------------------------------ url filters

def plain_host_path(url):
    if url is None or "://" not in url:
        return "", ""
    host, path = re.fullmatch(r"([^/?#]*)([^?#]*).*", url.split("://", 1)[1], re.S).groups()
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def plain_rule(url, rules):
    host, path = plain_host_path(url)
    fits = [(len(h + p), v == "allow", h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[2:] if fits else (None, None)


URLS = ["http://Example.ORG/es/x", "https://www.example.org/es/x#top", "http://a.example.org/en/12", "http://a.org/", "http://a.org", "http://notorg/",
        "https://shop.com/de/1", "http://m.shop.com/de/1/", "https://shop.com/de", "https://shop.com/de/", "https://shop.com/fr/9?ref=x&page=2",
        "https://shop.com/fr/9?page=2", "https://other.net/x", "https://alias.net/y?utm_source=q", "http://alias.net/y", "ftp://u:p@com:80/de/",
        "no scheme", "", None, "http:///only/path", "http://" + "a." * 300 + "org/x", "http://" + "long" * 5000 + ".org/" + "p" * 20_000,
        "http://tie.net/a", "http://chain.net/3", "http://chain.net/1", "http://chain.net/2", "http://loop.net/a", "http://loop.net/b", "x://..org/"]


def test_url_verdicts(spark):  # noqa: F811
    rules = url_filter.RULES + [("block", "tie.net", "/a"), ("allow", "TIE.net", "/a"), ("block", "chain.net", "/3"), ("allow", "chain.net", "/2")]
    extra = [("deny", "x", "/"), ("block", None, "/"), ("block", "y" * 300, "/")]
    edges = [("https://other.net/x", "https://shop.com/de/1"), ("http://chain.net/1", "http://chain.net/2"), ("http://chain.net/2", "http://chain.net/3"),
             ("http://loop.net/a", "http://loop.net/b"), ("http://loop.net/b", "http://loop.net/a"), (None, "http://a.org"), ("http://a.org", None),
             ("http://alias.net/y", "http://gone.com/de/elsewhere"), ("http://chain.net/1", "http://chain.net/2")]
    urls = spark.createDataFrame([(u, "h", "r") for u in URLS + URLS[:4]], "url string, host string, rule string")
    got = url_filter.url_verdicts(urls, spark.createDataFrame([(*r, 1) for r in rules + extra], "verdict string, host string, path string, url long"),
                                  spark.createDataFrame([(*e, "k") for e in edges], "src string, dst string, kind string")).collect()
    assert len(got) == len(set(URLS))
    lower = [(v, h.lower(), p) for v, h, p in rules]
    blocked_by_alias = {"https://other.net/x", "http://chain.net/1", "https://alias.net/y?utm_source=q", "http://alias.net/y", "https://shop.com/de"}
    for r in got:
        assert (r["host"], r["path"]) == plain_host_path(r["url"]), r["url"]
        rule, said = plain_rule(r["url"], lower)
        assert (r["rule"], r["verdict"]) == (rule, said or ("block" if r["url"] in blocked_by_alias else "allow")), r["url"]


def test_pages_state_their_links(spark):  # noqa: F811
    pages = [(1, "http://a.net/x/y", '<LINK href="/z" rel="Canonical nofollow">'), (2, "http://a.net/x/y", "<meta http-equiv=refresh content='0; URL=other?a=1&amp;b=2'>"),
             (3, "http://a.net", "<link rel=canonical href=//b.org/es/>"), (4, "http://c.net/", "<!-- <link rel=canonical href=/no> --><script>'<link rel=canonical href=/no>'</script>"),
             (5, None, "<link rel=canonical href=/no>"), (6, "no scheme", "<link rel=canonical href=/no>"), (7, "http://d.net/a", None),
             (8, "http://e.net/a", "<link rel=stylesheet href=/canonical.css><meta name=refresh content=5>"), (9, "http://f.net/q", "<link rel='canonical' href=''>"),
             (10, "http://blocked.net/", "<p>" + "word " * 50_000 + "</p><link rel=canonical href='http://x.example.org/es/1'>"), (10, "http://blocked.net/", "copy")]
    frame = spark.createDataFrame([(*p, "s") for p in pages], "page_id long, url string, html string, src string")
    links = {(r["src"], r["dst"], r["kind"]) for r in url_filter.page_links(frame).collect()}
    assert links == {("http://a.net/x/y", "http://a.net/z", "canonical"), ("http://a.net/x/y", "http://a.net/x/other?a=1&b=2", "redirect"),
                     ("http://a.net", "http://b.org/es/", "canonical"), ("http://blocked.net/", "http://x.example.org/es/1", "canonical")}
    judged = url_filter.judge_pages(frame, url_filter.rule_table(spark))
    got = [(r["page_id"], r["verdict"]) for r in judged.collect()]
    assert sorted(x for x, v in got if v == "block") == [10, 10] and len(got) == len(pages)
    assert url_filter.judge_pages(frame.limit(0), url_filter.rule_table(spark)).count() == 0
    log = spark.createDataFrame([("http://c.net/", "http://y.com/de/1")], "src string, dst string")
    assert {r["page_id"] for r in url_filter.judge_pages(frame, url_filter.rule_table(spark), log).where("verdict = 'block'").collect()} == {4, 10}
