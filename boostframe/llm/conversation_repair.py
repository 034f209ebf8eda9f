"""Repair of conversation structure at least cost (operator 12).

Faults of single turns are found by DataFrame functions. The turns' classes (a role initial, "must go", "truncated"), not
their texts, are then repartitioned by conversation, sorted by turn and streamed through ``mapInPandas``: a dynamic
program over four states whose state (relative costs and the order of the prefixes) is carried from Arrow batch to Arrow
batch. Its steps form a small automaton that is built as it is met, so a turn's backpointers are the number of one step, two
bytes. A conversation longer than ``chunk`` turns spills them: they leave the task as rows of the stage's table, and a
second stream, sorted from the last chunk to the first, traces the cheapest edits back. `repaired_turns` sorts the texts in
the same way behind their conversation's edits and streams the repaired turns.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE, WORD, cut, prepare, table

START, SYSTEM, USER, ASSISTANT = range(4)
KEEP, REROLE, DELETE, INSERT = "KRDI"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
#: The role that an inserted or re-roled turn gets after each state, and the state that follows.
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}
CHUNK = 1 << 16


# ------------------------------------------------------------------------------------------------ dynamic program

def _moves(initial: str, must_go: bool, truncated: bool) -> list[tuple[int, int, int, str]]:
    """(from, to, cost, edits) of one turn: at most two inserts (a third repeats a state), then what happens to it."""
    out = []
    for state in range(4):
        at, inserts = state, ""
        for _ in range(3):
            base = COST[INSERT] * len(inserts)
            out.append((state, at, base + COST[DELETE], inserts + DELETE))
            if not must_go:
                follow = NEXT[at]
                out.append((state, follow, base + COST[REROLE] + truncated, inserts + REROLE))
                if initial == "u" and follow == USER or initial == "a" and follow == ASSISTANT:
                    out.append((state, follow, base + COST[KEEP] + truncated, inserts + KEEP))
                elif initial == "s" and at == START:
                    out.append((state, SYSTEM, base + COST[KEEP] + truncated, inserts + KEEP))
            at, inserts = NEXT[at], inserts + INSERT
    return out


def _ends() -> list[tuple[int, int, int, str]]:
    out = []
    for state in range(4):
        at, inserts = state, ""
        for _ in range(3):
            if at in (START, ASSISTANT):
                out.append((state, at, COST[INSERT] * len(inserts), inserts))
            at, inserts = NEXT[at], inserts + INSERT
    return out


class Automaton:
    """The steps of the dynamic program: what one turn of a class does to (relative costs, order of the prefixes).

    Before a turn, each state holds its cheapest edits so far; ties go to the least string. All these strings end in the
    edit of the turn before, so none is a prefix of another and their order decides that of all their extensions: costs
    relative to the least and four ranks are the whole state. ``steps[i]`` is (next vector, cost added, per state the
    (state before, edits)). Costs differ by at most a few edits, so the automaton stays small.
    """

    FIRST = ((0, None, None, None), (0, 1, 2, 3))

    def __init__(self):
        self.steps, self.known, self.moves = [], {}, {}

    def step(self, vector, kind) -> int:
        number = self.known.get((vector, kind))
        if number is None:
            if kind not in self.moves:
                self.moves[kind] = _moves(*kind)
            costs, ranks = vector
            best = [None] * 4
            for before, after, cost, edits in self.moves[kind]:
                if costs[before] is not None:
                    offer = (costs[before] + cost, ranks[before], edits, before)
                    if best[after] is None or offer < best[after]:
                        best[after] = offer
            low = min(b[0] for b in best if b)
            order = sorted((s for s in range(4) if best[s]), key=lambda s: best[s][1:3])
            place = {s: i for i, s in enumerate(order)}
            vector_after = (tuple(None if b is None else b[0] - low for b in best), tuple(place.get(s, 9) for s in range(4)))
            number = self.known[vector, kind] = len(self.steps)
            self.steps.append((vector_after, low, tuple(None if b is None else (b[3], b[2]) for b in best)))
        return number

    @staticmethod
    def end(vector) -> tuple[int, int, str]:
        """(state, cost, edits) of the cheapest way to end."""
        costs, ranks = vector
        cost, _, edits, state = min((costs[s] + c, ranks[s], e, s) for s, _, c, e in _ends() if costs[s] is not None)
        return state, cost, edits

    def trace(self, numbers, state: int) -> tuple[list[str], int]:
        """The edits of a run of steps that ends in ``state`` (last first), and the state before the run."""
        out = []
        for number in reversed(numbers):
            state, edits = self.steps[number][2][state]
            out.append(edits)
        return out, state


# ------------------------------------------------------------------------------------------------ turns

def _turns(rows: DataFrame) -> DataFrame:
    """The rows that are streamed: key (the conversation as text), turn, role, text, and the order among equal turns."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    return rows.select(F.col("conv_id").cast("string").alias("key"), F.col("turn").cast("long").alias("turn"),
                       F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), text.alias("text"),
                       F.md5(F.encode(text, "UTF-8")).alias("digest"))


def _order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("digest").asc()]


def turn_faults(rows: DataFrame) -> DataFrame:
    """key, turn, role, digest, blank, truncated and ``again`` (role and text stand in an earlier turn) of every row.

    Rows that repeat a turn, role and text are told apart when they are streamed (they are neighbours there).
    """
    turns = cut(_turns(rows).select(
        "key", "turn", "role", "digest", (~F.col("text").rlike(WORD)).alias("blank"),
        (~F.right(F.rtrim(F.col("text"), F.lit(WHITE)), F.lit(1)).isin(".", "!", "?")).alias("truncated")), "turns")
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn"))
    first = (turns.groupBy("key", "role", "digest").agg(F.min(place).alias("first"), F.max(place).alias("last"))
             .where("first < last").select(F.col("key").alias("k"), F.col("role").alias("r"), F.col("digest").alias("d"), "first"))
    again = F.coalesce(F.col("first") < place, F.lit(False))
    return (turns.join(first, F.col("key").eqNullSafe(F.col("k")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d")), "left")
            .select("key", "turn", "role", "digest", "blank", "truncated", again.alias("again")))


_RUN = ("key string, chunk int, steps binary, state int, tail string, cost bigint, audit string, gaps bigint, blank bigint, "
        "duplicate bigint, truncated bigint, illegal bigint")


def _stream(chunk: int):
    def run(frames: Iterator[pd.DataFrame]):
        auto = Automaton()
        here = None                                  # the conversation at hand
        out = []

        def close():
            state, cost, tail = auto.end(here["vector"])
            row = {"key": here["key"], "cost": here["cost"] + cost, "blank": here["blank"], "duplicate": here["duplicate"],
                   "truncated": here["truncated"], "illegal": here["illegal"],
                   "gaps": here["high"] - here["low"] + 1 - here["distinct"] if here["distinct"] else 0}
            if here["chunk"] == 0:                   # short: traced at once
                edits, _ = auto.trace(here["steps"], state)
                row["audit"] = "".join(reversed(edits)) + tail
            else:
                if here["steps"]:
                    spill()
                row.update(state=state, tail=tail)
            out.append(row)

        def spill():
            # the automaton belongs to this task, so a chunk carries the backpointers themselves: its distinct steps
            distinct = sorted(set(here["steps"]))
            code = {n: i for i, n in enumerate(distinct)}
            table_ = "\n".join(";".join("-" if b is None else f"{b[0]}{b[1]}" for b in auto.steps[n][2]) for n in distinct)
            body = array("H", [code[n] for n in here["steps"]])
            head = table_.encode()
            out.append({"key": here["key"], "chunk": here["chunk"], "steps": len(head).to_bytes(4, "little") + head + body.tobytes()})
            here["chunk"] += 1
            here["steps"] = []

        for frame in frames:
            columns = (frame[c].tolist() for c in ("key", "known", "turn", "role", "digest", "blank", "truncated", "again"))
            for key, known, turn, role, digest, blank, truncated, again in zip(*columns):
                if here is None or key != here["key"]:
                    if here is not None:
                        close()
                    here = {"key": key, "vector": auto.FIRST, "cost": 0, "steps": [], "chunk": 0, "blank": 0, "duplicate": 0,
                            "truncated": 0, "illegal": 0, "distinct": 0, "low": 0, "high": 0, "last": None, "initial": None}
                if known and (not here["distinct"] or turn != here["high"]):
                    here["low"] = here["low"] if here["distinct"] else turn
                    here["distinct"], here["high"] = here["distinct"] + 1, turn
                initial, now = role[:1], (known, turn, role, digest)
                duplicate = not blank and (again or now == here["last"])
                fault = "blank" if blank else "duplicate" if duplicate else "truncated" if truncated else None
                if fault:
                    here[fault] += 1
                if here["last"] is not None and here["initial"] + initial not in LEGAL:
                    here["illegal"] += 1
                here["last"], here["initial"] = now, initial
                kind = (initial if initial in ("s", "u", "a") else "", fault in ("blank", "duplicate"), fault == "truncated")
                number = auto.step(here["vector"], kind)
                here["vector"], added, _ = auto.steps[number]
                here["cost"] += added
                here["steps"].append(number)
                if len(here["steps"]) == chunk:
                    here["chunk"] = max(1, here["chunk"])
                    spill()
                if len(out) >= 4096 or out and "steps" in out[-1]:
                    yield _frame(out)
                    out = []
        if here is not None:
            close()
        if out:
            yield _frame(out)
    return run


_FIELDS = [f.split() for f in _RUN.split(", ")]


def _frame(rows: list[dict]) -> pd.DataFrame:
    kinds = {"bigint": "Int64", "int": "Int32", "string": object, "binary": object}
    return pd.DataFrame({name: pd.array([r.get(name) for r in rows], kinds[kind]) for name, kind in _FIELDS})


def _trace_back(frames: Iterator[pd.DataFrame]):
    """Chunks of giant conversations, each conversation's summary first, then its chunks from the last to the first."""
    key, state = None, None
    for frame in frames:
        out = []
        for k, chunk, steps, end, tail in zip(*(frame[c].tolist() for c in ("key", "chunk", "steps", "state", "tail"))):
            if steps is None:
                key, state = k, int(end)
                out.append((k, 1 << 30, tail))
                continue
            size = int.from_bytes(steps[:4], "little")
            back = [[None if b == "-" else (int(b[0]), b[1:]) for b in line.split(";")]
                    for line in steps[4:4 + size].decode().split("\n")]
            numbers, edits = array("H", steps[4 + size:]), []
            for n in reversed(numbers):
                state, edit = back[n][state]
                edits.append(edit)
            out.append((k, int(chunk), "".join(reversed(edits))))
        yield pd.DataFrame(out, columns=["key", "chunk", "piece"])


def repair_plan(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Per conversation of ``rows`` (conv_id, turn, role, text): faults and the cheapest edits that mend it.

    Columns: conv_id, gaps (missing turn numbers), blank, duplicate, truncated (each row's first fault), illegal
    (neighbours whose role initials are not su, ua or au), cost and audit. ``audit`` holds one letter per edit in order:
    K keeps a row (cost 0), R gives it the role user or assistant that is due (2), D deletes it (3; needed for blank and
    duplicate rows), I inserts an empty turn of the role that is due (2); a truncated row that stays adds 1. The result's
    role initials are ``(s?(ua)+)?``; of the cheapest edits the ASCII-least are taken.

    Rows are ordered by turn (nulls first), then role, then the MD5 of the text. A null role or text counts as one space.
    Rows with a null conv_id are one conversation. A role of another initial can't be kept. Equal rows are duplicates of
    the first. An empty table gives no rows; other columns are ignored. Texts are not held: memory per conversation is
    ``chunk`` steps, whatever its length; its audit is one value.
    """
    prepare(rows.sparkSession)
    kind = rows.schema["conv_id"].dataType
    faults = turn_faults(rows)
    streamed = (faults.repartition("key").sortWithinPartitions("key", *_order())
                .select("key", F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0)).alias("turn"), "role",
                        "digest", "blank", "truncated", "again"))
    runs = cut(streamed.mapInPandas(_stream(chunk), _RUN), "runs")
    short = runs.where("audit is not null")
    giant = runs.where("audit is null")
    last_first = giant.repartition("key").sortWithinPartitions("key", F.col("chunk").desc_nulls_first())
    pieces = last_first.select("key", "chunk", "steps", "state", "tail").mapInPandas(_trace_back, "key string, chunk int, piece string")
    audits = pieces.groupBy("key").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("chunk", "piece"))), lambda x: x["piece"]), "").alias("whole"))
    heads = giant.where("chunk is null").withColumnRenamed("key", "k").drop("audit")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    long = heads.join(audits, F.col("k").eqNullSafe(F.col("key"))).select("key", *numbers, F.col("whole").alias("audit"))
    return (short.select("key", *numbers, "audit").union(long)
            .select(F.col("key").cast(kind).alias("conv_id"), *numbers, "audit"))


# ------------------------------------------------------------------------------------------------ repaired turns

def _apply(frames: Iterator[pd.DataFrame]):
    """The repaired turns of sorted rows; each conversation begins with the row that holds its audit."""
    here = None

    def said(out, role, text, source):
        line = f"{role}:{text}"
        here["sha"].update((line if here["n"] == 0 else "\n" + line).encode("utf-8", "surrogatepass"))
        out.append((here["key"], here["n"], role, text, source, None))
        here["n"] += 1

    def inserts(out):
        while here["audit"][here["at"]:here["at"] + 1] == INSERT:
            here["state"] = NEXT[here["state"]]
            said(out, ROLE[here["state"]], "", None)
            here["at"] += 1

    def close(out):
        inserts(out)
        out.append((here["key"], None, None, None, None, here["sha"].hexdigest()))

    names = ["key", "pos", "role", "text", "turn", "sha256"]

    def frame_of(out):
        done = pd.DataFrame(out, columns=names)
        return done.astype({"pos": "Int64", "turn": "Int64"})

    for frame in frames:
        out = []
        for key, audit, known, turn, role, text in zip(*(frame[c].tolist() for c in ("key", "audit", "known", "turn", "role", "text"))):
            if audit is not None:
                if here is not None:
                    close(out)
                here = {"key": key, "audit": audit, "at": 0, "n": 0, "state": START, "sha": hashlib.sha256()}
                continue
            inserts(out)
            edit = here["audit"][here["at"]]
            here["at"] += 1
            if edit == DELETE:
                continue
            kept_system = edit == KEEP and here["state"] == START and role[:1] == "s"
            here["state"] = SYSTEM if kept_system else NEXT[here["state"]]
            said(out, role if edit == KEEP else ROLE[here["state"]], text, turn if known else None)
        if out:
            yield frame_of(out)
    if here is not None:
        out = []
        close(out)
        yield frame_of(out)


def repaired_turns(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """The turns of ``rows`` after the edits of ``plan`` (from `repair_plan` over the same rows).

    conv_id, pos (0, 1, ...), role, text and turn (null for an inserted turn), and one closing row per conversation
    with null pos and ``sha256``: lowercase hex digest of all its ``role:text``, joined by newlines. Conversations without
    turns left have the closing row alone.
    """
    kind = rows.schema["conv_id"].dataType
    turns = _turns(rows).select("key", F.lit(None).cast("string").alias("audit"), "turn", "role", "text", "digest")
    edits = plan.select(F.col("conv_id").cast("string").alias("key"), "audit", F.lit(None).cast("long").alias("turn"),
                        F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"),
                        F.lit(None).cast("string").alias("digest"))
    streamed = (turns.unionByName(edits).repartition("key")
                .sortWithinPartitions("key", F.col("audit").isNull(), *_order())
                .select("key", "audit", F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0)).alias("turn"),
                        "role", "text"))
    out = streamed.mapInPandas(_apply, "key string, pos bigint, role string, text string, turn bigint, sha256 string")
    return out.select(F.col("key").cast(kind).alias("conv_id"), "pos", "role", "text", "turn", "sha256")


# ------------------------------------------------------------------------------------------------ query

def damage(rows: DataFrame) -> DataFrame:
    """The damaged conversations that the query mends; null parts are one space, but conv_id and turn stay null."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))  # noqa: E731
    code = F.crc32(F.encode(F.concat(part("conv_id"), F.lit(":"), part("turn")), "UTF-8")) % 20
    text = F.when(code == 1, "").when(code == 2, F.regexp_replace(part("text"), "[.!?]", "")).otherwise(part("text"))
    return (rows.where(code != 0)
            .select("conv_id", "turn", F.when(code == 4, "user").otherwise(part("role")).alias("role"), text.alias("text"),
                    F.explode(F.when(code == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
            .drop("copy"))


def query(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    hurt = damage(rows)
    plan = cut(repair_plan(hurt), "plan")
    digests = (repaired_turns(hurt, plan).where("pos is null")
               .select(F.col("conv_id").alias("_c"), F.col("sha256").alias("repaired_sha256")))
    done = plan.join(digests, F.col("conv_id").eqNullSafe(F.col("_c"))).drop("_c").withColumnRenamed("conv_id", "_c")
    every = rows.select("conv_id").distinct().join(done, F.col("conv_id").eqNullSafe(F.col("_c")), "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


#: CRC-32 of the UTF-8 bytes of an SQL string expression, for engines without the function.
CRC_TABLE = ("(SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)), lambda c, i: "
             "CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS crc)")


def sql_crc32(text: str, crc: str = "crc") -> str:
    digits = f"hex({text})"
    data = f"list_transform(range(0, length({digits}) // 2), lambda i: ('0x' || substr({digits}, 2 * i + 1, 2))::BIGINT)"
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, {data}), lambda c, b: "
            f"xor(c // 256, {crc}[xor(c % 256, b) + 1])), 4294967295::BIGINT)")


SQL = rf"""
WITH RECURSIVE t AS MATERIALIZED {CRC_TABLE},
codes AS MATERIALIZED (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {sql_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS code
    FROM conversations, t),
hurt AS (SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
    CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN code = 3 THEN [0, 1] ELSE [0] END) AS copy FROM codes WHERE code <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i FROM hurt),
seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth, substr(role, 1, 1) AS initial,
    lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
    NOT regexp_matches(text, '[^ 	-]') AS empty,
    NOT regexp_matches(text, '[.!?][ 	-]*$') AS cutoff FROM placed),
r AS MATERIALIZED (SELECT *, empty OR nth > 1 AS gone, (NOT empty AND nth = 1 AND cutoff)::INT AS late FROM seen),
faults AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (WHERE empty) AS blank, count(*) FILTER (WHERE NOT empty AND nth > 1) AS duplicate,
    sum(late) AS truncated, count(*) FILTER (WHERE i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
    FROM r GROUP BY conv_id),
ins(state, k, here, follow, added) AS (VALUES (0, 0, 0, 2, ''), (0, 1, 2, 3, chr(10) || 'user:'),
    (0, 2, 3, 2, chr(10) || 'user:' || chr(10) || 'assistant:'), (1, 0, 1, 2, ''), (1, 1, 2, 3, chr(10) || 'user:'),
    (1, 2, 3, 2, chr(10) || 'user:' || chr(10) || 'assistant:'), (2, 0, 2, 3, ''), (2, 1, 3, 2, chr(10) || 'assistant:'),
    (2, 2, 2, 3, chr(10) || 'assistant:' || chr(10) || 'user:'), (3, 0, 3, 2, ''), (3, 1, 2, 3, chr(10) || 'user:'),
    (3, 2, 3, 2, chr(10) || 'user:' || chr(10) || 'assistant:')),
edits(e, price) AS (VALUES ('D', 3), ('K', 0), ('R', 2)),
dp AS (
    SELECT conv_id, 0::BIGINT AS i, 0 AS state, struct_pack(c := 0, a := '', t := '') AS best FROM faults
    UNION ALL
    SELECT conv_id, i, state, min(best) FROM (
        SELECT dp.conv_id, r.i,
            CASE WHEN e = 'D' THEN here WHEN e = 'K' AND initial = 's' THEN 1 ELSE follow END AS state,
            struct_pack(c := dp.best.c + 2 * k + price + CASE WHEN e = 'D' THEN 0 ELSE late END,
                a := dp.best.a || repeat('I', k) || e,
                t := dp.best.t || added || CASE e WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || role || ':' || text
                     ELSE chr(10) || CASE follow WHEN 2 THEN 'user:' ELSE 'assistant:' END || text END) AS best
        FROM dp JOIN r ON r.conv_id IS NOT DISTINCT FROM dp.conv_id AND r.i = dp.i + 1 JOIN ins ON ins.state = dp.state
        JOIN edits ON e = 'D' OR NOT gone AND (e = 'R' OR initial = 's' AND here = 0 OR initial = 'u' AND follow = 2
                                               OR initial = 'a' AND follow = 3)) x
    GROUP BY conv_id, i, state),
best AS (SELECT dp.conv_id, min(struct_pack(c := dp.best.c + 2 * k, a := dp.best.a || repeat('I', k), t := dp.best.t || added)) AS b
    FROM dp JOIN faults f ON f.conv_id IS NOT DISTINCT FROM dp.conv_id AND f.n = dp.i
    JOIN ins ON ins.state = dp.state AND here IN (0, 3) GROUP BY dp.conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
    coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
    coalesce(illegal, 0)::BIGINT AS illegal, coalesce(b.c, 0)::BIGINT AS cost, coalesce(b.a, '') AS audit,
    sha256(substr(coalesce(b.t, ''), 2)) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM c.conv_id
"""
