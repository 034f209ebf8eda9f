"""SimHash near-duplicates by tiled exact comparison (operator 7).

Fingerprints are made once per document inside Arrow batches (XXH64 of every shingle, bit counts in numpy) and
reduced to distinct values, so copies cost nothing further. Two fingerprints within the radius agree on at least one of
``radius + 1`` bit blocks, so distinct fingerprints are brought together by (block, value). Within such a group numpy
compares tile against tile, exclusive-or and bit counts, and skips tile pairs whose population counts are further apart
than the radius. A group larger than a tile is cut into tiles by population count and a hash; each pair of tiles that
may hold a link is then a unit of work of its own, so no task ever holds a whole group. A unit returns a spanning forest
of its links (at most one row per fingerprint), never all pairs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, cut, prepare, releasing, table

SHINGLE, RADIUS, SEED, TILE = 4, 4, 42, 2048


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """SimHash of the word shingles of ``text``; 0 without words, the whole sequence with fewer than ``shingle``."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()   # bytes: ASCII rules on both calls
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    stops = ends[len(words) - n:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts, stops)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 8192):
        part = hashes[at:at + 8192].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """doc_id and ``fp`` (the 64 bits as a signed long) of every row of ``docs`` (doc_id, text)."""
    def run(batches):
        for batch in batches:
            values = np.fromiter((fingerprint(t.as_py(), shingle, seed) for t in batch.column("text")), np.uint64,
                                 batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values.view(np.int64))], ["doc_id", "fp"])

    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(releasing(run), f"doc_id {kind}, fp long")


def _ones(words: np.ndarray) -> np.ndarray:
    return np.bitwise_count(words)


def _tile_links(a: np.ndarray, b: np.ndarray, radius: int):
    """Indices (i, j) with a[i], b[j] within the radius, a block of rows at a time; both sorted by bit count."""
    ca, cb = _ones(a).astype(np.int16), _ones(b).astype(np.int16)
    step = 256
    for i in range(0, len(a), step):
        rows = a[i:i + step]
        lo = np.searchsorted(cb, ca[i] - radius, "left")
        hi = np.searchsorted(cb, ca[min(i + step, len(a)) - 1] + radius, "right")
        if lo < hi:                                           # else the whole tile pair is too far apart
            x, y = np.nonzero(np.bitwise_count(rows[:, None] ^ b[None, lo:hi]) <= radius)
            yield x + i, y + lo


def _forest(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect just what the links between ``a`` and ``b`` connect: at most one for each fingerprint."""
    a = a[np.argsort(_ones(a), kind="stable")]
    b = b[np.argsort(_ones(b), kind="stable")]
    nodes = np.unique(np.concatenate([a, b]))
    root = np.arange(len(nodes))
    at_a, at_b = np.searchsorted(nodes, a), np.searchsorted(nodes, b)
    for x, y in _tile_links(a, b, radius):
        u, v = at_a[x], at_b[y]
        while True:
            ru, rv = root[u], root[v]
            open_ = ru != rv
            if not open_.any():
                break
            u, v, ru, rv = u[open_], v[open_], ru[open_], rv[open_]
            np.minimum.at(root, np.maximum(ru, rv), np.minimum(ru, rv))
            while (root[root] != root).any():
                root = root[root]
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[moved], nodes[root[moved]]


def _group_links(frames, radius: int):
    """Links within runs of equal (block, value); rows arrive sorted, a run may span batches."""
    def links(fp):
        words = fp.to_numpy(np.int64).view(np.uint64)
        return _forest(words, words, radius)

    rest = None
    out_u, out_v = [], []

    def out():
        u, v = (np.concatenate(x) if x else np.empty(0, np.uint64) for x in (out_u, out_v))
        out_u.clear(), out_v.clear()
        return pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})

    for frame in frames:
        frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
        key = frame["block"].to_numpy(np.int64) * (1 << 40) + frame["value"].to_numpy(np.int64)
        ends = np.flatnonzero(key[1:] != key[:-1]) + 1
        last = int(ends[-1]) if len(ends) else 0
        for s, e in zip(np.concatenate(([0], ends[:-1])) if len(ends) else [], ends):
            if e - s > 1:
                u, v = links(frame["fp"].iloc[s:e])
                out_u.append(u), out_v.append(v)
        rest = frame.iloc[last:]
        yield out()
    if rest is not None and len(rest) > 1:
        u, v = links(rest["fp"])
        out_u.append(u), out_v.append(v)
    yield out()


def _tile_pair(frame: pd.DataFrame, radius: int) -> pd.DataFrame:
    words = frame["fp"].to_numpy(np.int64).view(np.uint64)
    first = frame["side"].to_numpy() == 0
    same = bool((frame["t1"] == frame["t2"]).iloc[0])
    u, v = _forest(words[first], words if same else words[~first], radius)
    return pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})


def _block_value(block: int, blocks: int) -> Column:
    lo, hi = 64 * block // blocks, 64 * (block + 1) // blocks
    return F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1))


def fingerprint_links(distinct: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Links (u, v) that join the same distinct fingerprints ``fp`` as all pairs within ``radius`` bits would."""
    blocks = radius + 1
    keys = distinct.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("block"), _block_value(i, blocks).alias("value")) for i in range(blocks)])).alias("k"))
    keys = keys.select("k.block", "k.value", "fp", F.bit_count("fp").alias("ones"))
    per_count = keys.groupBy("block", "value", "ones").agg(F.count(F.lit(1)).alias("n"))
    large = per_count.groupBy("block", "value").agg(F.sum("n").alias("total")).where(F.col("total") > tile)
    large = cut(large.select("block", "value"), "large")
    small = (keys.join(large, ["block", "value"], "left_anti").select("block", "value", "fp")
             .repartition("block", "value").sortWithinPartitions("block", "value"))
    links = small.mapInPandas(lambda frames: _group_links(frames, radius), "u long, v long")
    # tiles of large groups: by bit count, each count cut by a hash into parts of about a tile
    parts = (per_count.join(large, ["block", "value"])
             .select("block", "value", "ones", F.ceil(F.col("n") / tile).cast("int").alias("parts")))
    parts = cut(parts, "parts")
    tiles = parts.select("block", "value", "ones", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    name = F.struct("ones", "part")
    left = tiles.select("block", "value", name.alias("t1"))
    right = tiles.select("block", "value", name.alias("t2"))
    pairs = (left.join(right, ["block", "value"])
             .where((F.col("t1") <= F.col("t2")) & (F.col("t2.ones") - F.col("t1.ones") <= radius)))
    member = (pairs.select("*", F.explode(F.when(F.col("t1") == F.col("t2"), F.array(F.lit(0)))
                                          .otherwise(F.array(F.lit(0), F.lit(1)))).alias("side"))
              .withColumn("t", F.when(F.col("side") == 0, F.col("t1")).otherwise(F.col("t2")))
              .select("block", "value", "t1", "t2", "side", "t.ones", "t.part"))
    big = (keys.join(parts, ["block", "value", "ones"])
           .withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
           .join(member, ["block", "value", "ones", "part"]).select("block", "value", "t1", "t2", "side", "fp"))
    heavy = (big.groupBy("block", "value", "t1", "t2")
             .applyInPandas(lambda f: _tile_pair(f, radius), "u long, v long"))
    return links.union(heavy)


def simhash_groups(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, seed: int = SEED,
                   tile: int = TILE) -> DataFrame:
    """doc_id, fingerprint (16 lower-case hex digits) and component_id of every row of ``docs`` (doc_id, text).

    A-Z are lower-cased, words are runs of non-white characters (ASCII white space), shingles are ``shingle`` words with
    repeats; a bit is 1 if set in over half of the hashes. component_id is the smallest doc_id that links of at most
    ``radius`` bits reach. Null and empty texts have fingerprint 0 and link like any other. Null doc_ids count in their
    group but are its id only if all are null. Repeated rows stay. Other columns are ignored; an empty table gives none.
    """
    prepare(docs.sparkSession)
    prints = cut(fingerprints(docs, shingle, seed), "prints")
    distinct = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    groups = components(fingerprint_links(distinct.select("fp"), radius, tile), "u", "v")
    named = (distinct.join(groups, F.col("fp") == F.col("node"), "left")
             .select("fp", "least", F.coalesce("component", "fp").alias("component")))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    ids = cut(named.join(least, "component").select("fp", "component_id"), "ids")
    return (prints.join(ids, "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """One row of every SimHash group of ``docs``, all columns: that with the smallest doc_id (null after all others), then
    the smallest 64-bit hash of its text.

    Rows with one doc_id and different texts are different documents and belong to the groups of their texts; rows that
    repeat doc_id and text are one document, of which one stays (other columns may differ: any of them). A group without
    any doc_id keeps one row. Columns of any name are allowed beside doc_id and text. ``options`` go to `simhash_groups`.
    """
    key = F.struct(F.col("doc_id").isNull().alias("nameless"), F.col("doc_id"), F.xxhash64("text").alias("print"))
    groups = simhash_groups(docs.select(key.alias("doc_id"), "text"), **options)
    kept = cut(groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id.*").distinct(), "kept")
    kept = kept.select(F.struct(F.coalesce("nameless", F.lit(False)).alias("nameless"), F.col("doc_id"),
                                F.coalesce("print", F.lit(0).cast("long")).alias("print")).alias("kept"))
    rows = docs.select(F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]).alias("row"), key.alias("key"))
    # both sides have one type (a key's flag and hash are never null), so one shuffle by key serves the join and what follows
    return rows.join(kept, F.col("key") == F.col("kept"), "left_semi").dropDuplicates(["key"]).select("row.*")


def query(spark, sf_dir):
    return simhash_groups(table(spark, sf_dir, "documents"))
