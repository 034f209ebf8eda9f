"""Near-duplicate embeddings by a subspace pigeonhole join (operator 9).

Vectors are scaled to length one and rotated by random signs and a Hadamard transform, then split into blocks of a few
coordinates. Two vectors with cosine t lie at squared distance 2 - 2t, so in at least one block their squared distance is
at most that block's proportional share. Each block is a range join: vectors go to the slab of the block's first
coordinate they lie in, and visit the next slab if within range of it. Inside a slab numpy compares block coordinates;
what is within the share is verified exactly on the whole vectors. A pair counts only in the first block that finds it,
so the union needs no second shuffle: a vector meets every partner in its own slab, and its links are summed, not listed.

Equal vectors of a label are one class before anything is compared. Slabs with many vectors are cut into tiles, and each
pair of tiles is a task of its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, cut, prepare, table

COSINE, BLOCKS, TILE, SEED = 0.98, 8, 3000, 11
_OUT = "node long, links long, root long"


def rotate(unit: np.ndarray, seed: int = SEED) -> np.ndarray:
    """Random signs, then an orthonormal Hadamard transform (zero-padded to a power of two). Additions are per row and
    in one order, so a vector's coordinates are the same in every task."""
    n, d = unit.shape
    size = 1 << max(0, d - 1).bit_length()
    x = np.zeros((n, size))
    x[:, :d] = unit * np.random.default_rng(seed).choice([-1.0, 1.0], d)
    step = 1
    while step < size:
        pair = x.reshape(n, -1, 2, step)
        x = np.stack([pair[:, :, 0] + pair[:, :, 1], pair[:, :, 0] - pair[:, :, 1]], 2).reshape(n, size)
        step *= 2
    return x / np.sqrt(size)


def _unit(raw: list[bytes], kind: str) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _shares(size: int, cosine: float, blocks: int) -> tuple[int, float, float]:
    """(number of blocks, a block's share of the squared distance with room for rounding, its range)."""
    m = min(blocks, size)
    share = max(0.0, 2 - 2 * cosine) / m * (1 + 1e-9) + 1e-12
    return m, share, float(np.sqrt(share)) * (1 + 1e-9)


def _place(batches, cosine: float, blocks: int, kind: str):
    """Rows of every (block, slab) a vector lies in or visits."""
    for batch in batches:
        if not batch.num_rows:
            continue
        raw, sizes = batch.column("raw").to_pylist(), np.array([len(r.as_py()) for r in batch.column("raw")])
        for length in np.unique(sizes):
            mine = np.flatnonzero(sizes == length)
            x = rotate(_unit([raw[i] for i in mine], kind))
            m, _, reach = _shares(x.shape[1], cosine, blocks)
            width = 2 * reach
            first = x.reshape(len(x), m, -1)[:, :, 0]
            home = np.floor(first / width).astype(np.int64)
            rows, block = np.meshgrid(np.arange(len(x)), np.arange(m), indexing="ij")
            at, blk, slab, own = [], [], [], []
            for step, visits in ((0, np.ones_like(home, bool)), (-1, first - home * width <= reach * (1 + 1e-9)),
                                 (1, (home + 1) * width - first <= reach * (1 + 1e-9))):
                at.append(rows[visits]), blk.append(block[visits])
                slab.append((home + step)[visits]), own.append(np.full(int(visits.sum()), step == 0))
            at = mine[np.concatenate(at)]
            take = pa.array(at)
            piece = batch.take(take)
            yield pa.RecordBatch.from_arrays(
                [piece.column("label"), pa.array(np.full(len(at), length, np.int32)),
                 pa.array(np.concatenate(blk).astype(np.int32)), pa.array(np.concatenate(slab)),
                 pa.array(np.concatenate(own)), piece.column("node"), piece.column("n"), piece.column("raw")],
                ["label", "size", "block", "slab", "home", "node", "n", "raw"])


def _tile_links(block: int, t: pa.Table, a: int, b: int, cosine: float, blocks: int, kind: str) -> pa.Table:
    """Links of the residents of tile ``a`` with the members of tile ``b``: a row per vector that has any."""
    node, n = t["node"].to_numpy(), t["n"].to_numpy()
    tile = t["tile"].to_numpy()
    unit = _unit(t["raw"].to_pylist(), kind)
    x = rotate(unit)
    m, share, _ = _shares(x.shape[1], cosine, blocks)
    cells = x.reshape(len(x), m, -1)
    here = cells[:, block]
    length = (here * here).sum(1)
    residents = np.flatnonzero(t["home"].to_numpy(zero_copy_only=False) & (tile == a))
    members = np.flatnonzero(tile == b)
    links, root = np.zeros(len(node), np.int64), np.arange(len(node))
    touched = np.zeros(len(node), bool)
    for at in range(0, len(residents), 256):
        rows = residents[at:at + 256]
        gap = length[rows][:, None] + length[members] - 2 * (here[rows] @ here[members].T)
        i, j = np.nonzero(gap <= share + 1e-9)
        i, j = rows[i], members[j]
        i, j = i[node[i] != node[j]], j[node[i] != node[j]]
        for k in range(0, len(i), 20_000):
            p, q = i[k:k + 20_000], j[k:k + 20_000]
            near = ((cells[p, :block + 1] - cells[q, :block + 1]) ** 2).sum(2) <= share
            first = near[:, block] & ~near[:, :block].any(1)
            p, q = p[first], q[first]
            good = (unit[p] * unit[q]).sum(1) >= cosine
            p, q = p[good], q[good]
            np.add.at(links, p, n[q])
            touched[p] = touched[q] = True
            while len(p):                                            # union by the smallest place
                rp, rq = root[p], root[q]
                open_ = rp != rq
                p, q, rp, rq = p[open_], q[open_], rp[open_], rq[open_]
                np.minimum.at(root, np.maximum(rp, rq), np.minimum(rp, rq))
                while (root[root] != root).any():
                    root = root[root]
    out = np.flatnonzero(touched)
    return pa.table({"node": node[out], "links": links[out], "root": node[root[out]]})


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, blocks: int = BLOCKS, tile: int = TILE) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of ``vectors`` (vec_id, embedding, label).

    Rows link if their labels are equal and not null, their embeddings are of one length and the cosine in double
    precision is at least ``cosine`` (above 0). n_links counts the other rows linked directly, equal ones included;
    component_id is the smallest vec_id that links reach, kept says that it is the row's own. Rows with a null vec_id, and
    embeddings that are null, empty, zero or hold null or non-finite components, link with nothing and are kept; their
    component is their id. Repeated rows are vectors of their own. Other columns are ignored; an empty table gives no rows.
    """
    prepare(vectors.sparkSession)
    e = F.col("embedding").cast("array<double>")
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    sound = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.forall(e, finite)
                       & F.exists(e, lambda v: v != 0), F.lit(False))
    rows = cut(vectors.select("vec_id", "label", F.when(sound, e).alias("e"))
               .select("vec_id", "label", "e", F.xxhash64("e").alias("h1"), F.xxhash64(F.lit("e"), "e").alias("h2")), "vectors")
    sound_rows = rows.where(F.col("e").isNotNull())
    classes = cut(sound_rows.groupBy("label", "h1", "h2").agg(F.min("vec_id").cast("long").alias("node"),
                                                              F.count(F.lit(1)).alias("n"), F.first("e").alias("e")), "classes")

    # components travel as they are stored: four bytes each if that is what the column holds
    kind = "<f4" if vectors.schema["embedding"].dataType.elementType.simpleString() == "float" else "<f8"

    def pack(batches):
        for batch in batches:
            raw = [np.array(v, kind).tobytes() for v in batch.column("e").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("node"), batch.column("n"),
                                              pa.array(raw, pa.binary())], ["label", "node", "n", "raw"])

    def place(batches):
        return _place(pack(batches), cosine, blocks, kind)

    label = classes.schema["label"].dataType.simpleString()
    placed = classes.select("label", "node", "n", "e").mapInArrow(
        place, f"label {label}, size int, block int, slab long, home boolean, node long, n long, raw binary")
    spot = ["label", "size", "block", "slab"]
    placed = cut(placed, "placed")
    tiles = cut(placed.groupBy(*spot).agg(F.count(F.lit(1)).alias("held"), F.count(F.when(F.col("home"), 1)).alias("residents"))
                .where("residents > 0 AND held > 1").select(*spot, F.ceil(F.col("held") / tile).cast("int").alias("tiles")), "tiles")
    t = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")
    every = F.sequence(F.lit(0), F.col("tiles") - 1)
    tasks = F.array_union(F.transform(every, lambda k: F.struct(F.col("tile").alias("a"), k.alias("b"))),
                          F.transform(every, lambda k: F.struct(k.alias("a"), F.col("tile").alias("b"))))
    work = (placed.join(tiles, spot).withColumn("tile", t)
            .select(*spot, "home", "node", "n", "raw", "tile", F.explode(tasks).alias("task"))
            .select(*spot, "task.a", "task.b", "home", "node", "n", "raw", "tile"))

    def compare(key, group):
        return _tile_links(key[2].as_py(), group, key[4].as_py(), key[5].as_py(), cosine, blocks, kind)

    found = cut(work.groupBy(*spot, "a", "b").applyInArrow(compare, _OUT), "found")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    groups = components(found.select("node", "root"), "node", "root").withColumnRenamed("node", "_node")
    named = (classes.select("label", "h1", "h2", "node", "n").join(counts, "node", "left")
             .join(groups, F.col("node") == F.col("_node"), "left")
             .select("label", "h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"),
                     F.coalesce("component", "node").alias("component")))
    named = cut(named, "named")
    linked = sound_rows.select("vec_id", "label", "h1", "h2").join(named, ["label", "h1", "h2"]).select("vec_id", "links", "component")
    alone = rows.where(F.col("e").isNull()).select("vec_id", F.lit(0).cast("long").alias("links"), F.col("vec_id").cast("long").alias("component"))
    return (linked.union(alone).select("vec_id", F.col("links").alias("n_links"), F.col("component").alias("component_id"),
                                       F.col("vec_id").eqNullSafe(F.col("component")).alias("kept")))


def query(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "embeddings"))


SQL = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding::DOUBLE[] IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding::DOUBLE[] IF x <> 0]) > 0),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
r AS (SELECT vec_id AS x, vec_id AS y FROM v UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
c AS (SELECT x, min(y) AS component_id FROM r GROUP BY x),
n AS (SELECT x, count(*) AS n_links FROM l GROUP BY x)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, coalesce(component_id, vec_id) AS component_id,
       coalesce(component_id, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN n ON n.x = vec_id LEFT JOIN c ON c.x = vec_id
"""
