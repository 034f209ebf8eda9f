"""DuckDB SQL that grows whole trees level by level: the oracle of fits deeper than a stump.

Rows carry the number of their node (root 1, children 2k and 2k + 1). Per level, one chain of CTEs sums fixed-point gradients
by (node, feature, bin), lists every candidate split (numeric: after each bin; few categories: one against the rest; many:
prefixes of the categories ordered by G / (H + lambda)) with missing values on either side, and keeps the best of each node.
"""

from __future__ import annotations

S = "1048576.0"
ORDERS = {"reg:absoluteerror": "0.5"}      # objectives whose leaves are quantiles of the residuals

GRADIENTS = {
    "reg:squarederror": ("$m - y", "1.0"),
    "binary:logistic": ("p - y", "greatest(p * (1.0 - p), 1e-16)"),
    "count:poisson": ("exp($m) - y", "exp($m) * exp(0.7)"),
    "reg:absoluteerror": ("CAST(sign($m - y) AS DOUBLE)", "1.0"),
}


def gradient(objective: str, m: str) -> tuple[str, str]:
    if objective.startswith("reg:quantileerror:"):
        alpha = objective.rsplit(":", 1)[1]
        return f"CASE WHEN {m} >= y THEN 1.0 - {alpha} ELSE -{alpha} END", "1.0"
    if objective.startswith("class:"):                   # the first softmax round of one of k classes, from zero margins
        _, label, k = objective.split(":")
        return f"1.0 / {k}.0 - CASE WHEN y = '{label}' THEN 1.0 ELSE 0.0 END", f"2.0 * (1.0 / {k}.0) * (1.0 - 1.0 / {k}.0)"
    g, h = GRADIENTS[objective.removeprefix("margin:")]
    return g.replace("$m", m), h.replace("$m", m)


def base_sql(objective: str, train: str) -> str:
    """The starting margin; of rows that carry one already (`margin`), that."""
    if objective.startswith("margin:"):
        return "base AS (SELECT 0.0 AS b)"
    mean = f"(CAST(sum(floor(y * {S} + 0.5)) AS DOUBLE) / {S}) / count(*)"
    if objective.startswith("class:"):
        mean = "0.0 * count(*)"
    elif objective in ORDERS or objective.startswith("reg:quantileerror:"):
        mean = f"quantile_cont(y, {ORDERS.get(objective) or objective.rsplit(':', 1)[1]})"
    elif objective == "binary:logistic":
        mean = "ln((sum(y) / count(*)) / (1.0 - sum(y) / count(*)))"
    elif objective == "count:poisson":
        mean = f"ln({mean})"
    return f"base AS (SELECT {mean} AS b FROM binned WHERE {train})"


def tree_ctes(src: str, categorical: list[bool], objective: str, rounds: int = 1, depth: int = 3, lam: float = 1.0,
              eta: float = 0.3, mcw: float = 1.0, signs: list[int] | None = None, groups: list[list[int]] | None = None,
              onehot: int = 4, most: int = 64, train: str = "TRUE", g_scale: str = S, h_scale: str = S, bins: str | None = None) -> str:
    """CTEs ``src0, dv{f}, nbs, binned, base, st{r}, split{r}_{level}, leaf{r}``. ``src`` gives x0.., y (and more)."""
    nf = len(categorical)
    ctes = [f"src0 AS ({src})"]
    for f in range(nf):
        ctes.append(f"dv{f} AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS bin "
                    f"FROM (SELECT DISTINCT x{f} AS v FROM src0 WHERE x{f} IS NOT NULL))")
    ctes.append("nbs AS MATERIALIZED (" + " UNION ALL ".join(
        f"SELECT {f} AS fidx, CAST((SELECT count(*) FROM dv{f}) AS INTEGER) AS nb, {str(categorical[f]).upper()} AS cat"
        for f in range(nf)) + ")")
    joins = " ".join(f"LEFT JOIN dv{f} d{f} ON s.x{f} = d{f}.v" for f in range(nf))
    codes = ", ".join(f"COALESCE(d{f}.bin, (SELECT nb FROM nbs WHERE fidx = {f})) AS b{f}" for f in range(nf))
    ctes.append(f"binned AS MATERIALIZED (SELECT s.*, {codes} FROM src0 s {joins})")
    ctes.append(base_sql(objective, train))
    ctes.append("st0 AS MATERIALIZED (SELECT binned.*, " + ("margin" if objective.startswith("margin:") else "base.b") + " AS m0 FROM binned, base)")
    logistic = objective.endswith("binary:logistic")
    quantile = ORDERS.get(objective) or (objective.rsplit(":", 1)[1] if objective.startswith("reg:quantileerror:") else None)

    def weight(g: str, h: str) -> str:
        plain = f"-({g} / ({h} + {lam}))"
        return plain if signs is None else f"least(greatest({plain}, lo), hi)"

    def score(g: str, h: str) -> str:
        if signs is None:
            return f"({g} * {g} / ({h} + {lam}))"
        return f"(-(2.0 * {g} * {weight(g, h)} + ({h} + {lam}) * {weight(g, h)} * {weight(g, h)}))"

    for r in range(rounds):
        g, h = gradient(objective, f"m{r}")
        source = f"(SELECT *, 1.0 / (1.0 + exp(-m{r})) AS p FROM st{r})" if logistic else f"st{r}"
        ctes.append(f"n{r}_0 AS MATERIALIZED (SELECT *, floor(({g}) * {g_scale} + 0.5) AS gf, floor(({h}) * {h_scale} + 0.5) AS hf, "
                    f"1::BIGINT AS node FROM {source})")
        ctes.append(f"b{r}_0 AS (SELECT 1::BIGINT AS node, '-Infinity'::DOUBLE AS lo, 'Infinity'::DOUBLE AS hi, []::INTEGER[] AS path)")
        for lv in range(depth):
            t = f"{r}_{lv}"
            long = " UNION ALL ".join(f"SELECT node, {f} AS fidx, b{f} AS bin, gf, hf FROM n{t} WHERE node >= {1 << lv} AND ({train})"
                                      for f in range(nf))
            ctes.append(f"h{t} AS MATERIALIZED (SELECT node, fidx, bin, sum(gf) / {g_scale} AS G, sum(hf) / {h_scale} AS H, "
                        f"count(*) AS N FROM ({long}) GROUP BY ALL)")
            ctes.append(f"t{t} AS MATERIALIZED (SELECT node, sum(G) AS Gt, sum(H) AS Ht, sum(N) AS Nt FROM h{t} WHERE fidx = 0 GROUP BY node)")
            ctes.append(f"m{t} AS (SELECT h.node, h.fidx, sum(h.G) FILTER (WHERE bin = nb) AS Gm, sum(h.H) FILTER (WHERE bin = nb) AS Hm, "
                        f"sum(h.N) FILTER (WHERE bin = nb) AS Nm FROM h{t} h JOIN nbs USING (fidx) GROUP BY ALL)")
            # numeric: every bin but the last; categories: one each, or prefixes in the order of their ratio
            ctes.append(f"""c{t} AS (
                SELECT d.node, d.fidx, d.bin AS spot, NULL::INTEGER[] AS cats, coalesce(sum(h.G) OVER w, 0) AS cG,
                       coalesce(sum(h.H) OVER w, 0) AS cH, coalesce(sum(h.N) OVER w, 0) AS cN
                FROM (SELECT t.node, n.fidx, unnest(range(n.nb - 1)) AS bin FROM t{t} t, nbs n WHERE NOT n.cat AND n.nb > 1) d
                LEFT JOIN h{t} h ON h.node = d.node AND h.fidx = d.fidx AND h.bin = d.bin
                WINDOW w AS (PARTITION BY d.node, d.fidx ORDER BY d.bin ROWS UNBOUNDED PRECEDING)
                UNION ALL
                SELECT node, fidx, bin, [bin], G, H, N FROM h{t} JOIN nbs USING (fidx) WHERE cat AND nb < {onehot} AND bin < nb
                UNION ALL
                SELECT node, fidx, place - 1, CASE WHEN place <= {most} THEN list_slice(every, 1, place) ELSE list_slice(every, place + 1, all_) END,
                       CASE WHEN place <= {most} THEN cG ELSE tG - cG END, CASE WHEN place <= {most} THEN cH ELSE tH - cH END,
                       CASE WHEN place <= {most} THEN cN ELSE tN - cN END FROM (
                    SELECT node, fidx, row_number() OVER o AS place, count(*) OVER k AS all_, sum(G) OVER k AS tG, sum(H) OVER k AS tH,
                           sum(N) OVER k AS tN, sum(G) OVER o AS cG, sum(H) OVER o AS cH, sum(N) OVER o AS cN
                    FROM h{t} JOIN nbs USING (fidx) WHERE cat AND nb >= {onehot} AND bin < nb
                    WINDOW o AS (PARTITION BY node, fidx ORDER BY G / (H + {lam}), bin ROWS UNBOUNDED PRECEDING), k AS (PARTITION BY node, fidx))
                JOIN (SELECT node, fidx, list(bin ORDER BY G / (H + {lam}), bin) AS every FROM h{t} JOIN nbs USING (fidx)
                      WHERE cat AND nb >= {onehot} AND bin < nb GROUP BY node, fidx) USING (node, fidx)
                WHERE place < all_ AND (place <= {most} OR all_ - place <= {most}))""")
            allowed = ""
            if groups is not None:
                sets = " OR ".join(f"list_has_all([{', '.join(map(str, x))}], path) AND c.fidx IN ({', '.join(map(str, x))})" for x in groups)
                allowed = f" WHERE len(path) = 0 OR list_contains(path, c.fidx) OR {sets}"
            ctes.append(f"""e{t} AS (SELECT c.*, s.dir, t.Gt, t.Ht, t.Nt, b.lo, b.hi, b.path,
                c.cG + CASE WHEN dir = 0 THEN coalesce(Gm, 0) ELSE 0 END AS GL, c.cH + CASE WHEN dir = 0 THEN coalesce(Hm, 0) ELSE 0 END AS HL,
                c.cN + CASE WHEN dir = 0 THEN coalesce(Nm, 0) ELSE 0 END AS NL
                FROM c{t} c JOIN t{t} t ON c.node = t.node JOIN b{t} b ON b.node = c.node
                LEFT JOIN m{t} m ON m.node = c.node AND m.fidx = c.fidx, (VALUES (0), (1)) s(dir){allowed})""")
            rising = ""
            if signs is not None:
                sign = "CASE fidx " + " ".join(f"WHEN {f} THEN {x}" for f, x in enumerate(signs)) + " END"
                rising = f" AND ({sign} = 0 OR {sign} * (wr - wl) >= 0)"
            ctes.append(f"""split{t} AS MATERIALIZED (SELECT * FROM (
                SELECT *, ({score('GL', 'HL')} + {score('GR', 'HR')}) - {score('Gt', 'Ht')} AS gain, {weight('GL', 'HL')} AS wl,
                       {weight('GR', 'HR')} AS wr FROM (SELECT *, Gt - GL AS GR, Ht - HL AS HR, Nt - NL AS NR FROM e{t}))
                WHERE HL >= {mcw} AND HR >= {mcw} AND NL > 0 AND NR > 0 AND gain > 1e-6{rising}
                QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, fidx, spot, dir) = 1)""")
            code = "CASE s.fidx " + " ".join(f"WHEN {f} THEN n.b{f}" for f in range(nf)) + " END"
            left = (f"CASE WHEN {code} = (SELECT nb FROM nbs WHERE nbs.fidx = s.fidx) THEN s.dir = 0 "
                    f"WHEN s.cats IS NOT NULL THEN list_contains(s.cats, {code}) ELSE {code} <= s.spot END")
            ctes.append(f"n{r}_{lv + 1} AS MATERIALIZED (SELECT n.* REPLACE (CASE WHEN s.node IS NULL THEN n.node WHEN {left} "
                        f"THEN 2 * n.node ELSE 2 * n.node + 1 END AS node) FROM n{t} n LEFT JOIN split{t} s ON s.node = n.node)")
            mid, sign = "(wl + wr) / 2", "0" if signs is None else \
                "CASE fidx " + " ".join(f"WHEN {f} THEN {x}" for f, x in enumerate(signs)) + " END"
            path = "CASE WHEN list_contains(path, fidx) THEN path ELSE list_append(path, fidx) END"
            ctes.append(f"""b{r}_{lv + 1} AS (
                SELECT 2 * node AS node, CASE WHEN {sign} = -1 THEN {mid} ELSE lo END AS lo, CASE WHEN {sign} = 1 THEN {mid} ELSE hi END AS hi, {path} AS path FROM split{t}
                UNION ALL
                SELECT 2 * node + 1, CASE WHEN {sign} = 1 THEN {mid} ELSE lo END, CASE WHEN {sign} = -1 THEN {mid} ELSE hi END, {path} FROM split{t})""")
        last = f"n{r}_{depth}"
        bounds = " UNION ALL ".join(f"SELECT node, lo, hi FROM b{r}_{lv}" for lv in range(depth + 1))
        value = (f"(quantile_cont(y - m{r}, {quantile}))" if quantile else weight("G", "H")) + f" * {eta}"
        extra = f", quantile_cont(y - m{r}, {quantile}) AS q" if quantile else ""
        value = f"q * {eta}" if quantile else f"({weight('G', 'H')}) * {eta}"
        ctes.append(f"leaf{r} AS MATERIALIZED (SELECT a.node, H, {value} AS value FROM (SELECT node, sum(gf) / {g_scale} AS G, sum(hf) / {h_scale} AS H{extra} "
                    f"FROM {last} WHERE {train} GROUP BY node) a JOIN ({bounds}) b ON a.node = b.node)")
        ctes.append(f"st{r + 1} AS MATERIALIZED (SELECT n.* EXCLUDE (gf, hf, node), n.m{r} + l.value AS m{r + 1} FROM {last} n JOIN leaf{r} l ON l.node = n.node)"
                    if not logistic else
                    f"st{r + 1} AS MATERIALIZED (SELECT n.* EXCLUDE (gf, hf, node, p), n.m{r} + l.value AS m{r + 1} FROM {last} n JOIN leaf{r} l ON l.node = n.node)")
    return "WITH " + ",\n".join(ctes)


def nodes_sql(names: list[str], categorical: list[bool], rounds: int, depth: int, tree: str = "") -> str:
    """The node table of the trees that `tree_ctes` grew: nodes numbered by level, from left to right."""
    parts = []
    name = "CASE s.fidx " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(names)) + " END"
    cut = "CASE s.fidx " + " ".join(f"WHEN {f} THEN " + ("NULL" if c else f"(SELECT v FROM dv{f} WHERE bin = s.spot + 1)")
                                    for f, c in enumerate(categorical)) + " END"
    cats = "CASE s.fidx " + " ".join(
        f"WHEN {f} THEN (SELECT string_agg(v, ',' ORDER BY v) FROM dv{f} WHERE list_contains(s.cats, bin))" for f, c in enumerate(categorical) if c) + " END" \
        if any(categorical) else "CAST(NULL AS VARCHAR)"
    for r in range(rounds):
        splits = " UNION ALL ".join(f"SELECT {lv} AS lv, node, fidx, spot, cats, dir, gain, Ht FROM split{r}_{lv}" for lv in range(depth))
        parts.append(f"""SELECT {tree or f'CAST({r} AS INTEGER)'} AS tree_id, CAST(id AS INTEGER) AS node_id, feature, round(threshold, 6) AS threshold, left_cats, default_left,
            CAST(max(CASE WHEN leftmost THEN id END) OVER (PARTITION BY family) AS INTEGER) AS x_left, node, round(gain, 6) AS gain, round(cover, 6) AS cover, round(leaf_value, 6) AS leaf_value
            FROM (SELECT *, row_number() OVER (ORDER BY node) - 1 AS id, node // 2 AS family, node % 2 = 0 AS leftmost FROM (
                SELECT s.node, {name} AS feature, {cut} AS threshold, {cats} AS left_cats, s.dir = 0 AS default_left, s.gain, s.Ht AS cover, CAST(NULL AS DOUBLE) AS leaf_value FROM ({splits}) s
                UNION ALL SELECT node, NULL, NULL, NULL, NULL, NULL, H, value FROM leaf{r}))""")
    table = " UNION ALL ".join(parts)
    return f"""SELECT t.tree_id, t.node_id, t.feature, t.threshold, t.left_cats, t.default_left, c.node_id AS left_id, c.node_id + 1 AS right_id, t.gain, t.cover, t.leaf_value
        FROM ({table}) t LEFT JOIN ({table}) c ON c.tree_id = t.tree_id AND c.node = 2 * t.node"""
