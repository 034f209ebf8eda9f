"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The boosted-stump oracles rebuild the whole fit in SQL: exact bins from distinct values, fixed-point
(2^20) gradient sums, the split gain ``GL²/(HL+λ) + GR²/(HR+λ) − G²/(H+λ)`` with ties broken by
(feature, bin, missing-left first), leaf values ``−G/(H+λ)·η`` and the margin update round by round.
"""

from __future__ import annotations

from tree_oracles import nodes_sql, tree_ctes

S = "1048576.0"
LI_ALL = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, "
          "l_returnflag, l_linestatus, l_shipdate")

LI_X = """CAST(l_quantity AS DOUBLE) AS x0, CAST(l_discount AS DOUBLE) AS x1, CAST(l_tax AS DOUBLE) AS x2,
       CAST(l_linenumber AS DOUBLE) AS x3"""
LI_Y = "CAST(l_quantity * (1 - l_discount) AS DOUBLE)"
LI_ROWS = f"(SELECT *, CAST(row_number() OVER (ORDER BY {LI_ALL}) - 1 AS BIGINT) AS id FROM lineitem)"
LI_REG_ID = f"SELECT id, {LI_X}, {LI_Y} AS y FROM {LI_ROWS}"
LI_REG_FOLDS = f"""SELECT id, {LI_X}, {LI_Y} AS y, CAST(CASE WHEN id < (n // 3) + CASE WHEN n % 3 > 0 THEN 1 ELSE 0 END THEN 0
       WHEN id < 2 * (n // 3) + CASE WHEN n % 3 > 0 THEN 1 ELSE 0 END + CASE WHEN n % 3 > 1 THEN 1 ELSE 0 END THEN 1 ELSE 2 END AS INTEGER) AS fold
       FROM {LI_ROWS}, (SELECT count(*) AS n FROM lineitem)"""
LI_REG = """SELECT CAST(l_quantity AS DOUBLE) AS x0, CAST(l_discount AS DOUBLE) AS x1, CAST(l_tax AS DOUBLE) AS x2,
       CAST(l_linenumber AS DOUBLE) AS x3, CAST(l_quantity * (1 - l_discount) AS DOUBLE) AS y FROM lineitem"""
LI_REG_NAMES = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]

LI_CAT = """SELECT l_returnflag AS x0, l_linestatus AS x1, NULLIF(l_tax, 0.0) AS x2, CAST(l_quantity AS DOUBLE) AS x3,
       CAST(CAST((l_returnflag = 'R') <> (l_quantity > 25) AS INTEGER) AS DOUBLE) AS y FROM lineitem"""
LI_CAT_NAMES = ["l_returnflag", "l_linestatus", "tax", "l_quantity"]


def _r(expr: str, alias: str) -> str:
    return f"round({expr}, 6) AS {alias}"


LOG_LINK = ("count:poisson", "reg:gamma", "reg:tweedie")
#: First and second derivatives of the losses at margin $m, Poisson's with the default step limit 0.7.
GRADIENTS = {
    "reg:squarederror": ("$m - y", "1.0"),
    "binary:logistic": ("p - y", "greatest(p * (1.0 - p), 1e-16)"),
    "count:poisson": ("exp($m) - y", "exp($m) * exp(0.7)"),
    "reg:gamma": ("1.0 - y * exp(-$m)", "y * exp(-$m)"),
    "reg:tweedie": ("exp(0.5 * $m) - y * exp(-0.5 * $m)", "0.5 * exp(0.5 * $m) + 0.5 * (y * exp(-0.5 * $m))"),
    "reg:pseudohubererror": ("($m - y) / sqrt(1.0 + ($m - y) * ($m - y))",
                             "1.0 / pow(sqrt(1.0 + ($m - y) * ($m - y)), 3)"),
    "reg:squaredlogerror": ("(ln($m + 1.0) - ln(y + 1.0)) / ($m + 1.0)",
                            "greatest((1.0 - (ln($m + 1.0) - ln(y + 1.0))) / (($m + 1.0) * ($m + 1.0)), 1e-6)"),
}


def stump_ctes(src: str, names: list[str], categorical: list[bool], objective: str, rounds: int,
               lam: float = 1.0, eta: float = 0.3, mcw: float = 1.0, train: str = "TRUE", g_scale: str = S) -> str:
    """CTEs ``src0, dv{f}, nbs, st0..st{rounds}, split{r}, base`` for boosted depth-1 trees on the rows of ``train``."""
    SG = g_scale
    nf = len(names)
    ctes = [f"src0 AS ({src})"]
    for f in range(nf):
        ctes.append(f"dv{f} AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS bin "
                    f"FROM (SELECT DISTINCT x{f} AS v FROM src0 WHERE x{f} IS NOT NULL))")
    ctes.append("nbs AS (" + " UNION ALL ".join(
        f"SELECT {f} AS fidx, CAST((SELECT count(*) FROM dv{f}) AS INTEGER) AS nb, {str(categorical[f]).upper()} AS cat"
        for f in range(nf)) + ")")
    joins = " ".join(f"LEFT JOIN dv{f} d{f} ON s.x{f} = d{f}.v" for f in range(nf))
    bins = ", ".join(f"COALESCE(d{f}.bin, (SELECT nb FROM nbs WHERE fidx = {f})) AS b{f}" for f in range(nf))
    ctes.append(f"binned AS (SELECT s.*, {bins} FROM src0 s {joins})")
    mean = f"(CAST(sum(floor(y * {S} + 0.5)) AS DOUBLE) / {S}) / count(*)"
    if objective.startswith("softmax:"):
        mean = "0.0 * count(*)"
    start = {"binary:logistic": "ln(p / (1.0 - p))"} | {o: "ln(p)" for o in LOG_LINK}
    mean = "sum(y) / count(*)" if objective == "binary:logistic" else mean
    ctes.append(f"base AS (SELECT {start.get(objective, 'p')} AS b FROM (SELECT {mean} AS p FROM binned WHERE {train}))")
    ctes.append("st0 AS (SELECT binned.*, base.b AS m0 FROM binned, base)")
    for r in range(rounds):
        m = f"m{r}"
        g, h = GRADIENTS[objective]
        grad = f"floor(({g}) * {SG} + 0.5) AS gf, floor(({h}) * {S} + 0.5) AS hf".replace("$m", m)
        src_g = f"(SELECT *, 1.0 / (1.0 + exp(-{m})) AS p FROM st{r})" if objective == "binary:logistic" else f"st{r}"
        ctes.append(f"g{r} AS (SELECT *, {grad} FROM {src_g})")
        long = " UNION ALL ".join(f"SELECT {f} AS fidx, b{f} AS bin, gf, hf FROM g{r} WHERE {train}" for f in range(nf))
        ctes.append(f"hist{r} AS (SELECT fidx, bin, sum(gf) AS G, sum(hf) AS H, count(*) AS N FROM ({long}) "
                    f"GROUP BY fidx, bin)")
        ctes.append(f"tot{r} AS (SELECT sum(G) / {SG} AS Gt, sum(H) / {S} AS Ht, sum(N) AS Nt FROM hist{r} WHERE fidx = 0)")
        ctes.append(
            f"miss{r} AS (SELECT n.fidx, COALESCE(sum(h.G) FILTER (WHERE h.bin = n.nb), 0) / {SG} AS Gm, "
            f"COALESCE(sum(h.H) FILTER (WHERE h.bin = n.nb), 0) / {S} AS Hm, "
            f"COALESCE(sum(h.N) FILTER (WHERE h.bin = n.nb), 0) AS Nm FROM nbs n LEFT JOIN hist{r} h ON h.fidx = n.fidx "
            f"GROUP BY n.fidx)")
        ctes.append(
            f"cum{r} AS (SELECT h.fidx, h.bin, n.cat, n.nb, "
            f"CASE WHEN n.cat THEN h.G ELSE sum(h.G) OVER w END / {SG} AS cG, "
            f"CASE WHEN n.cat THEN h.H ELSE sum(h.H) OVER w END / {S} AS cH, "
            f"CASE WHEN n.cat THEN h.N ELSE sum(h.N) OVER w END AS cN "
            f"FROM hist{r} h JOIN nbs n ON h.fidx = n.fidx WHERE h.bin < n.nb "
            f"WINDOW w AS (PARTITION BY h.fidx ORDER BY h.bin ROWS UNBOUNDED PRECEDING))")
        ctes.append(
            f"cand{r} AS (SELECT c.fidx, c.bin, d.dir, "
            f"CASE WHEN d.dir = 0 THEN c.cG + m.Gm ELSE c.cG END AS GL, "
            f"CASE WHEN d.dir = 0 THEN c.cH + m.Hm ELSE c.cH END AS HL, "
            f"CASE WHEN d.dir = 0 THEN c.cN + m.Nm ELSE c.cN END AS NL "
            f"FROM cum{r} c JOIN miss{r} m ON c.fidx = m.fidx, (SELECT 0 AS dir UNION ALL SELECT 1) d "
            f"WHERE (c.cat AND c.cN > 0) OR (NOT c.cat AND c.bin <= c.nb - 2))")
        ctes.append(
            f"gain{r} AS (SELECT c.*, t.Gt - c.GL AS GR, t.Ht - c.HL AS HR, t.Nt - c.NL AS NR, t.Gt, t.Ht, "
            f"(c.GL * c.GL / (c.HL + {lam}) + (t.Gt - c.GL) * (t.Gt - c.GL) / ((t.Ht - c.HL) + {lam})) "
            f"- t.Gt * t.Gt / (t.Ht + {lam}) AS gain FROM cand{r} c, tot{r} t)")
        ctes.append(
            f"split{r} AS (SELECT *, (-(GL / (HL + {lam}))) * {eta} AS vL, (-(GR / (HR + {lam}))) * {eta} AS vR "
            f"FROM gain{r} WHERE HL >= {mcw} AND HR >= {mcw} AND NL > 0 AND NR > 0 AND gain > 1e-6 "
            f"ORDER BY gain DESC, fidx, bin, dir LIMIT 1)")
        bsel = "CASE s.fidx " + " ".join(f"WHEN {f} THEN t.b{f}" for f in range(nf)) + " END"
        left = (f"CASE WHEN {bsel} = n.nb THEN s.dir = 0 WHEN n.cat THEN {bsel} = s.bin ELSE {bsel} <= s.bin END")
        ctes.append(
            f"st{r + 1} AS (SELECT t.*, t.m{r} + CASE WHEN {left} THEN s.vL ELSE s.vR END AS m{r + 1} "
            f"FROM st{r} t, split{r} s JOIN nbs n ON n.fidx = s.fidx)")
    return "WITH " + ",\n".join(ctes)


def _fname(names: list[str], alias: str = "s.fidx") -> str:
    return "CASE " + alias + " " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(names)) + " END"


def _threshold(nf: int, categorical: list[bool]) -> str:
    parts = []
    for f in range(nf):
        if categorical[f]:
            parts.append(f"WHEN {f} THEN NULL")
        else:
            parts.append(f"WHEN {f} THEN (SELECT v FROM dv{f} WHERE bin = s.bin + 1)")
    return "CASE s.fidx " + " ".join(parts) + " END"


def _feature_label(names: list[str], categorical: list[bool]) -> str:
    """Spark side: concat_ws(':', feature, array_join(left_cats, ','))."""
    parts = []
    for f, n in enumerate(names):
        if categorical[f]:
            parts.append(f"WHEN {f} THEN '{n}:' || (SELECT v FROM dv{f} WHERE bin = s.bin)")
        else:
            parts.append(f"WHEN {f} THEN '{n}'")
    return "CASE s.fidx " + " ".join(parts) + " END"


def stump_nodes_sql(src, names, categorical, objective, rounds, label_cats=False) -> str:
    head = stump_ctes(src, names, categorical, objective, rounds)
    fl = _feature_label(names, categorical) if label_cats else _fname(names)
    sel = []
    for r in range(rounds):
        sel.append(
            f"SELECT CAST({r} AS INTEGER) AS tree_id, CAST(0 AS INTEGER) AS node_id, {fl} AS feature, "
            f"{_r(_threshold(len(names), categorical), 'threshold')}, s.dir = 0 AS default_left, "
            f"CAST(1 AS INTEGER) AS left_id, CAST(2 AS INTEGER) AS right_id, {_r('s.gain', 'gain')}, "
            f"{_r('s.Ht', 'cover')}, CAST(NULL AS DOUBLE) AS leaf_value FROM split{r} s")
        for node, (h, v) in enumerate([("HL", "vL"), ("HR", "vR")], start=1):
            sel.append(
                f"SELECT CAST({r} AS INTEGER), CAST({node} AS INTEGER), CAST(NULL AS VARCHAR), CAST(NULL AS DOUBLE), "
                f"CAST(NULL AS BOOLEAN), CAST(NULL AS INTEGER), CAST(NULL AS INTEGER), CAST(NULL AS DOUBLE), "
                f"round(s.{h}, 6), round(s.{v}, 6) FROM split{r} s")
    return head + "\n" + "\nUNION ALL\n".join(sel)


def deep_tree_sql() -> dict[str, str]:
    """Node tables of trees of depth 2 and 3."""
    def table(src, names, categorical, objective, rounds=2, depth=3, **options):
        return tree_ctes(src, categorical, objective, rounds, depth, **options) + nodes_sql(names, categorical, rounds, depth)

    out = {"fit_depth3_nodes": table(LI_REG, LI_REG_NAMES, [False] * 4, "reg:squarederror")}
    out["fit_missing_nodes"] = table("""SELECT CAST(NULLIF(l_tax, 0.03) AS DOUBLE) AS x0, CAST(CASE WHEN l_linenumber = 4 THEN NULL ELSE l_quantity END AS DOUBLE) AS x1,
        CAST(l_discount AS DOUBLE) AS x2, CAST(CAST((l_quantity > 30 AND l_discount < 0.05) OR l_tax = 0.03 AS INTEGER) AS DOUBLE) AS y FROM lineitem""",
                                     ["tax", "quantity", "discount"], [False] * 3, "binary:logistic")
    out["fit_category_nodes"] = table("""SELECT p_brand AS x0, p_type AS x1, CAST(p_size AS DOUBLE) AS x2,
        CAST(p_size + 3 * length(p_type) + 10 * CAST(substr(p_brand, -1) AS INTEGER) AS DOUBLE) AS y FROM part""",
                                      ["p_brand", "p_type", "p_size"], [True, True, False], "reg:squarederror")
    multi = f"SELECT {LI_X}, CASE WHEN l_quantity <= 15 THEN 'low' WHEN l_quantity <= 35 THEN 'mid' ELSE 'high' END AS y FROM lineitem"
    out["fit_softmax_nodes"] = " UNION ALL ".join(
        f"SELECT * FROM ({tree_ctes(multi, [False] * 4, f'class:{label}:3', 1, 3)} {nodes_sql(LI_REG_NAMES, [False] * 4, 1, 3, f'CAST({k} AS INTEGER)')})"
        for k, label in enumerate(["high", "low", "mid"]))
    out["fit_poisson_price"] = table("SELECT CAST(l_quantity AS DOUBLE) AS x0, CAST(l_tax AS DOUBLE) AS x1, CAST(l_extendedprice AS DOUBLE) AS y FROM lineitem",
                                     ["l_quantity", "l_tax"], [False] * 2, "count:poisson", depth=2, g_scale="32768.0", h_scale="16384.0")
    bumpy = f"SELECT {LI_X}, CAST(l_quantity * (1 - l_discount) - CASE WHEN l_quantity > 30 THEN 25 ELSE 0 END + l_tax * l_linenumber AS DOUBLE) AS y FROM lineitem"
    out["fit_monotone_nodes"] = table(bumpy, LI_REG_NAMES, [False] * 4, "reg:squarederror", signs=[1, -1, 0, 1])
    out["fit_interaction_nodes"] = table(bumpy, LI_REG_NAMES, [False] * 4, "reg:squarederror", groups=[[0, 2], [1, 3]])
    out["fit_absolute_nodes"] = table(bumpy, LI_REG_NAMES, [False] * 4, "reg:absoluteerror", depth=2)
    out["fit_quantile_nodes"] = table(bumpy, LI_REG_NAMES, [False] * 4, "reg:quantileerror:0.9", depth=2)
    out["fit_wide_nodes"] = table("""SELECT 'k' || (l_orderkey % 5000)::VARCHAR AS x0, CAST(l_quantity AS DOUBLE) AS x1,
        CAST(l_quantity + 40 * ((l_orderkey % 5000) % 7) AS DOUBLE) AS y FROM lineitem""", ["key.of order", "__t"], [True, False], "reg:squarederror")
    out["fit_exact_nodes"] = table(f"SELECT CAST(l_extendedprice AS DOUBLE) AS x0, CAST(l_discount AS DOUBLE) AS x1, {LI_Y} AS y FROM lineitem",
                                   ["l_extendedprice", "l_discount"], [False] * 2, "reg:squarederror")
    folds = LI_REG_FOLDS.replace(LI_X, "CAST(l_extendedprice AS DOUBLE) AS x, CAST(l_discount AS DOUBLE) AS x1")
    out["cross_val_wide"] = " UNION ALL ".join(
        f"""SELECT CAST({k} AS BIGINT) AS fold, (WITH rows_ AS MATERIALIZED ({folds}),
            ranked AS (SELECT x, row_number() OVER (ORDER BY x) - 1 AS place, count(*) OVER () AS n FROM rows_ WHERE fold <> {k}),
            cuts AS MATERIALIZED (SELECT DISTINCT x AS cut FROM ranked, range(1, 16) t(i) WHERE place = i * n // 16)
            SELECT round(1.0 - sse / sst, 6) FROM ({tree_ctes("SELECT r.*, (SELECT count(*) FROM cuts WHERE cut <= r.x)::DOUBLE AS x0 FROM rows_ r", [False] * 2,
                                                              "reg:squarederror", 2, 2, train=f"fold <> {k}")}
            SELECT sum((y - m2) * (y - m2)) AS sse, var_pop(y) * count(*) AS sst FROM st2 WHERE fold = {k})) AS score""" for k in range(3))
    out["median_error"] = """SELECT l_linestatus, round(-median(abs(CAST(l_extendedprice AS DOUBLE) - CAST(l_quantity * 1500 AS DOUBLE))), 6) AS score
        FROM lineitem GROUP BY l_linestatus"""
    return out


def _expected(r: int) -> str:
    return f"(s{r}.HL / s{r}.Ht * s{r}.vL + s{r}.HR / s{r}.Ht * s{r}.vR)"


def sql_for() -> dict[str, str]:
    reg_cat = [False] * 4
    cat_cat = [True, True, False, False]
    R = 2
    reg_head = stump_ctes(LI_REG, LI_REG_NAMES, reg_cat, "reg:squarederror", R)
    id_head = stump_ctes(LI_REG_ID, LI_REG_NAMES, reg_cat, "reg:squarederror", R)
    cat_head = stump_ctes(LI_CAT, LI_CAT_NAMES, cat_cat, "binary:logistic", 1)
    out: dict[str, str] = deep_tree_sql()

    out["labelled_table"] = f"""
SELECT CAST(row_number() OVER (ORDER BY {LI_ALL}) - 1 AS BIGINT) AS sample_id,
       CAST(l_quantity AS DOUBLE) AS l_quantity, CAST(l_discount AS DOUBLE) AS l_discount,
       CAST(l_tax AS DOUBLE) AS l_tax, CAST(l_linenumber AS DOUBLE) AS l_linenumber,
       CAST(dense_rank() OVER (ORDER BY l_returnflag) - 1 AS INTEGER) AS target,
       CAST(l_returnflag AS VARCHAR) AS target_name
FROM lineitem"""

    out["labelled_regression"] = f"""
SELECT CAST(row_number() OVER (ORDER BY {LI_ALL}) - 1 AS BIGINT) AS sample_id,
       CAST(l_quantity AS DOUBLE) AS l_quantity, CAST(l_discount AS DOUBLE) AS l_discount,
       round(CAST(l_extendedprice AS DOUBLE), 6) AS target
FROM lineitem"""

    out["category_dictionary"] = """
SELECT feature, CAST(row_number() OVER (PARTITION BY feature ORDER BY category) - 1 AS INTEGER) AS code, category
FROM (SELECT DISTINCT 'l_returnflag' AS feature, l_returnflag AS category FROM lineitem WHERE l_returnflag IS NOT NULL
      UNION SELECT DISTINCT 'l_linestatus', l_linestatus FROM lineitem WHERE l_linestatus IS NOT NULL)"""

    out["bin_cuts"] = " UNION ALL ".join(
        f"SELECT '{n}' AS feature, CAST(row_number() OVER (ORDER BY v) - 2 AS INTEGER) AS bin, round(v, 6) AS threshold "
        f"FROM (SELECT DISTINCT CAST({n} AS DOUBLE) AS v FROM lineitem) QUALIFY row_number() OVER (ORDER BY v) > 1"
        for n in LI_REG_NAMES)

    out["class_codes"] = """
SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS code, n FROM (
  SELECT CASE WHEN l_quantity <= 15 THEN 'low' WHEN l_quantity <= 35 THEN 'mid' ELSE 'high' END AS label,
         count(*) AS n FROM lineitem GROUP BY 1)"""

    out["root_histogram"] = reg_head + f"""
SELECT {_fname(LI_REG_NAMES, 'h.fidx')} AS feature, CAST(h.bin AS INTEGER) AS bin, CAST(h.G AS BIGINT) AS sum_g,
       CAST(h.H AS BIGINT) AS sum_h, CAST(h.N AS BIGINT) AS n FROM hist0 h"""

    out["fit_stumps_nodes"] = stump_nodes_sql(LI_REG, LI_REG_NAMES, reg_cat, "reg:squarederror", R)

    out["predict_stumps"] = id_head + f"\nSELECT id, round(m{R}, 6) AS prediction FROM st{R}"
    # dart without dropped trees is plain boosting; a forest of equal stumps is one stump at full step
    out["predict_dart_rate0"] = out["predict_stumps"]
    out["predict_rf_stumps"] = (stump_ctes(LI_REG_ID, LI_REG_NAMES, reg_cat, "reg:squarederror", 1, lam=1e-5, eta=1.0)
                                + "\nSELECT id, round(m1, 6) AS prediction FROM st1")
    out["objective_stumps"] = "\nUNION ALL\n".join(
        f"SELECT '{o}' AS objective, * FROM ({stump_nodes_sql(LI_REG, LI_REG_NAMES, reg_cat, o, 1)})"
        for o in GRADIENTS if o.startswith(("count", "reg")))
    out["fit_large_target"] = (stump_ctes(LI_REG_ID.replace(LI_Y, LI_Y + " * 1e9"), LI_REG_NAMES, reg_cat, "reg:squarederror", R,
                                          g_scale="0.0625") + f"\nSELECT id, round(m{R} / 1e9, 6) AS prediction FROM st{R}")

    def cv_scores(eta: float, rounds: int) -> str:
        return " UNION ALL ".join(
            f"SELECT CAST({k} AS BIGINT) AS fold, (SELECT 1.0 - sse / sst FROM ("
            + stump_ctes(LI_REG_FOLDS, LI_REG_NAMES, reg_cat, "reg:squarederror", rounds, eta=eta, train=f"fold <> {k}")
            + f" SELECT sum((y - m{rounds}) * (y - m{rounds})) AS sse, var_pop(y) * count(*) AS sst FROM st{rounds} WHERE fold = {k})) AS score"
            for k in range(3))

    out["cross_val_score"] = f"SELECT fold, round(score, 6) AS score FROM ({cv_scores(0.3, 2)})"
    boards = {"grid_search": [(e, n) for e in (0.1, 0.3) for n in (1, 2)], "randomized_search": [(0.3, 2), (0.3, 1), (0.1, 1)]}   # fixed values: the picks of seed 1
    for name, combos in boards.items():
        rows = " UNION ALL ".join(
            f"""SELECT '{{"learning_rate": {e}, "max_depth": 1, "n_estimators": {n}}}' AS params, avg(score) AS m, stddev_pop(score) AS s
                FROM ({cv_scores(e, n)})""" for e, n in combos)
        out[name] = f"""SELECT 'xgb_regressor' AS estimator, params, round(m, 6) AS mean_test_score, round(s, 6) AS std_test_score,
            rank() OVER (ORDER BY m DESC) AS rank FROM ({rows})"""
    folds = f"""WITH d AS (SELECT id, {LI_X}, CASE WHEN l_quantity > 25 AND l_discount >= 0.05 THEN 1.0 ELSE 0.0 END AS y FROM {LI_ROWS}),
        c AS (SELECT y, count(*) AS cnt, min(id) AS first FROM d GROUP BY y),
        o AS (SELECT y, cnt, sum(cnt) OVER (ORDER BY first ROWS UNBOUNDED PRECEDING) - cnt AS s FROM c),
        a AS (SELECT o.y, f, (CASE WHEN o.s + o.cnt <= f THEN 0 ELSE (o.s + o.cnt - f - 1) // 3 + 1 END)
                     - (CASE WHEN o.s <= f THEN 0 ELSE (o.s - f - 1) // 3 + 1 END) AS k FROM o, range(3) t(f)),
        b AS (SELECT y, f, sum(k) OVER (PARTITION BY y ORDER BY f ROWS UNBOUNDED PRECEDING) AS hi FROM a),
        r AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY id) - 1 AS rk FROM d)
        SELECT r.id, r.x0, r.x1, r.x2, r.x3, r.y, (SELECT min(f) FROM b WHERE b.y = r.y AND r.rk < b.hi) AS fold FROM r"""
    out["cross_val_predict"] = " UNION ALL ".join(
        "SELECT id, CAST(CASE WHEN m2 > 0 THEN 1 ELSE 0 END AS BIGINT) AS prediction FROM ("
        + stump_ctes(folds, LI_REG_NAMES, reg_cat, "binary:logistic", 2, train=f"fold <> {k}")
        + f" SELECT id, m2 FROM st2 WHERE fold = {k})" for k in range(3))
    # permutation importance: in repeat k the donor of row r is the row d with (d * a + b) mod n = r
    moves = [(371249, 435829), (183497, 963395)]      # fixed values: drawn with seed 0
    terms = " + ".join(
        f"(SELECT CASE WHEN (CASE s.fidx WHEN 0 THEN CASE WHEN f.j = 0 THEN d.b0 ELSE t.b0 END WHEN 1 THEN CASE WHEN f.j = 1 THEN d.b1 ELSE t.b1 END "
        f"WHEN 2 THEN CASE WHEN f.j = 2 THEN d.b2 ELSE t.b2 END ELSE CASE WHEN f.j = 3 THEN d.b3 ELSE t.b3 END END) <= s.bin "
        f"THEN s.vL ELSE s.vR END FROM split{r} s)" for r in range(R))
    per = " UNION ALL ".join(
        f"SELECT f.j, {k} AS k, 1.0 - sum((t.y - ((SELECT b FROM base) + {terms})) ** 2) / (var_pop(t.y) * count(*)) AS score "
        f"FROM binned t JOIN (SELECT b0, b1, b2, b3, (id * {a} + {b}) % n AS dst FROM binned, (SELECT count(*) AS n FROM binned)) d "
        f"ON t.id = d.dst, range(4) f(j) GROUP BY f.j"
        for k, (a, b) in enumerate(moves))
    out["permutation_importance"] = id_head + f"""
, whole AS (SELECT 1.0 - sum((y - m{R}) ** 2) / (var_pop(y) * count(*)) AS score FROM st{R})
, per AS ({per})
, imp AS (SELECT j, avg(w.score - per.score) AS m, stddev_pop(w.score - per.score) AS s FROM per, whole w GROUP BY j)
SELECT {_fname(LI_REG_NAMES, 'j')} AS feature, round(m, 6) + 0.0 AS importance_mean, round(s, 6) + 0.0 AS importance_std,
       CAST(row_number() OVER (ORDER BY round(m, 9) DESC, j) AS INTEGER) AS rank FROM imp"""

    # one softmax round from zero margins: an independent stump per class
    multi = f"SELECT id, {LI_X}, CASE WHEN l_quantity <= 15 THEN 'low' WHEN l_quantity <= 35 THEN 'mid' ELSE 'high' END AS y FROM {LI_ROWS}"
    classes = ["high", "low", "mid"]
    for k, label in enumerate(classes):
        GRADIENTS[f"softmax:{label}"] = (f"1.0 / 3.0 - CASE WHEN y = '{label}' THEN 1.0 ELSE 0.0 END",
                                         "2.0 * (1.0 / 3.0) * (1.0 - 1.0 / 3.0)")
    stumps = " JOIN ".join(
        f"({stump_ctes(multi, LI_REG_NAMES, reg_cat, f'softmax:{label}', 1)} SELECT t.id, t.m1 AS m_{label}, "
        f"CASE WHEN t.m1 = s.vL THEN 1 ELSE 2 END AS leaf_{label} FROM st1 t, split0 s) {label}" + (" USING (id)" if k else "")
        for k, label in enumerate(classes))
    total = " + ".join(f"exp(m_{c} - top)" for c in classes)
    out["predict_multiclass_proba"] = f"""
SELECT id, CASE WHEN m_high = top THEN 'high' WHEN m_low = top THEN 'low' ELSE 'mid' END AS prediction,
       {', '.join(f"round(exp(m_{c} - top) / ({total}), 6) AS proba_{c}" for c in classes)}
FROM (SELECT *, greatest(m_high, m_low, m_mid) AS top FROM {stumps})"""
    out["predict_leaf"] = f"SELECT id, leaf_high || ',' || leaf_low || ',' || leaf_mid AS leaves FROM {stumps}"
    out["predict_margin"] = (stump_ctes(f"SELECT id, l_returnflag AS x0, l_linestatus AS x1, NULLIF(l_tax, 0.0) AS x2, CAST(l_quantity AS DOUBLE) AS x3, "
                                        f"CAST(CAST((l_returnflag = 'R') <> (l_quantity > 25) AS INTEGER) AS DOUBLE) AS y FROM {LI_ROWS}",
                                        LI_CAT_NAMES, cat_cat, "binary:logistic", 1) + "\nSELECT id, round(m1, 6) AS margin FROM st1")
    out["registry"] = """SELECT 'kept' AS model_name, 'regression' AS task, count(*) AS n_samples, true AS dropped_other, false AS dropped_again
        FROM lineitem"""
    out["gblinear_line"] = """SELECT round(regr_slope(y, x), 4) AS weight, round(regr_intercept(y, x), 4) AS bias
        FROM (SELECT CAST(l_quantity AS DOUBLE) AS x, CAST(l_quantity * (1 - l_discount) AS DOUBLE) AS y FROM lineitem)"""
    out["many_categories"] = f"""SELECT id, CAST(dense_rank() OVER (ORDER BY l_orderkey::VARCHAR || '-' || l_partkey::VARCHAR) - 1 AS BIGINT) AS code
        FROM {LI_ROWS}"""
    out["exact_bins"] = """SELECT CAST(row_number() OVER (ORDER BY v) - 2 AS BIGINT) AS bin, round(v, 6) AS threshold
        FROM (SELECT DISTINCT CAST(l_extendedprice AS DOUBLE) AS v FROM lineitem) QUALIFY row_number() OVER (ORDER BY v) > 1"""

    out["regression_metrics"] = reg_head + f"""
, e AS (SELECT y, m{R} AS p FROM st{R})
, a AS (SELECT sum((y - p) * (y - p)) AS sse, sum(y) AS sy, sum(y * y) AS syy, count(*) AS n,
               var_pop(y - p) AS ve, var_pop(y) AS vy, avg((y - p) * (y - p)) AS mse, avg(abs(y - p)) AS mae,
               max(abs(y - p)) AS mx FROM e)
SELECT 'r2' AS scorer, round(1.0 - sse / (syy - sy * sy / n), 6) AS score FROM a
UNION ALL SELECT 'explained_variance', round(1.0 - ve / vy, 6) FROM a
UNION ALL SELECT 'neg_mean_squared_error', round(-mse, 6) FROM a
UNION ALL SELECT 'neg_root_mean_squared_error', round(-sqrt(mse), 6) FROM a
UNION ALL SELECT 'neg_mean_absolute_error', round(-mae, 6) FROM a
UNION ALL SELECT 'max_error', round(-mx, 6) FROM a
UNION ALL SELECT 'neg_mean_absolute_percentage_error', round(-avg(abs(y - p) / greatest(abs(y), 2.220446049250313e-16)), 6) FROM e"""

    imp_parts = []
    feats = " UNION ALL ".join(f"SELECT '{n}' AS feature, {i} AS pos" for i, n in enumerate(LI_REG_NAMES))
    splits = " UNION ALL ".join(f"SELECT fidx, gain, Ht AS cover FROM split{r}" for r in range(R))
    aggs = {"weight": "CAST(count(*) AS DOUBLE)", "gain": "avg(gain)", "cover": "avg(cover)",
            "total_gain": "sum(gain)", "total_cover": "sum(cover)"}
    for it, agg in aggs.items():
        imp_parts.append(
            f"SELECT '{it}' AS importance_type, f.feature, round(COALESCE(a.imp, 0.0), 6) AS importance, "
            f"CAST(row_number() OVER (ORDER BY COALESCE(a.imp, 0.0) DESC, f.pos) AS INTEGER) AS rank "
            f"FROM ({feats}) f LEFT JOIN (SELECT fidx, {agg} AS imp FROM ({splits}) GROUP BY fidx) a ON a.fidx = f.pos")
    out["feature_importance"] = reg_head + "\n" + "\nUNION ALL\n".join(imp_parts)

    # partial dependence over the distinct values of l_quantity (50 < grid_resolution 100)
    pd_leaf = []
    for r in range(R):
        xb = "CASE s.fidx WHEN 0 THEN g.b WHEN 1 THEN t.b1 WHEN 2 THEN t.b2 WHEN 3 THEN t.b3 END"
        pd_leaf.append(f"(SELECT CASE WHEN {xb} <= s.bin THEN s.vL ELSE s.vR END FROM split{r} s)")
    pd_sum = " + ".join(pd_leaf)
    out["partial_dependence"] = reg_head + f"""
, grid AS (SELECT v, bin AS b FROM dv0)
SELECT round(g.v, 6) AS feature_value, CAST(NULL AS BIGINT) AS class,
       round(avg((SELECT b FROM base) + {pd_sum.replace('(SELECT CASE', '(SELECT CASE')}), 6) AS partial_dependence
FROM grid g, binned t GROUP BY g.v"""

    # explain for boosted stumps: feature of split r gets leaf_r(x) − E_r, others 0
    shap_terms = []
    for f in range(4):
        terms = []
        for r in range(R):
            xb = f"t.b{f}"
            terms.append(f"(SELECT CASE WHEN s.fidx = {f} THEN (CASE WHEN {xb} <= s.bin THEN s.vL ELSE s.vR END) "
                         f"- (s.HL / s.Ht * s.vL + s.HR / s.Ht * s.vR) ELSE 0.0 END FROM split{r} s)")
        shap_terms.append(f"SELECT t.id, '{LI_REG_NAMES[f]}' AS feature, round({' + '.join(terms)}, 6) AS shap_value, "
                          f"round((SELECT b FROM base) + {' + '.join(f'(SELECT s.HL / s.Ht * s.vL + s.HR / s.Ht * s.vR FROM split{r} s)' for r in range(R))}, 6) AS base_value FROM binned t")
    out["explain"] = id_head + "\n" + "\nUNION ALL\n".join(shap_terms)

    out["fit_cat_stump_nodes"] = stump_nodes_sql(LI_CAT, LI_CAT_NAMES, cat_cat, "binary:logistic", 1, True)

    out["predict_cat_proba"] = cat_head + """
, pr AS (SELECT 1.0 / (1.0 + exp(-m1)) AS p1, m1 FROM st1)
SELECT CAST(CASE WHEN m1 > 0 THEN 1 ELSE 0 END AS BIGINT) AS prediction, round(1.0 - p1, 6) AS proba_0,
       round(p1, 6) AS proba_1 FROM pr"""

    out["classification_metrics"] = cat_head + """
, pr AS (SELECT y, CASE WHEN m1 > 0 THEN 1.0 ELSE 0.0 END AS pred, 1.0 / (1.0 + exp(-m1)) AS p1 FROM st1)
, rk AS (SELECT y, avg(r) OVER (PARTITION BY p1) AS ar FROM (SELECT y, p1, row_number() OVER (ORDER BY p1) AS r FROM pr))
, auc AS (SELECT (sum(ar) FILTER (WHERE y = 1) - count(*) FILTER (WHERE y = 1) * (count(*) FILTER (WHERE y = 1) + 1) / 2.0)
                 / (count(*) FILTER (WHERE y = 1) * count(*) FILTER (WHERE y <> 1)) AS v FROM rk)
, c AS (SELECT count(*) FILTER (WHERE y = 1 AND pred = 1) AS tp, count(*) FILTER (WHERE y <> 1 AND pred = 1) AS fp,
               count(*) FILTER (WHERE y = 1 AND pred <> 1) AS fn, count(*) FILTER (WHERE y <> 1 AND pred <> 1) AS tn,
               count(*) AS n,
               avg(-ln(least(greatest(CASE WHEN y = 1 THEN p1 ELSE 1.0 - p1 END / ((1.0 - p1) + p1), 2.220446049250313e-16),
                   1.0 - 2.220446049250313e-16))) AS ll FROM pr)
, f AS (SELECT *, CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1p,
               CASE WHEN 2 * tn + fn + fp > 0 THEN 2.0 * tn / (2 * tn + fn + fp) ELSE 0.0 END AS f1n FROM c)
, h AS (SELECT *, CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0.0 END AS pp,
               CASE WHEN tn + fn > 0 THEN CAST(tn AS DOUBLE) / (tn + fn) ELSE 0.0 END AS pn,
               CAST(tp AS DOUBLE) / (tp + fn) AS rp, CAST(tn AS DOUBLE) / (tn + fp) AS rn FROM c)
SELECT 'roc_auc' AS scorer, round(v, 6) AS score FROM auc
UNION ALL SELECT 'roc_auc_ovr', round(v, 6) FROM auc
UNION ALL SELECT unnest(['precision_micro', 'recall_micro', 'f1_micro']), round(CAST(tp + tn AS DOUBLE) / n, 6) FROM f
UNION ALL SELECT 'precision_macro', round((pp + pn) / 2, 6) FROM h
UNION ALL SELECT 'recall_macro', round((rp + rn) / 2, 6) FROM h
UNION ALL SELECT 'precision_weighted', round((pp * (tp + fn) + pn * (tn + fp)) / n, 6) FROM h
UNION ALL SELECT 'recall_weighted', round((rp * (tp + fn) + rn * (tn + fp)) / n, 6) FROM h
UNION ALL SELECT 'neg_brier_score', round(-avg((p1 - y) * (p1 - y)), 6) FROM pr
UNION ALL SELECT 'matthews_corrcoef', round(CASE WHEN (tp + fp) * (tp + fn) * (tn + fp) * (tn + fn) > 0 THEN (CAST(tp AS DOUBLE) * tn - CAST(fp AS DOUBLE) * fn)
    / sqrt(CAST(tp + fp AS DOUBLE) * (tp + fn) * (tn + fp) * (tn + fn)) ELSE 0.0 END, 6) FROM f
UNION ALL SELECT 'average_precision', round(sum(pos * upto / allto) / max(total), 6) FROM
    (SELECT pos, sum(pos) OVER w AS upto, sum(cnt) OVER w AS allto, sum(pos) OVER () AS total
     FROM (SELECT p1, count(*) FILTER (WHERE y = 1) AS pos, count(*) AS cnt FROM pr GROUP BY p1) WINDOW w AS (ORDER BY p1 DESC))
UNION ALL SELECT 'accuracy', round(CAST(tp + tn AS DOUBLE) / n, 6) FROM f
UNION ALL SELECT 'balanced_accuracy', round((CAST(tp AS DOUBLE) / (tp + fn) + CAST(tn AS DOUBLE) / (tn + fp)) / 2, 6) FROM f
UNION ALL SELECT 'precision', round(CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0.0 END, 6) FROM f
UNION ALL SELECT 'recall', round(CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0.0 END, 6) FROM f
UNION ALL SELECT 'f1', round(f1p, 6) FROM f
UNION ALL SELECT 'f1_macro', round((f1p + f1n) / 2, 6) FROM f
UNION ALL SELECT 'f1_weighted', round((f1p * (tp + fn) + f1n * (tn + fp)) / n, 6) FROM f
UNION ALL SELECT 'neg_log_loss', round(-ll, 6) FROM f"""

    out["folds_stratified"] = f"""
WITH d AS (SELECT row_number() OVER (ORDER BY {LI_ALL}) - 1 AS id,
                  CASE WHEN l_quantity > 25 AND l_discount >= 0.05 THEN 1 ELSE 0 END AS y FROM lineitem),
cls AS (SELECT y, count(*) AS cnt, min(id) AS first FROM d GROUP BY y),
ord AS (SELECT y, cnt, sum(cnt) OVER (ORDER BY first ROWS UNBOUNDED PRECEDING) - cnt AS s FROM cls),
f AS (SELECT * FROM range(5) t(f)),
alloc AS (SELECT o.y, f.f,
   (CASE WHEN o.s + o.cnt <= f.f THEN 0 ELSE (o.s + o.cnt - f.f - 1) // 5 + 1 END)
 - (CASE WHEN o.s <= f.f THEN 0 ELSE (o.s - f.f - 1) // 5 + 1 END) AS a FROM ord o, f),
bounds AS (SELECT y, f, sum(a) OVER (PARTITION BY y ORDER BY f ROWS UNBOUNDED PRECEDING) AS hi FROM alloc),
r AS (SELECT id, y, row_number() OVER (PARTITION BY y ORDER BY id) - 1 AS rk FROM d)
SELECT CAST(r.id AS BIGINT) AS id, CAST(min(b.f) AS INTEGER) AS fold FROM r JOIN bounds b ON b.y = r.y AND r.rk < b.hi
GROUP BY r.id"""

    out["folds_plain"] = f"""
WITH d AS (SELECT row_number() OVER (ORDER BY {LI_ALL}) - 1 AS id FROM lineitem),
n AS (SELECT count(*) AS n FROM d),
f AS (SELECT f, (n // 4) + CASE WHEN f < n % 4 THEN 1 ELSE 0 END AS sz FROM range(4) t(f), n),
b AS (SELECT f, sum(sz) OVER (ORDER BY f ROWS UNBOUNDED PRECEDING) AS hi FROM f)
SELECT CAST(d.id AS BIGINT) AS id, CAST(min(b.f) AS INTEGER) AS fold FROM d JOIN b ON d.id < b.hi GROUP BY d.id"""

    P = 2147483647

    def mix(v: str) -> str:
        v1 = f"((({v}) % {P}) * 48271 % {P})"
        v2 = f"(({v1} * 69621 + 12345) % {P})"
        return f"({v2} * 48271 % {P})"

    def unif(row: str, j: int) -> str:
        h = mix(f"CAST({7 % P} AS BIGINT) + 1")
        h = mix(f"{h} + {row} % {P}")
        h = mix(f"{h} + {j + 1}")
        return f"(({h}) + 0.5) / {float(P)}"

    def normal(row: str, j: int) -> str:
        return f"(sqrt(-2.0 * ln({unif(row, 2 * j)})) * cos({2.0 * 3.141592653589793!r} * {unif(row, 2 * j + 1)}))"

    coef = [21.931367866662967, 26.345549745646096]      # fixed values: 100 · u(7, -1, j)
    feats_sql = [normal("id", j) for j in range(3)]
    target = "0.0" + "".join(f" + {coef[j]!r} * x{j}" for j in range(2)) + f" + 0.5 * {normal('id', 3)}"
    out["make_regression"] = f"""
WITH r AS (SELECT CAST(o_orderkey AS BIGINT) AS id FROM orders),
x AS (SELECT id, {feats_sql[0]} AS x0, {feats_sql[1]} AS x1, {feats_sql[2]} AS x2 FROM r)
SELECT id AS sample_id, round(x0, 6) AS feature_0, round(x1, 6) AS feature_1,
       round(x2, 6) AS feature_2, round({target}, 6) AS target FROM x"""

    out["model_lifecycle"] = """
SELECT 'li_reg_stumps' AS model_name, 'xgb_regressor' AS estimator, 'regression' AS task, 'target' AS target,
       CAST(4 AS BIGINT) AS n_features, count(*) AS n_samples, CAST(NULL AS BIGINT) AS n_classes FROM lineitem"""
    held = f"""SELECT {LI_X}, l_orderkey % 5 = 0 AS held, CAST(l_quantity * (1 - l_discount) + 20 * ((l_partkey % 7) - 3) AS DOUBLE) AS y FROM lineitem"""
    scores = " UNION ALL ".join(f"SELECT {r} AS r, (SELECT sqrt(avg((y - m{r}) * (y - m{r}))) FROM st9 WHERE held) AS score" for r in range(1, 10))
    out["early_stopping"] = tree_ctes(held, [False] * 4, "reg:squarederror", 9, 2, eta=0.9, train="NOT held") + f"""
        , scores AS ({scores}),
        so_far AS (SELECT r, score, (SELECT arg_min(b.r, b.score) FROM scores b WHERE b.r <= a.r) AS best FROM scores a),
        stop AS (SELECT coalesce(min(r), 9) AS last FROM so_far WHERE r - best >= 2),
        kept AS (SELECT best FROM so_far, stop WHERE r = last)
        SELECT CAST(r AS INTEGER) AS round, round(score, 4) AS score, r = kept.best AS best, CAST(kept.best AS INTEGER) AS kept
        FROM scores, stop, kept WHERE r <= last"""
    # approx: cuts where the weight of the second derivatives passes i/12 of the whole, per round
    def recut(rows: str, h: str) -> str:
        return f"""WITH rows_ AS MATERIALIZED ({rows}),
            held AS (SELECT x, sum(floor(({h}) * 1048576.0 + 0.5)) AS w FROM rows_ GROUP BY x),
            upto AS (SELECT x, sum(w) OVER (ORDER BY x ROWS UNBOUNDED PRECEDING) AS c, sum(w) OVER () AS whole FROM held),
            cuts AS MATERIALIZED (SELECT DISTINCT (SELECT min(x) FROM upto WHERE c > whole * i / 12.0) AS cut FROM range(1, 12) t(i))
            SELECT r.* EXCLUDE (x), x, coalesce((SELECT max(cut) FROM cuts WHERE cut <= r.x), -1.0) AS x0 FROM rows_ r"""

    plain = """SELECT CAST(l_quantity AS DOUBLE) AS x, CAST(l_discount AS DOUBLE) AS x1,
        CAST(CAST(l_quantity > 37 AND l_discount >= 0.03 AS INTEGER) AS DOUBLE) AS y FROM lineitem"""
    first = tree_ctes(recut(plain, "0.25"), [False] * 2, "binary:logistic", 1, 2)
    second = recut(f"SELECT x, x1, y, margin, 1.0 / (1.0 + exp(-margin)) AS q FROM ({first} SELECT x, x1, y, m1 AS margin FROM st1)", "greatest(q * (1.0 - q), 1e-16)")
    names = ["l_quantity", "l_discount"]
    out["fit_approx_nodes"] = (f"SELECT * FROM ({first} {nodes_sql(names, [False] * 2, 1, 2)}) UNION ALL "
                               f"SELECT * FROM ({tree_ctes(second, [False] * 2, 'margin:binary:logistic', 1, 2)} "
                               f"{nodes_sql(names, [False] * 2, 1, 2, 'CAST(1 AS INTEGER)')})")
    # the table functions give what the DataFrame functions give
    out.update(sql_predict=out["predict_stumps"], sql_explain=out["explain"], sql_importance=out["feature_importance"])
    return out
