"""Plain-SQL statements of every registered query, for an independent engine.

They run on the driver's tables (``customer``, ``orders``, ``nation``) and
restate each operator's definition directly (self-joins, group-bys, window
functions, recursive CTEs) rather than mirroring the Spark plan.

Doubles are rounded the way Spark's ``round`` does it — decimal HALF_UP of
the shortest text form — via ``VARCHAR -> DECIMAL -> ROUND -> DOUBLE``.
"""

from __future__ import annotations

from snapdiff.plans import fixtures as fx

DECAY = "CAST(0.63 AS DOUBLE)"
TAB = "chr(9)"


def rnd(expr: str, dp: int = 12) -> str:
    return f"CAST(ROUND(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,30)), {dp}) AS DOUBLE)"


def _side_ctes(x: str) -> dict[str, tuple[str, list[str]]]:
    """Per-snapshot relations (x = 'o' or 'p')."""
    n, e = f"nodes_{x}", f"edges_{x}"
    return {
        f"und_{x}": (
            f"SELECT src, dst FROM {e} WHERE src IS NOT NULL AND dst IS NOT NULL "
            f"UNION SELECT dst, src FROM {e} WHERE src IS NOT NULL AND dst IS NOT NULL",
            [e],
        ),
        f"act_{x}": (f"SELECT node_id, stored_value FROM {n} WHERE node_id IN (SELECT src FROM und_{x})", [n, f"und_{x}"]),
        f"deg_{x}": (f"SELECT src AS node_id, count(*) AS deg FROM und_{x} GROUP BY src", [f"und_{x}"]),
        f"vc_{x}": (
            f"SELECT u.src AS node_id, v.stored_value, count(*) AS n FROM und_{x} u "
            f"JOIN act_{x} v ON v.node_id = u.dst GROUP BY u.src, v.stored_value",
            [f"und_{x}", f"act_{x}"],
        ),
        # components: every label spreads only to larger ids, the least survives
        f"reach_{x}": (
            f"SELECT DISTINCT src AS node_id, src AS comp FROM und_{x} "
            f"UNION SELECT u.dst, r.comp FROM reach_{x} r JOIN und_{x} u ON u.src = r.node_id WHERE r.comp < u.dst",
            [f"und_{x}"],
        ),
        f"cc_{x}": (f"SELECT node_id, min(comp) AS component FROM reach_{x} GROUP BY node_id", [f"reach_{x}"]),
        f"parts_{x}": (
            f"SELECT CAST(ntile(3) OVER (ORDER BY component, node_id) - 1 AS INTEGER) AS part, node_id FROM cc_{x}",
            [f"cc_{x}"],
        ),
        f"mem_{x}": (
            f"SELECT part, node_id FROM parts_{x} "
            f"UNION SELECT s.part, u.dst FROM parts_{x} s JOIN und_{x} u ON u.src = s.node_id "
            f"UNION SELECT s.part, u2.dst FROM parts_{x} s JOIN und_{x} u ON u.src = s.node_id "
            f"JOIN und_{x} u2 ON u2.src = u.dst",
            [f"parts_{x}", f"und_{x}"],
        ),
        f"sadj_{x}": (
            f"SELECT m1.part, u.src, u.dst FROM und_{x} u JOIN mem_{x} m1 ON m1.node_id = u.src "
            f"JOIN mem_{x} m2 ON m2.part = m1.part AND m2.node_id = u.dst",
            [f"und_{x}", f"mem_{x}"],
        ),
        f"snodes_{x}": (
            f"SELECT m.part, m.node_id, v.stored_value, (s.node_id IS NOT NULL) AS is_subject FROM mem_{x} m "
            f"LEFT JOIN {n} v ON v.node_id = m.node_id "
            f"LEFT JOIN parts_{x} s ON s.part = m.part AND s.node_id = m.node_id",
            [f"mem_{x}", n, f"parts_{x}"],
        ),
        f"svc_{x}": (
            f"SELECT s.part, s.src AS node_id, v.stored_value, count(*) AS n FROM sadj_{x} s "
            f"JOIN snodes_{x} v ON v.part = s.part AND v.node_id = s.dst GROUP BY s.part, s.src, v.stored_value",
            [f"sadj_{x}", f"snodes_{x}"],
        ),
        f"sdeg_{x}": (f"SELECT part, src AS node_id, count(*) AS deg FROM sadj_{x} GROUP BY part, src", [f"sadj_{x}"]),
    }


def _level2(vc_o: str, vc_p: str, deg_o: str, deg_p: str, val_o: str, val_p: str, ctx: bool) -> str:
    """Non-equal positive pairs at depth 2 from per-node value counts."""
    ko = "o.part AS i, " if ctx else ""
    kp = "p.part AS j, " if ctx else ""
    grp = "i, a, j, b" if ctx else "a, b"
    on_o = "da.part = r.i AND " if ctx else ""
    on_p = "db.part = r.j AND " if ctx else ""
    vo = "va.part = r.i AND " if ctx else ""
    vp = "vb.part = r.j AND " if ctx else ""
    sel = "r.i, r.a, r.j, r.b" if ctx else "r.a, r.b"
    return (
        f"SELECT {sel}, {DECAY} * (r.s / (da.deg * db.deg)) AS score FROM ("
        f"SELECT {ko}o.node_id AS a, {kp}p.node_id AS b, CAST(sum(o.n * p.n) AS DOUBLE) AS s "
        f"FROM {vc_o} o JOIN {vc_p} p ON o.stored_value = p.stored_value GROUP BY {grp}) r "
        f"JOIN {deg_o} da ON {on_o}da.node_id = r.a JOIN {deg_p} db ON {on_p}db.node_id = r.b "
        f"JOIN {val_o} va ON {vo}va.node_id = r.a JOIN {val_p} vb ON {vp}vb.node_id = r.b "
        f"WHERE NOT coalesce(va.stored_value = vb.stored_value, false)"
    )


def _best(pairs: str, lm: str, restrict_o: str = "", restrict_p: str = "", score: str = "q.score") -> str:
    """Best match per node, both directions; equal scores go to the least id."""
    return f"""
    SELECT side, node_id, equal_id AS match_id, CAST(1.0 AS DOUBLE) AS score FROM {lm} WHERE n_equal > 0
    UNION ALL
    SELECT 'original', l.node_id, t.match_id, coalesce(t.score, CAST(0.0 AS DOUBLE))
    FROM {lm} l LEFT JOIN (
        SELECT q.a AS node_id, q.b AS match_id, {rnd(score)} AS score,
               row_number() OVER (PARTITION BY q.a ORDER BY {score} DESC, q.b ASC) AS rn
        FROM {pairs} q {restrict_o} WHERE q.score > 0) t ON t.node_id = l.node_id AND t.rn = 1
    WHERE l.side = 'original' AND l.n_equal = 0
    UNION ALL
    SELECT 'perturbed', l.node_id, t.match_id, coalesce(t.score, CAST(0.0 AS DOUBLE))
    FROM {lm} l LEFT JOIN (
        SELECT q.b AS node_id, q.a AS match_id, {rnd(score)} AS score,
               row_number() OVER (PARTITION BY q.b ORDER BY {score} DESC, q.a ASC) AS rn
        FROM {pairs} q {restrict_p} WHERE q.score > 0) t ON t.node_id = l.node_id AND t.rn = 1
    WHERE l.side = 'perturbed' AND l.n_equal = 0"""


def _split(m: str, prefix: str, method: str) -> dict[str, tuple[str, list[str]]]:
    """Two-cluster split of the original side's imperfect scores of matches ``m``."""
    near_lo = f"{rnd('abs(u.score - c.lo)')} < {rnd('abs(u.score - c.hi)')}"
    ctes: dict[str, tuple[str, list[str]]] = {
        f"{prefix}_uo": (f"SELECT node_id, {rnd('score')} AS score FROM {m} WHERE side = 'original' AND score < 1", [m]),
    }
    if method == "two_means":
        it_near = f"{rnd('abs(u.score - it.lo)')} < {rnd('abs(u.score - it.hi)')}"
        ctes[f"{prefix}_it"] = (
            f"SELECT 0 AS n, min(score) AS lo, max(score) AS hi, false AS done FROM {prefix}_uo "
            f"UNION ALL SELECT n + 1, new_lo, new_hi, (new_lo = lo AND new_hi = hi) FROM ("
            f"SELECT it.n, it.lo, it.hi, "
            f"{rnd(f'avg(CASE WHEN {it_near} THEN u.score END)')} AS new_lo, "
            f"{rnd(f'avg(CASE WHEN NOT ({it_near}) THEN u.score END)')} AS new_hi "
            f"FROM {prefix}_it it JOIN {prefix}_uo u ON true "
            f"WHERE NOT it.done AND it.n < 100 AND it.lo < it.hi GROUP BY it.n, it.lo, it.hi) s",
            [f"{prefix}_uo"],
        )
        ctes[f"{prefix}_c"] = (f"SELECT lo, hi FROM {prefix}_it ORDER BY n DESC LIMIT 1", [f"{prefix}_it"])
    else:
        ctes[f"{prefix}_firsts"] = (
            f"SELECT score, min('original_' || CAST(node_id AS VARCHAR)) AS k FROM {prefix}_uo GROUP BY score",
            [f"{prefix}_uo"],
        )
        ctes[f"{prefix}_c"] = (
            f"SELECT min(score) AS lo, max(score) AS hi FROM (SELECT score FROM {prefix}_firsts ORDER BY k LIMIT 2) s",
            [f"{prefix}_firsts"],
        )
    ctes[f"{prefix}_split"] = (
        f"SELECT u.node_id, CASE WHEN c.lo < c.hi AND {near_lo} THEN 'Removed' ELSE 'Modified' END AS change_type "
        f"FROM {prefix}_uo u JOIN {prefix}_c c ON true",
        [f"{prefix}_uo", f"{prefix}_c"],
    )
    ctes[f"{prefix}_changes"] = (
        f"SELECT change_type, node_id FROM {prefix}_split UNION ALL "
        f"SELECT 'Added', node_id FROM (SELECT DISTINCT node_id FROM {m} WHERE side <> 'original' AND score < 1) x "
        f"WHERE node_id NOT IN (SELECT node_id FROM {prefix}_split WHERE change_type = 'Modified')",
        [m, f"{prefix}_split"],
    )
    return ctes


def _evaluation_ctes() -> dict[str, tuple[str, list[str]]]:
    flags = []
    for ct, t in (("Modified", "mod"), ("Removed", "rem"), ("Added", "add")):
        for src in ("p", "a"):
            flags.append(f"max(CASE WHEN change_type = '{ct}' AND src = '{src}' THEN 1 ELSE 0 END) AS {t}_{src}")
    sums = []
    for t in ("mod", "rem", "add"):
        sums += [
            f"sum({t}_p * {t}_a) AS {t}_tp",
            f"sum({t}_p * (1 - {t}_a)) AS {t}_fp",
            f"sum((1 - {t}_p) * {t}_a) AS {t}_fn",
            f"sum({t}_p) AS {t}_np",
            f"sum({t}_a) AS {t}_na",
        ]
    sums.append("sum(rem_a * greatest(rem_p, add_p) + add_a * greatest(rem_p, add_p)) AS dtl_ra")
    sums.append("sum(rem_a * rem_p + add_a * rem_p) AS dtl_rt")
    conf = []
    for ct, t in (("Modified", "mod"), ("Removed", "rem"), ("Added", "add")):
        prec = f"CASE WHEN {t}_tp + {t}_fp > 0 THEN CAST({t}_tp AS DOUBLE) / CAST({t}_tp + {t}_fp AS DOUBLE) ELSE 0.0 END"
        rec = f"CASE WHEN {t}_tp + {t}_fn > 0 THEN CAST({t}_tp AS DOUBLE) / CAST({t}_tp + {t}_fn AS DOUBLE) ELSE 0.0 END"
        conf.append(
            f"SELECT '{ct}' AS change_type, CAST({t}_tp AS BIGINT) AS tp, CAST({t}_fp AS BIGINT) AS fp, "
            f"CAST({t}_fn AS BIGINT) AS fn, CAST((n_o + n_p - (2 * {t}_tp + {t}_fn + {t}_fp)) // 2 AS BIGINT) AS tn, "
            f"CAST({prec} AS DOUBLE) AS precision, CAST({rec} AS DOUBLE) AS recall FROM ev_cnt JOIN ev_n ON true"
        )
    return {
        "ev_flags": (
            "SELECT node_id, " + ", ".join(flags) + " FROM (SELECT change_type, node_id, 'p' AS src FROM pred "
            "UNION ALL SELECT change_type, node_id, 'a' AS src FROM truth) t GROUP BY node_id",
            ["pred", "truth"],
        ),
        "ev_cnt": ("SELECT " + ", ".join(f"coalesce({s.split(' AS ')[0]}, 0) AS {s.split(' AS ')[1]}" for s in sums) + " FROM ev_flags", ["ev_flags"]),
        "ev_n": ("SELECT (SELECT count(*) FROM nodes_o) AS n_o, (SELECT count(*) FROM nodes_p) AS n_p", ["nodes_o", "nodes_p"]),
        "conf_raw": (" UNION ALL ".join(conf), ["ev_cnt", "ev_n"]),
        "conf": (
            "SELECT change_type, tp, fp, fn, tn, precision, recall, "
            "CASE WHEN precision + recall > 0 THEN 2 * (precision * recall) / (precision + recall) ELSE 0.0 END AS f1_score "
            "FROM conf_raw",
            ["conf_raw"],
        ),
        "tl_ra": (_trace("dtl_ra", "rem_np + add_np"), ["ev_cnt", "ev_n"]),
        "tl_rt": (_trace("dtl_rt", "2 * rem_np"), ["ev_cnt", "ev_n"]),
        "report": (
            "SELECT "
            + ", ".join(
                f"{rnd(f'max(CASE WHEN change_type = {chr(39)}{ct}{chr(39)} THEN {s} END)', 4)} AS {ct.lower()}_{s}"
                for ct in ("Modified", "Removed", "Added")
                for s in ("precision", "recall", "f1_score")
            )
            + ", (SELECT "
            + rnd("acc", 4)
            + " FROM tl_ra) AS acc, (SELECT "
            + rnd("btlr", 4)
            + " FROM tl_ra) AS btlr, (SELECT "
            + rnd("vpr", 4)
            + " FROM tl_ra) AS vpr FROM conf",
            ["conf", "tl_ra"],
        ),
    }


def _trace(dtl: str, cp_n: str) -> str:
    # both snapshots' nodes, less every true or predicted change, count half as old links each
    errors = f"(mod_na + mod_np - 2 * mod_tp) + (rem_na + add_na + {cp_n} - 2 * {dtl})"
    rows = (
        f"SELECT CAST({dtl} AS BIGINT) AS dtl, CAST({errors} AS BIGINT) AS btl, "
        f"CAST(mod_np - mod_tp + rem_na + add_na - {dtl} AS BIGINT) AS wtl, "
        f"CAST(mod_tp AS BIGINT) + CAST(n_o + n_p - 2 * {dtl} - ({errors}) AS BIGINT) // 2 AS atl "
        f"FROM ev_cnt JOIN ev_n ON true"
    )
    rows = f"SELECT dtl, atl, btl - wtl AS ctl, wtl, btl, atl + dtl AS gtl, atl + dtl + btl AS rtl FROM ({rows}) r"

    def ratio(n: str, d: str) -> str:
        return f"coalesce(CAST({n} AS DOUBLE) / nullif(CAST({d} AS DOUBLE), 0), 0.0)"

    return (
        f"SELECT dtl, atl, ctl, wtl, btl, gtl, rtl, {ratio('atl', 'rtl')} AS acc, {ratio('wtl', 'rtl')} AS btlr, "
        f"{ratio('gtl - btl', '2 * rtl')} + 0.5 AS vpr FROM ({rows}) d"
    )


def _all_ctes() -> dict[str, tuple[str, list[str]]]:
    add = fx.ADD_OFFSET
    c: dict[str, tuple[str, list[str]]] = {
        "nodes_o": (
            "SELECT CAST(c_custkey AS BIGINT) AS node_id, "
            "CAST(CAST(ROUND(c_acctbal * 100) AS BIGINT) AS VARCHAR) AS stored_value FROM customer",
            [],
        ),
        "edges_o": (
            "SELECT DISTINCT CAST(a.o_custkey AS BIGINT) AS src, CAST(b.o_custkey AS BIGINT) AS dst "
            "FROM orders a JOIN orders b ON b.o_orderkey = a.o_orderkey + 1 WHERE a.o_custkey <> b.o_custkey",
            [],
        ),
        "nodes_p": (
            f"SELECT node_id, CASE WHEN node_id % {fx.MODIFY_MOD} = {fx.MODIFY_REM} THEN stored_value || '#m' "
            f"ELSE stored_value END AS stored_value FROM nodes_o WHERE node_id % {fx.REMOVE_MOD} <> {fx.REMOVE_REM} "
            f"UNION ALL SELECT node_id + {add}, stored_value || '#a' FROM nodes_o "
            f"WHERE node_id % {fx.ADD_MOD} = {fx.ADD_REM}",
            ["nodes_o"],
        ),
        "edges_p": (
            f"SELECT src, dst FROM edges_o WHERE src % {fx.REMOVE_MOD} <> {fx.REMOVE_REM} "
            f"AND dst % {fx.REMOVE_MOD} <> {fx.REMOVE_REM} AND (src * {fx.CUT_MUL} + dst) % {fx.CUT_MOD} <> 0 "
            f"UNION ALL SELECT node_id + {add} AS src, node_id + 1 AS dst FROM nodes_o "
            f"WHERE node_id % {fx.ADD_MOD} = {fx.ADD_REM} AND node_id + 1 IN (SELECT node_id FROM nodes_p)",
            ["edges_o", "nodes_o", "nodes_p"],
        ),
        "truth": (
            f"SELECT 'Removed' AS change_type, node_id FROM nodes_o WHERE node_id % {fx.REMOVE_MOD} = {fx.REMOVE_REM} "
            f"UNION ALL SELECT 'Modified', node_id FROM nodes_o WHERE node_id % {fx.MODIFY_MOD} = {fx.MODIFY_REM} "
            f"AND node_id % {fx.REMOVE_MOD} <> {fx.REMOVE_REM} "
            f"UNION ALL SELECT 'Added', node_id + {add} FROM nodes_o WHERE node_id % {fx.ADD_MOD} = {fx.ADD_REM}",
            ["nodes_o"],
        ),
    }
    c.update(_side_ctes("o"))
    c.update(_side_ctes("p"))
    c["lm"] = (
        "SELECT 'original' AS side, o.node_id, count(p.node_id) AS n_equal, min(p.node_id) AS equal_id "
        "FROM act_o o LEFT JOIN act_p p ON p.stored_value = o.stored_value GROUP BY o.node_id "
        "UNION ALL SELECT 'perturbed', p.node_id, count(o.node_id), min(o.node_id) "
        "FROM act_p p LEFT JOIN act_o o ON o.stored_value = p.stored_value GROUP BY p.node_id",
        ["act_o", "act_p"],
    )
    c["eq"] = (
        "SELECT o.node_id AS a, p.node_id AS b, CAST(1.0 AS DOUBLE) AS score FROM act_o o "
        "JOIN act_p p ON o.stored_value = p.stored_value",
        ["act_o", "act_p"],
    )
    c["lvl2"] = (_level2("vc_o", "vc_p", "deg_o", "deg_p", "act_o", "act_p", False), ["vc_o", "vc_p", "deg_o", "deg_p", "act_o", "act_p"])
    c["raw3"] = (
        "SELECT a, b, sum(s) AS s FROM (SELECT o.node_id AS a, p.node_id AS b, CAST(o.n * p.n AS DOUBLE) AS s FROM vc_o o "
        "JOIN vc_p p ON o.stored_value = p.stored_value "
        "UNION ALL SELECT uo.src AS a, up.src AS b, r.score AS s "
        "FROM und_o uo JOIN lvl2 r ON r.a = uo.dst JOIN und_p up ON up.dst = r.b) t GROUP BY a, b",
        ["vc_o", "vc_p", "und_o", "und_p", "lvl2"],
    )
    c["lvl3"] = (
        f"SELECT r.a, r.b, {DECAY} * (r.s / (da.deg * db.deg)) AS score FROM raw3 r "
        "JOIN deg_o da ON da.node_id = r.a JOIN deg_p db ON db.node_id = r.b "
        "JOIN act_o va ON va.node_id = r.a JOIN act_p vb ON vb.node_id = r.b "
        "WHERE NOT coalesce(va.stored_value = vb.stored_value, false)",
        ["raw3", "deg_o", "deg_p", "act_o", "act_p"],
    )
    c["bm"] = (_best("lvl2", "lm"), ["lvl2", "lm"])
    # sums of doubles: compared by their 40 leading bits, so that their order does not decide
    lead = "(q.score * CAST(8193 AS DOUBLE) - (q.score * CAST(8193 AS DOUBLE) - q.score))"
    c["bm3"] = (_best("lvl3", "lm", score=lead), ["lvl3", "lm"])
    c["slvl2"] = (
        _level2("svc_o", "svc_p", "sdeg_o", "sdeg_p", "snodes_o", "snodes_p", True),
        ["svc_o", "svc_p", "sdeg_o", "sdeg_p", "snodes_o", "snodes_p"],
    )
    c["sm"] = (
        _best(
            "slvl2",
            "lm",
            "JOIN parts_o so ON so.part = q.i AND so.node_id = q.a",
            "JOIN parts_p sp ON sp.part = q.j AND sp.node_id = q.b",
        ),
        ["slvl2", "lm", "parts_o", "parts_p"],
    )
    c.update(_split("bm", "tm", "two_means"))
    c.update(_split("bm", "ts", "two_seeds"))
    c.update(_split("sm", "ss", "two_seeds"))
    c["pred"] = ("SELECT change_type, node_id FROM tm_changes", ["tm_changes"])
    c.update(_evaluation_ctes())
    return c


_CTES = _all_ctes()


SPARSE_EDGES = (
    "SELECT CAST(a.c_custkey AS BIGINT) AS src, CAST(b.c_custkey AS BIGINT) AS dst FROM customer a JOIN customer b "
    "ON (b.c_custkey = a.c_custkey + 1 AND a.c_nationkey % 2 = b.c_nationkey % 2) "
    "OR (b.c_custkey = a.c_custkey + 3 AND a.c_mktsegment = b.c_mktsegment)"
)


def _on_sparse(sql: str) -> str:
    """The same statement over the second edge relation."""
    return sql.replace(f"edges_o AS ({_CTES['edges_o'][0]})", f"edges_o AS ({SPARSE_EDGES})")


HOT_NODES = (
    "SELECT CAST(c_custkey AS BIGINT) AS node_id, CASE c_nationkey % 3 WHEN 0 THEN 'hot' WHEN 1 THEN 'warm' "
    "ELSE CAST(CAST(ROUND(c_acctbal * 100) AS BIGINT) AS VARCHAR) END AS stored_value FROM customer"
)


def _with(final: str, *needed: str) -> str:
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for dep in _CTES[name][1]:
            visit(dep)
        order.append(name)

    for n in needed:
        visit(n)
    body = ",\n".join(f"{n} AS ({_CTES[n][0]})" for n in order)
    return f"WITH RECURSIVE {body}\n{final}"


def _both(select_o: str, select_p: str, *needed: str) -> str:
    return _with(f"SELECT 'original' AS side, * FROM ({select_o}) o UNION ALL SELECT 'perturbed' AS side, * FROM ({select_p}) p", *needed)


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["nodes_scan"] = _both("SELECT * FROM nodes_o", "SELECT * FROM nodes_p", "nodes_o", "nodes_p")
    q["edges_scan"] = _both("SELECT * FROM edges_o", "SELECT * FROM edges_p", "edges_o", "edges_p")
    q["component_split"] = _with(
        "SELECT 'node' AS kind, node_id, stored_value, CAST(NULL AS BIGINT) AS src, CAST(NULL AS BIGINT) AS dst "
        "FROM nodes_o UNION ALL SELECT 'edge', CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), src, dst FROM edges_o",
        "nodes_o",
        "edges_o",
    )
    q["node_counts"] = _with(
        "SELECT (SELECT count(*) FROM nodes_o) AS n_original, (SELECT count(*) FROM nodes_p) AS n_perturbed",
        "nodes_o",
        "nodes_p",
    )
    q["truth_flatten"] = _with("SELECT change_type, node_id FROM truth", "truth")
    q["out_adjacency"] = _both(
        "SELECT n.node_id, e.dst FROM nodes_o n LEFT JOIN edges_o e ON e.src = n.node_id",
        "SELECT n.node_id, e.dst FROM nodes_p n LEFT JOIN edges_p e ON e.src = n.node_id",
        "nodes_o", "edges_o", "nodes_p", "edges_p",
    )
    q["undirected_edges"] = _both("SELECT * FROM und_o", "SELECT * FROM und_p", "und_o", "und_p")
    q["isolated_nodes"] = _both(
        "SELECT node_id FROM nodes_o WHERE node_id NOT IN (SELECT src FROM und_o)",
        "SELECT node_id FROM nodes_p WHERE node_id NOT IN (SELECT src FROM und_p)",
        "nodes_o", "und_o", "nodes_p", "und_p",
    )
    q["degrees"] = _both(
        "SELECT node_id, deg AS degree FROM deg_o", "SELECT node_id, deg AS degree FROM deg_p", "deg_o", "deg_p"
    )
    q["connected_components"] = _both("SELECT * FROM cc_o", "SELECT * FROM cc_p", "cc_o", "cc_p")
    q["partition_nodes"] = _both("SELECT * FROM parts_o", "SELECT * FROM parts_p", "parts_o", "parts_p")
    q["khop_nodes"] = _both("SELECT * FROM mem_o", "SELECT * FROM mem_p", "mem_o", "mem_p")
    q["induced_subgraph"] = _both("SELECT * FROM sadj_o", "SELECT * FROM sadj_p", "sadj_o", "sadj_p")
    counts = (
        "SELECT n.part, n.n_subjects, n.n_nodes, CAST(coalesce(e.n_edges, 0) AS BIGINT) AS n_edges FROM "
        "(SELECT part, CAST(sum(CAST(is_subject AS BIGINT)) AS BIGINT) AS n_subjects, count(*) AS n_nodes "
        "FROM snodes_{x} GROUP BY part) n LEFT JOIN (SELECT part, count(*) AS n_edges FROM sadj_{x} GROUP BY part) e "
        "ON e.part = n.part"
    )
    q["build_shards"] = _both(counts.format(x="o"), counts.format(x="p"), "snodes_o", "sadj_o", "snodes_p", "sadj_p")
    q["shard_pairs"] = _with(
        "SELECT DISTINCT o.part AS i, p.part AS j FROM (SELECT DISTINCT part, stored_value FROM snodes_o) o "
        "JOIN (SELECT DISTINCT part, stored_value FROM snodes_p) p ON o.stored_value = p.stored_value",
        "snodes_o",
        "snodes_p",
    )
    rt = (
        "SELECT n.part, n.node_id, n.stored_value, n.is_subject, CAST(coalesce(d.c, 0) AS BIGINT) AS n_neighbors "
        "FROM snodes_{x} n LEFT JOIN (SELECT part, src, count(*) AS c FROM sadj_{x} GROUP BY part, src) d "
        "ON d.part = n.part AND d.src = n.node_id"
    )
    q["shard_roundtrip"] = _both(rt.format(x="o"), rt.format(x="p"), "snodes_o", "sadj_o", "snodes_p", "sadj_p")
    q["label_match"] = _with("SELECT side, node_id, n_equal, equal_id FROM lm", "lm")
    q["unmatched_nodes"] = _with("SELECT side, node_id FROM lm WHERE n_equal = 0", "lm")
    q["simrank_pairs"] = _with(
        f"SELECT a, b, {rnd('score')} AS score FROM (SELECT a, b, score FROM eq UNION ALL SELECT a, b, score FROM lvl2) s",
        "eq",
        "lvl2",
    )
    q["simrank_depth3"] = _with(
        f"SELECT a, b, {rnd('score')} AS score FROM (SELECT a, b, score FROM eq UNION ALL SELECT a, b, score FROM lvl3) s",
        "eq",
        "lvl3",
    )
    q["best_match"] = _with("SELECT side, node_id, match_id, score FROM bm", "bm")
    q["sharded_match"] = _with("SELECT side, node_id, match_id, score FROM sm", "sm")
    q["best_match_depth3"] = _with("SELECT side, node_id, match_id, score FROM bm3", "bm3")
    q["best_match_depth3_sparse"] = _on_sparse(q["best_match_depth3"])
    q["best_match_hot"] = q["best_match"].replace(f"nodes_o AS ({_CTES['nodes_o'][0]})", f"nodes_o AS ({HOT_NODES})")
    q["match_encode"] = _with(
        "SELECT side, node_id, side || '_' || CAST(node_id AS VARCHAR) AS key, "
        "CAST(coalesce(match_id, -1) AS VARCHAR) AS match_part, score FROM bm",
        "bm",
    )
    q["match_decode"] = _with(
        f"""SELECT side, node_id, CASE WHEN match_id <> -1 THEN match_id END AS match_id, {rnd('score')} AS score FROM (
          SELECT k[1] AS side, TRY_CAST(k[2] AS BIGINT) AS node_id, TRY_CAST(v[1] AS BIGINT) AS match_id,
                 TRY_CAST(v[2] AS DOUBLE) AS score
          FROM (SELECT string_split(h[1], '_') AS k, string_split(h[2], '_') AS v FROM (
                  SELECT string_split(line, {TAB}) AS h FROM (
                    SELECT key || {TAB} || value AS line FROM enc
                    UNION ALL
                    SELECT CASE node_id % 4 WHEN 0 THEN key
                                WHEN 1 THEN key || {TAB} || value || {TAB} || 'extra'
                                WHEN 2 THEN key || '_1' || {TAB} || value
                                ELSE key || {TAB} || split_part(value, '_', 1) END FROM enc) l) h
                WHERE len(h) = 2 AND length(h[1]) > 0 AND length(h[2]) > 0) kv
          WHERE len(k) = 2 AND length(k[1]) > 0 AND length(k[2]) > 0
            AND len(v) = 2 AND length(v[1]) > 0 AND length(v[2]) > 0) t
        WHERE node_id IS NOT NULL AND match_id IS NOT NULL AND score IS NOT NULL""".replace(
            "FROM enc", "FROM (SELECT node_id, side || '_' || CAST(node_id AS VARCHAR) AS key, "
            "CAST(coalesce(match_id, -1) AS VARCHAR) || '_' || CAST(score AS VARCHAR) AS value FROM bm) e"
        ),
        "bm",
    )
    q["split_two_seeds"] = _with("SELECT node_id, change_type FROM ts_split", "ts_split")
    q["split_two_means"] = _with("SELECT node_id, change_type FROM tm_split", "tm_split")
    q["classify_changes"] = _with("SELECT change_type, node_id FROM ss_changes", "ss_changes")
    q["detect_changes"] = _with("SELECT change_type, node_id FROM tm_changes", "tm_changes")
    q["confusion_scores"] = _with(
        f"SELECT change_type, tp, fp, fn, tn, {rnd('precision')} AS precision, {rnd('recall')} AS recall, "
        f"{rnd('f1_score')} AS f1_score FROM conf",
        "conf",
    )
    trace_cols = f"dtl, atl, ctl, wtl, btl, gtl, rtl, {rnd('acc')} AS acc, {rnd('btlr')} AS btlr, {rnd('vpr')} AS vpr"
    q["traceability_scores"] = _with(f"SELECT {trace_cols} FROM tl_ra", "tl_ra")
    q["traceability_removed_twice"] = _with(f"SELECT {trace_cols} FROM tl_rt", "tl_rt")
    q["score_report"] = _with("SELECT * FROM report", "report")
    q["scores_long"] = _with(
        " UNION ALL ".join(
            f"SELECT change_type, '{s}' AS score_type, {rnd(s)} AS score FROM conf"
            for s in ("precision", "recall", "f1_score")
        ),
        "conf",
    )
    metrics = [(ct, s) for ct in ("Modified", "Removed", "Added") for s in ("precision", "recall", "f1_score")]
    q["evaluate_changes"] = _with(
        " UNION ALL ".join(
            f"SELECT '{ct}' AS change_type, '{s}' AS score_type, {ct.lower()}_{s} AS score FROM report" for ct, s in metrics
        )
        + " UNION ALL "
        + " UNION ALL ".join(f"SELECT 'Traceability', '{s}', {s} FROM report" for s in ("acc", "btlr", "vpr")),
        "report",
    )
    for name in ("connected_components", "partition_nodes", "khop_nodes", "induced_subgraph", "build_shards", "shard_pairs",
                 "shard_roundtrip", "sharded_match", "classify_changes"):
        q[f"{name}_sparse"] = _on_sparse(q[name])
    q["shard_read_parts"] = _on_sparse(_with(
        "SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{side}' AS side, * FROM ({rt.format(x=side[0])}) {side} " for side in ("original", "perturbed"))
        + ") r WHERE part IN (0, 2)",
        "snodes_o", "sadj_o", "snodes_p", "sadj_p",
    ))
    # every match is one good line and one bad one: a half missing, one too many, a key or a value of the wrong parts
    q["match_skips"] = _with(
        "SELECT CAST(2 * count(*) AS BIGINT) AS n_read, CAST(count(*) AS BIGINT) AS n_kept, "
        "CAST(count(*) FILTER (WHERE node_id % 4 IN (0, 1)) AS BIGINT) AS n_no_tab, "
        "CAST(count(*) FILTER (WHERE node_id % 4 = 2) AS BIGINT) AS n_bad_key, "
        "CAST(count(*) FILTER (WHERE node_id % 4 = 3) AS BIGINT) AS n_bad_value, CAST(0 AS BIGINT) AS n_no_number FROM bm",
        "bm",
    )
    q["nodes_read"] = _with("SELECT * FROM nodes_p", "nodes_p")
    q["edges_read"] = _with("SELECT * FROM edges_p", "edges_p")
    q["match_files"] = q["best_match"]
    lists = (
        "SELECT n.node_id, coalesce(string_agg(CAST(e.dst AS VARCHAR), ',' ORDER BY e.dst), '') AS neighbors "
        "FROM nodes_{x} n LEFT JOIN edges_{x} e ON e.src = n.node_id GROUP BY n.node_id"
    )
    q["neighbor_lists"] = _on_sparse(_both(lists.format(x="o"), lists.format(x="p"), "nodes_o", "edges_o", "nodes_p", "edges_p"))
    q["truth_tabs"] = q["truth_flatten"]
    q["evaluate_report"] = q["score_report"]
    everyone = {f"act_{x}": f"SELECT node_id, stored_value FROM nodes_{x}" for x in "op"}
    own_rows = {f"und_{x}": f"SELECT DISTINCT src, dst FROM edges_{x}" for x in "op"}
    for name, base, changed in (("detect_all_nodes", "detect_changes", everyone), ("simrank_directed", "simrank_pairs", own_rows)):
        sql = _on_sparse(q[base])
        for cte, body in changed.items():
            assert f"{cte} AS ({_CTES[cte][0]})" in sql
            sql = sql.replace(f"{cte} AS ({_CTES[cte][0]})", f"{cte} AS ({body})")
        q[name] = sql
    return q
