"""DuckDB SQL text for the K-Means oracles.

Each function writes, as one SQL statement, the same arithmetic the Spark operators run: squared
distances as ``dx*dx + dy*dy``, the first minimum as ``least`` + ``CASE``, micro-unit sums, md5
uniforms and exponential keys. A fit is a recursive CTE that stops when no point moves. This is test scaffolding for ``oracle_sql()``; no Spark code uses it.
"""

from __future__ import annotations

from collections.abc import Sequence

from centroidal.functions.hashing import hash_uniform_sql

X, Y = "pickup_longitude", "pickup_latitude"


def lit(v: float) -> str:
    return f"({float(v)!r})::DOUBLE"


def dist(px: str, py: str, cx: str, cy: str) -> str:
    return f"(({px}) - ({cx})) * (({px}) - ({cx})) + (({py}) - ({cy})) * (({py}) - ({cy}))"


def micro(c: str, scale: int = 6) -> str:
    return f"CAST(floor(({c}) * {float(10 ** scale)!r}::DOUBLE + 0.5::DOUBLE) AS BIGINT)"


def wide_centres(centres: Sequence[tuple[float, float]]) -> str:
    """One-row relation ``x0, y0, x1, y1, ...`` of literal centres."""
    return "SELECT " + ", ".join(f"{lit(cx)} AS x{i}, {lit(cy)} AS y{i}" for i, (cx, cy) in enumerate(centres))


def long_centres(wide: str, k: int) -> str:
    """``cluster_id, cx, cy`` rows from a one-row wide relation name."""
    return " UNION ALL ".join(f"SELECT {i}::INTEGER AS cluster_id, x{i} AS cx, y{i} AS cy FROM {wide}"
                              for i in range(k))


def assign(src: str, k: int, cur: str, prev: str | None = None, x: str = X, y: str = Y) -> str:
    """Rows of ``src`` with ``k`` (nearest of ``cur``), ``d`` and, with ``prev``, ``kp``.

    ``cur``/``prev`` are one-row wide centre relations (``x0, y0, ...``), cross joined (one row).
    """
    def block(rel: str, tag: str) -> tuple[list[str], str, str]:
        ds = [f"{dist(x, y, f'{rel}.x{i}', f'{rel}.y{i}')} AS _{tag}{i}" for i in range(k)]
        m = f"least({', '.join(f'_{tag}{i}' for i in range(k))})" if k > 1 else f"_{tag}0"
        if k == 1:
            arg = "0"
        else:
            arg = "CASE " + " ".join(f"WHEN _{tag}{i} = _m{tag} THEN {i}" for i in range(k - 1)) + f" ELSE {k - 1} END"
        return ds, m, arg

    dcur, mcur, acur = block("_cur", "d")
    cols = list(dcur)
    rels = f"{src} AS _p, {cur} AS _cur"
    mids = [f"{mcur} AS _md"]
    outs = [f"CAST({acur} AS INTEGER) AS k", "_md AS d"]
    if prev is not None:
        dprev, mprev, aprev = block("_prev", "p")
        cols += dprev
        rels += f", {prev} AS _prev"
        mids.append(f"{mprev} AS _mp")
        outs.append(f"CAST({aprev} AS INTEGER) AS kp")
    inner = f"SELECT _p.*, {', '.join(cols)} FROM {rels}"
    mid = f"SELECT *, {', '.join(mids)} FROM ({inner})"
    keep = "* EXCLUDE (" + ", ".join([f"_d{i}" for i in range(k)] + ([f"_p{i}" for i in range(k)] if prev else [])
                                     + ["_md"] + (["_mp"] if prev else [])) + ")"
    return f"SELECT {keep}, {', '.join(outs)} FROM ({mid})"


def group_step(assigned: str, moved_all: bool, x: str = X, y: str = Y) -> str:
    """Per-cluster ``k, sx, sy, n, sse, moved`` of an assigned relation."""
    moved = "count(*)" if moved_all else "sum(CASE WHEN k <> kp THEN 1 ELSE 0 END)"
    return (f"SELECT k, sum({micro(x)}) AS sx, sum({micro(y)}) AS sy, count(*) AS n, sum(d) AS sse, "
            f"CAST({moved} AS BIGINT) AS moved FROM {assigned} GROUP BY k")


def update(groups: str, old: str, k: int) -> str:
    """New one-row wide centres: mean from the exact sums, or the old centre for an empty cluster."""
    cols = []
    for i in range(k):
        for axis, s in (("x", "sx"), ("y", "sy")):
            cols.append(f"coalesce((SELECT {s}::DOUBLE / n::DOUBLE / 1000000.0::DOUBLE FROM {groups} WHERE k = {i}),"
                        f" {old}.{axis}{i}) AS {axis}{i}")
    return f"SELECT {', '.join(cols)} FROM {old}"


def kmeans_parallel_ctes(pts: str, k: int, seed: int, rounds: int, oversampling: float, scale: int, key: str = "id",
                         x: str = X, y: str = Y) -> list[tuple[str, str]]:
    """K-Means‖ unrolled: ``k0..k{rounds}`` (the candidates after each round) and ``weighted`` (key, coordinates and
    the points nearest to each candidate, ``m``)."""
    first = hash_uniform_sql(key, seed, "parallel:0")
    ctes = [("k0", f"SELECT 0 AS r, {key}, {x}, {y} FROM {pts} ORDER BY -ln({first}) / 1.0::DOUBLE, {key} LIMIT 1")]
    unit = float(10 ** scale)
    for r in range(1, rounds + 1):
        u = hash_uniform_sql(f"w{r}.{key}", seed, f"parallel:{r}")
        d = dist(f"p.{x}", f"p.{y}", f"c.{x}", f"c.{y}")
        ctes.append((f"w{r}", f"SELECT p.{key}, p.{x}, p.{y}, min({d}) AS w FROM {pts} AS p, k{r - 1} AS c GROUP BY ALL"))
        ctes.append((f"t{r}", f"SELECT sum({micro('w', scale)})::DOUBLE / {unit!r}::DOUBLE AS total FROM w{r}"))
        ctes.append((f"k{r}", f"SELECT * FROM k{r - 1} UNION ALL SELECT {r} AS r, {key}, {x}, {y} FROM w{r}, t{r} "
                              f"WHERE total > 0 AND {u} < {lit(oversampling * k)} * w / total"))
    d = dist(f"p.{x}", f"p.{y}", f"c.{x}", f"c.{y}")
    ctes.append(("cands", f"SELECT *, row_number() OVER (ORDER BY r, {key}) AS j FROM k{rounds}"))
    ctes.append(("near", f"SELECT m.j AS j FROM (SELECT p.{key}, min({{'d': {d}, 'j': j}}) AS m FROM {pts} AS p, cands AS c GROUP BY ALL)"))
    ctes.append(("weighted", f"SELECT c.{key}, c.{x}, c.{y}, count(n.j) AS m FROM cands AS c LEFT JOIN near AS n ON n.j = c.j GROUP BY c.j, c.{key}, c.{x}, c.{y}"))
    return ctes


def kmeanspp_ctes(pts: str, k: int, seed: int, key: str = "id", x: str = X, y: str = Y, mult: str | None = None) -> list[tuple[str, str]]:
    """CTEs ``s0..s{k-1}`` (one chosen point each) and ``c0`` (the wide seeds); ``mult`` names a multiplicity."""
    ctes = []
    for r in range(k):
        u = hash_uniform_sql(key, seed, f"kmeanspp:{r}")
        if r == 0:
            w = "1.0::DOUBLE"
            src = pts
        else:
            ds = [dist(x, y, f"s{j}.sx{j}", f"s{j}.sy{j}") for j in range(r)]
            w = ds[0] if r == 1 else f"least({', '.join(ds)})"
            src = f"{pts}, " + ", ".join(f"s{j}" for j in range(r))
        if mult:
            w = f"({w}) * {pts}.{mult}::DOUBLE"
        body = (f"SELECT {x} AS sx{r}, {y} AS sy{r} FROM ("
                f"SELECT {key}, {x}, {y}, CASE WHEN _w > 0 THEN -ln({u}) / _w END AS _key FROM ("
                f"SELECT {pts}.{key}, {pts}.{x}, {pts}.{y}, {w} AS _w FROM {src})) "
                f"WHERE _key IS NOT NULL ORDER BY _key, {key} LIMIT 1")
        ctes.append((f"s{r}", body))
    seeds = "SELECT " + ", ".join(f"sx{i} AS x{i}, sy{i} AS y{i}" for i in range(k)) + " FROM " + \
        ", ".join(f"s{i}" for i in range(k))
    ctes.append(("c0", seeds))
    return ctes


def lloyd_ctes(pts: str, k: int, iters: int, first: str = "c0", x: str = X, y: str = Y) -> list[tuple[str, str]]:
    """``a_t`` (assignment), ``g_t`` (per-cluster sums) and ``c_{t+1}`` for t < iters."""
    ctes = []
    for t in range(iters):
        cur = first if t == 0 else f"c{t}"
        prev = None if t == 0 else (first if t == 1 else f"c{t - 1}")
        ctes.append((f"a{t}", assign(pts, k, cur, prev, x, y)))
        ctes.append((f"g{t}", group_step(f"a{t}", t == 0, x, y)))
        ctes.append((f"c{t + 1}", update(f"g{t}", cur, k)))
    return ctes


def with_clause(ctes: list[tuple[str, str]]) -> str:
    return "WITH RECURSIVE " + ",\n".join(f"{name} AS ({body})" for name, body in ctes)


def lloyd_recursive(pts: str, k: int, first: str = "c0", max_iter: int = 100, x: str = X, y: str = Y) -> list[tuple[str, str]]:
    """CTEs ``lloyd`` (one row a pass, until no point moves or ``max_iter`` passes ran) and ``last`` (the
    final centres, wide). A row holds the centres after ``it`` passes and the pass's moved count, WCSS
    before and after the update; row 0 the starting centres."""
    ids = range(k)
    dist_cols = [f"{dist('p.' + x, 'p.' + y, f's.x{i}', f's.y{i}')} AS d{i}" for i in ids]
    prev_cols = [f"{dist('p.' + x, 'p.' + y, f's.px{i}', f's.py{i}')} AS e{i}" for i in ids]

    def nearest(d: str) -> str:
        least = f"least({', '.join(f'{d}{i}' for i in ids)})"
        return "CASE " + " ".join(f"WHEN {d}{i} = {least} THEN {i}" for i in ids[:-1]) + f" ELSE {k - 1} END"

    state = [f"{c}{i}" for i in ids for c in "xy"]
    seed = ", ".join([*state, *(f"{c}{i} AS p{c}{i}" for i in ids for c in "xy")])
    per = ", ".join(
        f"sum(CASE WHEN k = {i} THEN {micro(x)} END) AS sx{i}, sum(CASE WHEN k = {i} THEN {micro(y)} END) AS sy{i}, "
        f"count(CASE WHEN k = {i} THEN 1 END) AS n{i}, sum(CASE WHEN k = {i} THEN d END) AS sse{i}" for i in ids)
    means = ", ".join(f"coalesce(s{c}{i}::DOUBLE / n{i}::DOUBLE / 1000000.0::DOUBLE, {c}{i}) AS n{c}{i}" for i in ids for c in "xy")
    gain = " + ".join(f"coalesce(sse{i}, 0.0::DOUBLE) - n{i}::DOUBLE * ((x{i} - nx{i}) * (x{i} - nx{i}) + (y{i} - ny{i}) * (y{i} - ny{i}))"
                      for i in ids)
    flat = ", ".join(state)
    body = f"""
SELECT 0 AS it, {seed}, -1::BIGINT AS n_moved, NULL::DOUBLE AS wcss, NULL::DOUBLE AS wcss_after FROM {first}
UNION ALL
SELECT it + 1, {', '.join(f'n{c}{i}' for i in ids for c in 'xy')}, {flat}, moved, total, {gain} FROM (
 SELECT *, {means} FROM (
  SELECT it, {flat}, {per}, CAST(sum(CASE WHEN it = 0 OR k <> kp THEN 1 ELSE 0 END) AS BIGINT) AS moved, sum(d) AS total FROM (
   SELECT *, {nearest('d')} AS k, {nearest('e')} AS kp, least({', '.join(f'd{i}' for i in ids)}) AS d FROM (
    SELECT p.{x}, p.{y}, s.*, {', '.join(dist_cols + prev_cols)} FROM {pts} AS p, lloyd AS s
    WHERE s.it < {max_iter} AND s.n_moved <> 0))
  GROUP BY it, {flat}))"""
    last = f"SELECT {flat} FROM lloyd ORDER BY it DESC LIMIT 1"
    return [("lloyd", body), ("last", last)]


def history_select(digits: int = 4) -> str:
    """Per-pass ``iteration, n_moved, wcss, wcss_after`` of a ``lloyd`` CTE."""
    from centroidal.functions.numeric import round_half_up_sql
    return (f"SELECT CAST(it - 1 AS INTEGER) AS iteration, n_moved, {round_half_up_sql('wcss', digits)} AS wcss, "
            f"{round_half_up_sql('wcss_after', digits)} AS wcss_after FROM lloyd WHERE it > 0")
