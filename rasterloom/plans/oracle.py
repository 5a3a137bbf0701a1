"""SQL for the raster queries, in DuckDB's dialect, written from the definitions."""

from __future__ import annotations

RAW = """v AS (SELECT vec_id::INT AS y, embedding AS e FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
raw AS (SELECT y, i::INT AS x, e[i + 1]::DOUBLE AS r, e[(i + 1) % len(e) + 1]::DOUBLE AS g, e[(i + 2) % len(e) + 1]::DOUBLE AS b FROM v, unnest(range(len(e))) u(i)),
pc AS (SELECT quantile_cont(r, [0.01, 0.99]) AS r, quantile_cont(g, [0.01, 0.99]) AS g, quantile_cont(b, [0.01, 0.99]) AS b FROM raw)"""
U8 = "trunc(255 * least(greatest((raw.{c} - pc.{c}[1]) / (pc.{c}[2] - pc.{c}[1] + 1e-8), 0), 1))::INT AS {c}"
PX = f"""{RAW},
px AS (SELECT y, x, {U8.format(c='r')}, {U8.format(c='g')}, {U8.format(c='b')} FROM raw, pc),
dim AS (SELECT max(y) + 1 AS h, max(x) + 1 AS w FROM px)"""
BOUNDS = (0.6123457, 0.5123457)  # of the scorer that labels arriving tiles
HSV = "greatest(r, g, b) / 255.0 AS val, CASE WHEN greatest(r, g, b) > 0 THEN (greatest(r, g, b) - least(r, g, b)) / greatest(r, g, b)::DOUBLE ELSE 0 END AS sat"
BIN = "((r * 299 + g * 587 + b * 114) // 1000) >> 4"
OD = "0 - log10(least(greatest({c}::DOUBLE, 1), {io}) / {io})"


def _axis(name: str, source: str, size: str, tile: int, overlap: int, close: bool) -> str:
    """CTEs ``<name>(size, o, i, n, skip, keep, last)``: the tiles along an axis of each size."""
    stride, half = tile - overlap, overlap // 2
    kept = f"CASE WHEN len(l) >= 2 AND s - l[len(l)] < {overlap} THEN l[1:len(l) - 1] ELSE l END" if close else "l"
    long = f"CASE WHEN i = k - 1 THEN s - o ELSE least({tile}, s - o) END" if close else f"least({tile}, s - o)"
    return f"""{name}0 AS (SELECT s, {kept} AS l FROM (SELECT DISTINCT {size} AS s, range(0, {size}, {stride}) AS l FROM {source})),
{name}1 AS (SELECT s, unnest(l) AS o, unnest(range(len(l))) AS i, len(l) AS k FROM {name}0),
{name}2 AS (SELECT s, o, i, i = k - 1 AS last, {long} AS n, CASE WHEN i = 0 THEN 0 ELSE {half} END AS skip FROM {name}1),
{name} AS (SELECT s AS size, o, i, n, skip, n - skip - CASE WHEN last THEN 0 ELSE least({overlap - half}, n - skip - 1) END AS keep, last FROM {name}2)"""


def _grid(pairs: str, height: str, width: str, tile: int, overlap: int, close: bool = True) -> str:
    """CTE ``tiles``: a row a tile of images ``pairs(h, w)``."""
    return f"""{_axis('ay', pairs, height, tile, overlap, close)}, {_axis('ax', pairs, width, tile, overlap, close)},
tiles AS (SELECT img.h, img.w, a.i AS ri, c.i AS ci, a.o AS oy0, c.o AS ox0, a.n AS oh, c.n AS ow, a.skip AS keep_y0, c.skip AS keep_x0, a.keep AS keep_h, c.keep AS keep_w
    FROM {pairs} img JOIN ay a ON a.size = img.h JOIN ax c ON c.size = img.w)"""


def _entropy(source: str = "px") -> str:
    """CTE ``ent(y, x, entropy)`` by looking at all 81 neighbours."""
    return f"""bins AS MATERIALIZED (SELECT y, x, {BIN} AS bin FROM {source}),
around AS MATERIALIZED (SELECT c.y, c.x, least(greatest(c.y + dy, 0), h - 1) AS ny, least(greatest(c.x + dx, 0), w - 1) AS nx FROM bins c, dim, range(-4, 5) a(dy), range(-4, 5) d(dx)),
hits AS (SELECT o.y, o.x, n.bin, count(*) AS k FROM around o JOIN bins n ON n.y = o.ny AND n.x = o.nx GROUP BY o.y, o.x, n.bin),
ent AS MATERIALIZED (SELECT y, x, -sum(k / 81.0 * log2(k / 81.0)) AS entropy FROM hits GROUP BY y, x)"""


def _discs(height: int, width: int) -> str:
    """CTE ``px`` of the formulas' raster."""
    dist, radius = "((y % 24 - 12) * (y % 24 - 12) + (x % 24 - 12) * (x % 24 - 12))", "(4 + ((y // 24) * 7 + (x // 24) * 5) % 9)"
    hit = f"{dist} <= {radius} * {radius}"
    return f"""spots AS (SELECT (id // {width})::INT AS y, (id % {width})::INT AS x FROM range({height * width}) t(id)),
px AS (SELECT y, x, CASE WHEN {hit} THEN 250 ELSE 150 + (y * 7 + x * 13) % 40 END AS r, CASE WHEN {hit} THEN 248 ELSE 90 + (y * 5 + x * 3) % 50 END AS g,
    CASE WHEN {hit} THEN 249 ELSE 140 + (y * 11 + x) % 60 END AS b FROM spots),
dim AS (SELECT {height} AS h, {width} AS w)"""


def _parts(source: str) -> str:
    """CTE ``parts(y, x, part)`` of the pixels of ``source(y, x)``: the smallest pixel within reach, by side."""
    return f"""dots AS MATERIALIZED (SELECT y, x, y * 100000 + x AS id FROM {source}),
near AS MATERIALIZED (SELECT a.id AS a, b.id AS b FROM dots a JOIN dots b ON b.id IN (a.id + 1, a.id - 1, a.id + 100000, a.id - 100000)),
reach(id, r) AS (SELECT id, id FROM dots UNION SELECT reach.id, near.b FROM reach JOIN near ON near.a = reach.r),
parts AS (SELECT dots.y, dots.x, min(r) AS part FROM reach JOIN dots USING (id) GROUP BY dots.y, dots.x)"""


_MASK = f"{PX},\nm AS (SELECT y, x, NOT (val > 0.55 AND sat < 0.5) AS tissue FROM (SELECT y, x, {HSV} FROM px))"
_GATED = f"""{_MASK}, img AS (SELECT h * 4 AS h, w * 4 AS w FROM dim), {_grid('img', 'h', 'w', 64, 16)},
span AS (SELECT *, oy0 * th // h AS y0, least(th, (oy0 + oh) * th // h + 1) AS y1, ox0 * tw // w AS x0, least(tw, (ox0 + ow) * tw // w + 1) AS x1
    FROM tiles, (SELECT h AS th, w AS tw FROM dim)),
gated AS (SELECT ri, ci, oy0, ox0, count(m.y) AS n_px, coalesce(sum(m.tissue::INT), 0)::BIGINT AS n_tissue, coalesce(avg(m.tissue::INT), 0) >= 0.65 AS tissue
    FROM span LEFT JOIN m ON m.y >= y0 AND m.y < y1 AND m.x >= x0 AND m.x < x1 GROUP BY ri, ci, oy0, ox0)"""


_RUNS = """runs AS MATERIALIZED (SELECT y, white, min(x) AS x0, max(x) + 1 AS x1
    FROM (SELECT y, x, white, x - row_number() OVER (PARTITION BY y, white ORDER BY x) AS k FROM (SELECT y, x, NOT tissue AS white FROM m)) GROUP BY y, white, k)"""


def _whites(bright: float, pale: float, even: float, base: float, base_pale: float) -> str:
    """CTE ``chosen(y, x, entropy_white, base_white, white)``."""
    return f"""{_entropy()},
flags AS (SELECT y, x, val, val > {bright} AND sat < {pale} AND round(entropy, 6) < {even} AS entropy_white, val > {base} AND sat < {base_pale} AS base_white
    FROM (SELECT y, x, {HSV} FROM px) JOIN ent USING (y, x)),
share AS (SELECT avg(entropy_white::INT) AS fe, avg(base_white::INT) AS fb FROM flags),
chosen AS (SELECT y, x, entropy_white, base_white, CASE WHEN fe < 0.01 OR fe > 0.9 OR fe > 1.8 * fb + 1e-6 THEN base_white ELSE entropy_white OR (base_white AND val > 0.94) END AS white
    FROM flags, share)"""


def _linear(n_in: str, n_out: str, name: str) -> str:
    return f"""{name}a AS (SELECT o, CASE WHEN n_out > 1 THEN o * (n_in - 1) / (n_out - 1)::DOUBLE ELSE 0 END AS spot, n_in FROM (SELECT {n_in} AS n_in, {n_out} AS n_out FROM dim), unnest(range(n_out)) t(o)),
{name} AS (SELECT o, floor(spot)::INT AS src, 1 - (spot - floor(spot)) AS w FROM {name}a UNION ALL SELECT o, least(floor(spot)::INT + 1, n_in - 1), spot - floor(spot) FROM {name}a)"""


def _lanczos(n_in: str, n_out: str, name: str) -> str:
    sinc = "CASE WHEN abs({z}) < 1e-12 THEN 1 ELSE sin(pi() * ({z})) / (pi() * ({z})) END"
    return f"""{name}a AS (SELECT o, n_in, greatest(1, n_in / n_out::DOUBLE) AS scale, (o + 0.5) * n_in / n_out::DOUBLE - 0.5 AS c FROM (SELECT {n_in} AS n_in, {n_out} AS n_out FROM dim), unnest(range(n_out)) t(o)),
{name}b AS (SELECT o, n_in, (i - c) / scale AS t, i FROM {name}a, unnest(range(ceil(c - 3 * scale)::BIGINT, floor(c + 3 * scale)::BIGINT + 1)) u(i)),
{name}c AS (SELECT o, least(greatest(i, 0), n_in - 1) AS src, {sinc.format(z='t')} * {sinc.format(z='t / 3')} AS w FROM {name}b),
{name} AS (SELECT o, src, w / sum(w) OVER (PARTITION BY o) AS w FROM {name}c)"""


def _windows(size: str, name: str) -> str:
    """CTE ``<name>(s)``: where windows of 32 pixels with a quarter of overlap start."""
    return f"{name} AS (SELECT DISTINCT greatest(0, least(i * 24, {size} - 32))::INT AS s FROM dim, unnest(range(CASE WHEN {size} <= 32 THEN 1 ELSE ceil(({size} - 32) / 24.0)::BIGINT + 1 END)) t(i))"


def _gauss() -> str:
    return "greatest(exp(-((y - wy - 15.5) * (y - wy - 15.5) + (x - wx - 15.5) * (x - wx - 15.5)) / 32.0), 1e-3)"


def _stain_estimate(io: str) -> str:
    """Each step of the stain parameters as a CTE of one row; eigenvalues by the cosine of a third of an angle."""
    dot = "({a}1 * {b}1 + {a}2 * {b}2 + {a}3 * {b}3)"
    cross = "{a}2 * {b}3 - {a}3 * {b}2 AS {o}1, {a}3 * {b}1 - {a}1 * {b}3 AS {o}2, {a}1 * {b}2 - {a}2 * {b}1 AS {o}3"
    scaled = lambda v, o: ", ".join(f"{v}{i} / sqrt({dot.format(a=v, b=v)}) AS {o}{i}" for i in (1, 2, 3))
    signed = lambda v, o: ", ".join(f"{v}{i} * CASE WHEN {v}1 + {v}2 + {v}3 < 0 THEN -1 ELSE 1 END AS {o}{i}" for i in (1, 2, 3))
    rows = lambda e: f"c00 - {e} AS p1, c01 AS p2, c02 AS p3, c01 AS q1, c11 - {e} AS q2, c12 AS q3, c02 AS s1, c12 AS s2, c22 - {e} AS s3"
    kernel = lambda e, o: f"""{o}_rows AS (SELECT {rows(e)} FROM eig),
{o}_all AS (SELECT {cross.format(a='p', b='q', o='v')} FROM {o}_rows UNION ALL SELECT {cross.format(a='p', b='s', o='v')} FROM {o}_rows UNION ALL SELECT {cross.format(a='q', b='s', o='v')} FROM {o}_rows),
{o} AS (SELECT {scaled('v', o)} FROM {o}_all ORDER BY {dot.format(a='v', b='v')} DESC LIMIT 1)"""  # noqa: E731
    like = lambda w, dye: f"abs({' + '.join(f'{w}{i} * {c}' for i, c in zip((1, 2, 3), dye))})"
    best = lambda dye: f"CASE WHEN {like('h', dye)} >= {like('e', dye)} AND {like('h', dye)} >= {like('n', dye)} THEN 0 WHEN {like('e', dye)} >= {like('n', dye)} THEN 1 ELSE 2 END"
    inverse = lambda k: f"CASE {k} WHEN 0 THEN {dot.format(a='i', b='d')} / hi WHEN 1 THEN {dot.format(a='j', b='d')} / ej ELSE {dot.format(a='n', b='d')} END"
    named = "d0 AS d1, d1 AS d2, d2 AS d3"
    ends = ", ".join(f"CASE WHEN {c}_hi <= {c}_lo + 1e-8 THEN {v} ELSE round({c}_{n}, 6) END AS {c}_{n}" for c in ("e", "h") for n, v in (("lo", 0.0), ("hi", 1.0)))
    return f"""WITH {PX}, flags AS MATERIALIZED (SELECT *, val > 0.55 AND sat < 0.5 AS bg FROM (SELECT *, {HSV} FROM px)), light AS (SELECT ({io})::DOUBLE AS io FROM flags),
den AS MATERIALIZED (SELECT bg, {", ".join(f"{OD.format(c=c, io='io')} AS d{i}" for i, c in enumerate('rgb'))} FROM flags, light),
dense AS (SELECT {named} FROM den WHERE NOT bg AND least(d0, d1, d2) >= 0.15),
m AS (SELECT {", ".join(f"covar_pop(d{i + 1}, d{j + 1}) AS c{i}{j}" for i in range(3) for j in range(i, 3))} FROM dense),
m1 AS (SELECT *, (c00 + c11 + c22) / 3 AS mean FROM m),
m2 AS (SELECT *, c00 - mean AS x, c11 - mean AS y, c22 - mean AS z, sqrt(((c00 - mean) ** 2 + (c11 - mean) ** 2 + (c22 - mean) ** 2 + 2 * (c01 ** 2 + c02 ** 2 + c12 ** 2)) / 6) AS spread FROM m1),
m3 AS (SELECT *, acos(greatest(-1, least(1, (x * (y * z - c12 * c12) - c01 * (c01 * z - c12 * c02) + c02 * (c01 * c12 - y * c02)) / spread ** 3 / 2))) / 3 AS angle FROM m2),
eig AS MATERIALIZED (SELECT *, mean + 2 * spread * cos(angle) AS top, mean + 2 * spread * cos(angle + 2 * pi() / 3) AS low FROM m3),
{kernel('top', 't')}, {kernel('low', 'l')},
a AS (SELECT {signed('t', 'a')}, {cross.format(a='l', b='t', o='b')} FROM t, l), ab AS MATERIALIZED (SELECT a1, a2, a3, {signed('b', 'b')} FROM a),
q AS (SELECT quantile_cont(w, 0.01) AS w0, quantile_cont(w, 0.99) AS w1 FROM (SELECT atan2({dot.format(a='b', b='d')}, {dot.format(a='a', b='d')}) AS w FROM dense, ab)),
uv0 AS (SELECT {", ".join(f"cos({w}) * a{i} + sin({w}) * b{i} AS {o}{i}" for w, o in (("w0", "u"), ("w1", "v")) for i in (1, 2, 3))} FROM q, ab),
uv1 AS (SELECT {scaled('u', 'u')}, {scaled('v', 'v')} FROM uv0), uv AS (SELECT {signed('u', 'u')}, {signed('v', 'v')} FROM uv1),
he AS (SELECT {", ".join(f"CASE WHEN u1 < v1 THEN {y}{i} ELSE {x}{i} END AS {o}{i}" for o, x, y in (("h", "u", "v"), ("e", "v", "u")) for i in (1, 2, 3))} FROM uv),
hen0 AS (SELECT *, {cross.format(a='h', b='e', o='m')} FROM he), hen AS (SELECT *, {scaled('m', 'n')} FROM hen0),
w0 AS (SELECT *, {cross.format(a='e', b='n', o='i')}, {cross.format(a='n', b='h', o='j')}, {best((0.07, 0.99, 0.11))} AS ke, {best((0.65, 0.70, 0.29))} AS kh FROM hen),
w AS MATERIALIZED (SELECT *, {dot.format(a='h', b='i')} AS hi, {dot.format(a='e', b='j')} AS ej, ke = kh OR ke = 2 OR kh = 2 AS unclear FROM w0),
k AS MATERIALIZED (SELECT *, CASE WHEN unclear THEN 1 ELSE ke END AS e_idx, CASE WHEN unclear THEN 0 ELSE kh END AS h_idx FROM w),
sep AS (SELECT {inverse('e_idx')} AS e, {inverse('h_idx')} AS h, (d1 + d2 + d3) / 3 AS od FROM (SELECT {named} FROM den), k),
r AS (SELECT {", ".join(f"quantile_cont({c}, 0.01) AS {c}_lo, quantile_cont({c}, 0.99) AS {c}_hi" for c in ("e", "h", "od"))} FROM sep)
SELECT round(io, 6) AS io, {", ".join(f"round({c}{i + 1}, 6) AS w{i}{j}" for i in range(3) for j, c in enumerate("hen"))}, e_idx::INT AS e_idx, h_idx::INT AS h_idx,
    {ends}, round(od_lo, 6) AS od_lo, round(od_hi, 6) AS od_hi FROM light, k, r"""


def sql(dims: tuple[int, ...], discs: tuple[int, int], inverse, light: float) -> dict[str, str]:
    img = "img AS (SELECT h, {w} AS w FROM (VALUES " + ", ".join(f"({d})" for d in dims) + ") t(h))"
    dims_1d = "d AS (SELECT dim FROM (VALUES " + ", ".join(f"({d})" for d in dims) + ") t(dim))"
    cells = "h::INT AS h, ri::INT AS ri, ci::INT AS ci, oy0::INT AS oy0, ox0::INT AS ox0, oh::INT AS oh, ow::INT AS ow, keep_y0::INT AS keep_y0, keep_x0::INT AS keep_x0, keep_h::INT AS keep_h, keep_w::INT AS keep_w"
    od = {c: OD.format(c=c, io=f"{light}::DOUBLE") for c in "rgb"}
    dense = f"{PX},\nden AS (SELECT y, x, r, g, b, {od['r']} AS d0, {od['g']} AS d1, {od['b']} AS d2 FROM px)"
    dot = ["d0 * {} + d1 * {} + d2 * {}".format(*(f"({v})" for v in row)) for row in inverse]
    sep = f"{dense},\nsep AS (SELECT y, x, {dot[0]} AS e, {dot[1]} AS h, (d0 + d1 + d2) / 3 AS od FROM den)"
    pct = ", ".join(f"quantile_cont({c}, 0.01) AS {c}_lo, quantile_cont({c}, 0.99) AS {c}_hi" for c in ("e", "h", "od"))
    inverted = ", ".join(f"trunc(255 - 255 * least(greatest(({c} - {c}_lo) / ({c}_hi - {c}_lo + 1e-8), 0), 1))::INT AS {c}" for c in ("e", "h", "od"))
    label = "CASE WHEN p0 > 0.5 AND p0 > p2 THEN 1 WHEN p1 > 0.5 AND p1 > p2 THEN 2 ELSE 0 END::INT"
    probs = "SELECT vec_id, 1 / (1 + exp(-embedding[1]::DOUBLE)) AS p0, 1 / (1 + exp(-embedding[2]::DOUBLE)) AS p1, 1 / (1 + exp(-embedding[3]::DOUBLE)) AS p2 FROM embeddings"
    io = """CASE WHEN count(*) FILTER (bg AND NOT (r = 255 AND g = 255 AND b = 255)) >= 100 THEN least(greatest(avg((r + g + b) / 3.0) FILTER (bg AND NOT (r = 255 AND g = 255 AND b = 255)), 200), 255)
    WHEN count(*) FILTER (bg) >= 100 THEN least(greatest(avg((r + g + b) / 3.0) FILTER (bg), 200), 255) ELSE 240 END"""
    norm1 = ", ".join(f"CASE WHEN {c} <> 0 THEN ({c} / 255.0 - (avg({c} / 255.0) FILTER ({c} <> 0) OVER ())) / coalesce(nullif(stddev_pop({c} / 255.0) FILTER ({c} <> 0) OVER (), 0), 1) ELSE 0 END AS {c}" for c in "rgb")
    norm2 = ", ".join(f"round(CASE WHEN max({c}) OVER () > min({c}) OVER () THEN ({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()) ELSE 0 END, 6) AS {c}" for c in "rgb")
    sums = ", ".join(f"round(sum({c} * ty.w * tx.w), 6) AS {c}" for c in "rgb")
    fold = "CASE WHEN {p} % {q} < {n} THEN {p} % {q} ELSE {q} - {p} % {q} END"
    levels = "lv AS (SELECT p_brand AS slide_id, (row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1)::INT AS level_idx, p_size * 100 AS size_x, p_partkey % 3000 AS size_y, p_retailprice / 100 AS m FROM part)"
    line = "user_id || CASE WHEN event_id % 3 = 1 THEN '' ELSE ' , ' || event_id END || ',' || CASE WHEN event_id % 5 = 2 THEN 'n/a' ELSE ' ' || event_id % 97 END"
    ok = "len(p) >= 3 AND v[1] IS NOT NULL AND v[2] IS NOT NULL AND v[3] IS NOT NULL"
    metric = "SELECT event_type, '{m}' AS metric, min({m})::DOUBLE AS min, round(avg({m}), 6) AS avg, median({m}) AS median, max({m})::DOUBLE AS max FROM events GROUP BY event_type"
    rest = "CASE WHEN contains(u, '://') THEN regexp_replace(u, '^[^:]*://', '') ELSE u END"
    moments = ", ".join([f"round(avg(d{i}), 8) AS m{i}" for i in range(3)] + [f"round(covar_pop(d{i}, d{j}), 8) AS c{i}{j}" for i in range(3) for j in range(i, 3)])
    white_discs = "val > 0.83 AND sat < 0.12"
    return {
        "tile_grid": f"WITH {img.format(w='h')}, {_grid('img', 'h', 'w', 2048, 128)} SELECT {cells} FROM tiles",
        "tile_keep_regions": f"WITH {img.format(w='2500')}, {_grid('img', 'h', 'w', 2048, 128, False)} SELECT {cells} FROM tiles",
        "tile_cover_gaps": f"WITH {dims_1d}, {_axis('a', 'd', 'dim', 2048, 128, False)}, {_axis('c', 'd', 'dim', 2048, 128, True)}, "
        "o AS (SELECT size, count(*) AS tiles_open, size - sum(greatest(keep, 0)) AS gap_open FROM a GROUP BY size), p AS (SELECT size, count(*) AS tiles, size - sum(greatest(keep, 0)) AS gap FROM c GROUP BY size) "
        "SELECT size::INT AS dim, tiles_open::INT AS tiles_open, gap_open::INT AS gap_open, tiles::INT AS tiles, gap::INT AS gap FROM o JOIN p USING (size)",
        "u8_stretch": f"WITH {PX} SELECT y, x, r, g, b FROM px",
        "gray_bins": f"WITH {PX} SELECT y, x, trunc(r * 0.2989 + g * 0.5870 + b * 0.1140 + 1e-9)::INT AS gray, ({BIN})::INT AS level FROM px",
        "white_base": f"WITH {PX} SELECT y, x, round(val, 6) AS brightness, round(sat, 6) AS saturation, val > 0.83 AND sat < 0.12 AS base_white, r = 255 AND g = 255 AND b = 255 AS pure_white FROM (SELECT *, {HSV} FROM px)",
        "local_entropy": f"WITH {PX}, {_entropy()} SELECT y, x, round(entropy, 6) AS entropy FROM ent",
        "white_rule": f"WITH {PX}, {_whites(0.6, 0.45, 2.95, 0.6, 0.4)} SELECT y, x, entropy_white, base_white, white FROM chosen",
        "tissue_tiles": f"WITH {_GATED} SELECT ri::INT AS ri, ci::INT AS ci, n_px, n_tissue FROM gated WHERE tissue ORDER BY ri, ci",
        "tile_counters": f"WITH {_GATED} SELECT count(*) AS tiles_total, count(*) FILTER (tissue) AS tiles_kept, round(100.0::DOUBLE * count(*) FILTER (NOT tissue) / count(*), 6) AS skipped_percent FROM gated",
        "bg_tile_pick": f"WITH {_GATED}, bg AS (SELECT *, row_number() OVER (ORDER BY ri, ci) - 1 AS p, count(*) OVER () AS n FROM gated WHERE NOT tissue) "
        "SELECT ri::INT AS ri, ci::INT AS ci, oy0::INT AS oy0, ox0::INT AS ox0 FROM bg WHERE p % greatest(1, n // 4) = 0 AND p // greatest(1, n // 4) < 4",
        "components_sizes": f"WITH RECURSIVE {_discs(*discs)}, wh AS (SELECT y, x FROM (SELECT y, x, {HSV} FROM px) WHERE {white_discs}), {_parts('wh')} "
        "SELECT (part // 100000)::INT AS part_y, (part % 100000)::INT AS part_x, count(*) AS area FROM parts GROUP BY part",
        "white_runs": f"WITH {_MASK}, {_RUNS} SELECT y, x0, x1, white FROM runs",
        "white_regions": f"WITH RECURSIVE {_MASK}, {_RUNS}, {_parts('(SELECT y, x FROM m WHERE NOT tissue)')} SELECT (part // 100000)::INT AS part_y, (part % 100000)::INT AS part_x, "
        "count(*) FILTER (NOT EXISTS (SELECT 1 FROM dots d WHERE d.id = parts.y * 100000 + parts.x - 1)) AS n_runs, max(y) AS last_y, count(*) AS area FROM parts GROUP BY part",
        "background_mask": f"WITH RECURSIVE {_discs(*discs)}, {_whites(0.82, 0.25, 2.4, 0.83, 0.12)}, wh AS (SELECT y, x FROM chosen WHERE white), {_parts('wh')}, "
        "big AS (SELECT part FROM parts GROUP BY part HAVING count(*) >= 128), bgp AS (SELECT y, x FROM parts JOIN big USING (part)) "
        "SELECT px.y, px.x, bgp.y IS NOT NULL AS background FROM px LEFT JOIN bgp ON bgp.y = px.y AND bgp.x = px.x",
        "background_blocks": f"WITH RECURSIVE {PX}, {_whites(0.6, 0.45, 2.95, 0.6, 0.4)}, wh AS (SELECT y, x FROM chosen WHERE white), {_parts('wh')}, "
        "big AS (SELECT part FROM parts GROUP BY part HAVING count(*) >= 3), bgp AS (SELECT y, x FROM parts JOIN big USING (part)) "
        "SELECT px.y, px.x, bgp.y IS NOT NULL AS background FROM px LEFT JOIN bgp ON bgp.y = px.y AND bgp.x = px.x",
        "background_intensity": f"WITH {PX}, {_discs(*discs).replace('px AS', 'dpx AS').replace('dim AS', 'ddim AS')}, "
        f"both_px AS (SELECT 'embeddings' AS slide_id, r, g, b, val > 0.55 AND sat < 0.5 AS bg FROM (SELECT *, {HSV} FROM px) UNION ALL SELECT 'discs', r, g, b, {white_discs} FROM (SELECT *, {HSV} FROM dpx)) "
        f"SELECT slide_id, round(({io})::DOUBLE, 6) AS io FROM both_px GROUP BY slide_id",
        "optical_density": f"WITH {dense} SELECT y, x, round(d0, 6) AS od_r, round(d1, 6) AS od_g, round(d2, 6) AS od_b, round((d0 + d1 + d2) / 3, 6) AS od FROM den",
        "concentration": f"WITH {sep} SELECT y, x, round(e, 6) AS e, round(h, 6) AS h FROM sep",
        "stain_percentiles": f"WITH {sep}, q AS (SELECT {pct} FROM sep) SELECT " + ", ".join(f"round({c}_{n}, 6) AS {c}_{n}" for c in ("e", "h", "od") for n in ("lo", "hi")) + " FROM q",
        "eho_pixels": f"WITH {sep}, q AS (SELECT {pct} FROM sep) SELECT y, x, {inverted} FROM sep, q",
        "masked_normalize": f"WITH {PX}, s AS (SELECT y, x, {norm1} FROM px) SELECT y, x, {norm2} FROM s",
        "od_covariance": f"WITH {dense}, k AS (SELECT * FROM (SELECT *, {HSV} FROM den) WHERE NOT (val > 0.55 AND sat < 0.5)) SELECT count(*) AS n, {moments} FROM k",
        "stain_estimate": _stain_estimate(io),
        "label_rule": f"SELECT vec_id, {label} AS label FROM ({probs})",
        "label_distinct": f"SELECT DISTINCT {label} AS label FROM ({probs}) ORDER BY label",
        "nearest_resize": f"WITH {PX}, o AS (SELECT oy, ox, h, w, h * 3 // 7 AS oh FROM dim, unnest(range(h * 3 // 7)) a(oy), unnest(range(100)) c(ox)) "
        "SELECT oy::INT AS y, ox::INT AS x, r, g, b FROM o JOIN px ON px.y = oy * h // oh AND px.x = ox * w // 100",
        "linear_resize": f"WITH {PX}, {_linear('h', 'h * 3 // 7', 'ty')}, {_linear('w', '100', 'tx')} SELECT ty.o::INT AS y, tx.o::INT AS x, {sums} FROM px JOIN ty ON ty.src = px.y JOIN tx ON tx.src = px.x GROUP BY ty.o, tx.o",
        "lanczos_resize": f"WITH {PX}, {_lanczos('h', 'h * 3 // 7', 'ty')}, {_lanczos('w', '100', 'tx')} SELECT ty.o::INT AS y, tx.o::INT AS x, round(sum(r * ty.w * tx.w), 6) AS r FROM px JOIN ty ON ty.src = px.y JOIN tx ON tx.src = px.x GROUP BY ty.o, tx.o",
        "reflect_pad": f"WITH {PX}, s AS (SELECT h, w, ((-h % 96) + 96) % 96 AS ph, ((-w % 96) + 96) % 96 AS pw FROM dim), "
        "o AS (SELECT oy - ph // 2 AS y, ox - pw // 2 AS x, h, w, 2 * (h - 1) AS qy, 2 * (w - 1) AS qx FROM s, unnest(range(h + ph)) a(oy), unnest(range(w + pw)) c(ox)), "
        f"f AS (SELECT y, x, {fold.format(p='((y + 10 * qy))', q='qy', n='h')} AS sy, {fold.format(p='((x + 10 * qx))', q='qx', n='w')} AS sx FROM o) SELECT f.y::INT AS y, f.x::INT AS x, px.r FROM f JOIN px ON px.y = sy AND px.x = sx",
        "window_blend": f"WITH {PX}, {_windows('h', 'wys')}, {_windows('w', 'wxs')}, c AS (SELECT y, x, r / 255.0 + wxs.s / 67.0 - wys.s / 509.0 AS z, wys.s AS wy, wxs.s AS wx FROM px JOIN wys ON y >= wys.s AND y < wys.s + 32 JOIN wxs ON x >= wxs.s AND x < wxs.s + 32) "
        f"SELECT y, x, round((sum(z * {_gauss()}) / sum({_gauss()}))::DOUBLE, 6) AS z FROM c GROUP BY y, x",
        "stitch_keep": f"WITH {PX}, {_grid('dim', 'h', 'w', 16, 4)}, k AS (SELECT y, x, (r + ri * 3 + ci) % 3 AS label FROM px JOIN tiles ON y >= oy0 + keep_y0 AND y < oy0 + keep_y0 + keep_h AND x >= ox0 + keep_x0 AND x < ox0 + keep_x0 + keep_w WHERE (ri + ci) % 5 <> 3) "
        "SELECT px.y, px.x, coalesce(k.label, 0)::INT AS label FROM px LEFT JOIN k ON k.y = px.y AND k.x = px.x",
        "arriving_labels": f"WITH {PX}, {_grid('dim', 'h', 'w', 16, 4)}, t AS (SELECT px.*, tiles.* EXCLUDE (h, w) FROM px JOIN tiles ON y >= oy0 AND y < oy0 + oh AND x >= ox0 AND x < ox0 + ow), "
        f"s AS (SELECT * EXCLUDE (r, g, b), {norm1.replace('OVER ()', 'OVER (PARTITION BY ri, ci)')} FROM t), n AS (SELECT * EXCLUDE (r, g, b), {norm2.replace('OVER ()', 'OVER (PARTITION BY ri, ci)')} FROM s) "
        f"SELECT y, x, (CASE WHEN r > {BOUNDS[0]} THEN 1 WHEN g > {BOUNDS[1]} THEN 2 ELSE 0 END)::INT AS label FROM n WHERE y >= oy0 + keep_y0 AND y < oy0 + keep_y0 + keep_h AND x >= ox0 + keep_x0 AND x < ox0 + keep_x0 + keep_w",
        "pyramid_level": f"WITH {levels}, b AS (SELECT slide_id, count(*) AS n, max(m) FILTER (m <= 12) AS best, max(m) FILTER (level_idx = 0) AS m0 FROM lv GROUP BY slide_id), "
        "c AS (SELECT b.*, coalesce((SELECT min(level_idx) FROM lv WHERE lv.slide_id = b.slide_id AND m = best), 0) AS idx FROM b) SELECT slide_id, idx::INT AS level_idx, (n - 1 - idx)::INT AS level, round(coalesce(best, m0), 6) AS mpp FROM c",
        "thumb_level": f"WITH {levels} SELECT slide_id, coalesce(max(level_idx) FILTER (greatest(size_x, size_y) >= 4990), max(level_idx))::INT AS level_idx FROM lv GROUP BY slide_id",
        "metric_summary": metric.format(m="value") + " UNION ALL " + metric.format(m="user_id"),
        "metric_lag_rate": "WITH s AS (SELECT event_id, user_id, value, epoch_us(ts) / 1e6 AS t FROM events), d AS (SELECT event_id, t - lag(t) OVER w AS dt, value - lag(value) OVER w AS dv FROM s WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id)) "
        "SELECT event_id, round(CASE WHEN dt > 0 THEN 100 * dv / dt WHEN dt IS NOT NULL THEN 0 END, 6) AS rate FROM d",
        "csv_metric_parse": f"WITH s AS (SELECT event_id, string_split({line}, ',') AS p FROM events), n AS (SELECT event_id, p, list_transform(p, lambda a: try_cast(trim(a) AS DOUBLE)) AS v FROM s) "
        f"SELECT event_id, CASE WHEN {ok} THEN v[1] END AS util, CASE WHEN {ok} THEN v[2] END AS used, CASE WHEN {ok} THEN v[3] END AS total FROM n",
        "url_parts": f"WITH s AS (SELECT page_id, coalesce(url, '') AS u FROM pages), t AS (SELECT page_id, CASE WHEN contains(u, '://') THEN lower(string_split(u, '://')[1]) ELSE '' END AS scheme, {rest} AS rest FROM s), "
        "q AS (SELECT page_id, scheme, regexp_extract(rest, '^([^/?#]*)', 1) AS place, regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) AS path FROM t) "
        "SELECT page_id, scheme, regexp_extract(place, '^(?:.*@)?([^:]*)', 1) AS host, coalesce(try_cast(regexp_extract(place, ':(\\d+)$', 1) AS INT), CASE WHEN scheme IN ('https', 'wss') THEN 443 ELSE 80 END) AS port, "
        "CASE WHEN path = '' THEN '/' ELSE path END AS path FROM q",
        "registry_lookup": "SELECT n_nationkey, 'weights-' || CASE WHEN n_nationkey % 7 <> 0 THEN n_regionkey ELSE 4 END || '.bin' AS file FROM nation",
    }
