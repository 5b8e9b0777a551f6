"""The registered queries in plain SQL over the same tables.

The overlay is computed here by brute force: every segment against every zone whose
bounding box it meets, every edge of those zones, and ray casting over all edges of a
zone. No grid, no tessellation and no chunks, so the two sides differ where the engine
could go wrong.
"""

import re

from checks.numbers import HALF

INPUT = """
WITH q AS MATERIALIZED (
  SELECT l_orderkey, l_linenumber, min(l_partkey) AS pk, min(l_suppkey) AS sk
  FROM lineitem GROUP BY l_orderkey, l_linenumber),
vertex AS MATERIALIZED (
  SELECT l_orderkey AS eid, l_linenumber AS ln,
    CAST((l_orderkey * 7919) % 400000 + sum((pk * 131) % 1201 - 600) OVER w AS BIGINT) AS x,
    CAST((l_orderkey * 104729) % 400000
      + sum((sk * 197 + l_linenumber * 389) % 1201 - 600) OVER w AS BIGINT) AS y
  FROM q WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber)),
raw_element AS MATERIALIZED (
  SELECT o_orderkey AS element_id,
    CASE left(o_orderpriority, 1) WHEN '1' THEN 'EV' WHEN '2' THEN 'RV' WHEN '3' THEN 'FV'
      WHEN '4' THEN 'KV' WHEN '5' THEN 'JB' END AS elementtype_code,
    'R' || (o_custkey % 100) AS route_code,
    floor(o_totalprice / 50) AS aadt_passenger,
    floor(o_totalprice / 400) AS aadt_goods,
    CAST(10 + 15 * ((o_custkey % 100) % 7) AS DOUBLE) AS diversion_time,
    n.n_vertex, n.xmin, n.ymin, n.xmax, n.ymax
  FROM orders LEFT JOIN (
    SELECT eid, count(*) AS n_vertex, min(x) AS xmin, min(y) AS ymin, max(x) AS xmax, max(y) AS ymax
    FROM vertex GROUP BY eid) n ON n.eid = o_orderkey),
element AS MATERIALIZED (SELECT * FROM raw_element WHERE n_vertex >= 2),
seg AS MATERIALIZED (
  SELECT eid, row_number() OVER (PARTITION BY eid ORDER BY ln) - 1 AS sn,
    count(*) OVER (PARTITION BY eid) AS n_seg, 0 AS part_no, 0 AS part_first, x1, y1, x2, y2
  FROM (SELECT eid, ln, x AS x1, y AS y1, lead(x) OVER w AS x2, lead(y) OVER w AS y2
        FROM vertex WINDOW w AS (PARTITION BY eid ORDER BY ln))
  WHERE x2 IS NOT NULL AND (x1 <> x2 OR y1 <> y2)),
zone AS MATERIALIZED (
  SELECT p_partkey AS zid, (p_partkey * 6151) % 400000 AS cx, (p_partkey * 15485863) % 400000 AS cy,
    300 + 35 * p_size AS r, CAST(p_size % 3 + 1 AS INTEGER) AS processtype_id,
    CAST(CASE p_partkey % 5 WHEN 0 THEN 0 WHEN 1 THEN 20 WHEN 2 THEN 100 WHEN 3 THEN 333
      ELSE 1000 END AS DOUBLE) AS event_frequency
  FROM part),
corner(k, a, b) AS (VALUES (0, -2, -2), (1, 2, -2), (2, 2, 0), (3, 0, 0), (4, 0, 2), (5, -2, 2)),
edge AS MATERIALIZED (
  SELECT zid, c.k, cx + r * c.a AS qx, cy + r * c.b AS qy, cx + r * d.a AS px, cy + r * d.b AS py
  FROM zone, corner c, corner d WHERE d.k = (c.k + 1) % 6),
zbox AS MATERIALIZED (
  SELECT zid, cx - 2 * r AS xmin, cy - 2 * r AS ymin, cx + 2 * r AS xmax, cy + 2 * r AS ymax
  FROM zone)
"""

OVERLAP = """,
box AS (SELECT greatest(e.xmin, z.xmin) AS xmin, greatest(e.ymin, z.ymin) AS ymin,
    least(e.xmax, z.xmax) AS xmax, least(e.ymax, z.ymax) AS ymax
  FROM (SELECT min(xmin) AS xmin, min(ymin) AS ymin, max(xmax) AS xmax, max(ymax) AS ymax
        FROM element) e,
       (SELECT min(xmin) AS xmin, min(ymin) AS ymin, max(xmax) AS xmax, max(ymax) AS ymax
        FROM zbox) z)
"""

CAND = """,
cand AS MATERIALIZED (
  SELECT s.*, b.zid FROM seg s JOIN zbox b
    ON least(s.x1, s.x2) <= b.xmax + {tol} AND greatest(s.x1, s.x2) >= b.xmin - {tol}
   AND least(s.y1, s.y2) <= b.ymax + {tol} AND greatest(s.y1, s.y2) >= b.ymin - {tol})
"""

_ZONE_MEETS = """
  SELECT c.eid, c.sn, c.n_seg, c.x1, c.y1, c.x2, c.y2, e.qx, e.qy, e.px, e.py
  FROM cand c JOIN edge e USING (zid)
"""

_ELEMENT_MEETS = """
  UNION ALL
  SELECT s.eid, s.sn, s.n_seg, s.x1, s.y1, s.x2, s.y2, o.x1, o.y1, o.x2, o.y2
  FROM seg s JOIN seg o ON s.eid <> o.eid
   AND least(s.x1, s.x2) <= greatest(o.x1, o.x2) AND greatest(s.x1, s.x2) >= least(o.x1, o.x2)
   AND least(s.y1, s.y2) <= greatest(o.y1, o.y2) AND greatest(s.y1, s.y2) >= least(o.y1, o.y2)
"""



def _base(*names: str) -> str:
    """The input with some of its tables under the name <name>0, to be defined anew."""
    text = INPUT
    for name in names:
        text = re.sub(rf"\b{name} AS MATERIALIZED", f"{name}0 AS MATERIALIZED", text)
        text = re.sub(rf"FROM {name}\b", f"FROM {name}0", text)
    return text


# Elements per customer: the lines of its orders are the parts. Odd customers have ids beyond
# 2^50, even ones negative ids.
MULTIPART = _base("seg", "element") + """,
owner AS (SELECT o_orderkey, o_custkey, CASE WHEN o_custkey % 2 = 1 THEN 1125899906842624 + o_custkey
    ELSE -o_custkey END AS id FROM orders),
element AS MATERIALIZED (
  SELECT id AS element_id, 'EV' AS elementtype_code, 'R' || (any_value(o_custkey) % 100) AS route_code,
    CAST(count(*) AS DOUBLE) AS aadt_passenger, CAST(1 AS DOUBLE) AS aadt_goods,
    CAST(30 AS DOUBLE) AS diversion_time
  FROM owner GROUP BY id),
part AS MATERIALIZED (
  SELECT o_orderkey, id, row_number() OVER (PARTITION BY id ORDER BY o_orderkey) - 1 AS part_no
  FROM owner WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)),
seg AS MATERIALIZED (
  SELECT id AS eid, row_number() OVER w - 1 AS sn, count(*) OVER (PARTITION BY id) AS n_seg,
    p.part_no, CAST(s.sn = 0 AND row_number() OVER w > 1 AS INTEGER) AS part_first, x1, y1, x2, y2
  FROM seg0 s JOIN part p ON s.eid = o_orderkey WINDOW w AS (PARTITION BY id ORDER BY o_orderkey, s.sn))
"""


def extent_sql(shift: int) -> str:
    """Elements moved to the right, and both layers restricted to their common extent."""
    return _base("seg", "element", "zone", "edge", "zbox") + f""",
line AS (SELECT *, xmin + {shift} AS x_lo, xmax + {shift} AS x_hi FROM raw_element),
box AS (
  SELECT greatest(e.xmin, z.xmin) AS xmin, greatest(e.ymin, z.ymin) AS ymin,
    least(e.xmax, z.xmax) AS xmax, least(e.ymax, z.ymax) AS ymax
  FROM (SELECT min(x_lo) AS xmin, min(ymin) AS ymin, max(x_hi) AS xmax, max(ymax) AS ymax FROM line) e,
       (SELECT min(xmin) AS xmin, min(ymin) AS ymin, max(xmax) AS xmax, max(ymax) AS ymax FROM zbox0) z),
element AS MATERIALIZED (
  SELECT m.* FROM line m, box b WHERE m.element_id IN (SELECT eid FROM seg0)
    AND x_lo <= b.xmax AND x_hi >= b.xmin AND m.ymin <= b.ymax AND m.ymax >= b.ymin),
zbox AS MATERIALIZED (
  SELECT m.* FROM zbox0 m, box b
  WHERE m.xmin <= b.xmax AND m.xmax >= b.xmin AND m.ymin <= b.ymax AND m.ymax >= b.ymin),
zone AS MATERIALIZED (SELECT * FROM zone0 WHERE zid IN (SELECT zid FROM zbox)),
edge AS MATERIALIZED (SELECT * FROM edge0 WHERE zid IN (SELECT zid FROM zbox)),
seg AS MATERIALIZED (
  SELECT eid, sn, n_seg, part_no, part_first, x1 + {shift} AS x1, y1, x2 + {shift} AS x2, y2
  FROM seg0 WHERE eid IN (SELECT element_id FROM element))
"""


# Seven elements of a part per order, and twenty straight lines across the plane.
LONG = _base("seg", "element") + """,
straight AS (SELECT unnest(range(20)) AS i),
element AS MATERIALIZED (
  SELECT id AS element_id, 'EV' AS elementtype_code, 'R1' AS route_code, CAST(1 AS DOUBLE) AS aadt_passenger,
    CAST(1 AS DOUBLE) AS aadt_goods, CAST(30 AS DOUBLE) AS diversion_time
  FROM (SELECT DISTINCT -1 - o_custkey % 7 AS id FROM orders UNION ALL SELECT 1152921504606846976 + i FROM straight)),
seg AS MATERIALIZED (
  SELECT -1 - o_custkey % 7 AS eid, row_number() OVER w - 1 AS sn,
    count(*) OVER (PARTITION BY o_custkey % 7) AS n_seg, 0 AS part_no,
    CAST(s.sn = 0 AND row_number() OVER w > 1 AS INTEGER) AS part_first, x1, y1, x2, y2
  FROM seg0 s JOIN orders ON s.eid = o_orderkey
  WINDOW w AS (PARTITION BY o_custkey % 7 ORDER BY o_orderkey, s.sn)
  UNION ALL SELECT 1152921504606846976 + i, 0, 1, 0, 0, 0, 20000 * i + 10, 400000, 20000 * i + 10 FROM straight)
"""

# Sevenths of the coordinates. Each zone has a neighbour that fills its notch; their shared
# borders are computed in two ways, which differ in the last bits.
_SEVENTH = "{0} / 7.0::DOUBLE AS {0}"
SEVENTHS = _base("seg", "zone", "edge", "zbox") + f""",
seg AS MATERIALIZED (SELECT eid, sn, n_seg, part_no, part_first,
    {", ".join(_SEVENTH.format(c) for c in ("x1", "y1", "x2", "y2"))} FROM seg0),
zone AS MATERIALIZED (
  SELECT zid, processtype_id, event_frequency FROM zone0
  UNION ALL SELECT -zid, processtype_id, event_frequency FROM zone0),
notch(k, a, b) AS (VALUES (0, 0, 0), (1, 2, 0), (2, 2, 2), (3, 0, 2)),
edge AS MATERIALIZED (
  SELECT zid, k, {", ".join(_SEVENTH.format(c) for c in ("qx", "qy", "px", "py"))} FROM edge0
  UNION ALL
  SELECT -zid, c.k, cx / 7.0::DOUBLE + r / 7.0::DOUBLE * c.a, cy / 7.0::DOUBLE + r / 7.0::DOUBLE * c.b,
    cx / 7.0::DOUBLE + r / 7.0::DOUBLE * d.a, cy / 7.0::DOUBLE + r / 7.0::DOUBLE * d.b
  FROM zone0, notch c, notch d WHERE d.k = (c.k + 1) % 4),
zbox AS MATERIALIZED (
  SELECT zid, min(qx) AS xmin, min(qy) AS ymin, max(qx) AS xmax, max(qy) AS ymax FROM edge GROUP BY zid)
"""

_EXACT_HITS = """
  SELECT eid, sn, n_seg, tn / d AS t FROM meet
    WHERE d <> 0 AND tn / d BETWEEN 0 AND 1 AND un / d BETWEEN 0 AND 1
  UNION ALL SELECT eid, sn, n_seg, qr / rr FROM meet
    WHERE d = 0 AND un = 0 AND qr / rr BETWEEN 0 AND 1
  UNION ALL SELECT eid, sn, n_seg, pr / rr FROM meet
    WHERE d = 0 AND un = 0 AND pr / rr BETWEEN 0 AND 1
"""


def _near_hits(tol: float) -> str:
    """Within a tolerance, for layers whose segments are all longer than it."""
    t = f"{tol}::DOUBLE"
    return f"""
  SELECT eid, sn, n_seg, t FROM (
    SELECT *, t - lag(CASE WHEN t BETWEEN 1e-300 AND 0.9999999999999998 THEN t END)
        OVER (PARTITION BY eid, sn, t BETWEEN 1e-300 AND 0.9999999999999998 ORDER BY t) AS gap
    FROM (SELECT DISTINCT eid, sn, n_seg, len,
        CASE WHEN t * len <= {t} THEN 0 WHEN (1 - t) * len <= {t} THEN 1 ELSE t END AS t
      FROM (
        SELECT *, tn / d AS t FROM near WHERE NOT along AND d <> 0 AND un / d * el BETWEEN -{t} AND el + {t}
        UNION ALL SELECT *, qr / rr FROM near WHERE along AND near_q
        UNION ALL SELECT *, pr / rr FROM near WHERE along AND near_p)
      WHERE t * len BETWEEN -{t} AND len + {t}))
  WHERE gap IS NULL OR gap * len > {t} OR t = 0 OR t = 1
"""


def split_sql(
    split_at_elements: bool = False, source: str = INPUT, tolerance: float = 0.0
) -> str:
    """CTEs cut, stretch (sub-segments with piece numbers) and piece."""
    tol = f"{tolerance}::DOUBLE"
    return source + CAND.format(tol=tol) + split_tail(split_at_elements, tolerance)


def split_tail(split_at_elements: bool = False, tolerance: float = 0.0) -> str:
    """CTEs cut, stretch and piece over seg, edge and cand."""
    tol = f"{tolerance}::DOUBLE"
    near = f""",
near AS (SELECT *, near_q AND near_p OR abs(ea) <= {tol} * el AND abs(eb) <= {tol} * el AS along FROM (
  SELECT *, abs(un) <= {tol} * len AS near_q, abs(lp) <= {tol} * len AS near_p FROM (
    SELECT *, sqrt(rr) AS len, sqrt((px - qx) * (px - qx) + (py - qy) * (py - qy)) AS el,
      (px - x1) * (y2 - y1) - (py - y1) * (x2 - x1) AS lp,
      (x1 - qx) * (py - qy) - (y1 - qy) * (px - qx) AS ea,
      (x2 - qx) * (py - qy) - (y2 - qy) * (px - qx) AS eb
    FROM meet)))"""
    return (
        f""",
meet AS (SELECT *, CAST((x2 - x1) * (py - qy) - (y2 - y1) * (px - qx) AS DOUBLE) AS d,
    CAST((qx - x1) * (py - qy) - (qy - y1) * (px - qx) AS DOUBLE) AS tn,
    CAST((qx - x1) * (y2 - y1) - (qy - y1) * (x2 - x1) AS DOUBLE) AS un,
    CAST((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1) AS DOUBLE) AS rr,
    CAST((qx - x1) * (x2 - x1) + (qy - y1) * (y2 - y1) AS DOUBLE) AS qr,
    CAST((px - x1) * (x2 - x1) + (py - y1) * (y2 - y1) AS DOUBLE) AS pr
  FROM ({_ZONE_MEETS}{_ELEMENT_MEETS if split_at_elements else ""})){near if tolerance else ""},
hit AS ({_near_hits(tolerance) if tolerance else _EXACT_HITS}),
cut AS MATERIALIZED (
  SELECT DISTINCT eid, CASE WHEN t = 1 THEN sn + 1 ELSE sn END AS sn,
    CASE WHEN t = 1 THEN 0 ELSE t END AS t
  FROM hit
  WHERE (t < 1 AND (sn > 0 OR t > 0)) OR (t = 1 AND sn + 1 < n_seg)),
point AS (
  SELECT eid, sn, t, max(c) AS c FROM (
    SELECT eid, sn, CAST(0 AS DOUBLE) AS t, part_first AS c FROM seg
    UNION ALL SELECT eid, sn, t, 1 FROM cut) GROUP BY eid, sn, t),
stretch AS MATERIALIZED (
  SELECT p.eid, p.sn, p.t AS t1,
    coalesce(lead(p.t) OVER (PARTITION BY p.eid, p.sn ORDER BY p.t), 1) AS t2,
    sum(p.c) OVER (PARTITION BY p.eid ORDER BY p.sn, p.t) AS pno,
    s.x1, s.y1, s.x2, s.y2
  FROM point p JOIN seg s ON s.eid = p.eid AND s.sn = p.sn),
piece AS MATERIALIZED (
  SELECT CASE WHEN eid BETWEEN -8796093022208 AND 8796093022207 AND pno < 1048576
      THEN eid * 1048576 + CAST(pno AS BIGINT) END AS fid, eid, CAST(pno AS BIGINT) AS pno,
    sum((t2 - t1) * sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))) AS len
  FROM stretch GROUP BY eid, pno)
"""
    )


_ON_EDGE = """(i.x2 - i.x1) * (e.py - e.qy) - (i.y2 - i.y1) * (e.px - e.qx) = 0
      AND (e.qx - i.x1) * (i.y2 - i.y1) - (e.qy - i.y1) * (i.x2 - i.x1) = 0
      AND i.t * ((i.x2 - i.x1) * (i.x2 - i.x1) + (i.y2 - i.y1) * (i.y2 - i.y1)) BETWEEN
        least((i.x2 - i.x1) * (e.qx - i.x1) + (i.y2 - i.y1) * (e.qy - i.y1),
              (i.x2 - i.x1) * (e.px - i.x1) + (i.y2 - i.y1) * (e.py - i.y1))
        AND greatest((i.x2 - i.x1) * (e.qx - i.x1) + (i.y2 - i.y1) * (e.qy - i.y1),
              (i.x2 - i.x1) * (e.px - i.x1) + (i.y2 - i.y1) * (e.py - i.y1))"""


def _near_edge(tol: float) -> str:
    """Whether the edge's nearest point is within the tolerance of the inner point."""
    mx, my = "(i.x1 + i.t * (i.x2 - i.x1))", "(i.y1 + i.t * (i.y2 - i.y1))"
    ss = "((e.px - e.qx) * (e.px - e.qx) + (e.py - e.qy) * (e.py - e.qy))"
    u = f"greatest(0, least(1, (({mx} - e.qx) * (e.px - e.qx) + ({my} - e.qy) * (e.py - e.qy)) / {ss}))"
    dx, dy = f"(e.qx + {u} * (e.px - e.qx) - {mx})", f"(e.qy + {u} * (e.py - e.qy) - {my})"
    return f"sqrt({dx} * {dx} + {dy} * {dy}) <= {tol}::DOUBLE"


PAIRS = """,
inner_point AS (
  SELECT eid, pno, sn, (t1 + t2) / 2 AS t, x1, y1, x2, y2 FROM (
    SELECT *, row_number() OVER (PARTITION BY eid, pno ORDER BY
      (t2 - t1) * sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)) DESC, sn, t1) AS n FROM stretch)
  WHERE n = 1),
tested AS (
  SELECT i.eid, CAST(i.pno AS BIGINT) AS pno, c.zid,
    CASE WHEN (e.qy > i.y1 + i.t * (i.y2 - i.y1)) <> (e.py > i.y1 + i.t * (i.y2 - i.y1))
      AND i.x1 + i.t * (i.x2 - i.x1)
        < e.qx + (i.y1 + i.t * (i.y2 - i.y1) - e.qy) * (e.px - e.qx) / (e.py - e.qy)
      THEN 1 ELSE 0 END AS crossing,
    CASE WHEN {on_edge}
      THEN 1 ELSE 0 END AS on_edge
  FROM inner_point i JOIN cand c ON c.eid = i.eid AND c.sn = i.sn JOIN edge e ON e.zid = c.zid),
pair AS MATERIALIZED (
  SELECT eid, pno, zid FROM tested GROUP BY eid, pno, zid
  HAVING sum(crossing) % 2 = 1 OR max(on_edge) = 1),
inter AS MATERIALIZED (
  SELECT p.fid, r.zid, p.eid, p.pno, e.elementtype_code, e.route_code, e.aadt_passenger, e.aadt_goods,
    e.diversion_time, z.processtype_id, z.event_frequency,
    floor(z.event_frequency / 5) AS freq_interval_plus,
    floor(z.event_frequency / 5) AS freq_interval_minus, p.len
  FROM pair r JOIN piece p ON p.eid = r.eid AND p.pno = r.pno
    JOIN zone z ON z.zid = r.zid JOIN element e ON e.element_id = r.eid
  WHERE p.len > 0 AND z.event_frequency > 0)
"""

PAIRS_NEAR, PAIRS = PAIRS, PAIRS.format(on_edge=_ON_EDGE)
OVERLAY = split_sql() + PAIRS


def near_pairs(tolerance: float) -> str:
    """CTEs pair and inter with points near a boundary counted as inside."""
    return PAIRS_NEAR.format(on_edge=_near_edge(tolerance))


def parameters(closure_days_factor: float = 1.0, without: int | None = None) -> str:
    rows = {1: (0.5, 12.5, 3000), 2: (2, 40, 9000), 3: (7, 150, 25000)}
    values = ", ".join(
        f"({k}, CAST({c * closure_days_factor} AS DOUBLE), CAST({r} AS DOUBLE), CAST({o} AS DOUBLE))"
        for k, (c, r, o) in rows.items()
        if k != without
    )
    return f""",
process_type(processtype_id, closure_days, repair_per_m, reopening_cost) AS (VALUES {values}),
element_type(elementtype_code, vot_passenger, vot_goods) AS (VALUES
  ('EV', 200, 600), ('RV', 180, 550), ('FV', 150, 500), ('KV', 120, 450))
"""


COSTS = """,
cost AS MATERIALIZED (
  SELECT i.*, 1 / i.event_frequency AS freq,
    1 / (i.event_frequency + i.freq_interval_plus) AS f_low,
    CASE WHEN i.event_frequency - i.freq_interval_minus > 0
      THEN 1 / (i.event_frequency - i.freq_interval_minus) END AS f_high,
    p.closure_days * (i.aadt_passenger * t.vot_passenger + i.aadt_goods * t.vot_goods)
      * i.diversion_time / 60 AS closure_event,
    p.repair_per_m * i.len AS repair_event, p.reopening_cost AS reopening_event
  FROM inter i LEFT JOIN process_type p USING (processtype_id)
    LEFT JOIN element_type t USING (elementtype_code)),
es AS MATERIALIZED (
  SELECT fid, eid, pno, sum(freq) AS hazard_frequency, sum(freq * closure_event) AS closure_cost,
    sum(freq * repair_event) AS repair_cost, sum(freq * reopening_event) AS reopening_cost,
    sum(freq * (closure_event + repair_event + reopening_event)) AS total_cost,
    sum(f_low * (closure_event + repair_event + reopening_event)) AS total_cost_low,
    sum(f_high * (closure_event + repair_event + reopening_event)) AS total_cost_high,
    count(DISTINCT zid) AS n_zones
  FROM cost GROUP BY fid, eid, pno),
rs AS MATERIALIZED (
  SELECT o.*, n.n_elements FROM (
    SELECT route_code, sum(freq) AS closure_frequency, sum(closure) AS closure_cost,
      sum(repair) AS repair_cost, sum(reopening) AS reopening_cost,
      sum(closure) + sum(repair) + sum(reopening) AS total_cost, count(*) AS n_zones
    FROM (SELECT route_code, zid, max(freq) AS freq, max(freq * closure_event) AS closure,
            sum(freq * repair_event) AS repair, max(freq * reopening_event) AS reopening
          FROM cost GROUP BY route_code, zid) GROUP BY route_code) o
  JOIN (SELECT route_code, count(DISTINCT fid) AS n_elements FROM cost GROUP BY route_code) n
    USING (route_code))
"""


def fixed(expr: str, name: str, digits: int = 2) -> str:
    scale = 10**digits
    return f"CAST(floor(({expr}) * {scale}.0::DOUBLE + {HALF}::DOUBLE) / {scale} AS DOUBLE) AS {name}"


ES_COLUMNS = ", ".join(
    [fixed("hazard_frequency", "hazard_frequency", 6)]
    + [
        fixed(c, c)
        for c in (
            "closure_cost",
            "repair_cost",
            "reopening_cost",
            "total_cost",
            "total_cost_low",
            "total_cost_high",
        )
    ]
    + ["CAST(n_zones AS BIGINT) AS n_zones"]
)
RS_COLUMNS = ", ".join(
    [fixed("closure_frequency", "closure_frequency", 6)]
    + [fixed(c, c) for c in ("closure_cost", "repair_cost", "reopening_cost", "total_cost")]
    + ["CAST(n_zones AS BIGINT) AS n_zones", "CAST(n_elements AS BIGINT) AS n_elements"]
)
INTER_COLUMNS = (
    "fid AS element_feature_id, zid AS hazardzone_feature_id, elementtype_code, route_code,"
    " aadt_passenger, aadt_goods, diversion_time, processtype_id, event_frequency,"
    " freq_interval_plus, freq_interval_minus, eid AS element_id, pno AS piece_no, "
    + fixed("len", "element_size", 3)
)
EAR_COLUMNS = (
    "p.fid AS element_feature_id, p.eid AS element_id, p.pno AS piece_no, e.elementtype_code,"
    " e.route_code, e.aadt_passenger, e.aadt_goods, e.diversion_time, "
    + fixed("p.len", "element_size", 3)
)
FROM_EAR = "FROM piece p JOIN element e ON e.element_id = p.eid"

RISK = OVERLAY + parameters() + COSTS
