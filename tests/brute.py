"""The overlay in exact rational arithmetic, one pair at a time; for small whole-number fixtures."""

from fractions import Fraction
from math import sqrt


def cut_parameters(a, b, q, p):
    """Parameters in [0, 1] at which the edge q-p cuts the segment a-b."""
    rx, ry, sx, sy = b[0] - a[0], b[1] - a[1], p[0] - q[0], p[1] - q[1]
    d = rx * sy - ry * sx
    u_num = (q[0] - a[0]) * ry - (q[1] - a[1]) * rx
    if d != 0:
        t = Fraction((q[0] - a[0]) * sy - (q[1] - a[1]) * sx, d)
        return [t] if 0 <= t <= 1 and 0 <= Fraction(u_num, d) <= 1 else []
    if u_num != 0:
        return []
    rr = rx * rx + ry * ry
    ends = [Fraction((e[0] - a[0]) * rx + (e[1] - a[1]) * ry, rr) for e in (q, p)]
    return [t for t in ends if 0 <= t <= 1]


def ring_edges(rings):
    return [
        (ring[i], ring[(i + 1) % len(ring)])
        for ring in rings
        for i in range(len(ring))
        if ring[i] != ring[(i + 1) % len(ring)]
    ]


def inside(x, y, rings):
    """Even-odd rule on the closed polygon."""
    odd = False
    for (ax, ay), (bx, by) in ring_edges(rings):
        if min(ax, bx) <= x <= max(ax, bx) and min(ay, by) <= y <= max(ay, by):
            if (bx - ax) * (y - ay) == (by - ay) * (x - ax):
                return True
        if (ay > y) != (by > y) and x < ax + Fraction((y - ay) * (bx - ax)) / (by - ay):
            odd = not odd
    return odd


def overlay(elements, zones):
    """{(eid, piece_no): (length, zones, vertices)} for elements {eid: vertices}, zones {zid: rings}."""
    borders = [e for rings in zones.values() for e in ring_edges(rings)]
    found = {}
    for eid, line in elements.items():
        segs = [(a, b) for a, b in zip(line, line[1:]) if a != b]
        cuts = set()
        for sn, (a, b) in enumerate(segs):
            for q, p in borders:
                for t in cut_parameters(a, b, q, p):
                    cuts.add((sn + 1, Fraction(0)) if t == 1 else (sn, t))
        cuts = {c for c in cuts if c != (0, 0) and c[0] < len(segs)}
        stops = sorted(cuts | {(sn, Fraction(0)) for sn in range(len(segs))})
        number, pieces = 0, {}
        for i, (sn, t) in enumerate(stops):
            if (sn, t) in cuts:
                number += 1
            end = stops[i + 1][1] if i + 1 < len(stops) and stops[i + 1][0] == sn else Fraction(1)
            pieces.setdefault(number, []).append((sn, t, end))
        for number, stretches in pieces.items():
            length, vertices = 0.0, []
            for sn, t, end in stretches:
                (ax, ay), (bx, by) = segs[sn]
                length += float(end - t) * sqrt((bx - ax) ** 2 + (by - ay) ** 2)
                vertices.append((float(ax + t * (bx - ax)), float(ay + t * (by - ay))))
            vertices.append((float(ax + end * (bx - ax)), float(ay + end * (by - ay))))
            sn, t, end = stretches[0]
            (ax, ay), (bx, by) = segs[sn]
            mid = (t + end) / 2
            mx, my = ax + mid * (bx - ax), ay + mid * (by - ay)
            hit = {zid for zid, rings in zones.items() if inside(mx, my, rings)}
            found[eid, number] = (length, hit, vertices)
    return found
