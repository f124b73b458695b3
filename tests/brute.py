"""Brute-force Python versions of the analyses, over collected rows.

Written straight from the analysis semantics with ``Decimal`` HALF_UP
rounding; used to check the Spark plans on small inputs.
"""

from __future__ import annotations

from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

UNSPEC = "Unspecified"


def r2(x: Decimal | None) -> float | None:
    return None if x is None else float(x.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))


def mean(values) -> Decimal | None:
    vals = [Decimal(str(v)) for v in values if v is not None]
    return sum(vals) / len(vals) if vals else None


def rank(items, key, dense=False):
    """RANK / DENSE_RANK of ``items`` sorted by ``key`` (ties share a rank)."""
    ordered = sorted(items, key=key)
    out, prev, r, distinct = {}, object(), 0, 0
    for i, it in enumerate(ordered, start=1):
        k = key(it)
        if k != prev:
            distinct += 1
            r = distinct if dense else i
            prev = k
        out[id(it)] = r
    return out


def top_complaints_by_borough(rows, top_n=3):
    counts = defaultdict(int)
    for r in rows:
        if r["borough"] is not None and r["borough"] != UNSPEC:
            counts[(r["borough"], r["complaint_type"])] += 1
    result = set()
    for b in {b for b, _ in counts}:
        items = [(t, n) for (bb, t), n in counts.items() if bb == b]
        total = sum(n for _, n in items)
        ranks = rank(items, key=lambda it: -it[1])
        for it in items:
            if ranks[id(it)] <= top_n:
                result.add((b, it[0], it[1], ranks[id(it)], r2(Decimal(it[1]) * 100 / total)))
    return result


def _resolution(rows, key_fn, where=lambda r: True):
    groups = defaultdict(list)
    for r in rows:
        if where(r):
            groups[key_fn(r)].append(r["resolution_time_hours"])
    return groups


def high_volume_complaints(rows):
    g = _resolution(rows, lambda r: r["complaint_type"])
    avg_total = Decimal(sum(len(v) for v in g.values())) / len(g)
    return {
        (t, len(v), sum(x is not None for x in v), r2(mean(v)))
        for t, v in g.items() if len(v) > avg_total
    }


def agency_workload_speed(rows):
    g = _resolution(rows, lambda r: r["agency"])
    items = [(a, len(v), sum(x is not None for x in v), r2(mean(v))) for a, v in g.items()]
    wr = rank(items, key=lambda it: -it[1])
    sr = rank(items, key=lambda it: (it[3] is None, it[3] or 0))
    return {it + (wr[id(it)], sr[id(it)] if it[3] is not None else None) for it in items}


def borough_coverage(rows):
    g = _resolution(rows, lambda r: r["borough"], lambda r: r["borough"] is not None and r["borough"] != UNSPEC)
    out = set()
    for b, v in g.items():
        resolved = sum(x is not None for x in v)
        out.add((b, len(v), resolved, r2(mean(v)), r2(Decimal(resolved) * 100 / len(v))))
    return out


def peak_hours(rows):
    counts = defaultdict(int)
    for r in rows:
        counts[r["request_hour"]] += 1
    total = sum(counts.values())
    items = list(counts.items())
    dr = rank(items, key=lambda it: -it[1], dense=True)
    return {
        (None if h is None else f"{h:02d}:00", n, dr[id(it)], r2(Decimal(n) * 100 / total))
        for it in items for h, n in [it]
    }


def weekday_pattern(rows):
    dates = [r["request_date"] for r in rows if r["request_date"] is not None]
    first, last = min(dates), max(dates)
    daily = defaultdict(list)
    for r in rows:
        d = r["request_date"]
        if d is not None and first < d < last:
            daily[(d, r["request_day_of_week"])].append(r["resolution_time_hours"])
    per_dow = defaultdict(list)
    for (d, dow), hours in daily.items():
        per_dow[dow].append((len(hours), r2(mean(hours))))
    items = []
    for dow, days in per_dow.items():
        avg_req = Decimal(sum(n for n, _ in days)) / len(days)
        items.append((dow, "Weekend" if dow in ("Saturday", "Sunday") else "Weekday", r2(avg_req),
                      r2(mean([m for _, m in days])), avg_req))
    ranks = rank(items, key=lambda it: -it[4])
    return {it[:4] + (ranks[id(it)],) for it in items}


def daily_spikes(rows):
    counts = defaultdict(int)
    for r in rows:
        counts[r["request_date"]] += 1
    avg = Decimal(r2(Decimal(sum(counts.values())) / len(counts)))
    out = set()
    for d, n in counts.items():
        diff = r2((n - avg) / avg * 100) if avg != 0 else None
        status = "Above Average" if n > avg else "Below Average" if n < avg else "Average"
        out.add((d, n, float(avg), diff, status))
    return out


def _top_types(rows, top_n):
    counts = defaultdict(int)
    for r in rows:
        counts[r["complaint_type"]] += 1
    items = list(counts.items())
    ranks = rank(items, key=lambda it: -it[1])
    return {t for it in items for t, _ in [it] if ranks[id(it)] <= top_n}


def peak_hour_by_complaint(rows, top_n=10, top_hours=3):
    top = _top_types(rows, top_n) - {None}
    counts = defaultdict(int)
    for r in rows:
        if r["complaint_type"] in top:
            counts[(r["complaint_type"], r["request_hour"])] += 1
    out = set()
    for t in top:
        items = [(h, n) for (tt, h), n in counts.items() if tt == t]
        dr = rank(items, key=lambda it: -it[1], dense=True)
        for h, n in items:
            rk = dr[id(next(it for it in items if it == (h, n)))]
            if rk <= top_hours:
                out.add((t, None if h is None else f"{h:02d}:00", n, rk))
    return out


def complaint_resolution_by_borough(rows, top_n=10, min_resolved=100):
    top = _top_types(rows, top_n) - {None}
    g = _resolution(rows, lambda r: (r["complaint_type"], r["borough"]),
                    lambda r: r["complaint_type"] in top and r["borough"] is not None and r["borough"] != UNSPEC)
    out = set()
    for t in top:
        items = [(b, v) for (tt, b), v in g.items() if tt == t and sum(x is not None for x in v) >= min_resolved]
        dr = rank(items, key=lambda it: -mean(it[1]), dense=True)
        for it in items:
            b, v = it
            out.add((t, b, sum(x is not None for x in v), r2(mean(v)), dr[id(it)]))
    return out
