"""Randomised checks against plain-Python implementations of the rules.

Each test draws a seeded random register (hundreds of persons or stays in
one Spark job) and compares the Spark operator with a direct, row-by-row
reading of the rules: the interval and fallback order for residence (S5,
S6), the flag OR and whole-row pick for episodes (S2), and distinct-person
counting for profiles (E12).
"""

from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict

from conftest import code, make_sources, stay

from regstat import catalogue as cat
from regstat.operators import episodes, residence, tabulate

YEARS = cat.years()
CODES_POOL = ["301", "0301", "1103", "9999", "", "12345", "5001", "abc1", "0220", None]


def _rand_date(rng, lo=2008, hi=2027):
    return dt.date(rng.randint(lo, hi), rng.randint(1, 12), rng.randint(1, 28))


def _expected_residence(intervals):
    """{(pid, year): municipality} straight from the rules."""
    out = {}
    by_pid = defaultdict(list)
    for pid, f, t, m in intervals:
        by_pid[pid].append((f, t, m))
    for pid, rows in by_pid.items():
        for y in YEARS:
            def at(day):
                vals = [m for f, t, m in rows
                        if f is not None and f <= day and (t is None or t >= day) and m is not None]
                return max(vals) if vals else None  # max over raw text
            jan, dec = at(dt.date(y, 1, 1)), at(dt.date(y, 12, 31))
            jan = None if jan in ("9999", "") else jan
            dec = None if dec in ("9999", "") else dec
            m = jan if jan is not None else dec
            if m is None:
                continue
            if len(m) < 4:
                m = m.rjust(4, "0")
            if len(m) == 4 and m.isdigit() and m.isascii():
                out[(str(pid), y)] = m
    return out


def test_residence_by_year_random(spark):
    rng = random.Random(20260101)
    intervals = []
    for pid in range(1, 301):
        for _ in range(rng.randint(0, 5)):
            f = None if rng.random() < 0.05 else _rand_date(rng)
            t = None if rng.random() < 0.3 else _rand_date(rng)
            intervals.append((pid, f, t, rng.choice(CODES_POOL)))
    src = make_sources(spark, residence=intervals)
    cohort = spark.createDataFrame([(str(p),) for p in range(1, 301)], "person_id string")
    got = {(r["person_id"], r["year"]): r["municipality"]
           for r in residence.residence_by_year(cohort, src.residence).collect()}
    assert got == _expected_residence(intervals)
    via_wide = {(r["person_id"], r["year"]): r["municipality"]
                for r in residence.wide_to_long(residence.residence_wide(cohort, src.residence)).collect()}
    assert via_wide == got


def _pick_key(row):
    year, pid, care, age, sex, home = row
    return (year, pid, care, age is None, age if age is not None else 0, sex, home is None, home or "")


def test_episodes_and_profile_random(spark):
    rng = random.Random(424242)
    spec = cat.service("PHV")
    code_pool = ["F100", "F102", "F111", "F170", "F185", "F199", "F329", "F412", "F00", "F9X", "G20", "Z000"]
    codes, stays, persons = [], [], []
    pids = [str(100 + i) for i in range(60)]
    for p in pids:
        for _ in range(rng.choice([1, 1, 1, 2])):  # some duplicate dimension rows
            persons.append((int(p), rng.choice([None, 1950, 1960, 1970, 1985]), rng.choice([None, "1", "2"])))
    for key in range(1, 500):
        for _ in range(rng.randint(1, 2)):  # a key may recur (same or other year)
            y = rng.choice([2013, 2014, 2015])
            stays.append(stay("PHV", key, y, rng.choice(pids), sex=rng.choice([None, "1", "2", "9"]),
                              home=rng.choice([None, "0301", "1103"]), care=rng.choice([1, 2, 2, 3, None])))
            for _ in range(rng.randint(0, 3)):
                codes.append(code("PHV", key, y, rng.choice(code_pool), code_no=rng.choice([11, 12, 13])))
    src = make_sources(spark, codes=codes, stays=stays, persons=persons)
    got = {r["episode_id"]: r.asDict()
           for r in episodes.episodes(src.codes["PHV"], src.stays["PHV"], src.persons, spec).collect()}

    # brute force: code rows x stay rows x person rows, then per key
    groups = spec.groups

    def flag(c, g):
        def rule(r):
            p = c[: r.width] if c is not None else None
            if p is None:
                return False
            if hasattr(r, "lo"):
                return r.lo <= p <= r.hi
            return p in r.values
        return int(any(rule(r) for r in g.rules))

    dim = defaultdict(list)
    for pid, by, sx in persons:
        dim[str(pid)].append((by, sx))
    cand = defaultdict(list)
    for (_, key, y, ct, cn, ax, cd, c) in codes:
        if not (ct == 6 and cn in (11, 12) and 2012 <= y <= 2025):
            continue
        fl = [flag(c, g) for g in groups]
        if not any(fl):
            continue
        for (_, skey, sy, pid, ssex, home, care, _, _) in stays:
            if skey != key or sy != y or care not in (1, 2) or len(pid.rstrip()) >= 12:
                continue
            for by, dsex in dim.get(pid, [(None, None)]):
                age = y - by if by is not None else None
                s = dsex if dsex is not None else ssex
                label = cat.SEX_CODES.get(s, cat.SEX_UNKNOWN) if s is not None else cat.SEX_UNKNOWN
                cand[key].append(((y, pid, care, age, label, home), fl))
    expected = {}
    for key, rows in cand.items():
        best = min(rows, key=lambda r: _pick_key(r[0]))[0]
        fl = [max(r[1][i] for r in rows) for i in range(len(groups))]
        y, pid, care, age, label, home = best
        expected[f"PHV{key}"] = dict(
            person_id=pid, episode_id=f"PHV{key}", age=age, sex=label, home_municipality=home,
            year=y, service="PHV", care_level=care, **{g.name: fl[i] for i, g in enumerate(groups)},
        )
    assert len(expected) > 100
    assert got == expected

    # profile counts against per-cell person sets (municipality fixed per person)
    res = {p: rng.choice(["0301", "1103", None]) for p in pids}
    res_rows = [(int(p), dt.date(2010, 1, 1), None, m) for p, m in res.items() if m is not None]
    src2 = make_sources(spark, residence=res_rows)
    cohort = spark.createDataFrame([(p,) for p in pids], "person_id string")
    e = episodes.episodes(src.codes["PHV"], src.stays["PHV"], src.persons, spec)
    r = residence.residence_by_year(cohort, src2.residence)
    counts = tabulate.profile_counts(tabulate.episodes_with_residence(e, r), spec.group_names)
    got_counts = {(c["year"], c["municipality"], c["sex"], c["age"]): tuple(c[g] for g in spec.group_names)
                  for c in counts.collect()}
    cells = defaultdict(lambda: [set() for _ in groups])
    for ep in expected.values():
        m = res.get(ep["person_id"])
        if m is None:
            continue
        k = (ep["year"], m, ep["sex"], ep["age"])
        for i, g in enumerate(groups):
            if ep[g.name]:
                cells[k][i].add(ep["person_id"])
        cells[k]  # cell exists even when all its groups are empty
    assert got_counts == {k: tuple(len(s) for s in v) for k, v in cells.items()}
