"""DuckDB SQL oracle for every registered query.

Each string is self-contained: CTEs derive the register inputs from the
pre-registered driver tables (same recipe as ``regstat.sources.fixtures``,
written here in SQL), then compute the query in plain SQL. The forms are
deliberately the textbook ones, not our Spark plans: window MAX +
ROW_NUMBER for episodes, 28 CASE columns + UNION ALL for residence,
``count(DISTINCT CASE ...)`` for the profile counts.
"""

from __future__ import annotations

from regstat import catalogue as cat
from regstat.catalogue import CodeGroup, PrefixRange, ServiceSpec
from regstat.operators.episodes import PICK_ORDER

START, END = cat.START_YEAR, cat.END_YEAR
YEARS = cat.years()

FIXTURE_CTES = f"""
stays_all AS (
  SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'SOM' WHEN '2-HIGH' THEN 'PHV'
              WHEN '3-MEDIUM' THEN 'TSB' WHEN '4-NOT SPECIFIED' THEN 'PHBU' ELSE 'AVT' END AS service,
         o_orderkey AS stay_key,
         CAST(year(o_orderdate) + 16 AS INTEGER) AS year,
         rtrim(CASE WHEN o_custkey % 97 = 0 THEN concat('00000000000', CAST(o_custkey AS VARCHAR))
              ELSE CAST(o_custkey AS VARCHAR) END) AS person_id,
         CASE o_orderkey % 4 WHEN 0 THEN '1' WHEN 1 THEN '2' WHEN 2 THEN '9' END AS sex,
         CAST(301 + (o_custkey % 25) * 50 AS VARCHAR) AS home_municipality,
         CASE o_orderkey % 10 WHEN 0 THEN NULL WHEN 1 THEN 3
              ELSE CAST(1 + o_orderkey % 2 AS INTEGER) END AS care_level,
         CASE o_orderkey % 7 WHEN 0 THEN 1 WHEN 1 THEN NULL ELSE 0 END AS is_rehab,
         CASE WHEN o_orderkey % 11 = 0 THEN NULL
              WHEN o_orderstatus = 'P' AND o_orderkey % 3 = 0 THEN 'S'
              ELSE o_orderstatus END AS niva
  FROM orders
),
codes_all AS (
  SELECT CASE o.o_orderpriority WHEN '1-URGENT' THEN 'SOM' WHEN '2-HIGH' THEN 'PHV'
              WHEN '3-MEDIUM' THEN 'TSB' WHEN '4-NOT SPECIFIED' THEN 'PHBU' ELSE 'AVT' END AS service,
         l.l_orderkey AS stay_key,
         CAST(CASE WHEN l.l_linenumber = 7 THEN year(l.l_shipdate) ELSE year(o.o_orderdate) END + 16
              AS INTEGER) AS year,
         CASE WHEN l.l_returnflag = 'N' AND l.l_linestatus = 'O' THEN 5 ELSE 6 END AS code_type,
         CAST(11 + l.l_linenumber % 3 AS INTEGER) AS code_no,
         CASE WHEN l.l_returnflag = 'N' THEN 2 ELSE 1 END AS axis,
         CASE WHEN l.l_linestatus = 'O' THEN 2 ELSE 1 END AS condition,
         ['I219', 'I500', 'J449', 'M170', 'S720', 'S723', 'S009', 'T402', 'T781', 'T079',
          'F329', 'F413', 'F102', 'F120', 'F170', 'F185', 'F199', 'F000', 'Z000', 'I109'
         ][1 + (l.l_partkey + l.l_suppkey) % 20] AS code
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
persons AS (
  SELECT c_custkey AS person_id, CAST(2010 - c_custkey % 90 AS INTEGER) AS birth_year,
         CAST(1 + c_nationkey % 2 AS VARCHAR) AS sex
  FROM customer WHERE c_custkey % 31 <> 0
),
residence AS (
  SELECT o_custkey AS person_id,
         CAST(o_orderdate + INTERVAL 16 YEAR AS DATE) AS from_date,
         CAST(CASE WHEN o_orderkey % 13 = 0 THEN nxt + INTERVAL 16 YEAR + INTERVAL 60 DAY
                   ELSE nxt + INTERVAL 16 YEAR - INTERVAL 1 DAY END AS DATE) AS to_date,
         CASE WHEN o_orderkey % 17 = 0 THEN '9999' WHEN o_orderkey % 19 = 0 THEN ''
              WHEN o_orderkey % 23 = 0 THEN '12345' WHEN o_orderkey % 29 = 0 THEN '1534'
              ELSE CAST(301 + (o_orderkey % 25) * 50 AS VARCHAR) END AS municipality
  FROM (SELECT o_orderkey, o_custkey, o_orderdate,
               lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS nxt
        FROM orders)
),
places_raw AS (
  SELECT CAST(301 + n_nationkey * 50 AS INTEGER) AS kommunenr, n_name AS kommunenavn,
         CAST(301 + n_nationkey * 50 AS VARCHAR) AS kommunenrdagens, n_name AS kommunenavndagens,
         CAST(r_regionkey AS VARCHAR) AS fylkenr, r_name AS fylkenavn,
         CAST(r_regionkey AS VARCHAR) AS fylkenrdagens, r_name AS fylkenavndagens
  FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL
  SELECT CAST(301 + n_nationkey * 50 AS INTEGER), concat(n_name, ' OLD'),
         CAST(301 + n_nationkey * 50 AS VARCHAR), n_name,
         CAST(r_regionkey AS VARCHAR), r_name, CAST(r_regionkey AS VARCHAR), r_name
  FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey = 3
  UNION ALL
  SELECT 1534, 'Old Haram', '1507', 'Alesund', '0', 'AFRICA', '0', 'AFRICA'
)"""


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def group_sql(code: str, g: CodeGroup) -> str:
    parts = []
    for r in g.rules:
        p = f"left({code}, {r.width})"
        if isinstance(r, PrefixRange):
            parts.append(f"{p} BETWEEN {_q(r.lo)} AND {_q(r.hi)}")
        else:
            parts.append(f"{p} IN ({', '.join(_q(v) for v in r.values)})")
    return "(" + " OR ".join(parts) + ")"


def flags_sql(code: str, spec: ServiceSpec) -> str:
    return ",\n    ".join(
        f"CASE WHEN {group_sql(code, g)} THEN 1 ELSE 0 END AS {g.name}" for g in spec.groups
    )


def selector_sql(spec: ServiceSpec, a: str = "c") -> str:
    s = spec.selector
    if s.kind == "type":
        return f"{a}.code_type = {s.code_type} AND {a}.code_no IN ({', '.join(map(str, s.code_nos))})"
    return f"{a}.axis = {s.axis} AND {a}.condition = {s.condition}"


def cohort_sql(code: str, spec: ServiceSpec) -> str:
    return "(" + " OR ".join(group_sql(code, g) for g in spec.groups) + ")"


def stay_filter_sql(spec: ServiceSpec, b: str = "b") -> str:
    levels = ", ".join(map(str, cat.CARE_LEVELS))
    out = (
        f"length(rtrim({b}.person_id)) < {cat.MAX_ID_LENGTH} AND {b}.year BETWEEN {START} AND {END}"
        f" AND {b}.care_level IN ({levels})"
    )
    if spec.somatic_stay_filter:
        out += (
            f" AND ({b}.is_rehab IS NULL OR {b}.is_rehab = {cat.REHAB_KEEP})"
            f" AND {b}.niva <> {_q(cat.LEVEL_EXCLUDED)}"
        )
    return out


def sex_sql(expr: str) -> str:
    whens = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in cat.SEX_CODES.items())
    return f"CASE {expr} {whens} ELSE {_q(cat.SEX_UNKNOWN)} END"


def marked_sql(spec: ServiceSpec) -> str:
    """Code rows x stays x persons with attributes and flags (no collapse)."""
    return f"""
  SELECT c.stay_key, b.person_id,
    concat({_q(spec.name)}, CAST(c.stay_key AS VARCHAR)) AS episode_id,
    c.year - d.birth_year AS age,
    {sex_sql('coalesce(d.sex, b.sex)')} AS sex,
    b.home_municipality, c.year, {_q(spec.name)} AS service, b.care_level,
    {flags_sql('c.code', spec)}
  FROM codes_all c
  JOIN stays_all b ON b.stay_key = c.stay_key AND b.year = c.year AND b.service = c.service
  LEFT JOIN persons d ON CAST(d.person_id AS VARCHAR) = b.person_id
  WHERE c.service = {_q(spec.name)} AND b.service = {_q(spec.name)}
    AND c.year BETWEEN {START} AND {END} AND {selector_sql(spec)}
    AND {cohort_sql('c.code', spec)} AND {stay_filter_sql(spec)}"""


EPISODE_COLS = "person_id, episode_id, age, sex, home_municipality, year, service, care_level"


def episodes_sql(spec: ServiceSpec, marked: str) -> str:
    order = ", ".join(f"{n} NULLS LAST" if nullable else n for n, nullable in PICK_ORDER)
    maxes = ", ".join(f"max({g}) OVER (PARTITION BY episode_id) AS {g}" for g in spec.group_names)
    return f"""
  SELECT {EPISODE_COLS}, {', '.join(spec.group_names)} FROM (
    SELECT {EPISODE_COLS}, {maxes},
      row_number() OVER (PARTITION BY episode_id ORDER BY {order}) AS episode_row
    FROM {marked}) t
  WHERE episode_row = 1"""


def _with(ctes: list[tuple[str, str]], final: str) -> str:
    body = ",\n".join(f"{n} AS ({s}\n)" for n, s in ctes)
    return f"WITH {FIXTURE_CTES.strip()},\n{body}\n{final}" if ctes else f"WITH {FIXTURE_CTES.strip()}\n{final}"


def _episode_ctes(services=cat.SERVICES) -> list[tuple[str, str]]:
    out = []
    for s in services:
        n = s.name.lower()
        out.append((f"marked_{n}", marked_sql(s)))
        out.append((f"episodes_{n}", episodes_sql(s, f"marked_{n}")))
    return out


def _extract_cte(services=cat.SERVICES) -> tuple[str, str]:
    parts = []
    for s in services:
        sel = [f"CAST(NULL AS INTEGER) AS {g}" if g not in s.group_names else g for g in cat.ALL_GROUP_NAMES]
        parts.append(f"SELECT {EPISODE_COLS}, {', '.join(sel)} FROM episodes_{s.name.lower()}")
    return ("extract", "\n  " + "\n  UNION ALL ".join(parts))


def _covers(day: str) -> str:
    return f"bo.from_date <= DATE '{day}' AND (bo.to_date >= DATE '{day}' OR bo.to_date IS NULL)"


def _residence_ctes(cohort_from: str = "extract") -> list[tuple[str, str]]:
    cases = [f"CASE WHEN {_covers(f'{y}-01-01')} THEN bo.municipality END AS jan1_{y}" for y in YEARS]
    cases += [f"CASE WHEN {_covers(f'{y}-12-31')} THEN bo.municipality END AS dec31_{y}" for y in YEARS]
    maxes = [f"max(jan1_{y}) AS jan1_{y}" for y in YEARS] + [f"max(dec31_{y}) AS dec31_{y}" for y in YEARS]

    def clean(c):
        return f"nullif(nullif({c}, '9999'), '')"

    longs = [
        f"SELECT person_id, {y} AS year, coalesce({clean(f'jan1_{y}')}, {clean(f'dec31_{y}')}) AS municipality"
        f" FROM res_wide"
        for y in YEARS
    ]
    return [
        ("cohort", f"\n  SELECT DISTINCT person_id FROM {cohort_from}"),
        (
            "res_rows",
            f"\n  SELECT s.person_id, {', '.join(cases)}\n  FROM cohort s LEFT JOIN residence bo"
            f" ON s.person_id = CAST(bo.person_id AS VARCHAR)",
        ),
        ("res_wide", f"\n  SELECT person_id, {', '.join(maxes)} FROM res_rows GROUP BY person_id"),
        ("res_long", "\n  " + "\n  UNION ALL ".join(longs)),
        (
            "res_year",
            """
  SELECT person_id, year, municipality FROM (
    SELECT person_id, year,
      CASE WHEN length(municipality) < 4 THEN lpad(municipality, 4, '0') ELSE municipality END
        AS municipality
    FROM res_long WHERE municipality IS NOT NULL) t
  WHERE regexp_matches(municipality, '^[0-9]{4}$')""",
        ),
    ]


def _places_ctes() -> list[tuple[str, str]]:
    other = cat.PLACE_COLUMNS[1:]
    order = ", ".join(f"{c} NULLS LAST" for c in other)
    override_code = " ".join(f"WHEN kommunenr = {_q(a)} THEN {_q(b)}" for a, b, _ in cat.PLACE_OVERRIDES)
    override_name = " ".join(f"WHEN kommunenr = {_q(a)} THEN {_q(c)}" for a, _, c in cat.PLACE_OVERRIDES)
    return [
        (
            "places_prep",
            f"""
  SELECT kommunenr, kommunenavn,
    CASE WHEN kommunenr IS NULL THEN NULL {override_code} ELSE kommunenrdagens END AS kommunenrdagens,
    CASE WHEN kommunenr IS NULL THEN NULL {override_name} ELSE kommunenavndagens END AS kommunenavndagens,
    fylkenr, fylkenavn, fylkenrdagens, fylkenavndagens
  FROM (
    SELECT CASE WHEN length(k) < 4 THEN lpad(k, 4, '0') ELSE k END AS kommunenr,
      {', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in other)}
    FROM (SELECT DISTINCT CAST(kommunenr AS VARCHAR) AS k, {', '.join(other)} FROM places_raw) d
  ) p""",
        ),
        (
            "places",
            f"""
  SELECT {', '.join(cat.PLACE_COLUMNS)} FROM (
    SELECT *, row_number() OVER (PARTITION BY kommunenr ORDER BY {order}) AS rn FROM places_prep) t
  WHERE rn = 1""",
        ),
    ]


def _joined_cte(src: str = "extract") -> tuple[str, str]:
    levels = ", ".join(map(str, cat.CARE_LEVELS))
    return (
        "joined",
        f"""
  SELECT e.*, r.municipality FROM {src} e
  JOIN res_year r ON e.person_id = r.person_id AND e.year = r.year
  WHERE e.care_level IN ({levels}) AND e.year BETWEEN {START} AND {END}""",
    )


def _profile_final(spec: ServiceSpec, joined: str = "joined") -> str:
    counts = ", ".join(
        f"count(DISTINCT CASE WHEN {g} = 1 THEN person_id END) AS {g}" for g in spec.group_names
    )
    keys = {
        "year": "c.year", "municipality": "c.municipality", "sex": "c.sex", "age": "c.age",
    }
    cols = ", ".join(f"{keys.get(src, 'p.' + src)} AS {dst}" for src, dst in cat.PROFILE_KEY_HEADERS)
    return f"""
SELECT {cols}, {', '.join('c.' + g for g in spec.group_names)}
FROM (SELECT year, municipality, sex, age, {counts}
      FROM {joined} WHERE service = {_q(spec.name)}
      GROUP BY year, municipality, sex, age) c
LEFT JOIN places p ON p.kommunenr = c.municipality"""


def _services_values() -> str:
    rows = ", ".join(f"({_q(s.name)}, {_q(s.label)}, {i})" for i, s in enumerate(cat.SERVICES))
    return f"SELECT * FROM (VALUES {rows}) v(service, label, service_order)"


def build() -> dict[str, str]:
    o: dict[str, str] = {}
    all_marked = [(f"marked_{s.name.lower()}", marked_sql(s)) for s in cat.SERVICES]
    ep = _episode_ctes()
    extract = _extract_cte()
    res = _residence_ctes()
    flags_all = ", ".join(cat.ALL_GROUP_NAMES)

    # pieces
    parts = []
    for s in cat.SERVICES:
        sel = [
            f"CASE WHEN {group_sql('c.code', next(g for g in s.groups if g.name == n))} THEN 1 ELSE 0 END AS {n}"
            if n in s.group_names else f"CAST(NULL AS INTEGER) AS {n}"
            for n in cat.ALL_GROUP_NAMES
        ]
        parts.append(
            f"SELECT {_q(s.name)} AS service, c.stay_key, c.year, c.code, {', '.join(sel)}"
            f" FROM codes_all c WHERE c.service = {_q(s.name)} AND c.year BETWEEN {START} AND {END}"
            f" AND {selector_sql(s)} AND {cohort_sql('c.code', s)}"
        )
    o["code_group_flags"] = _with([], "\nUNION ALL\n".join(parts))

    o["valid_stays"] = _with([], "\nUNION ALL\n".join(
        f"SELECT {_q(s.name)} AS service, b.stay_key, b.year, b.person_id, b.sex, b.home_municipality,"
        f" b.care_level FROM stays_all b WHERE b.service = {_q(s.name)} AND {stay_filter_sql(s)}"
        for s in cat.SERVICES
    ))
    for kind, key in (("type", "main_diagnosis_type"), ("axis", "main_diagnosis_axis")):
        o[key] = _with([], "\nUNION ALL\n".join(
            f"SELECT {_q(s.name)} AS service, c.stay_key, c.year, c.code FROM codes_all c"
            f" WHERE c.service = {_q(s.name)} AND c.year BETWEEN {START} AND {END} AND {selector_sql(s)}"
            for s in cat.SERVICES if s.selector.kind == kind
        ))

    parts = []
    for s in cat.SERVICES:
        sel = [n if n in s.group_names else f"CAST(NULL AS INTEGER) AS {n}" for n in cat.ALL_GROUP_NAMES]
        parts.append(
            f"SELECT {_q(s.name)} AS service, c.stay_key, c.year, b.person_id, b.care_level,"
            f" b.home_municipality, {', '.join(sel)} FROM (SELECT c.stay_key, c.year, {flags_sql('c.code', s)}"
            f" FROM codes_all c WHERE c.service = {_q(s.name)} AND c.year BETWEEN {START} AND {END}"
            f" AND {selector_sql(s)} AND {cohort_sql('c.code', s)}) c"
            f" JOIN stays_all b ON b.stay_key = c.stay_key AND b.year = c.year"
            f" WHERE b.service = {_q(s.name)} AND {stay_filter_sql(s)}"
        )
    o["codes_join_stays"] = _with([], "\nUNION ALL\n".join(parts))

    parts = []
    for s in cat.SERVICES:
        sel = [n if n in s.group_names else f"CAST(NULL AS INTEGER) AS {n}" for n in cat.ALL_GROUP_NAMES]
        parts.append(f"SELECT stay_key, {EPISODE_COLS}, {', '.join(sel)} FROM marked_{s.name.lower()}")
    o["stays_person_attributes"] = _with(all_marked, "\nUNION ALL\n".join(parts))

    for s in cat.SERVICES:
        n = s.name.lower()
        o[f"episodes_{n}"] = _with(
            [(f"marked_{n}", marked_sql(s))],
            episodes_sql(s, f"marked_{n}"),
        )
    o["episodes_window_som"] = o["episodes_som"]

    base = ep + [extract]
    o["extract_from_service_folders"] = _with(base, f"SELECT {EPISODE_COLS}, {flags_all} FROM extract")
    o["extract_from_named_tables"] = o["extract_from_service_folders"]
    o["cohort_persons"] = _with(base, "SELECT DISTINCT person_id FROM extract")
    o["residence_by_year"] = _with(base + res, "SELECT person_id, year, municipality FROM res_year")
    o["residence_by_year_from_wide"] = o["residence_by_year"]
    o["residence_wide"] = _with(
        base + res[:3],
        "SELECT c.person_id, "
        + ", ".join(f"w.jan1_{y}" for y in YEARS) + ", "
        + ", ".join(f"w.dec31_{y}" for y in YEARS)
        + " FROM cohort c LEFT JOIN res_wide w ON c.person_id = w.person_id",
    )
    pl = _places_ctes()
    o["places_clean"] = _with(pl, f"SELECT {', '.join(cat.PLACE_COLUMNS)} FROM places")
    o["places_duplicates"] = _with(
        pl[:1],
        "SELECT kommunenr, count(*) AS n_rows FROM places_prep GROUP BY kommunenr HAVING count(*) > 1",
    )
    o["episodes_with_residence"] = _with(base + res + [_joined_cte()], "SELECT * FROM joined")

    for s in cat.SERVICES:
        n = s.name.lower()
        ctes = [(f"marked_{n}", marked_sql(s)), (f"episodes_{n}", episodes_sql(s, f"marked_{n}"))]
        o[f"profile_{n}"] = _with(
            ctes + _residence_ctes(f"episodes_{n}") + pl + [_joined_cte(f"episodes_{n}")],
            _profile_final(s),
        )

    sums = ", ".join(
        f"CAST(count(DISTINCT CASE WHEN {g} = 1 THEN person_id END) AS BIGINT) AS {g}"
        for g in cat.ALL_GROUP_NAMES
    )
    o["profiles_all_services"] = _with(
        base + res + pl + [_joined_cte()],
        f"""
SELECT c.municipality, c.service, c.year, c.sex, c.age, {', '.join('c.' + g for g in cat.ALL_GROUP_NAMES)},
  c.n_rows, {', '.join('p.' + c for c in cat.PLACE_COLUMNS[1:])}
FROM (SELECT service, year, municipality, sex, age, {sums}, count(*) AS n_rows
      FROM joined GROUP BY service, year, municipality, sex, age) c
LEFT JOIN places p ON p.kommunenr = c.municipality""",
    )

    # checks
    avt = cat.service("AVT")
    pre_rows = f"""
  SELECT c.stay_key, b.person_id, b.care_level FROM codes_all c
  JOIN stays_all b ON b.stay_key = c.stay_key AND b.year = c.year
  WHERE c.service = {_q(avt.name)} AND b.service = {_q(avt.name)}
    AND length(rtrim(b.person_id)) < {cat.MAX_ID_LENGTH}
    AND c.year BETWEEN {START} AND {END} AND {selector_sql(avt)} AND {cohort_sql('c.code', avt)}"""
    levels = ", ".join(map(str, cat.CARE_LEVELS))
    o["care_level_precheck"] = _with(
        [("pre", pre_rows)],
        f"""
SELECT care_level, status, count(*) AS n_code_rows, count(DISTINCT stay_key) AS n_stays,
       count(DISTINCT person_id) AS n_persons
FROM (SELECT *, CASE WHEN care_level IN ({levels}) THEN {_q(cat.STATUS_IN_EXTRACT)}
                      ELSE {_q(cat.STATUS_NOT_IN_EXTRACT)} END AS status
      FROM pre) t
GROUP BY care_level, status""",
    )
    o["included_totals"] = _with(
        [("pre", pre_rows)],
        f"SELECT count(DISTINCT stay_key) AS n_stays, count(DISTINCT person_id) AS n_persons"
        f" FROM pre WHERE care_level IN ({levels})",
    )
    o["persons_per_service_year"] = _with(
        base, "SELECT service, year, count(DISTINCT person_id) AS n_persons FROM extract GROUP BY service, year"
    )
    svc = ("services", "\n  " + _services_values())
    o["persons_per_service"] = _with(
        base + [svc],
        "SELECT s.service, CAST(coalesce(n.n_persons, 0) AS BIGINT) AS n_persons FROM services s"
        " LEFT JOIN (SELECT service, count(DISTINCT person_id) AS n_persons FROM extract GROUP BY service) n"
        " ON s.service = n.service",
    )
    o["year_span"] = _with(
        base + [svc],
        "SELECT s.service, n.min_year, n.max_year FROM services s LEFT JOIN"
        " (SELECT service, min(year) AS min_year, max(year) AS max_year FROM extract GROUP BY service) n"
        " ON s.service = n.service",
    )
    o["sex_distribution"] = _with(base, "SELECT service, sex, count(*) AS n FROM extract GROUP BY service, sex")
    o["care_level_distribution"] = _with(
        base, "SELECT service, care_level, count(*) AS n FROM extract GROUP BY service, care_level"
    )
    o["rule_violations"] = _with(
        base,
        f"SELECT service, count(*) AS n_invalid FROM extract"
        f" WHERE care_level NOT IN ({levels}) OR care_level IS NULL GROUP BY service",
    )
    o["stay_rule_violations"] = _with(
        [],
        f"SELECT service, count(*) AS n_invalid FROM stays_all"
        f" WHERE care_level NOT IN ({levels}) OR care_level IS NULL GROUP BY service",
    )
    o["residence_persons"] = _with(
        base + res[:3], "SELECT count(DISTINCT person_id) AS n_persons FROM cohort"
    )
    o["residence_preview"] = _with(
        base + res[:3],
        "SELECT c.person_id, "
        + ", ".join(f"w.jan1_{y}" for y in YEARS) + ", "
        + ", ".join(f"w.dec31_{y}" for y in YEARS)
        + " FROM cohort c LEFT JOIN res_wide w ON c.person_id = w.person_id ORDER BY c.person_id LIMIT 5",
    )
    o["control_table"] = _with(
        base + res + [_joined_cte(), svc],
        f"""
SELECT s.label AS service,
  CAST(coalesce(a.extract_rows, 0) AS BIGINT) AS extract_rows,
  CAST(coalesce(a.extract_persons, 0) AS BIGINT) AS extract_persons,
  CAST(coalesce(a.rows_care_level_1, 0) AS BIGINT) AS rows_care_level_1,
  CAST(coalesce(a.rows_care_level_2, 0) AS BIGINT) AS rows_care_level_2,
  CAST(coalesce(b.rows_with_residence, 0) AS BIGINT) AS rows_with_residence,
  CAST(coalesce(c.output_rows, 0) AS BIGINT) AS output_rows,
  c.min_year, c.max_year
FROM services s
LEFT JOIN (SELECT service, count(*) AS extract_rows, count(DISTINCT person_id) AS extract_persons,
                  count(*) FILTER (WHERE care_level = 1) AS rows_care_level_1,
                  count(*) FILTER (WHERE care_level = 2) AS rows_care_level_2
           FROM extract GROUP BY service) a ON a.service = s.service
LEFT JOIN (SELECT service, count(*) AS rows_with_residence FROM joined GROUP BY service) b
  ON b.service = s.service
LEFT JOIN (SELECT service, count(*) AS output_rows, min(year) AS min_year, max(year) AS max_year
           FROM (SELECT DISTINCT service, year, municipality, sex, age FROM joined) d
           GROUP BY service) c ON c.service = s.service""",
    )
    return o
