"""ANSI SQL side of the correctness check.

A query text may name any derived table, any dimension (``dim_<name>``) and the
shared helper tables below; ``complete`` puts the needed definitions in front.
"""

from __future__ import annotations

import re

from harmlens.functions import dims

VIEWS: dict[str, str] = {
    "lesions": """
SELECT p.p_type AS secteur_scian, CAST(year(l.l_shipdate) + 22 AS INT) AS annee,
  p.p_name AS nature_lesion, p.p_brand AS siege_lesion, CAST(l.l_linenumber AS STRING) AS genre,
  CASE WHEN l.l_linenumber = 7 THEN NULL ELSE o.o_orderpriority END AS agent_causal_lesion,
  CASE WHEN l.l_linestatus = 'F' THEN 'FEMME' ELSE 'HOMME' END AS sexe_pers_phys,
  CASE WHEN l.l_quantity <= 10 THEN '15-24' WHEN l.l_quantity <= 20 THEN '25-34'
       WHEN l.l_quantity <= 30 THEN '35-44' WHEN l.l_quantity <= 40 THEN '45-54' ELSE '55+' END AS groupe_age,
  CASE WHEN l.l_returnflag = 'R' THEN 'OUI' ELSE 'NON' END AS ind_lesion_tms,
  CASE WHEN l.l_discount > 0.095 THEN 'OUI' ELSE 'NON' END AS ind_lesion_psy,
  CASE WHEN l.l_tax > 0.075 AND year(l.l_shipdate) >= 1998 THEN 'OUI' ELSE 'NON' END AS ind_lesion_covid_19,
  CASE WHEN l.l_tax < 0.005 THEN 'OUI' ELSE 'NON' END AS ind_lesion_surdite,
  CASE WHEN l.l_linenumber = 3 THEN 'OUI' ELSE 'NON' END AS ind_lesion_machine,
  CAST(floor(l.l_quantity / CASE p.p_type WHEN 'ECONOMY' THEN 3 WHEN 'LARGE' THEN 4 WHEN 'MEDIUM' THEN 5
       WHEN 'PROMO' THEN 7 WHEN 'SMALL' THEN 2 ELSE 10 END) AS BIGINT) AS jours_perdus
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey""",
    "osha_raw": """
SELECT o.o_orderkey AS id, c.c_name AS establishment_name,
  CASE WHEN n.n_nationkey = 0 THEN NULL ELSE n.n_name END AS state,
  CASE c.c_mktsegment WHEN 'BUILDING' THEN '23' WHEN 'MACHINERY' THEN '31-33' WHEN 'HOUSEHOLD' THEN '62'
       WHEN 'AUTOMOBILE' THEN '48-49' ELSE NULL END AS naics_code,
  c.c_mktsegment AS industry_description, CAST(year(o.o_orderdate) + 22 AS INT) AS year_filing_for,
  o.o_totalprice AS total_hours_worked, CAST(o.o_orderkey % 7 AS BIGINT) AS total_injuries,
  CAST(CASE WHEN o.o_orderkey % 97 = 0 THEN 1 ELSE 0 END AS BIGINT) AS total_deaths,
  CAST(o.o_custkey % 31 AS BIGINT) AS days_away
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "esaw": """
SELECT CASE WHEN n.n_nationkey = 3 THEN NULL ELSE 'N' || CAST(n.n_nationkey AS STRING) END AS country_code,
  n.n_name AS country_name, CAST(c.c_custkey % 50 AS STRING) AS incident_count,
  CAST(2010 + c.c_custkey % 13 AS INT) AS year, CAST(c.c_custkey % 90 AS STRING) AS deviation
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "osha_records": """
SELECT CAST(l.l_orderkey AS STRING) AS id, CAST(l.l_partkey % 600 AS STRING) AS event_type,
  CAST(100 + l.l_suppkey * 7 % 500 AS STRING) AS nature, CAST(l.l_partkey % 60 AS STRING) AS body_part,
  CASE l.l_linenumber WHEN 1 THEN '23' WHEN 2 THEN '23821' WHEN 3 THEN '221122' WHEN 4 THEN '62'
       WHEN 5 THEN '484' WHEN 6 THEN '236' ELSE '99' END AS naics_code
FROM lineitem l""",
    "cnesst_lesions": """
SELECT annee, CASE secteur_scian WHEN 'ECONOMY' THEN '23' WHEN 'LARGE' THEN '31-33' WHEN 'MEDIUM' THEN '62'
    WHEN 'PROMO' THEN '48-49' WHEN 'SMALL' THEN '221122' ELSE '21' END AS scian,
  CASE genre WHEN '1' THEN '31' WHEN '2' THEN '42' WHEN '3' THEN '50' WHEN '4' THEN '51' WHEN '5' THEN '52'
    WHEN '6' THEN '60' ELSE '72' END AS genre_accident,
  CASE groupe_age WHEN '15-24' THEN '10' WHEN '25-34' THEN '20' WHEN '35-44' THEN '30' WHEN '45-54' THEN '40'
    ELSE '50' END AS nature_lesion,
  CAST(COUNT(*) AS BIGINT) AS nombre_lesions, CAST(SUM(jours_perdus) AS BIGINT) AS jours_perdus
FROM lesions GROUP BY 1, 2, 3, 4""",
    "osha_injuries": """
SELECT year_filing_for AS year, naics_code AS naics, industry_description,
  CAST(SUM(total_injuries) AS BIGINT) AS total_cases, CAST(SUM(total_deaths) AS BIGINT) AS total_deaths,
  CAST(SUM(days_away) AS BIGINT) AS days_away
FROM osha_raw WHERE naics_code IS NOT NULL GROUP BY 1, 2, 3""",
    "incidents_global": """
SELECT 'OSHA' AS source, 'USA' AS jurisdiction, CAST(id AS STRING) AS incident_id, year_filing_for AS year,
  naics_code AS industry_code, CASE WHEN total_deaths > 0 THEN 'fatal' ELSE 'non-fatal' END AS incident_type,
  CAST(days_away AS DOUBLE) AS days_lost FROM osha_raw
UNION ALL
SELECT 'CNESST', 'Quebec', genre || '-' || siege_lesion, annee, secteur_scian,
  CASE WHEN ind_lesion_psy = 'OUI' THEN 'illness' ELSE 'non-fatal' END, CAST(jours_perdus AS DOUBLE) FROM lesions""",
}

_DIMENSIONS = {
    "dim_" + name.lower(): value for name, value in vars(dims).items() if isinstance(value, dims.Dimension)
}


def flag(name: str) -> str:
    column = {"covid": "ind_lesion_covid_19"}.get(name, f"ind_lesion_{name}")
    return f"CAST(COUNT(*) FILTER (WHERE {column} = 'OUI') AS BIGINT)"


def ratio(num: str, den: str, scale: int = 1, places: int = 2) -> str:
    """``round(scale * num / den, places)``, half away from zero, on integers."""
    factor = 2 * scale * 10**places
    n, d = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)"
    return f"(CAST(({n} * {factor} + {d}) // (2 * NULLIF({d}, 0)) AS DOUBLE) / {10**places})"


def percent(num: str, den: str) -> str:
    return ratio(num, den, scale=100, places=2)


_ALL_FLAGS = ", ".join(f"{flag(f)} AS {f}" for f in ("tms", "psy", "covid", "surdite", "machine"))

HELPERS: dict[str, str] = {
    # counts by sector and year, by sector, and for the whole province
    "sector_year": f"SELECT secteur_scian, annee, COUNT(*) AS n, {_ALL_FLAGS} FROM lesions GROUP BY 1, 2",
    "sector_total": f"SELECT secteur_scian, COUNT(*) AS n, {_ALL_FLAGS}, MIN(annee) AS annee_min, "
                    "MAX(annee) AS annee_max FROM lesions GROUP BY 1",
    "province": f"SELECT COUNT(*) AS n, {_ALL_FLAGS} FROM lesions",
    "sector_rate": "SELECT *, " + ", ".join(
        f"{percent(f, 'n')} AS pct_{f}" for f in ("tms", "psy", "machine", "surdite")) + " FROM sector_total",
    "province_rate": "SELECT *, " + ", ".join(
        f"{percent(f, 'n')} AS pct_{f}" for f in ("tms", "psy", "machine", "surdite")) + " FROM province",
}


def complete(sql: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``sql`` with the tables it uses, dependencies first."""
    known = {**VIEWS, **HELPERS, **{k: dims.values_sql(v) for k, v in _DIMENSIONS.items()}, **(extra or {})}
    ordered: list[str] = []

    def visit(text: str, seen: tuple[str, ...]) -> None:
        for word in dict.fromkeys(re.findall(r"\b[a-z_][a-z_0-9]*\b", text)):
            if word in known and word not in ordered and word not in seen:
                visit(known[word], (*seen, word))
                ordered.append(word)

    visit(sql, ())
    if not ordered:
        return sql
    return "WITH " + ",\n".join(f"{name} AS ({known[name]})" for name in ordered) + "\n" + sql.strip()
