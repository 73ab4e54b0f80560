"""Queries G01-G19, J10-J15, X01-X02: graphs and streams."""

from datetime import date

from pyspark.sql import functions as F

from harmlens.functions import dims
from harmlens.functions.dims import Dimension
from harmlens.functions.exprs import row_count
from harmlens.operators import aggregates as agg
from harmlens.operators import graph as gr
from harmlens.operators import harmonize as har
from harmlens.operators import lookups as lk
from harmlens.operators import warehouse as wh
from harmlens.operators.containment import contained_keys
from harmlens.operators.paths import paths_from_both_ends
from harmlens.plans.oracle import percent
from harmlens.plans.q_harmonize import PARTS as HPARTS
from harmlens.plans.q_harmonize import esaw_input
from harmlens.plans.registry import query
from harmlens.streaming import ingest
from harmlens.workspace import scratch_path, stored

DAY = date(2024, 1, 1)

# Test dimensions: norms with the domain they cover, where they apply, and watching agents.
NORM = Dimension(("code", "id", "titre", "obligatoire", "domain"), (
    ("RSST-51", "N1", "Travaux electriques", True, "ELEC"), ("RSST-312", "N2", "Travail en hauteur", True, "CHUTE"),
    ("RSST-166", "N3", "Cadenassage", True, "MACHINE"), ("LSST-51", "N4", "Droit de refus", True, "AUTRE"),
    ("ISO-45001", "N5", "Management SST", False, "AUTRE"), ("29CFR1910.147", "N6", "Lockout/Tagout", True, "MACHINE"),
    ("29CFR1926.501", "N7", "Fall Protection", True, "CHUTE"), ("CSA-Z462", "N8", "Securite electrique", True, "ELEC")))
APPLIES = Dimension(("norm", "jurisdiction"), (
    ("RSST-51", "QC"), ("RSST-312", "QC"), ("RSST-166", "QC"), ("LSST-51", "QC"), ("ISO-45001", "INT"), ("29CFR1910.147", "US"),
    ("CSA-Z462", "CA"), ("CSA-Z462", "QC")))
AGENTS = Dimension(("id", "type", "sector_coverage"), (
    ("A1", "specialist", "23,31-33"), ("A2", "specialist", "62"), ("A3", "generalist", ""), ("A4", "specialist", "48-49,62")))
LITERALS = {"norms": dims.values_sql(NORM), "applies": dims.values_sql(APPLIES), "agents": dims.values_sql(AGENTS)}
PARTS = {**HPARTS, **LITERALS, "risks": "SELECT DISTINCT * FROM osha_unified", "esaw_risks": "SELECT DISTINCT * FROM esaw_unified"}


def norms(t):
    return dims.frame(t.spark, NORM)


def norm_domain(t):
    return norms(t).select(F.col("code").alias("norm"), "domain")


def applies(t):
    return dims.frame(t.spark, APPLIES)


def osha_risks(t):
    return gr.risk_rows(har.transform_osha(t.osha_records, DAY))


def esaw_risks(t):
    return gr.risk_rows(har.transform_esaw(esaw_input(t), DAY))


@query("g01_initialize", """
SELECT 'DomaineRisque' AS label, code AS key, nom_fr, nom_en, niveau_danger AS niveau, NULL AS type FROM dim_risk_domain
UNION ALL SELECT 'Juridiction', code, nom_fr, nom_en, NULL, type FROM dim_jurisdiction
UNION ALL SELECT DISTINCT 'Secteur', naics_code, NULL, NULL, NULL, 'SCIAN' FROM osha_records""", **PARTS)
def _(t):
    blank = {"nom_fr": F.lit(None).cast("string"), "nom_en": F.lit(None).cast("string"), "niveau": F.lit(0)}
    known = lk.osha_event(t.osha_records, prefix="").select("domain").distinct().select(F.lit("DomaineRisque").alias("label"), F.col("domain").alias("key"))
    sectors = t.osha_records.select("naics_code").distinct().select(F.lit("Secteur").alias("label"), F.col("naics_code").alias("key"))
    existing = known.withColumns({**blank, "type": F.lit(None).cast("string")}).unionByName(
        sectors.withColumns({**blank, "niveau": F.lit(None).cast("int"), "type": F.lit("SCIAN")}))
    return gr.initialize(existing)


@query("g02_risk_nodes", """
SELECT risk_id AS id, CASE WHEN risk_id < '8' THEN 'old' ELSE risk_code END AS code, title_en AS titre_en, CAST(0 AS BIGINT) AS total_incidents, CASE WHEN risk_id < '8' THEN 'ARCHIVED' ELSE 'ACTIVE' END AS statut
FROM risks""", **PARTS)
def _(t):
    rows = stored(osha_risks(t), "risks")  # read twice
    old = rows.filter("id < '8'").select("id", F.lit("old").alias("code"), F.lit("old").alias("titre_fr"), F.lit("old").alias("titre_en"),
                                         F.lit(-1).cast("bigint").alias("total_incidents"), F.lit("ARCHIVED").alias("statut"))
    return gr.merge_risks(old, rows).drop("titre_fr")


@query("g02_risk_edges", """
SELECT rel, dst_label, dst, COUNT(*) AS n FROM (SELECT 'APPARTIENT_A' AS rel, 'DomaineRisque' AS dst_label, domain AS dst FROM risks
  UNION ALL SELECT 'LOCALISE_DANS', 'Juridiction', 'US' FROM risks UNION ALL SELECT 'DANS_SECTEUR', 'Secteur', scian FROM risks) GROUP BY ALL""", **PARTS)
def _(t):
    return agg.counts_by(gr.risk_edges(gr.edge_rows(har.transform_osha(t.osha_records, DAY))), ["rel", "dst_label", "dst"])


@query("j10_link_existing_nodes", """
SELECT country, COUNT(*) AS n FROM esaw_risks WHERE country IN (SELECT code FROM dim_jurisdiction) GROUP BY 1""", **PARTS)
def _(t):
    return agg.counts_by(gr.link(esaw_risks(t), "country", dims.frame(t.spark, dims.JURISDICTION), "code"), ["country"])


@query("g03_link_standards", """
SELECT r.risk_id, n.code AS norm FROM (SELECT risk_id, CASE domain WHEN 'ELEC' THEN 'Z462' WHEN 'CHUTE' THEN '19' ELSE 'RSST' END AS wanted FROM esaw_risks
  WHERE domain <> 'AUTRE') r JOIN norms n ON contains(n.code, r.wanted) OR contains(n.id, r.wanted)""", **PARTS)
def _(t):
    code = F.when(F.col("domain_code") == "ELEC", "Z462").when(F.col("domain_code") == "CHUTE", "19").otherwise("RSST")
    wanted = esaw_risks(t).filter("domain_code <> 'AUTRE'").select(F.col("id").alias("risk_id"), code.alias("code"))
    return gr.link_standards(wanted, norms(t))


AUTO = """SELECT r.risk_id, n.code AS norm FROM esaw_risks r JOIN norms n ON n.domain = r.domain WHERE NOT (r.risk_id < '8' AND n.id IN ('N1', 'N2'))"""


def auto_links(t):
    risks = esaw_risks(t).select(F.col("id").alias("risk_id"), F.col("domain_code").alias("domain"))
    pairs = risks.join(F.broadcast(norm_domain(t)), "domain")
    linked = pairs.filter("risk_id < '8' AND norm IN ('RSST-51', 'RSST-312')").select("risk_id", "norm")
    return gr.auto_link(risks, norm_domain(t), linked).drop("auto_linked")


@query("g04_auto_link", "SELECT * FROM links", links=AUTO, **PARTS)
def _(t):
    return auto_links(t)


@query("j11_anti_link", "SELECT norm, COUNT(*) AS n FROM links GROUP BY 1", links=AUTO, **PARTS)
def _(t):
    return agg.counts_by(auto_links(t), ["norm"])


@query("g05_risks_by_domain", """
SELECT risk_id AS id, risk_code AS code, CASE source_code WHEN '51' THEN 'Chute de hauteur' ELSE 'Chute de plain-pied' END AS titre, incidents, source_system AS source FROM esaw_risks
WHERE domain = 'CHUTE' ORDER BY incidents DESC, risk_id LIMIT 100""", **PARTS)
def _(t):
    return gr.risks_by_domain(esaw_risks(t), "CHUTE")


NORMS_OF = """SELECT l.risk_id, n.code, n.titre, n.obligatoire, COALESCE((SELECT string_agg(jurisdiction, '|' ORDER BY jurisdiction) FROM applies a WHERE a.norm = n.code), '') AS juridictions
FROM links l JOIN norms n ON n.code = l.norm"""


@query("g06_standards_for_risks", NORMS_OF, links=AUTO, **PARTS)
def _(t):
    out = gr.standards_for_risks(auto_links(t), norms(t), applies(t))
    return out.withColumn("juridictions", F.array_join("juridictions", "|"))


@query("j12_optional_match", "SELECT code, juridictions, COUNT(*) AS n FROM rows_of GROUP BY 1, 2", rows_of=NORMS_OF, links=AUTO, **PARTS)
def _(t):
    out = gr.standards_for_risks(auto_links(t), norms(t), applies(t)).withColumn("juridictions", F.array_join("juridictions", "|"))
    return agg.counts_by(out, ["code", "juridictions"])


@query("j13_containment_join", """
SELECT a.id AS item, r.naics_code, COUNT(*) AS n FROM osha_records r JOIN agents a ON contains(a.sector_coverage, r.naics_code) GROUP BY 1, 2""", **PARTS)
def _(t):
    index = gr.containment_index(dims.frame(t.spark, AGENTS), "id", ["sector_coverage"])
    return agg.counts_by(gr.containment_join(t.osha_records, "naics_code", index), ["item", "naics_code"])


LONG_KEYS = """SELECT DISTINCT unnest(string_split(p_name, ' ')) AS key FROM part UNION SELECT substr(text, 1, 9) FROM benchmark WHERE text IS NOT NULL
UNION SELECT substr(text, 1, 9) FROM conversations WHERE text IS NOT NULL"""


@query("j13_long_lists", "SELECT key, COUNT(*) AS n, MIN(doc_id) AS first, MAX(doc_id) AS last FROM keys JOIN documents ON contains(text, key) GROUP BY 1", keys=LONG_KEYS)
def _(t):
    """Words of part names and beginnings of texts, in whole documents."""
    begins = [t.base(name).select(F.substring("text", 1, 9).alias("key")) for name in ("benchmark", "conversations")]
    keys = t.base("part").select(F.explode(F.split("p_name", " ")).alias("key")).unionByName(begins[0]).unionByName(begins[1])
    pairs = contained_keys(t.base("documents"), "doc_id", "text", keys, "key")
    return pairs.groupBy("key").agg(row_count().alias("n"), F.min("item").alias("first"), F.max("item").alias("last"))


# Trade graph: nation - supplier - customer - nation, over all order lines.
TRADE = """SELECT DISTINCT 'S' || CAST(l.l_suppkey AS STRING) AS a, 'C' || CAST(o.o_custkey AS STRING) AS b FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
UNION SELECT 'S' || CAST(s_suppkey AS STRING), 'N' || CAST(s_nationkey AS STRING) FROM supplier
UNION SELECT 'C' || CAST(c_custkey AS STRING), 'N' || CAST(c_nationkey AS STRING) FROM customer
UNION SELECT 'N' || CAST(n_nationkey AS STRING), 'R' || CAST(n_regionkey AS STRING) FROM nation"""
HOPS = {"both_ways": "SELECT a, b FROM trade UNION SELECT b, a FROM trade", "trade": TRADE,
        "hop1": "SELECT DISTINCT a AS source, b AS node FROM both_ways WHERE a LIKE 'N1%'"}
for i in range(2, 6):
    HOPS[f"hop{i}"] = f"SELECT DISTINCT h.source, e.b AS node FROM hop{i - 1} h JOIN both_ways e ON e.a = h.node"
PATH_SQL = "SELECT source, node AS target, MIN(d) AS path_length FROM (" + " UNION ALL ".join(
    f"SELECT source, node, {i} AS d FROM hop{i}" for i in range(1, 6)) + ") WHERE node LIKE 'N%' AND node <> source GROUP BY 1, 2"
# the same with the path: each hop keeps the smallest path to a node not reached before
WALKS = {"both_ways": HOPS["both_ways"], "trade": TRADE, "walk0": "SELECT DISTINCT a AS source, a AS node, [a] AS path FROM both_ways WHERE a LIKE 'N1%'"}
for i in range(1, 6):
    before = " UNION ALL ".join(f"SELECT source, node FROM walk{k}" for k in range(i))
    WALKS[f"walk{i}"] = f"""SELECT w.source, e.b AS node, MIN(list_append(w.path, e.b)) AS path FROM walk{i - 1} w JOIN both_ways e ON e.a = w.node
WHERE (w.source, e.b) NOT IN ({before}) GROUP BY 1, 2"""
WALK_SQL = "SELECT source, node AS target, array_to_string(path, '>') AS path, len(path) - 1 AS path_length FROM (" + " UNION ALL ".join(
    f"SELECT * FROM walk{i}" for i in range(1, 6)) + ") WHERE node LIKE 'N%' AND node <> source"


def trade_edges(t):
    tag = lambda letter, c: F.concat(F.lit(letter), F.col(c).cast("string"))
    sales = t.base("lineitem").join(t.base("orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(tag("S", "l_suppkey").alias("a"), tag("C", "o_custkey").alias("b"))
    home = t.base("supplier").select(tag("S", "s_suppkey").alias("a"), tag("N", "s_nationkey").alias("b"))
    buyers = t.base("customer").select(tag("C", "c_custkey").alias("a"), tag("N", "c_nationkey").alias("b"))
    regions = t.base("nation").select(tag("N", "n_nationkey").alias("a"), tag("R", "n_regionkey").alias("b"))
    return gr.merged_edges(sales, home, buyers, regions)


def nation_paths(t, search=gr.shortest_paths):
    nodes = t.base("nation").select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("node"))
    return search(trade_edges(t), nodes.filter(F.col("node").startswith("N1")), nodes)


@query("g07_concordance_path", WALK_SQL, **WALKS)
def _(t):
    return nation_paths(t).withColumn("path", F.array_join("path", ">"))


@query("g07_both_ends", same_as="g07_concordance_path")
def _(t):
    return nation_paths(t, paths_from_both_ends).withColumn("path", F.array_join("path", ">"))


@query("j15_shortest_path", f"SELECT path_length, COUNT(*) AS n FROM ({PATH_SQL}) GROUP BY 1", **HOPS)
def _(t):
    return agg.counts_by(nation_paths(t), ["path_length"])


EXPOSED = "SELECT DISTINCT naics_code AS sector, domain FROM ev"
RECOMMENDED = """SELECT DISTINCT w.sector, w.jurisdiction, n.code AS norme_code, n.titre AS norme_titre, n.obligatoire, d.code AS domaine_code, d.nom_fr AS domaine_nom, a.jurisdiction AS juridiction
FROM (SELECT DISTINCT naics_code AS sector, j AS jurisdiction FROM osha_records, (VALUES ('QC'), ('US')) v(j)) w JOIN exposed e ON e.sector = w.sector
JOIN norms n ON n.domain = e.domain JOIN applies a ON a.norm = n.code JOIN dim_risk_domain d ON d.code = e.domain
WHERE a.jurisdiction = w.jurisdiction OR a.jurisdiction = 'INT' OR (w.jurisdiction IN ('QC', 'ON') AND a.jurisdiction = 'CA')"""


def recommended(t):
    coded = lk.osha_event(t.osha_records, prefix="").select(F.col("naics_code").alias("sector"), "domain").distinct()
    wanted = t.osha_records.select(F.col("naics_code").alias("sector")).distinct().select("sector", F.explode(F.array(F.lit("QC"), F.lit("US"))).alias("jurisdiction"))
    return gr.recommended_norms(coded, norm_domain(t), applies(t), norms(t), wanted)


@query("g08_recommended_norms", "SELECT * FROM rec", rec=RECOMMENDED, exposed=EXPOSED, **PARTS)
def _(t):
    return recommended(t)


@query("j14_hierarchical_match", "SELECT jurisdiction, juridiction, COUNT(*) AS n FROM rec GROUP BY 1, 2", rec=RECOMMENDED, exposed=EXPOSED, **PARTS)
def _(t):
    return agg.counts_by(recommended(t), ["jurisdiction", "juridiction"])


RISK_GRAPH = """SELECT 'Risque' AS element, COUNT(*) AS n FROM risks UNION ALL SELECT 'DomaineRisque', COUNT(*) FROM dim_risk_domain UNION ALL SELECT 'Juridiction', COUNT(*) FROM dim_jurisdiction
UNION ALL SELECT 'Secteur', COUNT(DISTINCT scian) FROM risks WHERE scian <> '' UNION ALL SELECT 'relations', 2 * COUNT(*) + COUNT(NULLIF(scian, '')) FROM risks"""


def risk_graph_counts(t):
    rows = stored(osha_risks(t), "risks")  # read three times
    nodes = rows.select(F.lit("Risque").alias("label")).unionByName(gr.base_nodes(t.spark).select("label")).unionByName(gr.sector_nodes(rows).select(F.lit("Secteur").alias("label")))
    return gr.label_counts(nodes, gr.risk_edges(rows))


@query("g09_label_counts", "SELECT * FROM counted", counted=RISK_GRAPH, **PARTS)
def _(t):
    return risk_graph_counts(t)


@query("g09_verify_schema", """
SELECT v.required, COALESCE(c.n, 0) AS n, COALESCE(c.n, 0) > 0 AS passed FROM (VALUES ('DomaineRisque'), ('Norme')) v(required) LEFT JOIN counted c ON c.element = v.required""",
       counted=RISK_GRAPH, **PARTS)
def _(t):
    return gr.integrity(risk_graph_counts(t), ["DomaineRisque", "Norme"])


SECTOR_NODES = """SELECT 'Sector' AS labels, secteur_scian AS key, secteur_scian AS name, 'QC' AS jurisdiction, NULL AS total FROM sector_total
UNION ALL SELECT 'IncidentStats', 'QC-' || secteur_scian || '-' || CAST(annee AS STRING), 'QC-' || secteur_scian || '-' || CAST(annee AS STRING), 'QC', n FROM sector_year"""
STATE_NODES = """SELECT 'State|Sector', 'USA-' || state, state, 'USA', n FROM (SELECT state, COUNT(*) AS n FROM osha_raw WHERE state IS NOT NULL GROUP BY 1)"""
COUNTRY_NODES = """SELECT 'Country|Sector', 'EU-' || country_code, MIN(country_name), 'EU27', COUNT(*) FROM esaw WHERE country_code IS NOT NULL GROUP BY country_code"""
BASE_NODES = """SELECT 'Jurisdiction', code, name, NULL, NULL FROM dim_stat_jurisdiction UNION ALL SELECT 'Year', CAST(y AS STRING), CAST(y AS STRING), NULL, NULL FROM (SELECT y FROM range(2010, 2024) r(y) UNION SELECT annee FROM sector_year)"""
SECTOR_EDGES = """SELECT 'HAS_STATS' AS rel, 'Sector' AS src_label, secteur_scian AS src, 'IncidentStats' AS dst_label, 'QC-' || secteur_scian || '-' || CAST(annee AS STRING) AS dst FROM sector_year
UNION ALL SELECT 'IN_YEAR', 'IncidentStats', 'QC-' || secteur_scian || '-' || CAST(annee AS STRING), 'Year', CAST(annee AS STRING) FROM sector_year
UNION ALL SELECT 'IN_JURISDICTION', 'IncidentStats', 'QC-' || secteur_scian || '-' || CAST(annee AS STRING), 'Jurisdiction', 'QC' FROM sector_year"""
ALL_NODES = f"SELECT * FROM ({SECTOR_NODES}) UNION ALL SELECT * FROM ({STATE_NODES}) UNION ALL SELECT * FROM ({COUNTRY_NODES}) UNION ALL SELECT * FROM ({BASE_NODES})"
ALL_EDGES = f"""SELECT * FROM ({SECTOR_EDGES}) UNION ALL SELECT 'IN_JURISDICTION', 'State', key, 'Jurisdiction', 'USA' FROM all_nodes WHERE labels = 'State|Sector'
UNION ALL SELECT 'IN_JURISDICTION', 'Country', key, 'Jurisdiction', 'EU27' FROM all_nodes WHERE labels = 'Country|Sector'"""
SPARTS = {"all_nodes": ALL_NODES, "all_edges": ALL_EDGES}


def stat_graph(t):
    counts = agg.sector_year_graph_stats(t.lesions)
    sector = gr.sector_graph(counts)
    state = gr.state_graph(agg.state_totals(t.osha_raw))
    country = gr.country_graph(agg.country_totals(t.esaw))
    return (gr.union_all(sector[0], state[0], country[0], gr.stat_base_nodes(t.spark, counts)), gr.union_all(sector[1], state[1], country[1]))


def _labels(nodes):
    return nodes.withColumn("labels", F.array_join("labels", "|"))


@query("g10_base_nodes", f"SELECT * FROM ({BASE_NODES}) b(labels, key, name, jurisdiction, total) UNION ALL SELECT * FROM ({SECTOR_NODES}) WHERE labels = 'Sector'", **SPARTS)
def _(t):
    counts = agg.sector_year_graph_stats(t.lesions)
    sectors = gr.sector_graph(counts)[0].filter(F.array_contains("labels", "Sector"))
    return _labels(wh.seed_missing(sectors, gr.stat_base_nodes(t.spark, counts), ["key"]))


@query("g11_sector_nodes", f"""SELECT n.labels, n.key, n.name, n.jurisdiction, n.total, s.tms_rate FROM ({SECTOR_NODES}) n LEFT JOIN (SELECT 'QC-' || secteur_scian || '-' || CAST(annee AS STRING) AS k,
  {percent('tms', 'n')} AS tms_rate FROM sector_year) s ON s.k = n.key""")
def _(t):
    counts = agg.sector_year_graph_stats(t.lesions)
    attributes = gr.stats_attributes(counts).select(F.col("id").alias("key"), "tms_rate")
    return _labels(gr.sector_graph(counts)[0]).join(attributes, "key", "left")


@query("g11_sector_edges", SECTOR_EDGES)
def _(t):
    return gr.sector_graph(agg.sector_year_graph_stats(t.lesions))[1]


LONG = """SELECT 'TRANSPORT ET ENTREPOSAGE ' || secteur_scian AS s, annee + 12 AS y, n FROM sector_year"""


@query("g11_long_sectors", """
SELECT 'node' AS kind, 'QC-' || s || '-' || CAST(y AS STRING) AS key, CAST(n AS STRING) AS detail FROM long_sectors
UNION ALL SELECT 'IN_YEAR', 'QC-' || s || '-' || CAST(y AS STRING), CAST(y AS STRING) FROM long_sectors
UNION ALL SELECT 'year', CAST(y AS STRING), NULL FROM (SELECT y FROM range(2010, 2024) r(y) UNION SELECT y FROM long_sectors)""", long_sectors=LONG)
def _(t):
    # Names that agree in more than 20 characters, and years later than any that is set up.
    counts = agg.sector_year_graph_stats(t.lesions).withColumns({
        "secteur": F.concat(F.lit("TRANSPORT ET ENTREPOSAGE "), F.col("secteur")), "annee": F.col("annee") + 12})
    nodes, edges = gr.sector_graph(counts)
    stats = nodes.filter(F.array_contains("labels", "IncidentStats")).select(F.lit("node").alias("kind"), "key", F.col("total").cast("string").alias("detail"))
    dated = edges.filter("rel = 'IN_YEAR'").select(F.lit("IN_YEAR").alias("kind"), F.col("src").alias("key"), F.col("dst").alias("detail"))
    years = gr.stat_base_nodes(t.spark, counts).filter(F.array_contains("labels", "Year")).select(F.lit("year").alias("kind"), "key", F.lit(None).cast("string").alias("detail"))
    return stats.unionByName(dated).unionByName(years)


@query("g12_state_graph", f"SELECT * FROM ({STATE_NODES}) s(labels, key, name, jurisdiction, total)")
def _(t):
    return _labels(gr.state_graph(agg.state_totals(t.osha_raw))[0])


@query("g13_country_graph", f"SELECT * FROM ({COUNTRY_NODES}) s(labels, key, name, jurisdiction, total)")
def _(t):
    return _labels(gr.country_graph(agg.country_totals(t.esaw))[0])


@query("g14_nodes_per_label", "SELECT label, COUNT(*) AS total FROM (SELECT unnest(string_split(labels, '|')) AS label FROM all_nodes) GROUP BY 1", **SPARTS)
def _(t):
    return gr.nodes_per_label(stat_graph(t)[0])


@query("g15_graph_totals", """
SELECT (SELECT COUNT(*) FROM all_nodes) AS total_nodes, (SELECT COUNT(*) FROM all_edges) AS total_relationships, 'Country|IncidentStats|Jurisdiction|Sector|State|Year' AS labels""", **SPARTS)
def _(t):
    return gr.graph_totals(*stat_graph(t)).withColumn("labels", F.array_join("labels", "|"))


@query("g15_jurisdiction_entities", """
SELECT d.code, d.name, (SELECT COUNT(*) FROM all_edges e WHERE e.rel = 'IN_JURISDICTION' AND e.dst = d.code) AS entities FROM dim_stat_jurisdiction d""", **SPARTS)
def _(t):
    return gr.jurisdiction_entities(*stat_graph(t))


@query("g15_sectors_of", """
SELECT key AS code, name, jurisdiction FROM all_nodes WHERE labels LIKE '%Sector' AND jurisdiction = 'EU27' ORDER BY key LIMIT 50""", **SPARTS)
def _(t):
    return gr.sectors_of(stat_graph(t)[0], "EU27")


INCIDENTS = """SELECT 'incident:osha:' || CAST(id AS STRING) AS incident_uri, 'USA-OSHA' AS jurisdiction, naics_code AS sector_code, industry_description AS sector_name, naics_code AS scian_code,
  CASE WHEN total_deaths > 0 THEN 'FATAL' WHEN days_away > 20 THEN 'SEVERE' ELSE 'MINOR' END AS injury_type, establishment_name AS description FROM osha_raw"""
INCIDENT_EDGES = """SELECT 'Incident' AS src_label, incident_uri AS src, 'OCCURRED_IN' AS rel, 'Jurisdiction' AS dst_label, jurisdiction AS dst FROM incidents
UNION ALL SELECT 'Incident', incident_uri, 'IN_SECTOR', 'Sector', sector_code FROM incidents WHERE sector_code IS NOT NULL
UNION ALL SELECT 'Incident', incident_uri, 'HAS_INJURY', 'LesionType', injury_type FROM incidents
UNION ALL SELECT 'Agent', a.id, 'MONITORS', 'Incident', i.incident_uri FROM incidents i JOIN agents a ON contains(a.sector_coverage, i.scian_code)"""
INCIDENT_NODES = """SELECT 'Jurisdiction' AS label, jurisdiction AS key, 'United States' AS name FROM incidents GROUP BY 2 UNION ALL SELECT 'Sector', sector_code, MIN(sector_name) FROM incidents WHERE sector_code IS NOT NULL GROUP BY 2
UNION ALL SELECT 'LesionType', injury_type, lower(injury_type) FROM incidents GROUP BY 2 UNION ALL SELECT 'Incident', incident_uri, MIN(description) FROM incidents GROUP BY 2"""
IPARTS = {**LITERALS, "incidents": INCIDENTS, "incident_edges": INCIDENT_EDGES, "incident_nodes": INCIDENT_NODES}


def incidents(t):
    kind = F.when(F.col("total_deaths") > 0, "FATAL").when(F.col("days_away") > 20, "SEVERE").otherwise("MINOR")
    return t.osha_raw.select(
        F.concat(F.lit("incident:osha:"), F.col("id").cast("string")).alias("incident_uri"), F.lit("USA-OSHA").alias("jurisdiction"),
        F.lit("United States").alias("jurisdiction_name"), F.col("naics_code").alias("sector_code"), F.col("industry_description").alias("sector_name"),
        F.col("naics_code").alias("scian_code"), kind.alias("injury_type"), F.lower(kind).alias("injury_name"), F.col("establishment_name").alias("description"))


def agents(t):
    return dims.frame(t.spark, AGENTS)


@query("g16_incident_nodes", "SELECT label, key, name, 'osha' AS source FROM incident_nodes", **IPARTS)
def _(t):
    return gr.incident_graph(incidents(t), agents(t), "osha")[0]


@query("g16_incident_edges", "SELECT * FROM incident_edges", **IPARTS)
def _(t):
    return gr.incident_graph(incidents(t), agents(t), "osha")[1]


@query("g17_triples_graph", """
SELECT 'entity' AS kind, COUNT(*) AS n FROM (SELECT src AS uri FROM incident_edges UNION SELECT dst FROM incident_edges)
UNION ALL SELECT rel, COUNT(*) FROM (SELECT DISTINCT src, rel, dst FROM incident_edges) GROUP BY 1""", **IPARTS)
def _(t):
    edges = gr.incident_graph(incidents(t), agents(t), "osha")[1]
    triples = edges.select(F.col("src").alias("subject"), F.col("rel").alias("predicate"), F.col("dst").alias("object"))
    entities, typed = gr.triples_graph(triples.unionByName(triples))
    return entities.agg(F.count(F.lit(1)).alias("n")).select(F.lit("entity").alias("kind"), "n").unionByName(
        agg.counts_by(typed, ["predicate"]).withColumnRenamed("predicate", "kind"))


@query("g18_assign_agents", """
SELECT 'Agent' AS src_label, a.id AS src, 'MONITORS' AS rel, 'Incident' AS dst_label, i.incident_uri AS dst FROM incidents i JOIN agents a
ON contains(a.sector_coverage, '62') OR a.type = 'generalist' WHERE i.scian_code = '62' AND i.injury_type <> 'MINOR'""", **IPARTS)
def _(t):
    rows = incidents(t)
    watched = gr.monitors(rows.filter("injury_type = 'MINOR'"), agents(t))
    return gr.assign_agents(rows, agents(t), watched, "62")


GRAPH_COUNTS = "SELECT label AS element, COUNT(*) AS n FROM incident_nodes GROUP BY 1 UNION ALL SELECT 'relations', COUNT(*) FROM incident_edges"


@query("g19_graph_stats", "SELECT * FROM counted", counted=GRAPH_COUNTS, **IPARTS)
def _(t):
    return gr.label_counts(*gr.incident_graph(incidents(t), agents(t), "osha"))


@query("g19_integrity", "SELECT 'Incident' AS required, n, n > 0 AS passed FROM counted WHERE element = 'Incident'", counted=GRAPH_COUNTS, **IPARTS)
def _(t):
    return gr.integrity(gr.label_counts(*gr.incident_graph(incidents(t), agents(t), "osha")), ["Incident"])


# -- streams ---------------------------------------------------------------------------------

@query("x01_ingest_new_files", "SELECT event_type, COUNT(*) AS n, COUNT(DISTINCT user_id) AS users FROM events GROUP BY 1")
def _(t):
    root = scratch_path(t.spark, "stream")
    for _ in range(2):  # the second run finds nothing new
        ingest.ingest_new_files(t.spark, t.sf_dir, t.base("events").schema, f"{root}/bronze", f"{root}/state", glob="events.parquet")
    return t.spark.read.parquet(f"{root}/bronze").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("users"))


@query("x02_stream_spikes", """
SELECT cle, strftime(debut, '%Y-%m-%d') AS jour, n, previous, ROUND(c, 2) AS change_pct, CASE WHEN c > 30 THEN 'CRITICAL' WHEN c > 15 THEN 'WARNING' ELSE 'NORMAL' END AS level
FROM (SELECT *, CAST(n - previous AS DOUBLE) / previous * 100 AS c FROM (SELECT event_type AS cle, date_trunc('day', ts) AS debut, COUNT(*) AS n,
  LAG(COUNT(*)) OVER (PARTITION BY event_type ORDER BY date_trunc('day', ts)) AS previous FROM events GROUP BY 1, 2)) WHERE previous IS NOT NULL""")
def _(t):
    root = scratch_path(t.spark, "stream")
    schema = t.base("events").schema
    stream = t.spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(t.sf_dir)
    ingest.stream_spikes(stream, "event_type", f"{root}/spikes", f"{root}/state")
    return ingest.read_spikes(t.spark, f"{root}/spikes").withColumn("debut", F.date_format("debut", "yyyy-MM-dd")).withColumnRenamed("debut", "jour")


@query("x01_ingest_unique", "SELECT event_type, COUNT(*) AS n, COUNT(DISTINCT event_id) AS events, SUM(user_id)::BIGINT AS users FROM events GROUP BY 1")
def _(t):
    """Deliveries of overlapping days, each landed and ingested by a run of its own."""
    root, events = scratch_path(t.spark, "deliveries"), t.base("events")
    schema = events.schema
    for first, last in ((1, 12), (9, 20), (17, 31)):
        events.filter(F.dayofmonth("ts").between(first, last)).write.parquet(f"{root}/landing/from-{first}")
        ingest.ingest_unique(t.spark, f"{root}/landing", schema, f"{root}/stored", f"{root}/state", ["event_id"], "ts", lateness="5 days")
    stored = t.spark.read.schema(schema).parquet(f"{root}/stored")
    return stored.groupBy("event_type").agg(row_count().alias("n"), F.count_distinct("event_id").alias("events"), F.sum("user_id").alias("users"))


@query("x02_stream_alerts", """
SELECT cle, strftime(debut, '%Y-%m-%d') AS jour, n, previous, ROUND(c, 2) AS change_pct, CASE WHEN c > 30 THEN 'CRITICAL' ELSE 'WARNING' END AS level FROM (
  SELECT p.cle, p.debut, COALESCE(now.n, 0) AS n, before.n AS previous, CAST(COALESCE(now.n, 0) - before.n AS DOUBLE) / before.n * 100 AS c
  FROM (SELECT cle, jour AS debut FROM days UNION SELECT cle, jour + INTERVAL 1 DAY FROM days) p
  LEFT JOIN days now ON now.cle = p.cle AND now.jour = p.debut JOIN days before ON before.cle = p.cle AND before.jour = p.debut - INTERVAL 1 DAY
  WHERE p.debut + INTERVAL 1 DAY <= (SELECT MAX(ts) - INTERVAL 2 DAY FROM events)) WHERE c > 15""",
       days="SELECT event_type || '-' || CAST(user_id % 40 AS STRING) AS cle, date_trunc('day', ts) AS jour, COUNT(*) AS n FROM events GROUP BY 1, 2")
def _(t):
    """Few enough events a key and day that some days are empty."""
    root = scratch_path(t.spark, "alerts")
    stream = t.spark.readStream.schema(t.base("events").schema).option("pathGlobFilter", "events.parquet").parquet(t.sf_dir)
    keyed = stream.withColumn("cle", F.concat_ws("-", "event_type", (F.col("user_id") % 40).cast("string")))
    ingest.stream_alerts(keyed, "cle", f"{root}/alerts", f"{root}/state")
    alerts = t.spark.read.parquet(f"{root}/alerts").drop("batch")
    return alerts.withColumn("debut", F.date_format("debut", "yyyy-MM-dd")).withColumnRenamed("debut", "jour")
