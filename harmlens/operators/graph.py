"""Property graphs as node and edge tables.

nodes: label, key and attribute columns; edges: src_label, src, rel, dst_label, dst.
An upsert of a node or edge is a group-by on its key, so repeated rows merge
map-side however often a key occurs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harmlens.functions import dims
from harmlens.functions.exprs import percent, row_count
from harmlens.operators.warehouse import upsert
from harmlens.operators.windows import top_k
from harmlens.workspace import cut_lineage, stored

EDGE = ["src_label", "src", "rel", "dst_label", "dst"]


def _edge(df: DataFrame, src_label: str, src: Column, rel: str, dst_label: str, dst: Column) -> DataFrame:
    return df.select(F.lit(src_label).alias("src_label"), src.cast("string").alias("src"), F.lit(rel).alias("rel"),
                     F.lit(dst_label).alias("dst_label"), dst.cast("string").alias("dst"))


def union_all(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def merged_edges(*parts: DataFrame) -> DataFrame:
    """All edges, each once."""
    return union_all(*parts).distinct()


def link(left: DataFrame, left_key: str, node: DataFrame, node_key: str) -> DataFrame:
    """Rows whose key is an existing node; the others give no edge."""
    side = node.select(F.col(node_key).alias("__node")).distinct()
    return left.join(side, F.col(left_key) == F.col("__node"), "left_semi")


def containment_index(items: DataFrame, item: str, texts: Sequence[str]) -> DataFrame:
    """Every substring of short code texts -> the item, for an equality join.

    ``text CONTAINS key`` becomes ``key = part``. ``items`` must be a small code
    list: the index has about half the squared text length of rows per item.
    """
    text = items.select(F.col(item).alias("item"), F.explode(F.array(*texts)).alias("text")).filter(F.col("text").isNotNull())
    parts = F.transform(F.sequence(F.lit(1), F.length("text")), lambda i: F.transform(
        F.sequence(F.lit(1), F.length("text") - i + 1), lambda n: F.substring(F.col("text"), i, n)))
    whole = F.when(F.length("text") > 0, F.array_union(F.flatten(parts), F.array(F.lit("")))).otherwise(F.array(F.lit("")))
    return text.select("item", F.explode(whole).alias("part")).distinct()


def containment_join(left: DataFrame, key: str, index: DataFrame) -> DataFrame:
    """Left rows with each item whose text contains the key."""
    return left.join(index, F.col(key) == F.col("part")).drop("part")


# -- risk graph (G01-G09) --------------------------------------------------------------

def base_nodes(spark: SparkSession) -> DataFrame:
    """Domain and jurisdiction nodes."""
    domains = dims.frame(spark, dims.RISK_DOMAIN).select(
        F.lit("DomaineRisque").alias("label"), F.col("code").alias("key"), "nom_fr", "nom_en", F.col("niveau_danger").alias("niveau"), F.lit(None).cast("string").alias("type"))
    places = dims.frame(spark, dims.JURISDICTION).select(
        F.lit("Juridiction").alias("label"), F.col("code").alias("key"), "nom_fr", "nom_en", F.lit(None).cast("int").alias("niveau"), "type")
    return domains.unionByName(places)


def initialize(nodes: DataFrame) -> DataFrame:
    """Upsert the base nodes into an existing node table with the same columns."""
    n = lambda c: F.col(f"n.{c}")
    values = {c: n(c) for c in ("nom_fr", "nom_en", "niveau", "type")}
    return upsert(nodes, base_nodes(nodes.sparkSession), ["label", "key"], on_create=values, on_match=values)


def _risk_columns(unified: DataFrame) -> DataFrame:
    """The attributes of each record."""
    blank = F.lit("")
    return unified.select(
        F.col("risk_id").alias("id"), F.coalesce("risk_code", blank).alias("code"), F.coalesce("title.fr", blank).alias("titre_fr"),
        F.coalesce("title.en", blank).alias("titre_en"), F.coalesce("hazard_classification.unified.domain_code", F.lit("AUTRE")).alias("domain_code"),
        F.coalesce("data_provenance.source_system", F.lit("MANUAL_ENTRY")).alias("source_system"),
        F.coalesce("incident_statistics.total_incidents", F.lit(0)).alias("total_incidents"),
        F.coalesce("industry_classification.scian.code", blank).alias("scian"), F.coalesce("industry_classification.nace.code", blank).alias("nace"),
        F.coalesce(F.array_join("metadata.tags", ","), blank).alias("tags"),
        F.coalesce("jurisdiction.primary_country", F.lit("XX")).alias("country"),
        F.coalesce(F.element_at(F.split("jurisdiction.subdivision.code", "-"), -1), blank).alias("subdivision"))


def _with_id(rows: DataFrame) -> DataFrame:
    """Each row that has an id, once, and how many equal ones there are.

    Rows without an id are dropped by their count: a filter on the id would be moved down to the input and hash every
    record once more. Columns are grouped as one struct: Spark puts a small map in front of the grouping of plain strings,
    which copies and hashes each of them once more and finds few of many different rows.
    """
    equal = rows.select(F.struct(*rows.columns).alias("row")).groupBy("row")
    return equal.agg(F.count_if(F.col("row.id") != "").alias("copies")).filter("copies > 0").select("row.*", "copies")


def risk_rows(unified: DataFrame) -> DataFrame:
    """The attributes of each risk node and how many equal records it stands for.

    Records without an id are left out.
    """
    # an id stands for all fields of its record, so grouping by every column merges exact copies only
    return _with_id(_risk_columns(unified))


def edge_rows(unified: DataFrame) -> DataFrame:
    """The columns that ``risk_edges`` needs, once for each risk; nothing else of the records is read or moved."""
    return _with_id(_risk_columns(unified).select("id", "domain_code", "country", "subdivision", "scian")).drop("copies")


def missing_ids(unified: DataFrame) -> DataFrame:
    """Records that cannot become a node."""
    return unified.filter(F.col("risk_id").isNull() | (F.col("risk_id") == ""))


def merge_risks(existing: DataFrame, rows: DataFrame) -> DataFrame:
    """New risks take every attribute; known ones only the titles and the incident total."""
    n = lambda c: F.col(f"n.{c}")
    created = {c: n(c) for c in existing.columns if c != "id" and c in rows.columns}
    return upsert(existing, rows, ["id"], on_create={**created, "statut": F.lit("ACTIVE")},
                  on_match={c: n(c) for c in ("titre_fr", "titre_en", "total_incidents")})


def risk_edges(rows: DataFrame) -> DataFrame:
    """Domain, jurisdiction and sector edges of risks that are unique by id.

    Domains and jurisdictions must exist; a sector node is made on demand and so
    needs no lookup. All edges of a risk come from its own row in one pass: the
    two fixed code lists are scalars, and edges cannot repeat across rows.
    """
    nodes = base_nodes(rows.sparkSession)
    codes = {label: nodes.filter(F.col("label") == label).agg(F.collect_set("key")).scalar() for label in ("DomaineRisque", "Juridiction")}
    edge = lambda rel, label, dst: F.struct(F.lit(rel).alias("rel"), F.lit(label).alias("dst_label"), F.col(dst).alias("dst"))
    listed = lambda label, column: F.array_contains(codes[label], F.col(column))
    other = ~F.col("subdivision").eqNullSafe(F.col("country"))  # the only two of a row's edges that can be the same
    found = F.array(
        F.when(listed("DomaineRisque", "domain_code"), edge("APPARTIENT_A", "DomaineRisque", "domain_code")),
        F.when(listed("Juridiction", "country"), edge("LOCALISE_DANS", "Juridiction", "country")),
        F.when(listed("Juridiction", "subdivision") & other, edge("LOCALISE_DANS", "Juridiction", "subdivision")),
        F.when(F.col("scian") != "", edge("DANS_SECTEUR", "Secteur", "scian")))
    return rows.select("id", F.explode(found).alias("e")).filter(F.col("e").isNotNull()).select(
        F.lit("Risque").alias("src_label"), F.col("id").alias("src"), "e.rel", "e.dst_label", "e.dst")


def sector_nodes(rows: DataFrame) -> DataFrame:
    """The sectors created on demand."""
    return rows.filter("scian <> ''").select(F.col("scian").alias("code"), F.lit("SCIAN").alias("type")).distinct()


def link_standards(wanted: DataFrame, norms: DataFrame) -> DataFrame:
    """(risk_id, code) pairs to the norms whose code or id contains the code."""
    hits = containment_join(wanted, "code", containment_index(norms, "code", ["code", "id"]))
    return hits.select("risk_id", F.col("item").alias("norm")).distinct()


def auto_link(risk_domain: DataFrame, norm_domain: DataFrame, linked: DataFrame) -> DataFrame:
    """Risk-norm pairs sharing a domain that are not linked yet.

    A short norm list is broadcast by the optimizer's own size check; a longer one
    is shuffled, and AQE splits a domain that holds most risks.
    """
    pairs = risk_domain.join(norm_domain, "domain").select("risk_id", "norm").distinct()
    return pairs.join(linked.select("risk_id", "norm"), ["risk_id", "norm"], "left_anti").withColumn("auto_linked", F.lit(True))


def risks_by_domain(rows: DataFrame, domain: str, k: int = 100) -> DataFrame:
    """G05."""
    return top_k(rows.filter(F.col("domain_code") == domain), "total_incidents", k, ["id"]).select(
        "id", "code", F.col("titre_fr").alias("titre"), F.col("total_incidents").alias("incidents"), F.col("source_system").alias("source"))


def standards_for_risks(links: DataFrame, norms: DataFrame, applies: DataFrame) -> DataFrame:
    """Each risk's norms with their distinct jurisdictions; a norm without any keeps an empty list."""
    by_norm = applies.groupBy(F.col("norm").alias("__norm")).agg(F.array_sort(F.collect_set("jurisdiction")).alias("juridictions"))
    listed = norms.join(by_norm, F.col("code") == F.col("__norm"), "left").select(
        "code", "titre", "obligatoire", F.coalesce("juridictions", F.array().cast("array<string>")).alias("juridictions"))
    return links.join(listed, F.col("norm") == F.col("code")).select("risk_id", "code", "titre", "obligatoire", "juridictions")


def shortest_paths(edges: DataFrame, sources: DataFrame, targets: DataFrame, max_hops: int = 5) -> DataFrame:
    """Shortest undirected paths of at most ``max_hops`` edges.

    ``edges(a, b)``, ``sources(node)``, ``targets(node)``. Each hop first joins the frontier to the edges that lead to
    a target, a small part of all: a source that has reached all its targets leaves the frontier before its last and
    largest ball of nodes is formed. The others join all edges. Both keep the smallest path per (source, node) - combined
    map-side, so a hub node is not gathered - and drop nodes already reached. Every hop is cut, so the plan stays
    one hop long; edges and balls are stored as Parquet, many times smaller than a checkpoint.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct()
    both = stored(both, "edges")
    frontier = cut_lineage(sources.select(F.col("node").alias("source"), "node", F.array("node").alias("path")).distinct())
    levels = [frontier]
    aims = cut_lineage(targets.select("node").distinct())
    last = stored(both.join(aims, F.col("b") == F.col("node"), "left_semi"), "edges-to-targets")
    own = frontier.select("source").join(aims.select(F.col("node").alias("source"), F.lit(1).alias("self")), "source", "left")
    wanted = own.select("source", (aims.agg(row_count()).scalar() - F.coalesce("self", F.lit(0))).alias("aims"))

    def grown(by: DataFrame) -> DataFrame:
        step = frontier.join(by, F.col("node") == F.col("a")).select("source", F.col("b").alias("node"), F.concat("path", F.array("b")).alias("path"))
        step = step.groupBy("source", "node").agg(F.min("path").alias("path"))
        # an undirected neighbour of level d lies on level d - 1, d or d + 1: older levels can't be met again
        return step.join(union_all(*[level.select("source", "node") for level in levels[-2:]]), ["source", "node"], "left_anti")

    found: list[DataFrame] = []
    for hop in range(max_hops):
        found.append(cut_lineage(grown(last)))
        hits = union_all(*[pairs.select("source") for pairs in found])
        done = hits.groupBy("source").agg(row_count().alias("hits")).join(wanted, "source").filter("hits >= aims").select("source")
        frontier = frontier.join(cut_lineage(done), "source", "left_anti")
        if hop == max_hops - 1 or frontier.isEmpty():
            break
        frontier = stored(grown(both), "frontier")
        levels.append(frontier)
    return union_all(*found).select("source", F.col("node").alias("target"), "path", (F.size("path") - 1).alias("path_length"))


def recommended_norms(exposure: DataFrame, norm_domain: DataFrame, applies: DataFrame, norms: DataFrame, wanted: DataFrame) -> DataFrame:
    """Norms for (sector, jurisdiction) pairs through sector -> domain -> norm -> jurisdiction.

    A jurisdiction also accepts INT, and QC and ON accept CA: the accepted codes
    are listed per pair, which turns the OR into an equality join.
    """
    own = F.array(F.col("jurisdiction"), F.lit("INT"))
    accepted = F.when(F.col("jurisdiction").isin("QC", "ON"), F.concat(own, F.array(F.lit("CA")))).otherwise(own)
    pairs = wanted.select("sector", "jurisdiction", F.explode(accepted).alias("juridiction"))
    danger = dims.frame(wanted.sparkSession, dims.RISK_DOMAIN).select(F.col("code").alias("domain"), F.col("nom_fr").alias("domaine_nom"), "niveau_danger")
    places = applies.select("norm", F.col("jurisdiction").alias("juridiction"))
    rows = pairs.join(exposure, "sector").join(norm_domain, "domain").join(places, ["norm", "juridiction"]).join(
        norms.select(F.col("code").alias("norm"), "titre", "obligatoire"), "norm").join(F.broadcast(danger), "domain")
    return rows.select("sector", "jurisdiction", F.col("norm").alias("norme_code"), F.col("titre").alias("norme_titre"), "obligatoire",
                       F.col("domain").alias("domaine_code"), "domaine_nom", "juridiction", "niveau_danger").distinct().orderBy(
        F.col("obligatoire").desc(), F.col("niveau_danger").desc(), "norme_code").drop("niveau_danger")


def label_counts(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes per label, and all edges under ``relations``."""
    by_label = nodes.groupBy(F.col("label").alias("element")).agg(row_count().alias("n"))
    return by_label.unionByName(edges.agg(row_count().alias("n")).select(F.lit("relations").alias("element"), "n"))


def integrity(counts: DataFrame, required: Sequence[str]) -> DataFrame:
    """One row per required label, whether it has any node."""
    wanted = counts.sparkSession.sql("SELECT explode(array(" + ", ".join(f"'{r}'" for r in required) + ")) AS required")
    return F.broadcast(wanted).join(counts, F.col("required") == F.col("element"), "left").select(
        "required", F.coalesce("n", F.lit(0)).alias("n"), (F.coalesce("n", F.lit(0)) > 0).alias("passed"))


# -- statistics graph (G10-G15) -----------------------------------------------------------

YEARS = (2010, 2023)  # fixed value: the years that exist before any data


def stat_base_nodes(spark: SparkSession, *counts: DataFrame) -> DataFrame:
    """Jurisdiction and year nodes; years of ``counts`` (annee) beyond the usual ones are added."""
    places = dims.frame(spark, dims.STAT_JURISDICTION).select(F.array(F.lit("Jurisdiction")).alias("labels"), F.col("code").alias("key"), "name",
                                                              F.lit(None).cast("string").alias("jurisdiction"), F.lit(None).cast("bigint").alias("total"))
    found = union_all(spark.range(YEARS[0], YEARS[1] + 1).select(F.col("id").alias("year")), *[c.select(F.col("annee").cast("bigint").alias("year")) for c in counts])
    years = found.filter("year is not null").distinct().select(
        F.array(F.lit("Year")).alias("labels"), F.col("year").cast("string").alias("key"), F.col("year").cast("string").alias("name"),
        F.lit(None).cast("string").alias("jurisdiction"), F.lit(None).cast("bigint").alias("total"))
    return places.unionByName(years)


def _stat_nodes(df: DataFrame, labels: list[str], key: Column, name: Column, jurisdiction: str, total: Column) -> DataFrame:
    return df.select(F.array(*[F.lit(x) for x in labels]).alias("labels"), key.alias("key"), name.alias("name"), F.lit(jurisdiction).alias("jurisdiction"),
                     total.cast("bigint").alias("total"))


def sector_graph(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sector and statistics nodes with their edges, from per (secteur, annee) counts.

    The counts are small and read several times, hence the checkpoint.
    """
    counts = cut_lineage(counts)
    rows = counts.withColumn("id", _stats_id())
    nodes = _stat_nodes(rows.select("secteur").distinct(), ["Sector"], F.col("secteur"), F.col("secteur"), "QC", F.lit(None)).unionByName(
        _stat_nodes(rows, ["IncidentStats"], F.col("id"), F.col("id"), "QC", F.col("total")))
    edges = merged_edges(
        _edge(rows, "Sector", F.col("secteur"), "HAS_STATS", "IncidentStats", F.col("id")),
        _edge(rows.filter("annee is not null"), "IncidentStats", F.col("id"), "IN_YEAR", "Year", F.col("annee")),
        _edge(rows, "IncidentStats", F.col("id"), "IN_JURISDICTION", "Jurisdiction", F.lit("QC")))
    return nodes, edges


def _stats_id() -> Column:
    """The whole sector name: a shortened one would merge sectors."""
    return F.concat_ws("-", F.lit("QC"), "secteur", F.col("annee").cast("string"))


def stats_attributes(counts: DataFrame) -> DataFrame:
    """The attributes each statistics node carries."""
    return counts.select(_stats_id().alias("id"), "total", "tms", "psy", "machine", percent("tms", "total").alias("tms_rate"))


def state_graph(states: DataFrame) -> tuple[DataFrame, DataFrame]:
    """State nodes, which carry two labels, and their jurisdiction edges."""
    key = F.concat(F.lit("USA-"), F.col("state"))
    return (_stat_nodes(states, ["State", "Sector"], key, F.col("state"), "USA", F.col("total")),
            _edge(states, "State", key, "IN_JURISDICTION", "Jurisdiction", F.lit("USA")))


def country_graph(countries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Country nodes; a missing name is replaced by the code, repeated codes merge."""
    rows = countries.groupBy("country").agg(F.min("country_name").alias("name"), F.sum("total").alias("total"))
    key = F.concat(F.lit("EU-"), F.col("country"))
    return (_stat_nodes(rows, ["Country", "Sector"], key, F.coalesce("name", "country"), "EU27", F.col("total")),
            _edge(rows, "Country", key, "IN_JURISDICTION", "Jurisdiction", F.lit("EU27")))


def nodes_per_label(nodes: DataFrame) -> DataFrame:
    """A node with two labels counts under both."""
    return nodes.select(F.explode("labels").alias("label")).groupBy("label").agg(row_count().alias("total"))


def graph_totals(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes, edges and labels on one row."""
    labels = F.array_sort(F.flatten(F.collect_set("labels")))
    return nodes.agg(row_count().alias("total_nodes"), F.array_distinct(labels).alias("labels")).select(
        "total_nodes", edges.agg(row_count()).scalar().alias("total_relationships"), "labels")


def jurisdiction_entities(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Entities per jurisdiction, including those with none."""
    counted = edges.filter("rel = 'IN_JURISDICTION'").groupBy(F.col("dst").alias("__j")).agg(row_count().alias("entities"))
    places = nodes.filter(F.array_contains("labels", "Jurisdiction"))
    return places.join(counted, F.col("key") == F.col("__j"), "left").select(F.col("key").alias("code"), "name", F.coalesce("entities", F.lit(0)).alias("entities"))


def sectors_of(nodes: DataFrame, jurisdiction: str | None = None, k: int = 50) -> DataFrame:
    """Sector nodes of a jurisdiction, the first k by code."""
    rows = nodes.filter(F.array_contains("labels", "Sector") & F.col("jurisdiction").isNotNull())
    if jurisdiction:
        rows = rows.filter(F.col("jurisdiction") == jurisdiction)
    return rows.select(F.col("key").alias("code"), "name", "jurisdiction").orderBy("code").limit(k)


# -- incident graph (G16-G19) ----------------------------------------------------------------

def incident_graph(incidents: DataFrame, agents: DataFrame, source: str) -> tuple[DataFrame, DataFrame]:
    """Incidents with jurisdiction, sector and lesion nodes, and four kinds of edges.

    A node takes its name from its smallest row. Agents watch an incident when
    their coverage text contains its sector code. Nodes and edges each come from
    one pass: every incident row lists its own, and repeats merge map-side.
    """
    item = lambda label, key, name: F.struct(F.lit(label).alias("label"), F.col(key).cast("string").alias("key"), F.col(name).alias("name"))
    named = F.array(item("Jurisdiction", "jurisdiction", "jurisdiction_name"), item("Sector", "sector_code", "sector_name"),
                    item("LesionType", "injury_type", "injury_name"), item("Incident", "incident_uri", "description"))
    nodes = incidents.select(F.explode(F.filter(named, lambda n: n["key"].isNotNull())).alias("n")).groupBy("n.label", "n.key").agg(
        F.min("n.name").alias("name")).withColumn("source", F.lit(source))

    watching = containment_index(agents, "id", ["sector_coverage"]).groupBy("part").agg(F.collect_set("item").alias("agents"))
    rows = incidents.join(watching, F.col("scian_code") == F.col("part"), "left")
    edge = lambda rel, label, dst: F.struct(
        F.lit("Incident").alias("src_label"), F.col("incident_uri").alias("src"), F.lit(rel).alias("rel"), F.lit(label).alias("dst_label"),
        F.col(dst).cast("string").alias("dst"))
    own = F.array(edge("OCCURRED_IN", "Jurisdiction", "jurisdiction"), edge("IN_SECTOR", "Sector", "sector_code"), edge("HAS_INJURY", "LesionType", "injury_type"))
    watched = F.transform(F.coalesce("agents", F.array().cast("array<string>")), lambda a: F.struct(
        F.lit("Agent").alias("src_label"), a.alias("src"), F.lit("MONITORS").alias("rel"), F.lit("Incident").alias("dst_label"), F.col("incident_uri").alias("dst")))
    edges = rows.select(F.explode(F.concat(F.filter(own, lambda e: e["dst"].isNotNull()), watched)).alias("e")).select("e.*").distinct()
    return nodes, edges


def monitors(incidents: DataFrame, agents: DataFrame) -> DataFrame:
    index = containment_index(agents, "id", ["sector_coverage"])
    seen = containment_join(incidents.select("incident_uri", "scian_code"), "scian_code", index)
    return _edge(seen, "Agent", F.col("item"), "MONITORS", "Incident", F.col("incident_uri"))


def triples_graph(triples: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entities of subjects and objects, and each typed edge once."""
    entities = triples.select(F.col("subject").alias("uri")).union(triples.select("object")).distinct()
    return entities, triples.select("subject", "predicate", "object").distinct()


def assign_agents(incidents: DataFrame, agents: DataFrame, watched: DataFrame, sector: str) -> DataFrame:
    """Unwatched incidents of a sector to the agents covering it, or generalists."""
    waiting = incidents.filter(F.col("scian_code") == sector).join(
        watched.select(F.col("dst").alias("incident_uri")).distinct(), "incident_uri", "left_anti")
    fit = agents.filter(F.col("sector_coverage").contains(sector) | (F.col("type") == "generalist")).agg(
        F.array_sort(F.collect_set("id")).alias("ids")).scalar()  # the roster of one sector, a short list
    return _edge(waiting.select("incident_uri", F.explode(fit).alias("agent")), "Agent", F.col("agent"), "MONITORS", "Incident", F.col("incident_uri"))
