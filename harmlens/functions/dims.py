"""Reference dimensions: code concordances, rule lists, tariffs.

Each dimension is a short list of fixed values. ``frame`` turns one into a
literal relation whose size is fixed, which is what makes a broadcast safe.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Dimension:
    columns: tuple[str, ...]
    rows: tuple[tuple, ...]


# US event code -> unified hazard.
OSHA_EVENT = Dimension(
    ("code", "hazard_code", "domain", "label_fr", "label_en"),
    (
        ("42", "CHUTE-01", "CHUTE", "Chute de hauteur", "Fall from height"),
        ("421", "CHUTE-01", "CHUTE", "Chute de hauteur", "Fall from height"),
        ("422", "CHUTE-03", "CHUTE", "Chute dans escaliers", "Fall on stairs"),
        ("43", "CHUTE-02", "CHUTE", "Chute de plain-pied", "Fall on same level"),
        ("51", "ELEC-01", "ELEC", "Contact électrique", "Electrical contact"),
        ("511", "ELEC-01", "ELEC", "Contact électrique direct", "Direct electrical contact"),
        ("512", "ELEC-02", "ELEC", "Arc électrique", "Arc flash"),
        ("21", "MACH-01", "MACHINE", "Frappé par objet", "Struck by object"),
        ("22", "MACH-02", "MACHINE", "Heurté contre objet", "Struck against object"),
        ("23", "MACH-03", "MACHINE", "Coincement", "Caught in machinery"),
        ("232", "MACH-04", "MACHINE", "Écrasement", "Crushing"),
        ("71", "ERGO-01", "ERGO", "Effort excessif", "Overexertion"),
        ("72", "ERGO-02", "ERGO", "Mouvement répétitif", "Repetitive motion"),
        ("731", "ERGO-03", "ERGO", "Posture contraignante", "Awkward posture"),
        ("32", "FEU-01", "INCENDIE", "Incendie", "Fire"),
        ("321", "FEU-02", "INCENDIE", "Explosion", "Explosion"),
        ("53", "CHIM-01", "CHIMIQUE", "Exposition chimique", "Chemical exposure"),
        ("534", "CHIM-02", "CHIMIQUE", "Inhalation toxique", "Toxic inhalation"),
        ("31", "THERM-01", "THERMIQUE", "Contact chaud", "Contact with hot object"),
        ("55", "THERM-02", "THERMIQUE", "Stress thermique", "Heat stress"),
        ("26", "VEH-01", "VEHICULE", "Accident véhicule", "Vehicle accident"),
        ("542", "CONF-01", "CONFINE", "Asphyxie espace clos", "Confined space asphyxiation"),
        ("12", "RPS-01", "RPS", "Violence au travail", "Workplace violence"),
    ),
)

# European deviation code -> unified hazard.
ESAW_DEVIATION = Dimension(
    OSHA_EVENT.columns,
    (
        ("51", "CHUTE-01", "CHUTE", "Chute de hauteur", "Fall from height"),
        ("52", "CHUTE-02", "CHUTE", "Chute de plain-pied", "Fall on same level"),
        ("61", "ELEC-01", "ELEC", "Contact électrique direct", "Direct electrical contact"),
        ("62", "ELEC-02", "ELEC", "Arc électrique", "Arc flash"),
        ("43", "MACH-01", "MACHINE", "Heurt par objet", "Struck by object"),
        ("44", "MACH-02", "MACHINE", "Heurt contre objet", "Struck against object"),
        ("41", "MACH-03", "MACHINE", "Happement machine", "Caught in machinery"),
        ("42", "MACH-04", "MACHINE", "Écrasement", "Crushing"),
        ("71", "ERGO-01", "ERGO", "Effort excessif", "Overexertion"),
        ("72", "ERGO-02", "ERGO", "Mouvement répétitif", "Repetitive motion"),
        ("73", "ERGO-03", "ERGO", "Posture contraignante", "Awkward posture"),
        ("21", "FEU-01", "INCENDIE", "Incendie", "Fire"),
        ("22", "FEU-02", "INCENDIE", "Explosion", "Explosion"),
        ("15", "CHIM-01", "CHIMIQUE", "Exposition substance", "Substance exposure"),
        ("63", "THERM-01", "THERMIQUE", "Contact chaud/froid", "Contact with hot/cold"),
        ("81", "THERM-02", "THERMIQUE", "Stress thermique", "Thermal stress"),
        ("11", "VEH-01", "VEHICULE", "Accident véhicule", "Vehicle accident"),
        ("82", "RPS-01", "RPS", "Violence", "Violence"),
    ),
)

# Quebec accident-type code -> unified hazard.
CNESST_GENRE = Dimension(
    OSHA_EVENT.columns,
    (
        ("31", "CHUTE-01", "CHUTE", "Chute niveau inférieur", "Fall to lower level"),
        ("32", "CHUTE-02", "CHUTE", "Chute même niveau", "Fall on same level"),
        ("51", "ELEC-01", "ELEC", "Contact électricité", "Electrical contact"),
        ("52", "ELEC-02", "ELEC", "Arc électrique", "Arc flash"),
        ("21", "MACH-01", "MACHINE", "Frappé par objet", "Struck by object"),
        ("22", "MACH-02", "MACHINE", "Heurt contre objet", "Struck against object"),
        ("23", "MACH-03", "MACHINE", "Happement", "Caught in"),
        ("24", "MACH-04", "MACHINE", "Écrasement", "Crushing"),
        ("11", "ERGO-01", "ERGO", "Effort en soulevant", "Overexertion lifting"),
        ("12", "ERGO-02", "ERGO", "Mouvement répétitif", "Repetitive motion"),
        ("13", "ERGO-03", "ERGO", "Posture contraignante", "Awkward posture"),
        ("61", "FEU-01", "INCENDIE", "Incendie", "Fire"),
        ("62", "FEU-02", "INCENDIE", "Explosion", "Explosion"),
        ("41", "CHIM-01", "CHIMIQUE", "Exposition nocive", "Harmful exposure"),
        ("42", "CHIM-02", "CHIMIQUE", "Inhalation", "Inhalation"),
        ("53", "THERM-01", "THERMIQUE", "Contact chaud", "Contact with hot"),
        ("44", "THERM-02", "THERMIQUE", "Chaleur/froid", "Heat/cold"),
        ("71", "VEH-01", "VEHICULE", "Accident véhicule", "Vehicle accident"),
        ("43", "CONF-01", "CONFINE", "Asphyxie", "Asphyxiation"),
        ("91", "RPS-01", "RPS", "Violence/agression", "Violence/aggression"),
    ),
)

# US nature-of-injury code -> unified nature.
OSHA_NATURE = Dimension(
    ("code", "nature_code", "label_fr", "label_en"),
    (
        ("121", "NAT-01", "Fracture", "Fracture"),
        ("122", "NAT-05", "Amputation", "Amputation"),
        ("211", "NAT-02", "Entorse/Foulure", "Sprain/Strain"),
        ("212", "NAT-10", "TMS", "MSD"),
        ("131", "NAT-03", "Contusion", "Contusion"),
        ("111", "NAT-04", "Coupure", "Cut/Laceration"),
        ("321", "NAT-06", "Brûlure thermique", "Thermal burn"),
        ("322", "NAT-07", "Brûlure chimique", "Chemical burn"),
        ("323", "NAT-08", "Brûlure électrique", "Electrical burn"),
        ("331", "NAT-09", "Électrocution", "Electrocution"),
        ("341", "NAT-11", "Intoxication", "Poisoning"),
        ("342", "NAT-12", "Asphyxie", "Asphyxiation"),
        ("561", "NAT-13", "Stress post-traumatique", "PTSD"),
        ("999", "NAT-99", "Décès", "Fatality"),
    ),
)

# US body-part code -> unified body part.
OSHA_BODYPART = Dimension(
    ("code", "part_code", "label_fr", "label_en"),
    (
        ("1", "BP-01", "Tête", "Head"),
        ("12", "BP-02", "Œil", "Eye"),
        ("2", "BP-03", "Cou", "Neck"),
        ("32", "BP-04", "Dos", "Back"),
        ("41", "BP-05", "Épaule", "Shoulder"),
        ("42", "BP-06", "Bras", "Arm"),
        ("44", "BP-07", "Main", "Hand"),
        ("45", "BP-08", "Doigt", "Finger"),
        ("31", "BP-09", "Poitrine", "Chest"),
        ("33", "BP-10", "Abdomen", "Abdomen"),
        ("51", "BP-11", "Bassin/Hanche", "Pelvis/Hip"),
        ("52", "BP-12", "Jambe", "Leg"),
        ("53", "BP-13", "Genou", "Knee"),
        ("54", "BP-14", "Pied", "Foot"),
        ("55", "BP-15", "Orteil", "Toe"),
        ("8", "BP-90", "Corps entier", "Whole body"),
    ),
)

# North American industry code -> European and international codes.
INDUSTRY = Dimension(
    ("code", "nace", "isic", "label"),
    (
        ("23", "F", "F", "Construction"),
        ("236", "F41", "41", "Construction de bâtiments"),
        ("238", "F43", "43", "Travaux spécialisés"),
        ("23821", "F4321", "4321", "Travaux d'électricité"),
        ("2211", "D351", "351", "Production d'électricité"),
        ("221122", "D3513", "3513", "Distribution d'électricité"),
        ("31-33", "C", "C", "Fabrication"),
        ("332", "C25", "25", "Fabrication métallique"),
        ("21", "B", "B", "Mines"),
        ("11", "A01", "01", "Agriculture"),
        ("484", "H49", "49", "Transport routier"),
        ("62", "Q86", "86", "Santé"),
    ),
)

# Sector crosswalk, in match order.
SECTOR_CROSSWALK = Dimension(
    ("ord", "code", "scian", "naics", "nace", "name_fr", "name_en", "name_de"),
    (
        (1, "221122", "221122", "221122", "D35.13", "Distribution d'électricité", "Electric power distribution", "Elektrizitätsverteilung"),
        (2, "23", "23", "23", "F41-43", "Construction", "Construction", "Baugewerbe"),
        (3, "31-33", "31-33", "31-33", "C10-33", "Fabrication", "Manufacturing", "Verarbeitendes Gewerbe"),
        (4, "62", "62", "62", "Q86-88", "Soins de santé et assistance sociale", "Health care and social assistance", "Gesundheits- und Sozialwesen"),
        (5, "48-49", "48-49", "48-49", "H49-53", "Transport et entreposage", "Transportation and warehousing", "Verkehr und Lagerei"),
        (6, "21", "21", "21", "B05-09", "Extraction minière", "Mining and quarrying", "Bergbau"),
        (7, "11", "11", "11", "A01-03", "Agriculture, foresterie", "Agriculture, forestry", "Land- und Forstwirtschaft"),
        (8, "44-45", "44-45", "44-45", "G47", "Commerce de détail", "Retail trade", "Einzelhandel"),
    ),
)

# Injury types across three classifications.
INJURY_CROSSWALK = Dimension(
    ("code", "cnesst_code", "cnesst_name", "osha_code", "osha_name", "esaw_code", "esaw_name"),
    (
        ("10", "10", "Entorse, foulure, déchirure", "021", "Sprains, strains, tears", "010", "Wounds and superficial injuries"),
        ("20", "20", "Contusion, écrasement", "030", "Bruises, contusions", "020", "Bone fractures"),
        ("30", "30", "Fracture", "011", "Fractures", "020", "Bone fractures"),
        ("40", "40", "Brûlure (thermique, électrique, chimique)", "050", "Burns", "050", "Burns, scalds and frostbites"),
        ("50", "50", "Coupure, lacération", "040", "Cuts, lacerations", "010", "Wounds and superficial injuries"),
    ),
)

# Accident causes across three classifications.
CAUSE_CROSSWALK = Dimension(
    INJURY_CROSSWALK.columns,
    (
        ("31", "31", "Chute au même niveau", "411", "Fall on same level", "30", "Fall of persons - same level"),
        ("42", "42", "Chute à un niveau inférieur", "410", "Fall to lower level", "31", "Fall of persons - from height"),
        ("50", "50", "Frappé par un objet", "520", "Struck by object", "40", "Struck by moving object"),
        ("51", "51", "Contact avec courant électrique", "610", "Contact with electric current", "70", "Contact with electrical voltage"),
        ("52", "52", "Coincé dans ou entre", "530", "Caught in/compressed by", "50", "Trapped, crushed"),
        ("60", "60", "Accident de transport", "200", "Transportation accidents", "80", "Road traffic accidents"),
        ("72", "72", "Effort excessif (TMS)", "710", "Overexertion", "60", "Physical strain"),
    ),
)

# Canadian sector -> US sector; an unlisted sector maps to itself.
SCIAN_NAICS = Dimension(
    ("scian", "naics"),
    (
        ("221122", "2211"),
        ("23", "23"),
        ("62", "62"),
        ("31-33", "31-33"),
        ("48-49", "48-49"),
        ("44-45", "44-45"),
        ("21", "21"),
        ("11", "11"),
    ),
)

# Risk domains with their danger level.
RISK_DOMAIN = Dimension(
    ("code", "nom_fr", "nom_en", "icone", "couleur", "niveau_danger"),
    (
        ("ELEC", "Électricité", "Electrical", "⚡", "#FFA500", 5),
        ("CHUTE", "Chutes", "Falls", "🪜", "#FF0000", 5),
        ("INCENDIE", "Incendie/Explosion", "Fire/Explosion", "🔥", "#FF4500", 5),
        ("MACHINE", "Machines", "Machinery", "⚙️", "#808080", 4),
        ("ERGO", "Ergonomie", "Ergonomics", "🦴", "#9370DB", 3),
        ("CHIMIQUE", "Chimique", "Chemical", "☣️", "#32CD32", 4),
        ("GAZ", "Gaz", "Gas", "💨", "#87CEEB", 5),
        ("CONFINE", "Espaces clos", "Confined Spaces", "🚪", "#4169E1", 5),
        ("THERMIQUE", "Thermique", "Thermal", "🌡️", "#DC143C", 3),
        ("RPS", "Psychosociaux", "Psychosocial", "🧠", "#9932CC", 3),
        ("BIOLOGIQUE", "Biologique", "Biological", "🦠", "#228B22", 4),
        ("BRUIT", "Bruit", "Noise", "🔊", "#FF6347", 3),
        ("VEHICULE", "Véhicules", "Vehicles", "🚗", "#4682B4", 5),
        ("AUTRE", "Autre", "Other", "❓", "#A9A9A9", 2),
    ),
)

# Jurisdictions of the risk graph.
JURISDICTION = Dimension(
    ("code", "nom_fr", "nom_en", "type"),
    (
        ("US", "États-Unis", "United States", "FEDERAL"),
        ("CA", "Canada", "Canada", "FEDERAL"),
        ("QC", "Québec", "Quebec", "STATE_PROVINCIAL"),
        ("ON", "Ontario", "Ontario", "STATE_PROVINCIAL"),
        ("EU", "Union Européenne", "European Union", "SUPRANATIONAL"),
        ("FR", "France", "France", "NATIONAL"),
        ("DE", "Allemagne", "Germany", "NATIONAL"),
        ("GB", "Royaume-Uni", "United Kingdom", "NATIONAL"),
        ("INT", "International", "International", "INTERNATIONAL"),
    ),
)

# Jurisdictions of the statistics graph.
STAT_JURISDICTION = Dimension(
    ("code", "name", "flag", "source"),
    (
        ("USA", "États-Unis", "🇺🇸", "OSHA"),
        ("EU27", "Union Européenne", "🇪🇺", "Eurostat"),
        ("QC", "Québec", "🇨🇦", "CNESST"),
    ),
)

# Preventive solutions by risk type (efficacy share, cost).
SOLUTION = Dimension(
    ("risk_type", "ord", "id", "solution", "efficacite", "cout"),
    (
        ("ELEC", 1, "E1", "Verification LOTO avant intervention", 0.95, 5000),
        ("ELEC", 2, "E2", "Formation arc flash annuelle", 0.85, 15000),
        ("ELEC", 3, "E3", "EPI categorie 4 obligatoire", 0.90, 25000),
        ("CHUTE", 1, "C1", "Garde-corps conformes", 0.92, 20000),
        ("CHUTE", 2, "C2", "Formation travail en hauteur", 0.80, 8000),
        ("CHUTE", 3, "C3", "Inspection echelles mensuelle", 0.75, 2000),
        ("TMS", 1, "T1", "Analyse ergonomique postes", 0.70, 12000),
        ("TMS", 2, "T2", "Rotation des taches", 0.65, 5000),
        ("TMS", 3, "T3", "Equipements aide manutention", 0.85, 35000),
        ("MACHINE", 1, "M1", "Protecteurs fixes machines", 0.95, 30000),
        ("MACHINE", 2, "M2", "Capteurs presence", 0.90, 45000),
        ("MACHINE", 3, "M3", "Procedure cadenassage", 0.92, 10000),
    ),
)

# Dominant risks per sector, in order.
SECTOR_RISK = Dimension(
    ("sector", "risk_ord", "risk_type"),
    (
        ("221122", 1, "ELEC"), ("221122", 2, "CHUTE"), ("221122", 3, "TMS"),
        ("23", 1, "CHUTE"), ("23", 2, "MACHINE"), ("23", 3, "ELEC"),
        ("31-33", 1, "MACHINE"), ("31-33", 2, "TMS"), ("31-33", 3, "CHUTE"),
        ("62", 1, "TMS"), ("62", 2, "CHUTE"),
        ("48-49", 1, "TMS"), ("48-49", 2, "CHUTE"),
        ("21", 1, "MACHINE"), ("21", 2, "CHUTE"),
    ),
)
DEFAULT_SECTOR_RISKS = ("TMS", "CHUTE")

# Regulations, one row per sector they apply to ('*' = every sector).
REGULATION = Dimension(
    ("source", "code", "titre", "sector"),
    (
        ("CNESST", "RSST-51", "Travaux electriques", "221122"),
        ("CNESST", "RSST-51", "Travaux electriques", "23"),
        ("CNESST", "RSST-312", "Travail en hauteur", "23"),
        ("CNESST", "RSST-312", "Travail en hauteur", "221122"),
        ("CNESST", "RSST-312", "Travail en hauteur", "31-33"),
        ("CNESST", "RSST-166", "Cadenassage", "31-33"),
        ("CNESST", "RSST-166", "Cadenassage", "221122"),
        ("CNESST", "LSST-51", "Droit de refus", "*"),
        ("ISO", "ISO-45001", "Management SST", "*"),
        ("ISO", "ISO-14001", "Management environnemental", "*"),
        ("OSHA", "29CFR1910.147", "Lockout/Tagout", "31-33"),
        ("OSHA", "29CFR1910.147", "Lockout/Tagout", "221122"),
        ("OSHA", "29CFR1926.501", "Fall Protection", "23"),
    ),
)

# Observation keywords by category, in report order.
BEHAVIOUR_KEYWORDS = (
    ("POSTURE", "penche"), ("POSTURE", "courbe"), ("POSTURE", "tordu"), ("POSTURE", "dos"), ("POSTURE", "flexion"),
    ("VITESSE", "rapide"), ("VITESSE", "precipite"), ("VITESSE", "presse"), ("VITESSE", "vite"),
    ("EPI", "sans gants"), ("EPI", "absence casque"), ("EPI", "pas de lunettes"),
    ("PROCEDURE", "raccourci"), ("PROCEDURE", "saute"), ("PROCEDURE", "ignore"),
    ("FATIGUE", "fatigue"), ("FATIGUE", "lent"), ("FATIGUE", "somnolent"),
)

# Intent word lists, first hit wins.
INTENT_WORDS = (
    ("stats", ("statistique", "stats", "combien", "total")),
    ("sector_analysis", ("secteur", "scian", "221122", "construction", "sante")),
    ("comparison", ("comparer", "versus", "vs", "difference", "quebec", "usa", "europe")),
    ("risk_prediction", ("risque", "prediction", "prevision", "danger")),
    ("recommendation", ("recommandation", "solution", "prevention", "ameliorer")),
)

# Sectors that can be named in a question, in match order.
NAMED_SECTORS = (
    ("221122", "Distribution electricite (ex: Hydro-Quebec)"),
    ("23", "Construction"),
    ("31-33", "Fabrication/Manufacturing"),
    ("62", "Soins de sante"),
    ("48-49", "Transport et entreposage"),
    ("21", "Extraction miniere"),
    ("11", "Agriculture"),
)

# Published series id -> indicator name.
BLS_SERIES = Dimension(
    ("series_id", "indicator"),
    (
        ("FWU00X4XXXXXXXX1", "fatal_injuries_total"),
        ("FWU00X4230XXXXX1", "fatal_injuries_construction"),
        ("FWU00X431XXXXXX1", "fatal_injuries_manufacturing"),
        ("ISU00000000000000100000", "nonfatal_rate_private"),
    ),
)

# Sector words -> sector code, and severity words -> severity class.
SECTOR_WORDS = Dimension(
    ("word", "scian_code"),
    (
        ("construction", "23"), ("manufacturing", "31-33"), ("mining", "21"),
        ("healthcare", "62"), ("transportation", "48-49"), ("agriculture", "11"),
    ),
)
SEVERITY_WORDS = Dimension(
    ("word", "severity_class"),
    (
        ("fatal", "CRITICAL"), ("fatality", "CRITICAL"), ("death", "CRITICAL"),
        ("hospitalization", "HIGH"), ("serious", "HIGH"), ("severe", "HIGH"),
        ("moderate", "MEDIUM"), ("minor", "LOW"), ("first_aid", "LOW"),
    ),
)

# Registered sources.
SOURCE = Dimension(
    ("ord", "source_key", "name", "type", "format", "jurisdiction", "priority", "enabled"),
    (
        (1, "kaggle_osha_injuries", "OSHA Work-Related Injury Data 2016-2021", "kaggle", "csv", "USA", 1, True),
        (2, "kaggle_industrial_safety", "Industrial Safety & Health Analytics", "kaggle", "csv", "International", 2, True),
        (3, "osha_inspections", "OSHA Inspection Data", "api", "csv", "USA", 1, True),
        (4, "osha_ita", "OSHA Injury Tracking Application (ITA)", "api", "csv", "USA", 1, True),
        (5, "osha_severe_injuries", "OSHA Severe Injury Reports", "file", "xml", "USA", 2, True),
        (6, "bls_cfoi", "BLS Census of Fatal Occupational Injuries", "api", "json", "USA", 1, True),
        (7, "bls_soii", "BLS Survey of Occupational Injuries & Illnesses", "api", "json", "USA", 1, True),
        (8, "eurostat_esaw", "Eurostat ESAW - Accidents at Work", "sdmx", "sdmx", "EU-27", 1, True),
        (9, "eurostat_esaw_fatal", "Eurostat ESAW - Fatal Accidents", "sdmx", "sdmx", "EU-27", 1, True),
        (10, "ilostat_injuries", "ILOSTAT Occupational Injuries", "sdmx", "sdmx", "International", 1, True),
        (11, "dares_at", "DARES Accidents du Travail France", "file", "xlsx", "France", 1, True),
        (12, "carsat_opendata", "CARSAT Open Data - Pays de la Loire", "api", "json", "France", 2, True),
        (13, "cnesst_lesions", "CNESST Lésions Professionnelles Québec", "file", "csv", "Quebec", 1, True),
    ),
)


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, float):
        return f"CAST({value!r} AS DOUBLE)"
    if isinstance(value, int):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def values_sql(dim: Dimension) -> str:
    """A ``VALUES`` query both Spark and an ANSI engine accept."""
    rows = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in dim.rows)
    return f"SELECT * FROM (VALUES {rows}) AS t({', '.join(dim.columns)})"


def frame(spark: SparkSession, dim: Dimension) -> DataFrame:
    return spark.sql(values_sql(dim))
