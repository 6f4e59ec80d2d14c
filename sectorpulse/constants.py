"""Fixed values of the registry domain."""

# The 34 municipalities of the metropolitan region, as
# normalised (upper-case, accent-free) names.
REGION_MUNICIPALITIES = (
    "PORTO ALEGRE", "ALVORADA", "ARARICA", "ARROIO DOS RATOS", "CACHOEIRINHA",
    "CAMPO BOM", "CANOAS", "CAPELA DE SANTANA", "CHARQUEADAS", "DOIS IRMAOS",
    "ELDORADO DO SUL", "ESTANCIA VELHA", "ESTEIO", "GLORINHA", "GRAVATAI",
    "GUAIBA", "IGREJINHA", "IVOTI", "MONTENEGRO", "NOVA HARTZ",
    "NOVA SANTA RITA", "NOVO HAMBURGO", "PAROBE", "PORTAO", "ROLANTE",
    "SANTO ANTONIO DA PATRULHA", "SAPIRANGA", "SAPUCAIA DO SUL",
    "SAO JERONIMO", "SAO LEOPOLDO", "SAO SEBASTIAO DO CAI", "TAQUARA",
    "TRIUNFO", "VIAMAO",
)

# Registration status codes (1 null, 2 active, 3 suspended,
# 4 unfit, 8 closed) and company size codes.
STATUS_ACTIVE = 2
STATUS_DOMAIN = (1, 2, 3, 4, 8)
SIZE_DOMAIN = (1, 3, 5)

# Growth window and ranking parameters.
TRAILING_ROWS = 6            # previous rows in the trailing mean
RANKING_SIZE = 8             # growth ranking rows on the dashboard
RANKING_MIN_OPENINGS = 5     # minimum openings to enter the ranking
INSIGHT_SIZE = 5             # rows in the insight snapshot
LEADS_PAGE = 500             # newest active establishments listed
ENRICHMENT_LIMIT = 50        # leads sent to enrichment per run
STATE_DEFAULT = "RS"         # default state of a municipality row

# Dashboard label widths and fallbacks.
CHART_LABEL_WIDTH = 26
KPI_LABEL_WIDTH = 22
EMPTY_MARK = "—"
NOT_ENRICHED = "Não enriquecido"
SECTOR_FALLBACK = "CNAE "
MUNICIPALITY_FALLBACK = "Município "
