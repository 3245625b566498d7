"""Names, classes and thresholds that results must carry unchanged."""

# Layers of the table namespace.
LAYERS = ("bronze", "silver", "gold")

# Audit columns of every bronze table.
INGESTED_AT = "timestamp_ingesta"
FILE_NAME = "nombre_archivo"
FILE_PATH = "ruta_archivo"
SOURCE_ID = "fuente_id"
INGEST_DATE = "fecha_ingesta"
LOAD = "carga"

# Missing-reading marker of the air stations.
SENTINEL = -999.0

# Severity classes: text in the source, column in the wide table, weight in the index.
SEVERITIES = (
    ("Con heridos", "con_heridos", 1.0),
    ("Con muertos", "con_muertos", 5.0),
    ("Solo daños", "solo_danos", 0.1),
)

# Bands of the day, first and last hour inclusive; every other hour is the default.
DAY_BANDS = (
    ("punta_am", 5, 8),
    ("valle_am", 9, 11),
    ("almuerzo", 12, 13),
    ("valle_pm", 14, 16),
    ("punta_pm", 17, 20),
)
DAY_BAND_DEFAULT = "nocturno"

# Zones by municipality; every other municipality, and none, is the default.
ZONES = (
    ("valle_aburra_norte", ("Bello", "Copacabana", "Girardota", "Barbosa")),
    ("valle_aburra_sur", ("Itagüí", "Envigado", "Sabaneta", "La Estrella", "Caldas")),
)
ZONE_DEFAULT = "valle_aburra_centro"

# Trip classes: minutes strictly below the bound; longer trips are the default.
TRIP_CLASSES = (("corta", 10), ("media", 30))
TRIP_CLASS_DEFAULT = "larga"
TRIP_MINUTES = (1, 240)

# Valid area for coordinates, and the ranges that show a swapped pair.
LON_RANGE = (-76.0, -75.0)
LAT_RANGE = (5.7, 6.7)
SWAPPED_FIRST = (4.5, 7.5)
SWAPPED_SECOND = (-77.0, -74.5)

# Weather bins: width in degrees and in micrograms, label of a missing value, rain limit in mm.
TEMPERATURE_BIN = 4
PM25_BIN = 15
NO_DATA = "sin_dato"
RAIN_DAY_MM = 1.0

# Area names that stand for "unknown".
PLACEHOLDER_AREAS = ("SD", "NO_DEFINIDO", "NULL", "")

# The street kind and token at the start of an address, and keywords with the corridor they stand for.
STREET_PATTERN = r"^(AVENIDA|AV|CALLE|CL|CARRERA|CR|TRANSVERSAL|TV|DIAGONAL|DG)\s*([0-9A-Z]+)"
STREET_KEYWORDS = (
    ("AUTOPISTA", "Autopista"),
    ("BOLIVARIANA", "Avenida Bolivariana"),
    ("ORIENTAL", "Avenida Oriental"),
)

# Corridors known to carry risk.
KNOWN_CORRIDORS = (
    "Carrera 70", "Calle Colombia", "Avenida Las Vegas", "Carrera 80",
    "Avenida Oriental", "Carrera 65", "Calle 33", "Avenida 33",
)

# Rural divisions that count as official boundaries.
RURAL_DIVISIONS = (
    "Altavista",
    "San Sebastián de Palmitas",
    "San Cristóbal",
    "San Antonio de Prado",
    "Santa Elena",
)

# Air alert classes: lower bound of the window average; below all bounds is the default.
AIR_CLASSES = (("critica", 150.0), ("moderada", 75.0))
AIR_CLASS_DEFAULT = "leve"
AIR_CLASSES_SHORT_WINDOW = (("alta", 100.0),)
AIR_CLASS_SHORT_WINDOW_DEFAULT = "moderada"

# Alert limits.
PM25_LIMIT = 75.0
BIKES_LIMIT = 2
VEHICLES_PER_MINUTE_LIMIT = 80
RAIN_LIMIT_MM = 0.3
RIDERSHIP_FACTOR = 0.7

# Document types.
AIR_ALERT = "ALERTA_PM25"
BIKE_ALERT, BIKE_SNAPSHOT = "ALERTA_DISPONIBILIDAD", "snapshot_disponibilidad"
CORRIDOR_ALERT, CORRIDOR_SNAPSHOT = "ALERTA_CORREDOR_RIESGO", "snapshot_corredor"
LINE_SNAPSHOT = "snapshot_afluencia"
HYBRID_ALERT, HYBRID_HYPOTHESIS = "ALERTA_HIBRIDA", "afluencia_baja_durante_lluvia"

# Classifier: columns, value for a missing category, forest size, test share, seed, least rows.
CATEGORIES = ("clase", "diseno_via", "comuna")
NUMBERS = ("hora", "dia_semana", "mes_accidente", "longitud", "latitud")
UNKNOWN_CATEGORY = "DESCONOCIDO"
TREES, DEPTH, TEST_SHARE, SEED, LEAST_ROWS = 100, 10, 0.2, 42, 200
