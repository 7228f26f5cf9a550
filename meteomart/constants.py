"""Fixed values that must equal the pipeline being re-implemented.

Everything in this module is data, not logic: names, thresholds, lookup
tables and tokens, kept together and in their natural order.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES: state (UF) -> IANA time zone, default for NULL/unknown states.
# ---------------------------------------------------------------------------
UF_TIMEZONE = {
    "AC": "America/Rio_Branco",
    "AL": "America/Maceio",
    "AP": "America/Belem",
    "BA": "America/Bahia",
    "CE": "America/Fortaleza",
    "DF": "America/Sao_Paulo",
    "ES": "America/Sao_Paulo",
    "GO": "America/Sao_Paulo",
    "MA": "America/Fortaleza",
    "MG": "America/Sao_Paulo",
    "PA": "America/Belem",
    "PB": "America/Fortaleza",
    "PE": "America/Recife",
    "PI": "America/Fortaleza",
    "PR": "America/Sao_Paulo",
    "RJ": "America/Sao_Paulo",
    "RN": "America/Fortaleza",
    "RO": "America/Porto_Velho",
    "RR": "America/Boa_Vista",
    "RS": "America/Sao_Paulo",
    "SC": "America/Sao_Paulo",
    "SE": "America/Maceio",
    "SP": "America/Sao_Paulo",
    "TO": "America/Araguaina",
    "MS": "America/Campo_Grande",
    "MT": "America/Cuiaba",
    "AM": "America/Manaus",
}
DEFAULT_TIMEZONE = "America/Sao_Paulo"

# ---------------------------------------------------------------------------
# FIXED VALUES: class labels of the domain classifiers.
# ---------------------------------------------------------------------------
RAIN_CLASSES = ["sem_dado", "sem_chuva", "chuva_fraca", "chuva_moderada", "chuva_intensa"]
WIND_CLASSES = ["sem_dado", "vento_fraco", "vento_moderado", "vento_forte", "vento_tempestade"]
DAY_PERIODS = ["madrugada", "manha", "tarde", "noite"]

# Rain: (0, 5] light, (5, 25] moderate, anything else heavy.
RAIN_LIGHT_MAX_MM = 5
RAIN_MODERATE_MAX_MM = 25
# Gust: < 10 weak, [10, 20) moderate, [20, 35) strong, anything else storm.
GUST_MODERATE_MIN_MS = 10
GUST_STRONG_MIN_MS = 20
GUST_STORM_MIN_MS = 35
# Day period from the UTC hour: 0-5, 6-11, 12-17, otherwise night.
PERIOD_BOUNDS = [(0, 5, "madrugada"), (6, 11, "manha"), (12, 17, "tarde")]

# ---------------------------------------------------------------------------
# FIXED VALUES: surrogate keys are md5 over '-'-joined text, NULL parts
# replaced by this sentinel (public behaviour of the key macro package).
# ---------------------------------------------------------------------------
SURROGATE_KEY_NULL = "_dbt_utils_surrogate_key_null_"
SURROGATE_KEY_SEP = "-"

# ---------------------------------------------------------------------------
# FIXED VALUES: header handling of station files.
# ---------------------------------------------------------------------------
# Canonical name -> prefix, in priority order (first match wins; an exact
# canonical name already present is kept as is).
CANONICAL_PREFIXES = [
    ("data", "data"),
    ("hora_utc", "hora_utc"),
    ("hora", "hora"),
    ("temperatura_do_ar_bulbo_seco_horaria", "temperatura_do_ar_bulbo_seco_horaria"),
    ("umidade_relativa_do_ar_horaria", "umidade_relativa_do_ar_horaria"),
    ("precipitacao_total_horario", "precipitacao_total_horario"),
]
HEADER_SCAN_LINES = 40
HEADER_MIN_SEPARATORS = 10
HEADER_NOT_FOUND_MESSAGE = "Cabeçalho tabular não encontrado no arquivo INMET."
SUCCESS_MESSAGE = "Arquivo processado com sucesso."
ERROR_DETAILS_MAX_CHARS = 5000

# Text cells read as missing (default NA tokens of the CSV reader used upstream).
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
]

# ---------------------------------------------------------------------------
# FIXED VALUES: raw validation suite (run-time rule set).
# ---------------------------------------------------------------------------
REQUIRED_COLUMNS = [
    ("data", ["data"]),
    ("hora_referencia", ["hora_referencia", "hora", "hora_utc"]),
    ("meta_codigo_wmo", ["meta_codigo_wmo"]),
    ("temperatura_do_ar_bulbo_seco_horaria", ["temperatura_do_ar_bulbo_seco_horaria"]),
    ("umidade_relativa_do_ar_horaria", ["umidade_relativa_do_ar_horaria"]),
    ("precipitacao_total_horario", ["precipitacao_total_horario"]),
    ("vento_velocidade_horaria", ["vento_velocidade_horaria", "vento_velocidade_horaria_m_s"]),
    ("vento_direcao_horaria_graus", ["vento_direcao_horaria_graus", "vento_direcao_horaria_gr_gr"]),
    ("vento_rajada_maxima_horaria", ["vento_rajada_maxima_horaria", "vento_rajada_maxima_m_s"]),
    ("pressao_atmosferica_ao_nivel_da_estacao_horaria",
     ["pressao_atmosferica_ao_nivel_da_estacao_horaria",
      "pressao_atmosferica_ao_nivel_da_estacao_horaria_mb"]),
    ("source_year", ["source_year"]),
]
NOT_NULL_COLUMNS = ["data", "meta_codigo_wmo"]
# (canonical column, min, max, mostly)
RANGE_RULES = [
    ("umidade_relativa_do_ar_horaria", 0, 100, 0.98),
    ("temperatura_do_ar_bulbo_seco_horaria", -20, 55, 0.98),
    ("precipitacao_total_horario", 0, None, 0.999),
]
MIN_EXPECTED_ROWS = 100_000
MAX_EXPECTED_ROWS = 10_000_000      # upstream's setting; here the default is no maximum
CHECKPOINT_NAME = "raw_inmet_weather_checkpoint"

# ---------------------------------------------------------------------------
# FIXED VALUES: gold-layer generic tests.
# ---------------------------------------------------------------------------
UNIQUE_TESTS = [
    ("dim_station", "station_sk"),
    ("dim_date", "date_sk"),
    ("dim_time", "time_sk"),
    ("fact_weather_hourly", "weather_event_sk"),
]
NOT_NULL_TESTS = [
    ("stg_inmet_weather", "data_referencia"),
    ("stg_inmet_weather", "hora_referencia"),
    ("stg_inmet_weather", "codigo_wmo"),
    ("dim_station", "station_sk"),
    ("dim_station", "codigo_wmo"),
    ("dim_date", "date_sk"),
    ("dim_time", "time_sk"),
    ("fact_weather_hourly", "weather_event_sk"),
    ("fact_weather_hourly", "station_sk"),
    ("fact_weather_hourly", "date_sk"),
    ("fact_weather_hourly", "time_sk"),
]
ACCEPTED_VALUES_TESTS = [
    ("dim_date", "mes", list(range(1, 13))),
    ("dim_time", "hora_int", list(range(0, 24))),
    ("dim_time", "periodo_dia", DAY_PERIODS),
    ("fact_weather_hourly", "intensidade_chuva", RAIN_CLASSES),
    ("fact_weather_hourly", "risco_vento", WIND_CLASSES),
]

# Ingestion log table layout.
LOG_STATUS_SUCCESS = "success"
LOG_STATUS_ERROR = "error"
LOG_STATUS_QUARANTINED = "quarantined"
QUARANTINED_MESSAGE = "Todas as linhas em quarentena."
LOAD_MODES = ("full_refresh", "incremental")
