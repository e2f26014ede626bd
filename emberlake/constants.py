"""Domain constants. Everything in this module is a fixed value of the data model."""

from __future__ import annotations

SOURCES = ("FIRMS", "METEO", "CAMS", "CHIRPS", "MODIS", "INUMET")

# Countries in scope and their names.
COUNTRY_NAMES = {"URY": "Uruguay", "ARG": "Argentina", "BRA": "Brasil"}
COUNTRIES = tuple(COUNTRY_NAMES)

# Country spellings accepted in raw files.
COUNTRY_ALIASES = {
    "UY": "URY",
    "AR": "ARG",
    "BR": "BRA",
    "URUGUAY": "URY",
    "ARGENTINA": "ARG",
    "BRASIL": "BRA",
}
# Dataset preparation also accepts the English spelling.
PREPARATION_ALIASES = {**COUNTRY_ALIASES, "BRAZIL": "BRA"}

# First and last day of the period.
PERIOD_START = "2018-01-01"
PERIOD_END = "2025-12-31"

# Places known by name, with country and coordinates.
PLACES = [
    # key, country, latitude, longitude
    ("montevideo", "URY", -34.90, -56.16),
    ("artigas", "URY", -30.40, -56.47),
    ("canelones", "URY", -34.52, -56.28),
    ("maldonado", "URY", -34.90, -54.95),
    ("rocha", "URY", -34.48, -54.33),
    ("treinta_y_tres", "URY", -33.23, -54.38),
    ("cerro_largo", "URY", -32.37, -54.17),
    ("rivera", "URY", -30.90, -55.55),
    ("salto", "URY", -31.38, -57.97),
    ("paysandu", "URY", -32.32, -58.08),
    ("paysandú", "URY", -32.32, -58.08),
    ("rio_negro", "URY", -33.12, -58.31),
    ("fray_bentos", "URY", -33.12, -58.31),
    ("soriano", "URY", -33.25, -58.03),
    ("mercedes", "URY", -33.25, -58.03),
    ("colonia", "URY", -34.47, -57.84),
    ("colonia_del_sacramento", "URY", -34.47, -57.84),
    ("san_jose", "URY", -34.34, -56.71),
    ("san_josé", "URY", -34.34, -56.71),
    ("san_jose_de_mayo", "URY", -34.34, -56.71),
    ("flores", "URY", -33.54, -56.89),
    ("trinidad", "URY", -33.54, -56.89),
    ("florida", "URY", -34.10, -56.21),
    ("durazno", "URY", -33.41, -56.50),
    ("lavalleja", "URY", -34.37, -55.23),
    ("minas", "URY", -34.37, -55.23),
    ("melo", "URY", -32.37, -54.17),
    ("tacuarembo", "URY", -31.73, -55.98),
    ("tacuarembó", "URY", -31.73, -55.98),
    ("buenos_aires", "ARG", -34.61, -58.37),
    ("mendoza", "ARG", -32.89, -68.84),
    ("posadas", "ARG", -27.37, -55.90),
    ("salta", "ARG", -24.79, -65.41),
    ("brasilia", "BRA", -15.78, -47.93),
    ("brasília", "BRA", -15.78, -47.93),
    ("campo_grande", "BRA", -20.47, -54.62),
    ("cuiaba", "BRA", -15.60, -56.10),
    ("cuiabá", "BRA", -15.60, -56.10),
    ("manaus", "BRA", -3.12, -60.02),
    ("porto_alegre", "BRA", -30.03, -51.23),
]
PLACE_COUNTRY = {key: country for key, country, _, _ in PLACES}
PLACE_LATITUDE = {key: lat for key, _, lat, _ in PLACES}
PLACE_LONGITUDE = {key: lon for key, _, _, lon in PLACES}

# Place names recognised while preparing datasets (a different list).
PREPARATION_PLACES = {
    "URY": [
        "montevideo", "artigas", "canelones", "maldonado", "rocha", "treinta_y_tres",
        "cerro_largo", "rivera", "salto", "paysandu", "paysandú", "rio_negro", "soriano",
        "colonia", "colonia_del_sacramento", "san_jose", "san_josé", "flores", "florida",
        "durazno", "lavalleja", "tacuarembo", "tacuarembó", "melo",
    ],
    "ARG": [
        "buenos_aires", "mendoza", "posadas", "salta", "misiones", "corrientes", "chaco",
        "formosa", "santiago_del_estero",
    ],
    "BRA": [
        "brasilia", "brasília", "campo_grande", "cuiaba", "cuiabá", "manaus", "porto_alegre",
        "rio_grande_do_sul", "santa_catarina", "parana", "paraná", "uruguaiana", "pelotas",
        "caxias_do_sul",
    ],
}
PREPARATION_PLACE_COUNTRY = {
    place: country for country, places in PREPARATION_PLACES.items() for place in places
}

# Monitoring points of the hourly weather and air-quality payloads.
MONITORING_POINTS = [
    # name, country, place, latitude, longitude
    ("UY_Montevideo", "URY", "Montevideo", -34.90, -56.16),
    ("UY_Canelones", "URY", "Canelones", -34.52, -56.28),
    ("UY_Maldonado", "URY", "Maldonado", -34.90, -54.95),
    ("UY_Rocha", "URY", "Rocha", -34.48, -54.33),
    ("UY_Treinta_y_Tres", "URY", "Treinta_y_Tres", -33.23, -54.38),
    ("UY_Cerro_Largo", "URY", "Cerro_Largo", -32.37, -54.17),
    ("UY_Rivera", "URY", "Rivera", -30.90, -55.55),
    ("UY_Artigas", "URY", "Artigas", -30.40, -56.47),
    ("UY_Salto", "URY", "Salto", -31.38, -57.97),
    ("UY_Paysandu", "URY", "Paysandu", -32.32, -58.08),
    ("UY_Rio_Negro", "URY", "Rio_Negro", -33.12, -58.31),
    ("UY_Soriano", "URY", "Soriano", -33.25, -58.03),
    ("UY_Colonia", "URY", "Colonia", -34.47, -57.84),
    ("UY_San_Jose", "URY", "San_Jose", -34.34, -56.71),
    ("UY_Flores", "URY", "Flores", -33.54, -56.89),
    ("UY_Florida", "URY", "Florida", -34.10, -56.21),
    ("UY_Durazno", "URY", "Durazno", -33.41, -56.50),
    ("UY_Lavalleja", "URY", "Lavalleja", -34.37, -55.23),
    ("UY_Tacuarembo", "URY", "Tacuarembo", -31.73, -55.98),
    ("AR_Misiones", "ARG", "Misiones", -27.37, -55.90),
    ("AR_Corrientes", "ARG", "Corrientes", -27.48, -58.83),
    ("AR_Chaco", "ARG", "Chaco", -27.45, -58.98),
    ("AR_Formosa", "ARG", "Formosa", -26.18, -58.18),
    ("AR_Santiago_del_Estero", "ARG", "Santiago_del_Estero", -27.78, -64.26),
    ("AR_Salta", "ARG", "Salta", -24.79, -65.41),
    ("BR_Rio_Grande_do_Sul", "BRA", "Rio_Grande_do_Sul", -30.03, -51.23),
    ("BR_Santa_Catarina", "BRA", "Santa_Catarina", -27.59, -48.55),
    ("BR_Parana", "BRA", "Parana", -25.42, -49.27),
    ("BR_Uruguaiana", "BRA", "Uruguaiana", -29.76, -57.09),
    ("BR_Pelotas", "BRA", "Pelotas", -31.77, -52.34),
    ("BR_Caxias_do_Sul", "BRA", "Caxias_do_Sul", -29.17, -51.18),
]

# Weather stations kept from the station files.
STATIONS = [
    # name, department, latitude, longitude
    ("Rocha G3", "Rocha", -34.48, -54.33),
    ("Colonia G3", "Colonia", -34.47, -57.84),
    ("Salto G3", "Salto", -31.38, -57.97),
    ("Paso de los Toros G3", "Tacuarembo", -32.82, -56.51),
    ("Aeropuerto Melilla G3", "Montevideo", -34.79, -56.26),
    ("Mercedes G3", "Soriano", -33.25, -58.03),
    ("Artigas G3", "Artigas", -30.40, -56.47),
]

# Land-cover labels by code.
LAND_COVER_LABELS = {
    1: "Bosque perenne de coniferas",
    2: "Bosque perenne latifoliado",
    3: "Bosque deciduo de coniferas",
    4: "Bosque deciduo latifoliado",
    5: "Bosque mixto",
    6: "Matorral cerrado",
    7: "Matorral abierto",
    8: "Sabana lenosa",
    9: "Sabana",
    10: "Pastizal",
    11: "Humedal permanente",
    12: "Cultivos",
    13: "Urbano y construido",
    14: "Mosaico cultivos/vegetacion natural",
    15: "Nieve y hielo",
    16: "Suelo desnudo o vegetacion escasa",
    17: "Agua",
}

# Association thresholds in km and source preference on equal distance.
THRESHOLD_KM = {"METEO": 100.0, "INUMET": 150.0, "CHIRPS": 100.0, "MODIS": 100.0, "CAMS": 100.0}
SOURCE_PRIORITY = {"INUMET": 0, "METEO": 1}
EARTH_RADIUS_KM = 6371.0088

# Raw column names accepted for each canonical column, first non-null wins.
COLUMN_ALIASES = {
    "pais_codigo": ("pais_codigo", "pais", "country"),
    "ubicacion": ("ubicacion", "punto", "location", "estacion"),
    "latitud": ("latitud", "latitude", "lat"),
    "longitud": ("longitud", "longitude", "lon"),
    "firms.latitud": ("latitud", "latitude"),
    "firms.longitud": ("longitud", "longitude"),
    "fecha_adq": ("fecha_adq", "acq_date", "fecha"),
    "hora_adq_hhmm": ("hora_adq_hhmm", "acq_time"),
    "frp_mw": ("frp_mw", "frp", "potencia_radiativa"),
    "confianza": ("confianza", "confidence", "confianza_num", "confianza_raw"),
    "dia_noche": ("dia_noche", "daynight"),
    "brillo_termico": ("brillo_termico", "brightness", "bright_ti4", "brillo_ti4"),
    "satelite": ("satelite", "satellite"),
    "instrumento": ("instrumento", "instrument"),
    "meteo.fecha_hora_utc": (
        "fecha_hora_utc", "time", "datetime", "fecha_hora", "fecha", "date",
    ),
    "temperatura_c": ("temperatura_c", "temperature_2m", "temperature", "temperature_2m_max"),
    "humedad_pct": (
        "humedad_pct", "relative_humidity_2m", "humidity", "relative_humidity_2m_min",
    ),
    "viento_kmh": ("viento_kmh", "wind_speed_10m", "wind_speed", "wind_speed_10m_max"),
    "direccion_viento_grados": (
        "direccion_viento_grados", "wind_direction_10m", "wind_direction_10m_dominant",
    ),
    "presion_superficie_hpa": ("presion_superficie_hpa", "surface_pressure"),
    "meteo.precipitacion_mm": ("precipitacion_mm", "rain", "precipitation_sum"),
    "chirps.fecha": ("fecha", "date"),
    "chirps.precipitacion_mm": ("precipitacion_mm", "precipitation", "rain"),
    "anio": ("anio", "year"),
    "codigo_cobertura": ("codigo_cobertura", "valor", "lc_type1"),
    "descripcion_cobertura": ("descripcion_cobertura", "lc_descripcion"),
    "cams.fecha_hora_utc": (
        "fecha_hora_utc", "time", "datetime", "fecha_hora", "date", "fecha",
    ),
    "pm25": ("pm25", "pm2_5", "pm2.5", "pm2_5_media"),
    "pm10": ("pm10", "pm10_media"),
}

# Detection complement columns and the canonical upper-case schema.
COMPLEMENT_COLUMNS = {
    "LATITUDE": ("latitude", "latitud"),
    "LONGITUDE": ("longitude", "longitud"),
    "BRIGHTNESS": ("brightness", "brillo_ti4", "bright_ti4"),
    "SCAN": ("scan",),
    "TRACK": ("track",),
    "ACQ_DATE": ("acq_date", "fecha_adq", "date"),
    "ACQ_TIME": ("acq_time", "hora_adq_hhmm"),
    "SATELLITE": ("satellite", "satelite"),
    "INSTRUMENT": ("instrument", "instrumento"),
    "CONFIDENCE": ("confidence", "confianza_raw", "confianza_num"),
    "VERSION": ("version",),
    "BRIGHT_T31": ("bright_t31", "brillo_ti5"),
    "FRP": ("frp", "potencia_radiativa"),
    "DAYNIGHT": ("daynight", "dia_noche"),
    "TYPE": ("type",),
}
COMPLEMENT_OPTIONAL = ("SCAN", "TRACK", "VERSION", "TYPE")

# Columns kept from detection files, in either of their two schemas.
DETECTION_COLUMNS = (
    "latitud", "longitud", "brillo_ti4", "fecha_adq", "hora_adq_hhmm", "satelite",
    "instrumento", "confianza_raw", "potencia_radiativa", "dia_noche", "pais_codigo", "pais",
    "latitude", "longitude", "brightness", "scan", "track", "acq_date", "acq_time", "satellite",
    "instrument", "confidence", "version", "bright_t31", "frp", "daynight", "type",
    "geometry_wkt",
)
DETECTION_DATE_COLUMNS = ("fecha_adq", "acq_date", "fecha")
OPTION_DATE_COLUMNS = (
    "fecha", "fecha_adq", "acq_date", "date", "time", "datetime", "fecha_hora",
    "fecha_hora_utc",
)
AUDIT_DATE_COLUMNS = (
    "fecha_adq", "acq_date", "fecha", "date", "time", "datetime", "fecha_hora",
    "fecha_hora_utc", "anio", "year",
)
REGION_NAME_COLUMNS = (
    "region", "departamento", "nombre", "name", "nam", "depto", "nomdep",
    "nombre_departamento", "admlnm", "departamen", "departamento_nombre",
)

# Numeric columns of the prepared weather files.
WEATHER_NUMERIC_COLUMNS = (
    "latitud", "longitud", "temperature_2m", "relative_humidity_2m", "wind_speed_10m",
    "wind_direction_10m", "rain", "surface_pressure", "temperature_2m_max",
    "temperature_2m_min", "relative_humidity_2m_min", "relative_humidity_2m_max",
    "wind_speed_10m_max", "wind_direction_10m_dominant", "precipitation_sum",
    "et0_fao_evapotranspiration", "riesgo_temp", "riesgo_humedad", "riesgo_viento",
    "riesgo_sequia", "indice_riesgo",
)

ZERO_HASH = "0" * 64

# Document collections, required fields and value domains.
COLLECTIONS = {
    "ingesta_metadata": {
        "required": ("run_id", "fuente", "estado", "metricas", "registrado_en"),
        "domains": {"fuente": SOURCES, "estado": ("ok", "parcial", "error")},
    },
    "rechazos_etl": {
        "required": ("run_id", "fuente", "motivo", "registro", "registrado_en"),
        "domains": {"fuente": SOURCES},
    },
    "raw_payloads": {
        "required": ("run_id", "fuente", "payload", "registrado_en"),
        "domains": {"fuente": SOURCES},
    },
    "pipeline_logs": {
        "required": ("run_id", "fuente", "estado", "mensaje", "registrado_en"),
        "domains": {"fuente": SOURCES, "estado": ("inicio", "ok", "parcial", "error")},
    },
    "snapshots_firms": {
        "required": ("fecha", "pais_codigo", "total_focos", "resumen"),
        "domains": {"pais_codigo": COUNTRIES},
    },
}
# Parts of key names whose values are redacted.
SENSITIVE_KEYS = (
    "password", "passwd", "token", "secret", "api[_-]?key", "authorization", "credential",
)
