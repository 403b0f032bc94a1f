"""Names and schemas in one place: wire payloads, lake tables, landing tables, defaults.

Tables inside the lake use English names. `WIRE_NAMES` maps them to the spelling that
producers and warehouse tables use, so either side can be read or written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _schema(ddl: str) -> T.StructType:
    fields = []
    for part in ddl.replace("\n", " ").split(","):
        name, kind = part.split()
        fields.append(T.StructField(name, _KINDS[kind]))
    return T.StructType(fields)


_KINDS = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "binary": T.BinaryType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
}

# --- broker records -------------------------------------------------------------------

RECORD = _schema(
    "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"
)

# --- payloads on the wire (fixed values: field names as producers send them) ------------

# Text-typed fields: a field of another JSON type is kept as its JSON text, so one
# schema reads both spellings of a feed and both shapes of `clima`.
TRIP_PAYLOAD = _schema(
    """ts_evento string, id_viagem string, viagem_id string, id_passageiro string,
    passageiro_id string, id_motorista string, motorista_id string, preco string,
    preco_estimado string, status string, fonte string, origem_lat string, origem_lon string,
    destino_lat string, destino_lon string"""
)
GPS_PAYLOAD = _schema(
    """ts_evento string, veiculo_id string, id_motorista string, tipo_veiculo string,
    linha string, estado string, cidade string, bairro string, latitude double,
    longitude double, velocidade_kmh double, velocidade double, rumo_graus int,
    precisao_m int, fonte_gps string, fonte string, status_sinal string, clima string"""
)
INCIDENT_PAYLOAD = _schema(
    """incidente_id string, id_incidente string, ts_evento string, tipo_incidente string,
    tipo string, severidade string, gravidade string, estado string, cidade string,
    bairro string, latitude double, longitude double, faixa_interditada boolean,
    impacto string, fonte string"""
)
WEATHER_PAYLOAD = _schema(
    """ts_evento string, estado string, cidade string, latitude double, longitude double,
    fonte string, clima string"""
)
# Fields that silver keeps of a traffic observation; the payload itself stays in bronze.
TRAFFIC_FIELDS = (
    "event_id", "tipo", "provider", "city", "region_id", "label", "point_lat", "point_lon",
    "ts_evento", "ts_coleta", "status", "error_message", "congestion_ratio",
)
WEATHER_OBJECT = T.StructType(
    [
        T.StructField("condicao", T.StringType()),
        T.StructField("temperatura_c", T.DoubleType()),
        T.StructField("chuva_mm_h", T.DoubleType()),
        T.StructField("visibilidade_m", T.LongType()),
    ]
)

# Canonical column -> accepted spellings, in order of precedence (fixed values).
TRIP_ALIASES = {
    "status": ("status",),
    "source": ("fonte",),
    "trip_id": ("id_viagem", "viagem_id"),
    "passenger_id": ("id_passageiro", "passageiro_id"),
    "driver_id": ("id_motorista", "motorista_id"),
    "price": ("preco", "preco_estimado"),
}
TRIP_PLACES = {
    "origin_lat": ("origem_lat",),
    "origin_lon": ("origem_lon",),
    "destination_lat": ("destino_lat",),
    "destination_lon": ("destino_lon",),
}
GPS_ALIASES = {
    "vehicle_id": ("veiculo_id", "id_motorista"),
    "speed_kmh": ("velocidade_kmh", "velocidade"),
    "source": ("fonte_gps", "fonte"),
}
INCIDENT_ALIASES = {
    "incident_id": ("incidente_id", "id_incidente"),
    "type": ("tipo_incidente", "tipo"),
    "severity": ("severidade", "gravidade"),
}

# Spellings a table handed to the trip rollup may use; the first one present is taken (fixed values).
TRIP_COLUMN_NAMES = {
    "trip_id": ("viagem_id", "id_viagem", "trip_id"),
    "passenger_id": ("passageiro_id", "id_passageiro", "passenger_id"),
    "driver_id": ("motorista_id", "id_motorista", "driver_id"),
    "price": ("preco", "valor", "valor_total", "preco_total", "price"),
    "status": ("status",),
    "source": ("fonte", "source"),
}

# --- defaults for missing labels (fixed values) ----------------------------------------

DEFAULT_STATUS = "desconhecido"
DEFAULT_SOURCE = "simulado"
DEFAULT_GOLD_SOURCE = "desconhecida"
DEFAULT_CITY = "desconhecida"
DEFAULT_CONDITION = "nao_informada"
DEFAULT_TYPE = "nao_informado"
DEFAULT_SEVERITY = "nao_informado"

# --- lake tables -----------------------------------------------------------------------

BRONZE = {
    "trips": _schema(
        """broker_ts timestamp, topic string, partition int, offset bigint, key string,
        value string, ingest_ts timestamp, event_ts_text string, event_ts timestamp,
        event_date date"""
    ),
    "gps": _schema(
        """event_ts timestamp, vehicle_id string, vehicle_type string, line string,
        state string, city string, neighbourhood string, latitude double, longitude double,
        speed_kmh double, heading_deg int, precision_m int, source string,
        signal_status string, weather_condition string, weather_temperature_c double,
        weather_rain_mm_h double, weather_visibility_m bigint, event_date date"""
    ),
    "incidents": _schema(
        """incident_id string, event_ts_text string, type string, severity string,
        state string, city string, neighbourhood string, latitude double, longitude double,
        lane_closed boolean, impact string, source string, event_ts timestamp,
        event_date date"""
    ),
    "weather": _schema(
        """raw_json string, broker_ts timestamp, event_ts_text string, state string,
        city string, latitude double, longitude double, source string, weather string,
        event_ts timestamp, event_date date"""
    ),
}
BRONZE["traffic"] = BRONZE["trips"]

SILVER = {
    "trips": _schema(
        """status string, source string, event_ts timestamp, ingest_ts timestamp,
        trip_id string, passenger_id string, driver_id string, price double, year int,
        month int, day int, hour int, origin_lat double, origin_lon double,
        destination_lat double, destination_lon double, region_id string"""
    ),
    "gps": _schema(
        """event_ts timestamp, vehicle_id string, vehicle_type string, line string,
        state string, city string, neighbourhood string, latitude double, longitude double,
        speed_kmh double, heading_deg int, precision_m int, source string,
        signal_status string, weather_condition string, weather_temperature_c double,
        weather_rain_mm_h double, weather_visibility_m bigint, silver_process_ts timestamp,
        event_date date, event_hour int"""
    ),
    "incidents": _schema(
        """incident_id string, event_ts timestamp, type string, severity string,
        state string, city string, neighbourhood string, latitude double, longitude double,
        lane_closed boolean, impact string, source string, silver_process_ts timestamp,
        event_date date, event_hour int"""
    ),
    "weather": _schema(
        """event_ts timestamp, state string, city string, latitude double, longitude double,
        source string, condition string, temperature double, humidity double, rain double,
        silver_process_ts timestamp, event_date date, event_hour int"""
    ),
    "traffic": _schema(
        """event_id string, type string, provider string, city string, region_id string,
        label string, point_lat double, point_lon double, event_ts_text string,
        event_ts timestamp, collected_ts timestamp, status string, error_message string,
        congestion_ratio double, broker_ts timestamp, ingest_ts timestamp, topic string,
        partition int, offset bigint, silver_process_ts timestamp, event_date date,
        event_hour int"""
    ),
}

REGIONS = _schema("city string, region_id string, label string, lat double, lon double")

# --- landing tables (fixed values: warehouse column names and types) --------------------

LANDING = {
    "trips_hourly": _schema(
        """STATUS string, FONTE string, QTD_REGISTROS bigint, QTD_VIAGENS_DISTINTAS bigint,
        QTD_PASSAGEIROS_DISTINTOS bigint, QTD_MOTORISTAS_DISTINTOS bigint,
        PRECO_MEDIO double, PRECO_TOTAL double, GOLD_PROCESS_TS timestamp_ntz, HORA bigint,
        ANO bigint, MES bigint, DIA bigint"""
    ),
    "weather_hourly": _schema(
        """CIDADE string, TEMPERATURA_MEDIA double, CHUVA_MM double, CONDICAO string,
        FONTE string, GOLD_PROCESS_TS timestamp_ntz"""
    ),
    "gps_hourly": _schema(
        """CIDADE string, LATITUDE double, LONGITUDE double, VELOCIDADE_MEDIA double,
        FONTE string, GOLD_PROCESS_TS timestamp_ntz"""
    ),
    "incidents_hourly": _schema(
        """CIDADE string, TIPO_INCIDENTE string, QUANTIDADE bigint, FONTE string,
        GOLD_PROCESS_TS timestamp_ntz"""
    ),
    "traffic_hourly": _schema(
        """CIDADE string, NIVEL_CONGESTIONAMENTO double, VELOCIDADE_MEDIA double,
        FONTE string, GOLD_PROCESS_TS timestamp_ntz"""
    ),
}

# Gold columns that feed a landing column of another name (fixed values).
LANDING_SOURCES = {
    "weather_hourly": {"CHUVA_MM": "precipitacao_total", "CONDICAO": "condicao_climatica"},
    "incidents_hourly": {"TIPO_INCIDENTE": "tipo", "QUANTIDADE": "qtd_incidentes"},
    "traffic_hourly": {"NIVEL_CONGESTIONAMENTO": "congestion_ratio_medio"},
}

# --- canonical name -> wire name, per table (fixed values) -------------------------------

_KEYS = {"event_date": "dt_ref", "event_hour": "hora_ref"}
_PARTS = {"year": "ano", "month": "mes", "day": "dia", "hour": "hora"}
WIRE_NAMES = {
    "silver.trips": {
        "source": "fonte",
        "trip_id": "id_viagem",
        "passenger_id": "id_passageiro",
        "driver_id": "id_motorista",
        "price": "preco",
        "origin_lat": "origem_lat",
        "origin_lon": "origem_lon",
        "destination_lat": "destino_lat",
        "destination_lon": "destino_lon",
        **_PARTS,
    },
    "silver.gps": {
        "event_ts": "ts_evento",
        "vehicle_id": "veiculo_id",
        "vehicle_type": "tipo_veiculo",
        "line": "linha",
        "state": "estado",
        "city": "cidade",
        "neighbourhood": "bairro",
        "speed_kmh": "velocidade_kmh",
        "heading_deg": "rumo_graus",
        "precision_m": "precisao_m",
        "source": "fonte_gps",
        "signal_status": "status_sinal",
        "weather_condition": "clima_condicao",
        "weather_temperature_c": "clima_temperatura_c",
        "weather_rain_mm_h": "clima_chuva_mm_h",
        "weather_visibility_m": "clima_visibilidade_m",
        **_KEYS,
    },
    "silver.incidents": {
        "incident_id": "incidente_id",
        "event_ts": "event_ts_ref",
        "type": "tipo_incidente",
        "severity": "severidade",
        "state": "estado",
        "city": "cidade",
        "neighbourhood": "bairro",
        "lane_closed": "faixa_interditada",
        "impact": "impacto",
        "source": "fonte",
        **_KEYS,
    },
    "silver.weather": {
        "event_ts": "ts_evento",
        "state": "estado",
        "city": "cidade",
        "source": "fonte",
        "condition": "condicao",
        "temperature": "temperatura",
        "humidity": "umidade",
        "rain": "precipitacao",
        "event_date": "dt",
        "event_hour": "hora",
    },
    "silver.traffic": {
        "type": "tipo",
        "city": "cidade",
        "event_ts_text": "ts_evento_payload",
        "event_ts": "ts_evento_ref",
        "collected_ts": "ts_coleta",
        "broker_ts": "kafka_timestamp",
        **_KEYS,
    },
    "gold.trips_hourly": {
        "source": "fonte",
        "records": "qtd_registros",
        "distinct_trips": "qtd_viagens_distintas",
        "distinct_passengers": "qtd_passageiros_distintos",
        "distinct_drivers": "qtd_motoristas_distintos",
        "mean_price": "preco_medio",
        "total_price": "preco_total",
        **_KEYS,
        **_PARTS,
    },
    "gold.gps_hourly": {
        "city": "cidade",
        "signals": "qtd_eventos_gps",
        "distinct_vehicles": "qtd_veiculos_distintos",
        "mean_speed": "velocidade_media",
        "min_speed": "velocidade_min",
        "max_speed": "velocidade_max",
        **_KEYS,
    },
    "gold.gps_mobility_hourly": {
        "state": "estado",
        "city": "cidade",
        "neighbourhood": "bairro",
        "vehicle_type": "tipo_veiculo",
        "signals": "qtd_sinais_gps",
        "distinct_vehicles": "qtd_veiculos_distintos",
        "mean_speed": "velocidade_media_kmh",
        "max_speed": "velocidade_max_kmh",
        "min_speed": "velocidade_min_kmh",
        "mean_precision": "precisao_media_m",
        "event_date": "dt",
        "event_hour": "hora",
    },
    "gold.weather_hourly": {
        "city": "cidade",
        "condition": "condicao_climatica",
        "observations": "qtd_eventos_clima",
        "mean_temperature": "temperatura_media",
        "max_temperature": "temperatura_max",
        "min_temperature": "temperatura_min",
        "mean_humidity": "umidade_media",
        "total_rain": "precipitacao_total",
        **_KEYS,
    },
    "gold.weather_condition_hourly": {
        "state": "estado",
        "city": "cidade",
        "condition": "condicao",
        "observations": "qtd_eventos_climaticos",
        "distinct_sources": "qtd_fontes_distintas",
        "event_date": "dt",
        "event_hour": "hora",
    },
    "gold.traffic_hourly": {
        "city": "cidade",
        "observations": "qtd_eventos_trafego",
        "observations_with_ratio": "qtd_eventos_com_ratio",
        "mean_ratio": "congestion_ratio_medio",
        "max_ratio": "congestion_ratio_max",
        "min_ratio": "congestion_ratio_min",
        "errors": "qtd_status_error",
        **_KEYS,
    },
    "gold.incidents_hourly": {
        "city": "cidade",
        "type": "tipo",
        "severity": "severidade",
        "incidents": "qtd_incidentes",
        "distinct_incidents": "qtd_incidentes_distintos",
        **_KEYS,
    },
    "gold.incidents_detail_hourly": {
        "state": "estado",
        "city": "cidade",
        "neighbourhood": "bairro",
        "type": "tipo_incidente",
        "severity": "severidade",
        "impact": "impacto",
        "incidents": "qtd_incidentes",
        "distinct_incidents": "qtd_incidentes_unicos",
        "lane_closed": "qtd_faixa_interditada",
        "latest_event_ts": "ultimo_evento_ts",
        **_KEYS,
    },
    "mart.daily_operations": {
        "date": "data",
        "total_trips": "total_viagens",
        "total_records": "total_registros",
        "total_passengers": "total_passageiros",
        "total_drivers": "total_motoristas",
        "revenue": "faturamento",
        "mean_ticket": "ticket_medio",
        "mean_temperature": "temperatura_media",
        "mean_speed": "velocidade_media_trafego",
        "mean_congestion": "nivel_congestionamento_medio",
        "weather_status": "status_clima",
        "traffic_status": "status_trafego",
    },
}


def to_wire(df: DataFrame, table: str) -> DataFrame:
    """Rename canonical columns to the wire spelling of `table`."""
    return df.withColumnsRenamed(WIRE_NAMES[table])


def from_wire(df: DataFrame, table: str) -> DataFrame:
    """Rename wire columns of `table` to their canonical names."""
    return df.withColumnsRenamed({wire: name for name, wire in WIRE_NAMES[table].items()})
