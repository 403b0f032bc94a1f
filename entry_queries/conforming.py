"""Parsing, scalar functions, filters and the silver tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from entry_queries import views as v
from entry_queries.registry import query
from entry_queries.views import with_views
from mobility_lake import contracts
from mobility_lake.functions.display import format_br
from mobility_lake.functions.times import iso_utc, parse_event_time
from mobility_lake.functions.values import (
    clean_label,
    congestion_ratio,
    default_label,
    json_pick,
    to_number,
    weather_condition,
)
from mobility_lake.operators import conform as c
from mobility_lake.operators import quality as q
from mobility_lake.operators.dedup import dedup_events
from mobility_lake.plans import marts
from mobility_lake.plans.bronze import BRONZE
from mobility_lake.plans.feeds import FEEDS
from mobility_lake.plans.silver import MARK
from mobility_lake.sources.broker import record_envelope


@query(
    "record_envelope",
    with_views(
        """select ts as broker_ts, 'trips' as topic, cast(event_id % 8 as integer) as "partition",
        event_id as "offset", cast(event_id as varchar) as key,
        case when k <> 99 then event_type end as status,
        case when k <> 99 then ts_text end as time_text, k <> 99 as is_json from read""",
        "read",
    ),
)
def envelope(spark, sf):
    """The value is compared by fields of its JSON; the ingest time is not comparable."""
    records = record_envelope(v.trip_records(spark, sf))
    fields = {
        "status": F.get_json_object("value", "$.status"),
        "time_text": F.get_json_object("value", "$.ts_evento"),
        "is_json": F.get_json_object("value", "$").isNotNull(),
    }
    return records.withColumns(fields).drop("value", "ingest_ts")


_PRICE = "case when k >= 5 and k <> 99 then value end"


@query(
    "parse_payload",
    with_views(
        f"""select event_id as "offset", case when k <> 99 then event_type end as status,
        case when k <> 99 and event_id % 2 = 0 then cast(event_id // 2 as varchar) end as id_viagem,
        case when event_id % 2 = 0 then {_PRICE} end as preco,
        case when k <> 99 and event_id % 2 = 0 then k end as id_motorista,
        case when k <> 99 then ts_text end as ts_evento from read""",
        "read",
    ),
)
def parse_payload(spark, sf):
    schema = contracts._schema(
        "status string, id_viagem string, preco double, id_motorista string, ts_evento string"
    )
    parsed = c.parse_payload(v.trip_records(spark, sf), schema, keep=("offset",))
    return parsed.withColumn("id_motorista", F.col("id_motorista").try_cast("int"))


@query(
    "json_pick",
    with_views(
        f"""select event_id as "offset", case when k <> 99 then event_type end as status,
        case when event_id % 2 = 0 then {_PRICE} end as price,
        cast(null as integer) as status_as_int from ev""",
        "ev",
    ),
)
def json_pick_paths(spark, sf):
    value = F.col("value").cast("string")
    return v.trip_records(spark, sf).select(
        "offset",
        json_pick(value, "$.status").alias("status"),
        json_pick(value, "$.preco", "double").alias("price"),
        json_pick(value, "$.status", "int").alias("status_as_int"),
    )


@query(
    "resolve_alias",
    with_views(
        f"""select event_id as "offset",
        case when k <> 99 then cast(event_id // 2 as varchar) end as trip_id,
        case when k <> 99 then cast(user_id as varchar) end as passenger_id,
        case when k <> 99 then cast(k as varchar) end as driver_id, {_PRICE} as price,
        case when k <> 99 then event_type else 'desconhecido' end as status,
        case when k <> 99 and event_id % 2 = 0 then 'src' || (event_id % 3)
            else 'simulado' end as source from ev""",
        "ev",
    ),
)
def resolve_alias(spark, sf):
    records = record_envelope(v.trip_records(spark, sf))
    parsed = c.pick_fields(records, contracts.TRIP_PAYLOAD.names)
    defaults = {"status": contracts.DEFAULT_STATUS, "source": contracts.DEFAULT_SOURCE}
    return parsed.select(
        "offset",
        *[
            c.resolve_alias(
                parsed,
                (name,),
                spellings,
                "double" if name == "price" else "string",
                defaults.get(name),
            ).alias(name)
            for name, spellings in contracts.TRIP_ALIASES.items()
        ],
    )


@query(
    "parse_event_time",
    with_views("""select event_id, ts_text, text_ts as event_ts from read""", "read"),
)
def event_time(spark, sf):
    text = v.events(spark, sf).select("event_id", v.event_text().alias("ts_text"))
    return text.withColumn("event_ts", parse_event_time(F.col("ts_text")))


@query(
    "resolve_event_time",
    with_views(
        """select event_id as "offset", coalesce(case when k <> 99 then text_ts end, ts)
        as event_ts from read""",
        "read",
    ),
)
def event_time_precedence(spark, sf):
    records = record_envelope(v.trip_records(spark, sf))
    parsed = c.pick_fields(records, ["ts_evento"])
    candidates = ("event_ts", c.JSON_FIELD + "ts_evento", "broker_ts", "ingest_ts")
    return parsed.select("offset", c.resolve_event_time(parsed, candidates).alias("event_ts"))


@query(
    "event_calendar",
    with_views(
        """select event_id, event_date, event_hour, year, month, day, hour from
        (select event_id, cast(ts as date) as event_date, cast(hour(ts) as integer) as event_hour,
        cast(year(ts) as integer) as year, cast(month(ts) as integer) as month,
        cast(day(ts) as integer) as day, cast(hour(ts) as integer) as hour from ev)""",
        "ev",
    ),
)
def event_calendar(spark, sf):
    parts = ("event_date", "event_hour", "year", "month", "day", "hour")
    rows = c.with_event_calendar(v.events(spark, sf), parts, event_ts="ts")
    return rows.select("event_id", *parts)


@query(
    "date_from_parts",
    with_views(
        """select trip_id, event_date, event_hour, price from trips""",
        "trips",
    ),
)
def date_from_parts(spark, sf):
    parts = v.trips(spark, sf).select("trip_id", "price", "year", "month", "day", "hour")
    return c.event_date_from_parts(parts).drop("year", "month", "day", "hour")


@query(
    "iso_utc",
    "select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as iso from events",
)
def iso(spark, sf):
    return v.events(spark, sf).select("event_id", iso_utc(F.col("ts")).alias("iso"))


@query(
    "ensure_columns",
    with_views(
        """select vehicle_id, city, event_ts, cast(null as double) as heading_deg,
        'desconhecida' as line from gps""",
        "gps",
    ),
)
def ensure_columns(spark, sf):
    rows = v.gps(spark, sf).select("vehicle_id", "city", "event_ts")
    return c.ensure_columns(
        rows,
        {
            "city": ("string", "never used"),
            "heading_deg": ("double", None),
            "line": ("string", "desconhecida"),
        },
    )


@query(
    "rename_if_absent",
    with_views(
        """select vehicle_id, speed_kmh, vehicle_type as weather_condition,
        city, state as cidade from gps""",
        "gps",
    ),
)
def rename_if_absent(spark, sf):
    rows = v.gps(spark, sf).select(
        "vehicle_id",
        F.col("speed_kmh").alias("velocidade"),
        F.col("vehicle_type").alias("clima"),
        "city",
        F.col("state").alias("cidade"),
    )
    return c.rename_if_absent(
        rows, {"velocidade": "speed_kmh", "clima": "weather_condition", "cidade": "city"}
    )


@query(
    "flatten_struct",
    with_views(
        """select city, event_ts, condition as weather_condition,
        temperature as weather_temperature_c, rain as weather_rain_mm_h,
        cast(null as bigint) as weather_visibility_m from weather""",
        "weather",
    ),
)
def flatten_struct(spark, sf):
    nested = v.weather(spark, sf).select(
        "city",
        "event_ts",
        F.struct(
            F.col("condition").alias("condicao"),
            F.col("temperature").alias("temperatura_c"),
            F.col("rain").alias("chuva_mm_h"),
            F.lit(None).cast("bigint").alias("visibilidade_m"),
        ).alias("clima"),
    )
    return c.flatten_weather(nested)


@query(
    "weather_condition",
    "select event_id, event_type as condition from events",
)
def condition(spark, sf):
    rows = v.events(spark, sf).join(v.places(spark, sf), "m")
    return rows.select("event_id", weather_condition(v.weather_payload()).alias("condition"))


@query(
    "tolerant_number",
    with_views(
        """select event_id, case when k % 10 <> 0 then value end as number from ev""", "ev"
    ),
)
def tolerant_number(spark, sf):
    text = F.when(F.col("k") % 10 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string"))
    return v.events(spark, sf).select("event_id", to_number(text).alias("number"))


@query(
    "congestion_ratio",
    with_views(
        """select event_id, case when free_time_s > 0
        then current_time_s / cast(free_time_s as double) end as ratio from traffic""",
        "traffic",
    ),
)
def ratio(spark, sf):
    rows = v.traffic(spark, sf)
    return rows.select(
        "event_id", congestion_ratio(F.col("current_time"), F.col("free_time")).alias("ratio")
    )


@query(
    "format_br",
    """select o_orderkey,
    translate(format('{:,.2f}', o_totalprice), ',.', '.,') as amount,
    'R$ ' || translate(format('{:,.2f}', o_totalprice), ',.', '.,') as money,
    '-' as missing from orders""",
)
def display(spark, sf):
    price = F.col("o_totalprice")
    return v.table(spark, sf, "orders").select(
        "o_orderkey",
        format_br(price, 2).alias("amount"),
        format_br(price, 2, "R$ ").alias("money"),
        format_br(F.lit(None).cast("double")).alias("missing"),
    )


@query(
    "clean_label",
    with_views(
        """select incident_id, event_ts,
        case when trim(city) <> '' and upper(trim(city)) <> 'NULL' then trim(city) end as city,
        coalesce(type, 'nao_informado') as type from incidents""",
        "incidents",
    ),
)
def labels(spark, sf):
    return v.incidents(spark, sf).select(
        "incident_id",
        "event_ts",
        clean_label(F.col("city")).alias("city"),
        default_label(F.col("type"), contracts.DEFAULT_TYPE).alias("type"),
    )


# --- filters and checks ----------------------------------------------------------------------


@query(
    "require_all",
    with_views(
        "select incident_id, city, type, event_ts from incidents "
        "where city is not null and type is not null",
        "incidents",
    ),
)
def require_all(spark, sf):
    kept = q.require_all(v.incidents(spark, sf), ("city", "type"))
    return kept.select("incident_id", "city", "type", "event_ts")


@query(
    "require_any",
    with_views(
        "select vehicle_id, precision_m, city, event_ts from "
        "(select * replace (case when precision_m % 2 = 1 then city end as city) from gps) "
        "where event_ts is not null and (vehicle_id is not null or city is not null)",
        "gps",
    ),
)
def require_any(spark, sf):
    rows = v.gps(spark, sf).withColumn(
        "city", F.when(F.col("precision_m") % 2 == 1, F.col("city"))
    )
    kept = q.require_any(rows, ("event_ts",), ("vehicle_id", "city"))
    return kept.select("vehicle_id", "precision_m", "city", "event_ts")


@query(
    "reject_reasons",
    with_views(
        """select reject_reason, count(*) as rejected from (select case
        when city is null or trim(city) = '' or upper(trim(city)) = 'NULL' then 'no city'
        when type is null then 'no type' end as reject_reason from incidents)
        group by reject_reason""",
        "incidents",
    ),
)
def reject_reasons(spark, sf):
    """Good rows show up under the NULL reason, so nothing can get lost in between."""
    rows = v.incidents(spark, sf).withColumn("city", clean_label(F.col("city")))
    good, bad = q.split_rejects(
        rows, {"no city": q.missing("city"), "no type": q.missing("type")}
    )
    reasons = bad.select(q.REASON).unionAll(
        good.select(F.lit(None).cast("string").alias(q.REASON))
    )
    return reasons.groupBy(q.REASON).agg(F.count("*").alias("rejected"))


@query(
    "between_days",
    with_views(
        "select trip_id, event_ts, event_date, price from trips "
        "where event_date between date '2024-01-05' and date '2024-01-20'",
        "trips",
    ),
)
def between_days(spark, sf):
    days = q.between_days(
        v.trips(spark, sf), dt.date(2024, 1, 5), dt.date(2024, 1, 20), column="event_date"
    )
    return days.select("trip_id", "event_ts", "event_date", "price")


@query(
    "check_not_null",
    with_views(
        """select 'event_ts' as column_name,
        count(*) filter (where event_ts is null) as failing_rows from trips
        union all select 'trip_id', count(*) filter (where trip_id is null) from trips
        union all select 'price', count(*) filter (where price is null) from trips""",
        "trips",
    ),
)
def check_not_null(spark, sf):
    return q.check_not_null(v.trips(spark, sf), ("event_ts", "trip_id", "price"))


@query("check_row_count", "select count(*) as total_records from events")
def check_row_count(spark, sf):
    return q.check_row_count(v.trips(spark, sf))


# --- silver tables, from broker records --------------------------------------------------------


def _silver(feed: str):
    def build(spark, sf):
        good = q.accepted(MARK[feed](BRONZE[feed](v.RECORDS[feed](spark, sf))))
        plan = FEEDS[feed]
        kept = dedup_events(good, plan.dedup_keys, plan.dedup_order) if plan.dedup_keys else good
        return kept.drop("ingest_ts", "silver_process_ts")

    return build


query(
    "silver_trips",
    with_views(
        f"""select event_type as status,
        case when event_id % 2 = 0 then 'src' || (event_id % 3) else 'simulado' end as source,
        coalesce(text_ts, ts) as event_ts, cast(event_id // 2 as varchar) as trip_id,
        cast(user_id as varchar) as passenger_id, cast(k as varchar) as driver_id,
        {_PRICE} as price, cast(year(ts) as integer) as year,
        cast(month(ts) as integer) as month, cast(day(ts) as integer) as day,
        cast(hour(ts) as integer) as hour,
        case when event_id % 2 = 0 then (k + 0.5::double) / 100 end as origin_lat,
        case when event_id % 2 = 0 then (m + 0.5::double) / 100 end as origin_lon,
        case when event_id % 2 = 0 then -23.5::double end as destination_lat,
        cast(null as double) as destination_lon,
        case when event_id % 2 = 0 then k || ':' || m end as region_id from read where k <> 99
        qualify row_number() over (partition by event_id // 2, coalesce(text_ts, ts)
            order by status, source, passenger_id, driver_id, price nulls first,
            origin_lat nulls first, origin_lon nulls first) = 1""",
        "read",
    ),
)(_silver("trips"))

# The parity of an event decides whether its payload has coordinates; of two copies one stays.
_STORED_TRIPS = """select k, m, event_id from read where k <> 99
    qualify row_number() over (partition by event_id // 2, coalesce(text_ts, ts)
        order by event_type, case when event_id % 2 = 0 then 'src' || (event_id % 3) else 'simulado' end,
        cast(user_id as varchar), cast(k as varchar), """ + _PRICE + """ nulls first) = 1"""


@query(
    "top_regions_of_silver",
    with_views(
        f"""select k || ':' || m as region_id, count(*) as trips from ({_STORED_TRIPS})
        where event_id % 2 = 0 group by 1 order by trips desc, region_id limit 5""",
        "read",
    ),
)
def top_regions_of_silver(spark, sf):
    """The five grid cells where most stored trips start."""
    return marts.top_regions(_silver("trips")(spark, sf).filter("region_id is not null"), 5)


@query(
    "geo_grid_of_silver",
    with_views(
        f"""select cast(k as bigint) as cell_lat, cast(m as bigint) as cell_lon, count(*) as trips
        from ({_STORED_TRIPS}) where event_id % 2 = 0 group by 1, 2""",
        "read",
    ),
)
def geo_grid_of_silver(spark, sf):
    """Stored trips per grid cell of their origin."""
    trips = _silver("trips")(spark, sf).filter("origin_lat is not null")
    return marts.geo_grid(trips, "origin_lat", "origin_lon")


query(
    "silver_gps",
    with_views(
        """select text_ts as event_ts,
        case when k <> 7 then cast(user_id as varchar) end as vehicle_id,
        case when event_id % 2 = 0 then event_type end as vehicle_type,
        cast(null as varchar) as line,
        case when event_id % 2 = 0 then r_name end as state,
        case when event_id % 2 = 0 then n_name end as city,
        case when event_id % 2 = 0 then 'b' || (k % 4) end as neighbourhood,
        cast(null as double) as latitude,
        cast(null as double) as longitude, value as speed_kmh,
        cast(null as integer) as heading_deg,
        case when event_id % 2 = 0 then k end as precision_m,
        case when event_id % 2 = 1 then 'simulado' end as source,
        cast(null as varchar) as signal_status, event_type as weather_condition,
        case when event_id % 2 = 0 then value end as weather_temperature_c,
        case when event_id % 2 = 0 then cast(k as double) end as weather_rain_mm_h,
        cast(null as bigint) as weather_visibility_m,
        cast(text_ts as date) as event_date, cast(hour(text_ts) as integer) as event_hour
        from read where k <> 99 and text_ts is not null and (k <> 7 or event_id % 2 = 0)""",
        "read",
    ),
)(_silver("gps"))

query(
    "silver_weather",
    with_views(
        """select text_ts as event_ts, r_name as state, n_name as city,
        cast(null as double) as latitude, cast(null as double) as longitude,
        'simulado' as source, event_type as condition,
        case when event_id % 2 = 1 then value end as temperature,
        cast(null as double) as humidity,
        case when event_id % 2 = 1 then cast(k as double) end as rain,
        cast(text_ts as date) as event_date, cast(hour(text_ts) as integer) as event_hour
        from read where k <> 99 and text_ts is not null and k <> 7""",
        "read",
    ),
)(_silver("weather"))

query(
    "silver_traffic",
    with_views(
        """select cast(event_id as varchar) as event_id, 'trafego' as type,
        cast(null as varchar) as provider, n_name as city, 'r' || (k % 5) as region_id,
        'zone ' || (k % 5) as label, cast(null as double) as point_lat,
        cast(null as double) as point_lon, ts_text as event_ts_text, text_ts as event_ts,
        cast(null as timestamp) as collected_ts, event_type as status,
        cast(null as varchar) as error_message,
        case when k % 10 <> 0 then value end as congestion_ratio, 'traffic' as topic,
        cast(event_id % 8 as integer) as "partition", event_id as "offset", ts as broker_ts,
        cast(text_ts as date) as event_date, cast(hour(text_ts) as integer) as event_hour
        from read where k <> 99 and k <> 7 and text_ts is not null""",
        "read",
    ),
)(_silver("traffic"))

query(
    "silver_incidents",
    with_views(
        """select cast(event_id // 2 as varchar) as incident_id, text_ts as event_ts,
        event_type as type, case when event_id % 2 = 0 then 'alta' else 'baixa' end as severity,
        case when event_id % 2 = 0 then r_name end as state,
        case when event_id % 2 = 0 then n_name end as city,
        case when event_id % 2 = 0 then 'b' || (k % 4) end as neighbourhood,
        cast(null as double) as latitude,
        cast(null as double) as longitude,
        case when event_id % 2 = 0 then k > 50 end as lane_closed,
        case when event_id % 2 = 0 then 'i' || (k % 2) end as impact,
        cast(null as varchar) as source,
        cast(text_ts as date) as event_date, cast(hour(text_ts) as integer) as event_hour
        from read where k <> 99 and text_ts is not null
        qualify row_number() over (partition by event_id // 2, text_ts
            order by type, severity, state nulls first, city nulls first,
            neighbourhood nulls first, lane_closed nulls first, impact nulls first) = 1""",
        "read",
    ),
)(_silver("incidents"))
