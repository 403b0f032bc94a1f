"""The driver's tables seen as mobility data, in Spark and as SQL text.

Both sides are written independently; `k` is `$.k` of `props`, `m` is `event_id % 25`.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mobility_lake.functions.values import json_pick
from mobility_lake.operators.conform import with_event_calendar
from mobility_lake.operators.rollup import rollup
from mobility_lake.plans import gold
from mobility_lake.session import shared_dir


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def events(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "events")
        .withColumn("ts", F.col("ts").cast("timestamp"))
        .withColumn("k", json_pick(F.col("props"), "$.k", "int"))
        .withColumn("m", (F.col("event_id") % 25).cast("int"))
    )


def places(spark: SparkSession, sf: str) -> DataFrame:
    """City and state per `m`; Spark broadcasts it while it is small."""
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("m"), F.col("n_name").alias("city"), F.col("r_name").alias("state")
    )


def _numbered(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def trips(spark: SparkSession, sf: str) -> DataFrame:
    ev = events(spark, sf)
    k = F.col("k")
    rows = ev.select(
        F.expr("event_id div 2").alias("trip_id"),
        F.col("user_id").alias("passenger_id"),
        k.alias("driver_id"),
        F.when(k >= 5, F.col("value")).alias("price"),
        F.col("event_type").alias("status"),
        _numbered("src", F.col("event_id") % 3).alias("source"),
        _numbered("r", k % 5).alias("region_id"),
        ((k + 0.5) / 100).alias("lat"),
        ((F.col("m") + 0.5) / 100).alias("lon"),
        F.col("ts").alias("event_ts"),
    )
    return with_event_calendar(
        rows, ("event_date", "event_hour", "year", "month", "day", "hour")
    )


def gps(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("k")
    rows = events(spark, sf).join(places(spark, sf), "m").select(
        F.when(k != 7, F.col("user_id")).alias("vehicle_id"),
        F.col("event_type").alias("vehicle_type"),
        "city",
        "state",
        _numbered("b", k % 4).alias("neighbourhood"),
        F.col("value").alias("speed_kmh"),
        k.alias("precision_m"),
        F.col("ts").alias("event_ts"),
    )
    return with_event_calendar(rows)


def weather(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("k")
    rows = events(spark, sf).join(places(spark, sf), "m").select(
        "city",
        "state",
        F.col("event_type").alias("condition"),
        F.col("value").alias("temperature"),
        F.when(k >= 5, k.cast("double")).alias("humidity"),
        k.cast("double").alias("rain"),
        _numbered("src", F.col("event_id") % 3).alias("source"),
        F.col("ts").alias("event_ts"),
    )
    return with_event_calendar(rows)


def traffic(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("k")
    rows = events(spark, sf).join(places(spark, sf), "m").select(
        "event_id",
        "city",
        _numbered("r", k % 5).alias("region_id"),
        _numbered("zone ", k % 5).alias("label"),
        F.col("event_type").alias("status"),
        F.when(k >= 10, F.col("value")).alias("congestion_ratio"),
        F.col("value").alias("current_time"),
        k.alias("free_time"),
        F.col("ts").alias("event_ts"),
    )
    return with_event_calendar(rows)


def incidents(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("k")
    rows = events(spark, sf).join(places(spark, sf), "m").select(
        F.expr("event_id div 2").alias("incident_id"),
        F.when(k == 1, F.lit("  "))
        .when(k == 2, F.lit("Null"))
        .when(k != 3, F.concat(F.lit("  "), F.col("city"), F.lit(" ")))
        .alias("city"),
        "state",
        F.when(k >= 20, F.col("event_type")).alias("type"),
        F.when(k % 3 == 0, "baixa").when(k % 3 == 1, "media").otherwise("alta").alias("severity"),
        _numbered("b", k % 4).alias("neighbourhood"),
        _numbered("i", k % 2).alias("impact"),
        (k > 50).alias("lane_closed"),
        F.col("ts").alias("event_ts"),
    )
    return with_event_calendar(rows)


# --- payloads and broker records ----------------------------------------------------------


def event_text() -> Column:
    """Event time as text, in one of five spellings by `event_id % 5`; the last is junk."""
    ts, form = F.col("ts"), F.col("event_id") % 5
    local = ts - F.expr("interval 3 hours")
    return (
        F.when(form == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(form == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS"))
        .when(form == 2, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .when(form == 3, F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-03:00")))
        .otherwise("junk")
    )


def _record(df: DataFrame, payload: Column, topic: str) -> DataFrame:
    return df.select(
        F.col("event_id").cast("string").cast("binary").alias("key"),
        payload.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        (F.col("event_id") % 8).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
    )


def _broken(payload: Column) -> Column:
    """Cut the JSON text open where k = 99."""
    return F.when(F.col("k") == 99, F.lit('{"broken')).otherwise(payload)


def _text_id(number: Column) -> Column:
    return number.cast("string")


def trip_records(spark: SparkSession, sf: str) -> DataFrame:
    ev = events(spark, sf)
    trip, passenger = _text_id(F.expr("event_id div 2")), _text_id(F.col("user_id"))
    driver = _text_id(F.col("k"))
    price = F.when(F.col("k") >= 5, F.col("value"))
    status, time = F.col("event_type").alias("status"), event_text().alias("ts_evento")
    first = F.to_json(
        F.struct(
            time, trip.alias("id_viagem"), passenger.alias("id_passageiro"),
            driver.alias("id_motorista"), price.alias("preco"), status,
            _numbered("src", F.col("event_id") % 3).alias("fonte"),
            ((F.col("k") + 0.5) / 100).alias("origem_lat"),
            ((F.col("m") + 0.5) / 100).alias("origem_lon"),
            F.lit(-23.5).alias("destino_lat"), F.lit("x").alias("destino_lon"),
        )
    )
    second = F.to_json(
        F.struct(
            time, trip.alias("viagem_id"), passenger.alias("passageiro_id"),
            driver.alias("motorista_id"), price.alias("preco_estimado"), status,
        )
    )
    payload = F.when(F.col("event_id") % 2 == 0, first).otherwise(second)
    return _record(ev, _broken(payload), "trips")


def gps_records(spark: SparkSession, sf: str) -> DataFrame:
    ev = events(spark, sf).join(places(spark, sf), "m")
    vehicle = _text_id(F.when(F.col("k") != 7, F.col("user_id")))
    weather_object = F.struct(
        F.col("event_type").alias("condicao"),
        F.col("value").alias("temperatura_c"),
        F.col("k").cast("double").alias("chuva_mm_h"),
    )
    first = F.to_json(
        F.struct(
            event_text().alias("ts_evento"), vehicle.alias("veiculo_id"),
            F.col("event_type").alias("tipo_veiculo"),
            F.col("state").alias("estado"), F.col("city").alias("cidade"),
            _numbered("b", F.col("k") % 4).alias("bairro"),
            F.col("value").alias("velocidade_kmh"), F.col("k").alias("precisao_m"),
            weather_object.alias("clima"),
        )
    )
    second = F.to_json(
        F.struct(
            event_text().alias("ts_evento"), vehicle.alias("id_motorista"),
            F.col("value").alias("velocidade"), F.lit("simulado").alias("fonte"),
            F.col("event_type").alias("clima"),
        )
    )
    payload = F.when(F.col("event_id") % 2 == 0, first).otherwise(second)
    return _record(ev, _broken(payload), "gps")


def incident_records(spark: SparkSession, sf: str) -> DataFrame:
    ev = events(spark, sf).join(places(spark, sf), "m")
    incident = _text_id(F.expr("event_id div 2"))
    first = F.to_json(
        F.struct(
            event_text().alias("ts_evento"), incident.alias("incidente_id"),
            F.col("event_type").alias("tipo_incidente"), F.lit("alta").alias("severidade"),
            F.col("state").alias("estado"), F.col("city").alias("cidade"),
            _numbered("b", F.col("k") % 4).alias("bairro"),
            _numbered("i", F.col("k") % 2).alias("impacto"),
            (F.col("k") > 50).alias("faixa_interditada"),
        )
    )
    second = F.to_json(
        F.struct(
            event_text().alias("ts_evento"), incident.alias("id_incidente"),
            F.col("event_type").alias("tipo"), F.lit("baixa").alias("gravidade"),
        )
    )
    payload = F.when(F.col("event_id") % 2 == 0, first).otherwise(second)
    return _record(ev, _broken(payload), "incidents")


def weather_payload() -> Column:
    """Weather as a word for even ids, as an object for odd ones."""
    head = [
        event_text().alias("ts_evento"),
        F.when(F.col("k") != 7, F.col("state")).alias("estado"),
        F.col("city").alias("cidade"),
        F.lit("simulado").alias("fonte"),
    ]
    word = F.to_json(F.struct(*head, F.col("event_type").alias("clima")))
    inner = F.struct(
        F.col("event_type").alias("condicao"),
        F.col("value").alias("temperatura_c"),
        F.col("k").cast("double").alias("chuva_mm_h"),
    )
    full = F.to_json(F.struct(*head, inner.alias("clima")))
    return F.when(F.col("event_id") % 2 == 0, word).otherwise(full)


def weather_records(spark: SparkSession, sf: str) -> DataFrame:
    ev = events(spark, sf).join(places(spark, sf), "m")
    return _record(ev, _broken(weather_payload()), "weather")


def traffic_records(spark: SparkSession, sf: str) -> DataFrame:
    """Every observation, and those with k < 20 sent again under a later offset."""
    ev = events(spark, sf).join(places(spark, sf), "m")
    payload = F.to_json(
        F.struct(
            F.col("event_id").cast("string").alias("event_id"),
            F.lit("trafego").alias("tipo"),
            F.when(F.col("k") != 7, F.col("city")).alias("city"),
            _numbered("r", F.col("k") % 5).alias("region_id"),
            _numbered("zone ", F.col("k") % 5).alias("label"),
            event_text().alias("ts_evento"),
            F.col("event_type").alias("status"),
            F.when(F.col("k") % 10 == 0, F.lit("n/a"))
            .otherwise(F.col("value").cast("string"))
            .alias("congestion_ratio"),
        )
    )
    once = _record(ev, _broken(payload), "traffic")
    again = _record(ev.filter("k < 20"), _broken(payload), "traffic")
    return once.unionAll(again.withColumn("offset", F.col("offset") + 1_000_000_000))


RECORDS = {
    "trips": trip_records,
    "gps": gps_records,
    "incidents": incident_records,
    "weather": weather_records,
    "traffic": traffic_records,
}


def duplicated(spark: SparkSession, sf: str) -> DataFrame:
    """Every event, and those with k < 20 a second time, ingested a minute later."""
    ev = events(spark, sf)
    columns = [
        F.expr("event_id div 2").alias("trip_id"),
        "event_id",
        F.col("ts").alias("event_ts"),
    ]
    once = ev.select(
        *columns, F.col("ts").alias("ingest_ts"), F.col("event_id").alias("offset"), "value"
    )
    again = ev.filter("k < 20").select(
        *columns,
        (F.col("ts") + F.expr("interval 1 minute")).alias("ingest_ts"),
        (F.col("event_id") + 1).alias("offset"),
        (F.col("value") + 1).alias("value"),
    )
    return once.unionAll(again)


def region_source(spark: SparkSession, sf: str) -> DataFrame:
    """Regions as they would be listed by hand; every fourth lacks its label."""
    key = F.col("m")
    return places(spark, sf).select(
        "city",
        _numbered("r", key).alias("region_id"),
        F.when(key % 4 != 3, F.concat(F.col("city"), F.lit(" centre"))).alias("label"),
        (key / 10).alias("lat"),
        (key / 5).alias("lon"),
    )


# --- rollups used as input -----------------------------------------------------------------


def gold_trips(spark: SparkSession, sf: str) -> DataFrame:
    return rollup(trips(spark, sf), gold.TRIPS_HOURLY)


def gold_gps(spark: SparkSession, sf: str) -> DataFrame:
    return rollup(gps(spark, sf), gold.GPS_HOURLY)


def gold_weather(spark: SparkSession, sf: str) -> DataFrame:
    return rollup(weather(spark, sf), gold.WEATHER_HOURLY)


def gold_traffic(spark: SparkSession, sf: str) -> DataFrame:
    return rollup(traffic(spark, sf), gold.TRAFFIC_HOURLY)


def gold_incidents(spark: SparkSession, sf: str) -> DataFrame:
    return rollup(gold.clean_incidents(incidents(spark, sf)), gold.INCIDENTS_HOURLY)


# --- a table as a stream of files ------------------------------------------------------------


@dataclass(frozen=True)
class FileStream:
    """A written table and how many of its files make up a sixth of it."""

    path: str
    max_files: int


def as_files(
    spark: SparkSession, df: DataFrame, order: str, partition_by: tuple[str, ...] = ()
) -> FileStream:
    """Write `df` to files by ranges of `order`, to be streamed in about six micro-batches."""
    path = shared_dir(spark, "files")
    slices = max(6, int(spark.conf.get("spark.sql.shuffle.partitions")))
    writer = df.repartitionByRange(slices, order).write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    files = spark.read.parquet(path).select(F.col("_metadata.file_path")).distinct().count()
    return FileStream(path, math.ceil(files / 6))


def as_ordered_files(
    spark: SparkSession, df: DataFrame, order: str, partition_by: tuple[str, ...] = (), steps: int = 6
) -> FileStream:
    """The same, written one range after the other, so that the stream meets them in that order.

    Every row is given its range in one pass and staged in a folder split by range; each range is then
    written from its own part, so `df` is read twice in all, not once for every range.
    """
    path, staged, files = shared_dir(spark, "files"), shared_dir(spark, "ranges"), 4
    numbered = df.withColumn("_at", F.unix_micros(F.col(order).cast("timestamp")))
    bounds = numbered.approxQuantile("_at", [i / steps for i in range(1, steps)], 0.001)
    step = sum(((F.col("_at") >= int(high)).cast("int") for high in bounds), F.lit(0))  # null time: no range
    numbered.withColumn("_step", step).drop("_at").write.partitionBy("_step").parquet(staged)
    schema = T.StructType([*df.schema.fields, T.StructField("_step", T.IntegerType())])
    for i in range(len(bounds) + 1):
        part = spark.read.schema(schema).parquet(staged).filter(F.col("_step") == i)
        writer = part.drop("_step").repartition(files).write.mode("append")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
    return FileStream(path, files)


# --- the same views as SQL -------------------------------------------------------------------


def total(column: str, digits: int = 2) -> str:
    return f"cast(sum(cast({column} as decimal(18,{digits}))) as double)"


def mean(column: str, digits: int = 2) -> str:
    return f"{total(column, digits)} / nullif(count({column}), 0)"


_CALENDAR = "cast(ts as date) as event_date, cast(hour(ts) as integer) as event_hour"
_PLACES = "join nation on m = n_nationkey join region on n_regionkey = r_regionkey"

CTES = {
    "ev": """select event_id, ts, user_id, event_type, value, props,
        cast(json_extract_string(props, '$.k') as integer) as k,
        cast(event_id % 25 as integer) as m from events""",
    "trips": f"""select event_id // 2 as trip_id, user_id as passenger_id, k as driver_id,
        case when k >= 5 then value end as price, event_type as status,
        'src' || (event_id % 3) as source, 'r' || (k % 5) as region_id,
        (k + 0.5::double) / 100 as lat, (m + 0.5::double) / 100 as lon,
        ts as event_ts, {_CALENDAR}, cast(year(ts) as integer) as year,
        cast(month(ts) as integer) as month, cast(day(ts) as integer) as day,
        cast(hour(ts) as integer) as hour from ev""",
    "gps": f"""select case when k <> 7 then user_id end as vehicle_id,
        event_type as vehicle_type, n_name as city, r_name as state,
        'b' || (k % 4) as neighbourhood, value as speed_kmh, k as precision_m,
        ts as event_ts, {_CALENDAR} from ev {_PLACES}""",
    "weather": f"""select n_name as city, r_name as state, event_type as condition,
        value as temperature, case when k >= 5 then cast(k as double) end as humidity,
        cast(k as double) as rain, 'src' || (event_id % 3) as source,
        ts as event_ts, {_CALENDAR} from ev {_PLACES}""",
    "traffic": f"""select event_id, n_name as city, 'r' || (k % 5) as region_id,
        'zone ' || (k % 5) as label, event_type as status,
        case when k >= 10 then value end as congestion_ratio, value as current_time_s,
        k as free_time_s, ts as event_ts, {_CALENDAR} from ev {_PLACES}""",
    "incidents": f"""select event_id // 2 as incident_id,
        case k when 1 then '  ' when 2 then 'Null' when 3 then null
            else '  ' || n_name || ' ' end as city,
        r_name as state, case when k >= 20 then event_type end as type,
        case k % 3 when 0 then 'baixa' when 1 then 'media' else 'alta' end as severity,
        'b' || (k % 4) as neighbourhood, 'i' || (k % 2) as impact, k > 50 as lane_closed,
        ts as event_ts, {_CALENDAR} from ev {_PLACES}""",
    "read": f"""select *, case when event_id % 5 in (0, 2, 3) then date_trunc('second', ts)
        when event_id % 5 = 1 then date_trunc('milliseconds', ts) end as text_ts,
        case event_id % 5 when 0 then strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
            when 1 then strftime(ts, '%Y-%m-%dT%H:%M:%S.%g')
            when 2 then strftime(ts, '%Y-%m-%d %H:%M:%S')
            when 3 then strftime(ts - interval 3 hour, '%Y-%m-%dT%H:%M:%S') || '-03:00'
            else 'junk' end as ts_text from ev {_PLACES}""",
    "duplicated": """select event_id // 2 as trip_id, event_id, ts as event_ts,
        ts as ingest_ts, event_id as "offset", value from ev
        union all select event_id // 2, event_id, ts, ts + interval 1 minute,
        event_id + 1, value + 1 from ev where k < 20""",
    "regions": """select n_name as city, 'r' || n_nationkey as region_id,
        case when n_nationkey % 4 <> 3 then n_name || ' centre' end as label,
        n_nationkey / 10 as lat, n_nationkey / 5 as lon
        from nation join region on n_regionkey = r_regionkey""",
    "gold_trips": f"""select event_date, event_hour, status, source, count(*) as records,
        count(distinct trip_id) as distinct_trips,
        count(distinct passenger_id) as distinct_passengers,
        count(distinct driver_id) as distinct_drivers,
        {mean('price')} as mean_price, {total('price')} as total_price
        from trips group by event_date, event_hour, status, source""",
    "gold_gps": f"""select city, event_date, event_hour, count(*) as signals,
        count(distinct vehicle_id) as distinct_vehicles, {mean('speed_kmh')} as mean_speed,
        min(speed_kmh) as min_speed, max(speed_kmh) as max_speed
        from gps where vehicle_id is not null group by city, event_date, event_hour""",
    "gold_weather": f"""select city, condition, event_date, event_hour,
        count(*) as observations, {mean('temperature')} as mean_temperature,
        max(temperature) as max_temperature, min(temperature) as min_temperature,
        {mean('humidity')} as mean_humidity, {total('rain')} as total_rain
        from weather group by city, condition, event_date, event_hour""",
    "gold_traffic": f"""select city, region_id, label, event_date, event_hour,
        count(*) as observations, count(congestion_ratio) as observations_with_ratio,
        {mean('congestion_ratio')} as mean_ratio, max(congestion_ratio) as max_ratio,
        min(congestion_ratio) as min_ratio,
        count(*) filter (where status = 'error') as errors
        from traffic group by city, region_id, label, event_date, event_hour""",
    "gold_incidents": """select trim(city) as city, coalesce(type, 'nao_informado') as type,
        severity, event_date, event_hour, count(*) as incidents,
        count(distinct incident_id) as distinct_incidents from incidents
        where trim(city) <> '' and upper(trim(city)) <> 'NULL'
        group by 1, 2, 3, 4, 5""",
    "staged_trips": """select * replace (coalesce(mean_price, 0) as mean_price,
        coalesce(total_price, 0) as total_price) from gold_trips""",
    "staged_traffic": """select city, region_id, label, event_date, event_hour,
        mean_ratio as congestion_level, mean_speed from gold_traffic
        left join gold_gps using (city, event_date, event_hour)""",
    "mobility_daily": f"""select cast(year(event_date) as integer) as year,
        cast(month(event_date) as integer) as month, cast(day(event_date) as integer) as day,
        event_date as date,
        cast(sum(records) as bigint) as total_records,
        cast(sum(distinct_trips) as bigint) as total_trips,
        cast(sum(distinct_passengers) as bigint) as total_passengers,
        cast(sum(distinct_drivers) as bigint) as total_drivers,
        {total('total_price')} as total_revenue, {mean('mean_price', 6)} as mean_price
        from staged_trips group by event_date""",
    "weather_daily": f"""select event_date as date,
        {mean('mean_temperature', 6)} as mean_temperature, {total('total_rain')} as total_rain
        from gold_weather group by event_date""",
    "speed_daily": f"""select event_date as date, {mean('mean_speed', 6)} as mean_speed
        from gold_gps group by event_date""",
    "jam_daily": f"""select event_date as date, {mean('mean_ratio', 6)} as mean_congestion
        from gold_traffic group by event_date""",
    "mart": """select date, total_trips, total_records, total_passengers, total_drivers,
        total_revenue as revenue, total_revenue / nullif(total_trips, 0) as mean_ticket,
        mean_temperature, mean_speed, mean_congestion,
        case when w.date is null then 'unknown' when total_rain > 0 then 'rain'
            else 'dry' end as weather_status,
        case when mean_congestion is null then 'unknown' when mean_congestion < 1.2 then 'free'
            when mean_congestion < 1.5 then 'moderate' else 'heavy' end as traffic_status
        from mobility_daily t left join weather_daily w using (date)
        left join speed_daily using (date) left join jam_daily using (date)""",
}

_NEEDS = {
    "ev": (),
    "regions": (),
    "gold_trips": ("trips",),
    "gold_gps": ("gps",),
    "gold_weather": ("weather",),
    "gold_traffic": ("traffic",),
    "gold_incidents": ("incidents",),
    "staged_trips": ("gold_trips",),
    "staged_traffic": ("gold_traffic", "gold_gps"),
    "mobility_daily": ("staged_trips",),
    "weather_daily": ("gold_weather",),
    "speed_daily": ("gold_gps",),
    "jam_daily": ("gold_traffic",),
    "mart": ("mobility_daily", "weather_daily", "speed_daily", "jam_daily"),
}


def with_views(body: str, *views: str) -> str:
    """`body` behind the CTEs it needs, in order."""
    ordered: list[str] = []

    def add(name: str) -> None:
        if name not in ordered:
            for needed in _NEEDS.get(name, ("ev",)):
                add(needed)
            ordered.append(name)

    for view in views:
        add(view)
    ctes = ", ".join(f"{name} as ({CTES[name]})" for name in ordered)
    return f"with {ctes} {body}"


