"""DuckDB SQL for the registered queries, over the same tables.

Written from the rules, not from the Spark plans: polygons are tested edge by
edge, labels by CASE, incremental results by set operations.
"""

from __future__ import annotations

from .. import adapter
from ..operators.quality import Rules
from ..plans.declared_checks import DECLARED, GATES
from .queries import BASE_UNTIL, CHANGES_FROM, ROLLING_AS_OF, STREAM_START

_RAW = "raw as (select " + ", ".join(f"{sql} as {name}" for name, sql in adapter.DETECTION_SQL.items()) + " from events)"

_SHAPES = """
cells as (select n_nationkey as regency_id, 95e0+9*(n_nationkey%5) as x0, -10e0+3*floor(n_nationkey/5) as y0
  from nation),
corner(k, fx, fy) as (values (0,0.25e0,0e0),(1,0.75e0,0e0),(2,1e0,0.25e0),(3,1e0,0.75e0),
  (4,0.75e0,1e0),(5,0.25e0,1e0),(6,0e0,0.75e0),(7,0e0,0.25e0)),
vx as (select regency_id, k, x0+9*fx as x, y0+3*fy as y from cells, corner),
side as (select a.regency_id, a.k, a.x as xa, a.y as ya, b.x as xb, b.y as yb,
    a.y<b.y or (a.y=b.y and a.x<=b.x) as up
  from vx a join vx b on a.regency_id=b.regency_id and b.k=(a.k+1)%8),
edges as (select regency_id, if(up,xa,xb) as x1, if(up,ya,yb) as y1, if(up,xb,xa) as x2, if(up,yb,ya) as y2 from side)"""


def _hit(points: str, key: str, name: str = "hit") -> str:
    """Point-polygon pairs: odd crossings of the eastward ray, or on an edge."""
    return f"""
{name} as (select p.{key}, e.regency_id from {points} p join edges e on p.latitude between e.y1 and e.y2
  group by p.{key}, e.regency_id
  having sum(case when e.y1<=p.latitude and p.latitude<e.y2
                   and p.longitude < (e.x2-e.x1)*(p.latitude-e.y1)/(e.y2-e.y1)+e.x1 then 1 else 0 end)%2=1
      or bool_or((e.x2-e.x1)*(p.latitude-e.y1)=(e.y2-e.y1)*(p.longitude-e.x1)
                 and p.longitude between least(e.x1,e.x2) and greatest(e.x1,e.x2)))"""


_LOCATED = f"""{_RAW}, {_SHAPES}, {_hit('raw', 'event_id')},
loc as (select r.*, h.regency_id from raw r left join (
  select event_id, min(case when regency_id%7<>6 then regency_id end) as regency_id from hit group by event_id) h
  using (event_id))"""

_ID = (
    "md5(cast(latitude as varchar)||'|'||cast(longitude as varchar)||'|'||cast(acq_date as varchar)||'|'"
    "||cast(acq_time as varchar)||'|'||coalesce(satellite,'')||'|'||coalesce(instrument,''))"
)
_CLOCK = "left(lpad(cast(acq_time as varchar),4,'0'),2)||':'||right(lpad(cast(acq_time as varchar),4,'0'),2)||':00'"


def _num(column: str) -> str:
    return f"coalesce(cast(cast({column} as decimal(38,9)) as double), -999)"


def _text(column: str) -> str:
    return f"coalesce(cast({column} as varchar), 'UNKNOWN')"


_STAGED = f"""{_LOCATED},
stg as (select {_ID} as detection_id, {_num('latitude')} as latitude, {_num('longitude')} as longitude,
  {_num('brightness')} as brightness, {_num('scan')} as scan, {_num('track')} as track,
  cast(acq_date as varchar) as acquisition_date, {_CLOCK} as acquisition_time,
  {_text('satellite')} as satellite, {_text('instrument')} as instrument, {_text('confidence')} as confidence,
  {_text('version')} as version, {_num('bright_t31')} as brightness_temperature_t31,
  {_num('frp')} as fire_radiative_power, {_text('daynight')} as daynight,
  cast(coalesce(type,-999) as bigint) as detection_type, cast(coalesce(regency_id,-999) as bigint) as regency_id,
  'batch' as ingestion_source from loc)"""

_LABELS = """case lower(confidence) when 'h' then 'HIGH' when 'n' then 'NOMINAL' when 'l' then 'LOW' else 'UNKNOWN' end
    as confidence_level_label,
  case upper(daynight) when 'D' then 'DAY' when 'N' then 'NIGHT' else 'UNKNOWN' end as detection_period,
  case upper(satellite) when 'SNPP' then 'SUOMI NPP' when 'N20' then 'NOAA-20' when 'N21' then 'NOAA-21'
    else 'UNKNOWN' end as satellite_label"""

_BUSINESS = f"""{_LABELS},
  case detection_type when 0 then 'VEGETATION_FIRE' when 1 then 'ACTIVE_VOLCANO' when 2 then 'STATIC_LAND_SOURCE'
    when 3 then 'OFFSHORE' else 'UNKNOWN' end as detection_type_label,
  nullif(regexp_extract(version, '^[0-9]+(\\.[0-9]+)?'), '') as collection_version,
  case when ends_with(upper(version),'NRT') then 'NEAR_REAL_TIME' when ends_with(upper(version),'URT')
    then 'ULTRA_REAL_TIME' when ends_with(upper(version),'RT') then 'REAL_TIME'
    when regexp_full_match(version, '[0-9]+(\\.[0-9]+)?') then 'STANDARD' else 'UNKNOWN' end as processing_type"""

_TIMES = """acquisition_date||' '||acquisition_time as detection_datetime,
  acquisition_date||' '||acquisition_time as detection_timestamp,
  year(cast(acquisition_date as date)) as detection_year, month(cast(acquisition_date as date)) as detection_month,
  dayofweek(cast(acquisition_date as date))+1 as detection_day_of_week,
  cast(left(acquisition_time,2) as bigint) as detection_hour,
  upper(monthname(cast(acquisition_date as date))) as detection_month_name,
  upper(dayname(cast(acquisition_date as date))) as detection_day_name"""

_DESCRIBED = f"""{_STAGED},
det as (select *, {_TIMES}, {_BUSINESS} from stg where regency_id<>-999)"""


def _key(*columns: str) -> str:
    parts = ", ".join(f"coalesce(cast({c} as varchar), '_dbt_utils_surrogate_key_null_')" for c in columns)
    return f"md5(concat_ws('-', {parts}))"


_SAT = _key("satellite", "instrument")
_CLASS = _key("confidence_level_label", "daynight", "detection_period", "detection_type", "detection_type_label")
_PROC = _key("version", "collection_version", "processing_type")

_STAR = f"""{_DESCRIBED},
fct as (select detection_id, ingestion_source, regency_id, {_SAT} as satellite_id, {_CLASS} as classification_id,
  {_PROC} as processing_id, brightness, scan, track, confidence, brightness_temperature_t31, fire_radiative_power,
  acquisition_date, acquisition_time, detection_datetime, detection_timestamp from det),
cls as (select distinct {_CLASS} as classification_id, confidence_level_label, daynight, detection_period,
  detection_type, detection_type_label from det),
sat as (select distinct {_SAT} as satellite_id, satellite, satellite_label, instrument from det),
prc as (select distinct {_PROC} as processing_id, version, collection_version, processing_type from det),
reg as (select cast(n_nationkey as bigint) as regency_id, cast(n_regionkey as bigint) as province_id,
  case when n_nationkey%2=1 then 'KABUPATEN ' else 'KOTA ' end||n_name as regency_name from nation),
place as (select regency_id, regency_name, province_id, r_name as province_name
  from reg left join region on r_regionkey=province_id)"""


def _mart(where: str = "true") -> str:
    return f"""{_STAR},
mart as (select f.acquisition_date, p.province_name, p.regency_name,
  case c.confidence_level_label when 'HIGH' then 'High' when 'NOMINAL' then 'Nominal' when 'LOW' then 'Low'
    else 'Unknown' end as confidence_level,
  case c.daynight when 'D' then 'Day' when 'N' then 'Night' else 'Unknown' end as day_night,
  case c.detection_type_label when 'VEGETATION_FIRE' then 'Vegetation Fire' when 'ACTIVE_VOLCANO'
    then 'Active Volcano' when 'STATIC_LAND_SOURCE' then 'Static Land Source' when 'OFFSHORE' then 'Offshore'
    else 'Unknown' end as detection_type_label,
  f.ingestion_source, count(*) as detection_count,
  sum(cast(f.fire_radiative_power as decimal(38,9))) as sum_frp, max(f.fire_radiative_power) as max_frp,
  sum(cast(f.brightness as decimal(38,9))) as sum_brightness, max(f.brightness) as max_brightness
  from fct f left join cls c using (classification_id) left join place p on p.regency_id=f.regency_id
  where {where} group by 1,2,3,4,5,6,7)"""


_MART_ROWS = """select * exclude (sum_frp, sum_brightness), round(cast(sum_frp as double),4) as total_frp,
  round(cast(sum_brightness as double),4) as total_brightness from mart"""

# --- streams ----------------------------------------------------------------

_EVENTS = f"""
ev as (select {_ID} as event_id, 'NASA_FIRMS' as source, 'fire_detection_nrt' as source_table,
  '1.0' as schema_version, latitude, longitude, brightness, scan, track, cast(acq_date as varchar) as acq_date,
  acq_time, satellite, instrument, confidence, version, bright_t31, frp, daynight from raw)"""

_STREAM = f"""{_RAW}, {_EVENTS},
cp as (select ev.* replace (frp+copy as frp), copy from (select *, unnest(range(0, acq_time%3+1)) as copy from ev) ev),
srow as (select event_id, source, source_table, schema_version, '{STREAM_START}' as published_timestamp,
  '2024-02-01 0'||copy||':00:00' as ingested_timestamp, latitude, longitude, brightness, scan, track,
  acq_date as acquisition_date, {_CLOCK} as acquisition_time, satellite, instrument, confidence, version,
  bright_t31 as brightness_temperature_t31, frp as fire_radiative_power, daynight,
  acq_date||' '||{_CLOCK} as detection_datetime, acq_date||' '||{_CLOCK} as detection_timestamp,
  year(cast(acq_date as date)) as detection_year, month(cast(acq_date as date)) as detection_month,
  dayofweek(cast(acq_date as date))+1 as detection_day_of_week, acq_time//100 as detection_hour, {_LABELS},
  nullif(regexp_extract(upper(version), '^([0-9]+(\\.[0-9]+)?)(NRT|URT|RT)?$', 1), '') as collection_version,
  case regexp_extract(upper(version), '^[0-9]+(\\.[0-9]+)?(NRT|URT|RT)$', 2) when 'NRT' then 'NEAR_REAL_TIME'
    when 'URT' then 'ULTRA_REAL_TIME' when 'RT' then 'REAL_TIME'
    else case when regexp_full_match(version, '[0-9]+(\\.[0-9]+)?') then 'STANDARD' else 'UNKNOWN' end
  end as processing_type from cp)"""

# Copies of an event lie at the same point, so one location per event serves.
_ENRICHED = f"""{_STREAM}, {_SHAPES}, spot as (select distinct event_id, latitude, longitude from srow),
{_hit('spot', 'event_id', 'shit')},
enr as (select s.*, cast(h.regency_id as bigint) as regency_id from srow s left join (
  select event_id, min(case when regency_id%7<>6 then regency_id end) as regency_id from shit group by event_id) h
  using (event_id))"""


def _staged_stream(source: str) -> str:
    return f"""select event_id as detection_id, {_num('latitude')} as latitude, {_num('longitude')} as longitude,
  {_num('brightness')} as brightness, {_num('scan')} as scan, {_num('track')} as track, acquisition_date,
  acquisition_time, {_text('satellite')} as satellite, {_text('instrument')} as instrument,
  {_text('confidence')} as confidence, {_text('version')} as version,
  {_num('brightness_temperature_t31')} as brightness_temperature_t31,
  {_num('fire_radiative_power')} as fire_radiative_power, {_text('daynight')} as daynight,
  cast(null as bigint) as detection_type, coalesce(regency_id,-999) as regency_id, 'stream' as ingestion_source
  from {source} qualify row_number() over (partition by event_id
    order by acquisition_date desc, acquisition_time desc, ingested_timestamp desc)=1"""


_BOTH = _STAGED + "".join(
    ", " + part for part in (_ENRICHED.removeprefix(_RAW + ", ").replace(_SHAPES + ", ", ""),)
)


# --- quality ------------------------------------------------------------------


def _checks(table: str, rules: Rules, parents: dict[str, str], fresh: tuple[str, str] | None = None) -> str:
    counts = {"row_count": f"(select case when count(*)=0 then 1 else 0 end from {table})"}
    for column in rules.not_null:
        counts[f"not_null:{column}"] = f"(select count(*) from {table} where {column} is null)"
    for column, values in rules.accepted.items():
        listed = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)
        counts[f"accepted:{column}"] = f"(select count(*) from {table} where {column} not in ({listed}))"
    for name, expression in rules.invalid.items():
        counts[f"invalid:{name}"] = f"(select count(*) from {table} where {expression})"
    for column in rules.unique:
        counts[f"unique:{column}"] = (
            f"(select count(*) from (select {column} from {table} where {column} is not null"
            f" group by 1 having count(*)>1))"
        )
    for column, (parent, field) in rules.relationships.items():
        counts[f"relationship:{column}"] = (
            f"(select count(*) from {table} where {column} is not null"
            f" and {column} not in (select {field} from {parents[parent]} where {field} is not null))"
        )
    if fresh:
        column, day = fresh
        counts["freshness"] = f"(select case when count(*)>0 then 0 else 1 end from {table} where {column}='{day}')"
    rows = " union all ".join(f"select '{name}' as \"check\", {sql} as n" for name, sql in counts.items())
    return f"select \"check\", n=0 as passed, cast(n as bigint) as failing_rows from ({rows})"


_PARENTS = {
    "dim_location": "place", "dim_satellite": "sat",
    "dim_detection_classification": "cls", "dim_collecting_process": "prc",
}

# --- coordinates and names ------------------------------------------------------


def _grid(places: int) -> str:
    scale = f"1e{places}"
    return ", ".join(f"round_even({c}*{scale},0)/{scale}+0e0 as {c}" for c in ("latitude", "longitude"))


_ROUNDED = f"{_RAW}, pts as (select distinct {_grid(2)} from raw)"
_KNOWN = f"""{_ROUNDED},
early as (select distinct {_grid(2)} from raw where acq_date<=date '{BASE_UNTIL}'),
fresh as (select * from pts except select * from early)"""

_NAMES = """
bnd as (select """ + adapter.BOUNDARY_NAME_SQL + """ as "WADMKK",
  cast(n_regionkey as varchar) as "WADMPR" from nation),
reg as (select cast(n_nationkey as bigint) as regency_id, cast(n_regionkey as bigint) as province_id,
  case when n_nationkey%2=1 then 'KABUPATEN ' else 'KOTA ' end||n_name as regency_name from nation)"""


def _loose(column: str) -> str:
    return f"regexp_replace(regexp_replace(upper(trim({column})), '^KABUPATEN ', ''), '^KOTA ', '')"


def _matched() -> str:
    return f"""{_NAMES}, m as (select b.*, {_loose('"WADMKK"')} as match_name, r.regency_id, r.province_id, r.regency_name
  from bnd b left join reg r on {_loose('"WADMKK"')}={_loose('r.regency_name')})"""


def _changed(table: str, day: str, select_base: str, select_new: str, replaced: str) -> str:
    """Base rows not replaced, plus the changed ones."""
    return f"""select {select_base} from {table} where {day}<='{BASE_UNTIL}' and not ({replaced})
  union all select {select_new} from {table} where {day}>='{CHANGES_FROM}'"""


def oracle_sql() -> dict[str, str]:
    with_ = "with "
    out: dict[str, str] = {}

    out["stage_batch"] = with_ + _STAGED + " select * from stg"
    out["stage_stream_dedup"] = with_ + _ENRICHED + " " + _staged_stream("enr")
    out["stage_union"] = with_ + _BOTH + " select * from stg union all " + _staged_stream("enr")
    out["stage_union_prefer_batch"] = (
        with_ + _BOTH + " select * from stg union all select * from (" + _staged_stream("enr")
        + ") where detection_id not in (select detection_id from stg)"
    )
    out["stage_province"] = "select cast(r_regionkey as bigint) as province_id, r_name as province_name from region"
    out["stage_regency"] = with_ + _NAMES + " select regency_id, province_id, regency_name from reg"

    out["event_projection"] = with_ + _RAW + ", " + _EVENTS + " select * from ev"
    out["event_projection_archive"] = out["event_projection"]
    out["stream_transform_batch"] = with_ + _STREAM + " select * from srow"
    problem = "case confidence when 'h' then 'MALFORMED_JSON' when 'l' then 'MISSING_FIELD'" \
        " else case when confidence='x' then 'INVALID_VALUE' else 'NONE' end end"
    out["decode_problems"] = with_ + _RAW + f" select {problem} as problem, count(*) as messages from raw group by 1"
    out["decode_events"] = (
        with_ + _RAW + ", " + _EVENTS
        + f" select *, '{STREAM_START.replace(' ', 'T')}.000000Z' as published_timestamp from ev where {problem}='NONE'"
    )

    out["normalize_types"] = (
        with_ + _RAW + " select * replace (cast(acq_date as varchar) as acq_date, cast(acq_time as varchar) as acq_time,"
        " cast(try_cast(version as double) as bigint) as version) from raw"
    )
    coords = (
        "t as (select event_id, case when confidence='x' then 'n/a' else cast(latitude as varchar) end as latitude,"
        " case when confidence='h' then null else cast(longitude as varchar) end as longitude from raw)"
    )
    bad = "try_cast(latitude as double) is null or try_cast(longitude as double) is null"
    out["invalid_coordinates"] = (
        with_ + _RAW + ", " + coords + f" select *, 'INVALID_COORDINATE' as reject_reason from t where {bad}"
    )
    out["valid_coordinates"] = (
        with_ + _RAW + ", " + coords + " select event_id, cast(latitude as double) as latitude,"
        f" cast(longitude as double) as longitude from t where not ({bad})"
    )
    out["csv_scan"] = with_ + _RAW + " select * exclude (event_id) replace (cast(acq_date as varchar) as acq_date) from raw"
    out["reference_load"] = out["stage_regency"]
    out["daily_split_counts"] = (
        with_ + _RAW + " select cast(year(acq_date) as bigint) as year, cast(month(acq_date) as bigint) as month,"
        " cast(acq_date as varchar) as acq_date, count(*) as rows,"
        " round(cast(sum(cast(frp as decimal(18,4))) as double), 4) as total_frp from raw group by all"
    )
    out["date_range_scan"] = (
        with_ + _RAW + " select * replace (cast(acq_date as varchar) as acq_date) from raw"
        f" where acq_date between date '{CHANGES_FROM}' and date '2024-02-15'"
    )
    out["source_discovery"] = (
        with_ + _RAW + " select cast(acq_date as varchar) as day, day(acq_date)%3<>1 as batch_exists,"
        " day(acq_date)%3<>2 as stream_exists from raw group by acq_date"
    )

    out["landing_catalogue"] = (
        with_ + _RAW + " select case when satellite='SNPP' then 'snpp' else 'others' end as \"table\","
        " cast(acq_date as varchar) as day, count(*) as rows from raw group by 1, 2"
    )
    out["discovery_report"] = (
        with_ + _RAW + ", d as (select acq_date, count(*) as n, day(acq_date)%3 as k, day(acq_date)%2=0 as stream_exists"
        " from raw group by acq_date), t as (select *, case k when 0 then 1 when 1 then 2 else 0 end as batch_tables from d)"
        " select cast(acq_date as varchar) as day, batch_tables, n*batch_tables as batch_rows, stream_exists,"
        " case when batch_tables>1 then 'AMBIGUOUS_SOURCE' when batch_tables=0 and not stream_exists then 'MISSING_SOURCE' end"
        " as error from t"
    )
    out["enrich_point_in_polygon"] = (
        with_ + _LOCATED + " select event_id, latitude, longitude, cast(regency_id as bigint) as regency_id from loc"
    )
    out["enrich_shuffled"] = out["enrich_point_in_polygon"]
    out["enrich_all_matches"] = (
        with_ + _LOCATED + " select r.event_id, cast(case when h.regency_id%7<>6 then h.regency_id end as bigint)"
        " as regency_id from raw r left join hit h using (event_id)"
    )
    # Rectangles: within the outer one, not inside the hole unless in the island; borders count as inside.
    out["enrich_overlaps"] = with_ + _RAW + """
, o as (select cast(r_regionkey as bigint) as boundary_id, r_name as province_name, 95e0+9*r_regionkey as x0 from region),
h as (select event_id, boundary_id, province_name from raw join o on longitude between x0 and x0+11 and latitude between -10 and 5
  and (not (longitude>x0+3 and longitude<x0+7 and latitude>-6 and latitude<1)
    or (longitude between x0+4 and x0+6 and latitude between -4 and -2)))
select r.event_id, boundary_id, province_name from raw r left join h using (event_id)"""
    centre = "floor(sum(cast(round({0}*1000) as bigint))/count(*))/1000e0"
    out["point_lookup"] = (
        with_ + _RAW + ", " + _SHAPES
        + f", ctr as (select acq_date, confidence, acq_date||confidence as k, {centre.format('latitude')} as latitude,"
        f" {centre.format('longitude')} as longitude from raw group by acq_date, confidence), "
        + _hit("ctr", "k", "found")
        + " select cast(acq_date as varchar) as acq_date, confidence, latitude, longitude,"
        " " + adapter.BOUNDARY_NAME_SQL + ' as "WADMKK",'
        " cast(n_regionkey as varchar) as \"WADMPR\" from ctr join found using (k) join nation on n_nationkey=regency_id"
    )
    out["geojson_boundaries"] = (
        with_ + _SHAPES + f""" select {adapter.BOUNDARY_NAME_SQL} as "WADMKK", cast(n_regionkey as varchar) as "WADMPR",
  replace(replace({adapter.BOUNDARY_NAME_SQL}, 'Kota ', 'KOTA_'), ' ', '') as regency_key,
  count(*)+1 as vertices, min(x) as west, max(y) as north
  from vx join nation on n_nationkey=regency_id group by 1,2,3"""
    )
    out["boundary_profile"] = (
        "select n_nationkey%11<>5 as all_valid, 'EPSG:4326' as crs, count(*) as features, 'Polygon' as geometry_types"
        " from nation group by 1"
    )

    wrong = ", ".join(f"({k},'{problem}')" for k, (_, found) in enumerate(adapter.GEOMETRIES) for problem in found)
    out["geometry_validity"] = (
        f"select s_suppkey as geometry, problem from supplier join (values {wrong}) as w(kind, problem)"
        f" on s_suppkey%{len(adapter.GEOMETRIES)}=kind"
    )

    out["quarantine"] = (
        with_ + _STAGED + " select *, 'REGION_NOT_MATCHED' as quarantine_issue from stg where regency_id=-999"
    )
    out["temporal_enrich"] = (
        with_ + _STAGED + f" select detection_id, acquisition_date, acquisition_time, {_TIMES} from stg where regency_id<>-999"
    )
    out["business_labels"] = with_ + _STAGED + f" select detection_id, {_BUSINESS} from stg where regency_id<>-999"
    joined = (
        "detection_id, regency_id, detection_datetime, detection_month_name, confidence_level_label, detection_period,"
        " detection_type_label, satellite_label, collection_version, processing_type"
    )
    out["detection_join"] = with_ + _DESCRIBED + f" select {joined} from det"
    out["detection_describe"] = out["detection_join"]
    out["dim_location"] = with_ + _STAR + " select * from place"
    out["dim_satellite"] = with_ + _STAR + " select * from sat"
    out["dim_classification"] = with_ + _STAR + " select * from cls"
    out["dim_process"] = with_ + _STAR + " select * from prc"
    out["fct_detection"] = with_ + _STAR + " select * from fct"

    out["daily_detection"] = with_ + _mart() + " " + _MART_ROWS
    out["daily_detection_rolling"] = (
        with_ + _mart(f"cast(f.acquisition_date as date) >= date '{ROLLING_AS_OF}' - 3") + " " + _MART_ROWS
    )
    for name in ("province", "regency"):
        out[f"top_{name}"] = (
            with_ + _mart() + f" select {name}_name, count(*) as total_detection from mart group by 1 order by 2 desc, 1"
        )
    grains = {"day": "acquisition_date", "month": "left(acquisition_date,7)", "year": "left(acquisition_date,4)",
              "season": "acquisition_date[6:7]"}
    out["trend"] = with_ + _mart() + " union all ".join(
        f" select '{g}' as grain, {p} as period, cast(sum(detection_count) as bigint) as detection_count,"
        f" round(cast(sum(sum_frp) as double),4) as total_frp from mart group by 2" for g, p in grains.items()
    )
    severity = (
        " select {0}, cast(sum(detection_count) as bigint) as detection_count,"
        " round(cast(sum(sum_frp) as double),4) as total_frp, max(max_frp) as max_frp from mart group by 1"
        " order by 2 desc, 3 desc, 1"
    )
    out["severity_ranking"] = with_ + _mart() + severity.format("province_name")
    out["severity_ranking_regency"] = with_ + _mart() + severity.format("regency_name") + " limit 10"
    out["density_grid"] = (
        with_ + _RAW + " select cast(floor(latitude/0.5e0) as bigint) as cell_row,"
        " cast(floor(longitude/0.5e0) as bigint) as cell_col, count(*) as detection_count from raw group by 1,2"
    )
    out["type_breakdown"] = (
        with_ + _mart() + " select detection_type_label, cast(sum(detection_count) as bigint) as detection_count,"
        " round(cast(sum(sum_frp) as double),4) as total_frp from mart group by 1"
    )

    # Incremental: newer values win on overlapping days; unseen only adds.
    out["upsert_fact"] = with_ + _STAR + " " + _changed(
        "fct", "acquisition_date", "detection_id, regency_id, fire_radiative_power, acquisition_date",
        "detection_id, regency_id, cast(cast(fire_radiative_power as decimal(38,9))+1 as double), acquisition_date",
        f"acquisition_date>='{CHANGES_FROM}'",
    )
    out["upsert_moved_days"] = (
        with_ + _STAR + " select detection_id, regency_id, fire_radiative_power, cast(case when acquisition_date>="
        f"'{CHANGES_FROM}' then cast(acquisition_date as date)+1 else cast(acquisition_date as date) end as varchar)"
        " as acquisition_date from fct"
    )
    out["append_replayed"] = (
        with_ + _ENRICHED + " select event_id, acquisition_date, fire_radiative_power, regency_id from enr"
    )
    out["partition_overwrite"] = (
        with_ + _mart() + " select acquisition_date, count(*) as rows, cast(sum(detection_count"
        f"+case when acquisition_date>='{CHANGES_FROM}' then 1 else 0 end) as bigint) as detections from mart group by 1"
    )
    out["date_scoped_replace"] = (
        with_ + _LOCATED + " select event_id, cast(acq_date as varchar) as acq_date, cast(regency_id as bigint) as regency_id,"
        " cast(try_cast(version as double) as bigint) as version, cast(type as bigint) as type,"
        f" case when acq_date=date '{CHANGES_FROM}' then frp+1 else frp end as frp from loc"
    )
    out["versioned_reload"] = (
        with_ + _RAW + " select event_id, case when confidence<>'x' then cast(acq_date as varchar) end as acq_date,"
        f" case when confidence<>'x' and acq_date=date '{CHANGES_FROM}' then frp+1 else frp end as frp from raw"
    )
    unseen = (
        f"select {{0}} from {{1}} where acquisition_date>='{CHANGES_FROM}'"
        f" and event_id not in (select event_id from {{1}} where acquisition_date<='{BASE_UNTIL}')"
    )
    kept = "event_id, acquisition_date, fire_radiative_power, regency_id"
    plus = "event_id, acquisition_date, fire_radiative_power+1 as fire_radiative_power"
    out["append_unseen"] = (
        with_ + _ENRICHED + f" select {kept} from enr where acquisition_date<='{BASE_UNTIL}' union all "
        + unseen.format(plus + ", regency_id", "enr")
    )
    out["unseen_events"] = with_ + _STREAM + " " + unseen.format(plus, "srow")

    out["quality_staging"] = with_ + _STAGED + " " + _checks("stg", DECLARED["stg_detection"], {})
    out["quality_fact"] = with_ + _STAR + " " + _checks("fct", DECLARED["fct_detection"], _PARENTS)
    out["quality_classification"] = (
        with_ + _STAR + " " + _checks("cls", DECLARED["dim_detection_classification"], {})
    )
    out["quality_process"] = with_ + _STAR + " " + _checks("prc", DECLARED["dim_collecting_process"], {})
    streamed = _ENRICHED.removeprefix(_RAW + ", ").replace(_SHAPES + ", ", "")
    kept = "from stg where regency_id<>-999"
    models = f"""{_mart()}, daily as ({_MART_ROWS}), {streamed}, sstg as ({_staged_stream('enr')}),
both_stg as (select * from stg union all select * from sstg), prov as (select cast(r_regionkey as bigint) as province_id,
  r_name as province_name from region), timed as (select detection_id, {_TIMES} {kept}),
labelled as (select detection_id, {_BUSINESS} {kept}), quar as (select *, 'REGION_NOT_MATCHED' as quarantine_issue,
  1 as quarantined_at from stg where regency_id=-999)"""
    tables = _PARENTS | {
        "fct_detection": "fct", "stg_detection_batch": "stg", "stg_detection_stream": "sstg", "stg_detection": "both_stg",
        "stg_regency": "reg", "stg_province": "prov", "int_detection_enrich": "timed", "int_detection_business": "labelled",
        "int_detection_join": "det", "int_detection_quarantine": "quar", "daily_detection": "daily",
    }
    out["quality_declared"] = with_ + models + " union all ".join(
        f" select '{name}' as model, * from ({_checks(tables[name], rules, _PARENTS)})" for name, rules in DECLARED.items()
    )
    gate = GATES["intermediate"][1]
    out["quality_gate"] = (
        with_ + _STAGED + " select 'table_exists' as \"check\", true as passed, cast(0 as bigint) as failing_rows union all "
        + _checks("stg", gate, {}, ("acquisition_date", ROLLING_AS_OF))
    )
    seen = (
        "select {0} as step, count(*) as rows, 0 as broken, count(distinct acq_date) as days, cast(count(*) as bigint) as counted"
        " from raw where {1}"
    )
    without, whole = f"acq_date<>date '{CHANGES_FROM}'", "true"
    out["audited_release"] = with_ + _RAW + " " + " union all ".join(
        seen.format(step, where) for step, where in enumerate((without, without, whole), 1)
    )
    out["relationship_violations"] = (
        with_ + _STAGED + " select regency_id as missing_key, count(*) as rows from stg"
        " where regency_id not in (select n_nationkey from nation) group by 1"
    )
    out["duplicated_events"] = (
        with_ + _STREAM + " select event_id, count(*) as count from srow group by 1 having count(*)>1"
    )

    out["distinct_coordinates"] = with_ + _RAW + " select distinct latitude, longitude from raw"
    profile = " union all ".join(
        f"select {p} as precision, count(*) as n from (select distinct {_grid(p)} from raw)" for p in range(6)
    )
    out["coordinate_profile"] = (
        with_ + _RAW + f", ex as (select count(*) as exact_count from (select distinct latitude, longitude from raw)),"
        f" pr as ({profile}) select cast(precision as bigint) as precision, n as unique_count, exact_count,"
        " round((1-n/exact_count)*100, 4) as reduction_pct from pr, ex"
    )
    out["coordinate_worklist"] = with_ + _ROUNDED + " select * from pts order by latitude, longitude limit 1000"
    out["coordinate_slice"] = with_ + _ROUNDED + " select * from pts order by latitude, longitude limit 500 offset 250"
    out["assign_location_ids"] = (
        with_ + _KNOWN + " select cast((select count(*) from early) + row_number() over (order by latitude, longitude)"
        " as bigint) as location_id, latitude as latitude_key, longitude as longitude_key from fresh"
    )
    out["unresolved_coordinates"] = with_ + _KNOWN + " select * from fresh"
    out["name_match_audit"] = with_ + _matched() + " select * from m"
    out["name_match_counts"] = (
        with_ + _matched() + " select count(regency_id) as matched, count(*)-count(regency_id) as unmatched from m"
    )
    out["unmatched_names"] = with_ + _matched() + ' select "WADMKK", "WADMPR" from m where regency_id is null'
    out["parse_location"] = """
select c_custkey, case when c_mktsegment in ('BUILDING','MACHINERY') then null else n_name end as county,
  case when c_mktsegment in ('BUILDING','MACHINERY') then null else r_name end as state,
  case when c_mktsegment='MACHINERY' then null else 'Indonesia' end as country
from customer join nation on n_nationkey=c_nationkey join region on r_regionkey=n_regionkey"""

    outcome = problem.replace("'NONE'", "'ROW'")
    out["stream_outcomes"] = (
        with_ + _RAW + f" select {outcome} as outcome, count(*) as messages from raw group by 1"
        " union all select 'SENT', count(*) from raw"
    )
    out["stream_latest"] = (
        with_ + _STREAM + " select event_id, acquisition_date, acquisition_time, ingested_timestamp, fire_radiative_power"
        " from srow qualify row_number() over (partition by event_id order by acquisition_date desc, acquisition_time desc,"
        " ingested_timestamp desc)=1"
    )
    out["stream_end_to_end"] = (
        with_ + _STREAM + " select * exclude (ingested_timestamp) from srow"
    )
    out["stream_enrichment"] = (
        with_ + _ENRICHED + " select event_id, fire_radiative_power, regency_id, acquisition_date from enr"
    )
    return out
