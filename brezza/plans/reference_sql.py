"""SQL that gives the results of ``reference_queries``, written for another engine and without its code."""

from __future__ import annotations

from brezza.plans.problems import STATION_HISTORY

_TIDY = "upper(regexp_replace({0}, '\\s+', '', 'g'))"

_TYPES = """
types_raw as (
  select distinct station_id, extracted_on from stg_arpae__stations
  union select distinct station_id, date '2024-06-24' from int_measurements_deduplicated),
types_labelled as (
  select station_id, extracted_on,
    case ((station_id + (extracted_on - date '2024-01-01')) % 7)
      when 0 then 'Urbana Traffico' when 1 then 'Suburbana Fondo' when 2 then 'Rurale' when 3 then 'Fondo remoto' when 4 then 'URBANA INDUSTRIALE' when 5 then 'Traffico' else '' end as label
  from types_raw),
types as (
  select station_id, extracted_on, label, 'S' || station_id as bulletin_station_name,
    case when lower(label) like '%traffico%' then 'traffic' when lower(label) like '%fondo%' then 'background' when lower(label) like '%industriale%' then 'industrial' end as station_type,
    case when lower(label) like '%remot%' then 'remote' when lower(label) like '%suburban%' then 'suburban' when lower(label) like '%urban%' then 'urban' when lower(label) like '%rural%' then 'rural' end as area_type
  from types_labelled),
types_latest as (select * from types qualify row_number() over (partition by station_id order by extracted_on desc) = 1),
types_stated as (select * from types where station_type is not null qualify row_number() over (partition by station_id order by extracted_on desc) = 1),
types_reference as (
  select distinct station_id, case station_id % 3 when 0 then 'background' when 1 then 'traffic' else 'other' end as station_type, case station_id % 3 when 0 then 'rural' end as area_type
  from int_measurements_deduplicated),
types_current as (
  select l.station_id, coalesce(s.station_type, r.station_type, 'other') as station_type, coalesce(l.area_type, s.area_type, r.area_type) as area_type,
    case when l.station_type is not null then 'latest_snapshot' when s.station_type is not null then 'earlier_snapshot' when r.station_type is not null then 'reference' else 'unknown' end as station_type_source,
    l.label as type_label_original, '20240101' as bulletin_id, l.extracted_on
  from types_latest l left join types_stated s using (station_id) left join (select * from types_reference where station_type <> 'other') r using (station_id))
"""

_STATIONS = (
    _TYPES
    + f"""
, open_sensors as (
  select * from stg_arpae__stations where extracted_on = (select max(extracted_on) from stg_arpae__stations)
  qualify row_number() over (partition by station_id, pollutant_id order by loaded_at desc) = 1),
registry as (
  select station_id, {_TIDY.format("station_name")} as station_name, {_TIDY.format("municipality")} as municipality, {_TIDY.format("province")} as province, {_TIDY.format("address")} as address,
    altitude_m, longitude, latitude, cast(cast(round(latitude * 10) as bigint) as varchar) || '_' || cast(cast(round(longitude * 10) as bigint) as varchar) as weather_location_id
  from open_sensors),
stations as (
  select station_id, station_name, municipality, weather_location_id, province from registry
  qualify row_number() over (partition by station_id order by station_name nulls first, municipality nulls first, province nulls first, address nulls first,
    altitude_m nulls first, longitude nulls first, latitude nulls first) = 1
  union all
  select station_id, bulletin_station_name, null, null, '' from types_latest where station_id not in (select station_id from registry))
"""
)

_WEATHER = """
weather_hourly as (
  select s.weather_location_id as location_id, cast(m.measured_at_utc as date) as weather_date, m.concentration_ugm3 / 4 as t,
    case when hour(m.measured_at_utc) % 11 <> 0 then (day(m.measured_at_utc) % 4) * 0.1::double end as p, m.concentration_ugm3 / 16 as w, m.concentration_ugm3 + 900 as h
  from int_measurements_deduplicated m join stations s using (station_id)
  where m.pollutant_code = 'O3' and m.is_valid and s.weather_location_id is not null),
weather as (
  select location_id, weather_date, avg(w) as wind_speed_mean_ms, max(w) as wind_speed_max_ms, sum(p) as precipitation_mm, avg(t) as temperature_mean_c, avg(h) as surface_pressure_mean_hpa,
    count(case when w is not null and p is not null then 1 end) as hours
  from weather_hourly group by all)
"""

_DAYS_IN_YEAR = "(make_date({0} + 1, 1, 1) - make_date({0}, 1, 1))"

_LIMITS = """
limits_by_code(pollutant_code, metric, limit_ugm3, max_exceedances_per_year) as (values
  ('PM10', 'daily_mean', 50.0::double, 35), ('NO2', 'hourly_mean', 200.0::double, 18), ('O3', 'daily_max_8h_mean', 120.0::double, 25)),
limits as (select distinct p.pollutant_id, l.* from limits_by_code l join arpae_pollutants p using (pollutant_code)),
periods as (
  select station_id, pollutant_id, 'daily_mean' as metric, measurement_date, daily_mean_ugm3 as v, 1 as n from int_measurements_daily where is_valid_day
  union all
  select station_id, pollutant_id, 'hourly_mean', measurement_date, concentration_ugm3, 24 from int_measurements_deduplicated where is_valid and averaging_minutes = 60
  union all
  select station_id, pollutant_id, 'daily_max_8h_mean', measurement_date, max(rolling_8h_mean_ugm3), 1 from int_o3_8h_rolling where is_valid_window
  group by all having count(*) >= 18),
yearly as (
  select p.station_id, pollutant_id, pollutant_code, metric, year(p.measurement_date) as year, limit_ugm3, max_exceedances_per_year,
    count(case when round(v) > limit_ugm3 then 1 end) as exceedances, count(*) as valid_periods, max(v) as max_value_ugm3, max(n) as n
  from periods p join limits using (pollutant_id, metric) group by all)
"""

_GRID = """
spans as (
  select station_id, pollutant_id, pollutant_code, expected_measurements, min(measurement_date) as a, max(measurement_date) as z from int_measurements_daily group by all),
grid as (
  select * from (select * exclude (a, z), cast(unnest(generate_series(a, z, interval 1 day)) as date) as measurement_date from spans)
  where measurement_date in (select measurement_date from int_measurements_daily)),
completeness as (
  select g.station_id, s.station_name, s.municipality, g.pollutant_id, g.pollutant_code, g.measurement_date, g.expected_measurements,
    coalesce(d.measurements, 0) as measurements, coalesce(d.valid_measurements, 0) as valid_measurements,
    coalesce(d.valid_measurements, 0) / g.expected_measurements as completeness, coalesce(d.is_valid_day, false) as is_complete
  from grid g left join int_measurements_daily d using (station_id, pollutant_id, measurement_date) left join stations s using (station_id))
"""

_FEED = """
feed as (
  select station_id, pollutant_id, measured_at_utc, concentration_ugm3, value_original, unit_original, validation_flag from stg_arpae__measurements
  qualify row_number() over (partition by station_id, pollutant_id, measured_at_utc order by ingested_at desc, row_id desc) = 1)
"""

_FLAGGED = """
  select station_id, pollutant_id, pollutant_code, averaging_minutes, measured_at_utc,
    case when averaging_minutes = 60 then measured_at_utc - interval 1 hour else measured_at_utc end as period_start_utc,
    cast(case when averaging_minutes = 60 then measured_at_utc else measured_at_utc + interval 1 hour end as date) as measurement_date,
    round(concentration_ugm3, 6) as concentration_ugm3, round(value_original, 6) as value_original, unit_original, validation_flag, source_name,
    coalesce(concentration_ugm3 < 0, false) as is_negative, coalesce(concentration_ugm3 = 0, false) as is_zero, coalesce(concentration_ugm3 > max_plausible_ugm3, false) as is_implausible,
    concentration_ugm3 is not null and not coalesce(concentration_ugm3 < 0, false) and not coalesce(concentration_ugm3 > max_plausible_ugm3, false) as is_valid
"""

_SCOPE = """
with loaded as (select * from int_measurements_deduplicated where is_valid)
select f.station_id, f.pollutant_id, f.measured_at_utc from int_measurements_deduplicated f
where f.measured_at_utc >= {0}
  or (f.source_name = 'archive' and not exists (
    select 1 from loaded l where l.station_id = f.station_id and l.pollutant_id = f.pollutant_id and l.measured_at_utc = f.measured_at_utc and l.source_name = 'archive'))
"""

_YEARS = f"""
station_years as (
  select station_id, pollutant_id, pollutant_code, year(measurement_date) as year, avg(daily_mean_ugm3) as m, count(*) / {_DAYS_IN_YEAR.format("year(measurement_date)")} as c
  from int_measurements_daily where is_valid_day group by station_id, pollutant_id, pollutant_code, year(measurement_date))
"""

_PAIRED = """
means as (
  select s.province as municipality, t.station_type, d.pollutant_id, d.pollutant_code, d.measurement_date, avg(d.daily_mean_ugm3) as m, count(*) as n
  from int_measurements_daily d join types_current t using (station_id) join stations s using (station_id) where d.is_valid_day group by all),
paired as (
  select a.municipality, a.pollutant_id, a.pollutant_code, a.measurement_date, a.m as t, b.m as b, a.n as tn, b.n as bn
  from means a join means b using (municipality, pollutant_id, measurement_date) where a.station_type = 'traffic' and b.station_type = 'background')
"""

_CORRELATED = """
paired as (
  select d.station_id, s.station_name, s.municipality, d.daily_mean_ugm3 as m, w.wind_speed_mean_ms as w, w.precipitation_mm as p,
    case when month(d.measurement_date) in (12, 1, 2) then 'winter' when month(d.measurement_date) <= 5 then 'spring' when month(d.measurement_date) <= 8 then 'summer' else 'autumn' end as season
  from int_measurements_daily d join stations s using (station_id) join weather w on w.location_id = s.weather_location_id and w.weather_date = d.measurement_date
  where d.pollutant_code = 'PM10' and d.is_valid_day and w.hours / 24 >= 0.75),
grouped as (
  select station_id, station_name, municipality, season, count(*) as days, avg(m) as pm10_mean_ugm3,
    case when count(*) >= 20 and var_pop(w) > 0 and var_pop(m) > 0 then corr(m, w) end as corr_pm10_wind,
    case when count(*) >= 20 and var_pop(p) > 0 and var_pop(m) > 0 then corr(m, p) end as corr_pm10_precipitation,
    count(case when w >= 3 then 1 end) as windy_days, avg(case when w >= 3 then m end) as pm10_mean_windy_ugm3, avg(case when w < 3 then m end) as pm10_mean_calm_ugm3,
    count(case when p >= 1 then 1 end) as rainy_days, avg(case when p >= 1 then m end) as pm10_mean_rainy_ugm3, avg(case when p < 1 then m end) as pm10_mean_dry_ugm3
  from paired group by station_id, station_name, municipality, season)
"""

_TREND = """
select municipality, {0} pollutant_code, year, count(*) as stations, round(avg(m), {1}) as annual_mean_ugm3, round(min(m), {1}) as min_station_mean_ugm3, round(max(m), {1}) as max_station_mean_ugm3,
  round(min(c), {1}) as min_year_coverage, min(c) >= 0.9 as is_representative from station_years join stations using (station_id) where municipality is not null {2} group by municipality, pollutant_id, pollutant_code, year"""

_TRAFFIC = """
select municipality, pollutant_code, cast(date_trunc('month', measurement_date) as date) as month, count(*) as days, max(tn) as traffic_stations, max(bn) as background_stations, round(avg(t), {0}) as traffic_mean_ugm3,
  round(avg(b), {0}) as background_mean_ugm3, round(avg(t) - avg(b), {0}) as difference_ugm3, round(avg(t) / nullif(avg(b), 0), {0}) as traffic_to_background_ratio
from paired {1} group by municipality, pollutant_id, pollutant_code, cast(date_trunc('month', measurement_date) as date)"""

_THOUSANDTHS = """
select * replace (round(traffic_mean_ugm3, 3) as traffic_mean_ugm3, round(background_mean_ugm3, 3) as background_mean_ugm3, round(difference_ugm3, 3) as difference_ugm3,
  round(traffic_to_background_ratio, 3) as traffic_to_background_ratio) from ({0})"""

_CORRELATION = """
select station_id, station_name, municipality, season, days, round(pm10_mean_ugm3, {0}) as pm10_mean_ugm3, round(corr_pm10_wind, {0}) as corr_pm10_wind, round(corr_pm10_precipitation, {0}) as corr_pm10_precipitation,
  windy_days, round(pm10_mean_windy_ugm3, {0}) as pm10_mean_windy_ugm3, round(pm10_mean_calm_ugm3, {0}) as pm10_mean_calm_ugm3, rainy_days, round(pm10_mean_rainy_ugm3, {0}) as pm10_mean_rainy_ugm3,
  round(pm10_mean_dry_ugm3, {0}) as pm10_mean_dry_ugm3 from grouped {1}"""

_EXPORTED = """
exported as ({0})
select to_json(e)::varchar as line from exported e"""

_EXCEEDED = """
select y.station_id, s.station_name, s.municipality, {0} pollutant_code, metric, year, exceedances, limit_ugm3, max_exceedances_per_year, exceedances > max_exceedances_per_year as is_over_allowed_exceedances,
  round(max_value_ugm3, {1}) as max_value_ugm3, valid_periods, round(valid_periods / (n * (make_date(year + 1, 1, 1) - make_date(year, 1, 1))), {1}) as year_coverage
from yearly y left join stations s using (station_id)"""

ORACLES: dict[str, str] = {
    "s05_archive_stamps": """
with parsed as (
  select file_name, row_no, case when regexp_full_match(replace(trim(cod_staz), '.', ''), '[0-9]{1,10}') then cast(replace(trim(cod_staz), '.', '') as bigint) end as station_id,
    cast(id_param as bigint) as pollutant_id, try_cast(trim(valore) as double) as value,
    case when regexp_full_match(trim(data_inizio), '\\d\\d/\\d\\d/\\d{4} ([01]\\d|2[0-4])') then try_strptime(trim(data_inizio)[1:10], '%d/%m/%Y') + to_hours(cast(trim(data_inizio)[12:13] as int)) end as s,
    case when regexp_full_match(trim(data_fine), '\\d\\d/\\d\\d/\\d{4} ([01]\\d|2[0-4])') then try_strptime(trim(data_fine)[1:10], '%d/%m/%Y') + to_hours(cast(trim(data_fine)[12:13] as int)) end as e
  from csv_row),
judged as (
  select *, case when station_id is null then 'station' when pollutant_id is null then 'parameter' when s is null or e is null then 'time' when value is null then 'value' when e <= s then 'interval' end as problem from parsed)
select distinct file_name, row_no, station_id, pollutant_id, case when problem is null then case when e - s >= interval 24 hour then s else e end - interval 1 hour end as measured_at_utc, value, problem
from judged""",
    "s07_archive_records": r"""
with records as (
  select *, regexp_extract(reftime, '(Z|[+-]\d\d:\d\d)$', 1) as zone, try_cast(replace(regexp_extract(reftime, '^(.*?)(Z|[+-]\d\d:\d\d)$', 1), 'T', ' ') as timestamp) as local
  from measurement_record where try_cast(station_id as bigint) is not null),
placed as (
  select *, case when regexp_full_match(reftime, '20\d\d-\d\d-\d\d[T ]\d\d:\d\d(:\d\d([.]\d+)?)?(Z|[+-]\d\d:\d\d)')
    then local - to_minutes(case when zone = 'Z' then 0 else case when zone[1] = '-' then -1 else 1 end * (coalesce(try_cast(zone[2:3] as int), 0) * 60 + coalesce(try_cast(zone[5:6] as int), 0)) end) end as moment
  from records)
select distinct _id as record_id, cast(r.station_id as bigint) as station_id, cast(p.pollutant_id as bigint) as pollutant_id,
  case when p.pollutant_id is null then null when p.averaging_minutes = 1440 then moment - interval 1 day else moment + interval 1 hour end as measured_at_utc, value, reftime as raw_reftime,
  case when p.pollutant_id is null then 'parameter' when moment is null then 'time' end as problem
from placed r left join arpae_pollutants p on p.archive_parameter_id = r.parameter_id""",
    "s09_station_registry": """
select cast(station_id as bigint) as station_id, trim(station_name) as station_name, trim(municipality) as municipality, trim(province) as province, trim(address) as address, round(altitude_m, 6) as altitude_m,
  round(longitude, 6) as longitude, round(latitude, 6) as latitude, cast(pollutant_id as bigint) as pollutant_id, trim(pollutant_name) as pollutant_name, trim(unit_original) as unit from stg_arpae__stations""",
    "s10_station_types": """
select distinct cast(station_id as bigint) as station_id, 'S' || station_id as station_name, 'BO' as province, case station_id % 3 when 0 then 'Urbana Traffico' when 1 then 'Urbana Fondo' else 'Rurale' end as type_label,
  strftime(extracted_on, '%Y%m%d') as bulletin_id from stg_arpae__stations""",
    "s11_weather": """
select 'L' || station_id as location_id, 44.4::double as latitude, 44.5::double as grid_latitude, measured_at_utc as observed_at_utc, round(concentration_ugm3, 6) as temperature_c,
  round(case when hour(measured_at_utc) % 3 <> 0 then concentration_ugm3 / 8 end, 6) as wind_speed_ms
from int_measurements_deduplicated where pollutant_code = 'O3' and concentration_ugm3 is not null""",
    "s14_weather_locations": """
with cells as (
  select cast(cast(round(latitude * 10) as bigint) as varchar) || '_' || cast(cast(round(longitude * 10) as bigint) as varchar) as location_id, latitude, longitude
  from stg_arpae__stations where latitude is not null and longitude is not null)
select location_id, latitude, longitude from cells qualify row_number() over (partition by location_id order by latitude, longitude) = 1""",
    "f01_unit_conversion": """
select row_id, round(case when unit_original in ('ug/m3', 'µg/m³') then value_original when unit_original in ('mg/m3', 'mg/m³') then value_original * 1000 end, 6) as concentration_ugm3
from stg_arpae__measurements""",
    "f06_location_id": """
select distinct station_id, pollutant_id, cast(cast(round(latitude * 10) as bigint) as varchar) || '_' || cast(cast(round(longitude * 10) as bigint) as varchar) as weather_location_id
from snap_arpae__stations""",
    "f10_calendar": f"""
select distinct measurement_date as day,
  case when month(measurement_date) in (12, 1, 2) then 'winter' when month(measurement_date) <= 5 then 'spring' when month(measurement_date) <= 8 then 'summer' else 'autumn' end as season,
  cast(date_trunc('month', measurement_date) as date) as month, {_DAYS_IN_YEAR.format("year(measurement_date)")} as days_in_year, year(measurement_date) as year
from int_measurements_daily""",
    "f16_unpivot": """
select station_id, pollutant_id, measurement_date, statistic, value_ugm3
from (unpivot (select station_id, pollutant_id, measurement_date, daily_mean_ugm3, daily_max_ugm3 from int_measurements_daily) on daily_mean_ugm3, daily_max_ugm3 into name statistic value value_ugm3)""",
    "pred04_latest_snapshot": """
select distinct station_id, pollutant_id, station_name, extracted_on from stg_arpae__stations where extracted_on = (select max(extracted_on) from stg_arpae__stations)""",
    "pred05_incremental_scope": _SCOPE.format("(select max(measured_at_utc) - interval 30 day from loaded)"),
    "pred06_reprocess_scope": _SCOPE.format("(select least(max(measured_at_utc) - interval 30 day, timestamp '2026-05-10' - interval 1 day) from loaded)"),
    "m01_staged_measurements": """
select station_id, pollutant_id, measured_at_utc, round(case when unit_original in ('ug/m3', 'µg/m³') then value_original when unit_original in ('mg/m3', 'mg/m³') then value_original * 1000 end, 6) as concentration_ugm3,
  round(value_original, 6) as value_original, unit_original, validation_flag from stg_arpae__measurements""",
    "m02_staged_stations": """
select * replace (round(altitude_m, 6) as altitude_m, round(longitude, 6) as longitude, round(latitude, 6) as latitude) from stg_arpae__stations where extracted_on = (select max(extracted_on) from stg_arpae__stations)""",
    "m04_staged_weather": """
select station_id as location_id, measured_at_utc as observed_at_utc, round(rolling_8h_mean_ugm3, 6) as temperature_c, null::double as precipitation_mm, valid_hours_in_window::double as wind_speed_ms,
  null::double as wind_direction_deg, null::double as surface_pressure_hpa from int_o3_8h_rolling""",
    "m06_measurements_deduplicated": f"""
with {_FEED},
united as (
  select station_id, pollutant_id, measured_at_utc, concentration_ugm3, value_original, unit_original, validation_flag, 'archive' as source_name from int_measurements_deduplicated
  union all
  select *, 'near_real_time' from feed f where not exists (
    select 1 from int_measurements_deduplicated a where a.station_id = f.station_id and a.pollutant_id = f.pollutant_id and a.measured_at_utc = f.measured_at_utc))
{_FLAGGED} from united left join arpae_pollutants using (pollutant_id)""",
    "m06_incremental": f"""
with {_FEED},
loaded as (select * from int_measurements_deduplicated where measured_at_utc < timestamp '2026-06-20'),
fresh as (select *, 'near_real_time' as source_name from feed where measured_at_utc >= (select max(measured_at_utc) - interval 30 day from loaded)),
flagged as ({_FLAGGED} from fresh left join arpae_pollutants using (pollutant_id)),
fact as (
  select source_name, pollutant_id, is_valid from loaded l where not exists (
    select 1 from fresh f where f.station_id = l.station_id and f.pollutant_id = l.pollutant_id and f.measured_at_utc = l.measured_at_utc)
  union all select source_name, pollutant_id, is_valid from flagged)
select source_name, pollutant_id, count(*) as rows, count(case when is_valid then 1 end) as valid_rows from fact group by all""",
    "m07_measurements_daily": """
select station_id, pollutant_id, pollutant_code, averaging_minutes, measurement_date, round(avg(case when is_valid then concentration_ugm3 end), 6) as daily_mean_ugm3,
  round(max(case when is_valid then concentration_ugm3 end), 6) as daily_max_ugm3, count(*) as measurements, count(case when is_valid then 1 end) as valid_measurements,
  cast(1440 // averaging_minutes as integer) as expected_measurements, round(count(case when is_valid then 1 end) / (1440 // averaging_minutes), 6) as coverage,
  count(case when is_valid then 1 end) / (1440 // averaging_minutes) >= 0.75 as is_valid_day
from int_measurements_deduplicated group by station_id, pollutant_id, pollutant_code, averaging_minutes, measurement_date""",
    "m08_o3_8h_rolling": """
with hourly as (select * from int_measurements_deduplicated where pollutant_code = 'O3' and is_valid),
spans as (select station_id, pollutant_id, pollutant_code, min(measurement_date) as a, max(measurement_date) as z from hourly group by all),
days as (select station_id, pollutant_id, pollutant_code, cast(unnest(generate_series(a, z, interval 1 day)) as date) as measurement_date from spans),
grid as (select *, unnest(range(24)) as h from days),
hours as (select * exclude (h), cast(measurement_date as timestamp) + to_hours(h) as measured_at_utc from grid),
rolled as (
  select g.*, avg(m.concentration_ugm3) over w as rolling_8h_mean_ugm3, count(m.concentration_ugm3) over w as valid_hours_in_window
  from hours g left join hourly m on m.station_id = g.station_id and m.pollutant_id = g.pollutant_id and m.measured_at_utc = g.measured_at_utc
  window w as (partition by g.station_id, g.pollutant_id order by g.measured_at_utc rows between 7 preceding and current row))
select station_id, pollutant_id, pollutant_code, measured_at_utc, measurement_date, round(rolling_8h_mean_ugm3, 6) as rolling_8h_mean_ugm3, valid_hours_in_window,
  valid_hours_in_window / 8 >= 0.75 as is_valid_window from rolled""",
    "m09_stations_current": f"with {_STATIONS} select station_id, station_name, municipality, weather_location_id from stations",
    "m10_station_types_current": f"with {_TYPES} select * from types_current",
    "m11_weather_daily": f"""
with {_STATIONS}, {_WEATHER}
select location_id, weather_date, round(wind_speed_mean_ms, 6) as wind_speed_mean_ms, round(wind_speed_max_ms, 6) as wind_speed_max_ms, round(precipitation_mm, 6) as precipitation_mm,
  round(temperature_mean_c, 6) as temperature_mean_c, round(surface_pressure_mean_hpa, 6) as surface_pressure_mean_hpa, hours, hours / 24 >= 0.75 as is_valid_day from weather""",
    "m12_exceedances_yearly": f"""
with {_STATIONS}, {_LIMITS}
select y.station_id, s.station_name, s.municipality, pollutant_id, pollutant_code, metric, year, exceedances, limit_ugm3, max_exceedances_per_year,
  exceedances > max_exceedances_per_year as is_over_allowed_exceedances, round(max_value_ugm3, 6) as max_value_ugm3, valid_periods,
  round(valid_periods / (n * {_DAYS_IN_YEAR.format("year")}), 6) as year_coverage
from yearly y left join stations s using (station_id)""",
    "m13_data_completeness": f"with {_STATIONS}, {_GRID} select * replace (round(completeness, 6) as completeness) from completeness",
    "m14_pollutant_trend": f"""
with {_STATIONS},
{_YEARS}
select municipality, pollutant_id, pollutant_code, year, count(*) as stations, round(avg(m), 6) as annual_mean_ugm3, round(min(m), 6) as min_station_mean_ugm3,
  round(max(m), 6) as max_station_mean_ugm3, round(min(c), 6) as min_year_coverage, min(c) >= 0.9 as is_representative
from station_years join stations using (station_id) where municipality is not null group by all""",
    "m15_traffic_vs_background": f"""
with {_STATIONS},
{_PAIRED}
select municipality, pollutant_id, pollutant_code, cast(date_trunc('month', measurement_date) as date) as month, count(*) as days, max(tn) as traffic_stations, max(bn) as background_stations,
  round(avg(t), 6) as traffic_mean_ugm3, round(avg(b), 6) as background_mean_ugm3, round(avg(t) - avg(b), 6) as difference_ugm3, round(avg(t) / nullif(avg(b), 0), 6) as traffic_to_background_ratio
from paired group by all""",
    "m16_weather_correlation": f"""
with {_STATIONS}, {_WEATHER},
{_CORRELATED}
select station_id, station_name, municipality, season, days, round(pm10_mean_ugm3, 6) as pm10_mean_ugm3, round(corr_pm10_wind, 6) as corr_pm10_wind,
  round(corr_pm10_precipitation, 6) as corr_pm10_precipitation, windy_days, round(pm10_mean_windy_ugm3, 6) as pm10_mean_windy_ugm3, round(pm10_mean_calm_ugm3, 6) as pm10_mean_calm_ugm3,
  rainy_days, round(pm10_mean_rainy_ugm3, 6) as pm10_mean_rainy_ugm3, round(pm10_mean_dry_ugm3, 6) as pm10_mean_dry_ugm3
from grouped""",
    "k01_upsert": """
with incoming as (
  select station_id, pollutant_id, measured_at_utc, value_original, unit_original from stg_arpae__measurements
  qualify row_number() over (partition by station_id, pollutant_id, measured_at_utc order by row_id desc) = 1),
merged as (
  select coalesce(s.pollutant_id, i.pollutant_id) as pollutant_id, case when i.station_id is null then s.value_original else i.value_original end as value_original,
    case when s.station_id is null then 'inserted' when i.station_id is null then 'kept'
      when s.value_original is not distinct from i.value_original and s.unit_original is not distinct from i.unit_original then 'unchanged' else 'updated' end as change
  from int_measurements_deduplicated s full join incoming i on i.station_id = s.station_id and i.pollutant_id = s.pollutant_id and i.measured_at_utc = s.measured_at_utc)
select change, pollutant_id, count(*) as rows, round(sum(value_original), 4) as total from merged group by all""",
    "k09_scd2": STATION_HISTORY.format(
        columns="station_id, pollutant_id, upper(regexp_replace(station_name, '\\s+', '', 'g')) as station_name, round(altitude_m, 3) as altitude_m, valid_from, day as valid_to",
        closed="station_id, pollutant_id, upper(regexp_replace(station_name, '\\s+', '', 'g')), round(altitude_m, 3), dbt_valid_from, dbt_valid_to",
    ),
    "k11_monthly_completeness": f"""
with {_STATIONS}, {_GRID}
select station_id, pollutant_code, cast(date_trunc('month', measurement_date) as date) as month, count(*) as days, count(*) filter (where is_complete) as complete_days,
  round(avg(completeness), 6) as completeness from completeness group by all""",
    "q01_duplicates": """
select station_id, pollutant_id, measured_at_utc, count(*) as rows from stg_arpae__measurements group by all having count(*) > 1""",
    "q02_orphans": """
select distinct station_id, pollutant_id from stg_arpae__stations s where station_id is not null and pollutant_id is not null
  and not exists (select 1 from int_measurements_deduplicated f where f.station_id = s.station_id and f.pollutant_id = s.pollutant_id)""",
    "q02_nulls": "select row_id from stg_arpae__measurements where unit_original is null",
    "q02_unaccepted": """
select unit_original, count(*) as rows from stg_arpae__measurements where unit_original not in ('ug/m3', 'µg/m³', 'mg/m3', 'mg/m³') group by all""",
    "q03_correlations": f"""
with {_STATIONS}, {_WEATHER}, {_CORRELATED}
select station_id, season, round(corr_pm10_wind, 6) as corr_pm10_wind, round(corr_pm10_precipitation, 6) as corr_pm10_precipitation from grouped
where abs(corr_pm10_wind) > 0.1000001 or abs(corr_pm10_precipitation) > 0.1000001""",
    "q05_inconsistent_exceedances": f"""
with {_LIMITS} select station_id, pollutant_id, year, exceedances + 100 as exceedances, valid_periods from yearly where exceedances + 100 > valid_periods""",
    "q07_missing_kinds": f"""
with {_TYPES} select k as station_type from unnest(['traffic', 'background', 'industrial', 'harbour', 'other']) u(k) where k not in (select station_type from types_current)""",
    "q08_implausible": "select station_id, pollutant_id, measured_at_utc, concentration_ugm3 from int_measurements_deduplicated where is_implausible",
    "q08_negative": "select station_id, pollutant_id, measured_at_utc, concentration_ugm3 from int_measurements_deduplicated where is_negative",
    "q08_stale_types": f"""
with {_TYPES} select station_id, station_type, station_type_source, type_label_original from types_current where station_type_source in ('earlier_snapshot', 'reference')""",
    "q04_inconsistent_days": """
with days as (
  select station_id, pollutant_id, pollutant_code, averaging_minutes, measurement_date, avg(case when is_valid then concentration_ugm3 end) as m, max(case when is_valid then concentration_ugm3 end) as x,
    count(*) as n, count(case when is_valid then 1 end) as v, 1440 // averaging_minutes as e
  from int_measurements_deduplicated where not is_implausible group by all)
select station_id, pollutant_id, pollutant_code, averaging_minutes, measurement_date, round(m, 6) as daily_mean_ugm3, round(x, 6) as daily_max_ugm3, n as measurements, v as valid_measurements,
  cast(e - 1 as integer) as expected_measurements, round(v / e, 6) as coverage, v / e >= 0.75 as is_valid_day
from days where n > e - 1 or m < 0""",
    "q06_flagged_but_valid": """
select station_id, pollutant_id, measured_at_utc, is_negative, is_implausible from int_measurements_deduplicated
where concentration_ugm3 is not null and (is_negative or is_implausible)""",
    "q09_symmetric_difference": """
with own as (
  select station_id, pollutant_id, measurement_date, round(avg(case when is_valid then concentration_ugm3 end), 6) as m, count(case when is_valid then 1 end) as v
  from int_measurements_deduplicated where not is_zero group by all),
held as (select station_id, pollutant_id, measurement_date, round(daily_mean_ugm3, 6) as m, valid_measurements as v from int_measurements_daily)
select station_id, pollutant_id, measurement_date, 'left' as side from (select * from own except all select * from held)
union all
select station_id, pollutant_id, measurement_date, 'right' from (select * from held except all select * from own)""",
    "x01_distinct": "select distinct pollutant_code from int_measurements_daily where pollutant_code is not null",
    "x02_exceedances": f"""
with {_STATIONS}, {_LIMITS} {_EXCEEDED.format("", 6)} where metric = 'hourly_mean' and year between 2025 and 2026""",
    "x03_pollutant_trend": f"""
with {_STATIONS}, {_YEARS} {_TREND.format("", 6, "and pollutant_code = 'NO2' and year between 2025 and 2026")}""",
    "x04_traffic_vs_background": f"""
with {_STATIONS}, {_PAIRED} {_TRAFFIC.format(6, "where pollutant_code = 'PM10' and municipality = (select min(municipality) from paired where pollutant_code = 'PM10') and date_trunc('month', measurement_date) between date '2025-01-01' and date '2026-12-31'")}""",
    "x05_weather_correlation": f"""
with {_STATIONS}, {_WEATHER}, {_CORRELATED} {_CORRELATION.format(6, "where season in ('spring', 'summer')")}""",
    "x06_completeness": f"""
with {_STATIONS}, {_GRID}
select station_id, cast(station_id as varchar) as station_name, pollutant_code, measurement_date, expected_measurements, valid_measurements, round(completeness, 6) as completeness, is_complete from completeness
where station_id = 9100001 and pollutant_code in ('PM10', 'O3') and measurement_date between date '2026-05-01' and date '2026-06-15'""",
    "x09_export_exceedances": f"""
with {_STATIONS}, {_LIMITS}, {_EXPORTED.format(_EXCEEDED.format("", 3))}""",
    "x10_export_trend": f"""
with {_STATIONS}, {_YEARS}, {_EXPORTED.format(_TREND.format("", 3, ""))}""",
    "x11_export_traffic": f"""
with {_STATIONS}, {_PAIRED}, {_EXPORTED.format(_THOUSANDTHS.format(_TRAFFIC.format(6, "")))}""",
    "x12_export_correlation": f"""
with {_STATIONS}, {_WEATHER}, {_CORRELATED}, {_EXPORTED.format(_CORRELATION.format(3, ""))}""",
    "x13_export_completeness": f"""
with {_STATIONS}, {_GRID}, {_EXPORTED.format("""
select station_id, station_name, municipality, pollutant_code, cast(date_trunc('month', measurement_date) as date) as month, count(*) as days, count(*) filter (where is_complete) as complete_days,
  round(avg(completeness), 3) as completeness from completeness group by all""")}""",
    "x07_date_range": "select min(measurement_date) as first, max(measurement_date) as last from int_measurements_daily",
    "x19_loaded_days": """
select distinct cast(measured_at_utc + interval 1 hour - interval 1 second as date) as day from int_measurements_deduplicated where measured_at_utc is not null
intersect select distinct cast(measured_at_utc as date) from int_o3_8h_rolling where measured_at_utc is not null""",
    "x22_missing_months": """
with loaded as (select distinct cast(measured_at_utc + interval 1 hour - interval 1 second as date) as day from stg_arpae__measurements),
months as (
  select greatest(m, date '2026-03-10') as first, least(last_day(m), date '2026-09-14') as last
  from (select cast(unnest(generate_series(date '2026-03-01', date '2026-09-01', interval 1 month)) as date) as m))
select first, last from months
where first not in (select day from loaded) or (last < date '2026-09-14' and last not in (select day from loaded)) order by first limit 12""",
    "x24_freshness": """
select max(measured_at_utc) as newest, round(epoch_us(timestamp '2026-07-02 00:00:00' - max(measured_at_utc)) / 3.6e9, 6) as age_hours,
  coalesce(epoch_us(timestamp '2026-07-02 00:00:00' - max(measured_at_utc)) / 3.6e9 <= 48, false) as passed from int_measurements_deduplicated""",
    "x25_recent_completeness": f"""
with {_STATIONS}, {_GRID}
select count(*) filter (where is_complete) as complete, count(*) as total, round(count(*) filter (where is_complete) / count(*), 6) as share,
  count(*) filter (where is_complete) / count(*) >= 0.9 as passed from completeness
where measurement_date > (select max(measurement_date) - 30 from completeness)""",
    "w01_source_precedence": """
select l_orderkey, l_linenumber, l_partkey, l_quantity from lineitem
qualify row_number() over (partition by l_orderkey, l_linenumber order by l_partkey % 2, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) = 1""",
    "o02_sorted_top": """
select station_id, measurement_date, daily_max_ugm3 from int_measurements_daily where pollutant_code = 'NO2' and daily_max_ugm3 is not null
order by daily_max_ugm3 desc, station_id, measurement_date limit 10""",
    "o04_tagged_union": """
select origin, source_name, pollutant_id, count(*) as rows from (
  select 'fact' as origin, source_name, pollutant_id from int_measurements_deduplicated union all select 'feed', null, pollutant_id from stg_arpae__measurements) group by all""",
}
