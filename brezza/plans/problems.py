"""The queries of the general data problems 1 to 6 and the SQL that they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brezza.functions.temporal import cell_text, day_number, day_text, instant_text
from brezza.functions.texts import number_of, plain_unit, rest_after_number, unit_in_title
from brezza.operators import history, regular_grid, relational, spikes, timestamps, trailing, units
from brezza.operators.checkpoints import shared_checkpoint
from brezza.sources.tables import table

SERIES = ["station_id", "pollutant_id"]
PERIODS = (7, 30)
LOCAL_OFFSET_MINUTES = 60
COUNTER_GAP_PERIODS = 72
STATION_ATTRIBUTES = ["station_name", "municipality", "province", "address", "altitude_m", "longitude", "latitude", "pollutant_name", "unit_original"]

Query = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, directory: str) -> DataFrame:
    facts = table(spark, directory, "int_measurements_deduplicated")
    empty = trailing.trailing_totals(facts, SERIES, "measurement_date", "concentration_ugm3", F.col("is_valid"), PERIODS, valid_bounds=True, empty_only=True)
    return empty.select(*SERIES, day_text(F.col("day")).alias("day"), "period_days")


def p1_rolling(spark: SparkSession, directory: str) -> DataFrame:
    facts = table(spark, directory, "int_measurements_deduplicated")
    totals = trailing.trailing_totals(facts, SERIES, "measurement_date", "concentration_ugm3", F.col("is_valid"), PERIODS)
    return totals.select(*SERIES, "day", "period_days", F.round("total", 6).alias("total_ugm3"), F.round("mean", 6).alias("mean_ugm3"), "readings")


def _latest_feed(spark: SparkSession, directory: str) -> DataFrame:
    """``station_id, pollutant_id, measured_at_utc, concentration_ugm3``: the latest delivery of each reading, in ug/m3 from whatever unit it states; null where there is none."""
    feed = table(spark, directory, "stg_arpae__measurements")
    key = [*SERIES, "measured_at_utc"]
    latest = relational.latest_per_key(feed.select(*key, "concentration_ugm3", "value_original", "unit_original", F.struct("ingested_at", "row_id").alias("_at")), key, "_at")
    conversions = units.conversion_table(table(spark, directory, "arpae_pollutants"), "pollutant_id", "ug_per_ppb")
    stated = latest.withColumn("_unit", units.stated_unit(F.col("unit_original")))
    converted = units.convert(stated, "pollutant_id", "_unit", "value_original", conversions, [*key, "concentration_ugm3"])
    return converted.select(*key, F.coalesce("concentration_ugm3", "converted").alias("concentration_ugm3"))


def p1_corrected(spark: SparkSession, directory: str) -> DataFrame:
    """Trailing totals after the readings of the newest feed arrive as late corrections of the fact's forest.

    Of several deliveries of a reading the latest holds, also against the fact's own.  Readings that are null, negative, above the
    largest plausible value, or in a unit that cannot be converted correct nothing by themselves, but still replace earlier ones.
    """
    facts = table(spark, directory, "int_measurements_deduplicated")
    # The forest as it would be stored between the loads.
    forest = shared_checkpoint(trailing.build_forest(trailing.day_leaves(facts, SERIES, "measurement_date", "concentration_ugm3", F.col("is_valid")), SERIES))
    feed = _latest_feed(spark, directory)
    bounds = table(spark, directory, "arpae_pollutants").groupBy("pollutant_id").agg(F.max("max_plausible_ugm3").alias("largest"))
    value = F.col("concentration_ugm3")
    valid = value.isNotNull() & ~F.coalesce(spikes.impossible(value, F.col("largest")), F.lit(False))
    local_day = F.to_date(F.col("measured_at_utc") + F.expr("interval 1 hour"))
    added = feed.join(bounds, "pollutant_id", "left").where(valid).select(*SERIES, day_number(local_day).alias("day_no"), value.alias("change"), F.lit(1).alias("readings"))
    replaced = facts.where("is_valid").join(feed.select(*SERIES, "measured_at_utc"), [*SERIES, "measured_at_utc"], "left_semi")
    removed = replaced.select(*SERIES, day_number(F.col("measurement_date")).alias("day_no"), (-value).alias("change"), F.lit(-1).alias("readings"))
    late = added.unionByName(removed).groupBy(*SERIES, "day_no").agg(F.sum("change").alias("sum_change"), F.sum("readings").alias("count_change"))
    totals = trailing.query_forest(trailing.correct_forest(forest, late, SERIES), SERIES, PERIODS)
    return totals.select(*SERIES, "day", "period_days", F.round("total", 4).alias("total_ugm3"), "readings")


def _feed_slots(spark: SparkSession, directory: str) -> DataFrame:
    """The feed with the averaging period of its pollutants; rows of pollutants that have none fill no slot and are left out."""
    feed = table(spark, directory, "stg_arpae__measurements")
    periods = table(spark, directory, "arpae_pollutants").where("averaging_minutes > 0").groupBy("pollutant_id").agg(F.min("averaging_minutes").alias("averaging_minutes"))
    return feed.join(periods, "pollutant_id")


def p2_found(spark: SparkSession, directory: str) -> DataFrame:
    filled = _feed_slots(spark, directory).where(F.col("value_original").isNotNull())
    readings = regular_grid.instant_intervals(filled, SERIES, "measured_at_utc", F.lit(1.0), F.col("averaging_minutes"))
    empty = regular_grid.uncovered_cells(regular_grid.spread_on_grid(readings, SERIES, LOCAL_OFFSET_MINUTES), SERIES)
    return empty.select(*SERIES, cell_text(F.col("cell"), F.col("minutes"), LOCAL_OFFSET_MINUTES).alias("slot"))


def p2_series(spark: SparkSession, directory: str) -> DataFrame:
    """The whole regular series: readings and their sum per slot, empty slots marked."""
    readings = regular_grid.instant_intervals(_feed_slots(spark, directory), SERIES, "measured_at_utc", F.col("value_original"), F.col("averaging_minutes"))
    series = regular_grid.regular_series(readings, SERIES, LOCAL_OFFSET_MINUTES)
    return series.select(*SERIES, "slot", F.round("amount", 6).alias("amount"), F.col("intervals").alias("readings"), "is_empty")


def p2_counter(spark: SparkSession, directory: str) -> DataFrame:
    """The feed's values taken as a cumulative counter that restarts wherever they fall: increments per slot, and how far each slot is covered.

    ``coverage`` is ``none`` (no interval, null amount), ``part`` or ``whole``.  Readings more than ``COUNTER_GAP_PERIODS`` averaging
    periods apart leave the time between them uncovered.  Intervals do not overlap, so that the covered minutes add up.
    """
    readings = _feed_slots(spark, directory)
    gap = F.col("averaging_minutes") * COUNTER_GAP_PERIODS
    intervals = regular_grid.counter_intervals(readings, SERIES, "measured_at_utc", "value_original", F.col("averaging_minutes"), gap)
    cells = regular_grid.spread_on_grid(intervals, SERIES, LOCAL_OFFSET_MINUTES)
    covered = F.round("covered_minutes", 6)
    filled = cells.select(*SERIES, "cell", F.round("amount", 7).alias("amount"), covered.alias("covered_minutes"), "intervals", F.when(covered < F.col("minutes"), "part").otherwise("whole").alias("coverage"))
    empty = regular_grid.uncovered_cells(cells, SERIES).select(
        *SERIES, "cell", F.lit(None).cast("double").alias("amount"), F.lit(0.0).alias("covered_minutes"), F.lit(0).cast("bigint").alias("intervals"), F.lit("none").alias("coverage")
    )
    return filled.unionByName(empty)


def p3_found(spark: SparkSession, directory: str) -> DataFrame:
    feeds = table(spark, directory, "feed_clock")
    rest = table(spark, directory, "measurement_record")
    rows = table(spark, directory, "csv_row")
    file_row = F.concat_ws("#", "file_name", F.col("row_no").cast("string"))
    texts = rest.select(F.col("_id").alias("record_key"), F.lit("reftime").alias("field_name"), "feed_id", F.col("reftime").alias("text"))
    both = F.array(*(F.struct(F.lit(c).alias("field_name"), F.col(c).alias("text")) for c in ("data_inizio", "data_fine")))
    texts = texts.unionByName(rows.select(file_row.alias("record_key"), "feed_id", F.inline(both)))
    read = timestamps.normalise_timestamps(texts, "text", "feed_id", feeds, ["record_key", "field_name"])
    return read.where(F.col("status") == "ok").select("record_key", "field_name", "utc_us").distinct()


def p3_feed(spark: SparkSession, directory: str) -> DataFrame:
    """The instants of the newest feed, read from its texts alone."""
    feed = table(spark, directory, "stg_arpae__measurements").select("row_id", F.lit("arc").alias("feed_id"), "raw_reftime")
    read = timestamps.normalise_timestamps(feed, "raw_reftime", "feed_id", table(spark, directory, "feed_clock"), ["row_id"])
    return read.select("row_id", "utc_us", "status")


def _bounded_facts(spark: SparkSession, directory: str) -> DataFrame:
    facts = table(spark, directory, "int_measurements_deduplicated")
    bounds = table(spark, directory, "arpae_pollutants").groupBy("pollutant_id").agg(F.max("max_plausible_ugm3").alias("largest"))
    return facts.join(bounds, "pollutant_id", "left")


def p4_found(spark: SparkSession, directory: str) -> DataFrame:
    flagged = spikes.flag_readings(_bounded_facts(spark, directory), SERIES, "measured_at_utc", "concentration_ugm3", "largest", "averaging_minutes")
    return flagged.select(*SERIES, instant_text(F.col("measured_at_utc")).alias("measured_at")).distinct()


def p4_impossible(spark: SparkSession, directory: str) -> DataFrame:
    flagged = spikes.impossible_readings(_bounded_facts(spark, directory), SERIES, "measured_at_utc", "concentration_ugm3", "largest")
    return flagged.select(*SERIES, instant_text(F.col("measured_at_utc")).alias("measured_at"), "concentration_ugm3")


def _unit_records(spark: SparkSession, directory: str) -> list[DataFrame]:
    """``src, record_key, converted, status`` of the three kinds of record."""
    pollutants = table(spark, directory, "arpae_pollutants")
    by_code = units.conversion_table(pollutants, "archive_parameter_id", "ug_per_ppb")
    by_id = units.conversion_table(pollutants, "pollutant_id", "ug_per_ppb")
    rest = table(spark, directory, "measurement_record").select(
        F.col("_id").alias("record_key"), F.col("parameter_id").alias("quantity"), "value", units.stated_unit(F.col("parameter_unit"), plain_unit(unit_in_title(F.col("series_name")))).alias("unit")
    )
    rows = table(spark, directory, "csv_row").select(
        F.concat_ws("#", "file_name", F.col("row_no").cast("string")).alias("record_key"),
        F.col("id_param").alias("quantity"),
        number_of(F.col("valore")).alias("value"),
        units.stated_unit(F.col("um"), plain_unit(rest_after_number(F.col("valore")))).alias("unit"),
    )
    feed = (
        table(spark, directory, "stg_arpae__measurements")
        .where(F.col("concentration_ugm3").isNull())
        .select(F.col("row_id").cast("string").alias("record_key"), F.col("pollutant_id").alias("quantity"), F.col("value_original").alias("value"), units.stated_unit(F.col("unit_original")).alias("unit"))
    )
    parts = [("rest", rest, by_code), ("csv", rows, by_id), ("stg", feed, by_id)]
    return [units.convert(records.withColumn("src", F.lit(src)), "quantity", "unit", "value", conversions, ["src", "record_key"]) for src, records, conversions in parts]


def p5_found(spark: SparkSession, directory: str) -> DataFrame:
    found = [part.where("status = 'ok'").select("src", "record_key", F.round(F.col("converted") * 1000).cast("bigint").alias("ng_m3")) for part in _unit_records(spark, directory)]
    # The feed's row_id is unique; the other two deliver some records twice.
    return found[0].unionByName(found[1]).distinct().unionByName(found[2])


def p5_statuses(spark: SparkSession, directory: str) -> DataFrame:
    """What came of the records of each kind: how many, by status."""
    rest, rows, feed = _unit_records(spark, directory)
    return rest.unionByName(rows).unionByName(feed).groupBy("src", "status").agg(F.count(F.lit(1)).alias("records"))


def p5_temperatures(spark: SparkSession, directory: str) -> DataFrame:
    """Conversions with a shift: the customers' balances taken as temperatures, in Fahrenheit, kelvin or Celsius by nation, all brought to Celsius."""
    scale = F.pmod(F.col("c_nationkey"), F.lit(4))
    unit = F.when(scale == 0, "°F").when(scale == 1, "K").when(scale == 2, " °C ").otherwise("degF")
    readings = table(spark, directory, "customer").select("c_custkey", F.lit("temperature").alias("quantity"), F.col("c_acctbal").cast("double").alias("value"), plain_unit(unit).alias("unit"))
    quantities = spark.range(1).select(F.lit("temperature").alias("quantity"), F.lit(None).cast("double").alias("per"))
    conversions = units.conversion_table(quantities, "quantity", "per", ["degC"])
    converted = units.convert(readings, "quantity", "unit", "value", conversions, ["c_custkey"], F.lit("degC"))
    return converted.select("c_custkey", F.round("converted", 6).alias("degrees_c"), "status")


def _station_versions(spark: SparkSession, directory: str) -> DataFrame:
    earlier = table(spark, directory, "snap_arpae__stations").withColumnsRenamed({"dbt_valid_from": "valid_from", "dbt_valid_to": "valid_to"})
    return history.snapshot_versions(table(spark, directory, "stg_arpae__stations"), SERIES, STATION_ATTRIBUTES, "extracted_on", "loaded_at", earlier)


def p6_found(spark: SparkSession, directory: str) -> DataFrame:
    versions = _station_versions(spark, directory)
    return versions.select(*SERIES, day_text(F.col("valid_from")).alias("valid_from"), F.coalesce(day_text(F.col("valid_to")), F.lit("")).alias("valid_to")).distinct()


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (p1_found, p1_rolling, p1_corrected, p2_found, p2_series, p2_counter, p3_found, p3_feed, p4_found, p4_impossible, p5_found, p5_statuses, p5_temperatures, p6_found)
}

_P1_GRID = """
bounds as (select station_id, pollutant_id, min(measurement_date) as a, max(measurement_date) as z from chosen group by all),
grid as (select station_id, pollutant_id, cast(unnest(generate_series(a, z, interval 1 day)) as date) as day from bounds),
periods as (select unnest([7, 30])::integer as period_days),
daily as (select station_id, pollutant_id, measurement_date, sum(concentration_ugm3) as s, count(*) as c from valid group by all),
totals as (
  select g.station_id, g.pollutant_id, g.day, p.period_days, sum(d.s) as s, coalesce(sum(d.c), 0)::bigint as c
  from grid g cross join periods p
  left join daily d on d.station_id = g.station_id and d.pollutant_id = g.pollutant_id
    and d.measurement_date between g.day - p.period_days + 1 and g.day
  group by all)
"""

_SLOTS = """
slotted as (
  select m.station_id, m.pollutant_id, m.value_original, p.averaging_minutes,
    case when p.averaging_minutes = 60 then date_trunc('hour', m.measured_at_utc)
      else date_trunc('day', m.measured_at_utc + interval 1 hour) - interval 1 hour end as slot
  from stg_arpae__measurements m join arpae_pollutants p using (pollutant_id)
  where m.value_original is not null),
filled as (select distinct station_id, pollutant_id, averaging_minutes, slot from slotted),
spans as (select station_id, pollutant_id, averaging_minutes, min(slot) as a, max(slot) as z from filled group by all),
grid as (select station_id, pollutant_id, unnest(generate_series(a, z, to_minutes(averaging_minutes))) as slot from spans)
"""

_UNIT = """replace(replace(replace(replace(replace(replace(replace(replace(lower({0}), '&micro;', 'u'), '&sup3;', '3'), 'µ', 'u'), 'μ', 'u'), '³', '3'), '⁻', '-'), '·', ''), ' ', '')"""
_FACTORS = """
factors(spelling, kind, factor) as (values
  ('ug/m3', 'mass', 1.0), ('mcg/m3', 'mass', 1.0), ('ugm-3', 'mass', 1.0), ('microg/m3', 'mass', 1.0), ('ug/mc', 'mass', 1.0),
  ('mg/m3', 'mass', 1000.0), ('mgm-3', 'mass', 1000.0), ('mg/mc', 'mass', 1000.0), ('ug/l', 'mass', 1000.0), ('ug/dm3', 'mass', 1000.0),
  ('ng/m3', 'mass', 0.001), ('ngm-3', 'mass', 0.001), ('g/m3', 'mass', 1000000.0),
  ('ppb', 'ratio', 1.0), ('ppbv', 'ratio', 1.0), ('nmol/mol', 'ratio', 1.0), ('partsperbillion', 'ratio', 1.0),
  ('ppm', 'ratio', 1000.0), ('ppmv', 'ratio', 1000.0), ('umol/mol', 'ratio', 1000.0))
"""

_UNIT_RECORDS = """
records as (
  select 'rest' as src, _id as record_key, p.pollutant_id as quantity, p.ug_per_ppb, r.value,
    case when trim(coalesce(parameter_unit, '')) in ('', '-', 'n.d.')
      then coalesce(nullif(regexp_extract(series_name, '[(\\[]([^()\\[\\]]+)[)\\]]$', 1), ''), nullif(regexp_extract(series_name, ' - (.+)$', 1), ''), nullif(regexp_extract(series_name, ' in (.+)$', 1), ''))
      else parameter_unit end as unit
  from measurement_record r left join arpae_pollutants p on p.archive_parameter_id = r.parameter_id
  union all
  select 'csv', file_name || '#' || row_no, p.pollutant_id, p.ug_per_ppb,
    try_cast(case when n like '%,%' then replace(replace(n, '.', ''), ',', '.') else n end as double),
    case when trim(coalesce(um, '')) in ('', '-', 'n.d.') then trim(regexp_extract(valore, '^\\s*[0-9.,]+(?:[eE][+-]?[0-9]+)?\\s*\\[?([^\\]]*)\\]?', 1)) else um end
  from (select *, regexp_extract(trim(valore), '^[+-]?[0-9.,]+(?:[eE][+-]?[0-9]+)?') as n from csv_row) c left join arpae_pollutants p on p.pollutant_id = c.id_param
  union all
  select 'stg', cast(row_id as varchar), p.pollutant_id, p.ug_per_ppb, value_original, unit_original
  from stg_arpae__measurements m left join arpae_pollutants p using (pollutant_id) where concentration_ugm3 is null)
"""

STATION_HISTORY = """
with days as (select day, row_number() over (order by day) as k from (select distinct extracted_on as day from stg_arpae__stations)),
tidy as (
  select station_id, pollutant_id, extracted_on, loaded_at, dbt_from, station_name, altitude_m,
    [coalesce('1' || regexp_replace(lower(station_name), '[\\s\\x{{00a0}}]+', '', 'g'), '0'), coalesce('1' || regexp_replace(lower(municipality), '[\\s\\x{{00a0}}]+', '', 'g'), '0'),
     coalesce('1' || regexp_replace(lower(province), '[\\s\\x{{00a0}}]+', '', 'g'), '0'), coalesce('1' || regexp_replace(lower(address), '[\\s\\x{{00a0}}]+', '', 'g'), '0'),
     coalesce('1' || regexp_replace(lower(pollutant_name), '[\\s\\x{{00a0}}]+', '', 'g'), '0'), coalesce('1' || regexp_replace(lower(unit_original), '[\\s\\x{{00a0}}]+', '', 'g'), '0'),
     coalesce('1' || round(altitude_m, 6), '0'), coalesce('1' || round(longitude, 6), '0'), coalesce('1' || round(latitude, 6), '0')] as attributes
  from (
    select *, null::date as dbt_from from stg_arpae__stations
    union all by name
    select * exclude (dbt_valid_from, dbt_valid_to), dbt_valid_from as dbt_from, null::date as extracted_on, null::timestamp as loaded_at from snap_arpae__stations where dbt_valid_to is null)),
held as (
  select station_id, pollutant_id, coalesce(k, 0) as k, coalesce(dbt_from, extracted_on) as since, attributes, station_name, altitude_m
  from tidy left join days on day = extracted_on
  qualify row_number() over (partition by station_id, pollutant_id, coalesce(k, 0) order by loaded_at desc nulls last, attributes desc) = 1),
marked as (
  select *, case when attributes = lag(attributes) over w and k = lag(k) over w + 1 then 0 else 1 end as new
  from held window w as (partition by station_id, pollutant_id order by k)),
islands as (select *, sum(new) over (partition by station_id, pollutant_id order by k) as island from marked),
versions as (select station_id, pollutant_id, min(since) as valid_from, max(k) as last, arg_max(struct_pack(n := station_name), k).n as station_name, arg_max(struct_pack(a := altitude_m), k).a as altitude_m from islands group by station_id, pollutant_id, island)
select distinct {columns}
from versions left join days on days.k = versions.last + 1
union
select {closed} from snap_arpae__stations where dbt_valid_to is not null"""

ORACLES: dict[str, str] = {
    "p1_found": f"""
with chosen as (select * from int_measurements_deduplicated where is_valid), valid as (select * from chosen), {_P1_GRID}
select station_id, pollutant_id, strftime(day, '%Y-%m-%d') as day, period_days from totals where c = 0""",
    "p1_rolling": f"""
with chosen as (select * from int_measurements_deduplicated), valid as (select * from chosen where is_valid), {_P1_GRID}
select station_id, pollutant_id, day, period_days, round(s, 6) as total_ugm3, round(s / nullif(c, 0), 6) as mean_ugm3, c as readings from totals""",
    "p1_corrected": f"""
with {_FACTORS},
limits as (select pollutant_id, max(max_plausible_ugm3) as largest, min(ug_per_ppb) as ug_per_ppb from arpae_pollutants group by all),
latest as (
  select station_id, pollutant_id, measured_at_utc, largest, coalesce(concentration_ugm3, value_original * factor * case when kind = 'ratio' then ug_per_ppb else 1 end) as concentration_ugm3
  from stg_arpae__measurements left join limits using (pollutant_id) left join factors on spelling = {_UNIT.format("unit_original")}
  qualify row_number() over (partition by station_id, pollutant_id, measured_at_utc order by ingested_at desc, row_id desc) = 1),
chosen as (
  select station_id, pollutant_id, measurement_date, concentration_ugm3, is_valid and k.measured_at_utc is null as is_valid
  from int_measurements_deduplicated f left join (select station_id, pollutant_id, measured_at_utc from latest) k using (station_id, pollutant_id, measured_at_utc) union all
  select station_id, pollutant_id, cast(measured_at_utc + interval 1 hour as date), concentration_ugm3, true
  from latest where concentration_ugm3 >= 0 and (largest is null or concentration_ugm3 <= largest)),
valid as (select * from chosen where is_valid), {_P1_GRID}
select station_id, pollutant_id, day, period_days, round(s, 4) as total_ugm3, c as readings from totals""",
    "p2_found": f"""
with {_SLOTS}
select station_id, pollutant_id, strftime(slot, '%Y-%m-%d %H:%M:%S') as slot from grid g anti join filled f using (station_id, pollutant_id, slot)""",
    "p2_series": f"""
with {_SLOTS},
sums as (select station_id, pollutant_id, slot, sum(value_original) as s, count(*) as n from slotted group by all)
select g.station_id, g.pollutant_id, g.slot, round(s.s, 6) as amount, coalesce(s.n, 0)::bigint as readings, s.n is null as is_empty
from grid g left join sums s using (station_id, pollutant_id, slot)""",
    "p2_counter": """
with readings as (
  select m.station_id, m.pollutant_id, p.averaging_minutes * 60000000::bigint as len, epoch_us(m.measured_at_utc) as t, max(m.value_original) as v
  from stg_arpae__measurements m join arpae_pollutants p using (pollutant_id) where m.value_original is not null group by all),
pairs as (select *, lag(t) over w as t0, lag(v) over w as v0 from readings window w as (partition by station_id, pollutant_id order by t)),
intervals as (select station_id, pollutant_id, len, t0, t, case when v < v0 then v else v - v0 end as inc from pairs where t - t0 <= 72 * len),
touched as (select *, unnest(generate_series((t0 + 3600000000) // len, (t - 1 + 3600000000) // len)) as cell from intervals),
cells as (
  select station_id, pollutant_id, len, cell::bigint as cell,
    round(sum(inc * (least(t, (cell + 1) * len - 3600000000) - greatest(t0, cell * len - 3600000000)) / (t - t0)), 7) as amount,
    round(sum((least(t, (cell + 1) * len - 3600000000) - greatest(t0, cell * len - 3600000000)) / 60000000.0), 6) as covered_minutes, count(*) as intervals
  from touched group by all),
spans as (select station_id, pollutant_id, min(cell) as a, max(cell) as z from cells group by all),
grid as (select station_id, pollutant_id, unnest(generate_series(a, z)) as cell from spans)
select station_id, pollutant_id, cell::bigint as cell, amount, coalesce(covered_minutes, 0.0) as covered_minutes, coalesce(intervals, 0)::bigint as intervals,
  case when intervals is null then 'none' when covered_minutes < len / 60000000 then 'part' else 'whole' end as coverage
from grid g left join cells c using (station_id, pollutant_id, cell)""",
    "p3_feed": "select row_id, epoch_us(measured_at_utc) as utc_us, 'ok' as status from stg_arpae__measurements",
    "p4_impossible": """
select m.station_id, m.pollutant_id, strftime(m.measured_at_utc, '%Y-%m-%d %H:%M:%S') as measured_at, m.concentration_ugm3
from int_measurements_deduplicated m left join arpae_pollutants p using (pollutant_id)
where m.concentration_ugm3 < 0 or m.concentration_ugm3 > p.max_plausible_ugm3""",
    "p5_found": f"""
with {_FACTORS}, {_UNIT_RECORDS}
select distinct src, record_key, cast(round(value * factor * case when kind = 'ratio' then ug_per_ppb else 1 end * 1000) as bigint) as ng_m3
from records join factors on spelling = {_UNIT.format("unit")}
where value is not null and quantity is not null and (kind = 'mass' or ug_per_ppb is not null)""",
    "p5_statuses": f"""
with {_FACTORS}, {_UNIT_RECORDS}
select src, case when value is null then 'no_value' when unit is null or trim(unit) in ('', '-', 'n.d.') then 'no_unit' when kind is null then 'unknown_unit'
    when quantity is null or (kind = 'ratio' and ug_per_ppb is null) then 'no_way' else 'ok' end as status, count(*) as records
from records left join factors on spelling = {_UNIT.format("unit")} group by all""",
    "p5_temperatures": """
select c_custkey, round(case c_nationkey % 4 when 1 then c_acctbal::double - 273.15 when 2 then c_acctbal::double else (c_acctbal::double - 32) / 1.8 end, 6) as degrees_c, 'ok' as status from customer""",
    "p6_found": STATION_HISTORY.format(
        columns="station_id, pollutant_id, strftime(valid_from, '%Y-%m-%d') as valid_from, coalesce(strftime(day, '%Y-%m-%d'), '') as valid_to",
        closed="station_id, pollutant_id, strftime(dbt_valid_from, '%Y-%m-%d'), strftime(dbt_valid_to, '%Y-%m-%d')",
    ),
    "p3_found": """
with zones(z, m) as (values ('Z', 0), ('UTC', 0), ('GMT', 0), ('BST', 60), ('CET', 60), ('CEST', 120), ('EET', 120), ('EEST', 180)),
texts as (
  select _id as record_key, 'reftime' as field_name, feed_id, reftime as text from measurement_record
  union all select file_name || '#' || row_no, 'data_inizio', feed_id, data_inizio from csv_row
  union all select file_name || '#' || row_no, 'data_fine', feed_id, data_fine from csv_row),
plain as (
  select record_key, field_name, clock, date_order, trim(text) as t,
    regexp_extract(trim(text), '(?:^|[0-9]) ?((?:[+-][0-9]{2}(?::?[0-9]{2})?)|Z|z|UTC|GMT|BST|CET|CEST|EET|EEST)$', 1) as zone
  from texts left join feed_clock using (feed_id)),
based as (
  select *, regexp_replace(lower(trim(t[1:length(t) - length(zone)])), '^[a-z]+, ', '') as b0 from plain where not regexp_full_match(t, '[0-9]{10}|[0-9]{13}')),
english as (
  select *, replace(replace(replace(replace(replace(replace(replace(replace(b0, ' gen ', ' jan '), ' mag ', ' may '), ' giu ', ' jun '), ' lug ', ' jul '), ' ago ', ' aug '), ' set ', ' sep '), ' ott ', ' oct '), ' dic ', ' dec ') as b1 from based),
ended as (select *, regexp_matches(b1, '[ t]24(:00)*$') as late, regexp_replace(b1, '([ t])24((:00)*)$', '\\1' || '00' || '\\2') as b from english),
read as (
  select *, coalesce(
    try_strptime(b, ['%Y-%m-%dt%H:%M:%S.%f', '%Y-%m-%dt%H:%M:%S', '%Y-%m-%dt%H:%M', '%Y-%m-%d %H:%M:%S.%f', '%Y-%m-%d %H:%M:%S', '%Y-%m-%d %H:%M', '%Y%m%dt%H%M%S', '%d %b %Y, %H:%M:%S', '%d %b %Y %H:%M:%S', '%d %b %Y %H:%M']),
    case when date_order = 'mdy'
      then try_strptime(b, ['%m/%d/%Y %I:%M:%S %p', '%m/%d/%Y %H:%M:%S', '%m/%d/%Y %H:%M', '%m/%d/%Y %H', '%m-%d-%Y %H.%M', '%m.%d.%y %H:%M'])
      else try_strptime(b, ['%d/%m/%Y %I:%M:%S %p', '%d/%m/%Y %H:%M:%S', '%d/%m/%Y %H:%M', '%d/%m/%Y %H', '%d-%m-%Y %H.%M', '%d.%m.%y %H:%M']) end)
    + case when late then interval 1 day else interval 0 day end as local
  from ended),
timed as (
  select record_key, field_name, local, zone,
    case when zone ~ '^[+-]' then case when zone[1] = '-' then -1 else 1 end * (cast(zone[2:3] as int) * 60 + coalesce(try_cast(right(replace(zone, ':', ''), 2) as int), 0) * case when length(zone) > 3 then 1 else 0 end) else z.m end as stated,
    case clock when '+01:00' then 60 when 'Europe/Rome' then 60 when 'Europe/Sofia' then 120 when 'Europe/London' then 0 when 'UTC' then 0 end as base, clock like 'Europe/%' as shifts
  from read left join zones z on z.z = upper(zone) where local is not null),
candidates as (
  select record_key, field_name, local - to_minutes(stated) as u, true as ok from timed where zone <> ''
  union all select record_key, field_name, local - to_minutes(base), not shifts or not (local - to_minutes(base) >= make_date(year(local), 3, 31) - cast(dayofweek(make_date(year(local), 3, 31)) as int) + interval 1 hour
    and local - to_minutes(base) < make_date(year(local), 10, 31) - cast(dayofweek(make_date(year(local), 10, 31)) as int) + interval 1 hour) from timed where zone = ''
  union all select record_key, field_name, local - to_minutes(base + 60), local - to_minutes(base + 60) >= make_date(year(local), 3, 31) - cast(dayofweek(make_date(year(local), 3, 31)) as int) + interval 1 hour
    and local - to_minutes(base + 60) < make_date(year(local), 10, 31) - cast(dayofweek(make_date(year(local), 10, 31)) as int) + interval 1 hour from timed where zone = '' and shifts)
select record_key, field_name, epoch_us(min(u)) as utc_us from (select distinct * from candidates where ok) group by record_key, field_name having count(*) = 1
union
select record_key, field_name, cast(case when length(t) = 10 then t || '000000' else t || '000' end as bigint) from plain where regexp_full_match(t, '[0-9]{10}|[0-9]{13}')""",
}
