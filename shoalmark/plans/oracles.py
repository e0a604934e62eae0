"""The registered queries in DuckDB's SQL, written on their own and as plainly as can be."""

from __future__ import annotations

from shoalmark.plans.fixtures import with_views

_NAMES = "lower(trim(species))"


def _uniform(tag: str) -> str:
    digits = f"substr(md5('42:{tag}:' || occ_id || ':' || draw), 1, 8)"
    return f"cast('0x' || {digits} as ubigint) / 4294967296e0"


_BOX = """box as (select min(decimalLatitude) as min_lat, max(decimalLatitude) as max_lat,
  min(decimalLongitude) as min_lon, max(decimalLongitude) as max_lon from {t})"""

_ABSENCES = f"""
select species, occ_id, draw, min_lat + {_uniform('lat')} * (max_lat - min_lat) as decimalLatitude,
  min_lon + {_uniform('lon')} * (max_lon - min_lon) as decimalLongitude
from (select *, unnest(range(1, {{ratio}} + 1))::int as draw from {{t}}) cross join box"""

# Brute force: every occurrence against every coordinate.
_ORDER = "time nulls last, depth, temperature_C, salinity_PSU"
_NEAREST = f"""
dated as (select *, try_cast(eventDate as timestamp) as event_time from occ),
reps_all as (select * from ocean qualify row_number() over (
  partition by latitude, longitude order by {_ORDER}) = 1),
reps_year as (select *, year(time) as y from ocean qualify row_number() over (
  partition by latitude, longitude, year(time) order by {_ORDER}) = 1),
overall as (select occ_id, min({{{{'d2': (decimalLatitude - latitude) * (decimalLatitude - latitude)
    + (decimalLongitude - longitude) * (decimalLongitude - longitude), 'la': latitude, 'lo': longitude,
    'temperature_C': temperature_C, 'salinity_PSU': salinity_PSU, 'depth': depth, 'ocean_time': time}}}}) as hit
  from dated cross join reps_all group by occ_id),
filled as (select dated.*, overall.hit, year(coalesce(event_time, overall.hit.ocean_time)) as y
  from dated join overall using (occ_id)),
in_year as (select occ_id, min({{{{'d2': (decimalLatitude - latitude) * (decimalLatitude - latitude)
    + (decimalLongitude - longitude) * (decimalLongitude - longitude), 'la': latitude, 'lo': longitude,
    'temperature_C': reps_year.temperature_C, 'salinity_PSU': reps_year.salinity_PSU,
    'depth': reps_year.depth, 'ocean_time': reps_year.time}}}}) as hit
  from filled join reps_year using (y) group by occ_id)""".replace("{{", "{").replace("}}", "}")

_MATCHED = ("best.temperature_C as temperature_C, best.salinity_PSU as salinity_PSU, "
            "best.depth as depth, best.ocean_time as ocean_time")

_SPLIT = """
hashed as (select *, md5('42:split:' || {key}) as hash from {t}),
sizes as (select {by}{label}, count(*) as n from hashed group by all),
totals as (select *, sum(n) over ({group}) as total from sizes),
shares as (select *, cast(ceil(0.3e0 * total) as bigint) as n_test from totals),
parts as (select *, (n_test * n) // total as whole, (n_test * n) % total as rest from shares),
takes as (select *, whole + case when row_number() over ({group} order by rest desc, {label})
    <= n_test - sum(whole) over ({group}) then 1 else 0 end as take from parts),
placed as (select *, row_number() over (partition by {by}{label} order by hash, {key}) as place
  from hashed)
select placed.* exclude (hash, place), case when total < 4 then 'both'
  when place <= take then 'test' else 'train' end as role
from placed join takes using ({by}{label})"""

_CELLS = """cells as (select
  count(*) filter (where label = 0 and prediction = 0)::double as c00,
  count(*) filter (where label = 0 and prediction = 1)::double as c01,
  count(*) filter (where label = 1 and prediction = 0)::double as c10,
  count(*) filter (where label = 1 and prediction = 1)::double as c11 from pred),
per_class as (
  select 'Absence' as name, c00 as hit, c00 + c10 as predicted, c00 + c01 as actual from cells
  union all
  select 'Presence', c11, c11 + c01, c11 + c10 from cells),
measures as (select name, case when predicted = 0 then 0 else hit / predicted end as precision,
  case when actual = 0 then 0 else hit / actual end as recall,
  case when predicted + actual = 0 then 0 else 2 * hit / (predicted + actual) end as f1,
  actual::bigint as support, hit from per_class),
lines as (
  select name, precision, recall, f1, support from measures
  union all
  select 'accuracy', null, null, sum(hit) / sum(support), sum(support)::bigint from measures
  union all
  select 'macro avg', avg(precision), avg(recall), avg(f1), sum(support)::bigint from measures
  union all
  select 'weighted avg', sum(precision * support) / sum(support),
    sum(recall * support) / sum(support), sum(f1 * support) / sum(support),
    sum(support)::bigint from measures)"""


def _counts(table: str, column: str) -> str:
    return with_views(table, f"select {column}, count(*) as n from {table} "
                             f"where {column} is not null group by {column}")


def _nearest(select: str) -> str:
    return with_views("occ ocean", "," + _NEAREST + "\n" + select)


def _training(name: str, with_environment: bool) -> str:
    mine = f"mine as (select * from fused where species = (select arg_min(species, occ_id) " \
           f"from fused where {_NAMES} = '{name}'))"
    present, absent = "", ""
    if with_environment:
        present = (", round(temperature_C, 9) as temperature, round(salinity_PSU, 9) as salinity")
        absent = (", (select round(avg(temperature_C), 9) from fused),"
                  " (select round(avg(salinity_PSU), 9) from fused)")
    return with_views("fused", f""", {_BOX.format(t='fused')}, {mine}
select species, occ_id, 0::int as draw, decimalLatitude, decimalLongitude{present}, 1::int as presence
from mine union all
select *{absent}, 0::int as presence from ({_ABSENCES.format(t='mine', ratio=1)})""")


def _slice_rows(where: str) -> str:
    return with_views("grid_slices", f"""
select time::timestamp as time, depth_idx, 8e0 + 0.25e0 * (k // 8) as latitude, 68e0 + 0.25e0 * (k % 8) as longitude,
  thetao[k + 1]::double as temperature_C, thetao[64 - k]::double as salinity_PSU
from grid_slices cross join (select unnest(range(64))::int as k) {where}""")


def _polygon() -> str:
    from shoalmark.plans.queries import AREA
    tests = []
    for (ax, ay), (bx, by) in zip(AREA, AREA[1:] + AREA[:1]):
        slope = (bx - ax) / (by - ay)
        tests.append(
            f"case when ({ay}e0 > decimalLatitude) <> ({by}e0 > decimalLatitude) and decimalLongitude"
            f" < {ax}e0 + (decimalLatitude - {ay}e0) * cast('{slope!r}' as double) then 1 else 0 end")
    return with_views("occ", "select occ_id, decimalLatitude, decimalLongitude from occ where ("
                      + "\n + ".join(tests) + ") % 2 = 1")


_ROLES = "with roles as (with " + _SPLIT.format(
    t=f"({_training('click', True)})", by="", group="", label="presence", key="occ_id || ':' || draw") + ")"

_CELLS_AT = with_views("occ ocean", f""", {_BOX.format(t='occ')},
cells as (select i_lat * 200 + i_lon as cell_id, min_lat + i_lat * (max_lat - min_lat) / 199e0 as la,
    min_lon + i_lon * (max_lon - min_lon) / 199e0 as lo
  from range(200) a(i_lat) cross join range(200) b(i_lon) cross join box),
reps as (select * from ocean qualify row_number() over (
  partition by latitude, longitude order by {_ORDER}) = 1),
best as (select cell_id, min({{'d2': (la - latitude) * (la - latitude) + (lo - longitude) * (lo - longitude),
    'la': latitude, 'lo': longitude, 't': temperature_C, 's': salinity_PSU}}) as hit
  from cells cross join reps group by cell_id)
""")

_EVERY_SPECIES = with_views("fused", f""",
named as (select * replace (lower(trim(species)) as species) from fused), {_BOX.format(t='named')},
every as (
  select species, occ_id, 0::int as draw, 1::int as presence from named union all
  select species, occ_id, draw, 0::int as presence from ({_ABSENCES.format(t='named', ratio=1)})),
""")

_PAGES = with_views("occ", """,
held as (
  select *, occ_id // 100 * 100 as page, 'first' as kind from occ where occ_id // 100 * 100 % 1100 <> 500
  union all
  select *, (occ_id - 50) // 100 * 100 + 50, 'half' from occ where occ_id >= 50 and (occ_id - 50) // 100 * 100 % 400 = 0
  union all
  select * replace (case when occ_id % 2 = 0 then upper(species) else species end as species),
    occ_id // 100 * 100 + 20, 'other' from occ where occ_id // 100 * 100 % 700 = 0 and occ_id % 100 between 20 and 79
  union all
  select *, (occ_id - 200) // 1300 * 1300 + 200, 'long' from occ where occ_id >= 200 and (occ_id - 200) % 1300 < 120),
pages as (select page, kind, count(*) as n, page + count(*) as page_end from held group by page, kind),
versions as (
  select occ_id, species, decimalLatitude, decimalLongitude, eventDate, min({'page': page, 'shorter': -n}) as first
  from held join pages using (page, kind) group by all),
numbered as (select *, row_number() over (partition by occ_id order by first) as version from versions),
swept as (
  select *, max(page_end) over (order by page, page_end desc rows between unbounded preceding and 1 preceding) as reach
  from pages),
clusters as (
  select *, sum(case when reach is null or page >= reach then 1 else 0 end) over (order by page, page_end desc
    rows unbounded preceding) as cluster from swept)
""")

ORACLES: dict[str, str] = {
    "landing_all": with_views("occ", """
select row_number() over (order by occ_id) - 1 as occ_id, * exclude (occ_id) from occ"""),
    "landing_limit": with_views("occ", """
select row_number() over (order by occ_id) - 1 as occ_id, * exclude (occ_id) from occ
order by 1 limit 750"""),
    "landing_half": with_views("occ", """
select * from occ qualify row_number() over (order by occ_id) <= (select count(*) // 2 from occ)"""),
    "landing_overlap": _PAGES + "select * exclude (first, version) from numbered where version = 1",
    "landing_conflicts": _PAGES + "select * exclude (first, version) from numbered where version > 1",
    "landing_audit": _PAGES + """
select page as "offset", page_end as "end", 'repeated' as problem, 1::bigint as n from pages
where kind = 'first' and page % 300 = 0
union all
select min(page), max(page_end), 'overlap', count(*) from clusters group by cluster having count(*) > 1
union all select page, page_end, 'oversize', n from pages where n > 100
union all select page, page_end, 'short', n from pages where n < 100 and page < (select max(page) from pages)
union all select coalesce(reach, 0), page, 'missing', page - coalesce(reach, 0) from swept where page > coalesce(reach, 0)""",
    "csv_roundtrip": with_views("occ_raw", "select * from occ_raw"),
    "ocean_by_year": with_views("ocean", """
select year(time)::int as year, count(*) as n, min(temperature_C) as min_temperature,
  max(salinity_PSU) as max_salinity from ocean group by 1"""),
    "ocean_partitioned_roundtrip": with_views("ocean", """
select * exclude (ocean_id), year(time)::int as year from ocean"""),
    "ocean_landing": with_views("ocean", """
select case when ocean_id % 53 <> 0 then time end as time, * exclude (ocean_id, time),
  case when ocean_id % 53 <> 0 then year(time)::int end as year from ocean"""),
    "ocean_landings": with_views("ocean", """
select (year(time) + (ocean_id % 41 = 0)::int)::int as file_year, count(*) as n_rows,
  count(*) filter (where ocean_id % 53 <> 0 and ocean_id % 41 = 0) as n_other_year,
  count(*) filter (where ocean_id % 53 = 0) as n_no_time from ocean group by 1"""),
    "missing_years": with_views("occ ocean", """
select distinct year(try_cast(eventDate as timestamp))::int as year from occ
where try_cast(eventDate as timestamp) is not null
  and year(try_cast(eventDate as timestamp)) not in (select year(time) from ocean)"""),
    "union_by_name": with_views("ocean", """
select ocean_id, year(time)::int as year, temperature_C,
  case when year(time) >= 1998 then salinity_PSU end as salinity_PSU from ocean"""),
    "species_partitioned_roundtrip": with_views("fused", """
select replace(regexp_replace(species, '[^\\p{L}\\p{N} _]', '', 'g'), ' ', '_') as species_key,
  count(*) as n, min(occ_id) as first_id, max(occ_id) as last_id from fused group by 1"""),
    "summary_statistics": with_views("taxa", """
select 'num_records' as metric, count(*) as value from taxa
union all select 'num_species', count(distinct species) from taxa"""),
    "select_existing": with_views("taxa", """
select line_key, species, eventDate, phylum, taxon_class, taxon_order, family, genus from taxa"""),
    "normalise_names": with_views("occ_raw", f"select occ_id, {_NAMES} as name from occ_raw"),
    "species_key": with_views("taxa", """
select name, replace(regexp_replace(name, '[^\\p{L}\\p{N} _]', '', 'g'), ' ', '_') as species_key
from (select distinct species || ' (' || family || ', ' || genus || '.)' as name from taxa
  where species is not null)"""),
    "key_collisions": with_views("taxa", """
select family as species_key, count(distinct line_key % 2) as n_names from taxa
group by family having n_names > 1"""),
    "parse_event_date": with_views("occ", """
select occ_id, try_cast(eventDate as timestamp) as event_time from occ"""),
    "event_year": with_views("occ", """
select occ_id, year(try_cast(eventDate as timestamp))::int as year from occ
where try_cast(eventDate as timestamp) is not null"""),
    "grid_flatten": _slice_rows(""),
    "surface_layer": _slice_rows("where depth_idx = 0"),
    "ocean_rename": with_views("ocean", "select ocean_id, temperature_C, salinity_PSU from ocean"),
    "time_range": with_views("ocean", """
select * from ocean where time between timestamp '1997-01-01 00:00:00'
  and timestamp '1997-12-31 23:59:59'"""),
    "clean_occurrences": with_views("occ_raw", """
select * from occ_raw where species is not null and decimalLatitude is not null
  and decimalLongitude is not null"""),
    "cleaning_audit": with_views("occ_raw", """
select count(*) as rows_before, count(species || decimalLatitude || decimalLongitude) as rows_after,
  rows_before - rows_after as rows_removed from occ_raw"""),
    "region_filter": with_views("occ", """
select * from (select occ_id, decimalLatitude - 3e0 as decimalLatitude,
  decimalLongitude + 2e0 as decimalLongitude from occ)
where decimalLatitude >= 8 and decimalLatitude <= 37
  and decimalLongitude >= 68 and decimalLongitude <= 97"""),
    "polygon_filter": _polygon(),
    "region_join": with_views("occ areas", r""",
ring as (
  select region_id, ring_no, string_split(ring, ',') as corners from (
    select region_id, unnest(range(1, 1 + len(rings))) as ring_no, unnest(rings) as ring from (
      select region_id, regexp_extract_all(wkt, '\(([^()]+)\)', 1) as rings from areas where wkt like '%))'))),
corner as (
  select region_id, ring_no, place, cast(string_split(trim(corners[place]), ' ')[1] as double) as x,
    cast(string_split(trim(corners[place]), ' ')[2] as double) as y
  from (select *, unnest(range(1, 1 + len(corners))) as place from ring)),
edge as (
  select * from (select *, lead(x) over w as x2, lead(y) over w as y2 from corner
    window w as (partition by region_id, ring_no order by place)) where y2 <> y)
select occ_id, region_id from occ join edge
  on (y > decimalLatitude) <> (y2 > decimalLatitude) and decimalLongitude < x + (decimalLatitude - y) * ((x2 - x) / (y2 - y))
group by occ_id, region_id having count(*) % 2 = 1"""),
    "unreadable_regions": with_views("areas", "select * from areas where wkt is null or wkt not like '%))'"),
    "wkt_filter": with_views("occ", """
select * from (select occ_id, decimalLatitude - 3e0 as decimalLatitude, decimalLongitude + 2e0 as decimalLongitude from occ)
where decimalLatitude >= 8 and decimalLatitude < 37 and decimalLongitude >= 68 and decimalLongitude < 97"""),
    "species_lookup": with_views("occ_raw", f"""
select name, species, count(*) as n from occ_raw join (
  select {_NAMES} as name, arg_min(species, occ_id) as species from occ_raw
  where species is not null group by 1) using (species) group by all"""),
    "species_presence": with_views("occ_raw", f"""
select * from occ_raw where species = (
  select species from occ_raw where {_NAMES} = 'click' order by occ_id limit 1)"""),
    "species_exists": with_views("occ_raw taxa", f"""
select species, {_NAMES} as name, {_NAMES} in (
  select {_NAMES} from occ_raw where species is not null) as known
from (select species from occ_raw where species is not null union select phylum from taxa)"""),
    "species_gate": with_views("taxa", """
, records as (select concat_ws(' ', species, genus, family, phylum) as species from taxa),
names as (select species from records union select upper(species) from records),
counted as (select names.species, count(records.species) as n
  from names left join records using (species) group by names.species)
select species, n, case when n = 0 then 'empty' when n < 10 then 'low' else 'ok' end as status
from counted"""),
    "species_suggestions": with_views("taxa", """
select species from taxa where species is not null group by species
order by count(*) desc, species limit 5"""),
    "missing_dates": with_views("occ", """
select count(*) filter (where try_cast(eventDate as timestamp) is null) as n_missing from occ"""),
    "nearest_global": _nearest(f"""
select occ_id, sqrt(hit.d2) as distance, {_MATCHED.replace('best', 'hit')} from overall"""),
    "nearest_same_year": _nearest(f"""
select occ_id, y::int as year, sqrt(best.d2) as distance, {_MATCHED}
from (select f.occ_id, f.y, coalesce(i.hit, f.hit) as best from filled f left join in_year i using (occ_id)
  where f.event_time is not null)"""),
    "fuse": _nearest(f"""
select occ_id, species, decimalLatitude, decimalLongitude, coalesce(event_time, overall_time) as eventDate,
  {_MATCHED}, y::int as eventYear
from (select f.* exclude (hit), f.hit.ocean_time as overall_time, coalesce(i.hit, f.hit) as best
  from filled f left join in_year i using (occ_id) where f.y is not null)"""),
    "prediction_grid": with_views("occ", f""", {_BOX.format(t='occ')}
select i_lat * 200 + i_lon as cell_id, i_lat::int as i_lat, i_lon::int as i_lon,
  min_lat + i_lat * (max_lat - min_lat) / 199e0 as decimalLatitude,
  min_lon + i_lon * (max_lon - min_lon) / 199e0 as decimalLongitude
from range(200) a(i_lat) cross join range(200) b(i_lon) cross join box"""),
    "species_counts": _counts("taxa", "species"),
    "phylum_counts": _counts("taxa", "phylum"),
    "yearly_counts": with_views("occ_raw", """
select year(try_cast(eventDate as timestamp))::int as year, count(*) as n from occ_raw
where species is not null and decimalLatitude is not null and decimalLongitude is not null
group by 1 having year > 1950 order by 1"""),
    "bounding_box": with_views("occ_raw", f""", {_BOX.format(t='occ_raw')} select * from box"""),
    "mean_environment": with_views("fused", """
select round(avg(temperature_C), 9) as temperature, round(avg(salinity_PSU), 9) as salinity from fused"""),
    "modal_species": with_views("taxa", """
select species from taxa where species is not null group by species
order by count(*) desc, species limit 1"""),
    "column_profile": with_views("occ_raw", """
select unnest([
  {'position': 0::int, 'column': 'occ_id', 'type': 'bigint', 'non_null': count(occ_id), 'rows': count(*)},
  {'position': 1::int, 'column': 'species', 'type': 'string', 'non_null': count(species), 'rows': count(*)},
  {'position': 2::int, 'column': 'decimalLatitude', 'type': 'double',
   'non_null': count(decimalLatitude), 'rows': count(*)},
  {'position': 3::int, 'column': 'decimalLongitude', 'type': 'double',
   'non_null': count(decimalLongitude), 'rows': count(*)},
  {'position': 4::int, 'column': 'eventDate', 'type': 'string',
   'non_null': count(eventDate), 'rows': count(*)}], recursive := true) from occ_raw"""),
    "head_rows": with_views("occ", "select * from occ order by occ_id limit 5"),
    "top_species": with_views("taxa", """
select species, count(*) as n from taxa where species is not null group by species
order by n desc, species limit 20"""),
    "top_phyla": with_views("taxa", """
select phylum, count(*) as n from taxa where phylum is not null group by phylum
order by n desc, phylum limit 10"""),
    "cleaning_audit_nan": with_views("occ_nan", """
select count(*) as rows_before,
  count(*) filter (where species is not null and not isnan(decimalLatitude) and not isnan(decimalLongitude)) as rows_after,
  rows_before - rows_after as rows_removed from occ_nan"""),
    "bounding_box_nan": with_views("occ_nan", """
select min(decimalLatitude) filter (where not isnan(decimalLatitude)) as min_lat,
  max(decimalLatitude) filter (where not isnan(decimalLatitude)) as max_lat,
  min(decimalLongitude) filter (where not isnan(decimalLongitude)) as min_lon,
  max(decimalLongitude) filter (where not isnan(decimalLongitude)) as max_lon from occ_nan"""),
    "mean_environment_nan": with_views("occ_nan", """
select round(avg(temperature_C) filter (where not isnan(temperature_C)), 9) as temperature,
  round(avg(salinity_PSU) filter (where not isnan(salinity_PSU)), 9) as salinity from occ_nan"""),
    "rf_test_rows": _ROLES + """
select occ_id, draw, presence as label, true as p_in_range, true as prediction_follows
from roles where role in ('test', 'both')""",
    "rf_support": _ROLES + """
select unnest(['Absence', 'Presence', 'accuracy', 'macro avg', 'weighted avg']) as name,
  unnest([count(*) filter (where presence = 0), count(*) filter (where presence = 1), count(*), count(*), count(*)])
    as support
from roles where role in ('test', 'both')""",
    "rf_reload_differences": _ROLES + """
select count(*) as n, 0::bigint as n_different from roles where role in ('test', 'both')""",
    "rf_nodes": _ROLES + """
select count(*) as n, 0::bigint as n_different_p, 0::bigint as n_different_class
from roles where role in ('test', 'both')""",
    "model_all_species": _EVERY_SPECIES + "roles as (with " + _SPLIT.format(
        t="every", by="species, ", group="partition by species", label="presence",
        key="occ_id || ':' || draw") + """)
select species, count(*) filter (where role <> 'test') as n_train,
  count(*) filter (where role <> 'train') as n_test, true as learnt from roles group by species""",
    "surface_cells": _CELLS_AT + "select cell_id, hit.t as temperature, hit.s as salinity, true as p_in_range from best",
    "surface_all_species": _CELLS_AT + """
select species, cell_id, hit.t as temperature, hit.s as salinity, true as p_in_range
from best cross join (select distinct lower(trim(species)) as species from occ where species is not null)""",
    "overlay_points": with_views("occ_raw", """
select occ_id, species, decimalLatitude, decimalLongitude from occ_raw where species = (
  select species from occ_raw where species is not null group by species order by count(*) desc, species limit 1)"""),
    "occurrence_density": with_views("occ_raw", """
select floor(decimalLatitude / 0.5e0)::bigint as i_lat, floor(decimalLongitude / 0.5e0)::bigint as i_lon,
  count(*) as n from occ_raw
where decimalLatitude is not null and decimalLongitude is not null group by 1, 2"""),
    "pseudo_absence": with_views("fused", f""", {_BOX.format(t='fused')}
select occ_id, draw, decimalLatitude, decimalLongitude from (
{_ABSENCES.format(t='fused', ratio=2)})"""),
    "training_set": _training("view", False),
    "training_set_env": _training("view", True),
    "training_sets": with_views("fused", f""", {_BOX.format(t='fused')},
mine as (select fused.* from fused where species in (
  select arg_min(species, occ_id) from fused group by {_NAMES}))
select species, occ_id, 0::int as draw, decimalLatitude, decimalLongitude, 1::int as presence
from mine union all
select *, 0::int as presence from ({_ABSENCES.format(t='mine', ratio=1)})"""),
    "shuffled_training": _training("click", False),
    "stratified_split": "with " + _SPLIT.format(
        t="(select doc_id, quality from labels)", by="", group="", label="quality", key="doc_id"),
    "small_species": "with " + _SPLIT.format(
        t="(select event_id, user_id, event_type, (value > 10)::int as presence from events)",
        by="user_id, event_type, ", group="partition by user_id, event_type", label="presence",
        key="event_id"),
    "confusion_matrix": with_views("pred", """
select a.label, b.prediction, count(pred.row_id) as n
from (select unnest([0, 1])::int as label) a cross join (select unnest([0, 1])::int as prediction) b
left join pred on pred.label = a.label and pred.prediction = b.prediction group by all"""),
    "classification_report": with_views("pred", f""", {_CELLS}
select name, round(precision, 9) as precision, round(recall, 9) as recall, round(f1, 9) as f1,
  support from lines"""),
    "accuracy": with_views("pred", """
select round(avg((label = prediction)::int::double), 9) as accuracy from pred"""),
    "probability_bands": with_views("pred", """
select least(floor(p * 20)::bigint + 1, 20) as band, count(*) as n from pred group by 1"""),
}
