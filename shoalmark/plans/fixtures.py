"""Representative inputs: views over the driver's tables, read by the registered queries.

The SQL of each view runs unchanged in Spark and DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shoalmark.session import configure

VIEWS = {
    "occ": """
select event_id as occ_id, event_type as species,
  8e0 + 29e0 * ((event_id * 7919 + user_id) % 10007) / 10007e0 as decimalLatitude,
  68e0 + 29e0 * ((event_id * 104729 + user_id * 31) % 10009) / 10009e0 as decimalLongitude,
  case when event_id % 11 = 0 then null when event_id % 13 = 0 then 'junk'
       when event_id % 17 = 0 then '1998-01-01/1998-01-31'
       when event_id % 19 = 0 then '12:30' when event_id % 23 = 0 then 'T10:00'
       else cast(1994 + event_id % 10 as string) || substr(cast(ts as string), 5, 6) end as eventDate
from events""",
    "occ_raw": """
select occ_id,
  case when occ_id % 19 = 0 then null when occ_id % 7 = 0 then upper(species)
       when occ_id % 23 = 0 then '  ' || species || ' ' else species end as species,
  case when occ_id % 29 = 0 then null else decimalLatitude end as decimalLatitude,
  case when occ_id % 31 = 0 then null else decimalLongitude end as decimalLongitude,
  eventDate
from occ""",
    "occ_nan": """
select occ_id, species,
  case when occ_id % 37 = 0 then cast('NaN' as double) else decimalLatitude end as decimalLatitude,
  case when occ_id % 41 = 0 then cast('NaN' as double) else decimalLongitude end as decimalLongitude,
  case when occ_id % 43 = 0 then cast('NaN' as double) else 18e0 + (occ_id * 13) % 170 end as temperature_C,
  case when occ_id % 47 = 0 then null else 30e0 + (occ_id * 7) % 100 end as salinity_PSU
from occ_raw""",
    "ocean": """
select o_orderkey as ocean_id, o_orderdate as time, 0.494e0 as depth,
  8e0 + 0.25e0 * ((o_orderkey * 31) % 48) as latitude,
  68e0 + 0.25e0 * ((o_custkey * 17 + o_orderkey) % 117) as longitude,
  18e0 + o_totalprice / 50000e0 as temperature_C,
  30e0 + (o_orderkey % 100) / 20e0 as salinity_PSU
from orders""",
    "taxa": """
select l_orderkey * 8 + l_linenumber as line_key,
  case when l_orderkey % 19 = 0 then null else p_name end as species,
  p_brand as genus, p_type as family, l_returnflag as taxon_order,
  n_name as taxon_class, r_name as phylum, l_shipdate as eventDate
from lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey
  join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
    "fused": """
select occ_id, species, decimalLatitude, decimalLongitude,
  case when occ_id % 37 = 0 then null else 18e0 + ((occ_id * 13) % 170) / 10e0 end as temperature_C,
  30e0 + ((occ_id * 7) % 100) / 20e0 as salinity_PSU
from occ_raw where species is not null and decimalLatitude is not null and decimalLongitude is not null""",
    "areas": """
select n_nationkey as region_id, case
  when n_nationkey % 9 = 4 then 'POLYGON((68 8, 70 9)' when n_nationkey % 9 = 7 then null
  when n_nationkey % 4 = 1 then
    'MULTIPOLYGON (((' || x || ' ' || y || ', ' || (x + 4) || ' ' || y || ', ' || (x + 4) || '.5 ' || (y + 3) || ', ' || x || ' ' || y || ')), (('
      || (x + 6) || ' ' || y || ', ' || (x + 9) || ' ' || (y + 1) || ', ' || (x + 6) || ' ' || (y + 7) || ', ' || (x + 6) || ' ' || y || ')))'
  else 'POLYGON ((' || x || ' ' || y || '.3, ' || (x + 8) || ' ' || (y + 1) || ', ' || (x + 6) || '.5 ' || (y + 7) || ', '
      || (x + 3) || ' ' || (y + 4) || ', ' || x || '.2 ' || (y + 8) || ', ' || x || ' ' || y || '.3), (' || (x + 2) || ' ' || (y + 2) || ', '
      || (x + 4) || ' ' || (y + 2) || ', ' || (x + 4) || ' ' || (y + 3) || '.75, ' || (x + 2) || ' ' || (y + 2) || '))' end as wkt
from (select n_nationkey, 68 + n_nationkey % 5 * 5 as x, 8 + cast(floor(n_nationkey / 5) as int) * 5 as y from nation) as corners""",
    "pred": """
select doc_id as row_id, quality as label, toxic as prediction, ((doc_id * 37) % 101) / 100e0 as p
from labels""",
    "grid_slices": """
select cast('2020-01-01' as date) + cast(vec_id as int) as time, cast(vec_id % 3 as int) as depth_idx,
  embedding as thetao
from embeddings""",
}

# What each view reads: tables, and other views in the order they build on each other.
_TABLES = {
    "occ": ["events"], "occ_raw": ["events"], "occ_nan": ["events"], "fused": ["events"], "ocean": ["orders"],
    "taxa": ["lineitem", "part", "supplier", "nation", "region"],
    "pred": ["labels"], "areas": ["nation"], "grid_slices": ["embeddings"],
}
_NEEDS = {"occ_raw": ["occ"], "fused": ["occ", "occ_raw"], "occ_nan": ["occ", "occ_raw"]}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the VIEWS over the tables in ``sf_dir``."""
    configure(spark)
    for table in _TABLES[name]:
        spark.read.parquet(f"{sf_dir}/{table}.parquet").createOrReplaceTempView(table)
    for needed in _NEEDS.get(name, []):
        spark.sql(VIEWS[needed]).createOrReplaceTempView(needed)
    return spark.sql(VIEWS[name])


def with_views(name_list: str, sql: str) -> str:
    """``sql`` preceded by the named views as common table expressions."""
    wanted: list[str] = []
    for name in name_list.split():
        wanted += [n for n in [*_NEEDS.get(name, []), name] if n not in wanted]
    return "with " + ",\n".join(f"{n} as ({VIEWS[n]})" for n in wanted) + "\n" + sql
