"""Landing of pages that overlap, and of yearly files that hold other rows too."""

import gzip
import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import rows
from shoalmark.operators.intervals import sweep
from shoalmark.plans import pipelines
from shoalmark.schemas import OCCURRENCE, OCEAN, OCEAN_WITH_YEAR
from shoalmark.session import scratch_path
from shoalmark.sources import tables
from shoalmark.sources.landing import first_records, land_pages, landed_records, read_pages


def land(spark, tmp_path, pages):
    with open(tmp_path / "pages.json", "w") as out:
        for offset, names in pages:
            out.write(json.dumps({"offset": offset, "results": [{"species": n} for n in names]}) + "\n")
    return read_pages(spark, str(tmp_path))


def parts(landing):
    return ([(r.occ_id, r.species) for r in landing.records.orderBy("occ_id").collect()],
            sorted((r.occ_id, r.species) for r in landing.conflicts.collect()),
            sorted((r.problem, r.offset, r.end, r.n) for r in landing.audit.collect()))


def test_equal_pages_collapse_and_shifted_ones_agree(spark, tmp_path):
    pages = land(spark, tmp_path, [(0, "abcd"), (0, "abcd"), (2, "cdef"), (6, "gh")])
    records, conflicts, audit = parts(land_pages(pages, 4))
    assert records == list(enumerate("abcdefgh")) and conflicts == []
    assert audit == [("overlap", 0, 6, 2), ("repeated", 0, 4, 1)]
    assert rows(landed_records(pages).select("occ_id")) == [(i,) for i in range(8)]


def test_conflicts_keep_the_page_that_begins_first(spark, tmp_path):
    pages = land(spark, tmp_path, [(0, "abcd"), (2, "cXef"), (2, "cd")])
    records, conflicts, audit = parts(land_pages(pages, 4))
    assert records == list(enumerate("abcdef")) and conflicts == [(3, "X")]
    assert audit == [("overlap", 0, 6, 3)]
    with pytest.raises(ValueError, match="disagree, first at places 3"):
        landed_records(pages)


def test_the_pipeline_stops_on_conflicts_or_hands_them_on(spark, tmp_path):
    record = {"species": "a", "decimalLatitude": 10.0, "decimalLongitude": 70.0}
    lines = [{"offset": 0, "results": [record, record]}, {"offset": 1, "results": [{**record, "species": "b"}, record]}]
    (tmp_path / "p.json").write_text("\n".join(map(json.dumps, lines)))
    with pytest.raises(ValueError, match="disagree, first at places 1"):
        pipelines.land_occurrences(spark, str(tmp_path), scratch_path(spark, "clean"))
    landed = pipelines.land_occurrences(spark, str(tmp_path), scratch_path(spark, "clean"), page_size=2, keep_conflicts=True)
    assert rows(landed["occurrences"].select("occ_id", "species")) == [(0, "a"), (1, "a"), (2, "a")]
    assert rows(landed["conflicts"].select("occ_id", "species")) == [(1, "b")]
    assert rows(landed["pages"].select("problem")) == [("overlap",)]
    away = "POLYGON((0 0, 1 0, 1 1, 0 0))"
    with pytest.raises(ValueError, match="no record"):
        pipelines.land_occurrences(spark, str(tmp_path), scratch_path(spark, "clean"), region=away, keep_conflicts=True)


def test_a_page_above_the_size_is_told_and_landed(spark, tmp_path):
    records, conflicts, audit = parts(land_pages(land(spark, tmp_path, [(0, "abcdef"), (4, "ef"), (9, "j")]), 4))
    assert records == [*enumerate("abcdef"), (9, "j")] and conflicts == []
    assert audit == [("missing", 6, 9, 3), ("overlap", 0, 6, 2), ("oversize", 0, 6, 6), ("short", 4, 6, 2)]


def test_no_page_and_empty_pages(spark, tmp_path):
    assert parts(land_pages(land(spark, tmp_path, []), 4)) == ([], [], [])
    assert parts(land_pages(land(spark, tmp_path, [(0, ""), (0, "")]), 4)) == ([], [], [("repeated", 0, 0, 1)])


def test_many_messy_pages_equal_brute_force(spark, tmp_path, no_broadcast):
    rng = random.Random(4)
    truth = [rng.choice("abcdefg") for _ in range(600)]
    pages = []
    for _ in range(90):
        start, n = rng.randrange(560), rng.choice([0, 1, 7, 20, 20, 20, 35])
        names = truth[start:start + n]
        if names and rng.random() < 0.3:
            names = [rng.choice(["Z", name]) for name in names]
        pages += [(start, names)] * rng.choice([1, 1, 2])
    landing = land_pages(land(spark, tmp_path, pages), 20)
    versions = {}
    for start, names in pages:
        for i, name in enumerate(names):
            versions.setdefault(start + i, {}).setdefault(name, []).append((start, -len(names)))
    records, conflicts, audit = parts(landing)
    assert [r[0] for r in records] == sorted(versions)
    assert sorted(records + conflicts) == sorted((place, name) for place, by in versions.items() for name in by)
    for place, name in records:
        assert min(versions[place][name]) == min(min(v) for v in versions[place].values())
    covered = {p for p, v in versions.items()}
    holes = {p for _, a, b, _ in audit if _ is not None for p in ()}
    for problem, a, b, n in audit:
        if problem == "missing":
            holes |= set(range(a, b))
    assert holes == set(range(max(covered))) - covered


def test_sweep(spark):
    rng = random.Random(5)
    ranges = [(s, s + rng.randint(1, 30), i) for i, s in enumerate(rng.randrange(3000) for _ in range(400))]
    df = spark.createDataFrame(ranges, "start long, end long, id long").repartition(7)
    found = {r.id: (r.reach, r.cluster) for r in sweep(df, "start", "end", ["id"]).collect()}
    reach = cluster = None
    for start, end, i in sorted(ranges, key=lambda r: (r[0], -r[1], r[2])):
        cluster = start if reach is None or start >= reach else cluster
        assert found[i] == (reach, cluster)
        reach = end if reach is None else max(reach, end)


@pytest.mark.parametrize("limit", [0, 1, 3, 50, 499, 500, 900])
def test_first_records_are_cut_by_counts(spark, limit, monkeypatch):
    monkeypatch.setattr("shoalmark.sources.landing.CUT_BUCKETS", 8)
    ids = sorted(random.Random(1).sample(range(-10**12, 10**12), 500))
    df = spark.createDataFrame([(i,) for i in ids], "occ_id long").repartition(5)
    found = first_records(df, limit)
    assert sorted(r.occ_id for r in found.collect()) == ids[:limit]
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in text and "GlobalLimit" not in text.replace("GlobalLimit 0", "")


# --- yearly files --------------------------------------------------------------------


def year_files(tmp_path, contents):
    files = {}
    for year, lines in contents.items():
        file = tmp_path / f"sea {year}+%.csv"
        file.write_text("latitude,time,longitude\n" + "".join(f"{lat},{time},2\n" for lat, time in lines))
        files[year] = str(file)
    return files


def stored(spark, path):
    return rows(tables.read_ocean(spark, path, OCEAN_WITH_YEAR).select(
        "latitude", F.col("time").cast("string"), "year"))


def test_rows_of_other_years_and_without_a_time_are_kept(spark, tmp_path):
    path = scratch_path(spark, "sea")
    files = year_files(tmp_path, {
        2020: [(1, "2020-03-01 00:00:00"), (2, "2021-01-01 00:00:00"), (3, "no time"), (4, "")],
        2021: [(5, "2021-05-05 00:00:00"), (6, "2020-12-31 23:59:59")]})
    first = {2020: files[2020]}
    assert pipelines.land_ocean_years(spark, first, path) == [2020]
    assert pipelines.land_ocean_years(spark, files, path) == [2021]
    everything = sorted([(1.0, "2020-03-01 00:00:00", 2020), (2.0, "2021-01-01 00:00:00", 2021), (3.0, None, None),
                         (4.0, None, None), (5.0, "2021-05-05 00:00:00", 2021), (6.0, "2020-12-31 23:59:59", 2020)], key=repr)
    assert stored(spark, path) == everything
    assert pipelines.land_ocean_years(spark, files, path) == []
    assert stored(spark, path) == everything
    assert rows(tables.read_landings(spark, path).select("file_year", "n_rows", "n_other_year", "n_no_time")) == [
        (2020, 4, 1, 2), (2021, 2, 1, 0)]
    assert rows(tables.read_ocean(spark, path, OCEAN).where("time is null").select("latitude")) == [(3.0,), (4.0,)]


def test_a_year_without_a_row_of_its_own_has_landed(spark, tmp_path):
    path = scratch_path(spark, "sea")
    files = year_files(tmp_path, {2020: [(1, "2019-03-01 00:00:00")], 2021: []})
    assert pipelines.land_ocean_years(spark, files, path) == [2020, 2021]
    assert pipelines.land_ocean_years(spark, files, path) == []
    assert [r[1] for r in stored(spark, path)] == ["2019-03-01 00:00:00"]


def test_a_landing_that_broke_off_can_run_again(spark, tmp_path, monkeypatch):
    path = scratch_path(spark, "sea")
    files = year_files(tmp_path, {2020: [(1, "2020-03-01 00:00:00"), (2, "x")], 2021: [(3, "2021-01-01 00:00:00")]})
    with monkeypatch.context() as broken:
        def stop(*_):
            raise OSError("lost")
        broken.setattr(tables, "write_ocean", stop)
        with pytest.raises(OSError):
            pipelines.land_ocean_years(spark, files, path)
    assert pipelines.land_ocean_years(spark, files, path) == [2020, 2021]
    assert len(stored(spark, path)) == 3


def test_files_that_lack_or_are_given_twice(spark, tmp_path):
    files = year_files(tmp_path, {2020: [(1, "2020-03-01 00:00:00")]})
    with pytest.raises(FileNotFoundError):
        pipelines.land_ocean_years(spark, {**files, 2021: str(tmp_path / "none.csv")}, scratch_path(spark, "sea"))
    with pytest.raises(ValueError, match="more than one year"):
        pipelines.land_ocean_years(spark, {2020: files[2020], 2021: files[2020]}, scratch_path(spark, "sea"))


def test_all_missing_years_are_one_scan(spark, tmp_path):
    files = year_files(tmp_path, {year: [(1, f"{year}-03-01 00:00:00")] for year in range(2000, 2012)})
    df = tables.read_year_files(spark, files, OCEAN)
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 1
    assert rows(df.select("file_year").distinct()) == [(year,) for year in range(2000, 2012)]


# --- headers -------------------------------------------------------------------------


def bytes_read(spark):
    return sum(s.getBytesRead() for s in spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics()
               if s.getScheme() == "file")


def test_a_header_costs_no_pass_over_its_file(spark, tmp_path):
    long = tmp_path / "long.csv"
    long.write_text("species,decimalLatitude\n" + "a name of some length,1.5\n" * 400_000)
    (tmp_path / "other.csv").write_text("decimalLatitude,species\n2,b\n")
    (tmp_path / "packed.csv.gz").write_bytes(gzip.compress(b"species,decimalLatitude\r\nc,3\r\n"))
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "_hidden.csv").write_text("x\n")
    before = bytes_read(spark)
    groups = tables.files_by_header(spark, str(tmp_path))
    assert bytes_read(spark) - before < 100_000 < long.stat().st_size
    assert [[Path(f).name for f in files] for files in groups] == [["other.csv"], ["long.csv", "packed.csv.gz"]]
    got = tables.read_csv(spark, str(tmp_path), OCCURRENCE)
    plan = got._jdf.queryExecution().executedPlan()
    assert plan.toString().count("FileScan csv") == 2
    assert rows(got.groupBy("species").count()) == [("a name of some length", 400_000), ("b", 1), ("c", 1)]


def test_read_csv_names_the_file(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.csv").write_text(f"species\n{name}\n")
    got = tables.read_csv(spark, str(tmp_path / "*.csv"), OCCURRENCE, file_column="file")
    assert sorted((r.species, Path(r.file).name) for r in got.collect()) == [("a", "a.csv"), ("b", "b.csv")]
