import decimal
import gzip
import shutil
import struct
import threading
from concurrent.futures import ThreadPoolExecutor

import pytest

from tests.tables import line, observation, observations, streams
from thalweg import schemas, sources
from thalweg.plans.snapping import explode_points, keyed_observations
from thalweg.functions import wkb
from thalweg.sources import eventstore, writers

HEADER = "id,type,extinct_indicator,watershed_id,sequence_number,waterbody_identifier,gazetted_name,waterbody_mouth_identifier,formatted_name\n"


def test_dictionary_csv(spark, tmp_path):
    path = tmp_path / "w.csv.gz"
    with gzip.open(path, "wt") as f:
        f.write(HEADER + '7,L,,5,"",00012ABCD,"Big ""B"" Lake, North",,"two\nlines"\n8,,,,,,,,\n')
    rows = sources.read_waterbody_dictionary(spark, str(path)).orderBy("id").collect()
    first = rows[0]
    assert (first.id, first.extinct_indicator, first.watershed_id, first.sequence_number) == (7, None, 5, "")
    assert (first.gazetted_name, first.formatted_name) == ('Big "B" Lake, North', "two\nlines")
    assert tuple(rows[1]) == (8,) + (None,) * 8


def test_species_csv(spark, tmp_path):
    path = tmp_path / "s.csv"
    names = ",".join(f.name for f in schemas.SPECIES.fields)
    path.write_text(f"{names}\n3,ST,Steelhead,a,b,c,d,e\n")
    assert tuple(sources.read_species(spark, str(path)).collect()[0]) == (3, "ST", "Steelhead", "a", "b", "c", "d", "e")


def test_bad_csv_stops(spark, tmp_path):
    path = tmp_path / "w.csv"
    path.write_text(HEADER + "x,L,,5,,,,,\n")
    with pytest.raises(Exception):
        sources.read_waterbody_dictionary(spark, str(path)).collect()


def test_parquet_sources(spark, tmp_path):
    lines = streams(spark, line(1, (0, 0, 0), (1, 0, 1)))
    lines.write.parquet(str(tmp_path / "streams"))
    assert sources.read_streams(spark, str(tmp_path / "streams")).collect() == lines.collect()
    for read, schema, row in (
        (sources.read_waterbody_xref, schemas.WATERBODY_XREF, (1, "ABCD", 2)),
        (sources.read_waterbodies, schemas.WATERBODIES, (2,)),
        (sources.read_stream_xref, schemas.STREAM_XREF, ("100", 3)),
    ):
        path = str(tmp_path / read.__name__)
        spark.createDataFrame([row], schema).write.parquet(path)
        assert tuple(read(spark, path).collect()[0]) == row


def test_observation_forms(spark, tmp_path):
    flat = observations(spark, observation(fish_observation_point_id=4, x=1.0, y=2.0))
    flat.write.parquet(str(tmp_path / "flat"))
    assert sources.read_observations(spark, str(tmp_path / "flat")).collect() == flat.collect()
    two = b"\x01" + struct.pack("<II", 4, 2) + 2 * (b"\x01" + struct.pack("<Idd", 1, 7.0, 8.0))
    number = flat.selectExpr("* except(x, y, wbody_id)", "cast(5 as decimal(38,0)) as wbody_id")
    binary = number.crossJoin(spark.createDataFrame([(bytearray(two),), (None,)], "geom binary"))
    binary.write.parquet(str(tmp_path / "wkb"))
    read = sources.read_observations(spark, str(tmp_path / "wkb"))
    assert {r.wbody_id for r in read.collect()} == {5}
    parts = explode_points(read).collect()
    assert [(r.x, r.y) for r in parts] == [(7.0, 8.0)] * 2
    assert keyed_observations(read).count() == 1


def test_fractional_ids_stop(spark, tmp_path):
    df = observations(spark, observation()).drop("wbody_id")
    half = spark.createDataFrame([(decimal.Decimal("1.5"),)], "wbody_id decimal(10,1)")
    df.crossJoin(half).write.parquet(str(tmp_path / "half"))
    with pytest.raises(Exception, match="isn't whole"):
        sources.read_observations(spark, str(tmp_path / "half")).collect()


@pytest.mark.parametrize(
    "column, value, kind",
    [("wbody_id", 5.7, "double"), ("utm_zone", decimal.Decimal("9.6"), "decimal(3,1)"), ("agency_id", float("nan"), "double")],
)
def test_other_fractions_stop(spark, tmp_path, column, value, kind):
    df = observations(spark, observation()).drop(column)
    df.crossJoin(spark.createDataFrame([(value,)], f"{column} {kind}")).write.parquet(str(tmp_path / "f"))
    with pytest.raises(Exception, match="isn't whole|overflow"):
        sources.read_observations(spark, str(tmp_path / "f")).collect()


def test_long_texts_stop_at_ingest(spark, tmp_path):
    observations(spark, observation(species_code="TOOLONG")).write.parquet(str(tmp_path / "long"))
    with pytest.raises(ValueError, match="longer than declared"):
        sources.read_observations(spark, str(tmp_path / "long"))


def output(spark, *keys, **values):
    rows = []
    for k in keys:
        row = dict.fromkeys(schemas.OUTPUT_COLUMNS)
        row.update(observation_key=k, blue_line_key=1, downstream_route_measure=2.0, geom=(1.0, 2.0, 3.0), **values)
        rows.append(tuple(row.values()))
    return spark.createDataFrame(rows, schemas.OUTPUT)


def test_publishing_is_all_or_nothing(spark, tmp_path):
    path = str(tmp_path / "out")
    with pytest.raises(ValueError, match="nothing is published"):
        sources.read_published(spark, path)
    sources.write_observations(output(spark, "a", "b"), path)
    assert sources.read_published(spark, path).count() == 2
    for bad in (output(spark, "a", "a"), output(spark, "a", species_code="TOOLONG"), output(spark, None)):
        with pytest.raises(ValueError):
            sources.write_observations(bad, path)
        assert sources.read_published(spark, path).count() == 2
    sources.write_observations(output(spark, "c"), path)
    assert [r.observation_key for r in sources.read_published(spark, path).collect()] == ["c"]


def test_one_of_two_writers_wins(spark, tmp_path, monkeypatch):
    """Both begin at the same state; the one that comes second learns of it, and may try again."""
    path = str(tmp_path / "t")
    sources.write_observations(output(spark, "a"), path)
    both, kept = threading.Barrier(2, timeout=120), writers._last

    def last(*a):
        found = kept(*a)
        both.wait()
        return found

    monkeypatch.setattr(writers, "_last", last)
    with ThreadPoolExecutor(2) as pool:
        tries = [pool.submit(sources.write_observations, output(spark, k), path) for k in ("b", "c")]
        failed = [t.exception() for t in tries]
    monkeypatch.setattr(writers, "_last", kept)
    assert sorted(type(e).__name__ for e in failed) == ["NoneType", "PublishConflict"]
    won = "bc"[failed.index(None)]
    assert [r.observation_key for r in sources.read_published(spark, path).collect()] == [won]
    assert kept(spark, path)[1] == 2
    sources.write_observations(output(spark, "d"), path)
    assert [r.observation_key for r in sources.read_published(spark, path).collect()] == ["d"]


def test_the_source_is_read_once(spark, tmp_path):
    path = str(tmp_path / "o")
    observations(spark, observation(), observation(fish_observation_point_id=2)).write.parquet(path)
    read = sources.read_observations(spark, path)
    shutil.rmtree(path)
    assert read.count() == 2


def test_export(spark, tmp_path):
    path = str(tmp_path / "export")
    sources.export_observations(output(spark, "a"), path)
    back = spark.read.parquet(path)
    assert back.columns == schemas.OUTPUT_COLUMNS and dict(back.dtypes)["wscode"] == "string"


def test_positions_in_binary(spark, tmp_path):
    point = "struct<x: double, y: double, z: double, m: double>"
    rows = [(1, (1.5, -2.0, 3.0, 4.25)), (2, None), (3, (1.0, 2.0, None, None)), (4, (1.0, 2.0, None, 9.0)), (5, (None, 2.0, 3.0, 4.0)), (6, (7.0, 8.0, 9.0, None))]
    df = spark.createDataFrame(rows, f"id long, geom {point}")
    got = {r.id: r.geom for r in wkb.with_wkb(df).repartition(2).collect()}
    assert got[2] is got[5] is None
    assert struct.unpack("<BI4d", got[1]) == (1, 3001, 1.5, -2.0, 3.0, 4.25)
    assert struct.unpack("<BI2d", got[3]) == (1, 1, 1.0, 2.0)
    assert struct.unpack("<BI3d", got[4]) == (1, 2001, 1.0, 2.0, 9.0) and struct.unpack("<BI3d", got[6]) == (1, 1001, 7.0, 8.0, 9.0)
    back = {r.id: [tuple(p) for p in r.p] for r in wkb.with_wkb(df).where("geom is not null").select("id", wkb.wkb_points("geom").alias("p")).collect()}
    assert back == {1: [(1.5, -2.0)], 3: [(1.0, 2.0)], 4: [(1.0, 2.0)], 6: [(7.0, 8.0)]}
    assert wkb.with_wkb(df.limit(0)).count() == 0
    sources.export_observations(output(spark, "a"), str(tmp_path / "b"), binary=True)
    assert struct.unpack("<BI3d", spark.read.parquet(str(tmp_path / "b")).first().geom) == (1, 1001, 1.0, 2.0, 3.0)


def events(spark, n):
    rows = [(i, p, 1, 7.0, [i * 10 + p, 5] if i % 3 else [i * 10 + p], [i % 4, None], (1.0, 2.0, 3.0)) for i in range(n) for p in range(1 + i % 2)]
    schema = "fish_obsrvtn_event_id long, part_no long, blue_line_key long, downstream_route_measure double, obs_ids array<long>, species_ids array<int>, geom struct<x: double, y: double, z: double>"
    return spark.createDataFrame(rows, schema)


def _files_read(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if plan.nodeName().startswith("Adaptive") else plan
    scans = plan.collectLeaves()
    return sum(scans.apply(i).metrics().apply("numFiles").value() for i in range(scans.size()) if scans.apply(i).nodeName().startswith("Scan"))


@pytest.mark.parametrize("few", [10_000, 1])
def test_stored_events(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr(eventstore, "FEW_EVENTS", few)
    path, table = str(tmp_path / "e"), events(spark, 200)
    sources.write_events(table, path, buckets=16)
    key = ["fish_obsrvtn_event_id", "part_no"]
    assert sorted(map(tuple, sources.read_events(spark, path).select(*key).collect())) == sorted(map(tuple, table.select(*key).collect()))
    for column, ids in (("obs_ids", [30, 71]), ("obs_ids", [5]), ("obs_ids", [-1]), ("obs_ids", []), ("species_ids", [2]), ("species_ids", [2, 3, 9])):
        found = sources.stored_events_with(spark, path, column, ids)
        want = {r.fish_obsrvtn_event_id for r in table.collect() if set(ids) & set(r[column])}
        assert sorted(map(tuple, found.select(*key).collect())) == sorted((r[0], r[1]) for r in table.collect() if r[0] in want)
    if few > 1:
        one = sources.stored_events_with(spark, path, "obs_ids", [30])
        assert one.count() == 2 and _files_read(one) * 4 < _files_read(sources.read_events(spark, path))
    with pytest.raises(ValueError, match="no postings"):
        sources.stored_events_with(spark, path, "match_types", [1])


def test_events_carry_the_measure(spark, tmp_path):
    sources.export_events(events(spark, 3), str(tmp_path / "x"))
    assert struct.unpack("<BI4d", spark.read.parquet(str(tmp_path / "x")).first().geom) == (1, 3001, 1.0, 2.0, 3.0, 7.0)


def test_duplicate_report_csv(spark, tmp_path):
    path = str(tmp_path / "dup")
    row = observation(source="s")
    sources.write_duplicates(observations(spark, row, row, observation(source="t")), path)
    back = spark.read.option("header", True).csv(path).collect()
    assert [(r.source, r.n) for r in back] == [("s", "2")] and len(back[0]) == 9


def test_staged_tables_are_removed_on_request(spark, tmp_path, monkeypatch):
    import glob

    from thalweg import staging

    monkeypatch.setattr(staging, "_shared_dir", lambda spark: str(tmp_path))
    assert staging.stage(spark.range(3), "x").count() == 3
    assert len(glob.glob(f"{tmp_path}/staged-*/x-*")) == 1
    staging.clear_staged(spark)
    assert not glob.glob(f"{tmp_path}/staged-*")
