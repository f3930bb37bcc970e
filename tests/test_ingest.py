"""Raw CSV ingest on a hand-made micro fixture: name pattern, text schema,
rounding casts, exact booleans, quality filter and keep-first dedup."""

import os
import tempfile

from skydrift.operators.staging import stage_flights
from skydrift.schemas import RAW_FLIGHT_COLUMNS
from skydrift.sources.ingest import cast_raw, read_raw_text

NAMES = [n for n, _ in RAW_FLIGHT_COLUMNS]


def _row(**kw):
    base = dict(Year="2019", Quarter="1", Month="1", DayofMonth="5", DayOfWeek="6",
                FlightDate="2019-01-05", Origin="JFK", OriginCityName="New York",
                OriginState="NY", OriginAirportID="12478", Dest="LAX",
                DestCityName="Los Angeles", DestState="CA", DestAirportID="12892",
                Distance="2475", DistanceGroup="10", Marketing_Airline_Network="AA",
                Operating_Airline="AA", Flight_Number_Marketing_Airline="1",
                Flight_Number_Operating_Airline="1", Tail_Number="N1", CRSDepTime="900",
                CRSArrTime="1200", CRSElapsedTime="360", DepTimeBlk="0900-0959",
                ArrDelay="5.0", ArrDelayMinutes="5.0", ArrDel15="0.0",
                ArrivalDelayGroups="0.0", DepDelay="1.0", DepDelayMinutes="1.0",
                Cancelled="False", Diverted="False")
    base.update(kw)
    return ",".join(base[n] for n in NAMES)


def _write(folder, name, rows):
    with open(os.path.join(folder, name), "w") as f:
        f.write(",".join(NAMES) + "\n")
        for r in rows:
            f.write(r + "\n")


def test_micro_csv_ingest_and_staging(spark):
    folder = tempfile.mkdtemp(prefix="skydrift-csv-")
    rows = [
        _row(),                                                    # kept
        _row(CRSDepTime="12.0", Marketing_Airline_Network="UA"),   # 12.0 -> 12; dup key
        _row(CRSDepTime="12.0", Marketing_Airline_Network="B6"),   # same key, B6 < UA
        _row(CRSDepTime="1000", Marketing_Airline_Network=""),     # NULL airline ...
        _row(CRSDepTime="1000", Marketing_Airline_Network="DL"),   # ... loses to DL
        _row(CRSDepTime="1100", CRSElapsedTime="2.5"),             # 2.5 -> 3
        _row(CRSDepTime="1200", CRSElapsedTime="-2.5"),            # -2.5 -> -3
        _row(CRSDepTime="1300", Cancelled="true"),                 # malformed flag -> dropped
        _row(CRSDepTime="1400", Cancelled=""),                     # NULL flag -> dropped
        _row(CRSDepTime="1500", Diverted="True"),                  # diverted -> dropped
        _row(CRSDepTime="1600", Distance="0"),                     # distance 0 -> dropped
        _row(CRSDepTime="1700", ArrDelay=""),                      # missing delay -> dropped
        _row(CRSDepTime="1800", Tail_Number="", OriginState=""),   # empty text -> NULL, kept
    ]
    _write(folder, "Combined_Flights_2019.csv", rows)
    _write(folder, "Combined_Flights_2019_backup.csv", [_row(CRSDepTime="2000")])  # decoy
    text = read_raw_text(spark, folder)
    assert text.count() == len(rows)
    typed = cast_raw(text)
    got = {r["CRSDepTime"]: r for r in typed.collect()}
    assert 12 in got and got[12]["Distance"] == 2475
    elapsed = sorted(r["CRSElapsedTime"] for r in typed.collect())
    assert elapsed[0] == -3 and 3 in elapsed
    flags = [r["Cancelled"] for r in typed.collect()]
    assert flags.count(None) == 2
    stg = {r["flight_uid"]: r for r in stage_flights(typed).collect()}
    assert set(stg) == {"JFK_LAX_2019-01-05_AA_900", "JFK_LAX_2019-01-05_AA_12",
                        "JFK_LAX_2019-01-05_AA_1000", "JFK_LAX_2019-01-05_AA_1100",
                        "JFK_LAX_2019-01-05_AA_1200", "JFK_LAX_2019-01-05_AA_1800"}
    assert stg["JFK_LAX_2019-01-05_AA_12"]["marketing_airline_network"] == "B6"
    assert stg["JFK_LAX_2019-01-05_AA_1000"]["marketing_airline_network"] == "DL"
    assert stg["JFK_LAX_2019-01-05_AA_1800"]["tail_number"] is None


def test_many_headers_without_a_job_each(spark, tmp_path):
    """1,000 files of three headers: the jobs of the read do not grow with them."""
    from skydrift.sources.ingest import read_raw_text
    heads = ("a,b,c", 'c,"a",b', "b,c")
    for k in range(1000):
        folder = tmp_path / f"f{k}"
        folder.mkdir()
        head = heads[2 if k % 100 == 7 else k % 2]
        values = {"a": f"a{k}", "b": "" if k % 3 else f"b{k}", "c": str(k)}
        row = ",".join(values[c.strip('"')] for c in head.split(","))
        (folder / "Combined_Flights_2018.csv").write_text(f"{head}\r\n{row}\r\n" if k % 2 else f"{head}\n{row}\n")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "headers")
    skipped: list[str] = []
    df = read_raw_text(spark, str(tmp_path), columns=["a", "b", "c"], skipped=skipped)
    jobs = len(tracker.getJobIdsForGroup("headers"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    got = {r.a: (r.b, r.c) for r in df.collect()}
    assert jobs <= 6 and len(skipped) == 10
    assert got == {f"a{k}": (None if k % 3 else f"b{k}", str(k)) for k in range(1000) if k % 100 != 7}


def test_scratch_tables_go(spark, tmp_path):
    import os
    from skydrift.session import scratch_path, temporaries
    path = scratch_path(spark, "stays")
    spark.range(3).write.parquet(path)
    with temporaries(spark):
        inner = scratch_path(spark, "goes")
        spark.range(3).write.parquet(inner)
        spark.read.parquet(inner).write.parquet(str(tmp_path / "out"))
    local = [p.removeprefix("file:") for p in (path, inner)]
    assert os.path.isdir(local[0]) and not os.path.isdir(local[1]) and spark.read.parquet(str(tmp_path / "out")).count() == 3
