"""Registry, typed reading, Parquet layout, scratch tables, incremental ingest, command line."""

import glob
import json

import pyarrow.parquet as pq
import pytest
from conftest import FIXTURE_ROLES as R
from pyspark.sql import functions as F

from logassay.cli import main
from logassay.operators.verdict import FAIL, PASS
from logassay.sources import scratch, storage, tables
from logassay.sources.registry import Registry, declared_outputs
from logassay.streaming.ingest import ingest_new_files

HEADER = "user_id,video_id,play_duration,video_duration,time,date,timestamp,watch_ratio"
LINES = [
    "1,10,3000,8000,2020-07-05 00:09:41.617,20200705,1593878981.617,0.375",
    "1,11,5,10,2020-07-05 01:02:33.5,20200705,1593882153.5,0.5",
    "2,10,5,10,2020-07-05 03:44:05.32,20200705.0,1593891845.32,0.5",
    "14,77,1000,3000,,,,0.3333333333333333",
    "3,12,20,10,2020-07-06 23:00:00,20200706,1594047600.0,2.0",
]


def write_csv(folder, name="big.csv", lines=LINES):
    path = folder / name
    path.write_text("\n".join([HEADER, *lines]) + "\n")
    return str(path)


def test_ingest_types_every_cell(spark, tmp_path):
    got = tables.ingest(spark, write_csv(tmp_path), str(tmp_path / "t"), R).orderBy("user_id", "video_id")
    assert dict(got.dtypes) == {
        "user_id": "bigint", "video_id": "bigint", "play_duration": "bigint", "video_duration": "bigint",
        "time": "timestamp_ntz", "date": "bigint", "timestamp": "double", "watch_ratio": "double"}
    rows = got.collect()
    assert [r["time"].microsecond if r["time"] else None for r in rows] == [617000, 500000, 320000, 0, None]
    assert [r["date"] for r in rows] == [20200705, 20200705, 20200705, 20200706, None]
    assert rows[0]["watch_ratio"] == 0.375


def test_cells_that_do_not_fit_are_counted(spark, tmp_path):
    path = write_csv(tmp_path, lines=[*LINES, "x,10,5,10,2020-07-05 03:28:02,20200705,1.0,0.5"])
    assert tables.bad_rows(spark, path, tables.raw_schema(R)).first().asDict() == {"rows": 6, "bad_rows": 1}


def test_row_groups_and_file_sizes(spark, tmp_path):
    df = spark.range(1000).coalesce(1)
    tables.write_parquet(df, str(tmp_path / "g"), tables.ParquetLayout(row_group_rows=300, file_rows=600))
    sizes = []
    for f in sorted(glob.glob(str(tmp_path / "g/*.parquet"))):
        meta = pq.ParquetFile(f).metadata
        assert meta.row_group(0).column(0).compression == "ZSTD"
        sizes.append([meta.row_group(i).num_rows for i in range(meta.num_row_groups)])
    assert sorted(sizes) == [[300, 100], [300, 300]]


def test_formats_are_compared_on_full_reads(spark, tmp_path):
    many = [f"{i},{i},100,200,2020-07-05 00:09:41.617,20200705,1593878981.617,0.5" for i in range(5000)]
    csv = write_csv(tmp_path, lines=many)
    table = tables.ingest(spark, csv, str(tmp_path / "t"), R)
    got = storage.compare_formats(tables.read_csv(spark, csv, tables.raw_schema(R)), table, 1).first()
    assert (got["csv_rows"], got["parquet_rows"], got["smaller"]) == (5000, 5000, True)
    assert got["csv_seconds"] > 0 and got["parquet_seconds"] > 0


def test_registry_paths_and_errors(tmp_path):
    doc = {"root": "/data", "raw_dir": "raw", "table_dir": "s3a://bucket/t",
           "datasets": {"big": {"csv": "b.csv", "parquet": "b", "observed": "full"}}, "side_files": {"f": "f.csv"}}
    path = tmp_path / "r.json"
    path.write_text(json.dumps(doc))
    registry = Registry.load(path)
    big = registry.dataset("big")
    assert (big.csv, big.parquet, big.options) == ("/data/raw/b.csv", "s3a://bucket/t/b", {"observed": "full"})
    assert registry.side_file("f") == "/data/raw/f.csv"
    with pytest.raises(KeyError, match="nope"):
        registry.dataset("nope")
    with pytest.raises(KeyError, match="nope"):
        registry.side_file("nope")
    with pytest.raises(FileNotFoundError):
        Registry.load(tmp_path / "absent.json")


def test_missing_outputs_fail(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "here"))
    registry = Registry({"root": str(tmp_path), "datasets": {
        "a": {"csv": "a.csv", "parquet": "here"}, "b": {"csv": "b.csv", "parquet": "gone"}}})
    got = {r["check_id"]: r["verdict"] for r in declared_outputs(spark, registry).collect()}
    assert got == {"contract.output.a": PASS, "contract.output.b": FAIL}


def test_scratch_tables_live_in_the_shared_folder(spark):
    folder = scratch.scratch_folder(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir", folder)
    table = scratch.materialize(spark.range(10).withColumn("x", F.lit("y")), "t")
    assert table.count() == 10 and all(folder in f for f in table.inputFiles())


def test_incremental_ingest_takes_each_file_once(spark, tmp_path):
    source = tmp_path / "csv"
    source.mkdir()
    out, progress = str(tmp_path / "t"), str(tmp_path / "progress")

    def run():
        ingest_new_files(spark, str(source), out, progress, R).awaitTermination()
        return spark.read.parquet(out).count()

    write_csv(source, "one.csv")
    assert run() == 5
    assert run() == 5
    write_csv(source, "two.csv", LINES[:2])
    assert run() == 7


@pytest.fixture
def registry_file(tmp_path):
    """Two small datasets; the exposure log has a day written twice and two runs of days."""
    raw = tmp_path / "raw"
    raw.mkdir()
    lines = []
    for day, copies in ((4, 1), (5, 2), (6, 1), (10, 1)):
        for user in range(1, 6):
            epoch = 1593820800 + (day - 4) * 86400 + user
            line = (f"{user},{10 + user},5,10,2020-07-{day:02d} 08:00:{user:02d}.5,202007{day:02d},{epoch}.5,0.5")
            lines += [line] * copies
    write_csv(raw, "big.csv", lines)
    panel = [f"{u},{v},5,10,2020-07-05 08:00:00.5,20200705,1593907200.5,0.5" for u in (1, 2) for v in (11, 12)]
    write_csv(raw, "small.csv", panel)
    (raw / "features.csv").write_text("video_id,date\n11,20200704\n12,20200705\n")
    doc = {"root": str(tmp_path), "raw_dir": "raw", "table_dir": "tables",
           "datasets": {"big": {"csv": "big.csv", "parquet": "big"},
                        "small": {"csv": "small.csv", "parquet": "small", "observed": "full"}},
           "side_files": {"features": "features.csv"},
           "roles": {"item": "video_id", "day": "date", "wall_time": "time", "epoch": "timestamp",
                     "numerator": "play_duration", "denominator": "video_duration", "ratio": "watch_ratio"}}
    path = tmp_path / "audit.json"
    path.write_text(json.dumps(doc))
    return str(path)


def test_command_line_end_to_end(spark, registry_file, tmp_path, capsys):
    def run(*argv):
        code = main([argv[0], "--registry", registry_file, *argv[1:]], spark)
        return code, capsys.readouterr().out

    code, out = run("contract")
    assert code == 1 and "FAIL" in out
    assert run("ingest")[0] == 0
    code, out = run("contract", "--formats")
    assert code == 0 and "contract.big.time_loss" in out
    code, out = run("profile", "--features", "features", "--out", str(tmp_path / "out"))
    assert code == 0 and "profile.small.observed" in out
    assert spark.read.parquet(str(tmp_path / "out/profile_verdicts")).where("verdict = 'FAIL'").isEmpty()
    assert run("anomaly")[0] == 0
    code, out = run("diff", "--left", "small", "--right", "big", "--segments", "2")
    assert code == 0 and "20200707" in out
    assert run("diff", "--left", "small", "--right", "big", "--segments", "3")[0] == 1
    code, out = run("peaks", "--dataset", "big", "--control", "small", "--partial", "20200705", "--whole", "20200705",
                    "--expect", "removed_dups=5")
    assert "peak.big.whole_doubled" in out and "peak.small.clean" in out
    # Written twice on one listed day: only the rule that another day must lead afterwards can fail.
    assert code == 1
    code, out = run("text")
    assert code == 0 and "invalid_rows" in out
    # A command leaves no scratch table behind.
    before = scratch.written(spark)
    assert run("anomaly")[0] == 0 and scratch.written(spark) == before


@pytest.mark.parametrize("command,lacking", [("diff", "--left and --right"), ("peaks", "--partial and --whole")])
def test_required_arguments_are_named(spark, registry_file, capsys, command, lacking):
    with pytest.raises(SystemExit):
        main([command, "--registry", registry_file], spark)
    assert f"{command} needs {lacking}" in capsys.readouterr().err


def test_dataset_without_a_table_is_named():
    with pytest.raises(ValueError, match="'big' lacks parquet"):
        Registry({"datasets": {"big": {"csv": "big.csv"}}}).dataset("big")


def test_spoiled_days_and_epochs_are_null(spark):
    cells = ["20240101", "20240101.0", "20240101.7", "NaN", "1e30", "-Infinity", "", None, "x"]
    raw = spark.createDataFrame([(c,) for c in cells], "date string")
    got = [r[0] for r in raw.select(tables.whole_day(F.col("date"))).collect()]
    assert got == [20240101, 20240101] + [None] * 7


def test_missing_table_is_reported(spark, registry_file, capsys):
    assert main(["profile", "--registry", registry_file], spark) == 1
    assert "FAIL" in capsys.readouterr().out
