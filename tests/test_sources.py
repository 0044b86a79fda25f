import pytest

from conftest import rows
from gapscope import labels as L
from gapscope.sources import (
    EFFECTIVE_VS_STATUTORY,
    export_csv,
    malformed_lines,
    read_csv_export,
    read_ingest_stamp,
    read_labelled_csv,
    read_table,
    write_table,
)


def land(path, text):
    import os

    os.makedirs(path, exist_ok=True)
    with open(f"{path}/part-0.csv", "w") as f:
        f.write(text)


def test_case_twin_headers_and_selection(spark, scratch):
    path = scratch("csv")
    land(path, "Reference area,Measure,MEASURE,Counterpart area,TIME_PERIOD,OBS_VALUE\nPL,Employees,EMP,DE,2020,5\n")
    allcols = read_labelled_csv(spark, path)
    assert allcols.columns == ["Reference area", "Measure", "MEASURE_2", "Counterpart area", "TIME_PERIOD", "OBS_VALUE"]
    picked = read_labelled_csv(spark, path, select=L.FACT_COLUMNS)
    assert rows(picked) == [("PL", "DE", "Employees", "2020", "5")]
    assert dict(picked.dtypes) == {c: "string" for c in picked.columns}


def test_missing_required_column(spark, scratch):
    path = scratch("csv")
    land(path, "Reference area,TIME_PERIOD\nPL,2020\n")
    with pytest.raises(ValueError, match="lacks the columns"):
        read_labelled_csv(spark, path, select=L.FACT_COLUMNS)


def test_files_of_one_landing_must_have_one_header(spark, scratch):
    path = scratch("csv")
    land(path, "a,b\n1,2\n")
    with open(f"{path}/part-1.csv", "w") as f:
        f.write("\ufeffa,b\r\n3,4\r\n")
    assert rows(read_labelled_csv(spark, path)) == [("1", "2"), ("3", "4")]
    with open(f"{path}/part-2.csv", "w") as f:
        f.write("b,a\n6,5\n")
    with pytest.raises(ValueError, match="part-2.csv has 'b,a'"):
        read_labelled_csv(spark, path)


def test_malformed_lines_are_counted(spark, scratch):
    path = scratch("csv")
    land(path, "a,b\n1,2\n1\n1,2,3\n4,5\n")
    counted = malformed_lines(spark, path).collect()
    assert [(r.file.rsplit("/", 1)[-1], r.n) for r in counted] == [("part-0.csv", 2)]


def test_scratch_needs_a_shared_folder_on_a_cluster(spark):
    from gapscope.session import scratch_root

    class Context:
        master = "spark://head:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda key, default: default)})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(Session())


def test_partitioned_write_makes_few_files(spark, scratch):
    import glob

    path = scratch("few")
    df = spark.range(0, 4000, 1, 16).selectExpr("id", "cast(id % 4 as int) as year")
    write_table(df, path, partition_by=["year"])
    assert len(glob.glob(f"{path}/year=*/*.parquet")) <= 8 and read_table(spark, path).count() == 4000


def test_missing_input(spark, scratch):
    with pytest.raises(FileNotFoundError):
        read_labelled_csv(spark, scratch("nothing_here"))


def test_side_file_stamp(spark, scratch):
    import os

    path = scratch("landing")
    os.makedirs(path)
    with open(f"{path}/_ingest_metadata.json", "w") as f:
        f.write('{"ingested_at_utc": "2026-01-15T08:30:00Z"}')
    land(path, "a\n1\n")
    import datetime as dt

    assert read_ingest_stamp(spark, path).first()[0] == dt.datetime(2026, 1, 15, 8, 30)
    assert read_labelled_csv(spark, path).count() == 1  # side file is not data


def test_table_and_csv_roundtrip(spark, scratch):
    vals = ("A", 2020, 1.5, 0.1, 3.0, 2.0, 1 / 3, 0.5, 25.0, 100 / 3, 25.0 - 100 / 3, "A_2020")
    df = spark.createDataFrame([vals, ("B", 2021) + (None,) * 9 + ("B_2021",)], EFFECTIVE_VS_STATUTORY)
    t = scratch("table")
    write_table(df, t, partition_by=["year"])
    assert rows(read_table(spark, t, EFFECTIVE_VS_STATUTORY)) == rows(df)
    c = scratch("csv_out")
    export_csv(df, c)
    assert rows(read_csv_export(spark, c, EFFECTIVE_VS_STATUTORY)) == rows(df)


def test_byte_order_mark_in_header(spark, scratch):
    import os

    path = scratch("bom")
    os.makedirs(path)
    with open(f"{path}/part-0.csv", "wb") as f:
        f.write(b"\xef\xbb\xbfReference area,TIME_PERIOD\nPL,2020\n")
    assert read_labelled_csv(spark, path).columns == ["Reference area", "TIME_PERIOD"]


def bytes_read(spark):
    """Bytes read from local files so far, by driver and tasks (one JVM)."""
    return sum(s.getBytesRead() for s in spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics())


def test_headers_cost_the_same_for_long_files(spark, scratch):
    path = scratch("long")
    land(path, "a,b\n" + "1,2\n" * 2_000_000)
    with open(f"{path}/part-1.csv", "w") as f:
        f.write("a,b\n")
    before = bytes_read(spark)
    scan = read_labelled_csv(spark, path)
    assert 0 < bytes_read(spark) - before < 100_000
    assert scan.count() == 2_000_000


def test_headers_long_quoted_compressed_or_missing(spark, scratch):
    import gzip

    from gapscope.sources import read_header

    path = scratch("headers")
    labels = [f"label {i}" for i in range(2000)] + ['with, comma "quoted"']
    line = ",".join([*labels[:-1], '"with, comma ""quoted"""'])
    land(path, f"\n{line}\n" + ",".join("x" * 2001) + "\n")
    with gzip.open(f"{path}/part-1.csv.gz", "wt") as f:
        f.write(f"{line}\r\n")
    with open(f"{path}/part-2.csv", "w"):
        pass  # an empty file has no header
    assert read_header(spark, path) == labels
    assert read_labelled_csv(spark, path).count() == 1
    empty = scratch("empty")
    land(empty, "")
    with pytest.raises(ValueError, match="No CSV header"):
        read_labelled_csv(spark, empty)
    endless = scratch("endless")
    land(endless, "x" * (3 << 20))
    with pytest.raises(ValueError, match="no line end"):
        read_labelled_csv(spark, endless)


def test_rejects_are_kept_whole_in_the_one_scan(spark, scratch):
    path = scratch("rejects")
    land(path, "a,b,c\n1,2,3\n1\n1,2,3,4\n,,\n4,5,\n")
    got = read_labelled_csv(spark, path, select={"a": "x"}, rejects="_line")
    assert rows(got) == [(None, None), ("1", None), ("1", "1"), ("1", "1,2,3,4"), ("4", None)]
    assert rows(got.where("_line is not null").select("_line")) == [("1",), ("1,2,3,4",)]
    assert got.where("_line is null").count() == 3
