"""Landing routes, typed CSV reads, schema differences and quoted CSV writes."""

import datetime as dt
import tempfile
from pathlib import Path

from pyspark.sql import functions as F
from pyspark.sql import types as T

from onsetlake.operators import geo, quality
from onsetlake.sources import files, landing, sinks


def test_route_by_file_name(spark):
    df = spark.createDataFrame([("Data1_x.csv",), ("Data2_y.xlsx",), ("Data1_x.xlsx",), ("notes.txt",)], "f string")
    got = [r.d for r in df.select(landing.route(F.col("f")).alias("d")).collect()]
    assert got == ["data1_country_variants", "data2_country_indicators", None, None]


def test_land_files_and_inventory(spark):
    src = Path(tempfile.mkdtemp(prefix="onsetlake-landing-"))
    (src / "Data1_a.csv").write_text('"location","date"\n"A","01.01.2020"\n')
    (src / "other.bin").write_bytes(b"\x00\x01")
    out = tempfile.mkdtemp(prefix="onsetlake-raw-")
    plan = landing.land_files(spark, str(src), out, "20240102").collect()
    assert [(r.file_name, r.dataset, r.ingest_date) for r in plan] == [
        ("Data1_a.csv", "data1_country_variants", "20240102")]
    inv = {r.file_name: r.size_mb for r in landing.file_inventory(spark, str(src)).collect()}
    assert set(inv) == {"Data1_a.csv", "other.bin"} and inv["other.bin"] > 0


def test_landing_keeps_other_dates_and_datasets(spark):
    base = tempfile.mkdtemp(prefix="onsetlake-raw-")
    lines = spark.createDataFrame([("a",), ("b",)], "value string")
    landing.land_text(lines, base, "one", "20240101")
    landing.land_text(lines.limit(1), base, "one", "20240102")
    landing.land_text(lines, base, "two", "20240102")
    landing.land_text(lines.limit(1), base, "one", "20240102")
    count = lambda dataset, day: landing.read_partition(spark, base, dataset, day).count()
    assert [count("one", "20240101"), count("one", "20240102"), count("two", "20240102")] == [2, 1, 2]
    src = Path(tempfile.mkdtemp(prefix="onsetlake-landing-"))
    (src / "Data2_a.xlsx").write_bytes(b"PK")
    for day in ("20240101", "20240102"):
        landing.land_files(spark, str(src), base, day)
    files = [landing.read_landed_files(spark, base, "data2_country_indicators", day).count() for day in ("20240101", "20240102")]
    assert files == [1, 1] and count("one", "20240101") == 2


def test_typed_csv_and_quoted_write(spark):
    d = Path(tempfile.mkdtemp(prefix="onsetlake-csv-"))
    (d / "v.csv").write_text("location,date,variant,num_sequences,perc_sequences,num_sequences_total\n"
                             "A,06.07.2020,Alpha,1,33.3,3\nB,bad,Beta,x,1.0,2\n")
    rows = {r.location: r for r in files.read_csv_typed(spark, str(d / "v.csv")).collect()}
    assert rows["A"].date == dt.date(2020, 7, 6) and rows["A"].num_sequences == 1
    assert rows["B"].date is None and rows["B"].num_sequences is None
    out = tempfile.mkdtemp(prefix="onsetlake-out-")
    sinks.write_quoted_csv(spark.createDataFrame([("A", 1)], "a string, b int"), out)
    text = "".join(p.read_text() for p in Path(out).glob("*.csv"))
    assert '"A","1"' in text


def test_schema_differences_reads_schema_only(spark):
    df = spark.createDataFrame([("A", 1)], "location string, population int")
    want = T.StructType([T.StructField("location", T.StringType()), T.StructField("population", T.LongType()),
                         T.StructField("date", T.DateType())])
    assert quality.schema_differences(df, want) == [("population", "bigint", "int"), ("date", "date", "missing")]


def test_country_codes_stages(spark):
    ref = spark.createDataFrame([("Cabo Verde", None, "CPV"), ("Germany", "Deutschland", "DEU"),
                                 ("Netherlands", None, "NLD")], "name string, common_name string, code string")
    locs = spark.createDataFrame([("Cape Verde",), ("Deutschland",), ("Netherland",), ("Atlantis",)],
                                 "location string")
    got = {r.location: (r.code, r.match_kind) for r in geo.country_codes(locs, ref).collect()}
    assert got == {"Cape Verde": ("CPV", "exact"), "Deutschland": ("DEU", "common"),
                   "Netherland": ("NLD", "fuzzy"), "Atlantis": (None, None)}


def test_shuffle_partitions_sized_from_listing(spark):
    from onsetlake.session import size_shuffle_partitions

    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        n = size_shuffle_partitions(spark, ["/root/testdata/sf0.01"], bytes_per_partition=1 << 20, minimum=1)
        # about 3.8 MB of parquet in that folder -> 4 partitions of 1 MB
        assert n == 4 and spark.conf.get("spark.sql.shuffle.partitions") == "4"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
