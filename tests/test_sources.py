import pytest

from tabq.operators.labels import label
from tabq.plans import cleaning
from tabq.plans.reports import answers as all_answers
from tabq.plans.reports import retail
from tabq.plans.rules import airports as airport_rules
from tabq.sources import files, schemas


def test_schemas():
    assert len(schemas.COMMUNITIES) == 128 and len(set(schemas.COMMUNITIES.fieldNames())) == 128
    assert [len(s) for s in (schemas.AIRPORTS, schemas.PLANES, schemas.FLIGHTS, schemas.CENSUS,
                             schemas.RETAIL)] == [7, 9, 16, 15, 8]
    assert schemas.AIRPORTS["tz"].dataType.simpleString() == "float"
    assert schemas.AIRPORTS_WHOLE_HOURS["tz"].dataType.simpleString() == "int"
    assert "dest" in schemas.FLIGHTS_TEXT_TIMES.names and "destiny" in schemas.FLIGHTS.names
    assert set(f.dataType.simpleString() for f in schemas.as_text(schemas.PLANES)) == {"string"}


def test_csv_types_and_bad_fields(spark, tmp_path):
    path = tmp_path / "airports.csv"
    path.write_text("faa,name,lat,lon,alt,tz,dst\n04G,Lans Field,41.1,-80.6,1044,-5,A\n"
                    "X,,12O.12,,1044Aa,-5,\n")
    first, second = files.read_csv(spark, str(path), schemas.AIRPORTS).collect()
    assert (first.alt, first.tz, first.dst) == (1044, -5.0, "A")
    assert (second.name, second.lat, second.lon, second.alt, second.dst) == (None,) * 5
    as_text = files.read_csv(spark, str(path))
    assert set(t for _, t in as_text.dtypes) == {"string"}
    labels = label(as_text, airport_rules.rules()).collect()[1]
    assert (labels.qa_lat, labels.qa_alt, labels.qa_name) == ("A", "A", "M")


def test_csv_leading_blanks(spark, tmp_path):
    path = tmp_path / "census.csv"
    path.write_text("age,sex,hours\n39, Male, 40\n")
    schema = schemas.typed("age int, sex string, hours int")
    assert tuple(files.read_csv(spark, str(path), schema).first()) == (39, " Male", None)
    assert tuple(files.read_csv(spark, str(path), schema, trim=True).first()) == (39, "Male", 40)


def test_parquet_does_not_overwrite(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "n int, k string")
    path = str(tmp_path / "out")
    files.write_parquet(df, path, partition_by=["k"])
    assert [tuple(r) for r in files.read_parquet(spark, path).collect()] == [(1, "a")]
    with pytest.raises(Exception, match="(?i)exists"):
        files.write_parquet(df, path)


def test_handoff_under_its_own_name_keeps_both_versions(spark, tmp_path):
    first = files.handoff(spark.range(4).toDF("n"), "numbers", str(tmp_path))
    second = files.handoff(first.filter("n > 1"), "numbers", str(tmp_path))
    assert first.count() == 4 and second.count() == 2


def test_local_folders_are_told_from_shared_ones(spark):
    assert files.is_local("/tmp/x", spark) and files.is_local("file:///tmp/x", spark)
    assert not files.is_local("hdfs://store/x", spark)


def test_handoff_refuses_a_local_folder_on_a_cluster(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077", raising=False)
    with pytest.raises(ValueError, match="one machine"):
        files.handoff(spark.range(1), "numbers", str(tmp_path))


def test_handoff_and_view(spark, tmp_path):
    df = spark.createDataFrame([(1,), (2,)], "n int")
    shared = files.handoff(df, "numbers")
    assert shared.count() == 2
    assert files.handoff(df, "numbers", str(tmp_path)).count() == 2
    files.publish(numbers=shared)
    assert spark.sql("SELECT sum(n) FROM numbers").first()[0] == 3


def test_prepend_rows_turns_columns_to_text(spark):
    df = spark.createDataFrame([("X", 1.5)], "faa string, lat float")
    both = files.prepend_rows(df, [(None, "12O.12")])
    assert both.dtypes == [("faa", "string"), ("lat", "string")]
    assert [tuple(r) for r in both.collect()] == [(None, "12O.12"), ("X", "1.5")]


def test_from_csv_to_report(spark, tmp_path):
    """Scan, clean, hand over and answer all questions of one file."""
    path = tmp_path / "retail.csv"
    path.write_text(
        ",".join(schemas.RETAIL.fieldNames()) + "\n"
        '536365,71053,lamp,6,1/12/2010 08:26,"2,50",17850,UK\n'
        '536366,gift_0001_10,voucher,2,5/1/2011 10:02,"10,00",17851,France\n'
        '536367,8503S,sample,4,5/1/2011 10:02,1.25,17851,France\n'
        'C53636,PADS,pads,-6,1/12/2010 08:26,"2,50",17850,UK\n')
    raw = files.read_csv(spark, str(path), schemas.RETAIL)
    sales = files.handoff(cleaning.clean_sales(raw), "sales", str(tmp_path))
    answers = {k: [tuple(r) for r in df.collect()]
               for k, df in all_answers(retail.REPORTS, sales).items()}
    assert answers["rq01"] == [("20.00",)]
    assert answers["rq02"] == [(1, "10.00")]
    assert answers["rq03"] == [(4,)]
    assert answers["rq04"] == [("71053", 6)]
    assert answers["rq05"][0] == ("71053", 12, 6)
    assert answers["rq06"] == [(10, "25.00")]
    assert answers["rq07"] == [(1, "25.00")]
    assert answers["rq08"] == [("voucher", 1, "20.00")]
    assert answers["rq09"] == [("France", "25.00")]
    assert answers["rq10"] == []
    assert answers["rq11"] == [("536366", 20.0)]
    assert answers["rq12"] == [("536365", 6)]
    assert answers["rq13"] == [("17851", 2)]
