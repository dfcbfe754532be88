"""Files in and out, database options, session settings."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import rows, values
from perkline.operators.checks import QualityError
from perkline.operators.cleaning import missing_to_null, rename_headers
from perkline.plans import people, reporting
from perkline.session import shared_dir
from perkline.sources import files, jdbc
from perkline import schemas

HR = """ID salarié,Nom,Prénom,Date de naissance,BU,Date d'embauche,Salaire brut,Type de contrat,Nombre de jours de CP,Adresse du domicile,Moyen de déplacement
1,Roux,Ana,1990-05-17,Finance,2019-01-02,30000.50,CDI,25,"1, rue du Lac",Marche/running
2,Lin,Bo,1985-11-30,Ventes,2020-03-04,41000,CDD,20,Nîmes,Vélo/Trottinette/Autres
"""
SPORT = """ID salarié,Pratique d'un sport
1,Runing
2,
3,Équitation
3,Équitation
"""


@pytest.fixture
def person_files(tmp_path):
    for name, text in (("hr", HR), ("sport", SPORT)):
        (tmp_path / f"{name}.csv").write_text(text, encoding="utf-8")
    return str(tmp_path / "hr.csv"), str(tmp_path / "sport.csv")


def test_person_files_become_typed_tables(spark, person_files):
    hr, sport = (files.read_delimited(spark, p) for p in person_files)
    staff = people.employees_from_file(hr)
    assert [(f.name, f.dataType) for f in staff.schema] == [
        (f.name, f.dataType) for f in schemas.EMPLOYEES
    ]
    first = staff.orderBy("employee_id").first()
    assert first["gross_salary"] == Decimal("30000.50") and first["birth_date"] == dt.date(1990, 5, 17)
    assert first["home_address"] == "1, rue du Lac"
    assert rows(people.profile_from_file(sport).distinct()) == [
        (("employee_id", 1), ("sport_type", "Running")),
        (("employee_id", 2), ("sport_type", None)),
        (("employee_id", 3), ("sport_type", "Équitation")),
    ]


def test_audit_of_person_files(spark, person_files):
    hr, sport = (files.read_delimited(spark, p) for p in person_files)
    report = {(r["section"], r["item"]): r["value"] for r in people.audit(hr, sport, "ID salarié").collect()}
    assert report[("rows", "left")] == 2 and report[("columns", "left")] == 11
    assert report[("repeated_rows", "right")] == 1 and report[("repeated_keys", "right")] == 1
    assert report[("nulls", "right.Pratique d'un sport")] == 1
    assert report[("missing_keys", "left")] == 1 and ("missing_keys", "right") not in report


def test_header_that_is_missing_is_named(spark):
    with pytest.raises(ValueError, match="Nom"):
        rename_headers(spark.createDataFrame([(1,)], "x int"), {"Nom": "last_name"})


def test_missing_markers(spark):
    df = spark.createDataFrame([("NaN",), ("  ",), ("",), (None,), ("Nantes",)], "s string")
    assert values(missing_to_null(df, "s").groupBy("s").count(), "s", "count") == {None: 4, "Nantes": 1}


def test_single_report_is_one_file(spark, folder):
    df = spark.createDataFrame([(1, "é, ü"), (2, None)], "id int, name string")
    for _ in range(2):  # can be made again
        path = files.write_report(df, folder, "names", single_file=True)
    assert path == f"{folder}/names.csv" and os.path.isfile(path)
    with open(path, encoding="utf-8") as file:
        assert file.readline().strip() == "id,name"
    assert sorted(os.listdir(folder)) in (["names.csv"], [".names.csv.crc", "names.csv"])
    back = spark.read.csv(path, header=True, schema="id int, name string")
    assert rows(back) == rows(df)


def test_the_form_of_a_report_does_not_depend_on_its_rows_and_is_there_once(spark, folder):
    for rows_written in (3, 2_000, 3):
        for single in (False, True):
            path = files.write_report(spark.range(rows_written, numPartitions=4), folder, "ids", single)
            assert path == f"{folder}/ids" + (".csv" if single else "")
            assert [f for f in os.listdir(folder) if not f.startswith(".")] == [os.path.basename(path)]
            assert spark.read.csv(path, header=True).count() == rows_written


def test_one_file_is_byte_equal_to_that_of_one_task(spark, folder):
    df = spark.range(3_000, numPartitions=7).select(
        F.col("id").alias("an, id"), F.when(F.col("id") % 5 > 0, F.concat(F.lit('é "q", '), F.col("id"))).alias("text"), F.lit("").alias("empty")
    )
    one = files.write_report(df.filter("`an, id` >= 900"), folder, "all", single_file=True)  # the first parts are empty
    files.write_delimited(df.filter("`an, id` >= 900").coalesce(1), f"{folder}/whole")
    (whole,) = [f for f in os.listdir(f"{folder}/whole") if f.startswith("part-")]
    with open(one, "rb") as mine, open(f"{folder}/whole/{whole}", "rb") as other:
        assert mine.read() == other.read()
    back = files.read_delimited(spark, one).collect()
    assert [int(r["an, id"]) for r in back] == list(range(900, 3_000))


def test_one_file_of_no_rows_has_its_header(spark, folder):
    one = files.write_report(spark.range(0).withColumn("name", F.lit("x")), folder, "none", single_file=True)
    with open(one, encoding="utf-8") as file:
        assert file.read() == "id,name\n"


def test_rows_of_one_file_are_written_by_all_tasks(spark, folder, monkeypatch):
    joined = []
    monkeypatch.setattr(files, "_join_parts", lambda s, folders, *_: joined.extend(os.listdir(folders[1])))
    files.write_report(spark.range(100, numPartitions=4), folder, "ids", single_file=True)
    assert len([f for f in joined if f.startswith("part-")]) == 4


def test_export_is_gated(spark, folder):
    benefits = spark.createDataFrame(
        [tuple([1] + [None] * 15)], ", ".join(f"{c} int" for c in schemas.BENEFIT_COLUMNS)
    )
    activities = spark.createDataFrame([], schemas.ACTIVITIES)
    with pytest.raises(QualityError):
        reporting.export_reports(benefits, activities, folder, expected_employees=161)
    with pytest.raises(QualityError):
        reporting.export_reports(benefits.union(benefits), activities, folder)
    assert os.listdir(folder) == []
    written = reporting.export_reports(benefits, activities, folder, 1, single_file=True)
    with open(written["activities"], encoding="utf-8") as file:
        assert "comment" not in file.read()


def test_one_file_of_benefits_leaves_activities_in_part_files(spark, folder):
    benefits = spark.createDataFrame([tuple([1] + [None] * 15)], ", ".join(f"{c} int" for c in schemas.BENEFIT_COLUMNS))
    activities = spark.range(6, numPartitions=3).select(F.col("id").alias("activity_id"))
    for f in spark.createDataFrame([], schemas.ACTIVITIES).schema:
        if f.name != "activity_id":
            activities = activities.withColumn(f.name, F.lit(None).cast(f.dataType))
    written = reporting.export_reports(benefits, activities, folder, 1, single_file=["employee_benefits"])
    assert os.path.isfile(written["employee_benefits"])
    assert len([f for f in os.listdir(written["activities"]) if f.startswith("part-")]) == 3


def test_database_options():
    db = jdbc.Database("jdbc:postgresql://h/db", {"user": "u", "driver": "org.postgresql.Driver"})
    assert jdbc.read_options(db, "public.t") == {
        "user": "u",
        "driver": "org.postgresql.Driver",
        "url": "jdbc:postgresql://h/db",
        "dbtable": "public.t",
    }
    split = jdbc.read_options(db, "t", jdbc.Split("id", 64, 1, 1000))
    assert split["partitionColumn"] == "id" and split["numPartitions"] == "64"
    assert (split["lowerBound"], split["upperBound"]) == ("1", "1000")
    with pytest.raises(ValueError):
        jdbc.read_options(db, "t", jdbc.Split("id", 64))
    assert jdbc.write_options(db, "t")["batchsize"] == "10000"


def test_shared_folder_is_the_named_one(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert first.startswith(root) and first != second
