import os
import tempfile

from riskfold.operators.clean import application_base, sentinel_profile, tag_dataset
from riskfold.sources import raw
from riskfold.sources.tables import file_sizes, read_csv_table

SCHEMA = "SK_ID_CURR long, NAME_CONTRACT_TYPE string, DAYS_BIRTH int, DAYS_EMPLOYED int, AMT_INCOME_TOTAL double"


def _csv(rows, header="SK_ID_CURR,NAME_CONTRACT_TYPE,DAYS_BIRTH,DAYS_EMPLOYED,AMT_INCOME_TOTAL"):
    d = tempfile.mkdtemp(prefix="riskfold-csv-")
    path = os.path.join(d, "application_test.csv")
    with open(path, "w", encoding="latin-1") as f:
        f.write(header + "\n")
        for r in rows:
            f.write(",".join("" if v is None else str(v) for v in r) + "\n")
    return path


def test_csv_scan_tag_and_null_target(spark):
    path = _csv([(1, " XNA ", -10000, 365243, 0.0), (2, "Cash loans", -12000, -100, 1000.0)])
    df = read_csv_table(spark, path, SCHEMA, columns=["SK_ID_CURR", "NAME_CONTRACT_TYPE", "DAYS_EMPLOYED"],
                        dataset="test", add_null_target=True)
    assert df.columns == ["dataset", "SK_ID_CURR", "NAME_CONTRACT_TYPE", "DAYS_EMPLOYED", "TARGET"]
    rows = df.orderBy("SK_ID_CURR").collect()
    assert rows[0]["TARGET"] is None and rows[0]["dataset"] == "test"
    sizes = file_sizes(spark, [path]).collect()
    assert sizes[0]["file_mb"] > 0


def test_sentinel_flag_only_when_present(spark):
    train = spark.createDataFrame([(1, "Cash loans", -10000, 365243, 0.0, 1), (2, "XNA", -9000, -5, 100.0, 0)],
                                  SCHEMA + ", TARGET int")
    test = spark.createDataFrame([(3, " Unknown ", -8000, -7, 50.0)], SCHEMA)
    prof = {r["column"]: r for r in sentinel_profile(tag_dataset(train, "train").unionByName(tag_dataset(test, "test"))).collect()}
    assert prof["DAYS_EMPLOYED"]["sentinel_count"] == 1 and prof["DAYS_BIRTH"]["created_flag"] is False
    base = application_base(train, test)
    assert "DAYS_EMPLOYED_SENTINEL_365243" in base.columns and "DAYS_BIRTH_SENTINEL_365243" not in base.columns
    r = {x["SK_ID_CURR"]: x for x in base.collect()}
    assert r[1]["DAYS_EMPLOYED"] is None and r[1]["employment_years"] is None
    assert r[2]["NAME_CONTRACT_TYPE"] is None and r[3]["NAME_CONTRACT_TYPE"] is None  # XNA / padded Unknown
    assert r[1]["credit_to_income_ratio"] is None if "credit_to_income_ratio" in base.columns else True


def test_every_line_that_does_not_fit_is_kept_and_counted(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,price,name\n1,2.5,x\n2,oops,y\n3,1.0\n4,2.0,z,extra\n\"5\",,\"q, \"\"r\"\"\"\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text("id,price,name\n6,1e3,é\n", encoding="utf-8")
    rows = raw.read_csv_checked(spark, str(tmp_path), "id long, price double, name string")
    counts = {r["source_file"]: (r["rows"], r["rejected"]) for r in raw.reject_counts(rows).collect()}
    assert counts == {"a.csv": (5, 3), "b.csv": (1, 0)}
    good = {tuple(r) for r in raw.accepted(rows).collect()}
    assert good == {(1, 2.5, "x"), (5, None, 'q, "r"'), (6, 1000.0, "é")}
    # the same lines are rejected whatever is selected
    assert raw.accepted(rows).select("id").count() == 3
    assert {r[0] for r in rows.filter("rejected_line IS NOT NULL").select("rejected_line").collect()} == {"2,oops,y", "3,1.0", "4,2.0,z,extra"}


def test_latin1_with_quoted_line_ends_and_separators(spark, tmp_path):
    data = [(1, 'a "quoted", é'), (2, "two\nlines ü"), (3, ""), (4, None)]
    path = str(tmp_path / "t")
    raw.write_csv(spark.createDataFrame(data, "id long, text string"), path, "ISO-8859-1")
    got = raw.accepted(raw.read_csv_checked(spark, path, "id long, text string", "ISO-8859-1", multi_line=True)).collect()
    assert {(r["id"], r["text"] or None) for r in got} == {(i, t or None) for i, t in data}


def test_inventory_of_missing_and_three_part_tables(spark, tmp_path):
    parts = spark.range(30).selectExpr("id AS SK_ID_CURR", "CAST(id % 3 = 0 AS INT) AS TARGET").repartition(3)
    parts.write.parquet(str(tmp_path / "three"))
    rows = {r["table"]: r for r in raw.inventory(spark, {"three": str(tmp_path / "three"), "gone": str(tmp_path / "gone")}).collect()}
    three, gone = rows["three"], rows["gone"]
    assert three["exists"] and three["rows"] == 30 and three["columns"] == 2 and three["bad_count"] == 10 and three["key_columns"] == "SK_ID_CURR"
    size = sum(os.path.getsize(p) for p in map(str, (tmp_path / "three").iterdir()))
    assert abs(three["file_mb"] - size / 2**20) < 0.01
    assert not gone["exists"] and gone["rows"] is None and gone["file_mb"] is None and gone["has_target"] is False
    assert raw.inventory(spark, {"gone": str(tmp_path / "gone")}).count() == 1


def test_descriptions(spark, tmp_path):
    text = 'No,Table,Row,Description,Special\n1,app.csv,AMT,"Betrag,\nü",normalized\n2,app.csv,AMT,"zweite",\n3,b.csv,X,,\n'
    (tmp_path / "doc.csv").write_bytes(text.encode("latin-1"))
    rows = raw.read_descriptions(spark, str(tmp_path / "doc.csv"), {"train": "app.csv", "test": "app.csv", "b": "b.csv"}).collect()
    assert sorted(map(tuple, rows)) == [("b", "X", "", ""), ("test", "AMT", "Betrag,\nü", "normalized"), ("train", "AMT", "Betrag,\nü", "normalized")]
