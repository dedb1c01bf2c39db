import io
import zipfile

import pytest
from pyspark.sql import functions as F

from rowsmith.sources import files
from rowsmith.streaming import incremental


def test_exports(spark, tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    (d / "a.csv").write_bytes("Report\nx\nCompany Name,City,City\nCafé,Berea,Mail\n,none,\nB,\"Paris, KY\",\n".encode("cp1252"))
    with zipfile.ZipFile(d / "b.xlsx", "w") as z:
        m = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
        z.writestr("xl/sharedStrings.xml", f"<sst {m}><si><t>Company Name</t></si><si><t>City</t></si><si><t>Z Co</t></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {m}><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c></row><row><c r="A2" t="s"><v>2</v></c><c r="B2" t="inlineStr"><is><t>Troy</t></is></c></row></sheetData></worksheet>')
    out = files.read_exports(spark, str(d), "Company Name", ["Company Name", "City", "City (2)"])
    assert sorted(tuple(r)[2:] for r in out.collect()) == [("B", "Paris, KY", ""), ("Café", "Berea", "Mail"), ("Z Co", "Troy", "")]
    assert files.newest_files(spark, str(d)).count() == 1


def test_csv_json_and_backup(spark, tmp_path):
    p = tmp_path / "x.csv"
    p.write_text("﻿Name,Site\nA,\n", encoding="utf-8")
    assert [tuple(r) for r in files.read_csv(spark, str(p), ["name", "site"]).collect()] == [("A", "")]
    j = tmp_path / "x.json"
    j.write_text('{"data":{"items":[{"t":"A","u":"x"},{"t":" "}]}}\n')
    assert [tuple(r) for r in files.read_records(spark, str(j), "data.items", {"name": "t", "url": "u"}).collect()] == [("A", "x")]
    df = spark.range(3)
    assert files.backup({"t": df}, str(tmp_path / "b")).first().n == 3
    with pytest.raises(ValueError):
        files.backup({"t": df.where("false")}, str(tmp_path / "c"))
    files.write_csv(df, str(tmp_path / "w"), ["missing", "id"])
    assert spark.read.csv(str(tmp_path / "w"), header=True).columns == ["missing", "id"]


def test_two_micro_batches_are_one_batch(spark, tmp_path, data):
    subs = spark.read.parquet(f"{data}/submissions.parquet")
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    subs.where("id <= 20").coalesce(1).write.parquet(src)
    handle = lambda df, _: df.where("status = 'approved'").select("id").write.mode("append").parquet(out)
    incremental.stream(spark, src, subs.schema, handle, str(tmp_path / "cp"))
    subs.where("id > 20").coalesce(1).write.mode("append").parquet(src)
    incremental.stream(spark, src, subs.schema, handle, str(tmp_path / "cp"))
    got = sorted(r.id for r in spark.read.parquet(out).collect())
    assert got == sorted(r.id for r in subs.where("status = 'approved'").select("id").collect())


def test_state(spark):
    rows = spark.createDataFrame([(1,), (2,), (3,), (4,)], "id long")
    state = spark.createDataFrame([(1, "2025-01-01"), (2, "2024-11-01"), (3, "never")], "id long, checked_at string")
    assert sorted(r.id for r in incremental.due(rows, state, "id", "2025-01-02", 25).collect()) == [2, 3, 4]
    units = spark.createDataFrame([("a", 1), ("b", 1)], "q string, c int")
    assert [r.q for r in incremental.pending(units, units.where("q = 'a'"), ["q", "c"]).collect()] == ["b"]


def test_late_rows_across_ranges(spark):
    rows = [(i, f"2025-01-01 00:00:{i % 60:02d}") for i in range(0, 3_000, 7)]
    df = spark.createDataFrame(rows, "id long, at string").select("id", F.col("at").cast("timestamp").alias("at"))
    top, want = None, []
    for i, t in sorted(rows):
        if top and t < top:
            want.append(i)
        top = max(top or t, t)
    assert sorted(r.id for r in incremental.late_rows(df, "id", "at").collect()) == want


def test_public_view_hides_people(spark, data):
    assert not {"submitter_name", "submitter_email"} & set(incremental.public_view(spark.read.parquet(f"{data}/submissions.parquet")).columns)
