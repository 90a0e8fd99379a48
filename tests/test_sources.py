"""Sources and sinks on files the tests write."""

import json
import os
import random
import zipfile
from types import SimpleNamespace

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from doselens.functions.census import CENSUS_VARIABLES
from doselens.plans.build import build_marts
from doselens.sources import archives, documents, tables
from doselens.streaming import refresh as refresh_module
from doselens.streaming.refresh import refresh_quarters
from suite import bronze

OLD = "primaryid$age$gndr_cod\r\n1$40$M\r\n2$$F$extra\r\n3\r\n"
NEW = "primaryid$caseid$AGE$sex\n4$9$51$\"M\n5$10$caf\xe9$F"


def put(folder, quarter, members):
    path = folder / f"faers_ascii_{quarter}.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, text in members.items():
            archive.writestr(name, text.encode("latin-1"))
    return path


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    put(folder, "2012q1", {"__MACOSX/ascii/._DEMO12Q1.txt": "junk", "ascii/demo12q1.TXT": OLD,
                           "ascii/DRUG12Q1.txt": "caseid$drug_seq\n1$1\n"})
    put(folder, "2024Q2", {"ascii/DEMO24Q2.pdf": "x", "ascii/DEMO24Q2.txt": NEW,
                           "ascii/DEMO24Q2_old.txt": "a\n1\n"})
    put(folder, "2013q4", {"ascii/DRUG13Q4.txt": "caseid\n1\n"})
    (folder / "faers_ascii_2014q1.zip").write_bytes(b"not a zip")
    (folder / "readme.zip").write_bytes(b"other")
    return folder


def read(spark, landing, table, **options):
    return archives.read_archives(spark, str(landing), table, work=str(landing.parent), **options)


def status(spark, landing, table):
    unzipped = archives.unzip_archives(spark, str(landing), [table], work=str(landing.parent))
    return archives.archive_status(unzipped)


def by_id(frame):
    return {row.primaryid: row for row in frame.collect()}


EXPECTED = {
    "1": ("40", "M", None, None, 2012, 1), "2": (None, "F", None, None, 2012, 1),
    "3": (None, None, None, None, 2012, 1), "4": ("51", None, "9", '"M', 2024, 2),
    "5": ("caf\xe9", None, "10", "F", 2024, 2),
}


def test_archives_unite_headers(spark, landing):
    rows = by_id(read(spark, landing, "DEMO"))
    assert {k: (r.age, r.gndr_cod, r.caseid, r.sex, r.src_year, r.src_quarter)
            for k, r in rows.items()} == EXPECTED


def test_text_does_not_depend_on_chunk_size(landing, monkeypatch):
    def lines(size):
        monkeypatch.setattr(archives, "CHUNK_BYTES", size)
        with zipfile.ZipFile(landing / "faers_ascii_2024Q2.zip") as archive:
            found = list(archives._below_header(archives._chunks(archive, "ascii/DEMO24Q2.txt")))
        return {h for h, _ in found}, [l for _, text in found if text is not None for l in text.split("\n")]

    assert lines(1 << 20) == ({"primaryid$caseid$AGE$sex"}, ['4$9$51$"M', "5$10$caf\xe9$F"])
    for size in (1, 2, 3, 10):
        assert lines(size) == lines(1 << 20)


def test_archives_below_odd_folders_and_of_any_year(spark, tmp_path):
    folder = tmp_path / "with space [x]"
    folder.mkdir()
    put(folder, "2031q4", {"DEMO31Q4.txt": "a\n1\n"})
    assert [r.src_year for r in read(spark, folder, "DEMO").collect()] == [2031]
    with pytest.raises(ValueError):
        read(spark, folder, "DEMO", years=(2012, 2026))


def test_newest_archive_of_a_quarter_counts(spark, tmp_path):
    for name, text, time in (("old", "a\n1\n2\n3\n", 1_000_000_000), ("new", "a\n9\n", 1_100_000_000)):
        (tmp_path / name).mkdir()
        path = put(tmp_path / name, "2020q1_v2" if name == "new" else "2020q1", {"DEMO20Q1.txt": text})
        os.utime(path, (time, time))
    assert [r.a for r in read(spark, tmp_path, "DEMO").collect()] == ["9"]


def test_archives_beyond_the_limit_of_the_binary_reader(spark, landing):
    """The reader's limit, 2 GB as it stands, does not bind."""
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "10")
    try:
        rows = by_id(read(spark, landing, "DEMO"))
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    assert {k: (r.age, r.gndr_cod, r.caseid, r.sex, r.src_year, r.src_quarter)
            for k, r in rows.items()} == EXPECTED


def test_archives_come_through_cuts_as_they_are(spark, tmp_path, monkeypatch):
    lines = [f"{i}${'x' * (i % 90)}\x85\xff" for i in range(3000)]
    for quarter, how, comment in (("2020q1", zipfile.ZIP_STORED, b"end\n"), ("2020q2", zipfile.ZIP_DEFLATED, b"\n\n")):
        with zipfile.ZipFile(tmp_path / f"faers_ascii_{quarter}.zip", "w", how) as archive:
            archive.writestr("DEMO.txt", "\r\n".join(["a$b", *lines]).encode("latin-1"))
            archive.comment = comment
    (tmp_path / "faers_ascii_2020q3.zip").write_bytes(b"\n")
    monkeypatch.setattr(archives, "PART_BYTES", 100)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        unzipped = archives.unzip_archives(spark, str(tmp_path), "DEMO", work=str(tmp_path / "w"))
        found = archives.archive_table(unzipped, "DEMO").collect()
        told = {r.src_quarter: r.status for r in archives.archive_status(unzipped).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert told == {1: "LOADED", 2: "LOADED", 3: "LOAD_FAILED"}
    for quarter in (1, 2):
        own = [f"{r.a}${r.b}" for r in found if r.src_quarter == quarter]
        assert sorted(own) == sorted(lines)


def test_template_is_the_earliest_quarter(spark, landing):
    frame = read(spark, landing, "DEMO", from_first=True)
    assert frame.columns == ["primaryid", "age", "gndr_cod", "src_year", "src_quarter"]
    assert {k: r.age for k, r in by_id(frame).items()} == {k: v[0] for k, v in EXPECTED.items()}


def test_inventory_reports_every_archive(spark, landing):
    rows = status(spark, landing, "DEMO").collect()
    found = {(r.src_year, r.src_quarter): (r.status, r.row_count) for r in rows}
    assert found == {(2012, 1): ("LOADED", 3), (2024, 2): ("LOADED", 2),
                     (2013, 4): ("NO_MEMBER", 0), (2014, 1): ("LOAD_FAILED", 0)}
    newest = archives.learned_header(status(spark, landing, "DEMO"))
    assert newest == ["primaryid", "caseid", "AGE", "sex"]


def test_no_archives(spark, tmp_path):
    with pytest.raises(ValueError):
        read(spark, tmp_path, "DEMO")
    put(tmp_path, "2015q1", {"DRUG15Q1.txt": "a\n1\n"})
    with pytest.raises(ValueError):
        read(spark, tmp_path, "DEMO")


def test_damaged_member_gives_no_rows(spark, tmp_path):
    text = "primaryid$age\n" + "".join(f"{i}$40\n" for i in range(20000))
    path = put(tmp_path, "2015q1", {"DEMO15Q1.txt": text})
    data = bytearray(path.read_bytes())
    data[len(data) // 2] ^= 0xFF
    path.write_bytes(bytes(data))
    put(tmp_path, "2015q2", {"DEMO15Q2.txt": "primaryid$age\n1$2\n"})
    rows = status(spark, tmp_path, "DEMO").collect()
    assert {r.src_quarter: r.status for r in rows} == {1: "LOAD_FAILED", 2: "LOADED"}
    assert read(spark, tmp_path, "DEMO").count() == 1


def test_blank_lines_and_repeated_names(spark, tmp_path):
    put(tmp_path, "2015q1", {"DEMO15Q1.txt": "\n\na$A$$b\r\n1$2$3$4\r\n\r\n5\n\n"})
    frame = read(spark, tmp_path, "DEMO")
    assert frame.columns == ["a", "A_duplicated_0", "b", "src_year", "src_quarter"]
    rows = sorted([tuple(r)[:3] for r in frame.collect()], key=str)
    assert rows == [("1", "2", "4"), ("5", None, None), (None, None, None), (None, None, None)]
    assert status(spark, tmp_path, "DEMO").first().row_count == 4
    (tmp_path / "faers_ascii_2015q1").mkdir()
    unzipped = tmp_path / "faers_ascii_2015q1" / "DEMO.txt"
    unzipped.write_bytes(b"\na$A$$b\r\n1$2$3$4\r\n\r\n5\n\n")
    text = archives.read_text_tables(spark, [str(unzipped)])
    same = sorted([tuple(r)[:3] for r in text.collect()], key=str)
    assert same[:2] == rows[:2] and set(same) == set(rows)


def test_empty_member_is_told(spark, tmp_path):
    put(tmp_path, "2015q1", {"DEMO15Q1.txt": "\n\n"})
    put(tmp_path, "2015q2", {"DEMO15Q2.txt": "a$b\n"})
    rows = status(spark, tmp_path, "DEMO").collect()
    assert {r.src_quarter: (r.status, r.member, r.row_count) for r in rows} == {
        1: ("EMPTY", "DEMO15Q1.txt", 0), 2: ("LOADED", "DEMO15Q2.txt", 0)}


def test_choose_member():
    names = ["__MACOSX/DEMO.txt", "a/drug.txt", "a/demo.csv", "a/Demo1.TXT", "a/DEMO2.txt"]
    assert archives.choose_member(names, "DEMO") == "a/Demo1.TXT"
    assert archives.choose_member(names, "DEMO", skip_ignored=False) == "__MACOSX/DEMO.txt"
    assert archives.choose_member(names, "REAC") is None


def test_unzipped_members(spark, tmp_path):
    paths = []
    for quarter, text in (("2012q1", OLD), ("2024q2", NEW)):
        folder = tmp_path / f"faers_ascii_{quarter}"
        folder.mkdir()
        (folder / "DEMO.txt").write_bytes(text.encode("latin-1"))
        paths.append(str(folder / "DEMO.txt"))
    rows = by_id(archives.read_text_tables(spark, paths))
    assert {k: (r.age, r.gndr_cod, r.caseid, r.sex, r.src_year, r.src_quarter)
            for k, r in rows.items()} == EXPECTED


def refresh(spark, landing, tmp_path, **options):
    out, work = str(tmp_path / "bronze"), str(tmp_path / "work")
    record = refresh_quarters(spark, str(landing), ["DEMO", "DRUG"], out, work, **options)
    found = {(r.path.split("/")[-1][12:18].lower(), r.table_name): r for r in record.collect()}
    assert not list((tmp_path / "work").glob("unzipped*"))
    return found


def demo_rows(spark, tmp_path):
    return by_id(tables.read_quarters(spark, str(tmp_path / "bronze" / "demo_faers")))


def test_refresh_records_every_archive_and_reads_new_ones(spark, landing, tmp_path, monkeypatch):
    found = refresh(spark, landing, tmp_path)
    assert set(demo_rows(spark, tmp_path)) == set(EXPECTED)
    assert {k: (r.status, r.in_use) for k, r in found.items() if k[1] == "DEMO"} == {
        ("2012q1", "DEMO"): ("LOADED", True), ("2024q2", "DEMO"): ("LOADED", True),
        ("2013q4", "DEMO"): ("NO_MEMBER", False), ("2014q1", "DEMO"): ("LOAD_FAILED", False)}
    assert found["2013q4", "DRUG"].in_use
    put(landing, "2024q3", {"DEMO24Q3.txt": "primaryid$weight\n6$1\n"})
    opened = []
    unzip = refresh_module.unzip_archives
    monkeypatch.setattr(refresh_module, "unzip_archives",
                        lambda spark, paths, *rest: opened.extend(paths) or unzip(spark, paths, *rest))
    refresh(spark, landing, tmp_path)
    assert sorted(p[-10:-4] for p in opened) == ["2014q1", "2024q3"]
    rows = demo_rows(spark, tmp_path)
    assert set(rows) == {*EXPECTED, "6"}
    assert (rows["6"].weight, rows["1"].weight, rows["4"].caseid) == ("1", None, "9")


def test_refresh_retries_a_replaced_archive(spark, landing, tmp_path):
    assert refresh(spark, landing, tmp_path)["2014q1", "DEMO"].status == "LOAD_FAILED"
    put(landing, "2014q1", {"DEMO14Q1.txt": "primaryid$age\n14$1\n"})
    found = refresh(spark, landing, tmp_path)
    assert found["2014q1", "DEMO"].status == "LOADED" and found["2014q1", "DEMO"].in_use
    assert "14" in demo_rows(spark, tmp_path)
    path = put(landing, "2012q1", {"DEMO12Q1.txt": "primaryid$age\n77$1\n"})
    os.utime(path, (2_000_000_000, 2_000_000_000))
    refresh(spark, landing, tmp_path)
    assert set(demo_rows(spark, tmp_path)) == {"4", "5", "14", "77"}


def test_refresh_uses_one_archive_per_quarter(spark, tmp_path):
    landing = tmp_path / "landing"
    for name, text, time in (("new", "primaryid\n8\n9\n", 2), ("old", "primaryid\n1\n2\n3\n", 1)):
        (landing / name).mkdir(parents=True)
        path = put(landing / name, "2020q1", {"DEMO20Q1.txt": text})
        os.utime(path, (time * 10**9, time * 10**9))
    record = refresh_quarters(spark, str(landing), ["DEMO"], str(tmp_path / "bronze"), str(tmp_path))
    assert sorted((r.path.split("/")[-2], r.status, r.in_use) for r in record.collect()) == [
        ("new", "LOADED", True), ("old", "LOADED", False)]
    assert set(demo_rows(spark, tmp_path)) == {"8", "9"}


def test_refresh_records_years_that_are_not_covered(spark, landing, tmp_path):
    found = refresh(spark, landing, tmp_path, years=(2012, 2013))
    assert found["2024q2", "DEMO"].status == "NOT_COVERED" and not found["2024q2", "DEMO"].in_use
    assert set(demo_rows(spark, tmp_path)) == {"1", "2", "3"}
    assert refresh(spark, landing, tmp_path)["2024q2", "DEMO"].in_use
    assert set(demo_rows(spark, tmp_path)) == set(EXPECTED)


def test_shared_folder():
    def session(setting):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda name, default: setting))

    assert tables.shared_folder(session("/named")) == "/named"
    with pytest.raises(ValueError):
        tables.shared_folder(session(None))


def test_product_document_and_lines(spark, tmp_path):
    results = [{"application_number": f"NDA00000{i}", "submissions": [{"a": i}],
                "products": [{"brand_name": "B", "active_ingredients": [{"name": "n"}]}]}
               for i in range(3)]
    document = {"meta": {"last_updated": "2026-05-01", "other": 1}, "results": results}
    (tmp_path / "d.json").write_text(json.dumps(document, indent=1))
    (tmp_path / "l.jsonl").write_text("\n".join(json.dumps(r) for r in results))
    whole = documents.read_product_document(spark, str(tmp_path / "d.json"))
    lines = documents.read_product_lines(spark, str(tmp_path / "l.jsonl"), "2026-05-01")
    with zipfile.ZipFile(tmp_path / "d.zip", "w") as archive:
        archive.writestr("drugs.json", json.dumps({"results": results, "meta": document["meta"]}))
    zipped = documents.read_product_document(spark, str(tmp_path / "d.zip"))
    assert sorted(map(str, zipped.collect())) == sorted(map(str, whole.collect()))
    assert whole.first().meta.last_updated == "2026-05-01"
    assert whole.count() == 3 and lines.count() == 3
    numbers = [f.select(F.explode("results.application_number")).collect() for f in (whole, lines)]
    assert sorted(numbers[0]) == sorted(numbers[1]) and len(numbers[0]) == 3


def test_study_pages(spark, tmp_path):
    good = {"protocolSection": {"identificationModule": {"nctId": "N1"}}}
    bad = {"protocolSection": {"identificationModule": {"nctId": "N2"}, "designModule": "x"}}
    (tmp_path / "1.json").write_text(json.dumps({"studies": [good, bad], "nextPageToken": "t"}, indent=1))
    (tmp_path / "2.json").write_text(json.dumps({"studies": [good]}))
    (tmp_path / "3.json").write_text('{"studies": [')
    pages = documents.read_study_pages(spark, str(tmp_path))
    parsed = documents.parse_studies(pages)
    assert [r.nct_id for r in documents.clinical_trials(parsed).collect()] == ["N1", "N1"]
    assert [r.nct_id for r in documents.rejected_studies(parsed).collect()] == ["N2"]
    assert documents.rejected_pages(pages).count() == 1


def test_census_matrix(spark, tmp_path):
    header = [*CENSUS_VARIABLES, "state", "county"]
    rows = [[str(i) for i in range(22)] + ["01", "003"], [None] * 22 + [None, "005"]]
    (tmp_path / "m.json").write_text(json.dumps([header, *rows], indent=0))
    found = documents.read_census_matrix(spark, str(tmp_path / "m.json")).collect()
    assert found[0].fips_code == "01003" and found[0]["5_To_9_Population"] == "4"
    assert found[1].fips_code is None and found[1].Total_Population is None
    assert len(found[0]) == 25


def test_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name\n1,"a,b"\n2,\n')
    typed = tables.read_csv(spark, str(tmp_path / "a.csv"))
    assert dict(typed.dtypes) == {"id": "int", "name": "string"}
    assert [tuple(r) for r in typed.orderBy("id").collect()] == [(1, "a,b"), (2, None)]
    assert dict(tables.read_csv(spark, str(tmp_path / "a.csv"), infer_types=False).dtypes)["id"] == "string"


def test_template_load(spark, tmp_path):
    spark.createDataFrame([("1", "x")], "id string, name string").write.parquet(str(tmp_path / "a"))
    spark.createDataFrame([("y", 5, "2")], "NAME string, extra int, ID string").write.parquet(str(tmp_path / "b"))
    spark.createDataFrame([("3",)], "id string").write.parquet(str(tmp_path / "c"))
    paths = [str(tmp_path / n) for n in "abc"]
    one_scan = tables.load_from_template(spark, paths)
    united = tables.template_union([spark.read.parquet(p) for p in paths])
    for frame in (one_scan, united):
        assert frame.columns == ["id", "name"]
        assert sorted(map(tuple, frame.collect()), key=str) == [("1", "x"), ("2", "y"), ("3", None)]
    other = spark.createDataFrame([(7,), (8,)], "id int")
    text = tables.template_union([spark.read.parquet(paths[0]), other])
    assert {r.id for r in text.collect()} == {"1", "7", "8"}


def test_tolerant_load_reports_damaged_files(spark, tmp_path):
    for name in ("good", "bad"):
        spark.range(5).coalesce(1).write.parquet(str(tmp_path / name))
    spark.range(0).coalesce(1).write.parquet(str(tmp_path / "empty"))
    table = pa.table({"id": list(range(200_000)), "text": [str(i) for i in range(200_000)]})
    pq.write_table(table, tmp_path / "half.parquet", row_group_size=100_000, compression="none")
    place = pq.read_metadata(tmp_path / "half.parquet").row_group(1).column(0).dictionary_page_offset
    data = bytearray((tmp_path / "half.parquet").read_bytes())
    data[place : place + 2000] = b"\xff" * 2000
    (tmp_path / "half.parquet").write_bytes(bytes(data))
    files = [str(next((tmp_path / n).glob("part-*.parquet"))) for n in ("good", "bad", "empty")]
    with open(files[1], "wb") as damaged:
        damaged.write(b"PAR1 damaged")
    paths = [*files, str(tmp_path / "half.parquet")]
    found = {r.file.split("/")[-2] if "part-" in r.file else "half": (r.status, r.rows_parsed, r.rows_loaded)
             for r in tables.parquet_load_status(spark, paths).collect()}
    print(found)
    assert found == {"good": ("LOADED", 5, 5), "bad": ("LOAD_FAILED", 0, 0), "empty": ("LOADED", 0, 0),
                     "half": ("PARTIALLY_LOADED", 200_000, 100_000)}


def test_text_load_status(spark, tmp_path):
    (tmp_path / "good.csv").write_text("a,b\n1,2\n3,4\n")
    (tmp_path / "part.csv").write_text("a,b\n1,2\nx,4\n")
    rows = spark.read.schema("a int, b int, _corrupt_record string").csv(str(tmp_path), header=True)
    found = {r.file.split("/")[-1]: (r.status, r.rows_parsed, r.rows_loaded)
             for r in tables.load_status(rows).collect()}
    assert found == {"good.csv": ("LOADED", 2, 2), "part.csv": ("PARTIALLY_LOADED", 2, 1)}


def test_diagonal_union(spark):
    a = spark.createDataFrame([("1", "2")], "x string, y string")
    b = spark.createDataFrame([("3", "4")], "Y string, z string")
    united = tables.diagonal_union([a, b])
    assert united.columns == ["x", "y", "z"]
    assert sorted(map(tuple, united.collect()), key=str) == [("1", "2", None), (None, "3", "4")]


def test_quarters_replace_only_themselves(spark, tmp_path):
    path = str(tmp_path / "q")
    tables.write_quarters(spark.createDataFrame([("a", 2012, 1), ("b", 2012, 2)], "v string, src_year int, src_quarter int"), path)
    tables.write_quarters(spark.createDataFrame([("c", 2012, 2)], "v string, src_year int, src_quarter int"), path)
    assert {(r.v, r.src_quarter) for r in tables.read_quarters(spark, path).collect()} == {("a", 1), ("c", 2)}


def test_marts_are_tables(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    names = ["demo_faers", "drug_faers", "openfda_drugs", "census_fips", "clinical_trials"]
    built = build_marts({n: getattr(bronze, n)(spark, sf) for n in names}, "marts_test")
    assert len(built) == 7
    assert tables.source(spark, "dim_drug_faers", "marts_test").count() == 1340
    assert tables.source(spark, "stg_faers").count() == 842
    age = built["rpt_faers_age_distribution"]
    assert tables.to_client(age.limit(3)).num_rows == 3
    assert age.agg(F.sum("report_count")).first()[0] == 890
    tables.write_parquet(age, str(tmp_path / "age"))
    assert tables.read_parquet(spark, str(tmp_path / "age")).count() == age.count()
    again = build_marts({n: getattr(bronze, n)(spark, sf) for n in names}, "marts_test")
    assert again["dim_drug_faers"].count() == 1340


def test_first_bad_lines_of_files_in_several_splits(spark, tmp_path):
    rng = random.Random(8)
    expected = {}
    for name in ("a", "b", "c"):
        bad = set(rng.sample(range(2, 400), 5)) if name != "c" else set()
        lines = ["a,b", *["" if n % 50 == 0 and n not in bad else "x,oops" if n in bad else f"{n},{n * 7}" for n in range(2, 400)]]
        (tmp_path / f"{name}.csv").write_text("\n".join(lines) + ("\n" if name == "a" else ""))
        expected[name] = (399, len(bad), min(bad, default=None))
    (tmp_path / "empty.csv").write_text("")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
        found = tables.bad_lines(spark, [str(tmp_path)], lambda v: (v != "") & tables.malformed_csv("a int, b int", v), header=True)
        rows = {r.file.split("/")[-1][0]: (r.lines, r.bad_lines, r.first_bad_line) for r in found.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert rows == expected
    read = spark.read.schema("a int, b int, _corrupt_record string").csv(str(tmp_path), header=True)
    told = {r.file.split("/")[-1][0]: (r.status, r.first_bad_line) for r in tables.load_status(read, places=found).collect()}
    assert told == {n: ("LOADED" if n == "c" else "PARTIALLY_LOADED", place) for n, (_, _, place) in expected.items()}
    (tmp_path / "j.jsonl").write_text('{"a": 1}\n\n{"a": "x"}\n[\n')
    places = tables.bad_lines(spark, [str(tmp_path / "j.jsonl")], lambda v: tables.malformed_json("a int", v)).first()
    assert (places.lines, places.bad_lines, places.first_bad_line) == (4, 2, 3)


def test_bad_lines_of_texts_in_parts(spark, tmp_path):
    """Parts count in the order of their numbers, also beyond five digits."""
    for text, parts in {"a": {99_998: "1\n2\n", 99_999: "3\n", 100_000: "x\n5\nx\n"}, "b": {0: "", 2: "1\n", 10: "2\n"}}.items():
        (tmp_path / text).mkdir()
        for number, lines in parts.items():
            (tmp_path / text / f"part-{number:05}-u.txt").write_text(lines)
    found = tables.bad_lines(spark, [str(tmp_path / t) for t in "ab"], lambda v: v == "x", parts=True)
    rows = {r.file.rpartition("/")[2]: (r.lines, r.bad_lines, r.first_bad_line) for r in found.collect()}
    assert rows == {"a": (6, 2, 4), "b": (2, 0, None)}


def chain(spark, tmp_path, pages):
    for token, following in pages:
        body = {"studies": []} | ({"nextPageToken": following} if following else {})
        (tmp_path / f"page-{token}.json").write_text(json.dumps(body))
    found = documents.landed_pages(documents.read_study_pages(spark, str(tmp_path)))
    return {(r.fault, r.token, r.pages) for r in documents.chain_faults(found).collect()}


def test_a_whole_chain_of_pages_has_no_fault(spark, tmp_path):
    assert chain(spark, tmp_path, [("", "A b"), ("A b", "C=="), ("C==", None)]) == set()


def test_a_removed_page_is_told(spark, tmp_path):
    faults = chain(spark, tmp_path, [("", "B"), ("B", "C"), ("D", "E"), ("E", None)])
    assert faults == {("MISSING_PAGE", "C", 1), ("UNNAMED_PAGE", "D", 1)}


def test_broken_chains(spark, tmp_path):
    (tmp_path / "other.json").write_text('{"studies": []}')
    faults = chain(spark, tmp_path, [("B", "C"), ("C", "D"), ("D", "C")])
    assert faults == {("NO_FIRST_PAGE", None, 0), ("NO_LAST_PAGE", None, 0), ("UNNAMED_PAGE", "B", 1),
                      ("REPEATED_POINTER", "C", 2)}
    (tmp_path / "page-D.json").write_text('{"studies": [')
    (tmp_path / "page-.json").write_text('{"nextPageToken": "B"}')
    pages = documents.landed_pages(documents.read_study_pages(spark, str(tmp_path)))
    assert documents.chain_faults(pages).count() == 0
    both = pages.unionByName(pages.filter("page_token is null or page_token = 'D'"))
    assert {r.fault for r in documents.chain_faults(both).collect()} == {
        "SEVERAL_FIRST_PAGES", "SEVERAL_LAST_PAGES", "REPEATED_PAGE", "REPEATED_POINTER"}


def test_studies_on_two_pages_are_kept_once(spark):
    def study(key, day, extra=None):
        body = {"identificationModule": {"nctId": key}, "statusModule": {"lastUpdatePostDateStruct": {"date": day}}}
        return json.dumps({"protocolSection": body | (extra or {})})

    texts = [study("N1", "2020-01-01"), study("N1", "2021-05-01"), study("N1", "2021-05-01"), study("N2", "2019-01-01"),
             study("N2", "2022-01-01", {"designModule": None}), '{"protocolSection": {}}', '{"protocolSection": {}}']
    frame = spark.createDataFrame([(t,) for t in texts], "value string").select(F.array(F.parse_json("value")).alias("studies"))
    kept = documents.latest_studies(documents.parse_studies(frame))
    assert kept.columns == ["raw", "study", "rejected"]
    rows = documents.clinical_trials(kept).select("nct_id", "last_update_posted").collect()
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, [("N1", "2021-05-01"), ("N2", "2019-01-01"), (None, None), (None, None)]))
    # The pages are parsed in one pass, for studies with and without an id.
    assert kept._jdf.queryExecution().executedPlan().toString().count("Generate inline(") == 1
