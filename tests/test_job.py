"""The whole flow on landed files."""

import json
from types import SimpleNamespace

import pytest

from doselens import job, session
from doselens.functions.census import CENSUS_VARIABLES
from doselens.plans import reports
from test_sources import put

DEMO = "primaryid$i_f_code$event_dt$mfr_dt$init_fda_dt$fda_dt$rept_cod$mfr_num$mfr_sndr$age$age_cod$wt$wt_cod"
DRUG = ("caseid$drug_seq$role_cod$drugname$val_vbm$route$dose_vbm$cum_dose_chr$dechal$rechal$lot_nbr"
        "$exp_dt$nda_num$dose_amt$dose_unit$dose_form$dose_freq")


def demo(key, age, gender):
    return f"{key}$I$2020-01-02$$$$EXP$M1$MAKER${age}$YR$70$KG${gender}\n"


def drug(case, seq, number, dose):
    return f"{case}${seq}$PS$NAME$1$$$$$$$${number}${dose}$MG$TAB$QD\n"


def land(folder):
    for name in ("faers", "drugs", "census", "trials"):
        (folder / name).mkdir(parents=True)
    put(folder / "faers", "2013q1", {
        "DEMO13Q1.txt": f"{DEMO}$gndr_cod\n" + demo("11", 40, "M") + demo("21", 7, "F"),
        "DRUG13Q1.txt": f"{DRUG}\n" + drug(1, 1, "000001", "5 mg") + drug(2, 1, "000002", "1.2.3"),
        "REAC13Q1.txt": "primaryid$pt\n11$Rash\n"})
    put(folder / "faers", "2024q1", {
        "DEMO24Q1.txt": f"{DEMO}$sex\n" + demo("31", 200, "F"),
        "DRUG24Q1.txt": f"{DRUG}\n" + drug(3, 1, "000001", "1/2") + drug(9, 9, "N/A", "")})
    (folder / "drugs" / "d.json").write_text(json.dumps({
        "meta": {"last_updated": "2026-05-01"},
        "results": [{"application_number": f"NDA00000{n}", "submissions": [{"x": None}],
                     "products": [{"product_number": "001", "brand_name": f"B{n}", "route": "ORAL",
                                   "active_ingredients": [{"name": "X"}, {"name": "Y"}][:n]}]}
                    for n in (1, 2)]}))
    header = [*CENSUS_VARIABLES, "state", "county"]
    (folder / "census" / "c.json").write_text(json.dumps(
        [header, ["100"] * 22 + ["01", "001"], ["10"] * 22 + ["02", "001"]]))
    (folder / "trials" / "p.json").write_text(json.dumps({"studies": [
        {"protocolSection": {"identificationModule": {"nctId": "N1"},
                             "eligibilityModule": {"minimumAge": "18 Years", "sex": "ALL"}}},
        {"protocolSection": []}]}))
    (folder / "trials" / "q.json").write_text('{"studies": [')


def test_flow_from_files_to_reports(spark, tmp_path):
    landing, bronze, work = tmp_path / "landing", str(tmp_path / "bronze"), str(tmp_path / "work")
    land(landing)
    written = job.run(spark, str(landing), bronze, "marts_job", work)
    rows = written["dim_drug_faers"].collect()
    assert sorted((r.primary_id, r.age_in_years, r.gender, r.brand_name, r.active_ingredient_name, r.route)
                  for r in rows if r.gender) == [
        (11, 40, "M", "B1", "X", "ORAL"), (21, 7, "F", "B2", "X", "ORAL"),
        (21, 7, "F", "B2", "Y", "ORAL"), (31, None, "F", "B1", "X", "ORAL")]
    ages = written["rpt_faers_age_distribution"].groupBy("age_group", "gender").sum("report_count")
    assert sorted(map(tuple, ages.collect())) == [("35-44", "M", 1), ("5-9", "F", 2)]
    assert sum(r.report_count for r in written["rpt_faers_gender"].collect()) == 4
    figures = reports.headline(*[written[n] for n in (
        "rpt_faers_age_distribution", "rpt_census_demographics", "rpt_clinical_trials")]).first()
    assert (figures.total_reports, figures.total_population, figures.total_trials) == (3, 110, 1)
    assert {r.check_name: r.violations for r in written["data_checks"].collect()} == {
        "dose_amount_is_numeric": 1, "nda_number_is_numeric": 0, "age_is_realistic": 0,
        "raw_nda_num_is_numeric": 1, "raw_age_is_realistic": 1,
        "drug_key_fits_38_digits": 0, "report_key_fits_38_digits": 0}
    assert spark.read.parquet(f"{bronze}/reac_faers").count() == 1
    assert spark.read.parquet(f"{bronze}/rejected_studies").count() == 1
    assert spark.read.parquet(f"{bronze}/rejected_pages").count() == 1
    assert spark.read.parquet(f"{bronze}/openfda_drugs").count() == 2
    record = spark.read.parquet(f"{bronze}/load_status").collect()
    assert sorted((r.src_year, r.table_name, r.status) for r in record) == [
        (2013, "DEMO", "LOADED"), (2013, "DRUG", "LOADED"), (2013, "REAC", "LOADED"),
        (2024, "DEMO", "LOADED"), (2024, "DRUG", "LOADED"), (2024, "REAC", "NO_MEMBER")]
    assert not list((tmp_path / "work").glob("unzipped*"))

    put(landing / "faers", "2024q2", {"DEMO24Q2.txt": f"{DEMO}$sex\n" + demo("41", 41, "M"),
                                      "DRUG24Q2.txt": f"{DRUG}\n" + drug(4, 1, "000001", "1")})
    again = job.run(spark, str(landing), bronze, "marts_job", work)
    assert again["dim_drug_faers"].count() == len(rows) + 1


def test_session_of_the_command_line(monkeypatch):
    """The command line builds its session with the settings and folders it is given."""
    options = job.parsed_options(["in", "out", "--work", "/shared", "--warehouse", "/tables",
                                  "--shuffled-bytes", str(1 << 40), "--cores", "100"])
    settings = {}

    class Builder:
        def appName(self, name):
            return self

        def config(self, key, value):
            settings[key] = value
            return self

        def getOrCreate(self):
            return settings

    monkeypatch.setattr(session, "SparkSession", SimpleNamespace(builder=Builder()))
    assert job.session_for(options) is settings
    assert settings.items() >= session.SETTINGS.items()
    assert settings["spark.checkpoint.dir"] == "/shared"
    assert settings["spark.sql.warehouse.dir"] == "/tables"
    assert settings["spark.sql.shuffle.partitions"] == str((1 << 40) // session.PARTITION_BYTES)
    with pytest.raises(SystemExit):
        job.parsed_options(["in", "out"])
