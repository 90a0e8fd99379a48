"""Flattening, group-by labels, checks and report queries on small tables."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from doselens.operators import aggregates as agg
from doselens.operators import checks, flatten
from doselens.operators.joins import on_spine
from doselens.plans import marts, reports, staging
from doselens.sources import documents

DOCUMENTS = [
    """{"meta": {"last_updated": "2026-05-01"}, "results": [
        {"application_number": "NDA000001", "reportnumber": "r1", "products": []},
        {"application_number": "NDA000002", "products": [{"product_number": "001",
            "brand_name": "B", "active_ingredients": []}],
         "submissions": [{"a": 1, "b": null}, {"c": {"d": [1]}}]},
        {"application_number": "NDA000003"},
        {"application_number": "NDA000004", "products": [
            {"product_number": "001", "brand_name": "C", "active_ingredients":
                [{"name": "X", "strength": "1MG"}, {"name": "Y"}]},
            {"product_number": "002", "brand_name": "D", "active_ingredients": [{"name": "X"}]}]}]}""",
]


@pytest.fixture(scope="module")
def openfda(spark):
    text = spark.createDataFrame([(d,) for d in DOCUMENTS], "value string")
    return text.select(F.from_json("value", flatten.PRODUCT_DOCUMENT).alias("d")).select("d.*")


def test_product_rows(openfda):
    rows = staging.stg_openfda_drugs(openfda).orderBy("product_number", "active_ingredient_name")
    found = [(r.application_number, r.brand_name, r.active_ingredient_name,
              r.active_ingredient_strength) for r in rows.collect()]
    assert found == [(4, "C", "X", "1MG"), (4, "C", "Y", None), (4, "D", "X", None)]


def test_submission_fields_keep_null_and_unknown_keys(openfda):
    rows = staging.stg_openfda_values(openfda, id_field="application_number")
    found = {(r.report_id, r.field_name, r.v) for r in rows.select(
        "report_id", "field_name", F.col("field_value").cast("string").alias("v")).collect()}
    assert found == {("NDA000002", "a", "1"), ("NDA000002", "b", None),
                     ("NDA000002", "c", '{"d":[1]}')}


def study_frame(spark, *texts):
    text = spark.createDataFrame([(t,) for t in texts], "value string")
    pages = text.select(F.array(F.parse_json("value")).alias("studies"))
    return documents.parse_studies(pages)


def test_study_lists(spark):
    parsed = study_frame(spark, """{"protocolSection": {
        "designModule": {"phases": ["PHASE1", "PHASE2"], "enrollmentInfo": {"count": 5}},
        "conditionsModule": {"conditions": []},
        "contactsLocationsModule": {"locations": [{"city": "x"}, {"country": "FR"}]},
        "armsInterventionsModule": {"interventions": [
            {"name": "a", "type": "DRUG"}, {"type": "DRUG"}, {"name": "c"}]}}}""")
    row = documents.clinical_trials(parsed).first()
    assert (row.phases, row.conditions, row.std_ages) == ("PHASE1|PHASE2", "", "")
    assert (row.intervention_names, row.intervention_types) == ("a||c", "DRUG|DRUG|")
    assert row.drug_interventions == "a|"
    assert (row.location_count, row.first_location_country, row.primary_outcome) == (2, None, None)
    assert len(row) == 34


@pytest.mark.parametrize("section", [
    '[1]', 'null', '"x"', '{"designModule": null}', '{"designModule": []}',
    '{"designModule": {"phases": null}}', '{"designModule": {"phases": [1]}}',
    '{"designModule": {"phases": ["PHASE1", null]}}',
    '{"statusModule": {"startDateStruct": "2020"}}',
    '{"armsInterventionsModule": {"interventions": ["x"]}}',
    '{"armsInterventionsModule": {"interventions": [{"name": null}]}}',
    '{"contactsLocationsModule": {"locations": ["x"]}}',
])
def test_malformed_study_is_rejected(spark, section):
    parsed = study_frame(spark, f'{{"protocolSection": {section}}}', '{"protocolSection": {}}', "{}")
    assert [r.rejected for r in parsed.select("rejected").collect()] == [True, False, False]
    assert documents.rejected_studies(parsed).count() == 1
    assert documents.clinical_trials(parsed).count() == 2


def trial_rows(spark, rows):
    """A study dimension with the columns the report reads."""
    return spark.createDataFrame(rows, """eligible_sex string, enrollment bigint,
        lead_sponsor_class string""").select(
        "*", F.lit("COMPLETED").alias("overall_status"), F.lit("Phase 1").alias("phase_bucket"),
        F.lit("X").alias("study_type"), F.lit("FR").alias("first_location_country"),
        F.lit(False).alias("is_industry_sponsored"), F.lit(True).alias("has_drug_intervention"),
        F.lit(20).alias("minimum_age_years"), F.lit(None).cast("int").alias("study_duration_days"),
        F.lit(1).cast("bigint").alias("location_count"))


def test_trial_measures(spark):
    row = marts.rpt_clinical_trials(
        trial_rows(spark, [("ALL", 1, "NIH"), ("ALL", 2, "NIH"), ("ALL", None, "NIH")])).first()
    assert (row.study_count, row.total_enrollment, row.avg_enrollment, row.median_enrollment) == (
        3, 3, 1.5, 1.5)
    assert (row.avg_duration_days, row.total_locations, row.drug_study_count) == (None, 3, 3)


def test_null_key_and_equal_label_stay_two_rows(spark):
    rows = marts.rpt_clinical_trials(trial_rows(spark, [("ALL", 1, "OTHER"), (None, 1, "OTHER")]))
    assert [(r.eligible_sex, r.study_count) for r in rows.collect()] == [("ALL", 1), ("ALL", 1)]


def test_labelled_key_merges(spark):
    rows = marts.rpt_clinical_trials(trial_rows(spark, [("ALL", 1, "OTHER"), ("ALL", 1, None)]))
    assert [(r.sponsor_class, r.study_count) for r in rows.collect()] == [("OTHER", 2)]


def test_checks(spark):
    rows = [("7/0", None), ("1.2.3", None), ("5 mg/ml", None), ("UNKNOWN", None), (None, None),
            ("5 mg", Decimal("5"))]
    frame = spark.createDataFrame(rows, "dose_amt_raw string, dose_amount decimal(18,8)")
    found = checks.violations(frame, checks.dose_unparsed(), "dose_amt_raw").collect()
    assert {r.dose_amt_raw for r in found} == {"7/0", "1.2.3", "5 mg/ml"}
    counted = checks.summary(frame, {"dose": checks.dose_unparsed()}).collect()
    assert [(r.check_name, r.violations) for r in counted] == [("dose", 3)]
    ages = spark.createDataFrame([(-1,), (0,), (131,), (None,)], "age_in_years bigint")
    assert ages.filter(checks.age_out_of_range()).count() == 2
    numbers = spark.createDataFrame([("N/A",), ("012",), (None,)], "nda_num string")
    assert numbers.filter(checks.not_a_number("nda_num")).count() == 1


def empty_reports(spark):
    age = spark.createDataFrame([], """age_group string, report_count bigint, source_year int,
        gender string, active_ingredient_name string, brand_name string""")
    people = ", ".join(f"{c} bigint" for c in reports.POPULATION)
    census = spark.createDataFrame([], f"{people}, state_abbreviation string")
    trials = spark.createDataFrame([], """overall_status string, phase_bucket string,
        eligible_sex string, eligibility_age_bucket string, study_count bigint""")
    return age, census, trials


def test_reports_of_nothing(spark):
    age, census, trials = empty_reports(spark)
    row = reports.headline(age, census, trials).first()
    assert row.asDict() == {"total_reports": 0, "total_population": 0, "age_groups": 0,
                            "total_trials": 0, "reports_per_100k": None}
    compared = reports.age_comparison(age, census).collect()
    assert [r.age_group for r in compared] == reports.AGE_LABELS
    assert {(r.faers_pct, r.census_pct) for r in compared} == {(0.0, 0.0)}
    three = reports.age_three_way(age, census, trials).collect()
    assert [(r.census_pct, r.faers_pct, r.trials_pct) for r in three] == [(0.0, 0.0, 0.0)] * 3


def test_shares_and_rates(spark):
    frame = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), (None, 4)], "k string, n bigint")
    totals = agg.label_totals(frame, "k", ["a", "b"], "n", "everything")
    found = agg.shares(totals, {"a": "A", "b": "B"}, "everything", "k", "pct").collect()
    assert [(r.k, r.pct) for r in found] == [("A", 37.5), ("B", 12.5)]
    buckets = agg.bucket_shares(totals, {"x": ["a"], "y": ["b"]}, "k", "pct").collect()
    assert [(r.k, r.pct) for r in buckets] == [("x", 75.0), ("y", 25.0)]
    assert frame.agg(agg.distinct_values("k").alias("n")).first().n == 3
    assert frame.limit(0).agg(agg.distinct_values("k").alias("n")).first().n == 0
    assert agg.regrouped(frame, "k", "n").count() == 3


def test_spine_keeps_order_and_fills(spark):
    spine = reports.label_spine(spark, "k", ["z", "a"])
    side = spark.createDataFrame([("a", 5.0)], "k string, v double")
    rows = on_spine(spine, "k", side).orderBy("position").collect()
    assert [(r.k, r.v) for r in rows] == [("z", 0.0), ("a", 5.0)]


def test_no_filter_keeps_all(spark):
    age, _, _ = empty_reports(spark)
    assert reports.select_faers(age) is age


def small_bronze(spark):
    """Two quarters with one hot report id, one hot drug and one hot application."""
    demo = [("11" if i % 3 == 0 else f"{i}1", str(i % 90), "YR", "M" if i % 2 else None, "F")
            for i in range(60)]
    drug = [("1" if i % 3 == 0 else str(i), "1", "000007" if i % 2 else f"{i % 5:06d}", 2012 + i % 2)
            for i in range(90)]
    demo_faers = spark.createDataFrame(demo, """primaryid string, age string, age_cod string,
        sex string, gndr_cod string""")
    drug_faers = spark.createDataFrame(drug, "caseid string, drug_seq string, nda_num string, src_year int")
    absent = lambda names: [F.lit(None).cast("string").alias(n) for n in names]
    demo_faers = demo_faers.select("*", *absent(
        ["i_f_code", "event_dt", "mfr_dt", "init_fda_dt", "fda_dt", "rept_cod", "mfr_num",
         "mfr_sndr", "wt", "wt_cod"]))
    drug_faers = drug_faers.select("*", F.lit(1).alias("src_quarter"), *absent(
        ["role_cod", "drugname", "val_vbm", "route", "dose_vbm", "cum_dose_chr", "dechal", "rechal",
         "lot_nbr", "exp_dt", "dose_amt", "dose_unit", "dose_form", "dose_freq"]))
    rows = [(7 if i % 2 else i % 5, f"ing{i % 3}", f"brand{i % 4}") for i in range(40)]
    products = spark.createDataFrame(
        rows, "application_number bigint, active_ingredient_name string, brand_name string")
    products = products.select("*", *absent(
        [n for n in [*staging.PRODUCT_TEXTS, "application_type", "active_ingredient_strength",
                     "sponsor_name"] if n != "brand_name"]),
        F.lit(1).cast("bigint").alias("product_number"),
        F.lit(None).cast("timestamp_ntz").alias("last_updated"))
    return demo_faers, drug_faers, products


def test_counted_reports_equal_plain_reports_under_hot_keys(spark):
    demo, drug, products = small_bronze(spark)
    dim = marts.dim_drug_faers(staging.stg_faers(demo, drug), products)
    plain = marts.rpt_faers_age_distribution(dim)
    counted = marts.rpt_faers_age_distribution_counted(demo, drug, products)
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(plain.collect(), key=key) == sorted(counted.collect(), key=key)
    plain, counted = marts.rpt_faers_gender(dim), marts.rpt_faers_gender_counted(demo, drug, products)
    assert sorted(plain.collect(), key=key) == sorted(counted.select(plain.columns).collect(), key=key)
    assert dim.count() == plain.agg(F.sum("report_count")).first()[0] > 1000


def test_age_report_is_ordered_by_youngest(spark):
    demo, drug, products = small_bronze(spark)
    dim = marts.dim_drug_faers(staging.stg_faers(demo, drug), products)
    groups = [r.age_group for r in marts.rpt_faers_age_distribution(dim, ordered=True).collect()]
    positions = [reports.AGE_LABELS.index(g) for g in groups]
    assert positions == sorted(positions)


def test_other_drug_key(spark):
    demo, drug, products = small_bronze(spark)
    keyed = drug.withColumn("primaryid", F.lit("11"))
    joined = staging.stg_faers(demo, keyed, drug_key=F.col("primaryid"))
    assert joined.count() == demo.filter("primaryid = '11'").count() * drug.count()


def test_null_ingredient_and_equal_label_stay_two_rows(spark):
    rows = [("M", 2020, None, "B", 40, 1), ("M", 2020, "UNKNOWN", "B", 40, 2), (None, None, "X", None, None, 3)]
    dim = spark.createDataFrame(rows, """gender string, source_year int, active_ingredient_name string,
        brand_name string, age_in_years int, primary_id bigint""")
    expected = [("M", 2020, "UNKNOWN", "B", 1), ("M", 2020, "UNKNOWN", "B", 1), ("UNK", -1, "X", "UNKNOWN", 1)]
    for report in (marts.rpt_faers_gender(dim), marts.gender_report(marts.report_cells(dim))):
        assert sorted(map(tuple, report.collect())) == expected
    age = marts.rpt_faers_age_distribution(dim).collect()
    assert [(r.age_group, r.active_ingredient_name, r.report_count) for r in age] == [
        ("35-44", "UNKNOWN", 1)] * 2


def test_long_ids_join(spark):
    """Ids of 20 and 38 digits, one apart, keep their rows and their partners."""
    demo, drug, products = small_bronze(spark)
    ids = ["9" * 20, "9" * 19 + "8", "1" * 38, "1" * 37 + "2"]
    many = spark.createDataFrame([(i,) for i in ids], "key string")
    demo = demo.limit(1).drop("primaryid").crossJoin(many).withColumnRenamed("key", "primaryid")
    drug = drug.limit(1).drop("caseid", "drug_seq").crossJoin(many).select(
        "*", F.expr("left(key, length(key) - 1)").alias("caseid"), F.expr("right(key, 1)").alias("drug_seq"))
    joined = staging.stg_faers(demo, drug)
    assert sorted(str(r.primary_id) for r in joined.collect()) == sorted(ids)
    dim = marts.dim_drug_faers(joined.withColumn("nda_number", F.lit("9" * 30).try_cast("decimal(38,0)")), products)
    assert dim.count() == 0
