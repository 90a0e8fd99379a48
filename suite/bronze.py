"""Bronze-shaped views over the given tables.

The given tables hold no drug data, so reports, products, counties and studies
are derived from them row by row. Nothing is joined or filtered here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from doselens.functions.census import POPULATION_COLUMNS
from doselens.operators.flatten import flatten_studies
from doselens.sources.tables import read_parquet


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet")


def _by(remainder: Column, values: dict[int, object], otherwise: object = None) -> Column:
    """The value listed for a remainder."""
    chain = F
    for number, value in values.items():
        chain = chain.when(remainder == number, value)
    return chain.otherwise(otherwise)


def _text(value: Column) -> Column:
    return value.cast("string")


def _padded(value: Column, width: int) -> Column:
    return F.lpad(_text(value), width, "0")


def demo_faers(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    key, customer, day = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate")
    iso, compact = F.date_format(day, "yyyy-MM-dd"), F.date_format(day, "yyyyMMdd")
    return orders.select(
        F.concat(_text(key), _text(customer % 7 + 1)).alias("primaryid"),
        F.col("o_orderstatus").alias("i_f_code"),
        F.when(key % 5 == 0, F.date_format(day, "yyyyMM")).otherwise(iso).alias("event_dt"),
        F.when(key % 3 == 0, compact).otherwise(iso).alias("mfr_dt"),
        iso.alias("init_fda_dt"),
        compact.alias("fda_dt"),
        F.col("o_orderpriority").alias("rept_cod"),
        F.concat(F.lit("MFR-"), _text(customer)).alias("mfr_num"),
        F.concat(F.lit("MAKER "), _text(customer % 40)).alias("mfr_sndr"),
        _by(key % 11, {0: None, 1: "UNK", 2: "2.5"}, _text(key % 97)).alias("age"),
        _by(key % 13, {0: "DY", 1: "MON", 2: "DEC", 3: "WK", 4: "HR", 5: None}, "YR").alias("age_cod"),
        _by(customer % 5, {0: "M", 1: "F", 2: "UNK"}).alias("sex"),
        _by(customer % 3, {0: "M", 1: "F"}, "NS").alias("gndr_cod"),
        F.when(key % 17 == 0, "n/a").otherwise(F.concat(_text(key % 150), F.lit(".5"))).alias("wt"),
        _by(key % 4, {0: "KG", 1: "G", 2: "LBS"}, "XX").alias("wt_cod"),
        F.year(day).alias("src_year"),
        F.quarter(day).alias("src_quarter"),
    )


def drug_faers(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem")
    part, line, day = F.col("l_partkey"), F.col("l_linenumber"), F.col("l_shipdate")
    amount = F.col("l_quantity").cast("int")
    quantity = _text(amount)
    doses = {
        0: F.concat(quantity, F.lit(" mg")),
        1: F.concat_ws("/", quantity, _text(part % 4)),
        2: F.concat_ws("-", quantity, _text(amount + 5)),
        3: "UNKNOWN",
        4: F.concat(quantity, F.lit(".25")),
        5: "5 mg/ml",
        6: "1.2.3",
    }
    return lines.select(
        _text(F.col("l_orderkey")).alias("caseid"),
        _text(line).alias("drug_seq"),
        F.col("l_returnflag").alias("role_cod"),
        F.concat(F.lit("DRUG "), _text(part % 500)).alias("drugname"),
        _text(line % 3 + 1).alias("val_vbm"),
        F.when(part % 4 != 0, F.col("l_linestatus")).alias("route"),
        F.concat(quantity, F.lit(" units")).alias("dose_vbm"),
        quantity.alias("cum_dose_chr"),
        _by(part % 3, {0: "Y", 1: "N"}, "U").alias("dechal"),
        _by(part % 5, {0: "Y", 1: "N"}).alias("rechal"),
        F.concat(F.lit("LOT"), _text(F.col("l_suppkey"))).alias("lot_nbr"),
        F.date_format(day, "yyyy-MM-dd").alias("exp_dt"),
        F.when(part % 19 == 0, "N/A").when(part % 23 != 0, _padded(part, 6)).alias("nda_num"),
        _by((part + line) % 8, doses).alias("dose_amt"),
        _by(part % 2, {0: "MG"}).alias("dose_unit"),
        _by(part % 6, {0: "TABLET", 1: "CAPSULE"}, "OTHER").alias("dose_form"),
        _by(line % 2, {0: "BID", 1: "QD"}).alias("dose_freq"),
        F.year(day).alias("src_year"),
        F.quarter(day).alias("src_quarter"),
    )


def openfda_drugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ``{meta, results}`` document per part, each with one result."""
    key, kind = F.col("p_partkey"), F.col("p_type")
    ingredients = F.transform(
        F.split("p_name", " "),
        lambda word: F.struct(
            word.alias("name"), F.concat(_text(F.col("p_size")), F.lit("MG")).alias("strength")
        ),
    )
    product = F.struct(
        F.lit("001").alias("product_number"),
        F.col("p_brand").alias("brand_name"),
        kind.alias("dosage_form"),
        _by(key % 3, {0: "Prescription", 1: "Discontinued"}, "None").alias("marketing_status"),
        _by(key % 2, {0: "Yes"}, "No").alias("reference_drug"),
        _by(key % 7, {0: "Yes"}, "No").alias("reference_standard"),
        _by(key % 5, {0: "AB"}).alias("te_code"),
        F.lit("ORAL").alias("route"),
        ingredients.alias("active_ingredients"),
    )
    products = F.array(product)
    submission = F.struct(
        kind.alias("submission_type"),
        _text(F.col("p_size")).alias("submission_number"),
        F.when(key % 3 != 0, "AP").alias("submission_status"),
    )
    application = F.when(
        key % 10 == 0, F.concat(F.lit("BLA"), _padded(key, 5))
    ).otherwise(F.concat(F.lit("NDA"), _padded(key, 6)))
    result = F.struct(
        application.alias("application_number"),
        F.concat(F.lit("SPONSOR "), _text(key % 30)).alias("sponsor_name"),
        _text(key).alias("reportnumber"),
        F.when(key % 29 == 0, F.slice(products, 1, 0)).otherwise(products).alias("products"),
        F.array(F.to_variant_object(submission)).alias("submissions"),
    )
    return _table(spark, sf_dir, "part").select(
        F.struct(F.lit("2026-05-01").alias("last_updated")).alias("meta"),
        F.array(result).alias("results"),
    )


def census_fips(spark: SparkSession, sf_dir: str, *kept: str) -> DataFrame:
    """Counties; ``kept`` names columns of the given table to keep beside them."""
    key = F.col("c_custkey")
    counts = [
        F.when((key + k) % 31 == 0, F.lit(" "))
        .otherwise(F.concat(F.lit(" "), _text((key * k) % 5000)))
        .alias(name)
        for k, name in enumerate(POPULATION_COLUMNS, start=1)
    ]
    state = _padded(F.col("c_nationkey") + 1, 2)
    county = _padded(key % 1000, 3)
    return _table(spark, sf_dir, "customer").select(
        *counts, state.alias("state"), county.alias("county"),
        F.concat(state, county).alias("fips_code"), *kept,
    )


def studies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested study per order, as a registry page holds it."""
    key, customer, day = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate")
    number = F.concat(F.lit("NCT"), _padded(key, 8))
    status = F.col("o_orderstatus")
    end = F.date_add(day.cast("date"), (customer % 900).cast("int"))
    enrolled = F.floor(F.col("o_totalprice")).cast("bigint") % 1000
    none = F.lit(None).cast("string")

    def words(*values: str) -> Column:
        return F.array(*[F.lit(value) for value in values])

    phases = {
        0: words("PHASE1"), 1: words("PHASE2"), 2: words("PHASE3"), 3: words("PHASE4"),
        4: words("PHASE1", "PHASE2"), 5: words("PHASE2", "PHASE3"), 6: words("NA"),
    }
    minimum = (
        F.when(customer % 90 == 0, none)
        .when(customer % 4 == 1, F.concat(_text(customer % 90), F.lit(" Months")))
        .otherwise(F.concat(_text(customer % 90), F.lit(" Years")))
    )

    def intervention(step: int) -> Column:
        return F.struct(
            F.when((key + step) % 10 != 0, F.concat(F.lit("AGENT "), _text((key + step) % 60))).alias("name"),
            _by((key + step) % 3, {0: "DRUG", 1: "DEVICE"}, "BEHAVIORAL").alias("type"),
        )

    interventions = F.slice(
        F.array(intervention(0), intervention(1), intervention(2)),
        F.lit(1), (key % 4).cast("int"),
    )
    locations = F.transform(
        F.slice(F.array(*[F.lit(n) for n in range(5)]), F.lit(1), (customer % 6).cast("int")),
        lambda n: F.struct(
            F.when(customer % 7 != 0, F.concat(F.lit("NATION "), _text((customer + n) % 25))).alias("country")
        ),
    )

    def dated(value: Column) -> Column:
        return F.struct(value.alias("date"))

    iso = F.date_format(day, "yyyy-MM-dd")
    section = F.struct(
        F.struct(
            number.alias("nctId"),
            F.concat(F.lit("Study "), _text(key)).alias("briefTitle"),
            F.when(key % 10 != 0, F.concat(F.lit("Official study "), _text(key))).alias("officialTitle"),
            F.struct(F.concat(F.lit("ORG-"), _text(customer)).alias("id")).alias("orgStudyIdInfo"),
        ).alias("identificationModule"),
        F.struct(
            F.when(key % 12 == 0, none).when(status == "F", "COMPLETED")
            .when(status == "O", "RECRUITING").otherwise("UNKNOWN").alias("overallStatus"),
            dated(iso).alias("startDateStruct"),
            dated(F.date_format(day, "MM/dd/yyyy")).alias("primaryCompletionDateStruct"),
            dated(
                F.when(key % 6 == 0, F.date_format(end, "yyyy-MM")).otherwise(F.date_format(end, "yyyy-MM-dd"))
            ).alias("completionDateStruct"),
            dated(F.date_format(day, "dd-MMM-yyyy")).alias("studyFirstPostDateStruct"),
            dated(F.when(key % 4 != 0, iso)).alias("lastUpdatePostDateStruct"),
        ).alias("statusModule"),
        F.struct(F.concat(F.lit("Summary "), _text(key)).alias("briefSummary")).alias("descriptionModule"),
        F.struct(
            _by(key % 3, {0: "INTERVENTIONAL", 1: "OBSERVATIONAL"}).alias("studyType"),
            _by(key % 8, phases).alias("phases"),
            F.struct(
                F.when(key % 9 != 0, enrolled).alias("count"),
                _by(key % 2, {0: "ACTUAL"}, "ESTIMATED").alias("type"),
            ).alias("enrollmentInfo"),
            F.struct(
                _by(key % 3, {0: "RANDOMIZED"}).alias("allocation"),
                _by(key % 5, {0: "PARALLEL"}, "CROSSOVER").alias("interventionModel"),
                F.lit("TREATMENT").alias("primaryPurpose"),
                F.struct(_by(key % 4, {0: "NONE"}, "DOUBLE").alias("masking")).alias("maskingInfo"),
            ).alias("designInfo"),
        ).alias("designModule"),
        F.struct(
            F.concat(F.lit("Criteria "), _text(key)).alias("eligibilityCriteria"),
            F.when(key % 3 != 0, key % 2 == 0).alias("healthyVolunteers"),
            _by(customer % 4, {0: "ALL", 1: "FEMALE", 2: "MALE"}).alias("sex"),
            minimum.alias("minimumAge"),
            F.when(key % 5 == 0, "N/A").otherwise(F.concat(_text(customer % 90 + 10), F.lit(" Years"))).alias("maximumAge"),
            F.when(key % 7 != 0, words("ADULT", "OLDER_ADULT")).alias("stdAges"),
        ).alias("eligibilityModule"),
        F.struct(locations.alias("locations")).alias("contactsLocationsModule"),
        F.struct(
            F.struct(
                F.concat(F.lit("SPONSOR "), _text(customer % 50)).alias("name"),
                F.when(F.col("o_orderpriority") == "1-URGENT", "INDUSTRY")
                .when(F.col("o_orderpriority") == "2-HIGH", "NIH")
                .when(F.col("o_orderpriority") == "3-MEDIUM", "OTHER")
                .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "OTHER_GOV").alias("class"),
            ).alias("leadSponsor")
        ).alias("sponsorCollaboratorsModule"),
        F.struct(
            F.when(
                key % 5 != 0,
                F.array(F.struct(F.concat(F.lit("Measure "), _text(key % 20)).alias("measure"))),
            ).alias("primaryOutcomes")
        ).alias("outcomesModule"),
        F.struct(F.when(key % 11 != 0, interventions).alias("interventions")).alias("armsInterventionsModule"),
        F.struct(
            F.array(
                F.concat(F.lit("CONDITION "), _text(key % 15)),
                F.concat(F.lit("CONDITION "), _text(customer % 15)),
            ).alias("conditions")
        ).alias("conditionsModule"),
    )
    return _table(spark, sf_dir, "orders").select(
        F.struct(section.alias("protocolSection")).alias("study")
    )


def clinical_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_studies(studies(spark, sf_dir))


def write_product_documents(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """The products as JSON documents, one file each, as many as a shuffle has partitions.

    A document is written line by line in one task, so it is never one value.
    """
    number = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = openfda_drugs(spark, sf_dir)
    lines = found.select(
        F.col("meta.last_updated").alias("day"),
        F.explode(F.transform("results", lambda result: F.to_json(result))).alias("value"),
    )
    lines = lines.withColumn("document", F.pmod(F.xxhash64("value"), F.lit(number)).cast("int"))
    meta = F.to_json(F.struct(F.max("day").alias("last_updated")))
    head = lines.groupBy("document").agg(
        F.concat(F.lit('{"meta": '), meta, F.lit(', "results": [null')).alias("value")
    )
    parts = [
        head.select("document", F.lit(0).alias("place"), "value"),
        lines.select("document", F.lit(1).alias("place"), F.concat(F.lit(","), "value").alias("value")),
        head.select("document", F.lit(2).alias("place"), F.lit("]}").alias("value")),
    ]
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    placed = whole.repartition(number, "document").sortWithinPartitions("document", "place")
    placed.drop("place").write.partitionBy("document").text(folder)
