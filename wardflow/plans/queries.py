"""Runnable queries over a folder of driver tables: one per operator, table and mart.

Every query reads whole tables. Columns that hold run times, sizes or paths are
left out of the results, so two runs give the same rows.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections import ChainMap
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow import session
from wardflow.functions import expressions as e
from wardflow.operators import cleaning as c
from wardflow.operators import joins as j
from wardflow.operators import ordering, profile, quality, scd, upsert
from wardflow.operators import watermark as wm
from wardflow.plans import bronze, dimensions, facts, marts, rollups, warehouse
from wardflow.plans.marts import common, operational
from wardflow.plans.silver import RECIPES, clean_table
from wardflow.sinks import store as sinks
from wardflow.sources import domain, files, rows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = dt.date(2001, 12, 31)
WATERMARK = dt.date(1999, 1, 1)
FIRST_LOAD, SECOND_LOAD = dt.date(1998, 1, 1), dt.date(2000, 1, 1)
REGISTERED_BY = "1995-07-01"
CLAIMS_KNOWN_AT = dt.date(1999, 6, 30)


class Data(Mapping[str, DataFrame]):
    """Raw and cleaned tables of one folder, built when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = session.configure(spark), sf_dir
        self._driver: dict[str, DataFrame] = {}

    def driver(self, name: str) -> DataFrame:
        if name not in self._driver:
            self._driver[name] = domain.driver_table(self.spark, self.sf_dir, name)
        return self._driver[name]

    def raw(self, name: str) -> DataFrame:
        return domain.raw_table(self.spark, self.driver, name)

    def __getitem__(self, name: str) -> DataFrame:
        """A cleaned table."""
        fixes = None
        if name == "hospital":
            fixes = {"manager_name": self.raw("manager_fix"), "hospital_id": self.raw("hospital_fix")}
        return clean_table(self.raw(RECIPES[name].source), name, AS_OF, fixes)

    def __iter__(self):
        return iter(RECIPES)

    def __len__(self) -> int:
        return len(RECIPES)

    def new_store(self) -> sinks.TableStore:
        mark = uuid.uuid4().hex[:12]
        return sinks.TableStore(self.spark, session.fresh_path(self.spark, "lake"), f"lake_{mark}")

    def csv_folder(self, *names: str) -> str:
        """Raw tables written as CSV, to be read back."""
        folder = session.fresh_path(self.spark, "csv")
        for name in names:
            write = self.raw(name).write.option("header", True).option("ignoreLeadingWhiteSpace", False)
            write.option("ignoreTrailingWhiteSpace", False).csv(f"{folder}/{name}.csv")
        return folder


class LoadData(Data):
    """Tables that facts are loaded from: each is cleaned once, however often and from whichever load it is read.

    Rows of ``HEADS`` are not shuffled for the few keys that may repeat. With ``twice``
    the tables of ``LINES``, which are grouped and joined to be cleaned, are written, as a
    lakehouse has them written before its facts are loaded.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, twice: bool = False) -> None:
        super().__init__(spark, sf_dir)
        self.twice = twice
        self._cleaned: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in (*HEADS, *LINES):
            return super().__getitem__(name)
        if name not in self._cleaned:
            cleaned = clean_table(self.raw(RECIPES[name].source), name, AS_OF, few_repeats=name in HEADS)
            self._cleaned[name] = ordering.stage(cleaned) if self.twice and name in LINES else cleaned
        return self._cleaned[name]


#: What facts are loaded from: tables with one row for a thing of their own, and their many details.
HEADS = ("visit", "claim", "claim_approval", "prescription", "patient_feedback", "referral")
LINES = ("visit_procedure", "claim_items", "prescription_items", "drug_transaction", "drug_inventory")


def query(function: Callable[[Data], DataFrame]) -> Callable[[Data], DataFrame]:
    QUERIES[function.__name__] = lambda spark, sf_dir: function(Data(spark, sf_dir))
    return function


def register(name: str, function: Callable[[Data], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf_dir: function(Data(spark, sf_dir))


# Sources --------------------------------------------------------------------------


@query
def scan_csv(d: Data) -> DataFrame:
    return files.read_csv(d.spark, f"{d.csv_folder('claim')}/claim.csv")


@query
def scan_discover(d: Data) -> DataFrame:
    found = files.discover_csv(d.spark, d.csv_folder("claim", "visit", "hospital"))
    return found.groupBy("table_name").agg(
        F.count_distinct("source_name").alias("sources"), (F.min("file_size_bytes") > 0).alias("all_have_bytes")
    )


@query
def scan_table(d: Data) -> DataFrame:
    lake = d.new_store()
    lake.overwrite("visit", d.raw("visit"))
    return d.spark.table(lake.full_name("visit"))


@query
def scan_file_metadata(d: Data) -> DataFrame:
    return files.with_source_metadata(d.driver("lineitem")).groupBy("source_file").agg(F.count(F.lit(1)).alias("row_count"))


@query
def values_seed(d: Data) -> DataFrame:
    """Seeded watermarks with the number of source rows that are newer."""
    seeds = wm.seed_rows(d.spark, date=WATERMARK)
    dated = [
        d.raw("visit").select(F.lit("fact_visits").alias("source"), F.col("visit_date").alias("day")),
        d.raw("claim").select(F.lit("fact_claims"), "claim_date"),
        d.raw("drug_transaction").select(F.lit("fact_pharmacy"), "transaction_date"),
    ]
    per_day = reduce(DataFrame.union, [t.groupBy(*t.columns).count() for t in dated])
    joined = seeds.join(per_day, (F.col("table_name") == F.col("source")) & (F.col("day") > F.col("last_loaded_date")))
    return joined.groupBy("table_name", "last_loaded_date").agg(F.sum("count").alias("newer_rows"))


@query
def date_spine(d: Data) -> DataFrame:
    """Every day of the visit period with its number of visits."""
    visits = d.raw("visit").groupBy("visit_date").agg(F.count(F.lit(1)).alias("visits"))
    period = visits.agg(F.min("visit_date").alias("first_day"), F.max("visit_date").alias("last_day"))
    days = rows.date_spine(d.spark, F.col("first_day"), F.col("last_day"), period)
    return days.join(visits, F.col("full_date") == F.col("visit_date"), "left").select(
        "full_date", e.zero_if_null("visits").alias("visit_count")
    )


# Sinks ----------------------------------------------------------------------------


@query
def sink_overwrite(d: Data) -> DataFrame:
    lake = d.new_store()
    first = lake.overwrite("claim", d.raw("claim").drop("hospital_id"))
    wider = first.withColumn("claim_year", F.year("claim_date"))
    return lake.overwrite("claim", wider, rebalance=True)


@query
def sink_partitioned(d: Data) -> DataFrame:
    """Late years are loaded again with other amounts; earlier years stay."""
    lake = d.new_store()
    claims = d.raw("claim").select("claim_id", "claim_amount", F.year("claim_date").alias("claim_year"))
    lake.replace_partitions("claim", claims, ["claim_year"])
    again = claims.filter("claim_year >= 2000").withColumn("claim_amount", F.col("claim_amount") * 2)
    return lake.replace_partitions("claim", again, ["claim_year"])


@query
def sink_append(d: Data) -> DataFrame:
    lake = d.new_store()
    pending = F.trim("claim_status") == facts.PENDING
    lake.append("claim", d.raw("claim").filter(~pending))
    return lake.append("claim", d.raw("claim").filter(pending))


@query
def sink_append_evolve(d: Data) -> DataFrame:
    lake = d.new_store()
    visits = d.raw("visit").select("visit_id", "visit_date", "visit_type")
    lake.append_evolving("visit", visits.filter("visit_type = 'Inpatient'"))
    return lake.append_evolving(
        "visit", visits.filter("visit_type <> 'Inpatient'").withColumn("visit_year", F.year("visit_date"))
    )


@query
def upsert_evolve(d: Data) -> DataFrame:
    """A merge by partition whose second batch brings a new column and new rows."""
    lake = d.new_store()
    visits = d.raw("visit").select("visit_id", "visit_date", "visit_type", F.year("visit_date").alias("visit_year"))
    upsert.upsert_partitions(lake, "visit", visits.filter("visit_type <> 'Inpatient'"), ["visit_id"], "visit_year")
    more = visits.filter("visit_type <> 'Outpatient'").withColumn("marked", F.lit("yes"))
    return upsert.upsert_partitions(lake, "visit", more, ["visit_id"], "visit_year")


@query
def schema_conform(d: Data) -> DataFrame:
    declared = "claim_id string, claim_date date, approved_amount decimal(12,2), claim_year int, reviewed_by string"
    source = d.raw("claim").withColumn("claim_year", F.year("claim_date").cast("string"))
    return sinks.conform(source, T.StructType.fromDDL(declared))


@query
def load_validate(d: Data) -> DataFrame:
    lake, found = d.new_store(), []
    for name in ("claim", "visit", "patient"):
        watched, watch = sinks.counted(d.raw(name), [])
        table = lake.overwrite(name, watched)
        found.append((name, watch.get["rows"], table.count(), sinks.validate_load(watch.get["rows"], table)))
    return d.spark.createDataFrame(found, "table_name string, written bigint, read_back bigint, status string")


def earlier_claims(d: Data) -> DataFrame:
    """Claims as they stood on a past day: decisions of later days are not known yet."""
    decided = d["claim_approval"].select("claim_id", "approval_date")
    later = F.coalesce(F.col("approval_date") > F.lit(CLAIMS_KNOWN_AT), F.lit(False))
    return (
        d["claim"]
        .filter(F.col("claim_date") <= F.lit(CLAIMS_KNOWN_AT))
        .join(decided, "claim_id", "left")
        .withColumn("claim_status", F.when(later, facts.PENDING).otherwise(F.col("claim_status")))
        .withColumn("approved_amount", F.when(~later, F.col("approved_amount")))
        .drop("approval_date")
    )


@query
def snapshot_diff(d: Data) -> DataFrame:
    return upsert.snapshot_diff(earlier_claims(d), d["claim"], ["claim_id"])


# Cleaning -------------------------------------------------------------------------

register("clean_dedup", lambda d: c.remove_duplicates(d.raw("claim_item"), ["claim_item_id"]))
register("clean_trim", lambda d: c.trim_strings(d.raw("doctor")))
register("clean_initcap", lambda d: c.initcap_strings(d.raw("hospital").drop("latitude", "longitude")))
register("clean_lower", lambda d: c.lowercase_strings(d.raw("visit")))
register("clean_fill_str", lambda d: c.fill_strings(d.raw("patient"), exclude=["national_id"]))
register("clean_fill_num", lambda d: c.fill_numbers(d.raw("visit")))
register("clean_rename", lambda d: c.rename(d.raw("claim_item"), {"quantity": "item_quantity"}))
register("clean_concat", lambda d: c.concat_columns(d.raw("doctor"), {"doctor_name": ["first_name", "last_name"]}))
register("clean_fullname", lambda d: c.full_name(d.raw("patient"), "patient_name", ["first_name", "last_name"]))
register("clean_age", lambda d: c.add_age(d.raw("patient"), AS_OF).select("patient_id", "birth_date", "patient_age"))


@query
def clean_to_date(d: Data) -> DataFrame:
    text = F.when(F.col("visit_type") == "Follow-up", "no date").otherwise(F.col("visit_date").cast("string"))
    return c.to_dates(d.raw("visit").select("visit_id", text.alias("visit_date")), ["visit_date"])


@query
def clean_fill_everything(d: Data) -> DataFrame:
    """A whole recipe without its exemptions; the date comes as text, blank on some rows."""
    text = F.when(F.col("claim_status") == "Rejected", " ").otherwise(F.col("claim_date").cast("string"))
    return clean_table(d.raw("claim").withColumn("claim_date", text), "claim", AS_OF, fill_everything=True)


@query
def clean_blank_date(d: Data) -> DataFrame:
    text = (
        F.when(F.col("visit_type") == "Follow-up", "")
        .when(F.col("visit_type") == "Inpatient", "   ")
        .otherwise(F.col("visit_date").cast("string"))
    )
    return c.blank_dates_to_null(d.raw("visit").select("visit_id", text.alias("visit_date")), ["visit_date"])


@query
def clean_audit(d: Data) -> DataFrame:
    created = c.add_created_at(d.raw("bed"), AS_OF)
    return created.withColumn("_created_at", F.col("_created_at").cast("timestamp_ntz"))


@query
def clean_cast(d: Data) -> DataFrame:
    picked = d.raw("patient").select("patient_id", "national_id", "phone")
    return c.cast(c.cast(picked, {"phone": "string"}), {"national_id": "bigint"}, strict=False)


@query
def clean_phone(d: Data) -> DataFrame:
    texts = d.raw("doctor").select(F.col("doctor_id").alias("id"), "phone")
    texts = texts.unionByName(d.raw("hospital").select(F.col("hospital_id").alias("id"), "phone"))
    numbers = c.restore_leading_zero(d.raw("patient"), ["phone"]).select(F.col("patient_id").alias("id"), "phone")
    both = texts.unionByName(numbers).withColumn("strict_phone", F.col("phone"))
    return c.format_phones(c.format_phones(both, ["phone"]), ["strict_phone"], strict=True)


@query
def clean_override(d: Data) -> DataFrame:
    corrected = c.apply_overrides(d.raw("hospital"), d.raw("manager_fix"), "manager_name", ["manager_phone", "manager_email"])
    return corrected.select("hospital_id", "manager_name", "manager_phone", "manager_email")


@query
def bronze_audit(d: Data) -> DataFrame:
    raw = files.read_csv(d.spark, f"{d.csv_folder('claim')}/claim.csv", domain.SCHEMAS["claim"])
    audited = files.with_ingestion_audit(raw, "run-1", AS_OF)
    return audited.select(
        "claim_id",
        F.col("ingestion_timestamp").cast("timestamp_ntz").alias("ingestion_timestamp"),
        "ingestion_date",
        "pipeline_run_id",
        F.col("source_file").endswith(".csv").alias("from_csv"),
        F.col("source_file_path").contains("/claim.csv/").alias("from_claim"),
        F.col("source_file_modified_time").isNotNull().alias("has_time"),
    )


for _name in RECIPES:
    register(f"silver_{_name}", lambda d, name=_name: d[name])


# Filters --------------------------------------------------------------------------


@query
def filter_in(d: Data) -> DataFrame:
    moves = d["drug_transaction"]
    return moves.filter(
        F.col("transaction_type").isin("Dispensing", "Wastage") & ~F.substring("performed_by", 1, 7).isin("Staff 1", "Staff 2")
    )


register("filter_between", lambda d: d.raw("claim").filter(F.col("claim_amount").between(5000, 100000)))
register("filter_like", lambda d: d.raw("doctor").filter(F.col("phone").like(quality.PHONE_SHAPE)))
register("filter_null", lambda d: d.raw("bed").filter(F.col("hospital_id").isNull() | F.col("bed_type").isNull()))
register(
    "filter_colcol", lambda d: d.raw("drug_inventory").filter(F.col("quantity_available") < F.col("reorder_level"))
)
register(
    "filter_watermark",
    lambda d: d["claim"].filter(wm.after_watermark("claim_date", WATERMARK, F.col("claim_status") == facts.PENDING)),
)


@query
def filter_length(d: Data) -> DataFrame:
    text = F.col("phone").cast("string")
    odd = (F.length(text) != 10) | ~F.substring(text, 1, 2).isin("10", "11", "12", "15")
    return d.raw("patient").filter(odd).select("patient_id", "phone", F.length(text).alias("phone_length"))


@query
def exists_flag(d: Data) -> DataFrame:
    prescribed = (
        d.raw("prescription_item")
        .join(d.raw("prescription").select("prescription_id", "visit_id"), "prescription_id")
        .join(d.raw("visit").select("visit_id", "hospital_id", "visit_date"), "visit_id")
    )
    return j.flag_existing(
        d.raw("drug_transaction"),
        prescribed,
        {"drug_id": "drug_id", "hospital_id": "hospital_id", "transaction_date": "visit_date"},
        "prescribed",
    )


@query
def case_bucket(d: Data) -> DataFrame:
    aged = c.add_age(d.raw("patient"), AS_OF)
    group = e.band("patient_age", marts.patient.AGE_GROUPS, marts.patient.OLDEST)
    return aged.select("patient_id", "patient_age", group.alias("age_group"))


@query
def safe_divide(d: Data) -> DataFrame:
    share = e.safe_divide(F.col("approved_amount") * 100, "claim_amount")
    return d.raw("claim").select("claim_id", e.round2(share).alias("approval_pct"))


# Joins ----------------------------------------------------------------------------


@query
def join_inner(d: Data) -> DataFrame:
    done = d.raw("visit_procedure").join(d.raw("visit").select("visit_id", "hospital_id"), "visit_id")
    return done.select("visit_procedure_id", "visit_id", "hospital_id", "procedure_amount")


@query
def join_current_dim(d: Data) -> DataFrame:
    members = j.current_members(two_loads(d, "hospital")["hospital"], "hospital_id", "hospital_key", "scd_version")
    return d.raw("visit").select("visit_id", "hospital_id").join(members, "hospital_id")


@query
def join_left(d: Data) -> DataFrame:
    counted = d.raw("visit").groupBy("patient_id").agg(common.rows("visits"))
    rated = d.raw("patient_feedback").groupBy("patient_id").agg(common.rows("feedbacks"))
    joined = j.feed(d.raw("patient").select("patient_id"), [(counted, ["patient_id"]), (rated, ["patient_id"])])
    return joined.select("patient_id", *common.zeros("visits", "feedbacks"))


@query
def join_left_multi(d: Data) -> DataFrame:
    keys = ["patient_id", "hospital_id", "doctor_id"]
    rated = d.raw("patient_feedback").groupBy(*keys).agg(F.max("rating").alias("best_rating"))
    return d.raw("visit").select("visit_id", *keys).join(rated, keys, "left")


@query
def join_top1(d: Data) -> DataFrame:
    """The dearest item of each claim that has one; the item id breaks ties."""
    priced = d["claim_items"].filter("item_amount IS NOT NULL")
    top = priced.groupBy("claim_id").agg(
        e.latest(F.struct("claim_item_id", "item_amount"), "item_amount", "claim_item_id").alias("item")
    )
    return d["claim"].select("claim_id").join(top.select("claim_id", "item.*"), "claim_id", "left")


register("join_anti", lambda d: d.raw("claim").join(d.raw("claim_item"), "claim_id", "left_anti"))
register(
    "join_flag",
    lambda d: j.flag_existing(
        d.raw("visit").select("visit_id", "visit_type"),
        d.raw("prescription"),
        {"visit_id": "visit_id"},
        "prescription_flag",
    ),
)
register(
    "join_dup_keys", lambda d: j.rows_with_shared_value(d.raw("patient").select("patient_id", "phone"), "phone")
)


@query
def join_asof_scd2(d: Data) -> DataFrame:
    """Each visit with the patient version valid on its day; none before the first load."""
    history = two_loads(d, "patient")["patient"]
    visits = d.raw("visit").select("visit_id", "patient_id", "visit_date")
    return j.members_as_of(visits, history, "patient_id", "visit_date", ["patient_key", "scd_version"], "left")


# Aggregates -----------------------------------------------------------------------

register("agg_count", lambda d: d.raw("visit").groupBy("hospital_id").agg(common.rows("visits")))
register(
    "agg_count_distinct",
    lambda d: d.raw("visit")
    .groupBy("doctor_id")
    .agg(F.count_distinct("patient_id").alias("patients"), F.count_distinct("diagnosis_code").alias("diagnoses")),
)
register(
    "agg_cond_distinct",
    lambda d: d.raw("visit")
    .groupBy("hospital_id")
    .agg(
        F.count_distinct(F.when(F.col("visit_type") == "Inpatient", F.col("patient_id"))).alias("inpatients"),
        F.count_distinct(F.when(F.col("visit_type") == "Outpatient", F.col("patient_id"))).alias("outpatients"),
    ),
)
register(
    "agg_basic",
    lambda d: d.raw("visit")
    .groupBy("doctor_id")
    .agg(
        e.round2(F.sum("total_amount")).alias("amount"),
        e.round2(F.avg("waiting_time")).alias("avg_wait"),
        F.min("visit_date").alias("first_visit"),
        F.max("visit_date").alias("last_visit"),
    ),
)
register("agg_cond_sum", lambda d: marts.drug.moves_by_drug(d["drug_transaction"]))
register(
    "agg_avg_ratio",
    lambda d: d.raw("claim")
    .groupBy("patient_id")
    .agg(e.round2(F.avg(e.safe_divide("approved_amount", "claim_amount")) * 100).alias("approval_pct")),
)
register(
    "agg_sum_diff",
    lambda d: d.raw("claim")
    .groupBy("hospital_id")
    .agg(e.round2(F.sum(F.col("claim_amount") - F.col("approved_amount"))).alias("denied")),
)
register(
    "agg_avg_decimal",
    lambda d: d.raw("patient_feedback")
    .groupBy("doctor_id")
    .agg(e.round2(F.avg(F.col("rating").cast("decimal(3,1)"))).alias("avg_rating")),
)
register(
    "agg_first",
    lambda d: d.raw("referral")
    .groupBy("patient_id", "from_hospital_id")
    .agg(e.earliest("referral_reason", "referral_date", "referral_id").alias("referral_reason")),
)
register(
    "agg_max",
    lambda d: d.raw("claim")
    .groupBy("hospital_id")
    .agg(F.max("claim_date").alias("newest_claim"), F.max("claim_amount").alias("largest_claim")),
)
register(
    "agg_distinct",
    lambda d: d["claim_approval"].select("approval_status", "rejection_reason", "reviewed_by").distinct(),
)


@query
def agg_derived_keys(d: Data) -> DataFrame:
    daily = d.raw("visit").groupBy("hospital_id", "visit_date").agg(common.rows("visits"))
    return daily.select(
        "hospital_id",
        "visit_date",
        F.date_format("visit_date", "EEEE").alias("day_of_week"),
        F.year("visit_date").alias("visit_year"),
        F.month("visit_date").alias("visit_month"),
        "visits",
    )


# Windows, order, set operations ---------------------------------------------------

register("window_latest", lambda d: common.latest_icu(d["icu_status"]))
register(
    "surrogate_key", lambda d: ordering.with_position(d.raw("patient").select("patient_id"), ["patient_id"], "patient_key")
)
register(
    "sort_multi",
    lambda d: d.raw("claim")
    .select("claim_id", "hospital_id", "claim_date", "claim_amount")
    .orderBy("hospital_id", F.desc("claim_date"), F.desc("claim_amount"), "claim_id"),
)
register("limit_any", lambda d: d["patient"].limit(10))
register("union_all_padded", lambda d: operational.referral_sides(d["referral"]))


# Scalar functions -----------------------------------------------------------------


@query
def fn_string(d: Data) -> DataFrame:
    name = F.col("last_name")
    return d.raw("patient").select(
        "patient_id",
        F.trim(name).alias("trimmed"),
        F.lower(name).alias("lowered"),
        F.regexp_replace(name, "[^0-9]", "").alias("digits"),
        F.substring(name, 1, 4).alias("head"),
        name.startswith("Customer").alias("starts"),
        F.concat(F.lit("#"), name).alias("joined"),
        F.concat_ws("-", "first_name", "last_name").alias("joined_ws"),
        F.length(name).alias("size"),
    )


@query
def fn_date(d: Data) -> DataFrame:
    day = F.col("visit_date")
    return d.raw("visit").select(
        "visit_id",
        F.to_date(day.cast("string")).alias("parsed"),
        F.year(day).alias("y"),
        F.month(day).alias("m"),
        F.quarter(day).alias("q"),
        F.dayofmonth(day).alias("d"),
        F.dayofweek(day).alias("dow"),
        F.weekofyear(day).alias("week"),
        e.date_key(day).alias("date_key"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.datediff(F.lit(AS_OF), day).alias("days_ago"),
        F.date_sub(day, 1).alias("day_before"),
    )


@query
def fn_math(d: Data) -> DataFrame:
    return d.raw("claim").select(
        "claim_id",
        e.round2(F.col("claim_amount") / 3).alias("third"),
        e.percent_when_positive("approved_amount", "claim_amount").alias("approval_pct"),
        (F.col("claim_amount") - F.coalesce("approved_amount", F.lit(0.0))).alias("gap"),
        e.round2(F.datediff(F.lit(AS_OF), "claim_date") / F.lit(365.25)).alias("years_ago"),
    )


@query
def fn_conditional(d: Data) -> DataFrame:
    return d.raw("patient").select(
        "patient_id",
        F.coalesce("national_id", F.lit("none")).alias("national_id"),
        F.nullif("gender", F.lit("other")).alias("gender"),
        F.when(F.col("phone").isNull(), "missing").otherwise("given").alias("phone_state"),
        F.col("phone").cast("string").alias("phone_text"),
        F.col("birth_date").cast("string").alias("birth_text"),
        F.lit(None).cast("date").alias("no_date"),
        F.col("emergency_contact").cast("decimal(12,2)").alias("contact_decimal"),
    )


# Dimensions -----------------------------------------------------------------------

AUDIT = ("dwh_created_at", "dwh_updated_at")


@query
def dim_date(d: Data) -> DataFrame:
    """The calendar of the period that has visits."""
    period = d.raw("visit").agg(F.min("visit_date").alias("first_day"), F.max("visit_date").alias("last_day"))
    return dimensions.dim_date(d.spark, F.col("first_day"), F.col("last_day"), bounds=period)


register("dim_diagnosis", lambda d: dimensions.dim_diagnosis(d["diagnosis"], AS_OF).drop(*AUDIT))
register("dim_procedure", lambda d: dimensions.dim_procedure(d["medical_procedure"], AS_OF).drop(*AUDIT))
register("dim_claim_status", lambda d: dimensions.dim_claim_status(d["claim_approval"], AS_OF).drop(*AUDIT))


def earlier_state(d: Data, name: str) -> DataFrame:
    """A cleaned table as it was at the first load: rows missing, values different."""
    now = d[name]
    if name == "patient":
        seen = d.raw("visit").filter(F.col("visit_date") < REGISTERED_BY).select("patient_id")
        return now.join(seen, "patient_id", "left_semi").withColumns(
            {
                "city": F.when(F.col("blood_type") == "O+", "Old City").otherwise(F.col("city")),
                "patient_phone": F.when(F.col("blood_type") != "A-", F.col("patient_phone")),
                "governorate": F.when(F.col("gender") == "other", "Old Governorate").otherwise(F.col("governorate")),
            }
        )
    if name == "hospital":
        return now.filter("governorate <> 'ASIA'").withColumn(
            "total_beds", F.when(F.col("hospital_type") == "Public", F.col("total_beds") + 5).otherwise(F.col("total_beds"))
        )
    if name == "department":
        return now.withColumn(
            "floor_number", F.when(F.col("department_name") != "Surgery", F.col("floor_number"))
        )
    if name == "doctor":
        return now.withColumn(
            "specialty", F.when(F.col("employment_status") == "On Leave", "General").otherwise(F.col("specialty"))
        )
    return now.filter("drug_category <> 'LARGE'").withColumns(
        {
            "unit_amount": F.when(F.col("drug_category") == "PROMO", F.col("unit_amount") / 2).otherwise(
                F.col("unit_amount")
            ),
            "generic_name": F.when(F.col("drug_category") == "SMALL", "old name").otherwise(F.col("generic_name")),
        }
    )


NEEDS = {"department": ("hospital",), "doctor": ("hospital", "department")}


def first_load(d: Data, *names: str) -> dict[str, DataFrame]:
    """Dimensions after their first load from today's tables."""
    dims: dict[str, DataFrame] = {}
    for name in dimensions.DIMENSIONS:
        if name in names:
            dims[name] = dimensions.load_dimension(name, d, dims, FIRST_LOAD)
    return dims


def two_loads(d: Data, name: str) -> dict[str, DataFrame]:
    """A dimension (and those it refers to) after a load of the earlier state and one of today's."""
    chain = (*NEEDS.get(name, ()), name)
    past = {n: earlier_state(d, n) for n in chain}
    before: dict[str, DataFrame] = {}
    for n in chain:
        before[n] = dimensions.load_dimension(n, past, before, FIRST_LOAD)
    after: dict[str, DataFrame] = {}
    for n in chain:
        after[n] = dimensions.load_dimension(n, d, after, SECOND_LOAD, target=before[n])
    return after


for _name in dimensions.DIMENSIONS:
    register(f"scd2_{_name}", lambda d, name=_name: two_loads(d, name)[name].drop(*AUDIT))


@query
def scd2_published(d: Data) -> DataFrame:
    """The patient dimension as a table, after two loads; the versions closed by the second are in a partition of their own."""
    lake = d.new_store()
    dimensions.publish_dimension(lake, "patient", {"patient": earlier_state(d, "patient")}, {}, FIRST_LOAD)
    return dimensions.publish_dimension(lake, "patient", d, {}, SECOND_LOAD).drop(*AUDIT)


def _patient_step(d: Data) -> tuple[DataFrame, DataFrame]:
    spec = dimensions.DIMENSIONS["patient"]
    target = dimensions.load_dimension("patient", {"patient": earlier_state(d, "patient")}, {}, FIRST_LOAD)
    source = spec.stage(d, {}, SECOND_LOAD).select(*[f.name for f in T.StructType.fromDDL(spec.columns).fields])
    return target, scd.scd2_changes(target, source, spec.surrogate, spec.key, spec.tracked, SECOND_LOAD)


@query
def scd2_expire(d: Data) -> DataFrame:
    target, changes = _patient_step(d)
    return scd.scd2_expire(target, changes, "patient_id", SECOND_LOAD).drop(*AUDIT)


@query
def scd2_insert(d: Data) -> DataFrame:
    target, changes = _patient_step(d)
    return scd.scd2_insert(target, changes).drop(*AUDIT)


# Watermarks and facts -------------------------------------------------------------


def loaded_visits(d: Data) -> DataFrame:
    return wm.load_summary(d.raw("visit"), "fact_visits", "visit_date")


@query
def watermark_init(d: Data) -> DataFrame:
    """A control table that already knows the visits gets only the missing rows."""
    control = loaded_visits(d).select("table_name", F.col("max_date").alias("last_loaded_date"))
    return wm.wm_init(control, wm.seed_rows(d.spark))


@query
def watermark_advance(d: Data) -> DataFrame:
    control = wm.seed_rows(d.spark, date=WATERMARK)
    none = wm.load_summary(d.raw("claim").filter("claim_date > DATE '2099-01-01'"), "fact_claims", "claim_date")
    moves = wm.load_summary(d.raw("drug_transaction"), "fact_pharmacy", "transaction_date")
    return wm.wm_advance(control, loaded_visits(d).unionByName(none).unionByName(moves))


@query
def fact_visits(d: Data) -> DataFrame:
    d = LoadData(d.spark, d.sf_dir)
    dims = first_load(d, "patient", "hospital", "department", "doctor")
    dims["diagnosis"] = dimensions.dim_diagnosis(d["diagnosis"], AS_OF)
    fact = facts.fact_visits(d, dims, WATERMARK, AS_OF).drop("dwh_loaded_at")
    return fact.withColumn("feedback_rating", e.round2("feedback_rating"))


def _loaded_twice(
    d: Data,
    name: str,
    dims: dict[str, DataFrame],
    late: tuple[str, ...],
    past: Mapping[str, DataFrame] | None = None,
    rollup: rollups.Rollup | None = None,
) -> DataFrame:
    """A fact, or a summary of it that is kept up, after two loads; a third of the members of some dimensions, and what ``past`` lacks, come between them.

    What came is found by the ledger that the first load leaves.
    """
    early, later = dict(dims), dict(dims)
    for dim in late:
        comes = F.col(f"{dim}_key") % 3 == 0
        early[dim] = dims[dim].filter(~comes)
        created = F.when(comes, F.lit(AS_OF).cast("timestamp")).otherwise(F.col("dwh_created_at"))
        later[dim] = dims[dim].withColumn("dwh_created_at", created)
    lake, summary = d.new_store(), None
    for tables, members, since, day in ((past or d, early, WATERMARK, SECOND_LOAD), (d, later, AS_OF, AS_OF)):
        warehouse.load_fact(lake, name, tables, members, since, day, keys_may_move=False)
        summary = rollups.refresh(lake, rollup) if rollup else None
    if summary is not None:
        return summary
    return lake.table(name).drop("dwh_loaded_at", "dwh_updated_at", "month_key")


@query
def fact_visits_two_loads(d: Data) -> DataFrame:
    """A doctor and a department come after their first visits: those are loaded, then mended by the next load."""
    d = LoadData(d.spark, d.sf_dir, twice=True)
    dims = first_load(d, "patient", "hospital", "department", "doctor")
    dims["diagnosis"] = dimensions.dim_diagnosis(d["diagnosis"], AS_OF)
    fact = _loaded_twice(d, "fact_visits", dims, ("department", "doctor"))
    return fact.withColumn("feedback_rating", e.round2("feedback_rating"))


@query
def fact_claims_two_loads(d: Data) -> DataFrame:
    """Patients come after their claims, and decisions too: the next load mends what waits for them."""
    d = LoadData(d.spark, d.sf_dir, twice=True)
    dims, reviews = claim_dims(d), d["claim_approval"]
    known = F.coalesce(F.col("approval_date") <= F.lit(CLAIMS_KNOWN_AT), F.lit(True))
    waits = reviews.filter(~known).select("claim_id", F.lit(True).alias("waits")).distinct()
    claims = d["claim"].join(waits, "claim_id", "left")
    claims = claims.withColumns(
        {
            "claim_status": F.when(F.col("waits"), facts.PENDING).otherwise(F.col("claim_status")),
            "approved_amount": F.when(F.col("waits").isNull(), F.col("approved_amount")),
        }
    )
    past = ChainMap({"claim": claims.drop("waits"), "claim_approval": reviews.filter(known)}, d)
    fact = _loaded_twice(d, "fact_claims", dims, ("patient", "hospital"), past)
    return fact.withColumn("approval_gap", e.round2("approval_gap"))


@query
def fact_pharmacy_two_loads(d: Data) -> DataFrame:
    """A third of the drugs come after their first movements."""
    d = LoadData(d.spark, d.sf_dir, twice=True)
    dims = first_load(d, "drug", "hospital")
    fact = _loaded_twice(d, "fact_pharmacy", dims, ("drug", "hospital"))
    return fact.withColumn("total_value", e.round2("total_value"))


@query
def rollup_hospital_activity(d: Data) -> DataFrame:
    """Visits of each hospital, kept up over two loads: counts, sums and distinct patients and doctors."""
    d = LoadData(d.spark, d.sf_dir, twice=True)
    dims = first_load(d, "patient", "hospital", "department", "doctor")
    dims["diagnosis"] = dimensions.dim_diagnosis(d["diagnosis"], AS_OF)
    found = _loaded_twice(d, "fact_visits", dims, ("patient", "doctor"), rollup=rollups.HOSPITAL_ACTIVITY)
    return found.withColumn("total_cost", e.round2("total_cost"))


@query
def rollup_drug_movements(d: Data) -> DataFrame:
    """Movements of each drug, kept up over two loads, with the number of hospitals."""
    d = LoadData(d.spark, d.sf_dir, twice=True)
    found = _loaded_twice(d, "fact_pharmacy", first_load(d, "drug", "hospital"), ("drug",), rollup=rollups.DRUG_MOVEMENTS)
    return found.withColumn("total_value", e.round2("total_value"))


def claim_dims(d: Data) -> dict[str, DataFrame]:
    dims = first_load(d, "patient", "hospital", "drug")
    dims["claim_status"] = dimensions.dim_claim_status(d["claim_approval"], AS_OF)
    return dims


@query
def fact_claims(d: Data) -> DataFrame:
    d = LoadData(d.spark, d.sf_dir)
    fact = facts.fact_claims(d, claim_dims(d), WATERMARK, AS_OF)
    return fact.drop("dwh_loaded_at", "dwh_updated_at").withColumn("approval_gap", e.round2("approval_gap"))


@query
def merge_upsert(d: Data) -> DataFrame:
    """Two loads of the claims fact; claims decided in between are updated, new ones added."""
    d = LoadData(d.spark, d.sf_dir, twice=True)
    dims = claim_dims(d)
    reviews = d["claim_approval"]
    known = F.coalesce(F.col("approval_date") <= F.lit(CLAIMS_KNOWN_AT), F.lit(True))
    past = ChainMap({"claim": earlier_claims(d), "claim_approval": reviews.filter(known)}, d)
    target = ordering.stage(facts.fact_claims(past, dims, wm.NO_WATERMARK, CLAIMS_KNOWN_AT))
    batch = facts.fact_claims(d, dims, CLAIMS_KNOWN_AT, AS_OF, target)
    merged = upsert.upsert(target, batch, ["claim_id"], **facts.claim_update_rule())
    return merged.withColumns(
        {
            "loaded_on": F.col("dwh_loaded_at").cast("date"),
            "updated_on": F.col("dwh_updated_at").cast("date"),
            "approval_gap": e.round2("approval_gap"),
        }
    ).drop(*["dwh_loaded_at", "dwh_updated_at"])


@query
def fact_pharmacy(d: Data) -> DataFrame:
    d = LoadData(d.spark, d.sf_dir)
    fact = facts.fact_pharmacy(d, first_load(d, "drug", "hospital"), WATERMARK, AS_OF).drop("dwh_loaded_at")
    return fact.withColumn("total_value", e.round2("total_value"))


# Quality and profiles -------------------------------------------------------------

register("dq_primary_key", lambda d: quality.primary_key_violations(d.raw("claim_item"), "claim_item_id"))


@query
def dq_untrimmed(d: Data) -> DataFrame:
    watched = {
        "hospital": ["hospital_name", "manager_name"],
        "doctor": ["first_name", "last_name", "specialty"],
        "drug": ["manufacturer", "generic_name"],
        "claim": ["claim_status"],
        "diagnosis": ["diagnosis_name"],
        "bed": ["availability_status"],
        "claim_approval": ["approval_status", "rejection_reason"],
        "claim_item": ["drug_id"],
    }
    found = [
        quality.run_checks(d.raw(t), t, [quality.untrimmed(col) for col in columns], RECIPES_KEY[t])
        for t, columns in watched.items()
    ]
    return reduce(DataFrame.unionByName, found)


RECIPES_KEY = {recipe.source: recipe.key for recipe in RECIPES.values()}


@query
def dq_domain(d: Data) -> DataFrame:
    watched = {
        "hospital": ["hospital_type", "governorate", "district"],
        "doctor": ["specialty", "employment_status"],
        "bed": ["bed_type", "availability_status"],
        "claim": ["claim_status"],
        "diagnosis": ["severity_level"],
    }
    found = [
        quality.domain_listing(d.raw(t), columns).withColumn("table_name", F.lit(t)) for t, columns in watched.items()
    ]
    return reduce(DataFrame.unionByName, found)


@query
def dq_email(d: Data) -> DataFrame:
    bad = quality.failing_rows(d.raw("hospital"), quality.email_shape("manager_email"))
    return bad.select("hospital_id", "manager_email")


@query
def dq_phone(d: Data) -> DataFrame:
    bad = quality.failing_rows(d.raw("doctor"), quality.phone_shape("phone")).select(
        F.col("doctor_id").alias("id"), "phone"
    )
    cleaned = quality.failing_rows(d["hospital"], quality.phone_shape("hospital_phone"))
    return bad.unionByName(cleaned.select(F.col("hospital_id").alias("id"), F.col("hospital_phone").alias("phone")))


@query
def dq_foreign_key(d: Data) -> DataFrame:
    """NULL and dangling references per column."""
    references = {
        "bed": {"hospital_id": "hospital", "department_id": "department"},
        "prescription_item": {"prescription_id": "prescription"},
        "claim_item": {"claim_id": "claim", "drug_id": "drug"},
    }
    found = [
        quality.reference_findings(d.raw(table), table, {col: (d.raw(parent), col) for col, parent in columns.items()})
        for table, columns in references.items()
    ]
    return reduce(DataFrame.unionByName, found)


@query
def dq_null_date(d: Data) -> DataFrame:
    rule = quality.is_missing("approval_date", "null_date")
    late = quality.run_checks(d.raw("claim_approval"), "claim_approval", [rule], "approval_id")
    dated = quality.run_checks(d.raw("claim"), "claim", [quality.is_missing("claim_date", "null_date")], "claim_id")
    return late.unionByName(dated)


@query
def dq_date_order(d: Data) -> DataFrame:
    """Decisions before their claim, and more approved than claimed."""
    reviewed = d.raw("claim").join(d.raw("claim_approval").select("claim_id", "approval_date"), "claim_id", "left")
    rules = [quality.ordered("claim_date", "approval_date"), quality.ordered("approved_amount", "claim_amount")]
    return quality.run_checks(reviewed, "claim", rules, "claim_id")


@query
def dq_invalid_rows(d: Data) -> DataFrame:
    return quality.invalid_rows(d.raw("patient"), quality.patient_rules(AS_OF)).select("patient_id", "failed_rules")


@query
def dq_outlier_iqr(d: Data) -> DataFrame:
    """Rows outside the 1.5 IQR fences of each watched number."""
    watched = {
        "hospital": ["icu_capacity"],
        "doctor": ["years_experience"],
        "claim": ["claim_amount", "approved_amount"],
        "claim_items": ["item_amount", "item_quantity"],
    }
    # Cleaned once: the quartiles and the filter read the same narrow rows.
    narrow = {t: (ordering.stage(d[t].select(RECIPES[t].key, *columns)), columns) for t, columns in watched.items()}
    fences = quality.iqr_fences(narrow)
    found = []
    for table, (rows_of, columns) in narrow.items():
        known = {c: fences[table, c] for c in columns if (table, c) in fences}
        found.append(quality.outlier_values(rows_of, RECIPES[table].key, known).withColumn("table_name", F.lit(table)))
    return reduce(DataFrame.unionByName, found).select(
        "table_name", "column_name", "row_id", "value", e.round2("q1").alias("q1"), e.round2("q3").alias("q3")
    )


register("profile_nulls", lambda d: profile.null_counts(d.raw("patient")))
register("profile_columns", lambda d: profile.column_profile(d.raw("patient")))


@query
def profile_describe(d: Data) -> DataFrame:
    """Every described column; the numbers are rounded."""
    told = profile.describe(d.raw("claim"))
    amounts = {c: e.round2(F.col(c).cast("double")) for c in ("claim_amount", "approved_amount")}
    return told.withColumns(amounts)


register(
    "profile_value_counts",
    lambda d: profile.value_counts(d.raw("patient"), ["gender", "city", "governorate", "blood_type"]),
)
register(
    "profile_phone",
    lambda d: profile.phone_findings(d.raw("patient").select("patient_id", "phone", "emergency_contact")),
)

LOAD_COLUMNS = ("table_name", "row_count", "column_count", "total_null_values", "null_percentage", "status", "rejected_rows")


def _short_names(metrics: DataFrame) -> DataFrame:
    return metrics.withColumn("table_name", F.element_at(F.split("table_name", r"\."), -1))


def mixed_claims(d: Data, folder: str | None = None) -> str:
    """Claims as four sources of one table: turned and other-case columns, missing and new ones, and odd rows."""
    folder = folder or session.fresh_path(d.spark, "csv")
    claims, status = d.raw("claim"), F.trim("claim_status")
    turned = claims.filter(status == "Rejected")
    late = claims.filter(status == facts.PENDING).drop("approved_amount").withColumn("note", F.col("visit_id"))
    odd = claims.filter(status == facts.PENDING).select("claim_id", F.lit("none").alias("claim_amount"))
    sources = {
        "claim.csv": claims.filter(status == "Approved"),
        "a/CLAIM.csv": turned.select(*[F.col(c).alias(c.upper()) for c in reversed(turned.columns)]),
        "b/Claim.csv": late,
        "c/claim.csv": odd,
    }
    for name, rows_of in sources.items():
        write = rows_of.write.option("header", True).option("ignoreLeadingWhiteSpace", False)
        write.option("ignoreTrailingWhiteSpace", False).csv(f"{folder}/{name}")
    return folder


@query
def load_by_name(d: Data) -> DataFrame:
    """Claims loaded from sources whose headers differ."""
    lake = d.new_store()
    bronze.ingest_folder(lake, mixed_claims(d), "run-1", AS_OF, domain.SCHEMAS)
    return lake.table("claim").select(*d.raw("claim").columns, "note", "pipeline_run_id")


@query
def load_rejects(d: Data) -> DataFrame:
    """The raw lines that did not fit their table."""
    lake = d.new_store()
    bronze.ingest_folder(lake, mixed_claims(d), "run-1", AS_OF, domain.SCHEMAS)
    return lake.table(bronze.rejects_table("claim")).select("raw_row", "parsed_values", "pipeline_run_id", "ingestion_date")


@query
def load_metrics(d: Data) -> DataFrame:
    folder = mixed_claims(d, d.csv_folder("patient", "visit"))
    measured = bronze.ingest_folder(d.new_store(), folder, "run-1", AS_OF, domain.SCHEMAS)
    return _short_names(measured).select(*LOAD_COLUMNS)


@query
def load_metrics_history(d: Data) -> DataFrame:
    lake, folder = d.new_store(), d.csv_folder("patient", "claim")
    bronze.ingest_folder(lake, folder, "run-1", FIRST_LOAD, domain.SCHEMAS)
    bronze.ingest_folder(lake, folder, "run-2", SECOND_LOAD, domain.SCHEMAS)
    history = bronze.metrics_history(lake.table(bronze.METRICS_TABLE))
    return _short_names(history).select(
        "pipeline_run_id", F.col("load_timestamp").cast("date").alias("load_date"), *LOAD_COLUMNS
    )


# Marts ----------------------------------------------------------------------------

LOOKUP = ("H5", "1997-02-09")

register("mart_patient", lambda d: marts.mart_patient(d))
register("mart_hospital", lambda d: marts.mart_hospital(d))
register("mart_doctor", lambda d: marts.mart_doctor(d))
register("mart_claims", lambda d: marts.mart_claims(d))
register("mart_drug", lambda d: marts.mart_drug(d, AS_OF))
register("mart_financial", lambda d: marts.mart_financial(d))
register("mart_operational", lambda d: marts.mart_operational(d))

register("summary_patient", lambda d: marts.summary_patient(marts.mart_patient(d)))
register("summary_hospital", lambda d: marts.summary_hospital(marts.mart_hospital(d)))
register("summary_doctor", lambda d: marts.summary_doctor(marts.mart_doctor(d)))
register("summary_claims", lambda d: marts.summary_claims(marts.mart_claims(d)))
register("summary_drug", lambda d: marts.summary_drug(marts.mart_drug(d, AS_OF)))
register("summary_financial", lambda d: marts.summary_financial(marts.mart_financial(d)))
register(
    "summary_financial_by_row", lambda d: marts.summary_financial(marts.mart_financial(d), repeat_daily_figures=True)
)
register("summary_operational", lambda d: marts.summary_operational(marts.mart_operational(d)))
register(
    "summary_operational_by_row",
    lambda d: marts.summary_operational(marts.mart_operational(d), repeat_daily_figures=True),
)

register("topk_hospital", lambda d: marts.topk_hospital(marts.mart_hospital(d)))
register("topk_doctor", lambda d: marts.topk_doctor(marts.mart_doctor(d)))
register("topk_claims", lambda d: marts.topk_claims(marts.mart_claims(d)))
register("topk_drug", lambda d: marts.topk_drug(marts.mart_drug(d, AS_OF)))
register("topk_financial", lambda d: marts.topk_financial(marts.mart_financial(d)))
register("topk_operational", lambda d: marts.topk_operational(marts.mart_operational(d)))
register("lookup_operational", lambda d: marts.lookup_operational(marts.mart_operational(d), *LOOKUP))
register("daily_occupancy", lambda d: marts.daily_occupancy(marts.mart_operational(d)))
