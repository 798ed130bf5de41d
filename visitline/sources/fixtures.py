"""Study-shaped tables derived from the driver's parquet tables.

No clinical data ships with the project, so the observation table (``obs``)
and the subject table (``subj``) are derived from the TPC-H-like tables with
the rules fixed in FIXTURES.md: a customer is a subject, an order is a planned
visit, a line item is one form filled at that visit, the region is the study.
Every branch of the visit rules (as-needed and unscheduled visits, missing and
scattered dates, missing ages) gets rows.

Join order is chosen for scale: the orders-side work (visit numbering by
customer, study lookup) happens on the orders table, and the largest table
(``lineitem``) is shuffled once, for the join on the order key. ``nation`` and
``region`` are tiny; Spark broadcasts them by its own size check.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from visitline.session import cut_lineage
from visitline.sources.manifest import Source
from visitline.sources.sinks import stored_form_name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _study_of_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", F.col("r_name").alias("study"))
    return (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select("c_custkey", "study")
    )


def visit_numbers(orders: DataFrame, customers: DataFrame | None = None) -> DataFrame:
    """``vn``: 0-based position of each order among its customer's, by date then key.

    Same result as ``row_number() over (partition by o_custkey order by
    o_orderdate, o_orderkey) - 1``, without one task per customer: orders
    before the day come from per-day counts (at most one row per calendar day
    and customer), and the rank inside the day is a window over one
    customer's orders of one day. A customer holding a large share of all
    orders is thus split by day instead of being sorted in a single task.
    ``customers`` (``c_custkey`` and more) join their columns to the orders; orders of no customer leave.
    """
    day = F.col("o_orderdate").cast("date")
    per_day = orders.groupBy("o_custkey", day.alias("od")).agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy("o_custkey").orderBy("od").rowsBetween(Window.unboundedPreceding, -1)
    per_day = per_day.select("o_custkey", "od", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    if customers is not None:
        # Met where the days are together by customer already: the orders need no shuffle of their own for it.
        per_day = per_day.join(customers, per_day.o_custkey == customers.c_custkey).drop("c_custkey")
    in_day = Window.partitionBy("o_custkey", "od").orderBy("o_orderdate", "o_orderkey")
    ranked = orders.withColumn("od", day).withColumn("__r", F.row_number().over(in_day))
    return ranked.join(per_day, ["o_custkey", "od"]).withColumn(
        "vn", (F.col("__before") + F.col("__r") - 1).cast("int")
    ).drop("__before", "__r")


def _visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: subject, study, visit label/number, order date."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"
    )
    v = visit_numbers(orders, _study_of_customer(spark, sf_dir))
    unscheduled = (F.col("o_orderkey") % 11) == 0
    avisit = (
        F.when((F.col("o_orderpriority") == "5-LOW") & ((F.col("vn") % 3) == 2), F.lit("PRN"))
        .when(unscheduled, F.lit("Unscheduled"))
        .when(F.col("vn") == 0, F.lit("Baseline"))
        .otherwise(F.concat(F.lit("Visit "), F.col("vn").cast("string")))
    )
    avisitn = F.when(unscheduled, F.lit(-1.0)).otherwise(F.col("vn").cast("double"))
    return v.select(
        "o_orderkey",
        "od",
        "study",
        F.col("o_custkey").alias("sjid"),
        avisit.alias("avisit"),
        avisitn.alias("avisitn"),
    )


def _form_rows(spark: SparkSession, sf_dir: str, extra: tuple[str, ...] = ()) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", *extra
    )
    v = _visits(spark, sf_dir)
    partkey, suppkey = F.col("l_partkey"), F.col("l_suppkey")
    adt = (
        F.when((partkey % 397) == 0, F.lit(None).cast("date"))
        .when((suppkey % 10) == 0, F.date_add("od", (partkey % 200).cast("int")))
        .when((suppkey % 3) == 0, F.date_add("od", (partkey % 30).cast("int")))
        .otherwise(F.date_add("od", (F.col("o_orderkey") % 7).cast("int")))
    )
    # Hashing the orders' side spares the sort of all line items.
    return items.join(v.hint("shuffle_hash"), items.l_orderkey == v.o_orderkey).select(
        "study",
        "sjid",
        "avisit",
        "avisitn",
        F.concat(F.lit("crf"), F.col("l_linenumber").cast("string")).alias("crf"),
        adt.alias("adt"),
        F.col("l_returnflag").alias("hpf"),
        *extra,
    )


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``study, sjid, avisit, avisitn, crf, adt, hpf``: one row per filled form."""
    return _form_rows(spark, sf_dir)


def raw_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``obs`` plus two content columns, for the duplicate-content rule."""
    return _form_rows(spark, sf_dir, ("l_quantity", "l_linestatus")).withColumnsRenamed(
        {"l_quantity": "qty", "l_linestatus": "status"}
    )


def study_forms(spark: SparkSession, sf_dir: str, names: Mapping[str, str]) -> DataFrame:
    """``raw_forms`` under a study's form names, with rows that lack a visit number.

    ``names`` maps ``crf1`` ... ``crf7`` to the study's names; a form's visit
    number is missing where its quantity divides by 7.
    """
    forms = raw_forms(spark, sf_dir)
    renamed = F.col("crf")
    for fixture_name, name in names.items():
        renamed = F.when(F.col("crf") == fixture_name, F.lit(name)).otherwise(renamed)
    return forms.withColumn("crf", renamed).withColumn(
        "avisitn", F.when(F.col("qty") % 7 != 0, F.col("avisitn"))
    )


def text_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``obs`` as a text export has it: visit numbers and dates are text, some empty, blank or not readable."""
    rows = _form_rows(spark, sf_dir, ("l_partkey",))
    part = F.col("l_partkey")
    number = F.col("avisitn").cast("int").cast("string")
    avisitn = F.when(part % 53 == 0, F.concat(number, F.lit("a"))).when(part % 59 == 0, F.lit(" ")).otherwise(number)
    adt = F.when(part % 61 == 0, F.lit("n/a")).when(F.col("adt").isNull(), F.lit("")).otherwise(F.col("adt").cast("string"))
    return rows.select("study", "sjid", "avisit", avisitn.alias("avisitn"), "crf", adt.alias("adt"), "hpf")


def write_study_folder(spark: SparkSession, sf_dir: str, folder: str, names: Mapping[str, str], source: Source) -> None:
    """``study_forms`` as a study's folder of form files in the study's format, column names in upper case.

    Beside the forms there is one without visit keys (``sites``) and one without rows (``blank``). In text files the visit number
    of rows whose quantity divides by 11 can't be read. Names that Spark would hide are stored under the study's name for them.
    """
    rows = study_forms(spark, sf_dir, {k: stored_form_name(v) for k, v in names.items()}).drop("study")
    if source.format != "parquet":
        rows = rows.withColumn("avisitn", F.when(F.col("qty") % 11 == 0, F.concat(F.col("avisitn").cast("string"), F.lit("?"))).otherwise(F.col("avisitn").cast("string")))
    rows = cut_lineage(rows, partition_by=("crf",))

    def write(df: DataFrame, name: str) -> None:
        df = df.toDF(*[c.upper() for c in df.columns])
        df.write.format(source.format).options(**source.options).save(f"{folder}/{name}{source.suffix}")

    for i in range(1, 8):
        name = stored_form_name(names.get(f"crf{i}", f"crf{i}"))
        write(rows.where(F.col("crf") == name).drop("crf"), name)
    write(rows.drop("crf").limit(0), "blank")
    write(table(spark, sf_dir, "nation").select("n_name"), "sites")


def subj(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``study, sjid, start_age, registration_age, ageatregistration, dm_date``."""
    key = F.col("c_custkey")
    studies = _study_of_customer(spark, sf_dir)
    return studies.select(
        "study",
        key.alias("sjid"),
        F.when(key % 4 == 0, F.lit(None)).otherwise((20 + key % 50).cast("double")).alias("start_age"),
        F.when(key % 8 == 0, F.lit(None))
        .otherwise((21 + key % 50).cast("double"))
        .alias("registration_age"),
        F.when(key % 40 == 0, F.lit(None))
        .otherwise((22 + key % 50).cast("double"))
        .alias("ageatregistration"),
        F.concat(
            (1 + key % 12).cast("string"), F.lit("/"), (1 + key % 28).cast("string"), F.lit("/2020")
        ).alias("dm_date"),
    )


def registration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subj(spark, sf_dir).select("study", "sjid", "start_age", "registration_age")


def demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subj(spark, sf_dir).select("sjid", "ageatregistration", "dm_date")
