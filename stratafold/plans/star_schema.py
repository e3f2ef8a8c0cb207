"""The eight source tables, derived from the star-schema test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratafold.functions.rows import rows_frame
from stratafold.functions.values import email_for, iso_text
from stratafold.plans.contracts import RAW
from stratafold.sources.tables import parquet_reader, scan

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

CODES = [
    ("EINDE_JZG", "JZG_REDEN_EINDE_PRODUCT", "Einde JZG"),
    ("EINDE_JZG", "WVRTEIND", "Einde JZG, ander domein"),
    ("EINDE_WMO", "WVRTEIND", "Einde WMO"),
    ("EINDE_WMO", "WVRTEIND", "Einde WMO, oude omschrijving"),
]


def choice(column: str, values: dict[str, str | None]) -> F.Column:
    """The value listed for a column's content; NULL where none is listed."""
    picked = F.lit(None).cast("string")
    for content, value in reversed(values.items()):
        picked = F.when(F.col(column) == content, F.lit(value)).otherwise(picked)
    return picked


def exact_sum(amount: F.Column) -> F.Column:
    """The sum of a DECIMAL(18,2) from two whole numbers, cents above and below 10^9: as partial sums
    they take half the bytes of the DECIMAL(28,2) that Spark sums in, and no total overflows them."""
    part = 10 ** 9
    cents = (amount * 100).cast("bigint")
    low, high = cents % part, F.call_function("div", cents, F.lit(part))
    total = F.sum(high).cast("decimal(19,0)") * F.lit(part).cast("decimal(10,0)") + F.sum(low).cast("decimal(19,0)")
    return total * F.lit("0.01").cast("decimal(2,2)")


def source_reader(spark: SparkSession, folder: str) -> Callable[[str], DataFrame]:
    """The source tables by name: lines are indications, their distinct (order, line) pairs
    are dossiers and payments."""
    read = parquet_reader(spark, folder)
    dossier_no = (F.col("besluitnr") * 10 + F.col("volgnr_ind")).cast("string")

    def per_dossier(**values):
        # Keys are named and cast before grouping, so that later steps on them need no shuffle.
        keyed = read("lineitem").withColumns({
            "besluitnr": F.col("l_orderkey"), "volgnr_ind": F.col("l_linenumber").cast("bigint")})
        return keyed.groupBy("besluitnr", "volgnr_ind").agg(
            *[value.alias(name) for name, value in values.items()])

    def abc_refcod():
        return rows_frame(spark, CODES, "code string, domein string, omschrijving string")

    def szclient():
        return read("customer").select(
            F.col("c_custkey").alias("clientnr"),
            F.when(F.col("c_acctbal") < 0, "0").otherwise("1").alias("ind_gezag"))

    def szregel():
        names = choice("r_regionkey", {"0": "JEUGDWET", "1": "WMO", "2": None})
        return read("region").select(
            F.col("r_regionkey").cast("string").alias("kode_regeling"),
            F.when(F.col("r_regionkey") > 2, F.col("r_name")).otherwise(names).alias("omschryving"))

    def szukhis():
        amount = exact_sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double")
        paid = per_dossier(bedrag=amount, verslagnr=F.max("l_partkey"))
        return paid.select(dossier_no.alias("uniekwvdos"), "bedrag", "verslagnr")

    def szwerker():
        name = F.regexp_replace("s_name", "#", " ")
        return read("supplier").select(
            F.col("s_suppkey").cast("string").alias("kode_werker"),
            name.alias("naam"),
            F.when(F.col("s_acctbal") < 0, "BBZ").otherwise("WMO").alias("kode_instan"),
            email_for(name).alias("e_mail"),
            F.when(F.col("s_nationkey") < 8, "M").when(F.col("s_nationkey") < 16, "V")
            .otherwise("X").alias("ind_geslacht"),
            F.lit("synthetic").alias("toelichting"),
            F.concat(F.lit("06-"), F.substring("s_name", 11, 8)).alias("telefoon"))

    def wvbesl():
        return read("orders").select(
            F.col("o_orderkey").alias("besluitnr"), F.col("o_custkey").alias("clientnr"))

    def wvdos():
        # A number as the smallest flag: text in an aggregate would cost a sort.
        flag = F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2) \
            .when(F.col("l_returnflag") == "R", 3)
        reason = choice("flag", {"1": "EINDE_JZG", "2": "EINDE_WMO", "3": "ONBEKEND"})
        return per_dossier(flag=F.min(flag)).select(
            "besluitnr", "volgnr_ind", dossier_no.alias("uniek"),
            reason.alias("kode_reden_einde_voorz"))

    def wvind_b():
        end = F.date_add("l_shipdate", F.col("l_quantity").cast("int"))
        return read("lineitem").select(
            F.col("l_orderkey").alias("besluitnr"),
            F.col("l_linenumber").cast("bigint").alias("volgnr_ind"),
            F.col("l_suppkey").alias("clientnr"),
            iso_text(F.col("l_shipdate")).alias("dd_begin"), iso_text(end).alias("dd_eind"),
            (F.col("l_quantity") * 0.5).alias("volume"),
            choice("l_linestatus", {"O": "ACTIEF", "F": "GESLOTEN"}).alias("status_indicatie"),
            choice("l_returnflag", {"A": "0", "N": "1", "R": "2"}).alias("kode_regeling"))

    tables = {f.__name__: f for f in (abc_refcod, szclient, szregel, szukhis, szwerker, wvbesl,
                                      wvdos, wvind_b)}
    return cache(lambda name: tables[name]())


def sources(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return scan(RAW, source_reader(spark, folder))
