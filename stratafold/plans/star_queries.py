"""One query per operator over the star-schema test tables, each with its checking SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratafold.contract import TableContract
from stratafold.functions.rows import rows_frame
from stratafold.functions.values import concat_key, email_for, iso_text, parse_date
from stratafold.operators import audits, conformance, joins, lateral, windows
from stratafold.operators.conform import conform
from stratafold.operators.latest import latest_load, staging
from stratafold.plans import contracts, oracle, star_schema, suite
from stratafold.plans.layers import Layers, refresh, run
from stratafold.plans.models import Model, all_models, staging_model, unstored
from stratafold.session import new_folder
from stratafold.sources import raw, sinks, tables
from stratafold.sources.raw import LOAD_ID

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
LOAD_TIME = "2024-01-01 00:00:00"


def query(sql: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        SQL[function.__name__] = sql
        return function

    return register


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return tables.parquet_reader(spark, folder)(name)


def new_layers(spark: SparkSession, label: str) -> Layers:
    """Layer databases of one query run, in the shared folder."""
    prefix = f"{label}_{uuid.uuid4().hex[:8]}_"
    return Layers(spark, prefix, new_folder(spark, label)).create()


def target(spark: SparkSession, folder: str) -> Callable[[str], DataFrame]:
    """Target tables by name, over the eight source tables each stamped as one load."""
    source = star_schema.source_reader(spark, folder)
    table = unstored(all_models(wide=True), lambda name: raw.stamp(
        source(name.removeprefix("raw.")), "load_1", LOAD_TIME))
    return lambda name: table(f"silver.{name}")


def targets(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    table = target(spark, folder)
    return {name: table(name) for name in contracts.TARGETS.contracts}


# --- sources and raw layer ------------------------------------------------------------------

@query(oracle.union_all(
    f"SELECT '{t}' AS table_name, COUNT(*) AS \"rows\" FROM {t}" for t in star_schema.TABLES))
def src_scan(spark, folder):
    found = tables.scan(star_schema.TABLES, tables.parquet_reader(spark, folder))
    counts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
              for name, df in found.items()]
    result = counts[0]
    for more in counts[1:]:
        result = result.unionByName(more)
    return result


@query("SELECT * FROM orders ORDER BY o_orderkey LIMIT 100")
def src_row_limit(spark, folder):
    return tables.row_limit(read(spark, folder, "orders"), 100, ["o_orderkey"])


@query("""SELECT *, 'load_1' AS _load_id, TIMESTAMP '2024-01-01 00:00:00' AS _load_time
    FROM customer""")
def raw_stamp(spark, folder):
    return raw.stamp(read(spark, folder, "customer"), "load_1", LOAD_TIME)


@query("""SELECT _load_id, COUNT(*) AS "rows", CAST(SUM(c_nationkey) AS BIGINT) AS nations,
        MIN(c_mktsegment) AS segment FROM (
        SELECT 'load_1' AS _load_id, c_nationkey, c_mktsegment FROM customer UNION ALL
        SELECT 'load_2', c_nationkey, LOWER(c_mktsegment) FROM customer) h GROUP BY _load_id""")
def raw_history(spark, folder):
    layers = new_layers(spark, "raw_history")
    table = layers.qualified("raw.customer")
    first = read(spark, folder, "customer")
    raw.append_load(first, table, "load_1", LOAD_TIME)
    second = first.withColumn("c_mktsegment", F.lower("c_mktsegment"))
    raw.append_load(second, table, "load_2", LOAD_TIME)
    return spark.table(table).groupBy(LOAD_ID).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("c_nationkey").alias("nations"),
        F.min("c_mktsegment").alias("segment"))


@query("""SELECT strftime(ts, '%Y%m%d') AS _load_id, COUNT(*) AS "rows" FROM events GROUP BY 1""")
def load_report(spark, folder):
    return raw.load_report(daily_events(spark, folder))


def daily_events(spark, folder):
    return read(spark, folder, "events").withColumn(LOAD_ID, F.date_format("ts", "yyyyMMdd"))


@query("""SELECT c_custkey, c_name, CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal FROM customer""")
def sink_decimal(spark, folder):
    return sinks.doubles_to_decimal(
        read(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal"))


@query("SELECT doc_id, text FROM documents")
def csv_text_round_trip(spark, folder):
    """Texts with quotes and line breaks out to CSV and back, whole."""
    place = new_folder(spark, "csv")
    texts = read(spark, folder, "documents").select("doc_id", "text")
    sinks.write_csv(texts.repartition("doc_id"), f"{place}/texts.csv")
    return tables.read_csv_folder(spark, place, {"texts": texts.schema}, multiline=["texts"])["texts"]


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def csv_folder_scan(spark, folder):
    """Suppliers and nations out to CSV with upper-case names, the folder read back."""
    place = new_folder(spark, "csv")
    for name in ("supplier", "nation"):
        df = read(spark, folder, name)
        sinks.write_csv(df.toDF(*[c.upper() for c in df.columns]), f"{place}/{name}.csv")
    return tables.read_csv_folder(spark, place)["supplier"]


@query("""SELECT s.wet_enum_id, s."value", COUNT(l.l_linenumber) AS uses FROM (VALUES
        (1, 'ANDERE_WET'), (2, 'BIJZONDERE_BIJSTAND'), (3, 'I_O_A_W_I_O_A_Z_'), (4, 'JEUGDWET'),
        (5, 'LEEG'), (6, 'NIET_VAN_TOEPASSING'), (7, 'ONBEKEND'), (8, 'PARTICIPATIEWET_PW_I'),
        (9, 'WMO')) s(wet_enum_id, "value")
    LEFT JOIN lineitem l ON l.l_linenumber = s.wet_enum_id GROUP BY s.wet_enum_id, s."value" """)
def seed_enum(spark, folder):
    """The seeded law table with the number of lines that refer to each law."""
    seed = rows_frame(spark, contracts.WET_ENUM_SEED, "wet_enum_id int, value string")
    used = read(spark, folder, "lineitem").groupBy(F.col("l_linenumber").alias("used")).agg(
        F.count(F.lit(1)).alias("uses"))
    return seed.join(used, F.col("wet_enum_id") == F.col("used"), "left").select(
        "wet_enum_id", "value", F.coalesce("uses", F.lit(0).cast("bigint")).alias("uses"))


# --- staging --------------------------------------------------------------------------------

@query("""SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus, 'load_1' AS _load_id
    FROM lineitem""")
def stg_project(spark, folder):
    lines = raw.stamp(read(spark, folder, "lineitem"), "load_1", LOAD_TIME)
    return staging(lines, ["l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus"])


@query("""WITH h AS (SELECT *, strftime(ts, '%Y%m%d') AS _load_id FROM events)
    SELECT * FROM h WHERE _load_id = (SELECT MAX(_load_id) FROM h)""")
def stg_latest_load(spark, folder):
    return latest_load(daily_events(spark, folder))


@query("""WITH h AS (SELECT strftime(ts, '%Y%m%d') AS _load_id FROM events)
    SELECT DISTINCT _load_id FROM h WHERE _load_id = (SELECT MAX(_load_id) FROM h)""")
def distinct_loads(spark, folder):
    return latest_load(daily_events(spark, folder)).select(LOAD_ID).distinct()


@query("""SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS ship_text,
    CAST(CAST(strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS TIMESTAMP) AS DATE) AS ship_date
    FROM lineitem""")
def stg_date_parse(spark, folder):
    lines = read(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", iso_text(F.col("l_shipdate")).alias("ship_text"))
    return lines.withColumn("ship_date", parse_date(F.col("ship_text")))


@query(oracle.with_sources(["wvind_b"], """SELECT besluitnr, volgnr_ind, clientnr,
    CAST(CAST(dd_begin AS TIMESTAMP) AS DATE) AS dd_begin,
    CAST(CAST(dd_eind AS TIMESTAMP) AS DATE) AS dd_eind,
    volume, status_indicatie, kode_regeling, 'load_1' AS _load_id FROM wvind_b"""))
def stg_indication(spark, folder):
    source = star_schema.source_reader(spark, folder)("wvind_b")
    model = staging_model(contracts.RAW["wvind_b"])
    return model.build(lambda name: raw.stamp(source, "load_1", LOAD_TIME))


# --- contract projection ----------------------------------------------------------------------

_SUPPLIER_MAP = {"medewerker_id": "s_suppkey", "achternaam": "s_name",
                 "medewerkeridentificatie": "s_suppkey", "functie": "s_nationkey"}


@query("""SELECT CAST(s_suppkey AS BIGINT) AS medewerker_id, s_name AS achternaam,
    CAST(NULL AS DATE) AS datumindienst, CAST(NULL AS DATE) AS datumuitdienst,
    CAST(NULL AS VARCHAR) AS emailadres, CAST(NULL AS BIGINT) AS extern_enum_id,
    CAST(s_nationkey AS VARCHAR) AS functie, CAST(NULL AS VARCHAR) AS geslachtsaanduiding,
    CAST(s_suppkey AS VARCHAR) AS medewerkeridentificatie,
    CAST(NULL AS VARCHAR) AS medewerkertoelichting, CAST(NULL AS VARCHAR) AS roepnaam,
    CAST(NULL AS VARCHAR) AS telefoonnummer, CAST(NULL AS VARCHAR) AS voorletters,
    CAST(NULL AS VARCHAR) AS voorvoegselachternaam FROM supplier""")
def conform_rename_cast(spark, folder):
    return conform(read(spark, folder, "supplier"), contracts.MEDEWERKER.widened(), _SUPPLIER_MAP)


@query("""SELECT o_orderkey AS beschikking_id, o_custkey AS client_id, CAST(NULL AS VARCHAR) AS code,
    CAST(NULL AS VARCHAR) AS commentaar, CAST(NULL AS DATE) AS datumafgifte,
    CAST(NULL AS BIGINT) AS grondslagen,
    o_orderkey AS heeft_voorzieningen_beschikte_voorziening_id,
    CAST(NULL AS BIGINT) AS toewijzing_toewijzing_id, CAST(NULL AS BIGINT) AS wet_enum_id
    FROM orders""")
def conform_null_fill(spark, folder):
    return conform(read(spark, folder, "orders"), contracts.BESCHIKKING.widened(), {
        "beschikking_id": "o_orderkey", "client_id": "o_custkey",
        "heeft_voorzieningen_beschikte_voorziening_id": "o_orderkey"})


@query("""SELECT c_custkey AS rechtspersoon_id, UPPER(c_mktsegment) AS code,
    CAST(round_even(c_acctbal, 0) AS BIGINT) AS gezagsdragergekend_enum_id,
    c_name || '/' || CAST(c_nationkey AS VARCHAR) AS juridischestatus,
    CAST(NULL AS VARCHAR) AS wettelijkevertegenwoordiging FROM customer""")
def conform_mapped(spark, folder):
    """Source expressions, a Column, and a float rounded into a whole-number column."""
    return conform(read(spark, folder, "customer"), contracts.CLIENT.widened(), {
        "rechtspersoon_id": "c_custkey", "code": F.upper("c_mktsegment"),
        "gezagsdragergekend_enum_id": "c_acctbal",
        "juridischestatus": "c_name || '/' || c_nationkey"})


@query("""SELECT CAST(NULL AS BIGINT) AS wet_enum_id, CAST(NULL AS VARCHAR) AS "value"
    FROM orders""")
def conform_skeleton(spark, folder):
    return conform(read(spark, folder, "orders"), contracts.WET_ENUM.widened())


@query("""SELECT l_orderkey, l_linenumber, CAST(CONCAT(l_orderkey, l_linenumber) AS BIGINT) AS line_key
    FROM lineitem""")
def key_concat(spark, folder):
    return read(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", concat_key(
        F.col("l_orderkey"), F.col("l_linenumber"), to="bigint").alias("line_key"))


@query("""SELECT o_orderkey, n AS volgnr_ind, o_orderkey * 10 + n AS uniek
    FROM orders, (VALUES (1), (2)) v(n)""")
def key_arith(spark, folder):
    children = read(spark, folder, "orders").select(
        "o_orderkey", F.explode(F.sequence(F.lit(1), F.lit(2))).alias("volgnr_ind"))
    return children.withColumn("uniek", F.col("o_orderkey") * 10 + F.col("volgnr_ind"))


# --- target tables ------------------------------------------------------------------------------

def _target(name: str, table: str) -> None:
    def build(spark, folder):
        return target(spark, folder)(table)

    build.__name__ = name
    query(oracle.target(table))(build)


_target("silver_decision", "beschikking")
_target("silver_provision", "beschikte_voorziening")
_target("silver_client", "client")
_target("silver_claim_line", "declaratieregel")
_target("silver_employee", "medewerker")
_target("silver_law", "wet_enum")


@query(oracle.with_sources(["abc_refcod"], """, l AS (SELECT l_orderkey, l_linenumber, l_partkey,
        l_suppkey, CASE l_returnflag WHEN 'A' THEN 'EINDE_JZG' WHEN 'N' THEN 'EINDE_WMO' END AS reason,
        CASE WHEN l_quantity < 10 THEN NULL WHEN l_linestatus = 'O' THEN 'JEUGDWET' ELSE 'WMO' END
        AS law FROM lineitem)
    SELECT l.*, ar.code, ar.domein, ar.omschrijving FROM l LEFT JOIN abc_refcod ar
        ON l.reason = ar.code AND ((l.law = 'JEUGDWET' AND ar.domein = 'JZG_REDEN_EINDE_PRODUCT')
        OR (l.law <> 'JEUGDWET' AND ar.domein = 'WVRTEIND'))"""))
def lookup_conditional(spark, folder):
    lines = read(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        star_schema.choice("l_returnflag", {"A": "EINDE_JZG", "N": "EINDE_WMO"}).alias("reason"),
        F.when(F.col("l_quantity") < 10, None).when(F.col("l_linestatus") == "O", "JEUGDWET")
        .otherwise("WMO").alias("law"))
    codes = star_schema.source_reader(spark, folder)("abc_refcod")
    youth = F.col("law") == "JEUGDWET"
    return joins.lookup_by_domain(lines, codes, {"reason": "code"}, "domein", [
        (youth, "JZG_REDEN_EINDE_PRODUCT"), (~youth, "WVRTEIND")])


@query("""SELECT l.l_orderkey, l.l_linenumber, COUNT(*) AS "rows" FROM lineitem l
    LEFT JOIN (SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R') r
        ON l.l_orderkey = r.l_orderkey AND l.l_linenumber = r.l_linenumber
    GROUP BY l.l_orderkey, l.l_linenumber""")
def join_fanout(spark, folder):
    lines = read(spark, folder, "lineitem")
    returned = lines.where(F.col("l_returnflag") == "R")
    return joins.fan_out_counts(lines, returned, {
        "l_orderkey": "l_orderkey", "l_linenumber": "l_linenumber"})


# --- audits ---------------------------------------------------------------------------------------

_OPEN = "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderkey END"


@query(f"""SELECT * FROM (SELECT {_OPEN} AS beschikking_id, o_custkey AS client_id, o_totalprice
    FROM orders) d WHERE beschikking_id IS NULL""")
def audit_pk_not_null(spark, folder):
    decisions = read(spark, folder, "orders").selectExpr(
        f"{_OPEN} AS beschikking_id", "o_custkey AS client_id", "o_totalprice")
    return audits.pk_not_null(decisions, "beschikking_id")


@query("""SELECT l_orderkey, l_linenumber, COUNT(*) AS cnt FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""")
def audit_pk_unique(spark, folder):
    return audits.pk_unique(read(spark, folder, "lineitem"), "l_orderkey", "l_linenumber")


@query("""SELECT lang, text, COUNT(*) AS cnt FROM documents
    GROUP BY lang, text HAVING COUNT(*) > 1""")
def audit_pk_unique_wide(spark, folder):
    return audits.repeated_keys(read(spark, folder, "documents"), "lang", "text")


@query("SELECT * FROM documents WHERE LENGTH(CAST(text AS VARCHAR)) > 5000")
def audit_max_length(spark, folder):
    return audits.max_length(read(spark, folder, "documents"), "text", 5000)


@query("""SELECT d.doc_id, d.lang, d.source, d.n_chars FROM documents d
    LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE d.doc_id IS NOT NULL AND l.doc_id IS NULL""")
def audit_fk_orphans(spark, folder):
    documents = read(spark, folder, "documents").drop("text")
    return audits.fk_orphans(documents, "doc_id", read(spark, folder, "labels"), "doc_id")


@query(oracle.with_targets("""SELECT b.* FROM beschikking b LEFT JOIN beschikte_voorziening v
    ON b.heeft_voorzieningen_beschikte_voorziening_id = v.beschikte_voorziening_id
    WHERE b.heeft_voorzieningen_beschikte_voorziening_id IS NOT NULL
    AND v.beschikte_voorziening_id IS NULL"""))
def audit_decision_provision(spark, folder):
    table = target(spark, folder)
    found = {name: table(name) for name in ("beschikking", "beschikte_voorziening")}
    name = "assert_fk_beschikking_beschikte_voorziening"
    return next(a for a in suite.target_audits() if a.name == name).violations(found)



# --- schema conformance -----------------------------------------------------------------------------

@query(f"""SELECT table_name, "position", column_name, {oracle.CANONICAL} AS canonical_type,
    "rows", filled FROM ({oracle.fill(star_schema.TABLES)}) f""")
def schema_rows(spark, folder):
    """Columns of all tables with their canonical type and how far they are filled."""
    found = tables.scan(star_schema.TABLES, tables.parquet_reader(spark, folder))
    columns = conformance.schema_rows(spark, found).select(
        "table_name", "position", "column_name", "canonical_type")
    return columns.join(conformance.column_fill(found), ["table_name", "column_name"])


@query(f"""SELECT canonical_type, COUNT(*) AS "columns", CAST(SUM(filled) AS BIGINT) AS filled
    FROM (SELECT {oracle.CANONICAL} AS canonical_type, filled
        FROM ({oracle.fill(star_schema.TABLES)}) f) c GROUP BY canonical_type""")
def canonical_types(spark, folder):
    """Stored values per canonical type over all tables."""
    return schema_rows(spark, folder).groupBy("canonical_type").agg(
        F.count(F.lit(1)).alias("columns"), F.sum("filled").alias("filled"))


# Differs from the stored tables on purpose: one type, one column too many on either
# side, one table too many on either side.
_DECLARED = [
    TableContract.of("customer", [("c_custkey", "bigint"), ("c_name", "varchar(25)"),
                                  ("c_nationkey", "integer"), ("c_acctbal", "decimal(15,2)"),
                                  ("c_mktsegment", "char(10)")]),
    TableContract.of("orders", [("o_orderkey", "number"), ("o_custkey", "bigint"),
                                ("o_orderstatus", "char(1)"), ("o_totalprice", "numeric(15,2)"),
                                ("o_orderdate", "date"), ("o_clerk", "varchar2(15)")]),
    TableContract.of("returns", [("r_orderkey", "bigint")]),
]


@query(f"""WITH e(table_name, column_name, expected_type) AS (VALUES
        ('customer', 'c_custkey', 'INTEGER'), ('customer', 'c_name', 'VARCHAR'),
        ('customer', 'c_nationkey', 'INTEGER'), ('customer', 'c_acctbal', 'DECIMAL'),
        ('customer', 'c_mktsegment', 'VARCHAR'), ('orders', 'o_orderkey', 'DECIMAL'),
        ('orders', 'o_custkey', 'INTEGER'), ('orders', 'o_orderstatus', 'VARCHAR'),
        ('orders', 'o_totalprice', 'DECIMAL'), ('orders', 'o_orderdate', 'DATE'),
        ('orders', 'o_clerk', 'VARCHAR'), ('returns', 'r_orderkey', 'INTEGER')),
    a AS (SELECT table_name, column_name, {oracle.CANONICAL} AS actual_type, filled
        FROM ({oracle.fill(["customer", "orders", "part"])}) f)
    SELECT COALESCE(e.table_name, a.table_name) AS table_name,
        COALESCE(e.column_name, a.column_name) AS column_name, expected_type, actual_type,
        CASE WHEN e.table_name = 'returns' THEN 'missing_table'
            WHEN a.table_name = 'part' THEN 'extra_table'
            WHEN a.column_name IS NULL THEN 'missing_column'
            WHEN e.column_name IS NULL THEN 'extra_column'
            WHEN expected_type <> actual_type THEN 'type_mismatch' ELSE 'ok' END AS status,
        COALESCE(filled, 0) AS filled
    FROM e FULL JOIN a ON e.table_name = a.table_name AND e.column_name = a.column_name""")
def schema_diff(spark, folder):
    """Declared against stored columns, with the stored values each line concerns."""
    found = tables.scan(["customer", "orders", "part"], tables.parquet_reader(spark, folder))
    diff = conformance.schema_diff(spark, _DECLARED, conformance.schema_rows(spark, found))
    return _with_fill(diff, found)


def _with_fill(diff: DataFrame, found: dict[str, DataFrame]) -> DataFrame:
    filled = conformance.column_fill(found).drop("rows")
    joined = diff.join(filled, ["table_name", "column_name"], "left")
    return joined.withColumn("filled", F.coalesce("filled", F.lit(0).cast("bigint")))


# The raw columns by the type that is expected of them.
_RAW_TYPES = {
    "abc_refcod": {"VARCHAR": ["code", "domein", "omschrijving"]},
    "szclient": {"INTEGER": ["clientnr"], "VARCHAR": ["ind_gezag"]},
    "szregel": {"VARCHAR": ["kode_regeling", "omschryving"]},
    "szukhis": {"VARCHAR": ["uniekwvdos"], "DECIMAL": ["bedrag"], "INTEGER": ["verslagnr"]},
    "szwerker": {"VARCHAR": ["kode_werker", "naam", "kode_instan", "e_mail", "ind_geslacht",
                             "toelichting", "telefoon"]},
    "wvbesl": {"INTEGER": ["besluitnr", "clientnr"]},
    "wvdos": {"INTEGER": ["besluitnr", "volgnr_ind"], "VARCHAR": ["uniek", "kode_reden_einde_voorz"]},
    "wvind_b": {"INTEGER": ["besluitnr", "volgnr_ind", "clientnr"], "DECIMAL": ["volume"],
                "VARCHAR": ["dd_begin", "dd_eind", "status_indicatie", "kode_regeling"]},
}


def _raw_check_sql() -> str:
    rows = [f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{kind}' AS expected_type, "
            f"ANY_VALUE(TYPEOF({column})) AS t, COUNT({column}) AS filled FROM stamped_{table}"
            for table, kinds in _RAW_TYPES.items()
            for kind, columns in {**kinds, "VARCHAR": [*kinds.get("VARCHAR", []), "_load_id"],
                                  "DATE": ["_load_time"]}.items() for column in columns]
    stamped = ",\n".join(
        f"stamped_{name} AS (SELECT *, 'load_1' AS _load_id, TIMESTAMP '2024-01-01 00:00:00' "
        f"AS _load_time FROM {name})" for name in _RAW_TYPES)
    return oracle.with_sources(_RAW_TYPES, f""", {stamped},
        found AS (SELECT *, {oracle.CANONICAL} AS actual_type FROM ({oracle.union_all(rows)}) c)
        SELECT table_name, column_name, expected_type, actual_type,
            CASE WHEN expected_type = actual_type THEN 'ok' ELSE 'type_mismatch' END AS status, filled,
            CAST(0 AS BIGINT) AS failures FROM found""")


@query(_raw_check_sql())
def raw_contract_check(spark, folder):
    """The eight raw tables against their declared columns, and their values against the types."""
    found = {name: raw.stamp(df, "load_1", LOAD_TIME)
             for name, df in star_schema.sources(spark, folder).items()}
    diff = conformance.schema_diff(
        spark, contracts.RAW.values(), conformance.schema_rows(spark, found))
    return diff.join(conformance.cast_failures(contracts.RAW.values(), found), ["table_name", "column_name"])


@query("""SELECT 'customer' AS table_name, 'c_custkey' AS column_name, COUNT(c_custkey) AS filled,
        COUNT(c_custkey) - COUNT(TRY_CAST(c_custkey AS TINYINT)) AS failures FROM customer
    UNION ALL SELECT 'customer', 'c_name', COUNT(c_name), COUNT(c_name) - COUNT(TRY_CAST(c_name AS INTEGER))
        FROM customer
    UNION ALL SELECT 'customer', 'c_acctbal', COUNT(c_acctbal),
        COUNT(c_acctbal) - COUNT(TRY_CAST(c_acctbal AS DECIMAL(5,2))) FROM customer
    UNION ALL SELECT 'documents', 'n_chars', COUNT(n_chars), COUNT(n_chars) - COUNT(TRY_CAST(n_chars AS SMALLINT))
        FROM documents
    UNION ALL SELECT 'documents', 'lang', COUNT(lang), CAST(0 AS BIGINT) FROM documents""")
def value_cast_check(spark, folder):
    """Stored values that types declared too narrow, or of another kind, can't hold."""
    declared = [
        TableContract.of("customer", [("c_custkey", "tinyint"), ("c_name", "integer"), ("c_acctbal", "decimal(5,2)")]),
        TableContract.of("documents", [("n_chars", "smallint"), ("lang", "varchar(20)")])]
    return conformance.cast_failures(declared, {c.name: read(spark, folder, c.name) for c in declared})


# How catalogs of other engines may spell the types of the test tables.
_SPELLED = {
    "postgres": {"int": "int4", "bigint": "int8", "float": "float4", "double": "float8", "string": "bpchar",
                 "date": "date", "timestamp": "timestamp without time zone", "array": "jsonb"},
    "mssql": {"int": "int", "bigint": "bigint", "float": "real", "double": "float", "string": "ntext",
              "date": "date", "timestamp": "smalldatetime", "array": "varbinary"},
    "mysql": {"int": "mediumint", "bigint": "bigint", "float": "float", "double": "double", "string": "longtext",
              "date": "date", "timestamp": "year", "array": "longblob"},
    "duckdb": {"int": "uinteger", "bigint": "hugeint", "float": "float", "double": "double", "string": "string",
               "date": "date", "timestamp": "timestamp with time zone", "array": "blob"},
}


@query(f"""SELECT engine, canonical_type, COUNT(*) AS "columns", CAST(SUM(filled) AS BIGINT) AS filled FROM (
    SELECT engine, filled, CASE WHEN t LIKE '%[]' AND engine = 'postgres' THEN 'JSON'
        WHEN t LIKE '%[]' THEN 'BINARY' ELSE {oracle.CANONICAL} END AS canonical_type
    FROM ({oracle.fill(star_schema.TABLES)}) f, (VALUES ('postgres'), ('mssql'), ('mysql'), ('duckdb')) e(engine))
    GROUP BY engine, canonical_type""")
def engine_types(spark, folder):
    """The tables' columns as other engines' catalogs spell them, under canonical names."""
    found = tables.scan(star_schema.TABLES, tables.parquet_reader(spark, folder))
    kinds = [(name, at, f.name, "timestamp" if f.dataType.simpleString().startswith("timestamp")
              else f.dataType.simpleString().split("<")[0].split("(")[0])
             for name, df in found.items() for at, f in enumerate(df.schema, 1)]
    named = None
    for engine, spelled in _SPELLED.items():
        catalog = rows_frame(spark, [(t, at, c, spelled[kind]) for t, at, c, kind in kinds],
                             "table_name string, ordinal_position int, column_name string, data_type string")
        rows = conformance.catalog_rows(catalog, engine).select(
            F.lit(engine).alias("engine"), "table_name", "column_name", "canonical_type")
        named = rows if named is None else named.unionByName(rows)
    return named.join(conformance.column_fill(found), ["table_name", "column_name"]).groupBy(
        "engine", "canonical_type").agg(F.count(F.lit(1)).alias("columns"), F.sum("filled").alias("filled"))


@query("""SELECT 'customer' AS table_name, column_name, status, filled, FALSE AS conforms FROM (
    SELECT 'c_custkey' AS column_name, 'ok' AS status, COUNT(c_custkey) AS filled FROM customer
    UNION ALL SELECT 'c_name', 'ok', COUNT(c_name) FROM customer
    UNION ALL SELECT 'c_nationkey', 'ok', COUNT(c_nationkey) FROM customer
    UNION ALL SELECT 'c_acctbal', 'type_mismatch', COUNT(c_acctbal) FROM customer
    UNION ALL SELECT 'c_mktsegment', 'missing_column', 0) c""")
def stored_mismatch(spark, folder):
    """A stored table with one type changed and one column lost does not conform."""
    layers = new_layers(spark, "mismatch")
    layers.replace(read(spark, folder, "customer").drop("c_mktsegment").withColumn(
        "c_acctbal", F.col("c_acctbal").cast("string")), "silver.customer")
    stored = layers.frames("silver")
    diff = conformance.schema_diff(spark, _DECLARED[:1], conformance.schema_rows(spark, stored))
    return _with_fill(diff, stored).select("table_name", "column_name", "status", "filled", F.lit(
        conformance.conforms(diff, "stored")).alias("conforms"))


@query("""SELECT 'customer' AS table_name, column_name, filled FROM (
    SELECT 'c_custkey' AS column_name, COUNT(c_custkey) AS filled FROM customer
    UNION ALL SELECT 'c_acctbal', COUNT(c_acctbal) FROM customer) c""")
def contract_merge(spark, folder):
    """Of two declarations of a table the later one counts: only its columns are looked at."""
    merged = contracts.ContractSet.of([
        _DECLARED[0], TableContract.of("customer", [("c_custkey", "bigint"), ("c_acctbal", "double")])])
    found = conformance.cast_failures(merged.select(["CUSTOMER"]), {"customer": read(spark, folder, "customer")})
    return found.select("table_name", "column_name", "filled")


# What a model states about its keys: one reference left out, one key column too many.
_STATED = [
    TableContract.of("beschikking", [], pk=["beschikking_id"], references=[
        ("client_id", "client", "rechtspersoon_id"),
        ("toewijzing_toewijzing_id", "toewijzing", "toewijzing_id"),
        ("wet_enum_id", "wet_enum", "wet_enum_id")]),
    TableContract.of("client", [], pk=["rechtspersoon_id", "code"], references=[
        ("rechtspersoon_id", "ingeschrevenpersoon", "rechtspersoon_id"),
        ("gezagsdragergekend_enum_id", "boolean_enum", "boolean_enum_id")]),
]


def _keys_sql() -> str:
    lines = [
        ("beschikking", "pk", "beschikking_id", "ok"),
        ("beschikking", "fk", "client_id", "ok"),
        ("beschikking", "fk", "heeft_voorzieningen_beschikte_voorziening_id", "missing"),
        ("beschikking", "fk", "toewijzing_toewijzing_id", "ok"),
        ("beschikking", "fk", "wet_enum_id", "ok"),
        ("client", "pk", "rechtspersoon_id", "ok"),
        ("client", "pk", "code", "extra"),
        ("client", "fk", "rechtspersoon_id", "ok"),
        ("client", "fk", "gezagsdragergekend_enum_id", "ok"),
    ]
    return oracle.with_targets(oracle.union_all(
        f"SELECT '{t}' AS table_name, '{kind}' AS kind, '{column}' AS column_name, "
        f"'{status}' AS status, COUNT({column}) AS filled FROM {t}"
        for t, kind, column, status in lines))


@query(_keys_sql())
def contract_keys_check(spark, folder):
    """Declared keys against stated ones, with how far each key column is filled."""
    declared = contracts.TARGETS.select(["BESCHIKKING", "Client"])
    keys = conformance.key_sets(spark, declared, _STATED)
    table = target(spark, folder)
    filled = conformance.column_fill({c.name: table(c.name) for c in declared}).drop("rows")
    return keys.join(filled, ["table_name", "column_name"])


# Columns, key columns and references of the targets.
_TARGET_SIZES = {
    "beschikking": (9, 1, 4), "beschikte_voorziening": (15, 1, 7), "client": (5, 1, 2),
    "declaratieregel": (8, 1, 3), "medewerker": (14, 1, 1), "wet_enum": (2, 1, 0),
}


@query(oracle.with_targets(oracle.union_all(
    f"SELECT '{table}' AS table_name, {columns} AS \"columns\", {pk} AS pk_columns, "
    f"{fk} AS fk_columns, COUNT(*) AS \"rows\" FROM {table}"
    for table, (columns, pk, fk) in _TARGET_SIZES.items())))
def contract_summary(spark, folder):
    return conformance.table_summary(spark, contracts.TARGETS.select(), targets(spark, folder))


# --- stored layers --------------------------------------------------------------------------------------

def _customer_model(layers: Layers) -> Model:
    columns = ["c_custkey", "c_mktsegment"]
    return Model("stg.customer", lambda table: staging(
        table("raw.customer"), columns, loads=layers.loads("raw.customer")), ("raw.customer",))


def _two_loads(spark: SparkSession, folder: str, restate: bool) -> DataFrame:
    """Load, refresh, load a changed extract, refresh again; staging as it then stands."""
    layers = new_layers(spark, "refresh")
    table = layers.qualified("raw.customer")
    first = read(spark, folder, "customer")
    raw.append_load(first, table, "test_first_1", LOAD_TIME)
    refresh(layers, [_customer_model(layers)])
    second = first.withColumn("c_mktsegment", F.lower("c_mktsegment"))
    raw.append_load(second, table, "test_second_1", LOAD_TIME)
    refresh(layers, [_customer_model(layers)], restate=restate)
    return layers.table("stg.customer")


@query("""SELECT c_custkey, LOWER(c_mktsegment) AS c_mktsegment, 'test_second_1' AS _load_id
    FROM customer""")
def refresh_on(spark, folder):
    return _two_loads(spark, folder, restate=True)


@query("SELECT c_custkey, c_mktsegment, 'test_first_1' AS _load_id FROM customer")
def refresh_off(spark, folder):
    return _two_loads(spark, folder, restate=False)


@query("SELECT c_custkey, UPPER(c_name) AS c_name FROM customer")
def refresh_changed_model(spark, folder):
    """A model that now computes something else is built again without a restate."""
    layers = new_layers(spark, "changed")
    raw.append_load(read(spark, folder, "customer"), layers.qualified("raw.customer"), "load_1", LOAD_TIME)
    for change in (F.lower, F.upper):
        model = Model("stg.named", lambda table, change=change: table("raw.customer").select(
            "c_custkey", change("c_name").alias("c_name")), ("raw.customer",))
        refresh(layers, [model], restate=False)
    return layers.table("stg.named")


@query("""SELECT c_custkey, CAST(NULL AS VARCHAR) AS c_mktsegment, 'load_1' AS _load_id FROM customer
    UNION ALL SELECT c_custkey, c_mktsegment, 'load_2' FROM customer""")
def raw_added_column(spark, folder):
    """A later extract has one more column, NULL in the earlier load."""
    layers = new_layers(spark, "added")
    customers, table = read(spark, folder, "customer"), layers.qualified("raw.customer")
    raw.append_load(customers.select("c_custkey"), table, "load_1", LOAD_TIME)
    raw.append_load(customers.select("c_custkey", "c_mktsegment"), table, "load_2", LOAD_TIME, add_columns=True)
    return layers.table("raw.customer").select("c_custkey", "c_mktsegment", LOAD_ID)


@query("""SELECT CAST(c_custkey AS BIGINT) AS c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey,
        CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS DECIMAL(16,4)) AS c_acctbal,
        CAST(DATE '2024-01-31' AS TIMESTAMP) AS seen_at, 'load_1' AS _load_id FROM customer
    UNION ALL SELECT CAST(c_custkey AS BIGINT) + 5000000000, c_nationkey,
        CAST(c_acctbal AS DECIMAL(16,4)), TIMESTAMP '2024-02-01 12:30:00', 'load_2' FROM customer""")
def raw_widened(spark, folder):
    """A later extract has wider types: INT to BIGINT, DATE to TIMESTAMP, more decimal digits."""
    layers = new_layers(spark, "widened")
    customers, table = read(spark, folder, "customer"), layers.qualified("raw.customer")
    first = customers.select(
        F.col("c_custkey").cast("int"), F.col("c_nationkey").cast("int"), F.col("c_acctbal").cast("decimal(12,2)"),
        F.lit("2024-01-31").cast("date").alias("seen_at"))
    second = customers.select(
        (F.col("c_custkey").cast("bigint") + 5000000000).alias("c_custkey"), F.col("c_nationkey").cast("bigint"),
        F.col("c_acctbal").cast("decimal(16,4)"), F.lit("2024-02-01 12:30:00").cast("timestamp_ntz").alias("seen_at"))
    raw.append_load(first, table, "load_1", LOAD_TIME, widen=True)
    raw.append_load(second, table, "load_2", LOAD_TIME, widen=True)
    return layers.table("raw.customer").drop("_load_time")


_SHARED = {"customer": ("c_nationkey", "c_custkey"), "supplier": ("s_nationkey", "s_suppkey")}


def _party_models(layers: Layers) -> list[Model]:
    """Two staged sources, a target on each, and one on both."""
    def staged(name, columns):
        return Model(f"stg.{name}", lambda table: staging(
            table(f"raw.{name}"), columns, loads=layers.loads(f"raw.{name}")), (f"raw.{name}",))

    def parties(name, columns):
        return Model(f"silver.{name}", lambda table: table(f"stg.{name}").select(
            F.col(columns[0]).alias("nation"), F.col(columns[1]).alias("party")), (f"stg.{name}",))

    every = Model("silver.party", lambda table: table("silver.customer").unionByName(table("silver.supplier")),
                  ("silver.customer", "silver.supplier"))
    return [build(name, columns) for build in (staged, parties) for name, columns in _SHARED.items()] + [every]


@query("""WITH c AS (SELECT COUNT(*) AS n, SUM(c_custkey + 1) AS s FROM customer),
        p AS (SELECT COUNT(*) AS n, SUM(s_suppkey) AS s FROM supplier)
    SELECT t.table_name, t.action, CAST(t.n AS BIGINT) AS "rows", CAST(t.s AS BIGINT) AS key_sum FROM (
        SELECT 'silver.customer' AS table_name, 'build' AS action, n, s FROM c
        UNION ALL SELECT 'silver.supplier', 'keep', n, s FROM p
        UNION ALL SELECT 'silver.party', 'build', c.n + p.n, c.s + p.s FROM c, p) t""")
def refresh_new_load(spark, folder):
    """One of two sources has a new load: what was built or kept, and the rows as they then stand."""
    layers = new_layers(spark, "new_load")
    models = _party_models(layers)
    for name in _SHARED:
        raw.append_load(read(spark, folder, name), layers.qualified(f"raw.{name}"), "load_1", LOAD_TIME)
    refresh(layers, models)
    changed = read(spark, folder, "customer").withColumn("c_custkey", F.col("c_custkey") + 1)
    raw.append_load(changed, layers.qualified("raw.customer"), "load_2", LOAD_TIME)
    steps = refresh(layers, models, restate=False, new_loads=True)
    told = {step.table: step.action for step in steps if step.table.startswith("silver.")}
    rows = [layers.table(name).agg(F.count(F.lit(1)).alias("rows"), F.sum("party").alias("key_sum")).select(
        F.lit(name).alias("table_name"), F.lit(action).alias("action"), "rows", "key_sum")
        for name, action in told.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query("SELECT s_suppkey, s_name FROM supplier")
def layer_failed_refresh(spark, folder):
    """A refresh that fails in the middle of its write leaves the table's rows as they were."""
    layers = new_layers(spark, "failed_refresh")
    layers.replace(read(spark, folder, "supplier").select("s_suppkey", "s_name"), "silver.party")
    parts = read(spark, folder, "part")
    last = parts.agg(F.max("p_partkey")).scalar()
    bad = parts.withColumn("p_name", F.when(F.col("p_partkey") == last, F.raise_error(F.lit("unreadable row")))
                           .otherwise(F.col("p_name")))
    try:
        layers.replace(bad, "silver.party")
    except Exception as error:
        if "unreadable row" not in str(error):
            raise
    else:
        raise AssertionError("the refresh was meant to fail")
    return layers.table("silver.party")


@query("""WITH lines AS (SELECT l_orderkey, l_partkey, CASE WHEN l_returnflag = 'R' THEN l_shipdate END AS returned
        FROM lineitem), found AS (
    SELECT 'one_order' AS audit, 'pk_unique' AS kind, 'l_orderkey' AS column_name, (SELECT COUNT(*) FROM
        (SELECT 1 FROM lines GROUP BY l_orderkey HAVING COUNT(*) > 1)) AS violations
    UNION ALL SELECT 'one_part', 'pk_unique', 'l_orderkey, l_partkey', (SELECT COUNT(*) FROM
        (SELECT 1 FROM lines GROUP BY l_orderkey, l_partkey HAVING COUNT(*) > 1))
    UNION ALL SELECT 'came_back', 'pk_not_null', 'returned', (SELECT COUNT(*) FROM lines WHERE returned IS NULL))
    SELECT 'lines' AS table_name, *, violations = 0 AS passed FROM found""")
def audit_several_keys(spark, folder):
    """Two unique keys and a null check on a third column of one table."""
    lines = read(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", F.when(F.col("l_returnflag") == "R", F.col("l_shipdate")).alias("returned"))
    return audits.summarise({"lines": lines}, [
        audits.Audit("lines", "one_order", "pk_unique", "l_orderkey"),
        audits.Audit("lines", "one_part", "pk_unique", "l_orderkey, l_partkey"),
        audits.Audit("lines", "came_back", "pk_not_null", "returned")])


@query("""SELECT (SELECT COUNT(*) = COUNT(DISTINCT o_orderkey) FROM orders)
    AND (SELECT COUNT(*) = COUNT(o_orderdate) FROM orders) AS passed""")
def audit_flag(spark, folder):
    """All checks of a table as one flag."""
    return audits.all_passed(audits.summarise({"orders": read(spark, folder, "orders")}, [
        audits.Audit("orders", "one_row", "pk_unique", "o_orderkey"),
        audits.Audit("orders", "dated", "pk_not_null", "o_orderdate")]))


@query("SELECT s_suppkey, s_name FROM supplier")
def layer_full_refresh(spark, folder):
    """A stored table replaced by a narrower one of other rows."""
    layers = new_layers(spark, "full_refresh")
    layers.replace(read(spark, folder, "part"), "silver.party")
    layers.replace(read(spark, folder, "supplier").select("s_suppkey", "s_name"), "silver.party")
    return layers.table("silver.party")


@query(oracle.with_targets(
    f"SELECT *, violations = 0 AS passed FROM ({oracle.AUDITS}) a"))
def audit_summary(spark, folder):
    """All checks of the targets, which are stored first because several checks read each."""
    layers = new_layers(spark, "audit")
    built = targets(spark, folder)
    layers.replace_all({f"silver.{name}": df for name, df in built.items()}, suite.target_audits())
    return audits.summarise(layers.frames("silver"), suite.target_audits(), layers.measured("silver"))


@query(oracle.with_sources(["szclient"], f"""SELECT * FROM ({oracle.target("client")}) c
    ORDER BY rechtspersoon_id LIMIT 10"""))
def adhoc_limit(spark, folder):
    client = target(spark, folder)("client")
    return spark.sql("SELECT * FROM {client} ORDER BY rechtspersoon_id LIMIT 10", client=client)


@query(oracle.with_targets(
    f"SELECT *, violations = 0 AS passed, TRUE AS conforms FROM ({oracle.AUDITS}) a"))
def end_to_end(spark, folder):
    """Ingest, transform and store all layers, then audit and check the stored targets."""
    layers = new_layers(spark, "end_to_end")
    run(layers, star_schema.sources(spark, folder), all_models(wide=True, loads=layers.loads),
        "load_1", LOAD_TIME, audits=suite.target_audits())
    stored = layers.frames("silver")
    diff = conformance.schema_diff(
        spark, contracts.TARGETS.select(), conformance.schema_rows(spark, stored))
    summary = audits.summarise(stored, suite.target_audits(), layers.measured("silver"))
    return summary.withColumn("conforms", F.lit(conformance.conforms(diff, "stored")))


# --- SQL constructs a model may use -------------------------------------------------------------------------

@query("""SELECT l_suppkey AS supplier, COUNT(*) AS lines, CAST(SUM(l_partkey) AS BIGINT) AS key_sum,
    AVG(l_linenumber) AS mean_line, MAX(l_shipdate) AS last_shipped FROM lineitem GROUP BY l_suppkey""")
def sql_group_agg(spark, folder):
    """How many lines does each supplier ship?"""
    return read(spark, folder, "lineitem").groupBy(F.col("l_suppkey").alias("supplier")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum("l_partkey").alias("key_sum"),
        F.avg("l_linenumber").alias("mean_line"), F.max("l_shipdate").alias("last_shipped"))


@query("""SELECT l_orderkey, l_linenumber, l_returnflag, ROW_NUMBER() OVER (
    PARTITION BY l_returnflag ORDER BY l_shipdate, l_orderkey, l_linenumber) AS nth_shipped FROM lineitem""")
def sql_row_number(spark, folder):
    """Which line of its return flag is each line, in order of shipping? There are three large groups."""
    lines = read(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate")
    return windows.numbered(lines, ["l_returnflag"], ["l_shipdate", "l_orderkey", "l_linenumber"],
                            "nth_shipped").drop("l_shipdate")


@query("""SELECT event_id, kind,
    CAST(SUM(event_id) OVER (PARTITION BY kind) AS BIGINT) AS ids_of_kind FROM (
    SELECT event_id, CASE WHEN event_id % 3 > 0 THEN event_id % 3 END AS kind FROM events)""")
def sql_window_sum(spark, folder):
    """A sum over each group, the events without a kind being one group."""
    third = F.col("event_id") % 3
    events = read(spark, folder, "events").select(
        "event_id", F.when(third > 0, third).alias("kind"))
    return windows.with_group_total(events, ["kind"], F.sum("event_id"), "ids_of_kind")


_SHIPPING = """SELECT l_orderkey, l_linenumber,
    CASE WHEN l_quantity >= 40 THEN 'pallet' WHEN l_quantity >= 10 THEN 'box' ELSE 'parcel' END AS unit,
    CASE l_linestatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS is_shipped,
    COALESCE(CASE WHEN l_returnflag = 'R' THEN l_shipdate END,
        CASE WHEN l_discount > 0.05 THEN l_shipdate END, DATE '1970-01-01') AS review_from,
    l_returnflag IN ('A', 'R') AS was_returned, l_partkey + l_suppkey AS place
    FROM {lineitem}"""


@query(_SHIPPING.format(lineitem="lineitem"))
def sql_case_coalesce(spark, folder):
    """How is a line shipped, and from when must it be looked at again?"""
    return spark.sql(_SHIPPING, lineitem=read(spark, folder, "lineitem"))


@query("""SELECT p_partkey, UPPER(p_brand) AS brand, LOWER(p_type) AS kind,
    CONCAT(p_brand, '/', p_type) AS label, SUBSTRING(p_type, 1, 4) AS family,
    LENGTH(p_name) AS name_size, REPLACE(LOWER(p_brand), ' ', '.') || '@example.org' AS contact
    FROM part""")
def sql_string_fns(spark, folder):
    """How is a part labelled?"""
    return read(spark, folder, "part").select(
        "p_partkey", F.upper("p_brand").alias("brand"), F.lower("p_type").alias("kind"),
        F.concat("p_brand", F.lit("/"), "p_type").alias("label"),
        F.substring("p_type", 1, 4).alias("family"),
        F.length("p_name").cast("bigint").alias("name_size"),
        email_for(F.col("p_brand")).alias("contact"))


@query("""SELECT event_id, CAST(DATE_TRUNC('month', ts) AS TIMESTAMP) AS month_start,
    ts + INTERVAL '1 day' AS next_day, CAST(ts AS DATE) + 30 AS due FROM events""")
def sql_date_fns(spark, folder):
    return spark.sql(
        """SELECT event_id, CAST(DATE_TRUNC('month', ts) AS TIMESTAMP_NTZ) AS month_start,
        ts + INTERVAL '1' DAY AS next_day, DATE_ADD(CAST(ts AS DATE), 30) AS due
        FROM {events}""", events=read(spark, folder, "events"))


_BUSY = """SELECT busy.day AS day, busy.lines AS lines FROM (SELECT l_shipdate AS day,
    COUNT(*) AS lines FROM {lineitem} GROUP BY l_shipdate) busy WHERE busy.lines > 1"""


@query(_BUSY.format(lineitem="lineitem"))
def sql_derived_table(spark, folder):
    """Days on which more than one line is shipped."""
    return spark.sql(_BUSY, lineitem=read(spark, folder, "lineitem"))


@query("""WITH last AS (SELECT MAX(o_orderdate) AS day FROM orders)
    SELECT o.o_orderkey, last.day AS last_day FROM orders o JOIN last ON 1 = 1""")
def sql_join_on_true(spark, folder):
    """A join without a key whose right side is one aggregate row, as a scalar subquery."""
    orders = read(spark, folder, "orders")
    return orders.select("o_orderkey", orders.agg(F.max("o_orderdate")).scalar().alias("last_day"))


@query("""SELECT o.o_orderkey, r.r_regionkey, r.r_name FROM orders o JOIN region r ON TRUE""")
def sql_join_on_true_rows(spark, folder):
    """Every order with every region: the right side is a small table, held as one array."""
    orders = read(spark, folder, "orders").select("o_orderkey")
    return joins.join_on_true(orders, read(spark, folder, "region").select("r_regionkey", "r_name"))


@query("""SELECT p.p_partkey, l.l_orderkey, l.l_linenumber, l.l_quantity FROM part p CROSS JOIN LATERAL (
    SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_partkey = p.p_partkey
    ORDER BY l_quantity DESC, l_orderkey, l_linenumber LIMIT 3) l""")
def sql_lateral_top3(spark, folder):
    """The three largest lines of each part; parts without a line are left out."""
    lines = read(spark, folder, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_quantity")
    order = [F.desc("l_quantity"), F.asc("l_orderkey"), F.asc("l_linenumber")]
    parts = read(spark, folder, "part").select("p_partkey")
    return lateral.lateral_top(parts, lines, {"p_partkey": "l_partkey"}, order, 3).drop("place")


@query("""SELECT c.c_custkey, s.s_suppkey, s.s_acctbal FROM customer c CROSS JOIN LATERAL (
    SELECT s_suppkey, s_acctbal FROM supplier WHERE s_nationkey = c.c_nationkey AND s_acctbal < c.c_acctbal
    ORDER BY s_acctbal DESC, s_suppkey LIMIT 2) s""")
def sql_lateral_residual(spark, folder):
    """Each customer's two richest suppliers of its nation that are poorer than the customer.

    A nation is a key with a large share of both sides.
    """
    customers = read(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    suppliers = read(spark, folder, "supplier").select("s_nationkey", "s_suppkey", "s_acctbal")
    return lateral.lateral_top(
        customers, suppliers, {"c_nationkey": "s_nationkey"}, [F.desc("s_acctbal"), F.asc("s_suppkey")], 2,
        F.col("s_acctbal") < F.col("c_acctbal"), ["c_acctbal"]).select("c_custkey", "s_suppkey", "s_acctbal")


@query("""SELECT s.s_suppkey, l.l_orderkey, l.l_linenumber FROM supplier s LEFT JOIN LATERAL (
    SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_suppkey = s.s_suppkey AND l_quantity > s.s_acctbal / 200
    ORDER BY l_shipdate, l_orderkey, l_linenumber LIMIT 2) l ON TRUE""")
def sql_lateral_left(spark, folder):
    """The first two lines each supplier shipped above a quantity of its own; suppliers without stay."""
    suppliers = read(spark, folder, "supplier").select("s_suppkey", "s_acctbal")
    lines = read(spark, folder, "lineitem").select(
        "l_suppkey", "l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    return lateral.lateral_top(
        suppliers, lines, {"s_suppkey": "l_suppkey"}, [F.asc(c) for c in ("l_shipdate", "l_orderkey", "l_linenumber")],
        2, F.col("l_quantity") > F.col("s_acctbal") / 200, ["s_acctbal"], "left").select(
            "s_suppkey", "l_orderkey", "l_linenumber")


@query("""SELECT p.p_partkey, l.l_orderkey AS largest_order FROM part p
    JOIN (SELECT l_partkey, l_orderkey, ROW_NUMBER() OVER (PARTITION BY l_partkey
        ORDER BY l_quantity DESC, l_orderkey DESC) AS place FROM lineitem) l
    ON l.l_partkey = p.p_partkey AND l.place = 1""")
def sql_lateral_top1(spark, folder):
    """The largest order of each part: a lateral top row per key from partial aggregates."""
    top = read(spark, folder, "lineitem").groupBy("l_partkey").agg(
        F.max_by("l_orderkey", F.struct("l_quantity", "l_orderkey")).alias("largest_order"))
    parts = read(spark, folder, "part").select("p_partkey")
    return parts.join(top, F.col("p_partkey") == F.col("l_partkey")).select("p_partkey", "largest_order")


_LAST_SHIPPED = """SELECT s.s_suppkey, (SELECT MAX(l.l_shipdate) FROM {lineitem} l
    WHERE l.l_suppkey = s.s_suppkey) AS last_shipped FROM {supplier} s"""


@query(_LAST_SHIPPED.format(lineitem="lineitem", supplier="supplier"))
def sql_correlated_max(spark, folder):
    """When did each supplier ship last?"""
    return spark.sql(_LAST_SHIPPED, lineitem=read(spark, folder, "lineitem"),
                     supplier=read(spark, folder, "supplier"))


_OFFERED = "SELECT p.*, 1 AS is_offered FROM {part} p"


@query(_OFFERED.format(part="part"))
def sql_star_const(spark, folder):
    return spark.sql(_OFFERED, part=read(spark, folder, "part"))


@query("""SELECT c_nationkey AS nation, 'customer' AS party FROM customer
    UNION ALL SELECT s_nationkey, 'supplier' FROM supplier""")
def sql_union_all(spark, folder):
    """Where do our parties live? Every customer and supplier counts."""
    customers = read(spark, folder, "customer").select(
        F.col("c_nationkey").alias("nation"), F.lit("customer").alias("party"))
    suppliers = read(spark, folder, "supplier").select(
        F.col("s_nationkey").alias("nation"), F.lit("supplier").alias("party"))
    return customers.unionByName(suppliers)


@query("SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def sql_distinct(spark, folder):
    """Which suppliers have lines with which return flag?"""
    return read(spark, folder, "lineitem").select("l_suppkey", "l_returnflag").distinct()


@query("""SELECT o.o_orderkey, c.c_name, n.n_name FROM orders o
    JOIN customer c ON o.o_custkey = c.c_custkey
    LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def sql_join_chain(spark, folder):
    """Inner join, then left join; a customer with very many orders is spread over tasks."""
    orders = read(spark, folder, "orders").select("o_orderkey", "o_custkey")
    customers = read(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey")
    nations = read(spark, folder, "nation").select("n_nationkey", "n_name")
    named = joins.keyed_join(orders, customers, {"o_custkey": "c_custkey"}, "inner")
    placed = joins.keyed_join(named, nations, {"c_nationkey": "n_nationkey"}, "left")
    return placed.select("o_orderkey", "c_name", "n_name")
