"""The shipped models: eight staging tables and six target tables.

Every model is a function of a table lookup, so the same definition runs on stored
layers and on frames that are not stored yet.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratafold.contract import TableContract
from stratafold.functions.values import concat_key, parse_date
from stratafold.operators.conform import conform
from stratafold.operators.joins import keyed_join, repeat_rows, with_matches
from stratafold.operators.latest import staging
from stratafold.plans import contracts
from stratafold.sources.raw import LOAD_ID, LOAD_TIME

Lookup = Callable[[str], DataFrame]

YOUTH_LAW = "JEUGDWET"
YOUTH_DOMAIN = "JZG_REDEN_EINDE_PRODUCT"
OTHER_DOMAIN = "WVRTEIND"


@dataclass(frozen=True)
class Model:
    """A table of a layer: how it is built and from which tables.

    ``version`` is raised when the definition changes in a way its schema does not show.
    """

    name: str
    build: Callable[[Lookup], DataFrame] = field(compare=False)
    reads: tuple[str, ...] = ()
    contract: TableContract | None = None
    version: int = 1


# --- staging -----------------------------------------------------------------------------

_DATES = {"wvind_b": ("dd_begin", "dd_eind")}


def staging_model(contract: TableContract, loads: Callable[[str], DataFrame] | None = None) -> Model:
    """Latest load of a raw table; ``loads`` lists its load ids without a data scan."""
    columns = [name for name in contract.names if name not in (LOAD_ID, LOAD_TIME)]
    parsed = {name: parse_date(F.col(name)) for name in _DATES.get(contract.name, ())}
    raw = f"raw.{contract.name}"

    def build(table: Lookup) -> DataFrame:
        return staging(table(raw), columns, parsed, loads(raw) if loads else None)

    return Model(f"stg.{contract.name}", build, (raw,))


def staging_models(loads: Callable[[str], DataFrame] | None = None) -> list[Model]:
    return [staging_model(contract, loads) for contract in contracts.RAW.values()]


# --- targets -----------------------------------------------------------------------------

def decision(table: Lookup, contract: TableContract) -> DataFrame:
    return conform(table("stg.wvbesl"), contract, {
        "beschikking_id": "besluitnr",
        "client_id": "clientnr",
        "heeft_voorzieningen_beschikte_voorziening_id": "besluitnr",
    })


def provision(table: Lookup, contract: TableContract) -> DataFrame:
    """Indications, repeated by how many law, decision, dossier and code rows they meet.

    No column of those four is selected, so only the number of matches counts. The
    right sides are reduced to one row per key first; what an indication's dossiers
    would match under the youth law, another law, and no known law is summed per key.
    Decisions matter where there are several: those are brought to the indications' (decision,
    number) pairs by the pairs alone, so that the wide rows are shuffled once for all joins.
    Indications without a number, which no dossier meets, are joined by their decision.
    """
    law = F.col("omschryving")
    laws = table("stg.szregel").groupBy(F.col("kode_regeling").alias("law")).agg(
        F.count_if(law == YOUTH_LAW).alias("youth"),
        F.count_if(law != YOUTH_LAW).alias("other"),
        F.count_if(law.isNull()).alias("unnamed"),
    )
    codes = table("stg.abc_refcod").groupBy(F.col("code").alias("reason")).agg(
        F.count_if(F.col("domein") == YOUTH_DOMAIN).alias("youth_codes"),
        F.count_if(F.col("domein") == OTHER_DOMAIN).alias("other_codes"),
    )
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")

    def at_least_one(column: str) -> F.Column:
        return F.greatest(F.coalesce(F.col(column), zero), one)

    dossiers = (
        keyed_join(
            table("stg.wvdos").select("besluitnr", "volgnr_ind", "kode_reden_einde_voorz"),
            codes, {"kode_reden_einde_voorz": "reason"}, "left")
        .groupBy(F.col("besluitnr").alias("d_besluitnr"), F.col("volgnr_ind").alias("d_volgnr"))
        .agg(F.sum(at_least_one("youth_codes")).alias("as_youth"),
             F.sum(at_least_one("other_codes")).alias("as_other"),
             F.count(F.lit(1)).alias("as_unnamed"))
    )
    indications = table("stg.wvind_b").drop("clientnr", LOAD_ID)
    numbered = indications.where(F.col("volgnr_ind").isNotNull())
    rest = with_matches(indications.where(F.col("volgnr_ind").isNull()), table("stg.wvbesl"),
                        {"besluitnr": "besluitnr"}, "decisions")
    several = table("stg.wvbesl").groupBy(F.col("besluitnr").alias("b_besluitnr")).agg(
        F.count(F.lit(1)).alias("decisions")).where(F.col("decisions") > 1)
    # Where no decision stands twice, as its key promises, no pair is shuffled.
    pairs = numbered.select("besluitnr", "volgnr_ind").where(several.agg(F.count(F.lit(1))).scalar() > 0)
    shared = keyed_join(pairs, several, {"besluitnr": "b_besluitnr"}, "inner")
    shared = shared.groupBy(F.col("besluitnr").alias("s_besluitnr"), F.col("volgnr_ind").alias("s_volgnr")).agg(
        F.max("decisions").alias("decisions"))
    rows = keyed_join(numbered, dossiers, {"besluitnr": "d_besluitnr", "volgnr_ind": "d_volgnr"}, "left")
    rows = keyed_join(rows, shared, {"besluitnr": "s_besluitnr", "volgnr_ind": "s_volgnr"}, "left")
    rows = rows.unionByName(rest, allowMissingColumns=True)
    rows = keyed_join(rows, laws, {"kode_regeling": "law"}, "left")
    matched = F.when(F.col("youth").isNull(), at_least_one("as_unnamed")).otherwise(
        F.col("youth") * at_least_one("as_youth") + F.col("other") * at_least_one("as_other")
        + F.col("unnamed") * at_least_one("as_unnamed"))
    rows = rows.select(*indications.columns, (matched * at_least_one("decisions")).alias("times"))
    rows = repeat_rows(rows, "times")

    key = contract.column("beschikte_voorziening_id").type
    return conform(rows, contract, {
        "beschikte_voorziening_id": concat_key(
            F.col("besluitnr"), F.col("volgnr_ind"), to=key.simpleString()),
        "datumeinde": "dd_eind",
        "datumstart": "dd_begin",
        "omvang": "volume",
        "status": "status_indicatie",
    }, as_is=["status"])


def client(table: Lookup, contract: TableContract) -> DataFrame:
    return conform(table("stg.szclient"), contract, {
        "rechtspersoon_id": "clientnr",
        "gezagsdragergekend_enum_id": "ind_gezag",
    })


def claim_line(table: Lookup, contract: TableContract) -> DataFrame:
    """Indications to their dossiers, then to the payments of a dossier by its text key, so that
    payments are shuffled once."""
    payments = table("stg.szukhis").select(
        F.col("uniekwvdos").cast("string").alias("uniekwvdos"), "bedrag", "verslagnr")
    dossiers = table("stg.wvdos").select(
        F.col("uniek").cast("string").alias("uniek"), F.col("besluitnr").alias("d_besluitnr"),
        F.col("volgnr_ind").alias("d_volgnr"))
    indications = table("stg.wvind_b").select("besluitnr", "volgnr_ind", "clientnr")
    known = keyed_join(indications, dossiers, {"besluitnr": "d_besluitnr", "volgnr_ind": "d_volgnr"}, "inner")
    rows = keyed_join(payments, known.drop("volgnr_ind"), {"uniekwvdos": "uniek"}, "inner")
    return conform(rows, contract, {
        "declaratieregel_id": "uniekwvdos",
        "bedrag": "bedrag",
        "betreft_client_id": "clientnr",
        "is_voor_beschikking_id": "besluitnr",
        "valt_binnen_declaratie_id": "verslagnr",
    }, as_is=["bedrag"])


def employee(table: Lookup, contract: TableContract) -> DataFrame:
    return conform(table("stg.szwerker"), contract, {
        "medewerker_id": "kode_werker",
        "achternaam": "naam",
        "emailadres": "e_mail",
        "functie": "kode_instan",
        "geslachtsaanduiding": "ind_geslacht",
        "medewerkeridentificatie": "kode_werker",
        "medewerkertoelichting": "toelichting",
        "telefoonnummer": "telefoon",
    })


def law(table: Lookup, contract: TableContract) -> DataFrame:
    return conform(table("stg.szregel"), contract, {
        "wet_enum_id": "kode_regeling",
        "value": "omschryving",
    })


_TARGET_MODELS = {
    "beschikking": (decision, ["wvbesl"]),
    "beschikte_voorziening": (provision, ["wvind_b", "szregel", "wvbesl", "wvdos", "abc_refcod"]),
    "client": (client, ["szclient"]),
    "declaratieregel": (claim_line, ["wvind_b", "wvdos", "szukhis"]),
    "medewerker": (employee, ["szwerker"]),
    "wet_enum": (law, ["szregel"]),
}


def target_models(wide: bool = False) -> list[Model]:
    """The six target tables; ``wide`` declares whole numbers as BIGINT for large keys."""

    def model(name: str) -> Model:
        declared = contracts.TARGETS.contracts[name]
        contract = declared.widened() if wide else declared
        build, reads = _TARGET_MODELS[name]
        return Model(f"silver.{name}", lambda table: build(table, contract),
                     tuple(f"stg.{source}" for source in reads), contract)

    return [model(name) for name in _TARGET_MODELS]


def all_models(wide: bool = False, loads: Callable[[str], DataFrame] | None = None) -> list[Model]:
    """Staging before targets: each model comes after those it reads."""
    return staging_models(loads) + target_models(wide)


def unstored(models: Iterable[Model], raw: Lookup) -> Lookup:
    """A lookup of the models as frames over raw tables, nothing stored; built when asked for."""
    by_name = {model.name: model for model in models}
    built: dict[str, DataFrame] = {}

    def table(name: str) -> DataFrame:
        if name not in by_name:
            return raw(name)
        if name not in built:
            built[name] = by_name[name].build(table)
        return built[name]

    return table
