"""The contracts of the shipped models: eight raw tables and six target tables."""

from __future__ import annotations

from stratafold.contract import ContractSet, TableContract
from stratafold.sources.raw import LOAD_ID, LOAD_TIME

# Declared columns of the raw tables.
_RAW = {
    "abc_refcod": "code text, domein text, omschrijving text",
    "szclient": "clientnr bigint, ind_gezag text",
    "szregel": "kode_regeling text, omschryving text",
    "szukhis": "uniekwvdos text, bedrag double, verslagnr bigint",
    "szwerker": "kode_werker text, naam text, kode_instan text, e_mail text, "
                "ind_geslacht text, toelichting text, telefoon text",
    "wvbesl": "besluitnr bigint, clientnr bigint",
    "wvdos": "besluitnr bigint, volgnr_ind bigint, uniek text, kode_reden_einde_voorz text",
    "wvind_b": "besluitnr bigint, volgnr_ind bigint, clientnr bigint, dd_begin text, dd_eind text, "
               "volume double, status_indicatie text, kode_regeling text",
}

RAW = {
    name: TableContract.of(name, [
        *[tuple(column.split()) for column in columns.split(", ")],
        (LOAD_ID, "text"), (LOAD_TIME, "timestamp"),
    ])
    for name, columns in _RAW.items()
}

SOURCE = "Sociaal_Domein_Beschikking_en_Voorziening__Domain_Objects_postgres.sql"

# Declared columns, keys and references of the target tables.
BESCHIKKING = TableContract.of(
    "beschikking",
    [
        ("beschikking_id", "INTEGER"),
        ("client_id", "INTEGER"),
        ("code", "VARCHAR(20)"),
        ("commentaar", "VARCHAR(200)"),
        ("datumafgifte", "DATE"),
        ("grondslagen", "INTEGER"),
        ("heeft_voorzieningen_beschikte_voorziening_id", "INTEGER"),
        ("toewijzing_toewijzing_id", "INTEGER"),
        ("wet_enum_id", "INTEGER"),
    ],
    pk=["beschikking_id"],
    references=[
        ("client_id", "rechtspersoon", "rechtspersoon_id"),
        ("heeft_voorzieningen_beschikte_voorziening_id", "beschikte_voorziening",
         "beschikte_voorziening_id"),
        ("toewijzing_toewijzing_id", "toewijzing", "toewijzing_id"),
        ("wet_enum_id", "wet_enum", "wet_enum_id"),
    ],
    source=SOURCE,
)

BESCHIKTE_VOORZIENING = TableContract.of(
    "beschikte_voorziening",
    [
        ("beschikte_voorziening_id", "INTEGER"),
        ("code", "VARCHAR(20)"),
        ("datumeinde", "DATE"),
        ("datumeindeoorspronkelijk", "DATE"),
        ("datumstart", "DATE"),
        ("eenheid_enum_id", "INTEGER"),
        ("frequentie_enum_id", "INTEGER"),
        ("heeft_leveringsvorm_293_id", "INTEGER"),
        ("is_voorziening_voorziening_id", "INTEGER"),
        ("leveringsvorm_287_enum_id", "INTEGER"),
        ("omvang", "INTEGER"),
        ("redeneinde", "DATE"),
        ("status", "VARCHAR(50)"),
        ("toegewezen_product_toewijzing_id", "INTEGER"),
        ("wet_enum_id", "INTEGER"),
    ],
    pk=["beschikte_voorziening_id"],
    references=[
        ("eenheid_enum_id", "eenheid_enum", "eenheid_enum_id"),
        ("frequentie_enum_id", "frequentie_enum", "frequentie_enum_id"),
        ("heeft_leveringsvorm_293_id", "leveringsvorm_293", "leveringsvorm_293_id"),
        ("is_voorziening_voorziening_id", "voorziening", "voorziening_id"),
        ("leveringsvorm_287_enum_id", "leveringsvorm_309_enum", "leveringsvorm_309_enum_id"),
        ("toegewezen_product_toewijzing_id", "toewijzing", "toewijzing_id"),
        ("wet_enum_id", "wet_enum", "wet_enum_id"),
    ],
    source=SOURCE,
)

CLIENT = TableContract.of(
    "client",
    [
        ("rechtspersoon_id", "INTEGER"),
        ("code", "VARCHAR(80)"),
        ("gezagsdragergekend_enum_id", "INTEGER"),
        ("juridischestatus", "VARCHAR(80)"),
        ("wettelijkevertegenwoordiging", "VARCHAR(80)"),
    ],
    pk=["rechtspersoon_id"],
    references=[
        ("rechtspersoon_id", "ingeschrevenpersoon", "rechtspersoon_id"),
        ("gezagsdragergekend_enum_id", "boolean_enum", "boolean_enum_id"),
    ],
    source=SOURCE,
)

DECLARATIEREGEL = TableContract.of(
    "declaratieregel",
    [
        ("declaratieregel_id", "INTEGER"),
        ("bedrag", "DECIMAL(10,2)"),
        ("betreft_client_id", "INTEGER"),
        ("code", "VARCHAR(20)"),
        ("datumeinde", "DATE"),
        ("datumstart", "DATE"),
        ("is_voor_beschikking_id", "INTEGER"),
        ("valt_binnen_declaratie_id", "INTEGER"),
    ],
    pk=["declaratieregel_id"],
    references=[
        ("betreft_client_id", "rechtspersoon", "rechtspersoon_id"),
        ("is_voor_beschikking_id", "beschikking", "beschikking_id"),
        ("valt_binnen_declaratie_id", "declaratie", "declaratie_id"),
    ],
    source=SOURCE,
)

MEDEWERKER = TableContract.of(
    "medewerker",
    [
        ("medewerker_id", "INTEGER"),
        ("achternaam", "VARCHAR(200)"),
        ("datumindienst", "DATE"),
        ("datumuitdienst", "DATE"),
        ("emailadres", "VARCHAR(255)"),
        ("extern_enum_id", "INTEGER"),
        ("functie", "VARCHAR(50)"),
        ("geslachtsaanduiding", "VARCHAR(255)"),
        ("medewerkeridentificatie", "VARCHAR(255)"),
        ("medewerkertoelichting", "VARCHAR(255)"),
        ("roepnaam", "VARCHAR(255)"),
        ("telefoonnummer", "VARCHAR(20)"),
        ("voorletters", "VARCHAR(20)"),
        ("voorvoegselachternaam", "VARCHAR(255)"),
    ],
    pk=["medewerker_id"],
    references=[("extern_enum_id", "boolean_enum", "boolean_enum_id")],
    source=SOURCE,
)

WET_ENUM = TableContract.of(
    "wet_enum",
    [("wet_enum_id", "INTEGER"), ("value", "VARCHAR(255)")],
    pk=["wet_enum_id"],
    source=SOURCE,
)

TARGETS = ContractSet.of(
    [BESCHIKKING, BESCHIKTE_VOORZIENING, CLIENT, DECLARATIEREGEL, MEDEWERKER, WET_ENUM])

# Seed rows of the law table.
WET_ENUM_SEED = [
    (1, "ANDERE_WET"),
    (2, "BIJZONDERE_BIJSTAND"),
    (3, "I_O_A_W_I_O_A_Z_"),
    (4, "JEUGDWET"),
    (5, "LEEG"),
    (6, "NIET_VAN_TOEPASSING"),
    (7, "ONBEKEND"),
    (8, "PARTICIPATIEWET_PW_I"),
    (9, "WMO"),
]
