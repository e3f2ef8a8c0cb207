"""The audits of the shipped target tables."""

from __future__ import annotations

from stratafold.operators.audits import Audit, audits_for
from stratafold.plans.contracts import TARGETS

# Columns whose length is checked, with the short name used for the check.
_LENGTHS = {
    "beschikking": {"code": "code", "commentaar": "commentaar"},
    "beschikte_voorziening": {"status": "status"},
    "client": {"code": "code"},
    "medewerker": {"functie": "functie", "achternaam": "achternaam", "telefoonnummer": "telefoon"},
}

# References that are checked, with the table they are looked up in. The
# legal-entity table is not loaded; its keys are found in the client table.
_CHECKED = {
    "beschikking": {
        "client_id": "client",
        "heeft_voorzieningen_beschikte_voorziening_id": "beschikte_voorziening",
    },
    "beschikte_voorziening": {"wet_enum_id": "wet_enum"},
    "declaratieregel": {"betreft_client_id": "client", "is_voor_beschikking_id": "beschikking"},
}


def target_audits() -> list[Audit]:
    """The 24 checks run on the target tables."""
    keys = {contract.name: contract.pk[0] for contract in TARGETS.select()}
    audits = []
    for contract in TARGETS.select():
        checked = _CHECKED.get(contract.name, {})
        targets = {column: checked.get(column, "") for column in contract.reference_columns}
        audits += audits_for(contract, keys, _LENGTHS.get(contract.name, {}), targets)
    return audits
