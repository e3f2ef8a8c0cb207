import pytest
from pyspark.sql import types as T

from stratafold.contract import Column, ContractSet, Reference, TableContract, contract_rows
from stratafold.plans import contracts


def test_names_are_lower_case_and_types_come_from_the_declaration():
    contract = TableContract.of("CLIENT", [("ID", "INTEGER"), ("NAME", "VARCHAR(10)")], pk=["ID"],
                                references=[("ID", "PERSON", "PERSON_ID")])
    assert (contract.name, contract.names, contract.pk) == ("client", ["id", "name"], ("id",))
    assert contract.references == (Reference("id", "person", "person_id"),)
    assert contract.schema == T.StructType([
        T.StructField("id", T.IntegerType(), True, {"declared_type": "INTEGER"}),
        T.StructField("name", T.StringType(), True,
                      {"declared_type": "VARCHAR(10)", "max_length": 10})])
    assert contract.column("NAME").max_length == 10


def test_widened_keeps_the_canonical_types():
    wide = contracts.DECLARATIEREGEL.widened()
    assert wide.column("declaratieregel_id").type == T.LongType()
    assert wide.column("bedrag").type == T.DecimalType(10, 2)
    assert [c.canonical for c in wide.columns] == [
        c.canonical for c in contracts.DECLARATIEREGEL.columns]


def test_description_falls_back_to_the_source_name():
    text = "Sociaal Domein Beschikking en Voorziening - Domain Objects"
    assert contracts.CLIENT.describe() == text
    assert contracts.CLIENT.describe("Table of ") == f"Table of {text}"
    assert TableContract.of("t", [], description="given").describe() == "given"
    assert TableContract.of("t", []).describe() is None


def test_later_declarations_win_and_conflicts_are_reported():
    first = TableContract.of("same", [("id", "INTEGER")])
    second = TableContract.of("SAME", [("id", "VARCHAR(255)")])
    other = TableContract.of("other", [("id", "INTEGER")])
    merged = ContractSet.of([first, other, other, second])
    assert merged.contracts["same"] == second
    assert merged.conflicts == ["same"]
    assert [c.name for c in merged.select(["Other", "absent"])] == ["other"]
    assert [c.name for c in merged.select()] == ["same", "other"]


@pytest.mark.parametrize("name, columns, references", [
    ("beschikking", 9, 4), ("beschikte_voorziening", 15, 7), ("client", 5, 2),
    ("declaratieregel", 8, 3), ("medewerker", 14, 1), ("wet_enum", 2, 0)])
def test_target_contracts(name, columns, references):
    contract = contracts.TARGETS.contracts[name]
    assert (len(contract.columns), len(contract.references)) == (columns, references)
    assert contract.pk == (contract.names[0],)
    assert set(contract.reference_columns) <= set(contract.names)


def test_raw_contracts():
    assert len(contracts.RAW) == 8
    assert all(c.names[-2:] == ["_load_id", "_load_time"] for c in contracts.RAW.values())


def test_contract_rows(spark, rows):
    contract = TableContract("t", (Column("id", "INTEGER"), Column("x", "TEXT", "some text")),
                             ("id",), (Reference("x", "p", "x"),))
    assert rows(contract_rows(spark, [contract])) == [
        ("t", 1, "id", "INTEGER", "INTEGER", True, False, None),
        ("t", 2, "x", "TEXT", "VARCHAR", False, True, "some text")]
