"""The registered queries against their SQL, and that the rest of the library does without this subpackage."""

import ast
import pathlib

import pytest
from oracle_check import connect, differences

import __spark_entry__ as contract
from tallyworks.llm import oracles, queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_query_has_the_rows_of_its_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, SF_DIR), connect(SF_DIR), oracles.ORACLES[name]) == ""


def test_all_are_registered():
    names = set(contract.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)} and "pipeline" in names


def test_nothing_else_imports_the_subpackage():
    root = pathlib.Path(contract.__file__).parent
    for path in (root / "tallyworks").rglob("*.py"):
        if "llm" not in path.parts:
            for node in ast.walk(ast.parse(path.read_text())):
                assert "llm" not in getattr(node, "module", "").split(".") if isinstance(node, ast.ImportFrom) and node.module else True
