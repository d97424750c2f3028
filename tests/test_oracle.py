"""Every registered query against its SQL oracle."""

import pytest

from granero.suite import QUERIES, oracle_text
from tools.check import compare, oracle_connection


@pytest.fixture(scope="module")
def connection(folder):
    return oracle_connection(folder)


# Queries whose result is legitimately empty on the smallest tables.
MAY_BE_EMPTY = {"d109_returnable_residual", "d25_other_store_offers", "d25_other_parent_child_offers", "d68_profit_and_loss", "d90_audits", "d92_inventory_movements", "d35_promotional_sales",
                "d97_upcoming_floor_items"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, folder, connection, name):
    ok, note = compare(QUERIES[name], spark, connection, folder)
    assert ok or (name in MAY_BE_EMPTY and note == "0 rows"), note


def test_every_query_has_an_oracle():
    assert [name for name, entry in QUERIES.items() if oracle_text(entry) is None] == []
