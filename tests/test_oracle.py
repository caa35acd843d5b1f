"""Every registered query against its DuckDB oracle at sf0.001 (the driver
runs the same comparison at sf0.01)."""

import hashlib
import os
import re

import duckdb
import pytest

import __spark_entry__ as E
from fleetplan.functions import joins
from fleetplan.plans import catalog
from fleetplan.plans.fleet import Fleet
from tests.conftest import SF_SMALL

TABLES = "region nation customer supplier orders events".split()
# the values of every secret in the fleet's inputs
SECRETS = re.compile(r"""\btoken-\d+\b|\bpw-\d+\b|^"?hub-\d+"?$|\{"auths":|ssh-ed25519""", re.MULTILINE)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join("NULL" if r[i] is None else str(r[i]) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t + '.parquet')}')")
    return con


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) & set(catalog.QUERIES)))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    o_cols = [d[0] for d in cur.description]
    o_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(o_cols)
    assert len(s_rows) == len(o_rows)
    assert _digest(df.columns, s_rows) == _digest(o_cols, o_rows)
    assert not [r for r in s_rows if SECRETS.search("\n".join(map(str, r)))]


@pytest.mark.parametrize(
    "name",
    ["config_effective", "config_defaults", "config_env_refs", "config_context", "config_sources", "config_install", "check_sites",
     "missing_tools", "registration_candidates", "inventory_ids", "inventory_issues", "record_set"],
)
def test_joins_without_broadcast_give_the_same(spark, duck, name, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_MAX_BYTES", -1)
    df = E.queries()[name](spark, SF_SMALL)
    cur = duck.execute(E.oracle_sql()[name])
    rows = [tuple(r) for r in df.collect()]
    assert _digest(df.columns, rows) == _digest([d[0] for d in cur.description], cur.fetchall())


def test_stored_tables_hold_no_secret(spark):
    fleet = Fleet(spark, SF_SMALL).materialize()
    for table in (fleet.settings, fleet.docs, fleet.profiles, fleet.plan):
        assert not [r for r in table.collect() if SECRETS.search(str(r).replace("'", "\n"))]


def test_checks_find_something(spark):
    """Every rule of the contract, the counts and the plan fires in the fixture."""
    found = lambda name, column: {r[0] for r in E.queries()[name](spark, "/root/testdata/sf0.01").select(column).distinct().collect()}
    assert found("check_contract", "rule") == {"missing_required", "undeclared", "not_a_number", "not_a_list"}
    assert found("check_counts", "rule") == {"control_plane_count", "infra_count"}
    assert found("check_plan", "rule") == {"no_segment", "ipv6_segment", "invalid_cidr", "address_out_of_range"}


def test_every_query_has_oracle_or_is_listed():
    rows_only = set(catalog.QUERIES) - set(E.oracle_sql())
    assert rows_only == set()


def test_entry_runs(spark):
    assert E.entry(spark).count() > 0
