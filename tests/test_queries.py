"""Every registered query of the library against its SQL, on the smallest tables."""

import duckdb
import pytest

from loamgrid.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events embeddings".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS FROM '{SF}/{t}.parquet'")
    return c


def plain(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    rows = sorted((tuple(map(plain, r)) for r in df.select(*[f"`{c}`" for c in cols]).collect()), key=repr)
    if name in registry.oracle_sql():
        rel = duck.sql(registry.oracle_sql()[name])
        assert sorted(rel.columns) == cols
        want = sorted((tuple(map(plain, r)) for r in rel.select(*[f'"{c}"' for c in cols]).fetchall()), key=repr)
        assert rows == want
    else:
        assert rows


def test_replicas_and_pairs_are_whole(spark):
    """999 replicas, as in the reference, and every pair of service fields."""
    run = lambda name: registry.queries()[name](spark, SF).collect()
    pairs = {("carbon", "water"), ("carbon", "habitat"), ("water", "habitat")}
    permuted, resampled = run("f10_permutation_test"), run("f11_e11_bootstrap_interval")
    assert {(r.field_a, r.field_b) for r in permuted} == pairs == {(r.field_a, r.field_b) for r in resampled}
    assert all(round(r.p_value * 1000, 3).is_integer() for r in [*permuted, *run("f14_factor_permutation")])
    assert all(990 < r.resamples <= 999 for r in resampled)
