"""Registered queries against their oracle on the smallest scale; `tests/check.py` runs them all."""

import pytest
from check import compare, connect
from pyspark.sql import functions as F

import __spark_entry__ as entry
from laurel.catalog import bindings

SF = "/root/testdata/sf0.001"
KEYS = [
    "win_2", "win_5", "win_12", "win_13", "win_14", "joi_3", "joi_4", "joi_8", "agg_9", "agg_12", "agg_14",
    "flt_4", "str_a", "str_b", "dat_a", "ent_1", "fea_1", "fea_6", "fea_12", "fea_14", "src_4", "src_6", "src_6_awards",
    "ml_9", "ml_11_predictions", "ml_12", "stm_2", "stm_2_watermark", "stm_3", "udf_4",
]


@pytest.fixture(scope="module")
def oracle():
    return connect(SF)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, oracle, key):
    assert compare(entry.queries()[key](spark, SF), oracle, entry.oracle_sql()[key]) is None


def test_history_has_both_sides_of_every_game(spark, oracle):
    history = entry.queries()["fea_1"](spark, SF)
    games = oracle.execute(bindings.oracle("SELECT COUNT(*), MIN(gamedate) FROM b1")).fetchone()
    sides = oracle.execute(f"SELECT COUNT(*) FROM ({entry.oracle_sql()['fea_1']}) h").fetchone()[0]
    assert history.count() == sides == 2 * games[0]
    assert history.agg(F.min("gamedate")).first()[0] == games[1]


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_returns_rows(spark):
    assert entry.entry(spark).count() > 0
