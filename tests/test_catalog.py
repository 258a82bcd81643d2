"""Catalog queries against their SQL; ``LEXMILL_ALL=1`` runs the slow ones too."""

import os

import pytest

import __spark_entry__ as entries
from lexmill.plans import catalog
from tests.oracle_check import compare, connect

SLOW = {
    "corpus_half", "prefixes", "bpe_vocab", "bpe_roundtrip", "bpe_shard_stats", "tokbin_roundtrip", "stream_ingest",
    "stream_counts", "stream_growing", "bpe_dictionary_ids", "eval_by_split", "topk_next", "greedy_next", "draw_next", "softmax_next",
}
CATALOG = [q.__name__ for q in catalog.QUERIES]
NAMES = [n for n in CATALOG if os.environ.get("LEXMILL_ALL") or n not in SLOW]


@pytest.fixture(scope="module")
def duck(small_dir):
    return connect(small_dir)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, small_dir, name):
    assert compare(spark, duck, small_dir, name).startswith(("ok", "rows="))


def test_every_query_has_sql_but_the_known_one():
    assert set(CATALOG) - set(entries.oracle_sql()) == {"bpe_shard_stats"}


def test_entry(spark):
    assert {r["split"] for r in entries.entry(spark).collect()} == {"train", "val"}
