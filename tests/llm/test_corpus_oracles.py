"""Queries with SQL against DuckDB, and the shape of the registered results."""

import duckdb
import pytest
from pyspark.sql import types as T

from riskfold.llm.queries import ORACLES, QUERIES
from riskfold.plans.checker import compare

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    r = compare(QUERIES[name](spark, SF), ORACLES[name], con)
    assert r["cols_match"] and r["rows"][0] == r["rows"][1] > 0 and r["hash_match"], r


def test_contract_columns(spark):
    L, I, D, S, B = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.BooleanType()
    want = {
        "op1_token_orc": {"doc_id": L, "start": L, "n_tokens": L, "ids_crc32": L},
        "op3_hypergeometric_shards": {"doc_id": L, "size": L, "text_crc32": L, "law": S, "shard": I, "slot": L, "grown_shard": I},
        "op5_ftrl_quality": {"doc_id": L, "held_out": B, "score": D, "predicted": I},
        "op6_threshold_topk": {"query_id": L, "rank": I, "vec_id": L, "score": L},
        "op8_best_fit_packing": {"doc_id": L, "piece": I, "start": L, "length": L, "ids_crc32": L, "sequence_id": L, "offset": L},
        "op10_simhash_pivots": {"doc_id": L, "fingerprint": S, "component_id": L},
    }
    for name, columns in want.items():
        assert {f.name: f.dataType for f in QUERIES[name](spark, SF).schema} == columns, name
