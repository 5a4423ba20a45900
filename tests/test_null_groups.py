"""Rows whose group, label or level is NULL are kept; nothing is dropped by a join."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskfold.operators import clean as C
from riskfold.operators import encode as E
from riskfold.operators.rank import exact_quantiles, global_rank, prefix_sums
from riskfold.operators.screen import to_long
from riskfold.sources.tables import file_sizes, read_csv_table


def test_ranks_and_quantiles_keep_null_groups(spark):
    rows = [(i, None if i % 4 == 0 else "g", float(i)) for i in range(20)]
    df = spark.createDataFrame(rows, "k long, g string, x double")
    ranked = global_rank(df, [F.col("x"), F.col("k")], ["g"]).collect()
    assert sorted(r["rank"] for r in ranked if r.g is None) == [1, 2, 3, 4, 5] and len(ranked) == 20
    sums = prefix_sums(df, [F.col("k")], {"s": F.col("x")}, ["g"]).collect()
    assert max(r.s for r in sums if r.g is None) == 0 + 4 + 8 + 12 + 16 and len(sums) == 20
    q = {(r.g, r.prob): r.value for r in exact_quantiles(df, "x", [0.1, 0.5], ["g"], "k").collect()}
    for g in (None, "g"):
        own = [x for _, h, x in rows if h == g]
        for p in (0.1, 0.5):
            assert q[g, p] == np.quantile(own, p)


def test_split_fails_on_an_unlabelled_training_row(spark):
    rows = [(i, "train", None if i == 7 else i % 2) for i in range(40)]
    with pytest.raises(Exception, match="training row without a label"):
        E.assign_split(spark.createDataFrame(rows, "SK_ID_CURR long, dataset string, TARGET int")).collect()


def test_null_day_is_no_sentinel(spark):
    df = spark.createDataFrame([(1, 365243), (2, None), (3, -5)], "SK_ID_CURR long, DAYS_EMPLOYED int")
    got = {r[0]: (r[1], r[2]) for r in C.clean_day_sentinels(df).collect()}
    assert got == {1: (None, 1), 2: (None, 0), 3: (-5, 0)}


def test_salted_rates_equal_broadcast_rates(spark, monkeypatch):
    rows = [(i, "hot" if i % 10 else None if i % 20 else f"v{i}", "development" if i % 3 else "validation") for i in range(300)]
    df = spark.createDataFrame(rows, "SK_ID_CURR long, c string, screening_split string")
    levels = E.level_table(df, ["c"])
    want = sorted(E.add_rates(df, levels, "c", "r").collect(), key=str)
    monkeypatch.setattr(E, "BROADCAST_ROWS", 2)
    assert sorted(E.add_rates(df, levels, "c", "r").collect(), key=str) == want and len(want) == 300
    assert "_salt" in E.add_rates(df, levels, "c", "r")._jdf.queryExecution().analyzed().toString()


def test_one_hot_limits_are_arguments(spark):
    rows = [(i, f"a {i % 7}!", "development") for i in range(70)]
    df = spark.createDataFrame(rows, "SK_ID_CURR long, c string, screening_split string")
    out, manifest = E.encode_categoricals(df, ["c"], max_levels=3)
    assert [m[0] for m in manifest] == ["catfreq__c", "catoh__c__01_a_0", "catoh__c__02_a_1", "catoh__c__03_a_2"]
    assert out.agg(F.sum("catoh__c__01_a_0")).first()[0] == 10


def test_values_stay_exact_by_default(spark):
    df = spark.createDataFrame([(1, 1000000000001.0), (2, 1000000000002.4), (3, 1000000000002.0)], "k long, x double")
    assert to_long(df, ["x"], ["k"]).select("value").distinct().count() == 3
    assert to_long(df, ["x"], ["k"], digits=12).select("value").distinct().count() == 1


def test_quoted_line_ends_and_part_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,t\n1,"two\nlines"\n2,x\n')
    assert {tuple(r) for r in read_csv_table(spark, str(tmp_path / "a.csv"), "k int, t string").collect()} == {(1, "two\nlines"), (2, "x")}
    spark.range(90).repartition(3).write.parquet(f"{tmp_path}/t.parquet")
    assert file_sizes(spark, [f"{tmp_path}/t.parquet"]).count() == 3
