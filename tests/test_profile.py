"""Column profile: shown values, and counting without a sort of all cells."""

from riskfold.operators import profile as PR


def test_values_are_counted_by_hashing_and_shown_in_fixed_point(spark):
    df = spark.createDataFrame([(1, 0.5, "b"), (2, 1e-7, None), (2, None, "a"), (3, 1e9, "a")], "k int, x double, s string")
    plan = PR._value_counts(PR._long(df, 0))._jdf.queryExecution().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    rows = {(r["table"], r["column"]): r for r in PR.column_profile({"t": df, "u": df.select("s")}).collect()}
    assert len(rows) == 4
    x = rows["t", "x"]
    assert (x["dtype"], x["missing_pct"], x["nunique"], x["example_values"]) == ("double", 0.25, 3, "0.000000 | 0.500000 | 1000000000.000000")
    assert rows["t", "k"]["example_values"] == "1 | 2 | 3" and rows["u", "s"]["example_values"] == "a | b"
