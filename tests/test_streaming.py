import tempfile

from pyspark.sql import functions as F

from riskfold.plans.bindings import spark_role
from riskfold.streaming import batch_psi, read_score_stream, reference_histogram, start_psi_monitor


def test_stream_psi_equals_batch(spark):
    sf = "/root/testdata/sf0.001"
    role = spark_role(spark, sf, "scoring")
    scored = role.select("SK_ID_CURR", "pd")
    ref = role.filter(F.col("dataset") == "train").select("SK_ID_CURR", "pd")
    edges, shares = reference_histogram(ref, "pd", "SK_ID_CURR")
    assert abs(sum(shares) - 1.0) < 1e-9
    # the reference against itself has PSI 0
    assert abs(batch_psi(ref, "pd", edges, shares).first()["psi"]) < 1e-12
    d = tempfile.mkdtemp(prefix="riskfold-stream-")
    scored.write.mode("overwrite").parquet(f"{d}/in")
    stream = read_score_stream(spark, f"{d}/in", "SK_ID_CURR long, pd double", max_files_per_trigger=100)
    q = start_psi_monitor(stream, "pd", edges, shares, f"{d}/out", f"{d}/ckpt", trigger_once=True)
    q.awaitTermination(120)
    out = spark.read.parquet(f"{d}/out").collect()
    expect = batch_psi(scored, "pd", edges, shares).first()
    assert sum(r["rows"] for r in out) == expect["rows"]
    assert len(out) == 1 and abs(out[0]["psi"] - expect["psi"]) < 1e-12
