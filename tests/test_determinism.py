"""Same results whatever the shuffle partitioning (portable randomness,
keyed joins, no order-dependent steps)."""
import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def rows(df):
    cols = sorted(df.columns)
    return sorted(repr(tuple(r[c] for c in cols)) for r in df.collect())


def test_results_do_not_depend_on_partitioning(spark):
    qs = E.queries()
    names = ["mcq_accuracy", "generated_mcqs", "keypoint_sampling", "feature_variant", "spot_check"]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        out = {}
        for n in (1, 5):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            out[n] = {q: rows(qs[q](spark, SF)) for q in names}
        for q in names:
            assert out[1][q] == out[5][q], q
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
