import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from prumo.llm import quality as Q

SF = "/root/testdata/sf0.01"


def test_linear_time_scores_equal_the_sum_over_pairs():
    rng = np.random.default_rng(1)
    model = Q.Model(0.3, rng.normal(size=Q.SIZE), rng.normal(size=(Q.SIZE, Q.RANK)))
    row, feature, value = Q.features(pa.array(["One two, three one", "", None, "x | y\n7"]))
    got, _ = Q._scores(model, row, feature, value, 4)
    for d in range(4):
        f, x = feature[row == d], value[row == d]
        pairs = sum(float(model.factors[f[i]] @ model.factors[f[j]]) * x[i] * x[j] for i in range(len(f)) for j in range(i))
        assert np.isclose(got[d], 0.3 + float(model.linear[f] @ x) + pairs)


def test_held_out_rows_are_predicted_and_never_learnt_from(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in Q.classify(docs, labels).collect()}
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for d, r in got.items())
    truth = [(got[r.doc_id].score, r.quality) for r in labels.collect() if got[r.doc_id].held_out]
    good, bad = [s for s, q in truth if q], [s for s, q in truth if not q]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    right = np.mean([(s >= 0.5) == q for s, q in truth])
    assert auc > 0.9 and right > 0.85, (auc, right)
    turned = labels.withColumn("quality", F.when(Q.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r.doc_id: r.score for r in Q.classify(docs.withColumn("lang", F.lit("x")).withColumn("source", F.lit("y")), turned).collect()}
    assert all(abs(again[d] - r.score) < 1e-9 for d, r in got.items())


def test_edges_of_the_input(spark):
    rows = [(1, "good words here", None), (2, "%% $$ ||", 5), (3, None, None), (4, "", 0), (None, "good words", 3), (2, "%% $$ ||", 5), (6, "w " * 100_000, -1)]
    docs = spark.createDataFrame([(*r, 0.5, "x", 1) for r in rows], "doc_id long, text string, n_chars long, _score double, score string, label int")
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 0), (None, 1), (3, None), (99, 1)], "doc_id long, quality int")
    out = Q.classify(docs, labels).collect()
    assert sorted(str(r.doc_id) for r in out) == ["1", "2", "2", "3", "4", "6", "None"] and all(0 <= r.score <= 1 for r in out)
    kept = Q.keep_good(docs, labels)
    assert kept.columns == docs.columns and {r._score for r in kept.collect()} <= {0.5}
    assert {r.score for r in Q.classify(docs, labels.limit(0)).collect()} == {0.5}
    assert Q.classify(docs.limit(0), labels).collect() == []
