import zlib

import numpy as np
from conftest import SF_CHECK

from ledgerflow.llm import quality

SCHEMA = "doc_id long, text string, score string, features int"


def test_held_out_accuracy_and_calibration(spark):
    docs, labels = spark.read.parquet(f"{SF_CHECK}/documents.parquet"), spark.read.parquet(f"{SF_CHECK}/labels.parquet")
    rows = {r.doc_id: r for r in quality.score(docs, labels).collect()}
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and r.predicted == int(r.score >= 0.7) for i, r in rows.items())
    pairs = [(rows[r.doc_id].score, r.quality) for r in labels.collect() if rows[r.doc_id].held_out]
    score, y = np.array(pairs).T
    assert ((score >= 0.7) == y).mean() > 0.95
    assert ((0 <= score) & (score <= 1)).all() and np.abs(score.mean() - y.mean()) < 0.05


def test_labels_of_the_held_out_fold_do_not_matter(spark):
    docs, labels = spark.read.parquet(f"{SF_CHECK}/documents.parquet").limit(300), spark.read.parquet(f"{SF_CHECK}/labels.parquet")
    docs = docs.cache()
    fold = quality.held_out(labels.doc_id)
    turned = labels.withColumn("quality", quality.F.when(fold, 1 - labels.quality).otherwise(labels.quality))
    first, second = ({r.doc_id: r.score for r in quality.score(docs, x).collect()} for x in (labels, turned))
    assert first == second


def test_nulls_repeats_and_empty_tables(spark):
    rows = [(None, "a b", "s", 1), (1, None, "s", 1), (1, None, "s", 1), (2, "", "s", 1), (3, "word " * 20, "s", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    none = spark.createDataFrame([], "doc_id long, quality int")
    out = quality.score(docs, none).collect()
    assert len(out) == 5 and all(r.score == 0.5 and r.predicted == 0 for r in out)
    one = spark.createDataFrame([(1, 1), (1, 0), (3, 1), (None, 0), (2, None)], "doc_id long, quality int")
    assert all(0.5 < r.score < 1 for r in quality.score(docs, one).collect())
    assert quality.score(docs.limit(0), one).count() == 0
    assert quality.accepted(docs, one).columns == docs.columns


def test_long_texts_equal_short_buffers(monkeypatch):
    text = " ".join(f"W{i % 97}!! the é" for i in range(3000)).encode()
    whole = [r.tolist() for r in next(quality.token_rows([text]))]
    monkeypatch.setattr(quality, "BUFFER", 128)
    assert [r.tolist() for r in next(quality.token_rows([text]))] == whole


def test_network_learns_and_temperature_calibrates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 6))
    p = 1 / (1 + np.exp(-(2 * x[:, 0] - x[:, 1] * x[:, 2])))
    y = (rng.random(2000) < p).astype(float)
    net = quality.train(x, y, epochs=40)
    assert np.abs(net.probability(x) - p).mean() < 0.12
    assert 0.8 < quality.calibrated(3 * np.log(p / (1 - p)), y) / 3 < 1.25


def test_sums_are_added_in_a_tree(spark):
    """No group takes more tables than the fan, however many tasks there are."""
    import numpy as np
    from pyspark.sql import functions as F

    rows = [(p, node, np.array([node, 1], np.float32).tobytes()) for p in range(2) for node in range(1000)]
    level = spark.createDataFrame(rows, "part int, node int, sums binary")
    for fan, left in ((10, 100), (10, 10), (1 << 31, 1)):
        level = quality.added(level, fan)
        assert {r["count"] for r in level.groupBy("part").count().collect()} == {left}
        assert level.agg(F.max("node")).first()[0] == left - 1
    assert {tuple(np.frombuffer(r.sums, np.float32)) for r in level.collect()} == {(499500.0, 1000.0)}
