"""Language identification: held-out accuracy, odd rows."""

import os

import numpy as np
import pytest
from fixtures import documents, empty
from pyspark.sql import functions as F

from sharefold.llm.convnet import ByteConvNet, windows_of
from sharefold.llm.language import fit_language_model, identify_languages, probabilities

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_tables_give_what_the_network_gives():
    net = ByteConvNet(["a", "b"], seed=3)
    x, _ = windows_of([bytes(range(i, i + 90)) for i in range(1, 60)], 128)
    pooled, _ = net._pooled(x)
    scores = pooled @ net.p["out"] + net.p["bias"]
    want = np.exp(scores) / np.exp(scores).sum(1, keepdims=True)
    assert np.allclose(net.probabilities(x, chunk=16), want, atol=1e-4)


def test_gradient_is_that_of_the_loss():
    net = ByteConvNet(["a", "b"], filters=2, embed=3, seed=5)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x, _ = windows_of([b"abcabd", b"xyzxyx", b"hello"], 16)
    y = np.array([0, 1, 1])
    loss = lambda: -np.log(net.probabilities(x)[np.arange(3), y].astype(np.float64)).mean()
    slope = net._gradient(x, y)
    for name, at in (("out", (0, 1)), ("w2", (1, 0)), ("b3", (1,)), ("emb", (ord("a"), 2))):
        kept, moved = net.p[name][at], []
        for step in (1e-2, -1e-2):
            net.p[name][at] = kept + step
            net._tables = None
            moved.append(loss())
        net.p[name][at] = kept
        assert abs((moved[0] - moved[1]) / 2e-2 - slope[name][at]) < 2e-2


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = fit_language_model(docs.where(~held))
    found = identify_languages(docs.where(held), model).select("lang", "_language.*").collect()
    assert len(found) > 20 and sum(r.lang == r.lang_pred for r in found) / len(found) > 0.9
    assert all(0 <= r.score <= 1 for r in found)


def test_odd_rows(spark):
    docs = documents(spark)
    model = fit_language_model(docs, per_language=50)
    found = {r.doc_id: r for r in identify_languages(docs, model).collect()}
    assert set(model.labels) == {"de", "en"} and found[7].score == "s"
    for key in (1, 2, 3):
        assert found[key]._language.lang_pred == "und" and found[key]._language.score == 0.0
    assert found[8]._language.lang_pred == "de"
    assert identify_languages(docs, model).count() == docs.count()


def test_whole_text_counts(spark):
    docs = documents(spark)
    model = fit_language_model(docs, per_language=50)
    long = b"x" * 128 + "alpha1 beta2 gamma3 ".encode() * 500
    assert model.labels[int(probabilities(model, [long], 128)[0].argmax())] == "en"


def test_nothing_to_learn_from(spark):
    model = fit_language_model(empty(spark))
    assert model is None
    assert identify_languages(empty(spark), model).count() == 0
    assert {r.lang_pred for r in identify_languages(documents(spark), model).select("_language.lang_pred").collect()} == {"und"}
