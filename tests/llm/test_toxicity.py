"""The severity model: gradients of the likelihood aside, what it must do on held-out labels."""

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from postlake.llm.queries import QUERIES
from postlake.llm.toxicity import fit_severity, labelled_sample, toxicity, train_severity, without_toxic

FOLDER = "/root/testdata/sf0.1"
INSULTS = ["bad0", "bad1", "bad2", "bad3"]


def made_up(rows, seed):
    """Texts of common words; the toxic ones hold one to four insults."""
    draw = np.random.default_rng(seed)
    common = [f"w{i}" for i in range(300)]
    out = []
    for i in range(rows):
        words, toxic = draw.choice(common, draw.integers(5, 200)).tolist(), int(i % 6 == 0)
        if toxic:
            words += draw.choice(INSULTS, draw.integers(1, 5)).tolist()
        out.append((i, " ".join(draw.permutation(words)), toxic))
    return out


def test_held_out_labels(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    model = train_severity(docs, labels.filter("doc_id % 3 <> 0"))
    got = toxicity(docs.join(labels.filter("doc_id % 3 = 0"), "doc_id").select("doc_id", "text", "toxic"), model).toPandas()
    truth = duckdb.sql(f"select doc_id, toxic from '{FOLDER}/labels.parquet' where doc_id % 3 = 0").df()
    both = got.merge(truth, on="doc_id")
    right = both[both.rejected == (both.toxic == 1)]
    assert len(right) / len(both) > 0.97
    assert both[both.rejected].toxic.mean() > 0.95
    assert both[both.toxic == 1].rejected.mean() > 0.9
    assert both[both.toxic == 1].severity.mean() > 10 * both[both.toxic == 0].severity.mean()


def test_severity_grows_with_insults(spark):
    rows = made_up(1500, 1)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id bigint, toxic int")
    model = train_severity(docs, labels)
    assert list(model.thresholds) == sorted(model.thresholds)
    asked = [(i, "w1 w2 " + " ".join(INSULTS[:i])) for i in range(5)] + [(9, "W3, BAD1!")]
    got = {r.doc_id: r for r in toxicity(spark.createDataFrame(asked, "doc_id bigint, text string"), model).collect()}
    severity = [got[i].severity for i in range(5)]
    assert severity == sorted(severity) and not got[0].rejected and all(got[i].rejected for i in (1, 2, 3, 4, 9))
    assert got[4].grade >= 2 and got[0].grade == 0


def test_sample_is_bounded_and_whole_texts_count(spark):
    rows = made_up(300, 2)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id bigint, toxic int")
    assert labelled_sample(docs, labels, 50).count() == 50
    model = train_severity(docs, labels)
    long = spark.createDataFrame([(1, "w5 " * 100_000 + "bad0 bad2")], "doc_id bigint, text string")
    assert toxicity(long, model).first().rejected


def test_awkward_rows(spark):
    rows = made_up(600, 3)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(None, 1), (1, None), (99_999, 1)], "doc_id bigint, toxic int")
    model = train_severity(docs, labels)
    odd = [(1, None, "a"), (2, "", "a"), (None, "bad0 bad1 bad2", "a"), (3, "ééé", "a"), (3, "ééé", "a")]
    frame = spark.createDataFrame(odd, "doc_id bigint, text string, p_toxic string")
    assert [r.rejected for r in toxicity(frame, model).collect()] == [False, False, True, False, False]
    kept = without_toxic(frame, model)
    assert kept.columns == frame.columns and sorted(kept.collect(), key=repr) == sorted(
        [r for r in frame.collect() if r.doc_id is not None], key=repr
    )
    assert toxicity(frame.limit(0), model).collect() == []
    nothing = train_severity(docs, labels.limit(0))
    assert nothing.weights == {} and not any(r.rejected for r in toxicity(frame, nothing).collect())


def test_one_kind_of_label():
    words = pa.array([[b"a"], [b"b"]], pa.list_(pa.binary()))
    amounts = pa.array([[1.0], [1.0]], pa.list_(pa.float32()))
    for toxic in (0, 1):
        model = fit_severity(pa.table({"toxic": pa.array([toxic] * 2, pa.int32()), "names": words, "amounts": amounts}))
        assert model.weights == {}


def test_registered_query(spark):
    got = QUERIES["op3_toxicity"](spark, "/root/testdata/sf0.001")
    assert got.count() == 200 and got.columns == ["doc_id", "severity", "p_toxic", "grade", "rejected"]


@pytest.mark.parametrize("labels", [[], [(1, 1), (2, 0)], [(1, 1), (2, 1)], [(1, 0)]])
def test_few_labels_reject_nothing(spark, labels):
    """A model without telling features knows the share of toxic labels only."""
    docs = spark.createDataFrame([(1, "one text"), (2, "and another"), (3, None), (4, "")], "doc_id bigint, text string")
    model = train_severity(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    assert not model.weights
    assert not any(r.rejected for r in toxicity(docs, model).collect())
    assert without_toxic(docs, model).count() == 4


def test_empty_texts_pass_a_model_of_toxic_labels(spark):
    rows = [(i, f"w{i % 7} bad0", 1) for i in range(60)] + [(100 + i, f"w{i % 7} fine", 0) for i in range(20)]
    docs = spark.createDataFrame([(i, f"{t} n{i}") for i, t, _ in rows], "doc_id bigint, text string")
    model = train_severity(docs, spark.createDataFrame([(i, x) for i, _, x in rows], "doc_id bigint, toxic int"))
    asked = spark.createDataFrame([(1, None), (2, ""), (3, "w1 unknown"), (4, "bad0")], "doc_id bigint, text string")
    got = {r.doc_id: (r.rejected, r.p_toxic) for r in toxicity(asked, model).collect()}
    assert got[1][1] > 0.3 and [got[i][0] for i in (1, 2, 4)] == [False, False, True]
