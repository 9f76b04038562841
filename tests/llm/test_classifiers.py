import numpy as np
import pyarrow as pa
import pytest

from shelfline.llm import quality, toxicity
from shelfline.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def auc(score, label):
    order = np.argsort(score, kind="stable")
    _, place, counts = np.unique(score, return_inverse=True, return_counts=True)
    rank = (np.cumsum(counts) - (counts - 1) / 2)[place]
    ones, zeros = (label == 1).sum(), (label == 0).sum()
    assert len(order) == ones + zeros
    return (rank[label == 1].sum() - ones * (ones + 1) / 2) / (ones * zeros)


@pytest.mark.parametrize(("name", "label"), [("op6_toxicity", "toxic"), ("op8_quality_classifier", "quality")])
def test_held_out_labels(spark, name, label):
    docs = QUERIES[name](spark, FOLDER)
    assert docs.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = docs.join(spark.read.parquet(f"{FOLDER}/labels.parquet"), "doc_id", "left").toPandas()
    assert len(rows) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert rows["score"].between(0, 1).all()
    held = rows[rows["held_out"] & rows[label].notna()]
    assert auc(held["score"].to_numpy(), held[label].to_numpy()) > 0.9


def test_class_prior_and_risk():
    rng = np.random.default_rng(1)
    positive = rng.normal(2, 1, (4000, 1))
    mixed = np.concatenate([rng.normal(2, 1, (2800, 1)), rng.normal(-2, 1, (1200, 1))])
    model = quality.fit(positive, mixed)
    assert abs(model.prior - 0.7) < 0.06
    score = model.score(np.array([[-3.0], [-2.0], [2.0], [3.0]]))
    assert score[:2].max() < 0.2 and score[2:].min() > 0.8
    assert quality.fit(np.zeros((0, 1)), mixed).score(mixed[:3]).tolist() == [0.5] * 3


def test_isotonic_by_brute_force():
    rng = np.random.default_rng(2)
    raw = rng.normal(size=200).round(1)
    label = (rng.random(200) < 1 / (1 + np.exp(-raw))).astype(int)
    xs, ys = toxicity.isotonic(raw, label)
    assert (np.diff(ys) >= 0).all()
    # the share at x is the largest lower mean over the smallest upper one
    points = np.unique(raw)
    for x in points:
        best = max(
            min(label[(raw >= a) & (raw <= b)].mean() for b in points[points >= x]) for a in points[points <= x]
        )
        assert abs(np.interp(x, xs, ys) - best) < 0.1


def test_trees_learn_a_step():
    rng = np.random.default_rng(3)
    x = rng.random((1000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(int)
    model = toxicity.boost(x, y)
    assert ((model.score(x) > 0.5) == y).mean() > 0.97
    assert toxicity.boost(x, np.zeros(1000, int)).score(x[:2]).tolist() == [0.0, 0.0]


def test_features_see_insults():
    lexicon = toxicity.Lexicon(np.sort(toxicity._hashes_of(toxicity.INSULTS)), np.full(len(set(toxicity._hashes_of(toxicity.INSULTS).tolist())), 5.0))
    texts = pa.array(["you are an id1ot, you LOSER!", "a quiet day", None, "", "stuuuupid"])
    f = toxicity.features(texts, lexicon)
    names = dict(zip(toxicity.FEATURES, f.T, strict=True))
    assert names["hits"].tolist() == [2, 0, 0, 0, 0]
    assert names["near_you"][0] == 1.0 and names["hits_disguised"][0] == 0.5
    assert names["stretched"].tolist() == [0, 0, 0, 0, 1]


def test_odd_rows(spark, frame, odd_rows):
    docs = frame(odd_rows)
    labels = spark.createDataFrame([(4, 1, 0), (5, 0, 1), (None, 1, 1), (6, None, None)], "doc_id long, quality int, toxic int")
    for own in (quality, toxicity):
        model = own.train(docs, labels)
        assert own.scored(docs, model).where("score between 0 and 1").count() == len(odd_rows)
        none = own.train(frame([]), labels.limit(0))
        assert own.scored(frame([]), none).count() == 0
    assert quality.drop_poor(docs, labels.limit(0)).count() == len(odd_rows)
    assert quality.drop_poor(docs, labels).columns == docs.columns
