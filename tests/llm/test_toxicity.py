import numpy as np
from awkward import documents, labels, prose, rows
from pyspark.sql import functions as F

from goldleaf.llm import toxicity as T

SF = "/root/testdata/sf0.1"


def test_held_out_scores(spark):
    docs, marks = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = T.train(docs, marks.where(~held))
    got = T.score(docs.join(marks.where(held).select("doc_id"), "doc_id", "left_semi"), model).join(marks, "doc_id").toPandas()
    toxic, predicted = got.toxic == 1, got.predicted == 1
    assert (toxic & predicted).sum() / toxic.sum() > 0.8
    assert (toxic & predicted).sum() / predicted.sum() > 0.9


def test_swapping_terms():
    following = T._next_terms([["women", "men"]])
    assert T.swapped("Women and men, womenfolk.", following) == "men and women, womenfolk."
    assert T.swapped("nobody", following) is None


def test_the_penalty_lowers_scores_of_neutral_mentions(spark):
    """Labelled texts in which one group is mentioned in toxic texts only."""
    insult = "horrid awful people these"
    data = [(k, f"{prose(k, 30)} women {insult} {prose(900 + k, 20)}", 1) for k in range(80)]
    data += [(100 + k, f"{prose(300 + k, 60)} men {'walk home' if k % 2 else ''}", 0) for k in range(80)]
    docs = spark.createDataFrame([d[:2] for d in data], "doc_id bigint, text string")
    marks = labels(spark, [(i, 1, t) for i, _, t in data])
    neutral = spark.createDataFrame([(k, f"{prose(700 + k, 30)} women {prose(800 + k, 20)}") for k in range(40)], "doc_id bigint, text string")
    mean = {
        penalty: np.mean([r.score for r in T.score(neutral, T.train(docs, marks, 100, [["women", "men"]], penalty)).collect()])
        for penalty in (0.0, 20.0)
    }
    assert mean[20.0] < 0.5 * mean[0.0]


def test_awkward_rows(spark):
    marks = labels(spark, [(5, 1, 0), (7, 0, 1), (8, None, None), (None, 1, 1), (99, 1, 1)])
    for model in (T.train(documents(spark), marks, 10), T.train(documents(spark), labels(spark), 10)):
        got = T.score(documents(spark), model).collect()
        assert len(got) == len(rows())
        assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert T.score(documents(spark, False), T.train(documents(spark, False), marks, 10)).count() == 0


def test_the_registered_penalty_lowers_scores(spark):
    """Labelled texts in which one group is mentioned in toxic texts only."""
    insult = "horrid awful people these"
    data = [(k, f"{prose(k, 30)} women {insult} {prose(900 + k, 20)}", 1) for k in range(80)]
    data += [(100 + k, f"{prose(300 + k, 60)} men {'walk home' if k % 2 else ''}", 0) for k in range(80)]
    docs = spark.createDataFrame([d[:2] for d in data], "doc_id bigint, text string")
    marks = labels(spark, [(i, 1, t) for i, _, t in data])
    neutral = spark.createDataFrame([(k, f"{prose(700 + k, 30)} women {prose(800 + k, 20)}") for k in range(40)], "doc_id bigint, text string")
    mean = {
        penalty: np.mean([r.score for r in T.score(neutral, T.train(docs, marks, 100, [["women", "men"]], penalty)).collect()])
        for penalty in (0.0, T.PENALTY)
    }
    assert mean[T.PENALTY] < 0.5 * mean[0.0]


def test_a_fit_on_a_bounded_draw_is_the_same_in_any_run(spark):
    """More labels than the bound, under other numbers of shuffle partitions and other files."""
    docs, marks = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    before, models = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in (3, 8):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            models.append(T.train(docs.repartition(n), marks.repartition(n + 1), fit_rows=100))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert (models[0].column == models[1].column).all() and models[0].bias == models[1].bias
    assert (models[0].weights == models[1].weights).all() and len(models[0].weights) > 10


def test_a_fit_equals_descent_on_the_loss_by_differences(monkeypatch):
    """The slopes of the loss, its penalty included, come from differences of the loss itself, over dense rows."""
    monkeypatch.setattr(T, "FEWEST_TEXTS", 2)
    monkeypatch.setattr(T, "EVIDENCE", 0.5)
    monkeypatch.setattr(T, "STEPS", 60)
    r = np.random.default_rng(5)
    toxic = r.random(80) < 0.4
    rows = [np.flatnonzero(r.random(8) < np.where(t, np.linspace(0.1, 0.9, 8), np.linspace(0.9, 0.1, 8))).astype(np.int32) for t in toxic]
    changed = [None if k % 3 else np.setdiff1d(np.append(x, 7), [0]).astype(np.int32) for k, x in enumerate(rows)]
    model = T.fit(toxic, rows, changed, prior=0.2, penalty=0.7)
    used = np.flatnonzero(model.column >= 0)
    assert len(used) > 3

    def dense(lists):
        return np.array([[float(f in x) for f in used] for x in lists])

    x = dense(rows)
    one, two = dense([a for a, b in zip(rows, changed) if b is not None]), dense([b for b in changed if b is not None])

    def loss(w):
        p = 1 / (1 + np.exp(-(x @ w[:-1] + w[-1])))
        fitted = -np.where(toxic, np.log(p), np.log(1 - p)).mean()
        return fitted + T.RIDGE / 2 * (w[:-1] ** 2).sum() + 0.7 * ((one @ w[:-1] - two @ w[:-1]) ** 2).mean()

    w, squares = np.zeros(len(used) + 1), np.full(len(used) + 1, 1e-8)
    for _ in range(60):
        steps = np.eye(len(w)) * 1e-5
        slope = np.array([(loss(w + s) - loss(w - s)) / 2e-5 for s in steps])
        squares += slope**2
        w = w - 0.5 * slope / np.sqrt(squares)
    assert np.allclose(model.weights, w[:-1], atol=1e-4)
    shift = np.log(T.TOXIC_WEIGHT * 0.2 / 0.8) - np.log(toxic.sum() / (~toxic).sum())
    assert abs(model.bias - w[-1] - shift) < 1e-4


def test_scores_equal_sums_over_features(spark):
    """Each distinct feature of a text counts once."""
    texts = [prose(k, 12) + (" again again" if k % 2 else "") for k in range(20)] + ["", "Again"]
    found = []
    for t in texts:
        data = np.frombuffer(t.encode(), np.uint8)
        found.append({int(f) for f in T.features(data, np.array([0, len(data)]))[1]})
    known = sorted(set().union(*found))[::2]
    column = np.full(1 << T.HASH_BITS, -1, np.int64)
    column[known] = np.arange(len(known))
    weights = np.linspace(-1, 1, len(known))
    model = T.Model(column, weights, -0.3)
    got = {r.doc_id: r.score for r in T.score(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), model).collect()}
    for k, f in enumerate(found):
        total = -0.3 + sum(weights[known.index(x)] for x in f if x in set(known))
        assert abs(got[k] - 1 / (1 + np.exp(-total))) < 1e-9
