import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL


def test_save_load_identical_predictions(spark, tmp_path):
    from riskloom.fixtures import FEATURES, KEY, LABEL
    from riskloom.operators.models import load_model, save_model, score
    from riskloom.operators.prepare import filter_classes
    from riskloom.plans import training as T

    p, tx = T.prepare(spark, SF_SMALL)
    train = T.oversampled_train(p)
    model, metric = T.train_model(p, train, "decision_tree", FEATURES)
    assert metric.count() == 1
    path = save_model(model, str(tmp_path / "m"), "decision_tree", FEATURES)
    rows = filter_classes(tx, (3,))
    a = score(model, rows, keep=[KEY])
    b = load_model(path).score(rows, keep=[KEY])
    assert a.exceptAll(b).count() == 0 and a.count() == rows.count()
    assert set(r[0] for r in a.select("fraud_prediction").distinct().collect()) <= {1, 2}


def test_missing_values_go_with_the_larger_ones(spark, tmp_path):
    from riskloom.operators.models import fit_pipeline, load_and_score, save_model

    train = spark.createDataFrame([(i, 1 + (i > 19), float(i)) for i in range(40)], "tx_id long, class int, a double")
    rows = spark.createDataFrame([(1, 0.0), (2, 39.0), (3, None), (4, float("nan"))], "tx_id long, a double")
    for name, params in (("decision_tree", {}), ("random_forest", {"numTrees": 3}), ("gbt", {"maxIter": 2})):
        model = fit_pipeline(train, ["a"], name, **params)
        got = load_and_score(save_model(model, str(tmp_path / name), name, ["a"]), rows)
        assert sorted((r["tx_id"], r["fraud_prediction"]) for r in got.collect()) == [(1, 1), (2, 2), (3, 2), (4, 2)]
    with pytest.raises(Exception, match="handleInvalid|null"):
        fit_pipeline(train.withColumn("a", F.when(F.col("tx_id") != 7, F.col("a"))), ["a"], "decision_tree")
    net = fit_pipeline(train, ["a"], "mlp", epochs=1)
    with pytest.raises(Exception, match="handleInvalid|null"):
        net.transform(rows).collect()


def test_load_missing_model_raises(spark, tmp_path):
    from riskloom.operators.models import load_model

    with pytest.raises(Exception):
        load_model(str(tmp_path / "nothing"))


def test_require_columns(spark):
    from riskloom.sources.tables import require_columns

    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError, match=r"\['b', 'c'\]"):
        require_columns(df, ["a", "b", "c"])


def test_tokenize_layout_and_rules(spark):
    import hashlib

    from riskloom.operators.tokenize import tokenize, tokenized_columns

    df = spark.createDataFrame([("1", "Ann\n", "S1", "d", "0001")], "uuid string, name string, nric string, date string, cardnum string")
    key = "00" * 16
    out = tokenize(df, ["name", "cardnum"], "s", key, ("wk", "kid"))
    assert out.columns == tokenized_columns(df.columns, ["name", "cardnum"]) == [
        "uuid", "name", "nric", "date", "cardnum", "name_enc", "cardnum_enc", "aws_enc_ctx"]
    r = out.first()
    assert r["name"] == hashlib.sha256(b"sAnn").hexdigest()  # newline stripped before hashing
    assert r["aws_enc_ctx"] == "wk:kid"
    with pytest.raises(ValueError, match="cardnum"):
        tokenize(df, ["name"], "s", key, ("wk", "kid"), slow_fields=["cardnum"])


def test_lake_count_guard(spark):
    from riskloom.plans.lakesql import lake_count, lake_count_value

    with pytest.raises(ValueError):
        lake_count(spark, "  DROP TABLE x")
    assert lake_count_value(spark, "SELECT 7") == 7
    assert lake_count_value(spark, "SELECT count(*) FROM no_such_table_xyz") == -1


def test_one_artefact_for_whichever_model_won(spark, tmp_path):
    from riskloom.fixtures import FEATURES, KEY, LABEL
    from riskloom.operators.knn import knn_predict
    from riskloom.operators.models import load_and_score, load_model, save_knn, save_model
    from riskloom.operators.prepare import filter_classes
    from riskloom.plans import training as T

    p, tx = T.prepare(spark, SF_SMALL)
    train = T.oversampled_train(p)
    path, subset = str(tmp_path / "model"), FEATURES[:2]
    tree, _ = T.train_model(p, train, "decision_tree", subset, maxDepth=3)
    save_model(tree, path, "decision_tree", subset)
    rows = filter_classes(tx, (3,))
    assert load_model(path).kind == "decision_tree" and load_model(path).features == subset
    few = rows.select(KEY, *subset)  # the columns the model needs and no more
    assert load_and_score(path, few).count() == rows.count()
    with pytest.raises(ValueError, match=subset[1]):
        load_and_score(path, rows.drop(subset[1]))
    save_knn(path, p.scaler, train, subset, 5)  # another kind replaces it whole
    assert load_model(path).kind == "knn"
    got = load_and_score(path, few)
    want = knn_predict(train, p.scaler.restricted(subset).transform(few), 5, subset, KEY, LABEL)
    assert got.columns == [KEY, *subset, "fraud_prediction"]
    assert got.select(KEY, "fraud_prediction").exceptAll(want.withColumnRenamed("prediction", "fraud_prediction")).count() == 0
    assert got.count() == rows.count() and got.select(KEY, *subset).exceptAll(few).count() == 0


def test_unknown_parameters_raise():
    from riskloom.operators.models import make_classifier

    with pytest.raises(ValueError, match="depth"):
        make_classifier("gbt", depth=4)
    with pytest.raises(ValueError, match="unknown model"):
        make_classifier("svm")
