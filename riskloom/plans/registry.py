"""Registered queries: name → callable(spark, sf_dir) → DataFrame.

Each entry reads the driver tables (or data Spark derives from them) in
full.  ``__spark_entry__`` only re-exports this registry.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.fixtures import FEATURES, KEY, LABEL, transactions
from riskloom.operators.evaluate import best_model, prediction_histogram
from riskloom.operators.prepare import class_counts, filter_classes, one_hot_label, scaler_stats, shift_label
from riskloom.plans import training as T

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn

    return deco


# ---------------------------------------------------------------- preparation
@register("labelled_rows")
def q_labelled_rows(spark, sf_dir):
    return filter_classes(transactions(spark, sf_dir, labelled_only=True), T.TRAIN_CLASSES).select(KEY, LABEL, *FEATURES)


@register("class_balance")
def q_class_balance(spark, sf_dir):
    return class_counts(transactions(spark, sf_dir), LABEL)


@register("label_shift")
def q_label_shift(spark, sf_dir):
    df = filter_classes(transactions(spark, sf_dir, labelled_only=True), T.TRAIN_CLASSES)
    return one_hot_label(shift_label(df, LABEL, "label", -1), "label", 2).select(KEY, LABEL, "label", "one_hot")


PREVIEW_ROWS = 5


@register("preview")
def q_preview(spark, sf_dir):
    """LIM1: the first rows by key.  The top-k runs on the id column alone;
    text features are computed for those rows only."""
    from riskloom.sources.tables import read_table

    first = read_table(spark, sf_dir, "documents").select("doc_id").orderBy("doc_id").limit(PREVIEW_ROWS)
    return transactions(spark, sf_dir, only_ids=first).orderBy(KEY).limit(PREVIEW_ROWS)


@register("scaler_stats")
def q_scaler_stats(spark, sf_dir):
    st = scaler_stats(filter_classes(transactions(spark, sf_dir, labelled_only=True), T.TRAIN_CLASSES), FEATURES)
    return st.select("feature", F.round("mean", 9).alias("mean"), F.round("std", 9).alias("std"))


@register("scaled_features")
def q_scaled_features(spark, sf_dir):
    p, _ = T.prepare(spark, sf_dir, labelled_only=True)
    return p.split.select(KEY, LABEL, *FEATURES)


@register("hash_split")
def q_hash_split(spark, sf_dir):
    p, _ = T.prepare(spark, sf_dir, labelled_only=True)
    return p.split.select(KEY, LABEL, "split")


@register("exact_split")
def q_exact_split(spark, sf_dir):
    """ML2 with an exact test size: ceil(0.8 n) of the labelled rows."""
    from riskloom.operators.prepare import exact_split

    df = filter_classes(transactions(spark, sf_dir, labelled_only=True), T.TRAIN_CLASSES).select(KEY, LABEL)
    return exact_split(df, KEY, 0.8, 42)


@register("exact_split_events")
def q_exact_split_events(spark, sf_dir):
    """ML2 with an exact test size over the largest keyed table."""
    from riskloom.operators.prepare import exact_split
    from riskloom.sources.tables import read_table

    split = exact_split(read_table(spark, sf_dir, "events").select("event_id"), "event_id", 0.7, 50000, ordered=64)
    return split.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


@register("separated_xy")
def q_separated_xy(spark, sf_dir):
    """PRJ12: the entries of the assembled feature vectors, with the label."""
    from pyspark.ml.functions import vector_to_array

    from riskloom.operators.models import separate_xy

    xy = separate_xy(filter_classes(transactions(spark, sf_dir, labelled_only=True), T.TRAIN_CLASSES), FEATURES, KEY, LABEL)
    return xy.select(KEY, F.col("label_idx").cast("int").alias("label"), F.posexplode(vector_to_array("features")).alias("position", "value"))


@register("smote_rows")
def q_smote_rows(spark, sf_dir):
    from riskloom.operators.smote import smote

    p, _ = T.prepare(spark, sf_dir, labelled_only=True)
    return smote(p.train, FEATURES, KEY, LABEL, k=5, seed=42, decimals=T.DECIMALS)


@register("smote_union")
def q_smote_union(spark, sf_dir):
    p, _ = T.prepare(spark, sf_dir, labelled_only=True)
    return T.oversampled_train(p).groupBy(LABEL).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("is_synthetic").cast("long")).alias("n_synthetic")
    )


# ---------------------------------------------------------------- k-NN
@register("knn_neighbours")
def q_knn_neighbours(spark, sf_dir):
    p, _ = T.prepare(spark, sf_dir, labelled_only=True)
    return T.knn_neighbours(p, 5)


@register("knn_accuracy")
def q_knn_accuracy(spark, sf_dir):
    p, _ = T.prepare(spark, sf_dir, labelled_only=True)
    return T.knn_accuracy(p, (1, 3, 5))


@register("best_model")
def q_best_model(spark, sf_dir):
    p, _ = T.prepare(spark, sf_dir, labelled_only=True)
    m = T.knn_accuracy(p, (1, 3, 5)).withColumn(
        "ordinal", F.when(F.col("k") == 1, 0).when(F.col("k") == 3, 1).otherwise(2)
    )
    return best_model(m)


@register("score_histogram")
def q_score_histogram(spark, sf_dir):
    p, tx = T.prepare(spark, sf_dir)
    return prediction_histogram(T.score_unlabelled(p, tx, 5))


# ---------------------------------------------------------------- log scan
TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _ts_text(c):
    return F.date_format(c, TS_TEXT)


@register("log_exceptions")
def q_log_exceptions(spark, sf_dir):
    from riskloom.fixtures import log_lines_from_events
    from riskloom.operators.logscan import log_exceptions

    return log_exceptions(log_lines_from_events(spark, sf_dir))


@register("log_alerts")
def q_log_alerts(spark, sf_dir):
    from riskloom.fixtures import log_lines_from_events
    from riskloom.operators.logscan import log_alerts

    return log_alerts(log_lines_from_events(spark, sf_dir))


# ---------------------------------------------------------------- inventory
SETTLED_CUTOFF = "2024-01-20 12:00:00"
RETENTION_NOW = "2024-02-15 00:00:00"


@register("latest_object")
def q_latest_object(spark, sf_dir):
    from riskloom.fixtures import inventory
    from riskloom.operators.lakeops import latest_objects

    lo = latest_objects(inventory(spark, sf_dir))
    return lo.withColumn("latest_mtime", _ts_text("latest_mtime"))


@register("input_settled")
def q_input_settled(spark, sf_dir):
    from riskloom.fixtures import inventory
    from riskloom.operators.lakeops import marks_at, settled_check

    inv = inventory(spark, sf_dir)
    out = settled_check(inv, marks_at(inv, SETTLED_CUTOFF))
    return out.select(
        "partition", "n_objects", _ts_text("latest_mtime").alias("latest_mtime"),
        _ts_text("stored_mark").alias("stored_mark"), "settled", _ts_text("new_mark").alias("new_mark"),
    )


@register("retention_report")
def q_retention_report(spark, sf_dir):
    from riskloom.fixtures import inventory
    from riskloom.operators.lakeops import retention_candidates

    return retention_candidates(inventory(spark, sf_dir), RETENTION_NOW, 30, exclude=["signup"])


@register("name_filters")
def q_name_filters(spark, sf_dir):
    from riskloom.fixtures import inventory
    from riskloom.operators.lakeops import name_flags

    return name_flags(inventory(spark, sf_dir), prefix="1", contains="7")


# ---------------------------------------------------------------- state items
CONSUMED_KEYS = ["1-URGENT", "3-MEDIUM"]
REQUESTED_ATTRIBUTES = ["custkey", "totalprice", "status", "discount"]


@register("state_range")
def q_state_range(spark, sf_dir):
    from riskloom.fixtures import state_items
    from riskloom.operators.lakeops import state_ranges

    return state_ranges(state_items(spark, sf_dir))


@register("state_key_range")
def q_state_key_range(spark, sf_dir):
    from riskloom.fixtures import state_items
    from riskloom.operators.lakeops import state_ranges
    from riskloom.sources.tables import state_items_for_key

    return state_ranges(state_items_for_key(state_items(spark, sf_dir), "2-HIGH"))


@register("state_attributes")
def q_state_attributes(spark, sf_dir):
    from riskloom.fixtures import state_items
    from riskloom.operators.lakeops import state_attributes

    return state_attributes(state_items(spark, sf_dir), REQUESTED_ATTRIBUTES)


@register("state_remainder")
def q_state_remainder(spark, sf_dir):
    from riskloom.fixtures import state_items
    from riskloom.operators.lakeops import remaining_items

    return remaining_items(state_items(spark, sf_dir), CONSUMED_KEYS)


# ---------------------------------------------------------------- reconcile / query text
@register("reconcile_counts")
def q_reconcile_counts(spark, sf_dir):
    from riskloom.fixtures import reconcile_sides
    from riskloom.operators.lakeops import reconcile_counts

    src, lake = reconcile_sides(spark, sf_dir)
    return reconcile_counts(src, lake).withColumn("slot", _ts_text("slot"))


@register("query_lineage")
def q_query_lineage(spark, sf_dir):
    from riskloom.fixtures import statements
    from riskloom.operators.lakeops import query_lineage

    return query_lineage(statements(spark, sf_dir))


@register("unsafe_statements")
def q_unsafe_statements(spark, sf_dir):
    from riskloom.fixtures import statements
    from riskloom.operators.lakeops import statement_checks

    return statement_checks(statements(spark, sf_dir)).withColumn("n_tables", F.col("n_tables").cast("long"))


@register("lake_count_scalar")
def q_lake_count_scalar(spark, sf_dir):
    from riskloom.plans.lakesql import lake_count
    from riskloom.sources.tables import read_table

    read_table(spark, sf_dir, "events").createOrReplaceTempView("events")
    return lake_count(spark, "SELECT count(*) AS n FROM events WHERE event_type = 'error'")


def _consumed_keys(spark):
    return spark.createDataFrame([("1-URGENT",), ("3-MEDIUM",)], "pk string")


@register("consume_range")
def q_consume_range(spark, sf_dir):
    """JOB5 as a step: the ranges of the consumed keys, and how many items the
    remainder, written and read back, has of each other key."""
    from riskloom.fixtures import state_items
    from riskloom.operators.lakeops import consume_range
    from riskloom.session import scratch_dir

    ranges, left = consume_range(scratch_dir(spark, "state"), state_items(spark, sf_dir), _consumed_keys(spark))
    n = left.groupBy("pk").agg(F.count(F.lit(1)).alias("n_left"))
    return ranges.withColumn("n_left", F.lit(0).cast("long")).unionByName(n, allowMissingColumns=True)


@register("consume_attributes")
def q_consume_attributes(spark, sf_dir):
    """JOB6 as a step: the last attribute values of the consumed keys, and how
    many items the remainder has of each other key."""
    from riskloom.fixtures import state_items
    from riskloom.operators.lakeops import consume_attributes
    from riskloom.session import scratch_dir

    wanted = ["custkey", "totalprice", "status", "absent"]
    values, left = consume_attributes(scratch_dir(spark, "state"), state_items(spark, sf_dir), _consumed_keys(spark), wanted)
    n = left.groupBy("pk").agg(F.lit("n_left").alias("attribute"), F.count(F.lit(1)).cast("string").alias("value"))
    return values.unionByName(n)


# ---------------------------------------------------------------- time slots and time functions
SLOT_FORMAT = "year=%Y/month=%m/day=%d/hour=%H"


def _event_hour_bounds(spark, sf_dir):
    from riskloom.sources.tables import read_table

    ev = read_table(spark, sf_dir, "events")
    return ev.agg(
        F.date_trunc("hour", F.min("ts")).alias("start"), F.date_trunc("hour", F.max("ts")).alias("end")
    )


@register("time_slots")
def q_time_slots(spark, sf_dir):
    from riskloom.operators.timeslots import time_slots

    return time_slots(_event_hour_bounds(spark, sf_dir), "start", "end", SLOT_FORMAT, 1, True).select("idx", "slot")


@register("time_slots_6h")
def q_time_slots_6h(spark, sf_dir):
    from riskloom.operators.timeslots import time_slots

    return time_slots(_event_hour_bounds(spark, sf_dir), "start", "end", "%Y-%m-%d %H:00", 6, False).select("idx", "slot")


@register("slot_coverage")
def q_slot_coverage(spark, sf_dir):
    from riskloom.operators.timeslots import slot_coverage, time_slots
    from riskloom.sources.tables import read_table

    slots = time_slots(_event_hour_bounds(spark, sf_dir), "start", "end", SLOT_FORMAT, 1, True)
    return slot_coverage(slots, read_table(spark, sf_dir, "events"))


@register("slot_coverage_6h")
def q_slot_coverage_6h(spark, sf_dir):
    """JOB8 with 6-hour slots: events per slot."""
    from riskloom.operators.timeslots import slot_coverage, time_slots
    from riskloom.sources.tables import read_table

    slots = time_slots(_event_hour_bounds(spark, sf_dir), "start", "end", "%Y-%m-%d %H:00", 6, False)
    return slot_coverage(slots, read_table(spark, sf_dir, "events"), interval_hours=6)


@register("local_time")
def q_local_time(spark, sf_dir):
    from riskloom.functions.timefns import run_date, shift_hours, utc_to_local
    from riskloom.sources.tables import read_table

    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        _ts_text(utc_to_local("ts")).alias("local_ts"),
        _ts_text(shift_hours(F.col("ts").cast("timestamp"), -3)).alias("shifted"),
        _ts_text(run_date("ts", previous=True, delta=2, tz="Asia/Kuala_Lumpur")).alias("run_date"),
    )


@register("date_parts")
def q_date_parts(spark, sf_dir):
    from riskloom.functions.timefns import exec_date_parts, quarter_hour
    from riskloom.sources.tables import read_table

    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        *exec_date_parts("ts", previous=1, delta=1, tz="Asia/Kuala_Lumpur"),
        quarter_hour("ts").alias("quarter"),
    )


@register("hour_window")
def q_hour_window(spark, sf_dir):
    from riskloom.functions.timefns import hour_window_strings
    from riskloom.sources.tables import read_table

    ev = read_table(spark, sf_dir, "events")
    return ev.select("event_id", *hour_window_strings(F.col("ts").cast("timestamp")))


@register("partition_date")
def q_partition_date(spark, sf_dir):
    from riskloom.functions.timefns import partition_date_parts
    from riskloom.sources.tables import read_table

    ev = read_table(spark, sf_dir, "events")
    return ev.select("event_id", *partition_date_parts("ts"))


@register("path_codec")
def q_path_codec(spark, sf_dir):
    from riskloom.functions.text import decode_path, encode_path
    from riskloom.sources.tables import read_table

    ev = read_table(spark, sf_dir, "events")
    p = F.concat(F.lit("type="), F.col("event_type"), F.lit("/user="), F.col("user_id").cast("string"))
    enc = encode_path(p)
    return ev.select("event_id", enc.alias("encoded"), decode_path(enc).alias("decoded"))


# ---------------------------------------------------------------- tokenisation
# Demo salt of the tokenisation fixture (not a secret).  Fixed value.
DEMO_SALT = "riskloom-demo-salt"
TOKEN_FIELDS = ["name", "nric", "cardnum"]


def _demo_key() -> str:
    import secrets

    return secrets.token_hex(16)  # fresh AES-128 key per run; nothing stored


def _demo_context() -> tuple[str, str]:
    """A wrapped key as a key service would return it: bytes that say nothing
    about the data key."""
    import base64
    import secrets

    return base64.b64encode(secrets.token_bytes(32)).decode(), "demo-key"


@register("tokenize_hash")
def q_tokenize_hash(spark, sf_dir):
    from riskloom.fixtures import personal_data
    from riskloom.operators.tokenize import tokenize

    key = _demo_key()
    t = tokenize(personal_data(spark, sf_dir), TOKEN_FIELDS, DEMO_SALT, key, _demo_context())
    return t.select("uuid", "name", "nric", "date", "cardnum")


@register("tokenize_roundtrip")
def q_tokenize_roundtrip(spark, sf_dir):
    from riskloom.fixtures import personal_data
    from riskloom.functions.hashing import aes_decrypt_b64
    from riskloom.operators.tokenize import tokenize

    key = _demo_key()
    t = tokenize(personal_data(spark, sf_dir), TOKEN_FIELDS, DEMO_SALT, key, _demo_context())
    return t.select("uuid", *[aes_decrypt_b64(f"{f}_enc", key).alias(f"{f}_dec") for f in TOKEN_FIELDS])


@register("tokenize_header")
def q_tokenize_header(spark, sf_dir):
    """FN4/FN5: the columns of the tokenised table in order, with, for each, in
    how many rows it holds what it should: the context, a decryptable field,
    or a value as long as a digest."""
    from riskloom.fixtures import personal_data
    from riskloom.functions.hashing import aes_decrypt_b64, hidden
    from riskloom.operators.tokenize import CONTEXT_COLUMN, ENC_SUFFIX, tokenize

    key, context = _demo_key(), (_demo_context()[0], "demo-key")
    source = personal_data(spark, sf_dir)
    t = tokenize(source, TOKEN_FIELDS, DEMO_SALT, key, context)
    hidden_key = hidden(spark, key)
    back = t.join(source.select("uuid", *[F.col(f).alias(f"was_{f}") for f in TOKEN_FIELDS]), "uuid")

    def right(c: str):
        if c == CONTEXT_COLUMN:
            return (F.col(c) == ":".join(context)) & F.col(c).endswith(":demo-key")
        if c.endswith(ENC_SUFFIX):
            return aes_decrypt_b64(c, hidden_key) == F.col(f"was_{c[: -len(ENC_SUFFIX)]}")
        return F.length(c) == 64 if c in TOKEN_FIELDS else F.col(c).isNotNull()

    counts = back.agg(*[F.sum(right(c).cast("long")).alias(f"c{i}") for i, c in enumerate(t.columns)])
    rows = [F.struct(F.lit(i).alias("position"), F.lit(c).alias("name"), F.col(f"c{i}").alias("n_right")) for i, c in enumerate(t.columns)]
    return counts.select(F.inline(F.array(*rows)))


@register("tokenize_slow")
def q_tokenize_slow(spark, sf_dir):
    from riskloom.fixtures import personal_data
    from riskloom.operators.tokenize import tokenize

    key = _demo_key()
    return tokenize(personal_data(spark, sf_dir), TOKEN_FIELDS, DEMO_SALT, key, _demo_context(), slow_fields=["cardnum"])


# ---------------------------------------------------------------- L1 selection and trainers
@register("gram_by_fold")
def q_gram_by_fold(spark, sf_dir):
    from riskloom.operators.lasso import gram_by_fold

    p, _ = T.prepare(spark, sf_dir, labelled_only=True)
    g = gram_by_fold(T.oversampled_train(p), FEATURES, LABEL, KEY, folds=5, seed=42)
    return g.select("fold", "n", *[F.round(c, 6).alias(c) for c in g.columns if c.startswith("s_")])


@register("gram_vectors")
def q_gram_vectors(spark, sf_dir):
    """AGG9 on a wide input: fold statistics of the embedding dimensions
    against the binary class, as per-task numpy blocks summed by Spark."""
    from riskloom.fixtures import vectors
    from riskloom.operators.lasso import gram_blocks

    table = vectors(spark, sf_dir)
    width = table.agg(F.max(F.size("embedding"))).first()[0] or 0
    dims = [f"e{j}" for j in range(width)]
    v = table.select("vec_id", LABEL, *[F.col("embedding")[j].alias(d) for j, d in enumerate(dims)])
    g = gram_blocks(v, dims, LABEL, "vec_id", folds=5, seed=42)
    return g.select("fold", "stat", F.round("value", 6).alias("value"))


@register("lasso_selection")
def q_lasso_selection(spark, sf_dir):
    p, _ = T.prepare(spark, sf_dir, labelled_only=True)
    alpha, sel = T.select_features(p)
    return sel.select("feature", F.round("coefficient", 6).alias("coefficient"), "selected", F.lit(alpha).alias("alpha"))


@register("selected_of_total")
def q_selected_of_total(spark, sf_dir):
    """AGG8 over the one-feature L1 problems, which have a closed form."""
    from riskloom.operators.lasso import selection_summary

    return selection_summary(q_lasso_single(spark, sf_dir))


@register("selection_summary")
def q_selection_summary(spark, sf_dir):
    from riskloom.operators.lasso import selection_summary

    p, _ = T.prepare(spark, sf_dir, labelled_only=True)
    _, sel = T.select_features(p)
    return selection_summary(sel)


def _train_one(spark, sf_dir, name, **params):
    from riskloom.operators.lasso import selected_features

    p, _ = T.prepare(spark, sf_dir, labelled_only=True)
    train = T.oversampled_train(p)
    from riskloom.operators.lasso import lasso_select

    _, sel = lasso_select(train, FEATURES, LABEL, KEY)
    _, metric = T.train_model(p, train, name, selected_features(sel), **params)
    return metric


@register("train_decision_tree")
def q_train_dt(spark, sf_dir):
    return _train_one(spark, sf_dir, "decision_tree")


@register("train_random_forest")
def q_train_rf(spark, sf_dir):
    return _train_one(spark, sf_dir, "random_forest")


@register("boosted_stump")
def q_boosted_stump(spark, sf_dir):
    """ML9 where it has a closed form: one round, one split of two features of
    few values, the probability of every labelled row."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    from riskloom.operators.boosting import BoostedTrees

    tx = filter_classes(transactions(spark, sf_dir, labelled_only=True), T.TRAIN_CLASSES)
    steps = [F.floor(F.coalesce(F.col(f), F.lit(0.0)) * n).cast("double").alias(f"x_{f}") for f, n in (("f_uniq", 20), ("f_digit", 200))]
    rows = VectorAssembler(inputCols=["x_f_uniq", "x_f_digit"], outputCol="features").transform(tx.select(KEY, (F.col(LABEL) - 1).alias("y"), *steps))
    scored = BoostedTrees(labelCol="y", maxIter=1, maxDepth=1).fit(rows).transform(rows)
    return scored.select(KEY, F.round(vector_to_array("probability")[1], 6).alias("p"), F.col("prediction").cast("int").alias("prediction"))


def _split_rows(spark, sf_dir):
    """The labelled transactions with a 0-based label; no features are missing."""
    tx = filter_classes(transactions(spark, sf_dir, labelled_only=True), T.TRAIN_CLASSES)
    return tx.select(KEY, (F.col(LABEL) - 1).alias("y"), *[F.coalesce(F.col(f), F.lit(0.0)).alias(f) for f in FEATURES])


@register("exact_split_points")
def q_exact_split_points(spark, sf_dir):
    """ML7, the first split: every feature's best place between two distinct values, and which one is taken."""
    from riskloom.operators import exacttree as X

    own = X.vectors(_split_rows(spark, sf_dir), FEATURES, KEY, "y")
    root = own.select(F.lit(0).alias("tree"), F.lit("").alias("path"), "x", F.lit(1).alias("w"), "y")
    cuts = T.materialize(X.cuts_of_features(root, X.value_ranges(own, len(FEATURES))), "cuts")
    taken = X.chosen_cuts(cuts, None, 0).select("tree", "path", F.col("feature").alias("f"), F.lit(True).alias("t"))
    return cuts.join(taken, ["tree", "path", "f"], "left").select(
        "f", F.round(-F.col("best.cost"), 6).alias("score"), F.round(X.between(F.col("best.v"), F.col("best.next")), 9).alias("threshold"),
        F.col("best.ln").alias("n_left"), F.col("best.l1").alias("n1_left"), F.col("best.n").alias("n"), F.col("best.n1").alias("n1"),
        F.coalesce("t", F.lit(False)).alias("taken"),
    )


@register("forest_votes")
def q_forest_votes(spark, sf_dir):
    """ML8 where SQL can follow it: a forest of one tree of one level, its bootstrap weights and drawn
    features; the vote for every labelled row."""
    from riskloom.operators import exacttree as X

    rows = _split_rows(spark, sf_dir)
    nodes = X.grow(rows, FEATURES, KEY, "y", bootstrap=True, draw=2, max_depth=1)
    return X.predict(nodes, rows, FEATURES).select(KEY, F.round("p", 5).alias("p"), (F.col("prediction") + 1).alias("prediction"))


def _exact_scores(spark, sf_dir, **options):
    from riskloom.operators import exacttree as X

    p, _ = T.prepare(spark, sf_dir, labelled_only=True)
    nodes = X.grow(T.oversampled_train(p).withColumn("y", F.col(LABEL) - 1), p.features, KEY, "y", **options)
    scored = X.predict(nodes, p.test, p.features)
    return scored.select(KEY, LABEL, F.round("p", 6).alias("p"), (F.col("prediction") + 1).alias("prediction"))


@register("exact_tree")
def q_exact_tree(spark, sf_dir):
    """ML7: a tree of exact splits and no depth limit, trained on the oversampled rows; the test rows scored."""
    return _exact_scores(spark, sf_dir)


@register("exact_forest")
def q_exact_forest(spark, sf_dir):
    """ML8: 100 such trees, each on rows and features of its own draw."""
    return _exact_scores(spark, sf_dir, trees=100, bootstrap=True, draw=int(len(FEATURES) ** 0.5))


@register("train_gbt")
def q_train_gbt(spark, sf_dir):
    return _train_one(spark, sf_dir, "gbt")


@register("train_mlp")
def q_train_mlp(spark, sf_dir):
    return _train_one(spark, sf_dir, "mlp")


@register("model_selection")
def q_model_selection(spark, sf_dir):
    from riskloom.session import scratch_dir

    p, _ = T.prepare(spark, sf_dir, labelled_only=True)
    metrics, best, _ = T.training_run(p, model_path=scratch_dir(spark, "best-model"))
    return metrics.withColumn("is_best", F.col("model") == F.lit(best))


#: A strict subset of the features, as an L1 selection would leave.
SUBSET = ["f_chars", "f_digit", "f_uniq"]


def _saved_knn(spark, sf_dir):
    """(path of a saved 5-NN on SUBSET, the transactions).  A tree is saved
    there first, so that the winner replaces another kind."""
    from riskloom.operators.models import save_knn, save_model
    from riskloom.session import scratch_dir

    p, tx = T.prepare(spark, sf_dir)
    train = T.oversampled_train(p)
    path = scratch_dir(spark, "model")
    tree, _ = T.train_model(p, train, "decision_tree", FEATURES, maxDepth=2)
    save_model(tree, path, "decision_tree", FEATURES)
    return save_knn(path, p.scaler, train, SUBSET, 5), tx


@register("save_load_score")
def q_save_load_score(spark, sf_dir):
    """E2: saved winner → load → required columns → score class-3 rows → CSV
    out → read back by name."""
    from riskloom.operators.models import PREDICTION_CODE, load_and_score
    from riskloom.session import scratch_dir
    from riskloom.sources.sinks import write_csv
    from riskloom.sources.tables import read_csv_table

    path, tx = _saved_knn(spark, sf_dir)
    rows = filter_classes(tx, T.SCORE_CLASSES).select(KEY, LABEL, *SUBSET)
    out = write_csv(load_and_score(path, rows), scratch_dir(spark, "predictions"))
    return read_csv_table(spark, out, schema=f"{PREDICTION_CODE} int, {KEY} long, {LABEL} int")


@register("save_load_tree")
def q_save_load_tree(spark, sf_dir):
    """SNK3/ML13/ML14 with a tree winner: Licit/Illicit counts of class-3 rows."""
    from riskloom.operators.models import PREDICTION_CODE, load_and_score, save_model
    from riskloom.session import scratch_dir

    p, tx = T.prepare(spark, sf_dir)
    model, _ = T.train_model(p, T.oversampled_train(p), "decision_tree", FEATURES)
    path = save_model(model, scratch_dir(spark, "model"), "decision_tree", FEATURES)
    return prediction_histogram(load_and_score(path, filter_classes(tx, T.SCORE_CLASSES)), PREDICTION_CODE)


@register("metrics_published")
def q_metrics_published(spark, sf_dir):
    """SNK4: the k-NN metric rows of two runs, one published twice, read back."""
    from riskloom.session import scratch_dir
    from riskloom.sources.sinks import append_metrics

    p, _ = T.prepare(spark, sf_dir, labelled_only=True)
    path = scratch_dir(spark, "metrics")
    for run, ks in (("run-1", (1, 3)), ("run-2", (5,)), ("run-1", (1, 3))):
        append_metrics(T.knn_accuracy(p, ks), path, run)
    return spark.read.schema("model string, k int, accuracy double, n_test long, run_id string").parquet(path)


@register("lasso_single")
def q_lasso_single(spark, sf_dir):
    """ML4/ML5/AGG8 where the L1 problem has a closed form: one feature at a
    time, the penalty of least held-out error, the coefficient, kept or not."""
    from riskloom.operators.lasso import lasso_select

    p, _ = T.prepare(spark, sf_dir, labelled_only=True)
    train = T.oversampled_train(p)
    out = None
    for f in FEATURES:
        alpha, chosen = lasso_select(train, [f], LABEL, KEY)
        row = chosen.select("feature", F.round(F.lit(alpha), 6).alias("alpha"), F.round("coefficient", 6).alias("coefficient"), "selected")
        out = row if out is None else out.unionByName(row)
    return out


# ---------------------------------------------------------------- file sources and sinks
@register("csv_roundtrip")
def q_csv_roundtrip(spark, sf_dir):
    """SRC1 + SNK1 + PRJ1 + PRJ2: write the transaction table as header CSV
    with a pandas-style index column, read it back with an explicit schema,
    drop the index and project the run-time column list."""
    from riskloom.session import scratch_dir
    from riskloom.sources.sinks import write_csv
    from riskloom.sources.tables import columns_in_order, read_csv_table

    tx = transactions(spark, sf_dir)
    path = write_csv(tx.select(F.col(KEY).alias("Unnamed: 0"), KEY, LABEL, *FEATURES), scratch_dir(spark, "tx-csv"))
    schema = f"`Unnamed: 0` long, {KEY} long, {LABEL} int, " + ", ".join(f"{f} double" for f in FEATURES)
    back = read_csv_table(spark, path, schema=schema)
    return columns_in_order(back, [KEY, LABEL, *FEATURES])


@register("csv_splits")
def q_csv_splits(spark, sf_dir):
    """SRC1 where no field holds a line break: one large file, read in splits."""
    from riskloom.session import scratch_dir
    from riskloom.sources.sinks import write_csv
    from riskloom.sources.tables import read_csv_table, read_table

    events = read_table(spark, sf_dir, "events").select("event_id", "event_type", "user_id", "value", "props")
    path = write_csv(events, scratch_dir(spark, "events-csv"))
    back = read_csv_table(spark, path, "event_id long, event_type string, user_id long, value double, props string", lines_in_fields=False)
    return back.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"), F.round(F.sum("value"), 4).alias("total_value"), F.sum(F.length("props")).alias("props_length")
    )


@register("listed_files")
def q_listed_files(spark, sf_dir):
    """SRC6: every log's files listed by prefix in tasks: files and bytes of
    plain-text logs, all written and listed within the hour."""
    from riskloom.fixtures import log_lines_from_events
    from riskloom.session import scratch_dir
    from riskloom.sources.sinks import clustered
    from riskloom.sources.tables import list_prefixes

    base = scratch_dir(spark, "plain-logs")
    lines = log_lines_from_events(spark, sf_dir).select("log_id", "line")
    clustered(lines, ["log_id"]).write.partitionBy("log_id").text(base)
    found = list_prefixes(lines.select(F.concat(F.lit(f"{base}/log_id="), "log_id").alias("prefix")))
    data = found.where(F.col("name").startswith("part-"))
    fresh = F.col("mtime").between(F.current_timestamp() - F.expr("interval 1 hour"), F.current_timestamp() + F.expr("interval 1 minute"))
    return data.groupBy(F.regexp_extract("path", r"log_id=([^/]+)", 1).alias("log_id")).agg(F.sum("length").alias("bytes"), F.min(fresh).alias("fresh"))


def _events_by_partition_date(spark, sf_dir):
    from riskloom.functions.timefns import partition_date_parts
    from riskloom.sources.tables import read_table

    ev = read_table(spark, sf_dir, "events")
    return ev.select("event_id", "event_type", "value", *partition_date_parts("ts"))


@register("partition_scan")
def q_partition_scan(spark, sf_dir):
    """SRC5 + FN16: a year=/month=/day= lake table, one day read through
    partition pruning."""
    from riskloom.session import scratch_dir
    from riskloom.sources.sinks import clustered
    from riskloom.sources.tables import read_day_partition

    base = scratch_dir(spark, "lake-events")
    clustered(_events_by_partition_date(spark, sf_dir), ["year", "month", "day"]).write.partitionBy("year", "month", "day").parquet(base)
    schema = "event_id long, event_type string, value double, year string, month string, day string"
    df = read_day_partition(spark, base, "2024", "01", "10", schema=schema)
    return df.select("event_id", "event_type", "value", "year", "month", "day")


@register("dynamic_overwrite")
def q_dynamic_overwrite(spark, sf_dir):
    """SNK2: overwrite only the partitions present in the new data
    (days up to 2024-01-05 with doubled values); all others stay."""
    from riskloom.session import scratch_dir
    from riskloom.sources.sinks import overwrite_partitions

    inv = _events_by_partition_date(spark, sf_dir).withColumn("partition", F.concat_ws("-", "year", "month", "day"))
    base = scratch_dir(spark, "lake-dyn")
    overwrite_partitions(inv.select("event_id", "value", "partition"), base, ["partition"])
    fresh = inv.where(F.col("partition") <= "2024-01-05").select("event_id", (F.col("value") * 2).alias("value"), "partition")
    overwrite_partitions(fresh, base, ["partition"])
    return spark.read.schema("event_id long, value double, partition string").parquet(base)


def _write_gzip_logs(spark, sf_dir):
    """Write the derived logs as gzip text, lines in order.

    Range partitioning on (log, line) lets a large log span several writer
    tasks; its part files (part-00000…) are then in line order, and the
    reader numbers lines across them.
    """
    from riskloom.fixtures import log_lines_from_events
    from riskloom.session import scratch_dir

    base = scratch_dir(spark, "logs")
    lines = log_lines_from_events(spark, sf_dir)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (
        lines.repartitionByRange(n, "log_id", "line_no")
        .sortWithinPartitions("log_id", "line_no")
        .select("log_id", "line")
        .write.partitionBy("log_id")
        .option("compression", "gzip")
        .text(base)
    )
    return base


def _gzip_lines(spark, sf_dir):
    from riskloom.sources.tables import global_line_numbers, log_lines

    base = _write_gzip_logs(spark, sf_dir)
    lines = log_lines(spark, base).withColumn("log_id", F.regexp_extract("log_path", r"log_id=([^/]+)", 1))
    return base, global_line_numbers(lines).select("log_id", "line_no", "line")


@register("gzip_lines")
def q_gzip_lines(spark, sf_dir):
    """SRC7: gzip logs back to ordered lines (position within each file)."""
    return _gzip_lines(spark, sf_dir)[1]


@register("gzip_log_alerts")
def q_gzip_log_alerts(spark, sf_dir):
    """E3: gzip logs → exception scan → alert rows, for all logs at once."""
    from riskloom.operators.logscan import log_alerts

    return log_alerts(_gzip_lines(spark, sf_dir)[1])


@register("file_inventory")
def q_file_inventory(spark, sf_dir):
    """SRC6: listing of the written log files (no contents read): which logs
    have non-empty files."""
    from riskloom.sources.tables import file_inventory

    base = _write_gzip_logs(spark, sf_dir)
    inv = file_inventory(spark, base)
    return (
        inv.where(F.col("name").endswith(".gz"))
        .groupBy(F.regexp_extract("path", r"log_id=([^/]+)", 1).alias("log_id"))
        .agg((F.min("length") > 0).alias("listed"))
    )


@register("catalog_table")
def q_catalog_table(spark, sf_dir):
    """SRC10: save as a catalog table (data in the shared folder; a later run
    replaces it), read it back by name."""
    from riskloom.session import scratch_dir
    from riskloom.sources.tables import catalog_table, read_table

    name = "riskloom_events"
    read_table(spark, sf_dir, "events").write.mode("overwrite").option("path", scratch_dir(spark, "catalog")).saveAsTable(name)
    t = catalog_table(spark, name)
    return t.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 6).alias("total_value"))


# ---------------------------------------------------------------- k-NN over embeddings
@register("knn_vectors")
def q_knn_vectors(spark, sf_dir):
    """JON2 on 64-dim embeddings: the 5 nearest other vectors of each vector."""
    from riskloom.fixtures import vectors
    from riskloom.operators.knn import knn_join

    v = vectors(spark, sf_dir)
    return knn_join(v, v, 5, ["embedding"], "vec_id", "vec_id", exclude_self=True, carry=LABEL)


@register("knn_vectors_approx")
def q_knn_vectors_approx(spark, sf_dir):
    """JON1, approximate: 5 near other vectors of each vector by random projections, distances exact."""
    from riskloom.fixtures import vectors
    from riskloom.operators.annjoin import approximate_knn_join

    v = vectors(spark, sf_dir)
    return approximate_knn_join(v, v, 5, "embedding", "vec_id", "vec_id", exclude_self=True)


@register("knn_vectors_accuracy")
def q_knn_vectors_accuracy(spark, sf_dir):
    """ML6 on embeddings: hash split 80/20 (train 20%), 5-NN class votes."""
    from riskloom.fixtures import vectors
    from riskloom.operators.evaluate import accuracy
    from riskloom.operators.knn import knn_predict
    from riskloom.operators.prepare import hash_split

    v = hash_split(vectors(spark, sf_dir), "vec_id", 0.8, 42)
    train = v.where(F.col("split") == "train")
    test = v.where(F.col("split") == "test")
    pred = knn_predict(train, test, 5, ["embedding"], "vec_id", LABEL)
    return accuracy(pred.join(test.select("vec_id", LABEL), "vec_id"), "prediction", LABEL)


# ---------------------------------------------------------------- streaming
STREAM_CHUNKS = 6


@register("stream_buckets")
def q_stream_buckets(spark, sf_dir):
    """STR4: hourly windows with a watermark over a file stream of events."""
    from riskloom.sources.tables import read_table
    from riskloom.streaming.common import Chunks
    from riskloom.streaming.jobs import stream_buckets

    out = stream_buckets(spark, Chunks(read_table(spark, sf_dir, "events"), "ts", STREAM_CHUNKS, "stream-events"))
    return out.select(_ts_text("slot").alias("slot"), "n_events", F.round("total_value", 6).alias("total_value"))


@register("stream_settled")
def q_stream_settled(spark, sf_dir):
    """STR2: six pokes of the settled check, each against the marks that the
    one before stored; one row a (pass, partition)."""
    from riskloom.fixtures import inventory
    from riskloom.operators.lakeops import marks_at
    from riskloom.session import materialize
    from riskloom.streaming.common import Chunks
    from riskloom.streaming.jobs import stream_settled

    inv = inventory(spark, sf_dir)
    marks = materialize(marks_at(inv, SETTLED_CUTOFF), "marks")
    out = stream_settled(spark, Chunks(inv, "mtime", STREAM_CHUNKS, "stream-inventory"), marks)
    stamps = [_ts_text(c).alias(c) for c in ("latest_mtime", "stored_mark", "new_mark")]
    return out.select("pass", "partition", "n_objects", "latest_path", *stamps, "settled")


@register("stream_logscan")
def q_stream_logscan(spark, sf_dir):
    """STR3: exception scan as per-log state across micro-batches."""
    from riskloom.fixtures import log_lines_from_events
    from riskloom.streaming.common import Chunks
    from riskloom.streaming.jobs import stream_logscan

    lines = log_lines_from_events(spark, sf_dir, with_ts=True)
    return stream_logscan(spark, Chunks(lines, "ts", STREAM_CHUNKS, "stream-logs"))


@register("stream_score")
def q_stream_score(spark, sf_dir):
    """STR1: a saved k-NN winner on a strict subset of the features, applied
    to a stream of rows to score."""
    from riskloom.streaming.common import Chunks
    from riskloom.streaming.jobs import stream_score

    mpath, tx = _saved_knn(spark, sf_dir)
    rows = filter_classes(tx, T.SCORE_CLASSES).select(KEY, LABEL, *SUBSET, F.timestamp_seconds(F.col(KEY)).alias("ts"))
    scored = stream_score(spark, mpath, Chunks(rows, "ts", 3, "stream-rows"), [KEY, LABEL])
    return scored.select(KEY, LABEL, "fraud_prediction")


@register("settled_marks")
def q_settled_marks(spark, sf_dir):
    """SNK5: the settled check's new marks stored per partition (replacing
    only the partitions written) and read back."""
    from riskloom.fixtures import inventory
    from riskloom.operators.lakeops import marks_at, settled_check
    from riskloom.session import scratch_dir
    from riskloom.sources.sinks import save_marks

    inv = inventory(spark, sf_dir)
    out = settled_check(inv, marks_at(inv, SETTLED_CUTOFF))
    path = save_marks(out.select(_ts_text("new_mark").alias("mark"), "partition"), scratch_dir(spark, "marks"))
    return spark.read.schema("mark string, partition string").parquet(path)


@register("string_frame")
def q_string_frame(spark, sf_dir):
    """PRJ5: every column of a table as text (NULL stays NULL)."""
    from riskloom.sources.tables import read_table, to_string_columns

    return to_string_columns(read_table(spark, sf_dir, "customer"))


@register("probability_codes")
def q_probability_codes(spark, sf_dir):
    """FN20: class code from P(class index 1) > 0.5, P from a column of the data."""
    from pyspark.ml.functions import array_to_vector

    from riskloom.operators.models import probability_to_code
    from riskloom.sources.tables import read_table

    c = read_table(spark, sf_dir, "customer")
    share = F.pmod(F.col("c_custkey"), F.lit(101)) / F.lit(100.0)
    vec = c.select("c_custkey", array_to_vector(F.array(F.lit(1.0) - share, share)).alias("probability"))
    return vec.select("c_custkey", probability_to_code("probability"))


@register("tree_codes")
def q_tree_codes(spark, sf_dir):
    """FN20 next to a model's own codes: counts of each pair."""
    from riskloom.operators.models import PREDICTION_CODE, probability_to_code

    p, tx = T.prepare(spark, sf_dir)
    model, _ = T.train_model(p, T.oversampled_train(p), "decision_tree", FEATURES)
    scored = model.transform(filter_classes(tx, T.SCORE_CLASSES))
    pairs = scored.select(probability_to_code("probability").alias("threshold_code"), PREDICTION_CODE)
    return pairs.groupBy("threshold_code", PREDICTION_CODE).agg(F.count(F.lit(1)).alias("n"))


@register("stream_quarter_buckets")
def q_stream_quarter_buckets(spark, sf_dir):
    """STR4: quarter-hour windows with a watermark over a file stream."""
    from riskloom.sources.tables import read_table
    from riskloom.streaming.common import Chunks
    from riskloom.streaming.jobs import stream_buckets

    source = Chunks(read_table(spark, sf_dir, "events"), "ts", STREAM_CHUNKS, "stream-events-q")
    out = stream_buckets(spark, source, watermark="15 minutes", window="15 minutes")
    return out.select(_ts_text("slot").alias("slot"), "n_events", F.round("total_value", 6).alias("total_value"))
