"""Derived inputs built from the driver tables (see FIXTURES.md).

Each function returns a lazy DataFrame; every heavy per-row expression is
computed before any shuffle so only narrow columns cross the network.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.hashing import hash_bucket
from riskloom.functions.timefns import utc_to_local
from riskloom.sources.tables import read_table, spread_small_input

FEATURES = ["f_chars", "f_words", "f_lines", "f_digit", "f_upper", "f_uniq"]
KEY = "tx_id"
LABEL = "class"


DIGITS = "0123456789"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def transaction_features(documents: DataFrame) -> DataFrame:
    """Six numeric features per document, computed over the whole text.

    The word array is built once in a lower projection (Catalyst keeps a
    non-trivial alias that is used twice instead of inlining it), and
    character-class counts use ``translate`` rather than a regex.
    """
    text = F.col("text")
    base = documents.select(
        F.col("doc_id"),
        F.col("n_chars"),
        F.length(text).alias("_len"),
        # the runs of non-space characters: split at whitespace runs, minus
        # the empty ends (measured ~40% cheaper than regexp_extract_all \S+)
        F.filter(F.split(text, r"\s+"), lambda w: w != "").alias("_words"),
        F.size(F.split(text, "\n", -1)).alias("_lines"),
        (F.length(text) - F.length(F.translate(text, DIGITS, ""))).alias("_digits"),
        (F.length(text) - F.length(F.translate(text, UPPER, ""))).alias("_upper"),
    )
    n = F.nullif(F.col("_len"), F.lit(0))
    n_words = F.size("_words")
    return base.select(
        F.col("doc_id").alias(KEY),
        F.col("n_chars").cast("double").alias("f_chars"),
        n_words.cast("double").alias("f_words"),
        F.col("_lines").cast("double").alias("f_lines"),
        F.round(F.col("_digits") / n, 6).alias("f_digit"),
        F.round(F.col("_upper") / n, 6).alias("f_upper"),
        F.round(F.size(F.array_distinct("_words")) / F.nullif(n_words, F.lit(0)), 6).alias("f_uniq"),
    )


def transactions(
    spark: SparkSession,
    sf_dir: str,
    only_ids: DataFrame | None = None,
    labelled_only: bool = False,
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """(tx_id, class, f_*): class 1 = quality 0, 2 = quality 1, 3 = unlabelled.

    Features are computed on the documents side first, so the join with
    `labels` shuffles 7 numbers per row instead of whole texts; AQE turns it
    into a broadcast join when the measured label side is small.
    ``labelled_only`` keeps documents that have a label *before* the text
    work (classes 1 and 2 only); ``only_ids`` restricts to a bounded id list.
    ``broadcast_bytes`` bounds the label side broadcast for that early filter.
    """
    from riskloom.operators.joins import DEFAULT_MAX_BROADCAST_BYTES, broadcast_if_small, fits

    broadcast_bytes = DEFAULT_MAX_BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    if only_ids is not None:
        # an id list (e.g. a top-k): features only for those rows; the list
        # is broadcast after its size is checked
        ids = broadcast_if_small(only_ids.select(F.col(only_ids.columns[0]).alias("doc_id")))
        docs = docs.join(ids, "doc_id", "left_semi")
    else:
        docs = spread_small_input(docs)
    labels = read_table(spark, sf_dir, "labels").select(F.col("doc_id").alias(KEY), "quality")
    if labelled_only:
        # Drop unlabelled documents before the text work only when the label
        # side is measured small (a broadcast semi-join: no shuffle of text).
        # Otherwise features are computed for all documents and the inner
        # join below shuffles 7 numbers per row, never the texts.
        if fits(labels, broadcast_bytes):
            labels = F.broadcast(labels)
            docs = docs.join(labels.select(F.col(KEY).alias("doc_id")), "doc_id", "left_semi")
    feats = transaction_features(docs)
    joined = feats.join(labels, KEY, "inner" if labelled_only else "left")
    cls = F.when(F.col("quality").isNull(), 3).when(F.col("quality") == 0, 1).otherwise(2)
    return joined.select(KEY, cls.cast("int").alias(LABEL), *FEATURES)


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, embedding array<double>, label, class = label % 2 + 1)."""
    emb = read_table(spark, sf_dir, "embeddings")
    return emb.select(
        "vec_id",
        F.col("embedding").cast("array<double>").alias("embedding"),
        "label",
        (F.pmod(F.col("label"), F.lit(2)) + 1).cast("int").alias(LABEL),
    )


# Constant date of the personal-data fixture.  Fixed value.
PERSONAL_DATE = "2024-01-01"


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(uuid, name, nric, date, cardnum) strings built from `customer`."""
    c = read_table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").cast("string").alias("uuid"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("nric"),
        F.lit(PERSONAL_DATE).alias("date"),
        F.lpad(F.col("c_custkey").cast("string"), 16, "0").alias("cardnum"),
    )


# Log-line texts of the log fixture.  Fixed values.
TRACEBACK_LINE = "Traceback (most recent call last):"
ERROR_LINE_PREFIX = "ValueError: bad record for user "
FRAME_LINE_PREFIX = '  File "job.py", line '
FRAME_LINE_SUFFIX = ", in step"
IGNORED_LINE = "INFO py4j.clientserver: Closing down clientserver connection"
INFO_LINE_PREFIX = "INFO step "


def log_lines_from_events(spark: SparkSession, sf_dir: str, with_ts: bool = False) -> DataFrame:
    """(log_id, line_no, line): one log per UTC day of `events`.

    `line_no` is the event id, which orders the lines of a day; it need not be
    contiguous, the scan only relies on the order.
    """
    ev = read_table(spark, sf_dir, "events")
    et = F.col("event_type")
    uid = F.col("user_id").cast("string")
    eid = F.col("event_id")
    line = (
        F.when((et == "error") & (F.pmod(eid, F.lit(3)) == 0), F.lit(TRACEBACK_LINE))
        .when(et == "error", F.concat(F.lit(ERROR_LINE_PREFIX), uid))
        .when(et == "view", F.concat(F.lit(FRAME_LINE_PREFIX), uid, F.lit(FRAME_LINE_SUFFIX)))
        .when(et == "signup", F.lit(IGNORED_LINE))
        .otherwise(F.concat(F.lit(INFO_LINE_PREFIX), eid.cast("string"), F.lit(" "), et))
    )
    return ev.select(
        F.date_format(F.col("ts"), "yyyy-MM-dd").alias("log_id"),
        eid.alias("line_no"),
        line.alias("line"),
        *([F.col("ts")] if with_ts else []),
    )


def inventory(spark: SparkSession, sf_dir: str, tz: str = "Asia/Kuala_Lumpur") -> DataFrame:
    """Object listing: (path, name, mtime, partition = local date)."""
    ev = read_table(spark, sf_dir, "events")
    path = F.concat_ws("/", F.col("event_type"), F.col("user_id").cast("string"), F.col("event_id").cast("string"))
    return ev.select(
        path.alias("path"),
        F.col("event_id").cast("string").alias("name"),
        F.col("ts").cast("timestamp").alias("mtime"),
        F.date_format(utc_to_local(F.col("ts"), tz), "yyyy-MM-dd").alias("partition"),
    )


def state_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key-value state items from `orders`.

    pk = o_orderpriority, seq = o_orderkey (scan order), min_ts/max_ts as ISO
    text (NULL resp. empty for status 'P'), plus attributes custkey (absent
    when o_orderkey % 7 = 0), totalprice and status.
    """
    o = read_table(spark, sf_dir, "orders")
    iso = "yyyy-MM-dd'T'HH:mm:ss"
    pending = F.col("o_orderstatus") == "P"
    return o.select(
        F.col("o_orderpriority").alias("pk"),
        F.col("o_orderkey").alias("seq"),
        F.when(pending, F.lit(None).cast("string")).otherwise(F.date_format("o_orderdate", iso)).alias("min_ts"),
        F.when(pending, F.lit("")).otherwise(F.date_format(F.timestamp_add("DAY", F.lit(1), F.col("o_orderdate")), iso)).alias("max_ts"),
        F.when(F.pmod(F.col("o_orderkey"), F.lit(7)) == 0, F.lit(None).cast("string"))
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("custkey"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("totalprice"),
        F.col("o_orderstatus").alias("status"),
    )


def statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(stmt_id, query) — statement texts with the event type as table name."""
    ev = read_table(spark, sf_dir, "events")
    t = F.col("event_type")
    u = F.col("user_id").cast("string")
    i = F.col("event_id").cast("string")
    k = F.pmod(F.col("event_id"), F.lit(5))
    q = (
        F.when(k == 0, F.concat(F.lit("SELECT COUNT(*) FROM "), t, F.lit(" WHERE user_id = "), u))
        .when(k == 1, F.concat(F.lit("select e.* from "), t, F.lit(" e join users u on e.user_id = u.id")))
        .when(k == 2, F.concat(F.lit("DELETE FROM "), t, F.lit(" WHERE event_id = "), i))
        .when(k == 3, F.concat(F.lit("  drop table "), t, F.lit("_archive;")))
        .otherwise(F.concat(F.lit("ALTER TABLE "), t, F.lit(" ADD COLUMN c"), u, F.lit(" INT")))
    )
    return ev.select(F.col("event_id").alias("stmt_id"), q.alias("query"))


def reconcile_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(source, lake) event rows: the lake misses rows whose key bucket is 0."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts")
    lake = ev.where(hash_bucket(10, F.col("event_id")) != 0)
    return ev, lake
