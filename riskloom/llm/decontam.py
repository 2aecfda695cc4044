"""Benchmark decontamination by SimHash windows (operator 5, DataFrame functions only).

Words are runs other than space and \\t \\n \\v \\f \\r, A-Z as a-z; shingles are five words.

1. Windows.  For every benchmark item a document's windows have the item's size in shingles.  A
   window without any shingle of the benchmark has similarity 0 to every item, so windows are laid
   only where a benchmark shingle stands, in the place the item would have around it (moved inside the
   document); a document shorter than the item is one window.  This leaves out no window that
   could be verified at its place.
2. Fingerprints.  64-bit SimHash of a window's and of an item's words, each word voting with the summed
   weights of the shingles it stands in, so that words many items share count as little as in 4.
3. Search.  The fingerprint is cut into ``BLOCKS``; two fingerprints within ``RADIUS`` bits differ by
   at most RADIUS // len(BLOCKS) bits in some block, so items are indexed under every block value that
   near, windows look their own values up, and none within the radius is missed.  A pair that 4 accepts
   may still lie beyond the radius, so there is an exact way back: the accepted share at least
   ``SIMILARITY`` of the item's weight, hence one of its heaviest shingles whose rest weighs less, and
   windows are looked up by those too.  What is found does not depend on the radius.
4. Verification.  Weighted Jaccard of the two shingle multisets, a shingle weighing one over the
   number of items that hold it (one if none does), at least ``SIMILARITY``.

One row per (doc_id, item_id) found: doc_id, item_id, similarity (the best window's), position (its
first word), found_by (``fingerprint`` if the search met any accepted window of the pair, else ``heaviest``;
``run`` if only a short item's words).  An item of one to four words is its own one shingle: documents that hold its words in a
row have it with similarity 1, at the first such place.  Null texts and ids and items without a word are
passed over: a null text holds nothing, a null item_id cannot be identified.  Repeated documents and items give one row per
pair of ids, equal passages at several places the best, then the first.  Empty tables give no row.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import drop_ids, materialize, ship_package

WORDS = 5
SIMILARITY = 0.8
RADIUS = 14
#: Bits of each block of the fingerprint.
BLOCKS = (13, 13, 13, 13, 12)

SPACES = r"[\x20\x09-\x0D]+"


def word_array(text: Column) -> Column:
    """The words of a text, A-Z in lower case."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), upper, lower), SPACES), lambda w: w != "")


def _shifted(words: str, k: int) -> list[Column]:
    """``words`` (an array column) from its 1st, 2nd, ... k-th place on, all as long as the last."""
    n = F.size(words) - (k - 1)
    return [F.slice(F.col(words), i + 1, n).alias(f"w{i}") for i in range(k)]


def _shingles(words: str, k: int = WORDS) -> Column:
    """array<struct(w0 .. wk-1)>: the shingles of an array of words or word hashes, in order."""
    return F.when(F.size(words) >= k, F.arrays_zip(*_shifted(words, k)))


def _shingle_hash(prefix: str = "", k: int = WORDS) -> Column:
    return F.xxhash64(*[F.col(f"{prefix}w{i}") for i in range(k)])


def _votes(word: str, weight: str | None = None) -> list[Column]:
    """Aggregates: for each of 64 bits, how many more of a group's hashes have it than have not, each
    counted as 1 or with its ``weight``."""
    one = F.col(weight) if weight else F.lit(1)
    return [F.sum(F.when(F.shiftright(F.col(word), b).bitwiseAND(F.lit(1)) == 1, one).otherwise(-one)).alias(f"b{b}") for b in range(64)]


def _packed() -> Column:
    """The fingerprint from the 64 sums: bit b is set if its sum is above zero."""
    out = F.lit(0).cast("long")
    for b in range(64):
        out = out.bitwiseOR(F.when(F.col(f"b{b}") > 0, F.shiftleft(F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long")))
    return out


def fingerprints(rows: DataFrame, keys: list[str], words: str = "words") -> DataFrame:
    """keys + fingerprint of rows whose ``words`` is an array of word hashes; keys identify a row."""
    return rows.select(*keys, F.explode(words).alias("word")).groupBy(*keys).agg(*_votes("word")).select(*keys, _packed().alias("fingerprint"))


def weighted_fingerprints(shingles: DataFrame, key: str) -> DataFrame:
    """key + fingerprint of rows (key, s, n, weight): a shingle's words vote with its weight, n times."""
    votes = shingles.select(key, (F.col("n") * F.col("weight")).alias("vote"), F.explode(F.array(*[F.col(f"s.w{i}") for i in range(WORDS)])).alias("word"))
    return votes.groupBy(key).agg(*_votes("word", "vote")).select(key, _packed().alias("fingerprint"))


def _heaviest(item_side: DataFrame, similarity: float) -> DataFrame:
    """(item, shingle): of each item so many of its heaviest shingles that the others weigh less than
    ``similarity`` of it."""
    whole = Window.partitionBy("item")
    before = whole.orderBy(F.desc("weight"), "shingle").rowsBetween(Window.unboundedPreceding, -1)
    worth = F.col("n") * F.col("weight")
    ranked = item_side.select("item", "shingle", F.coalesce(F.sum(worth).over(before), F.lit(0.0)).alias("before"), F.sum(worth).over(whole).alias("total"))
    return ranked.filter(F.col("before") <= (1 - similarity + 1e-6) * F.col("total")).select("item", "shingle")


def _blocks(fingerprint: Column) -> list[tuple[int, int, Column]]:
    """(block, its bits, its value) of a fingerprint."""
    out, at = [], 0
    for k, bits in enumerate(BLOCKS):
        out.append((k, bits, F.shiftrightunsigned(fingerprint, at).bitwiseAND(F.lit((1 << bits) - 1).cast("long"))))
        at += bits
    return out


def _entries(block: int, values: Column) -> Column:
    return F.transform(values, lambda v: F.struct(F.lit(block).alias("block"), v.alias("value")))


def _block_rows(found: DataFrame, near: int) -> DataFrame:
    """``found`` with a row for each block and each value within ``near`` bits of the block's own."""
    entries = []
    for block, bits, value in _blocks(F.col("fingerprint")):
        masks = [sum(1 << b for b in chosen) for n in range(near + 1) for chosen in combinations(range(bits), n)]
        entries.append(_entries(block, F.array(*[value.bitwiseXOR(F.lit(m).cast("long")) for m in masks])))
    exploded = found.withColumn("entry", F.explode(F.concat(*entries)))
    return exploded.select(*found.columns, F.col("entry.block").alias("block"), F.col("entry.value").alias("value"))


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, *, id_col="doc_id", text_col="text", item_col="item_id", item_text_col="text") -> DataFrame:
    """doc_id, item_id, similarity, position of every benchmark passage found."""
    return passages(docs, benchmark, similarity, id_col=id_col, text_col=text_col, item_col=item_col, item_text_col=item_text_col).drop("found_by")


def passages(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, *, id_col="doc_id", text_col="text", item_col="item_id", item_text_col="text") -> DataFrame:
    """doc_id, item_id, similarity, position, found_by of every benchmark passage found."""
    ship_package(docs.sparkSession)
    hashed = lambda text: F.transform(word_array(text), lambda w: F.xxhash64(w))
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), hashed(F.col(item_text_col)).alias("words"))
    items = items.filter(F.col("item_id").isNotNull() & (F.size("words") > 0))
    short, items = items.filter(F.size("words") < WORDS), items.filter(F.size("words") >= WORDS)
    # A repeated item_id with other words is another item of that id.
    items = materialize(items.groupBy("item_id", "words").agg(F.lit(1).alias("one")).select("item_id", "words", F.xxhash64("item_id", "words").alias("item"), (F.size("words") - WORDS + 1).alias("size")), "items")
    placed = items.select("item", "size", F.posexplode(_shingles("words")).alias("place", "s")).select("item", "size", "place", _shingle_hash("s.").alias("shingle"))
    # Benchmark shingles, and the (size, place) of the windows each calls for, a row of its own each.
    weights = materialize(placed.groupBy("shingle").agg((1.0 / F.countDistinct("item")).alias("weight")), "weights")
    calls = materialize(placed.select("shingle", "size", "place").distinct(), "calls")
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), hashed(F.col(text_col)).alias("words")).filter("doc_id is not null")
    base = base.select("doc_id", F.xxhash64("words", F.lit(2)).alias("row"), "words")  # rows of one doc_id may hold other words
    n = (F.size("words") - WORDS + 1).alias("n")
    laid = base.select("doc_id", "row", n, F.posexplode(_shingles("words")).alias("at", "s")).select("doc_id", "row", "n", "at", _shingle_hash("s.").alias("shingle"))
    size = F.least("size", "n")
    start = F.greatest(F.lit(0), F.least(F.col("at") - F.col("place"), F.col("n") - size))
    # The same place is called for by several shingles: a map-side combine leaves one row for each before
    # the shuffle.  Only then are windows cut from the words, of the documents that have any.
    spans = laid.join(_sized(calls), "shingle").select("doc_id", "row", start.alias("position"), size.alias("size")).distinct()
    spans = materialize(spans, "spans")
    windows = base.join(_sized(spans), ["doc_id", "row"]).select("doc_id", "position", F.slice("words", F.col("position") + 1, F.col("size") + (WORDS - 1)).alias("words"))
    windows = windows.select("doc_id", "position", F.xxhash64("words", F.lit(1)).alias("window"), "words")
    windows = materialize(windows, "windows")
    distinct = windows.groupBy("window").agg(F.first("words").alias("words")).select("words", "window")
    distinct = materialize(distinct, "distinct_windows")  # a passage in many documents is searched once

    counted = lambda rows, key: rows.select(key, F.explode(_shingles("words")).alias("s")).select(key, "s", _shingle_hash("s.").alias("shingle")).groupBy(key, "shingle").agg(F.first("s").alias("s"), F.count("*").alias("n"))
    weighed = lambda rows, key: counted(rows, key).join(_sized(weights), "shingle", "left").select(key, "shingle", "s", "n", F.coalesce("weight", F.lit(1.0)).alias("weight"))
    window_side = materialize(weighed(distinct, "window"), "window_shingles")
    item_side = materialize(weighed(items, "item"), "item_shingles")

    near = RADIUS // len(BLOCKS)
    own = materialize(_block_rows(weighted_fingerprints(item_side, "item"), near), "index").withColumnRenamed("fingerprint", "item_print")
    probe = _block_rows(weighted_fingerprints(window_side, "window"), 0)
    met = probe.join(_sized(own), ["block", "value"]).filter(F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("item_print"))) <= RADIUS)
    met = materialize(met.select("window", "item").distinct(), "met")
    back = window_side.select("window", "shingle").join(_sized(materialize(_heaviest(item_side, similarity), "heaviest")), "shingle")
    back = back.select("window", "item").distinct().join(met, ["window", "item"], "left_anti")
    pairs = materialize(met.withColumn("met", F.lit(True)).union(back.withColumn("met", F.lit(False))), "near_pairs")

    total = lambda side, key, n: side.groupBy(key).agg(F.sum(F.col(n) * F.col("weight")).alias(f"{key}_total"))
    shared = pairs.join(window_side.select("window", "shingle", "n"), "window").join(_sized(item_side.select("item", "shingle", F.col("n").alias("m"), "weight")), ["item", "shingle"])
    shared = shared.groupBy("window", "item", "met").agg(F.sum(F.least("n", "m") * F.col("weight")).alias("shared"))
    scored = shared.join(total(window_side, "window", "n"), "window").join(total(item_side, "item", "n"), "item")
    scored = scored.select("window", "item", "met", (F.col("shared") / (F.col("window_total") + F.col("item_total") - F.col("shared"))).alias("similarity"))
    kept = scored.filter(F.col("similarity") >= similarity - 1e-9).join(items.select("item", "item_id"), "item")

    leading = F.max_by(F.struct("similarity", "position"), F.struct(F.round("similarity", 9), -F.col("position"))).alias("best")
    best = windows.select("doc_id", "position", "window").join(kept, "window").groupBy("doc_id", "item_id").agg(leading, F.bool_or("met").alias("met"))
    by = F.when(F.col("met"), "fingerprint").otherwise("heaviest").alias("found_by")
    best = best.select("doc_id", "item_id", F.round("best.similarity", 9).alias("similarity"), F.col("best.position").cast("long").alias("position"), by)
    runs = _short_runs(base, materialize(short.distinct(), "short_items"))
    if runs is None:
        return best
    # An item_id may have short and long items.
    both = best.union(runs.withColumn("found_by", F.lit("run"))).groupBy("doc_id", "item_id").agg(leading, F.min("found_by").alias("found_by"))
    return both.select("doc_id", "item_id", "best.similarity", "best.position", "found_by")


def _short_runs(base: DataFrame, short: DataFrame) -> DataFrame | None:
    """doc_id, item_id, similarity 1, position of the items of fewer than ``WORDS`` words, None if there
    are none: runs of words of an item's length are looked up by their hash."""
    out = None
    for k in [r[0] for r in short.select(F.size("words")).distinct().collect()]:
        own = short.filter(F.size("words") == k).select("item_id", F.xxhash64(*[F.get("words", F.lit(i)) for i in range(k)]).alias("run"))
        runs = base.select("doc_id", F.posexplode(_shingles("words", k)).alias("at", "s")).select("doc_id", "at", _shingle_hash("s.", k).alias("run"))
        found = runs.join(_sized(own), "run").groupBy("doc_id", "item_id").agg(F.min("at").alias("position"))
        out = found if out is None else out.union(found)
    if out is None:
        return None
    # An item_id may have items of several lengths.
    first = out.groupBy("doc_id", "item_id").agg(F.min("position").cast("long").alias("position"))
    return first.select("doc_id", "item_id", F.lit(1.0).alias("similarity"), "position")


#: A side of so many rows of at most five numbers (8 MB) is broadcast; beyond it a shuffle join is planned.
MAX_SIDE_ROWS = 200_000


def _sized(side: DataFrame) -> DataFrame:
    """A written benchmark-side table, broadcast only when counted to fit the bound."""
    return F.broadcast(side) if side.count() <= MAX_SIDE_ROWS else side


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs``, all columns, without the documents that hold a benchmark passage."""
    return drop_ids(docs, contaminated(docs, benchmark).select("doc_id"))
