"""Spelling variants of a corpus's words, grouped by asymmetric q-chunks (operator 11).

Words are the maximal runs of A-Z, a-z and U+00C0 to U+00FF, lower-cased for A-Z only.  Of the words of at
least ``min_length`` code points that occur ``min_count`` times, two are near when they differ by exactly
one inserted, deleted or replaced code point.

1. Words are counted per task, then by Spark; only (word, count) rows move.
2. Every unordered pair has one chunk side, its longer word (of two as long, the smaller), and one gram
   side.  The chunk side gives its first and its last q code points, q being half its length: they are
   disjoint, so one edit leaves one of them whole.  The gram side gives all its positional grams of the
   lengths that words as long as it or one longer cut.  A chunk that is left whole stands in the other word
   within shift one of its own place: the first at its place, the last there or one place before.  Sides
   join on (gram, place).
3. A key that very many words share is split by what the pair has beside the chunk: the rest of the longer
   word, again cut in two, and the rest of the other, which still differ by one edit only.  So a key is
   refined while it holds many pairs and there is a rest to cut, and no group of frequent beginnings or
   endings is joined all with all; no pair is lost, since every pair keeps one of the two halves.
4. Candidates are verified by their edit distance, distinct, and reduced to each word's near words, its
   most frequent one (ties: the smallest), and, by pointer doubling, the end of its chain of forms.

Counts cover all rows.  Null and empty texts have no words; a null id stands for the empty string where a
corrupted run is drawn; repeated rows and rows of one id count each.  A text of any length is read a run at
a time; a run is never cut.  Words as frequent as each other order by code points.  An empty table gives no
row.  Only the id and text columns are read, so others may have any name.
"""

from __future__ import annotations

from collections import Counter
from zlib import crc32

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import materialize, text_chunks, texts

RUNS = regex.compile("[A-Za-zÀ-ÿ]+")
#: Distinct words that a task counts before it hands their counts on.
TASK_WORDS = 200_000
#: Candidate pairs of a key up to which it is joined as it is.
KEY_PAIRS = 100_000
#: Every run whose checksum this number divides loses a code point in the registered query.
CORRUPTED = 97

KEYS = ["key", "place"]
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_counts(docs: DataFrame, min_length: int, min_count: int, *, corrupted: int | None = None, id_col="doc_id", text_col="text") -> DataFrame:
    """word, n of the words of ``docs``.  With ``corrupted`` = c, a run whose crc32 h of '<doc_id>:<run>'
    is divided by c is counted without its code point h % length."""

    def count(batches):
        seen: Counter[str] = Counter()

        def counted():
            found = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])
            seen.clear()
            return found

        def add(key: bytes, runs: Counter[str]) -> None:
            start = crc32(key)
            for run, n in runs.items():
                if corrupted and (h := crc32(run.encode(), start)) % corrupted == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1 :]
                if len(run) >= min_length:
                    seen[run] += n

        for batch in batches:
            for chunk in text_chunks(batch):
                for key, text in zip(chunk.column("doc_id").to_pylist(), chunk.column("text").to_pylist(), strict=True):
                    lead = b":" if key is None else b"%d:" % key
                    if not text:
                        continue
                    if len(text) <= 1 << 20:
                        add(lead, Counter(RUNS.findall(text.translate(_LOWER))))
                    else:
                        for m in RUNS.finditer(text):
                            add(lead, Counter([m.group().translate(_LOWER)]))
                            if len(seen) >= TASK_WORDS:
                                yield counted()
                if len(seen) >= TASK_WORDS:
                    yield counted()
        if seen:
            yield counted()

    parts = texts(docs, id_col, text_col).mapInArrow(count, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def _sub(text: Column, start: Column, size: Column) -> Column:
    """``size`` code points of ``text`` from ``start`` (from 0)."""
    return text.substr((start + 1).cast("int"), size.cast("int"))


def _rows(words: DataFrame, rows: Column) -> DataFrame:
    return words.select("word", F.explode(rows).alias("r")).select("r.key", "r.place", "word", "r.rest")


def _key(of: Column, gram: Column) -> Column:
    """A gram together with the size of the chunk side it is cut for; words hold no digits."""
    return F.concat(of.cast("string"), F.lit(":"), gram)


def chunk_rows(words: DataFrame) -> DataFrame:
    """key, place, word, rest: the two chunks of every word, at the places where they may stand in the
    other word, and what the word has beside them."""
    word, size = F.col("word"), F.length("word").cast("long")
    q = F.floor(size / 2)
    last = size - q
    row = lambda gram, place, rest: F.struct(_key(size, gram).alias("key"), place.cast("int").alias("place"), rest.alias("rest"))
    rows = [row(_sub(word, F.lit(0), q), F.lit(0), _sub(word, q, last))]
    rows += [row(_sub(word, last, q), last - shift, _sub(word, F.lit(0), last)) for shift in (0, 1)]
    return _rows(words, F.array(*rows))


def gram_rows(words: DataFrame) -> DataFrame:
    """key, place, word, rest: all positional grams of every word, as words of its size and of one more
    cut their chunks.  A gram that starts the word has the end beside it, any other the beginning."""
    word, size = F.col("word"), F.length("word").cast("long")

    def grams(of: Column) -> Column:
        q = F.floor(of / 2)
        rest = lambda p: F.when(p == 0, _sub(word, q, size - q)).otherwise(_sub(word, F.lit(0), p))
        one = lambda p: F.struct(_key(of, _sub(word, p, q)).alias("key"), p.cast("int").alias("place"), rest(p).alias("rest"))
        return F.transform(F.sequence(F.lit(0).cast("long"), size - q), one)

    return _rows(words, F.concat(grams(size), grams(size + 1)))


def _refined(chunks: DataFrame, grams: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides under finer keys: the chunk side's rest is cut in two, and the other side's as a rest
    of its size or of one more is; one edit leaves one half as it is."""
    rest, size = F.col("rest"), F.length("rest").cast("long")

    def halves(of: Column) -> Column:
        q = F.floor(of / 2)
        before = size - (of - q)
        row = lambda side, half, left: F.struct(F.concat("key", F.lit(side), _key(of, half)).alias("key"), "place", left.alias("rest"))
        return F.array(row("<", _sub(rest, F.lit(0), q), _sub(rest, q, size - q)), row(">", _sub(rest, before, of - q), _sub(rest, F.lit(0), before)))

    # A gram inside a word is no chunk of a near word: its neighbour's rest would not end where it starts.
    return _rows(chunks, halves(size)), _rows(grams.filter(size > 0), halves(size)).union(_rows(grams, halves(size + 1)))


def _joined(chunks: DataFrame, grams: DataFrame) -> DataFrame:
    """a, b: the candidates whose edit distance is one, a being the chunk side."""
    own, other = chunks.select(*KEYS, F.col("word").alias("a")), grams.select(*KEYS, F.col("word").alias("b"))
    la, lb = F.length("a"), F.length("b")
    may = (la == lb + 1) | ((la == lb) & (F.col("a") < F.col("b")))
    return own.join(other, KEYS).filter(may).filter(F.levenshtein("a", "b", 1) == 1).select("a", "b")


def near_pairs(words: DataFrame, key_pairs: int = KEY_PAIRS) -> DataFrame:
    """a, b: every pair of near words once, ``words`` being a column of distinct words."""
    chunks, grams, found = chunk_rows(words), gram_rows(words), []
    while True:
        chunks, grams = materialize(chunks, "chunks"), materialize(grams, "grams")
        load = chunks.groupBy(KEYS).agg(F.count(F.lit(1)).alias("x")).join(grams.groupBy(KEYS).agg(F.count(F.lit(1)).alias("y")), KEYS)
        hot = materialize(load.filter(F.col("x") * F.col("y") > key_pairs).select(*KEYS), "hot")
        if hot.isEmpty():
            found.append(_joined(chunks, grams))
            break
        found.append(_joined(chunks.join(hot, KEYS, "left_anti"), grams))
        chunks, grams = (side.join(hot, KEYS, "left_semi") for side in (chunks, grams))
        # Rests of one code point cannot be cut: all pairs of such a key are near, or one word.
        short = F.length("rest") <= 1
        found.append(_joined(chunks.filter(short), grams.filter(short)))
        chunks, grams = _refined(chunks.filter(~short), grams)
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.union(more)
    return materialize(pairs.distinct(), "near")


def variant_groups(words: DataFrame, *, ratio: int = 2, key_pairs: int = KEY_PAIRS) -> DataFrame:
    """word, form, root, n, n_near, form_n of every row of ``words`` (word, n): the form is the near
    word of largest n (ties: the smallest) if it has ``ratio`` times the word's n at least."""
    if ratio < 2:
        raise ValueError("forms of a ratio below 2 may run in circles")
    words = materialize(words.select("word", "n"), "words")
    if not words.filter(F.length("word") < 3).isEmpty():
        raise ValueError("words of fewer than three code points have no two chunks with a place of their own")
    near = near_pairs(words.select("word"), key_pairs)
    side = lambda c, n: words.select(F.col("word").alias(c), F.col("n").alias(n))
    both = near.join(side("a", "na"), "a").join(side("b", "nb"), "b")
    both = both.select("a", "b", "nb").union(both.select("b", "a", "na")).toDF("word", "other", "m")
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct(-F.col("m"), F.col("other"))).alias("top"))
    best = best.select("word", "n_near", F.col("top.other").alias("other"), (-F.col("top.col1")).alias("m"))
    own = words.join(best, "word", "left")
    has = F.col("m") >= F.col("n") * ratio
    formed = materialize(own.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(has, F.col("other")).alias("form"), F.when(has, F.col("m")).alias("form_n")), "formed")
    ends = chain_ends(formed.filter("form is not null").select("word", "form"))
    return formed.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def chain_ends(forms: DataFrame) -> DataFrame:
    """word, root: where the forms of each word (word, form; no circles) end.  Every round doubles the
    length of the chains followed."""
    ends = materialize(forms.toDF("word", "root"), "ends")
    while True:
        on = ends.toDF("root", "next")
        stepped = materialize(ends.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "ends")
        ends = stepped.select("word", "root")
        if stepped.filter("moved").isEmpty():
            return ends


def spelling_variants(docs: DataFrame, *, min_length: int = 5, min_count: int = 3, corrupted: int | None = None, id_col="doc_id", text_col="text") -> DataFrame:
    """The variant groups of the words of ``docs``."""
    return variant_groups(word_counts(docs, min_length, min_count, corrupted=corrupted, id_col=id_col, text_col=text_col))


VARIANTS_SQL = """
WITH RECURSIVE steps AS (SELECT list(c ORDER BY b) AS t FROM (
  SELECT b, list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: xor(c >> 1, CASE WHEN c % 2 = 1 THEN 3988292384 ELSE 0 END)) AS c FROM range(0, 256) AS r(b))),
low AS (SELECT coalesce(doc_id::VARCHAR, '') || ':' AS lead, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
runs AS (SELECT lead, run, count(*) AS n FROM (SELECT lead, unnest(regexp_extract_all(t, '[A-Za-z\\x{00C0}-\\x{00FF}]+')) AS run FROM low) GROUP BY ALL),
raw AS (SELECT run, n, hex(encode(lead || run)) AS h FROM runs),
coded AS (SELECT run, n, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, length(h) // 2), lambda i: ('0x' || substr(h, (2 * i + 1)::INT, 2))::BIGINT)),
  lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)) AS c FROM raw, steps),
drawn AS (SELECT run, n, xor(c, 4294967295::BIGINT) AS h FROM coded),
words AS (SELECT word, sum(n)::BIGINT AS n FROM (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM drawn)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cut AS (SELECT word, i, length(word) AS l, substr(word, 1, i::INT) || substr(word, i::INT + 2) AS rest FROM (SELECT word, unnest(range(0, length(word))) AS i FROM words)),
near AS (
  SELECT a.word AS a, b.word AS b FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.l = b.l AND a.word <> b.word
  UNION SELECT cut.word, words.word FROM cut JOIN words ON cut.rest = words.word
  UNION SELECT words.word, cut.word FROM cut JOIN words ON cut.rest = words.word),
best AS (SELECT a AS word, count(*) AS n_near, max(n) AS m, arg_min(b, (-n, b)) AS other FROM near JOIN words ON words.word = near.b GROUP BY a),
formed AS (SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * words.n THEN other END AS form, CASE WHEN m >= 2 * words.n THEN m END AS form_n
  FROM words LEFT JOIN best ON best.word = words.word),
walk(word, stop) AS (SELECT word, word FROM formed UNION ALL SELECT walk.word, formed.form FROM walk JOIN formed ON formed.word = walk.stop WHERE formed.form IS NOT NULL)
SELECT formed.word, formed.form, stop AS root, formed.n, formed.n_near, formed.form_n FROM formed JOIN walk ON walk.word = formed.word JOIN formed f2 ON f2.word = walk.stop WHERE f2.form IS NULL"""
