"""Threshold-scaled document sketches (operator 3).

The shingles of a text are its runs of five words (the whole sequence of one to four words counts as
one).  The sketch keeps every distinct shingle hash below 1/``SCALE`` of the hash range, however long
the text, and besides the smallest hash alone.  Sketches of parts merge into the sketch of the whole
(union; smaller minimum), and a part's share in another text is estimated without bias, however
unequal the two.  A text without words has the empty sketch.

As a string a sketch is its sorted hashes, 16 hex digits each, the minimum first; equal texts have
equal strings.  Likeness of two sketches: shared hashes over all hashes (Jaccard estimate); 1 if the
sketches are equal, 0 if just one is empty.  Containment: shared hashes over those of the first.

Each document is also held against the next one in descending doc_id (after the last, the first) and
against its edit with it.  Null texts are empty; null ids come last, repeated ids follow each other by
text; an empty table gives no row; only doc_id and text are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import materialize, text_chunks, texts
from riskloom.llm.words import shingle_sets

#: One of so many shingle hashes is kept.
SCALE = 8
WORDS = 5

COLUMNS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, contained_edited double, contained_next double"
)
_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string())]
    + [(c, pa.float64()) for c in ("near_edited", "near_next", "contained_edited", "contained_next")]
)
#: Ranges of ids for each shuffle partition: several, so that hashing them evens out.
RANGES = 4


def sketch(hashes: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """The sketch of sorted distinct hashes: the minimum, then what is below the threshold."""
    kept = hashes[: np.searchsorted(hashes, np.uint64(2**64 // scale))]
    return np.concatenate([hashes[:1], kept])


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of all shingles of two texts."""
    if not a.size or not b.size:
        return a if a.size else b
    return np.concatenate([np.minimum(a[:1], b[:1]), np.union1d(a[1:], b[1:])])


def as_string(sketched: np.ndarray) -> str:
    return sketched.astype(">u8").tobytes().hex()


def from_string(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u8").astype(np.uint64)


def likeness(a: np.ndarray, b: np.ndarray) -> tuple[float, float]:
    """(Jaccard estimate, containment of a in b) of two sketches."""
    if np.array_equal(a, b):
        return 1.0, 1.0
    if not a.size or not b.size:
        return 0.0, 0.0
    own, other = np.unique(a), np.unique(b)
    shared = np.intersect1d(own, other, assume_unique=True).size
    return shared / (own.size + other.size - shared), shared / own.size


def edited(text: str, following: str) -> str:
    """``text`` with its last half (rounded down) replaced by as much of ``following``'s start."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compare(keys: list, bodies: list[str], followings: list[str], scale: int, sketches: list[np.ndarray]) -> pa.RecordBatch:
    """The rows of documents whose next texts are at hand; ``sketches`` has those of ``bodies`` and
    then of ``followings``."""
    edits = [edited(t, f) for t, f in zip(bodies, followings, strict=True)]
    changed = [sketch(s, scale) for s in shingle_sets(pa.array(edits, pa.large_string()), WORDS, True)]
    own, nexts = sketches[: len(bodies)], sketches[len(bodies) :]
    near = [likeness(a, b) for a, b in zip(own, changed, strict=True)]
    far = [likeness(a, b) for a, b in zip(own, nexts, strict=True)]
    columns = [
        keys, [len(t) for t in bodies], [hashlib.sha256(t.encode()).hexdigest() for t in edits], [as_string(s) for s in own], [as_string(s) for s in changed],
        [x[0] for x in near], [x[0] for x in far], [x[1] for x in near], [x[1] for x in far],
    ]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SCHEMA, strict=True)], schema=_SCHEMA)


def _range_of(bounds: list[float]):
    """The range of an id, counted down from the greatest ids; ids that are null come last."""
    edges = np.array(sorted(set(bounds)))

    @F.arrow_udf("int")
    def place(ids: pa.Array) -> pa.Array:
        at = len(edges) - np.searchsorted(edges, ids.fill_null(0).to_numpy(zero_copy_only=False).astype(float))
        return pa.array(np.where(ids.is_null().to_numpy(zero_copy_only=False), len(edges) + 1, at).astype("int32"))

    return place


def fingerprints(docs: DataFrame, scale: int = SCALE, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: COLUMNS.

    Ids are cut into ranges at approximate quantiles; each range lies in one task, sorted, where a
    row's next text is the next row's.  A range's last row needs the first text of the range after
    it: those few texts (one a range) are read beforehand and join their range as a border row.  So
    texts are shuffled once and nothing is written in between."""
    docs = texts(docs, id_col, text_col).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = RANGES * partitions
    place = _range_of(docs.approxQuantile("doc_id", [i / n for i in range(1, n)], 1 / (4 * n)))
    firsts = docs.select("doc_id", place("doc_id").alias("range")).groupBy("range").agg(F.max("doc_id").alias("first"))
    firsts = materialize(firsts, "firsts")
    texts_of = docs.join(F.broadcast(firsts), docs["doc_id"].eqNullSafe(firsts["first"])).groupBy("range").agg(F.min("text").alias("text"))
    following = F.lead("text").over(Window.orderBy("range"))  # a row a range
    lowest = F.min_by("text", "range").over(Window.partitionBy())
    borders = texts_of.select("range", F.lit(None).cast("long").alias("doc_id"), F.coalesce(following, lowest).alias("text"), F.lit(True).alias("border"))
    borders = materialize(borders, "borders")

    def walk(batches):
        last = None  # (id, text, whether it is a border) of the row before
        for batch in batches:
            for chunk in text_chunks(batch):
                rows = list(zip(*(chunk.column(c).to_pylist() for c in ("doc_id", "text", "border")), strict=True))
                if last is not None:
                    rows.insert(0, last)
                last = rows[-1]
                own = [sketch(s, scale) for s in shingle_sets(pa.array([r[1] for r in rows], pa.large_string()), WORDS, True)]
                use = [i for i, r in enumerate(rows[:-1]) if not r[2]]
                if use:
                    yield _compare([rows[i][0] for i in use], [rows[i][1] for i in use], [rows[i + 1][1] for i in use], scale, [own[i] for i in use] + [own[i + 1] for i in use])

    ranged = docs.select(place("doc_id").alias("range"), "doc_id", "text", F.lit(False).alias("border")).unionByName(borders)
    # Ids in descending order; sorting by text makes the order of repeated ids definite.
    ordered = ranged.repartition(partitions, "range").sortWithinPartitions("range", "border", F.desc_nulls_last("doc_id"), "text")
    return ordered.mapInArrow(walk, COLUMNS)
