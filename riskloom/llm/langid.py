"""Language identification of mixed-language text (operator 7).

Learning: over all training documents, how often each hashed byte trigram (a letter with its two
neighbours, word edges included, lower case) and each script occurs in each language.  The model has at
most languages x ``BUCKETS`` numbers and is written once to the shared folder.

Prediction: a word's letters fall in script ranges; only languages that were seen to use its script are
its candidates (all, if none was).  A word scores the summed log-probabilities of its trigrams in each
candidate, and the best labelling of a document's words, where each change of language between
neighbours costs ``SWITCH``, is found by Viterbi.  Its runs are the spans.  The document's language is
that of most letters in spans (of equal ones the first by name), its score the share of those letters.

A text that is null or has no letter is ``und`` with score 0, as is every text if there was nothing to
learn from.  A language seen in one document only is learned as any other.  Rows come back one to one,
ids may be null or repeat, an empty table gives no row, and no column but the text is looked at.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import save_file, shared_folder, shared_uri, ship_package, text_chunks
from riskloom.llm.words import text_bytes

UNKNOWN = "und"
BUCKETS = 1 << 16
SMOOTHING = 0.5
#: Cost, in nats, of a change of language between two words.
SWITCH = 25.0
#: A language uses a script if at least this share of its words is written in it.
LEAST_SHARE = 0.01

#: First byte of a UTF-8 character, first and last, and its script; other first bytes
#: from C2 on are "other".  Continuation bytes have none.
SCRIPTS = (
    ("latin", 0x61, 0x7A), ("latin", 0xC3, 0xC9), ("greek", 0xCD, 0xCF), ("cyrillic", 0xD0, 0xD4), ("hebrew", 0xD6, 0xD7),
    ("arabic", 0xD8, 0xDB), ("indic", 0xE0, 0xE0), ("georgian", 0xE1, 0xE1), ("kana_or_han", 0xE3, 0xE9), ("hangul", 0xEA, 0xED),
)
NAMES = tuple(dict.fromkeys(["none", "latin", "other", *(s for s, _, _ in SCRIPTS)]))


def _script_table() -> np.ndarray:
    table = np.zeros(256, np.int64)
    table[0xC2:] = NAMES.index("other")
    for name, first, last in SCRIPTS:
        table[first : last + 1] = NAMES.index(name)
    return table


_SCRIPT = _script_table()
_LETTER = np.zeros(256, bool)
_LETTER[0x61:0x7B] = _LETTER[0x80:] = True

#: Bytes of text labelled at a time: what is made of them is some hundred times as large.
CHUNK_BYTES = 1 << 18

_MODELS: dict[str, Model] = {}


def word_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(trigram bucket of every letter byte, first letter of each word, script of each word, offsets
    of the texts into the words) of a text column."""
    raw, at = text_bytes(pc.utf8_lower(column.fill_null("")))
    if not raw.size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    letter = _LETTER[raw]
    plain = np.where(letter, raw, 0x20).astype(np.uint32)
    before, after = np.empty_like(plain), np.empty_like(plain)
    before[1:], after[:-1] = plain[:-1], plain[1:]
    before[at[:-1][at[:-1] < raw.size]] = 0x20
    after[at[1:][at[1:] > 0] - 1] = 0x20
    where = np.flatnonzero(letter)
    gram = (before[where] << np.uint32(16)) | (plain[where] << np.uint32(8)) | after[where]
    bucket = ((gram * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)
    first = np.flatnonzero(before[where] == 0x20)
    script = np.maximum.reduceat(_SCRIPT[raw[where]], first) if first.size else np.zeros(0, np.int64)
    return bucket, first, script, np.searchsorted(where[first], at)


def learn(docs: DataFrame, *, lang_col: str = "lang", text_col: str = "text") -> str:
    """Learn from all rows with a language; the URI of the written model."""
    ship_package(docs.sparkSession)
    uri = shared_uri(docs.sparkSession, "langid")
    labelled = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).filter("lang is not null and text is not null")

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for chunk in text_chunks(batch):
                bucket, first, script, words = word_features(chunk.column("text"))
                names, lang = np.unique(np.array(chunk.column("lang").to_pylist(), object), return_inverse=True)
                of_word = np.repeat(lang, np.diff(words))
                of_letter = np.repeat(of_word, np.diff(np.append(first, len(bucket))))
                size = BUCKETS + len(NAMES)
                grams = np.bincount(of_letter * BUCKETS + bucket, minlength=len(names) * BUCKETS).reshape(len(names), BUCKETS)
                scripts = np.bincount(of_word * len(NAMES) + script, minlength=len(names) * len(NAMES)).reshape(len(names), len(NAMES))
                for i, name in enumerate(names):
                    sums[name] = sums.get(name, np.zeros(size, np.int64)) + np.concatenate([grams[i], scripts[i]])
        for name, n in sums.items():
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(some)), pa.array(some), pa.array(n[some])], names=["lang", "feature", "n"])

    def write(batches):
        found = pa.Table.from_batches(list(batches))
        found = found.filter(pc.is_valid(found.column("lang")))
        langs = sorted(set(found.column("lang").to_pylist()))
        n = np.zeros((len(langs), BUCKETS + len(NAMES)))
        if langs:
            n[np.searchsorted(langs, found.column("lang").to_pylist()), found.column("feature").to_numpy()] = found.column("n").to_numpy()
        out = io.BytesIO()
        np.savez_compressed(out, langs=np.array(langs, dtype="U"), n=n)
        save_file(uri, "model.npz", [out.getvalue()])
        yield pa.RecordBatch.from_pydict({"langs": pa.array([len(langs)], pa.int32())})

    sums = labelled.mapInArrow(count, "lang string, feature long, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n"))
    one = docs.sparkSession.range(1).selectExpr("string(null) as lang", "0L as feature", "0L as n")  # so that there is a task
    # At most languages x features rows.
    sums.unionByName(one).repartition(1).mapInArrow(write, "langs int").collect()
    return uri


class Model:
    def __init__(self, langs: list[str], n: np.ndarray):
        self.langs = langs
        grams, scripts = n[:, :BUCKETS], n[:, BUCKETS:]
        self.log = np.log((grams + SMOOTHING) / (grams.sum(1, keepdims=True) + SMOOTHING * BUCKETS)).T.astype(np.float32).copy()
        uses = scripts >= LEAST_SHARE * np.maximum(scripts.sum(1, keepdims=True), 1)
        uses[:, ~uses.any(0)] = True  # a script never seen tells nothing
        self.barred = np.where(uses, 0.0, -1e6).T

    @classmethod
    def load(cls, uri: str) -> Model:
        if uri not in _MODELS:
            fs, root = shared_folder(uri)
            with fs.open_input_file(f"{root}/model.npz") as f:
                held = np.load(io.BytesIO(f.read()), allow_pickle=False)
                _MODELS.clear()
                _MODELS[uri] = cls([str(x) for x in held["langs"]], held["n"])
        return _MODELS[uri]

    def label(self, column: pa.Array) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Of each text: the language of every word and the letters of every word."""
        bucket, first, script, words = word_features(column)
        if not len(first):
            return [np.zeros(0, np.int64)] * len(column), [np.zeros(0, np.int64)] * len(column)
        score = np.add.reduceat(self.log[bucket], first, axis=0).astype(np.float64) + self.barred[script]
        size = np.diff(np.append(first, len(bucket)))
        spans = list(zip(words[:-1], words[1:], strict=True))
        return [best_labels(score[a:b]) for a, b in spans], [size[a:b] for a, b in spans]


def best_labels(score: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The labels of words (rows) with the greatest summed score less ``switch`` for each change; of
    equal ones the first.

    If no stretch of words gains more than half a switch in any other language, the best single
    language is the answer: k changes make at most k + 1 stretches, and such a labelling gains no more
    than it pays.  Only other texts need the recurrence."""
    n, langs = score.shape
    if not n or langs == 1:
        return np.zeros(n, np.int64)
    one = int(score.sum(0).argmax())
    gain = np.zeros((n + 1, langs))
    np.cumsum(score - score[:, one : one + 1], axis=0, out=gain[1:])
    if (gain - np.minimum.accumulate(gain, axis=0)).max() <= switch / 2:
        return np.full(n, one)
    return viterbi(score, switch)


def viterbi(score: np.ndarray, switch: float) -> np.ndarray:
    n, langs = score.shape
    value, back, every = score[0].tolist(), [], range(langs)
    for row in score[1:].tolist():
        top = max(value)
        come = value.index(top)
        top -= switch
        stay = [value[i] >= top for i in every]
        back.append([i if stay[i] else come for i in every])
        value = [(value[i] if stay[i] else top) + row[i] for i in every]
    label = value.index(max(value))
    out = [label]
    for step in reversed(back):
        label = step[label]
        out.append(label)
    return np.array(out[::-1])


RESULT = "lang_pred string, score double, spans array<struct<lang:string,start:int,end:int>>"


def predicted(text: Column, uri: str) -> Column:
    """struct(RESULT) of a text column; spans are in words (runs of letters), end exclusive."""
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("spans", pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int32()), ("end", pa.int32())])))])

    @F.arrow_udf(RESULT)
    def run(column: pa.Array) -> pa.Array:
        model, done = Model.load(uri), []
        batch = pa.RecordBatch.from_arrays([column], names=["text"])
        for chunk in text_chunks(batch, limit=CHUNK_BYTES):
            own, out = chunk.column("text"), []
            real = pc.fill_null(pc.match_substring_regex(own, r"\pL"), False).to_pylist()
            if not model.langs:
                done.append(pa.array([{"lang_pred": UNKNOWN, "score": 0.0, "spans": []}] * len(own), kind))
                continue
            for letters, labels, sizes in zip(real, *model.label(own), strict=True):
                if not letters or not len(labels):
                    out.append({"lang_pred": UNKNOWN, "score": 0.0, "spans": []})
                    continue
                share = np.bincount(labels, sizes, len(model.langs))
                best = int(share.argmax())
                cuts = np.concatenate([[0], np.flatnonzero(np.diff(labels)) + 1, [len(labels)]])
                spans = [{"lang": model.langs[labels[a]], "start": int(a), "end": int(b)} for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                out.append({"lang_pred": model.langs[best], "score": float(share[best] / share.sum()), "spans": spans})
            done.append(pa.array(out, kind))
        return pa.concat_arrays(done) if done else pa.array([], kind)

    return run(text)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn_by_id(docs: DataFrame, *, id_col: str = "doc_id") -> str:
    """``learn`` from the documents that are not held out; those without an id are left aside."""
    return learn(docs.filter(F.col(id_col).isNotNull() & ~held_out(F.col(id_col))))


def identified(docs: DataFrame, uri: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score, spans of every row."""
    ship_package(docs.sparkSession)
    found = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), predicted(F.col(text_col).cast("string"), uri).alias("p"))
    return found.select("doc_id", "held_out", "p.lang_pred", "p.score", "p.spans")


def keep_identified(docs: DataFrame, uri: str, least: float, *, text_col: str = "text") -> DataFrame:
    """``docs``, all columns, whose language is known with at least score ``least``."""
    ship_package(docs.sparkSession)
    found = docs.withColumn("__langid", predicted(F.col(text_col).cast("string"), uri))
    return found.filter((F.col("__langid.lang_pred") != UNKNOWN) & (F.col("__langid.score") >= least)).drop("__langid")
