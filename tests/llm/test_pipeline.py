"""The pipeline against the same stages in plain code."""

import random

import public_tokenizers
from odd import frame, prose
from test_decontam import brute as leaks
from test_jaccard import brute as groups
from test_secrets import SECRETS, by_hand
from tokenizers import Tokenizer

import corpus_pipeline as cp

EN, DE = "the and house of with from this that wording letter".split(), "der und haus von mit aus dieses nicht wort brief".split()


def sentence(seed, n, words):
    rng = random.Random(seed)
    return " ".join(rng.choice(words) + rng.choice("abcdefgh") for _ in range(n))


def corpus():
    """(doc_id, text, lang, kept up to the language stage)."""
    out = []
    for i in range(60):
        words, lang = (EN, "en") if i % 2 else (DE, "de")
        out.append((i, sentence(i, 40 + i, words), lang, True))
    out += [(100 + i, out[i][1] + " tail", out[i][2], True) for i in range(10)]
    out += [(200 + i, out[i][1], out[i][2], True) for i in range(5)]
    out += [(300, sentence(1, 30, EN) + " " + ITEM + " " + sentence(2, 30, EN), "en", True), (301, ITEM, "en", True)]
    out += [(400 + i, sentence(50 + i, 30, EN) + " " + s, "en", True) for i, s in enumerate(SECRETS[:6])]
    out += [(500, None, "en", False), (501, "", "en", False), (502, "12 34", "en", False), (503, sentence(3, 12, EN), None, True)]
    return out


ITEM = sentence(999, 45, EN)


def test_stages_equal_plain_code(spark, tmp_path):
    data = corpus()
    docs = frame(spark, [(k, t) for k, t, _, _ in data]).drop("lang")
    docs = docs.join(spark.createDataFrame([(k, lang) for k, _, lang, _ in data], "doc_id long, lang string"), "doc_id")
    items = [(1, ITEM), (2, prose(5, 30))]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))

    left = {k: t for k, t, _, kept in data if kept}
    step = spark.read.parquet(str(tmp_path / "documents.parquet"))
    want = [dict(left)]
    one = {k for k, _, c in groups([*left.items()], cp.SHINGLE_WORDS, cp.SIMILAR_PERCENT) if k == c}
    want.append({k: t for k, t in left.items() if k in one})
    bad = {f[0] for f in leaks([*want[-1].items()], items)}
    want.append({k: t for k, t in want[-1].items() if k not in bad})
    want.append({k: t for k, t in want[-1].items() if not by_hand(t)[-1]})
    assert len({len(w) for w in want}) == 4  # every stage drops some
    for (name, stage), kept in zip(cp.STAGES[:-1], want, strict=True):
        step = cp.materialize(stage(spark, step, str(tmp_path)), name)
        assert sorted(step.columns) == sorted(docs.columns)
        assert dict(step.select("doc_id", "text").collect()) == kept, name
    own = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    lengths = {k: len(own.encode(t, add_special_tokens=False).ids) + 1 for k, t in want[-1].items()}
    for rows in (cp.STAGES[-1][1](spark, step, str(tmp_path)).collect(), cp.run(spark, str(tmp_path)).collect()):
        got = {}
        for r in rows:
            got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
        assert got == lengths


def test_shape():
    assert [n for n, _ in cp.STAGES] == ["language", "near_duplicates", "benchmark_passages", "secrets", "packing"] and cp.ORACLE_SQL is None


def test_documents_without_an_id_are_filtered_too(spark, tmp_path):
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    known, lone = sentence(70, 40, EN), sentence(71, 40, EN)
    docs = frame(spark, [(7, known), (None, known), (None, lone), (None, lone), (None, lone + " tail"), (None, ITEM), (None, sentence(72, 30, EN) + " " + SECRETS[0])])
    for stage, left in ((cp.near_duplicates, 4), (cp.benchmark_passages, 3), (cp.secrets, 2)):
        docs, columns = cp.materialize(stage(spark, docs, str(tmp_path)), "step"), docs.columns
        assert docs.columns == columns and docs.count() == left, stage.__name__
    got = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert (7, known) in got and [k for k, t in got if t.startswith(lone)] == [None]
