"""Byte-level BPE by prefixes: ids and decoded texts equal the tokenizers library's."""

import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pytest
from odd import empty, frame, rows
from tokenizers import Tokenizer

from riskloom.llm.bpe import ByteBpe, SuffixAutomaton, UnsupportedTokenizer, decode_documents, encode_documents, round_trip
from riskloom.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def own():
    return ByteBpe(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids(own, text):
    return [i for block in own.encode(text) for i in block.tolist()]


def test_random_texts_equal_the_library(own, library):
    rng = random.Random(5)
    pieces = ["a", "aa", "ab", "the", "ing", " ", "  ", "\n", "\t", "é", "日本", "ß", "'s", "'ll", "<|endoftext|>", "1", "23", "!!", "\x85", " ", "\U0001f600", "é", "\x1c", "꟝", "\U00010ec5"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 50))) for _ in range(3000)]
    texts += ["".join(chr(rng.choice([rng.randint(0, 0x2FF), rng.randint(0, 0xD7FF), rng.randint(0xE000, 0x10FFFF)])) for _ in range(20)) for _ in range(1000)]
    texts += ["".join(rng.choice("aabcdehit") for _ in range(150)) for _ in range(500)] + ["a" * k for k in range(200)]
    want = library.encode_batch(texts, add_special_tokens=False)
    assert [ids(own, t) for t in texts] == [e.ids for e in want]
    assert ["".join(own.decode(own.encode(t))) for t in texts] == [library.decode(e.ids, skip_special_tokens=False) for e in want]


def test_every_token_is_its_own_encoding_and_prefixes_store_their_last_token(own, library):
    rng = random.Random(6)
    assert all(own.part_ids(own.bytes_of[t]) == [t] for t in rng.sample(range(50256), 5000))
    part = b" antidisestablishmentarianism"
    for k, last in enumerate(own.last_tokens(part), 1):
        assert last == library.encode(part[:k].decode(), add_special_tokens=False).ids[-1]


def test_long_texts_without_spaces_and_blocks(own, library, monkeypatch):
    monkeypatch.setattr("riskloom.llm.bpe.BLOCK_PARTS", 7)
    monkeypatch.setattr("riskloom.llm.bpe.KEEP_PARTS", 20)
    rng = random.Random(7)
    for text in ["x" * 20_000, "".join(rng.choice("日本語の文") for _ in range(5000)), "".join(rng.choice("ab é\n") for _ in range(5000)), " " * 3000 + "a"]:
        assert ids(own, text) == library.encode(text, add_special_tokens=False).ids
        assert "".join(own.decode(own.encode(text))) == text


def test_ids_that_are_no_text_decode_as_the_library_does(own, library):
    rng = random.Random(8)
    for _ in range(500):
        some = [rng.randrange(50257) for _ in range(rng.randint(0, 12))]
        assert "".join(own.decode([np.array(x) for x in np.array_split(np.array(some, int), 3)])) == library.decode(some, skip_special_tokens=False)


def test_automaton_finds_the_strings_that_end_at_each_place():
    rng = random.Random(9)
    strings = list({bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 6))) for _ in range(60)} | {b"a", b"b", b"c"})
    auto = SuffixAutomaton(list(enumerate(strings)))
    text = bytes(rng.choice(b"abc") for _ in range(300))
    state = matched = 0
    for end, letter in enumerate(text, 1):
        while letter not in auto.next[state]:
            state = auto.link[state]
            matched = auto.length[state]
        state, matched = auto.next[state][letter], matched + 1
        at = state if matched == auto.length[state] and auto.string[state] >= 0 else auto.up[state]
        found = []
        while at:
            found.append(strings[auto.string[at]])
            at = auto.up[at]
        assert found == sorted((s for s in strings if text[:end].endswith(s)), key=len, reverse=True)


def test_other_tokenizers_are_refused(tmp_path):
    with pytest.raises(UnsupportedTokenizer):
        ByteBpe(public_tokenizers.path("word_bpe_49k.json"))
    spec = json.load(open(PATH, encoding="utf-8"))
    spec["added_tokens"][0]["lstrip"] = True
    (tmp_path / "t.json").write_text(json.dumps(spec))
    with pytest.raises(UnsupportedTokenizer):
        ByteBpe(str(tmp_path / "t.json"))


def test_odd_rows(spark, library):
    got = sorted((str(r["doc_id"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in round_trip(frame(spark), PATH).collect())
    want = []
    for key, text in rows():
        own = library.encode(text or "", add_special_tokens=False).ids
        want.append((str(key), len(own), hashlib.sha256(np.array(own, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want)
    assert round_trip(empty(spark), PATH).count() == 0


def test_documents_there_and_back(spark):
    encoded = encode_documents(frame(spark), PATH)
    back = sorted((str(r["doc_id"]), r["text"]) for r in decode_documents(encoded, PATH).collect())
    assert back == sorted((str(k), t or "") for k, t in rows())


def test_query_equals_the_library(spark, library):
    import pyarrow.parquet as pq

    docs = pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    got = {r["doc_id"]: r for r in QUERIES["op13_byte_bpe"](spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(docs)
    for d in docs:
        own = library.encode(d["text"] or "", add_special_tokens=False).ids
        text = library.decode(own, skip_special_tokens=False)
        r = got[d["doc_id"]]
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(own), hashlib.sha256(np.array(own, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
