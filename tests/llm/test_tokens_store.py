import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from odd import empty, frame, rows

from riskloom.llm import tokens
from riskloom.llm.idstore import read_ids, read_index, scan_store, write_store

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = list("abcXYZ .,'!\n\t\r\x0b\x0c\xa0éÉßñİΣς²½日本0123\x00​\x1c\x85́") + ["<|endoftext|>", "<|startoftext|>", "'s", "'LL", "ſ", "K"]


def library_ids(text):
    return tokens.encoder(PATH).tokenizer.encode(text or "", add_special_tokens=False).ids


def test_ids_equal_the_library(monkeypatch):
    monkeypatch.setattr(tokens, "KEEP_PARTS", 500)  # also when the cache begins anew
    rng = random.Random(3)
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 40))) for _ in range(3000)] + [None, "", "a.,", ".", "..a,"]
    for k in range(0, len(texts), 700):
        part = texts[k : k + 700]
        ids, at = tokens.WordEncoder(PATH).encode(pa.array(part, pa.string()))
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [library_ids(t) for t in part]
    sliced = pa.array(texts, pa.string())[5:50]
    ids, at = tokens.encoder(PATH).encode(sliced)
    assert ids.tolist() == [i for t in texts[5:50] for i in library_ids(t)]


def expected(data):
    out, start = [], 0
    ids = lambda t: [*library_ids(t), 1]
    for key, text in sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, len(ids(r[1])))):
        own = ids(text)
        out.append((key, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
        start += len(own)
    return out


def test_store_round_trip(spark):
    got = scan_store(*write_store(frame(spark), PATH, 1, shard_bytes=3000)).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == expected(rows())
    assert scan_store(*write_store(empty(spark), PATH, 1)).count() == 0


def test_one_document_by_the_index(spark):
    data = [(i, f"Document number {i}, with words.") for i in range(300)]
    uri, shards = write_store(frame(spark, data), PATH, 1)
    for shard in shards.collect():
        index = read_index(uri, shard["name"])
        assert len(index) == shard["n_docs"]
        for entry in index[:: max(1, len(index) // 5)]:
            assert read_ids(uri, shard["name"], entry).tolist() == [*library_ids(dict(data)[entry["doc_id"]]), 1]
