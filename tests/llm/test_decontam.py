import random
import re
from collections import Counter

import pytest
from odd import CLASHING, empty, frame, prose, rows

from riskloom.llm import decontam as dc


def bench(spark, items):
    return spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, doc_id string").repartition(2)


ITEMS = [(1, prose(11, 40)), (2, prose(12, 25) + "\nmore " + prose(13, 30)), (3, "too few words"), (4, None), (None, prose(14, 30)), (5, prose(15, 12)), (1, prose(11, 40)), (6, "the of and a to in is")]


def edited(text, k):
    words = text.split()
    words[k] = "changed"
    return " ".join(words)


def ascii_upper(text):
    return "".join(c.upper() if c.isascii() else c for c in text)


DOCS = [
    *rows(), (201, prose(21, 50) + " " + ascii_upper(ITEMS[0][1]) + " " + prose(22, 50)), (202, ITEMS[1][1].replace(" ", "\n\t")), (203, edited(ITEMS[1][1], 2) + " " + prose(23, 10)),
    (204, " ".join(ITEMS[0][1].split()[:10])), (205, prose(24, 300) + " " + ITEMS[5][1] + " " + ITEMS[0][1]), (None, ITEMS[0][1]), (206, "the of and a to in was"), (201, "other text"),
]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def shingles(w):
    return [tuple(w[i : i + 5]) for i in range(len(w) - 4)]


def brute(docs, items, t=dc.SIMILARITY):
    """Every window of every document against every item."""
    real = {(k, tuple(words(x))) for k, x in items if k is not None and len(words(x)) >= 5}
    df = Counter(s for _, w in real for s in set(shingles(w)))
    weight = lambda s: 1 / df[s] if s in df else 1.0
    out = {}
    for key, text in docs:
        own = shingles(words(text))
        for item, w in real:
            there = Counter(shingles(w))
            size = min(sum(there.values()), len(own))
            for at in range(len(own) - size + 1 if key is not None and size else 0):
                here = Counter(own[at : at + size])
                low = sum(weight(s) * min(n, there[s]) for s, n in here.items())
                total = sum(weight(s) * n for c in (here, there) for s, n in c.items())
                if low / (total - low) >= t - 1e-9:
                    best = out.get((key, item), (0, 0))
                    out[key, item] = max(best, (round(low / (total - low), 6), -at))
    return {(k, i, s, -at) for (k, i), (s, at) in out.items()}


def test_found_passages_equal_brute_force(spark):
    got = dc.contaminated(frame(spark, DOCS), bench(spark, ITEMS)).collect()
    found = {(r["doc_id"], r["item_id"], round(r["similarity"], 6), r["position"]) for r in got}
    assert len(found) == len(got) and found == brute(DOCS, ITEMS)
    assert {(201, 1), (202, 2), (203, 2), (205, 1), (205, 5)} <= {f[:2] for f in found} and not {204, 206} & {f[0] for f in found}


def test_empty_tables(spark):
    assert dc.contaminated(empty(spark), bench(spark, ITEMS)).count() == 0
    assert dc.contaminated(frame(spark), bench(spark, [(1, None)])).count() == 0


def test_stage_keeps_clean_documents(spark):
    docs = frame(spark, DOCS)
    kept = dc.decontaminate(docs, bench(spark, ITEMS))
    assert kept.columns == docs.columns and CLASHING.split()[0] in kept.columns
    bad = {f[0] for f in brute(DOCS, ITEMS)}
    key = lambda x: (x is None, x or 0)
    assert sorted((r[0] for r in kept.collect()), key=key) == sorted((k for k, _ in DOCS if k not in bad), key=key)


@pytest.mark.parametrize("distance", [0, 1, dc.RADIUS - 1, dc.RADIUS])
def test_the_index_misses_nothing_within_the_radius(spark, distance):
    rng = random.Random(distance)
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    prints = [rng.getrandbits(64) for _ in range(60)]
    near = [p ^ sum(1 << b for b in rng.sample(range(64), distance)) for p in prints]
    own = spark.createDataFrame([(i, signed(p)) for i, p in enumerate(prints)], "item long, fingerprint long")
    probe = spark.createDataFrame([(i, signed(p)) for i, p in enumerate(near)], "window long, fingerprint long")
    index = dc._block_rows(own, dc.RADIUS // len(dc.BLOCKS)).select("item", "block", "value")
    met = dc._block_rows(probe, 0).join(index, ["block", "value"]).filter("window = item").select("window").distinct()
    assert met.count() == len(prints)


def test_simhash_equals_the_vote(spark):
    hashes = [[1, -1, 5], [7], [2**62, -(2**62), 3, 3]]
    got = dc.fingerprints(spark.createDataFrame(list(enumerate(hashes)), "k long, words array<long>"), ["k"]).collect()
    for k, fingerprint in got:
        votes = [sum(1 if h >> b & 1 else -1 for h in hashes[k]) for b in range(64)]
        assert fingerprint % 2**64 == sum(1 << b for b in range(64) if votes[b] > 0)


@pytest.mark.parametrize("header,body", [(16, 24), (60, 30)])
def test_items_that_share_a_header_equal_brute_force(spark, header, body):
    rng = random.Random(header)
    draw = lambda n: " ".join(f"w{rng.randrange(400)}" for _ in range(n))
    opening = draw(header)
    bodies = [draw(body) for _ in range(50)]
    items = [(i, f"{opening} {b}") for i, b in enumerate(bodies)]
    docs = [(i, b) for i, b in enumerate(bodies)] + [(100 + i, f"{opening.split()[-1]} {b}") for i, b in enumerate(bodies)] + [(200, opening)]
    found = {(r["doc_id"], r["item_id"], round(r["similarity"], 6), r["position"]) for r in dc.contaminated(frame(spark, docs), bench(spark, items)).collect()}
    expected = brute(docs, items)
    assert found == expected and len(expected) >= 100


def test_rows_of_one_id_keep_all_their_passages(spark):
    items = [(i, prose(40 + i, 30)) for i in range(8)]
    docs = [(7, text) for _, text in items] + [(7, " ".join(text.split()[:5]) + " " + prose(60 + i, 25)) for i, text in items]
    got = dc.contaminated(frame(spark, docs), bench(spark, items)).collect()
    assert sorted((r["doc_id"], r["item_id"], r["similarity"], r["position"]) for r in got) == [(7, i, 1.0, 0) for i in range(8)]


def test_items_of_fewer_than_five_words(spark):
    items = [(1, "Quux"), (2, "blue\tquux tree"), (3, "one two three four"), (4, " "), (5, prose(15, 12)), (5, "blue")]
    docs = [(10, "a blue quux\ntree, a blue QUUX tree"), (11, "quux"), (12, "one two x three four"), (13, "x one Two three four " + items[4][1]), (14, None)]
    got = dc.contaminated(frame(spark, docs), bench(spark, items)).collect()
    assert sorted(tuple(r) for r in got) == [(10, 1, 1.0, 2), (10, 2, 1.0, 5), (10, 5, 1.0, 1), (11, 1, 1.0, 0), (13, 3, 1.0, 1), (13, 5, 1.0, 5)]


def replaced(rng, text, share):
    return " ".join(f"x{rng.randrange(10**6)}" if rng.random() < share else w for w in text.split())


def test_the_fingerprints_alone_find_nine_pairs_in_ten(spark):
    rng = random.Random(5)
    items = [(i, prose(300 + i, 20 + i)) for i in range(40)]
    docs = [(100 * k + i, prose(1000 + 100 * k + i, 15) + " " + replaced(rng, text, share) + " " + prose(2000 + i, 15)) for k, share in enumerate((0.0, 0.01, 0.02, 0.03)) for i, text in items]
    found = dc.passages(frame(spark, docs), bench(spark, items)).collect()
    # Changed words at a passage's ends leave windows beside its place that are as similar.
    assert {(r["doc_id"], r["item_id"], round(r["similarity"], 6)) for r in found} == {p[:3] for p in brute(docs, items)}
    by = Counter(r["found_by"] for r in found)
    print("found by", dict(by))
    assert by["fingerprint"] >= 0.9 * len(found) and len(found) >= 90


def test_without_the_way_back_the_fingerprints_give_the_pairs(spark, monkeypatch):
    rng = random.Random(6)
    items = [(i, prose(400 + i, 40)) for i in range(20)]
    docs = [(i, replaced(rng, text, 0.01)) for i, text in items]
    whole = dc.passages(frame(spark, docs), bench(spark, items)).collect()
    monkeypatch.setattr(dc, "_heaviest", lambda item_side, similarity: item_side.select("item", "shingle").limit(0))
    alone = dc.passages(frame(spark, docs), bench(spark, items)).collect()
    key = lambda r: (r["doc_id"], r["item_id"])
    assert {key(r) for r in alone} == {key(r) for r in whole if r["found_by"] == "fingerprint"} and alone
    monkeypatch.setattr(dc, "RADIUS", -1)
    assert dc.passages(frame(spark, docs), bench(spark, items)).count() == 0


def test_a_long_text_without_broadcasts(spark, monkeypatch):
    items = [(i, prose(500 + i, 30)) for i in range(10)]
    docs = [(1, prose(7, 20_000) + " " + items[3][1] + " " + prose(8, 20_000)), (2, items[4][1])]
    want = sorted((r["doc_id"], r["item_id"], r["position"]) for r in dc.passages(frame(spark, docs), bench(spark, items)).collect())
    monkeypatch.setattr(dc, "MAX_SIDE_ROWS", -1)
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    try:
        got = dc.passages(frame(spark, docs), bench(spark, items)).collect()
    finally:
        spark.conf.set(setting, before)
    assert sorted((r["doc_id"], r["item_id"], r["position"]) for r in got) == want and {(1, 3), (2, 4)} <= {w[:2] for w in want}
