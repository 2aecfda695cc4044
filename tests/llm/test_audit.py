"""Filter audit: against running every order of the filters over the rows."""

import random
from itertools import permutations

from odd import CLASHING, prose

from riskloom.llm.audit import COUNTS, FILTERS, filter_audit


def plain(docs, labels):
    """(part, order, step) -> counts, by running the filters."""
    least, good, toxic = {}, set(), set()
    for key, text, _ in docs:
        if key is not None:
            least[text or ""] = min(key, least.get(text or "", key))
    for key, quality, bad in labels:
        good |= {key} if quality == 1 and key is not None else set()
        toxic |= {key} if bad == 1 and key is not None else set()

    def fails(key, text):
        t = text or ""
        words = [w for w in "".join(" " if c in "\t\n\v\f\r" else c for c in t).split(" ") if w]
        return {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t),
                "D": any(c in "#$%&*|" for c in t), "E": key is not None and key > least[t]}

    found, out = [(key, part or "", fails(key, text)) for key, text, part in docs], {}
    for order in permutations(FILTERS):
        for part in {p for _, p, _ in found}:
            left = [(k, f) for k, p, f in found if p == part]
            gone = []
            for step, own in enumerate(order, 1):
                lost, kept = [x for x in left if x[1][own]], [x for x in left if not x[1][own]]
                alone = sum(f[own] and sum(f.values()) == 1 for _, p, f in found if p == part)
                out[part, "".join(order), step] = [len(kept), len(lost), sum(f[own] for _, f in gone), alone, sum(k in good for k, _ in lost), sum(k in toxic for k, _ in lost)]
                left, gone = kept, gone + lost
    for (part, order, step), row in out.items():
        own = order[step - 1]
        row.append(sum(r[1] for (p, o, s), r in out.items() if p == part and o[s - 1] == own)) if len(row) == 6 else None
    return out


def frames(spark, docs, labels):
    extra = CLASHING.replace("source string, ", "") + ", bits int, hash string, good int, toxic int, id long, body string"
    d = spark.createDataFrame([(*r, *[None] * len(extra.split(","))) for r in docs], f"doc_id long, text string, source string, {extra}").repartition(3)
    return d, spark.createDataFrame([(*r, "x") for r in labels], "doc_id long, quality int, toxic int, part string")


def test_equals_running_the_filters(spark):
    rng = random.Random(3)
    base = [prose(k, rng.choice([10, 60, 90])) for k in range(12)] + ["SHOUTED " * 60, "a b " * 40, prose(50, 70) + " 5%", None, "", " \t\n"]
    docs = [(rng.choice([None, *range(40)]), rng.choice(base), rng.choice([None, "", "web", "books"])) for _ in range(150)]
    docs += [(7, base[1], "web")] * 3 + [(-5, base[2], "web"), (2**40, base[2], None)]
    labels = [(rng.choice([None, *range(40)]), rng.choice([None, 0, 1]), rng.choice([None, 0, 1])) for _ in range(60)]
    got = {(r["part"], r["filter_order"], r["step"]): [r[c] for c in COUNTS] for r in filter_audit(*frames(spark, docs, labels)).collect()}
    assert got == plain(docs, labels)


def test_empty_tables(spark):
    docs, labels = frames(spark, [(1, "a b", "s")], [])
    assert filter_audit(docs.limit(0), labels).count() == 0
    assert filter_audit(docs, labels).count() == 600


def test_a_text_that_all_rows_share(spark):
    docs = [(k, prose(1, 80), "s") for k in range(500)]
    got = filter_audit(*frames(spark, docs, [(0, 1, 0), (9, 1, 1)])).filter("filter_order = 'EABCD' and step = 1").first()
    assert [got[c] for c in COUNTS][:3] == [1, 499, 0] and (got["good_lost"], got["toxic_lost"]) == (1, 1)
