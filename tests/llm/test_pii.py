import hashlib
import re
from datetime import date, datetime, timedelta

import pytest
from odd import empty, frame, rows
from pyspark.sql import functions as F

from riskloom.llm import pii

KEY = pii.key_of("test")
GOOD = {
    "card": ["4041894974608795", "4111-1111-1111-1111", "3782 822463 10005"],
    "phone": ["+1 (988) 555-2485", "+49 30 1234 5678", "(988) 555-2485", "988-555-2485"],
    "ssn": ["123-45-6789"], "ip": ["42.144.35.254", "0.0.0.0", "255.255.255.255"],
    "date": ["2024-02-29", "2024/01/05", "31.12.1999", "12/31/1999", "1900-01-01"], "email": ["bosbt.42@mail8.example.com", "A@b.co"],
}
BAD = ["4041894974608796", "2023-02-29", "42.144.35.256", "1.2.3", "31.04.2000", "13/31/1999", "4.0.", "12345", "a@b", "2099-12-31"]


def luhn(d):
    digits = [int(c) for c in reversed(d)]
    return sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(digits)) % 10 == 0


def run(spark, texts, **options):
    data = [(i, t) for i, t in enumerate(texts)]
    return {r["doc_id"]: r for r in pii.pseudonymise(frame(spark, data), KEY, **options).collect()}


@pytest.mark.parametrize("kind", list(GOOD))
def test_each_kind_keeps_its_format(spark, kind):
    values = GOOD[kind]
    got = run(spark, [f"é {v} and {v}, x" for v in values])
    for i, v in enumerate(values):
        r = got[i]
        first, second = re.fullmatch(r"é (.*) and (.*), x", r["text"]).groups()
        assert first == second != v and r[f"n_{kind}"] == 2 and sum(r[f"n_{k}"] for k in pii.KINDS) == 2
        assert re.fullmatch(pii.PATTERNS[kind], first)
        if kind not in ("ip", "email"):
            assert re.sub("[0-9]", "9", first) == re.sub("[0-9]", "9", v)
        if kind == "card":
            assert luhn(re.sub("[^0-9]", "", first))
        if kind == "ip":
            assert all(int(o) < 256 for o in first.split("."))
    if kind != "email":
        back = run(spark, [got[i]["text"] for i in range(len(values))], undo=True)
        assert [back[i]["text"] for i in range(len(values))] == [f"é {v} and {v}, x" for v in values]


def test_equal_values_stay_linked_and_invalid_ones_stay(spark):
    got = run(spark, ["on 2024-02-29 a", "b 2024-02-29", *(f"x {b} y" for b in BAD)])
    assert got[0]["text"].split()[1] == got[1]["text"].split()[1] != "2024-02-29"
    assert [got[i + 2]["text"] for i in range(len(BAD))] == [f"x {b} y" for b in BAD]


def test_odd_rows(spark):
    got = pii.pseudonymise(frame(spark), KEY).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    assert sorted(((r[0], r[1]) for r in got), key=key) == sorted(rows(), key=key)
    assert pii.pseudonymise(empty(spark), KEY).count() == 0


@pytest.mark.parametrize("a,b", [(10, 10), (1, 7), (270, 3), (100, 1000)])
def test_the_permutation_is_one_to_one(spark, a, b):
    x, sides = F.col("id"), [F.lit(s).cast("long") for s in (a, b)]
    moved = spark.range(a * b).select("id", pii.permute(x, *sides, F.lit("t"), KEY).alias("y"))
    back = moved.select("id", "y", pii.permute(F.col("y"), *sides, F.lit("t"), KEY, undo=True).alias("z")).collect()
    assert {r["y"] for r in back} == set(range(a * b)) and all(r["id"] == r["z"] for r in back)


def test_day_range():
    assert (date(2099, 8, 4) - date(1900, 1, 1)).days == pii.DAYS_SIDE**2 - 1


def test_key_is_not_shown(spark):
    plan = pii.pseudonymise(frame(spark), KEY)._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("extended"))
    assert KEY[12:] not in plan


def test_numbers_beside_a_value_do_not_hide_it(spark):
    card, solid, phone = "4111 1111 1111 1111", "4111111111111111", "+1 555 123 4567"
    alone = run(spark, [card, solid, phone, "+49 30 1234 5678"])
    new = {v: alone[i]["text"] for i, v in enumerate([card, solid, phone, "+49 30 1234 5678"])}
    cases = [
        (card, "{} 12/27"), (card, "{} 123"), (solid, "2 {}"), (card, "1234 {} 99"), (card, "12 {} 12.34"), (solid, "17-{}-5 123456"), (card, "1 2 3 4 5 6 7 8 9 10 11 {} 12 13 14"), (card, "+5 {}"),
        (phone, "{} 2024 12"), (phone, "{} 2024"), ("+49 30 1234 5678", "{} 2024 12"),
    ]
    got = run(spark, [f"x {c.format(v)} y" for v, c in cases])
    for i, (v, c) in enumerate(cases):
        assert got[i]["text"] == f"x {c.format(new[v])} y" and sum(got[i][f"n_{k}"] for k in pii.KINDS) == 1
    mixed = f"{card} 2024-02-29 {phone} {solid} 123-45-6789 {card} 42.144.35.254"
    r = run(spark, [mixed])[0]
    assert (r["n_card"], r["n_date"], r["n_phone"], r["n_ssn"], r["n_ip"]) == (3, 1, 1, 1, 1) and r["text"].count(new[card]) == 2 and new[phone] in r["text"] and new[solid] in r["text"]
    assert run(spark, [r["text"]], undo=True)[0]["text"] == mixed


def plain_permute(x, a, b, tweak):
    left, right = divmod(x, b)
    for i in range(pii.ROUNDS):
        half = right if i % 2 == 0 else left
        k = int(hashlib.sha256(f"{KEY}|{tweak}|{a}|{b}|{i}|{half}".encode()).hexdigest()[:15], 16)
        left, right = ((left + k % a) % a, right) if i % 2 == 0 else (left, (right + k % b) % b)
    return left * b + right


def plain(kind, v):
    """The pseudonym of a value, digit by digit."""
    digits = re.sub("[^0-9]", "", v)

    def moved(d, tweak):
        return str(plain_permute(int(d), 10 ** (len(d) // 2), 10 ** -(-len(d) // 2), tweak)).zfill(len(d))

    if kind == "ip":
        x = plain_permute(int.from_bytes(map(int, v.split("."))), 1 << 16, 1 << 16, "ip")
        return ".".join(map(str, x.to_bytes(4)))
    if kind == "date":
        form = "%Y/%m/%d" if v[4] == "/" else "%m/%d/%Y" if "/" in v else "%d.%m.%Y" if "." in v else "%Y-%m-%d"
        days = (datetime.strptime(v, form).date() - date(1900, 1, 1)).days
        return (date(1900, 1, 1) + timedelta(plain_permute(days, 270, 270, "date"))).strftime(form)
    if kind == "card":
        body = moved(digits[:-1], "card")
        new = body + next(c for c in "0123456789" if luhn(body + c))
    elif kind == "phone":
        code = next(c for c in ("1", "49", "44", "971") if digits.startswith(c)) if v[0] == "+" else ""
        new = code + moved(digits[len(code) :], "phone" + (code or "1"))
    else:
        new = moved(digits, kind)
    out = iter(new)
    return re.sub("[0-9]", lambda _: next(out), v)


def test_equals_a_plain_version(spark):
    values = [(k, v) for k, some in GOOD.items() if k != "email" for v in some]
    got = run(spark, [f"a {v} b" for _, v in values])
    assert [got[i]["text"] for i in range(len(values))] == [f"a {plain(k, v)} b" for k, v in values]


def test_a_phone_number_is_linked_however_it_is_spaced(spark):
    spelt = [
        ["+1 555 123 4567", "+15551234567", "+1 (555) 123-4567", "(555) 123-4567", "555-123-4567"],
        ["+44 20 7946 0958", "+442079460958"], ["+971 50 123 4567", "+971501234567"],
    ]
    for same, code in zip(spelt, ("1", "44", "971"), strict=True):
        got = run(spark, [f"x {v} y" for v in same])
        new = [got[i]["text"][2:-2] for i in range(len(same))]
        digits = [re.sub("[^0-9]", "", v).removeprefix(code if v[0] == "+" else "") for v in new]
        assert len(set(digits)) == 1 and digits[0] not in same[1] and all(v.startswith("+" + code) for v in new if v[0] == "+")
        back = run(spark, [f"x {v} y" for v in new], undo=True)
        assert [back[i]["text"][2:-2] for i in range(len(same))] == same
    assert run(spark, ["a 010.001.001.001 b"])[0]["n_ip"] == 0


def test_key_is_not_shown_under_a_session_pattern_of_its_own(spark):
    spark.conf.set("spark.sql.redaction.string.regex", "nothing-like-it")
    try:
        plan = pii.pseudonymise(frame(spark), KEY)._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("extended"))
    finally:
        spark.conf.unset("spark.sql.redaction.string.regex")
    assert KEY[12:] not in plan
