"""Format-preserving pseudonyms of personal data (operator 6, DataFrame functions only).

Found and validated: card numbers (13 to 19 digits with a right Luhn check digit), phone numbers (with a
country code, or 3-3-4 digits), 3-2-4 social security numbers, IPv4 addresses (bytes up to 255, without
leading zeros), dates (Y-M-D, Y/M/D, D.M.Y, M/D/Y; real days of the range below) and e-mail addresses.

A number or date is a value of a finite set a x b (digits: 10^u x 10^v; address: 2^16 x 2^16; date: 270
x 270 days from 1900-01-01) and is moved by a keyed Feistel permutation of just that set, so a
pseudonym has the same format, equal values have equal pseudonyms in all documents, different values
different ones, and the key's holder can undo it.  A card gets the check digit of its new digits, a
phone number keeps its country code, read from its digits, so that a number is linked however it is
spaced; 3-3-4 digits are a number of country code 1.  Separators stay where they were.  Equal e-mail
addresses (letters of either case) get equal keyed-hash addresses.  What is not valid stays as it is, and
so do ten digits without a separator, national numbers with a leading zero, phone numbers with a group of one digit, days or months of one digit and
dates outside the range.

Numbers that follow each other after a space or hyphen are read together and apart: cards are searched in
every run of groups of such a sequence, those in a usual layout first (one group, 4-4-4-4, 4-6-4 or 4-6-5),
then from the left, the longest first.  A phone number of a country in ``NATIONAL`` has just that many digits,
another up to 15 in whole groups.  A sequence whose pseudonyms can be read in more than one way may not be undone.

Null texts stay null with zero counts; other columns are not read; repeated rows come back as they came;
an empty table gives no row.  Texts without a digit or @ are passed through untouched.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.hashing import hidden
from riskloom.llm.common import texts

ROUNDS = 8
KEY_MARK = "feistel-key:"

#: Days from 1900-01-01 that a date may be moved among: 270 x 270, up to 2099-08-04.
FIRST_DAY, DAYS_SIDE = "1900-01-01", 270

#: Country codes of one and two digits (ITU-T E.164); all others have three.
SHORT_CODES = "[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"

#: Digits after the country code where all numbers have the same count.
NATIONAL = {"1": 10, "7": 10, "31": 9, "33": 9, "34": 9, "41": 9, "44": 10, "45": 8, "47": 8, "48": 9, "61": 9, "86": 11, "91": 10}

#: A card in a usual layout, which a phone number does not run into.
USUAL_CARD = r"(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}([ -])[0-9]{6}\2[0-9]{4,5})"
_NO_CARD = r"(?![ .-](?:[0-9]{13,19}|[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5})(?![0-9]))"
#: A further digit of a phone number; a group has two at the least.
_DIGIT = rf"(?:{_NO_CARD}(?:[ .-]\(?(?=[0-9]{{2}})|\((?=[0-9]{{2}}))?[0-9]\)?)"
_ABROAD = "|".join(rf"\+{code}{_DIGIT}{{{n}}}(?![0-9])" for code, n in NATIONAL.items()) + rf"|\+[0-9]{_DIGIT}{{9,14}}(?![0-9])"
_LOCAL = r"(?<![0-9-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])"

#: What a match of each kind looks like; possessive runs keep a scan linear.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "ip": r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?[0-9])",
    "date": r"(?<![0-9-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9-])|(?<![0-9.])[0-9]{2}\.[0-9]{2}\.[0-9]{4}(?![0-9])|(?<![0-9/])(?:[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{4}/[0-9]{2}/[0-9]{2})(?![0-9/])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": rf"{_ABROAD}|{_LOCAL}",
}
#: All groups of digits in a row, 13 digits or more, up to one that begins a value of another kind.
_APART = "|".join(f"(?:{p})" for p in (PATTERNS["email"], PATTERNS["ip"], PATTERNS["date"], PATTERNS["ssn"], _LOCAL))
PATTERNS["card"] = rf"(?<![0-9])(?=[0-9](?:[ -]?[0-9]){{12}})[0-9]++(?:[ -](?!{_APART})[0-9]++)*+"
KINDS = tuple(PATTERNS)
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())


def key_of(secret: str) -> str:
    """The permutation key of a secret, in a form that session redaction recognises."""
    return KEY_MARK + hashlib.sha256(secret.encode()).hexdigest()


def _key(key: str | Column) -> Column:
    return key if isinstance(key, Column) else F.lit(key)


def permute(x: Column, a: Column, b: Column, tweak: Column, key: str | Column, undo: bool = False) -> Column:
    """The keyed permutation of 0 .. a * b - 1: ``ROUNDS`` Feistel rounds that add a keyed hash of one
    half to the other, modulo its own size.  ``undo`` inverts it."""

    def keyed(i: Column, half: Column) -> Column:
        text = F.concat_ws("|", _key(key), tweak, a.cast("string"), b.cast("string"), i.cast("string"), half.cast("string"))
        return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")

    def step(acc: Column, i: Column) -> Column:
        sign = -1 if undo else 1
        left = F.when(i % 2 == 0, F.pmod(acc["l"] + sign * F.pmod(keyed(i, acc["r"]), a), a)).otherwise(acc["l"])
        right = F.when(i % 2 == 1, F.pmod(acc["r"] + sign * F.pmod(keyed(i, acc["l"]), b), b)).otherwise(acc["r"])
        return F.struct(left.alias("l"), right.alias("r"))

    rounds = F.array(*[F.lit(i) for i in (reversed(range(ROUNDS)) if undo else range(ROUNDS))])
    start = F.struct(F.call_function("div", x, b).alias("l"), F.pmod(x, b).alias("r"))  # whole division of longs
    return F.aggregate(rounds, start, step, lambda acc: acc["l"] * b + acc["r"])


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _power(n: Column) -> Column:
    """10^n as a long, for n up to 18."""
    return F.get(F.array(*[F.lit(10**i).cast("long") for i in range(19)]), n)


def permute_digits(digits: Column, tweak: str | Column, key: str | Column, undo: bool = False) -> Column:
    """A string of up to 18 digits moved within all strings of its length."""
    n = F.length(digits)
    half = (n - n % 2) / 2
    low = F.ceil(n / 2).cast("int")
    moved = permute(digits.cast("long"), _power(half.cast("int")), _power(low), tweak if isinstance(tweak, Column) else F.lit(tweak), key, undo)
    return F.lpad(moved.cast("string"), n, "0")


def luhn_digit(payload: Column) -> Column:
    """The check digit that follows ``payload``."""
    n = F.length(payload)

    def worth(i: Column) -> Column:
        d = F.substring(payload, i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when((n - i) % 2 == 0, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda acc, i: acc + worth(i))
    return F.pmod(10 - total % 10, F.lit(10)).cast("string")


def refill(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced, in order, by those of ``digits``."""

    def place(i: Column) -> Column:
        c = F.substring(shape, i, F.lit(1))
        return F.when(c.between("0", "9"), F.substring(digits, F.length(_digits(F.substring(shape, F.lit(1), i))), F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(shape)), place), "")


def _kind(m: Column) -> Column:
    """The kind of a match, if it is valid; else null."""
    d = _digits(m)
    n = F.length(d)
    octets = F.split(m, r"\.")
    out = F.when(F.contains(m, F.lit("@")), "email")
    out = out.when(m.rlike(rf"^(?:{PATTERNS['ip']})$"), F.when(F.forall(octets, lambda o: (F.try_to_number(o, F.lit("999")) <= 255) & ~o.rlike("^0[0-9]")), "ip"))
    out = out.when(m.rlike(rf"^(?:{PATTERNS['date']})$"), F.when(_day(m).between(0, DAYS_SIDE**2 - 1), "date"))
    out = out.when(m.rlike(rf"^(?:{PATTERNS['ssn']})$"), "ssn")
    out = out.when(m.rlike(rf"^(?:{PATTERNS['phone']})$") & n.between(10, 15), "phone")
    return out.when(n.between(13, 19), F.when(luhn_digit(F.substring(d, F.lit(1), n - 1)) == F.substring(d, -1, 1), "card"))


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


#: The groups of a card, one digit each at the least.
CARD_GROUPS = 19


def _cards(groups: Column) -> Column:
    """array<struct(start, end, rank)>: the runs of ``groups`` that are cards, from the left, the longest
    first; rank 0 in a usual layout, else 1."""

    def read(s: Column) -> Column:
        right = lambda d: F.when(F.length(d).between(13, 19), luhn_digit(F.substring(d, F.lit(1), F.length(d) - 1)) == F.substring(d, -1, 1))
        return F.when(_let(_digits(s), right), F.when(s.rlike(rf"^{USUAL_CARD}[ -]?$"), 0).otherwise(1))

    def from_(i: Column) -> Column:
        counts = F.sequence(F.least(F.lit(CARD_GROUPS), F.size(groups) - i + 1), F.lit(1), F.lit(-1))
        runs = F.transform(counts, lambda c: F.struct(i.alias("start"), (i + c).alias("end"), read(F.array_join(F.slice(groups, i, c), "")).alias("rank")))
        return F.filter(runs, lambda c: c["rank"].isNotNull())

    return F.flatten(F.transform(F.sequence(F.lit(1), F.size(groups)), from_))


def _apart(cards: Column) -> Column:
    """From the left, the ``cards`` that begin after the end of the last taken."""
    start = F.struct(F.lit(1).alias("at"), F.array().cast("array<struct<start:int,end:int,rank:int>>").alias("out"))
    step = lambda acc, c: F.when(c["start"] >= acc["at"], F.struct(c["end"].alias("at"), F.concat(acc["out"], F.array(c)).alias("out"))).otherwise(acc)
    return F.aggregate(cards, start, step, lambda acc: acc["out"])


def _readings(m: Column) -> Column:
    """The parts of a match: of digit groups in a row the cards and what is between them, else the match."""

    def cut(groups: Column, taken: Column) -> Column:
        text = lambda a, b: F.array_join(F.slice(groups, a, b - a), "")
        start = F.struct(F.lit(1).alias("at"), F.array().cast("array<string>").alias("out"))
        step = lambda acc, c: F.struct(c["end"].alias("at"), F.concat(acc["out"], F.array(text(acc["at"], c["start"]), text(c["start"], c["end"]))).alias("out"))
        parts = F.aggregate(taken, start, step, lambda acc: F.concat(acc["out"], F.array(text(acc["at"], F.size(groups) + 1))))
        return F.filter(parts, lambda p: p != "")

    def choose(cards: Column) -> Column:
        usual = _apart(F.filter(cards, lambda c: c["rank"] == 0))
        free = lambda u: F.filter(cards, lambda c: (c["rank"] == 1) & ~F.exists(u, lambda x: (x["start"] < c["end"]) & (c["start"] < x["end"])))
        return _let(usual, lambda u: F.array_sort(F.concat(u, _apart(free(u)))))

    groups = F.regexp_extract_all(m, F.lit("[0-9]+[ -]?"), F.lit(0))
    several = _let(groups, lambda g: _let(_let(_cards(g), choose), lambda taken: cut(g, taken)))
    return F.when(m.rlike("^[0-9]+(?:[ -][0-9]+)++$") & (F.length(_digits(m)) >= 13), several).otherwise(F.array(m))


_YEAR_FIRST = "^[0-9]{4}/"


def _iso(m: Column) -> Column:
    part = lambda i, n: F.substring(m, i, n)
    us = F.concat_ws("-", part(7, 4), part(1, 2), part(4, 2))
    de = F.concat_ws("-", part(7, 4), part(4, 2), part(1, 2))
    return F.when(m.rlike(_YEAR_FIRST), F.translate(m, "/", "-")).when(F.contains(m, F.lit("/")), us).when(F.contains(m, F.lit(".")), de).otherwise(m)


def _day(m: Column) -> Column:
    """A date's days since FIRST_DAY; null if there is no such day."""
    return F.datediff(F.try_to_date(_iso(m), "yyyy-MM-dd"), F.lit(FIRST_DAY).cast("date"))


def pseudonym(m: Column, key: str | Column, undo: bool = False) -> Column:
    """The pseudonym of one match; a match that is not valid stays."""
    d = _digits(m)
    n = F.length(d)
    small = lambda v: F.lit(v).cast("long")
    body = permute_digits(F.substring(d, F.lit(1), n - 1), "card", key, undo)
    card = refill(m, F.concat(body, luhn_digit(body)))
    code = F.when(~m.startswith("+"), F.lit("")).when(d.rlike(f"^(?:{SHORT_CODES})"), F.regexp_extract(d, f"^(?:{SHORT_CODES})", 0)).otherwise(F.substring(d, 1, 3))
    rest = F.substring(d, F.length(code) + 1, n)
    country = F.concat(F.lit("phone"), F.when(code == "", F.lit("1")).otherwise(code))
    phone = refill(m, F.concat(code, permute_digits(rest, country, key, undo)))
    address = F.aggregate(F.split(m, r"\."), small(0), lambda acc, o: acc * 256 + o.cast("long"))
    moved = permute(address, small(65536), small(65536), F.lit("ip"), key, undo)
    ip = F.array_join(F.transform(F.array(*[F.lit(s) for s in (24, 16, 8, 0)]), lambda s: F.pmod(F.call_function("shiftright", moved, s), small(256)).cast("string")), ".")
    day = permute(_day(m).cast("long"), small(DAYS_SIDE), small(DAYS_SIDE), F.lit("date"), key, undo).cast("int")
    moved_day = F.date_add(F.lit(FIRST_DAY).cast("date"), day)
    shown = lambda pattern: F.date_format(moved_day, pattern)
    date = F.when(m.rlike(_YEAR_FIRST), shown("yyyy/MM/dd")).when(F.contains(m, F.lit("/")), shown("MM/dd/yyyy")).when(F.contains(m, F.lit(".")), shown("dd.MM.yyyy")).otherwise(shown("yyyy-MM-dd"))
    hashed = lambda s: F.sha2(F.concat(_key(key), F.lit("|"), F.lower(s)), 256)
    email = F.concat(F.lit("u"), F.substring(hashed(m), 1, 12), F.lit("@m"), F.substring(hashed(F.substring_index(m, "@", -1)), 1, 8), F.lit(".example"))
    kind = _kind(m)
    out = F.when(kind == "card", card).when(kind == "phone", phone).when(kind == "ssn", refill(m, permute_digits(d, "ssn", key, undo)))
    return out.when(kind == "ip", ip).when(kind == "date", date).when(kind == "email", m if undo else email).otherwise(m)


def pseudonymise(docs: DataFrame, key: str, *, id_col: str = "doc_id", text_col: str = "text", undo: bool = False) -> DataFrame:
    """doc_id, text with pseudonyms, and how many of each kind it had (n_email, n_ip, ...).

    One narrow pass: the pieces between matches and the pseudonyms alternate; no shuffle, no join.
    ``undo`` turns pseudonyms back, but for e-mail addresses."""
    secret = F.col("__key")  # in no plan, whatever the session redacts
    docs = texts(docs, id_col, text_col).withColumn("__key", hidden(docs.sparkSession, key))
    some = F.regexp_like("text", F.lit("[0-9@]"))
    none = F.array().cast("array<string>")
    found = docs.withColumn("found", F.when(some, F.regexp_extract_all("text", F.lit(ANY), F.lit(0))).otherwise(none))
    found = found.withColumn("parts", F.transform("found", _readings))
    new = F.transform("parts", lambda parts: F.array_join(F.transform(parts, lambda m: pseudonym(m, secret, undo)), ""))
    pieces = F.split("text", ANY, -1)
    woven = F.array_join(F.flatten(F.transform(F.arrays_zip(pieces.alias("piece"), new.alias("new")), lambda x: F.array(x["piece"], F.coalesce(x["new"], F.lit(""))))), "")
    kinds = F.transform(F.flatten("parts"), lambda m: _kind(m))
    of = lambda kind: F.filter("kinds", lambda k: k == kind)
    counts = [F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in KINDS]
    found = found.withColumn("kinds", F.coalesce(kinds, none))
    return found.select("doc_id", F.when(F.size("found") > 0, woven).otherwise(F.col("text")).alias("text"), *counts)
