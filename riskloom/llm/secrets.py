"""Secret scan through a trigram inverted index over the rules' trigrams (operator 2, DataFrame functions only).

1. Every rule's regex gives a Boolean query: an OR of ANDs of trigrams that any match must hold, read
   off the literal runs of the parsed pattern (in lower case).  A rule without one has no query.
2. Postings: one row (trigram, document) for each of the queries' trigrams that a document holds.
3. A query's postings are intersected: a conjunction whose trigrams all point to a document makes that
   document a candidate of the rule.  Only candidates' texts are run through the rule's regex.  Rules
   without a query run over every text.

Spans are code points, end exclusive, of the leftmost non-overlapping matches of each kind; a match
whose tested group is too short is dropped after matching.  Null texts are empty and give no span;
rows with equal (doc_id, text) share their result, so repeated rows come back as often as they came.
Only doc_id and text are read; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from re import _constants as rc  # the standard library's own regex parser
from re import _parser as rp

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import MAX_BROADCAST_IDS, drop_ids, materialize, texts


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    any_case: str = ""  # the part of the pattern, if any, that matches letters of either case
    tested: int = 0  # the group whose length is tested
    least: int = 0  # its least length

    @property
    def regex(self) -> str:
        return self.pattern.replace(self.any_case, f"(?i:{self.any_case})", 1) if self.any_case else self.pattern


ASSIGN_WORDS = "password|passwd|secret|token|api_?key"

#: In the order that breaks ties of start: the three base kinds, then the added ones.
RULES = (
    Rule("assign", rf"({ASSIGN_WORDS})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", ASSIGN_WORDS, 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", least=18),
    Rule("hex", r"[0-9a-f]+", least=16),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
BASE = ("assign", "access", "hex")

#: A class of up to this many characters is spelled out into alternatives.
SPELLED = 8


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """The alternatives of a pattern's Boolean trigram query, each a set of trigrams that must all be
    there; empty if some match of the pattern need hold no trigram."""
    runs = _runs(rp.parse(pattern))
    query = [frozenset(run[i : i + 3] for run in alternative for i in range(len(run) - 2)) for alternative in runs]
    return list(dict.fromkeys(query)) if all(query) else []


def _runs(node) -> list[tuple[str, ...]]:
    """Alternatives of a parsed pattern; each lists the literal runs of a match in their order.  The
    last run of one is still open: a literal that follows continues it."""
    done: list[tuple[str, ...]] = [("",)]
    for op, arg in node:
        if op is rc.LITERAL:
            nexts = [(chr(arg).lower(),)]
        elif op is rc.IN and len(arg) <= SPELLED and all(o is rc.LITERAL for o, _ in arg):
            nexts = [(chr(c).lower(),) for _, c in arg]
        elif op is rc.SUBPATTERN:
            nexts = _runs(arg[3])
        elif op is rc.BRANCH:
            nexts = [run for part in arg[1] for run in _runs(part)]
        elif op is rc.MAX_REPEAT and arg[0] == 0 and arg[1] == 1 and len(inner := _runs(arg[2])) == 1:
            nexts = [("",), *inner]
        elif op is rc.MAX_REPEAT and arg[0] == arg[1] == 1:
            nexts = _runs(arg[2])
        else:  # anything else may match anything: the run ends, another begins
            nexts = [("", "")]
        done = list(dict.fromkeys((*a[:-1], a[-1] + b[0], *b[1:]) for a in done for b in nexts))
        if len(done) > 64:
            return [("", "")]
    return done


def found_spans(text: Column, rule: Rule) -> Column:
    """array<struct(start, order, end)> of a rule's matches in ``text``.

    The pieces between matches and the matches alternate, so running sums of their lengths are the
    places; nothing is written into the text, whatever characters it holds."""
    regex = F.lit(rule.regex)
    pieces = F.transform(F.split(text, rule.regex, -1), F.length)
    whole = F.transform(F.regexp_extract_all(text, regex, F.lit(0)), F.length)
    tested = F.transform(F.regexp_extract_all(text, regex, F.lit(rule.tested)), F.length) if rule.tested else whole
    order = [r.kind for r in RULES].index(rule.kind) if rule in RULES else len(RULES)
    empty = F.array().cast("array<struct<start:int,ord:int,end:int>>")

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + x["size"]
        span = F.struct(start.alias("start"), F.lit(order).alias("ord"), end.alias("end"))
        kept = F.when(x["tested"] >= rule.least, F.array_append(acc["spans"], span)).otherwise(acc["spans"])
        return F.struct(end.alias("at"), kept.alias("spans"))

    row = F.arrays_zip(F.slice(pieces, 1, F.size(whole)).alias("gap"), whole.alias("size"), tested.alias("tested"))
    spans = F.aggregate(row, F.struct(F.lit(0).alias("at"), empty.alias("spans")), step, lambda acc: acc["spans"])
    return F.when(F.regexp_like(text, regex), spans).otherwise(empty)


def secret_spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ``spans``: array<struct(start, ord, end)> by start, then the rule's place, per row."""
    docs = texts(docs, id_col, text_col).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    queries = {r: trigram_query(r.pattern) for r in rules}
    indexed = {r: q for r, q in queries.items() if q}
    empty = F.array().cast("array<struct<start:int,ord:int,end:int>>")
    everywhere = [found_spans(F.col("text"), r) for r in rules if r not in indexed]
    base = docs.withColumn("__h", F.xxhash64("text"))
    rows = base.select("doc_id", "__h", (F.concat(*everywhere) if everywhere else empty).alias("__everywhere"))
    if not indexed:
        return rows.select("doc_id", F.array_sort("__everywhere").alias("spans"))

    vocabulary = sorted({t for q in indexed.values() for alternative in q for t in alternative})
    lowered = base.select("doc_id", "__h", F.lower("text").alias("low"))  # once, not once a trigram
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in vocabulary]))
    posted = lowered.select("doc_id", "__h", F.explode(held).alias("trigram"))
    postings = materialize(posted, "postings")  # the inverted index, for any number of queries

    # Intersection, algebraic so that a document's postings meet as partial aggregates: a
    # conjunction's trigrams are all there when the set of held ones has its size.
    wanted = [(rules.index(r), k, t) for r, q in indexed.items() for k, alternative in enumerate(q) for t in sorted(alternative)]
    conditions = docs.sparkSession.createDataFrame(wanted, "rule int, alt int, trigram string")
    sizes = {(rules.index(r), k): len(alternative) for r, q in indexed.items() for k, alternative in enumerate(q)}
    need = docs.sparkSession.createDataFrame([(r, k, n) for (r, k), n in sizes.items()], "rule int, alt int, need int")
    # Conditions are a few rows for each rule, whatever the data.
    met = postings.join(F.broadcast(conditions), "trigram").distinct().groupBy("doc_id", "__h", "rule", "alt").agg(F.count("*").alias("n"))
    met = met.join(F.broadcast(need), ["rule", "alt"]).filter("n = need")
    candidates = materialize(met.groupBy("doc_id", "__h").agg(F.collect_set("rule").alias("__rules")), "candidates")

    # Candidates meet their texts: where they are counted to fit, every task gets their keys and no
    # text moves; beyond that, only texts that hold some rule's full conjunction do.
    left, side = base, candidates
    if candidates.count() <= MAX_BROADCAST_IDS:
        side = F.broadcast(candidates)
    else:
        low, some = F.lower("text"), F.lit(False)
        for alternative in (x for q in indexed.values() for x in q):
            both = F.lit(True)
            for t in sorted(alternative):
                both = both & F.contains(low, F.lit(t))
            some = some | both
        left = base.filter(some)
    same = left["doc_id"].eqNullSafe(side["doc_id"]) & (left["__h"] == side["__h"])
    spans = F.concat(*[F.when(F.array_contains("__rules", rules.index(r)), found_spans(left["text"], r)).otherwise(empty) for r in indexed])
    verified = left.join(side, same).select(left["doc_id"].alias("__id"), left["__h"].alias("__g"), spans.alias("__verified")).dropDuplicates(["__id", "__g"])
    joined = rows.join(verified, rows["doc_id"].eqNullSafe(verified["__id"]) & (rows["__h"] == verified["__g"]), "left")
    spans = F.array_sort(F.concat("__everywhere", F.coalesce("__verified", empty)))
    return joined.select("doc_id", spans.alias("spans"))


def digest(found: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans (text) from ``secret_spans``."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    word = lambda x: F.concat_ws(":", F.get(kinds, x["ord"]), x["start"].cast("string"), x["end"].cast("string"))
    n_base = [r.kind for r in rules].index(BASE[-1]) + 1
    base = F.filter("spans", lambda x: x["ord"] < n_base)
    of = lambda i: F.filter("spans", lambda x: x["ord"] == i)
    counts = [F.size(of(i)).cast("long").alias(f"n_{k}") for i, k in enumerate(BASE)]
    return found.select("doc_id", *counts, F.sha2(F.array_join(F.transform(base, word), ","), 256).alias("base_sha256"), F.array_join(F.transform("spans", word), ",").alias("spans"))


def without_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, all columns, without the documents in which some rule has a span.  Rows without an id
    cannot be told apart afterwards and stay."""
    found = secret_spans(docs, rules, id_col=id_col, text_col=text_col).filter(F.size("spans") > 0)
    return drop_ids(docs, found.select("doc_id"), id_col)


def secrets_sql(rules: tuple[Rule, ...] = RULES) -> str:
    """DuckDB SQL of ``digest(secret_spans(documents))``: every regex over every text."""

    def spans(i: int, r: Rule) -> str:
        regex = r.regex.replace("'", "''")
        group = f"regexp_extract_all(t, '{regex}', {r.tested})"
        start = "list_sum(list_transform(p[:i], lambda y: length(y))) + coalesce(list_sum(list_transform(m[:i-1], lambda y: length(y))), 0)"
        return (
            f"SELECT k, {i} AS ord, '{r.kind}' AS kind, s AS s, s + length(m[i]) AS e FROM (SELECT k, i, m, {start} AS s FROM "
            f"(SELECT k, p, m, g, unnest(range(1, len(m) + 1)) AS i FROM (SELECT k, regexp_split_to_array(t, '{regex}') AS p, "
            f"regexp_extract_all(t, '{regex}') AS m, {group} AS g FROM docs WHERE regexp_matches(t, '{regex}'))) WHERE length(g[i]) >= {r.least})"
        )

    parts = " UNION ALL ".join(spans(i, r) for i, r in enumerate(rules))
    n_base = len(BASE)
    item = "kind || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT)"
    counts = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in BASE)
    listed = lambda w: f"coalesce(string_agg({item}, ',' ORDER BY s, ord){w}, '')"
    return (
        f"WITH docs AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents), found AS ({parts}) "
        f"SELECT any_value(doc_id) AS doc_id, {counts}, sha256({listed(f' FILTER (ord < {n_base})')}) AS base_sha256, {listed('')} AS spans "
        f"FROM docs LEFT JOIN found USING (k) GROUP BY docs.k"
    )


def matches_in(text: str, rule: Rule) -> list[tuple[int, int]]:
    """The spans of one rule in one text, by Python's regex (for tests and single texts)."""
    return [m.span() for m in re.finditer(rule.regex, text, re.ASCII) if len(m.group(rule.tested)) >= rule.least]
