"""DuckDB SQL for every class-A query, written from each operator's
definition (not generated from the Spark plans).

The pieces are CTE texts composed per query; the driver runs the resulting
statements against the pre-registered parquet views.
"""

from __future__ import annotations

import math

FEATS = ["f_chars", "f_words", "f_lines", "f_digit", "f_upper", "f_uniq"]


def h(expr: str) -> str:
    """60-bit md5 prefix as an integer (same rule as functions.hashing.hash_int)."""
    return f"CAST(('0x' || substr(md5({expr}), 1, 15)) AS UBIGINT)"


def _feat_list(prefix: str = "", alias_prefix: str = "") -> str:
    return ", ".join(f"{prefix}{f} AS {alias_prefix}{f}" for f in FEATS)


def _dist(a: str, b: str, feats=FEATS) -> str:
    terms = " + ".join(f"({a}.{f} - {b}.{f}) * ({a}.{f} - {b}.{f})" for f in feats)
    return f"round(sqrt({terms}), 9)"


TX = r"""
tx AS (
  SELECT d.doc_id AS tx_id,
    CAST(CASE WHEN l.quality IS NULL THEN 3 WHEN l.quality = 0 THEN 1 ELSE 2 END AS INTEGER) AS class,
    CAST(d.n_chars AS DOUBLE) AS f_chars,
    CAST(len(regexp_extract_all(d.text, '\S+')) AS DOUBLE) AS f_words,
    CAST(len(string_split(d.text, chr(10))) AS DOUBLE) AS f_lines,
    round((length(d.text) - length(regexp_replace(d.text, '[0-9]', '', 'g'))) / nullif(length(d.text), 0), 6) AS f_digit,
    round((length(d.text) - length(regexp_replace(d.text, '[A-Z]', '', 'g'))) / nullif(length(d.text), 0), 6) AS f_upper,
    round(len(list_distinct(regexp_extract_all(d.text, '\S+')))
          / nullif(len(regexp_extract_all(d.text, '\S+')), 0), 6) AS f_uniq
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
)"""

LABELLED = """
labelled AS (SELECT * FROM tx WHERE class IN (1, 2))"""

STATS = """
stats AS (SELECT {aggs} FROM labelled)""".format(
    aggs=", ".join(f"avg({f}) AS m_{f}, stddev_pop({f}) AS s_{f}" for f in FEATS)
)


def _scale(src: str, from_clause: str | None = None) -> str:
    cols = ", ".join(
        f"round(({src}.{f} - stats.m_{f}) / coalesce(nullif(stats.s_{f}, 0), 1), 6) AS {f}" for f in FEATS
    )
    return f"SELECT {src}.tx_id, {src}.class, {cols} FROM {from_clause or src} CROSS JOIN stats"


SCALED = f"""
scaled AS ({_scale('labelled')})"""

SPLIT = f"""
split AS (
  SELECT *, CASE WHEN {h("'42:' || CAST(tx_id AS VARCHAR)")} % 100 < 80 THEN 'test' ELSE 'train' END AS split
  FROM scaled
),
train AS (SELECT tx_id, class, {', '.join(FEATS)} FROM split WHERE split = 'train'),
test AS (SELECT tx_id, class, {', '.join(FEATS)} FROM split WHERE split = 'test')"""

SMOTE = f"""
cnt AS (SELECT class, count(*) AS n FROM train GROUP BY class),
maj AS (SELECT max(n) AS n_maj FROM cnt),
mino AS (
  SELECT c.class, c.n AS n_c, least(5, c.n - 1) AS k_c, m.n_maj - c.n AS n_syn
  FROM cnt c CROSS JOIN maj m WHERE c.n < m.n_maj AND c.n >= 2
),
mrows AS (
  SELECT t.*, row_number() OVER (PARTITION BY t.class ORDER BY t.tx_id) - 1 AS idx
  FROM train t JOIN mino USING (class)
),
mnn AS (
  SELECT a.tx_id AS base, b.tx_id AS nbr, a.class,
    row_number() OVER (PARTITION BY a.tx_id ORDER BY {_dist('a', 'b')}, b.tx_id) AS rnk
  FROM mrows a JOIN mrows b ON a.class = b.class AND a.tx_id <> b.tx_id
),
pairs AS (
  SELECT a.class, a.idx, nn.rnk, {_feat_list('a.', 'b_')}, {_feat_list('b.', 'n_')}
  FROM mnn nn JOIN mrows a ON a.tx_id = nn.base JOIN mrows b ON b.tx_id = nn.nbr
  JOIN mino ON mino.class = a.class
  WHERE nn.rnk <= mino.k_c
),
draws AS (
  SELECT mino.class, g.i,
    {h("'42:base:' || CAST(mino.class AS VARCHAR) || ':' || CAST(g.i AS VARCHAR)")} % mino.n_c AS idx,
    CAST({h("'42:nn:' || CAST(mino.class AS VARCHAR) || ':' || CAST(g.i AS VARCHAR)")} % mino.k_c + 1 AS BIGINT) AS rnk,
    ({h("'42:gap:' || CAST(mino.class AS VARCHAR) || ':' || CAST(g.i AS VARCHAR)")} % 1000000) / 1000000.0 AS u
  FROM mino CROSS JOIN LATERAL generate_series(0, mino.n_syn - 1) AS g(i)
),
synth AS (
  SELECT -(CAST(d.class AS BIGINT) * 1000000000000 + d.i + 1) AS tx_id, d.class,
    {', '.join(f'round(p.b_{f} + d.u * (p.n_{f} - p.b_{f}), 6) AS {f}' for f in FEATS)},
    true AS is_synthetic
  FROM draws d JOIN pairs p ON p.class = d.class AND p.idx = d.idx AND p.rnk = d.rnk
),
trainos AS (
  SELECT tx_id, class, {', '.join(FEATS)}, false AS is_synthetic FROM train
  UNION ALL SELECT * FROM synth
)"""


def _knn(name: str, query: str, ref: str, k: int, feats=FEATS) -> str:
    return f"""
{name} AS (
  SELECT * FROM (
    SELECT q.tx_id AS query_id, r.tx_id AS ref_id, r.class AS class, {_dist('q', 'r', feats)} AS distance,
      row_number() OVER (PARTITION BY q.tx_id ORDER BY {_dist('q', 'r', feats)}, r.tx_id) AS rank
    FROM {query} q CROSS JOIN {ref} r
  ) WHERE rank <= {k}
)"""


def _vote(name: str, nn: str, k: int) -> str:
    return f"""
{name} AS (
  SELECT query_id, class AS prediction FROM (
    SELECT query_id, class, row_number() OVER (PARTITION BY query_id ORDER BY count(*) DESC, class) AS o
    FROM {nn} WHERE rank <= {k} GROUP BY query_id, class
  ) WHERE o = 1
)"""


PREP = TX + "," + LABELLED + "," + STATS + "," + SCALED + "," + SPLIT


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def queries_sql() -> dict[str, str]:
    feats = ", ".join(FEATS)
    q: dict[str, str] = {}
    q["labelled_rows"] = with_(TX) + f"SELECT tx_id, class, {feats} FROM tx WHERE class IN (1, 2)"
    q["class_balance"] = with_(TX) + "SELECT class, count(*) AS n FROM tx GROUP BY class"
    q["label_shift"] = with_(TX) + (
        "SELECT tx_id, class, CAST(class - 1 AS INTEGER) AS label, "
        "[CAST(class - 1 = 0 AS INTEGER), CAST(class - 1 = 1 AS INTEGER)] AS one_hot "
        "FROM tx WHERE class IN (1, 2)"
    )
    q["preview"] = with_(TX) + f"SELECT tx_id, class, {feats} FROM tx ORDER BY tx_id LIMIT 5"
    q["scaler_stats"] = with_(TX, LABELLED) + " UNION ALL ".join(
        f"SELECT '{f}' AS feature, round(avg({f}), 9) AS mean, round(stddev_pop({f}), 9) AS std FROM labelled"
        for f in FEATS
    )
    q["scaled_features"] = with_(PREP) + f"SELECT tx_id, class, {feats} FROM scaled"
    q["hash_split"] = with_(PREP) + "SELECT tx_id, class, split FROM split"
    q["exact_split"] = with_(TX) + (
        f"SELECT tx_id, class, CASE WHEN row_number() OVER (ORDER BY {h("'42:' || CAST(tx_id AS VARCHAR)")}, tx_id) "
        "<= ceil(round(0.8 * count(*) OVER (), 6)) THEN 'test' ELSE 'train' END AS split FROM tx WHERE class IN (1, 2)"
    )
    q["exact_split_events"] = (
        "SELECT split, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM (SELECT event_id, CASE WHEN row_number() OVER ("
        f"ORDER BY {h("'50000:' || CAST(event_id AS VARCHAR)")}, event_id) <= ceil(round(0.7 * count(*) OVER (), 6)) "
        "THEN 'test' ELSE 'train' END AS split FROM events) GROUP BY split"
    )
    q["separated_xy"] = with_(TX) + " UNION ALL ".join(
        f"SELECT tx_id, CAST(class - 1 AS INTEGER) AS label, {i} AS position, {f} AS value FROM tx WHERE class IN (1, 2)" for i, f in enumerate(FEATS)
    )
    q["boosted_stump"] = with_(TX).rstrip() + """,
x AS (SELECT tx_id, class - 1 AS y, floor(coalesce(f_uniq, 0) * 20) AS x0, floor(coalesce(f_digit, 0) * 200) AS x1 FROM tx WHERE class IN (1, 2)),
long AS (SELECT 0 AS f, x0 AS v, y FROM x UNION ALL SELECT 1, x1, y FROM x),
cells AS (SELECT f, v, sum(0.5 - y)::DOUBLE AS g, count(*) * 0.25::DOUBLE AS h FROM long GROUP BY f, v),
cuts AS (SELECT f, v, sum(g) OVER w AS lg, sum(h) OVER w AS lh, sum(g) OVER (PARTITION BY f) AS g, sum(h) OVER (PARTITION BY f) AS h FROM cells WINDOW w AS (PARTITION BY f ORDER BY v)),
best AS (SELECT * FROM (SELECT *, lg * lg / (lh + 1) + (g - lg) * (g - lg) / (h - lh + 1) - g * g / (h + 1) AS gain FROM cuts WHERE lh >= 1 AND h - lh >= 1)
  WHERE gain > 1e-6 ORDER BY gain DESC, f, v LIMIT 1),
tot AS (SELECT sum(0.5 - y)::DOUBLE AS g, count(*) * 0.25::DOUBLE AS h FROM x),
m AS (SELECT tx_id, CASE WHEN best.f IS NULL THEN -0.3 * tot.g / (tot.h + 1) WHEN (CASE best.f WHEN 0 THEN x0 ELSE x1 END) <= best.v THEN -0.3 * lg / (lh + 1)
  ELSE -0.3 * (best.g - lg) / (best.h - lh + 1) END AS m FROM x CROSS JOIN tot LEFT JOIN best ON true)
SELECT tx_id, round(1 / (1 + exp(-m)), 6) AS p, CAST(m > 0 AS INTEGER) AS prediction FROM m"""
    values = " UNION ALL ".join(f"SELECT tx_id, {i} AS f, coalesce({f}, 0) AS v, class - 1 AS y, w FROM x" for i, f in enumerate(FEATS))
    cuts = """,
long AS ({values}),
cells AS (SELECT f, v, sum(w) AS c, sum(w * y) AS c1 FROM long GROUP BY f, v),
run AS (SELECT f, v, lead(v) OVER o AS nx, (sum(c) OVER o)::DOUBLE AS ln, (sum(c1) OVER o)::DOUBLE AS l1, (sum(c) OVER (PARTITION BY f))::DOUBLE AS n,
  (sum(c1) OVER (PARTITION BY f))::DOUBLE AS n1 FROM cells WINDOW o AS (PARTITION BY f ORDER BY v)),
sides AS (SELECT *, ln - l1 AS l0, n1 - l1 AS r1, (n - ln) - (n1 - l1) AS r0, n - ln AS rn FROM run WHERE nx IS NOT NULL),
cut AS (SELECT *, (l0 * l0 + l1 * l1) / ln + (r0 * r0 + r1 * r1) / rn AS score, CASE WHEN v / 2 + nx / 2 < nx THEN v / 2 + nx / 2 ELSE v END AS threshold FROM sides
  QUALIFY row_number() OVER (PARTITION BY f ORDER BY score DESC, v) = 1)""".replace("{values}", values)
    q["exact_split_points"] = with_(TX).rstrip() + ", x AS (SELECT *, 1 AS w FROM tx WHERE class IN (1, 2))" + cuts + """
SELECT CAST(f AS INTEGER) AS f, round(score, 6) AS score, round(threshold, 9) AS threshold, CAST(ln AS BIGINT) AS n_left, CAST(l1 AS BIGINT) AS n1_left,
  CAST(n AS BIGINT) AS n, CAST(n1 AS BIGINT) AS n1, row_number() OVER (ORDER BY score DESC, f) = 1 AS taken FROM cut"""
    # a row weighs as many of Poisson(1)'s cumulative shares of 2^32 as its draw reaches
    shares, term, total = [], math.exp(-1), 0.0
    for k in range(13):
        total += term
        term /= k + 1
        shares.append(int(total * 2**32))
    drawn = "CAST(('0x' || substr(md5('42:weight:0:' || tx_id), 1, 8)) AS UBIGINT)"
    worth = " + ".join(f"CAST({drawn} >= {s} AS INTEGER)" for s in shares if s < 2**32)
    sample = f", every AS (SELECT * FROM tx WHERE class IN (1, 2)), x AS (SELECT * FROM (SELECT *, {worth} AS w FROM every) WHERE w > 0)"
    q["forest_votes"] = with_(TX).rstrip() + sample + cuts + """,
offered AS (SELECT * FROM cut QUALIFY row_number() OVER (ORDER BY md5('42:draw:0::' || f), f) <= 2),
best AS (SELECT * FROM offered ORDER BY score DESC, f LIMIT 1),
told AS (SELECT tx_id, (CASE best.f """ + " ".join(f"WHEN {i} THEN coalesce({f}, 0)" for i, f in enumerate(FEATS)) + """ END) <= best.threshold AS goes_left, best.* FROM every, best),
leaf AS (SELECT tx_id, round((CASE WHEN goes_left THEN l1 / ln ELSE r1 / rn END) * 1048576) / 1048576 AS p FROM told)
SELECT tx_id, round(p, 5) AS p, CAST(p > 0.5 AS INTEGER) + 1 AS prediction FROM leaf"""
    q["smote_rows"] = with_(PREP, SMOTE) + f"SELECT tx_id, class, {feats}, is_synthetic FROM synth"
    q["smote_union"] = with_(PREP, SMOTE) + (
        "SELECT class, count(*) AS n, CAST(sum(CAST(is_synthetic AS INTEGER)) AS BIGINT) AS n_synthetic "
        "FROM trainos GROUP BY class"
    )
    q["knn_neighbours"] = with_(PREP, SMOTE, _knn("nn", "test", "trainos", 5)) + (
        "SELECT query_id, ref_id, CAST(rank AS INTEGER) AS rank, distance, class FROM nn"
    )
    acc_parts = []
    for k in (1, 3, 5):
        acc_parts.append(
            f"SELECT 'knn_k{k}' AS model, {k} AS k, avg(CAST(v.prediction = t.class AS DOUBLE)) AS accuracy, "
            f"count(*) AS n_test FROM vote{k} v JOIN test t ON t.tx_id = v.query_id"
        )
    votes = [_vote(f"vote{k}", "nn", k) for k in (1, 3, 5)]
    q["knn_accuracy"] = with_(PREP, SMOTE, _knn("nn", "test", "trainos", 5), *votes) + " UNION ALL ".join(acc_parts)
    q["best_model"] = (
        with_(PREP, SMOTE, _knn("nn", "test", "trainos", 5), *votes)
        + "SELECT model, k, accuracy, n_test, ordinal FROM ("
        + " UNION ALL ".join(
            f"SELECT * , {i} AS ordinal FROM ({p})" for i, p in enumerate(acc_parts)
        )
        + ") ORDER BY accuracy DESC, ordinal LIMIT 1"
    )
    score = f"""
toscore AS ({_scale('s', '(SELECT * FROM tx WHERE class = 3) s')})"""
    q["score_histogram"] = with_(PREP, SMOTE, score, _knn("snn", "toscore", "trainos", 5), _vote("svote", "snn", 5)) + (
        "SELECT prediction, count(*) AS n, CASE WHEN prediction = 1 THEN 'Licit' ELSE 'Illicit' END AS prediction_label "
        "FROM svote GROUP BY prediction"
    )
    subset = ["f_chars", "f_digit", "f_uniq"]
    q["save_load_score"] = with_(PREP, SMOTE, score, _knn("snn", "toscore", "trainos", 5, subset), _vote("svote", "snn", 5)) + (
        "SELECT query_id AS tx_id, CAST(3 AS INTEGER) AS class, CAST(prediction AS INTEGER) AS fraud_prediction FROM svote"
    )
    q["stream_score"] = q["save_load_score"]
    q["metrics_published"] = with_(PREP, SMOTE, _knn("nn", "test", "trainos", 5), *votes) + " UNION ALL ".join(
        f"SELECT *, '{run}' AS run_id FROM ({acc_parts[i]})" for i, run in ((0, "run-1"), (1, "run-1"), (2, "run-2"))
    )
    q["lasso_single"] = lasso_single_sql()
    q["selected_of_total"] = f"SELECT CAST(sum(CAST(selected AS INTEGER)) AS BIGINT) AS n_selected, count(*) AS n_total FROM ({lasso_single_sql()})"
    q.update(ops_sql())
    q.update(ml_sql())
    q.update(io_sql())
    q["gzip_log_alerts"] = q["log_alerts"]
    q.update(stream_sql(q))
    return q


def lasso_single_sql() -> str:
    """The L1 problem of one feature has the closed form w = S(c, a) / G with
    the soft threshold S; the penalty is the one of least mean held-out
    squared error over five folds, of 100 from |c| down to |c| / 1000."""
    fold = f"{h(chr(39) + '42:fold:' + chr(39) + ' || CAST(tx_id AS VARCHAR)')} % 5"
    sums = "count(*)::DOUBLE AS n, sum(x) AS sx, sum(y) AS sy, sum(x * x) AS sxx, sum(x * y) AS sxy, sum(y * y) AS syy"
    rows = " UNION ALL ".join(f"SELECT '{f}' AS feature, {fold} AS fold, {f} AS x, CAST(class AS DOUBLE) AS y FROM trainos" for f in FEATS)
    soft = "sign({c}) * greatest(abs({c}) - {a}, 0) / nullif({g}, 0)"
    return with_(PREP, SMOTE).rstrip() + f""", xy AS ({rows}),
held AS (SELECT feature, fold, {sums} FROM xy GROUP BY ALL),
tot AS (SELECT feature, {sums} FROM xy GROUP BY ALL),
whole AS (SELECT feature, sxx / n - (sx / n) * (sx / n) AS g, sxy / n - (sx / n) * (sy / n) AS c FROM tot),
grid AS (SELECT feature, g, c, i, pow(10, log10(abs(c)) + (log10(abs(c) * 0.001) - log10(abs(c))) * i / 99) AS a
  FROM whole, generate_series(0, 99) AS s(i) WHERE abs(c) > 0),
rest AS (SELECT h.*, (t.sx - h.sx) / (t.n - h.n) AS mx, (t.sy - h.sy) / (t.n - h.n) AS my, (t.sxx - h.sxx) / (t.n - h.n) AS mxx,
  (t.sxy - h.sxy) / (t.n - h.n) AS mxy FROM held h JOIN tot t USING (feature)),
fit AS (SELECT r.*, i, a, {soft.format(c='(mxy - mx * my)', a='a', g='(mxx - mx * mx)')} AS w FROM rest r JOIN grid USING (feature)),
err AS (SELECT feature, i, a, avg((syy - 2 * b * sy - 2 * w * sxy + n * b * b + 2 * b * w * sx + w * w * sxx) / n) AS mse
  FROM (SELECT *, my - mx * w AS b FROM fit) GROUP BY ALL),
best AS (SELECT feature, arg_min(a, (mse, i)) AS a FROM err GROUP BY 1)
SELECT w.feature, round(coalesce(a, 0), 6) AS alpha, round(coalesce({soft.format(c='c', a='a', g='g')}, 0), 6) + 0.0 AS coefficient,
  coalesce(abs({soft.format(c='c', a='a', g='g')}) > 1e-9, false) AS selected FROM whole w LEFT JOIN best USING (feature)"""


# ====================================================================== ops
TSF = "'%Y-%m-%d %H:%M:%S.%f'"
KL = "timezone('Asia/Kuala_Lumpur', ts AT TIME ZONE 'UTC')"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


LOGLINES = r"""
loglines AS (
  SELECT strftime(ts, '%Y-%m-%d') AS log_id, event_id AS line_no,
    CASE WHEN event_type = 'error' AND event_id % 3 = 0 THEN 'Traceback (most recent call last):'
         WHEN event_type = 'error' THEN 'ValueError: bad record for user ' || CAST(user_id AS VARCHAR)
         WHEN event_type = 'view' THEN '  File "job.py", line ' || CAST(user_id AS VARCHAR) || ', in step'
         WHEN event_type = 'signup' THEN 'INFO py4j.clientserver: Closing down clientserver connection'
         ELSE 'INFO step ' || CAST(event_id AS VARCHAR) || ' ' || event_type END AS line
  FROM events
)"""

LOGSCAN = (
    r"""
t0 AS (
  SELECT log_id, min(line_no) AS t FROM loglines
  WHERE regexp_matches(line, '^Traceback \(most recent call last\):') GROUP BY log_id
),
e0 AS (
  SELECT l.log_id, min(t0.t) AS trace_line_no, min(l.line_no) AS error_line_no
  FROM loglines l JOIN t0 ON l.log_id = t0.log_id
  WHERE l.line_no > t0.t AND regexp_matches(l.line, '^(\w+):(.*)') GROUP BY l.log_id
),
heads AS (
  SELECT e0.log_id, e0.trace_line_no, e0.error_line_no,
    """
    + _strip(r"regexp_extract(l.line, '^(\w+):(.*)', 1)")
    + r""" AS exception_name,
    """
    + _strip(r"regexp_extract(l.line, '^(\w+):(.*)', 2)")
    + r""" AS exception_head
  FROM e0 JOIN loglines l ON l.log_id = e0.log_id AND l.line_no = e0.error_line_no
),
tail AS (
  SELECT l.log_id, l.line_no AS part_no, """
    + _strip("l.line")
    + r""" AS part
  FROM loglines l JOIN heads h ON l.log_id = h.log_id
  WHERE l.line_no > h.error_line_no AND regexp_matches(l.line, '^[^\t ]')
    AND NOT regexp_matches(l.line, 'py4j\.clientserver.*?Closing down clientserver connection')
)"""
)

INV = f"""
inv AS (
  SELECT event_type || '/' || CAST(user_id AS VARCHAR) || '/' || CAST(event_id AS VARCHAR) AS path,
    CAST(event_id AS VARCHAR) AS name, ts AS mtime, strftime({KL}, '%Y-%m-%d') AS partition
  FROM events
)"""

ITEMS = """
items AS (
  SELECT o_orderpriority AS pk, o_orderkey AS seq,
    CASE WHEN o_orderstatus = 'P' THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END AS min_ts,
    CASE WHEN o_orderstatus = 'P' THEN '' ELSE strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%dT%H:%M:%S') END AS max_ts,
    CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS custkey,
    CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) AS totalprice,
    o_orderstatus AS status
  FROM orders
)"""

STMTS = """
stmts AS (
  SELECT event_id AS stmt_id,
    CASE event_id % 5
      WHEN 0 THEN 'SELECT COUNT(*) FROM ' || event_type || ' WHERE user_id = ' || CAST(user_id AS VARCHAR)
      WHEN 1 THEN 'select e.* from ' || event_type || ' e join users u on e.user_id = u.id'
      WHEN 2 THEN 'DELETE FROM ' || event_type || ' WHERE event_id = ' || CAST(event_id AS VARCHAR)
      WHEN 3 THEN '  drop table ' || event_type || '_archive;'
      ELSE 'ALTER TABLE ' || event_type || ' ADD COLUMN c' || CAST(user_id AS VARCHAR) || ' INT' END AS query
  FROM events
)"""

TABLE_RE = r"'(?i)\b(?:FROM|JOIN)\s+([^\s;]+)'"

BOUNDS = """
bounds AS (SELECT date_trunc('hour', min(ts)) AS s, date_trunc('hour', max(ts)) AS e FROM events)"""


def _slots(name: str, hours: int, fmt: str) -> str:
    return f"""
{name} AS (
  SELECT CAST(g.i AS VARCHAR) AS idx, strftime(b.s + to_hours(CAST(g.i * {hours} AS BIGINT)), '{fmt}') AS slot,
    b.s + to_hours(CAST(g.i * {hours} AS BIGINT)) AS slot_ts
  FROM bounds b CROSS JOIN LATERAL generate_series(0,
    CAST(trunc((epoch(b.e) - epoch(b.s)) / {hours * 3600}.0) AS BIGINT)) AS g(i)
)"""


PERSONAL = """
personal AS (
  SELECT CAST(c_custkey AS VARCHAR) AS uuid, c_name AS name, c_mktsegment AS nric, '2024-01-01' AS date,
    lpad(CAST(c_custkey AS VARCHAR), 16, '0') AS cardnum
  FROM customer
)"""


def _clean(c: str) -> str:
    return f"replace(coalesce({c}, ''), chr(10), '')"


def ops_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["log_exceptions"] = with_(LOGLINES, LOGSCAN) + (
        "SELECT log_id, exception_name, CAST(-1 AS BIGINT) AS part_no, exception_head AS part FROM heads "
        "UNION ALL SELECT t.log_id, h.exception_name, t.part_no, t.part FROM tail t JOIN heads h ON t.log_id = h.log_id"
    )
    full = _strip("concat_ws(' ', h.exception_head, (SELECT string_agg(t.part, ' ' ORDER BY t.part_no) "
                  "FROM tail t WHERE t.log_id = h.log_id))")
    q["log_alerts"] = with_(LOGLINES, LOGSCAN) + (
        f"SELECT log_id, alias, CASE WHEN length(m) > 300 THEN substr(m, 1, 300) || '... truncated ...' ELSE m END AS message, "
        "'P3' AS priority, ['airflow.data'] AS tags FROM ("
        f"SELECT h.log_id, h.exception_name AS alias, {full} AS m FROM heads h)"
    )
    q["latest_object"] = with_(INV) + (
        f"SELECT partition, n_objects, strftime(latest_mtime, {TSF}) AS latest_mtime, latest_path FROM ("
        "SELECT partition, count(*) OVER (PARTITION BY partition) AS n_objects, mtime AS latest_mtime, path AS latest_path, "
        "row_number() OVER (PARTITION BY partition ORDER BY mtime DESC, path) AS r FROM inv) WHERE r = 1"
    )
    q["input_settled"] = with_(INV) + (
        "SELECT coalesce(a.partition, m.partition) AS partition, coalesce(a.n, 0) AS n_objects, "
        f"strftime(a.latest, {TSF}) AS latest_mtime, strftime(m.stored_mark, {TSF}) AS stored_mark, "
        "coalesce(a.n > 0 AND m.stored_mark IS NOT NULL AND a.latest <= m.stored_mark, false) AS settled, "
        "strftime(CASE WHEN coalesce(a.n > 0 AND m.stored_mark IS NOT NULL AND a.latest <= m.stored_mark, false) "
        f"THEN m.stored_mark WHEN coalesce(a.n, 0) > 0 THEN a.latest ELSE m.stored_mark END, {TSF}) AS new_mark "
        "FROM (SELECT partition, count(*) AS n, max(mtime) AS latest FROM inv GROUP BY partition) a "
        "FULL OUTER JOIN (SELECT partition, max(mtime) AS stored_mark FROM inv "
        "WHERE mtime <= TIMESTAMP '2024-01-20 12:00:00' GROUP BY partition) m ON a.partition = m.partition"
    )
    q["settled_marks"] = f"SELECT partition, new_mark AS mark FROM ({q['input_settled']})"
    q["retention_report"] = with_(INV) + (
        "SELECT path, age_days FROM (SELECT path, string_split(path, '/') AS parts, "
        "CAST(floor((epoch_us(TIMESTAMP '2024-02-15 00:00:00') - epoch_us(mtime)) / 86400000000) AS BIGINT) AS age_days "
        "FROM inv) WHERE age_days > 30 AND NOT list_has_any(list_slice(parts, 1, len(parts) - 1), ['signup'])"
    )
    q["name_filters"] = with_(INV) + (
        "SELECT path, name, NOT starts_with(name, '.') AS visible, starts_with(name, '1') AS has_prefix, "
        "contains(name, '7') AS has_substring FROM inv"
    )
    usable = "min_ts IS NOT NULL AND min_ts <> '' AND max_ts IS NOT NULL AND max_ts <> ''"
    q["state_range"] = with_(ITEMS) + (
        f"SELECT pk, min(CASE WHEN {usable} THEN min_ts END) AS min_ts, "
        f"max(CASE WHEN {usable} THEN max_ts END) AS max_ts FROM items GROUP BY pk"
    )
    q["state_key_range"] = with_(ITEMS) + (
        f"SELECT pk, min(CASE WHEN {usable} THEN min_ts END) AS min_ts, "
        f"max(CASE WHEN {usable} THEN max_ts END) AS max_ts FROM items WHERE pk = '2-HIGH' GROUP BY pk"
    )
    q["state_attributes"] = with_(ITEMS) + " UNION ALL ".join(
        f"SELECT pk, '{a}' AS attribute, arg_max({a}, seq) AS value FROM items WHERE {a} IS NOT NULL GROUP BY pk"
        for a in ("custkey", "totalprice", "status")
    )
    q["state_remainder"] = with_(ITEMS) + "SELECT * FROM items WHERE pk IS NULL OR pk NOT IN ('1-URGENT', '3-MEDIUM')"
    q["reconcile_counts"] = (
        "WITH src AS (SELECT date_trunc('hour', ts) AS slot, count(*) AS source_count FROM events GROUP BY 1), "
        f"lk AS (SELECT date_trunc('hour', ts) AS slot, count(*) AS lake_count FROM events "
        f"WHERE {h('CAST(event_id AS VARCHAR)')} % 10 <> 0 GROUP BY 1) "
        f"SELECT strftime(coalesce(s.slot, l.slot), {TSF}) AS slot, coalesce(s.source_count, 0) AS source_count, "
        "coalesce(l.lake_count, 0) AS lake_count, CASE WHEN coalesce(s.source_count, 0) = coalesce(l.lake_count, 0) "
        "THEN 'match' WHEN coalesce(l.lake_count, 0) = 0 THEN 'missing' ELSE 'mismatch' END AS status "
        "FROM src s FULL OUTER JOIN lk l ON s.slot = l.slot"
    )
    q["query_lineage"] = with_(STMTS) + (
        f"SELECT table_name, count(*) AS n_statements FROM (SELECT unnest(regexp_extract_all(query, {TABLE_RE}, 1)) "
        "AS table_name FROM stmts) GROUP BY table_name"
    )
    q["unsafe_statements"] = with_(STMTS) + (
        "SELECT stmt_id, regexp_matches(query, '(?i)(drop|delete)') AS has_drop_delete, "
        "regexp_matches(query, '(?i)^\\s*\\b(drop|alter)\\b') AS leading_drop_alter, "
        "regexp_replace(query, 'COUNT\\(\\*\\)', '*', 'g') AS rewritten, "
        f"CAST(len(regexp_extract_all(query, {TABLE_RE}, 1)) AS BIGINT) AS n_tables FROM stmts"
    )
    q["lake_count_scalar"] = "SELECT count(*) AS n FROM events WHERE event_type = 'error'"
    q["time_slots"] = with_(BOUNDS, _slots("slots", 1, "year-%Y_month-%m_day-%d_hour-%H")) + "SELECT idx, slot FROM slots"
    q["time_slots_6h"] = with_(BOUNDS, _slots("slots", 6, "%Y-%m-%d %H:00")) + "SELECT idx, slot FROM slots"
    q["slot_coverage"] = with_(BOUNDS, _slots("slots", 1, "year-%Y_month-%m_day-%d_hour-%H")) + (
        "SELECT s.idx, s.slot, coalesce(c.n, 0) AS n_events FROM slots s LEFT JOIN "
        "(SELECT date_trunc('hour', ts) AS slot_ts, count(*) AS n FROM events GROUP BY 1) c "
        "ON s.slot_ts = c.slot_ts"
    )
    q["slot_coverage_6h"] = with_(BOUNDS, _slots("slots", 6, "%Y-%m-%d %H:00")) + (
        "SELECT s.idx, s.slot, CAST(coalesce(sum(c.n), 0) AS BIGINT) AS n_events FROM slots s LEFT JOIN "
        "(SELECT date_trunc('hour', ts) AS hour_ts, count(*) AS n FROM events GROUP BY 1) c "
        "ON c.hour_ts >= s.slot_ts AND c.hour_ts < s.slot_ts + INTERVAL 6 HOUR GROUP BY s.idx, s.slot"
    )
    q["local_time"] = (
        f"SELECT event_id, strftime({KL}, {TSF}) AS local_ts, strftime(ts - INTERVAL 3 HOUR, {TSF}) AS shifted, "
        f"strftime({KL} - INTERVAL 2 DAY, {TSF}) AS run_date FROM events"
    )
    d = f"({KL} - INTERVAL 1 DAY)"
    q["date_parts"] = (
        f"SELECT event_id, strftime({d}, '%Y-%m-%d') AS current, lower(strftime({d}, '%b')) AS m_str, "
        f"strftime({d}, '%m') AS m_int, strftime({d}, '%d') AS day, strftime({d}, '%H') AS hour, "
        f"strftime({d}, '%M') AS minute, lpad(CAST(CAST(floor(minute(ts) / 15) AS BIGINT) AS VARCHAR), 2, '0') AS quarter "
        "FROM events"
    )
    cur = "date_trunc('hour', ts)"
    prev = "(date_trunc('hour', ts) - INTERVAL 1 HOUR)"
    q["hour_window"] = (
        f"SELECT event_id, strftime({cur}, '%Y-%m-%dT%H:%M:%S') || '.000' AS formatted_date, "
        f"strftime({prev}, '%Y-%m-%dT%H:%M:%S') || '.000' AS previous_hour, "
        f"strftime({cur}, '%Y-%m-%d %H:%M:%S.%f') AS sql_formatted_date, "
        f"strftime({prev}, '%Y-%m-%d %H:%M:%S.%f') AS sql_previous_hour FROM events"
    )
    pd_ = f"(CAST({KL} AS DATE) + INTERVAL 1 DAY)"
    q["partition_date"] = (
        f"SELECT event_id, strftime({pd_}, '%Y') AS year, strftime({pd_}, '%m') AS month, "
        f"strftime({pd_}, '%d') AS day FROM events"
    )
    p = "('type=' || event_type || '/user=' || CAST(user_id AS VARCHAR))"
    q["path_codec"] = (
        f"SELECT event_id, translate({p}, '=/', '-_') AS encoded, "
        f"translate(translate({p}, '=/', '-_'), '-_', '=/') AS decoded FROM events"
    )
    salt = "'riskloom-demo-salt'"
    q["tokenize_hash"] = with_(PERSONAL) + (
        f"SELECT {_clean('uuid')} AS uuid, sha256({salt} || {_clean('name')}) AS name, "
        f"sha256({salt} || {_clean('nric')}) AS nric, {_clean('date')} AS date, "
        f"sha256({salt} || {_clean('cardnum')}) AS cardnum FROM personal"
    )
    names = ["uuid", "name", "nric", "date", "cardnum", "name_enc", "nric_enc", "cardnum_enc", "aws_enc_ctx"]
    q["tokenize_header"] = " UNION ALL ".join(f"SELECT {i} AS position, '{c}' AS name, count(*) AS n_right FROM customer" for i, c in enumerate(names))
    q["probability_codes"] = "SELECT c_custkey, CAST(CASE WHEN c_custkey % 101 > 50 THEN 2 ELSE 1 END AS INTEGER) AS code FROM customer"
    taken = "pk IN ('1-URGENT', '3-MEDIUM')"
    q["consume_range"] = (
        f"SELECT *, CAST(0 AS BIGINT) AS n_left FROM ({q['state_range']}) WHERE {taken} UNION ALL "
        f"SELECT pk, NULL, NULL, count(*) FROM ({with_(ITEMS)} SELECT * FROM items) WHERE pk IS NULL OR NOT {taken} GROUP BY pk"
    )
    q["consume_attributes"] = (
        f"SELECT * FROM ({q['state_attributes']}) WHERE {taken} UNION ALL "
        f"SELECT pk, 'n_left', CAST(count(*) AS VARCHAR) FROM ({with_(ITEMS)} SELECT * FROM items) WHERE pk IS NULL OR NOT {taken} GROUP BY pk"
    )
    q["tokenize_roundtrip"] = with_(PERSONAL) + (
        f"SELECT {_clean('uuid')} AS uuid, {_clean('name')} AS name_dec, {_clean('nric')} AS nric_dec, "
        f"{_clean('cardnum')} AS cardnum_dec FROM personal"
    )
    return q


def ml_sql() -> dict[str, str]:
    sums = ["count(*) AS n", "round(sum(CAST(class AS DOUBLE)), 6) AS s_y", "round(sum(CAST(class AS DOUBLE) * class), 6) AS s_yy"]
    for i, a in enumerate(FEATS):
        sums.append(f"round(sum({a}), 6) AS s_{a}")
        sums.append(f"round(sum({a} * CAST(class AS DOUBLE)), 6) AS s_{a}__y")
        for b in FEATS[i:]:
            sums.append(f"round(sum({a} * {b}), 6) AS s_{a}__{b}")
    fold = f"CAST({h(chr(39) + '42:fold:' + chr(39) + ' || CAST(tx_id AS VARCHAR)')} % 5 AS INTEGER)"
    dims = [f"e{j}" for j in range(64)]
    vfold = f"CAST({h(chr(39) + '42:fold:' + chr(39) + ' || CAST(vec_id AS VARCHAR)')} % 5 AS INTEGER)"
    vcols = ", ".join(f"CAST(embedding[{j + 1}] AS DOUBLE) AS {d}" for j, d in enumerate(dims))
    wide = ["CAST(count(*) AS DOUBLE) AS n", "sum(y) AS s_y", "sum(y * y) AS s_yy"]
    wide += [f"sum({d}) AS s_{d}" for d in dims] + [f"sum({d} * y) AS s_{d}__y" for d in dims]
    wide += [f"sum({a} * {b}) AS s_{a}__{b}" for i, a in enumerate(dims) for b in dims[i:]]
    return {
        "gram_by_fold": with_(PREP, SMOTE) + f"SELECT {fold} AS fold, {', '.join(sums)} FROM trainos GROUP BY 1",
        "gram_vectors": (
            f"WITH v AS (SELECT CAST(label % 2 + 1 AS DOUBLE) AS y, {vcols}, {vfold} AS fold FROM embeddings), "
            f"w AS (SELECT fold, {', '.join(wide)} FROM v GROUP BY fold), "
            "u AS (UNPIVOT w ON COLUMNS(* EXCLUDE (fold)) INTO NAME stat VALUE value) "
            "SELECT fold, stat, round(value, 6) AS value FROM u"
        ),
    }


def io_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    feats = ", ".join(FEATS)
    q["csv_roundtrip"] = with_(TX) + f"SELECT tx_id, class, {feats} FROM tx"
    q["string_frame"] = (
        "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, "
        "CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment FROM customer"
    )
    pdate = f"(CAST({KL} AS DATE) + INTERVAL 1 DAY)"
    parts = f"strftime({pdate}, '%Y') AS year, strftime({pdate}, '%m') AS month, strftime({pdate}, '%d') AS day"
    q["partition_scan"] = (
        f"SELECT * FROM (SELECT event_id, event_type, value, {parts} FROM events) "
        "WHERE year = '2024' AND month = '01' AND day = '10'"
    )
    q["dynamic_overwrite"] = (
        f"SELECT event_id, CASE WHEN partition <= '2024-01-05' THEN value * 2 ELSE value END AS value, partition "
        f"FROM (SELECT event_id, value, strftime({pdate}, '%Y-%m-%d') AS partition FROM events)"
    )
    q["gzip_lines"] = with_(LOGLINES) + (
        "SELECT log_id, row_number() OVER (PARTITION BY log_id ORDER BY line_no) - 1 AS line_no, line FROM loglines"
    )
    q["csv_splits"] = (
        "SELECT event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids, round(sum(value), 4) AS total_value, "
        "CAST(sum(length(props)) AS BIGINT) AS props_length FROM events GROUP BY event_type"
    )
    q["listed_files"] = with_(LOGLINES) + "SELECT log_id, CAST(sum(strlen(line) + 1) AS BIGINT) AS bytes, true AS fresh FROM loglines GROUP BY log_id"
    q["file_inventory"] = "SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS log_id, true AS listed FROM events"
    q["catalog_table"] = "SELECT event_type, count(*) AS n, round(sum(value), 6) AS total_value FROM events GROUP BY event_type"
    vdist = "round(list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 9)"
    q["knn_vectors"] = (
        "SELECT query_id, ref_id, CAST(rank AS INTEGER) AS rank, distance, class FROM ("
        f"SELECT a.vec_id AS query_id, b.vec_id AS ref_id, {vdist} AS distance, CAST(b.label % 2 + 1 AS INTEGER) AS class, "
        f"row_number() OVER (PARTITION BY a.vec_id ORDER BY {vdist}, b.vec_id) AS rank "
        "FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id) WHERE rank <= 5"
    )
    split = f"CASE WHEN {h(chr(39) + '42:' + chr(39) + ' || CAST(vec_id AS VARCHAR)')} % 100 < 80 THEN 'test' ELSE 'train' END"
    q["knn_vectors_accuracy"] = (
        f"WITH v AS (SELECT vec_id, embedding, CAST(label % 2 + 1 AS INTEGER) AS class, {split} AS split FROM embeddings), "
        f"nn AS (SELECT a.vec_id AS qid, a.class AS truth, b.class AS c, row_number() OVER (PARTITION BY a.vec_id "
        f"ORDER BY {vdist}, b.vec_id) AS rnk FROM v a JOIN v b ON a.split = 'test' AND b.split = 'train'), "
        "votes AS (SELECT qid, truth, c, row_number() OVER (PARTITION BY qid ORDER BY count(*) DESC, c) AS o "
        "FROM nn WHERE rnk <= 5 GROUP BY qid, truth, c) "
        "SELECT avg(CAST(c = truth AS DOUBLE)) AS accuracy, count(*) AS n_test FROM votes WHERE o = 1"
    )
    return q


def stream_sql(q: dict[str, str]) -> dict[str, str]:
    return {
        "stream_buckets": (
            f"SELECT strftime(date_trunc('hour', ts), {TSF}) AS slot, count(*) AS n_events, "
            "round(sum(value), 6) AS total_value FROM events GROUP BY 1"
        ),
        "stream_quarter_buckets": (
            f"SELECT strftime(date_trunc('hour', ts) + to_minutes(CAST(floor(minute(ts) / 15) * 15 AS BIGINT)), {TSF}) "
            "AS slot, count(*) AS n_events, round(sum(value), 6) AS total_value FROM events GROUP BY 1"
        ),
        "stream_settled": pokes_sql(6),
        "stream_logscan": q["log_alerts"],
    }


def pokes_sql(passes: int) -> str:
    """The settled check replayed poke by poke: objects arrive in passes of
    equal time, and each poke compares with the mark that the last one left."""
    return with_("RECURSIVE " + INV.strip()).rstrip() + f""",
span AS (SELECT min(mtime) AS lo, CAST(round_even((epoch_us(max(mtime)) - epoch_us(min(mtime))) / {passes}.0, 0) AS BIGINT) AS step FROM inv),
arrived AS (SELECT inv.*, CASE WHEN step = 0 THEN {passes - 1} ELSE least({passes - 1}, (epoch_us(mtime) - epoch_us(lo)) // step) END AS pass FROM inv, span),
start AS (SELECT partition, max(mtime) AS mark FROM inv WHERE mtime <= TIMESTAMP '2024-01-20 12:00:00' GROUP BY 1),
known AS (SELECT partition, min(pass) AS since FROM (SELECT partition, pass FROM arrived UNION ALL SELECT partition, 0 FROM start) GROUP BY 1),
listed AS (
  SELECT k.partition, p.pass, count(a.path) AS n, max(a.mtime) AS latest, arg_min(a.path, (-epoch_us(a.mtime), a.path)) AS path
  FROM known k JOIN range(0, {passes}) AS p(pass) ON p.pass >= k.since LEFT JOIN arrived a ON a.partition = k.partition AND a.pass <= p.pass GROUP BY 1, 2),
pokes AS (
  SELECT l.partition, l.pass, l.n, l.latest, l.path, s.mark AS stored, coalesce(l.n > 0 AND l.latest <= s.mark, false) AS settled,
    CASE WHEN l.n > 0 AND NOT coalesce(l.latest <= s.mark, false) THEN l.latest ELSE s.mark END AS mark
  FROM listed l JOIN known k ON k.partition = l.partition AND k.since = l.pass LEFT JOIN start s ON s.partition = l.partition
  UNION ALL
  SELECT l.partition, l.pass, l.n, l.latest, l.path, p.mark, coalesce(l.n > 0 AND l.latest <= p.mark, false),
    CASE WHEN l.n > 0 AND NOT coalesce(l.latest <= p.mark, false) THEN l.latest ELSE p.mark END
  FROM pokes p JOIN listed l ON l.partition = p.partition AND l.pass = p.pass + 1)
SELECT pass, partition, n AS n_objects, path AS latest_path, strftime(latest, {TSF}) AS latest_mtime, strftime(stored, {TSF}) AS stored_mark,
  strftime(mark, {TSF}) AS new_mark, settled FROM pokes"""
