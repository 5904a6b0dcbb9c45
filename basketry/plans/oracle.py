"""DuckDB oracle SQL fragments shared by the registry.

The oracle re-derives every result from the raw tables independently of the
Spark code, from the definition of the result.
"""

from __future__ import annotations

import datetime as dt

from basketry.schema import DAY30, DAY31, LAST_HOUR


def ts(value: dt.datetime) -> str:
    return f"TIMESTAMP '{value:%Y-%m-%d %H:%M:%S}'"


A30 = ts(DAY30)
A31 = ts(DAY31)
AH = ts(LAST_HOUR)

# The behaviour log derived from `events` (same rule as the Spark adapter).
BEH = """beh AS (
  SELECT * FROM (
    SELECT CAST(user_id AS BIGINT) AS user_id,
           TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
           CAST(CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2
                                WHEN 'signup' THEN 3 WHEN 'purchase' THEN 4 END AS INTEGER) AS behavior_type,
           date_trunc('hour', ts) AS time
    FROM events
    WHERE event_type IN ('view', 'click', 'signup', 'purchase') AND ts IS NOT NULL) e
  WHERE user_id IS NOT NULL AND item_id IS NOT NULL)"""


def hours_before(col: str, anchor: str) -> str:
    return f"CAST(date_diff('hour', {col}, {anchor}) AS INTEGER)"


def with_beh(*ctes: str) -> str:
    return "WITH " + ",\n".join((BEH, *ctes)) + "\n"


# Latest cart per pair before day 30, as hours before the anchor; distinct buyers after it.
LAST_CART = f"""last_cart AS (
  SELECT user_id, item_id, min({hours_before('time', A30)}) AS hour
  FROM beh WHERE behavior_type = 3 AND time < {A30} GROUP BY user_id, item_id)"""
BUYERS = f"""buyers AS (SELECT DISTINCT user_id, item_id FROM beh WHERE behavior_type = 4 AND time > {A30})"""
PER_HOUR = """per_hour AS (SELECT hour, count(*) AS carted FROM last_cart GROUP BY hour)"""
CONV = """conv AS (
  SELECT c.hour, count(*) AS bought FROM last_cart c JOIN buyers b USING (user_id, item_id) GROUP BY c.hour)"""
CURVE = f"""curve AS (
  SELECT conv.hour, conv.bought, per_hour.carted,
         round(conv.bought / per_hour.carted, 4) AS rate,
         printf('%.4f', round(conv.bought / per_hour.carted, 4)) AS rate_text
  FROM conv JOIN per_hour USING (hour))"""


FEATURE_LIST = "user_id, item_id, time1, type_1count, time2, type_2count, time3, type_3count, type_4count"


def features(anchor: str, before: bool) -> str:
    """Features from their definition: one grouped SELECT over the log (before
    the anchor, or all of it), each by its own filter."""
    where = f"WHERE time < {anchor} AND behavior_type BETWEEN 1 AND 4" if before else "WHERE behavior_type BETWEEN 1 AND 4"
    recency = ", ".join(
        f"coalesce({hours_before(f'max(time) FILTER (WHERE behavior_type = {k})', anchor)}, 0) AS time{k}, count(*) FILTER (WHERE behavior_type = {k}) AS type_{k}count" for k in (1, 2, 3)
    )
    return f"feat AS (SELECT user_id, item_id, {recency}, count(*) FILTER (WHERE behavior_type = 4) AS type_4count FROM beh {where} GROUP BY user_id, item_id)"


# The label of a pair is whether it was bought after the anchor; a bought pair
# stands as often as it was bought.
TRAINING = f"""bought AS (SELECT user_id, item_id, count(*) AS times FROM beh WHERE behavior_type = 4 AND time > {A30} GROUP BY ALL),
counted AS (SELECT feat.*, coalesce(times, 0) AS times FROM feat LEFT JOIN bought USING (user_id, item_id)),
training AS (SELECT {FEATURE_LIST}, CASE WHEN times > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS label FROM (SELECT *, unnest(range(greatest(times, 1))) FROM counted)),
pos AS (SELECT * FROM training WHERE label = 1)"""


def outer_join_features(anchor: str) -> str:
    """The chain of full outer joins over four aggregates, before the anchor."""
    part = lambda k: (
        f"(SELECT user_id, item_id, {f'min({hours_before("time", anchor)}) AS time{k}, ' if k < 4 else ''}count(*) AS type_{k}count FROM beh WHERE time < {anchor} AND behavior_type = {k} GROUP BY ALL)"
    )
    columns = ", ".join(f"coalesce({c}, 0) AS {c}" for c in FEATURE_LIST.split(", ")[2:])
    return f"feat AS (SELECT user_id, item_id, {columns} FROM " + " FULL OUTER JOIN ".join(part(k) + (" USING (user_id, item_id)" if k > 1 else "") for k in (1, 2, 3, 4)) + ")"


# ---------------------------------------------------------------------------
# Text


def tokens_expr(text: str, lower: bool = True, sep: str = r"\s") -> str:
    """Java String.split semantics: '' -> [''], separators only -> [], trailing
    empties dropped, leading and inner empties kept."""
    src = f"lower({text})" if lower else text
    trail = r"\s+$" if sep == r"\s" else " +$"
    stripped = f"regexp_replace({src}, '{trail}', '')"
    return f"(CASE WHEN {src} = '' THEN [''] WHEN {stripped} = '' THEN CAST([] AS VARCHAR[]) ELSE string_split_regex({stripped}, '{sep}') END)"


_M = "4294967296"


def _rotl(x: str, r: int) -> str:
    return f"(({x}) * {2 ** r} % {_M} + ({x}) // {2 ** (32 - r)})"


def _mix(k: str) -> str:
    k1 = f"(CAST({k} AS HUGEINT) * 3432918353 % {_M})"
    return f"({_rotl(k1, 15)} * 461845907 % {_M})"


def _step(h: str, k: str) -> str:
    return f"(({_rotl(f'xor({h}, {_mix(k)})', 13)}) * 5 + 3864292196) % {_M}"


def hashed_buckets(source: str, num_features: int) -> str:
    """CTE chain ``source(… , token)`` -> ``hashed(…, bucket)``: Spark ML
    HashingTF's bucket, i.e. murmur3_x86_32 (seed 42) over the token's UTF-8
    bytes, as a signed 32-bit value, positive modulo ``num_features``.
    Written out in SQL so the oracle does not share code with the job."""
    block = "CAST(CAST(('0x' || substr(hx, 8*i+7, 2) || substr(hx, 8*i+5, 2) || substr(hx, 8*i+3, 2) || substr(hx, 8*i+1, 2)) AS UBIGINT) AS HUGEINT)"
    tail = (
        "CASE WHEN n % 4 = 0 THEN NULL ELSE CAST(CAST(('0x' || list_aggregate(list_reverse(list_transform(range(n % 4), "
        "lambda j: substr(hx, 8*(n // 4) + 2*j + 1, 2))), 'string_agg', '')) AS UBIGINT) AS HUGEINT) END"
    )
    return f"""hb AS (SELECT *, hex(encode(token)) AS hx, octet_length(encode(token)) AS n FROM {source}),
hk AS (SELECT * EXCLUDE (hx), list_reduce(list_prepend(CAST(42 AS HUGEINT), list_transform(range(n // 4), lambda i: {block})),
                                 lambda h, k: {_step('h', 'k')}) AS h0, {tail} AS tl FROM hb),
h1 AS (SELECT * EXCLUDE (h0, tl), xor(CASE WHEN tl IS NULL THEN h0 ELSE xor(h0, {_mix('tl')}) END, CAST(n AS HUGEINT)) AS h FROM hk),
h2 AS (SELECT * EXCLUDE (h), xor(h, h // 65536) * 2246822507 % {_M} AS h FROM h1),
h3 AS (SELECT * EXCLUDE (h), xor(h, h // 8192) * 3266489909 % {_M} AS h FROM h2),
h4 AS (SELECT * EXCLUDE (h), xor(h, h // 65536) AS h FROM h3),
hashed AS (SELECT * EXCLUDE (h, n),
  CAST((((CASE WHEN h >= 2147483648 THEN h - {_M} ELSE h END) % {num_features}) + {num_features}) % {num_features} AS INTEGER) AS bucket FROM h4)"""


def doc_tokens(table_sql: str, id_cols: str) -> str:
    return f"toks AS (SELECT {id_cols}, unnest({tokens_expr('text')}) AS token FROM ({table_sql}) d WHERE text IS NOT NULL)"


def tf_rows(id_cols: str) -> str:
    return f"tf AS (SELECT {id_cols}, bucket, CAST(count(*) AS DOUBLE) AS tf FROM hashed GROUP BY ALL)"


def tfidf_rows(id_cols: str) -> str:
    """TF-IDF of the ``tf`` rows, fitted on the same documents."""
    return f"""ndocs AS (SELECT count(*) AS n_docs FROM (SELECT DISTINCT {id_cols} FROM docs) x),
dfreq AS (SELECT bucket, count(*) AS df FROM tf GROUP BY bucket),
tfidf AS (SELECT {id_cols}, tf.bucket, round(tf.tf * ln((ndocs.n_docs + 1) / (dfreq.df + 1)), 6) AS weight
          FROM tf JOIN dfreq USING (bucket), ndocs)"""


CORPUS = "SELECT d.doc_id, d.text, CAST(l.toxic AS DOUBLE) AS label FROM documents d JOIN labels l USING (doc_id) WHERE d.text IS NOT NULL"


# ---------------------------------------------------------------------------
# Models


# Newton steps of the weighted logistic regression on the training set: per
# step the sums of an augmented matrix (Hessian | gradient), solved by
# Gauss-Jordan elimination of its lists.
NEWTON_STEPS = 25
NEWTON = f"""obs AS (SELECT [1.0, time1, type_1count, time2, type_2count, time3, type_3count, type_4count]::DOUBLE[] AS x, label AS y, count(*)::DOUBLE AS w FROM training GROUP BY ALL),
cells AS (SELECT i, j FROM range(1, 9) a(i), range(1, 10) b(j)),
newton AS (
  SELECT 0 AS step, [0.0, 0, 0, 0, 0, 0, 0, 0]::DOUBLE[] AS beta
  UNION ALL
  SELECT step + 1, list_transform(range(1, 9), lambda i: beta[i] + solved[i][9])
  FROM (
    SELECT step, beta, list_reduce(list_prepend(m, list_transform(range(1, 9), lambda k: [[k::DOUBLE]])),
      lambda m, k: list_transform(range(1, 9), lambda r: list_transform(range(1, 10), lambda c:
        CASE WHEN r = k[1][1] THEN m[r][c] / m[r][r] ELSE m[r][c] - m[r][k[1][1]::INT] / m[k[1][1]::INT][k[1][1]::INT] * m[k[1][1]::INT][c] END))) AS solved
    FROM (
      SELECT step, beta, list(line ORDER BY i) AS m
      FROM (
        SELECT step, beta, i, list(s ORDER BY j) AS line
        FROM (SELECT step, beta, i, j, sum(CASE WHEN j = 9 THEN w * (y - p) * x[i] ELSE w * p * (1 - p) * x[i] * x[j] END) AS s
              FROM (SELECT step, beta, x, y, w, 1 / (1 + exp(-list_dot_product(x, beta))) AS p FROM newton, obs WHERE step < {NEWTON_STEPS}), cells GROUP BY ALL)
        GROUP BY step, beta, i)
      GROUP BY step, beta))),
fitted AS (SELECT beta FROM newton WHERE step = {NEWTON_STEPS})"""


def recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


def legacy_sgd(num_features: int, iterations: int = 100, reg: float = 0.01, tol: float = 0.001) -> str:
    """Full-batch gradient steps of size 1 / sqrt(step) on the mean logistic
    loss with L2 shrinkage, until the weights move by less than ``tol`` of
    their length; the decision for every labelled document."""
    return (
        f"WITH RECURSIVE docs AS ({CORPUS}),\ntoks AS (SELECT doc_id, label, unnest({tokens_expr('text', lower=False, sep=' ')}) AS token FROM docs),\n"
        + hashed_buckets("toks", num_features)
        + ",\n"
        + tf_rows("doc_id, label")
        + f""",
sgd AS (
  SELECT 0 AS step, bucket, 0.0::DOUBLE AS w, FALSE AS done FROM tf GROUP BY bucket
  UNION ALL
  SELECT step, bucket, new AS w, step > 1 AND sqrt(sum((new - old) ** 2) OVER ()) < {tol} * greatest(sqrt(sum(new * new) OVER ()), 1) AS done
  FROM (
    SELECT step + 1 AS step, bucket, w AS old, w * (1 - {reg} / sqrt(step + 1)) - g / sqrt(step + 1) AS new
    FROM sgd JOIN (
      SELECT bucket, sum(miss * tf) / (SELECT count(*) FROM docs) AS g
      FROM tf JOIN (SELECT doc_id, 1 / (1 + exp(-sum(tf * w))) - any_value(label) AS miss FROM tf JOIN sgd USING (bucket) WHERE step < {iterations} AND NOT done GROUP BY doc_id) USING (doc_id)
      GROUP BY bucket) USING (bucket)
    WHERE step < {iterations} AND NOT done)),
margins AS (SELECT doc_id, sum(tf * w) AS margin FROM tf JOIN (SELECT * FROM sgd WHERE step = (SELECT max(step) FROM sgd)) USING (bucket) GROUP BY doc_id)
SELECT doc_id, label, CASE WHEN margin > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction FROM docs LEFT JOIN margins USING (doc_id)"""
    )


def grid_folds(num_folds: int, grid: dict[str, tuple], kinds: tuple[str, ...]) -> str:
    """Rows and positives of every fold, for every setting of ``grid``."""
    settings = " CROSS JOIN ".join(f"(SELECT unnest([{', '.join(map(str, v))}])::{k} AS {n})" for (n, v), k in zip(grid.items(), kinds))
    return (
        f"WITH docs AS ({CORPUS}), folds AS (SELECT (('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT % {num_folds})::INTEGER AS fold, "
        f"count(*) AS n_rows, count(*) FILTER (WHERE label = 1) AS n_positive FROM docs GROUP BY ALL) "
        f"SELECT {', '.join(grid)}, fold, n_rows, n_positive, true AS auc_is_evaluators FROM folds CROSS JOIN {settings}"
    )
