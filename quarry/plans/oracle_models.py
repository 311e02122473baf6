"""DuckDB SQL of the model keys that have an exact form."""

from __future__ import annotations

import math

from quarry.plans.oracle import FEATURES, R6, SHAPE, STAR, WS_TOKENS, _stats, with_

_WORD = 4294967296  # 2^32


def _turn(x: str, left: int) -> str:
    """``x`` rotated left by ``left`` of 32 bits, as arithmetic on UBIGINT."""
    return f"({x} % {2 ** (32 - left)} * {2 ** left} + {x} // {2 ** (32 - left)})"


def murmur_slots(terms: str) -> list[str]:
    """CTEs up to ``slots (t, slot)``: Murmur3 (32 bits, seed 42) of the UTF-8 bytes of ``terms.t``, modulo 2^18."""
    mixed = [f"(k * CAST(3432918353 AS UBIGINT)) % {_WORD}", _turn("k", 15), f"(k * CAST(461845907 AS UBIGINT)) % {_WORD}"]
    blocks, tail = "blocks", "tail"
    for step in mixed:
        blocks = f"list_transform({blocks}, lambda k: {step})"
        tail = f"list_transform({tail}, lambda k: {step})"
    folded = f"(({_turn('xor(h, k)', 13)}) * 5 + 3864292196) % {_WORD}"
    byte = "CAST('0x' || substr(x, 2 * (i) + 1, 2) AS UBIGINT)"
    at = lambda place: byte.replace("(i)", f"({place})")
    return [
        terms,
        "hexed AS (SELECT t, hex(encode(t)) AS x, CAST(octet_length(encode(t)) AS BIGINT) AS n FROM (SELECT DISTINCT t FROM terms))",
        f"""cut AS (SELECT t, n,
  list_transform(range(0, n // 4), lambda b: {at('4 * b')} + {at('4 * b + 1')} * 256 + {at('4 * b + 2')} * 65536 + {at('4 * b + 3')} * 16777216) AS blocks,
  [CAST(coalesce(list_sum(list_transform(range(n - n % 4, n), lambda j: {at('j')} * CAST(power(256, j % 4) AS UBIGINT))), 0) AS UBIGINT)] AS tail
  FROM hexed)""",
        f"mixed AS (SELECT t, n, {blocks} AS blocks, ({tail})[1] AS tail FROM cut)",
        f"h0 AS (SELECT t, xor(xor(list_reduce(list_concat([CAST(42 AS UBIGINT)], blocks), lambda h, k: {folded}), tail), CAST(n AS UBIGINT)) AS h FROM mixed)",
        f"h1 AS (SELECT t, (xor(h, h // 65536) * CAST(2246822507 AS UBIGINT)) % {_WORD} AS h FROM h0)",
        f"h2 AS (SELECT t, (xor(h, h // 8192) * CAST(3266489909 AS UBIGINT)) % {_WORD} AS h FROM h1)",
        "slots AS (SELECT t, CAST(xor(h, h // 65536) % 262144 AS BIGINT) AS slot FROM h2)",
    ]


_NUMBERS = ["S_years", "R_years", "Resume_Tips", "Resume_OnFile", "Client", "Confirmed_hire", "responsive", "Created_Linkedin"]
_TEXTS = ["Client_Type", "Service_R", "Service_B", "Com_Method", "active", "Educ", "Occupation"]
_HASHED = "terms AS (\n" + "\nUNION ALL ".join(
    [f"SELECT order_id * 16 + line_no AS row_key, '{c}' AS t, CAST({c} AS DOUBLE) AS v FROM features WHERE {c} IS NOT NULL" for c in _NUMBERS]
    + [f"SELECT order_id * 16 + line_no, '{c}=' || {c}, 1.0 FROM features WHERE {c} IS NOT NULL" for c in _TEXTS]
) + ")"

MODEL_KEYS = {
    "hashing_tf_slots": with_(*murmur_slots(f"terms AS (SELECT doc_id, unnest({WS_TOKENS.format(x='text')}) AS t FROM documents)")) + """
SELECT doc_id, slot, CAST(count(*) AS DOUBLE) AS value FROM terms JOIN slots USING (t) GROUP BY doc_id, slot""",
    "feature_hash_slots": with_(STAR, FEATURES, *murmur_slots(_HASHED)) + f"""
SELECT row_key, slot, {R6('sum(v)')} AS value FROM terms JOIN slots USING (t) GROUP BY row_key, slot""",
    "decision_stump": with_(
        STAR, FEATURES,
        "d AS (SELECT order_id * 16 + line_no AS row_key, TRY_CAST(hired AS DOUBLE) AS label, S_years AS x FROM features)",
        """v AS (SELECT x, lead(x) OVER (ORDER BY x) AS y, sum(count(*)) OVER (ORDER BY x) AS nl, sum(sum(label)) OVER (ORDER BY x) AS pl
  FROM d GROUP BY x)""",
        "whole AS (SELECT count(*) AS n, sum(label) AS p FROM d)",
        """best AS (SELECT (x + y) / 2 AS bound, nl, pl, n, p FROM v, whole WHERE y IS NOT NULL
  ORDER BY (pl * pl + (nl - pl) * (nl - pl)) / nl + ((p - pl) * (p - pl) + (n - nl - p + pl) * (n - nl - p + pl)) / (n - nl) DESC, x LIMIT 1)""",
    ) + """
SELECT row_key, label, CAST(CASE WHEN x <= bound THEN 2 * pl > nl ELSE 2 * (p - pl) > n - nl END AS DOUBLE) AS prediction FROM d, best""",
    "pca_rotation": with_(SHAPE) + """
SELECT page_id, CAST(len_body * len_body + num_paragraphs * num_paragraphs + num_links * num_links AS BIGINT) AS squared_length FROM shape""",
}


# ---- seeded draws ------------------------------------------------------------

_DRAWS = 2**48


def _draw(seed: int, *parts: str) -> str:
    """SQL twin of ``sampling.draw``; parts are text expressions."""
    named = " || ".join(f"coalesce(octet_length(encode({p})) || ':' || {p}, '-')" for p in parts)
    return f"CAST('0x' || substr(md5('{seed};' || {named}), 1, 12) AS BIGINT)"


MODEL_KEYS["random_split"] = f"""
WITH r AS (SELECT o_orderstatus, o_orderpriority,
                  CAST(row_number() OVER (PARTITION BY o_orderstatus, o_orderpriority) - 1 AS VARCHAR) AS number FROM orders)
SELECT o_orderstatus, o_orderpriority,
       CASE WHEN {_draw(11, 'o_orderstatus', 'o_orderpriority', 'number')} < {math.ceil(0.7 * _DRAWS)} THEN 'train' ELSE 'test' END AS split
FROM r"""

# ---- 28 stumps on bootstrap weights ------------------------------------------

_INPUTS = ["S_years", "Resume_Tips", "Resume_OnFile"]


def _poisson(u: str) -> str:
    """How many of the running sums of e^-1 / k! lie at or below ``u / 2^48``."""
    bounds = [math.ceil(math.fsum(math.exp(-1) / math.factorial(j) for j in range(k + 1)) * _DRAWS) for k in range(16)]
    return " + ".join(f"CAST({u} >= {b} AS INTEGER)" for b in bounds)


_BAGS = [
    STAR, FEATURES,
    f"d AS MATERIALIZED (SELECT row_number() OVER () AS rid, order_id * 16 + line_no AS row_key, TRY_CAST(hired AS DOUBLE) AS label, {', '.join(_INPUTS)} FROM features)",
    "trees AS (SELECT unnest(range(28)) AS tree)",
    f"drawn AS (SELECT *, {_draw(17, 'CAST(tree AS VARCHAR)', 'CAST(row_key AS VARCHAR)')} AS u FROM d, trees)",
    f"bags AS MATERIALIZED (SELECT * FROM (SELECT *, {_poisson('u')} AS w FROM drawn) WHERE w > 0)",
]
_OPTIONS = " UNION ALL ".join(
    f"SELECT tree, {i} AS input, {_draw(17, repr(c), 'CAST(tree AS VARCHAR)')} AS u FROM trees" for i, c in enumerate(_INPUTS)
)
_VALUES = " UNION ALL ".join(
    f"SELECT tree, {i} AS input, {c} AS x, sum(w) AS n, sum(w * label) AS p FROM bags GROUP BY tree, {c}" for i, c in enumerate(_INPUTS)
)
_SIDE = "({p} * {p} + ({n} - {p}) * ({n} - {p})) / {n}"

MODEL_KEYS["forest_bags"] = with_(*_BAGS) + """
SELECT CAST(tree AS INTEGER) AS tree, count(*) AS n_rows, CAST(sum(w) AS BIGINT) AS weight FROM bags GROUP BY tree"""
MODEL_KEYS["forest_votes"] = with_(
    *_BAGS,
    f"allowed AS (SELECT tree, input FROM ({_OPTIONS}) QUALIFY row_number() OVER (PARTITION BY tree ORDER BY u, input) <= 2)",
    f"by_value AS ({_VALUES})",
    """cuts AS (SELECT tree, input, x, lead(x) OVER (PARTITION BY tree, input ORDER BY x) AS y,
  sum(n) OVER (PARTITION BY tree, input ORDER BY x) AS nl, sum(p) OVER (PARTITION BY tree, input ORDER BY x) AS pl,
  sum(n) OVER (PARTITION BY tree, input) AS n, sum(p) OVER (PARTITION BY tree, input) AS p
  FROM by_value JOIN allowed USING (tree, input))""",
    f"""best AS (SELECT * FROM cuts WHERE y IS NOT NULL QUALIFY row_number() OVER (PARTITION BY tree
  ORDER BY {_SIDE.format(p='pl', n='nl')} + {_SIDE.format(p='(p - pl)', n='(n - nl)')} DESC, input, x) = 1)""",
    f"""votes AS (SELECT rid, row_key, CASE WHEN CASE input {' '.join(f'WHEN {i} THEN {c}' for i, c in enumerate(_INPUTS))} END <= (x + y) / 2
  THEN 2 * pl > nl ELSE 2 * (p - pl) > n - nl END AS vote FROM d, best)""",
) + """
SELECT row_key, count(*) FILTER (WHERE vote) AS votes_1, CAST(2 * count(*) FILTER (WHERE vote) > 28 AS DOUBLE) AS prediction
FROM votes GROUP BY rid, row_key"""

# ---- k-means on the hashed model columns ---------------------------------------

KMEANS_STEPS = 20


_POINT_TERMS = _HASHED.replace("order_id * 16 + line_no AS row_key", "rid").replace("order_id * 16 + line_no", "rid").replace("FROM features", "FROM f")


def _kmeans() -> list[str]:
    """CTEs up to ``clusters (row_key, prediction)``: four farthest-first centres, then Lloyd steps."""
    ctes = [
        STAR, FEATURES, "f AS MATERIALIZED (SELECT *, row_number() OVER () AS rid, order_id * 16 + line_no AS row_key FROM features)",
        *murmur_slots(_POINT_TERMS),
        "e AS MATERIALIZED (SELECT rid, slot, sum(v) AS v FROM terms JOIN slots USING (t) GROUP BY rid, slot)",
        "norms AS MATERIALIZED (SELECT rid, sum(v * v) AS q FROM e GROUP BY rid)",
        "far0 AS MATERIALIZED (SELECT rid, q AS d FROM norms)",
    ]
    for i in range(4):
        ctes += [
            f"start{i} AS MATERIALIZED (SELECT slot, v, q FROM e JOIN norms USING (rid) WHERE rid = (SELECT rid FROM far{i} JOIN f USING (rid) ORDER BY d DESC, row_key LIMIT 1))",
            f"""far{i + 1} AS MATERIALIZED (SELECT rid, {'d' if not i else ''}{'' if not i else 'least(f.d, n.d) AS d'} FROM (
  SELECT rid, any_value(norms.q) + (SELECT any_value(q) FROM start{i}) - 2 * coalesce(sum(e.v * s.v), 0) AS d
  FROM norms JOIN e USING (rid) LEFT JOIN start{i} s USING (slot) GROUP BY rid) n {'' if not i else f'JOIN far{i} f USING (rid)'})""",
        ]
    ctes.append("c0 AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT {i} AS k, slot, v FROM start{i}" for i in range(4)) + ")")
    for t in range(KMEANS_STEPS + 1):
        ctes.append(f"""a{t} AS MATERIALIZED (
  SELECT rid, k FROM (SELECT rid, k, sum(e.v * c.v) AS dot FROM e JOIN c{t} c USING (slot) GROUP BY rid, k)
  JOIN (SELECT k, sum(v * v) AS q FROM c{t} GROUP BY k) USING (k)
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY q - 2 * dot, k) = 1)""")
        if t < KMEANS_STEPS:
            ctes.append(f"""c{t + 1} AS MATERIALIZED (
  SELECT k, slot, sum(v) / any_value(n) AS v FROM e JOIN a{t} USING (rid) JOIN (SELECT k, count(*) AS n FROM a{t} GROUP BY k) USING (k)
  GROUP BY k, slot)""")
    ctes.append(f"clusters AS (SELECT rid, CAST(k AS INTEGER) AS prediction FROM a{KMEANS_STEPS})")
    return ctes


_CLUSTERED = _kmeans() + ["g AS (SELECT * FROM f JOIN clusters USING (rid))"]
MODEL_KEYS["kmeans"] = with_(*_CLUSTERED) + "SELECT row_key, prediction FROM g"
MODEL_KEYS["cluster_values"] = with_(*_CLUSTERED) + "SELECT DISTINCT prediction FROM clusters"
MODEL_KEYS["cluster_combinations"] = with_(*_CLUSTERED) + """
SELECT DISTINCT Service_B, Service_R, TRY_CAST(hired AS DOUBLE) AS label, prediction FROM g"""
MODEL_KEYS["cluster_profile"] = with_(*_CLUSTERED) + _stats("S_years", "g", "prediction") + "\nUNION ALL\n" + _stats("R_years", "g", "prediction")

# ---- Newton steps and the area of a fixed score ----------------------------------


def _newton(steps: int, penalty: float) -> list[str]:
    """CTEs up to ``w{steps} (w0, w1, w2)``; each 3 x 3 system by Cramer's rule."""
    ctes = [
        """d AS (SELECT CAST(quality AS DOUBLE) AS y, n_chars / 1000.0 AS x1,
  (length(text) - length(replace(text, ' ', ''))) / n_chars AS x2 FROM documents JOIN labels USING (doc_id))""",
        "w0 AS (SELECT 0.0::DOUBLE AS w0, 0.0::DOUBLE AS w1, 0.0::DOUBLE AS w2)",
    ]
    for t in range(steps):
        ctes += [
            f"p{t} AS (SELECT y, x1, x2, 1 / (1 + exp(-(w0 + x1 * w1 + x2 * w2))) AS p, w0, w1, w2 FROM d, w{t} WHERE y IS NOT NULL AND x1 IS NOT NULL AND x2 IS NOT NULL)",
            f"""s{t} AS (SELECT any_value(w0) AS w0, any_value(w1) AS w1, any_value(w2) AS w2,
  sum(y - p) AS g, sum((y - p) * x1) - {penalty} * any_value(w1) AS h, sum((y - p) * x2) - {penalty} * any_value(w2) AS i,
  sum(p * (1 - p)) AS a, sum(p * (1 - p) * x1) AS b, sum(p * (1 - p) * x2) AS c, sum(p * (1 - p) * x1 * x1) + {penalty} AS e,
  sum(p * (1 - p) * x1 * x2) AS f, sum(p * (1 - p) * x2 * x2) + {penalty} AS k FROM p{t})""",
            f"""w{t + 1} AS (SELECT w0 + (g * (e * k - f * f) - b * (h * k - f * i) + c * (h * f - e * i)) / det AS w0,
  w1 + (a * (h * k - f * i) - g * (b * k - f * c) + c * (b * i - h * c)) / det AS w1,
  w2 + (a * (e * i - h * f) - b * (b * i - h * c) + g * (b * f - e * c)) / det AS w2
  FROM (SELECT *, a * (e * k - f * f) - b * (b * k - f * c) + c * (b * f - e * c) AS det FROM s{t}))""",
        ]
    return ctes


MODEL_KEYS["logistic_newton"] = with_(*_newton(5, 0.01)) + f"""
SELECT unnest(['intercept', 'kchars', 'space_share']) AS term, unnest([{R6('w0')}, {R6('w1')}, {R6('w2')}]) AS weight FROM w5"""
MODEL_KEYS["area_under_curve"] = f"""
WITH r AS (SELECT lang, n_chars // 100 AS score, CAST(quality > 0.5 AS BIGINT) AS up FROM documents JOIN labels USING (doc_id)
           WHERE n_chars IS NOT NULL AND quality IS NOT NULL),
s AS (SELECT lang, score, sum(up) AS up, sum(1 - up) AS down FROM r GROUP BY lang, score),
b AS (SELECT *, coalesce(sum(down) OVER (PARTITION BY lang ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM s)
SELECT lang, CAST(sum(up + down) AS BIGINT) AS n, CAST(sum(up) AS BIGINT) AS positives,
       CASE WHEN sum(up) > 0 AND sum(down) > 0 THEN {R6('sum(up * (below + down / 2)) / (sum(up) * sum(down))')} END AS auc
FROM b GROUP BY lang"""

# ---- components of three columns by power iteration ------------------------------

_XYZ = ["len_body", "num_paragraphs", "num_links"]


def _power(name: str, matrix: str, steps: int) -> list[str]:
    """CTEs ``{name} (l, x, y, z)``: largest eigenvalue and unit vector of the symmetric ``matrix (a, b, c, e, f, k)``."""
    return [
        f"""{name}_step AS (SELECT 0 AS i, 1.0::DOUBLE AS x, 0.9::DOUBLE AS y, 0.8::DOUBLE AS z UNION ALL
  SELECT i + 1, u / sqrt(u * u + v * v + w * w), v / sqrt(u * u + v * v + w * w), w / sqrt(u * u + v * v + w * w) FROM (
  SELECT i, a * x + b * y + c * z AS u, b * x + e * y + f * z AS v, c * x + f * y + k * z AS w FROM {name}_step, {matrix} WHERE i < {steps}))""",
        f"""{name} AS (SELECT a * x * x + e * y * y + k * z * z + 2 * (b * x * y + c * x * z + f * y * z) AS l, x, y, z
  FROM {name}_step, {matrix} WHERE i = {steps})""",
    ]


MODEL_KEYS["pca_components"] = "WITH RECURSIVE " + ",\n".join([
    SHAPE,
    "m AS (SELECT " + ", ".join(f"covar_samp({p}, {q}) AS {n}" for n, p, q in zip(
        "abcefk", [_XYZ[0]] * 3 + [_XYZ[1]] * 2 + [_XYZ[2]], [*_XYZ, *_XYZ[1:], _XYZ[2]])) + " FROM shape)",
    *_power("p1", "m", 400),
    """m2 AS (SELECT a - l * x * x AS a, b - l * x * y AS b, c - l * x * z AS c, e - l * y * y AS e, f - l * y * z AS f, k - l * z * z AS k FROM m, p1)""",
    *_power("p2", "m2", 400),
    """p3 AS (SELECT a + e + k - p1.l - p2.l AS l, p1.y * p2.z - p1.z * p2.y AS x, p1.z * p2.x - p1.x * p2.z AS y, p1.x * p2.y - p1.y * p2.x AS z FROM m, p1, p2)""",
    "every AS (SELECT 1 AS component, * FROM p1 UNION ALL SELECT 2, * FROM p2 UNION ALL SELECT 3, * FROM p3)",
    "turned AS (SELECT component, l, x, y, z, CASE WHEN abs(x) >= abs(y) AND abs(x) >= abs(z) THEN x WHEN abs(y) >= abs(z) THEN y ELSE z END AS lead FROM every)",
]) + "\n" + " UNION ALL ".join(
    f"SELECT component, '{c}' AS input, {R6(f'CASE WHEN lead < 0 THEN -{v} ELSE {v} END')} AS weight, {R6('l')} AS variance FROM turned"
    for c, v in zip(_XYZ, "xyz")
)
