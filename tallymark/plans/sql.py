"""The DuckDB side of the catalog: the entity view, its normal forms, keys and candidates as CTEs."""

from __future__ import annotations

from ..functions import text as T
from ..operators.blocking import DEFAULT_RULES
from ..sources.tables import ENTITY_SQL

ENT = "ent AS MATERIALIZED (" + ENTITY_SQL.replace("as string", "as varchar").format(part="part", nation="nation") + ")"
_SUFFIX = T.suffix_pattern().replace("'", "''")
_ABBR = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in T.ABBREVIATIONS.items()) + "}"
_STOP = ", ".join(f"'{w}'" for w in T.STOPWORDS)
NORM = rf"""{ENT},
norm0 AS (SELECT *, trim(regexp_replace(regexp_replace(regexp_replace(replace(trim(lower(business_name)), '&', ' and '), '{_SUFFIX}', ''), '[^\w\s]', ' ', 'g'), '\s+', ' ', 'g')) AS name,
  trim(regexp_replace(regexp_replace(replace(trim(lower(business_address)), '&', ' and '), '[^\w\s\-]', ' ', 'g'), '\s+', ' ', 'g')) AS address0,
  regexp_replace(trim(lower(country)), '\s+', ' ', 'g') AS country_norm,
  regexp_extract(business_address, '(?i)\b({T.POSTAL})\b', 1) AS postal FROM ent),
norm1 AS (SELECT * EXCLUDE (address0), array_to_string(list_transform(string_split(address0, ' '), lambda t: coalesce({_ABBR}[t], t)), ' ') AS address FROM norm0),
norm AS MATERIALIZED (SELECT *, regexp_extract(trim(address), '^(\d+[A-Za-z]?)\b', 1) AS house, regexp_extract_all(address, '\b\d+\b') AS numbers,
  list_filter(string_split(name, ' '), lambda t: t <> '') AS tk, list_filter(string_split(address, ' '), lambda t: t <> '') AS atk FROM norm1)"""

_TOK = "list_filter(tk, lambda t: length(t) >= 2)"
_WORDS = f"list_filter(atk, lambda t: length(t) >= 2 AND t NOT IN ({_STOP}))"
_LONG = "length(name) >= 4"


def _when(condition: str, keys: str) -> str:
    return f"CASE WHEN {condition} THEN {keys} ELSE [] END"


GRAMS = "CASE WHEN length(name) = 0 THEN []::VARCHAR[] WHEN length(name) < 3 THEN [name] ELSE list_distinct(list_transform(range(1, length(name) - 1), lambda i: substr(name, i, 3))) END"
KEYS = {
    "country": _when("country_norm <> ''", "['country:' || country_norm]"),
    "name_token": f"list_transform({_TOK}, lambda t: 'ntok:' || t)",
    "name_prefix": _when(_LONG, "['npfx:' || substr(name, 1, 4)]"),
    "address_token": f"list_transform({_WORDS}, lambda t: 'atok:' || t)",
    "postal_code": _when("postal <> ''", "['post:' || postal]"),
    "char_ngram": f"list_transform({GRAMS}, lambda g: 'cng:' || g)",
    "country_name_token": _when("country_norm <> ''", f"list_transform({_TOK}, lambda t: 'c_ntok:' || country_norm || '::' || t)"),
    "country_name_prefix": _when(f"country_norm <> '' AND {_LONG}", "['c_npfx:' || country_norm || '::' || substr(name, 1, 4)]"),
    "country_postal": _when("country_norm <> '' AND postal <> ''", "['c_post:' || country_norm || '::' || postal]"),
    "country_address_token": _when("country_norm <> ''", f"list_transform({_WORDS}, lambda t: 'c_atok:' || country_norm || '::' || t)"),
    "name_token_postal": _when("postal <> ''", f"list_transform({_TOK}, lambda t: 'ntok_post:' || t || '::' || postal)"),
    "name_prefix_postal": _when(f"{_LONG} AND postal <> ''", "['npfx_post:' || substr(name, 1, 4) || '::' || postal]"),
    "name_token_address_token": f"flatten(list_transform(list_filter(tk, lambda t: length(t) >= 3)[1:3], lambda t: list_transform(list_filter({_WORDS}, lambda a: length(a) >= 3)[1:3], lambda a: 'ntok_atok:' || t || '::' || a)))",
}


def keys(rules=DEFAULT_RULES) -> str:
    each = " UNION ALL ".join(f"SELECT entity_id, src, '{r}' AS rule, unnest({KEYS[r]}) AS key FROM norm" for r in rules)
    return f"{NORM}, keys AS MATERIALIZED ({each})"


def pairs(rules=DEFAULT_RULES, most: int = 500) -> str:
    return f"""{keys(rules)},
pool_all AS (SELECT DISTINCT rule, key, entity_id FROM keys WHERE src <> 'S1'),
pool_keys AS (SELECT * FROM pool_all QUALIFY count(*) OVER (PARTITION BY rule, key) <= {most}),
met AS (SELECT k.entity_id AS s1, p.entity_id AS cand, k.rule, count(*) AS n FROM keys k JOIN pool_keys p USING (rule, key) WHERE k.src = 'S1' GROUP BY ALL),
pairs AS MATERIALIZED (SELECT s1, cand, sum(CASE WHEN rule = 'char_ngram' THEN 1 ELSE n END)::BIGINT AS hits, array_to_string(list_sort(list_distinct(list(rule))), ',') AS rules FROM met WHERE rule <> 'char_ngram' OR n >= 2 GROUP BY ALL)"""


JACCARD = "CASE WHEN len(list_distinct(list_concat({a}, {b}))) = 0 THEN 0.0 ELSE len(list_intersect({a}, {b})) / len(list_distinct(list_concat({a}, {b}))) END"


def ranked(rules=DEFAULT_RULES, most: int = 500) -> str:
    j = JACCARD.format(a="list_distinct(list_filter(a.tk, lambda t: length(t) >= 2))", b="list_distinct(b.tk)")
    return f"""{pairs(rules, most)},
scored AS (SELECT s1, cand, b.src AS source, hits, rules, 4.0::DOUBLE * ({j}) + CASE WHEN a.postal <> '' AND a.postal = b.postal THEN 2.0::DOUBLE ELSE 0 END
  + CASE WHEN a.country_norm <> '' AND a.country_norm = b.country_norm THEN 1.0::DOUBLE ELSE 0 END + 0.5::DOUBLE * hits AS score
  FROM pairs JOIN norm a ON a.entity_id = s1 JOIN norm b ON b.entity_id = cand),
ranked AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY s1 ORDER BY score DESC, cand) AS rn FROM scored),
cands AS MATERIALIZED (SELECT * FROM ranked WHERE rn <= 50)"""


LINKS = "links AS MATERIALIZED (SELECT a.entity_id AS s1, b.entity_id AS cand FROM ent a JOIN ent b ON a.truth_key = b.truth_key AND a.src = 'S1' AND b.src <> 'S1')"
_SET = lambda c: f"list_distinct({c})"
_CHARS = "CASE WHEN length({0}) = 0 THEN []::VARCHAR[] ELSE list_distinct(string_split({0}, '')) END"


def _same(f: str) -> str:
    return f"(a.{f} = b.{f} AND a.{f} <> '')::INTEGER"


def features() -> str:
    j = lambda x: JACCARD.format(a=_SET(f"a.{x}"), b=_SET(f"b.{x}"))
    chars = lambda f: JACCARD.format(a="(" + _CHARS.format(f"a.{f}") + ")", b="(" + _CHARS.format(f"b.{f}") + ")")
    return f"""feats AS MATERIALIZED (SELECT s1, cand, {_same('name')} AS name_exact, {j('tk')} AS name_jaccard, {chars('name')} AS name_char_sim, abs(length(a.name) - length(b.name)) AS name_length_diff,
  len(list_intersect({_SET('a.tk')}, {_SET('b.tk')})) AS name_common_tokens, abs(len({_SET('a.tk')}) - len({_SET('b.tk')})) AS name_token_count_diff,
  {_same('address')} AS address_exact, {j('atk')} AS address_jaccard, {chars('address')} AS address_char_sim, abs(length(a.address) - length(b.address)) AS address_length_diff,
  len(list_intersect({_SET('a.atk')}, {_SET('b.atk')})) AS address_common_tokens,
  CASE WHEN len(a.numbers) = 0 OR len(b.numbers) = 0 THEN 0.0 ELSE len(list_filter(a.numbers, lambda x: list_contains(b.numbers, x))) / len(a.numbers) END AS address_numeric_overlap,
  {_same('postal')} AS postal_code_match, {_same('house')} AS house_number_match, {_same('country_norm')} AS country_exact, (b.src = 'S2')::INTEGER AS source_is_s2, (b.src = 'S3')::INTEGER AS source_is_s3
  FROM cands JOIN norm a ON a.entity_id = s1 JOIN norm b ON b.entity_id = cand),
linear AS MATERIALIZED (SELECT *, round(0.55::DOUBLE * name_jaccard + 0.2::DOUBLE * postal_code_match + 0.15::DOUBLE * address_jaccard + 0.1::DOUBLE * country_exact, 6) AS probability FROM feats)"""


SCORED = f"{ranked()}, {features()}, {LINKS}"


def scores(truth_n: str, pred_n: str, tp: str) -> str:
    p = f"CASE WHEN {truth_n} = 0 AND {pred_n} = 0 THEN 1.0::DOUBLE WHEN {pred_n} > 0 THEN {tp} / {pred_n} ELSE 0.0 END"
    r = f"CASE WHEN {truth_n} = 0 THEN 1.0::DOUBLE ELSE {tp} / {truth_n} END"
    f = f"CASE WHEN {truth_n} = 0 AND {pred_n} = 0 THEN 1.0::DOUBLE WHEN {truth_n} = 0 OR {tp} = 0 THEN 0.0 ELSE 1.25::DOUBLE * ({p}) * ({r}) / (0.25::DOUBLE * ({p}) + ({r})) END"
    return f"{p} AS precision, {r} AS recall, {f} AS f05"


def entity(threshold: str) -> str:
    """Scores of every s1 at a threshold, or at each t of a table."""
    return f"""pred AS (SELECT s1, cand FROM linear WHERE probability >= {threshold}),
ents AS (SELECT e.entity_id AS s1, (SELECT count(*) FROM links l WHERE l.s1 = e.entity_id) AS n_true, (SELECT count(*) FROM pred p WHERE p.s1 = e.entity_id) AS n_pred,
  (SELECT count(*) FROM pred p JOIN links l USING (s1, cand) WHERE p.s1 = e.entity_id) AS tp FROM ent e WHERE src = 'S1'),
es AS (SELECT *, {scores('n_true', 'n_pred', 'tp')} FROM ents)"""


MACRO = """count(*) AS n, avg(f05) AS macro_f05, avg(precision) AS macro_precision, avg(recall) AS macro_recall,
coalesce(avg((n_pred = 0)::INTEGER) FILTER (n_true = 0), 1.0) AS singleton_accuracy, CASE WHEN sum(n_pred) > 0 THEN sum(tp) / sum(n_pred) ELSE 0.0 END AS pair_precision,
CASE WHEN sum(n_true) > 0 THEN sum(tp) / sum(n_true) ELSE 0.0 END AS pair_recall, sum(n_pred)::BIGINT AS predicted_links, count(*) FILTER (n_pred = 0) AS predicted_singletons"""


def masks(a: str, b: str) -> str:
    """For each character of b, in order, the places in a that have it, as bits."""
    bits = f"list_transform(string_split({a}, ''), lambda x, i: CASE WHEN x = c THEN 1::HUGEINT << (i - 1)::INTEGER ELSE 0::HUGEINT END)"
    return f"list_transform(string_split({b}, ''), lambda c: list_reduce(list_prepend(0::HUGEINT, {bits}), lambda p, q: p | q))"


def _folded(a: str, found: str) -> str:
    """The length of the longest common subsequence of a, of up to 120 characters, and a text, by its masks: a row of the table is one integer."""
    full = f"((1::HUGEINT << length({a})) - 1)"
    return f"(length({a}) - bit_count(list_reduce(list_prepend({full}, {found}), lambda s, m: ((s + (s & m)) | (s - (s & m))) & {full})))"


def lcs(a: str, b: str) -> str:
    return _folded(a, masks(a, b))


def ratio(a: str, b: str) -> str:
    return f"CASE WHEN {a} = '' OR {b} = '' THEN 0.0::DOUBLE ELSE 200.0::DOUBLE * {lcs(a, b)} / (length({a}) + length({b})) END"


def _sorted(x: str) -> str:
    return f"array_to_string(list_sort(list_filter(string_split({x}, ' '), lambda t: t <> '')), ' ')"


def _windows(short: str, long: str, found: str) -> str:
    """The best ratio of short with a window of its size in long, cut short at the ends; found: the masks of long's characters."""
    first, size = "greatest(0, k)", f"(least(k + length({short}), length({long})) - greatest(0, k))"
    one = f"200.0::DOUBLE * {_folded(short, f'{found}[{first} + 1:{first} + {size}]')} / (length({short}) + {size})"
    return f"list_max(list_transform(range(1 - length({short}), length({long})), lambda k: {one}))"


def fuzzy(pairs: str) -> str:
    """CTE fz: x, y and their ratios, for distinct pairs of texts from a query with columns x and y."""
    tokens = lambda c: f"list_distinct(list_filter(string_split({c}, ' '), lambda t: t <> ''))"
    rest = lambda a, b: f"array_to_string(list_sort(list_filter({a}, lambda t: NOT list_contains({b}, t))), ' ')"
    return f"""fz0 AS MATERIALIZED (SELECT DISTINCT x, y, {_sorted('x')} AS sx, {_sorted('y')} AS sy, {tokens('x')} AS tx, {tokens('y')} AS ty,
  CASE WHEN length(y) < length(x) THEN y ELSE x END AS short, CASE WHEN length(y) < length(x) THEN x ELSE y END AS long FROM ({pairs})),
fz1 AS MATERIALIZED (SELECT *, array_to_string(list_sort(list_intersect(tx, ty)), ' ') AS same, {rest('tx', 'ty')} AS lx, {rest('ty', 'tx')} AS ly, {masks('short', 'long')} AS ml, {masks('long', 'short')} AS ms FROM fz0),
fz2 AS MATERIALIZED (SELECT *, (same <> '')::INTEGER AS gap, length(same) + (same <> '')::INTEGER + length(lx) AS nx, length(same) + (same <> '')::INTEGER + length(ly) AS ny FROM fz1),
fz AS MATERIALIZED (SELECT x, y, {ratio('x', 'y')} AS fuzzy_ratio, {ratio('sx', 'sy')} AS token_sort_ratio,
  CASE WHEN short = '' THEN 0.0::DOUBLE WHEN contains(long, short) THEN 100.0::DOUBLE WHEN length(x) = length(y) THEN greatest({_windows('short', 'long', 'ml')}, {_windows('long', 'short', 'ms')}) ELSE {_windows('short', 'long', 'ml')} END AS partial_ratio,
  CASE WHEN len(tx) = 0 OR len(ty) = 0 THEN 0.0::DOUBLE WHEN same <> '' AND (lx = '' OR ly = '') THEN 100.0::DOUBLE
    ELSE greatest(100.0::DOUBLE * (1 - (length(lx) + length(ly) - 2 * CASE WHEN lx = '' OR ly = '' THEN 0 ELSE {lcs('lx', 'ly')} END) / (nx + ny)::DOUBLE),
      CASE WHEN same <> '' THEN 100.0::DOUBLE * (1 - (gap + length(lx)) / (length(same) + nx)::DOUBLE) ELSE 0.0 END, CASE WHEN same <> '' THEN 100.0::DOUBLE * (1 - (gap + length(ly)) / (length(same) + ny)::DOUBLE) ELSE 0.0 END) END AS token_set_ratio FROM fz2)"""


def fuzzy_features(of: str = "cands") -> str:
    """CTE fuzz: s1, cand and the six ratios of pairs."""
    both = f"SELECT a.name AS x, b.name AS y FROM {of} JOIN norm a ON a.entity_id = s1 JOIN norm b ON b.entity_id = cand UNION SELECT a.address, b.address FROM {of} JOIN norm a ON a.entity_id = s1 JOIN norm b ON b.entity_id = cand"
    return f"""{fuzzy(both)},
fuzz AS MATERIALIZED (SELECT s1, cand, n.fuzzy_ratio AS name_fuzzy_ratio, n.partial_ratio AS name_partial_ratio, n.token_sort_ratio AS name_token_sort_ratio, n.token_set_ratio AS name_token_set_ratio,
  d.fuzzy_ratio AS address_fuzzy_ratio, d.token_sort_ratio AS address_token_sort_ratio
  FROM {of} JOIN norm a ON a.entity_id = s1 JOIN norm b ON b.entity_id = cand JOIN fz n ON n.x = a.name AND n.y = b.name JOIN fz d ON d.x = a.address AND d.y = b.address)"""


def tfidf(field: str, analyzer: str, of: str = "norm") -> str:
    """CTEs {field}_{analyzer}_w: entity_id, term, w of every record, fitted to the records of a relation."""
    p = f"{field}_{analyzer}"
    if analyzer == "word":
        words = rf"regexp_extract_all({field}, '\w\w+')"
        made = f"SELECT entity_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM (SELECT entity_id, {words} AS w FROM norm)"
    else:
        grams = ", ".join(f"CASE WHEN length(p) >= {n} THEN list_transform(range(1, length(p) - {n - 2}), lambda i: substr(p, i, {n})) ELSE [] END" for n in (2, 3, 4))
        made = f"SELECT entity_id, unnest(flatten([{grams}])) AS term FROM (SELECT entity_id, ' ' || unnest(list_filter(string_split({field}, ' '), lambda w: w <> '')) || ' ' AS p FROM norm)"
    return f"""{p}_tf AS MATERIALIZED (SELECT entity_id, term, count(*) AS tf FROM ({made}) GROUP BY ALL),
{p}_vocab AS MATERIALIZED (SELECT term, ln((1 + (SELECT count(*) FROM {of})) / (1 + count(*))) + 1 AS idf FROM {p}_tf WHERE entity_id IN (SELECT entity_id FROM {of}) GROUP BY term ORDER BY sum(tf) DESC, term LIMIT 10000),
{p}_x AS (SELECT entity_id, term, (1 + ln(tf)) * idf AS x FROM {p}_tf JOIN {p}_vocab USING (term)),
{p}_w AS MATERIALIZED (SELECT entity_id, term, x / sqrt(sum(x * x) OVER (PARTITION BY entity_id)) AS w FROM {p}_x)"""


def cosine(field: str, analyzer: str) -> str:
    """CTE {field}_tfidf_{analyzer}: s1, cand, cosine of every pair. The master rows' terms come first, and then only lookups."""
    p, name = f"{field}_{analyzer}", f"{field}_tfidf_{analyzer}"
    return f"""{p}_s AS MATERIALIZED (SELECT s1, cand, term, w FROM cands JOIN {p}_w ON entity_id = s1),
{p}_d AS MATERIALIZED (SELECT s1, cand, sum(s.w * b.w) AS dot FROM {p}_s s JOIN {p}_w b ON b.entity_id = cand AND b.term = s.term GROUP BY ALL),
{name} AS MATERIALIZED (SELECT s1, cand, least(1.0, greatest(0.0, coalesce(dot, 0.0))) AS cosine FROM cands LEFT JOIN {p}_d USING (s1, cand))"""


def quantiles(v: str, prefix: str = "", places: int = 2) -> str:
    stats = {"mean": f"avg({v})", "std": f"stddev_samp({v})", "min": f"min({v})", "p25": f"quantile_cont({v}, 0.25)", "median": f"quantile_cont({v}, 0.5)", "p75": f"quantile_cont({v}, 0.75)", "p90": f"quantile_cont({v}, 0.9)", "max": f"max({v})"}
    return ", ".join(f"round_even(coalesce(({c})::DOUBLE, 0.0), {places}) AS {prefix}{k}" for k, c in stats.items())


def place(key: str, seed: int = 42) -> str:
    return f"md5({key} || ':{seed}')"


PARTS = f"parts AS MATERIALIZED (SELECT entity_id AS s1, CASE WHEN row_number() OVER (ORDER BY {place('entity_id')}, entity_id) <= floor(0.2::DOUBLE * count(*) OVER ()) THEN 'validation' ELSE 'train' END AS part FROM ent WHERE src = 'S1')"
