"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from galecast.llm import decontam, lm, substrings, urls
from galecast.llm.text import WORD

_WORDS = f"regexp_extract_all(coalesce(text, ''), '{WORD}')"
_UNITS = ", ".join(f"'{unit}'" for unit in decontam.UNITS)


def _typed(word: str) -> str:
    return f"CASE WHEN regexp_matches({word}, '{decontam._NUMBER}') THEN chr(2) WHEN {word} IN ({_UNITS}) THEN chr(3) ELSE {word} END"


def _windows(template: str) -> str:
    return f"""CASE WHEN len({template}) = 0 THEN [] WHEN len({template}) < 5 THEN [array_to_string({template}, ' ')]
        ELSE list_transform(range(1, len({template}) - 3), lambda i: array_to_string({template}[i:i + 4], ' ')) END"""


def _template(table: str, key: str) -> str:
    """k, the key, text, words (chr(1): a name, chr(4): another capitalised word), the three readings, their windows, and the words
    with all capitalised ones but units as names."""
    marked = f"regexp_replace(coalesce(text, ''), '{decontam._INNER_CAPITAL}', '\\1' || chr(1) || '\\2', 'g')"
    marked = f"regexp_replace({marked}, '{decontam._OTHER_CAPITAL}', '\\1' || chr(4) || '\\2', 'g')"
    first = "CASE WHEN starts_with(w, chr(1)) THEN chr(1) WHEN starts_with(w, chr(4)) THEN " + _typed("w[2:]") + " ELSE " + _typed("w") + " END"
    bare = f"CASE WHEN starts_with(w, chr(1)) OR starts_with(w, chr(4)) THEN {_typed('w[2:]')} ELSE {_typed('w')} END"
    return f"""
    SELECT *, {_windows("template")} AS wt, {_windows("plain")} AS wp, {_windows("named")} AS wn
    FROM (SELECT *, list_transform(words, lambda w: {first}) AS template, list_transform(words, lambda w: {bare}) AS plain,
        list_transform(words, lambda w: CASE WHEN starts_with(w, chr(4)) THEN chr(1) ELSE {first} END) AS named,
        list_transform(words, lambda w: CASE WHEN NOT starts_with(w, chr(4)) THEN w
            WHEN ({_typed('w[2:]')}) = chr(3) THEN w[2:] ELSE chr(1) || w[2:] END) AS shown
    FROM (SELECT row_number() OVER () AS k, {key}, text, regexp_extract_all(translate(lower({marked}), '{decontam.PUNCTUATION}', ''), '{WORD}') AS words
    FROM (SELECT DISTINCT {key}, coalesce(text, '') AS text FROM {table})))"""


def _spots(table: str) -> str:
    """Windows of all readings by position; sure: of a reading that takes only names within sentences."""
    return " UNION ".join(f"SELECT k, generate_subscripts({w}, 1) AS pos, unnest({w}) AS h, {sure} AS sure FROM {table}" for w, sure in (("wt", True), ("wp", True), ("wn", False)))


OP3 = f"""
WITH d AS MATERIALIZED ({_template("documents", "doc_id")}),
i AS MATERIALIZED (SELECT * FROM ({_template("benchmark", "item_id")}) WHERE len(words) > 0),
spots AS MATERIALIZED (
    {_spots("i")}
    UNION SELECT k, 1, array_to_string(list_prepend(chr(1), template[2:5]), ' '), true FROM i WHERE regexp_matches(text, '{decontam._CAPITAL_FIRST}')),
held AS (SELECT DISTINCT k, h FROM (SELECT k, unnest(list_concat(list_concat(wt, wp), wn)) AS h FROM d)),
found AS MATERIALIZED (
    SELECT held.k AS dk, spots.k AS ik, any_value(ceil(len(i.wt) * CAST({decontam.CONTAINED} AS DOUBLE))) AS needed
    FROM held JOIN spots USING (h) JOIN i ON i.k = spots.k
    GROUP BY ALL HAVING count(DISTINCT pos) >= any_value(ceil(len(i.wt) * CAST({decontam.CONTAINED} AS DOUBLE)))),
hit AS MATERIALIZED (SELECT * FROM d WHERE k IN (SELECT dk FROM found)),
doc_spots AS MATERIALIZED ({_spots("hit")}),
meets AS MATERIALIZED (
    SELECT dk, ik, a.pos AS q, b.pos AS p, bool_or(a.sure AND b.sure) AS sure
    FROM found JOIN doc_spots b ON b.k = dk JOIN spots a ON a.k = ik AND a.h = b.h GROUP BY ALL),
shifts AS (SELECT dk, ik, p - q AS shift, count(*) AS n FROM meets GROUP BY ALL),
best AS (SELECT dk, ik, arg_max(shift, n * 1000000000 - shift) AS shift FROM shifts GROUP BY ALL),
told AS (SELECT dk, ik, count(DISTINCT q) FILTER (WHERE sure) AS n FROM meets GROUP BY ALL),
places AS (
    SELECT dk, ik, i.shown[p] AS a, hit.shown[p + shift] AS b, i.named[p] = chr(1) AND hit.named[p + shift] = chr(1) AS capital,
        i.template[p] IN (chr(1), chr(2), chr(3)) AND hit.template[p + shift] = i.template[p] AS typed
    FROM (SELECT dk, ik, shift, unnest(range(1, len(words) + 1)) AS p FROM best JOIN i ON i.k = ik)
    JOIN i ON i.k = ik JOIN hit ON hit.k = dk WHERE p + shift >= 1 AND p + shift <= len(hit.words)),
slots AS (SELECT dk, ik, a, b, typed FROM places WHERE typed OR (capital AND a <> b)),
judged AS (
    SELECT dk, ik, count(DISTINCT (a, b)) - count(DISTINCT a) AS clash, count(*) AS n, bool_and(a = b) AS exact,
        count(DISTINCT (a, b)) FILTER (WHERE typed) - count(DISTINCT a) FILTER (WHERE typed) AS typed_clash, count(*) FILTER (WHERE typed) AS typed_n
    FROM slots GROUP BY ALL),
kept AS (
    SELECT d.doc_id, d.text, count(*) AS n_items, count(*) FILTER (WHERE NOT coalesce(exact, true)) AS n_changed,
        array_to_string(list_sort(list(i.item_id)), ',') AS item_ids
    FROM found JOIN told USING (dk, ik) LEFT JOIN judged USING (dk, ik) JOIN d ON d.k = dk JOIN i ON i.k = ik
    WHERE coalesce(clash, 0) <= {1 - decontam.CONTAINED} * coalesce(judged.n, 0)
        OR (told.n >= needed AND coalesce(typed_clash, 0) <= {1 - decontam.CONTAINED} * coalesce(typed_n, 0))
    GROUP BY ALL)
SELECT documents.doc_id, kept.n_items IS NOT NULL AS contaminated, coalesce(n_items, 0) AS n_items,
    coalesce(n_changed, 0) AS n_changed, coalesce(item_ids, '') AS item_ids
FROM documents LEFT JOIN kept ON kept.doc_id IS NOT DISTINCT FROM documents.doc_id AND kept.text = coalesce(documents.text, '')"""


def _backoff(order: int) -> str:
    """Grams of every order by document, counts of all others, and the longest that the others hold at each word."""
    grams = " UNION ALL ".join(
        f"SELECT doc_id, {n} AS n, j + {n - 1} AS spot, array_to_string(l[j:j + {n - 1}], ' ') AS g, array_to_string(l[j:j + {n - 2}], ' ') AS c "
        f"FROM (SELECT doc_id, l, unnest(range(1, len(l) - {n} + 2)) AS j FROM w)"
        for n in range(1, order + 1)
    )
    return f"""
WITH w AS (SELECT doc_id, {_WORDS} AS l FROM documents),
total AS (SELECT sum(len(l)) AS words FROM w),
grams AS ({grams}),
own AS (SELECT doc_id, n, g, count(*) AS k FROM grams GROUP BY ALL),
everyone AS (SELECT n, g, sum(k) AS k FROM own GROUP BY ALL),
others AS (SELECT doc_id, n, g, everyone.k - own.k AS k FROM own JOIN everyone USING (n, g)),
steps AS (
    SELECT grams.doc_id, grams.n, grams.spot, o.k, CASE WHEN grams.n > 1 THEN c.k ELSE words - len(l) END AS under, words - len(l) AS rest
    FROM grams JOIN others o ON o.doc_id = grams.doc_id AND o.n = grams.n AND o.g = grams.g JOIN w ON w.doc_id = grams.doc_id, total
    LEFT JOIN others c ON c.doc_id = grams.doc_id AND c.n = grams.n - 1 AND c.g = grams.c),
longest AS (SELECT doc_id, spot, max(n) AS tried, coalesce(max(n) FILTER (WHERE k > 0), 1) AS held FROM steps GROUP BY ALL),
scores AS (
    SELECT doc_id, spot, tried, held, (tried - held) * ln({lm.BACKOFF}) + CASE WHEN k > 0 THEN ln(k / under) ELSE ln(1 / (rest + 1)) END AS score
    FROM longest JOIN steps USING (doc_id, spot) WHERE steps.n = held)
SELECT w.doc_id, len(any_value(l)) AS n_words, round(coalesce(sum(score), 0), 3) AS log_score,
    round(sum(score) / len(any_value(l)), 6) AS mean_log_score, count(*) FILTER (WHERE tried > held) AS n_backed_off
FROM w LEFT JOIN scores USING (doc_id) GROUP BY w.doc_id"""


def _hosts() -> str:
    rules = sorted(urls.HOST_RULES, key=lambda rule: -len(rule[0]))
    split = [(rule, rule.partition("/")[0], "/" + rule.partition("/")[2], verdict) for rule, verdict in rules]
    fits = [f"('.' || host) LIKE '%.{host}' AND starts_with(path, '{path}')" for _, host, path, _ in split]
    rule = " ".join(f"WHEN {fit} THEN '{name}'" for fit, (name, *_) in zip(fits, split, strict=True))
    verdict = " ".join(f"WHEN rule = '{name}' THEN '{say}'" for name, _, _, say in split)
    like = lambda glob: glob.replace("*", "%").replace("?", "_").replace("|", "' || chr(1) || '")
    glob = " ".join(f"WHEN whole LIKE '{like(g)}' THEN '{g}'" for g in urls.BLOCKED_GLOBS)
    return f"""
WITH rest AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substring(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
judged AS (SELECT *, CASE {rule} END AS rule, CASE {glob} END AS pattern FROM (SELECT *, '.' || host || chr(1) || path AS whole FROM parts))
SELECT page_id, host, path, rule, CASE {verdict} WHEN pattern IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict, pattern FROM judged"""


_K = substrings.WINDOW
OP10 = f"""
WITH w AS (SELECT doc_id, {_WORDS} AS l FROM documents),
spots AS (SELECT doc_id, i, md5(array_to_string(l[i:i + {_K - 1}], ' ')) AS h FROM (SELECT doc_id, l, unnest(range(1, len(l) - {_K} + 2)) AS i FROM w)),
least AS (SELECT h, min(doc_id) AS first FROM spots GROUP BY h),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + {_K})) AS p FROM spots JOIN least USING (h) WHERE first < doc_id),
lost AS (SELECT doc_id, count(*) AS n, list(p) AS ps FROM gone GROUP BY doc_id)
SELECT w.doc_id, len(l) AS n_words, coalesce(n, 0) AS n_removed,
    sha256(array_to_string(CASE WHEN n IS NULL THEN l ELSE list_transform(list_filter(range(1, len(l) + 1), lambda p: NOT list_contains(ps, p)), lambda p: l[p]) END, ' ')) AS kept_sha256
FROM w LEFT JOIN lost USING (doc_id)"""

ORACLE = {
    "op2_stupid_backoff": _backoff(lm.ORDER),
    "op3_template_windows": OP3,
    "op9_url_automaton": _hosts(),
    "op10_block_anchors": OP10,
}
