"""DuckDB SQL for the results of registered queries, where SQL can express them."""

from __future__ import annotations

from . import chat_format, mixing, quality_rules, url_filter

_SPACE = r"[\x20\x09-\x0D]+"


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def chats(probe: str, template: chat_format.Template = chat_format.LLAMA) -> str:
    escaped = "replace(text, '\\', '\\\\')"
    for m in sorted(template.marks(), key=len, reverse=True):
        escaped = f"replace({escaped}, {text(m)}, {text(m[0] + chr(92) + m[1:])})"
    role = escaped.replace("replace(text,", "replace(role,")
    marks = " ".join(f"WHEN {text(r)} THEN {len(a) + len(b)}" for r, (a, b, _) in template.turns.items())
    lossy = ", ".join(text(r) for r, x in template.turns.items() if x[2])
    allowed = " OR ".join(f"(before IS {'NULL' if a is None else 'NOT DISTINCT FROM ' + text(a)} AND role IN "
                          f"({', '.join(map(text, b))}))" for a, b in template.after.items())
    return f"""WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', {text(probe)} UNION ALL SELECT -1, 1, 'assistant', {text(probe)}),
written AS (
  SELECT *, {escaped} AS escaped, {role} AS escaped_role,
    lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role IN ({lossy})), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role IN ({lossy})), '')) AS loss_sha256,
  CAST(sum(length(escaped) + CASE role {marks} ELSE {sum(map(len, template.other))} + length(escaped_role) END) AS BIGINT)
    AS formatted_chars,
  count(*) FILTER (NOT ({allowed})) AS n_bad_turns,
  last(role ORDER BY turn NULLS FIRST, role, text) IN ({', '.join(map(text, template.final))}) AS complete
FROM written GROUP BY conv_id"""


def urls() -> str:
    rules = " ".join(
        f"WHEN (host = {text(h)} OR ends_with(host, {text('.' + h)})) AND starts_with(path, {text('/' + p)}) THEN {text(r)}"
        for _, r in sorted(url_filter.RULES, key=lambda x: -len(x[1])) for h, _, p in [r.partition("/")])
    actions = " ".join(f"WHEN {text(r)} THEN {text(a)}" for a, r in url_filter.RULES)
    weights = dict(sorted({**url_filter.SOFT, **dict.fromkeys(url_filter.STRICT, url_filter.SOFT_LIMIT)}.items()))
    found = {t: f"regexp_matches(lower(url), '(^|[^\\p{{L}}\\p{{N}}]){t}($|[^\\p{{L}}\\p{{N}}])')" for t in weights}
    weight = " + ".join(f"CASE WHEN {c} THEN {weights[t]} ELSE 0 END" for t, c in found.items())
    listed = ", ".join(f"CASE WHEN {c} THEN {text(t)} END" for t, c in found.items())
    return f"""WITH cut AS (SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (SELECT page_id, url,
  translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
ruled AS (SELECT page_id, url, host, path, CASE {rules} END AS rule FROM parts),
hits AS (SELECT *, {weight} AS weight, array_to_string(list_filter([{listed}], lambda t: t IS NOT NULL), ',') AS terms
  FROM ruled)
SELECT page_id, host, path, rule, coalesce(CASE rule {actions} END,
  CASE WHEN weight >= {url_filter.SOFT_LIMIT} THEN 'block' ELSE 'allow' END) AS verdict, coalesce(terms, '') AS terms
FROM hits"""


def quality() -> str:
    q = quality_rules
    vocabulary = ", ".join(text(w) for w in q.common_words())
    peel, counts = "joined", []
    for _, pattern in q.CLASSES:
        rest = f"regexp_replace({peel}, {text(pattern)}, '', 'g')"
        counts.append(f"length({peel}) - length({rest})")
        peel = rest
    counts.append(f"length({peel})")
    n_common = len(q.common_words()) + 1

    def distance(a: str, b: str) -> str:
        def part(x: str, y: str) -> str:
            return f"CASE WHEN {x} > 0 THEN {x} * log2(2 * {x} / ({x} + {y})) ELSE 0 END"
        both = f"list_transform(list_zip({a}, {b}), lambda z: {part('z[1]', 'z[2]')} + {part('z[2]', 'z[1]')})"
        return f"sqrt(greatest(list_sum({both}) / 2, 0))"

    def shares(x: str) -> str:
        return f"list_transform({x}, lambda v: CASE WHEN list_sum({x}) > 0 THEN v / list_sum({x}) ELSE 0 END)"

    def total(x: str, n: int) -> str:
        return "[" + ", ".join(f"avg({x}[{i}])" for i in range(1, n + 1)) + "]"

    return f"""WITH words AS (SELECT row_number() OVER () AS rn, doc_id, lang, coalesce(text, '') AS text,
  list_filter(regexp_split_to_array(coalesce(text, ''), {text(_SPACE)}), lambda w: w <> '') AS w FROM documents),
windows AS (SELECT rn, p, array_to_string(w[p:p + 2], ' ') AS shingle
  FROM (SELECT rn, w, unnest(range(1, len(w) - 1)) AS p FROM words WHERE len(w) >= 3)),
twice AS (SELECT rn, p FROM (SELECT rn, p, count(*) OVER (PARTITION BY rn, shingle) AS n FROM windows) WHERE n > 1),
repeated AS (SELECT rn, count(DISTINCT p + o) AS n FROM twice, (VALUES (0), (1), (2)) offsets(o) GROUP BY rn),
joined AS (SELECT *, array_to_string(w, '') AS joined, list_filter(string_split(text, chr(10)),
  lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines, list_transform(w, lambda x: lower(x)) AS low FROM words),
features AS (SELECT rn, doc_id, lang, len(w) AS n_words, length(joined) AS word_chars, [{', '.join(counts)}] AS chars,
  len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
  list_append(list_transform([{vocabulary}], lambda v: len(list_filter(low, lambda x: x = v))),
    len(list_filter(low, lambda x: NOT list_contains([{vocabulary}], x)))) AS common
  FROM joined LEFT JOIN repeated r USING (rn)),
shared AS (SELECT lang, {shares('chars')} AS c, {shares('common')} AS w FROM features WHERE n_words > 0),
refs AS (SELECT lang, {total('c', len(counts))} AS chars, {total('w', n_common)} AS common FROM shared GROUP BY lang),
judged AS (SELECT f.*, f.n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.MAX_REPEAT_PERCENT} * f.n_words AS base_failed,
  {distance(shares('f.chars'), 'r.chars')} AS char_distance,
  {distance(shares('f.common'), 'r.common')} AS word_distance
  FROM features f LEFT JOIN refs r ON f.lang IS NOT DISTINCT FROM r.lang)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(chars[{1 + [c for c, _ in q.CLASSES].index('symbol')}] AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  round(char_distance, 6) AS char_distance, round(word_distance, 6) AS word_distance,
  NOT base_failed AND NOT (n_words >= {q.MIN_COMPARED_WORDS} AND word_distance > {q.MAX_WORD_DISTANCE}
    OR word_chars >= {q.MIN_COMPARED_CHARS} AND char_distance > {q.MAX_CHAR_DISTANCE}) AS kept
FROM judged"""


def jaccard(words: int = 5, percent: int = 75) -> str:
    return f"""WITH RECURSIVE words AS (SELECT doc_id, list_filter(regexp_split_to_array(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {text(_SPACE)}),
  lambda w: w <> '') AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + {words - 1}], ' ') AS s FROM (
  SELECT doc_id, w, unnest(range(1, greatest(len(w) - {words - 2}, 2))) AS p FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM shingles a JOIN shingles b USING (s)
  WHERE a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT x, y FROM common c JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
  WHERE 100 * c.n >= {percent} * (a.n + b.n - c.n)),
both_ways AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reached(doc_id, seen) AS (SELECT doc_id, doc_id FROM documents
  UNION SELECT r.doc_id, l.y FROM reached r JOIN both_ways l ON l.x = r.seen)
SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, m.least AS component_id FROM documents d
  LEFT JOIN sizes s USING (doc_id) JOIN (SELECT doc_id, min(seen) AS least FROM reached GROUP BY doc_id) m USING (doc_id)"""


def mixture() -> str:
    m = mixing

    def uniform(*parts: str) -> str:
        return (f"CAST(('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 13))::UBIGINT AS DOUBLE)"
                f" / {float(1 << 52)!r}e0")

    return f"""WITH RECURSIVE sizes AS (SELECT source, CAST(coalesce(sum(length(text)), 0) AS BIGINT) AS n_chars FROM documents
  GROUP BY source),
weighed AS (SELECT *, pow(CAST(n_chars AS DOUBLE), CAST({m.POWER} AS DOUBLE)) AS weight FROM sizes),
rated AS (SELECT source, CASE WHEN n_chars > 0 THEN CAST({m.EPOCHS} AS DOUBLE) * (SELECT sum(n_chars) FROM sizes) * weight
  / (SELECT sum(weight) FROM weighed WHERE n_chars > 0) / n_chars ELSE {m.EPOCHS} END AS rate FROM weighed),
parted AS (SELECT source, rate, greatest(CAST(ceil(rate / {m.PART_MEAN}) AS INTEGER), 1) AS parts FROM rated),
terms(source, parts, mean, k, term, total) AS (
  SELECT source, parts, rate / parts, 0, exp(-(rate / parts)), exp(-(rate / parts)) FROM parted
  UNION ALL SELECT source, parts, mean, k + 1, term * mean / (k + 1), total + term * mean / (k + 1) FROM terms
  WHERE k < {m.TERMS}),
draws AS (SELECT rn, d.source, unnest(range(1, parts + 1)) AS j, d.doc_id FROM
  (SELECT row_number() OVER () AS rn, doc_id, source FROM documents) d JOIN parted p ON d.source IS NOT DISTINCT FROM p.source),
counted AS (SELECT rn, count(t.k) AS n FROM (SELECT *, {uniform("'" + str(m.SEED) + "'", "'count'",
        "coalesce(CAST(doc_id AS VARCHAR), 'null')", 'CAST(j AS VARCHAR)')} AS u FROM draws) d
  JOIN terms t ON d.source IS NOT DISTINCT FROM t.source AND t.total <= d.u GROUP BY rn),
copies AS (SELECT d.* EXCLUDE (rn), CAST(unnest(range(1, n + 1)) AS BIGINT) AS copy
  FROM (SELECT row_number() OVER () AS rn, * FROM documents) d JOIN counted USING (rn))
SELECT *, CAST(('0x' || substr(md5(concat_ws('|', '{m.SEED}', 'order', coalesce(CAST(doc_id AS VARCHAR), 'null'),
  CAST(copy AS VARCHAR))), 1, 15))::UBIGINT AS BIGINT) AS shuffle_key FROM copies"""
