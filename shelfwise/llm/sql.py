"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from shelfwise.llm import collocations
from shelfwise.llm.chat_rotation import CLOSE, NOBODY, OPEN, SYSTEM
from shelfwise.llm.rule_ledger import POLICIES, RULES, WINDOW, policy_mask
from shelfwise.llm.temperature_mix import BLOCK_DOCS, Target

WORDS = r"list_filter(string_split_regex({}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


def op2() -> str:
    return f"""
WITH speakers AS (
    SELECT DISTINCT conv_id, role AS speaker FROM conversations WHERE role IS NOT NULL AND role <> '{SYSTEM}'),
seen AS (
    SELECT c.conv_id, speaker, turn, role, coalesce(text, '') AS text,
           CASE WHEN role = '{SYSTEM}' THEN {_quote(OPEN + 'system' + chr(10))}
                WHEN role = speaker THEN {_quote(OPEN + 'assistant' + chr(10))}
                ELSE {_quote(OPEN + 'user name=')} || regexp_replace(coalesce(role, '{NOBODY}'), '[\\s<>|]', '_', 'g') || chr(10) END AS header,
           coalesce(role = speaker, FALSE) AS learn
    FROM conversations c JOIN speakers s ON c.conv_id IS NOT DISTINCT FROM s.conv_id),
shown AS (SELECT *, header || replace(text, '<|', '< |') || {_quote(CLOSE)} AS rendered FROM seen),
placed AS (
    SELECT *, coalesce(sum(length(rendered)) OVER (
        PARTITION BY conv_id, speaker ORDER BY turn NULLS FIRST, role NULLS FIRST, text
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
    FROM shown)
SELECT conv_id, speaker, turn, role, start, start + length(header) AS learn_start,
       CASE WHEN learn THEN start + length(rendered) - 1 ELSE start + length(header) END AS learn_end, learn, md5(rendered) AS rendered_md5
FROM placed"""


def op3() -> str:
    target = Target()
    search = """
    SELECT 0.0::DOUBLE AS low, 1.0::DOUBLE AS high, 0 AS step
    UNION ALL
    SELECT CASE WHEN {0} THEN mid ELSE low END, CASE WHEN {0} THEN high ELSE mid END, step + 1
    FROM (SELECT *, list_sum(list_transform(ps, lambda x: pow(x, mid))) AS z, list_sum(list_transform(ps, lambda x: pow(x, mid) * ln(x))) AS s
          FROM (SELECT *, CASE WHEN step = 0 THEN 1.0 ELSE (low + high) / 2 END AS mid FROM {1}), ps)
    WHERE step < 48 AND low < 1"""
    entropy = search.format(f"ln(z) - mid * s / z >= {target.entropy} * ln(len(ps))", "to_entropy")
    repeats = search.format(f"{target.budget} * pow(list_min(ps), mid - 1) / z > {target.repeats}", "to_repeats")
    return f"""
WITH RECURSIVE own AS (
    SELECT doc_id, source, len({WORDS.format("coalesce(text, '')")}) AS tokens, coalesce('=' || source, 'null') AS key,
           md5(concat_ws('|', coalesce(doc_id::VARCHAR, 'null'), md5(coalesce(text, '')))) AS mark
    FROM documents),
totals AS (SELECT key, sum(tokens)::BIGINT AS tokens, count(*) AS docs FROM own GROUP BY key HAVING sum(tokens) > 0),
shares AS (SELECT *, tokens / (SELECT sum(tokens) FROM own)::DOUBLE AS p FROM totals),
ps AS (SELECT list(p) AS ps FROM shares),
to_entropy AS ({entropy}),
to_repeats AS ({repeats}),
alpha AS (SELECT round(greatest((SELECT max(low) FROM to_entropy), (SELECT max(low) FROM to_repeats)), 6) AS a),
weighed AS (SELECT *, pow(p, a) / (SELECT sum(pow(p, a)) FROM shares, alpha) AS w FROM shares, alpha),
sources AS (
    SELECT *, quota // tokens AS passes, quota % tokens AS rest, ceil(docs / {float(BLOCK_DOCS)})::BIGINT AS blocks
    FROM (SELECT *, floor(w * ({target.budget} * (SELECT sum(tokens) FROM own)) + 1e-6)::BIGINT AS quota FROM weighed)),
passes AS (
    SELECT own.*, passes, rest, unnest(range(0, passes + 1)) AS pass, ('0x' || substr(mark, 1, 8))::BIGINT % blocks AS block
    FROM own JOIN sources USING (key)),
drawn AS (SELECT *, md5(concat_ws('|', '0', pass, mark)) AS turn FROM passes WHERE pass < passes OR rest > 0),
sums AS (SELECT key, pass, block, sum(tokens) AS tokens, md5(concat_ws('|', '0', pass, key, block)) AS turn FROM drawn GROUP BY ALL),
starts AS (
    SELECT key, pass, block, sum(tokens) OVER (PARTITION BY key, pass ORDER BY turn, block) - tokens AS block_start FROM sums),
placed AS (
    SELECT d.*, (block_start + sum(d.tokens) OVER (
        PARTITION BY key, pass, block ORDER BY d.turn, mark ROWS UNBOUNDED PRECEDING) - d.tokens)::BIGINT AS start
    FROM drawn d JOIN starts USING (key, pass, block))
SELECT doc_id, source, pass, block, start, tokens::BIGINT AS n_tokens FROM placed WHERE pass < passes OR 2 * start + tokens <= 2 * rest"""


def op4() -> str:
    bits = " + ".join(f"CASE WHEN {rule.fails} THEN {1 << i} ELSE 0 END" for i, rule in enumerate(RULES))
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (
    SELECT r, doc_id, t, {WORDS.format('t')} AS ws,
           list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls
    FROM d),
windows AS (SELECT r, i, array_to_string(ws[i:i + {WINDOW - 1}], ' ') AS win FROM (SELECT r, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM w)),
again AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, win) > 1),
covered AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(range(i, i + {WINDOW})) AS j FROM again) GROUP BY r),
m AS (
    SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
           length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(ls)::BIGINT AS n_lines,
           (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
           len(list_filter(ws, lambda x: regexp_matches(x, '[A-Z]') AND NOT regexp_matches(x, '[a-z]')))::BIGINT AS n_caps_words,
           (length(t) - length(replace(t, '!', '')))::BIGINT AS n_bangs,
           len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1]))::BIGINT AS n_stutters
    FROM w LEFT JOIN covered USING (r)),
f AS (SELECT *, ({bits})::BIGINT AS failed_bits FROM m)
SELECT *, failed_bits & {policy_mask(POLICIES['base'])} <> 0 AS base_failed, failed_bits & {policy_mask(POLICIES['v2'] + POLICIES['base'])} = 0 AS kept FROM f"""


def op13() -> str:
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(string_split_regex(translate(coalesce(text, ''), '{letters}', '{letters.lower()}'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents),
ws AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM pieces),
totals AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM ws GROUP BY lang),
sizes AS (SELECT unnest(range(1, {collocations.DEPTH + 1})) AS k),
f AS (
    SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*) AS f
    FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM ws, sizes WHERE len(ws) >= k)
    GROUP BY ALL HAVING count(*) >= {collocations.MIN_COUNT}),
c AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS p FROM f WHERE k > 1),
cuts AS (SELECT *, unnest(range(1, k)) AS cut FROM c),
scored AS (
    SELECT cuts.lang, cuts.phrase, cuts.a, cut, l.f AS l, r.f AS r, ((2000000::HUGEINT * cuts.a) // (l.f + r.f))::BIGINT AS score
    FROM cuts JOIN f l ON l.lang = cuts.lang AND l.phrase = array_to_string(p[1:cut], ' ')
    JOIN f r ON r.lang = cuts.lang AND r.phrase = array_to_string(p[cut + 1:], ' ')),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_phrases AS (
    SELECT lang, array_to_string(p[i:i + many - 1], ' ') AS phrase, max(a) AS longer
    FROM (SELECT *, unnest(range(1, k - many + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS many FROM c WHERE k > 2)) GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best JOIN totals USING (lang) LEFT JOIN inner_phrases USING (lang, phrase)
WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a
QUALIFY rank <= {collocations.TOP}"""


def llm_sql() -> dict[str, str]:
    return {"op2_chat_rotation": op2(), "op3_temperature_mix": op3(), "op4_rule_ledger": op4(), "op13_collocations": op13()}
