"""DuckDB SQL equal to the registered queries, where SQL can express them."""

from __future__ import annotations

from ledgerline.llm import katz, resampling, spelling, url_filters
from ledgerline.llm.quality_rules import RULES, STOP_WORDS
from ledgerline.llm.queries import URL_RULES

OP1 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
escaped AS (
  SELECT *, 4 + length(regexp_replace(regexp_replace(regexp_replace(role, '<(\\*)/turn>', '<\\\1/turn>', 'g'),
                '###(\\*) ', '###\\\1 ', 'g'), ':(\\*) ', ':\\\1 ', 'g')) + 2
    + length(regexp_replace(regexp_replace(text, '<(\\*)/turn>', '<\\\1/turn>', 'g'), '###(\\*) ', '###\\\1 ', 'g')) + 8 AS chars
  FROM turns),
listed AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS whole,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
    sum(chars) AS chars
  FROM escaped GROUP BY conv_id)
SELECT conv_id, n_turns::BIGINT AS n_turns, sha256(whole) AS turns_sha256, length(loss)::BIGINT AS loss_chars,
  sha256(loss) AS loss_sha256, chars::BIGINT AS formatted_chars FROM listed
"""


def quality_ctes(source: str, name: str) -> str:
    """CTE ``name``: rid and the measures of the rows of a table with doc_id and text."""
    stops = ", ".join(f"'{w}'" for w in STOP_WORDS)
    return rf"""
{name}_text AS (SELECT *, row_number() OVER () AS rid, coalesce(text, '') AS t FROM {source}),
{name}_words AS (
  SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
    list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM {name}_text),
{name}_windows AS (
  SELECT rid, i, words[i] || ' ' || words[i+1] || ' ' || words[i+2] || ' ' || words[i+3] || ' ' || words[i+4] AS w
  FROM (SELECT rid, words, unnest(range(1, len(words) - 3)) AS i FROM {name}_words)),
{name}_twice AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, w) AS n FROM {name}_windows) WHERE n > 1),
{name}_repeats AS (
  SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + 5)) AS p FROM {name}_twice) GROUP BY rid),
{name}_counts AS (
  SELECT x.*, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
    len(list_filter(words, lambda w: lower(w) IN ({stops}))) AS stops, len(lines) AS n_lines
  FROM {name}_words x LEFT JOIN {name}_repeats r USING (rid)),
{name}_ratios AS (
  SELECT *, CASE WHEN n_words > 0 THEN n_repeat_words / n_words ELSE 0.0 END AS repeat_ratio,
    CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0.0 END AS mean_word_length,
    CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0.0 END AS symbol_ratio,
    CASE WHEN n_words > 0 THEN stops / n_words ELSE 0.0 END AS stop_ratio,
    CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0.0 END AS dup_line_ratio,
    n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed
  FROM {name}_counts),
{name} AS (
  SELECT *, NOT base_failed AND broken = '' AS kept FROM (
    SELECT *, array_to_string(list_filter([{_checks()}], lambda x: x IS NOT NULL), ',') AS broken FROM {name}_ratios))"""


def _checks() -> str:
    found = []
    for r in RULES:
        out = [f"{r.measure} < {r.least}"] * (r.least is not None) + [f"{r.measure} > {r.most}"] * (r.most is not None)
        found.append(f"CASE WHEN ({' OR '.join(out)}) AND n_words >= {r.from_words} THEN '{r.name}' END")
    return ", ".join(found)


OP8 = f"""
WITH {quality_ctes("documents", "judged")}
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed, kept, broken FROM judged
"""

def _url_sql() -> str:
    u = url_filters
    levels = [f"t{k}" for k in range(u.DEPTH + 1)]
    firsts = [f"g{k}" for k in range(u.DEPTH + 1)]
    named = ", ".join(f"coalesce(cut[{k + 1}], '') AS g{k}" for k in range(u.DEPTH))
    ctes = [rf"""
labelled AS (SELECT doc_id, max((quality = 0 OR toxic = 1)::INT) AS bad FROM labels GROUP BY doc_id),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{u.UPPER}', '{u.LOWER}') AS host,
    regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages)),
cuts AS (
  SELECT *, list_transform(list_filter(string_split(path, '/'), lambda s: s <> ''), lambda s:
      CASE WHEN regexp_matches(regexp_replace(s, '\.[A-Za-z]{{2,5}}$', ''), '{u.VARIABLE}') THEN '*' ELSE s END) AS cut,
    TRY_CAST(regexp_extract(path, '/([0-9]{{1,18}})(?:[./]|$)', 1) AS BIGINT) AS doc_id FROM parts),
urls AS (
  SELECT page_id, host, path, {named}, CASE WHEN len(cut) > {u.DEPTH} THEN '**' ELSE '' END AS g{u.DEPTH}, l.bad
  FROM cuts c LEFT JOIN labelled l ON l.doc_id = c.doc_id),
tree_0 AS (
  SELECT host, {', '.join(firsts)}, {', '.join(f'{g} AS {t}' for g, t in zip(firsts, levels))}, count(*) AS n,
    count(bad) AS labelled, count(*) FILTER (bad = 1) AS bad FROM urls GROUP BY ALL)"""]
    for step in range(2 * u.DEPTH):
        k, last, here = step % u.DEPTH, f"tree_{step}", f"tree_{step + 1}"
        parent, key = ", ".join(["host", *levels[:k]]), ", ".join(["host", *levels[:k + 1]])
        if step < u.DEPTH:
            marked, sums = "*", "sum(n) AS c"
            window = f"sum(c) OVER p AS whole, count(*) OVER p AS siblings"
            rule = f"siblings >= {u.MANY_SIBLINGS} AND c < {u.RARE_SHARE} * whole"
        else:
            marked, sums = "~", "sum(labelled)::DOUBLE AS l, sum(bad)::DOUBLE AS b"
            window = "sum(l) OVER p AS ls, sum(b) OVER p AS bs, count(*) OVER p AS siblings"
            gap = "abs(b / l - (bs - b) / (ls - l))"
            error = "sqrt((bs / ls) * (1 - bs / ls) * (1 / l + 1 / (ls - l)))"
            rule = f"siblings > 1 AND NOT CASE WHEN l > 0 AND ls - l > 0 THEN {gap} > {u.SIGNIFICANT} * {error} ELSE false END"
        ctes.append(f"""
mark_{step} AS (
  SELECT {key} FROM (SELECT *, {window} FROM (SELECT {key}, {sums} FROM {last} GROUP BY ALL) WINDOW p AS (PARTITION BY {parent}))
  WHERE {levels[k]} <> '' AND {rule}),
{here} AS (
  SELECT t.* REPLACE (CASE WHEN m.host IS NOT NULL THEN '{marked}' ELSE t.{levels[k]} END AS {levels[k]})
  FROM {last} t LEFT JOIN mark_{step} m ON {' AND '.join(f't.{c} = m.{c}' for c in ['host', *levels[:k + 1]])})""")
    fits = lambda r: f"((host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}'))"
    ordered = sorted(URL_RULES, key=lambda r: (-len(r.name), r.name))
    case = lambda field: "CASE " + " ".join(f"WHEN {fits(r)} THEN '{getattr(r, field)}'" for r in ordered)
    leaf = ", ".join(["host", *levels])
    listed = ", ".join(levels)
    return f"""
WITH {','.join(ctes)},
shares AS (
  SELECT *, (sum(bad) OVER (PARTITION BY {leaf}) + {u.PRIOR} * host_share) / (sum(labelled) OVER (PARTITION BY {leaf}) + {u.PRIOR}) AS share
  FROM (SELECT *, (sum(bad) OVER (PARTITION BY host) + {u.PRIOR} * coalesce(sum(bad) OVER () / nullif(sum(labelled) OVER (), 0), 0))
      / (sum(labelled) OVER (PARTITION BY host) + {u.PRIOR}) AS host_share FROM tree_{2 * u.DEPTH}))
SELECT page_id, host, path, {case('name')} END AS rule,
  {case('verdict')} WHEN share > {u.REJECT} THEN 'block' ELSE 'allow' END AS verdict,
  '/' || array_to_string(list_filter([{listed}], lambda t: t <> ''), '/') AS template, round(share, 6) AS bad_share
FROM urls JOIN shares USING (host, {', '.join(firsts)})
"""


OP10 = _url_sql()

#: The table of CRC-32 by its rule: eight steps for each byte.
CRC_TABLE = """crc_table AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda x, k: xor(x >> 1, 3988292384 * (x & 1))) ORDER BY i) AS crc_steps FROM range(256) r(i))"""


def crc32_sql(text: str) -> str:
    """CRC-32 of the UTF-8 bytes of a text, in a query that also reads ``crc_table``."""
    octets = f"list_transform(range(1, 1 + strlen({text})), lambda i: ('0x' || substr(hex(encode({text})), 2 * i - 1, 2))::BIGINT)"
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, {octets}), "
            "lambda c, b: xor(c >> 8, crc_steps[(xor(c, b) & 255) + 1])), 4294967295)")


def lower_sql(text: str) -> str:
    return f"translate({text}, '{spelling.UPPER}', '{spelling.LOWER}')"


def _lost_sql(level: str, counts: str) -> str:
    """CTE: what a count r of 1 to GT_UP_TO loses, from a table of kinds with their counts n."""
    top = katz.GT_UP_TO
    return f"""
{level}_kinds AS (
  SELECT r, (SELECT count(*) FROM {counts} WHERE n = r) AS k, (SELECT count(*) FROM {counts} WHERE n = r + 1) AS k_next FROM range(1, {top + 1}) x(r)),
{level}_rest AS (
  SELECT CASE WHEN ones > 0 THEN ({top + 1} * many)::DOUBLE / ones ELSE 1.0 END AS rest FROM (
    SELECT count(*) FILTER (n = 1) AS ones, count(*) FILTER (n = {top + 1}) AS many FROM {counts})),
{level}_lost AS (
  SELECT r, k, CASE WHEN kept > 0 AND kept < 1 THEN r * (1 - kept) ELSE 0.5 END AS e FROM (
    SELECT r, k, CASE WHEN rest < 1 THEN (CASE WHEN k > 0 THEN ((r + 1) * k_next)::DOUBLE / k / r ELSE 0.0 END - rest) / (1 - rest) ELSE 0.0 END AS kept
    FROM {level}_kinds, {level}_rest))"""


_LOG = f"round(log10({{}}) * {katz.PLACES})::BIGINT"

OP11 = f"""
WITH {CRC_TABLE},
texts AS (
  SELECT row_number() OVER () AS rid, doc_id, {crc32_sql("coalesce(doc_id::VARCHAR, '')")} % {katz.FOLDS} = {katz.HELD_OUT} AS held_out,
    list_filter(string_split_regex({lower_sql("coalesce(text, '')")}, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words FROM documents, crc_table),
tokens AS (
  SELECT rid, held_out, unnest(list_prepend(' ', words)) AS v, unnest(list_append(words, chr(10))) AS w FROM texts),
singles AS (SELECT w, count(*) AS n FROM tokens WHERE NOT held_out GROUP BY w),
pairs AS (SELECT v, w, count(*) AS n FROM tokens WHERE NOT held_out GROUP BY v, w),
sizes AS (SELECT coalesce(sum(n), 0)::BIGINT AS total, count(*) AS kinds FROM singles),
{_lost_sql("one", "singles")},
{_lost_sql("two", "pairs")},
unknown AS (
  SELECT CASE WHEN total > 0 THEN ((SELECT sum(k * e ORDER BY r) FROM one_lost)
    + (SELECT count(*) FROM singles WHERE n > {katz.GT_UP_TO}) * (SELECT e FROM one_lost WHERE r = {katz.GT_UP_TO})) / total ELSE 1.0 END AS p FROM sizes),
words AS (
  SELECT w, n, (n - e) / total AS p FROM singles, sizes, one_lost WHERE r = least(n, {katz.GT_UP_TO})),
histories AS (SELECT v, sum(n)::BIGINT AS n FROM pairs GROUP BY v),
followed AS (
  SELECT v, w, (pairs.n - e) / h.n AS p, e, h.n AS of FROM pairs JOIN histories h USING (v), two_lost WHERE r = least(pairs.n, {katz.GT_UP_TO})),
weights AS (SELECT v, sum(e) / max(of) / (1 - sum(words.p)) AS weight FROM followed JOIN words USING (w) GROUP BY v),
scored AS (
  SELECT rid, count(*) AS n_tokens, count(o.n) AS n_known,
    sum({_LOG.format("(coalesce(o.n, 0) + 0.5::DOUBLE) / (total + 0.5::DOUBLE * (kinds + 1))")})::BIGINT AS base,
    sum(CASE WHEN f.p IS NOT NULL THEN {_LOG.format("f.p")} ELSE
      {_LOG.format("coalesce(o.p, u.p)")} + coalesce({_LOG.format("h.weight")}, 0) END)::BIGINT AS score
  FROM tokens t LEFT JOIN words o ON t.w = o.w LEFT JOIN followed f ON t.v = f.v AND t.w = f.w LEFT JOIN weights h ON t.v = h.v, unknown u, sizes
  GROUP BY rid)
SELECT doc_id, held_out, n_tokens::BIGINT AS n_tokens, n_known::BIGINT AS n_known, total AS train_tokens,
  base::DOUBLE / {katz.PLACES} AS base_score, score::DOUBLE / {katz.PLACES} AS score
FROM texts JOIN scored USING (rid), sizes
"""

OP12 = f"""
WITH RECURSIVE {CRC_TABLE},
runs AS (
  SELECT doc_id, {lower_sql("run")} AS run, count(*) AS k FROM (
    SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[{spelling.LETTERS}]+')) AS run FROM documents)
  WHERE length(run) >= {spelling.LEAST_LETTERS} GROUP BY ALL),
hashed AS (SELECT run, k, {crc32_sql("(coalesce(doc_id::VARCHAR, '') || ':' || run)")} AS h FROM runs, crc_table),
words AS (
  SELECT word, sum(k)::BIGINT AS n FROM (
    SELECT CASE WHEN h % {spelling.SLIP} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, k FROM hashed)
  WHERE length(word) >= {spelling.LEAST_LETTERS} GROUP BY word HAVING sum(k) >= {spelling.LEAST_COUNT}),
holes AS (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS cut FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other FROM holes a JOIN holes b USING (i, cut) WHERE a.word <> b.word
  UNION SELECT h.word, w.word FROM holes h JOIN words w ON h.cut = w.word
  UNION SELECT w.word, h.word FROM holes h JOIN words w ON h.cut = w.word),
best AS (
  SELECT near.word, count(*) AS n_near, first(other ORDER BY n DESC, other) AS top, max(n) AS top_n
  FROM near JOIN words ON near.other = words.word GROUP BY near.word),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN top_n >= {spelling.RATIO} * w.n THEN top END AS form,
    CASE WHEN top_n >= {spelling.RATIO} * w.n THEN top_n END AS form_n FROM words w LEFT JOIN best b USING (word)),
steps AS (
  SELECT word, word AS here, 0 AS far FROM forms
  UNION ALL SELECT s.word, f.form, far + 1 FROM steps s JOIN forms f ON s.here = f.word WHERE f.form IS NOT NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN (SELECT word, arg_max(here, far) AS root FROM steps GROUP BY word) USING (word)
"""


def _features_sql(name: str, table: str) -> str:
    """CTE: row, words of the row, feature."""
    words = rf"regexp_extract_all({lower_sql("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
{name}_words AS (SELECT *, {words} AS words FROM (SELECT row_number() OVER () AS rid, * FROM {table})),
{name} AS (
  SELECT rid, unnest(words) AS f FROM {name}_words
  UNION ALL SELECT rid, words[i] || ' ' || words[i + 1] FROM (SELECT rid, words, unnest(range(1, len(words))) AS i FROM {name}_words))"""


OP13 = f"""
WITH {CRC_TABLE},
{_features_sql("sources", "documents")},
{_features_sql("targets", "benchmark")},
kinds AS (
  SELECT f, {crc32_sql("f")} % {resampling.BUCKETS} AS bucket FROM (SELECT f FROM sources UNION SELECT f FROM targets), crc_table),
counts AS (
  SELECT bucket, coalesce(s, 0)::DOUBLE AS s, coalesce(t, 0)::DOUBLE AS t FROM
    (SELECT bucket, count(*) AS s FROM sources JOIN kinds USING (f) GROUP BY bucket)
    FULL JOIN (SELECT bucket, count(*) AS t FROM targets JOIN kinds USING (f) GROUP BY bucket) USING (bucket)),
totals AS (SELECT sum(s) + {resampling.BUCKETS} AS of_source, sum(t) + {resampling.BUCKETS} AS of_target FROM counts),
gains AS (SELECT bucket, floor({resampling.SCALE} * ln((t + 1) * of_source / ((s + 1) * of_target)))::BIGINT AS gain FROM counts, totals),
weights AS (
  SELECT rid, count(*) AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
  FROM sources JOIN kinds USING (f) JOIN gains USING (bucket) GROUP BY rid),
scored AS (
  SELECT doc_id, len(words) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    coalesce(weight, 0)::BIGINT + floor(-{resampling.SCALE} * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM (SELECT *, ('0x' || substr(sha256('{resampling.SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h FROM sources_words)
    LEFT JOIN weights USING (rid)),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST, n_features, weight) AS place, count(*) OVER () AS able
  FROM scored WHERE n_words >= {resampling.LEAST_WORDS})
SELECT doc_id, n_features, weight, score, CASE WHEN place <= {resampling.PERCENT} * able // 100 THEN place END AS rank FROM ranked
UNION ALL SELECT doc_id, n_features, weight, score, NULL FROM scored WHERE n_words < {resampling.LEAST_WORDS}
"""

ORACLES = {
    "op1_chat_format": OP1, "op8_quality_rules": OP8, "op10_url_filters": OP10, "op11_katz": OP11, "op12_spelling": OP12,
    "op13_resampling": OP13,
}
