"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from varzea.llm import quality_rules as q
from varzea.llm import source_divergence as s

_WORD = r"[^\x20\x09-\x0D]+"


def _count(chars: str) -> str:
    return f"(length(t) - length(translate(t, '{chars}', '')))::DOUBLE"


_BINS = "MAP {" + ", ".join(f"'{k}': [{', '.join(repr(w) for w in v.split())}]" for k, v in q.COMMON.items()) + "}"
_CHARS = [_count(q.LOWER), _count(q.UPPER), f"length(regexp_replace(t, '{_WORD}', '', 'g'))::DOUBLE", _count(q.STOPS), _count(q.SYMBOLS), _count(q.DIGITS)]


def _js(p: str, r: str) -> str:
    a, b = "x[1]", "x[2]"
    part = f"CASE WHEN {a} > 0 THEN {a} * log2(2 * {a} / ({a} + {b})) ELSE 0.0::DOUBLE END + CASE WHEN {b} > 0 THEN {b} * log2(2 * {b} / ({a} + {b})) ELSE 0.0::DOUBLE END"
    return f"sqrt(greatest(0.0::DOUBLE, 0.5::DOUBLE * list_sum(list_transform(list_zip({p}, {r}), lambda x: {part}))))"


OP3 = f"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w, row_number() OVER () AS row FROM documents),
c AS (SELECT *, len(w)::BIGINT AS n_words, (length(t) - length(regexp_replace(t, '{_WORD}', '', 'g')))::BIGINT AS word_chars, {_count(q.SYMBOLS)}::BIGINT AS n_symbols,
  list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '{_WORD}')) AS lines, [{", ".join(_CHARS)}] AS known, {_BINS}[lang] AS bins FROM d),
windows AS (SELECT row, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s FROM (SELECT row, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
again AS (SELECT row, i FROM windows QUALIFY count(*) OVER (PARTITION BY row, s) > 1),
repeated AS (SELECT row, count(DISTINCT i + k)::BIGINT AS n FROM (SELECT row, i, unnest([0, 1, 2]) AS k FROM again) GROUP BY 1),
s AS (SELECT c.*, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(repeated.n, 0) AS n_repeat_words,
  CASE WHEN length(t) > 0 THEN list_transform(list_append(known, length(t) - list_sum(known)), lambda x: x / length(t)) END AS char_share,
  list_transform(bins, lambda b: len(list_filter(w, lambda x: x = b))::DOUBLE) AS found FROM c LEFT JOIN repeated ON repeated.row = c.row),
b AS (SELECT *, n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.MAX_REPEAT_PCT} * n_words AS base_failed,
  CASE WHEN n_words > 0 THEN list_append(list_transform(found, lambda x: x / n_words), (n_words - list_sum(found)) / n_words) END AS word_share FROM s),
r AS (SELECT lang, count(*) AS n_ref, [{", ".join(f"avg(char_share[{i}])" for i in range(1, 8))}] AS char_ref, [{", ".join(f"avg(word_share[{i}])" for i in range(1, 14))}] AS word_ref FROM b WHERE NOT base_failed AND lang IS NOT NULL GROUP BY 1),
every AS (SELECT [{", ".join(f"avg(char_share[{i}])" for i in range(1, 8))}] AS all_ref FROM b WHERE NOT base_failed),
drawn AS (SELECT r.*, list_transform(list_zip(char_ref, all_ref), lambda x: (x[1] * n_ref + x[2] * {q.PRIOR_TEXTS}) / (n_ref + {q.PRIOR_TEXTS})) AS drawn_ref FROM r CROSS JOIN every),
j AS (SELECT b.*, CASE WHEN char_ref IS NOT NULL THEN least({_js("char_share", "char_ref")}, {_js("char_share", "drawn_ref")}) END AS cd, CASE WHEN word_ref IS NOT NULL AND word_ref[1] IS NOT NULL THEN {_js("word_share", "word_ref")} END AS wd FROM b LEFT JOIN drawn ON drawn.lang = b.lang)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT (word_chars >= {q.MIN_CHARS} AND coalesce(cd > {q.MAX_CHAR_DISTANCE}, false))
 AND NOT (n_words >= {q.MIN_WORDS_FOR_WORDS} AND (coalesce(wd > {q.MAX_WORD_DISTANCE}, false) OR coalesce(cd > {q.BOTH_CHAR_DISTANCE} AND wd > {q.BOTH_WORD_DISTANCE}, false))) AS kept FROM j
"""

OP10 = r"""
WITH i AS (SELECT row_number() OVER () AS item, item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM benchmark),
d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents),
iw AS (SELECT *, least(len(w), 5) AS k FROM i WHERE len(w) > 0),
si AS (SELECT DISTINCT item, item_id, k, array_to_string(w[p : p + k - 1], ' ') AS s FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS p FROM iw)),
sd AS (SELECT DISTINCT row, doc_id, k, array_to_string(w[p : p + k - 1], ' ') AS s FROM (SELECT d.row, d.doc_id, d.w, x.k, unnest(range(1, len(d.w) - x.k + 2)) AS p FROM d, (SELECT DISTINCT k FROM iw) x)),
size AS (SELECT item, count(*) AS n FROM si GROUP BY 1)
SELECT doc_id, item_id, shared, n AS n_shingles FROM (SELECT sd.row, sd.doc_id, si.item, si.item_id, count(*) AS shared FROM sd JOIN si ON si.k = sd.k AND si.s = sd.s GROUP BY ALL) JOIN size USING (item) WHERE shared >= 0.8 * n - 1e-9
"""

OP12 = f"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT row, lang, source, unnest(regexp_extract_all(t, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
counted AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT row) AS docs FROM w GROUP BY ALL),
kept AS (SELECT lang, term, sum(n) AS n FROM counted GROUP BY ALL HAVING sum(docs) >= {s.LEAST_DOCS}),
c AS (SELECT counted.lang, source, term, counted.n FROM counted JOIN kept USING (lang, term)),
v AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY 1),
g AS (SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS total FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source) GROUP BY ALL),
q AS (SELECT lang, term, 1 + ({s.SCALE}::HUGEINT * (n + {s.PRIOR})) // (total + {s.PRIOR} * v) AS q FROM kept JOIN v USING (lang)),
p AS (SELECT g.lang, g.source, q.term, coalesce(c.n, 0) AS n, q, 1 + ({s.SCALE}::HUGEINT * (coalesce(c.n, 0) + {s.PRIOR})) // (g.total + {s.PRIOR} * v) AS p
  FROM g JOIN q USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = q.term),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
rows AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE n > 0 AND p > q)
SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM rows QUALIFY part = 'pair' OR rank <= {s.TOP}
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_quality_divergence": OP3, "op10_decontamination": OP10, "op12_source_divergence": OP12}
