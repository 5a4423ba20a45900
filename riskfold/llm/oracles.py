"""DuckDB SQL for the queries that SQL can express: exact top-k and licence rules."""

from __future__ import annotations

from riskfold.llm import licenses as L


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def topk_sql(k: int = 20, every: int = 20) -> str:
    """All inner products of every ``every``-th vector, ranked."""
    return f"""
WITH ok AS (
  SELECT vec_id AS id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
one AS (SELECT id, min(v) AS v FROM ok GROUP BY id),
met AS (
  SELECT q.id AS query_id, c.id AS vec_id,
    CAST(coalesce(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])), 0) AS BIGINT) AS score
  FROM one q JOIN one c ON q.id % {every} = 0 AND c.id <> q.id AND len(c.v) = len(q.v)),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM met)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {k}
"""


def licenses_sql() -> str:
    """Both cuttings, the sentence table as a join, the rules one after the other."""
    known = ", ".join(f"({_text(s)}, {_text(i)})" for s, i in L.SENTENCES.items())
    clean = "trim(regexp_replace(replace(lower(s), 'licence', 'license'), '[^a-z0-9]+', ' ', 'g'))"

    def cut(name: str, text: str, breaks: str) -> str:
        return f"""{name}_s AS (
  SELECT n, unnest(p) AS s, generate_subscripts(p, 1) AS place
  FROM (SELECT n, regexp_split_to_array({text}, {_text(breaks)}) AS p FROM docs)),
{name}_i AS (
  SELECT n, string_agg(k.i, ' ' ORDER BY place) AS ids, string_agg(k.i, '  ' ORDER BY place) AS spaced, count(*) AS c
  FROM {name}_s JOIN known k ON k.s = {clean.replace('lower(s)', f'lower({name}_s.s)')} GROUP BY n)"""

    by_line = cut("a", "text", r"[\r\n]+|" + L.END)
    by_text = cut("b", r"regexp_replace(text, '\s+', ' ', 'g')", L.END)
    steps = []
    for name in ("a", "b"):
        rest = f"{name}0"
        for j, (_, ids) in enumerate(L.RULES, 1):
            key = _text(" " + "  ".join(ids) + " ")
            steps.append(f"contains({rest}, {key}) AS {name}f{j}, replace({rest}, {key}, ' | ') AS {name}{j}")
            rest = f"{name}{j}"
    last = len(L.RULES)
    names = list(dict.fromkeys(n for n, _ in L.RULES))
    listed = ", ".join(
        "CASE WHEN "
        + " OR ".join(f"{c}f{j}" for j, (n, _) in enumerate(L.RULES, 1) if n == name for c in "ab")
        + f" THEN {_text(name)} END"
        for name in names
    )
    words = lambda c: f"array_to_string(list_filter(regexp_split_to_array({c}, '[ |]+'), lambda x: x <> ''), ' ')"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS text FROM documents),
known AS (SELECT * FROM (VALUES {known}) AS t(s, i)),
{by_line},
{by_text},
pairs AS (
  SELECT docs.doc_id, coalesce(a_i.ids, '') AS a_ids, coalesce(b_i.ids, '') AS b_ids,
    coalesce(b_i.c, 0) > coalesce(a_i.c, 0) AS longer,
    ' ' || coalesce(a_i.spaced, '') || ' ' AS a0, ' ' || coalesce(b_i.spaced, '') || ' ' AS b0
  FROM docs LEFT JOIN a_i USING (n) LEFT JOIN b_i USING (n)),
ruled AS (SELECT *, {', '.join(steps)} FROM pairs)
SELECT doc_id, CASE WHEN longer THEN b_ids ELSE a_ids END AS sentence_ids,
  array_to_string(list_filter([{listed}], lambda x: x IS NOT NULL), ' ') AS licenses,
  {words(f'CASE WHEN longer THEN b{last} ELSE a{last} END')} AS loose_ids
FROM ruled
"""


def rule_cascade_sql() -> str:
    """Measures and verdict of the rules over all documents; no order of rules, as the verdict has none."""
    return r"""
    WITH d AS (
        SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
               regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
               list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
        FROM documents
    ),
    w AS (SELECT r, words[p] || ' ' || words[p + 1] || ' ' || words[p + 2] AS window3, p
          FROM (SELECT r, words, unnest(generate_series(1, len(words) - 2)) AS p FROM d)),
    twice AS (SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, window3) AS n FROM w) WHERE n > 1),
    covered AS (SELECT r, count(DISTINCT p + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r),
    m AS (
        SELECT doc_id, len(words)::BIGINT AS n_words,
               length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
               len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
               (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
               coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
               len(lines) AS n_lines,
               len(list_filter(words, lambda x: regexp_full_match(x, '(?:[^\pL]*\p{Lu}){2}[^\p{Ll}]*'))) AS n_shouts,
               len(list_filter(words, lambda x: regexp_matches(x, '\pL'))) AS n_letter_words,
               len(regexp_extract_all(t, '[0-9]')) AS n_digits,
               len(regexp_extract_all(t, '(?:\.\.\.|…)[\x20\x09\x0B-\x0D]*(?:\n|\z)')) AS n_dotted_lines,
               len(regexp_extract_all(t, '(?i)lorem ipsum')) AS n_fillers
        FROM d LEFT JOIN covered USING (r)
    ),
    v AS (SELECT *, n_words < 50 OR n_repeat_words * 100 > n_words * 50 AS base_failed FROM m)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT (base_failed OR n_symbols * 100 > n_words * 10 OR word_chars < n_words * 3 OR word_chars > n_words * 10
                OR n_dup_lines * 100 > n_lines * 50 OR n_shouts * 100 > n_words * 30 OR n_letter_words * 100 < n_words * 60
                OR n_digits * 100 > word_chars * 50 OR n_dotted_lines * 100 > n_lines * 30 OR n_fillers > 0) AS kept
    FROM v
    """
