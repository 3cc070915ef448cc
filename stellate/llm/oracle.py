"""DuckDB SQL of the training-data queries that SQL can express."""

from __future__ import annotations

from stellate.llm.license_scan import LICENSES, MARK, NOTICE, PLAIN, SPELLINGS

NOT_SPACE = r"[^\x20\x09-\x0D]+"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# A-Z only: lower() of ASCII is the same, other characters stay
_AZ = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP3 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{NOT_SPACE}') AS w FROM documents),
     p AS (SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50),
     x AS (SELECT r, doc_id, i, array_to_string(w[i:i + 49], ' ') AS s FROM p),
     f AS (SELECT s, min(doc_id) AS first_doc FROM x GROUP BY s),
     c AS (SELECT DISTINCT r, unnest(range(i, i + 50)) AS j FROM x JOIN f USING (s) WHERE x.doc_id > f.first_doc),
     g AS (SELECT r, list(j) AS gone FROM c GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
       sha256(array_to_string(list_transform(list_filter(list_zip(w, range(1, len(w) + 1)),
                                                         lambda a: gone IS NULL OR NOT list_contains(gone, a[2])), lambda a: a[1]), ' ')) AS kept_sha256
FROM d LEFT JOIN g USING (r)
"""

OP4 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_AZ.format("coalesce(text, '')")}, '{ITEM_WORD}') AS w FROM documents),
     b AS (SELECT item_id, regexp_extract_all({_AZ.format("coalesce(text, '')")}, '{ITEM_WORD}') AS w FROM benchmark),
     q AS (SELECT item_id, w, least(10, len(w)) AS m FROM b WHERE len(w) > 0),
     k AS (SELECT item_id, m, w, unnest(range(1, len(w) - m + 2)) AS i FROM q),
     pat AS (SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS s FROM k),
     ms AS (SELECT DISTINCT m FROM pat),
     pos AS (SELECT r, m, w, unnest(range(1, len(w) - m + 2)) AS i FROM d, ms WHERE len(w) >= m),
     x AS (SELECT r, m, i, array_to_string(w[i:i + m - 1], ' ') AS s FROM pos),
     hits AS (SELECT r, m, i, item_id FROM x JOIN pat USING (m, s)),
     covered AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + m)) AS j FROM (SELECT DISTINCT r, m, i FROM hits)) GROUP BY r),
     named AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
               FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM hits) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""


def _canonical(text: str) -> str:
    """All lines, notices marked."""
    low = f"translate(lower(coalesce({text}, '')), '{MARK}', '{PLAIN}')"
    marked = f"regexp_replace({low}, '{NOTICE}', '{MARK} \\0', 'g')"
    flat = rf"regexp_replace({marked}, '[^\p{{L}}\p{{N}}\n]+', '  ', 'g')"
    out = f"'  ' || replace({flat}, chr(10), '  ' || chr(10) || '  ') || '  '"
    for a, b in SPELLINGS:
        out = f"replace({out}, ' {a} ', ' {b} ')"
    return f"list_transform(string_split({out}, chr(10)), lambda x: trim(x, ' '))"


def _unmarked(lines: str) -> str:
    return (f"list_filter(list_transform({lines}, lambda x: CASE WHEN starts_with(x, '{MARK}') THEN trim(substr(x, 2), ' ') ELSE x END), "
            "lambda x: x <> '')")


_PARAGRAPHS = r"list_filter(list_transform(string_split_regex(array_to_string(lines, chr(10)), '\n\n+'), lambda x: ltrim(x, chr(10))), "
_FORMS = (f"list_filter(lines, lambda x: x <> '' AND NOT starts_with(x, '{MARK}'))",
          _unmarked(f"string_split(array_to_string({_PARAGRAPHS}lambda x: NOT starts_with(x, '{MARK}')), chr(10)), chr(10))"),
          _unmarked("lines"))
_VALUES = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in LICENSES)
OP5 = f"""
WITH l(license, text) AS (VALUES {_VALUES}),
     lc AS (SELECT license, {_canonical("text")} AS lines FROM l),
     lf AS ({" UNION ALL ".join(f"SELECT license, {f} AS form FROM lc" for f in _FORMS)}),
     known AS (SELECT sha256(array_to_string(form, '  ')) AS unit, min(license) AS license FROM lf WHERE len(form) > 0 GROUP BY 1),
     d AS (SELECT row_number() OVER () AS r, doc_id, {_canonical("text")} AS lines FROM documents),
     f AS ({" UNION ALL ".join(f"SELECT r, {i} AS nth, {f} AS form FROM d" for i, f in enumerate(_FORMS))}),
     w AS (SELECT r, arg_min(license, nth) AS license FROM (SELECT r, nth, sha256(array_to_string(form, '  ')) AS unit FROM f)
           JOIN known USING (unit) GROUP BY r),
     u AS (SELECT r, sha256(line) AS unit FROM (SELECT r, unnest(form) AS line FROM f WHERE nth = 0)),
     n AS (SELECT r, count(*) AS n_notices, string_agg(DISTINCT license, ',' ORDER BY license) AS notices FROM u JOIN known USING (unit) GROUP BY r)
SELECT doc_id, sha256(array_to_string(form, '  ')) AS text_digest, license, coalesce(n_notices, 0)::BIGINT AS n_notices,
       coalesce(notices, '') AS notices
FROM d JOIN (SELECT r, form FROM f WHERE nth = 0) USING (r) LEFT JOIN w USING (r) LEFT JOIN n USING (r)
"""

_ASSIGN = (r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"""
           r"""[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""")


def _spans(kind: str, place: int, pattern: str, group: int, least: int) -> str:
    return f"""
     SELECT r, '{kind}' AS kind, {place} AS place, stop - len(hit) AS start, stop FROM (
       SELECT r, hit, own, sum(len(gap) + len(hit)) OVER (PARTITION BY r ORDER BY i) AS stop FROM (
         SELECT r, unnest(range(len(h))) AS i, unnest(h) AS hit, unnest(o) AS own, unnest(g[1:len(h)]) AS gap FROM (
           SELECT r, regexp_extract_all(text, '{pattern}', 0) AS h, regexp_extract_all(text, '{pattern}', {group}) AS o,
                  string_split_regex(text, '{pattern}') AS g FROM d) WHERE len(h) > 0)) WHERE len(own) >= {least}"""


OP6 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
     s AS ({_spans("assign", 0, _ASSIGN, 2, 6)} UNION ALL {_spans("access", 1, "AKIA[A-Z0-9]+", 0, 20)}
           UNION ALL {_spans("hex", 2, "[0-9a-f]+", 0, 24)}),
     a AS (SELECT r, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
                  count(*) FILTER (WHERE kind = 'hex') AS n_hex,
                  string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place) AS spans FROM s GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
       coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (r)
"""

OP8 = """
WITH v AS (SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS w FROM embeddings
           WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
     s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum([a[1] * a[2] FOR a IN list_zip(q.w, c.w)])::BIGINT AS score
           FROM v q, v c WHERE q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
     o AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM o WHERE rank <= 5
"""

OP11 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_AZ.format("coalesce(text, '')")}, '{TERM}') AS w FROM documents),
     s AS (SELECT count(*)::BIGINT AS n_docs, sum(len(w))::BIGINT AS n_all FROM d WHERE len(w) > 0),
     q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_AZ.format("coalesce(text, '')")}, '{TERM}')) AS term FROM benchmark),
     p AS (SELECT r, doc_id, len(w)::BIGINT AS n, unnest(w) AS term FROM d),
     f AS (SELECT r, doc_id, n, term, count(*)::BIGINT AS tf FROM p JOIN (SELECT DISTINCT term FROM q) USING (term) GROUP BY ALL),
     g AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS wt FROM f, s GROUP BY term),
     i AS (SELECT r, doc_id, term, wt * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_all))) AS x FROM f JOIN g USING (term), s),
     o AS (SELECT item_id, r, doc_id, sum(x)::BIGINT AS score FROM q JOIN i USING (term) GROUP BY ALL HAVING sum(x) > 0),
     k AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank, doc_id, score FROM o)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 50
"""

LLM_ORACLE_SQL: dict[str, str] = {
    "op3_substring_dedup": OP3,
    "op4_decontamination": OP4,
    "op5_license_scan": OP5,
    "op6_secret_scan": OP6,
    "op8_exact_topk": OP8,
    "op11_ranked_search": OP11,
}
