"""DuckDB SQL for the queries of this package that SQL can express."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: Words of a text: [^\x20\x09-\x0D]+.
_TOKENS = "regexp_extract_all({text}, '[^\\x20\\x09-\\x0D]+')"
_ALNUM = "regexp_extract_all({text}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

OP3 = f"""
WITH d AS (SELECT doc_id, {_ALNUM.format(text=_LOWER)} AS w FROM documents),
b AS (SELECT item_id, {_ALNUM.format(text=_LOWER)} AS w FROM benchmark),
p AS (
    SELECT DISTINCT item_id, least(10, len(w)) AS size, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS win
    FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0)
),
s AS (SELECT DISTINCT size FROM p),
o AS (
    SELECT doc_id, i, size, array_to_string(w[i : i + size - 1], ' ') AS win
    FROM (
        SELECT doc_id, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i
        FROM d, s WHERE len(w) >= size
    )
),
m AS (SELECT doc_id, i, o.size, item_id FROM o JOIN p USING (win) WHERE o.size = p.size),
h AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(generate_series(i, i + size - 1)) AS place FROM m) GROUP BY doc_id
),
n AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN n USING (doc_id)
"""

OP4 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_TOKENS.format(text="coalesce(text, '')")} AS w FROM documents),
x AS (
    SELECT doc_id, i, w[i : i + 4] AS win
    FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 4)) AS i FROM d WHERE len(w) >= 5)
),
r AS (
    SELECT doc_id, count(DISTINCT place) AS n FROM (
        SELECT doc_id, unnest(generate_series(i, i + 4)) AS place
        FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS times FROM x) WHERE times > 1
    ) GROUP BY doc_id
),
m AS (
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
           CAST(length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
           CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
           list_filter(string_split(text, chr(10)), lambda y: regexp_matches(y, '[^\\x20\\x09-\\x0D]')) AS lines,
           len(list_filter(w, lambda y: regexp_matches(y, '[A-Za-z]|[^\\x00-\\x7F]'))) AS n_letter_words
    FROM d
),
f AS (
    SELECT doc_id, n_words, word_chars, n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
           CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words, len(lines) AS n_lines, n_letter_words
    FROM m LEFT JOIN r USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR 10 * n_symbols > n_words
            OR 100 * n_dup_lines > 60 * n_lines OR word_chars < 2 * n_words OR word_chars > 20 * n_words
            OR 100 * n_letter_words < 60 * n_words) AS kept
FROM f
"""

OP6 = f"""
WITH RECURSIVE d AS (
    SELECT doc_id, {_TOKENS.format(text=_LOWER)} AS w FROM documents
),
s AS (
    SELECT DISTINCT doc_id, w[i : i + 4] AS shingle
    FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM d WHERE len(w) > 0)
),
n AS (SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id),
links AS MATERIALIZED (
    SELECT a, b FROM (
        SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
        FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY 1, 2
    ) JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
    WHERE 100 * common >= 75 * (p.size + q.size - common)
),
reach AS (
    SELECT a AS doc_id, a AS node FROM links
    UNION
    SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.node
),
c AS (SELECT doc_id, min(node) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.size, 0) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id,
       coalesce(component_id, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""

OP11 = f"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, {_LOWER} AS text FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM p),
g AS (
    SELECT lang, size, array_to_string(w[i : i + size - 1], ' ') AS phrase, count(*) AS f
    FROM (
        SELECT lang, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i
        FROM w, (VALUES (1), (2), (3)) AS s(size) WHERE len(w) >= size
    ) GROUP BY ALL
),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM g WHERE size = 1 GROUP BY lang),
c AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM g WHERE size > 1 AND f >= 10),
cut AS (
    SELECT lang, phrase, a, k, array_to_string(w[1 : k], ' ') AS x, array_to_string(w[k + 1 : size], ' ') AS y
    FROM (SELECT *, unnest(generate_series(1, size - 1)) AS k FROM c)
),
s AS (
    SELECT cut.lang, cut.phrase, a, k, x.f AS l, y.f AS r,
           CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
    FROM cut JOIN g AS x ON x.lang = cut.lang AND x.phrase = cut.x JOIN g AS y ON y.lang = cut.lang AND y.phrase = cut.y
),
lowest AS (
    SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
),
longer AS (
    SELECT lang, phrase, max(a) AS b
    FROM (SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase FROM c WHERE size = 3)
    GROUP BY lang, phrase
),
kept AS (
    SELECT lowest.* FROM lowest LEFT JOIN longer USING (lang, phrase) WHERE b IS NULL OR 100 * b < 50 * a
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""


def _op12(rounds: int = 6) -> str:
    """One pair of tables per round: the nearest entries, and the entries averaged again."""
    nearest = """
    SELECT row, p, e, d FROM (
        SELECT row, parts.p, e, sum((parts.x - book.x) * (parts.x - book.x)) AS d
        FROM parts JOIN {book} AS book ON book.p = parts.p AND book.j = parts.j GROUP BY row, parts.p, e
    ) QUALIFY row_number() OVER (PARTITION BY row, p ORDER BY d, e) = 1
"""
    averaged = """
    SELECT old.p, old.e, old.j, CASE WHEN n IS NULL THEN old.x ELSE (s - ((s % n) + n) % n) // n END AS x
    FROM {book} AS old LEFT JOIN (
        SELECT parts.p, e, j, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
        FROM parts JOIN {near} AS near ON near.row = parts.row AND near.p = parts.p GROUP BY parts.p, e, j
    ) AS new ON new.p = old.p AND new.e = old.e AND new.j = old.j
"""
    steps = []
    for i in range(rounds):
        steps.append(f"near{i} AS MATERIALIZED ({nearest.format(book=f'book{i}')})")
        steps.append(f"book{i + 1} AS MATERIALIZED ({averaged.format(book=f'book{i}', near=f'near{i}')})")
    return f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY vec_id) - 1 AS row, vec_id, label,
           list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
parts AS MATERIALIZED (
    SELECT row, (i - 1) // (len(v) // 8) AS p, (i - 1) % (len(v) // 8) AS j, v[i] AS x
    FROM (SELECT row, v, unnest(generate_series(1, len(v))) AS i FROM kept)
),
book0 AS MATERIALIZED (SELECT p, row AS e, j, x FROM parts WHERE row < 16),
{", ".join(steps)},
final AS MATERIALIZED ({nearest.format(book=f"book{rounds}")}),
coded AS (
    SELECT row, string_agg(lower(printf('%02x', e)), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
    FROM final GROUP BY row
),
digest AS (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, e, j)) AS codebooks_sha256 FROM book{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded USING (row), digest
"""


OP12 = _op12()
