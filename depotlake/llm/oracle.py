"""SQL for DuckDB of the queries that SQL can express, over the same tables."""

from depotlake.llm import licenses

_ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
_ACCESS, _HEX, _RUN = "AKIA[A-Z0-9]{14,}", "[0-9a-f]{16,}", "[A-Za-z0-9+/_=-]{16,}"
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-="


def _found(kind: int, pattern: str) -> str:
    """Matches with their places, from the lengths of what lies between them."""
    return f"""
    SELECT doc_id, {kind} AS kind, found, start, start + length(found) AS stop FROM (
        SELECT doc_id, found, sum(length(gap)) OVER every + coalesce(sum(length(found)) OVER before, 0) AS start
        FROM (
            SELECT doc_id, unnest(range(1, len(matches) + 1)) AS place, unnest(matches) AS found,
                   unnest(gaps[1:len(matches)]) AS gap
            FROM (SELECT doc_id, regexp_extract_all(text, '{pattern}') AS matches,
                         regexp_split_to_array(text, '{pattern}') AS gaps FROM texts)
        )
        WINDOW every AS (PARTITION BY doc_id ORDER BY place ROWS UNBOUNDED PRECEDING),
               before AS (PARTITION BY doc_id ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    )"""


_SIGNS = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (('0x' || substr(digest, {2 * k + 1}, 2))::INTEGER % 32) + 1, 1)"
    for k in range(32)
)

SECRET_SCANS = f"""
WITH texts AS MATERIALIZED (
    SELECT doc_id, coalesce(text, '') AS text FROM documents
), sample AS (
    SELECT text FROM texts
    WHERE ('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8))::BIGINT % 1000000
          < ceil(1000000 * least(1.0, 1000.0 / (SELECT greatest(count(*), 1) FROM texts)))
), words AS (
    SELECT unnest(regexp_extract_all(
        regexp_replace(regexp_replace(regexp_replace(text, '{_ASSIGN}', ' ', 'g'), '{_ACCESS}', ' ', 'g'), '{_HEX}', ' ', 'g'),
        '[A-Za-z_][A-Za-z0-9_-]{{3,}}')) AS word
    FROM sample
), digests AS (
    SELECT sha256(CAST(id AS VARCHAR)) AS digest FROM range(2000) t(id)
), samples AS (
    SELECT unnest([word, upper(word) || '_' || upper(word),
                   lower(word) || upper(substr(word, 1, 1)) || lower(substr(word, 2))]) AS text, false AS random FROM words
    UNION ALL
    SELECT value, true FROM (
        SELECT unnest(regexp_extract_all(text, '{_ASSIGN}', 2) || regexp_extract_all(text, '{_ACCESS}')
                      || regexp_extract_all(text, '{_HEX}')) AS value FROM sample
    ) WHERE length(value) >= 12
    UNION ALL
    SELECT unnest([base64(unhex(digest)), {_SIGNS}, substr(digest, 1, 40)]), true FROM digests
), pairs AS (
    SELECT random, instr('{_ALPHABET}', substr(text, i, 1)) AS first, instr('{_ALPHABET}', substr(text, i + 1, 1)) AS second
    FROM (SELECT random, text, unnest(range(1, length(text))) AS i FROM samples)
), counts AS (
    SELECT first, second, count(*) FILTER (WHERE random) AS r, count(*) FILTER (WHERE NOT random) AS o
    FROM pairs GROUP BY first, second
), model AS MATERIALIZED (
    SELECT a.i AS first, b.i AS second,
           ln((coalesce(r, 0) + 0.5::DOUBLE) / (coalesce(sum(r) OVER x, 0) + 0.5::DOUBLE * 67))
           - ln((coalesce(o, 0) + 0.5::DOUBLE) / (coalesce(sum(o) OVER x, 0) + 0.5::DOUBLE * 67)) AS ratio
    FROM range(67) a(i), range(67) b(i) LEFT JOIN counts ON counts.first = a.i AND counts.second = b.i
    WINDOW x AS (PARTITION BY a.i)
), base AS MATERIALIZED (
    SELECT doc_id, kind, start, stop FROM ({_found(0, _ASSIGN)}) WHERE length(regexp_extract(found, '{_ASSIGN}', 2)) >= 12
    UNION ALL
    SELECT doc_id, kind, start, stop FROM ({_found(1, _ACCESS)})
    UNION ALL
    SELECT doc_id, kind, start, stop FROM ({_found(2, _HEX)})
), runs AS (
    SELECT row_number() OVER () AS run, * FROM ({_found(3, _RUN)})
), scored AS (
    SELECT run, sum(ratio) AS score
    FROM (SELECT run, instr('{_ALPHABET}', substr(found, i, 1)) AS first, instr('{_ALPHABET}', substr(found, i + 1, 1)) AS second
          FROM (SELECT run, found, unnest(range(1, length(found))) AS i FROM runs))
    JOIN model USING (first, second) GROUP BY run
), likely AS (
    SELECT doc_id, kind, start, stop FROM runs JOIN scored USING (run) WHERE score >= 15
      AND NOT EXISTS (SELECT 1 FROM base WHERE base.doc_id = runs.doc_id AND base.start < runs.stop AND runs.start < base.stop)
), spans AS (
    SELECT *, ['assign', 'access', 'hex', 'random'][kind + 1] || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT) AS shown
    FROM (SELECT * FROM base UNION ALL SELECT * FROM likely)
)
SELECT doc_id, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access,
       count(*) FILTER (WHERE kind = 2) AS n_hex, count(*) FILTER (WHERE kind = 3) AS n_random,
       sha256(coalesce(string_agg(shown, ',' ORDER BY start, kind) FILTER (WHERE kind < 3), '')) AS base_sha256,
       coalesce(string_agg(shown, ',' ORDER BY start, kind), '') AS spans
FROM texts LEFT JOIN spans USING (doc_id) GROUP BY doc_id
"""

EXACT_DEDUP = r"""
WITH normal AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS content FROM documents
)
SELECT doc_id,
       min(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept,
       sha256(content) AS text_sha256
FROM normal WINDOW same AS (PARTITION BY content)
"""

NEAR_DEDUP = r"""
WITH RECURSIVE worded AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS words FROM documents
), sets AS MATERIALIZED (
    SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) = 1 THEN words
                        ELSE list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) END AS shingles
    FROM worded
), flat AS MATERIALIZED (
    SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets
), common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS n_a, any_value(b.n) AS n_b, count(*) AS shared
    FROM flat a JOIN flat b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
        AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
    GROUP BY a.doc_id, b.doc_id
), links AS MATERIALIZED (
    SELECT a, b FROM common WHERE 100 * shared >= 80 * (n_a + n_b - shared)
), both_ways AS MATERIALIZED (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached AS (
    SELECT doc_id AS start, doc_id AS node FROM documents
    UNION
    SELECT reached.start, both_ways.b FROM reached JOIN both_ways ON reached.node = both_ways.a
)
SELECT sets.doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, component_id, sets.doc_id = component_id AS kept
FROM sets JOIN (SELECT start AS doc_id, min(node) AS component_id FROM reached GROUP BY start) USING (doc_id)
"""


def _spans(length: int, name: str) -> str:
    """Maximal runs of the bytes that repeated strings of a length cover."""
    return f"""
strings_{name} AS MATERIALIZED (
    SELECT doc_id, start, md5_number(substr(bytes, 2 * start + 1, {2 * length})) AS string
    FROM (SELECT doc_id, bytes, unnest(range(0, greatest(n - {length - 1}, 0))) AS start FROM docs)
), repeated_{name} AS (
    SELECT doc_id, start FROM strings_{name}
    WHERE string IN (SELECT string FROM strings_{name} GROUP BY string HAVING count(*) > 1)
), marked_{name} AS (
    SELECT doc_id, start,
           CASE WHEN start <= lag(start) OVER (PARTITION BY doc_id ORDER BY start) + {length} THEN 0 ELSE 1 END AS new
    FROM repeated_{name}
), {name} AS MATERIALIZED (
    SELECT doc_id, min(start) AS a, max(start) + {length} AS b
    FROM (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY start) AS run FROM marked_{name})
    GROUP BY doc_id, run
)"""


SUFFIX_DEDUP = f"""
WITH docs AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS bytes, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), {_spans(400, "spans")}, {_spans(250, "shorter")}, pieces AS (
    SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b FROM spans
    UNION ALL
    SELECT doc_id, coalesce(max(spans.b), 0), any_value(n) FROM docs LEFT JOIN spans USING (doc_id) GROUP BY doc_id
), kept AS (
    SELECT doc_id, string_agg(substr(bytes, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS bytes
    FROM pieces JOIN docs USING (doc_id) GROUP BY doc_id
), removed AS (
    SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id
), counted AS (
    SELECT doc_id, sum(b - a) AS n_repeated FROM shorter GROUP BY doc_id
)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(unhex(kept.bytes)) AS kept_sha256,
       CAST(coalesce(n_repeated, 0) AS BIGINT) AS n_repeated
FROM docs JOIN kept USING (doc_id) LEFT JOIN removed USING (doc_id) LEFT JOIN counted USING (doc_id)
"""

SOURCE_MIXING = r"""
WITH sized AS (
    SELECT doc_id, source, coalesce('s' || source, '') AS source_key,
           len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
           ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), md5(coalesce(text, ''))) || '/mix'), 1, 8))::BIGINT AS hash
    FROM documents
), classed AS (
    SELECT *, length(bin(size)) * 32 + (size >> greatest(length(bin(size)) - 5, 0)) AS class FROM sized
), sources AS (
    SELECT source_key, CAST(sum(size) AS BIGINT) AS source_size,
           1 + (row_number() OVER (ORDER BY max(source) NULLS LAST) - 1) % 3 AS weight
    FROM sized GROUP BY source_key
), summed AS (
    SELECT *, sum(source_size) OVER () AS all_sizes,
           coalesce(sum(source_size) OVER (ORDER BY CAST(source_size AS DOUBLE) / weight, source_key
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stopped,
           sum(weight) OVER (ORDER BY CAST(source_size AS DOUBLE) / weight, source_key
                    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights_left
    FROM sources
), marked AS (
    SELECT *, (all_sizes - 3 * stopped) * weight > 3 * source_size * weights_left AS over FROM summed
), share AS (
    SELECT all_sizes - 3 * stopped AS rest, weights_left FROM marked WHERE NOT over
    ORDER BY CAST(source_size AS DOUBLE) / weight, source_key LIMIT 1
), targets AS (
    SELECT source_key, source_size,
           CASE WHEN over THEN CAST(3 * source_size AS DOUBLE)
                ELSE CAST(weight AS DOUBLE) * (SELECT CAST(rest AS DOUBLE) FROM share) / (SELECT CAST(weights_left AS DOUBLE) FROM share)
           END AS target
    FROM marked
), stepped AS (
    SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size * 1048576) AS BIGINT) ELSE 0 END AS rate,
           ('0x' || substr(md5(source_key || '/mix'), 1, 5))::BIGINT AS start
    FROM targets
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY source_key ORDER BY class, hash, doc_id, size) AS number FROM classed
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST((((start + number * rate) >> 20) - ((start + (number - 1) * rate) >> 20)) * size AS BIGINT) AS taken
FROM numbered JOIN stepped USING (source_key)
"""

_DRAWS = ", ".join(f"('0x' || substr(digest, {8 * k + 1}, 8))::BIGINT AS h{k + 1}" for k in range(4))

FILL_IN_MIDDLE = f"""
WITH texts AS (
    SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
           sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest
    FROM documents
), drawn AS (
    SELECT *, {_DRAWS} FROM texts
), cut AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
           CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90
                THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM drawn
), parts AS (
    SELECT *, substr(text, 1, a) AS prefix, substr(text, a + 1, b - a) AS middle, substr(text, b + 1) AS suffix FROM cut
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""

_LICENCES = (*licenses.BASE, *licenses.NOTICES)


def _values(rows) -> str:
    return "VALUES " + ", ".join(f"({', '.join(repr(v) for v in row)})" for row in rows)


_LICENCE_WORDS = _values((n, q, w.decode()) for n, t in enumerate(_LICENCES) for q, w in enumerate(t.words))
_LICENCE_LABELS = _values((n, t.label, len(t.words), len(t.phrases), int(t.base)) for n, t in enumerate(_LICENCES))
_KEY_WORDS = _values((n, k, len(p), i, w.decode()) for n, t in enumerate(_LICENCES) for k, p in enumerate(t.phrases) for i, w in enumerate(p))

LICENSE_SCANS = f"""
WITH rows_ AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY doc_id) AS r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
    FROM documents
), licence_words(t, q, word) AS ({_LICENCE_WORDS}
), licences(t, label, size, phrases, base) AS ({_LICENCE_LABELS}
), key_words(t, k, size, i, word) AS ({_KEY_WORDS}
), postings AS MATERIALIZED (
    SELECT r, p, word FROM (SELECT r, unnest(words) AS word, unnest(range(len(words))) AS p FROM rows_)
    WHERE word IN (SELECT word FROM licence_words)
), present AS MATERIALIZED (
    SELECT DISTINCT r, word FROM postings
), counts AS (
    SELECT word, count(*) AS documents FROM present GROUP BY word
), looked_up AS (
    SELECT r, t FROM present JOIN (SELECT DISTINCT t, word FROM key_words) USING (word)
    JOIN (SELECT t, count(DISTINCT word) AS needed FROM key_words GROUP BY t) USING (t)
    GROUP BY r, t HAVING count(*) = any_value(needed)
), rarest AS (
    SELECT r, t, word FROM present JOIN (SELECT DISTINCT t, word FROM licence_words) USING (word) JOIN counts USING (word)
    QUALIFY row_number() OVER (PARTITION BY r, t ORDER BY documents, word) <= {licenses.RARE}
), candidates AS MATERIALIZED (
    SELECT r, t, p - q AS start FROM rarest JOIN looked_up USING (r, t) JOIN postings USING (r, word) JOIN licence_words USING (t, word)
    GROUP BY r, t, start HAVING count(*) >= {licenses.VOTES}
), matched AS MATERIALIZED (
    SELECT c.r, c.t, c.start, count(*) AS matched
    FROM candidates c JOIN licence_words w USING (t) JOIN postings p ON p.r = c.r AND p.p = c.start + w.q AND p.word = w.word
    GROUP BY c.r, c.t, c.start
), phrases AS MATERIALIZED (
    SELECT r, t, k, p - i AS s, any_value(size) AS size
    FROM key_words JOIN (SELECT DISTINCT r, t FROM candidates) USING (t) JOIN postings USING (r, word)
    GROUP BY r, t, k, s HAVING count(*) = any_value(size)
), found AS MATERIALIZED (
    SELECT m.r, label, m.start, m.matched, l.size, base
    FROM matched m JOIN licences l USING (t)
    WHERE CASE WHEN base = 1 THEN matched = l.size ELSE l.phrases = (
        SELECT count(DISTINCT k) FROM phrases p WHERE p.r = m.r AND p.t = m.t
        AND p.s BETWEEN m.start - {licenses.SLACK} AND m.start + l.size + {licenses.SLACK} - p.size) END
), summed AS (
    SELECT r, count(*) FILTER (WHERE base = 1) AS n_base, min(start) FILTER (WHERE base = 1) AS first_word,
           max(start) FILTER (WHERE base = 1) AS last_word,
           string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base = 1) AS base_labels,
           string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(matched / size) AS score
    FROM found GROUP BY r
)
SELECT doc_id, len(words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0) AS score
FROM rows_ LEFT JOIN summed USING (r)
"""

ORACLE_SQL = {
    "op1_secret_scans": SECRET_SCANS,
    "op3_minhash_near_dedup": NEAR_DEDUP,
    "op4_source_mixing": SOURCE_MIXING,
    "op7_exact_dedup": EXACT_DEDUP,
    "op8_suffix_dedup": SUFFIX_DEDUP,
    "op12_license_scans": LICENSE_SCANS,
    "op13_fill_in_middle": FILL_IN_MIDDLE,
}
