"""DuckDB SQL that must give the same rows as the queries of the same name."""

from __future__ import annotations

from sonoloom.llm import licenses

# Words: the text's runs of characters that are none of these six.
_WORDS = r"list_filter(regexp_split_to_array(coalesce({}, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"


def _spans(kind: int, name: str, pattern: str, group: int, least: int) -> str:
    """Matches are marked in the text; lengths of the pieces before a mark give its place."""
    return f"""
  SELECT doc_id, row_id, {kind} AS kind_no, '{name}' AS kind, place AS start_at, place + length(m) AS end_at
  FROM (
    SELECT doc_id, row_id, unnest(ms) AS m, unnest(list_transform(range(1, len(ms) + 1),
             lambda i: list_sum(list_transform(pieces[1:i], lambda p: length(p)))
                       + coalesce(list_sum(list_transform(ms[1:i - 1], lambda p: length(p))), 0))) AS place,
             unnest(gs) AS g
    FROM (SELECT doc_id, row_id, regexp_extract_all(t, '{pattern}') AS ms, regexp_extract_all(t, '{pattern}', {group}) AS gs,
                 string_split(regexp_replace(t, '{pattern}', chr(57344), 'g'), chr(57344)) AS pieces FROM texts)
  ) WHERE length(g) >= {least}"""


_ASSIGN = (
    "([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
    r"""|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
)

_OP1 = f"""
WITH texts AS (SELECT doc_id, row_number() OVER () AS row_id, coalesce(text, '') AS t FROM documents),
spans AS ({_spans(0, "assign", _ASSIGN, 2, 6)}
  UNION ALL {_spans(1, "access", "AKIA[A-Z0-9]{16,}", 0, 20)}
  UNION ALL {_spans(2, "hex", "[0-9a-f]{24,}", 0, 24)}
  UNION ALL {_spans(3, "forge", "gh[opsru]_[A-Za-z0-9]{36,}", 0, 40)}
  UNION ALL {_spans(4, "private", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1)}),
said AS (SELECT *, kind || ':' || start_at::BIGINT || ':' || end_at::BIGINT AS said FROM spans)
SELECT any_value(t.doc_id) AS doc_id,
  count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
  count(*) FILTER (kind = 'hex') AS n_hex,
  sha256(coalesce(string_agg(said, ',' ORDER BY start_at, kind_no) FILTER (kind_no < 3), '')) AS base_sha256,
  coalesce(string_agg(said, ',' ORDER BY start_at, kind_no), '') AS spans
FROM texts t LEFT JOIN said s ON t.row_id = s.row_id GROUP BY t.row_id"""

_OP2 = f"""
WITH texts AS (SELECT doc_id, row_number() OVER () AS row_id, {_WORDS.format("text")} AS w FROM documents),
words AS (SELECT row_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place, len(w) AS total FROM texts),
windows AS (
  SELECT row_id, place, word, total, md5(array_to_string(list(word) OVER (
    PARTITION BY row_id ORDER BY place ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING), ' ')) AS h FROM words),
again AS (SELECT h FROM windows WHERE place <= total - 34 GROUP BY h HAVING count(*) > 1),
marked AS (
  SELECT row_id, place, word, max(CASE WHEN place <= total - 34 AND again.h IS NOT NULL THEN 1 ELSE 0 END) OVER (
    PARTITION BY row_id ORDER BY place ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone
  FROM windows LEFT JOIN again USING (h)),
kept AS (SELECT row_id, string_agg(word, ' ' ORDER BY place) AS kept, count(*) AS n FROM marked WHERE gone = 0 GROUP BY row_id)
SELECT doc_id, len(w)::BIGINT AS n_words, len(w)::BIGINT - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (row_id)"""

_OP3 = rf"""
WITH texts AS (
  SELECT doc_id, source, text, row_number() OVER () AS row_id, {_WORDS.format("text")} AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
words AS (SELECT row_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i, len(w) AS total FROM texts),
windows AS (
  SELECT row_id, i, total, [word, lead(word) OVER following, lead(word, 2) OVER following] AS g
  FROM words WINDOW following AS (PARTITION BY row_id ORDER BY i)),
grams AS (SELECT row_id, i, g FROM windows WHERE i <= total - 2),
twice AS (SELECT row_id, i FROM grams JOIN (SELECT row_id, g FROM grams GROUP BY ALL HAVING count(*) > 1) USING (row_id, g)),
repeats AS (SELECT row_id, count(DISTINCT i + o) AS n FROM twice, range(0, 3) r(o) GROUP BY row_id),
lines AS (
  SELECT row_id, doc_id, source, md5(coalesce(text, '')) AS d, unnest(lines) AS raw FROM texts),
plain AS (
  SELECT row_id, doc_id, source, d, len({_WORDS.format("raw")}) AS n,
    regexp_replace(lower(trim(regexp_replace(raw, '[\x20\x09-\x0D]+', ' ', 'g'))), '[0-9]', '0', 'g') AS line FROM lines),
counted AS (SELECT coalesce(source, '') AS host, line, count(DISTINCT (doc_id, source, d)) AS n FROM plain GROUP BY 1, 2),
often AS (SELECT host, line FROM counted WHERE n > 20),
removed AS (
  SELECT row_id, sum(n) AS n FROM plain JOIN often ON coalesce(source, '') = host AND plain.line = often.line GROUP BY row_id),
figures AS (
  SELECT row_id, doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(repeats.n, 0)::BIGINT AS n_repeat_words,
    coalesce(removed.n, 0) AS n_removed
  FROM texts LEFT JOIN repeats USING (row_id) LEFT JOIN removed USING (row_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_words - n_removed >= 0.5 * n_words AS kept
FROM figures"""

_OP4 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS t, encode(coalesce(html, '')) AS b FROM pages),
top AS (SELECT t, max(page_id) AS top FROM p WHERE octet_length(b) >= 1000 GROUP BY t)
SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha1(t) AS payload_digest,
  CASE WHEN top IS NULL OR page_id IS NOT DISTINCT FROM top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM top THEN top END AS refers_to
FROM p LEFT JOIN top USING (t)"""

_OP5 = f"""
WITH sized AS (SELECT doc_id, text, source, len({_WORDS.format("text")})::BIGINT AS size FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1 AS weight FROM sources),
ordered AS (
  SELECT *, 3 * source_size AS cap,
    coalesce(sum(3 * source_size) OVER before, 0) AS caps, sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS open,
    sum(source_size) OVER () AS total
  FROM weighed WINDOW before AS (ORDER BY 3 * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
factor AS (
  SELECT (total - caps)::BIGINT::DOUBLE / open::BIGINT::DOUBLE AS t FROM ordered
  WHERE cap >= (total - caps)::BIGINT::DOUBLE / open::BIGINT::DOUBLE * weight ORDER BY caps LIMIT 1),
targets AS (SELECT source, source_size, CASE WHEN cap < t * weight THEN cap::DOUBLE ELSE t * weight END AS target FROM ordered, factor),
rated AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN least(target / source_size, 3.0::DOUBLE) ELSE 0 END AS rate,
    ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null:' || md5(coalesce(text, '')))), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS draw
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, size, source_size, target,
  (size * (floor(rate)::BIGINT + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken FROM rated"""

_OP7 = f"""
WITH shingled AS (
  SELECT item_id, text, {_WORDS.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w
  FROM benchmark),
items AS (
  SELECT row_number() OVER () AS item, item_id, least(5, len(w)) AS n,
    list_distinct(list_transform(range(1, len(w) - least(5, len(w)) + 2), lambda i: w[i:i + least(5, len(w)) - 1])) AS g
  FROM shingled WHERE len(w) > 0),
docs AS (
  SELECT row_number() OVER () AS row_id, doc_id,
    {_WORDS.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
words AS (SELECT row_id, doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i, len(w) AS total FROM docs),
windows AS (
  SELECT row_id, doc_id, i, total, [word, lead(word) OVER f, lead(word, 2) OVER f, lead(word, 3) OVER f, lead(word, 4) OVER f] AS g
  FROM words WINDOW f AS (PARTITION BY row_id ORDER BY i)),
have AS (
  SELECT DISTINCT row_id, doc_id, n, g[1:n] AS s FROM windows, (SELECT DISTINCT n FROM items) WHERE i + n - 1 <= total),
hits AS (
  SELECT row_id, doc_id, item, item_id, count(*) AS c, any_value(total) AS total
  FROM (SELECT item, item_id, n, len(g) AS total, unnest(g) AS s FROM items) JOIN have USING (n, s)
  GROUP BY row_id, doc_id, item, item_id)
SELECT doc_id, item_id, c::DOUBLE / total::DOUBLE AS containment FROM hits WHERE c >= 0.8 * total - 1e-9"""

def _rules() -> str:
    """The license rules as SQL rows; base rules have priority -1."""
    rows = [(r, -1) for r in licenses.BASE] + [(r, r.priority) for r in licenses.RULES]
    return ",\n".join(f"({i}, '{r.label}', '{r.keyword}', '{r.pattern}', {p})" for i, (r, p) in enumerate(rows))


_OP12 = rf"""
WITH rules(place, label, keyword, pattern, priority) AS (VALUES {_rules()}),
spaced AS (
  SELECT doc_id, row_number() OVER () AS row_id, ' ' || trim(regexp_replace(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', '  ', 'g'), ' ') || ' ' AS norm
  FROM documents),
tried AS (
  SELECT row_id, place, label, priority, regexp_extract_all(norm, pattern) AS ms, string_split_regex(norm, pattern) AS pieces
  FROM spaced JOIN rules ON contains(norm, ' ' || keyword || ' ')),
counted AS (
  SELECT * REPLACE (list_transform(ms, lambda x: length(x) - length(replace(x, ' ', ''))) AS ms,
    list_transform(pieces, lambda x: length(x) - length(replace(x, ' ', ''))) AS pieces)
  FROM tried WHERE len(ms) > 0),
found AS (
  SELECT row_id, place, label, priority, unnest(list_transform(range(1, len(ms) + 1), lambda i: (list_sum(pieces[1:i])
    + coalesce(list_sum(ms[1:i - 1]), 0)) // 2))::BIGINT AS a, unnest(ms) // 2 AS n FROM counted),
rivals AS (SELECT * FROM found WHERE priority >= 0),
lost AS (
  SELECT DISTINCT d.row_id, d.place, d.a FROM rivals d JOIN rivals e ON d.row_id = e.row_id AND e.priority <= d.priority
    AND e.a <= d.a AND e.a + e.n >= d.a + d.n AND (e.n > d.n OR e.priority < d.priority OR e.place < d.place)),
held AS (
  SELECT f.* FROM found f LEFT JOIN lost l ON f.row_id = l.row_id AND f.place = l.place AND f.a = l.a WHERE l.a IS NULL)
SELECT any_value(doc_id) AS doc_id, any_value(CASE WHEN norm = '  ' THEN 0 ELSE (length(norm) - length(replace(norm, ' ', ''))) // 2 END) AS n_words,
  count(*) FILTER (priority = -1) AS n_base, min(a) FILTER (priority = -1) AS first_word, max(a) FILTER (priority = -1) AS last_word,
  coalesce(array_to_string(list_sort(list(DISTINCT label) FILTER (priority = -1)), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list(DISTINCT label) FILTER (label IS NOT NULL)), ','), '') AS labels,
  coalesce(max(CASE priority WHEN -1 THEN 0.5 WHEN 0 THEN 1.0 WHEN 1 THEN 0.9 WHEN 2 THEN 0.75 WHEN 3 THEN 0.4 END), 0.0)::DOUBLE AS score
FROM spaced LEFT JOIN held USING (row_id) GROUP BY row_id"""

#: The others are held against brute force in tests/llm: ranks that are passed on in rounds (op6), a keyed hash
#: that SQL lacks (op8), a trained model (op9), HTML (op10), runs of any period (op11).
SQL: dict[str, str] = {
    "op1_secret_scans": _OP1,
    "op2_substring_dedup": _OP2,
    "op3_quality_rules": _OP3,
    "op4_warc": _OP4,
    "op5_mixing": _OP5,
    "op7_decontamination": _OP7,
    "op12_license_scans": _OP12,
}
