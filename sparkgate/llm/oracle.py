"""DuckDB SQL for the training-data queries that SQL can express."""

CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
escaped AS (
  SELECT *, replace(replace(replace(role, '\', '\\'), '##', '#\h'), '</turn>', '<\eturn>') AS r,
    replace(replace(replace(text, '\', '\\'), '##', '#\h'), '</turn>', '<\eturn>') AS t
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(14 + length(replace(r, ':', '\c')) + length(t))::BIGINT AS formatted_chars
FROM escaped GROUP BY conv_id
"""

RULES = r"""
WITH words AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT row, i, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT row, w, unnest(range(1, len(w) - 3)) AS i FROM words)),
repeated AS (
  SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, s) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT row, count(DISTINCT p) AS n
  FROM (SELECT row, unnest(range(i, i + 5)) AS p FROM repeated) GROUP BY row),
lines AS (
  SELECT row, count(*) AS n_lines, count(DISTINCT line) AS n_different
  FROM (SELECT row, unnest(string_split(text, chr(10))) AS line FROM words)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY row),
measured AS (
  SELECT doc_id, len(w)::BIGINT AS n_words,
    length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    length(regexp_replace(text, '[^!]', '', 'g'))::BIGINT AS n_exclamations,
    coalesce(n_lines, 0)::BIGINT AS n_lines,
    coalesce(n_lines - n_different, 0)::BIGINT AS n_dup_lines,
    coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM words LEFT JOIN covered USING (row) LEFT JOIN lines USING (row)),
failing AS (
  SELECT *, (n_words < 10)::BIGINT
    + 2 * (100 * n_repeat_words > 20 * n_words)::BIGINT
    + 4 * (10 * n_symbols > n_words)::BIGINT
    + 8 * (2 * n_exclamations > n_words)::BIGINT
    + 16 * (n_dup_lines >= 3 AND 100 * n_dup_lines > 30 * n_lines)::BIGINT
    + 32 * (word_chars < 2 * n_words)::BIGINT
    + 64 * (word_chars > 15 * n_words)::BIGINT AS failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (failed & 3) <> 0 AS base_failed, failed = 0 AS kept, n_lines, n_exclamations, failed
FROM failing
"""

FILTER_AUDIT = r"""
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
says AS (
  SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
  FROM labels GROUP BY doc_id),
masks AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    (len(w) < 200)::INT
    + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
    + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t))::INT
    + 8 * regexp_matches(t, '[#$%&*|]')::INT
    + 16 * coalesce(min(doc_id) OVER (PARTITION BY t) < doc_id, false)::INT AS mask
  FROM words LEFT JOIN says USING (doc_id)),
cells AS (SELECT part, mask, good, toxic, count(*) AS n FROM masks GROUP BY ALL),
letter AS (SELECT chr(65 + i) AS c, 1 << i AS bit FROM (SELECT unnest(range(5))::INT AS i)),
orders AS (
  SELECT a.c || b.c || c.c || d.c || e.c AS filter_order,
    unnest([a.c, b.c, c.c, d.c, e.c]) AS c,
    unnest([a.bit, b.bit, c.bit, d.bit, e.bit]) AS bit,
    unnest([0, a.bit, a.bit + b.bit, a.bit + b.bit + c.bit, a.bit + b.bit + c.bit + d.bit]) AS before,
    unnest([1, 2, 3, 4, 5])::INT AS step
  FROM letter a, letter b, letter c, letter d, letter e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31),
steps AS (
  SELECT part, filter_order, step, c,
    coalesce(sum(n) FILTER (mask & (before | bit) = 0), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & before = 0), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & before <> 0), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
    coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & before = 0 AND good), 0)::BIGINT AS good_lost,
    coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & before = 0 AND toxic), 0)::BIGINT AS toxic_lost
  FROM cells, orders GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, c))::BIGINT AS shapley
FROM steps
"""

EXACT_TOPK = r"""
WITH ints AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM ints q, ints c WHERE q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
  FROM scored)
SELECT * FROM ranked WHERE rank <= 20
"""

#: crc32 is folded over the bytes of the text: letters are ASCII or U+00C0 to U+00FF.
SPELLING = r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i] || range(8), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id,
    translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
counted AS (SELECT id, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY ALL),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce([4294967295] || flatten(list_transform(
      string_split(id || ':' || run, ''),
      lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)::BIGINT] ELSE [195, ord(c)::BIGINT - 64] END)),
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) AS h
  FROM counted, crc),
written AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
    ELSE run END AS word, n FROM hashed),
vocabulary AS (
  SELECT word, sum(n)::BIGINT AS n FROM written WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
places AS (SELECT word, n, unnest(range(length(word)))::INT AS i FROM vocabulary),
holes AS (SELECT word, n, i, substr(word, 1, i) || '?' || substr(word, i + 2) AS rest FROM places),
shorter AS (SELECT DISTINCT word, n, substr(word, 1, i) || substr(word, i + 2) AS rest FROM places),
near AS (
  SELECT a.word, b.word AS near, b.n FROM holes a JOIN holes b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION ALL SELECT s.word, v.word, v.n FROM shorter s JOIN vocabulary v ON s.rest = v.word
  UNION ALL SELECT v.word, s.word, s.n FROM shorter s JOIN vocabulary v ON s.rest = v.word),
best AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY n DESC, near) AS near, max(n) AS near_n FROM near GROUP BY word),
forms AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN near_n >= 10 * v.n THEN near END AS form, CASE WHEN near_n >= 10 * v.n THEN near_n END AS form_n
  FROM vocabulary v LEFT JOIN best USING (word)),
chain AS (
  SELECT word, form AS root, 1 AS steps FROM forms WHERE form IS NOT NULL
  UNION ALL
  SELECT c.word, f.form, c.steps + 1 FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL),
ends AS (SELECT word, arg_max(root, steps) AS root FROM chain GROUP BY word)
SELECT f.word, form, coalesce(root, f.word) AS root, n, n_near, form_n FROM forms f LEFT JOIN ends USING (word)
"""

ORACLE: dict[str, str] = {
    "op1_chat": CHAT,
    "op9_rules": RULES,
    "op11_filter_audit": FILTER_AUDIT,
    "op12_spelling": SPELLING,
    "op13_exact_topk": EXACT_TOPK,
}
