"""SQL for the operators that SQL can express."""

from __future__ import annotations

MIXTURE = r"""
WITH sized AS (
    SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
everything AS (SELECT count(*) AS n FROM sized),
dealt AS (
    SELECT sized.*, length(bin(size)) AS stratum, doc_id % (2 * CAST(floor(floor(sqrt(n)) / 2) AS BIGINT) + 1) AS cell
    FROM sized, everything),
places AS (
    SELECT source, sum(size) AS words, row_number() OVER (ORDER BY source IS NULL, source) AS place FROM sized GROUP BY source),
weighed AS (SELECT *, [5, 2, 1][(place - 1) % 3 + 1] AS weight FROM places),
levels AS (
    SELECT *, (sum(words) OVER () - coalesce(sum(3 * words) OVER earlier, 0))
              / (sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0)) AS level
    FROM weighed WINDOW earlier AS (ORDER BY words / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
    SELECT source, place, words, least(CAST(3 * words AS DOUBLE), max(level) OVER () * weight) AS target FROM levels),
ranked AS (
    SELECT d.doc_id, d.size, CAST(t.words AS BIGINT) AS source_size, t.target, t.place * 40503 % 65536 / 65536.0::DOUBLE AS start,
           CASE WHEN t.words > 0 THEN t.target / t.words ELSE 0 END AS share,
           row_number() OVER (PARTITION BY d.source ORDER BY stratum, cell, size, doc_id) AS nth
    FROM dealt d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(least(floor(nth * share + start) - floor((nth - 1) * share + start), 3) * size AS BIGINT) AS taken
FROM ranked
"""

# crc32 byte by byte over a table made by its rule; near words share a word with a letter masked, or one is the other without a letter.
VARIANTS = r"""
WITH RECURSIVE steps AS (
    SELECT list_transform(range(256), lambda b: list_reduce(list_concat([b], [0, 0, 0, 0, 0, 0, 0, 0]),
           lambda c, _: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS of_byte),
written AS (
    SELECT doc_id, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS w FROM documents)),
runs AS (SELECT doc_id, run, length(run) AS letters, count(*) AS k FROM written WHERE length(run) >= 7 GROUP BY ALL),
bytes AS (SELECT *, hex(encode(doc_id || ':' || run)) AS code FROM runs),
hashed AS (
    SELECT doc_id, run, letters, k, CASE WHEN doc_id IS NOT NULL THEN xor(4294967295, list_reduce(
           list_concat([4294967295], list_transform(range(1, length(code), 2), lambda i: CAST('0x' || substr(code, i, 2) AS BIGINT))),
           lambda c, b: xor(c >> 8, of_byte[xor(c, b) % 256 + 1]))) END AS h
    FROM bytes, steps),
slipped AS (
    SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % letters) || substr(run, h % letters + 2) ELSE run END AS word, k FROM hashed),
words AS (SELECT word, CAST(sum(k) AS BIGINT) AS n, length(word) AS letters FROM slipped WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
places AS (SELECT word, n, unnest(range(1, letters + 1)) AS i FROM words),
cut AS (SELECT DISTINCT word, n, substr(word, 1, i - 1) || substr(word, i + 1) AS less FROM places),
masked AS (SELECT word, n, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS mask FROM places),
near AS (
    SELECT a.word, b.word AS near, b.n AS near_n FROM masked a JOIN masked b ON a.mask = b.mask AND a.word <> b.word
    UNION ALL SELECT c.word, w.word, w.n FROM cut c JOIN words w ON c.less = w.word
    UNION ALL SELECT w.word, c.word, c.n FROM cut c JOIN words w ON c.less = w.word),
ranked AS (
    SELECT *, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS nth FROM near),
formed AS (
    SELECT w.word, CASE WHEN r.near_n >= 10 * w.n THEN r.near END AS form, w.n, coalesce(r.n_near, 0) AS n_near,
           CASE WHEN r.near_n >= 10 * w.n THEN r.near_n END AS form_n
    FROM words w LEFT JOIN ranked r ON w.word = r.word AND r.nth = 1),
led AS (
    SELECT word, word AS root FROM formed
    UNION ALL SELECT led.word, formed.form FROM led JOIN formed ON led.root = formed.word WHERE formed.form IS NOT NULL),
roots AS (SELECT led.word, led.root FROM led JOIN formed ON led.root = formed.word WHERE formed.form IS NULL)
SELECT formed.word, form, root, n, n_near, form_n FROM formed JOIN roots ON formed.word = roots.word
"""

LLM_ORACLES: dict[str, str] = {"op4_mixture": MIXTURE, "op12_spelling_variants": VARIANTS}
