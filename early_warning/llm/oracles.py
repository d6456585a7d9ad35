"""DuckDB SQL of the text queries that SQL can express, written from their contracts."""

QUALITY = r"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents),
m AS (SELECT k, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
p AS (SELECT k, unnest(w) AS word, unnest(range(len(w))) AS i FROM m),
g AS (SELECT k, i, word, lead(word) OVER (PARTITION BY k ORDER BY i) AS w2,
             lead(word, 2) OVER (PARTITION BY k ORDER BY i) AS w3 FROM p),
o AS (SELECT k, i, count(*) OVER (PARTITION BY k, word, w2, w3) AS c FROM g WHERE w3 IS NOT NULL),
r AS (SELECT k, count(DISTINCT i + j) AS n FROM o, (VALUES (0), (1), (2)) v(j) WHERE c > 1 GROUP BY k),
s AS (SELECT k, sum(length(word)) AS chars, count(*) FILTER (word IN (
        'the','of','and','to','that','with','is','for','be','in','der','die','und','das','nicht','mit','ist','ein','eine',
        'zu','de','la','et','les','des','est','que','le','en','un','el','y','los','las','se','con','no',
        'The','Of','And','To','That','With','Is','For','Be','In','Der','Die','Und','Das','Nicht','Mit','Ist','Ein','Eine',
        'Zu','De','La','Et','Les','Des','Est','Que','Le','En','Un','El','Y','Los','Las','Se','Con','No')) AS stop
      FROM p GROUP BY k),
x AS (SELECT k, unnest(string_split(t, chr(10))) AS line FROM d),
l AS (SELECT k, count(*) AS n, count(*) - count(DISTINCT line) AS dup,
             count(*) FILTER (rtrim(line, ' ') LIKE '%...' OR rtrim(line, ' ') LIKE '%…') AS ell,
             count(*) FILTER (substring(ltrim(line, ' '), 1, 1) IN ('-', '*', '•', '‣', '●')) AS bullet
      FROM x WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY k),
v AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(chars, 0) AS BIGINT) AS word_chars,
             CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
             CAST(coalesce(dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words,
             coalesce(stop, 0) AS stop, coalesce(l.n, 0) AS n_lines, coalesce(ell, 0) AS ell, coalesce(bullet, 0) AS bullet
      FROM m LEFT JOIN r USING (k) LEFT JOIN s USING (k) LEFT JOIN l USING (k)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
        CASE WHEN n_words < 50 THEN ['too few words'] ELSE [] END
        || CASE WHEN 100 * n_repeat_words > 50 * n_words THEN ['repeated windows'] ELSE [] END
        || CASE WHEN n_words = 0 OR word_chars / n_words < 2 OR word_chars / n_words > 14 THEN ['mean word length'] ELSE [] END
        || CASE WHEN n_words > 0 AND n_symbols / n_words > 0.1 THEN ['symbols per word'] ELSE [] END
        || CASE WHEN n_words = 0 OR stop / n_words < 0.02 THEN ['stop words'] ELSE [] END
        || CASE WHEN n_lines > 0 AND n_dup_lines / n_lines > 0.5 THEN ['repeated lines'] ELSE [] END
        || CASE WHEN n_lines > 0 AND ell / n_lines > 0.5 THEN ['lines ending in an ellipsis'] ELSE [] END
        || CASE WHEN n_lines > 0 AND bullet / n_lines > 0.9 THEN ['bullet lines'] ELSE [] END AS broken
      FROM v)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, len(broken) = 0 AS kept,
       array_to_string(broken, ',') AS broken_rules
FROM f"""

_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

DECONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bs AS (SELECT item_id, w, least(10, len(w)) AS m, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS ix
       FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, m, array_to_string(list_slice(w, ix, ix + m - 1), ' ') AS g FROM bs),
ds AS (SELECT k, w, m, unnest(range(1, CAST(len(w) - m + 2 AS BIGINT))) AS ix
       FROM d, (SELECT DISTINCT m FROM bw) WHERE len(w) >= m),
hit AS (SELECT k, ix, m, item_id FROM (SELECT k, ix, m, array_to_string(list_slice(w, ix, ix + m - 1), ' ') AS g FROM ds)
        JOIN bw USING (m, g)),
words AS (SELECT k, count(DISTINCT i) AS n FROM (SELECT k, unnest(range(ix, ix + m)) AS i FROM hit) GROUP BY k),
items AS (SELECT k, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT k, CAST(item_id AS VARCHAR) AS item FROM hit WHERE item_id IS NOT NULL) GROUP BY k)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(words.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (k) LEFT JOIN items USING (k)"""

LINE_DEDUP = r"""
WITH x AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                  unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents),
l AS (SELECT doc_id, pos, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS nw FROM x),
c AS (SELECT *, CAST(sum(nw) OVER (PARTITION BY doc_id ORDER BY pos) AS BIGINT) AS upto FROM l WHERE nw > 0),
b AS (SELECT *, upto - nw AS b4 FROM c),
ahead AS (SELECT doc_id, min(pos) OVER f AS s, max(pos) OVER f AS e, string_agg(line, chr(10)) OVER f AS win,
                 max(upto) OVER f - b4 AS n
          FROM b WINDOW f AS (PARTITION BY doc_id ORDER BY b4 RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING)),
back AS (SELECT doc_id, min(pos) OVER f AS s, max(pos) OVER f AS e, string_agg(line, chr(10)) OVER f AS win,
                upto - min(b4) OVER f AS n
         FROM b WINDOW f AS (PARTITION BY doc_id ORDER BY upto RANGE BETWEEN 49 PRECEDING AND CURRENT ROW)),
w AS (SELECT doc_id, s, e, win FROM ahead WHERE n >= 50 UNION SELECT doc_id, s, e, win FROM back WHERE n >= 50),
later AS (SELECT doc_id, s, e FROM (
    SELECT *, row_number() OVER (PARTITION BY win ORDER BY doc_id, s) AS nth FROM w) WHERE nth > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, e + 1)) AS pos FROM later),
kept AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS text, count(*) AS n
         FROM x ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n FROM x GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text,
       CAST(coalesce(n.n, 0) AS BIGINT) AS n_lines, CAST(coalesce(n.n, 0) - coalesce(kept.n, 0) AS BIGINT) AS n_removed
FROM documents d LEFT JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)"""

SPELLING = r"""
WITH RECURSIVE
crc AS (SELECT list(list_reduce([n] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)
               ORDER BY n) AS t FROM range(256) r(n)),
runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents),
counted AS (SELECT id, run, count(*) AS n, hex(encode(id || ':' || run)) AS x FROM runs GROUP BY id, run),
hashed AS (SELECT run, n, xor(list_reduce([4294967295] || list_transform(range(1, len(x), 2), lambda i: CAST('0x' || x[i:i + 1] AS BIGINT)),
                  lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS h FROM counted, crc),
edited AS (SELECT n, CASE WHEN h % 97 = 0 THEN run[1:h % len(run)] || run[h % len(run) + 2:] ELSE run END AS word FROM hashed),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM edited WHERE len(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
d AS (SELECT word, n, i, word[1:i - 1] || word[i + 1:] AS x FROM v, LATERAL (SELECT unnest(range(1, len(word) + 1)) AS i)),
near AS (SELECT a.word, b.word AS o FROM d a JOIN d b ON a.x = b.x AND a.i = b.i AND a.word <> b.word
         UNION SELECT d.word, v.word FROM d JOIN v ON d.x = v.word
         UNION SELECT v.word, d.word FROM d JOIN v ON d.x = v.word),
best AS (SELECT near.word, count(*) AS n_near, min(struct_pack(k := -v.n, o := o)) AS b FROM near JOIN v ON v.word = o GROUP BY near.word),
f AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.k >= 2 * n THEN b.o END AS form,
             CASE WHEN -b.k >= 2 * n THEN -b.k END AS form_n FROM v LEFT JOIN best USING (word)),
way AS (SELECT word, word AS root FROM f UNION ALL SELECT way.word, f.form FROM way JOIN f ON way.root = f.word WHERE f.form IS NOT NULL),
root AS (SELECT way.word, way.root FROM way JOIN f ON way.root = f.word WHERE f.form IS NULL)
SELECT word, form, root, n, CAST(n_near AS BIGINT) AS n_near, CAST(form_n AS BIGINT) AS form_n FROM f JOIN root USING (word)"""

NEGATIVES = """
WITH v AS (SELECT DISTINCT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
      FROM v a JOIN v b ON a.id <> b.id AND a.id % 50 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (SELECT p.*, s.id AS negative_id, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id) AS rank
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
       AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3"""
