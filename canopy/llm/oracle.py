"""DuckDB statements of the queries that SQL can express, over whole tables."""

from . import quality as Q

WORD = r"[^\x20\x09-\x0D]+"
_CLASS_PATTERNS = {"lower": "[a-z]", "upper": "[A-Z]", "digit": "[0-9]", "space": r"[\x20\x09-\x0D]",
                   "stop": "[.,;:!?]", "mark": "[''\"()/-]", "control": r"[\x00-\x08\x0E-\x1F\x7F]",
                   "other": r"[^\x00-\x7F]"}


def _quality() -> str:
    """Base counts by lists and windows; the divergences from their definition."""
    count = {c: f"length(t) - length(regexp_replace(t, '{p}', '', 'g'))" for c, p in _CLASS_PATTERNS.items()}
    count["symbol"] = "length(t) - " + " - ".join(f"({count[c]})" for c in _CLASS_PATTERNS)
    classes = " UNION ALL ".join(f"SELECT doc_id, ref, '{c}' AS bin, {count[c]} AS n FROM d" for c in Q.CLASSES)

    def distance(name: str, doc_bins: str, ref_bins: str, guard: str) -> str:
        return f"""{name}_p AS (SELECT doc_id, ref, bin, n / sum(n) OVER (PARTITION BY doc_id) AS p FROM {doc_bins}
  WHERE doc_id IN (SELECT doc_id FROM {doc_bins} GROUP BY doc_id HAVING {guard})),
{name}_q AS (SELECT ref, bin, n / sum(n) OVER (PARTITION BY ref) AS q FROM {ref_bins}),
{name} AS (SELECT doc_id, sqrt(greatest(0, least(1, sum(
    CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END
    + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2))) AS distance
  FROM {name}_p JOIN {name}_q USING (ref, bin) GROUP BY doc_id)"""

    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS lang FROM documents),
split AS (SELECT doc_id, t, lang, regexp_extract_all(t, '{WORD}') AS w FROM docs),
own AS (SELECT lang FROM split WHERE lang <> '' GROUP BY lang
        HAVING count(*) >= {Q.MIN_DOCUMENTS} AND sum(len(w)) >= {Q.MIN_DOCUMENTS * Q.MIN_WORDS}),
d AS (SELECT doc_id, t, CASE WHEN lang IN (SELECT lang FROM own) THEN lang ELSE '' END AS ref, w FROM split),
lines AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS l FROM d),
win AS (SELECT doc_id, k, w[k] || ' ' || w[k + 1] || ' ' || w[k + 2] AS g
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS k FROM d)),
twice AS (SELECT doc_id, k FROM (SELECT doc_id, k, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT k + s) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS s) GROUP BY doc_id),
class_bins AS ({classes}),
class_ref AS (SELECT ref, bin, sum(n) AS n FROM class_bins WHERE ref <> '' GROUP BY ref, bin),
tokens AS (SELECT doc_id, ref, unnest(w) AS word FROM d),
counted AS (SELECT doc_id, ref, word, count(*) AS n FROM tokens GROUP BY ALL),
by_ref AS (SELECT ref, word, sum(n) AS n FROM counted WHERE ref <> '' GROUP BY ref, word),
common AS (SELECT ref, word, n FROM (SELECT ref, word, n, sum(n) OVER (PARTITION BY ref) AS total FROM by_ref)
           WHERE n >= {Q.COMMON_SHARE!r} * total),
word_ref AS (SELECT ref, 'w' || word AS bin, n FROM common UNION ALL
    SELECT ref, 'other', sum(n) FILTER (WHERE (ref, word) NOT IN (SELECT ref, word FROM common)) FROM by_ref GROUP BY ref),
word_bins AS (SELECT d.doc_id, d.ref, 'w' || c.word AS bin, coalesce(n.n, 0) AS n
    FROM d JOIN common c USING (ref) LEFT JOIN counted n ON n.doc_id = d.doc_id AND n.word = c.word
  UNION ALL SELECT d.doc_id, d.ref, 'other', len(d.w) - coalesce(sum(n.n), 0)
    FROM d LEFT JOIN (SELECT counted.doc_id, counted.n FROM counted JOIN common USING (ref, word)) n ON n.doc_id = d.doc_id
    GROUP BY d.doc_id, d.ref, len(d.w)),
{distance("class_js", "class_bins", "class_ref", f"sum(n) >= {Q.MIN_CHARS}")},
{distance("word_js", "word_bins", "word_ref", f"sum(n) >= {Q.MIN_WORDS}")},
base AS (SELECT d.doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words
  FROM d JOIN lines USING (doc_id) LEFT JOIN rep USING (doc_id)),
usual AS (SELECT ref, sum(n) FILTER (bin <> 'other') / sum(n) AS share FROM word_ref GROUP BY ref),
lack AS (SELECT doc_id FROM (SELECT doc_id, ref, sum(n) AS total, sum(n) FILTER (bin <> 'other') AS held
    FROM word_bins GROUP BY doc_id, ref HAVING sum(n) >= {Q.MIN_WORDS}) JOIN usual USING (ref)
  WHERE total * share >= {Q.EXPECTED_COMMON} AND held < {Q.LEAST_COMMON} * total * share),
judged AS (SELECT *, n_words < {Q.LEAST_WORDS} OR 100 * n_repeat_words > {Q.REPEAT_PERCENT} * n_words AS base_failed FROM base)
SELECT doc_id, n_words, CAST(word_chars AS BIGINT) AS word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(c.distance <= {Q.MAX_CLASS_DISTANCE}, TRUE)
    AND coalesce(v.distance <= {Q.MAX_WORD_DISTANCE}, TRUE) AND doc_id NOT IN (SELECT doc_id FROM lack) AS kept
FROM judged LEFT JOIN class_js c USING (doc_id) LEFT JOIN word_js v USING (doc_id)
"""


_UPPER, _LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"


def _lexical() -> str:
    def terms(key: str, table: str) -> str:
        return (f"SELECT {key}, regexp_extract_all(translate(coalesce(text, ''), {_UPPER}, {_LOWER}), "
                rf"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM {table}")

    return f"""
WITH d AS ({terms("doc_id", "documents")}), q AS ({terms("item_id", "benchmark")}),
c AS (SELECT count(*) FILTER (len(w) > 0) AS docs, CAST(sum(len(w)) AS BIGINT) AS total FROM d),
lengths AS (SELECT doc_id, 25 + (75 * len(w) * docs) // total AS m FROM d, c WHERE len(w) > 0),
tf AS (SELECT doc_id, t, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS t FROM d) GROUP BY ALL),
wt AS (SELECT t, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
       FROM tf, c GROUP BY t),
k AS (SELECT item_id, t, count(*) AS k FROM (SELECT item_id, unnest(w) AS t FROM q) GROUP BY ALL),
s AS (SELECT item_id, doc_id, CAST(sum(k * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
      FROM k JOIN wt USING (t) JOIN tf USING (t) JOIN lengths USING (doc_id) GROUP BY ALL HAVING score > 0),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM s)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 10
"""


def _spelling() -> str:
    """The checksum byte by byte; near words by the patterns that leave a code point out."""
    crc_step = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, CAST(3988292384 AS UBIGINT)) ELSE c >> 1 END"
    return f"""
WITH RECURSIVE codes AS (SELECT list_transform(range(256), lambda i: list_reduce(
    list_transform(range(9), lambda k: CAST(CASE WHEN k = 0 THEN i ELSE 0 END AS UBIGINT)), lambda c, z: {crc_step})) AS code),
runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, {_UPPER}, {_LOWER}), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
pairs AS (SELECT run, count(*) AS k, hex(encode(doc_id || ':' || run)) AS x FROM runs GROUP BY doc_id, run),
hashed AS (SELECT run, k, xor(list_reduce(list_prepend(CAST(4294967295 AS UBIGINT),
    list_transform(range(length(x) // 2), lambda i: CAST(('0x' || substr(x, 2 * i + 1, 2)) AS UBIGINT))),
    lambda c, b: xor(c >> 8, code[CAST(xor(c, b) & 255 AS BIGINT) + 1])), CAST(4294967295 AS UBIGINT)) AS h FROM pairs, codes),
slips AS (SELECT k, CASE WHEN h % 97 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT))
    || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word FROM hashed),
words AS MATERIALIZED (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM slips WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
cuts AS (SELECT word, n, i, substr(word, 1, i) AS a, substr(word, i + 2) AS b FROM
    (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS (SELECT x.word, y.word AS other, y.n AS other_n FROM cuts x JOIN cuts y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT x.word, y.word, y.n FROM cuts x JOIN words y ON x.a || x.b = y.word
  UNION SELECT y.word, x.word, x.n FROM cuts x JOIN words y ON x.a || x.b = y.word),
best AS (SELECT word, count(*) AS n_near, max(other_n) AS form_n FROM near GROUP BY word),
firsts AS (SELECT word, min(other) AS form FROM near JOIN best USING (word) WHERE other_n = form_n GROUP BY word),
formed AS MATERIALIZED (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 2 * n THEN form END AS form,
    CASE WHEN form_n >= 2 * n THEN form_n END AS form_n
  FROM words LEFT JOIN best USING (word) LEFT JOIN firsts USING (word)),
path(word, root) AS (SELECT word, word FROM formed
  UNION ALL SELECT path.word, formed.form FROM path JOIN formed ON formed.word = path.root WHERE formed.form IS NOT NULL),
ends AS (SELECT path.word, path.root FROM path JOIN formed ON formed.word = path.root WHERE formed.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)
"""


ORACLE_SQL = {
    "op11_lexical_search": _lexical(),
    "op13_spelling": _spelling(),
    "op2_quality": _quality(),
    "op6_minhash": rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w
  FROM documents),
s AS (SELECT DISTINCT doc_id, w[k] || ' ' || w[k + 1] AS g
      FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS k FROM d WHERE len(w) >= 2)
      UNION ALL SELECT doc_id, w[1] FROM d WHERE len(w) = 1),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id
           GROUP BY ALL),
links AS (SELECT x, y FROM common JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y
          WHERE 100 * c >= 80 * (p.n + q.n - c)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM d
  UNION SELECT reach.doc_id, edges.y FROM reach JOIN edges ON edges.x = reach.other)
SELECT r.doc_id, coalesce(max(n.n), 0) AS n_shingles, min(r.other) AS component_id, r.doc_id = min(r.other) AS kept
FROM reach r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
""",
    "op10_suffix_dedup": """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s
      FROM (SELECT doc_id, h, unnest(range(greatest(0, length(h) // 2 - 49))) AS i FROM d)),
f AS (SELECT s, min(doc_id) AS least FROM w GROUP BY s HAVING min(doc_id) < max(doc_id)),
c AS (SELECT w.doc_id, w.i FROM w JOIN f USING (s) WHERE f.least < w.doc_id),
e AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS first FROM c),
g AS (SELECT doc_id, i, sum(first) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM e),
r AS (SELECT doc_id, k, min(i) AS a, max(i) + 50 AS b FROM g GROUP BY doc_id, k),
p AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS z FROM r),
left_over AS (SELECT d.doc_id, any_value(length(h) // 2) AS n_bytes, coalesce(sum(b - a), 0) AS n_removed, count(a) AS n_spans,
    coalesce(string_agg(substr(h, 2 * z + 1, 2 * (a - z)), '' ORDER BY a), '')
      || substr(any_value(h), 2 * coalesce(max(b), 0) + 1) AS kept
  FROM d LEFT JOIN p USING (doc_id) GROUP BY d.doc_id)
SELECT doc_id, n_bytes, CAST(n_removed AS BIGINT) AS n_removed, n_spans, sha256(unhex(kept)) AS kept_sha256 FROM left_over
""",
    "op4_exact_dedup": """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW g AS (PARTITION BY coalesce(text, ''))
""",
    "op9_url_filters": r"""
WITH parsed AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
  FROM pages),
rules(verdict, rhost, rpath) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
         ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
fits AS (
  SELECT page_id, arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
         arg_max(verdict, length(rhost || rpath)) AS verdict
  FROM parsed JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY page_id)
SELECT p.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parsed p LEFT JOIN fits f ON p.page_id = f.page_id
""",
}
