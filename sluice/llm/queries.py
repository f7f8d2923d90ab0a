"""The registered queries of the text operators, beside their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import (
    attribution, collocations, decontaminate, jaccard, licenses, linededup, packing, pii, quality, sentencepieces, spelling, template, urlrules)
from .common import ORACLE, QUERIES, query, table

__all__ = ["ORACLE", "QUERIES"]

ASCII_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
NOT_SPACE = r"'[^\x20\x09-\x0D]+'"

JACCARD_SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, coalesce(regexp_extract_all({ASCII_LOWER}, {NOT_SPACE}), []) AS words FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
  ELSE list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' ')) END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * i >= 85 * (nx.n + ny.n - i)),
r AS (SELECT doc_id AS x, doc_id AS y FROM w UNION SELECT r.x, l.y FROM r JOIN l ON l.x = r.y),
c AS (SELECT x, min(y) AS component_id FROM r GROUP BY 1)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.x = w.doc_id
"""


@query("op8_ngram_jaccard", JACCARD_SQL)
def op8_ngram_jaccard(spark, sf):
    """Near-duplicate components of all documents by 4-word shingles at a Jaccard similarity of 0.85."""
    return jaccard.near_duplicates(table(spark, sf, "documents"), "doc_id", "text", k=4, percent=85)


@query("op3_quality_rules")
def op3_quality_rules(spark, sf):
    """Measures of every document and the verdict of the adaptive rules."""
    docs = table(spark, sf, "documents")
    return quality.quality_report(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op6_best_fit_packing")
def op6_best_fit_packing(spark, sf):
    """All documents packed into sequences of 4096 tokens."""
    import public_tokenizers

    return packing.pack(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


LINES_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS p FROM d),
u AS (SELECT doc_id, p, line, greatest(1, sum(CASE WHEN regexp_matches(line, '[^\x20\x09-\x0D]') THEN 1 ELSE 0 END)
  OVER (PARTITION BY doc_id ORDER BY p)) AS j, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS t FROM l),
f AS (SELECT doc_id, j, t, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS w FROM u WHERE t <> ''),
c AS (SELECT *, sum(w) OVER (PARTITION BY doc_id ORDER BY j) AS upto, sum(w) OVER (PARTITION BY doc_id ORDER BY j) - w AS before FROM f),
r AS (SELECT a.doc_id, a.j AS s, b.j AS e FROM c a JOIN c b ON a.doc_id = b.doc_id AND a.j <= b.j AND b.upto - a.before >= 50
  AND (b.before - a.before < 50 OR b.upto - a.upto < 50)),
g AS (SELECT r.doc_id, s, e, string_agg(t, chr(10) ORDER BY j) AS run FROM r JOIN c ON c.doc_id = r.doc_id AND c.j BETWEEN s AND e GROUP BY 1, 2, 3),
o AS (SELECT doc_id, s, e, row_number() OVER (PARTITION BY run ORDER BY doc_id, s) AS nth FROM g),
x AS (SELECT DISTINCT c.doc_id, c.j FROM c JOIN o ON o.doc_id = c.doc_id AND c.j BETWEEN o.s AND o.e WHERE o.nth > 1),
k AS (SELECT u.doc_id, string_agg(u.line, chr(10) ORDER BY u.p) AS text FROM u LEFT JOIN x ON x.doc_id = u.doc_id AND x.j = u.j WHERE x.j IS NULL GROUP BY 1)
SELECT d.doc_id, (SELECT count(*) FROM f WHERE f.doc_id = d.doc_id) AS n_lines, (SELECT count(*) FROM x WHERE x.doc_id = d.doc_id) AS n_removed,
  length(coalesce(k.text, '')) AS n_chars, sha256(coalesce(k.text, '')) AS text_sha256
FROM d LEFT JOIN k USING (doc_id)
"""


@query("op2_line_dedup", LINES_SQL)
def op2_line_dedup(spark, sf):
    """All documents without later copies of repeated line runs of 50 words or more."""
    text = F.coalesce("text", F.lit(""))
    return linededup.dedup_lines(table(spark, sf, "documents")).select(
        "doc_id", "n_lines", "n_removed", F.length(text).cast("long").alias("n_chars"), F.sha2(text, 256).alias("text_sha256"))


LEAKS_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all({ASCII_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, coalesce(regexp_extract_all({ASCII_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS w
  FROM benchmark),
iw AS (SELECT item, least(len(w), 10) AS n, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 10 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 8), lambda i: array_to_string(w[i:i + 9], ' ')) END) AS t FROM b),
t AS (SELECT DISTINCT n, t FROM iw),
dw AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS p, w FROM d, (SELECT DISTINCT n FROM t) WHERE len(w) >= n),
h AS (SELECT DISTINCT doc_id, p, n, t FROM (SELECT doc_id, p, n, array_to_string(w[p:p + n - 1], ' ') AS t FROM dw) JOIN t USING (n, t)),
words AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM h) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM h JOIN iw USING (n, t)) GROUP BY 1)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op1_benchmark_decontamination", LEAKS_SQL)
def op1_benchmark_decontamination(spark, sf):
    """Words of every document that lie in a 10-word window of a benchmark item, and those items."""
    found = decontaminate.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"), window=10)
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@query("op5_token_attribution")
def op5_token_attribution(spark, sf):
    """Tokens of every line of every document, from one encoding of the whole document."""
    import public_tokenizers

    return attribution.section_tokens(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


# The rules of the query (host, path, verdict).
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]

URL_SQL = f"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM u),
p AS (SELECT page_id, {ASCII_LOWER.replace("text", "coalesce(raw, '')")} AS host,
  coalesce(regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*'), '') AS path FROM h),
r(rh, rp, v) AS (VALUES {", ".join(map(str, URL_RULES))}),
m AS (SELECT page_id, max_by(rh || rp, length(rh || rp)) AS rule, max_by(v, length(rh || rp)) AS v FROM p JOIN r
  ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY 1)
SELECT p.page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM p LEFT JOIN m USING (page_id)
"""


@query("op9_url_filters", URL_SQL)
def op9_url_filters(spark, sf):
    """The rule that fits every page's URL, and the verdict."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urlrules.judge(table(spark, sf, "pages"), rules)


@query("op4_pii_surrogates")
def op4_pii_surrogates(spark, sf):
    """All documents with surrogates for personal data, and how many mentions each had by kind."""
    out = pii.pseudonymized(table(spark, sf, "documents").select("doc_id", "text"), secret="sluice")
    return out.select("doc_id", *[f"n_{kind}" for kind in pii.KINDS], "text")


def _template_words(text):
    return f"string_split(trim(regexp_replace(lower({text}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ')"


LICENSE_SQL = f"""
WITH t(license, text) AS (VALUES {", ".join("('" + k + "', '" + v + "')" for k, v in licenses.TEMPLATES.items())}),
tw AS (SELECT license, {_template_words("text")} AS w FROM t),
ts AS (SELECT DISTINCT license, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM tw),
dw AS (SELECT doc_id, {_template_words("coalesce(text, '')")} AS w FROM documents),
ds AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 5 THEN [] ELSE
  list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM dw),
f AS (SELECT doc_id, license FROM ds JOIN ts USING (s) JOIN (SELECT license, count(*) AS n FROM ts GROUP BY 1) USING (license)
  GROUP BY doc_id, license, n HAVING 100 * count(*) >= 80 * n)
SELECT d.doc_id, count(license) AS n_licenses, coalesce(string_agg(license, ',' ORDER BY license), '') AS licenses
FROM documents d LEFT JOIN f USING (doc_id) GROUP BY 1
"""


@query("op7_license_scan", LICENSE_SQL)
def op7_license_scan(spark, sf):
    """The licence notices that every document holds."""
    return licenses.license_report(table(spark, sf, "documents"))


@query("op10_html_extraction")
def op10_html_extraction(spark, sf):
    """The main text of every page."""
    return template.extract(table(spark, sf, "pages"))


@query("op11_sentencepiece")
def op11_sentencepiece(spark, sf):
    """Ids of every whole document, and the text they decode to, as digests."""
    import public_tokenizers

    out = sentencepieces.encode(table(spark, sf, "documents"), public_tokenizers.path("piece_bpe_32k.model"), decoded=True)
    return out.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


SPELLING_SQL = rf"""
WITH RECURSIVE step(b, c, i) AS (SELECT range, range, 0 FROM range(256) UNION ALL
  SELECT b, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i + 1 FROM step WHERE i < 8),
crc AS (SELECT list(c ORDER BY b) AS t FROM step WHERE i = 8),
bytes AS (SELECT map(list(chr(x::INTEGER)), list(bs)) AS m FROM (SELECT x, CASE WHEN x < 128 THEN [x] ELSE [192 + (x >> 6), 128 + (x & 63)] END AS bs
  FROM (SELECT range AS x FROM range(1, 256)))),
r AS (SELECT doc_id, unnest(regexp_extract_all({ASCII_LOWER}, '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
g AS (SELECT doc_id, run, count(*) AS c FROM r WHERE length(run) >= 6 GROUP BY 1, 2),
h AS (SELECT run, c, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(concat(doc_id, ':', run), ''),
  lambda ch: m[ch]))), lambda x, y: xor(x >> 8, t[xor(x & 255, y) + 1])), 4294967295) AS h FROM g, crc, bytes),
s AS (SELECT CASE WHEN h % 199 = 0 THEN concat(substr(run, 1, (h % length(run))::BIGINT), substr(run, (h % length(run))::BIGINT + 2)) ELSE run END AS word, c FROM h),
v AS (SELECT word, sum(c)::BIGINT AS n FROM s WHERE length(word) >= 6 GROUP BY 1 HAVING sum(c) >= 5),
e AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v),
x AS (SELECT word, n, concat(substr(word, 1, i - 1), '*', substr(word, i + 1)) AS replaced, concat(substr(word, 1, i - 1), substr(word, i + 1)) AS less FROM e),
p AS (SELECT a.word, b.word AS near, b.n AS near_n FROM x a JOIN x b ON a.replaced = b.replaced AND a.word <> b.word
  UNION SELECT x.word, v.word, v.n FROM x JOIN v ON v.word = less UNION SELECT v.word, x.word, x.n FROM x JOIN v ON v.word = less),
o AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS nth, count(*) OVER (PARTITION BY word) AS c FROM p),
f AS (SELECT v.word, v.n, coalesce(o.c, 0) AS n_near, CASE WHEN near_n >= 5 * v.n THEN near END AS form, CASE WHEN near_n >= 5 * v.n THEN near_n END AS form_n
  FROM v LEFT JOIN o ON o.word = v.word AND nth = 1),
w(word, root, form) AS (SELECT word, word, form FROM f UNION ALL SELECT w.word, f.word, f.form FROM w JOIN f ON f.word = w.form)
SELECT f.word, n, n_near, f.form, form_n, root FROM f JOIN w ON w.word = f.word AND w.form IS NULL
"""


@query("op12_spelling_variants", SPELLING_SQL)
def op12_spelling_variants(spark, sf):
    """Words of all documents, some with a letter left out on purpose, with their near words, forms and roots."""
    runs = spelling.letter_runs(table(spark, sf, "documents"))
    return spelling.group_variants(spelling.counted(runs.select(spelling.with_slips(runs, 199).alias("word"))))


COLLOCATION_SQL = rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({ASCII_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
t AS (SELECT lang, unnest(w) AS phrase, 1 AS k FROM w
  UNION ALL SELECT lang, unnest(list_transform(range(1, len(w)), lambda i: array_to_string(w[i:i + 1], ' '))), 2 FROM w WHERE len(w) > 1
  UNION ALL SELECT lang, unnest(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))), 3 FROM w WHERE len(w) > 2),
f AS (SELECT lang, phrase, k, count(*) AS a FROM t GROUP BY ALL),
n AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY 1),
c AS (SELECT * FROM f WHERE k > 1 AND a >= 10),
u AS (SELECT c.*, unnest(range(1, k)) AS cut, string_split(phrase, ' ') AS w FROM c),
s AS (SELECT u.*, x.a AS l, y.a AS r, (1000000::HUGEINT * u.a * u.a // (x.a::HUGEINT * y.a))::BIGINT AS score
  FROM u JOIN f x ON x.lang = u.lang AND x.phrase = array_to_string(w[:cut], ' ') JOIN f y ON y.lang = u.lang AND y.phrase = array_to_string(w[cut + 1:], ' ')),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS nth FROM s),
i AS (SELECT lang, unnest([array_to_string(string_split(phrase, ' ')[1:2], ' '), array_to_string(string_split(phrase, ' ')[2:3], ' ')]) AS phrase, a FROM c WHERE k = 3),
m AS (SELECT lang, phrase, max(a) AS longer FROM i GROUP BY 1, 2),
q AS (SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, b.a DESC, b.phrase) AS rank, b.phrase, b.a, l, r, score
  FROM b LEFT JOIN m ON m.lang = b.lang AND m.phrase = b.phrase WHERE nth = 1 AND (longer IS NULL OR 100 * longer < 50 * b.a))
SELECT q.lang, rank, phrase, a, l, r, n, score FROM q JOIN n USING (lang) WHERE rank <= 2000
"""


@query("op13_collocations", COLLOCATION_SQL)
def op13_collocations(spark, sf):
    """The 2000 phrases of two or three words of every language whose words attract each other most."""
    return collocations.collocations(table(spark, sf, "documents"))
