"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from terrace.llm.align import op12_tokenizer_alignment
from terrace.llm.ann import op2_nearest_neighbours
from terrace.llm.chat import op9_quotation_linking
from terrace.llm.jaccard import op3_ngram_jaccard
from terrace.llm.licenses import CONTAINED, LOWER, TEMPLATES, TOKEN, UPPER, op6_license_scan
from terrace.llm.mixing import op5_mixing_weights
from terrace.llm.packing import op7_packing
from terrace.llm.pieces import op11_sentencepiece
from terrace.llm.quality import MOST_BANGS_PER_WORD, MOST_LOST, MOST_SYMBOLS_PER_WORD, op8_quality_rules
from terrace.llm.substring import op10_substring_dedup
from terrace.llm.suffix import op4_suffix_dedup
from terrace.llm.toxicity import op1_toxicity
from terrace.llm.trie import op13_conversation_trie

WORDS = r"'[^\x20\x09-\x0D]+'"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_toxicity, op2_nearest_neighbours, op3_ngram_jaccard, op4_suffix_dedup, op5_mixing_weights, op6_license_scan, op7_packing, op8_quality_rules, op9_quotation_linking, op10_substring_dedup, op11_sentencepiece, op12_tokenizer_alignment, op13_conversation_trie)}


_COMPONENTS = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {WORDS}) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY ALL),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
r(doc_id, c) AS (SELECT a, a FROM (SELECT DISTINCT a FROM l) UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(least(d.doc_id, m.c), d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT doc_id, min(c) AS c FROM r GROUP BY ALL) m USING (doc_id)
"""

_COVERED = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {WORDS}) AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + {{size}} - 1], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - {{size}} + 2)) AS i FROM d)),
dup AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY h) AS n FROM win) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + {{size}})) AS p FROM dup),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d)
"""

_REMOVED = (
    _COVERED.format(size=35)
    + """
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(g.n, 0)::BIGINT AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256
FROM d LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY ALL) g USING (doc_id)
LEFT JOIN (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY ALL) k USING (doc_id)
"""
)

_PASSAGES = (
    _COVERED.format(size=50)
    + """
, runs AS (SELECT doc_id, min(p) - 1 AS a, count(*) AS n FROM (SELECT doc_id, p, p - row_number() OVER (PARTITION BY doc_id ORDER BY p) AS g FROM gone) GROUP BY doc_id, g)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(r.n, 0)::BIGINT AS n_repeated, coalesce(r.spans, '') AS spans
FROM d LEFT JOIN (SELECT doc_id, sum(n) AS n, string_agg(a || '+' || n, ',' ORDER BY a) AS spans FROM runs GROUP BY ALL) r USING (doc_id)
"""
)

_QUALITY = rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS x, regexp_extract_all(coalesce(text, ''), {WORDS}) AS w FROM documents),
win AS (SELECT doc_id, i, w[i:i + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM t)),
rep AS (SELECT DISTINCT doc_id, unnest(range(i, i + 3)) AS p FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1),
line AS (SELECT doc_id, l, len(regexp_extract_all(l, {WORDS})) AS n, len(regexp_extract_all(l, '[#*$%&|<>]')) AS s, len(regexp_extract_all(l, '[!?]{{{{2,}}}}')) AS b,
  regexp_matches(lower(l), '(^|[^\pL\pM\p{{{{Nd}}}}\p{{{{Pc}}}}])({{phrases}})($|[^\pL\pM\p{{{{Nd}}}}\p{{{{Pc}}}}])') AS f FROM (SELECT doc_id, unnest(string_split(x, chr(10))) AS l FROM t) WHERE regexp_matches(l, {WORDS})),
lost AS (SELECT doc_id, count(*) - count(DISTINCT l) AS dup, coalesce(sum(n) FILTER (s > n * {{symbols}} OR b > n * {{bangs}} OR (n <= 12 AND f)), 0) AS lost FROM line GROUP BY ALL),
c AS (SELECT t.doc_id, len(w)::BIGINT AS n_words, len(array_to_string(w, ''))::BIGINT AS word_chars, len(regexp_extract_all(x, '[#*$%&|<>]'))::BIGINT AS n_symbols,
  coalesce(dup, 0)::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words, coalesce(lost, 0)::BIGINT AS lost_words
  FROM t LEFT JOIN lost USING (doc_id) LEFT JOIN (SELECT doc_id, count(*) AS n FROM rep GROUP BY ALL) r USING (doc_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND lost_words <= n_words * {{most}} AS kept FROM c
"""

_TEMPLATES = ", ".join("('" + k + "', '" + t.replace("'", "''") + "')" for k, t in TEMPLATES.items())
_TOKENS = f"regexp_extract_all(translate(coalesce(x, ''), '{UPPER}', '{LOWER}'), '{TOKEN}')"
_LICENSES = f"""
WITH t AS (SELECT license, {_TOKENS} AS w FROM (VALUES {_TEMPLATES}) AS v(license, x)),
o AS (SELECT DISTINCT license, 2 * len(w) AS span, array_to_string(w[i:i + 2], ' ') AS g FROM (SELECT license, w, unnest(range(1, len(w) - 1)) AS i FROM t)),
n AS (SELECT license, count(*) AS n FROM o GROUP BY ALL),
s AS (SELECT doc_id, i - 1 AS p, array_to_string(w[i:i + 2], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM (SELECT doc_id, {_TOKENS} AS w FROM (SELECT doc_id, text AS x FROM documents)))),
m AS (SELECT doc_id, license, span, p, g FROM s JOIN o USING (g)),
e AS (SELECT doc_id, license FROM m JOIN n USING (license) GROUP BY doc_id, license, n HAVING count(DISTINCT g) / n >= {CONTAINED}),
c AS (SELECT a.doc_id, a.license, a.p, count(DISTINCT b.g) AS k, max(b.p) - a.p AS long FROM m a JOIN m b ON a.doc_id = b.doc_id AND a.license = b.license AND b.p >= a.p AND b.p < a.p + a.span
  JOIN e ON e.doc_id = a.doc_id AND e.license = a.license GROUP BY a.doc_id, a.license, a.p),
b AS (SELECT doc_id, license, k / n AS contained, p, row_number() OVER (PARTITION BY doc_id, license ORDER BY k DESC, long, p) AS r FROM c JOIN n USING (license))
SELECT doc_id, license, contained, p::BIGINT AS first_word FROM b WHERE r = 1 AND contained >= {CONTAINED}
"""

#: The checksum of a conversation's number is worked out bit by bit. A node is named by the digest of all turns up to it, with their lengths.
_TRIE = """
WITH t AS (SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS x, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p FROM conversations WHERE conv_id IS NOT NULL),
i AS (SELECT c, c - c % 5 AS f, xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(c::VARCHAR, ''), lambda z: ascii(z)::UBIGINT)),
  lambda s, b: list_reduce(list_prepend(xor(s, b), range(8)::UBIGINT[]), lambda y, k: xor(y >> 1, 3988292384::UBIGINT * (y & 1)))), 4294967295::UBIGINT) % 9 AS h FROM (SELECT DISTINCT conv_id AS c FROM t)),
a AS (SELECT c, 1 AS s, p, r, x FROM i JOIN t ON conv_id = f AND p <= h UNION ALL SELECT c, 2, p, r, x FROM i JOIN t ON conv_id = c AND p > h),
b AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY s, p) AS d, strlen(x) AS size, length(r) || ':' || r || length(x) || ':' || x AS y FROM a),
k AS (SELECT c, d, size, sha256(string_agg(y, '') OVER (PARTITION BY c ORDER BY d)) AS key FROM b UNION ALL SELECT c, 0, 0, sha256('') FROM i),
m AS (SELECT *, lag(key) OVER (PARTITION BY c ORDER BY d) AS up, d = max(d) OVER (PARTITION BY c) AS last FROM k),
n AS (SELECT key, any_value(d) AS depth, any_value(up) AS up, min(c) AS conv, count(*) AS n, (count(*) - 1) * any_value(size) AS saved, string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (last) AS ends FROM m GROUP BY key),
kids AS (SELECT up AS key, count(*) AS n_children FROM n WHERE up IS NOT NULL GROUP BY ALL),
g AS (SELECT above.key, count(*) FILTER (n_children IS NULL) AS n_leaves, sum(saved) AS saved FROM n LEFT JOIN kids USING (key) JOIN m above ON above.c = n.conv AND above.d <= n.depth GROUP BY ALL)
SELECT n.conv AS conv_id, n.depth::BIGINT AS depth, p.conv AS parent_conv_id, n.n::BIGINT AS n_convs, coalesce(n_children, 0)::BIGINT AS n_children, g.n_leaves::BIGINT AS n_leaves, g.saved::BIGINT AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
FROM n LEFT JOIN n p ON p.key = n.up LEFT JOIN kids ON kids.key = n.key JOIN g ON g.key = n.key
"""


def oracle_sql() -> dict[str, str]:
    from terrace.llm.quality import BOILERPLATE, NAVIGATION

    return {
        "op3_ngram_jaccard": _COMPONENTS,
        "op4_suffix_dedup": _PASSAGES,
        "op6_license_scan": _LICENSES,
        "op8_quality_rules": _QUALITY.format(phrases="|".join(NAVIGATION + BOILERPLATE), symbols=MOST_SYMBOLS_PER_WORD, bangs=MOST_BANGS_PER_WORD, most=MOST_LOST),
        "op10_substring_dedup": _REMOVED,
        "op13_conversation_trie": _TRIE,
    }
