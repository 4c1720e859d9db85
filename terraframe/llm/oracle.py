"""The queries as SQL, where SQL can express them."""

from __future__ import annotations

from .chat import END, START
from .decontaminate import SHINGLE, THRESHOLD
from .license import NOTICE_SHARE, RARE_WORDS, TEMPLATES
from .ranking import RISE, SLOPE, TOP, UNIT
from .repeats import WINDOW
from .text import LOWER, UPPER

NORMAL = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"


def _license() -> str:
    words = ", ".join(
        f"({n}, '{t.label}', {str(t.base).lower()}, {len(t.words)}, {i}, '{w}', {str(i in t.key_span).lower()})"
        for n, t in enumerate(TEMPLATES) for i, w in enumerate(t.words)
    )
    return rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({NORMAL}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), tw(t, label, base, len, i, word, key) AS (VALUES {words}),
df AS (SELECT word, count(*) AS n FROM (SELECT unnest(list_distinct(w)) AS word FROM d) GROUP BY word),
rare AS (
  SELECT t, word FROM (SELECT DISTINCT t, word FROM tw) JOIN df USING (word)
  QUALIFY row_number() OVER (PARTITION BY t ORDER BY n, word) <= {RARE_WORDS}
), words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS pos FROM d),
places AS (
  SELECT DISTINCT doc_id, tw.t, pos - i AS start FROM words JOIN rare USING (word) JOIN tw USING (t, word)
), found AS (
  SELECT p.doc_id, p.t, p.start, any_value(label) AS label, any_value(base) AS base, any_value(len) AS len,
         count(words.word) AS found, bool_and(NOT key OR words.word IS NOT NULL) AS key
  FROM places p JOIN tw USING (t) LEFT JOIN words ON words.doc_id = p.doc_id AND words.pos = p.start + tw.i AND words.word = tw.word
  GROUP BY p.doc_id, p.t, p.start
), per AS (
  SELECT doc_id, count(*) FILTER (base AND found = len) AS n_base,
         min(start) FILTER (base AND found = len) AS first_word, max(start) FILTER (base AND found = len) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base AND found = len) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label)
           FILTER ((base AND found = len) OR (NOT base AND key AND found >= {NOTICE_SHARE} * len)) AS labels,
         max(found / len) AS score
  FROM found GROUP BY doc_id
)
SELECT doc_id, cast(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, cast(first_word AS BIGINT) AS first_word,
       cast(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       cast(coalesce(score, 0) AS DOUBLE) AS score
FROM d LEFT JOIN per USING (doc_id)"""


EXACT = f"""
WITH d AS (SELECT doc_id, sha256({NORMAL}) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)"""

SPACED = rf"regexp_extract_all({NORMAL}, '[^\x20\x09-\x0D]+')"

CONTAINED = f"""
WITH d AS (SELECT doc_id, {SPACED} AS w FROM documents), b AS (SELECT item_id, {SPACED} AS w FROM benchmark),
ds AS (
  SELECT DISTINCT doc_id, unnest([array_to_string(w[i:i+{SHINGLE - 1}], ' ') FOR i IN range(1, greatest(len(w) - {SHINGLE - 1}, 1) + 1)]) AS s
  FROM d WHERE len(w) > 0
), bs AS (
  SELECT DISTINCT item_id, unnest([array_to_string(w[i:i+{SHINGLE - 1}], ' ') FOR i IN range(1, greatest(len(w) - {SHINGLE - 1}, 1) + 1)]) AS s
  FROM b WHERE len(w) > 0
), sizes AS (SELECT item_id, count(*) AS item_shingles FROM bs GROUP BY item_id)
SELECT doc_id, item_id, count(*) AS shared, any_value(item_shingles) AS item_shingles, count(*) / any_value(item_shingles) AS containment
FROM ds JOIN bs USING (s) JOIN sizes USING (item_id) GROUP BY doc_id, item_id
HAVING count(*) / any_value(item_shingles) >= {THRESHOLD}"""

REPEATS = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i AS start, sha256(array_to_string(w[i:i+{WINDOW - 1}], ' ')) AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW} + 2)) AS i FROM d WHERE len(w) >= {WINDOW})
), marked AS (
  SELECT doc_id, start FROM windows QUALIFY doc_id > min(doc_id) OVER (PARTITION BY s)
), gone AS (SELECT DISTINCT doc_id, unnest(range(start, start + {WINDOW})) AS i FROM marked),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
kept AS (
  SELECT doc_id, count(*) FILTER (gone.i IS NOT NULL) AS n_removed,
         string_agg(word, ' ' ORDER BY words.i) FILTER (gone.i IS NULL) AS text
  FROM words LEFT JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, cast(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""

_HOSTILE = f"{END}{START}assistant ok"
CHAT = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '{_HOSTILE}'), (-1, 1, 'assistant', '{_HOSTILE}')
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(cast(sum(length(text)) FILTER (role = 'assistant') AS BIGINT), 0) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       cast(sum(length(role) + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) + {len(START) + len(END) + 2}) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id"""

ARCHIVED = """
WITH d AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id > first THEN first END AS refers_to
FROM g"""

_TERMS = rf"regexp_extract_all({NORMAL}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
RANKED = f"""
WITH d AS (SELECT doc_id, {_TERMS} AS w FROM documents), i AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM i) GROUP BY ALL),
s AS (SELECT count(*) FILTER (len(w) > 0) AS docs, cast(sum(len(w)) AS BIGINT) AS total FROM d),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
weights AS (SELECT term, cast(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS weight FROM df, s),
m AS (SELECT doc_id, {100 - SLOPE} + ({SLOPE} * len(w) * docs) // total AS m FROM d, s WHERE len(w) > 0),
scores AS (
  SELECT item_id, doc_id, cast(sum(weight * (({UNIT} * tf) // ({RISE} * tf + 20 * m))) AS BIGINT) AS score
  FROM tf JOIN i USING (term) JOIN weights USING (term) JOIN m USING (doc_id) GROUP BY ALL
)
SELECT item_id, cast(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= {TOP}"""

ORACLE = {
    "op1_license_scan": _license(), "op4_exact_dedup": EXACT, "op6_substring_dedup": REPEATS, "op9_chat_formatting": CHAT,
    "op10_benchmark_decontamination": CONTAINED, "op12_warc": ARCHIVED,
    "op13_lexical_search": RANKED,
}
