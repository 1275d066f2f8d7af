"""DuckDB SQL for the queries of this subpackage that SQL can express, on whole tables."""

_LOW = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"



#: The lines of url_lists.FILTERS, written out by hand as regular expressions over host and path.
_LABEL, _END = r"^([^/]*\.)?", r"([^A-Za-z0-9_.%-]|$)"
_BLOCKED = [
    _LABEL + r"(ads-track|adserver|doubleclick|tracker)\.", _LABEL + rf"pixel\.{_END}.*\.gif$", "/adserv/", "/banner-ads/", "/click-tracking/", "utm-redirect" + _END, _LABEL + "casino.*/(promo|bonus)/", r"casino\..*/(promo|bonus)/", r"free-bets\.",
    _LABEL + r"poker-online\.", "/slot-machine/", r"cheap-pills\.", _LABEL + "(viagra|porn|xxx-)", _LABEL + r"pharmacy-discount\.", "payday-loan", "/adult-videos/", "/keygen/", r"\.exe$", "/crack-download" + _END,
]
_ALLOWED = [_LABEL + r"wikipedia\.org" + _END, _LABEL + r"gambling-help\.", "/responsible-gambling/"]


def _any(regexes: list[str]) -> str:
    return " OR ".join(f"regexp_matches(host || path, '{r}')" for r in regexes)


OP5 = rf"""
WITH parts AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), cut AS (
  SELECT page_id, {_LOW.format("regexp_extract(coalesce(rest, ''), '^[^/?#]*')")} AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM parts
), ruled AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/' END AS rule FROM cut
)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
  WHEN {_any(_ALLOWED)} THEN 'allow' WHEN {_any(_BLOCKED)} THEN 'block'
  ELSE 'allow' END AS verdict FROM ruled
"""

_WORDS = r"regexp_extract_all(" + _LOW.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP7 = rf"""
WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 10 + 1, 1) + 1)) AS i FROM items WHERE len(w) > 0)
),
docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, sizes WHERE len(w) >= n)
),
found AS (SELECT p.doc_id, p.n, p.i, x.item_id FROM places p JOIN windows x ON p.n = x.n AND p.win = x.win),
hits AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
"""


def _escaped(column: str) -> str:
    out = rf"replace({column}, '\', '\\')"
    for c in ("<s>", "[INST]", "[/INST]", "</s>"):
        out = rf"replace({out}, '{c}', '{c[0]}\{c[1:]}')"
    return out


OP10 = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
       CAST(sum(20 + length({_escaped("role")}) + length({_escaped("text")})) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""

OP6 = rf"""
WITH RECURSIVE docs AS (SELECT doc_id, regexp_extract_all({_LOW.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM docs WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id WHERE 100 * common >= 85 * (x.n + y.n - common)),
ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a AS node, a AS other FROM ways UNION SELECT node, b FROM reach JOIN ways ON other = a),
least AS (SELECT node, min(other) AS component FROM reach GROUP BY node)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component, doc_id) AS component_id, coalesce(component, doc_id) = doc_id AS kept
FROM docs LEFT JOIN sizes USING (doc_id) LEFT JOIN least ON doc_id = node
"""

OP8 = """
WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
bytes AS (
  SELECT doc_id, i, substr(x, 2 * i + 1, 2) AS byte, CASE WHEN 2 * i + 100 <= length(x) THEN substr(x, 2 * i + 1, 100) END AS string
  FROM (SELECT doc_id, x, unnest(range(0, length(x) // 2)) AS i FROM texts)
),
firsts AS (SELECT string, min(doc_id) AS first FROM bytes WHERE string IS NOT NULL GROUP BY string),
hits AS (SELECT doc_id, i FROM bytes JOIN firsts USING (string) WHERE first < doc_id),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM hits, range(0, 50) AS t(k)),
marked AS (SELECT b.doc_id, b.i, byte, g.i IS NOT NULL AS removed FROM bytes b LEFT JOIN gone g ON b.doc_id = g.doc_id AND b.i = g.i),
edges AS (SELECT *, removed AND NOT coalesce(lag(removed) OVER (PARTITION BY doc_id ORDER BY i), false) AS starts FROM marked),
done AS (
  SELECT doc_id, count(*) AS n_bytes, count(*) FILTER (WHERE removed) AS n_removed, count(*) FILTER (WHERE starts) AS n_spans,
         coalesce(string_agg(CASE WHEN NOT removed THEN byte END, '' ORDER BY i), '') AS kept FROM edges GROUP BY doc_id
)
SELECT doc_id, coalesce(n_bytes, 0) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM texts LEFT JOIN done USING (doc_id)
"""

_DIGEST32 = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((part >> {k}) & 31) + 1, 1)" for k in (15, 10, 5, 0))

OP11 = rf"""
WITH rows AS (SELECT page_id, coalesce(html, '') AS payload, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages),
cut AS (SELECT *, list_transform(range(0, 8), lambda k: CAST('0x' || substr(sha1(payload), 5 * k + 1, 5) AS BIGINT)) AS parts FROM rows)
SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes, array_to_string(list_transform(parts, lambda part: {_DIGEST32}), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to,
       CASE WHEN page_id = first THEN CAST(octet_length(encode(payload)) AS BIGINT) ELSE 0 END AS stored_bytes
FROM cut
"""


def _crc32(text: str) -> str:
    """crc32 of a string's UTF-8 bytes, from the table `crc` (t)."""
    bytes_ = f"list_transform(range(0, octet_length(encode({text}))), lambda k: CAST('0x' || substr(hex(encode({text})), 2 * k + 1, 2) AS BIGINT))"
    return f"xor(list_reduce(list_concat([4294967295], {bytes_}), lambda c, b: xor(c >> 8, t[CAST(xor(c & 255, b) AS INTEGER) + 1])), 4294967295)"


_CRC = "crc AS (SELECT list_transform(range(0, 256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"

OP12 = rf"""
WITH RECURSIVE {_CRC},
runs AS (SELECT doc_id, {_LOW.format("unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+'))")} AS run FROM documents),
hashed AS (SELECT doc_id, run, {_crc32("(CAST(doc_id AS VARCHAR) || ':' || run)")} AS h FROM (SELECT * FROM runs WHERE length(run) >= 7), crc),
made AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed),
words AS MATERIALIZED (SELECT word, count(*) AS n FROM made WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
gaps AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM places),
pairs AS (
  SELECT a.word AS a, b.word AS b, b.n AS bn FROM gaps a JOIN gaps b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM gaps a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM gaps a JOIN words b ON a.rest = b.word
),
near AS (SELECT a AS word, count(*) AS n_near, max(bn) AS best_n FROM pairs GROUP BY a),
best AS (SELECT a AS word, min(b) AS best FROM pairs JOIN near ON a = near.word AND bn = best_n GROUP BY a),
formed AS MATERIALIZED (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 10 * n THEN best END AS form, CASE WHEN best_n >= 10 * n THEN best_n END AS form_n
  FROM words LEFT JOIN near USING (word) LEFT JOIN best USING (word)
),
chain AS (SELECT word, word AS here, 0 AS step FROM formed UNION ALL SELECT chain.word, f.form, step + 1 FROM chain JOIN formed f ON chain.here = f.word WHERE f.form IS NOT NULL),
ends AS (SELECT word, arg_max(here, step) AS root FROM chain GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)
"""


def _field(name: str) -> str:
    return f"coalesce(CAST(octet_length(encode(CAST({name} AS VARCHAR))) AS VARCHAR) || ':' || CAST({name} AS VARCHAR), '-')"


_LEAF = "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", "text"))) + ")"

OP13 = rf"""
WITH RECURSIVE {_CRC},
leaves AS MATERIALIZED (
  SELECT doc_id, coalesce('+' || lang, '') AS g, {_LEAF} AS leaf,
         CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 7 = 0 THEN {_LEAF.replace("n_chars", "(n_chars + 1)")} END AS tampered FROM documents, crc
),
ranked AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS size FROM leaves),
tree AS (
  SELECT g, 0 AS level, pos, leaf AS digest, size FROM ranked
  UNION ALL
  SELECT a.g, a.level + 1, a.pos // 2, sha256(a.digest || coalesce(b.digest, '')), (a.size + 1) // 2
  FROM tree a LEFT JOIN tree b ON a.g = b.g AND b.pos = a.pos + 1 WHERE a.pos % 2 = 0 AND a.size > 1
),
subroots AS MATERIALIZED (SELECT g, digest AS subroot, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS size FROM (SELECT g, digest FROM tree WHERE size = 1)),
upper AS (
  SELECT 0 AS level, pos, subroot AS digest, size FROM subroots
  UNION ALL
  SELECT a.level + 1, a.pos // 2, sha256(a.digest || coalesce(b.digest, '')), (a.size + 1) // 2
  FROM upper a LEFT JOIN upper b ON b.pos = a.pos + 1 WHERE a.pos % 2 = 0 AND a.size > 1
),
steps AS (
  SELECT r.g, r.pos AS leaf_pos, t.level, (r.pos >> t.level) & 1 AS odd, coalesce(s.digest, '') AS digest
  FROM ranked r JOIN tree t ON t.g = r.g AND t.pos = r.pos >> t.level AND t.size > 1 LEFT JOIN tree s ON s.g = r.g AND s.level = t.level AND s.pos = xor(r.pos >> t.level, 1)
  UNION ALL
  SELECT r.g, r.pos, 1000 + t.level, (q.pos >> t.level) & 1, coalesce(s.digest, '')
  FROM ranked r JOIN subroots q ON q.g = r.g JOIN upper t ON t.pos = q.pos >> t.level AND t.size > 1 LEFT JOIN upper s ON s.level = t.level AND s.pos = xor(q.pos >> t.level, 1)
),
paths AS MATERIALIZED (SELECT g, leaf_pos AS pos, sha256(string_agg(digest, '' ORDER BY level)) AS proof, list({{'odd': odd, 'digest': digest}} ORDER BY level) AS path FROM steps GROUP BY ALL),
fold AS (
  SELECT g, pos, 0 AS step, coalesce(tampered, leaf) AS digest FROM ranked
  UNION ALL
  SELECT f.g, f.pos, step + 1, CASE WHEN path[step + 1].odd = 1 THEN sha256(path[step + 1].digest || f.digest) ELSE sha256(f.digest || path[step + 1].digest) END
  FROM fold f JOIN paths p ON p.g = f.g AND p.pos = f.pos WHERE step < len(path)
),
folded AS (SELECT g, pos, arg_max(digest, step) AS folded_root FROM fold GROUP BY ALL)
SELECT doc_id, leaf, subroot, (SELECT digest FROM upper WHERE size = 1) AS root, coalesce(proof, sha256('')) AS proof_sha256, folded_root,
       folded_root = (SELECT digest FROM upper WHERE size = 1) AS verified
FROM ranked JOIN subroots USING (g) JOIN folded ON folded.g = ranked.g AND folded.pos = ranked.pos LEFT JOIN paths ON paths.g = ranked.g AND paths.pos = ranked.pos
"""

ORACLE_SQL = {"op8_repeats": OP8, "op6_near_dedup": OP6, "op5_url_rules": OP5, "op7_decontaminate": OP7, "op10_chat": OP10, "op11_warc": OP11, "op12_spelling": OP12, "op13_merkle": OP13}
