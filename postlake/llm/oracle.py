"""DuckDB SQL with the expected rows of the queries that SQL can express."""

from __future__ import annotations

from postlake.llm.middle_fill import CHANGED_PERCENT, SEED, SUFFIX_FIRST_PERCENT, UNIT
from postlake.llm.phrase_index import PHRASE_WORDS, SLACK
from postlake.llm.secret_scan import BASE_RULES, RULES, Rule
from postlake.llm.spans import LEAST_SENTENCES, LEAST_WORDS


def _rule_spans(place: int, rule: Rule) -> str:
    """Spans of one rule: what lies between its matches and the matches themselves add up to places."""
    pattern = rule.pattern.replace("'", "''")
    return f"""cut_{place} AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '{pattern}', 0)) AS m,
    unnest(regexp_extract_all(text, '{pattern}', {rule.group})) AS g,
    unnest(regexp_split_to_array(text, '{pattern}')[:-2]) AS gap,
    unnest(range(len(regexp_extract_all(text, '{pattern}', 0)))) AS i
  FROM texts),
spans_{place} AS (
  SELECT doc_id, {place} AS place, '{rule.kind}' AS kind, g, m,
    CAST(sum(length(gap)) OVER w + sum(length(m)) OVER w - length(m) AS BIGINT) AS first
  FROM cut_{place} WINDOW w AS (PARTITION BY doc_id ORDER BY i))"""


def _secrets() -> str:
    kept = " UNION ALL ".join(
        f"SELECT doc_id, place, kind, first, first + length(m) AS last FROM spans_{i} WHERE length(g) >= {r.least}"
        for i, r in enumerate(RULES)
    )
    joined = "string_agg(concat(kind, ':', first, ':', last), ',' ORDER BY first, place)"
    counts = ", ".join(
        f"CAST(count(*) FILTER (place = {i}) AS BIGINT) AS n_{r.kind}" for i, r in enumerate(BASE_RULES)
    )
    return f"""WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
{", ".join(_rule_spans(i, r) for i, r in enumerate(RULES))},
kept AS ({kept})
SELECT doc_id, {counts},
  sha256(coalesce({joined} FILTER (place < {len(BASE_RULES)}), '')) AS base_sha256,
  coalesce({joined} FILTER (place IS NOT NULL), '') AS spans
FROM texts LEFT JOIN kept USING (doc_id) GROUP BY doc_id"""


_TOP = """WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(list_zip(q.w, c.w), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(q.w) = len(c.w)),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10"""

_LINKS = """WITH RECURSIVE fine AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND label IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM fine a JOIN fine b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (
  SELECT vec_id, vec_id AS r FROM embeddings
  UNION SELECT l.a, reach.r FROM reach JOIN links l ON l.b = reach.vec_id),
least AS (SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id)
SELECT v.vec_id, (SELECT CAST(count(*) AS BIGINT) FROM links WHERE a = v.vec_id) AS n_links, component_id,
  v.vec_id = component_id AS kept
FROM embeddings v JOIN least USING (vec_id)"""

_SENTENCE = r"[^.!?\n]*[.!?\n]+\s*|[^.!?\n]+"
_SPANS = rf"""WITH cut AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '{_SENTENCE}'), []) AS parts FROM documents),
numbered AS (SELECT doc_id, unnest(parts) AS part, unnest(range(len(parts))) AS nr FROM cut),
worded AS (
  SELECT *, string_split_regex(
      trim(translate(part, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), E' \t\n\r\v\f'), '\s+') AS words
  FROM numbered WHERE trim(part, E' \t\n\r\v\f') <> ''),
placed AS (
  SELECT doc_id, nr, array_to_string(words, ' ') AS plain, row_number() OVER w AS k, sum(len(words)) OVER w AS total,
    sum(len(words)) OVER w - len(words) AS earlier
  FROM worded WINDOW w AS (PARTITION BY doc_id ORDER BY nr)),
lists AS (SELECT doc_id, list(plain ORDER BY k) AS plains FROM placed GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id, a.k AS first, b.k AS last FROM placed a JOIN placed b
    ON a.doc_id = b.doc_id AND b.k BETWEEN a.k + {LEAST_SENTENCES - 1} AND a.k + {LEAST_WORDS}
    AND b.total - a.earlier >= {LEAST_WORDS}),
runs AS (
  SELECT doc_id, first, min(last) AS last FROM pairs GROUP BY doc_id, first
  UNION SELECT doc_id, max(first), last FROM pairs GROUP BY doc_id, last),
keyed AS (SELECT r.*, array_to_string(plains[first:last], ' ') AS words FROM runs r JOIN lists USING (doc_id)),
later AS (
  SELECT doc_id, first, last FROM keyed QUALIFY min((doc_id, first)) OVER (PARTITION BY words) <> (doc_id, first)),
gone AS (
  SELECT DISTINCT n.doc_id, n.nr FROM later l
  JOIN placed a ON a.doc_id = l.doc_id AND a.k = l.first JOIN placed b ON b.doc_id = l.doc_id AND b.k = l.last
  JOIN numbered n ON n.doc_id = l.doc_id AND n.nr BETWEEN a.nr AND b.nr)
SELECT c.doc_id, coalesce(string_agg(n.part, '' ORDER BY n.nr) FILTER (g.nr IS NULL), '') AS text,
  CAST(any_value(len(parts)) AS INT) AS n_sentences, CAST(count(g.nr) AS INT) AS n_removed
FROM cut c LEFT JOIN numbered n USING (doc_id) LEFT JOIN gone g ON g.doc_id = n.doc_id AND g.nr = n.nr GROUP BY c.doc_id"""

def _told(*values: str) -> str:
    fields = [f"coalesce(strlen(CAST({v} AS VARCHAR)) || ':' || CAST({v} AS VARCHAR), '-')" for v in values]
    return f"sha256({' || '.join(fields)})"


_CRC = """xor(4294967295, list_reduce(list_concat([4294967295],
    list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT))),
    lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]),
      lambda x, z: xor(x // 2, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END))))"""


def _tree(name: str, leaves: str, key: str) -> str:
    """All nodes of binary trees, one per ``key``: ``(key, lvl, idx, h, n)`` with ``n`` nodes on the level."""
    return f"""{name} AS (
  SELECT {key}, 0 AS lvl, idx, h, n FROM {leaves}
  UNION ALL
  SELECT {key}, lvl + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx)), (any_value(n) + 1) // 2
  FROM {name} WHERE n > 1 GROUP BY {key}, lvl, idx // 2)"""


_MANIFEST = f"""WITH RECURSIVE told AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, {_told("doc_id", "source", "lang", "n_chars", "text")} AS h,
    CASE WHEN {_CRC} % 7 = 0 THEN {_told("doc_id", "source", "lang", "n_chars + 1", "text")}
      ELSE {_told("doc_id", "source", "lang", "n_chars", "text")} END AS other
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS idx,
    count(*) OVER (PARTITION BY tree) AS n FROM told),
{_tree("nodes", "leaves", "tree")},
subroots AS (
  SELECT 0 AS one, tree, h, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n FROM nodes WHERE n = 1),
{_tree("tops", "subroots", "one")},
way AS (
  SELECT l.doc_id, l.tree, l.idx AS leaf_idx, 0 AS stage, v.lvl, (l.idx >> v.lvl) & 1 AS side, s.h AS sibling
  FROM leaves l JOIN nodes v ON v.tree = l.tree AND v.idx = l.idx >> v.lvl AND v.n > 1
  LEFT JOIN nodes s ON s.tree = v.tree AND s.lvl = v.lvl AND s.idx = xor(v.idx, 1)
  UNION ALL
  SELECT l.doc_id, l.tree, l.idx, 1, v.lvl, (r.idx >> v.lvl) & 1, s.h
  FROM leaves l JOIN subroots r ON r.tree = l.tree JOIN tops v ON v.idx = r.idx >> v.lvl AND v.n > 1
  LEFT JOIN tops s ON s.lvl = v.lvl AND s.idx = xor(v.idx, 1)),
steps AS (SELECT *, row_number() OVER (PARTITION BY tree, leaf_idx ORDER BY stage, lvl) AS k FROM way),
folded AS (
  SELECT tree, idx AS leaf_idx, CAST(0 AS BIGINT) AS k, other AS h FROM leaves
  UNION ALL
  SELECT f.tree, f.leaf_idx, s.k, sha256(CASE WHEN s.side = 1 THEN s.sibling || f.h ELSE f.h || coalesce(s.sibling, '') END)
  FROM folded f JOIN steps s ON s.tree = f.tree AND s.leaf_idx = f.leaf_idx AND s.k = f.k + 1),
last AS (SELECT tree, leaf_idx, max_by(h, k) AS folded_root FROM folded GROUP BY tree, leaf_idx),
proofs AS (
  SELECT tree, leaf_idx, string_agg(sibling, '' ORDER BY k) AS proof FROM steps GROUP BY tree, leaf_idx),
found AS (
  SELECT l.doc_id, l.h AS leaf, r.h AS subroot, (SELECT h FROM tops WHERE n = 1) AS root,
    sha256(coalesce(proof, '')) AS proof_sha256, folded_root
  FROM leaves l JOIN subroots r ON r.tree = l.tree JOIN last f ON f.tree = l.tree AND f.leaf_idx = l.idx
  LEFT JOIN proofs p ON p.tree = l.tree AND p.leaf_idx = l.idx)
SELECT *, folded_root = root AS verified FROM found"""

_DRAWS = ", ".join(f"CAST(('0x' || substr(d, {1 + 8 * i}, 8)) AS BIGINT) AS h{i + 1}" for i in range(4))
_MIDDLE_FILL = rf"""WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{UNIT}') AS units,
    sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d FROM documents),
drawn AS (SELECT *, CAST(len(units) AS BIGINT) AS n, {_DRAWS} FROM cut),
placed AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
      OR h3 % 100 >= {CHANGED_PERCENT} THEN 'plain' WHEN h4 % 100 < {SUFFIX_FIRST_PERCENT} THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
parts AS (
  SELECT *, array_to_string(units[1:low], '') AS p, array_to_string(units[low + 1:high], '') AS m,
    array_to_string(units[high + 1:], '') AS s FROM placed)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN concat('<P>', p, '<S>', s, '<M>', m)
    ELSE concat('<S>', s, '<P>', p, '<M>', m) END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts"""

_PLAIN_WORDS = (
    "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
_CONTAMINATION = f"""WITH docs AS (SELECT doc_id, coalesce({_PLAIN_WORDS}, []) AS w FROM documents),
items AS (SELECT item_id, {_PLAIN_WORDS} AS w FROM benchmark),
phrases AS (
  SELECT DISTINCT item_id, w[i + 1:i + {PHRASE_WORDS}] AS p FROM (
    SELECT *, unnest(range(greatest(len(w) - {PHRASE_WORDS}, 0) + 1)) AS i FROM items WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT len(p) AS n FROM phrases),
runs AS (
  SELECT doc_id, i, n, w[i + 1:i + n] AS p FROM (
    SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS i FROM docs JOIN lengths ON len(w) >= n)),
found AS (SELECT doc_id, item_id, i, n FROM runs JOIN phrases USING (p)),
words AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM found) GROUP BY doc_id),
named AS (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found),
listed AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM named GROUP BY doc_id),
words_at AS (SELECT doc_id, unnest(w) AS term, unnest(range(len(w))) AS pos FROM docs),
totals AS (SELECT term, count(*) AS total FROM words_at GROUP BY term),
places AS (SELECT p, unnest(p) AS term, unnest(range(len(p))) AS place FROM (SELECT DISTINCT p FROM phrases)),
rarest AS (
  SELECT p, term, place FROM places JOIN totals USING (term)
  QUALIFY row_number() OVER (PARTITION BY p ORDER BY total, term, place) = 1 AND count(*) OVER (PARTITION BY p) = len(p)),
begun AS (SELECT doc_id, p, pos - place AS start FROM rarest JOIN words_at USING (term)),
near AS (
  SELECT doc_id, p FROM (
    SELECT b.doc_id, b.p, b.start FROM begun b JOIN places s ON s.p = b.p JOIN words_at a ON a.doc_id = b.doc_id
      AND a.term = s.term AND a.pos BETWEEN b.start + s.place - {SLACK} AND b.start + s.place + {SLACK}
    GROUP BY b.doc_id, b.p, b.start HAVING count(DISTINCT s.place) = len(b.p))),
nearly AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_near FROM near JOIN phrases USING (p)
  WHERE NOT EXISTS (SELECT 1 FROM named n WHERE n.doc_id = near.doc_id AND n.item = CAST(item_id AS VARCHAR))
  GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near
FROM docs d LEFT JOIN words USING (doc_id) LEFT JOIN listed USING (doc_id) LEFT JOIN nearly USING (doc_id)"""

ORACLE = {
    "op13_contamination": _CONTAMINATION,
    "op11_manifest": _MANIFEST,
    "op12_middle_fill": _MIDDLE_FILL,
    "op7_embedding_links": _LINKS,
    "op8_repeated_spans": _SPANS,
    "op9_secrets": _secrets(),
    "op10_top_scores": _TOP,
}
