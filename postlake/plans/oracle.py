"""DuckDB SQL with the expected rows of the registered queries, over the same whole tables."""

from __future__ import annotations

from postlake.plans.registry import (
    CHECKS, HARVEST_LIMIT, LIMIT, PAGE_SIZE, POOL_TARGET, RUN_AT, SEEDED_AT, SHARED_LIMIT, TERMS,
)

_POSTS_RAW = """posts_raw AS (
  SELECT doc_id,
    CASE WHEN doc_id % 11 = 0 THEN NULL WHEN doc_id % 13 = 0 THEN '' ELSE md5(text) END AS id,
    concat('t3_', doc_id) AS name, split_part(text, chr(10), 1) AS title, source AS author,
    concat(lang, '_', source) AS subreddit,
    CASE WHEN doc_id % 10 = 3 THEN '' ELSE concat('/r/', lang, '/comments/', doc_id, '/') END AS permalink,
    concat('https://example.org/', doc_id) AS url,
    CASE WHEN doc_id % 7 = 0 THEN NULL ELSE text END AS selftext,
    CAST(1700000000 + doc_id * 60 AS DOUBLE) AS created_utc, n_chars AS score, doc_id % 50 AS num_comments
  FROM documents)"""

_POST_FIELDS = """id, name, title, author, subreddit, permalink,
  CASE WHEN permalink <> '' THEN concat('https://www.reddit.com', permalink) ELSE url END AS link,
  substring(coalesce(selftext, ''), 1, 269) AS description, created_utc, score, num_comments"""

_VALUES = ", ".join(f"({i}, '{t}')" for i, t in enumerate(TERMS, 1))

_HITS = f"""terms(q_idx, term) AS (VALUES {_VALUES}),
tok AS (
  SELECT doc_id, md5(text) AS id, unnest(string_split_regex(lower(text), '[^\\p{{L}}\\p{{M}}\\p{{N}}]+')) AS word FROM documents),
found AS (
  SELECT q_idx, term, id, doc_id, count(*) AS tf FROM tok JOIN terms ON word = term GROUP BY ALL),
uniq AS (
  SELECT * FROM found QUALIFY row_number() OVER (PARTITION BY term, id ORDER BY tf DESC, doc_id) = 1),
hits AS (
  SELECT *, row_number() OVER (PARTITION BY term ORDER BY tf DESC, doc_id) AS pos FROM uniq
  QUALIFY pos <= {LIMIT}),
owned AS (
  SELECT * FROM hits QUALIFY row_number() OVER (PARTITION BY id ORDER BY q_idx, pos) = 1),
nq AS (SELECT id, count(DISTINCT term) AS queries FROM hits GROUP BY id),
stats AS (
  SELECT t.q_idx, t.term, CAST(count(h.id) AS BIGINT) AS total,
    CAST(count(*) FILTER (queries = 1) AS BIGINT) AS unique_cnt
  FROM terms t LEFT JOIN hits h USING (term) LEFT JOIN nq USING (id) GROUP BY t.q_idx, t.term)"""


def _harvest(stop: str) -> str:
    return f"""WITH hdr0 AS (
  SELECT DISTINCT source AS query, doc_id // 200 AS page_no FROM documents),
hdr AS (
  SELECT query, page_no, CASE WHEN page_no = max(page_no) OVER (PARTITION BY query) THEN NULL
    WHEN query = 'src5' AND page_no = 3 THEN NULL ELSE concat(query, '_', page_no) END AS after_token FROM hdr0),
held AS (
  SELECT * FROM (SELECT source AS query, doc_id // 200 AS page_no, doc_id AS pos, concat('p', n_chars % 37) AS id
    FROM documents)
  WHERE NOT (query = 'src7' AND page_no = 1) AND NOT (query = 'src8' AND page_no IN (1, 2))),
firsts AS (SELECT query, id, min(page_no) AS page_no FROM held GROUP BY query, id),
pages AS (
  SELECT query, page_no, after_token,
    (SELECT count(*) FROM held p WHERE p.query = h.query AND p.page_no = h.page_no) AS n_rows,
    (SELECT count(*) FROM firsts f WHERE f.query = h.query AND f.page_no = h.page_no) AS new_cnt
  FROM hdr h),
marked AS (
  SELECT *, after_token IS NULL OR ({stop}) AS stops FROM (
    SELECT *, lag(n_rows) OVER (PARTITION BY query ORDER BY page_no) AS prev_rows FROM pages)),
run AS (
  SELECT *,
    coalesce(sum(new_cnt) OVER w, 0) AS before,
    coalesce(bool_or(stops) OVER w, false) AS stopped
  FROM marked WINDOW w AS (
    PARTITION BY query ORDER BY page_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
replay AS (
  SELECT query, page_no, CAST(new_cnt AS BIGINT) AS new_cnt, before < {HARVEST_LIMIT} AND NOT stopped AS accepted
  FROM run)"""


def _shared(stop: str) -> str:
    """Queries one after another; each step carries the list of posts seen so far."""
    return f"""WITH RECURSIVE hdr0 AS (
  SELECT DISTINCT source AS query, doc_id // 200 AS page_no FROM documents),
hdr AS (
  SELECT query, page_no, CASE WHEN page_no = max(page_no) OVER (PARTITION BY query) THEN NULL
    WHEN query = 'src5' AND page_no = 3 THEN NULL ELSE concat(query, '_', page_no) END AS after_token FROM hdr0),
asked AS (
  SELECT query, CAST(substring(query, 4) AS INT) AS q_idx, row_number() OVER (ORDER BY CAST(substring(query, 4) AS INT)) AS nr
  FROM (SELECT DISTINCT query FROM hdr)),
held AS (
  SELECT * FROM (SELECT source AS query, doc_id // 200 AS page_no, doc_id AS pos, concat('p', n_chars % 211) AS id
    FROM documents)
  WHERE NOT (query = 'src7' AND page_no = 1) AND NOT (query = 'src8' AND page_no IN (1, 2))),
firsts AS (SELECT query, id, min(page_no) AS page_no FROM held GROUP BY query, id),
pages AS (
  SELECT query, page_no, after_token, q_idx, nr,
    (SELECT count(*) FROM held p WHERE p.query = h.query AND p.page_no = h.page_no) AS n_rows,
    coalesce((SELECT list(f.id) FROM firsts f WHERE f.query = h.query AND f.page_no = h.page_no), []) AS ids
  FROM hdr h JOIN asked USING (query)),
marked AS (
  SELECT *, after_token IS NULL OR ({stop}) AS stops FROM (
    SELECT *, lag(n_rows) OVER (PARTITION BY query ORDER BY page_no) AS prev_rows FROM pages)),
step AS (
  SELECT CAST(0 AS BIGINT) AS nr, (SELECT list(DISTINCT concat('p', n_chars % 211)) FROM documents WHERE doc_id % 50 = 0) AS seen,
    CAST([] AS STRUCT(page_no BIGINT, new_cnt BIGINT, accepted BOOLEAN)[]) AS found
  UNION ALL
  SELECT nr, list_distinct(list_concat(any_value(seen), flatten(list(fresh) FILTER (accepted)))),
    list(struct_pack(page_no := page_no, new_cnt := new_cnt, accepted := accepted))
  FROM (
    SELECT *, coalesce(sum(new_cnt) OVER w, 0) < {SHARED_LIMIT} AND NOT coalesce(bool_or(stops) OVER w, false) AS accepted
    FROM (
      SELECT m.nr, m.page_no, m.stops, s.seen, list_filter(m.ids, lambda i: NOT list_contains(s.seen, i)) AS fresh,
        CAST(len(list_filter(m.ids, lambda i: NOT list_contains(s.seen, i))) AS BIGINT) AS new_cnt
      FROM step s JOIN marked m ON m.nr = s.nr + 1)
    WINDOW w AS (ORDER BY page_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
  GROUP BY nr),
shared AS (
  SELECT a.q_idx, a.query, f.page_no, f.new_cnt, f.accepted
  FROM (SELECT nr, unnest(found) AS f FROM step) JOIN asked a USING (nr))"""


_REPLAY_OUT = " SELECT query, page_no, new_cnt, accepted FROM replay"

_HARVEST_HITS = _harvest("n_rows = 0") + """,
harvested AS (
  SELECT CAST(substring(query, 4) AS INT) AS q_idx, query, id, page_no, pos
  FROM held JOIN replay USING (query, page_no) WHERE accepted
  QUALIFY row_number() OVER (PARTITION BY query, id ORDER BY page_no, pos) = 1)"""

# Text of a document as lines, sentences and clauses, as the payloads have them.
_COMMENTS = """valid AS (
  SELECT * FROM documents WHERE doc_id % 10 <> 3 AND doc_id % 9 NOT IN (4, 7)),
lines AS (
  SELECT doc_id, lang, source, unnest(parts) AS l, unnest(range(len(parts))) AS i
  FROM (SELECT *, string_split(text, chr(10)) AS parts FROM valid)),
kept_lines AS (SELECT * FROM lines WHERE i % 4 <> 3),
sentences AS (
  SELECT doc_id, lang, i, unnest(parts) AS s, unnest(range(len(parts))) AS j
  FROM (SELECT *, string_split(l, '. ') AS parts FROM kept_lines) WHERE len(parts) > 1),
clauses AS (
  SELECT doc_id, i, j, unnest(parts) AS c, unnest(range(len(parts))) AS k
  FROM (SELECT *, string_split(s, ', ') AS parts FROM sentences) WHERE len(parts) > 1),
comments AS (
  SELECT doc_id, CAST(i AS VARCHAR) AS path, 1 AS depth, source AS author, l AS body,
    CASE WHEN i % 3 <> 1 THEN CAST(length(l) AS BIGINT) END AS score FROM kept_lines
  UNION ALL
  SELECT doc_id, concat(i, '.', j), 2, lang, s, CAST(j AS BIGINT) FROM sentences
  UNION ALL
  SELECT doc_id, concat(i, '.', j, '.', k), 3, '', c, NULL FROM clauses WHERE k % 3 <> 2)"""

_ENRICHED = f"""{_POSTS_RAW}, {_COMMENTS},
counted AS (SELECT doc_id, CAST(count(*) AS BIGINT) AS n FROM comments GROUP BY doc_id),
older AS (
  SELECT doc_id, 'old' AS body FROM documents WHERE doc_id % 10 <> 3 AND doc_id % 9 IN (4, 7) AND doc_id % 7 = 0),
details AS (SELECT doc_id, text AS body FROM valid UNION ALL SELECT doc_id, body FROM older),
enriched AS (
  SELECT p.doc_id, p.id, p.name, d.body, CASE WHEN d.doc_id IS NOT NULL THEN coalesce(n, 0) END AS n_comments,
    d.doc_id IS NOT NULL AS has_details
  FROM posts_raw p LEFT JOIN details d USING (doc_id) LEFT JOIN counted c USING (doc_id))"""

_LOG = """log AS (
  SELECT event_id, ts, concat('http://h', user_id, ':8080') AS endpoint, event_type <> 'error' AS ok,
    CASE WHEN event_type <> 'error' THEN 200 WHEN k = 0 THEN 404 WHEN k = 1 THEN 429 ELSE 500 + k END AS status
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events))"""

_KIND = """CASE WHEN status IN (400, 401, 403, 404, 407, 410) THEN 'dead'
  WHEN status IN (408, 429, 500, 502, 503, 504, 520, 522, 524) OR status >= 500 THEN 'temporary' ELSE 'dead' END"""

_HEALTH = f"""{_LOG},
islands AS (
  SELECT *, sum(CASE WHEN ok THEN 1 ELSE 0 END) OVER (PARTITION BY endpoint ORDER BY ts, event_id) AS island FROM log),
runs AS (
  SELECT endpoint, island, count(*) FILTER (NOT ok) AS fails FROM islands GROUP BY endpoint, island),
streaks AS (
  SELECT endpoint, CAST(max(fails) AS BIGINT) AS max_streak, CAST(max_by(fails, island) AS BIGINT) AS cur_streak
  FROM runs GROUP BY endpoint),
facts AS (
  SELECT endpoint, min(ts) AS first_ts, max(ts) AS last_ts, max(ts) FILTER (ok) AS last_ok_ts,
    CAST(count(*) FILTER (ok) AS BIGINT) AS n_ok, bool_or(NOT ok AND {_KIND} = 'dead') AS any_dead
  FROM log GROUP BY endpoint),
ledger AS (
  SELECT endpoint, coalesce(last_ok_ts, first_ts) AS last_ok, n_ok AS ok_streak, cur_streak AS fail_streak
  FROM facts JOIN streaks USING (endpoint)),
state0 AS (
  SELECT *, last_ts + to_days(CAST(least(cur_streak, 6) AS INT)) AS ready, any_dead OR max_streak >= 3 AS dead,
    (SELECT max(ts) FROM log) AS now
  FROM facts JOIN streaks USING (endpoint)),
states AS (
  SELECT endpoint, cur_streak AS failures,
    CASE WHEN dead THEN 'dead' WHEN cur_streak > 0 AND ready > now THEN 'cooldown' ELSE 'good' END AS state,
    CASE WHEN NOT dead AND cur_streak > 0 AND ready > now THEN epoch_us(ready) END AS ready_at_us
  FROM state0)"""

_CHANGES = f"""WITH {_HEALTH},
steps AS (
  SELECT *, count(*) FILTER (NOT ok) OVER (PARTITION BY endpoint, island ORDER BY ts, event_id) AS streak,
    bool_or(NOT ok AND {_KIND} = 'dead') OVER (PARTITION BY endpoint ORDER BY ts, event_id) AS final
  FROM islands),
told AS (
  SELECT *, final OR max(streak) OVER w >= 3 AS dead, lag(streak) OVER w AS previous, lead(ts) OVER w AS next
  FROM steps WINDOW w AS (PARTITION BY endpoint ORDER BY ts, event_id)),
instants AS (
  SELECT *, bool_or(streak > 0 OR previous IS NULL OR previous > 0) OVER (PARTITION BY endpoint, ts) AS changed,
    NOT dead AND streak > 0 AS cooling, ts + to_days(CAST(least(streak, 6) AS INT)) AS ready
  FROM told QUALIFY next IS NULL OR next > ts),
changes AS (
  SELECT endpoint, ts AS moment, CASE WHEN dead THEN 'dead' WHEN cooling THEN 'cooldown' ELSE 'good' END AS state,
    CAST(streak AS BIGINT) AS failures, CASE WHEN cooling THEN epoch_us(ready) END AS ready_at_us
  FROM instants WHERE changed
  UNION ALL SELECT endpoint, ready, 'good', streak, NULL FROM instants WHERE cooling AND (next IS NULL OR next > ready))
SELECT endpoint, epoch_us(moment) AS at_us, state, failures, ready_at_us FROM changes"""

_LINES = """lines0 AS (
  SELECT event_id AS pos, event_id % 3 AS src_idx,
    CASE WHEN event_id % 17 = 0 THEN '   '
      WHEN user_id % 4 = 0 THEN concat('http://h', user_id, ':8080')
      WHEN user_id % 4 = 1 THEN concat('  h', user_id, ':8080 ')
      WHEN user_id % 4 = 2 THEN concat('https://h', user_id, ':8080')
      ELSE concat('h', user_id, ':8080') END AS line
  FROM events),
norm AS (
  SELECT pos, src_idx, line, CASE WHEN trim(line) = '' OR starts_with(trim(line), 'http://')
    OR starts_with(trim(line), 'https://') THEN trim(line) ELSE concat('http://', trim(line)) END AS endpoint
  FROM lines0),
listed AS (SELECT endpoint, min(pos) AS pos FROM norm WHERE endpoint <> '' GROUP BY endpoint)"""

_TESTED = f"""tested AS (
  SELECT *, coalesce(sum(CASE WHEN ok THEN 1 ELSE 0 END) OVER (
    ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS passed
  FROM log QUALIFY passed < {CHECKS})"""

_POOL = f"""{_TESTED},
good AS (SELECT endpoint, min(event_id) AS pos FROM tested WHERE ok GROUP BY endpoint),
merged AS (
  SELECT endpoint, min(src) AS src, min_by(pos, src) AS pos FROM (
    SELECT endpoint, 0 AS src, pos FROM good UNION ALL SELECT endpoint, 1, pos FROM listed) GROUP BY endpoint),
pool AS (
  SELECT endpoint, row_number() OVER (ORDER BY src, pos) AS rank FROM merged QUALIFY rank <= {POOL_TARGET})"""

_LEDGER_OUT = "endpoint, epoch_us(last_ok) AS last_ok_us, ok_streak, fail_streak"
_SEED = f"TIMESTAMP '{SEEDED_AT}'"
_STATES_OUT = f"WITH {_HEALTH} SELECT endpoint, state, failures, ready_at_us FROM states"
_LEDGER_SQL = f"WITH {_HEALTH} SELECT {_LEDGER_OUT} FROM ledger"
_ACCENTS = [("für", 1, "für"), ("la Réeux", 2, "la"), ("la Réeux", 2, "réeux"), ("ñ", 3, "ñ")]
_ACCENTED_HITS = f"""terms(term, q_idx, w) AS (VALUES {", ".join(map(str, _ACCENTS))}),
tok AS (
  SELECT doc_id, md5(text) AS id, unnest(string_split_regex(lower(text), '[^\\p{{L}}\\p{{M}}\\p{{N}}]+')) AS word FROM documents),
found AS (
  SELECT q_idx, term, id, doc_id, count(*) AS tf FROM tok JOIN terms ON word = w GROUP BY ALL),
uniq AS (
  SELECT * FROM found QUALIFY row_number() OVER (PARTITION BY term, id ORDER BY tf DESC, doc_id) = 1),
hits AS (
  SELECT *, row_number() OVER (PARTITION BY term ORDER BY tf DESC, doc_id) AS pos FROM uniq
  QUALIFY pos <= {LIMIT})"""
_HARVEST_RUN = f"""WITH {_POSTS_RAW},
keyed AS (
  SELECT *, author AS query, doc_id // 200 AS page_no, coalesce(nullif(id, ''), permalink, '') AS key FROM posts_raw),
placed AS (SELECT *, row_number() OVER (PARTITION BY query, page_no ORDER BY doc_id) - 1 AS pos FROM keyed),
firsts AS (SELECT query, key, min(page_no) AS page_no FROM keyed WHERE key <> '' GROUP BY query, key),
pages AS (
  SELECT query, page_no, page_no = max(page_no) OVER (PARTITION BY query) OR (query = 'src5' AND page_no = 3) AS stops,
    (SELECT count(*) FROM firsts f WHERE f.query = p.query AND f.page_no = p.page_no) AS new_cnt
  FROM (SELECT DISTINCT query, page_no FROM keyed) p),
run AS (
  SELECT *, coalesce(sum(new_cnt) OVER w, 0) AS before, coalesce(bool_or(stops) OVER w, false) AS stopped
  FROM pages WINDOW w AS (PARTITION BY query ORDER BY page_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
owned AS (
  SELECT p.* FROM placed p JOIN run r USING (query, page_no)
  WHERE before < {HARVEST_LIMIT} AND NOT stopped AND key <> ''
  QUALIFY row_number() OVER (PARTITION BY key ORDER BY CAST(substring(query, 4) AS INT), page_no, pos) = 1)
SELECT query, page_no, CAST(pos AS INT) AS pos, {_POST_FIELDS},
  (SELECT CAST(count(*) AS BIGINT) FROM owned) AS total_posts FROM owned"""
_ENRICHED_OUT = f"WITH {_ENRICHED} SELECT doc_id, body, n_comments, has_details FROM enriched"
_FAILED = "NOT (coalesce(body, '') <> '' OR coalesce(n_comments, 0) > 0)"

ORACLE: dict[str, str] = {
    "normalize_posts": f"WITH {_POSTS_RAW} SELECT {_POST_FIELDS} FROM posts_raw",
    "dedup_posts": f"""WITH {_POSTS_RAW},
keyed AS (SELECT *, coalesce(nullif(id, ''), permalink, '') AS key FROM posts_raw)
SELECT key, doc_id FROM keyed WHERE key <> '' QUALIFY row_number() OVER (PARTITION BY key ORDER BY doc_id) = 1""",
    "dedupe_first_seen": f"WITH {_LINES} SELECT endpoint, pos FROM listed",
    "keyword_search": f"WITH {_HITS} SELECT term, id, CAST(tf AS BIGINT) AS tf, pos FROM hits",
    "search_page": f"""WITH {_HITS},
paged AS (SELECT *, (pos - 1) // {PAGE_SIZE} AS page_no FROM hits),
ends AS (SELECT term, page_no, max_by(id, pos) AS last_id, max(pos) AS page_end FROM paged GROUP BY term, page_no),
sizes AS (SELECT term, max(pos) AS n FROM hits GROUP BY term)
SELECT term, page_no, id, CASE WHEN page_end < n THEN last_id END AS next_token
FROM paged JOIN ends USING (term, page_no) JOIN sizes USING (term)""",
    "search_multi": f"WITH {_HITS} SELECT id, term AS first_term, CAST(q_idx AS INT) AS q_idx FROM owned",
    "query_stats": f"WITH {_HITS} SELECT term, total, unique_cnt FROM stats",
    "search_new_in_order": f"""WITH {_HITS}
SELECT s.term, CAST(count(o.id) AS BIGINT) AS new_cnt FROM stats s LEFT JOIN owned o USING (term) GROUP BY s.term""",
    "run_manifest": f"""WITH {_HITS}
SELECT '{RUN_AT}' AS timestamp, (SELECT CAST(count(*) AS BIGINT) FROM owned) AS total_posts,
  concat('[', string_agg(concat('{{"query":"', term, '","posts_collected":', total, ',"unique_posts":', unique_cnt, '}}'),
    ',' ORDER BY q_idx), ']') AS queries_json
FROM stats""",
    "harvest_replay": _harvest("n_rows = 0") + _REPLAY_OUT,
    "harvest_replay_tolerant": _harvest("n_rows = 0 AND coalesce(prev_rows, 1) = 0") + _REPLAY_OUT,
    "harvest_hits": _HARVEST_HITS + " SELECT q_idx, query, id, page_no, pos FROM harvested",
    "harvest_stats": _HARVEST_HITS + """,
owned AS (
  SELECT * FROM harvested QUALIFY row_number() OVER (PARTITION BY id ORDER BY q_idx, page_no, pos) = 1),
spread AS (SELECT id, count(*) AS queries FROM harvested GROUP BY id)
SELECT query, CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (queries = 1) AS BIGINT) AS unique_cnt,
  (SELECT CAST(count(*) AS BIGINT) FROM owned o WHERE o.query = h.query) AS owned
FROM harvested h JOIN spread USING (id) GROUP BY query""",
    "harvest_shared": _shared("n_rows = 0") + " SELECT q_idx, query, page_no, new_cnt, accepted FROM shared",
    "harvest_shared_tolerant": _shared("n_rows = 0 AND coalesce(prev_rows, 1) = 0")
    + " SELECT q_idx, query, page_no, new_cnt, accepted FROM shared",
    "harvest_shared_hits": _shared("n_rows = 0") + """
SELECT q_idx, query, id, page_no, pos FROM held JOIN shared USING (query, page_no)
WHERE accepted AND id NOT IN (SELECT concat('p', n_chars % 211) FROM documents WHERE doc_id % 50 = 0)
QUALIFY row_number() OVER (PARTITION BY id ORDER BY q_idx, page_no, pos) = 1""",
    "ingest_search_pages": f"""WITH {_POSTS_RAW}
SELECT doc_id // 100 AS page_no, CAST(doc_id % 100 AS INT) AS pos,
  CASE WHEN (doc_id // 100) % 5 <> 4 THEN concat('t3_', doc_id // 100) END AS after, {_POST_FIELDS}
FROM posts_raw""",
    "search_page_headers": """SELECT DISTINCT doc_id // 100 AS page_no,
  CASE WHEN (doc_id // 100) % 5 <> 4 THEN concat('t3_', doc_id // 100) END AS after_token FROM documents""",
    "flatten_comments": f"WITH {_COMMENTS} SELECT doc_id, path, depth, author, body, score FROM comments",
    "nest_comments": f"""WITH {_COMMENTS},
clause_json AS (
  SELECT doc_id, i, j, string_agg(concat('{{"author":"","body":', CAST(to_json(c) AS VARCHAR),
    ',"score":null,"replies":[]}}'), ',' ORDER BY k) AS r FROM clauses WHERE k % 3 <> 2 GROUP BY doc_id, i, j),
sentence_json AS (
  SELECT doc_id, i, string_agg(concat('{{"author":', CAST(to_json(lang) AS VARCHAR), ',"body":',
    CAST(to_json(s) AS VARCHAR), ',"score":', j, ',"replies":[', coalesce(r, ''), ']}}'), ',' ORDER BY j) AS r
  FROM sentences LEFT JOIN clause_json USING (doc_id, i, j) GROUP BY doc_id, i),
line_json AS (
  SELECT doc_id, string_agg(concat('{{"author":', CAST(to_json(source) AS VARCHAR), ',"body":',
    CAST(to_json(l) AS VARCHAR), ',"score":', CASE WHEN i % 3 <> 1 THEN CAST(length(l) AS VARCHAR) ELSE 'null' END,
    ',"replies":[', coalesce(r, ''), ']}}'), ',' ORDER BY i) AS r
  FROM kept_lines LEFT JOIN sentence_json USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, concat('/r/', lang, '/comments/', doc_id, '/') AS permalink, concat('[', coalesce(r, ''), ']') AS comments_json
FROM valid LEFT JOIN line_json USING (doc_id)""",
    "comment_stats": f"""WITH {_COMMENTS}
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_comments, CAST(max(depth) AS BIGINT) AS max_depth
FROM comments GROUP BY doc_id""",
    "detail_worklist": f"""WITH {_ENRICHED}
SELECT p.doc_id, concat('https://www.reddit.com', p.permalink, '.json') AS detail_url
FROM posts_raw p JOIN enriched e USING (doc_id) WHERE p.permalink <> '' AND NOT e.has_details""",
    "enrich_posts": _ENRICHED_OUT,
    "detail_worklist_enriched": f"""WITH {_ENRICHED}
SELECT p.doc_id, concat('https://www.reddit.com', p.permalink, '.json') AS detail_url
FROM posts_raw p JOIN enriched e USING (doc_id) WHERE p.permalink <> '' AND NOT e.has_details""",
    "enriched_document_head": f"""WITH {_ENRICHED}
SELECT CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (NOT ({_FAILED})) AS BIGINT) AS success,
  CAST(count(*) FILTER ({_FAILED}) AS BIGINT) AS failed, CAST(count(*) AS BIGINT) AS n_posts FROM enriched""",
    "rejected_details": """WITH captured AS (SELECT * FROM documents WHERE doc_id % 10 <> 3)
SELECT doc_id, 2 AS fetched_at, CASE WHEN doc_id % 9 = 4 THEN 'listings' ELSE 'json' END AS reason
FROM captured WHERE doc_id % 9 IN (4, 7)
UNION ALL SELECT doc_id, 3, 'listings' FROM captured WHERE doc_id % 5 = 0""",
    "harvest_run": _HARVEST_RUN,
    "harvest_run_recaptured": _HARVEST_RUN,
    "rejected_pages": """WITH pages AS (SELECT DISTINCT source AS query, doc_id // 200 AS page_no FROM documents)
SELECT query, page_no, 3 AS fetched_at, 'json' AS reason FROM pages WHERE page_no % 4 = 2
UNION ALL SELECT query, page_no, 4, 'listing' FROM pages WHERE page_no % 6 = 5""",
    "keyword_search_accents": f"WITH {_ACCENTED_HITS} SELECT term, id, CAST(tf AS BIGINT) AS tf, pos FROM hits",
    "search_page_from_tokens": f"""WITH {_HITS},
rest AS (SELECT *, CASE WHEN q_idx <= 2 THEN pos - {PAGE_SIZE} ELSE pos END AS rel FROM hits
  WHERE q_idx > 2 OR pos > {PAGE_SIZE} OR (SELECT count(*) FROM hits h WHERE h.q_idx = hits.q_idx) < {PAGE_SIZE}),
paged AS (SELECT *, (rel - 1) // {PAGE_SIZE} AS page_no FROM rest),
ends AS (SELECT term, page_no, max_by(id, rel) AS last_id, max(rel) AS page_end FROM paged GROUP BY term, page_no),
sizes AS (SELECT term, max(rel) AS n FROM rest GROUP BY term)
SELECT term, page_no, id, CASE WHEN page_end < n THEN last_id END AS next_token
FROM paged JOIN ends USING (term, page_no) JOIN sizes USING (term)""",
    "stream_late_ledger": f"""WITH {_HEALTH}
SELECT endpoint, epoch_us(last_ok) AS last_ok_us, ok_streak, any_dead AS dead FROM ledger JOIN facts USING (endpoint)""",
    "enrichment_summary": f"""WITH {_ENRICHED}
SELECT CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (NOT ({_FAILED})) AS BIGINT) AS success,
  CAST(count(*) FILTER ({_FAILED}) AS BIGINT) AS failed FROM enriched""",
    "enrichment_failures": f"""WITH {_ENRICHED}
SELECT doc_id, coalesce(id, 'unknown') AS failed_id FROM enriched WHERE {_FAILED}""",
    "load_endpoints": f"WITH {_LINES} SELECT endpoint, pos FROM listed",
    "normalize_endpoint": f"WITH {_LINES} SELECT pos, line AS raw, endpoint FROM norm",
    "merge_sources": f"""WITH {_LINES}
SELECT endpoint, src_idx, pos FROM norm WHERE endpoint <> ''
QUALIFY row_number() OVER (PARTITION BY endpoint ORDER BY src_idx, pos) = 1""",
    "load_sources": f"""WITH {_LINES}
SELECT endpoint, min(src_idx) AS src_idx, true AS ok FROM norm WHERE endpoint <> '' AND src_idx <> 1 GROUP BY endpoint""",
    "classify_failure": f"""WITH log AS (
  SELECT CAST(400 + 100 * (event_id % 2) + CAST(json_extract_string(props, '$.k') AS INT) AS INT) AS status FROM events)
SELECT status, {_KIND} AS failure_type, CAST(count(*) AS BIGINT) AS n FROM log GROUP BY status""",
    "split_ok_failed": f"""WITH {_LOG}
SELECT endpoint, CAST(count(*) FILTER (ok) AS BIGINT) AS n_ok, CAST(count(*) FILTER (NOT ok) AS BIGINT) AS n_failed
FROM log GROUP BY endpoint""",
    "first_n_passing": f"WITH {_LOG}, {_TESTED} SELECT event_id, ok FROM tested",
    "failure_streaks": f"WITH {_HEALTH} SELECT endpoint, max_streak, cur_streak FROM streaks",
    "health_ledger": _LEDGER_SQL,
    "pool_state": _STATES_OUT,
    "state_changes": _CHANGES,
    "states_replayed": _STATES_OUT,
    "stream_state_changes": f"{_CHANGES} WHERE moment <= (SELECT max(ts) FROM log)",
    "pool_stats": f"""WITH {_HEALTH}
SELECT CAST(count(*) FILTER (state = 'good') AS BIGINT) AS good,
  CAST(count(*) FILTER (state = 'cooldown') AS BIGINT) AS cooldown,
  CAST(count(*) FILTER (state = 'dead') AS BIGINT) AS dead FROM states""",
    "refresh_pool": f"WITH {_LOG}, {_LINES}, {_POOL} SELECT endpoint, rank FROM pool",
    "upsert_ledger": f"""WITH {_HEALTH}, {_LINES}
SELECT {_LEDGER_OUT} FROM ledger UNION ALL
SELECT endpoint, epoch_us({_SEED}), CAST(0 AS BIGINT), CAST(0 AS BIGINT) FROM listed
WHERE endpoint NOT IN (SELECT endpoint FROM ledger)""",
    "refresh_ledger": f"""WITH {_HEALTH}, {_LINES}, {_POOL}
SELECT p.endpoint,
  epoch_us(CASE WHEN g.endpoint IS NOT NULL THEN {_SEED} ELSE coalesce(l.last_ok, {_SEED}) END) AS last_ok_us,
  coalesce(l.ok_streak, 0) + CASE WHEN g.endpoint IS NOT NULL THEN 1 ELSE 0 END AS ok_streak,
  CASE WHEN g.endpoint IS NOT NULL THEN 0 ELSE coalesce(l.fail_streak, 0) END AS fail_streak
FROM pool p LEFT JOIN good g USING (endpoint) LEFT JOIN ledger l USING (endpoint)""",
    "append_if_absent": f"WITH {_LINES} SELECT endpoint FROM listed",
    "read_posts_roundtrip": f"WITH {_POSTS_RAW} SELECT {_POST_FIELDS}, false AS has_details FROM posts_raw",
    **dict.fromkeys(("write_enriched_roundtrip", "large_document_roundtrip"), f"""WITH {_ENRICHED},
tops AS (SELECT doc_id, CAST(count(*) AS BIGINT) AS n FROM kept_lines GROUP BY doc_id)
SELECT name, body, CASE WHEN has_details THEN coalesce(n, 0) END AS top_comments, has_details
FROM enriched LEFT JOIN tops USING (doc_id)"""),
    "write_run_roundtrip": f"""WITH {_HITS}
SELECT 'run-1' AS run_id, term AS first_term, id, doc_id, CAST(tf AS BIGINT) AS tf, pos,
  (SELECT CAST(count(*) AS BIGINT) FROM owned) AS total_posts FROM owned""",
    "ledger_roundtrip": f"""WITH {_HEALTH}
SELECT endpoint, epoch_us(last_ok) // 1000000 AS last_ok, ok_streak, fail_streak FROM ledger""",
    "stream_dedup_posts": f"""WITH {_POSTS_RAW}
SELECT DISTINCT coalesce(nullif(id, ''), permalink, '') AS key FROM posts_raw
WHERE coalesce(nullif(id, ''), permalink, '') <> ''""",
    "stream_health_ledger": _LEDGER_SQL,
    "stream_pool_state": _STATES_OUT,
    "stream_kept_ledger": _LEDGER_SQL,
    "stream_kept_states": _STATES_OUT,
    **dict.fromkeys(("stream_enrich", "stream_enrich_late"), f"""WITH {_ENRICHED},
keyed AS (SELECT doc_id, coalesce(nullif(id, ''), permalink, '') AS key FROM posts_raw),
kept AS (
  SELECT doc_id FROM keyed WHERE key = '' UNION ALL
  SELECT doc_id FROM keyed WHERE key <> '' QUALIFY row_number() OVER (PARTITION BY key ORDER BY doc_id) = 1)
SELECT doc_id, body, n_comments, has_details FROM enriched JOIN kept USING (doc_id)"""),
}
