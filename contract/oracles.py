"""DuckDB statements of the same results, written from the definitions, not from the plans."""

from __future__ import annotations

from .queries import COMMENT_MIN, COMMENT_ROWS, COMMUNITY, POST_MIN, POST_ROWS, PRIORITY
from .roles import COMMENT_MONTH, COMMENT_POS

POS = ", ".join(COMMENT_POS)
SLIM = "id, created_utc, subreddit, score, is_removed"
BLOCK = (
    "subreddit, total_pos_upvotes, total_items, last_created_utc, last_id, rate, num_pos_upvotes_removed, "
    "num_items_with_pos_upvotes_removed, score_of_max_pos_removed_item, id_of_max_pos_removed_item"
)


def b36(x: str) -> str:
    return f"lower(to_base({x}, 36))"


def from_b36(x: str) -> str:
    digits = "0123456789abcdefghijklmnopqrstuvwxyz"
    values = f"list_transform(string_split({x}, ''), lambda c: CAST(instr('{digits}', c) - 1 AS BIGINT))"
    return f"list_reduce({values}, lambda a, b: a * 36 + b)"


def clean(x: str) -> str:
    """The test tables hold these entities and only blanks and line feeds as white space."""
    plain = f"replace(replace(replace({x}, '&copy;', '©'), '&middot;', '·'), '&quot;', '\"')"
    plain = f"regexp_replace({plain}, '&amp;?', '&', 'g')"
    return f"substr(trim(regexp_replace({plain}, '\\s+', ' ', 'g')), 1, 300)"


COMMENTS = f"""
comment_src AS (
  SELECT {b36('l_orderkey * 8 + l_linenumber')} AS id, l_orderkey * 8 + l_linenumber AS id_int,
         CAST(epoch(l_shipdate) AS BIGINT) AS created_utc, 'Sub_' || l_suppkey AS subreddit,
         CASE WHEN l_tax <> 0.08 THEN CAST(l_quantity AS BIGINT) - 10 END AS raw_score,
         l_returnflag = 'R' AND l_partkey % 11 = 0 AS is_removed,
         CASE WHEN l_linenumber = 7 AND l_discount = 0.1 THEN 'advert'
              WHEN l_linenumber = 7 AND l_discount = 0.09 THEN 'no score' ELSE 'item' END AS kind,
         {b36('l_orderkey')} AS link_id, l_orderkey, l_linenumber, l_partkey,
         row_number() OVER (ORDER BY {POS}) AS pos
  FROM lineitem
),
comment_items AS (
  SELECT 'comments' AS type, '{COMMENT_MONTH}' AS month, id, id_int, created_utc, subreddit,
         coalesce(raw_score, 1) AS score, is_removed, pos
  FROM comment_src WHERE kind = 'item'
),
unique_comments AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY pos DESC) AS copy FROM comment_items) WHERE copy = 1
)"""

POSTS = f"""
post_src AS (
  SELECT 'posts' AS type, strftime(o_orderdate, '%Y-%m') AS month, {b36('o_orderkey')} AS id, o_orderkey AS id_int,
         CAST(epoch(o_orderdate) AS BIGINT) AS created_utc, o_orderpriority AS subreddit,
         CAST(floor(o_totalprice / 1000) AS BIGINT) - 50 AS score,
         o_orderstatus = 'F' AND o_orderkey % 7 = 0 AS hidden, o_orderkey % 13 = 0 AS author_deleted,
         o_orderkey % 997 = 5 AS no_flag, o_custkey, o_orderkey AS pos
  FROM orders
),
post_items AS (
  SELECT type, month, id, id_int, created_utc, subreddit, score, hidden AND NOT author_deleted AS is_removed, pos FROM post_src
),
unique_posts AS (SELECT * FROM post_items)"""


def blocks(kind: str, n: int, dropna: bool = True) -> str:
    """Block table of the unique items of a kind as ``<kind>_blocks``."""
    counted = "is_removed AND score > 1"
    keep = f"HAVING count(*) FILTER ({counted}) > 0" if dropna else ""
    removed = f"coalesce(sum(score) FILTER ({counted}), 0)"
    return f"""
{kind}_numbered AS (
  SELECT *, row_number() OVER (PARTITION BY month, subreddit ORDER BY created_utc, id_int) - 1 AS position FROM unique_{kind}s
),
{kind}_blocks AS (
  SELECT type, month, subreddit,
         CAST(sum(CASE WHEN score > 0 THEN score ELSE 0 END) AS BIGINT) AS total_pos_upvotes,
         count(score) AS total_items, max(created_utc) AS last_created_utc,
         last(id ORDER BY position) AS last_id,
         CASE WHEN {removed} > 0 THEN CAST({removed} AS DOUBLE) / sum(CASE WHEN score > 0 THEN score ELSE 0 END) ELSE 0.0 END AS rate,
         CAST({removed} AS BIGINT) AS num_pos_upvotes_removed,
         count(*) FILTER ({counted}) AS num_items_with_pos_upvotes_removed,
         coalesce(max(score) FILTER ({counted}), 0) AS score_of_max_pos_removed_item,
         coalesce(first(id ORDER BY score DESC, position) FILTER ({counted}), '') AS id_of_max_pos_removed_item,
         last(id_int ORDER BY position) AS last_int
  FROM {kind}_numbered GROUP BY type, month, subreddit, position // {n} {keep}
)"""


def merged(kind: str, minimum: int, n: int) -> str:
    """Merged block table as ``<kind>_merged``: a short block joins the full one before it."""
    return f"""
{kind}_ordered AS (
  SELECT *, row_number() OVER (PARTITION BY subreddit ORDER BY last_created_utc, month, last_int) AS place FROM {kind}_blocks
),
{kind}_pairs AS (
  SELECT f.subreddit, f.place, s.place AS short_place, f.last_created_utc < s.last_created_utc AS in_order
  FROM {kind}_ordered f JOIN {kind}_ordered s ON f.subreddit = s.subreddit AND s.place = f.place + 1
  WHERE f.total_items = {n} AND s.total_items < {minimum}
),
{kind}_roles AS (
  SELECT subreddit, CASE WHEN in_order THEN place ELSE short_place END AS x_place,
         CASE WHEN in_order THEN short_place ELSE place END AS y_place
  FROM {kind}_pairs
),
{kind}_merged AS (
  SELECT x.type, lower(x.subreddit) AS subreddit, x.total_pos_upvotes + y.total_pos_upvotes AS total_pos_upvotes,
         x.total_items + y.total_items AS total_items, y.last_created_utc, y.last_id,
         CAST(x.num_pos_upvotes_removed + y.num_pos_upvotes_removed AS DOUBLE) / (x.total_pos_upvotes + y.total_pos_upvotes) AS rate,
         x.num_pos_upvotes_removed + y.num_pos_upvotes_removed AS num_pos_upvotes_removed,
         x.num_items_with_pos_upvotes_removed + y.num_items_with_pos_upvotes_removed AS num_items_with_pos_upvotes_removed,
         CASE WHEN x.score_of_max_pos_removed_item > y.score_of_max_pos_removed_item
              THEN x.score_of_max_pos_removed_item ELSE y.score_of_max_pos_removed_item END AS score_of_max_pos_removed_item,
         CASE WHEN x.score_of_max_pos_removed_item > y.score_of_max_pos_removed_item
              THEN x.id_of_max_pos_removed_item ELSE y.id_of_max_pos_removed_item END AS id_of_max_pos_removed_item
  FROM {kind}_roles r
  JOIN {kind}_ordered x ON x.subreddit = r.subreddit AND x.place = r.x_place
  JOIN {kind}_ordered y ON y.subreddit = r.subreddit AND y.place = r.y_place
  UNION ALL
  SELECT type, lower(subreddit), total_pos_upvotes, total_items, last_created_utc, last_id, rate, num_pos_upvotes_removed,
         num_items_with_pos_upvotes_removed, score_of_max_pos_removed_item, id_of_max_pos_removed_item
  FROM {kind}_ordered o
  WHERE NOT EXISTS (SELECT 1 FROM {kind}_pairs p WHERE p.subreddit = o.subreddit AND o.place IN (p.place, p.short_place))
)"""


COMMENT_BLOCKS = ",".join([COMMENTS, blocks("comment", COMMENT_ROWS)])
POST_BLOCKS = ",".join([POSTS, blocks("post", POST_ROWS)])
COMMENT_MERGED = ",".join([COMMENT_BLOCKS, merged("comment", COMMENT_MIN, COMMENT_ROWS)])
POST_MERGED = ",".join([POST_BLOCKS, merged("post", POST_MIN, POST_ROWS)])

VERSIONS = f"""
versions AS (
  SELECT id, created_utc, link_id, pos,
         {clean(r"CASE WHEN is_removed AND l_linenumber % 2 = 1 THEN '\[removed\]' WHEN is_removed THEN '[removed]' ELSE coalesce(text, 'part ' || l_partkey) END")} AS body
  FROM comment_src LEFT JOIN documents ON l_orderkey = doc_id
  WHERE kind = 'item'
),
resolved AS (
  SELECT id, body, created_utc, link_id FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY gone, CASE WHEN gone THEN -pos ELSE pos END) AS choice
    FROM (SELECT *, replace(body, '\\', '') = '[removed]' AS gone FROM versions)
  ) WHERE choice = 1
)"""

STORED = """
stored AS (
  SELECT id, id_int,
         CASE id_int % 3 WHEN 0 THEN '[removed]' WHEN 1 THEN 'stored ' || id ELSE '' END AS body,
         CASE WHEN id_int % 5 <> 0 THEN created_utc + (id_int % 2) * 700000000 END AS created_utc,
         link_id, coalesce(raw_score, 1) AS score
  FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY pos DESC) AS copy FROM comment_src WHERE kind = 'item' AND is_removed)
  WHERE copy = 1
),
stored_flagged AS (
  SELECT *, coalesce(created_utc, 12345678901) < 1609257600 OR body <> '[removed]' AS archived FROM stored
),
inaccessible AS (SELECT id FROM unique_comments WHERE id_int % 17 = 0)"""

ENRICHED = f"""
comments_table AS (
  SELECT r.id, r.body, r.created_utc, r.link_id, m.score_of_max_pos_removed_item AS score
  FROM resolved r JOIN comment_merged m ON r.id = m.id_of_max_pos_removed_item
),
post_ids AS (
  SELECT id_of_max_pos_removed_item AS id FROM post_merged UNION SELECT link_id FROM comments_table
),
posts_table AS (
  SELECT p.id, p.created_utc, p.o_custkey % 50 AS num_comments,
         {clean("coalesce(regexp_extract(html, '<title>(.*?)</title>', 1), 'order  by ' || o_custkey)")} AS title,
         m.score_of_max_pos_removed_item AS score
  FROM post_src p JOIN post_ids i ON p.id = i.id
  LEFT JOIN pages ON page_id = o_custkey
  LEFT JOIN post_merged m ON m.id_of_max_pos_removed_item = p.id
)"""

ALL = ",".join([COMMENT_MERGED, POST_MERGED, VERSIONS, ENRICHED])

FILES = """
post_files AS (
  SELECT 'RS_' || strftime(o_orderdate, '%Y-%m') || '.zst' AS name, CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) AS BIGINT) AS size,
         month(min(o_orderdate)) AS m
  FROM orders GROUP BY strftime(o_orderdate, '%Y-%m')
),
days AS (
  SELECT strftime(l_shipdate, '%Y-%m-%d') AS day, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS size, month(min(l_shipdate)) AS m
  FROM lineitem GROUP BY strftime(l_shipdate, '%Y-%m-%d')
),
months AS (SELECT substr(day, 1, 7) AS month, m, CAST(sum(size) AS BIGINT) AS size FROM days GROUP BY 1, 2),
manifest AS (
  SELECT name, size FROM post_files
  UNION ALL SELECT 'RC_' || day || '.zst', size FROM days
  UNION ALL SELECT 'RC_' || month || '.zst', size + 7 FROM months WHERE m % 2 = 1
),
local_files AS (
  SELECT name, size + CASE WHEN m % 5 = 0 THEN 1 ELSE 0 END AS size FROM post_files WHERE m <> 11
  UNION ALL SELECT 'RC_' || month || '.zst', size + CASE WHEN m = 7 THEN 1 ELSE 0 END FROM months WHERE m % 2 = 1
  UNION ALL SELECT 'RC_' || day || '.zst', size + CASE WHEN m = 4 AND day LIKE '%-13' THEN 1 ELSE 0 END FROM days WHERE m % 2 = 0
),
parsed AS (
  SELECT *, replace(name, '.zst', '') AS base, CASE WHEN name LIKE 'RS%' THEN 'posts' ELSE 'comments' END AS type,
         substr(name, 4, 7) AS month, length(name) > 14 AS is_daily
  FROM local_files
),
parts AS (
  SELECT base, CAST(sum(size) AS BIGINT) AS parts_size FROM (
    SELECT substr(name, 1, 7) AS base, size FROM manifest UNION ALL
    SELECT substr(name, 1, 10), size FROM manifest WHERE length(name) > 14
  ) GROUP BY base
),
judged AS (
  SELECT p.*, l.size AS listed_size, q.parts_size,
         CASE WHEN is_daily THEN 'daily' WHEN type = 'posts' AND month LIKE '%-03' THEN 'skipped'
              WHEN l.size IS NOT NULL AND l.size <> p.size AND coalesce(q.parts_size, 0) <> p.size THEN 'size_mismatch'
              ELSE 'ready' END AS status
  FROM parsed p LEFT JOIN manifest l ON l.name = p.name LEFT JOIN parts q ON q.base = p.base
),
daily_months AS (
  SELECT type, month, count(*) AS num_days, bool_and(coalesce(listed_size = size, false)) AS complete
  FROM judged j WHERE is_daily
    AND NOT EXISTS (SELECT 1 FROM judged k WHERE NOT k.is_daily AND k.type = j.type AND k.month = j.month)
  GROUP BY type, month
)"""


def _top_comments(by: str, limit: int | None, more: str = "") -> str:
    key = {"rate": "rate", "date": "last_created_utc"}[by]
    limited = f"LIMIT {limit}" if limit is not None else ""
    return f"""WITH {ALL}
SELECT trim(m.subreddit) AS subreddit, m.rate, m.last_created_utc, trim(m.id_of_max_pos_removed_item) AS id_of_max_pos_removed_item,
       trim(m.last_id) AS last_id, m.total_items, trim(c.body) AS body, c.created_utc, trim(c.link_id) AS link_id,
       trim(p.title) AS title, m.score_of_max_pos_removed_item AS score,
       row_number() OVER (ORDER BY m.{key} DESC, m.last_id DESC) AS place
FROM comment_merged m LEFT JOIN comments_table c ON m.id_of_max_pos_removed_item = c.id LEFT JOIN posts_table p ON c.link_id = p.id
WHERE m.last_id IN (
  SELECT last_id FROM comment_merged WHERE subreddit = '{COMMUNITY}' {more} ORDER BY {key} DESC, last_id DESC {limited}
)
ORDER BY m.{key} DESC, m.last_id DESC"""


def _top_posts(by: str, limit: int | None, more: str = "") -> str:
    key = {"rate": "rate", "date": "last_created_utc"}[by]
    limited = f"LIMIT {limit}" if limit is not None else ""
    return f"""WITH {ALL}
SELECT trim(m.subreddit) AS subreddit, m.rate, m.last_created_utc, trim(m.id_of_max_pos_removed_item) AS id_of_max_pos_removed_item,
       trim(m.last_id) AS last_id, m.total_items, trim(p.title) AS title, p.num_comments, p.created_utc,
       m.score_of_max_pos_removed_item AS score, row_number() OVER (ORDER BY m.{key} DESC, m.last_id DESC) AS place
FROM post_merged m LEFT JOIN posts_table p ON m.id_of_max_pos_removed_item = p.id
WHERE m.last_id IN (
  SELECT last_id FROM post_merged WHERE subreddit = '{PRIORITY}' {more} ORDER BY {key} DESC, last_id DESC {limited}
)
ORDER BY m.{key} DESC, m.last_id DESC"""


_SLIM_COMMENTS = f"WITH {COMMENTS} SELECT {SLIM} FROM comment_items"
_NUMBERED = f"WITH {COMMENT_BLOCKS} SELECT id, subreddit, position, position // {COMMENT_ROWS} AS block FROM comment_numbered"
_MERGED_POSTS = f"WITH {POST_MERGED} SELECT type, {BLOCK} FROM post_merged"
_SHARES = (
    "shares AS (SELECT type, month, count(*) FILTER (is_removed) AS removed, count(*) AS total, "
    "count(*) FILTER (is_removed) / count(*) AS share FROM post_items GROUP BY type, month)"
)
_MIXED_PARENTS = "SELECT id_of_max_pos_removed_item AS id FROM post_merged UNION SELECT link_id FROM stored"
_NOT_FOUND = f"SELECT id FROM ({_MIXED_PARENTS}) WHERE id NOT IN (SELECT id FROM post_src WHERE score > 100)"

_COMMENT_RULES = [
    ("id", "not null", "id IS NULL"),
    ("created_utc", "not null", "created_utc IS NULL"),
    ("link_id", "not null", "link_id IS NULL"),
    ("id", "length <= 15", "length(id) > 15"),
    ("body", "length <= 300", "length(body) > 300"),
    ("link_id", "length <= 15", "length(link_id) > 15"),
]

_null = lambda *names: [(c, "not null", f"{c} IS NULL") for c in names]
_long = lambda **limits: [(c, f"length <= {n}", f"length({c}) > {n}") for c, n in limits.items()]
_BLOCK_RULES = _null(*BLOCK.split(", ")) + _long(subreddit=30, last_id=15, id_of_max_pos_removed_item=15)
_RULES = [
    ("comments", "unclean", _COMMENT_RULES),
    ("posts", "posts_table", _null("id", "created_utc", "num_comments") + _long(id=15, title=300)),
    ("aggregate_comments", "comment_merged", _BLOCK_RULES),
    ("aggregate_posts", "post_merged", _BLOCK_RULES),
]

ORACLES: dict[str, str] = {
    "base36_roundtrip": f"""
SELECT o_orderkey,
       CASE WHEN o_orderkey * 7919 < 1000 THEN '-' || {b36('abs(o_orderkey * 7919 - 1000)')} ELSE {b36('abs(o_orderkey * 7919 - 1000)')} END AS id,
       {from_b36(b36('o_orderkey'))} AS back
FROM orders""",
    "clean_text_documents": f"SELECT doc_id, {clean('text')} AS body FROM documents",
    "clean_text_pages": f"SELECT page_id, {clean('html')} AS title FROM pages",
    "link_id_normalise": f"""
SELECT CASE WHEN l_linenumber % 2 = 0 THEN 't3_' || {b36('l_orderkey')} ELSE CAST(l_orderkey AS VARCHAR) END AS raw,
       {b36('l_orderkey')} AS link_id, {b36('l_orderkey')} AS bare
FROM lineitem""",
    "file_name_parts": f"""WITH {FILES}
SELECT name, base, '.zst' AS ext, type, substr(base, 4) AS period, month, is_daily FROM parsed""",
    "period_series_months": """
SELECT strftime(d, '%Y-%m') AS period FROM (
  SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)) AS d FROM orders)""",
    "period_series_days": """
SELECT strftime(d, '%Y-%m-%d') AS period FROM (
  SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d FROM orders)""",
    "slim_comments": _SLIM_COMMENTS,
    "slim_posts": f"WITH {POSTS} SELECT month, {SLIM} FROM post_items",
    "slim_float_numbers": f"WITH {POSTS} SELECT month, {SLIM} FROM post_items",
    "outcome_report": f"""WITH {COMMENTS},{POSTS}
SELECT type, outcome, reason, count(*) AS lines FROM (
  SELECT 'comments' AS type, CASE kind WHEN 'item' THEN 'keep' WHEN 'advert' THEN 'ignore' ELSE 'quarantine' END AS outcome,
         CASE kind WHEN 'advert' THEN 'ignorable' WHEN 'no score' THEN 'no score' END AS reason FROM comment_src
  UNION ALL
  SELECT 'posts', CASE WHEN no_flag AND NOT author_deleted THEN 'reject_file' ELSE 'keep' END,
         CASE WHEN no_flag AND NOT author_deleted THEN 'no removal flag' END FROM post_src
) GROUP BY type, outcome, reason""",
    "quarantine_lines": f"""WITH {COMMENTS}
SELECT 'RC_{COMMENT_MONTH}.zst' AS file, kind AS reason, id FROM comment_src WHERE kind = 'no score'""",
    "rejected_dump_files": f"""WITH {POSTS}
SELECT DISTINCT 'RS_' || month || '.zst' AS file FROM post_src WHERE no_flag AND NOT author_deleted""",
    "slim_posts_of_usable_files": f"""WITH {POSTS}
SELECT month, {SLIM} FROM post_items WHERE month NOT IN (SELECT month FROM post_src WHERE no_flag AND NOT author_deleted)""",
    "encoding_fallback": "SELECT doc_id, text FROM documents",
    "encoding_fallback_whole_file": "SELECT doc_id, text FROM documents",
    "line_cap": """
SELECT file, o_orderkey FROM (
  SELECT strftime(o_orderdate, '%Y-%m') AS file, o_orderkey,
         row_number() OVER (PARTITION BY strftime(o_orderdate, '%Y-%m') ORDER BY o_orderkey) AS n FROM orders) WHERE n <= 40""",
    "scan_gz": _SLIM_COMMENTS,
    "scan_bz2": _SLIM_COMMENTS,
    "broken_dump_files": f"""WITH {POSTS}, months AS (
  SELECT month, count(*) AS items, CAST(substr(month, 6) AS INT) % 3 = 0 OR CAST(substr(month, 6) AS INT) % 5 = 0 AS broken FROM post_items GROUP BY month)
SELECT 'RS_' || month AS base, CASE WHEN broken THEN 'broken' ELSE 'ready' END AS status,
  CASE WHEN broken THEN 0 ELSE items END AS items, CASE WHEN broken THEN 1 ELSE 0 END AS logged FROM months""",
    "scan_frames": f"WITH {POSTS} SELECT month, {SLIM} FROM post_items",
    "stopped_and_resumed": f"WITH {POST_BLOCKS} SELECT type, month, {BLOCK} FROM post_blocks",
    "merge_incremental": _MERGED_POSTS,
    "merge_replaced_month": _MERGED_POSTS,
    "scan_zst": _SLIM_COMMENTS,
    "scan_xz": _SLIM_COMMENTS,
    "slim_csv_roundtrip": f"WITH {POSTS} SELECT type, month, {SLIM} FROM post_items",
    "dedup_keep_last": f"WITH {COMMENTS} SELECT {SLIM} FROM unique_comments",
    "dedup_two_files_of_month": f"""WITH {COMMENTS},
both_files AS (
  SELECT 1 AS file, * FROM comment_items UNION ALL SELECT 2, * REPLACE (score + 100 AS score) FROM comment_items WHERE score > 5
)
SELECT {SLIM} FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY file DESC, pos DESC) AS copy FROM both_files) WHERE copy = 1""",
    "block_number": _NUMBERED,
    "block_number_large_groups": _NUMBERED,
    "block_aggregate": f"WITH {COMMENT_BLOCKS} SELECT type, month, {BLOCK} FROM comment_blocks",
    "block_aggregate_posts": f"WITH {POST_BLOCKS} SELECT type, month, {BLOCK} FROM post_blocks",
    "block_aggregate_keep_all": f"WITH {COMMENTS},{blocks('comment', COMMENT_ROWS, dropna=False)} SELECT type, month, {BLOCK} FROM comment_blocks",
    "positive_scores": f"""WITH {COMMENTS}
SELECT subreddit, CAST(sum(greatest(score, 0)) AS BIGINT) AS sum_pos, count(*) FILTER (score > 0) AS count_pos FROM comment_items GROUP BY subreddit""",
    "merge_short_tail": _MERGED_POSTS,
    "merge_short_tail_large_groups": _MERGED_POSTS,
    "merge_short_tail_comments": f"WITH {COMMENT_MERGED} SELECT type, {BLOCK} FROM comment_merged",
    "removal_share_by_month": f"WITH {POSTS},{_SHARES} SELECT * FROM shares",
    "removal_share_compat": f"""WITH {POSTS},{_SHARES}
SELECT type, month, removed, total + 1 AS total, floor(removed * 1000000 / (total + 1)) / 1000000 AS share FROM shares""",
    "usable_months": f"WITH {POSTS},{_SHARES} SELECT *, share BETWEEN 0.03 AND 0.09 AS usable FROM shares",
    "unusable_month_skip_list": f"WITH {POSTS},{_SHARES} SELECT 'RS_' || month AS basename FROM shares WHERE share NOT BETWEEN 0.03 AND 0.09",
    "manifest_check": f"WITH {FILES} SELECT name, size, listed_size, parts_size, status FROM judged",
    "daily_size_rollup": f"WITH {FILES} SELECT base, parts_size FROM parts",
    "daily_months": f"WITH {FILES} SELECT type, month, num_days, complete FROM daily_months",
    "daily_months_incomplete": f"""WITH {FILES},
held AS (SELECT * FROM judged WHERE NOT (is_daily AND name LIKE '%-09.zst' AND CAST(substr(month, 6, 2) AS INT) % 4 = 0)),
listed_days AS (SELECT substr(name, 4, 7) AS month, count(*) AS days FROM manifest WHERE length(name) > 14 GROUP BY 1)
SELECT type, month, count(*) AS num_days, bool_and(coalesce(listed_size = size, false)) AND count(*) = coalesce(max(days), 0) AS complete
FROM held h LEFT JOIN listed_days USING (month)
WHERE is_daily AND NOT EXISTS (SELECT 1 FROM judged k WHERE NOT k.is_daily AND k.type = h.type AND k.month = h.month)
GROUP BY type, month""",
    "files_with_two_skip_lists": f"""WITH {POSTS},{_SHARES},{FILES},
skipped AS (SELECT base FROM judged WHERE status = 'skipped' UNION SELECT 'RS_' || month FROM shares WHERE share NOT BETWEEN 0.03 AND 0.09)
SELECT CASE WHEN status <> 'daily' AND base IN (SELECT base FROM skipped) THEN 'skipped' ELSE status END AS status, count(*) AS files
FROM judged GROUP BY 1""",
    "files_to_read": f"""WITH {FILES}
SELECT name, type, month FROM judged j
WHERE status = 'ready' OR (is_daily AND EXISTS (SELECT 1 FROM daily_months d WHERE d.complete AND d.type = j.type AND d.month = j.month))""",
    "coverage_report": f"""WITH {FILES},
expected AS (
  SELECT 'RS_' || strftime(d, '%Y-%m') || '.zst' AS name FROM (
    SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)) AS d FROM orders)
)
SELECT e.name, l.size AS local_size, m.size AS listed_size,
       CASE WHEN m.size IS NULL THEN 'unlisted' WHEN l.size IS NULL THEN 'missing' WHEN l.size <> m.size THEN 'stale' ELSE 'present' END AS status
FROM expected e LEFT JOIN local_files l ON l.name = e.name
LEFT JOIN (SELECT * FROM manifest WHERE name NOT LIKE '%-06.zst') m ON m.name = e.name""",
    "manifest_upsert": f"""WITH {FILES}
SELECT name, size FROM post_files UNION ALL
SELECT name, size + 1 FROM manifest WHERE name NOT IN (SELECT name FROM post_files)""",
    "manifest_order": f"""WITH {FILES}
SELECT name, size, row_number() OVER (ORDER BY length(name) > 14, CASE WHEN length(name) > 14 THEN name ELSE substr(name, 4) END, name) AS place
FROM manifest""",
    "months_to_process": f"WITH {POSTS} SELECT DISTINCT type, month FROM post_items WHERE month >= '1998-01'",
    "output_is_stale": "SELECT (SELECT max(o_orderdate) FROM orders) >= (SELECT max(l_shipdate) FROM lineitem) AS stale",
    "archived_comments": f"WITH {COMMENTS},{STORED} SELECT id, archived FROM stored_flagged",
    "ids_to_lookup": f"""WITH {COMMENT_MERGED},{STORED}
SELECT DISTINCT id_of_max_pos_removed_item AS id FROM comment_merged
WHERE id_of_max_pos_removed_item NOT IN (SELECT id FROM stored_flagged WHERE archived)
  AND id_of_max_pos_removed_item NOT IN (SELECT id FROM inaccessible)""",
    "post_ids_to_lookup": f"WITH {COMMENTS},{POST_MERGED},{STORED} {_MIXED_PARENTS}",
    "post_ids_to_lookup_stored": f"""WITH {COMMENTS},{POST_MERGED},{STORED}
SELECT id FROM ({_MIXED_PARENTS}) WHERE id NOT IN (SELECT id FROM post_src WHERE id_int % 4 = 0)""",
    "enrich_posts_flawed": f"""WITH {POSTS}
SELECT p.id, p.created_utc, p.o_custkey % 50 AS num_comments,
       {clean("coalesce(regexp_extract(html, '<title>(.*?)</title>', 1), 'order  by ' || o_custkey)")} AS title
FROM post_src p LEFT JOIN pages ON page_id = o_custkey
WHERE month NOT IN (SELECT month FROM post_src WHERE no_flag AND NOT author_deleted)""",
    "ids_not_found": f"WITH {COMMENTS},{POST_MERGED},{STORED} {_NOT_FOUND}",
    "inaccessible_update": f"WITH {COMMENTS},{POST_MERGED},{STORED} SELECT id FROM inaccessible UNION {_NOT_FOUND}",
    "resolve_versions": f"WITH {COMMENTS},{VERSIONS} SELECT * FROM resolved",
    "resolve_versions_without_body": f"""WITH {COMMENTS}
SELECT id, link_id, created_utc FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY pos DESC) AS copy FROM comment_src) WHERE copy = 1""",
    "relookup_merge": f"""WITH {COMMENT_MERGED},{VERSIONS},{STORED},
found AS (
  SELECT * FROM resolved WHERE id IN (SELECT id_of_max_pos_removed_item FROM comment_merged)
    AND id NOT IN (SELECT id FROM stored_flagged WHERE archived)
)
SELECT id, coalesce(f.body, s.body) AS body, coalesce(f.created_utc, s.created_utc) AS created_utc, coalesce(f.link_id, s.link_id) AS link_id
FROM found f FULL OUTER JOIN (SELECT * FROM stored_flagged WHERE NOT archived) s USING (id)
UNION ALL SELECT id, body, created_utc, link_id FROM stored_flagged WHERE archived""",
    "attach_score": f"""WITH {COMMENT_MERGED},{STORED}
SELECT id, body, created_utc, link_id, score_of_max_pos_removed_item AS score
FROM (SELECT * EXCLUDE (score) FROM stored) LEFT JOIN comment_merged ON id = id_of_max_pos_removed_item""",
    "enrich_comments": f"WITH {ALL} SELECT * FROM comments_table",
    "enrich_posts": f"WITH {ALL} SELECT * FROM posts_table",
    "enriched_csv_roundtrip": f"WITH {ALL} SELECT * FROM comments_table",
    "id_list_roundtrip": f"WITH {COMMENTS},{STORED} SELECT id, row_number() OVER (ORDER BY id) AS place FROM inaccessible",
    "published_comment_blocks": f"WITH {COMMENT_MERGED} SELECT {BLOCK} FROM comment_merged",
    "published_post_blocks": f"WITH {POST_MERGED} SELECT {BLOCK} FROM post_merged",
    "published_blocks_keep_all": f"""WITH {COMMENTS},{blocks('comment', COMMENT_ROWS, dropna=False)},{merged('comment', COMMENT_MIN, COMMENT_ROWS)}
SELECT {BLOCK} FROM comment_merged""",
    "blocks_csv_roundtrip": f"WITH {POST_MERGED} SELECT {BLOCK}, true AS in_order FROM post_merged",
    "unique_key_report": f"WITH {COMMENTS} SELECT id, count(*) AS copies FROM comment_items GROUP BY id HAVING count(*) > 1",
    "constraint_report": f"""WITH {ALL},
unclean AS (
  SELECT id, text AS body, CASE WHEN kind = 'item' THEN created_utc END AS created_utc, link_id
  FROM comment_src LEFT JOIN documents ON l_partkey = doc_id
)
"""
    + " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", '{r}' AS \"rule\", count(*) FILTER ({broken}) AS violations FROM {source}"
        for t, source, rules in _RULES
        for c, r, broken in rules
    )
    + "".join(
        f" UNION ALL SELECT '{t}', '{k}', 'primary key', count(*) FROM (SELECT {k} FROM {source} GROUP BY {k} HAVING count(*) > 1)"
        for t, source, k in (
            ("comments", "unclean", "id"),
            ("posts", "posts_table", "id"),
            ("aggregate_comments", "comment_merged", "last_id"),
            ("aggregate_posts", "post_merged", "last_id"),
        )
    ),
    "top_comments_by_rate": _top_comments("rate", 2),
    "top_comments_by_date": _top_comments("date", 2),
    "top_comments_paged": _top_comments("date", 1, "AND last_created_utc <= 960000000 AND rate >= 0.01 AND rate <= 0.9"),
    "top_comments_unlimited": _top_comments("rate", None, "AND last_created_utc >= 880000000"),
    "top_posts_by_rate": _top_posts("rate", 10),
    "top_posts_by_date": _top_posts("date", 10),
    "top_comments_by_rate_sql": _top_comments("rate", 2),
    "top_comments_by_date_sql": _top_comments("date", 1, "AND last_created_utc <= 960000000"),
    "top_posts_by_rate_sql": _top_posts("rate", 10),
    "top_posts_by_date_sql": _top_posts("date", None, "AND rate >= 0.2"),
}
