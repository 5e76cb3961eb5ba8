"""Inputs with the faults that the cleaning and the rules are for.

The given tables hold no nulls, so each fixture damages whole tables by a rule.
The same text runs in Spark SQL (session zone UTC) and in DuckDB.
"""

from __future__ import annotations

import re
from datetime import date, datetime, timezone

AS_OF = date(2024, 1, 1)
PROCESSED_AT = datetime(2024, 1, 1, tzinfo=timezone.utc)

DIRTY_CUSTOMER = """
SELECT c_custkey AS src_key,
  CASE WHEN c_custkey % 97 = 0 THEN ' N/A '
       WHEN c_custkey % 89 = 0 THEN ''
       WHEN c_custkey % 50 = 1 THEN concat('u', CAST(c_custkey - 1 AS STRING))
       ELSE concat(' u', CAST(c_custkey AS STRING), ' ') END AS user_id,
  CASE WHEN c_custkey % 41 = 0 THEN 'NA'
       WHEN c_custkey % 43 = 0 THEN '-5'
       WHEN c_custkey % 601 = 0 THEN '20000000'
       ELSE concat(CAST(c_custkey * 7 % 1000 AS STRING), ' items') END AS products,
  CAST(CAST(floor(c_acctbal) AS BIGINT) AS STRING) AS reviews
FROM {customer}
"""

DIRTY_EVENTS = """
SELECT event_id AS src_key,
  CASE WHEN event_id % 211 = 0 THEN NULL
       WHEN event_id % 100 = 1 THEN event_id - 1 ELSE event_id END AS review_id,
  CASE WHEN event_id % 307 = 0 THEN NULL ELSE user_id END AS user_id,
  CASE WHEN event_id % 401 = 0 THEN NULL ELSE event_id % 50 END AS app_id,
  CASE event_id % 7 WHEN 0 THEN 'TRUE' WHEN 1 THEN 'no' WHEN 2 THEN '1' WHEN 3 THEN 'False'
       WHEN 4 THEN 'maybe' WHEN 5 THEN NULL ELSE 'yes' END AS is_recommended,
  CASE WHEN event_id % 61 = 0 THEN '   ' WHEN event_id % 67 = 0 THEN NULL
       ELSE concat('  ', event_type, ' ', props) END AS review_text,
  CASE WHEN event_id % 53 = 0 THEN -value ELSE value END AS hours,
  value / CAST(400 AS DOUBLE) AS weighted_vote_score,
  CASE WHEN event_id % 503 = 0 THEN CAST('1890-01-01 00:00:00' AS TIMESTAMP)
       ELSE CAST(ts AS TIMESTAMP) END AS timestamp_created
FROM {events}
"""

DIRTY_BRIDGE = """
SELECT CASE WHEN l_linenumber = 7 AND l_partkey % 10 = 0 THEN NULL
            ELSE CAST(l_partkey AS STRING) END AS app_id,
  CASE WHEN l_partkey % 101 = 0 THEN '  '
       WHEN l_linenumber % 2 = 0 THEN concat(' ', l_returnflag, '  ', l_linestatus)
       ELSE concat(lower(l_returnflag), ' ', l_linestatus, ' ') END AS tag
FROM {lineitem}
"""

DIRTY_PAGES = """
SELECT page_id AS src_key,
  CASE WHEN page_id % 20 = 1 THEN page_id - 1 WHEN page_id % 83 = 0 THEN NULL ELSE page_id END AS app_id,
  CASE WHEN page_id % 17 = 0 THEN NULL WHEN page_id % 19 = 0 THEN '<p> </p>' ELSE html END AS about
FROM {pages}
"""

DIRTY_PART = """
SELECT p_partkey AS app_id,
  CASE WHEN p_partkey % 71 = 0 THEN ' null ' ELSE p_name END AS title,
  CASE WHEN p_partkey % 31 = 0 THEN '1' WHEN p_partkey % 2 = 0 THEN '0' ELSE 'true' END AS is_free,
  CASE WHEN p_partkey % 37 = 0 THEN -p_size ELSE p_size * 3 END AS positive_ratio,
  CASE WHEN p_partkey % 59 = 0 THEN '2999-01-01' WHEN p_partkey % 13 = 0 THEN 'soon'
       ELSE '2020-05-17' END AS date_release,
  p_retailprice AS price_final
FROM {part}
"""

# Reviews of an item, in the raw spelling of the store export.
ITEM_REVIEWS = """
SELECT l_partkey AS appid,
  concat(CAST(l_linenumber AS STRING), ' votes') AS votes_up,
  CASE WHEN l_suppkey % 11 = 0 THEN NULL ELSE l_suppkey END AS votes_funny,
  CASE l_returnflag WHEN 'A' THEN 'TRUE' WHEN 'N' THEN 'no' ELSE 'maybe' END AS voted_up,
  CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE concat('game ', CAST(l_partkey AS STRING)) END AS game
FROM {lineitem}
"""

# The store's own list: two rows per item with different tags, some names missing.
STORE_GAMES = """
SELECT p_partkey AS app_id, CASE WHEN p_partkey % 142 = 0 THEN 'NA' ELSE p_brand END AS name,
  CASE WHEN p_partkey % 31 = 0 THEN '1' WHEN p_partkey % 2 = 0 THEN '0' ELSE 'true' END AS is_free,
  p_type AS genre, concat('size ', CAST(p_size AS STRING)) AS tag
FROM {part}
UNION ALL
SELECT p_partkey, CASE WHEN p_partkey % 142 = 0 THEN 'NA' ELSE p_brand END,
  CASE WHEN p_partkey % 31 = 0 THEN '1' WHEN p_partkey % 2 = 0 THEN '0' ELSE 'true' END,
  CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE 'PLAIN' END, p_brand
FROM {part}
"""

# Descriptions, texts for promotion and figures of use: of some items only, with missing and text values.
GAME_METADATA = """
SELECT p_partkey AS app_id, CASE WHEN p_partkey % 23 = 0 THEN 'N/A' ELSE concat('About ', p_name) END AS description,
  concat(p_type, ' by ', p_brand) AS tags
FROM {part} WHERE p_partkey % 3 <> 1
"""
GAME_PROMOTIONAL = """
SELECT page_id AS app_id, url AS summary, CASE WHEN page_id % 13 = 0 THEN ' ' ELSE substr(html, 1, 40) END AS extensive,
  html AS about
FROM {pages}
"""
GAME_USAGE = """
SELECT p_partkey AS app_id, p_brand AS developer, concat('0 .. ', CAST(p_size * 1000 AS STRING)) AS owners,
  concat(CAST(p_size AS STRING), '.5 hours') AS average_forever, CASE WHEN p_partkey % 29 = 0 THEN NULL ELSE p_partkey % 97 END AS ccu
FROM {part} WHERE p_partkey % 5 > 0
"""

# User-item interactions: buyer and part of every order line.
INTERACTIONS = """
SELECT o.o_custkey AS user_id, l.l_partkey AS app_id,
  CASE WHEN l.l_returnflag = 'R' THEN 'false' ELSE 'true' END AS is_recommended,
  l.l_quantity AS hours, CAST(l.l_linenumber AS BIGINT) AS helpful, l.l_suppkey % 5 AS funny,
  substr(CAST(CAST(o.o_orderdate AS DATE) AS STRING), 1, 7) AS month
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey
"""

# Item-to-tag pairs: brand, type, size class and the words of the name.
ITEM_TAGS = """
SELECT p_partkey AS app_id, p_brand AS tag FROM {part}
UNION ALL SELECT p_partkey, p_type FROM {part}
UNION ALL SELECT p_partkey, concat('size ', CAST(p_size % 7 AS STRING)) FROM {part}
UNION ALL SELECT p_partkey, split_part(p_name, ' ', 1) FROM {part}
UNION ALL SELECT p_partkey, split_part(p_name, ' ', 2) FROM {part}
"""

# A vector for every item: the vectors, whose ids run without gaps, dealt to the items over and over.
ITEM_VECTORS = """
SELECT p.p_partkey AS app_id, v.embedding AS embedding
FROM {part} p CROSS JOIN (SELECT count(*) AS n, min(vec_id) AS least FROM {embeddings}) c
  JOIN {embeddings} v ON p.p_partkey % c.n + c.least = v.vec_id
"""

# Items with the platforms they run on.
PLATFORM_ITEMS = """
SELECT p_partkey AS app_id, p_size % 2 = 0 AS win, p_size % 3 = 0 AS mac, p_size % 5 = 0 AS linux,
  p_partkey % 4 = 0 AS is_free, p_retailprice AS price
FROM {part}
"""

FIXTURES: dict[str, tuple[str, list[str]]] = {
    "dirty_customer": (DIRTY_CUSTOMER, ["customer"]),
    "dirty_events": (DIRTY_EVENTS, ["events"]),
    "dirty_bridge": (DIRTY_BRIDGE, ["lineitem"]),
    "dirty_pages": (DIRTY_PAGES, ["pages"]),
    "dirty_part": (DIRTY_PART, ["part"]),
    "item_reviews": (ITEM_REVIEWS, ["lineitem"]),
    "store_games": (STORE_GAMES, ["part"]),
    "game_metadata": (GAME_METADATA, ["part"]),
    "game_promotional": (GAME_PROMOTIONAL, ["pages"]),
    "game_usage": (GAME_USAGE, ["part"]),
    "item_tags": (ITEM_TAGS, ["part"]),
    "item_vectors": (ITEM_VECTORS, ["part", "embeddings"]),
    "platform_items": (PLATFORM_ITEMS, ["part"]),
    "interactions": (INTERACTIONS, ["lineitem", "orders"]),
}


def with_fixtures(sql: str) -> str:
    """Prefix a DuckDB query with the fixtures it names."""
    used = [n for n in FIXTURES if re.search(rf"\b{n}\b", sql)]
    if not used:
        return sql
    parts = []
    for name in used:
        text, inputs = FIXTURES[name]
        for table in inputs:
            text = text.replace("{" + table + "}", table)
        parts.append(f"{name} AS ({text})")
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return "WITH " + ", ".join(parts) + ", " + body[5:]
    return "WITH " + ", ".join(parts) + " " + body
