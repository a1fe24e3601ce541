"""Plain DuckDB SQL for the catalog: naive joins and windows over the driver's tables."""

from __future__ import annotations

from checks.adapters import BLOCK_CODES, COUNTRIES
from checks.catalog import CUT, FIRST_RUN, ONE_RUN
from peernet.config import GENESIS_HASH

STAMP = "TIMESTAMP '2024-01-31 00:00:00'"
SINCE = "TIMESTAMP '2024-01-01 00:00:00'"
HASHES = "('new_hash', 'new_hash_66', 'new_hash_68')"
CODES = "[" + ", ".join(f"'{c}'" for c in BLOCK_CODES) + "]"


def _text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


_COUNTRY_ROWS = ", ".join(f"({_text(a)}, {_text(b)}, {_text(c)})" for a, b, c in COUNTRIES)

INPUTS = f"""
e AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
    sha256('a' || user_id) || sha256('b' || user_id) AS pk
  FROM events),
ec AS (
  SELECT *, 'n' || (event_id % 2) AS node_id, sha256(from_hex(pk)) AS peer_id,
    CASE WHEN k % 4 = 0 THEN 'Nethermind/v1.2.' || (k % 3) || '/linux-x64/dotnet8'
      ELSE 'Geth/v1.13.' || (k % 5) || '-stable/linux-amd64/go1.21' END AS client,
    '10.' || (user_id % 30) || '.0.' || k AS host
  FROM e),
feed AS (
  SELECT ts AS msg_timestamp, node_id, peer_id, 'peer_set_add' AS msg_type, CAST([] AS VARCHAR[]) AS msg_data
  FROM ec WHERE event_type = 'signup'
  UNION ALL SELECT ts, node_id, peer_id, 'peer_set_remove',
    ['r', 'x', CAST(CAST(k AS BIGINT) * 1000000000 AS VARCHAR)] FROM ec WHERE event_type = 'error'
  UNION ALL SELECT ts, node_id, peer_id, 'node_start', CAST([] AS VARCHAR[])
  FROM ec WHERE event_type = 'purchase' AND event_id % 7 = 0
  UNION ALL SELECT ts + INTERVAL 10 MILLISECONDS, node_id, peer_id, 'node_tracker',
    [pk, '5', client, '["eth/67","eth/68"]',
      CASE WHEN event_id % 11 <> 0 THEN host || ':30303' END] FROM ec WHERE event_type = 'signup'
  UNION ALL SELECT ts + INTERVAL 20 MILLISECONDS, node_id, peer_id, 'handshake_eth',
    [CASE WHEN k % 10 = 9 THEN '5' ELSE '1' END, 'x', '{GENESIS_HASH}', '0x' || sha256('blk' || (event_id % 100)),
     '0x' || sha256('blk' || (event_id % 100 - event_id % 3))] FROM ec WHERE event_type = 'signup'
  UNION ALL SELECT ts, node_id, peer_id,
    CASE event_id % 3 WHEN 0 THEN 'new_hash' WHEN 1 THEN 'new_hash_66' ELSE 'new_hash_68' END,
    list_transform(range(0, k % 4 + 1), lambda i: '0x' || sha256(CAST((event_id * 31 + i * 7) % 500 AS VARCHAR)))
  FROM ec WHERE event_type = 'view'
  UNION ALL SELECT ts, node_id, peer_id, 'get_tx_66',
    list_transform(range(0, k % 4 + 1), lambda i: '0x' || sha256(CAST((event_id * 17 + i * 7) % 500 AS VARCHAR)))
  FROM ec WHERE event_type = 'click'),
eth_transaction AS (
  SELECT o_orderkey // 10 + 1 AS blk_number,
    TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(o_orderkey % 500 * 80 AS INTEGER)) AS blk_timestamp,
    '0x' || sha256(CAST(o_orderkey AS VARCHAR)) AS tx_hash, CAST(o_orderkey % 10 AS INTEGER) AS tx_index,
    CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS tx_status,
    '0x' || sha256(CAST(o_custkey AS VARCHAR)) AS tx_from, '0x' || sha256('to' || o_custkey) AS tx_to,
    CAST(1.0 AS DOUBLE) AS tx_gas_price, CAST(21000.0 AS DOUBLE) AS tx_gas_used, o_totalprice AS tx_value
  FROM orders),
tx AS (SELECT * FROM eth_transaction),
block_header AS (
  SELECT 1000 + n AS blk_number, sha256('blk' || n) AS blk_hash FROM (SELECT DISTINCT event_id % 100 AS n FROM e)),
ethernodes AS (
  SELECT pk AS node_public_key, host AS ip, 'isp' || (k % 5) AS isp, ({CODES})[user_id % 25 + 1] AS country,
    split_part(client, '/', 1) AS client_type, split_part(client, '/', 2) AS client_version,
    split_part(client, '/', 3) AS os, k % 2 = 0 AS in_sync, ts AS last_seen
  FROM ec WHERE event_type = 'purchase' AND event_id % 2 = 0),
etherscan AS (
  SELECT pk AS node_public_key, host AS ip, CAST(30303 + k % 3 AS INTEGER) AS port,
    ({CODES})[user_id % 25 + 1] AS country, split_part(client, '/', 1) AS client_type,
    split_part(client, '/', 4) AS run_time_version, split_part(client, '/', 3) AS os, ts AS last_seen
  FROM ec WHERE event_type = 'purchase' AND event_id % 2 = 1),
nets AS (
  SELECT i, 167772160 + i * 65536 AS base, ({CODES})[i + 1] AS country_code
  FROM (SELECT DISTINCT user_id % 30 AS i FROM e) WHERE i < 25),
geo_blocks AS (
  SELECT base AS start_ip, base + 65535 AS end_ip, country_code, 'city' || i AS city, 'sub' || i AS subdivision FROM nets
  UNION ALL SELECT base, base + 63, country_code, 'inner' || i, NULL FROM nets WHERE i % 2 = 0
  UNION ALL SELECT base + 70, base + 90, country_code, 'odd' || i, NULL FROM nets WHERE i % 5 = 0),
country_code(country_code, country_name, region) AS (VALUES {_COUNTRY_ROWS}),
ledger AS (
  SELECT TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(r AS INTEGER)) AS run_timestamp, 'ethereum' AS blockchain,
    'FACT_TRANSACTION__TX_HASH' AS incremental_table, r % 7 <> 0 AND r <> max(r) OVER () AS run_completed,
    lo AS run_start_blk_number, hi AS run_stop_blk_number
  FROM (SELECT blk_number // 100 AS r, min(blk_number) AS lo, max(blk_number) AS hi FROM eth_transaction GROUP BY 1))
"""

MODELS = f"""
hash_msg AS (SELECT * FROM feed WHERE msg_type IN {HASHES}),
announced AS (
  SELECT node_id, peer_id, msg_timestamp, msg_type, unnest(msg_data) AS hash_text,
    generate_subscripts(msg_data, 1) - 1 AS msg_hash_index
  FROM hash_msg),
marked AS (
  SELECT a.*, t.tx_hash AS confirmed_hash, t.blk_timestamp
  FROM announced a LEFT JOIN tx t ON a.hash_text = t.tx_hash AND a.msg_timestamp < t.blk_timestamp),
peer_events AS (
  SELECT msg_timestamp, node_id, peer_id, msg_type,
    CASE WHEN msg_type <> 'peer_set_add' THEN msg_timestamp END AS closed_at,
    CASE WHEN msg_type = 'peer_set_remove' THEN msg_data[3] END AS reported
  FROM feed WHERE msg_type IN ('peer_set_add', 'peer_set_remove', 'node_start') AND msg_timestamp > {SINCE}),
sessions AS (
  SELECT start_time, end_time, CAST(reported AS BIGINT) AS session_duration,
    date_diff('microsecond', start_time, coalesce(end_time, last_event)) * 1000 AS session_duration_calculated,
    session_duration_calculated / 1e9 / 3600.0 AS session_duration_hour, end_time IS NULL AS end_time_imputed,
    node_id, peer_id
  FROM (SELECT max(msg_timestamp) AS last_event FROM peer_events), (
    SELECT msg_timestamp AS start_time, node_id, peer_id, msg_type,
      lead(closed_at IGNORE NULLS) OVER w AS end_time, lead(reported IGNORE NULLS) OVER w AS reported
    FROM peer_events
    WINDOW w AS (PARTITION BY node_id, peer_id ORDER BY msg_timestamp, msg_type, reported NULLS FIRST))
  WHERE msg_type = 'peer_set_add'),
en AS (
  SELECT sha256(from_hex(node_public_key)) AS node_id, node_public_key, s.first_seen, s.last_seen, d.* EXCLUDE (node_public_key)
  FROM (SELECT node_public_key, min(last_seen) AS first_seen, max(last_seen) AS last_seen FROM ethernodes GROUP BY 1) s
  LEFT JOIN (
    SELECT * EXCLUDE (last_seen) FROM ethernodes
    QUALIFY row_number() OVER (PARTITION BY node_public_key ORDER BY last_seen DESC NULLS FIRST, ip NULLS FIRST,
      isp NULLS FIRST, country NULLS FIRST, client_type NULLS FIRST) = 1) d USING (node_public_key)),
es AS (
  SELECT sha256(from_hex(node_public_key)) AS node_id, node_public_key, s.first_seen, s.last_seen, d.* EXCLUDE (node_public_key)
  FROM (SELECT node_public_key, min(last_seen) AS first_seen, max(last_seen) AS last_seen FROM etherscan GROUP BY 1) s
  LEFT JOIN (
    SELECT * EXCLUDE (last_seen) FROM etherscan
    QUALIFY row_number() OVER (PARTITION BY node_public_key ORDER BY last_seen DESC NULLS FIRST, ip NULLS FIRST,
      port NULLS FIRST, country NULLS FIRST, client_type NULLS FIRST) = 1) d USING (node_public_key)),
peers AS (
  SELECT node_id, node_public_key, first_seen, last_seen, ip, CAST(NULL AS INTEGER) AS port, isp, country, client_type,
    client_version, CAST(NULL AS VARCHAR) AS run_time_version, os, in_sync, 'ethernodes' AS source FROM en
  UNION ALL
  SELECT node_id, node_public_key, first_seen, last_seen, ip, port, NULL, country, client_type, NULL,
    run_time_version, os, NULL, 'etherscan' FROM es),
shaken AS (
  SELECT node_id, peer_id, msg_timestamp, msg_data[4] AS head, msg_data[5] AS local FROM feed
  WHERE msg_type = 'handshake_eth' AND msg_timestamp > {SINCE} - INTERVAL 14 HOURS
    AND CAST(msg_data[1] AS INTEGER) = 1 AND msg_data[3] = '{GENESIS_HASH}'),
gaps AS (
  SELECT s.node_id, s.peer_id, s.msg_timestamp, s.head = s.local AND s.head IS NOT NULL AS in_sync,
    b1.blk_number AS head_block, b2.blk_number AS local_block,
    CASE WHEN b1.blk_number IS NULL OR b2.blk_number IS NULL THEN NULL
      ELSE greatest(b1.blk_number - b2.blk_number, 0) END AS sync_block_gap
  FROM shaken s
    LEFT JOIN block_header b1 ON s.head = lower('0x' || b1.blk_hash)
    LEFT JOIN block_header b2 ON s.local = lower('0x' || b2.blk_hash)
  QUALIFY row_number() OVER (PARTITION BY s.node_id, s.peer_id, date_trunc('minute', s.msg_timestamp)
    ORDER BY s.msg_timestamp, s.head, s.local, b1.blk_number, b2.blk_number) = 1),
trackers AS (
  SELECT node_id, peer_id, msg_timestamp, replace(msg_data[1], '"', '') AS peer_public_key,
    CAST(msg_data[2] AS INTEGER) AS peer_rlp_protocol_version,
    nullif(split_part(msg_data[3], '/', 1), '') AS peer_client_type,
    nullif(regexp_extract(msg_data[3], 'v[^/]+', 0), '') AS peer_client_version,
    nullif(regexp_extract(msg_data[3], '/([^/]+)/[^/]+$', 1), '') AS peer_os,
    nullif(regexp_extract(msg_data[3], '([^/]+)$', 1), '') AS peer_run_time_version,
    replace(msg_data[4], '"', '') AS peer_capabilities,
    replace(split_part(msg_data[5], ':', 1), '"', '') AS peer_ip,
    CAST(split_part(msg_data[5], ':', 2) AS INTEGER) AS peer_port
  FROM feed WHERE msg_type = 'node_tracker' AND msg_timestamp > {SINCE} - INTERVAL 14 HOURS
  QUALIFY row_number() OVER (PARTITION BY node_id, peer_id, date_trunc('minute', msg_timestamp)
    ORDER BY msg_timestamp, msg_data) = 1),
places AS (
  SELECT peer_ip, country_code, city, subdivision
  FROM (SELECT DISTINCT peer_ip FROM trackers) a JOIN geo_blocks b
    ON CAST(split_part(peer_ip, '.', 1) AS BIGINT) * 16777216 + CAST(split_part(peer_ip, '.', 2) AS BIGINT) * 65536
      + CAST(split_part(peer_ip, '.', 3) AS BIGINT) * 256 + CAST(split_part(peer_ip, '.', 4) AS BIGINT)
      BETWEEN b.start_ip AND b.end_ip
  QUALIFY row_number() OVER (PARTITION BY peer_ip ORDER BY end_ip - start_ip, start_ip) = 1),
fact_sessions AS (
  SELECT s.start_time, s.end_time, s.session_duration, s.session_duration_calculated, s.session_duration_hour,
    s.end_time_imputed, s.node_id, s.peer_id, nt.* EXCLUDE (node_id, peer_id, msg_timestamp), sg.in_sync,
    sg.head_block, sg.local_block, sg.sync_block_gap, c.region AS peer_region, c.country_name AS peer_country,
    g.city AS peer_city, g.subdivision AS peer_subdivision,
    p.first_seen AS etherscan_first_seen, p.last_seen AS etherscan_last_seen, p.ip AS etherscan_ip,
    p.port AS etherscan_port, p.country AS etherscan_country, p.client_type AS etherscan_client_type,
    p.run_time_version AS etherscan_run_time_version, p.os AS etherscan_os,
    q.first_seen AS ethernodes_first_seen, q.last_seen AS ethernodes_last_seen, q.ip AS ethernodes_ip,
    q.isp AS ethernodes_isp, q.country AS ethernodes_country, q.client_type AS ethernodes_client_type,
    q.client_version AS ethernodes_client_version, q.os AS ethernodes_os, q.in_sync AS ethernodes_in_sync,
    {STAMP} AS updated_at
  FROM sessions s
    LEFT JOIN trackers nt ON s.node_id = nt.node_id AND s.peer_id = nt.peer_id
      AND date_trunc('minute', s.start_time) = date_trunc('minute', nt.msg_timestamp)
    LEFT JOIN gaps sg ON s.node_id = sg.node_id AND s.peer_id = sg.peer_id
      AND date_trunc('minute', s.start_time) = date_trunc('minute', sg.msg_timestamp)
    LEFT JOIN places g ON nt.peer_ip = g.peer_ip
    LEFT JOIN country_code c ON g.country_code = c.country_code
    LEFT JOIN peers p ON s.peer_id = p.node_id AND p.source = 'etherscan'
    LEFT JOIN peers q ON s.peer_id = q.node_id AND q.source = 'ethernodes'),
limits AS (
  SELECT {SINCE} AS lo,
    least(date_trunc('hour', (SELECT max(start_time) FROM sessions)) - INTERVAL 1 HOUR,
      date_trunc('hour', (SELECT max(blk_timestamp) FROM tx))) AS hi),
spans AS (
  SELECT peer_id, node_id, start_time, coalesce(end_time, least(hi, start_time + INTERVAL 12 HOURS)) AS end_time,
    date_trunc('hour', start_time) AS start_hour,
    date_trunc('hour', coalesce(end_time, least(hi, start_time + INTERVAL 12 HOURS))) AS end_hour, lo, hi
  FROM sessions s, limits
  WHERE start_time < hi AND coalesce(s.end_time, least(hi, start_time + INTERVAL 12 HOURS)) >= lo),
slices AS (
  SELECT peer_id, node_id, session_hour, start_time, end_time,
    session_hour = start_hour OR session_hour = end_hour AS is_edge_hour,
    greatest(session_hour, start_time) AS session_hour_start,
    least(end_time, session_hour + INTERVAL 1 HOUR) AS session_hour_end,
    date_diff('minute', session_hour_start, session_hour_end) AS session_hour_minutes
  FROM (SELECT *, unnest(generate_series(start_hour, end_hour, INTERVAL 1 HOUR)) AS session_hour FROM spans)
  WHERE session_hour >= lo AND session_hour < hi
    AND greatest(session_hour, start_time) <> least(end_time, session_hour + INTERVAL 1 HOUR)),
counted AS (
  SELECT s.peer_id, s.node_id, s.session_hour, s.session_hour_start, s.session_hour_end, s.start_time, s.end_time,
    s.is_edge_hour, s.session_hour_minutes, count(m.peer_id) AS total_hash_count,
    count(DISTINCT m.confirmed_hash) AS confirmed_distinct_tx_count
  FROM slices s
    LEFT JOIN (SELECT marked.* FROM marked, limits WHERE msg_timestamp BETWEEN lo AND hi) m
      ON m.peer_id = s.peer_id AND m.node_id = s.node_id
      AND m.msg_timestamp BETWEEN s.session_hour_start AND s.session_hour_end
  GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9),
hourly AS (
  SELECT c.*,
    CASE WHEN session_hour_minutes = 0 THEN 0 ELSE total_hash_count / session_hour_minutes END AS hash_per_minute,
    CASE WHEN session_hour_minutes = 0 THEN 0 ELSE confirmed_distinct_tx_count / session_hour_minutes END
      AS confirmed_distinct_tx_per_minute,
    lo AS update_start_time, hi AS update_end_time, {STAMP} AS updated_at
  FROM counted c, limits),
mempool AS (
  SELECT hash_text AS tx_hash, min(msg_timestamp) AS first_seen_at FROM announced WHERE msg_timestamp > {SINCE} GROUP BY 1),
mempool_hours AS (
  SELECT date_trunc('hour', m.first_seen_at) AS blk_hour, count(*) AS tx_ct
  FROM mempool m JOIN tx ON m.tx_hash = tx.tx_hash GROUP BY 1),
shares AS (
  SELECT h.peer_id, h.session_hour, h.confirmed_distinct_tx_per_minute,
    CASE WHEN m.tx_ct IS NULL THEN NULL ELSE least(h.confirmed_distinct_tx_count / m.tx_ct, 1) END AS pct
  FROM hourly h LEFT JOIN mempool_hours m ON h.session_hour = m.blk_hour WHERE NOT is_edge_hour),
rates AS (
  SELECT peer_id, avg(confirmed_distinct_tx_per_minute) AS per_minute,
    coalesce(avg(pct) FILTER (CAST(session_hour AS DATE) >= DATE '2024-01-17'), 0) AS avg_2w,
    coalesce(max(pct) FILTER (CAST(session_hour AS DATE) >= DATE '2024-01-17'), 0) AS max_2w,
    avg(pct) AS avg_all, max(pct) AS max_all
  FROM shares GROUP BY 1),
latest AS (
  SELECT * FROM fact_sessions WHERE peer_client_type IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY peer_id ORDER BY start_time DESC NULLS FIRST, node_id, end_time NULLS FIRST) = 1),
upgrades AS (
  SELECT peer_id, max(start_time) AS upgraded_at
  FROM (SELECT peer_id, start_time, peer_client_version,
      lag(peer_client_version) OVER (PARTITION BY peer_id ORDER BY start_time, node_id) AS prev_version
    FROM fact_sessions WHERE peer_client_type IS NOT NULL
    QUALIFY peer_client_version <> prev_version OR prev_version IS NULL)
  GROUP BY 1),
lags AS (
  SELECT peer_id, avg(sync_block_gap) AS avg_sync_lag,
    coalesce(avg(sync_block_gap) FILTER (CAST(start_time AS DATE) >= DATE '2024-01-17'), 0) AS avg_sync_lag_2w
  FROM fact_sessions GROUP BY 1),
performance AS (
  SELECT r.peer_id, CAST(round(CAST(r.per_minute AS DECIMAL(38, 10)), 0) AS DOUBLE) AS avg_confirmed_distinct_tx_per_minute,
    CAST(round(CAST(avg_2w * 100 AS DECIMAL(38, 10)), 2) AS DOUBLE) AS avg_propogation_rate_2w,
    CAST(round(CAST(max_2w * 100 AS DECIMAL(38, 10)), 2) AS DOUBLE) AS max_propogation_rate_2w,
    CAST(round(CAST(avg_all * 100 AS DECIMAL(38, 10)), 2) AS DOUBLE) AS avg_propogation_rate,
    CAST(round(CAST(max_all * 100 AS DECIMAL(38, 10)), 2) AS DOUBLE) AS max_propogation_rate,
    u.upgraded_at, avg_sync_lag, avg_sync_lag_2w, coalesce(d.in_sync, FALSE) AS in_sync, d.peer_public_key,
    d.peer_rlp_protocol_version, d.peer_client_type, d.peer_client_version, d.peer_os, d.peer_run_time_version,
    d.peer_capabilities, d.peer_ip, d.peer_port, d.peer_region, d.peer_country, d.peer_city, d.peer_subdivision,
    coalesce(d.end_time, d.start_time) AS last_seen_at
  FROM rates r LEFT JOIN latest d ON r.peer_id = d.peer_id LEFT JOIN upgrades u ON r.peer_id = u.peer_id
    LEFT JOIN lags l ON r.peer_id = l.peer_id),
region_counts AS (
  SELECT coalesce(l.peer_region, 'unknown') AS peer_region, l.enode, CAST(sum(h.total_hash_count) AS BIGINT) AS hash_ct
  FROM hourly h LEFT JOIN (
      SELECT peer_id, peer_region, peer_public_key || '@' || peer_ip || ':' || peer_port AS enode FROM fact_sessions
      QUALIFY row_number() OVER (PARTITION BY peer_id ORDER BY start_time DESC NULLS FIRST, node_id) = 1) l
    ON h.peer_id = l.peer_id
  WHERE h.session_hour >= {STAMP} - INTERVAL 12 DAYS GROUP BY 1, 2 HAVING sum(h.total_hash_count) > 0),
under AS (
  SELECT peer_region, enode, hash_ct, {STAMP} AS updated_at FROM region_counts
  QUALIFY row_number() OVER (PARTITION BY peer_region ORDER BY hash_ct, enode NULLS FIRST) <= 100),
recent_msg AS (SELECT * FROM hash_msg WHERE msg_timestamp > {STAMP} - INTERVAL 7 DAYS),
orders_raw AS (
  SELECT confirmed_hash AS tx_hash,
    list({{'ts': msg_timestamp, 'node': node_id, 'peer': peer_id}} ORDER BY msg_timestamp, node_id, peer_id) AS seen
  FROM marked WHERE confirmed_hash IS NOT NULL AND msg_timestamp > {STAMP} - INTERVAL 7 DAYS GROUP BY 1),
orders_kept AS (
  SELECT tx_hash, seen,
    list_filter(seen, lambda s, i: len(list_filter(seen[1:i-1], lambda p: p.node = s.node AND p.peer = s.peer)) = 0) AS kept
  FROM orders_raw),
hash_facts AS (
  SELECT substr(h.tx_hash, 3) AS tx_hash, seen[1].peer AS first_peer, t.blk_timestamp AS confirmed_at,
    seen[1].ts AS first_seen_at, seen[2].ts AS second_seen_at, seen[1].node AS first_node, seen[2].node AS second_node,
    CAST(len(list_distinct(list_transform(seen, lambda s: s.peer))) AS INTEGER) AS seen_by_count,
    date_diff('microsecond', seen[1].ts, seen[2].ts) * 1000 AS win_margin_nano,
    win_margin_nano / 1000000000 AS win_margin_sec, CAST(len(pm.msg_data) AS INTEGER) AS first_msg_hash_count,
    CAST(list_position(pm.msg_data, h.tx_hash) - 1 AS BIGINT) AS first_msg_hash_index,
    array_to_string(list_transform(kept, lambda s: CAST(epoch_us(s.ts) AS VARCHAR)), ',') AS msg_timestamps,
    array_to_string(list_transform(kept, lambda s: s.node), ',') AS msg_node_order,
    array_to_string(list_transform(kept, lambda s: s.peer), ',') AS msg_peer_order, t.tx_from
  FROM orders_kept h JOIN recent_msg pm ON pm.msg_timestamp = seen[1].ts AND pm.peer_id = seen[1].peer
    LEFT JOIN tx t ON h.tx_hash = t.tx_hash)
"""

_UNIQUE_HASH = """,
w AS (SELECT TIMESTAMP '2024-01-22' AS a, TIMESTAMP '2024-01-29' AS b),
meta AS (
  SELECT epoch_us(min(msg_timestamp)) // 60000000 AS lo, epoch_us(max(msg_timestamp)) // 60000000 AS hi
  FROM hash_msg, w WHERE msg_timestamp BETWEEN a AND b),
chosen AS (SELECT s.* FROM sessions s, w WHERE start_time BETWEEN a AND b),
bins AS (SELECT s.*, unnest(range(greatest(epoch_us(start_time) // 60000000, lo),
    least(epoch_us(end_time) // 60000000, hi) + 1)) AS bin_num FROM chosen s, meta WHERE end_time IS NOT NULL),
gets AS (
  SELECT node_id, peer_id, msg_timestamp, epoch_us(msg_timestamp) // 60000000 AS bin_num, len(msg_data) AS asked, hash_text
  FROM (SELECT feed.*, unnest(msg_data) AS hash_text FROM feed, w WHERE msg_type = 'get_tx_66' AND msg_timestamp BETWEEN a AND b)),
sent AS (
  SELECT b.peer_id, b.node_id, b.start_time, b.session_duration_calculated AS d, count(m.peer_id) AS total_hash_count,
    count(DISTINCT m.confirmed_hash) AS confirmed_distinct_tx_count
  FROM bins b LEFT JOIN (SELECT marked.*, epoch_us(msg_timestamp) // 60000000 AS bin_num FROM marked, w
      WHERE msg_timestamp BETWEEN a AND w.b) m
    ON b.bin_num = m.bin_num AND b.peer_id = m.peer_id AND b.node_id = m.node_id
    AND m.msg_timestamp BETWEEN date_trunc('second', b.start_time) AND date_trunc('second', b.end_time)
  GROUP BY 1, 2, 3, 4),
asked_sum AS (
  SELECT b.peer_id, b.node_id, b.start_time, sum(g.asked) AS total_get_hash_count
  FROM bins b LEFT JOIN (SELECT DISTINCT node_id, peer_id, msg_timestamp, bin_num, asked FROM gets) g
    ON b.bin_num = g.bin_num AND b.peer_id = g.peer_id AND b.node_id = g.node_id
    AND g.msg_timestamp BETWEEN date_trunc('second', b.start_time) AND date_trunc('second', b.end_time)
  GROUP BY 1, 2, 3),
asked_distinct AS (
  SELECT b.peer_id, b.node_id, b.start_time, count(DISTINCT g.hash_text) AS distinct_get_hash_count
  FROM bins b LEFT JOIN gets g
    ON b.bin_num = g.bin_num AND b.peer_id = g.peer_id AND b.node_id = g.node_id
    AND g.msg_timestamp BETWEEN date_trunc('second', b.start_time) AND date_trunc('second', b.end_time)
  GROUP BY 1, 2, 3)
SELECT s.peer_id, s.node_id, s.start_time, s.end_time, s.session_duration_calculated, s.session_duration_hour,
  CAST(NULL AS BIGINT) AS msg_ct, CAST(NULL AS DOUBLE) AS msg_per_minute,
  total_hash_count, total_hash_count / (d / 1e9 / 60) AS hash_per_minute,
  confirmed_distinct_tx_count, confirmed_distinct_tx_count / (d / 1e9 / 60) AS confirmed_distinct_tx_per_minute,
  CAST(total_get_hash_count AS BIGINT) AS total_get_hash_count,
  CAST(total_get_hash_count AS BIGINT) / (d / 1e9 / 60) AS get_hash_per_minute,
  distinct_get_hash_count, distinct_get_hash_count / (d / 1e9 / 60) AS distinct_get_hash_per_minute
FROM chosen s LEFT JOIN sent USING (peer_id, node_id, start_time)
  LEFT JOIN asked_sum USING (peer_id, node_id, start_time) LEFT JOIN asked_distinct USING (peer_id, node_id, start_time)
"""

_STAGED = f"""SELECT blk_number, blk_timestamp, 'ethereum' AS blockchain, substr(tx_hash, 3) AS tx_hash, tx_index,
  tx_status, tx_from, tx_to, tx_gas_price, tx_gas_used, tx_value, {STAMP} AS run_timestamp FROM tx"""
_ROLE = {
    "etherscan": ["first_seen", "last_seen", "ip", "port", "country", "client_type", "run_time_version", "os"],
    "ethernodes": ["first_seen", "last_seen", "ip", "isp", "country", "client_type", "client_version", "os", "in_sync"],
}
_ROLES = ", ".join(f"{a}.{c} AS {a}_{c}" for a, columns in _ROLE.items() for c in columns)
_PLAN = f"""SELECT {STAMP} AS run_timestamp, 'ethereum' AS blockchain, t AS incremental_table, FALSE AS run_completed,
  coalesce(stop, 0) + 1 AS run_start_blk_number, (SELECT max(blk_number) FROM eth_transaction
    WHERE blk_timestamp + INTERVAL 1 MINUTE < {STAMP}) AS run_stop_blk_number
FROM (VALUES ('FACT_TRANSACTION__TX_HASH'), ('FACT_NEW')) m(t) LEFT JOIN (
  SELECT incremental_table, max(run_stop_blk_number) AS stop FROM ledger WHERE run_completed GROUP BY 1) l ON t = l.incremental_table"""
_NEWEST = "SELECT max(run_stop_blk_number) FROM ledger WHERE run_completed"
_TWICE = "msg_data || msg_data"
_MIRROR = "msg_data || list_reverse(msg_data)"
_REPEATED = f"list_filter(range(0, len({_MIRROR})), lambda i: list_position({_MIRROR}, ({_MIRROR})[i + 1]) <= i)"

QUERIES: dict[str, str] = {
    "fact_transaction": f"{_STAGED} WHERE blk_number BETWEEN coalesce(({_NEWEST}), 0) + 1 AND (SELECT max(blk_number) FROM tx)",
    "tracker_ethernodes": "SELECT * FROM en",
    "tracker_etherscan": "SELECT * FROM es",
    "dim_peers": "SELECT * FROM peers",
    "fact_peer_session": "SELECT * FROM fact_sessions",
    "fact_mempool": f"SELECT *, {STAMP} AS updated_at FROM mempool",
    "hourly_performance": "SELECT * FROM hourly",
    "peer_performance": "SELECT * FROM performance",
    "fact_hash": "SELECT * FROM hash_facts",
    "undersampled": "SELECT * FROM under",
    "hourly_run": "SELECT * FROM performance",
    "scan_feed": """SELECT msg_timestamp, node_id, peer_id, msg_type FROM feed
      WHERE msg_type IN ('peer_set_add', 'handshake_eth') AND msg_timestamp > TIMESTAMP '2024-01-10'
        AND msg_timestamp <= TIMESTAMP '2024-01-20'""",
    "stg_transaction": _STAGED,
    "stg_ethernodes": f"SELECT *, {STAMP} AS run_timestamp FROM ethernodes",
    "stg_etherscan": f"SELECT *, {STAMP} AS run_timestamp FROM etherscan",
    "seed_country": """SELECT c.country_code, country_name, region, count(g.peer_ip) AS sightings FROM country_code c
      LEFT JOIN (SELECT p.* FROM feed f JOIN places p ON split_part(f.msg_data[5], ':', 1) = p.peer_ip
        WHERE f.msg_type = 'node_tracker') g ON c.country_code = g.country_code GROUP BY 1, 2, 3""",
    "replace_table": "SELECT node_id, first_seen, last_seen, 'etherscan' AS source FROM es",
    "append_increment": f"""SELECT CASE WHEN blk_number <= m THEN TIMESTAMP '{FIRST_RUN}' ELSE {STAMP} END AS run_timestamp,
      blk_number, substr(tx_hash, 3) AS tx_hash, tx_value
      FROM tx, (SELECT max(blk_number) AS m FROM tx WHERE blk_timestamp + INTERVAL 1 MINUTE < TIMESTAMP '{FIRST_RUN}')""",
    "upsert_by_key": "SELECT peer_id, node_id, start_time, end_time FROM sessions",
    "cluster_write": "SELECT peer_id, node_id, start_time, end_time FROM sessions",
    "export_csv_roundtrip": "SELECT peer_region, enode, hash_ct FROM under",
    "export_undersampled": "SELECT peer_region, enode, hash_ct FROM under",
    "export_performance": f"""SELECT * EXCLUDE (peer_subdivision) FROM performance
      WHERE last_seen_at >= {STAMP} - INTERVAL 1 MONTH""",
    "freshness_check": f"""SELECT 'eth_transaction' AS table_name, newest, epoch_us({STAMP}) / 6e7 - epoch_us(newest) / 6e7
      AS age_minutes, CASE WHEN age_minutes <= 60 THEN 'pass' ELSE 'error' END AS status
      FROM (SELECT max(blk_timestamp) AS newest FROM tx)""",
    "filter_predicates": f"""SELECT msg_timestamp, node_id, peer_id, msg_type FROM feed WHERE peer_id IS NOT NULL AND (
      (msg_type IN {HASHES} AND msg_timestamp BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-07')
      OR (msg_type = 'peer_set_remove' AND msg_timestamp >= TIMESTAMP '2024-01-29'))""",
    "block_range_filter": f"""SELECT blk_number, tx_index, substr(tx_hash, 3) AS tx_hash FROM tx JOIN ledger l
      ON blk_number BETWEEN run_start_blk_number AND run_stop_blk_number AND l.run_timestamp = TIMESTAMP '{ONE_RUN}'""",
    "join_inner": "SELECT m.*, blk_number, blk_timestamp FROM mempool m JOIN tx USING (tx_hash)",
    "join_left": "SELECT m.*, blk_number, blk_timestamp FROM mempool m LEFT JOIN tx USING (tx_hash)",
    "preconfirmation_join": """SELECT peer_id, node_id, msg_timestamp, substr(hash_text, 3) AS tx_hash, blk_timestamp,
      confirmed_hash IS NOT NULL AS is_sent_pre_confirmation FROM marked""",
    "interval_join_hourly": """SELECT s.peer_id, s.node_id, session_hour, start_time, end_time, msg_timestamp,
      substr(hash_text, 3) AS tx_hash FROM slices s JOIN announced a ON s.peer_id = a.peer_id AND s.node_id = a.node_id
      AND msg_timestamp BETWEEN session_hour_start AND session_hour_end""",
    "interval_join_binned": """SELECT s.peer_id, s.node_id, start_time, end_time, msg_timestamp FROM sessions s JOIN feed f
      ON s.peer_id = f.peer_id AND s.node_id = f.node_id AND msg_type = 'get_tx_66'
      AND msg_timestamp BETWEEN date_trunc('second', start_time) AND date_trunc('second', end_time)""",
    "hour_slices": "SELECT * FROM slices",
    "minute_bucket_join": """SELECT s.peer_id, s.node_id, s.start_time, t.* EXCLUDE (peer_id, node_id, msg_timestamp)
      FROM sessions s LEFT JOIN trackers t ON s.peer_id = t.peer_id AND s.node_id = t.node_id
      AND date_trunc('minute', start_time) = date_trunc('minute', msg_timestamp)""",
    "hex_key_join": """SELECT peer_id, msg_timestamp, local AS local_block_hash, blk_number FROM shaken
      JOIN block_header ON local = '0x' || lower(blk_hash)""",
    "role_playing_join": f"""SELECT s.peer_id, s.node_id, s.start_time, {_ROLES} FROM sessions s
      LEFT JOIN peers etherscan ON s.peer_id = etherscan.node_id AND etherscan.source = 'etherscan'
      LEFT JOIN peers ethernodes ON s.peer_id = ethernodes.node_id AND ethernodes.source = 'ethernodes'""",
    "first_seen_upsert": f"""SELECT m.*, {STAMP} AS updated_at FROM mempool m LEFT JOIN (
      SELECT hash_text, min(msg_timestamp) AS t FROM announced WHERE msg_timestamp > TIMESTAMP '{CUT}' GROUP BY 1) k
      ON m.tx_hash = k.hash_text WHERE k.t IS NULL OR m.first_seen_at < k.t""",
    "first_seen_increments": f"SELECT *, {STAMP} AS updated_at FROM mempool",
    "geoip_enrich": """SELECT node_id, peer_id, msg_timestamp, t.peer_ip, country_code AS peer_country_code,
      city AS peer_city, subdivision AS peer_subdivision FROM trackers t LEFT JOIN places p ON t.peer_ip = p.peer_ip""",
    "sync_gap": "SELECT * FROM gaps",
    "explode_hashes": """SELECT node_id, peer_id, msg_timestamp, msg_type, CAST(msg_hash_index AS INTEGER) AS msg_hash_index,
      hash_text, substr(hash_text, 3) AS tx_hash FROM announced""",
    "number_range": """SELECT bin_num, coalesce(messages, 0) AS messages FROM (
      SELECT unnest(range(min(epoch_us(msg_timestamp) // 60000000), max(epoch_us(msg_timestamp) // 60000000) + 1)) AS bin_num
      FROM hash_msg) LEFT JOIN (SELECT epoch_us(msg_timestamp) // 60000000 AS bin_num, count(*) AS messages FROM hash_msg
      GROUP BY 1) USING (bin_num)""",
    "seen_range": """SELECT node_public_key, min(last_seen) AS first_seen, max(last_seen) AS last_seen FROM ethernodes
      GROUP BY 1""",
    "feed_bounds": """SELECT min(msg_timestamp) AS start_time, max(msg_timestamp) AS end_time,
      epoch_us(min(msg_timestamp)) // 60000000 AS bin_num_start, epoch_us(max(msg_timestamp)) // 60000000 AS bin_num_end
      FROM hash_msg""",
    "public_mempool_hourly": "SELECT * FROM mempool_hours",
    "conditional_agg": """SELECT peer_id, avg(sync_block_gap) AS avg_sync_lag, coalesce(avg(CASE WHEN
      CAST(msg_timestamp AS DATE) >= DATE '2024-01-17' THEN sync_block_gap END), 0) AS avg_sync_lag_2w FROM gaps GROUP BY 1""",
    "ordered_arrays": """SELECT substr(tx_hash, 3) AS tx_hash,
      array_to_string(list_transform(kept, lambda s: CAST(epoch_us(s.ts) AS VARCHAR)), ',') AS msg_timestamps,
      array_to_string(list_transform(kept, lambda s: s.node), ',') AS msg_node_order,
      array_to_string(list_transform(kept, lambda s: s.peer), ',') AS msg_peer_order FROM orders_kept""",
    "hll_distinct": """SELECT msg_type, count(DISTINCT hash_text) AS exact_ct, TRUE AS within_five_percent
      FROM (SELECT msg_type, unnest(msg_data) AS hash_text FROM feed) GROUP BY 1""",
    "impute_end": """SELECT peer_id, node_id, start_time, session_duration_calculated, session_duration_hour,
      end_time_imputed FROM sessions""",
    "latest_per_key": """SELECT * FROM etherscan QUALIFY row_number() OVER (PARTITION BY node_public_key
      ORDER BY last_seen DESC NULLS FIRST, ip, port, country, client_type) = 1""",
    "first_per_minute": """SELECT node_id, msg_timestamp, peer_id, msg_type FROM feed QUALIFY row_number() OVER (
      PARTITION BY node_id, date_trunc('minute', msg_timestamp) ORDER BY msg_timestamp, peer_id, msg_type) = 1""",
    "bottom_k_per_group": """SELECT node_id, peer_id, message_ct FROM (SELECT node_id, peer_id, count(*) AS message_ct
      FROM hash_msg GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY node_id ORDER BY message_ct, peer_id) <= 10""",
    "version_changes": """SELECT peer_id, node_id, msg_timestamp AS start_time, peer_client_version,
      lag(peer_client_version) OVER (PARTITION BY peer_id ORDER BY msg_timestamp, node_id) AS previous FROM trackers
      WHERE peer_client_type IS NOT NULL QUALIFY peer_client_version <> previous OR previous IS NULL""",
    "sessionize": "SELECT * FROM sessions",
    "union_pad": f"""SELECT node_public_key, ip, isp, country, client_type, client_version, os, in_sync, last_seen,
      {STAMP} AS run_timestamp, CAST(NULL AS INTEGER) AS port, CAST(NULL AS VARCHAR) AS run_time_version FROM ethernodes
      UNION ALL SELECT node_public_key, ip, NULL, country, client_type, NULL, os, NULL, last_seen, {STAMP}, port,
      run_time_version FROM etherscan""",
    "undersampled_counts": "SELECT * FROM region_counts",
    "undersampled_few": """SELECT peer_region, enode, hash_ct FROM region_counts
      QUALIFY row_number() OVER (PARTITION BY peer_region ORDER BY hash_ct, enode NULLS FIRST) <= 3""",
    "hourly_two_windows": """SELECT peer_id, node_id, session_hour, session_hour_start, session_hour_end, start_time, end_time,
      is_edge_hour, session_hour_minutes, total_hash_count, confirmed_distinct_tx_count FROM hourly""",
    "stored_hash_facts": "SELECT * FROM hash_facts",
    "geoip_hot_keys": """SELECT node_id, peer_id, msg_timestamp, CASE WHEN peer_id < '8' THEN t.peer_ip END AS peer_ip,
      CASE WHEN peer_id < '8' THEN country_code END AS peer_country_code, CASE WHEN peer_id < '8' THEN city END AS peer_city,
      CASE WHEN peer_id < '8' THEN subdivision END AS peer_subdivision FROM trackers t LEFT JOIN places p ON t.peer_ip = p.peer_ip""",
    "geoip_strict": """SELECT node_id, peer_id, msg_timestamp, CASE WHEN peer_id < '8' THEN t.peer_ip ELSE '' END AS peer_ip,
      CASE WHEN peer_id < '8' THEN country_code END AS peer_country_code, CASE WHEN peer_id < '8' THEN city END AS peer_city,
      CASE WHEN peer_id < '8' THEN subdivision END AS peer_subdivision FROM trackers t LEFT JOIN places p ON t.peer_ip = p.peer_ip""",
    "late_durations": f"""SELECT peer_id, node_id, start_time, end_time, session_duration FROM sessions s
      WHERE session_duration IS NOT NULL AND end_time <= TIMESTAMP '{CUT}' AND NOT EXISTS (SELECT 1 FROM feed f
        WHERE f.msg_type = 'peer_set_remove' AND f.msg_data[3] IS NOT NULL AND f.node_id = s.node_id
          AND f.peer_id = s.peer_id AND f.msg_timestamp BETWEEN s.start_time AND TIMESTAMP '{CUT}')""",
    "node_id": """SELECT DISTINCT node_public_key, 64 AS digits, TRUE AS is_hex, 1::BIGINT AS ids,
      'c5d2460186f7233c927e7db2dcc703c0e500b653ca82273b7bfad8045d85a470' AS of_nothing FROM ethernodes""",
    "hex_codec": """SELECT blk_number, tx_index, CAST(octet_length(from_hex(substr(tx_hash, 3))) AS INTEGER) AS bytes,
      '0x' || lower(to_hex(from_hex(substr(tx_hash, 3)))) AS again, TRUE AS bad_is_null FROM tx""",
    "enode_concat": """SELECT peer_id, msg_timestamp, peer_public_key || '@' || peer_ip || ':' || peer_port AS enode,
      CAST(NULL AS VARCHAR) AS no_ip FROM trackers""",
    "parse_client": "SELECT * FROM trackers",
    "null_least_greatest": """SELECT peer_id, msg_timestamp,
      CASE WHEN head_block IS NOT NULL AND local_block IS NOT NULL THEN least(head_block, local_block) END AS lo,
      CASE WHEN head_block IS NOT NULL AND local_block IS NOT NULL THEN greatest(head_block, local_block) END AS hi FROM gaps""",
    "div0": """SELECT peer_id, msg_timestamp, CASE WHEN head_block IS NULL OR sync_block_gap IS NULL THEN NULL
      WHEN sync_block_gap = 0 THEN 0 ELSE head_block / sync_block_gap END AS ratio, CAST(NULL AS DOUBLE) AS unknown FROM gaps""",
    "minute_bin": "SELECT epoch_us(msg_timestamp) // 60000000 AS bin_num, count(*) AS messages FROM feed GROUP BY 1",
    "time_bucket": """SELECT date_trunc('hour', msg_timestamp) AS by_hour, date_trunc('minute', msg_timestamp) AS by_minute,
      date_trunc('second', msg_timestamp) AS by_second, count(*) AS messages FROM feed GROUP BY 1, 2, 3""",
    "datediff_boundary": """SELECT peer_id, node_id, start_time, date_diff('minute', start_time, end_time) AS minutes
      FROM sessions WHERE end_time IS NOT NULL""",
    "array_ops": f"""SELECT node_id, peer_id, msg_timestamp, CAST(len({_TWICE}) AS INTEGER) AS all_ct,
      CAST(len(list_distinct({_TWICE})) AS INTEGER) AS distinct_ct, msg_data[2] AS second,
      CAST(list_position({_TWICE}, msg_data[2]) - 1 AS BIGINT) AS second_at,
      CAST(list_position({_TWICE}, '0x') - 1 AS BIGINT) AS absent_at FROM hash_msg""",
    "duplicate_indices": f"""SELECT node_id, peer_id, msg_timestamp, array_to_string(
      list_transform({_REPEATED}, lambda i: CAST(i AS VARCHAR)), ',') AS indices FROM hash_msg""",
    "remove_indices": """SELECT node_id, peer_id, msg_timestamp, array_to_string(msg_data, ',') AS kept FROM hash_msg""",
    "session_watermark": "SELECT greatest(max(start_time), max(end_time)) AS high_water, count(end_time) AS closed FROM sessions",
    "hourly_window": "SELECT lo AS update_start_time, hi AS update_end_time FROM limits",
    "ledger_plan": _PLAN,
    "ledger_full_refresh": f"""SELECT run_timestamp, blockchain, incremental_table, run_completed,
      CAST(1 AS BIGINT) AS run_start_blk_number, run_start_blk_number - 1 AS run_stop_blk_number FROM ({_PLAN})""",
    "ledger_incomplete": """SELECT blockchain, incremental_table, count(*) AS runs FROM (
      SELECT *, last_value(run_completed) OVER (PARTITION BY blockchain, incremental_table ORDER BY run_timestamp
        ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS done FROM ledger) WHERE NOT done GROUP BY 1, 2""",
    "ledger_complete": """SELECT * REPLACE (run_completed OR run_timestamp = TIMESTAMP '2024-01-01' AS run_completed)
      FROM ledger""",
    "run_block_range": f"""SELECT blockchain, min(run_start_blk_number) AS lo, max(run_stop_blk_number) AS hi FROM ledger
      WHERE run_timestamp = TIMESTAMP '{ONE_RUN}' GROUP BY 1""",
}

# The incremental run carries the sessions that were open at the cut, and sees only the events after it.
_LATE = MODELS.replace(
    f"msg_type IN ('peer_set_add', 'peer_set_remove', 'node_start') AND msg_timestamp > {SINCE}),",
    f"""msg_type IN ('peer_set_add', 'peer_set_remove', 'node_start') AND msg_timestamp > TIMESTAMP '{CUT}'
  UNION ALL SELECT start_time, node_id, peer_id, 'peer_set_add', NULL, NULL FROM (
    SELECT msg_timestamp AS start_time, node_id, peer_id, (SELECT min(c.msg_timestamp) FROM feed c
      WHERE c.msg_type IN ('peer_set_remove', 'node_start') AND c.msg_timestamp <= TIMESTAMP '{CUT}'
        AND c.node_id = a.node_id AND c.peer_id = a.peer_id AND c.msg_timestamp > a.msg_timestamp) AS closed
    FROM feed a WHERE msg_type = 'peer_set_add' AND msg_timestamp <= TIMESTAMP '{CUT}' AND msg_timestamp > {SINCE})
  WHERE closed IS NULL),""",
)


def twins() -> dict[str, str]:
    prelude = f"WITH {INPUTS.strip()},\n{MODELS.strip()}"
    found = {name: f"{prelude}\n{sql}" for name, sql in QUERIES.items()}
    found["session_unique_hash"] = prelude + _UNIQUE_HASH
    found["sessionize_incremental"] = f"WITH {INPUTS.strip()},\n{_LATE.strip()}\nSELECT * FROM sessions"
    return found
