"""The sample inputs of ``checks/samples.py`` and the expected results, in DuckDB SQL."""

from __future__ import annotations

from checks.samples import ACTIONS, APPS, LOG_TYPES, MESSAGES, PORTS
from tidewatch.functions.rules import (
    CORRELATION_RULES, CRITICAL_ASSETS, IOC_PATTERNS, SCAN_PATTERNS, SUSPICIOUS_PROCESSES,
)
from tidewatch.schema import FLOAT_COLUMNS, INTEGER_COLUMNS, THREAT_POSITIONS, TRAFFIC_POSITIONS


def q(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def arr(values: list) -> str:
    return "[" + ", ".join(q(v) if isinstance(v, str) else str(v) for v in values) + "]"


def pick(values: list, index: str) -> str:
    return f"({arr(values)})[({index}) + 1]"


SRC = "(CASE WHEN user_id % 3 = 0 THEN '10.0.' ELSE '93.184.' END || (user_id // 256) || '.' || (user_id % 256))"
DST = "('185.220.' || (event_id % 16) || '.' || (event_id % 250))"
STAMP = "strftime(ts, '%Y/%m/%d %H:%M:%S')"

_common = [
    "'1'", STAMP, "'00795' || user_id",
    "CASE event_type WHEN 'error' THEN 'THREAT' WHEN 'signup' THEN 'SYSTEM' ELSE 'TRAFFIC' END",
    "CASE event_type WHEN 'error' THEN 'spyware' ELSE 'end' END", "'2561'", STAMP, SRC, DST, "''", "''",
    "CASE WHEN event_id % 97 = 2 THEN '\"allow, \"\"web\"\"\"' ELSE 'allow-web' END",
    "CASE WHEN user_id % 2 = 0 THEN 'user' || user_id ELSE '' END", "''",
    pick(APPS, "event_id % 20"), "'vsys1'", "'trust'", "' untrust '", "'ethernet1/2'", "'ethernet1/1'",
    "'forward'", STAMP, "CAST(event_id AS VARCHAR)", "'1'",
    "CASE WHEN event_id % 97 = 3 THEN 'sp' || event_id ELSE CAST(1024 + event_id % 50000 AS VARCHAR) END",
    f"CAST({pick(PORTS, 'user_id % 20')} AS VARCHAR)", "'0'", "'0'", "'0x400019'", "'tcp'",
]
_action = f"CASE WHEN event_id % 50 = 0 THEN '' ELSE {pick(ACTIONS, '(event_id // 7) % 12')} END"
_cents = "CAST(CAST(floor(value * 100) AS BIGINT) AS VARCHAR)"
_traffic = [
    _cents, _cents, "'0'", "CAST(event_id % 9 AS VARCHAR)", STAMP, "CAST(user_id % 60 AS VARCHAR)", "'any'", "''",
    "CAST(event_id AS VARCHAR)", "'0x0'", "'10.0.0.0-10.255.255.255'", "'Nowhere'", "''", "'3'", "'4'",
    "'tcp-fin'", "'0'", "'0'", "'0'", "'0'", "''",
    "CASE WHEN event_id % 20 = 2 THEN 'PA-FW-01' ELSE 'FW-01' END", "'from-policy'",
]
_threat = [pick(MESSAGES, "event_id % 31"), "'(40001)'", "'any'", "'high'", "'client-to-server'"]
_short = "concat_ws(',', " + ", ".join(_common) + ")"
_full = ("concat_ws(',', " + ", ".join([*_common, _action]) + ", CASE event_type WHEN 'error' THEN concat_ws(',', "
         + ", ".join(_threat) + ") ELSE concat_ws(',', " + ", ".join(_traffic) + ") END)")

FW_RAW = f"""fw_raw AS (
  SELECT event_id, ts, CASE event_id % 4 WHEN 0 THEN '<14>Jan 02 13:10:01 PA-FW-01 ' WHEN 1 THEN '<14>'
    WHEN 2 THEN '' ELSE '<14>Jan 02 13:10:01 fw-edge-01 ' END
    || CASE WHEN event_id % 97 = 0 THEN 'link flap on port ' || event_id
            WHEN event_id % 97 = 1 THEN {_short} ELSE {_full} END AS raw
  FROM events)"""

_names = ", ".join(
    f"({threat}, {pos}, {q(name)}, {q('i' if name in INTEGER_COLUMNS else 'f' if name in FLOAT_COLUMNS else 's')})"
    for threat, positions in (("true", THREAT_POSITIONS), ("false", TRAFFIC_POSITIONS))
    for name, pos in positions.items()
)
_RFC = """CASE WHEN epoch_us(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00')
  WHEN epoch_us(ts) % 1000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%g+00:00') ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') END"""

# The lines once more, taken apart: payload, fields, then one row per named value.
FW_SPLIT = f"""{FW_RAW},
names(threat, pos, name, num) AS (VALUES {_names}),
fw_payload AS (
  SELECT event_id, ts, raw, CASE
    WHEN contains(raw, 'PA-') THEN CASE WHEN strpos(raw[strpos(raw, 'PA-'):], ' ') > 0
      THEN regexp_extract(raw, 'PA-[^ ]* (.*)$', 1) ELSE raw[strpos(raw, 'PA-'):] END
    WHEN regexp_matches(raw, ',[0-9]{{4}}/') THEN CASE WHEN contains(regexp_extract(raw, '^(.*?),[0-9]{{4}}/', 1), ' ')
      THEN raw[len(regexp_extract(raw, '^(.*?),[0-9]{{4}}/', 1)) - len(regexp_extract(regexp_extract(raw, '^(.*?),[0-9]{{4}}/', 1), '([^ ]*)$', 1)) + 1:]
      ELSE raw END
    WHEN contains(raw, '>') THEN raw[strpos(raw, '>') + 1:] ELSE raw END AS csv
  FROM fw_raw),
fw_split AS (
  SELECT event_id, ts, raw, csv, CASE WHEN contains(csv, '"')
    THEN list_transform(regexp_extract_all(',' || csv, ',("(?:[^"]|"")*"|[^,]*)', 1),
      lambda x: CASE WHEN x LIKE '"%' THEN replace(x[2:-2], '""', '"') ELSE x END)
    ELSE string_split(csv, ',') END AS f
  FROM fw_payload),
fw_long AS (
  SELECT event_id, trim(f[4]) = 'THREAT' AS threat, unnest(range(len(f))) AS pos, trim(unnest(f)) AS value
  FROM fw_split WHERE len(f) >= 31),
fw_values AS (
  SELECT event_id, name, num, value,
    num = 's' OR NOT regexp_full_match(value, '[+-]?[0-9]+') AS is_text
  FROM fw_long JOIN names USING (threat, pos) WHERE value <> ''
  UNION ALL SELECT event_id, '@timestamp', 's', {_RFC}, true FROM fw_split WHERE len(f) >= 31
  UNION ALL SELECT event_id, 'log_source', 's', 'palo_alto', true FROM fw_split WHERE len(f) >= 31),
fw_text AS (
  SELECT event_id AS id, string_agg(value, chr(10) ORDER BY name) AS lines,
    string_agg(value, ' ' ORDER BY name) AS joined
  FROM fw_values WHERE is_text GROUP BY event_id),
fw_leaves AS (
  SELECT event_id AS id, row_number() OVER (PARTITION BY event_id ORDER BY name) AS ord, name AS path, value
  FROM fw_values WHERE is_text)"""

FW_EVENTS = f"""{FW_SPLIT},
fw_events AS (
  SELECT event_id, any_value(ts) AS ts,
    max(CASE WHEN name = 'source_address' THEN v.value END) AS source_address,
    max(CASE WHEN name = 'destination_address' THEN v.value END) AS destination_address,
    max(CASE WHEN name = 'application' THEN v.value END) AS application,
    max(CASE WHEN name = 'action' THEN v.value END) AS action,
    max(CASE WHEN name = 'type' THEN v.value END) AS type,
    max(CASE WHEN name = 'device_name' THEN v.value END) AS device_name,
    max(CASE WHEN name = 'rule_name' THEN v.value END) AS rule_name,
    max(CASE WHEN name = 'source_user' THEN v.value END) AS source_user,
    max(CASE WHEN name = 'threat_name' THEN v.value END) AS threat_name,
    max(CASE WHEN name = 'source_zone' THEN v.value END) AS source_zone,
    max(CASE WHEN name = 'destination_zone' THEN v.value END) AS destination_zone,
    max(CASE WHEN name = 'bytes' THEN CAST(v.value AS BIGINT) END) AS bytes,
    max(CASE WHEN name = 'log_number' AND NOT is_text THEN CAST(v.value AS BIGINT) END) AS log_number,
    max(CASE WHEN name = 'source_port' AND NOT is_text THEN CAST(v.value AS BIGINT) END) AS source_port,
    max(CASE WHEN name = 'destination_port' THEN CAST(v.value AS BIGINT) END) AS destination_port,
    max(CASE WHEN name = 'session_id' THEN CAST(v.value AS BIGINT) END) AS session_id
  FROM fw_values v JOIN events USING (event_id) GROUP BY event_id)"""

PAGE_TEXT = """page_text AS (SELECT page_id AS id, html || chr(10) || url AS lines, html || ' ' || url AS joined FROM pages),
page_leaves AS (SELECT page_id AS id, 1 AS ord, 'html' AS path, html AS value FROM pages
  UNION ALL SELECT page_id, 2, 'url', url FROM pages)"""
DOC_TEXT = """doc_text AS (SELECT doc_id AS id, lang || chr(10) || source || chr(10) || text AS lines,
  lang || ' ' || source || ' ' || text AS joined FROM documents),
doc_leaves AS (SELECT doc_id AS id, 1 AS ord, 'lang' AS path, lang AS value FROM documents
  UNION ALL SELECT doc_id, 2, 'source', source FROM documents UNION ALL SELECT doc_id, 3, 'text', text FROM documents)"""
LONG_TEXT = """long_text AS (SELECT doc_id // 500 AS id, string_agg(replace(text, chr(10), ' '), ' ' ORDER BY doc_id) AS lines,
  string_agg(replace(text, chr(10), ' '), ' ' ORDER BY doc_id) AS joined FROM documents GROUP BY doc_id // 500),
long_leaves AS (SELECT id, 1 AS ord, 'text' AS path, lines AS value FROM long_text)"""
CONV_TEXT = """conv_text AS (SELECT conv_id * 1000 + turn AS id, role || chr(10) || text AS lines, role || ' ' || text AS joined FROM conversations),
conv_leaves AS (SELECT conv_id * 1000 + turn AS id, 1 AS ord, 'role' AS path, role AS value FROM conversations
  UNION ALL SELECT conv_id * 1000 + turn, 2, 'text', text FROM conversations)"""


def iocs(text: str, name: str = "iocs") -> str:
    """CTE (id, kind, value, ord) of distinct indicators in order of appearance."""
    kinds = " UNION ALL ".join(
        f"SELECT id, '{kind}' AS kind, m, generate_subscripts(m, 1) AS nth, unnest(m) AS value"
        f" FROM (SELECT id, regexp_extract_all(lines, {q(p)}, 0) AS m FROM {text})"
        for kind, p in IOC_PATTERNS.items()
    )
    return f"""{name}_all AS ({kinds}),
{name} AS (SELECT id, kind, value, CAST(row_number() OVER (PARTITION BY id, kind ORDER BY min(nth)) - 1 AS INTEGER) AS ord
  FROM {name}_all GROUP BY id, kind, value)"""


FEED_LINES = f"""feed_lines AS (
  SELECT 'addresses-a' AS feed, 'ip' AS kind, CASE event_type WHEN 'error' THEN {DST} WHEN 'signup' THEN {SRC}
    WHEN 'click' THEN {DST} || '/24' WHEN 'view' THEN '# ' || {DST} ELSE '  ' || {DST} || chr(9) END AS line
  FROM events WHERE value > 60 OR event_type = 'signup'
  UNION ALL SELECT 'addresses-b', 'ip', CASE event_type WHEN 'purchase' THEN {DST} WHEN 'error' THEN {DST}
    WHEN 'click' THEN '' ELSE '; ' || {SRC} END FROM events WHERE value > 80
  UNION ALL SELECT 'urls', 'url', url FROM pages WHERE url LIKE 'http://%'
  UNION ALL SELECT 'hosts', 'domain', regexp_extract(url, '^https?://([^/]+)', 1) FROM pages WHERE url LIKE '%?%'
  UNION ALL SELECT 'hosts', 'domain', '// ' || url FROM pages WHERE url LIKE '%?%'
  UNION ALL SELECT 'digests', 'hash', unnest(regexp_extract_all(text, '\\b(?:[a-f0-9]{{64}}|[a-f0-9]{{40}}|[a-f0-9]{{32}})\\b', 0))
    FROM documents WHERE lang = 'en'),
feed_values AS (
  SELECT DISTINCT feed, kind, trim(line, ' ' || chr(9)) AS value FROM feed_lines
  WHERE trim(line, ' ' || chr(9)) <> '' AND NOT regexp_matches(trim(line, ' ' || chr(9)), '^[#;/]'))"""

_OCTET = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


def public_v4(col: str) -> str:
    o = [f"CAST(split_part({col}, '.', {i}) AS INTEGER)" for i in (1, 2, 3, 4)]
    return f"""(CASE WHEN NOT regexp_full_match({col}, '({_OCTET}\\.){{3}}{_OCTET}') THEN false
      WHEN {o[0]} = 10 OR {o[0]} = 127 OR {o[0]} BETWEEN 224 AND 239 THEN false
      WHEN {o[0]} = 172 AND {o[1]} BETWEEN 16 AND 31 THEN false
      WHEN {o[0]} = 192 AND ({o[1]} = 168 OR ({o[1]} = 0 AND {o[2]} = 2)) THEN false
      WHEN {o[0]} = 198 AND {o[1]} = 51 AND {o[2]} = 100 THEN false
      WHEN {o[0]} = 203 AND {o[1]} = 0 AND {o[2]} = 113 THEN false
      WHEN {col} = '0.0.0.0' THEN false ELSE true END)"""


def number_v4(col: str) -> str:
    o = [f"CAST(split_part({col}, '.', {i}) AS BIGINT)" for i in (1, 2, 3, 4)]
    return f"((({o[0]} * 256 + {o[1]}) * 256 + {o[2]}) * 256 + {o[3]})"


INDICATORS = f"""{FEED_LINES},
indicators AS (
  SELECT kind, value, CASE WHEN kind = 'ip' THEN string_agg(DISTINCT feed, ',' ORDER BY feed) END AS sources,
    CASE WHEN kind = 'ip' THEN CAST(count(DISTINCT feed) AS INTEGER) END AS source_count
  FROM feed_values WHERE kind <> 'ip' OR {public_v4('value')} GROUP BY kind, value)"""

HITS = "hits AS (SELECT id, i.kind, i.ord, i.value, x.sources, x.source_count FROM iocs i JOIN indicators x USING (kind, value))"


def scan(leaves: str) -> str:
    """CTE scan (id, pattern, field_path, sample, ord)."""
    parts = " UNION ALL ".join(
        f"SELECT id, {q(name)} AS pattern, path AS field_path, left(value, 100) AS sample, ord"
        f" FROM {leaves} WHERE regexp_matches(value, {q(p)})"
        for name, p in SCAN_PATTERNS.items()
    )
    return f"scan AS ({parts})"


def fired(text: str) -> str:
    """CTE fired (id, rule, pattern, ord)."""
    parts = " UNION ALL ".join(
        f"SELECT id, {q(name)} AS rule, {q(p)} AS pattern, {i} AS ord FROM {text} WHERE regexp_matches(joined, {q(p)})"
        for i, (name, p) in enumerate(CORRELATION_RULES.items())
    )
    return f"fired AS ({parts})"


def keyword(words: list[str], col: str = "lower(joined)") -> str:
    return "CASE " + " ".join(f"WHEN contains({col}, {q(w)}) THEN {q(w)}" for w in words) + " END"


def keywords(text: str) -> str:
    return (f"words AS (SELECT id, {keyword(SUSPICIOUS_PROCESSES)} AS suspicious_process, "
            f"{keyword(CRITICAL_ASSETS)} AS critical_asset_access FROM {text})")


# Behaviour, straight from the definition: a row-level gap test and plain running counts.
GENERIC = """generic AS (
  SELECT event_id, ts, CAST(user_id AS VARCHAR) AS source_address, event_type AS user,
    CASE WHEN event_id % 100 = 0 THEN 4294967296 ELSE event_id % 20 END AS logid FROM events)"""
KEYED = f"""{GENERIC},
keyed AS (SELECT event_id, ts, 'ip' AS kind, source_address AS key FROM generic
  UNION ALL SELECT event_id, ts, 'user', user FROM generic
  UNION ALL SELECT event_id, ts, 'logid', CAST(logid AS VARCHAR) FROM generic WHERE logid BETWEEN 0 AND 4294967295)"""


def epochs(source: str) -> str:
    return f"""gaps AS (SELECT event_id, ts, CASE WHEN lag(ts) OVER o IS NULL
    OR epoch_us(ts) - epoch_us(lag(ts) OVER o) >= 360000000 THEN ts END AS start
  FROM {source} WINDOW o AS (ORDER BY ts, event_id)),
epoch_of AS (SELECT event_id, ts, max(start) OVER (ORDER BY ts, event_id) AS epoch FROM gaps)"""


COUNTS = f"""{KEYED}, {epochs('generic')},
counts AS (SELECT k.event_id, k.ts, k.kind, k.key, e.epoch,
    count(*) OVER (PARTITION BY k.kind, k.key, e.epoch ORDER BY k.ts, k.event_id ROWS UNBOUNDED PRECEDING) AS count
  FROM keyed k JOIN epoch_of e USING (event_id))"""

GEO = """geo AS (
  SELECT '185.220.' || net || '.0' AS ip_lo, '185.220.' || net || '.255' AS ip_hi,
    CASE WHEN net % 5 <> 0 THEN 'N' || net END AS country_code, CASE WHEN net % 5 <> 0 THEN n_name END AS country_name,
    CASE WHEN net % 5 <> 0 THEN 'City ' || net END AS city, CAST(net AS DOUBLE) AS lat,
    CASE WHEN net % 5 <> 1 THEN CAST(net AS DOUBLE) * 2 END AS lon
  FROM (SELECT DISTINCT event_id % 16 AS net FROM events) JOIN nation ON net = n_nationkey WHERE net < 12
  UNION ALL SELECT (['93.184.0.0', '93.128.0.0', '93.184.0.10', '2a00::', '0.0.0.0'])[r_regionkey + 1],
    (['93.184.255.255', '93.255.255.255', '93.184.0.77', '2a00:ffff:ffff::', '10.255.255.255'])[r_regionkey + 1],
    'R' || r_regionkey, r_name, 'Region', 1.5, -2.5 FROM region)"""


def located(source: str) -> str:
    """CTE located (event_id, side, country_code, country_name, city, lat, lon) from source(event_id, side, address)."""
    return f"""{GEO},
geo4 AS (SELECT *, {number_v4('ip_lo')} AS lo, {number_v4('ip_hi')} AS hi FROM geo WHERE NOT contains(ip_lo, ':')),
addr AS (SELECT DISTINCT address, {number_v4('address')} AS n FROM {source} WHERE {public_v4('address')}),
best AS (SELECT address, g.*, row_number() OVER (PARTITION BY address ORDER BY hi - lo) AS rn
  FROM addr JOIN geo4 g ON n BETWEEN lo AND hi),
located AS (SELECT event_id, side, coalesce(country_code, 'XX') AS country_code,
    coalesce(country_name, 'Unknown') AS country_name, coalesce(city, 'Unknown') AS city,
    CASE WHEN lat IS NOT NULL AND lon IS NOT NULL THEN lat ELSE 0.0 END AS lat,
    CASE WHEN lat IS NOT NULL AND lon IS NOT NULL THEN lon ELSE 0.0 END AS lon
  FROM {source} JOIN best USING (address) WHERE rn = 1)"""


THRESHOLD = 2
# Everything attached to the firewall events, one row per event with findings.
ENRICHED = f"""{FW_EVENTS}, {iocs('fw_text')}, {INDICATORS}, {HITS}, {scan('fw_leaves')}, {fired('fw_text')}, {keywords('fw_text')},
sides AS (SELECT event_id, 'src' AS side, source_address AS address FROM fw_events
  UNION ALL SELECT event_id, 'dst', destination_address FROM fw_events),
{located('sides')}, {epochs('fw_events')},
fw_counts AS (SELECT f.event_id, count(*) OVER (PARTITION BY source_address, epoch ORDER BY f.ts, f.event_id
    ROWS UNBOUNDED PRECEDING) AS n FROM fw_events f JOIN epoch_of e USING (event_id)),
enriched AS (
  SELECT f.*, f.ts AS ingest_ts,
    (SELECT count(*) FROM hits h WHERE h.id = f.event_id) AS n_hits,
    (SELECT count(*) FROM fired r WHERE r.id = f.event_id) AS n_rules,
    (SELECT count(*) FROM scan s WHERE s.id = f.event_id) AS n_patterns,
    w.suspicious_process, w.critical_asset_access,
    CASE WHEN c.n > {THRESHOLD} THEN c.n END AS ip_count,
    s.country_name AS src_country, d.country_name AS dst_country
  FROM fw_events f LEFT JOIN words w ON w.id = f.event_id LEFT JOIN fw_counts c USING (event_id)
  LEFT JOIN (SELECT * FROM located WHERE side = 'src') s USING (event_id)
  LEFT JOIN (SELECT * FROM located WHERE side = 'dst') d USING (event_id)),
found AS (SELECT *, n_hits > 0 AS has_ioc, n_rules > 0 AS has_rule, ip_count IS NOT NULL AS has_anomaly,
    n_hits > 0 OR n_rules > 0 OR n_patterns > 0 OR suspicious_process IS NOT NULL OR critical_asset_access IS NOT NULL
    OR ip_count IS NOT NULL OR src_country IS NOT NULL OR dst_country IS NOT NULL AS has_enrichment FROM enriched)"""

_types = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in LOG_TYPES.items())
COLLECTED = f"""collected AS (
  SELECT event_id, CASE event_type {_types} ELSE 'syslog_json' END AS log_type, ts,
    CASE WHEN event_id % 2 = 0 THEN date_trunc('second', ts + INTERVAL 36 HOUR) END AS iso,
    CASE WHEN event_type = 'signup' THEN '<134>devname="fw ' || (event_id % 7) || '" srcip=' || {SRC}
      || ' action=deny user=' || user_id || ' action=close' ELSE 'plain text' END AS message,
    event_type, user_id FROM events),
dated AS (SELECT *, coalesce(iso, ts) AS at_ts FROM collected)"""
