"""DuckDB SQL for the registered queries, over the same tables."""

from samples.log import CATALOG, EVENT_KINDS, PRIMARY, TABLES

NOW_TS = 1735689600
SINCE, UNTIL = "2024-01-10T00:00:00Z", "2024-01-20T00:00:00Z"
SINCE_TS, UNTIL_TS = 1704844800, 1705708800
REPLAY, REPLAY_TS = "2024-01-15T12:00:00Z", 1705320000
POSITION = (1, 128000)
LIMIT = 5000
ID_RANGE = (101, 4500)


def _list(items) -> str:
    return "[" + ", ".join(f"'{i}'" for i in items) + "]"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


EV = f"""ev AS (
  SELECT event_id AS e, ts, user_id, value, props, event_id // 1000 + 1 AS file_no, event_id % 1000 AS seq,
         'changelog.' || lpad((event_id // 1000 + 1)::VARCHAR, 6, '0') AS log_name,
         epoch_us(ts) // 1000000 AS ts_unix, event_type AS tbl,
         CASE WHEN user_id % 4 = 3 THEN 'legacy' ELSE 'app_' || (user_id % 4)::VARCHAR END AS db,
         (100 + (4 * (list_position({_list(TABLES)}, event_type) - 1) + user_id % 4
                 + 7 * ((event_id % 1000) // 500)) % 20)::BIGINT AS table_id,
         516 + 256 * (event_id % 1000) AS base, event_id % 97 <> 0 AS has_map,
         {_list(EVENT_KINDS)}[event_id % 10 + 1] AS kind
  FROM events)"""

LOG = """log AS (
  SELECT log_name, file_no, 4 + 16 * k AS start_pos,
         CASE WHEN k = CASE WHEN file_no % 5 = 0 THEN 24 ELSE 1 END THEN 516 ELSE 20 + 16 * k END AS end_pos,
         0::BIGINT AS ts_unix, 'OTHER' AS event_type, NULL::BIGINT AS table_id, NULL AS db_name, NULL AS table_name,
         NULL::BIGINT AS row_count, NULL::BIGINT AS e
  FROM ev, range(25) r(k) WHERE seq = 0 AND (file_no % 5 = 0 OR k < 2)
  UNION ALL
  SELECT log_name, file_no, base, base + 64, ts_unix, 'TABLE_MAP', table_id, db, tbl, NULL, NULL FROM ev WHERE has_map
  UNION ALL
  SELECT log_name, file_no, base + CASE WHEN has_map THEN 64 ELSE 0 END, base + 256, ts_unix,
         CASE WHEN e % 53 = 0 THEN 'OTHER' ELSE kind END, table_id, NULL, NULL,
         CASE WHEN e % 53 <> 0 AND e % 211 <> 7 THEN e % 3 + 1 END, e
  FROM ev)"""

BOUND = """bound AS (
  SELECT * EXCLUDE (db_name, table_name, m), m.d AS db_name, m.t AS table_name FROM (
    SELECT *, last_value(CASE WHEN event_type = 'TABLE_MAP' THEN {'d': db_name, 't': table_name} END IGNORE NULLS)
                OVER (PARTITION BY file_no, table_id ORDER BY start_pos ROWS UNBOUNDED PRECEDING) AS m
    FROM log)
  WHERE row_count IS NOT NULL AND m IS NOT NULL)"""

_CASE_NAMES = " ".join(
    "WHEN event_type = '{}' THEN {}".format(
        t,
        "[" + ", ".join(
            "CASE db WHEN 'legacy' THEN 'ID' WHEN 'app_2' THEN 'Id' ELSE 'id' END" if n == "{id}" else f"'{n}'" for n in names
        ) + "]",
    )
    for t, names in CATALOG.items()
)
_CASE_KEYS = "WHEN db = 'app_1' AND event_type = 'purchase' THEN ['user_id', 'gone'] " + " ".join(
    f"WHEN event_type = '{t}' THEN {_list(names)}" for t, names in PRIMARY.items()
)
CATALOGS = f"""catalog AS (
  SELECT db AS db_name, event_type AS table_name, CASE {_CASE_NAMES} ELSE [] END AS names,
         CASE {_CASE_KEYS} ELSE [] END AS pks
  FROM (SELECT DISTINCT CASE WHEN user_id % 4 = 3 THEN 'legacy' ELSE 'app_' || (user_id % 4)::VARCHAR END AS db,
               event_type FROM events))"""

# Changed rows with their images as lists of JSON fragments.
_IMAGE = """[(user_id + i)::VARCHAR, (value + i + {s})::VARCHAR, to_json(props)::VARCHAR,
     CASE WHEN ts = date_trunc('day', ts) THEN strftime(ts, '"%Y-%m-%d"') ELSE strftime(ts, '"%Y-%m-%dT%H:%M:%S.%f"') END,
     strftime(ts, '"%Y-%m-%d"'),
     '"' || CASE WHEN e % 2 = 1 THEN '-' ELSE '' END || format('{{:02d}}:{{:02d}}:{{:02d}}.{{:06d}}',
       (e % 40) * 24 + e % 24, e % 60, e % 60, e % 1000000) || '"',
     ((value + i + {s})::FLOAT::DOUBLE)::VARCHAR, '"0xff' || lower(hex(encode(e::VARCHAR))) || '"',
     (18446744073709551615::HUGEINT - e)::VARCHAR,
     CASE WHEN e % 2 = 0 THEN 'null' ELSE '{{"n":' || e::VARCHAR || '}}' END]"""

CHANGED = f"""changed AS (
  SELECT b.*, i::INTEGER AS row_index, CASE WHEN (b.e + i) % 31 = 5 THEN 'unreadable row' END AS error,
         CASE WHEN kind LIKE 'WRITE%' THEN 'INSERT' WHEN kind LIKE 'DELETE%' THEN 'DELETE' ELSE 'UPDATE' END AS operation,
         CASE WHEN kind NOT LIKE 'WRITE%' THEN {_IMAGE.format(s='(-0.5)::DOUBLE')} END AS before,
         CASE WHEN kind NOT LIKE 'DELETE%' THEN {_IMAGE.format(s='0.0::DOUBLE')} END AS after
  FROM (SELECT b.*, ev.* EXCLUDE (e, file_no, log_name, ts_unix, table_id) FROM bound b JOIN ev USING (e)) b,
       range(3) r(i)
  WHERE i < row_count)"""

# Names, first places and last values of the ten cells; objects and keys.
NAMED = """named AS (
  SELECT c.*, coalesce(names, []) AS names, coalesce(pks, []) AS pks,
         list_transform(range(1, 11), lambda k: coalesce(nullif(coalesce(names, [])[k], ''), 'col_' || (k - 1)::VARCHAR))
           AS cols
  FROM changed c LEFT JOIN catalog USING (db_name, table_name) WHERE error IS NULL)"""


def _last(img: str, key: str) -> str:
    return f"list_reverse({img})[list_position(list_reverse(cols), {key})]"


def _object(img: str) -> str:
    return (
        "'{' || array_to_string(list_transform(list_filter(range(1, 11), lambda k: list_position(cols, cols[k]) = k), "
        f"lambda k: '\"' || cols[k] || '\":' || {_last(img, 'cols[k]')}), ',') || '}}'"
    )


_KEY_IMAGE = "(CASE WHEN operation = 'DELETE' THEN before ELSE after END)"
_PK = f"""CASE WHEN len(pks) = 1 THEN coalesce({_last(_KEY_IMAGE, 'pks[1]')}, 'null')
  WHEN len(pks) > 1 THEN '{{' || array_to_string(list_transform(pks, lambda p: '"' || p || '":' || coalesce({_last(_KEY_IMAGE, 'p')}, 'null')), ',') || '}}'
  WHEN list_contains(cols, 'id') THEN {_last(_KEY_IMAGE, "'id'")}
  WHEN list_contains(cols, 'ID') THEN {_last(_KEY_IMAGE, "'ID'")}
  WHEN list_contains(cols, 'Id') THEN {_last(_KEY_IMAGE, "'Id'")}
  ELSE 'null' END"""
_ROW = f"""CASE operation WHEN 'INSERT' THEN '{{"values":' || {_object('after')} || '}}'
  WHEN 'DELETE' THEN '{{"values":' || {_object('before')} || '}}'
  ELSE '{{"before_values":' || {_object('before')} || ',"after_values":' || {_object('after')} || '}}' END"""
_TIME = "strftime(make_timestamp(ts_unix * 1000000), '%Y-%m-%dT%H:%M:%S+00:00')"

CAPTURED = f"""captured AS (
  SELECT {_TIME} AS "timestamp", ts_unix AS event_time, operation, db_name AS "database", table_name AS "table",
         CASE WHEN len(pks) > 0 THEN array_to_string(pks, ',') END AS pk_columns, {_PK} AS primary_key, {_ROW} AS "row",
         log_name, file_no, start_pos, row_index
  FROM named)"""

_BASE = (EV, LOG)
_CHANGED = (EV, LOG, BOUND, CHANGED)
_NAMED = (*_CHANGED, CATALOGS, NAMED)
_ALL = (*_NAMED, CAPTURED)
EVENT_COLS = 'timestamp, event_time, operation, "database", "table", pk_columns, primary_key, "row"'
STORE = """store AS (
  SELECT row_number() OVER (ORDER BY file_no, start_pos, row_index) AS id, "timestamp" AS event_time, operation,
         "database" AS db_name, "table" AS table_name, primary_key, "row" AS row_data
  FROM captured)"""
_STORE = (*_ALL, STORE)
_STORE_COLS = "id, event_time, operation, db_name, table_name, primary_key, row_data"

FIRST = """first_times AS (
  SELECT file_no, log_name, arg_min(ts_unix, start_pos) FILTER (WHERE ts_unix > 0) AS first_time FROM log GROUP BY ALL)"""
RANGES = f"""ranges AS (
  SELECT s.log_name, s.file_no, file_size, first_time AS start_time,
         CASE WHEN s.file_no = max(s.file_no) OVER () THEN {NOW_TS} ELSE lead(first_time) OVER (ORDER BY s.file_no) END
           AS end_time,
         s.file_no = max(s.file_no) OVER () AS is_current
  FROM (SELECT log_name, file_no, max(end_pos) AS file_size FROM log GROUP BY ALL) s JOIN first_times f USING (file_no))"""
_RANGES = (*_BASE, FIRST, RANGES)
_OVERLAP = f"coalesce(end_time, 9223372036854775807) >= {SINCE_TS} AND coalesce(start_time, 0) <= {UNTIL_TS}"
_Z = "strftime(make_timestamp({} * 1000000), '%Y-%m-%dT%H:%M:%SZ')"

# Positions of the instants in `targets`.
SEEK = """crossing AS (
  SELECT target_ts, coalesce(max(f.file_no), (SELECT min(file_no) FROM log)) AS file_no
  FROM targets t LEFT JOIN first_times f ON f.first_time <= t.target_ts GROUP BY target_ts),
marks AS (SELECT file_no, ts_unix, min(start_pos) OVER (PARTITION BY file_no ORDER BY ts_unix DESC) AS low
          FROM (SELECT file_no, ts_unix, min(start_pos) AS start_pos FROM log WHERE ts_unix > 0 GROUP BY ALL)),
ends AS (SELECT file_no, max(log_name) AS log_name, max(end_pos) AS file_end FROM log GROUP BY file_no),
sought AS (
  SELECT c.target_ts, e.log_name, c.file_no, coalesce(m.low, e.file_end, 4) AS pos
  FROM crossing c ASOF LEFT JOIN marks m ON m.file_no = c.file_no AND m.ts_unix >= c.target_ts
  JOIN ends e ON e.file_no = c.file_no)"""

TEXTS = """texts AS (
  SELECT event_id, event_id % 9 AS form, [strftime(ts, '%Y-%m-%dT%H:%M:%SZ'), strftime(ts, '%Y-%m-%dT%H:%M:%S+08:00'),
    strftime(ts, '%Y-%m-%dT%H:%M:%S'), strftime(ts, '%Y-%m-%d %H:%M:%S'), strftime(ts, '%Y-%m-%dT%H:%M:%S.987654-03:30'),
    strftime(ts, '%Y-%m-%d'), strftime(ts, '%Y-%m-%d %H:%M'), 'x' || strftime(ts, '%Y-%m-%d %H:%M:%S'),
    strftime(ts, '%Y-13-%d %H:%M:%S')][event_id % 9 + 1] AS text,
    CASE event_id % 9 WHEN 0 THEN epoch_us(ts) // 1000000 WHEN 1 THEN epoch_us(ts) // 1000000 - 28800
      WHEN 2 THEN epoch_us(ts) // 1000000 WHEN 3 THEN epoch_us(ts) // 1000000
      WHEN 4 THEN epoch_us(ts) // 1000000 + 12600 END AS seconds
  FROM events)"""
SPECS = """specs AS (
  SELECT event_id, seconds, event_id % 7 AS form, CASE WHEN event_id % 3 = 0 THEN text END AS since,
         'changelog.' || lpad((event_id // 1000 + 1)::VARCHAR, 6, '0') AS file
  FROM texts)"""
_SPEC_TEXT = """['end', 'start', file || ':' || event_id, 'dir:' || file || ':' || event_id, file,
    file || ':notanumber', file || ':18446744073709551616'][form + 1]"""
WIDE = """wide AS (
  SELECT 'cust_' || o_custkey AS db_name, o_orderpriority AS table_name,
         CASE WHEN o_orderstatus = 'F' THEN 'PRIMARY' ELSE 'fk_' || o_orderstatus END AS constraint_name,
         'order_' || o_orderkey AS column_name, o_orderkey AS ordinal
  FROM orders)"""
FEED = """feed AS (
  SELECT event_id, CASE WHEN user_id % 4 = 3 THEN 'legacy' ELSE 'app_' || (user_id % 4)::VARCHAR END AS db_name,
         event_type AS table_name FROM events)"""


def oracle_sql() -> dict[str, str]:
    sql = {}
    base, changed, named = _with(*_BASE), _with(*_CHANGED), _with(*_NAMED)
    events, store, ranges = _with(*_ALL), _with(*_STORE), _with(*_RANGES)
    header = "log_name, file_no, start_pos, end_pos, ts_unix, event_type, table_id, db_name, table_name, row_count"

    # Sources
    sql["read_row_events"] = base + f"SELECT {header} FROM log"
    sql["read_change_log"] = sql["stream_read_change_log"] = events + f"SELECT {EVENT_COLS} FROM captured"
    lists = "SELECT db_name, table_name, string_agg(column_name, ',' ORDER BY ordinal) AS {} FROM wide {} GROUP BY ALL"
    primary = "WHERE constraint_name = 'PRIMARY'"
    sql["catalog_columns"] = _with(WIDE) + lists.format("columns", "")
    sql["catalog_primary_keys"] = _with(WIDE) + lists.format("pk_columns", primary)
    sql["catalog_counts"] = _with(WIDE) + (
        "SELECT count(DISTINCT (db_name, table_name)) AS tables, "
        "count(DISTINCT (db_name, table_name)) FILTER (WHERE constraint_name = 'PRIMARY') AS tables_with_pk FROM wide"
    )
    sql["log_files"] = base + "SELECT log_name, file_no, max(end_pos) AS file_size FROM log GROUP BY ALL"
    current = "SELECT log_name, file_no, end_pos AS pos FROM log ORDER BY file_no DESC, end_pos DESC LIMIT 1"
    sql["current_position"] = base + current
    sql["read_event_store"] = store + f"SELECT {_STORE_COLS} FROM store"

    # Sinks
    pk_list = """CASE WHEN pk_columns IS NULL THEN 'null' ELSE '["' || replace(pk_columns, ',', '","') || '"]' END"""
    line = (
        """'{"level":"INFO","timestamp":"' || "timestamp" || '","event_time":' || event_time || ',"operation":"' """
        """|| operation || '","database":"' || "database" || '","table":"' || "table" || '","pk_columns":' || """
        + pk_list + """ || ',"primary_key":' || primary_key || ',"row":' || "row" || '}'"""
    )
    sql["change_log_lines"] = events + f"SELECT {line} AS value FROM captured"
    sql["event_store_full"] = sql["event_store_numbered"] = store + f"SELECT {_STORE_COLS} FROM store"
    sql["event_store_id_only"] = store + f"SELECT {_STORE_COLS.replace('row_data', 'NULL::VARCHAR AS row_data')} FROM store"
    sql["export_json_lines"] = store + (
        "SELECT to_json({id: id, captured_at: event_time, event_time: event_time, operation: operation, db_name: db_name, "
        "table_name: table_name, primary_key: primary_key, row_data: row_data})::VARCHAR AS value FROM store"
    )
    sql["export_csv_lines"] = "SELECT doc_id, text, lang, source FROM documents"

    # Projections
    sql["classify_operation"] = base + (
        "SELECT file_no, start_pos, event_type, CASE WHEN event_type LIKE 'WRITE%' THEN 'INSERT' WHEN event_type LIKE "
        "'%UPDATE%' THEN 'UPDATE' WHEN event_type LIKE 'DELETE%' THEN 'DELETE' END AS operation FROM log"
    )
    sql["explode_rows"] = changed + (
        "SELECT file_no, start_pos, row_index, before IS NOT NULL AS has_before, after IS NOT NULL AS has_after, error "
        "FROM changed"
    )
    sql["name_cells"] = named + "SELECT file_no, start_pos, row_index, array_to_string(cols, ',') AS names FROM named"
    images = ", ".join(f"CASE WHEN {side} IS NOT NULL THEN {_object(side)} END AS {side}" for side in ("before", "after"))
    images = f"SELECT file_no, start_pos, row_index, {images} FROM named"
    two_names = named.replace("coalesce(names, [])[k]", "coalesce(names, [])[1:2][k]")
    sql["row_json_missing_names"] = two_names + images
    sql["row_image_json"] = named + images
    sql["render_values"] = changed + " UNION ALL ".join(
        f"SELECT file_no, start_pos, row_index, '{side}' AS side, (k - 1)::INTEGER AS cell_no, {side}[k] AS json "
        f"FROM changed, range(1, 11) r(k) WHERE {side} IS NOT NULL"
        for side in ("before", "after")
    )
    sql["render_bytes_hex"] = (
        "SELECT doc_id, CASE WHEN doc_id % 2 = 1 THEN '\"0xff' || lower(hex(encode(text))) || '\"' "
        "ELSE to_json(text)::VARCHAR END AS json FROM documents"
    )
    sql["row_envelope"] = events + 'SELECT file_no, start_pos, row_index, operation, "row" FROM captured'
    sql["primary_key_json"] = events + 'SELECT file_no, start_pos, row_index, "table", primary_key FROM captured'
    sql["null_if_empty"] = events + 'SELECT file_no, start_pos, row_index, pk_columns FROM captured'
    sql["to_store_row"] = events + (
        'SELECT "timestamp" AS event_time, operation, "database" AS db_name, "table" AS table_name, primary_key, '
        '"row" AS row_data FROM captured'
    )
    sql["format_event_time"] = _with(EV) + f"SELECT e AS event_id, {_TIME} AS text FROM ev"
    sql["format_utc_z"] = (
        f"SELECT o_orderkey, {_Z.format('(epoch_us(o_orderdate) // 1000000)')} AS text FROM orders"
    )
    sql["parse_instant"] = _with(TEXTS) + "SELECT event_id, text, seconds FROM texts"
    sql["parse_start_spec"] = _with(TEXTS, SPECS) + (
        f"SELECT event_id, {_SPEC_TEXT} AS start_spec, ['end', 'start', 'at', 'at'][form + 1] AS kind, "
        "CASE form WHEN 2 THEN file WHEN 3 THEN 'dir:' || file END AS log_name, "
        "CASE WHEN form IN (2, 3) THEN event_id::VARCHAR END AS pos FROM specs"
    )
    sql["csv_field"] = (
        "SELECT doc_id, CASE WHEN regexp_matches(text, '[,\"\\n\\r]') THEN '\"' || replace(text, '\"', '\"\"') || '\"' "
        "ELSE text END AS field FROM documents"
    )
    sql["position_label"] = base + "SELECT file_no, start_pos, log_name || ':' || start_pos AS label FROM log"

    # Filters
    sql["wildcard_match"] = (
        "SELECT page_id, url LIKE 'http%page=_%&%' AS by_url, contains(html, '%%%') AS by_html, "
        "url LIKE '%/fr/___' AS by_end FROM pages"
    )
    feed = _with(FEED) + "SELECT event_id, db_name, table_name FROM feed WHERE "
    sql["filter_db_wildcard"] = feed + "db_name LIKE 'app!_%' ESCAPE '!'"
    sql["filter_table_wildcard"] = feed + "table_name LIKE '%r%' OR table_name = 'view'"
    sql["filter_db_and_table"] = feed + (
        "(db_name LIKE 'app!__' ESCAPE '!' OR db_name = 'legacy') AND (table_name LIKE 'c%k' OR table_name LIKE 'si%')"
    )
    sql["rows_events_only"] = base + f"SELECT {header} FROM log WHERE row_count IS NOT NULL"
    rows_events = "(SELECT count(*) FROM log WHERE row_count IS NOT NULL)"
    sql["skipped_counts"] = sql["capture_counts"] = changed + (
        f"SELECT {rows_events} AS rows_events, {rows_events} - (SELECT count(*) FROM bound) AS unbound_events, "
        "(SELECT count(*) FROM changed WHERE error IS NOT NULL) AS bad_rows"
    )
    sql["drop_bad_rows"] = changed + "SELECT file_no, start_pos, row_index FROM changed WHERE error IS NULL"
    f, p = POSITION
    sql["from_position"] = base + (
        f"SELECT {header} FROM log WHERE file_no > {f} OR (file_no = {f} AND start_pos >= {p})"
    )
    export = store + f"SELECT {_STORE_COLS} FROM store "
    sql["export_filtered"] = export + "WHERE db_name = 'app_1' AND table_name = 'click' AND operation = 'UPDATE'"
    sql["export_limit"] = export + f"ORDER BY id LIMIT {LIMIT}"
    sql["export_events"] = export + "WHERE operation = 'INSERT' ORDER BY id LIMIT 500"
    parts = _with(*_ALL, """store AS (
  SELECT row_number() OVER (ORDER BY file_no % 3, file_no, start_pos, row_index) AS id, "timestamp" AS event_time, operation,
         "database" AS db_name, "table" AS table_name, primary_key, "row" AS row_data, file_no % 3 AS part
  FROM captured)""")
    sql["store_id_range"] = parts + f"SELECT {_STORE_COLS} FROM store WHERE id BETWEEN {ID_RANGE[0]} AND {ID_RANGE[1]}"
    sql["store_sql"] = parts + (
        "SELECT db_name, table_name, operation, count(*) AS events, min(event_time) AS earliest FROM store GROUP BY ALL"
    )
    sql["store_commits"] = parts + (
        "SELECT 'append=' || k::VARCHAR AS folder, (1 + count(*) FILTER (part < k))::BIGINT AS first, "
        "count(*) FILTER (part = k) AS rows FROM store, range(3) r(k) GROUP BY k"
    )
    sql["files_overlapping"] = ranges + f"SELECT log_name, file_no, start_time, end_time FROM ranges WHERE {_OVERLAP}"
    sql["level_filter"] = (
        "SELECT event_id, level FROM (SELECT event_id, ['debug', 'INFO', 'Warn', 'WARNING', 'error', 'noise']"
        "[event_id % 6 + 1] AS level FROM events) WHERE lower(level) IN ('warn', 'warning', 'error')"
    )

    sql["rejected_rows"] = changed + (
        "SELECT log_name, file_no, start_pos, NULL::INTEGER AS row_index, 'no table map' AS error FROM log l "
        "WHERE row_count IS NOT NULL AND NOT EXISTS (SELECT 1 FROM bound b WHERE b.e = l.e) UNION ALL "
        "SELECT log_name, file_no, start_pos, row_index, error FROM changed WHERE error IS NOT NULL"
    )

    # Joins
    bound = _with(EV, LOG, BOUND)
    names = "SELECT file_no, start_pos, event_type, table_id, db_name, table_name FROM bound"
    sql["resolve_tables"] = sql["stream_resolve_tables"] = sql["stream_out_of_order"] = bound + names
    few_ids = "few AS (SELECT * REPLACE (table_id % 3 AS table_id) FROM log)"
    sql["resolve_alternating"] = _with(EV, LOG, few_ids, BOUND.replace("FROM log)", "FROM few)")) + names
    feed_catalog = _with(FEED, CATALOGS)
    attach = "SELECT event_id, db_name, table_name, array_to_string(coalesce({}, []), ',') AS {} FROM feed LEFT JOIN catalog USING (db_name, table_name)"
    sql["attach_columns"] = feed_catalog + attach.format("names", "columns")
    sql["attach_primary_keys"] = feed_catalog + attach.format("pks", "pk_columns")
    sql["unknown_tables"] = feed_catalog + (
        "SELECT DISTINCT db_name, table_name FROM feed JOIN catalog USING (db_name, table_name) WHERE len(names) = 0"
    )
    targets = """targets AS (SELECT epoch_us(ts) // 1000000 AS target_ts FROM events
      UNION SELECT o FROM (VALUES (0::BIGINT), (4000000000)) v(o))"""
    sql["seek_positions"] = _with(*_BASE, FIRST, targets, SEEK) + "SELECT target_ts, log_name, file_no, pos FROM sought"
    spec_targets = "targets AS (SELECT DISTINCT seconds AS target_ts FROM specs WHERE since IS NOT NULL AND seconds IS NOT NULL)"
    sql["resolve_start"] = _with(*_BASE, FIRST, TEXTS, SPECS, spec_targets, SEEK, f"here AS ({current})") + """
      SELECT event_id,
        CASE WHEN s.log_name IS NOT NULL THEN s.log_name WHEN since IS NULL AND form = 2 THEN file
             WHEN since IS NULL AND form = 3 THEN 'dir:' || file ELSE here.log_name END AS log_name,
        CASE WHEN s.log_name IS NOT NULL THEN s.file_no WHEN since IS NULL AND form IN (2, 3) THEN event_id // 1000 + 1
             ELSE here.file_no END AS file_no,
        (CASE WHEN s.log_name IS NOT NULL THEN s.pos WHEN since IS NULL AND form IN (2, 3) THEN event_id
              WHEN since IS NULL AND form = 1 THEN 4 ELSE here.pos END)::VARCHAR AS pos
      FROM specs LEFT JOIN sought s ON s.target_ts = seconds AND since IS NOT NULL CROSS JOIN here"""

    # Aggregates and windows
    sql["next_id"] = store + "SELECT max(id) + 1 AS next_id FROM store"
    sql["first_event_time"] = _with(*_BASE, FIRST) + "SELECT file_no, log_name, first_time FROM first_times"
    sql["file_time_ranges"] = ranges + "SELECT log_name, file_no, file_size, start_time, end_time, is_current FROM ranges"
    sql["inventory_totals"] = ranges + (
        f"SELECT count(*) AS files, sum(file_size)::BIGINT AS total_bytes FROM ranges WHERE {_OVERLAP}"
    )
    sql["event_offsets"] = base + (
        "SELECT file_no, end_pos, coalesce(lag(end_pos) OVER (PARTITION BY file_no ORDER BY end_pos), 4) AS start_pos FROM log"
    )
    sql["assign_ids"] = changed + (
        "SELECT 1000 + row_number() OVER (ORDER BY file_no, start_pos, row_index) AS id, file_no, start_pos, row_index "
        "FROM changed"
    )

    # Commands
    whole = f"SELECT {EVENT_COLS}, log_name, file_no, start_pos, row_index FROM captured"
    sql["capture"] = sql["stream_capture"] = events + whole
    sql["capture_filtered"] = events + whole + """ WHERE "database" LIKE 'app!_%' ESCAPE '!' AND "table" LIKE '%r%'"""
    sql["log_inventory"] = ranges + (
        f"SELECT log_name, file_size, {_Z.format('start_time')} AS start_time, {_Z.format('end_time')} AS end_time, "
        f"is_current FROM ranges WHERE {_OVERLAP}"
    )
    sql["inventory_current"] = base + (
        "SELECT log_name AS file, end_pos AS pos, log_name || ':' || end_pos AS binlog_start FROM log "
        "ORDER BY file_no DESC, end_pos DESC LIMIT 1"
    )
    # A feed opened at a position does not see the table maps before it.
    late_log = LOG.replace("log AS (", "whole_log AS (", 1)
    late = """log AS (SELECT w.* FROM whole_log w
      WHERE w.file_no > {f} OR (w.file_no = {f} AND w.start_pos >= {p}))"""
    seek_one = SEEK.replace("FROM log", "FROM whole_log")
    first_whole = FIRST.replace("FROM log", "FROM whole_log")
    replay_from = late.format(f="(SELECT file_no FROM sought)", p="(SELECT pos FROM sought)")
    one = f"targets AS (SELECT {REPLAY_TS}::BIGINT AS target_ts)"
    sql["replay_since"] = (
        _with(EV, late_log, first_whole, one, seek_one, replay_from, BOUND, CHANGED, CATALOGS, NAMED, CAPTURED) + whole
    )
    sql["stream_from_position"] = sql["stream_source_from_end"] = (
        _with(EV, late_log, late.format(f=f, p=p), BOUND, CHANGED, CATALOGS, NAMED, CAPTURED) + whole
    )
    sql["stream_event_store"] = store + (
        "SELECT count(*) AS rows, min(id) AS first_id, max(id) AS last_id, count(DISTINCT id) AS ids FROM store"
    )
    sql["stream_refresh_catalog"] = events + whole
    sql["stream_refused_batches"] = events + (
        'SELECT kept_in, operation, "database", "table", "row" FROM captured, (VALUES (\'log\'), (\'store\')) k(kept_in)'
    )
    sql["stream_fan_out"] = events + f"SELECT {EVENT_COLS} FROM captured"
    return sql
