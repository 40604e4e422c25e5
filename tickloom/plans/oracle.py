"""The same results as plain SQL over the driver's tables."""

from __future__ import annotations

TOK = ("CAST(CASE WHEN ({k} % 1000000000)%29=0 THEN {k} % 1000000000 WHEN ({k} % 1000000000)%3=0 "
       "THEN 100000 + {k} % 1000000000 ELSE 10000 + {k} % 1000000000 END AS INT)")

# Building blocks; each is a WITH entry.
PARTS = {
    "msgs": f"""msgs AS (
  SELECT event_id AS record_no, 'arc' || CAST(event_id%4 AS VARCHAR) AS archive_stem,
    substr('NMXTCGHJKZ?', CAST(event_id%11 AS INT)+1, 1) AS msg_type,
    epoch_us(ts)*1000 + event_id%1000 AS capture_ns,
    CAST(event_id%16 AS SMALLINT) AS stream_id, CAST(event_id%2000000000 AS INT) AS seq_no,
    {TOK.format(k="user_id")} AS token,
    CASE WHEN event_id%97=0 THEN '?' WHEN event_id%2=0 THEN 'B' ELSE 'S' END AS side_byte,
    CAST(event_id AS VARCHAR) AS id_a, CAST(event_id+1000000 AS VARCHAR) AS id_b,
    CAST(floor(value*100) AS INT) AS price, CAST(1+event_id%500 AS INT) AS quantity,
    CAST(CASE WHEN event_id%101=0 THEN 0 WHEN event_id%103=0 THEN 3 ELSE 36 END AS SMALLINT) AS msg_len,
    CASE WHEN event_id%499=0 THEN 1 ELSE 0 END AS pad0,
    CASE WHEN event_id%997=0 THEN 1 ELSE 0 END AS pad1,
    CASE WHEN event_id%11 IN (0,1,2,5,6,7) THEN 'order' WHEN event_id%11 IN (3,4,8) THEN 'trade'
         WHEN event_id%11 = 9 THEN 'heartbeat' END AS cls
  FROM events)""",
    "lanes": """lanes AS (
  SELECT *, CASE WHEN pad0 <> 0 THEN 'pad0' WHEN pad1 <> 0 THEN 'pad1' WHEN cls IS NULL THEN NULL
    WHEN msg_len <= 0 THEN 'msg_len'
    WHEN msg_len < CASE cls WHEN 'order' THEN 29 WHEN 'trade' THEN 36 ELSE 4 END THEN 'short_body'
    WHEN cls = 'order' AND side_byte NOT IN ('B','S') THEN 'side' END AS defect
  FROM msgs)""",
    "decoded": """decoded AS (
  SELECT archive_stem, record_no, capture_ns,
    CASE WHEN cls='heartbeat' THEN 0 ELSE capture_ns - 1000000 END AS exchange_ns, stream_id, seq_no, msg_type,
    CAST(CASE cls WHEN 'order' THEN token WHEN 'trade' THEN token+1 ELSE 0 END AS INT) AS token,
    CASE WHEN cls='order' THEN side_byte ELSE '' END AS side,
    CASE WHEN cls='order' THEN id_a ELSE 'NaN' END AS order_id,
    CASE WHEN cls='trade' THEN id_a ELSE 'NaN' END AS buy_order_id,
    CASE WHEN cls='trade' THEN id_b ELSE 'NaN' END AS sell_order_id,
    CAST(CASE WHEN msg_type IN ('G','H','J') THEN -price WHEN cls='order' THEN price
         WHEN cls='trade' THEN price+5 ELSE record_no%100 END AS INT) AS price,
    CAST(CASE cls WHEN 'order' THEN quantity WHEN 'trade' THEN quantity+7 ELSE 0 END AS INT) AS quantity
  FROM lanes WHERE defect IS NULL AND cls IS NOT NULL)""",
    "con": f"""con AS (
  SELECT c_custkey AS line_key, CAST({TOK.format(k="c_custkey")} AS BIGINT) AS token,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'FUTSTK' WHEN 'AUTOMOBILE' THEN 'FUTIDX' WHEN 'MACHINERY' THEN 'OPTSTK'
      WHEN 'HOUSEHOLD' THEN 'OPTIDX' ELSE 'EQUITY' END AS instrument,
    CASE WHEN c_custkey%23=0 THEN 'TEST' || CAST(c_custkey%5 AS VARCHAR)
      ELSE 'SYM&' || CAST(c_custkey%40 AS VARCHAR) END AS symbol,
    CAST(1459348200 + (c_nationkey%3)*2419200 AS BIGINT) AS expiry,
    CASE c_custkey%4 WHEN 0 THEN 'BE' WHEN 1 THEN 'SM' ELSE 'EQ' END AS series
  FROM customer)""",
    "fo": """fo_meta AS (
  SELECT token, symbol, expiry FROM (
    SELECT *, row_number() OVER (PARTITION BY token ORDER BY line_key) AS n FROM con
    WHERE instrument <> 'EQUITY' AND token >= 0 AND token < 1000000) WHERE n = 1),
inst AS (SELECT DISTINCT token, instrument FROM con WHERE instrument <> 'EQUITY'),
att AS (
  SELECT m.*, f.symbol, f.expiry FROM msgs m JOIN fo_meta f ON m.token = f.token WHERE m.msg_type <> '?'),
split AS (SELECT a.*, i.instrument FROM att a JOIN inst i ON a.token = i.token),
final AS (SELECT * FROM split WHERE msg_type <> 'Z' AND symbol NOT LIKE 'TEST%')""",
    "cm": """cm_meta AS (
  SELECT token, symbol, series FROM (
    SELECT *, row_number() OVER (PARTITION BY token ORDER BY line_key) AS n FROM con
    WHERE instrument = 'EQUITY' AND token >= 0 AND token < 1000000) WHERE n = 1),
catt AS (
  SELECT m.*, c.symbol, c.series, regexp_replace(c.symbol, '[^A-Za-z0-9._-]', '_', 'g') || '_' || c.series AS safe_name
  FROM msgs m JOIN cm_meta c ON m.token = c.token WHERE m.msg_type <> '?')""",
    "dup": """dup AS (
  SELECT o_orderkey AS line_key, 10000 + o_custkey AS token, o_orderpriority AS symbol,
    CAST(1459348200 + (o_custkey%3)*2419200 AS BIGINT) AS expiry,
    'S' || CAST(o_orderkey%37 AS VARCHAR) AS series FROM orders)""",
    "files": """files AS (
  SELECT con.*, CAST(floor(abs(c_acctbal)*1000) AS BIGINT) AS length FROM con JOIN customer ON line_key = c_custkey)""",
    "tape": """tape AS (
  SELECT symbol, archive_stem, record_no, capture_ns,
    CASE WHEN cls='heartbeat' THEN 0 ELSE capture_ns - 1000000 END AS exchange_ns, seq_no, msg_type,
    CASE WHEN cls='order' AND side_byte IN ('B','S') THEN side_byte ELSE '' END AS side,
    CASE WHEN cls='order' THEN id_a ELSE '0' END AS order_id,
    CASE WHEN cls='trade' THEN id_a ELSE '0' END AS buy_order_id,
    CASE WHEN cls='trade' THEN id_b ELSE '0' END AS sell_order_id,
    price, quantity, stream_id, token, cls <> 'order' AS order_id_was_na,
    cls <> 'trade' AS buy_order_id_was_na, cls <> 'trade' AS sell_order_id_was_na,
    CASE WHEN msg_type IN ('N','M','X','T') THEN 'main' WHEN msg_type IN ('G','H','J','K') THEN 'aux' END AS tape
  FROM att)""",
    "exp": """exp AS (
  SELECT symbol, CAST(1459348200 - 1209600 + (line_key%6)*604800 AS VARCHAR) AS expiry_epoch FROM con),
dated AS (
  SELECT symbol, expiry_epoch, DATE '1970-01-01'
    + CAST(floor((CAST(expiry_epoch AS BIGINT) + 315532800 + 19800) / 86400.0) AS INT) AS expiry_date FROM exp)""",
    "caps": """caps AS (
  SELECT o_custkey AS source, CASE o_orderkey%3 WHEN 0 THEN 'recovery' WHEN 1 THEN 'stitched' END AS kind,
    '/src/' || CASE o_orderkey%3 WHEN 0 THEN 'recovery_efvi_' WHEN 1 THEN 'stitched_efvi_' ELSE 'other_' END
      || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') || '.cap' AS path, CAST(floor(o_totalprice) AS BIGINT) AS length
  FROM orders),
firsts AS (
  SELECT source, kind, min(path) AS path, arg_min(length, path) AS length FROM caps
  WHERE kind IS NOT NULL GROUP BY source, kind),
chosen AS (
  SELECT source, kind, path, length FROM (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY length DESC, kind) AS n FROM firsts) WHERE n = 1)""",
}

NEEDS = {"lanes": ["msgs"], "decoded": ["lanes"], "fo": ["msgs", "con"], "cm": ["msgs", "con"],
         "tape": ["fo"], "files": ["con"], "exp": ["con"]}


def _with(*names: str) -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    return "WITH " + ",\n".join(PARTS[name] for name in ordered) + "\n"


DECODED = ("SELECT capture_ns, exchange_ns, stream_id, seq_no, msg_type, token, side, order_id, buy_order_id, "
           "sell_order_id, price, quantity FROM decoded")
TAPE_COLUMNS = ("symbol, archive_stem, record_no, capture_ns, exchange_ns, seq_no, msg_type, side, order_id, "
                "buy_order_id, sell_order_id, price, quantity, stream_id, token, order_id_was_na, "
                "buy_order_id_was_na, sell_order_id_was_na")


def _verdict(source: str, keys: str = "") -> str:
    return f"""SELECT {keys} parser_total, parquet_total,
  CASE WHEN parser_total <= 0 THEN 'UNKNOWN' WHEN parser_total = parquet_total THEN 'YES' ELSE 'NO' END AS match,
  CASE WHEN parser_total > 0 AND parser_total <> parquet_total THEN abs(parser_total - parquet_total) END AS diff,
  CASE WHEN parser_total > 0 AND parquet_total > parser_total THEN 'MORE'
       WHEN parser_total > 0 AND parquet_total < parser_total THEN 'FEWER' END AS direction,
  CASE WHEN parser_total > 0 AND parser_total <> parquet_total
       THEN round(abs(parser_total - parquet_total) / parser_total * 100, 4) END AS pct
  {source}"""


ORACLE: dict[str, str] = {
    "decode_messages": _with("decoded") + "SELECT * FROM decoded",
    "msg_type_counts": _with("decoded") + "SELECT msg_type, count(*) AS rows FROM decoded GROUP BY 1",
    "unknown_types": _with("lanes") + "SELECT CAST(ascii(msg_type) AS SMALLINT) AS msg_type_code, count(*) AS rows "
    "FROM lanes WHERE cls IS NULL AND defect IS NULL GROUP BY 1",
    "message_class_profile": _with("msgs") + """SELECT coalesce(cls, 'unknown') AS msg_class, count(*) AS rows,
  min(msg_len) AS shortest, CASE cls WHEN 'order' THEN 29 WHEN 'trade' THEN 36 ELSE 4 END AS required
FROM msgs GROUP BY cls""",
    "defect_report": _with("lanes") + "SELECT defect, count(*) AS rows, min(record_no) AS first_record_no "
    "FROM lanes WHERE defect IS NOT NULL GROUP BY 1",
    "defects_by_archive": _with("lanes") + "SELECT archive_stem, defect, count(*) AS rows, "
    "min(record_no) AS first_record_no FROM lanes WHERE defect IS NOT NULL GROUP BY 1, 2",
    "archive_profile": _with("lanes") + """SELECT archive_stem, count(*) AS records,
  count(*) FILTER (defect IS NULL AND cls IS NULL) AS unknown_types,
  count(*) FILTER (defect IS NULL AND cls = 'heartbeat') AS heartbeats, count(defect) AS defects FROM lanes GROUP BY 1""",
    "token_coverage": _with("decoded", "fo") + """SELECT archive_stem, count(f.token) AS known_tokens,
  count(*) - count(f.token) AS unknown_tokens FROM decoded d LEFT JOIN fo_meta f ON d.token = f.token GROUP BY 1""",
    "read_batches": _with("msgs") + "SELECT CAST(floor(record_no / 1000) + 1 AS INT) AS batch, count(*) AS records, "
    "max(seq_no) AS last_seq_no FROM msgs GROUP BY 1",
    "token_lookup": _with("fo") + "SELECT record_no, archive_stem, msg_type, token, symbol, expiry FROM att",
    "token_lookup_shuffled": _with("fo") + "SELECT record_no, archive_stem, msg_type, token, symbol, expiry FROM att",
    "instrument_split_counts": _with("fo") + """SELECT instrument, count(*) AS rows,
  count(*) FILTER (msg_type = 'Z') AS heartbeats, count(*) FILTER (symbol LIKE 'TEST%') AS test_rows
FROM split GROUP BY 1""",
    "instrument_split_rows": _with("fo") + "SELECT record_no, instrument, symbol, expiry, msg_type FROM final",
    "instrument_subset": _with("fo") + "SELECT symbol, count(*) AS rows FROM final WHERE instrument = 'FUTSTK' GROUP BY 1",
    "drop_counts": _with("fo") + """SELECT expiry, count(*) FILTER (msg_type = 'Z') AS dropped_heartbeat,
  count(*) FILTER (msg_type <> 'Z' AND symbol LIKE 'TEST%') AS dropped_test, count(*) AS rows_before
FROM att GROUP BY 1""",
    "cm_lookup_counts": _with("cm") + "SELECT safe_name, count(*) AS rows FROM catt GROUP BY 1",
    "cm_series_filter": _with("cm") + "SELECT symbol, series, count(*) AS rows FROM catt "
    "WHERE series IN ('EQ','BE') GROUP BY 1, 2",
    "publish_filter": _with("fo") + "SELECT instrument, symbol, count(*) AS rows FROM final "
    "WHERE instrument NOT IN ('OPTSTK','OPTIDX') GROUP BY 1, 2",
    "contract_keep_first": _with("dup") + """SELECT token, symbol, expiry FROM (
  SELECT *, row_number() OVER (PARTITION BY token ORDER BY line_key) AS n FROM dup) WHERE n = 1""",
    "contract_keep_last": _with("dup") + """SELECT token, symbol, expiry FROM (
  SELECT *, row_number() OVER (PARTITION BY token ORDER BY line_key DESC) AS n FROM dup) WHERE n = 1""",
    "contract_conflicts": _with("dup") + """SELECT token, count(DISTINCT (symbol, expiry)) AS mappings,
  count(*) AS lines FROM dup GROUP BY 1 HAVING count(DISTINCT (symbol, expiry)) > 1""",
    "contract_profile": _with("con") + "SELECT instrument, count(DISTINCT token) AS tokens FROM con GROUP BY 1",
    "contract_expiry_profile": _with("con") + "SELECT expiry, count(DISTINCT token) AS tokens, "
    "count(DISTINCT symbol) AS symbols FROM con GROUP BY 1",
    "top_series": _with("dup") + """, first_meta AS (
  SELECT token, arg_min(symbol, line_key) AS symbol, arg_min(series, line_key) AS series FROM dup GROUP BY 1),
counted AS (
  SELECT d.series, count(*) AS tokens, min(d.line_key) AS line_key FROM dup d JOIN first_meta f
    ON d.token = f.token AND d.symbol = f.symbol AND d.series = f.series GROUP BY 1
  ORDER BY tokens DESC, line_key LIMIT 10)
SELECT series, tokens FROM counted""",
    "contract_fo_file": _with("con") + "SELECT token, instrument, symbol, expiry FROM con "
    "WHERE instrument <> 'EQUITY' AND line_key%50 <> 7",
    "contract_cm_file": _with("con") + "SELECT token, symbol, series FROM con "
    "WHERE instrument = 'EQUITY' AND line_key%50 <> 7",
    "row_ledger": _with("fo") + "SELECT archive_stem, expiry, symbol, "
    "regexp_replace(symbol, '[^A-Za-z0-9._-]', '_', 'g') AS safe_symbol, count(*) AS rows FROM att GROUP BY 1, 2, 3",
    "row_ledger_cash": _with("cm") + "SELECT archive_stem, symbol, series, safe_name, count(*) AS rows "
    "FROM catt GROUP BY 1, 2, 3, 4",
    "ledger_scan": _with("fo") + """SELECT CAST(coalesce(sum(rows), 0) AS BIGINT) AS parser_total FROM (
  SELECT count(*) AS rows FROM att GROUP BY archive_stem, expiry, symbol) WHERE rows%7 <> 0""",
    "token_digit_check": _with("fo") + """SELECT instrument, expiry, symbol, count(*) AS row_count,
  count(*) FILTER (token < 10000 OR token > 999999) AS bad_tokens,
  count(*) FILTER (token BETWEEN 10000 AND 99999) AS five_digit,
  count(*) FILTER (token BETWEEN 100000 AND 999999) AS six_digit,
  CASE WHEN count(*) FILTER (token < 10000 OR token > 999999) = 0 THEN 'PASS' ELSE 'FAIL' END AS token_check,
  CASE WHEN count(*) FILTER (token < 10000 OR token > 999999) = 0 THEN 'PASS' ELSE 'FAIL' END AS status
FROM final GROUP BY 1, 2, 3""",
    "rows_rollup": _with("fo") + """SELECT coalesce(d.i, 'TOTAL') AS instrument, CAST(count(f.instrument) AS BIGINT) AS rows
FROM (VALUES ('FUTSTK'), ('FUTIDX'), ('OPTSTK'), ('OPTIDX'), ('FUTCUR')) AS d(i)
LEFT JOIN final f ON f.instrument = d.i GROUP BY ROLLUP (d.i)""",
    "cross_check": _with("fo") + ", totals AS (SELECT (SELECT count(*) FROM att) AS parser_total, "
    "(SELECT count(*) FROM final) AS parquet_total, "
    "(SELECT count(*) FROM att WHERE msg_type = 'Z' OR symbol LIKE 'TEST%') AS dropped, "
    "(SELECT count(*) FROM final) - (SELECT count(*) FROM att WHERE msg_type <> 'Z' AND symbol NOT LIKE 'TEST%') AS gained)\n"
    + _verdict("FROM totals", "dropped, gained, parser_total - dropped + gained AS expected_total, "
               "parser_total - dropped + gained = parquet_total AS expected_match, "),
    "cross_check_by_key": _with("fo") + """, l AS (SELECT expiry, symbol, count(*) AS n FROM att GROUP BY 1, 2),
r AS (SELECT expiry, symbol, count(*) AS n FROM final GROUP BY 1, 2),
totals AS (SELECT coalesce(l.expiry, r.expiry) AS expiry, coalesce(l.symbol, r.symbol) AS symbol,
  coalesce(l.n, 0) AS parser_total, coalesce(r.n, 0) AS parquet_total
  FROM l FULL OUTER JOIN r ON l.expiry = r.expiry AND l.symbol = r.symbol)
""" + _verdict("FROM totals", "expiry, symbol, "),
    "expiry_dates": _with("exp") + """SELECT DISTINCT expiry_epoch, CAST(expiry_date AS VARCHAR) AS expiry_date,
  CAST(DATE '1970-01-01' + CAST(floor((CAST(expiry_epoch AS BIGINT) + 315532800) / 86400.0) AS INT) AS VARCHAR) AS expiry_date_ist,
  CAST(expiry_epoch AS BIGINT) + 315532800 AS expiry_unix FROM dated""",
    "front_expiry": _with("exp") + """SELECT symbol, CAST(expiry_date AS VARCHAR) AS expiry_date, expiry_epoch FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY expiry_date, expiry_epoch) AS n FROM dated
  WHERE expiry_date >= DATE '2026-03-27') WHERE n = 1""",
    "front_expiry_rows": _with("exp") + """SELECT symbol, expiry_epoch, count(*) AS entries FROM exp
WHERE expiry_epoch = (SELECT expiry_epoch FROM dated WHERE expiry_date >= DATE '2026-03-27'
  ORDER BY expiry_date, expiry_epoch LIMIT 1) GROUP BY 1, 2""",
    "tape_main": _with("tape") + f"SELECT {TAPE_COLUMNS} FROM tape WHERE tape = 'main'",
    "tape_aux": _with("tape") + f"SELECT {TAPE_COLUMNS} FROM tape WHERE tape = 'aux'",
    "tape_sorted": _with("tape") + f"SELECT {TAPE_COLUMNS} FROM tape WHERE tape = 'main'",
    "tape_split_counts": _with("tape") + "SELECT tape, symbol, count(*) AS rows FROM tape WHERE tape IS NOT NULL GROUP BY 1, 2",
    "tape_ranked": _with("tape") + """, shaped AS (
  SELECT symbol, tape, CASE WHEN record_no%41 = 0 THEN NULL ELSE capture_ns // 60000000000 END AS capture_ns,
    seq_no, archive_stem, record_no FROM tape WHERE tape IS NOT NULL)
SELECT *, row_number() OVER (PARTITION BY tape, symbol ORDER BY capture_ns NULLS LAST, seq_no NULLS LAST,
  archive_stem, record_no) AS tape_no FROM shaped""",
    "clean_ids": """SELECT event_id,
  CASE WHEN event_id%8 < 5 THEN '0' WHEN event_id%8 = 5 THEN '0' ELSE CAST(event_id AS VARCHAR) END AS order_id,
  CASE WHEN event_id%5 IN (0, 1) THEN '0' WHEN event_id%5 = 2 THEN CAST(CAST((CAST(event_id AS DOUBLE) - 50) * 1e21::DOUBLE AS HUGEINT) AS VARCHAR)
    ELSE CAST(event_id + 1300000000000000 AS VARCHAR) END AS buy_order_id,
  CASE WHEN event_id%3 = 0 THEN '0' ELSE CAST(event_id AS VARCHAR) END AS sell_order_id,
  event_id%8 < 4 AS order_id_was_na, event_id%5 IN (0, 1) AS buy_order_id_was_na,
  event_id%3 = 0 AS sell_order_id_was_na FROM events""",
    "alias_columns": _with("msgs") + """SELECT capture_ns,
  CASE WHEN cls='heartbeat' THEN 0 ELSE capture_ns - 1000000 END AS exchange_ns, seq_no, msg_type,
  CASE WHEN cls='order' AND side_byte IN ('B','S') THEN side_byte ELSE '' END AS side,
  CASE WHEN cls='order' THEN id_a ELSE '0' END AS order_id, CASE WHEN cls='trade' THEN id_a ELSE '0' END AS buy_order_id,
  CASE WHEN cls='trade' THEN id_b ELSE '0' END AS sell_order_id, price, quantity, stream_id, CAST(NULL AS INT) AS token,
  cls <> 'order' AS order_id_was_na, cls <> 'trade' AS buy_order_id_was_na, cls <> 'trade' AS sell_order_id_was_na
FROM msgs WHERE cls IS NOT NULL""",
    "sanitize_symbols": """SELECT c_custkey, name, regexp_replace(name, '[^\\p{L}\\p{N}._-]', '_', 'g') AS safe_name FROM (
  SELECT c_custkey, c_name || ([' & Co', '-é9', '.x_', '/1', '+ü!'])[c_custkey%5 + 1] AS name FROM customer)""",
    "archive_stems": """SELECT '/data/efvi_20260327_' || c_custkey
  || (['.cap.tar.xz', '.tar.gz', '.cap', '.tgz', '.tar.bz2', '.cap.gz'])[c_custkey%6 + 1] AS path,
  'efvi_20260327_' || c_custkey || CASE WHEN c_custkey%6 = 5 THEN '.cap.gz' ELSE '' END AS archive_stem FROM customer""",
    "shard_names": """SELECT c_custkey AS line_key,
  'arc_b' || CAST(c_custkey%10 AS VARCHAR) || CASE WHEN c_custkey%3=0 THEN '_b12' ELSE '' END AS archive_stem,
  CASE WHEN c_custkey%3 <> 0 THEN CAST(c_custkey%7 AS INT) END AS batch FROM customer""",
    "output_names": _with("con") + """SELECT line_key,
  '20260327_' || instrument || '_' || replace(symbol, '&', '_') || '_' || expiry || '.parquet' AS derivative_file,
  '20260327_' || replace(symbol, '&', '_') || '_' || series || '.parquet' AS cash_file,
  'TBT_' || symbol || '_20260327' AS tape FROM con""",
    "manifest_futstk": _with("con") + """SELECT symbol || '_A' AS symbol, CAST(expiry AS VARCHAR) AS expiry_epoch,
  min('/final/' || CASE WHEN line_key%2=0 THEN 'b/' ELSE 'a/' END || '20260327_FUTSTK_' || symbol || '_A_' || expiry || '.parquet') AS path
FROM con WHERE line_key%9 <> 0 AND line_key%4 <> 0 GROUP BY 1, 2""",
    "manifest_cash": _with("con") + "SELECT symbol || '_X' AS symbol, series, count(*) AS files FROM con "
    "WHERE line_key%9 <> 0 AND series = 'EQ' GROUP BY 1, 2",
    "manifest_cash_sorted": _with("con") + "SELECT DISTINCT '/cm/20260327_' || symbol || '_' || series || '.parquet' AS path, "
    "symbol, series FROM con",
    "capture_choice": _with("caps") + "SELECT source, kind, path, length FROM chosen",
    "capture_list_union": _with("caps") + """SELECT '/src/efvi_' || c_custkey || '.cap.tar.xz' AS path,
  'efvi_' || c_custkey AS archive_stem FROM customer
UNION ALL SELECT path, regexp_extract(path, '([^/]*)\\.cap$', 1) FROM chosen""",
    "resume_remaining": """SELECT DISTINCT 'efvi_' || o_custkey AS archive_stem FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey%3 = 0)""",
    "export_todo": _with("dup") + """SELECT DISTINCT symbol, series FROM dup EXCEPT
SELECT symbol, series FROM dup WHERE line_key%101 = 0 GROUP BY 1, 2 HAVING count(DISTINCT line_key%2) = 2""",
    "export_existing": _with("dup") + """SELECT symbol, series FROM dup WHERE line_key%101 = 0
GROUP BY 1, 2 HAVING count(DISTINCT line_key%2) = 2""",
    "capture_roundtrip": _with("decoded") + DECODED,
    "archive_roundtrip": _with("decoded") + DECODED,
    "capture_type_counts": _with("msgs") + "SELECT CAST(ascii(msg_type) AS SMALLINT) AS msg_type_code, count(*) AS rows, "
    "max(seq_no) AS last_seq_no FROM msgs WHERE msg_type IN ('N','T','Z') GROUP BY 1",
    "archive_blocks_roundtrip": _with("decoded") + DECODED,
    "bundled_roundtrip": """SELECT 'small' || CAST(event_id // 300 AS VARCHAR) AS archive_stem, count(*) AS records,
  row_number_max AS last_record_no, count(*) FILTER (place = event_id % 300) AS in_place, CAST(sum(code) AS BIGINT) AS codes
FROM (SELECT event_id, ascii(substr('NMXTCGHJKZ?', CAST(event_id%11 AS INT)+1, 1)) AS code,
  row_number() OVER (PARTITION BY event_id // 300 ORDER BY event_id) - 1 AS place,
  count(*) OVER (PARTITION BY event_id // 300) - 1 AS row_number_max FROM events) GROUP BY event_id // 300, row_number_max""",
    "torn_records": _with("msgs") + """SELECT archive_stem || '_' || kind AS archive_stem, CASE kind WHEN 'archive' THEN 'whole' ELSE kind END AS form,
  count(*) AS records, CAST(torn AS BIGINT) AS torn_bytes, CAST(NULL AS VARCHAR) AS problem
FROM msgs, (VALUES ('plain', 13), ('archive', 5), ('blocks', 7)) AS f(kind, torn) GROUP BY archive_stem, kind, torn""",
    "archive_discovery": _with("msgs") + """SELECT archive_stem || '_' || kind AS archive_stem, archive_stem || '_' || kind || '.cap.tar.xz' AS file,
  count(*) AS records, CAST(torn AS BIGINT) AS torn_bytes
FROM msgs, (VALUES ('archive', 5), ('blocks', 7)) AS f(kind, torn) GROUP BY archive_stem, kind, torn""",
    "footer_counts": _with("decoded", "fo") + """SELECT i.instrument, f.symbol, f.expiry, count(*) AS rows
FROM decoded d JOIN fo_meta f ON d.token = f.token
JOIN inst i ON d.token = i.token WHERE d.msg_type <> 'Z' AND f.symbol NOT LIKE 'TEST%' GROUP BY 1, 2, 3""",
    "ingest_status": _with("decoded", "fo") + """, placed AS (
  SELECT 'broken' || substr(archive_stem, 4) AS stem, defect, row_number() OVER (PARTITION BY archive_stem ORDER BY record_no) - 1 AS place
  FROM lanes WHERE defect IS NOT NULL),
first_place AS (SELECT 'defect ' || defect || ' in ' || stem || ' record ' || place AS raised FROM placed ORDER BY stem, place LIMIT 1),
every AS (
  SELECT l.archive_stem, count(f.token) AS rows, 0 AS defects FROM (SELECT DISTINCT archive_stem FROM lanes WHERE defect IS NULL) l
  LEFT JOIN decoded d ON d.archive_stem = l.archive_stem LEFT JOIN fo_meta f ON f.token = d.token GROUP BY 1
  UNION ALL SELECT stem, 0, count(*) FROM placed GROUP BY 1)
SELECT archive_stem, rows, defects, CAST(9 AS BIGINT) AS torn_bytes, CASE WHEN defects > 0 THEN 'failed' ELSE 'done' END AS status, raised
FROM every, first_place""",
    "quarantine": _with("decoded", "fo") + """, placed AS (
  SELECT archive_stem, row_number() OVER (PARTITION BY archive_stem ORDER BY record_no) - 1 AS record_no, CAST(record_no AS INT) AS seq_no, msg_type, defect FROM lanes)
SELECT archive_stem, record_no, seq_no, msg_type, defect, CAST(0 AS BIGINT) AS shard_rows FROM placed WHERE defect IS NOT NULL
UNION ALL SELECT d.archive_stem, NULL, NULL, NULL, NULL, count(*) FROM decoded d JOIN fo_meta f ON d.token = f.token GROUP BY 1""",
    "ingest_profile": _with("decoded", "fo") + """, tokens AS (
  SELECT count(f.token) AS known, count(*) - count(f.token) AS unknown FROM decoded d LEFT JOIN fo_meta f ON d.token = f.token)
SELECT count(DISTINCT archive_stem) AS commits, count(DISTINCT archive_stem) AS archives, count(DISTINCT archive_stem) AS torn_records,
  11 * count(DISTINCT archive_stem) AS torn_bytes, count(*) AS records, count(*) FILTER (defect IS NULL AND cls IS NULL) AS unknown_types,
  count(*) FILTER (defect IS NULL AND cls = 'heartbeat') AS heartbeats, count(*) FILTER (defect = 'pad0') AS defect_pad0,
  count(*) FILTER (defect = 'pad1') AS defect_pad1, count(*) FILTER (defect = 'msg_len') AS defect_msg_len,
  count(*) FILTER (defect = 'short_body') AS defect_short_body, count(*) FILTER (defect = 'side') AS defect_side,
  0 AS defect_exchange_time, 0 AS defect_unreadable, any_value(known) AS known_tokens, any_value(unknown) AS unknown_tokens
FROM lanes, tokens""",
    "ingest_groups": _with("decoded", "fo") + """, counted AS (
  SELECT l.archive_stem, count(f.token) AS rows FROM (SELECT DISTINCT archive_stem FROM lanes WHERE defect IS NULL) l
  LEFT JOIN decoded d ON d.archive_stem = l.archive_stem LEFT JOIN fo_meta f ON f.token = d.token GROUP BY 1)
SELECT seen, archive_stem, 'done' AS status, rows FROM counted, (VALUES ('after the failure'), ('done again'), ('at the end')) AS s(seen)
WHERE seen = 'at the end' OR (archive_stem < 'arc2') = (seen = 'after the failure')""",
    "ingest_clean_start": _with("decoded", "fo") + """, counted AS (
  SELECT l.archive_stem, count(f.token) AS rows FROM (SELECT DISTINCT archive_stem FROM lanes WHERE defect IS NULL) l
  LEFT JOIN decoded d ON d.archive_stem = l.archive_stem LEFT JOIN fo_meta f ON f.token = d.token GROUP BY 1)
SELECT t.n AS table_name, archive_stem, rows FROM counted, (VALUES ('status'), ('ledger'), ('shards')) AS t(n)
WHERE archive_stem <> 'arc1' AND (rows > 0 OR t.n = 'status')""",
    "skipped_shards": _with("fo") + """SELECT archive_stem, count(*) AS rows, NULL AS skipped, NULL AS length FROM att GROUP BY 1
UNION ALL SELECT 'arc1', NULL, 'damaged-1.parquet', 17 UNION ALL SELECT 'arc3', NULL, 'damaged-2.parquet', 3""",
    "day_swap": _with("fo") + """SELECT seen, instrument, symbol, expiry, count(*) AS rows, CAST(sum(price) AS BIGINT) AS price, 2 AS versions
FROM final, (VALUES ('first'), ('after the failure'), ('second')) AS s(seen)
WHERE seen = 'second' OR record_no % 2 = 0 GROUP BY 1, 2, 3, 4""",
    "ingest_final_counts": _with("decoded", "fo") + """SELECT i.instrument, f.symbol, f.expiry, count(*) AS rows,
  CAST(sum(d.quantity) AS BIGINT) AS quantity FROM decoded d JOIN fo_meta f ON d.token = f.token
JOIN inst i ON d.token = i.token WHERE d.msg_type <> 'Z' AND f.symbol NOT LIKE 'TEST%' GROUP BY 1, 2, 3""",
    "ingest_cash_counts": _with("decoded", "cm") + """SELECT c.symbol, c.series, count(*) AS rows
FROM decoded d JOIN cm_meta c ON d.token = c.token GROUP BY 1, 2""",
    "final_table": _with("fo") + "SELECT record_no, '20260327' AS trade_date, instrument, symbol, expiry, price FROM final",
    "research_export": _with("tape") + """, written AS (
  SELECT symbol, count(*) FILTER (tape = 'main') AS rows FROM tape GROUP BY 1)
SELECT symbol, rows, 'written' AS status FROM written UNION ALL SELECT symbol, NULL, 'exists' FROM written""",
    "shard_stream_counts": _with("fo") + "SELECT instrument, symbol, count(*) AS rows FROM final GROUP BY 1, 2",
    "shard_stream_redo": _with("fo") + "SELECT instrument, symbol, count(*) AS rows FROM final GROUP BY 1, 2",
    "ingest_redone_empty": _with("fo") + """SELECT archive_stem, 'done' AS status,
  count(*) FILTER (archive_stem <> 'arc1') AS rows, nullif(count(*) FILTER (archive_stem <> 'arc1'), 0) AS shard_rows,
  CAST(nullif(count(*) FILTER (archive_stem <> 'arc1'), 0) AS BIGINT) AS ledger_rows FROM att GROUP BY 1""",
    "size_by_instrument": _with("files") + """SELECT coalesce(d.i, 'TOTAL') AS instrument,
  CAST(coalesce(sum(f.length), 0) AS BIGINT) AS bytes, count(f.length) AS files, count(DISTINCT f.expiry) AS expiries,
  count(DISTINCT CASE WHEN f.symbol IS NOT NULL THEN (f.instrument, f.symbol, f.expiry) END) AS symbol_groups
FROM (SELECT unnest(['FUTSTK', 'FUTIDX', 'OPTSTK', 'OPTIDX', 'EQUITY']) AS i) d
LEFT JOIN files f ON f.instrument = d.i GROUP BY ROLLUP (d.i)
HAVING coalesce(d.i, 'TOTAL') <> 'EQUITY'""",
    "compression_ratio": _with("files") + """, t AS (
  SELECT CAST(sum(length) AS BIGINT) AS a, CAST(sum(length) FILTER (instrument <> 'EQUITY') AS BIGINT) AS b FROM files)
SELECT a AS input_bytes, b AS output_bytes, round(a / 1e9, 3) AS input_gb, round(b / 1e9, 3) AS output_gb,
  b / a AS ratio, (1 - b / a) * 100 AS pct_smaller FROM t""",
    "codec_saving_ratio": _with("files") + """, t AS (
  SELECT CAST(sum(length) FILTER (line_key%10 <> 0) AS BIGINT) AS a,
    CAST(sum(length) FILTER (line_key%3 = 0) AS BIGINT) AS b FROM files WHERE instrument = 'FUTSTK')
SELECT a AS old_bytes, b AS new_bytes, (1 - b / a) * 100 AS saving_pct FROM t WHERE a > 0 AND b > 0""",
    "cash_size_table": _with("cm", "files") + """, r AS (
  SELECT symbol, series, safe_name, count(*) AS rows FROM catt GROUP BY 1, 2, 3),
s AS (SELECT symbol, series, sum(length) AS bytes FROM files WHERE instrument = 'EQUITY' GROUP BY 1, 2)
SELECT r.symbol, r.series, safe_name, rows, round(coalesce(bytes, 0) / 1048576, 2) AS file_size_mb
FROM r LEFT JOIN s ON r.symbol = s.symbol AND r.series = s.series""",
    "sanity_report": _with("fo") + """SELECT instrument, symbol, expiry, count(*) AS row_count,
  count(*) FILTER (token < 10000 OR token > 999999) AS bad_tokens,
  count(*) FILTER (token BETWEEN 10000 AND 99999) AS five_digit,
  count(*) FILTER (token BETWEEN 100000 AND 999999) AS six_digit,
  CASE WHEN count(*) FILTER (token < 10000 OR token > 999999) = 0 THEN 'PASS' ELSE 'FAIL' END AS token_check,
  CASE WHEN count(*) FILTER (token < 10000 OR token > 999999) = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
  'PASS' AS magic_bytes FROM final GROUP BY 1, 2, 3""",
    "contract_fo_read": _with("dup") + """, wanted AS (
  SELECT *, ['FUTSTK', 'FUTIDX', 'OPTSTK', 'OPTIDX', 'EQUITY'][line_key%5 + 1] AS instrument FROM dup WHERE line_key%5 <> 4 AND token < 1000000),
picked AS (
  SELECT token, arg_min({'s': symbol, 'e': expiry}, line_key) AS first, arg_max({'s': symbol, 'e': expiry}, line_key) AS last,
    array_to_string(list_sort(list(DISTINCT instrument)), ',') AS instruments FROM wanted GROUP BY 1)
SELECT 'first' AS policy, token, first.s AS symbol, first.e AS expiry, instruments FROM picked
UNION ALL SELECT 'last', token, last.s, last.e, instruments FROM picked""",
    "contract_cm_read": _with("dup") + """, picked AS (
  SELECT token, arg_min(symbol, line_key) AS symbol, arg_min(series, line_key) AS series FROM dup WHERE line_key%3 = 0 AND token < 1000000 GROUP BY 1)
SELECT first_line, token, symbol, series FROM picked, (VALUES ('number'), ('entry')) AS f(first_line)
UNION ALL SELECT 'entry', 77, 'FIRST', 'EQ'""",
    "contract_checks": _with("dup") + """, clash AS (
  SELECT token, count(DISTINCT (symbol, expiry)) AS ways FROM dup WHERE line_key%5 <> 4 GROUP BY 1 HAVING count(DISTINCT (symbol, expiry)) > 1 ORDER BY 1 LIMIT 1)
SELECT 'conflict' AS case, 'token ' || token || ' maps inconsistently (' || ways || ' ways)' AS message FROM clash
UNION ALL SELECT 'empty', 'no contract lines of the wanted instruments'
UNION ALL SELECT 'token', 'bad token: x' || max(c_custkey) FROM customer
UNION ALL SELECT 'expiry', 'bad expiry: ' || max(c_custkey) || '.5' FROM customer""",
    "report_blocks": _with("decoded", "fo") + """, kept AS (
  SELECT d.archive_stem, d.record_no, d.token, d.msg_type, f.symbol, f.expiry FROM decoded d JOIN fo_meta f ON d.token = f.token),
fin AS (SELECT kept.*, i.instrument FROM kept JOIN inst i ON kept.token = i.token WHERE msg_type <> 'Z' AND symbol NOT LIKE 'TEST%')
SELECT 'files' AS block, '20260327_' || instrument || '_' || regexp_replace(symbol, '[^A-Za-z0-9._-]', '_', 'g') || '_' || expiry || '.parquet' AS name,
  count(*) || CASE WHEN count(*) FILTER (token < 10000 OR token > 999999) = 0 THEN ' PASS PASS PASS' ELSE ' FAIL PASS FAIL' END AS value
FROM fin GROUP BY instrument, symbol, expiry
UNION ALL SELECT 'totals', coalesce(d.i, 'TOTAL'), CAST(count(f.instrument) AS VARCHAR)
FROM (VALUES ('FUTSTK'), ('FUTIDX'), ('OPTSTK'), ('OPTIDX')) AS d(i) LEFT JOIN fin f ON f.instrument = d.i GROUP BY ROLLUP (d.i)
UNION ALL SELECT 'cross_check', 'expected', (SELECT count(*) FROM kept) || ' ' || (SELECT count(*) FROM fin) || ' '
  || (SELECT count(*) FROM kept WHERE msg_type = 'Z' OR symbol LIKE 'TEST%') || ' '
  || ((SELECT count(*) FROM fin) - (SELECT count(*) FROM kept WHERE msg_type <> 'Z' AND symbol NOT LIKE 'TEST%')) || ' true'
UNION ALL SELECT 'shared', instrument, CAST(count(*) AS VARCHAR) FROM fin WHERE instrument NOT IN ('OPTSTK', 'OPTIDX') GROUP BY instrument""",
    "export_mixed_files": _with("fo") + """, futures AS (
  SELECT replace(symbol, '&', '_') AS symbol, CAST(split_part(symbol, '&', 2) AS INT)%4 AS kind,
    count(*) FILTER (msg_type IN ('N','M','X','T')) AS main, count(*) FILTER (msg_type IN ('G','H','J','K')) AS aux
  FROM final WHERE instrument = 'FUTSTK' AND symbol LIKE 'SYM%' AND expiry = 1459348200 GROUP BY 1, 2)
SELECT symbol, CASE WHEN kind < 3 THEN main END AS rows, CASE WHEN kind < 3 THEN 'written' ELSE 'error' END AS status, '20260327' AS trade_date,
  CASE WHEN kind = 3 THEN '20260327_FUTSTK_' || symbol || '_1459348200.parquet'
       WHEN main > 0 THEN 'tapes/trade_date=20260327/tape=main/symbol=' || symbol
       WHEN aux > 0 THEN 'tapes/trade_date=20260327/tape=aux/symbol=' || symbol END AS path FROM futures""",
    "export_requested_expiry": _with("fo") + """, every AS (
  SELECT replace(symbol, '&', '_') AS symbol, CAST(split_part(symbol, '&', 2) AS INT)%4 AS kind, expiry,
    count(*) FILTER (msg_type IN ('N','M','X','T')) AS main FROM final WHERE instrument = 'FUTSTK' AND symbol LIKE 'SYM%' GROUP BY 1, 2, 3),
known AS (SELECT 'expiry 7 not found; available: ' || string_agg(DISTINCT CAST(expiry AS VARCHAR), ', ' ORDER BY CAST(expiry AS VARCHAR)) AS unknown FROM every)
SELECT symbol, CASE WHEN kind < 3 THEN main END AS rows, CASE WHEN kind < 3 THEN 'written' ELSE 'error' END AS status, unknown
FROM every, known WHERE expiry = 1459348200 + 2419200""",
}
