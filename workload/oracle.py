"""ANSI SQL that states the result of each query from the clean tables."""

from __future__ import annotations

SQL: dict[str, str] = {}

STAMP = "__20260717_103000"

# --- orders ------------------------------------------------------------------------------

_ORDERS = """
o AS (
  SELECT o_orderkey AS nr, 'orders_' || o_custkey || '.csv' AS file, o_custkey AS c,
         o_orderstatus AS s, CAST(o_totalprice AS DECIMAL(18,2)) AS p,
         CAST(o_orderdate AS DATE) AS dt, strftime(o_orderdate, '%Y-%m-%d') AS d,
         o_orderpriority AS pr, year(o_orderdate) AS y
  FROM orders
)"""

_COLUMN_REASON = "passt nicht zu Typ ''{typ}''"


def _finding(where, position, column, value, code, reason):
    col = "NULL" if column is None else f"'{column}'"
    return (
        f"SELECT file, nr, y, {position} AS position, CAST({col} AS VARCHAR) AS \"column\", "
        f"CAST({value} AS VARCHAR) AS value, '{code}' AS code, '{reason}' AS reason "
        f"FROM o WHERE {where}"
    )


_PRICE = (
    "CASE WHEN nr % 83 = 0 THEN '-' || CAST(p AS VARCHAR) "
    "WHEN nr % 107 = 0 THEN '1000000.00' ELSE CAST(p AS VARCHAR) END"
)
_FINDINGS = " UNION ALL ".join([
    _finding("nr % 89 = 0", -1, None, "NULL", "COLUMN_COUNT", "Spaltenanzahl 5 statt 6"),
    _finding("nr % 89 <> 0 AND nr % 101 = 0", 1, "cust_key", "'x' || c", "TYPE_OR_PATTERN",
             "passt nicht zu Typ ''integer''"),
    _finding("nr % 89 <> 0 AND nr % 79 = 0", 2, "status", "' '", "REQUIRED_EMPTY",
             "Pflichtfeld ist leer"),
    _finding("nr % 89 <> 0 AND nr % 83 = 0", 3, "total", _PRICE, "BELOW_MIN",
             "kleiner als Minimum 0.0"),
    _finding("nr % 89 <> 0 AND nr % 83 <> 0 AND nr % 107 = 0", 3, "total", _PRICE, "ABOVE_MAX",
             "groesser als Maximum 999999.99"),
    _finding("nr % 89 <> 0 AND nr % 97 = 0", 4, "order_date", "'2026-13-45'", "TYPE_OR_PATTERN",
             "passt nicht zu Typ ''date_iso''"),
    _finding("nr % 89 <> 0 AND nr % 103 = 0", 5, "priority", "'9-ODD'", "TYPE_OR_PATTERN",
             "passt nicht zu Typ ''string'' / Muster ''^[1-5]-[A-Z ]+$''"),
])
_CHECKED = f"WITH {_ORDERS}, e AS ({_FINDINGS})"
_GOOD = "nr NOT IN (SELECT nr FROM e)"
_MAPPED = "nr AS order_key, c AS cust_key, s AS status, CAST(p AS DOUBLE) AS total, dt AS order_date, pr AS priority"

SQL["parse_orders"] = f"WITH {_ORDERS} SELECT {_MAPPED} FROM o"
SQL["load_good_orders"] = f"{_CHECKED} SELECT {_MAPPED} FROM o WHERE {_GOOD}"
SQL["validate_rows"] = f'{_CHECKED} SELECT file, nr, position, "column", value, code, reason FROM e'
SQL["error_report"] = f"""{_CHECKED}
SELECT 'orders_' || y AS file, nr, position,
       CASE WHEN "column" IS NULL THEN 'Zeile ' || nr || ': ' || reason
            ELSE 'Zeile ' || nr || ', Spalte ''' || "column" || ''': ''' || value || ''' — ' || reason
       END AS text
FROM (SELECT *, row_number() OVER (PARTITION BY y ORDER BY nr, position, code) AS rn FROM e)
WHERE rn <= 50"""

_COUNTS = """
counts AS (
  SELECT f.file, count(o.nr) AS rows_total,
         count(o.nr) FILTER (WHERE o.nr IN (SELECT nr FROM e)) AS rows_bad
  FROM (SELECT 'orders_' || c_custkey || '.csv' AS file FROM customer) f
  LEFT JOIN o ON o.file = f.file GROUP BY f.file
),
found AS (SELECT file, count(*) AS n FROM e GROUP BY file)"""
SQL["file_verdicts"] = f"""{_CHECKED}, {_COUNTS}
SELECT counts.file, rows_total, rows_bad, coalesce(found.n, 0) AS n_errors,
       coalesce(found.n, 0) >= 50 AS report_capped,
       rows_bad = 0 AND rows_total > 0 AS valid,
       CASE WHEN NOT (rows_bad = 0 AND rows_total > 0) THEN
         rows_bad || ' von ' || rows_total || ' Zeilen fehlerhaft' ||
         CASE WHEN coalesce(found.n, 0) >= 50 THEN ' (Anzeige nach 50 Fehlern abgebrochen)' ELSE '' END
       END AS invalid_reason
FROM counts LEFT JOIN found ON found.file = counts.file"""
SQL["file_verdicts_partial"] = f"""{_CHECKED}, {_COUNTS}
SELECT file, rows_total, rows_bad, rows_total > rows_bad AS valid,
       CASE WHEN rows_total <= rows_bad THEN 'Alle ' || rows_total ||
         ' Zeilen fehlerhaft (partieller Modus, aber nichts zu laden)' END AS invalid_reason
FROM counts"""
_LINE = f"""concat_ws('|', CAST(nr AS VARCHAR),
  CASE WHEN nr % 101 = 0 THEN 'x' || c ELSE CAST(c AS VARCHAR) END,
  CASE WHEN nr % 79 = 0 THEN ' ' ELSE s END, {_PRICE},
  CASE WHEN nr % 97 = 0 THEN '2026-13-45' ELSE d END,
  CASE WHEN nr % 89 = 0 THEN NULL WHEN nr % 103 = 0 THEN '9-ODD' ELSE pr END)"""
SQL["quarantine_rows"] = f"""{_CHECKED},
g AS (
  SELECT nr, string_agg(CASE WHEN "column" IS NULL THEN reason ELSE "column" || ': ' || reason END,
                        ' | ' ORDER BY position) AS fehler_grund
  FROM e GROUP BY nr
)
SELECT o.file, o.nr AS zeile_nr, g.fehler_grund,
       (SELECT {_LINE}) AS original_zeile
FROM o JOIN g ON o.nr = g.nr""".replace("nr %", "o.nr %").replace("CAST(nr", "CAST(o.nr")
_FIRST = """arg_min(value, nr * 100 + position)"""
SQL["error_groups"] = f"""{_CHECKED},
g AS (
  SELECT "column", reason, count(*) AS n, min(nr) AS first_nr, {_FIRST} AS example,
         min(nr * 100 + position) AS first_seen
  FROM e GROUP BY "column", reason
),
r AS (SELECT *, least(row_number() OVER (ORDER BY n DESC, first_seen, reason), 6) AS place FROM g)
SELECT CAST(place AS INTEGER) AS place, CAST(sum(n) AS BIGINT) AS n, count(*) AS n_categories,
       max(CASE WHEN place <= 5 THEN "column" END) AS "column",
       max(CASE WHEN place <= 5 THEN reason END) AS reason,
       max(CASE WHEN place <= 5 THEN example END) AS example
FROM r GROUP BY place"""
SQL["error_groups_per_file"] = f"""{_CHECKED}
SELECT file, "column", reason, count(*) AS n, {_FIRST} AS example
FROM e GROUP BY file, "column", reason"""
SQL["preview"] = f"""{_CHECKED},
g AS (SELECT *, row_number() OVER (PARTITION BY file ORDER BY nr) AS rn,
             count(*) OVER (PARTITION BY file) AS total FROM o WHERE {_GOOD})
SELECT file, nr, nr AS order_key, s AS status, CAST(p AS DOUBLE) AS total,
       greatest(total - 5, 0) AS more
FROM g WHERE rn <= 5""".replace("greatest(total - 5", "greatest(g.total - 5")

# --- lineitem ----------------------------------------------------------------------------

_LINEITEM = """
SELECT l_orderkey AS order_key, l_partkey AS part_key, l_suppkey AS supp_key,
       CAST(l_linenumber AS BIGINT) AS line_number,
       CAST(CAST(l_quantity AS DECIMAL(18,2)) AS DOUBLE) AS quantity,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS price,
       CAST(CAST(l_discount AS DECIMAL(18,2)) AS DOUBLE) AS discount,
       CAST(CAST(l_tax AS DECIMAL(18,2)) AS DOUBLE) AS tax,
       l_returnflag AS return_flag, l_linestatus AS line_status,
       CAST(l_shipdate AS DATE) AS ship_date
FROM lineitem"""
SQL["parse_lineitem"] = _LINEITEM
SQL["parse_lineitem_quoted"] = _LINEITEM
SQL["decimal_de_parse"] = f"SELECT order_key, price, count(*) AS n FROM ({_LINEITEM}) GROUP BY 1, 2"
SQL["date_dmy_parse"] = f"SELECT order_key, ship_date, count(*) AS n FROM ({_LINEITEM}) GROUP BY 1, 2"
SQL["boolean_parse"] = f"""SELECT order_key, return_flag = 'R' AS returned, count(*) AS n
FROM ({_LINEITEM}) GROUP BY 1, 2"""
SQL["append_load"] = f"""SELECT return_flag, line_status, count(*) AS n,
       CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS sum_price, max(ship_date) AS last_ship_date
FROM ({_LINEITEM}) GROUP BY 1, 2"""
SQL["record_numbers"] = """SELECT count(*) AS n_lines, 1 AS least_first, 1 AS largest_first, count(*) AS sum_of_last,
       CAST(0 AS DOUBLE) AS missing FROM lineitem"""

_DE = r"^-?\d{1,3}(\.\d{3})*(,\d+)?$|^-?\d+(,\d+)?$"
_EN = r"^-?\d{1,3}(,\d{3})*(\.\d+)?$|^-?\d+(\.\d+)?$"
_ISO = r"^\d{4}-\d{2}-\d{2}$"
_DMY = r"^\d{1,2}\.\d{1,2}\.\d{4}$"
_WORDS = "('1','ja','true','y','j','0','nein','false','n')"
SQL["type_checks"] = f"""
WITH o AS (SELECT *, CAST(o_totalprice AS DECIMAL(18,2)) AS p FROM orders),
c AS (
  SELECT 'key' AS kind, CAST(o_orderkey AS VARCHAR) AS cell FROM o
  UNION ALL SELECT 'price', CAST(p AS VARCHAR) FROM o
  UNION ALL SELECT 'price_en', format('{{:,.2f}}', CAST(p AS DOUBLE)) FROM o
  UNION ALL SELECT 'date_iso', strftime(o_orderdate, '%Y-%m-%d') FROM o
  UNION ALL SELECT 'date_dmy', day(o_orderdate) || '.' || (month(o_orderdate) + o_orderkey % 4)
                               || '.' || year(o_orderdate) FROM o
  UNION ALL SELECT 'status', o_orderstatus FROM o
  UNION ALL SELECT 'flag', CAST(o_orderkey % 3 AS VARCHAR) FROM o
  UNION ALL SELECT 'control', CAST(o_orderkey AS VARCHAR) || CASE WHEN o_orderkey % 2 = 0 THEN chr(127) ELSE '' END FROM o
  UNION ALL SELECT 'umlaut', 'Müller' || CAST(o_orderkey AS VARCHAR) FROM o
)
SELECT kind, count(*) AS n, count(*) AS n_string,
  count(*) FILTER (WHERE regexp_matches(cell, '^-?\\d+$')) AS n_integer,
  count(*) FILTER (WHERE regexp_matches(cell, '{_DE}')) AS n_decimal_de,
  count(*) FILTER (WHERE regexp_matches(cell, '{_EN}')) AS n_decimal_en,
  count(*) FILTER (WHERE regexp_matches(cell, '{_DMY}')
    AND try_cast(split_part(cell, '.', 3) || '-' || lpad(split_part(cell, '.', 2), 2, '0') || '-'
                 || lpad(split_part(cell, '.', 1), 2, '0') AS DATE) IS NOT NULL) AS n_date_dmy,
  count(*) FILTER (WHERE regexp_matches(cell, '{_ISO}') AND try_cast(cell AS DATE) IS NOT NULL) AS n_date_iso,
  count(*) FILTER (WHERE lower(cell) IN {_WORDS}) AS n_boolean,
  CAST(sum(CASE WHEN regexp_matches(cell, '^-?\\d+$') THEN CAST(cell AS BIGINT) END) AS BIGINT) AS sum_integer
FROM c GROUP BY kind"""

SQL["pattern_checks"] = """
WITH c AS (
  SELECT 'word' AS kind, CASE WHEN o_orderkey % 2 = 0 THEN 'Müller' ELSE 'M ller' END || o_orderkey AS cell FROM orders
  UNION ALL SELECT 'bracket', '[' || o_orderkey || CASE WHEN o_orderkey % 3 = 0 THEN ']' ELSE '[' END FROM orders
  UNION ALL SELECT 'twice', substr(o_orderpriority, 1, 1) || (o_orderkey % 5 + 1) FROM orders
  UNION ALL SELECT 'end', o_orderkey || CASE WHEN o_orderkey % 4 = 0 THEN 'x' ELSE '' END FROM orders
)
SELECT kind, count(*) AS n, count(*) FILTER (WHERE CASE kind
    WHEN 'word' THEN regexp_full_match(cell, '[\\p{L}\\p{N}_]+')
    WHEN 'bracket' THEN regexp_full_match(cell, '\\[[0-9]+\\]')
    WHEN 'twice' THEN regexp_full_match(cell, '[0-9]{2}') AND substr(cell, 1, 1) = substr(cell, 2, 1)
    ELSE regexp_full_match(cell, '[0-9]+') END) AS n_fitting
FROM c GROUP BY kind"""

SQL["map_derived"] = """
SELECT p_partkey AS part_key, p_name AS name, p_brand AS brand, p_type AS kind,
       CAST(p_size AS BIGINT) AS size, CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DOUBLE) AS price,
       '202607' AS jahrmonat, DATE '2026-07-17' AS geladen_am,
       'part_' || (p_partkey % 10) || '.csv' AS datei
FROM part"""

# --- quoting and encodings ---------------------------------------------------------------

_SPACES = " || ".join(f"chr({c})" for c in range(0x3001) if chr(c).isspace())
_DOCUMENTS = f"""
SELECT doc_id, lang, length(body) AS n_chars, md5(body) AS digest
FROM (SELECT doc_id, lang, nullif(trim(text, {_SPACES}), '') AS body FROM documents)"""
SQL["quoted_records"] = _DOCUMENTS
SQL["spanning_records"] = _DOCUMENTS
SQL["encoding_detect"] = """
SELECT c_custkey,
       CASE c_nationkey % 3 WHEN 0 THEN 'utf-8' WHEN 1 THEN 'cp1252' ELSE 'iso-8859-1' END AS encoding,
       c_name || CASE WHEN c_nationkey % 3 = 2 THEN chr(129) ELSE '' END || 'ü' AS text
FROM customer"""

# --- classification ----------------------------------------------------------------------

_MIXED = """
mixed AS (
  SELECT 'customer_' || (c_custkey % 25) AS file, c_custkey // 25 + 1 AS nr,
         concat_ws('|', CAST(c_custkey AS VARCHAR), c_name, CAST(c_nationkey AS VARCHAR),
           CASE WHEN c_custkey % 7 = 0 THEN '12,34' ELSE CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) END,
           CASE WHEN c_custkey % 11 <> 0 THEN c_mktsegment END) AS line FROM customer
  UNION ALL
  SELECT 'supplier_' || (s_suppkey % 5), s_suppkey // 5 + 1,
         concat_ws('|', CAST(s_suppkey AS VARCHAR), s_name, CAST(s_nationkey AS VARCHAR),
           CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS VARCHAR)) FROM supplier
  UNION ALL
  SELECT 'nation', n_nationkey + 1,
         concat_ws(',', CAST(n_nationkey AS VARCHAR), n_name, CAST(n_regionkey AS VARCHAR)) FROM nation
  UNION ALL
  SELECT 'folder/part_' || (p_partkey % 10) || '.csv', p_partkey // 10 + 2,
         concat_ws(';', CAST(p_partkey AS VARCHAR), p_name, p_brand, p_type, CAST(p_size AS VARCHAR),
           CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR)) FROM part
  UNION ALL
  SELECT DISTINCT 'folder/part_' || (p_partkey % 10) || '.csv', 1,
         'part_key;name;brand;kind;size;price' FROM part
),
files AS (
  SELECT DISTINCT file FROM mixed
  UNION ALL SELECT 'region_' || r_regionkey FROM region
)"""
_INT = r"^-?\d+$"
_SOURCES = [
    ("kunden", "|", 0, [_INT, r"^Customer#\d+$", _INT, _EN, "^[A-Z]+$"]),
    ("partner", "|", 0, [None] * 5),
    ("lieferanten", "|", 0, [_INT, r"^Supplier#\d+$", _INT, _EN]),
    ("konten", "|", 0, [_INT, None, _ISO, _EN]),
    ("teile", ";", 1, [_INT, None, r"^Brand#\d+$", None, _INT, _EN]),
]


def _scored(order: int, name: str, delimiter: str, header: int, tests: list[str | None]) -> str:
    n = len(tests)
    hits = " + ".join(
        f"CAST(cells[{i}] <> '' AS INTEGER)" if t is None
        else f"CAST(regexp_matches(cells[{i}], '{t}') AS INTEGER)"
        for i, t in enumerate(tests, 1)
    )
    return f"""
SELECT f.file, '{name}' AS source, {order} AS catalog_order,
  CASE WHEN count(nr) = 0 THEN 'Datei nicht lesbar/leer'
       WHEN count(*) FILTER (WHERE nr > {header}) = 0 THEN 'Nur Header, keine Datenzeilen'
       WHEN count(*) FILTER (WHERE nr > {header} AND len(cells) = {n}) = 0
       THEN 'Spaltenanzahl ' || arg_min(len(cells), nr) FILTER (WHERE nr > {header}) || ' statt {n}'
  END AS ko_reason,
  round(CAST(sum({hits}) FILTER (WHERE nr > {header} AND len(cells) = {n}) AS DOUBLE)
        / (count(*) FILTER (WHERE nr > {header} AND len(cells) = {n}) * {n})
        * (CAST(count(*) FILTER (WHERE nr > {header} AND len(cells) = {n}) AS DOUBLE)
        / count(*) FILTER (WHERE nr > {header})), 4) AS raw_score
FROM files f
LEFT JOIN (SELECT file, nr, string_split(line, '{delimiter}') AS cells FROM mixed WHERE nr <= 20) r
  ON r.file = f.file
GROUP BY f.file"""


_SCORES = " UNION ALL ".join(_scored(i, *s) for i, s in enumerate(_SOURCES))
_RANKED = f"""WITH {_MIXED},
scores AS (
  SELECT file, source, catalog_order, ko_reason,
         CASE WHEN ko_reason IS NULL THEN raw_score ELSE 0.0 END AS score
  FROM ({_SCORES})
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY file ORDER BY score DESC, catalog_order) AS rank,
         row_number() OVER (PARTITION BY file, ko_reason IS NULL ORDER BY score DESC, catalog_order) AS place
  FROM scores
),
decided AS (
  SELECT file,
         max(source) FILTER (WHERE ko_reason IS NULL AND place = 1) AS source,
         max(score) FILTER (WHERE ko_reason IS NULL AND place = 1) AS score,
         max(score) FILTER (WHERE ko_reason IS NULL AND place = 2) AS second_score
  FROM ranked GROUP BY file
)"""
SQL["classify_files"] = f"""{_RANKED}
SELECT file, source, CAST(score AS DOUBLE) AS score, ko_reason, CAST(rank AS INTEGER) AS rank FROM ranked"""
SQL["best_source"] = f"""{_RANKED}
SELECT file, source, CAST(score AS DOUBLE) AS score,
  CASE WHEN source IS NULL THEN 'abgelehnt_unbekannt' WHEN score >= 0.9 THEN 'geladen'
       ELSE 'abgelehnt_unsicher' END AS decision,
  CASE WHEN source IS NULL THEN 'Keine Config passt zu dieser Datei'
       WHEN score < 0.9 THEN 'Kein sicherer Vorschlag (bester Score ' ||
         CAST(round_even(score * 100, 0) AS INTEGER) || '% < Schwellenwert 90%)' END AS reason
FROM decided"""
_SAFE = "score >= 0.9 AND (second_score IS NULL OR second_score < 0.9)"
SQL["unambiguous"] = f"""{_RANKED}
SELECT file, source, CAST(second_score AS DOUBLE) AS second_score,
  CASE WHEN source IS NULL THEN 'abgelehnt_unbekannt' WHEN {_SAFE} THEN 'geladen'
       ELSE 'abgelehnt_unsicher' END AS decision,
  CASE WHEN source IS NULL THEN 'kein_match' WHEN {_SAFE} THEN 'sicher' ELSE 'unsicher' END AS category
FROM decided"""
SQL["unambiguous_by_lead"] = f"""{_RANKED}
SELECT file, source,
  CASE WHEN source IS NULL THEN 'kein_match'
       WHEN score >= 0.9 AND (second_score IS NULL OR score - second_score >= 0.1) THEN 'sicher'
       ELSE 'unsicher' END AS category
FROM decided"""
SQL["category_overview"] = f"""{_RANKED}
SELECT CASE WHEN source IS NULL THEN 'kein_match' WHEN {_SAFE} THEN 'sicher' ELSE 'unsicher' END AS category,
       count(*) AS n_files
FROM decided GROUP BY 1"""
SQL["head_samples"] = f"""WITH {_MIXED}
SELECT file, count(*) AS n, arg_min(line, nr) AS first FROM mixed WHERE nr <= 20 GROUP BY file"""

# --- load modes --------------------------------------------------------------------------

_LOAD = """
r AS (
  SELECT o_custkey AS cust_key, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS priority,
         o_totalprice AS total, o_orderkey AS order_key, o_orderstatus AS st,
         CASE WHEN o_orderstatus = 'O' THEN 0 ELSE 1 END AS file_seq
  FROM orders
),
base AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY cust_key, priority ORDER BY order_key) AS rn
    FROM r WHERE st = 'F')
  WHERE rn = 1 OR priority IS NULL
),
delivered AS (
  SELECT *, row_number() OVER (PARTITION BY cust_key, priority ORDER BY file_seq, order_key) AS rn,
         row_number() OVER (PARTITION BY cust_key, priority ORDER BY file_seq DESC, order_key DESC) AS back
  FROM r WHERE st <> 'F'
),
fresh AS (
  SELECT * FROM delivered d WHERE priority IS NULL OR (rn = 1 AND NOT EXISTS (
    SELECT 1 FROM base b WHERE b.cust_key = d.cust_key AND b.priority = d.priority))
)"""
_FIELDS = "cust_key, priority, total, order_key"
SQL["upsert_skip"] = f"WITH {_LOAD} SELECT {_FIELDS} FROM base UNION ALL SELECT {_FIELDS} FROM fresh"
SQL["upsert_skip_counters"] = f"""WITH {_LOAD}
SELECT d.file_seq, coalesce(max(f.n), 0) AS loaded, count(*) - coalesce(max(f.n), 0) AS skipped
FROM delivered d LEFT JOIN (SELECT file_seq, count(*) AS n FROM fresh GROUP BY 1) f
  ON f.file_seq = d.file_seq
GROUP BY d.file_seq"""
SQL["upsert_update"] = f"""WITH {_LOAD}
SELECT {_FIELDS} FROM base b WHERE NOT EXISTS (
  SELECT 1 FROM delivered d WHERE b.cust_key = d.cust_key AND b.priority = d.priority)
UNION ALL
SELECT {_FIELDS} FROM delivered WHERE priority IS NULL OR back = 1"""

SQL["keyed_table_update"] = SQL["upsert_update"]
SQL["keyed_table_skip"] = SQL["upsert_skip"]
# Of each chain every other file loses.
SQL["reject_chain"] = """
SELECT CAST(o_orderkey AS INT) AS file_seq
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS place FROM orders) WHERE place % 2 = 0"""


def _reject() -> str:
    """The seven files settled one after another."""
    parts = ["""
rows AS (
  SELECT o_orderkey % 7 AS f, o_orderkey AS k FROM orders
  UNION ALL SELECT o_orderkey % 7 + 1, o_orderkey FROM orders WHERE o_orderkey % 15 = 0 AND o_orderkey % 7 < 6
  UNION ALL SELECT 2, o_orderkey FROM orders WHERE o_orderkey % 7 = 2 AND o_orderkey % 3 = 2
),
t0 AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 350 = 4)"""]
    for f in range(7):
        parts.append(f"""
v{f} AS (
  SELECT (SELECT count(*) FROM rows WHERE f = {f} AND k IN (SELECT k FROM t{f})) AS conflicts,
         (SELECT count(*) - count(DISTINCT k) FROM rows WHERE f = {f}) AS repeats
),
t{f + 1} AS (
  SELECT k FROM t{f}
  UNION ALL
  SELECT k FROM rows WHERE f = {f} AND (SELECT conflicts + repeats FROM v{f}) = 0
)""")
    verdicts = " UNION ALL ".join(
        f"SELECT CAST({f} AS INTEGER) AS file_seq, conflicts, repeats FROM v{f}" for f in range(7)
    )
    return f"WITH {','.join(parts)} {verdicts}"


SQL["upsert_reject"] = _reject()

# --- audit -------------------------------------------------------------------------------

_RUNS = """
runs AS (
  SELECT event_id AS id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS zeitstempel,
         'quelle_' || (user_id % 8) AS quelle,
         CASE WHEN event_type IN ('view', 'click') THEN 'geladen'
              WHEN event_type = 'purchase' THEN 'abgelehnt_ungueltig'
              WHEN event_type = 'signup' THEN 'abgelehnt_unsicher'
              ELSE 'abgelehnt_unbekannt' END AS status,
         CAST(floor(value) AS BIGINT) AS zeilen_geladen
  FROM events
)"""
SQL["run_stats"] = f"WITH {_RUNS} SELECT status, count(*) AS n_files FROM runs GROUP BY 1"
SQL["loaded_and_rejected"] = f"""WITH {_RUNS}
SELECT count(*) FILTER (WHERE status = 'geladen') AS loaded,
       count(*) FILTER (WHERE status <> 'geladen') AS rejected FROM runs"""
SQL["latest_runs"] = f"WITH {_RUNS} SELECT * FROM runs ORDER BY id DESC LIMIT 20"
SQL["monthly_loads"] = f"""WITH {_RUNS}
SELECT substr(zeitstempel, 1, 7) AS month, count(*) AS n_files,
       CAST(sum(zeilen_geladen) AS BIGINT) AS n_rows
FROM runs WHERE status = 'geladen' GROUP BY 1"""
SQL["rejects_per_source"] = f"""WITH {_RUNS}
SELECT quelle, count(*) FILTER (WHERE status <> 'geladen') AS n_rejected, count(*) AS n_files
FROM runs GROUP BY 1"""
_HASHED = "h AS (SELECT doc_id, lang, sha256(text) AS dateihash FROM documents)"
_KNOWN = "dateihash IN (SELECT dateihash FROM h WHERE lang IN ('de', 'en'))"
SQL["already_loaded"] = f"WITH {_HASHED} SELECT dateihash, doc_id FROM h WHERE {_KNOWN}"
SQL["not_yet_loaded"] = f"WITH {_HASHED} SELECT dateihash, doc_id FROM h WHERE NOT {_KNOWN}"

_NAME = "list_extract(string_split(url, '/'), -1)"
_STAMPED = (
    f"CASE WHEN contains({_NAME}, '.') THEN "
    rf"regexp_replace({_NAME}, '^(.*)\.([^.]*)$', '\1{STAMP}.\2') ELSE {_NAME} || '{STAMP}' END"
)
SQL["disposition_paths"] = f"""
SELECT page_id, 'archive/q' || (page_id % 4) || '/' || {_STAMPED} AS archive_path,
       'reject/' || {_STAMPED} AS reject_path,
       'reject/' || page_id || '.csv_fehlerhaft{STAMP}.csv' AS quarantine_path
FROM pages"""

# --- catalogs ----------------------------------------------------------------------------

_CATALOG = """
cols AS (SELECT CAST(l_orderkey AS VARCHAR) AS source, l_linenumber - 1 AS position,
                CAST(l_partkey AS VARCHAR) AS name FROM lineitem),
rules AS (SELECT CAST(l_orderkey AS VARCHAR) AS source, CAST(l_suppkey AS VARCHAR) AS target,
                 CAST(l_partkey + CASE WHEN l_quantity > 45 THEN 1 ELSE 0 END AS VARCHAR) AS col FROM lineitem),
keys AS (SELECT CAST(l_orderkey AS VARCHAR) AS source,
                CAST(l_suppkey + CASE WHEN l_discount > 0.09 THEN 1000000 ELSE 0 END AS VARCHAR) AS key_field
         FROM lineitem),
g AS (SELECT source, count(*) AS n, min(position) AS lo, max(position) AS hi,
             count(DISTINCT position) AS np, count(DISTINCT name) AS nn FROM cols GROUP BY source),
problems AS (
  SELECT source, 'POSITION_GAP' AS problem, NULL AS detail FROM g WHERE lo <> 0 OR hi + 1 <> n OR np <> n
  UNION ALL SELECT source, 'DUPLICATE_NAME', NULL FROM g WHERE nn <> n
  UNION ALL SELECT source, 'DANGLING_RULE', col FROM rules r
    WHERE NOT EXISTS (SELECT 1 FROM cols c WHERE c.source = r.source AND c.name = r.col)
  UNION ALL SELECT source, 'KEY_NOT_A_TARGET', key_field FROM keys k
    WHERE NOT EXISTS (SELECT 1 FROM rules r WHERE r.source = k.source AND r.target = k.key_field)
  UNION ALL SELECT source, 'DUPLICATE_TARGET', target FROM rules GROUP BY source, target HAVING count(*) > 1
)"""
SQL["catalog_checks"] = f"WITH {_CATALOG} SELECT source, problem, CAST(detail AS VARCHAR) AS detail FROM problems"
SQL["usable_sources"] = f"""WITH {_CATALOG}
SELECT CAST(o_orderkey AS VARCHAR) AS source FROM orders
WHERE CAST(o_orderkey AS VARCHAR) NOT IN (SELECT source FROM problems)"""
SQL["catalog_overview"] = f"""WITH {_CATALOG}
SELECT CAST(o_orderkey AS VARCHAR) AS source, g.n AS n_columns, '|' AS delimiter,
       o_orderstatus = 'F' AS has_header, o_orderpriority AS target
FROM orders LEFT JOIN g ON g.source = CAST(o_orderkey AS VARCHAR)"""

# --- whole pipelines ---------------------------------------------------------------------


def _totals(name: str, tbl: str) -> str:
    return (
        f"SELECT '{name}' AS quelle, 'geladen' AS status, count(*) AS zeilen_gesamt, "
        f"count(*) AS zeilen_geladen, CAST(0 AS BIGINT) AS zeilen_uebersprungen, "
        f"CAST(0 AS BIGINT) AS zeilen_quarantaene FROM {tbl}"
    )


SQL["inbox_run"] = f"""{_CHECKED}
{_totals('kunden', 'customer')} UNION ALL {_totals('lieferanten', 'supplier')}
UNION ALL {_totals('teile', 'part')}
UNION ALL SELECT 'orders', 'geladen', count(*), count(*) FILTER (WHERE {_GOOD}), 0,
                 count(*) FILTER (WHERE NOT ({_GOOD})) FROM o"""
SQL["inbox_stream"] = SQL["inbox_run"]
SQL["inbox_redelivered"] = """
SELECT 'erste' AS benutzer_modus, 'geladen' AS status, count(*) AS zeilen_geladen, 0 AS ohne_hash FROM lineitem WHERE l_orderkey % 2 = 0
UNION ALL SELECT 'zweite', 'abgelehnt_wiederholt', 0, 0
UNION ALL SELECT 'zweite', 'geladen', count(*), 0 FROM lineitem WHERE l_orderkey % 2 = 1
UNION ALL SELECT 'tabelle', '', count(*), 0 FROM lineitem"""
SQL["stream_redelivered"] = SQL["inbox_redelivered"]
SQL["inbox_loaded_orders"] = SQL["load_good_orders"]
SQL["archive_expand"] = """
WITH l AS (
  SELECT l_orderkey AS k, concat_ws('|', l_orderkey, l_partkey, l_suppkey,
    l_linenumber, CAST(l_quantity AS DECIMAL(18,2)), CAST(l_extendedprice AS DECIMAL(18,2)),
    CAST(l_discount AS DECIMAL(18,2)), CAST(l_tax AS DECIMAL(18,2)), l_returnflag, l_linestatus,
    strftime(l_shipdate, '%Y-%m-%d')) AS line
  FROM lineitem
),
i AS (
  SELECT k, count(*) AS n, sum(length(line)) AS chars, sum(CAST('0x' || md5(line)[1:8] AS BIGINT)) AS digest
  FROM l GROUP BY k
),
o AS (
  SELECT o_orderkey, concat_ws('|', o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)),
    strftime(o_orderdate, '%Y-%m-%d'), o_orderpriority) AS line
  FROM orders
)
SELECT 'order_' || o_orderkey AS archive, 'orders.csv' AS member, length(line) AS size, 1 AS n_lines,
       CAST('0x' || md5(line)[1:8] AS BIGINT) AS digest
FROM o
UNION ALL
SELECT 'order_' || o_orderkey, 'teile.zip/items.csv', CAST(coalesce(chars + n - 1, 0) AS BIGINT), coalesce(n, 0),
       CAST(coalesce(digest, 0) AS BIGINT)
FROM orders LEFT JOIN i ON i.k = o_orderkey"""
SQL["archive_run"] = """
SELECT 'kunden' AS quelle, 'geladen' AS status, count(*) AS zeilen_gesamt, count(*) AS zeilen_geladen,
       CAST(0 AS BIGINT) AS zeilen_uebersprungen, CAST(0 AS BIGINT) AS zeilen_quarantaene FROM customer
UNION ALL
SELECT NULL, 'abgelehnt_unbekannt', 0, 0, 0, 0"""

SQL["archive_refused"] = """
WITH b AS (SELECT c_custkey // 100 AS block, count(*) AS n FROM customer GROUP BY 1)
SELECT 'kunden_' || block || '.zip/orders.csv' AS file, 'geladen' AS status, n AS zeilen_geladen, false AS refused
FROM b WHERE block % 3 <> 2
UNION ALL SELECT 'kunden_' || block || '.zip/teile.zip/items.csv', 'abgelehnt_unbekannt', 0, false FROM b WHERE block % 3 <> 2
UNION ALL SELECT 'kunden_' || block || '.zip', 'abgelehnt_unbekannt', 0, true FROM b WHERE block % 3 = 2"""
