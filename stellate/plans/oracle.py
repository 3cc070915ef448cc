"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each text runs against views named after the provided tables.  Integers are
BIGINT, money DECIMAL(19,4), dates DATE -- the same as the Spark side.
"""

from __future__ import annotations

# ---------------------------------------------------------------- shared fixtures (FIXTURES.md section 4)

SRC = """src AS (
  SELECT c_custkey AS k, c_name AS nm,
         CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_mktsegment END AS addr
  FROM customer)"""

PREV = """prev AS (
  SELECT c_custkey AS k, c_name AS nm,
         CASE WHEN c_custkey % 11 = 0 THEN NULL
              WHEN c_custkey % 7 = 0 THEN concat('OLD_', c_mktsegment)
              ELSE c_mktsegment END AS addr
  FROM customer WHERE c_custkey % 10 <> 0
  UNION ALL
  SELECT c_custkey + 1000000, c_name, c_mktsegment FROM customer WHERE c_custkey % 13 = 0)"""

HIST = """hist AS (
  SELECT k, nm, addr, true AS is_current, DATE '2001-01-01' AS effective_date,
         CAST(NULL AS DATE) AS ineffective_date FROM prev
  UNION ALL
  SELECT k, nm, 'HIST', false, DATE '2000-01-01', DATE '2000-12-31' FROM prev WHERE k % 5 = 1)"""

HIST_J = """hj AS (
  SELECT coalesce(h.k, s.k) AS k, h.nm AS t_nm, h.addr AS t_addr, h.is_current, h.effective_date,
         h.ineffective_date, s.nm AS s_nm, s.addr AS s_addr,
         CASE WHEN h.k IS NULL THEN 'INSERT' WHEN s.k IS NULL THEN 'DELETE'
              WHEN h.is_current AND (coalesce(h.nm, '') <> coalesce(s.nm, '')
                                     OR coalesce(h.addr, '') <> coalesce(s.addr, '')) THEN 'UPDATE'
              ELSE 'KEEP' END AS merge_action
  FROM hist h FULL OUTER JOIN src s ON h.k = s.k)"""

BRIDGE = """bridge AS (
  SELECT s_suppkey, n_nationkey FROM supplier JOIN nation ON (s_suppkey + n_nationkey) % 5 = 0)"""

EMP = """emp AS (
  SELECT s_suppkey AS employee_id, s_name AS last_name, s_nationkey AS nation_id,
         CAST(s_acctbal AS DECIMAL(19,4)) AS acctbal,
         encode(concat_ws('|', s_name, s_name, CAST(s_nationkey AS VARCHAR))) AS photo,
         CASE WHEN s_suppkey % 10 = 0 THEN NULL
              WHEN s_suppkey % 17 = 0 THEN s_suppkey + 1000000
              ELSE s_suppkey - s_suppkey % 10 END AS reports_to
  FROM supplier)"""

ONULL = """onull AS (
  SELECT o_orderkey,
         CASE WHEN o_orderkey % 19 = 0 THEN NULL
              WHEN o_orderkey % 23 = 0 THEN o_custkey + 9000000 ELSE o_custkey END AS o_custkey
  FROM orders)"""

RAW = """raw AS (
  SELECT CASE WHEN o_orderkey % 31 = 0 THEN concat('x', CAST(o_orderkey AS VARCHAR))
              ELSE CAST(o_orderkey AS VARCHAR) END AS k,
         CASE WHEN o_orderkey % 11 = 0 THEN 'nan' WHEN o_orderkey % 29 = 0 THEN 'bad'
              ELSE CAST(o_custkey AS VARCHAR) END AS cust,
         CASE WHEN o_orderkey % 13 = 0 THEN 'NaT' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS od,
         CASE WHEN o_orderstatus = 'F' THEN 'True' ELSE 'False' END AS fin
  FROM orders)"""

DIMS = """dim_c AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS customer_key FROM customer),
cats AS (SELECT p_type AS category_name, row_number() OVER (ORDER BY p_type) AS category_id
         FROM (SELECT DISTINCT p_type FROM part)),
dim_p AS (SELECT p.*, row_number() OVER (ORDER BY p_partkey) AS product_key FROM part p),
dim_e AS (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) AS employee_key FROM supplier),
dim_s AS (SELECT shipper_id, row_number() OVER (ORDER BY shipper_id) AS shipper_key
          FROM (SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS shipper_id FROM orders)),
dim_t AS (SELECT CAST(n_nationkey AS BIGINT) AS territory_id, n_name AS description,
                 CAST(n_regionkey AS BIGINT) AS region_id,
                 row_number() OVER (ORDER BY n_nationkey) AS territory_key FROM nation)"""

TERR_OK = """terr_ok AS (
  SELECT DISTINCT b.s_suppkey FROM bridge b JOIN nation n ON b.n_nationkey = n.n_nationkey
  WHERE n.n_regionkey IN (SELECT r_regionkey FROM region))"""


def _with(*ctes):
    return "WITH " + ",\n".join(ctes) + "\n"


def dk(c):
    return f"CAST(year({c}) * 10000 + month({c}) * 100 + day({c}) AS BIGINT)"


FACT = _with(DIMS, BRIDGE, TERR_OK) + f"""
SELECT l.l_orderkey AS order_id, CAST(l.l_linenumber AS BIGINT) AS line_number,
       dc.customer_key, de.employee_key, dp.product_key, ds.shipper_key,
       {dk('o.o_orderdate')} AS order_date_key, {dk('l.l_shipdate')} AS ship_date_key,
       CAST(l.l_quantity AS BIGINT) AS quantity, CAST(l.l_extendedprice AS DECIMAL(19,4)) AS line_price,
       CAST(dp.p_retailprice AS DECIMAL(19,4)) AS list_price, l.l_discount AS discount
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN dim_c dc ON o.o_custkey = dc.c_custkey
JOIN dim_p dp ON l.l_partkey = dp.p_partkey
JOIN cats ON dp.p_type = cats.category_name
JOIN dim_e de ON l.l_suppkey = de.s_suppkey
JOIN dim_s ds ON CAST(substr(o.o_orderpriority, 1, 1) AS BIGINT) = ds.shipper_id
WHERE l.l_suppkey IN (SELECT s_suppkey FROM terr_ok)"""

FANOUT = _with(BRIDGE) + f"""
SELECT l.l_orderkey AS order_id, CAST(l.l_linenumber AS BIGINT) AS line_number, l.l_suppkey AS employee_id,
       CAST(n.n_nationkey AS BIGINT) AS territory_id, CAST(r.r_regionkey AS BIGINT) AS region_id,
       {dk('o.o_orderdate')} AS order_date_key, CAST(l.l_quantity AS BIGINT) AS quantity
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN bridge b ON l.l_suppkey = b.s_suppkey
JOIN nation n ON b.n_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey"""

def dn(c):
    return (f"CAST(datediff('day', DATE '1900-01-01', CAST({c} AS DATE)) "
            f"+ CASE WHEN hour({c}) >= 12 THEN 1 ELSE 0 END AS BIGINT)")


FACT_COMPAT = _with(DIMS, BRIDGE) + f"""
SELECT l.l_orderkey AS order_id, dc.customer_key, l.l_suppkey AS employee_key,
       {dn('o.o_orderdate')} AS order_date_key, {dn('l.l_shipdate')} AS shipped_date,
       ds.shipper_id AS shipper_key, l.l_partkey AS product_key,
       CAST(p.p_retailprice AS DECIMAL(19,4)) AS unit_price, CAST(l.l_quantity AS BIGINT) AS quantity,
       l.l_discount AS discount
FROM region r
JOIN nation n ON r.r_regionkey = n.n_regionkey
JOIN bridge b ON n.n_nationkey = b.n_nationkey
JOIN supplier e ON e.s_suppkey = b.s_suppkey
JOIN lineitem l ON l.l_suppkey = e.s_suppkey
JOIN orders o ON o.o_orderkey = l.l_orderkey
JOIN dim_s ds ON CAST(substr(o.o_orderpriority, 1, 1) AS BIGINT) = ds.shipper_id
JOIN dim_c dc ON o.o_custkey = dc.c_custkey
JOIN part p ON l.l_partkey = p.p_partkey
JOIN cats ON p.p_type = cats.category_name"""

KEY_LOOKUP = _with(DIMS) + f"""
SELECT o.o_orderkey AS order_id, dc.customer_key, ds.shipper_key, {dk('o.o_orderdate')} AS order_date_key
FROM orders o JOIN dim_c dc ON o.o_custkey = dc.c_custkey
JOIN dim_s ds ON CAST(substr(o.o_orderpriority, 1, 1) AS BIGINT) = ds.shipper_id"""

SEMI = """
SELECT l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS line_number, l_partkey AS part_id,
       l_suppkey AS supplier_id
FROM lineitem
WHERE EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = l_suppkey)
  AND EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey
              AND p_type IN (SELECT DISTINCT p_type FROM part))"""

UNMATCHED = _with(ONULL) + """
SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id,
       CASE WHEN o.o_custkey IS NULL THEN 'NULL_KEY' ELSE 'ORPHAN' END AS reason
FROM onull o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
WHERE c.c_custkey IS NULL"""

LINE_COLS = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, "
             "l_tax, l_returnflag, l_linestatus, l_shipdate")

APPEND = f"""WITH existing AS (SELECT {LINE_COLS} FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01'),
batch AS (SELECT {LINE_COLS} FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01')
SELECT *, 'existing' AS load_batch FROM existing
UNION ALL
SELECT *, 'appended' AS load_batch FROM (SELECT * FROM batch EXCEPT ALL SELECT * FROM existing)"""

DAY_NUMBER = """
SELECT event_id, ts,
       CAST(datediff('day', DATE '1900-01-01', CAST(ts AS DATE)) + CASE WHEN hour(ts) >= 12 THEN 1 ELSE 0 END
            AS BIGINT) AS day_number,
       CAST(datediff('day', DATE '1900-01-01', CAST(ts AS DATE)) AS BIGINT) AS day_diff
FROM events"""

DATE_KEYS = f"""
SELECT o_orderkey AS order_id, CAST(year(o_orderdate) AS BIGINT) AS year,
       CAST(month(o_orderdate) AS BIGINT) AS month, CAST(day(o_orderdate) AS BIGINT) AS day,
       {dk('o_orderdate')} AS date_key, strftime(o_orderdate, '%Y%m%d') AS date_key_str,
       strftime(CAST(o_orderdate AS DATE) - INTERVAL 1 DAY, '%Y%m%d') AS prev_day_key_str,
       CAST(year(o_orderdate) * 1000 + month(o_orderdate) * 100 + day(o_orderdate) AS BIGINT) AS run_stamp_compat
FROM orders"""


def calendar_sql(days_from: str) -> str:
    return f"""
SELECT {dk('d')} AS date_key, d AS date, CAST(day(d) AS BIGINT) AS day, CAST(month(d) AS BIGINT) AS month,
       CAST(quarter(d) AS BIGINT) AS quarter, CAST(year(d) AS BIGINT) AS year, monthname(d) AS month_name,
       CAST((dayofyear(d) - 1 + dayofweek(date_trunc('year', d))) // 7 + 1 AS BIGINT) AS week_of_year,
       CAST((day(d) - 1) // 7 + 1 AS BIGINT) AS week_of_month, CAST(day(d) AS BIGINT) AS day_of_month,
       CAST(dayofyear(d) AS BIGINT) AS day_of_year
FROM ({days_from})"""


CALENDAR_DAYS = """SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM (
  SELECT min(d0) AS lo, max(d1) AS hi FROM (
    SELECT min(CAST(o_orderdate AS DATE)) AS d0, max(CAST(o_orderdate AS DATE)) AS d1 FROM orders
    UNION ALL
    SELECT min(CAST(l_shipdate AS DATE)), max(CAST(l_shipdate AS DATE)) FROM lineitem))"""

CALENDAR = calendar_sql(CALENDAR_DAYS)

MATCHED = _with(SRC, PREV) + """
SELECT p.k, {expr} AS changed FROM prev p JOIN src s ON p.k = s.k"""

CHANGE_SENTINEL = MATCHED.format(
    expr="(coalesce(p.nm, '') <> coalesce(s.nm, '') OR coalesce(p.addr, '') <> coalesce(s.addr, ''))")
CHANGE_SQL = MATCHED.format(expr="coalesce(p.nm <> s.nm OR p.addr <> s.addr, false)")
CHANGE_NULLSAFE = MATCHED.format(expr="(p.nm IS DISTINCT FROM s.nm OR p.addr IS DISTINCT FROM s.addr)")

CHANGE_BINARY = """WITH d AS (
  SELECT doc_id, encode(text) AS t,
         encode(CASE WHEN doc_id % 5 = 0 THEN concat('[rev] ', text)
                     WHEN doc_id % 3 = 0 THEN concat(text, ' [rev]') ELSE text END) AS s
  FROM documents)
SELECT doc_id, coalesce(left(hex(t), 60), '') <> coalesce(left(hex(s), 60), '') AS prefix_changed,
       sha256(t) IS DISTINCT FROM sha256(s) AS digest_changed
FROM d"""

MERGE_ACTIONS = _with(SRC, PREV) + """
SELECT coalesce(p.k, s.k) AS k,
       CASE WHEN p.k IS NULL THEN 'INSERT' WHEN s.k IS NULL THEN 'DELETE'
            WHEN coalesce(p.nm, '') <> coalesce(s.nm, '') OR coalesce(p.addr, '') <> coalesce(s.addr, '')
            THEN 'UPDATE' ELSE 'KEEP' END AS merge_action,
       p.nm AS t_nm, p.addr AS t_addr, s.nm AS s_nm, s.addr AS s_addr
FROM prev p FULL OUTER JOIN src s ON p.k = s.k"""

MERGE_CAST_KEY = _with(PREV) + """, st AS (
  SELECT CASE WHEN c_custkey % 37 = 0 THEN concat('C', CAST(c_custkey AS VARCHAR))
              ELSE lpad(CAST(c_custkey AS VARCHAR), 8, '0') END AS k_text FROM customer)
SELECT st.k_text, try_cast(st.k_text AS BIGINT) AS k,
       CASE WHEN try_cast(st.k_text AS BIGINT) IS NULL THEN 'REJECT'
            WHEN p.k IS NOT NULL THEN 'MATCH' ELSE 'NEW' END AS status
FROM st LEFT JOIN prev p ON p.k = try_cast(st.k_text AS BIGINT)"""

SCD1 = _with(SRC, PREV) + """, j AS (
  SELECT coalesce(p.k, s.k) AS k, p.nm AS t_nm, p.addr AS t_addr, s.nm AS s_nm, s.addr AS s_addr,
         CASE WHEN p.k IS NULL THEN 'INSERT' WHEN s.k IS NULL THEN 'DELETE'
              WHEN coalesce(p.nm, '') <> coalesce(s.nm, '') OR coalesce(p.addr, '') <> coalesce(s.addr, '')
              THEN 'UPDATE' ELSE 'KEEP' END AS a
  FROM prev p FULL OUTER JOIN src s ON p.k = s.k)
SELECT k, CASE WHEN a IN ('INSERT', 'UPDATE') THEN s_nm ELSE t_nm END AS nm,
       CASE WHEN a IN ('INSERT', 'UPDATE') THEN s_addr ELSE t_addr END AS addr
FROM j WHERE a <> 'DELETE'"""

SCD2_BODY = _with(SRC, PREV, HIST, HIST_J)

SCD2 = SCD2_BODY + """
SELECT k, t_nm AS nm, t_addr AS addr,
       CASE WHEN merge_action = 'UPDATE' THEN false ELSE is_current END AS is_current,
       effective_date,
       CASE WHEN merge_action = 'UPDATE' THEN DATE '2001-12-31' ELSE ineffective_date END AS ineffective_date
FROM hj WHERE merge_action <> 'INSERT'
UNION ALL
SELECT k, s_nm, s_addr, true, DATE '2002-01-01', CAST(NULL AS DATE)
FROM hj WHERE merge_action IN ('INSERT', 'UPDATE')"""

SCD2_EXPIRE = SCD2_BODY + """
SELECT k, t_nm AS nm, t_addr AS addr, false AS is_current, effective_date,
       DATE '2001-12-31' AS ineffective_date
FROM hj WHERE merge_action = 'UPDATE'"""

SCD2_NEW = SCD2_BODY + """
SELECT k, s_nm AS nm, s_addr AS addr, true AS is_current, DATE '2002-01-01' AS effective_date,
       CAST(NULL AS DATE) AS ineffective_date
FROM hj WHERE merge_action = 'UPDATE'"""

SCD2_FEED = SCD2_BODY + """
SELECT k, s_nm AS nm, s_addr AS addr, merge_action FROM hj WHERE merge_action IN ('INSERT', 'UPDATE')"""

SCD2_FEED_FULL = SCD2_BODY + """
SELECT k, s_nm AS nm, s_addr AS addr, merge_action FROM hj
WHERE merge_action IN ('INSERT', 'UPDATE') OR (merge_action = 'DELETE' AND is_current)"""

# the second source changes every 3rd key again, under the same date: versions
# that the first load opened get the value, older ones are closed as usual
SCD2_SAME_DAY = f"""WITH once AS ({SCD2}),
src2 AS (SELECT c_custkey AS k, c_name AS nm,
                CASE WHEN c_custkey % 3 = 0 THEN concat(coalesce(addr, ''), '!') ELSE addr END AS addr
         FROM (SELECT c_custkey, c_name, CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_mktsegment END AS addr FROM customer)),
j2 AS (SELECT o.*, s.nm AS s_nm, s.addr AS s_addr,
              o.is_current AND s.k IS NOT NULL
              AND (coalesce(o.nm, '') <> coalesce(s.nm, '') OR coalesce(o.addr, '') <> coalesce(s.addr, '')) AS upd,
              o.effective_date >= DATE '2002-01-01' AS same_day
       FROM once o LEFT JOIN src2 s ON o.k = s.k)
SELECT k, CASE WHEN upd AND same_day THEN s_nm ELSE nm END AS nm, CASE WHEN upd AND same_day THEN s_addr ELSE addr END AS addr,
       CASE WHEN upd AND NOT same_day THEN false ELSE is_current END AS is_current, effective_date,
       CASE WHEN upd AND NOT same_day THEN DATE '2001-12-31' ELSE ineffective_date END AS ineffective_date
FROM j2
UNION ALL
SELECT k, s_nm, s_addr, true, DATE '2002-01-01', CAST(NULL AS DATE) FROM j2 WHERE upd AND NOT same_day"""

SCD2_CURRENT = f"SELECT * FROM ({SCD2}) WHERE is_current"

SCD2_VERSION_KEYS = _with(SRC, PREV, HIST) + """, hsk AS (
  SELECT h.*, row_number() OVER (ORDER BY k, effective_date) AS version_key FROM hist h),
vj AS (
  SELECT coalesce(h.k, s.k) AS k, h.nm AS t_nm, h.addr AS t_addr, h.is_current, h.effective_date,
         h.ineffective_date, h.version_key, s.nm AS s_nm, s.addr AS s_addr,
         CASE WHEN h.k IS NULL THEN 'INSERT' WHEN s.k IS NULL THEN 'DELETE'
              WHEN h.is_current AND (coalesce(h.nm, '') <> coalesce(s.nm, '')
                                     OR coalesce(h.addr, '') <> coalesce(s.addr, '')) THEN 'UPDATE'
              ELSE 'KEEP' END AS merge_action
  FROM hsk h FULL OUTER JOIN src s ON h.k = s.k)
SELECT k, t_nm AS nm, t_addr AS addr,
       CASE WHEN merge_action = 'UPDATE' THEN false ELSE is_current END AS is_current, effective_date,
       CASE WHEN merge_action = 'UPDATE' THEN DATE '2001-12-31' ELSE ineffective_date END AS ineffective_date,
       CAST(version_key AS BIGINT) AS version_key
FROM vj WHERE merge_action <> 'INSERT'
UNION ALL
SELECT k, s_nm, s_addr, true, DATE '2002-01-01', CAST(NULL AS DATE),
       CAST((SELECT max(version_key) FROM hsk) + row_number() OVER (ORDER BY k) AS BIGINT)
FROM vj WHERE merge_action IN ('INSERT', 'UPDATE')"""


def scd2_generic(target_cte: str, source_cte: str, key: str, tracked: list, other_cols: list,
                 tracked_sentinels: dict, out_map: dict | None = None, out_alias: dict | None = None) -> str:
    """SCD2 over arbitrary target/source CTEs named ``tgt`` and ``srcx``.

    ``other_cols`` are target columns carried from the target (old image) and
    taken from the source in the new version; ``tracked_sentinels`` gives the
    empty value per tracked column."""
    out_map = out_map or {}
    out_alias = out_alias or {}
    change = " OR ".join(
        f"coalesce(t.{c}, {tracked_sentinels[c]}) <> coalesce(s.{c}, {tracked_sentinels[c]})"
        if tracked_sentinels[c] is not None else f"t.{c} IS DISTINCT FROM s.{c}"
        for c in tracked)
    cols = other_cols
    sel_t = ", ".join(f"t.{c} AS t_{c}" for c in cols)
    sel_s = ", ".join(f"s.{c} AS s_{c}" for c in cols)
    j = f"""j AS (
  SELECT coalesce(t.{key}, s.{key}) AS {key}, {sel_t}, {sel_s}, t.is_current, t.effective_date, t.ineffective_date,
         CASE WHEN t.{key} IS NULL THEN 'INSERT' WHEN s.{key} IS NULL THEN 'DELETE'
              WHEN t.is_current AND ({change}) THEN 'UPDATE' ELSE 'KEEP' END AS a
  FROM tgt t FULL OUTER JOIN srcx s ON t.{key} = s.{key})"""
    old = ", ".join(out_map.get(c, "{}").format(f"t_{c}") + f" AS {out_alias.get(c, c)}" for c in cols)
    new = ", ".join(out_map.get(c, "{}").format(f"s_{c}") + f" AS {out_alias.get(c, c)}" for c in cols)
    return f"""WITH {target_cte},
{source_cte},
{j}
SELECT {key}, {old}, CASE WHEN a = 'UPDATE' THEN false ELSE is_current END AS is_current, effective_date,
       CASE WHEN a = 'UPDATE' THEN DATE '2001-12-31' ELSE ineffective_date END AS ineffective_date
FROM j WHERE a <> 'INSERT'
UNION ALL
SELECT {key}, {new}, true, DATE '2002-01-01', CAST(NULL AS DATE) FROM j WHERE a IN ('INSERT', 'UPDATE')"""


SCD2_REGION = scd2_generic(
    """tgt AS (
  SELECT CAST(r_regionkey AS BIGINT) AS region_id,
         CASE WHEN r_regionkey % 2 = 0 THEN concat('OLD_', r_name) ELSE r_name END AS description,
         true AS is_current, DATE '2001-01-01' AS effective_date, CAST(NULL AS DATE) AS ineffective_date
  FROM region WHERE r_regionkey <> (SELECT max(r_regionkey) FROM region))""",
    """srcx AS (SELECT CAST(r_regionkey AS BIGINT) AS region_id, r_name AS description FROM region)""",
    "region_id", ["description"], ["description"], {"description": "''"})

SCD2_TERRITORY = scd2_generic(
    """tgt AS (
  SELECT CAST(n_nationkey AS BIGINT) AS territory_id,
         CASE WHEN n_nationkey % 3 = 0 THEN concat('OLD_', n_name) ELSE n_name END AS description,
         CAST(CASE WHEN n_nationkey % 4 = 0 THEN (n_regionkey + 1) % 5 ELSE n_regionkey END AS BIGINT) AS region_id,
         true AS is_current, DATE '2001-01-01' AS effective_date, CAST(NULL AS DATE) AS ineffective_date
  FROM nation WHERE n_nationkey % 7 <> 6)""",
    """srcx AS (
  SELECT try_cast(lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS BIGINT) AS territory_id, n_name AS description,
         CAST(n_regionkey AS BIGINT) AS region_id
  FROM nation WHERE try_cast(lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS BIGINT) IS NOT NULL)""",
    "territory_id", ["description", "region_id"], ["description", "region_id"],
    {"description": "''", "region_id": "0"})

SCD2_EMPLOYEE = scd2_generic(
    EMP + """,
tgt AS (
  SELECT employee_id,
         CASE WHEN employee_id % 4 = 0 THEN concat('OLD_', last_name) ELSE last_name END AS last_name,
         nation_id,
         CAST(CASE WHEN employee_id % 9 = 0 THEN acctbal + CAST(1 AS DECIMAL(19,4)) ELSE acctbal END
              AS DECIMAL(19,4)) AS acctbal,
         CASE WHEN employee_id % 6 = 0 THEN photo || encode('X') ELSE photo END AS photo,
         reports_to, true AS is_current, DATE '2001-01-01' AS effective_date, CAST(NULL AS DATE) AS ineffective_date
  FROM emp WHERE employee_id % 10 <> 3)""",
    """srcx AS (SELECT * FROM emp)""",
    "employee_id", ["last_name", "nation_id", "acctbal", "photo", "reports_to"],
    ["last_name", "nation_id", "acctbal", "photo", "reports_to"],
    {"last_name": "''", "nation_id": "0", "acctbal": "CAST(0 AS DECIMAL(19,4))", "photo": None,
     "reports_to": "0"},
    out_map={"photo": "sha256({})"}, out_alias={"photo": "photo_sha256"})

PREV3 = """prev3 AS (
  SELECT k, nm, addr, CASE WHEN k % 3 = 0 THEN 'PREV_ADDR' END AS addr_prev,
         CASE WHEN k % 3 = 0 THEN '20000101' END AS addr_prev_validto, k * 10 AS customer_key FROM prev)"""

SCD3 = _with(SRC, PREV, PREV3) + """, j AS (
  SELECT coalesce(p.k, s.k) AS k, p.nm AS t_nm, p.addr AS t_addr, p.addr_prev, p.addr_prev_validto, p.customer_key,
         s.nm AS s_nm, s.addr AS s_addr,
         CASE WHEN p.k IS NULL THEN 'INSERT' WHEN s.k IS NULL THEN 'DELETE'
              WHEN coalesce(p.nm <> s.nm OR p.addr <> s.addr, false) THEN 'UPDATE' ELSE 'KEEP' END AS a
  FROM prev3 p FULL OUTER JOIN src s ON p.k = s.k)
SELECT k,
       CASE WHEN a IN ('INSERT', 'UPDATE') THEN s_nm ELSE t_nm END AS nm,
       CASE WHEN a IN ('INSERT', 'UPDATE') THEN s_addr ELSE t_addr END AS addr,
       CASE WHEN a = 'INSERT' THEN NULL WHEN a = 'UPDATE' AND coalesce(t_addr <> s_addr, false) THEN t_addr
            ELSE addr_prev END AS addr_prev,
       CASE WHEN a = 'INSERT' THEN NULL WHEN a = 'UPDATE' AND coalesce(t_addr <> s_addr, false) THEN '20011231'
            ELSE addr_prev_validto END AS addr_prev_validto,
       CAST(coalesce(customer_key, (SELECT max(customer_key) FROM prev3)
                     + row_number() OVER (PARTITION BY customer_key IS NULL ORDER BY k)) AS BIGINT) AS customer_key
FROM j"""

SCD4 = """WITH cur AS (
  SELECT p_partkey AS product_id, p_name AS product_name, CAST(p_retailprice AS DECIMAL(19,4)) AS unit_price,
         p_type AS category_name, DATE '2001-01-01' AS valid_from, p_partkey * 10 AS product_key
  FROM part WHERE p_partkey % 9 <> 0),
srcx AS (
  SELECT p_partkey AS product_id,
         CASE WHEN p_partkey % 11 = 0 THEN concat(p_name, ' v2') ELSE p_name END AS product_name,
         CAST(CAST(p_retailprice AS DECIMAL(19,4))
              + CAST(CASE WHEN p_partkey % 7 = 0 THEN 1 ELSE 0 END AS DECIMAL(19,4)) AS DECIMAL(19,4)) AS unit_price,
         p_type AS category_name FROM part)
SELECT c.product_id, c.product_name, c.unit_price, c.category_name, c.valid_from, c.product_key,
       DATE '2001-12-31' AS valid_to
FROM cur c JOIN srcx s ON c.product_id = s.product_id
WHERE c.product_name IS DISTINCT FROM s.product_name OR c.unit_price IS DISTINCT FROM s.unit_price
   OR c.category_name IS DISTINCT FROM s.category_name"""

SCD4_CURRENT = SCD4[:SCD4.index("SELECT c.product_id")] + """
SELECT coalesce(c.product_id, s.product_id) AS product_id,
       CASE WHEN c.product_id IS NULL OR c.product_name IS DISTINCT FROM s.product_name
                 OR c.unit_price IS DISTINCT FROM s.unit_price OR c.category_name IS DISTINCT FROM s.category_name
            THEN s.product_name ELSE c.product_name END AS product_name,
       CASE WHEN c.product_id IS NULL OR c.product_name IS DISTINCT FROM s.product_name
                 OR c.unit_price IS DISTINCT FROM s.unit_price OR c.category_name IS DISTINCT FROM s.category_name
            THEN s.unit_price ELSE c.unit_price END AS unit_price,
       CASE WHEN c.product_id IS NULL OR c.product_name IS DISTINCT FROM s.product_name
                 OR c.unit_price IS DISTINCT FROM s.unit_price OR c.category_name IS DISTINCT FROM s.category_name
            THEN s.category_name ELSE c.category_name END AS category_name,
       CASE WHEN c.product_id IS NULL OR c.product_name IS DISTINCT FROM s.product_name
                 OR c.unit_price IS DISTINCT FROM s.unit_price OR c.category_name IS DISTINCT FROM s.category_name
            THEN DATE '2002-01-01' ELSE c.valid_from END AS valid_from,
       CAST(coalesce(c.product_key, (SELECT max(product_key) FROM cur)
                     + row_number() OVER (PARTITION BY c.product_key IS NULL ORDER BY s.product_id)) AS BIGINT) AS product_key
FROM cur c FULL OUTER JOIN srcx s ON c.product_id = s.product_id
WHERE s.product_id IS NOT NULL OR c.product_id IS NOT NULL"""

SURROGATE = _with(SRC, PREV) + """, psk AS (SELECT k, row_number() OVER (ORDER BY k) AS sk FROM prev)
SELECT k, CAST(sk AS BIGINT) AS sk FROM psk
UNION ALL
SELECT k, CAST((SELECT coalesce(max(sk), 0) FROM psk) + row_number() OVER (ORDER BY k) AS BIGINT)
FROM (SELECT DISTINCT k FROM src WHERE k NOT IN (SELECT k FROM prev))"""

DIM_PRODUCTS = _with(DIMS) + """
SELECT dp.product_key, dp.p_partkey AS product_id, dp.p_name AS product_name, dp.p_brand AS brand,
       CAST(dp.p_size AS BIGINT) AS size, CAST(dp.p_retailprice AS DECIMAL(19,4)) AS unit_price,
       cats.category_id, cats.category_name, ps.supplier_id, s.s_name AS supplier_name, n.n_name AS supplier_country
FROM dim_p dp JOIN cats ON dp.p_type = cats.category_name
LEFT JOIN (SELECT l_partkey, min(l_suppkey) AS supplier_id FROM lineitem GROUP BY l_partkey) ps ON ps.l_partkey = dp.p_partkey
LEFT JOIN supplier s ON s.s_suppkey = ps.supplier_id LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey"""

DIM_EMP_KEYS = "dim_ek AS (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) AS employee_key FROM supplier)"

BRIDGE_KEYS = _with(DIMS, BRIDGE) + """
SELECT de.employee_key, dt.territory_key
FROM bridge b JOIN dim_e de ON b.s_suppkey = de.s_suppkey JOIN dim_t dt ON b.n_nationkey = dt.territory_id"""

AUDIT_PK = _with(PREV, HIST) + """
SELECT k, CAST(count(*) AS BIGINT) AS n_rows FROM hist GROUP BY k HAVING count(*) > 1 OR k IS NULL"""

AUDIT_CPK = """
SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL"""

AUDIT_UNIQUE_CURRENT = f"""
SELECT k, CAST(sum(CASE WHEN k % 50 = 0 THEN 2 ELSE 1 END) AS BIGINT) AS n_rows FROM ({SCD2}) WHERE is_current
GROUP BY k HAVING n_rows > 1 OR k IS NULL"""

AUDIT_DECLARED = _with(PREV, HIST, ONULL, """c AS (
  SELECT c_custkey AS k, CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE c_name END AS nm,
         CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_mktsegment END AS addr FROM customer)""") + """
SELECT 'orders' AS table_name, 'primary_key' AS constraint_name, CAST(count(*) AS BIGINT) AS n_rows
FROM (SELECT o_orderkey FROM onull GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'orders', 'fk_o_custkey', count(*) FROM onull
  WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT 'orders', 'not_null', count(*) FROM onull WHERE o_custkey IS NULL
UNION ALL SELECT 'customer_landed', 'primary_key', count(*) FROM (SELECT k FROM c GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'customer_landed', 'not_null', count(*) FILTER (WHERE nm IS NULL) + count(*) FILTER (WHERE addr IS NULL) FROM c
UNION ALL SELECT 'customer_landed', 'lengths', count(*) FILTER (WHERE length(nm) > 10) + count(*) FILTER (WHERE length(addr) > 8) FROM c
UNION ALL SELECT 'customer_hist', 'primary_key', count(*) FROM (SELECT k FROM hist GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'customer_hist', 'unique_current', count(*) FROM (SELECT k FROM hist WHERE is_current GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'customer_hist', 'not_null', count(*) FROM hist WHERE k IS NULL"""

AUDIT_FK = _with(ONULL) + """
SELECT o.o_orderkey, o.o_custkey FROM onull o
WHERE o.o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)"""

AUDIT_SELF_FK = _with(EMP) + """
SELECT e.employee_id, e.reports_to FROM emp e
WHERE e.reports_to IS NOT NULL AND NOT EXISTS (SELECT 1 FROM emp m WHERE m.employee_id = e.reports_to)"""

AUDIT_NOT_NULL = """WITH c AS (
  SELECT c_custkey AS k, CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE c_name END AS nm,
         CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_mktsegment END AS addr, c_nationkey AS nation
  FROM customer)
SELECT k, 'nm' AS column_name FROM c WHERE nm IS NULL
UNION ALL SELECT k, 'addr' FROM c WHERE addr IS NULL
UNION ALL SELECT k, 'nation' FROM c WHERE nation IS NULL"""

AUDIT_LENGTH = """
SELECT p_partkey, 'p_name' AS column_name, CAST(length(p_name) AS BIGINT) AS length, CAST(10 AS BIGINT) AS max_length
FROM part WHERE length(p_name) > 10
UNION ALL
SELECT p_partkey, 'p_brand', CAST(length(p_brand) AS BIGINT), CAST(7 AS BIGINT) FROM part WHERE length(p_brand) > 7"""

CASCADE_DELETE = _with(BRIDGE) + """
SELECT b.s_suppkey AS employee_id, CAST(b.n_nationkey AS BIGINT) AS territory_id
FROM bridge b
WHERE b.n_nationkey NOT IN (
  SELECT n_nationkey FROM nation WHERE n_regionkey IN (SELECT r_regionkey FROM region WHERE r_regionkey % 2 = 1))"""

CASCADE_UPDATE = """
SELECT CAST(n.n_nationkey AS BIGINT) AS n_nationkey, n.n_name,
       CAST(coalesce(m.new_key, n.n_regionkey) AS BIGINT) AS n_regionkey
FROM nation n LEFT JOIN (SELECT r_regionkey AS old_key, r_regionkey + 100 AS new_key FROM region) m
  ON n.n_regionkey = m.old_key"""

CASCADE_UPDATE_BRIDGE = _with(BRIDGE) + """
SELECT b.s_suppkey AS employee_id, CAST(coalesce(m.new_key, b.n_nationkey) AS BIGINT) AS territory_id
FROM bridge b LEFT JOIN (SELECT n_nationkey AS old_key, n_nationkey + 100 AS new_key FROM nation) m
  ON b.n_nationkey = m.old_key"""

LAND_NORMALIZE = _with(RAW) + """
SELECT try_cast(CASE WHEN k IN ('nan', 'NaT') THEN NULL ELSE k END AS BIGINT) AS k,
       try_cast(CASE WHEN cust IN ('nan', 'NaT') THEN NULL ELSE cust END AS BIGINT) AS cust,
       try_cast(CASE WHEN od IN ('nan', 'NaT') THEN NULL ELSE od END AS DATE) AS od,
       try_cast(CASE WHEN fin IN ('nan', 'NaT') THEN NULL ELSE fin END AS BOOLEAN) AS fin
FROM raw"""

LAND_REJECTS = _with(RAW) + """
SELECT k, 'k' AS column_name, k AS raw_value FROM raw
WHERE k IS NOT NULL AND k NOT IN ('nan', 'NaT') AND try_cast(k AS BIGINT) IS NULL
UNION ALL
SELECT k, 'cust' AS column_name, cust AS raw_value FROM raw
WHERE cust IS NOT NULL AND cust NOT IN ('nan', 'NaT') AND try_cast(cust AS BIGINT) IS NULL
UNION ALL
SELECT k, 'od', od FROM raw WHERE od IS NOT NULL AND od NOT IN ('nan', 'NaT') AND try_cast(od AS DATE) IS NULL
UNION ALL
SELECT k, 'fin', fin FROM raw WHERE fin IS NOT NULL AND fin NOT IN ('nan', 'NaT') AND try_cast(fin AS BOOLEAN) IS NULL"""

TABLE_KEYS = [("region", ["r_regionkey"]), ("nation", ["n_nationkey"]), ("customer", ["c_custkey"]),
              ("supplier", ["s_suppkey"]), ("part", ["p_partkey"]), ("orders", ["o_orderkey"]),
              ("lineitem", ["l_orderkey", "l_linenumber"]), ("events", ["event_id"]), ("documents", ["doc_id"]),
              ("embeddings", ["vec_id"]), ("pages", ["page_id"]), ("benchmark", ["item_id"]), ("labels", ["doc_id"]),
              ("conversations", ["conv_id", "turn"])]


def _preview():
    parts = []
    for t, ks in TABLE_KEYS:
        k1 = f"CAST({ks[0]} AS BIGINT)"
        k2 = f"CAST({ks[1]} AS BIGINT)" if len(ks) > 1 else "CAST(NULL AS BIGINT)"
        parts.append(f"SELECT * FROM (SELECT '{t}' AS entity, {k1} AS key_1, {k2} AS key_2 FROM {t} "
                     f"ORDER BY {', '.join(ks)} LIMIT 15)")
    return "\nUNION ALL\n".join(parts)


ALL_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
              "embeddings", "pages", "benchmark", "labels", "conversations"]


def _entities():
    return "\nUNION ALL\n".join(f"SELECT '{t}' AS entity, CAST(count(*) AS BIGINT) AS n_rows FROM {t}"
                                for t in ALL_TABLES)


def _catalog_pk():
    parts = []
    for t, ks in TABLE_KEYS:
        kd = ks[0] if len(ks) == 1 else "(" + ", ".join(ks) + ")"
        parts.append(f"SELECT '{t}' AS table_name, '{','.join(ks)}' AS key_columns, "
                     f"CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT {kd}) AS BIGINT) AS n_keys, "
                     f"count(*) = count(DISTINCT {kd}) AS is_unique FROM {t}")
    return "\nUNION ALL\n".join(parts)


def _star_pipeline():
    fact_body = FACT[FACT.index("SELECT l.l_orderkey"):]
    cal_body = CALENDAR
    return _with(DIMS, BRIDGE, TERR_OK) + f""", fact AS ({fact_body}),
cal AS ({cal_body}),
bk AS (SELECT de.employee_key, dt.territory_key FROM bridge b JOIN dim_e de ON b.s_suppkey = de.s_suppkey
       JOIN dim_t dt ON b.n_nationkey = dt.territory_id),
dp2 AS (SELECT dp.product_key FROM dim_p dp JOIN cats ON dp.p_type = cats.category_name)
SELECT 'dim_customers' AS table_name, CAST(count(*) AS BIGINT) AS n_rows,
       CAST(count(DISTINCT customer_key) AS BIGINT) AS n_keys FROM dim_c
UNION ALL SELECT 'dim_products', count(*), count(DISTINCT product_key) FROM dp2
UNION ALL SELECT 'dim_employees', count(*), count(DISTINCT employee_key) FROM dim_e
UNION ALL SELECT 'dim_shippers', count(*), count(DISTINCT shipper_key) FROM dim_s
UNION ALL SELECT 'dim_territories', count(*), count(DISTINCT territory_key) FROM dim_t
UNION ALL SELECT 'dim_regions', count(*), count(DISTINCT r_regionkey) FROM region
UNION ALL SELECT 'bridge_employee_territory', count(*), count(DISTINCT (employee_key, territory_key)) FROM bk
UNION ALL SELECT 'dim_date', count(*), count(DISTINCT date_key) FROM cal
UNION ALL SELECT 'fact_order_lines', count(*),
                 count(DISTINCT (order_id, line_number, product_key, employee_key)) FROM fact"""


STAR_PIPELINE = _star_pipeline()

APPEND_NULL_KEYS = _with(ONULL) + """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 2 = 0 THEN 'existing' ELSE 'appended' END AS load_batch FROM onull"""

_CSV = """raw AS (
  SELECT CASE WHEN c_custkey % 41 = 0 THEN concat('x', CAST(c_custkey AS VARCHAR)) ELSE CAST(c_custkey AS VARCHAR) END AS k,
         c_name, c_nationkey, c_mktsegment,
         CASE WHEN c_custkey % 31 = 0 THEN 'bad' WHEN c_custkey % 19 = 0 THEN 'nan'
              ELSE CAST(CAST(c_acctbal AS DECIMAL(19,4)) AS VARCHAR) END AS bal
  FROM customer)"""
TYPED_CSV = _with(_CSV) + """
SELECT try_cast(k AS BIGINT) AS c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey,
       CASE WHEN bal = 'nan' THEN NULL ELSE try_cast(bal AS DECIMAL(19,4)) END AS c_acctbal, c_mktsegment FROM raw"""
TYPED_CSV_REJECTS = _with(_CSV) + """
SELECT k AS c_custkey, 'c_custkey' AS column_name, k AS raw_value FROM raw WHERE try_cast(k AS BIGINT) IS NULL
UNION ALL SELECT k, 'c_acctbal', bal FROM raw WHERE bal = 'bad'"""


# ---------------------------------------------------------------- two daily loads (FIXTURES.md section 4)

def _two_days(name, key, sk, cols, change, first, second):
    """CTEs of a type-2 dimension after a load of ``first`` (2001-01-01) and of ``second`` (2002-01-01)."""
    t, s_ = (", ".join(f"{a}.{c} AS {b}_{c}" for c in cols) for a, b in (("t", "t"), ("s", "s")))
    old, new = (", ".join(f"{b}_{c} AS {c}" for c in cols) for b in ("t", "s"))
    return f"""{name}_1 AS (SELECT *, row_number() OVER (ORDER BY {key}) AS {sk} FROM ({first})),
{name}_j AS (
  SELECT coalesce(t.{key}, s.{key}) AS {key}, {t}, {s_}, t.{sk},
         CASE WHEN t.{key} IS NULL THEN 'INSERT' WHEN s.{key} IS NULL THEN 'DELETE' WHEN {change} THEN 'UPDATE' ELSE 'KEEP' END AS a
  FROM {name}_1 t FULL OUTER JOIN ({second}) s ON t.{key} = s.{key}),
{name} AS (
  SELECT {key}, {old}, a <> 'UPDATE' AS is_current, DATE '2001-01-01' AS effective_date,
         CASE WHEN a = 'UPDATE' THEN DATE '2001-12-31' END AS ineffective_date, {sk} FROM {name}_j WHERE a <> 'INSERT'
  UNION ALL
  SELECT {key}, {new}, true, DATE '2002-01-01', CAST(NULL AS DATE),
         (SELECT max({sk}) FROM {name}_1) + row_number() OVER (ORDER BY {key}) FROM {name}_j WHERE a IN ('INSERT', 'UPDATE'))"""


def _listing(name, cols):
    text = ", '|', ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in cols)
    return f"SELECT '{name}' AS table_name, concat({text}) AS row_text"


def _fact_of(lines, dc, dp, de, ds):
    return f"""SELECT l.l_orderkey AS order_id, CAST(l.l_linenumber AS BIGINT) AS line_number, dc.customer_key, de.employee_key,
       dp.product_key, ds.shipper_key, {dk('o.o_orderdate')} AS order_date_key, {dk('l.l_shipdate')} AS ship_date_key,
       CAST(l.l_quantity AS BIGINT) AS quantity, CAST(l.l_extendedprice AS DECIMAL(19,4)) AS line_price,
       dp.unit_price AS list_price, l.l_discount AS discount
FROM {lines} l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN {dc} dc ON o.o_custkey = dc.c_custkey
LEFT JOIN {dp} dp ON l.l_partkey = dp.product_id
LEFT JOIN (SELECT * FROM {de} WHERE employee_id IN (SELECT s_suppkey FROM terr_ok)) de ON l.l_suppkey = de.employee_id
LEFT JOIN {ds} ds ON CAST(substr(o.o_orderpriority, 1, 1) AS BIGINT) = ds.shipper_id"""


def _star_reload(day=2, only=()):
    """The star's rows after the loads of day 1, or of both days."""
    old = "CASE WHEN {w} THEN concat('OLD_', {c}) ELSE {c} END AS {c}"
    emp_cols = ["last_name", "nation_id", "acctbal", "photo", "reports_to"]
    e_first = "SELECT employee_id, " + old.format(w="employee_id % 4 = 0", c="last_name") + \
        ", nation_id, acctbal, photo, reports_to FROM emp WHERE employee_id % 10 <> 3"
    e_second = "SELECT * FROM emp WHERE employee_id % 12 <> 5"
    e_change = ("t.last_name <> s.last_name OR coalesce(t.nation_id, 0) <> coalesce(s.nation_id, 0) "
                "OR t.acctbal <> s.acctbal OR t.photo IS DISTINCT FROM s.photo OR coalesce(t.reports_to, 0) <> coalesce(s.reports_to, 0)")
    terr = ("SELECT CAST(n_nationkey AS BIGINT) AS territory_id, {d}, CAST(n_regionkey AS BIGINT) AS region_id FROM nation WHERE {w}")
    t_first = terr.format(d="CASE WHEN n_nationkey % 3 = 0 THEN concat('OLD_', n_name) ELSE n_name END AS description", w="n_nationkey % 7 <> 6")
    t_second = terr.format(d="n_name AS description", w="n_nationkey % 11 <> 4")
    reg = "SELECT CAST(r_regionkey AS BIGINT) AS region_id, {d} FROM region WHERE {w}"
    r_first = reg.format(d="CASE WHEN r_regionkey % 2 = 0 THEN concat('OLD_', r_name) ELSE r_name END AS description", w="r_regionkey <> 2")
    r_second = reg.format(d="r_name AS description", w="true")
    missing = ("array_to_string(list_filter([CASE WHEN customer_key IS NULL THEN 'customer_key' END, "
               "CASE WHEN shipper_key IS NULL THEN 'shipper_key' END, CASE WHEN product_key IS NULL THEN 'product_key' END, "
               "CASE WHEN employee_key IS NULL THEN 'employee_key' END], lambda x: x IS NOT NULL), ',')")
    full = "customer_key IS NOT NULL AND shipper_key IS NOT NULL AND product_key IS NOT NULL AND employee_key IS NOT NULL"
    ctes = [EMP, BRIDGE, TERR_OK, f"""c1 AS (
  SELECT c_custkey, c_name, c_nationkey, {old.format(w='c_custkey % 7 = 0', c='c_mktsegment')},
         row_number() OVER (ORDER BY c_custkey) AS customer_key FROM customer WHERE c_custkey % 10 <> 0)""",
            """cj AS (
  SELECT coalesce(t.c_custkey, s.c_custkey) AS c_custkey, t.c_name AS t_name, s.c_name AS s_name, t.c_nationkey AS t_nation,
         s.c_nationkey AS s_nation, t.c_mktsegment AS t_seg, s.c_mktsegment AS s_seg, t.customer_key, s.c_custkey IS NOT NULL AS in_s
  FROM c1 t FULL OUTER JOIN (SELECT * FROM customer WHERE c_custkey % 13 <> 0) s ON t.c_custkey = s.c_custkey)""",
            """c2 AS (
  SELECT CAST(coalesce(customer_key, (SELECT max(customer_key) FROM c1)
              + row_number() OVER (PARTITION BY customer_key IS NULL ORDER BY c_custkey)) AS BIGINT) AS customer_key, c_custkey,
         CASE WHEN in_s THEN s_name ELSE t_name END AS c_name, CASE WHEN in_s THEN s_nation ELSE t_nation END AS c_nationkey,
         CASE WHEN in_s THEN s_seg ELSE t_seg END AS c_mktsegment,
         CASE WHEN t_seg <> s_seg THEN t_seg END AS c_mktsegment_prev,
         CASE WHEN t_seg <> s_seg THEN '20011231' END AS c_mktsegment_prev_validto
  FROM cj)""",
            """p1 AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS brand, CAST(p_size AS BIGINT) AS size,
         CAST(p_retailprice AS DECIMAL(19,4)) AS unit_price, p_type AS category_name,
         row_number() OVER (ORDER BY p_partkey) AS product_key FROM part WHERE p_partkey % 9 <> 0)""",
            """ps AS (
  SELECT p_partkey AS product_id, CASE WHEN p_partkey % 11 = 0 THEN concat(p_name, ' v2') ELSE p_name END AS product_name,
         p_brand AS brand, CAST(p_size AS BIGINT) AS size,
         CAST(CAST(p_retailprice AS DECIMAL(19,4)) + CASE WHEN p_partkey % 7 = 0 THEN 1 ELSE 0 END AS DECIMAL(19,4)) AS unit_price,
         p_type AS category_name FROM part)""",
            """p2 AS (
  SELECT s.*, CAST(coalesce(t.product_key, (SELECT max(product_key) FROM p1)
              + row_number() OVER (PARTITION BY t.product_key IS NULL ORDER BY s.product_id)) AS BIGINT) AS product_key,
         CASE WHEN t.product_id IS NOT NULL AND t.product_name = s.product_name AND t.unit_price = s.unit_price
              THEN DATE '2001-01-01' ELSE DATE '2002-01-01' END AS valid_from
  FROM ps s LEFT JOIN p1 t ON t.product_id = s.product_id)""",
            """ph AS (
  SELECT t.*, DATE '2001-01-01' AS valid_from, DATE '2001-12-31' AS valid_to FROM p1 t JOIN ps s ON t.product_id = s.product_id
  WHERE t.product_name <> s.product_name OR t.unit_price <> s.unit_price)""",
            _two_days("e2", "employee_id", "employee_key", emp_cols, e_change, e_first, e_second),
            _two_days("t2", "territory_id", "territory_key", ["description", "region_id"],
                      "t.description <> s.description OR t.region_id <> s.region_id", t_first, t_second),
            _two_days("r2", "region_id", "region_key", ["description"], "t.description <> s.description", r_first, r_second),
            """ship AS (SELECT CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS shipper_id, min(o_orderpriority) AS company_name
  FROM orders GROUP BY 1)""",
            """s1 AS (
  SELECT shipper_id, CASE WHEN shipper_id = 2 THEN concat('OLD_', company_name) ELSE company_name END AS company_name,
         row_number() OVER (ORDER BY shipper_id) AS shipper_key
  FROM (SELECT * FROM ship WHERE shipper_id <> 3 UNION ALL SELECT shipper_id + 100, company_name FROM ship WHERE shipper_id = 1))""",
            """s2 AS (
  SELECT s.*, CAST(coalesce(t.shipper_key, (SELECT max(shipper_key) FROM s1)
              + row_number() OVER (PARTITION BY t.shipper_key IS NULL ORDER BY s.shipper_id)) AS BIGINT) AS shipper_key
  FROM ship s LEFT JOIN s1 t ON t.shipper_id = s.shipper_id)""",
            """b2 AS (
  SELECT e.employee_key, t.territory_key FROM bridge b JOIN e2 e ON b.s_suppkey = e.employee_id AND e.is_current
  JOIN t2 t ON b.n_nationkey = t.territory_id AND t.is_current)""",
            f"""f1 AS (SELECT * FROM ({_fact_of("(SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '1997-01-01')", 'c1', 'p1', 'e2_1', 's1')})
  WHERE {full})""",
            f"""fl AS ({_fact_of('lineitem', 'c2', 'p2', '(SELECT * FROM e2 WHERE is_current)', 's2')})""",
            f"""f2 AS (
  SELECT * FROM f1 UNION ALL
  SELECT * FROM fl WHERE {full} AND NOT EXISTS (
    SELECT 1 FROM f1 WHERE f1.order_id = fl.order_id AND f1.line_number = fl.line_number AND f1.ship_date_key = fl.ship_date_key
    AND f1.quantity = fl.quantity AND f1.line_price = fl.line_price AND f1.discount = fl.discount))"""]
    if day == 1:
        ctes += [f"""fl1 AS ({_fact_of("(SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '1997-01-01')", 'c1', 'p1', 'e2_1', 's1')})""",
                 """c1x AS (SELECT *, CAST(NULL AS VARCHAR) AS c_mktsegment_prev, CAST(NULL AS VARCHAR) AS c_mktsegment_prev_validto FROM c1)""",
                 "p1x AS (SELECT *, DATE '2001-01-01' AS valid_from FROM p1)",
                 *[f"""{t}_1x AS (SELECT *, true AS is_current, DATE '2001-01-01' AS effective_date, CAST(NULL AS DATE) AS ineffective_date
  FROM {t}_1)""" for t in ("e2", "t2", "r2")],
                 """b1 AS (
  SELECT e.employee_key, t.territory_key FROM bridge b JOIN e2_1 e ON b.s_suppkey = e.employee_id
  JOIN t2_1 t ON b.n_nationkey = t.territory_id)"""]
    c, p, h, e, t, r, sh, b, f, lines = (("c2", "p2", "ph", "e2", "t2", "r2", "s2", "b2", "f2", "fl") if day == 2 else
                                         ("c1x", "p1x", "ph WHERE false", "e2_1x", "t2_1x", "r2_1x", "s1", "b1", "f1", "fl1"))
    version = ["is_current", "effective_date", "ineffective_date"]
    parts = {
        "dim_customers": _listing("dim_customers", ["customer_key", "c_custkey", "c_name", "c_nationkey", "c_mktsegment",
                                                    "c_mktsegment_prev", "c_mktsegment_prev_validto"]) + f" FROM {c}",
        "dim_products": _listing("dim_products", ["product_key", "product_id", "product_name", "brand", "size", "unit_price",
                                                  "category_name", "valid_from"]) + f" FROM {p}",
        "dim_products_history": _listing("dim_products_history", ["product_key", "product_id", "product_name", "unit_price",
                                                                  "valid_from", "valid_to"]) + f" FROM {h}",
        "dim_employees": _listing("dim_employees", ["employee_key", "employee_id", "last_name", "nation_id", "acctbal", "hex(photo)",
                                                    "reports_to", *version]) + f" FROM {e}",
        "dim_territories": _listing("dim_territories", ["territory_key", "territory_id", "description", "region_id", *version])
        + f" FROM {t}",
        "dim_regions": _listing("dim_regions", ["region_key", "region_id", "description", *version]) + f" FROM {r}",
        "dim_shippers": _listing("dim_shippers", ["shipper_key", "shipper_id", "company_name"]) + f" FROM {sh}",
        "bridge_employee_territory": _listing("bridge_employee_territory", ["employee_key", "territory_key"]) + f" FROM {b}",
        "fact_order_lines": _listing("fact_order_lines", ["order_id", "line_number", "customer_key", "employee_key", "product_key",
                                                          "shipper_key", "order_date_key", "ship_date_key", "quantity", "line_price",
                                                          "list_price", "CAST(discount AS DECIMAL(19,4))"]) + f" FROM {f}",
        "fact_rejects": _listing("fact_rejects", ["order_id", "line_number", missing]) + f" FROM {lines} WHERE NOT ({full})",
    }
    return _with(*ctes) + "\nUNION ALL\n".join(q for name, q in parts.items() if not only or name in only)


STAR_RELOAD = _star_reload()

CATALOG_INCLUDED = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                    "documents"]

# Column lists of the provided tables (TESTDATA / FIXTURES section 3).
TABLE_COLUMNS = {
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
    "documents": ["doc_id", "text", "lang", "source", "n_chars"],
    "embeddings": ["vec_id", "embedding", "label"],
    "pages": ["page_id", "url", "html"],
    "benchmark": ["item_id", "text"],
    "labels": ["doc_id", "quality", "toxic"],
    "conversations": ["conv_id", "turn", "role", "text"],
}


def _catalog_tables():
    listed = ("SELECT table_name FROM information_schema.tables WHERE table_name IN ("
              + ", ".join(f"'{t}'" for t in CATALOG_INCLUDED) + ")")
    counts = "\nUNION ALL\n".join(f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS n_rows FROM {t}"
                                   for t in CATALOG_INCLUDED)
    return f"SELECT c.table_name, c.n_rows FROM ({counts}) c WHERE c.table_name IN ({listed})"


def _catalog_columns():
    counts = "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, CAST(count({c}) AS BIGINT) AS n_non_null FROM {t}"
        for t, cols in TABLE_COLUMNS.items() for c in cols)
    return f"""
SELECT i.table_name, i.column_name, CAST(i.ordinal_position AS BIGINT) AS ordinal_position, s.n_non_null
FROM information_schema.columns i JOIN ({counts}) s
  ON i.table_name = s.table_name AND i.column_name = s.column_name"""


#: columns that aren't cast to text as they are
_WHOLE = "CAST(floor(CAST({0} AS DOUBLE) * 10000) AS BIGINT)"
_TEXT_OF = {c: _WHOLE for c in ("c_acctbal", "s_acctbal", "p_retailprice", "o_totalprice", "l_quantity", "l_extendedprice",
                                "l_discount", "l_tax", "value")}
_TEXT_OF |= {c: "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')" for c in ("o_orderdate", "l_shipdate", "ts")}
_TEXT_OF["embedding"] = ("concat('[', array_to_string(list_transform({0}, lambda x: coalesce(CAST("
                         + _WHOLE.format("x") + " AS VARCHAR), '~')), ','), ']')")


def _preview_rows():
    parts = []
    for t, ks in TABLE_KEYS:
        text = ", '|', ".join(f"coalesce(CAST({_TEXT_OF.get(c, '{0}').format(c)} AS VARCHAR), '~')" for c in TABLE_COLUMNS[t])
        parts.append(f"SELECT * FROM (SELECT '{t}' AS entity, concat({text}) AS row_text FROM {t} ORDER BY {', '.join(ks)} LIMIT 15)")
    return "\nUNION ALL\n".join(parts)


# net change of prev to the last source, all columns compared NULL-safely
FEED_BETWEEN = _with(SRC, PREV, """last AS (
  SELECT s.k, CASE WHEN s.k % 13 = 0 THEN upper(s.nm) ELSE s.nm END || CASE WHEN s.k % 12 = 5 THEN ' II' ELSE '' END AS nm,
         CASE WHEN s.k % 7 = 0 THEN CASE WHEN s.k % 11 = 0 THEN NULL ELSE concat('OLD_', c.c_mktsegment) END ELSE s.addr END AS addr
  FROM src s JOIN customer c ON c.c_custkey = s.k WHERE s.k % 10 <> 0)""") + """
SELECT coalesce(p.k, l.k) AS k, CASE WHEN p.k IS NULL THEN 'INSERT' WHEN l.k IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS merge_action,
       p.nm AS nm_before, p.addr AS addr_before, l.nm AS nm_after, l.addr AS addr_after
FROM prev p FULL OUTER JOIN last l ON p.k = l.k
WHERE p.k IS NULL OR l.k IS NULL OR p.nm IS DISTINCT FROM l.nm OR p.addr IS DISTINCT FROM l.addr"""

ASOF = """
WITH v AS (
  SELECT c_custkey, c_custkey * 10 + i AS version_key, DATE '1995-01-01' + CAST(i * 500 + (c_custkey % 5) * 30 AS INTEGER) AS since,
         CASE WHEN i < c_custkey % 4 THEN DATE '1995-01-01' + CAST(i * 500 + (c_custkey % 5) * 30 + 499 AS INTEGER) END AS until
  FROM (SELECT c_custkey, unnest(range(0, c_custkey % 4 + 1)) AS i FROM customer))
SELECT l.l_orderkey AS order_id, CAST(l.l_linenumber AS BIGINT) AS line_number, o.o_custkey AS customer_id, v.version_key,
       v.until IS NOT NULL AS ends_later
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN v ON o.o_custkey = v.c_custkey AND CAST(o.o_orderdate AS DATE) >= v.since
           AND (v.until IS NULL OR CAST(o.o_orderdate AS DATE) <= v.until)"""

_TREE = """tree AS (
  SELECT e.employee_id, CASE WHEN m.s_suppkey IS NULL THEN NULL ELSE e.manager END AS manager, e.territory_id
  FROM (SELECT s_suppkey AS employee_id, CAST(s_nationkey AS BIGINT) AS territory_id,
               CASE WHEN s_suppkey % 29 = 27 THEN s_suppkey + 1 WHEN s_suppkey % 29 = 28 THEN s_suppkey - 1
                    WHEN s_suppkey % 31 = 30 THEN s_suppkey + 1000000 WHEN s_suppkey > 0 THEN s_suppkey // 2 END AS manager
        FROM supplier) e LEFT JOIN supplier m ON m.s_suppkey = e.manager)"""

HIERARCHY = f"""
WITH RECURSIVE {_TREE},
     cyc AS (SELECT a.employee_id FROM tree a JOIN tree b ON a.manager = b.employee_id AND b.manager = a.employee_id),
     up AS (SELECT employee_id, manager AS manager_id, CAST(1 AS BIGINT) AS distance FROM tree
            WHERE manager IS NOT NULL AND employee_id NOT IN (SELECT employee_id FROM cyc)
            UNION ALL
            SELECT u.employee_id, t.manager, u.distance + 1 FROM up u JOIN tree t ON u.manager_id = t.employee_id
            WHERE t.manager IS NOT NULL AND t.employee_id NOT IN (SELECT employee_id FROM cyc))
SELECT 'above' AS kind, employee_id, manager_id, distance FROM up
UNION ALL SELECT 'cycle', employee_id, NULL, NULL FROM cyc"""

CASCADED = f"""
WITH RECURSIVE {_TREE}, {BRIDGE},
     gone_t AS (SELECT n_nationkey FROM nation WHERE n_regionkey IN (SELECT r_regionkey FROM region WHERE r_regionkey % 2 = 1)),
     gone_e AS (SELECT employee_id FROM tree WHERE employee_id % 13 = 12
                UNION SELECT t.employee_id FROM tree t JOIN gone_e g ON t.manager = g.employee_id)
SELECT 'region' AS table_name, CAST(r_regionkey AS BIGINT) AS id_1, CAST(NULL AS BIGINT) AS id_2 FROM region WHERE r_regionkey % 2 <> 1
UNION ALL SELECT 'territory', CAST(n_nationkey AS BIGINT), CAST(n_regionkey AS BIGINT) FROM nation WHERE n_nationkey NOT IN (SELECT * FROM gone_t)
UNION ALL SELECT 'employee', employee_id, CASE WHEN territory_id IN (SELECT n_nationkey FROM gone_t) THEN NULL ELSE territory_id END
FROM tree WHERE employee_id NOT IN (SELECT * FROM gone_e)
UNION ALL SELECT 'bridge', s_suppkey, CAST(n_nationkey AS BIGINT) FROM bridge
WHERE s_suppkey NOT IN (SELECT * FROM gone_e) AND n_nationkey NOT IN (SELECT * FROM gone_t)"""

MALFORMED = """
WITH c AS (
  SELECT c_custkey AS k, *, CASE WHEN c_custkey % 53 = 0 THEN 'bad' ELSE CAST(CAST(c_acctbal AS DECIMAL(19,4)) AS VARCHAR) END AS bal FROM customer),
     l AS (SELECT *, concat_ws(',', CAST(k AS VARCHAR), c_name, CAST(c_nationkey AS VARCHAR), bal, c_mktsegment) AS whole FROM c)
SELECT 'row' AS kind, c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, TRY_CAST(bal AS DECIMAL(19,4)) AS c_acctbal,
       c_mktsegment, CAST(NULL AS VARCHAR) AS line FROM l WHERE k % 43 <> 0 AND k % 47 <> 0
UNION ALL
SELECT 'line', NULL, NULL, NULL, NULL, NULL,
       CASE WHEN k % 43 = 0 THEN whole || ',extra' ELSE concat_ws(',', CAST(k AS VARCHAR), c_name) END FROM l WHERE k % 43 = 0 OR k % 47 = 0"""

EVOLVED = """
SELECT o_orderkey AS order_id, o_custkey AS customer_id,
       CASE WHEN o_orderkey % 2 = 0 THEN CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DECIMAL(19,4))
            ELSE CAST(o_totalprice AS DECIMAL(19,4)) END AS total_price,
       CASE WHEN o_orderkey % 2 = 0 THEN 'NONE' ELSE o_orderpriority END AS priority
FROM orders"""


def _registry():
    counts = "\nUNION ALL\n".join(f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS n_rows FROM {t}" for t, _ in TABLE_KEYS)
    keys = ", ".join(f"('{t}', '{k}')" for t, ks in TABLE_KEYS for k in ks)
    names = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "TIMESTAMP": "timestamp_ntz",
             "FLOAT[]": "array<float>"}
    kind = "CASE i.data_type " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in names.items()) + " ELSE i.data_type END"
    return f"""
WITH n AS ({counts}), k(t, c) AS (VALUES {keys}),
     i AS (SELECT * FROM information_schema.columns WHERE table_name IN (SELECT table_name FROM n))
SELECT i.table_name, CAST(i.ordinal_position AS BIGINT) AS ordinal_position, i.column_name, {kind} AS data_type,
       EXISTS (SELECT 1 FROM k WHERE k.t = i.table_name AND k.c = i.column_name) AS is_key, n.n_rows, CAST(0 AS BIGINT) AS n_loaded_on
FROM i JOIN n ON i.table_name = n.table_name
UNION ALL
SELECT i.table_name, max(i.ordinal_position) + 1, 'loaded_on', 'date', false, any_value(n.n_rows), CAST(0 AS BIGINT)
FROM i JOIN n ON i.table_name = n.table_name GROUP BY i.table_name"""


CATALOG_TABLES = _catalog_tables()
CATALOG_COLUMNS = _catalog_columns()

ORACLE_SQL = {
    "fact_order_lines": FACT,
    "fact_territory_fanout": FANOUT,
    "fact_orders_compat": FACT_COMPAT,
    "fact_key_lookup": KEY_LOOKUP,
    "fact_semi_filters": SEMI,
    "fact_unmatched": UNMATCHED,
    "fact_append_idempotent": APPEND,
    "fact_append_null_keys": APPEND_NULL_KEYS,
    "scalar_day_number": DAY_NUMBER,
    "scalar_date_keys": DATE_KEYS,
    "calendar_dim": CALENDAR,
    "change_sentinel": CHANGE_SENTINEL,
    "change_sql": CHANGE_SQL,
    "change_nullsafe": CHANGE_NULLSAFE,
    "change_binary": CHANGE_BINARY,
    "merge_actions": MERGE_ACTIONS,
    "merge_cast_key": MERGE_CAST_KEY,
    "scd1_merge": SCD1,
    "scd2_merge": SCD2,
    "scd2_expire": SCD2_EXPIRE,
    "scd2_new_versions": SCD2_NEW,
    "scd2_change_feed": SCD2_FEED,
    "scd2_current_rows": SCD2_CURRENT,
    "scd2_feed_full": SCD2_FEED_FULL,
    "scd2_same_day": SCD2_SAME_DAY,
    "scd2_version_keys": SCD2_VERSION_KEYS,
    "scd2_region": SCD2_REGION,
    "scd2_territory": SCD2_TERRITORY,
    "scd2_employee": SCD2_EMPLOYEE,
    "scd3_customer": SCD3,
    "scd4_products": SCD4,
    "scd4_current": SCD4_CURRENT,
    "surrogate_keys": SURROGATE,
    "dim_products": DIM_PRODUCTS,
    "bridge_employee_territory": BRIDGE_KEYS,
    "audit_primary_key": AUDIT_PK,
    "audit_composite_key": AUDIT_CPK,
    "audit_unique_current": AUDIT_UNIQUE_CURRENT,
    "audit_declared": AUDIT_DECLARED,
    "audit_foreign_key": AUDIT_FK,
    "audit_self_fk": AUDIT_SELF_FK,
    "audit_not_null": AUDIT_NOT_NULL,
    "audit_length": AUDIT_LENGTH,
    "cascade_delete": CASCADE_DELETE,
    "cascade_update": CASCADE_UPDATE,
    "cascade_update_bridge": CASCADE_UPDATE_BRIDGE,
    "land_normalize": LAND_NORMALIZE,
    "land_rejects": LAND_REJECTS,
    "land_typed_csv": TYPED_CSV,
    "land_typed_csv_rejects": TYPED_CSV_REJECTS,
    "land_append": "SELECT * FROM customer",
    "land_preview": _preview(),
    "land_preview_rows": _preview_rows(),
    "land_entities": _entities(),
    "star_pipeline": STAR_PIPELINE,
    "star_reload": STAR_RELOAD,
    "land_malformed": MALFORMED,
    "evolve_read": EVOLVED,
    "schema_registry": _registry(),
    "star_commit": _star_reload(day=1),
    # what waited on day 1 is looked up again with day 2's dimensions, as if it had been delivered again
    "reject_replay": _star_reload(only=("fact_order_lines", "fact_rejects")),
    "feed_between": FEED_BETWEEN,
    "publish_compacted": "SELECT * FROM customer",
    "scd1_touched_files": """
SELECT c_custkey, c_name, CASE WHEN c_custkey % 150 = 7 THEN concat(c_mktsegment, '!') ELSE c_mktsegment END AS c_mktsegment FROM customer
UNION ALL SELECT c_custkey + 1000000, c_name, c_mktsegment FROM customer WHERE c_custkey % 300 = 9""",
    "audit_incremental": _with(ONULL) + """
SELECT 'orphan' AS violation, o_orderkey, o_custkey FROM onull WHERE o_custkey IS NOT NULL
  AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 7 <> 0)
UNION ALL
SELECT 'orphan', o_orderkey, o_custkey FROM onull WHERE o_orderkey % 100 = 0 AND o_custkey IS NOT NULL
  AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 7 <> 0)
UNION ALL SELECT 'duplicate', o_orderkey, NULL FROM onull WHERE o_orderkey % 100 = 0""",
    "append_audited": _with(ONULL, """unknown AS (
  SELECT * FROM onull WHERE o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey))""",
                            """valid AS (SELECT * FROM onull WHERE o_orderkey NOT IN (SELECT o_orderkey FROM unknown))""") + """
SELECT 'orphan' AS violation, o_orderkey, o_custkey FROM (
  SELECT * FROM valid UNION ALL SELECT * FROM valid WHERE o_orderkey % 100 = 0)
WHERE o_custkey % 7 = 0
UNION ALL SELECT 'orphan', o_orderkey, o_custkey FROM unknown
UNION ALL SELECT 'duplicate', o_orderkey, NULL FROM valid WHERE o_orderkey % 100 = 0""",
    "fact_asof_lookup": ASOF,
    "employee_hierarchy": HIERARCHY,
    "cascade_closure": CASCADED,
    "publish_snapshot": "SELECT * FROM customer",
    "catalog_tables": CATALOG_TABLES,
    "catalog_columns": CATALOG_COLUMNS,
    "catalog_primary_keys": _catalog_pk(),
}
