"""What each registered query must return, as SQL over the test tables."""

from __future__ import annotations

_LOG = """log AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS amount,
         o_orderstatus AS status, o_orderdate AS commit_ts,
         CASE o_orderkey % 5 WHEN 0 THEN 'D' WHEN 1 THEN 'I' ELSE 'U' END AS op
  FROM orders
  UNION ALL
  SELECT o_orderkey, o_custkey, o_totalprice + 10, o_orderstatus,
         CASE WHEN o_custkey % 3 = 0 THEN o_orderdate - INTERVAL '1' DAY
              ELSE o_orderdate + INTERVAL '1' DAY END,
         CASE o_orderkey % 7 WHEN 0 THEN 'D' WHEN 1 THEN 'I' WHEN 2 THEN 'X' ELSE 'U' END
  FROM orders)"""

_TGT = """tgt AS (
  SELECT o_orderkey * 3 // 2 AS order_id, o_custkey AS customer_id, o_totalprice AS amount,
         o_orderstatus AS status, o_orderdate AS commit_ts
  FROM orders)"""

_S = """s AS (
  SELECT order_id, customer_id, amount, status, commit_ts, op
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id
                                     ORDER BY commit_ts DESC NULLS LAST) AS rn FROM log) x
  WHERE rn = 1)"""

_ALL = f"WITH {_LOG}, {_TGT}, {_S}"
_COLS = "order_id, customer_id, amount, status, commit_ts"

_EVENTS = """ev AS (
  SELECT user_id, event_type, value, ts AS commit_ts,
         CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS op
  FROM events)"""


def _merged(cols: str, key: list[str], target: str, staged: str) -> str:
    """All three clauses, for a batch that has every target column."""
    on = " AND ".join(f"{staged}.{k} = {target}.{k}" for k in key)
    return f"""SELECT {cols} FROM {target}
WHERE NOT EXISTS (SELECT 1 FROM {staged} WHERE {on} AND {staged}.op IN ('U','D'))
UNION ALL
SELECT {cols} FROM {staged} WHERE op = 'U'
UNION ALL
SELECT {cols} FROM {staged}
WHERE op = 'I' AND NOT EXISTS (SELECT 1 FROM {target} WHERE {on})"""


_MERGE = _merged(_COLS, ["order_id"], "tgt", "s")

_MERGE_NULL_TARGET = f"""{_ALL}, t2 AS (
  SELECT CASE WHEN order_id % 3 <> 0 THEN order_id END AS order_id,
         customer_id, amount, status, commit_ts FROM tgt)
{_merged(_COLS, ["order_id"], "t2", "s")}"""


#: Several target rows may have one key.
_MERGE_HOT = f"""{_ALL}, t2 AS (
  SELECT CASE WHEN order_id % 3 <> 0 THEN order_id ELSE 6 END AS order_id,
         customer_id, amount, status, commit_ts FROM tgt)
SELECT t2.order_id,
       CASE WHEN s.op = 'U' THEN s.customer_id ELSE t2.customer_id END AS customer_id,
       CASE WHEN s.op = 'U' THEN s.amount ELSE t2.amount END AS amount,
       CASE WHEN s.op = 'U' THEN s.status ELSE t2.status END AS status,
       CASE WHEN s.op = 'U' THEN s.commit_ts ELSE t2.commit_ts END AS commit_ts
FROM t2 LEFT JOIN s ON s.order_id = t2.order_id WHERE s.op IS NULL OR s.op <> 'D'
UNION ALL
SELECT {_COLS} FROM s
WHERE op IN ('I','U') AND NOT EXISTS (SELECT 1 FROM t2 WHERE t2.order_id = s.order_id)"""


def _newest_event(name: str, condition: str) -> str:
    return f"""{name} AS (
  SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id
                                              ORDER BY commit_ts DESC NULLS LAST) AS rn
                 FROM ev WHERE {condition}) x
  WHERE rn = 1)"""


ORACLES: dict[str, str] = {
    "read_select_existing": "SELECT c_custkey, c_name, c_mktsegment FROM customer",
    "read_json": "SELECT c_custkey, c_name, c_acctbal FROM customer",
    "read_csv": "SELECT c_custkey, c_name, c_mktsegment FROM customer",
    "drop_op": f"WITH {_LOG} SELECT {_COLS} FROM log",
    "latest_per_pk": f"{_ALL} SELECT {_COLS}, op FROM s",
    "latest_composite_pk": """
SELECT l_orderkey, l_linenumber, MAX(l_shipdate) AS l_shipdate
FROM lineitem GROUP BY l_orderkey, l_linenumber""",
    "latest_tie_cols": """
SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice
FROM (SELECT *, ROW_NUMBER() OVER (
        PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS rn
      FROM lineitem) x
WHERE rn = 1""",
    "latest_null_pk": """
SELECT pk, MAX(o_orderdate) AS commit_ts
FROM (SELECT NULLIF(o_orderkey % 10, 0) AS pk, o_orderdate FROM orders) x GROUP BY pk""",
    "latest_null_ts": """
SELECT o_custkey, MAX(ts) AS ts
FROM (SELECT o_custkey,
             CASE WHEN o_custkey % 4 <> 0 AND o_orderstatus <> 'P' THEN o_orderdate END AS ts
      FROM orders) x
GROUP BY o_custkey""",
    "latest_no_ts": f"WITH {_LOG} SELECT order_id, customer_id, amount, status, op FROM log",
    "merge_cdc": f"{_ALL} {_MERGE}",
    "merge_broadcast_keys": f"{_ALL} {_MERGE}",
    "merge_shuffled": _MERGE_NULL_TARGET,
    "merge_filtered_keys": _MERGE_NULL_TARGET,
    "merge_hot_keys": _MERGE_HOT,
    "merge_bucketed": _MERGE_NULL_TARGET,
    "merge_delete": f"""{_ALL}
SELECT {_COLS} FROM tgt
WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.order_id = tgt.order_id AND s.op = 'D')""",
    "merge_update": f"""{_ALL}
SELECT {_COLS} FROM tgt
WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.order_id = tgt.order_id AND s.op = 'U')
UNION ALL
SELECT {_COLS} FROM s WHERE op = 'U'""",
    "merge_insert": f"""{_ALL}
SELECT {_COLS} FROM tgt
WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.order_id = tgt.order_id AND s.op = 'U')
UNION ALL
SELECT {_COLS} FROM s WHERE op = 'U'
UNION ALL
SELECT {_COLS} FROM s
WHERE op = 'I' AND NOT EXISTS (SELECT 1 FROM tgt WHERE tgt.order_id = s.order_id)""",
    "merge_noop_rows": f"""{_ALL}
SELECT tgt.order_id, tgt.amount, tgt.commit_ts
FROM tgt JOIN s ON tgt.order_id = s.order_id WHERE s.op NOT IN ('U','D')""",
    "merge_unknown_op": f"WITH {_TGT} SELECT {_COLS} FROM tgt",
    "merge_null_pk": f"""{_ALL}, s2 AS (
  SELECT CASE WHEN order_id % 50 <> 1 THEN order_id END AS order_id,
         customer_id, amount, status, commit_ts, op FROM s)
{_merged(_COLS, ["order_id"], "tgt", "s2")}""",
    "merge_null_target_pk": _MERGE_NULL_TARGET,
    "merge_subset_columns": f"""{_ALL}
SELECT COALESCE(tgt.order_id, s.order_id) AS order_id,
       tgt.customer_id AS customer_id, tgt.amount AS amount,
       CASE WHEN tgt.order_id IS NULL OR s.op = 'U' THEN s.status ELSE tgt.status END AS status,
       CASE WHEN tgt.order_id IS NULL OR s.op = 'U'
            THEN s.commit_ts ELSE tgt.commit_ts END AS commit_ts
FROM tgt FULL OUTER JOIN s ON tgt.order_id = s.order_id
WHERE (tgt.order_id IS NOT NULL AND (s.op IS NULL OR s.op <> 'D'))
   OR (tgt.order_id IS NULL AND s.op IN ('I','U'))""",
    "merge_composite_pk": f"""WITH lt AS (
  SELECT l_orderkey, l_linenumber, MAX(l_quantity) AS qty
  FROM lineitem GROUP BY l_orderkey, l_linenumber),
ls AS (
  SELECT l_orderkey, l_linenumber + 1 AS l_linenumber, MAX(l_quantity) + 100 AS qty,
         CASE (l_orderkey + l_linenumber) % 3 WHEN 0 THEN 'I' WHEN 1 THEN 'U' ELSE 'D' END AS op
  FROM lineitem GROUP BY l_orderkey, l_linenumber)
{_merged("l_orderkey, l_linenumber, qty", ["l_orderkey", "l_linenumber"], "lt", "ls")}""",
    "merge_duplicate_inserts": f"""WITH {_LOG}, {_TGT}
SELECT {_COLS} FROM tgt
UNION ALL
SELECT -1 - order_id, customer_id, amount, status, commit_ts FROM log WHERE op IN ('I','U')""",
    "merge_replay": f"{_ALL} {_MERGE}",
    "merge_key_slices": f"{_ALL} {_MERGE}",
    "merge_two_batches": f"""WITH {_EVENTS},
{_newest_event("b1", "commit_ts < TIMESTAMP '2024-01-16 00:00:00'")},
{_newest_event("b2", "commit_ts >= TIMESTAMP '2024-01-16 00:00:00'")},
t1 AS (SELECT user_id, event_type, value, commit_ts FROM b1 WHERE op IN ('I','U'))
{_merged("user_id, event_type, value, commit_ts", ["user_id"], "t1", "b2")}""",
    "merge_effects": f"""{_ALL}
SELECT CASE WHEN tgt.order_id IS NOT NULL AND s.op = 'D' THEN 'delete'
            WHEN tgt.order_id IS NOT NULL AND s.op = 'U' THEN 'update'
            WHEN tgt.order_id IS NULL AND s.op IN ('I','U') THEN 'insert'
            ELSE 'ignored' END AS effect, COUNT(*) AS n
FROM s LEFT JOIN tgt ON tgt.order_id = s.order_id GROUP BY 1""",
    "create_table_schema": f"""WITH {_LOG}
SELECT 1 AS pos, 'order_id' AS name, 'bigint' AS type, COUNT(order_id) AS n FROM log
UNION ALL SELECT 2, 'customer_id', 'bigint', COUNT(customer_id) FROM log
UNION ALL SELECT 3, 'amount', 'double', COUNT(amount) FROM log
UNION ALL SELECT 4, 'status', 'string', COUNT(status) FROM log
UNION ALL SELECT 5, 'commit_ts', 'timestamp_ntz', COUNT(commit_ts) FROM log""",
    "truncate_load": f"WITH {_LOG} SELECT {_COLS} FROM log",
    "overwrite_partitions": f"""WITH {_LOG}, {_TGT}
SELECT {_COLS} FROM tgt WHERE status <> 'O'
UNION ALL
SELECT {_COLS} FROM log WHERE status = 'O'""",
    "route_tables": f"""{_ALL}, m AS ({_MERGE})
SELECT 'orders' AS tbl, 'merge' AS mode, COUNT(*) AS n FROM m
UNION ALL SELECT 'customers' AS tbl, 'overwrite' AS mode, COUNT(*) AS n FROM customer""",
    "route_merge_only": f"{_ALL} {_MERGE}",
    "route_skip_empty": f"""WITH {_TGT}
SELECT 'orders' AS tbl, 'skipped' AS mode, COUNT(*) AS n FROM tgt
UNION ALL SELECT 'customers', 'overwrite', COUNT(*) FROM customer""",
    "route_existing_target": f"{_ALL} {_MERGE}",
    "route_fail_fast": f"""{_ALL}, m AS ({_MERGE})
SELECT 'orders' AS tbl, 'yes' AS mode, COUNT(*) AS n FROM m
UNION ALL SELECT 'customers', 'yes', 0""",
    "route_overwrite_only": "SELECT c_custkey, c_name, c_mktsegment FROM customer",
}
