"""Oracle building blocks: the adapters as DuckDB SQL, composed on demand."""

from __future__ import annotations

import re

CTES: dict[str, str] = {
    "f_lines": """SELECT p.p_brand AS code, CAST(l.l_shipdate AS DATE) AS date, p.p_type, p.p_retailprice,
        l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity, l.l_extendedprice, l.l_discount,
        l.l_returnflag, l.l_linestatus
        FROM lineitem AS l JOIN part AS p ON l.l_partkey = p.p_partkey
        WHERE isodow(CAST(l.l_shipdate AS DATE)) <= 5""",
    "f_bars": """SELECT code, date, first(p_retailprice ORDER BY l_orderkey, l_linenumber, p_retailprice) AS open,
        max(p_retailprice) AS high, min(p_retailprice) AS low,
        last(p_retailprice ORDER BY l_orderkey, l_linenumber, p_retailprice) AS close,
        CAST(sum(l_quantity) AS BIGINT) AS volume, round(sum(p_retailprice * l_quantity), 4) AS amount
        FROM f_lines GROUP BY code, date""",
    "f_hfq": """SELECT code, date, open * k AS open, high * k AS high, low * k AS low, close * k AS close, volume, amount
        FROM (SELECT *, 1 + CAST(0.001 AS DOUBLE) * CAST(regexp_extract(code, '(\\d+)', 1) AS INT) AS k FROM f_bars)""",
    "f_ubars": """SELECT ['60','00','30','68','83'][CAST(user_id % 5 + 1 AS INT)] ||
        CASE WHEN user_id < 10000 THEN lpad(CAST(user_id AS VARCHAR), 4, '0') ELSE CAST(user_id AS VARCHAR) END AS code,
        CAST(ts AS DATE) AS date, first(value ORDER BY ts, event_id) AS open, max(value) AS high, min(value) AS low,
        last(value ORDER BY ts, event_id) AS close, count(*) AS volume, round(sum(value), 4) AS amount
        FROM events GROUP BY user_id, CAST(ts AS DATE)""",
    "f_members": """SELECT p_type AS industry, code || '/' || p_type AS code, date,
        first(p_retailprice ORDER BY l_orderkey, l_linenumber, p_retailprice) AS open,
        max(p_retailprice) AS high, min(p_retailprice) AS low,
        last(p_retailprice ORDER BY l_orderkey, l_linenumber, p_retailprice) AS close,
        CAST(sum(l_quantity) AS BIGINT) AS volume, round(sum(p_retailprice * l_quantity), 4) AS amount,
        round(sum(l_quantity) / 50.0, 6) AS turnover FROM f_lines GROUP BY p_type, code, date""",
    "f_index": """SELECT series_id, date, px, px * (1 + CAST(0.0001 AS DOUBLE) * rn) AS close, vol FROM (
        SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY date) AS rn FROM (
        SELECT series_id, date, CAST(CAST(sum(CAST(round(close * 100) AS BIGINT)) AS BIGINT) * 10 // count(*) AS DOUBLE) / 1000 AS px, CAST(sum(volume) AS BIGINT) AS vol FROM (
        SELECT industry AS series_id, date, close, volume FROM f_members UNION ALL
        SELECT 'ALL' AS series_id, date, close, volume FROM f_members) GROUP BY series_id, date))""",
    "f_cal": """SELECT date, row_number() OVER (ORDER BY date) AS td_idx FROM (
        SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM (
        SELECT min(CAST(l_shipdate AS DATE)) AS lo, max(CAST(l_shipdate AS DATE)) AS hi FROM lineitem))
        WHERE isodow(date) <= 5 AND NOT (dayofyear(date) BETWEEN 121 AND 123 OR dayofyear(date) BETWEEN 274 AND 278)""",
    "f_uni": """SELECT code, CASE WHEN n % 11 = 0 THEN code || '退' ELSE code END AS name, ipo_date,
        CASE WHEN n % 7 = 0 THEN last_date END AS out_date, CASE WHEN n % 7 = 0 THEN '0' ELSE '1' END AS status FROM (
        SELECT code, CAST(regexp_extract(code, '(\\d+)', 1) AS INT) AS n, min(date) AS ipo_date, max(date) AS last_date
        FROM f_bars GROUP BY code)""",
    "f_st": """SELECT code, date, 1 AS is_st FROM f_lines GROUP BY code, date
        HAVING avg(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) > 0.5""",
    "f_seats": """SELECT date, code, trade_id, side, seat_code, CASE WHEN side = 'buy' THEN v ELSE 0.0 END AS buy,
        CASE WHEN side = 'sell' THEN v ELSE 0.0 END AS sell FROM (
        SELECT CAST(date_trunc('month', date) AS DATE) AS date, code, CAST(l_linenumber % 2 AS BIGINT) AS trade_id,
        CASE WHEN l_linestatus = 'F' THEN 'buy' ELSE 'sell' END AS side, CAST(l_suppkey AS VARCHAR) AS seat_code,
        round(sum(l_extendedprice), 2) AS v FROM f_lines GROUP BY 1, 2, 3, 4, 5)""",
    "f_yield": """SELECT date, CAST(CAST(sum(CAST(round(l_discount * 100) AS BIGINT)) AS BIGINT) * 1000 // count(*) AS DOUBLE) / 1000 AS y10 FROM (
        SELECT CAST(l_shipdate AS DATE) AS date, l_discount FROM lineitem) WHERE isodow(date) = 1 GROUP BY date""",
    "f_runs": """SELECT o_orderpriority AS domain, CAST(o_orderdate AS DATE) AS run_date,
        max(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS bad, count(*) AS n FROM orders GROUP BY 1, 2""",
}


def cte(name: str, sql: str) -> None:
    if name in CTES:
        raise ValueError(f"block {name} is defined twice")
    CTES[name] = sql


def compose(body: str) -> str:
    """Prefix a statement with the blocks it uses, in order of need."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in dict.fromkeys(re.findall(r"\b[fg]_\w+\b", text)):
            if name in CTES and name not in order:
                visit(re.sub(rf"\b{name}\b", "", CTES[name]))
                if name not in order:
                    order.append(name)

    visit(body)
    body = body.strip()
    local = ""
    m = re.match(r"WITH\s+(RECURSIVE\s+)?", body)
    if m:
        local, body = "", body[m.end():]
        joined = ", ".join([_block(n) for n in order] + [body])
        return f"WITH RECURSIVE {joined}"
    if not order:
        return body
    return f"WITH RECURSIVE {', '.join(_block(n) for n in order)}{local} {body}"


def _block(name: str) -> str:
    # A block that refers to itself is recursive and cannot be materialised by hint.
    kind = "" if re.search(rf"\b{name}\b", CTES[name]) else "MATERIALIZED "
    return f"{name} AS {kind}({CTES[name]})"
