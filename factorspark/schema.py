"""The table contract: schemas, keys and retention."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, L, DATE = T.StringType(), T.DoubleType(), T.LongType(), T.DateType()


def _struct(**cols) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in cols.items()])


BAR = _struct(code=S, date=DATE, open=D, high=D, low=D, close=D, volume=L, amount=D)
OPTIONAL = _struct(turnover=D)
PARTIAL_FLAG = "is_partial"
PERIOD_KEY = "period_key"
BAR_KEY = ("code", "date")
PRICES = ("open", "high", "low", "close")

# Fixed values of the contract: assets, price bases, trading days kept per asset (None = for ever).
ASSETS = ("stock", "etf", "index")
BASES = ("raw", "hfq")
FREQS = ("daily", "weekly", "monthly")
RETENTION = {"stock": 1250, "etf": 2430, "index": None}
PRIVATE_META = {"st_history": "shortterm"}

# Event tables with their keys and columns.
EVENTS = {
    "lhb_detail": (
        ("date", "code", "trade_id"),
        _struct(date=DATE, code=S, name=S, market=S, trade_id=L, reason=S, reason_tag=S,
                change_type=S, close=D, change_rate=D, turnover_rate=D, free_market_cap=D,
                acc_amount=D, buy_amount=D, sell_amount=D, net_amount=D),
    ),
    "lhb_seat": (
        ("date", "code", "trade_id", "side", "seat_code"),
        _struct(date=DATE, code=S, trade_id=L, side=S, seat_code=S, seat_name=S, buy=D, sell=D,
                net=D, rank=L),
    ),
    "zt_pool": (
        ("date", "code"),
        _struct(date=DATE, code=S, name=S, price=D, change_rate=D, amount=D, free_market_cap=D,
                total_market_cap=D, turnover_rate=D, seal_amount=D, first_seal_time=L,
                last_seal_time=L, break_count=L, limit_board_count=L, zt_days=L, zt_count=L,
                industry=S),
    ),
    "zt_daily": (
        ("date", "code"),
        _struct(date=DATE, code=S, name=S, close=D, change_rate=D, limit_up=L, limit_count=L,
                m3=L, m5=L, m10=L, threshold=D),
    ),
    "zt_ladder": (
        ("date", "lbc"),
        _struct(date=DATE, lbc=L, count=L, prev_count=L, promote_rate=D),
    ),
}


class ContractError(ValueError):
    """A frame or a request breaks the table contract."""


def check_retention(asset: str, keep: int | None) -> None:
    """Retention may only be raised; an asset kept for ever stays so."""
    if asset not in RETENTION:
        raise ContractError(f"unknown asset {asset!r}")
    want = RETENTION[asset]
    if want is None and keep is not None:
        raise ContractError(f"{asset} is kept for ever, got {keep}")
    if want is not None and (keep is None or keep < want):
        raise ContractError(f"{asset} needs at least {want} trading days, got {keep}")
