import datetime as dt

import pytest
from pyspark.sql import functions as F

from factorspark.schema import BAR, ContractError
from factorspark.sources import ingest as G
from factorspark.sources.store import BarStore, EventStore, load_meta, read_legacy

c = F.col


def d(s):
    return dt.date.fromisoformat(s)


def day_frame(spark, day, codes=("600000", "000001", "300750"), close=10.0):
    return spark.createDataFrame([(k, d(day), 9.0, 12.0, 8.0, close, 100, 1000.0) for k in codes], BAR)


def test_append_day_is_idempotent(spark, tmp_path):
    st = BarStore(spark, str(tmp_path))
    assert st.append_day(day_frame(spark, "2025-01-02"), "2025-01-02") == "written"
    assert st.append_day(day_frame(spark, "2025-01-02", close=11.0), "2025-01-02") == "skipped"
    with pytest.raises(ContractError):
        st.append_day(day_frame(spark, "2025-01-02", ("600000",)), "2025-01-02")
    assert st.append_day(day_frame(spark, "2025-01-03"), "2025-01-03") == "written"
    assert st.append_day(day_frame(spark, "2025-01-02", ("600000",), 12.0), "2025-01-02", overwrite=True) == "overwritten"
    rows = {(r.code, str(r.date)): r.close for r in st.load().collect()}
    assert rows[("600000", "2025-01-02")] == 12.0 and len(rows) == 4
    with pytest.raises(ContractError):
        st.append_frozen(day_frame(spark, "2025-01-03"))
    with pytest.raises(ContractError):
        BarStore(spark, str(tmp_path), basis="qfq")


def test_seal_keeps_every_row_and_clears_increments(spark, tmp_path):
    st = BarStore(spark, str(tmp_path))
    for day in ("2025-01-02", "2025-01-03"):
        st.append_day(day_frame(spark, day), day)
    assert st.seal("2025-01", dry_run=True) == 6
    assert st.seal("2025-01") == 6
    assert st.sealed().count() == 6 and st.increments().filter(c("ym") == "2025-01").count() == 0
    st.rebuild_months(day_frame(spark, "2025-01-03", ("sh.600000",), 99.0))
    rows = {(r.code, str(r.date)): r.close for r in st.load().collect()}
    assert len(rows) == 6 and rows[("600000", "2025-01-03")] == 99.0
    assert st.load(columns=["close"], codes=["sz.000001"], start="2025-01-03").columns == ["code", "date", "close"]
    with pytest.raises(ContractError):
        st.load(freq="weekly")


def test_event_upsert_rewrites_only_touched_days(spark, tmp_path):
    st = EventStore(spark, str(tmp_path), "zt_ladder")
    row = lambda day, lbc, n: (d(day), lbc, n, 0, None)
    frame = lambda *r: spark.createDataFrame(list(r), st.schema)
    st.write_month(frame(row("2025-01-02", 1, 5), row("2025-01-02", 2, 1), row("2025-01-03", 1, 4)))
    st.upsert(frame(row("2025-01-02", 1, 7), row("2025-01-02", 3, 1)))
    got = {(str(r.date), r.lbc): r["count"] for r in st.load().collect()}
    assert got == {("2025-01-02", 1): 7, ("2025-01-02", 2): 1, ("2025-01-02", 3): 1, ("2025-01-03", 1): 4}
    with pytest.raises(ContractError):
        EventStore(spark, str(tmp_path), "nope")


def test_private_meta(spark, tmp_path):
    spark.createDataFrame([("600000", 1)], "code string, is_st int").write.json(f"{tmp_path}/meta/st_history.json")
    assert load_meta(spark, str(tmp_path), "st_history", domain="shortterm").count() == 1
    with pytest.raises(ContractError):
        load_meta(spark, str(tmp_path), "st_history", domain="etf")
    with pytest.raises(ContractError):
        load_meta(spark, str(tmp_path), "universe")


def test_quote_lines_are_never_dropped_silently(spark):
    f = ["51", "n", "600004", "8.5", "8.4", "8.45", "1000"] + ["0"] * 26 + ["8.6", "8.3", "0", "0", "12.5", "0", "0"]
    full = "~".join(f)
    lines = [f'v_sh600004="{full}"', f'v_sz000001="{full}"', 'v_s_sh600005="1~n~600005~9.1~9.0~9.05"', 'v_sh600006="1~n~600006"', 'v_zz600007="1~2"',
             f'v_sh600008="{full.replace("8.5~", "x~", 1)}"', f'v_sh600009="{full.replace("~8.5~", "~0~", 1)}"']
    df = spark.createDataFrame([(";".join(lines) + ";",)], "value string")
    sym = spark.createDataFrame([(f"sh60000{i}", f"1.60000{i}") for i in range(4, 10)], "symbol string, code string")
    p = G.parse_quotes(df, sym)
    rows = {r.code: r for r in G.quote_rows(p).collect()}
    assert set(rows) == {"1.600004", "1.600005"}
    assert rows["1.600004"].amount == 125_000.0 and rows["1.600004"].volume == 1000
    assert rows["1.600005"].degraded and rows["1.600005"].high == 9.1 and rows["1.600005"].open == 9.05
    assert {r.reason: r.n for r in G.drop_ledger(p).collect()} == {"unknown_code": 1, "short_format": 2, "other": 1, "parse_error": 2}


def test_calendar_headers(spark):
    a = spark.createDataFrame([("2025-01-01", "0", "new year"), ("2025-01-02", "1", "")], "date string, is_trading_day string, holiday_name string")
    got = {str(r.date): (r.is_trading_day, r.holiday_name) for r in G.parse_calendar(a).collect()}
    assert got == {"2025-01-01": (False, "new year"), "2025-01-02": (True, None)}
    b = G.parse_calendar(spark.createDataFrame([("20250102",), ("bad",)], "trade_date string")).collect()
    assert [(str(r.date), r.is_trading_day) for r in b] == [("2025-01-02", True)]
    with pytest.raises(ValueError):
        G.parse_calendar(spark.createDataFrame([("x",)], "foo string"))


def test_seal_and_rebuild_keep_the_newest_row(spark, tmp_path):
    st = BarStore(spark, str(tmp_path))
    day = "2025-01-02"
    st.append_day(day_frame(spark, day, close=10.0), day)
    st.seal("2025-01")
    st.append_day(day_frame(spark, day, close=9.0), day)
    assert {r.close for r in st.load().collect()} == {9.0}
    assert st.seal("2025-01") == 3
    assert {r.close for r in st.sealed().collect()} == {9.0} == {r.close for r in st.load().collect()}
    st.append_day(day_frame(spark, day, close=8.0), day)
    st.rebuild_months(day_frame(spark, day, ("600000",), 20.0))
    assert {r.code: r.close for r in st.load().collect()} == {"600000": 20.0, "000001": 8.0, "300750": 8.0}
    assert not [p for p in (tmp_path / "market/stock/raw").iterdir() if p.name.startswith("stage")]


def test_append_days_tells_changed_days(spark, tmp_path):
    st = BarStore(spark, str(tmp_path))
    two = day_frame(spark, "2025-01-02").unionByName(day_frame(spark, "2025-01-03"))
    assert {r.state for r in st.append_days(two).collect()} == {"written"}
    more = day_frame(spark, "2025-01-02").unionByName(day_frame(spark, "2025-01-03", close=7.0)).unionByName(day_frame(spark, "2025-01-06"))
    assert {str(r.date): r.state for r in st.append_days(more).collect()} == {"2025-01-02": "skipped", "2025-01-03": "differs", "2025-01-06": "written"}
    assert st.load().count() == 9


def test_event_month_is_replaced_whole(spark, tmp_path):
    st = EventStore(spark, str(tmp_path), "zt_ladder")
    frame = lambda *r: spark.createDataFrame([(d(x), 1, n, 0, None) for x, n in r], st.schema)
    st.write_month(frame(("2025-01-02", 5), ("2025-01-03", 5), ("2025-02-03", 5)))
    st.write_month(frame(("2025-01-03", 7), ("2025-01-03", 8)))
    assert {str(r.date): r["count"] for r in st.load().collect()} == {"2025-01-03": 8, "2025-02-03": 5}
    assert st.load(start="2025-02-01").count() == 1


def test_shared_folder_needs_a_setting_on_a_cluster(monkeypatch):
    from factorspark import session

    class Conf(dict):
        get = dict.get

    class Session:
        conf = Conf({"spark.master": "spark://host:7077"})

    with pytest.raises(ValueError):
        session.shared_dir(Session(), "x")
    Session.conf = Conf({"spark.master": "spark://host:7077", "spark.checkpoint.dir": "hdfs://n/ck"})
    assert session.shared_dir(Session(), "x").startswith("hdfs://n/ck/x-")


def test_derived_tables_manifest_and_retention(spark, tmp_path):
    days = [d("2025-01-02") + dt.timedelta(days=i) for i in range(75)]
    days = [x for x in days if x.weekday() < 5]
    cal = spark.createDataFrame([(x, i + 1) for i, x in enumerate(days)], "date date, td_idx long")
    bars = spark.createDataFrame([("000300", x, 9.0, 12.0, 8.0, 10.0 + i, 100, 1000.0) for i, x in enumerate(days)], BAR)
    st = BarStore(spark, str(tmp_path), "index")
    with pytest.raises(ContractError):
        st.load(freq="weekly")
    st.append_days(bars)
    st.seal("2025-01")
    st.write_derived("weekly", cal)
    weekly = st.load(freq="weekly")
    assert weekly.count() == len({x.isocalendar()[:2] for x in days}) and not weekly.filter("is_partial").count()
    assert {r.state for r in st.verify().collect()} == {"ok"}
    assert {(r.kind, r.ym) for r in st.manifest().collect()} == {("sealed", "2025-01"), ("incr", "2025-02"), ("incr", "2025-03")}
    st._clear(st.incr_path, "2025-02")
    assert {(r.ym, r.state) for r in st.verify().collect()} == {("2025-01", "ok"), ("2025-02", "gone"), ("2025-03", "ok")}
    with pytest.raises(ContractError):
        st.expire(cal, "2025-02-28", 10)  # indices are kept for ever


def test_legacy_layout(spark, tmp_path):
    base = f"{tmp_path}/old"
    day_frame(spark, "2025-01-02").write.parquet(base)
    day_frame(spark, "2025-01-03", close=5.0).write.parquet(f"{base}/year=2025/month=01")
    day_frame(spark, "2025-01-03", ("600000",), 7.0).write.parquet(f"{base}/_incr/20250103")
    got = {(r.code, str(r.date)): r.close for r in read_legacy(spark, base).collect()}
    assert len(got) == 6 and got[("600000", "2025-01-03")] == 7.0 and got[("000001", "2025-01-03")] == 5.0
    with pytest.raises(ContractError):
        read_legacy(spark, f"{tmp_path}/nothing")


def test_the_last_place_of_a_key_counts_not_the_greatest_row(spark, tmp_path):
    base, day = f"{tmp_path}/order", "2025-01-03"
    put = lambda close, path, codes=("600000",): day_frame(spark, day, codes, close).coalesce(1).write.mode("append").parquet(f"{base}{path}")
    close = lambda **more: {r.code: r.close for r in read_legacy(spark, base, **more).collect()}
    put(20.0, "/_incr/20250104")
    put(30.0, "/_incr/20250103")
    assert close() == {"600000": 20.0}  # the later day folder, though written first and lower
    put(10.0, "/_incr/20250104-late")
    assert close() == {"600000": 10.0}
    put(9.0, "/_incr")
    assert close() == {"600000": 9.0}  # flat increments over day folders
    put(99.0, "/year=2025/month=01", ("600000", "000001"))
    put(8.0, "", ("000001", "300750"))
    assert close() == {"600000": 9.0, "000001": 8.0, "300750": 8.0}  # flat sealed files over month folders
    put(50.0, "/year=2024/month=12", ("688001",))
    assert set(close(start="2025-01-01")) == {"600000", "000001", "300750"}
    fix = day_frame(spark, day, ("sz.000001",), 1.0)
    assert close(fix=fix)["000001"] == 1.0


def test_of_copies_in_one_file_the_last_counts(spark, tmp_path):
    rows = [("600000", d("2025-01-03"), 9.0, 12.0, 8.0, x, 100, 1000.0) for x in (5.0, 9.0, 7.0, 6.0)]
    spark.createDataFrame(rows, BAR).coalesce(1).write.parquet(f"{tmp_path}/one/year=2025/month=01")
    assert [r.close for r in read_legacy(spark, f"{tmp_path}/one").collect()] == [6.0]
