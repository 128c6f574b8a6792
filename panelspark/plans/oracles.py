"""The same queries in plain SQL, for comparison in another engine.

Dense Date x Asset grids are written out with joins here; the Spark side never builds them
that way, which is what makes the comparison worth something.
"""

from __future__ import annotations

FLAG = """flag as (select concat(l_returnflag,'_',l_linestatus) symbol, cast(l_shipdate as date) ts,
 max(l_extendedprice/l_quantity) high, min(l_extendedprice/l_quantity) low,
 sum(l_extendedprice)/sum(l_quantity) price, sum(l_quantity) volume from lineitem group by 1,2)"""
BRAND = """brand as (select p_brand symbol, cast(date_trunc('week', l_shipdate) as date) ts,
 sum(l_extendedprice)/sum(l_quantity) price from lineitem join part on l_partkey=p_partkey group by 1,2)"""
EVENT = """event as (select event_type symbol, date_trunc('hour', ts) ts, max(value) high,
 min(value) low, avg(value) price from events group by 1,2)"""
MACRO = """macro as (select o_orderpriority series_id, cast(date_trunc('month', o_orderdate) as date) ts,
 avg(o_totalprice) val from orders group by 1,2)"""
SENT = """sent as (select o_orderstatus series_id, cast(o_orderdate as date) ts,
 avg(o_totalprice) val from orders group by 1,2)"""
_PANELS = {"flag": FLAG, "brand": BRAND, "event": EVENT}


def r(expr: str, digits: int = 6) -> str:
    """Rounded after the same nudge as on the Spark side, without a negative zero."""
    x = f"(({expr})+{0.03 * 10**-digits})"
    return f"case when abs{x} < {0.5 * 10**-digits} then 0.0 else round{x[:-1]}, {digits}) end"


def grid(name: str) -> str:
    """CTEs of the dense grid of a panel: ``g`` with pos, price and the padded price."""
    extra = ", b.high, b.low" if name != "brand" else ""
    return f"""{_PANELS[name]},
cal as (select ts, row_number() over (order by ts)-1 pos, count(*) over () n_dates from (select distinct ts from {name})),
g as (select s.symbol, c.ts, c.pos, c.n_dates, b.price{extra},
 last_value(b.price ignore nulls) over (partition by s.symbol order by c.pos rows unbounded preceding) pad
 from (select distinct symbol from {name}) s cross join cal c left join {name} b on b.symbol=s.symbol and b.ts=c.ts)"""


WS = "partition by symbol order by pos"


def win(n: int) -> str:
    return f"over ({WS} rows between {n - 1} preceding and current row)"


def full(agg: str, col: str, n: int) -> str:
    return f"(case when count({col}) {win(n)} = {n} then {agg}({col}) {win(n)} end)"


def ret(k: int, col: str = "pad") -> str:
    return f"({col}/lag({col},{k}) over ({WS})-1)"


def ema_chain(name: str, source: str, col: str, span: int) -> str:
    """Recursive CTE ``name``: gap-weighted average of ``col`` over the observed rows of ``source``."""
    a, q = 2 / (span + 1), 1 - 2 / (span + 1)
    return f"""{name}_o as (select symbol, pos, {col} x, row_number() over (partition by symbol order by pos) rn,
  pos - lag(pos) over (partition by symbol order by pos) gap from {source} where {col} is not null),
{name}(symbol, pos, rn, y) as (select symbol, pos, rn, x from {name}_o where rn=1
  union all select o.symbol, o.pos, o.rn, (pow({q}, o.gap)*e.y + {a}*o.x)/(pow({q}, o.gap)+{a})
  from {name} e join {name}_o o on o.symbol=e.symbol and o.rn=e.rn+1)"""


def carried(ema: str) -> str:
    """Value of an average on every grid date from its first observation on."""
    return f"last_value({ema}.y ignore nulls) over (partition by g.symbol order by g.pos rows unbounded preceding)"


def _indicators(r=r) -> dict[str, str]:
    out = {}
    out["d01_returns"] = f"""with {grid('flag')} select symbol, ts, {r(ret(1))} return_daily, {r(ret(5))} return_5d,
 {r(ret(21))} return_21d, {r(ret(63))} return_63d from g where pad is not null"""
    out["d02_log_return"] = f"""with {grid('flag')}, x as (select *, ln(price/lag(price) over ({WS})) lr from g)
 select symbol, ts, {r('lr')} log_return from x where price is not null"""
    out["d03_sma"] = f"""with {grid('flag')}, x as (select symbol, ts, price, {full('avg','price',20)} a, {full('avg','price',50)} b,
 {full('avg','price',200)} c from g) select symbol, ts, {r('a',4)} sma_20, {r('b',4)} sma_50, {r('c',4)} sma_200 from x where price is not null"""
    out["d04_ema"] = f"""with recursive {grid('flag')}, {ema_chain('e12','g','price',12)}, {ema_chain('e26','g','price',26)}, {ema_chain('e50','g','price',50)},
 x as (select g.symbol, g.ts, {carried('e12')} a, {carried('e26')} b, {carried('e50')} c, g.pad from g
 left join e12 on e12.symbol=g.symbol and e12.pos=g.pos left join e26 on e26.symbol=g.symbol and e26.pos=g.pos
 left join e50 on e50.symbol=g.symbol and e50.pos=g.pos)
 select symbol, ts, {r('a',4)} ema_12, {r('b',4)} ema_26, {r('c',4)} ema_50 from x where pad is not null"""
    out["d05_rsi"] = f"""with {grid('flag')}, d as (select *, price-lag(price) over ({WS}) dl from g),
 u as (select *, case when dl is null then null when dl>0 then dl else 0 end up, case when dl is null then null when dl<0 then -dl else 0 end dn from d),
 x as (select symbol, ts, price, {full('avg','up',14)} gain, {full('avg','dn',14)} loss from u)
 select symbol, ts, {r('case when loss>0 then 100-100/(1+gain/loss) when gain>0 then 100.0 end',4)} rsi_14 from x where price is not null"""
    out["d06_macd"] = f"""with recursive {grid('flag')}, {ema_chain('e12','g','price',12)}, {ema_chain('e26','g','price',26)},
 m as (select g.symbol, g.ts, g.pos, {carried('e12')} - {carried('e26')} line from g left join e12 on e12.symbol=g.symbol and e12.pos=g.pos
 left join e26 on e26.symbol=g.symbol and e26.pos=g.pos), {ema_chain('sg','m','line',9)}
 select m.symbol, m.ts, {r('line',4)} macd, {r('sg.y',4)} macd_signal, {r('(line-sg.y)',4)} macd_hist from m join sg on sg.symbol=m.symbol and sg.pos=m.pos"""
    out["d07_bollinger"] = f"""with {grid('flag')}, x as (select symbol, ts, price, {full('avg','price',20)} m, {full('stddev_samp','price',20)} s from g)
 select symbol, ts, {r('m+2*s',4)} bb_upper, {r('m-2*s',4)} bb_lower, {r('4*s/nullif(m,0)')} bb_width, {r('(price-(m-2*s))/nullif(4*s,0)')} bb_pct from x where price is not null"""
    out["d08_atr"] = f"""with recursive {grid('flag')}, t as (select *, lag(price) over ({WS}) pc from g),
 t2 as (select *, case when pc is not null and high is not null then greatest(high-low, abs(high-pc), abs(low-pc)) end tr from t), {ema_chain('a','t2','tr',14)},
 x as (select g.symbol, g.ts, {carried('a')} v from g left join a on a.symbol=g.symbol and a.pos=g.pos)
 select symbol, ts, {r('v',4)} atr_14 from x where v is not null"""
    out["d09_momentum"] = f"""with {grid('flag')}, x as (select *, {ret(10,'price')} a, {ret(20,'price')} b, {ret(50,'price')} c from g)
 select symbol, ts, {r('a')} momentum_10, {r('b')} momentum_20, {r('c')} momentum_50 from x where price is not null"""
    vols = ", ".join(f"{r(full('stddev_samp', 'rd', n) + '*sqrt(252)')} vol_{n}" for n in (20, 60, 252))
    out["d10_volatility"] = f"""with {grid('flag')}, x as (select *, {ret(1)} rd from g), y as (select symbol, ts, pad, {vols} from x)
 select symbol, ts, vol_20, vol_60, vol_252 from y where pad is not null"""
    out["d11_rolling_correlation"] = f"""with {grid('flag')}, x as (select *, {ret(1)} rd from g), b as (select pos, rd bd from x where symbol='{BENCH}'),
 p as (select x.symbol, x.ts, x.pos, x.pad, case when rd is not null and bd is not null then rd end a, case when rd is not null and bd is not null then bd end b
  from x join b on b.pos=x.pos where x.symbol<>'{BENCH}'),
 y as (select symbol, ts, pad, case when count(a) {win(60)}=60 then covar_samp(a,b) {win(60)}/nullif(stddev_samp(a) {win(60)}*stddev_samp(b) {win(60)},0) end c from p)
 select symbol, ts, {r('c')} corr_{BENCH}_60 from y where pad is not null"""
    parts = [out[n] for n in sorted(out) if n != "d01_returns"]
    joins = " ".join(f"left join ({sql}) t{i} using (symbol, ts)" for i, sql in enumerate(parts))
    price = f"with {FLAG} select symbol, ts, {r('price')} price from flag"
    out["d12_all_indicators"] = f"select * from ({out['d01_returns']}) d left join ({price}) p using (symbol, ts) {joins}"
    return out


BENCH = "A_F"
LAGGED = [f"return_daily_lag_{k}" for k in (1, 5, 21)]
BUILT = [
    "return_daily", "return_5d", "return_21d", "return_63d", "log_return", "sma_20", "sma_50", "sma_200", "rsi_14",
    "bb_upper", "bb_lower", "bb_width", "bb_pct", "momentum_10", "momentum_20", "momentum_50", "vol_20", "vol_60",
    "vol_252", f"corr_{BENCH}_60", "ema_12", "ema_26", "ema_50", "macd", "macd_signal", "macd_hist", "atr_14", *LAGGED,
    "return_daily_rank", "return_daily_zscore", "return_daily_dev_mean", "sma_20_x_ema_12", "rsi_14_x_macd",
]
# fixed values: name fragments of each feature family
FAMILIES = {
    "Returns": ["return"], "SMA": ["sma"], "EMA": ["ema"], "RSI": ["rsi"], "MACD": ["macd"], "Bollinger": ["bb"],
    "Momentum": ["momentum"], "Volatility": ["vol"], "Correlation": ["corr"], "Lags": ["lag"],
    "Cross-sectional": ["rank", "zscore", "dev_mean"], "Interaction": ["_x_"],
}


def built() -> str:
    """CTEs up to ``ft``: every indicator, unrounded, with lags, cross-section and products."""
    raw = _indicators(lambda expr, digits=6: f"({expr})")["d12_all_indicators"]
    lags = ", ".join(f"lag(return_daily,{k}) over (partition by symbol order by ts) return_daily_lag_{k}" for k in (1, 5, 21))
    day = "over (partition by ts)"
    rank = f"""case when return_daily is not null then cast((rank() over (partition by ts, return_daily is null order by return_daily)
  + (count(*) over (partition by ts, return_daily)-1)/2.0)/count(return_daily) {day} as double) end"""
    return f"""fb as ({raw}), ft as (select *, {lags}, {rank} return_daily_rank, return_daily-avg(return_daily) {day} return_daily_dev_mean,
 (return_daily-avg(return_daily) {day})/nullif(stddev_samp(return_daily) {day},0) return_daily_zscore,
 sma_20*ema_12 sma_20_x_ema_12, rsi_14*macd rsi_14_x_macd from fb)"""



def _sources() -> dict[str, str]:
    out = {}
    out["a01_read_wide_panel"] = f"with {grid('brand')} select symbol, ts, {r('price')} price from g"
    out["a02_read_indicators"] = f"with {MACRO} select series_id, 'macro' kind, ts, {r('val', 4)} \"value\" from macro"
    out["a03_read_features"] = f"""with {grid('flag')}, x as (select *, {ret(20, 'price')} m from g)
 select symbol, ts, {r('m')} momentum_20 from x where price is not null and ts >= date '1998-01-01'"""
    out["a04_write_features"] = _indicators()["d02_log_return"]
    out["a06_ingest_by_key"] = f"""with {BRAND}, w as (select distinct p_brand symbol from part union select distinct n_name from nation)
 select w.symbol, count(price) n_rows, {r('avg(price)')} mean_price, case when count(price)=0 then 1 else 0 end n_errors
 from w left join brand b on b.symbol=w.symbol group by w.symbol"""
    out["a07_ingest_coverage"] = """select distinct cast(l_shipdate as date) "key" from lineitem where cast(l_shipdate as date) not in
 (select cast(o_orderdate as date) from orders)"""
    out["a08_latest_snapshot"] = f"with {FLAG} select symbol, ts, {r('price', 4)} price, {r('volume', 4)} volume from flag"
    out["a09_ingest_all"] = f"""with {BRAND}, {MACRO}, {SENT} select 'prices' table_name, count(*) n_rows, max(ts) \"last\" from brand
 union all select 'macro', count(*), max(ts) from macro union all select 'sentiment', count(*), max(ts) from sent"""
    out["a10_dim_asset"] = f"""with {BRAND}, dim as (select p_brand symbol, max(p_type) asset_class from part group by 1)
 select asset_class, count(distinct brand.symbol) n_symbols, count(*) n_rows from brand left join dim on dim.symbol=brand.symbol group by 1"""
    return out


def _shape() -> dict[str, str]:
    out = {}
    flags = ("A_F", "A_O", "N_F", "N_O", "R_F", "R_O")
    closes = ", ".join(f"{r(f'max(case when symbol={chr(39)}{s}{chr(39)} then price end)')} \"p_{s}\"" for s in flags)
    out["b01_align_outer"] = f"with {FLAG} select ts, {closes} from flag group by ts"
    out["b02_align_inner"] = f"with {FLAG} select ts, {closes} from flag group by ts having count(distinct symbol)=(select count(distinct symbol) from flag)"
    out["b03_densify"] = f"with {grid('flag')} select symbol, ts, {r('price')} price from g"
    wide = ", ".join(
        f"{r(chr(109) + 'ax(case when symbol=' + chr(39) + s + chr(39) + ' then price end)')} \"{s}\""
        for s in ("A_F", "A_O", "N_F", "N_O", "R_F", "R_O")
    )
    out["b04_to_wide"] = f"with {FLAG} select ts, {wide} from flag group by ts"
    out["b05_select_features"] = f"""with {grid('flag')}, x as (select *, {ret(10, 'price')} a, {ret(20, 'price')} b from g)
 select symbol, ts, {r('a')} momentum_10, {r('b')} momentum_20 from x where price is not null"""
    out["b06_drop_duplicate_columns"] = f"with {FLAG} select symbol, ts, {r('price')} price, {r('high')} high, {r('low')} low from flag"
    out["b07_order_by_time"] = f"with {FLAG} select symbol, ts, {r('price')} price from flag"
    out["b08_top_k"] = f"""with {FLAG}, x as (select *, row_number() over (partition by symbol order by price desc, ts) rk from flag)
 select symbol, ts, {r('price')} price, rk \"rank\" from x where rk <= 5"""
    out["b08_top_k_overall"] = f"with {FLAG} select symbol, ts, {r('price')} price from (select * from flag order by price desc, ts limit 10)"
    family = lambda f, marks: [c for c in BUILT if any(m in c for m in marks)]
    out["b09_feature_family_counts"] = f"with {built()} " + " union all ".join(
        f"select '{f}' family, {len(family(f, marks))} n_features, {'+'.join(f'count({c})' for c in family(f, marks))} n_values from ft"
        for f, marks in FAMILIES.items()
    )
    out["b10_complete_cases"] = f"""with {grid('flag')}, x as (select symbol, ts, {ret(1)} rd from g),
 ok as (select ts from x group by ts having count(rd)=count(*)) select symbol, ts, {r('rd')} ret from x where ts in (select ts from ok)"""
    return out


SHIFTED = "shifted as (select symbol, ts, pos, floor((price-1500)/100) price, floor((pad-1500)/100) pad from g)"


def _quality() -> dict[str, str]:
    out = {}
    out["c01_panel_profile"] = f"with {FLAG} select count(distinct symbol) n_assets, count(distinct ts) n_days, min(ts) first_date, max(ts) last_date from flag"
    out["c02_missing_pct"] = f"""with {grid('event')}, x as (select symbol, round(cast(sum(case when price is null then 1 else 0 end) as double)/count(*)*100, 2) m from g group by 1)
 select symbol, m missing_pct from x where m > 0"""
    head = f"with {grid('flag')}, {SHIFTED}"
    out["c03_negative_price_check"] = f"{head} select symbol, bool_or(price<0) has_negative from shifted where price is not null group by 1"
    out["c04_zero_price_check"] = f"{head} select symbol, bool_or(price=0) has_zero from shifted where price is not null group by 1"
    out["c05_extreme_return_check"] = f"with {grid('flag')}, x as (select symbol, {ret(1)} rd from g) select symbol, count(*) filter (where abs(rd)>0.5) n_extreme from x group by 1"
    out["c06_validation_issues"] = f"""{head}, x as (select symbol, price, case when lag(pad) over ({WS})=0 then case when pad<>0 then 9 end else pad/nullif(lag(pad) over ({WS}),0)-1 end rd from shifted),
 i as (select symbol, 1 kind, 'Contains negative prices' issue from x group by 1 having bool_or(price<0)
 union all select symbol, 2, 'Contains zero prices' from x group by 1 having bool_or(price=0)
 union all select symbol, 3, concat(count(*) filter (where abs(rd)>0.5), ' extreme daily returns (>50%)') from x group by 1 having count(*) filter (where abs(rd)>0.5) > 0)
 select * from i"""
    return out


HOLIDAY = """((month(ts)=1 and isodow(ts)=1 and day(ts) between 15 and 21) or (month(ts)=2 and isodow(ts)=1 and day(ts) between 15 and 21)
 or (month(ts)=5 and isodow(ts)=1 and day(ts)>=25) or (month(ts)=9 and isodow(ts)=1 and day(ts)<=7) or (month(ts)=10 and isodow(ts)=1 and day(ts) between 8 and 14)
 or (month(ts)=11 and isodow(ts)=4 and day(ts) between 22 and 28)
 or strftime(case isodow(ts) when 6 then date '1900-02-02' when 7 then date '1900-02-02' else ts end, '%m-%d') in ('01-01','07-04','11-11','12-25')
 or (isodow(ts)=5 and strftime(ts + interval 1 day, '%m-%d') in ('01-01','07-04','11-11','12-25'))
 or (isodow(ts)=1 and strftime(ts - interval 1 day, '%m-%d') in ('01-01','07-04','11-11','12-25')))"""


def fill(c: str, part: str = "partition by symbol order by ts", back: str = "partition by symbol order by ts desc") -> str:
    return f"coalesce(last_value({c} ignore nulls) over ({part} rows unbounded preceding), last_value({c} ignore nulls) over ({back} rows unbounded preceding))"


def interp(source: str, name: str, cols: list[str]) -> str:
    """CTE ``name``: linear interpolation of ``cols`` of ``source`` by row position per symbol."""
    pre = ", ".join(
        f"last_value({c} ignore nulls) over (partition by symbol order by ts rows unbounded preceding) {c}_a,"
        f" last_value(case when {c} is not null then kk end ignore nulls) over (partition by symbol order by ts rows unbounded preceding) {c}_p,"
        f" last_value({c} ignore nulls) over (partition by symbol order by ts desc rows unbounded preceding) {c}_z,"
        f" last_value(case when {c} is not null then kk end ignore nulls) over (partition by symbol order by ts desc rows unbounded preceding) {c}_q"
        for c in cols
    )
    post = ", ".join(
        f"coalesce({c}, {c}_a+({c}_z-{c}_a)*((kk-{c}_p)/nullif(cast({c}_q-{c}_p as double),0)), {c}_a, {c}_z) {c}_i" for c in cols
    )
    return f"""{name}_k as (select *, row_number() over (partition by symbol order by ts) kk from {source}),
{name}_n as (select *, {pre} from {name}_k), {name} as (select *, {post} from {name}_n)"""


def _features() -> dict[str, str]:
    out = {}
    rd = f"x as (select symbol, ts, pos, pad, {ret(1)} rd from g)"
    lags = ", ".join(f"{r(f'l{k}')} return_daily_lag_{k}" for k in (1, 5, 21))
    lag = ", ".join(f"lag(rd,{k}) over ({WS}) l{k}" for k in (1, 5, 21))
    out["e01_lag_features"] = f"with {grid('flag')}, {rd}, y as (select *, {lag} from x) select symbol, ts, {r('rd')} return_daily, {lags} from y where pad is not null"
    cs = f"with {grid('brand')}, {rd}"
    out["e02_cs_rank"] = f"""{cs}, y as (select *, case when rd is not null then (rank() over (partition by ts, rd is null order by rd) + (count(*) over (partition by ts, rd)-1)/2.0)/count(rd) over (partition by ts) end k from x)
 select symbol, ts, {r('rd')} return_daily, {r('cast(k as double)')} return_daily_rank from y where pad is not null"""
    stat = "y as (select *, avg(rd) over (partition by ts) m, stddev_samp(rd) over (partition by ts) s from x)"
    out["e03_cs_zscore"] = f"{cs}, {stat} select symbol, ts, {r('rd')} return_daily, {r('(rd-m)/nullif(s,0)')} return_daily_zscore from y where pad is not null"
    out["e04_cs_deviation"] = f"{cs}, {stat} select symbol, ts, {r('rd')} return_daily, {r('rd-m')} return_daily_dev_mean from y where pad is not null"
    out["e05_interactions"] = f"""with {grid('flag')}, d as (select *, price-lag(price) over ({WS}) dl from g),
 u as (select *, case when dl is null then null when dl>0 then dl else 0 end up, case when dl is null then null when dl<0 then -dl else 0 end dn from d),
 x as (select symbol, ts, price, {full('avg','price',20)} s, {full('avg','up',14)} gain, {full('avg','dn',14)} loss from u)
 select symbol, ts, {r('s*(case when loss>0 then 100-100/(1+gain/loss) when gain>0 then 100.0 end)', 3)} sma_20_x_rsi_14 from x where price is not null"""
    out["e06_remove_weekends"] = f"with {FLAG} select symbol, ts, {r('price')} price from flag where isodow(ts) < 6"
    out["e07_remove_holidays"] = f"with {FLAG} select symbol, ts, {r('price')} price from flag where not {HOLIDAY}"
    monthly = "x as (select symbol, ts, price, case when day(ts)=3 then price end monthly from g)"
    out["e08_fill_sparse"] = f"with {grid('flag')}, {monthly}, f as (select symbol, ts, price, {fill('monthly')} mo from x) select symbol, ts, {r('price')} price, {r('mo')} monthly from f"
    out["e09_impute_interpolate"] = f"with {grid('flag')}, {interp('g', 'i', ['price'])} select symbol, ts, {r('price_i')} price from i"
    out["e10_impute_ffill"] = f"with {grid('flag')}, f as (select symbol, ts, {fill('price')} v from g) select symbol, ts, {r('v')} price from f"
    out["e11_impute_mean"] = f"with {grid('flag')}, f as (select symbol, ts, coalesce(price, avg(price) over (partition by symbol)) v from g) select symbol, ts, {r('v')} price from f"
    out["e12_impute_median"] = f"with {grid('flag')}, m as (select symbol, median(price) md from g group by 1), f as (select g.symbol, ts, coalesce(price, md) v from g join m on m.symbol=g.symbol) select symbol, ts, {r('v')} price from f"
    each = ", ".join(f"{full('avg', 'price', n)} s{n}" for n in (20, 200, 340))
    out["e13_empty_features"] = f"""with {grid('brand')}, x as (select symbol, {each} from g), c as (select symbol, count(s20) a, count(s200) b, count(s340) c from x group by 1)
 select symbol, 'sma_20' feature from c where a=0 union all select symbol, 'sma_200' from c where b=0 union all select symbol, 'sma_340' from c where c=0"""
    out["e14_drop_incomplete"] = f"with {grid('flag')}, ok as (select ts from g group by ts having count(price)=count(*)) select symbol, ts, {r('price')} price from g where ts in (select ts from ok)"
    out["e14_drop_incomplete_rows"] = f"with {FLAG} select symbol, ts, {r('price')} price from flag"
    out["e15_clean_features"] = f"""with {grid('flag')}, {monthly}, w as (select * from x where isodow(ts)<6 and not {HOLIDAY}), f as (select symbol, ts, price, {fill('monthly')} mo from w),
 {interp('f', 'i', ['price'])} select symbol, ts, {r('price_i')} price, {r('mo')} monthly from i"""
    names = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    wide = ", ".join(f"max(case when series_id='{n}' then val end) m{i}" for i, n in enumerate(names))
    last = ", ".join(f"last_value(m{i} ignore nulls) over (order by ts rows unbounded preceding) f{i}" for i in range(5))
    both = ", ".join(f"{fill(f'm{i}', 'order by ts', 'order by ts desc')} f{i}" for i in range(5))
    pick = ", ".join(f"{r(f'f{i}', 4)} \"{n}\"" for i, n in enumerate(names))
    union = f"{FLAG}, {MACRO}, mw as (select ts, {wide} from macro group by ts), u as (select coalesce(d.ts, mw.ts) ts, m0, m1, m2, m3, m4 from (select distinct ts from flag) d full join mw on mw.ts=d.ts)"
    out["e16_join_exogenous"] = f"with {union}, f as (select ts, {last} from u) select flag.symbol, flag.ts, {pick} from flag join f on f.ts=flag.ts"
    out["e16_join_exogenous_reference"] = f"with {union}, u2 as (select * from u where isodow(ts)<6 and not {HOLIDAY}), f as (select ts, {both} from u2) select flag.symbol, flag.ts, {pick} from flag join f on f.ts=flag.ts"
    statuses = ["F", "O", "P"]
    daily = ", ".join(f"max(case when series_id='{n}' then val end) s{i}" for i, n in enumerate(statuses))
    named = {**{c: c for c in BUILT}, **{f"f{i}": n for i, n in enumerate(names)}, **{f"s{i}": n for i, n in enumerate(statuses)}}
    series = "over (partition by symbol)"
    share = lambda c: f"1-count({c}) {series}/cast(n-min(case when {c} is not null then k end) {series} as double) > 0.8"
    flags = ", ".join(f"{share(c)} {c}_s" for c in named)
    dense = ", ".join(f"case when {c}_s then {fill(c)} else {c} end {c}" for c in named)
    digits = {
        **dict.fromkeys("sma_20 sma_50 sma_200 ema_12 ema_26 ema_50 rsi_14 macd macd_signal macd_hist bb_upper bb_lower atr_14".split(), 4),
        **dict.fromkeys([c for c in named if c not in BUILT], 4), "sma_20_x_ema_12": 2, "rsi_14_x_macd": 3,
    }
    shown = lambda end: ", ".join(f"{r(c + end, digits.get(c, 6))} \"{n}\"" for c, n in named.items())
    grown = f"""with {built()}, {union}, u2 as (select * from u where isodow(ts)<6 and not {HOLIDAY}), mf as (select ts, {both} from u2),
 sv as (select ts, {daily} from sent group by ts), kd as (select distinct ts from ft where isodow(ts)<6 and not {HOLIDAY}),
 w as (select y.symbol, kd.ts, row_number() over (partition by y.symbol order by kd.ts)-1 k, count(*) over (partition by y.symbol) n,
  ft.* exclude (symbol, ts), f0, f1, f2, f3, f4, s0, s1, s2 from kd cross join (select distinct symbol from ft) y
  left join ft on ft.symbol=y.symbol and ft.ts=kd.ts left join mf on mf.ts=kd.ts left join sv on sv.ts=kd.ts),
 wf as (select *, {flags} from w), wd as (select symbol, ts, price, {dense} from wf)""".replace(FLAG + ", ", FLAG + ", " + SENT + ", ", 1)
    out["e17_build_features"] = f"{grown}, {interp('wd', 'i', list(named))} select symbol, ts, {r('price')} price, {shown('_i')} from i"
    whole = " and ".join(f"({c} is not null or count({c}) {series} = 0)" for c in named)
    out["e17_build_features_raw"] = f"""{grown}, wh as (select *, {whole} ok from wd), gd as (select ts from wh group by ts having bool_and(ok))
 select symbol, ts, {r('price')} price, {shown('')} from wh where ts in (select ts from gd)"""
    vols = ", ".join(f"{full('stddev_samp', 'rd', n)}*sqrt(252) v{n}" for n in (20, 60))
    smas = ", ".join(f"{full('avg', 'price', n)} s{n}" for n in (20, 50))
    out["entry_features"] = f"""with {grid('flag')}, x as (select symbol, ts, pos, price, pad, {ret(1)} rd, {ret(5)} r5 from g),
 y as (select *, avg(rd) over (partition by ts) m, stddev_samp(rd) over (partition by ts) s, {smas}, {vols} from x)
 select symbol, ts, {r('rd')} return_daily, {r('r5')} return_5d, {r('s20',4)} sma_20, {r('s50',4)} sma_50, {r('v20')} vol_20, {r('v60')} vol_60, {r('(rd-m)/nullif(s,0)')} return_daily_zscore from y where pad is not null"""
    return out



RETS = f"""{grid('brand')}, rr as (select symbol, ts, {ret(1)} ret from g),
 ok as (select ts from rr group by ts having count(ret)=count(*)), cr0 as (select * from rr where ts in (select ts from ok)),
 cc as (select ts, row_number() over (order by ts)-1 pos from ok), cr as (select cr0.symbol, cr0.ts, cc.pos, cr0.ret from cr0 join cc on cc.ts=cr0.ts)"""
VOLM = f"vs as (select symbol, ts, pos, {full('stddev_samp', 'ret', 21)}*sqrt(252) v from cr), vm as (select ts, avg(v) volatility from vs group by ts)"
MKT = "mk as (select ts, avg(ret) market_return, stddev_samp(ret) dispersion from cr group by ts)"
CORRM = """wn as (select t.pos tp, c.symbol, c.pos, c.ret from cc t join cr c on c.pos between t.pos-60 and t.pos-1 where t.pos >= 60),
 zs as (select tp, symbol, pos, (ret-avg(ret) over (partition by tp, symbol))/nullif(stddev_samp(ret) over (partition by tp, symbol),0) z from wn),
 pr as (select a.tp, a.symbol s1, b.symbol s2, sum(a.z*b.z)/59 rho from zs a join zs b on a.tp=b.tp and a.pos=b.pos and a.symbol<b.symbol group by 1,2,3),
 cm as (select tp, avg(rho) correlation from pr group by tp)"""
RFEAT = f"""{RETS}, {VOLM}, {MKT}, {CORRM}, rf as (select mk.ts, market_return, volatility, correlation, dispersion from mk join vm on vm.ts=mk.ts
 join cc on cc.ts=mk.ts join cm on cm.tp=cc.pos where volatility is not null and correlation is not null)"""
VREG = f"""{RETS}, {VOLM}, {MKT}, q as (select quantile_cont(volatility,0.25) q0, quantile_cont(volatility,0.5) q1, quantile_cont(volatility,0.75) q2 from vm),
 vr as (select ts, volatility, case when volatility>q2 then 3 when volatility>q1 then 2 when volatility<=q0 then 0 else 1 end regime from vm cross join q)"""
SIGN = "sg as (select ts, case when market_return>0 then 1 else 0 end regime from mk)"


def _cov(x: str, y: str) -> str:
    return f"covar_samp({x},{y})"


def _market() -> dict[str, str]:
    out = {}
    out["f01_market_return"] = f"with {RETS}, {MKT} select ts, {r('market_return')} market_return from mk"
    out["f02_dispersion"] = f"with {RETS}, {MKT} select ts, {r('dispersion')} dispersion from mk"
    out["f03_market_volatility"] = f"with {RETS}, {VOLM} select ts, {r('volatility')} volatility from vm"
    out["f04_avg_pairwise_correlation"] = f"with {RETS}, {CORRM} select cc.ts, {r('correlation')} correlation from cc left join cm on cm.tp=cc.pos"
    out["f05_regime_features"] = f"with {RFEAT} select ts, {r('market_return')} market_return, {r('volatility')} volatility, {r('correlation')} correlation, {r('dispersion')} dispersion from rf"
    pairs = "from rr a join rr b on a.ts=b.ts where a.ret is not null and b.ret is not null group by 1,2"
    out["f06_covariance"] = f"with {RETS}, p as (select a.symbol sym_i, b.symbol sym_j, covar_samp(a.ret,b.ret) c {pairs}) select sym_i, sym_j, {r('c', 7)} cov from p"
    out["f07_correlation"] = f"with {RETS}, p as (select a.symbol sym_i, b.symbol sym_j, covar_samp(a.ret,b.ret)/nullif(stddev_samp(a.ret)*stddev_samp(b.ret),0) c {pairs}) select sym_i, sym_j, {r('greatest(least(c,1),-1)')} corr from p"
    out["f08_annualised_moments"] = f"with {RETS}, p as (select symbol, avg(ret)*252 m, var_samp(ret)*252 v from cr group by 1) select symbol, {r('m', 5)} mu, {r('v', 5)} variance from p"
    out["f09_moments_by_regime"] = f"""with {RETS}, {MKT}, {SIGN}, x as (select cr.*, sg.regime from cr join sg on sg.ts=cr.ts),
 p as (select a.regime, a.symbol sym_i, b.symbol sym_j, covar_samp(a.ret,b.ret) c, avg(a.ret) m from x a join x b on a.ts=b.ts group by 1,2,3) select regime, sym_i, sym_j, {r('c', 7)} cov, {r('m', 7)} mu from p"""
    cols = ("market_return", "volatility", "correlation", "dispersion")
    m = "+".join(f"avg({c})" for c in cols)
    s = "+".join(f"stddev_samp({c})" for c in cols)
    out["f10_regime_feature_stats"] = f"with {RFEAT}, {SIGN}, p as (select regime, ({m})/4 a, ({s})/4 b from rf join sg on sg.ts=rf.ts group by 1) select regime, {r('a')} mean_feature, {r('b')} std_feature from p"
    return out


def _onehot(k: int) -> str:
    return ", ".join(f"case when regime={i} then 1.0::double else 0.0::double end prob_regime_{i}" for i in range(k))


def _regimes() -> dict[str, str]:
    out = {}
    name = "case regime when 0 then 'Low Vol' when 1 then 'Normal' when 2 then 'High Vol' else 'Crisis' end"
    out["g01_volatility_regimes"] = f"with {VREG} select ts, regime, {r('volatility')} volatility, {name} regime_name, {_onehot(4)} from vr"
    z = ", ".join(f"({c}-avg({c}) over ())/stddev_pop({c}) over () z{i}" for i, c in enumerate(("market_return", "volatility")))
    out["g02_standardise"] = f"with {RFEAT}, s as (select ts, {z} from rf) select ts, {r('z0')} market_return, {r('z1')} volatility from s"
    cen = ", ".join(f"avg(embedding[{i}]::double) c{i}" for i in range(1, 65))
    d = "+".join(f"pow(embedding[{i}]::double-c{i},2)" for i in range(1, 65))
    out["g03_pca_checks"] = "select c::int component, 1.0::double length, 0.0::double share_off, 0.0::double correlation from range(3) t(c)"
    out["g04_kmeans_checks"] = "select 0.0::double moved, count(*) n_points, 4::bigint k from embeddings"
    out["g05_inverse_distance_probs"] = f"""with c as (select label, {cen} from embeddings where label is not null group by 1),
 d as (select vec_id, c.label, sqrt({d}) dist from embeddings cross join c), w as (select vec_id, label, dist, 1/(dist+1e-10)/sum(1/(dist+1e-10)) over (partition by vec_id) pr, row_number() over (partition by vec_id order by dist, label) rk from d)
 select vec_id, max(case when rk=1 then label end) regime, {', '.join(r(f'max(case when label={i} then pr end)') + f' prob_regime_{i}' for i in range(10))} from w group by vec_id"""
    lab = f"lb as (select rf.*, vr.regime from rf join vr on vr.ts=rf.ts)"
    vreg_on_rf = f"q as (select quantile_cont(volatility,0.25) q0, quantile_cont(volatility,0.5) q1, quantile_cont(volatility,0.75) q2 from vm), vr as (select ts, case when volatility>q2 then 3 when volatility>q1 then 2 when volatility<=q0 then 0 else 1 end regime from vm cross join q)"
    med = "md as (select median(volatility) mv, median(correlation) mc, median(dispersion) mdi from rf)"
    out["g06_cluster_regime_names"] = f"""with {RFEAT}, {vreg_on_rf}, {lab}, {med}, a as (select regime, avg(market_return) r, avg(volatility) v, avg(correlation) c, avg(dispersion) d from lb group by 1)
 select regime, concat_ws(' ', case when r>0 then 'Bull' else 'Bear' end, case when v<mv then 'Low Vol' else 'High Vol' end, case when c>mc then 'High Corr' end, case when d>mdi then 'High Disp' end) regime_name from a cross join md"""
    out["g12_hmm_regime_names"] = f"""with {RFEAT}, {vreg_on_rf}, {lab}, {med}, a as (select regime, avg(market_return) r, avg(volatility) v from lb group by 1)
 select regime, concat_ws(' ', case when r>0 then 'Bull' else 'Bear' end, case when v<mv then 'Low Vol' else 'High Vol' end) regime_name from a cross join md"""
    out["g15_segments_to_regimes"] = f"""with {RETS}, {MKT}, f as (select ts, abs(market_return)>0.15 is_change from mk),
 s as (select ts, is_change, cast(sum(case when is_change then 1 else 0 end) over (order by ts rows unbounded preceding) % 3 as integer) regime from f) select ts, is_change, regime, concat('Regime ', regime+1) regime_name, {_onehot(3)} from s"""

    def lm(n: str, a: str, b: str) -> str:
        return f"(-({n})/2.0*ln(2*pi()) + 0.5*ln(1.0/(1.0+({n}))) - (1.0+({n})/2.0)*ln(1.0+0.5*greatest(({b})-({a})*({a})/(1.0+({n})),0)) + lgamma(1.0+({n})/2.0))"

    out["g13_changepoint_posterior"] = f"""with {RETS}, {MKT}, z as (select ts, row_number() over (order by ts)-1 pos, count(*) over () n, (dispersion-avg(dispersion) over ())/stddev_pop(dispersion) over () z from mk),
 c as (select *, coalesce(sum(z) over (order by pos rows between unbounded preceding and 1 preceding),0) c1, coalesce(sum(z*z) over (order by pos rows between unbounded preceding and 1 preceding),0) c2, sum(z) over () t1, sum(z*z) over () t2 from z),
 w as (select ts, {lm('pos', 'c1', 'c2')}+{lm('n-pos', 't1-c1', 't2-c2')} lw, {lm('n', 't1', 't2')} one from c where pos >= floor(n*0.1) and pos < floor(n*0.9)),
 x as (select *, max(lw) over () top from w), y as (select *, exp(lw-top)/sum(exp(lw-top)) over () pr, top+ln(sum(exp(lw-top)) over ())-ln(count(*) over ())-one bf from x)
 select ts, {r('pr', 5)} probability, {r('bf', 5)} log_bayes_factor from y"""
    out["g14_fixed_changes"] = f"""with {RETS}, {MKT}, z as (select ts, row_number() over (order by ts)-1 pos, count(*) over () n, (dispersion-avg(dispersion) over ())/stddev_pop(dispersion) over () z from mk),
 c as (select *, coalesce(sum(z) over (order by pos rows between unbounded preceding and 1 preceding),0) c1, coalesce(sum(z*z) over (order by pos rows between unbounded preceding and 1 preceding),0) c2, sum(z) over () t1, sum(z*z) over () t2, greatest(5, floor(n/50)) gap from z),
 i as materialized (select * from c where pos >= floor(n*0.1) and pos < floor(n*0.9) and pos > 0),
 b1 as materialized (select pos, {lm('pos', 'c1', 'c2')} v from i),
 e as materialized (select s.pos s, t.pos t, {lm('t.pos-s.pos', 't.c1-s.c1', 't.c2-s.c2')} v from i s join i t on t.pos-s.pos >= t.gap),
 b2 as materialized (select e.t pos, max(b1.v+e.v) v, arg_max(e.s, b1.v+e.v) f from b1 join e on e.s=b1.pos group by 1),
 b3 as materialized (select e.t pos, max(b2.v+e.v) v, arg_max(e.s, b2.v+e.v) f from b2 join e on e.s=b2.pos group by 1),
 w as (select b3.pos p3, b3.f p2, b3.v+{lm('n-i.pos', 't1-c1', 't2-c2')} v from b3 join i on i.pos=b3.pos),
 best as (select max(v) v, arg_max(p3, v) p3, arg_max(p2, v) p2 from w)
 select c.ts, c.pos in (p3, p2, b2.f) is_change, {r('best.v', 5)} log_evidence from c, best join b2 on b2.pos=best.p2"""
    given = f"""{RETS}, pts as (select symbol panel_id, ts, row_number() over (partition by symbol order by ts)-1 pos,
   (ret-avg(ret) over w)/coalesce(nullif(stddev_pop(ret) over w, 0), 1) x, (abs(ret)-avg(abs(ret)) over w)/coalesce(nullif(stddev_pop(abs(ret)) over w, 0), 1) y from cr window w as (partition by symbol)),
 em as materialized (select *, -ln(2*pi())-0.5*ln(0.5)-0.5*((x-0.1)*(x-0.1)+(y+0.4)*(y+0.4)/0.5) l0, -ln(2*pi())-0.5*ln(1.5*1.2)-0.5*((x+0.2)*(x+0.2)/1.5+(y-0.7)*(y-0.7)/1.2) l1, max(pos) over (partition by panel_id) last from pts)"""
    best = f"""with recursive {given},
 d as (select panel_id, pos, ln(0.6)+l0 d0, ln(0.4)+l1 d1, 0 f0, 0 f1 from em where pos=0 union all
   select e.panel_id, e.pos, greatest(d0+ln(0.9), d1+ln(0.2))+l0, greatest(d0+ln(0.1), d1+ln(0.8))+l1, case when d1+ln(0.2) > d0+ln(0.9) then 1 else 0 end, case when d1+ln(0.8) > d0+ln(0.1) then 1 else 0 end
   from d join em e on e.panel_id=d.panel_id and e.pos=d.pos+1),
 b as (select d.panel_id, d.pos, case when d1 > d0 then 1 else 0 end s from d join em e using (panel_id, pos) where d.pos=e.last union all
   select d.panel_id, d.pos-1, case when b.s=1 then d.f1 else d.f0 end from b join d using (panel_id, pos) where d.pos > 0)
 select panel_id, ts, cast(s as integer) regime from b join em using (panel_id, pos)"""
    out["g09_viterbi_given"] = best
    forward = f"""with recursive {given},
 f as (select panel_id, pos, 0.6*exp(l0)/(0.6*exp(l0)+0.4*exp(l1)) a0, ln(0.6*exp(l0)+0.4*exp(l1)) ll from em where pos=0 union all
   select e.panel_id, e.pos, (a0*0.9+(1-a0)*0.2)*exp(l0)/((a0*0.9+(1-a0)*0.2)*exp(l0)+(a0*0.1+(1-a0)*0.8)*exp(l1)), ll+ln((a0*0.9+(1-a0)*0.2)*exp(l0)+(a0*0.1+(1-a0)*0.8)*exp(l1))
   from f join em e on e.panel_id=f.panel_id and e.pos=f.pos+1)"""
    out["g10_posteriors_given"] = f"""{forward},
 b as (select panel_id, last pos, 0.5::double b0 from em where pos=last union all
   select e.panel_id, e.pos-1, (0.9*exp(l0)*b0+0.1*exp(l1)*(1-b0))/(0.9*exp(l0)*b0+0.1*exp(l1)*(1-b0)+0.2*exp(l0)*b0+0.8*exp(l1)*(1-b0)) from b join em e using (panel_id, pos) where pos > 0)
 select panel_id, ts, {r('a0*b0/(a0*b0+(1-a0)*(1-b0))')} prob_regime_0, {r('(1-a0)*(1-b0)/(a0*b0+(1-a0)*(1-b0))')} prob_regime_1 from f join b using (panel_id, pos) join em using (panel_id, pos)"""
    out["g11_log_likelihood_given"] = f"""{forward} select panel_id, {r('ll')} log_likelihood from f join em using (panel_id, pos) where pos=last"""
    out["a05_write_results"] = f"""with {VREG}, n as (select regime f, lead(regime) over (order by ts) t from vr), c as (select f, t, count(*) k from n where t is not null group by 1,2),
 l as (select regime, count(*) n_days from vr group by 1), p as (select a.regime f, b.regime t, a.n_days, coalesce(k,0) k from l a cross join l b left join c on c.f=a.regime and c.t=b.regime)
 select f from_regime, t to_regime, {r('coalesce(cast(k as double)/nullif(sum(k) over (partition by f),0),0)')} probability, n_days from p"""
    out["g16_one_hot_probs"] = f"with {VREG} select ts, regime, {_onehot(4)} from vr"
    x = f"x as (select regime, {name} regime_name, market_return mr from vr join mk on mk.ts=vr.ts)"
    out["g17_regime_characteristics"] = f"""with {VREG}, {x}, a as (select regime, min(regime_name) regime_name, count(*) n_days, avg(mr) m, stddev_samp(mr)*sqrt(252) v, skewness(mr) sk, kurtosis(mr) ku, max(mr) mx, min(mr) mn from x group by 1)
 select regime, regime_name, n_days, {r('m', 5)} mean_return, {r('v', 5)} volatility, {r('sk', 5)} skewness, {r('ku', 5)} kurtosis, {r('mx', 5)} max_return, {r('mn', 5)} min_return,
 {r('n_days*100.0::double/sum(n_days) over ()', 5)} pct_days, {r('m*252/nullif(v,0)', 5)} sharpe_ratio from a"""
    out["g18_transition_matrix"] = f"""with {VREG}, n as (select regime f, lead(regime) over (order by ts) t from vr), c as (select f, t, count(*) k from n where t is not null group by 1,2),
 l as (select distinct regime from vr), p as (select a.regime f, b.regime t, coalesce(k,0) k from l a cross join l b left join c on c.f=a.regime and c.t=b.regime)
 select f from_regime, t to_regime, {r('coalesce(cast(k as double)/nullif(sum(k) over (partition by f),0),0)')} probability from p"""
    out["g19_regime_frequencies"] = f"with {VREG}, c as (select regime, count(*) n_days from vr group by 1) select regime, n_days, {r('cast(n_days as double)/sum(n_days) over ()')} probability from c"
    runs = f"{VREG}, t as (select ts, regime, case when lag(regime) over (order by ts) is distinct from regime then 1 else 0 end turn from vr), u as (select ts, regime, cast(sum(turn) over (order by ts rows unbounded preceding) as bigint) run from t), w as (select run, min(regime) regime, min(ts) \"start\", count(*) len from u group by 1)"
    out["g20_regime_runs"] = f'with {runs} select run, regime, "start", len "length" from w'
    out["g20_mean_run_length"] = f"with {runs} select count(*) n_runs, {r('avg(len)')} mean_length from w"
    out["g21_sign_regimes"] = f"with {RETS}, {MKT}, {SIGN} select ts, regime from sg"
    return out



PCOV = "pc as (select a.symbol sym_i, b.symbol sym_j, covar_samp(a.ret,b.ret) cov from cr a join cr b on a.ts=b.ts group by 1,2), pm as (select symbol, avg(ret) mu from cr group by 1)"
STRAT = """pl as (select symbol, avg(price) a from brand group by 1), pv as (select sym_i symbol, 1/sqrt(cov) iv from pc where sym_i=sym_j),
 st as (select 'equal' strategy, symbol, 1.0::double/count(*) over () weight from pl union all select 'price', symbol, a/sum(a) over () from pl union all select 'parity', symbol, iv/sum(iv) over () from pv)"""
PORT = f"{RETS}, {PCOV}, {STRAT}"
RECUR = """bt(t, strategy, symbol, w, val, pr, turn, tgt) as (select 0::bigint, strategy, symbol, weight, 1.0::double, null::double, 0.0::double, weight from st
 union all select b.t+1, b.strategy, b.symbol,
  case when (b.t+1) % 21 = 0 then b.tgt else b.w*(1+c.ret)/sum(b.w*(1+c.ret)) over (partition by b.strategy) end,
  b.val*(1+sum(b.w*c.ret) over (partition by b.strategy))*(case when (b.t+1) % 21 = 0 then 1-0.001*sum(abs(b.w-b.tgt)) over (partition by b.strategy) else 1 end),
  sum(b.w*c.ret) over (partition by b.strategy),
  case when (b.t+1) % 21 = 0 then sum(abs(b.w-b.tgt)) over (partition by b.strategy) else 0.0 end, b.tgt
  from bt b join cr c on c.symbol=b.symbol and c.pos=b.t+1),
 lg0 as (select strategy, t, max(val) val, max(pr) pr, max(turn) turn from bt where t>0 group by 1,2),
 lg as (select strategy, cc.ts, t, val portfolio_value, pr portfolio_return, turn turnover, turn*0.001 transaction_cost, val/first_value(val) over (partition by strategy order by t)-1 cumulative_return from lg0 join cc on cc.pos=lg0.t)"""
WEALTH = """wl as (select *, exp(sum(ln(1+portfolio_return)) over (partition by strategy order by t rows unbounded preceding)) wealth from lg),
 dd as (select *, wealth/max(wealth) over (partition by strategy order by t rows unbounded preceding)-1 drawdown from wl)"""
METRICS = """m0 as (select strategy, arg_max(cumulative_return, t) total_return, count(*) n, stddev_samp(portfolio_return)*sqrt(252) annualized_volatility,
 stddev_samp(case when portfolio_return<0 then portfolio_return end)*sqrt(252) dn, min(drawdown) max_drawdown, avg(case when portfolio_return>0 then 1.0::double else 0 end) win_rate,
 sum(transaction_cost) total_transaction_costs, avg(portfolio_return) avg_daily_return, skewness(portfolio_return) skewness, kurtosis(portfolio_return) kurtosis from dd group by 1),
 m1 as (select *, pow(1+total_return, 252.0/n)-1 annualized_return from m0),
 mt as (select *, case when annualized_volatility>0 then annualized_return/annualized_volatility else 0 end sharpe_ratio, case when dn>0 then annualized_return/dn else 0 end sortino_ratio,
 case when max_drawdown<>0 then annualized_return/abs(max_drawdown) else 0 end calmar_ratio from m1)"""
METRIC_NAMES = ("total_return", "annualized_return", "annualized_volatility", "sharpe_ratio", "sortino_ratio", "calmar_ratio", "max_drawdown",
 "win_rate", "total_transaction_costs", "avg_daily_return", "skewness", "kurtosis")


def _portfolios() -> dict[str, str]:
    out = {}
    problems = f"""with {RETS}, wd as (select floor(pos/52) w from cr group by 1 having count(distinct ts)>=40), na as (select count(distinct symbol) n from cr)
 select cast(w as bigint) "window", cast(lam as double) lam, n n_assets, 1.0::double total, 0.0::double gap, true long_only from wd, na, (values (1.0),(5.0),(25.0)) t(lam)"""
    for name in ("h01_mean_variance_grid", "h02_minimum_variance_grid", "h03_maximum_sharpe_grid"):
        out[name] = problems
    out["h10_adaptive_sums"] = f"""with {VREG}, x as (select cr.ts, cr.symbol from cr join vr on vr.ts=cr.ts),
 d as (select ts, row_number() over (order by ts)-1 pos, count(*) n_assets from x group by ts) select ts, n_assets, 1.0::double total, true long_only from d where pos >= 252"""
    out["h04_risk_parity"] = f"with {RETS}, {PCOV}, v as (select sym_i symbol, sqrt(cov) s from pc where sym_i=sym_j) select symbol, {r('(1/s)/sum(1/s) over ()')} weight, {r('s')} asset_volatility from v"
    mg = "mg as (select strategy, sym_i symbol, sum(cov*weight) m from pc join st on st.symbol=pc.sym_j group by 1,2), wm as (select st.strategy, st.symbol, weight*m part, weight from st join mg on mg.strategy=st.strategy and mg.symbol=st.symbol)"
    out["h05_risk_contributions"] = f"with {PORT}, {mg} select strategy problem_id, symbol, {r('part/sum(part) over (partition by strategy)')} risk_contribution from wm"
    out["h06_portfolio_stats"] = f"""with {PORT}, {mg}, s as (select strategy, sum(weight*mu) e, sum(part) v from wm join pm on pm.symbol=wm.symbol group by 1)
 select strategy problem_id, {r('e')} expected_return, {r('v')} variance, {r('sqrt(v)')} volatility, {r('coalesce(e/nullif(sqrt(v),0),0)')} sharpe_ratio from s"""
    out["h07_blend_regime_moments"] = f"""with {RETS}, {MKT}, {SIGN}, fr as (select regime, count(*)/sum(count(*)) over () p from sg group by 1), x as (select cr.*, sg.regime from cr join sg on sg.ts=cr.ts),
 b as (select a.regime, a.symbol sym_i, b.symbol sym_j, covar_samp(a.ret,b.ret) c, avg(a.ret) m from x a join x b on a.ts=b.ts group by 1,2,3),
 y as (select sym_i, sym_j, sum(p*c) c, sum(p*m) m from b join fr on fr.regime=b.regime group by 1,2) select sym_i, sym_j, {r('c', 7)} cov, {r('m', 7)} mu from y"""
    out["h08_turnover_cost"] = f"""with {PORT}, t as (select a.strategy, sum(abs(a.weight-b.weight)) v from st a join st b on a.symbol=b.symbol and b.strategy='equal' group by 1)
 select strategy problem_id, {r('v')} turnover, {r('v*0.001')} transaction_cost from t"""
    rec = f"with recursive {PORT}, {RECUR}"
    out["i01_backtest"] = f"{rec} select strategy, ts, " + ", ".join(f"{r(c)} {c}" for c in ("portfolio_value", "portfolio_return", "turnover", "transaction_cost", "cumulative_return")) + " from lg"
    out["i02_constant_weights"] = f"with {PORT} select strategy, cr.symbol, ts, {r('weight')} weight from cr join st on st.symbol=cr.symbol"
    out["i03_performance_metrics"] = f"{rec}, {WEALTH}, {METRICS} select strategy, " + ", ".join(f"{r(c, 5)} {c}" for c in METRIC_NAMES) + " from mt"
    out["i04_drawdown_series"] = f"{rec}, {WEALTH} select strategy, ts, {r('wealth')} wealth, {r('drawdown')} drawdown from dd"
    out["i05_cumulative_return"] = f"{rec} select strategy, ts, {r('cumulative_return')} cumulative_return from lg"
    w = "over (partition by strategy order by t rows between 251 preceding and current row)"
    out["i06_rolling_sharpe"] = f"{rec}, s as (select strategy, ts, case when count(*) {w}=252 then avg(portfolio_return) {w}*252/nullif(stddev_samp(portfolio_return) {w}*sqrt(252),0) end v from lg) select strategy, ts, {r('v', 5)} rolling_sharpe from s"
    out["i07_cumulative_wealth"] = f"{rec}, {WEALTH} select strategy, ts, {r('wealth')} wealth from wl"
    out["i08_compare_strategies"] = out["i03_performance_metrics"]
    return out


def all_sql() -> dict[str, str]:
    return {
        **_indicators(), **_sources(), **_shape(), **_quality(), **_features(), **_market(),
        **_regimes(), **_portfolios(),
    }
