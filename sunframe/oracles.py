"""DuckDB SQL for the queries: written from the specification, apart from the Spark code."""

from __future__ import annotations

import itertools
import math

from sunframe.plant import PV, WT

H, PRE = 10, 5
FEATURES = ("p_solar", "pac", "temp_module", "mean_prev_h")


def r(expression: str, name: str) -> str:
    """Rounded like ``rounded`` in Spark: a nudge takes exact halves, which engines round differently, to one side."""
    return f"round({expression} + 2e-10, 6) + 0.0 as {name}"


_TELEMETRY = """
 select h as ts, epoch(h)::bigint as t, row_number() over (order by h) - 1 as rn,
 round(case when day(h)=7 and hour(h)=12 then 2.5 when day(h)=14 and hour(h)=12 then 12.0 when hour(h)=3 then 0.0
   else greatest((av-30.0)/40.0,-0.05) end + 2e-10,6) as poa_irr,
 round(5.0+au*20.0/150.0 + 2e-10,6) as temperature,
 round(case when day(h) in (7,14) and hour(h)=12 then 30.0 else n*0.4 end + 2e-10,6)::double as wind_speed,
 round(least(greatest(mn/5.0,0.05),1.5) + 2e-10,6) as humidity,
 round(1000.0+mx/50.0 + 2e-10,6) as pressure,
 round(case when hour(h)=3 then 0.0005 else (av/12.0)*(case when hour(h)%6=5 then 0.25 else 1.0 end) end + 2e-10,6) as p_solar,
 round(greatest((av-30.0)/45.0,0.0) + 2e-10,6) as ghi, round(fmod(au*7.0,360.0) + 2e-10,6) as wind_dir, round(n*0.15 + 2e-10,6)::double as p_wind
 from (select date_trunc('hour',ts) h, count(*) n, sum(value::decimal(18,6))::double/count(*) av, sum(user_id)::double/count(*) au, min(value) mn, max(value) mx from events group by 1) e"""


def _string(s: int) -> str:
    p = PV.strings[s]
    n = p.name
    return f"""temperature + poa_irr*1000.0*exp({p.a} + {p.b}*wind_speed) as {n}_tm,
 temperature + poa_irr*1000.0*exp({p.a} + {p.b}*wind_speed) + poa_irr*1000.0/{PV.e_stc}*{p.d_t} as {n}_tc,
 {float(p.n_series * p.n_parallel)}*(poa_irr*1000.0/{PV.e_stc}*{p.pmp_stc}*(1.0 + {p.gamma_mp}*(temperature + poa_irr*1000.0*exp({p.a} + {p.b}*wind_speed) + poa_irr*1000.0/{PV.e_stc}*{p.d_t} - {PV.t_stc}))) as {n}_array"""


_A, _B = PV.strings
_POWER = f"select *, {_A.eff_max / 100}*a_array as a_pac, {_B.eff_max / 100}*b_array as b_pac from (select *, {_string(0)}, {_string(1)} from telemetry)"


def _level(n: str, cap: float) -> str:
    return f"case when {n}_pac > {cap} then {cap} when {n}_pac < 0 then 0.0 end"


def _take(level: str, strings: str) -> str:
    return ", ".join(f"coalesce({level}, {n}_{c}) as {n}_{c}" for n in strings for c in ("tm", "tc", "array", "pac"))


_OUT = "(coalesce(a_pac,0)+coalesce(b_pac,0))/1000 as pac, (coalesce(a_array,0)+coalesce(b_array,0))/1000 as pdc, (a_tm+b_tm)/2 as temp_module, (a_tc+b_tc)/2 as temp_cell"
_KEPT = "ts, t, rn, poa_irr, temperature, wind_speed, humidity, pressure, p_solar, ghi, wind_dir, p_wind"
_ROW = f"""select {_KEPT}, {_OUT} from (
 select {_KEPT}, {_take("lb", "ab")} from (
 select *, {_level("b", _B.p_max)} as lb from (
 select * exclude (a_tm, a_tc, a_array, a_pac), {_take("la", "a")} from (select *, {_level("a", _A.p_max)} as la from power))))"""
_COLUMN = f"select {_KEPT}, {_OUT} from (select * exclude (a_pac, b_pac), least(greatest(a_pac,0.0),{_A.p_max}) as a_pac, least(greatest(b_pac,0.0),{_B.p_max}) as b_pac from power)"
_CLEAN = """select * exclude (p_solar, pac), case when p1 <= 0.001 then 0.0 else p1 end as p_solar, case when pac <= 0.001 then 0.0 else pac end as pac
 from (select *, case when pac >= p_solar*1.5 then pac else p_solar end as p1 from pv)"""


def _rolling(x: str, f: str) -> str:
    return f"case when count({x}) over w = {H} then {f}({x}) over w end"


_EXPANDED = f"""select *, hour(ts)::int as hour_of_day, {_rolling("p_solar", "avg")} as mean_prev_h, {_rolling("p_solar", "stddev_samp")} as std_prev_h,
 {_rolling("wind_speed", "avg")} as mean_wind_prev_h, {_rolling("wind_speed", "stddev_samp")} as std_wind_prev_h
 from clean window w as (order by rn rows between {H - 1} preceding and current row)"""
LAGS = [(f, i) for f in FEATURES for i in range(PRE, -1, -1)]
INPUTS = [f"{f}_lag{i}" if i else f"{f}_now" for f, i in LAGS]
OUTPUTS = [f"p_solar_lead{i}" for i in range(1, H + 1)]
_WIDE = "select rn, t, " + ", ".join(
    [f"lag({f},{i}) over w as {n}" if i else f"{f} as {n}" for (f, i), n in zip(LAGS, INPUTS, strict=True)] + [f"lead(p_solar,{i}) over w as p_solar_lead{i}" for i in range(1, H + 1)]
) + " from expanded window w as (order by rn)"
_FRAMED = "select * from wide where " + " and ".join(f"{c} is not null" for c in INPUTS + OUTPUTS)
_DEFAULT = ("temperature humidity wind_speed wind_dir ghi poa_irr p_wind p_solar pressure pac pdc temp_module temp_cell hour_of_day mean_prev_h std_prev_h mean_wind_prev_h std_wind_prev_h").split()
_SHIFTED = [(f"{f}_lag{i}" if i else f"{f}_now", f"lag({f},{i}) over w" if i else f) for f in _DEFAULT for i in range(PRE, -1, -1)] + [(f"p_solar_lead{i}", f"lead(p_solar,{i}) over w") for i in range(1, H + 1)]
_WIDE18 = "select rn, " + ", ".join(f"{x} as {n}" for n, x in _SHIFTED) + " from expanded window w as (order by rn)"
_FRAMED18 = "select * from wide18 where " + " and ".join(f"{n} is not null" for n, _ in _SHIFTED)
_SAMPLES = "select *, row_number() over (order by rn) - 1 as sample_id, count(*) over () as n from framed"
_TREE = "select *, case when sample_id < n - ceil(0.1*n) then 'train' else 'test' end as split from samples"
_NET = """select *, case when sample_id < floor(0.7*n) then 'train'
 when sample_id < floor(0.7*n) + floor((n - floor(0.7*n))*(20/30.0)) then 'validation' else 'test' end as split from samples"""
_PAIRS = "select sample_id, h, p_solar_now as forecast, observed from (" + " union all ".join(f"select sample_id, {i} as h, p_solar_now, p_solar_lead{i} as observed from tree where split='test'" for i in range(1, H + 1)) + ")"
_ERRORS = "select h, avg((forecast-observed)*(forecast-observed)) as mse, sqrt(avg((forecast-observed)*(forecast-observed))) as rmse, avg(abs(forecast-observed)) as mae from pairs group by h"

_CTES = {
    "telemetry": _TELEMETRY, "power": _POWER, "pv": _ROW, "pvc": _COLUMN, "clean": _CLEAN, "expanded": _EXPANDED, "wide": _WIDE, "framed": _FRAMED,
    "samples": _SAMPLES, "wide18": _WIDE18, "framed18": _FRAMED18, "tree": _TREE, "net": _NET, "pairs": _PAIRS, "errors": _ERRORS,
}
_NEEDS = {
    "power": ["telemetry"], "pv": ["power"], "pvc": ["power"], "clean": ["pv"], "expanded": ["clean"], "wide": ["expanded"], "framed": ["wide"], "wide18": ["expanded"], "framed18": ["wide18"],
    "samples": ["framed"], "tree": ["samples"], "net": ["samples"], "pairs": ["tree"], "errors": ["pairs"],
}


def sql(body: str, *tables: str, recursive: bool = False) -> str:
    """``body`` after the tables it needs."""
    need: list[str] = []

    def add(name: str) -> None:
        for n in _NEEDS.get(name, []):
            add(n)
        if name not in need:
            need.append(name)

    for name in tables:
        add(name)
    return f"with {'recursive ' if recursive else ''}" + ",\n".join(f"{n} as ({_CTES[n]})" for n in need) + ("," if recursive else "") + "\n" + body


def curve(x: str, xp: tuple[float, ...], fp: tuple[float, ...], left: float, right: float) -> str:
    """Piecewise-linear lookup as a CASE."""
    arms = [f"when {x} < {xp[0]} then {left}"]
    arms += [f"when {x} < {b} then {(d - c) / (b - a)}::double*({x} - {a}) + {c}" for a, b, c, d in zip(xp, xp[1:], fp, fp[1:], strict=False)]
    return f"case {' '.join(arms)} when {x} = {xp[-1]} then {fp[-1]} else {right} end"


def scaled(kind: str, x: str, over: str) -> str:
    """A scaler fitted on the training rows, as an expression over windows-free scalars ``lo``, ``hi``, ``mu``, ``sd``."""
    if kind == "Standard":
        return f"({x} - {over}.mu)/(case when {over}.sd = 0 then 1 else {over}.sd end)"
    low, span = (0.0, 1.0) if kind == "MinMax01" else (-1.0, 2.0)
    return f"({x} - {over}.lo)*({span}/(case when {over}.hi = {over}.lo then 1 else {over}.hi - {over}.lo end)) + {low}"


def fit(columns: list[str], table: str, name: str) -> str:
    """A one-row table of the statistics of the columns' training values together."""
    values = " union all ".join(f"select {c}::double as v from {table} where split='train'" for c in columns)
    return f"{name} as (select min(v) lo, max(v) hi, avg(v) mu, stddev_pop(v) sd from ({values}))"


def scale_query(kind: str) -> str:
    body = f", {fit(['p_solar_now'], 'tree', 's1')}, {fit(['temp_module_lag5'], 'tree', 's2')} select sample_id, {r(scaled(kind, 'p_solar_now', 's1'), 'p_solar_now')}, {r(scaled(kind, 'temp_module_lag5', 's2'), 'temp_module_lag5')} from tree, s1, s2"
    return sql(body, "tree")


def cross_scaled_query() -> str:
    fits = ", ".join([fit(["p_solar_now"], "tree", "sx"), *(fit([c], "tree", f"sy{i + 1}") for i, c in enumerate(OUTPUTS))])
    rows = " union all ".join(f"select sample_id, {i} as h, {r(f'(p_solar_now - sx.mu)/sx.sd*sy{i}.sd + sy{i}.mu', 'forecast')}, {r(f'p_solar_lead{i}', 'observed')} from tree, sx, sy{i} where split='test'" for i in range(1, H + 1))
    return sql(f", {fits} select sample_id, h::int as h, forecast, observed from ({rows})", "tree")


def tensor_query() -> str:
    rows = " union all ".join(f"select rn, {PRE - i} as step, {FEATURES.index(f)} as feature, {r(n, 'value')} from framed" for (f, i), n in zip(LAGS, INPUTS, strict=True))
    return sql(f"select rn, step::int as step, feature::int as feature, value from ({rows})", "framed")


def legacy_query() -> str:
    nx, ny = f"(ceil(n/{PRE + 1}.0)*{PRE + 1})", f"(ceil(n/{H}.0)*{H})"
    return sql(f"select rn from framed, (select count(*) n from telemetry) c where rn between {PRE} and {PRE} + least({nx} - {2 * PRE + 1 + H}, {ny} - {PRE + H + 2}) - 1", "framed")


RELAX = 0.35
#: Recursion over rows: the value, whether it was damped, then the rewrite of the row before.
RELAXATION = sql(
    f""" fold(rn, v, damped) as (
  select rn, temp_module, false from pv where rn = 0
  union all
  select p.rn, case when abs({RELAX}*(p.temp_module - f.v)) >= 5 then f.v + 0.1*({RELAX}*(p.temp_module - f.v)) else f.v + {RELAX}*(p.temp_module - f.v) end,
    abs({RELAX}*(p.temp_module - f.v)) >= 5 from fold f join pv p on p.rn = f.rn + 1)
 select rn, {r("case when lead(damped) over (order by rn) then lead(v) over (order by rn) else v end", "relaxed")} from fold""",
    "pv",
    recursive=True,
)
#: Air properties that do not depend on the panel, then the recursion.
_FOLD = (
    f""" air as (
  select rn, poa_irr as e, temperature as c, temperature + 273.15 as ta, pressure*100.0 as p, least(humidity, 1.0) as rh, abs(wind_speed) as v, temp_module as tm from pv),
 gas as (
  select *, least(greatest(rh*611.21*exp((18.678 - c/234.5)*c/(257.14 + c))/p, 0.0), 1.0) as x,
    1.716e-5*pow(ta/273.15, 1.5)*(273.15 + 110.4)/(ta + 110.4) as mua, 1.12e-5*pow(ta/350.0, 1.5)*(350.0 + 1064.0)/(ta + 1064.0) as muv,
    0.0241*pow(ta/273.15, 1.5)*(273.15 + 194.4)/(ta + 194.4) as ka, 0.0181*pow(ta/300.0, 1.35) as kv,
    p/(285.9*ta)*(1 + rh)/(1 + rh*461.5/285.9) as rho from air),
 wilke as (
  select *, pow(1 + sqrt(mua/muv)*pow(18.02/28.96, 0.25), 2)/(sqrt(8.0)*sqrt(1 + 28.96/18.02)) as pav,
    pow(1 + sqrt(muv/mua)*pow(28.96/18.02, 0.25), 2)/(sqrt(8.0)*sqrt(1 + 18.02/28.96)) as pva, x*18.02/(x*18.02 + (1 - x)*28.96) as w from gas),
 mix as (
  select *, (1 - x)*mua/((1 - x) + x*pav) + x*muv/(x + (1 - x)*pva) as mu, (1 - x)*ka/((1 - x) + x*pav) + x*kv/(x + (1 - x)*pva) as k, (1 - w)*1006.0 + w*1860.0 as cp from wilke),
 flow as (
  select *, rho*v*10.0/mu as re, cp*mu/k as pr,
    list_sum(list_transform(range(1, 100), lambda i: (case when rho*v*(10.0*i/99.0)/mu <= 1e5 then 0.453*sqrt(rho*v*(10.0*i/99.0)/mu) else 0.0308*pow(rho*v*(10.0*i/99.0)/mu, 0.8) end)*pow(cp*mu/k, 1/3.0)*k/(10.0*i/99.0)))/100 as forced
  from mix),
 -- One row ahead of the panel's temperature t: convection, then the step.
 fold(rn, v, damped) as (
  select rn, {{step}}, false from (select f.*, 273.15 + f.tm as t from flow f where rn = 0)
  union all
  select rn, case when abs(n - t) >= 5 then t + 0.1*(n - t) else n end, abs(n - t) >= 5
  from (select rn, t, {{step}} as n from (select f.*, o.v as t from fold o join flow f on f.rn = o.rn + 1)))
,
 panel as (select rn, tm, case when lead(damped) over (order by rn) then lead(fold.v) over (order by rn) else fold.v end - 273.15 as rp from fold join (select rn, tm from air) using (rn))""".replace(
        "{step}",
        "t + (1000.0*e*15.0*0.53*0.3 + {h}*15.0*(ta - t) + (case when t >= ta then -0.3*5.670374419e-8*15.0*(pow(t, 4) - pow(ta, 4)) else 0.0 end))"
        "*((case when {h} = 1e-16 then 0.0 else 1/({h}*15.0) end) + 0.1/(350.0*15.0*2))".replace(
            "{h}",
            "(case when re < 1e3 and {ra} > 1e4 and {ra} < 1e7 then 0.54*pow({ra}, 0.25)*k/10.0 when re < 1e3 and {ra} > 1e7 and {ra} < 1e11 then 0.15*pow({ra}, 1/3.0)*k/10.0 when forced = 0 then 1e-16 else forced end)".replace(
                "{ra}", "(9.81/ta*abs(t - ta)*pow(15.0/23.0, 3)/pow(mu/rho, 2)*pr)"
            ),
        ),
    )
)
THERMAL = sql(f"{_FOLD} select rn, {r('tm', 'temp_module')}, {r('rp', 'temp_module_rp')} from panel", "pv", recursive=True)
DEFAULT_INPUTS = [f"{f}_lag{i}" if i else f"{f}_now" for f in _DEFAULT for i in range(PRE, -1, -1)]
EXPANDED_DEFAULT = sql(f"{_FOLD} select rn::bigint as rn, hour_of_day, {', '.join(r(c, c) for c in _DEFAULT if c != 'hour_of_day')}, {r('rp', 'temp_module_rp')} from expanded join panel using (rn)", "expanded", recursive=True)
_DAILY_LEADS = ", ".join(f"lead(q,{i}) over (order by rn) as y{i}" for i in range(1, 6))
DEMAND = f"""with d as (select row_number() over (order by l_shipdate) - 1 as rn, sum(l_quantity) as q from lineitem group by l_shipdate),
 f as (select rn, q, lag(q,5) over (order by rn) as x5, {_DAILY_LEADS} from d),
 s as (select *, row_number() over (order by rn) - 1 as sample_id, count(*) over () as n from f where x5 is not null and y5 is not null),
 p as ({" union all ".join(f"select {i} as h, q as forecast, y{i} as observed from s where sample_id >= n - ceil(0.1*n)" for i in range(1, 6))})
 select h::int as h, {r("avg((forecast-observed)*(forecast-observed))", "mse")}, {r("sqrt(avg((forecast-observed)*(forecast-observed)))", "rmse")}, {r("avg(abs(forecast-observed))", "mae")} from p group by h"""

class _Unrolled:
    """A network written out as one SELECT a layer and step: every unit is a column."""

    def __init__(self) -> None:
        self._weights, self._names, self.tables = itertools.count(), itertools.count(), []

    def weights(self, *shape: int) -> list:
        """The given weights, in the order in which networks hold them."""
        if len(shape) == 1:
            return [0.4 * math.sin(1.0 + 7.0 * next(self._weights)) for _ in range(shape[0])]
        return [self.weights(*shape[1:]) for _ in range(shape[0])]

    def add(self, expressions: list[str]) -> list[str]:
        """Columns of the next table."""
        names = [f"u{next(self._names)}" for _ in expressions]
        before = f"net{len(self.tables) - 1}" if self.tables else "framed"
        self.tables.append(f"net{len(self.tables)} as materialized (select *, {', '.join(f'{e} as {n}' for e, n in zip(expressions, names, strict=True))} from {before})")
        return names

    @staticmethod
    def affine(terms: list[tuple[str, float]], bias: float) -> str:
        return " + ".join([f"{x}*({w!r})" for x, w in terms] + [f"({bias!r})"])

    @staticmethod
    def active(kind: str, z: str) -> str:
        return {"linear": f"({z})", "tanh": f"tanh({z})", "relu": f"greatest({z}, 0.0)", "sigmoid": f"1/(1 + exp(-({z})))"}[kind]

    def dense(self, steps: list[list[str]], width: int, kind: str) -> list[list[str]]:
        w, b = self.weights(len(steps[0]), width), self.weights(width)
        return [self.add([self.active(kind, self.affine([(x, w[i][o]) for i, x in enumerate(step)], b[o])) for o in range(width)]) for step in steps]

    def convolution(self, steps: list[list[str]], filters: int, size: int, left: int, kind: str) -> list[list[str]]:
        w, b = self.weights(size, len(steps[0]), filters), self.weights(filters)
        out = []
        for t in range(len(steps)):
            seen = [(k, t + k - left) for k in range(size) if 0 <= t + k - left < len(steps)]
            out.append(self.add([self.active(kind, self.affine([(x, w[k][i][o]) for k, at in seen for i, x in enumerate(steps[at])], b[o])) for o in range(filters)]))
        return out

    def pool(self, steps: list[list[str]], size: int) -> list[list[str]]:
        parts = [steps[i : i + size] for i in range(0, len(steps), size)]
        return [self.add([f"greatest({', '.join(column)})" for column in zip(*part, strict=True)]) for part in parts]

    def memory(self, steps: list[list[str]], units: int, kind: str) -> list[list[str]]:
        """Gates in the order input, forget, cell, output; steps are never the mask value here."""
        kernel, recurrent, b = self.weights(len(steps[0]), 4 * units), self.weights(units, 4 * units), self.weights(4 * units)
        h, c, out = ["0.0::double"] * units, ["0.0::double"] * units, []
        for step in steps:
            z = [self.affine([(x, kernel[i][g]) for i, x in enumerate(step)] + [(x, recurrent[i][g]) for i, x in enumerate(h)], b[g]) for g in range(4 * units)]
            gates = self.add([self.active(kind if 2 * units <= g < 3 * units else "sigmoid", e) for g, e in enumerate(z)])
            i, f, g, o = (gates[k * units : (k + 1) * units] for k in range(4))
            c = self.add([f"{f[u]}*{c[u]} + {i[u]}*{g[u]}" for u in range(units)])
            h = self.add([f"{o[u]}*{self.active(kind, c[u])}" for u in range(units)])
            out.append(h)
        return out


def network_query(model: str) -> str:
    """Forecasts of the small networks with given weights."""
    net = _Unrolled()
    steps = [net.add([f"{f}_lag{i}/10" if i else f"{f}_now/10" for f in FEATURES]) for i in range(PRE, -1, -1)]
    if model == "CNN":
        steps = net.dense(net.convolution(steps, 3, 2, 0, "tanh"), 2, "linear")
        steps = net.dense(net.pool(steps, 3), 3, "relu")
        last = net.dense([[x for step in steps for x in step]], 2, "tanh")
    elif model == "LSTM":
        steps = net.memory(net.memory(net.dense(steps, 2, "linear"), 3, "tanh"), 2, "tanh")
        last = net.dense(net.dense(steps[-1:], 3, "relu"), 2, "linear")
    else:
        steps = net.dense(net.convolution(steps, 3, 3, 2, "tanh"), 2, "linear")
        steps = net.dense(net.pool(steps, 2), 3, "relu")
        last = net.dense(net.memory(net.memory(steps, 3, "sigmoid"), 2, "sigmoid")[-1:], 2, "sigmoid")
    rows = " union all ".join(f"select rn::bigint as rn, {h}::int as h, {r(x, 'forecast')} from net{len(net.tables) - 1}" for h, x in enumerate(last[0], 1))
    return sql(", " + ",\n".join(net.tables) + " " + rows, "framed")


def _points(name: str, xs: tuple[float, ...], ys: tuple[float, ...]) -> str:
    return " union all ".join(f"select '{name}' as curve, {i}::int as point, {x}::double as x, {y}::double as y" for i, (x, y) in enumerate(zip(xs, ys, strict=True)))


_PANELS = "select ts, t, unnest(['poa_irr', 'p_solar', 'wind_speed', 'p_wind']) as panel, unnest([poa_irr, p_solar, wind_speed, p_wind]) as value from telemetry"
_KINDS = " union all ".join(
    f"select '{kind}' as kind, {i} as h, {c} - p_solar_lead{i} as gap from tree where split='test'" for kind, c in (("forecaster", "mean_prev_h_now"), ("persistence", "p_solar_now")) for i in range(1, H + 1)
)
_BY_KIND = f", k as (select kind, h, sqrt(avg(gap*gap)) as rmse, avg(abs(gap)) as mae, avg(gap*gap) as mse from ({_KINDS}) group by all)"

ORACLES = {
    "resample_hourly": f"select epoch(date_trunc('hour',ts))::bigint as t, count(*)::bigint as n, {r('avg(value)', 'av')}, {r('min(value)', 'mn')}, {r('max(value)', 'mx')} from events group by date_trunc('hour',ts)",
    "resample_unknown": f"""select epoch(date_trunc('hour',ts))::bigint as t, count(*)::bigint as n, {r('avg(x)', 'av')}, {r('min(x)*1e6', 'mn')}, {r('max(x)', 'mx')}
 from (select ts, case when event_id % 7 = 0 then null when event_id % 5 = 0 then value*1e-8 else value end as x from events) e group by date_trunc('hour',ts)""",
    "expand_default": EXPANDED_DEFAULT,
    "frame_default": sql("select rn::bigint as rn, " + ", ".join(r(c, c) for c in [*DEFAULT_INPUTS, *OUTPUTS]) + " from framed18", "framed18"),
    "telemetry_view": sql("select t, rn::bigint as rn, poa_irr + 0.0 as poa_irr, temperature, wind_speed, humidity, pressure, p_solar, ghi, wind_dir, p_wind from telemetry", "telemetry"),
    "pv_temp_module": sql(f"select t, {r('temp_module', 'temp_module')} from pv", "pv"),
    "pv_temp_cell": sql(f"select t, {r('temp_cell', 'temp_cell')} from pv", "pv"),
    "pv_pac_pdc_row_clamp": sql(f"select t, {r('pac', 'pac')}, {r('pdc', 'pdc')} from pv", "pv"),
    "pv_pac_pdc_column_clamp": sql(f"select t, {r('pac', 'pac')}, {r('pdc', 'pdc')} from pvc", "pvc"),
    "inverter_interp": sql(f"select t, {r(curve('w', _A.eff_p, _A.eff_percent, 0.0, _A.eff_percent[-1]), 'percent')} from (select t, poa_irr*5000.0 as w from telemetry)", "telemetry"),
    "wt_power_curve": sql(f"select t, {r(curve('wind_speed', tuple(map(float, WT.speed)), WT.power, 0.0, 0.0), 'power')} from telemetry", "telemetry"),
    "clean_curtailment": sql(f"select t, {r('case when pac >= p_solar*1.5 then pac else p_solar end', 'p_solar')} from pv", "pv"),
    "smooth_zeros": sql(f"select t, {r('p_solar', 'p_solar')}, {r('pac', 'pac')} from clean", "clean"),
    "hour_of_day": "select event_id, hour(ts)::int as hour_of_day from events",
    "rolling_mean_h": sql(f"select t, {r('mean_prev_h', 'mean_prev_h')} from expanded", "expanded"),
    "rolling_std_h": sql(f"select t, {r('std_prev_h', 'std_prev_h')} from expanded", "expanded"),
    "rolling_wind_mean": sql(f"select t, {r('mean_wind_prev_h', 'mean_wind_prev_h')} from expanded", "expanded"),
    "rolling_wind_std": sql(f"select t, {r('std_wind_prev_h', 'std_wind_prev_h')} from expanded", "expanded"),
    "rolling_per_user": f"select event_id, {r('case when count(value) over w = 5 then avg(value) over w end', 'rolled')} from events window w as (partition by user_id order by ts, event_id rows between 4 preceding and current row)",
    "expand_all": sql("select t, " + ", ".join([r(c, c) for c in ("p_solar", "pac", "pdc", "temp_module", "temp_cell", "mean_prev_h", "std_prev_h", "mean_wind_prev_h", "std_wind_prev_h")]) + ", hour_of_day from expanded", "expanded"),
    "column_prune": sql(f"select rn::bigint as rn, {r('p_solar', 'p_solar')}, {r('temp_module', 'temp_module')} from expanded", "expanded"),
    "frame_lags": sql("select rn::bigint as rn, " + ", ".join(r(c, c) for c in INPUTS) + " from wide", "wide"),
    "frame_leads": sql("select rn::bigint as rn, " + ", ".join(r(c, c) for c in OUTPUTS) + " from wide", "wide"),
    "frame_full_dropna": sql("select rn::bigint as rn, " + ", ".join(r(c, c) for c in INPUTS + OUTPUTS) + " from framed", "framed"),
    "frame_ann_legacy": legacy_query(),
    "tensor_x": tensor_query(),
    "tensor_y": sql("select rn, h::int as h, value from (" + " union all ".join(f"select rn, {i} as h, {r(f'p_solar_lead{i}', 'value')} from framed" for i in range(1, H + 1)) + ")", "framed"),
    "outer_align": sql(f"select rn, {r('pac', 'pac')}, {r('wind_speed', 'wind_speed')} from (select rn, pac from pv) a full join (select rn + 24 as rn, wind_speed from telemetry) b using (rn)", "pv"),
    "pad_union": sql(f"select rn, {r('p_solar', 'p_solar')} from telemetry union all select unnest(range(n, (ceil(n/{PRE + 1}.0)*{PRE + 1})::bigint)), null from (select count(*) as n from telemetry) c", "telemetry"),
    "split_tree": sql("select rn, sample_id, split from tree", "tree"),
    "split_ann": sql("select rn, sample_id, split from net", "net"),
    "scale_minmax01": scale_query("MinMax01"),
    "scale_minmax11": scale_query("MinMax11"),
    "scale_standard": scale_query("Standard"),
    "scale_pooled": sql(f", {fit([f'temp_module_lag{i}' if i else 'temp_module_now' for i in range(PRE + 1)], 'net', 's')} select sample_id, {r(scaled('MinMax01', 'temp_module_now', 's'), 'temp_module_now')}, {r(scaled('MinMax01', 'temp_module_lag5', 's'), 'temp_module_lag5')} from net, s", "net"),
    "scale_pooled_standard": sql(f", {fit([f'temp_module_lag{i}' if i else 'temp_module_now' for i in range(PRE + 1)], 'net', 's')} select sample_id, {r(scaled('Standard', 'temp_module_now', 's'), 'temp_module_now')}, {r(scaled('Standard', 'temp_module_lag5', 's'), 'temp_module_lag5')} from net, s", "net"),
    "scale_constant_col": sql("select sample_id, 0.0::double as minmax01, (-1.0)::double as minmax11, 0.0::double as standard from tree", "tree"),
    "inverse_scale": sql(
        f", {fit(['p_solar_now'], 'tree', 's1')}, {fit(['temp_module_lag5'], 'tree', 's2')} select sample_id, {r('p_solar_now', 'p_solar_now')}, {r('temp_module_lag5', 'temp_module_lag5')}, "
        f"{r(scaled('MinMax11', 'p_solar_now', 's1'), 'p_solar_now_scaled')}, {r(scaled('MinMax11', 'temp_module_lag5', 's2'), 'temp_module_lag5_scaled')} from tree, s1, s2",
        "tree",
    ),
    "persistence_exact": sql(f"select sample_id, h::int as h, {r('forecast', 'forecast')}, {r('observed', 'observed')} from pairs", "pairs"),
    "persistence_cross_scaled": cross_scaled_query(),
    "persistence_24h": sql(f"select rn::bigint as rn, h::int as h, {r('v', 'forecast')} from (" + " union all ".join(f"select rn, {i} as h, lag(p_solar,{24 - i}) over (order by rn) as v from clean" for i in range(1, H + 1)) + ")", "clean"),
    "metrics_mse_rmse_mae": sql(f"select h::int as h, {r('mse', 'mse')}, {r('rmse', 'rmse')}, {r('mae', 'mae')} from errors", "errors"),
    "metrics_summary": sql(f"select {r('avg(rmse)', 'rmse')}, {r('avg(mae)', 'mae')}, {r('avg(mse)', 'mse')} from errors", "errors"),
    "metric_limits": sql(f"select {r('least(min(rmse)*1.1, 0.0)', 'low')}, {r('greatest(max(rmse)*1.1, 0.0)', 'high')} from errors", "errors"),
    "residuals": sql(f"select sample_id, h::int as h, {r('observed - forecast', 'residual')} from pairs", "pairs"),
    "epoch_to_ts": "select event_id, epoch_us(ts)::bigint as us from events",
    "sort_by_ts": "select event_id, (row_number() over (order by ts, event_id) - 1)::bigint as rn from events",
    "thermal_relaxation": RELAXATION,
    "thermal_full": THERMAL,
    "demand_daily_framing": DEMAND,
    "cnn_given_weights": network_query("CNN"),
    "lstm_given_weights": network_query("LSTM"),
    "cnn_lstm_given_weights": network_query("CNN_LSTM"),
    "plot_data": sql(f"select t, panel, {r('value', 'value')} from ({_PANELS})", "telemetry"),
    "plot_data_daily": sql(f"select epoch(date_trunc('day', ts))::bigint as t, panel, {r('min(value)', 'low')}, {r('avg(value)', 'value')}, {r('max(value)', 'high')} from ({_PANELS}) group by date_trunc('day', ts), panel", "telemetry"),
    "plot_curves": " union all ".join([_points("turbine", WT.speed, WT.power), *(_points(f"inverter_{s.name}", s.eff_p, s.eff_percent) for s in PV.strings)]),
    "plot_rmse": sql(f"{_BY_KIND} select h::int as h, {r("max(rmse) filter (kind = 'forecaster')", 'forecaster')}, {r("max(rmse) filter (kind = 'persistence')", 'persistence')} from k group by h", "tree"),
    "plot_rmse_title": sql(f"{_BY_KIND} select {r('round(avg(rmse), 3)', 'rmse')}, {r('round(avg(mae), 3)', 'mae')}, {r('round(avg(mse), 3)', 'mse')} from k where kind = 'forecaster'", "tree"),
    "import_expanded": sql(f"select rn::bigint as rn, {r('p_solar', 'p_solar')}, {r('mean_prev_h', 'mean_prev_h')} from expanded", "expanded"),
    "results_round_trip": sql(f"select sample_id, h::int as h, {r('forecast', 'value')} from pairs", "pairs"),
    "stream_hourly": f"select epoch(date_trunc('hour',ts))::bigint as t, count(*)::bigint as n, {r('avg(value)', 'av')}, {r('min(value)', 'mn')}, {r('max(value)', 'mx')} from events group by date_trunc('hour',ts)",
}
#: Tables added after the shared ones follow a comma.
ORACLES = {k: v.replace(")\n, ", "),\n ") for k, v in ORACLES.items()}
