"""Oracle statements of the linear models: least squares by sweeping the cross-product matrix."""

from __future__ import annotations

from oracles.base import compose, relation

HOURS, DAYS, MONTHS = "hour_of_day", "day_of_week", "regression_month"
_DUMMIES = [*(f"{HOURS}_{k}" for k in range(1, 24)), *(f"{DAYS}_{k}" for k in range(1, 7)), f"{MONTHS}_5", f"{MONTHS}_6"]
TAXI = [f"taxi_trip_count_lag_{k}" for k in (1, 2, 24, 168)]
RIDERS = ["subway_ridership", *(f"subway_ridership_lag_{k}" for k in (1, 2, 24))]
SKY = ["temperature_2m", "precipitation", "rain_flag"]
AIR = ["temperature_2m", "relative_humidity_2m", "wind_speed_10m", "cloud_cover"]

relation("m_series", """
select *, lag(subway_ridership, 3) over (order by pickup_hour) as subway_ridership_lag_3 from m_lagged
""")
relation("m_model_hours", f"""
select *, row_number() over (order by pickup_hour) <= floor(count(*) over () * 0.8) as is_train
from m_series where {' and '.join(f'{c} is not null' for c in [*TAXI, *RIDERS, *SKY])}
""")


def _value(term: str) -> str:
    for stem in (HOURS, DAYS, MONTHS):
        if term.startswith(f"{stem}_"):
            return f"({stem} = {term[len(stem) + 1:]})::int::double"
    return "1::double" if term == "const" else f"{term}::double"


def model(tag: str, terms: list[str], rows: str) -> None:
    """Relations of one fit: long design, swept matrix, coefficients, residuals."""
    p = len(terms)
    pairs = ", ".join(f"struct_pack(i := {i}, v := {_value(t)})" for i, t in enumerate(terms, 1))
    relation(f"{tag}_long", f"""
select pickup_hour, u.i as i, u.v as v from (
  select pickup_hour, unnest([{pairs}, struct_pack(i := {p + 1}, v := taxi_trip_count::double)]) as u from ({rows}))
""")
    relation(f"{tag}_gram", f"""
select a.i as i, b.i as j, sum(a.v * b.v) as v from {tag}_long a join {tag}_long b using (pickup_hour) group by 1, 2
""")
    relation(f"{tag}_swept", f"""
with recursive s(k, i, j, v) as (
  select 0, i, j, v from {tag}_gram
  union all
  select k + 1, i, j, case when d < 1e-9 then v when i = k + 1 and j = k + 1 then -1 / d when i = k + 1 then across / d
                           when j = k + 1 then down / d else v - down * across / d end
  from (select k, i, j, v, max(case when i = k + 1 and j = k + 1 then v end) over () as d,
          max(case when i = k + 1 then v end) over (partition by j) as across,
          max(case when j = k + 1 then v end) over (partition by i) as down
        from s where k < {p}))
select i, j, v from s where k = {p}
""")
    names = ", ".join(f"'{t}'" for t in terms)
    relation(f"{tag}_fit", f"""
select n, ssr, sst, p, 1 - ssr / sst as r2, 1 - ssr / sst * (n - 1) / (n - p) as adjusted,
  n * (ln(2 * pi()) + 1 + ln(ssr / n)) + 2 * p as aic, n * (ln(2 * pi()) + 1 + ln(ssr / n)) + ln(n) * p as bic
from (select (select count(*) from {tag}_swept where i = j and i <= {p} and v < 0) as p,
        (select v from {tag}_swept where i = {p + 1} and j = {p + 1}) as ssr,
        (select count(*) from {tag}_long where i = {p + 1}) as n,
        (select var_pop(v) * count(*) from {tag}_long where i = {p + 1}) as sst)
""")
    relation(f"{tag}_beta", f"""
select b.i as i, [{names}][b.i] as feature, b.v as coefficient, sqrt(-d.v * ssr / (n - p)) as std_error
from {tag}_swept b join {tag}_swept d on d.i = b.i and d.j = b.i, {tag}_fit where b.j = {p + 1} and b.i <= {p}
""")


def residuals(tag: str, fitted: str, terms: list[str], rows: str) -> None:
    """Residuals of a fit over any rows with the same columns."""
    dot = " + ".join(
        f"(select coefficient from {fitted}_beta where feature = '{t}') * {_value(t)}" for t in terms
    )
    relation(tag, f"""
select pickup_hour, taxi_trip_count, subway_ridership, is_train, {dot} as prediction,
  taxi_trip_count - ({dot}) as residual from ({rows})
""")


def robust(tag: str, fitted: str, lags: int, p: int, res: str) -> None:
    """Newey-West standard errors from explicit lag joins."""
    relation(f"{tag}_scores", f"""
select l.i as i, dense_rank() over (order by pickup_hour) as t, l.v * r.residual as g
from {fitted}_long l join {res} r using (pickup_hour) where l.i <= {p}
""")
    relation(f"{tag}_meat", f"""
select a.i as i, b.i as j, sum(a.g * (b.g + coalesce(b.past, 0)) + coalesce(a.past, 0) * b.g) as v
from {tag}_both a join {tag}_both b using (t) group by 1, 2
""")
    relation(f"{tag}_both", f"""
select s.i as i, s.t as t, any_value(s.g) as g, sum((1 - (s.t - o.t) / {lags + 1}.0) * o.g) as past
from {tag}_scores s left join {tag}_scores o on o.i = s.i and o.t between s.t - {lags} and s.t - 1 group by 1, 2
""")
    relation(f"{tag}_hac", f"""
select b.i as i, feature, coefficient, sqrt(sum(l.v * m.v * r.v)) as std_error
from {fitted}_beta b join {fitted}_swept l on l.i = b.i and l.j <= {p}
join {tag}_meat m on m.i = l.j join {fitted}_swept r on r.i = m.j and r.j = b.i
group by 1, 2, 3
""")


_TERMS = 300


def _beta_direct(a: str, b: str, x: str, rest: str) -> str:
    """Front factor over the continued fraction, worked out from its last term; rest is 1 - x."""
    fraction = f"""list_reduce(range({_TERMS}, 0, -1)::double[], lambda acc, k: 1 + case when k % 2 = 1
      then -({a} + (k - 1) / 2) * ({a} + {b} + (k - 1) / 2) * ({x}) / (({a} + k - 1) * ({a} + k))
      else (k / 2) * ({b} - k / 2) * ({x}) / (({a} + k - 1) * ({a} + k)) end / acc, 1::double)"""
    return f"exp(lgamma({a} + {b}) - lgamma({a}) - lgamma({b}) + {a} * ln({x}) + {b} * ln({rest})) / ({a} * {fraction})"


def _beta(a: str, b: str, x: str, rest: str) -> str:
    return f"""case when {x} <= 0 then 0 when {rest} <= 0 then 1 when {x} > ({a} + 1) / ({a} + {b} + 2)
      then 1 - {_beta_direct(b, a, rest, x)} else {_beta_direct(a, b, x, rest)} end"""


def t_tail(t: str, df: str) -> str:
    return _beta(f"({df} / 2)", "0.5::double", f"({df} / ({df} + {t} * {t}))", f"({t} * {t} / ({df} + {t} * {t}))")


def f_tail(f: str, df1: str, df2: str) -> str:
    return _beta(f"({df2} / 2)", f"({df1} / 2)", f"({df2} / ({df2} + {df1} * {f}))", f"({df1} * {f} / ({df2} + {df1} * {f}))")


def chi_tail(x: str, df: str) -> str:
    s, half = f"({df} / 2)", f"({x} / 2)"
    front = f"exp({s} * ln({half}) - {half} - lgamma({s}))"
    # the series in Horner's form, and the fraction from its last term
    series = f"list_reduce(range({_TERMS}, 0, -1)::double[], lambda acc, k: 1 + acc * {half} / ({s} + k), 1::double) / {s}"
    fraction = f"""list_reduce(range({_TERMS}, 0, -1)::double[], lambda acc, k: {half} + 2 * k - 1 - {s} - k * (k - {s}) / acc,
      ({half} + {2 * _TERMS + 1} - {s})::double)"""
    return f"""case when {half} <= 0 then 1 when {half} < {s} + 1 then 1 - {front} * {series}
      else {front} / ({fraction}) end"""


def normal_tail(z: str) -> str:
    return chi_tail(f"({z} * {z})", "1::double")


NORMAL_QUANTILE = "1.959963984540054"
INFERENCE = "p_value ci_lower ci_upper"


def inferred(rows: str, tail: str, quantile: str) -> str:
    """rows (with coefficient, std_error and statistic) with p-values and 95 percent intervals."""
    return f"""select * exclude (df), p_value < 0.05 as significant_05 from (
      select *, {tail} as p_value, coefficient - {quantile} * std_error as ci_lower,
             coefficient + {quantile} * std_error as ci_upper from ({rows}))"""


MODELS = {
    "model_1_temporal_baseline": ("q1", TAXI),
    "model_2_transit": ("q2", [*TAXI, *RIDERS]),
    "model_3_weather": ("q3", [*TAXI, *RIDERS, *SKY]),
    "model_4_reduced": ("q4", [TAXI[0], TAXI[2], TAXI[3], RIDERS[0], *SKY]),
}
_TRAIN = "select * from m_model_hours where is_train"
for _tag, _numeric in MODELS.values():
    _terms = ["const", *_numeric, *_DUMMIES]
    model(_tag, _terms, _TRAIN)
    residuals(f"{_tag}_res", _tag, _terms, "select * from m_model_hours")

_CALENDAR_TERMS = ["const", *TAXI, *_DUMMIES]
model("qc", _CALENDAR_TERMS, "select * from m_model_hours")
residuals("qc_res", "qc", _CALENDAR_TERMS, "select * from m_model_hours")

# Association models: tag, numeric terms, calendar controls, Newey-West lags.
ASSOCIATIONS = {
    "raw_subway": ("a1", ["subway_ridership"], False, 24),
    "subway_time": ("a2", ["subway_ridership"], True, 24),
    "subway_weather_time": (
        "a3", ["subway_ridership", "temperature_2m", "relative_humidity_2m", "precipitation", "wind_speed_10m", "cloud_cover"], True, 24,
    ),
    "rain_subway_time": ("a4", ["rain_flag", "subway_ridership", *AIR], True, 24),
    "subway_lags": ("a5", ["subway_ridership", *(f"subway_ridership_lag_{k}" for k in (1, 2, 3))], True, 24),
    "baseline": ("a6", ["subway_ridership", "rain_flag", *AIR], True, 24),
    "short_lags": ("a7", ["subway_ridership", "rain_flag", *AIR, *TAXI[:2]], True, 24),
    "full_lags": ("a8", ["subway_ridership", "rain_flag", *AIR, *TAXI], True, 168),
    "lagged_demand": ("a9", ["rain_flag", "subway_ridership", *AIR, *TAXI], True, 168),
}
for _tag, _numeric, _controls, _lags in ASSOCIATIONS.values():
    _terms = ["const", *_numeric, *(_DUMMIES if _controls else [])]
    _rows = f"select *, true as is_train from m_series where {' and '.join(f'{c} is not null' for c in _numeric)}"
    model(_tag, _terms, _rows)
    residuals(f"{_tag}_res", _tag, _terms, _rows)
    robust(_tag, _tag, _lags, len(_terms), f"{_tag}_res")
_A2_TERMS = len(_DUMMIES) + 2
for _lags in (6, 12, 48, 168):
    robust(f"a2w{_lags}", "a2", _lags, _A2_TERMS, "a2_res")

_TEST_ERRORS = """select pickup_hour, taxi_trip_count::double as taxi_trip_count, prediction, residual,
    abs(residual) as abs_error, residual * residual as squared_error, hour(pickup_hour)::int as hour_of_day,
    dayofweek(pickup_hour) in (0, 6) as is_weekend from q4_res where not is_train"""


def _metrics(name: str, tag: str) -> str:
    sample = """select avg(abs(residual)) as mae, sqrt(avg(residual * residual)) as rmse,
        1 - sum(residual * residual) / (var_pop(taxi_trip_count) * count(*)) as r2"""
    return f"""select '{name}' as model, a.r2 as train_r2, b.r2 as test_r2, a.mae as train_mae, b.mae as test_mae,
        a.rmse as train_rmse, b.rmse as test_rmse, adjusted as adjusted_r2, aic, bic
      from ({sample} from {tag}_res where is_train) a, ({sample} from {tag}_res where not is_train) b, {tag}_fit"""


def _robust_rows(names: list[str], columns: str = "*") -> str:
    found = " union all ".join(
        f"""select '{n}' as model, feature, coefficient, std_error, coefficient / std_error as statistic, null as df
            from {ASSOCIATIONS[n][0]}_hac"""
        for n in names
    )
    doubles = f"coefficient std_error statistic {INFERENCE}" if columns == "*" else INFERENCE
    return compose(f"select {columns} from ({inferred(found, normal_tail('statistic'), NORMAL_QUANTILE)})", doubles)


_INFERRED = f"model, feature, {INFERENCE.replace(' ', ', ')}, significant_05"
# The upper 2.5 percent point of t by its expansion around the normal one, exact to 1e-12 beyond a thousand degrees.
_Z = NORMAL_QUANTILE
_T_QUANTILE = f"""({_Z} + (pow({_Z}, 3) + {_Z}) / (4 * df) + (5 * pow({_Z}, 5) + 16 * pow({_Z}, 3) + 3 * {_Z}) / (96 * df * df)
  + (3 * pow({_Z}, 7) + 19 * pow({_Z}, 5) + 17 * pow({_Z}, 3) - 15 * {_Z}) / (384 * pow(df, 3)))"""


def _coefficient_rows(columns: str = "*") -> str:
    found = " union all ".join(
        f"""select '{n}' as model, feature, coefficient, std_error, coefficient / std_error as statistic,
              (select n - p from {tag}_fit)::double as df from {tag}_beta""" for n, (tag, _) in MODELS.items()
    )
    doubles = f"coefficient std_error statistic {INFERENCE}" if columns == "*" else INFERENCE
    return compose(f"select {columns} from ({inferred(found, t_tail('statistic', 'df'), _T_QUANTILE)})", doubles)


def _fit_rows(names: list[str]) -> str:
    return compose(
        " union all ".join(
            f"""select '{n}' as model, n as observations, r2 as r_squared, adjusted as adjusted_r_squared, aic, bic
                from {ASSOCIATIONS[n][0]}_fit"""
            for n in names
        ),
        "r_squared adjusted_r_squared aic bic",
    )


_Q4 = ["const", *MODELS["model_4_reduced"][1], *_DUMMIES]

# Uncentred inflation: sweep the reduced model's terms without the constant, over all complete hours.
model("qv", _Q4[1:], "select * from m_model_hours")
model("qa", ["const", *ASSOCIATIONS["subway_weather_time"][1]], "select * from m_series where subway_ridership is not null")

_ASSOCIATED = ["raw_subway", "subway_time", "subway_weather_time", "rain_subway_time"]
_LJUNG_BOX = f"""with o as (select residual - avg(residual) over () as r, row_number() over (order by pickup_hour) as t,
                        count(*) over () as n from a9_res),
             acf as (select a.t - b.t as k, any_value(a.n) as n, sum(a.r * b.r) / (select sum(r * r) from o) as r
                     from o a join o b on b.t between a.t - 168 and a.t - 1 group by 1),
             stats as (select m::int as lag, any_value(n) * (any_value(n) + 2) * sum(r * r / (n - k)) as lb_stat
                       from (values (1), (6), (12), (24), (48), (168)) as l(m) join acf on k <= m group by 1)
           select lag, lb_stat, {chi_tail('lb_stat', 'lag::double')} as lb_pvalue from stats"""

STATS_SQL = {
    "chronological_split": compose("select pickup_hour, is_train from m_model_hours"),
    "design_matrix": compose(
        "select pickup_hour, taxi_trip_count::double as y, "
        + ", ".join(f"{_value(t)} as {t}" for t in _Q4)
        + " from m_model_hours"
    ),
    "gram_matrix": compose(
        f"""select [{', '.join(f"'{t}'" for t in [*_Q4, 'y'])}][i] as term_i,
              [{', '.join(f"'{t}'" for t in [*_Q4, 'y'])}][j] as term_j, v as total from q4_gram where i <= j""",
        "total",
    ),
    "model_coefficients": _coefficient_rows(),
    "model_inference": _coefficient_rows(_INFERRED),
    "model_fit_summary": compose(
        " union all ".join(
            f"""select '{n}' as model, n as observations, p::int as rank, r2 as r_squared,
                  adjusted as adjusted_r_squared, (sst - ssr) / (p - 1) / (ssr / (n - p)) as f_statistic, aic, bic,
                  {f_tail('((sst - ssr) / (p - 1) / (ssr / (n - p)))', '(p - 1)', '(n - p)')} as f_p_value
                from {tag}_fit""" for n, (tag, _) in MODELS.items()
        ),
        "r_squared adjusted_r_squared f_statistic aic bic f_p_value",
    ),
    "model_comparison": compose(
        " union all ".join(_metrics(n, tag) for n, (tag, _) in MODELS.items()),
        "train_r2 test_r2 train_mae test_mae train_rmse test_rmse adjusted_r2 aic bic",
    ),
    "model_test_predictions": compose(
        "select pickup_hour, taxi_trip_count::double as taxi_trip_count, prediction, residual from q4_res where not is_train",
        "prediction residual",
    ),
    "test_error_by_hour": compose(
        f"""select hour_of_day, count(*) as observations, avg(abs_error) as mae, sqrt(avg(squared_error)) as rmse
            from ({_TEST_ERRORS}) group by 1""",
        "mae rmse",
    ),
    "test_error_by_weekend": compose(
        f"""select is_weekend, count(*) as observations, avg(abs_error) as mae, sqrt(avg(squared_error)) as rmse
            from ({_TEST_ERRORS}) group by 1""",
        "mae rmse",
    ),
    "worst_predictions": compose(
        f"""select pickup_hour, taxi_trip_count, prediction, abs_error, hour_of_day, is_weekend
            from ({_TEST_ERRORS}) order by abs_error desc limit 20""",
        "prediction abs_error",
    ),
    "residual_diagnostics": compose(
        """select avg(residual) as mean_residual, median(residual) as median_residual,
             stddev_samp(residual) as std_residual, min(residual) as min_residual, max(residual) as max_residual,
             quantile_cont(abs(residual), 0.95) as residual_p95_abs,
             quantile_cont(abs(residual), 0.99) as residual_p99_abs from q4_res where is_train""",
        "mean_residual median_residual std_residual min_residual max_residual residual_p95_abs residual_p99_abs",
    ),
    "vif_reduced_model": compose(
        f"""select [{', '.join(f"'{t}'" for t in _Q4[1:])}][s.i] as feature, -s.v * g.v as vif
            from qv_swept s join qv_gram g on g.i = s.i and g.j = s.i where s.i = s.j and s.i < {len(_Q4)}""",
        "vif",
    ),
    "vif_ambient": compose(
        """select ['subway_ridership', 'temperature_2m', 'relative_humidity_2m', 'precipitation', 'wind_speed_10m',
                   'cloud_cover'][s.i - 1] as variable, -s.v * c.ss as vif
           from qa_swept s join (select i, var_pop(v) * count(*) as ss from qa_long group by 1) c on c.i = s.i
           where s.i = s.j and s.i between 2 and 7""",
        "vif",
    ),
    "subway_residual_correlation": compose(
        "select count(*) as hours, corr(residual, subway_ridership) as residual_correlation from qc_res",
        "residual_correlation",
    ),
    "association_coefficients": _robust_rows(_ASSOCIATED),
    "association_inference": _robust_rows(_ASSOCIATED, _INFERRED),
    "training_residuals": compose("select pickup_hour, residual from q4_res where is_train", "residual"),
    "subway_residuals": compose(
        "select pickup_hour, taxi_trip_count::double as taxi_trip_count, prediction, residual, subway_ridership from qc_res",
        "prediction residual",
    ),
    "association_comparison": _fit_rows(["raw_subway", "subway_time", "subway_weather_time", "rain_subway_time"]),
    "subway_lag_coefficients": _robust_rows(["subway_lags"]),
    "demand_lag_comparison": _fit_rows(["baseline", "short_lags", "full_lags"]),
    "demand_lag_coefficients": _robust_rows(["baseline", "short_lags", "full_lags"]),
    "hac_sensitivity": compose(
        "select * exclude (significant_05) from (" + inferred(
            " union all ".join(
                f"""select {k} as hac_lags, coefficient, std_error, coefficient / std_error as statistic, null as df
                    from {'a2' if k == 24 else f'a2w{k}'}_hac where feature = 'subway_ridership'"""
                for k in (6, 12, 24, 48, 168)
            ),
            normal_tail("statistic"), NORMAL_QUANTILE,
        ) + ")",
        f"coefficient std_error statistic {INFERENCE}",
    ),
    "diagnostic_coefficients": _robust_rows(["lagged_demand"]),
    "diagnostic_summary": compose(
        """select count(*) as observations, (select count(*) from m_series) - count(*) as lost_to_lags,
             (select r2 from a9_fit) as r_squared, (select adjusted from a9_fit) as adjusted_r_squared,
             avg(residual) as mean, stddev_samp(residual) as std, min(residual) as min,
             quantile_cont(residual, 0.25) as p25, quantile_cont(residual, 0.5) as p50,
             quantile_cont(residual, 0.75) as p75, max(residual) as max from a9_res""",
        "r_squared adjusted_r_squared mean std min p25 p50 p75 max",
    ),
    "residual_autocorrelation": compose(
        """with o as (select residual as r, row_number() over (order by pickup_hour) as t from a9_res)
           select k::int as lag, corr(a.r, b.r) as autocorrelation
           from (values (1), (2), (3), (6), (12), (24), (48), (168)) as l(k), o a join o b on b.t = a.t - l.k
           group by 1""",
        "autocorrelation",
    ),
    "residual_ljung_box": compose(_LJUNG_BOX, "lb_stat lb_pvalue"),
    "residual_ljung_box_test": compose(_LJUNG_BOX, "lb_stat lb_pvalue"),
    "lag_products": compose(
        """with o as (select taxi_trip_count - avg(taxi_trip_count) over () as d,
                        row_number() over (order by pickup_hour) as t from m_series)
           select (a.t - b.t)::int as lag, sum(a.d * b.d) as product_sum, count(*) as pairs
           from o a join o b on b.t between a.t - 24 and a.t group by 1""",
        "product_sum",
    ),
}
