"""DuckDB SQL oracles for the catalog queries.

Written directly in SQL over the fixture views (row-level ``LAG`` windows,
plain ``GROUP BY`` with ``count(DISTINCT ..)``, correlated lookups), not
derived from the Spark plans: agreement means the Spark formulation computes
the defined quantity. Fractional outputs are rounded to 6 places and integral
ones cast to BIGINT, as in ``common.finalize``.
"""

from __future__ import annotations

from itertools import combinations

from ..functions.timeparts import BANDS
from ..operators.base_features import (BASE_RATIO_COLUMNS, CENTRED_COLS, COUNT_COLS, COUNT_RATIO_COLS,
                                       IP_RATIO_DENOMS, SHARE_COLS)
from ..operators.cross import CROSS_COLS, CROSS_COLS1
from ..sources.fixtures import BASE_COLUMNS, FIRST_DAY_TYPE1, fixture_cte_sql
from . import common

# Category values of the fixture columns used by the pivots.
PIVOT_VALUES = {
    "platform": ["p0", "p1", "p2", "p3"],
    "type1": ["click", "purchase", "signup", "view"],
    "type2": ["y0", "y1", "y2", "y3", "y4"],
}

U = '"user"'


def r6(expr: str) -> str:
    return f"(ROUND(CAST({expr} AS DOUBLE), 6) + 0.0)"


def i64(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def _parts(view: str) -> str:
    clock = "split_part(tm_diff, ' ', 3)"
    return (f"SELECT *, days_diff % 7 AS week, days_diff % 15 AS half_month, hour // 6 AS band, "
            f"CAST(days_diff AS BIGINT) * 86400 + hour * 3600 + minute * 60 + second AS timestamp "
            f"FROM (SELECT *, CAST(split_part(tm_diff, ' ', 1) AS INTEGER) AS days_diff, "
            f"CAST(split_part({clock}, ':', 1) AS INTEGER) AS hour, "
            f"CAST(split_part({clock}, ':', 2) AS INTEGER) AS minute, "
            f"CAST(split_part(split_part({clock}, ':', 3), '.', 1) AS INTEGER) AS second FROM {view})")


def with_views(body: str, extra: list[tuple[str, str]] = ()) -> str:
    ctes = fixture_cte_sql().rstrip() + ",\n"
    ctes += f"op_t AS ({_parts('op')}),\ntrans_t AS ({_parts('trans')}),\n"
    ctes += ("op_n AS (SELECT * REPLACE (coalesce(op_type, 'nan') AS op_type, coalesce(op_mode, 'nan') AS op_mode, "
             "coalesce(op_device, 'nan') AS op_device) FROM op_t)")
    for name, sql in extra:
        ctes += f",\n{name} AS ({sql})"
    return ctes + "\n" + body


def _skew(x: str) -> str:
    return f"CASE WHEN count({x}) < 3 THEN NULL WHEN var_pop({x}) = 0 THEN 0 ELSE skewness({x}) END"


def _stat(s: str, x: str) -> str:
    return {
        "mean": r6(f"avg({x})"), "std": r6(f"stddev_samp({x})"), "max": r6(f"max({x})"),
        "min": r6(f"min({x})"), "sum": r6(f"sum(coalesce({x}, 0))"), "med": r6(f"median({x})"),
        "cnt": i64(f"count({x})"), "skew": r6(_skew(x)), "nunique": i64(f"count(DISTINCT {x})"),
    }[s]


STATS9 = ("mean", "std", "max", "min", "sum", "med", "cnt", "skew", "nunique")


def _amount9(suffix: str | None) -> str:
    cols = []
    for s in STATS9:
        if suffix is None:
            name = "user_ampunt_nunique" if s == "nunique" else f"user_amount_{s}"
        else:
            name = f"user_amount_{'nun' if s == 'nunique' else s}_{suffix}"
        cols.append(f"{_stat(s, 'amount')} AS {name}")
    return ", ".join(cols)


def _stats_cols(x: str, stats, template: str) -> str:
    return ", ".join(f"{_stat(s, x)} AS {template.format(s)}" for s in stats)


def _join_on_user(first: str, subqueries: list[str]) -> str:
    """``first`` gives the user list; each subquery is keyed by user."""
    sql = f"SELECT * FROM ({first}) AS q0"
    for i, s in enumerate(subqueries, start=1):
        sql += f" LEFT JOIN ({s}) AS q{i} USING ({U})"
    return sql


ORACLES: dict[str, str] = {}

# ---------------------------------------------------------------- T0
ORACLES["user_amount_stats"] = with_views(f"SELECT {U}, {_amount9(None)} FROM trans_t GROUP BY {U}")

ORACLES["time_parts"] = with_views(
    f"SELECT {U}, row_id, {i64('days_diff')} AS days_diff, {i64('hour')} AS hour, {i64('minute')} AS minute, "
    f"{i64('second')} AS second, {i64('timestamp')} AS timestamp, {i64('week')} AS week, "
    f"{i64('half_month')} AS half_month, {i64('band')} AS band FROM op_t")


def _base_select() -> str:
    out = []
    for name, _ in BASE_COLUMNS:
        kind = _BASE_KINDS.get(name, "i")
        q = f'"{name}"'
        out.append(q if kind == "s" else (r6(q) if kind == "d" else i64(q)) + f" AS {q}")
    return ", ".join(out)


_BASE_KINDS = {n: "s" for n in ("province", "city", "regist_type", "balance", "balance_avg", "service3_level")}
_BASE_KINDS.update({n: "d" for n in ("age", "using_time", "login_cnt_avg", "service1_amt")
                    + tuple(f"product{j}_amount" for j in range(1, 7))})
ORACLES["base_label_union"] = with_views(f"SELECT {_base_select()} FROM base")

# ---------------------------------------------------------------- T1a
for _w in common.DAY_WINDOWS:
    ORACLES[f"amount_window_{_w}"] = with_views(
        f"SELECT {U}, {_amount9(f'{_w}d')} FROM trans_t WHERE days_diff > {_w} GROUP BY {U}")

ORACLES["amount_hours_6_15"] = with_views(
    f"SELECT {U}, {_amount9('6d')} FROM trans_t WHERE hour BETWEEN 6 AND 15 GROUP BY {U}")

for _c, _vals in PIVOT_VALUES.items():
    _cols = []
    for _v in _vals:
        _cols.append(f"{i64(f'count(CASE WHEN {_c} = {_v!r} THEN amount END)')} AS user_{_c}_{_v}_amount_count")
        _cols.append(f"{r6(f'coalesce(sum(CASE WHEN {_c} = {_v!r} THEN amount END), 0)')} "
                     f"AS user_{_c}_{_v}_amount_sum")
    ORACLES[f"amount_pivot_{_c}"] = with_views(
        f"SELECT {U}, {', '.join(_cols)} FROM trans_t WHERE {_c} IS NOT NULL GROUP BY {U}")

ORACLES["user_nunique_trans"] = with_views(
    f"SELECT {U}, " + ", ".join(f"{i64(f'count(DISTINCT {c})')} AS user_trans_{c}_nuniq"
                                 for c in common.TRANS_NUNIQUE_COLS) + f" FROM trans_t GROUP BY {U}")
ORACLES["user_nunique_op"] = with_views(
    f"SELECT {U}, " + ", ".join(f"{i64(f'count(DISTINCT {c})')} AS user_op_{c}_nuniq"
                                 for c in common.OP_NUNIQUE_COLS) + f" FROM op_t GROUP BY {U}")
ORACLES["user_nonnull_count"] = with_views(
    f"SELECT {U}, " + ", ".join(f"{i64(f'count({c})')} AS user_trans_{c}_count"
                                 for c in ["ip", "type2", "tunnel_out", "amount"]) + f" FROM trans_t GROUP BY {U}")
ORACLES["user_row_count"] = with_views(
    f"SELECT {U}, {i64('o.n')} AS user_op_sum, {i64('t.n')} AS user_trans_sum, "
    f"{i64('o.n - t.n')} AS operation_transaction_count_gap FROM base "
    f"LEFT JOIN (SELECT {U}, count(*) AS n FROM op_t GROUP BY {U}) o USING ({U}) "
    f"LEFT JOIN (SELECT {U}, count(*) AS n FROM trans_t GROUP BY {U}) t USING ({U})")


def _null_cols(cols, prefix):
    out = []
    for c in cols:
        flag = f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END"
        out.append(f"{i64(f'sum({flag})')} AS user_{prefix}_{c}_null_cnt")
        out.append(f"{r6(f'avg({flag})')} AS user_{prefix}_{c}_null_ratio")
    return ", ".join(out)


ORACLES["null_profile"] = with_views(_join_on_user(
    f"SELECT {U} FROM base",
    [f"SELECT {U}, {_null_cols(['ip', 'type2'], 'trans')} FROM trans_t GROUP BY {U}",
     f"SELECT {U}, {_null_cols(['net_type'], 'op')} FROM op_t GROUP BY {U}"]))


def _time_profile(view, tag):
    cols = []
    for p in common.TIME_PARTS:
        cols += [f"{r6(f'avg({p})')} AS {p}_{tag}mean", f"{r6(f'stddev_samp({p})')} AS {p}_{tag}std",
                 f"{i64(f'max({p})')} AS {p}_{tag}max", f"{i64(f'min({p})')} AS {p}_{tag}min",
                 f"{i64(f'count(DISTINCT {p})')} AS {p}_{tag}nu", f"{i64(f'max({p}) - min({p})')} AS {p}_{tag}range"]
    return with_views(f"SELECT {U}, {', '.join(cols)} FROM {view} GROUP BY {U}")


ORACLES["time_profile_trans"] = _time_profile("trans_t", "tr")
ORACLES["time_profile_op"] = _time_profile("op_t", "op")
ORACLES["first_day_of_type"] = with_views(
    f"SELECT {U}, {i64('min(days_diff)')} AS user_type1_{FIRST_DAY_TYPE1}_min_day FROM trans_t "
    f"WHERE type1 = '{FIRST_DAY_TYPE1}' GROUP BY {U}")

# ---------------------------------------------------------------- T1b
STATS4 = ("mean", "max", "min", "std")
STATS5 = ("sum", "mean", "max", "min", "std")


def _series_stats(src: str, x: str, stats, template: str) -> str:
    return f"SELECT {U}, {_stats_cols(x, stats, template)} FROM ({src}) GROUP BY {U}"


def _band_filter(b: int) -> str:
    _, lo, hi = BANDS[b]
    return f"hour BETWEEN {lo} AND {hi}"


_OP_HOURLY = f"SELECT {U}, days_diff, hour, count(*) AS n FROM op_t GROUP BY {U}, days_diff, hour"
_OP_DAILY = f"SELECT {U}, days_diff, count(*) AS n FROM op_t GROUP BY {U}, days_diff"
_OP_WEEKLY = f"SELECT {U}, week, count(*) AS n FROM op_t GROUP BY {U}, week"

_subs = [_series_stats(_OP_HOURLY, "n", STATS4, "frequence_one_hour_{}_op"),
         _series_stats(_OP_DAILY, "n", STATS4, "frequence_one_day_{}_op"),
         _series_stats(_OP_WEEKLY, "n", STATS4, "frequence_one_week_{}_op")]
for _b, (_nm, _, _) in BANDS.items():
    _subs.append(_series_stats(
        f"SELECT {U}, days_diff, count(*) AS n FROM op_t WHERE {_band_filter(_b)} GROUP BY {U}, days_diff",
        "n", STATS4, f"frequence_{_nm}_{{}}_op"))
ORACLES["op_frequency"] = with_views(_join_on_user(f"SELECT DISTINCT {U} FROM op_t", _subs))


def _lag_src(src: str, x: str, order: str, part: str = U) -> str:
    return f"SELECT {U}, {x} - lag({x}) OVER (PARTITION BY {part} ORDER BY {order}) AS g FROM ({src})"


ORACLES["op_frequency_gap"] = with_views(_join_on_user(f"SELECT DISTINCT {U} FROM op_t", [
    _series_stats(_lag_src(_OP_DAILY, "n", "days_diff"), "g", STATS5, "frequence_one_day_gap_{}_op"),
    _series_stats(_lag_src(_OP_HOURLY, "n", "days_diff, hour"), "g", STATS5, "frequence_one_hour_gap_{}_op"),
    _series_stats(_lag_src(_OP_WEEKLY, "n", "week"), "g", STATS5, "frequence_one_week_gap_{}_op"),
]))

_AMT = "sum(coalesce(amount, 0))"
_TR_HOURLY = f"SELECT {U}, days_diff, hour, {_AMT} AS a FROM trans_t GROUP BY {U}, days_diff, hour"
_TR_DAILY = f"SELECT {U}, days_diff, {_AMT} AS a FROM trans_t GROUP BY {U}, days_diff"


def _tr_band(b):
    return f"SELECT {U}, days_diff, {_AMT} AS a FROM trans_t WHERE {_band_filter(b)} GROUP BY {U}, days_diff"


ORACLES["amount_frequency"] = with_views(_join_on_user(f"SELECT DISTINCT {U} FROM trans_t", [
    _series_stats(_TR_HOURLY, "a", STATS5, "money_frequence_one_hour_{}"),
    _series_stats(_TR_DAILY, "a", STATS4, "money_frequence_day_{}"),
]))
ORACLES["amount_band"] = with_views(_join_on_user(f"SELECT DISTINCT {U} FROM trans_t", [
    _series_stats(_tr_band(b), "a", STATS5, f"money_frequence_{nm}_{{}}") for b, (nm, _, _) in BANDS.items()]))
ORACLES["amount_gap"] = with_views(_join_on_user(f"SELECT DISTINCT {U} FROM trans_t", [
    _series_stats(_lag_src(_TR_HOURLY, "a", "days_diff, hour"), "g", STATS5, "money_frequence_one_hour_gap_{}"),
    _series_stats(_lag_src(_TR_DAILY, "a", "days_diff"), "g", STATS5, "money_frequence_day_gap_{}"),
]))
ORACLES["amount_band_gap"] = with_views(_join_on_user(f"SELECT DISTINCT {U} FROM trans_t", [
    _series_stats(_lag_src(_tr_band(b), "a", "days_diff"), "g", STATS5, f"money_frequence_{nm}_gap_{{}}")
    for b, (nm, _, _) in BANDS.items()]))

# ---------------------------------------------------------------- T1c
_GAP_STEMS = {1: "every_days_diff_time2_gap", 3: "every_three_days_diff_time2_gap",
              7: "every_sixteen_days_diff_time2_gap"}


def _interevent(view):
    subs = []
    for n, stem in _GAP_STEMS.items():
        src = (f"SELECT {U}, days_diff - lag(days_diff, {n}) OVER (PARTITION BY {U} ORDER BY days_diff, row_id) "
               f"AS g FROM {view}")
        subs.append(_series_stats(src, "g", STATS5, stem + "_{}"))
    return with_views(_join_on_user(f"SELECT DISTINCT {U} FROM {view}", subs))


ORACLES["interevent_gap_trans"] = _interevent("trans_t")
ORACLES["interevent_gap_op"] = _interevent("op_t")


def _nz(x):
    return f"nullif(CAST({x} AS DOUBLE), 0)"


_prod = [f"product{j}_amount" for j in range(1, 7)]
_cards = ["card_a_cnt", "card_b_cnt", "card_c_cnt", "card_d_cnt"]
_ratio_exprs = {
    "product7_fail_ratio": f"product7_fail_cnt / {_nz('product7_cnt')}",
    "product_amount_sum": " + ".join(f"coalesce({c}, 0)" for c in _prod),
    "product_amount_max": f"greatest({', '.join(_prod)})",
    "card_sum_cnt": "(" + " + ".join(f"coalesce({c}, 0)" for c in _cards) + ")",
    "card_max_cnt": f"greatest({', '.join(_cards)})",
    "op_sum_cnt": "(coalesce(op1_cnt, 0) + coalesce(op2_cnt, 0))",
    "login_cnt_period12": "(login_cnt_period1 + login_cnt_period2)",
    "login_cnt": "login_days_cnt * login_cnt_avg",
    "service_sum_cnt": "(service1_cnt + service2_cnt)",
}
_ratio_exprs.update({
    "card_div_cnt": f"card_a_cnt / {_nz(_ratio_exprs['card_sum_cnt'])}",
    "op_div_cnt": f"op1_cnt / {_nz('op2_cnt')}",
    "acc_card_ratio": f"acc_count / {_nz(_ratio_exprs['card_sum_cnt'])}",
    "time_age": f"using_time / {_nz('age')}",
    "card_time": f"{_ratio_exprs['card_sum_cnt']} / {_nz('using_time')}",
    "op_time": f"{_ratio_exprs['op_sum_cnt']} / {_nz('using_time')}",
    "service_cnt_time": f"{_ratio_exprs['service_sum_cnt']} / {_nz('using_time')}",
    "service1_amtt_time": f"service1_amt / {_nz('using_time')}",
    "agreement_time": f"agreement_total / {_nz('using_time')}",
    "acc_time": f"acc_count / {_nz('using_time')}",
    "fail_time": f"product7_fail_cnt / {_nz('using_time')}",
    "cnt_time": f"product7_cnt / {_nz('using_time')}",
})
for _d in IP_RATIO_DENOMS:
    _den = _ratio_exprs["login_cnt_period12"] if _d == "login_cnt_period12" else _d
    _ratio_exprs[f"ip_cnt_{_d}"] = f"ip_cnt / {_nz(_den)}"
_INT_RATIO = {"card_sum_cnt", "card_max_cnt", "op_sum_cnt", "login_cnt_period12", "service_sum_cnt"}
ORACLES["base_ratios"] = with_views(
    f"SELECT {U}, " + ", ".join(
        f"{i64(_ratio_exprs[c]) if c in _INT_RATIO else r6(_ratio_exprs[c])} AS {c}" for c in BASE_RATIO_COLUMNS)
    + " FROM base")

_centred = []
for _c in CENTRED_COLS:
    _centred += [f"{r6(f'(SELECT max({_c}) FROM base) - {_c}')} AS {_c}_max",
                 f"{r6(f'{_c} - (SELECT min({_c}) FROM base)')} AS {_c}_min",
                 f"{r6(f'{_c} - (SELECT median({_c}) FROM base)')} AS {_c}_median",
                 f"{r6(f'{_c} - (SELECT avg({_c}) FROM base)')} AS {_c}_mean"]
ORACLES["base_centred"] = with_views(f"SELECT {U}, {', '.join(_centred)} FROM base")


def _value_frequency_sql() -> str:
    cols = []
    for c in SHARE_COLS:
        cnt = f"(SELECT count(*) FROM base b2 WHERE b2.{c} = base.{c})"
        cols.append(f"{i64(f'CASE WHEN {c} IS NULL THEN NULL ELSE {cnt} END')} AS {c}_user_count")
        cols.append(f"{r6(f'CASE WHEN {c} IS NULL THEN NULL ELSE {cnt} / (SELECT count({c}) FROM base) END')} "
                    f"AS {c}_count")
    for c in COUNT_RATIO_COLS:
        cnt = f"(SELECT count(*) FROM base b2 WHERE b2.{c} = base.{c})"
        cols.append(f"{i64(f'CASE WHEN {c} IS NULL THEN NULL ELSE {cnt} END')} AS {c}_count")
        cols.append(f"{r6(f'CASE WHEN {c} IS NULL THEN NULL ELSE {cnt} / (SELECT count(*) FROM base) END')} "
                    f"AS {c}_count_ratio")
    for c in COUNT_COLS:
        cnt = f"(SELECT count(*) FROM base b2 WHERE b2.{c} = base.{c})"
        cols.append(f"{i64(f'CASE WHEN {c} IS NULL THEN NULL ELSE {cnt} END')} AS {c}_count")
    return f"SELECT {U}, {', '.join(cols)} FROM base"


ORACLES["value_frequency"] = with_views(_value_frequency_sql())

# ---------------------------------------------------------------- T2a
_SK_VALUES = {"v_hour": "every_days_diff_hour_amt", "v_day": "every_days_diff_amt"}
_SK_VALUES.update({f"v_{nm}": f"every_{nm}_amt" for nm, _, _ in BANDS.values()})


def _shared_rows() -> str:
    sel = [f"t.{U}", "t.timestamp", "t.row_id", "hk.v AS v_hour", "dk.v AS v_day"]
    joins = [f"LEFT JOIN (SELECT ip, days_diff, hour, {_AMT} AS v FROM trans_t WHERE ip IS NOT NULL "
             f"GROUP BY ip, days_diff, hour) hk ON hk.ip = t.ip AND hk.days_diff = t.days_diff AND hk.hour = t.hour",
             f"LEFT JOIN (SELECT ip, days_diff, {_AMT} AS v FROM trans_t WHERE ip IS NOT NULL "
             f"GROUP BY ip, days_diff) dk ON dk.ip = t.ip AND dk.days_diff = t.days_diff"]
    for b, (nm, _, _) in BANDS.items():
        sel.append(f"b{b}.v AS v_{nm}")
        joins.append(f"LEFT JOIN (SELECT ip, days_diff, {_AMT} AS v FROM trans_t WHERE ip IS NOT NULL AND "
                     f"{_band_filter(b)} GROUP BY ip, days_diff) b{b} ON b{b}.ip = t.ip AND b{b}.days_diff = t.days_diff")
    return f"SELECT {', '.join(sel)} FROM trans_t t " + " ".join(joins)


ORACLES["shared_key_amount"] = with_views(
    f"SELECT {U}, " + ", ".join(_stats_cols(v, STATS4, stem + "_{}_ip") for v, stem in _SK_VALUES.items())
    + f" FROM sk GROUP BY {U}", [("sk", _shared_rows())])
ORACLES["shared_key_amount_gap"] = with_views(
    f"SELECT {U}, " + ", ".join(_stats_cols(f"g_{v}", STATS5, stem + "_gap_{}_ip") for v, stem in _SK_VALUES.items())
    + f" FROM (SELECT {U}, " + ", ".join(
        f"{v} - lag({v}) OVER (PARTITION BY {U} ORDER BY timestamp, row_id) AS g_{v}" for v in _SK_VALUES)
    + f" FROM sk) GROUP BY {U}", [("sk", _shared_rows())])


# ---------------------------------------------------------------- T2b
def _tuple_sub(view: str, cols) -> str:
    name = "_".join(cols) + "_count_user"
    return (f"SELECT {U}, {i64('count(*)')} AS {name} FROM "
            f"(SELECT DISTINCT {U}, {', '.join(cols)} FROM {view}) GROUP BY {U}")


ORACLES["pair_count"] = with_views(_join_on_user(
    f"SELECT {U} FROM base",
    [_tuple_sub("op_n", p) for p in combinations(common.OP_PAIR_COLS, 2)]
    + [_tuple_sub("trans_t", p) for p in combinations(common.TRANS_PAIR_COLS, 2)]))
ORACLES["triple_count"] = with_views(_join_on_user(
    f"SELECT {U} FROM base",
    [_tuple_sub("trans_t", t) for t in common.TRANS_TRIPLES]
    + [_tuple_sub("op_n", t) for t in common.OP_TRIPLES]))


def _assoc_sub(view: str, x1: str, x2: str) -> str:
    return (f"SELECT u.{U}, {i64('coalesce(sum(g.n), 0)')} AS {x2}_of_nunique_{x1} FROM "
            f"(SELECT DISTINCT {U}, {x1} FROM {view}) u LEFT JOIN "
            f"(SELECT {x1}, count(DISTINCT {x2}) AS n FROM {view} WHERE {x1} IS NOT NULL GROUP BY {x1}) g "
            f"ON u.{x1} = g.{x1} GROUP BY u.{U}")


ORACLES["associated_diversity"] = with_views(_join_on_user(
    f"SELECT {U} FROM base",
    [_assoc_sub("op_n", a, b) for a in common.OP_PAIR_COLS for b in common.OP_PAIR_COLS if a != b]
    + [_assoc_sub("trans_t", a, b) for a in common.TRANS_PAIR_COLS for b in common.TRANS_PAIR_COLS if a != b]))


# ---------------------------------------------------------------- T2c
def _cross_sql(kind: str) -> str:
    ctes, joins, cols = [], [], []
    for c in CROSS_COLS1:
        ctes.append((f"vc_{c}", f"SELECT {c}, count(*) AS n FROM base WHERE {c} IS NOT NULL GROUP BY {c}"))
        joins.append(f"LEFT JOIN vc_{c} ON vc_{c}.{c} = b.{c}")
    ctes.append(("city_total", "SELECT count(city) AS n FROM base"))
    joins.append("CROSS JOIN city_total")

    def value_count(c):
        return f"vc_{c}.n / city_total.n" if c == "city" else f"vc_{c}.n"

    for f in CROSS_COLS:
        for c in CROSS_COLS1:
            if c == f:
                continue
            p = f"cross_{f}_{c}"
            t = f"x_{f}_{c}"
            ctes.append((f"{t}_nu", f"SELECT {f}, count(DISTINCT {c}) AS nu FROM base WHERE {f} IS NOT NULL GROUP BY {f}"))
            ctes.append((f"{t}_pc", f"SELECT {f}, {c}, count(*) AS n FROM base WHERE {f} IS NOT NULL AND {c} IS NOT NULL "
                                    f"GROUP BY {f}, {c}"))
            ctes.append((f"{t}_en", f"SELECT {f}, -sum(n / s * ln(n / s)) AS e FROM (SELECT {f}, n, "
                                    f"sum(n) OVER (PARTITION BY {f}) AS s FROM {t}_pc) GROUP BY {f}"))
            joins.append(f"LEFT JOIN {t}_nu ON {t}_nu.{f} = b.{f}")
            joins.append(f"LEFT JOIN {t}_en ON {t}_en.{f} = b.{f}")
            joins.append(f"LEFT JOIN {t}_pc ON {t}_pc.{f} = b.{f} AND {t}_pc.{c} = b.{c}")
            if kind == "ne":
                cols.append(f"{i64(f'{t}_nu.nu')} AS {p}_nunique")
                cols.append(f"{r6(f'CASE WHEN b.{f} IS NOT NULL THEN coalesce({t}_en.e, 0) END')} AS {p}_ent")
            else:
                cols.append(f"{i64(f'{t}_pc.n')} AS {p}_count")
                cols.append(f"{r6(f'{t}_pc.n / ({value_count(c)})')} AS {p}_count_ratio")
                cols.append(f"{r6(f'{t}_nu.nu / ({value_count(f)})')} AS {p}_nunique_ratio_{f}_count")
    return with_views(f"SELECT b.{U}, {', '.join(cols)} FROM base b " + " ".join(joins), ctes)


ORACLES["cross_nunique_entropy"] = _cross_sql("ne")
ORACLES["cross_count_ratio"] = _cross_sql("cr")


# ---------------------------------------------------------------- T2d
_TOKENS = " UNION ALL ".join(
    f"SELECT {U}, '{c}' AS col_name, unnest(regexp_extract_all(lower(coalesce({c}, 'nan')), '\\b\\w\\w+\\b')) "
    f"AS token FROM op_t" for c in common.TEXT_COLS)
_TC = f"SELECT col_name, {U}, token, count(*) AS n FROM ({_TOKENS}) GROUP BY col_name, {U}, token"
ORACLES["token_counts"] = with_views(f"SELECT col_name, {U}, token, {i64('n')} AS count FROM tc", [("tc", _TC)])
ORACLES["tfidf_weights"] = with_views(
    f"SELECT col_name, {U}, token, {r6('raw / sqrt(sum(raw * raw) OVER (PARTITION BY col_name, ' + U + '))')} "
    f"AS weight FROM (SELECT tc.*, n * (ln((1 + d.docs) / (1 + f.df)) + 1) AS raw FROM tc "
    f"JOIN (SELECT col_name, token, count(*) AS df FROM tc GROUP BY col_name, token) f USING (col_name, token) "
    f"CROSS JOIN (SELECT count(DISTINCT {U}) AS docs FROM op_t) d)", [("tc", _TC)])

ORACLES["svd_gram"] = with_views(
    f"SELECT a.col_name, a.token, b.token AS other, CAST(sum(a.n * b.n) AS DOUBLE) AS g FROM tc a "
    f"JOIN tc b ON a.col_name = b.col_name AND a.{U} = b.{U} AND a.token <= b.token GROUP BY ALL", [("tc", _TC)])

# ---------------------------------------------------------------- T3
_ENC = ["province", "city", "regist_type", "balance", "balance_avg"]
ORACLES["label_encode"] = with_views(
    f"SELECT {U}, " + ", ".join(f"{i64(f'dense_rank() OVER (ORDER BY coalesce({c}, {chr(39)}-1{chr(39)})) - 1')} AS {c}"
                                 for c in _ENC) + " FROM base")

_FOLDS = (f"SELECT *, (row_number() OVER (PARTITION BY label ORDER BY md5(concat(CAST({U} AS VARCHAR), '#', '0')), "
          f"{U}) - 1) % 5 AS fold FROM base WHERE label IS NOT NULL")
ORACLES["stratified_fold"] = with_views(f"SELECT {U}, {i64('label')} AS label, {i64('fold')} AS fold FROM f",
                                        [("f", _FOLDS)])

_TE_VALUES = {
    "province": "coalesce(province, '-1')",
    "city": "coalesce(city, '-1')",
    "city_level": "coalesce(city, '-1') || '_' || CAST(level AS VARCHAR)",
    "city_balance_avg": "coalesce(city, '-1') || '_' || coalesce(balance_avg, '-1')",
}
_TE_SRC = "SELECT *, " + ", ".join(f"{v} AS v_{k}" for k, v in _TE_VALUES.items())
ORACLES["target_encode_train"] = with_views(
    f"SELECT t.{U}, {i64('t.fold')} AS fold, " + ", ".join(
        f"{r6(f'coalesce((SELECT avg(x.label) FROM tf x WHERE x.v_{k} = t.v_{k} AND x.fold <> t.fold), '
              f'(SELECT avg(label) FROM tf))')} AS {k}_label_kfold_mean" for k in _TE_VALUES) + " FROM tf t",
    [("f", _FOLDS), ("tf", f"{_TE_SRC} FROM f")])
ORACLES["target_encode_test"] = with_views(
    f"SELECT t.{U}, " + ", ".join(
        f"{r6(f'coalesce((SELECT avg(x.label) FROM tf x WHERE x.v_{k} = t.v_{k}), (SELECT avg(label) FROM tf))')} "
        f"AS {k}_label_kfold_mean" for k in _TE_VALUES) + " FROM te t",
    [("f", _FOLDS), ("tf", f"{_TE_SRC} FROM f"), ("te", f"{_TE_SRC} FROM base WHERE label IS NULL")])


def _duplicate_sql() -> str:
    cols = [n for n, _ in BASE_COLUMNS if n not in ("user", "label")]
    kind = {n: ("s" if _BASE_KINDS.get(n) == "s" else "n") for n in cols}

    def same(a, b):
        if kind[a] == "s":
            return f"(SELECT bool_and({a} IS NOT DISTINCT FROM {b}) FROM base)"
        return f"(SELECT bool_and(CAST({a} AS DOUBLE) IS NOT DISTINCT FROM CAST({b} AS DOUBLE)) FROM base)"

    parts = []
    for j, b in enumerate(cols):
        earlier = [a for a in cols[:j] if kind[a] == kind[b]]
        if not earlier:
            continue
        chain = " ".join(f"WHEN {same(a, b)} THEN '{a}'" for a in earlier)
        parts.append(f"SELECT '{b}' AS \"column\", CASE {chain} END AS duplicate_of")
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE duplicate_of IS NOT NULL"


ORACLES["duplicate_columns"] = with_views(_duplicate_sql())

# ---------------------------------------------------------------- sequences and typed text
ORACLES["seq_sentences"] = with_views(" UNION ALL ".join(
    f"SELECT CAST({n} AS BIGINT) AS selection, {U}, position // 10000 AS run, position, token FROM ("
    f"SELECT {U}, row_number() OVER (PARTITION BY {U} ORDER BY days_diff, hour, minute, row_id) - 1 AS position, "
    f"{r6('amount')} AS token FROM trans_t{where})"
    for n, where in ((1, ""), (2, " WHERE days_diff > 27"), (3, " WHERE days_diff > 23"),
                     (4, " WHERE hour BETWEEN 7 AND 15"), (5, " WHERE days_diff > 15"))))
ORACLES["typed_text"] = (
    "SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_linenumber AS BIGINT) AS line, "
    "CASE WHEN l_quantity = floor(l_quantity) THEN CAST(l_quantity AS BIGINT) END AS quantity, "
    f"CASE WHEN l_linenumber > 1 THEN {r6('l_discount')} END AS discount FROM lineitem")
