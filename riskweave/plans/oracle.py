"""Independent SQL for the registered queries, in the dialect of DuckDB.

Built from a few shared fragments: ``t`` transactions, ``h`` history, ``f`` features, ``card`` fixed
scorecard, ``report`` scored report, ``parts`` chronological split.
"""

from __future__ import annotations

from riskweave.plans.catalog import BUSY_CUSTOMER, LINEAR_WEIGHTS, TREE_INPUTS, TREES
from riskweave.schema import ACTIONS, NUMERIC_FEATURES, TRANSACTIONS
from riskweave.sources.events import REQUESTS_SQL, TRANSACTIONS_SQL

# Categories of the test tables, sorted; the first of each has no indicator column.
CATEGORIES = {
    "merchant_category": [
        "electronics", "entertainment", "fashion", "food_delivery", "grocery", "jewelry", "travel", "utilities",
    ],
    "payment_type": ["credit_card", "debit_card", "netbanking", "upi", "wallet"],
    "device": ["mobile_android", "mobile_ios", "pos_terminal", "web_chrome", "web_safari"],
}

T = "t as (" + TRANSACTIONS_SQL.format(events="events") + ")"
R = "r as (" + REQUESTS_SQL.format(events="events") + ")"

H = """h as (
  select t.*,
    cast(extract(hour from transaction_time) as integer) as hour,
    cast(isodow(transaction_time) - 1 as integer) as day_of_week,
    case when isodow(transaction_time) >= 6 then 1 else 0 end as is_weekend,
    case when extract(hour from transaction_time) <= 5 then 1 else 0 end as is_night,
    ln(1 + amount) as log_amount,
    avg(amount) over (partition by customer_id order by transaction_time, transaction_id
                      rows between unbounded preceding and 1 preceding) as running_avg,
    cast(count(amount) over (partition by customer_id order by transaction_time
      range between interval 24 hours preceding and interval 1 microsecond preceding) as double)
      as transactions_last_24h,
    cast(count(amount) over (partition by customer_id order by transaction_time
      range between interval 1 hour preceding and interval 1 microsecond preceding) as double)
      as transactions_last_1h,
    case when row_number() over (partition by customer_id, device order by transaction_time, transaction_id) = 1
         then 1 else 0 end as new_device,
    coalesce(sqrt(power(location_lat - lag(location_lat) over (partition by customer_id
                        order by transaction_time, transaction_id), 2)
                + power(location_lon - lag(location_lon) over (partition by customer_id
                        order by transaction_time, transaction_id), 2)), 0) as location_change
  from t)"""

F = """f as (
  select h.*, coalesce(running_avg, (select quantile_cont(amount, 0.5) from t)) as cust_running_avg_amount,
    amount / (coalesce(running_avg, (select quantile_cont(amount, 0.5) from t)) + 1e-6) as amount_vs_customer_avg
  from h)"""

PARTS = """parts as (
  select t.*, case when pos < floor(n * cast(0.70 as double)) then 'train'
                   when pos < floor(n * cast(0.85 as double)) then 'validation' else 'test' end as split
  from (select t.*, row_number() over (order by transaction_time, transaction_id) - 1 as pos,
               count(*) over () as n from t) t)"""

POINTS = "(cents - cents % 4) / 4"

CARD = f"""c as (select h.*, cast(round(amount * 100) as bigint) as cents from h),
card as (select c.*, least(10000, {POINTS} + 1500 * is_night + 1000 * new_device) / 10000e0 as score,
                least(10000, {POINTS}) / 10000e0 as amount_score from c)"""


def _risk(p: str) -> str:
    level = f"case when {p} < 0.3e0 then 'LOW' when {p} < 0.7e0 then 'MEDIUM' else 'HIGH' end"
    action = " ".join(f"when '{k}' then '{v}'" for k, v in ACTIONS.items())
    return (
        f"cast(round_even({p} * 100, 0) as integer) as risk_score, {level} as risk_level,"
        f" case {level} {action} end as recommended_action"
    )


REPORT = f"""report as (
  select transaction_id, customer_id, amount, merchant_category, payment_type, is_fraud,
         score as fraud_probability, {_risk("score")} from card)"""

# one row per distinct score with the class counts at and above it
RANKED = """ranked as (
  select score, pos, neg, sum(pos) over w as tp, sum(neg) over w as fp,
         sum(pos) over () as p, sum(neg) over () as n
  from (select {score} as score, sum(is_fraud) as pos, sum(1 - is_fraud) as neg from card group by 1)
  window w as (order by score desc))"""

AREAS = """(select sum(neg * (2 * (tp - pos) + pos)) / (2e0 * max(p) * max(n)) from ranked) as roc_auc,
  (select sum(pos * (tp / (tp + fp))) / max(p) from ranked) as pr_auc"""

FLAGGED = """coalesce(tp / nullif(tp + fp, 0), 0) as precision, coalesce(tp / nullif(tp + fn, 0), 0) as recall,
  coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) as f1"""


def _counts(score: str) -> str:
    return f"""select count(*) filter (is_fraud = 1 and {score} >= 0.5) as tp,
      count(*) filter (is_fraud = 0 and {score} >= 0.5) as fp,
      count(*) filter (is_fraud = 1 and {score} < 0.5) as fn,
      count(*) filter (is_fraud = 0 and {score} < 0.5) as tn from card"""


def _metrics(name: str, score: str) -> str:
    ranked = RANKED.format(score=score)
    return f"""select '{name}' as model, precision, recall, f1, roc_auc, pr_auc
      from (with {ranked}, k as ({_counts(score)}) select {FLAGGED}, {AREAS} from k)"""


TWO = f"two as ({_metrics('scorecard', 'score')} union all {_metrics('amount_only', 'amount_score')})"
METRIC_NAMES = ("precision", "recall", "f1", "roc_auc", "pr_auc")


def _steps() -> str:
    """One row per step from a root towards a leaf: (tree, leaf, value, input, threshold, goes left, share of the weight)."""
    rows = []
    for t, (weight, nodes) in enumerate(TREES):
        up = {child: (i, child == n[2]) for i, n in enumerate(nodes) if len(n) > 2 for child in n[2:4]}
        for leaf in (i for i, n in enumerate(nodes) if len(n) == 2):
            at = leaf
            while at:
                above, left = up[at]
                _, _, _, _, feature, cut = nodes[above]
                rows.append(f"({t}, {leaf}, {2 * weight * nodes[leaf][0]!r}e0, {feature}, {cut!r}e0, {left}, {nodes[at][1]} / {nodes[above][1]}e0)")
                at = above
    return f"step(tree, leaf, value, input, cut, goes_left, share) as (values {', '.join(rows)})"


M = len(TREE_INPUTS)
# ``v`` is the trees' expectation for a row when only the inputs of ``mask`` are known, and a Shapley value the weighted sum of
# what an input adds to every subset of the others.
SHAPLEY = (
    _steps(),
    f"""x as (select f.*, [{', '.join(f'{c}::double' for c in TREE_INPUTS)}] as inputs,
      case when extract(day from transaction_time) <= 20 then 'early' else 'late' end as part from f)""",
    f"""v as (select transaction_id, mask, sum(value * p) as v from (
      select transaction_id, mask, any_value(value) as value, product(case when (mask >> input) & 1 = 0 then share
        when (inputs[input + 1] <= cut) = goes_left then 1 else 0 end) as p
      from x, range({2**M}) s(mask), step group by transaction_id, mask, tree, leaf) group by all)""",
    f"""phi as (select a.transaction_id, j, sum((b.v - a.v) * case bit_count(a.mask::integer) when 0 then 6 when 3 then 6 else 2 end / 24e0) as phi
      from v a, range({M}) i(j), v b
      where (a.mask >> j) & 1 = 0 and b.mask = a.mask + (1 << j) and a.transaction_id = b.transaction_id group by all)""",
    f"named as (select *, [{', '.join(repr(c) for c in TREE_INPUTS)}][j + 1] as feature from phi)",
)


def _newton(steps: int = 12) -> list[str]:
    """Newton steps of the weighted, penalised logistic loss over grouped rows, a fragment each.

    ``z`` has the standardised flags, class weights and counts of the distinct rows; the intercept is not penalised.
    """
    out = ["b0 as (select 0e0 as a, 0e0 as b, 0e0 as c)"]
    for i in range(steps):
        out.append(f"""s{i} as (
          select any_value(a) as a, any_value(b) as b, any_value(c) as c, sum(w * (p - y)) as g0, sum(w * (p - y) * z1) + any_value(b) as g1,
            sum(w * (p - y) * z2) + any_value(c) as g2, sum(w * p * (1 - p)) as h00, sum(w * p * (1 - p) * z1) as h01,
            sum(w * p * (1 - p) * z2) as h02, sum(w * p * (1 - p) * z1 * z1) + 1 as h11, sum(w * p * (1 - p) * z1 * z2) as h12,
            sum(w * p * (1 - p) * z2 * z2) + 1 as h22
          from (select *, 1 / (1 + exp(-(a + b * z1 + c * z2))) as p from z, b{i})),
        b{i + 1} as (
          select a - (g0 * (h11 * h22 - h12 * h12) - g1 * (h01 * h22 - h02 * h12) + g2 * (h01 * h12 - h02 * h11)) / d as a,
            b - (-g0 * (h01 * h22 - h12 * h02) + g1 * (h00 * h22 - h02 * h02) - g2 * (h00 * h12 - h01 * h02)) / d as b,
            c - (g0 * (h01 * h12 - h11 * h02) - g1 * (h00 * h12 - h01 * h02) + g2 * (h00 * h11 - h01 * h01)) / d as c
          from (select *, h00 * (h11 * h22 - h12 * h12) - h01 * (h01 * h22 - h12 * h02) + h02 * (h01 * h12 - h11 * h02) as d from s{i}))""")
    return out


def _q(*fragments_and_body: str) -> str:
    *fragments, body = fragments_and_body
    return f"with {', '.join(fragments)} {body}"


def _rates(key: str, name: str, extra: str = "") -> str:
    return _q(
        T,
        f"""select {key} as {name}, count(*) as transactions, cast(sum(is_fraud) as bigint) as fraud_count,
        round(100e0 * sum(is_fraud) / count(*), 3) as fraud_rate_pct{extra} from t group by 1""",
    )


def _rounded(names, digits: int) -> str:
    return ", ".join(f"round({n}, {digits}) as {n}" for n in names)


def _indicators(cast: str = "integer") -> str:
    return ", ".join(
        f"cast(case when {c} = '{v}' then 1 else 0 end as {cast}) as {c}_{v}"
        for c, values in CATEGORIES.items()
        for v in values[1:]
    )


def _numeric(digits: dict[str, int]) -> str:
    return ", ".join(
        f"round({n}, {digits[n]}) as {n}" if n in digits else f"cast({n} as double) as {n}" for n in NUMERIC_FEATURES
    )


# averages of two-decimal amounts can end exactly in a five at six digits, so they are compared at eight
DIGITS = {"log_amount": 6, "cust_running_avg_amount": 8, "amount_vs_customer_avg": 6, "location_change": 6}

RULES = {
    "amount_required": "amount is null",
    "amount_positive": "amount <= 0",
    "hour_range": "hour not between 0 and 23",
    "day_of_week_range": "day_of_week not between 0 and 6",
    "new_device_range": "new_device not between 0 and 1",
}
ERRORS = "concat_ws(',', " + ", ".join(f"case when {rule} then '{name}' end" for name, rule in RULES.items()) + ")"

D = """d as (
  select request_id, coalesce(amount, 0) as amount, coalesce(hour, 12) as hour,
    coalesce(day_of_week, 0) as day_of_week, merchant_category, payment_type, device,
    coalesce(new_device, 0) as new_device, coalesce(transactions_last_1h, 0) as transactions_last_1h,
    coalesce(transactions_last_24h, 1) as transactions_last_24h, coalesce(location_change, 0) as location_change,
    coalesce(cust_running_avg_amount, case when coalesce(amount, 0) > 0 then amount else 1 end)
      as cust_running_avg_amount
  from r{where})"""
ALL_D = D.format(where="")
VALID_D = D.format(where=f" where {ERRORS} = ''")
RF = """rf as (select d.*, ln(1 + amount) as log_amount, case when day_of_week >= 5 then 1 else 0 end as is_weekend,
  case when hour <= 5 then 1 else 0 end as is_night,
  amount / (cust_running_avg_amount + 1e-6) as amount_vs_customer_avg from d)"""

LINEAR = "lin as (select transaction_id, " + ", ".join(
    f"{w!r} * (cast({n} as double) - (select avg({n}) from f)) as {n}" for n, w in LINEAR_WEIGHTS.items()
) + ", " + " + ".join(f"{w!r} * cast({n} as double)" for n, w in LINEAR_WEIGHTS.items()) + " as margin from f)"

QUARTILES = """quantile_cont(amount, 0.25) as q1, quantile_cont(amount, 0.5) as median,
  quantile_cont(amount, 0.75) as q3"""


def sql() -> dict[str, str]:
    out: dict[str, str] = {}

    out["scan_transactions"] = _q(T, "select * from t")
    out["csv_round_trip"] = out["scan_transactions"]
    out["load_table_count"] = _q(T, "select count(*) as rows_loaded from t")
    out["load_table_replaced"] = out["scan_transactions"]
    out["map_foreign_orders"] = """select concat('ORD', o_orderkey) as transaction_id, o_custkey as customer_id,
      o_totalprice as amount, o_orderdate as transaction_time, cast(null as varchar) as merchant_category,
      lower(o_orderpriority) as payment_type, cast(null as varchar) as device,
      cast(null as double) as location_lat, cast(null as double) as location_lon,
      case when o_orderstatus = 'F' then 1 else 0 end as is_fraud from orders"""
    out["total_transactions"] = _q(T, "select count(*) as total from t")
    out["fraud_vs_legit"] = _q(
        T,
        """select is_fraud, count(*) as count, round(100e0 * count(*) / (select count(*) from t), 3) as pct
        from t group by is_fraud""",
    )
    out["fraud_by_payment_type"] = _rates("payment_type", "payment_type")
    out["fraud_by_merchant_category"] = _rates(
        "merchant_category", "merchant_category", ", round(avg(amount), 2) as avg_amount"
    )
    out["fraud_by_hour"] = _rates("cast(extract(hour from transaction_time) as integer)", "hour")
    out["top_risky_devices"] = _rates("device", "device")
    out["high_value_fraud"] = _q(
        T,
        """select transaction_id, customer_id, amount, merchant_category, payment_type from t where is_fraud = 1
        order by amount desc nulls last, transaction_id limit 10""",
    )
    out["velocity_customers"] = _q(
        T,
        f"""select customer_id, count(*) as txn_count, cast(sum(is_fraud) as bigint) as fraud_count
        from t group by customer_id having count(*) > {BUSY_CUSTOMER}""",
    )

    names = TRANSACTIONS.fieldNames()
    out["profile_shape"] = _q(T, f"select count(*) as row_count, {len(names)} as column_count from t")
    out["profile_nulls"] = _q(
        T,
        " union all ".join(
            f"select '{n}' as column_name, count(*) - count({n}) as null_count from t" for n in names
        ),
    )
    out["class_balance"] = _q(
        T,
        """select is_fraud, count(*) as count, cast(count(*) as double) / (select count(*) from t) as fraction
        from t group by is_fraud""",
    )
    statistics = {
        "count": "cast(count(amount) as double)", "mean": "avg(amount)", "std": "stddev_samp(amount)",
        "min": "min(amount)", "max": "max(amount)", "25%": "quantile_cont(amount, 0.25)",
        "50%": "quantile_cont(amount, 0.5)", "75%": "quantile_cont(amount, 0.75)",
    }
    out["describe_amount"] = _q(
        T,
        " union all ".join(
            f"select '{n}' as statistic, round({e}, 8) as value from t" for n, e in statistics.items()
        ),
    )
    out["amount_by_class"] = _q(
        T,
        f"""select is_fraud, {_rounded(("mean", "std", "q1", "median", "q3"), 8)} from (
        select is_fraud, avg(amount) as mean, stddev_samp(amount) as std, {QUARTILES} from t group by is_fraud)""",
    )
    out["boxplot_amount"] = _q(
        T,
        f"b as (select is_fraud, {QUARTILES} from t group by is_fraud)",
        f"""select is_fraud, {_rounded(("q1", "median", "q3", "whisker_low", "whisker_high"), 8)} from (
        select b.is_fraud, q1, median, q3,
          least(min(amount) filter (amount >= q1 - (q3 - q1) * 1.5), q1) as whisker_low,
          greatest(max(amount) filter (amount <= q3 + (q3 - q1) * 1.5), q3) as whisker_high
        from t join b on t.is_fraud = b.is_fraud group by 1, 2, 3, 4)""",
    )
    for key, name, column in (
        ("fraud_rate_hour_curve", "hour", "cast(extract(hour from transaction_time) as integer)"),
        ("fraud_rate_merchant", "merchant_category", "merchant_category"),
    ):
        out[key] = _q(
            T, f"select {column} as {name}, round(avg(is_fraud) * 100, 9) as fraud_rate_pct from t group by 1"
        )
    out["crosstab_payment"] = _q(
        T,
        """select payment_type, count(*) filter (is_fraud = 0) as legit, count(*) filter (is_fraud = 1) as fraud
        from t group by payment_type""",
    )
    out["global_median"] = _q(T, "select quantile_cont(amount, 0.5) as median_amount from t")
    # average ranks of tied amounts, then the rank-sum form of U
    out["mannwhitney"] = _q(
        T,
        """g as (select amount, cast(count(*) as double) as c, cast(sum(is_fraud) as double) as pos
                 from t group by amount)""",
        "a as (select g.*, sum(c) over (order by amount) - c + (c + 1) / 2 as avg_rank from g)",
        """s as (select sum(pos) as n1, sum(c) - sum(pos) as n2, sum(pos * avg_rank) as r1,
                 sum(c * c * c - c) as tie_term from a)""",
        "u as (select s.*, n1 + n2 as n, r1 - n1 * (n1 + 1) / 2 as u from s)",
        """select cast(n1 as bigint) as n_fraud, cast(n2 as bigint) as n_legit, u as u_statistic, tie_term,
        round((greatest(u, n1 * n2 - u) - n1 * n2 / 2 - 0.5e0)
          / sqrt(n1 * n2 / 12 * (n + 1 - tie_term / (n * (n - 1)))), 9) as z from u""",
    )
    out["chi_square"] = _q(
        T,
        "o as (select payment_type, is_fraud, count(*) as seen from t group by all)",
        """e as (select payment_type, is_fraud, seen, cast(sum(seen) over (partition by payment_type) as double)
                 * sum(seen) over (partition by is_fraud) / sum(seen) over () as expected from o)""",
        """select round(sum(power(seen - expected, 2) / expected), 9) as chi2,
        cast((count(distinct payment_type) - 1) * (count(distinct is_fraud) - 1) as integer) as dof from e""",
    )
    # four degrees of freedom: the tail has a closed form
    out["chi_square_p"] = f"""select round(exp(-chi2 / 2) * (1 + chi2 / 2), 9) as p_value,
      exp(-chi2 / 2) * (1 + chi2 / 2) < 0.05 as reject from ({out["chi_square"]}) where dof = 4"""
    # erf(x) = 2 / sqrt(pi) * exp(-x * x) * (x + x * (2 x x / 3) + x * (2 x x / 3) * (2 x x / 5) + ...): all terms are positive
    out["hypothesis_results"] = f"""with recursive mw as ({out["mannwhitney"]}),
      e(i, x, term, total) as (
        select 0, z / sqrt(2e0), z / sqrt(2e0), z / sqrt(2e0) from mw
        union all select i + 1, x, term * 2 * x * x / (2 * i + 3), total + term * 2 * x * x / (2 * i + 3) from e where i < 300),
      tail as (select case when x > 6 then 0 else least(1, 1 - 2 / sqrt(pi()) * exp(-x * x) * total) end as p from e where i = 300)
      select 'mann_whitney_amount' as test, round(u_statistic, 6) as statistic, round(p, 7) as p_value, p < 0.05 as reject from mw, tail
      union all select 'chi_square_payment_type', round(chi2, 6), round(exp(-chi2 / 2) * (1 + chi2 / 2), 7),
        exp(-chi2 / 2) * (1 + chi2 / 2) < 0.05 from ({out["chi_square"]}) where dof = 4"""
    out["sketched_quartiles"] = _q(
        T,
        "select is_fraud, quantile, count(amount) as rows, true as within from t, (values ('q1'), ('median'), ('q3')) q(quantile) group by all",
    )
    out["corr_hour_fraud"] = _q(
        T, "select round(corr(extract(hour from transaction_time), is_fraud), 9) as corr from t"
    )

    out["time_features"] = _q(
        T, H, "select transaction_id, hour, day_of_week, is_weekend, is_night, round(log_amount, 6) as log_amount from h"
    )
    out["rounding"] = _q(
        T,
        """select transaction_id, round(cents / 8e0, 2) as half_up, round_even(cents / 8e0, 2) as half_even,
        round(100e0 * (cents % 97) / 128, 3) as pct
        from (select transaction_id, cast(round(amount * 100) as bigint) as cents from t)""",
    )
    out["feat_running_avg"] = _q(
        T, H, F, "select transaction_id, round(cust_running_avg_amount, 8) as cust_running_avg_amount from f"
    )
    out["feat_velocity"] = _q(T, H, "select transaction_id, transactions_last_24h, transactions_last_1h from h")
    out["feat_new_device"] = _q(T, H, "select transaction_id, new_device from h")
    out["feat_location_change"] = _q(
        T, H, "select transaction_id, round(location_change, 6) as location_change from h"
    )
    out["stream_history"] = _q(
        T,
        H,
        """select transaction_id, round(running_avg, 8) as running_avg, transactions_last_24h, transactions_last_1h, new_device,
        round(location_change, 6) as location_change from h""",
    )
    out["feat_amount_ratio"] = _q(
        T, H, F, "select transaction_id, round(amount_vs_customer_avg, 6) as amount_vs_customer_avg from f"
    )
    out["build_features"] = _q(
        T,
        H,
        F,
        f"""select {", ".join(names)}, hour, day_of_week, is_weekend, is_night, transactions_last_24h,
        transactions_last_1h, new_device, round(cust_running_avg_amount, 8) as cust_running_avg_amount,
        {_rounded(("log_amount", "amount_vs_customer_avg", "location_change"), 6)} from f""",
    )

    out["split_rows"] = _q(T, PARTS, "select transaction_id, split from parts")
    out["split_summary"] = _q(
        T, PARTS, "select split, count(*) as row_count, round(avg(is_fraud), 9) as fraud_rate from parts group by split"
    )
    out["one_hot"] = _q(T, f"select transaction_id, {_indicators()} from t")
    out["feature_matrix"] = _q(T, H, F, f"select transaction_id, {_numeric(DIGITS)}, {_indicators('double')} from f")
    scaled = ", ".join(f"round(({n} - m_{n}) / s_{n}, 6) as {n}" for n in NUMERIC_FEATURES)
    moments = ", ".join(
        f"avg({n}) as m_{n}, case when stddev_pop({n}) = 0 then 1 else stddev_pop({n}) end as s_{n}"
        for n in NUMERIC_FEATURES
    )
    out["standardize"] = _q(
        T,
        H,
        F,
        PARTS,
        f"m as (select {moments} from f where transaction_id in (select transaction_id from parts where split = 'train'))",
        f"select transaction_id, {scaled} from f, m",
    )
    sets = {f"{c}_{v}": f"case when {c} = '{v}' then 1e0 else 0e0 end" for c, values in CATEGORIES.items() for v in values[1:]}
    inputs = {n: n for n in NUMERIC_FEATURES} | sets
    out["fitted_moments"] = _q(
        T,
        H,
        F,
        PARTS,
        "u as (select f.* from f join parts using (transaction_id) where split = 'train')",
        " union all ".join(
            f"select '{n}' as feature, round(avg({e}), 6) as mean, round(coalesce(nullif(stddev_pop({e}), 0), 1), 6) as deviation from u"
            for n, e in inputs.items()
        ),
    )
    begin = 2
    places = []
    for c, values in CATEGORIES.items():
        places.append(f"case {c} " + " ".join(f"when '{v}' then {begin + i}" for i, v in enumerate(values[1:])) + " end")
        begin += len(values) - 1
    out["sparse_encoding"] = _q(
        T, f"select transaction_id, {begin} as inputs, amount, concat_ws(',', {', '.join(places)}) as places from t"
    )
    out["class_weights"] = _q(
        T,
        PARTS,
        "k as (select cast(sum(is_fraud) as bigint) as p, count(*) as n from parts where split = 'train')",
        """select p as positives, n - p as negatives, cast(n as double) / (2 * p) as weight_positive,
        cast(n as double) / (2 * (n - p)) as weight_negative,
        cast(n - p as double) / greatest(p, 1) as scale_pos_weight from k""",
    )

    card = (T, H, CARD)
    ranked = RANKED.format(score="score")
    out["confusion_matrix"] = _q(
        *card,
        f"""select tn as true_negative, fp as false_positive, fn as false_negative, tp as true_positive
        from ({_counts("score")})""",
    )
    out["precision_recall_f1"] = _q(*card, f"k as ({_counts('score')})", f"select {FLAGGED} from k")
    out["roc_auc"] = _q(*card, ranked, f"select round(roc_auc, 9) as roc_auc from (select {AREAS})")
    out["average_precision"] = _q(*card, ranked, f"select round(pr_auc, 9) as pr_auc from (select {AREAS})")
    out["roc_curve"] = _q(
        *card,
        ranked,
        """select fp / n as fpr, tp / p as tpr, score as threshold from ranked
        union all select 0e0, 0e0, null""",
    )
    out["pr_curve"] = _q(
        *card,
        ranked,
        """select tp / (tp + fp) as precision, tp / p as recall, score as threshold from ranked
        union all select 1e0, 0e0, null""",
    )
    out["metrics_two_scores"] = _q(*card, TWO, f"select model, {_rounded(METRIC_NAMES, 9)} from two")
    out["metrics_long"] = _q(
        *card,
        TWO,
        " union all ".join(f"select model, '{m}' as metric, round({m}, 9) as value from two" for m in METRIC_NAMES),
    )

    rep = (*card, REPORT)
    out["risk_scoring"] = _q(
        *rep, "select transaction_id, fraud_probability, risk_score, risk_level, recommended_action from report"
    )
    out["scored_report"] = _q(
        *rep,
        PARTS,
        "select report.* from report join parts using (transaction_id) where split = 'test'",
    )
    out["risk_level_distribution"] = _q(*rep, "select risk_level, count(*) as count from report group by 1")
    out["top_risk"] = _q(*rep, "select * from report order by risk_score desc, transaction_id limit 10")
    out["argmax_row"] = _q(
        *card, "select transaction_id, is_fraud, score from card order by score desc, transaction_id limit 1"
    )
    out["dashboard_kpis"] = _q(
        *rep,
        """select count(*) as total_transactions, cast(sum(is_fraud) as bigint) as fraud_transactions,
        round(100e0 * sum(is_fraud) / count(*), 2) as fraud_rate_pct,
        count(*) filter (risk_level = 'HIGH') as high_risk_flagged from report""",
    )
    out["risk_by_merchant"] = _q(
        *rep, "select merchant_category, risk_level, count(*) as count from report group by 1, 2"
    )
    out["risk_level_share"] = _q(
        *rep,
        """select risk_level, count(*) as count, cast(count(*) as double) / (select count(*) from report) as share
        from report group by 1""",
    )
    shown = """select transaction_id, customer_id, amount, merchant_category, fraud_probability, risk_score,
      risk_level, recommended_action from report"""
    out["monitor_default"] = _q(*rep, f"{shown} where risk_level in ('HIGH', 'MEDIUM')")
    out["monitor_all"] = _q(*rep, shown)

    out["request_validation"] = _q(R, f"select request_id, {ERRORS} = '' as valid, {ERRORS} as errors from r")
    out["request_defaults"] = _q(R, ALL_D, "select * exclude (merchant_category, payment_type, device) from d")
    few = {n: 6 for n in ("log_amount", "amount_vs_customer_avg")}
    plain = ", ".join(f"round({n}, 6) as {n}" if n in few else n for n in NUMERIC_FEATURES)
    out["request_features"] = _q(R, VALID_D, RF, f"select request_id, {plain} from rf")
    out["request_encoding"] = _q(
        R, VALID_D, RF, f"select request_id, {_numeric(few)}, {_indicators('double')} from rf"
    )
    out["score_requests"] = _q(
        R,
        VALID_D,
        RF,
        f"""p as (select request_id, least(10000, {POINTS} + 1500 * is_night + 1000 * new_device) / 10000e0 as p
             from (select rf.*, cast(round(amount * 100) as bigint) as cents from rf))""",
        f"select request_id, round_even(p, 4) as fraud_probability, {_risk('p')} from p",
    )
    out["score_stream_card"] = out["score_requests"]
    out["stream_responses"] = out["score_requests"]
    out["stream_rejects"] = _q(R, f"select request_id, {ERRORS} as errors from r where {ERRORS} <> ''")
    out["report_csv_round_trip"] = _q(*rep, "select report.* from report")
    out["report_read_back"] = _q(*rep, "select report.* from report")
    out["comparison_read_back"] = out["metrics_two_scores"]

    out["linear_attributions"] = _q(
        T, H, F, LINEAR, f"select transaction_id, {_rounded(LINEAR_WEIGHTS, 8)} from lin"
    )
    out["linear_importance"] = _q(
        T,
        H,
        F,
        LINEAR,
        " union all ".join(
            f"select '{n}' as feature, round(avg(abs({n})), 12) as mean_abs_attribution from lin"
            for n in LINEAR_WEIGHTS
        ),
    )
    out["linear_explain_top"] = _q(
        T,
        H,
        F,
        LINEAR,
        "top as (select * from lin order by margin desc, transaction_id limit 1)",
        "select * from ("
        + " union all ".join(
            f"select transaction_id, '{n}' as feature, round({n}, 8) as attribution from top" for n in LINEAR_WEIGHTS
        )
        + ") order by abs(attribution) desc, feature limit 8",
    )
    out["logreg_small_design"] = _q(
        T,
        H,
        PARTS,
        "u as (select h.*, split from h join parts using (transaction_id))",
        """m as (select avg(is_night) as m1, avg(new_device) as m2, stddev_pop(is_night) as d1, stddev_pop(new_device) as d2,
          count(*) as n, sum(is_fraud) as p from u where split = 'train')""",
        """z as (select (is_night - m1) / d1 as z1, (new_device - m2) / d2 as z2, is_fraud as y,
          count(*) * n / (2e0 * case is_fraud when 1 then p else n - p end) as w
          from u, m where split = 'train' group by is_night, new_device, is_fraud, m1, m2, d1, d2, n, p)""",
        *_newton(),
        """select transaction_id, is_fraud,
        round(1 / (1 + exp(-(a + b * (is_night - m1) / d1 + c * (new_device - m2) / d2))), 6) as fraud_probability
        from u, m, b12 where split = 'test'""",
    )
    shapley = (T, H, F, *SHAPLEY)
    out["fixed_tree_attributions"] = _q(
        *shapley,
        f"""select v.transaction_id, round(v.v, 9) as base_value,
        {", ".join(f"round(max(phi) filter (j = {i}), 9) as {c}" for i, c in enumerate(TREE_INPUTS))}
        from v join phi using (transaction_id) where v.mask = 0 group by v.transaction_id, v.v""",
    )
    out["fixed_attribution_importance"] = _q(
        *shapley, "select feature, round(avg(abs(phi)), 9) as mean_abs_attribution from named group by feature"
    )
    out["fixed_attribution_long"] = _q(
        *shapley,
        "select transaction_id, feature, inputs[j + 1] as value, round(phi, 9) as attribution from named join x using (transaction_id)",
    )
    out["fixed_explain_top"] = _q(
        *shapley,
        f"top as (select transaction_id, round(1 / (1 + exp(-v)), 9) as fraud_probability from v where mask = {2**M - 1}"
        " order by 2 desc, 1 limit 1)",
        """select transaction_id, is_fraud, fraud_probability, feature, inputs[j + 1] as value, round(phi, 9) as attribution
        from top join named using (transaction_id) join x using (transaction_id)
        order by abs(phi) desc, feature limit 8""",
    )
    out["fixed_round_metrics"] = _q(
        T,
        H,
        F,
        *SHAPLEY[:2],
        f"""g as (select transaction_id, part, is_fraud, tree, sum(value * p) as v from (
          select transaction_id, part, is_fraud, tree, any_value(value) as value,
            product(case when (inputs[input + 1] <= cut) = goes_left then 1 else 0 end) as p
          from x, step group by transaction_id, part, is_fraud, tree, leaf) group by all)""",
        "s as (select part, is_fraud, tree + 1 as round, sum(v) over (partition by transaction_id order by tree) as score from g)",
        "k as (select part, round, score, sum(is_fraud) as pos, sum(1 - is_fraud) as neg from s group by all)",
        """r as (select *, sum(pos) over w as tp, sum(neg) over w as fp, sum(pos) over (partition by part, round) as p,
          sum(neg) over (partition by part, round) as n from k window w as (partition by part, round order by score desc))""",
        """c as (select part, round, sum(neg * (2 * (tp - pos) + pos)) / (2e0 * max(p) * max(n)) as roc_auc,
          sum(pos * (tp / (tp + fp))) / max(p) as pr_auc, sum(pos) filter (score >= 0) as tp, sum(neg) filter (score >= 0) as fp,
          sum(pos) filter (score < 0) as fn from r group by all)""",
        f"m as (select part, round, roc_auc, pr_auc, {FLAGGED} from (select * replace (coalesce(tp, 0) as tp, coalesce(fp, 0) as fp, coalesce(fn, 0) as fn) from c))",
        f"select part, round::integer as round, {_rounded(METRIC_NAMES, 9)} from m",
    )
    return out
