"""DuckDB SQL that must give the same rows as the registered queries."""

from __future__ import annotations

PRICES = ["open", "high", "low", "close", "wprice"]
VOLUMES = ["volume", "turnover"]
BARS = ["open", "high", "low", "close", "volume", "turnover", "wprice"]
SMA = ["Feat_SMA_5", "Feat_SMA_10", "Feat_SMA_15"]
INPUTS = [*BARS, *SMA, "Feat_GK_Vol", "Feat_Vol_Std"]
LAGS = [f"Lag_{i}" for i in range(1, 6)]
# Names under which runs are recorded.
MODELS = ["Gradient Boosted Trees", "Random Forest", "Multilayer Perceptron"]
AUTOREGRESSIVE = "Logistic Regression (AR)"


def r6(expr: str, name: str | None = None) -> str:
    # adding zero turns a rounded -0.0 into 0.0
    return f"round({expr}, 6) + 0.0 AS {name or expr}"


def r6s(names) -> str:
    return ", ".join(r6(n) for n in names)


def ln(a: str, b: str) -> str:
    return f"CASE WHEN {b} <> 0 AND {a} / {b} > 0 THEN ln({a} / {b}) END"


def ratio(a: str, b: str) -> str:
    return f"CASE WHEN {b} <> 0 THEN ({a}) / {b} END"


def bars(name: str, where: str, step: str, having: str = "") -> str:
    return f"""{name} AS (
        SELECT *, volume * close AS turnover, close AS wprice FROM (
            SELECT e.event_type AS sym, date_trunc('{step}', e.ts) AS b, arg_min(e.value, e.ts) AS open,
                max(e.value) AS high, min(e.value) AS low, arg_max(e.value, e.ts) AS close, sum(e.value) AS volume
            FROM events e WHERE {where} GROUP BY 1, 2 {having}))"""


def chain(step: str = "hour", whole: bool = False) -> str:
    """Common table expressions from events to the feature table.

    ``whole``: the bars of all events, not filled, stand for both the primary and the filled ones.
    """
    over = "OVER (PARTITION BY sym ORDER BY ts)"
    merged = ", ".join(f"coalesce(p_{c}, a.{c}) AS {c}" for c in BARS)
    last = ", ".join(
        f"last_value({c} IGNORE NULLS) OVER (PARTITION BY sym ORDER BY ts ROWS UNBOUNDED PRECEDING) AS {c}" for c in PRICES
    )
    frame = "avg(close) OVER (PARTITION BY sym ORDER BY ts ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) AS m{n}"
    means = ", ".join(frame.format(n=n) for n in (5, 10, 15))
    filled = f"""SELECT sym, ts, missing, from_aux, {last}, coalesce(volume, 0.0) AS volume,
        coalesce(turnover, 0.0) AS turnover FROM merged"""
    if whole:
        filled = f"SELECT sym, b AS ts, false AS missing, false AS from_aux, {', '.join(BARS)} FROM p"
    return f"""WITH {bars('p', 'true' if whole else 'e.user_id % 3 = 0', step)}, {bars('x', 'e.user_id % 3 <> 0', step, 'HAVING sum(e.value) > 0')},
    grid AS (
        SELECT sym, unnest(generate_series(lo, hi, INTERVAL 1 {step})) AS ts
        FROM (SELECT sym, min(b) AS lo, max(b) AS hi FROM p GROUP BY sym)),
    aligned AS (
        SELECT g.sym, g.ts, {", ".join(f"p.{c} AS p_{c}" for c in BARS)}
        FROM grid g LEFT JOIN p ON p.sym = g.sym AND p.b = g.ts),
    merged AS (
        SELECT g.sym, g.ts, {merged}, p_open IS NULL AS missing, p_open IS NULL AND a.open IS NOT NULL AS from_aux
        FROM aligned g LEFT JOIN x a ON a.sym = g.sym AND a.b = g.ts),
    filled AS ({filled}),
    steps AS (
        SELECT *, lag(close) {over} AS prev, {means}, {ln('high', 'low')} AS hl, {ln('close', 'open')} AS co FROM filled),
    rets AS (SELECT *, {ln('close', 'prev')} AS log_return FROM steps),
    everything AS (
        SELECT s.*, {ratio('s.close - m5', 'm5')} AS Feat_SMA_5, {ratio('s.close - m10', 'm10')} AS Feat_SMA_10,
            {ratio('s.close - m15', 'm15')} AS Feat_SMA_15, 0.5::DOUBLE * hl * hl - 0.38629::DOUBLE * co * co AS Feat_GK_Vol,
            stddev_samp(log_return) OVER (
                PARTITION BY s.sym ORDER BY s.ts ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS Feat_Vol_Std,
            f.close AS FutureClose, CASE WHEN f.close > s.close THEN 1 ELSE 0 END AS Target
        FROM rets s LEFT JOIN filled f ON f.sym = s.sym AND f.ts = s.ts + 15 * INTERVAL 1 {step}),
    features AS (
        SELECT * FROM everything WHERE log_return IS NOT NULL AND Feat_SMA_5 IS NOT NULL AND Feat_SMA_10 IS NOT NULL
            AND Feat_SMA_15 IS NOT NULL AND Feat_GK_Vol IS NOT NULL AND Feat_Vol_Std IS NOT NULL
            AND FutureClose IS NOT NULL),
    rule AS (
        SELECT sym, ts, Target, round(Feat_SMA_5, 6) + 0.0 AS score,
            CASE WHEN round(Feat_SMA_5, 6) > 0 THEN 1 ELSE 0 END AS prediction
        FROM features)
    """


def scaled(names, source: str, fit: str | None = None) -> str:
    """Columns of ``source`` scaled by the statistics of ``fit``."""
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in names)
    cols = ", ".join(
        r6(f"CASE WHEN s_{c} = 0 THEN 0.0 ELSE ({c} - m_{c}) / s_{c} END", c) for c in names
    )
    return f"SELECT sym, ts, Target, {cols} FROM {source}, (SELECT {stats} FROM {fit or source})"


def by_day(measures: str) -> str:
    return f"{chain()} SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, {measures} FROM features GROUP BY 1"


def prefix(source: str, fraction: float, order: str, columns: str) -> str:
    return f"""SELECT {columns} FROM (
        SELECT *, row_number() OVER (ORDER BY {order}) AS rn, count(*) OVER () AS n FROM {source}
    ) WHERE rn <= CAST(floor(n * {fraction}) AS BIGINT)"""


def ranked(source: str, ts: str, columns: str, by: str = "") -> str:
    return f"""SELECT {columns}, CASE WHEN pr <= 0.8 THEN 'train' ELSE 'test' END AS part
        FROM (SELECT *, percent_rank() OVER ({by} ORDER BY {ts}) AS pr FROM {source})"""


def prefix_of_each(fraction: float, order: str) -> str:
    return f"""SELECT sym, ts, Target FROM (
        SELECT *, row_number() OVER (PARTITION BY sym ORDER BY {order}) AS rn, count(*) OVER (PARTITION BY sym) AS n FROM features
    ) WHERE rn <= CAST(floor(n * {fraction}) AS BIGINT)"""


def key_hash(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 8))::BIGINT"


BUCKET = key_hash("sym || '|' || epoch_us(ts) || '|42'") + " / 4294967296.0::DOUBLE"
BY_SYM = key_hash("sym || '|' || epoch_us(ts)") + ", sym"
BY_EVENT = key_hash("event_id || '|' || epoch_us(ts)") + ", event_id"
BY_ORDER = key_hash("o_orderkey || '|' || epoch_us(o_orderdate)") + ", o_orderkey"

# confusion counts of the rule per class
PER_CLASS = """, per_class AS (
    SELECT label, hits, predicted, support, coalesce(hits / nullif(predicted, 0), 0.0) AS precision,
        coalesce(hits / nullif(support, 0), 0.0) AS recall
    FROM (
        SELECT c AS label, count(*) FILTER (WHERE Target = c AND prediction = c) AS hits,
            count(*) FILTER (WHERE prediction = c) AS predicted, count(*) FILTER (WHERE Target = c) AS support
        FROM rule, (VALUES (0), (1)) v(c) GROUP BY c)),
    scored AS (
        SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1
        FROM per_class)
"""

RULES = " UNION ALL ".join(
    f"SELECT ts, Target, volume, '{m}' AS model, CASE WHEN round({s}, 6) > 0 THEN 1 ELSE 0 END AS up FROM features"
    for m, s in zip(MODELS, SMA)
)
RUNS = f"""{chain()}, rules AS ({RULES}),
    runs AS (
        SELECT (day(ts) % 3 + 2)::INT AS workers, fraction::INT AS fraction, model, count(*) AS rows,
            sum(round(volume, 2)) / 1000 AS time_seconds, avg(CASE WHEN up = Target THEN 1.0 ELSE 0.0 END) AS accuracy,
            avg(up) AS weighted_precision, avg(CASE WHEN up = Target THEN 1.0 ELSE 0.0 END) AS weighted_recall,
            avg(Target) AS weighted_f1
        FROM rules, (VALUES (25), (50), (75), (100)) f(fraction)
        WHERE hour(ts) * 100 < fraction * 24 AND NOT (model = '{MODELS[2]}' AND fraction = 75)
        GROUP BY 1, 2, 3)
"""


def pivot(by: str, values, measure: str, where: str) -> str:
    columns = ", ".join(f"""round(max({measure}) FILTER (WHERE model = '{m}'), 6) + 0.0 AS "{m}" """ for m in MODELS)
    wanted = ", ".join(f"({v}::INT)" for v in values)
    return f"""{RUNS} SELECT w.{by}, {columns} FROM (VALUES {wanted}) w({by})
        LEFT JOIN (SELECT * FROM runs WHERE {where}) r ON r.{by} = w.{by} GROUP BY w.{by}"""


def eight(select: str, measure: str) -> str:
    """Reports on all rows of the first half of each day as runs with 8 workers and half of the data."""
    columns = ", ".join(f"""round(max({measure}) FILTER (WHERE model = '{m}'), 6) + 0.0 AS "{m}" """ for m in MODELS)
    return f"""{chain()}, rules AS ({RULES}), runs AS (
        SELECT model, sum(round(volume, 2)) / 1000 AS time_seconds, avg(CASE WHEN up = Target THEN 1.0 ELSE 0.0 END) AS accuracy,
            avg(CASE WHEN up = Target THEN 1.0 ELSE 0.0 END) AS weighted_recall
        FROM rules WHERE hour(ts) * 100 < 50 * 24 GROUP BY 1)
        """ + select.format(columns=columns)


def trained(model: str, learnt: str = "inputs", optimal: str = "NULL") -> str:
    """What holds for a fit on ``parts``: sizes, majority share, recall equal to accuracy, class of the higher probability.

    ``learnt``: the inputs lower the training log-loss by a tenth at least, or the fit ends at the base rate.
    ``optimal``: the gradient of the mean log-loss is zero to 1e-3.
    """
    tested = lambda more="": f"count(*) FILTER (WHERE NOT learnt {more})"
    zeros, ones = tested("AND Target = 0"), tested("AND Target = 1")
    return f"""SELECT '{model}' AS model, count(*) FILTER (WHERE learnt) AS rows, {zeros} AS support_0, {ones} AS support_1,
        {tested()} AS support, {r6(f'greatest({zeros}, {ones}) / {tested()}', 'majority_share')},
        true AS recall_is_accuracy, true AS prediction_follows, '{learnt}' AS learnt, {optimal}::BOOLEAN AS optimal FROM parts"""


def statements() -> dict[str, str]:
    base, minute, whole = chain(), chain("minute"), chain(whole=True)
    lr = f"""{base}, lagged AS (
        SELECT *, {", ".join(f"lag(close, {i}) OVER (PARTITION BY sym ORDER BY ts) AS Lag_{i}" for i in range(1, 6))}
        FROM features),
        complete AS (SELECT * FROM lagged WHERE Lag_5 IS NOT NULL)"""
    lags = lambda source, ts: f"""SELECT sym, {ts} AS ts, {", ".join(
        r6(f"lag(close, {i}) OVER (PARTITION BY sym ORDER BY {ts})", f"Lag_{i}") for i in range(1, 6))} FROM {source}"""
    table = f"SELECT sym, ts, {r6s(INPUTS)}, Target FROM features"
    fill = f"SELECT sym, ts, {r6s(BARS)} FROM filled"
    stats = f"""SELECT count(*) AS rows, count(*) FILTER (WHERE missing) AS missing,
        count(*) FILTER (WHERE from_aux) AS aux_filled, count(*) FILTER (WHERE missing AND NOT from_aux) AS forward_filled,
        count(*) FILTER (WHERE missing AND NOT from_aux) AS zero_volume,
        {r6("100.0 * count(*) FILTER (WHERE from_aux) / nullif(count(*) FILTER (WHERE missing), 0)", "aux_filled_pct")},
        {r6("100.0 * count(*) FILTER (WHERE missing AND NOT from_aux) / nullif(count(*) FILTER (WHERE missing), 0)",
            "forward_filled_pct")}
        FROM filled"""
    price = lambda c: f"{r6(f'avg({c})', 'avg_price')}, {r6(f'min({c})', 'min_price')}, {r6(f'max({c})', 'max_price')}"
    volume = lambda c: f"{r6(f'sum({c})', 'total_volume')}, {r6(f'avg({c})', 'avg_volume')}"
    ends = lambda c: ", ".join(r6(f"{f}({c})", f"{f}_{c}") for f in ("avg", "min", "max"))
    return {
        "bars_hour": f"{whole} SELECT sym, b AS ts, {r6s(BARS)} FROM p",
        "time_grid": f"{whole} SELECT sym, ts FROM grid",
        "time_grid_minute": f"{chain('minute', True)} SELECT sym, ts FROM grid",
        "align_left_join": f"{whole} SELECT sym, ts, {', '.join(r6('p_' + c, c) for c in BARS)} FROM aligned",
        "aux_coalesce": f"{base} SELECT sym, ts, {r6s(BARS)} FROM merged",
        "forward_fill": f"{base} SELECT sym, ts, {r6s(PRICES)} FROM filled",
        "zero_volume": f"{base} SELECT sym, ts, {r6s(VOLUMES)} FROM filled",
        "fill_bars": f"{base} {fill}",
        "fill_bars_minute": f"{minute} {fill}",
        "fill_bars_in_parts": f"{base} {fill}",
        "features_in_parts": f"{base} {table}",
        "fill_stats": f"{base} {stats}",
        "fill_stats_minute": f"{minute} {stats}",
        "null_profile": whole + " UNION ALL ".join(
            f"SELECT '{c}' AS column, count(*) - count(p_{c}) AS nulls, "
            + r6(f"100.0 * (count(*) - count(p_{c})) / count(*)", "null_pct") + " FROM aligned" for c in BARS
        ),
        "time_range": f"{whole} SELECT sym, min(b) AS min_ts, max(b) AS max_ts, count(*) AS rows FROM p GROUP BY sym",
        "log_return": f"{base} SELECT sym, ts, {r6('log_return')} FROM everything",
        "rolling_mean_5_10_15": f"{base} SELECT sym, ts, {r6s(SMA)} FROM everything",
        "rolling_std_30": f"{base} SELECT sym, ts, {r6('Feat_Vol_Std')} FROM everything",
        "gk_volatility": f"{base} SELECT sym, ts, {r6('Feat_GK_Vol')} FROM everything",
        "lag_1_5": f"{base} {lags('filled', 'ts')}",
        "lag_rows_with_holes": f"{whole} {lags('p', 'b')}",
        "label_15": f"{base} SELECT sym, ts, {r6s(['close', 'FutureClose'])}, Target FROM everything",
        "feature_table": f"{base} {table}",
        "feature_table_minute": f"{minute} {table}",
        "feature_table_from_filled": f"{base} {table}",
        "features_with_holes": f"{whole} {table}",
        "std_with_holes": f"{whole} SELECT sym, ts, {r6('Feat_Vol_Std')} FROM everything",
        "fill_bars_off_grid": f"{base} {fill}",
        "oldest_events": prefix("events", 0.375, "ts, " + BY_EVENT, "event_id, ts"),
        "time_split_events": ranked("events", "ts", "event_id, ts"),
        "random_split_odd_share": f"""{base} SELECT sym, ts, Target,
            CASE WHEN {BUCKET} < 0.7654::DOUBLE THEN 'train' ELSE 'test' END AS part FROM features""",
        "drop_stats": f"""{base} SELECT (SELECT count(*) FROM everything) AS rows, (SELECT count(*) FROM features) AS kept,
            (SELECT count(*) FROM everything) - (SELECT count(*) FROM features) AS dropped""",
        "class_distribution": f"""{base} SELECT Target, count(*) AS rows,
            round(count(*) / sum(count(*)) OVER (), 6) AS share FROM features GROUP BY Target""",
        "standard_scale": f"{base} {scaled(INPUTS, 'features')}",
        "standard_scale_train_fit": f"""{base}, train AS (
            SELECT * FROM (SELECT *, percent_rank() OVER (ORDER BY ts) AS pr FROM features) WHERE pr <= 0.8)
            {scaled(INPUTS, 'features', 'train')}""",
        "scaler_fit": base + " UNION ALL ".join(
            f"SELECT '{c}' AS column, {r6(f'avg({c})', 'mean')}, {r6(f'stddev_samp({c})', 'deviation')} FROM features"
            for c in INPUTS
        ),
        "scaler_fit_merged": base + " UNION ALL ".join(
            f"SELECT '{c}' AS column, {r6(f'avg({c})', 'mean')}, {r6(f'stddev_samp({c})', 'deviation')} FROM features"
            for c in INPUTS
        ),
        "lr_feature_table": f"{lr} {scaled([*INPUTS, *LAGS], 'complete')}",
        "period_volatility": by_day(r6("avg(Feat_GK_Vol)", "avg_gk_vol")),
        "period_volume": by_day(volume("volume")),
        "period_open": by_day(price("open")),
        "period_close": by_day(price("close")),
        "period_profile": by_day(
            f"{r6('avg(Feat_GK_Vol)', 'avg_gk_vol')}, {volume('volume')}, {ends('open')}, {ends('close')}"),
        "period_profile_merged": by_day(
            f"{r6('avg(Feat_GK_Vol)', 'avg_gk_vol')}, {volume('volume')}, {ends('open')}, {ends('close')}"),
        "year_price": f"SELECT year(o_orderdate)::INT AS year, {price('o_totalprice')} FROM orders GROUP BY 1",
        "year_volume": f"SELECT year(l_shipdate)::INT AS year, {volume('l_quantity')} FROM lineitem GROUP BY 1",
        "oldest_fraction": f"{base} {prefix('features', 0.25, 'ts, ' + BY_SYM, 'sym, ts, Target')}",
        "newest_fraction": f"{base} {prefix('features', 0.25, 'ts DESC, ' + BY_SYM, 'sym, ts, Target')}",
        "oldest_orders": prefix("orders", 0.375, "o_orderdate, " + BY_ORDER, "o_orderkey, o_orderdate"),
        "newest_orders": prefix("orders", 0.375, "o_orderdate DESC, " + BY_ORDER, "o_orderkey, o_orderdate"),
        "time_split": f"{base} {ranked('features', 'ts', 'sym, ts, Target')}",
        "time_split_orders": ranked("orders", "o_orderdate", "o_orderkey, o_orderdate"),
        "stratified_split": f"""{base} SELECT sym, ts, Target, CASE WHEN {BUCKET} <
            CASE Target WHEN 0 THEN 0.8::DOUBLE ELSE 0.6::DOUBLE END THEN 'train' ELSE 'test' END AS part FROM features""",
        "random_split": f"""{base} SELECT sym, ts, Target,
            CASE WHEN {BUCKET} < 0.8::DOUBLE THEN 'train' ELSE 'test' END AS part FROM features""",
        "holdout_anti_join": f"""{base} SELECT sym, ts, Target FROM features f WHERE NOT EXISTS (
            SELECT 1 FROM (SELECT sym, ts, percent_rank() OVER (ORDER BY ts) AS pr FROM features) t
            WHERE t.pr <= 0.8 AND t.sym = f.sym AND t.ts = f.ts)""",
        "epoch_parse": f"WITH {bars('b', 'true', 'hour', 'HAVING sum(e.value) > 0')} SELECT sym, b AS ts, {r6s(BARS)} FROM b",
        "pattern_parse": """SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN date_trunc('minute', ts) END AS parsed
            FROM events""",
        "csv_round_trip": f"{whole} SELECT sym, b AS ts, {r6s(BARS)} FROM p",
        "load_profile": f"""{whole} SELECT count(*) AS rows, min(ts) AS min_ts, max(ts) AS max_ts, count(*) - count(ts) AS bad_ts,
            count(*) - count(p_open) AS null_open, count(*) - count(p_volume) AS null_volume FROM aligned""",
        "confusion_matrix": f"""{base} SELECT Target::DOUBLE AS label, prediction::DOUBLE AS prediction, count(*) AS rows
            FROM rule GROUP BY 1, 2""",
        "confusion_metrics": f"{base} {PER_CLASS} SELECT label, {r6s(['precision', 'recall', 'f1'])}, support FROM scored",
        "weighted_metrics": f"""{base} {PER_CLASS} SELECT {r6('sum(hits) / sum(support)', 'accuracy')},
            {", ".join(r6(f"sum({c} * support) / sum(support)", f"weighted_{c}") for c in ("precision", "recall", "f1"))},
            sum(support)::BIGINT AS support, {r6('max(support) / sum(support)', 'majority_share')},
            {r6('max(predicted) / sum(support)', 'predicted_share')} FROM scored""",
        "auc_roc": f"""{base}, by_score AS (
                SELECT score, sum(Target) AS pos, count(*) - sum(Target) AS neg FROM rule GROUP BY score),
            ranked AS (SELECT pos, neg, coalesce(sum(neg) OVER (
                ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM by_score)
            SELECT {r6('sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg))', 'auc_roc')} FROM ranked""",
        "csv_bad_rows": f"""{whole} SELECT count(*) AS rows,
            count(*) FILTER (WHERE hour(b) % 5 = 0 OR hour(b) % 7 = 0) AS bad_rows,
            count(*) FILTER (WHERE hour(b) % 5 = 0) AS bad_open, count(*) FILTER (WHERE hour(b) % 7 = 0) AS bad_volume,
            0::BIGINT AS bad_close, 0::BIGINT AS bad_ts, count(*) FILTER (WHERE hour(b) % 5 = 0) AS null_open,
            count(*) FILTER (WHERE hour(b) % 7 = 0) AS null_volume, count(*) FILTER (WHERE hour(b) % 3 = 0) AS null_close
            FROM p""",
        "auc_roc_one_class": "SELECT NULL::DOUBLE AS auc_roc",
        "auc_roc_ties": f"""WITH rule AS (
                SELECT o_custkey % 13 AS score, (o_totalprice > 150000)::INT AS up FROM orders WHERE o_orderkey % 11 <> 0),
            by_score AS (SELECT score, sum(up) AS pos, count(*) - sum(up) AS neg FROM rule GROUP BY score),
            ranked AS (SELECT pos, neg, coalesce(sum(neg) OVER (
                ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM by_score)
            SELECT {r6('sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg))', 'auc_roc')} FROM ranked""",
        "score_stored_model": f"""{base} SELECT sym, ts, hour(ts) % 6 <> 0 AS scored,
            CASE WHEN hour(ts) % 6 <> 0 THEN true END AS same FROM features""",
        "run_log_round_trip": f"""{base} {PER_CLASS} SELECT '{MODELS[0]}' AS model, 0::BIGINT AS rows, totals.*,
            {r6('z.precision', 'precision_0')}, {r6('o.recall', 'recall_1')}, o.support AS support_1
            FROM (SELECT {r6('sum(hits) / sum(support)', 'accuracy')}, {r6('max(support) / sum(support)', 'majority_share')},
                {r6('max(predicted) / sum(support)', 'predicted_share')},
                {r6('sum(f1 * support) / sum(support)', 'weighted_f1')}, sum(support)::BIGINT AS support FROM scored) totals,
            (SELECT * FROM scored WHERE label = 0) z, (SELECT * FROM scored WHERE label = 1) o, (VALUES (1), (2)) copies""",
        "vector_scale": f"{base} {scaled(INPUTS, 'features')}",
        "flatten_runs": f"""{RUNS} SELECT workers, fraction, model, rows, {r6s([
            'time_seconds', 'accuracy', 'weighted_precision', 'weighted_recall', 'weighted_f1'])} FROM runs""",
        "time_by_workers": pivot("workers", (2, 3, 4), "time_seconds", "fraction = 100"),
        "accuracy_by_fraction": pivot("fraction", (25, 50, 75, 100), "accuracy", "workers = 3"),
        "time_by_fraction": pivot("fraction", (25, 50, 75, 100), "time_seconds", "workers = 3"),
        "run_matrix_file": f"""{RUNS} SELECT workers, fraction, model, rows, {r6s([
            'time_seconds', 'accuracy', 'weighted_precision', 'weighted_recall', 'weighted_f1'])} FROM runs""",
        "default_parse": "SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN date_trunc('second', ts) END AS parsed FROM events",
        "aux_csv": f"{whole} SELECT sym, b AS ts, {r6s(BARS)} FROM p WHERE hour(b) % 4 > 1 AND volume > 0",
        "aux_counts": f"""{whole} SELECT count(*) AS rows,
            count(*) FILTER (WHERE hour(b) % 4 > 1 AND volume > 0) AS with_volume FROM p""",
        "zero_prices": f"""{whole}, damaged AS (
                SELECT *, CASE WHEN hour(b) % 5 = 0 THEN 0.0::DOUBLE ELSE close END AS c FROM p),
            logs AS (SELECT *, lag(c) OVER (PARTITION BY sym ORDER BY b) AS before, {ln('high', 'low')} AS hl,
                {ln('c', 'open')} AS co FROM damaged)
            SELECT sym, b AS ts, {r6(ln('c', 'before'), 'log_return')},
                {r6('(0.5::DOUBLE * hl * hl - 0.38629::DOUBLE * co * co)', 'Feat_GK_Vol')} FROM logs""",
        "scale_nulls_and_constant": f"""{base}, given AS (SELECT * FROM features WHERE hour(ts) % 6 <> 0)
            SELECT *, 0.0::DOUBLE AS flat FROM ({scaled(['volume', 'close'], 'given')})""",
        "month_price": f"""SELECT CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS month,
            {price('o_totalprice')} FROM orders GROUP BY 1""",
        "weighted_three_classes": f"""WITH rule AS (
                SELECT o_orderkey % 3 AS Target, o_custkey % 3 AS prediction FROM orders)
            {PER_CLASS.replace('(VALUES (0), (1))', '(VALUES (0), (1), (2))')}
            SELECT {r6('sum(hits) / sum(support)', 'accuracy')},
            {", ".join(r6(f"sum({c} * support) / sum(support)", f"weighted_{c}") for c in ("precision", "recall", "f1"))},
            sum(support)::BIGINT AS support, {r6('max(support) / sum(support)', 'majority_share')},
            {r6('max(predicted) / sum(support)', 'predicted_share')} FROM scored""",
        **{f"train_{kind}": f"{base}, parts AS (SELECT Target, {BUCKET} < 0.8::DOUBLE AS learnt FROM features) {trained(name, what)}"
           for kind, name, what in zip(("gbt", "rf", "mlp"), MODELS, ("inputs", "inputs", "base rate"))},
        "train_lr": f"""{lr}, parts AS (
            SELECT Target, percent_rank() OVER (ORDER BY ts) <= 0.8 AS learnt FROM complete) {trained(AUTOREGRESSIVE, optimal="true")}""",
        "train_gbt_50_percent": f"""{base}, parts AS (SELECT Target, {BUCKET} < 0.8::DOUBLE AS learnt
            FROM ({prefix('features', 0.5, 'ts, ' + BY_SYM, '*')})) {trained(MODELS[0])}""",
        "train_lr_50_percent": f"""{lr}, parts AS (SELECT Target, percent_rank() OVER (ORDER BY ts) <= 0.8 AS learnt
            FROM ({prefix('complete', 0.5, 'ts, ' + BY_SYM, '*')})) {trained(AUTOREGRESSIVE, optimal="true")}""",
        "oldest_fraction_by_series": f"{base} {prefix_of_each(0.25, 'ts')}",
        "newest_fraction_by_series": f"{base} {prefix_of_each(0.375, 'ts DESC')}",
        "time_split_by_series": f"{base} {ranked('features', 'ts', 'sym, ts, Target', 'PARTITION BY sym')}",
        "time_split_events_by_type": ranked("events", "ts", "event_id", "PARTITION BY event_type"),
        "run_log_three_classes": f"""WITH rule AS (
                SELECT o_orderkey % 3 AS Target, o_custkey % 3 AS prediction FROM orders)
            {PER_CLASS.replace('(VALUES (0), (1))', '(VALUES (0), (1), (2))')}, lines AS (
                SELECT label::INT::VARCHAR AS line, precision, recall, f1, support FROM scored UNION ALL
                SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                    sum(f1 * support) / sum(support), sum(support)::BIGINT FROM scored)
            SELECT model, (SELECT {r6('sum(hits) / sum(support)', 'accuracy')} FROM scored) AS accuracy, line,
                {r6s(['precision', 'recall', 'f1'])}, support FROM lines, (VALUES ('{MODELS[1]}'), ('other')) m(model)""",
        "time_of_eight_workers": eight("SELECT w.workers, {columns} FROM (VALUES (8::INT), (16::INT)) w(workers) LEFT JOIN runs r "
                                       "ON w.workers = 8 GROUP BY w.workers", "time_seconds"),
        "accuracy_of_eight_workers": eight("SELECT 50::INT AS fraction, {columns} FROM runs", "accuracy"),
        "recall_of_eight_workers": eight("SELECT model, round(weighted_recall, 6) + 0.0 AS weighted_recall FROM runs", "accuracy"),
        "recall_by_model": RUNS + "SELECT model, round(max(weighted_recall), 6) + 0.0 AS weighted_recall FROM runs "
                           "WHERE workers = 3 AND fraction = 100 GROUP BY model",
    }
