"""The forecast models as plain SQL: normal equations as sums, solved by elimination in a recursive table.

Written from the model's definition, not from its code: trend ``1, t, max(t - knot, 0)``, waves as sines and cosines of the day
number, the promotion rate in standard units, ridge penalties per column, and the multiplicative model by turns of two
linear ones. Series of the given tables are all long enough for a fit.
"""

from __future__ import annotations

WEEK = [(7.0, k) for k in (1, 2, 3)]
MONTH = [(30.5, k) for k in (1, 2, 3, 4, 5)]
DOT = "list_sum(list_transform({a}, lambda v, i: v * {b}[i]))"


def dot(a: str, b: str) -> str:
    return DOT.format(a=a, b=b)


def times(vector: str, factor: str) -> str:
    return f"list_transform({vector}, lambda v: v * {factor})"


def solve(name: str, rows: str, x: str, target: str, penalty: str) -> str:
    """Tables ending in ``name`` (category, c): the ridge solution of ``target`` on the list ``x`` over known ``rows``.
    ``penalty`` is that of column ``i``, from 1; it may use ``nk``, the number of knots."""
    return f"""{name}_z AS (SELECT category, nk, list_append({x}, {target}) AS z FROM {rows} WHERE known),
{name}_e AS (
  SELECT category, i, j, sum(z[i] * z[j]) + CASE WHEN i = j THEN any_value({penalty}) + 1e-9 ELSE 0 END AS v
  FROM {name}_z, (SELECT unnest(range(1, 60)) AS i), (SELECT unnest(range(1, 60)) AS j)
  WHERE i < len(z) AND j <= len(z) GROUP BY category, i, j),
{name}_m AS (
  SELECT category, list(r ORDER BY i) AS m FROM (SELECT category, i, list(v ORDER BY j) AS r FROM {name}_e GROUP BY category, i)
  GROUP BY category),
{name}_g AS (
  SELECT category, 1 AS k, m FROM {name}_m
  UNION ALL
  SELECT category, k + 1, list_transform(m, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda v: v / r[k])
    ELSE list_transform(r, lambda v, j: v - r[k] * m[k][j] / m[k][k]) END)
  FROM {name}_g WHERE k <= len(m)),
{name} AS (SELECT category, list_transform(m, lambda r: r[len(r)]) AS c FROM {name}_g WHERE k = len(m) + 1)"""


def features(name: str, frames: str, seasons: list[tuple[float, int]], promo: bool) -> str:
    """``name``: frames (category, ds, y, promo_rate, known) with their trend ``g``, other columns ``b`` and scaled ``target``."""
    waves = ", ".join(f"{f}(2 * pi() * {k} * day / {p}::DOUBLE)" for p, k in seasons for f in ("sin", "cos"))
    extra = f"[{waves}]"
    if promo:
        extra = f"CASE WHEN spread > 0 THEN list_append({extra}, (promo_rate - centre) / spread) ELSE {extra} END"
    return f"""{name}_d AS (SELECT *, CAST(ds - DATE '1970-01-01' AS DOUBLE) AS day FROM {frames}),
{name}_s AS (
  SELECT category, min(day) FILTER (known) AS d0, max(day) FILTER (known) AS d1, greatest(max(abs(y)) FILTER (known), 1) AS scale,
         avg(promo_rate) FILTER (known) AS centre, stddev_pop(promo_rate) FILTER (known) AS spread,
         least(25, greatest(0, CAST(floor(count(*) FILTER (known) * 0.8::DOUBLE) AS INTEGER) - 1)) AS nk
  FROM {name}_d GROUP BY category),
{name} AS (
  SELECT *, list_concat([1::DOUBLE, t], list_transform(range(1, nk + 1), lambda k: greatest(t - 0.8::DOUBLE * k / nk, 0))) AS g,
         {extra} AS b, y / scale AS target
  FROM (SELECT *, (day - d0) / greatest(d1 - d0, 1) AS t FROM {name}_d JOIN {name}_s USING (category)))"""


TREND_PENALTY, OTHER_PENALTY = "CASE WHEN i <= 2 THEN 0 ELSE 1 END", "0.01::DOUBLE"


def multiplicative(name: str, frames: str, promo: bool) -> str:
    """``name`` (category, ds, y, yhat) of the rows not known."""
    parts = [features(f"{name}_f", frames, WEEK + MONTH, promo),
             solve(f"{name}_w0", f"{name}_f", "g", "target", TREND_PENALTY),
             f"{name}_r0 AS (SELECT f.*, {dot('g', 'c')} AS level FROM {name}_f f JOIN {name}_w0 USING (category))"]
    for k in range(1, 5):
        before = f"{name}_r{k - 1}"
        parts += [solve(f"{name}_c{k}", before, times("b", "greatest(level, 0.01)"), "target - level", OTHER_PENALTY),
                  f"{name}_q{k} AS (SELECT r.* EXCLUDE (level), 1 + {dot('b', 'c')} AS factor FROM {before} r JOIN {name}_c{k} USING (category))",
                  solve(f"{name}_w{k}", f"{name}_q{k}", times("g", "factor"), "target", TREND_PENALTY),
                  f"{name}_r{k} AS (SELECT q.* EXCLUDE (factor), factor, {dot('g', 'c')} AS level FROM {name}_q{k} q JOIN {name}_w{k} USING (category))"]
        if k < 4:
            parts[-1] = parts[-1].replace("EXCLUDE (factor), factor,", "EXCLUDE (factor),")
    parts.append(f"{name} AS (SELECT category, ds, y, greatest(level * factor * scale, 0) AS yhat FROM {name}_r4 WHERE NOT known)")
    return ",\n".join(parts)


def additive(name: str, frames: str) -> str:
    """``name`` (category, ds, yhat, yhat_lower, yhat_upper, y, kind) of all rows."""
    z80 = "1.2815515655446004::DOUBLE"
    return ",\n".join([
        features(f"{name}_f", frames, WEEK, False),
        solve(f"{name}_w", f"{name}_f", "list_concat(g, b)", "target",
              "CASE WHEN i <= 2 THEN 0 WHEN i <= nk + 2 THEN 1 ELSE 0.01::DOUBLE END"),
        f"""{name}_r AS (
  SELECT f.*, {dot('list_concat(g, b)', 'c')} AS fitted,
         list_avg(list_transform(c[3:nk + 2], lambda v: abs(v))) * sqrt(greatest(nk, 1) / 0.8::DOUBLE) * pow(greatest(t - 1, 0), 1.5::DOUBLE) AS drift
  FROM {name}_f f JOIN {name}_w USING (category)),
{name}_v AS (SELECT category, stddev_pop(target - fitted) FILTER (known) AS sigma FROM {name}_r GROUP BY category),
{name}_h AS (SELECT *, {z80} * sqrt(sigma * sigma + drift * drift) AS half FROM {name}_r JOIN {name}_v USING (category)),
{name} AS (
  SELECT category, ds, round_even(fitted * scale, 1) AS yhat, round_even((fitted - half) * scale, 1) AS yhat_lower,
         round_even((fitted + half) * scale, 1) AS yhat_upper, y, CASE WHEN known THEN 'history' ELSE 'forecast' END AS kind
  FROM {name}_h)"""])


EVALUATED = f"""marked AS (
  SELECT category, ds, CAST(units AS DOUBLE) AS y, COALESCE(promo_rate, 0) AS promo_rate,
         row_number() OVER (PARTITION BY category ORDER BY ds DESC) > 30 AS known
  FROM dense LEFT JOIN campaign USING (ds)),
{multiplicative("plain", "marked", False)},
{multiplicative("promoted", "marked", True)},
trials AS (
  SELECT 'naive' AS model, category, ds, CAST(y AS DOUBLE) AS y, yhat FROM naive
  UNION ALL SELECT 'model', * FROM plain UNION ALL SELECT 'model_promo', * FROM promoted)"""

TRIAL_ERRORS = """trial_errors AS (
  SELECT model, category, avg(abs(y - yhat)) AS mae, sqrt(avg(pow(y - yhat, 2))) AS rmse,
         avg(CASE WHEN y <> 0 THEN abs(y - yhat) / abs(y) END) * 100 AS mape FROM trials GROUP BY ALL)"""

COMPARED = """compared AS (
  SELECT category, round_even(max(mae) FILTER (model = 'naive'), 1) AS mae_naive,
         round_even(max(mae) FILTER (model = 'model'), 1) AS mae_model,
         round_even(max(mae) FILTER (model = 'model_promo'), 1) AS mae_model_promo FROM trial_errors GROUP BY category),
comparison AS (
  SELECT * FROM compared
  UNION ALL SELECT 'MEAN', round_even(avg(mae_naive), 1), round_even(avg(mae_model), 1), round_even(avg(mae_model_promo), 1) FROM compared)"""

PUBLISHED = f"""frames AS (
  SELECT category, ds, CAST(units AS DOUBLE) AS y, 0::DOUBLE AS promo_rate, true AS known FROM demand
  UNION ALL
  SELECT category, CAST(last + CAST(ahead AS INTEGER) AS DATE), NULL, 0, false
  FROM (SELECT category, max(ds) AS last FROM demand GROUP BY category), (SELECT unnest(range(1, 31)) AS ahead)),
{additive("published", "frames")}"""


def queries(dense: str, campaign: str, stock_rows: str) -> dict[str, str]:
    """SQL of the forecast queries. ``dense``: WITH tables up to ``demand``, ``dense``, ``naive`` and ``products``;
    ``campaign``: the tables of promotion days; ``stock_rows``: the cover of products by a table ``d`` and ``ahead``."""
    base = dense.rstrip().replace("WITH ", "WITH RECURSIVE ", 1)
    trials = f"{base},\n{campaign},\n{EVALUATED}"
    compared = f"{trials},\n{TRIAL_ERRORS},\n{COMPARED}"
    published = f"{base},\n{PUBLISHED}"
    return {
        "model_forecast": trials + "\nSELECT model, category, ds, y, round(yhat, 4) AS yhat FROM trials",
        "forecast_comparison": compared + "\nSELECT * FROM comparison",
        "forecast_experiments": f"{trials},\n{TRIAL_ERRORS}" + """
SELECT model, CAST(30 AS INTEGER) AS horizon_days, count(*) AS series, round_even(avg(mae), 2) AS mae, round_even(avg(rmse), 2) AS rmse,
       round_even(avg(mape), 2) AS mape FROM trial_errors GROUP BY model""",
        "published_forecast": published + "\nSELECT * FROM published",
        "forecast_view": published + "\nSELECT * FROM published",
        "stock_cover_forecast": published + f""",
ahead AS (SELECT category, ds, yhat FROM published WHERE kind = 'forecast'),
{stock_rows}""",
    }
