"""The same results as plain SQL, for comparison."""

from __future__ import annotations

from plumbline import names
from plumbline.catalog.panels import EVENT_FEATURES, FEATURES

PANEL = """
panel AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS ticker,
         CAST(date_trunc('quarter', l_shipdate) AS DATE) AS report_date,
         round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue,
         round(sum(l_discount), 2) / CAST(count(*) AS DOUBLE) AS discount,
         round(sum(l_tax), 2) / CAST(count(*) AS DOUBLE) AS tax,
         round(sum(l_quantity), 2) / CAST(count(*) AS DOUBLE) AS quantity,
         CAST(count(*) AS DOUBLE) AS n_lines
  FROM lineitem GROUP BY 1, 2)"""

_PLACE = "(CAST(ticker AS BIGINT) + quarter(report_date) + year(report_date))"
SPARSE = PANEL + f""",
sparse AS (
  SELECT ticker, report_date,
         CASE WHEN {_PLACE} % 7 <> 0 THEN revenue END AS revenue,
         CASE WHEN {_PLACE} % 5 <> 0 THEN discount END AS discount,
         CASE WHEN {_PLACE} % 3 <> 0 THEN tax END AS tax,
         quantity, n_lines
  FROM panel)"""

EVENTS = """
event_panel AS (
  SELECT CAST(user_id AS VARCHAR) AS ticker,
         strftime(date_trunc('week', ts), '%Y-%m-%d') AS report_date,
         round(sum(value), 2) AS value_sum, max(value) AS value_max,
         round(sum(value), 2) / CAST(count(*) AS DOUBLE) AS value_mean,
         min(value) AS value_min
  FROM events GROUP BY 1, 2)"""


def r6(value, alias):
    """Six decimals; adding zero turns a rounded -0.0 into 0.0, as Spark's rounding does."""
    return f"round({value}, 6) + 0.0 AS {alias}"


def r3(value, alias):
    """Three decimals, for distances of half a million: sums in another order move their tenth decimal,
    and one of the planted rows lies on an edge of the sixth."""
    return f"round({value}, 3) + 0.0 AS {alias}"


def cols(parts):
    return ", ".join(parts)


def clipped(source, features, out="clipped"):
    """CTEs `<out>_bounds` and `<out>` with every feature limited to its 5th and 95th percentile."""
    bounds = cols(f"quantile_cont({f}, 0.05) AS lo_{f}, quantile_cont({f}, 0.95) AS hi_{f}"
                  for f in features)
    limited = cols(f"CASE WHEN {f} IS NOT NULL THEN greatest(least({f}, hi_{f}), lo_{f}) END AS {f}"
                   for f in features)
    return f"""
{out}_bounds AS (SELECT {bounds} FROM {source}),
{out} AS (SELECT ticker, report_date, {limited} FROM {source}, {out}_bounds)"""


def z_scored(source, by, features, prefix, out, extra=""):
    """CTEs with group quartiles and the robust z-score of every feature."""
    key = cols(by)
    stats = cols(f"count({f}) AS n_{f}, quantile_cont({f}, 0.25) AS q1_{f}, "
                 f"quantile_cont({f}, 0.5) AS q2_{f}, quantile_cont({f}, 0.75) AS q3_{f}"
                 for f in features)
    z = cols(f"""CASE WHEN n_{f} >= 2 THEN CASE WHEN q3_{f} - q1_{f} = 0 THEN 0.0
                 ELSE ({f} - q2_{f}) / ((q3_{f} - q1_{f}) / 1.35) END END AS {prefix}{f}"""
             for f in features)
    same = " AND ".join(f"g.{k} = s.{k}" for k in by)
    known = " AND ".join(f"{k} IS NOT NULL" for k in by)
    return f"""
{out}_groups AS (SELECT {key}, {stats} FROM {source} WHERE {known} GROUP BY {key}),
{out} AS (SELECT s.*, {z} FROM {source} s LEFT JOIN {out}_groups g ON {same})"""


def blended(source, features):
    """CTEs up to `blended`: self, peer and combined scores of a clipped source."""
    combined = cols(f"""CASE WHEN coalesce(self_z__{f}, peer_z__{f}) IS NOT NULL THEN greatest(least(
        coalesce((self_z__{f} + peer_z__{f}) / 2, self_z__{f}, peer_z__{f}), 8.0), -8.0)
        END AS combined_z__{f}""" for f in features)
    return (clipped(source, features) + ","
            + z_scored("clipped", ["ticker"], features, "self_z__", "with_self") + ","
            + z_scored("with_self", ["report_date"], features, "peer_z__", "with_peer")
            + f", blended AS (SELECT *, {combined} FROM with_peer)")


def mean_abs(prefix, features):
    total = " + ".join(f"coalesce(abs({prefix}{f}), 0)" for f in features)
    present = count_of(prefix, features)
    return f"CASE WHEN {present} > 0 THEN ({total}) / ({present}) END"


def count_of(prefix, features):
    return "(" + " + ".join(f"CAST({prefix}{f} IS NOT NULL AS INTEGER)" for f in features) + ")"


def driver_ctes(features):
    """CTE `slots`: up to three drivers per row, by |z| and feature position."""
    entries = " UNION ALL ".join(
        f"SELECT ticker, report_date, '{f}' AS name, {i} AS pos, combined_z__{f} AS z FROM blended"
        for i, f in enumerate(features))
    pick = cols(
        f"max(CASE WHEN rn = {i} THEN name END) AS top_driver_{i}, "
        f"max(CASE WHEN rn = {i} THEN round(z, 4) + 0.0 END) AS top_driver_{i}_value" for i in (1, 2, 3))
    return f""",
entries AS ({entries}),
placed AS (SELECT *, row_number() OVER (PARTITION BY ticker, report_date
           ORDER BY CASE WHEN z IS NULL THEN 1 ELSE 0 END, abs(z) DESC, pos) AS rn FROM entries),
picked AS (SELECT ticker, report_date, {pick} FROM placed WHERE z IS NOT NULL GROUP BY 1, 2),
slots AS (SELECT b.ticker, b.report_date, top_driver_1, top_driver_1_value, top_driver_2,
          top_driver_2_value, top_driver_3, top_driver_3_value
          FROM blended b LEFT JOIN picked USING (ticker, report_date))"""


def summary_text():
    parts = []
    for i in (1, 2, 3):
        v = f"top_driver_{i}_value"
        number = f"regexp_replace(CAST(CAST({v} AS DECIMAL(18,4)) AS VARCHAR), '(\\.\\d+?)0+$', '\\1')"
        parts.append(
            f"CASE WHEN top_driver_{i} IS NOT NULL AND {v} IS NOT NULL THEN top_driver_{i} || ': ' || "
            f"CASE WHEN abs({v}) >= 8 AND {v} > 0 THEN 'far above' WHEN abs({v}) >= 8 THEN 'far below' "
            f"WHEN {v} > 0 THEN 'above' ELSE 'below' END || ' baseline (' || {number} || ')' END")
    return f"concat_ws(' | ', {cols(parts)})"


def percentile(value, alias):
    return f"""CASE WHEN {value} IS NOT NULL THEN round(
        (rank() OVER (ORDER BY {value} NULLS LAST)
         + (count(*) OVER (PARTITION BY {value}) - 1) / CAST(2.0 AS DOUBLE))
        / CAST(count({value}) OVER () AS DOUBLE) * 100, 4) END AS {alias}"""


def scored_events():
    """CTE `scored`: the whole score table of the event panel with the sum-of-squares distance."""
    return EVENTS + "," + scored_by_squares("event_panel", EVENT_FEATURES)


def scored_by_squares(source, f):
    """CTEs up to `scored` from a panel: four features, holes at the median in the distance."""
    medians = cols(f"median({x}) AS m_{x}" for x in f)
    filled = cols(f"coalesce({x}, m_{x}) AS {x}" for x in f)
    return (blended(source, f) + driver_ctes(f) + f""",
filled AS (SELECT ticker, report_date, {filled} FROM clipped, (SELECT {medians} FROM clipped)),
measured AS (SELECT ticker, report_date,
    ({f[0]} * {f[0]} + {f[1]} * {f[1]}) + ({f[2]} * {f[2]} + {f[3]} * {f[3]}) AS d2 FROM filled),
ranked AS (SELECT *, {percentile('d2', 'anomaly_score_0_100')} FROM measured),
scored AS (
  SELECT b.ticker, '' AS company_name, '' AS cik, CAST(NULL AS VARCHAR) AS form_type, b.report_date,
    CAST(NULL AS VARCHAR) AS filing_date, CAST(NULL AS VARCHAR) AS filing_url, anomaly_score_0_100,
    {r6('d2', 'mahalanobis_distance')},
    {r6(mean_abs('self_z__', f), 'self_history_score')},
    {r6(mean_abs('peer_z__', f), 'peer_relative_score')},
    {r6(mean_abs('combined_z__', f), 'combined_signal_strength')},
    {count_of('combined_z__', f)} AS num_features_used,
    top_driver_1, top_driver_1_value, top_driver_2, top_driver_2_value, top_driver_3,
    top_driver_3_value, '{names.MODEL_TYPE_L2}' AS model_type,
    {cols(r6(f'{p}{x}', f'{p}{x}') for p in ('self_z__', 'peer_z__', 'combined_z__') for x in f)},
    '{names.SCORING_VERSION}' AS scoring_version
  FROM blended b JOIN slots USING (ticker, report_date) JOIN ranked USING (ticker, report_date))""")


def quantile_table():
    values = cols(
        f"count({f}) AS n_{f}, " + cols(
            r6(f"quantile_cont({f}, {p})", f"{q}_{f}")
            for q, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)))
        for f in FEATURES)
    return f"WITH {SPARSE} SELECT report_date, {values} FROM sparse GROUP BY report_date"


def z_query(source_ctes, source, by, prefix, keys="ticker, report_date"):
    z = cols(r6(f"{prefix}{f}", f"{prefix}{f}") for f in FEATURES)
    return (f"WITH {source_ctes}, {z_scored(source, by, FEATURES, prefix, 'scored')} "
            f"SELECT {keys}, {z} FROM scored")


def all_r6(features):
    return cols(r6(f, f) for f in features)


SECTORS = PANEL + """,
sectored AS (SELECT p.*, CASE WHEN s_nationkey < 20 THEN CAST(s_nationkey AS VARCHAR) END AS sector,
    CAST(year(report_date) AS VARCHAR) || 'Q' || CAST(quarter(report_date) AS VARCHAR)
      AS calendar_quarter
  FROM panel p LEFT JOIN supplier ON CAST(s_suppkey AS VARCHAR) = ticker)"""

MEDIANS = SPARSE + f""",
medians AS (SELECT {cols(f'median({f}) AS m_{f}' for f in FEATURES)} FROM sparse),
filled AS (SELECT ticker, report_date, {cols(f'coalesce({f}, m_{f}) AS {f}' for f in FEATURES)}
           FROM sparse, medians)"""

# Full support makes the first fit the plain mean and covariance of all rows; two features make the
# inverse and the chi-square quantiles (-2 ln(1 - q)) closed forms.
_D2 = """((x - mx) * (x - mx) * vy - 2 * (x - mx) * (y - my) * cxy + (y - my) * (y - my) * vx)
         / (vx * vy - cxy * cxy)"""
_MOMENTS = """avg(x) AS mx, avg(y) AS my, var_pop(x) AS vx, var_pop(y) AS vy,
              covar_pop(x, y) AS cxy"""
def full_support(source):
    """CTEs up to `distances`: the robust distance of quantity and tax."""
    return f"""
xy AS (SELECT ticker, report_date, quantity AS x, tax AS y FROM {source}),
raw_fit AS (SELECT {_MOMENTS} FROM xy),
raw AS (SELECT ticker, report_date, x, y, {_D2} AS d2 FROM xy, raw_fit),
factor AS (SELECT median(d2) / (-2 * ln(0.5)) AS f FROM raw),
kept AS (SELECT x, y FROM raw, factor WHERE d2 < f * (-2 * ln(0.025))),
fit AS (SELECT {_MOMENTS} FROM kept),
distances AS (SELECT ticker, report_date, {_D2} AS d2 FROM xy, fit)"""


def full_support_scores():
    f = ["quantity", "tax"]
    return (f"WITH {PANEL}, {blended('panel', f)} {driver_ctes(f)}, {full_support('clipped')}, "
            f"ranked AS (SELECT *, {percentile('d2', 'anomaly_score_0_100')} FROM distances) "
            "SELECT b.ticker, strftime(b.report_date, '%Y-%m-%d') AS report_date, "
            f"anomaly_score_0_100, {count_of('combined_z__', f)} AS num_features_used, "
            f"top_driver_1, top_driver_2, {r6('d2', 'mahalanobis_distance')}, "
            f"{r6(mean_abs('self_z__', f), 'self_history_score')}, "
            f"{r6(mean_abs('peer_z__', f), 'peer_relative_score')}, "
            f"{r6(mean_abs('combined_z__', f), 'combined_signal_strength')}, "
            f"{all_r6([names.combined_z(x) for x in f])} FROM blended b "
            "JOIN slots USING (ticker, report_date) JOIN ranked USING (ticker, report_date)")


# Quantiles 0.5 and 0.975 of the chi-square distribution with five degrees of freedom.
_CHI_HALF, _CHI_CUT = 4.351460191095526, 12.832501994030027


def fitted(source, of, features, out):
    """CTEs with the mean and Cholesky factor of ``source``, and the distance `d2` of every row of ``of``."""
    p = len(features)
    means = cols(f"avg({f}) AS m{i}" for i, f in enumerate(features))
    spread = cols(f"covar_pop({features[i]}, {features[j]}) AS c{i}_{j}" for i in range(p) for j in range(i + 1))
    steps, last = [], f"{out}_m"
    for j in range(p):
        squares = "".join(f" - l{j}_{k} * l{j}_{k}" for k in range(j))
        steps.append(f"{out}_d{j} AS (SELECT *, sqrt(c{j}_{j}{squares}) AS l{j}_{j} FROM {last})")
        below = cols(["*", *[f"(c{i}_{j}" + "".join(f" - l{i}_{k} * l{j}_{k}" for k in range(j))
                             + f") / l{j}_{j} AS l{i}_{j}" for i in range(j + 1, p)]])
        steps.append(f"{out}_l{j} AS (SELECT {below} FROM {out}_d{j})")
        last = f"{out}_l{j}"
    solve, at = [], f"(SELECT o.*, f.* FROM {of} o, {last} f)"
    for i in range(p):
        known = "".join(f" - l{i}_{k} * z{k}" for k in range(i))
        solve.append(f"{out}_z{i} AS (SELECT *, ({features[i]} - m{i}{known}) / l{i}_{i} AS z{i} FROM {at})")
        at = f"{out}_z{i}"
    total = " + ".join(f"z{i} * z{i}" for i in range(p))
    return (f"{out}_m AS (SELECT {means}, {spread} FROM {source}), " + ", ".join(steps + solve)
            + f", {out} AS (SELECT ticker, report_date, {cols(features)}, {total} AS d2 FROM {at})")


_SCALES = {"revenue": 200000.0, "discount": 0.05, "tax": 0.04, "quantity": 25.0, "n_lines": 10.0}
_AT = "((year(report_date) - 1995) * 4 + quarter(report_date) - 1)"
PLANTED = PANEL + f""",
planted AS (SELECT ticker, report_date, {cols(
    f"CASE WHEN {_AT} >= 21 THEN {f} + CASE WHEN (CAST(ticker AS BIGINT) + {_AT}) % 2 = 0 THEN 1.0::DOUBLE "
    f"ELSE -1.0 END * CAST(40 + (CAST(ticker AS BIGINT) * {i + 3} + {_AT} * {7 - i}) % 17 AS DOUBLE) "
    f"* {scale}::DOUBLE ELSE {f} END AS {f}" for i, (f, scale) in enumerate(_SCALES.items()))}
  FROM panel)"""


def planted_distances():
    """CTEs from `clipped` (which must come before) to `distances`: the rows not moved are the raw fit."""
    return (f"stay AS (SELECT * FROM clipped WHERE {_AT} < 21), "
            + fitted("stay", "clipped", FEATURES, "raw")
            + f", factor AS (SELECT median(d2) / {_CHI_HALF} AS f FROM raw), "
              f"near AS (SELECT raw.* FROM raw, factor WHERE d2 < f * {_CHI_CUT}), "
            + fitted("near", "clipped", FEATURES, "distances"))


def planted_scores():
    return (f"WITH {PLANTED}, {blended('planted', FEATURES)} {driver_ctes(FEATURES)}, {planted_distances()}, "
            f"ranked AS (SELECT *, {percentile('d2', 'anomaly_score_0_100')} FROM distances) "
            "SELECT b.ticker, strftime(b.report_date, '%Y-%m-%d') AS report_date, "
            f"anomaly_score_0_100, {count_of('combined_z__', FEATURES)} AS num_features_used, "
            f"top_driver_1, top_driver_2, '{names.MODEL_TYPE}' AS model_type, "
            f"{r3('d2', 'mahalanobis_distance')}, "
            f"{r6(mean_abs('self_z__', FEATURES), 'self_history_score')}, "
            f"{r6(mean_abs('peer_z__', FEATURES), 'peer_relative_score')}, "
            f"{r6(mean_abs('combined_z__', FEATURES), 'combined_signal_strength')} FROM blended b "
            "JOIN slots USING (ticker, report_date) JOIN ranked USING (ticker, report_date)")


SUPPLIER_FILINGS = PANEL + """,
filings AS (
  SELECT ticker, s_name AS company_name, lpad(ticker, 10, '0') AS cik,
         strftime(report_date, '%Y-%m-%d') AS report_date,
         strftime(report_date + INTERVAL 40 DAY, '%Y-%m-%d') AS filing_date,
         'urn:filing:' || ticker || ':' || strftime(report_date, '%Y-%m-%d') AS filing_url,
         CAST(ticker AS BIGINT) AS t, year(report_date) AS y, revenue, tax, quantity, n_lines
  FROM panel LEFT JOIN supplier ON CAST(s_suppkey AS VARCHAR) = ticker)"""

EVENT_FILINGS = """
weeks AS (
  SELECT user_id AS t, CAST(user_id AS VARCHAR) AS ticker,
         CAST(date_trunc('week', ts) AS DATE) AS day, round(sum(value), 2) AS revenue,
         round(sum(value), 2) / CAST(count(*) AS DOUBLE) AS tax, max(value) AS quantity,
         CAST(count(*) AS DOUBLE) AS n_lines
  FROM events GROUP BY 1, 2, 3),
filings AS (
  SELECT ticker, 'User ' || ticker AS company_name, lpad(ticker, 10, '0') AS cik,
         strftime(day, '%Y-%m-%d') AS report_date,
         strftime(day + INTERVAL 40 DAY, '%Y-%m-%d') AS filing_date,
         'urn:filing:' || ticker || ':' || strftime(day, '%Y-%m-%d') AS filing_url,
         t, year(day) AS y, revenue, tax, quantity, n_lines FROM weeks)"""

_ACCEPT = """,
listed AS (
  SELECT * FROM filings
  WHERE n_lines % 7 <> 0 AND (t + y) % 11 <> 0 AND NOT (t % 17 = 0 AND n_lines % 3 = 0)),
accepted AS (SELECT * FROM listed WHERE NOT (t % 13 = 0 AND n_lines % 2 = 0))"""
FILINGS = SUPPLIER_FILINGS + _ACCEPT

_FLAT = f"""
SELECT ticker, company_name, cik, '10-Q' AS form_type, report_date, filing_date, filing_url,
       {r6('revenue', 'revenue_total')}, {r6('tax', 'f_2yr_tax')}, {r6('n_lines', 'n_lines_')},
       'text' AS note, 'true' AS flag, '5' AS digits,
       {r6('CASE WHEN t % 2 = 0 THEN quantity END', 'mix_ed_key')}
FROM accepted"""

_CHAIN = ["revenue_total", "f_2yr_tax", "n_lines_", "mix_ed_key"]
_FLAT_NUMBERS = cols([r6("revenue", "revenue_total"), r6("tax", "f_2yr_tax"), r6("n_lines", "n_lines_"),
                      r6("CASE WHEN t % 2 = 0 THEN quantity END", "mix_ed_key")])

ACCOUNTS = PANEL + """,
accounts AS (
  SELECT ticker, report_date, revenue * tax AS receivables, revenue AS sales,
    revenue * (0.5 + discount) AS cogs, revenue * 0.8 AS current_assets, quantity * 1000 AS ppe,
    n_lines * 100 AS securities, revenue * 2 + quantity * 1500 + n_lines * 300 AS total_assets,
    quantity * 50 + n_lines AS depreciation, revenue * discount + n_lines * 10 AS sga,
    revenue * 0.1 AS income, revenue * (0.05 + tax) AS cash_from_ops,
    revenue * 0.3 + n_lines AS current_liabilities, quantity * 700 AS long_term_debt
  FROM panel),
pairs AS (
  SELECT t.ticker, t.report_date,
    (t.receivables / nullif(t.sales, 0)) / nullif(p.receivables / nullif(p.sales, 0), 0) AS dsri,
    ((p.sales - p.cogs) / nullif(p.sales, 0)) / nullif((t.sales - t.cogs) / nullif(t.sales, 0), 0)
      AS gmi,
    (1 - (t.current_assets + t.ppe + t.securities) / nullif(t.total_assets, 0))
      / nullif(1 - (p.current_assets + p.ppe + p.securities) / nullif(p.total_assets, 0), 0) AS aqi,
    t.sales / nullif(p.sales, 0) AS sgi,
    (p.depreciation / nullif(p.ppe + p.depreciation, 0))
      / nullif(t.depreciation / nullif(t.ppe + t.depreciation, 0), 0) AS depi,
    (t.sga / nullif(t.sales, 0)) / nullif(p.sga / nullif(p.sales, 0), 0) AS sgai,
    (t.income - t.cash_from_ops) / nullif(t.total_assets, 0) AS tata,
    ((t.current_liabilities + t.long_term_debt) / nullif(t.total_assets, 0))
      / nullif((p.current_liabilities + p.long_term_debt) / nullif(p.total_assets, 0), 0) AS lvgi
  FROM accounts t LEFT JOIN accounts p
    ON p.ticker = t.ticker AND year(p.report_date - 15) = year(t.report_date - 15) - 1
      AND quarter(p.report_date - 15) = quarter(t.report_date - 15)),
rated AS (
  SELECT *, -4.84 + 0.920 * dsri + 0.528 * gmi + 0.404 * aqi + 0.892 * sgi + 0.115 * depi
    - 0.172 * sgai + 4.679 * tata - 0.327 * lvgi AS m_score
  FROM pairs)"""

_PATTERN = ("CASE mark % 7 " + " ".join(
    f"WHEN {i} THEN '{p}'" for i, p in enumerate(names.PATTERNS)) + " END")
SYNTHESIS = ACCOUNTS + f""",
marked AS (
  SELECT ticker, strftime(report_date, '%Y-%m-%d') AS report_date, {percentile('revenue',
    'anomaly_score_0_100')}, strftime(report_date + INTERVAL 40 DAY, '%Y-%m-%d') AS filing_date,
    CAST(ticker AS BIGINT) + year(report_date) AS mark
  FROM panel),
narrative AS (
  SELECT * FROM (SELECT ticker, report_date,
    CASE mark % 4 WHEN 0 THEN 'CONTRADICTS' WHEN 1 THEN 'CORROBORATES' WHEN 2 THEN 'NEUTRAL' END
      AS label, 'note ' || ticker AS rationale FROM marked WHERE mark % 3 = 0)
  WHERE label IS NOT NULL),
briefs AS (SELECT ticker, report_date, {_PATTERN} AS pattern, 'brief ' || ticker AS rationale
           FROM marked WHERE mark % 5 = 0),
convicted AS (
  SELECT ticker, report_date, round(0.4 * coalesce(anomaly_score_0_100, 0)
    + 0.3 * CASE WHEN m_score > -2.22 THEN 100 ELSE 0 END
    + 0.3 * CASE label WHEN 'CONTRADICTS' THEN 100 WHEN 'NEUTRAL' THEN 25 ELSE 0 END, 4)
      AS conviction_score
  FROM marked LEFT JOIN (SELECT ticker, strftime(report_date, '%Y-%m-%d') AS report_date, m_score
                         FROM rated) USING (ticker, report_date)
  LEFT JOIN narrative USING (ticker, report_date)),
tiered AS (SELECT *, CASE WHEN conviction_score >= 65 THEN 'ALERT' WHEN conviction_score >= 40
    THEN 'FLAG' WHEN conviction_score >= 20 THEN 'WATCH' END AS tier FROM convicted),
intelligence AS (
  SELECT m.ticker, m.report_date, anomaly_score_0_100, filing_date, pattern, b.rationale, label,
    n.rationale AS narrative_rationale, conviction_score, tier
  FROM marked m LEFT JOIN briefs b USING (ticker, report_date)
  LEFT JOIN narrative n USING (ticker, report_date) JOIN tiered USING (ticker, report_date))"""

# Fewer rows than features: squares of the features, holes at the median of the column.
_SMALL = [f"{kind}_{s}" for s in "fop" for kind in ("n", "most")]
_SQUARES = [f"({f} * {f})" for f in _SMALL]
SMALL_SAMPLE = f"""
WITH g AS (
  SELECT o_orderpriority AS ticker, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS d,
    {cols(f"count(*) FILTER (o_orderstatus = '{s.upper()}') / 100.0::DOUBLE AS n_{s}, "
          f"round(max(o_totalprice) FILTER (o_orderstatus = '{s.upper()}') / 1e4, 4) AS most_{s}"
          for s in "fop")}
  FROM orders GROUP BY 1),
holed AS (SELECT * REPLACE (CASE WHEN d <> 2 THEN n_f END AS n_f, CASE WHEN d > 3 THEN most_o END AS most_o)
  FROM g),
med AS (SELECT {cols(f'median({f}) AS m_{f}' for f in _SMALL)} FROM holed),
filled AS (SELECT ticker, {cols(f'coalesce({f}, m_{f}) AS {f}' for f in _SMALL)} FROM holed, med)
SELECT ticker, {r6(' + '.join(_SQUARES), 'mahalanobis_distance')} FROM filled"""

_EVENT_SCORES = scored_events()
_PACK = """ticker, company_name, report_date, filing_date, filing_url, anomaly_score_0_100,
  mahalanobis_distance, self_history_score, peer_relative_score, combined_signal_strength,
  num_features_used, top_driver_1, top_driver_1_value, top_driver_2, top_driver_2_value,
  top_driver_3, top_driver_3_value"""

_TREND = f"""{SYNTHESIS}, filed AS (
        SELECT * FROM intelligence UNION ALL
        SELECT * REPLACE (strftime(CAST(report_date AS DATE) + INTERVAL 1 DAY, '%Y-%m-%d')
          AS report_date, strftime(CAST(filing_date AS DATE) + INTERVAL 10 DAY, '%Y-%m-%d')
          AS filing_date) FROM intelligence WHERE tier IS NOT NULL),
        quartered AS (SELECT *, CAST(year(CAST(report_date AS DATE)) AS VARCHAR) || 'Q' ||
          CAST(quarter(CAST(report_date AS DATE)) AS VARCHAR) AS calendar_quarter FROM filed),
        trend AS (SELECT * FROM (SELECT *, row_number() OVER (
          PARTITION BY ticker, calendar_quarter ORDER BY filing_date DESC, report_date DESC) AS rn
          FROM quartered) WHERE rn = 1)"""

# The rows of `bundle_counts` from `r`, one row a document with the reason it was left out for.
_COUNTS = """SELECT 'documents' AS reason, count(*) AS n FROM r
        UNION ALL SELECT 'kept', count(*) FROM r WHERE reason IS NULL
        UNION ALL SELECT k, count(reason) FROM (VALUES ('malformed'), ('other_form'), ('no_ticker'),
          ('not_listed'), ('over_limit'), ('no_features')) v(k) LEFT JOIN r ON reason = k GROUP BY k"""


def robust_z_of(group, value="value"):
    """The robust z of a value, whose group has n, q1, m and q3 in `group`."""
    spread = f"({group}.q3 - {group}.q1)"
    return (f"CASE WHEN {group}.n >= 2 THEN CASE WHEN {spread} = 0 THEN 0.0 "
            f"ELSE ({value} - {group}.m) / ({spread} / {names.IQR_TO_SIGMA}) END END")


def quartiles_by(key):
    return (f"SELECT {key}, feature, count(*) AS n, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS m, "
            f"quantile_cont(value, 0.75) AS q3 FROM c GROUP BY {key}, feature")


WIDE_SCORES = f"""WITH lines AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS ticker,
    strftime(date_trunc('quarter', l_shipdate), '%Y-%m-%d') AS report_date, l_quantity AS q,
    unnest(['part_' || l_partkey, 'order_' || l_orderkey, 'line_' || l_partkey || '_' || l_linenumber]) AS feature
  FROM lineitem),
cells AS (SELECT ticker, report_date, feature, sum(q) AS value FROM lines GROUP BY ALL),
bounds AS (SELECT feature, quantile_cont(value, 0.05) AS lo, quantile_cont(value, 0.5) AS median,
  quantile_cont(value, 0.95) AS hi FROM cells GROUP BY feature),
c AS (SELECT ticker, report_date, feature, greatest(least(value, hi), lo) AS value, median
  FROM cells JOIN bounds USING (feature)),
own AS ({quartiles_by('ticker')}), peer AS ({quartiles_by('report_date')}),
z AS (SELECT c.*, {robust_z_of('own')} AS s, {robust_z_of('peer')} AS p
  FROM c JOIN own ON own.ticker = c.ticker AND own.feature = c.feature
  JOIN peer ON peer.report_date = c.report_date AND peer.feature = c.feature),
b AS (SELECT *, greatest(least(coalesce((s + p) / 2, s, p), {names.Z_CLIP}), -{names.Z_CLIP}) AS z
  FROM (SELECT *, s IS NULL AND p IS NULL AS none FROM z)),
b2 AS (SELECT * REPLACE (CASE WHEN none THEN NULL ELSE z END AS z) FROM b),
top AS (SELECT * FROM b2 WHERE z IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY ticker, report_date ORDER BY round(abs(z), 9) DESC, feature) = 1),
sums AS (SELECT ticker, report_date, CAST(count(z) AS INTEGER) AS num_features_used, avg(abs(s)) AS own_score,
  avg(abs(p)) AS peer_score, avg(abs(z)) AS strength, sum(value * value - median * median) AS more
  FROM b2 GROUP BY ticker, report_date)
SELECT sums.ticker, sums.report_date, num_features_used, top.feature AS top_driver_1,
  {r6("more + (SELECT sum(median * median) FROM bounds) + 1e-9", 'mahalanobis_distance')},
  {r6('own_score + 1e-9', 'self_history_score')}, {r6('peer_score + 1e-9', 'peer_relative_score')},
  {r6('strength + 1e-9', 'combined_signal_strength')}, {r6('top.z + 1e-9', 'top_driver_1_value')}
FROM sums LEFT JOIN top ON top.ticker = sums.ticker AND top.report_date = sums.report_date"""

ORACLE: dict[str, str] = {
    "scan_form_filter":
        "SELECT o_orderkey, o_orderstatus AS form_type, o_totalprice FROM orders "
        "WHERE o_orderstatus = 'F'",
    "dedup_panel":
        "SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER "
        "(PARTITION BY user_id, event_type ORDER BY event_id) AS rn FROM events) WHERE rn = 1",
    "feature_profile":
        "SELECT count(*) AS n_rows, count(DISTINCT user_id) AS n_entities, count(*) - "
        "(SELECT count(*) FROM (SELECT DISTINCT user_id, event_type FROM events)) AS n_duplicates, "
        "3 AS n_features FROM events",
    "filings_of_quarters": """WITH q AS (SELECT DISTINCT year(l_shipdate) || 'Q' || quarter(l_shipdate) AS cq
          FROM lineitem WHERE l_quantity = 50 AND l_discount = 0 AND year(l_shipdate) < 1996)
        SELECT o_orderkey, 'F' AS form_type, cq AS calendar_quarter, o_totalprice FROM (
          SELECT *, year(o_orderdate) || 'Q' || quarter(o_orderdate) AS cq FROM orders WHERE o_orderstatus = 'F')
        JOIN q USING (cq)""",
    "listed_orders":
        "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey IN "
        "(SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')",
    "split_list":
        "SELECT event_id, CAST(place AS INTEGER) - 1 AS place, trim([event_type, CAST(user_id AS VARCHAR), ' last '][place]) "
        "AS entry FROM events, (VALUES (1), (2), (3)) v(place)",
    "quantile_sketch_ranks": """SELECT l_returnflag, feature, count(*) AS n, prob, true AS within
        FROM lineitem, (VALUES ('l_quantity'), ('l_extendedprice'), ('l_discount')) f(feature),
          (VALUES (0.05::DOUBLE), (0.25), (0.5), (0.75), (0.95)) p(prob) GROUP BY l_returnflag, feature, prob""",
    "distinct_sketch_users":
        "SELECT event_type, count(DISTINCT user_id) AS n_users, true AS within FROM events GROUP BY event_type",
    "records_round_trip":
        "SELECT doc_id, sha256(coalesce('{\"' || text || '\"}, {', '')) AS text_sha256, lang, source, n_chars "
        "FROM documents",
    "allow_list":
        "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN "
        "('1-URGENT', '5-LOW', 'none')",
    "first_entities":
        "SELECT event_id, user_id FROM events WHERE user_id IN (SELECT user_id FROM events "
        "GROUP BY user_id ORDER BY min(event_id), user_id LIMIT 25)",
    "safe_names":
        "SELECT o_orderkey, CASE WHEN regexp_matches(s, '^[0-9]') THEN 'f_' || s ELSE s END "
        "AS column_name FROM (SELECT o_orderkey, regexp_replace(lower(o_orderpriority), "
        "'[^a-z0-9_]', '_', 'g') AS s FROM orders)",
    "group_quantiles": quantile_table(),
    "group_quantiles_hot": quantile_table(),
    "winsorize":
        f"WITH {PANEL}, {clipped('panel', FEATURES)} "
        f"SELECT ticker, report_date, {all_r6(FEATURES)} FROM clipped",
    "winsorize_hot":
        f"WITH {SPARSE}, {clipped('sparse', FEATURES)} "
        f"SELECT ticker, report_date, {all_r6(FEATURES)} FROM clipped",
    "self_z": z_query(SPARSE, "sparse", ["ticker"], "self_z__"),
    "peer_z": z_query(SPARSE, "sparse", ["report_date"], "peer_z__"),
    "peer_z_hot": z_query(SPARSE, "sparse", ["report_date"], "peer_z__"),
    "sector_peer_z": z_query(SECTORS, "sectored", ["sector", "calendar_quarter"], "peer_z__",
                             "ticker, report_date, sector, calendar_quarter"),
    "combined_z":
        f"WITH {SPARSE}, {blended('sparse', FEATURES)} SELECT ticker, report_date, "
        f"{all_r6([names.combined_z(f) for f in FEATURES])} FROM blended",
    "impute_median":
        f"WITH {MEDIANS} SELECT ticker, report_date, {all_r6(FEATURES)} FROM filled",
    "l2_fallback":
        f"WITH {MEDIANS} SELECT ticker, report_date, "
        f"{r6('(discount * discount + tax * tax) + quantity * quantity', 'mahalanobis_distance')} "
        "FROM filled",
    "percentile_score":
        f"WITH {SPARSE} SELECT ticker, report_date, {percentile('quantity', 'score')}, "
        f"{percentile('revenue', 'revenue_score')} FROM sparse",
    "percentile_score_ranges":
        f"WITH {SPARSE} SELECT ticker, report_date, {percentile('n_lines', 'score')} FROM sparse",
    "summary_scores":
        f"WITH {SPARSE}, {blended('sparse', FEATURES)} SELECT ticker, report_date, "
        f"{count_of('combined_z__', FEATURES)} AS num_features_used, "
        f"{r6(mean_abs('self_z__', FEATURES), 'self_history_score')}, "
        f"{r6(mean_abs('peer_z__', FEATURES), 'peer_relative_score')}, "
        f"{r6(mean_abs('combined_z__', FEATURES), 'combined_signal_strength')} FROM blended",
    "top_drivers":
        f"WITH {SPARSE}, {blended('sparse', FEATURES)} {driver_ctes(FEATURES)} SELECT * FROM slots",
    "driver_summary":
        f"WITH {SPARSE}, {blended('sparse', FEATURES)} {driver_ctes(FEATURES)} "
        f"SELECT ticker, report_date, {summary_text()} AS driver_summary FROM slots",
    "mcd_full_support":
        f"WITH {PANEL}, {full_support('panel')} SELECT ticker, report_date, "
        f"{r6('d2', 'mahalanobis_distance')} FROM distances",
    "score_filings_full_support": full_support_scores(),
    "mcd_planted":
        f"WITH {PLANTED}, {clipped('planted', FEATURES)}, {planted_distances()} "
        f"SELECT ticker, report_date, {r3('d2', 'mahalanobis_distance')} FROM distances",
    "score_filings_planted": planted_scores(),
    "score_filings_l2": f"WITH {_EVENT_SCORES} SELECT * FROM scored",
    "scores_csv_round_trip": f"WITH {_EVENT_SCORES} SELECT * FROM scored",
    "review_pack":
        f"WITH {_EVENT_SCORES}, top AS (SELECT * FROM scored ORDER BY anomaly_score_0_100 DESC "
        f"NULLS LAST, mahalanobis_distance DESC NULLS LAST, ticker, report_date LIMIT 20) SELECT {_PACK}, {summary_text()} "
        f"AS driver_summary, {all_r6(EVENT_FEATURES)} "
        "FROM top LEFT JOIN event_panel USING (ticker, report_date)",
    "top_scores":
        f"WITH {PANEL}, s AS (SELECT ticker, report_date, "
        f"{percentile('revenue', 'anomaly_score_0_100')}, revenue FROM panel) "
        "SELECT * EXCLUDE (revenue) FROM s "
        "ORDER BY anomaly_score_0_100 DESC, revenue DESC, ticker, report_date LIMIT 20",
    "top_scores_tied":
        f"WITH {PANEL}, s AS (SELECT ticker, report_date, "
        f"{percentile('revenue', 'score')}, revenue FROM panel) "
        f"SELECT ticker, report_date, round(score / 10) * 10 AS anomaly_score_0_100, "
        f"{r6('revenue', 'revenue')} FROM s "
        "ORDER BY round(score / 10) DESC, s.revenue DESC, ticker, report_date LIMIT 20",
    "small_sample_distance": SMALL_SAMPLE,
    "ordered_scores":
        f"WITH {PANEL} SELECT ticker, report_date, "
        f"{percentile('quantity', 'anomaly_score_0_100')} FROM panel",
    "score_preview":
        f"WITH {_EVENT_SCORES} SELECT ticker, report_date, anomaly_score_0_100, top_driver_1, "
        "top_driver_1_value FROM scored ORDER BY anomaly_score_0_100 DESC NULLS LAST, "
        "mahalanobis_distance DESC NULLS LAST, ticker, report_date LIMIT 5",
    "publish_outputs":
        f"WITH {_EVENT_SCORES} SELECT ticker, report_date, anomaly_score_0_100, num_features_used "
        "FROM scored",
    "bundle_flatten": f"WITH {FILINGS} {_FLAT}",
    "bundle_scan": f"WITH {EVENT_FILINGS} {_ACCEPT} {_FLAT}",
    "bundle_first_tickers":
        f"WITH {FILINGS} SELECT ticker, report_date FROM accepted WHERE ticker IN (SELECT ticker "
        "FROM listed GROUP BY ticker ORDER BY min(ticker || '/' || report_date) LIMIT 30)",
    "bundle_keys": f"""WITH {FILINGS}, k AS (
        SELECT 'Revenue Total' AS key, 'revenue_total' AS name, count(*) AS n_values, true AS numeric
          FROM accepted
        UNION ALL SELECT '2yr-tax', 'f_2yr_tax', count(*), true FROM accepted
        UNION ALL SELECT 'n lines%', 'n_lines_', count(*), true FROM accepted
        UNION ALL SELECT 'note', 'note', count(*), false FROM accepted
        UNION ALL SELECT 'flag', 'flag', count(*), false FROM accepted
        UNION ALL SELECT 'digits', 'digits', count(*), false FROM accepted
        UNION ALL SELECT 'mix.ed"key', 'mix_ed_key', count(*), true FROM accepted WHERE t % 2 = 0)
        SELECT * FROM k""",
    "bundle_malformed":
        f"WITH {FILINGS} SELECT ticker || '/' || report_date AS path FROM filings "
        "WHERE t % 17 = 0 AND n_lines % 3 = 0",
    "bundle_pruned":
        f"WITH {EVENT_FILINGS} {_ACCEPT} SELECT ticker, report_date, {r6('revenue', 'revenue_total')} "
        "FROM accepted WHERE t % 3 = 0",
    "bundle_counts": f"""WITH {EVENT_FILINGS}, r AS (
        SELECT CASE WHEN t % 17 = 0 AND n_lines % 3 = 0 THEN 'malformed' WHEN n_lines % 7 = 0 THEN 'other_form'
          WHEN (t + y) % 11 = 0 THEN 'no_ticker' WHEN t % 13 = 0 AND n_lines % 2 = 0 THEN 'no_features' END
          AS reason FROM filings)
        {_COUNTS}""",
    "bundle_counts_limited": f"""WITH {EVENT_FILINGS} {_ACCEPT}, chosen AS (
        SELECT ticker FROM listed GROUP BY ticker
        ORDER BY min('/folder=' || ticker || '/day=' || report_date), ticker LIMIT 40), r AS (
        SELECT CASE WHEN t % 17 = 0 AND n_lines % 3 = 0 THEN 'malformed' WHEN n_lines % 7 = 0 THEN 'other_form'
          WHEN (t + y) % 11 = 0 THEN 'no_ticker' WHEN ticker NOT IN (SELECT ticker FROM chosen) THEN 'over_limit'
          WHEN t % 13 = 0 AND n_lines % 2 = 0 THEN 'no_features' END AS reason FROM filings)
        {_COUNTS}""",
    "score_counts": f"""WITH {PANEL}, n AS (SELECT count(*) AS rows,
          count_if(CAST(ticker AS BIGINT) % 2 = 0) AS twice FROM panel)
        SELECT 'rows_read' AS what, rows + twice AS n FROM n UNION ALL
        SELECT 'duplicates_dropped', twice FROM n UNION ALL SELECT 'filings_scored', rows FROM n UNION ALL
        SELECT 'features', {len(FEATURES) + 1} UNION ALL SELECT 'features_with_values', {len(FEATURES)}""",
    "wide_scores": WIDE_SCORES,
    "publish_set":
        f"WITH {_EVENT_SCORES} SELECT ticker, report_date, anomaly_score_0_100, num_features_used "
        "FROM scored",
    "trend_table": f"""WITH {_TREND}
        SELECT ticker, calendar_quarter, {r6("anomaly_score_0_100 - lag(anomaly_score_0_100) OVER ("
            "PARTITION BY ticker ORDER BY calendar_quarter)", 'change')},
          count(*) OVER (PARTITION BY ticker) AS n_quarters FROM trend""",
    "flatten_job": f"WITH {EVENT_FILINGS} {_ACCEPT} SELECT ticker, report_date, {_FLAT_NUMBERS} FROM accepted",
    "table_flatten_job":
        f"WITH {PANEL} SELECT ticker, strftime(report_date, '%Y-%m-%d') AS report_date, "
        f"'10-Q' AS form_type, {all_r6(FEATURES)} FROM panel",
    "three_jobs": f"""WITH {EVENT_FILINGS} {_ACCEPT},
        flat AS (SELECT ticker, company_name, report_date, filing_date, filing_url, revenue AS revenue_total,
          tax AS f_2yr_tax, n_lines AS n_lines_, CASE WHEN t % 2 = 0 THEN quantity END AS mix_ed_key
          FROM accepted), {scored_by_squares('flat', _CHAIN)},
        top AS (SELECT * FROM scored ORDER BY anomaly_score_0_100 DESC NULLS LAST,
          mahalanobis_distance DESC NULLS LAST, ticker, report_date LIMIT 30)
        SELECT {_PACK.replace('company_name', 'flat.company_name').replace('filing_date', 'flat.filing_date').replace('filing_url', 'flat.filing_url')},
          {summary_text()} AS driver_summary, {all_r6(_CHAIN)}, '2024-01-01 00:00:00' AS scored_at
        FROM top JOIN flat USING (ticker, report_date)""",
    "json_flatten":
        "SELECT event_id, CAST(json_extract(props, '$.k') AS DOUBLE) AS k FROM events",
    "features_round_trip":
        f"WITH {SPARSE} SELECT ticker, report_date, {all_r6(FEATURES)} FROM sparse",
    "m_score":
        f"WITH {ACCOUNTS} SELECT ticker, report_date, m_score > -2.22 AS likely_manipulator, "
        + all_r6(["dsri", "gmi", "aqi", "sgi", "depi", "sgai", "tata", "lvgi", "m_score"])
        + " FROM rated",
    "label_join":
        "SELECT d.doc_id, source, n_chars, label FROM documents d LEFT JOIN (SELECT doc_id, "
        "CASE WHEN toxic = 1 THEN 'CONTRADICTS' ELSE 'CORROBORATES' END AS label FROM labels "
        "WHERE toxic = 1 OR quality = 1) l ON l.doc_id = d.doc_id",
    "eligible_filings": "SELECT event_id, value FROM events WHERE value >= 5.0",
    "conviction_tiers":
        f"WITH {SYNTHESIS} SELECT ticker, report_date, conviction_score, tier FROM tiered",
    "intelligence_view": f"WITH {SYNTHESIS} SELECT * FROM intelligence",
    "tiered_pack":
        f"WITH {SYNTHESIS} SELECT ticker, report_date, conviction_score, tier, label "
        "FROM intelligence WHERE tier IS NOT NULL",
    "company_trend":
        f"""WITH {_TREND} SELECT ticker, calendar_quarter, report_date, filing_date, anomaly_score_0_100,
          conviction_score, tier, label, pattern FROM trend""",
}
