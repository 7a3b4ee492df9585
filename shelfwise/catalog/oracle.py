"""Independent SQL for the catalog: the same results from one SQL engine on the same tables.

Every text starts from the ``sales`` view and reads whole tables. Column names equal those of the Spark queries.
"""

from __future__ import annotations

from shelfwise.config import RETAIL as R
from shelfwise.functions import scalars

SALES = """sales AS (
SELECT
  'FD' || lpad(CAST(l_partkey AS VARCHAR(20)), 6, '0')                       AS Item_Identifier,
  CASE WHEN (l_orderkey*7 + l_partkey*3 + l_suppkey) % 6 = 0 OR l_partkey % 97 = 0
       THEN NULL ELSE CAST(p_size AS DOUBLE) END                             AS Item_Weight,
  CASE l_partkey % 5 WHEN 0 THEN 'Low Fat' WHEN 1 THEN 'LF' WHEN 2 THEN 'low fat'
       WHEN 3 THEN 'Regular' ELSE 'reg' END                                  AS Item_Fat_Content,
  l_discount                                                                 AS Item_Visibility,
  p_type                                                                     AS Item_Type,
  CASE WHEN (l_orderkey + l_partkey*5) % 41 = 0 THEN NULL ELSE p_retailprice END AS Item_MRP,
  'OUT' || lpad(CAST(l_suppkey AS VARCHAR(20)), 4, '0')                      AS Outlet_Identifier,
  CAST(1985 + l_suppkey % 25 AS INT)                                         AS Outlet_Establishment_Year,
  CASE WHEN l_suppkey % 4 = 0 OR (l_orderkey + l_suppkey) % 9 = 0 THEN NULL
       WHEN l_suppkey % 3 = 0 THEN 'Small' WHEN l_suppkey % 3 = 1 THEN 'medium' ELSE 'HIGH' END AS Outlet_Size,
  CASE n_regionkey % 3 WHEN 0 THEN 'Tier 1' WHEN 1 THEN 'Tier2' ELSE 'tier 3' END AS Outlet_Location_Type,
  CASE s_nationkey % 4 WHEN 0 THEN 'Grocery' WHEN 1 THEN 'Supermarket Type1'
       WHEN 2 THEN 'Supermarket Type 2' ELSE 'Supermarket Type3' END         AS Outlet_Type,
  CAST(floor(p_retailprice * (1 + l_suppkey % 10) * (50 + l_quantity) * (1 - l_discount) / 2) AS DOUBLE) / 100
                                                                             AS Item_Outlet_Sales,
  l_orderkey, l_partkey, l_suppkey, l_linenumber
FROM lineitem
JOIN part     ON l_partkey   = p_partkey
JOIN supplier ON l_suppkey   = s_suppkey
JOIN nation   ON s_nationkey = n_nationkey
)"""

HELD_OUT = "(l_orderkey + l_partkey + l_suppkey + l_linenumber) % 5 = 0"
Y = R.target


# Label fixes, written out so that a slip in the configuration shows.
FAT_FIX = """CASE Item_Fat_Content WHEN 'LF' THEN 'Low Fat' WHEN 'low fat' THEN 'Low Fat' WHEN 'reg' THEN 'Regular'
  ELSE Item_Fat_Content END AS Item_Fat_Content"""
TYPE_FIX = """CASE Item_Type WHEN 'Fruits & Vegetables' THEN 'Fruits and Vegetables'
  WHEN 'Health & Hygiene' THEN 'Health and Hygiene' ELSE Item_Type END AS Item_Type"""
LOCATION_FIX = """CASE Outlet_Location_Type WHEN 'Tier1' THEN 'Tier 1' WHEN 'Tier2' THEN 'Tier 2' WHEN 'Tier3' THEN 'Tier 3'
  WHEN 'tier 1' THEN 'Tier 1' WHEN 'tier 2' THEN 'Tier 2' WHEN 'tier 3' THEN 'Tier 3'
  ELSE Outlet_Location_Type END AS Outlet_Location_Type"""
SIZE_FIX = """CASE Outlet_Size WHEN 'high' THEN 'High' WHEN 'medium' THEN 'Medium' WHEN 'small' THEN 'Small'
  WHEN 'SMALL' THEN 'Small' WHEN 'MEDIUM' THEN 'Medium' WHEN 'HIGH' THEN 'High' ELSE Outlet_Size END AS Outlet_Size"""
OUTLET_FIX = """CASE Outlet_Type WHEN 'Grocery' THEN 'Grocery Store' WHEN 'Supermarket Type 1' THEN 'Supermarket Type1'
  WHEN 'Supermarket Type 2' THEN 'Supermarket Type2' WHEN 'Supermarket Type 3' THEN 'Supermarket Type3'
  ELSE Outlet_Type END AS Outlet_Type"""

PROFILED = f"profiled AS (SELECT * EXCLUDE (l_orderkey, l_partkey, l_suppkey, l_linenumber) REPLACE ({FAT_FIX}) FROM sales)"
BASE = f"base AS (SELECT * REPLACE ({FAT_FIX}, {TYPE_FIX}, {LOCATION_FIX}, {SIZE_FIX}, {OUTLET_FIX}) FROM sales)"

ALL_COLUMNS = {
    R.item: "string", R.weight: "double", R.fat_content: "string", R.visibility: "double", R.item_type: "string",
    R.price: "double", R.outlet: "string", R.opened_year: "int", R.outlet_size: "string",
    R.outlet_location: "string", R.outlet_type: "string", R.target: "double",
}


def _long(columns, source, carry=(), text=True) -> str:
    """UNION ALL form of an unpivot."""
    kind = "VARCHAR" if text else "DOUBLE"
    extra = "".join(f", {c}" for c in carry)
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS {kind}) AS value{extra} FROM {source} WHERE {c} IS NOT NULL"
        for c in columns
    )


def on_profiled(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([SALES, PROFILED, *ctes]) + "\n" + body


def on_base(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([SALES, BASE, *ctes]) + "\n" + body


LABELS = f"labels_long AS ({_long(R.category_features, 'profiled', [Y])})"
ALL_LABELS = f"labels_long AS ({_long(R.categorical, 'profiled', [Y])})"
NUMBERS = f"numbers AS ({_long(R.numeric, 'profiled', text=False)})"


def _describe(where: str) -> str:
    return f"""SELECT feature AS "column", count(*) AS count, round(avg(value), 4) AS mean,
 round(stddev_samp(value), 4) AS std, round(min(value), 4) AS min, round(quantile_cont(value, 0.25), 4) AS q25,
 round(quantile_cont(value, 0.5), 4) AS q50, round(quantile_cont(value, 0.75), 4) AS q75, round(max(value), 4) AS max
FROM numbers WHERE {where} GROUP BY feature"""


def _pearson(a: str, b: str) -> str:
    both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
    return (
        f"covar_samp({a}, {b}) / nullif(stddev_samp({a}) FILTER (WHERE {both}) * "
        f"stddev_samp({b}) FILTER (WHERE {both}), 0)"
    )


def _corr_rows(pairs, names) -> str:
    """One SELECT per pair; the year needs a cast to be a plain number."""
    return " UNION ALL ".join(
        f"SELECT {', '.join(f'{chr(39)}{v}{chr(39)} AS {n}' for v, n in zip(pair, names))}, "
        f"round({'1.0' if pair[0] == pair[-1] and len(pair) > 1 else _pearson(pair[0], pair[1] if len(pair) > 1 else Y)}, 6) AS corr "
        f"FROM profiled"
        + (" HAVING count(*) > 0" if pair[0] == pair[-1] and len(pair) > 1 else "")
        for pair in pairs
    )


def _pivot(rows: str, columns: str, labels) -> str:
    cells = ", ".join(f"round(avg({Y}) FILTER (WHERE {columns} = '{v}'), 4) AS \"{v}\"" for v in labels)
    return on_profiled(
        f"SELECT {rows}, {cells} FROM profiled WHERE {rows} IS NOT NULL AND {columns} IS NOT NULL GROUP BY {rows}"
    )


RAW_SIZES = ["HIGH", "Small", "medium"]
RAW_OUTLET_TYPES = ["Grocery", "Supermarket Type 2", "Supermarket Type1", "Supermarket Type3"]
RAW_LOCATIONS = ["Tier 1", "Tier2", "tier 3"]
ITEM_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
OUTLET_TYPES = ["Grocery Store", "Supermarket Type1", "Supermarket Type2", "Supermarket Type3"]
SIZES = ["High", "Medium", "Small", "nan"]


def _histogram(columns, bins: int, digits: int, log: bool = False) -> str:
    x = "ln(1 + value)" if log else "value"
    edge = lambda i: f"(CASE WHEN {i} = {bins} THEN hi ELSE lo + ({i}) * ((hi - lo) / {bins}) END)"
    return on_profiled(
        f"""SELECT g.feature, CAST(g.bin AS INT) AS bin, round({edge('g.bin')}, {digits}) AS left_edge,
 round({edge('(g.bin + 1)')}, {digits}) AS right_edge, coalesce(c.n, 0) AS n
FROM (SELECT feature, lo, hi, unnest(range({bins})) AS bin FROM ends) g
LEFT JOIN (SELECT feature, bin, count(*) AS n FROM (
  SELECT feature, CASE WHEN x < {edge('k')} THEN k - 1 WHEN x >= {edge('(k + 1)')} AND k <> {bins - 1} THEN k + 1 ELSE k END AS bin
  FROM (SELECT v.feature, x, lo, hi, least(CAST(floor((x - lo) * {bins} / (hi - lo)) AS BIGINT), {bins - 1}) AS k
        FROM vals v JOIN ends e ON v.feature = e.feature)) GROUP BY feature, bin) c
ON g.feature = c.feature AND g.bin = c.bin""",
        f"numbers AS ({_long(columns, 'profiled', text=False)})",
        f"vals AS (SELECT feature, {x} AS x FROM numbers)",
        "ends AS (SELECT feature, min(x) - CASE WHEN min(x) = max(x) THEN 0.5 ELSE 0 END AS lo, "
        "max(x) + CASE WHEN min(x) = max(x) THEN 0.5 ELSE 0 END AS hi FROM vals GROUP BY feature)",
    )


def _box(by: str, source: str, y: str) -> str:
    group = f"{by}, " if by else ""
    on = " AND ".join(f"s.{k} = b.{k}" for k in by.split(", ")) if by else "true"
    keys = "".join(f"b.{k}, " for k in by.split(", ")) if by else ""
    return f"""SELECT {keys}b.n, round(least(min({y}) FILTER (WHERE {y} >= q1 - 1.5 * (q3 - q1)), q1), 4) AS whisker_low,
 round(q1, 4) AS q1, round(med, 4) AS median, round(q3, 4) AS q3,
 round(greatest(max({y}) FILTER (WHERE {y} <= q3 + 1.5 * (q3 - q1)), q3), 4) AS whisker_high,
 count(*) FILTER (WHERE {y} < q1 - 1.5 * (q3 - q1) OR {y} > q3 + 1.5 * (q3 - q1)) AS flier_count
FROM {source} s JOIN (SELECT {group}count({y}) AS n, quantile_cont({y}, 0.25) AS q1, quantile_cont({y}, 0.5) AS med,
 quantile_cont({y}, 0.75) AS q3 FROM {source} GROUP BY {by if by else 'ALL'}) b ON {on}
GROUP BY {keys}b.n, q1, med, q3"""


def _horner(x: str, k) -> str:
    out = repr(k[-1])
    for c in reversed(k[:-1]):
        out = f"({out} * {x} + {c!r})"
    return out.replace("e", "E")


def _normal(p: str) -> str:
    """Inverse normal distribution function, the same published rational approximation as an SQL expression."""
    q, r = f"({p} - 0.5)", f"(0.180625 - ({p} - 0.5) * ({p} - 0.5))"
    tail = f"sqrt(-ln(least({p}, 1 - {p})))"
    near, far = f"({tail} - 1.6)", f"({tail} - 5.0)"
    middle = f"{q} * {_horner(r, scalars.NORMAL_CENTRE_TOP)} / {_horner(r, scalars.NORMAL_CENTRE_BOTTOM)}"
    outer_near = f"{_horner(near, scalars.NORMAL_NEAR_TOP)} / {_horner(near, scalars.NORMAL_NEAR_BOTTOM)}"
    outer_far = f"{_horner(far, scalars.NORMAL_FAR_TOP)} / {_horner(far, scalars.NORMAL_FAR_BOTTOM)}"
    return (
        f"CASE WHEN abs({q}) <= 0.425 THEN {middle} "
        f"ELSE sign({q}) * (CASE WHEN {tail} <= 5.0 THEN {outer_near} ELSE {outer_far} END) END"
    )


QQ = (
    f"ranked AS (SELECT {Y} AS value, row_number() OVER (ORDER BY {Y}) AS rank, count(*) OVER () AS n FROM profiled)",
    "placed AS (SELECT rank, value, CASE WHEN rank = n THEN power(0.5, 1.0 / n) WHEN rank = 1 THEN 1 - power(0.5, 1.0 / n) "
    "ELSE (rank - CAST(0.3175 AS DOUBLE)) / (n + CAST(0.365 AS DOUBLE)) END AS p FROM ranked)",
    f"points AS (SELECT rank, value, {_normal('p')} AS theoretical FROM placed)",
)

# --- preparation ----------------------------------------------------------------------------------------------------


def _mode(name: str, source: str, keys: str) -> str:
    return (
        f"{name} AS (SELECT {keys}, v FROM (SELECT {keys}, Outlet_Size AS v, row_number() OVER (PARTITION BY {keys} "
        f"ORDER BY count(*) DESC, Outlet_Size) AS rn FROM {source} WHERE Outlet_Size IS NOT NULL "
        f"GROUP BY {keys}, Outlet_Size) WHERE rn = 1)"
    )


SIZE_STEPS = (
    _mode("mode1", "base", "Outlet_Identifier"),
    "size1 AS (SELECT b.* REPLACE (coalesce(b.Outlet_Size, m.v) AS Outlet_Size) FROM base b LEFT JOIN mode1 m "
    "ON b.Outlet_Identifier = m.Outlet_Identifier)",
    _mode("mode2", "size1", "Outlet_Type, Outlet_Location_Type"),
    "size2 AS (SELECT b.* REPLACE (coalesce(b.Outlet_Size, m.v) AS Outlet_Size) FROM size1 b LEFT JOIN mode2 m "
    "ON b.Outlet_Type = m.Outlet_Type AND b.Outlet_Location_Type = m.Outlet_Location_Type)",
    "mode3 AS (SELECT Outlet_Size AS v FROM size2 WHERE Outlet_Size IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)",
    "sized AS (SELECT * REPLACE (coalesce(Outlet_Size, (SELECT v FROM mode3)) AS Outlet_Size) FROM size2)",
)
WEIGHT_STEPS = (
    "w_item AS (SELECT Item_Identifier, greatest(least(avg(Item_Weight), max(Item_Weight)), min(Item_Weight)) AS m FROM base GROUP BY 1)",
    "w_type AS (SELECT Item_Type, greatest(least(avg(Item_Weight), max(Item_Weight)), min(Item_Weight)) AS m FROM base GROUP BY 1)",
    "p_item AS (SELECT Item_Identifier, greatest(least(avg(Item_MRP), max(Item_MRP)), min(Item_MRP)) AS m FROM base GROUP BY 1)",
    "visible AS (SELECT Item_Type, quantile_cont(Item_Visibility, 0.5) AS m FROM base WHERE Item_Visibility > 0 GROUP BY 1)",
)
FILLED = "imputed AS (SELECT b.* REPLACE (coalesce(b.Item_Weight, wi.m, wt.m, (SELECT avg(Item_Weight) FROM base)) AS Item_Weight, " \
    "coalesce(b.Item_MRP, pi.m, (SELECT avg(Item_MRP) FROM base)) AS Item_MRP, " \
    "CASE WHEN b.Item_Visibility = 0 THEN coalesce(v.m, 0) ELSE b.Item_Visibility END AS Item_Visibility) FROM {source} b " \
    "LEFT JOIN w_item wi ON b.Item_Identifier = wi.Item_Identifier LEFT JOIN w_type wt ON b.Item_Type = wt.Item_Type " \
    "LEFT JOIN p_item pi ON b.Item_Identifier = pi.Item_Identifier LEFT JOIN visible v ON b.Item_Type = v.Item_Type)"

FEATURES = R.numeric_features


def _quantile(c: str, p: float, source: str) -> str:
    return f"(SELECT quantile_cont(CAST({c} AS DOUBLE), {p}) FROM {source})"


def _bounds_iqr(source: str, name: str) -> str:
    parts = [
        f"SELECT '{c}' AS \"column\", q1 - 1.5 * (q3 - q1) AS lower_bound, q3 + 1.5 * (q3 - q1) AS upper_bound FROM "
        f"(SELECT quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3 FROM {source})"
        for c in FEATURES
    ]
    return f"{name} AS ({' UNION ALL '.join(parts)})"


def _bounds_z(source: str, name: str, t: float) -> str:
    parts = [
        f"SELECT '{c}' AS \"column\", avg({c}) - {t} * stddev_samp({c}) AS lower_bound, "
        f"avg({c}) + {t} * stddev_samp({c}) AS upper_bound FROM {source}"
        for c in FEATURES
    ]
    return f"{name} AS ({' UNION ALL '.join(parts)})"


def _capped(c: str, bounds: str) -> str:
    limit = lambda side: f"(SELECT {side} FROM {bounds} WHERE \"column\" = '{c}')"
    return (
        f"CASE WHEN {c} < {limit('lower_bound')} THEN {limit('lower_bound')} "
        f"WHEN {c} > {limit('upper_bound')} THEN {limit('upper_bound')} ELSE CAST({c} AS DOUBLE) END AS {c}"
    )


def _edges(source: str) -> str:
    return f"edges AS (SELECT {', '.join(f'quantile_cont(Item_MRP, {p}) AS e{i}' for i, p in enumerate((0.2, 0.4, 0.6, 0.8), 1))} FROM {source})"


BAND = (
    "CASE WHEN Item_MRP IS NULL THEN NULL WHEN Item_MRP <= (SELECT e1 FROM edges) THEN 'Low' "
    "WHEN Item_MRP <= (SELECT e2 FROM edges) THEN 'Low-Med' WHEN Item_MRP <= (SELECT e3 FROM edges) THEN 'Medium' "
    "WHEN Item_MRP <= (SELECT e4 FROM edges) THEN 'Med-High' ELSE 'High' END AS MRP_Category"
)
ENCODING = (
    f"encoding AS (SELECT Outlet_Identifier, (sum({Y}) + 10 * (SELECT avg({Y}) FROM base)) / (count({Y}) + 10) AS e "
    "FROM base GROUP BY 1)"
)


def _featured(source: str, name: str) -> str:
    return (
        f"{name} AS (SELECT s.*, 2024 - Outlet_Establishment_Year AS Outlet_Age, {BAND}, "
        "Item_MRP / nullif(Item_Weight, 0) AS MRP_per_Weight, Item_Visibility / nullif(Item_MRP, 0) AS Visibility_MRP_Ratio, "
        "Item_MRP * (2024 - Outlet_Establishment_Year) AS MRP_x_Outlet_Age, "
        f"coalesce(e.e, (SELECT avg({Y}) FROM base)) AS Outlet_Target_Encoded FROM {source} s "
        "LEFT JOIN encoding e ON s.Outlet_Identifier = e.Outlet_Identifier)"
    )


ONE_HOT = {
    "Item_Type": ITEM_TYPES,
    "Outlet_Type": OUTLET_TYPES,
    "MRP_Category": ["High", "Low", "Low-Med", "Med-High", "Medium"],
}
SCALED_COLUMNS = [
    "Item_Weight", "Item_Visibility", "Item_MRP", "Outlet_Establishment_Year", "Outlet_Age", "MRP_per_Weight",
    "Visibility_MRP_Ratio", "MRP_x_Outlet_Age", "Outlet_Target_Encoded",
]


ORDINAL_CODES = {
    "Item_Fat_Content": "WHEN 'Low Fat' THEN 0 WHEN 'Regular' THEN 1",
    "Outlet_Location_Type": "WHEN 'Tier 3' THEN 0 WHEN 'Tier 2' THEN 1 WHEN 'Tier 1' THEN 2",
    "Outlet_Size": "WHEN 'Small' THEN 0 WHEN 'Medium' THEN 1 WHEN 'High' THEN 2",
}


def _ordinal(c: str) -> str:
    whens = ORDINAL_CODES[c]
    return f"CASE {c} {whens} END AS {c}"


def _one_hot(c: str, labels) -> list[str]:
    return [f"CASE WHEN coalesce({c}, 'nan') = '{v}' THEN 1.0 ELSE 0.0 END::DOUBLE AS \"{c}_{v}\"" for v in labels]


BLOCKS = [x for c, labels in ONE_HOT.items() for x in _one_hot(c, labels)]
BLOCK_NAMES = [f"{c}_{v}" for c, labels in ONE_HOT.items() for v in labels]
PREPARED = (
    *SIZE_STEPS,
    *WEIGHT_STEPS,
    FILLED.format(source="sized"),
    _bounds_iqr("imputed", "bounds"),
    _edges("imputed"),
    ENCODING,
    _featured("imputed", "fitted"),
    f"fitted_wide AS (SELECT *, {', '.join(BLOCKS)} FROM fitted)",
)


def _z(c: str) -> str:
    return (
        f"(\"{c}\" - (SELECT avg(\"{c}\") FROM fitted_wide)) / "
        f"(SELECT CASE WHEN stddev_pop(\"{c}\") = 0 THEN 1 ELSE stddev_pop(\"{c}\") END FROM fitted_wide)"
    )


def _fit_stats() -> str:
    rows = [f"SELECT 'mean' AS kind, '{c}' AS name, avg({c}) AS value FROM base" for c in ("Item_Weight", "Item_MRP")]
    rows += [f"SELECT '{side}' AS kind, \"column\" AS name, {side} AS value FROM bounds" for side in ("lower_bound", "upper_bound")]
    rows += [f"SELECT 'price_edge' AS kind, '{i}' AS name, e{i} AS value FROM edges" for i in range(1, 5)]
    for c in SCALED_COLUMNS + BLOCK_NAMES:
        rows += [
            f"SELECT 'scale_mean' AS kind, '{c}' AS name, avg(\"{c}\") AS value FROM fitted_wide",
            f"SELECT 'scale_std' AS kind, '{c}' AS name, stddev_pop(\"{c}\") AS value FROM fitted_wide",
        ]
    rows += [
        f"SELECT 'target' AS kind, '{name}' AS name, {f}({Y}) AS value FROM base"
        for name, f in (("mean", "avg"), ("low", "min"), ("high", "max"))
    ]
    return "SELECT kind, name, round(value, 7) AS value FROM (" + " UNION ALL ".join(rows) + ")"


_scaled_target = f"({Y} - (SELECT min({Y}) FROM sales)) / (SELECT max({Y}) - min({Y}) FROM sales)"
_log = f"ln(1 + {Y})"
_log_low, _log_high = f"(SELECT min({_log}) FROM sales)", f"(SELECT max({_log}) FROM sales)"
_log_scaled = f"({_log} - {_log_low}) / ({_log_high} - {_log_low})"

PREDICTED = f"predicted AS (SELECT *, CAST(0.9 AS DOUBLE) * {Y} + CAST(100.0 AS DOUBLE) AS p FROM sales)"


def on_predicted(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([SALES, PREDICTED, *ctes]) + "\n" + body


def _metrics(units: str, y: str, p: str, source: str) -> str:
    return (
        f"SELECT '{units}' AS units, count(*) AS n, round(avg(({y} - {p})**2), 6) AS mse, round(sqrt(avg(({y} - {p})**2)), 6) AS rmse, "
        f"round(avg(abs({y} - {p})), 6) AS mae, round(1 - sum(({y} - {p})**2) / sum(({y} - m)**2), 6) AS r2, "
        f"round(avg(abs(({y} - {p}) / nullif({y}, 0))) * 100, 6) AS mape FROM {source}, (SELECT avg({y}) AS m FROM {source})"
    )


def _r2(where: str) -> str:
    return (
        f"(SELECT 1 - sum(({Y} - p)**2) / (var_pop({Y}) * count(*)) FROM predicted WHERE {where})"
    )


def _group(by: str, cells: str) -> str:
    return on_profiled(f"SELECT {by}, {cells} FROM profiled WHERE {by} IS NOT NULL GROUP BY {by}")


MEAN, MEDIAN = f"round(avg({Y}), 4) AS mean", f"round(quantile_cont({Y}, 0.5), 4) AS median"
COUNT, STD = f"count({Y}) AS count", f"round(stddev_samp({Y}), 4) AS std"
IDS = ", ".join(R.ids)


def _band_rows() -> str:
    step = "(hi - lo) / 5.0"
    band = "CASE " + " ".join(
        f"WHEN Item_MRP <= lo + {i}.0 * ({step}) THEN '{label}'" for i, label in enumerate(R.price_labels[:-1], 1)
    ) + f" ELSE '{R.price_labels[-1]}' END"
    listed = ", ".join(f"('{label}')" for label in R.price_labels)
    return on_profiled(
        f"SELECT l.band, g.mean, coalesce(g.n, 0) AS n FROM (VALUES {listed}) l(band) LEFT JOIN ("
        f"SELECT {band} AS band, round(avg({Y}), 4) AS mean, count({Y}) AS n FROM profiled, "
        "(SELECT min(Item_MRP) AS lo, max(Item_MRP) AS hi FROM profiled) WHERE Item_MRP IS NOT NULL GROUP BY 1) g ON l.band = g.band"
    )


def _insights() -> str:
    gaps = ", ".join(f"CASE WHEN count(*) > count({c}) THEN '{c}' END" for c in ALL_COLUMNS)
    skew = f"(avg(({Y} - m)**3) / power(var_pop({Y}), 1.5))"
    strengths = " UNION ALL ".join(
        f"SELECT {i} AS place, '{c}' AS feature, abs({_pearson(c, Y)}) AS size FROM profiled" for i, c in enumerate(FEATURES)
    )
    many = " UNION ALL ".join(f"SELECT '{c}' AS feature FROM profiled HAVING count(DISTINCT {c}) > 20" for c in R.categorical)
    return on_profiled(
        f"""SELECT 'missing_values' AS rule_id, concat_ws(', ', {gaps}) <> '' AS triggered, concat_ws(', ', {gaps}) AS detail FROM profiled
UNION ALL SELECT 'skewed_target', abs({skew}) > 1, printf('%.3f', {skew}) FROM profiled, (SELECT avg({Y}) AS m FROM profiled)
UNION ALL SELECT 'top_correlation', true, feature || ' ' || printf('%.3f', size) FROM (SELECT * FROM ({strengths}) ORDER BY size DESC, place LIMIT 1)
UNION ALL SELECT 'high_cardinality', count(*) > 0, coalesce(string_agg(feature, ', ' ORDER BY feature), '') FROM ({many})
UNION ALL SELECT 'outlet_variation', cv > 0.3, printf('%.3f', cv) FROM (SELECT stddev_samp(m) / avg(m) AS cv FROM (
 SELECT avg({Y}) AS m FROM profiled GROUP BY Outlet_Identifier))"""
    )


ORACLE: dict[str, str] = {
    "dataset_shape": on_profiled("SELECT count(*) AS n_rows, CAST(12 AS BIGINT) AS n_cols FROM profiled"),
    "column_types": on_profiled(
        " UNION ALL ".join(
            f"SELECT {i} AS position, '{c}' AS \"column\", '{t}' AS data_type, count({c}) AS non_null FROM profiled"
            for i, (c, t) in enumerate(ALL_COLUMNS.items(), 1)
        )
    ),
    "describe_numeric": on_profiled(_describe("true"), NUMBERS),
    "describe_target": on_profiled(_describe(f"feature = '{Y}'"), NUMBERS),
    "missing_values": on_profiled(
        "SELECT * FROM ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing_count, "
            f"round((count(*) - count({c})) * 100.0::DOUBLE / count(*), 4) AS missing_pct FROM profiled"
            for c in ALL_COLUMNS
        )
        + ") WHERE missing_count > 0"
    ),
    "iqr_outliers": on_profiled(
        f"""SELECT round(q1, 4) AS q1, round(q3, 4) AS q3, round(q3 - q1, 4) AS iqr, round(q1 - 1.5 * (q3 - q1), 4) AS lower_bound,
 round(q3 + 1.5 * (q3 - q1), 4) AS upper_bound,
 count(*) FILTER (WHERE {Y} < q1 - 1.5 * (q3 - q1) OR {Y} > q3 + 1.5 * (q3 - q1)) AS outlier_count,
 round(count(*) FILTER (WHERE {Y} < q1 - 1.5 * (q3 - q1) OR {Y} > q3 + 1.5 * (q3 - q1)) * 100.0::DOUBLE / count(*), 4) AS outlier_pct
FROM profiled, (SELECT quantile_cont({Y}, 0.25) AS q1, quantile_cont({Y}, 0.75) AS q3 FROM profiled) GROUP BY q1, q3"""
    ),
    "distribution_shape": on_profiled(
        f"SELECT round(avg(({Y} - m)**3) / power(var_pop({Y}), 1.5), 6) AS skewness, "
        f"round(avg(({Y} - m)**4) / power(var_pop({Y}), 2) - 3, 6) AS kurtosis FROM profiled, (SELECT avg({Y}) AS m FROM profiled)"
    ),
    "correlation_matrix": on_profiled(
        _corr_rows([(a, b) for a in R.numeric for b in R.numeric], ["feature_a", "feature_b"])
    ),
    "corr_with_target": on_profiled(_corr_rows([(f,) for f in FEATURES], ["feature"])),
    "top_correlated": on_profiled(
        f"SELECT feature, corr, abs(corr) AS abs_corr FROM ({_corr_rows([(f,) for f in FEATURES], ['feature'])}) "
        "ORDER BY abs(corr) DESC, feature LIMIT 1"
    ),
    "value_counts": on_profiled("SELECT feature, value, count(*) AS n FROM labels_long GROUP BY 1, 2", LABELS),
    "cardinality": on_profiled(
        "SELECT feature, count(DISTINCT value) AS distinct_count FROM labels_long GROUP BY 1", ALL_LABELS
    ),
    "target_by_category": on_profiled(
        f"SELECT feature, value, {MEAN}, {MEDIAN}, {STD}, count({Y}) AS n FROM labels_long GROUP BY 1, 2", LABELS
    ),
    "outlet_performance": on_profiled(
        f"SELECT Outlet_Identifier, {MEAN}, {MEDIAN}, round(sum({Y}), 2) AS sum, {COUNT}, {STD}, "
        f"round(stddev_samp({Y}) / avg({Y}), 6) AS cv FROM profiled GROUP BY 1 ORDER BY avg({Y}) DESC, 1 LIMIT 10"
    ),
    "sales_by_year": _group(R.opened_year, f"{MEAN}, {COUNT}"),
    "sales_by_location": _group(R.outlet_location, MEAN),
    "item_type_stats": _group(R.item_type, f"{MEAN}, {MEDIAN}, {COUNT}, {STD}"),
    "fat_content_stats": _group(R.fat_content, f"{MEAN}, {MEDIAN}, {COUNT}"),
    "mrp_equal_width": _band_rows(),
    "pivot_type_size": _pivot(R.outlet_type, R.outlet_size, RAW_SIZES),
    "pivot_itemtype_outlettype": _pivot(R.item_type, R.outlet_type, RAW_OUTLET_TYPES),
    "pivot_fat_size": _pivot(R.fat_content, R.outlet_size, RAW_SIZES),
    "pivot_location_outlettype": _pivot(R.outlet_location, R.outlet_type, RAW_OUTLET_TYPES),
    "pivot_itemtype_location": _pivot(R.item_type, R.outlet_location, RAW_LOCATIONS),
    "anova_f": on_profiled(
        f"""SELECT feature, k, n, k - 1 AS df_between, n - k AS df_within, round((ssb / (k - 1)) / (ssw / (n - k)), 4) AS f_statistic
FROM (SELECT g.feature, count(*) AS k, CAST(sum(g.n) AS BIGINT) AS n, sum(g.n * (g.mean - t.mean)**2) AS ssb, sum(g.n * g.var) AS ssw
 FROM (SELECT feature, value, count(*) AS n, avg({Y}) AS mean, var_pop({Y}) AS var FROM labels_long GROUP BY 1, 2) g
 JOIN (SELECT feature, avg({Y}) AS mean FROM labels_long GROUP BY 1) t ON g.feature = t.feature GROUP BY g.feature) WHERE k > 1""",
        ALL_LABELS,
    ),
    "duplicate_rows": on_profiled(
        "SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS duplicate_rows FROM (SELECT count(*) AS c FROM profiled GROUP BY ALL, "
        + ", ".join(ALL_COLUMNS)
        + ")"
    ).replace("GROUP BY ALL, ", "GROUP BY "),
    "target_sign_checks": on_profiled(
        f"SELECT count(*) FILTER (WHERE {Y} < 0) AS negative_count, count(*) FILTER (WHERE {Y} = 0) AS zero_count FROM profiled"
    ),
    "distinct_labels": on_profiled("SELECT DISTINCT Item_Fat_Content AS value FROM profiled"),
    "id_prefix_counts": on_profiled("SELECT substr(Outlet_Identifier, 1, 3) AS prefix, count(*) AS n FROM profiled GROUP BY 1"),
    "between_group_cv": on_profiled(
        f"SELECT round(cv, 6) AS cv, cv > 0.3 AS high FROM (SELECT stddev_samp(m) / avg(m) AS cv FROM "
        f"(SELECT avg({Y}) AS m FROM profiled GROUP BY Outlet_Identifier))"
    ),
    "insights": _insights(),
    "histogram_target": _histogram([Y], 50, 4),
    "histogram_log_target": _histogram([Y], 50, 6, log=True),
    "histogram_features": _histogram(FEATURES, 30, 6),
    "box_stats": on_profiled(_box("", "profiled", Y)),
    "box_stats_by_category": on_profiled(_box("feature, value", "labels_long", Y), LABELS),
    "qq_points": on_profiled("SELECT rank, round(theoretical, 6) AS theoretical, round(value, 6) AS value FROM points", *QQ),
    "qq_fit": on_profiled(
        "SELECT round(regr_slope(value, theoretical), 4) AS slope, round(regr_intercept(value, theoretical), 4) AS intercept, "
        "round(corr(value, theoretical), 4) AS r, count(*) AS n FROM points",
        *QQ,
    ),
    "scatter_points": on_profiled(
        " UNION ALL ".join(
            f"SELECT '{f} vs {Y}' AS pair, CAST({f} AS DOUBLE) AS x, {Y} AS y FROM profiled WHERE {f} IS NOT NULL" for f in FEATURES
        )
    ),
    "pivot_cells": on_profiled(
        "SELECT Item_Identifier AS row_label, Outlet_Identifier AS column_label, round(avg(Item_Outlet_Sales), 8) AS mean "
        "FROM profiled GROUP BY 1, 2"
    ),
    "standardize_values": on_base(f"SELECT {IDS}, {', '.join(R.label_fixes)} FROM base"),
    "ordinal_encode": on_base(f"SELECT {IDS}, {', '.join(_ordinal(c) for c in R.ordinal)} FROM base"),
    "one_hot_encode": on_base(
        f"SELECT {IDS}, "
        + ", ".join(
            x
            for c, labels in (("Item_Type", ITEM_TYPES), ("Outlet_Type", OUTLET_TYPES), ("Outlet_Size", SIZES))
            for x in _one_hot(c, labels)
        )
        + " FROM base"
    ),
    "impute_weight": on_base(
        f"SELECT {IDS}, Item_Type, round(Item_Weight, 4) AS Item_Weight FROM imputed", *WEIGHT_STEPS, FILLED.format(source="base")
    ),
    "impute_mrp": on_base(
        f"SELECT {IDS}, Item_Type, round(Item_MRP, 4) AS Item_MRP FROM imputed", *WEIGHT_STEPS, FILLED.format(source="base")
    ),
    "impute_outlet_size": on_base(
        f"SELECT {IDS}, Outlet_Type, Outlet_Location_Type, Outlet_Size FROM sized", *SIZE_STEPS
    ),
    "zero_visibility_impute": on_base(
        f"SELECT {IDS}, Item_Type, round(Item_Visibility, 6) AS Item_Visibility FROM imputed",
        *WEIGHT_STEPS,
        FILLED.format(source="base"),
    ),
    "outlier_bounds_iqr": on_base(
        'SELECT "column", round(lower_bound, 6) AS lower_bound, round(upper_bound, 6) AS upper_bound FROM bounds',
        _bounds_iqr("base", "bounds"),
    ),
    "outlier_bounds_zscore": on_base(
        'SELECT "column", round(lower_bound, 6) AS lower_bound, round(upper_bound, 6) AS upper_bound FROM bounds',
        _bounds_z("base", "bounds", 3.0),
    ),
    "cap_outliers": on_base(
        f"SELECT {IDS}, {', '.join(f'round({c}, 6) AS {c}' for c in FEATURES)} FROM "
        f"(SELECT {IDS}, {', '.join(_capped(c, 'bounds') for c in FEATURES)} FROM base)",
        _bounds_z("base", "bounds", 1.0),
    ),
    "mrp_quintile_bins": on_base(f"SELECT {IDS}, Item_MRP, {BAND} FROM base", _edges("base")),
    "feature_engineering": on_base(
        f"SELECT {IDS}, Outlet_Age, MRP_Category, round(MRP_per_Weight, 6) AS MRP_per_Weight, "
        "round(Visibility_MRP_Ratio, 6) AS Visibility_MRP_Ratio, round(MRP_x_Outlet_Age, 6) AS MRP_x_Outlet_Age, "
        "round(Outlet_Target_Encoded, 6) AS Outlet_Target_Encoded FROM featured",
        _edges("base"),
        ENCODING,
        _featured("base", "featured"),
    ),
    "target_encode_fit": on_base(
        f"SELECT Outlet_Identifier, round((sum({Y}) + 10 * (SELECT avg({Y}) FROM base)) / (count({Y}) + 10), 4) AS encoding, "
        "count(*) AS n FROM base GROUP BY 1"
    ),
    "target_encode_apply": on_base(
        "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, b.Outlet_Identifier, round(coalesce(e.e, o.m), 4) AS Outlet_Target_Encoded "
        "FROM base b CROSS JOIN overall o LEFT JOIN enc e ON b.Outlet_Identifier = e.Outlet_Identifier",
        f"known AS (SELECT * FROM base WHERE NOT ({HELD_OUT}))",
        f"overall AS (SELECT avg({Y}) AS m FROM known)",
        f"enc AS (SELECT Outlet_Identifier, (sum({Y}) + 10 * (SELECT m FROM overall)) / (count({Y}) + 10) AS e FROM known GROUP BY 1)",
    ),
    "scale_features": on_base(
        f"SELECT {IDS}, "
        + ", ".join(
            f"round(({c} - (SELECT avg({c}) FROM base)) / (SELECT stddev_pop({c}) FROM base), 6) AS {c}" for c in FEATURES
        )
        + " FROM base"
    ),
    "scale_target": f"WITH {SALES} SELECT {IDS}, round({Y}, 8) AS {Y}, round({_scaled_target}, 8) AS scaled, round({_log_scaled}, 8) AS log_scaled FROM sales",
    "inverse_target": f"WITH {SALES} SELECT {IDS}, "
    f"round({_scaled_target} / 2 * (SELECT max({Y}) - min({Y}) FROM sales) + (SELECT min({Y}) FROM sales), 4) AS from_scaled, "
    f"round(exp({_log_scaled} / 2 * ({_log_high} - {_log_low}) + {_log_low}) - 1, 4) AS from_log_scaled FROM sales",
    "roundtrip_check": f"""WITH {SALES}, pairs AS (SELECT {Y} AS y, exp({_log_scaled} * ({_log_high} - {_log_low}) + {_log_low}) - 1 AS back FROM sales)
SELECT count(*) AS n, round(max(abs(y - back)), 6) AS max_abs_diff, round(max(abs(y - back) / y), 6) AS max_rel_diff,
 round(avg(abs(y - back) / y), 6) AS mean_rel_diff, bool_and(abs(y - back) <= 1e-8 + 1e-10 * abs(back)) AS all_close FROM pairs""",
    "prepare_fit_stats": on_base(_fit_stats(), *PREPARED),
    "prepare_transform": on_base(
        f"SELECT {IDS}, round({Y}, 5) AS {Y}, round({_scaled_target}, 5) AS scaled_target, "
        + ", ".join(R.ordinal)
        + ", "
        + ", ".join(f'round({_z(c)}, 5) AS "{c}"' for c in SCALED_COLUMNS + BLOCK_NAMES)
        + " FROM wide",
        *PREPARED,
        f"capped AS (SELECT * REPLACE ({', '.join(_capped(c, 'bounds') for c in FEATURES)}) FROM imputed)",
        _featured("capped", "transformed"),
        f"wide AS (SELECT * REPLACE ({', '.join(_ordinal(c) for c in R.ordinal)}), {', '.join(BLOCKS)} FROM transformed)",
    ),
    "ridge_cv_one_feature": f"""WITH {SALES},
d AS (SELECT (l_orderkey + 3 * l_partkey + l_linenumber) % 5 AS fold, {R.price} AS x, {Y} AS y FROM sales WHERE {R.price} IS NOT NULL),
fits AS (SELECT alpha, fold, my - w * mx AS b, w FROM (
  SELECT alpha, f.fold, avg(x) AS mx, avg(y) AS my, covar_pop(y, x) * count(*) / (var_pop(x) * count(*) + alpha) AS w
  FROM (SELECT DISTINCT fold FROM d) f JOIN d ON d.fold <> f.fold, (VALUES (0.1), (1.0), (10.0), (100.0)) a(alpha)
  GROUP BY alpha, f.fold))
SELECT CAST(alpha AS DOUBLE) AS alpha, CAST(fold AS INT) AS fold, round(any_value(w), 5) AS coefficient,
  round(any_value(b), 5) AS intercept, round(avg((y - b - w * x) * (y - b - w * x)), 1) AS mse
FROM fits JOIN d USING (fold) GROUP BY alpha, fold""",
    "best_of_fixed_members": f"""WITH {SALES},
d AS (SELECT {Y} AS y, 0.9 * {Y} + 100.0 AS p FROM sales WHERE {HELD_OUT}),
m AS (SELECT 'rf' AS model, y, p AS q FROM d UNION ALL SELECT 'gbt', y, 0.8 * y + 10.0 FROM d UNION ALL SELECT 'ridge', y, 0.5 * p FROM d)
SELECT model, round(1 - avg((y - q) * (y - q)) / var_pop(y), 6) AS r2 FROM m GROUP BY model ORDER BY 2 DESC LIMIT 1""",
    "split_counts": f"WITH {SALES} SELECT CASE WHEN {HELD_OUT} THEN 'test' ELSE 'train' END AS split, count(*) AS n FROM sales GROUP BY 1",
    "regression_metrics": on_predicted(
        _metrics("real", Y, "p", "predicted") + " UNION ALL " + _metrics("scaled", "sy", "sp", "scaled"),
        f"scaled AS (SELECT {_scaled_target} AS sy, (p - (SELECT min({Y}) FROM sales)) / (SELECT max({Y}) - min({Y}) FROM sales) AS sp FROM predicted)",
    ),
    "model_rating": on_predicted(
        "SELECT round(train_r2, 6) AS train_r2, round(test_r2, 6) AS test_r2, "
        "CASE WHEN test_r2 > 0.8 THEN 'Excellent' WHEN test_r2 > 0.7 THEN 'Good' WHEN test_r2 > 0.6 THEN 'Fair' "
        "ELSE 'Needs Improvement' END AS rating, CASE WHEN abs(train_r2 - test_r2) < 0.05 THEN 'No overfitting' "
        "WHEN abs(train_r2 - test_r2) < 0.1 THEN 'Slight overfitting' ELSE 'Significant overfitting' END AS overfitting "
        f"FROM (SELECT {_r2('NOT (' + HELD_OUT + ')')} AS train_r2, {_r2(HELD_OUT)} AS test_r2)"
    ),
    "clip_predictions": on_predicted(
        f"SELECT {IDS}, round(least(greatest(1.5 * p - 900, 0), (SELECT max({Y}) FROM sales)), 6) AS p FROM predicted"
    ),
    "prediction_stats": on_predicted(
        "SELECT round(avg(p), 4) AS mean, round(quantile_cont(p, 0.5), 4) AS median, round(stddev_pop(p), 4) AS std, "
        "round(min(p), 4) AS min, round(max(p), 4) AS max FROM predicted"
    ),
    "prediction_frame": on_predicted("SELECT Item_Identifier, round(p, 6) AS Predicted_Sales FROM predicted"),
    "ensemble_combine": on_predicted(
        f"SELECT {IDS}, round(0.4::DOUBLE * p + 0.4::DOUBLE * {Y} + 0.2::DOUBLE * (0.5::DOUBLE * p), 6) AS prediction FROM predicted"
    ),
}
