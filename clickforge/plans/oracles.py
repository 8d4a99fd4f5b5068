"""DuckDB oracle SQL for the registered queries (same names, same column names).

The driver pre-registers the raw tables as views; each text starts from
:func:`fixture.oracle_prelude` (the ``impressions`` fixture and its md5 split).
Floating columns are rounded to 6 places like the Spark side.
"""

from __future__ import annotations

import itertools

from clickforge.functions.hashing import HASH_SPAN, md5_bucket_sql, md5_place_sql, share_edges
from clickforge.plans.fixture_plan import FIXTURE_RULES
from clickforge.sources import fixture as fx

NUM, CAT, ID = fx.NUMERIC, fx.CATEGORICAL, fx.ID
FEATURES = NUM + CAT
PRE = fx.oracle_prelude()
ORACLES: dict[str, str] = {}
MIN = fx.MASK_MIN


def R(x: str) -> str:
    return f"round(CAST({x} AS DOUBLE), 6)"


def unnest_long(src: str, cols: list[str], ids: list[str], cast: str = "VARCHAR") -> str:
    names = ", ".join(f"'{c}'" for c in cols)
    vals = ", ".join(f"CAST({c} AS {cast})" for c in cols)
    idl = "".join(f"{i}, " for i in ids)
    return f"SELECT {idl}unnest([{names}]) AS feature, unnest([{vals}]) AS value FROM {src}"


def union_all(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


# ---- shared CTE fragments ----------------------------------------------------------------------

def stats_cte(src: str = "train") -> str:
    """One-row wide statistics of ``src``: med_/sd_/mx_/mn_/mean_/cnt_<col>."""
    cols = []
    for c in NUM:
        cols += [f"quantile_cont({c}, 0.5) AS med_{c}", f"stddev_samp({c}) AS sd_{c}", f"max({c}) AS mx_{c}",
                 f"min({c}) AS mn_{c}", f"avg({c}) AS mean_{c}", f"count({c}) AS cnt_{c}"]
    return f"SELECT {', '.join(cols)} FROM {src}"


def stats_long(src: str = "train") -> str:
    return union_all([f"SELECT '{c}' AS feature, count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS stddev, "
                      f"min({c}) AS min, max({c}) AS max, quantile_cont({c}, 0.5) AS median FROM {src}"
                      for c in NUM])


def std_expr(c: str, rule: str) -> str:
    x = f"coalesce({c}, s.med_{c})"
    num, den = {
        "scale2sd": (x, f"(2.0 * s.sd_{c})"),
        "scale1sd": (x, f"s.sd_{c}"),
        "median_z": (f"({x} - s.med_{c})", f"s.sd_{c}"),
        "max": (x, f"s.mx_{c}"),
    }[rule]
    return f"CASE WHEN {den} = 0 THEN CASE WHEN {num} IS NOT NULL THEN 0.0 END ELSE {num} / {den} END"


def filled_cte() -> str:
    fills = ", ".join(f"coalesce({c}, 'deadbeef') AS {c}" for c in CAT)
    return f"SELECT * REPLACE ({fills}) FROM imp"


def masked_cte(inclusive: bool = False, minimum: int = MIN) -> str:
    """``masked`` over all subsets: value kept when its filled-train count passes the threshold."""
    op = ">=" if inclusive else ">"
    cases = ", ".join(
        f"CASE WHEN {c} IS NULL THEN NULL WHEN {c} IN (SELECT value FROM freq WHERE feature = '{c}' "
        f"AND counts {op} {minimum}) THEN {c} ELSE 'rarebeef' END AS {c}" for c in CAT)
    return f"SELECT * REPLACE ({cases}) FROM filled"


def cat_freq_cte(src: str) -> str:
    return f"SELECT feature, value, count(*) AS counts FROM ({unnest_long(src, CAT, [])}) GROUP BY feature, value"


def index_ctes() -> str:
    """filled, freq, masked, mfreq (masked train counts), sidx (string index), offs, gidx."""
    order = " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(CAT))
    return (f", filled AS ({filled_cte()})\n"
            f", freq AS ({cat_freq_cte('(SELECT * FROM filled WHERE subset = ' + chr(39) + 'train' + chr(39) + ')')})\n"
            f", masked AS ({masked_cte()})\n"
            f", mfreq AS ({cat_freq_cte('(SELECT * FROM masked WHERE subset = ' + chr(39) + 'train' + chr(39) + ')')})\n"
            f", sidx AS (SELECT feature, value, counts, CAST(row_number() OVER (PARTITION BY feature ORDER BY counts DESC, "
            f"value ASC) - 1 AS INTEGER) AS idx FROM mfreq WHERE value IS NOT NULL)\n"
            f", widths AS (SELECT feature, count(*) AS width, CASE feature {order} END AS pos FROM sidx GROUP BY feature)\n"
            f", offs AS (SELECT feature, width, coalesce(sum(width) OVER (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING "
            f"AND 1 PRECEDING), 0) AS off FROM widths)\n"
            f", gidx AS (SELECT sidx.feature, value, idx, CAST(off + idx AS BIGINT) AS gidx FROM sidx JOIN offs "
            f"USING (feature))\n")


def q(name: str, sql: str) -> None:
    ORACLES[name] = sql


# ---- flagship and profiles --------------------------------------------------------------------

q("ctr_by_category", PRE + f", long AS ({unnest_long('train', CAT, ['label'])})\n"
  "SELECT feature, value, count(*) AS impressions, CAST(sum(label) AS BIGINT) AS clicks, "
  f"{R('sum(label) / count(*)')} AS ctr, "
  f"{R('CASE WHEN count(*) - sum(label) = 0 THEN NULL ELSE sum(label) / (count(*) - sum(label)) END')} AS pos_neg_ratio "
  "FROM long GROUP BY feature, value")

_null_rows = union_all([f"SELECT '{c}' AS feature, CAST(count(*) - count({c}) AS BIGINT) AS null_count, count(*) AS rows "
                        "FROM impressions" for c in FEATURES])
_null_sel = (f"SELECT feature, null_count, rows, {R('null_count * 100.0 / rows')} AS null_pct, "
             f"{R('(rows - null_count) / rows')} AS fill_rate FROM np")
q("null_profile", PRE + f", np AS ({_null_rows})\n" + _null_sel)
q("high_null_columns", PRE + f", np AS ({_null_rows})\nSELECT * FROM ({_null_sel}) WHERE null_count * 100.0 / rows > 5.0")

q("co_null_counts", PRE + "\n" + union_all([
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, CAST(count(*) FILTER (WHERE {a} IS NULL AND {b} IS NULL) AS BIGINT) AS both_null, "
    f"CAST(count(*) FILTER (WHERE {a} IS NULL) AS BIGINT) AS a_null FROM impressions"
    for a, b in itertools.combinations(FEATURES, 2)]))

q("label_by_null", PRE + "\n" + union_all([
    f"SELECT '{c}' AS feature, label, CAST(count(*) - count({c}) AS BIGINT) AS rows_null, count(*) AS rows_all "
    f"FROM impressions GROUP BY label" for c in FEATURES]))

_z = union_all([f"SELECT '{c}' AS feature, count(*) AS n, CAST(count(*) - count({c}) AS BIGINT) AS m, "
                f"avg(label) AS p1, CASE WHEN count(*) = count({c}) THEN NULL ELSE "
                f"sum(label) FILTER (WHERE {c} IS NULL) / (count(*) - count({c})) END AS p2 FROM train"
                for c in FEATURES])
q("null_label_ztest", PRE + f", zz AS ({_z}), z2 AS (SELECT *, CASE WHEN sqrt(p1*(1-p1)/n + p2*(1-p2)/m) = 0 THEN NULL "
  "ELSE (p1 - p2) / sqrt(p1*(1-p1)/n + p2*(1-p2)/m) END AS z FROM zz)\n"
  f"SELECT feature, n, m, {R('p1')} AS p1, {R('p2')} AS p2, {R('z')} AS z, abs(z) > 2.81 AS reject FROM z2")

q("complete_row_ratio", PRE + "SELECT count(*) AS rows, CAST(count(*) FILTER (WHERE "
  + " AND ".join(f"{c} IS NOT NULL" for c in FEATURES)
  + f") AS BIGINT) AS complete_rows, {R('count(*) FILTER (WHERE ' + ' AND '.join(f'{c} IS NOT NULL' for c in FEATURES) + ') / count(*)')} AS complete_ratio FROM impressions")

_desc = union_all([f"SELECT '{c}' AS feature, count({c}) AS count, {R(f'avg({c})')} AS mean, "
                   f"{R(f'stddev_samp({c})')} AS stddev, {R(f'min({c})')} AS min, {R(f'max({c})')} AS max FROM train"
                   for c in NUM])
q("numeric_describe", PRE + _desc)
q("describe_by_label", PRE + union_all([
    f"SELECT label, '{c}' AS feature, count({c}) AS count, {R(f'avg({c})')} AS mean, "
    f"{R(f'stddev_samp({c})')} AS stddev, {R(f'min({c})')} AS min, {R(f'max({c})')} AS max FROM train GROUP BY label"
    for c in NUM]))
q("numeric_measurements", PRE + f", st AS ({stats_long()})\nSELECT feature, count, {R('mean')} AS mean, "
  f"{R('stddev')} AS stddev, {R('min')} AS min, {R('max')} AS max, {R('median')} AS median FROM st")
q("median_skewness", PRE + f", st AS ({stats_long()})\nSELECT feature, "
  f"{R('CASE WHEN stddev = 0 THEN NULL ELSE 3 * (mean - median) / stddev END')} AS skewness FROM st")

q("category_frequencies", PRE + cat_freq_cte("train"))
q("category_shares", PRE + f", f AS ({cat_freq_cte('train')})\nSELECT feature, value, counts, "
  f"{R('counts * 100.0 / sum(counts) OVER (PARTITION BY feature)')} AS share_pct FROM f")
q("top_k_values", PRE + f", f AS ({cat_freq_cte('train')})\nSELECT * FROM (SELECT feature, value, counts, "
  "CAST(row_number() OVER (PARTITION BY feature ORDER BY counts DESC, value ASC NULLS FIRST) AS INTEGER) AS rank "
  "FROM f) WHERE rank <= 5")
q("distinct_counts", PRE + f", f AS ({cat_freq_cte('impressions')})\n"
  "SELECT feature, count(value) AS distinct_values FROM f GROUP BY feature")
q("threshold_cardinality", PRE + f", filled AS ({filled_cte()})\n, f AS ({cat_freq_cte('(SELECT * FROM filled WHERE subset = ' + chr(39) + 'train' + chr(39) + ')')})\n"
  f", tc AS (SELECT feature, count(*) AS distinct_values, CAST(sum(CASE WHEN counts > {MIN} THEN 1 ELSE 0 END) AS BIGINT) AS frequent, "
  f"CAST(sum(CASE WHEN counts >= {MIN} THEN 1 ELSE 0 END) AS BIGINT) AS frequent_inclusive, "
  f"CAST(sum(CASE WHEN counts <= {MIN} THEN 1 ELSE 0 END) AS BIGINT) AS uncommon, "
  f"CAST(sum(CASE WHEN counts <= {MIN} THEN counts ELSE 0 END) AS BIGINT) AS uncommon_rows, "
  f"CAST(sum(CASE WHEN counts > {MIN} THEN 1 ELSE 0 END) + CASE WHEN sum(CASE WHEN counts <= {MIN} THEN 1 ELSE 0 END) > 0 "
  "THEN 1 ELSE 0 END AS BIGINT) AS width_after_mask FROM f GROUP BY feature)\n"
  "SELECT *, CAST(sum(width_after_mask) OVER (ORDER BY feature ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) "
  "AS BIGINT) AS running_width FROM tc")
q("masked_cardinality", PRE + index_ctes() + "SELECT feature, count(DISTINCT value) AS cardinality FROM ("
  + unnest_long("(SELECT * FROM masked WHERE subset = 'train')", CAT, []) + ") GROUP BY feature")

HIST_BINS = {"n01": 50, "n02": 12, "n03": 10, "n04": 7, "n05": 1000, "n06": 25, "n07": 5000, "n08": 400, "n09": 50}
_bounds = union_all([f"SELECT '{c}' AS feature, {HIST_BINS[c]} AS n, min({c}) AS lo, max({c}) AS hi FROM train" for c in NUM])
q("equal_width_histogram", PRE + f", bounds AS ({_bounds})\n, lv AS ({unnest_long('train', NUM, [], 'DOUBLE')})\n"
  ", cnt AS (SELECT feature, CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((value - lo) / (hi - lo) * n), n - 1) END "
  "AS INTEGER) AS bin, count(*) AS count FROM lv JOIN bounds USING (feature) WHERE value IS NOT NULL GROUP BY 1, 2)\n"
  ", grid AS (SELECT feature, n, lo, hi, CAST(unnest(range(0, n)) AS INTEGER) AS bin FROM bounds WHERE lo IS NOT NULL)\n"
  f"SELECT feature, bin, {R('lo + (hi - lo) / n * bin')} AS lower, "
  f"{R('CASE WHEN bin = n - 1 THEN hi ELSE lo + (hi - lo) / n * (bin + 1) END')} AS upper, "
  "CAST(coalesce(count, 0) AS BIGINT) AS count FROM grid LEFT JOIN cnt USING (feature, bin)")

q("numeric_frequencies", PRE + f", st AS ({stats_long()})\n, g AS (SELECT feature, value, count(*) AS count FROM ("
  + unnest_long("train", NUM, [], "DOUBLE") + ") WHERE value IS NOT NULL GROUP BY feature, value)\n"
  f"SELECT g.feature, {R('value')} AS value, g.count, {R('CASE WHEN stddev = 0 THEN NULL ELSE (value - median) / stddev END')} AS normed "
  "FROM g JOIN st USING (feature)")

q("special_value_counts", PRE + union_all(
    [f"SELECT '{c}' AS feature, 'eq' AS op, CAST({v} AS DOUBLE) AS special, CAST(count(*) FILTER (WHERE {c} = {v}) AS BIGINT) AS rows FROM impressions"
     for c in NUM for v in ("-1.0", "0.0")]
    + [f"SELECT '{c}' AS feature, 'lt' AS op, 0.0 AS special, CAST(count(*) FILTER (WHERE {c} < 0) AS BIGINT) AS rows FROM impressions"
       for c in NUM]))

q("log_transform", PRE + "SELECT imp_id, " + ", ".join(
    f"{R(f'CASE WHEN {c} > 0 THEN ln({c}) END')} AS log_{c}" for c in NUM) + " FROM impressions")

q("correlation_matrix", PRE + union_all([f"SELECT '{a}' AS col_a, '{b}' AS col_b, {R(f'corr({a}, {b})')} AS corr FROM train"
                                         for a, b in itertools.combinations(NUM, 2)]))

q("label_distribution", PRE + "SELECT subset, label, count(*) AS rows, "
  f"{R('count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY subset)')} AS pct FROM imp GROUP BY subset, label")
q("balance_rate", PRE + f"SELECT count(*) AS rows, CAST(sum(label) AS BIGINT) AS positives, {R('avg(label)')} AS balance_rate FROM train")

# ---- nulls, imputation, standardisation -------------------------------------------------------

q("impute_numeric", PRE + f", s AS ({stats_cte()})\nSELECT imp_id, subset, "
  + ", ".join(f"{R(f'coalesce({c}, s.med_{c})')} AS {c}" for c in NUM) + " FROM imp, s")
q("fill_categorical", PRE + "SELECT imp_id, " + ", ".join(f"coalesce({c}, 'deadbeef') AS {c}" for c in CAT) + " FROM impressions")
q("standardize", PRE + f", s AS ({stats_cte()})\nSELECT imp_id, subset, "
  + ", ".join(f"{R(std_expr(c, r))} AS {c}_std" for c, r in FIXTURE_RULES.items()) + " FROM imp, s")
q("unit_variance_scale", PRE + f", s AS ({stats_cte()})\n, f AS (SELECT imp_id, subset, "
  + ", ".join(f"coalesce({c}, s.med_{c}) AS {c}" for c in NUM) + " FROM imp, s)\n"
  ", sd AS (SELECT " + ", ".join(f"stddev_samp({c}) AS sd_{c}" for c in NUM) + " FROM f WHERE subset = 'train')\n"
  "SELECT imp_id, subset, " + ", ".join(
      f"{R(f'CASE WHEN sd_{c} = 0 THEN 0.0 ELSE {c} / sd_{c} END')} AS {c}_uv" for c in NUM) + " FROM f, sd")

# ---- masking and encoding ---------------------------------------------------------------------

q("mask_uncommon", PRE + index_ctes() + "SELECT imp_id, subset, " + ", ".join(CAT) + " FROM masked")
q("mask_uncommon_inclusive", PRE + f", filled AS ({filled_cte()})\n, freq AS ("
  + cat_freq_cte("(SELECT * FROM filled WHERE subset = 'train')") + f")\n, masked AS ({masked_cte(True)})\n"
  "SELECT imp_id, subset, " + ", ".join(CAT) + " FROM masked")
q("replace_values", PRE + "SELECT imp_id, CASE WHEN c06 IN ('BUILDING', 'MACHINERY') THEN 'rarebeef' ELSE c06 END AS c06 FROM impressions")
q("string_index", PRE + index_ctes() + "SELECT feature, value, counts, idx FROM sidx")
q("one_hot_long", PRE + index_ctes() + ", ml AS (" + unnest_long("masked", CAT, ["imp_id", "subset"]) + ")\n"
  "SELECT imp_id, subset, feature, idx, gidx FROM ml JOIN gidx USING (feature, value)")


# ---- selection, crosses, packing --------------------------------------------------------------

STD_SQL = {c: std_expr(c, r) for c, r in FIXTURE_RULES.items()}
_MT = "(SELECT * FROM masked WHERE subset = 'train')"
_CHI = (PRE + index_ctes() +
        f", tot AS (SELECT CAST(count(*) AS DOUBLE) AS bn, CAST(sum(label) AS DOUBLE) AS bp FROM {_MT})\n"
        f", vc AS (SELECT feature, value, count(*) AS n, sum(label) AS a FROM ({unnest_long(_MT, CAT, ['label'])}) "
        "GROUP BY feature, value)\n"
        ", j AS (SELECT gidx, g.feature, g.value, CAST(coalesce(n, 0) AS DOUBLE) AS n, CAST(coalesce(a, 0) AS DOUBLE) AS a, "
        "bn, bp FROM gidx g LEFT JOIN vc USING (feature, value), tot)\n"
        ", sc AS (SELECT gidx, feature, value, CAST(n AS BIGINT) AS n, CAST(a AS BIGINT) AS a, "
        "CASE WHEN n * (bn - n) * bp * (bn - bp) = 0 THEN 0.0 ELSE bn * ((a * (bn - n - bp + a) - (n - a) * (bp - a)) * "
        "(a * (bn - n - bp + a) - (n - a) * (bp - a))) / (n * (bn - n) * bp * (bn - bp)) END AS stat FROM j)\n")
q("chi2_scores", _CHI + f"SELECT gidx, feature, value, n, a, {R('stat')} AS stat FROM sc")
q("chi2_top_n", _CHI + ", top AS (SELECT * FROM sc ORDER BY stat DESC, gidx ASC LIMIT 20)\n"
  f"SELECT gidx, CAST(row_number() OVER (ORDER BY gidx) - 1 AS INTEGER) AS pos, feature, value, {R('stat')} AS stat FROM top")

_STDM = (f", s AS ({stats_cte()})\n, sm AS (SELECT masked.*, " + ", ".join(f"{e} AS {c}_std" for c, e in STD_SQL.items())
         + " FROM masked, s)\n")
q("cross_long", PRE + index_ctes() + _STDM +
  ", kk AS (SELECT count(*) AS k FROM sidx)\n"
  ", hot AS (SELECT imp_id, subset, feature, value, [" + ", ".join(f"{c}_std" for c in NUM) + "] AS xs FROM ("
  "SELECT *, unnest([" + ", ".join(f"'{c}'" for c in CAT) + "]) AS feature, unnest([" + ", ".join(CAT)
  + "]) AS value FROM sm))\n"
  ", hx AS (SELECT imp_id, subset, gidx, unnest(range(0, 9)) AS i, unnest(xs) AS xv FROM hot JOIN gidx USING (feature, value))\n"
  f"SELECT subset, CAST(i * k + gidx AS BIGINT) AS cidx, count(*) AS entries, {R('sum(xv)')} AS sum_value FROM hx, kk GROUP BY 1, 2")

_ROWS = (", kk AS (SELECT count(*) AS k FROM sidx)\n, hits AS (SELECT imp_id, count(*) AS h, sum(gidx) AS places FROM ("
         + unnest_long("sm", CAT, ["imp_id"]) + ") JOIN gidx USING (feature, value) GROUP BY imp_id)\n")
q("pack_weights", PRE + index_ctes() + _STDM + _ROWS + ", br AS (SELECT avg(label) AS rate FROM train)\n"
  f"SELECT sm.imp_id, sm.subset, sm.label, {R('CASE WHEN label = 0 THEN rate ELSE 1.0 - rate END')} AS weight, "
  f"CAST({len(NUM)} + k AS INTEGER) AS width, " + R(" + ".join(f"{c}_std" for c in NUM) + " + coalesce(h, 0)") + " AS mass, CAST("
  + " + ".join(f"CASE WHEN {c}_std <> 0 THEN 1 ELSE 0 END" for c in NUM)
  + " + coalesce(h, 0) AS BIGINT) AS entries FROM sm LEFT JOIN hits USING (imp_id), br, kk")
q("sparse_to_dense", PRE + index_ctes() + _STDM + _ROWS +
  "SELECT sm.imp_id, CAST(k AS INTEGER) AS width, CAST(coalesce(h, 0) AS DOUBLE) AS mass, CAST(coalesce(places, 0) AS DOUBLE) AS places "
  "FROM sm LEFT JOIN hits USING (imp_id), kk")

_STDS = "[" + ", ".join(f"{c}_std" for c in NUM) + "]"
q("packed_entries", _CHI + _STDM + ", top AS (SELECT * FROM sc ORDER BY stat DESC, gidx ASC LIMIT 20)\n"
  ", pk AS (SELECT feature, value, row_number() OVER (ORDER BY gidx) - 1 AS pos FROM top)\n"
  f", hot AS (SELECT imp_id, subset, xs, pos FROM (SELECT *, {_STDS} AS xs, unnest([" + ", ".join(f"'{c}'" for c in CAT)
  + "]) AS feature, unnest([" + ", ".join(CAT) + "]) AS value FROM sm) JOIN pk USING (feature, value))\n"
  f", allv AS (SELECT subset, idx, v FROM (SELECT subset, unnest(range(0, 9)) AS idx, unnest({_STDS}) AS v FROM sm) WHERE v <> 0\n"
  " UNION ALL SELECT subset, 9 + pos, 1.0 FROM hot\n"
  " UNION ALL SELECT subset, 29 + 20 * i + pos, v FROM (SELECT subset, pos, unnest(range(0, 9)) AS i, unnest(xs) AS v FROM hot) WHERE v <> 0)\n"
  f"SELECT subset, CAST(idx AS BIGINT) AS idx, count(*) AS entries, {R('sum(v)')} AS sum_value FROM allv GROUP BY 1, 2")

q("assembled_long", PRE + index_ctes() + _STDM +
  ", nums AS (SELECT unnest(range(0, 9)) AS idx, unnest([" + ", ".join(f"{c}_std" for c in NUM) + "]) AS value FROM sm)\n"
  ", hot AS (SELECT " + str(len(NUM)) + " + gidx AS idx, 1.0 AS value FROM (" + unnest_long("sm", CAT, []) + ") JOIN gidx USING (feature, value))\n"
  ", allv AS (SELECT idx, value FROM nums WHERE value <> 0 UNION ALL SELECT idx, value FROM hot)\n"
  f"SELECT CAST(idx AS INTEGER) AS idx, count(*) AS entries, {R('sum(value)')} AS sum_value FROM allv GROUP BY idx")

# ---- splits and rebalancing -------------------------------------------------------------------


q("hash_split_counts", PRE + "SELECT subset, count(*) AS rows, CAST(sum(label) AS BIGINT) AS positives FROM imp GROUP BY subset")
q("holdout_split", PRE + f"SELECT CASE WHEN {md5_place_sql('imp_id', 1)} < {share_edges((0.8, 0.2))[0]} THEN 'fit' ELSE 'holdout' END AS part, "
  "count(*) AS rows, CAST(sum(label) AS BIGINT) AS positives FROM train GROUP BY 1")
q("uneven_split", PRE + "SELECT CASE WHEN p < " + str(share_edges((0.995, 0.004, 0.001))[0]) + " THEN 'train' WHEN p < "
  + str(share_edges((0.995, 0.004, 0.001))[1]) + " THEN 'tests' ELSE 'valid' END AS part, count(*) AS rows, "
  f"CAST(sum(label) AS BIGINT) AS positives FROM (SELECT label, {md5_place_sql('imp_id', 5)} AS p FROM impressions) GROUP BY 1")
q("tiny_rate_sample", PRE + f"SELECT imp_id, label FROM impressions WHERE label = 1 OR {md5_place_sql('imp_id', 13)} < {int(1e-5 * HASH_SPAN)}")
q("toy_subsample", PRE + "SELECT imp_id, label FROM train ORDER BY md5('2019:' || imp_id), imp_id LIMIT 1000")

_OVER = (", cnt AS (SELECT CAST(sum(label) AS BIGINT) AS pos, CAST(count(*) - sum(label) AS BIGINT) AS neg FROM train)\n"
         ", r AS (SELECT CASE WHEN pos = 0 THEN 0.0 ELSE CAST(neg - pos AS DOUBLE) / pos END AS rate FROM cnt)\n"
         ", kk AS (SELECT floor(rate) AS whole, CAST(floor((rate - floor(rate)) * " + str(HASH_SPAN) + ") AS BIGINT) AS extra FROM r)\n"
         f", t AS (SELECT imp_id, label, CASE WHEN label = 1 THEN whole + CASE WHEN {md5_place_sql('imp_id', 7)} "
         "< extra THEN 1 ELSE 0 END ELSE 0 END AS k FROM train, kk)\n"
         ", over AS (SELECT imp_id, label, 0 AS copy FROM train UNION ALL "
         "SELECT imp_id, label, CAST(unnest(range(1, CAST(k AS BIGINT) + 1)) AS INTEGER) AS copy FROM t WHERE k > 0)\n")
q("oversample_exact", PRE + _OVER + "SELECT imp_id, label, CAST(copy AS INTEGER) AS copy FROM over")
q("union_all_counts", PRE + _OVER + "SELECT label, count(*) AS rows FROM over GROUP BY label")
q("undersample_hash", PRE + ", cnt AS (SELECT CAST(sum(label) AS BIGINT) AS pos, CAST(count(*) - sum(label) AS BIGINT) AS neg FROM train)\n"
  f", r AS (SELECT CAST(floor(CASE WHEN neg = 0 THEN 1.0 ELSE CAST(pos AS DOUBLE) / neg END * {HASH_SPAN}) AS BIGINT) AS thr FROM cnt)\n"
  f"SELECT imp_id, label FROM train, r WHERE label = 1 OR {md5_place_sql('imp_id', 11)} < thr")

# ---- evaluation -------------------------------------------------------------------------------

_SCORED = (", sco AS (SELECT imp_id, subset, label, n01 * n05 AS score, CASE WHEN n01 * n05 > 2000000 THEN 1 ELSE 0 END "
           "AS prediction FROM imp)\n")
q("rank_auc", PRE + _SCORED +
  ", ag AS (SELECT subset, score, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS neg "
  "FROM sco GROUP BY subset, score)\n"
  ", cu AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY subset ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM ag)\n"
  "SELECT subset, CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives, "
  f"{R('sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg))')} AS auc FROM cu GROUP BY subset")
_CONF = (", cf AS (SELECT subset, count(*) FILTER (WHERE prediction > 0 AND label = 1) AS tp, "
         "count(*) FILTER (WHERE prediction > 0 AND label <> 1) AS fp, count(*) FILTER (WHERE prediction <= 0 AND label <> 1) AS tn, "
         "count(*) FILTER (WHERE prediction <= 0 AND label = 1) AS fn FROM sco GROUP BY subset)\n")
q("hard_label_auc", PRE + _SCORED + _CONF + f"SELECT subset, {R('(tp / (tp + fn) + tn / (tn + fp)) / 2')} AS auc FROM cf")
q("confusion_metrics", PRE + _SCORED + _CONF +
  ", pr AS (SELECT *, CASE WHEN tp + fp = 0 THEN NULL ELSE tp / (tp + fp) END AS precision, "
  "CASE WHEN tp + fn = 0 THEN NULL ELSE tp / (tp + fn) END AS recall FROM cf)\n"
  f"SELECT subset, tp, fp, tn, fn, {R('precision')} AS precision, {R('recall')} AS recall, "
  f"{R('CASE WHEN precision + recall = 0 THEN NULL ELSE 2 * precision * recall / (precision + recall) END')} AS f1 FROM pr")

# ---- hand-written SVM -------------------------------------------------------------------------

_D = len(NUM)
_X = [f"x{i}" for i in range(_D + 1)]


def _margin(w: str) -> str:
    e = "0.0"
    for i in range(_D + 1):
        e = f"({e} + {w}_{i} * x{i})"
    return e


def _svm_steps(k: int) -> str:
    parts = [", pts AS (SELECT imp_id, subset, CASE WHEN label = 0 THEN -1 ELSE label END AS y, 1.0 AS x0, "
             + ", ".join(f"{STD_SQL[c]} AS x{i + 1}" for i, c in enumerate(NUM)) + " FROM imp, s)\n",
             ", tr AS (SELECT * FROM pts WHERE subset = 'train')\n",
             ", w0 AS (SELECT avg(y) AS w0_0, " + ", ".join(f"0.0 AS w0_{i}" for i in range(1, _D + 1)) + " FROM tr)\n"]
    for s in range(1, k + 1):
        p = f"w{s - 1}"
        m = _margin(p)
        parts.append(f", g{s} AS (SELECT count(*) AS n, " + ", ".join(
            f"sum(CASE WHEN y * {m} < 1 THEN y * x{j} ELSE 0.0 END) AS g_{j}" for j in range(_D + 1)) + f" FROM tr, {p})\n")
        parts.append(f", w{s} AS (SELECT " + ", ".join(
            f"{p}_{j} - 0.1 * ((-g_{j}) / n" + (f" + 0.1 * {p}_{j}" if j > 0 else " + 0.0") + f") AS w{s}_{j}"
            for j in range(_D + 1)) + f" FROM {p}, g{s})\n")
    return PRE + f", s AS ({stats_cte()})\n" + "".join(parts)


q("svm_baseline", _svm_steps(0) + "SELECT CAST(unnest(range(0, 10)) AS INTEGER) AS idx, "
  f"unnest([{R('w0_0')}, " + ", ".join(f"{R(f'w0_{i}')}" for i in range(1, _D + 1)) + "]) AS weight FROM w0")
q("hinge_loss", _svm_steps(0) + f"SELECT subset, {R('avg(greatest(0.0, 1 - y * ' + _margin('w0') + '))')} AS hinge_loss "
  "FROM pts, w0 GROUP BY subset")
q("svm_one_step", _svm_steps(2) + union_all([
    f"SELECT {s} AS step, CAST(unnest(range(0, 10)) AS INTEGER) AS idx, unnest([" + ", ".join(
        R(f"w{s}_{j}") for j in range(_D + 1)) + f"]) AS weight FROM w{s}" for s in (1, 2)]))
q("svm_predict", _svm_steps(2) + f"SELECT imp_id, subset, y, CASE WHEN {_margin('w2')} >= 0 THEN 1 ELSE -1 END AS prediction "
  "FROM pts, w2")
q("labelled_points", _svm_steps(0) + "SELECT imp_id, y, " + ", ".join(f"{R(x)} AS {x}" for x in _X)
  + " FROM pts WHERE subset = 'train'")
q("label_recode", PRE + "SELECT imp_id, label, CASE WHEN label = 0 THEN -1 ELSE label END AS y, "
  "CASE WHEN (CASE WHEN label = 0 THEN -1 ELSE label END) = -1 THEN 0 ELSE (CASE WHEN label = 0 THEN -1 ELSE label END) END AS back "
  "FROM impressions")

# ---- projection, filters, small sources -------------------------------------------------------

q("project_rename_cast_drop", PRE + "SELECT imp_id, label, n01, CAST(n04 AS INTEGER) AS n04, c01 AS flag FROM impressions")
q("columns_by_pattern", PRE + "SELECT imp_id, " + ", ".join(
    f"{R(f'CAST(CAST({c} AS FLOAT) AS DOUBLE)')} AS {c}" for c in NUM) + " FROM impressions")
q("row_counts", PRE + "SELECT count(*) AS rows, count(*) FILTER (WHERE label = 1) AS positives, "
  "count(*) FILTER (WHERE label = 0) AS negatives FROM impressions")
q("inline_rows", PRE + f", st AS ({stats_long()})\n, rules AS (SELECT * FROM (VALUES "
  + ", ".join(f"('{c}', '{r}')" for c, r in FIXTURE_RULES.items()) + ") v(feature, rule))\n"
  f"SELECT feature, rule, {R(chr(39).join(['CASE WHEN rule = ', 'median_z', ' THEN median ELSE 0.0 END']))} AS centre, "
  f"{R(chr(39).join(['CASE WHEN rule = ', 'scale2sd', ' THEN 2.0 * stddev WHEN rule = ', 'max', ' THEN max ELSE stddev END']))} "
  "AS divisor FROM rules JOIN st USING (feature)")
q("first_n_ordered", PRE + f"SELECT imp_id, {R('n07')} AS n07, label FROM train WHERE label = 1 ORDER BY n07 DESC, imp_id ASC LIMIT 20")
# ---- sources and sinks ------------------------------------------------------------------------

_IMP_COLS = ["imp_id", "label", "label_noise"] + NUM + CAT
q("tsv_round_trip", PRE + "SELECT imp_id, label, label_noise, " + ", ".join(R(c) + f" AS {c}" for c in NUM) + ", "
  + ", ".join(CAT) + " FROM impressions")
q("raw_field_profile", PRE + union_all([
    f"SELECT {i} AS field, count(*) AS rows, count(*) - count({c}) AS empty, count(DISTINCT {c}) AS distinct_values "
    "FROM impressions" for i, c in enumerate(_IMP_COLS)]))
q("parquet_preview", PRE + f"SELECT imp_id, {R('n05')} AS n05, c07 FROM train WHERE label = 1 AND n02 IS NULL "
  "ORDER BY n05 DESC, imp_id LIMIT 20")
q("stats_round_trip", ORACLES["numeric_measurements"])


# ---- more library-stage checks ----------------------------------------------------------------

q("impute_mean", PRE + f", s AS ({stats_cte()})\nSELECT imp_id, subset, "
  + ", ".join(f"{R(f'coalesce({c}, s.mean_{c})')} AS {c}_imp" for c in NUM) + " FROM imp, s")
q("chi2_selector_picks", _CHI + ", top AS (SELECT * FROM sc ORDER BY stat DESC, gidx ASC LIMIT 20)\n"
  "SELECT gidx, CAST(row_number() OVER (ORDER BY gidx) - 1 AS INTEGER) AS pos FROM top")


# ---- the whole preparation run ----------------------------------------------------------------

q("prep_flow", PRE + index_ctes() + ", kk AS (SELECT count(*) AS k FROM sidx), br AS (SELECT avg(label) AS rate FROM train)\n"
  f"SELECT subset, count(*) AS rows, CAST(sum(label) AS BIGINT) AS positives, "
  f"{R('sum(CASE WHEN label = 0 THEN rate ELSE 1.0 - rate END)')} AS weight_sum, "
  f"CAST({len(NUM)} + 20 + {len(NUM)} * k AS INTEGER) AS width FROM imp, br, kk GROUP BY subset, k")


q("normed_frame", PRE + f", s AS ({stats_cte()})\nSELECT imp_id, subset, label, "
  + ", ".join(f"{R(std_expr(c, r))} AS s{i}" for i, (c, r) in enumerate(FIXTURE_RULES.items())) + ", "
  + ", ".join(f"coalesce({c}, 'deadbeef') AS {c}" for c in CAT) + " FROM imp, s")
q("toy_click_ratio", PRE + ", toy AS (SELECT imp_id, label FROM train ORDER BY md5('2019:' || imp_id), imp_id LIMIT 1000)\n"
  f"SELECT count(*) AS rows, CAST(sum(label) AS BIGINT) AS clicks, {R('sum(label) * 100.0 / count(*)')} AS click_pct FROM toy")
q("raw_field_counts", PRE + f"SELECT {len(_IMP_COLS)} AS fields, count(*) AS lines FROM impressions")


q("interaction_entries", ORACLES["cross_long"].replace(
    "FROM hx, kk GROUP BY 1, 2", "FROM hx, kk WHERE xv <> 0 GROUP BY 1, 2"))

q("string_indexer_labels", PRE + index_ctes() + "SELECT feature, value, idx FROM sidx")


def _svm_chain(tag: str, src: str, steps: int, lr: float, reg: float) -> str:
    """CTEs ``{tag}w0 .. {tag}w{steps}``: baseline on ``src`` then ``steps`` sub-gradient updates."""
    parts = [f", {tag}w0 AS (SELECT avg(y) AS {tag}w0_0, " + ", ".join(f"0.0 AS {tag}w0_{i}" for i in range(1, _D + 1))
             + f" FROM {src})\n"]
    for k in range(1, steps + 1):
        p_ = f"{tag}w{k - 1}"
        m = _margin(p_)
        parts.append(f", {tag}g{k} AS (SELECT count(*) AS n, " + ", ".join(
            f"sum(CASE WHEN y * {m} < 1 THEN y * x{j} ELSE 0.0 END) AS g_{j}" for j in range(_D + 1))
            + f" FROM {src}, {p_})\n")
        parts.append(f", {tag}w{k} AS (SELECT " + ", ".join(
            f"{p_}_{j} - {lr} * ((-g_{j}) / n" + (f" + {reg} * {p_}_{j}" if j > 0 else " + 0.0") + f") AS {tag}w{k}_{j}"
            for j in range(_D + 1)) + f" FROM {p_}, {tag}g{k})\n")
    return "".join(parts)


def _svm_points() -> str:
    b, edge = md5_place_sql("imp_id", 1), share_edges((0.8, 0.2))[0]
    return (f", s AS ({stats_cte()})\n"
            ", pts AS (SELECT imp_id, subset, CASE WHEN label = 0 THEN -1 ELSE label END AS y, 1.0 AS x0, "
            + ", ".join(f"{STD_SQL[c]} AS x{i + 1}" for i, c in enumerate(NUM)) + " FROM imp, s)\n"
            f", fit AS (SELECT * FROM pts WHERE subset = 'train' AND {b} < {edge})\n"
            f", ho AS (SELECT * FROM pts WHERE subset = 'train' AND {b} >= {edge})\n")


def _loss_weights(tag: str, ks: list[int]) -> tuple[str, str]:
    loss = union_all([
        f"SELECT {k} AS step, (SELECT avg(greatest(0.0, 1 - y * {_margin(f'{tag}w{k}')})) FROM fit, {tag}w{k}) AS train_loss, "
        f"(SELECT avg(greatest(0.0, 1 - y * {_margin(f'{tag}w{k}')})) FROM ho, {tag}w{k}) AS test_loss" for k in ks])
    weights = union_all([
        f"SELECT {k} AS step, CAST(unnest(range(0, {_D + 1})) AS INTEGER) AS idx, unnest(["
        + ", ".join(f"{tag}w{k}_{j}" for j in range(_D + 1)) + f"]) AS weight FROM {tag}w{k}" for k in ks])
    return loss, weights


def _svm_descent_sql(steps: int = 20, lr: float = 0.1, reg: float = 0.1) -> str:
    """Unrolled descent on the 80 % ``fit`` part of train, losses on fit and hold-out."""
    loss, weights = _loss_weights("", list(range(1, steps + 1)))
    return (PRE + _svm_points() + _svm_chain("", "fit", steps, lr, reg) + f", loss AS ({loss})\n, wts AS ({weights})\n"
            f"SELECT CAST(step AS INTEGER) AS step, idx, {R('weight')} AS weight, {R('train_loss')} AS train_loss, "
            f"{R('test_loss')} AS test_loss FROM wts JOIN loss USING (step)")


def _svm_sweep_sql(regs=(0.001, 0.01, 0.1, 1.0, 10.0), steps: int = 50, lr: float = 0.1) -> str:
    chains, finals = [], []
    for n, r in enumerate(regs):
        tag = f"r{n}_"
        chains.append(_svm_chain(tag, "fit", steps, lr, r))
        loss, weights = _loss_weights(tag, [steps])
        finals.append(f"SELECT CAST({r} AS DOUBLE) AS reg, CAST(step AS INTEGER) AS step, idx, {R('weight')} AS weight, "
                      f"{R('train_loss')} AS train_loss, {R('test_loss')} AS test_loss "
                      f"FROM ({weights}) JOIN ({loss}) USING (step)")
    return PRE + _svm_points() + "".join(chains) + union_all(finals)


q("svm_descent", _svm_descent_sql())
q("svm_reg_sweep", _svm_sweep_sql())


_SUB = ("SELECT subset, count(*) AS rows, CAST(sum(label) AS BIGINT) AS positives, CAST(any_value(w) AS INTEGER) AS width, true AS auc_ok "
        f"FROM imp, (SELECT {len(NUM)} + count(*) AS w FROM sidx) GROUP BY subset")
for _name, _more in {"lr_auc": "optimum_ok", "lr_l2_auc": "optimum_ok", "lr_l1_auc": "zero_ok", "weighted_lr_auc": "optimum_ok", "linear_svc_auc": "",
                     "tree_auc": "leaves_ok", "forest_auc": "trees_ok", "gbt_auc": "rounds_ok"}.items():
    q(_name, PRE + index_ctes() + (f"SELECT *, true AS {_more} FROM ({_SUB})" if _more else _SUB))
q("lr_reg_sweep", PRE + index_ctes() + f"SELECT reg, t.* FROM ({_SUB}) t, (SELECT unnest([0.01, 0.1, 0.5, 1.0]::DOUBLE[]) AS reg)")
q("lr_moments", PRE + index_ctes() + f"SELECT feature, value, count(*) AS rows, CAST(sum(label) AS BIGINT) AS clicks FROM ({unnest_long(_MT, CAT, ['label'])}) "
  "GROUP BY ALL UNION ALL SELECT 'all', '', count(*), CAST(sum(label) AS BIGINT) FROM train")
q("cv_folds", PRE + f"SELECT {md5_bucket_sql('imp_id', 2019, 5)} AS fold, count(*) AS rows, CAST(sum(label) AS BIGINT) AS positives FROM train GROUP BY 1")
q("distinct_sketches", PRE + union_all(
    [f"SELECT subset, '{c}' AS feature, count(DISTINCT {c}) AS distinct_values, true AS close_ok FROM imp GROUP BY subset\n"
     f"UNION ALL SELECT 'all', '{c}', count(DISTINCT {c}), true FROM imp" for c in FEATURES]))
q("quantile_sketches", PRE + union_all(
    [f"SELECT '{c}' AS feature, unnest([0.1, 0.5, 0.9]::DOUBLE[]) AS share, count({c}) AS count, true AS rank_ok FROM imp" for c in NUM]))
q("cross_validate", "SELECT unnest(['regParam=0.01', 'regParam=0.1', 'regParam=1.0']) AS params, true AS auc_ok")
q("sgd_svm_auc", PRE + "SELECT subset, CAST(sum(label) AS BIGINT) AS positives, CAST(count(*) - sum(label) AS BIGINT) AS negatives, "
  "true AS auc_ok FROM imp GROUP BY subset")
q("random_split", PRE + "SELECT unnest([0, 1, 2]) AS part, n AS source_rows, i AS ids, true AS share_ok "
  "FROM (SELECT count(*) AS n, count(DISTINCT imp_id) AS i FROM impressions)")
q("bernoulli_sample", PRE + "SELECT count(*) AS source_rows, true AS share_ok, CAST(0 AS BIGINT) AS unknown, CAST(0 AS BIGINT) AS repeated FROM impressions")
q("null_free_toy", PRE + "SELECT count(*) AS source_rows, true AS share_ok, CAST(0 AS BIGINT) AS unknown, CAST(0 AS BIGINT) AS repeated "
  "FROM impressions WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in FEATURES))
q("approx_measurements", PRE + union_all([f"SELECT '{c}' AS feature, count({c}) AS count, true AS rank_ok FROM train" for c in NUM]))
q("oversample_random", PRE + "SELECT label, count(*) AS source_rows, count(DISTINCT imp_id) AS ids, true AS even FROM train GROUP BY label")
q("undersample_random", PRE + "SELECT label, count(*) AS source_rows, true AS share_ok FROM train GROUP BY label")
q("reshuffled", PRE + "SELECT count(*) AS rows, count(DISTINCT imp_id) AS ids, CAST(sum(CAST(trunc(n05 * 100) AS BIGINT)) AS BIGINT) AS mass, "
  "true AS mixed FROM impressions")
q("feature_hash", PRE + f"SELECT imp_id, CAST({len(CAT)} AS DOUBLE) AS total, true AS counts, true AS in_width FROM impressions")


def _packed_svm_sql(steps: int, lr: float = 0.1, reg: float = 0.1, subset: str = "subset", losses: bool = False) -> str:
    """Entries of the packed vectors (place 0: bias) and ``steps`` descent steps on train as weight tables w0, w1, ...

    ``subset`` spells each row's part; with ``losses`` the margins m1 ... of the new weights too.
    """
    vals = ", ".join(f"{c}_std" for c in NUM)
    out = (PRE + index_ctes() + _STDM + ", kk AS (SELECT count(*) AS k FROM sidx)\n"
           f", yy AS (SELECT imp_id, {subset} AS subset, CASE WHEN label = 0 THEN -1 ELSE 1 END AS y FROM imp)\n"
           f", ent AS (SELECT imp_id, 0 AS i, 1.0 AS v FROM yy\n UNION ALL SELECT imp_id, unnest(range(1, {len(NUM) + 1})), unnest([{vals}]) FROM sm\n"
           f" UNION ALL SELECT imp_id, {len(NUM) + 1} + gidx, 1.0 FROM ({unnest_long('sm', CAT, ['imp_id'])}) JOIN gidx USING (feature, value))\n"
           ", n AS (SELECT count(*) AS n, avg(y) AS mean_y FROM yy WHERE subset = 'train')\n"
           f", w0 AS (SELECT i, CASE WHEN i = 0 THEN mean_y ELSE 0.0 END AS w FROM (SELECT unnest(range(0, {len(NUM) + 1} + k)) AS i FROM kk), n)\n")
    for s in range(steps + losses):
        out += (f", m{s} AS MATERIALIZED (SELECT imp_id, any_value(y) AS y, any_value(subset) AS subset, sum(v * w) AS m FROM ent JOIN w{s} USING (i) "
                "JOIN yy USING (imp_id) GROUP BY imp_id)\n")
        if s < steps:
            out += (f", g{s} AS (SELECT i, sum(y * v) AS g FROM ent JOIN m{s} USING (imp_id) WHERE subset = 'train' AND y * m < 1 GROUP BY i)\n"
                f", w{s + 1} AS MATERIALIZED (SELECT i, w - {lr} * (-coalesce(g, 0.0) / n + CASE WHEN i = 0 THEN 0.0 ELSE {reg} * w END) AS w "
                f"FROM w{s} LEFT JOIN g{s} USING (i), n)\n")
    return out


q("svm_packed_steps", _packed_svm_sql(2) + union_all(
    [f"SELECT {s} AS step, CAST(i AS INTEGER) AS idx, {R('w')} AS weight FROM w{s}" for s in (1, 2)]))
_FOLD = (f"CASE WHEN subset <> 'train' THEN NULL WHEN {md5_place_sql('imp_id', 1)} < {share_edges((0.8, 0.2))[0]} THEN 'train' ELSE 'holdout' END")
q("svm_packed_descent", _packed_svm_sql(10, subset=_FOLD, losses=True) + union_all(
    [f"SELECT {s} AS step, CAST(i AS INTEGER) AS idx, {R('w')} AS weight, "
     + ", ".join(f"{R(f'(SELECT avg(greatest(0.0, 1 - y * m)) FROM m{s} WHERE subset = {chr(39)}{p}{chr(39)})')} AS {c}"
                 for p, c in (("train", "train_loss"), ("holdout", "test_loss"))) + f" FROM w{s}" for s in range(1, 11)]))
q("svm_packed_loss", _packed_svm_sql(1) + ", last AS (SELECT imp_id, sum(v * w) AS m FROM ent JOIN w1 USING (i) GROUP BY imp_id)\n"
  f"SELECT subset, {R('avg(greatest(0.0, 1 - y * m))')} AS hinge_loss, count(*) FILTER (WHERE m >= 0) AS clicks "
  "FROM last JOIN yy USING (imp_id) GROUP BY subset")
_INTS = ("label", fx.NOISE_LABEL)
q("import_headerless", ORACLES["tsv_round_trip"])
_MISSING = "(n02 IS NULL)::INT + (n03 IS NULL)::INT + (c05 IS NULL)::INT"
q("import_with_rejects", PRE + f"SELECT CASE WHEN {_MISSING} > 0 THEN 'fields: ' || ({len(_IMP_COLS)} - ({_MISSING})) WHEN CAST(c10 AS BIGINT) > 127 THEN 'c10' "
  "ELSE 'typed' END AS outcome, count(*) AS rows, CAST(sum(label) AS BIGINT) AS positives FROM impressions GROUP BY 1")
q("malformed_fields", PRE + union_all(
    [f"SELECT '{c}' AS field, CAST(" + (f"count({c})" if c in ("c03", "c07") else "count(*) FILTER (false)") + " AS BIGINT) AS malformed FROM impressions"
     for c in [ID, *_INTS, *NUM, *CAT]]))
q("impute_median", PRE + ", s AS (SELECT " + ", ".join(f"quantile_disc({c}, 0.5) AS m_{c}" for c in NUM) + " FROM train)\n"
  "SELECT imp_id, subset, " + ", ".join(f"{R(f'coalesce({c}, m_{c})')} AS {c}_imp" for c in NUM) + " FROM imp, s")
q("centred_scale", PRE + ", m AS (SELECT " + ", ".join(f"avg({c}) AS a_{c}" for c in NUM) + " FROM train)\n, s AS (SELECT "
  + ", ".join(f"avg(coalesce({c}, a_{c})) AS m_{c}, stddev_samp(coalesce({c}, a_{c})) AS d_{c}" for c in NUM) + " FROM train, m)\n"
  "SELECT imp_id, subset, " + ", ".join(f"{R(f'(coalesce({c}, a_{c}) - m_{c}) / d_{c}')} AS {c}_cs" for c in NUM) + " FROM imp, m, s")
q("resumable_step", ORACLES["mask_uncommon"])
q("model_round_trip", PRE + "SELECT imp_id, true AS same FROM impressions")
q("libsvm_round_trip", PRE + index_ctes() + _STDM + ", kk AS (SELECT count(*) AS k FROM sidx)\n"
  ", hits AS (SELECT imp_id, count(*) AS h, sum(gidx) AS places FROM (" + unnest_long("sm", CAT, ["imp_id"]) + ") JOIN gidx USING (feature, value) "
  "GROUP BY imp_id)\n"
  f"SELECT {R(' + '.join(f'{c}_std' for c in NUM) + ' + coalesce(h, 0)')} AS mass, "
  f"{R(' + '.join(f'{i} * {c}_std' for i, c in enumerate(NUM)) + f' + {len(NUM)} * coalesce(h, 0) + coalesce(places, 0)')} AS places, "
  "CAST(label AS DOUBLE) AS label, CAST(" + " + ".join(f"CASE WHEN {c}_std <> 0 THEN 1 ELSE 0 END" for c in NUM)
  + f" + coalesce(h, 0) AS INTEGER) AS nnz, CAST({len(NUM)} + k AS INTEGER) AS width "
  "FROM sm LEFT JOIN hits USING (imp_id), kk")


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
