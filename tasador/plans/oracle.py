"""SQL building blocks for checking the queries with another engine on the same tables."""

from __future__ import annotations

CASED = r"[\p{Lu}\p{Ll}\p{Lt}]"
NOT_CASED = r"[^\p{Lu}\p{Ll}\p{Lt}]"


def title(column: str) -> str:
    words = f"regexp_extract_all(regexp_replace({column}, '^\\s+|\\s+$', '', 'g'), '({CASED}+|{NOT_CASED}+)')"
    return f"coalesce(array_to_string([upper(w[1]) || lower(w[2:]) for w in {words}], ''), 'Nan')"


def unit(identity: str, salt: str = "") -> str:
    return f"(('0x' || substr(md5({identity}::VARCHAR || '|{salt}42'), 1, 8))::BIGINT)"


LISTINGS = """
li AS (
  SELECT l_orderkey AS k,
         SUM(l_quantity) * 10 AS surface_total,
         SUM(CASE WHEN l_returnflag <> 'R' THEN l_quantity END) * 10 AS surface_covered,
         COUNT(*) AS rooms,
         CAST(SUM(CASE WHEN l_linestatus = 'O' THEN 1 END) AS BIGINT) AS bedrooms,
         MAX(l_linenumber) AS bathrooms,
         CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price
  FROM lineitem GROUP BY l_orderkey),
listings AS (
  SELECT o_orderkey AS id, r_name AS l1, n_name AS l2,
         CASE WHEN c_mktsegment = 'FURNITURE' THEN NULL ELSE n_name || '/' || c_mktsegment END AS l3,
         CASE o_orderstatus WHEN 'F' THEN 'Venta' WHEN 'O' THEN 'Alquiler' ELSE 'Alquiler temporal' END AS operation_type,
         '  ' || lower(o_orderpriority) || ' ' AS property_type,
         surface_total, surface_covered, rooms, bedrooms, bathrooms, price
  FROM orders LEFT JOIN li ON k = o_orderkey
  JOIN customer ON c_custkey = o_custkey
  JOIN nation ON n_nationkey = c_nationkey
  JOIN region ON r_regionkey = n_regionkey)"""

CLEANING = f"""
by_country AS (SELECT * FROM listings WHERE l1 IN ('AMERICA', 'ASIA')),
by_operation AS (SELECT * FROM by_country WHERE operation_type IN ('Venta', 'Alquiler')),
priced AS (SELECT * EXCLUDE (price), price AS price_usd FROM by_operation),
present AS (SELECT * FROM priced WHERE price_usd IS NOT NULL AND surface_total IS NOT NULL),
quartiles AS (SELECT quantile_cont(price_usd, 0.25) AS q1, quantile_cont(price_usd, 0.75) AS q3 FROM present),
in_iqr AS (SELECT p.* FROM present p, quartiles
           WHERE price_usd >= q1 - 1.5 * (q3 - q1) AND price_usd <= q3 + 1.5 * (q3 - q1)),
in_surface AS (SELECT * FROM in_iqr WHERE surface_total > 0 AND surface_total < 2000),
clean AS (SELECT id, l1, {title('l2')} AS l2, {title('l3')} AS l3, {title('operation_type')} AS operation_type,
                 {title('property_type')} AS property_type, surface_total, surface_covered, rooms, bedrooms, bathrooms, price_usd
          FROM in_surface),
surface_range AS (SELECT min(surface_total) AS lo, max(surface_total) AS hi FROM clean),
featured AS (
  SELECT c.*, CASE WHEN isfinite(surface_covered / surface_total) THEN surface_covered / surface_total ELSE 1.0 END AS surface_ratio,
         bedrooms + bathrooms AS total_rooms,
         CASE WHEN isfinite(rooms / surface_total) THEN rooms / surface_total END AS room_density,
         l2 AS province, l3 AS department,
         CASE WHEN surface_total <= lo + (hi - lo) * 1 / 5 THEN 1 WHEN surface_total <= lo + (hi - lo) * 2 / 5 THEN 2
              WHEN surface_total <= lo + (hi - lo) * 3 / 5 THEN 3 WHEN surface_total <= lo + (hi - lo) * 4 / 5 THEN 4
              WHEN surface_total <= hi THEN 5 END AS surface_bin
  FROM clean c, surface_range),
stored AS (
  SELECT id, operation_type, property_type, province, department, surface_total, surface_covered,
         rooms, bedrooms, bathrooms, price_usd,
         {unit('id')} AS u, CAST({unit('id', 'fold')} % 5 AS INTEGER) AS fold, CAST({unit('id', 'inner')} % 5 AS INTEGER) AS inner_fold
  FROM featured),
train AS (SELECT * FROM stored WHERE u >= 858993459),
test AS (SELECT * FROM stored WHERE u < 858993459)"""

# One-feature models on surface_total, in closed form; within folds the feature is standardised, which shrinks the ridge slope by n / (n + 1).
LINE = """
moments AS (SELECT count(*) AS n, avg(surface_total) AS mx, avg(price_usd) AS my,
                   count(*) * var_pop(surface_total) AS sxx, count(*) * covar_pop(price_usd, surface_total) AS sxy FROM train),
lines AS (SELECT 'Linear Regression' AS model, sxy / sxx AS slope, my - mx * sxy / sxx AS intercept FROM moments
          UNION ALL SELECT 'Ridge', sxy / (sxx + 1.0), my - mx * sxy / (sxx + 1.0) FROM moments
          UNION ALL SELECT 'Lasso', sign(sxy) * greatest(abs(sxy) / n - 0.1, 0) / (sxx / n),
                    my - mx * (sign(sxy) * greatest(abs(sxy) / n - 0.1, 0) / (sxx / n)) FROM moments),
scored AS (SELECT model, id, price_usd, intercept + slope * surface_total AS prediction FROM test, lines),
fold_moments AS (SELECT f AS fold, count(*) AS n, avg(surface_total) AS mx, avg(price_usd) AS my,
                        count(*) * var_pop(surface_total) AS sxx, count(*) * covar_pop(price_usd, surface_total) AS sxy
                 FROM train, range(5) t(f) WHERE train.fold <> f GROUP BY f),
fold_lines AS (SELECT fold, 'Linear Regression' AS model, sxy / sxx AS slope, my - mx * sxy / sxx AS intercept FROM fold_moments
               UNION ALL SELECT fold, 'Ridge', sxy / sxx * n / (n + 1.0), my - mx * sxy / sxx * n / (n + 1.0) FROM fold_moments),
fold_scored AS (SELECT model, t.fold, price_usd, intercept + slope * surface_total AS prediction
                FROM train t JOIN fold_lines l ON l.fold = t.fold),
fold_metrics AS (SELECT model, fold, count(*) AS n, sqrt(avg((price_usd - prediction) ** 2)) AS rmse,
                        avg(abs(price_usd - prediction)) AS mae,
                        1 - sum((price_usd - prediction) ** 2) / (count(*) * var_pop(price_usd)) AS r2
                 FROM fold_scored GROUP BY model, fold),
cv AS (SELECT model, avg(r2) AS cv_r2, avg(rmse) AS cv_rmse, avg(mae) AS cv_mae, stddev_pop(r2) AS cv_r2_std FROM fold_metrics GROUP BY model)"""


def with_listings(body: str) -> str:
    return f"WITH {LISTINGS}\n{body}"


def with_clean(body: str, *more: str) -> str:
    return f"WITH {','.join([LISTINGS, CLEANING, *more])}\n{body}"


def with_lines(body: str, *more: str) -> str:
    return with_clean(body, LINE, *more)


def money(expression: str = "price_usd") -> str:
    return f"CAST(SUM(CAST({expression} AS DECIMAL(18,2))) AS DOUBLE) / COUNT({expression})"


def bins(source: str, value: str, number: int) -> str:
    """Rows ``bin, low, high, n`` of an equal-width histogram."""
    return f"""lim AS (SELECT min({value}) AS lo, max({value}) AS hi FROM {source}),
    cut AS (SELECT CASE WHEN lo < hi THEN lo ELSE lo - 0.5 END AS lo, CASE WHEN lo < hi THEN hi ELSE hi + 0.5 END AS hi FROM lim),
    binned AS (SELECT CAST(least(floor(({value} - lo) / ((hi - lo) / {number})), {number - 1}) AS INTEGER) AS bin, count(*) AS n
               FROM {source}, cut WHERE {value} IS NOT NULL GROUP BY 1),
    histogram AS (SELECT CAST(g AS INTEGER) AS bin, round(lo + g * ((hi - lo) / {number}), 6) AS low,
                         round(lo + (g + 1) * ((hi - lo) / {number}), 6) AS high, coalesce(n, 0) AS n
                  FROM range({number}) t(g) CROSS JOIN cut LEFT JOIN binned ON bin = g)"""
