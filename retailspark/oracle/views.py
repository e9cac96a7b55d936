"""The retail views and their untidy variants as SQL common table expressions."""

CLEAN = """
v_brands AS (
  SELECT DISTINCT CAST(substring(p_brand, 7) AS BIGINT) AS brand_id, p_brand AS brand_name FROM part),
v_categories AS (
  SELECT DISTINCT CAST('0x' || substring(md5(p_type), 1, 7) AS BIGINT) AS category_id,
         p_type AS category_name FROM part),
v_products AS (
  SELECT p_partkey AS product_id, p_name AS product_name,
         CAST(substring(p_brand, 7) AS BIGINT) AS brand_id,
         CAST('0x' || substring(md5(p_type), 1, 7) AS BIGINT) AS category_id,
         p_retailprice AS list_price, p_brand AS brand_name, p_type AS category_name FROM part),
v_stores AS (
  SELECT CAST(n_nationkey AS BIGINT) AS store_id, n_name AS store_name, r_name AS city,
         substring(r_name, 1, 2) AS state
  FROM nation JOIN region ON n_regionkey = r_regionkey),
v_staffs AS (
  SELECT s_suppkey AS staff_id, 'Staff' AS first_name, s_name AS last_name,
         lower(s_name) || '@example.com' AS email,
         CASE WHEN s_acctbal > 0 THEN 1 ELSE 0 END AS active,
         CAST(s_nationkey AS BIGINT) AS store_id FROM supplier),
v_customers AS (
  SELECT c_custkey AS customer_id, c_name AS full_name, lower(c_name) || '@example.com' AS email,
         lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS phone, n_name AS city, r_name AS state,
         lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS zip_code
  FROM (SELECT c_custkey, c_name, c_nationkey FROM customer
        UNION ALL SELECT s_suppkey + 1000000000000, s_name, s_nationkey FROM supplier)
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
v_order_items AS (
  SELECT l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS item_id, l_partkey AS product_id,
         CAST(l_quantity AS BIGINT) AS quantity, l_extendedprice / l_quantity AS list_price,
         l_discount AS discount,
         CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4)) AS total_price
  FROM lineitem),
v_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id,
         CAST(CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'P' THEN 2 WHEN 'F' THEN 4 END AS BIGINT) AS order_status,
         o_orderdate AS order_date,
         (SELECT CAST(c_nationkey AS BIGINT) FROM customer WHERE c_custkey = o_custkey) AS store_id,
         (SELECT min(l_suppkey) FROM lineitem WHERE l_orderkey = o_orderkey) AS staff_id,
         coalesce((SELECT sum(total_price) FROM v_order_items i WHERE i.order_id = o_orderkey), 0)
           AS order_total
  FROM orders),
v_stocks AS (
  SELECT CAST(s_nationkey AS BIGINT) AS store_id, l_partkey AS product_id,
         CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
  FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL)
"""

DIRTY = """
d_brands AS (
  WITH b AS (SELECT DISTINCT CAST(substring(p_brand, 7) AS BIGINT) AS k, p_brand FROM part)
  SELECT CAST(k AS VARCHAR) AS brand_id, CASE WHEN k % 5 <> 0 THEN p_brand END AS brand_name FROM b
  UNION ALL
  SELECT CAST(k AS VARCHAR), CASE WHEN k % 5 <> 0 THEN p_brand END FROM b WHERE k = 7),
d_categories AS (
  WITH b AS (SELECT DISTINCT CAST('0x' || substring(md5(p_type), 1, 7) AS BIGINT) AS k, p_type FROM part)
  SELECT CAST(k AS VARCHAR) AS category_id, CASE WHEN k % 5 <> 0 THEN p_type END AS category_name FROM b
  UNION ALL
  SELECT CAST(k AS VARCHAR), CASE WHEN k % 5 <> 0 THEN p_type END FROM b WHERE k % 2 = 0),
d_products AS (
  WITH b AS (SELECT * FROM part UNION ALL SELECT * FROM part WHERE p_partkey % 150 = 0)
  SELECT CAST(p_partkey AS VARCHAR) AS product_id,
         CASE WHEN p_partkey % 90 <> 0 THEN p_name END AS product_name,
         substring(p_brand, 7) AS brand_id,
         CAST(CAST('0x' || substring(md5(p_type), 1, 7) AS BIGINT) AS VARCHAR) AS category_id,
         CASE WHEN p_partkey % 8 <> 0 THEN CAST(2010 + p_partkey % 10 AS VARCHAR) END AS model_year,
         CAST(CAST(CASE WHEN p_partkey % 25 = 0 THEN -p_retailprice ELSE p_retailprice END
              AS DECIMAL(18,2)) AS VARCHAR) AS list_price FROM b),
d_customers AS (
  WITH b AS (SELECT * FROM customer UNION ALL SELECT * FROM customer WHERE c_custkey % 50 = 0)
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS first_name,
         CASE WHEN c_custkey % 11 <> 0 THEN c_mktsegment END AS last_name,
         CASE c_custkey % 4 WHEN 1 THEN '(555) 010-0001, 555-010-0002' WHEN 2 THEN '555.010.0003'
              WHEN 3 THEN '5550100004' END AS phone,
         CASE WHEN c_custkey % 7 <> 0 THEN lower(c_name) || '@example.com' END AS email,
         CASE WHEN c_custkey % 13 <> 0 THEN (c_custkey % 900) || ' Main St' END AS street,
         CASE WHEN c_custkey % 17 <> 0 THEN 'City ' || c_nationkey END AS city,
         CASE WHEN c_custkey % 19 <> 0 THEN 'S' || (c_nationkey % 5) END AS state,
         CASE WHEN c_custkey % 9 <> 0 THEN lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') END AS zip_code
  FROM b),
d_orders AS (
  WITH b AS (SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderkey % 500 = 0)
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
         CASE o_orderstatus WHEN 'O' THEN '1' WHEN 'P' THEN '2' WHEN 'F' THEN '4' END AS order_status,
         CASE WHEN o_orderkey % 97 = 0 THEN 'not a date'
              WHEN o_orderkey % 101 = 0 THEN NULL
              WHEN o_orderkey % 50 = 0 THEN '1016' || strftime(o_orderdate, '-%m-%d')
              WHEN o_orderkey % 53 = 0 THEN '1800' || strftime(o_orderdate, '-%m-%d')
              WHEN o_orderkey % 10 = 3 THEN strftime(o_orderdate, '%-m/%-d/%Y')
              WHEN o_orderkey % 10 = 7 THEN strftime(o_orderdate, '%Y/%m/%d')
              WHEN o_orderkey % 10 = 9 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
              WHEN o_orderkey % 10 = 1 AND day(o_orderdate) > 12 THEN strftime(o_orderdate, '%d/%m/%Y')
              WHEN o_orderkey % 10 = 2 THEN strftime(o_orderdate, '%Y%m%d')
              WHEN o_orderkey % 10 = 4 THEN strftime(o_orderdate, '%b %-d, %Y')
              WHEN o_orderkey % 10 = 5 THEN strftime(o_orderdate, '%d-%b-%Y')
              WHEN o_orderkey % 10 = 6 THEN strftime(o_orderdate, '%m-%d-%Y')
              WHEN o_orderkey % 10 = 8 THEN strftime(o_orderdate, '%-m/%-d/%y')
              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS order_date,
         CASE WHEN o_orderkey % 20 = 0 THEN strftime(o_orderdate - INTERVAL 3 DAY, '%Y-%m-%d')
              ELSE strftime(o_orderdate + INTERVAL 7 DAY, '%Y-%m-%d') END AS required_date,
         CASE WHEN o_orderstatus <> 'O' THEN strftime(o_orderdate + INTERVAL 2 DAY, '%Y-%m-%d') END AS shipped_date,
         CAST((SELECT c_nationkey FROM customer WHERE c_custkey = o_custkey) AS VARCHAR) AS store_id, CAST(o_orderkey % 100 AS VARCHAR) AS staff_id FROM b),
d_order_items AS (
  WITH b AS (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_orderkey % 200 = 1)
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
         CASE WHEN l_orderkey % 40 = 0 THEN 'x' WHEN l_orderkey % 41 = 0 THEN l_linenumber || '.0'
              ELSE CAST(l_linenumber AS VARCHAR) END AS item_id,
         CAST(l_partkey AS VARCHAR) AS product_id,
         CASE WHEN l_partkey % 33 = 0 THEN '-1' WHEN l_partkey % 35 = 0 THEN '0'
              WHEN l_partkey % 37 = 0 THEN CAST(l_quantity AS BIGINT) || 'E+000'
              ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS quantity,
         CAST(CAST(l_extendedprice / l_quantity AS DECIMAL(18,8)) AS VARCHAR) AS list_price,
         CASE WHEN l_partkey % 60 = 0 THEN '1.5' ELSE CAST(CAST(l_discount AS DECIMAL(18,2)) AS VARCHAR) END AS discount
  FROM b),
d_staffs AS (
  WITH b AS (SELECT * FROM supplier UNION ALL SELECT * FROM supplier WHERE s_suppkey % 40 = 0)
  SELECT CAST(s_suppkey AS VARCHAR) AS staff_id, 'Staff' AS first_name,
         CASE WHEN s_suppkey % 14 <> 0 THEN s_name END AS last_name,
         CASE WHEN s_suppkey % 6 <> 0 THEN lower(s_name) || '@example.com' END AS email,
         CASE WHEN s_suppkey % 5 <> 0 THEN '+1 555-' || substring(lpad(CAST(s_suppkey AS VARCHAR), 4, '0'), 1, 4) END AS phone,
         CASE WHEN s_suppkey % 17 = 0 THEN 'inf' WHEN s_acctbal > 0 THEN '1' ELSE '0' END AS active,
         CASE WHEN s_suppkey % 10 <> 0 THEN CAST(s_nationkey AS VARCHAR) END AS store_id,
         CASE WHEN s_suppkey % 3 <> 0 THEN CAST(s_suppkey % 4 AS VARCHAR) END AS manager_id FROM b),
d_stores AS (
  WITH b AS (SELECT * FROM nation UNION ALL SELECT * FROM nation WHERE n_nationkey = 11)
  SELECT CAST(n_nationkey AS VARCHAR) AS store_id,
         CASE WHEN n_nationkey % 5 <> 0 THEN n_name END AS store_name,
         '(555) 020-00' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS phone,
         CASE WHEN n_nationkey % 5 <> 0 THEN lower(n_name) || '@example.com' END AS email,
         n_nationkey || ' High St' AS street, 'City ' || n_nationkey AS city, 'S' || n_regionkey AS state,
         CASE WHEN n_nationkey % 5 <> 0 THEN lpad(CAST(n_nationkey AS VARCHAR), 5, '0') END AS zip_code FROM b),
d_stocks AS (
  SELECT CAST(store_id AS VARCHAR) AS store_id, CAST(product_id AS VARCHAR) AS product_id,
         CASE WHEN product_id % 7 = 0 THEN NULL WHEN product_id % 13 = 0 THEN '-1'
              ELSE CAST(quantity AS VARCHAR) END AS quantity FROM v_stocks)
"""


def over_clean(body: str, more: str = "") -> str:
    return f"WITH {CLEAN}{',' if more else ''}{more}\n{body}"


def over_dirty(body: str) -> str:
    return f"WITH {CLEAN},{DIRTY}\n{body}"
