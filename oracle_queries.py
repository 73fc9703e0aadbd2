"""The SQL twin of every query, for DuckDB over the same tables."""

from __future__ import annotations

# The longest allowed text per staging column (product_description has none).
_TEXT_LIMITS = {
    "customer_first_name": 100,
    "customer_last_name": 100,
    "customer_email": 200,
    "customer_country": 100,
    "customer_postal_code": 20,
    "customer_pet_type": 50,
    "customer_pet_name": 100,
    "customer_pet_breed": 100,
    "seller_first_name": 100,
    "seller_last_name": 100,
    "seller_email": 200,
    "seller_country": 100,
    "seller_postal_code": 20,
    "product_name": 200,
    "product_category": 100,
    "sale_date": 20,
    "store_name": 200,
    "store_location": 200,
    "store_city": 100,
    "store_state": 100,
    "store_country": 100,
    "store_phone": 50,
    "store_email": 200,
    "pet_category": 50,
    "product_color": 50,
    "product_size": 50,
    "product_brand": 100,
    "product_material": 100,
    "product_release_date": 20,
    "product_expiry_date": 20,
    "supplier_name": 200,
    "supplier_contact": 200,
    "supplier_email": 200,
    "supplier_phone": 50,
    "supplier_address": 200,
    "supplier_city": 100,
    "supplier_country": 100,
}

# The staging rows, written out here: the queries' own expressions are not read.
_RAW = """SELECT
  l_orderkey * 10 + l_linenumber AS id,
  'Customer' AS customer_first_name,
  substr(c_name, 10) AS customer_last_name,
  CAST(18 + c_custkey % 60 AS INT) AS customer_age,
  concat('c', CAST(c_custkey AS STRING), '@example.com') AS customer_email,
  CASE WHEN c_custkey % 40 = 0 THEN NULL ELSE cn.n_name END AS customer_country,
  lpad(CAST(c_custkey AS STRING), 6, '0') AS customer_postal_code,
  c_mktsegment AS customer_pet_type,
  concat('Pet', CAST(c_custkey % 97 AS STRING)) AS customer_pet_name,
  concat('Breed', CAST(c_custkey % 13 AS STRING)) AS customer_pet_breed,
  'Seller' AS seller_first_name,
  CAST(o_custkey % 50 AS STRING) AS seller_last_name,
  concat('s', CAST(o_custkey % 50 AS STRING), '@example.com') AS seller_email,
  concat('NATION_', CAST(o_custkey % 25 AS STRING)) AS seller_country,
  lpad(CAST(o_custkey % 50 AS STRING), 5, '0') AS seller_postal_code,
  p_name AS product_name,
  p_type AS product_category,
  CAST(p_retailprice AS DECIMAL(10,2)) AS product_price,
  p_size AS product_quantity,
  CASE WHEN l_orderkey % 500 = 0 THEN 'n/a' ELSE concat(CAST(month(o_orderdate) AS STRING), '/', CAST(day(o_orderdate) AS STRING), '/', CAST(year(o_orderdate) AS STRING)) END AS sale_date,
  o_custkey AS sale_customer_id,
  o_custkey % 50 AS sale_seller_id,
  l_partkey AS sale_product_id,
  CAST(l_quantity AS INT) AS sale_quantity,
  CAST(l_extendedprice AS DECIMAL(10,2)) AS sale_total_price,
  concat('Store ', o_orderpriority) AS store_name,
  concat('Block ', substr(o_orderpriority, 1, 1)) AS store_location,
  cn.n_name AS store_city,
  CAST(NULL AS STRING) AS store_state,
  cr.r_name AS store_country,
  concat('555-', CAST(cn.n_nationkey AS STRING), substr(o_orderpriority, 1, 1)) AS store_phone,
  concat('store', CAST(cn.n_nationkey AS STRING), substr(o_orderpriority, 1, 1), '@example.com') AS store_email,
  p_type AS pet_category,
  CAST(p_size / 10.0 AS DECIMAL(10,2)) AS product_weight,
  split_part(p_name, ' ', 1) AS product_color,
  CASE WHEN p_size < 17 THEN 'S' WHEN p_size < 34 THEN 'M' ELSE 'L' END AS product_size,
  p_brand AS product_brand,
  split_part(p_name, ' ', 2) AS product_material,
  concat(p_name, ', ', p_type, ' ', p_brand) AS product_description,
  CASE WHEN p_partkey % 50 = 0 THEN NULL ELSE CAST((10 + p_size % 41) / 10.0 AS DECIMAL(3,1)) END AS product_rating,
  CASE WHEN p_partkey % 70 = 0 THEN NULL ELSE CAST(p_partkey * 37 % 1000 AS INT) END AS product_reviews,
  concat(CAST(month(make_date(CAST(2010 + p_partkey % 10 AS INT), CAST(1 + p_partkey % 12 AS INT), CAST(1 + p_partkey % 28 AS INT))) AS STRING), '/', CAST(day(make_date(CAST(2010 + p_partkey % 10 AS INT), CAST(1 + p_partkey % 12 AS INT), CAST(1 + p_partkey % 28 AS INT))) AS STRING), '/', CAST(year(make_date(CAST(2010 + p_partkey % 10 AS INT), CAST(1 + p_partkey % 12 AS INT), CAST(1 + p_partkey % 28 AS INT))) AS STRING)) AS product_release_date,
  concat(CAST(month(make_date(CAST(2022 + p_partkey % 8 AS INT), CAST(1 + p_partkey % 12 AS INT), CAST(1 + p_partkey % 28 AS INT))) AS STRING), '/', CAST(day(make_date(CAST(2022 + p_partkey % 8 AS INT), CAST(1 + p_partkey % 12 AS INT), CAST(1 + p_partkey % 28 AS INT))) AS STRING), '/', CAST(year(make_date(CAST(2022 + p_partkey % 8 AS INT), CAST(1 + p_partkey % 12 AS INT), CAST(1 + p_partkey % 28 AS INT))) AS STRING)) AS product_expiry_date,
  s_name AS supplier_name,
  concat('Contact ', CAST(s_suppkey AS STRING)) AS supplier_contact,
  concat('sup', CAST(s_suppkey AS STRING), '@example.com') AS supplier_email,
  concat('777-', CAST(s_suppkey AS STRING)) AS supplier_phone,
  concat(CAST(s_suppkey AS STRING), ' Main St') AS supplier_address,
  sn.n_name AS supplier_city,
  sr.r_name AS supplier_country
  FROM lineitem
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation cn ON c_nationkey = cn.n_nationkey
  LEFT JOIN region cr ON cn.n_regionkey = cr.r_regionkey
  LEFT JOIN part ON l_partkey = p_partkey
  LEFT JOIN supplier ON l_suppkey = s_suppkey
  LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey
  LEFT JOIN region sr ON sn.n_regionkey = sr.r_regionkey"""

_DIM_DATE = """
  SELECT full_date,
    CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key,
    CAST(year(full_date) AS INTEGER) AS year,
    CAST(quarter(full_date) AS INTEGER) AS quarter,
    CAST(month(full_date) AS INTEGER) AS month,
    CAST(day(full_date) AS INTEGER) AS day,
    CAST(dayofweek(full_date) + 1 AS INTEGER) AS day_of_week,
    strftime(full_date, '%B') AS month_name,
    strftime(full_date, '%A') AS day_name
  FROM (SELECT DISTINCT CAST(try_strptime(sale_date, '%m/%d/%Y') AS DATE) AS full_date FROM raw)
  WHERE full_date IS NOT NULL"""

_DIM_CUSTOMER = """
  SELECT *, row_number() OVER (ORDER BY customer_id NULLS FIRST) AS customer_key
  FROM (SELECT DISTINCT sale_customer_id AS customer_id, customer_first_name AS first_name,
          customer_last_name AS last_name, customer_age AS age, customer_email AS email,
          customer_country AS country, customer_postal_code AS postal_code,
          customer_pet_type AS pet_type, customer_pet_name AS pet_name,
          customer_pet_breed AS pet_breed
        FROM raw)"""

_DIM_SELLER = """
  SELECT *, row_number() OVER (ORDER BY seller_id NULLS FIRST) AS seller_key
  FROM (SELECT DISTINCT sale_seller_id AS seller_id, seller_first_name AS first_name,
          seller_last_name AS last_name, seller_email AS email, seller_country AS country,
          seller_postal_code AS postal_code
        FROM raw)"""

_DIM_PRODUCT = """
  SELECT *, row_number() OVER (ORDER BY product_id NULLS FIRST) AS product_key
  FROM (SELECT DISTINCT sale_product_id AS product_id, product_name AS name,
          product_category AS category, CAST(product_price AS DOUBLE) AS price,
          CAST(product_weight AS DOUBLE) AS weight, product_color AS color,
          product_size AS size, product_brand AS brand, product_material AS material,
          product_description AS description, CAST(product_rating AS DOUBLE) AS rating,
          product_reviews AS reviews,
          CAST(try_strptime(product_release_date, '%m/%d/%Y') AS DATE) AS release_date,
          CAST(try_strptime(product_expiry_date, '%m/%d/%Y') AS DATE) AS expiry_date,
          pet_category
        FROM raw)"""

_DIM_STORE = """
  SELECT *, row_number() OVER (ORDER BY store_name NULLS FIRST, city NULLS FIRST,
                                        country NULLS FIRST) AS store_id
  FROM (SELECT DISTINCT store_name, store_location AS location, store_city AS city,
          store_state AS state, store_country AS country, store_phone AS phone,
          store_email AS email
        FROM raw)"""

_DIM_SUPPLIER = """
  SELECT *, row_number() OVER (ORDER BY supplier_name NULLS FIRST, city NULLS FIRST,
                                        country NULLS FIRST) AS supplier_id
  FROM (SELECT DISTINCT supplier_name, supplier_contact AS contact, supplier_email AS email,
          supplier_phone AS phone, supplier_address AS address, supplier_city AS city,
          supplier_country AS country
        FROM raw)"""

_FACT_SALES = """
  SELECT customer_key, seller_key, product_key, st.store_id AS store_key,
    su.supplier_id AS supplier_key, dd.date_key, sale_quantity,
    CAST(sale_total_price AS DOUBLE) AS sale_total_price,
    CAST(product_price AS DOUBLE) AS unit_price
  FROM raw
  LEFT JOIN dim_customer dc ON sale_customer_id = dc.customer_id
  LEFT JOIN dim_seller ds ON sale_seller_id = ds.seller_id
  LEFT JOIN dim_product dp ON sale_product_id = dp.product_id
  LEFT JOIN dim_store st ON raw.store_name = st.store_name AND store_city = st.city
                        AND store_country = st.country
  LEFT JOIN dim_supplier su ON raw.supplier_name = su.supplier_name
                           AND supplier_city = su.city AND supplier_country = su.country
  LEFT JOIN dim_date dd ON CAST(try_strptime(sale_date, '%m/%d/%Y') AS DATE) = dd.full_date"""


def _money(amount: str) -> str:
    return f"SUM(CAST({amount} AS DECIMAL(12,2)))"


def _total(amount: str) -> str:
    return f"CAST({_money(amount)} AS DOUBLE)"


def _mean(amount: str) -> str:
    return f"{_total(amount)} / COUNT({amount})"


_PRODUCT_TOTALS = f"""
  SELECT product_id, name AS product_name, category,
    CAST(SUM(sale_quantity) AS BIGINT) AS total_quantity,
    {_total('sale_total_price')} AS total_revenue,
    rating AS avg_rating, CAST(reviews AS BIGINT) AS review_count
  FROM fact_sales JOIN dim_product USING (product_key)
  GROUP BY product_id, name, category, rating, reviews"""

_CUSTOMER_TOTALS = f"""
  SELECT customer_id, concat_ws(' ', first_name, last_name) AS customer_name,
    coalesce(country, 'Unknown') AS country,
    {_total('sale_total_price')} AS total_purchases, COUNT(*) AS order_count,
    {_mean('sale_total_price')} AS avg_check
  FROM fact_sales JOIN dim_customer USING (customer_key)
  GROUP BY ALL"""

_STORE_TOTALS = f"""
  SELECT store_id, store_name, city, country,
    {_total('sale_total_price')} AS total_revenue, COUNT(*) AS order_count,
    {_mean('sale_total_price')} AS avg_check
  FROM fact_sales JOIN dim_store ON store_key = store_id
  GROUP BY ALL"""

_SUPPLIER_TOTALS = f"""
  SELECT supplier_id, supplier_name, country,
    {_total('sale_total_price')} AS total_revenue,
    {_mean('unit_price')} AS avg_product_price, COUNT(*) AS order_count
  FROM fact_sales JOIN dim_supplier ON supplier_key = supplier_id
  GROUP BY ALL"""

_TIME_SALES = f"""
  SELECT year, month, month_name, {_total('sale_total_price')} AS total_revenue,
    COUNT(*) AS order_count, {_mean('sale_total_price')} AS avg_order_size
  FROM fact_sales JOIN dim_date USING (date_key)
  GROUP BY year, month, month_name"""


def _rank(measure: str) -> str:
    return f"CAST(rank() OVER (ORDER BY {measure} DESC NULLS LAST) AS BIGINT)"


_PRODUCT_SALES = f"""
  SELECT product_id, product_name, category, total_quantity, total_revenue,
    coalesce(avg_rating, 0.0) AS avg_rating, coalesce(review_count, 0) AS review_count,
    {_rank('p.total_quantity')} AS quantity_rank, {_rank('p.total_revenue')} AS revenue_rank
  FROM product_totals p"""

_PRODUCT_QUALITY = f"""
  SELECT product_id, product_name, category, coalesce(p.avg_rating, 0.0) AS avg_rating,
    coalesce(p.review_count, 0) AS total_reviews, total_quantity AS total_sales_quantity,
    total_revenue, {_rank('p.avg_rating')} AS rating_rank,
    {_rank('p.review_count')} AS review_rank, {_rank('p.total_quantity')} AS sales_rank
  FROM product_totals p"""

# Staging rows whose attributes differ between lines of one member, with keys and prices missing.
_UNTIDY_RAW = """
  SELECT * REPLACE (
    CASE WHEN id % 7 = 0 THEN NULL ELSE concat('C', CAST(id % 3 AS VARCHAR)) END AS customer_first_name,
    CASE WHEN id % 2 = 0 THEN NULL ELSE customer_age END AS customer_age,
    CASE WHEN id % 5 = 0 THEN 'Elsewhere' ELSE customer_country END AS customer_country,
    CASE WHEN id % 17 = 0 THEN NULL ELSE sale_customer_id END AS sale_customer_id,
    CASE WHEN id % 13 = 0 THEN NULL ELSE store_city END AS store_city,
    CASE WHEN id % 3 = 0 THEN NULL ELSE store_phone || CAST(id % 4 AS VARCHAR) END AS store_phone,
    CASE WHEN id % 19 = 0 THEN NULL ELSE product_price END AS product_price,
    CASE WHEN id % 23 = 0 THEN NULL ELSE sale_total_price END AS sale_total_price
  ) FROM raw"""


def _first_variant(dimension: str, keys: str) -> str:
    """A dimension of untidy rows: of each key the row that sorts first, column by column."""
    tidy = dimension.replace("FROM raw)", "FROM untidy_raw)")
    head, _, variants = tidy.partition("FROM (SELECT DISTINCT")
    names = [part.split()[-1] for part in _top_level(variants.rpartition("FROM untidy_raw)")[0])]
    order = ", ".join(f"{name} NULLS FIRST" for name in names)
    return f"{head} FROM (SELECT DISTINCT ON ({keys}) * FROM (SELECT DISTINCT {variants} ORDER BY {order})"


def _top_level(columns: str) -> list[str]:
    """The parts between commas that are in no brackets."""
    parts, depth = [""], 0
    for character in columns:
        depth += (character == "(") - (character == ")")
        if character == "," and not depth:
            parts.append("")
        else:
            parts[-1] += character
    return parts


_UNTIDY = {
    "untidy_raw": _UNTIDY_RAW,
    "untidy_customers": _first_variant(_DIM_CUSTOMER, "customer_id"),
    "untidy_products": _first_variant(_DIM_PRODUCT, "product_id"),
    "untidy_stores": _first_variant(_DIM_STORE, "store_name, city, country"),
    "untidy_sales": """
  SELECT customer_key, st.store_id AS store_key, sale_quantity,
    CAST(sale_total_price AS DOUBLE) AS sale_total_price, CAST(product_price AS DOUBLE) AS unit_price
  FROM untidy_raw
  LEFT JOIN untidy_customers dc ON sale_customer_id = dc.customer_id
  LEFT JOIN untidy_stores st ON untidy_raw.store_name = st.store_name AND store_city = st.city
                            AND store_country = st.country""",
    "untidy_stores_mart": f"""
  SELECT *, {_rank('total_revenue')} AS revenue_rank FROM (
    SELECT store_id, store_name, city, country, {_total('sale_total_price')} AS total_revenue,
      COUNT(*) AS order_count, {_mean('sale_total_price')} AS avg_check
    FROM untidy_sales JOIN untidy_stores ON store_key = store_id GROUP BY ALL)""",
}

_MART_ROWS = " UNION ALL ".join(
    f"SELECT '{mart}' AS mart, CAST({member} AS BIGINT) AS member, {label} AS label, "
    f"{amount} AS amount, CAST({count} AS BIGINT) AS n, CAST({place} AS BIGINT) AS place FROM {mart}"
    for mart, member, label, amount, count, place in (
        ("mart_product_sales", "product_id", "product_name", "total_revenue", "total_quantity", "revenue_rank"),
        ("mart_customer_sales", "customer_id", "customer_name", "total_purchases", "order_count", "purchase_rank"),
        ("mart_time_sales", "year * 100 + month", "month_name", "total_revenue", "order_count", "month"),
        ("mart_store_sales", "store_id", "store_name", "total_revenue", "order_count", "revenue_rank"),
        ("mart_supplier_sales", "supplier_id", "supplier_name", "total_revenue", "order_count", "revenue_rank"),
        ("mart_product_quality", "product_id", "product_name", "avg_rating", "total_reviews", "rating_rank"),
    )
)

# Each table may read those before it.
_TABLES = {
    "raw": _RAW,
    "dim_date": _DIM_DATE,
    "dim_customer": _DIM_CUSTOMER,
    "dim_seller": _DIM_SELLER,
    "dim_product": _DIM_PRODUCT,
    "dim_store": _DIM_STORE,
    "dim_supplier": _DIM_SUPPLIER,
    "fact_sales": _FACT_SALES,
    "product_totals": _PRODUCT_TOTALS,
    "customer_totals": _CUSTOMER_TOTALS,
    "store_totals": _STORE_TOTALS,
    "supplier_totals": _SUPPLIER_TOTALS,
    "mart_product_sales": _PRODUCT_SALES,
    "mart_customer_sales": f"""
  SELECT *, {_rank('total_purchases')} AS purchase_rank FROM customer_totals""",
    "mart_time_sales": _TIME_SALES,
    "months": """
  SELECT year, month, SUM(CAST(sale_total_price AS DECIMAL(12,2))) AS amount
  FROM fact_sales JOIN dim_date USING (date_key) GROUP BY year, month""",
    "mart_store_sales": f"""
  SELECT *, {_rank('total_revenue')} AS revenue_rank FROM store_totals""",
    "mart_supplier_sales": f"""
  SELECT *, {_rank('total_revenue')} AS revenue_rank FROM supplier_totals""",
    "mart_product_quality": _PRODUCT_QUALITY,
    **_UNTIDY,
}

_LOST = " UNION ALL ".join(
    f"SELECT '{key}' AS key_column, COUNT(*) AS lost_lines, "
    f"coalesce({_total('sale_total_price')}, 0.0) AS lost_revenue "
    f"FROM fact_sales WHERE {key} IS NULL"
    for key in ("customer_key", "seller_key", "product_key", "store_key", "supplier_key", "date_key")
)


def _counts(tables: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, COUNT(*) AS row_count FROM {table}"
        for name, table in tables.items()
    )


_DIMS = ("dim_date", "dim_customer", "dim_seller", "dim_product", "dim_store", "dim_supplier")
_MARTS = tuple(name for name in _TABLES if name.startswith("mart_"))

_REPORTS = {
    "csv_staging": "SELECT * FROM raw",
    "csv_quoted_breaks": """
      SELECT * REPLACE (replace(product_description, ', ', ',' || chr(10) || '"')
        AS product_description) FROM raw""",
    "raw_sales": "SELECT * FROM raw",
    "top_products": """
      SELECT product_id, product_name, total_quantity, quantity_rank FROM mart_product_sales
      ORDER BY quantity_rank, product_id LIMIT 10""",
    "top_customers": """
      SELECT customer_id, customer_name, country, total_purchases, purchase_rank
      FROM mart_customer_sales ORDER BY purchase_rank, customer_id LIMIT 10""",
    "top_stores": """
      SELECT store_id, store_name, city, country, total_revenue, revenue_rank
      FROM mart_store_sales ORDER BY revenue_rank, store_id LIMIT 5""",
    "top_suppliers": """
      SELECT supplier_id, supplier_name, country, total_revenue, revenue_rank
      FROM mart_supplier_sales ORDER BY revenue_rank, supplier_id LIMIT 5""",
    "best_rated": """
      SELECT product_id, product_name, avg_rating, total_reviews, total_sales_quantity,
        rating_rank
      FROM mart_product_quality ORDER BY rating_rank, product_id LIMIT 10""",
    "worst_rated": """
      SELECT product_id, product_name, avg_rating, review_count AS total_reviews,
        total_quantity AS total_sales_quantity
      FROM product_totals ORDER BY avg_rating ASC NULLS LAST, product_id LIMIT 10""",
    "most_reviewed": """
      SELECT product_id, product_name, avg_rating, total_reviews, review_rank
      FROM mart_product_quality ORDER BY review_rank, product_id LIMIT 10""",
    "category_revenue": f"""
      SELECT category, COUNT(*) AS products,
        CAST(SUM(total_quantity) AS BIGINT) AS total_quantity,
        {_total('total_revenue')} AS total_revenue
      FROM mart_product_sales GROUP BY category""",
    "product_ratings": """
      SELECT product_id, product_name, category, avg_rating, review_count
      FROM mart_product_sales""",
    "rating_sales_corr": """
      SELECT COUNT(*) AS rated_products,
        round(corr(avg_rating, total_quantity), 9) AS rating_quantity_corr,
        round(corr(avg_rating, total_revenue), 9) AS rating_revenue_corr
      FROM product_totals WHERE avg_rating IS NOT NULL""",
    "country_customers": f"""
      SELECT country, COUNT(*) AS customers, CAST(SUM(order_count) AS BIGINT) AS order_count,
        {_total('total_purchases')} AS total_purchases,
        COUNT(*) / (SELECT CAST(COUNT(*) AS DOUBLE) FROM mart_customer_sales) AS customer_share
      FROM mart_customer_sales GROUP BY country""",
    "customer_avg_check": """
      SELECT customer_id, customer_name, order_count, avg_check FROM mart_customer_sales""",
    "monthly_trend": """
      SELECT year, month, month_name, total_revenue, order_count FROM mart_time_sales
      ORDER BY year, month""",
    "yearly_trend": f"""
      SELECT year, {_total('sale_total_price')} AS total_revenue, COUNT(*) AS order_count,
        {_mean('sale_total_price')} AS avg_order_size
      FROM fact_sales JOIN dim_date USING (date_key) GROUP BY year ORDER BY year""",
    "period_comparison": """
      SELECT year, month, total_revenue, previous_revenue, year_before_revenue,
        change, change * 100 / previous_revenue AS change_pct,
        year_change, year_change * 100 / year_before_revenue AS year_change_pct
      FROM (
        SELECT year, month, CAST(now AS DOUBLE) AS total_revenue,
          CAST(before AS DOUBLE) AS previous_revenue,
          CAST(year_before AS DOUBLE) AS year_before_revenue,
          CAST(now - before AS DOUBLE) AS change,
          CAST(now - year_before AS DOUBLE) AS year_change
        FROM (
          SELECT m.year, m.month, m.amount AS now,
            b.amount AS before, y.amount AS year_before
          FROM months m LEFT JOIN months y ON y.year = m.year - 1 AND y.month = m.month
            LEFT JOIN months b ON b.year * 12 + b.month = m.year * 12 + m.month - 1))
      ORDER BY year, month""",
    "avg_order_size": """
      SELECT year, month, month_name, order_count, avg_order_size FROM mart_time_sales
      ORDER BY year, month""",
    "store_distribution": f"""
      SELECT country, city, CAST(grouping(country, city) AS INTEGER) AS level,
        COUNT(*) AS stores, CAST(SUM(order_count) AS BIGINT) AS order_count,
        {_total('total_revenue')} AS total_revenue
      FROM mart_store_sales GROUP BY ROLLUP (country, city)""",
    "store_avg_check": """
      SELECT store_id, store_name, city, country, order_count, avg_check
      FROM mart_store_sales""",
    "supplier_avg_price": """
      SELECT supplier_id, supplier_name, country, avg_product_price
      FROM mart_supplier_sales""",
    "supplier_countries": f"""
      SELECT country, COUNT(*) AS suppliers, CAST(SUM(order_count) AS BIGINT) AS order_count,
        {_total('total_revenue')} AS total_revenue
      FROM mart_supplier_sales GROUP BY country""",
    "table_counts": _counts({name: name for name in (*_DIMS, "fact_sales")}),
    "text_lengths": " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, {limit} AS allowed, "
        f"CAST(max(length({name})) AS INTEGER) AS longest, "
        f"count(*) FILTER (length({name}) > {limit}) AS too_long FROM raw"
        for name, limit in _TEXT_LIMITS.items()
    ),
    "sorted_mart": "SELECT * FROM mart_time_sales",
    "lost_sales": _LOST,
    "stored_fact": "SELECT * FROM fact_sales",
    "stored_marts": _MART_ROWS,
    **{name: f"SELECT * FROM {name}" for name in _UNTIDY if name != "untidy_raw"},
    "warehouse_counts": _counts(
        {"staging": "raw", **{name: name for name in (*_DIMS, "fact_sales", *_MARTS)}}
    ),
}


def _with_tables(query: str) -> str:
    tables = ",\n".join(f"{name} AS ({sql})" for name, sql in _TABLES.items())
    return f"WITH {tables}\n{query}"


def all_queries() -> dict[str, str]:
    tables = {name: f"SELECT * FROM {name}" for name in (*_DIMS, "fact_sales", *_MARTS)}
    return {name: _with_tables(query) for name, query in {**tables, **_REPORTS}.items()}
