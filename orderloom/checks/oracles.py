"""The same queries in SQL over the driver's tables, written from their meaning.

Reports are plain groupings of the fully joined star: they know nothing of the
pre-aggregations on the Spark side.
"""

from __future__ import annotations

from collections.abc import Iterable

from orderloom.schemas import silver_columns

# The retail tables, typed and clean.
_RETAIL = {
    "r_order_details": """
        SELECT l_orderkey AS order_id, l_partkey AS product_id,
               CAST(l_extendedprice AS DECIMAL(10,2)) AS unit_price,
               CAST(l_quantity AS INTEGER) AS quantity,
               CAST(l_discount AS DECIMAL(5,2)) AS discount
        FROM lineitem""",
    "r_orders": """
        SELECT *, CASE WHEN shipped_date IS NULL THEN 'PENDING'
                       WHEN shipped_date <= required_date THEN 'ON_TIME'
                       ELSE 'DELAYED' END AS delivery_status
        FROM (SELECT o_orderkey AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
                     o_custkey // 15 AS employee_id,
                     CAST(o_orderdate AS DATE) AS order_date,
                     CAST(o_orderdate AS DATE) + 60 AS required_date,
                     CAST(left(o_orderpriority, 1) AS INTEGER) AS shipper_id,
                     CAST(o_totalprice AS DECIMAL(10,2)) AS freight,
                     (SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem
                      WHERE l_orderkey = o_orderkey) AS shipped_date
              FROM orders)""",
    "r_customers": """
        SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS company,
               c_mktsegment AS contact_name, 'BUYER' AS contact_title,
               CAST(c_nationkey AS VARCHAR) AS city, n_name AS country
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "r_products": """
        SELECT p_partkey AS product_id, p_name AS product_name,
               concat(p_size, '-', p_type) AS quantity_per_unit,
               CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price, 0 AS discontinued,
               CAST(substring(p_brand, 7) AS INTEGER) AS category_id
        FROM part""",
    "r_employees": """
        SELECT s_suppkey AS employee_id, s_name AS employee_name, 'SALES' AS title,
               CAST(s_nationkey AS VARCHAR) AS city, n_name AS country,
               CASE WHEN s_suppkey <> 0 THEN CAST(s_suppkey // 10 AS INTEGER) END AS manager_id
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
    "r_shippers": """
        SELECT DISTINCT CAST(left(o_orderpriority, 1) AS INTEGER) AS shipper_id,
               substring(o_orderpriority, 3) AS shipping_company_name
        FROM orders""",
    "r_categories": """
        SELECT CAST(substring(p_brand, 7) AS INTEGER) AS category_id, p_brand AS category_name,
               min(p_type) AS description
        FROM part GROUP BY p_brand""",
}

# The same as a source system delivers them: one copy, before doubling.
_DELIVERED = {
    "order_details": """
        SELECT CASE WHEN quantity < 50 THEN concat('  ', order_id, ' ') END AS "orderID",
               concat('  ', product_id, ' ') AS "productID",
               CAST(unit_price AS VARCHAR) AS "unitPrice",
               concat(quantity, '.0') AS quantity,
               CASE WHEN discount > 0 THEN CAST(discount AS VARCHAR) ELSE 'none' END AS discount
        FROM r_order_details""",
    "orders": """
        SELECT CASE WHEN delivery_status <> 'PENDING' THEN concat('  ', order_id, ' ') END
                   AS "orderID",
               customer_id AS "customerID", CAST(employee_id AS VARCHAR) AS "employeeID",
               CAST(order_date AS VARCHAR) AS "orderDate",
               CASE WHEN shipper_id = 1 THEN concat(required_date, ' 10:00:00')
                    ELSE CAST(required_date AS VARCHAR) END AS "requiredDate",
               CAST(shipped_date AS VARCHAR) AS "shippedDate",
               CASE WHEN shipper_id = 5 THEN 'n/a' ELSE CAST(shipper_id AS VARCHAR) END
                   AS "shipperID",
               CAST(freight AS VARCHAR) AS freight
        FROM r_orders""",
    "customers": """
        SELECT CASE WHEN contact_name <> 'MACHINERY' THEN customer_id END AS "customerID",
               concat('  ', lower(company), chr(65533), ' ') AS "companyName",
               concat('  ', lower(contact_name), chr(65533), ' ') AS "contactName",
               contact_title AS "contactTitle",
               concat('  ', lower(city), chr(65533), ' ') AS city,
               concat(' ', country) AS country
        FROM r_customers""",
    "products": """
        SELECT concat('  ', product_id, ' ') AS "productID",
               concat('  ', lower(product_name), chr(65533), ' ') AS "productName",
               concat('  ', quantity_per_unit, '  BOXES - 20 ') AS "quantityPerUnit",
               concat(unit_price, '5') AS "unitPrice",
               CAST(discontinued AS VARCHAR) AS discontinued,
               concat('  ', category_id, ' ') AS "categoryID"
        FROM r_products""",
    "employees": """
        SELECT CAST(employee_id AS VARCHAR) AS "employeeID", employee_name AS "employeeName",
               concat(' ', title) AS title, city, country,
               CAST(manager_id AS VARCHAR) AS "reportsTo"
        FROM r_employees""",
    "shippers": """
        SELECT CASE WHEN shipper_id < 5 THEN CAST(shipper_id AS VARCHAR) END AS "shipperID",
               shipping_company_name AS "companyName"
        FROM r_shippers""",
    "categories": """
        SELECT concat('  ', category_id, ' ') AS "categoryID",
               concat('  ', category_name, ' ') AS "categoryName",
               concat(description, '  ') AS description
        FROM r_categories""",
}
_RAW = {
    f"raw_{t}": f"SELECT * FROM ({sql}) UNION ALL SELECT * FROM ({sql})"
    for t, sql in _DELIVERED.items()
}

# The curated tables, without the arrival time of orders.
_SILVER = {
    "s_order_details": """
        SELECT coalesce(order_id, 0) AS order_id, coalesce(product_id, 0) AS product_id,
               unit_price, quantity, discount,
               CAST(round(unit_price * quantity, 2) AS DECIMAL(22,2)) AS total_price
        FROM (SELECT DISTINCT TRY_CAST("orderID" AS BIGINT) AS order_id,
                     TRY_CAST("productID" AS BIGINT) AS product_id,
                     TRY_CAST("unitPrice" AS DECIMAL(10,2)) AS unit_price,
                     TRY_CAST(quantity AS INTEGER) AS quantity,
                     TRY_CAST(discount AS DECIMAL(5,2)) AS discount
              FROM raw_order_details)""",
    "s_orders": """
        SELECT coalesce(order_id, 0) AS order_id, customer_id, employee_id, order_date,
               required_date, shipped_date, shipper_id, freight,
               CASE WHEN shipped_date IS NULL THEN 'PENDING'
                    WHEN shipped_date <= required_date THEN 'ON_TIME'
                    ELSE 'DELAYED' END AS delivery_status
        FROM (SELECT DISTINCT TRY_CAST("orderID" AS BIGINT) AS order_id,
                     "customerID" AS customer_id, TRY_CAST("employeeID" AS BIGINT) AS employee_id,
                     CAST("orderDate" AS DATE) AS order_date,
                     CASE WHEN length("requiredDate") = 10
                          THEN CAST("requiredDate" AS DATE) END AS required_date,
                     CAST("shippedDate" AS DATE) AS shipped_date,
                     TRY_CAST("shipperID" AS BIGINT) AS shipper_id,
                     TRY_CAST(freight AS DECIMAL(10,2)) AS freight
              FROM raw_orders)""",
    "s_customers": """
        SELECT DISTINCT coalesce("customerID", 'UNKNOWN') AS customer_id,
               upper(trim(replace("companyName", chr(65533), ''))) AS company,
               upper(trim(replace("contactName", chr(65533), ''))) AS contact_name,
               "contactTitle" AS contact_title,
               upper(trim(replace(city, chr(65533), ''))) AS city, country
        FROM raw_customers""",
    "s_products": r"""
        SELECT DISTINCT coalesce(TRY_CAST("productID" AS BIGINT), 0) AS product_id,
               upper(trim(replace("productName", chr(65533), ''))) AS product_name,
               trim(regexp_replace(replace(lower(trim("quantityPerUnit")), '-', ' x '),
                                   '\s+', ' ', 'g')) AS quantity_per_unit,
               TRY_CAST("unitPrice" AS DECIMAL(10,2)) AS unit_price,
               TRY_CAST(discontinued AS INTEGER) AS discontinued,
               TRY_CAST("categoryID" AS BIGINT) AS category_id
        FROM raw_products""",
    "s_employees": """
        SELECT DISTINCT coalesce(TRY_CAST("employeeID" AS BIGINT), 0) AS employee_id,
               "employeeName" AS employee_name, title, city, country,
               coalesce(TRY_CAST("reportsTo" AS BIGINT), 0) AS manager_id
        FROM raw_employees""",
    "s_shippers": """
        SELECT DISTINCT coalesce(TRY_CAST("shipperID" AS BIGINT), 0) AS shipper_id,
               "companyName" AS shipping_company_name
        FROM raw_shippers""",
    "s_categories": """
        SELECT TRY_CAST("categoryID" AS BIGINT) AS category_id,
               trim("categoryName") AS category_name, trim(description) AS description
        FROM raw_categories""",
}


def _base(p: str) -> str:
    """The joined star over the tables with prefix ``p``."""
    return f"""
        SELECT d.order_id, d.product_id, d.unit_price AS sales_unit_price, d.quantity, d.discount,
               o.customer_id, o.employee_id, o.shipper_id, o.order_date, o.delivery_status,
               o.freight, c.company, c.contact_name, c.city AS customer_city,
               c.country AS customer_country, p.product_name, p.category_id, e.employee_name,
               e.title, e.city AS employee_city, e.country AS employee_country,
               s.shipping_company_name,
               round(d.unit_price * d.quantity * (1 - d.discount), 2) AS net_sales
        FROM {p}order_details d
        JOIN {p}orders o ON o.order_id = d.order_id
        LEFT JOIN {p}customers c ON c.customer_id = o.customer_id
        LEFT JOIN {p}products p ON p.product_id = d.product_id
        LEFT JOIN {p}employees e ON e.employee_id = o.employee_id
        LEFT JOIN {p}shippers s ON s.shipper_id = o.shipper_id"""


def _reports(base: str, orders: str) -> dict[str, str]:
    who = "customer_id, company, contact_name, customer_city, customer_country"
    what = "product_id, product_name, category_id"
    staff = "employee_id, employee_name, title, employee_city, employee_country"
    carrier = "shipper_id, shipping_company_name"
    return {
        "report_top_customers": f"""
            SELECT {who}, round(sum(net_sales), 2) AS total_spend FROM {base} GROUP BY {who}
            ORDER BY total_spend DESC NULLS LAST, customer_id LIMIT 10""",
        "report_top_products": f"""
            SELECT {what}, CAST(sum(quantity) AS BIGINT) AS total_quantity_sold,
                   round(sum(net_sales), 2) AS total_product_revenue
            FROM {base} GROUP BY {what}
            ORDER BY total_product_revenue DESC NULLS LAST, product_id LIMIT 10""",
        "report_sales_by_employee": f"""
            SELECT {staff}, round(sum(net_sales), 2) AS total_sales,
                   count(DISTINCT order_id) AS total_orders_handled
            FROM {base} GROUP BY {staff} ORDER BY total_sales DESC NULLS LAST""",
        "report_monthly_sales_trend": f"""
            SELECT CAST(year(order_date) AS INTEGER) AS sales_year,
                   CAST(month(order_date) AS INTEGER) AS sales_month,
                   coalesce(strftime(order_date, '%Y-%m'), '') AS sales_year_month,
                   round(sum(net_sales), 2) AS monthly_sales
            FROM {base} GROUP BY ALL ORDER BY 1 NULLS FIRST, 2 NULLS FIRST""",
        "report_sales_by_shipping_company": f"""
            SELECT {carrier}, round(sum(net_sales), 2) AS total_sales,
                   count(DISTINCT order_id) AS total_orders
            FROM {base} GROUP BY {carrier} ORDER BY total_sales DESC NULLS LAST""",
        "report_orders_by_delivery_status": f"""
            SELECT delivery_status, count(order_id) AS total_orders,
                   round(sum(freight), 2) AS total_freight
            FROM {orders} GROUP BY delivery_status ORDER BY total_orders DESC""",
        "report_kpi_summary": f"""
            SELECT round(sum(net_sales), 2) AS total_revenue,
                   count(DISTINCT order_id) AS total_orders,
                   count(DISTINCT customer_id) AS total_customers,
                   count(DISTINCT product_id) AS total_products,
                   count(DISTINCT employee_id) AS total_employees
            FROM {base}""",
    }


# Retail tables after cleaning, as far as it changes them: what the published reports are made from.
_CLEANED_RETAIL = {
    "p_order_details": "SELECT DISTINCT * FROM r_order_details",
    "p_orders": "SELECT * FROM r_orders",
    "p_customers": """
        SELECT customer_id, upper(trim(company)) AS company,
               upper(trim(contact_name)) AS contact_name, upper(trim(city)) AS city, country
        FROM r_customers""",
    "p_products": """
        SELECT product_id, upper(trim(product_name)) AS product_name, category_id
        FROM r_products""",
    "p_employees": "SELECT * FROM r_employees",
    "p_shippers": "SELECT * FROM r_shippers",
}

_NAMED = _RETAIL | _RAW | _SILVER | _CLEANED_RETAIL
_NAMED |= {f"{p}_base": _base(f"{p}_") for p in "rsp"}
_WITH = "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in _NAMED.items())

# Events: every third status sends text, or an id of the wrong type.
_SENT = """
    SELECT r.*, CAST(r.shipper_id AS BIGINT) AS shipper, CAST(r.freight AS DOUBLE) AS amount,
           o_orderstatus AS status
    FROM r_orders r JOIN orders ON o_orderkey = r.order_id"""


# Of open orders every fifth sends a freight that is no number.
_AMOUNT_READ = "CASE WHEN order_id % 5 <> 0 THEN amount END"


def _landed(customer: str, where: str, freight: str = "amount") -> str:
    return f"""
        SELECT order_id, {customer} AS customer_id, employee_id, order_date, required_date,
               shipped_date, shipper AS shipper_id, {freight} AS freight, delivery_status
        FROM ({_SENT}) WHERE {where}"""


_REFINED = _landed("concat('C', customer_id)", "true")


def _count(label: str, source: str) -> str:
    return f"SELECT '{label}' AS table_name, count(*) AS n_rows FROM {source}"




def _silver_columns(table: str) -> list[str]:
    return [name for name in silver_columns(table) if name != "ingestion_timestamp"]


def _fingerprint(label: str, source: str, columns: Iterable[str]) -> str:
    texts = [f'CAST("{name}" AS VARCHAR)' for name in sorted(columns)]
    row = " || ".join(f"coalesce(strlen({text}) || ':' || {text}, '-')" for text in texts)
    return f"""
        SELECT '{label}' AS table_name, count(*) AS n_rows,
               CAST(coalesce(sum(digest), 0) AS DECIMAL(38,0)) AS digest_sum,
               coalesce(bit_xor(digest), 0) AS digest_xor
        FROM (SELECT CAST('0x' || md5({row})[1:13] AS BIGINT) AS digest FROM {source})"""


_REPORT_COLUMNS = {
    "report_top_customers": (
        "customer_id company contact_name customer_city customer_country total_spend"
    ),
    "report_top_products": (
        "product_id product_name category_id total_quantity_sold total_product_revenue"
    ),
    "report_sales_by_employee": (
        "employee_id employee_name title employee_city employee_country total_sales "
        "total_orders_handled"
    ),
    "report_monthly_sales_trend": "sales_year sales_month sales_year_month monthly_sales",
    "report_sales_by_shipping_company": (
        "shipper_id shipping_company_name total_sales total_orders"
    ),
    "report_orders_by_delivery_status": "delivery_status total_orders total_freight",
    "report_kpi_summary": (
        "total_revenue total_orders total_customers total_products total_employees"
    ),
}


def _union(*parts: str) -> str:
    return " UNION ALL ".join(parts)


_TABLES = tuple(_DELIVERED)
_CLEANED_REPORTS = _reports("s_base", "s_orders")

_BODIES = {
    # Sources, projection, filters.
    "parquet_scan": "SELECT * FROM orders",
    "catalog_table_scan": _union(
        *(
            _fingerprint(t, f"r_{t}", [c for c in _silver_columns(t) if c != "total_price"])
            for t in _TABLES
        )
    ),
    "rename_columns": """
        SELECT "customerID" AS customer_id, "companyName" AS company,
               "contactName" AS contact_name, "contactTitle" AS contact_title, city, country
        FROM raw_customers""",
    "select_subset": "SELECT product_id, product_name, category_id FROM r_products",
    "filter_not_null_key": 'SELECT * FROM raw_orders WHERE "orderID" IS NOT NULL',
    "filter_positive": "SELECT * FROM r_order_details WHERE discount > 0",
    "drop_null_rows": """
        SELECT * FROM raw_orders
        WHERE "orderID" IS NOT NULL AND "customerID" IS NOT NULL AND "employeeID" IS NOT NULL
          AND "orderDate" IS NOT NULL AND "requiredDate" IS NOT NULL
          AND "shippedDate" IS NOT NULL AND "shipperID" IS NOT NULL AND freight IS NOT NULL""",
    "delivery_status": "SELECT order_id, shipped_date, required_date, delivery_status FROM r_orders",
    # Joins.
    "join_inner": """
        SELECT d.*, customer_id, order_date
        FROM r_order_details d JOIN r_orders o ON o.order_id = d.order_id""",
    "join_left": """
        SELECT o.customer_id, order_id, company
        FROM r_orders o LEFT JOIN s_customers c ON c.customer_id = o.customer_id""",
    "base_sales": "SELECT * FROM r_base",
    "silver_base_sales": """
        SELECT order_id, count(*) AS n_rows, sum(net_sales) AS net_sales
        FROM s_base GROUP BY order_id""",
    "join_missing_keys": """
        SELECT d.order_id, gross, n_lines * n_orders AS n_pairs
        FROM (SELECT order_id, count(*) AS n_lines, sum(total_price) AS gross
              FROM s_order_details GROUP BY order_id) d
        JOIN (SELECT order_id, count(*) AS n_orders FROM s_orders GROUP BY order_id) o
          ON o.order_id = d.order_id""",
    # Aggregation, distinct.
    "sum_by_customer": """
        SELECT customer_id, sum(freight) AS total_spend FROM r_orders GROUP BY customer_id""",
    "distinct_rows": "SELECT DISTINCT * FROM raw_orders",
    "dedup_by_key": """
        SELECT customer_id, order_id, order_date, freight
        FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
                                           ORDER BY order_date DESC, order_id DESC) AS n
              FROM r_orders)
        WHERE n = 1""",
    "row_count_audit": _union(
        *(_count(f"bronze/{t}", f"raw_{t}") for t in _TABLES),
        *(_count(f"silver/{t}", f"s_{t}") for t in _TABLES),
        *(_count(f"gold/{t}", f"r_{t}") for t in _TABLES if t != "categories"),
        _count("gold/base_sales", "r_base"),
    ),
    # Scalar functions.
    "str_trim": 'SELECT "categoryID", trim("categoryName") AS category_name FROM raw_categories',
    "str_upper": "SELECT p_partkey, upper(p_name) AS product_name FROM part",
    "str_lower": "SELECT p_partkey, lower(p_brand) AS brand FROM part",
    "str_strip_replacement_char": """
        SELECT "productID", replace("productName", chr(65533), '') AS name FROM raw_products""",
    "normalize_pack_size": """
        SELECT "productID", concat(p_size, ' x ', lower(p_type), ' boxes x 20') AS quantity_per_unit
        FROM raw_products JOIN part ON p_partkey = CAST("productID" AS BIGINT)""",
    "year_month_label": """
        SELECT order_id, CAST(year(shipped_date) AS INTEGER) AS shipped_year,
               CAST(month(shipped_date) AS INTEGER) AS shipped_month,
               coalesce(strftime(shipped_date, '%Y-%m'), '') AS year_month
        FROM r_orders""",
    "cast_int_lenient": """
        SELECT l_orderkey, l_extendedprice, CAST(trunc(l_extendedprice) AS INTEGER) AS whole_price,
               CAST(NULL AS INTEGER) AS flag_number, CAST(l_partkey AS INTEGER) AS part_number,
               TRY_CAST(concat('99999999', l_orderkey) AS INTEGER) AS too_big
        FROM lineitem""",
    "cast_string": "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS customer_id FROM orders",
    "cast_decimal": """
        SELECT l_orderkey, l_extendedprice,
               CAST(CAST(l_extendedprice AS DECIMAL(12,2)) + 0.01 AS DECIMAL(10,2)) AS price,
               CAST(NULL AS DECIMAL(10,2)) AS too_big,
               CAST(l_discount AS DECIMAL(5,2)) AS discount
        FROM lineitem""",
    "parse_iso_date": """
        SELECT o_orderkey, CAST(o_orderdate AS DATE) AS from_iso, CAST(NULL AS DATE) AS from_time,
               CAST(NULL AS DATE) AS from_other
        FROM orders""",
    "round_half_up": """
        SELECT l_orderkey, l_extendedprice,
               round(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(0.125 AS DECIMAL(4,3)), 2) AS up,
               round(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(-0.125 AS DECIMAL(4,3)), 2)
                   AS down
        FROM lineitem""",
    "fill_missing_keys": """
        SELECT CASE WHEN delivery_status = 'PENDING' THEN 0 ELSE order_id END AS order_id,
               CASE WHEN shipper_id < 5 THEN customer_id ELSE 'UNKNOWN' END AS customer_id
        FROM r_orders""",
    "line_total": """
        SELECT *, round(unit_price * quantity, 2) AS total_price FROM r_order_details""",
    "net_sales": """
        SELECT *, round(unit_price * quantity * (1 - discount), 2) AS net_sales
        FROM s_order_details""",
    # Tables and reports.
    **{f"silver_{t}": f"SELECT * FROM s_{t}" for t in _TABLES},
    **_reports("r_base", "r_orders"),
    **{f"silver_{name}": sql for name, sql in _CLEANED_REPORTS.items()},
    # Sinks, catalog.
    "full_load_bronze": " UNION ALL BY NAME ".join(
        f"SELECT '{t}' AS table_name, * FROM raw_{t}" for t in _TABLES
    ),
    "register_external": _union(*(_fingerprint(t, f"s_{t}", _silver_columns(t)) for t in _TABLES)),
    "catalog_tables": _union(
        *(_count(f"silver_{t}", f"s_{t}") for t in _TABLES),
        "SELECT 'database' AS table_name, CAST(1 AS BIGINT) AS n_rows",
    ),
    "publish_report_table": _union(
        *(
            _fingerprint(name, f"({sql})", _REPORT_COLUMNS[name].split())
            for name, sql in _reports("p_base", "p_orders").items()
        )
    ),
    "colocated_reports": _union(
        *(
            _fingerprint(name, f"({sql})", _REPORT_COLUMNS[name].split())
            for name, sql in _CLEANED_REPORTS.items()
        )
    ),
    "full_load_run": _union(
        *(_count(f"bronze/{t}", f"raw_{t}") for t in _TABLES),
        *(_count(f"silver/{t}", f"s_{t}") for t in _TABLES),
        *(_count(f"gold/{name}", f"({sql})") for name, sql in _CLEANED_REPORTS.items()),
    ),
    "full_load_kpi": _CLEANED_REPORTS["report_kpi_summary"],
    # Events.
    "order_events_to_json": "SELECT * FROM events",
    "json_parse_flatten": f"""
        SELECT CASE WHEN status = 'O' THEN order_id END AS order_id,
               CASE WHEN status = 'O' THEN concat(' c', customer_id, ' ') END AS customer_id,
               CASE WHEN status = 'O' THEN employee_id END AS employee_id,
               CASE WHEN status = 'O' THEN CAST(order_date AS VARCHAR) END AS order_date,
               CASE WHEN status = 'O' THEN CAST(required_date AS VARCHAR) END AS required_date,
               CASE WHEN status = 'O' THEN CAST(shipped_date AS VARCHAR) END AS shipped_date,
               CASE WHEN status = 'O' THEN shipper END AS shipper_id,
               CASE WHEN status = 'O' THEN {_AMOUNT_READ} END AS freight,
               status = 'O' AS accepted
        FROM ({_SENT})""",
    "stream_order_ingest": _landed("concat(' c', customer_id, ' ')", "status = 'O'", _AMOUNT_READ),
    "stream_partly_read": f"""
        SELECT order_id, 'EUR' AS unit FROM ({_SENT}) WHERE status = 'O' AND order_id % 5 = 0""",
    "stream_rejects": f"""
        SELECT CASE status WHEN 'P' THEN concat('order ', order_id)
                           ELSE concat('{{"order_id":"no ', order_id, '"}}') END AS payload
        FROM ({_SENT}) WHERE status <> 'O'""",
    "stream_batch_counts": f"""
        SELECT 'rows' AS counted, count(*) AS n FROM ({_SENT})
        UNION ALL SELECT 'accepted', count(*) FROM ({_SENT}) WHERE status = 'O'
        UNION ALL SELECT 'rejected', count(*) FROM ({_SENT}) WHERE status <> 'O'""",
    "stream_orders_silver": _REFINED,
    "stream_orders_segments": _REFINED,
    "publish_stream_table": _REFINED,
    "latest_orders_preview": f"{_REFINED} ORDER BY order_id DESC LIMIT 20",
    "incremental_run": _union(
        *(
            _count(layer, f"({_SENT}) WHERE status {test} 'O'")
            for layer, test in {
                "bronze": "=",
                "rejected": "<>",
                "silver": "=",
                "table": "=",
            }.items()
        )
    ),
}


def _with_tables(body: str) -> str:
    return f"{_WITH}\n{body}"


ORACLES = {name: _with_tables(body) for name, body in _BODIES.items()}
