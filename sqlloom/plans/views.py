"""Test views: text-to-SQL shaped tables derived from the driver's orders and customer tables.

The SQL text runs unchanged in Spark and in DuckDB. Every view grows with the tables under it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CORPUS = """
SELECT o_orderkey AS example_id,
 CASE o_orderkey % 3 WHEN 0 THEN 'retail' WHEN 1 THEN 'logistics' ELSE 'finance' END AS domain,
 CASE o_orderkey % 3 WHEN 0 THEN 'Stores and sales' WHEN 1 THEN 'Shipping and routes' ELSE 'Accounts and totals' END AS domain_description,
 CASE o_orderkey % 4 WHEN 0 THEN 'basic SQL' WHEN 1 THEN 'aggregation' WHEN 2 THEN 'single join' ELSE 'window functions' END AS sql_complexity,
 CASE WHEN o_orderkey % 20 IN (0, 1) THEN 'data manipulation' WHEN o_orderkey % 20 = 2 THEN 'data definition' ELSE 'analytics and reporting' END AS sql_task_type,
 CASE WHEN o_orderkey % 20 = 3 THEN 'Count?' WHEN o_orderkey % 20 = 4 THEN NULL
      ELSE concat('  What is the', chr(9), 'total', chr(160), 'price for customer ', CAST(o_custkey AS STRING), chr(10), 'with status ', o_orderstatus, '? ') END AS sql_prompt,
 CASE WHEN o_orderkey % 20 = 11 THEN concat('INSERT INTO orders VALUES (1, ''a;CREATE TABLE fake (x INT);'');')
      WHEN o_orderkey % 20 = 12 THEN NULL
      ELSE concat('CREATE TABLE orders (id INT, cust INT, status TEXT, total REAL); INSERT INTO orders VALUES (', CAST(o_orderkey AS STRING), ', ', CAST(o_custkey AS STRING), ', ''x;y'', 1.5); CREATE VIEW v AS SELECT id FROM orders; create table customer (id INT,  name TEXT)') END AS sql_context,
 CASE WHEN o_orderkey % 20 = 5 THEN 'SELECT'
      WHEN o_orderkey % 20 = 6 THEN 'UPDATE orders SET total = 0 WHERE id = 1'
      WHEN o_orderkey % 20 = 7 THEN 'SELECT REPLACE(status, ''O'', ''P'') FROM orders'
      WHEN o_orderkey % 20 = 8 THEN 'SELECT id FROM orders WHERE day > DATE_SUB(CURDATE(), INTERVAL 1 DAY)'
      WHEN o_orderkey % 20 = 9 THEN 'select top 5 id from orders'
      WHEN o_orderkey % 20 = 10 THEN 'SELECT id FROM orders WHERE (total >'
      WHEN o_orderkey % 20 = 13 THEN '( SELECT id FROM orders )'
      WHEN o_orderkey % 20 = 14 THEN concat('WITH t AS (SELECT cust, SUM(total) AS s FROM orders GROUP BY cust) SELECT s FROM t WHERE cust = ', CAST(o_custkey AS STRING), ';')
      WHEN o_orderkey % 20 = 15 THEN concat('SELECT  updated_at', chr(10), 'FROM orders WHERE cust = ', CAST(o_custkey AS STRING))
      ELSE concat('SELECT SUM(total) FROM orders WHERE cust = ', CAST(o_custkey AS STRING), ' AND status = ''', o_orderstatus, ''';') END AS sql,
 CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE concat('Sums totals  for customer ', CAST(o_custkey AS STRING), '.') END AS sql_explanation
FROM {orders}
"""

BLOCKLIST = """
SELECT CASE c_mktsegment WHEN 'MACHINERY' THEN concat('what IS the total price for customer ', CAST(c_custkey AS STRING), ' with status o?')
            WHEN 'FURNITURE' THEN '' END AS question,
 CASE WHEN c_mktsegment = 'FURNITURE' THEN concat('What is  the total price for customer ', CAST(c_custkey AS STRING), ' with STATUS P?') END AS prompt,
 CASE c_mktsegment WHEN 'BUILDING' THEN concat('select sum( total ) from orders where cust = ', CAST(c_custkey AS STRING), ' and status == ''f''')
            WHEN 'HOUSEHOLD' THEN '' END AS sql,
 CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN concat('select  Updated_at from orders WHERE cust =', CAST(c_custkey AS STRING), ' ;') END AS query
FROM {customer}
"""

# One database per customer, in one of two layouts.
CATALOG_COLUMNS = """
SELECT concat(t.kind, '_', CAST(c.c_custkey AS STRING)) AS db_id, t.table_idx, t.table_name, t.column_idx, t.column_name, t.column_type, t.is_pk, t.fk_target_idx
FROM {customer} AS c
JOIN (VALUES
 ('shop',0,'customer',1,'id','number',true,-1),('shop',0,'customer',2,'name','text',false,-1),('shop',0,'customer',3,'active','boolean',false,-1),
 ('shop',1,'orders',4,'id','number',true,-1),('shop',1,'orders',5,'cust id','NUMBER',false,1),('shop',1,'orders',6,'at','time',false,-1),
 ('fleet',0,'truck',1,'plate','text',true,-1),('fleet',1,'trip',2,'plate','text',true,1),('fleet',1,'trip',3,'leg','number',true,-1),('fleet',1,'trip',4,'note"s','blob',false,-1)
) AS t(kind, table_idx, table_name, column_idx, column_name, column_type, is_pk, fk_target_idx)
ON t.kind = CASE WHEN c.c_custkey % 2 = 0 THEN 'shop' ELSE 'fleet' END
"""

# The same databases as raw catalog objects (Spark only; the shape of one JSON object each). Every
# database has an earlier entry too, which must lose.
RAW_CATALOG = """
SELECT concat(kind, '_', CAST(c_custkey AS STRING)) AS db_id,
 CASE kind WHEN 'shop' THEN array('customer', 'orders') ELSE array('truck', 'trip') END AS table_names_original,
 CASE kind WHEN 'shop' THEN array(array('-1', '*'), array('0', 'id'), array('0', 'name'), array('0', 'active'), array('1', 'id'), array('1', 'cust id'), array('1', 'at'))
  ELSE array(array('-1', '*'), array('0', 'plate'), array('1', 'plate'), array('1', 'leg'), array('1', 'note"s')) END AS column_names_original,
 CASE kind WHEN 'shop' THEN array('text', 'number', 'text', 'boolean', 'number', 'NUMBER', 'time') ELSE array('text', 'text', 'text', 'number', 'blob') END AS column_types,
 CASE kind WHEN 'shop' THEN array(1, 4) ELSE array(1, 2, 3) END AS primary_keys,
 CASE kind WHEN 'shop' THEN array(array(5, 1)) ELSE array(array(2, 1)) END AS foreign_keys, 1L AS ordinal
FROM (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'shop' ELSE 'fleet' END AS kind FROM {customer})
UNION ALL
SELECT concat(CASE WHEN c_custkey % 2 = 0 THEN 'shop_' ELSE 'fleet_' END, CAST(c_custkey AS STRING)), array('old'),
 array(array('-1', '*'), array('0', 'x')), array('text', 'text'), CAST(NULL AS ARRAY<INT>), CAST(NULL AS ARRAY<ARRAY<INT>>), 0L
FROM {customer}
"""

EXAMPLES = """
SELECT o_orderkey AS example_id,
 CASE WHEN o_orderkey % 10 = 9 THEN 'missing_db' WHEN o_orderkey % 10 = 8 THEN ''
      ELSE concat(CASE WHEN o_custkey % 2 = 0 THEN 'shop_' ELSE 'fleet_' END, CAST(o_custkey AS STRING)) END AS db_id,
 CASE WHEN o_orderkey % 10 = 7 THEN '  ' ELSE concat('How many rows  match ', CAST(o_custkey AS STRING), '?') END AS question,
 CASE WHEN o_orderkey % 10 = 6 THEN 'SELECT FROM WHERE ;' ELSE concat('SELECT count(*)  FROM ', CASE WHEN o_custkey % 2 = 0 THEN 'customer' ELSE 'truck' END, ';') END AS query
FROM {orders}
"""

RESPONSES = """
SELECT o_orderkey AS example_id,
 CASE o_orderkey % 7 WHEN 0 THEN concat('Sure:', chr(10), '```sql', chr(10), 'SELECT ', CAST(o_custkey AS STRING), ';', chr(10), '```', chr(10), 'done')
  WHEN 1 THEN concat('```', chr(10), 'SELECT ', CAST(o_custkey AS STRING), chr(10), '```')
  WHEN 2 THEN concat('Reasoning:', chr(10), 'r', chr(10), chr(10), 'Final SQL:', chr(10), 'SELECT ', CAST(o_custkey AS STRING))
  WHEN 3 THEN concat('  SELECT ', CAST(o_custkey AS STRING), '  ')
  WHEN 4 THEN concat('```SQL', chr(10), 'SELECT ', CAST(o_custkey AS STRING), '```')
  WHEN 5 THEN concat('Final SQL: ```sql SELECT ', CAST(o_custkey AS STRING))
  ELSE concat('select ', CAST(o_custkey AS STRING), '<|im_end|>') END AS response,
 concat('SELECT ', CAST(o_custkey AS STRING)) AS gold_sql,
 o_orderpriority AS grp
FROM {orders}
"""


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def view(spark: SparkSession, sf: str, sql: str) -> DataFrame:
    names = [n for n in ("orders", "customer") if "{" + n + "}" in sql]
    return spark.sql(sql, **{n: table(spark, sf, n) for n in names})


def corpus(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, CORPUS)


def blocklist(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, BLOCKLIST)


def raw_catalog(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, RAW_CATALOG)


def examples(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, EXAMPLES)


def responses(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, RESPONSES)
