"""Structured documents derived from the star schema: one account statement per customer.

The statements have headings (most of them), key-value lines, paragraphs with
references, a numbered list and a table of the customer's orders, and a figure. They
are made from the tables, so their number and length grow with the tables. The SQL of
blocks, tables and figures is for those who state an operator's result in SQL.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.sources.sinks import dealt, tasks_for, written

#: One row per customer with orders. The SQL is the common part of the dialects that run it.
ACCOUNTS = """
    SELECT concat('acct-', cast(c_custkey AS string)) AS doc_id, c_custkey AS k, c_name, c_mktsegment AS segment, n_name AS nation,
           cast(floor(c_acctbal) AS bigint) AS balance, cast(sum(cast(floor(o_totalprice) AS bigint)) AS bigint) AS revenue,
           min(cast(cast(o_orderdate AS date) AS string)) AS first_day, max(cast(cast(o_orderdate AS date) AS string)) AS last_day
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey
    GROUP BY c_custkey, c_name, c_mktsegment, n_name, c_acctbal
"""
#: The same rows: orders are summed up by customer before names are joined to them.
SUMMED = """
    SELECT concat('acct-', cast(c_custkey AS string)) AS doc_id, c_custkey AS k, c_name, c_mktsegment AS segment, n_name AS nation,
           cast(floor(c_acctbal) AS bigint) AS balance, cast(sum(total) AS bigint) AS revenue, cast(min(first_day) AS string) AS first_day, cast(max(last_day) AS string) AS last_day
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN (
        SELECT o_custkey, sum(cast(floor(o_totalprice) AS bigint)) AS total, min(cast(o_orderdate AS date)) AS first_day, max(cast(o_orderdate AS date)) AS last_day FROM orders GROUP BY o_custkey
    ) ON o_custkey = c_custkey
    GROUP BY c_custkey, c_name, c_mktsegment, n_name, c_acctbal
"""
ORDERS = """
    SELECT concat('acct-', cast(o_custkey AS string)) AS doc_id, cast(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS int) AS i,
           cast(o_orderkey AS string) AS order_id, o_orderstatus AS status, cast(cast(floor(o_totalprice) AS bigint) AS string) AS total,
           cast(cast(o_orderdate AS date) AS string) AS day
    FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation))
"""
#: Every seventeenth statement has no headings.
BLOCKS = """
    SELECT doc_id, 'h1' AS block_id, 1 AS page_number, 0 AS y0, 0 AS x0, 0 AS reading_order, 'heading' AS block_type, '1 Account Overview' AS text FROM accounts WHERE k % 17 <> 5
    UNION ALL SELECT doc_id, 'b1', 1, 10, 0, 1, 'paragraph', concat('Account Balance: USD ', cast(balance AS string)) FROM accounts
    UNION ALL SELECT doc_id, 'b2', 1, 20, 0, 2, 'paragraph', concat('Market Segment: ', segment) FROM accounts
    UNION ALL SELECT doc_id, 'b3', 1, 30, 0, 3, 'paragraph', concat('Account Holder Services in ', nation, ' keeps ACCT-', cast(k AS string), ' under review. This section introduces Table 1.') FROM accounts
    UNION ALL SELECT doc_id, 'h2', 2, 0, 0, 0, 'heading', '1.1 Order Results' FROM accounts WHERE k % 17 <> 5
    UNION ALL SELECT doc_id, concat('l', cast(i AS string)), 2, 10 + i, 0, i, 'list_item', concat(cast(i AS string), '. Order ', order_id, ' placed ', day, ' with status ', status) FROM account_orders
    UNION ALL SELECT doc_id, 'h3', 3, 0, 0, 0, 'heading', '2 Revenue Notes' FROM accounts WHERE k % 17 <> 5
    UNION ALL SELECT doc_id, 'b4', 3, 10, 0, 1, 'paragraph', concat('Total revenue was USD ', cast(revenue AS string), ' between ', first_day, ' and ', last_day, '. Refer to Figure 1 and Section 1.1 for context.') FROM accounts
    UNION ALL SELECT doc_id, 'b5', 3, 20, 0, 2, 'paragraph', 'See Table 2 for the tax balance.' FROM accounts WHERE k % 2 = 1
    UNION ALL SELECT doc_id, 'b6', 3, 25, 0, 3, 'paragraph', 'Figure captions follow.' FROM accounts WHERE k % 13 = 0
    UNION ALL SELECT doc_id, 'b7', 3, 40, 0, 4, 'list_item', 'a) closing item' FROM accounts WHERE k % 3 = 0
"""
TABLES = """
    SELECT doc_id, 't1' AS table_id, 2 AS page_number, 100000 AS y0, 0 AS x0, 'Orders' AS caption, k % 11 = 0 AS bare FROM accounts
"""
FIGURES = """
    SELECT doc_id, 'f1' AS figure_id, 3 AS page_number, 30 AS y0, 0 AS x0, CASE WHEN k % 7 = 0 THEN NULL ELSE 'Order volume chart' END AS caption, 'chart' AS figure_type FROM accounts
"""
HEADERS = ("Order", "Status", "Total Price", "Order Date")


#: Right and lower ends of boxes: of a text by its length, of tables and figures always the same.
CHAR_WIDTH, LINE_HEIGHT, TABLE_BOX, FIGURE_BOX = 5, 8, (480, 200), (300, 80)


class Statements:
    """The statements' blocks, tables, figures and table rows as DataFrames.

    Accounts and their orders feed everything else, so both are written once.
    """

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def _over(self, sql: str) -> DataFrame:
        """SQL over the tables that it names, large ones dealt by customer."""
        named = {t: self.spark.read.parquet(f"{self.sf_dir}/{t}.parquet") for t in ("customer", "nation", "orders") if re.search(rf"\b{t}\b", sql)}
        tasks = tasks_for(self.spark, named["orders"].count())
        for table, key in (("customer", "c_custkey"), ("orders", "o_custkey")):
            named[table] = dealt(named[table], tasks, key)
        return self.spark.sql(re.sub(rf"\b(FROM|JOIN) ({'|'.join(named)})\b", r"\1 {\2}", sql), **named)

    @cached_property
    def accounts(self) -> DataFrame:
        return written(self._over(SUMMED), "accounts", many=True)

    @cached_property
    def orders(self) -> DataFrame:
        return written(self._over(ORDERS), "account-orders", many=True)

    @cached_property
    def blocks(self) -> DataFrame:
        """One pass over the accounts for all blocks but the list items, which come from the orders."""
        s = lambda c: F.col(c).cast("string")
        always = F.lit(True)

        def block(name: str, page: int, y0: int, order: int, kind: str, text: Column, there: Column = always) -> Column:
            return F.struct(
                F.lit(name).alias("block_id"), F.lit(page).alias("page_number"), F.lit(y0).alias("y0"), F.lit(0).alias("x0"), F.lit(order).alias("reading_order"), F.lit(kind).alias("block_type"), text.alias("text"), there.alias("there")
            )

        k = F.col("k")
        headed = k % 17 != 5
        every = F.array(
            block("h1", 1, 0, 0, "heading", F.lit("1 Account Overview"), headed),
            block("b1", 1, 10, 1, "paragraph", F.concat(F.lit("Account Balance: USD "), s("balance"))),
            block("b2", 1, 20, 2, "paragraph", F.concat(F.lit("Market Segment: "), F.col("segment"))),
            block("b3", 1, 30, 3, "paragraph", F.concat(F.lit("Account Holder Services in "), F.col("nation"), F.lit(" keeps ACCT-"), s("k"), F.lit(" under review. This section introduces Table 1."))),
            block("h2", 2, 0, 0, "heading", F.lit("1.1 Order Results"), headed),
            block("h3", 3, 0, 0, "heading", F.lit("2 Revenue Notes"), headed),
            block("b4", 3, 10, 1, "paragraph", F.concat(F.lit("Total revenue was USD "), s("revenue"), F.lit(" between "), F.col("first_day"), F.lit(" and "), F.col("last_day"), F.lit(". Refer to Figure 1 and Section 1.1 for context."))),
            block("b5", 3, 20, 2, "paragraph", F.lit("See Table 2 for the tax balance."), k % 2 == 1),
            block("b6", 3, 25, 3, "paragraph", F.lit("Figure captions follow."), k % 13 == 0),
            block("b7", 3, 40, 4, "list_item", F.lit("a) closing item"), k % 3 == 0),
        )
        fixed = self.accounts.select("doc_id", F.explode(F.filter(every, lambda b: b["there"])).alias("b")).select("doc_id", "b.*").drop("there")
        text = F.concat(s("i"), F.lit(". Order "), F.col("order_id"), F.lit(" placed "), F.col("day"), F.lit(" with status "), F.col("status"))
        listed = self.orders.select(
            "doc_id", F.concat(F.lit("l"), s("i")).alias("block_id"), F.lit(2).alias("page_number"), (F.col("i") + 10).alias("y0"), F.lit(0).alias("x0"), F.col("i").alias("reading_order"), F.lit("list_item").alias("block_type"), text.alias("text")
        )
        return fixed.unionByName(listed).withColumn("x1", F.col("x0") + F.length("text") * CHAR_WIDTH).withColumn("y1", F.col("y0") + LINE_HEIGHT)

    @cached_property
    def tables(self) -> DataFrame:
        rows = self.accounts.select("doc_id", F.lit("t1").alias("table_id"), F.lit(2).alias("page_number"), F.lit(100000).alias("y0"), F.lit(0).alias("x0"), F.lit("Orders").alias("caption"), (F.col("k") % 11 == 0).alias("bare"))
        return rows.withColumn("x1", F.lit(TABLE_BOX[0])).withColumn("y1", F.col("y0") + TABLE_BOX[1])

    @cached_property
    def figures(self) -> DataFrame:
        caption = F.when(F.col("k") % 7 != 0, "Order volume chart")
        rows = self.accounts.select("doc_id", F.lit("f1").alias("figure_id"), F.lit(3).alias("page_number"), F.lit(30).alias("y0"), F.lit(0).alias("x0"), caption.alias("caption"), F.lit("chart").alias("figure_type"))
        return rows.withColumn("x1", F.lit(FIGURE_BOX[0])).withColumn("y1", F.col("y0") + FIGURE_BOX[1])


#: The same inputs as common table expressions, for SQL that states an operator's result.
WITH = f"accounts AS ({ACCOUNTS}), account_orders AS ({ORDERS}), blocks AS ({BLOCKS}), tables AS ({TABLES}), figures AS ({FIGURES})"
