"""Flatten, names, projection, unpivot."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sievebed.catalog.base import Query, table
from sievebed.operators.flatten import expand_struct, flatten
from sievebed.operators.names import clean_names, filtered_view, project, strip_names
from sievebed.operators.reshape import distinct_prefixes, unpivot


def flatten_arrays(spark: SparkSession, folder: str) -> DataFrame:
    """Two arrays of unequal length per document, lined up by position."""
    texts = table(spark, folder, "documents").select(
        "doc_id", F.split("text", "\n").alias("line"), F.split("text", " ").alias("word")
    )
    return flatten(texts)


def flatten_struct_array(spark: SparkSession, folder: str) -> DataFrame:
    """A struct beside an array of structs in the same row."""
    measures = F.array(
        *[
            F.struct(F.lit(name).alias("measure"), F.col(f"l_{name}").alias("value"))
            for name in ("quantity", "extendedprice", "discount", "tax")
        ]
    )
    nested = table(spark, folder, "lineitem").select(
        "l_partkey",
        F.struct(F.col("l_orderkey").alias("order"), F.col("l_linenumber").alias("line")).alias("id"),
        measures.alias("data"),
    )
    return flatten(nested)


def flatten_nested(spark: SparkSession, folder: str) -> DataFrame:
    """Arrays inside structs inside arrays; names with dots and dashes."""
    lines = F.transform(
        F.split("text", "\n"), lambda line: F.struct(line.alias("line.text"), F.split(line, " ").alias("words"))
    )
    turns = table(spark, folder, "conversations").select(
        "conv_id", "turn", F.struct(F.col("role").alias("role"), lines.alias("lines")).alias("data")
    )
    return flatten(turns)


def flatten_outer(spark: SparkSession, folder: str) -> DataFrame:
    """Rows with a null or an empty array stay, with a null."""
    names = F.when(F.col("p_size") % 3 == 0, F.array("p_name", "p_brand")).when(
        F.col("p_size") % 3 == 1, F.array().cast("array<string>")
    )
    return flatten(table(spark, folder, "part").select("p_partkey", names.alias("label")), outer=True)


def flatten_inner(spark: SparkSession, folder: str) -> DataFrame:
    """Rows go when one array is null, or when all are empty."""
    names = F.when(F.col("p_size") % 3 == 0, F.array("p_name", "p_brand")).when(
        F.col("p_size") % 3 == 1, F.array().cast("array<string>")
    )
    sizes = F.when(F.col("p_size") % 2 == 0, F.array("p_size")).otherwise(F.array().cast("array<int>"))
    nested = table(spark, folder, "part").select("p_partkey", names.alias("label"), sizes.alias("size"))
    return flatten(nested)


def explode_embedding(spark: SparkSession, folder: str) -> DataFrame:
    return flatten(table(spark, folder, "embeddings"))


def star_expand(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("ticker"),
        F.struct(
            F.col("p_name").alias("name"), F.col("p_brand").alias("brand"), F.col("p_size").alias("size")
        ).alias("data"),
    )
    return expand_struct(documents)


def clean_column_names(spark: SparkSession, folder: str) -> DataFrame:
    awkward = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("DIV. LÍQUIDA / EBITDA"),
        F.col("c_name").alias("P/L"),
        F.col("c_acctbal").alias("VALOR (R$)"),
        F.col("c_nationkey").alias("Nation-Key"),
        F.col("c_mktsegment").alias("ÔNUS.total"),
    )
    return clean_names(awkward)


def strip_column_names(spark: SparkSession, folder: str) -> DataFrame:
    prefixed = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("ticker"),
        F.col("s_name").alias("data-name"),
        F.col("s_acctbal").alias("data-values-data-balance"),
    )
    return strip_names(prefixed, "data-")


def rename_columns(spark: SparkSession, folder: str) -> DataFrame:
    return project(
        table(spark, folder, "orders"),
        {"o_orderpriority": "rank", "o_orderkey": "ticker", "o_totalprice": "quotation"},
    )


def unpivot_grid(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as one wide row per customer, two measures per year, back to rows."""
    yearly = (
        table(spark, folder, "orders")
        .select(F.col("o_custkey").alias("ticker"), F.year("o_orderdate").alias("year"), "o_totalprice")
        .groupBy("ticker")
        .pivot("year", list(range(1992, 1999)))
        .agg(F.max("o_totalprice").alias("net_profit"), F.min("o_totalprice").alias("quotation"))
    )
    wide = yearly.toDF(*[name.replace("_", "-", 1) if name != "ticker" else name for name in yearly.columns])
    return unpivot(wide)


def unpivot_bad_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Unreadable numbers and an absent column give nulls."""
    wide = table(spark, folder, "part").select(
        F.col("p_partkey").alias("ticker"),
        F.col("p_type").alias("2013-net_profit"),
        F.col("p_retailprice").cast("string").alias("2013-quotation"),
        F.col("p_size").alias("2012-net_profit"),
    )
    return unpivot(wide)


def distinct_priorities(spark: SparkSession, folder: str) -> DataFrame:
    return distinct_prefixes(table(spark, folder, "orders"), "o_orderpriority")


def sql_select(spark: SparkSession, folder: str) -> DataFrame:
    return filtered_view(
        table(spark, folder, "lineitem"),
        "t",
        ["l_orderkey", "l_linenumber", "l_quantity"],
        "1 = 1 AND t.l_partkey = t.l_suppkey",
    )


_PART_LABEL = """case when p_size % 3 = 0 then [p_name, p_brand]
                      when p_size % 3 = 1 then []::varchar[] end"""

QUERIES = {
    "flatten_arrays": Query(
        flatten_arrays,
        "SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(string_split(text, ' ')) AS word"
        " FROM documents",
    ),
    "flatten_struct_array": Query(
        flatten_struct_array,
        """
        SELECT l_partkey, l_orderkey AS "id-order", l_linenumber AS "id-line", 'quantity' AS "data-measure",
               l_quantity AS "data-value" FROM lineitem
        UNION ALL SELECT l_partkey, l_orderkey, l_linenumber, 'extendedprice', l_extendedprice FROM lineitem
        UNION ALL SELECT l_partkey, l_orderkey, l_linenumber, 'discount', l_discount FROM lineitem
        UNION ALL SELECT l_partkey, l_orderkey, l_linenumber, 'tax', l_tax FROM lineitem
        """,
    ),
    "flatten_nested": Query(
        flatten_nested,
        """
        SELECT conv_id, turn, role AS "data-role", line AS "data-lines-line.text",
               unnest(string_split(line, ' ')) AS "data-lines-words"
        FROM (SELECT conv_id, turn, role, unnest(string_split(text, chr(10))) AS line FROM conversations)
        """,
    ),
    "flatten_outer": Query(
        flatten_outer,
        """
        SELECT p_partkey, unnest(CASE WHEN p_size % 3 = 0 THEN [p_name, p_brand] ELSE [NULL] END) AS label
        FROM part
        """,
    ),
    "flatten_inner": Query(
        flatten_inner,
        f"""
        SELECT p_partkey, unnest({_PART_LABEL}) AS label,
               unnest(CASE WHEN p_size % 2 = 0 THEN [p_size] ELSE []::int[] END) AS size
        FROM part WHERE p_size % 3 <> 2
        """,
    ),
    "explode_embedding": Query(
        explode_embedding, "SELECT vec_id, label, unnest(embedding) AS embedding FROM embeddings"
    ),
    "star_expand": Query(
        star_expand,
        "SELECT p_partkey::varchar AS ticker, p_name AS name, p_brand AS brand, p_size AS size FROM part",
    ),
    "clean_column_names": Query(
        clean_column_names,
        """
        SELECT c_custkey AS "div__liquida_ebitda", c_name AS "p_l", c_acctbal AS "valor_r$",
               c_nationkey AS "nation_key", c_mktsegment AS "onus_total" FROM customer
        """,
    ),
    "strip_column_names": Query(
        strip_column_names,
        'SELECT s_suppkey AS ticker, s_name AS name, s_acctbal AS "values-balance" FROM supplier',
    ),
    "rename_columns": Query(
        rename_columns,
        "SELECT o_orderpriority AS rank, o_orderkey AS ticker, o_totalprice AS quotation FROM orders",
    ),
    "unpivot_grid": Query(
        unpivot_grid,
        """
        WITH yearly AS (
            SELECT o_custkey AS ticker, year(o_orderdate)::varchar AS year,
                   max(o_totalprice) AS net_profit, min(o_totalprice) AS quotation
            FROM orders GROUP BY ALL)
        SELECT t.ticker, y.year, net_profit, quotation
        FROM (SELECT DISTINCT ticker FROM yearly) t
        CROSS JOIN (SELECT unnest(range(1992, 1999))::varchar AS year) y
        LEFT JOIN yearly USING (ticker, year)
        """,
    ),
    "unpivot_bad_numbers": Query(
        unpivot_bad_numbers,
        """
        SELECT p_partkey AS ticker, '2012' AS year, p_size::double AS net_profit, NULL::double AS quotation FROM part
        UNION ALL
        SELECT p_partkey, '2013', try_cast(p_type AS double), p_retailprice FROM part
        """,
    ),
    "distinct_prefixes": Query(
        distinct_priorities, "SELECT DISTINCT split_part(o_orderpriority, '-', 1) AS prefix FROM orders ORDER BY 1"
    ),
    "sql_select": Query(
        sql_select,
        "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem t WHERE 1 = 1 AND t.l_partkey = t.l_suppkey",
    ),
}
