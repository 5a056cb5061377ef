"""Multi-tenant sources (I1-I4): tenant union, eligibility, code check, copy list.

At cluster scale a tenant is a partition value of one dataset, read with one
scan (partition pruning selects tenants); a dict of per-tenant readers is
also accepted for a handful of sources. The eligibility scan is one grouped
aggregation over the catalog instead of one lookup per tenant and table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Tables a tenant must own and the longest accepted tenant code.
REQUIRED_TABLES = ["archived_line", "archived_header", "current_line", "current_header",
                   "account", "journal"]
MAX_CODE_LENGTH = 20


def tenant_union(readers: dict[str, DataFrame], tenant_col: str = "client_code") -> DataFrame:
    """Each tenant's table tagged with its code, appended by column name."""
    parts = [df.withColumn(tenant_col, F.lit(code)) for code, df in readers.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_tenants(spark: SparkSession, path: str, schema: StructType,
                 tenant_col: str = "client_code") -> DataFrame:
    """I1 at scale: a dataset laid out as ``path/<tenant_col>=<code>/``; the
    tenant column comes back as text (codes keep their leading zeros)."""
    full = schema if tenant_col in schema.fieldNames() else StructType(
        [*schema.fields, StructField(tenant_col, StringType())])
    return spark.read.schema(full).option("basePath", path).parquet(path)


def like_prefix(c: Column, prefix: str, escaped: bool = True) -> Column:
    """F8: ``LIKE 'prefix%'``. Unescaped, each '_' in the prefix matches any
    one character (the shell scripts' behaviour); escaped it is a literal."""
    if escaped:
        return c.startswith(prefix)
    pattern = "^" + "".join("." if ch == "_" else _re_escape(ch) for ch in prefix)
    return c.rlike(pattern)


def _re_escape(ch: str) -> str:
    return "\\" + ch if ch in ".^$*+?{}[]\\|()" else ch


def eligible_tenants(catalog: DataFrame, *, prefix: str, excluded: list[str],
                     required: list[str] = REQUIRED_TABLES, escaped: bool = True) -> DataFrame:
    """Schemas with the tenant prefix, not excluded, that own every
    required table (GROUP BY schema HAVING count(DISTINCT table) = n)."""
    c = catalog.filter(like_prefix(F.col("schema_name"), prefix, escaped)
                       & ~F.col("schema_name").isin(excluded)
                       & F.col("table_name").isin(required))
    return (c.groupBy("schema_name").agg(F.countDistinct("table_name").alias("tables"))
            .filter(F.col("tables") == len(required)))


def tenant_code_check(tenants: DataFrame, *, prefix: str,
                      max_len: int = MAX_CODE_LENGTH) -> DataFrame:
    """Tenant code = upper(schema name without the prefix); codes longer
    than ``max_len`` are flagged as rejected (the caller counts them)."""
    code = F.upper(F.regexp_replace("schema_name", "^" + prefix, ""))
    return (tenants.select("schema_name", code.alias("client_code"))
            .withColumn("code_length", F.length("client_code"))
            .withColumn("accepted", F.col("code_length") <= max_len))


def copy_selection(catalog: DataFrame, exclude_patterns: list[str]) -> DataFrame:
    """I4: tables to copy = every table whose name matches none of the patterns."""
    bad = reduce(lambda a, b: a | b, [F.col("table_name").rlike(p) for p in exclude_patterns])
    return catalog.filter(~bad)


def copy_tables(spark: SparkSession, sources: dict[str, DataFrame], exclude_patterns: list[str], root: str) -> DataFrame:
    """I4: copy every table of ``sources`` whose name matches no pattern to
    ``root/<name>``; returns (table_name, rows) read back from the copies. The
    loop is over table names; each copy is one Spark write."""
    names = spark.createDataFrame([(n,) for n in sorted(sources)], "table_name string")
    chosen = [r.table_name for r in copy_selection(names, exclude_patterns).collect()]
    for n in chosen:
        sources[n].write.mode("errorifexists").parquet(f"{root}/{n}")
    parts = [spark.read.schema(sources[n].schema).parquet(f"{root}/{n}").agg(F.count(F.lit(1)).alias("rows"))
             .select(F.lit(n).alias("table_name"), "rows") for n in chosen]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], "table_name string, rows long")
