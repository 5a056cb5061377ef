"""Source-side extracts.

I7 takes a table over page by page in key order, and goes on where a killed run
stopped. A plan comes first: the key ranges the table falls into, from approximate
quantiles of the key column. Then the ranges are extracted a group at a time; each
group is one Spark job that reads only its key range (a filter that reaches the
scan), numbers the rows of every range by itself and writes them. A finished group
is never read again. Nothing is sorted, shuffled or checkpointed as a whole: a row's
number is its place in its range plus the rows of the ranges before, which are
counted on the files that were written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..session import adopt, path_complete

ROWS_PER_RANGE = 2_000_000   # rows one task sorts, about
RANGES_PER_GROUP = 64        # ranges one job extracts; the unit that is repeated or skipped
ATTEMPTS = 2                 # a group that fails is tried so often before the run fails


class ExtractFailed(RuntimeError):
    """Some groups could not be extracted; the others are kept for the next run."""


def plan_pages(df: DataFrame, key: str, path: str, *, rows_per_range: int = ROWS_PER_RANGE,
               ranges_per_group: int = RANGES_PER_GROUP) -> DataFrame:
    """The stored plan of an extract at ``path``: one row per key range (group,
    range, lo, hi), ``lo`` included and ``hi`` not, NULL for no bound. A plan that is
    there already is the plan: a run that goes on keeps its ranges."""
    spark, place = df.sparkSession, f"{path}/plan"
    if not path_complete(spark, place):
        keys = df.select(F.col(key).alias("k")).filter("k is not null")
        kind = f"array<{keys.schema['k'].dataType.simpleString()}>"
        ranges = max(1, -(-keys.count() // rows_per_range))
        shares = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
        bounds = F.percentile_approx("k", shares, 10 * ranges + 1000) if ranges > 1 else F.array().cast(kind)
        cuts = keys.agg(F.coalesce(F.array_sort(F.array_distinct(bounds)), F.array().cast(kind)).alias("cuts"))
        plan = (cuts.select("cuts", F.posexplode(F.concat(F.array(F.lit(None)).cast(kind), F.col("cuts"))).alias("range", "lo"))
                .select(F.floor(F.col("range") / ranges_per_group).cast("int").alias("group"), "range", "lo",
                        F.get("cuts", F.col("range")).alias("hi")))
        plan.coalesce(1).write.mode("overwrite").parquet(place)          # one row per range
    return spark.read.parquet(place)


def _group(path: str, group: int) -> str:
    return f"{path}/pages/group={group}"


def _groups(spark: SparkSession, path: str) -> list[tuple[int, bool]]:
    """(group, whether it is extracted), in order. A group stands for millions of rows."""
    found = spark.read.parquet(f"{path}/plan").select("group").distinct().orderBy("group").collect()
    return [(r.group, path_complete(spark, _group(path, r.group))) for r in found]


def page_state(spark: SparkSession, path: str) -> DataFrame:
    """The manifest of an extract: its ranges with their bounds, rows and whether they are extracted (``done``)."""
    done = spark.createDataFrame([(g,) for g, ok in _groups(spark, path) if ok], StructType([StructField("group", IntegerType())]))
    plan = spark.read.parquet(f"{path}/plan").join(done.withColumn("done", F.lit(True)), "group", "left").fillna(False, ["done"])
    if done.isEmpty():
        return plan.withColumn("rows", F.lit(None).cast("long"))
    rows = spark.read.parquet(f"{path}/pages").groupBy("range").agg(F.count(F.lit(1)).alias("rows"))
    return plan.join(rows, "range", "left").withColumn("rows", F.when(F.col("done"), F.coalesce("rows", F.lit(0))))


def _extract(df: DataFrame, key: str, path: str, plan: DataFrame, group: int) -> None:
    """One group: read its key range, number the rows of every range, write them."""
    mine = plan.filter(F.col("group") == group)
    rows = df.filter(F.col(key).isNotNull())
    first, last = (mine.orderBy(order).first() for order in (F.col("range").asc(), F.col("range").desc()))
    if first.lo is not None:
        rows = rows.filter(F.col(key) >= F.lit(first.lo))
    if last.hi is not None:
        rows = rows.filter(F.col(key) < F.lit(last.hi))
    bounds = F.broadcast(mine.select("range", "lo", "hi"))               # RANGES_PER_GROUP rows
    placed = rows.join(bounds, (F.col("lo").isNull() | (F.col(key) >= F.col("lo"))) & (F.col("hi").isNull() | (F.col(key) < F.col("hi"))))
    out = placed.withColumn("place", F.row_number().over(Window.partitionBy("range").orderBy(key)).cast("long"))
    made = f"{path}/tries/group={group}"
    out.select(*df.columns, "range", "place").write.mode("overwrite").parquet(made)
    adopt(df.sparkSession, made, _group(path, group))


def read_pages(spark: SparkSession, path: str, schema: StructType, page_size: int) -> DataFrame:
    """The extracted rows with ``row_no`` (1-based, in key order) and ``page``."""
    stored = StructType([*schema.fields, StructField("range", IntegerType()), StructField("place", LongType())])
    rows = spark.read.schema(stored).parquet(f"{path}/pages")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)      # one row per range
    counts = rows.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    offsets = counts.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    row_no = F.col("before") + F.col("place")
    return rows.join(offsets, "range").select(*schema.fieldNames(), row_no.alias("row_no"),
                                              F.floor((row_no - 1) / page_size).cast("long").alias("page"))


def extract_pages(df: DataFrame, key: str, page_size: int, path: str, *, attempts: int = ATTEMPTS, **plan_options) -> DataFrame:
    """``df`` in pages of ``page_size`` rows in ``key`` order, stored at ``path``.

    Adds ``row_no`` (1-based) and ``page`` = (row_no - 1) // page_size. ``key`` must
    be unique, as the id paging of the source assumes; rows without a key aren't paged.
    A run that is started again with the same ``path`` extracts only the groups that
    are missing. A group that fails is tried ``attempts`` times; the others go on,
    and the run then fails naming the groups it still lacks.
    """
    spark = df.sparkSession
    plan = plan_pages(df, key, path, **plan_options)
    failed = {}
    for group, done in _groups(spark, path):
        for _ in range(0 if done else attempts):
            try:
                _extract(df, key, path, plan, group)
                failed.pop(group, None)
                break
            except Exception as e:                                        # noqa: BLE001 - whatever the source raises
                failed[group] = str(e)[:200]
    if failed:
        raise ExtractFailed(f"groups {sorted(failed)} of {path} failed: {failed}")
    return read_pages(spark, path, df.schema, page_size)


def clean_projection(company: DataFrame) -> DataFrame:
    """I8: the extract's text clean-up: ',' -> ';' in free text, '.' removed
    from activity codes (they would break the comma-separated transfer)."""
    def semi(c):
        return F.replace(F.col(c), F.lit(","), F.lit(";"))
    return company.select(
        "company_id", semi("name").alias("name"), semi("firm").alias("firm"),
        semi("trade_name").alias("trade_name"), "registration_no", semi("city").alias("city"),
        "postal_code", "tax_category", "tax_regime",
        F.replace(F.col("activity_code"), F.lit("."), F.lit("")).alias("activity_code"),
        semi("sector").alias("sector"), semi("legal_form").alias("legal_form"), "created", "updated")


def clean_ledger_projection(ledger: DataFrame) -> DataFrame:
    """I8, ledger half: ',' -> ';' in labels, no journal -> '', no amount -> 0."""
    semi = lambda c: F.replace(F.col(c), F.lit(","), F.lit(";")).alias(c)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("decimal(18,2)")).alias(c)
    return ledger.select("line_id", "company_id", semi("company_name"), "day", "account", semi("account_label"),
                         F.coalesce("journal", F.lit("")).alias("journal"), semi("journal_label"),
                         zero("debit"), zero("credit"), "updated")
