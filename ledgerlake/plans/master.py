"""Master-data layer: one client list across sources, staff, contacts.

Entity resolution is a key match on the nine-character company number. The
set form used here is one FULL OUTER JOIN of the kept legacy and cloud rows on
the number, which reads each side once. Every number, valid or not, is kept once
per source: the smallest row key wins (a grouped ``min``, with a map-side partial
step), the others are returned as rejects instead of failing the load. Rows without
a number are all kept under numbers of their own, so they never meet in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import normalize as N
from ..operators.pattern_join import like_join

SERVICE_FLAGS = ["has_books_legacy", "has_books_cloud", "has_books_other", "has_payroll",
                 "has_payroll_alt", "has_legal", "has_audit"]

MASTER_COLUMNS = [
    "company_no", "client_code", "company_id", "external_id", "name", "site_no", "title",
    "legal_form", "tax_category", "tax_regime", "activity_code", "activity_label", "city",
    "postal_code", "region", "email", "phone", "director", "manager", "accountant", "office",
    "internal_account", "entry_date", "exit_date", "active", *SERVICE_FLAGS,
]


def _by_number(df: DataFrame, row_key: str) -> DataFrame:
    """One row per ``_number``: the company number, the smallest ``row_key`` (the
    table's unique key) keeping it. A row without a number has a ``_number`` of its
    own that meets no other, so all such rows are kept and spread over the tasks.
    A minimum of whole rows is found by sorting, before the shuffle too: rows are dealt
    by their key first, as few input files would give a few tasks all rows to sort."""
    own = F.concat(F.lit(f"\0{row_key} "), F.monotonically_increasing_id().cast("string"))
    rest = [c for c in df.columns if c != row_key]
    first = (df.withColumn("_number", F.coalesce("company_no", own)).repartition(row_key).groupBy("_number")
             .agg(F.min(F.struct(row_key, *rest)).alias("_row")))
    return first.select("_number", "_row.*")


def _lost_numbers(df: DataFrame, row_key: str) -> DataFrame:
    """Rows that lose their number to a smaller ``row_key``."""
    first = df.filter(F.col("company_no").isNotNull()).groupBy("company_no").agg(F.min(row_key).alias("_first"))
    return df.join(first, "company_no").filter(F.col(row_key) != F.col("_first")).drop("_first")


# master columns only one side has, or that the legacy side fills first when both are there
OWN_ONLY = ["client_code", "site_no", "title", "activity_label", "region", "email", "phone", "internal_account"]
OWN_FIRST = ["name", "activity_code", "city", "postal_code", "director", "manager", "accountant", "office"]
FILLED = ["legal_form", "tax_category", "tax_regime"]


def master_clients(legacy: DataFrame, cloud: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Master client list and the rows rejected for a duplicate number.

    ``legacy`` is the output of ``client_star`` and ``cloud`` of ``cloud_clients``.
    A legacy number counts only if it is valid (nine characters).
    """
    own = legacy.withColumn("company_no", F.when(N.valid_company_no("company_no"), F.col("company_no")))
    left = _by_number(own, "client_code").select(
        "_number", F.col("company_no").alias("o_no"), *OWN_ONLY, *[F.col(c).alias(f"o_{c}") for c in OWN_FIRST + FILLED],
        N.parse_ymd("entry_date").alias("entry_date"), F.lit(True).alias("in_own"))
    right = _by_number(cloud, "company_id").select(
        "_number", F.col("company_no").alias("c_no"), "company_id", "external_id",
        *[F.col(c).alias(f"c_{c}") for c in OWN_FIRST + FILLED], F.lit(True).alias("in_cloud"))
    merged = left.join(right, "_number", "full_outer").withColumn("company_no", F.coalesce("o_no", "c_no"))
    in_own, in_cloud = (F.coalesce(F.col(c), F.lit(False)) for c in ("in_own", "in_cloud"))
    values = {c: F.when(in_own, F.col(f"o_{c}")).otherwise(F.col(f"c_{c}")) for c in OWN_FIRST}
    for c in FILLED:   # a blank own value is filled from the cloud row of the same number
        values[c] = F.when(in_cloud, F.coalesce(N.blank_to_null(f"o_{c}"), F.col(f"c_{c}"))).otherwise(F.col(f"o_{c}"))
    values |= {"exit_date": F.lit(None).cast("date"), "active": F.lit(True),
               "has_books_legacy": in_own, "has_books_cloud": in_cloud}
    values |= {flag: F.lit(False) for flag in SERVICE_FLAGS if flag not in values}
    master = merged.select(*[values.get(c, F.col(c)).alias(c) for c in MASTER_COLUMNS])

    lost = [df.select(F.lit(source).alias("source"), "company_no", F.col(key).cast("string").alias("row_key"),
                      F.lit("duplicate company number").alias("reason"))
            for source, df, key in (("legacy", _lost_numbers(own, "client_code"), "client_code"),
                                    ("cloud", _lost_numbers(cloud, "company_id"), "company_id"))]
    return master, lost[0].unionByName(lost[1])


def master_counts(master: DataFrame) -> DataFrame:
    """The four counts printed after the master load (one pass, A11)."""
    lg, cl = F.col("has_books_legacy"), F.col("has_books_cloud")
    return master.agg(
        F.count(F.lit(1)).alias("total"),
        F.sum(F.when(lg & ~cl, 1).otherwise(0)).alias("legacy_only"),
        F.sum(F.when(~lg & cl, 1).otherwise(0)).alias("cloud_only"),
        F.sum(F.when(lg & cl, 1).otherwise(0)).alias("both"))


def source_mix(master: DataFrame) -> DataFrame:
    """Number of master clients by source combination."""
    lg, cl = F.col("has_books_legacy"), F.col("has_books_cloud")
    bucket = (F.when(lg & cl, F.lit("legacy + cloud")).when(lg, F.lit("legacy only"))
              .when(cl, F.lit("cloud only")).otherwise(F.lit("no source")))
    return master.groupBy(bucket.alias("source")).agg(F.count(F.lit(1)).alias("clients"))


def staff_reference(staff: DataFrame, offices: DataFrame, services: DataFrame,
                    functions: DataFrame) -> DataFrame:
    """Staff with office, service and function labels; blank exit -> NULL."""
    off = offices.select(F.col("code").alias("office_code"), F.col("label").alias("office"))
    srv = services.select(F.col("code").alias("service_code"), F.col("label").alias("service"))
    fn = functions.select(F.col("code").alias("function_code"), F.col("label").alias("function"))
    out = (staff.join(off, "office_code", "left").join(srv, "service_code", "left")
           .join(fn, "function_code", "left"))
    exit_date = F.when(F.col("exit_date") != "", N.parse_ymd("exit_date"))
    return out.select("code", "email", "last_name", "first_name", "office", "service", "function",
                      N.parse_ymd("entry_date").alias("entry_date"), exit_date.alias("exit_date"),
                      exit_date.isNull().alias("active"))


def contacts(contact: DataFrame, links: DataFrame, address: DataFrame, functions: DataFrame,
             master: DataFrame) -> DataFrame:
    """Contacts of active clients through the bridge table (J8), with the
    master client found on the computed company number (J5)."""
    from .staging import active_clients
    a = active_clients(address).select(F.col("id").alias("address_id"),
                                       N.company_no_of("site_no").alias("company_no"))
    fn = functions.select(F.col("code").alias("function_code"), F.col("label").alias("function"))
    known = master.filter(N.valid_company_no("company_no")).select(
        F.col("company_no").alias("_known"), F.col("company_no").alias("master_company_no"))
    rows = (contact.join(links, contact.id == links.contact_id, "inner")
            .join(a, "address_id", "inner").join(fn, "function_code", "left"))
    out = N.left_join_valid(rows, known, "company_no", "_known", N.valid_company_no("company_no"))
    return out.select("master_company_no", "company_no", F.col("id").alias("contact_id"),
                      "last_name", "first_name", "email", N.digits_only_phone("phone").alias("phone"),
                      "function")


# Fee-account patterns and the service each one reveals.
SERVICE_PATTERNS = [
    ("706100%", "BOOKKEEPING"),
    ("706110%", "BOOKKEEPING"),
    ("706120%", "BOOKKEEPING"),
    ("706200%", "PAYROLL"),
    ("706210%", "PAYROLL"),
    ("706300%", "LEGAL"),
    ("706310%", "LEGAL"),
    ("706400%", "AUDIT"),
    ("706410%", "AUDIT"),
]


def detect_services(internal_ledger: DataFrame, patterns: DataFrame) -> DataFrame:
    """One row per client with a flag per service seen on its fee accounts.

    ``account LIKE pattern`` is a theta join; it runs as an equi-join on the text
    each pattern is anchored by (``operators/pattern_join.py``), whatever the
    pattern. Only the distinct (client, account) pairs enter it.
    """
    used = internal_ledger.select("client_code", "account").distinct()
    hits = like_join(used, patterns, "account", "pattern")
    svc = F.col("service")
    return hits.groupBy("client_code").agg(
        F.max(svc == "BOOKKEEPING").alias("has_books_other"),
        F.max(svc == "PAYROLL").alias("has_payroll"),
        F.max(svc == "LEGAL").alias("has_legal"),
        F.max(svc == "AUDIT").alias("has_audit"))


def apply_services(master: DataFrame, detected: DataFrame) -> DataFrame:
    """Set the service flags of master clients from ``detect_services``. Clients
    without a code of their own (cloud ones) take no part in the join; codes meet
    under the sources' collation."""
    flags = ["has_books_other", "has_payroll", "has_legal", "has_audit"]
    d = detected.groupBy(N.key_of("client_code").alias("_code")).agg(*[F.max(c).alias(f"d_{c}") for c in flags])
    out = N.left_join_valid(master.withColumn("_client", N.key_of("client_code")), d, "_client", "_code", ~N.is_blank("client_code"))
    for c in flags:
        out = out.withColumn(c, F.coalesce(F.col(f"d_{c}"), F.col(c)))
    return out.select(*MASTER_COLUMNS)
