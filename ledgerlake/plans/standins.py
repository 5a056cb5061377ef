"""Driver tables -> ledger model tables (stand-ins for the real sources).

The test data is a TPC-H-like star schema plus an event stream. Every model
table below is a pure DataFrame derivation of those parquet files, so each job
reads data whose size grows with the scale factor. The derivation rules are
deliberately simple arithmetic on keys so that the DuckDB oracle can state the
same rules independently (``ledgerlake/plans/oracle.py``).

Tenants ("clients") of the legacy tool are ``lpad(orderkey % 100, 5, '0')``;
companies of the cloud tool are suppliers; staff are event users.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.normalize import HOURS, MONEY, by_shuffle
from ..operators.colocated import buckets_for
from ..session import input_bytes, read_parquet

# Fixed values of the stand-in mapping (not taken from any source system).
ACCOUNT_PREFIXES = ["C", "F", "411", "401", "512", "606", "70", "c", "f", "7"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
OFFICES = [("AUTOMOBILE", "North"), ("BUILDING", "South"),
           ("FURNITURE", "East"), ("HOUSEHOLD", "West")]  # MACHINERY left out
LEGAL_FORMS = [("LF0", "SARL"), ("LF1", "SAS"), ("LF2", "SA"), ("LF3", "SCI")]
ACTIVITIES = [("A0", "Retail"), ("A1", "Building"), ("A2", "Transport"),
              ("A3", "Catering"), ("A4", "Consulting"), ("A5", "Farming")]
TITLES = [("T0", "Mr"), ("T1", "Ms")]
SERVICES = [("SV0", "Bookkeeping"), ("SV1", "Payroll")]
FUNCTIONS = [("FN0", "Manager"), ("FN1", "Director"), ("FN2", "Assistant")]
TASKS = [("click", "Data entry"), ("view", "Review"), ("purchase", "Closing"),
         ("signup", "Onboarding")]
CLOUD_FY_YEARS = [1996, 1998, 2000]
LEGACY_TABLES = ["archived_line", "archived_header", "current_line",
                 "current_header", "account", "journal"]

IN_MEMORY = 16       # bytes that a byte of lines in Parquet takes when its rows are sorted, about

LEGACY_AS_OF = dt.date(2001, 8, 1)
CLOUD_AS_OF = dt.date(2024, 2, 1)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events"]


def _lpad(c, n):
    """Zero-padded decimal text of a non-negative integral column; never
    truncates (plain ``lpad`` cuts longer text), and stays in codegen."""
    text = c.cast("string")
    return F.when(F.length(text) >= n, text).otherwise(F.lpad(text, n, "0"))


def _tenant(k):
    """Code of a tenant of the ledger tool; its import stores codes in upper case."""
    return F.concat(_lpad(k, 5), F.lit("A"))


def _journal(digit, lower: bool = False):
    """Journal code of a priority's digit; priority 4 has none. Spark would lower these literals
    in the driver, for which it loads the collations' tables (gigabytes of short-lived arrays there)."""
    a, b, c, d = (F.lit(x.lower() if lower else x) for x in ("AC", "VÉ", "OD", "BQ"))
    return F.when(digit == "1", a).when(digit == "2", b).when(digit == "3", c).when(digit == "5", d)


def _pick(index_col, values):
    """values[index_col] for a fixed list (a CASE over a literal list)."""
    expr = None
    for i, v in enumerate(values):
        expr = (F.when(index_col == i, F.lit(v)) if expr is None
                else expr.when(index_col == i, F.lit(v)))
    return expr


def literal_table(spark: SparkSession, rows, names) -> DataFrame:
    """A fixed lookup table built JVM-side (no Python worker, known tiny size).

    It is broadcast explicitly: its size is bounded by the literal list.
    """
    structs = [F.struct(*[F.lit(v).alias(n) for v, n in zip(r, names)]) for r in rows]
    return F.broadcast(spark.range(1).select(F.inline(F.array(*structs))))


class Standins:
    """Lazily derived model tables for one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._schemas: dict[str, StructType] = {}

    def raw(self, name: str) -> DataFrame:
        """An input table. Its schema is looked up once: each look is a job, with broadcasts
        that the driver holds until it next collects garbage."""
        df = read_parquet(self.spark, f"{self.sf_dir}/{name}.parquet", self._schemas.get(name))
        self._schemas[name] = df.schema
        return df

    def _lookup(self, rows, names) -> DataFrame:
        return literal_table(self.spark, rows, names)

    # ---------------------------------------------------------------- legacy ledger
    def headers(self) -> DataFrame:
        """Entry headers of all tenants, ``archived`` marks the archive bucket."""
        o = self.raw("orders")
        k = F.col("o_orderkey")
        month = F.when(k % 101 == 0, F.lit(13)).otherwise(F.month("o_orderdate"))
        digit = F.left("o_orderpriority", F.lit(1))
        code = _journal(digit)
        # written in either case, with and without accents and with trailing blanks
        journal = (F.when(k % 3 == 0, _journal(digit, lower=True)).when(k % 3 == 1, F.concat(F.replace(code, F.lit("É"), F.lit("E")), F.lit(" ")))
                   .otherwise(code))
        return (o.filter(k % 97 != 0)
                .select(_tenant(k % 100).alias("client_code"),
                        k.alias("entry_id"),
                        F.col("o_orderdate").alias("entered_at"),
                        F.year("o_orderdate").cast("short").alias("year"),
                        month.cast("byte").alias("month"),
                        journal.alias("journal"),
                        (k % 2 == 0).alias("archived")))

    def lines(self) -> DataFrame:
        li = self.raw("lineitem")
        k = F.col("l_orderkey")
        status_open = F.col("l_linestatus") == "O"
        amount = F.col("l_extendedprice").cast(MONEY)
        zero = F.lit(0).cast(MONEY)
        returned = F.col("l_returnflag") == "R"
        account = F.concat(_pick(F.col("l_partkey") % 10, ACCOUNT_PREFIXES), _lpad(F.col("l_partkey"), 5))
        return li.select(
            _tenant(k % 100).alias("client_code"),
            (k * 10 + F.col("l_linenumber")).alias("line_id"),
            k.alias("entry_id"),
            # second lines write their account in lower case, fifth ones with a blank: one account, three spellings
            F.when(F.col("l_linenumber") == 2, F.lower(account)).when(F.col("l_linenumber") == 5, F.concat(account, F.lit(" ")))
             .otherwise(account).alias("account"),
            F.when(status_open, zero).otherwise(amount).alias("credit"),
            F.when(status_open, amount).otherwise(zero).alias("debit"),
            F.col("l_returnflag").alias("label"),
            F.dayofmonth("l_shipdate").cast("short").alias("day"),
            F.concat(F.lit("D"), k.cast("string")).alias("document"),
            F.when(returned, F.concat(F.lit("M"), F.col("l_suppkey").cast("string")))
             .otherwise(F.lit("")).alias("match_code"),
            F.when(returned, 1).otherwise(0).cast("short").alias("match_flag"),
            F.when(returned, F.date_format("l_shipdate", "yyyyMMdd"))
             .otherwise(F.lit("")).alias("match_date"),
            F.to_date("l_shipdate").alias("posted"),
            (k % 2 == 0).alias("archived"),
        )

    def archived_headers(self) -> DataFrame:
        return self.headers().filter("archived").drop("archived")

    def current_headers(self) -> DataFrame:
        return self.headers().filter(~F.col("archived")).drop("archived")

    def archived_lines(self) -> DataFrame:
        return self.lines().filter("archived").drop("archived")

    def current_lines(self) -> DataFrame:
        return self.lines().filter(~F.col("archived")).drop("archived")

    def parts_used(self, part: DataFrame) -> DataFrame:
        """(client_code, l_partkey, n) of every tenant and part in its lines, with the columns of ``part``.

        The pairs are a few bytes each when shuffled and many when hashed, labelled and
        sorted, so AQE would give too many to a task: their input's size deals them. Parts grow with
        the input too and are hashed where they are dealt to, not broadcast."""
        least = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        tasks = buckets_for(input_bytes(self.spark, f"{self.sf_dir}/lineitem.parquet") * IN_MEMORY, least)
        used = (self.raw("lineitem").select(_tenant(F.col("l_orderkey") % 100).alias("client_code"), "l_partkey")
                .repartition(tasks, "client_code", "l_partkey").groupBy("client_code", "l_partkey").agg(F.count(F.lit(1)).alias("n")))
        return (used.repartition(tasks, "l_partkey")
                .join(by_shuffle(part.repartition(tasks, "p_partkey"), "shuffle_hash"), F.col("l_partkey") == F.col("p_partkey"), "inner"))

    def accounts(self) -> DataFrame:
        """Chart of accounts in use per tenant; labels from parts (1/13 missing); every fourth is there in two spellings."""
        part = self.raw("part").filter(F.col("p_partkey") % 13 != 0)
        account = F.concat(_pick(F.col("l_partkey") % 10, ACCOUNT_PREFIXES), _lpad(F.col("l_partkey"), 5))
        rows = self.parts_used(part)
        twin = rows.filter(F.col("l_partkey") % 4 == 0).select("client_code", F.concat(F.lower(account), F.lit(" ")).alias("account"),
                                                               F.upper("p_name").alias("label"))
        return rows.select("client_code", account.alias("account"), F.col("p_name").alias("label")).unionByName(twin)

    def journals(self) -> DataFrame:
        """Journals per tenant: priorities 1-3 (5 is left out, 4 has no journal), in two spellings."""
        o = self.raw("orders")
        digit = F.left("o_orderpriority", F.lit(1))
        code = F.when(F.col("o_orderkey") % 200 < 100, _journal(digit)).otherwise(_journal(digit, lower=True))
        return (o.filter(digit.isin("1", "2", "3"))
                .groupBy(_tenant(F.col("o_orderkey") % 100).alias("client_code"), code.alias("journal"))
                .agg(F.max(F.substring("o_orderpriority", 3, 40)).alias("label"))
                .withColumn("kind", F.lit("G")))

    # ------------------------------------------------------------ practice source
    def address(self) -> DataFrame:
        c = self.raw("customer")
        n = self.raw("nation")
        k = F.col("c_custkey")
        site = (F.when(k % 17 == 0, F.lit(""))
                .when(k % 19 == 0, _lpad(k, 7))
                .when(k % 23 == 0, F.concat(_lpad(k - 1, 9), F.lit("00020")))
                .otherwise(F.concat(_lpad(k, 9), F.lit("00010"))))
        joined = c.join(n, c.c_nationkey == n.n_nationkey, "left")
        return joined.select(
            k.alias("id"),
            # the practice writes every second client's code in lower case
            F.concat(_lpad(k, 5), F.when(k % 2 == 1, F.lit("a")).otherwise(F.lit("A"))).alias("code"),
            F.col("c_name").alias("name"),
            site.alias("site_no"),
            F.when(k % 13 == 5, F.lit("PROSPECT")).otherwise(F.lit("CLIENT")).alias("kind"),
            F.when(k % 11 == 3, F.lit("20000630")).when(k % 29 == 1, F.lit(None))
             .otherwise(F.lit("")).alias("exit_date"),
            F.concat(F.lit("LF"), (k % 5).cast("string")).alias("legal_code"),
            F.concat(F.lit("S"), _lpad(k % 50, 4)).alias("staff1"),
            F.concat(F.lit("S"), _lpad(k % 50 + 50, 4)).alias("staff2"),
            F.concat(F.lit("S"), _lpad(k % 50 + 100, 4)).alias("staff3"),
            F.concat(F.lit("A"), (k % 7).cast("string")).alias("activity_code"),
            F.col("n_regionkey").cast("string").alias("region_code"),
            F.col("c_mktsegment").alias("office_code"),
            F.concat(F.lit("T"), (k % 3).cast("string")).alias("title_code"),
            F.when(k % 2 == 0, F.lit("IS")).otherwise(F.lit("IR")).alias("tax_type"),
            F.when(k % 10 == 0, F.lit("")).when(k % 3 == 0, F.lit("RN"))
             .otherwise(F.lit("RS")).alias("tax_regime"),
            F.col("n_name").alias("city"),
            _lpad(F.col("c_nationkey") * 1000 + k % 1000, 5).alias("postal_code"),
            F.concat(F.lit("client"), k.cast("string"), F.lit("@example.org")).alias("email"),
            F.concat(F.lit("03 20 "), _lpad(k % 100, 2), F.lit(" 00")).alias("phone"),
            F.concat(F.lit("411"), _lpad(k, 5)).alias("internal_account"),
            F.date_format(F.date_add(F.lit("1995-01-01").cast("date"), (k % 2500).cast("int")),
                          "yyyyMMdd").alias("entry_date"),
        )

    def legal_forms(self) -> DataFrame:
        return self._lookup(LEGAL_FORMS, ["code", "label"])

    def activities(self) -> DataFrame:
        return self._lookup(ACTIVITIES, ["code", "label"])

    def titles(self) -> DataFrame:
        return self._lookup(TITLES, ["code", "label"])

    def offices(self) -> DataFrame:
        return self._lookup(OFFICES, ["code", "label"])

    def services(self) -> DataFrame:
        return self._lookup(SERVICES, ["code", "label"])

    def functions(self) -> DataFrame:
        return self._lookup(FUNCTIONS, ["code", "label"])

    def tasks(self) -> DataFrame:
        return self._lookup(TASKS, ["code", "label"])

    def regions(self) -> DataFrame:
        r = self.raw("region")
        return r.select(F.col("r_regionkey").cast("string").alias("code"),
                        F.col("r_name").alias("label"))

    def staff(self) -> DataFrame:
        e = self.raw("events")
        u = F.col("user_id")
        return (e.groupBy("user_id").agg(F.min("ts").alias("first_ts"))
                .select(F.concat(F.lit("S"), _lpad(u, 4)).alias("code"),
                        F.concat(F.lit("Last"), u.cast("string")).alias("last_name"),
                        F.concat(F.lit("First"), (u % 37).cast("string")).alias("first_name"),
                        F.concat(F.lit("staff"), u.cast("string"), F.lit("@firm.example")).alias("email"),
                        _pick(u % 5, SEGMENTS).alias("office_code"),
                        F.concat(F.lit("SV"), (u % 3).cast("string")).alias("service_code"),
                        F.concat(F.lit("FN"), (u % 4).cast("string")).alias("function_code"),
                        F.date_format("first_ts", "yyyyMMdd").alias("entry_date"),
                        F.when(u % 9 == 4, F.lit("20240115")).when(u % 13 == 2, F.lit(None))
                         .otherwise(F.lit("")).alias("exit_date")))

    def practice_fiscal_years(self) -> DataFrame:
        o = self.raw("orders")
        y = F.year("o_orderdate")
        g = o.groupBy(F.col("o_custkey").alias("address_id"), y.alias("y")).agg(
            F.count(F.lit(1)).alias("n"))
        ys = F.col("y").cast("string")
        return g.select(
            (F.col("address_id") * 10000 + F.col("y")).alias("id"),
            "address_id",
            ys.alias("code"),
            F.concat(ys, F.lit("0101")).alias("start"),
            F.concat(ys, F.lit("1231")).alias("end"),
            F.when(F.col("y") >= 2001, F.lit(""))
             .otherwise(F.concat((F.col("y") + 1).cast("string"), F.lit("0331"))).alias("closed"))

    def timesheet(self) -> DataFrame:
        e = self.raw("events")
        eid = F.col("event_id")
        u = F.col("user_id")
        return e.select(
            eid.alias("id"),
            (u % 100).alias("address_id"),
            F.concat(F.lit("S"), _lpad(u, 4)).alias("staff_code"),
            (u % 20).alias("mission_id"),
            F.col("event_type").alias("task_code"),
            F.col("props").alias("memo"),
            F.col("value").cast(HOURS).alias("hours"),
            F.to_date("ts").alias("day"),
            F.col("ts").alias("entered"),
            F.when(eid % 4 == 0, F.lit("2024")).when(eid % 4 == 1, F.lit(" 2023X"))
             .when(eid % 4 == 2, F.lit("2022")).otherwise(F.lit("2023")).alias("year_code"))

    def missions(self) -> DataFrame:
        e = self.raw("events")
        return (e.groupBy((F.col("user_id") % 20).alias("id"))
                .agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
                .select("id",
                        F.concat(F.lit("Mission "), F.col("id").cast("string")).alias("label"),
                        F.date_format("a", "yyyyMMdd").alias("start"),
                        F.date_format("b", "yyyyMMdd").alias("end")))

    def contacts(self) -> DataFrame:
        c = self.raw("customer")
        k = F.col("c_custkey")
        return c.select(
            k.alias("id"),
            F.concat(F.lit("Contact"), k.cast("string")).alias("last_name"),
            F.concat(F.lit("Pat"), (k % 11).cast("string")).alias("first_name"),
            F.concat(F.lit("contact"), k.cast("string"), F.lit("@example.org")).alias("email"),
            F.concat(F.lit("06 10 "), _lpad(k % 100, 2), F.lit(" 99")).alias("phone"))

    def contact_links(self) -> DataFrame:
        """Bridge contact <-> client, one row per (customer, priority class)."""
        o = self.raw("orders")
        return (o.groupBy(F.col("o_custkey").alias("contact_id"),
                          F.left("o_orderpriority", F.lit(1)).alias("p"))
                .agg(F.count(F.lit(1)).alias("n"))
                .select("contact_id", F.col("contact_id").alias("address_id"),
                        F.concat(F.lit("FN"), F.col("p")).alias("function_code")))

    def internal_ledger(self) -> DataFrame:
        """The firm's own sales ledger: fee accounts per client (input of P14)."""
        o = self.raw("orders")
        k = F.col("o_orderkey")
        account = (F.when(k % 6 == 0, F.lit("706100")).when(k % 6 == 1, F.lit("706200"))
                   .when(k % 6 == 2, F.lit("706300")).when(k % 6 == 3, F.lit("706410"))
                   .when(k % 6 == 4, F.lit("706999")).otherwise(F.lit("512000")))
        return o.select(
            _pick(F.col("o_custkey") % 5, SEGMENTS).alias("office"),
            account.alias("account"),
            F.col("o_orderpriority").alias("label"),
            _tenant(F.col("o_custkey")).alias("client_code"),
            F.to_date("o_orderdate").alias("day"),
            F.lit(0).cast(MONEY).alias("debit"),
            F.col("o_totalprice").cast(MONEY).alias("credit"),
            F.left("o_orderpriority", F.lit(1)).alias("journal"))

    def tenant_catalog(self) -> DataFrame:
        """information_schema-like (schema, table) rows of the legacy server."""
        c = self.raw("customer")
        k = F.col("c_custkey")
        schema = (F.when(k % 31 == 0, F.concat(F.lit("ledger_client_with_a_long_name_"), k.cast("string")))
                  .when(k % 37 == 0, F.concat(F.lit("ledgerx"), _lpad(k, 5)))
                  .otherwise(F.concat(F.lit("ledger_"), _lpad(k, 5))))
        rows = c.select(k.alias("k"), schema.alias("schema_name"),
                        F.explode(F.array(*[F.lit(t) for t in LEGACY_TABLES])).alias("table_name"))
        # every 7th tenant lost its journal table
        return (rows.filter(~((F.col("k") % 7 == 0) & (F.col("table_name") == "journal")))
                .select("schema_name", "table_name"))

    def sync_marks(self) -> DataFrame:
        """Per-tenant import marks of the header table."""
        h = self.raw("orders")
        code = _tenant(F.col("o_orderkey") % 100)
        g = h.groupBy(code.alias("client_code")).agg(
            F.count(F.lit(1)).alias("rows"), F.max("o_orderdate").alias("last_seen"))
        n = F.left("client_code", F.lit(5)).cast("int")
        mark = F.make_timestamp_ntz(1998 + n % 3, F.lit(1) + n % 12, F.lit(1), F.lit(0), F.lit(0), F.lit(0))
        return (g.filter(n % 4 != 0)
                .select(F.lit("header").alias("table"), "client_code",
                        mark.alias("last_sync"),
                        F.when(n % 5 == 0, F.lit("full")).otherwise(F.lit("incremental")).alias("type"),
                        F.when(n % 10 == 3, F.lit("FAILED")).otherwise(F.lit("SUCCESS")).alias("status"),
                        "rows", (F.col("rows") * 211).alias("duration_s")))

    # -------------------------------------------------------------- cloud source
    def company(self) -> DataFrame:
        s = self.raw("supplier")
        n = self.raw("nation")
        k = F.col("s_suppkey")
        # no number, blank and malformed ones (each held by several companies), duplicates, and plain ones
        reg = (F.when(k % 9 == 4, F.lit(None))
               .when(k % 15 == 11, F.lit(""))
               .when(k % 14 == 9, F.lit("123"))
               .when(k % 10 == 7, F.concat(_lpad((k - 1) * 20, 9), F.lit("00019")))
               .otherwise(F.concat(_lpad(k * 20, 9), F.lit("00019"))))
        name = (F.when(k % 11 == 5, F.concat(F.lit("Test "), F.col("s_name")))
                .when(k % 13 == 7, F.concat(F.col("s_name"), F.lit(" sandbox")))
                .otherwise(F.col("s_name")))
        joined = s.join(n, s.s_nationkey == n.n_nationkey, "left")
        return joined.select(
            k.alias("company_id"),
            name.alias("name"),
            _pick(k % 4, [o[1] for o in OFFICES]).alias("firm"),
            F.concat(F.lit("Trade "), k.cast("string")).alias("trade_name"),
            reg.alias("registration_no"),
            F.when(k % 2 == 0, F.lit("IS")).otherwise(F.lit("IR")).alias("tax_category"),
            F.when(k % 3 == 0, F.lit("RN")).otherwise(F.lit("RS")).alias("tax_regime"),
            F.col("n_name").alias("city"),
            _lpad(F.col("s_nationkey") * 1000 + k % 1000, 5).alias("postal_code"),
            F.concat(F.lit("A"), (k % 7).cast("string")).alias("activity_code"),
            F.lit("services").alias("sector"),
            _pick(k % 4, [lf[1] for lf in LEGAL_FORMS]).alias("legal_form"),
            F.make_timestamp_ntz(F.lit(2020), F.lit(1) + k % 12, F.lit(1) + k % 28,
                             F.lit(0), F.lit(0), F.lit(0)).alias("created"),
            F.make_timestamp_ntz(F.lit(2023), F.lit(1) + k % 12, F.lit(1) + k % 28,
                             F.lit(0), F.lit(0), F.lit(0)).alias("updated"))

    def company_identification(self) -> DataFrame:
        s = self.raw("supplier")
        k = F.col("s_suppkey")
        return s.filter(k % 7 != 3).select(
            k.alias("company_id"),
            F.concat(F.lit("EXT"), k.cast("string")).alias("external_id"),
            F.lit("standard").alias("file_type"),
            F.concat(F.lit("acc"), (k % 7).cast("string"), F.lit("@firm.example")).alias("accountant_email"),
            F.concat(F.lit("sup"), (k % 3).cast("string"), F.lit("@firm.example")).alias("supervisor_email"),
            F.concat(F.lit("mgr"), (k % 5).cast("string"), F.lit("@firm.example")).alias("manager_email"))

    def cloud_ledger(self) -> DataFrame:
        e = self.raw("events")
        eid = F.col("event_id")
        u = F.col("user_id")
        et = F.col("event_type")
        head = (F.when(et == "purchase", F.lit("411")).when(et == "error", F.lit("401"))
                .when(et == "signup", F.lit("706")).when(et == "view", F.lit("512"))
                .otherwise(F.lit("606")))
        amount = F.col("value").cast(MONEY)
        zero = F.lit(0).cast(MONEY)
        return e.select(
            eid.alias("line_id"),
            (u % 100).alias("company_id"),
            F.concat(F.lit("Supplier#"), _lpad(u % 100, 9)).alias("company_name"),
            F.to_date("ts").alias("day"),
            F.concat(head, F.when(eid % 3 == 0, F.lit("a")).otherwise(F.lit("A")), _lpad(u % 1000, 3)).alias("account"),
            F.concat(et, F.lit(" "), (u % 1000).cast("string")).alias("account_label"),
            F.when(et == "error", F.lit(None)).when(eid % 5 == 1, F.left(et, F.lit(2)))
             .otherwise(F.upper(F.left(et, F.lit(2)))).alias("journal"),
            et.alias("journal_label"),
            F.when(eid % 2 == 0, amount).otherwise(zero).alias("debit"),
            F.when(eid % 2 == 1, amount).when(eid % 10 == 0, F.lit(None).cast(MONEY))
             .otherwise(zero).alias("credit"),
            F.col("ts").alias("updated"))

    def cloud_fiscal_years(self) -> DataFrame:
        s = self.raw("supplier")
        k = F.col("s_suppkey")
        rows = s.filter(k % 2 == 0).select(
            k.alias("company_id"), F.col("s_name").alias("company_name"),
            F.explode(F.array(*[F.lit(y) for y in CLOUD_FY_YEARS])).alias("start_year"))
        y = F.col("start_year")
        return rows.select(
            "company_id", "company_name", y.cast("int").alias("start_year"),
            F.make_date(y, F.lit(7), F.lit(1)).alias("start"),
            F.make_date(y + 1, F.lit(6), F.lit(30)).alias("end"),
            F.when(y < 2000, F.make_date(y + 1, F.lit(9), F.lit(30))).alias("closed"))
