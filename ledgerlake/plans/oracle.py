"""Independent DuckDB SQL for every registered query (the correctness oracle).

The stand-in rules of ``standins.py`` are restated here as SQL CTEs over the
in forms that differ from the DataFrame code as far as SQL allows: labels come
from lookup maps instead of joins, sums are taken before labels are attached,
duplicates are decided by window ranks, and existence by semi and anti joins.
"""

from __future__ import annotations

import re

# --------------------------------------------------------------------------- stand-ins
_PREFIX = ("CASE {k} % 10 WHEN 0 THEN 'C' WHEN 1 THEN 'F' WHEN 2 THEN '411' WHEN 3 THEN '401' "
           "WHEN 4 THEN '512' WHEN 5 THEN '606' WHEN 6 THEN '70' WHEN 7 THEN 'c' WHEN 8 THEN 'f' "
           "ELSE '7' END")
_SEGMENT = ("CASE {k} % 5 WHEN 0 THEN 'AUTOMOBILE' WHEN 1 THEN 'BUILDING' WHEN 2 THEN 'FURNITURE' "
            "WHEN 3 THEN 'HOUSEHOLD' ELSE 'MACHINERY' END")

_JOURNAL = "CASE left(o_orderpriority, 1) WHEN '1' THEN 'AC' WHEN '2' THEN 'VÉ' WHEN '3' THEN 'OD' WHEN '5' THEN 'BQ' END"


def _key(code: str) -> str:
    """What codes are compared by: neither case, accents nor trailing blanks count."""
    return f"strip_accents(lower(rtrim({code})))"


CTE: dict[str, str] = {
    "o_headers": f"""
        SELECT printf('%05dA', o_orderkey % 100) AS client_code, o_orderkey AS entry_id,
               o_orderdate AS entered_at, CAST(year(o_orderdate) AS SMALLINT) AS year,
               CAST(CASE WHEN o_orderkey % 101 = 0 THEN 13 ELSE month(o_orderdate) END AS TINYINT) AS month,
               CASE o_orderkey % 3 WHEN 0 THEN lower({_JOURNAL}) WHEN 1 THEN replace({_JOURNAL}, 'É', 'E') || ' ' ELSE {_JOURNAL} END AS journal,
               o_orderkey % 2 = 0 AS archived
        FROM orders WHERE o_orderkey % 97 <> 0""",
    "o_lines": f"""
        SELECT printf('%05dA', l_orderkey % 100) AS client_code, l_orderkey * 10 + l_linenumber AS line_id,
               l_orderkey AS entry_id,
               CASE l_linenumber WHEN 2 THEN lower(({_PREFIX.format(k='l_partkey')}) || printf('%05d', l_partkey))
                  ELSE ({_PREFIX.format(k='l_partkey')}) || printf('%05d', l_partkey) || if(l_linenumber = 5, ' ', '') END AS account,
               CASE WHEN l_linestatus = 'O' THEN CAST(0 AS DECIMAL(18,2)) ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS credit,
               CASE WHEN l_linestatus = 'O' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END AS debit,
               l_returnflag AS label, CAST(day(l_shipdate) AS SMALLINT) AS day,
               'D' || CAST(l_orderkey AS VARCHAR) AS document,
               CASE WHEN l_returnflag = 'R' THEN 'M' || CAST(l_suppkey AS VARCHAR) ELSE '' END AS match_code,
               CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS SMALLINT) AS match_flag,
               CASE WHEN l_returnflag = 'R' THEN strftime(l_shipdate, '%Y%m%d') ELSE '' END AS match_date,
               CAST(l_shipdate AS DATE) AS posted, l_orderkey % 2 = 0 AS archived
        FROM lineitem""",
    "o_accounts": f"""
        SELECT u.client_code, CASE spelling WHEN 0 THEN ({_PREFIX.format(k='u.l_partkey')}) || printf('%05d', u.l_partkey)
                 ELSE lower(({_PREFIX.format(k='u.l_partkey')}) || printf('%05d', u.l_partkey)) || ' ' END AS account,
               if(spelling = 0, p.p_name, upper(p.p_name)) AS label
        FROM (SELECT DISTINCT printf('%05dA', l_orderkey % 100) AS client_code, l_partkey FROM lineitem) u
        JOIN part p ON p.p_partkey = u.l_partkey, (VALUES (0), (1)) t(spelling)
        WHERE p.p_partkey % 13 <> 0 AND (spelling = 0 OR p.p_partkey % 4 = 0)""",
    "o_journals": f"""
        SELECT printf('%05dA', o_orderkey % 100) AS client_code, if(o_orderkey % 200 < 100, {_JOURNAL}, lower({_JOURNAL})) AS journal,
               max(substr(o_orderpriority, 3)) AS label, 'G' AS kind
        FROM orders WHERE left(o_orderpriority, 1) IN ('1', '2', '3')
        GROUP BY 1, 2""",
    "o_address": """
        SELECT c.c_custkey AS id, printf('%05d', c.c_custkey) || if(c.c_custkey % 2 = 1, 'a', 'A') AS code, c.c_name AS name,
               CASE WHEN c.c_custkey % 17 = 0 THEN ''
                    WHEN c.c_custkey % 19 = 0 THEN printf('%07d', c.c_custkey)
                    WHEN c.c_custkey % 23 = 0 THEN printf('%09d', c.c_custkey - 1) || '00020'
                    ELSE printf('%09d', c.c_custkey) || '00010' END AS site_no,
               CASE WHEN c.c_custkey % 13 = 5 THEN 'PROSPECT' ELSE 'CLIENT' END AS kind,
               CASE WHEN c.c_custkey % 11 = 3 THEN '20000630' WHEN c.c_custkey % 29 = 1 THEN NULL ELSE '' END AS exit_date,
               'LF' || CAST(c.c_custkey % 5 AS VARCHAR) AS legal_code,
               'S' || printf('%04d', c.c_custkey % 50) AS staff1,
               'S' || printf('%04d', c.c_custkey % 50 + 50) AS staff2,
               'S' || printf('%04d', c.c_custkey % 50 + 100) AS staff3,
               'A' || CAST(c.c_custkey % 7 AS VARCHAR) AS activity_code,
               CAST(n.n_regionkey AS VARCHAR) AS region_code,
               c.c_mktsegment AS office_code,
               'T' || CAST(c.c_custkey % 3 AS VARCHAR) AS title_code,
               CASE WHEN c.c_custkey % 2 = 0 THEN 'IS' ELSE 'IR' END AS tax_type,
               CASE WHEN c.c_custkey % 10 = 0 THEN '' WHEN c.c_custkey % 3 = 0 THEN 'RN' ELSE 'RS' END AS tax_regime,
               n.n_name AS city,
               printf('%05d', c.c_nationkey * 1000 + c.c_custkey % 1000) AS postal_code,
               'client' || CAST(c.c_custkey AS VARCHAR) || '@example.org' AS email,
               '03 20 ' || printf('%02d', c.c_custkey % 100) || ' 00' AS phone,
               '411' || printf('%05d', c.c_custkey) AS internal_account,
               strftime(DATE '1995-01-01' + CAST(c.c_custkey % 2500 AS INTEGER), '%Y%m%d') AS entry_date
        FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey""",
    "o_legal_forms": "SELECT * FROM (VALUES ('LF0', 'SARL'), ('LF1', 'SAS'), ('LF2', 'SA'), ('LF3', 'SCI')) t(code, label)",
    "o_activities": ("SELECT * FROM (VALUES ('A0', 'Retail'), ('A1', 'Building'), ('A2', 'Transport'), "
                     "('A3', 'Catering'), ('A4', 'Consulting'), ('A5', 'Farming')) t(code, label)"),
    "o_titles": "SELECT * FROM (VALUES ('T0', 'Mr'), ('T1', 'Ms')) t(code, label)",
    "o_offices": ("SELECT * FROM (VALUES ('AUTOMOBILE', 'North'), ('BUILDING', 'South'), "
                  "('FURNITURE', 'East'), ('HOUSEHOLD', 'West')) t(code, label)"),
    "o_services": "SELECT * FROM (VALUES ('SV0', 'Bookkeeping'), ('SV1', 'Payroll')) t(code, label)",
    "o_functions": "SELECT * FROM (VALUES ('FN0', 'Manager'), ('FN1', 'Director'), ('FN2', 'Assistant')) t(code, label)",
    "o_tasks": ("SELECT * FROM (VALUES ('click', 'Data entry'), ('view', 'Review'), ('purchase', 'Closing'), "
                "('signup', 'Onboarding')) t(code, label)"),
    "o_regions": "SELECT CAST(r_regionkey AS VARCHAR) AS code, r_name AS label FROM region",
    "o_staff": f"""
        SELECT 'S' || printf('%04d', user_id) AS code, 'Last' || CAST(user_id AS VARCHAR) AS last_name,
               'First' || CAST(user_id % 37 AS VARCHAR) AS first_name,
               'staff' || CAST(user_id AS VARCHAR) || '@firm.example' AS email,
               {_SEGMENT.format(k='user_id')} AS office_code,
               'SV' || CAST(user_id % 3 AS VARCHAR) AS service_code,
               'FN' || CAST(user_id % 4 AS VARCHAR) AS function_code,
               strftime(min(ts), '%Y%m%d') AS entry_date,
               CASE WHEN user_id % 9 = 4 THEN '20240115' WHEN user_id % 13 = 2 THEN NULL ELSE '' END AS exit_date
        FROM events GROUP BY user_id""",
    "o_practice_years": """
        SELECT o_custkey * 10000 + year(o_orderdate) AS id, o_custkey AS address_id,
               CAST(year(o_orderdate) AS VARCHAR) AS code,
               CAST(year(o_orderdate) AS VARCHAR) || '0101' AS start,
               CAST(year(o_orderdate) AS VARCHAR) || '1231' AS "end",
               CASE WHEN year(o_orderdate) >= 2001 THEN '' ELSE CAST(year(o_orderdate) + 1 AS VARCHAR) || '0331' END AS closed
        FROM orders GROUP BY o_custkey, year(o_orderdate)""",
    "o_timesheet": """
        SELECT event_id AS id, user_id % 100 AS address_id, 'S' || printf('%04d', user_id) AS staff_code,
               user_id % 20 AS mission_id, event_type AS task_code, props AS memo,
               CAST(value AS DECIMAL(10,2)) AS hours, CAST(ts AS DATE) AS day, ts AS entered,
               CASE event_id % 4 WHEN 0 THEN '2024' WHEN 1 THEN ' 2023X' WHEN 2 THEN '2022' ELSE '2023' END AS year_code
        FROM events""",
    "o_missions": """
        SELECT user_id % 20 AS id, 'Mission ' || CAST(user_id % 20 AS VARCHAR) AS label,
               strftime(min(ts), '%Y%m%d') AS start, strftime(max(ts), '%Y%m%d') AS "end"
        FROM events GROUP BY user_id % 20""",
    "o_contacts": """
        SELECT c_custkey AS id, 'Contact' || CAST(c_custkey AS VARCHAR) AS last_name,
               'Pat' || CAST(c_custkey % 11 AS VARCHAR) AS first_name,
               'contact' || CAST(c_custkey AS VARCHAR) || '@example.org' AS email,
               '06 10 ' || printf('%02d', c_custkey % 100) || ' 99' AS phone
        FROM customer""",
    "o_contact_links": """
        SELECT DISTINCT o_custkey AS contact_id, o_custkey AS address_id,
               'FN' || left(o_orderpriority, 1) AS function_code
        FROM orders""",
    "o_internal_ledger": f"""
        SELECT {_SEGMENT.format(k='o_custkey')} AS office,
               CASE o_orderkey % 6 WHEN 0 THEN '706100' WHEN 1 THEN '706200' WHEN 2 THEN '706300'
                    WHEN 3 THEN '706410' WHEN 4 THEN '706999' ELSE '512000' END AS account,
               o_orderpriority AS label, printf('%05dA', o_custkey) AS client_code,
               CAST(o_orderdate AS DATE) AS day, CAST(0 AS DECIMAL(18,2)) AS debit,
               CAST(o_totalprice AS DECIMAL(18,2)) AS credit, left(o_orderpriority, 1) AS journal
        FROM orders""",
    "o_tenant_catalog": """
        SELECT schema_name, table_name FROM (
            SELECT c_custkey AS k,
                   CASE WHEN c_custkey % 31 = 0 THEN 'ledger_client_with_a_long_name_' || CAST(c_custkey AS VARCHAR)
                        WHEN c_custkey % 37 = 0 THEN 'ledgerx' || printf('%05d', c_custkey)
                        ELSE 'ledger_' || printf('%05d', c_custkey) END AS schema_name,
                   t.table_name
            FROM customer,
                 (VALUES ('archived_line'), ('archived_header'), ('current_line'), ('current_header'),
                         ('account'), ('journal')) t(table_name)
        ) WHERE NOT (k % 7 = 0 AND table_name = 'journal')""",
    "o_sync_marks": """
        SELECT 'header' AS "table", client_code,
               make_timestamp(1998 + CAST(left(client_code, 5) AS INTEGER) % 3, 1 + CAST(left(client_code, 5) AS INTEGER) % 12, 1, 0, 0, 0) AS last_sync,
               CASE WHEN CAST(left(client_code, 5) AS INTEGER) % 5 = 0 THEN 'full' ELSE 'incremental' END AS type,
               CASE WHEN CAST(left(client_code, 5) AS INTEGER) % 10 = 3 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
               n AS rows, n * 211 AS duration_s
        FROM (SELECT printf('%05dA', o_orderkey % 100) AS client_code, count(*) AS n FROM orders GROUP BY 1)
        WHERE CAST(left(client_code, 5) AS INTEGER) % 4 <> 0""",
    "o_company": """
        SELECT s.s_suppkey AS company_id,
               CASE WHEN s.s_suppkey % 11 = 5 THEN 'Test ' || s.s_name
                    WHEN s.s_suppkey % 13 = 7 THEN s.s_name || ' sandbox' ELSE s.s_name END AS name,
               CASE s.s_suppkey % 4 WHEN 0 THEN 'North' WHEN 1 THEN 'South' WHEN 2 THEN 'East' ELSE 'West' END AS firm,
               'Trade ' || CAST(s.s_suppkey AS VARCHAR) AS trade_name,
               CASE WHEN s.s_suppkey % 9 = 4 THEN NULL
                    WHEN s.s_suppkey % 15 = 11 THEN ''
                    WHEN s.s_suppkey % 14 = 9 THEN '123'
                    WHEN s.s_suppkey % 10 = 7 THEN printf('%09d', (s.s_suppkey - 1) * 20) || '00019'
                    ELSE printf('%09d', s.s_suppkey * 20) || '00019' END AS registration_no,
               CASE WHEN s.s_suppkey % 2 = 0 THEN 'IS' ELSE 'IR' END AS tax_category,
               CASE WHEN s.s_suppkey % 3 = 0 THEN 'RN' ELSE 'RS' END AS tax_regime,
               n.n_name AS city, printf('%05d', s.s_nationkey * 1000 + s.s_suppkey % 1000) AS postal_code,
               'A' || CAST(s.s_suppkey % 7 AS VARCHAR) AS activity_code, 'services' AS sector,
               CASE s.s_suppkey % 4 WHEN 0 THEN 'SARL' WHEN 1 THEN 'SAS' WHEN 2 THEN 'SA' ELSE 'SCI' END AS legal_form,
               make_timestamp(2020, 1 + s.s_suppkey % 12, 1 + s.s_suppkey % 28, 0, 0, 0) AS created,
               make_timestamp(2023, 1 + s.s_suppkey % 12, 1 + s.s_suppkey % 28, 0, 0, 0) AS updated
        FROM supplier s LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey""",
    "o_identification": """
        SELECT s_suppkey AS company_id, 'EXT' || CAST(s_suppkey AS VARCHAR) AS external_id,
               'standard' AS file_type,
               'acc' || CAST(s_suppkey % 7 AS VARCHAR) || '@firm.example' AS accountant_email,
               'sup' || CAST(s_suppkey % 3 AS VARCHAR) || '@firm.example' AS supervisor_email,
               'mgr' || CAST(s_suppkey % 5 AS VARCHAR) || '@firm.example' AS manager_email
        FROM supplier WHERE s_suppkey % 7 <> 3""",
    "o_ledger": """
        SELECT event_id AS line_id, user_id % 100 AS company_id,
               'Supplier#' || printf('%09d', user_id % 100) AS company_name,
               CAST(ts AS DATE) AS day,
               CASE event_type WHEN 'purchase' THEN '411' WHEN 'error' THEN '401' WHEN 'signup' THEN '706'
                    WHEN 'view' THEN '512' ELSE '606' END || if(event_id % 3 = 0, 'a', 'A') || printf('%03d', user_id % 1000) AS account,
               event_type || ' ' || CAST(user_id % 1000 AS VARCHAR) AS account_label,
               CASE WHEN event_type = 'error' THEN NULL WHEN event_id % 5 = 1 THEN left(event_type, 2) ELSE upper(left(event_type, 2)) END AS journal,
               event_type AS journal_label,
               CASE WHEN event_id % 2 = 0 THEN CAST(value AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END AS debit,
               CASE WHEN event_id % 2 = 1 THEN CAST(value AS DECIMAL(18,2))
                    WHEN event_id % 10 = 0 THEN NULL ELSE CAST(0 AS DECIMAL(18,2)) END AS credit,
               ts AS updated
        FROM events""",
    "o_cloud_years": """
        SELECT s_suppkey AS company_id, s_name AS company_name, CAST(y AS INTEGER) AS start_year,
               make_date(y, 7, 1) AS start, make_date(y + 1, 6, 30) AS "end",
               CASE WHEN y < 2000 THEN make_date(y + 1, 9, 30) END AS closed
        FROM supplier, (VALUES (1996), (1998), (2000)) t(y)
        WHERE s_suppkey % 2 = 0""",
}

# ------------------------------------------------------------------ shared job CTEs
def _look(dimension: str, key: str, value: str = "label", by: str = "code") -> str:
    """The value a small dimension holds for a key, through a map of the whole dimension."""
    return f"(SELECT map(list({by}), list({value})) FROM {dimension})[{key}]"


JOB_CTE: dict[str, str] = {
    # Accounting clients that have not left, every code replaced by its label
    "j_present": "SELECT * FROM o_address WHERE kind = 'CLIENT' AND nullif(exit_date, '') IS NULL",
    "j_clients": f"""
        SELECT id AS address_id, code AS client_code, name, left(site_no, 9) AS company_no, site_no,
               {_look('o_titles', 'title_code')} AS title, {_look('o_legal_forms', 'legal_code')} AS legal_form,
               tax_type AS tax_category, tax_regime, city, postal_code, activity_code,
               {_look('o_activities', 'activity_code')} AS activity_label, email, replace(phone, ' ', '') AS phone,
               {_look('o_staff', 'staff1', 'email')} AS director, {_look('o_staff', 'staff2', 'email')} AS manager,
               {_look('o_staff', 'staff3', 'email')} AS accountant, {_look('o_offices', 'office_code')} AS office,
               {_look('o_regions', 'region_code')} AS region, internal_account, entry_date
        FROM j_present""",
    # The cloud tool's companies but for trial ones, with who looks after them
    "j_cloud_clients": f"""
        SELECT company_id, name, left(registration_no, 9) AS company_no, who.external_id, firm, trade_name, legal_form,
               tax_category, tax_regime, city, postal_code, activity_code, sector, who.supervisor_email AS director,
               who.manager_email AS manager, who.accountant_email AS accountant, firm AS office, created, updated
        FROM (SELECT *, {_look('o_identification', 'company_id', 'o_identification', 'company_id')} AS who FROM o_company)
        WHERE NOT regexp_matches(lower(name), 'test|sandbox')""",
}


def _deps(sql: str, pool: dict[str, str]) -> list[str]:
    return [n for n in pool if re.search(rf"\b{n}\b", sql)]


def with_ctes(body: str) -> str:
    """Prefix ``body`` with every stand-in / job CTE it (transitively) uses."""
    pool = {**CTE, **JOB_CTE}
    needed: list[str] = []

    def visit(sql: str):
        for n in _deps(sql, pool):
            if n not in needed:
                visit(pool[n])
                needed.append(n)

    visit(body)
    if not needed:
        return body
    parts = ",\n".join(f"{n} AS ({pool[n]})" for n in needed)
    own = re.match(r"\s*WITH\b", body)     # a body with CTEs of its own goes on with the list
    return f"WITH {parts},\n{body[own.end():]}" if own else f"WITH {parts}\n{body}"


ORACLE: dict[str, str] = {}


def oracle(name: str, body: str) -> None:
    ORACLE[name] = with_ctes(body)



# =========================================================================== jobs
LEGACY_AS_OF = "DATE '2001-08-01'"
CLOUD_AS_OF = "DATE '2024-02-01'"
_SUMS = """CAST(coalesce(sum(debit), 0) AS DECIMAL(18,2)) AS debits, CAST(coalesce(sum(credit), 0) AS DECIMAL(18,2)) AS credits,
       count(*) AS lines"""
_BALANCE = "CAST(debits - credits AS DECIMAL(18,2)) AS balance"

JOB_CTE.update({
    # every line with its header, whichever bucket both are in
    "j_booked": "SELECT * FROM o_lines JOIN o_headers USING (client_code, entry_id, archived)",
    # Sums per month first, then the labels of what was summed
    "j_month_sums": f"""
        SELECT client_code, make_date(year, month, 1) AS month, min(account) AS account, {_key('account')} AS account_key,
               min(ifnull(journal, 'UNKNOWN')) AS journal, {_key("ifnull(journal, 'UNKNOWN')")} AS journal_key, {_SUMS}, max(entered_at) AS last_entered
        FROM j_booked WHERE year > year({LEGACY_AS_OF}) - 4 AND month BETWEEN 1 AND 12
        GROUP BY client_code, year, month, account_key, journal_key""",
    "j_account_labels": f"SELECT client_code, {_key('account')} AS account_key, max(label) AS label FROM o_accounts GROUP BY ALL",
    "j_journal_labels": f"SELECT client_code, {_key('journal')} AS journal_key, max(label) AS label FROM o_journals GROUP BY ALL",
    "j_balance_legacy": f"""
        SELECT 'legacy' AS source, sums.* EXCLUDE (account_key, journal_key), {_BALANCE},
               {_look('j_clients', _key('sums.client_code'), 'company_no', _key('client_code'))} AS company_no,
               CASE left(account_key, 1) WHEN 'c' THEN '4110' WHEN 'f' THEN '4100' ELSE left(sums.account, 4) END AS account_class,
               acc.label AS account_label, jnl.label AS journal_label
        FROM j_month_sums sums LEFT JOIN j_account_labels acc USING (client_code, account_key)
        LEFT JOIN j_journal_labels jnl USING (client_code, journal_key)""",
    # P5: the balances of customer and supplier accounts
    "j_cp_legacy": """
        SELECT * EXCLUDE (account_class, account), account AS account_original,
               MAP {'C': 'customer', 'F': 'supplier'}[upper(left(account, 1))] AS kind,
               MAP {'C': '411', 'F': '401'}[upper(left(account, 1))] AS account_mapped
        FROM j_balance_legacy WHERE upper(left(account, 1)) IN ('C', 'F')""",
    # The cloud tool's ledger summed the same way
    "j_cloud_sums": f"""
        SELECT company_id, CAST(date_trunc('month', day) AS DATE) AS month, {_key('account')} AS account_key, min(account) AS account,
               {_key("ifnull(journal, '')")} AS journal_key, min(ifnull(journal, '')) AS journal,
               max(account_label) AS account_label, max(journal_label) AS journal_label, {_SUMS},
               max(updated) AS last_entered, recent
        FROM (SELECT *, day >= {CLOUD_AS_OF} - INTERVAL 3 YEAR AS recent FROM o_ledger)
        GROUP BY company_id, date_trunc('month', day), account_key, journal_key, recent""",
    "j_balance_cloud": f"""
        SELECT 'cloud' AS source, CAST(company_id AS VARCHAR) AS client_code, month, account, journal,
               {_look('j_cloud_clients', 'company_id', 'company_no', 'company_id')} AS company_no, left(account, 4) AS account_class,
               account_label, journal_label, debits, credits, {_BALANCE}, lines, last_entered
        FROM (SELECT company_id, month, min(account) AS account, min(journal) AS journal, max(account_label) AS account_label,
                     max(journal_label) AS journal_label, CAST(sum(debits) AS DECIMAL(18,2)) AS debits,
                     CAST(sum(credits) AS DECIMAL(18,2)) AS credits, CAST(sum(lines) AS BIGINT) AS lines, max(last_entered) AS last_entered
              FROM j_cloud_sums GROUP BY company_id, month, account_key, journal_key)""",
    "j_cp_cloud": f"""
        SELECT 'cloud' AS source, CAST(company_id AS VARCHAR) AS client_code, month, account AS account_original, journal,
               left({_look('o_company', 'company_id', 'registration_no', 'company_id')}, 9) AS company_no,
               MAP {{'411': 'customer', '401': 'supplier'}}[left(account, 3)] AS kind, left(account, 3) AS account_mapped,
               account_label, journal_label, debits, credits, {_BALANCE}, lines, last_entered
        FROM j_cloud_sums WHERE recent AND left(account, 3) IN ('411', '401')""",
    "j_balances": "SELECT * FROM j_balance_legacy UNION ALL BY NAME SELECT * FROM j_balance_cloud",
    "j_counterparties": "SELECT * FROM j_cp_legacy UNION ALL BY NAME SELECT * FROM j_cp_cloud",
    # A client's years in either tool; the client is named by its code or id
    "j_fiscal_years": f"""
        SELECT 'legacy' AS source, p.code AS client_code, CAST(try_strptime(y.start, '%Y%m%d') AS DATE) AS start, y.id AS origin_id,
               left(p.site_no, 9) AS company_no, y.code, CAST(try_strptime(y."end", '%Y%m%d') AS DATE) AS "end",
               CAST(try_strptime(nullif(y.closed, ''), '%Y%m%d') AS DATE) AS closed
        FROM j_present p JOIN o_practice_years y ON p.id = y.address_id
        UNION ALL BY NAME
        SELECT 'cloud' AS source, CAST(company_id AS VARCHAR) AS client_code, start,
               left({_look('o_company', 'company_id', 'registration_no', 'company_id')}, 9) AS company_no,
               CAST(start_year AS VARCHAR) AS code, "end", closed
        FROM o_cloud_years""",
    # This and last year's hours of staff who have not left
    "j_timesheets": f"""
        SELECT id AS time_id, {_look('o_address', 'address_id', 'code', 'id')} AS client_code,
               left({_look('o_address', 'address_id', 'site_no', 'id')}, 9) AS company_no, who.last_name, who.first_name,
               {_look('o_offices', 'who.office_code')} AS office, {_look('o_services', 'who.service_code')} AS service,
               {_look('o_functions', 'who.function_code')} AS function, work.label AS mission, {_look('o_tasks', 'task_code')} AS task,
               memo, hours, day, entered, CAST(try_strptime(work.start, '%Y%m%d') AS DATE) AS mission_start,
               CAST(try_strptime(work."end", '%Y%m%d') AS DATE) AS mission_end, year_code
        FROM (SELECT *, {_look('o_staff', 'staff_code', 'o_staff')} AS who, {_look('o_missions', 'mission_id', 'o_missions', 'id')} AS work FROM o_timesheet)
        WHERE TRY_CAST(left(trim(year_code), 4) AS INTEGER) >= year({CLOUD_AS_OF}) - 1 AND nullif(who.exit_date, '') IS NULL""",
    # One row per company number. Ranks decide who keeps a number; a legacy number counts only if it has nine characters.
    "j_ranked": """
        SELECT 'legacy' AS side, CASE WHEN length(company_no) = 9 THEN company_no END AS no, client_code AS row_key,
               row_number() OVER (PARTITION BY CASE WHEN length(company_no) = 9 THEN company_no END ORDER BY client_code) AS place
        FROM j_clients
        UNION ALL
        SELECT 'cloud', company_no, CAST(company_id AS VARCHAR), row_number() OVER (PARTITION BY company_no ORDER BY company_id)
        FROM j_cloud_clients""",
    "j_kept": "SELECT side, no, row_key FROM j_ranked WHERE place = 1 OR no IS NULL",
    "j_master": """
        WITH own AS (SELECT k.no, c.* FROM j_kept k JOIN j_clients c ON k.side = 'legacy' AND k.row_key = c.client_code),
             other AS (SELECT k.no, c.* FROM j_kept k JOIN j_cloud_clients c ON k.side = 'cloud' AND k.row_key = CAST(c.company_id AS VARCHAR)),
             both_ AS (
                SELECT coalesce(own.no, other.no) AS company_no, own.client_code, other.company_id, other.external_id,
                       ifnull(own.name, other.name) AS name, own.site_no, own.title,
                       CASE WHEN other.company_id IS NULL THEN own.legal_form ELSE ifnull(nullif(own.legal_form, ''), other.legal_form) END AS legal_form,
                       CASE WHEN other.company_id IS NULL THEN own.tax_category ELSE ifnull(nullif(own.tax_category, ''), other.tax_category) END AS tax_category,
                       CASE WHEN other.company_id IS NULL THEN own.tax_regime ELSE ifnull(nullif(own.tax_regime, ''), other.tax_regime) END AS tax_regime,
                       if(own.client_code IS NULL, other.activity_code, own.activity_code) AS activity_code, own.activity_label,
                       if(own.client_code IS NULL, other.city, own.city) AS city, if(own.client_code IS NULL, other.postal_code, own.postal_code) AS postal_code,
                       own.region, own.email, own.phone, if(own.client_code IS NULL, other.director, own.director) AS director,
                       if(own.client_code IS NULL, other.manager, own.manager) AS manager, if(own.client_code IS NULL, other.accountant, own.accountant) AS accountant,
                       if(own.client_code IS NULL, other.office, own.office) AS office, own.internal_account,
                       CAST(try_strptime(own.entry_date, '%Y%m%d') AS DATE) AS entry_date, CAST(NULL AS DATE) AS exit_date,
                       own.client_code IS NOT NULL AS has_books_legacy, other.company_id IS NOT NULL AS has_books_cloud
                FROM own FULL JOIN other ON own.no = other.no)
        SELECT *, exit_date IS NULL AS active, FALSE AS has_books_other, FALSE AS has_payroll, FALSE AS has_payroll_alt,
               FALSE AS has_legal, FALSE AS has_audit
        FROM both_""",
    # P14. Fee-account patterns and the service each one reveals.
    "o_patterns": """SELECT * FROM (VALUES
            ('706100%', 'BOOKKEEPING'), ('706110%', 'BOOKKEEPING'), ('706120%', 'BOOKKEEPING'),
            ('706200%', 'PAYROLL'), ('706210%', 'PAYROLL'), ('706300%', 'LEGAL'), ('706310%', 'LEGAL'),
            ('706400%', 'AUDIT'), ('706410%', 'AUDIT')) t(pattern, service)""",
    "j_services": """
        SELECT l.client_code, bool_or(p.service = 'BOOKKEEPING') AS has_books_other,
               bool_or(p.service = 'PAYROLL') AS has_payroll, bool_or(p.service = 'LEGAL') AS has_legal,
               bool_or(p.service = 'AUDIT') AS has_audit
        FROM o_internal_ledger l JOIN o_patterns p ON l.account LIKE p.pattern
        GROUP BY l.client_code""",
    "j_master_svc": f"""
        SELECT m.* REPLACE (ifnull(s.has_books_other, m.has_books_other) AS has_books_other, ifnull(s.has_payroll, m.has_payroll) AS has_payroll,
                            ifnull(s.has_legal, m.has_legal) AS has_legal, ifnull(s.has_audit, m.has_audit) AS has_audit)
        FROM j_master m LEFT JOIN j_services s ON {_key('m.client_code')} = {_key('s.client_code')}""",
})

oracle("monthly_balance", "SELECT * FROM j_balance_legacy")
oracle("monthly_balance_cloud", "SELECT * FROM j_balance_cloud")
oracle("counterparty_legacy", "SELECT * FROM j_cp_legacy")
oracle("counterparty_cloud", "SELECT * FROM j_cp_cloud")
oracle("client_star", "SELECT * FROM j_clients")
oracle("active_clients", "SELECT * FROM j_present")
oracle("cloud_clients", "SELECT * FROM j_cloud_clients")
oracle("fiscal_years", "SELECT * FROM j_fiscal_years")
oracle("timesheets", "SELECT * FROM j_timesheets")
oracle("account_reference", f"""
SELECT 'legacy' AS source, client_code, min(account) AS code, max(label) AS label,
       CASE left({_key('min(account)')}, 1) WHEN 'c' THEN '4110' WHEN 'f' THEN '4100' ELSE left(min(account), 4) END AS account_class
FROM o_accounts GROUP BY client_code, {_key('account')}
UNION ALL
SELECT 'cloud', CAST(company_id AS VARCHAR), min(account), max(account_label), left(min(account), 4)
FROM o_ledger GROUP BY company_id, {_key('account')}""")
oracle("journal_reference", f"""
SELECT 'legacy' AS source, client_code, min(journal) AS code, max(label) AS label FROM o_journals GROUP BY client_code, {_key('journal')}
UNION ALL
SELECT 'cloud', CAST(company_id AS VARCHAR), min(ifnull(journal, '')), max(journal_label)
FROM o_ledger GROUP BY company_id, {_key("ifnull(journal, '')")}""")
oracle("unified_lines", """
SELECT client_code, line_id, entry_id, account, credit, debit, label, day, document, match_code,
       match_flag, match_date, posted, archived FROM o_lines""")
oracle("period_rejects", """
SELECT client_code, entry_id, account, year, month FROM j_booked WHERE (month BETWEEN 1 AND 12 AND year BETWEEN 1 AND 9999) IS NOT TRUE""")
oracle("layer_counts", """
SELECT 'legacy_clients' AS table_name, (SELECT count(*) FROM j_clients) AS row_count
UNION ALL SELECT 'cloud_clients', (SELECT count(*) FROM j_cloud_clients)
UNION ALL SELECT 'monthly_balance', (SELECT count(*) FROM j_balances)
UNION ALL SELECT 'counterparty', (SELECT count(*) FROM j_counterparties)
UNION ALL SELECT 'fiscal_years', (SELECT count(*) FROM j_fiscal_years)
UNION ALL SELECT 'timesheets', (SELECT count(*) FROM j_timesheets)""")
oracle("master_clients", "SELECT * FROM j_master")
oracle("master_rejects", """
SELECT side AS source, no AS company_no, row_key, 'duplicate company number' AS reason FROM j_ranked WHERE place > 1 AND no IS NOT NULL""")
oracle("master_counts", """
SELECT count(*) AS total,
       CAST(sum(CASE WHEN has_books_legacy AND NOT has_books_cloud THEN 1 ELSE 0 END) AS BIGINT) AS legacy_only,
       CAST(sum(CASE WHEN NOT has_books_legacy AND has_books_cloud THEN 1 ELSE 0 END) AS BIGINT) AS cloud_only,
       CAST(sum(CASE WHEN has_books_legacy AND has_books_cloud THEN 1 ELSE 0 END) AS BIGINT) AS both
FROM j_master""")
oracle("detect_services", "SELECT * FROM j_services")
oracle("staff_reference", f"""
SELECT code, email, last_name, first_name, {_look('o_offices', 'office_code')} AS office, {_look('o_services', 'service_code')} AS service,
       {_look('o_functions', 'function_code')} AS function, CAST(try_strptime(entry_date, '%Y%m%d') AS DATE) AS entry_date,
       CAST(try_strptime(nullif(exit_date, ''), '%Y%m%d') AS DATE) AS exit_date, try_strptime(nullif(exit_date, ''), '%Y%m%d') IS NULL AS active
FROM o_staff""")
oracle("contacts", f"""
WITH at_client AS (SELECT contact_id, function_code, left(site_no, 9) AS company_no FROM o_contact_links JOIN j_present ON id = address_id),
     numbers AS (SELECT list(company_no) AS known FROM j_master WHERE length(company_no) = 9)
SELECT CASE WHEN list_contains(known, company_no) THEN company_no END AS master_company_no, company_no, id AS contact_id,
       last_name, first_name, email, replace(phone, ' ', '') AS phone, {_look('o_functions', 'function_code')} AS function
FROM o_contacts JOIN at_client ON contact_id = id, numbers""")
oracle("source_mix", """
SELECT CASE WHEN has_books_legacy AND has_books_cloud THEN 'legacy + cloud' WHEN has_books_legacy THEN 'legacy only'
            WHEN has_books_cloud THEN 'cloud only' ELSE 'no source' END AS source,
       count(*) AS clients
FROM j_master GROUP BY 1""")


# =========================================================================== marts
_BOOKS = "(m.has_books_legacy OR m.has_books_cloud OR m.has_books_other)"
_PAY = "(m.has_payroll OR m.has_payroll_alt)"
JOB_CTE.update({
    "j_matrix": f"""
        SELECT m.company_no, m.client_code, m.name, m.office, m.director, m.manager, m.accountant, m.active,
               m.has_books_legacy, m.has_books_cloud, m.has_books_other, {_BOOKS} AS has_books,
               m.has_payroll, m.has_payroll_alt, {_PAY} AS has_any_payroll, m.has_legal, m.has_audit,
               CAST((COALESCE(m.has_books_legacy, FALSE)::INT + COALESCE(m.has_books_cloud, FALSE)::INT
                     + COALESCE(m.has_books_other, FALSE)::INT > 0)::INT
                    + (COALESCE(m.has_payroll, FALSE)::INT + COALESCE(m.has_payroll_alt, FALSE)::INT > 0)::INT
                    + COALESCE(m.has_legal, FALSE)::INT + COALESCE(m.has_audit, FALSE)::INT AS INTEGER) AS services
        FROM j_master_svc m WHERE m.active""",
    # who a valid company number belongs to
    "j_named": "SELECT company_no, name AS client_name, office FROM j_master_svc WHERE length(company_no) = 9",
    "j_revenue": """
        WITH sold AS (SELECT source, client_code, company_no, month, CAST(sum(credits) - sum(debits) AS DECIMAL(18,2)) AS revenue
                      FROM j_balances WHERE starts_with(account, '7') GROUP BY ALL)
        SELECT source, client_code, client_name, office, month, revenue, CAST(date_part('year', month) AS INTEGER) AS year,
               CAST(date_part('month', month) AS INTEGER) AS month_no
        FROM sold LEFT JOIN j_named USING (company_no)""",
})

oracle("service_matrix", "SELECT * FROM j_matrix")
oracle("service_penetration", """
SELECT services, count(*) AS clients,
       round(CAST(count(*) AS DOUBLE) * 100.0 / CAST(sum(count(*)) OVER () AS DOUBLE), 2) AS pct_clients
FROM j_matrix GROUP BY services""")
oracle("staff_portfolio", f"""
SELECT m.director, m.manager, m.accountant, m.office, count(*) AS clients,
       CAST(sum(CASE WHEN {_BOOKS} THEN 1 ELSE 0 END) AS BIGINT) AS books_clients,
       CAST(sum(CASE WHEN {_PAY} THEN 1 ELSE 0 END) AS BIGINT) AS payroll_clients,
       CAST(sum(CASE WHEN m.has_legal THEN 1 ELSE 0 END) AS BIGINT) AS legal_clients,
       CAST(sum(CASE WHEN m.has_audit THEN 1 ELSE 0 END) AS BIGINT) AS audit_clients
FROM j_master_svc m WHERE m.active
GROUP BY m.director, m.manager, m.accountant, m.office""")
oracle("entries_exits", """
SELECT strftime(entry_date, '%Y-%m') AS month, office,
       CAST(sum(CASE WHEN exit_date IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS entries,
       CAST(sum(CASE WHEN exit_date IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS exits,
       CAST(sum(CASE WHEN exit_date IS NULL THEN 1 ELSE -1 END) AS BIGINT) AS net
FROM j_master_svc WHERE entry_date IS NOT NULL
GROUP BY strftime(entry_date, '%Y-%m'), office""")
oracle("office_split", """
SELECT office, count(*) AS clients,
       CAST(sum(CASE WHEN has_books_legacy THEN 1 ELSE 0 END) AS BIGINT) AS legacy_clients,
       CAST(sum(CASE WHEN has_books_cloud THEN 1 ELSE 0 END) AS BIGINT) AS cloud_clients,
       round(CAST(count(*) AS DOUBLE) * 100.0 / CAST(sum(count(*)) OVER () AS DOUBLE), 2) AS pct_total
FROM j_master_svc WHERE active GROUP BY office""")
_PEOPLE = ("office", "name", "tax_category", "tax_regime", "legal_form", "director", "manager", "accountant")
oracle("unified_ledger", f"""
WITH in_tool AS (SELECT 'legacy' AS source, {_key('client_code')} AS client_key, {', '.join(_PEOPLE)} FROM j_clients
                 UNION ALL SELECT 'cloud', CAST(company_id AS VARCHAR), {', '.join(_PEOPLE)} FROM j_cloud_clients),
     agreed AS (SELECT company_no, {', '.join(_PEOPLE)} FROM j_master_svc WHERE length(company_no) = 9)
SELECT source, client_code, month, account, account_label, journal, journal_label, credits, debits, balance, lines, last_entered,
       {', '.join(f"ifnull(agreed.{c}, in_tool.{c}) AS {'client_name' if c == 'name' else c}" for c in _PEOPLE)}
FROM (SELECT *, {_key('client_code')} AS client_key FROM j_balances) LEFT JOIN in_tool USING (source, client_key) LEFT JOIN agreed USING (company_no)
WHERE month >= DATE '2000-01-01'""")
oracle("dashboard_kpis", f"""
WITH clients AS (SELECT count(*) AS active_clients, count_if(has_books_legacy) AS legacy_clients, count_if(has_books_cloud) AS cloud_clients
                 FROM j_master_svc WHERE active),
     time_ AS (SELECT CAST(sum(hours) AS DECIMAL(18,2)) AS hours_this_year, count(DISTINCT client_code) AS clients_with_time
               FROM j_timesheets WHERE TRY_CAST(year_code AS INTEGER) = year({CLOUD_AS_OF}))
SELECT strftime({CLOUD_AS_OF}, '%Y-%m') AS current_period, CAST(active_clients AS BIGINT) AS active_clients,
       CAST(legacy_clients AS BIGINT) AS legacy_clients, CAST(cloud_clients AS BIGINT) AS cloud_clients, hours_this_year, clients_with_time
FROM clients, time_""")
oracle("hours_by_client", """
WITH spent AS (SELECT client_code, year_code, service, CAST(sum(hours) AS DECIMAL(18,2)) AS total_hours,
                      count(DISTINCT last_name || '-' || first_name) AS staff, count(*) AS entries
               FROM j_timesheets GROUP BY ALL)
SELECT spent.*, name AS client_name, office, director, manager
FROM spent LEFT JOIN (SELECT client_code, name, office, director, manager FROM j_master_svc WHERE client_code <> '') USING (client_code)""")
oracle("hours_by_staff", """
SELECT last_name, first_name, office, service, function, year_code, strftime(day, '%Y-%m') AS month,
       CAST(sum(hours) AS DECIMAL(18,2)) AS total_hours, count(DISTINCT client_code) AS clients
FROM j_timesheets
GROUP BY last_name, first_name, office, service, function, year_code, strftime(day, '%Y-%m')""")
oracle("fiscal_year_overlap", """
WITH years AS (SELECT *, CASE WHEN length(company_no) = 9 THEN company_no END AS no FROM j_fiscal_years),
     judged AS (SELECT here.*, TRUE AS possible_duplicate FROM years here SEMI JOIN years there
                  ON here.no = there.no AND here.source <> there.source AND there.start <= here."end" AND here.start <= there."end"
                UNION ALL
                SELECT here.*, FALSE FROM years here ANTI JOIN years there
                  ON here.no = there.no AND here.source <> there.source AND there.start <= here."end" AND here.start <= there."end")
SELECT source, client_code, client_name, office, code, start, "end", closed, if(closed IS NULL, 'open', 'closed') AS status, possible_duplicate
FROM judged LEFT JOIN j_named ON j_named.company_no = judged.no""")
oracle("counterparty_detail", """
SELECT source, client_code, client_name, office, month, kind, account_original, account_mapped, account_label, journal, journal_label,
       debits, credits, balance, lines
FROM j_counterparties LEFT JOIN j_named USING (company_no)""")
oracle("counterparty_monthly", """
WITH sums AS (SELECT source, client_code, company_no, month, kind, account_mapped, CAST(sum(debits) AS DECIMAL(18,2)) AS total_debits,
                     CAST(sum(credits) AS DECIMAL(18,2)) AS total_credits, CAST(sum(balance) AS DECIMAL(18,2)) AS total_balance,
                     CAST(sum(lines) AS BIGINT) AS total_lines
              FROM j_counterparties GROUP BY ALL)
SELECT sums.* EXCLUDE (company_no), client_name, office FROM sums LEFT JOIN j_named USING (company_no)""")
oracle("revenue_monthly", "SELECT * FROM j_revenue")
oracle("revenue_yoy", """
SELECT r.source, r.client_code, r.client_name, r.office, r.month, r.year, r.month_no, r.revenue,
       p.revenue AS revenue_prev_year, CAST(r.revenue - p.revenue AS DECIMAL(18,2)) AS change
FROM j_revenue r
LEFT JOIN j_revenue p ON p.source = r.source AND p.client_code = r.client_code
                     AND CAST(p.month + INTERVAL 12 MONTH AS DATE) = r.month""")
oracle("top_counterparties", f"""
WITH moved AS (SELECT source, client_code, company_no, kind, account_original, account_label,
                      CAST(sum(abs(balance)) AS DECIMAL(18,2)) AS total_amount, CAST(sum(lines) AS BIGINT) AS movements
               FROM j_counterparties WHERE month >= {LEGACY_AS_OF} - INTERVAL 1 YEAR GROUP BY ALL)
SELECT moved.* EXCLUDE (company_no), client_name, office FROM moved LEFT JOIN j_named USING (company_no)""")

# ================================================================ documented reports
oracle("client_balance", f"""
WITH sums AS (SELECT client_code, CAST(date_trunc('month', entered_at) AS DATE) AS month, {_key('account')} AS written, min(account) AS account,
                     CAST(sum(debit) AS DECIMAL(18,2)) AS debits, CAST(sum(credit) AS DECIMAL(18,2)) AS credits
              FROM j_booked WHERE year >= 1999 GROUP BY ALL)
SELECT * EXCLUDE (written), CAST(debits - credits AS DECIMAL(18,2)) AS balance FROM sums""")
oracle("top_clients_volume", """
SELECT client_code, count(*) AS lines, CAST(sum(debit + credit) AS DECIMAL(18,2)) AS volume
FROM o_lines WHERE archived
GROUP BY client_code ORDER BY lines DESC, client_code ASC LIMIT 10""")
oracle("lines_per_year", "SELECT year, count(*) AS lines FROM j_booked GROUP BY year")
oracle("import_state", """
SELECT "table", type, status, count(DISTINCT client_code) AS tenants, CAST(sum(rows) AS BIGINT) AS rows,
       min(last_sync) AS oldest_sync, max(last_sync) AS latest_sync,
       format('{:,}', CAST(sum(rows) AS BIGINT)) AS rows_display
FROM o_sync_marks GROUP BY "table", type, status""")
oracle("import_alerts", """
SELECT "table", client_code, last_sync, status, duration_s,
       CASE WHEN upper(status) <> 'SUCCESS' THEN 'failed' ELSE 'slow' END AS alert
FROM o_sync_marks WHERE upper(status) <> 'SUCCESS' OR duration_s > 28800""")

# ================================================================ data quality
_LINE_COLS = ("client_code, line_id, entry_id, account, credit, debit, label, day, document, match_code, "
              "match_flag, match_date, posted, archived")
oracle("duplicate_keys", """
SELECT client_code, line_id, count(*) AS occurrences FROM o_lines
GROUP BY client_code, line_id HAVING count(*) > 1""")
oracle("orphan_lines", f"""
SELECT {_LINE_COLS} FROM o_lines l
WHERE NOT EXISTS (SELECT 1 FROM o_headers h WHERE h.client_code = l.client_code AND h.entry_id = l.entry_id)""")
oracle("domain_check", """
SELECT 'month_out_of_range' AS rule, CAST(count(*) FILTER (WHERE NOT (month BETWEEN 1 AND 12)) AS BIGINT) AS violations, count(*) AS checked_rows FROM o_headers
UNION ALL SELECT 'missing_journal', count(*) FILTER (WHERE journal IS NULL), count(*) FROM o_headers
UNION ALL SELECT 'client_code_too_long', count(*) FILTER (WHERE length(client_code) > 20), count(*) FROM o_headers
UNION ALL SELECT 'year_after_as_of', count(*) FILTER (WHERE year > 2001), count(*) FROM o_headers
UNION ALL SELECT 'journal_too_long', count(*) FILTER (WHERE length(journal) > 4), count(*) FROM o_headers""")
oracle("reconcile_counts", """
SELECT COALESCE(s.client_code, t.client_code) AS client_code, COALESCE(s.n, 0) AS source_rows,
       COALESCE(t.n, 0) AS target_rows, COALESCE(s.n, 0) - COALESCE(t.n, 0) AS difference,
       CASE WHEN t.n IS NULL THEN 'missing in target' WHEN s.n IS NULL THEN 'missing in source'
            WHEN s.n = t.n THEN 'match' ELSE 'mismatch' END AS status
FROM (SELECT client_code, count(*) AS n FROM o_lines GROUP BY client_code) s
FULL OUTER JOIN (SELECT client_code, count(*) AS n FROM j_booked GROUP BY client_code) t
  ON s.client_code = t.client_code""")

# ================================================================ write modes
_LINE_ORDER = ("posted DESC, entry_id DESC, account DESC, credit DESC, debit DESC, label DESC, day DESC, "
               "document DESC, match_code DESC, match_flag DESC, match_date DESC, posted DESC, archived DESC")
JOB_CTE.update({
    "j_line_base": f"""
        SELECT {_LINE_COLS} FROM o_lines WHERE posted < DATE '1999-01-01'
        QUALIFY row_number() OVER (PARTITION BY client_code, line_id ORDER BY {_LINE_ORDER}) = 1""",
    "j_line_delta": f"""
        SELECT client_code, line_id, entry_id, account, credit, CAST(debit + 1 AS DECIMAL(18,2)) AS debit, label, day,
               document, match_code, match_flag, match_date, posted, archived
        FROM o_lines WHERE posted >= DATE '1998-07-01'""",
    "j_line_delta_last": f"""
        SELECT * FROM j_line_delta
        QUALIFY row_number() OVER (PARTITION BY client_code, line_id ORDER BY {_LINE_ORDER}) = 1""",
    "j_account_delta": f"""
        SELECT u.client_code, ({_PREFIX.format(k='u.l_partkey')}) || printf('%05d', u.l_partkey) AS account,
               CASE WHEN p.p_partkey % 10 = 0 THEN NULL ELSE upper(p.p_name) END AS label
        FROM (SELECT DISTINCT printf('%05dA', l_orderkey % 100) AS client_code, l_partkey FROM lineitem) u
        JOIN part p ON p.p_partkey = u.l_partkey
        WHERE p.p_partkey % 5 = 0 OR p.p_partkey % 13 = 0""",
    "j_ledger_feed": """
        SELECT line_id, company_id, company_name, day, account, account_label, journal, journal_label, debit,
               CAST(COALESCE(credit, 0) + 2 AS DECIMAL(18,2)) AS credit, updated,
               updated + INTERVAL 1 DAY AS synchronised_at,
               CASE WHEN line_id % 7 = 0 THEN updated END AS deleted_at
        FROM o_ledger WHERE day >= DATE '2024-01-15'""",
    "j_new_headers": """
        SELECT h.* FROM o_headers h
        LEFT JOIN o_sync_marks m ON m.client_code = h.client_code AND m."table" = 'header'
        WHERE h.entered_at >= COALESCE(m.last_sync, TIMESTAMP '2000-01-01 00:00:00')""",
})
oracle("upsert_replace", """
SELECT * FROM j_line_base b
WHERE NOT EXISTS (SELECT 1 FROM j_line_delta d WHERE d.client_code = b.client_code AND d.line_id = b.line_id)
UNION ALL SELECT * FROM j_line_delta_last""")
oracle("upsert_audit", """
SELECT CAST(sum(CASE WHEN b.line_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS inserted,
       CAST(sum(CASE WHEN b.line_id IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS updated,
       count(*) AS delta_keys
FROM (SELECT DISTINCT client_code, line_id FROM j_line_delta) d
LEFT JOIN (SELECT DISTINCT client_code, line_id FROM j_line_base) b
  ON b.client_code = d.client_code AND b.line_id = d.line_id""")
ORACLE["audit_row"] = ORACLE["upsert_audit"].replace("SELECT CAST(sum(CASE WHEN b.line_id IS NULL", "SELECT 'lines' AS step, 'SUCCESS' AS status, CAST(NULL AS VARCHAR) AS error, CAST(95 AS BIGINT) AS duration_s, CAST(sum(CASE WHEN b.line_id IS NULL")
oracle("upsert_merge", """
SELECT COALESCE(b.client_code, d.client_code) AS client_code, COALESCE(b.account, d.account) AS account,
       CASE WHEN b.account IS NOT NULL AND d.account IS NOT NULL THEN COALESCE(d.label, b.label)
            WHEN d.account IS NOT NULL THEN d.label ELSE b.label END AS label
FROM o_accounts b FULL OUTER JOIN j_account_delta d ON b.client_code = d.client_code AND b.account = d.account""")
oracle("apply_changes", """
SELECT b.* FROM o_ledger b
WHERE b.day < DATE '2024-01-20' AND NOT EXISTS (SELECT 1 FROM j_ledger_feed f WHERE f.line_id = b.line_id)
UNION ALL
SELECT line_id, company_id, company_name, day, account, account_label, journal, journal_label, debit, credit, updated
FROM j_ledger_feed WHERE deleted_at IS NULL""")
oracle("insert_absent", """
SELECT * FROM o_company WHERE company_id % 3 <> 0
UNION ALL
SELECT company_id, upper(name), firm, trade_name, registration_no, tax_category, tax_regime, city, postal_code,
       activity_code, sector, legal_form, created, updated
FROM o_company WHERE company_id % 3 = 0""")
oracle("full_refresh", "SELECT * FROM j_clients")
_REFRESHED = f"""
SELECT client_code, line_id, entry_id, account,
       CASE WHEN client_code LIKE '%7A' THEN CAST(credit + 5 AS DECIMAL(18,2)) ELSE credit END AS credit,
       debit, label, day, document, match_code, match_flag, match_date, posted, archived
FROM o_lines"""
oracle("tenant_refresh", _REFRESHED)
oracle("tenant_refresh_frame", _REFRESHED)
oracle("incremental_headers", "SELECT * FROM j_new_headers")
oracle("incremental_lines", f"""
SELECT {_LINE_COLS} FROM o_lines l
WHERE EXISTS (SELECT 1 FROM j_new_headers h WHERE h.client_code = l.client_code AND h.entry_id = l.entry_id)""")
oracle("incremental_since", """
SELECT * FROM o_ledger
WHERE updated >= (SELECT max(m) FROM (SELECT max(updated) - INTERVAL 10 DAY AS m FROM o_ledger GROUP BY journal))""")
oracle("tracking_upsert", """
WITH new_rows AS (SELECT client_code, count(*) AS n FROM j_new_headers GROUP BY client_code),
     run AS (SELECT 'header' AS "table", client_code, CASE WHEN client_code NOT LIKE '%9A' THEN TIMESTAMP '2001-08-01' END AS last_sync,
                    if(client_code LIKE '%9A', 'FAILED', 'SUCCESS') AS status, ifnull(n, 0) AS rows
             FROM (SELECT DISTINCT client_code FROM o_headers) LEFT JOIN new_rows USING (client_code))
SELECT "table", client_code, ifnull(run.last_sync, o.last_sync) AS last_sync, if(run.status IS NULL, o.type, 'incremental') AS type,
       ifnull(run.status, o.status) AS status, ifnull(run.rows, o.rows) AS rows, if(run.status IS NULL, o.duration_s, 5400) AS duration_s
FROM o_sync_marks o FULL JOIN run USING ("table", client_code)""")
oracle("incremental_first_run", "SELECT * FROM o_ledger WHERE updated >= TIMESTAMP '2000-01-01'")
oracle("incremental_headers_text", """
SELECT client_code, entry_id, if(entry_id % 89 = 0, '00/00/0000', strftime(entered_at, '%d/%m/%Y %H:%M:%S')) AS entered_at, year, month, journal, archived
FROM o_headers LEFT JOIN (SELECT client_code, last_sync FROM o_sync_marks WHERE "table" = 'header') USING (client_code)
WHERE entry_id % 89 = 0 OR entered_at >= ifnull(last_sync, TIMESTAMP '2000-01-01')""")
oracle("known_tenants", "SELECT DISTINCT client_code FROM o_headers SEMI JOIN o_sync_marks USING (client_code)")
oracle("reset_tracking", """SELECT * REPLACE ('account' AS "table") FROM o_sync_marks""")
oracle("import_listing", """
SELECT "table", count(DISTINCT client_code) AS tenants, CAST(count_if(status <> 'SUCCESS') AS BIGINT) AS failed, CAST(sum(rows) AS BIGINT) AS rows,
       max(last_sync) AS latest_sync
FROM o_sync_marks GROUP BY ALL""")
oracle("entries_exits_by_exit", """
WITH moves AS (SELECT strftime(entry_date, '%Y-%m') AS month, office, 1 AS came, 0 AS went FROM j_master_svc WHERE entry_date IS NOT NULL
               UNION ALL SELECT strftime(exit_date, '%Y-%m'), office, 0, 1 FROM j_master_svc WHERE exit_date IS NOT NULL)
SELECT month, office, CAST(sum(came) AS BIGINT) AS entries, CAST(sum(went) AS BIGINT) AS exits, CAST(sum(came - went) AS BIGINT) AS net FROM moves GROUP BY ALL""")
oracle("purge_year_headers", "SELECT * FROM o_headers WHERE year IS DISTINCT FROM 1999")
oracle("purge_before_headers", "SELECT * FROM o_headers WHERE entered_at IS NULL OR entered_at >= DATE '1997-01-01'")
oracle("source_refresh", "SELECT * FROM j_balance_legacy UNION ALL BY NAME SELECT * REPLACE (lines + 1 AS lines) FROM j_balance_cloud")
oracle("company_refresh", "SELECT * REPLACE (if(company_id % 7 = 0, upper(account_label), account_label) AS account_label) FROM o_ledger")
oracle("quality_alerts", """
WITH found AS (
    SELECT 'duplicate line keys' AS check_name, (SELECT count(*) FROM (SELECT 1 FROM o_lines GROUP BY client_code, line_id HAVING count(*) > 1)) AS violations
    UNION ALL SELECT 'lines without a header', (SELECT count(*) FROM o_lines ANTI JOIN o_headers USING (client_code, entry_id))
    UNION ALL SELECT 'lines without a period', (SELECT count(*) FROM j_booked WHERE (month BETWEEN 1 AND 12) IS NOT TRUE)
    UNION ALL SELECT 'rejected company numbers', (SELECT count(*) FROM j_ranked WHERE place > 1 AND no IS NOT NULL)
    UNION ALL SELECT 'failed or slow imports', (SELECT count(*) FROM o_sync_marks WHERE status <> 'SUCCESS' OR duration_s > 28800))
SELECT * FROM found WHERE violations > 0""")
oracle("tenant_union_frames", """SELECT * EXCLUDE (archived), if(archived, 'archive', 'live') AS bucket FROM o_lines""")
oracle("clean_ledger", """
SELECT * REPLACE (replace(company_name, ',', ';') AS company_name, replace(account_label, ',', ';') AS account_label,
                  replace(journal_label, ',', ';') AS journal_label, ifnull(journal, '') AS journal,
                  CAST(ifnull(debit, 0) AS DECIMAL(18,2)) AS debit, CAST(ifnull(credit, 0) AS DECIMAL(18,2)) AS credit)
FROM o_ledger""")
oracle("copied_tables", """
SELECT 'address' AS table_name, (SELECT count(*) FROM o_address) AS rows UNION ALL SELECT 'staff', (SELECT count(*) FROM o_staff)
UNION ALL SELECT 'account', (SELECT count(*) FROM o_accounts) UNION ALL SELECT 'timesheet', (SELECT count(*) FROM o_timesheet)""")
oracle("account_class", """
SELECT DISTINCT account, ifnull(MAP {'C': '4110', 'F': '4100'}[upper(left(account, 1))], left(account, 4)) AS account_class,
       MAP {'C': 'customer', 'F': 'supplier'}[upper(left(account, 1))] AS kind
FROM o_lines""")
oracle("company_no_split", """
SELECT company_id, left(registration_no, 9) AS company_no, ifnull(length(left(registration_no, 9)) = 9, FALSE) AS valid FROM o_company""")
oracle("drop_test_names", "SELECT company_id, name FROM o_company WHERE NOT regexp_matches(lower(name), 'test|sandbox')")
oracle("new_tenants", """
SELECT DISTINCT client_code FROM o_headers
WHERE client_code NOT IN (SELECT client_code FROM o_sync_marks)""")
oracle("purge_tenant", f"SELECT {_LINE_COLS} FROM o_lines WHERE client_code <> '00042A'")
oracle("purge_year", f"""
SELECT {_LINE_COLS} FROM o_lines l
WHERE NOT EXISTS (SELECT 1 FROM o_headers h WHERE h.client_code = l.client_code AND h.entry_id = l.entry_id
                  AND h.year = 1999)""")
oracle("purge_before", f"""
SELECT {_LINE_COLS} FROM o_lines l
WHERE NOT EXISTS (SELECT 1 FROM o_headers h WHERE h.client_code = l.client_code AND h.entry_id = l.entry_id
                  AND h.entered_at < DATE '1997-01-01')""")

# ================================================================ sources
_ELIGIBLE = """
SELECT schema_name, count(DISTINCT table_name) AS tables FROM o_tenant_catalog
WHERE {like} AND schema_name NOT IN ('ledger_00000', 'ledger_zz')
  AND table_name IN ('archived_line', 'archived_header', 'current_line', 'current_header', 'account', 'journal')
GROUP BY schema_name HAVING count(DISTINCT table_name) = 6"""
oracle("tenant_union", f"SELECT {_LINE_COLS} FROM o_lines")
oracle("eligible_tenants", _ELIGIBLE.format(like="schema_name LIKE 'ledger\\_%' ESCAPE '\\'"))
oracle("eligible_tenants_unescaped", _ELIGIBLE.format(like="schema_name LIKE 'ledger_%'"))
oracle("tenant_code_check", f"""
SELECT schema_name, upper(regexp_replace(schema_name, '^ledger_', '')) AS client_code,
       CAST(length(upper(regexp_replace(schema_name, '^ledger_', ''))) AS INTEGER) AS code_length,
       length(upper(regexp_replace(schema_name, '^ledger_', ''))) <= 20 AS accepted
FROM ({_ELIGIBLE.format(like="schema_name LIKE 'ledger\\_%' ESCAPE '\\'")})""")
oracle("copy_selection", """
SELECT schema_name, table_name FROM o_tenant_catalog
WHERE NOT regexp_matches(table_name, '^archived_') AND NOT regexp_matches(table_name, '_header$')""")
oracle("csv_roundtrip", "SELECT * FROM j_clients")
oracle("tsv_clean", """
SELECT client_code, line_id, entry_id, account,
       CASE WHEN line_id % 11 <> 0 THEN credit END AS credit,
       CASE WHEN line_id % 11 <> 5 THEN debit END AS debit,
       CASE WHEN match_code = '' THEN 'NONE' ELSE match_code END AS match_code
FROM o_lines WHERE line_id % 13 <> 0 AND line_id % 103 <> 2 AND (line_id % 101 <> 1 OR line_id % 11 = 0)""")
oracle("tsv_rejects", """
SELECT line_id, CASE WHEN line_id % 103 = 2 THEN 'wrong number of fields' WHEN line_id % 13 = 0 THEN 'no entry_id' ELSE 'bad credit' END AS reason
FROM o_lines WHERE line_id % 103 = 2 OR line_id % 13 = 0 OR (line_id % 101 = 1 AND line_id % 11 <> 0)""")
oracle("paged_extract", """
SELECT line_id, company_id, day, account, debit, credit,
       row_number() OVER (ORDER BY line_id) AS row_no,
       CAST(floor((row_number() OVER (ORDER BY line_id) - 1) / 1000) AS BIGINT) AS page
FROM o_ledger""")
oracle("clean_projection", """
SELECT company_id, replace(name, ',', ';') AS name, replace(firm, ',', ';') AS firm,
       replace(trade_name, ',', ';') AS trade_name, registration_no, replace(city, ',', ';') AS city,
       postal_code, tax_category, tax_regime, replace(activity_code, '.', '') AS activity_code,
       replace(sector, ',', ';') AS sector, replace(legal_form, ',', ';') AS legal_form, created, updated
FROM o_company""")

oracle("stream_ingest", f"""
SELECT {_LINE_COLS} FROM o_lines
QUALIFY row_number() OVER (PARTITION BY client_code, line_id ORDER BY {_LINE_ORDER}) = 1""")

oracle("top_clients_lines", """
SELECT client_code, count(*) AS lines, CAST(sum(debit + credit) AS DECIMAL(18,2)) AS volume
FROM o_lines GROUP BY client_code ORDER BY lines DESC, client_code ASC LIMIT 20""")
oracle("incremental_since_date", """
SELECT * FROM o_ledger WHERE updated >= strptime('15/01/2024 12:00:00', '%d/%m/%Y %H:%M:%S')""")
oracle("staged_write", "SELECT * FROM j_master")
for _frame in ("source_refresh", "purge_tenant", "purge_year", "purge_before", "purge_before_headers"):
    ORACLE[f"{_frame}_stored"] = ORACLE[_frame]       # the same rows, from tables changed on storage
oracle("company_refresh_stored", """
SELECT * REPLACE (if(company_id % 7 = 0, upper(account_label), account_label) AS account_label) FROM o_ledger WHERE company_id % 21 <> 0""")
oracle("pattern_hits", r"""
WITH used AS (SELECT account FROM o_lines UNION SELECT account FROM o_internal_ledger),
     patterns AS (SELECT unnest(['70_1%', '%00', '%64%', '5____0', '______', '%', '706100', '_0%4_0', '7%', '70\%%']) AS pattern)
SELECT pattern, count(*) AS accounts, min(account) AS first, max(account) AS last
FROM used JOIN patterns ON account LIKE pattern ESCAPE '\' GROUP BY pattern""")
oracle("incremental_headers_tracked", """
SELECT h.* FROM o_headers h JOIN o_sync_marks m ON m.client_code = h.client_code
WHERE h.entered_at >= m.last_sync + INTERVAL 1 YEAR""")
oracle("import_sizes", """
SELECT 'header' AS "table", count(DISTINCT client_code) AS tenants, CAST(count_if(status <> 'SUCCESS') AS BIGINT) AS failed,
       CAST(sum(rows) AS BIGINT) AS rows, max(last_sync) AS latest_sync, CAST(1 AS BIGINT) AS files, TRUE AS stored, TRUE AS has_mean
FROM o_sync_marks
UNION ALL SELECT 'line', NULL, NULL, NULL, NULL, 1, TRUE, NULL""")
oracle("newest_delivery", """
SELECT client_code, line_id, CAST(debit + 1 AS DECIMAL(18,2)) AS debit, DATE '2024-02-29' AS delivered, TRUE AS named FROM o_lines""")
