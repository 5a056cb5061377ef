"""License scan by canonical digests.

A text is brought to a canonical form - lower case; copyright statements gone; every
run of characters other than letters and digits one space; equivalent spellings
made alike - and its SHA-256 is joined to the digests of known licence texts,
which go through the same form. Two units are looked up: the entire text of a
document (its line breaks count as spaces, so wrapping doesn't matter), and
every entire line of it, as licence notices in running documents are lines.
Parts of a unit never match.

DataFrame functions only. One pass over the text makes the digests; what is
joined are digests, not texts. The known table may be of any size: neither
side is broadcast by hand. Digests of lines that very many documents share
are counted per document first and joined on (digest, salt), with the known
side repeated per salt, so that a hot line is spread.

Defined results: a null or empty text, or one that is empty in canonical form,
has no licence; a text known under several ids lists each, and the smallest is
``license_id``; repeated rows give repeated results; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table
from .license_texts import KNOWN, SPELLINGS

# A holder statement at the beginning of a line: mark, years and holder up to the sentence's end (a word of four
# letters or more and a full stop), to words a licence goes on with (kept, group 1), or to the line's end. "(c)"
# alone counts before a year or a line of up to three words; without mark and year a holder line ends like an organisation.
_ORG = r"(?:inc|llc|ltd|corp|corporation|gmbh|foundation|contributors|authors|developers|team|university)"
_NOT_LAW = r"(?:[^\s(holnaisd]|h(?:[^o]|o[^l])|o(?:[^w]|w[^n])|n(?:[^o]|o[^t])|l(?:[^ai]|a[^w]|i[^c])|a(?:[^n]|n[^d])|i(?:[^ns]|n[^t])|s(?:[^t]|t[^a])|d[^i])"
_GOES_ON = (r"permission (?:is hereby|is granted|to use)|redistributions? and use|licen[cs]ed under|released under|distributed under|available under|all rights reserved|"
            r"everyone is permitted|this (?:software|program|work|library|file|project|code|licen[cs]e|source|product)|the above copyright|the software is|you may|verbatim copying|"
            r"spdx-licen[cs]e|mit licen[cs]e|apache licen[cs]e")
COPYRIGHT = (rf"(?m)^[^\n\p{{L}}\p{{N}}]*(?:(?:copyright[ \t]*(?:©|\(c\)|[0-9]{{4}}|by )|©[ \t]*[\p{{L}}0-9]|\(c\)[ \t]*(?:copyright|[0-9]{{4}}))[^\n]*?(?:[\p{{L}}0-9)]{{4}}\.[ \t]+|(\n|\z|{_GOES_ON}))"
             rf"|copyright[ \t]+{_NOT_LAW}[^\n]{{0,80}}\b{_ORG}[^\p{{L}}\p{{N}}\n]*$|\(c\)[ \t]*[\p{{L}}]+(?: [\p{{L}}]+){{0,2}}[ \t]*$)")
OTHER = r"[^\p{L}\p{N}\n]+"
SALTS = 16


def _java(replacement: str) -> str:
    return re.sub(r"\\([0-9])", r"$\1", replacement)


def canonical_lines(text: Column) -> Column:
    """Non-empty canonical lines of a text."""
    t = F.lower(F.coalesce(text.cast("string"), F.lit("")))
    t = F.regexp_replace(t, F.lit("(?d)" + COPYRIGHT), F.lit("$1"))     # lines end at \\n alone
    t = F.regexp_replace(t, F.lit(OTHER), F.lit(" "))
    for pattern, replacement in SPELLINGS:
        t = F.regexp_replace(t, F.lit(pattern), F.lit(_java(replacement)))
    return F.filter(F.transform(F.split(t, "\n", -1), lambda x: F.trim(x)), lambda x: x != "")


def digests(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` without its text: ``digest`` of the whole (null if empty) and
    ``line_digests``, with how often each line occurs."""
    lines = rows.withColumn("_lines", canonical_lines(F.col(text))).drop(text)
    whole = F.when(F.size("_lines") > 0, F.sha2(F.array_join("_lines", " "), 256))
    return lines.select(*[c for c in lines.columns if c != "_lines"], whole.alias("digest"),
                        F.transform("_lines", lambda x: F.sha2(x, 256)).alias("line_digests"))


def known_digests(spark: SparkSession, known: list[tuple[str, str]] | DataFrame = KNOWN) -> DataFrame:
    """(digest, license_id) of a table or list of (license_id, text)."""
    df = known if isinstance(known, DataFrame) else spark.createDataFrame(known, "license_id string, text string").repartition(SALTS)
    return digests(df.select("license_id", "text"), "text").filter("digest is not null").select("digest", "license_id").distinct()


def scan(docs: DataFrame, known: list[tuple[str, str]] | DataFrame = KNOWN) -> DataFrame:
    """doc_id, digest, license_id, n_license_lines, licenses of every row of ``docs``."""
    spark = docs.sparkSession
    src = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("_text"))
    rows = stored(digests(src, "_text"), "license-digests")
    ids = stored(known_digests(spark, known), "license-known").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.col("rid"), F.lit(SALTS)).cast("int").alias("salt")
    units = (rows.filter("digest is not null").select("rid", "digest", F.lit(0).alias("line"), salt)
             .unionByName(rows.select("rid", F.explode("line_digests").alias("digest"), F.lit(1).alias("line"), salt)))
    hits = (units.join(ids, ["digest", "salt"]).groupBy("rid", "digest", "line")
            .agg(F.collect_set("license_id").alias("ids"), F.countDistinct("license_id").alias("k"), F.count(F.lit(1)).alias("n")))
    found = hits.groupBy("rid").agg(
        F.min(F.when(F.col("line") == 0, F.array_min("ids"))).alias("license_id"),
        F.sum(F.when(F.col("line") == 1, F.col("n") / F.col("k")).otherwise(0)).cast("long").alias("n_license_lines"),
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), ",").alias("licenses"))
    return (rows.drop("line_digests").join(found, "rid", "left")
            .select("doc_id", "digest", "license_id", F.coalesce("n_license_lines", F.lit(0).cast("long")).alias("n_license_lines"),
                    F.coalesce("licenses", F.lit("")).alias("licenses")))


def op4_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _sql_lines(text: str) -> str:
    t = f"regexp_replace(lower(coalesce({text}, '')), {_quoted(COPYRIGHT)}, {_quoted(chr(92) + '1')}, 'g')"
    t = f"regexp_replace({t}, {_quoted(OTHER)}, ' ', 'g')"
    for pattern, replacement in SPELLINGS:
        t = f"regexp_replace({t}, {_quoted(pattern)}, {_quoted(replacement)}, 'g')"
    return f"[trim(x) for x in string_split({t}, chr(10)) if trim(x) <> '']"


ORACLE_SQL = f"""
WITH known AS (SELECT DISTINCT id, sha256(array_to_string({_sql_lines('t')}, ' ')) AS digest
               FROM (VALUES {', '.join(f'({_quoted(i)}, {_quoted(t)})' for i, t in KNOWN)}) v(id, t)),
     docs AS (SELECT row_number() OVER () AS rid, doc_id, {_sql_lines('text')} AS lines FROM documents),
     whole AS (SELECT rid, doc_id, if(len(lines) > 0, sha256(array_to_string(lines, ' ')), NULL) AS digest FROM docs),
     units AS (SELECT rid, digest, 0 AS line, 0 AS place FROM whole
               UNION ALL SELECT rid, sha256(x), 1, place FROM (SELECT rid, unnest(lines) AS x, generate_subscripts(lines, 1) AS place FROM docs)),
     found AS (SELECT rid, min(id) FILTER (line = 0) AS license_id, count(DISTINCT place) FILTER (line = 1) AS n,
                      array_to_string(list_sort(list_distinct(list(id))), ',') AS licenses
               FROM units JOIN known USING (digest) GROUP BY rid)
SELECT doc_id, digest, license_id, ifnull(n, 0) AS n_license_lines, ifnull(licenses, '') AS licenses FROM whole LEFT JOIN found USING (rid)"""
