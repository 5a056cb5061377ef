"""``value LIKE pattern`` joins for any pattern, as equi-joins.

A LIKE join is a theta join; run naively it compares every value to every
pattern. Here each pattern names a part that a value must contain, its anchor,
and values are joined to patterns on the anchor; the LIKE itself then decides
among those. The anchor is, in this order,

* ``prefix``: the text before the first wildcard; a value offers its first n
  characters for every length n that a prefix has;
* ``suffix``: the text after the last wildcard; a value offers its last n;
* ``inside``: the longest text between wildcards; a value offers each of its runs
  of n characters once;
* ``length``: a pattern of wildcards only asks for a length; a value offers its
  own, and if there are patterns with ``%`` the shorter ones.

So every pattern is looked up by hash and none is compared to all values. The
lengths come from the pattern table itself, as scalar subqueries; neither side is
broadcast by hand, so AQE decides by size. ``\\`` escapes a wildcard, as in SQL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# a run of literal characters (escaped ones too) or one wildcard
_TOKENS = r"(?s)(?:[^%_\\]|\\.)+|[%_]"


def anchored(patterns: DataFrame, pattern_col: str) -> DataFrame:
    """``patterns`` with _kind, _anchor (empty for ``length``) and _len. NULL patterns match nothing and go."""
    p = F.col(f"`{pattern_col}`")
    tokens = F.regexp_extract_all(p, F.lit(_TOKENS), F.lit(0))
    wild = lambda t: t.isin("%", "_")
    plain = lambda t: F.regexp_replace(t, r"(?s)\\(.)", "$1")
    first, last = F.get("_t", F.lit(0)), F.get("_t", F.size("_t") - 1)
    texts = F.transform(F.filter("_t", lambda t: ~wild(t)), plain)
    longest = F.aggregate(texts, F.lit(""), lambda a, t: F.when(F.length(t) > F.length(a), t).otherwise(a))
    kind = (F.when(F.size("_t") == 0, "prefix").when(~wild(first), "prefix").when(~wild(last), "suffix")
            .when(F.length(longest) > 0, "inside").otherwise("length"))
    anchor = (F.when(F.col("_kind") == "prefix", F.coalesce(plain(first), F.lit(""))).when(F.col("_kind") == "suffix", plain(last))
              .when(F.col("_kind") == "inside", longest).otherwise(F.lit("")))
    ones = F.size(F.filter("_t", lambda t: t == "_"))
    return (patterns.filter(p.isNotNull()).withColumn("_t", tokens).withColumn("_kind", kind).withColumn("_anchor", anchor)
            .withColumn("_len", F.when(F.col("_kind") == "length", ones).otherwise(F.length("_anchor"))).drop("_t"))


def like_join(df: DataFrame, patterns: DataFrame, value_col: str, pattern_col: str) -> DataFrame:
    """Rows of ``df`` joined to every pattern that their value is LIKE; columns of
    both. Values and patterns that are NULL match nothing."""
    pat = anchored(patterns, pattern_col)
    v = F.col(f"`{value_col}`")
    values = df.filter(v.isNotNull())

    def offers(kind: str, anchor) -> DataFrame:
        """What values offer patterns of a kind, one row per length that such patterns have."""
        found = pat.filter(F.col("_kind") == kind).agg(F.sort_array(F.collect_set("_len"))).scalar()   # distinct lengths only
        sized = values.withColumn("_len", F.explode(found)).filter(F.col("_len") <= F.length(v))
        return sized.withColumn("_anchor", anchor).withColumn("_kind", F.lit(kind))

    n = F.col("_len")
    places = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(v) - n + 1))
    runs = F.explode(F.array_distinct(F.transform(places, lambda i: F.substring(v, i, n))))
    parts = [offers("prefix", F.left(v, n)), offers("suffix", F.right(v, n)), offers("inside", runs), offers("length", F.lit(""))]
    keyed = reduce(DataFrame.unionByName, parts)
    right = pat.withColumnsRenamed({"_kind": "_pkind", "_len": "_plen", "_anchor": "_panchor"})
    on = (F.col("_kind") == F.col("_pkind")) & (F.col("_len") == F.col("_plen")) & (F.col("_anchor") == F.col("_panchor"))
    hits = keyed.join(right, on & F.like(v, F.col(f"`{pattern_col}`")), "inner")
    return hits.drop("_kind", "_len", "_anchor", "_pkind", "_plen", "_panchor")
