"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Fixed patterns find the base spans. Besides them, long mixed tokens are candidates. The values of all are hashed
and counted over the corpus by distinct repositories and distinct owners: a value that many owners have, or that
is in many repositories even of one owner, is a widely copied example; any other looks live. Live-looking tokens that
no base span touches are added as spans of the kind ``owned``; base spans always stay.

Positions come from the pattern ``\\G(.*?)(match)``: each find starts where the last one ended, so the lengths of the
gaps and matches add up to code point positions, by a running sum over the few matches of a text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tabqual.llm.shared import save

KINDS = ("assign", "access", "hex", "owned")

#: The base patterns; the length conditions of ``access`` and ``hex`` are part of theirs.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"
LEAST_VALUE = 8

TOKEN = "(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}"
#: A token is a candidate with both letters and digits and at least so many different characters.
LEAST_DISTINCT = 10
#: Values of at least so many owners, or in at least so many repositories, are widely copied examples.
COPIED_OWNERS = 3
COPIED_REPOS = 10


def _finds(text: Column, kind: str, pattern: str, value_group: int | None = None) -> Column:
    """Array of (kind, gap, length, value) of the pattern's matches, in order; empty for texts without one."""
    whole = F.lit(rf"(?s)\G(.*?)({pattern})")
    gaps = F.transform(F.regexp_extract_all(text, whole, 1), F.length)
    matches = F.regexp_extract_all(text, whole, 2)
    values = F.regexp_extract_all(text, whole, value_group) if value_group else matches
    zipped = F.transform(F.arrays_zip(gaps.alias("gap"), matches.alias("match"), values.alias("value")), lambda x: F.struct(
        F.lit(kind).alias("kind"), x["gap"].cast("bigint").alias("gap"), F.length(x["match"]).cast("bigint").alias("length"),
        x["value"].alias("value")))
    none = F.array().cast("array<struct<kind:string,gap:bigint,length:bigint,value:string>>")
    return F.when(text.rlike(pattern), zipped).otherwise(none)


def _row_key(id_col: str, owner_col: str, repo_col: str, text_col: str) -> Column:
    return F.md5(F.to_json(F.struct(*(F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(
        (id_col, owner_col, repo_col))), F.md5(text_col).alias("t")), {"ignoreNullFields": "false"}))


def find_candidates(docs: DataFrame, id_col: str, text_col: str, owner_col: str, repo_col: str) -> DataFrame:
    """``(row_key, owner, repo, kind, start, end, value)`` of base spans and of candidate tokens, once for equal rows."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    finds = F.concat(_finds(text, "assign", ASSIGN, 3), _finds(text, "access", ACCESS), _finds(text, "hex", HEX),
                     _finds(text, "owned", TOKEN))
    rows = docs.select(_row_key(id_col, owner_col, repo_col, text_col).alias("row_key"), F.col(owner_col).cast("string").alias("owner"),
                       F.col(repo_col).cast("string").alias("repo"), finds.alias("finds"))
    rows = rows.filter(F.size("finds") > 0).select("row_key", "owner", "repo", F.posexplode("finds").alias("at", "f"))
    rows = rows.select("row_key", "owner", "repo", "at", "f.*").dropDuplicates(["row_key", "at"])
    reach = F.sum(F.col("gap") + F.col("length")).over(W.partitionBy("row_key", "kind").orderBy("at"))
    rows = rows.withColumn("end", reach).withColumn("start", F.col("end") - F.col("length"))
    value = F.col("value")
    mixed = (value.rlike("[0-9]") & value.rlike("[A-Za-z]")
             & (F.size(F.array_distinct(F.split(value, ""))) >= LEAST_DISTINCT))
    keep = F.when(F.col("kind") == "assign", F.length(value) >= LEAST_VALUE).when(F.col("kind") == "owned", mixed).otherwise(True)
    return rows.filter(keep).select("row_key", "owner", "repo", "kind", "start", "end", F.xxhash64("value").alias("h1"),
                                    F.xxhash64(F.lit(1), "value").alias("h2"))


def ownership(candidates: DataFrame) -> DataFrame:
    """``(h1, h2, owners, repos)``: distinct owners and repositories of every value over the corpus.

    NULL counts as one owner and as one repository. Counted in two steps, so that a value that is everywhere is
    pre-aggregated before each shuffle.
    """
    keys = ["h1", "h2"]
    pairs = candidates.select(*keys, "owner", "repo").distinct()
    owners = pairs.groupBy(*keys, "owner").agg(F.count("*").alias("n")).groupBy(*keys).agg(F.count("*").alias("owners"))
    repos = pairs.groupBy(*keys, "repo").agg(F.count("*").alias("n")).groupBy(*keys).agg(F.count("*").alias("repos"))
    return owners.join(repos, keys)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
         repo_col: str = "doc_id") -> DataFrame:
    """``(id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_copied)`` for every row of ``docs``.

    ``spans`` holds ``kind:start:end`` in code points, ordered by start and then by kind; ``base_sha256`` digests the
    base ones alone, joined likewise. ``n_copied`` counts the spans whose values at least ``COPIED_OWNERS`` owners or
    ``COPIED_REPOS`` repositories have, ``n_live`` all others: each span is one or the other. NULL and empty texts have no spans. Rows equal in id, owner, repository and text count once in the
    ownership and each keep their row; NULL ids, owners and repositories are values like any other. An empty table gives
    an empty table; other columns are ignored.
    """
    found = save(find_candidates(docs, id_col, text_col, owner_col, repo_col), "candidates")
    owned = save(ownership(found), "ownership")
    copied = (F.col("owners") >= COPIED_OWNERS) | (F.col("repos") >= COPIED_REPOS)
    rows = found.join(owned, ["h1", "h2"])
    order = F.struct("start", F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).alias("rank"), "end", "kind",
                     (~copied).alias("live"), copied.alias("copied"))
    per = rows.groupBy("row_key").agg(F.array_sort(F.collect_set(order)).alias("all_spans"))
    base = F.filter("all_spans", lambda s: s["kind"] != "owned")
    per = per.withColumn("base", base)
    per = per.withColumn("spans", F.filter("all_spans", lambda s: (s["kind"] != "owned") | (
        s["live"] & ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))))

    def joined(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                     s["end"].cast("string"))), ",")

    def number(spans: str, test) -> Column:
        return F.size(F.filter(spans, test)).cast("bigint")

    def of_kind(kind: str):
        return lambda s: s["kind"] == kind

    per = save(per.select(
        F.col("row_key").alias("own_key"), *(number("base", of_kind(k)).alias(f"n_{k}") for k in KINDS[:3]),
        joined("base").alias("base"), joined("spans").alias("spans"), number("spans", lambda s: s["live"]).alias("n_live"),
        number("spans", lambda s: s["copied"]).alias("n_copied")), "spans")
    keyed = docs.select(F.col(id_col).alias("id"), _row_key(id_col, owner_col, repo_col, text_col).alias("row_key"))
    out = keyed.join(per, F.col("row_key") == F.col("own_key"), "left")
    numbers = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("n_assign", "n_access", "n_hex")]
    return out.select(F.col("id").alias(id_col), *numbers, F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"),
                      F.coalesce("spans", F.lit("")).alias("spans"),
                      *(F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("n_live", "n_copied")))
