"""URL filter: explicit rules first, gradient-boosted trees on lexical features for the rest.

The urls that a rule decides are the labelled rows. Trees learn from them by lexical features alone: lengths, path
depth, digit ratio, character entropy, parameter counts, and block rates of the host's suffixes and of the path's first
part. No rate is of host and path together: that pair is what the rules go by, so one split on it would fit all labels
and urls without a rule would have no rate. Each node chooses from some of the features only, so that the others count too.
Suffixes are hashed to a fixed number of buckets, so their statistics, counted over all labelled rows, have a bounded size.
The trees are fitted on a bounded sample: ``sample_rows`` labelled rows are expected, chosen by a hash of the url.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabqual.llm.shared import save

ALLOW, BLOCK = "allow", "block"
SUFFIX_BUCKETS = 1024
SAMPLE_ROWS = 10_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ENTROPY_CHARS = LOWER + "0123456789-._/?&=%:#"


@dataclass(frozen=True)
class Rule:
    """``verdict`` for urls of ``host`` and its subdomains whose path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (Rule(BLOCK, "net", "/"), Rule(ALLOW, "example.net", "/en/"), Rule(BLOCK, "example.com", "/de/"),
         Rule(ALLOW, "org", "/fr/"))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for NULL."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def matched_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as its text; NULL if none does."""
    found = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        found = F.when(fits, F.lit(r.text)).otherwise(found)
    return found


def _occurrences(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def lexical_features(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """Numbers for the trees; all are defined for NULL and empty urls."""
    whole = F.translate(F.coalesce(url, F.lit("")), UPPER, LOWER)
    length = F.length(whole).cast("double")
    query = F.coalesce(F.regexp_extract(whole, r"\?([^#]*)", 1), F.lit(""))
    digits = F.length(whole) - F.length(F.translate(whole, "0123456789", ""))
    rest = F.length(F.translate(whole, ENTROPY_CHARS, "")).cast("double")
    entropy = F.lit(0.0)
    for n in [*(_occurrences(whole, c).cast("double") for c in ENTROPY_CHARS), rest]:
        entropy = entropy + F.when(n > 0, -(n / length) * F.log2(n / length)).otherwise(0.0)
    last = F.element_at(F.split(path, "/"), -1)
    return {
        "url_length": length,
        "host_length": F.length(host).cast("double"),
        "path_length": F.length(path).cast("double"),
        "host_depth": _occurrences(host, ".").cast("double"),
        "path_depth": _occurrences(path, "/").cast("double"),
        "digit_ratio": F.when(length > 0, digits / length).otherwise(0.0),
        "hyphens": _occurrences(host, "-").cast("double"),
        "entropy": entropy,
        "parameters": F.when(query == "", 0).otherwise(_occurrences(query, "&") + 1).cast("double"),
        "query_length": F.length(query).cast("double"),
        "fragment": whole.contains("#").cast("double"),
        "https": whole.startswith("https:").cast("double"),
        "extension": last.contains(".").cast("double"),
    }


def _suffix_bucket(host: Column, path: Column, labels: int, section: bool) -> Column:
    own = F.reverse(F.slice(F.reverse(F.split(host, r"\.")), 1, labels))
    start = F.regexp_extract(path, "^/([^/]*)", 1) if section else F.lit("")
    return F.pmod(F.xxhash64(F.lit(labels), F.array_join(own, "."), start), F.lit(SUFFIX_BUCKETS)).cast("int")


class UrlFilter:
    """Rules, suffix statistics and trees. ``trees`` is None if the rules label only one class or nothing."""

    #: Statistics: how many labels of the host, and whether with the first part of the path; never both.
    LEVELS = ((1, False), (2, False), (0, True))

    def __init__(self, rules=RULES):
        self.rules, self.trees, self.constant = rules, None, ALLOW
        self.rates = [[0.5] * SUFFIX_BUCKETS for _ in self.LEVELS]

    def _prepared(self, urls: DataFrame, url_col: str) -> DataFrame:
        """``urls`` as ``(row, host, path, rule, verdict by rule, url)``."""
        url = F.col(url_col)
        host, path = host_of(url), path_of(url)
        rule = matched_rule(F.col("host"), F.col("path"), self.rules)
        by_text = F.create_map(*(F.lit(v) for r in self.rules for v in (r.text, r.verdict)))
        return (urls.withColumn("host", host).withColumn("path", path).withColumn("rule", rule)
                .withColumn("ruled", by_text[F.col("rule")]).withColumnRenamed(url_col, "url"))

    def _assembled(self, rows: DataFrame) -> DataFrame:
        columns = lexical_features(F.col("url"), F.col("host"), F.col("path"))
        for i, (labels, section) in enumerate(self.LEVELS):
            rates = F.array(*(F.lit(v) for v in self.rates[i]))
            columns[f"suffix_{i}"] = F.element_at(rates, _suffix_bucket(F.col("host"), F.col("path"), labels, section) + 1)
        rows = rows.withColumns(columns)
        return VectorAssembler(inputCols=list(columns), outputCol="features").transform(rows).drop(*columns)

    def fit(self, urls: DataFrame, url_col: str = "url", sample_rows: int = SAMPLE_ROWS, iterations: int = 15,
            depth: int = 4) -> UrlFilter:
        rows = self._prepared(urls.select(url_col), url_col).filter("ruled is not null")
        rows = rows.withColumn("label", (F.col("ruled") == BLOCK).cast("double"))
        stats = rows.select("label", F.explode(F.array(*(
            F.struct(F.lit(i).alias("n"), _suffix_bucket(F.col("host"), F.col("path"), *level).alias("bucket"))
            for i, level in enumerate(self.LEVELS)))).alias("s"))
        stats = stats.groupBy("s.n", "s.bucket").agg(F.count("*").alias("rows"), F.sum("label").alias("blocked")).collect()
        total = sum(r["rows"] for r in stats if r["n"] == 0)
        blocked = sum(r["blocked"] for r in stats if r["n"] == 0)
        if not total:
            return self
        prior = blocked / total
        self.rates = [[prior] * SUFFIX_BUCKETS for _ in self.LEVELS]
        for r in stats:
            self.rates[r["n"]][r["bucket"]] = (r["blocked"] + 10 * prior) / (r["rows"] + 10)
        if blocked in (0, total):
            self.constant = BLOCK if blocked else ALLOW
            return self
        chance = F.pmod(F.xxhash64("url"), F.lit(1 << 30)) / F.lit(float(1 << 30))
        sample = save(self._assembled(rows.filter(chance < min(1.0, sample_rows / total))).select("features", "label"), "urls")
        if sample.select("label").distinct().count() < 2:
            self.constant = BLOCK if prior >= 0.5 else ALLOW
            return self
        self.trees = GBTClassifier(maxIter=iterations, maxDepth=depth, stepSize=0.3, seed=11,
                                   featureSubsetStrategy="sqrt").fit(sample)
        return self

    def judge(self, urls: DataFrame, url_col: str = "url", id_col: str = "page_id") -> DataFrame:
        """``(id, host, path, rule, verdict, score)`` for every row.

        The verdict is the rule's, else the trees'; ``score`` is their probability of ``block``. NULL and malformed urls have an
        empty host and path and are judged by their features like any other. Repeated rows and NULL ids
        keep their rows; an empty table gives an empty table; other columns are ignored.
        """
        rows = self._prepared(urls.select(F.col(id_col).alias("id"), F.col(url_col).alias("u")), "u")
        if self.trees is None:
            rows = rows.withColumn("score", F.lit(1.0 if self.constant == BLOCK else 0.0))
        else:
            rows = self.trees.transform(self._assembled(rows))
            rows = rows.withColumn("score", vector_to_array("probability")[1])
        guess = F.when(F.col("score") >= 0.5, BLOCK).otherwise(ALLOW)
        return rows.select(F.col("id").alias(id_col), "host", "path", "rule",
                           F.coalesce("ruled", guess).alias("verdict"), "score")
