"""URL filters: gradient-boosted trees on lexical features, with rules that override them.

Features come from the URL's text by Spark SQL functions: lengths of host and path, depth
of both, share of digits, entropy of the host's characters, hyphens, numbers of
parameters, and statistics of the suffix (the share of blocked and the number of training
URLs under the same registered name). Boosting and scoring are Spark ML's, on DataFrames; no
Python runs on rows.

Training URLs are labelled rows (url, label); at most ``most_rows`` of them (by hash) are
used, the documented bound. Their suffix table is therefore bounded, too. A suffix's
statistics for a training URL leave out that URL itself.

Defined cases: a URL without ``://`` or null has an empty host and path and is judged by
its features; a port or user stays part of the host; repeated rows are judged each; with
labels of one class or none every URL without a rule gets that class (allow if none);
labels that are null are ignored; an empty table gives no rows; very long URLs are read whole;
other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm._common import ascii_lower, cut

FEATURES = ("url_length", "host_length", "path_length", "host_depth", "path_depth", "digit_ratio", "host_entropy", "hyphens", "parameters", "suffix_rate", "suffix_count")

# Words in the names of sites that are to be blocked; they label the URLs of a corpus without labels.
BLOCKED_NAMES = "casino bets poker slots pills viagra loans adult xxx porn spam ads track warez torrent replica lottery".split()


def host_of(url: Column) -> Column:
    """Text after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    at = F.locate("://", url)
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    return ascii_lower(F.coalesce(F.regexp_extract(rest, "^([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """Text after the host up to ``?``, ``#`` or the end."""
    at = F.locate("://", url)
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    return F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


@dataclass(frozen=True)
class Rule:
    """``host/path``: fits the host and its subdomains if the URL's path starts with the rule's."""

    text: str
    verdict: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        _, slash, rest = self.text.partition("/")
        return slash + rest


def rule_for(rules: list[Rule], host: Column, path: Column, what: str = "text") -> Column:
    """Text or verdict of the longest rule that fits; null if none does."""
    found = None
    for rule in sorted(rules, key=lambda r: (-len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        value = F.lit(getattr(rule, what))
        found = F.when(fits, value) if found is None else found.when(fits, value)
    return F.lit(None).cast("string") if found is None else found


def lexical(urls: DataFrame, url_col: str = "url") -> DataFrame:
    """Adds host, path, suffix and the features of the text to a table with a ``url``."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    parts = urls.withColumns({"host": host_of(F.col(url_col)), "path": path_of(F.col(url_col)), "all": url})
    characters = F.sort_array(F.split("host", ""))
    length = F.length("host")
    entropy = F.aggregate(
        F.array_distinct(characters),
        F.lit(0.0),
        lambda acc, c: acc - (lambda p: p * F.log2(p))((length - F.length(F.replace(F.col("host"), c, F.lit("")))) / length),
    )
    query = F.regexp_extract("all", "\\?([^#]*)", 1)
    labels = F.split("host", "\\.")
    return parts.withColumns({
        "suffix": F.array_join(F.slice(labels, F.greatest(F.lit(1), F.size(labels) - 2), 3), "."),
        "url_length": F.length("all").cast("double"),
        "host_length": length.cast("double"),
        "path_length": F.length("path").cast("double"),
        "host_depth": F.size(labels).cast("double"),
        "path_depth": F.regexp_count("path", F.lit("/[^/]")).cast("double"),
        "digit_ratio": F.when(F.length("all") > 0, F.regexp_count("all", F.lit("[0-9]")) / F.length("all")).otherwise(0.0),
        "host_entropy": F.when(length > 0, entropy).otherwise(0.0),
        "hyphens": F.regexp_count("host", F.lit("-")).cast("double"),
        "parameters": F.when(F.length(query) > 0, F.regexp_count(query, F.lit("&")) + 1).otherwise(0).cast("double"),
    }).drop("all")


def labelled_by_name(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """(url, label): labels a corpus' URLs by words in the name of their site, for lack of given labels."""
    host = F.concat(F.lit("."), host_of(F.col(url_col)), F.lit("."))
    return pages.select(F.col(url_col).alias("url"), host.rlike("[.-](" + "|".join(BLOCKED_NAMES) + ")[.-]").cast("int").alias("label"))


@dataclass
class Filter:
    """A fitted filter: trees, suffix statistics of the training URLs and their mean label."""

    trees: PipelineModel | None
    suffixes: DataFrame | None
    base: float

    def blocks(self, urls: DataFrame, url_col: str = "url") -> DataFrame:
        """Adds host, path and ``blocked`` to the rows."""
        rows = lexical(urls, url_col)
        if self.trees is None:
            return rows.withColumn("blocked", F.lit(self.base >= 0.5))
        rows = _with_suffix(rows, self.suffixes, self.base)
        return self.trees.transform(rows).withColumn("blocked", F.col("prediction") == 1.0)


def _with_suffix(rows: DataFrame, suffixes: DataFrame, base: float, own: Column | None = None) -> DataFrame:
    """Adds the suffix statistics, smoothed by two URLs at the mean; ``own``: the row's label, left out."""
    n, bad = F.coalesce("n", F.lit(0)), F.coalesce("bad", F.lit(0))
    if own is not None:
        n, bad = n - 1, bad - own
    # At most one row for each training URL, so the broadcast is bounded.
    joined = rows.join(F.broadcast(suffixes), "suffix", "left")
    return joined.withColumns({"suffix_rate": (bad + 2 * F.lit(base)) / (n + 2), "suffix_count": n.cast("double")})


def held_out(url: Column) -> Column:
    """URLs kept from training: CRC-32 of the URL is divisible by five."""
    return F.coalesce(F.crc32(url) % 5 == 0, F.lit(False))


def fit(labelled: DataFrame, most_rows: int = 20_000, trees: int = 10, depth: int = 3, seed: int = 7) -> Filter:
    """Fit trees on at most ``most_rows`` labelled URLs (url, label)."""
    chosen = labelled.select("url", F.col("label").cast("int").alias("label")).filter("url is not null and label is not null")
    chosen = chosen.orderBy(F.md5("url"), "label").limit(most_rows)
    # Written to the shared folder: at most ``most_rows`` rows, which every round of boosting reads.
    rows = cut(lexical(chosen).select("suffix", "label", *[f for f in FEATURES if not f.startswith("suffix")]))
    n, bad = rows.agg(F.count("*"), F.sum("label")).first()
    base = (bad or 0) / n if n else 0.0
    if not n or bad in (0, n):
        return Filter(None, None, base)
    suffixes = rows.groupBy("suffix").agg(F.count("*").alias("n"), F.sum("label").alias("bad"))
    training = _with_suffix(rows, suffixes, base, F.col("label"))
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    boosted = GBTClassifier(labelCol="label", maxIter=trees, maxDepth=depth, stepSize=0.3, seed=seed)
    model = boosted.fit(vectors.transform(training))
    return Filter(PipelineModel([vectors, model]), suffixes, base)


def judge(pages: DataFrame, filter_: Filter, rules: list[Rule], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict, blocked): the longest fitting rule decides, else the trees' ``blocked``."""
    rows = filter_.blocks(pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url")))
    host, path = F.col("host"), F.col("path")
    return rows.select(
        F.col("id").alias(id_col),
        host,
        path,
        rule_for(rules, host, path).alias("rule"),
        F.coalesce(rule_for(rules, host, path, "verdict"), F.when(F.col("blocked"), "block").otherwise("allow")).alias("verdict"),
        "blocked",
    )
