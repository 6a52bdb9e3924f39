"""URL verdicts: host and path rules first, gradient-boosted trees on lexical features for the rest.

The trees see a URL's text only: lengths, depth, digit share, entropy, parameter
counts, and how often URLs of the same host suffix are blocked.  They are
trained on labelled URLs, a bounded sample of them; suffix counts come from all
labelled URLs.  Features are native expressions, training and scoring Spark ML.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loam.session import materialize

# The trees are fitted on about so many distinct labelled URLs (an expectation: each is drawn by its hash).
SAMPLE_URLS = 20_000
FOLDS = 5               # a training URL's suffix shares come from the other folds
PRIOR_WEIGHT = 5.0      # labelled URLs that the share of all labelled URLs counts for, in each suffix's share
TREES, DEPTH = 12, 4

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


class Rule(NamedTuple):
    """A verdict for a host with its subdomains, and for the paths that start with ``path``."""
    verdict: str        # 'allow' or 'block'
    host: str
    path: str = "/"


RULES = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"),
         Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The text after the first ``://`` up to ``/``, ``?``, ``#`` (A-Z lower-cased), and from there up to ``?`` or ``#``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _UPPER.lower())
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest fitting rule as (rule, verdict), else null; of equal lengths the longer host's, then a block."""
    for r in rules:
        if r.verdict not in ("allow", "block"):
            raise ValueError(f"verdict of {r} is not allow or block")
    ranked = sorted(set(rules), key=lambda r: (-len(r.host) - len(r.path), -len(r.host), r.verdict != "block", r))
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in reversed(ranked):
        name = r.host.translate(str.maketrans(_UPPER, _UPPER.lower()))
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def lexical_features(url: Column, host: Column, path: Column) -> Column:
    """Length, host length, path length, depth, host labels, digit share, hyphens, entropy, parameters, query length.

    Entropy is in bits a character, over the 94 visible ASCII characters and one class for all others.
    """
    n = F.length(url).cast("double")
    share = lambda k: k.cast("double") / F.greatest(n, F.lit(1.0))
    without = lambda s, pattern: F.length(F.regexp_replace(s, pattern, ""))
    each = F.transform(F.sequence(F.lit(33), F.lit(126)), lambda c: (F.length(url) - F.length(F.replace(url, F.chr(c), F.lit("")))).cast("double"))
    others = without(url, r"[\x21-\x7E]+").cast("double")
    counts = F.concat(each, F.array(others))
    entropy = F.aggregate(counts, F.lit(0.0), lambda a, k: a - F.when(k > 0, share(k) * F.log2(share(k))).otherwise(0.0))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    parameters = F.when(query == "", 0).otherwise(1 + F.length(query) - without(query, "&+"))
    values = [n, F.length(host), F.length(path), F.size(F.filter(F.split(path, "/"), lambda s: s != "")),
              F.size(F.split(host, r"\.")), share(without(url, "[^0-9]+")), F.length(host) - without(host, "-+"),
              entropy, parameters, F.length(query)]
    return F.array(*[v.cast("double") for v in values])


def _described(urls: DataFrame) -> DataFrame:
    """``urls`` with _host, _path, _words (lexical features) and the keys of suffix counts.

    Keys: the host's last label, its last two, and these two with the path's first directory.
    """
    url = F.coalesce(F.col("url"), F.lit(""))
    host, path = host_and_path(F.col("url"))
    out = urls.withColumns({"_host": host, "_path": path})
    return out.withColumns({"_words": lexical_features(url, F.col("_host"), F.col("_path")),
                            "_one": F.substring_index("_host", ".", -1), "_two": F.substring_index("_host", ".", -2),
                            "_three": F.concat(F.substring_index("_host", ".", -2), F.regexp_extract("_path", "^/[^/]*", 0), F.lit("/"))})


class UrlModel:
    """Trees and suffix counts; with labels of one class only (or none) the verdict is that class (or allow)."""

    def __init__(self, trees: GBTClassificationModel | None, prior: float, suffixes: DataFrame):
        self.trees, self.prior, self.suffixes = trees, prior, suffixes

    def judge(self, urls: DataFrame) -> DataFrame:
        """``urls`` with the column ``blocked``; null URLs count as empty, repeated rows are judged alike."""
        if self.trees is None:
            return urls.withColumn("blocked", F.lit(self.prior > 0.5))
        out = self.trees.setFeaturesCol("_features").setPredictionCol("_verdict").setRawPredictionCol("").setProbabilityCol("").transform(
            _with_shares(_described(urls), self.suffixes, self.prior, None))
        return out.select(*urls.columns, (F.col("_verdict") == 1.0).alias("blocked"))


def _with_shares(rows: DataFrame, suffixes: DataFrame, prior: float, fold: str | None) -> DataFrame:
    """``rows`` with ``_features``: the lexical ones, and of each suffix the labelled count and the blocked share."""
    values = [F.col("_words")]
    for key in ("_one", "_two", "_three"):
        side = suffixes.select(F.col("suffix").alias(key), *[F.col(c).alias(key + c) for c in ("n", "b", "n_in", "b_in")])
        rows = rows.join(side, key, "left")
        n, b = F.coalesce(key + "n", F.lit(0)), F.coalesce(key + "b", F.lit(0))
        if fold:
            n = n - F.coalesce(F.get(key + "n_in", F.col(fold)), F.lit(0))
            b = b - F.coalesce(F.get(key + "b_in", F.col(fold)), F.lit(0))
        values.append(F.array(F.log1p(n.cast("double")), (b + PRIOR_WEIGHT * prior) / (n + PRIOR_WEIGHT)))
    return rows.withColumn("_features", array_to_vector(F.concat(*values)))


def fit_url_model(labelled: DataFrame, sample_urls: int = SAMPLE_URLS, seed: int = 7) -> UrlModel:
    """Trees from ``labelled`` (url, blocked); a URL counts once, as blocked if any of its rows is.

    Suffix counts are over all labelled URLs, the trees' training set about ``sample_urls`` of them.
    Rows whose url or label is null are not labelled.
    """
    once = labelled.filter("url IS NOT NULL AND blocked IS NOT NULL").groupBy("url").agg(F.max(F.col("blocked").cast("int")).alias("y"))
    once = materialize(once.withColumn("_hash", F.xxhash64("url", F.lit(seed))))
    total = once.agg(F.count("*").alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("b")).first()
    prior = total["b"] / total["n"] if total["n"] else 0.0
    fold = F.pmod(F.shiftright("_hash", 32), F.lit(FOLDS)).cast("int")
    rows = _described(once.withColumn("_fold", fold))
    keyed = rows.select("y", "_fold", F.explode(F.array_distinct(F.array("_one", "_two", "_three"))).alias("suffix"))
    inside = lambda v: F.array(*[F.sum(F.when(F.col("_fold") == i, v).otherwise(0)) for i in range(FOLDS)])
    suffixes = materialize(keyed.groupBy("suffix").agg(
        F.count("*").alias("n"), F.sum("y").alias("b"), inside(F.lit(1)).alias("n_in"), inside(F.col("y")).alias("b_in")))
    if total["b"] in (0, total["n"]):
        return UrlModel(None, prior, suffixes)
    drawn = rows if total["n"] <= sample_urls else rows.filter(
        F.pmod("_hash", F.lit(1 << 30)) < int((1 << 30) * sample_urls / total["n"]))
    train = materialize(_with_shares(drawn, suffixes, prior, "_fold").select(F.col("y").cast("double").alias("label"), F.col("_features").alias("features")))
    if train.agg(F.countDistinct("label")).first()[0] < 2:
        return UrlModel(None, prior, suffixes)
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=seed, maxBins=32).fit(train.coalesce(4))
    return UrlModel(trees, prior, suffixes)


def url_verdicts(pages: DataFrame, rules: Sequence[Rule] = RULES, sample_urls: int = SAMPLE_URLS) -> DataFrame:
    """``page_id``, host, path, rule and verdict of every row of ``pages`` (page_id, url; other columns are ignored).

    URLs that a rule decides are the labelled ones; the trees judge the others.  A null url, or one without
    ``://``, has an empty host and path and is judged by the trees; an empty table gives no rows.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules))
    ruled = rows.filter("fit IS NOT NULL")
    model = fit_url_model(ruled.select("url", (F.col("fit.verdict") == "block").alias("blocked")), sample_urls)
    rest = model.judge(rows.filter("fit IS NULL"))
    named = F.when(F.col("blocked"), "block").otherwise("allow")
    return ruled.select("page_id", "host", "path", "fit.rule", "fit.verdict").unionByName(
        rest.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), named.alias("verdict")))
