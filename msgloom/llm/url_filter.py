"""URL filter: rules first, and gradient-boosted trees on lexical features for the rest."""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgloom.llm.common import stored

ADDRESS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
QUERY = r"(?s)^.*?://[^?#]*\?([^#]*)"
#: Labelled urls the trees are fitted on at most; statistics take all labelled rows.
FIT_ROWS = 20_000
TREES, DEPTH, SEED = 15, 4, 7
PRIOR = 10.0  # rows that a suffix's share of blocked ones is pulled to the mean by


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    def __str__(self) -> str:
        return f"{self.host}{self.path}"


RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)
FEATURES = ("length", "host_length", "path_length", "depth", "digits", "entropy", "parameters", "labels",
            "hyphens", "top_share", "top_rows", "site_share", "site_rows", "head_share", "head_rows")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host_of(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), ADDRESS, 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), ADDRESS, 2)


def fits(rule: Rule) -> Column:
    """Whether the rule's host is the url's or above it, and its path the start of the url's."""
    at = F.concat(F.lit("."), F.col("host")).endswith(f".{rule.host}")
    return at & F.col("path").startswith(rule.path)


def with_rules(urls: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """rule and ruled: the longest fitting rule and its verdict, null where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(str(r)), r.host, r.path)):
        name = F.when(fits(rule), str(rule)).otherwise(name)
        verdict = F.when(fits(rule), rule.verdict).otherwise(verdict)
    return urls.withColumns({"rule": name, "ruled": verdict})


def _entropy(text: Column) -> Column:
    """Bits per character."""
    size = F.length(text)
    counts = F.transform(F.array_distinct(F.split(text, "")),
                         lambda c: size - F.length(F.replace(text, c, F.lit(""))))
    bits = F.aggregate(counts, F.lit(0.0),
                       lambda a, n: a - F.when(n > 0, n / size * F.log2(n / size)).otherwise(0.0))
    return F.when(size > 0, bits).otherwise(0.0)


def lexical(urls: DataFrame) -> DataFrame:
    """Adds the lexical features and the keys of the suffix statistics."""
    url = F.coalesce(F.col("url"), F.lit(""))
    labels = F.split("host", r"\.")
    gone = lambda chars: F.length(url) - F.length(F.translate(url, chars, ""))
    query = F.regexp_extract(url, QUERY, 1)
    return urls.withColumns({
        "length": F.length(url).cast("double"),
        "host_length": F.length("host").cast("double"),
        "path_length": F.length("path").cast("double"),
        "depth": (F.size(F.filter(F.split("path", "/"), lambda p: p != ""))).cast("double"),
        "digits": gone(string.digits) / F.greatest(F.length(url), F.lit(1)),
        "entropy": _entropy(url),
        "parameters": F.size(F.filter(F.split(query, "&"), lambda p: p != "")).cast("double"),
        "labels": F.size(labels).cast("double"),
        "hyphens": gone("-").cast("double"),
        "top": F.element_at(labels, -1),
        "site": F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), "."),
        "head": F.coalesce(F.get(F.split("path", "/"), F.lit(1)), F.lit("")),
    })


def with_shares(urls: DataFrame, labelled: DataFrame) -> DataFrame:
    """Adds how often each suffix, and each first folder, is blocked among all labelled rows.

    A row's own label is not left out of its shares; the prior damps what that gives away.
    """
    mean = F.coalesce(F.col("mean"), F.lit(0.5))
    # One row.
    overall = labelled.agg(F.avg("label").alias("mean"))
    out = urls.crossJoin(F.broadcast(overall))
    for key in ("top", "site", "head"):
        counts = labelled.groupBy(key).agg(F.sum("label").alias("_blocked"), F.count(F.lit(1)).alias("_rows"))
        rows = F.coalesce(F.col("_rows"), F.lit(0))
        share = (F.coalesce(F.col("_blocked"), F.lit(0)) + PRIOR * mean) / (rows + PRIOR)
        out = (
            out.join(counts, key, "left")
            .withColumns({f"{key}_share": share, f"{key}_rows": F.log1p(rows.cast("double"))})
            .drop("_blocked", "_rows")
        )
    return out.drop("mean")


def sample_of(labelled: DataFrame, fit_rows: int) -> DataFrame | None:
    """url, label and weight of at most ``fit_rows`` distinct urls, taken by the hash of the url.

    Each label has half of them, or what the other leaves. A url weighs as much as its
    rows, times the label's rows for each of its rows in the sample, so that the labels weigh as
    among all rows. None where all rows have one label.
    """
    least, most = labelled.agg(F.min("label"), F.max("label")).first()
    if least == most:
        return None
    urls = labelled.groupBy("url", "label").agg(F.count(F.lit(1)).alias("rows"))
    order = (F.xxhash64("url"), F.col("url"), F.col("label"))
    sides = (F.col("label") < most, F.col("label") == most)
    first = [urls.filter(side).orderBy(*order).limit(fit_rows) for side in sides]
    firsts = stored(first[0].unionByName(first[1]), "url-candidates")
    counts = firsts.agg(*(F.count_if(side) for side in sides)).first()
    quota = [max(1, fit_rows // 2, fit_rows - n) for n in reversed(counts)]
    whole = labelled.agg(*(F.count_if(side) for side in sides)).first()
    taken = []
    for side, most_urls, rows in zip(sides, quota, whole):
        mine = firsts.filter(side).orderBy(*order).limit(most_urls)
        share = F.lit(float(rows)) / mine.agg(F.sum("rows")).first()[0]
        taken.append(mine.select("url", "label", (F.col("rows") * share).alias("weight")))
    return taken[0].unionByName(taken[1])


def fit(labelled: DataFrame, fit_rows: int = FIT_ROWS) -> GBTClassificationModel | None:
    """Trees fitted on a sample of at most ``fit_rows`` labelled urls that has both labels.

    None where the rows have one label only.
    """
    picked = sample_of(labelled, fit_rows)
    if picked is None:
        return None
    places = picked.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    shares = with_shares(lexical(places), labelled).select("url", "label", "weight", *FEATURES)
    order = (F.xxhash64("url"), F.col("url"), F.col("label"))
    sample = stored(shares.orderBy(*order).coalesce(1), "url-sample").coalesce(1)
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(sample)
    trees = GBTClassifier(labelCol="label", featuresCol="features", weightCol="weight", maxIter=TREES, maxDepth=DEPTH,
                          seed=SEED, cacheNodeIds=False)
    return trees.fit(vectors.select("label", "features", "weight"))


def filter_urls(pages: DataFrame, labelled: DataFrame | None = None, rules: tuple[Rule, ...] = RULES,
                fit_rows: int = FIT_ROWS, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule and verdict; one row for each row of ``pages``.

    ``labelled`` has columns url and label (1 is blocked). Without it the urls that a rule
    judges are the labelled ones. A null url, or one without ``://``, has empty host and
    path and is judged by the trees; null labels are left out; null and repeated ids stay.
    With labels of one kind only, that kind's verdict holds for the rest, without any,
    ``allow``. Other columns are not read; an empty table gives no row.
    """
    url = F.col(url_col).cast("string")
    base = pages.select(F.col(id_col).cast("long").alias("page_id"), url.alias("url"),
                        host_of(url).alias("host"), path_of(url).alias("path"))
    judged = lexical(with_rules(base, rules))
    if labelled is None:
        known = judged.filter("ruled is not null").withColumn("label", (F.col("ruled") == "block").cast("double"))
    else:
        given = labelled.select(F.col("url").cast("string").alias("url"), F.col("label").cast("double").alias("label"))
        places = given.dropna().withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
        known = lexical(places)
    model = fit(known, fit_rows)
    if model is None:
        kind = known.select(F.max("label")).first()[0]
        return judged.select("page_id", "host", "path", "rule", F.coalesce(
            F.col("ruled"), F.lit("block" if kind else "allow")).alias("verdict"))
    features = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    scored = model.transform(features.transform(with_shares(judged, known)))
    verdict = F.when(F.col("prediction") == 1, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("ruled", verdict).alias("verdict"))
