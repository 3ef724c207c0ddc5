"""URL filters: host rules first, gradient-boosted trees on lexical features for the rest.

DataFrame functions and Spark's own trees only.  The trees learn from labelled URLs:
those that a rule decides, or any table of labels.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webgrove.llm.common import let, stored

#: Rules of the contract: verdict, host, path.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
#: Labelled URLs the trees are fitted on (those with the smallest hashes).
TRAINING_ROWS = 20_000
#: A labelled URL's suffix share leaves out its host's fold, so that no host vouches for itself.
FOLDS = 5
TREES, DEPTH, SEED = 8, 3, 7
#: Added to both sides of a suffix's share of blocked URLs.
PRIOR = 1.0
FEATURES = ("f_length", "f_host_length", "f_depth", "f_labels", "f_digits", "f_entropy", "f_parameters", "f_dashes", "f_fragment", "f_secure", "f_suffix", "f_suffix_known")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case (A-Z) and path up to the query; empty without ``://``."""
    text = F.coalesce(url, F.lit(""))
    has = F.instr(text, "://") > 0
    rest = F.when(has, F.substring(text, F.instr(text, "://") + 3, F.length(text))).otherwise(F.lit(""))
    end = F.regexp_replace(rest, r"(?s)[/?#].*", "")
    path = F.regexp_replace(F.substring(rest, F.length(end) + 1, F.length(rest)), r"(?s)[?#].*", "")
    return F.translate(end, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule as ``host + path``, and its verdict; nulls where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, domain, start in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):      # the longest is asked first
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(start)
        name = F.when(fits, domain + start).otherwise(name)
        verdict = F.when(fits, kind).otherwise(verdict)
    return name, verdict


def _entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits; zero for an empty text."""
    def of(chars: Column) -> Column:
        size = F.size(chars).cast("double")
        return F.aggregate(F.array_distinct(chars), F.lit(0.0), lambda a, c: a - let(
            F.size(F.filter(chars, lambda x: x == c)) / size, lambda p: p * F.log2(p)))
    return F.when(F.length(text) == 0, F.lit(0.0)).otherwise(let(F.split(text, ""), of))


def lexical(pages: DataFrame) -> DataFrame:
    """``pages`` with ``host, path, suffix`` and the lexical features."""
    url = F.coalesce("url", F.lit(""))
    host, path = host_and_path(F.col("url"))
    query = F.regexp_extract(url, r"(?s)[?]([^#]*)", 1)
    count = lambda text, pattern: F.regexp_count(text, F.lit(pattern)).cast("double")
    return (pages.withColumns({"host": host, "path": path})
            .withColumns({
                "suffix": F.regexp_extract("host", r"([^.]*)$", 1), "fold": F.pmod(F.xxhash64("host"), F.lit(FOLDS)),
                "f_length": F.length(url).cast("double"), "f_host_length": F.length("host").cast("double"), "f_depth": count(F.col("path"), "/"),
                "f_labels": count(F.col("host"), "[.]"), "f_digits": count(url, "[0-9]") / F.greatest(F.length(url), F.lit(1)), "f_entropy": _entropy(url),
                "f_parameters": F.when(query == "", F.lit(0.0)).otherwise(count(query, "&") + 1), "f_dashes": count(url, "[-_]"),
                "f_fragment": F.instr(url, "#").cast("boolean").cast("double"), "f_secure": url.startswith("https://").cast("double")}))


def suffix_statistics(labelled: DataFrame) -> DataFrame:
    """``_suffix, _n, _blocked, _folds``: labelled and blocked URLs of every suffix, in all and by fold of the host."""
    by_fold = labelled.groupBy("suffix", "fold").agg(F.count("*").alias("n"), F.sum("label").alias("blocked"))
    folds = F.map_from_entries(F.collect_list(F.struct("fold", F.struct("n", "blocked"))))     # at most FOLDS entries
    return by_fold.groupBy(F.col("suffix").alias("_suffix")).agg(F.sum("n").alias("_n"), F.sum("blocked").alias("_blocked"), folds.alias("_folds"))


def with_suffix(urls: DataFrame, statistics: DataFrame, *, held_out: bool = False) -> DataFrame:
    """``f_suffix``, the smoothed share of blocked URLs of the suffix, and ``f_suffix_known``.

    With ``held_out`` the share leaves out the fold of the row's host.
    """
    own = F.try_element_at("_folds", "fold") if held_out else F.lit(None).cast("struct<n:bigint,blocked:double>")
    n, blocked = (F.col(name) - F.coalesce(own[name.strip("_")], F.lit(0)) for name in ("_n", "_blocked"))
    known = F.coalesce(n > 0, F.lit(False))
    return (urls.join(statistics, F.col("suffix") == F.col("_suffix"), "left")
            .withColumns({"f_suffix": F.when(known, (blocked + PRIOR) / (n + 2 * PRIOR)).otherwise(0.5), "f_suffix_known": known.cast("double")})
            .drop(*statistics.columns))


def _assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="_features")


def fit_trees(labelled: DataFrame) -> GBTClassificationModel:
    """Boosted trees on rows with the features and ``label`` (1.0: block)."""
    return GBTClassifier(featuresCol="_features", labelCol="label", maxIter=TREES, maxDepth=DEPTH, maxBins=32, seed=SEED).fit(_assembler().transform(labelled))


def filter_urls(pages: DataFrame, labels: DataFrame | None = None, *, rules=RULES, training_rows: int = TRAINING_ROWS, threshold: float = 0.5) -> DataFrame:
    """``page_id, host, path, rule, verdict, blocked_score``, a row per page.

    A rule's verdict stands.  Other URLs are judged by trees that learn from ``labels``
    (``url, label``; 1 is block, 0 allow, null nothing; others raise), or from the URLs rules
    decide where it is not given; ``blocked_score`` is their probability, null where a rule
    decides.  Suffix shares count every labelled URL; the trees are fitted on at most
    ``training_rows`` of them.  A rule names suffixes, so of the URLs that rules decide only
    those of suffixes with both verdicts teach the trees, where there are any: the others would
    only teach the rule's own condition.  If the labels show one class or none, that class
    (or ``allow``) is the verdict.  Null URLs and URLs without ``://`` have empty hosts and
    paths and are judged by the trees.  Repeated rows are judged each.  Only ``page_id`` and
    ``url`` are read, and ``url`` and ``label`` of the labels.
    """
    plain = lexical(pages.select("page_id", "url"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    plain = plain.withColumns({"rule": name, "_by_rule": verdict})
    if labels is None:
        known = plain.where("_by_rule is not null").withColumn("label", (F.col("_by_rule") == "block").cast("double"))
    else:
        known = lexical(labels.select("url", F.col("label").cast("double").alias("label"))).where("label is not null")
        if known.where("label not in (0, 1)").limit(1).count():
            raise ValueError("labels are 1 (block), 0 (allow) or null")
    statistics = stored(suffix_statistics(known), "suffixes")
    if labels is None:
        both = statistics.where("_blocked > 0 and _blocked < _n")
        if both.limit(1).count():
            statistics = both
            known = known.join(both.select("_suffix"), F.col("suffix") == F.col("_suffix"), "left_semi")
    sample = stored(known.orderBy(F.xxhash64("url"), "url").limit(training_rows).select("url", "suffix", "fold", "label", *FEATURES[:10]), "labelled")
    classes = sorted(r["label"] for r in sample.groupBy("label").count().collect())
    if len(classes) == 2:
        model = fit_trees(with_suffix(sample, statistics, held_out=True))
        scored = model.transform(_assembler().transform(with_suffix(plain, statistics))).withColumn("_score", vector_to_array("probability")[1])
    else:
        scored = plain.withColumn("_score", F.lit(classes[0] if classes else 0.0))
    judged = F.when(F.col("_score") >= threshold, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("_by_rule", judged).alias("verdict"),
                         F.when(F.col("_by_rule").isNull(), F.col("_score")).alias("blocked_score"))
