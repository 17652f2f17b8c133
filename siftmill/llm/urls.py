"""URL filters: host and path rules, and gradient-boosted trees on lexical features for URLs without a rule."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftmill.llm.common import LOWER, UPPER, staged, table

#: (verdict, host, path)
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
#: Labelled URLs used for fitting, at most.
SAMPLE, TREES, DEPTH, SEED, FOLDS = 20_000, 12, 4, 7, 5
LEXICAL = ("n", "host_n", "path_n", "depth", "labels", "digits", "entropy", "params", "query_n", "hyphens", "fragment", "secure", "suffix_seen", "suffix_blocked")


def host_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def first_rule(rules, host: Column, path: Column) -> tuple[Column, Column]:
    """Rule string and verdict of the longest rule that fits; null without one. Of equally long rules the first counts."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(reversed(list(rules)), key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | F.endswith(host, F.lit(f".{h}"))) & F.startswith(path, F.lit(p))
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def lexical(df: DataFrame) -> DataFrame:
    """Adds the features that a URL has of itself, and ``suffix`` (the host's last label)."""
    u, host, path = F.coalesce(F.col("url"), F.lit("")), F.col("host"), F.col("path")
    n = F.length(u)
    query = F.regexp_extract(u, r"\?([^#]*)", 1)
    signs = F.filter(F.split(u, ""), lambda c: c != "")
    part = lambda c: (n - F.length(F.replace(u, c, F.lit("")))) / n
    return df.withColumns({
        "n": n.cast("double"), "host_n": F.length(host).cast("double"), "path_n": F.length(path).cast("double"),
        "depth": F.regexp_count(path, F.lit("[^/]+")).cast("double"), "labels": F.regexp_count(host, F.lit("[^.]+")).cast("double"),
        "digits": F.when(n > 0, F.regexp_count(u, F.lit("[0-9]")) / n).otherwise(0.0),
        "entropy": F.aggregate(F.transform(F.array_distinct(signs), part), F.lit(0.0), lambda a, p: a - p * F.log2(p)),
        "params": F.when(query == "", 0).otherwise(F.regexp_count(query, F.lit("[^&]+"))).cast("double"), "query_n": F.length(query).cast("double"),
        "hyphens": F.regexp_count(u, F.lit("-")).cast("double"), "fragment": F.contains(u, F.lit("#")).cast("double"), "secure": F.startswith(F.lower(u), F.lit("https")).cast("double"),
        "suffix": F.regexp_extract(host, r"([^.]*)$", 1),
    })


def labelled(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """The pages with host, path, rule, verdict (null without a rule), their lexical features and ``fold`` (by a hash of the URL)."""
    host, path = host_path(F.col(url_col))
    parts = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), host.alias("host"), path.alias("path"))
    rule, verdict = first_rule(rules, F.col("host"), F.col("path"))
    return lexical(parts.select("*", rule.alias("rule"), verdict.alias("verdict"))).withColumn("fold", F.pmod(F.xxhash64("url"), F.lit(FOLDS)).cast("int"))


def suffix_counts(known: DataFrame, sample: int) -> tuple[DataFrame, float]:
    """Labelled URLs by suffix, all and by fold, with those blocked; and the share blocked of all."""
    blocked = F.col("verdict") == "block"
    by_fold = [F.array(*[F.count_if((F.col("fold") == i) & c) for i in range(FOLDS)]) for c in (F.lit(True), blocked)]
    counts = known.where("rule IS NOT NULL").groupBy("suffix").agg(F.count(F.lit(1)).alias("n_all"), F.count_if(blocked).alias("blocks"), by_fold[0].alias("n_by"), by_fold[1].alias("blocks_by"))
    counts, total = staged(counts, F.count(F.lit(1)).alias("suffixes"), F.sum("n_all").alias("n"), F.sum("blocks").alias("blocks"))
    return F.broadcast(counts) if total["suffixes"] <= sample else counts, total["blocks"] / total["n"]


def with_suffix(df: DataFrame, counts: DataFrame, base: float, own_fold: bool) -> DataFrame:
    """The features as a vector. Rows that train (not ``own_fold``) get their suffix's blocked share without their own fold's
    URLs, so that no label enters its own features."""
    less = lambda c: F.col(c) if own_fold else F.col(c) - F.element_at(F.col("n_by" if c == "n_all" else "blocks_by"), F.col("fold") + 1)
    df = df.join(counts, "suffix", "left").withColumns({"suffix_seen": F.coalesce(F.log1p("n_all"), F.lit(0.0)), "suffix_blocked": F.coalesce((less("blocks") + 10 * base) / (less("n_all") + 10), F.lit(base))})
    return VectorAssembler(inputCols=list(LEXICAL), outputCol="features").transform(df)


def trees(rows: DataFrame):
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED, cacheNodeIds=False).fit(rows.select("features", "label"))
    return model.setPredictionCol("blocked")


def held_out_accuracy(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, sample: int = SAMPLE) -> tuple[float, float]:
    """The trees' share of right verdicts on labelled URLs of fold 0 when fitted on at most ``sample`` of the other folds, and the share
    of the commoner verdict. Suffix figures of fold 0 leave fold 0 out."""
    known = labelled(pages, id_col, url_col, rules).withColumn("label", (F.col("verdict") == "block").cast("double"))
    counts, base = suffix_counts(known.where("fold > 0"), sample)
    chosen = staged(known.where("rule IS NOT NULL AND fold > 0").orderBy(F.xxhash64("url"), "url", "page_id").limit(sample))
    said = trees(with_suffix(chosen, counts, base, False)).transform(with_suffix(known.where("rule IS NOT NULL AND fold = 0"), counts, base, True))
    r = said.agg(F.avg((F.col("blocked") == F.col("label")).cast("double")).alias("right"), F.avg("label").alias("blocked")).first()
    return r["right"], max(r["blocked"], 1 - r["blocked"])


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, sample: int = SAMPLE) -> DataFrame:
    """One row per row of ``pages``: ``page_id, host, path, rule, verdict``.

    URLs that a rule fits are the labelled ones: they get its verdict, and at most ``sample`` of them (of least hash)
    train the trees, which judge the others. Without labels of both kinds every other URL gets the one label there is,
    or ``allow``. Null URLs and those without ``://`` have empty host and path, and are judged by the trees. Rows
    repeated, or with null ids, are judged each; an empty table gives no rows; other columns are not read.
    Suffixes are counted over all labelled URLs; a row that trains sees the blocked share of the folds that it is not in. Only
    the sample and these counts are shuffled, and the join where there are more than ``sample`` suffixes."""
    known = labelled(pages, id_col, url_col, rules)
    chosen = known.where("rule IS NOT NULL").orderBy(F.xxhash64("url"), "url", "page_id").limit(sample)
    chosen = staged(chosen.withColumn("label", (F.col("verdict") == "block").cast("double")))
    classes = {r["label"]: r["n"] for r in chosen.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(classes) < 2:
        only = "block" if 1.0 in classes else "allow"
        return known.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(only)).alias("verdict"))
    counts, base = suffix_counts(known, sample)
    model = trees(with_suffix(chosen, counts, base, False))
    said = F.when(F.col("blocked") == 1, "block").otherwise("allow")
    return model.transform(with_suffix(known, counts, base, True)).select("page_id", "host", "path", "rule", F.coalesce("verdict", said).alias("verdict"))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))
