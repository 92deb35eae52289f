"""URL filter: rules first, then a ratio of character language models.  DataFrame functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, discard, join_hot, settle

#: (verdict, rule); a rule is host/path and fits the host and its subdomains.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: Characters of context at most.
ORDER = 4
#: Scores are calibrated in steps of 1/BINS nats a character.
BINS = 200
#: One character out of this many, where nothing is known.
ALPHABET = 256


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, or null.  ``rules`` is a short configured list."""
    out = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: len(r[1])):
        h, _, p = rule.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def _grams(url: Column) -> Column:
    """For each character and the end mark, it and the ORDER characters before it, in one linear pass."""
    padded = F.concat(F.lit("\x02" * ORDER), F.lower(url), F.lit("\x03"))
    return F.regexp_extract_all(padded, F.lit(f"(?s)(?=(.{{{ORDER + 1}}}))"), F.lit(1))


def gram_scores(grams: DataFrame) -> DataFrame:
    """``gram, llr`` for each row of ``grams(gram, accepted, rejected)``.

    Each class has an interpolated Witten-Bell model: at every order the estimate is
    ``(n(context, c) + types(context) * lower) / (n(context) + types(context))``, and a
    context that the class never showed leaves the shorter context's estimate as it is.
    The shorter contexts' counts are sums of the longest ones', so the text is read once.
    """
    out = grams.select("gram").withColumns({"pa": F.lit(1.0 / ALPHABET), "pr": F.lit(1.0 / ALPHABET)})
    for k in range(ORDER + 1):
        cut = F.substring("gram", ORDER + 1 - k, k + 1)
        own = grams.groupBy(cut.alias("g")).agg(F.sum("accepted").alias("a"), F.sum("rejected").alias("r"))
        ctx = own.groupBy(F.substring("g", 1, k).alias("ctx")).agg(
            F.sum("a").alias("na"), F.sum("r").alias("nr"), F.count_if(F.col("a") > 0).alias("ta"), F.count_if(F.col("r") > 0).alias("tr")
        )
        level = own.withColumn("ctx", F.substring("g", 1, k)).join(ctx, "ctx").drop("ctx")
        if k < 2:  # few keys, that many grams share
            level = settle(level)
            level = F.broadcast(level) if level.count() < BROADCAST_ROWS else level
        p = lambda n, total, types, lower: F.when(F.col(total) > 0, (F.col(n) + F.col(types) * F.col(lower)) / (F.col(total) + F.col(types))).otherwise(F.col(lower))
        out = out.withColumn("g", cut).join(level, "g").select("gram", p("a", "na", "ta", "pa").alias("pa"), p("r", "nr", "tr", "pr").alias("pr"))
    return out.select("gram", (F.log("pr") - F.log("pa")).alias("llr"))


def _threshold(scored: DataFrame) -> float:
    """The score that parts the calibration URLs best (most balanced accuracy); one row a bin comes to the driver, 10 * BINS + 1 rows at most."""
    bins = scored.groupBy(F.round(F.least(F.greatest("score", F.lit(-5.0)), F.lit(5.0)) * BINS).cast("int").alias("b")).agg(
        F.sum(F.when(F.col("label") == "allow", F.col("n")).otherwise(0)).alias("a"), F.sum(F.when(F.col("label") == "block", F.col("n")).otherwise(0)).alias("r")
    )
    rows = sorted((x["b"], x["a"], x["r"]) for x in bins.collect())
    good, bad = sum(x[1] for x in rows), sum(x[2] for x in rows)
    if not good or not bad:
        return float("inf")
    best, at, a, r = -1.0, 0.0, 0, 0
    for k, (b, x, y) in enumerate(rows):
        a, r = a + x, r + y
        if (value := a / good + 1 - r / bad) > best:
            best, at = value, (b + (rows[k + 1][0] if k + 1 < len(rows) else b + 2)) / 2 / BINS
    return at


def judge_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` for each row of ``pages(page_id, url)``.

    URLs that a rule decides train the two models (four in five of them, by hash) and
    calibrate the threshold (the fifth); the models decide the others.  The score is the
    mean of ln P(rejected) - ln P(accepted) over the URL's characters.  A null or empty
    URL has the score 0 and, like every URL where a class has no example, is allowed.
    URLs may be of any length; repeated rows are judged alike, an empty table gives an empty
    one; other columns, whatever their names, are not read.
    """
    src = pages.select("page_id", F.col("url").cast("string").alias("url")).withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    src = src.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    by_rule = reduce(lambda out, r: F.when(F.col("rule") == r[1], F.lit(r[0])).otherwise(out), rules, F.lit(None).cast("string"))
    src = src.withColumn("label", by_rule)
    urls = settle(src.where("url <> ''").groupBy("url").agg(F.first("label").alias("label"), F.count("*").alias("n")))
    rows = urls.withColumn("held", F.pmod(F.xxhash64("url"), F.lit(5)) == 0).select("url", "label", "n", "held", F.explode(_grams(F.col("url"))).alias("gram"))
    weigh = lambda label: F.sum(F.when((F.col("label") == label) & ~F.col("held"), F.col("n")).otherwise(0))
    grams = settle(rows.groupBy("gram").agg(weigh("allow").alias("accepted"), weigh("block").alias("rejected"), F.count("*").alias("rows")))
    llr = settle(gram_scores(grams.drop("rows")))
    # Grams that many URLs share (``http://`` is in all) are hot.
    total = grams.agg(F.sum("rows")).first()[0] or 0
    sums = join_hot(rows, llr.join(grams.select("gram", F.col("rows").alias("_rows")), "gram"), ["gram"], total, "_rows")
    scored = settle(sums.groupBy("url", "label", "n", "held").agg(F.avg("llr").alias("score")))
    cut = _threshold(scored.where("held and label is not null"))
    out = src.join(scored.select("url", "score"), "url", "left").withColumn("score", F.coalesce("score", F.lit(0.0)))
    discard(urls, grams, llr)
    verdict = F.coalesce(F.col("label"), F.when(F.col("score") > F.lit(cut), F.lit("block")).otherwise(F.lit("allow")))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")


def op10_url_filter(spark, sf_dir: str) -> DataFrame:
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))
