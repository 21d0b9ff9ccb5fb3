"""URL filter: rules, and a character language-model ratio for the URLs without a rule.

Two smoothed variable-order Markov models of characters are trained, one on the URLs that
rules accept, one on those that rules reject. The probability of a character mixes the
counts after its last 4, 3, 2, 1 and 0 characters, the longer context first, each smoothed
towards the next shorter one. A URL is judged by the mean log-likelihood difference per
character.

The models are exact tables of n-grams that grow with the input: runs of five characters are
counted by a shuffle, and the shorter contexts from those counts. What a character adds to a
URL depends on its run of five alone, so every different run is scored once and the scores are
joined back to the URLs and summed. The threshold is calibrated on a fold of the accepted and
rejected URLs, by models trained without that fold; different URLs count once.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobloom.llm.common import prepare, table
from jobloom.session import stage

ORDER = 4
SMOOTHING = 4.0
CHARACTERS = 256  # that an unknown one is thought to be one of
LEAST_CHARACTERS = 3
FOLDS, CALIBRATION_FOLD = 5, 0
SCORE_BINS = 2000
SCORE_LIMIT = 5.0
_START = "\x01" * ORDER
# accepted and rejected rows, of all folds and without the calibration fold
_SIDES = ("allow_all", "block_all", "allow_fit", "block_fit")

# Fixed values: (verdict, host, path).
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def host_of(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    raw = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(raw, upper, upper.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest fitting rule, as a struct (rule, verdict); null if none fits."""
    longest = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, name, start in reversed(longest):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        answer = F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, answer).otherwise(found)
    return found


def grams_of(text: Column) -> Column:
    """The runs of ORDER + 1 characters that end in each character of the text, A-Z
    lower-cased, every digit alike, with a start mark before it."""
    plain = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", "abcdefghijklmnopqrstuvwxyz" + "0" * 9)
    run = f"(?s)(?=(.{{{ORDER + 1}}}))"
    return F.regexp_extract_all(F.concat(F.lit(_START), plain), F.lit(run), F.lit(1))


def _by_order(grams: DataFrame, *columns: str) -> DataFrame:
    """Each run once for every order: its context of so many characters, and the next one."""
    orders = F.explode(F.sequence(F.lit(0), F.lit(ORDER))).alias("order")
    return grams.select("gram", *columns, orders).select(
        *columns, "order",
        F.substr("gram", F.lit(ORDER + 1) - F.col("order"), F.col("order")).alias("context"),
        F.substr("gram", F.lit(ORDER + 1)).alias("next"),
    )


def gram_counts(ruled: DataFrame) -> DataFrame:
    """(gram, *_SIDES) of different URLs (grams, verdict, fold)."""
    sums = []
    for name in _SIDES:
        verdict, part = name.split("_")
        counted = F.col("verdict") == verdict
        if part == "fit":
            counted &= F.col("fold") != CALIBRATION_FOLD
        sums.append(F.count_if(counted).alias(name))
    return ruled.select("verdict", "fold", F.explode("grams").alias("gram")).groupBy("gram").agg(*sums)


def context_counts(grams: DataFrame, counts: DataFrame) -> DataFrame:
    """(order, context, next, *_SIDES, of_*): what ``counts`` has of the character after its context,
    and of the context, for every order of the runs in ``grams``."""
    none = (F.lit(0).cast("bigint").alias(s) for s in _SIDES)
    runs = counts.select("gram", *_SIDES, F.lit(False).alias("wanted")).unionByName(
        grams.select("gram", *none, F.lit(True).alias("wanted"))
    )
    each = (
        _by_order(runs, *_SIDES, "wanted").groupBy("order", "context", "next")
        .agg(*(F.sum(s).alias(s) for s in _SIDES), F.max("wanted").alias("wanted"))
    )
    # A context has one row for each character that follows it.
    context = Window.partitionBy("order", "context")
    return each.select("*", *(F.sum(s).over(context).alias(f"of_{s}") for s in _SIDES)).where("wanted").drop("wanted")


def gram_scores(grams: DataFrame, counts: DataFrame) -> DataFrame:
    """(gram, score_all, score_fit): the log-likelihood difference of the last character of each
    run, accepted minus rejected.

    Each order is joined with what the next shorter one gave for all but the first character, so a
    key has no more rows than there are characters. No join of this module is a broadcast: the size
    of a table's files says little about its rows, and the driver would hold them.
    """
    known = stage(context_counts(grams, counts), "contexts")
    chances = None
    for order in range(ORDER + 1):
        own = known.where(F.col("order") == order).withColumn("gram", F.concat("context", "next"))
        shorter = dict.fromkeys(_SIDES, F.lit(1.0 / CHARACTERS))
        if chances is not None:
            ends = chances.select(F.col("gram").alias("ending"), *(F.col(s).alias(f"shorter_{s}") for s in _SIDES))
            own = own.withColumn("ending", F.substr("gram", F.lit(2))).join(ends.hint("merge"), "ending")
            shorter = {s: F.col(f"shorter_{s}") for s in _SIDES}
        chances = own.select("gram", *(
            ((F.col(s) + SMOOTHING * shorter[s]) / (F.col(f"of_{s}") + SMOOTHING)).alias(s) for s in _SIDES
        ))
    scores = (
        (F.log(f"allow_{part}") - F.log(f"block_{part}")).alias(f"score_{part}") for part in ("all", "fit")
    )
    return chances.select("gram", *scores)


def url_scores(urls: DataFrame, counts: DataFrame) -> DataFrame:
    """(url_text, score_all, score_fit) of different URLs (url_text, grams): means per character."""
    each = urls.select("url_text", F.explode("grams").alias("gram"))
    # Sums in whole numbers do not depend on the order of rows.
    unit = 1 << 40
    names = ("score_all", "score_fit")
    units = (F.round(F.col(name) * unit).cast("decimal(18,0)").alias(name) for name in names)
    # A table, so that Spark can split the rows of a run that very many URLs have.
    scored = stage(gram_scores(each.select("gram").distinct(), counts).select("gram", *units), "gram-scores")
    means = ((F.sum(name).cast("double") / F.count(F.lit(1)) / unit).alias(name) for name in names)
    return each.join(scored.hint("merge"), "gram").groupBy("url_text").agg(*means)


def threshold_of(scored: DataFrame) -> float:
    """The middle of the scores that part the two sides with the least summed error rates, from
    rows (verdict, score); 0 if a side has none. At most 2 * (SCORE_BINS + 1) counts come here."""
    clipped = F.greatest(F.least("score", F.lit(SCORE_LIMIT)), F.lit(-SCORE_LIMIT))
    bins = (
        scored.select(
            (F.col("verdict") == "allow").cast("int").alias("side"),
            F.floor((clipped + SCORE_LIMIT) * (SCORE_BINS / (2 * SCORE_LIMIT))).cast("int").alias("bin"),
        )
        .groupBy("side", "bin").count().collect()
    )
    histogram = np.zeros((2, SCORE_BINS + 1))
    for row in bins:
        histogram[row.side, row.bin] += row["count"]
    if not histogram.sum(axis=1).all():
        return 0.0
    share = histogram / histogram.sum(axis=1, keepdims=True)
    # Error at a threshold below bin b: accepted in bins under b, rejected from b on.
    errors = np.concatenate(([0], np.cumsum(share[1]))) + 1 - np.concatenate(([0], np.cumsum(share[0])))
    best = np.flatnonzero(errors <= errors.min() + 1e-12)
    return float((best[0] + best[-1]) / 2 * 2 * SCORE_LIMIT / SCORE_BINS - SCORE_LIMIT)


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, score.

    ``pages`` needs page_id and url; other columns are not read. A null url and one without
    ``://`` have empty host and path. Without a rule the models decide on host and path: a
    score at the threshold or above is allowed; texts of fewer than LEAST_CHARACTERS
    characters are blocked, and if rules accept or reject nothing at all there is nothing to
    learn from and the rest is allowed. score is null where a rule decides. Repeated rows are
    judged alike; an empty table gives no rows.
    """
    spark = pages.sparkSession
    prepare(spark)
    parts = pages.select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    ruled = parts.withColumn("found", rule_of(F.col("host"), F.col("path"), rules)).select(
        "page_id", "host", "path", "found.rule", "found.verdict",
        F.concat("host", "path").alias("url_text"),
    )
    urls = stage(
        ruled.groupBy("url_text").agg(F.first("verdict").alias("verdict")).select(
            "url_text", "verdict", grams_of(F.col("url_text")).alias("grams"),
            (F.crc32(F.col("url_text").cast("binary")) % FOLDS).alias("fold"),
        ),
        "urls",
    )
    counts = stage(gram_counts(urls.where("verdict IS NOT NULL")), "url-grams")
    scored = stage(
        url_scores(urls.where(F.col("verdict").isNull() | (F.col("fold") == CALIBRATION_FOLD)), counts), "url-scores"
    )
    sides = counts.agg(F.max("allow_all"), F.max("block_all")).first()
    calibration = urls.where(F.col("verdict").isNotNull()).select("url_text", "verdict").join(scored.hint("merge"), "url_text")
    threshold = threshold_of(calibration.select("verdict", F.col("score_fit").alias("score")))
    short = F.length("url_text") < LEAST_CHARACTERS
    learned = (
        F.when(short, "block").when(F.col("score") >= threshold, "allow").otherwise("block")
        if all(sides)
        else F.when(short, "block").otherwise("allow")
    )
    score = F.when(F.col("rule").isNull() & F.lit(all(sides)), F.col("score_all"))
    return ruled.join(scored.hint("merge"), "url_text", "left").withColumn("score", score).select(
        "page_id", "host", "path", "rule",
        F.coalesce("verdict", learned).alias("verdict"), "score",
    )


def op6_url_model(spark, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))
