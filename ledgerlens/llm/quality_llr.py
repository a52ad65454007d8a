"""Quality rules and a hashed n-gram log-likelihood ratio, in DataFrame functions only.

Every text's words and word pairs are hashed into ``BUCKETS`` buckets.  The raw
multinomial counts the buckets of all texts; the target one those of all
trusted texts (labelled good and not toxic).  A text's score is the
mean over its n-grams of log(target share / raw share); it is kept if it passes
the base rules and the score reaches the threshold.  The target's shares are
smoothed towards the raw ones with a weight of ``PRIOR_SHARE`` of its n-grams:
a corpus copied any number of times gives the same ratios.

The threshold comes from labelled texts that the target doesn't hold (every
``FOLDS``-th by id hash): half way between the score that all but
``GOOD_LOST`` of the good ones reach and the median of the bad ones, or the
former if that is less.  All held-out texts count, by their score in whole
micro-units: few values, however many the texts.  Without held-out texts of both
classes nothing is rejected, and so with no trusted text.

Texts meet the labels without a shuffle: the marked ids go to all tasks as bits,
64 ids a row (``with_marks``).

The log ratios are rounded to whole micro-units: sums do not depend on the
order of rows, and neither does any decision.  The model is one integer per
bucket, bounded whatever the corpus; it is the only thing that reaches the
driver.  Texts are scored where they are read, with no shuffle.

Defined cases: a null or empty text has no words, score 0, and fails the base
rules; repeated rows are judged alike; a null doc_id stays null and is never
trusted; of several labels of an id one bad label is enough to distrust it;
extra columns pass through ``judge`` untouched; no rows give no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import SPACE_RUN, text_of

BUCKETS = 1 << 16
#: Weight of the raw shares in the target's, as a share of the target's n-grams.
PRIOR_SHARE = 0.05
MICRO = 1_000_000
#: Share of the held-out good texts that may fall below the threshold's upper bound,
#: and the part of the labels that is held out.
GOOD_LOST = 0.005
FOLDS = 5
#: Rows of 64 ids' marks up to which they go to all tasks, some 32 MB; beyond, Spark picks the join.
MARK_ROWS = 1_000_000
WINDOW = 5
MIN_WORDS, MAX_REPEAT_PCT = 10, 20
SYMBOLS = r"[#*$%&|<>]"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE_RUN), "")


def _hashes(words: Column, n: Column) -> Column:
    """The hash of every word, and of every pair of neighbours."""
    return F.when(
        n > 1,
        F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.xxhash64(F.get(words, i - 1), F.get(words, i))),
    ).otherwise(F.array().cast("array<bigint>"))


def _with_words(docs: DataFrame, carried: list[Column]) -> DataFrame:
    rows = docs.select(*carried, text_of().alias("text"))
    return rows.select(
        *[c for c in rows.columns if c != "text"], "text", words_of(F.col("text")).alias("words")
    )


def _with_hashes(rows: DataFrame) -> DataFrame:
    """Adds ``n``, the word hashes ``wh`` and all n-gram hashes ``grams``."""
    hashed = rows.withColumn("n", F.size("words")).withColumn(
        "wh", F.transform("words", lambda w: F.xxhash64(w))
    )
    return hashed.withColumn("grams", F.concat("wh", _hashes(F.col("wh"), F.col("n"))))


def held_out() -> Column:
    """Labelled rows that set the threshold and never enter the target."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % FOLDS == 0


def training(labels: DataFrame) -> DataFrame:
    return labels.where(~held_out())


def trusted_ids(labels: DataFrame) -> DataFrame:
    """``doc_id`` of the trusted texts, each once."""
    return (
        labels.where("doc_id is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
        .where("quality = 1 and coalesce(toxic, 0) = 0")
        .select("doc_id")
    )


def with_marks(rows: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """``rows`` (with ``doc_id``, a long) given the ``mark`` of their id, 0 or 1; ``ids`` has ``doc_id, mark``, an id once.

    Rows of other ids have none, or go with an inner join.
    """
    bit = F.expr("shiftleft(1L, cast(doc_id & 63 as int))")
    marks = ids.groupBy(F.shiftright("doc_id", 6).alias("_ids")).agg(
        F.bit_or(bit).alias("_marked"), F.bit_or(F.when(F.col("mark") == 1, bit).otherwise(0)).alias("_ones")
    )
    marks = F.broadcast(marks) if marks.count() <= MARK_ROWS else marks
    met = rows.join(marks, F.shiftright("doc_id", 6) == F.col("_ids"), how)
    marked = F.col("_marked").bitwiseAND(bit) != 0
    mark = F.when(marked, (F.col("_ones").bitwiseAND(bit) != 0).cast("int"))
    found = met.where(marked) if how == "inner" else met
    return found.select(*rows.columns, mark.alias("mark"))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    buckets: int = BUCKETS,
    prior: float | None = None,
    prior_share: float = PRIOR_SHARE,
) -> list[int]:
    """The log ratio of every bucket in micro-units, over all rows of ``docs``.

    The smoothing weighs ``prior`` n-grams, or by default ``prior_share`` of the target's.
    """
    rows = _with_words(docs, [F.col("doc_id").cast("long").alias("doc_id")])
    # explode_outer: explode would have Catalyst compute the array once more in a filter below
    grams = with_marks(_with_hashes(rows), trusted_ids(labels).withColumn("mark", F.lit(1)), "left").select(
        F.explode_outer("grams").alias("h"), F.coalesce("mark", F.lit(0)).alias("trusted")
    )
    counts = grams.where("h is not null").groupBy(F.pmod("h", F.lit(buckets)).alias("bucket")).agg(
        F.count("*").alias("raw"), F.sum("trusted").alias("target")
    )
    found = counts.collect()  # one row per bucket at most
    spark = docs.sparkSession
    raw_all, target_all = sum(r["raw"] for r in found), sum(r["target"] for r in found)
    model = [0] * buckets
    prior = prior_share * target_all if prior is None else prior
    if target_all:
        ratios = spark.createDataFrame(found, counts.schema).select(
            "bucket",
            F.round(
                F.log((F.col("target") + prior * F.col("raw") / raw_all) / (target_all + prior) / (F.col("raw") / raw_all))
                * MICRO
            ).cast("long").alias("ratio"),
        )
        for r in ratios.collect():
            model[r["bucket"]] = r["ratio"]
    return model


def _literal(model: list[int]) -> Column:
    """The model as one constant array."""
    return F.split(F.lit(",".join(map(str, model))), ",").cast("array<int>")


def _repeat_words(n: Column, hashes: Column) -> Column:
    """Words in windows of five that the text holds twice or more.

    The windows' hashes are sorted with their places; those equal to a
    neighbour are repeats, and each repeat covers its five words up to the next.
    """
    starts = F.transform(
        F.filter(
            F.transform(
                hashes,
                lambda s, i: F.when(
                    (s["h"] == F.get(hashes, i - 1)["h"]) | (s["h"] == F.get(hashes, i + 1)["h"]), s["p"]
                ),
            ),
            lambda p: p.isNotNull(),
        ),
        lambda p: p,
    )
    return F.aggregate(
        F.array_sort(starts),
        F.struct(F.lit(0).alias("covered"), F.lit(-WINDOW).alias("last")),
        lambda acc, p: F.struct(
            (acc["covered"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("covered"), p.alias("last")
        ),
        lambda acc: acc["covered"],
    )


def calibrate(docs: DataFrame, labels: DataFrame, model: list[int]) -> int | None:
    """The threshold, in micro-units per n-gram, from held-out labels; None without both classes."""
    rows = labels.where(held_out() & F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
    held = rows.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("mark"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    passed = judge(with_marks(texts, held, "inner"), model).where("not base_failed").select(
        F.col("row.mark").alias("quality"), F.floor(F.col("ratio_sum") / F.col("n_grams")).alias("score")
    )
    scores = passed.groupBy("quality", "score").agg(F.count("*").alias("n"))
    good, bad = scores.agg(
        F.percentile(F.when(F.col("quality") == 1, F.col("score")), F.lit(GOOD_LOST), F.col("n")),
        F.percentile(F.when(F.col("quality") == 0, F.col("score")), F.lit(0.5), F.col("n")),
    ).first()
    return None if good is None or bad is None else math.floor(min(good, (good + bad) / 2))


def fit_judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``judge`` with the model and the threshold that ``labels`` give."""
    model = fit(docs, training(labels))
    return judge(docs, model, calibrate(docs, labels, model))


def judge(docs: DataFrame, model: list[int], threshold: int | None = None) -> DataFrame:
    """``row`` (the given columns as one struct) and the figures and verdict of each row.

    ``threshold``: the least mean log ratio of a text that is kept, in
    micro-units; None rejects by the base rules only.
    """
    buckets = len(model)
    carried = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    text, words = F.col("text"), F.col("words")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = _with_hashes(
        _with_words(docs, [carried]).select(
            "row",
            "words",
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            lines.alias("lines"),
        )
    ).select(
        "row",
        F.col("n").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "grams",
        F.when(
            F.col("n") >= WINDOW,
            F.transform(
                F.sequence(F.lit(0), F.col("n") - WINDOW),
                lambda i: F.xxhash64(*[F.get(F.col("wh"), i + j) for j in range(WINDOW)]),
            ),
        ).otherwise(F.array().cast("array<bigint>")).alias("windows"),
    )
    # only texts with a repeated window pay for the sort
    repeats = rows.withColumn(
        "placed",
        F.when(
            F.size(F.array_distinct("windows")) < F.size("windows"),
            F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("p")))),
        ),
    ).drop("windows")
    model_column = _literal(model)
    figures = repeats.select(
        "row", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.coalesce(_repeat_words(F.col("n_words"), F.col("placed")), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("grams").cast("long").alias("n_grams"),
        F.aggregate(
            "grams",
            F.lit(0).cast("long"),
            lambda acc, h: acc + F.get(model_column, F.pmod(h, F.lit(buckets)).cast("int")),
        ).alias("ratio_sum"),
    )
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))
    # a generator between the figures and the verdict: a filter on the verdict would else be
    # pushed below, where Catalyst puts each array's whole expression in place of its name,
    # inside the functions that run for every element
    figures = figures.select(F.explode_outer(F.array(F.struct("*"))).alias("f")).select("f.*")
    return figures.select(
        "*",
        base.alias("base_failed"),
        (~base & (F.lit(True) if threshold is None else F.col("ratio_sum") >= F.lit(threshold) * F.col("n_grams"))).alias(
            "kept"
        ),
    )


def labels_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")
