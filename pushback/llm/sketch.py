"""Document fingerprints: threshold-scaled sketches of word shingles.

A text's sketch keeps the hash of every distinct five-word shingle (fewer
words: the whole sequence) that lies below a fixed fraction of the hash range,
and its smallest hash, so that no text with a word has an empty sketch. Union
of sketches is the sketch of the union, whatever the texts' sizes. Hashes are
the first DIGITS hexadecimal digits of MD5; the fraction is the rank of a
leading digit among sixteen. Null texts are empty; empty sketches are alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pushback.llm.ledger import let, words_of

SHINGLE_WORDS = 5
DIGITS = 12
#: Hashes under this prefix are kept: 2 of 16 leading digits, an eighth.
BELOW = "2"
BUCKET_ROWS = 256
MAX_BUCKETS = 10_000


def sketch(text: Column, *, shingle_words: int = SHINGLE_WORDS, below: str = BELOW, digits: int = DIGITS) -> Column:
    """Sorted distinct hashes of a text's sketch."""
    def hashes(ws: Column) -> Column:
        last = F.greatest(F.size(ws) - shingle_words, F.lit(0))
        starts = F.when(F.size(ws) > 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.substring(F.md5(F.concat_ws(
            " ", *[F.get(ws, i + k) for k in range(shingle_words)])), 1, digits))

    def retained(hs: Column) -> Column:
        least = F.array_min(hs)
        kept = F.filter(hs, lambda h: h < below)
        return F.array_sort(F.array_distinct(F.when((F.size(hs) > 0) & (F.size(kept) == 0), F.array(least))
                                             .otherwise(kept)))

    return let(words_of(text), lambda ws: let(hashes(ws), retained))


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of all shingles that both texts have."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the smaller text's shingles that the other has."""
    least = F.least(F.size(a), F.size(b))
    return F.when(F.greatest(F.size(a), F.size(b)) == 0, F.lit(1.0)).when(least == 0, F.lit(0.0)).otherwise(
        F.size(F.array_intersect(a, b)) / least)


def with_next(docs: DataFrame, value: Column, *, id_col: str = "doc_id", text_col: str = "text",
              bucket_rows: int = BUCKET_ROWS, max_buckets: int = MAX_BUCKETS) -> DataFrame:
    """(id, value, next_value) in ascending order of the id; after the last
    the first. Null ids come first; rows that share an id go by a hash of the
    text.

    Quantiles of the ids (at most ``max_buckets`` numbers) deal rows to ranges
    of about ``bucket_rows``; the first row of each range is also sent to the
    range before, so that one shuffle and a window inside ranges suffice.
    """
    base = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_h"), value.alias("_value"))
    rows = base.count()
    buckets = max(1, min(max_buckets, -(-rows // bucket_rows)))
    wide = max(1, round(buckets ** 0.5))
    at = F.lit(0)
    if buckets > 1:
        cuts = base.select(F.percentile_approx("_id", [i / buckets for i in range(1, buckets)],
                                               max(10_000, 4 * buckets)).alias("q")).first()["q"] or []
        cuts = sorted(set(cuts))
        if cuts:
            blocks = [cuts[i:i + wide] for i in range(0, len(cuts), wide)]
            tops = F.array(*[F.lit(b[-1]) for b in blocks])
            within = F.array(*[F.array(*[F.lit(c) for c in b]) for b in blocks])
            below = lambda bounds: F.size(F.filter(bounds, lambda c: c < F.col("_id")))
            block = below(tops)
            at = block * wide + F.coalesce(F.when(block < len(blocks), below(F.get(within, block))), F.lit(0))
    dealt = base.withColumn("_b", at)
    heads = dealt.groupBy("_b").agg(F.min(F.struct(F.col("_id"), F.col("_h"))).alias("_head"))
    order = Window.orderBy("_b")
    heads = heads.select(F.col("_b").alias("_hb"), F.col("_head._id").alias("_hid"), F.col("_head._h").alias("_hh"),
                         F.coalesce(F.lag("_b").over(order),
                                    F.max("_b").over(Window.partitionBy(F.lit(0)))).alias("_before"))
    is_head = (F.col("_b") == F.col("_hb")) & F.col("_id").eqNullSafe(F.col("_hid")) & (F.col("_h") == F.col("_hh"))
    home = F.struct(F.lit(False).alias("ahead"), F.col("_b").alias("b"))
    ahead = F.struct(F.lit(True).alias("ahead"), F.col("_before").alias("b"))
    placed = (dealt.join(F.broadcast(heads), is_head, "left")
              .select("_id", "_value", "_h", F.explode(
                  F.when(F.col("_hb").isNotNull(), F.array(home, ahead)).otherwise(F.array(home))).alias("_p"))
              .select("_id", "_value", "_h", F.col("_p.b").alias("_b"), F.col("_p.ahead").alias("_ahead")))
    after = F.lead("_value").over(Window.partitionBy("_b").orderBy("_ahead", "_id", "_h"))
    return (placed.withColumn("_next", after).where(~F.col("_ahead"))
            .select(F.col("_id").alias(id_col), F.col("_value").alias("value"), F.col("_next").alias("next_value")))


def edited_text(text: Column, other: Column) -> Column:
    """The text with its last half replaced by as much of the other's start."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - half), F.substring(other, F.lit(1), half))


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, edited, sketch, edited_sketch, next_sketch) of each text and
    of its edited text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    pairs = with_next(docs, F.struct(text.alias("text"), sketch(text).alias("sketch")),
                      id_col=id_col, text_col=text_col)
    pairs = pairs.select(id_col, F.col("value.text").alias("text"), F.col("value.sketch").alias("sketch"),
                         edited_text(F.col("value.text"), F.col("next_value.text")).alias("edited"),
                         F.col("next_value.sketch").alias("next_sketch"))
    return pairs.withColumn("edited_sketch", sketch(F.col("edited")))
