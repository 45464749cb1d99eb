"""Document fingerprints by consistent weighted sampling (operator 5).

Method: a document is a bag of words with their counts as weights. For each
of ``samples`` draws every word has, by hash, r and c from a Gamma(2, 1)
distribution and b from a uniform one; with t = floor(ln(weight) / r + b) the
word whose c / exp(r (t - b + 1)) is smallest is drawn. The smallest value
itself names word and t, so it is the sample; two documents have the same
sample with a probability equal to the generalised Jaccard similarity of
their weights (sum of minima over sum of maxima).

Everything is DataFrame expressions. Words of a document are counted and
drawn from within the partition that holds the document, after one shuffle
of the texts. The neighbour in descending order of ids comes from ranges of
ids, never from one sorted whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auditlens.llm.shared import run_folder, slots, written

SAMPLES = 32
_SPACE = r"[\x20\x09-\x0D]+"
#: A document's key, without nulls: so joins and groups on it share one partitioning.
KEY = ("id", "no_id", "text_hash")


def uniform(bits: Column, shift: int, width: int) -> Column:
    """A number in (0, 1) from ``width`` bits of a 64-bit hash."""
    part = F.shiftrightunsigned(bits, shift).bitwiseAND(F.lit((1 << width) - 1)).cast("double")
    return (part + 0.5) / float(1 << width)


def sample(term: Column, weights: list[Column], k: int) -> list[Column]:
    """For each weight the smallest value of draw ``k`` (null where no weight is positive)."""
    x, y = F.xxhash64(term, F.lit(2 * k)), F.xxhash64(term, F.lit(2 * k + 1))
    r = -F.ln(uniform(x, 0, 26) * uniform(x, 26, 26))
    log_c = F.ln(-F.ln(uniform(y, 0, 26) * uniform(y, 26, 26)))
    b = (F.shiftrightunsigned(x, 52) * 4096 + F.shiftrightunsigned(y, 52)).cast("double") / float(1 << 24)
    return [F.min(log_c - r * (F.floor(F.ln(w.cast("double")) / r + b) - b + 1)) for w in weights]


def words(text: Column) -> Column:
    return F.split(text, _SPACE)


def signatures(texts: DataFrame, columns: list[str], keys: list[str], samples: int = SAMPLES) -> DataFrame:
    """``keys`` and for each text column its samples as ``<column>_<k>`` (rows without any word are left out).

    No shuffle if ``texts`` is dealt out by ``keys``.
    """
    sides = F.stack(F.lit(len(columns)), *(x for i, c in enumerate(columns) for x in (F.lit(i), F.col(c))))
    each = texts.select(*keys, sides.alias("side", "body")).select(*keys, "side", F.explode(words(F.col("body"))).alias("word"))
    each = each.where("word <> ''").select(*keys, "side", F.xxhash64("word").alias("term"))
    counts = each.groupBy(*keys, "term").agg(*(F.sum((F.col("side") == i).cast("int")).alias(f"w{i}") for i in range(len(columns))))
    drawn = []
    for k in range(samples):
        mins = sample(F.col("term"), [F.col(f"w{i}") for i in range(len(columns))], k)
        drawn += [m.alias(f"{c}_{k}") for m, c in zip(mins, columns, strict=True)]
    return counts.groupBy(*keys).agg(*drawn)


def compact(column: str, samples: int) -> Column:
    """Samples in binary, four bytes each."""
    return F.unhex(F.concat(*(F.lpad(F.hex(F.xxhash64(F.col(f"{column}_{k}")).bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")
                              for k in range(samples))))


def likeness(a: Column, b: Column, samples: int) -> Column:
    """Share of equal samples of two binary fingerprints."""
    same = [(F.substring(a, 4 * k + 1, 4) == F.substring(b, 4 * k + 1, 4)).cast("int") for k in range(samples)]
    return sum(same[1:], same[0]) / float(samples)


def neighbours(docs: DataFrame, folder: str) -> DataFrame:
    """For each distinct key the key, n_chars and copies of the row that it follows.

    The order is descending by id (null ids last), then by text_hash; the first row follows the last.
    """
    spark = docs.sparkSession
    rows = docs.groupBy(*KEY).agg(F.max("n_chars").alias("n_chars"), F.count("*").alias("copies"))
    order = [F.asc("no_id"), F.desc("id"), F.asc("text_hash")]
    held = written(rows.repartitionByRange(slots(spark), *order).withColumn("part", F.spark_partition_id()), f"{folder}/keys")
    own = F.struct(*KEY, "n_chars", "copies")
    within = Window.partitionBy("part").orderBy(*order)
    ranked = held.select("*", F.lag(own).over(within).alias("before"), F.lead(own).over(within).isNull().alias("is_last"))
    ends = ranked.where("is_last").select("part", own.alias("own"))  # a row for each range of ids
    along = Window.orderBy("part")
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    entries = ends.select("part", F.coalesce(F.lag("own").over(along), F.last("own").over(whole)).alias("entry"))
    return ranked.join(F.broadcast(entries), "part").select(
        *KEY, F.coalesce("before", "entry").alias("before"))


def fingerprints(docs: DataFrame, samples: int = SAMPLES, folder: str | None = None) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has the last floor(n_chars / 2) code points replaced by
    the first as many (or all) of the next document in descending order of
    ids. Null texts are empty; texts without words have the fingerprint of no
    samples, alike among each other (1) and unlike all others (0). Rows equal
    in id and text are one document for the order and come out as often as
    they went in; one document alone is its own neighbour. Null ids come last.
    """
    spark = docs.sparkSession
    folder = folder or run_folder(spark, "fingerprints")
    body = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    docs = docs.select(F.coalesce(doc_id, F.lit(0)).alias("id"), doc_id.isNull().alias("no_id"), body.alias("text")).select(
        "id", "no_id", F.xxhash64("text").alias("text_hash"), "text")
    order = written(neighbours(docs.select(*KEY, F.char_length("text").alias("n_chars")), folder), f"{folder}/order")
    if order.where("before.copies > 1").limit(1).count():
        docs = docs.dropDuplicates(list(KEY))
    # more partitions than usual, as the words of all texts of a partition are counted at once
    dealt = docs.repartition(4 * slots(spark), *KEY)
    ahead = dealt.join(order, list(KEY)).select(
        *(F.col(f"before.{k}").alias(k) for k in KEY), F.col("before.copies").alias("copies"),
        F.expr("substring(text, 1, CAST(before.n_chars DIV 2 AS INT))").alias("ahead"),
        *(F.col(k).alias(f"next_{k}") for k in KEY))
    n = F.char_length("text")
    following = [f"next_{k}" for k in KEY]
    both = dealt.join(ahead, list(KEY)).select(
        *KEY, "text", F.concat(F.substring("text", F.lit(1), (n - F.floor(n / 2)).cast("int")), F.col("ahead")).alias("edited"),
        "copies", *following)
    drawn = signatures(both, ["text", "edited"], list(KEY), samples)
    base = both.select(*KEY, F.char_length("text").cast("long").alias("n_chars"), F.unhex(F.sha2("edited", 256)).alias("edited_sha256"),
                       "copies", *following)
    made = base.join(drawn, list(KEY), "left").select(
        *base.columns, compact("text", samples).alias("fingerprint"), compact("edited", samples).alias("edited_fingerprint"))
    made = written(made, f"{folder}/made")
    nexts = made.select(*(F.col(k).alias(f"next_{k}") for k in KEY), F.col("fingerprint").alias("next_fingerprint"))
    out = made.join(nexts, following).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    text = [F.lower(F.hex(c)).alias(c) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")]
    return out.select(F.when(~F.col("no_id"), F.col("id")).alias("doc_id"), "n_chars", *text,
                      likeness(F.col("fingerprint"), F.col("edited_fingerprint"), samples).alias("near_edited"),
                      likeness(F.col("fingerprint"), F.col("next_fingerprint"), samples).alias("near_next"))
