"""Consistent weighted sampling of document words, in DataFrame functions alone."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Samples of a fingerprint, and hexadecimal digits that each of them keeps.
SAMPLES, DIGITS = 64, 4
#: White space between words (fixed values): space and U+0009 to U+000D.
SPACES = "[\\x20\\x09-\\x0D]+"
#: A term whose sample exceeds, for certain, this multiple of the expected smallest one is not worked out further.
#: exp(-BOUND) of all samples, 1 in 480 million, have no term below it and are the least term, equal for equal texts.
BOUND = 20.0

_M = (1 << 21) - 1
_U = 1.0 / (1 << 21)


def _uniform(bits: Column) -> Column:
    """A number in (0, 1) from 21 bits."""
    return (bits.bitwiseAND(F.lit(_M)).cast("double") + F.lit(0.5)) * F.lit(_U)


def _sample(k: int, bound: float | None = BOUND) -> Column:
    """The k-th sample's key for a row (term long, weight, log_weight, total): the text's smallest key is its sample.

    A gamma variate r = -ln(u1 u2), another one c = -ln(u3 u4) and a uniform b depend on term and k alone. With
    t = floor(ln(weight) / r + b), the term's value is ln(c) - r (t - b + 1); the term of smallest value, with its
    t, is the sample. The key holds the value and below it bits of the term; as values of one term for different t
    differ, equal keys mean an equal term and t.

    exp(value) is at least (1 - u3 u4) u1 u2 / weight, and for weight 1 at least (1 - u3 u4) u / (s + (1 - s) u)
    with u = u1 u2 and s = 1 - b, while the smallest of a text is exponential with mean 1 / total. Terms whose
    bound exceeds BOUND / total get a key above all others without a logarithm; that all terms of a text do, and
    its sample is then the least term, happens once in exp(BOUND) samples. With bound None all terms are worked out.
    """
    h = F.xxhash64(F.col("term").bitwiseXOR(F.lit(_odd(2 * k))))
    g = F.xxhash64(F.col("term").bitwiseXOR(F.lit(_odd(2 * k + 1))))
    u = _uniform(h) * _uniform(F.shiftrightunsigned(h, 21))
    rest = F.lit(1.0) - _uniform(F.shiftrightunsigned(h, 42)) * _uniform(g)
    b = _uniform(F.shiftrightunsigned(g, 21))
    r = -F.ln(u)
    t = F.when(F.col("weight") == 1, F.lit(0.0)).otherwise(F.floor(F.col("log_weight") / r + b).cast("double"))
    value = F.ln(-F.ln(F.lit(1.0) - rest)) - r * (t - b + 1)
    key = F.shiftleft(((value + F.lit(128.0)) * F.lit(float(1 << 22))).cast("long"), 32).bitwiseOR(F.col("term_bits"))
    if bound is None:
        return key
    one = u * (rest * F.col("total") - F.lit(bound) * b) <= F.lit(bound) * (F.lit(1.0) - b)  # the above, with u once
    more = rest * u * F.col("total") <= F.lit(bound) * F.col("weight")
    return F.when(F.when(F.col("weight") == 1, one).otherwise(more), key).otherwise(F.col("last_key"))


def _odd(k: int) -> int:
    """A 64-bit constant for each k, as a signed long."""
    x = (k * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (1 << 64) - 1
    return x - (1 << 64) if x >> 63 else x


def sample_words(texts: DataFrame, key: list[str], samples: int = SAMPLES, bound: float | None = BOUND) -> DataFrame:
    """key columns and fingerprint (string), for each row of texts(key..., text); no word counts as one empty word.

    texts must be partitioned by some of the key, whose values are unique: then no aggregation shuffles.
    """
    words = F.array_remove(F.split("text", SPACES), "")
    terms = (
        texts.select(*key, words.alias("words"))
        .select(*key, "words", F.size("words").alias("total"))  # else each word would carry them all
        .select(*key, "total", F.explode_outer("words").alias("word"))
        .select(*key, "total", F.xxhash64("word").alias("term"))
        .groupBy(*key, "total", "term")
        .agg(F.count("*").cast("double").alias("weight"))
    )
    low = F.col("term").bitwiseAND(F.lit(0xFFFFFFFF))
    terms = terms.select(
        *key, "term", "weight", F.col("total").cast("double").alias("total"), F.ln("weight").alias("log_weight"), low.alias("term_bits"), F.lit(1 << 62).bitwiseOR(low).alias("last_key")
    )
    best = terms.groupBy(*key).agg(*[F.min(_sample(k, bound)).alias(f"m{k}") for k in range(samples)])
    mask = F.lit((1 << (4 * DIGITS)) - 1)
    hexes = [F.lpad(F.lower(F.hex(F.xxhash64(f"m{k}").bitwiseAND(mask))), DIGITS, "0") for k in range(samples)]
    return best.select(*key, F.concat(*hexes).alias("fingerprint"))


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """The share of samples in which two fingerprints agree: an estimate of the texts' generalised Jaccard similarity."""
    same = [(F.substring(a, DIGITS * k + 1, DIGITS) == F.substring(b, DIGITS * k + 1, DIGITS)).cast("int") for k in range(samples)]
    return reduce(lambda x, y: x + y, same).cast("double") / F.lit(float(samples))


def _count_at_most(value: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds are at most value, by two short scans."""
    if not bounds:
        return F.lit(0)
    step = max(1, round(len(bounds) ** 0.5))
    rows = [bounds[k : k + step] for k in range(0, len(bounds), step)]
    firsts = F.array(*[F.lit(r[0]) for r in rows])
    row = F.size(F.filter(firsts, lambda x: x <= value))
    table = F.array(*[F.array(*[F.lit(x) for x in r]) for r in rows])
    inside = F.size(F.filter(F.element_at(table, F.greatest(row, F.lit(1))), lambda x: x <= value))
    return F.when(row == 0, F.lit(0)).otherwise((row - 1) * F.lit(step) + inside)


def fingerprint_with_neighbours(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of each text, of its edited text and their likenesses to the next document.

    docs: doc_id (a whole number), text, further columns are not read. Documents are in order of doc_id, then text;
    null ids come first; the first follows the last. The edited text has its last floor(n / 2) code points replaced
    by the first as many (or all) of the next document's text. Returns doc_id, n_chars long, edited_sha256,
    fingerprint, edited_fingerprint string, near_edited, near_next double: a row for each row of docs. Null texts
    count as empty; a text without words has the fingerprint of one empty word. Equal texts have equal fingerprints.
    An empty table gives no rows.

    Rows are dealt to ranges of doc_id of about equal numbers of rows, a few for each shuffle partition; the first
    row of each range is also sent to the range before, so that each range finds its neighbours alone. Texts are
    shuffled once, and all later steps keep to that partitioning.
    """
    spark = docs.sparkSession
    lowest = F.lit(-(1 << 63)).cast("long")
    key = F.coalesce(F.col("doc_id").cast("long"), lowest)
    ranges = max(16, min(20_000, 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    found = docs.select(key.alias("k")).agg(
        F.min("k").alias("least"), F.percentile_approx("k", [k / ranges for k in range(1, ranges)], 10 * ranges).alias("cuts")
    ).first()
    least = found.least if found.least is not None else 0
    bounds = sorted({c for c in found.cuts or [] if c > least})
    # Each copy of a row has the range it goes to and a rank: 0 its own, 1 the head of the range after, 2 the first row after the last.
    rows = docs.select(key.alias("k"), F.coalesce("text", F.lit("")).alias("text")).withColumn("own", _count_at_most(F.col("k"), bounds))
    copy = lambda at, rank: F.struct(at.cast("int").alias("range"), F.lit(rank).alias("rank"))
    head = F.col("k").isin(bounds) if len(bounds) < 50 else F.array_contains(F.array(*[F.lit(b) for b in bounds]), F.col("k"))
    copies = F.array_compact(
        F.array(
            copy(F.col("own"), 0),
            F.when(head, copy(F.col("own") - 1, 1)),
            F.when(F.col("k") == F.lit(least), copy(F.lit(len(bounds)), 2)),
        )
    )
    dealt = rows.select("k", "text", F.explode(copies).alias("c")).select("k", "text", "c.range", "c.rank")
    order = Window.partitionBy("range").orderBy("rank", "k", "text")
    n = F.char_length("text").cast("long")
    half = F.floor(n / 2).cast("int")
    placed = (
        dealt.withColumn("row", F.row_number().over(order))
        .withColumn("next", F.lead("text").over(order))
        .select(
            "range", "row", "rank", "k", "text", n.alias("n_chars"),
            F.concat(F.substring(F.col("text"), F.lit(1), (n - half).cast("int")), F.substring(F.coalesce("next", F.lit("")), F.lit(1), half)).alias("edited"),
        )
    )
    both = placed.select(
        "range", "row",
        F.explode_outer(
            F.array(F.struct(F.lit(0).alias("kind"), "text"), F.struct(F.lit(1).alias("kind"), F.col("edited").alias("text")))
        ).alias("t"),
    ).select("range", (F.col("row").cast("long") * 2 + F.col("t.kind")).alias("slot"), "t.text")
    prints = sample_words(both, ["range", "slot"], samples)
    pairs = prints.groupBy("range", F.shiftright("slot", 1).cast("int").alias("row")).agg(
        F.max(F.when(F.col("slot") % 2 == 0, F.col("fingerprint"))).alias("fingerprint"),
        F.max(F.when(F.col("slot") % 2 == 1, F.col("fingerprint"))).alias("edited_fingerprint"),
    )
    along = pairs.withColumn("next_fingerprint", F.lead("fingerprint").over(Window.partitionBy("range").orderBy("row")))
    # Both branches read the same columns of the one shuffle; the id comes back from its order key.
    doc_id = F.when(F.col("k") != lowest, F.col("k")).cast(docs.schema["doc_id"].dataType).alias("doc_id")
    own = placed.where("rank = 0").select("range", "row", doc_id, "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"))
    return own.join(along, ["range", "row"]).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint"), samples).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint"), samples).alias("near_next"),
    )
