"""Document fingerprints by improved consistent weighted sampling.

A document is a bag of words with their counts as weights.  For each sample
and word, two gamma(2, 1) draws r, c (by inverse distribution, from a table of
quantiles) and a uniform b come from a hash of word and sample alone.  With
weight w:

    t = floor(ln w / r + b),   ln y = r (t - b),   ln a = ln c - ln y - r

The sample is the pair (word, t) of the word with the least a.  Two documents
agree in a sample with probability sum(min) / sum(max) of their weights, the
generalised Jaccard similarity.  DataFrame expressions only.

A text and its edited form share their first half: its words are split and
counted once for both, and words of one count on both sides are drawn once.

The next document is found without one task for all: keys are cut at quantiles
into buckets of a bounded size, each bucket also gets the last rows of the one
before.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .state import n_parts, ordered_ids

LANES, MOST_LANES = 4, 8  # draws of one round: 16 make a method too long for the JIT compiler
BUCKET_BYTES, MOST_BUCKETS = 2 << 20, 10_000
PART_BYTES = 4 << 20  # of a task, whose counts stay in memory
LEVELS, EXACT = 1024, 16
FIRST, SECOND = 1, 1 << 32  # a word of the text, of the edited text
BOTH = FIRST + SECOND
_BITS, _FINE = 28, 26


def _gamma_quantiles() -> list[float]:
    """Quantiles of gamma(2, 1) at the middles of LEVELS equal shares, by
    Newton's method on 1 - (1 + x) exp(-x)."""
    out, x = [], 0.01
    for i in range(LEVELS):
        p = (i + 0.5) / LEVELS
        for _ in range(60):
            x = max(1e-9, x - (1 - (1 + x) * math.exp(-x) - p) / (x * math.exp(-x)))
        out.append(x)
    return out


def _constant(values: list[float]) -> Column:
    """An array that the optimiser folds into one literal."""
    return F.from_json(F.lit(json.dumps(values)), "array<double>")


def _tables(spark: SparkSession) -> DataFrame:
    """One row of the quantiles and their logarithms.  As columns they are
    plain doubles in one place; literals are boxed, and once more in each use."""
    quantiles = _gamma_quantiles()
    end = F.when(F.col("id") < 0, ",").otherwise("]")  # no constant, or it is folded back into literals
    array = lambda values: F.from_json(F.concat(F.lit(json.dumps(values)[:-1]), end), "array<double>")
    return F.broadcast(spark.range(1).select(array(quantiles).alias("gamma"), array([math.log(x) for x in quantiles]).alias("log_gamma")))


def _sample(word: Column, log_weight: Column, number: Column, gamma: Column, log_gamma: Column) -> Column:
    """(ln a in fixed point) << 28 | 28 bits that tell (word, t) apart.

    One hash of word and sample gives r by the table of gamma quantiles, b,
    and c by its share p: c is the quantile g at the middle d of p's level
    times sqrt(p / d), so ln c = ln g + atanh((p - d) / (p + d)).  In the first
    levels ln p is taken whole, so that small c, which decide, stay exact; in
    others four terms leave less than 1e-17.
    """
    known = lambda array, i: F.coalesce(F.get(array, i.cast("int")), F.lit(0.0))
    h = F.xxhash64(word, number)
    r = known(gamma, h.bitwiseAND(F.lit(LEVELS - 1)))
    b = F.shiftrightunsigned(h, 10).bitwiseAND(F.lit((1 << 22) - 1)).cast("double") / float(1 << 22)
    level = F.shiftrightunsigned(h, 54)
    p = F.shiftrightunsigned(h, 32).cast("double") + 0.5
    d = (level.cast("double") + 0.5) * float(1 << 22)
    s = (p - d) / (p + d)
    q = s * s
    near = s * (q * (q * (q * (1.0 / 7.0) + 0.2) + 1.0 / 3.0) + 1.0)
    log_c = known(log_gamma, level) + F.when(level < EXACT, F.coalesce(F.ln(p / d), F.lit(0.0)) * 0.5).otherwise(near)
    t = F.when(log_weight == 0.0, F.lit(0).cast("long")).otherwise(F.floor(log_weight / r + b))
    ln_a = log_c - r * (t - b) - r
    order = F.greatest(F.lit(0).cast("long"), F.least(F.lit((1 << 34) - 1), F.floor((ln_a + 128.0) * float(1 << _FINE))))
    apart = F.shiftrightunsigned(h, 28).bitwiseXOR(t * F.lit(2654435761)).bitwiseAND(F.lit((1 << _BITS) - 1))
    return F.shiftleft(order, _BITS).bitwiseOR(apart)


def _flat(text: Column) -> Column:
    """Blanks for tabs and line ends."""
    for c in "\t\n\r\x0b\x0c":
        text = F.replace(text, F.lit(c), F.lit(" "))
    return text


def _words(flat: Column) -> Column:
    """Lower-cased runs between blanks."""
    return F.array_remove(F.split(F.lower(flat), " "), "")


def _buckets(ids: DataFrame, n: int) -> tuple[list[float], dict[int, int]]:
    """(bounds of at most n buckets, {bucket: its largest id})."""
    bounds = sorted(set(ids.approxQuantile("k", [i / n for i in range(1, n)], 1 / (4 * n)))) if n > 1 else []
    last = ids.groupBy(_bucket(F.col("k"), bounds).alias("bucket")).agg(F.max("k").alias("k")).collect()
    return bounds, {r["bucket"]: r["k"] for r in last}


def _bucket(k: Column, bounds: list[float]) -> Column:
    """How many bounds are at most k: first among every m-th, then among the m
    behind that one, m the root of their number."""
    if not bounds:
        return F.lit(0)
    m = math.isqrt(len(bounds)) + 1
    groups = [bounds[i : i + m] for i in range(0, len(bounds), m)]
    below = lambda array: F.size(F.filter(array, lambda b: b <= k))
    group = below(_constant([g[0] for g in groups]))
    inside = F.get(F.from_json(F.lit(json.dumps(groups)), "array<array<double>>"), group - 1)
    return F.when(group == 0, 0).otherwise((group - 1) * m + below(inside))


def fingerprint_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", samples: int = 32) -> DataFrame:
    """key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next of each row.

    Words: lower-cased runs between blanks, tabs and line ends.  The edited text is the text with its last floor(n_chars / 2) code points
    replaced by the first as many (or all) of the next document's, in falling
    order of key, after the last the first.  near_*: share of equal samples.

    A key may be of any type that has an order.  A null text is empty; texts
    without words are alike.  Rows with a null key
    have no place in the order and are left out.  Rows of one key stand in the
    order of a hash of their text; rows repeated whole get a row each.  One
    row alone is its own next.  An empty table gives no rows; other columns
    are not read.
    """
    if samples % LANES:
        raise ValueError(f"samples must be a multiple of {LANES}")
    spark = docs.sparkSession
    rows, names = ordered_ids(docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("t")), "key", "k")
    rows = rows.where(F.col("k").isNotNull())
    bounds, last = _buckets(rows.select("k"), min(MOST_BUCKETS, n_parts(spark, docs.select(text), BUCKET_BYTES)))
    here = rows.withColumn("bucket", _bucket(F.col("k"), bounds)).withColumn("own", F.lit(True))
    order = sorted(last)
    before = {b: last[order[i - 1]] for i, b in enumerate(order)}  # the id just below a bucket, around the end
    if before:
        into = F.create_map(*(F.lit(x) for b, k in before.items() for x in (k, b)))
        edge = rows.where(F.col("k").isin(list(before.values()))).withColumn("bucket", F.element_at(into, F.col("k"))).withColumn("own", F.lit(False))
        here = here.unionByName(edge)
    here = here.repartitionById(n_parts(spark, docs.select(text), PART_BYTES), "bucket")
    line = Window.partitionBy("bucket").orderBy("own", "k", F.xxhash64("t"))
    n_chars, half = F.length("t"), F.floor(F.length("t") / 2).cast("int")
    placed = here.select("bucket", "own", "k", "t", F.row_number().over(line).alias("rn"), F.lag("t", 1, "").over(line).alias("next"))
    start, rest, edit = F.substring(F.col("t"), F.lit(1), n_chars - half), F.substring(F.col("t"), n_chars - half + 1, half), F.substring(F.col("next"), F.lit(1), half)
    facts = placed.where("own").select("bucket", "rn", "k", n_chars.cast("long").alias("n_chars"), F.sha2(F.concat(start, edit), 256).alias("edited_sha256"))

    # what both sides share up to the last blank before the cut, and the rest of either: counts add up, and words of one count on both sides are drawn once
    cut = placed.select("bucket", "rn", _flat(start).alias("start"), _flat(rest).alias("rest"), _flat(edit).alias("edit"))
    cut = cut.withColumn("open", F.substring_index("start", " ", -1))
    cut = cut.withColumn("both", F.substring(F.col("start"), F.lit(1), F.length("start") - F.length("open")))
    part = lambda one, x, bare: F.struct(F.lit(one).alias("one"), x.alias("x"), bare.alias("bare"))
    own = lambda one, x: part(one, F.concat("open", x), F.trim(F.concat("both", "open", x)) == "")
    parts = cut.select("bucket", "rn", F.inline(F.array(part(BOTH, F.col("both"), F.lit(False)), own(FIRST, "rest"), own(SECOND, "edit"))))
    words = parts.select("bucket", "rn", "one", F.explode(F.when(F.col("bare"), F.array(F.lit(None).cast("string"))).otherwise(_words(F.col("x")))).alias("word"))
    counts = words.select("bucket", "rn", "one", F.xxhash64("word").alias("word")).groupBy("bucket", "rn", "word").agg(F.sum("one").alias("n"))
    n, m = F.col("n").bitwiseAND(F.lit(FIRST * (SECOND - 1))), F.shiftrightunsigned("n", 32)
    sides = F.when(n == m, F.array(n * 4 + 3)).when(m == 0, F.array(n * 4 + 1)).when(n == 0, F.array(m * 4 + 2)).otherwise(F.array(n * 4 + 1, m * 4 + 2))
    weights = counts.select("bucket", "rn", "word", F.explode(sides).alias("n")).select("bucket", "rn", "word", F.col("n").bitwiseAND(F.lit(3)).alias("sides"), F.ln(F.shiftright("n", 2).cast("double")).alias("lw"))
    lanes = math.gcd(samples, MOST_LANES)
    rounds = weights.crossJoin(_tables(spark)).withColumn("round", F.explode(F.array(*map(F.lit, range(0, samples, lanes)))))
    draws = (_sample(F.col("word"), F.col("lw"), F.col("round") + j, F.col("gamma"), F.col("log_gamma")) for j in range(lanes))
    least = rounds.groupBy("bucket", "rn", "sides", "round").agg(*(F.min(x).alias(f"s{j}") for j, x in enumerate(draws)))
    places = [(i, j) for i in range(0, samples, lanes) for j in range(lanes)]
    prints = least.groupBy("bucket", "rn").agg(*(F.min(F.when((F.col("sides") != 2 - side) & (F.col("round") == i), F.col(f"s{j}"))).alias(f"p{side}_{i}_{j}") for side in (0, 1) for i, j in places))
    hexed = lambda c: F.lpad(F.hex(c.bitwiseAND(F.lit((1 << _BITS) - 1))), 7, "0")
    joined = lambda side: F.concat(*(hexed(F.col(f"p{side}_{i}_{j}")) for i, j in places))
    prints = prints.select("bucket", "rn", joined(0).alias("fingerprint"), joined(1).alias("edited_fingerprint"))
    prints = prints.withColumn("next_print", F.lag("fingerprint").over(Window.partitionBy("bucket").orderBy("rn")))

    def near(a: str, b: str) -> Column:
        same = [(F.substring(a, 7 * i + 1, 7) == F.substring(b, 7 * i + 1, 7)).cast("int") for i in range(samples)]
        total = same[0]
        for x in same[1:]:
            total = total + x
        return total / float(samples)

    prints = prints.select("bucket", "rn", "fingerprint", "edited_fingerprint", near("fingerprint", "edited_fingerprint").alias("near_edited"), near("fingerprint", "next_print").alias("near_next"))
    facts = facts.join(prints, ["bucket", "rn"])
    facts = facts.withColumn("key", F.col("k").cast(docs.schema[key].dataType)) if names is None else facts.join(names, "k")
    return facts.select(F.col("key").alias(key), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
