"""Document fingerprints by consistent weighted sampling, in DataFrame operations alone.

A text's terms are its words (maximal runs of anything but ASCII spaces), weighted by their counts.
For sample k a term draws r ~ Gamma(2,1), c ~ Gamma(2,1) and b ~ U(0,1) from hashes of (term, k). With
weight w: t = floor(ln w / r + b), ln a = ln c - r (t - b) - r. The sample is the (term, t) of least a;
two texts share it with a probability equal to the generalised Jaccard similarity of their weights.

Texts are shuffled once, into buckets of neighbouring documents; all that follows works on a bucket's own partition, so nothing
else is shuffled. The first document of each bucket is also a guest at the end of the bucket before, as the next one of its last.

Defined results: a null text is an empty one; a text without words has the fingerprint of zeros, which
equals that of other such texts. Rows that share a doc_id are kept one for one, ordered by a hash of
their texts; a null doc_id sorts first. A single row is its own next one. An empty table gives an empty
result. Very long texts are worked on whole. Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import SPACES, table, text_of

#: Stands for a null doc_id inside.
NO_ID = -(1 << 63)

#: Samples in a signature, and those of them that one row draws (with more, the code of a row is too long to be compiled).
SAMPLES, DRAWN = 64, 2
#: Shares of probability that gamma variates are tabulated for, and the lowest of them, which are worked out.
LEVELS, LOW = 4096, 64
#: Buckets for each shuffle partition.
BUCKETS = 4


def _quantiles() -> list[float]:
    """Gamma(2,1) at the middle of each of LEVELS equal shares of probability, by Newton's method on 1 - (1 + x) exp(-x)."""
    p = (np.arange(LEVELS) + 0.5) / LEVELS
    x = 0.1 + np.sqrt(2 * p) + 2 * p * p
    for _ in range(60):
        x = np.maximum(x - (1 - (1 + x) * np.exp(-x) - p) / (x * np.exp(-x)), 1e-6)
    return x.tolist()


def _tables() -> tuple[Column, Column]:
    """The quantiles and their logarithms: a look-up costs a tenth of a logarithm."""
    x = _quantiles()
    as_array = lambda values: F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")
    return as_array(x), as_array([math.log(v) for v in x])


def _draws(term: Column, k: Column, tables: tuple[Column, Column]) -> tuple[Column, Column, Column]:
    """r, ln c and b of sample k, from 12, 30 and 22 bits of one hash.

    c's lowest quantiles, which decide samples of long texts, are taken from all 30 bits: with s = sqrt(2 p), ln c = ln s + s / 3 + 7 s^2 / 72.
    """
    h = F.xxhash64(term, k)
    bits = lambda shift, n: F.shiftrightunsigned(h, shift).bitwiseAND(F.lit((1 << n) - 1).cast("long"))
    level = bits(12, 12).cast("int")
    s = F.sqrt((bits(24, 18).cast("double") + F.lit(0.5)) * F.lit(2.0 / (LEVELS << 18)) + level * F.lit(2.0 / LEVELS))
    log_c = F.when(level < LOW, F.log(s) + s * F.lit(1 / 3) + s * s * F.lit(7 / 72)).otherwise(F.get(tables[1], level))
    return F.get(tables[0], bits(0, 12).cast("int")), log_c, (bits(42, 22).cast("double") + F.lit(0.5)) * F.lit(2.0**-22)


def _sample(term: Column, log_weight: Column, r: Column, log_c: Column, b: Column) -> Column:
    """ln a in the upper half and 32 bits that tell (term, t) in the lower half of a long: its minimum is the sample."""
    t = F.floor(log_weight / r + b)
    log_a = log_c - r * (t.cast("double") - b) - r
    rank = F.floor((log_a + F.lit(80.0)) * F.lit(float(1 << 23)))
    packed = F.shiftleft(rank, 32).bitwiseOR(term.bitwiseXOR(t).bitwiseAND(F.lit((1 << 32) - 1).cast("long")))
    return F.when(log_weight.isNotNull(), packed)


#: The sides that words are on; marks from 1 on are facts of a document that its rows carry along.
BOTH, TEXT_ONLY, EDITED_ONLY = -1, -2, -3


def _bounds(rows: DataFrame) -> list[tuple[int, int]]:
    """The least (doc_id, h) of each bucket, ascending: BUCKETS for each shuffle partition at most, whatever the number of rows."""
    n = BUCKETS * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.select("doc_id", "h").repartitionByRange(n, "doc_id", "h")
    heads = ranged.groupBy(F.spark_partition_id()).agg(F.min(F.struct("doc_id", "h")).alias("head")).select("head.*").collect()
    return sorted((r["doc_id"], r["h"]) for r in heads)


def _dealt(docs: DataFrame) -> DataFrame:
    """bucket, guest (0 or 1), doc_id, h and text; rows of a bucket follow each other by (doc_id, h), its guests come after all of them."""
    rows = text_of(docs).select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "text", F.xxhash64("text").alias("h"))
    bounds = _bounds(rows) or [(NO_ID, 0)]
    n = len(bounds)
    # a literal each, of 8 bytes a bucket
    ids, hashes = (F.split(F.lit(",".join(str(b[i]) for b in bounds)), ",").cast("array<long>") for i in (0, 1))

    def reached(i: Column) -> Column:
        return (F.get(ids, i) < F.col("doc_id")) | ((F.get(ids, i) == F.col("doc_id")) & (F.get(hashes, i) <= F.col("h")))

    steps = F.array(*[F.lit(1 << k) for k in range(n.bit_length() - 1, -1, -1)])  # a binary search
    found = F.aggregate(steps, F.lit(0), lambda at, step: F.when((at + step < n) & reached(at + step), at + step).otherwise(at))
    rows = rows.withColumn("bucket", found)
    head = (F.get(ids, F.col("bucket")) == F.col("doc_id")) & (F.get(hashes, F.col("bucket")) == F.col("h"))
    before = F.when(F.col("bucket") == 0, n - 1).otherwise(F.col("bucket") - 1)
    own, guest = F.struct(F.col("bucket").alias("bucket"), F.lit(0).alias("guest")), F.struct(before.alias("bucket"), F.lit(1).alias("guest"))
    dealt = rows.select("doc_id", "h", "text", F.explode(F.when(head, F.array(own, guest)).otherwise(F.array(own))).alias("to"))
    # as many partitions as buckets: a text's terms need far more memory than the text, which is all that adaptive plans see
    return dealt.select("to.*", "doc_id", "h", "text").repartition(n, "bucket")


def edited(docs: DataFrame) -> DataFrame:
    """bucket, row, guest, doc_id, text, and the three parts whose words make up the text (both and text_only) and its edited
    form (both and edited_only): the last quarter of each text is replaced by the start of the next one."""
    order = W.partitionBy("bucket").orderBy("guest", "doc_id", "h")
    rows = _dealt(docs).withColumns({"row": F.row_number().over(order), "after": F.coalesce(F.lead("text").over(order), F.col("text"))})
    take = F.floor(F.length("text") / 4).cast("int")
    rows = rows.select("bucket", "row", "guest", "doc_id", "text", F.substring("text", F.lit(1), F.length("text") - take).alias("head"), F.substring("text", F.length("text") - take + 1, take).alias("end"), F.substring("after", F.lit(1), take).alias("start"))
    # the word that the cut falls into belongs to what follows
    word = F.length(F.regexp_extract(F.reverse("head"), r"^[^\x20\x09-\x0D]*", 0))
    cut = F.length("head") - word
    both, part = F.substring("head", F.lit(1), cut), F.substring("head", cut + 1, word)
    return rows.select("bucket", "row", "guest", "doc_id", "text", F.concat("head", "start").alias("edited"), both.alias("both"), F.concat(part, "end").alias("text_only"), F.concat(part, "start").alias("edited_only"))


def _halves(sha: Column) -> list[Column]:
    """A hash of 64 hex digits as four longs."""
    return [F.conv(F.substring(sha, 16 * i + 1, 16), 16, -10).cast("long") for i in range(4)]


def _sampled(counts: DataFrame, sides: int, samples: int) -> DataFrame:
    """The least sample of each group of DRAWN, and what marks other than 0 say as it is: bucket, row, part (group number, or mark
    less than 0), m<side>_<i>. counts: bucket, row, mark, term, n<side>."""
    groups = F.sequence(F.lit(0), F.lit((samples - 1) // DRAWN))
    logs = [F.when((F.col("mark") == 0) & (F.col(f"n{s}") > 0), F.log(F.col(f"n{s}").cast("double"))).alias(f"w{s}") for s in range(sides)]
    # a row for each term and group: one expression for each sample would be more code than a JVM compiles in useful time
    rows = counts.select("bucket", "row", "mark", "term", "n0", *logs, F.explode(F.when(F.col("mark") > 0, F.array(-F.col("mark"))).otherwise(groups)).alias("part"))
    out, tables = [], _tables()
    for i in range(DRAWN):
        r, log_c, b = _draws(F.col("term"), F.col("part") * DRAWN + i, tables)
        rows = rows.withColumns({f"r{i}": r, f"c{i}": log_c, f"b{i}": b})
        for s in range(sides):
            value = _sample(F.col("term"), F.col(f"w{s}"), F.col(f"r{i}"), F.col(f"c{i}"), F.col(f"b{i}"))
            if s == i == 0:
                value = F.when(F.col("mark") > 0, F.col("n0")).otherwise(value)
            out.append(F.min(value).alias(f"m{s}_{i}"))
    return rows.groupBy("bucket", "row", "part").agg(*out)


def _counts(said: DataFrame) -> DataFrame:
    """bucket, row, mark (0 for words), term, n0 and n1. said: bucket, row, mark, said, value."""
    # split() gives one empty string at least, so no row is lost
    words = said.select("bucket", "row", "mark", "value", F.explode(F.split("said", SPACES)).alias("word")).filter("word != '' or mark > 0")
    fact = F.col("mark") > 0
    on = [F.when(fact, F.col("value")).otherwise((F.col("mark") != EDITED_ONLY).cast("long")), (F.col("mark").isin(BOTH, EDITED_ONLY)).cast("long")]
    rows = words.select("bucket", "row", F.greatest("mark", F.lit(0)).alias("mark"), F.when(fact, F.lit(0).cast("long")).otherwise(F.xxhash64("word")).alias("term"), *[n.alias(f"n{i}") for i, n in enumerate(on)])
    return rows.groupBy("bucket", "row", "mark", "term").agg(*[F.sum(f"n{i}").alias(f"n{i}") for i in (0, 1)])


def _listed(said: DataFrame, sides: int, samples: int) -> DataFrame:
    """bucket, row and found: what the marks say, the greatest mark first, then the samples of each group."""
    least = _sampled(_counts(said), sides, samples)
    names = [f"m{s}_{i}" for s in range(sides) for i in range(DRAWN)]
    return least.groupBy("bucket", "row").agg(F.sort_array(F.collect_list(F.struct("part", *names))).alias("found"))


def _digits(facts: int, side: int, samples: int) -> Column:
    """8 hex digits a sample; zeros for a text without words."""
    low = F.lit((1 << 32) - 1).cast("long")

    def one(k: int) -> Column:
        value = F.get(F.col("found"), F.lit(facts + k // DRAWN))[f"m{side}_{k % DRAWN}"]
        return F.coalesce(value, F.lit(0).cast("long")).bitwiseAND(low)

    each = F.array(*[one(k) for k in range(samples)])
    return F.array_join(F.transform(each, lambda v: F.lower(F.lpad(F.hex(v), 8, "0"))), "")


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """The share of samples on which two signatures agree."""
    same = F.filter(F.sequence(F.lit(0), F.lit(samples - 1)), lambda k: a.substr(F.lit(8) * k + F.lit(1), F.lit(8)) == b.substr(F.lit(8) * k + F.lit(1), F.lit(8)))
    return F.size(same).cast("double") / F.lit(float(samples))


def _stacked(rows: DataFrame, facts: list[str], texts: dict[int, str]) -> DataFrame:
    """bucket, row, mark, said and value: a row for each fact (marks 1, 2, ...) and each text."""
    parts = [f"{i + 1}, '', {name}" for i, name in enumerate(facts)] + [f"{mark}, {name}, 0L" for mark, name in texts.items()]
    return rows.select("bucket", "row", F.expr(f"stack({len(parts)}, {', '.join(parts)})").alias("mark", "said", "value"))


def _id(fact: Column) -> Column:
    return F.when(fact != NO_ID, fact)


def fingerprint(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """doc_id and its fingerprint, one row for each row of docs."""
    order = W.partitionBy("bucket").orderBy("guest", "doc_id", "h")
    rows = _dealt(docs).filter("guest = 0").withColumn("row", F.row_number().over(order))
    found = _listed(_stacked(rows, ["doc_id"], {TEXT_ONLY: "text"}), 1, samples)
    return found.select(_id(F.col("found")[0]["m0_0"]).alias("doc_id"), _digits(1, 0, samples).alias("fingerprint"))


def fingerprint_edited(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """The fingerprint of each text and of its edited form, and their likeness to each other and to the next text's."""
    rows = edited(docs)
    sha = F.sha2(F.encode("edited", "UTF-8"), 256)
    rows = rows.withColumns({"chars": F.length("text").cast("long") * 2 + F.col("guest"), "sha": sha}).drop("text", "edited")
    rows = rows.withColumns({f"sha{i}": half for i, half in enumerate(_halves(F.col("sha")))})
    facts = ["doc_id", "chars", *[f"sha{i}" for i in range(4)]]
    found = _listed(_stacked(rows, facts, {BOTH: "both", TEXT_ONLY: "text_only", EDITED_ONLY: "edited_only"}), 2, samples)
    # the greatest mark is the first
    fact = lambda name: F.col("found")[len(facts) - 1 - facts.index(name)]["m0_0"]
    sha_text = F.concat(*[F.lower(F.lpad(F.hex(fact(f"sha{i}")), 16, "0")) for i in range(4)])
    done = found.select("bucket", "row", fact("doc_id").alias("doc_id"), fact("chars").alias("chars"), sha_text.alias("edited_sha256"), _digits(len(facts), 0, samples).alias("fingerprint"), _digits(len(facts), 1, samples).alias("edited_fingerprint"))
    done = done.withColumn("after", F.lead("fingerprint").over(W.partitionBy("bucket").orderBy("row"))).filter("chars % 2 = 0")
    return done.select(
        _id(F.col("doc_id")).alias("doc_id"), F.shiftright("chars", 1).alias("n_chars"), "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint"), samples).alias("near_edited"), likeness(F.col("fingerprint"), F.col("after"), samples).alias("near_next"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edited(table(spark, sf_dir, "documents"))
