"""Toxicity from two class-conditional Kneser-Ney models.

A text becomes its lower-case code points; an expression is any ORDER of them in a row, across words, with marks before the first
and after the last one. An interpolated Kneser-Ney model is counted for toxic and for ordinary documents, from all
labelled rows of the learning folds. The highest order has each class's own counts; the lower orders' continuation counts are
shared: they are taken over both classes, so an expression that either class has rarely seen is judged alike by both.
Discounts of counts 1, 2 and more come from the counts of counts. The log ratio of the models at each code point, averaged over the
text and over its highest windows of three sizes, is the length-normalised comparison; a logistic curve, fitted on a
fold that the counts leave out, turns these averages into a score between 0 and 1.

The model is a table with a row for each expression and context that was seen, so it grows with the corpus. It is counted and
joined in Spark, and stored in the shared folder in pages by hash. Workers read the pages that their texts ask for and keep at most KEPT rows
of them. The driver holds neither the table nor any part of it.

Of an expression that was not seen, both models take the same shared probability, so its log ratio is that of its context's backoff
weights; if the context was not seen either, it is 0.

Defined results: a null text is an empty one and scores like any text without evidence; rows that share a doc_id
are scored one for one; of several labels of a doc_id the largest counts, a label row with a null is passed over; without labels of both classes every score is
the prior, 0.5 without any label; a null doc_id is never held out. An empty table gives an empty result. Very long texts are
scored whole. Other columns are ignored.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, opened, release, ship, table, text_of
from .tokens import kept, own

#: Code points in an expression.
ORDER = 4
#: What stands before and after a text.
BEGIN, END = "\x02", "\x03"
#: Code points in the windows over which evidence is averaged.
WINDOWS = (5, 10, 24)
#: Labelled rows that the logistic curve is fitted on, at most.
CALIBRATION = 20_000
#: Score from which a document counts as toxic.
THRESHOLD = 0.7
#: Rows in a page of the model, about, and rows of pages that a worker keeps.
PAGE, KEPT = 1 << 18, 24 << 20
#: Texts that are scored together, and code points of them, at least one text.
SLICE, TOGETHER = 512, 1 << 20
#: Code points of text whose expressions a task counts before it hands them on.
FLUSH = 4 << 20
ODD = np.uint64(0x9E3779B97F4A7C15)


def code_points(texts: list[str], order: int = ORDER) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts' code points, each with its marks before and after, and each text's first and last place, its end mark included."""
    said = [t.lower() for t in texts]
    joined = "".join(BEGIN * (order - 1) + t + END for t in said)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    sizes = np.array([len(t) for t in said], np.int64) + order
    ends = np.cumsum(sizes) - 1
    return points, ends - sizes + order, ends


def hashes(points: np.ndarray, order: int) -> np.ndarray:
    """A 64-bit name of the `order` code points that end at each place (from order - 1 on)."""
    n = len(points) - order + 1
    name = np.full(max(n, 0), order, np.uint64)
    for k in range(order):
        name = (name ^ points[k : k + n]) * ODD
        name ^= name >> np.uint64(29)
    return name


def counted(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """gram, ordinary and toxic: how often each expression occurs in the texts (text, toxic) of each class."""
    ship()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own("toxicity")
        held: list[list[str]] = [[], []]
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            for c in (0, 1):
                if not held[c]:
                    continue
                points, starts, ends = code_points(held[c], order)
                inside = np.zeros(len(points) + 1, np.int8)
                inside[starts] += 1
                inside[ends + 1] -= 1
                at = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
                _, first, n = np.unique(hashes(points, order)[at - order + 1], return_index=True, return_counts=True)
                at = at[first]
                said = points.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
                for lo in range(0, len(at), 50_000):
                    grams = [said[i - order + 1 : i + 1] for i in at[lo : lo + 50_000].tolist()]
                    some = n[lo : lo + 50_000].astype(np.int64)
                    zero = np.zeros(len(some), np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(grams), *map(pa.array, (zero, some) if c else (some, zero))], ["gram", "ordinary", "toxic"])
                held[c].clear()

        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held[label].append(text)
                size += len(text)
                if size >= FLUSH:
                    yield from out()
                    size = 0
        yield from out()

    partial = texts.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(work, "gram string, ordinary long, toxic long")
    return partial.groupBy("gram").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))


def discounts(ones: int, twos: int, threes: int, fours: int) -> tuple[float, float, float]:
    """What counts 1, 2 and more lose, from how many expressions have counts 1 to 4."""
    n = [max(1, x or 0) for x in (ones, twos, threes, fours)]
    y = n[0] / (n[0] + 2 * n[1])
    raw = (1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2])
    return tuple(min(max(d, low), high) for d, low, high in zip(raw, (0.3, 0.5, 0.7), (1.0, 1.8, 2.7)))


def _loss(count: Column, d: tuple[float, float, float]) -> Column:
    return F.when(count <= 0, 0.0).when(count == 1, d[0]).when(count == 2, d[1]).otherwise(d[2])


def _counts_of_counts(df: DataFrame, names: list[str]) -> dict:
    parts = [F.sum((F.col(c) == k).cast("long")).alias(f"{c}{k}") for c in names for k in (1, 2, 3, 4)]
    return df.agg(F.count("*").alias("rows"), *[F.sum(c).alias(c) for c in names], *parts).first().asDict()


def _context(gram: Column, size: int) -> Column:
    return F.substring(gram, 1, size - 1)


def shared(grams: DataFrame, made: list[DataFrame], order: int = ORDER) -> DataFrame:
    """gram and p: the shared probability of the last code point of every gram of order - 1, from continuation counts.

    A gram of order k counts how many different code points stand before it; each level backs off to the one below. made gets the
    stored tables that the result reads.
    """
    levels, above = {}, grams.select("gram")
    for k in range(order - 1, 0, -1):
        levels[k] = materialise(above.groupBy(F.substring("gram", 2, k).alias("gram")).agg(F.count("*").alias("n")))
        above = levels[k]
        made.append(above)
    p = None
    for k in range(1, order):
        level, facts = levels[k], _counts_of_counts(levels[k], ["n"])
        d = discounts(*(facts[f"n{i}"] for i in (1, 2, 3, 4)))
        level = level.withColumn("loss", _loss(F.col("n"), d))
        if k == 1:
            total, lost = max(1, facts["n"] or 0), sum(min(i, 3) and d[min(i, 3) - 1] * (facts[f"n{i}"] or 0) for i in (1, 2))
            lost += d[2] * max(0, facts["rows"] - (facts["n1"] or 0) - (facts["n2"] or 0))
            p = level.select("gram", ((F.col("n") - F.col("loss")) / total + F.lit(lost / total / max(1, facts["rows"]))).alias("p"))
            continue
        contexts = level.groupBy(_context(F.col("gram"), k).alias("c")).agg(F.sum("n").alias("total"), F.sum("loss").alias("lost"))
        below = p.select(F.col("gram").alias("s"), F.col("p").alias("q"))
        joined = level.join(contexts, _context(F.col("gram"), k) == F.col("c")).join(below, F.substring("gram", 2, k - 1) == F.col("s"))
        p = joined.select("gram", ((F.col("n") - F.col("loss") + F.col("lost") * F.col("q")) / F.col("total")).alias("p"))
    return p


def ratios(grams: DataFrame, made: list[DataFrame], order: int = ORDER) -> DataFrame:
    """gram and ratio = log P(last code point | context, toxic) - log P(the same | ordinary): a row for each gram that was seen, and one
    for each context (shorter by one), with the ratio of those that were not seen after it."""
    facts = _counts_of_counts(grams, ["ordinary", "toxic"])
    rows = grams
    for c in ("ordinary", "toxic"):
        rows = rows.withColumn(f"loss_{c}", _loss(F.col(c), discounts(*(facts[f"{c}{i}"] for i in (1, 2, 3, 4)))))
    sums = [F.sum(x).alias(f"{prefix}_{c}") for c in ("ordinary", "toxic") for x, prefix in ((c, "total"), (f"loss_{c}", "lost"))]
    contexts = rows.groupBy(_context(F.col("gram"), order).alias("c")).agg(*sums)
    backoff = {c: F.when(F.col(f"total_{c}") > 0, F.col(f"lost_{c}") / F.col(f"total_{c}")).otherwise(1.0) for c in ("ordinary", "toxic")}
    below = shared(grams, made, order).select(F.col("gram").alias("s"), "p")
    joined = rows.join(contexts, _context(F.col("gram"), order) == F.col("c")).join(below, F.substring("gram", 2, order - 1) == F.col("s"))

    def likelihood(c: str) -> Column:
        return F.when(F.col(f"total_{c}") > 0, (F.col(c) - F.col(f"loss_{c}")) / F.col(f"total_{c}")).otherwise(0.0) + backoff[c] * F.col("p")

    seen = joined.select("gram", (F.log(likelihood("toxic")) - F.log(likelihood("ordinary"))).alias("ratio"))
    return seen.unionByName(contexts.select(F.col("c").alias("gram"), (F.log(backoff["toxic"]) - F.log(backoff["ordinary"])).alias("ratio")))


class Pages:
    """The stored model: ratios by the hashes of grams, read page by page."""

    def __init__(self, folder: str, bits: int, files: dict[int, list[str]], order: int = ORDER):
        self.folder, self.bits, self.files, self.order = folder, bits, files, order
        self.pages: OrderedDict[int, tuple[np.ndarray, np.ndarray]] = OrderedDict()
        self.rows = 0

    def __getstate__(self) -> dict:
        return {"folder": self.folder, "bits": self.bits, "files": self.files, "order": self.order, "pages": OrderedDict(), "rows": 0}

    def page(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        if number in self.pages:
            self.pages.move_to_end(number)
            return self.pages[number]
        import pyarrow.parquet as pq

        found = [pq.read_table(opened(f"{self.folder}/page={number}/{name}"), columns=["key", "ratio"]) for name in self.files.get(number, [])]
        keys = np.concatenate([np.zeros(0, np.int64), *(t["key"].to_numpy() for t in found)]).view(np.uint64)
        values = np.concatenate([np.zeros(0, np.float32), *(t["ratio"].to_numpy() for t in found)])
        by_key = np.argsort(keys)
        self.pages[number] = keys[by_key], values[by_key]
        self.rows += len(keys)
        while self.rows > KEPT and len(self.pages) > 1:
            _, (gone, _) = self.pages.popitem(last=False)
            self.rows -= len(gone)
        return self.pages[number]

    def look(self, keys: np.ndarray) -> np.ndarray:
        """The ratio of each key, NaN where there is none. keys ascend, so that each page is needed once."""
        out = np.full(len(keys), np.nan, np.float32)
        number = keys >> np.uint64(64 - self.bits) if self.bits else np.zeros(len(keys), np.uint64)
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(number)) + 1, [len(keys)]])
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if lo == hi:
                continue
            own_keys, values = self.page(int(number[lo]))
            if len(own_keys):
                at = np.minimum(np.searchsorted(own_keys, keys[lo:hi]), len(own_keys) - 1)
                out[lo:hi] = np.where(own_keys[at] == keys[lo:hi], values[at], np.nan)
        return out

    def ratios(self, points: np.ndarray) -> np.ndarray:
        """The ratio at each place from order - 1 on; of places that were not seen, that of their context, or 0."""
        names, where = np.unique(hashes(points, self.order), return_inverse=True)
        found = self.look(names)[where]
        new = np.flatnonzero(np.isnan(found))
        if len(new):
            names, where = np.unique(hashes(points, self.order - 1)[new], return_inverse=True)
            found[new] = np.nan_to_num(self.look(names)[where])
        return found


def store(model: DataFrame, order: int = ORDER) -> Pages:
    """Writes the table of ratios to the shared folder, in pages by hash."""
    ship()
    model = materialise(model)
    bits = max(0, (model.count() // PAGE).bit_length())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = batch.column(0).to_pylist()
            keys = np.zeros(len(grams), np.uint64)
            for size in (order - 1, order):
                at = np.array([i for i, g in enumerate(grams) if len(g) == size], np.int64)
                if len(at):
                    points = np.frombuffer("".join(grams[i] for i in at.tolist()).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
                    keys[at] = hashes(points, size)[::size]
            number = (keys >> np.uint64(64 - bits) if bits else keys * np.uint64(0)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(number), pa.array(keys.view(np.int64)), batch.column(1).cast(pa.float32())], ["page", "key", "ratio"])

    pages = model.mapInArrow(work, "page int, key long, ratio float").repartition(1 << bits, "page").sortWithinPartitions("page", "key")
    done = materialise(pages, "page")
    release(model)
    # a name or two for each page
    files: dict[int, list[str]] = {}
    for name in done.inputFiles():
        folder, page, file = name.rsplit("/", 2)
        files.setdefault(int(page.removeprefix("page=")), []).append(file)
    return Pages(folder if files else "", bits, files, order)


def evidence(texts: list[str], pages: Pages) -> np.ndarray:
    """For each text: the mean ratio, and the mean of its highest window of each size."""
    points, starts, ends = code_points(texts, pages.order)
    total = np.zeros(len(points) + 1)
    np.cumsum(pages.ratios(points), out=total[pages.order :])
    lengths = ends + 1 - starts
    whole = (total[ends + 1] - total[starts]) / lengths
    # windows stop at their text's start
    first = np.repeat(starts, lengths)
    at = np.arange(len(first)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + first + 1
    best = [np.maximum.reduceat(total[at] - total[np.maximum(at - w, first)], np.cumsum(lengths) - lengths) / w for w in WINDOWS]
    return np.stack([whole, *best], 1)


def evidence_of(texts: list[str], pages: Pages) -> np.ndarray:
    """evidence() of TOGETHER code points at a time."""
    found, lo = [np.zeros((0, 1 + len(WINDOWS)))], 0
    while lo < len(texts):
        hi, size = lo, 0
        while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= TOGETHER):
            size += len(texts[hi])
            hi += 1
        found.append(evidence(texts[lo:hi], pages))
        lo = hi
    return np.concatenate(found)


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 60) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean and spread of the features, and the weights of a logistic regression (bias last), by Newton's method."""
    mean, spread = x.mean(0), x.std(0) + 1e-9
    z = np.column_stack([(x - mean) / spread, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (y - p) / len(y) - ridge * w
        hessian = (z.T * (p * (1 - p))) @ z / len(y) + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return mean, spread, w


class Model:
    """What scoring needs: where the ratios are, and the curve."""

    def __init__(self, pages: Pages | None, curve: tuple | None, prior: float):
        self.pages, self.curve, self.prior = pages, curve, prior

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.pages is None or self.curve is None:
            return np.full(len(texts), self.prior)
        mean, spread, w = self.curve
        pages = kept(f"toxicity {self.pages.folder}", lambda: self.pages)
        z = (evidence_of(texts, pages) - mean) / spread
        return 1 / (1 + np.exp(-np.clip(z @ w[:-1] + w[-1], -30, 30)))


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary"))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(fold(doc_id) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, order: int = ORDER) -> Model:
    """Learns from the labelled rows that are not held out; a sixth of all rows is for the curve, the rest for the counts."""
    ship()
    known = labels.select(F.col("doc_id").cast("long").alias("l_id"), F.col("toxic").cast("int").alias("toxic")).filter(F.col("toxic").isin(0, 1) & ~held_out(F.col("l_id")))
    known = known.groupBy("l_id").agg(F.max("toxic").alias("toxic"))
    texts = text_of(docs).filter(~held_out(F.col("doc_id")))
    # the same join at every size
    rows = texts.join(known.hint("merge"), texts.doc_id == known.l_id).select("doc_id", "text", "toxic")
    for_curve = fold(F.col("doc_id")) % 6 == 5
    grams = materialise(counted(rows.filter(~for_curve), order))
    sums = grams.agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic")).first()
    if not sums["ordinary"] or not sums["toxic"]:
        share = known.agg(F.avg("toxic")).first()[0]
        return Model(None, None, 0.5 if share is None else float(share))
    made = [grams]
    pages = store(ratios(grams, made, order), order)
    for old in made:
        release(old)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own("toxicity")
        mine = kept(f"toxicity {pages.folder}", lambda: pages)
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE):
                part = batch.slice(lo, SLICE)
                x = evidence_of(part.column(0).to_pylist(), mine)
                yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.list_(pa.float64())), part.column(1)], ["x", "toxic"])

    picked = known.filter(fold(F.col("l_id")) % 6 == 5).orderBy(F.xxhash64("l_id"), "l_id").limit(CALIBRATION)
    # at most CALIBRATION ids of 8 bytes and a label
    some = texts.join(F.broadcast(picked), texts.doc_id == picked.l_id).select("text", "toxic")
    marks = some.mapInArrow(work, "x array<double>, toxic int").toPandas()
    y = marks["toxic"].to_numpy(float)
    if not 0 < y.sum() < len(y):
        return Model(None, None, float(sums["toxic"] / (sums["ordinary"] + sums["toxic"])))
    return Model(pages, fit_curve(np.stack(marks["x"].to_numpy()), y), float(y.mean()))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of each text."""
    ship()
    shared_model = docs.sparkSession.sparkContext.broadcast(model)  # names of files and a curve

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own("toxicity")
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE):
                part = batch.slice(lo, SLICE)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(shared_model.value.scores(part.column(1).to_pylist()), pa.float64())], ["doc_id", "score"])

    return text_of(docs).mapInArrow(work, "doc_id long, score double")


def reject(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that score below the threshold, with all their columns."""
    ship()
    shared_model = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own("toxicity")
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE):
                part = batch.slice(lo, SLICE)
                keep = shared_model.value.scores([t or "" for t in part.column(at).to_pylist()]) < threshold
                yield part.filter(pa.array(keep))

    return docs.mapInArrow(work, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
