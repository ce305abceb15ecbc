"""Toxic passages as maximal scoring segments, and a calibrated score of each document.

Words and beginnings of words have log-odds of toxic against other labelled documents, with a Dirichlet prior whose mean
is the share in both. Log-odds count only as far as they exceed three standard errors; a word scores the highest of its
own and its beginnings', less a small toll, so a text of no toxicity drifts down. One linear scan (Ruzzo and Tompa) finds all maximal segments. By Karlin and Altschul
the best segment of a clean text of n words follows an extreme-value law, P(S > x) = 1 - exp(-K n exp(-lambda x)):
lambda solves sum p(s) exp(lambda s) = 1 over the scores s of the clean documents' words, K is fitted to the clean documents' best segments, and
a segment is significant if its expected number of chance finds is below ``max_e``. A logistic curve that rises with the best
segment's evidence and with that of all significant ones gives the score.

Word counts cover all labelled rows of the folds they are learnt from: a table with a row for each word and beginning, by a
hash of 64 bits, that grows with the input. Those whose log-odds count are its model, sent to all tasks if there are few
enough and joined else (``common.with_table``). Only the logistic curve is fitted to a sample, of at most ``sample`` rows,
chosen by hash. Fold is crc32(id as text) mod 5: fold 0 is never learnt from, folds 1 to 3 give words, fold 4 the curve.

Where labels are so few that no word clears three standard errors, or the scores that do leave no drift, two, one and none
are tried in turn. Where the curve's fold lacks a class, a document is toxic if it has a significant passage.

Defined results: a null or empty text has no passages and the curve's lowest score; a label that is null is no label; a
document with several labels counts for each; without toxic or without other labels in the words' folds every score is 0; a
null id is in fold 0; repeated rows are rows of their own; texts of any length are scanned whole; of ties in a segment's bounds
the shortest segment stands; a score of 0.5 is predicted as toxic; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskiln.llm.common import materialise, summed, values_at, with_table

PREFIXES = (4, 5, 6, 7)  # bytes
BINS, PER_UNIT, LOWEST = 128, 5, -10  # histogram of word scores
PRIOR = 0.5  # pseudo-counts of each class, as a share of the counts of the toxic one
ERRORS = (3.0, 2.0, 1.0, 0.0)
TOLL = 0.1
MAX_E = 0.05
SAMPLE = 20_000


@dataclass
class Model:
    scores: DataFrame | None = None  # (key, value), a row for each word whose log-odds count
    lam: float = 0.0
    log_k: float = 0.0
    weights: list = field(default_factory=lambda: [0.0, 0.0, 0.0])
    empty: bool = True


def fold_of(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5, F.lit(0)).cast("int")


#: The curve without labels to fit it: what is significant has an evidence of 3 or more, and log1p(3) > 1.3.
BY_PASSAGE = [0.0, 1.0, -1.3]


def word_keys(text: str):
    """Hashes of 64 bits, as signed numbers: of each word, and below of its beginnings; first byte and byte after."""
    import numpy as np

    from corpuskiln.llm.words import words_of

    hashes, starts, ends = words_of(text, False, PREFIXES)
    return hashes.view(np.int64), starts, ends


def word_scores(counts: DataFrame, errors: float) -> DataFrame:
    """counts (key, toxic, other): (key, value) of the words whose log-odds exceed so many standard errors, by the excess."""
    toxic, other = counts.agg(F.sum("toxic"), F.sum("other")).head()
    mass = PRIOR * toxic
    prior = (F.col("toxic") + F.col("other")) * (mass / (toxic + other))
    odds = lambda c, n: F.log((F.col(c) + prior) / (n + mass))
    delta = odds("toxic", toxic) - odds("other", other)
    error = F.sqrt(1 / (F.col("toxic") + prior) + 1 / (F.col("other") + prior))
    value = F.signum(delta) * F.greatest(F.lit(0.0), F.abs(delta) - errors * error)
    return counts.select("key", value.cast("float").alias("value")).where("value != 0")


def values_of(keys, scores, text: str):
    """Each word's score, first byte and byte after; keys and scores are a model's."""
    hashes, starts, ends = word_keys(text)
    return values_at(keys, scores, hashes).max(axis=0) - TOLL, starts, ends


def keys_in(texts):
    import numpy as np

    return np.concatenate([np.zeros(0, np.int64), *[word_keys(t.as_py() or "")[0].ravel() for t in texts]])


def solve_lambda(bins: dict[int, int]) -> float:
    """bins: words by histogram bin. The positive root of sum p exp(lambda s) = 1; 0 if no word scores above 0."""
    import numpy as np

    value = np.array([(k + 0.5) / PER_UNIT + LOWEST for k in bins])
    share = np.array(list(bins.values()), float)
    if not len(value) or not (value > 0).any() or (share @ value) >= 0:
        return 0.0
    share /= share.sum()
    above = lambda x: (share * np.exp(np.minimum(x * value, 600))).sum() >= 1
    low, high = 0.0, 1e-3
    while not above(high):
        low, high = high, high * 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (low, mid) if above(mid) else (mid, high)
    return high


def maximal_segments(values) -> list[tuple[float, int, int]]:
    """All maximal scoring segments (score, first, after) of a sequence, in one pass; runs of one sign count as one value."""
    import numpy as np

    if not len(values):
        return []
    up = values > 0
    at = np.flatnonzero(np.append(True, up[1:] != up[:-1]))
    sums = np.add.reduceat(values.astype(np.float64), at)
    ends = np.append(at[1:], len(values))
    after = np.cumsum(sums)
    found: list[tuple[float, float, int, int, int]] = []  # total before, total after, first, after, the nearest earlier one that begins lower
    for k in np.flatnonzero(up[at]).tolist():
        right, left, first, end = float(after[k]), float(after[k] - sums[k]), int(at[k]), int(ends[k])
        j = len(found) - 1
        while True:
            while j >= 0 and found[j][0] >= left:
                j = found[j][4]
            if j < 0 or found[j][1] >= right:
                found.append((left, right, first, end, j))
                break
            left, first, j_next = found[j][0], found[j][2], found[j][4]
            del found[j:]
            j = j_next
    return [(b - a, x, y) for a, b, x, y, _ in found]


def count_words(labelled: DataFrame) -> DataFrame:
    """labelled (toxic, text): (key, toxic, other), how often each word and beginning is in the toxic and in the other rows."""
    import pyarrow as pa

    def tally(batches):
        parts = ((word_keys(text.as_py() or "")[0].ravel(), 1 - toxic) for b in batches for toxic, text in zip(b.column(0).to_pylist(), b.column(1)))
        for keys, n in summed(parts, 2):
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n[:, 0]), pa.array(n[:, 1])], ["key", "toxic", "other"])

    return labelled.select("toxic", "text").mapInArrow(tally, "key long, toxic long, other long").groupBy("key").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def scan(docs: DataFrame, model: Model, keep: list[str], text_col: str) -> DataFrame:
    """keep's columns, n_words, best (its ln E with K = 1) and passages: the significant ones, in characters of the text."""
    import numpy as np
    import pyarrow as pa

    lam, limit = model.lam, significant(model.log_k)
    passage = pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("log_e", pa.float64())])
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)

    def apply(b, keys, scores):
        n_words, best, passages = [], [], []
        for text in b.column(len(keep)):
            text = text.as_py() or ""
            values, starts, ends = values_of(keys, scores, text)
            found = [(math.log(len(values)) - lam * s, x, y) for s, x, y in maximal_segments(values)]
            n_words.append(len(values))
            best.append(min((e for e, _, _ in found), default=None))
            good = [(e, int(starts[x]), int(ends[y - 1])) for e, x, y in found if e < limit]
            if good and not text.isascii():
                raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
                char = np.append(0, np.cumsum((raw & 0xC0) != 0x80))
                good = [(e, int(char[x]), int(char[y])) for e, x, y in good]
            passages.append([{"start": x, "stop": y, "log_e": e} for e, x, y in good])
        return pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(n_words, pa.int32()), pa.array(best, pa.float64()), pa.array(passages, pa.list_(passage))], [*keep, "n_words", "best", "passages"])

    schema = f"{kinds}, n_words int, best double, passages array<struct<start:int,stop:int,log_e:double>>"
    return with_table(docs.select(*keep, text_col), model.scores, lambda b: keys_in(b.column(len(keep))), apply, schema)


def raw_scan(texts: DataFrame, scores: DataFrame) -> DataFrame:
    """Before lambda is known: id, n_words, the scores of all maximal segments, and how many words have which score."""
    import numpy as np
    import pyarrow as pa

    def apply(b, keys, values):
        n_words, segments, bins = [], [], []
        for text in b.column(1):
            found, _, _ = values_of(keys, values, text.as_py() or "")
            n_words.append(len(found))
            segments.append([s for s, _, _ in maximal_segments(found)])
            bins.append(np.bincount(np.clip(((found - LOWEST) * PER_UNIT).astype(np.int64), 0, BINS - 1), minlength=BINS))
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(n_words, pa.int32()), pa.array(segments, pa.list_(pa.float64())), pa.array(bins, pa.list_(pa.int64()))], ["id", "n_words", "segments", "bins"])

    return with_table(texts.select("id", "text"), scores, lambda b: keys_in(b.column(1)), apply, f"id {texts.schema['id'].dataType.simpleString()}, n_words int, segments array<double>, bins array<long>")


def significant(log_k: float) -> float:
    """A segment is significant if its ln E with K = 1 is below this."""
    return math.log(MAX_E) - log_k


def evidence(log_k: float) -> list[Column]:
    """The curve's inputs, from best and passages."""
    real = F.filter("passages", lambda p: p["log_e"] < significant(log_k))
    total = F.aggregate(real, F.lit(0.0), lambda a, p: a - p["log_e"] - F.lit(log_k))
    clip = lambda c: F.least(F.greatest(c, F.lit(0.0)), F.lit(60.0))
    return [F.log1p(clip(F.coalesce(-F.col("best") - log_k, F.lit(0.0)))), F.log1p(clip(total))]


def fit_curve(x, y, ridge: float = 1e-2):
    """Logistic regression by Newton steps; an input with a negative weight is left out. Weights and, last, the constant."""
    import numpy as np

    x = np.column_stack([x, np.ones(len(x))])
    used = list(range(x.shape[1]))
    while True:
        part, w = x[:, used], np.zeros(len(used))
        keep = np.array([ridge] * (len(used) - 1) + [1e-6])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(part @ w, -30, 30)))
            step = np.linalg.solve((part * (p * (1 - p))[:, None]).T @ part + np.diag(keep + 1e-9), part.T @ (y - p) - keep * w)
            w += step
            if np.abs(step).max() < 1e-8:
                break
        if len(used) == 1 or w[:-1].min() >= 0:
            break
        used.pop(int(np.argmin(w[:-1])))
    weights = np.zeros(x.shape[1])
    weights[used] = w
    return weights.tolist()


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> Model:
    """Words from folds 1 to 3, K and the curve from fold 4."""
    known = labels.where(F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic"), fold_of(F.col(id_col)).alias("fold")).where("fold != 0")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # one plan at every size: labels grow with the documents, and a broadcast that a small input gets would not carry over
    counts = materialise(count_words(texts.where(fold_of(F.col("id")).isin(1, 2, 3)).join(known.where("fold < 4").hint("merge"), "id")))
    if 0 in [x or 0 for x in counts.agg(F.sum("toxic"), F.sum("other")).head()]:
        return Model()
    tried = (fit_scores(materialise(word_scores(counts, e)), texts, known, sample) for e in ERRORS)
    return next((m for m in tried if not m.empty), Model())


def fit_scores(scores: DataFrame, texts: DataFrame, known: DataFrame, sample: int) -> Model:
    """The model of these scores; an empty one if no word's is above the toll, or all words' together don't drift down."""
    import numpy as np

    model = Model(scores)
    if not scores.where(F.col("value") > TOLL).head(1):
        return model
    held = materialise(raw_scan(texts.where(fold_of(F.col("id")) == 4), scores).join(known.where("fold = 4").hint("merge"), "id"))
    # a score that only toxic documents' words have counts as one clean word's, so that lambda stays finite
    counts = held.select("toxic", F.posexplode("bins").alias("bin", "n")).groupBy("bin").agg(F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("n"), F.max("n").alias("most"))
    bins = {r["bin"]: r["n"] for r in counts.where("most > 0").select("bin", F.greatest("n", F.lit(1)).alias("n")).collect()}  # at most BINS rows
    top = int((scores.agg(F.max("value")).head()[0] - TOLL - LOWEST) * PER_UNIT)
    bins.setdefault(min(max(top, 0), BINS - 1), 1)  # so does the highest score, if no word of the fold has it
    model.lam = solve_lambda(bins)
    if not model.lam:
        return model
    model.empty = False
    log_e = F.transform("segments", lambda s: F.log("n_words") - s * model.lam)
    held = held.select("id", "toxic", F.array_min(log_e).alias("best"), log_e.alias("log_e"))
    mean = held.where("toxic = 0 AND best IS NOT NULL").agg(F.avg(-F.col("best"))).head()[0]
    model.log_k = (mean if mean is not None else 0.0) - 0.5772156649015329
    held = held.withColumn("passages", F.transform(F.filter("log_e", lambda e: e < significant(model.log_k)), lambda e: F.struct(e.alias("log_e"))))
    chosen = held.orderBy(F.xxhash64("id"), "toxic").limit(sample).select("toxic", *[c.alias(f"x{k}") for k, c in enumerate(evidence(model.log_k))]).toPandas()
    model.weights = BY_PASSAGE
    if chosen["toxic"].nunique() == 2:
        fitted = fit_curve(chosen[["x0", "x1"]].to_numpy(float), chosen["toxic"].to_numpy(float))
        model.weights = fitted if np.isfinite(fitted).all() and max(fitted[:-1]) > 0 else BY_PASSAGE
    return model


def toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, score, predicted, n_words, best_log_e, passages (the significant ones)."""
    rows = docs.select(F.col(id_col), F.col(text_col).alias("__text"))
    if model.empty:
        return rows.select(id_col, F.lit(0.0).alias("score"), F.lit(0).alias("predicted"), F.lit(0).alias("n_words"), F.lit(None).cast("double").alias("best_log_e"), F.array().cast("array<struct<start:int,stop:int,log_e:double>>").alias("passages"))
    *inputs, constant = model.weights
    z = sum((w * x for w, x in zip(inputs, evidence(model.log_k))), F.lit(constant))
    score = 1 / (1 + F.exp(-z))
    real = F.transform("passages", lambda p: F.struct(p["start"].alias("start"), p["stop"].alias("stop"), (p["log_e"] + model.log_k).alias("log_e")))
    scored = scan(rows, model, [id_col], "__text").withColumn("score", score)
    return scored.select(id_col, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_words", (F.col("best") + model.log_k).alias("best_log_e"), real.alias("passages"))


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The documents not predicted toxic, with the columns they came with."""
    if model.empty:
        return docs
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text_col).alias("__text"))
    *inputs, constant = model.weights
    z = sum((w * x for w, x in zip(inputs, evidence(model.log_k))), F.lit(constant))
    return scan(rows, model, ["row"], "__text").where(z < 0).select("row.*")


def op6_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity(docs, model).select("doc_id", (fold_of(F.col("doc_id")) == 0).alias("held_out"), "score", "predicted", "n_words", "best_log_e", "passages")
