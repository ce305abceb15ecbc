"""URL filter: rules first, a ratio of two character language models for the rest.

A rule (action, host, path) fits its host and all subdomains if the url's path starts with the rule's; the longest rule
that fits wins. URLs that a rule decides are the accepted and rejected examples, without the parts of host and path that the
rule tests, since no other URL has those; from the rest two variable-order Markov models over the bytes of host and path are learnt: a byte's probability is that of the longest context seen, smoothed
towards the next shorter context's (a hierarchy of Dirichlet priors, down to a uniform one), so the order varies with
what was seen. A URL's score is the difference of the two log-likelihoods divided by its length.

The cut is the score at which the mean of the two error rates is least, for URLs of hosts that their model hasn't seen: hosts
(what the rule leaves of them) are dealt to FOLDS folds by CRC-32, and a fold's URLs are scored by the counts of the others.
So all examples calibrate, all are learnt from, and both error rates are held-out ones. A fold without which one of the two
models has no example calibrates nothing; without any that does, the cut is 0 and the rates are unknown.

Counts cover all rows: a table with a row for each context and each context with its next byte, by a hash of 64 bits, that
grows with the input, in a column for each class and fold; each task sums its own before the shuffle. It is sent to all tasks
if it is small enough, and joined with the n-grams of blocks of URLs else (``common.with_table``). The cut comes from a
histogram of fixed size.

Defined results: a null url, or one without "://", has an empty host and path; an empty host fits no rule; without
accepted or without rejected examples everything that no rule decides is allowed; repeated rows are rows of their own;
URLs of any length are scored whole; of rules of one length the later fits first; an empty table gives an empty table; other columns are ignored. A tie of score and cut is allowed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuskiln.llm.common import materialise, summed, values_at, with_table

#: (action, host, path)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
ORDER, FOLDS = 5, 5
STRENGTH = 2.0
BINS, LIMIT = 2048, 4.0
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://((?s:.*))$", 1)
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def with_rule(pages: DataFrame, rules=RULES) -> DataFrame:
    """pages has host and path; adds rule (its host and path) and action, null where none fits, and rule_host and rule_path."""
    best = dict.fromkeys(("rule", "action", "rule_host", "rule_path"), F.lit(None).cast("string"))
    for action, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest is asked first
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path)
        best = {k: F.when(fits, F.lit(x)).otherwise(best[k]) for k, x in zip(best, (host + path, action, host, path))}
    return pages.withColumns(best)


def _keys(texts: list[bytes], order: int = ORDER):
    """For the bytes of all texts: per order 0..ORDER the hash of (context, byte) and of the context, as signed numbers of 64
    bits; each text's length."""
    import numpy as np

    from corpuskiln.llm.words import mixed

    pad = b"\0" * order
    body = np.frombuffer(b"".join(pad + t + b"\1" for t in texts), np.uint8).astype(np.uint64) + np.uint64(1)
    lengths = np.array([len(t) + 1 for t in texts])
    starts = np.cumsum(lengths + order) - lengths
    at = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(starts, lengths)
    out, h = [], np.zeros(len(at), np.uint64)  # five bytes and one more fit into h: different contexts have different hashes
    with np.errstate(over="ignore"):
        for k in range(order + 1):
            if k:
                h = h * np.uint64(257) + body[at - k]
            out.append(tuple(mixed(x * np.uint64(16) + np.uint64(k)).view(np.int64) for x in (h * np.uint64(257) + body[at], h * np.uint64(257))))
    return out, lengths


def url_text(host: str | None, path: str | None) -> bytes:
    return ((host or "") + (path or "")).encode("utf-8", "surrogatepass")


def log_likelihoods(texts: list[bytes], keys, counts):
    """Summed log-likelihood of each text under both models, and the texts' lengths; counts: allowed and blocked, of the keys."""
    import numpy as np

    grams, lengths = _keys(texts)
    found = [(values_at(keys, counts, g), values_at(keys, counts, c)) for g, c in grams]
    out = []
    for shift in (0, 32):
        p = np.full(int(lengths.sum()), 1 / 257)
        for gram, context in found:
            p = ((gram >> shift & 0xFFFFFFFF) + STRENGTH * p) / ((context >> shift & 0xFFFFFFFF) + STRENGTH)
        out.append(np.add.reduceat(np.log(p), np.cumsum(lengths) - lengths))
    return *out, lengths


#: Columns of the counts: class by class, fold by fold.
COUNTS = [(action, fold) for action in ("allow", "block") for fold in range(FOLDS)]


def count_model(examples: DataFrame) -> DataFrame:
    """examples (host, path, action, fold): key and a column for each of COUNTS, such as allow0: how often each context, and
    each with its next byte, is in the examples of that class and fold."""
    import pyarrow as pa

    names = [f"{action}{fold}" for action, fold in COUNTS]

    def parts(batches):
        import numpy as np

        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                texts = {}
                for r in whole.slice(at, 1024).to_pylist():
                    texts.setdefault((r["action"], r["fold"]), []).append(url_text(r["host"], r["path"]))
                for each, found in texts.items():
                    yield np.concatenate([x for pair in _keys(found)[0] for x in pair]), COUNTS.index(each)

    def tally(batches):
        for keys, n in summed(parts(batches), len(COUNTS)):
            yield pa.RecordBatch.from_arrays([pa.array(keys), *[pa.array(c) for c in n.T]], ["key", *names])

    counted = examples.select("host", "path", "action", "fold").mapInArrow(tally, ", ".join(f"{c} long" for c in ("key", *names)))
    return counted.groupBy("key").agg(*[F.sum(c).alias(c) for c in names])


def model_of(counts: DataFrame, without: int | None = None) -> DataFrame:
    """(key, allow, block): the counts of all folds, or of all but one."""
    total = {action: sum((F.col(f"{a}{fold}") for a, fold in COUNTS if a == action and fold != without), F.lit(0)) for action in ("allow", "block")}
    return counts.select("key", *[n.alias(action) for action, n in total.items()]).where("allow + block > 0")


def score(urls: DataFrame, model: DataFrame) -> DataFrame:
    """Adds score to urls (host, path and others): the allowed model's log-likelihood less the other's, a byte."""
    import pyarrow as pa

    most = F.lit((1 << 31) - 1)  # both counts in one number; larger ones, of which a few more make no difference, count as this
    table = model.select("key", (F.shiftleft(F.least("block", most), 32) + F.least("allow", most)).alias("value"))
    schema = T.StructType([*urls.schema.fields, T.StructField("score", T.DoubleType())])

    def texts(b):
        return [url_text(x, y) for x, y in zip(b.column(b.schema.get_field_index("host")).to_pylist(), b.column(b.schema.get_field_index("path")).to_pylist())]

    def keys_of(b):
        import numpy as np

        return np.concatenate([x for pair in _keys(texts(b))[0] for x in pair])

    def judge(b, keys, counts):
        allowed, blocked, n = log_likelihoods(texts(b), keys, counts) if b.num_rows else ([], [], 1)
        return pa.RecordBatch.from_arrays([*b.columns, pa.array((allowed - blocked) / n if b.num_rows else [], pa.float64())], [*b.schema.names, "score"])

    return with_table(urls, table, keys_of, judge, schema)


def best_cut(bins: list[tuple[int, int, int]]) -> float:
    """bins (bin, allowed, blocked): the lower edge of a bin with the least mean error; the lowest of equal ones nearest 0."""
    allowed, blocked = sum(b[1] for b in bins), sum(b[2] for b in bins)
    if not allowed or not blocked:
        return 0.0
    by = {b: (x, y) for b, x, y in bins}
    best, lost, kept = (2.0, 0.0, 0.0), 0, blocked
    for b in range(BINS):
        edge = -LIMIT + 2 * LIMIT * b / BINS
        best = min(best, (lost / allowed + kept / blocked, abs(edge), edge))
        x, y = by.get(b, (0, 0))
        lost, kept = lost + x, kept - y
    return best[2]


def errors_at(bins: list[tuple[int, int, int]], cut: float) -> tuple[float | None, float | None]:
    """The share of allowed URLs below the cut, and of blocked ones that aren't; None without any."""
    below = [-LIMIT + 2 * LIMIT * b / BINS < cut for b, _, _ in bins]
    allowed, blocked = sum(b[1] for b in bins), sum(b[2] for b in bins)
    lost, kept = sum(b[1] for b, low in zip(bins, below) if low), sum(b[2] for b, low in zip(bins, below) if not low)
    return lost / allowed if allowed else None, kept / blocked if blocked else None


@dataclass(frozen=True)
class UrlModel:
    """counts: of count_model; cut: None if a class has no example; the error rates are those of hosts not learnt from."""

    counts: DataFrame
    cut: float | None
    allowed_lost: float | None = None
    blocked_kept: float | None = None


def _with_parts(pages: DataFrame, id_col: str, url_col: str, rules) -> DataFrame:
    host, path = url_parts(F.col(url_col))
    return with_rule(pages.select(F.col(id_col), host.alias("host"), path.alias("path")), rules)


def fit(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> UrlModel:
    """Counts, cut and error rates of the URLs that rules decide."""
    # what the rule tests is left out: the end of the host and the beginning of the path
    own = {"host": F.expr("left(host, length(host) - length(rule_host))"), "path": F.expr("substring(path, length(rule_path) + 1)")}
    known = _with_parts(pages, id_col, url_col, rules).where("action is not null").withColumns(own)
    known = known.select("host", "path", "action", (F.crc32(F.col("host").cast("binary")) % FOLDS).cast("int").alias("fold"))
    counts = materialise(count_model(known))
    n = counts.agg(*[F.coalesce(F.sum(f"{action}{fold}"), F.lit(0)).alias(f"{action}{fold}") for action, fold in COUNTS]).head().asDict()
    left = {fold: [sum(n[f"{a}{f}"] for a, f in COUNTS if a == action and f != fold) for action in ("allow", "block")] for fold in (None, *range(FOLDS))}
    if 0 in left[None]:
        return UrlModel(counts, None)
    at = F.least(F.lit(BINS - 1), F.greatest(F.lit(0), F.floor((F.col("score") + LIMIT) * (BINS / (2 * LIMIT))).cast("int")))
    held = [score(known.where(F.col("fold") == fold), model_of(counts, fold)) for fold in range(FOLDS) if 0 not in left[fold] and n[f"allow{fold}"] + n[f"block{fold}"]]
    bins: dict[int, tuple[int, int, int]] = {}
    for one in held:  # at most BINS rows each
        for b, x, y in one.groupBy(at.alias("bin")).agg(F.count_if(F.col("action") == "allow"), F.count_if(F.col("action") == "block")).collect():
            bins[b] = (b, bins.get(b, (b, 0, 0))[1] + x, bins.get(b, (b, 0, 0))[2] + y)
    cut = best_cut(list(bins.values()))
    return UrlModel(counts, cut, *errors_at(list(bins.values()), cut))


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, model: UrlModel | None = None) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, score; with a model of its own if none is given."""
    model = model or fit(pages, id_col, url_col, rules)
    parts = _with_parts(pages, id_col, url_col, rules).drop("rule_host", "rule_path")
    if model.cut is None:
        return parts.select(id_col, "host", "path", "rule", F.coalesce("action", F.lit("allow")).alias("verdict"), F.lit(0.0).alias("score"))
    method = F.when(F.col("score") >= model.cut, "allow").otherwise("block")
    return score(parts, model_of(model.counts)).select(id_col, "host", "path", "rule", F.coalesce("action", method).alias("verdict"), "score")


def op9_url_filter(spark, sf_dir: str) -> DataFrame:
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))
