"""Toxicity, URL filter and the pipeline."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from corpuskiln.llm import common, toxicity, urlfilter

DATA = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, score string, passages string"


def brute_segments(values):
    """Ruzzo and Tompa's definition: the best segment (shortest, leftmost), then the same left and right of it."""
    best = None
    for a in range(len(values)):
        total = 0
        for b in range(a, len(values)):
            total += values[b]
            if total > 0 and (best is None or (total, -(b + 1 - a), -a) > best[0]):
                best = ((total, -(b + 1 - a), -a), a, b + 1)
    if best is None:
        return []
    (total, _, _), a, b = best
    move = lambda found, by: [(s, x + by, y + by) for s, x, y in found]
    return brute_segments(values[:a]) + [(total, a, b)] + move(brute_segments(values[b:]), b)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(-4, 4), max_size=30))
def test_maximal_segments(values):
    # distinct powers of two break ties that the definition leaves open
    exact = [v * 4096 + (1 << (k % 11)) * (k % 2 * 2 - 1) for k, v in enumerate(values)]
    got = [(round(s), a, b) for s, a, b in toxicity.maximal_segments(np.array(exact, float))]
    assert sorted(got) == sorted(brute_segments(exact)) == sorted((round(s), a, b) for s, a, b in plain_segments(np.array(exact, float)))


def plain_segments(values):
    """By the definition: the best segment (the shortest of equal ones, then the first), then those of what lies left and right."""
    out, waiting = [], [(0, len(values))]
    while waiting:
        a, b = waiting.pop()
        if a < b:
            up = np.append(0.0, np.cumsum(values[a:b], dtype=float))
            low = np.minimum.accumulate(up)
            gain = up[1:] - low[:-1]
            end = int(gain.argmax())
            if gain[end] > 0:
                start = int(np.flatnonzero(up[: end + 1] == low[end])[-1])
                out.append((float(gain[end]), a + start, a + end + 1))
                waiting += [(a, a + start), (a + end + 1, b)]
    return out


def test_lambda_solves_its_equation():
    bins = {40: 9000, 45: 500, 60: 40, 75: 3}
    lam = toxicity.solve_lambda(bins)
    total = sum(bins.values())
    assert sum(n / total * math.exp(lam * ((k + 0.5) / toxicity.PER_UNIT + toxicity.LOWEST)) for k, n in bins.items()) == pytest.approx(1, abs=1e-6)
    assert toxicity.solve_lambda({40: 5}) == 0 and toxicity.solve_lambda({}) == 0


@pytest.fixture(scope="module")
def scored(spark):
    return toxicity.op6_toxicity(spark, DATA).toPandas()


def test_held_out_accuracy(spark, scored):
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    assert len(scored) == spark.read.parquet(f"{DATA}/documents.parquet").count()
    assert (scored.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in scored.doc_id]).all()
    assert scored.score.between(0, 1).all() and ((scored.score >= 0.5).astype(int) == scored.predicted).all()
    mine = scored[scored.held_out & scored.doc_id.isin(list(truth))]
    want = mine.doc_id.map(truth)
    assert ((mine.predicted == want).mean()) > 0.93 and mine.predicted[want == 1].mean() >= 0.75 and mine.predicted[want == 0].mean() <= 0.05
    high, low = mine.score[want == 1].to_numpy(), mine.score[want == 0].to_numpy()
    assert (high[:, None] > low).mean() + (high[:, None] == low).mean() / 2 > 0.8


def test_passages_are_in_the_text(spark, scored):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    rows = [(texts[r.doc_id], p) for r in scored.itertuples() for p in r.passages]
    assert rows and all(0 <= p["start"] < p["stop"] <= len(t) and not t[p["start"] : p["stop"]][0].isspace() and p["log_e"] < math.log(toxicity.MAX_E) for t, p in rows)


def test_scores_do_not_use_labels_or_fold(spark):
    rng = random.Random(1)
    rows = [(k, " ".join(rng.choices(["calm", "sea", "blue", "sky", "wind", *(["vile"] * (k % 4 == 0))], k=40)), "x", "y") for k in range(400)]
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(400)] + [(3, None)], "doc_id long, toxic int")
    model = toxicity.fit(spark.createDataFrame(rows, SCHEMA), labels)
    odd = [(None, rows[4][1], "", ""), (4, rows[4][1], "", ""), (8, rows[4][1], "", ""), (9, None, "", ""), (10, "", "", ""), (11, "é" * 9 + " vile " * 9000, "", "")]
    got = {(r.doc_id, r.score, r.predicted) for r in toxicity.toxicity(spark.createDataFrame(odd, SCHEMA), model).collect()}
    assert len({s for i, s, _ in got if i in (None, 4, 8)}) == 1 and {p for i, _, p in got if i in (None, 4, 8, 11)} == {1} and {p for i, _, p in got if i in (9, 10)} == {0}
    left = toxicity.drop_toxic(spark.createDataFrame(rows, SCHEMA), model)
    assert left.columns == ["doc_id", "text", "score", "passages"] and left.where("doc_id % 4 != 0").count() == 300 and left.count() <= 303
    blank = toxicity.fit(spark.createDataFrame(rows, SCHEMA), labels.where("toxic = 0"))
    assert blank.empty and toxicity.toxicity(spark.createDataFrame(rows, SCHEMA), blank).where("score != 0").count() == 0
    assert toxicity.drop_toxic(spark.createDataFrame([], SCHEMA), model).count() == toxicity.toxicity(spark.createDataFrame([], SCHEMA), model).count() == 0


def test_passages_significant_by_a_low_k(spark):
    """With log_k below ln(0.05), passages whose ln E with K = 1 is 0 or more are significant too."""
    keys, _, _ = toxicity.word_keys("vile calm")
    scores = spark.createDataFrame([(int(keys[0, 0]), 3.0), *((int(k), -1.0) for k in keys[:, 1])], "key long, value float")
    text = "calm " * 30 + "vile vile " + "calm " * 30
    docs = spark.createDataFrame([(1, text, "", "")], SCHEMA)
    plain = toxicity.Model(scores, 0.6, 0.0, [1.0, 1.0, -2.0], False)
    best = toxicity.toxicity(docs, plain).head()
    assert best.best_log_e > 0 and not best.passages
    low = toxicity.Model(scores, 0.6, -5.0, [1.0, 1.0, -2.0], False)
    got = toxicity.toxicity(docs, low).head()
    assert [text[p.start : p.stop] for p in got.passages] == ["vile vile"] and got.passages[0].log_e == pytest.approx(best.best_log_e - 5)
    assert got.score == pytest.approx(1 / (1 + math.exp(2 - 2 * math.log1p(-got.best_log_e))))


def plain_words(text):
    """Each word, and its beginnings, each with its length."""
    words = [w.lower() for w in re.findall(rb"[0-9A-Za-z_\x80-\xff]+", (text or "").encode())]
    return [[(0, w), *((k, w[:k]) for k in toxicity.PREFIXES)] for w in words]


def plain_scores(docs, labels, errors):
    """The operator as its docstring tells it, word by word, in Python: (id, score, best ln E)."""
    fold = {i: zlib.crc32(str(i).encode()) % 5 for i in docs}
    words = {i: plain_words(t) for i, t in docs.items()}
    counts = [collections.Counter(), collections.Counter()]
    for i, toxic in labels:
        if fold[i] in (1, 2, 3):
            counts[toxic].update(f for w in words[i] for f in w)
    totals = [c.total() for c in counts]
    mass, table = toxicity.PRIOR * totals[1], {}
    for f in {*counts[0], *counts[1]}:
        prior = mass * (counts[0][f] + counts[1][f]) / sum(totals)
        delta = math.log((counts[1][f] + prior) / (totals[1] + mass)) - math.log((counts[0][f] + prior) / (totals[0] + mass))
        excess = abs(delta) - errors * math.sqrt(sum(1 / (c[f] + prior) for c in counts))
        if excess > 0:
            table[f] = np.float32(math.copysign(excess, delta))
    values = {i: np.array([max(table.get(f, np.float32(0)) for f in w) - toxicity.TOLL for w in ws], np.float32) for i, ws in words.items()}
    bins, extra = collections.Counter(), set()
    where = lambda v: int(min(max((v - toxicity.LOWEST) * toxicity.PER_UNIT, 0), toxicity.BINS - 1))
    held = [(i, toxic) for i, toxic in labels if fold[i] == 4]
    for i, toxic in held:
        for v in values[i]:
            if toxic:
                extra.add(where(v))
            else:
                bins[where(v)] += 1
    for k in {*extra, where(max(table.values()) - toxicity.TOLL)}:
        bins[k] = max(bins[k], 1)
    lam = toxicity.solve_lambda(dict(bins))
    if not lam:
        return None
    log_e = {i: [math.log(len(v)) - lam * s for s, _, _ in plain_segments(v)] for i, v in values.items()}
    mean = [-min(log_e[i]) for i, toxic in held if not toxic and log_e[i]]
    log_k = sum(mean) / len(mean) - 0.5772156649015329 if mean else -0.5772156649015329
    clip = lambda x: math.log1p(min(max(x, 0.0), 60.0))
    inputs = {i: (clip(-min(e) - log_k) if e else 0.0, clip(sum(-x - log_k for x in e if x + log_k < math.log(toxicity.MAX_E)))) for i, e in log_e.items()}
    weights = toxicity.BY_PASSAGE
    if {t for _, t in held} == {0, 1}:
        weights = toxicity.fit_curve(np.array([inputs[i] for i, _ in held]), np.array([t for _, t in held], float))
        weights = weights if max(weights[:-1]) > 0 else toxicity.BY_PASSAGE
    return {i: (1 / (1 + math.exp(-(weights[0] * x + weights[1] * y + weights[2]))), min(log_e[i]) + log_k if log_e[i] else None) for i, (x, y) in inputs.items()}


def test_blocks_end_by_rows_and_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(common, "BLOCK_ROWS", 4)
    monkeypatch.setattr(common, "BLOCK_BYTES", 100)
    sizes = [5, 5, 5, 5, 5, 300, 60, 60, 0, None, 40]
    rows = spark.createDataFrame([(k, None if n is None else "x" * n) for k, n in enumerate(sizes)], "id int, text string").coalesce(1)
    blocks = collections.defaultdict(list)
    for r in common.in_blocks(rows).collect():
        blocks[r["__block"]].append(r.id)
    assert sorted(blocks.values()) == [[0, 1, 2, 3], [4], [5], [6], [7, 8, 9, 10]]
    assert common.in_blocks(rows.select("text", "id")).groupBy("__block").count().agg({"count": "max"}).head()[0] == 4
    assert common.in_blocks(rows.limit(0)).collect() == []


@pytest.mark.parametrize("most", [None, 0])
def test_scores_against_plain_python(spark, monkeypatch, most):
    """The whole query on sf0.001, whose few labels need less shrinkage; with the model's table sent to all tasks, and joined."""
    if most is not None:
        monkeypatch.setattr(common, "MOST_ROWS", most)
    small = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    labels = [(r.doc_id, r.toxic) for r in spark.read.parquet(f"{small}/labels.parquet").where("toxic IS NOT NULL").collect() if r.doc_id in docs]
    want = next(w for w in (plain_scores(docs, labels, e) for e in toxicity.ERRORS) if w)
    got = toxicity.op6_toxicity(spark, small)
    assert got.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    rows = got.collect()
    assert len(rows) == len(docs) and len({round(r.score, 6) for r in rows}) >= 3
    for r in rows:
        score, best = want[r.doc_id]
        assert r.score == pytest.approx(score, abs=1e-4) and (r.best_log_e is None) == (best is None) and (best is None or r.best_log_e == pytest.approx(best, abs=1e-3))


def test_without_toxic_rows_in_the_fold_of_the_curve(spark):
    rows = [(k, "calm sea blue sky " * 9 + ("vile " * 9 if k % 4 == 0 else ""), "x", "y") for k in range(300)]
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(300) if k % 4 or zlib.crc32(str(k).encode()) % 5 != 4], "doc_id long, toxic int")
    model = toxicity.fit(spark.createDataFrame(rows, SCHEMA), labels)
    assert model.weights == toxicity.BY_PASSAGE and not model.empty
    assert all(r.predicted == (r.doc_id % 4 == 0) for r in toxicity.toxicity(spark.createDataFrame(rows, SCHEMA), model).collect())


URLS = [None, "", "no scheme", "http://Example.NET/en/x", "https://a.example.net:80/en/", "http://net", "http://x.NET/fr", "ftp://example.com/de/?q#f", "http://www.example.com/den", "http://s.org/fr/é", "http://org#/fr/", "a://b://c/d", "HTTP://ÉX.net/", "http://?x", "http://org/fr/" + "y" * 9000, "http://internet/"]


def plain_judgement(url):
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", "", None
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fits = [h + p for _, h, p in urlfilter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits, key=len, default=None)


def test_hosts_paths_and_rules(spark):
    rows = spark.createDataFrame([(k, u, "html", "clash") for k, u in enumerate([*URLS, URLS[3]])], "page_id long, url string, html string, host string")
    got = urlfilter.judge_urls(rows).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule) for r in got] == [plain_judgement(u) for u in [*URLS, URLS[3]]]
    action = {h + p: a for a, h, p in urlfilter.RULES}
    assert all(r.verdict == action[r.rule] for r in got if r.rule) and {r.verdict for r in got} <= {"allow", "block"}
    assert urlfilter.judge_urls(rows.limit(0)).count() == 0
    assert {r.verdict for r in urlfilter.judge_urls(rows.where("page_id < 3")).collect()} == {"allow"}


def plain_log_likelihood(text, counts):
    """The smoothing, context by context."""
    data, total = b"\0" * urlfilter.ORDER + text + b"\1", 0.0
    for k in range(urlfilter.ORDER, len(data)):
        p = 1 / 257
        for order in range(urlfilter.ORDER + 1):
            ctx = data[k - order : k]
            p = (counts[ctx, data[k]] + urlfilter.STRENGTH * p) / (counts[ctx] + urlfilter.STRENGTH)
        total += math.log(p)
    return total


@pytest.mark.parametrize("most", [None, 0])
def test_verdicts_against_plain_python(spark, monkeypatch, most):
    """The whole query on sf0.001: rules, models of what rules leave, cut and the verdicts of undecided URLs."""
    if most is not None:
        monkeypatch.setattr(common, "MOST_ROWS", most)
    pages = [(r.page_id, r.url) for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()]
    rule_of = {h + p: (a, h, p) for a, h, p in urlfilter.RULES}
    judged = {i: plain_judgement(u) for i, u in pages}
    known, counts = [], {(action, fold): collections.Counter() for action in ("allow", "block") for fold in range(5)}
    for host, path, rule in judged.values():
        if rule:
            action, h, p = rule_of[rule]
            host, text = host[: len(host) - len(h)], urlfilter.url_text(host[: len(host) - len(h)], path[len(p) :])
            fold = zlib.crc32(host.encode()) % 5
            known.append((action, fold, text))
            data = b"\0" * urlfilter.ORDER + text + b"\1"
            for k in range(urlfilter.ORDER, len(data)):
                for order in range(urlfilter.ORDER + 1):
                    counts[action, fold][data[k - order : k]] += 1
                    counts[action, fold][data[k - order : k], data[k]] += 1
    learnt = {(action, out): sum((counts[action, fold] for fold in range(5) if fold != out), collections.Counter()) for action in ("allow", "block") for out in (None, *range(5))}
    score = lambda t, out=None: (plain_log_likelihood(t, learnt["allow", out]) - plain_log_likelihood(t, learnt["block", out])) / (len(t) + 1)
    bins, scored = collections.defaultdict(lambda: [0, 0]), []
    for action, fold, text in known:
        if learnt["allow", fold] and learnt["block", fold]:
            at = min(max(math.floor((score(text, fold) + urlfilter.LIMIT) * urlfilter.BINS / (2 * urlfilter.LIMIT)), 0), urlfilter.BINS - 1)
            bins[at][action == "block"] += 1
            scored.append((action, -urlfilter.LIMIT + 2 * urlfilter.LIMIT * at / urlfilter.BINS))
    cut = urlfilter.best_cut([(b, x, y) for b, (x, y) in bins.items()])
    model = urlfilter.fit(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"))
    share = lambda action, wrong: sum(wrong(x) for a, x in scored if a == action) / sum(a == action for a, _ in scored)
    assert model.cut == cut and model.allowed_lost == share("allow", lambda x: x < cut) and model.blocked_kept == share("block", lambda x: x >= cut)
    got = urlfilter.op9_url_filter(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(pages) and {r.rule is None for r in got} == {True, False}
    for r in got:
        host, path, rule = judged[r.page_id]
        want = score(urlfilter.url_text(host, path))
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.score == pytest.approx(want, abs=1e-9)
        assert r.verdict == (rule_of[rule][0] if rule else "allow" if want >= cut else "block")


def test_verdicts_beyond_the_rules(spark):
    """Hosts that no rule tests get the verdict of the paths like theirs."""
    rng = random.Random(6)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(9))
    rows = [(k, f"http://{'a' if k % 2 else 'b'}.{'example.net/en' if k % 2 else 'net'}/{word('abcd' if k % 2 else 'wxyz')}") for k in range(600)]
    rows += [(1000 + k, f"http://other.info/{word('abcd' if k % 2 else 'wxyz')}") for k in range(200)]
    got = urlfilter.judge_urls(spark.createDataFrame(rows, "page_id long, url string")).where("rule IS NULL").collect()
    assert len(got) == 200 and sum(r.verdict == ("allow" if r.page_id % 2 else "block") for r in got) >= 195


def test_error_rates_are_of_hosts_not_learnt_from(spark):
    """Hosts alone tell nothing of other hosts, paths do; a hot host has a third of the rows; one host a class calibrates nothing."""
    rng = random.Random(8)
    word = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    hosts = [word("klmnop", 8) for _ in range(40)]
    urls = lambda paths: [
        (k, f"http://{hosts[k % 2] if k % 3 == 0 else hosts[k % 40]}.{'example.net/en' if k % 2 else 'net'}/{word((paths if k % 2 else 'wxyz') if paths else 'stuv', 9)}") for k in range(1200)
    ]
    fit = lambda rows: urlfilter.fit(spark.createDataFrame(rows, "page_id long, url string"))
    told, blind = fit(urls("abcd")), fit(urls(""))
    assert told.allowed_lost <= 0.03 and told.blocked_kept <= 0.03
    assert (blind.allowed_lost + blind.blocked_kept) / 2 > 0.2  # folds of URLs would say that hosts tell all
    alone = fit([(k, f"http://{'a.example.net/en' if k % 2 else 'b.net'}/{k}") for k in range(50)])
    assert alone.cut == 0 and alone.allowed_lost is None and alone.blocked_kept is None
    assert fit([(1, "http://a.net/x"), (2, None)]).cut is None


def test_summed_counts_in_parts():
    rng = random.Random(2)
    parts = [(np.array([rng.randrange(-40, 40) for _ in range(rng.randrange(60))], np.int64), rng.randrange(2)) for _ in range(50)]
    want = collections.Counter((k, c) for keys, c in parts for k in keys.tolist())
    for most in (10, 30, 1 << 20):
        got = collections.Counter()
        for keys, n in common.summed(iter(parts), 2, most):
            assert len(set(keys.tolist())) == len(keys) <= most + 80
            got.update({(k, c): int(n[i, c]) for i, k in enumerate(keys.tolist()) for c in (0, 1)})
        assert +got == want
    keys = np.sort(np.array([rng.getrandbits(64) - (1 << 63) for _ in range(500)]))
    asked = np.concatenate([keys[::7], keys[:50] + 1]).reshape(-1, 2) if (len(keys[::7]) + 50) % 2 == 0 else np.concatenate([keys[::7], keys[:49] + 1]).reshape(-1, 2)
    known = dict(zip(keys.tolist(), range(500)))
    assert common.values_at(keys, np.arange(500), asked).tolist() == [[known.get(k, 0) for k in row] for row in asked.tolist()]
    assert common.values_at(keys[:0], np.arange(0), asked).sum() == 0


def test_cut():
    assert urlfilter.best_cut([]) == 0.0 and urlfilter.best_cut([(5, 3, 0)]) == 0.0
    at = lambda x: int((x + urlfilter.LIMIT) * urlfilter.BINS / (2 * urlfilter.LIMIT))
    assert -1 < urlfilter.best_cut([(at(-1), 1, 9), (at(1), 9, 1)]) <= 1


def test_pipeline(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    names, kept = [n for n, _ in corpus_pipeline.STAGES], []
    for name, stage in corpus_pipeline.STAGES:
        from corpuskiln.llm.common import materialise

        docs = materialise(stage(spark, docs, DATA))
        kept.append(docs.count())
        if name != names[-1]:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert 1000 > kept[0] > kept[1] > kept[2] > 700 and kept[3] == kept[4] > 0
    got = corpus_pipeline.run(spark, DATA)
    assert sorted((r.doc_id, r.n_ids) for r in got.select("doc_id", "n_ids").collect()) == sorted((r.doc_id, r.n_ids) for r in docs.select("doc_id", "n_ids").collect())


def test_pipeline_against_plain_python(spark):
    """All five stages on sf0.001, each by brute force on what the one before has kept."""
    import hashlib

    import sentencepiece
    from test_dedup import brute_classes
    from test_exact_and_mixing import filled, norm

    from corpuskiln.llm import pieces

    small = "/root/testdata/sf0.001"
    docs = {r.doc_id: (r.text, r.source) for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    labels = [(r.doc_id, r.toxic) for r in spark.read.parquet(f"{small}/labels.parquet").where("toxic IS NOT NULL").collect() if r.doc_id in docs]
    scores = next(w for w in (plain_scores({i: t for i, (t, _) in docs.items()}, labels, e) for e in toxicity.ERRORS) if w)
    kept = {i: d for i, d in docs.items() if scores[i][0] < 0.5}
    best = {}
    for i, (t, _) in kept.items():
        best[norm(t)] = max(i, best.get(norm(t), i))
    kept = {i: kept[i] for i in best.values()}
    ids = sorted(kept)
    group = brute_classes([(i, kept[i][0]) for i in ids])[2]
    kept = {ids[g]: kept[ids[g]] for g in set(group)}
    size = {i: len(re.findall("[^\x20\x09-\x0d]+", t or "")) for i, (t, _) in kept.items()}
    names = sorted({s for _, s in kept.values()})
    of = {s: sum(size[i] for i in kept if kept[i][1] == s) for s in names}
    want = {}
    for s, target in zip(names, filled([of[s] for s in names], [k % 3 + 1 for k in range(len(names))])):
        whole = int(target // of[s]) if of[s] else 0
        rest, total, cut = target - whole * of[s], 0, -1
        for h, i in sorted((int(hashlib.md5(f"17:{i}".encode()).hexdigest()[:15], 16), i) for i in kept if kept[i][1] == s):
            total += size[i]
            want[i] = whole
            if rest > 0 and total - size[i] / 2 <= rest:
                cut = h
        for i in kept:
            if kept[i][1] == s and int(hashlib.md5(f"17:{i}".encode()).hexdigest()[:15], 16) <= cut:
                want[i] += 1
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    expected = collections.Counter({(i, tuple(library.encode(kept[i][0] or ""))): n for i, n in want.items() if n})
    got = collections.Counter((r.doc_id, tuple(r.ids)) for r in corpus_pipeline.run(spark, small).collect())
    assert got == expected and len(docs) > len(kept) > 100
