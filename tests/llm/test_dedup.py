"""Substring, line and near-duplicate operators against brute force."""

import collections
import itertools
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpuskiln.llm import common, jaccard, linededup, substring
from corpuskiln.llm.words import mixed, words_of

SCHEMA = "doc_id long, text string, rank string, line string"


def corpus(spark, n=120):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").limit(n).collect()]
    rng = random.Random(7)
    passage = "Über allen Gipfeln ist Ruh, in allen Wipfeln spürest du kaum einen Hauch. Die Vögelein schweigen im Walde, warte nur. Balde ruhest du auch!"
    extra = []
    for k in range(60):
        base = rng.choice(docs)[1].split(" ")
        at = rng.randrange(len(base))
        kind = k % 4
        if kind == 0:
            base.insert(at, passage)
        elif kind == 1:
            base[at] = "changed"
        elif kind == 2:
            base = [w.upper() if rng.random() < 0.02 else w for w in base]
        else:
            base[at] = base[at] + "x"
        extra.append((1000 + k, " ".join(base)))
    rows = docs + extra + [(None, docs[3][1]), (None, "short one"), (2000, None), (2001, ""), (2002, "?!"), (2003, "a b"), (2004, "A, b."), (docs[5][0], docs[5][1]), (2005, "x " * 3000), (2006, "x " * 3000)]
    return [(i, t, "clash", "clash") for i, t in rows]


@pytest.fixture(scope="module")
def rows(spark):
    return corpus(spark)


def ranks(spark, rows):
    """Each row's rank; of rows that are alike but for it, any."""
    found = collections.defaultdict(list)
    for r in common.ranked_rows(spark.createDataFrame([(i, t) for i, t, *_ in rows], spark.createDataFrame(rows[:1], schema_of(rows)).select("doc_id", "text").schema), "doc_id", "text").collect():
        found[r.id, r.text].append(r.rank)
    return [found[i, t or ""].pop() for i, t, *_ in rows]


def schema_of(rows):
    return SCHEMA.replace("long", "string", 1) if any(isinstance(r[0], str) for r in rows) else SCHEMA


def named(rows):
    """The same rows with texts as ids, in another order, and two null-id copies of one text."""
    return [(None if i is None else f"id-{i * 7919 % 10007}", *rest) for i, *rest in rows]


WORD = re.compile("[0-9a-zA-Z_\x80-\U0010ffff]+")


def lowered(text):
    return re.sub("[A-ZÀ-ÖØ-Þ]", lambda m: m[0].lower(), text)


def plain_units(text, n, window):
    """Lines and passages as the docstring says, by regular expressions; only anchors come from the code."""
    out, at = [], 0
    for line in text.splitlines(keepends=True) if not re.search("[\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]", text) else re.findall("[^\n]*\n|[^\n]+", text):
        words = WORD.findall(lowered(line))
        if words or line.strip(" \t\n\r\x0b\x0c"):
            out.append((at, at + len(line), ("line", *words) if words else line.strip(" \t\n\r\x0b\x0c")))
        at += len(line)
    words = [(m.start(), m.end()) for m in WORD.finditer(text)]
    anchored = substring.anchors(words_of(lowered(text), False)[0], window)
    starts = [k for k, (a, b) in enumerate(words) if k == 0 or anchored[k] or re.search("[.!?\n]", text[words[k - 1][1] : a])]
    edges = [*starts, len(words)]
    for p in starts if len(words) >= n else []:
        q = next((e for e in edges if e >= p + n), None)
        if q is not None:
            out.append((0 if p == 0 else words[p][0], len(text) if q == len(words) else words[q][0], tuple(lowered(text[a:b]) for a, b in words[p:q])))
    return out


SHORT = "Accept all cookies here\nOf.\n---\n  \n***\nof\n--- "


@pytest.mark.parametrize("ids", ["whole", "text"])
def test_substring_dedup_against_brute_force(spark, rows, ids):
    n, window = 6, 9
    rows = [*rows, *[(4000 + k, f"own line {k}\n{SHORT}\nlast {k}", "", "") for k in range(3)], *[(None, SHORT, "", "")] * 3]
    if ids == "text":
        rows = named(rows[::3]) + named(rows[-6:])
    rank = ranks(spark, rows)
    first = {}
    for r, (_, t, *_) in zip(rank, rows):
        for *_, u in plain_units(t or "", n, window):
            first[u] = min(first.get(u, r), r)
    want = []
    for r, (i, t, *_) in zip(rank, rows):
        t, gone, mine, count = t or "", set(), {}, [0, 0]
        for a, b, u in plain_units(t, n, window):
            if first[u] < r or mine.setdefault(u, b) <= a:
                gone |= set(range(a, b))
                count[isinstance(u, tuple) and u[:1] != ("line",)] += 1
        want.append((i, *count, len(gone), "".join(c for k, c in enumerate(t) if k not in gone)))
    got = substring.substring_dedup(spark.createDataFrame(rows, schema_of(rows)).repartition(6), min_words=n, window=window).collect()
    assert sorted(((r.doc_id, r.n_lines_removed, r.n_passages_removed, r.chars_removed, r.clean_text) for r in got), key=repr) == sorted(want, key=repr)
    texts = collections.defaultdict(list)
    for i, t, *_ in rows:
        texts[i].append(t or "")
    for r in got:  # offsets lead back to the clean text
        assert any("".join(t[a:b] for a, b in zip([0, *[s.stop for s in r.removed]], [*[s.start for s in r.removed], len(t)])) == r.clean_text for t in texts[r.doc_id])
        assert r.longest_removed >= substring.SPAN_WORDS if r.n_removed else r.longest_removed < substring.SPAN_WORDS
    if ids == "whole":
        later = [r for r in got if r.doc_id and 1004 <= r.doc_id < 1060 and (r.doc_id - 1000) % 4 == 0]
        assert later and all("Walde, warte nur" not in r.clean_text for r in later)
        assert {re.sub("\\s+", " ", r.clean_text) for r in got if r.doc_id in (4001, 4002)} == {"own line 1 last 1", "own line 2 last 2"}  # short lines go as well
    assert sorted(r.clean_text for r in got if r.doc_id is None and not r.clean_text.strip())  # null-id copies lose what the first has
    assert substring.substring_dedup(spark.createDataFrame([], SCHEMA)).count() == 0


def test_anchors_by_definition():
    rng = random.Random(4)
    for n in (0, 1, 12, 13, 40, 300):
        words = np.array([rng.getrandbits(64) >> rng.choice((0, 62)) for _ in range(n)], np.uint64)
        h = [int(mixed(np.array([(int(a) + int(b) * 0xD6E8FEB86659FD93) % 2**64], np.uint64))[0]) for a, b in zip(words, words[1:])]
        want = {k for at in range(len(h) - 11) for k in range(at, at + 12) if h[k] == min(h[at : at + 12])}
        assert set(np.flatnonzero(substring.anchors(words, 12)).tolist()) == want


def test_passages_cut_inside_a_sentence(spark, tmp_path):
    """Lower case, no marks: 60 words that start and stop anywhere in two texts are found, all but what a cut at each end may cost."""
    rng = random.Random(5)
    made = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    passages = [made(60) for _ in range(40)]
    docs = [(k, " ".join([*made(rng.randrange(5, 90)), *p, *made(rng.randrange(5, 90))])) for k, p in enumerate(passages * 2)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in substring.op4_substring_dedup(spark, str(tmp_path)).collect()}
    kept = 0
    for k, p in enumerate(passages):
        assert got[k].chars_removed == 0 and got[k].clean_text == docs[k][1]
        left, gone = got[40 + k].clean_text.split(), [docs[40 + k][1][x.start : x.stop].split() for x in got[40 + k].removed]
        assert all(set(g) <= set(p) for g in gone) and len(set(left) & set(p)) <= 42 and gone and got[40 + k].n_passages_removed
        assert set(docs[40 + k][1].split()) - set(p) <= set(left)
        kept += len(set(left) & set(p))
    assert kept < 40 * 20


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


@pytest.mark.parametrize("ids, edits", [("whole", 1), ("text", 1), ("whole", 2), ("whole", 0)])
def test_line_dedup_against_brute_force(spark, rows, ids, edits):
    rng = random.Random(2)
    lines = [x for _, t, *_ in rows for x in (t or "").split("\n") if x and (edits < 2 or len(x) < 60)]
    lines += ["a cat sat", "a bat sat", "a", "b", "日", "x y", "xy", "- 1 -", "- 2 -", "Page 10", "Page 1", "é"] * 9
    more = []
    for k in range(80):
        made = []
        for _ in range(4):
            x = rng.choice(lines)
            for _ in range(rng.randrange(1, edits + 2)):
                at, how = rng.randrange(len(x) + 1), rng.randrange(4)
                x = x if how == 3 else x[:at] + ("q" if how else "") + x[at + (how != 1) :]
            made.append(x)
        more.append((3000 + k, "\n".join(made), "", ""))
    rows = [*(r for r in rows if edits < 2 or all(len(x) < 60 for x in (r[1] or "").split("\n"))), *more, *[(None, "a line twice\nover", "", "")] * 3]
    if ids == "text":
        rows = named(rows)
    rank = ranks(spark, rows)
    occurrences = sorted((r, n, linededup.normal(x)) for r, (_, t, *_) in zip(rank, rows) for n, x in enumerate((t or "").split("\n")) if linededup.normal(x))
    first, by_size = {}, collections.defaultdict(list)
    for r, n, x in occurrences:
        if x not in first:
            first[x] = (r, n)
            by_size[len(x)].append(x)

    def close(x, y):  # a difference of counted characters bounds the distance from below
        if edits < 2 and len(x) > 12:
            k = next((k for k, (c, d) in enumerate(zip(x, y)) if c != d), min(len(x), len(y)))
            return any(x[k + i :] == y[k + j :] for i, j in ((1, 1), (0, 1), (1, 0)))
        return ((c := collections.Counter(x)) - (d := collections.Counter(y))).total() <= edits >= (d - c).total() and distance(x, y) <= edits

    near = {x for x in first if edits and any(first[y] < first[x] and close(x, y) for m in range(-edits, edits + 1) for y in by_size[len(x) + m] if y != x)}
    assert len(near) > 50 or not edits
    want = []
    for r, (i, t, *_) in zip(rank, rows):
        seen, lost = set(), []
        for n, x in enumerate((t or "").split("\n")):
            if x := linededup.normal(x):
                if x in near or x in seen or first[x][0] < r:
                    lost.append(n)
                seen.add(x)
        want.append((i, len((t or "").split("\n")), lost))
    got = linededup.line_dedup(spark.createDataFrame(rows, schema_of(rows)).repartition(5), edits=edits).collect()
    assert sorted(((r.doc_id, r.n_lines, list(r.dropped)) for r in got), key=repr) == sorted(want, key=repr)
    assert sum(r.n_near for r in got) >= len(near)
    assert linededup.line_dedup(spark.createDataFrame([], SCHEMA)).count() == 0


def test_drop_lines(spark):
    docs = spark.createDataFrame([(1, "a line here\nsame old line", "r", "l"), (2, "same old lime\nnew text line\n\n", "r", "l"), (None, "same old line", "r", "l"), (4, None, "r", "l")], SCHEMA.replace("rank", "row").replace("line", "lost"))
    left = linededup.drop_lines(docs, linededup.line_dedup(docs)).orderBy(F.col("doc_id").asc_nulls_last()).collect()
    assert [(r.text, r.row, r.lost) for r in left] == [("a line here\nsame old line", "r", "l"), ("new text line\n\n", "r", "l"), (None, "r", "l"), ("same old line", "r", "l")]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abcé", min_size=1, max_size=24), st.lists(st.tuples(st.integers(0, 30), st.sampled_from("acx"), st.integers(0, 2)), max_size=2))
def test_keys_within_the_bound_are_shared(a, steps):
    b, edits = a, len(steps)
    for at, c, how in steps:
        at %= len(b) + 1
        b = b[:at] + (c if how else "") + b[at + (how != 1) :]
    if not b:
        return
    assert set(linededup.part_keys(a, edits)) & set(linededup.part_keys(b, edits))
    if edits == 1:
        assert set(linededup.segment_keys(a)) & set(linededup.segment_keys(b))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abc", min_size=1, max_size=6), st.text(alphabet="abc", min_size=1, max_size=6), st.integers(0, 2))
def test_neighbourhoods_meet_within_the_bound_alone(a, b, edits):
    keys = [collections.defaultdict(list) for _ in "ab"]
    for to, text in zip(keys, (a, b)):
        for v1, v2, unmatched, matched in (row for part in linededup.neighbourhood(text, edits) for row in zip(*(x.tolist() for x in part))):
            to[v1, v2].append((unmatched, edits - matched))
    meet = any(x + y <= budget for k in keys[0].keys() & keys[1].keys() for x, budget in keys[0][k] for y, _ in keys[1][k])
    assert meet == (distance(a, b) <= edits)


def brute_classes(rows):
    sets = [frozenset(jaccard.shingle_set(t or "").tolist()) for _, t, *_ in rows]
    links = collections.defaultdict(set)
    for x, y in itertools.combinations(range(len(rows)), 2):
        a, b = sets[x], sets[y]
        if len(a & b) * 10 >= 8 * len(a | b):
            links[x].add(y)
            links[y].add(x)
    group = list(range(len(rows)))
    for x in range(len(rows)):
        stack, seen = [x], {x}
        while stack:
            for y in links[stack.pop()] - seen:
                seen.add(y)
                stack.append(y)
        group[x] = min(seen)
    return sets, links, group


def test_jaccard_against_brute_force(spark, rows):
    sets, links, group = brute_classes(rows)
    members = collections.defaultdict(list)
    for k, g in enumerate(group):
        members[g].append(rows[k][0])
    want = [(rows[k][0], min((i for i in members[g] if i is not None), default=None), len(members[g]), len(links[k]), len({sets[j] for j in links[k]} - {sets[k]})) for k, g in enumerate(group)]
    assert sum(len(m) > 1 for m in members.values()) > 20
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    got = jaccard.similar_groups(df).collect()
    assert sorted((tuple(r) for r in got), key=repr) == sorted(want, key=repr)
    left = jaccard.drop_near_copies(df)
    assert left.columns == df.columns
    kept = collections.Counter(r.doc_id for r in left.collect())
    assert kept == collections.Counter(min((i for i in m if i is not None), default=None) for m in members.values())


def test_small_blocks_lose_nothing(spark, rows, monkeypatch):
    """A group over many blocks gives what one block gives."""
    base = "one two three four five six seven eight nine ten " * 4
    near = [(k, " ".join([*base.split(), *(f"w{k}_{n}" for n in range(3))]), "", "") for k in range(90)]
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    got = {r.doc_id: r for r in jaccard.similar_groups(spark.createDataFrame(near, SCHEMA)).collect()}
    _, links, _ = brute_classes(near)
    assert {k: r.n_links for k, r in got.items()} == {k: len(links[k]) for k in range(90)}


def test_empty_and_lonely(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert jaccard.similar_groups(none).count() == jaccard.drop_near_copies(none).count() == 0
    one = spark.createDataFrame([(1, None, "", ""), (2, "", "", ""), (3, "words here", "", "")], SCHEMA)
    assert sorted(tuple(r) for r in jaccard.similar_groups(one).collect()) == [(1, 1, 2, 1, 0), (2, 1, 2, 1, 0), (3, 3, 1, 0, 0)]


def test_pruning_keeps_pairs_at_the_threshold():
    least = jaccard.least_matches()
    assert least == sorted(least) and least[0] >= 1 and least[-1] < 0.8 * 128
    assert jaccard.least_matches(tolerance=1e-3)[-1] > least[-1]


def test_components(spark):
    chain = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 130)] + [(200, 201), (201, 200), (7, 7)]
    got = {r.node: r.root for r in common.connected(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert len({got[k] for k in range(61)}) == 1 and len({got[k] for k in range(100, 130)}) == 1 and got[200] == got[201]
    assert len(set(got.values())) == 3 and len(got) == 61 + 30 + 2
    assert common.connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_drawn_orders_are_bijections(spark):
    rows = spark.createDataFrame([(x,) for x in (0, 1, -1, 5, 1 << 33, (1 << 63) - 1, -(1 << 63), *range(1000, 1400))], "n long")
    got = rows.select("n", *[common._drawn(F.col("n"), k).alias(f"d{k}") for k in range(3)]).select("*", *[common._undrawn(F.col(f"d{k}"), k).alias(f"u{k}") for k in range(3)]).collect()
    assert all(r.n == r.u0 == r.u1 == r.u2 for r in got) and all(len({r[f"d{k}"] for r in got}) == len(got) for k in range(3))
    order = lambda k: sorted(range(len(got)), key=lambda i: got[i][f"d{k}"])
    assert order(0) != order(1) != order(2)


def test_spread_join(spark):
    big = spark.createDataFrame([(1, k) for k in range(500)] + [(2, 7), (3, 8)], "key long, x long")
    small = spark.createDataFrame([(1, "a"), (2, "b"), (4, "c")], "key long, v string")
    inner = common.spread_join(big, small, "key", F.col("x")).collect()
    assert sorted((r.key, r.x, r.v) for r in inner) == sorted([(1, k, "a") for k in range(500)] + [(2, 7, "b")])
    left = common.spread_join(big, small, "key", F.col("x"), "left").collect()
    assert {r.x: r.v for r in left if r.key == 3} == {8: None} and len(left) == 502


def thue_morse(n, a, b):
    return [b if bin(k).count("1") % 2 else a for k in range(n)]


def test_lines_that_sums_modulo_two_to_the_64_mix_up(spark):
    """Words, and letters of one word, in the order of Thue and Morse and with the two changed over."""
    pairs = [(" ".join(thue_morse(2048, "ab", "cd")), " ".join(thue_morse(2048, "cd", "ab"))), ("".join(thue_morse(2048, "a", "b")), "".join(thue_morse(2048, "b", "a")))]
    rows = [(2 * k + j, pair[j]) for k, pair in enumerate(pairs) for j in (0, 1)] + [(9, pairs[0][0] + "\nrest")]
    got = {r.doc_id: r.clean_text for r in substring.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string"), min_words=None).collect()}
    assert got == dict(rows) | {9: "rest"}
    groups = jaccard.similar_groups(spark.createDataFrame(rows[:4], "doc_id long, text string")).collect()
    assert len({r.class_id for r in groups if r.doc_id > 1}) == 2


def test_long_lines_in_bounded_parts():
    import resource

    from corpuskiln.llm import linededup

    line = "".join(thue_morse(1_000_000, "a", "b"))
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    n = 0
    for part in linededup.neighbourhood(line):
        assert len(part[0]) <= 2 * linededup.PART
        n += len(part[0])
    assert n == 2_000_001 and (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024 < 300
