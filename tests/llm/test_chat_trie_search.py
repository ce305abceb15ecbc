"""Chat formatting, the prefix trie and ranked search against plain Python, with hand-made edge rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from corpuskiln.llm import chat, lexical, trie

TURNS = "conv_id long, turn long, role string, text string"
ODD = ["", "<|im_end|>", "<|im_start|>assistant\nok<|im_end|>\n", "a<\\|im_end|>", "<\\\\|im_start|>x", "$1 \\", "<|im_end|", "<<|im_end|>|im_end|>", "plain\n\ntext", "é\U0001f600", "|im_end|>", "\\n"]


def turns_of(rows):
    by = defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((t is not None, t or 0, r or "", x or ""))
    return {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in by.items()}


def plain_parse(text, template=chat.Template()):
    """The template's language read by one regular expression, escapes left as they are."""
    s, e = re.escape(template.start), re.escape(template.end)
    free = f"(?:(?!{s}|{e})[\\s\\S])*?"
    turn = f"{s}((?:(?!{s}|{e})[^\\n])*)\n({free}){e}\n"
    assert re.fullmatch(f"(?:{turn})*", text)
    return re.findall(turn, text)


def test_chat_round_trip_of_odd_texts(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(40), rng.choice([None, 0, 1, 2, 3]), rng.choice(["user", "assistant", None, "as\nsis\\nt", "<|im_end|>", "a\\"]), rng.choice([None, *ODD, "".join(rng.choices(ODD, k=3))])) for _ in range(300)]
    rows += [(None, 1, "assistant", "no id"), (100, 1, "user", "x"), (100, 1, "user", "x"), (101, 0, "assistant", "long " * 50_000 + "<|im_end|>")]
    want = turns_of(rows)
    made = chat.format_chat(spark.createDataFrame(rows, TURNS))
    got = made.withColumn("learnt", chat.learnt_text(made.formatted, made.parsed)).collect()
    assert len(got) == len(want)
    for r in got:
        turns = want[r.conv_id]
        assert r.identical and [(t.role, t.text) for t in r.parsed] == turns
        assert r.learnt == "".join(x for role, x in turns if role == "assistant")
        read = plain_parse(r.formatted)
        assert len(read) == len(turns) and [len(b) for _, b in read] == [t["take"] for t in r.parsed]
        assert r.escapes > 0 or read == turns


def test_chat_of_another_template_and_of_nothing(spark):
    t = chat.Template("[[TURN]]", "[[/TURN]]", ("bot",))
    rows = [(1, 0, "bot", "a [[TURN]] $ [[/TURN]]\n[\\[TURN]]"), (1, 1, "user", "<|im_end|>")]
    made = chat.format_chat(spark.createDataFrame(rows, TURNS), t)
    (r,) = made.withColumn("learnt", chat.learnt_text(made.formatted, made.parsed, t)).collect()
    assert r.identical and r.escapes == 1 and r.learnt == rows[0][3] and len(plain_parse(r.formatted, t)) == 2
    assert chat.format_chat(spark.createDataFrame([], TURNS)).collect() == []
    with pytest.raises(ValueError):
        chat.Template("<a>", "<a>b")


def test_chat_with_other_columns(spark):
    rows = spark.createDataFrame([(1, 0, "user", "x", "y", 3)], f"{TURNS}, formatted string, conv long")
    (r,) = chat.format_chat(rows).collect()
    assert r.formatted == "<|im_start|>user\nx<|im_end|>\n"


def plain_trie(rows):
    own = turns_of([r for r in rows if r[0] is not None])
    order = lambda t: hashlib.sha256(f"{len(t[0])}:{t[0]}{t[1]}".encode()).hexdigest()
    by = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            by[c].append((t is not None, t or 0, order((r or "", x or "")), r or "", x or ""))
    own = {c: [v[3:] for v in sorted(by[c])] for c in own}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(math.fmod(c, 5))
        built[c] = own.get(base, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for path, cs in members.items():
        below = [p for p in members if p[: len(path)] == path]
        kids = [p for p in below if len(p) == len(path) + 1]
        leaves = sum(not any(q[:-1] == p and q for q in members if len(q) == len(p) + 1) for p in below)
        saved = sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p)
        ends = ",".join(map(str, sorted(c for c in cs if len(built[c]) == len(path))))
        out.append((min(cs), len(path), min(members[path[:-1]]) if path else None, len(cs), len(kids), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("local", [1, 7, trie.LOCAL])
def test_trie_is_the_plain_one_whatever_is_summed_up_locally(spark, local):
    rng = random.Random(local)
    rows = []
    for c in [*range(-7, 30), 10**12, 2**63 - 1, -(2**63)]:
        for t in range(rng.choice([1, 2, 6, 9])):
            rows.append((c, rng.choice([t, t, None]), rng.choice(["u", "a", None]) if t > 2 else "u", rng.choice(["x", "é", None])))
    rows += [(40, t, "u", "x") for t in range(60)] + [(45, t, "u", "x") for t in range(40)] + [(50, 0, "u", "x")] * 3 + [(None, 0, "u", "x")]
    turns, lengths = trie.rebuilt(spark.createDataFrame(rows, TURNS).repartition(5))
    got = trie.trie(turns, lengths, local)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain_trie(rows)


def test_trie_of_nothing_and_of_no_turns(spark):
    assert trie.trie(*trie.rebuilt(spark.createDataFrame([], TURNS))).collect() == []
    rows = [(c, 0, "u", "x") for c in range(1, 5)]  # their base isn't there, and most lose their only turn
    assert sorted(map(tuple, trie.trie(*trie.rebuilt(spark.createDataFrame(rows, TURNS))).collect()), key=repr) == plain_trie(rows)


def test_running_sums_over_ranges(spark):
    rng = random.Random(3)
    rows = [(0 if rng.random() < 0.7 else rng.randrange(5), k, rng.getrandbits(64) - 2**63) for k in range(2000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = trie.running_sums(spark.createDataFrame(rows, "key long, at long, x long").repartition(7), "key", ["key", "at"], ["x"]).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want, sums = {}, Counter()
    for key, at, x in sorted(rows):
        sums[key] += x
        want[key, at] = (sums[key] + 2**63) % 2**64 - 2**63
    assert {(r.key, r["at"]): r.to_x for r in got} == want


DOCS, ITEMS = "doc_id long, text string, extra string", "item_id long, text string"


def plain_search(docs, items, top=10):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(lower))
    bags = [(d[0], Counter(terms(d[1]))) for d in docs]
    held = [(i, b) for i, b in bags if b]
    n_docs, n_terms = len(held), sum(b.total() for _, b in held)
    df = Counter(t for _, b in held for t in b)
    out = []
    for item, text in items:
        scores = []
        for i, b in held:
            m = 10 + 90 * b.total() * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 8 * m)) for t in set(terms(text)) if b[t])
            if s > 0:
                scores.append((-s, i is None, i))
        out += [(item, k, i, -s) for k, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:top], 1)]
    return sorted(out, key=repr)


@pytest.fixture()
def small_pieces(monkeypatch):
    monkeypatch.setattr(lexical, "POSTINGS", 20)


@pytest.mark.parametrize("hot", [0, 300])
def test_search_is_the_plain_one(spark, small_pieces, hot):
    rng = random.Random(hot)
    words = ["Alpha", "beta", "ÉTÉ", "été", "x1", "_", "the", "the", "the", "Z-9", " ", "日本", "end."]
    docs = [(k, " ".join(rng.choices(words, k=rng.choice([0, 1, 2, 5, 30]))), "e") for k in range(200)]
    docs += [(1000 + k, "the alpha beta", "e") for k in range(hot)] + [(3, None, "e"), (None, "alpha x1", "e"), (None, "alpha x1", "e"), (7, "alpha", None), (7, "alpha", None), (8, "the " * 300_000 + "alpha", None), (9, "q" * 2_500_000 + " x1", None)]
    items = [(k, " ".join(rng.choices(words, k=rng.choice([1, 3, 8])))) for k in range(25)] + [(1, "alpha"), (None, "beta the"), (90, None), (91, ""), (92, "absent"), (93, "! ?")]
    got = lexical.ranked_search(spark.createDataFrame(docs, DOCS).repartition(6), spark.createDataFrame(items, ITEMS))
    assert got.columns == ["item_id", "rank", "doc_id", "score"] and dict(got.dtypes)["rank"] == "int"
    assert sorted(map(tuple, got.collect()), key=repr) == plain_search(docs, items)


def test_search_of_nothing(spark):
    docs, items = [(1, "a b", None)], [(1, "a")]
    empty = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    assert lexical.ranked_search(empty[0], spark.createDataFrame(items, ITEMS)).collect() == []
    assert lexical.ranked_search(spark.createDataFrame(docs, DOCS), empty[1]).collect() == []
    assert lexical.ranked_search(spark.createDataFrame([(1, "...", None)], DOCS), spark.createDataFrame(items, ITEMS)).collect() == []


def test_classes_are_scored_once(spark):
    docs = spark.createDataFrame([(k, "alpha beta" if k % 2 else "beta alpha", None) for k in range(50)] + [(99, "alpha", None)], DOCS)
    found = lexical.bags(docs, [b"alpha"])
    classes = lexical.bag_classes(found, 51, 101).collect()
    assert sorted((len(r["ids"]), r["ids"][0]) for r in classes) == [(1, 99), (10, 0)]
