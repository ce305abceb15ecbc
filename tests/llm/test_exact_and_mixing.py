import collections
import hashlib
import random

import pytest

from corpuskiln.llm import exact_dedup, mixing

SCHEMA = "doc_id long, text string, lang string, source string, kept string"
AZ = str.maketrans(exact_dedup.UPPER, exact_dedup.LOWER)


def made(seed=1, n=300):
    rng = random.Random(seed)
    texts = [None, "", "A", "a", "É x", "é x", "ΑΣ", "ας", "İ", "K", "ẞ b", "x" * 5000, "X" * 5000, "Ⅷ z"] + ["common " * 9 + str(k) for k in range(9)]
    rows = [(k, rng.choice(texts), "en", rng.choice(["a", "b", None, "ü"]), "clash") for k in range(n)]
    return rows + [(None, "A", "en", "a", "clash"), (None, "a", "en", "a", "clash"), rows[5], rows[5], *[(1000 + k, "hot", "en", "a", "clash") for k in range(150)]]


def norm(t):
    return (t or "").translate(AZ)


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_exact_groups_against_brute_force(spark, keep):
    rows = made()
    groups = collections.defaultdict(list)
    for r in rows:
        groups[norm(r[1])].append(r[0])
    pick = max if keep == "largest" else min
    best = {t: pick((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    got = exact_dedup.exact_groups(spark.createDataFrame(rows, SCHEMA).repartition(7), keep=keep, salts=8).collect()
    plain = lambda xs: sorted(xs, key=repr)
    assert plain((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == plain((i, best[norm(t)], len(groups[norm(t)]), hashlib.sha256(norm(t).encode()).hexdigest()) for i, t, *_ in rows)
    assert collections.Counter(r.text_sha256 for r in got if r.kept) == collections.Counter(hashlib.sha256(t.encode()).hexdigest() for t in groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)
    left = exact_dedup.drop_exact_copies(spark.createDataFrame(rows, SCHEMA), keep=keep).collect()
    assert plain((r.doc_id, norm(r.text)) for r in left) == plain((i, t) for t, i in best.items()) and left[0].kept == "clash"


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert exact_dedup.exact_groups(none).count() == exact_dedup.drop_exact_copies(none).count() == mixing.mix(none).count() == mixing.mixed_documents(none).count() == 0


def filled(sizes, weights, epochs=3):
    """Clamp whatever is above its cap, share the rest again, until nothing is."""
    total, caps, clamped = sum(sizes), [epochs * s for s in sizes], set()
    while True:
        free = [k for k in range(len(sizes)) if k not in clamped]
        rest = total - sum(caps[k] for k in clamped)
        share = {k: rest * weights[k] / sum(weights[j] for j in free) for k in free}
        over = {k for k in free if share[k] > caps[k]}
        if not over:
            return [caps[k] if k in clamped else share[k] for k in range(len(sizes))]
        clamped |= over


@pytest.mark.parametrize("seed", range(4))
def test_water_filling_against_iteration(spark, seed):
    rng = random.Random(seed)
    sizes = [rng.choice([0, 1, 5, 40, 1000, rng.randrange(10**6)]) for _ in range(12)]
    weights = [k % 3 + 1 for k in range(12)]
    rows = spark.createDataFrame([(f"s{k:02}", s, w) for k, (s, w) in enumerate(zip(sizes, weights))], "source string, source_size long, weight long")
    got = [r.target for r in mixing.water_fill(rows).orderBy("source").collect()]
    assert got == pytest.approx(filled(sizes, weights)) and sum(got) == pytest.approx(sum(sizes))


def test_mix(spark):
    rng = random.Random(5)
    rows = [(k, " ".join("w" * rng.randrange(1, 40)) + "　\x0b\x1c", "en", rng.choice(["a", "a", "a", "b", "ç", None]), "clash") for k in range(600)]
    rows += [(None, "x y", "en", "b", ""), (7000, None, "en", "only nulls", ""), rows[3], rows[3]]
    df = spark.createDataFrame(rows, SCHEMA)
    got = mixing.mix(df.repartition(5)).collect()
    assert len(got) == len(rows) and {r.size for r in got if r.doc_id == 7000} == {0}
    sizes = collections.Counter()
    for i, t, _, s, _ in rows:
        sizes[s] += len([x for x in __import__("re").split("[\x20\x09-\x0d]+", t or "") if x])
    names = sorted((s for s in sizes if s is not None)) + [None]
    want = dict(zip(names, filled([sizes[s] for s in names], [k % 3 + 1 for k in range(len(names))])))
    taken = collections.Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source]) and 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 3 * 45 for s in names)
    again = mixing.mix(df).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))
    copies = collections.Counter(r.doc_id for r in mixing.mixed_documents(df).collect())
    times = collections.Counter()
    for r in got:
        times[r.doc_id] += r.copies
    assert copies == +times


def test_capped_source_of_half_empty_documents(spark, tmp_path):
    """A source at its cap takes every document three times, empty ones too; the query agrees with its SQL."""
    import duckdb

    rng = random.Random(8)
    rows = [(k, "" if k % 2 else "w " * rng.randrange(1, 9), "en", "z", "") for k in range(60)] + [(100 + k, "w " * 30, "en", "a", "") for k in range(200)] + [(400 + k, None if k % 3 else "x", "en", None, "") for k in range(9)]
    df = spark.createDataFrame(rows, SCHEMA)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = mixing.op10_mixing(spark, str(tmp_path)).collect()
    by = {r.doc_id: r for r in got}
    assert {by[k].copies for k in range(60)} == {3} and all(by[k].target == 3 * by[k].source_size for k in range(60)) and max(r.copies for r in got) == 3
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(mixing.OP10_SQL)
    names = [d[0] for d in want.description]
    assert sorted(tuple(r[n] for n in names) for r in got) == sorted(want.fetchall())
    copies = collections.Counter(r.doc_id for r in mixing.mixed_documents(df).collect())
    assert copies == +collections.Counter({r.doc_id: r.copies for r in got})


@pytest.mark.parametrize("bits", [1, 3])
def test_few_buckets_give_the_same(spark, monkeypatch, bits):
    rng = random.Random(3)
    df = spark.createDataFrame([(k, "w " * rng.randrange(0, 30), "en", rng.choice(["a", "b", "c", None]), "") for k in range(400)], SCHEMA)
    want = sorted(map(tuple, mixing.mix(df).collect()), key=repr)
    monkeypatch.setattr(mixing, "BUCKET_BITS", bits)
    assert sorted(map(tuple, mixing.mix(df).collect()), key=repr) == want


def test_lower_case_for_a_to_z_alone(spark):
    from pyspark.sql import functions as F

    texts = ["Plain ASCII Z", "é x", "É x", "ΑΣ", "İ", "\u212a", "ẞ", "Ⅷ", "ǅ", "日本", ""]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = rows.select("t", exact_dedup.ascii_lower(F.col("t")).alias("n"), F.col("t").rlike(exact_dedup.OTHER_CAPITALS).alias("other")).collect()
    assert all(r.n == norm(r.t) for r in got) and {r.t for r in got if not r.other} == {"Plain ASCII Z", "é x", "日本", ""}


def test_every_character_beyond_ascii_keeps_its_case(spark):
    from pyspark.sql import functions as F

    chars = spark.range(0x110000).where("id NOT BETWEEN 55296 AND 57343").select(F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32").alias("t"))
    assert chars.where(exact_dedup.ascii_lower(F.col("t")) != F.translate("t", exact_dedup.UPPER, exact_dedup.LOWER)).isEmpty()


def test_main_paths_run_no_python(spark):
    for q in (exact_dedup.op1_exact_dedup, mixing.op10_mixing):
        plan = q(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan
