import hashlib
import random
import struct
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpuskiln.llm import media, pieces, tokencounts

ROWS = [(1, None, "x"), (2, "", "x"), (3, "a" * 64, "x"), (4, "é" * 700 + "\n", "x"), (4, "é" * 700 + "\n", "y"), (None, "日本語 text", "x"), (6, "word " * 30000, "x")]
SCHEMA = "doc_id long, text string, feature string"


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=5000))
def test_container_round_trip(raw):
    payload = raw + bytes(-len(raw) % 64 or (64 if not raw else 0))
    t = media.sample_tables(file := media.write_container(payload))
    assert media.read_payload(file, t) == payload and t["media_duration"] == t["duration"] == len(payload)
    assert all(file[a:b] == payload[k * 1024 : k * 1024 + 64] for k, (a, b) in enumerate(t["keyframes"]))
    assert [p[-1] for p, _, _ in media.walk(memoryview(file)) if len(p) == 1] == [b"ftyp", b"moov", b"mdat"]


def test_other_layouts():
    """64-bit sizes and offsets, sizes in a table, the media first and a last box of size 0."""
    samples = [b"one", b"sixteen bytes it", b"z"]
    box = lambda kind, *b: struct.pack(">I4s", 8 + sum(map(len, b)), kind) + b"".join(b)
    full = lambda kind, *b, v=0: box(kind, struct.pack(">I", v << 24), *b)
    mdat = struct.pack(">I4sQ", 1, b"mdat", 16 + 20) + b"".join(samples)
    stbl = box(b"stbl", full(b"stsd", struct.pack(">I", 1), box(b"avc1", bytes(78))), full(b"stts", struct.pack(">5I", 2, 1, 10, 2, 5)), full(b"stsc", struct.pack(">7I", 2, 1, 2, 1, 2, 1, 1)), full(b"stsz", struct.pack(">5I", 0, 3, 3, 16, 1)), full(b"co64", struct.pack(">I2Q", 2, 16, 35)), full(b"stss", struct.pack(">2I", 1, 2)))
    moov = box(b"moov", box(b"trak", box(b"mdia", full(b"mdhd", struct.pack(">QQIQ", 0, 0, 1000, 20), bytes(4), v=1), box(b"minf", stbl))))
    file = mdat + struct.pack(">I4s", 0, b"moov") + moov[8:]
    t = media.sample_tables(file)
    assert media.read_payload(file, t) == b"".join(samples) and t["codec"] == "avc1" and t["media_duration"] == t["duration"] == 20
    assert [file[a:b] for a, b in t["keyframes"]] == [samples[1]]


BOX = lambda kind, *b: struct.pack(">I4s", 8 + sum(map(len, b)), kind) + b"".join(b)
FULL = lambda kind, *b, v=0: BOX(kind, struct.pack(">I", v << 24), *b)


def track(codec, at, sizes, deltas, syncs=None, wide=False, small=0, stsc=None):
    """One chunk at a byte of the file; small: bits of an stz2."""
    if small == 4:
        packed = bytes(a << 4 | b for a, b in zip(sizes[::2], [*sizes[1::2], 0]))
    else:
        packed = b"".join(x.to_bytes(small // 8 or 4, "big") for x in sizes)
    size = FULL(b"stz2", bytes(3) + bytes([small]), struct.pack(">I", len(sizes)), packed) if small else FULL(b"stsz", struct.pack(">II", 0, len(sizes)), packed)
    offset = FULL(b"co64", struct.pack(">IQ", 1, at)) if wide else FULL(b"stco", struct.pack(">II", 1, at))
    sync = [FULL(b"stss", struct.pack(f">I{len(syncs)}I", len(syncs), *syncs))] if syncs is not None else []
    stbl = BOX(b"stbl", FULL(b"stsd", struct.pack(">I", 1), BOX(codec, bytes(28))), FULL(b"stts", struct.pack(">III", 1, len(sizes), deltas)), FULL(b"stsc", struct.pack(">IIII", 1, *(stsc or (1, len(sizes), 1)))), size, offset, *sync)
    return BOX(b"trak", BOX(b"mdia", FULL(b"mdhd", struct.pack(">IIII", 0, 0, 1000, len(sizes) * deltas), bytes(4)), FULL(b"hdlr", bytes(4), codec, bytes(13)), BOX(b"minf", stbl)))


@pytest.mark.parametrize("small", [0, 4, 8, 16])
def test_tracks_have_their_own_tables(spark, small):
    """Sound first, without stss and with 64-bit offsets; pictures second, with stss and 32-bit offsets; a broken third."""
    sound, pictures = [3, 5, 7], [9, 1, 2, 4]
    body = bytes(range(40))
    parts = lambda at: [track(b"mp4a", at, sound, 10, wide=True, small=small), track(b"avc1", at + 15, pictures, 20, [1, 3], small=small), track(b"tx3g", at, [1], 1, [2])]
    at = 8 + len(b"".join(parts(0))) + 8
    file = BOX(b"moov", *parts(at)) + BOX(b"mdat", body)
    rows = media.media_columns(spark.createDataFrame([(1, file), (2, file[:-50])], "id long, content binary")).collect()
    one, two, three = sorted((r for r in rows if r.id == 1), key=lambda r: r.track)
    cut = lambda r: [file[k.start : k.stop] for k in r.keyframes]
    assert (one.codec, one.samples, one.duration_s, cut(one)) == ("mp4a", 3, 0.03, [body[0:3], body[3:8], body[8:15]])
    assert (two.codec, two.samples, two.duration_s, cut(two)) == ("avc1", 4, 0.08, [body[15:24], body[25:27]])
    assert three.error and three.codec is None and [r.error is not None for r in rows if r.id == 2] == [True]


def test_files_that_lie(spark):
    """Deep nesting, counts that no box or file has room for, chunk numbers of 0: an error each, and no memory to speak of."""
    import tracemalloc

    deep = b""
    for _ in range(3000):
        deep = BOX(b"moov", deep)
    good = [BOX(b"moov", track(b"avc1", 16, [4], 1, [1])), 1 << 31]
    lies = [deep, b"\0\0\0\1moov", BOX(b"moov", track(b"avc1", 16, [4], 1, stsc=(0, 1, 1))), BOX(b"moov", track(b"avc1", 16, [4], 1, [0])), BOX(b"moov", track(b"avc1", 1 << 31, [4], 1)), BOX(b"moov", track(b"avc1", 16, [4], 1, stsc=(1, 1 << 31, 1)))]
    for kind, offset in ((b"stsz", 12), (b"stts", 8), (b"stsc", 8), (b"stco", 8), (b"stss", 8), (b"stts", 12)):
        at = good[0].index(kind) + offset - (4 if kind == b"stsz" else 0) + (4 if kind == b"stsz" else 0)
        lies.append(good[0][:at] + struct.pack(">I", 0xFFFFFFF0) + good[0][at + 4 :])
    fixed = good[0].index(b"stsz") + 8
    lies.append(good[0][:fixed] + struct.pack(">II", 1, 0xFFFFFFF0) + good[0][fixed + 8 :])
    assert media.sample_tables(good[0])["keyframes"] == [(16, 20)]
    tracemalloc.start()
    for file in lies:
        with pytest.raises((ValueError, struct.error)):
            media.sample_tables(file)
    assert tracemalloc.get_traced_memory()[1] < 5 << 20
    tracemalloc.stop()
    rows = media.media_columns(spark.createDataFrame([(k, f) for k, f in enumerate(lies)], "id long, content binary")).collect()
    assert len(rows) == len(lies) and all(r.error and r.codec is None for r in rows)


def test_media_query(spark):
    got = media.text_media(spark.createDataFrame(ROWS, SCHEMA), with_media=True).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in ROWS)
    for r in got:
        raw = next((t or "").encode() for i, t, _ in ROWS if i == r.doc_id)
        payload = raw + bytes(-len(raw) % 64 or (64 if not raw else 0))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert (r.media_bytes, r.media_sha256) == (len(r.media), hashlib.sha256(r.media).hexdigest()) and payload in bytes(r.media) and r.duration_s == len(payload) / 8000
    files = spark.createDataFrame([(1, bytes(got[0].media)), (2, b"\0\0\0\x20ftyp"), (3, None)], "id long, content binary")
    rows = {r.id: r for r in media.media_columns(files).collect()}
    assert rows[1].codec == "raw " and rows[1].handler == "soun" and rows[2].error and rows[3].error and rows[2].codec is None
    assert media.text_media(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.fixture(scope="module")
def tokens():
    with open(tokencounts.RANKS, "rb") as f:
        return tokencounts.Tokens(f.read())


def by_hand(tokens, text, spans, rule):
    """Each token's bytes walked one by one."""
    owner = []
    for k, c in enumerate(text):
        owner += [next((n for n, (a, b) in enumerate(spans) if a <= k < b), -1 - sum(b <= k for _, b in spans))] * len(c.encode())
    counts, at = {}, 0
    for t in tokens.encode(text):
        own = owner[at : at + tokens.width[t]]
        at += len(own)
        pick = own[0] if rule == "start" else own[-1] if rule == "end" else max(dict.fromkeys(own), key=own.count)
        counts[pick] = counts.get(pick, 0) + 1
    return counts


@pytest.mark.parametrize("rule", ["start", "end", "most"])
@pytest.mark.parametrize("text", ["", "a", "Hello wörld,\n\n\nnew  line\n", "x\n" * 30, "日本語🙂 né\n e", " lead", "tail\n\n"])
def test_sections_against_hand_count(tokens, text, rule):
    lines = text.splitlines(keepends=True) or [""]
    at, spans = 0, []
    for line in lines:
        spans.append((at, at + len(line)))
        at += len(line)
    names, starts, ends, n, _ = tokens.count(text, None, rule)
    assert list(zip(starts.tolist(), ends.tolist())) == spans and n.sum() == len(tokens.encode(text))
    want = by_hand(tokens, text, spans, rule)
    assert {int(k): int(v) for k, v in zip(names, n) if v} == {k: v for k, v in want.items() if v}
    spans = [(1, 4), (4, 5), (8, 12)]
    names, _, _, n, _ = tokens.count(text, spans, rule)
    want = by_hand(tokens, text, spans, rule)
    assert {int(k): int(v) for k, v in zip(names, n) if k >= 0 and v} == {k: v for k, v in want.items() if k >= 0 and v}


def test_token_query(spark, tokens):
    got = tokencounts.token_counts(spark.createDataFrame(ROWS, SCHEMA)).collect()
    assert sum(r.n_tokens for r in got) == sum(len(tokens.encode(t or "")) for _, t, _ in ROWS)
    assert [(r.section, r.start, r.stop, r.n_tokens) for r in got if r.doc_id == 1] == [(0, 0, 0, 0)]
    assert tokencounts.token_counts(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.fixture(scope="module")
def encoder():
    return pieces.Encoder(pieces.PieceModel.load())


def ids(encoder, text):
    return list(memoryview(encoder.encode(text)).cast("i"))


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("abcdefghinorst  ▁\n.éß日本≈🙂\x00\t"), st.characters(codec="utf-8")), max_size=300))
def test_ids_equal_the_library(encoder, library, text):
    got = ids(encoder, text)
    assert got == library.encode(text)
    if "▁" not in text:
        assert pieces.decode(encoder.model, got) == text


def test_long_runs_go_through_the_window(encoder, library):
    for text in ("the" * 3000, "ab" * 999 + "é" * 77, "日本語" * 500, "x" * 65, "=" * 4000):
        assert ids(encoder, text) == library.encode(text) == ids(encoder, text)
        assert encoder.stream("▁" + text) == library.encode(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["▁", "the", "tion", "e", "ing", "x", "日", "本語", "\x00", "=", "==", "ß"]), min_size=1, max_size=400))
def test_uncut_runs_go_through_the_window(encoder, library, parts):
    text = "".join(parts)
    assert encoder.stream("▁" + text) == library.encode(text.replace("▁", " "))


def test_the_window_stays_small(encoder, monkeypatch):
    """Ids are committed as the run goes on: what is kept doesn't follow its length."""
    most = []
    advance = pieces.Window.advance
    monkeypatch.setattr(pieces.Window, "advance", lambda self, *a: (advance(self, *a), most.append(len(self.last) - self.base)) and None)
    assert len(encoder.stream("thequickbrownfox" * 5000)) > 5000
    assert max(most) <= 4 * encoder.longest and len(most) > 10_000


def merges(model, text):
    """The model's own rule: the merge of best rank, the leftmost of equal ones, until there is none."""
    rank, parts = {p: -model.pieces[i][1] for p, i in model.ids.items()}, list(text)
    while found := [(rank[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in rank]:
        _, k = min(found)
        parts[k : k + 2] = [parts[k] + parts[k + 1]]
    return [model.ids[p] for p in parts]


def test_large_vocabularies_and_long_pieces():
    """Over 32,768 pieces, one of them of 64 characters: no key runs into another."""
    rng = random.Random(3)
    made = dict.fromkeys([*"▁abcdefghijklmnopqrstuvwxyz", *("ab" * (1 << n) for n in range(6))])  # doublings give a piece of 64 characters
    letters = "abcdefghijklmnopqrstuvwxyz"
    pool = list(dict.fromkeys(made))
    while len(made) < 40_000:
        a, b = rng.choice(pool), rng.choice(letters)
        if len(a) < 5 and "▁" not in a and a + b not in made:
            made[a + b] = None
            pool.append(a + b)
    model = pieces.PieceModel([(p, -float(k), "normal") for k, p in enumerate(made)])
    encoder = pieces.Encoder(model)
    assert model.longest == 64 and len(model.pieces) == 40_000
    seen = set()
    for _ in range(60):
        text = "▁" + "".join(rng.choice([rng.choice(letters), "ab" * rng.randrange(1, 50), rng.choice(pool[27:])]) for _ in range(rng.randrange(1, 40))).replace("▁", "")
        want = merges(model, text)
        assert encoder.stream(text) == want
        seen |= set(want)
    assert max(seen) > 32_768 and model.ids["ab" * 32] in seen


def test_piece_query(spark, library):
    got = pieces.piece_encode(spark.createDataFrame(ROWS, SCHEMA), with_text=True).collect()
    for r in got:
        text = next(t or "" for i, t, _ in ROWS if i == r.doc_id)
        assert list(r.ids) == library.encode(text) and r.n_ids == len(r.ids) and r.round_trip and r.decoded == text
    back = pieces.piece_decode(spark.createDataFrame([(1, [22557, 28705]), (2, None), (3, [])], "doc_id long, ids array<int>")).collect()
    assert {r.doc_id: r.text for r in back} == {1: library.decode([22557, 28705]), 2: "", 3: ""}
    assert pieces.piece_encode(spark.createDataFrame([], SCHEMA)).count() == 0


def test_long_white_space_is_counted(spark):
    texts = [" " * 1_000_000, "\t" * 1_000_000, "\n" * 1_000_000, "a" + " " * 1_000_000 + "b", "　" * 5_000 + "x\n" + " " * 4_096, ""]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in tokencounts.token_counts(rows).groupBy("doc_id").agg(F.sum("n_tokens").alias("n"), F.max("stop").alias("stop")).collect()}
    assert [got[k].stop for k in range(6)] == [len(t) for t in texts]
    with open(tokencounts.RANKS, "rb") as f:
        tokens = tokencounts.Tokens(f.read())
    # what lies within the tokenizer's own reach says what the cut ones have to give
    for text in [" " * 9_000, "a" + "\n" * 5_000 + "b", "x" + " " * 6_000 + "\n" * 7 + "y" + "\t" * 4_097, "　" * 4_500 + "é"]:
        assert tokens.encode(text) == tokens.encoding.encode_ordinary(text)
    assert got[0].n == len(tokens.encoding._encode_single_piece(texts[0])) and got[5].n == 0


def test_what_the_tokenizer_breaks_down_on_is_a_row(spark):
    pattern = r"\s+(?!\S)|\S+|\s"
    rows = spark.createDataFrame([(1, " " * 1_000_000 + "x"), (2, "a b")], "doc_id long, text string")
    got = {r.doc_id: (r.section, r.stop, r.n_tokens is None) for r in tokencounts.token_counts(rows, pattern=pattern).collect()}
    assert got == {1: (0, 1_000_001, True), 2: (0, 3, False)}


def test_a_failure_is_told_from_a_result(spark):
    """Texts that can't be counted keep their sections, have no counts and say why; the others' errors are null."""
    broken = "a\n" + " " * 1_000_000 + "x\nb\n"
    rows = spark.createDataFrame([(1, broken, [(0, 1), (4, 9)]), (2, "a b\nc", [(0, 1), (1, 4)]), (3, None, None)], "doc_id long, text string, parts array<struct<start:int,stop:int>>")
    for spans_col, sections in ((None, [(0, 0, 2), (1, 2, 1_000_004), (2, 1_000_004, 1_000_006)]), ("parts", [(0, 0, 1), (-1, 1, 4), (1, 4, 9), (-1, 9, 1_000_006)])):
        got = tokencounts.token_counts(rows, spans_col=spans_col, pattern=r"\s+(?!\S)|\S+|\s").collect()
        bad = [r for r in got if r.error is not None]
        assert [(r.section, r.start, r.stop) for r in bad] == sections and {(r.doc_id, r.n_tokens, r.n_crossing) for r in bad} == {(1, None, None)}
        assert all("breaks down" in r.error for r in bad) and {r.doc_id for r in got if r.n_tokens is not None and r.n_crossing is not None} == {2, 3}


def test_what_a_pattern_leaves_out(spark):
    """Where tokens are isn't known then, so only a text of one section, or without tokens, has counts."""
    rows = spark.createDataFrame([(1, "one\n....\ntwo\n"), (2, "one.two"), (3, "..\n.."), (4, "one"), (5, "")], "doc_id long, text string")
    got = tokencounts.token_counts(rows, pattern=r"\w+").collect()
    assert [(r.doc_id, r.section, r.start, r.stop, r.n_tokens, r.error is None) for r in got] == [(1, 0, 0, 4, None, False), (1, 1, 4, 9, None, False), (1, 2, 9, 13, None, False), (2, 0, 0, 7, 2, True), (3, 0, 0, 3, 0, True), (3, 1, 3, 5, 0, True), (4, 0, 0, 3, 1, True), (5, 0, 0, 0, 0, True)]
    assert "7 bytes" in got[0].error


def test_spans_out_of_order_are_an_error(spark, tokens):
    n, rest = len(tokens.encode("ab cd ef")), len(tokens.encode(" cd ef"))
    spans = [[(0, 5), (3, 8)], [(3, 5), (0, 2)], [(5, 3)], [(-1, 2)], [(None, 2)], [None], [(0, 2), (2, 2), (2, 90)], [(20, 30)]]
    rows = spark.createDataFrame([(k, "ab cd ef", s) for k, s in enumerate(spans)], "doc_id long, text string, parts array<struct<start:int,stop:int>>")
    got = tokencounts.token_counts(rows, spans_col="parts").collect()
    assert [(r.doc_id, r.section, r.start, r.stop, r.n_tokens) for r in got if r.error] == [(k, -1, 0, 8, None) for k in range(6)]
    assert [(r.doc_id, r.section, r.start, r.stop, r.n_tokens) for r in got if not r.error] == [(6, 0, 0, 2, n - rest), (6, 1, 2, 2, 0), (6, 2, 2, 8, rest), (7, -1, 0, 8, n), (7, 0, 8, 8, 0)]


@pytest.mark.parametrize("failure", [MemoryError, AttributeError, KeyError, ValueError])
def test_other_failures_end_the_task(tokens, monkeypatch, failure):
    def fail(text):
        raise failure("no result")

    monkeypatch.setattr(tokens, "encoding", type("Failing", (), {"encode_ordinary": staticmethod(fail)}))
    for name in ("count", "rows"):
        with pytest.raises(failure, match="no result"):
            getattr(tokens, name)("a\nb")


def test_spans_column(spark):
    rows = spark.createDataFrame([(1, "ab cd ef", [(0, 2), (3, 5)], "x"), (2, None, [(0, 1)], "y"), (3, "abc", None, "z")], "doc_id long, text string, parts array<struct<start:int,stop:int>>, section string")
    with open(tokencounts.RANKS, "rb") as f:
        n = len(tokencounts.Tokens(f.read()).encode("ab cd ef"))
    for rule in ("start", "end", "most"):
        got = tokencounts.token_counts(rows, spans_col="parts", rule=rule).collect()
        assert {r.doc_id: sum(x.n_tokens for x in got if x.doc_id == r.doc_id) for r in got}[1] == n
        assert {(r.section, r.start, r.stop) for r in got if r.doc_id == 1} == {(0, 0, 2), (-1, 2, 3), (1, 3, 5), (-1, 5, 8)} and [(r.section, r.stop) for r in got if r.doc_id == 3] == [(-1, 3)]


def test_slices_by_rows_and_bytes():
    import pyarrow as pa

    from corpuskiln.llm.common import slices

    batch = pa.RecordBatch.from_arrays([pa.array(range(9)), pa.array(["x" * n if n else None for n in (1, 0, 90, 20, 300, 5, 5, 5, 5)])], ["k", "t"])
    assert [s.column(0).to_pylist() for s in slices(batch, 1, 3, 100)] == [[0, 1, 2], [3], [4], [5, 6, 7], [8]] and list(slices(batch.slice(0, 0), 1)) == []


def test_a_vocabulary_without_pieces_for_bytes(spark):
    """Unknown characters in a row are one unknown id, across runs as well; ids come back as its sign."""
    made = pieces.PieceModel([("<unk>", 0.0, "unknown"), ("▁a", -1.0, "normal"), ("▁", -2.0, "normal"), ("a", -3.0, "normal"), ("b", -4.0, "normal")])
    rows = spark.createDataFrame([(1, "aéé日 ba"), (2, "éa"), (3, "ab"), (4, None), (5, "\n\té")], "doc_id long, text string")
    got = {r.doc_id: r for r in pieces.piece_encode(rows, model=made, with_text=True).collect()}
    assert [got[k].ids for k in range(1, 6)] == [[1, 0, 2, 4, 3], [2, 0, 3], [1, 4], [], [2, 0]]
    assert [got[k].round_trip for k in range(1, 6)] == [False, False, True, True, False] and got[1].decoded == "a ⁇  ba"


def test_models_of_other_kinds_are_refused(tmp_path):
    with open(pieces.MODEL, "rb") as f:
        raw = f.read()
    trainer = next(v for n, v in pieces.fields(raw) if n == 2)
    assert raw.count(trainer) == 1 and trainer.count(b"\x18\x02") == 1
    (tmp_path / "unigram.model").write_bytes(raw.replace(trainer, trainer.replace(b"\x18\x02", b"\x18\x01")))
    with pytest.raises(ValueError):
        pieces.PieceModel.load(str(tmp_path / "unigram.model"))
    assert pieces.model_specs(raw)["type"] == pieces.BPE
