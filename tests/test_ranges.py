"""Files read in byte ranges that end anywhere: the same rows as from whole ones."""

import json
import random

import pytest

from corpuskiln.operators import diagnostics
from corpuskiln.sources import exercises as source
from corpuskiln.sources import huge_json
from corpuskiln.sources.shared import read_in_ranges

LOG = "pre\nC:/a.src:1:2: warning: w1\n  more\n\n\x0bx\r\ninfo\ns.src:2:0: error: e1\nq\x0cr\ns.src:9:1: warning: says t.src:1:1: error: both\nlast line é é é é é é\nmore and more\n" * 4


@pytest.mark.parametrize("size", [10**7, 37])
def test_logs_cut_anywhere(spark, tmp_path, size):
    logs = {"a.log": LOG, "b.log": "nothing\n", "c.log": "b.src:1:1: error: m", "d.log": "x.src:1:1: warning: y\n" + "z\n" * 200}
    for name, text in logs.items():
        (tmp_path / name).write_bytes(text.encode())
    want = diagnostics.parse_diagnostics(spark.createDataFrame(list(logs.items()), "ex_id string, output string"))
    got = diagnostics.parse_log_files(spark, str(tmp_path), size)
    assert sorted((r.file.rpartition("/")[2], *tuple(r)[1:]) for r in got.collect()) == sorted(map(tuple, want.collect()))


def item(rng, k):
    text = "".join(rng.choice(["a", "é", "}", "{", "[", '"', "\\", ",", "日\n"]) for _ in range(rng.randrange(60)))
    return [
        {"loose": text}, {"chapter": [{"problem": text, "proof": k}, {"x": [{"题目": text, "答案": "b"}]}]}, {"problem": text, "proof": "", "parts": [{"problem": "inner", "proof": ""}]},
        [text, k, [{"problem": text, "source": k}]], text, {"题目内容": text, "知识点": []},
    ][rng.randrange(6)]


@pytest.fixture(scope="module")
def documents():
    rng = random.Random(5)
    items = [item(rng, k) for k in range(150)]
    whole = json.dumps(items, ensure_ascii=False)
    half = len(whole.encode()) // 2
    return {
        "list": whole.encode(), "pretty": json.dumps(items, indent=2).encode(), "lines": f"{whole}\n\n".encode(), "object": json.dumps({str(k): x for k, x in enumerate(items)}).encode(),
        "nested": json.dumps({"meta": {"t": 1}, "chapters": [{"items": items}, "loose", 3, None, {"items": items[:3]}]}, ensure_ascii=False).encode(),
        "one": b'{"problem": "p", "proof": "x"}', "scalar": b"3", "cut": whole.encode()[:half], "comma": f"{whole[:-1]},]".encode(), "twice": f"{whole}3".encode(),
        "missing": json.dumps([{"problem": "a", "proof": ""}] * 40).replace("}, {", "} {", 1).encode(), "bytes": whole.encode()[:half] + b"\xff" + whole.encode()[half:],
        "nul": whole.encode()[:-1] + b",\0]", "marked": b"\xef\xbb\xbf" + whole.encode(), "long": b'[{"problem": "p", "proof": ' + b"7" * 1500 + b"}]",
    }


@pytest.mark.parametrize("size", [10**7, 4000, 1500])
@pytest.mark.parametrize("what", ["exercises", "strict"])
def test_documents_cut_anywhere(spark, tmp_path, documents, size, what):
    for name, content in documents.items():
        (tmp_path / f"{name}.json").write_bytes(content)
    want = source.parse_documents(spark.createDataFrame([(n, bytearray(c)) for n, c in documents.items()], "file string, content binary"), what).collect()
    got = huge_json.parse_huge_documents(spark, str(tmp_path), what, size).collect()
    plain = lambda rows: sorted((r.file.rpartition("/")[2].removesuffix(".json"), r.ordinal, r.raw_json or "", r.error is None) for r in rows)
    assert plain(got) == plain(want)
    assert {r.file.rpartition("/")[2] for r in got if r.error} == {f"{n}.json" for n in ("cut", "comma", "twice", "missing", "bytes", "nul", "marked")}


def test_an_exercise_of_many_ranges_is_an_error(spark, tmp_path):
    body = [{"problem": "p", "proof": "", "parts": [{"a": "x" * 50}] * 100}, {"problem": "q", "proof": ""}]
    (tmp_path / "a.json").write_text(json.dumps(body))
    (r,) = huge_json.parse_huge_documents(spark, str(tmp_path), range_bytes=1000).collect()
    assert (r.ordinal, r.raw_json, r.error) == (1, None, huge_json.TOO_LARGE)
    assert huge_json.parse_huge_documents(spark, str(tmp_path), range_bytes=10_000).count() == 2


def test_many_tasks_share_one_list(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"problem": f"p{k}", "proof": "x" * 100} for k in range(20_000)]))
    reader = read_in_ranges(spark, 200_000)
    assert huge_json.pieces(reader, str(tmp_path)).rdd.getNumPartitions() > 10
    got = huge_json.parse_huge_documents(spark, str(tmp_path), range_bytes=200_000).collect()
    assert sorted((r.ordinal, json.loads(r.raw_json)["problem"]) for r in got) == [(k + 1, f"p{k}") for k in range(20_000)]
