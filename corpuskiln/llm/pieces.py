"""SentencePiece encoding by a streaming Viterbi search, and decoding.

The vocabulary given is a BPE model with byte fallback, so the best path isn't the one of the greatest summed score but
the one the merges lead to. That path has a local description which a Viterbi search can follow: a sequence of pieces is
the model's encoding exactly if every two neighbours, encoded alone, stay those two pieces. So each position keeps one
surviving last piece, chosen among those that end there and agree with the survivor at their start; a state is a
position, an arc a piece, and no arc is longer than the longest piece. The search keeps a window of that many positions,
beyond which no further piece can start, and what of the backpointer tree still leads to one of them; as soon as all
surviving paths go through one boundary, the ids up to it are committed. Ids equal those of the sentencepiece library.

Where no piece of the vocabulary has two characters next to each other, as before every space and before most
punctuation, all paths meet whatever stands around; texts are cut there first. Every run between two such boundaries goes
through the window; what short runs give is remembered, in a table of bounded size.

Defined results: a null or empty text has no ids and decodes to the empty text (``round_trip`` compares with the text, a
null counting as empty); the space mark U+2581 in a text can't be told from a space afterwards, and is the only case in
which ``round_trip`` is false, but for characters unknown to a vocabulary without pieces for bytes; texts of any length are
encoded whole; of merges of one rank the leftmost comes first; rows that share an id are rows of their own; an empty table gives an empty table; other
columns are ignored.
"""

from __future__ import annotations

import re
import string
from array import array

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskiln.llm.common import slices

MARK = "▁"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Fixed values of the format: the number of the kind of model, and how an unknown id is decoded.
BPE, UNKNOWN = 2, " \u2047 "
#: Runs remembered in each of a task's two generations, and agreements remembered.
REMEMBERED = 1 << 18
#: Characters of a run that is remembered.
MEMORABLE = 64


class PieceModel:
    """Pieces with scores, and how each decodes. Plain data, so it can be sent to tasks."""

    def __init__(self, pieces: list[tuple[str, float, str]]):
        """pieces: (piece, score, kind) by id; kind is normal, byte, unknown or control."""
        self.pieces = pieces
        self.ids = {p: i for i, (p, _, kind) in enumerate(pieces) if kind == "normal"}
        self.bytes = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == "byte"}
        self.unknown = next((i for i, (_, _, kind) in enumerate(pieces) if kind == "unknown"), 0)
        self.longest = max(map(len, self.ids), default=1)
        said = {"control": b"", "unknown": UNKNOWN.encode()}
        self.raw = [bytes([int(p[3:5], 16)]) if kind == "byte" else said[kind] if kind in said else p.replace(MARK, " ").encode() for p, _, kind in pieces]

    @classmethod
    def load(cls, path: str = MODEL) -> PieceModel:
        """A model file of the kind this search follows: BPE, text taken as it is but for the space mark put before it. Any
        other kind is a ValueError."""
        import sentencepiece

        with open(path, "rb") as f:
            spec = model_specs(f.read())
        if spec["type"] != BPE or spec["charsmap"] or not spec["dummy_prefix"] or spec["fewer_spaces"] or not spec["space_marks"]:
            raise ValueError(f"{path} is no BPE model without normalisation: {spec}")
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        kind = lambda i: "byte" if sp.is_byte(i) else "unknown" if sp.is_unknown(i) else "control" if sp.is_control(i) or sp.is_unused(i) else "normal"
        return cls([(sp.id_to_piece(i), sp.get_score(i), kind(i)) for i in range(sp.get_piece_size())])


def fields(raw: bytes):
    """(number, value) of a protocol buffer's fields."""
    at = 0

    def number() -> int:
        nonlocal at
        n = shift = 0
        while True:
            byte = raw[at]
            at, n, shift = at + 1, n | (byte & 127) << shift, shift + 7
            if byte < 128:
                return n

    while at < len(raw):
        tag = number()
        if tag & 7 == 0:
            yield tag >> 3, number()
        else:
            size = {1: 8, 5: 4}.get(tag & 7) or number()
            at += size
            yield tag >> 3, raw[at - size : at]


def model_specs(raw: bytes) -> dict:
    """What a model file says of its kind and of what it does to texts; the numbers of the fields are fixed by the format."""
    parts = {n: dict(fields(v)) for n, v in fields(raw) if n in (2, 3)}
    trainer, normaliser = parts.get(2, {}), parts.get(3, {})
    return {"type": trainer.get(3, 1), "charsmap": bool(normaliser.get(2)), "dummy_prefix": bool(normaliser.get(3, 1)), "fewer_spaces": bool(normaliser.get(4, 1)), "space_marks": bool(normaliser.get(5, 1))}


def cut_pattern(model: PieceModel) -> str:
    """A pattern for the longest runs between places that no piece crosses, read off the vocabulary: before a space mark,
    around a line feed, tab or return without a piece, and before punctuation that no piece has after another character
    (but for a few ``sticky`` ones, after which it isn't cut)."""
    before: dict[str, set] = {}
    for piece in model.ids:
        for x, y in zip(piece, piece[1:]):
            before.setdefault(y, set()).add(x)
    if any(x != MARK for x in before.get(MARK, ())):
        return "(?s).+"  # not a vocabulary of words
    marks, sticky = set(string.punctuation), set()
    while True:
        follows = {c: before.get(c, set()) - marks - {MARK} for c in marks}
        far = {c for c, x in follows.items() if any(y.isalpha() for y in x)}
        if not far:
            break
        marks -= far
    sticky = set().union(*follows.values())
    alone = re.escape("".join(c for c in "\n\t\r" if c not in model.ids))
    p = re.escape("".join(sorted(marks)))
    rest = f"(?:(?<=[{re.escape(''.join(sorted(sticky)))}])[{p}]+[^{MARK}{p}{alone}]*)*" if sticky and marks else ""
    if not marks:
        return f"{MARK}*[^{MARK}{alone}]+|{MARK}+" + f"|[{alone}]" * bool(alone)
    return f"{MARK}*[{p}]*[^{MARK}{p}{alone}]+{rest}|{MARK}*[{p}]+|{MARK}+" + f"|[{alone}]" * bool(alone)


class Window:
    """The positions from the last committed boundary on: the last piece before each, and the tree their paths make.

    Lists are by position less ``off``, what has been let go. ``kids`` counts a position's surviving successors and ``sums``
    adds their places up, so that an only one is known; both are made once a run is longer than the longest piece."""

    def __init__(self):
        self.last, self.size, self.kids, self.sums = [-1], [0], [], []
        self.off = self.base = 0
        self.out: list[int] = []

    def advance(self, text: str, longest: int, fallback: dict[int, int]) -> None:
        """New positions join the tree. With each, the one at which no piece can start any more leaves, and what led to it
        alone; while the boundary has one successor left, all paths meet there, and it is committed."""
        size, kids, sums = self.size, self.kids, self.sums
        for x in range(len(kids), len(self.last)):
            kids.append(0)
            sums.append(0)
            if x > self.base:
                kids[x - size[x]] += 1
                sums[x - size[x]] += x
            gone = at = x - longest
            while at > self.base and not kids[at]:
                kids[at], before = -1, at - size[at]
                kids[before] -= 1
                sums[before] -= at
                at = before
            while self.base <= gone and kids[self.base] == 1:
                self.base = sums[self.base]
                self.emit(text, self.base, fallback)
        if (d := self.base) > 4 * longest:
            del self.last[:d], size[:d], kids[:d]
            sums[:] = [s - k * d for s, k in zip(sums[d:], kids)]
            self.off, self.base = self.off + d, 0

    def emit(self, text: str, at: int, fallback: dict[int, int]) -> None:
        i = self.last[at]
        if i >= 0 or not fallback:
            self.out.append(i)  # -1: unknown
        else:
            self.out += [fallback[b] for b in text[self.off + at - 1].encode("utf-8", "surrogatepass")]

    def finish(self, text: str, fallback: dict[int, int]) -> None:
        """At the end of a run there is one path left."""
        path, at = [], len(self.last) - 1
        while at > self.base:
            path.append(at)
            at -= self.size[at]
        for at in reversed(path):
            self.emit(text, at, fallback)


class Encoder:
    """Viterbi over one text: a state is a position, its survivor the id of the last piece before it."""

    def __init__(self, model: PieceModel):
        import ahocorasick

        self.model, self.longest = model, model.longest
        self.rank = {p: -model.pieces[i][1] for p, i in model.ids.items()}
        self.text = [p for p, _, _ in model.pieces]
        self.agreed: dict[int, bool] = {}
        self.remembered: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.cut = re.compile(cut_pattern(model)).findall
        self.parts: dict[str, tuple[str, str]] = {}
        self.bits = self.longest.bit_length()
        automaton = ahocorasick.Automaton()
        for piece, i in model.ids.items():
            if len(piece) > 1 and self.stands(piece):
                automaton.add_word(piece, i << self.bits | len(piece))
        automaton.make_automaton()
        self.arcs = automaton.iter if len(automaton) else lambda text: ()
        self.single = {p: i for p, i in model.ids.items() if len(p) == 1}

    def stands(self, piece: str) -> bool:
        """Whether merging a piece's characters gives the piece; remembers its last two parts."""
        parts, rank = list(piece), self.rank
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                r = rank.get(parts[k] + parts[k + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, k
            if at < 0:
                return False
            if len(parts) == 2:
                self.parts[piece] = (parts[0], parts[1])
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return True

    def agree(self, left: int, right: int) -> bool:
        """Whether two neighbours stay apart: their merges are undone from the last one on, and at no time may what then
        stands at the boundary have a merge that would have come before the one just undone."""
        a, b, rank, parts = self.text[left], self.text[right], self.rank, self.parts
        before, upto = float("inf"), False  # a merge at the boundary wins below this rank, and at it if upto
        while True:
            r = rank.get(a + b)
            if r is not None and (r < before or upto and r == before):
                return False
            made_a, made_b = rank[a] if a in parts else -1, rank[b] if b in parts else -1
            if made_a < 0 and made_b < 0:
                return True
            if made_a > made_b:
                before, upto, a = made_a, False, parts[a][1]
            else:  # of equal merges the leftmost comes first, and the boundary is left of b's
                before, upto, b = made_b, True, parts[b][0]

    def agrees(self, left: int, right: int) -> bool:
        key = left * len(self.text) + right
        ok = self.agreed.get(key)
        if ok is None:
            if len(self.agreed) >= REMEMBERED:
                self.agreed.clear()
            ok = self.agreed[key] = self.agree(left, right)
        return ok

    def stream(self, text: str) -> list[int]:
        """Ids of a run. An automaton of the pieces of several characters gives the arcs in the order of their ends, longest
        first, so a position is final before an arc starts there; one that no such arc reaches has the character before it
        as its last piece, as some piece must be (-1: it has none, goes to bytes and merges with nothing)."""
        agreed, single, pieces, bits, longest = self.agreed, self.single, len(self.text), self.bits, self.longest
        mask = (1 << bits) - 1
        window = Window()
        last, size = window.last, window.size
        for end, arc in self.arcs(text):
            at = end - window.off
            n = len(last)
            if n <= at:
                last += [single.get(c, -1) for c in text[n + window.off - 1 : end]]
                size += [1] * (at + 1 - n)
            elif n == at + 2:
                continue  # reached by a longer piece
            i, width = arc >> bits, arc & mask
            left = last[at + 1 - width]
            if left >= 0:
                ok = agreed.get(left * pieces + i)
                if not (self.agrees(left, i) if ok is None else ok):
                    continue
            last.append(i)
            size.append(width)
            if at >= longest:
                window.advance(text, longest, self.model.bytes)
        rest = text[len(last) + window.off - 1 :]
        for at in range(0, len(rest), longest):  # no arc ends here
            last += [single.get(c, -1) for c in rest[at : at + longest]]
            size += [1] * (len(rest[at : at + longest]))
            if len(last) > longest:
                window.advance(text, longest, self.model.bytes)
        window.finish(text, self.model.bytes)
        return window.out

    def encode(self, text: str) -> bytes:
        """Ids as native 32-bit integers."""
        if not text:
            return b""
        runs = self.cut(MARK + text.replace(" ", MARK))
        known = list(map(self.remembered.get, runs))
        if None in known:
            known = [self.look_up(run) if got is None else got for run, got in zip(runs, known)]
        return b"".join(known) if self.model.bytes else self.with_unknown(b"".join(known))

    def with_unknown(self, ids: bytes) -> bytes:
        """Without pieces for bytes, characters in a row that no piece has are one unknown id."""
        found = memoryview(ids).cast("i").tolist()
        return array("i", [self.model.unknown if i < 0 else i for k, i in enumerate(found) if i >= 0 or not k or found[k - 1] >= 0]).tobytes()

    def look_up(self, run: str) -> bytes:
        """Two generations of remembered runs: when the young one is full it becomes the old one, and what is used returns."""
        got = self.remembered.get(run) or self.older.get(run)
        if got is None:
            got = array("i", self.stream(run)).tobytes()
        if len(run) <= MEMORABLE:
            if len(self.remembered) >= REMEMBERED:
                self.older, self.remembered = self.remembered, {}
            self.remembered[run] = got
        return got


def decode(model: PieceModel, ids) -> str:
    raw = model.raw
    text = b"".join([raw[i] for i in ids]).decode("utf-8", "replace")
    return text[1:] if text.startswith(" ") else text


def piece_encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: PieceModel | None = None, with_text: bool = False) -> DataFrame:
    """One row per document: id, n_ids, ids, round_trip; with_text adds the decoded text."""
    import pyarrow as pa

    shared = docs.sparkSession.sparkContext.broadcast(model or PieceModel.load())  # a vocabulary, some MB
    schema = f"{id_col} {docs.schema[id_col].dataType.simpleString()}, n_ids int, ids array<int>, round_trip boolean" + ", decoded string" * with_text

    def run(batches):
        import numpy as np

        encoder = Encoder(shared.value)
        for whole in batches:
            for b in slices(whole, 1):
                ids, same, texts = [], [], []
                for text in b.column(1).to_pylist():
                    got = encoder.encode(text or "")
                    ids.append(got)
                    back = decode(shared.value, memoryview(got).cast("i"))
                    same.append(back == (text or ""))
                    if with_text:
                        texts.append(back)
                n = pa.array([len(x) // 4 for x in ids], pa.int32())
                ends = pa.array(np.cumsum([0, *n.to_numpy()]), pa.int32())
                lists = pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(ids), np.int32)))
                yield pa.RecordBatch.from_arrays([b.column(0), n, lists, pa.array(same), *([pa.array(texts, pa.string())] if with_text else [])], [id_col, "n_ids", "ids", "round_trip", *(["decoded"] if with_text else [])])

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def piece_decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", model: PieceModel | None = None) -> DataFrame:
    """id and text of encoded rows; null ids decode to the empty text."""
    import pyarrow as pa

    shared = encoded.sparkSession.sparkContext.broadcast(model or PieceModel.load())

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([decode(shared.value, ids or []) for ids in b.column(1).to_pylist()], pa.string())], [id_col, "text"])

    return encoded.select(F.col(id_col), F.col(ids_col)).mapInArrow(run, f"{id_col} {encoded.schema[id_col].dataType.simpleString()}, text string")


def op8_sentencepiece(spark, sf_dir: str) -> DataFrame:
    return piece_encode(spark.read.parquet(f"{sf_dir}/documents.parquet"))
