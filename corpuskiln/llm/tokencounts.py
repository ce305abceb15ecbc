"""Token counts of a document's sections from one encoding of the whole document.

A document is encoded once. The tokens' byte spans are the running sums of their lengths; sections are character spans;
an interval join inside the task (a binary search of token ends in section starts) gives each token its section. A token
that crosses a boundary goes, by ``rule``, to the section of its first character ("start"), of its last ("end"), or to
the one that holds most of its bytes, the earlier of equal ones ("most"). So sections' counts add up to the document's.

Sections are the text's lines, each with its line feed, or a column of spans (array<struct<start:int,stop:int>>, in
characters, ascending, not overlapping); characters that no span covers count for section -1.

Long runs of white space, which the tokenizer's own matching can't take, are cut out first where the pattern ends its pieces
anyway, so ids stay the same; texts of any length are encoded whole.

A text that can't be counted has null counts, and ``error`` says why; elsewhere ``error`` is null. It has its sections all the
same, if the tokenizer (of another pattern or vocabulary) breaks down on it, or if the pattern leaves out some of a text that
has several sections: ids alone don't tell where its tokens are. If its spans aren't as above (null, negative, descending or
overlapping), it has one section, -1, of all its characters. Sums of counts leave such texts out, so look at ``error`` first.
Any other exception, like a lack of memory, is no row but ends the task.

Defined results: a null or empty text has one section, 0, of no characters and no tokens; spans are cut off at the text's end,
and without spans all of the text is section -1; rows that share an id are rows of their own; an empty table gives an empty table;
other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from corpuskiln.llm.common import slices

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The pattern the vocabulary's own pieces follow: a fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters of white space in a row from which on a run is cut out: a fixed set, Unicode's.
LONG_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{4096,}")


class Uncounted(ValueError):
    """A text's tokens can't be counted; the message is its ``error``."""


def ascending(spans: list | None) -> bool:
    edges = [0, *(x for span in spans or [] for x in span or (None,))]
    return None not in edges and all(a <= b for a, b in zip(edges, edges[1:]))


class Tokens:
    """A byte-level encoding; made in each task from the vocabulary file's content."""

    def __init__(self, ranks: bytes, pattern: str = PATTERN):
        import base64

        import numpy as np
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.own = pattern == PATTERN
        self.width = np.zeros(max(table.values()) + 1, np.int64)
        for piece, i in table.items():
            self.width[i] = len(piece)

    def encode(self, text: str) -> list[int]:
        """The text's ids, or Uncounted if the tokenizer breaks down on it."""
        try:
            return self._encode(text)
        except BaseException as e:  # the tokenizer's own way to end is no Exception, and its class can't be imported
            if (type(e).__module__, type(e).__name__) != ("pyo3_runtime", "PanicException"):
                raise
            raise Uncounted(f"the tokenizer breaks down: {e}") from None

    def _encode(self, text: str) -> list[int]:
        """A run of white space is one piece but for its last character, if something follows: that begins the next."""
        ids, at = [], 0
        for run in LONG_SPACE.finditer(text) if self.own else ():
            end = run.end() - (run.end() < len(text))
            ids += self.encoding.encode_ordinary(text[at : run.start()])
            ids += self.encoding._encode_single_piece(text[run.start() : end])
            at = end
        return ids + self.encoding.encode_ordinary(text[at:])

    def sections(self, text: str, spans: list[tuple[int, int]] | None = None):
        """(section, start, stop) as arrays, and the byte at which each character starts, with the text's end."""
        import numpy as np

        raw = np.frombuffer(text.encode(), np.uint8)
        first = np.flatnonzero((raw & 0xC0) != 0x80)  # byte at which each character starts
        if spans is None:
            char_ends = np.searchsorted(first, np.flatnonzero(raw == 10)) + 1
            ends = char_ends if len(char_ends) and char_ends[-1] == len(first) else np.append(char_ends, len(first))
            starts = np.append(0, ends[:-1])
            names = np.arange(len(starts))
        else:  # what lies between spans becomes sections named -1
            edges, names = [0], []
            for k, (a, b) in enumerate(spans):
                a, b = min(a, len(first)), min(b, len(first))
                if a > edges[-1]:
                    edges.append(a)
                    names.append(-1)
                edges.append(b)
                names.append(k)
            if edges[-1] < len(first) or not names:
                edges.append(len(first))
                names.append(-1)
            starts, ends, names = np.array(edges[:-1]), np.array(edges[1:]), np.array(names)
        return names, starts, ends, np.append(first, len(raw))

    def count(self, text: str, spans: list[tuple[int, int]] | None = None, rule: str = "start"):
        """(section, start, stop, tokens, crossing) as arrays, or Uncounted."""
        import numpy as np

        if not ascending(spans):
            raise Uncounted("spans are null, negative, descending or overlapping")
        names, starts, ends, byte_at = self.sections(text, spans)
        ids = self.encode(text)
        stop = np.cumsum(self.width[np.array(ids, np.int64)])
        if len(ids) and len(names) > 1 and stop[-1] != byte_at[-1]:
            raise Uncounted(f"the pattern leaves out {byte_at[-1] - stop[-1]} bytes")
        start = np.append(0, stop[:-1])[: len(stop)]
        from_, to = byte_at[starts], byte_at[ends]
        find = lambda x: np.searchsorted(to, x, "right")  # noqa: E731  the first section that ends after byte x
        a, b = find(start), find(stop - 1)
        where = a
        if rule == "end":
            where = b
        elif rule == "most":
            where = a.copy()
            for t in np.flatnonzero(a != b):
                held = np.minimum(to[a[t] : b[t] + 1], stop[t]) - np.maximum(from_[a[t] : b[t] + 1], start[t])
                where[t] = a[t] + int(np.argmax(held))
        n = np.bincount(where, minlength=len(starts))
        crossing = np.bincount(where[a != b], minlength=len(starts))
        return names, starts, ends, n, crossing

    def rows(self, text: str, spans: list | None = None, rule: str = "start"):
        """What count gives, and None; of a text that can't be counted, its sections, counts of -1, and why."""
        import numpy as np

        try:
            return *self.count(text, spans, rule), None
        except Uncounted as e:
            *found, _ = self.sections(text, spans if ascending(spans) else [])
            none = np.full(len(found[0]), -1)
            return *found, none, none, str(e)


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", spans_col: str | None = None, rule: str = "start", ranks_path: str = RANKS, pattern: str = PATTERN) -> DataFrame:
    """One row per section: id, section, start, stop, n_tokens, n_crossing, error. The vocabulary is read where the driver runs."""
    import pyarrow as pa

    if rule not in ("start", "end", "most"):
        raise ValueError(f"no such rule: {rule}")
    with open(ranks_path, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary, about 1 MB

    def run(batches):
        import numpy as np

        tokens = Tokens(shared.value, pattern)
        for whole in batches:
            for b in slices(whole, 1):
                texts = b.column(1).to_pylist()
                spans = b.column(2).to_pylist() if spans_col else [None] * len(texts)
                found = [tokens.rows(t or "", [x and (x["start"], x["stop"]) for x in s or []] if spans_col else None, rule) for t, s in zip(texts, spans)]
                if found:
                    rows = pa.array(np.repeat(np.arange(len(found)), [len(x[0]) for x in found]))
                    errors = pa.array([x[5] for x in found], pa.string()).take(rows)
                    cols = [np.concatenate([x[k] for x in found]) for k in range(5)]
                    yield pa.RecordBatch.from_arrays([b.column(0).take(rows), *[pa.array(c, t, mask=c < 0 if k > 2 else None) for k, (c, t) in enumerate(zip(cols, (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64())))], errors], [id_col, "section", "start", "stop", "n_tokens", "n_crossing", "error"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col, *([spans_col] if spans_col else [])).mapInArrow(run, f"{id_col} {kind}, section int, start int, stop int, n_tokens long, n_crossing long, error string")


def op5_token_counts(spark, sf_dir: str) -> DataFrame:
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
