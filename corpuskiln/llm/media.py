"""Media columns from ISO base media files, the payload never decoded.

``write_container`` stores bytes losslessly as 8-bit samples of one audio track: units of 64 samples, sixteen units a
chunk, every sixteenth unit a sync sample. ``media_columns`` knows nothing of the writer: it walks the nested boxes of
any such file (64-bit sizes and size 0 included), track by track, decodes each track's own sample tables (stts, stsc, stsz
or stz2, stco or co64, stss) and gives codec, timescale, duration and the byte ranges of the keyframes, reading no media
data. Counts are held against the boxes' and the file's sizes before anything is made of them, so memory follows the size of
a file whatever it says of itself. ``read_payload`` copies the samples' bytes out by those tables.

Defined results: a null text is empty; the payload is padded with bytes 0 to a positive multiple of 64, so empty texts
have 64 bytes; texts of any length are stored whole, one at a time; equal texts have equal values; rows that share an id are rows of their own; other columns are ignored. A
file that is null, cut short, nested deeper than DEPTH or has no track is one row of ``media_columns`` with null columns, and
``error`` says why; so is a track whose tables don't hold together, beside the file's other tracks. Samples of movie
fragments are in no sample table; a track that has only those is such a row.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from typing import Iterator

from pyspark.sql import DataFrame

from corpuskiln.llm.common import slices

#: Boxes within boxes at most.
DEPTH = 16
UNIT, UNITS_A_CHUNK, SYNC_EVERY, RATE = 64, 16, 16, 8000
#: Fixed values of the format: boxes that only hold boxes.
CONTAINERS = {b"moov", b"trak", b"mdia", b"minf", b"stbl", b"edts", b"dinf", b"udta"}
MATRIX = struct.pack(">9i", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)


def _box(kind: bytes, *body: bytes) -> bytes:
    inner = b"".join(body)
    return struct.pack(">I4s", 8 + len(inner), kind) + inner


def _full(kind: bytes, *body: bytes, flags: int = 0) -> bytes:
    return _box(kind, struct.pack(">I", flags), *body)


def padded(text: str | None) -> tuple[bytes, int]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw + bytes(-len(raw) % UNIT or (UNIT if not raw else 0)), len(raw)


def write_container(payload: bytes) -> bytes:
    """payload: a positive multiple of 64 bytes."""
    units = len(payload) // UNIT
    chunks = -(-units // UNITS_A_CHUNK)
    last = units - (chunks - 1) * UNITS_A_CHUNK
    kinds = [(1, UNITS_A_CHUNK), (chunks, last)] if chunks > 1 and last != UNITS_A_CHUNK else [(1, min(units, UNITS_A_CHUNK))]
    syncs = range(1, units + 1, SYNC_EVERY)
    ftyp = _box(b"ftyp", b"isom", struct.pack(">I", 512), b"isommp41")

    def moov(first: int) -> bytes:
        entry = struct.pack(">I4s6xH8xHHHHI", 36, b"raw ", 1, 1, 8, 0, 0, RATE << 16)
        stbl = _box(
            b"stbl",
            _full(b"stsd", struct.pack(">I", 1), entry),
            _full(b"stts", struct.pack(">III", 1, units, UNIT)),
            _full(b"stsc", struct.pack(">I", len(kinds)), *[struct.pack(">III", at, n, 1) for at, n in kinds]),
            _full(b"stsz", struct.pack(">II", UNIT, units)),
            _full(b"stco", struct.pack(f">I{chunks}I", chunks, *range(first, first + len(payload), UNIT * UNITS_A_CHUNK))),
            _full(b"stss", struct.pack(f">I{len(syncs)}I", len(syncs), *syncs)),
        )
        dref = _full(b"dref", struct.pack(">I", 1), _full(b"url ", flags=1))
        minf = _box(b"minf", _full(b"smhd", bytes(4)), _box(b"dinf", dref), stbl)
        mdhd = _full(b"mdhd", struct.pack(">IIIIHH", 0, 0, RATE, len(payload), 0x55C4, 0))
        hdlr = _full(b"hdlr", struct.pack(">I4s12x", 0, b"soun"), b"\0")
        tkhd = _full(b"tkhd", struct.pack(">IIIII8xHHHH", 0, 0, 1, 0, len(payload), 0, 0, 0x100, 0), MATRIX, bytes(8), flags=7)
        mvhd = _full(b"mvhd", struct.pack(">IIIIIH10x", 0, 0, RATE, len(payload), 0x10000, 0x100), MATRIX, bytes(24), struct.pack(">I", 2))
        return _box(b"moov", mvhd, _box(b"trak", tkhd, _box(b"mdia", mdhd, hdlr, minf)))

    first = len(ftyp) + len(moov(0)) + 8
    return b"".join((ftyp, moov(first), struct.pack(">I4s", 8 + len(payload), b"mdat"), payload))


def walk(data: memoryview) -> Iterator[tuple[tuple, int, int]]:
    """(path, start, end) of every box's content, outer boxes first, in the order of the file."""
    open_boxes: list[tuple[tuple, int, int]] = [((), 0, len(data))]
    while open_boxes:
        path, start, end = open_boxes.pop()
        if start + 8 > end:
            continue
        size, kind = struct.unpack_from(">I4s", data, start)
        head = 8
        if size == 1:
            size, head = struct.unpack_from(">Q", data, start + 8)[0], 16
        elif size == 0:
            size = end - start
        if size < head or start + size > end:
            raise ValueError(f"box {kind!r} at {start} doesn't fit")
        here = (*path, kind)
        if len(here) > DEPTH:
            raise ValueError(f"boxes are nested deeper than {DEPTH}")
        yield here, start + head, start + size
        open_boxes.append((path, start + size, end))
        if kind in CONTAINERS:
            open_boxes.append((here, start + head, start + size))


def tracks_of(data: bytes) -> list[dict]:
    """For each track the content (start, end) of its boxes by kind, the first of a kind."""
    tracks: list[dict] = []
    for path, a, b in walk(memoryview(data)):
        if path[-1] == b"trak":
            tracks.append({})
        elif b"trak" in path:
            tracks[-1].setdefault(path[-1], (a, b))
    return tracks


def sample_tables(data: bytes, found: dict | None = None) -> dict:
    """Codec, handler, timescale, durations, and the samples' offsets and sizes with the keyframes' byte ranges, of one track: of the
    first if found, one of tracks_of, isn't given."""
    import numpy as np

    if found is None:
        found = next(iter(tracks_of(data)), {})
    sizes_box = b"stsz" if b"stsz" in found else b"stz2"
    offsets_box = b"co64" if b"co64" in found and b"stco" not in found else b"stco"
    if missing := [k for k in (b"mdhd", b"stsd", b"stts", b"stsc", sizes_box, offsets_box) if k not in found]:
        raise ValueError(f"no {missing[0].decode()}")
    view = memoryview(data)

    def fields(kind: bytes, code: str, at: int) -> tuple:
        a, b = found[kind]
        if a + at + struct.calcsize(code) > b:
            raise ValueError(f"{kind.decode()} is cut short")
        return struct.unpack_from(code, view, a + at)

    def table(kind: bytes, width: int = 1, code: str = ">u4", at: int = 4):
        """The rows of a table that a count stands before."""
        (n,), (a, b) = fields(kind, ">I", at), found[kind]
        if n * width * np.dtype(code).itemsize > b - a - at - 4:
            raise ValueError(f"{kind.decode()} says {n} entries, more than it has room for")
        return np.frombuffer(view, code, n * width, a + at + 4).astype(np.int64).reshape(n, width)

    version = fields(b"mdhd", ">B", 0)[0]
    timescale, duration = fields(b"mdhd", ">IQ" if version else ">II", 20 if version else 12)
    codec = fields(b"stsd", ">4s", 12)[0].decode("latin-1")
    if sizes_box == b"stsz":
        fixed, count = fields(b"stsz", ">II", 4)
        if fixed and fixed * count > len(data):
            raise ValueError("samples are larger than the file")
        sizes = np.full(count, fixed, np.int64) if fixed else table(b"stsz", at=8)[:, 0]
    else:
        bits, count = fields(b"stz2", ">BI", 7)
        a, b = found[b"stz2"]
        if bits not in (4, 8, 16) or count * bits > (b - a - 12) * 8:
            raise ValueError("stz2 doesn't fit")
        raw = np.frombuffer(view, np.uint8, (count * bits + 7) // 8, a + 12)
        sizes = (np.stack([raw >> 4, raw & 15], 1).ravel()[:count] if bits == 4 else raw if bits == 8 else raw.view(">u2")).astype(np.int64)
    chunks = table(offsets_box, 1, ">u8" if offsets_box == b"co64" else ">u4")[:, 0]
    first, each, _ = table(b"stsc", 3).T
    if len(first) and (first[0] != 1 or (np.diff(first) <= 0).any() or first[-1] > len(chunks)):
        raise ValueError("stsc names chunks that there aren't")
    span = np.diff(np.append(first, len(chunks) + 1)) if len(first) else first
    if sum(x * y for x, y in zip(span.tolist(), each.tolist())) != count or bool(len(first)) != bool(len(chunks)):
        raise ValueError("stsc doesn't count the samples that there are")
    in_chunk = np.repeat(each, span)
    after = np.cumsum(sizes)
    begins = np.cumsum(in_chunk) - in_chunk  # each chunk's first sample
    before = np.append(0, after)[begins]
    offsets = np.repeat(chunks - before, in_chunk) + after - sizes
    if count and (offsets.min() < 0 or (offsets + sizes).max() > len(data)):
        raise ValueError("samples don't fit the file")
    runs, deltas = table(b"stts", 2).T
    if sum(runs.tolist()) != count:
        raise ValueError("stts doesn't count the samples that there are")
    syncs = table(b"stss")[:, 0] - 1 if b"stss" in found else np.arange(count)
    if len(syncs) and (syncs.min() < 0 or syncs.max() >= count):
        raise ValueError("stss names samples that there aren't")
    if not count and any(path[-1] == b"moof" for path, _, _ in walk(view)):
        raise ValueError("samples are in movie fragments")
    keyframes = list(zip(offsets[syncs].tolist(), (offsets + sizes)[syncs].tolist()))
    handler = bytes(view[found[b"hdlr"][0] + 8 : found[b"hdlr"][0] + 12]).decode("latin-1") if b"hdlr" in found else None
    return {"codec": codec, "handler": handler, "timescale": timescale, "duration": duration, "media_duration": sum(x * y for x, y in zip(runs.tolist(), deltas.tolist())), "offsets": offsets, "sizes": sizes, "keyframes": keyframes}


def read_payload(data: bytes, tables: dict) -> bytes:
    """The samples' bytes in their order; neighbouring samples are read as one."""
    import numpy as np

    offsets, ends = tables["offsets"], tables["offsets"] + tables["sizes"]
    if not len(offsets):
        return b""
    at = np.flatnonzero(np.append(True, offsets[1:] != ends[:-1]))
    last = np.append(at[1:], len(offsets)) - 1
    return b"".join([data[a:b] for a, b in zip(offsets[at].tolist(), ends[last].tolist())])


def feature_of(t: dict) -> str:
    return f"codec={t['codec'].strip()};timescale={t['timescale']};duration={t['media_duration']};samples={len(t['offsets'])};keyframes=" + ",".join(f"{a}-{b}" for a, b in t["keyframes"])


def media_columns(files: DataFrame, content_col: str = "content", id_col: str = "id") -> DataFrame:
    """Any table of ISO media files, a row for each track: id, track (from 1), handler, codec, timescale, duration_s, samples,
    keyframes (array of byte ranges), error."""
    import pyarrow as pa

    spans = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    columns = {"track": pa.int32(), "handler": pa.string(), "codec": pa.string(), "timescale": pa.int64(), "duration_s": pa.float64(), "samples": pa.int64(), "keyframes": spans, "error": pa.string()}
    schema = f"id {files.schema[id_col].dataType.simpleString()}, track int, handler string, codec string, timescale long, duration_s double, samples long, keyframes array<struct<start:long,stop:long>>, error string"

    def one(data: bytes, k: int, track: dict) -> tuple:
        try:
            t = sample_tables(data, track)
        except (ValueError, struct.error) as e:
            return (k, *[None] * 6, str(e))
        return (k, t["handler"], t["codec"], t["timescale"], t["duration"] / t["timescale"] if t["timescale"] else None, len(t["sizes"]), [{"start": x, "stop": y} for x, y in t["keyframes"]], None)

    def rows_of(data: bytes) -> list[tuple]:
        try:
            return [one(data, k, track) for k, track in enumerate(tracks_of(data), 1)] or [(*[None] * 7, "no track")]
        except (ValueError, struct.error) as e:
            return [(*[None] * 7, str(e))]

    def read(batches):
        for whole in batches:
            for at in range(whole.num_rows):  # a file's tables may be large
                data = whole.column(1)[at].as_py()
                rows = rows_of(data or b"")
                yield pa.RecordBatch.from_arrays([pa.array([whole.column(0)[at].as_py()] * len(rows), whole.column(0).type), *[pa.array([r[i] for r in rows], t) for i, t in enumerate(columns.values())]], ["id", *columns])

    return files.select(id_col, content_col).mapInArrow(read, schema)


def text_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_media: bool = False) -> DataFrame:
    """Each text stored as a container and read back; with_media adds the container itself as ``media``."""
    import pyarrow as pa

    names = [("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string()), ("codec", pa.string()), ("duration_s", pa.float64()), ("n_keyframes", pa.int64()), *([("media", pa.binary())] if with_media else [])]
    schema = f"{id_col} {docs.schema[id_col].dataType.simpleString()}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, codec string, duration_s double, n_keyframes long" + ", media binary" * with_media

    def one(text):
        payload, n = padded(text)
        media = write_container(payload)
        t = sample_tables(media)
        back = read_payload(media, t)
        return (n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-64:]), len(media), hashlib.sha256(media).hexdigest(), feature_of(t), t["codec"], t["duration"] / t["timescale"], len(t["keyframes"]), media if with_media else None)

    def store(batches):
        for whole in batches:
            for b in slices(whole, 1, 256):
                rows = [one(x.as_py()) for x in b.column(1)]
                yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array([r[i] for r in rows], k) for i, (_, k) in enumerate(names)]], [id_col, *[n for n, _ in names]])

    return docs.select(id_col, text_col).mapInArrow(store, schema)


def op3_media_columns(spark, sf_dir: str) -> DataFrame:
    return text_media(spark.read.parquet(f"{sf_dir}/documents.parquet"))
