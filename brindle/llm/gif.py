"""GIF: LZW code streams, palettes, disposal and transparency, timed frames with colour histograms."""

from __future__ import annotations

import functools
import hashlib
import json
import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brindle.llm import common

#: Fixed values of the format: largest table, sub-block size, row order of interlaced images (start, step).
TABLE, BLOCK = 4096, 255
PASSES = ((0, 8), (4, 8), (2, 4), (1, 2))
WIDTH, ROWS = 64, 1024
GREY = bytes(v for i in range(256) for v in (i, i, i))


def lzw_encode(data: bytes, bits: int = 8) -> bytes:
    """The code stream of ``data`` (before it is cut into sub-blocks). The table is cleared when it is full."""
    clear, end = 1 << bits, (1 << bits) + 1
    codes, lengths = [], []  # codes between clears, and how many
    append = codes.append
    table: dict[int, int] = {}
    nxt, done = end + 1, 0
    if data:
        cur = data[0]
        for b in memoryview(data)[1:]:
            key = cur << 8 | b
            if key in table:
                cur = table[key]
                continue
            append(cur)
            cur = b
            if nxt < TABLE:
                table[key] = nxt
                nxt += 1
            else:
                append(clear)
                lengths.append(len(codes) - done)
                done = len(codes)
                table = {}
                nxt = end + 1
        append(cur)
    append(end)
    lengths.append(len(codes) - done)
    widths = np.concatenate([np.full(1, bits + 1), *(_schedule(bits)[:n] for n in lengths)])
    return _pack(np.concatenate([[clear], np.array(codes, np.int64)]), widths)


@functools.cache
def _schedule(bits: int) -> np.ndarray:
    """Widths of the codes after a clear: when the k-th (from 0) is read, 2**bits + 1 + k entries precede the one it adds."""
    size = (1 << bits) + 1 + np.arange(TABLE + 2)
    size[0] += 1
    w = np.minimum(12, np.floor(np.log2(size)).astype(np.int64) + 1)
    w[0] = bits + 1
    return w


def _pack(codes: np.ndarray, widths: np.ndarray) -> bytes:
    """Little-endian bit packing of codes of at most 12 bits."""
    bits = np.unpackbits(codes.astype("<u2").view(np.uint8).reshape(-1, 2), axis=1, bitorder="little")[:, :12]
    return np.packbits(bits[np.arange(12) < widths[:, None]], bitorder="little").tobytes()


def lzw_decode(stream: bytes, bits: int, n_pixels: int) -> bytes:
    """At most ``n_pixels`` indices. A code beyond the table, or an early end, ends the image; what is there stays.

    After a clear the widths follow from the number of codes alone, so codes come out of the bits in bulk, and only
    the joining of strings goes code by code.
    """
    clear, end = 1 << bits, (1 << bits) + 1
    raw = np.frombuffer(stream + bytes(4), np.uint8).astype(np.int64)
    n_bits, at, got = 8 * len(stream), 0, 0
    singles = [bytes([i]) if i < 256 else b"" for i in range(clear)] + [b"", b""]
    schedule = _schedule(bits)[: TABLE - end]  # as many as the table takes entries, and the first
    starts, ends = np.cumsum(schedule) - schedule, np.cumsum(schedule)
    out: list[bytes] = []

    def read(pos: np.ndarray, width: np.ndarray) -> np.ndarray:
        byte = pos >> 3
        return ((raw[byte] | raw[byte + 1] << 8 | raw[byte + 2] << 16) >> (pos & 7)) & ((1 << width) - 1)

    while got < n_pixels:
        fit = int(np.searchsorted(ends, n_bits - at, side="right"))
        codes = read(at + starts[:fit], schedule[:fit])
        special = np.flatnonzero((codes == clear) | (codes == end))
        stop = int(special[0]) if len(special) else fit
        table = singles.copy()
        add, emit, before = table.append, out.append, None
        first = len(out)
        for c in codes[:stop].tolist():
            try:
                s = table[c]
                if before is not None:
                    add(before + s[:1])
            except IndexError:
                if before is None or c != len(table):
                    return b"".join(out)[:n_pixels]
                s = before + before[:1]
                add(s)
            emit(s)
            before = s
        got += sum(map(len, out[first:]))
        if stop < fit:
            if codes[stop] == end:
                break
            at += int(ends[stop])
            continue
        if fit < len(schedule):
            break
        at += int(ends[-1])
        while at + 12 <= n_bits and got < n_pixels:  # a full table without a clear: codes of 12 bits go on
            c = int(read(np.array([at]), np.array([12]))[0])
            at += 12
            if c == clear:
                break
            if c == end or c >= len(table):
                return b"".join(out)[:n_pixels]
            emit(table[c])
            got += len(table[c])
        else:
            break
    return b"".join(out)[:n_pixels]


def _blocks(data: bytes) -> bytes:
    return b"".join(bytes([len(p)]) + p for p in (data[i : i + BLOCK] for i in range(0, len(data), BLOCK))) + b"\0"


def encode_samples(payload: bytes, width: int = WIDTH, rows: int = ROWS, delay: int = 4) -> bytes:
    """A GIF whose frames hold ``payload`` (a multiple of ``width``) as indices of a grey palette, top to bottom."""
    frames = [payload[i : i + width * rows] for i in range(0, len(payload), width * rows)]
    out = [b"GIF89a", struct.pack("<HHBBB", width, max(len(f) for f in frames) // width, 0xF7, 0, 0), GREY]
    for f in frames:
        out += [b"\x21\xf9\x04", struct.pack("<BHB", 1 << 2, delay, 0), b"\0\x2c", struct.pack("<HHHHB", 0, 0, width, len(f) // width, 0), b"\x08", _blocks(lzw_encode(f))]
    return b"".join(out) + b"\x3b"


def frames(media: bytes, compose: bool = True) -> dict:
    """Parse and render a GIF: {"width", "height", "loops", "frames": [{...}]}.

    A frame has left, top, width, height, delay_cs, disposal, transparent (index or None), indices (2-D) and, if
    ``compose``, canvas: the RGBA canvas after drawing. Disposal 2 clears the frame's place, 3 restores what was
    there, 0 and 1 leave it. Pixels of the transparent index leave the canvas as it is. Raises ValueError where the
    header is no GIF; a file cut short gives the frames before the cut.
    """
    if media[:6] not in (b"GIF87a", b"GIF89a") or len(media) < 13:
        raise ValueError("not a GIF")
    width, height, flags = struct.unpack("<HHB", media[6:11])
    at = 13
    shared = None
    if flags & 0x80:
        n = 3 << ((flags & 7) + 1)
        shared, at = np.frombuffer(media[at : at + n].ljust(n, b"\0"), np.uint8).reshape(-1, 3), at + n
    out = {"width": width, "height": height, "loops": None, "frames": []}
    canvas = np.zeros((height, width, 4), np.uint8) if compose else None
    delay, disposal, transparent = 0, 0, None

    def sub_blocks(at: int) -> tuple[bytes, int]:
        parts = []
        while at < len(media) and media[at]:
            parts.append(media[at + 1 : at + 1 + media[at]])
            at += 1 + media[at]
        return b"".join(parts), at + 1

    while at < len(media):
        kind = media[at]
        if kind == 0x21:
            label = media[at + 1] if at + 1 < len(media) else 0
            data, at = sub_blocks(at + 2)
            if label == 0xF9 and len(data) >= 4:
                packed, delay, index = struct.unpack("<BHB", data[:4])
                disposal, transparent = packed >> 2 & 7, index if packed & 1 else None
            elif label == 0xFF and data[:11] == b"NETSCAPE2.0" and len(data) >= 14:
                out["loops"] = struct.unpack("<H", data[12:14])[0]
        elif kind == 0x2C and at + 11 <= len(media):
            left, top, w, h, packed = struct.unpack("<HHHHB", media[at + 1 : at + 10])
            at += 10
            palette = shared
            if packed & 0x80:
                n = 3 << ((packed & 7) + 1)
                palette, at = np.frombuffer(media[at : at + n].ljust(n, b"\0"), np.uint8).reshape(-1, 3), at + n
            bits = media[at] if at < len(media) else 8
            stream, at = sub_blocks(at + 1)
            flat = lzw_decode(stream, bits, w * h) if 1 <= bits <= 11 else b""
            indices = np.frombuffer(flat.ljust(w * h, b"\0"), np.uint8).reshape(h, w)
            if packed & 0x40:
                order = [r for start, step in PASSES for r in range(start, h, step)]
                turned = np.empty_like(indices)
                turned[order] = indices
                indices = turned
            frame = {"left": left, "top": top, "width": w, "height": h, "delay_cs": delay, "disposal": disposal, "transparent": transparent, "indices": indices, "palette": palette}
            if compose:
                y1, x1 = min(height, top + h), min(width, left + w)
                area = canvas[top:y1, left:x1]
                saved = area.copy() if disposal == 3 else None
                if area.size:
                    full = np.zeros((256, 4), np.uint8)
                    if palette is not None:
                        full[: len(palette), :3] = palette
                    full[:, 3] = 255
                    seen = indices[: y1 - top, : x1 - left]
                    if transparent is None:
                        area[...] = full[seen]
                    else:
                        area[seen != transparent] = full[seen[seen != transparent]]
                frame["canvas"] = canvas.copy()
                if disposal == 2:
                    area[...] = 0
                elif disposal == 3:
                    area[...] = saved
            out["frames"].append(frame)
            delay, disposal, transparent = 0, 0, None
        else:
            break  # the trailer, or nothing known
    return out


def histogram(canvas: np.ndarray, levels: int = 4) -> np.ndarray:
    """Counts of opaque pixels in levels**3 colour cells."""
    rgb = (canvas[..., :3].astype(np.uint16) * levels) >> 8
    cell = (rgb[..., 0] * levels + rgb[..., 1]) * levels + rgb[..., 2]
    return np.bincount(cell[canvas[..., 3] > 0].ravel(), minlength=levels**3)


FRAME_SCHEMA = T.ArrayType(
    T.StructType([T.StructField(n, T.LongType()) for n in ("frame", "start_cs", "delay_cs", "left", "top", "width", "height", "disposal")] + [T.StructField("histogram", T.ArrayType(T.LongType()))])
)


def media_frames(df: DataFrame, media_col: str = "media", id_col: str = "doc_id") -> DataFrame:
    """Rows (doc_id, error, frame, start_cs, delay_cs, left, top, width, height, disposal, histogram), a row for each
    timed frame, in order. A null or broken file gives one row with an error and null frame columns. Repeated rows and
    equal files have rows of their own; a null id stays null, extra columns are not read, an empty table gives no rows."""
    schema = T.StructType([T.StructField("doc_id", df.schema[id_col].dataType), T.StructField("error", T.StringType()), T.StructField("frames", FRAME_SCHEMA)])

    def run(batch):
        errors, found = [], []
        for media in batch.column(1):
            rows, error = [], None
            try:
                rows, _ = timed(media.as_py() or b"")
            except ValueError as e:
                error = str(e)
            errors.append(error)
            found.append(rows)
        return common.batch(schema, [batch.column(0), errors, found])

    rows = common.map_batches(df.select(id_col, media_col), run, schema)
    return rows.select("doc_id", "error", F.explode_outer("frames").alias("f")).select("doc_id", "error", "f.*")


def timed(media: bytes) -> tuple[list[dict], list[np.ndarray]]:
    """The timed frames of a GIF, as rows of ``FRAME_SCHEMA``, and their canvases."""
    rows, canvases, start = [], [], 0
    for i, f in enumerate(frames(media)["frames"]):
        rows.append({"frame": i, "start_cs": start, "histogram": histogram(f["canvas"]).tolist()} | {k: f[k] for k in ("delay_cs", "left", "top", "width", "height", "disposal")})
        canvases.append(f["canvas"])
        start += f["delay_cs"]
    return rows, canvases


def store_texts(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", rows: int = ROWS) -> DataFrame:
    """Store each text as a GIF, read it back, and describe it: doc_id, n_bytes, payload_bytes, payload_sha256,
    tail_crc32, media_bytes, media_sha256, feature, n_frames, duration_cs, frames.

    The payload is the text's UTF-8 (a null text is empty) with zero bytes up to a positive multiple of 64; pixels
    are its bytes, in rows of 64, ``rows`` of them a frame. The file is decoded and every frame is rendered; all digests of the payload are of
    the rendered pixels. frames holds the timed frames with their colour histograms as JSON, in the fields of
    ``media_frames``; the feature is the sum of the histograms, as cell=count of the cells that are not empty. A row for
    each row, repeated rows included; a null id stays null, extra columns are not read, an empty table gives no rows.
    """
    long, string = T.LongType(), T.StringType()
    schema = T.StructType([T.StructField("doc_id", df.schema[id_col].dataType), *(T.StructField(n, k) for n, k in (("n_bytes", long), ("payload_bytes", long), ("payload_sha256", string), ("tail_crc32", long), ("media_bytes", long), ("media_sha256", string), ("feature", string), ("n_frames", long), ("duration_cs", long), ("frames", string)))])

    def run(batch):
        cols: list[list] = [[] for _ in range(10)]
        for text in batch.column(1):
            raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
            payload = raw + b"\0" * (-len(raw) % WIDTH or (0 if raw else WIDTH))
            media = encode_samples(payload, rows=rows)
            found, canvases = timed(media)
            # a grey palette: a pixel's red is its byte; a frame shows what it has drawn at its place
            back = b"".join(c[f["top"] : f["top"] + f["height"], f["left"] : f["left"] + f["width"], 0].tobytes() for f, c in zip(found, canvases))
            total = np.sum([f["histogram"] for f in found], axis=0)
            feature = "rgb64:" + ",".join(f"{k}={total[k]}" for k in np.flatnonzero(total))
            for c, v in zip(cols, (len(raw), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-64:]), len(media), hashlib.sha256(media).hexdigest(), feature, len(found), sum(f["delay_cs"] for f in found), json.dumps(found, separators=(",", ":")))):
                c.append(v)
        return common.batch(schema, [batch.column(0), *cols])

    return common.map_batches(common.ids_and_texts(df, id_col, text_col), run, schema)
