"""Old binary workbooks: streams out of a compound file, cells out of their records (BIFF8)."""

from __future__ import annotations

import struct
from collections.abc import Iterator

#: Fixed values of the two formats: signature, end of a chain, record types and error codes.
SIGNATURE = bytes.fromhex("D0CF11E0A1B11AE1")
LAST = 0xFFFFFFFA
BOF, END, SHEET, CONTINUE, STRINGS = 0x809, 0x0A, 0x85, 0x3C, 0xFC
FORMULA, TEXT_RESULT, LABEL, RICH_LABEL, SHARED_LABEL, NUMBER, RK, MANY_RK, BOOL_OR_ERROR = 0x06, 0x207, 0x204, 0xD6, 0xFD, 0x203, 0x27E, 0xBD, 0x205
ERRORS = {0x00: "#NULL!", 0x07: "#DIV/0!", 0x0F: "#VALUE!", 0x17: "#REF!", 0x1D: "#NAME?", 0x24: "#NUM!", 0x2A: "#N/A"}


def stream(content: bytes, names: tuple[str, ...] = ("Workbook", "Book")) -> bytes:
    """The first of the named streams of a compound file. Raises ValueError where there is none."""
    if content[:8] != SIGNATURE or len(content) < 512:
        raise ValueError("not a compound file")
    shift, small_shift = struct.unpack_from("<HH", content, 30)
    size = 1 << shift
    first_dir, _, cutoff, first_small, _, first_more, n_more = struct.unpack_from("<7I", content, 48)
    sector = lambda i: content[(i + 1) * size : (i + 2) * size]
    tables = [t for t in struct.unpack_from("<109I", content, 76) if t < LAST]
    for _ in range(n_more):
        if first_more >= LAST:
            break
        *more, first_more = struct.unpack(f"<{size // 4}I", sector(first_more))
        tables += [t for t in more if t < LAST]
    links = [x for t in tables for x in struct.unpack(f"<{size // 4}I", sector(t).ljust(size, b"\xff"))]

    def chain(start: int, links: list[int]) -> Iterator[int]:
        seen = 0
        while start < LAST and start < len(links) and seen <= len(links):
            yield start
            start, seen = links[start], seen + 1

    read = lambda start: b"".join(map(sector, chain(start, links)))
    folder = read(first_dir)
    entries = {}
    root = b""
    for at in range(0, len(folder) - 127, 128):
        length, kind = struct.unpack_from("<HB", folder, at + 64)
        start, bytes_ = struct.unpack_from("<II", folder, at + 116)
        if kind == 5:
            root = read(start)
        elif kind == 2:
            entries[folder[at : at + max(0, length - 2)].decode("utf-16-le", "replace")] = (start, bytes_)
    found = next((entries[n] for n in names if n in entries), None)
    if found is None:
        raise ValueError("no workbook in the compound file")
    start, bytes_ = found
    if bytes_ >= cutoff:
        return read(start)[:bytes_]
    small = struct.unpack(f"<{len(t := read(first_small)) // 4}I", t) if first_small < LAST else ()
    step = 1 << small_shift
    return b"".join(root[i * step : (i + 1) * step] for i in chain(start, list(small)))[:bytes_]


def records(data: bytes, at: int = 0) -> Iterator[tuple[int, list[bytes]]]:
    """(type, parts): a record with what continues it. Ends where the data does."""
    kind, parts = None, []
    while at + 4 <= len(data):
        k, n = struct.unpack_from("<HH", data, at)
        body = data[at + 4 : at + 4 + n]
        at += 4 + n
        if k == CONTINUE and kind is not None:
            parts.append(body)
            continue
        if kind is not None:
            yield kind, parts
        kind, parts = k, [body]
    if kind is not None:
        yield kind, parts


def text(body: bytes, at: int, width: int = 2) -> str:
    """A string within one record: its length in ``width`` bytes, a flag for two bytes a sign, the signs."""
    n = int.from_bytes(body[at : at + width], "little")
    at += width
    if body[at] & 1:
        return body[at + 1 : at + 1 + 2 * n].decode("utf-16-le", "replace")
    return body[at + 1 : at + 1 + n].decode("latin-1")


def shared_strings(parts: list[bytes]) -> list[str]:
    """The table of strings. Where one goes on in the next part, that part starts with a flag of its own."""
    out: list[str] = []
    count = struct.unpack_from("<I", parts[0], 4)[0]
    k, at = 0, 8

    def take(n: int) -> bytes:
        nonlocal k, at
        got = b""
        while n and k < len(parts):
            piece = parts[k][at : at + n]
            got, at, n = got + piece, at + len(piece), n - len(piece)
            if n:
                k, at = k + 1, 0
        return got

    for _ in range(count):
        if k < len(parts) and at >= len(parts[k]):
            k, at = k + 1, 0
        if k >= len(parts):
            break
        n, flags = struct.unpack("<HB", take(3))
        runs = int.from_bytes(take(2), "little") if flags & 8 else 0
        extra = int.from_bytes(take(4), "little") if flags & 4 else 0
        wide, signs = flags & 1, ""
        while n and k < len(parts):
            left = (len(parts[k]) - at) // (1 + wide)
            some = parts[k][at : at + min(n, left) * (1 + wide)]
            signs += some.decode("utf-16-le" if wide else "latin-1", "replace")
            at, n = at + len(some), n - min(n, left)
            if n:
                k, at = k + 1, 1
                wide = parts[k][0] & 1 if k < len(parts) else 0
        take(4 * runs + extra)
        out.append(signs)
    return out


def number(v: float) -> str:
    return str(int(v)) if v == v and abs(v) < 1e15 and v == int(v) else repr(v)


def rk(v: int) -> float:
    """The short form of a number: an integer or the upper half of a double, perhaps a hundredfold."""
    x = float(v - (1 << 32) >> 2 if v & 1 << 31 else v >> 2) if v & 2 else struct.unpack("<d", struct.pack("<Q", (v & 0xFFFFFFFC) << 32))[0]
    return x / 100 if v & 1 else x


def cells(data: bytes, at: int, shared: list[str]) -> dict[int, dict[int, str]]:
    """row -> column -> value of the sheet that starts at ``at``: values as they are cached, as text."""
    out: dict[int, dict[int, str]] = {}
    waiting = None
    for kind, parts in records(data, at):
        b = parts[0]
        if kind == END:
            break
        if kind == TEXT_RESULT and waiting:
            out.setdefault(waiting[0], {})[waiting[1]] = text(b, 0)
            continue
        if kind not in (FORMULA, LABEL, RICH_LABEL, SHARED_LABEL, NUMBER, RK, MANY_RK, BOOL_OR_ERROR):
            continue
        row, col = struct.unpack_from("<HH", b)
        value: str | None = None
        if kind == SHARED_LABEL:
            value = shared[struct.unpack_from("<I", b, 6)[0]]
        elif kind in (LABEL, RICH_LABEL):
            value = text(b, 6)
        elif kind == NUMBER:
            value = number(struct.unpack_from("<d", b, 6)[0])
        elif kind == RK:
            value = number(rk(struct.unpack_from("<I", b, 6)[0]))
        elif kind == MANY_RK:
            for i in range((len(b) - 6) // 6):
                out.setdefault(row, {})[col + i] = number(rk(struct.unpack_from("<I", b, 6 + 6 * i)[0]))
        elif kind == BOOL_OR_ERROR:
            value = ERRORS.get(b[6]) if b[7] else str(bool(b[6]))
        elif b[12:14] != b"\xff\xff":
            value = number(struct.unpack_from("<d", b, 6)[0])
        elif b[6] == 0:
            waiting = (row, col)
        elif b[6] in (1, 2):
            value = str(bool(b[8])) if b[6] == 1 else ERRORS.get(b[8])
        if value is not None:
            out.setdefault(row, {})[col] = value
    return out


def sheets(content: bytes) -> Iterator[tuple[str, Iterator[tuple[int, list[str | None]]]]]:
    """(name, rows) of each sheet; rows as (number from 1, cells), those without a value left out."""
    data = stream(content)
    found: list[tuple[int, str]] = []
    shared: list[str] = []
    for kind, parts in records(data):
        if kind == SHEET and parts[0][5] == 0:  # no charts or macros
            found.append((struct.unpack_from("<I", parts[0])[0], text(parts[0], 6, 1)))
        elif kind == STRINGS:
            shared = shared_strings(parts)
        elif kind == END:
            break

    def rows(at: int) -> Iterator[tuple[int, list[str | None]]]:
        for row, values in sorted(cells(data, at, shared).items()):
            yield row + 1, [values.get(c) for c in range(max(values) + 1)]

    for at, name in found:
        yield name, rows(at)
