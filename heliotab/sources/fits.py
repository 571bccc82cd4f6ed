"""FITS tables, images and headers as a data source: spark.read.format("fits") and df.write.format("fits"), once register(spark) has been called.

Reading is planned from the headers alone; each task reads one block of rows of one table or image, and of these only the bytes of the columns that the schema asks for. Writing makes files of a bounded number of rows, each whole by itself; a job's files get their names when all tasks have ended, so a job that fails leaves none.
"""

import io
import math
import re
import uuid
from dataclasses import dataclass, field
from datetime import date, datetime

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type

#: Bytes of a block of the format, of a header card, and about those of table or image that a task reads or a file is given.
BLOCK, CARD, PART = 2880, 80, 16 << 20

#: Fixed values of the format: letters of binary table columns with their big-endian numpy types, and BITPIX of images.
COLUMN_KINDS = {"L": "S1", "B": ">u1", "I": ">i2", "J": ">i4", "K": ">i8", "A": "S", "E": ">f4", "D": ">f8", "C": ">c8", "M": ">c16", "P": ">i4", "Q": ">i8"}
IMAGE_KINDS = {8: ">u1", 16: ">i2", 32: ">i4", 64: ">i8", -32: ">f4", -64: ">f8"}
#: Offsets by which the format stores integers of the other signedness.
OTHER_SIGN = {"B": -128.0, "I": 2.0**15, "J": 2.0**31, "K": 2.0**63}

_INTEGERS = {"B": T.ShortType(), "I": T.ShortType(), "J": T.IntegerType(), "K": T.LongType()}
_WIDER = {"B": T.ByteType(), "I": T.IntegerType(), "J": T.LongType(), "K": T.DecimalType(20, 0)}
_FORM = re.compile(r"(\d*)([LXBIJKAEDCMPQ])(.*)")


class Damaged(ValueError):
    """A file that isn't whole, or not of this format."""


# -- headers ----------------------------------------------------------------------------------------------------------


def card(keyword: str, value, comment: str = "") -> bytes:
    """One card; texts are quoted, and cut to what a card holds."""
    if isinstance(value, bool):
        text = f"{'T' if value else 'F':>20}"
    elif isinstance(value, str):
        quoted = value.replace("'", "''")[:66]
        text = f"'{quoted:<8}'".ljust(20)
    elif isinstance(value, float):
        text = f"{value!r:>20}".upper()
    else:
        text = f"{value:>20}"
    line = f"{keyword:<8}= {text}" + (f" / {comment}" if comment else "")
    return line[:CARD].ljust(CARD).encode("ascii", "replace")


def parse_card(line: str) -> tuple[str, object, str]:
    """(keyword, value, comment) of a card: a value is a text, a number, true or false, or None; cards without a value have their text as comment."""
    keyword = line[:8].rstrip()
    if line[8:10] != "= " or keyword in ("COMMENT", "HISTORY", ""):
        return keyword, None, line[8:].strip()
    rest = line[10:].strip()
    if rest.startswith("'"):
        m = re.match(r"'((?:[^']|'')*)'\s*(?:/\s?(.*))?$", rest)
        if not m:
            raise Damaged(f"card without a closing quote: {line!r}")
        return keyword, m[1].replace("''", "'").rstrip(), (m[2] or "").strip()
    raw, _, comment = rest.partition("/")
    raw = raw.strip()
    if raw in ("T", "F"):
        return keyword, raw == "T", comment.strip()
    try:
        value = int(raw) if re.fullmatch(r"[+-]?\d+", raw) else float(raw.replace("D", "E")) if raw else None
    except ValueError as e:
        raise Damaged(f"card with an unreadable value: {line!r}") from e
    return keyword, value, comment.strip()


@dataclass
class Unit:
    """A header with the place of its data."""

    number: int
    cards: list[tuple[str, object, str]]
    at: int
    size: int
    values: dict[str, object] = field(default_factory=dict)

    def __post_init__(self):
        self.values = {k: v for k, v, _ in reversed(self.cards)}

    def get(self, keyword: str, default=None):
        found = self.values.get(keyword)
        return default if found is None else found

    @property
    def axes(self) -> list[int]:
        return [int(self.get(f"NAXIS{i + 1}", 0)) for i in range(int(self.get("NAXIS", 0)))]

    @property
    def is_table(self) -> bool:
        return self.get("XTENSION") == "BINTABLE"

    @property
    def heap(self) -> int:
        """The place of the values of columns of varying length."""
        return self.at + int(self.get("THEAP", self.axes[0] * self.axes[1]))


def units(source, size: int) -> list[Unit]:
    """All headers of a file; damaged files are refused: cards that can't be read, a header without END, axes that don't fit, data that end before they should."""
    out, at = [], 0
    while at + BLOCK <= size:
        cards, ended, start = [], False, at
        while not ended:
            source.seek(at)
            block = source.read(BLOCK)
            if len(block) < BLOCK:
                raise Damaged(f"header at {start} has no END")
            at += BLOCK
            try:
                text = block.decode("ascii")
            except UnicodeDecodeError as e:
                raise Damaged(f"header at {start} isn't text") from e
            for i in range(0, BLOCK, CARD):
                line = text[i : i + CARD]
                if line.rstrip() == "END":
                    ended = True
                    break
                if line.strip():
                    cards.append(parse_card(line))
        first = cards[0][0] if cards else None
        if first != ("XTENSION" if out else "SIMPLE"):
            raise Damaged(f"header at {start} begins with {first}")
        unit = Unit(len(out), cards, at, 0)
        axes, bits = unit.axes, int(unit.get("BITPIX", 0))
        if bits not in IMAGE_KINDS or any(n < 0 for n in axes):
            raise Damaged(f"header at {start} has BITPIX {bits} and axes {axes}")
        count = math.prod(axes) if axes else 0
        unit.size = abs(bits) // 8 * int(unit.get("GCOUNT", 1)) * (int(unit.get("PCOUNT", 0)) + count) if out or axes else 0
        if at + unit.size > size:
            raise Damaged(f"data at {at} have {size - at} bytes of {unit.size}")
        out.append(unit)
        at += -(-unit.size // BLOCK) * BLOCK
    if not out or at < size and size - at >= BLOCK:
        raise Damaged("no header, or bytes behind the last unit")
    return out


@dataclass
class Column:
    """A binary table's column as its header has it."""

    name: str
    kind: str
    repeat: int
    offset: int
    width: int
    element: str
    scale: float
    zero: float
    null: int | None

    @property
    def spark(self) -> T.DataType:
        if self.kind == "A":
            return T.StringType()
        if self.kind in "PQ":
            return T.ArrayType(self._one(self.element))
        if self.kind == "X":
            return T.ArrayType(T.BooleanType())
        one = self._one(self.kind)
        return one if self.repeat == 1 else T.ArrayType(one)

    def _one(self, kind: str) -> T.DataType:
        if kind in _INTEGERS:
            if self.scale == 1 and self.zero == 0:
                return _INTEGERS[kind]
            return _WIDER[kind] if self.scale == 1 and self.zero == OTHER_SIGN[kind] else T.DoubleType()
        if kind in "CM":
            return T.ArrayType(T.FloatType() if kind == "C" else T.DoubleType())
        if kind == "A":
            return T.StringType()
        if kind == "L":
            return T.BooleanType()
        return T.DoubleType() if kind == "D" or self.scale != 1 or self.zero != 0 else T.FloatType()


def columns(unit: Unit) -> list[Column]:
    out, offset = [], 0
    for i in range(1, int(unit.get("TFIELDS", 0)) + 1):
        m = _FORM.match(str(unit.get(f"TFORM{i}", "")))
        if not m:
            raise Damaged(f"TFORM{i} is {unit.get(f'TFORM{i}')!r}")
        repeat, kind = int(m[1] or 1), m[2]
        width = -(-repeat // 8) if kind == "X" else repeat * (np.dtype(COLUMN_KINDS[kind]).itemsize * (2 if kind in "PQ" else 1) if kind != "A" else 1)
        out.append(Column(str(unit.get(f"TTYPE{i}", f"c{i}")), kind, repeat, offset, width, m[3][:1], float(unit.get(f"TSCAL{i}", 1.0)), float(unit.get(f"TZERO{i}", 0.0)), unit.get(f"TNULL{i}")))
        offset += width
    if unit.axes[:1] != [offset]:
        raise Damaged(f"columns have {offset} bytes, rows {unit.axes[:1]}")
    return out


# -- values -----------------------------------------------------------------------------------------------------------


def scaled(values: np.ndarray, kind: str, scale: float, zero: float, null, want: pa.DataType) -> pa.Array:
    """Stored numbers as an Arrow array of the wanted type; `null` is the stored integer of a null."""
    mask = values == null if null is not None and values.dtype.kind in "iu" else None
    native = values.astype(values.dtype.newbyteorder("="))
    if scale == 1 and zero == 0:
        return pa.array(native, mask=mask).cast(want)
    if scale == 1 and kind in OTHER_SIGN and zero == OTHER_SIGN[kind]:
        if kind == "K":
            return pa.array([None if mask is not None and m else int(v) + (1 << 63) for v, m in zip(native, mask if mask is not None else [False] * len(native))], type=want)
        return pa.array(native.astype(np.int64) + int(zero), mask=mask).cast(want)
    return pa.array(native * scale + zero, mask=mask).cast(want)


def table_column(block: np.ndarray, c: Column, heap, want: pa.DataType) -> pa.Array:
    """A column of a block of rows (bytes, by row). heap(kind, count, offset) reads values of varying length."""
    n = len(block)
    raw = np.ascontiguousarray(block[:, c.offset : c.offset + c.width])
    if c.kind == "A":
        cut = [bytes(x).split(b"\0", 1)[0].rstrip(b" ") for x in raw.reshape(n, -1)] if c.width else [b""] * n
        return pa.array([x.decode("utf-8", "replace") for x in cut], type=want)
    if c.kind == "X":
        bits = np.unpackbits(raw.reshape(n, -1), axis=1)[:, : c.repeat].astype(bool)
        return pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * c.repeat, pa.array(bits.ravel())).cast(want)
    values = raw.reshape(-1).view(COLUMN_KINDS[c.kind])
    if c.kind in "PQ":
        out = []
        for count, offset in values.reshape(n, 2).tolist():
            out.append(_flat(heap(c.element, count, offset), c.element, c, want.value_type).to_pylist())
        return pa.array(out, type=want)
    if c.repeat == 1 and c.kind not in "CM":
        return _flat(values, c.kind, c, want)
    flat = _flat(values, c.kind, c, want if c.kind in "CM" and c.repeat == 1 else want.value_type)
    return flat if c.kind in "CM" and c.repeat == 1 else pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * c.repeat, flat)


def _flat(values: np.ndarray, kind: str, c: Column, want: pa.DataType) -> pa.Array:
    if kind == "L":
        return pa.array(values == b"T", mask=~np.isin(values, [b"T", b"F"]))
    if kind in "CM":
        native = values.astype(values.dtype.newbyteorder("="))
        pairs = native.view(native.real.dtype)
        return pa.ListArray.from_arrays(np.arange(len(native) + 1, dtype=np.int32) * 2, pa.array(pairs))
    if kind == "A":
        return pa.array([v.decode("ascii", "replace") for v in values], type=want)
    return scaled(values, kind, c.scale, c.zero, c.null, want)


# -- reading ----------------------------------------------------------------------------------------------------------


def _opened(path: str):
    """A file of the machine, or of any file system that Arrow knows by its URI."""
    if "://" in path or path.startswith("file:"):
        if path.startswith("file:"):
            return open(re.sub("^file:/*", "/", path), "rb")
        from pyarrow import fs

        system, inner = fs.FileSystem.from_uri(path)
        return system.open_input_file(inner)
    return open(path, "rb")


def _size(source) -> int:
    source.seek(0, io.SEEK_END)
    return source.tell()


def _files(path: str) -> list[str]:
    """The file, or the folder's files with the endings of the format, in order of their names."""
    from pyarrow import fs

    system, inner = (fs.LocalFileSystem(), re.sub("^file:/*", "/", path)) if path.startswith("file:") or "://" not in path else fs.FileSystem.from_uri(path)
    info = system.get_file_info(inner)
    if info.type == fs.FileType.File:
        return [path]
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    names = sorted(x.base_name for x in system.get_file_info(fs.FileSelector(inner)) if x.is_file and x.base_name.lower().endswith((".fits", ".fit", ".fts")))
    return [f"{path.rstrip('/')}/{n}" for n in names]


def headers_of(path: str) -> list[Unit]:
    with _opened(path) as f:
        return units(f, _size(f))


@dataclass
class Part(InputPartition):
    """Rows first to first + count of a unit; for images, rows of pixels along the first axis."""

    path: str
    unit: Unit
    first: int
    count: int


class FitsSource(DataSource):
    """Options: path (a file or a folder); kind: `table` (default), `image` or `header`; unit: a number, or an EXTNAME, else the first of the kind; nan_is_null: `true` reads NaN as null (null floats are written as NaN).

    Tables have a column for each of the file's: integers with TSCAL, TZERO and TNULL, texts without the blanks at their ends, arrays for repeated values and for those of varying length, arrays of two for complex ones. With several files, the first decides on the schema. With a schema given by the user, only the columns that it names are read.
    Images have a row a pixel: x, y, z, a4, ... (from 0) and v (double; BLANK is null). Headers have a row a card.
    """

    @classmethod
    def name(cls) -> str:
        return "fits"

    def _unit(self, path: str) -> Unit:
        wanted, kind = self.options.get("unit"), self.options.get("kind", "table")
        for u in headers_of(path):
            fits = u.is_table if kind == "table" else not u.is_table and bool(u.axes) and u.get("XTENSION", "IMAGE") == "IMAGE"
            if fits and (wanted is None or wanted == str(u.number) or wanted == u.get("EXTNAME")):
                return u
        raise Damaged(f"{path} has no {kind} {wanted or ''}")

    def schema(self) -> T.StructType | str:
        kind = self.options.get("kind", "table")
        if kind == "header":
            return "file string, unit int, card int, keyword string, value string, comment string"
        files = _files(self.options["path"])
        if not files:
            raise FileNotFoundError(f"{self.options['path']} has no FITS files")
        unit = self._unit(files[0])
        if kind == "image":
            return T.StructType([T.StructField(n, T.IntegerType()) for n in axis_names(len(unit.axes))] + [T.StructField("v", T.DoubleType())])
        return T.StructType([T.StructField(c.name, c.spark) for c in columns(unit)])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return FitsReader(self, schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        return FitsWriter(dict(self.options), schema, overwrite)


def axis_names(n: int) -> list[str]:
    return [("x", "y", "z")[i] if i < 3 else f"a{i + 1}" for i in range(n)]


class FitsReader(DataSourceReader):
    def __init__(self, source: FitsSource, schema: T.StructType):
        self.source, self.schema_, self.options = source, schema, dict(source.options)

    def partitions(self) -> list[Part]:
        out, kind = [], self.options.get("kind", "table")
        for path in _files(self.options["path"]):
            if kind == "header":
                out += [Part(path, u, 0, len(u.cards)) for u in headers_of(path)]
                continue
            u = self.source._unit(path)
            rows = u.axes[1] if kind == "table" else math.prod(u.axes[1:])
            step = max(1, PART // max(1, u.axes[0] if kind == "table" else u.axes[0] * abs(int(u.get("BITPIX"))) // 8))
            out += [Part(path, u, i, min(step, rows - i)) for i in range(0, rows, step)]
        return out

    def read(self, part: Part):
        if part is None:
            return
        kind = self.options.get("kind", "table")
        types = to_arrow_schema(self.schema_)
        if kind == "header":
            rows = [(part.path, part.unit.number, i, k, None if v is None else str(v), c) for i, (k, v, c) in enumerate(part.unit.cards)]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), types.types)], schema=types)
            return
        with _opened(part.path) as f:
            u = part.unit
            width = u.axes[0] if kind == "table" else u.axes[0] * abs(int(u.get("BITPIX"))) // 8
            f.seek(u.at + part.first * width)
            data = f.read(part.count * width)
            if len(data) < part.count * width:
                raise Damaged(f"{part.path} ends at row {part.first + len(data) // max(width, 1)}")
            arrays = self._pixels(data, part, types) if kind == "image" else self._table(data, part, types, f)
        arrays = [pa.array(np.where(np.isnan(a.to_numpy(zero_copy_only=False)), None, a.to_numpy(zero_copy_only=False)), type=a.type, from_pandas=True) if self.options.get("nan_is_null") == "true" and pa.types.is_floating(a.type) else a for a in arrays]
        yield pa.RecordBatch.from_arrays(arrays, schema=types)

    def _table(self, data: bytes, part: Part, types: pa.Schema, f) -> list[pa.Array]:
        found = {c.name: c for c in columns(part.unit)}
        block = np.frombuffer(data, dtype=np.uint8).reshape(part.count, part.unit.axes[0])

        def heap(kind: str, count: int, offset: int) -> np.ndarray:
            f.seek(part.unit.heap + offset)
            return np.frombuffer(f.read(count * np.dtype(COLUMN_KINDS[kind]).itemsize), dtype=COLUMN_KINDS[kind] if kind != "A" else "S1")

        missing = [t.name for t in types if t.name not in found]
        if missing:
            raise Damaged(f"{part.path} has no columns {missing}")
        return [table_column(block, found[t.name], heap, t.type).cast(t.type) for t in types]

    def _pixels(self, data: bytes, part: Part, types: pa.Schema) -> list[pa.Array]:
        u = part.unit
        values = np.frombuffer(data, dtype=IMAGE_KINDS[int(u.get("BITPIX"))])
        v = scaled(values, "", float(u.get("BSCALE", 1.0)), float(u.get("BZERO", 0.0)), u.get("BLANK"), pa.float64())
        place = np.arange(len(values), dtype=np.int64) + part.first * u.axes[0]
        made = {"v": v}
        for name, n in zip(axis_names(len(u.axes)), u.axes):
            made[name] = pa.array((place % n).astype(np.int32))
            place = place // n
        return [made[t.name].cast(t.type) for t in types]


# -- writing ----------------------------------------------------------------------------------------------------------


def _padded(data: bytes, fill: bytes = b"\0") -> bytes:
    return data + fill * (-len(data) % BLOCK)


def _header(cards: list[bytes]) -> bytes:
    return _padded(b"".join(cards) + b"END".ljust(CARD), b" ")


def datasum(data: bytes) -> int:
    """The ones' complement sum of the data as big-endian 32-bit integers."""
    total = int(np.frombuffer(_padded(data), dtype=">u4").sum(dtype=np.uint64))
    while total >> 32:
        total = (total & 0xFFFFFFFF) + (total >> 32)
    return total


def _stored(column: pa.Array, heap: bytearray) -> tuple[str, np.ndarray, dict[str, object]]:
    """(form, bytes by row, further keywords) of a column; values of varying length go to the heap."""
    kind, n = column.type, len(column)
    if pa.types.is_list(kind):
        places, longest = np.zeros((n, 2), dtype=">i4"), 0
        letter = "D"
        for i, value in enumerate(column):
            values = value.values if value.is_valid else pa.array([], type=kind.value_type)
            letter, raw, more = _stored(values, bytearray())
            if more:
                raise ValueError("arrays with nulls, or of bytes, can't be stored")
            places[i] = len(values), len(heap)
            longest = max(longest, len(values))
            heap += raw.tobytes()
        if not n:
            letter = _stored(pa.array([], type=kind.value_type), bytearray())[0]
        return f"1P{letter}({longest})", places.view(np.uint8).reshape(n, 8), {}
    if pa.types.is_boolean(kind):
        text = [b"\0" if v is None else b"T" if v else b"F" for v in column.to_pylist()]
        return "L", np.frombuffer(b"".join(text), dtype=np.uint8).reshape(n, 1), {}
    if pa.types.is_integer(kind):
        letter, dtype, zero = {8: ("B", ">u1", 128), 16: ("I", ">i2", 0), 32: ("J", ">i4", 0), 64: ("K", ">i8", 0)}[kind.bit_width]
        more: dict[str, object] = {"TZERO": -128.0} if zero else {}
        values = column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) + zero
        if column.null_count:
            info = np.iinfo(np.dtype(dtype))
            free = next((x for x in (info.min, info.max, *range(info.min + 1, info.min + 1000)) if not (values == x).any()), None)
            if free is None:
                raise ValueError("no integer is left for nulls")
            values[column.is_null().to_numpy(zero_copy_only=False)] = free
            more["TNULL"] = int(free)
        return letter, values.astype(dtype).view(np.uint8).reshape(n, np.dtype(dtype).itemsize), more
    if pa.types.is_floating(kind):
        dtype = ">f4" if kind.bit_width == 32 else ">f8"
        values = column.fill_null(math.nan).to_numpy(zero_copy_only=False).astype(dtype)
        return "E" if kind.bit_width == 32 else "D", values.view(np.uint8).reshape(n, values.itemsize), {}
    if pa.types.is_decimal(kind):
        return _stored(column.cast(pa.float64()), heap)
    text = [("" if v is None else v.isoformat() if isinstance(v, (datetime, date)) else str(v)).encode() for v in column.to_pylist()]
    if any(b"\0" in t or t.endswith(b" ") for t in text):
        raise ValueError("texts with blanks at their ends or zero bytes can't be stored")
    width = max(1, max(map(len, text), default=1))
    return f"{width}A", np.frombuffer(b"".join(t.ljust(width) for t in text), dtype=np.uint8).reshape(n, width), {}


def table_bytes(table: pa.Table, name: str) -> bytes:
    """A whole file: an empty first unit and one binary table, with DATASUM."""
    heap, parts, cards = bytearray(), [], []
    for i, c in enumerate(table.column_names, 1):
        form, raw, more = _stored(table.column(c).combine_chunks(), heap)
        parts.append(raw)
        cards += [card(f"TTYPE{i}", c), card(f"TFORM{i}", form), *(card(f"{k}{i}", v) for k, v in more.items())]
    rows = np.concatenate(parts, axis=1).tobytes() if parts else b""
    width = sum(p.shape[1] for p in parts)
    body = rows + bytes(heap)
    first = _header([card("SIMPLE", True), card("BITPIX", 8), card("NAXIS", 0), card("EXTEND", True)])
    own = [card("XTENSION", "BINTABLE"), card("BITPIX", 8), card("NAXIS", 2), card("NAXIS1", width), card("NAXIS2", len(table)), card("PCOUNT", len(heap)), card("GCOUNT", 1), card("TFIELDS", len(table.column_names)), card("EXTNAME", name)]
    return first + _header([*own, *cards, card("DATASUM", str(datasum(body)))]) + _padded(body)


def image_bytes(values: np.ndarray) -> bytes:
    """A whole file with one image of doubles, of which the last axis of the array is the first of the image; NaN where there is no pixel."""
    body = values.astype(">f8").tobytes()
    axes = [card(f"NAXIS{i}", n) for i, n in enumerate(reversed(values.shape), 1)]
    return _header([card("SIMPLE", True), card("BITPIX", -64), card("NAXIS", values.ndim), *axes, card("DATASUM", str(datasum(body)))]) + _padded(body)


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class FitsWriter(DataSourceArrowWriter):
    """Files of about PART bytes of rows each, with a table named by the option extname. Booleans, integers of all sizes (nulls by TNULL), floats (nulls as NaN), texts (nulls as empty ones), times as ISO texts, and arrays of these without nulls. A task without rows writes nothing, but a table without any rows is one file."""

    def __init__(self, options: dict[str, str], schema: T.StructType, overwrite: bool):
        self.path, self.name = re.sub("^file:/*", "/", options["path"]), options.get("extname", "TABLE")
        self.schema_, self.overwrite, self.job = schema, overwrite, uuid.uuid4().hex

    def _system(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.path) if "://" in self.path else (fs.LocalFileSystem(), self.path)

    def _put(self, name: str, data: bytes) -> None:
        system, folder = self._system()
        system.create_dir(f"{folder}/_{self.job}", recursive=True)
        with system.open_output_stream(f"{folder}/_{self.job}/{name}") as f:
            f.write(data)

    def write(self, iterator) -> Written:
        names, held, size, task = [], [], 0, uuid.uuid4().hex

        def closed():
            names.append(f"part-{task}-{len(names):05d}.fits")
            self._put(names[-1], table_bytes(pa.Table.from_batches(held), self.name))

        for batch in iterator:
            step = max(1, PART * batch.num_rows // max(1, batch.nbytes))
            for i in range(0, batch.num_rows, step):
                held.append(batch.slice(i, step))
                size += held[-1].nbytes
                if size >= PART:
                    closed()
                    held, size = [], 0
        if held:
            closed()
        return Written(names)

    def commit(self, messages) -> None:
        from pyarrow import fs

        system, folder = self._system()
        system.create_dir(folder, recursive=True)
        if self.overwrite:
            for x in system.get_file_info(fs.FileSelector(folder)):
                if x.is_file and x.base_name.endswith(".fits"):
                    system.delete_file(x.path)
        names = [n for m in messages if m for n in m.names]
        if not names:
            names = ["part-empty.fits"]
            empty = pa.Table.from_arrays([pa.array([], type=to_arrow_type(f.dataType)) for f in self.schema_], names=self.schema_.names)
            self._put(names[0], table_bytes(empty, self.name))
        for n in names:
            system.move(f"{folder}/_{self.job}/{n}", f"{folder}/{n}")
        system.delete_dir(f"{folder}/_{self.job}")

    def abort(self, messages) -> None:
        from pyarrow import fs

        system, folder = self._system()
        if system.get_file_info(f"{folder}/_{self.job}").type == fs.FileType.Directory:
            system.delete_dir(f"{folder}/_{self.job}")


def register(spark: SparkSession) -> None:
    """Makes the format `fits` known to the session."""
    spark.dataSource.register(FitsSource)


def write_images(df: DataFrame, path: str, by: str, nx: int, ny: int) -> None:
    """Pixels (by, x, y, v) as one file an image, named by its key; a task holds one image, nx times ny doubles. Pixels that aren't there are NaN."""
    os_path = re.sub("^file:/*", "/", path)

    def one(key: tuple, group: pa.Table) -> pa.Table:
        from pyarrow import fs

        values = np.full((ny, nx), math.nan)
        values[group.column("y").to_numpy(), group.column("x").to_numpy()] = group.column("v").to_numpy()
        system, folder = fs.FileSystem.from_uri(os_path) if "://" in os_path else (fs.LocalFileSystem(), os_path)
        system.create_dir(folder, recursive=True)
        name, own = f"{folder}/image-{key[0].as_py()}.fits", f"{folder}/_{uuid.uuid4().hex}"
        with system.open_output_stream(own) as f:
            f.write(image_bytes(values))
        system.move(own, name)  # a task that runs again puts the same file there
        return pa.table({"path": [name]})

    df.where(f"x BETWEEN 0 AND {nx - 1} AND y BETWEEN 0 AND {ny - 1}").groupBy(by).applyInArrow(one, "path string").write.format("noop").mode("overwrite").save()


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """(file, unit, stated, found) for each unit that states a DATASUM: its data are read by a task for each unit, PART bytes at a time."""
    files = _files(path)

    def run(batches):
        for batch in batches:
            for file in batch.column(0).to_pylist():
                out = []
                with _opened(file) as f:
                    for u in units(f, _size(f)):
                        if u.get("DATASUM") is None:
                            continue
                        total, left = 0, -(-u.size // BLOCK) * BLOCK
                        f.seek(u.at)
                        while left:
                            data = f.read(min(left, PART // BLOCK * BLOCK))
                            if not data:
                                raise Damaged(f"{file} ends within unit {u.number}")
                            total += int(np.frombuffer(_padded(data), dtype=">u4").sum(dtype=np.uint64))
                            left -= len(data)
                        while total >> 32:
                            total = (total & 0xFFFFFFFF) + (total >> 32)
                        out.append((file, u.number, int(u.get("DATASUM")), total))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["file", "unit", "stated", "found"])

    spread = spark.createDataFrame([(f,) for f in files], "file string").repartition(max(1, len(files)))
    return spread.mapInArrow(run, "file string, unit long, stated long, found long")
