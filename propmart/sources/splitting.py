"""Records of JSON arrays and quoted CSV in files of any size, cut in parallel.

Spark splits a text file by bytes, so a task begins somewhere inside a record.
Two scans find the records without moving the text.  The first sums every
split up as a function of the state it may begin in (inside a quoted string or
not; for JSON also the nesting depth it adds); a prefix composition of these
functions over the splits of a file, which is a row per split, gives each its
true state.  The second scan cuts records with that state.  Only what crosses
the border of two splits is shuffled and joined.

Neither Spark's readers nor its functions carry a state along a file, so the
scans go through Arrow batches, in numpy over whole batches.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from propmart.session import ship_package

WHOLE, HEAD, MIDDLE, TAIL = range(4)  # of a record: all of it, its end, neither, its start

FRAGMENTS = ("value", "source_file", "__file", "__start", "__size", "__n")

_BLANK = b" \t\r\n"


# ---------------------------------------------------------------------------
# JSON
# ---------------------------------------------------------------------------

_STEP = np.zeros(256, np.int8)
_STEP[[0x5B, 0x7B]] = 1
_STEP[[0x5D, 0x7D]] = -1
_MARK = _STEP != 0
_MARK[0x2C] = True


def json_marks(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Places of brackets, braces and commas, the quotes before each, and all quotes.

    A quote after an odd run of backslashes does not count.
    """
    quotes = np.flatnonzero(data == 0x22)
    slashes = np.flatnonzero(data == 0x5C)
    if len(slashes):
        new = np.concatenate([[True], np.diff(slashes) > 1])
        first = slashes[new]
        size = np.diff(np.concatenate([np.flatnonzero(new), [len(slashes)]]))
        quotes = np.setdiff1d(quotes, (first + size)[size % 2 == 1], assume_unique=True)
    marks = np.flatnonzero(_MARK[data])
    return marks, np.searchsorted(quotes, marks), len(quotes)


class JsonArray:
    """Elements of a top-level array; a file that is no array is one element."""

    separator = b"}"
    glue = ""

    def __init__(self, inside: bool = False, depth: int = 0, array: bool | None = None, before: int = 0):
        self.inside, self.depth, self.array = inside, depth, array
        self.at, self.held, self.cuts = before, [], 0

    @staticmethod
    def bytes_of(values: pa.Array) -> bytes:
        rows = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        return pc.binary_join(rows, b"}")[0].as_py() + b"}"

    def feed(self, values: pa.Array) -> tuple[list[bytes], bytes | None]:
        """Elements that end here, without the first one's start in another split (that one comes second)."""
        raw = self.bytes_of(values)
        self.at += len(raw)
        if self.array is None:  # the start of a file
            text = raw.lstrip(b"\xef\xbb\xbf" + _BLANK)
            if text:
                self.array = text[:1] == b"["
        data = np.frombuffer(raw, np.uint8)
        marks, quoted, n = json_marks(data)
        out = (quoted + self.inside) % 2 == 0
        marks = marks[out]
        char = data[marks]
        depth = self.depth + np.cumsum(_STEP[char], dtype=np.int64)
        self.inside = bool((n + self.inside) % 2)
        self.depth = int(depth[-1]) if len(depth) else self.depth
        if not self.array:
            self.held.append(raw)
            return [], None
        cuts = marks[((char == 0x2C) & (depth == 1)) | ((char == 0x5B) & (depth == 1)) | ((char == 0x5D) & (depth == 0))]
        if not len(cuts):
            self.held.append(raw)
            return [], None
        cuts = cuts.tolist()
        first = b"".join([*self.held, raw[: cuts[0]]])
        self.held = [raw[cuts[-1] + 1 :]]
        whole = [raw[a + 1 : b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        self.cuts += 1
        return whole, first

    def end(self, size: int) -> bytes:
        """What is left at the end of a split; a separator that the file does not end with is taken off."""
        left = b"".join(self.held)
        return left[:-1] if self.at - size in (1, -2) else left  # -2: Spark leaves out a byte-order mark


class JsonSummary:
    """What a split does to the state of a JSON file, for either state it may begin in."""

    def __init__(self):
        self.odd, self.depth, self.bytes, self.first = False, [0, 0], 0, None

    def feed(self, values: pa.Array) -> None:
        raw = JsonArray.bytes_of(values)
        self.bytes += len(raw)
        if self.first is None and (text := raw.lstrip(b"\xef\xbb\xbf" + _BLANK)):
            self.first = text[:1] == b"["
        data = np.frombuffer(raw, np.uint8)
        marks, quoted, n = json_marks(data)
        step = _STEP[data[marks]].astype(np.int64)
        even = (quoted + self.odd) % 2 == 0
        self.depth = [self.depth[0] + int(step[even].sum()), self.depth[1] + int(step[~even].sum())]
        self.odd ^= bool(n % 2)

    def row(self) -> tuple:
        return self.odd, not self.odd, *self.depth, self.bytes, bool(self.first)


# ---------------------------------------------------------------------------
# CSV
# ---------------------------------------------------------------------------

_FIELD = rb'(?:[ \t]*"(?:[^"]|"")*+"[^,]*+|(?![ \t]*")[^,]*+)'
_CLOSED = re.compile(rb"(?:\xef\xbb\xbf)?" + _FIELD + rb"(?:," + _FIELD + rb")*+", re.DOTALL)
_CLOSES = re.compile(rb'(?:[^"]|"")*+"[^,]*+(?:,' + _FIELD + rb")*+", re.DOTALL)


def leaves_open(line: bytes, is_open: bool) -> bool:
    """Whether a quoted cell is open after a line."""
    return (_CLOSES if is_open else _CLOSED).fullmatch(line) is None


class CsvLines:
    """Logical lines: a line break inside a quoted cell belongs to the cell."""

    separator = None  # any line break
    glue = "\n"

    def __init__(self, inside: bool = False, depth: int = 0, array: bool | None = None, before: int = 0):
        self.inside, self.held, self.from_before, self.at, self.row = inside, [], inside, 0, 0

    def feed(self, values: pa.Array) -> tuple[list[tuple[int, bytes]], bytes | None]:
        """(row, logical line) of the lines that end here; the first one's end, if it began in another split."""
        out, first, done, self.row = [], None, 0, 0
        quoted = np.flatnonzero(np.asarray(pc.match_substring(values, b'"')))
        if not self.inside and not len(quoted):
            return list(enumerate(values.to_pylist())), None
        rows = values.to_pylist()
        for at in quoted.tolist():
            if self.inside:
                self.held += rows[done:at]
            else:
                out += enumerate(rows[done:at], done)
                self.row = at
            self.held.append(rows[at])
            done = at + 1
            self.inside = leaves_open(rows[at], self.inside)
            if not self.inside:
                line, self.held = b"\n".join(self.held), []
                if self.from_before:
                    first, self.from_before = line, False
                else:
                    out.append((self.row, line))
        if self.inside:
            self.held += rows[done:]
        else:
            out += enumerate(rows[done:], done)
        return out, first

    def end(self, size: int) -> bytes | None:
        return b"\n".join(self.held) if self.held else None


class CsvSummary:
    """What a split does to the state of a CSV file, for either state it may begin in."""

    def __init__(self):
        self.state = [False, True]

    def feed(self, values: pa.Array) -> None:
        for line in values.filter(pc.match_substring(values, b'"')).to_pylist():
            self.state = [leaves_open(line, s) for s in self.state]

    def row(self) -> tuple:
        return *self.state, 0, 0, 0, False


# ---------------------------------------------------------------------------
# Both
# ---------------------------------------------------------------------------


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, bool]]:
    """Runs of rows of one split, in their order, and whether a run begins a split."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        file, start = batch.column("__file"), np.asarray(batch.column("__start"), np.int64)
        new = np.ones(batch.num_rows, bool)
        new[1:] = np.asarray(pc.not_equal(file[1:], file[:-1])) | (start[1:] != start[:-1])
        cuts = [*np.flatnonzero(new).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            key = (file[a].as_py(), int(start[a]))
            yield batch.slice(a, b - a), key != last
            last = key


SUMMARY = "__file string, __start long, from_closed boolean, from_open boolean, depth_closed long, depth_open long, bytes long, array boolean"


def _summaries(fragments: DataFrame, make: Callable) -> DataFrame:
    names = [f.split()[0] for f in SUMMARY.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = None, None
        for rows, new in _splits(batches):
            if new:
                if held is not None:
                    yield pa.RecordBatch.from_pydict(dict(zip(names, ([x] for x in (*key, *held.row())), strict=True)))
                held, key = make(), (rows.column("__file")[0].as_py(), rows.column("__start")[0].as_py())
            held.feed(rows.column("value"))
        if held is not None:
            yield pa.RecordBatch.from_pydict(dict(zip(names, ([x] for x in (*key, *held.row())), strict=True)))

    return fragments.select("value", "__file", "__start").mapInArrow(run, SUMMARY)


def entry_states(summaries: DataFrame) -> DataFrame:
    """The state in which every split but the first of a file begins.

    What a split does to the quoted state keeps it, turns it round, or sets it
    whatever it was; the state is that of the last split that set it, turned
    round as often as splits did so since.
    """
    before = Window.partitionBy("__file").orderBy("__start").rowsBetween(Window.unboundedPreceding, -1)
    turns = F.col("from_closed") & ~F.col("from_open")
    sets = F.col("from_closed") == F.col("from_open")
    rows = summaries.withColumn("turned", F.coalesce(F.sum(turns.cast("int")).over(before), F.lit(0)) % 2)
    # as if every turn were made on a file that begins closed: a set state, less the turns before it
    rows = rows.withColumn("kept", F.when(sets, F.col("from_closed").cast("int").bitwiseXOR(F.col("turned").cast("int"))))
    state = F.coalesce(F.last("kept", ignorenulls=True).over(before), F.lit(0)).bitwiseXOR(F.col("turned").cast("int")) == 1
    rows = rows.withColumn("inside", state)
    depth = F.coalesce(F.sum(F.when(F.col("inside"), F.col("depth_open")).otherwise(F.col("depth_closed"))).over(before), F.lit(0))
    rows = rows.select(
        F.col("__file").alias("s_file"), F.col("__start").alias("s_start"), F.col("inside").alias("s_inside"), depth.alias("s_depth"),
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("s_before"), F.coalesce(F.first("array").over(before), F.lit(False)).alias("s_array"),
    )
    return rows.where("s_start > 0")


CUT = "source_file string, __file string, __start long, __n long, kind int, value binary"


def _cut(fragments: DataFrame, states: DataFrame, make: Callable, whole_ones: bool | None) -> DataFrame:
    """The whole records, or the parts of those that cross a border (None: both)."""
    schema = pa.schema([("source_file", pa.string()), ("__file", pa.string()), ("__start", pa.int64()), ("__n", pa.int64()), ("kind", pa.int32()), ("value", pa.binary())])

    def rows_of(key: tuple, numbers: list, kind: int, values: list[bytes]) -> pa.RecordBatch:
        n = len(values)
        columns = [pa.array([key[0]] * n), pa.array([key[1]] * n), pa.array([key[2]] * n, pa.int64()), pa.array(numbers, pa.int64()), pa.array([kind] * n, pa.int32()), pa.array(values, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key, size, number, headless = None, None, 0, 0, False

        def finish() -> Iterator[pa.RecordBatch]:
            left = held.end(size)
            # a later split of the file needs a start to go with, were it blank
            if whole_ones is not True and left is not None and (left.strip() or held.at < size):
                yield rows_of(key, [number], MIDDLE if headless else TAIL, [left])

        for rows, new in _splits(batches):
            if new:
                if held is not None:
                    yield from finish()
                key = tuple(rows.column(c)[0].as_py() for c in ("source_file", "__file", "__start"))
                size, inside = rows.column("__size")[0].as_py(), rows.column("s_inside")[0].as_py()
                if inside is None:  # the start of a file
                    held = make()
                else:
                    held = make(inside, *(rows.column(c)[0].as_py() for c in ("s_depth", "s_array", "s_before")))
                headless = inside is not None and (make is JsonArray or inside)
            numbers = np.asarray(rows.column("__n"), np.int64)
            whole, first = held.feed(rows.column("value"))
            if first is not None:
                kind, headless = HEAD if headless else WHOLE, False
                if (first.strip() or kind == HEAD) and whole_ones in (None, kind == WHOLE):
                    yield rows_of(key, [int(numbers[0])], kind, [first])
            if whole_ones is False:
                whole = []
            if whole and isinstance(whole[0], tuple):
                yield rows_of(key, numbers[[i for i, _ in whole]].tolist(), WHOLE, [line for _, line in whole])
            elif whole:
                whole = [x for x in whole if x.strip()]
                yield rows_of(key, [int(numbers[0])] * len(whole), WHOLE, whole)
            number = int(numbers[-1])
        if held is not None:
            yield from finish()

    known = fragments.join(F.broadcast(states), (F.col("__file") == F.col("s_file")) & (F.col("__start") == F.col("s_start")), "left")
    return known.select(*FRAGMENTS, "s_inside", "s_depth", "s_array", "s_before").mapInArrow(run, CUT)


def cut_records(fragments: DataFrame, make: Callable, summary: Callable, staged: str | None = None) -> DataFrame:
    """Records (source_file, __file, __start, __n, value) of fragments in file order.

    The second scan runs once for the whole records and once for the parts of
    the others, unless a folder ``staged`` keeps what it finds; it then runs
    at once, and the result reads that folder.

    The states that are broadcast are a row per split of a file that has
    several, which the driver lists anyway to plan the scan.
    """
    ship_package(fragments.sparkSession)
    states = entry_states(_summaries(fragments, summary))
    if staged:
        _cut(fragments, states, make, None).write.mode("overwrite").parquet(staged)
        pieces = fragments.sparkSession.read.schema(CUT).parquet(staged)
        whole, parts = pieces.where(F.col("kind") == WHOLE).drop("kind"), pieces.where(F.col("kind") != WHOLE)
    else:
        whole, parts = _cut(fragments, states, make, True).drop("kind"), _cut(fragments, states, make, False)
    so_far = Window.partitionBy("__file").orderBy("__start", "kind").rowsBetween(Window.unboundedPreceding, 0)
    parts = parts.withColumn("record", F.coalesce(F.sum((F.col("kind") == TAIL).cast("int")).over(so_far), F.lit(0)))
    texts = F.array_sort(F.collect_list(F.struct("__start", "kind", F.col("value").cast("string").alias("value"))))
    joined = parts.groupBy("source_file", "__file", "record").agg(
        F.min_by("__start", F.struct("__start", "kind")).alias("__start"), F.min_by("__n", F.struct("__start", "kind")).alias("__n"),
        F.array_join(F.transform(texts, lambda t: t["value"]), make.glue).alias("value"),
    )
    return whole.select("source_file", "__file", "__start", "__n", F.col("value").cast("string").alias("value")).unionByName(joined.drop("record"))


def fragments(reader, path: str, glob: str | None, separator: str | None = None, encoding: str | None = None) -> DataFrame:
    """Text files cut at ``separator`` (default: line breaks), with the place of each piece.

    ``reader`` is ``spark.read`` or ``spark.readStream``; a stream has no
    ``__n``, which is given per batch.
    """
    if separator:
        reader = reader.option("lineSep", separator)
    if encoding:
        reader = reader.option("encoding", encoding)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.text(path).select(
        F.col("value").cast("binary").alias("value"), F.col("_metadata.file_name").alias("source_file"), F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__start"), F.col("_metadata.file_size").alias("__size"),
    )


def numbered(pieces: DataFrame) -> DataFrame:
    return pieces.withColumn("__n", F.monotonically_increasing_id())


def json_elements(pieces: DataFrame, staged: str | None = None) -> DataFrame:
    """(source_file, value): the elements of JSON array files cut at ``}``.

    A file that is no array is one element, and so is the text after the end
    of a file's array.  Blank elements give no row.
    """
    found = cut_records(numbered(pieces), JsonArray, JsonSummary, staged)
    return found.where(F.trim(F.col("value"), F.lit(" \t\r\n")) != "").select("value", "source_file")


def csv_records(lines: DataFrame) -> DataFrame:
    """The logical lines of numbered CSV lines: a quoted line break stays in its line, as a line feed."""
    return cut_records(lines, CsvLines, CsvSummary)
