"""CSV records with quoted line breaks, read by many tasks from one file.

Spark's text source cuts a file into byte ranges and gives each range the lines that begin in it. Whether such a range
begins inside quotes follows from the number of quotes before it: a first pass counts the quotes of each range, the parities
are summed up along the file, and a second pass joins lines into records, starting at the first true record end. A
record that crosses ranges is put together from the pieces that the first pass has kept.

Parity is right as long as quotes stand where the format wants them: at the start and the end of a field, doubled inside.
The first pass looks at the neighbours of every quote. A file that breaks the rule, or in which a record has a piece of
more than PIECE_BYTES in one range, is read in one task by Spark's own multi-line reader, with the same result.

As in that reader, the first line end of a file decides: in a file with CRLF there, every CRLF counts as a line feed, also
within quotes; elsewhere a carriage return is a character like any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Longest piece of a record that the first pass keeps at an end of a range.
PIECE_BYTES = 1 << 20
#: Ranges whose states are sent to every task; at 128 MB a range this is about 60 TB of text in one read.
BROADCAST_RANGES = 500_000

_QUOTE, _COMMA, _LINE, _RETURN = b'",\n\r'
_RANGE = "file string, start long, quotes long, odd_out boolean, odd_in boolean, head_in string, tail_out string, tail_in string, crlf boolean"


def lines(spark: SparkSession, path: str | list[str], pattern: str | None = None) -> DataFrame:
    """file, start (of its range) and text of every line, carriage returns kept."""
    reader = spark.read.option("lineSep", "\n")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.make_valid_utf8("value").alias("line")
    )


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Slices of batches whose rows share file and start."""
    for batch in batches:
        if not batch.num_rows:
            continue
        file, start = batch.column("file"), batch.column("start")
        new = pc.or_(pc.not_equal(file[1:], file[:-1]), pc.not_equal(start[1:], start[:-1])).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield (file[a].as_py(), start[a].as_py()), batch.slice(a, b - a)


def _quote_counts(text: pa.Array) -> np.ndarray:
    return pc.count_substring(text, '"').to_numpy(zero_copy_only=False).astype(np.int64)


def _misplaced(text: pa.Array, before: np.ndarray) -> tuple[bool, bool]:
    """Whether a quote stands where it should not, if the first line begins outside and if it begins inside quotes.

    ``before``: quotes before each line.
    """
    with_quotes = pc.match_substring(text, '"')
    data = np.frombuffer(("\n" + "\n".join(text.filter(with_quotes).to_pylist()) + "\n").encode("utf-8", "surrogatepass"), np.uint8)
    at = np.flatnonzero(data == _QUOTE)
    if not len(at):
        return False, False
    # the quotes of lines that were left out are none, so numbering the rest is numbering all
    opens = (np.arange(len(at)) + int(before[0])) % 2 == 0
    left, right = data[at - 1], data[at + 1]
    returns = (right == _RETURN) & (data[np.minimum(at + 2, len(data) - 1)] == _LINE)
    may_open = (left == _COMMA) | (left == _LINE) | (left == _QUOTE)
    may_close = (right == _COMMA) | (right == _LINE) | (right == _QUOTE) | returns
    return bool(np.any(np.where(opens, ~may_open, ~may_close))), bool(np.any(np.where(opens, ~may_close, ~may_open)))


class _Piece:
    """Lines strung together, given up beyond PIECE_BYTES."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.size, self.open = 0, True

    def add(self, lines: list[str]) -> None:
        if self.size <= PIECE_BYTES:
            self.lines += lines
            self.size += sum(map(len, lines)) + len(lines)
        if self.size > PIECE_BYTES:
            self.lines = []

    def text(self) -> str | None:
        """None: too long, or no lines at all."""
        return "\n".join(self.lines) if self.lines else None


class _Range:
    """What the first pass learns of a range, whatever its state at the start."""

    def __init__(self, key: tuple) -> None:
        self.key, self.quotes, self.odd = key, 0, [False, False]
        self.head, self.tails = _Piece(), [_Piece(), _Piece()]
        self.crlf: bool | None = None

    def add(self, text: pa.Array) -> None:
        if self.crlf is None:
            self.crlf = text[0].as_py().endswith("\r")
        counts = _quote_counts(text)
        after = self.quotes + np.cumsum(counts)
        odd = _misplaced(text, after - counts)
        self.odd = [self.odd[0] or odd[0], self.odd[1] or odd[1]]
        for state in (0, 1):  # outside, inside
            ends = np.flatnonzero((after + state) % 2 == 0)
            if state and self.head.open:
                stop = int(ends[0]) + 1 if len(ends) else len(text)
                self.head.add(text[:stop].to_pylist() if self.head.size <= PIECE_BYTES else [])
                self.head.open = not len(ends)
            if len(ends):
                self.tails[state] = _Piece()
            rest = text[int(ends[-1]) + 1 :] if len(ends) else text
            if self.tails[state].size <= PIECE_BYTES:
                self.tails[state].add(rest[-(PIECE_BYTES + 1) :].to_pylist())
        self.quotes = int(after[-1])

    def row(self) -> pa.RecordBatch:
        # an open head runs through the whole range: then it is the tail as well
        head = None if self.head.open else self.head.text()
        long_out, long_in = (t.size > PIECE_BYTES for t in self.tails)
        long_head = self.head.size > PIECE_BYTES and not self.head.open
        values = (*self.key, self.quotes, self.odd[0] or long_out, self.odd[1] or long_in or long_head, head, *(t.text() for t in self.tails), self.crlf)
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string(), pa.string(), pa.string(), pa.bool_())
        names = [part.split()[0] for part in _RANGE.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now = None
    for key, batch in _runs(batches):
        if now is None or now.key != key:
            if now:
                yield now.row()
            now = _Range(key)
        now.add(batch.column("line"))
    if now:
        yield now.row()


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole records of each range, with their numbers in it; what its neighbours hold a part of is left out."""
    held, key, outside, number, quotes = [], None, True, 0, 0
    for own, batch in _runs(batches):
        text = batch.column("line")
        if batch.column("skipped")[0].as_py() is None:
            raise ValueError(f"{own[0]} was cut into other ranges when it was read again")
        if batch.column("skipped")[0].as_py():
            continue
        if own != key:
            key, held, number, quotes = own, [], 0, int(batch.column("inside")[0].as_py())
            outside = not quotes
        after = quotes + np.cumsum(_quote_counts(text))
        quotes = int(after[-1])
        ends = np.flatnonzero(after % 2 == 0) + 1
        if not len(ends):
            held += text.to_pylist()
            continue
        first = "\n".join([*held, *text[: int(ends[0])].to_pylist()])
        rest = text[int(ends[0]) : int(ends[-1])]
        held = text[int(ends[-1]) :].to_pylist()
        lists = pa.ListArray.from_arrays(pa.array(ends - ends[0], pa.int32()), rest)
        records = pc.binary_join(lists, "\n").to_pylist()
        if outside:
            records.insert(0, first)
        outside = True
        numbers = np.arange(number, number + len(records))
        number += len(records)
        given = (own[0], own[1], batch.column("crlf")[0].as_py())
        columns = [pa.array([v] * len(records), k) for v, k in zip(given, (pa.string(), pa.int64(), pa.bool_()))]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(numbers, pa.int64()), pa.array(records, pa.string())], _RECORD_NAMES)


_RECORD_NAMES = ["file", "start", "crlf", "number", "record"]
_RECORD = "file string, start long, crlf boolean, number long, record string"


def ranges(text: DataFrame) -> DataFrame:
    """A row for each range of :func:`lines`: whether it begins `inside` quotes, whether parity is `unsure`, and the pieces
    of records that it shares with others: `head` ends one, `tail` begins or goes on with one."""
    along = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    found = text.mapInArrow(_ranges, _RANGE).withColumn("inside", F.coalesce(F.sum("quotes").over(along), F.lit(0)) % 2 == 1)
    return found.select(
        "file",
        "start",
        "inside",
        (F.col("quotes") % 2 == 1).alias("flips"),
        F.when(F.col("inside"), F.col("odd_in")).otherwise(F.col("odd_out")).alias("unsure"),
        F.when(F.col("inside"), F.col("head_in")).alias("head"),
        F.when(F.col("inside"), F.col("tail_in")).otherwise(F.col("tail_out")).alias("tail"),
        F.first("crlf").over(Window.partitionBy("file").orderBy("start")).alias("crlf"),
    )


def _crossing(found: DataFrame) -> DataFrame:
    """Records that cross ranges, under the start of the range they begin in (number -1), and quotes that never close."""
    pieces = found.select(
        "file",
        "start",
        "crlf",
        F.explode(
            F.filter(
                F.array(
                    F.struct(F.lit(0).alias("kind"), F.col("head").alias("piece")),
                    F.struct(F.when(F.col("inside") & F.col("head").isNull(), 1).otherwise(2).alias("kind"), F.col("tail").alias("piece")),
                ),
                lambda p: p["piece"].isNotNull(),
            )
        ).alias("p"),
    ).select("file", "start", "crlf", "p.*")
    # kinds: 0 ends a record, 1 is the middle of one, 2 begins one
    along = Window.partitionBy("file").orderBy("start", "kind")
    record = F.sum(F.when(F.col("kind") == 2, 1).otherwise(0)).over(along)
    parts = F.sort_array(F.collect_list(F.struct("start", "kind", "piece")))
    whole = pieces.withColumn("record", record).groupBy("file", "crlf", "record").agg(parts.alias("parts"))
    start, text = F.col("parts")[0]["start"], F.array_join("parts.piece", "\n")
    return whole.select("file", start.alias("start"), "crlf", F.lit(-1).cast("long").alias("number"), text.alias("record"))


def records(spark: SparkSession, path: str | list[str], store, pattern: str | None = None) -> tuple[DataFrame, list[str]]:
    """(file, start, number, record of every record but each file's header, files that must be read in one task).

    ``store`` writes the small table of ranges and reads it back, so that the passes agree on it.
    """
    text = lines(spark, path, pattern)
    found = store(ranges(text))
    size = found.agg(F.count(F.lit(1)).alias("n")).head().n
    serial = sorted(r.file for r in found.where("unsure").select("file").distinct().collect())  # file names
    skipped = F.col("file").isin(serial) if serial else F.lit(False)
    states = found.select("file", "start", "inside", "crlf", skipped.alias("skipped"))
    if size > BROADCAST_RANGES:
        raise ValueError(f"{size} ranges in one read; raise spark.sql.files.maxPartitionBytes or read fewer files at a time")
    # a left join: no condition on files may reach the scan, for fewer files would be cut into other ranges
    whole = text.join(F.broadcast(states), ["file", "start"], "left").mapInArrow(_records, _RECORD)
    everything = whole.where("start > 0 or number > 0").union(_crossing(found.where(~skipped)))
    one_character = F.regexp_replace(F.replace("record", F.lit("\r\n"), F.lit("\n")), "\r\\z", "")
    ended = everything.withColumn("record", F.when(F.col("crlf"), one_character).otherwise(F.col("record")))
    return ended.where("record <> ''").drop("crlf"), serial


def parsed(rows: DataFrame, schema: T.StructType, mode: str = "FAILFAST", corrupt: str | None = None) -> DataFrame:
    """Records read by Spark's CSV parser into `parsed`; with ``corrupt`` a bad one is kept, its text in that field."""
    options = {"mode": mode, "escape": '"', "multiLine": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema]
    if corrupt:
        fields.append(f"`{corrupt}` string")
        options["columnNameOfCorruptRecord"] = corrupt
    return rows.withColumn("parsed", F.from_csv("record", ", ".join(fields), options))
