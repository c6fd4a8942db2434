"""Records of delimited text whose quoted fields may hold line breaks, cut in parallel.

Files are read in splits, line by line. Whether a line begins a record depends on all quotes before it in its file,
which a task that reads a split from its middle does not know. So

1. each split is cut under the guess that it begins outside of quotes, and says where it would end under either
   truth: a function of two states. Once both truths agree, at a line end outside of quotes, what follows is right
   under either; what came before is marked *early*;
2. the functions of the splits of a file, one row each, are composed in file order and give the true beginning of
   every split;
3. splits that the guess was wrong for have their early lines cut again, from the stored rows. A record that goes on
   over splits is put together from the open end of one and the beginnings of the next.

The bytes of the files are read once; what the tasks cut is stored as it comes, with the encodings that each record
would be valid under, and everything else reads the stored rows.

A quote counts at the beginning of a field only, as in the usual dialect: doubled inside, and what follows a closing
quote up to the separator belongs to the field. A quote that is never closed makes one record of the rest of its file.
Line ends may be LF, CR LF or CR; inside a record they become LF.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.session import materialise, ship
from basketry.specs import FIELD_SEPARATOR

#: Kinds of stored rows: a whole record, one that is open at the end of its split, what is said of the split.
RECORD, OPEN, SPLIT, HEAD = 0, 1, 2, 3
STORED = "file string, block long, place long, kind byte, early boolean, raw binary, from_outside boolean, from_inside boolean"
_SCHEMA = pa.schema(
    [("file", pa.string()), ("block", pa.int64()), ("place", pa.int64()), ("kind", pa.int8()), ("early", pa.bool_())]
    + [("raw", pa.binary()), ("from_outside", pa.bool_()), ("from_inside", pa.bool_())]
)

_AT = re.escape(FIELD_SEPARATOR).encode()
#: A whole quoted field, the beginning of one that stays open, and the rest of a quoted field up to its closing quote.
_WHOLE = re.compile(b'(^|' + _AT + b')"[^"]*+(?:""[^"]*+)*+"')
_OPENS = re.compile(b'(?:^|' + _AT + b')"').search
_CLOSES = re.compile(b'[^"]*+(?:""[^"]*+)*+"').match


def ends_inside(line: bytes, inside: bool) -> bool:
    """Whether quotes are open behind a line, given whether they are before it."""
    if inside:
        closed = _CLOSES(line)
        if closed is None:
            return True
        # What follows the closing quote is the rest of a field, not the beginning of one.
        line = b"x" + line[closed.end() :]
    return _OPENS(_WHOLE.sub(rb"\1", line)) is not None


class SplitCutter:
    """Cuts the lines of one split, in order, under the guess ``inside``."""

    def __init__(self, file: str, block: int, inside: bool = False):
        self.file, self.block = file, block
        self.start = self.guess = inside
        self.other = not inside
        self.sure = False
        self.line, self.begun, self.open = 0, 0, []
        self.kinds = [HEAD if inside else RECORD]

    def _row(self, place: int, kind: int, raw: bytes | None, states: tuple = (None, None)) -> dict:
        return dict(zip(_SCHEMA.names, (self.file, self.block, place, kind, not self.sure, raw, *states), strict=True))

    def _plain(self, lines: pa.Array) -> Iterator[pa.RecordBatch]:
        """Lines without any quote."""
        if not len(lines):
            return
        if self.guess:
            if not self.open:
                self.begun = self.line
            self.open += lines.to_pylist()
        else:
            n = len(lines)
            places = pa.array(range(self.line, self.line + n), pa.int64())
            same = [pa.repeat(pa.scalar(v, t), n) for v, t in ((self.file, pa.string()), (self.block, pa.int64()))]
            rest = [pa.repeat(pa.scalar(RECORD, pa.int8()), n), pa.repeat(pa.scalar(not self.sure), n), lines]
            none = [pa.nulls(n, pa.bool_())] * 2
            yield pa.RecordBatch.from_arrays([*same, places, *rest, *none], schema=_SCHEMA)
        self.line += len(lines)

    def add(self, lines: pa.Array) -> Iterator[pa.RecordBatch]:
        quoted = pc.indices_nonzero(pc.match_substring(lines, '"')).to_pylist()
        rows, at = [], 0
        for i in quoted:
            # Rows go out in the order of their lines, whole batches of plain ones among them.
            if i > at:
                if rows and not self.guess:
                    yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)
                    rows = []
                yield from self._plain(lines.slice(at, i - at))
            line = lines[i].as_py()
            if not self.open:
                self.begun = self.line
            self.open.append(line)
            self.line, at = self.line + 1, i + 1
            self.guess = ends_inside(line, self.guess)
            if not self.sure:
                self.other = ends_inside(line, self.other)
            if not self.guess:
                rows.append(self._close())
                self.sure = self.sure or not self.other
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)
        yield from self._plain(lines.slice(at))

    def _close(self) -> dict:
        row = self._row(self.begun, self.kinds[-1], b"\n".join(self.open))
        self.open, self.kinds = [], [RECORD]
        return row

    def end(self, say: bool = True) -> Iterator[pa.RecordBatch]:
        rows = []
        if self.open:
            kind = HEAD if self.kinds[-1] == HEAD else OPEN
            rows.append(self._row(self.begun, kind, b"\n".join(self.open)))
        if say:
            rows.append(self._row(-1, SPLIT, None, (self.guess, self.guess if self.sure else self.other)))
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, int, int]]:
    """Neighbouring rows of one split: file, block, first row, number of rows."""
    files, blocks = batch.column(0), batch.column(1)
    n, at = batch.num_rows, 0
    while at < n:
        file, block = files[at].as_py(), blocks[at].as_py()
        stop = n
        if not (files[n - 1].as_py() == file and blocks[n - 1].as_py() == block):
            same = pc.and_(pc.equal(files.slice(at), file), pc.equal(blocks.slice(at), block))
            stop = at + pc.index(same, False).as_py()
        yield file, block, at, stop - at
        at = stop


def _cut_splits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cutter = None
    for batch in batches:
        for file, block, at, n in _runs(batch):
            if cutter is None or (cutter.file, cutter.block) != (file, block):
                if cutter is not None:
                    yield from cutter.end()
                cutter = SplitCutter(file, block)
            yield from cutter.add(batch.column(2).slice(at, n))
    if cutter is not None:
        yield from cutter.end()


def _cut_again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Early rows of splits that begin inside of quotes, in their order: the same lines under the other guess."""
    cutter = None
    for batch in batches:
        for file, block, at, n in _runs(batch):
            if cutter is None or (cutter.file, cutter.block) != (file, block):
                if cutter is not None:
                    yield from cutter.end(say=False)
                cutter = SplitCutter(file, block, inside=True)
            lines = [x for raw in batch.column(3).slice(at, n).to_pylist() for x in raw.split(b"\n")]
            yield from cutter.add(pa.array(lines, pa.binary()))
    if cutter is not None:
        yield from cutter.end(say=False)


def split_starts(stored: DataFrame) -> DataFrame:
    """``file, block, inside``: whether each split begins inside of quotes. A split keeps the state, turns it, or
    sets it; the state at a beginning is what was set last, turned as often as splits have turned it since."""
    said = stored.filter(F.col("kind") == SPLIT).select("file", "block", "from_outside", "from_inside")
    in_order = Window.partitionBy("file").orderBy("block")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    turns = (F.col("from_outside") & ~F.col("from_inside")).cast("int")
    counted = said.withColumn("turned", F.sum(turns).over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    sets = F.when(F.col("from_outside") == F.col("from_inside"), F.struct(F.col("from_outside").alias("to"), "turned"))
    last = counted.withColumns(
        {"so_far": F.coalesce(F.lag("turned").over(in_order), F.lit(0)), "set": F.last(sets, True).over(before)}
    )
    since = F.col("so_far") - F.coalesce("set.turned", F.lit(0))
    return last.select("file", "block", (F.coalesce("set.to", F.lit(False)).cast("int") != since % 2).alias("inside"))


def store_records(spark: SparkSession, path: str) -> DataFrame:
    """Read the files at ``path`` once and store what their splits were cut into."""
    ship(spark)
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("value"),
    )
    cut = lines.mapInArrow(_cut_splits, STORED)
    return materialise(cut.select("*", *[e.alias(n) for n, e in validity(F.col("raw")).items()]), "records")


def records(stored: DataFrame) -> DataFrame:
    """``file, block, place, raw``: every record of the stored files."""
    columns = ["file", "block", "place", "raw"]
    starts = materialise(split_starts(stored).filter("inside").select("file", "block", F.lit(True).alias("wrong")), "splits")
    rows = stored.filter(F.col("kind") <= OPEN)
    if starts.isEmpty():
        # Only the last record of a file can be open then.
        return rows.select(*columns)
    marked = rows.join(starts, ["file", "block"], "left")
    right = marked.filter(F.col("wrong").isNull() | ~F.col("early")).select(*columns, "kind")
    early = marked.filter(F.col("wrong") & F.col("early")).select(*columns)
    grouped = early.repartition("file", "block").sortWithinPartitions("file", "block", "place")
    again = materialise(grouped.mapInArrow(_cut_again, STORED).select(*columns, "kind"), "again")
    # Ends and beginnings of splits: at most two rows a split.
    pieces = right.filter(F.col("kind") == OPEN).unionByName(again.filter(F.col("kind") != RECORD))
    order = Window.partitionBy("file").orderBy("block", "place")
    opened = F.sum((F.col("kind") == OPEN).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    parts = F.array_sort(F.collect_list(F.struct("block", "place", "raw")))
    whole = (
        pieces.withColumn("record", opened)
        .groupBy("file", "record")
        .agg(parts.alias("parts"))
        .select(
            "file",
            F.col("parts")[0].block.alias("block"),
            F.col("parts")[0].place.alias("place"),
            F.aggregate(
                F.slice("parts", 2, F.greatest(F.size("parts"), F.lit(1))),
                F.col("parts")[0].raw,
                lambda held, part: F.concat(held, F.lit(b"\n"), part.raw),
            ).alias("raw"),
        )
    )
    single = right.filter(F.col("kind") == RECORD).unionByName(again.filter(F.col("kind") == RECORD))
    return single.select(*columns).unionByName(whole)


def validity(raw) -> dict:
    """Under which encodings bytes are valid, by column name."""
    latin = F.decode(raw, "ISO-8859-1")
    return {"utf8": F.is_valid_utf8(raw.cast("string")), "cp1252": ~latin.rlike(CP1252_UNDEFINED)}


# Fixed value: the bytes that Windows-1252 leaves undefined, as Latin-1.
CP1252_UNDEFINED = "[\x81\x8d\x8f\x90\x9d]"
