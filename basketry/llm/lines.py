"""Line dedup: sorted ranges of line hashes, first occurrences streamed, keep bitmaps in place of text.

1. A text is split at line feeds. The key of a line is the line without ASCII white space at both ends, A-Z in
   lower case. A document gives one row for each distinct key: the key's 128-bit hash, what the document is told
   by, and the places of the key's lines in it. Rows of one key are therefore as many as the documents that hold it.
2. The rows are partitioned by range over (hash, document) and sorted by hash, document, place, so a key that a
   third of all documents hold is spread over as many tasks as its rows fill.
3. Each task streams its rows. A run of ``min_docs`` rows or more loses its lines. Only the first and the last run
   of a task can go on in another one: of those it hands on fewer than ``min_docs`` rows each, and these few rows
   of all tasks decide together.
4. The places that go are gathered per document and become a bitmap of the lines that stay, compressed. Text is
   never shuffled for the decision; it meets its bitmap once, when lines are taken out.

``keep_first`` leaves the first occurrence: the first line of the first document in the order of id (null first),
then of text hash. Without it all lines of a key go. A key of fewer than ``min_chars`` code points is never counted
and its lines always stay.

Null and empty texts are one empty line. Rows equal in id and text count as documents of their own and share one
bitmap (with ``keep_first`` they keep the same lines). Rows with equal ids and different texts are different
documents. Other columns are kept as they are, whatever their names. Empty tables give empty results.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import Cut, ship, unused

MIN_DOCS, MIN_CHARS = 10, 1
#: Rows a task gathers before it hands them on.
ROWS_OUT = 16_384

_DOCUMENT = ["doc_id", "t1", "t2"]
LINES = "h1 long, h2 long, doc_id long, t1 long, t2 long, n_lines int, places array<int>"
#: Kinds of rows a task hands on: decided; part of a run that may go on elsewhere; first of such a run, decided.
DECIDED, OPEN, HEAD = 0, 1, 2
WHITE = b" \t\n\x0b\x0c\r"


def told_by(doc_id: Column, text: Column) -> list[Column]:
    """Two hashes that tell a document by its id and its whole text."""
    known = F.concat(doc_id.isNull().cast("int"), text.isNull().cast("int"))
    return [F.xxhash64(F.lit(seed), known, doc_id, text) for seed in (11, 12)]


def _line_rows(min_chars: int):
    """Rows of LINES for batches of (doc_id, t1, t2, text)."""
    schema = pa.schema(
        [("h1", pa.int64()), ("h2", pa.int64()), ("doc_id", pa.int64()), ("t1", pa.int64()), ("t2", pa.int64())]
        + [("n_lines", pa.int32()), ("places", pa.list_(pa.int32()))]
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests: list[bytes] = []
            places: list[list[int]] = []
            owner: list[int] = []
            counts: list[int] = []

            def flush() -> pa.RecordBatch:
                h = np.frombuffer(b"".join(digests), ">i8").reshape(-1, 2).astype(np.int64)
                at = pa.array(owner, pa.int64())
                same = [batch.column(i).take(at) for i in range(3)]
                columns = [pa.array(h[:, 0]), pa.array(h[:, 1]), *same, pa.array(counts, pa.int32()), pa.array(places, schema.field("places").type)]
                for held in (digests, places, owner, counts):
                    held.clear()
                return pa.RecordBatch.from_arrays(columns, schema=schema)

            for i, text in enumerate(batch.column(3)):
                lines = (text.as_py() or "").encode().lower().split(b"\n")
                keys: dict[bytes, list[int]] = {}
                for place, line in enumerate(lines):
                    keys.setdefault(line.strip(WHITE), []).append(place)
                for key, found in keys.items():
                    if len(key) >= min_chars and (min_chars < 2 or len(key.decode()) >= min_chars):
                        digests.append(xxhash.xxh3_128_digest(key))
                        places.append(found)
                        owner.append(i)
                        counts.append(len(lines))
                if len(digests) >= ROWS_OUT:
                    yield flush()
            if digests:
                yield flush()

    return rows


class _Stream:
    """Runs of equal hashes in sorted batches. Holds fewer than ``min_docs`` rows of a run that is not decided,
    and the first row of one that is: what that row is depends on whether the run can lie in other tasks too."""

    def __init__(self, min_docs: int):
        self.min_docs = min_docs
        self.key: tuple[int, int] | None = None
        self.seen, self.first_run = 0, True
        self.held: list[pa.Table] = []
        self.head: pa.Table | None = None

    @staticmethod
    def _out(rows: pa.Table, kind: int, heads: np.ndarray | None = None) -> pa.Table:
        heads = np.zeros(len(rows), bool) if heads is None else heads
        kinds = pa.array(np.full(len(rows), kind), pa.int8())
        return rows.append_column("kind", kinds).append_column("head", pa.array(heads, pa.bool_()))

    def _close(self, edge: bool) -> Iterator[pa.Table]:
        """The run in hand is over in this task; ``edge``: it can go on in another one."""
        if self.head is not None:
            yield self._out(self.head, HEAD) if edge else self._out(self.head, DECIDED, np.ones(1, bool))
        elif edge and self.held:
            yield self._out(pa.concat_tables(self.held), OPEN)
        self.first_run = False

    def _part(self, rows: pa.Table, fresh: bool, ended: bool) -> Iterator[pa.Table]:
        """The next rows of a run: ``fresh`` begins one, ``ended`` says that another follows in this task."""
        if fresh:
            self.held, self.head, self.seen = [], None, 0
        self.seen += len(rows)
        if self.head is None:
            self.held.append(rows)
            if self.seen >= self.min_docs:
                rows = pa.concat_tables(self.held)
                self.head, self.held = rows.slice(0, 1), []
        if self.head is not None:
            # Rows equal to the first share its fate, and it stands for them.
            same = [pc.equal(rows.column(i), self.head.column(i)[0]) for i in (3, 4)]
            yield self._out(rows.filter(pc.invert(pc.and_(*same))), DECIDED)
        if ended:
            yield from self._close(self.first_run)

    def add(self, batch: pa.RecordBatch) -> Iterator[pa.Table]:
        rows = pa.Table.from_batches([batch])
        h1, h2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        cuts = np.flatnonzero((h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])) + 1
        bounds = np.concatenate([[0], cuts, [len(h1)]])
        goes_on = self.key == (int(h1[0]), int(h2[0]))
        if self.key is not None and not goes_on:
            yield from self._part(rows.slice(0, 0), False, True)
        self.key = (int(h1[-1]), int(h2[-1]))
        if len(bounds) == 2:
            yield from self._part(rows, not goes_on, False)
            return
        yield from self._part(rows.slice(0, int(bounds[1])), not goes_on, True)
        lengths = np.diff(bounds)[1:-1]
        long = lengths >= self.min_docs
        if long.any():
            starts = bounds[1:-2][long]
            of = np.repeat(starts, lengths[long])
            at = of + np.arange(len(of)) - np.repeat(np.cumsum(lengths[long]) - lengths[long], lengths[long])
            t1, t2 = batch.column(3).to_numpy(), batch.column(4).to_numpy()
            at = at[(at == of) | (t1[at] != t1[of]) | (t2[at] != t2[of])]
            yield self._out(rows.take(pa.array(at)), DECIDED, np.isin(at, starts))
        yield from self._part(rows.slice(int(bounds[-2])), True, False)

    def end(self) -> Iterator[pa.Table]:
        if self.key is not None:
            yield from self._close(True)


def _streamed(min_docs: int):
    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = _Stream(min_docs)
        for batch in batches:
            if batch.num_rows:
                for table in runs.add(batch):
                    yield from table.combine_chunks().to_batches()
        for table in runs.end():
            yield from table.combine_chunks().to_batches()

    return stream


def dropped_places(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, keep_first: bool = False) -> DataFrame:
    """``t1, t2, n_lines, gone``: the documents that lose lines (as ``told_by`` tells them) and the places."""
    spark = docs.sparkSession
    ship(spark)
    doc_id, text = F.col("doc_id").cast("long"), F.col("text")
    t1, t2 = told_by(doc_id, text)
    rows = docs.select(doc_id.alias("doc_id"), t1.alias("t1"), t2.alias("t2"), text.alias("text"))
    # Stored, since finding the ranges looks at the rows once and dealing them out once more.
    lines = Cut(rows.mapInArrow(_line_rows(min_chars), LINES), "lines")
    order = ["h1", "h2", *_DOCUMENT]
    dealt = lines.df.repartitionByRange(*order).sortWithinPartitions(*order)
    found = Cut(dealt.mapInArrow(_streamed(min_docs), LINES + ", kind byte, head boolean"), "runs")
    lines.drop()

    edges = found.df.filter(F.col("kind") != DECIDED)
    of_key = Window.partitionBy("h1", "h2")
    # Fewer than min_docs rows a task and edge. Rows of one document twice have one rank.
    edges = (
        edges.withColumn("long", (F.max("kind").over(of_key) == HEAD) | (F.count("*").over(of_key) >= min_docs))
        .withColumn("head", F.rank().over(of_key.orderBy(*_DOCUMENT)) == 1)
        .filter("long")
    )
    columns = [*_DOCUMENT, "n_lines", "places", "head"]
    every = found.df.filter(F.col("kind") == DECIDED).select(*columns).unionByName(edges.select(*columns))
    if keep_first:
        every = every.withColumn("places", F.when(F.col("head"), F.slice("places", 2, F.greatest(F.size("places"), F.lit(1)))).otherwise(F.col("places")))
    # Equal rows give equal places: one of them is enough, and they meet before the document's places do.
    every = every.filter(F.size("places") > 0).select("t1", "t2", "n_lines", "places").distinct()
    return every.groupBy("t1", "t2").agg(F.first("n_lines").alias("n_lines"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("places")))).alias("gone"))


def pack(gone: np.ndarray, n_lines: int) -> bytes:
    """Bitmap of the lines that stay, lowest bit first, compressed with zlib."""
    keep = np.ones(n_lines, np.uint8)
    keep[gone] = 0
    return zlib.compress(np.packbits(keep, bitorder="little").tobytes(), 6)


def unpack(bitmap: bytes, n_lines: int) -> np.ndarray:
    """Which lines stay."""
    return np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=n_lines, bitorder="little").view(bool)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        held = [pack(np.array(g.as_py(), np.int64), n) for n, g in zip(batch.column(2).to_pylist(), batch.column(3), strict=True)]
        sizes = batch.column(3).value_lengths()
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), sizes.cast(pa.int64()), pa.array(held, pa.binary())], names=["t1", "t2", "n_dropped", "keep"])


def bitmaps(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, keep_first: bool = False) -> DataFrame:
    """``t1, t2, n_dropped, keep``: a bitmap for each document that loses lines; others keep all."""
    gone = dropped_places(docs, min_docs, min_chars, keep_first)
    return gone.mapInArrow(_packed, "t1 long, t2 long, n_dropped long, keep binary")


def line_bitmaps(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, keep_first: bool = False) -> DataFrame:
    """``doc_id, n_lines, n_dropped, keep`` of every document; ``keep`` is null where all lines stay."""
    t1, t2 = told_by(F.col("doc_id").cast("long"), F.col("text"))
    every = docs.select(F.col("doc_id"), t1.alias("t1"), t2.alias("t2"), count_lines(F.col("text")).alias("n_lines"))
    found = every.join(bitmaps(docs, min_docs, min_chars, keep_first), ["t1", "t2"], "left")
    return found.select("doc_id", "n_lines", F.coalesce("n_dropped", F.lit(0)).alias("n_dropped"), "keep")


def count_lines(text: Column) -> Column:
    """Line feeds and one."""
    text = F.coalesce(text, F.lit(""))
    return (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long")


def without_repeated(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, keep_first: bool = False, n_lines: str = "n_lines", n_dropped: str = "n_dropped") -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text``, and two new columns: lines before and lines dropped."""
    for name in (n_lines, n_dropped):
        if name.lower() in {c.lower() for c in docs.columns}:
            raise ValueError(f"the documents have a column {name}; name another one")
    a, b, gone, keep = unused(docs, "t1", "t2", "gone", "keep")
    t1, t2 = told_by(F.col("doc_id").cast("long"), F.col("text"))
    found = bitmaps(docs, min_docs, min_chars, keep_first).toDF(a, b, gone, keep)
    joined = docs.withColumns({a: t1, b: t2}).join(found, [a, b], "left")

    @F.arrow_udf("string")
    def kept(text: pa.Array, bitmap: pa.Array) -> pa.Array:
        out = []
        for t, k in zip(text, bitmap, strict=True):
            if not k.is_valid:
                out.append(None)
                continue
            lines = (t.as_py() or "").split("\n")
            out.append("\n".join([x for x, stays in zip(lines, unpack(k.as_py(), len(lines)).tolist(), strict=True) if stays]))
        return pa.array(out, pa.string())

    text = F.col("text")
    cut = kept(F.when(F.col(keep).isNotNull(), text), F.col(keep))
    return joined.select(
        *[(F.when(F.col(keep).isNull(), text).otherwise(cut).alias("text") if c == "text" else F.col(f"`{c}`")) for c in docs.columns],
        count_lines(text).alias(n_lines),
        F.coalesce(F.col(gone), F.lit(0)).alias(n_dropped),
    )


def report(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_sha256``: what is left of each document, as a digest."""
    left = without_repeated(docs.select("doc_id", "text"), min_docs, min_chars)
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def report_sql() -> str:
    """The report in SQL of another engine: all lines of keys that ten documents hold go."""
    strip = "regexp_replace(regexp_replace(line, '^[\\x20\\x09-\\x0D]+', ''), '[\\x20\\x09-\\x0D]+$', '')"
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
    WITH docs AS (SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS text FROM documents),
    split AS (SELECT row_no, doc_id, string_split(text, chr(10)) AS lines FROM docs),
    placed AS (SELECT row_no, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM split),
    keyed AS (SELECT row_no, doc_id, line, place, {lower.format(strip)} AS key FROM placed),
    often AS (SELECT key FROM keyed WHERE length(key) >= {MIN_CHARS} GROUP BY key HAVING count(DISTINCT row_no) >= {MIN_DOCS}),
    marked AS (SELECT k.*, o.key IS NOT NULL AS gone FROM keyed k LEFT JOIN often o ON k.key = o.key)
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
    FROM marked GROUP BY row_no, doc_id"""
