"""CSV records with quoted line breaks, read in parallel.

A reader for multi-line CSV takes a whole file as one task, since a line break may
stand inside quotes.  Here files are scanned as lines, split as any text.  Whether
a line begins a record depends on one bit: whether an odd number of quote signs
stands before it in its file (doubled quotes inside a field count twice).

1. One pass counts the quote signs of each split and the records that begin in it,
   for either parity at its start; one row per split comes back.
2. Running sums over the splits give each its parity and the number of its first
   record.
3. The second pass joins lines to records.  Only a record that crosses a split is
   put together by a shuffle, from one piece per split.

The engine's own ``from_csv`` parses the records.  Quote signs must be balanced, as
the format asks: one inside an unquoted field would shift the parity.  Lines end
with LF or CRLF.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_TALLY = "file string, block long, odd boolean, starts_even long, starts_odd long"
_PIECES = "file_no int, record_no long, block long, whole boolean, text string"


@dataclass(frozen=True)
class _Start:
    """What the second pass knows of a split."""

    file_no: int
    odd: bool  # an odd number of quote signs before it
    record: int  # number of the first record that begins in it, 0 for the header


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], str]]:
    for batch in batches:
        yield from zip(
            zip(batch.column("file").to_pylist(), batch.column("block").to_pylist(), strict=True), batch.column("value").to_pylist(), strict=True
        )


def _begins(line: str) -> bool:
    """Whether a line outside quotes is a record: blank ones are not."""
    return line not in ("", "\r")


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[tuple[str, int], list] = {}
    for key, line in _lines(batches):
        own = found.setdefault(key, [False, 0, 0])
        own[2 if own[0] else 1] += _begins(line)
        own[0] ^= line.count('"') % 2 == 1
    rows = [(file, block, odd, even, other) for (file, block), (odd, even, other) in found.items()]
    columns = list(zip(*rows, strict=True)) or [()] * 5
    types = [pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.int64()]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[c.split()[0] for c in _TALLY.split(", ")])


def _pieces(starts: dict[tuple[str, int], _Start]):
    """Lines to records, and to pieces of those that cross a split."""
    types = [pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]
    names = [c.split()[0] for c in _PIECES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        at, odd, record, held, crossing = None, False, 0, [], False

        def leave() -> None:
            """The end of a split: what is open goes on in the next one."""
            if held:
                out.append((starts[at].file_no, record, at[1], False, "\n".join(held)))

        for key, line in _lines(batches):
            if key != at:
                if at is not None:
                    leave()
                at, start = key, starts[key]
                odd, record, held, crossing = start.odd, start.record - 1, [], start.odd
            if not odd:
                if not _begins(line):
                    continue
                record, held, crossing = record + 1, [], False
            held.append(line)
            odd ^= line.count('"') % 2 == 1
            if not odd:
                out.append((starts[at].file_no, record, at[1], not crossing, "\n".join(held)))
                held = []
            if len(out) >= 4096:
                yield _batch(out)
                out.clear()
        if at is not None:
            leave()
        yield _batch(out)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return run


def read_records(spark: SparkSession, path: str, header: list[str]) -> DataFrame:
    """The rows under ``header`` (all strings) of every CSV file at ``path``, with ``src_row``.

    ``src_row`` numbers the records from one over all files in name order, their
    headers left out.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )
    splits = sorted(lines.mapInArrow(_tally, _TALLY).collect(), key=lambda r: (r.file, r.block))
    starts: dict[tuple[str, int], _Start] = {}
    before: list[int] = []  # rows of the files before each file
    total, last = 0, None
    for r in splits:
        if r.file != last:
            total += max(0, record - 1) if last is not None else 0
            before.append(total)
            last, odd, record = r.file, False, 0
        starts[r.file, r.block] = _Start(len(before) - 1, odd, record)
        record += r.starts_odd if odd else r.starts_even
        odd ^= r.odd
    pieces = lines.mapInArrow(_pieces(starts), _PIECES)
    whole = pieces.where("whole").select("file_no", "record_no", "text")
    parts = F.array_sort(F.collect_list(F.struct("block", "text")))
    crossing = pieces.where("not whole").groupBy("file_no", "record_no").agg(F.array_join(F.transform(parts, lambda p: p["text"]), "\n").alias("text"))
    records = whole.unionByName(crossing).where("record_no > 0")
    offset = F.get(F.array(*[F.lit(n).cast("long") for n in before or [0]]), F.col("file_no"))
    schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in header)
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true"}
    parsed = F.from_csv(F.regexp_replace("text", "\r$", ""), schema, options)
    return records.select((offset + F.col("record_no")).alias("src_row"), parsed.alias("r")).select("r.*", "src_row")

