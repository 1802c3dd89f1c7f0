"""CSV files whose quoted fields hold line breaks, read in splits.

A split may begin inside a quoted field, and its lines alone do not tell. A first pass counts the quotes of each split:
the number before a split, modulo two, says whether it begins inside quotes. With that, a second pass puts the
lines of each split together to records. A third looks only at splits that begin or end inside quotes, for the two pieces at
most of each that belong to a record of other splits; they are joined by their file and order. So a file is read by as many
tasks as it has splits, and lines are never shuffled. Lines are put together by columns of a batch, without a loop over them.

Every quote opens or closes, as in a database's bulk load of CSV: a quote within an unquoted field counts too.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.sources.files import CORRUPT, UNQUOTED_EMPTY

#: A record with more characters than this is an error: most likely a quote that nothing closes.
MAX_RECORD = 64 << 20
WHOLE = "split long, header boolean, record string"
PIECES = "split long, ends_here boolean, begins_here boolean, header boolean, record string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with the file and the split they begin in, in their order."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value"))


def _splits(lines: DataFrame) -> DataFrame:
    """One row for each split: its number, and whether it begins and ends inside quotes. The windows run over splits, not lines."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counted = lines.groupBy("file", "start").agg(F.sum(quotes).alias("quotes"))
    up_to = F.sum("quotes").over(Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, 0))
    number = F.row_number().over(Window.orderBy("file", "start")).cast("long")
    return counted.select(
        F.col("file").alias("of_file"),
        F.col("start").alias("of_start"),
        number.alias("split"),
        ((up_to - F.col("quotes")) % 2 == 1).alias("inside"),
        (up_to % 2 == 1).alias("after"),
    )


def _runs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose lines are of one split."""
    cuts = (np.flatnonzero(np.diff(batch.column(0).to_numpy())) + 1).tolist()
    for a, b in zip([0, *cuts], [*cuts, len(batch)]):
        yield batch.slice(a, b - a)


def _joined(lines: list[pa.Array]) -> str:
    return "\n".join(line for part in lines for line in part.to_pylist())


def _records(batches: Iterator[pa.RecordBatch], path: str, pieces: bool) -> Iterator[pa.RecordBatch]:
    """Records that lie in one split, or with ``pieces`` those at a split's ends that do not. The first record that begins in the
    first split of a file is its header.

    ``open_lines`` is what the batch before left of a record; ``began`` says whether that record began in this split.
    """
    at: int | None = None
    open_lines: list[pa.Array] = []
    inside = began = head = first = False
    size = byte = 0

    def whole(texts):
        nonlocal head
        heads = np.arange(len(texts)) < head
        head = False
        return pa.record_batch({"split": pa.array(np.full(len(texts), at, np.int64)), "header": heads, "record": texts})

    def piece(ends):
        return pa.record_batch({"split": pa.array([at], pa.int64()), "ends_here": [ends], "begins_here": [began], "header": [first and began], "record": [_joined(open_lines)]})

    def too_long():
        return ValueError(f"{path}: the record at or before byte {byte} of the file of split {at} has a quote that is not closed within {MAX_RECORD} characters")

    def carry(lines):
        nonlocal size
        open_lines.append(lines)
        size += pc.sum(pc.utf8_length(lines)).as_py() + len(lines)
        if size > MAX_RECORD:
            raise too_long()

    for batch in batches:
        for part in _runs(batch) if len(batch) else ():
            split = part.column(0)[0].as_py()
            if split != at:
                if open_lines and pieces:
                    yield piece(False)
                at, byte, open_lines, size = split, part.column(1)[0].as_py(), [], 0
                inside, began, head = part.column(3)[0].as_py(), False, byte == 0
            values = part.column(2).cast(pa.string())
            odd = pc.count_substring(values, '"').to_numpy(zero_copy_only=False) % 2 == 1
            after = np.logical_xor(np.logical_xor.accumulate(odd), inside)
            starts = np.flatnonzero(~np.concatenate([[inside], after[:-1]]))
            inside = bool(after[-1])
            to = int(starts[0]) if len(starts) else len(values)
            if to:
                carry(values.slice(0, to))
                if len(starts) or not inside:
                    if began and not pieces:
                        yield whole(pa.array([_joined(open_lines)], pa.string()))
                    elif pieces and not began:
                        yield piece(True)
                    head = head and not began
                    open_lines, size, began = [], 0, False
            if not len(starts):
                continue
            ends = np.append(starts, len(values))
            if inside:
                ends = ends[:-1]
            if len(ends) > 1:
                lines = values.slice(to, int(ends[-1]) - to)
                if not pieces:
                    alone = len(lines) == len(ends) - 1
                    texts = lines if alone else pc.binary_join(pa.ListArray.from_arrays(pa.array(ends - to, pa.int32()), lines), "\n")
                    if not alone and texts.nbytes >= MAX_RECORD and (np.where(np.diff(ends) > 1, pc.utf8_length(texts).to_numpy(), 0) >= MAX_RECORD).any():
                        raise too_long()
                    yield whole(texts)
                head = False
            if inside:
                began, first = True, head
                carry(values.slice(int(starts[-1])))
    if open_lines and pieces:
        yield piece(False)


def _whole_and_joined(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The splits, the records that lie in one of them (``split``, ``header``, ``record``) and those that do not (``file`` in place of ``split``)."""
    lines = _lines(spark, path)
    splits = _splits(lines)
    known = lines.join(F.broadcast(splits), (F.col("file") == F.col("of_file")) & (F.col("start") == F.col("of_start")), "left")
    inside = F.when(F.col("inside").isNull(), F.raise_error(F.lit("the files were split in another way by the second pass"))).otherwise(F.col("inside"))
    known = known.select("split", "start", "value", inside.alias("inside"), "after")
    whole = known.drop("after").mapInArrow(partial(_records, path=path, pieces=False), WHOLE)
    has_pieces = F.col("inside") | F.col("after")
    found = known.where(has_pieces).drop("after").mapInArrow(partial(_records, path=path, pieces=True), PIECES)
    places = splits.where(has_pieces).select("split", F.col("of_file").alias("file"), F.col("of_start").alias("start"))
    found = found.join(F.broadcast(places), "split")
    # A split's piece that ends a record comes before the one that begins another; one that does neither is all the split.
    in_order = Window.partitionBy("file").orderBy("start", F.desc("ends_here"))
    pieces = found.withColumn("number", F.sum(F.col("begins_here").cast("int")).over(in_order))
    ordered = F.array_sort(F.collect_list(F.struct("start", (~F.col("ends_here")).alias("later"), "record")))
    joined = pieces.groupBy("file", "number").agg(ordered.alias("parts"), F.bool_or("header").alias("header"), F.sum(F.length("record")).alias("size"))
    too_long = F.raise_error(F.concat("file", F.lit(f": a quote is not closed within {MAX_RECORD} characters")))
    text = F.array_join(F.transform("parts", lambda p: p["record"]), "\n")
    joined = joined.select("file", "header", F.when(F.col("size") > MAX_RECORD, too_long).otherwise(text).alias("record"))
    return splits, whole, joined


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``file``, ``header`` (whether it is a file's first) and ``record`` for each record of the CSV files at ``path``, without
    its line break.

    The splits and what is joined across them are bounded by the number of splits, which the driver plans anyway, so
    the former may be broadcast. All passes have to cut the files alike; if the session's cores change in between, the
    read fails. A file that ends inside quotes gives its last record as far as it goes.
    """
    splits, whole, joined = _whole_and_joined(spark, path)
    named = whole.join(F.broadcast(splits.select("split", F.col("of_file").alias("file"))), "split")
    return named.select("file", "header", "record").unionByName(joined)


def read_quoted_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What ``read_csv(..., multiline=True)`` reads, in splits: rows by column position, malformed ones whole in ``_corrupt_record``.
    Line breaks within quotes stay as they are in the file.

    The first record of each file is its header; blank lines are no records. A carriage return before the line break at a
    record's end belongs to the break.
    """
    fields = [*schema.fields, T.StructField(CORRUPT, T.StringType())]
    options = {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "dateFormat": "yyyy-MM-dd", "nullValue": UNQUOTED_EMPTY,
        "emptyValue": "", "escape": '"', "multiLine": "true",
    }
    text = F.when(F.contains("record", F.lit("\r")), F.regexp_replace("record", r"\r$", "")).otherwise(F.col("record"))
    _, whole, joined = _whole_and_joined(spark, path)
    records = whole.select("header", "record").unionByName(joined.select("header", "record"))
    body = records.where(~F.col("header")).select(text.alias("record")).where(F.trim("record") != "")
    layout = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return body.select(F.from_csv("record", layout, options).alias("row")).select("row.*")
