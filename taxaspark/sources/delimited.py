"""Delimited files by the names in their headers, in file order, whatever their quoted fields hold.

Three things that a plain scan of many files does not give:

* **Names.** ``catalogue`` finds every file's header in one scan. Files with one header are read
  together with the columns in that header's order, types are taken by name, and the groups are
  united by name. Nothing is bound by position.
* **Order.** ``ORDER`` is (place of the path in the list, file (the part of its path that tells it from the others), start of the split, position in the partition):
  the order of the records in the files, whatever the splits are, and the same in every retry.
* **Line breaks inside quotes, in files that many tasks read.** A split cannot know whether it begins inside a quoted field.
  So each split says where it would end up for both beginnings (``split_ends``), a prefix over the splits of a file (one
  row each) tells every split how it really begins, and each then puts its own records together (``records``). A record that crosses splits is
  joined from the pieces that the splits reported. Spark's ``from_csv`` parses the records.
  Files in which no line leaves a quoted field open are read by Spark's CSV reader, as before.

A line inside a quoted field ends with ``\\n``; quotes open at the start of a field only and are
doubled inside, which is how Spark's CSV reader takes them.
"""

from __future__ import annotations

import os
import re
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.nulls import qcol
from ..session import ensure_checkpoint_dir

# functions for executors travel with the tasks, so executors need pyarrow but not this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: the column that carries the order of the records, if asked for
ORDER = "__order__"
OUTSIDE, INSIDE, CLOSED = 0, 1, 2


@dataclass(frozen=True)
class Source:
    """One entry of the list of paths; ``glob`` and folders below it as Spark's file sources take them."""

    path: str
    place: int
    glob: str | None = None
    recursive: bool = False


@dataclass(frozen=True)
class File:
    path: str
    place: int
    header: tuple[str, ...]
    breaks: bool


def _literal_path(url: str) -> str:
    """A file's URL as a path that is read as it stands (no escapes, no globs)."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(url))


def _lines(spark: SparkSession, source: Source) -> DataFrame:
    reader = spark.read.option("lineSep", "\n")
    if source.glob:
        reader = reader.option("pathGlobFilter", source.glob)
    if source.recursive:
        reader = reader.option("recursiveFileLookup", True)
    # columns of folder names (k=v) are not the files' own
    return reader.text(source.path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"))


def left_open(line: Column, sep: str) -> Column:
    """Does a line that begins a record end inside a quoted field?

    A fold over the texts between quotes: a quote opens a field where one starts, closes it inside, and is
    a quote of the text right after one that closed.
    """
    pieces = F.split(line, '"')

    def step(state: Column, piece: Column) -> Column:
        opens = piece.endswith(sep) | ((state == CLOSED) & (piece == ""))
        return F.when(state == INSIDE, CLOSED).when(opens, INSIDE).otherwise(OUTSIDE)

    folded = F.aggregate(F.slice(pieces, 1, F.size(pieces) - 1), F.lit(CLOSED), step)
    return F.when(line.contains('"'), folded == INSIDE).otherwise(F.lit(False))


def ends_inside(line: str, sep: str, inside: bool) -> bool:
    """``left_open`` for a single line, which may begin inside a quoted field."""
    state = INSIDE if inside else CLOSED
    pieces = line.split('"')
    pieces.pop()
    for piece in pieces:
        if state == INSIDE:
            state = CLOSED
        else:
            state = INSIDE if piece.endswith(sep) or (state == CLOSED and not piece) else OUTSIDE
    return state == INSIDE


def unique_names(header: Sequence[str | None]) -> tuple[str, ...]:
    """Names without repeats: the first keeps its name, a later one (whatever its case) or an empty one gets ``...position``."""
    seen, out = set(), []
    for i, name in enumerate(header, 1):
        name = (name or "").strip()
        if not name or name.lower() in seen:
            name = f"{name}...{i}"
        seen.add(name.lower())
        out.append(name)
    return tuple(out)


def width(header: str, sep: str) -> int:
    """Fields of a record: separators outside quotes, and one."""
    state, n, pieces = CLOSED, 1, header.split('"')
    for piece in pieces:
        if state == INSIDE:
            state = CLOSED
            continue
        n += piece.count(sep)
        state = INSIDE if piece.endswith(sep) or (state == CLOSED and not piece) else OUTSIDE
    return n


def _header_names(spark: SparkSession, texts: Sequence[str], sep: str) -> dict[str, tuple[str, ...]]:
    """The names in header records, as Spark's own CSV parser cuts them; one row for each distinct header."""
    out = {}
    for text in texts:
        clean = text.lstrip("\ufeff").rstrip("\r")
        kind = ", ".join(f"c{i} string" for i in range(width(clean, sep)))
        row = spark.range(1).select(F.from_csv(F.lit(clean), kind, {"sep": sep, "escape": '"', "multiLine": "true"}).alias("r")).first()["r"]
        out[text] = unique_names(list(row))
    return out


def catalogue(spark: SparkSession, sources: Sequence[Source], sep: str) -> list[File]:
    """Every file with its header, and whether a quoted field in it leaves a line open, in order.

    One scan of the raw text; a row for each file comes to the driver. The header is the first record that is not blank; a file
    without one is left out. A header that holds line breaks has to end in its file's first split.
    """
    found = []
    for source in sources:
        lines = _lines(spark, source).where(~_blank(F.col("value")))
        # ``collect_set`` (of two values at most) makes it an aggregate of objects by hash: with ``max`` beside ``min_by`` Spark sorts all lines
        heads = lines.groupBy("file").agg(
            F.min_by("value", F.struct("block", "row")).alias("head"),
            F.array_contains(F.collect_set(left_open(F.col("value"), sep)), True).alias("breaks")).collect()
        found += [(source, r["file"], r["head"], r["breaks"]) for r in sorted(heads, key=lambda r: r["file"])]
    texts = {file: head for _, file, head, _ in found}
    wide = [file for file, head in texts.items() if ends_inside(head, sep, False)]
    if wide:
        for r in split_ends(_file_lines(spark, wide), sep).where("block = 0").select("file", "head").collect():  # a row for each file
            if r["head"] is None:
                raise ValueError(f"the header of {r['file']} does not end in the first split")
            texts[r["file"]] = r["head"]
    names = _header_names(spark, sorted(set(texts.values())), sep)
    return [File(file, source.place, names[texts[file]], breaks) for source, file, _, breaks in found]


def _blank(line: Column) -> Column:
    return F.trim(F.regexp_replace(line, "[\r\n\ufeff]", "")) == ""


def _file_lines(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    return spark.read.option("lineSep", "\n").text([_literal_path(f) for f in files]).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"), "value")


class _Walk:
    """The lines of one split as records, for one way to begin."""

    def __init__(self, inside: bool) -> None:
        self.inside = inside
        self.held: list[str] = []  # lines of the record that is open
        self.first: int | None = None  # row of its first line; None: it began in an earlier split
        self.carried: str | None = None  # what ends a record of an earlier split
        self.in_carried = inside

    def line(self, row: int, text: str, sep: str) -> tuple[int, str] | None:
        """Take a line; a record that began in this split and ends here is given back."""
        if not self.held and not self.in_carried:
            self.first = row
        self.held.append(text)
        self.inside = ends_inside(text, sep, self.inside)
        if self.inside:
            return None
        whole, self.held = "\n".join(self.held), []
        if self.in_carried:
            self.carried, self.in_carried = whole, False
            return None
        return self.first, whole


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, bool, pa.RecordBatch]]:
    """(file, block, is it the split's first batch, rows) for runs of rows of one split."""
    last = None
    for batch in batches:
        start = 0
        files, blocks = batch.column(0), batch.column(1)
        n = batch.num_rows
        if not n:
            continue
        changed = pc.or_(pc.not_equal(files.slice(1), files.slice(0, n - 1)), pc.not_equal(blocks.slice(1), blocks.slice(0, n - 1)))
        for end in [*(i + 1 for i in pc.indices_nonzero(changed).to_pylist()), n]:
            key = (files[start].as_py(), blocks[start].as_py())
            yield *key, key != last, batch.slice(start, end - start)
            last, start = key, end


def split_ends(lines: DataFrame, sep: str) -> DataFrame:
    """For each split: how it ends if it begins outside or inside a quoted field, and the pieces of records at its ends.

    ``file, block, row, out_end, in_end`` (ends inside?), ``head`` (first record, of a file's first split), ``carried`` (from a beginning inside to
    the end of that record, or the whole split), ``carried_ends``, ``out_row, out_open, in_row, in_open`` (the record left open).
    """
    schema = ("file string, block bigint, out_end boolean, in_end boolean, head string, carried string, carried_ends boolean, "
              "out_row bigint, out_open string, in_row bigint, in_open string")
    names = [x.strip().split(" ")[0] for x in schema.split(",")]
    kinds = pa.schema([(n, {"string": pa.string(), "bigint": pa.int64(), "boolean": pa.bool_()}[x.strip().split(" ")[1]])
                       for n, x in zip(names, schema.split(","), strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def said(key, walks, head):
            out, into = walks
            return pa.RecordBatch.from_pylist([{
                "file": key[0], "block": key[1], "out_end": out.inside, "in_end": into.inside, "head": head,
                "carried": "\n".join(into.held) if into.in_carried else into.carried, "carried_ends": not into.in_carried,
                "out_row": out.first if out.held else None, "out_open": "\n".join(out.held) if out.held else None,
                "in_row": into.first if into.held and not into.in_carried else None,
                "in_open": "\n".join(into.held) if into.held and not into.in_carried else None}], schema=kinds)

        key, walks, head = None, None, None
        for file, block, first, rows in _splits(batches):
            if first:
                if walks:
                    yield said(key, walks, head)
                key, walks, head = (file, block), (_Walk(False), _Walk(True)), None
            quoted = pc.match_substring(rows.column(3), '"')
            every, numbers = rows.column(3), rows.column(2)
            # a line without quotes changes nothing outside; it counts where a record is open, and as the first record
            for i, has in enumerate(quoted.to_pylist()):
                wanted = [w for w in walks if has or w.inside]
                if not wanted and (head is not None or block):
                    continue
                text, row = every[i].as_py(), numbers[i].as_py()
                for w in wanted:
                    done = w.line(row, text, sep)
                    if w is walks[0] and head is None and done:
                        head = done[1]
                if head is None and not walks[0].inside and walks[0] not in wanted and text.strip(" \r\ufeff"):
                    head = text
        if walks:
            yield said(key, walks, head)

    return lines.select("file", "block", "row", "value").mapInArrow(run, schema)


def begins(ends: DataFrame) -> DataFrame:
    """``ends`` plus ``inside``: does the split begin inside a quoted field? A prefix over the splits of each file.

    A split maps the two beginnings to two ends: it keeps them, swaps them, or ends one way whatever the beginning. So the state
    is the last fixed end before, swapped as often as splits since then swap: two running windows over one row a split.
    """
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    swap = (F.col("out_end") & ~F.col("in_end")).cast("int")
    fixed = F.col("out_end") == F.col("in_end")
    upto = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = ends.withColumn("_swaps", F.sum(swap).over(upto))
    last = F.last(F.when(fixed, F.struct(F.col("out_end").cast("int").alias("end"), F.col("_swaps").alias("at"))), ignorenulls=True).over(before)
    marked = counted.withColumn("_last", last).withColumn("_before", F.coalesce(F.lag("_swaps").over(Window.partitionBy("file").orderBy("block")), F.lit(0)))
    state = F.coalesce(F.col("_last.end"), F.lit(0)) + F.col("_before") - F.coalesce(F.col("_last.at"), F.lit(0))
    return marked.withColumn("inside", state % 2 == 1).drop("_swaps", "_last", "_before")


def records(spark: SparkSession, files: Sequence[str], sep: str) -> DataFrame:
    """``file, block, row, value``: all records of the files but their headers; ``value`` may hold line breaks."""
    ensure_checkpoint_dir(spark)
    lines = _file_lines(spark, files)
    ends = begins(split_ends(lines, sep)).checkpoint(eager=True)
    names = ["file", "block", "row", "value"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk, skip = None, False
        for file, block, first, rows in _splits(batches):
            if first:
                walk, skip = _Walk(rows.column(4)[0].as_py()), block == 0
            values, numbers = rows.column(3), rows.column(2)
            quoted = pc.match_substring(values, '"').to_pylist()
            single, joined = [], []
            for i, has in enumerate(quoted):
                if not has and not walk.inside:
                    if skip and values[i].as_py().strip(" \r\ufeff"):
                        skip = False  # the header
                    else:
                        single.append(i)
                    continue
                done = walk.line(numbers[i].as_py(), values[i].as_py(), sep)
                if done and skip:
                    skip = False
                elif done:
                    joined.append(done)
            if single:
                yield pa.RecordBatch.from_arrays(rows.take(pa.array(single)).columns[:4], names)
            if joined:
                yield pa.RecordBatch.from_arrays([pa.array([file] * len(joined)), pa.array([block] * len(joined), pa.int64()),
                                                  pa.array([r for r, _ in joined], pa.int64()), pa.array([t for _, t in joined])], names)

    kind = "file string, block bigint, row bigint, value string"
    # one row a split, so no more than tasks of the scan
    told = lines.join(F.broadcast(ends.select("file", "block", "inside")), ["file", "block"]).select("file", "block", "row", "value", "inside")
    inner = told.mapInArrow(run, kind)
    # the record that is open at the end of a split, and what later splits carry of it
    row, text = (F.when(F.col("inside"), F.col(f"in_{c}")).otherwise(F.col(f"out_{c}")) for c in ("row", "open"))
    piece = F.explode(F.array(
        F.struct(F.lit(0).alias("part"), F.lit(None).cast("bigint").alias("row"), F.when(F.col("inside"), F.col("carried")).alias("text")),
        F.struct(F.lit(1).alias("part"), row.alias("row"), text.alias("text")))).alias("p")
    pieces = ends.select("file", "block", piece).select("file", "block", "p.*").where("text IS NOT NULL")
    run_no = F.sum("part").over(Window.partitionBy("file").orderBy("block", "part").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    crossing = pieces.withColumn("no", run_no).groupBy("file", "no").agg(
        F.min_by("block", F.struct("block", "part")).alias("block"), F.max("row").alias("row"),
        F.sort_array(F.collect_list(F.struct("block", "part", "text"))).alias("texts"))
    crossing = crossing.select("file", "block", "row", F.array_join(F.col("texts.text"), "\n").alias("value"))
    return inner.unionByName(crossing)


def _options(sep: str, na_value: str) -> dict[str, str]:
    return {"sep": sep, "escape": '"', "nullValue": na_value, "mode": "FAILFAST"}


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)


def _group(spark: SparkSession, files: Sequence[File], kind: StructType, sep: str, na_value: str, placed: bool) -> DataFrame:
    """Files of one header: their columns as ``kind`` has them (in the header's order); if ``placed``, with file, block and row."""
    fields, place = [qcol(f.name) for f in kind.fields], [F.col("_m").getField(c).alias(f"_{c}") for c in ("file", "block", "row")]
    if files[0].breaks:
        rows = records(spark, [f.path for f in files], sep).where(~_blank(F.col("value")))  # empty lines are no records
        text = F.regexp_replace("value", "\r$", "")
        parsed = rows.select(F.from_csv(text, _ddl(kind), {**_options(sep, na_value), "multiLine": "true"}).alias("_r"),
                             F.struct("file", "block", "row").alias("_m"))
        return parsed.select(*[F.col("_r").getField(f.name).alias(f.name) for f in kind.fields], *(place if placed else []))
    reader = spark.read.schema(kind).option("header", True)
    for k, v in _options(sep, na_value).items():
        reader = reader.option(k, v)
    rows = reader.csv([_literal_path(f.path) for f in files])
    if not placed:
        return rows
    own = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                   F.monotonically_increasing_id().alias("row"))
    return rows.select(*fields, own.alias("_m")).select(*fields, *place)


def _own_part(paths: Sequence[str]) -> tuple[int, int]:
    """Where the paths differ, as (start, length): their order by this part is their order, and rows that carry it stay narrow.

    What they begin with is left out; what they end with too, if the rest is equally long in all.
    """
    start = len(os.path.commonprefix(paths))
    rest = [p[start:] for p in paths]
    length = max(map(len, rest), default=0)
    if length == min(map(len, rest), default=0):
        length -= len(os.path.commonprefix([r[::-1] for r in rest]))
    return start, length


def read_files(spark: SparkSession, sources: Sequence[Source], sep: str, na_value: str, schema: StructType | None,
               extra: str, missing: str, origin_col: str | None = None, ordered: bool = False) -> DataFrame:
    """All files of ``sources`` bound by name.

    ``schema`` gives types by name (any case; the schema's spelling is kept). ``extra``: columns that it does not name are
    kept as text (``"keep"``) or left out (``"drop"``). ``missing``: columns that no file has are null (``"null"``), left out (``"skip"``) or an error (``"fail"``);
    a column that only some files have is null in the others. No file with a header: no rows.
    """
    files = catalogue(spark, sources, sep)
    declared = {f.name.lower(): f for f in schema.fields} if schema is not None else {}
    groups: dict[tuple, list[File]] = {}
    for f in files:
        groups.setdefault((f.place, f.header, f.breaks), []).append(f)
    order: list[str] = [f.name for f in schema.fields] if schema is not None else []
    known = {n.lower() for n in order}
    there = set()
    for _, header, _ in groups:
        for name in header:
            there.add(name.lower())
            if name.lower() not in known and (schema is None or extra == "keep"):
                known.add(name.lower())
                order.append(name)
    absent = [n for n in order if n.lower() not in there]
    if absent and missing == "fail" and files:
        raise ValueError(f"no file has the columns {absent}")
    if missing == "skip" and files:
        order = [n for n in order if n.lower() in there]
    kinds = {n: declared[n.lower()].dataType if n.lower() in declared else StringType() for n in order}
    extras = ([origin_col] if origin_col else []) + ([ORDER] if ordered else [])
    out = None
    start, length = _own_part(sorted({f.path for f in files}))
    for (place, header, _), own in groups.items():
        spelled = {n.lower(): n for n in order}
        kind = StructType([StructField(spelled.get(h.lower(), h), kinds.get(spelled.get(h.lower(), ""), StringType())) for h in header])
        df = _group(spark, own, kind, sep, na_value, bool(origin_col or ordered))
        got = {f.name for f in kind.fields}
        cols = [qcol(n) if n in got else F.lit(None).cast(kinds[n]).alias(n) for n in order]
        if origin_col:
            cols.append(F.col("_file").alias(origin_col))
        if ordered:
            cols.append(F.struct(F.lit(place).alias("place"), F.substring("_file", start + 1, length).alias("file"), F.col("_block").alias("block"),
                                 F.col("_row").alias("row")).alias(ORDER))
        df = df.select(*cols)
        out = df if out is None else out.unionByName(df)
    if out is None:
        kind = ", ".join([*(f"`{n}` {kinds[n].simpleString()}" for n in order), *(f"`{n}` string" for n in extras)])
        return spark.createDataFrame([], kind or "value string")
    return out
