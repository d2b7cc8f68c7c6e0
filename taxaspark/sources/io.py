"""Readers and writers for the delimited files the pipeline starts from, and stage hand-offs."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.nulls import qcol
from .delimited import ORDER, Source, read_files


def snake(name: str) -> str:
    """Header to column name: blanks, dots and slashes become underscores."""
    s = re.sub(r"[^0-9A-Za-z_]+", "_", name.strip()).strip("_")
    return s or "col"


#: a null marker that no file holds: blanks then stay apart from ``NA``
NO_MARKER = "\u0001"


def _text_only(schema: StructType) -> StructType:
    return StructType([StructField(f.name, StringType()) for f in schema.fields])


def _delimited(spark: SparkSession, sources: Sequence[Source], schema: StructType | str | None, sep: str, blank_as_null: bool,
               rename: Mapping[str, str] | None, na_value: str, extra: str, missing: str, origin_col: str | None,
               ordered: bool) -> DataFrame:
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if blank_as_null:
        df = read_files(spark, sources, sep, na_value, schema, extra, missing, origin_col, ordered)
    else:
        # the reader turns an unquoted blank into NULL whatever the marker is: read text with a marker that does
        # not occur, then blank -> '' and na_value -> NULL in one projection, and cast
        text = _text_only(schema) if schema is not None else None
        raw = read_files(spark, sources, sep, NO_MARKER, text, extra, missing, origin_col, ordered)
        kinds = {f.name: f.dataType for f in raw.schema.fields} | {f.name: f.dataType for f in (schema or raw.schema).fields}

        def field(name: str) -> Column:
            if name in (origin_col, ORDER):
                return qcol(name)
            known = F.when(qcol(name) != F.lit(na_value), qcol(name))
            if isinstance(kinds[name], StringType):
                return F.when(qcol(name).isNull(), F.lit("")).otherwise(known).alias(name)
            return F.when(qcol(name) != F.lit(""), known).cast(kinds[name]).alias(name)

        df = raw.select(*[field(n) for n in raw.columns])
    return df.withColumnsRenamed(dict(rename)) if rename else df


def read_delimited(spark: SparkSession, path: str | Sequence[str], schema: StructType | str | None = None,
                   sep: str = ",", blank_as_null: bool = True, rename: Mapping[str, str] | None = None,
                   na_value: str = "NA", extra: str = "drop", missing: str = "null", ordered: bool = False) -> DataFrame:
    """CSV/TSV with headers; quoted fields may hold the separator, doubled quotes and line breaks.

    Columns are bound by the names in each file's header, never by position: files (of one path, a folder, or a list of paths) may have them in
    another order, or others. Files are split over tasks, those with line breaks inside quotes too. ``schema`` gives the
    types by name; without it every column of any file is read as text. ``extra`` (columns that the schema does not
    name): ``"drop"`` or ``"keep"`` as text; ``missing`` (columns that no file has): ``"null"``, ``"skip"`` or ``"fail"``. A name that a
    header repeats is the first column's; later ones get ``...position``.
    ``blank_as_null=False`` keeps empty text as ``''`` and reads ``na_value`` as NULL (base R's reader).
    ``ordered`` adds ``ORDER``: sorts as the records stand in the files, earlier paths first.
    """
    paths = [path] if isinstance(path, str) else list(path)
    return _delimited(spark, [Source(p, i) for i, p in enumerate(paths)], schema, sep, blank_as_null, rename, na_value,
                      extra, missing, None, ordered)


def read_tsv(spark: SparkSession, path, schema: StructType | None = None, **kw) -> DataFrame:
    return read_delimited(spark, path, schema, sep="\t", **kw)


def read_tree(spark: SparkSession, root: str, glob: str = "*.csv", schema: StructType | str | None = None,
              sep: str = ",", origin_col: str | None = "source_file", na_value: str = "NA", blank_as_null: bool = True,
              extra: str = "drop", missing: str = "null", ordered: bool = False) -> DataFrame:
    """All matching files below ``root`` (recursive), with the file each row came from; read and bound as ``read_delimited``
    does. With ``ordered``, files follow one another by path."""
    return _delimited(spark, [Source(root, 0, glob, True)], schema, sep, blank_as_null, None, na_value, extra, missing, origin_col, ordered)


def read_like(spark: SparkSession, path, other: DataFrame, sep: str = ",", **kw) -> DataFrame:
    """Read with the column types of another frame, taken by name (``col_types = sapply(df, class)``): columns that the frame
    does not have are text, and its columns that no file has are left out."""
    return read_delimited(spark, path, other.schema, sep=sep, **({"extra": "keep", "missing": "skip"} | kw))


def write_stage(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """Hand a stage to the next one as Parquet (also cuts the lineage)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_list(df: DataFrame, path: str, mode: str = "overwrite", na_value: str = "NA") -> None:
    """Final lists as CSV with a header (a folder of part files), written as the R readers expect:
    quotes doubled inside quoted fields, missing values as ``NA``."""
    (df.write.mode(mode).option("header", True).option("escape", '"').option("nullValue", na_value)
     .csv(path))


def inline_table(spark: SparkSession, rows: Sequence[tuple], schema: StructType) -> DataFrame:
    """A literal table (``data.frame(...)`` / ``tibble(...)``)."""
    return spark.createDataFrame(list(rows), schema)
