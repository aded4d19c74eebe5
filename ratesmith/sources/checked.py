"""Checked reading of the CSV sources: rejected lines, and exports whose headers differ.

**Rate files** (:func:`read_checked`).  Spark's permissive CSV reading turns a value that does not parse
into NULL and says nothing.  Here every line is either a good row or a *reject* with its file,
its text and the columns that could not be read, so that ``good + rejects`` are the lines
(blank lines and headers apart).  Header lines are known by their names instead of by their
place, so a file that lacks its header does not lose its first row.

**Trade exports** (:func:`read_aligned_exports`).  A glob of exports collected over years has files whose
headers differ in order, spelling or extra columns.  Each file's own header decides which of its
positions holds which column.  A file without a header that names all columns is an error, not a
shifted row.

Both are DataFrame plans: no file is opened on the driver, and a file's header reaches the other tasks of
that file by a join on the path.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratesmith.session import cut_lineage
from ratesmith.sources import files as SF

LINE, FILE = "rejected_line", "rejected_file"


@dataclass(frozen=True)
class Layout:
    """A rate-file layout: the columns of a line, whether files have a header, and how the folders nest."""

    schema: T.StructType
    header: bool
    partitions: tuple[str, ...] = SF.PAIR_PARTITIONS
    options: Mapping[str, str] = field(default_factory=dict)


LAYOUTS = {
    "currencylayer": Layout(SF.CURRENCYLAYER_SCHEMA, header=False),
    "ohlc": Layout(SF.OHLC_SCHEMA, header=True),
    "crypto": Layout(SF.OHLC_SCHEMA, header=True, partitions=("exchange",) + SF.PAIR_PARTITIONS),
    "investing": Layout(SF.INVESTING_SCHEMA, header=True, options={"quote": '"', "escape": '"'}),
}


@dataclass(frozen=True)
class CheckedRead:
    """``good``: the rows as the plain reader gives them.  ``rejects``: file, line, unread columns, partition columns."""

    good: DataFrame
    rejects: DataFrame

    def counts(self) -> DataFrame:
        """``file, rejected``: files with rejected lines (none if all lines are good)."""
        return self.rejects.groupBy("file").agg(F.count("*").alias("rejected"))


def _plain_name(name: Column) -> Column:
    return F.regexp_replace(F.lower(name), "[^a-z0-9]", "")


def _plain(name: str) -> str:
    return re.sub("[^a-z0-9]", "", name.lower())


def _is_header(line: Column, schema: T.StructType) -> Column:
    names = ",".join(_plain(f.name) for f in schema.fields)
    return F.regexp_replace(F.lower(line), "[^a-z0-9,]", "") == F.lit(names)


def read_checked(spark: SparkSession, layout: str, root: str) -> CheckedRead:
    """Read a rate-file root of one of the :data:`LAYOUTS`, telling good rows from rejected lines.

    A line is rejected when it has more or fewer fields than the layout or a value that
    does not parse; an empty field is a NULL of a good row.  Filters on the partition columns of
    either result prune folders as those of the plain readers do.
    """
    kind = LAYOUTS[layout]
    root = root.rstrip("/")
    schema = T.StructType([*kind.schema.fields, T.StructField(LINE, T.StringType())])
    reader = (spark.read.schema(schema).option("header", "false").option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", LINE).option("columnPruning", "false").options(**kind.options))
    if layout == "crypto":
        read = reader.option("basePath", root).csv(f"{root}/exchange=*")
    else:
        read = reader.csv(root)
    # Spark reads only the values a query needs, and a line counts as wrong for those alone.  So both sides look
    # at all of them (the condition is true of every row): a line's verdict is the same whatever is asked for.
    looked = F.hash(*[f.name for f in kind.schema.fields]) >= F.lit(-(1 << 31))
    wrong = F.col(LINE).isNotNull() & looked
    good = read.where(F.col(LINE).isNull() & looked).drop(LINE)
    unread = F.array_compact(F.array(*[F.when(F.col(f.name).isNull(), F.lit(f.name)) for f in kind.schema.fields]))
    rejected = read.where(wrong & ~(_is_header(F.col(LINE), kind.schema) if kind.header else F.lit(False)))
    rejects = rejected.select(F.col("_metadata.file_path").alias("file"), F.col(LINE).alias("line"), unread.alias("unread"),
                              *[p for p in kind.partitions if p in read.columns])
    return CheckedRead(good, rejects)


# ---- trade exports ---------------------------------------------------------------------------

#: Fields read of a line; an export may have this many columns at most.
WIDEST = 64


class HeaderError(ValueError):
    """Export files without a header that names every column."""


def read_aligned_exports(spark: SparkSession, path: str, columns: Sequence[str],
                         aliases: Mapping[str, Sequence[str]] | None = None, widest: int = WIDEST) -> DataFrame:
    """Trade exports with the given ``columns`` (all STRING), each file aligned by its own header.

    Header names match without regard to case, spaces and punctuation, or by one of ``aliases``
    (column -> other names).  Columns that are not asked for are left out.  A line that names all columns is a
    header wherever it stands (concatenated exports); a file must have one, and only one kind of
    it, else :class:`HeaderError` names files concerned.  Runs one job, over the files' header lines.
    """
    fields = [f"_c{i}" for i in range(widest)]
    schema = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    lines = (spark.read.schema(schema).option("header", "false").option("mode", "PERMISSIVE").option("columnPruning", "false").csv(path)
             .select(F.col("_metadata.file_path").alias("file"), F.array(*fields).alias("fields")))
    known = {c: sorted({_plain(n) for n in (c, *(aliases or {}).get(c, ()))}) for c in columns}
    taken = [n for names in known.values() for n in names]
    if len(set(taken)) != len(taken):
        raise ValueError("column names or aliases that differ in punctuation only")
    # only a line that names the first column somewhere is compared in full
    plain = F.transform("fields", _plain_name)
    place = [F.greatest(*[F.array_position("names", n) for n in known[c]], F.lit(0)) for c in columns]
    named = lines.withColumn("names", F.transform(plain, lambda n: F.coalesce(n, F.lit(""))))
    named = named.withColumn("places", F.array(*place))
    is_header = ~F.array_contains("places", F.lit(0))
    headers = named.where(is_header).select("file", "places").distinct()
    headers = cut_lineage(headers, "export-headers")
    unsure = headers.groupBy("file").agg(F.count("*").alias("k")).where("k > 1").select("file")
    headless = lines.select("file").distinct().join(headers.select("file"), "file", "left_anti")
    wrong = [r.file for r in unsure.union(headless).orderBy("file").limit(20).collect()]
    if wrong:
        raise HeaderError(f"no header, or several that differ, naming {', '.join(columns)} in: {', '.join(wrong)}")
    rows = named.where(~is_header).select("file", "fields").join(headers, "file")
    return rows.select(*[F.get("fields", F.get("places", F.lit(i)).cast("int") - 1).alias(c) for i, c in enumerate(columns)])
