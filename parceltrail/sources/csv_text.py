"""CSV files as all-text tables."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Tokens that mean "no value". Blanks around a token make it ordinary text.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Hadoop's setting for the bytes above which a line is skipped.
_LINE_LIMIT = "mapreduce.input.linerecordreader.line.maxlength"
LONGEST = 16 << 20

_RECORD = "_raw_record"
_FILE_NAME = "_file_name"
_FILE_PATH = "_file_path"


def _count(text: Column, char: str) -> Column:
    """Occurrences of an ASCII character; bytes are compared, which needs no decoding."""
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(char), F.lit("")))


def _names(header: Column) -> Column:
    """The names in a header line: what Python's csv module reads, without the blanks around each."""
    line = F.regexp_replace(header, "^\ufeff", "")
    fields = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(r',("[^"]*+(?:""[^"]*+)*+"?[^,]*|[^,]*)'), 1)

    def name(field: Column) -> Column:
        # What follows a closing quote belongs to the name as it is.
        parts = r'(?s)^"([^"]*+(?:""[^"]*+)*+)"?(.*)$'
        inside = F.replace(F.regexp_extract(field, parts, 1), F.lit('""'), F.lit('"'))
        value = F.when(F.startswith(field, F.lit('"')), F.concat(inside, F.regexp_extract(field, parts, 2)))
        return F.regexp_replace(value.otherwise(field), r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")

    return F.transform(fields, name)


@dataclass
class Look:
    """What one pass over the text tells of the files."""

    # (physical first line of a file, the file): one, or two whose names differ.
    headers: list[tuple[str, str]] = field(default_factory=list)
    # Files to read record by record, by the end of their lines.
    record_wise: dict[str, list[str]] = field(default_factory=dict)
    # Those of them that are large enough to be read in blocks.
    in_blocks: set[str] = field(default_factory=set)
    # Files to read line by line.
    any_line_wise: bool = False


def _line_ends(spark: SparkSession, path: str, files: list[str]) -> dict[str, str]:
    """How the lines of each of the files end.

    Read by LF, a file whose lines end in CR is one line. Lines above LONGEST are skipped, so such a file
    has either CR within its first line or, if it is large, no line at all.
    """
    lines = spark.read.option(_LINE_LIMIT, LONGEST).text(path, lineSep="\n").where(F.col("_metadata.file_path").isin(files))
    at_cr = F.instr("value", "\r")
    end = F.when(at_cr == 0, "\n").when(at_cr == F.length("value"), "\r\n").otherwise("\r")
    ends = lines.select(
        F.col("_metadata.file_path").alias("file"), end.alias("end"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
    )
    found = ends.groupBy("file").agg(F.min_by("end", F.struct("block", "at")).alias("end")).collect()
    return {f: "\r" for f in files} | {r.file: r.end for r in found}


def look_at_files(
    spark: SparkSession, path: str, multi_line: bool | None = None, block_above: int | None = None
) -> Look:
    """Header of the files, which may have line breaks in fields, and the ends of the lines of those.

    The first line of a record that goes on in the next line always has an odd number of quotes, whatever ends the
    lines. A lone literal quote inside an unquoted field does as well; such files are then read
    record-wise, which is right too, only dearer. The driver gets the names of the record-wise files, which it lists
    anyway, and not more than two headers.
    """
    # Without a separator of its own, the reader ends lines at LF, CRLF and CR alike.
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("bytes"),
        (F.col("_metadata.file_block_start") == 0).alias("at_start"),
        F.monotonically_increasing_id().alias("at"),
    )
    # An empty file has no line, so it has no header here.
    files = lines.groupBy("file").agg(
        F.min_by(F.when(F.col("at_start"), F.col("value")), F.when(F.col("at_start"), F.col("at"))).alias("header"),
        F.max(_count(F.col("value"), '"') % 2 == 1).alias("broken"),
        F.first("bytes").alias("bytes"),
    )
    if multi_line is not None:
        files = files.withColumn("broken", F.lit(multi_line))
    found = Look()
    # Spellings of the same names are one group, which then holds all files; two groups are an error.
    per_names = files.groupBy(_names(F.col("header")).alias("names")).agg(
        F.min(F.struct("file", "header")).alias("least"),
        F.max(~F.col("broken")).alias("plain"),
        F.sort_array(F.collect_list(F.when(F.col("broken"), F.struct("file", "bytes")))).alias("broken"),
    )
    rows = per_names.orderBy("least.file").limit(2).collect()
    found.headers = [(r.least.header, r.least.file) for r in rows]
    found.any_line_wise = any(r.plain for r in rows)
    sizes = {f.file: f.bytes for r in rows for f in r.broken}
    if sizes:
        above = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes() if block_above is None else block_above
        found.in_blocks = {f for f, size in sizes.items() if size > above}
        for file, end in sorted(_line_ends(spark, path, list(sizes)).items()):
            found.record_wise.setdefault(end, []).append(file)
    return found


def files_with_breaks(spark: SparkSession, path: str) -> list[str]:
    """Files in which some physical line holds an odd number of quotes."""
    return sorted(f for files in look_at_files(spark, path).record_wise.values() for f in files)


def _check_headers(headers: list[tuple[str, str]]) -> None:
    """All files must have the same names, whatever their quotes."""
    if len(headers) > 1:
        (one, first), (two, second) = headers
        raise ValueError(f"different headers: {one!r} in {first}, {two!r} in {second}")


def _unreadable(record: Column, n_columns: int) -> Column:
    """True for a record with too many fields or with a quoted field that does not end."""
    unquoted = F.regexp_replace(record, r'"[^"]*"', "")
    return (_count(unquoted, ",") >= n_columns) | unquoted.rlike(r'(^|,)"')


def quoted(name: str) -> Column:
    """The column of this very name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def _column_names(header: list[str | None]) -> list[str]:
    """Names without surrounding blanks; missing ones get their position, repeated ones a number."""
    seen: Counter[str] = Counter()
    names = []
    for position, cell in enumerate(header):
        name = cell or f"Unnamed: {position}"
        names.append((f"{name}.{seen[name]}" if seen[name] else name).strip())
        seen[name] += 1
    return names


def _checked(rows: DataFrame, columns: list[str], pad_short: bool, line_end: str | None) -> DataFrame:
    """``rows`` (text columns, the raw record of a row of another width, file name) of which each has to be right."""
    bad = F.col(_RECORD).isNotNull()
    if pad_short:
        bad = bad & _unreadable(F.col(_RECORD), len(columns))
    # Spark refuses queries that need nothing but the raw record; the message needs a value too.
    message = F.format_string(
        f"expected {len(columns)} fields in %s, got: %s (first value %s)",
        F.col(_FILE_NAME),
        F.col(_RECORD),
        quoted(columns[0]),
    )
    check = F.when(bad, F.raise_error(message).cast("boolean"))
    if line_end == "\n":
        check = check.when(F.endswith(quoted(columns[-1]), F.lit("\r")), F.raise_error(_mixed_ends()).cast("boolean"))
    return rows.where(check.otherwise(True)).drop(_RECORD)


def _mixed_ends() -> Column:
    return F.format_string("lines end in LF and in CRLF in %s", F.col(_FILE_NAME))


def _read_checked(
    spark: SparkSession, path: str, header: list[str | None], options: dict, pad_short: bool
) -> DataFrame:
    """Text columns, file name and file path; rows of a wrong width fail the read."""
    # Spark compares the header of every file with the schema, for which it needs distinct names.
    comparable = all(header) and len({cell.lower() for cell in header}) == len(header)
    columns = header if comparable else [f"_c{i}" for i in range(len(header))]
    schema = StructType([StructField(c, StringType()) for c in [*columns, _RECORD]])
    rows = (
        # Without column pruning every record is checked, whatever the query selects.
        spark.read.option("columnPruning", False)
        .csv(
            path,
            schema=schema,
            header=True,
            columnNameOfCorruptRecord=_RECORD,
            enforceSchema=not comparable,
            **options,
        )
        .select(
            "*",
            F.col("_metadata.file_name").alias(_FILE_NAME),
            F.col("_metadata.file_path").alias(_FILE_PATH),
        )
    )
    return _checked(rows, columns, pad_short, options.get("lineSep"))


# A line as a function of "inside a quoted field": whether it ends inside, if it starts outside or inside. A quote opens a
# field only at its start; a doubled one does not close it.
_INSIDE = r'[^"]*+(?:""[^"]*+)*+'
_FIELD = rf'(?:"{_INSIDE}"[^,]*+|[^",][^,]*+)?+,'
_FROM_OUTSIDE = rf'\A\ufeff?(?:{_FIELD})*+"{_INSIDE}\z'
_FROM_INSIDE = rf'\A{_INSIDE}(?:\z|"[^,]*+,(?:{_FIELD})*+"{_INSIDE}\z)'


def _traced(rows: DataFrame, group: list[str], order: str) -> DataFrame:
    """Add ``swaps`` and ``fixed`` of all rows of the group so far, this one included.

    A row takes the state (inside a quoted field or not) to ``outside_to`` or ``inside_to``. If these agree, the state behind the
    row is fixed, whatever it was; if both differ from the state before, it is swapped. So the state behind any
    row follows from the last fixed one and from the number of swaps since.
    """
    so_far = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swap = F.col("outside_to") & ~F.col("inside_to")
    rows = rows.withColumn("swaps", F.sum(swap.cast("int")).over(so_far))
    here = F.when(F.col("outside_to") == F.col("inside_to"), F.struct(F.col("outside_to").alias("to"), F.col("swaps").alias("at")))
    return rows.withColumn("fixed", F.last(here, ignorenulls=True).over(so_far))


def _behind(start: Column) -> Column:
    """The state behind a row of ``_traced``, if it is ``start`` before the group's first row."""
    odd = lambda n: n % 2 == 1
    since = odd(F.col("swaps") - F.col("fixed.at"))
    return F.when(F.col("fixed").isNull(), start != odd(F.col("swaps"))).otherwise(F.col("fixed.to") != since)


def _block_starts(lines: DataFrame) -> DataFrame:
    """file, block, starts_inside, more (whether the file goes on) of each block of ``lines``: a row for each block."""
    traced = _traced(lines, [_FILE_PATH, "block"], "at")
    last = traced.groupBy(_FILE_PATH, "block").agg(F.max_by(F.struct("swaps", "fixed"), "at").alias("last")).select(
        _FILE_PATH, "block", "last.*"
    )
    # A block takes either start to an end, like a line.
    blocks = last.select(
        _FILE_PATH, "block", _behind(F.lit(False)).alias("outside_to"), _behind(F.lit(True)).alias("inside_to")
    )
    behind = _traced(blocks, [_FILE_PATH], "block").withColumn("behind", _behind(F.lit(False)))
    order = Window.partitionBy(_FILE_PATH).orderBy("block")
    return behind.select(
        F.col(_FILE_PATH).alias("_of"),
        F.col("block").alias("_block"),
        F.lag("behind", 1, False).over(order).alias("starts_inside"),
        F.lead("block").over(order).isNotNull().alias("more"),
    )


def _records(spark: SparkSession, path: str, files: list[str], line_end: str) -> DataFrame:
    """The raw records of files with line breaks in fields, without the headers; each file is read block by block.

    A block is what one task reads of a file. Whether it starts inside a quoted field depends on all blocks before it: each block's
    effect is worked out by itself, and a window over the blocks (one row each) takes the state from block to block.
    Then the lines of a block, which meet in one task, are put together to records. A record that a block
    begins and another ends is put together from the pieces at the blocks' edges.
    """
    separator = "\r" if line_end == "\r" else "\n"
    text = F.rtrim("value", F.lit("\r")) if line_end == "\r\n" else F.col("value")
    quotes = F.contains("value", F.lit('"'))
    lines = (
        spark.read.text(path, lineSep=separator)
        .where(F.col("_metadata.file_path").isin(files))
        .select(
            F.col("_metadata.file_path").alias(_FILE_PATH),
            F.col("_metadata.file_name").alias(_FILE_NAME),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("at"),
            (quotes & text.rlike(_FROM_OUTSIDE)).alias("outside_to"),
            (~quotes | text.rlike(_FROM_INSIDE)).alias("inside_to"),
            "value",
        )
    )
    starts = _block_starts(lines.drop("value", _FILE_NAME))
    here = (F.col(_FILE_PATH) == F.col("_of")) & (F.col("block") == F.col("_block"))
    # The state at a place of a file does not depend on how it is cut; if it was cut elsewhere meanwhile, the read fails.
    lost = F.raise_error(F.format_string("%s was cut into other blocks by another scan", F.col(_FILE_PATH))).cast("boolean")
    lines = lines.join(starts, here, "left").withColumn("starts_inside", F.coalesce("starts_inside", lost))
    order = Window.partitionBy(_FILE_PATH, "block").orderBy("at")
    traced = _traced(lines, [_FILE_PATH, "block"], "at").withColumn("behind", _behind(F.col("starts_inside")))
    traced = traced.withColumn("before", F.coalesce(F.lag("behind").over(order), F.col("starts_inside")))
    if line_end == "\r\n":
        goes_on = F.col("more") | F.lead("at").over(order).isNotNull()
        mixed = ~F.col("behind") & ~F.endswith("value", F.lit("\r")) & goes_on
        value = F.when(mixed, F.raise_error(_mixed_ends())).otherwise(F.col("value"))
        traced = traced.withColumn("value", value)
    blank = F.length(F.rtrim("value", F.lit("\r"))) == 0 if line_end == "\r\n" else F.length("value") == 0
    traced = traced.where(F.col("before") | ~blank)
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = traced.withColumn("number", F.sum((~F.col("before")).cast("int")).over(so_far))

    def joined(*place: str) -> Column:
        ordered = F.array_sort(F.collect_list(F.struct(*place, "value")))
        return F.array_join(F.transform(ordered, lambda line: line["value"]), separator)

    pieces = numbered.groupBy(_FILE_PATH, _FILE_NAME, "block", "number").agg(
        joined("at").alias("value"), F.max_by("behind", "at").alias("open")
    )
    # Number 0 are the lines before a block's first record.
    edge = F.col("open") | (F.col("number") == 0)
    first = ((F.col("block") == 0) & (F.col("number") == 1)).alias("first")
    whole = pieces.where(~edge).select(_FILE_PATH, _FILE_NAME, "value", first)
    # At most two pieces for each block of a file.
    in_file = Window.partitionBy(_FILE_PATH).orderBy("block", "number")
    edges = pieces.where(edge).withColumn("record", F.sum((F.col("number") > 0).cast("int")).over(in_file))
    mended = edges.withColumn("first", first).groupBy(_FILE_PATH, _FILE_NAME, "record").agg(
        joined("block", "number").alias("value"), F.max("first").alias("first")
    )
    records = whole.unionByName(mended.drop("record")).where(~F.col("first")).drop("first")
    if line_end == "\r\n":
        records = records.withColumn("value", F.regexp_replace("value", r"\r\z", ""))
    return records


def _read_blocks(
    spark: SparkSession, path: str, files: list[str], header: list[str | None], line_end: str, pad_short: bool
) -> DataFrame:
    """What ``_read_checked`` gives, for files that are read in blocks."""
    columns = [f"_c{i}" for i in range(len(header))]
    schema = ", ".join(f"`{c}` string" for c in [*columns, _RECORD])
    options = {k: str(v) for k, v in _options(False).items()} | {"columnNameOfCorruptRecord": _RECORD, "mode": "PERMISSIVE"}
    rows = _records(spark, path, files, line_end).select(
        F.from_csv("value", schema, options).alias("row"), _FILE_NAME, _FILE_PATH
    )
    return _checked(rows.select("row.*", _FILE_NAME, _FILE_PATH), columns, pad_short, line_end)


def _options(multi_line: bool, line_end: str | None = None) -> dict:
    options = {
        "quote": '"',
        "escape": '"',
        "multiLine": multi_line,
        "unescapedQuoteHandling": "RAISE_ERROR",
    }
    # Left to itself, record-wise reading turns CRLF in quotes into LF.
    return {**options, "lineSep": line_end} if multi_line and line_end else options


def _header(spark: SparkSession, path: str, file: str, options: dict) -> list[str | None] | None:
    """The cells of a file's first record.

    The record is asked for as it stands, as a row that is too wide; Spark would take the number of columns from any
    file of the path, which may have other line ends.
    """
    raw = spark.read.csv(path, schema=f"_c0 string, {_RECORD} string", columnNameOfCorruptRecord=_RECORD, **options)
    row = raw.where(F.col("_metadata.file_path") == file).first()
    if row is None or row[_RECORD] is None:
        return row and [row["_c0"]]
    line = F.lit(row[_RECORD].rstrip("\r\n"))
    width = spark.range(1).select(F.size(_names(line))).first()[0]
    schema = ", ".join(f"_c{i} string" for i in range(width))
    plain = {k: str(v) for k, v in _options(False).items()}
    return list(spark.range(1).select(F.from_csv(line, schema, plain).alias("row")).select("row.*").first())


def read_text_csv(
    spark: SparkSession,
    path: str,
    multi_line: bool | None = None,
    pad_short: bool = True,
    block_above: int | None = None,
) -> DataFrame:
    """Read CSV with a header row; every column is text, plus ``source_file``.

    ``path`` is a file, folder or glob; all files must have the same header, or the read fails with the names of two
    that differ. Blanks around header names are removed, values are kept as they are, and NA tokens become NULL.

    ``multi_line`` says whether quoted fields may contain line breaks. Files without them are
    split between tasks line by line. Files with them are read record by record, each with its own line end, so
    a folder may hold LF, CRLF and CR files: small ones by one task each, those above ``block_above`` bytes
    (``spark.sql.files.maxPartitionBytes`` unless given) in blocks by many tasks. One pass over the text finds out which are
    which. ``None`` looks which files have breaks; False says that there are none, which saves the pass if the
    header's names are complete and distinct. A record-wise file that mixes line ends fails.

    A row with more fields than the header fails the read, and so does text after a closing quote.
    A row with fewer fields is filled with NULL, unless it ends inside a quoted field or
    ``pad_short`` is off; then it fails too. The check is part of the plan, not a second pass.
    """
    if multi_line is False:
        first = spark.read.csv(path, **_options(False)).first()
        header = list(first) if first else None
        if header and (not all(header) or len({c.lower() for c in header}) < len(header)):
            # Spark can't compare such names itself.
            _check_headers(look_at_files(spark, path, False).headers)
        look = Look(any_line_wise=True)
    else:
        look = look_at_files(spark, path, multi_line, block_above)
        _check_headers(look.headers)
        header = None
        if look.headers:
            file = look.headers[0][1]
            ends = [end for end, files in look.record_wise.items() if file in files]
            header = _header(spark, path, file, _options(True, ends[0]) if ends else _options(False))
    if header is None:
        raise ValueError(f"no header row in {path}")

    # The filters select whole files, so each file is read by one of the scans only.
    parts = []
    listed = [f for files in look.record_wise.values() for f in files]
    if look.any_line_wise:
        line_wise = _read_checked(spark, path, header, _options(False), pad_short)
        parts.append(line_wise.where(~F.col(_FILE_PATH).isin(listed)) if listed else line_wise)
    for end, files in sorted(look.record_wise.items()):
        large = [f for f in files if f in look.in_blocks]
        small = [f for f in files if f not in look.in_blocks]
        if large:
            parts.append(_read_blocks(spark, path, large, header, end, pad_short))
        if small:
            some = _read_checked(spark, path, header, _options(True, end), pad_short)
            alone = not look.any_line_wise and not look.in_blocks and len(look.record_wise) == 1
            parts.append(some if alone else some.where(F.col(_FILE_PATH).isin(small)))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.union(part)
    names = _column_names(header)
    renamed = rows.drop(_FILE_PATH).toDF(*names, _FILE_NAME)
    values = [
        F.when(~quoted(c).isin(NA_TOKENS), quoted(c)).alias(c)
        for c in names
        if c.lower() != "source_file"  # replaced by the audit column
    ]
    return renamed.select(*values, F.col(_FILE_NAME).alias("source_file"))
