"""Ragged trajectory text source.

One text line holds a whole vehicle track: 4 fixed fields (track_id,
vehicle_type, traveled_d, avg_speed) followed by N blocks of 6 fields (lat,
lon, speed, lon_acc, lat_acc, time) -- N differs per line.  The first line of
every file is a header and is dropped unread; blank lines are skipped.

Spark plan: the CSV reader with a separator that never occurs and quoting off
yields one ``line`` column per text line and drops the first line of each file
even when the file is split across tasks.  Tokenising, shape checks, strict
number parsing and the unnest of the blocks are all Catalyst expressions
(split / transform / slice / inline), so every split of every file is parsed
in parallel inside whole-stage codegen, with no Python on the hot path.

Files are UTF-8.  The reader decodes them as ISO-8859-1, one character per byte, so
that nothing is replaced on the way in: only lines that hold other bytes than ASCII
are turned back into bytes and judged by ``is_valid_utf8``.  A line that holds a
genuine U+FFFD is a line like others; a broken byte rejects its line.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinetra.functions.columns import FLOAT_PATTERN, strict_double, strict_int, strip_ws
from kinetra.schemas import POINT_MEASURES

FIXED_FIELDS = 4
BLOCK_FIELDS = 6
DELIMITER = ";"

# Reader options: one column per physical line, header line dropped per file.
_LINE_OPTIONS = {
    "header": "true",
    "sep": "\u0001",
    "quote": "",
    "escape": "",
    "comment": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "nullValue": "\u0002",
    "mode": "PERMISSIVE",
    "encoding": "ISO-8859-1",
    "columnNameOfCorruptRecord": "_whole",
}
# A line that holds the reader's separator fills ``_whole``; its text is kept
# there in full and rejected, never cut.
_LINE_SCHEMA = "line STRING, _whole STRING"

REJECT_TOO_FEW = "too_few_fields"
REJECT_REMAINDER = "bad_remainder"
REJECT_NUMBER = "bad_number"
REJECT_ENCODING = "bad_encoding"
REJECT_SEPARATOR = "control_character"


def read_lines(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Text lines of the ragged files below ``path`` with file lineage.

    Columns: source_file, line, _utf8 (its bytes are valid; else ``line`` has
    U+FFFD for the broken ones), _block_start (byte offset of the split).
    """
    reader = spark.read.schema(_LINE_SCHEMA).options(**_LINE_OPTIONS)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.csv(path)
    return _with_lineage(df)


def read_lines_stream(spark: SparkSession, path: str, glob: str | None = None,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming twin of :func:`read_lines` (new files only, once each).
    Parse each micro-batch with :func:`parse` inside ``foreachBatch``."""
    reader = spark.readStream.schema(_LINE_SCHEMA).options(**_LINE_OPTIONS)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return _with_lineage(reader.csv(path))


def _with_lineage(df: DataFrame) -> DataFrame:
    read = F.coalesce("_whole", "line")
    text = F.encode(read, "ISO-8859-1").cast("string")      # the line's own bytes
    ascii_only = ~read.rlike(r"[^\x00-\x7f]")
    out = df.select(
        F.col("_metadata.file_name").alias("source_file"),
        F.when(ascii_only, read).otherwise(F.make_valid_utf8(text)).alias("line"),
        (ascii_only | F.is_valid_utf8(text)).alias("_utf8"),
        F.col("_metadata.file_block_start").alias("_block_start"),
    )
    # Blank (whitespace-only) lines carry no record; the search ends at the
    # first character that is none.
    return out.filter(F.col("line").rlike(r"(?U)\S"))


def tokenize(lines: DataFrame) -> DataFrame:
    """Add ``fields`` (array<string>): strip the line, drop trailing ';',
    split, strip every field.  Lines of printable ASCII (white space is the
    blank only) are trimmed and split literally, their fields trimmed where
    they are used; other lines take the Unicode patterns first."""
    line = F.col("line")
    literal = F.rtrim(F.rtrim(F.trim(line), F.lit(DELIMITER)))
    body = F.regexp_replace(strip_ws("line"), f"{DELIMITER}+$", "")
    body = F.regexp_replace(body, r"(?U)\s+$", "")
    patterned = F.regexp_replace(body, rf"(?U)\s*{DELIMITER}\s*", DELIMITER)
    return lines.withColumn("fields", F.split(
        F.when(line.rlike(r"[^\x20-\x7e]"), patterned).otherwise(literal), DELIMITER, -1))


def _parse_columns() -> dict[str, Column]:
    f = F.col("fields")
    n = F.size(f)
    n_frames = F.when(n > FIXED_FIELDS, F.floor((n - FIXED_FIELDS) / BLOCK_FIELDS)).otherwise(0)
    tail = F.slice(f, FIXED_FIELDS + 1, F.greatest(n - FIXED_FIELDS, F.lit(0)))
    # Block numbers are cast as one array (codegen'd).  The cast accepts a
    # few Java-only forms (1.0d, 1.5f, 0x1p3) and misses two Python ones
    # (1_000, -nan); all of them need one of a handful of characters, so
    # only lines whose numbers hold such a character take the slow path: a
    # strict regex per field and normalisation before the cast.
    # (The cast itself trims blanks, so plain fields need no trimming.)
    # Lines of usual numbers pass one set of single characters (a range or an
    # alternative in it costs several times the rest of the parsing).
    joined = F.array_join(tail, ";")
    suspicious = joined.rlike(r"[^0123456789.; eE+\-]") & joined.rlike(
        r"[xXpPdD_]|[fF] *(;|$)|[+-][nN]|[\x00-\x1f\x7f]")
    normal = F.transform(tail, lambda x: F.regexp_replace(
        F.regexp_replace(F.trim(x), "(?<=[0-9])_(?=[0-9])", ""), "^[+-]([nN][aA][nN])$", "$1"))
    strict_ok = ~F.exists(tail, lambda x: ~F.trim(x).rlike(FLOAT_PATTERN))
    return {
        "n_fields": n,
        "n_frames": n_frames.cast("int"),
        # get(): NULL instead of an error on lines shorter than the header.
        "track_id": strict_int(F.trim(F.get(f, 0))),
        "vehicle_type": F.trim(F.get(f, 1)),
        "traveled_d": strict_double(F.trim(F.get(f, 2))),
        "avg_speed": strict_double(F.trim(F.get(f, 3))),
        "nums_syntax_ok": F.when(suspicious, strict_ok).otherwise(F.lit(True)),
        "nums": F.when(suspicious, normal).otherwise(tail).try_cast("array<double>"),
    }


def _reject_reason() -> Column:
    n = F.col("n_fields")
    header_bad = (F.col("track_id").isNull() | F.col("traveled_d").isNull()
                  | F.col("avg_speed").isNull())
    nums_bad = ~F.col("nums_syntax_ok") | F.exists(F.col("nums"), lambda x: x.isNull())
    return (F.when(~F.col("_utf8"), REJECT_ENCODING)
            .when(F.col("line").contains(_LINE_OPTIONS["sep"]), REJECT_SEPARATOR)
            .when(n < FIXED_FIELDS, REJECT_TOO_FEW)
            .when((n - FIXED_FIELDS) % BLOCK_FIELDS != 0, REJECT_REMAINDER)
            .when(header_bad | nums_bad, REJECT_NUMBER))


def parse(lines: DataFrame) -> DataFrame:
    """Tokenised and parsed lines: one row per line with ``reject_reason``
    (NULL when the line is good), header fields and the numeric block array."""
    tok = tokenize(lines)
    cols = _parse_columns()
    # _row_in_split (with _block_start) orders lines as in the file.
    parsed = tok.select("*", *[c.alias(k) for k, c in cols.items()],
                        F.monotonically_increasing_id().alias("_row_in_split"))
    return parsed.withColumn("reject_reason", _reject_reason())


# headers / frames / rejects select rows with a conditional ``inline`` (an
# empty array for the other lines) rather than a Filter: Catalyst would push
# a Filter on parsed columns below the parse projection by substituting the
# parse expressions, re-tokenising every line once per use.

def _select_rows(parsed: DataFrame, cond: Column, cols: list) -> DataFrame:
    row = F.struct(*cols)
    return parsed.select(F.inline(F.filter(F.array(row), lambda _: cond)))


def headers(parsed: DataFrame) -> DataFrame:
    """Track headers of good lines (one row per line, file order kept)."""
    return _select_rows(parsed, F.col("reject_reason").isNull(), [
        "source_file", "track_id", "vehicle_type", "traveled_d", "avg_speed",
        "_block_start", "_row_in_split"])


def frames(parsed: DataFrame) -> DataFrame:
    """One row per frame of every good line; frame_idx is zero-based."""
    nums = F.col("nums")

    def frame(i):
        base = i * BLOCK_FIELDS
        return F.struct(F.col("source_file"), F.col("track_id"), F.col("_block_start"),
                        F.col("_row_in_split"), i.alias("frame_idx"),
                        *[nums[base + j].alias(c) for j, c in enumerate(POINT_MEASURES)])

    good = F.col("reject_reason").isNull() & (F.col("n_frames") > 0)
    arr = F.when(good, F.transform(F.sequence(F.lit(0), F.col("n_frames") - 1), frame))
    return parsed.select(F.inline(arr))


def rejects(parsed: DataFrame) -> DataFrame:
    first = F.col("first_field") if "first_field" in parsed.columns else F.trim(F.get("fields", 0))
    return _select_rows(parsed, F.col("reject_reason").isNotNull(), [
        "source_file", "line", first.alias("first_field"), "n_fields",
        "reject_reason", "_block_start", "_row_in_split"])


@dataclass
class RaggedBatch:
    parsed: DataFrame

    @property
    def tracks(self) -> DataFrame:
        return headers(self.parsed)

    @property
    def points(self) -> DataFrame:
        return frames(self.parsed)

    @property
    def rejects(self) -> DataFrame:
        return rejects(self.parsed)

    def slim(self) -> "RaggedBatch":
        """Only what tracks / frames / rejects need (line text kept for
        rejected lines only): the form worth persisting."""
        p = self.parsed
        return RaggedBatch(p.select(
            "source_file", "_block_start", "_row_in_split", "n_fields", "n_frames", "track_id",
            "vehicle_type", "traveled_d", "avg_speed", "nums", "reject_reason",
            F.when(F.col("reject_reason").isNotNull(), F.col("line")).alias("line"),
            F.when(F.col("reject_reason").isNotNull(), F.trim(F.get("fields", 0))).alias("first_field")))

    def drop_failed_files(self) -> "RaggedBatch":
        """Per-file all-or-nothing: a file with any bad line contributes no
        rows (one transaction per file).  The set of bad files is joined with
        ``left_anti``; AQE broadcasts it when it turns out small."""
        bad = self.rejects.select("source_file").distinct()
        return RaggedBatch(self.parsed.join(bad, "source_file", "left_anti"))


def read_ragged(spark: SparkSession, path: str, glob: str | None = None) -> RaggedBatch:
    return RaggedBatch(parse(read_lines(spark, path, glob)))
