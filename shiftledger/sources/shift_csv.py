"""Shift-log CSV scan with file-order row numbers, split over many tasks per file.

A quoted field may hold line breaks, so where a record starts depends on all text before it,
and Spark's own multi-line CSV reader therefore gives each file to one task. Here a file is
read in pieces between line breaks, in blocks. A first pass counts pieces per block and notes
which are blank, leave a quote open or hold a line break of the other kind:

* files without the last two (the rule): every piece that is not blank is a record, and its number
  is the count of such pieces in earlier blocks plus its place in the block. No row is shuffled.
* other files: the states of ``csv_states`` run through the pieces of each block for both states
  possible at its start, then through the blocks of the file. A window never holds more than one
  block.

Pieces end at LF. A file that holds long runs of CR between two LF, as files do whose records end
in CR, is cut at CR instead; what is read does not hang on the choice.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import uuid_v5
from ..schemas import RAW_SCHEMA, REQUIRED_COLUMNS, SOURCE_COLUMNS
from ..session import dealt, stage
from .csv_states import fields_of, has_break, is_blank, opens, records_of, stays, without_cr
from .files import NO_HEADER, Inputs, check_header, input_files, literal_path

# One row per block, about 400 bytes each as a broadcast table; 128 MB blocks of 100 TB are
# 800,000 rows. Larger tables are joined by shuffle instead.
BROADCAST_BLOCKS = 1_000_000
# fixed value: largest field in characters
FIELD_LIMIT = 131_072
# Bytes of pieces one task sorts by block, each with so many bytes besides its text.
TASK_BYTES = 128 << 20
PIECE_BYTES = 150
#: Lone CRs in one piece from which on a file is cut at CR.
CR_RUN = 1_000

# pieces end at the first, read from the patterns beside it
Cuts = list[tuple[str, list[str]]]


def make_run_id(prefix: str = "records", now: datetime | None = None) -> str:
    """``<prefix>_<UTC time>_<8 hex digits>``."""
    moment = (now or datetime.now(timezone.utc)).astimezone(timezone.utc)
    return f"{prefix}_{moment:%Y%m%dT%H%M%SZ}_{uuid.uuid4().hex[:8]}"


def batch_instant(moment: datetime) -> datetime:
    """Instant of ingestion as it is stored: UTC, whole seconds."""
    return moment.astimezone(timezone.utc).replace(microsecond=0)


def _decoded(name: str) -> Column:
    """A file's path or name as it was given; Spark reports it URL-encoded, with ``+`` for itself."""
    return F.url_decode(F.replace(F.col(name), F.lit("+"), F.lit("%2B")))


def _pieces(spark: SparkSession, inputs: Cuts, blank: bool) -> DataFrame:
    """Pieces of text with file, block start and an id that rises in reading order.

    Without blank ones, ids count the pieces that are not.
    """

    def read(end: str, patterns: list[str]) -> DataFrame:
        text = spark.read.option("lineSep", end).text(patterns)
        return (text if blank else text.where(~is_blank(F.col("value")))).select(
            _decoded("_metadata.file_path").alias("path"),
            _decoded("_metadata.file_name").alias("name"),
            F.col("_metadata.file_block_start").alias("block"),
            F.col("_metadata.file_size").alias("file_size"),
            F.lit(end).alias("end"),
            F.monotonically_increasing_id().alias("mid"),
            F.col("value").alias("piece"),
        )

    return reduce(DataFrame.unionByName, [read(*i) for i in inputs])


def _pin_splits(spark: SparkSession) -> None:
    """Fix the number of splits, so that both passes cut the files alike.

    Spark derives it from the number of cores at the time of planning, which may change
    between two jobs under dynamic allocation.
    """
    setting = "spark.sql.files.minPartitionNum"
    if spark.conf.get(setting, None) is None:
        spark.conf.set(setting, str(spark.sparkContext.defaultParallelism))


def _first_line(piece: Column) -> Column:
    """Text up to the first line break, without a byte-order mark."""
    return F.regexp_extract(piece, "\\A\ufeff?([^\r\n]*+)", 1)


def _block_counts(pieces: DataFrame, usual_header: str) -> DataFrame:
    """First pass: numbers only, so it is a hash aggregation of one row per task and block."""
    piece = F.col("piece")
    header_here = (F.col("block") == 0) & (_first_line(piece) == usual_header)
    crs = F.char_length(piece) - F.char_length(F.replace(piece, F.lit("\r"), F.lit("")))
    return pieces.groupBy("path", "name", "block", "end").agg(
        F.min("mid").alias("first_mid"),
        F.count(F.lit(1)).alias("n_pieces"),
        F.count_if(is_blank(piece)).alias("n_blank"),
        F.count_if(has_break(piece) | opens(piece)).alias("n_irregular"),
        F.max(F.when(has_break(piece), crs).otherwise(0)).alias("most_crs"),
        F.sum(F.octet_length(piece) + 1).alias("n_bytes"),
        F.max("file_size").alias("file_size"),
        F.min(F.when(header_here, F.col("mid"))).alias("usual_mid"),
    )


def _one_form(path: str) -> str:
    """A path however many slashes follow its scheme."""
    return re.sub(r"\A(\w+):/+", r"\1:/", path)


def _counted(spark: SparkSession, given: Inputs, usual: str) -> tuple[DataFrame, Cuts]:
    """Counts of all blocks, staged, and the kind of pieces that each file is cut into."""

    def count(inputs: Cuts) -> DataFrame:
        return stage(_block_counts(_pieces(spark, inputs, blank=True), usual), "csv-blocks")

    inputs: Cuts = [("\n", given.patterns)]
    blocks = count(inputs)
    at_cr = [row.path for row in blocks.where(F.col("most_crs") >= CR_RUN).select("path").distinct().collect()]
    if at_cr:
        turned = {_one_form(path) for path in at_cr}
        rest = [f for f in given.files() if _one_form(re.sub(r"\\(.)", r"\1", f)) not in turned]
        inputs = [i for i in (("\n", rest), ("\r", [literal_path(path) for path in at_cr])) if i[1]]
        blocks = count(inputs)
    return blocks, inputs


def _headers(pieces: DataFrame, blocks: DataFrame, usual_header: str) -> tuple[DataFrame, int]:
    """Per file: its header fields and facts of the first pass, stored; the number of blocks.

    Almost always all files share one header, which the first pass has found by comparison.
    Only where a file has another one is the text read once more for it.
    """
    left = F.max("file_size") - F.sum("n_bytes")
    files = blocks.groupBy("path", "name", "end").agg(
        F.count(F.lit(1)).alias("n_blocks"),
        (F.sum("n_irregular") > 0).alias("irregular"),
        F.sum(F.col("n_bytes") + PIECE_BYTES * F.col("n_pieces")).alias("weight"),
        # a byte-order mark of three bytes is not part of the first piece
        left.isin(0, 3).alias("ended"),
        F.max(F.when(F.col("block") == 0, F.col("first_mid"))).alias("header_mid"),
        F.max(F.when(F.col("block") == 0, F.col("usual_mid"))).alias("usual_mid"),
    )
    usual = F.col("usual_mid").eqNullSafe(F.col("header_mid"))
    counts = files.agg(F.sum("n_blocks").alias("blocks"), F.count_if(~usual).alias("unusual")).first()
    if counts.unusual == 0:
        headed = files.withColumn("header", F.lit(usual_header))
    else:
        unusual = files.where(~usual).select("path", F.col("header_mid").alias("mid"))
        others = stage(
            pieces.where(F.col("block") == 0)
            .join(_bounded(unusual, counts.unusual), ["path", "mid"])
            .select("path", _first_line(F.col("piece")).alias("other")),
            "csv-other-headers",
        )
        headed = files.join(others, "path", "left").withColumn(
            "header", F.coalesce("other", F.lit(usual_header))
        )
    headers = headed.select(
        "path",
        "name",
        "end",
        "irregular",
        "ended",
        "weight",
        "header",
        fields_of(F.col("header")).alias("fields"),
        F.monotonically_increasing_id().alias("file"),
    )
    return stage(headers, "csv-headers"), counts.blocks


def _check_headers(headers: DataFrame, unique_names: bool) -> Row:
    """Apply the header contract to all files and return facts about them.

    One pass counts the offenders; a single one is fetched only to name it in the error.
    """
    required = F.array(*map(F.lit, REQUIRED_COLUMNS))
    known = F.array(*map(F.lit, SOURCE_COLUMNS))
    conditions = {
        "empty": F.col("header") == "",
        "broken": opens(F.col("header")),
        "lacking": F.size(F.array_except(required, "fields")) > 0,
        "extra": F.size(F.array_except("fields", known)) > 0,
    }
    facts = headers.agg(
        *[F.count_if(condition).alias(name) for name, condition in conditions.items()],
        F.bool_or("irregular").alias("any_irregular"),
        F.bool_and("irregular").alias("all_irregular"),
        F.count(F.lit(1)).alias("n_files"),
        F.sum(F.when(F.col("irregular"), F.col("weight"))).alias("weight"),
    ).first()

    def example(name: str) -> Row:
        return headers.where(conditions[name]).first()

    if facts.empty:
        raise ValueError(f"{NO_HEADER} {example('empty').path}")
    if facts.broken:
        raise ValueError(
            f"CSV schema error: header row holds a line break: {example('broken').path}"
        )
    if facts.lacking:
        check_header(example("lacking").fields)
    if facts.extra:
        check_header(example("extra").fields)
    if unique_names and facts.n_files > 1:
        same = headers.groupBy("name").count().where("count > 1").first()
        if same is not None:
            raise ValueError(
                f"several input files are named {same['name']}; pass source_file='path' to tell "
                "them apart by their whole path"
            )
    return facts


def _layout(headers: DataFrame) -> DataFrame:
    """Per file: number of header fields and the position of each column (0 = absent).

    The last of several equal header names counts.
    """
    backwards = F.reverse("fields")

    def position(name: str) -> Column:
        found = F.array_position(backwards, F.lit(name))
        return F.when(found > 0, F.size("fields") - found + 1).otherwise(F.lit(0)).cast("int")

    return headers.select(
        "file",
        "path",
        "name",
        "end",
        "irregular",
        "ended",
        F.size("fields").alias("header_width"),
        F.array(*[position(name) for name in SOURCE_COLUMNS]).alias("positions"),
    )


def _bounded(df: DataFrame, n_rows: int) -> DataFrame:
    return F.broadcast(df) if n_rows <= BROADCAST_BLOCKS else df


def _regular_records(pieces: DataFrame, blocks: DataFrame, files: DataFrame, n: int) -> DataFrame:
    """Every piece that is not blank is a record; its number follows from the counts alone."""
    n_records = F.col("n_pieces") - F.col("n_blank")
    in_file = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # ids count from the start of the task, whose number is in their upper bits
    task = F.shiftright("first_mid", 33)
    in_task = Window.partitionBy("end", task).orderBy("first_mid").rowsBetween(Window.unboundedPreceding, -1)
    counted = blocks.select(
        "path",
        "block",
        n_records.alias("n_records"),
        F.coalesce(F.sum(n_records).over(in_file), F.lit(0)).alias("before"),
        (F.shiftleft(task, 33) + F.coalesce(F.sum(n_records).over(in_task), F.lit(0))).alias("first_id"),
    )
    regular = files.where(~F.col("irregular")).select("path", "header_width", "positions")
    place = F.col("mid") - F.col("first_id")
    moved = F.raise_error(F.lit("the input files changed or were cut differently while being read"))
    checked = F.when((place >= 0) & (place < F.col("n_records")), F.col("before") + place + 1)
    return pieces.join(_bounded(counted.join(regular, "path"), n), ["path", "block"]).select(
        "path",
        "name",
        F.coalesce(checked, moved.cast("bigint")).alias("record_no"),
        without_cr(F.col("piece")).alias("record"),
        "header_width",
        "positions",
    )


def _fold_quote_states(df: DataFrame, opens: str, stays: str, order) -> DataFrame:
    """Add ``_last_set`` and ``_odd`` for a run of elements that change the quote state.

    Every element maps the state before it (outside, inside) to the state after it
    (``opens``, ``stays``): it keeps, flips or sets the state. So the state after an element is
    the last one set, or the state at the start of the run, flipped once for each flip since.
    """
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    outside, inside = F.col(opens), F.col(stays)
    sets = outside == inside
    return (
        df.withColumn("_flips", F.sum((outside & ~inside).cast("int")).over(running))
        .withColumns(
            {
                "_last_set": F.last(F.when(sets, outside), ignorenulls=True).over(running),
                "_flips_then": F.max(F.when(sets, F.col("_flips"))).over(running),
            }
        )
        .withColumn("_odd", (F.col("_flips") - F.coalesce("_flips_then", F.lit(0))) % 2 == 1)
        .drop("_flips", "_flips_then")
    )


def _state_from(start: bool) -> Column:
    return F.coalesce(F.col("_last_set"), F.lit(start)) != F.col("_odd")


def _irregular_records(pieces: DataFrame, files: DataFrame, n: int, limit: int, weight: int) -> DataFrame:
    """Records of files with line breaks in quotes or of another kind.

    Pieces are exchanged and sorted under the number of their file, which is shorter than its path.
    """
    chosen = files.where(F.col("irregular")).drop("irregular")
    in_block = Window.partitionBy("file", "block").orderBy("mid")
    running = in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = (
        pieces.join(_bounded(chosen.select("path", "file"), n), "path")
        .drop("path", "name", "file_size", "end")
        .withColumns({"opens": opens(F.col("piece")), "stays": stays(F.col("piece"))})
    )
    for start, inside in ((0, False), (1, True)):
        begun = F.size(records_of(F.col("piece"), F.lit(inside))) - start
        marked = marked.withColumn(f"own{start}", begun)
    marked = dealt(marked, min(n, -(-weight // TASK_BYTES)), "file", "block")
    marked = _fold_quote_states(marked, "opens", "stays", in_block)
    for start in (0, 1):
        marked = (
            marked.withColumn(f"after{start}", _state_from(bool(start)))
            .withColumn(f"inside{start}", F.lag(f"after{start}", 1, bool(start)).over(in_block))
            .withColumn(f"begun{start}", F.when(F.col(f"inside{start}"), F.col("own1")).otherwise(F.col("own0")))
            .withColumn(f"count{start}", F.sum(f"begun{start}").over(running))
        )
    marked = stage(marked.drop("opens", "stays", "own0", "own1", "_last_set", "_odd"), "csv-pieces")

    in_file = Window.partitionBy("file").orderBy("block")
    earlier = in_file.rowsBetween(Window.unboundedPreceding, -1)
    ends = marked.groupBy("file", "block").agg(
        *[F.max(f"count{s}").alias(f"records{s}") for s in (0, 1)],
        *[F.max_by(f"after{s}", "mid").alias(f"end{s}") for s in (0, 1)],
    )
    placed = (
        _fold_quote_states(ends, "end0", "end1", in_file)
        .withColumn("state", _state_from(False))
        .withColumn("begun", F.lag("state", 1, False).over(in_file))
        .withColumn("own", F.when(F.col("begun"), F.col("records1")).otherwise(F.col("records0")))
        .select(
            "file",
            "block",
            "begun",
            F.coalesce(F.sum("own").over(earlier), F.lit(0)).alias("before"),
        )
        .join(chosen, "file")
    )

    def by_state(name: str) -> Column:
        return F.when(F.col("begun"), F.col(f"{name}1")).otherwise(F.col(f"{name}0"))

    numbered = marked.join(_bounded(placed, n), ["file", "block"]).select(
        "path",
        "name",
        "block",
        "mid",
        by_state("inside").alias("inside"),
        by_state("after").alias("after"),
        (F.col("before") + by_state("count") - by_state("begun")).alias("prior"),
        records_of(F.col("piece"), by_state("inside")).alias("parts"),
        "header_width",
        "positions",
        "end",
        "ended",
    )
    parts = numbered.select(
        "*", F.size("parts").alias("n_parts"), F.posexplode("parts").alias("nth", "part")
    ).select(
        "path",
        "name",
        "block",
        "mid",
        (F.col("prior") + F.col("nth") + F.when(F.col("inside"), 0).otherwise(1)).alias("record_no"),
        (F.col("inside") & (F.col("nth") == 0)).alias("continues"),
        (F.col("after") & (F.col("nth") == F.col("n_parts") - 1)).alias("open"),
        "part",
        "header_width",
        "positions",
        "end",
        "ended",
    )
    whole = ~F.col("continues") & ~F.col("open")
    columns = ("path", "name", "record_no", "record", "header_width", "positions")
    single = parts.where(whole).withColumnRenamed("part", "record").select(*columns)
    broken = parts.where(~whole).withColumn(
        "part", F.when(F.col("continues"), F.substring("part", F.lit(2), F.char_length("part"))).otherwise(F.col("part"))
    )
    _check_record_sizes(broken, limit)
    return single.unionByName(_joined_parts(broken).select(*columns))


def _check_record_sizes(parts: DataFrame, limit: int) -> None:
    """Memory guard: refuse a record too long for its fields, such as the rest of a file after a lone quote.

    No record whose fields keep to the limit is refused: each sign but a quote is one of a field, and
    a quote in a field is two. Summed before anything is collected, so such a record never meets in
    one task.
    """
    width, size = F.col("header_width"), F.char_length("part") + 1
    plain = F.char_length(F.replace("part", F.lit('"'), F.lit(""))) + 1
    long = (
        parts.groupBy("path", "record_no", "header_width")
        .agg(F.sum(size).alias("size"), F.sum(plain).alias("plain"))
        .where((F.col("plain") > width * (limit + 3)) | (F.col("size") > width * (2 * limit + 3)))
        .first()
    )
    if long is not None:
        raise ValueError(
            f"field larger than field limit ({limit}): record {long.record_no - 1} of {long.path}"
        )


def _joined_parts(parts: DataFrame) -> DataFrame:
    """Records that run over several pieces; their size has been checked."""
    ordered = F.sort_array(F.collect_list(F.struct("block", "mid", "part", "open")))
    # at the end of the file a quote may still be open; the last line break is then in the field
    unclosed = F.element_at("parts", -1)["open"]
    last = F.concat(F.when(F.col("ended"), F.col("end")).otherwise(F.lit("")), F.lit('"'))
    return (
        parts.groupBy("path", "name", "record_no", "header_width", "positions", "end", "ended")
        .agg(ordered.alias("parts"))
        .withColumn("texts", F.transform("parts", lambda p: p["part"]))
        .withColumn("text", F.expr("array_join(texts, `end`)"))
        .withColumn("record", F.when(unclosed, F.concat("text", last)).otherwise(F.col("text")))
    )


def _parsed(records: DataFrame, limit: int) -> DataFrame:
    """Source columns by header position: empty text stays empty, an absent field is NULL."""
    fields, found = F.col("fields"), F.size("fields")

    def value(i: int, name: str) -> Column:
        position = F.col("positions")[i]
        return F.when(position > 0, F.get(fields, position - 1)).alias(name)

    row = F.concat((F.col("record_no") - 1).cast("string"), F.lit(" of "), F.col("path"))
    over = (F.char_length("record") > limit) & F.exists(fields, lambda f: F.char_length(f) > limit)

    def stop(what: str) -> Column:
        return F.raise_error(F.concat(F.lit(f"{what}: row "), row)).cast("bigint")

    number = (
        F.when(over, stop(f"field larger than field limit ({limit})"))
        .when(found > F.col("header_width"), stop("CSV row has more fields than the header"))
        .otherwise(F.col("record_no") - 1)
    )
    return (
        records.where(F.col("record_no") > 1)
        .withColumn("fields", fields_of(F.col("record")))
        .select(
            "path",
            "name",
            number.alias("row_number"),
            *[value(i, name) for i, name in enumerate(SOURCE_COLUMNS)],
        )
    )


def scan_shift_logs(
    spark: SparkSession, paths: str | Sequence[str], unique_names: bool = True, field_limit: int = FIELD_LIMIT
) -> DataFrame:
    """Source columns as text with ``path``, ``name`` and file-order ``row_number``.

    A field of more than ``field_limit`` characters is an error, however it is written.
    """
    patterns = [paths] if isinstance(paths, str) else list(paths)
    given = input_files(spark, patterns)
    _pin_splits(spark)
    first = spark.read.option("lineSep", "\n").text(given.first)
    usual_header = first.select(_first_line(F.col("value"))).first()[0]
    blocks, inputs = _counted(spark, given, usual_header)
    pieces = _pieces(spark, inputs, blank=True)
    headers, n_blocks = _headers(pieces, blocks, usual_header)
    facts = _check_headers(headers, unique_names)
    layout = _layout(headers)
    parts = []
    if not facts.all_irregular:
        parts.append(_regular_records(_pieces(spark, inputs, blank=False), blocks, layout, n_blocks))
    if facts.any_irregular:
        parts.append(_irregular_records(pieces, layout, n_blocks, field_limit, facts.weight))
    records = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return _parsed(records, field_limit)


def add_ingest_metadata(
    scanned: DataFrame,
    run_id: str,
    ingested_at: datetime,
    namespace: str | uuid.UUID,
    source_file: str = "name",
) -> DataFrame:
    """The 15 raw columns. The row id is a name-based UUID over run, instant, file and row,
    so it is unique like a random one but the same however often the plan runs."""
    instant = batch_instant(ingested_at)
    text = instant.strftime("%Y-%m-%dT%H:%M:%SZ")
    named = scanned.withColumns(
        {
            "source_file": F.col(source_file),
            "ingested_at": F.lit(text).cast("timestamp"),
            "run_id": F.lit(run_id),
        }
    )
    name = F.concat_ws("|", F.lit(run_id), F.lit(text), F.col("source_file"), F.col("row_number"))
    return named.withColumn("row_id", uuid_v5(namespace, name)).select(*RAW_SCHEMA.names)


def read_shift_logs(
    spark: SparkSession,
    paths: str | Sequence[str],
    namespace: str | uuid.UUID,
    run_id: str | None = None,
    ingested_at: datetime | None = None,
    source_file: str = "name",
    field_limit: int = FIELD_LIMIT,
) -> DataFrame:
    """Read shift-log CSV files into raw records.

    ``paths`` are ``.csv`` files or glob patterns for them. ``source_file`` is the base name of
    the file, or with ``"path"`` its whole path, which is needed where base names repeat.
    """
    if source_file not in ("name", "path"):
        raise ValueError("source_file must be 'name' or 'path'")
    scanned = scan_shift_logs(spark, paths, source_file == "name", field_limit)
    return add_ingest_metadata(
        scanned,
        run_id or make_run_id(),
        ingested_at or datetime.now(timezone.utc),
        namespace,
        source_file,
    )
