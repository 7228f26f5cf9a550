"""Station files -> raw rows, as Spark jobs.

A station file is latin-1 text: a ``KEY:;VALUE`` preamble, one ``;``-separated
header line, then hourly rows.  Every file, whatever its size, is read line by
line by the splittable text source; archive members become the same lines
(``archives``).  Two scans, each with bounded state: the first leaves a row a file
block (``blocks``), which merge into line numbers, headers, preambles and the
state of quotes; the second parses each record once.  Only the distinct header
layouts and metadata keys reach the driver.

Sources: ``<root>/<year>.zip`` archives (members ending ``.csv``) and
``<root>/<year>/**.csv`` folders.  Lines are numbered as the file has them,
from 1, blank ones included.  A record whose quoted cell holds line ends has the
number of its first line; a header stands on one line.
"""

from __future__ import annotations

import re
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meteomart import constants as K
from meteomart.functions import coerce_date, csvtext, na_to_null, normalize_col, parse_hour
from meteomart.functions.text import fold_lower
from meteomart.plans.joins import bounded_broadcast
from meteomart.sources import archives, blocks
from meteomart.sources.blocks import FILE

LISTING = "source_year string, source_file string, path string, archive boolean"
# Line ends beyond \r, \n and \r\n that can occur in latin-1 text; what they cut
# off keeps the line's number.
OTHER_BREAKS = "[\u000b\u000c\u001c\u001d\u001e\u0085]"
CSV_GLOB = "*.[cC][sS][vV]"
LOADED_AT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"
MOST_HEADS = 40_000            # headers and preambles that are broadcast: about 1 KB a file
# Python's str.strip() whitespace within latin-1.
_WS = "[\t\n\u000b\u000c\r\u001c-\u001f \u0085 ]"


class SourceError(RuntimeError):
    """A year's files cannot be loaded."""


def is_source_fault(exc: Exception) -> bool:
    """Whether a year's files are at fault: none, no header, or an archive that is damaged (as a task found it)."""
    return isinstance(exc, SourceError) or re.search(r"\bBadZipFile\b|\bzlib\.error\b", str(exc)) is not None


# ---------------------------------------------------------------------------
# Listing
# ---------------------------------------------------------------------------
def _fs_path(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath, hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    hpath, fs = _fs_path(spark, path)
    return fs.exists(hpath)


def remove(spark: SparkSession, path: str) -> None:
    hpath, fs = _fs_path(spark, path)
    fs.delete(hpath, True)


def _bare(path: Column | str):
    """A path without its scheme, so that file:/x and file:///x are the same."""
    if isinstance(path, str):
        return re.sub("^[A-Za-z][A-Za-z0-9+.-]*:/+", "/", path)
    return F.regexp_replace(path, "^[A-Za-z][A-Za-z0-9+.-]*:/+", "/")


def _folder_prefix(spark: SparkSession, folder: str) -> str:
    hpath, fs = _fs_path(spark, folder)
    return _bare(fs.makeQualified(hpath).toString()) + "/"


_LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
_STATUS_CACHE = "spark.sql.hive.filesourcePartitionFileCacheSize"
# Entries of a year's folder that are read at once: the driver holds some 3 KB for each of their files.
PART_ENTRIES = 20_000
ARCHIVE, NUL = "archive", "\0"


@contextmanager
def _lean_listing(spark: SparkSession) -> Iterator[None]:
    """Folders are listed by a few tasks a core, many folders each (by default every folder is a task), and
    nothing but the reader keeps what was listed."""
    conf = {_LISTING_TASKS: str(4 * spark.sparkContext.defaultParallelism), _STATUS_CACHE: "0"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def parts(spark: SparkSession, root: str, year: int) -> list[str | None]:
    """What a year is read by: all at once (None), or PART_ENTRIES entries of its folder at a time (their
    paths, one text a part), then its archive (ARCHIVE)."""
    folder = f"{root.rstrip('/')}/{int(year)}"
    if not exists(spark, folder):
        return [None]
    sc, (hpath, fs) = spark.sparkContext, _fs_path(spark, folder)
    paths = sc._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(fs.listStatus(hpath))
    n = len(paths)
    if n <= PART_ENTRIES:
        return [None]

    def text(i: int, m: int) -> str:                      # one call a part, not one a path
        some = sc._gateway.new_array(sc._jvm.java.lang.Object, m)
        sc._jvm.java.lang.System.arraycopy(paths, i, some, 0, m)
        return sc._jvm.org.apache.commons.lang3.StringUtils.join(some, NUL)
    found = [text(i, min(n - i, PART_ENTRIES)) for i in range(0, n, PART_ENTRIES)]
    return found + [ARCHIVE] * exists(spark, f"{folder}.zip")


def _entries(part: str) -> list[str]:
    """Paths of a part, for a reader that takes patterns."""
    return [re.sub(r"([*?{}\[\]\\])", r"\\\1", p) for p in part.split(NUL)]


def listing(spark: SparkSession, root: str, year: int, part: str | None = None) -> DataFrame:
    """Files of a year (or of one of its ``parts``), names only: its folder's (nested ones too) and its archive's members."""
    base, text = root.rstrip("/"), str(int(year))
    parts = [spark.createDataFrame([], LISTING)]
    if part != ARCHIVE and exists(spark, f"{base}/{text}"):
        prefix = _folder_prefix(spark, f"{base}/{text}")
        with _lean_listing(spark):
            found = (spark.read.format("binaryFile").option("pathGlobFilter", CSV_GLOB)
                     .option("recursiveFileLookup", "true").load(f"{base}/{text}" if part is None else _entries(part)))
        parts.append(_joined_tasks(found.select("path")).select(
            F.lit(text).alias("source_year"), F.substr(_bare(F.col("path")), F.lit(len(prefix) + 1)).alias("source_file"),
            "path", F.lit(False).alias("archive")))
    if part in (None, ARCHIVE) and exists(spark, f"{base}/{text}.zip"):
        path = f"{base}/{text}.zip"
        try:
            names = [m.name for m in archives.members(spark, path) if m.name.lower().endswith(".csv")]
        except zipfile.BadZipFile as exc:
            raise SourceError(f"BadZipFile: {path}: {exc}") from exc
        parts.append(spark.createDataFrame([(text, n, path, True) for n in names], LISTING))
    if len(parts) == 1:
        raise SourceError(f"no station files for {text} under {root}")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------------------
# Lines: (source_year, source_file, block, mid, sub, line); mid grows by one a line inside a block
# ---------------------------------------------------------------------------
def _split_breaks(df: DataFrame) -> DataFrame:
    return df.select(*FILE, "block", "mid", F.posexplode(F.split("line", OTHER_BREAKS, -1)).alias("sub", "line"))


def _archive_lines(spark: SparkSession, files: DataFrame) -> list[DataFrame]:
    """Lines of the archive members in ``files`` (their names are on the driver, as the directory's are)."""
    wanted: dict[tuple, set] = {}
    for r in files.select("source_year", "path", "source_file").collect():
        wanted.setdefault((r["source_year"], r["path"]), set()).add(r["source_file"])
    out = []
    for (year, path), names in sorted(wanted.items()):                    # one archive a year
        found = [m for m in archives.members(spark, path) if m.name in names]
        out.append(archives.member_lines(spark, path, found).select(
            F.lit(year).alias("source_year"), "source_file", F.lit(0).cast("long").alias("block"), F.col("no").alias("mid"), "line"))
    return out


def _joined_tasks(raw: DataFrame) -> DataFrame:
    """Small files make partitions of a few kilobytes: sixteen are one, while every core has four.

    Partitions are read one after the other, so the lines of a block stay together and in order.
    """
    return raw.coalesce(max(4 * raw.sparkSession.sparkContext.defaultParallelism, raw.rdd.getNumPartitions() // 16))


def _text_lines(spark: SparkSession, folder: str, year: str, paths: list[str] | None, part: str | None = None) -> DataFrame:
    """Lines of the files under ``folder`` (all, those of a ``part``, or ``paths``).

    A block (file split) is read in order by one task, so increasing ids number its lines.
    """
    reader = spark.read.format("text")
    with _lean_listing(spark):
        raw = (reader.option("pathGlobFilter", CSV_GLOB).option("recursiveFileLookup", "true").load(folder if part is None else _entries(part))
               if paths is None else reader.load(paths))
    return _shaped(_joined_tasks(raw).selectExpr("value", *_PLACE), _folder_prefix(spark, folder), year)


_PLACE = ["_metadata.file_path AS path", "_metadata.file_block_start AS block"]


def _shaped(raw: DataFrame, prefix: str, year: str | None) -> DataFrame:
    """Lines with their file's name below ``prefix``; without a year the first folder is one."""
    path = F.url_decode(F.replace(F.col("path"), F.lit("+"), F.lit("%2B")))
    name = F.substr(_bare(path), F.lit(len(prefix) + 1))
    first = F.substring_index(name, "/", 1)
    return raw.select(
        (first if year is None else F.lit(year)).alias("source_year"),
        (F.substr(name, F.length(first) + 2) if year is None else name).alias("source_file"),
        "block", F.monotonically_increasing_id().alias("mid"), F.decode(F.col("value").cast("binary"), "ISO-8859-1").alias("line"))


def line_stream(spark: SparkSession, root: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The lines of station files that appear under ``root``, with their places in the files."""
    reader = (spark.readStream.format("text").option("pathGlobFilter", CSV_GLOB).option("recursiveFileLookup", "true"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(root.rstrip("/")).selectExpr("value", *_PLACE)


def lines_of_batch(batch: DataFrame, root: str) -> DataFrame:
    """Lines of a micro-batch of ``line_stream``, as ``read_lines`` gives them; folders that are no year are left out."""
    lines = _shaped(batch, _folder_prefix(batch.sparkSession, root.rstrip("/")), None)
    return _split_breaks(lines.where(F.col("source_year").rlike("^[0-9]+$")))


def read_lines(spark: SparkSession, root: str, files: DataFrame, year: int, only: bool = False, part: str | None = None) -> DataFrame:
    """Lines of a year's ``files``, those of a block in order.

    With ``only`` the text files among ``files`` are opened by path (new files
    of an incremental load, names only); otherwise the folder is read, or the ``part`` of it that has the ``files``.
    """
    folder, text = f"{root.rstrip('/')}/{int(year)}", str(int(year))
    kinds = {r["archive"]: r["n"] for r in files.groupBy("archive").agg(F.count("*").alias("n")).collect()}
    parts = []
    if kinds.get(False):
        paths = [r["path"] for r in files.where(~F.col("archive")).select("path").collect()] if only else None
        parts.append(_text_lines(spark, folder, text, paths, part))
    if kinds.get(True):
        parts += _archive_lines(spark, files.where("archive"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return _split_breaks(out)


# ---------------------------------------------------------------------------
# Headers and preambles, from the rows of the blocks
# ---------------------------------------------------------------------------
def _strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^{_WS}+|{_WS}+$", "")


def _separators(line: Column) -> Column:
    """Number of ';' in a line, without splitting it."""
    return F.length(line) - F.length(F.replace(line, F.lit(";"), F.lit("")))


def _is_header(line: Column) -> Column:
    """Line with ';' whose 1st normalised field starts 'data' and 2nd has 'hora'.

    Normalising only maps runs of non-alphanumerics to '_', so a normalised
    field contains 'hora' exactly when its folded, lower-cased text does: that
    cheap test (no regex) runs first and rejects data rows.
    """
    has_sep = F.instr(line, ";") > 0
    second_raw = F.when(has_sep, F.substring_index(F.substring_index(line, ";", 2), ";", -1))
    maybe = has_sep & fold_lower(second_raw).contains("hora")
    first = normalize_col(F.substring_index(line, ";", 1))
    return F.when(maybe, first.startswith("data") & normalize_col(second_raw).contains("hora")) \
        .otherwise(F.lit(False))


def summaries(lines: DataFrame) -> DataFrame:
    """One row a block (``blocks.summaries``): a header is named, or at least has enough separators."""
    return blocks.summaries(lines, F.coalesce(_is_header(F.col("line")), F.lit(False)),
                            _separators(F.col("line")) >= K.HEADER_MIN_SEPARATORS)


def structure(summary: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(a row a file, a row a block), both from a written ``summary``.

    Per file: header line, its place (NULL when no rule matches) and the metadata map.
    The header is the first line that reads as one, else the first with enough
    separators.  Metadata comes from the lines before it, among the first 40.
    """
    summary = blocks.numbered(summary)
    found = blocks.headers(summary)
    early = F.filter("early", lambda x: F.col("header").isNull() | (x < F.col("header")))
    info = found.withColumn("entries", _metadata_entries(F.transform(early, lambda x: x["line"])))
    info = (files.select(*FILE).join(info, FILE, "left")
            .select(*FILE, F.col("header.line").alias("header_line"),
                    F.struct(F.col("header.no").alias("no"), F.col("header.sub").alias("sub")).alias("place"),
                    F.size(csvtext.fields(F.col("header.line"))).alias("header_width"),
                    F.coalesce(_entries_to_map(F.col("entries")), F.create_map().cast("map<string,string>")).alias("meta")))
    return info, blocks.with_states(summary, found)


def _metadata_entries(lines: Column) -> Column:
    """``key:value`` lines -> array of (k, v) structs."""
    return F.transform(
        F.filter(lines, lambda l: F.instr(l, ":") > 0),
        lambda l: F.struct(normalize_col(F.substring_index(l, ":", 1)).alias("k"),
                           _strip(F.regexp_extract(l, r"(?s)^[^:]*:(.*)$", 1)).alias("v")))


def _entries_to_map(entries: Column) -> Column:
    """(k, v) entries -> map; a repeated key keeps its last value (dict semantics)."""
    last = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries) + 1),
                                                     lambda x: x["k"] == e["k"]))
    return F.map_from_entries(last)


def resolved_names(header: Column) -> Column:
    """Raw column name of every field of a header line (NULL: the field is dropped).

    Blank names read ``Unnamed: i``, a repeated name gets ``.1``, ``.2``; names are
    normalised; blank and ``unnamed`` ones are dropped.  A canonical name that
    the header lacks goes to its first field with the canonical's prefix; a
    field wanted by several gets the one that the table lists last.
    """
    def let(value: Column, body) -> Column:
        """``body`` of a value that is worked out once."""
        return F.get(F.transform(F.array(value), body), F.lit(0))

    def apart(named: Column) -> Column:
        # How often each name came before: one pass with a map of the names seen.
        start = F.struct(F.create_map().cast("map<string,int>").alias("seen"), F.array().cast("array<string>").alias("out"))

        def add(done: Column, x: Column) -> Column:
            return let(F.coalesce(F.try_element_at(done["seen"], x), F.lit(0)), lambda n: F.struct(
                F.map_concat(F.map_filter(done["seen"], lambda k, _: k != x), F.create_map(x, n + 1)).alias("seen"),
                F.array_append(done["out"], F.when(n > 0, F.concat(x, F.lit("."), n.cast("string"))).otherwise(x)).alias("out")))
        return F.aggregate(named, start, add, lambda done: done["out"])

    def first_with(names: Column, prefix: str) -> Column:
        return F.get(F.filter(names, lambda y: y.startswith(prefix)), F.lit(0))

    def renamed(names: Column) -> Column:
        # For each canonical name the header lacks, the first field with its prefix.
        taken = [F.when(~F.array_contains(F.array_compact(names), canonical), first_with(names, prefix)).alias(canonical)
                 for canonical, prefix in K.CANONICAL_PREFIXES]
        return let(F.struct(*taken), lambda found: F.transform(names, lambda name: F.coalesce(
            *[F.when(found[canonical] == name, canonical) for canonical, _ in reversed(K.CANONICAL_PREFIXES)], name)))
    named = F.transform(csvtext.fields(header), lambda x, i: F.when(x == "", F.concat(F.lit("Unnamed: "), i.cast("string"))).otherwise(x))
    names = F.transform(apart(named), lambda x: let(normalize_col(x), lambda y: F.when((y != "") & ~y.startswith("unnamed"), y)))
    return let(names, renamed)


def resolve_headers(headers: DataFrame) -> dict[str, list[tuple[int, str]]]:
    """Header line -> (field position, raw column name), for the distinct lines of ``headers``."""
    rows = headers.where("header_line IS NOT NULL").select("header_line").distinct() \
        .select("header_line", resolved_names(F.col("header_line")).alias("names")).collect()
    return {r["header_line"]: [(i, n) for i, n in enumerate(r["names"]) if n is not None] for r in rows}


def metadata_keys(files: DataFrame) -> list[str]:
    return sorted(r[0] for r in files.select(F.explode(F.map_keys("meta")).alias("k")).distinct().collect())


# ---------------------------------------------------------------------------
# Rows
# ---------------------------------------------------------------------------
def _layout_lookup(layouts: dict, value_of) -> Column:
    """A constant map header_line -> value, looked up with the row's header."""
    items = [(line, value_of(cols)) for line, cols in layouts.items()]
    items = [(k, v) for k, v in items if v is not None]
    if not items:
        return F.lit(None)
    m = F.create_map(*[x for k, v in items for x in (F.lit(k), F.lit(v))])
    return F.try_element_at(m, F.col("header_line"))


def parsed_records(lines: DataFrame, files: DataFrame, places: DataFrame) -> DataFrame:
    """Records after the header with their file's header and fields, each parsed once.

    ``places`` has a row a block.  In special blocks quotes join lines into records;
    in all others every line is one.  A record with more fields than its header is ``extra``.
    """
    heads = bounded_broadcast(files.where("header_line IS NOT NULL").select(*FILE, "header_line", "header_width", "place", "meta"), MOST_HEADS)
    numbered = (lines.join(bounded_broadcast(places), [*FILE, "block"])
                .withColumn("no", F.col("base") + F.col("mid") - F.col("first"))
                .join(heads, FILE).where(F.struct("no", "sub") > F.col("place")))
    wanted = [*FILE, "no", "line", "header_line", "header_width", "meta"]
    data = numbered.where(~F.col("special")).select(*wanted)
    if places.where("special").limit(1).count():
        data = data.unionByName(blocks.records(numbered.where("special")).join(heads, FILE).select(*wanted))
    return (data.where(F.col("line") != "").withColumn("fields", csvtext.fields(F.col("line")))
            .withColumn("extra", F.size("fields") > F.col("header_width")))


def station_rows(lines: DataFrame, files: DataFrame, places: DataFrame, layouts: dict, meta_keys: list[str],
                 loaded_at: Column | None = None, load_id: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Lines -> all-text raw rows; returns (rows, quarantine).

    Rows with more fields than their header are quarantined instead of failing
    the whole year; blank lines are skipped.
    """
    parsed = parsed_records(lines, files, places)
    number = (F.col("no") + 1).alias("line_no")
    quarantine = parsed.where("extra").select(*FILE, number, "line")
    good = parsed.where(~F.col("extra"))

    # Target columns: union of every layout's names, in first-seen order.
    targets = list(dict.fromkeys(name for cols in layouts.values() for _, name in cols))

    def pick(name):
        where = {next((i for i, c in cols if c == name), None) for cols in layouts.values()}
        if len(where) == 1 and None not in where:
            # every layout has the column at the same position: plain field access
            return na_to_null(F.get(F.col("fields"), F.lit(where.pop())))
        pos = _layout_lookup(layouts, lambda cols: next((i for i, c in cols if c == name), None))
        return na_to_null(F.get(F.col("fields"), pos.cast("int")))

    out_cols = [(coerce_date(pick(n)) if n == "data" else pick(n)).alias(n) for n in targets if n != "hora_referencia"]
    # The hour column is chosen by the file's header, not by the cell value.
    hour = F.lit(None).cast("string")
    for name in ("hora", "hora_utc"):            # hora_utc is asked first
        if name in targets:
            has = _layout_lookup(layouts, lambda cols, n=name: any(c == n for _, c in cols) or None)
            hour = F.when(has.isNotNull(), parse_hour(pick(name))).otherwise(hour)
    out_cols.append(hour.alias("hora_referencia"))
    out_cols += [F.try_element_at(F.col("meta"), F.lit(k)).alias(f"meta_{k}") for k in meta_keys]
    ts = loaded_at if loaded_at is not None else F.date_format(F.current_timestamp(), LOADED_AT)
    out_cols += [F.col("source_file"), F.col("source_year"), ts.alias("loaded_at"),
                 (F.col("no") + 1).cast("string").alias("line_no")]
    if load_id is not None:
        out_cols.append(F.lit(load_id).alias("load_id"))
    return good.select(*out_cols), quarantine
