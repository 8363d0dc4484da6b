"""J1 ingest_transactions: messy CSV files -> all-string DataFrame.

* every column is text (no inference); leading / trailing spaces are data;
  Spark reads an empty field as NULL, so ``keep_empty=True`` (default) turns
  NULL text back into ``''`` (a short row's missing fields too); every
  cleaning stage treats NULL and ``''`` alike anyway
* one distributed pass over the lines finds, per file, its header, whether it
  is valid UTF-8 (else it is read as Latin-1) and whether quoted fields hold
  newlines.  Every file is read in splits, whatever its size: those with
  newlines in quotes are cut at true record starts (``csv_records``).  A quote
  inside a text (``5" pipe``) opens nothing; a file whose last quoted field
  never closes is read line by line
* the driver gets the distinct headers; facts about files stay in a table that
  is joined by file name (broadcast up to FEW_FILES files).  ``encoding`` and
  ``multi_line``, where given, hold for every file; encodings must contain ASCII
* every file is read by its own header (its first line that is not blank);
  files are put together by column name, a column that a file lacks is NULL
  there (``''`` with ``keep_empty``).  Of columns whose names differ in case
  only, the one in lower case (else the first) keeps its name; the others get
  ``_1``, ``_2``, ... (as do columns with the names of RESERVED).  An unnamed column is called by its place
* a BOM is stripped from the column names; blank lines between records are skipped
* a row with more fields than its header has, however empty they are, is
  long.  ``on_long_rows="error"`` (default) makes the job fail when it meets
  one, ``"drop"`` leaves them out (``quarantined_rows`` returns them),
  ``"keep"`` adds ``_long_row`` and ``_raw_row``, the row as it was
* ``sample=n`` is the first n rows in order of file name and place; 0,
  negative or None means all rows.  Files are opened in that order until n
  rows are there, and of each only its first lines; a sample judges encoding
  and quotes by what it reads
* a missing path raises ``ValueError``; a header-only file gives 0 rows
"""

from __future__ import annotations

import codecs
import csv
import re
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.text import is_ascii
from ledgerloom.sources import csv_records

RAW = "_raw_row"
FILE, START, PLACE = "_file", "_split_start", "_place"
RESERVED = {RAW, "_long_row", FILE, START, PLACE}
#: Files, and splits of files with newlines in quotes, whose facts are broadcast (about 200 bytes each).
FEW_FILES = 100_000
#: Largest sample whose lines are taken to the driver, as ``df.take`` does.
SMALL_SAMPLE = 100_000
#: Never a character of a Latin-1 text: lines are read as CSV of one column, which drops each file's header.
NO_SEPARATOR = "\uffff"
UTF8, LATIN1 = "utf-8", "iso8859-1"


def _paths(paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def _check_exists(spark: SparkSession, paths: list[str]) -> None:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        fs = hp.getFileSystem(conf)
        if not fs.exists(hp) and not fs.globStatus(hp):
            raise ValueError(f"Input file not found: {p}")


def _plain_path(uri: str) -> str:
    """A file's URI as a path for readers, which take patterns: nothing in it is one."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(uri))


def _encoding(name: str | None) -> str | None:
    """Python's name of an encoding in which ASCII stays ASCII."""
    if name is None:
        return None
    found = codecs.lookup(name).name
    if "a,\"\n".encode(found) != b'a,"\n':
        raise ValueError(f"{name}: lines can only be found in encodings that contain ASCII")
    return found


def columns_of(head: str) -> list[str]:
    """Distinct column names of a header line."""
    names = [name or f"_c{i}" for i, name in enumerate(next(csv.reader([head.strip("\ufeff")]), []))]
    keeper = {}
    for i, name in enumerate(names):
        held = keeper.setdefault(name.lower(), i)
        if name == name.lower() != names[held]:
            keeper[name.lower()] = i
    taken, out = {name.lower() for name in names}, []
    for i, name in enumerate(names):
        n = 0
        while (keeper.get(name.lower()) != i or name.lower() in RESERVED) and (n == 0 or new.lower() in taken):
            n += 1
            new = f"{name}_{n}"
        out.append(new if n else name)
        taken.add(out[-1].lower())
    return out


# --------------------------------------------------------------------------- facts about files
def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, start, value): the lines of every split, in order."""
    return spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def _few(df: DataFrame) -> bool:
    return df.limit(FEW_FILES + 1).count() <= FEW_FILES


class _Files:
    """Per file: ``kind`` (which header), ``utf8`` and ``spans`` (newlines in quotes)."""

    def __init__(self, spark: SparkSession, paths: list[str], encoding: str | None, multi_line: bool | None):
        lines = _lines(spark, paths).withColumn("id", F.monotonically_increasing_id())
        head = F.min_by("value", F.when((F.col("start") == 0) & (F.trim("value") != ""), F.col("id")))
        spans = F.max(csv_records.ends_open(F.col("value"))) if multi_line is None else F.lit(multi_line)
        utf8 = F.min(F.is_valid_utf8("value")) if encoding is None else F.lit(encoding == UTF8)
        files = lines.groupBy("file").agg(head.cast("binary").alias("head"), utf8.alias("utf8"), spans.alias("spans"))
        self.encoding, self.paths, self.spark = encoding, paths, spark
        self.files = files.where("head IS NOT NULL").cache()
        found = sorted(self.files.select("head", "utf8").distinct().collect(), key=lambda r: (bytes(r["head"]), r["utf8"]))  # the distinct headers
        self.kinds = [(bytes(r["head"]), r["utf8"], columns_of(bytes(r["head"]).decode(encoding or (UTF8 if r["utf8"] else LATIN1), "replace"))) for r in found]
        self.any_spans = self.files.where("spans").limit(1).count() > 0
        self.states = None
        if self.any_spans:
            quoted = self.tell_file(_lines(spark, paths), ["spans"]).where("spans").select("file", "start", F.col("value").cast("binary").alias("line"))
            self.states = csv_records.split_states(quoted).cache()
            open_end = self.states.where("NOT closed").select("file").distinct().withColumn("endless", F.lit(True))
            self.files = self.files.join(open_end, "file", "left").withColumn("spans", F.col("spans") & F.col("endless").isNull()).drop("endless").cache()
        self.one_kind = len(self.kinds) == 1 and not self.any_spans

    def tell_file(self, df: DataFrame, facts: list[str]) -> DataFrame:
        """``df`` (file) with facts of its file."""
        own = self.files.select("file", *facts)
        return df.join(F.broadcast(own) if _few(own) else own, "file")

    def kind(self) -> Column:
        out = F.when(F.lit(False), 0)
        for k, (head, utf8, _) in enumerate(self.kinds):
            out = out.when((F.col("head") == F.lit(head)) & (F.col("utf8") == F.lit(utf8)), k)
        return out


# --------------------------------------------------------------------------- records
def _plain_records(files: _Files) -> DataFrame:
    """(file, start, place, kind, record): the lines of files in which every line is a record."""
    spark = files.spark
    df = (
        spark.read.schema("value string")
        .option("header", True).option("enforceSchema", True)
        .option("encoding", "ISO-8859-1").option("sep", NO_SEPARATOR).option("quote", "")
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(files.paths)
    )
    df = df.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("place"), "value")
    if files.one_kind:
        df = df.withColumn("kind", F.lit(0)).withColumn("utf8", F.lit(files.kinds[0][1]))
    else:
        df = files.tell_file(df, ["utf8", "spans", "head"]).where("NOT spans").withColumn("kind", files.kind())
    as_bytes = F.encode("value", "ISO-8859-1")  # every byte came in as one character
    text = F.when(is_ascii(F.col("value")), F.col("value")).when(F.col("utf8"), F.make_valid_utf8(as_bytes.cast("string"))).otherwise(F.col("value"))
    return df.select("file", "start", "place", "kind", text.alias("record"))


def _cut_records(files: _Files) -> DataFrame:
    """The same for files with newlines in quotes."""
    lines = files.tell_file(_lines(files.spark, files.paths), ["spans"]).where("spans").select("file", "start", F.col("value").cast("binary").alias("line"))
    records = csv_records.join_pieces(csv_records.cut_records(lines, files.states, _few(files.states)))
    records = files.tell_file(records, ["utf8", "head"]).withColumn("kind", files.kind())
    raw = F.col("record").cast("string")
    if files.encoding in (None, UTF8, LATIN1):
        text = F.when(F.col("utf8"), F.make_valid_utf8(raw)).otherwise(F.decode("record", "ISO-8859-1"))
    else:
        text = _decoder(files.encoding)("record")
    return records.select("file", "start", "place", "kind", text.alias("record"))


def _decoder(encoding: str):
    @F.pandas_udf("string")
    def decode(s: pd.Series) -> pd.Series:
        return s.map(lambda b: bytes(b).decode(encoding, "replace"))

    return decode


def _parsed(records: DataFrame, kinds: list[list[str]]) -> DataFrame:
    """Records -> the columns of all kinds of files, with RAW, ``_long_row`` and the place of each row."""
    options = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "raw", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    parsed, where = [], {}
    for k, names in enumerate(kinds):
        schema = ", ".join([*(f"c{i} string" for i in range(len(names))), "raw string"])
        parsed.append(F.when(F.col("kind") == k, F.from_csv("record", schema, options)).alias(f"p{k}"))
        for i, name in enumerate(names):
            where.setdefault(name.lower(), (name, []))[1].append(F.col(f"p{k}.c{i}"))
    df = records.select(*(F.col(c) for c in ("file", "start", "place", "kind", "record")), *parsed)
    long_row = F.lit(False)
    for k, names in enumerate(kinds):
        more = F.col(f"p{k}.raw").isNotNull() & (csv_records.n_fields(F.col("record")) > len(names))
        long_row = F.when(F.col("kind") == k, F.coalesce(more, F.lit(False))).otherwise(long_row)
    columns = [F.coalesce(*found).alias(name) for name, found in where.values()]
    return df.select(
        *columns, F.col("record").alias(RAW), long_row.alias("_long_row"), F.col("file").alias(FILE), F.col("start").alias(START), F.col("place").alias(PLACE)
    )


def _rows(spark: SparkSession, paths, encoding: str | None, multi_line: bool | None) -> DataFrame:
    """All rows of all files, with RAW, ``_long_row`` and the place of each row."""
    paths, encoding = _paths(paths), _encoding(encoding)
    _check_exists(spark, paths)
    if encoding not in (None, UTF8, LATIN1):
        multi_line = True  # decoded where records are cut
    files = _Files(spark, paths, encoding, multi_line)
    if not files.kinds:
        return spark.createDataFrame([], f"{RAW} string, _long_row boolean, {FILE} string, {START} long, {PLACE} long")
    records = _plain_records(files)
    if files.any_spans:
        records = records.unionByName(_cut_records(files))
    return _parsed(records, [names for *_, names in files.kinds])


# --------------------------------------------------------------------------- ordered samples
def _first_records(spark: SparkSession, file: str, n: int, encoding: str | None, multi_line: bool | None, drop_long: bool):
    """Of one file: (header line, utf8, its first n records after the header), from as few lines as hold them."""
    path, want = _plain_path(file), n + 2
    while True:
        lines = [bytes(r[0]) for r in spark.read.text(path).select(F.col("value").cast("binary")).take(want)]
        done = len(lines) < want
        records, still_open = csv_records.records_of(lines) if multi_line is not False else ([x for x in lines if x.strip()], False)
        if still_open and done:  # a quote that never closes: line by line
            records = [x for x in lines if x.strip()]
        utf8 = encoding == UTF8
        if encoding is None:
            try:
                b"\n".join(lines).decode(UTF8)
                utf8 = True
            except UnicodeDecodeError:
                utf8 = False
        how = encoding or (UTF8 if utf8 else LATIN1)
        texts = [r.decode(how, "replace") for r in records]
        if not texts:
            if done:
                return None
            want *= 4
            continue
        width = len(columns_of(texts[0]))
        rows = [t for t in texts[1:] if not (drop_long and csv_records.field_count(t) > width)]
        if done or len(rows) >= n:
            return texts[0], rows[:n]
        want *= 4


def _sample(spark: SparkSession, paths, n: int, encoding: str | None, multi_line: bool | None, drop_long: bool) -> DataFrame:
    paths, encoding = _paths(paths), _encoding(encoding)
    _check_exists(spark, paths)
    names = sorted(spark.read.text(paths).inputFiles(), key=unquote)  # Spark's own listing; nothing is read
    if n > SMALL_SAMPLE:
        chosen, rows, take = [], 0, 1
        while rows < n and len(chosen) < len(names):
            more = [_plain_path(f) for f in names[len(chosen) : len(chosen) + take]]
            counted = _rows(spark, more, encoding, multi_line)
            rows += (counted.where("NOT _long_row") if drop_long else counted).count()
            chosen, take = chosen + more, take * 2
        df = _rows(spark, chosen, encoding, multi_line)
        df = df.where("NOT _long_row") if drop_long else df
        name = F.try_url_decode(F.replace(FILE, F.lit("+"), F.lit("%2B")))
        return df.orderBy(name, START, PLACE).limit(n)
    found, heads = [], {}
    for file in names:
        if len(found) >= n:
            break
        first = _first_records(spark, file, n - len(found), encoding, multi_line, drop_long)
        if first:
            kind = heads.setdefault(first[0], len(heads))
            found += [(file, 0, len(found) + i, kind, record) for i, record in enumerate(first[1])]
    records = spark.createDataFrame(found, "file string, start long, place long, kind int, record string").coalesce(1)
    return _parsed(records, [columns_of(h) for h in heads]).orderBy(PLACE)


# --------------------------------------------------------------------------- the job
def read_transactions(
    spark: SparkSession,
    paths,
    *,
    sample: int | None = None,
    encoding: str | None = None,
    multi_line: bool | None = None,
    on_long_rows: str = "error",
    keep_empty: bool = True,
) -> DataFrame:
    """Read transaction CSV file(s); see the module for the rules."""
    if sample is not None and sample > 0:
        df = _sample(spark, paths, int(sample), encoding, multi_line, on_long_rows == "drop")
    else:
        df = _rows(spark, paths, encoding, multi_line)
    cols = [c for c in df.columns if c not in (RAW, FILE, START, PLACE, "_long_row")]
    if on_long_rows == "drop":
        df = df.where("NOT _long_row")
    if keep_empty:
        df = df.select(*(F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) if c in cols else F.col(c) for c in df.columns))
    named = [F.col(f"`{c}`") for c in cols]
    if on_long_rows == "keep":
        return df.select(*named, "_long_row", F.when(F.col("_long_row"), F.col(RAW)).alias(RAW))
    if on_long_rows == "error" and cols:
        failed = F.raise_error(F.concat(F.lit("row has more fields than its header: "), F.col(RAW)))
        named[0] = F.when(F.col("_long_row"), failed.cast("string")).otherwise(named[0]).alias(cols[0])
    return df.select(*named)


def quarantined_rows(spark: SparkSession, paths, *, encoding: str | None = None, multi_line: bool | None = None) -> DataFrame:
    """``file, raw, fields``: the long rows that ``on_long_rows="drop"`` leaves
    out, with the fields that have a column."""
    return _quarantine(_rows(spark, paths, encoding, multi_line).where("_long_row"))


def _quarantine(df: DataFrame) -> DataFrame:
    cols = [F.col(f"`{c}`") for c in df.columns if c not in (RAW, FILE, START, PLACE, "_long_row")]
    fields = F.array(*cols).cast("array<string>")
    return df.select(F.col(FILE).alias("file"), F.col(RAW).alias("raw"), fields.alias("fields"))


def preview(df: DataFrame, n: int = 3, clean: bool = False) -> DataFrame:
    """First ``n`` rows (negative -> 0); with ``clean`` only the date and
    amount columns before / after cleaning."""
    from ledgerloom.plans.pipeline import clean_transactions

    n = max(0, int(n))
    if clean:
        if "date" in df.columns and "amount" in df.columns:
            df = clean_transactions(df).select("date", "date_iso", "amount", "amount_decimal", "currency", "issues")
        elif "date" in df.columns:
            df = clean_transactions(df).select("date", "date_iso")
    return df.limit(n)
