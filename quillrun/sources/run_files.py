"""Readers for text files and run folders.

``read.text`` has no line numbers. The file, the start of the block within the file
and the running id inside a task give every line a comparable place, so large files
stay splittable.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillrun.functions import formats
from quillrun.functions import text as tx
from quillrun.operators import encoding

# The fields a run description may have, all read as text because
# writers disagree about their types.
META_FIELDS = [
    "job_id", "nnodes", "stages", "dataset", "data_file", "seq_len", "epochs", "batch",
    "accum", "lr", "master_addr", "master_port", "gloo_iface", "status", "wall_seconds",
]
META_NUMBERS = {
    "nnodes": "int", "stages": "int", "seq_len": "int", "epochs": "int", "batch": "int",
    "accum": "int", "lr": "double", "wall_seconds": "bigint",
}


def read_lines(spark: SparkSession, path: str | Sequence[str], sep: str | None = None) -> DataFrame:
    """Lines of text files: ``(file, pos, line)``, blank lines kept.

    CR, LF and CRLF end a line, unless ``sep`` names the only line end. ``pos``
    orders the lines of a file. Undecodable bytes become the replacement character.
    """
    reader = spark.read.option("lineSep", sep) if sep else spark.read
    place = F.struct(
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return reader.text(path if isinstance(path, str) else list(path)).select(
        F.col("_metadata.file_path").alias("file"),
        place.alias("pos"),
        F.make_valid_utf8("value").alias("line"),
    )


def with_line_numbers(lines: DataFrame) -> DataFrame:
    """Add the 0-based number of each line of :func:`read_lines` in its file.

    Lines are counted per block, so no task sees more than one block of a file.
    """
    blocked = lines.withColumn("_block", F.col("pos.block"))
    sizes = blocked.groupBy("file", "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("file").orderBy("_block")
    starts = sizes.select(
        "file", "_block", (F.sum("_n").over(before) - F.col("_n")).alias("_start")
    )
    inside = Window.partitionBy("file", "_block").orderBy("pos")
    return (
        blocked.withColumn("_place", F.row_number().over(inside))
        .join(starts, ["file", "_block"])
        .withColumn("line_no", (F.col("_start") + F.col("_place") - 1).cast("long"))
        .drop("_block", "_start", "_place")
    )


def read_queries(spark: SparkSession, path: str) -> DataFrame:
    """Queries of a file, one per line: ``(query_id, text)`` in line order.

    Ids are places among the lines that are left after trimming.
    """
    ends = rf"^{tx.WHITE_SPACE}|{tx.WHITE_SPACE}$"
    kept = (
        read_lines(spark, path)
        .withColumn("text", F.regexp_replace("line", ends, ""))
        .filter(F.length("text") > 0)
    )
    return with_line_numbers(kept).select(F.col("line_no").alias("query_id"), "text")


def read_corpus(
    spark: SparkSession,
    path: str,
    max_len: int,
    vocab: DataFrame | None = None,
    key: str = "id",
    *,
    fit_terms: int | None = None,
) -> DataFrame:
    """Token table of a path: taken as it is when encoded, else encoded here.

    A Parquet table with ids and mask is used directly; one with ``key`` and ``text``
    is encoded. Anything else is read as one text per line. Texts need either ``vocab``
    or ``fit_terms``, the number of terms of a vocabulary that is fitted on them.
    """
    try:
        texts = spark.read.option("pathGlobFilter", "*.parquet").parquet(path)
        if encoding.is_encoded(texts):
            return texts
    except AnalysisException:  # no Parquet files there
        numbered = with_line_numbers(read_lines(spark, path))
        texts = numbered.select(
            F.concat_ws(":", "file", F.col("line_no").cast("string")).alias(key),
            F.col("line").alias("text"),
        )
    if vocab is None:
        if fit_terms is None:
            raise ValueError("raw texts need a vocabulary, or fit_terms to fit one")
        vocab = encoding.fit_vocab(texts, "text", fit_terms)
    return encoding.encode(texts, vocab, key, "text", max_len)


def _jobs(job: str | Sequence[str]) -> list[str]:
    return [job] if isinstance(job, str) else list(dict.fromkeys(job))


def _glob_of(jobs: list[str]) -> str:
    """One pattern for all jobs; characters that mean something there stand for themselves."""
    plain = [re.sub(r"([\\*?\[\]{},])", r"\\\1", job) for job in jobs]
    return plain[0] if len(plain) == 1 else "{" + ",".join(plain) + "}"


def _job_of(name: Column, pattern: str, jobs: list[str]) -> Column:
    """The jobs whose file this is, one row each."""
    before, after = pattern.split("{job}")
    marks = [before.lstrip("*") + job + after.split("*")[0] for job in jobs]
    whole = "*" not in pattern
    is_of = lambda mark: (name == mark) if whole else F.contains(name, F.lit(mark))
    named = [F.when(is_of(mark), F.lit(job)) for mark, job in zip(marks, jobs, strict=True)]
    return F.explode(F.array_compact(F.array(*named)))


def read_logs(spark: SparkSession, folder: str, job: str | Sequence[str]) -> DataFrame:
    """Log lines of one job or of many, ``(job, file, pos, line)``; no file is an error.

    All jobs are read in one scan; a job of many without files has no lines.
    """
    jobs = _jobs(job)
    pattern = f"{folder.rstrip('/')}/{formats.LOG_FILES.format(job=_glob_of(jobs))}"
    try:
        lines = read_lines(spark, pattern)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        raise FileNotFoundError(f"no log files match {pattern}") from error
    named = lines.withColumn("file", F.substring_index("file", "/", -1))
    of = F.lit(jobs[0]) if len(jobs) == 1 else _job_of(F.col("file"), formats.LOG_FILES, jobs)
    return named.select(of.alias("job"), "file", "pos", "line")


def _read_named(spark: SparkSession, folders: Sequence[str], names: str):
    """Reader over the files of these names in run folders, none being fine."""
    return spark.read.option("pathGlobFilter", names), [f.rstrip("/") for f in folders]


def _plain(path: Column) -> Column:
    """One spelling of a path, however many slashes follow its scheme."""
    return F.regexp_replace(path, r"^([A-Za-z][A-Za-z0-9+.-]*:)/+", "$1/")


def _folder() -> Column:
    return _plain(F.regexp_replace("_metadata.file_path", r"/[^/]*$", ""))


def _run_name(path: Column) -> Column:
    return F.url_decode(F.regexp_replace(F.substring_index(path, "/", -1), r"\+", "%2B"))


def _folder_names(spark: SparkSession, folders: Sequence[str]) -> DataFrame:
    """``(path, run)`` of the folders: the full path, which is the key, and its last name."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    full = []
    for folder in dict.fromkeys(f.rstrip("/") for f in folders):
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        qualified = path.getFileSystem(conf).makeQualified(path)
        full.append((qualified.toUri().toString(),))
    paths = spark.createDataFrame(full, "path string").select(_plain(F.col("path")).alias("path"))
    return paths.withColumn("run", _run_name(F.col("path")))


def read_preflight(spark: SparkSession, folder: str, job: str | Sequence[str]) -> DataFrame:
    """Preflight lines of one job or of many, empty when there is no such file."""
    jobs = _jobs(job)
    names = formats.PREFLIGHT_FILE.format(job=_glob_of(jobs))
    reader, paths = _read_named(spark, [folder], names)
    lines = reader.text(paths).select(
        F.col("_metadata.file_name").alias("file"),
        F.struct(
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("pos"),
        F.make_valid_utf8("value").alias("line"),
    )
    of = F.lit(jobs[0]) if len(jobs) == 1 else _job_of(F.col("file"), formats.PREFLIGHT_FILE, jobs)
    return lines.select(of.alias("job"), "file", "pos", "line")


def read_run_meta(spark: SparkSession, folders: Sequence[str]) -> DataFrame:
    """Run descriptions, one row per folder, with the folder's ``path`` and last name.

    The final description wins over the first one; a broken file falls through, and
    a folder without a usable file gives a row of NULLs. ``others`` holds all keys of
    the description that have no column of their own.
    """
    reader, paths = _read_named(spark, folders, "{" + ",".join(formats.META_FILES) + "}")
    found = (
        reader.text(paths, wholetext=True)
        .select(
            _folder().alias("path"),
            F.col("_metadata.file_name").alias("_name"),
            F.from_json("value", "map<string,string>").alias("_meta"),
        )
        .filter(F.size("_meta") > 0)
    )
    preference = F.array_position(F.array(*[F.lit(n) for n in formats.META_FILES]), F.col("_name"))
    best = found.groupBy("path").agg(F.min_by("_meta", preference).alias("_meta"))
    typed = [
        F.col("_meta")[f].try_cast(META_NUMBERS.get(f, "string")).alias(f) for f in META_FIELDS
    ]
    others = F.map_filter("_meta", lambda k, v: ~k.isin(META_FIELDS)).alias("others")
    known = _folder_names(spark, folders).join(best, "path", "left")
    return known.select("run", *typed, others, "path")


def read_wall(spark: SparkSession, folders: Sequence[str]) -> DataFrame:
    """Wall-clock seconds per run folder, NULL when absent or malformed."""
    reader, paths = _read_named(spark, folders, formats.WALL_FILE)
    content = F.btrim(F.regexp_replace("value", r"\s+", " "))
    found = reader.text(paths, wholetext=True).select(
        _folder().alias("path"), content.try_cast("bigint").alias("wall_seconds")
    )
    known = _folder_names(spark, folders).join(found, "path", "left")
    return known.select("run", "wall_seconds", "path")


def read_timings(spark: SparkSession, folders: Sequence[str]) -> DataFrame:
    """Lines of the timing files of run folders: ``(job, rank, file, line, path)``.

    ``job`` is the folder's last name; ``path`` tells folders of one name apart.
    """
    reader, paths = _read_named(spark, folders, formats.TIMING_FILES)
    name = F.col("_metadata.file_name")
    return reader.text(paths).select(
        _run_name(_folder()).alias("job"),
        F.regexp_extract(name, formats.TIMING_RANK, 1).try_cast("int").alias("rank"),
        name.alias("file"),
        F.make_valid_utf8("value").alias("line"),
        _folder().alias("path"),
    )
