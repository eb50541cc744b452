"""Incremental runs with Structured Streaming (available-now triggers).

* Sizing/scoring new inputs only: a file stream source remembers which files
  it has processed in its checkpoint, so a rerun picks up only new files; the
  per-document work is stateless per micro-batch.
* Latest quality entry per (version, talk_id): a streaming ``max_by``
  aggregate in update mode, written as an append-only changelog.  Log lines
  carry no event time, so there is no watermark: state is bounded by the
  number of keys, not by time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import make_valid_utf8, universal_newlines
from ..operators.corpus import with_token_sizes
from ..session import scratch_path


def text_file_stream(spark: SparkSession, directory: str, ext: str = ".txt") -> DataFrame:
    """Whole-text file stream: (path, text), one row per new file, sub-folders
    included; text as the batch reader gives it (line breaks, invalid UTF-8)."""
    df = (spark.readStream.format("text").option("wholetext", True).option("pathGlobFilter", f"*{ext}")
          .option("recursiveFileLookup", True).load(directory))
    return df.select(F.col("_metadata.file_path").alias("path"), universal_newlines(make_valid_utf8("value")).alias("text"))


def parquet_stream(spark: SparkSession, path: str, like: DataFrame, max_files: int | None = None) -> DataFrame:
    """Parquet file stream over ``path`` (a folder of part files whatever its name, or one file named inside its folder)."""
    r = spark.readStream.schema(like.schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at).isFile():
        folder, _, name = path.rstrip("/").rpartition("/")
        return r.option("pathGlobFilter", name).parquet(folder)
    return r.parquet(path)


def start_token_sizes(sized_stream: DataFrame, sink: str, checkpoint: str) -> StreamingQuery:
    """Append (doc key, words, tokens) for every new document, available-now."""
    return (sized_stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(availableNow=True).start(sink))


def start_latest_entries(log_stream: DataFrame, sink: str, checkpoint: str,
                         order_cols: tuple[str, ...] = ("path_ordinal", "line")) -> StreamingQuery:
    """Keyed latest entry as an append-only changelog.

    Update mode emits, per micro-batch, only the keys whose aggregate changed
    (with their full current state); each batch is a partition ``batch_id=N`` of
    its own, so a batch writes work proportional to what changed and one that is
    repeated replaces itself.  :func:`read_latest` keeps the newest row per key,
    :func:`compact_latest` folds old batches into a snapshot.
    """
    keep = [c for c in ("status", "likeness", "selected_file", *order_cols) if c in log_stream.columns]
    agg = log_stream.groupBy("model_version", "talk_id").agg(
        F.max_by(F.struct(*keep), F.struct(*[F.col(c) for c in order_cols])).alias("e"),
        F.count(F.lit(1)).alias("n_entries"))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.select("model_version", "talk_id", "e.*", "n_entries").write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    return (agg.writeStream.outputMode("update").foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def _names(spark: SparkSession, folder: str, prefix: str) -> list[tuple[int, str]]:
    """(number, path) of the sub-folders ``prefix<number>``, in order; none where the folder is missing."""
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [f.getPath().getName() for f in files.listStatus(at)] if files.exists(at) else []
    return sorted((int(n[len(prefix):]), f"{folder}/{n}") for n in found if n.startswith(prefix))


def _base(spark: SparkSession, sink: str) -> tuple[int, str] | None:
    """The newest whole snapshot: (last batch in it, path).  One without its success marker was never finished."""
    for number, path in reversed(_names(spark, f"{sink}/_bases", "upto=")):
        marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        if marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker):
            return number, path
    return None


def read_latest(spark: SparkSession, sink: str) -> DataFrame:
    """Current state: the newest row per key of the last snapshot and the batches after it."""
    base = _base(spark, sink)
    batches = [path for number, path in _names(spark, sink, "batch_id=") if base is None or number > base[0]]
    parts = [spark.read.parquet(base[1])] if base else []
    if batches:
        log = spark.read.option("basePath", sink).parquet(*batches)
        parts.append(log.withColumn("batch_id", F.col("batch_id").cast("long")))
    log = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    cols = [c for c in log.columns if c not in ("model_version", "talk_id", "batch_id")]
    return (log.groupBy("model_version", "talk_id")
            .agg(F.max_by(F.struct(*cols, "batch_id"), F.col("batch_id")).alias("s"))
            .select("model_version", "talk_id", "s.*")).drop("batch_id")


def compact_latest(spark: SparkSession, sink: str) -> int | None:
    """Fold all batches so far into one snapshot; returns the last batch in it.

    The snapshot counts from the moment its success marker is written; before, readers
    use the old one and the batches, after, this one.  Batches and snapshots that it
    replaces are deleted last, so a crash at any point changes no result.
    """
    batches, base = _names(spark, sink, "batch_id="), _base(spark, sink)
    last = max([n for n, _ in batches] + ([base[0]] if base else []), default=None)
    if last is not None and (base is None or last > base[0]):
        state = read_latest(spark, sink).withColumn("batch_id", F.lit(last).cast("long"))
        state.write.mode("overwrite").parquet(f"{sink}/_bases/upto={last}")
    for number, path in [*batches, *_names(spark, f"{sink}/_bases", "upto=")]:
        if number < last or number == last and "batch_id=" in path:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return last


def run_dir(spark: SparkSession, name: str) -> tuple[str, str]:
    base = scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")
    return base + "/out", base + "/_checkpoint"


def incremental_token_sizes(spark: SparkSession, documents_path: str) -> DataFrame:
    """Stream the documents table through the sizing step; return the sink table."""
    static = spark.read.parquet(documents_path)
    stream = parquet_stream(spark, documents_path, static)
    sized = with_token_sizes(stream).select("doc_id", "words", "tokens")
    out, ckpt = run_dir(spark, "token-sizes")
    start_token_sizes(sized, out, ckpt).awaitTermination()
    return spark.read.parquet(out)


def incremental_edit_scores(spark: SparkSession, documents_path: str) -> DataFrame:
    """Stream documents, score each against its edit (exact,
    stateless per micro-batch), append to a sink; return the sink table.

    Each micro-batch is dealt to tasks by cost: a streamed file can arrive as
    one task, and one exact alignment costs far more than moving its text.
    """
    from ..operators.scoring import score_pairs
    from ..sources.tables import inserting_edit

    static = spark.read.parquet(documents_path)
    stream = parquet_stream(spark, documents_path, static)
    pairs = stream.select(F.col("doc_id").cast("string").alias("pair_id"), F.col("text").alias("a_text"),
                          inserting_edit("text").alias("b_text"))
    scored = score_pairs(pairs, spread=True).select("pair_id", "likeness")
    out, ckpt = run_dir(spark, "edit-scores")
    (scored.writeStream.format("parquet").option("checkpointLocation", ckpt).outputMode("append")
     .trigger(availableNow=True).start(out).awaitTermination())
    return spark.read.parquet(out)


def start_incremental_transform(
    spark: SparkSession,
    input_dir: str,
    output_path: str,
    checkpoint: str,
    fn_factory,
    input_root: str | None = None,
    output_root: str = "cleaned",
    ext: str = ".txt",
    retries: int = 0,
) -> StreamingQuery:
    """Transform only files not seen before: the file source's checkpoint is the
    "already produced" memory, each micro-batch runs the batch harness
    (unwrap, blank short-circuit, callable with retries) and appends the
    transform log with the output texts."""
    from ..functions.text import make_valid_utf8
    from ..operators.transform import apply_transform, pending_inputs

    stream = text_file_stream(spark, input_dir, ext)
    stream = stream.select(F.regexp_replace("path", "^file:(//)?(?=/)", "").alias("path"),
                           make_valid_utf8("text").alias("text"))
    root = (input_root or input_dir).rstrip("/")
    log = apply_transform(pending_inputs(stream, root, output_root, ext), fn_factory, retries)
    return (log.writeStream.format("parquet").option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(availableNow=True).start(output_path))


def start_incremental_runs(
    spark: SparkSession,
    input_dir: str,
    out_dir: str,
    checkpoint: str,
    fn_factory,
    input_root: str | None = None,
    output_root: str = "cleaned",
    ext: str = ".txt",
    retries: int = 0,
) -> StreamingQuery:
    """Transform files not seen before, each micro-batch a run in the ledger of
    :mod:`..operators.runs`: ``current_outputs`` and the totals of a run read as
    after a batch run.  A batch that is repeated after a crash replaces what it
    left unless it was committed, so no document counts twice."""
    from ..operators import runs
    from ..operators.transform import apply_transform, pending_inputs

    stream = text_file_stream(spark, input_dir, ext).withColumn("path", F.regexp_replace("path", "^file:(//)?(?=/)", ""))
    root = (input_root or input_dir).rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        run_id = f"batch-{batch_id:08d}"
        if not runs.is_committed(batch.sparkSession, out_dir, run_id):
            runs.write_run(apply_transform(pending_inputs(batch, root, output_root, ext), fn_factory, retries), out_dir, run_id)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
