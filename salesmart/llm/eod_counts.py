"""Operator 10, token counts of flat unindexed token files by a separator scan.

A flat file is nothing but token ids, two bytes little-endian each, and an end-of-document id after
every document; there is no index.  ``scan`` reads files through Spark, cuts each into blocks of
``BLOCK`` ids regardless of documents, and searches each block for the separator with vectorised
comparisons.  A block reports how many ids and separators it has, how many ids precede its first and
follow its last separator, and the lengths in between.  Documents that straddle blocks are stitched
by prefix scans over a file's block summaries (a running maximum of the last separator's place, a
running sum of separators): window functions over one small row per block.

``write`` makes such files from a document table: whole texts are encoded with a public sentencepiece
vocabulary whose end id (2) text never yields, and Spark's text writer ends every record with that id's
two bytes, so files are written by Spark's own committers to any store.  A file's part number and a
document's ordinal in it are the partition and position of the document in the scan, which is how
counts find their doc_id again; documents per file are checked against separators found.

Edge cases: null and empty texts are documents of no tokens; empty tables write no files and count
nothing; ids after a file's last separator form one unfinished document, reported with
``ended`` false; repeated rows are documents of their own; a file must have an even number of bytes.
Files are read whole by tasks, so they must stay below Spark's 2 GB bound of a binary value, which
``write`` keeps by ``rows_per_file``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesmart.llm.common import shared_dir, stage

END = 2
BLOCK = 1 << 18
ROWS_PER_FILE = 1 << 18

_SUMMARY = "file string, block long, n long, separators long, head long, last long, inner array<int>"


def write(docs: DataFrame, model_file: str, path: str, text: str = "text", rows_per_file: int = ROWS_PER_FILE) -> None:
    """Flat files below ``path``, one or more for each partition of ``docs``."""
    with open(model_file, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        encoder = sentencepiece.SentencePieceProcessor(model_proto=shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                ids = encoder.encode([x or "" for x in batch.column(0).slice(at, 100).to_pylist()], num_threads=1)
                yield pa.RecordBatch.from_arrays([pa.array([np.array(x, "<u2").tobytes() for x in ids], pa.binary())], names=["ids"])

    # The writer puts out the bytes as they are; the separator is the end id's two bytes.
    records = docs.select(text).mapInArrow(run, "ids binary").select(F.col("ids").cast("string").alias("value"))
    (records.write.option("lineSep", np.array([END], "<u2").tobytes().decode("ascii"))
     .option("maxRecordsPerFile", rows_per_file).text(path))


def _summaries(end: int, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1)):
                data = np.frombuffer(content.as_buffer(), "<u2")
                out: list[tuple] = []
                for k, at in enumerate(range(0, len(data), block)):
                    part = data[at:at + block]
                    found = np.flatnonzero(part == end)
                    if len(found):
                        out.append((k, len(part), len(found), int(found[0]), at + int(found[-1]), (np.diff(found) - 1).astype(np.int32)))
                    else:
                        out.append((k, len(part), 0, len(part), None, np.zeros(0, np.int32)))
                if out:
                    columns = list(zip(*out))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name.as_py()] * len(out)), *(pa.array(columns[j], pa.int64()) for j in range(5)),
                         pa.array(columns[5], pa.list_(pa.int32()))], names=["file", "block", "n", "separators", "head", "last", "inner"])

    return run


def scan(spark: SparkSession, path: str, end: int = END, block: int = BLOCK) -> DataFrame:
    """file, ordinal in the file, n_tokens, ended: one row per document of the flat files below ``path``."""
    files = spark.read.format("binaryFile").load(path).where("length > 0").select("path", "content")
    blocks = files.mapInArrow(_summaries(end, block), _SUMMARY)
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    start = F.col("block") * block
    stitched = blocks.select(
        "*", F.coalesce(F.sum("separators").over(before), F.lit(0)).alias("earlier"),
        (start - 1 - F.coalesce(F.max("last").over(before), F.lit(-1))).alias("carried"),
        F.max("block").over(whole).alias("final"))
    # Documents that end in a block: the first with what it carries over, then those between separators.
    ended = stitched.where("separators > 0").select("file", "earlier", F.posexplode(
        F.concat(F.array(F.col("carried") + F.col("head")), F.transform("inner", lambda x: x.cast("long")))).alias("k", "n_tokens")) \
        .select("file", (F.col("earlier") + F.col("k")).alias("ordinal"), "n_tokens", F.lit(True).alias("ended"))
    tail = F.when(F.col("separators") > 0, start + F.col("n") - 1 - F.col("last")).otherwise(F.col("carried") + F.col("n"))
    open_ = stitched.where("block = final").select("file", (F.col("earlier") + F.col("separators")).alias("ordinal"), tail.alias("n_tokens"),
                                                   F.lit(False).alias("ended")).where("n_tokens > 0")
    return ended.unionByName(open_)


def digest(docs: DataFrame, model_file: str) -> DataFrame:
    """doc_id, file part, ordinal and n_tokens of every document, by way of flat files in the shared folder."""
    spark = docs.sparkSession
    path = f"{shared_dir(spark)}/llm/flat-{uuid.uuid4().hex}"
    # One file per scan partition: a document's place in the scan is its place in the files.  Spark cuts a scan
    # by the cores it has unless this is set, so executors that come or go between the two jobs change nothing.
    setting = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, before or str(spark.sparkContext.defaultParallelism))
    try:
        write(docs, model_file, path, rows_per_file=0)
        place = F.monotonically_increasing_id()
        ids = stage(docs.select("doc_id", F.shiftright(place, 33).alias("part"), place.bitwiseAND(F.lit((1 << 33) - 1)).alias("ordinal")), "flat-places")
    finally:
        spark.conf.set(setting, before) if before else spark.conf.unset(setting)
    found = scan(spark, path).select(F.regexp_extract("file", r"part-(\d+)", 1).cast("long").alias("part"), "ordinal", "n_tokens")
    joined = ids.join(found, ["part", "ordinal"], "full_outer")
    return joined.select("doc_id", F.col("part").alias("file_part"), "ordinal",
                         F.coalesce("n_tokens", F.raise_error(F.lit("documents and separators of a file differ")).cast("long")).alias("n_tokens"))
