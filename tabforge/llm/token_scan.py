"""Token counts from flat, unindexed token files.

A token file is little-endian unsigned 16-bit ids, each document followed by the
end-of-document id, with no index. The scan cuts files into blocks, searches
each block for the separator with one vectorised comparison, and stitches
documents that span blocks with a prefix scan over the blocks of a file: the
running maximum of the last separator seen gives each block the place where its
first document began, the running sum of separators its first ordinal.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import fresh_folder, open_store, stage, store_uri
from .piece_bpe import text_slices

#: Tokens that one scan task reads at a time.
BLOCK_TOKENS = 8 << 20


def byte_bpe_encoder(path: str, pattern: str):
    """A function that makes the encoder in the task (text -> ids) from a rank file."""
    def make():
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        return tiktoken.Encoding("flat", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    return make


def write_token_files(docs: DataFrame, make_encoder, end_id: int) -> DataFrame:
    """Write one token file per task; returns a written stage (path, ordinal, doc_id).

    A task that runs again writes another file; only files named by the committed
    rows count. Null and empty texts are documents of no tokens.
    """
    folder = store_uri(fresh_folder(docs.sparkSession, "token-files"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, sink, n = make_encoder(), None, 0
        name = f"{folder}/tokens-{uuid.uuid4().hex}.bin"
        for key, texts in text_slices(batches, "doc_id"):
            if sink is None:
                store, place = open_store(name)
                store.create_dir(place.rpartition("/")[0], recursive=True)
                sink = store.open_output_stream(place, compression=None)
            for text in texts:
                ids = encode(text)
                ids.append(end_id)
                sink.write(np.array(ids, "<u2").tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(texts)), pa.array(range(n, n + len(texts)), pa.int64()), key],
                ["path", "ordinal", "doc_id"])
            n += len(texts)
        if sink is not None:
            sink.close()

    kind = dict(docs.dtypes)["doc_id"]
    return stage(docs.select("doc_id", "text").mapInArrow(run, f"path string, ordinal long, doc_id {kind}"), "token-docs")


def scan_token_files(files: DataFrame, end_id: int, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(path, ordinal, start, n_tokens) of each document of the files in column path.

    Tokens after the last separator of a file are a last document of its own if
    there are any (``closed`` is then false). A file with an odd number of bytes
    raises an error; an empty file has no documents. Repeated paths count once.
    """
    spark = files.sparkSession

    def sizes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column("path").to_pylist()
            size = []
            for p in paths:
                store, place = open_store(p)
                size.append(store.get_file_info(place).size)
                if size[-1] % 2:
                    raise ValueError(f"{p} has an odd number of bytes")
            yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(size, pa.int64())], ["path", "bytes"])

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, at, n in zip(*(batch.column(c).to_pylist() for c in ("path", "at", "n")), strict=True):
                store, place = open_store(path)
                with store.open_input_file(place) as f:
                    block = np.frombuffer(f.read_at(2 * n, 2 * at), "<u2")
                ends = np.flatnonzero(block == end_id).astype(np.int64) + at
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path]), pa.array([at], pa.int64()), pa.array([n], pa.int64()),
                     pa.array([ends], pa.list_(pa.int64()))], ["path", "at", "n", "ends"])

    step = F.lit(block_tokens).cast("long")
    blocks = (files.select("path").distinct().mapInArrow(sizes, "path string, bytes long")
              .where("bytes > 0").withColumn("tokens", F.expr("bytes div 2"))
              .select("path", "tokens", F.explode(F.expr(f"sequence(0L, tokens - 1, {block_tokens}L)")).alias("at"))
              .select("path", "at", F.least(step, F.col("tokens") - F.col("at")).alias("n"))
              .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path", "at"))
    found = stage(blocks.mapInArrow(search, "path string, at long, n long, ends array<long>"), "token-blocks")
    order = Window.partitionBy("path").orderBy("at")
    past = order.rowsBetween(Window.unboundedPreceding, -1)
    stitched = found.withColumns({
        "last": F.when(F.size("ends") > 0, F.element_at("ends", -1)),
        "seps": F.size("ends").cast("long")}).withColumns({
            "begin": F.coalesce(F.max("last").over(past), F.lit(-1)) + 1,
            "ordinal0": F.coalesce(F.sum("seps").over(past), F.lit(0)),
            "is_last": F.lead("at").over(order).isNull()})
    # the tokens behind the last separator of the file end without one
    open_end = F.col("is_last") & (F.coalesce(F.col("last"), F.col("begin") - 1) < F.col("at") + F.col("n") - 1)
    ends = F.when(open_end, F.concat("ends", F.array(F.col("at") + F.col("n")))).otherwise(F.col("ends"))
    starts = F.concat(F.array("begin"), F.transform("ends", lambda x: x + 1))
    docs = stitched.withColumns({"all_ends": ends, "starts": starts}).select(
        "path", "ordinal0", "starts", "seps", F.posexplode("all_ends").alias("k", "end"))
    return docs.select("path", (F.col("ordinal0") + F.col("k")).alias("ordinal"),
                       F.element_at("starts", F.col("k") + 1).alias("start"),
                       (F.col("end") - F.element_at("starts", F.col("k") + 1)).alias("n_tokens"),
                       (F.col("k") < F.col("seps")).alias("closed"))


def document_token_counts(docs: DataFrame, make_encoder, end_id: int, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """doc_id, n_tokens for every row of ``docs`` (doc_id, text), counted from its token files.

    Null and empty texts have 0 tokens; repeated rows are counted each; an empty
    table gives no rows.
    """
    written = write_token_files(docs, make_encoder, end_id)
    found = scan_token_files(written.select("path"), end_id, block_tokens)
    return written.join(found, ["path", "ordinal"]).select("doc_id", "n_tokens")
