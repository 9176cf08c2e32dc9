"""Token ids of a corpus as canonical Huffman files, and the way back.

The files are Parquet rows in ascending document order, each a *segment* of whole documents:
`doc_ids` and `doc_tokens` are its index, `payload` the code bits of all its ids, and `checkpoints`
the bit offset of every block of 512 ids (a block belongs to one document). Blocks decode
independently. The code lengths, one per vocabulary id, lie beside the segments in `code`, so the
folder alone can be read.

Null texts count as empty and hold the end id alone. Null document ids come first; documents with equal ids are ordered
by the checksum of their ids, each its own row. An empty table gives empty files. Extra columns of the
input are not read. A document lies in one segment whatever its length.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyline.llm import huffman
from tallyline.llm.storage import stored
from tallyline.llm.text_arrays import groups, text_bytes
from tallyline.llm.word_ids import encoder
from tallyline.session import shared_folder

STAGED = "doc_id long, n_tokens long, ids_crc32 long, ids binary"
SEGMENT = (
    "shard int, segment int, first_token long, doc_ids array<long>, doc_tokens array<long>, "
    "checkpoints array<long>, payload binary"
)
SEGMENT_TOKENS = 1 << 19
# One row: the longest code allowed, and the code length of each id as a byte.
CODE = "code_limit int, lengths binary"


@dataclass
class TokenFiles:
    """A written corpus: the folder of its segments, the code lengths of all ids, and the limit."""

    path: str
    lengths: np.ndarray
    limit: int


def tokenized(docs: DataFrame, tokenizer: str, end_id: int, width: int = 2) -> DataFrame:
    """(doc_id, n_tokens, ids_crc32, ids): the ids of each text as `width`-byte integers."""
    kind = {2: np.dtype("<u2"), 4: np.dtype("<u4")}[width]

    def run(batches):
        words = encoder(tokenizer)
        for batch in batches:
            data, bounds = text_bytes(batch.column(1))
            for a, b in groups(bounds):
                ids, firsts = words.encode(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a])
                bodies, crcs = [], []
                for x, y in zip(firsts[:-1], firsts[1:], strict=True):
                    own = np.append(ids[x:y], np.uint32(end_id))
                    crcs.append(zlib.crc32(own.astype("<u4").tobytes()))
                    bodies.append(own.astype(kind).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a).cast(pa.int64()),
                        pa.array(np.diff(firsts) + 1, pa.int64()),
                        pa.array(crcs, pa.int64()),
                        pa.array(bodies, pa.binary()),
                    ],
                    names=["doc_id", "n_tokens", "ids_crc32", "ids"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, STAGED)


def id_counts(staged: DataFrame, vocabulary: int, width: int = 2) -> np.ndarray:
    """Occurrences of each id; tasks add up their own first, so `vocabulary` rows each leave them."""
    kind = {2: np.dtype("<u2"), 4: np.dtype("<u4")}[width]

    def run(batches):
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            for body in batch.column(0):
                total += np.bincount(np.frombuffer(body.as_py(), kind), minlength=vocabulary)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], names=["id", "n"])

    sums = staged.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    counts = np.zeros(vocabulary, np.int64)
    for row in sums.toLocalIterator():  # at most one row for each vocabulary id
        counts[row.id] = row.n
    return counts


def write_tokens(
    docs: DataFrame, tokenizer: str, end_id: int, vocabulary: int, limit: int = 16, path: str | None = None
) -> TokenFiles:
    """Encode all documents and write their segments in ascending order of `doc_id`."""
    spark = docs.sparkSession
    width = 2 if vocabulary <= 1 << 16 else 4
    staged = stored(tokenized(docs, tokenizer, end_id, width), "token-ids")
    lengths = huffman.code_lengths(id_counts(staged, vocabulary, width), limit)
    codes = huffman.canonical(lengths)
    kind = {2: np.dtype("<u2"), 4: np.dtype("<u4")}[width]

    def segment(shard, number, first, doc_ids, bodies):
        counts = np.array([len(x) // width for x in bodies], np.int64)
        ids = np.frombuffer(b"".join(bodies), kind)
        payload, offsets = huffman.encode(ids, _block_starts(counts)[0], codes, lengths)
        columns = [[shard], [number], [first], [doc_ids], [counts.tolist()], [offsets.tolist()], [payload.tobytes()]]
        kinds = [pa.int32(), pa.int32(), pa.int64(), *[pa.list_(pa.int64())] * 3, pa.binary()]
        names = [x.split()[0] for x in SEGMENT.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    def run(batches):
        shard, number, first, held = TaskContext.get().partitionId(), 0, 0, 0
        doc_ids: list = []
        bodies: list = []
        for batch in batches:
            for doc_id, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                body = body.as_py()
                if bodies and held + len(body) // width > SEGMENT_TOKENS:
                    yield segment(shard, number, first, doc_ids, bodies)
                    number, first, held, doc_ids, bodies = number + 1, first + held, 0, [], []
                doc_ids.append(doc_id)
                bodies.append(body)
                held += len(body) // width
        if bodies:
            yield segment(shard, number, first, doc_ids, bodies)

    path = path or shared_folder(spark, "token-files")
    ordered = staged.repartitionByRange("doc_id", "ids_crc32").sortWithinPartitions("doc_id", "ids_crc32")
    ordered.select("doc_id", "ids").mapInArrow(run, SEGMENT).write.option("compression", "uncompressed").parquet(
        f"{path}/segments"
    )
    code = [(limit, bytearray(lengths.astype(np.uint8).tobytes()))]
    spark.createDataFrame(code, CODE).coalesce(1).write.parquet(f"{path}/code")
    return TokenFiles(path, lengths, limit)


def open_tokens(spark: SparkSession, path: str) -> TokenFiles:
    """The corpus that `write_tokens` wrote to `path`."""
    limit, lengths = spark.read.schema(CODE).parquet(f"{path}/code").first()
    return TokenFiles(path, np.frombuffer(bytes(lengths), np.uint8).astype(np.int64), limit)


def _block_starts(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First id and size of each block of documents with `counts` ids."""
    blocks = -(-counts // huffman.BLOCK)
    within = np.arange(int(blocks.sum())) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    begin = np.repeat(np.cumsum(counts) - counts, blocks) + within * huffman.BLOCK
    size = np.minimum(np.repeat(counts, blocks) - within * huffman.BLOCK, huffman.BLOCK)
    return begin, size


def read_tokens(spark: SparkSession, files: TokenFiles | str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids): the decoded documents, ids as 4-byte integers.

    `files` is a written corpus or the path of its folder.
    """
    files = open_tokens(spark, files) if isinstance(files, str) else files
    lengths, limit = files.lengths, files.limit

    def run(batches):
        lookup = huffman.decode_table(lengths, limit)
        for batch in batches:
            for row in range(batch.num_rows):
                shard, first, doc_ids, counts, offsets, payload = (
                    batch.column(k)[row] for k in range(batch.num_columns)
                )
                counts = np.array(counts.as_py(), np.int64)
                ids = huffman.decode(
                    np.frombuffer(payload.as_py(), np.uint8),
                    np.array(offsets.as_py(), np.int64),
                    _block_starts(counts)[1],
                    lookup,
                    limit,
                ).astype("<u4")
                upto = np.cumsum(counts)
                bodies = [ids[a:b].tobytes() for a, b in zip(upto - counts, upto, strict=True)]
                n = len(counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard.as_py()] * n, pa.int32()),
                        pa.array(doc_ids.as_py(), pa.int64()),
                        pa.array(first.as_py() + upto - counts, pa.int64()),
                        pa.array(counts),
                        pa.array([zlib.crc32(x) for x in bodies], pa.int64()),
                        pa.array(bodies, pa.binary()),
                    ],
                    names=["shard", "doc_id", "start", "n_tokens", "ids_crc32", "ids"],
                )

    segments = spark.read.schema(SEGMENT).parquet(f"{files.path}/segments")
    sizes = segments.select("shard", F.aggregate("doc_tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    # One row for each written file, whatever the documents.
    before = (
        sizes.groupBy("shard")
        .agg(F.sum("n").alias("n"))
        .select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("base"))
    )
    decoded = segments.select("shard", "first_token", "doc_ids", "doc_tokens", "checkpoints", "payload").mapInArrow(
        run, "shard int, doc_id long, start long, n_tokens long, ids_crc32 long, ids binary"
    )
    return decoded.join(F.broadcast(before), "shard").select(
        "doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32", "ids"
    )
