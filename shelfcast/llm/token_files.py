"""Token ids in binary files: ids ranked by frequency, in one to four bytes each, apart from their control bytes.

A document's ids are written as ranks (the most frequent id is 0), each in as few bytes as it needs; two control
bits per id, four ids to a control byte, tell how many.  Blocks of documents in ascending order of their numbers
are rows of a Parquet table that executors write to the shared folder, so that Spark commits and recovers them.
Decoding looks the lengths of four ids up by their control byte and gathers all ids of a block at once.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.token_units import encoder, forget_words, vocabulary_path
from shelfcast.llm.workers import pieces
from shelfcast.shared import fresh_path, scratch

END = 2
#: Length of each of the four ids that a control byte stands for, and their sum.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3) + 1
BLOCK_TOKENS = 1 << 17
ROWS_PER_PART = 16_000

BLOCK = (
    "part bigint, place bigint, before bigint, n_tokens bigint, doc_ids array<bigint>, counts array<bigint>,"
    " controls binary, data binary"
)


def _padded(counts: np.ndarray) -> np.ndarray:
    """Places of the ids of rows that each begin a new control byte."""
    widths = -(-counts // 4) * 4
    return np.arange(int(counts.sum())) + np.repeat(np.cumsum(widths) - widths - (np.cumsum(counts) - counts), counts)


def pack(values: np.ndarray, counts: np.ndarray) -> tuple[list[bytes], list[bytes]]:
    """Control bytes and data bytes of each row of unsigned 32-bit numbers; ``counts`` tells the rows' lengths."""
    values = np.ascontiguousarray(values, "<u4")
    codes = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    widths = -(-counts // 4)
    four = np.zeros(int(widths.sum()) * 4, np.uint8)
    four[_padded(counts)] = codes
    four = four.reshape(-1, 4)
    controls = (four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6).astype(np.uint8).tobytes()
    data = values.view(np.uint8).reshape(-1, 4)[np.arange(4) <= codes[:, None]].tobytes()
    bytes_before = np.append(0, np.cumsum(codes.astype(np.int64) + 1))
    ends = np.append(0, np.cumsum(counts))
    cuts, at = bytes_before[ends].tolist(), np.append(0, np.cumsum(widths)).tolist()
    return [controls[a:b] for a, b in zip(at, at[1:])], [data[a:b] for a, b in zip(cuts, cuts[1:])]


def unpack(controls: bytes, data: bytes, counts: np.ndarray) -> np.ndarray:
    """All numbers of rows, one after another, from their joined control and data bytes."""
    lengths = LENGTHS[np.frombuffer(controls, np.uint8)].reshape(-1)[_padded(counts)]
    source = np.frombuffer(data, np.uint8)
    starts = np.cumsum(lengths) - lengths
    values = source[starts].astype(np.uint32)
    for k in (1, 2, 3):
        more = np.flatnonzero(lengths > k)
        if not len(more):
            break
        values[more] |= source[starts[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return values


def _tokenise(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[pa.RecordBatch]:
    """Ids of each document with the end id, as they are."""
    units = encoder(vocabulary_path(name))
    for batch, ids, counts in units.encode_batches(batches):
        ends = np.cumsum(counts + 1)
        ended = np.full(len(ids) + len(counts), END, units.width)
        inside = np.ones(len(ended), bool)
        inside[ends - 1] = False
        ended[inside] = ids
        cuts = np.append(0, ends * units.bytes).astype(np.int32)
        rows = pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(cuts), pa.py_buffer(ended)])
        yield pa.RecordBatch.from_arrays(
            [batch.column("at"), batch.column("doc_id"), pa.array(counts + 1), rows], names=["at", "doc_id", "n_tokens", "ids"]
        )


def _joined(batch: pa.RecordBatch, width: str) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a batch's rows in one array, and how many each row has."""
    return np.frombuffer(b"".join(batch.column("ids").to_pylist()), width), batch.column("n_tokens").to_numpy(zero_copy_only=False)


def _occurrences(batches: Iterator[pa.RecordBatch], size: int, width: str) -> Iterator[pa.RecordBatch]:
    """How often each id occurs among all rows of this task."""
    totals = np.zeros(size, np.int64)
    for batch in pieces(batches, "ids"):
        totals += np.bincount(_joined(batch, width)[0], minlength=size)
    ids = np.flatnonzero(totals)
    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(totals[ids])], names=["id", "n"])


def _rank_rows(batches: Iterator[pa.RecordBatch], ranks: np.ndarray, cuts: np.ndarray, width: str) -> Iterator[pa.RecordBatch]:
    """Rows with the part that their place falls in, ids re-coded as ranks."""
    for batch in pieces(batches, "ids"):
        numbers = batch.column("at")
        part = np.searchsorted(cuts, numbers.fill_null(0).to_numpy(zero_copy_only=False), side="right")
        part[numbers.is_null().to_numpy(zero_copy_only=False)] = 0
        ids, counts = _joined(batch, width)
        controls, data = pack(ranks[ids], counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(part, pa.int64()), numbers, batch.column("doc_id"), batch.column("n_tokens"),
                pa.array(controls, pa.binary()), pa.array(data, pa.binary()),
            ],
            names=["part", "at", "doc_id", "n_tokens", "controls", "data"],
        )


def _blocks(batches: Iterator[pa.RecordBatch], block_tokens: int) -> Iterator[pa.RecordBatch]:
    """Blocks of consecutive documents of one part; the rows of a part come together and in order."""
    state = {"part": None, "place": 0, "before": 0}
    held: list[tuple[int, int, bytes, bytes]] = []

    def flush() -> pa.RecordBatch:
        n = sum(h[1] for h in held)
        row = [
            [state["part"]], [state["place"]], [state["before"]], [n], [[h[0] for h in held]], [[h[1] for h in held]],
            [b"".join(h[2] for h in held)], [b"".join(h[3] for h in held)],
        ]
        kinds = [pa.int64()] * 4 + [pa.list_(pa.int64())] * 2 + [pa.binary()] * 2
        names = ["part", "place", "before", "n_tokens", "doc_ids", "counts", "controls", "data"]
        state["place"], state["before"] = state["place"] + 1, state["before"] + n
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], names=names)

    size = 0
    for batch in pieces(batches, "data"):
        for part, doc, n, controls, data in zip(
            *[batch.column(c).to_pylist() for c in ("part", "doc_id", "n_tokens", "controls", "data")]
        ):
            if held and (part != state["part"] or size + n > block_tokens):
                yield flush()
                size = 0
            if part != state["part"]:
                state.update(part=part, place=0, before=0)
            held.append((doc, n, controls, data))
            size += n
    if held:
        yield flush()


class TokenFiles:
    """Token files in a folder: the ``ranks`` table and the ``blocks`` table."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    @classmethod
    def write(
        cls, docs: DataFrame, folder: str | None = None, name: str = "byte_bpe_50k.json", doc_id: str = "doc_id",
        text: str = "text", block_tokens: int = BLOCK_TOKENS, rows_per_part: int = ROWS_PER_PART, order: Column | None = None,
    ) -> TokenFiles:
        """Encode every text of ``docs`` and write it, in ascending order of the documents' numbers, null first.

        ``order`` is another number to go by, such as a row's place in a mix.  A null text is empty: it has the end id
        only.  Rows with equal numbers stand together, the shorter first, then by their bytes.  Very long texts are
        encoded whole.  Only the named columns are read.  An empty table gives empty tables.
        """
        spark = docs.sparkSession
        files = cls(spark, folder or fresh_path(spark, "token-files"))
        number = F.col(f"`{doc_id}`").cast("long")
        rows = docs.select((number if order is None else order).alias("at"), number.alias("doc_id"), F.col(f"`{text}`").alias("text"))
        kinds = "at bigint, doc_id bigint, n_tokens bigint, ids binary"
        with scratch(spark):  # the ids as they are go once the blocks are written
            path = fresh_path(spark, "token-ids")
            rows.mapInArrow(lambda b: _tokenise(b, name), kinds).write.option("compression", "zstd").parquet(path)
            encoded = spark.read.schema(kinds).parquet(path)
            units = encoder(vocabulary_path(name))
            size, width = max(units.library.get_vocab_size(), END + 1), units.width
            counts = encoded.mapInArrow(lambda b: _occurrences(b, size, width), "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
            found = sorted(counts.collect(), key=lambda r: (-r["n"], r["id"]))  # as many as the vocabulary has at most
            order = [r["id"] for r in found]
            spark.createDataFrame([(k, i) for k, i in enumerate(order)], "rank bigint, id bigint").write.parquet(f"{files.folder}/ranks")
            ranks = np.zeros(size, np.uint32)
            ranks[order] = np.arange(len(order), dtype=np.uint32)
            total = encoded.count()
            parts = max(1, -(-total // rows_per_part), min(total, spark.sparkContext.defaultParallelism * 2))
            shares = [k / parts for k in range(1, parts)]
            cuts = encoded.select(F.percentile_approx("at", shares, 100 * parts)).first()[0] if shares else []
            cuts = sorted(set(cuts or []))
            table = np.array(cuts, np.int64)
            dealt = encoded.mapInArrow(
                lambda b: _rank_rows(b, ranks, table, width),
                "part bigint, at bigint, doc_id bigint, n_tokens bigint, controls binary, data binary",
            )
            ordered = dealt.repartitionById(len(cuts) + 1, F.col("part").cast("int")).sortWithinPartitions("part", "at", "doc_id", "n_tokens", "controls", "data")
            blocks = ordered.mapInArrow(lambda b: _blocks(b, block_tokens), BLOCK)
            blocks.write.option("compression", "uncompressed").parquet(f"{files.folder}/blocks")
        return files

    def read(self) -> DataFrame:
        """From the files: ``doc_id start n_tokens ids_crc32``, a row per document."""
        return self._decoded(
            lambda ids: [zlib.crc32(ids.astype("<u4").tobytes())], ["ids_crc32 bigint"], [pa.int64()]
        )

    def read_ids(self) -> DataFrame:
        """From the files: ``doc_id start n_tokens ids``, the ids as an array."""
        return self._decoded(lambda ids: [ids.astype(np.int64).tolist()], ["ids array<bigint>"], [pa.list_(pa.int64())])

    def _decoded(self, outputs, columns: list[str], kinds: list[pa.DataType]) -> DataFrame:
        stored = self.spark.read.parquet(f"{self.folder}/blocks")
        order = [r["id"] for r in self.spark.read.parquet(f"{self.folder}/ranks").orderBy("rank").collect()]
        ids_of = np.array(order or [0], np.uint32)
        # one total per part, of which there are as many as files
        totals = sorted((r["part"], r["n"]) for r in stored.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())
        first, running = {}, 0
        for part, n in totals:
            first[part], running = running, running + n

        def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            forget_words()
            for batch in batches:
                for k in range(batch.num_rows):
                    row = batch.slice(k, 1).to_pylist()[0]
                    counts = np.array(row["counts"], np.int64)
                    ids = ids_of[unpack(row["controls"], row["data"], counts)]
                    ends = np.cumsum(counts)
                    starts = ends - counts
                    found = [outputs(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
                    arrays = [pa.array(row["doc_ids"], pa.int64()), pa.array(starts + (first[row["part"]] + row["before"])), pa.array(counts)]
                    yield pa.RecordBatch.from_arrays(
                        arrays + [pa.array(v, kind) for v, kind in zip(zip(*found), kinds)],
                        names=["doc_id", "start", "n_tokens", *[c.split()[0] for c in columns]],
                    )

        return stored.mapInArrow(decode, ", ".join(["doc_id bigint", "start bigint", "n_tokens bigint", *columns]))
