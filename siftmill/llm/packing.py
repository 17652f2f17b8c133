"""Packing token sequences by Karmarkar-Karp multiway differencing."""

from __future__ import annotations

import heapq
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftmill.llm.common import grouped, staged, table
from siftmill.llm.tokens import per_text, shared_encoder

WINDOW, END_ID = 2048, 1
#: What a document has beyond its full windows is cut into pieces of so many tokens at most, so that windows can be
#: filled evenly; bins of about so many pieces are packed together.
PIECE, BIN = 512, 400


def difference(sizes: list[int], windows: int) -> list[list[int]]:
    """Karmarkar-Karp for ``windows`` parts: the two partial partitions of the widest spread are merged, the fullest
    part of one with the emptiest of the other, until one is left. Returns the items of each part."""
    heap = [(-s, k, [s], [[k]]) for k, s in enumerate(sizes)]  # sums of the parts that aren't empty, descending
    heapq.heapify(heap)
    k = len(sizes)
    while len(heap) > 1:
        _, _, sa, ia = heapq.heappop(heap)
        _, _, sb, ib = heapq.heappop(heap)
        # part j of a meets part windows - 1 - j of b; absent parts are empty
        la, lb = len(sa), len(sb)
        alone = max(0, min(la, windows - lb))
        parts = [(sa[j], ia[j]) for j in range(alone)]
        parts += [(sa[j] + sb[windows - 1 - j], ia[j] + ib[windows - 1 - j]) for j in range(alone, la)]
        parts += [(sb[i], ib[i]) for i in range(min(lb, windows - la))]
        parts.sort(key=lambda p: -p[0])
        sums, items = [p[0] for p in parts], [p[1] for p in parts]
        heapq.heappush(heap, (-(sums[0] - (sums[-1] if len(sums) == windows else 0)), k, sums, items))
        k += 1
    return heap[0][3] if heap else []


def pack(sizes: list[int], capacity: int) -> list[list[int]]:
    """Windows of near-equal sums, none above ``capacity``; one more is tried whenever one is."""
    windows = -(-sum(sizes) // capacity)
    while True:
        parts = difference(sizes, windows)
        if all(sum(sizes[i] for i in p) <= capacity for p in parts):
            return parts
        windows += 1


def cut(n: int, window: int, piece: int) -> list[tuple[int, int]]:
    """Full windows, then the rest in pieces of near-equal length."""
    full = n // window
    out = [(i * window, window) for i in range(full)]
    at, rest = full * window, n % window
    for left in range(-(-rest // piece), 0, -1):
        out.append((at, size := -(-rest // left)))
        at, rest = at + size, rest - size
    return out


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, window: int = WINDOW, end_id: int = END_ID, piece: int = PIECE, per_bin: int = BIN, path: str | None = None) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    A null or empty text is a document of the end id alone. Rows repeated with one id are documents of their own,
    each with its own pieces. An empty table gives no rows. Token ids stay in the task that makes them: only pieces'
    lengths and checksums are shuffled, into bins of bounded size (by a hash of the piece's number in the task that cut it, so that
    neither a very long document nor rows repeated many times fill one bin) that are packed apart. Sequence ids are unique, not gapless."""
    shared = shared_encoder(docs.sparkSession, path)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    end = end_id.to_bytes(4, "little")

    def pieces(batches):
        encode, number = per_text(shared), TaskContext.get().partitionId() << 40
        for b in batches:
            docs_, starts, lengths, sums, totals = [], [], [], [], []
            for doc, ids in zip(b["doc_id"].to_pylist(), encode(b["text"]), strict=True):
                ids = memoryview(ids + end)
                total = len(ids) // 4
                for s, n in cut(total, window, piece):
                    docs_.append(doc), starts.append(s), lengths.append(n), totals.append(total)
                    sums.append(zlib.crc32(ids[4 * s : 4 * (s + n)]))
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in (docs_, starts, lengths, sums, totals)), pa.array(range(number, number + len(docs_)), pa.int64())], [*names, "number"])
            number += len(docs_)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    cuts, seen = staged(rows.mapInArrow(pieces, ", ".join(f"{n} long" for n in [*names, "number"])), F.count(F.lit(1)).alias("n"))
    bins = max(1, -(-seen["n"] // per_bin))

    def fill(batches):
        for g in grouped(batches, "bin"):
            bin_id, next_id = g["bin"][0].as_py() << 32, 0
            for at in range(0, g.num_rows, 4 * per_bin):  # a bin that happens to be large is packed in parts
                part = g.slice(at, 4 * per_bin)
                sizes = part["length"].to_pylist()
                own = [[i] for i, n in enumerate(sizes) if n == window]
                loose = [i for i, n in enumerate(sizes) if n < window]
                seqs, offsets = [0] * len(sizes), [0] * len(sizes)
                for members in own + [[loose[i] for i in p] for p in pack([sizes[i] for i in loose], window)]:
                    offset = 0
                    for i in sorted(members):
                        seqs[i], offsets[i] = bin_id + next_id, offset
                        offset += sizes[i]
                    next_id += 1
                out = part.select(names).append_column("sequence_id", pa.array(seqs, pa.int64())).append_column("offset", pa.array(offsets, pa.int64()))
                yield from out.combine_chunks().to_batches()

    binned = cuts.withColumn("bin", F.pmod(F.xxhash64("number"), F.lit(bins)))
    return binned.repartition("bin").sortWithinPartitions("bin", *names).mapInArrow(fill, ", ".join(f"{n} long" for n in [*names, "sequence_id", "offset"]))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
