"""Best-fit packing after Martello-Toth dominance reduction.

Only the lengths of pieces matter to a packing, and there are at most
``capacity`` of them, so the whole instance is a histogram of that size however
many documents there are. The reduction takes the longest length left and asks
whether some partner provably does at least as well as every other set that
fits beside it:

* nothing fits beside it: it stays alone;
* the longest partner that fits fills the sequence exactly, or no two pieces
  fit beside it, or no three do and the partner is at least as long as every
  two: the pair dominates every alternative, and as many such pairs as there
  are pieces are fixed for good.

What no rule settles is packed best-fit, longest first. Both steps work on
counts, so the plan is a bounded list of runs: pieces of one length, by their
number among equals, to sequences and places. Spark numbers the pieces and looks
each one up in the plan.

Defined results: a null text counts as empty (one piece, only the end id);
null ids and repeated rows are documents of their own; longer texts than a
sequence are cut, none is left out; pieces of one length are numbered by id,
piece and checksum; an empty table gives an empty result; other columns are not
read, so their names can't clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslens.llm.shared import materialise, running_totals
from presslens.llm.tokens import encoder

CAPACITY = 4096
END_ID = 1


def pieces(
    df: DataFrame, vocabulary: str, end_id: int = END_ID, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False
) -> DataFrame:
    """Documents cut into pieces of at most ``capacity`` ids: doc_id, piece, start, length, ids_crc32 (and ids)."""
    docs = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        end = enc.pack([end_id])
        for rows in batches:
            owner, cuts, blobs = [], [], []
            for i, text in enumerate(rows.column(1)):
                ids = np.frombuffer(enc.encode(text.as_py()) + end, dtype=enc.dtype).astype("<u4")
                for n, at in enumerate(range(0, len(ids), capacity)):
                    part = ids[at : at + capacity]
                    owner.append(i)
                    cuts.append((n, at, len(part), zlib.crc32(part)))
                    if with_ids:
                        blobs.append(part.tobytes())
            table = np.array(cuts, dtype=np.int64).reshape(-1, 4)
            columns = [rows.column(0).take(pa.array(owner, pa.int32())), pa.array(table[:, 0], pa.int32())]
            columns += [pa.array(table[:, k]) for k in (1, 2, 3)] + [pa.array(blobs, pa.binary())] * with_ids
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            yield pa.RecordBatch.from_arrays(columns, names[: len(columns)])

    kinds = f"doc_id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    return docs.mapInArrow(cut, kinds)


def dominance(counts: np.ndarray) -> list[tuple[int, list[int]]]:
    """Fix dominating sets: (how many sequences, the lengths in each). Takes them out of ``counts`` (by length)."""
    capacity = len(counts) - 1
    fixed: list[tuple[int, list[int]]] = []

    def fix(n: int, lengths: list[int]) -> None:
        for x in lengths:
            counts[x] -= n
        fixed.append((int(n), lengths))

    changed = True
    while changed:
        changed = False
        for longest in range(capacity, 0, -1):
            while counts[longest]:
                room = capacity - longest
                counts[longest] -= 1  # the piece in question is no partner of its own
                fitting = np.flatnonzero(counts[: room + 1])
                best = int(fitting[-1]) if len(fitting) else 0
                least = np.repeat(fitting[:3], np.minimum(counts[fitting[:3]], 3))[:3].tolist()
                only_pairs = len(least) < 2 or least[0] + least[1] > room
                dominates = best == room or only_pairs
                if best and not dominates and (len(least) < 3 or sum(least) > room):
                    dominates = best >= _longest_two(counts, fitting, room)
                counts[longest] += 1
                if not best:
                    fix(counts[longest], [longest])
                elif dominates:
                    fix(counts[longest] // 2 if best == longest else min(counts[longest], counts[best]), [longest, best])
                else:
                    break
                changed = True
    return fixed


def _longest_two(counts: np.ndarray, fitting: np.ndarray, room: int) -> int:
    """The most that two of the pieces of these lengths add up to within ``room``."""
    low, high, most = 0, len(fitting) - 1, 0
    while low <= high:
        two = int(fitting[low] + fitting[high])
        if two > room:
            high -= 1
        elif low == high and counts[fitting[low]] < 2:
            break
        else:
            most, low = max(most, two), low + 1
    return most


def best_fit(counts: np.ndarray) -> list[tuple[int, list[tuple[int, int]]]]:
    """Best-fit, longest first, on counts: (how many sequences, runs of (length, times) in each)."""
    capacity = len(counts) - 1
    groups: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}  # by room left
    rooms = np.zeros(capacity + 1, dtype=bool)

    def put(n: int, room: int, runs: list[tuple[int, int]]) -> None:
        if n:
            groups.setdefault(room, []).append((n, runs))
            rooms[room] = True

    for length in range(capacity, 0, -1):
        left = int(counts[length])
        while left:
            fits = int(rooms[length:].argmax()) + length
            if rooms[fits]:
                n, runs = groups[fits].pop()
                rooms[fits] = bool(groups[fits])
                room = fits
            else:
                n, runs, room = left, [], capacity
            # the sequence just served is the tightest as long as another piece fits
            times = room // length
            full = min(n, left // times)
            put(full, room - times * length, [*runs, (length, times)])
            left, n = left - full * times, n - full
            if n and left:
                put(1, room - left * length, [*runs, (length, left)])
                left, n = 0, n - 1
            if runs:
                put(n, room, runs)
    return [x for room in sorted(groups) for x in groups[room]]


def plan(counts: np.ndarray) -> dict[str, np.ndarray]:
    """Runs by (length, first): pieces number first.. of a length go to sequence + k // times, at offset + k % times * length."""
    counts = counts.copy()
    groups = [(n, [(x, 1) for x in lengths]) for n, lengths in dominance(counts) if n]
    groups += best_fit(counts)
    used = np.zeros(len(counts), dtype=np.int64)
    rows, sequence = [], 0
    for n, runs in groups:
        offset = 0
        for length, times in runs:
            rows.append((length, used[length], times, sequence, offset))
            used[length] += n * times
            offset += length * times
        sequence += n
    table = np.array(rows, dtype=np.int64).reshape(-1, 5)
    table = table[np.lexsort((table[:, 1], table[:, 0]))]
    return dict(zip(("length", "first", "times", "sequence", "offset"), table.T.copy()))


def place(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut`` (see ``pieces``) with sequence_id and offset. The driver sees one count per length."""
    spark = cut.sparkSession
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for row in cut.groupBy("length").count().collect():
        counts[row["length"]] = row["count"]
    runs = spark.sparkContext.broadcast(plan(counts))
    order = [F.col("doc_id"), F.col("piece"), F.col("ids_crc32")]
    numbered = running_totals(cut, ["length"], order, rank="nth", name="numbered")
    columns = numbered.columns[:-1]

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = runs.value
        first_of = np.searchsorted(run["length"], np.arange(capacity + 2))
        for rows in batches:
            length, nth = rows.column("length").to_numpy(), rows.column("nth").to_numpy()
            at = np.empty(len(rows), dtype=np.int64)
            for x in np.unique(length):
                low, high = first_of[x], first_of[x + 1]
                here = length == x
                at[here] = low + np.searchsorted(run["first"][low:high], nth[here], "right") - 1
            k = nth - run["first"][at]
            sequence = run["sequence"][at] + k // run["times"][at]
            offset = run["offset"][at] + k % run["times"][at] * length
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(c) for c in columns), pa.array(sequence), pa.array(offset)], [*columns, "sequence_id", "offset"]
            )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in numbered.schema if f.name != "nth")
    return numbered.mapInArrow(look_up, f"{kinds}, sequence_id bigint, offset bigint")


def pack(df: DataFrame, vocabulary: str, end_id: int = END_ID, capacity: int = CAPACITY, with_ids: bool = False, **columns) -> DataFrame:
    """Pack whole documents: one row per piece with its sequence_id and offset."""
    cut = materialise(pieces(df, vocabulary, end_id, capacity, with_ids=with_ids, **columns), "pieces")
    return place(cut, capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves (from ``pack(with_ids=True)``): sequence_id, ids (little-endian unsigned 32-bit)."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.aggregate(parts, F.lit(b""), lambda all_, part: F.concat(all_, part["ids"])).alias("ids")
    )
