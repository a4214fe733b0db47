"""Best-fit packing of token pieces by a linear grouping scheme.

Only lengths matter for packing, and there are no more lengths than tokens in a sequence. So the pieces' histogram is
planned as a whole, whatever the corpus' size: the large lengths are rounded up within groups of equal cardinality,
a linear programme over these few sizes finds configurations (columns generated by a knapsack), the actual pieces
take the rounded slots, and the small ones are put best-fit, longest first, into what is left. The plan is a list of
runs, each some equal sequences; a piece's rank within its length says which sequence of which run it is in. Ranks
come from running counts: of a length within a partition, and of the partitions before.

Defined cases: a null text is empty and has the end id alone; repeated rows are pieces of their own; an empty table
gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, materialize
from .encoding import encoder

CAPACITY = 2048
#: Sizes of the linear programme, and the shares of a sequence from which a length may count as large: the plan with
#: the fewest sequences is taken.
GROUPS, LARGE = 64, (0.4, 0.5)
MAX_COLUMNS = 400
#: Rows (some 30 bytes each) up to which the counts of lengths are broadcast; beyond, they are joined by merge.
BROADCAST_COUNTS = 300_000


# --- the plan -------------------------------------------------------------------------------------------------------


def group_large(lengths: np.ndarray, counts: np.ndarray, groups: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Equal-cardinality groups from the longest down: (rounded length, [(length, pieces), ...])."""
    per_group = max(1, -(-int(counts.sum()) // groups))
    out: list[tuple[int, list[tuple[int, int]]]] = []
    room = 0
    for length, count in sorted(zip(lengths.tolist(), counts.tolist(), strict=True), reverse=True):
        while count:
            if not room:
                out.append((length, []))
                room = per_group
            take = min(room, count)
            out[-1][1].append((length, take))
            room -= take
            count -= take
    return out


def _knapsack(values: np.ndarray, sizes: list[int], capacity: int) -> tuple[float, np.ndarray]:
    """Most valuable multiset of sizes within the capacity."""
    best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    order = np.array(sizes)
    for w in range(min(sizes), capacity + 1):
        fits = order <= w
        gain = np.where(fits, best[np.maximum(w - order, 0)] + values, -1.0)
        i = int(gain.argmax())
        best[w], pick[w] = (gain[i], i) if gain[i] > best[w - 1] else (best[w - 1], -1)
    column, w = np.zeros(len(sizes)), capacity
    while w > 0:
        if pick[w] < 0:
            w -= 1
        else:
            column[pick[w]] += 1
            w -= sizes[pick[w]]
    return float(best[capacity]), column


def configurations(sizes: list[int], demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Configurations and how often to use each: the rounded-down optimum of the linear programme."""
    n = len(sizes)
    basis = np.diag([float(capacity // s) for s in sizes])
    x = demand / np.diag(basis)
    for _ in range(MAX_COLUMNS):
        duals = np.linalg.solve(basis.T, np.ones(n))
        value, column = _knapsack(np.maximum(duals, 0), sizes, capacity)
        if value <= 1 + 1e-7:
            break
        step = np.linalg.solve(basis, column)
        up = step > 1e-9
        if not up.any():
            break
        ratio = np.where(up, x / np.where(up, step, 1), np.inf)
        leave = int(ratio.argmin())
        x = np.maximum(x - ratio[leave] * step, 0)
        x[leave] = ratio[leave]
        basis[:, leave] = column
    return [(basis[:, k].copy(), int(x[k] + 1e-9)) for k in range(n) if int(x[k] + 1e-9)]


class Plan:
    """Runs of equal sequences. A run has ``count`` sequences and slots (length, first rank); a slot's piece in the
    run's j-th sequence has rank first + j."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.open: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}
        self.residuals: list[int] = []
        self.used: dict[int, int] = {}

    def add(self, count: int, slots: list[tuple[int, int]]) -> None:
        left = self.capacity - sum(length for length, _ in slots)
        if left not in self.open:
            self.open[left] = []
            insort(self.residuals, left)
        self.open[left].append((count, slots))

    def ranks(self, length: int, n: int) -> int:
        at = self.used.get(length, 0)
        self.used[length] = at + n
        return at

    def best_fit(self, length: int, count: int) -> None:
        """Put pieces into the fullest sequences that have room, then into new ones."""
        while count:
            i = bisect_left(self.residuals, length)
            if i == len(self.residuals):
                break
            left = self.residuals[i]
            n, slots = self.open[left].pop()
            if not self.open[left]:
                del self.open[left], self.residuals[i]
            take = min(n, count)
            if take < n:
                self.add(n - take, [(ln, at + take) for ln, at in slots])
            self.add(take, [*slots, (length, self.ranks(length, take))])
            count -= take
        per = self.capacity // length
        if count >= per:
            n = count // per
            self.add(n, [(length, self.ranks(length, n)) for _ in range(per)])
            count -= n * per
        if count:
            self.add(1, [(length, self.ranks(length, 1)) for _ in range(count)])

    def runs(self) -> list[tuple[int, list[tuple[int, int]]]]:
        return [run for left in self.residuals for run in self.open[left]]


def plan_packing(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS, large: tuple[float, ...] = LARGE) -> list[tuple[int, list[tuple[int, int]]]]:
    """Runs that hold every piece of the histogram (length: pieces) once."""
    return min((_plan(histogram, capacity, groups, share) for share in large), key=lambda runs: sum(n for n, _ in runs))


def _plan(histogram: dict[int, int], capacity: int, groups: int, share: float) -> list[tuple[int, list[tuple[int, int]]]]:
    plan = Plan(capacity)
    counts = {k: v for k, v in histogram.items() if v}
    for length in [k for k in counts if k == capacity]:
        plan.add(counts[length], [(length, plan.ranks(length, counts.pop(length)))])
    large, rest = {k: v for k, v in counts.items() if k > capacity * share}, {}
    if large:
        grouped = group_large(np.array(list(large)), np.array(list(large.values())), groups)
        sizes = [size for size, _ in grouped]
        stock = [list(members) for _, members in grouped]
        for column, times in configurations(sizes, np.array([float(sum(c for _, c in m)) for m in stock]), capacity):
            wanted = [g for g in range(len(sizes)) for _ in range(int(column[g]))]
            while times > 0 and wanted:
                # Actual pieces take the slots; a run ends where a group's next length begins.
                take, chosen, need = times, [], {}
                for g in wanted:
                    need[g] = need.get(g, 0) + 1
                for g, k in list(need.items()):
                    if not stock[g]:
                        wanted = [w for w in wanted if w != g]
                        need.pop(g)
                        continue
                    length, c = stock[g][0]
                    if c < k:
                        k = need[g] = c
                    take = min(take, c // k)
                if not need:
                    break
                for g, k in need.items():
                    length, c = stock[g][0]
                    chosen += [(length, plan.ranks(length, take)) for _ in range(k)]
                    stock[g][0] = (length, c - k * take)
                    if c == k * take:
                        stock[g].pop(0)
                plan.add(take, chosen)
                times -= take
        for length, c in (piece for members in stock for piece in members):
            rest[length] = rest.get(length, 0) + c
    small = {k: v for k, v in counts.items() if k not in large}
    for length, c in sorted((rest | small).items(), reverse=True):
        plan.best_fit(length, c)
    return plan.runs()


def lookup_table(runs) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted (length, first rank) keys with the first sequence and the offset of each slot."""
    keys, first, offset, sequence = [], [], [], 0
    for count, slots in runs:
        at = 0
        for length, rank in slots:
            keys.append(length << 48 | rank)
            first.append(sequence)
            offset.append(at)
            at += length
        sequence += count
    order = np.argsort(np.array(keys, np.int64), kind="stable")
    return np.array(keys, np.int64)[order], np.array(first, np.int64)[order], np.array(offset, np.int64)[order]


# --- the data -------------------------------------------------------------------------------------------------------

PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long, part int, nth long"


def token_pieces(df: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each piece, with its number among the pieces of that length in its partition."""

    def run(batches):
        from pyspark import TaskContext

        part, enc = TaskContext.get().partitionId(), encoder(tokenizer)
        seen = np.zeros(capacity + 1, np.int64)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                b = batch.slice(at, 256)
                rows = []
                for k, raw in zip(b.column(0).to_pylist(), enc.encode([t or "" for t in b.column(1).to_pylist()]), strict=True):
                    raw += end
                    n = len(raw) // 4
                    start, piece = 0, 0
                    stop = n % capacity or min(n, capacity)
                    while start < n:
                        length = stop - start
                        rows.append((k, piece, start, length, zlib.crc32(raw[4 * start : 4 * stop]), part, int(seen[length])))
                        seen[length] += 1
                        start, stop, piece = stop, stop + capacity, piece + 1
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    names = [c.split()[0] for c in PIECES.split(", ")]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64()]
    return df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, PIECES)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (written, as their numbers hold for one run only) with ``sequence_id`` and ``offset``."""
    counts = materialize(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "pack-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``capacity`` rows
    keys, first, offset = lookup_table(plan_packing(histogram, capacity))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    # One row for each length in each partition: counted, and broadcast only while there are few.
    ranked = pieces.join(F.broadcast(base) if counts.count() <= BROADCAST_COUNTS else base.hint("merge"), ["part", "length"])

    def run(batches):
        for b in batches:
            col = {n: b.column(i) for i, n in enumerate(b.schema.names)}
            length = col["length"].to_numpy(zero_copy_only=False).astype(np.int64)
            key = (length << 48) | (col["base"].to_numpy(zero_copy_only=False) + col["nth"].to_numpy(zero_copy_only=False))
            at = np.searchsorted(keys, key, side="right") - 1
            col["sequence_id"], col["offset"] = pa.array(first[at] + (key - keys[at])), pa.array(offset[at])
            names = [c.split()[0] for c in PACKED.split(", ")]
            yield pa.RecordBatch.from_arrays([col[n].cast(pa.int64()) if n == "length" else col[n] for n in names], names)

    return ranked.mapInArrow(run, PACKED)


PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def pack_documents(df: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    return pack(materialize(token_pieces(df, tokenizer, end_id), "pieces"))


def op4_packing(spark, sf_dir):
    import public_tokenizers

    return pack_documents(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
