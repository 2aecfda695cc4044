"""Packing documents into sequences by a configuration linear program (operator 9).

Every document is its token ids and the end id; only longer ones than a sequence are cut, into pieces
of the sequence's size but for the last.  A configuration is a multiset of lengths that fits a sequence.
The program over the histogram of lengths (at most as many rows as a sequence has tokens, whatever the
corpus) asks for the fewest configurations that cover every length as often as it occurs:

* pricing: an unbounded knapsack by dynamic programming gives the greatest price of a configuration; the
  walk back from each length gives configurations within a tolerance of it, many from one knapsack;
* multiplicative weights: a length's price is its tokens times a weight that falls exponentially with
  how often it has been covered.  A round covers each length at most once by configurations near the
  greatest price; tolerance and step are halved from phase to phase;
* gap: prices over the greatest price are a dual solution, so each round gives a lower bound; the rounds'
  mean, scaled so that every length is covered, is a solution.  They end within ``GAP`` of each other;
* rounding: the solution enters in whole sequences as long as there are pieces for them, then whole
  configurations of what is left by their prices; a last remainder is packed best-fit, longest first.
  Of several roundings the plan takes the one of fewest sequences (``report`` says what came from where).

The pieces of a length are numbered across the cluster (hashed buckets with offsets, so a length that a
third of all pieces share is numbered by many tasks) and take their places from the plan.

Null texts are empty and hold the end id alone.  Rows with null or repeated ids are documents of their
own; an empty table gives no row; only doc_id and text are read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import materialize, text_chunks, texts
from riskloom.llm.tokens import encoder

SEQUENCE = 2048
#: The program counts as solved within this share of its lower bound.
GAP = 0.01
#: Phases of the weights: tolerance and step start here and are halved from phase to phase, the rounds doubled.
START, PHASES, FIRST_ROUNDS = 0.1, 5, 8
#: Shares of the greatest price that whole configurations of what is left may lack, one after the other.
WHOLE = (0.0, 0.001, 0.004, 0.016)
#: Pieces that a task numbers together, about.
NUMBERED = 10_000

Configuration = tuple[tuple[int, int], ...]  # (length, how often), longest first


def pieces(docs: DataFrame, path: str, end_id: int, sequence: int = SEQUENCE, *, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every document."""

    def cut(batches):
        for batch in batches:
            for chunk in text_chunks(batch):
                ids, at = encoder(path).encode(chunk.column("text"))
                rows: list[list] = [[], [], [], [], []]
                for key, a, b in zip(chunk.column("doc_id").to_pylist(), at[:-1], at[1:], strict=True):
                    own = np.append(ids[a:b], np.uint32(end_id)).astype("<u4")
                    for k, start in enumerate(range(0, len(own), sequence)):
                        part = own[start : start + sequence]
                        for column, value in zip(rows, (key, k, start, len(part), zlib.crc32(part)), strict=True):
                            column.append(value)
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return texts(docs, id_col, text_col).mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def knapsack(price: np.ndarray, capacity: int) -> np.ndarray:
    """value[c]: the greatest price of pieces of at most c tokens together, by dynamic programming.
    price[l - 1] is that of length l, 0 if it is not there; a length may be used any number of times."""
    value = np.zeros(capacity + 1)
    lengths = np.flatnonzero(price) + 1
    worth = price[lengths - 1]
    within = np.searchsorted(lengths, np.arange(capacity + 1), "right")
    for c in range(1, capacity + 1):
        k = within[c]
        value[c] = max(value[c - 1], (value[c - lengths[:k]] + worth[:k]).max()) if k else value[c - 1]
    return value


def configuration(value: np.ndarray, price: np.ndarray, room: np.ndarray, first: int, slack: float, need: np.ndarray | None = None) -> dict[int, int] | None:
    """A configuration with a piece of length ``first`` whose price is at most ``slack`` below the greatest
    one, value[-1], with no more pieces of a length than ``room`` has; None if the walk back through the
    knapsack finds none.  Of the pieces that keep within the slack it takes the longest, or, given
    ``need``, those of which the greatest share is still there."""
    out = {first: 1}
    room[first - 1] -= 1
    c = len(value) - 1 - first
    slack += price[first - 1] + value[c] - value[-1]
    while c > 0 and slack > -1e-9:
        lost = np.where((room[:c] > 0) & (price[:c] > 0), value[c] - price[:c] - value[c - 1 :: -1], np.inf)
        fits = np.flatnonzero(lost <= slack + 1e-9)
        if not fits.size:
            break
        length = int(fits[-1] if need is None else fits[(room[fits] / need[fits]).argmax()]) + 1
        slack -= max(lost[length - 1], 0.0)
        out[length] = out.get(length, 0) + 1
        room[length - 1] -= 1
        c -= length
    for length, a in out.items():
        room[length - 1] += a
    return out if value[c] <= slack + 1e-9 else None


def one_round(price: np.ndarray, left: np.ndarray, tolerance: float, *, spread: bool) -> tuple[dict[Configuration, int], float]:
    """Whole configurations of at least 1 - ``tolerance`` of the greatest price, with no more pieces than
    are ``left`` (reduced by them), and the greatest price; ``spread``: they cover lengths evenly."""
    capacity = len(price)
    value = knapsack(price, capacity)
    slack, need = tolerance * value[-1], np.maximum(left, 1).astype(float) if spread else None
    made: dict[Configuration, int] = {}
    for length in (np.flatnonzero((left > 0) & (price > 0))[::-1] + 1).tolist():
        while left[length - 1] and price[length - 1] + value[capacity - length] >= value[-1] - slack - 1e-9:
            chosen = configuration(value, price, left, length, slack, need)
            if chosen is None:
                break
            times = min(int(left[n - 1]) // a for n, a in chosen.items())
            key = tuple(sorted(chosen.items(), reverse=True))
            made[key] = made.get(key, 0) + times
            for n, a in chosen.items():
                left[n - 1] -= a * times
    return made, float(value[-1])


def fractional(count: np.ndarray) -> tuple[dict[Configuration, float], float, np.ndarray]:
    """A solution of the program that covers every length of ``count``, a lower bound of the program's
    value and the last prices.  The sum of the solution is at most 1 + ``GAP`` times the bound, unless
    ``PHASES`` end first."""
    some = count > 0
    log, bound = np.log(np.arange(1, len(count) + 1)), 0.0
    best: dict[Configuration, float] = {}
    for phase in range(PHASES if some.any() else 0):
        tolerance = START / 2**phase
        used: dict[Configuration, int] = {}
        covered, total = np.zeros(len(count)), 0
        for _ in range(FIRST_ROUNDS << phase):
            price = np.where(some, np.exp(log - log[some].max()), 0.0)
            left = count.copy()
            made, greatest = one_round(price, left, tolerance, spread=True)
            bound = max(bound, float((price * count).sum()) / greatest)
            share = np.where(some, (count - left) / np.maximum(count, 1), 0.0)
            covered += share
            log -= tolerance * share
            for key, times in made.items():
                used[key] = used.get(key, 0) + times
                total += times
            scarcest = float(covered[some].min())
            if scarcest and (not best or total / scarcest < sum(best.values())):
                best = {key: x / scarcest for key, x in used.items()}
            if best and sum(best.values()) <= (1 + GAP) * bound:
                return best, bound, price
    return best, bound, price if some.any() else np.zeros(len(count))


def rounded(solution: dict[Configuration, float], left: np.ndarray) -> dict[Configuration, int]:
    """Whole sequences of a fractional solution, most used first; ``left`` is reduced by their pieces."""
    made: dict[Configuration, int] = {}
    for key, x in sorted(solution.items(), key=lambda c: -c[1]):
        times = min(int(x + 1e-9), *(int(left[n - 1]) // a for n, a in key))
        if times > 0:
            made[key] = times
            for n, a in key:
                left[n - 1] -= a * times
    return made


def roundings(count: np.ndarray, solution: dict[Configuration, float], price: np.ndarray) -> list[tuple[dict[Configuration, int], np.ndarray]]:
    """(whole sequences, pieces left) of several roundings of the program.  The solution enters in whole
    sequences or not at all; of what is left, of whose configurations less than one is used, whole ones
    enter by the last prices or by the first (the lengths), the dearest first, up to some tolerance."""
    out = []
    for start in (solution, {}) if solution else ():
        for worth in (price, np.arange(1.0, len(count) + 1)):
            left = count.copy()
            made = rounded(start, left)
            for tolerance in WHOLE:
                _add(made, one_round(np.where(left > 0, worth, 0.0), left, tolerance, spread=False)[0])
                out.append((dict(made), left.copy()))
    return out


def _add(made: dict[Configuration, int], more: dict[Configuration, int]) -> None:
    for key, times in more.items():
        made[key] = made.get(key, 0) + times


def best_fit(count: np.ndarray, capacity: int) -> dict[Configuration, int]:
    """Best-fit decreasing over a histogram; equal sequences are handled together."""
    free: list[int] = []  # the free sizes there are, ascending
    groups: dict[int, list[list]] = {}  # free size: [configuration, how many]

    def put(size: int, configuration: Configuration, n: int) -> None:
        if size not in groups:
            groups[size] = []
            insort(free, size)
        groups[size].append([configuration, n])

    for length in range(capacity, 0, -1):
        left = int(count[length - 1])
        while left:
            at = bisect_left(free, length)
            if at == len(free):
                put(capacity, (), left)
                continue
            size = free[at]
            configuration, n = groups[size].pop()
            if not groups[size]:
                del groups[size], free[at]
            each = min(size // length, left)
            full = min(n, left // each)
            put(size - each * length, (*configuration, (length, each)), full)
            left -= full * each
            if n > full:
                put(size, configuration, n - full)
    out: dict[Configuration, int] = {}
    for members in groups.values():
        for configuration, n in members:
            if configuration:
                out[configuration] = out.get(configuration, 0) + n
    return out


def plan(count: np.ndarray, capacity: int = SEQUENCE) -> list[tuple[Configuration, int]]:
    """Configurations and how often each is made, for a histogram (count[l - 1] pieces of length l)."""
    return report(count, capacity)["plan"]


def report(count: np.ndarray, capacity: int = SEQUENCE) -> dict:
    """The ``plan``, and where it comes from: the program's ``value`` and lower ``bound`` (full pieces
    included), sequences ``by_program`` and of the ``remainder`` (best-fit), and those of best-fit alone,
    which is never better than the plan."""
    left = count.astype(np.int64).copy()
    whole = int(left[capacity - 1])
    left[capacity - 1] = 0
    alone = best_fit(left, capacity)
    solution, bound, price = fractional(left)
    tried = [({}, alone)]
    for made, rest in roundings(left, solution, price):
        tried.append((made, best_fit(rest, capacity)))
    # The fewest sequences, and of equally many those with the most from the program.
    made, remainder = min(tried, key=lambda t: (sum(t[0].values()) + sum(t[1].values()), sum(t[1].values())))
    value, by = sum(solution.values()), sum(made.values())
    _add(made, remainder)
    if whole:
        _add(made, {((capacity, 1),): whole})
    planned = sorted(made.items(), key=lambda c: (-c[1], c[0]))
    return {"plan": planned, "value": value + whole, "bound": bound + whole, "by_program": by + whole, "remainder": sum(remainder.values()), "best_fit": sum(alone.values()) + whole}


def places(planned: list[tuple[Configuration, int]]) -> np.ndarray:
    """Rows (length, first number, how often in one sequence, first sequence, offset) by length and
    first number: which of a length's numbered pieces stand in which sequences of the plan."""
    rows, base, number = [], 0, {}
    for key, times in planned:
        offset = 0
        for length, a in key:
            rows.append((length, number.get(length, 0), a, base, offset))
            number[length] = number.get(length, 0) + a * times
            offset += a * length
        base += times
    out = np.array(rows, np.int64).reshape(-1, 5)
    return out[np.lexsort((out[:, 1], out[:, 0]))]


def pack(docs: DataFrame, path: str, end_id: int, sequence: int = SEQUENCE, *, id_col="doc_id", text_col="text") -> DataFrame:
    """``pieces`` with sequence_id and offset."""
    cut = materialize(pieces(docs, path, end_id, sequence, id_col=id_col, text_col=text_col), "pieces")
    histogram = np.zeros(sequence, np.int64)
    for row in cut.groupBy("length").count().collect():  # at most ``sequence`` rows
        histogram[row["length"] - 1] = row["count"]
    table = places(plan(histogram, sequence))
    # As many buckets for a length as its pieces fill: at most ``sequence`` rows of sizes.
    cuts = [(n + 1, max(1, -(-int(k) // NUMBERED))) for n, k in enumerate(histogram) if k]
    cuts = docs.sparkSession.createDataFrame(cuts, "length long, cuts long")
    hashed = cut.join(F.broadcast(cuts), "length").withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("cuts"))).drop("cuts")
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = hashed.groupBy("length", "bucket").agg(F.count("*").alias("n")).select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    numbered = hashed.withColumn("k", F.row_number().over(within)).join(sizes, ["length", "bucket"])
    numbered = numbered.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("k") - 1).alias("number"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]

    def place(batches):
        keys = (table[:, 0] << 44) + table[:, 1]
        for batch in batches:
            length, number = (batch.column(c).to_numpy() for c in ("length", "number"))
            row = table[np.searchsorted(keys, (length << 44) + number, "right") - 1]
            k = number - row[:, 1]
            found = [row[:, 3] + k // row[:, 2], row[:, 4] + (k % row[:, 2]) * length]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], *map(pa.array, found)], names=names)

    return numbered.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
