"""Packing documents into training sequences: a grouping genetic algorithm over lengths.

Pieces of equal length are interchangeable, so a packing is a list of bins, each a
group of lengths, with how often each is used. The search sees only the number of
pieces of each length: its size is bounded by the capacity, not by the documents.

Individuals are groups of bins. Crossover injects whole well-filled bins of one parent
into the other, removes the bins whose pieces are then used twice, lets the pieces that
this displaces replace smaller ones in badly filled bins, and best-fits the rest. Islands evolve in tasks of their own; after each epoch an
island sends its best individual to the next one. Pieces then take the places of their
length by rank.
"""

from __future__ import annotations

import json
import random
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from swishline.llm import bpe
from swishline.llm.tables import lookup_side, slices
from swishline.sources.scratch import written

END_ID = 2
REPLACED_KINDS, REPLACED_TIMES = 24, 8  # of bins, and of changes to one of them

Bins = dict[tuple[int, ...], int]  # lengths in falling order -> how many such bins


@dataclass(frozen=True)
class Search:
    """``well_filled``: share of the capacity from which a bin may be injected whole."""

    islands: int = 6
    epochs: int = 3
    generations: int = 12
    population: int = 6
    well_filled: float = 0.995
    seed: int = 1


# --- the search over lengths ---------------------------------------------------------


def best_fit(lengths: list[tuple[int, int]], capacity: int, start: Bins | None = None) -> Bins:
    """Put ``lengths`` (length, how many), in this order, each where least room is left."""
    by_room: dict[int, list[list]] = {}
    open_rooms = 0  # bit r is set if a bin with room r is open
    done: Bins = Counter()

    def put(bin_: tuple[int, ...], room: int, count: int) -> None:
        nonlocal open_rooms
        if room:
            by_room.setdefault(room, []).append([bin_, count])
            open_rooms |= 1 << room
        else:
            done[bin_] += count

    for bin_, count in (start or {}).items():
        put(bin_, capacity - sum(bin_), count)
    for length, count in lengths:
        while count:
            fitting = open_rooms >> length
            if fitting:
                room = length + (fitting & -fitting).bit_length() - 1
                bin_, copies = by_room[room].pop()
                if not by_room[room]:
                    open_rooms &= ~(1 << room)
            else:
                room, bin_, copies = capacity, (), count
            each = min(room // length, count)
            used = min(copies, count // each)
            put(tuple(sorted((*bin_, *[length] * each), reverse=True)), room - each * length, used)
            if bin_ and copies > used:
                put(bin_, room, copies - used)
            count -= used * each
    for room, bins in by_room.items():
        for bin_, count in bins:
            if room < capacity:
                done[bin_] += count
    return dict(done)


def cost(bins: Bins, capacity: int) -> tuple[int, int]:
    """Fewer bins first; then bins filled unevenly, which leave room that can be used."""
    return sum(bins.values()), -sum(n * sum(b) ** 2 for b, n in bins.items())


def cross(
    a: Bins, b: Bins, pieces: Counter, capacity: int, rng: random.Random, well: float
) -> Bins:
    """``a`` with some well-filled bins of ``b``: the method's crossover."""
    left = Counter(pieces)
    child: Bins = Counter()

    def take(bin_: tuple[int, ...], most: int) -> None:
        needs = Counter(bin_)
        count = min([most, *(left[x] // n for x, n in needs.items())])
        if count > 0:
            child[bin_] += count
            for x, n in needs.items():
                left[x] -= n * count

    chosen = [x for x in b if sum(x) >= well * capacity and rng.random() < 0.5]
    for bin_ in chosen:
        take(bin_, b[bin_])
    own = list(a)
    rng.shuffle(own)
    dropped = set(sorted(own, key=sum)[: rng.randint(0, 8)])
    for bin_ in sorted(own, key=lambda x: -sum(x)):
        if bin_ not in dropped:
            take(bin_, a[bin_])
    displaced = Counter({x: n for x, n in left.items() if n})
    replace(child, displaced, capacity)
    return best_fit(sorted(displaced.items(), reverse=True), capacity, child)


def replace(bins: Bins, displaced: Counter, capacity: int) -> None:
    """Before they are best-fitted, displaced pieces take the place of one or two smaller
    ones in the bins with the most room, where that fills the bin better: the smaller the
    pieces that are left over, the better they fit. Changes both arguments."""
    worst = sorted((b for b in bins if sum(b) < capacity), key=lambda b: (sum(b), b))
    for bin_ in worst[:REPLACED_KINDS]:
        for _ in range(REPLACED_TIMES):
            found = _better(bin_, sorted(displaced), displaced, capacity)
            if not found:
                break
            out, into = found
            needs = Counter(into)
            count = min([bins[bin_], *(displaced[x] // n for x, n in needs.items())])
            rest = list(bin_)
            for x in out:
                rest.remove(x)
                displaced[x] += count
            for x, n in needs.items():
                displaced[x] -= n * count
                if not displaced[x]:
                    del displaced[x]
            bins[bin_] -= count
            if not bins[bin_]:
                del bins[bin_]
            bin_ = tuple(sorted((*rest, *into), reverse=True))
            bins[bin_] = bins.get(bin_, 0) + count


def _better(bin_: tuple, lengths: list[int], displaced: Counter, capacity: int) -> tuple | None:
    """Pieces of the bin and displaced ones that fill it best in their place."""
    room, best = capacity - sum(bin_), None
    own = [(x,) for x in set(bin_)] + list(set(combinations(bin_, 2)))
    for out in own:
        low, high = sum(out), sum(out) + room
        at = bisect_right(lengths, high) - 1
        if at >= 0 and lengths[at] > (best[0] if best else 0) + low:
            best = lengths[at] - low, out, (lengths[at],)
        if len(out) == 2:
            i, j = 0, len(lengths) - 1
            while i <= j:
                total = lengths[i] + lengths[j]
                if total > high:
                    j -= 1
                    continue
                enough = i < j or displaced[lengths[i]] > 1
                if enough and total - low > (best[0] if best else 0):
                    best = total - low, out, (lengths[j], lengths[i])
                i += 1
        if best and best[0] == room:
            break
    return best[1:] if best else None


def _as_text(bins: Bins) -> str:
    return json.dumps([[n, *b] for b, n in sorted(bins.items())])


def _as_bins(text: str) -> Bins:
    return {tuple(b): n for n, *b in json.loads(text)}


def _first_individual(pieces: Counter, capacity: int, rng: random.Random) -> Bins:
    """Best fit of a part of the pieces in random order after the rest in falling order."""
    order = sorted(pieces.items(), reverse=True)
    late = [x for x in order if rng.random() < 0.1]
    early = [x for x in order if x not in late]
    rng.shuffle(late)
    return best_fit(early + late, capacity)


def _evolved(rows: pd.DataFrame, pieces: Counter, capacity: int, s: Search) -> pd.DataFrame:
    island, epoch = int(rows["island"].iloc[0]), int(rows["epoch"].max())
    rng = random.Random(f"{s.seed} {island} {epoch}")
    own = [_as_bins(t) for t in rows["bins"].dropna()]
    while len(own) < s.population:
        falling = not own and not island  # one individual of all is plain best fit
        own.append(
            best_fit(sorted(pieces.items(), reverse=True), capacity)
            if falling
            else _first_individual(pieces, capacity, rng)
        )
    least = -(-sum(x * n for x, n in pieces.items()) // capacity)
    for _ in range(s.generations):
        own.sort(key=lambda bins: cost(bins, capacity))
        if cost(own[0], capacity)[0] == least:
            break  # no packing has fewer bins
        a, b = rng.sample(own[: max(2, s.population // 2)], 2) if len(own) > 1 else (own[0], own[0])
        own = own[: s.population - 1] + [cross(a, b, pieces, capacity, rng, s.well_filled)]
    own = sorted(own, key=lambda bins: cost(bins, capacity))[: s.population]
    costs = [cost(bins, capacity) for bins in own]
    return pd.DataFrame(
        {
            "island": island,
            "epoch": epoch + 1,
            "place": range(len(own)),
            "n_bins": [c[0] for c in costs],
            "evenness": [c[1] for c in costs],
            "bins": [_as_text(bins) for bins in own],
        }
    )


_POPULATION = "island int, epoch int, place int, n_bins bigint, evenness bigint, bins string"


def pack_lengths(spark: SparkSession, pieces: Counter, capacity: int, s: Search = Search()) -> Bins:
    """The best packing that the islands find for ``pieces`` (length -> how many)."""
    if not pieces:
        return {}
    islands = spark.range(s.islands).selectExpr(
        "cast(id AS int) AS island", "0 AS epoch", "cast(null AS string) AS bins"
    )

    def evolve(rows: pd.DataFrame) -> pd.DataFrame:
        return _evolved(rows, pieces, capacity, s)

    for _ in range(s.epochs):
        found = written(islands.groupBy("island").applyInPandas(evolve, _POPULATION), "islands")
        kept = found.select("island", "epoch", "bins")
        sent = found.where("place = 0").selectExpr(
            f"cast((island + 1) % {s.islands} AS int) AS island", "epoch", "bins"
        )
        islands = kept.unionAll(sent)
    best = found.orderBy("n_bins", "evenness", "island", "place").select("bins").first()
    return _as_bins(best[0])


# --- pieces and their places ---------------------------------------------------------


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of ``n`` tokens: only the first may be shorter."""
    first = (n - 1) % capacity + 1
    starts = [0, *range(first, n, capacity)]
    return [(s, (first if not s else capacity)) for s in starts]


def pieces_of(docs: DataFrame, capacity: int, vocabulary: str, end_id: int) -> DataFrame:
    """Every document's pieces, numbered by length within their task."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "rank"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = bpe.encoder(bpe.vocabulary(vocabulary))
        task, met = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        end = np.array([end_id], "<u4").tobytes()
        for part in slices(batches, "text", bpe.SLICE_BYTES):
            ids, ends = encoder.encode(part["text"])
            raw = memoryview(ids.astype("<u4").tobytes())
            rows = []
            for doc, (low, high) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
                text = b"".join((raw[4 * low : 4 * high], end))
                for k, (start, length) in enumerate(cut(int(high - low) + 1, capacity)):
                    crc = zlib.crc32(text[4 * start : 4 * (start + length)])
                    rows.append((doc, k, start, length, crc, task, met[length]))
                    met[length] += 1
            columns = list(np.array(rows, np.int64).T)
            kinds = [pa.int32(), *[pa.int64()] * 3, pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [
                    part["doc_id"].take(pa.array(columns[0])),
                    *(pa.array(c).cast(k) for c, k in zip(columns[1:], kinds, strict=True)),
                ],
                names,
            )

    schema = (
        "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, "
        "task int, rank bigint"
    )
    texts = docs.select(F.col("doc_id").cast("bigint"), "text")
    return written(texts.mapInArrow(run, schema), "pieces")


def places(bins: Bins, capacity: int, rounds: int = 1) -> dict[str, np.ndarray]:
    """By length and first rank: sequence and offset of the pieces from that rank on.

    Every round takes about the same share of each kind of bin, so that the sequences of a
    round hold about the same part of the ranks of every length.
    """
    taken: Counter = Counter()
    rows, sequence = [], 0
    kinds = sorted(bins.items(), reverse=True)
    # where a kind's rounds begin, so that kinds of few bins do not all fall into one round
    shift = [int(rounds * (k * 0.618034 % 1)) for k in range(len(kinds))]
    for r in range(rounds):
        for (bin_, whole), s in zip(kinds, shift, strict=True):
            count = (whole * (r + 1) + s) // rounds - (whole * r + s) // rounds
            if not count:
                continue
            offset = 0
            for length in bin_:
                rows.append((length, taken[length], sequence, offset))
                taken[length] += count
                offset += length
            sequence += count
    rows.sort()
    length, rank, sequence_id, offset = np.array(rows, np.int64).reshape(-1, 4).T
    return {"key": (length << 40) + rank, "sequence": sequence_id, "offset": offset}


def pack(
    docs: DataFrame,
    capacity: int = 1024,
    vocabulary: str = bpe.BYTE_BPE,
    end_id: int = END_ID,
    search: Search = Search(),
    rounds: int = 1,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Pieces of one length go to sequences in the order of the rows of ``docs``: partitions
    one after the other. With more ``rounds`` the sequences as wholes follow that order.

    Every row of ``docs`` is a document, repeated ones too; null and empty texts are
    their end id alone; a null doc_id stays null; other columns are left out.
    """
    pieces = pieces_of(docs, capacity, vocabulary, end_id)
    counts = written(pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")), "counts")
    total = Counter(
        {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    )  # at most one row per length up to the capacity
    bins = pack_lengths(docs.sparkSession, total, capacity, search)
    found = docs.sparkSession.sparkContext.broadcast(places(bins, capacity, rounds))

    earlier = Window.partitionBy("length").orderBy("task")
    so_far = F.sum("n").over(earlier.rowsBetween(Window.unboundedPreceding, -1))
    before = counts.select("task", "length", F.coalesce(so_far, F.lit(0)).alias("before"))
    ranked = pieces.join(lookup_side(written(before, "before")), ["task", "length"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = found.value
        for batch in batches:
            length = batch["length"].to_numpy(False).astype(np.int64)
            key = (length << 40) + batch["rank"].to_numpy(False)
            at = np.searchsorted(table["key"], key, "right") - 1
            sequence = table["sequence"][at] + key - table["key"][at]
            kept = [batch[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence), pa.array(table["offset"][at])],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    rank = (F.col("rank") + F.col("before")).alias("rank")
    return ranked.select(
        "doc_id", "piece", "start", "length", "ids_crc32", rank
    ).mapInArrow(
        run,
        "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, "
        "sequence_id bigint, offset bigint",
    )
