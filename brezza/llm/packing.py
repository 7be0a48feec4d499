"""Items of varying length into containers of fixed capacity, by a grouping genetic algorithm on islands.

An item is never split unless it alone exceeds the capacity: then it fills whole containers, and what remains is an item.
Items are dealt at random to shards of about ``SHARD_ITEMS``; each shard is solved on ``ISLANDS`` islands, each with a population of its own that begins
from other orders of the items.  Crossover injects whole well-filled containers of one parent into another, removes the containers there that hold one of
their items twice over, and settles displaced items in place of smaller ones that leave less room, else where they fit best.  After every ``GENERATIONS``
children the best solution of each island migrates to all islands of its shard.  Containers that stay well filled are kept; the items of the others
are dealt to new shards and packed again, so that half-empty containers do not add up over the shards.

Scale: only (key, size) pairs are shuffled, never texts; between the islands travel sizes and container numbers.  A shard has a bounded number of items
whatever the keys, as it is dealt from a hash over key, size, part and number of the copy; sizes are worked out once and written to the checkpoint
folder, as is each round's result.
"""

from __future__ import annotations

import random
from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Iterator, Sequence
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brezza.operators.checkpoints import shared_checkpoint

CAPACITY = 2048
SHARD_ITEMS = 1024
ISLANDS = 3
POPULATION = 8
#: Children per island before each migration, and migrations.
GENERATIONS = 40
MIGRATIONS = 2
WELL_FILLED = 0.995
SEED = 20
# Pairs of displaced items are tried in place of pairs while so few are displaced; single items are tried always.
_PAIRS_OF = 32

Solution = list[list[int]]


def best_fit(sizes: Sequence[int], order: Sequence[int], capacity: int, bins: Solution | None = None) -> Solution:
    """Puts the items of ``order`` one by one where the least room remains, into the given containers or new ones."""
    bins = [list(b) for b in bins] if bins else []
    rooms = sorted((capacity - sum(sizes[i] for i in b), k) for k, b in enumerate(bins))
    for i in order:
        at = bisect_left(rooms, (sizes[i], -1))
        if at < len(rooms):
            room, k = rooms.pop(at)
            bins[k].append(i)
        else:
            room, k = capacity, len(bins)
            bins.append([i])
        if room > sizes[i]:
            insort(rooms, (room - sizes[i], k))
    return bins


def fitness(sizes: Sequence[int], bins: Solution, capacity: int) -> tuple[int, float]:
    """Fewer containers are better, then more uneven filling (the mean square of the fills)."""
    return -len(bins), sum((sum(sizes[i] for i in b) / capacity) ** 2 for b in bins) / max(1, len(bins))


def _settle(sizes: Sequence[int], bins: Solution, displaced: list[int], capacity: int) -> Solution:
    """Displaced items go into the containers: first in place of one or two smaller items that leave less room, then where they fit best.

    What a container gives up for a fuller one is smaller than what it takes, so that the rest becomes easier to place.
    """
    free = sorted((sizes[i], i) for i in displaced)
    bins = [list(b) for b in bins]
    for b in bins:
        room = capacity - sum(sizes[i] for i in b)
        if not room or not free:
            continue
        for out in (*((i,) for i in b), *combinations(b, 2)):
            given = sum(sizes[i] for i in out)
            at = bisect_right(free, (given + room, len(sizes))) - 1
            if at >= 0 and free[at][0] > given:
                taken = [free[at]]
            elif len(out) == 2 and 1 < len(free) <= _PAIRS_OF:
                taken = _best_pair(free, given, given + room)
            else:
                taken = []
            if taken:
                for pair in taken:
                    free.remove(pair)
                    b.append(pair[1])
                for i in out:
                    b.remove(i)
                    insort(free, (sizes[i], i))
                break
    return best_fit(sizes, [i for _, i in reversed(free)], capacity, bins)


def _best_pair(free: list[tuple[int, int]], more_than: int, at_most: int) -> list[tuple[int, int]]:
    """The two of a sorted list that together are largest within bounds."""
    low, high, best, found = 0, len(free) - 1, more_than, []
    while low < high:
        both = free[low][0] + free[high][0]
        if both > at_most:
            high -= 1
        else:
            if both > best:
                best, found = both, [free[low], free[high]]
            low += 1
    return found


def crossover(sizes: Sequence[int], giver: Solution, taker: Solution, capacity: int, chance: random.Random) -> Solution:
    """A child of ``taker`` with some of the best-filled containers of ``giver``."""
    ranked = sorted(giver, key=lambda b: -sum(sizes[i] for i in b))
    filled = ranked[: max(1, len(ranked) // 2)]
    injected = chance.sample(filled, chance.randint(1, max(1, min(len(filled), 1 + len(ranked) // 8))))
    taken = {i for b in injected for i in b}
    kept, displaced = [], []
    for b in taker:
        if taken.isdisjoint(b):
            kept.append(b)
        else:
            displaced.extend(i for i in b if i not in taken)
    # Mutation: the worst-filled containers and some others give their items up as well.
    kept.sort(key=lambda b: sum(sizes[i] for i in b))
    for _ in range(min(len(kept), 1 + len(kept) // 50)):
        displaced.extend(kept.pop(0))
    for _ in range(min(len(kept), chance.randint(0, 2))):
        displaced.extend(kept.pop(chance.randrange(len(kept))))
    chance.shuffle(kept)
    return _settle(sizes, [*injected, *kept], displaced, capacity)


def first_solutions(sizes: Sequence[int], capacity: int, island: int, number: int, chance: random.Random) -> Iterator[Solution]:
    """The population that an island begins with: the first of decreasing orders, the others of orders ever more shaken, the last of any order."""
    decreasing = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    shake = min(1.0, island / max(1, ISLANDS - 1))
    if island == 0:
        yield best_fit(sizes, decreasing, capacity)
    for _ in range(number - (island == 0)):
        yield best_fit(sizes, sorted(decreasing, key=lambda i: -sizes[i] * (1 - shake) * chance.uniform(0.8, 1.2) - shake * capacity * chance.random()), capacity)


def evolve(
    sizes: Sequence[int], capacity: int, seed: int, people: Sequence[Solution] = (), island: int = 0, population: int | None = None, generations: int | None = None
) -> list[Solution]:
    """The population of an island after so many children, the best solution first.

    It begins with the given solutions, filled up with ``first_solutions`` while none is known to be the best.  A solution with as few containers as the sum of the sizes needs cannot be
    bettered and ends the search.
    """
    population, generations = population or POPULATION, GENERATIONS if generations is None else generations
    chance = random.Random(seed)
    fewest = -(-sum(sizes) // capacity)
    ranked = [(fitness(sizes, s, capacity), [list(b) for b in s]) for s in people]
    for s in first_solutions(sizes, capacity, island, population - len(ranked), chance) if len(ranked) < population else ():
        if any(len(known) <= fewest for _, known in ranked):
            break
        ranked.append((fitness(sizes, s, capacity), s))
    ranked.sort(key=lambda r: r[0], reverse=True)
    for _ in range(generations):
        if -ranked[0][0][0] <= fewest:
            break
        giver, taker = (min(chance.sample(range(len(ranked)), min(2, len(ranked)))) for _ in range(2))
        child = crossover(sizes, ranked[giver][1], ranked[taker][1], capacity, chance)
        rank = fitness(sizes, child, capacity)
        # A child takes the place of the worst one, unless it is worse or there is one like it.
        if rank > ranked[-1][0] and all(rank != r for r, _ in ranked):
            ranked[-1] = (rank, child)
            ranked.sort(key=lambda r: r[0], reverse=True)
    return [s for _, s in ranked]


def as_items(documents: DataFrame, key: str, size: str, capacity: int = CAPACITY) -> DataFrame:
    """``key, part, start, tokens, whole``: the full containers that long documents fill (``whole``) and the items that remain."""
    full, rest = F.floor(F.col(size) / capacity), F.col(size) % capacity
    pieces = F.when(F.col(size) > 0, F.sequence(F.lit(0).cast("bigint"), F.ceil(F.col(size) / capacity) - 1))
    cut = documents.select(F.col(key), F.col(size).alias("_size"), full.alias("_full"), rest.alias("_rest"), F.explode(pieces).alias("_part"))
    return cut.select(
        key,
        F.col("_part").cast("int").alias("part"),
        (F.col("_part") * capacity).alias("start"),
        F.when(F.col("_part") < F.col("_full"), F.lit(capacity).cast("bigint")).otherwise(F.col("_rest")).alias("tokens"),
        (F.col("_part") < F.col("_full")).alias("whole"),
    )


def _copies(documents: DataFrame, key: str, size: str) -> DataFrame:
    """``_key, _n, _copy`` of every row: rows that repeat are told apart by a number, so that nothing depends on where a row lies.

    They are counted before the shuffle, and numbered in blocks, so that no array is longer than the root of their number or ``SHARD_ITEMS``.
    """
    block = F.lit(SHARD_ITEMS).cast("bigint")
    sized = documents.select(F.col(key).alias("_key"), F.greatest(F.coalesce(F.col(size), F.lit(0)), F.lit(0)).cast("bigint").alias("_n"))
    counted = sized.groupBy("_key", "_n").agg(F.count(F.lit(1)).alias("_c"))
    blocks = counted.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_c") - 1) / block))).alias("_b"))
    first = F.col("_b") * block
    return blocks.select("_key", "_n", F.explode(F.sequence(first, F.least(first + block, F.col("_c")) - 1)).alias("_copy"))


def _solve(items: DataFrame, capacity: int, round_: int, number: int) -> DataFrame:
    """``_key, part, start, tokens, deal, shard, bin, fill`` of ``number`` items that have a ``deal`` (a hash that tells them apart)."""
    spark = items.sparkSession
    islands, migrations, population, generations = ISLANDS, MIGRATIONS, POPULATION, GENERATIONS
    shards = max(1, -(-number // SHARD_ITEMS))
    # In a fixed order, so that a solution is a list of container numbers.
    item = F.struct("deal", "part", "start", "tokens", "_key")
    dealt = items.withColumn("shard", F.pmod(F.xxhash64("deal", F.lit(round_)), F.lit(shards))).groupBy("shard").agg(F.sort_array(F.collect_list(item)).alias("items"))
    dealt = shared_checkpoint(dealt)
    state = dealt.select("shard", F.col("items.tokens").alias("sizes"), F.lit(None).cast("array<array<int>>").alias("people"))
    solutions = "array<array<int>>"
    schema = f"shard bigint, island int, sizes array<bigint>, people {solutions}, bins int, evenness double"
    # The tasks are heavy for the little they read, so that their number is stated; it grows with the shards.
    tasks = max(1, min(shards * islands, max(3 * spark.sparkContext.defaultParallelism, shards * islands // 32)))

    def on_islands(step: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for shard, island, sizes, people in zip(*(b.column(c).to_pylist() for c in ("shard", "island", "sizes", "people")), strict=True):
                    begun = [list(_containers(s).values()) for s in people or []]
                    found = evolve(sizes, capacity, hash((SEED, round_, step, shard, island)), begun, island, population, generations)
                    fewer, evenness = fitness(sizes, found[0], capacity)
                    yield pa.RecordBatch.from_pylist(
                        [{"shard": shard, "island": island, "sizes": sizes, "people": [_numbered(s, len(sizes)) for s in found], "bins": -fewer, "evenness": evenness}],
                        schema=pa.schema([("shard", pa.int64()), ("island", pa.int32()), ("sizes", pa.list_(pa.int64())), ("people", pa.list_(pa.list_(pa.int32()))), ("bins", pa.int32()), ("evenness", pa.float64())]),
                    )

        return run

    for step in range(migrations + 1):
        if step:
            # The best of each island goes to all islands of its shard; the others stay at home.
            gathered = state.groupBy("shard").agg(F.first("sizes").alias("sizes"), F.sort_array(F.collect_list(F.struct("island", "people"))).alias("all"))
            elite = F.transform("all", lambda a: F.get(a["people"], F.lit(0)))
            each = gathered.select("shard", "sizes", elite.alias("elite"), F.inline("all"))
            state = each.select("shard", "island", "sizes", F.slice(F.concat("elite", F.slice("people", 2, population)), 1, population).alias("people"))
        else:
            state = state.select("shard", F.explode(F.array(*(F.lit(k) for k in range(islands)))).alias("island"), "sizes", "people")
        state = state.repartition(tasks, "shard", "island").mapInArrow(on_islands(step), schema)
    best = state.groupBy("shard").agg(F.min_by(F.get("people", F.lit(0)), F.struct("bins", -F.col("evenness"), "island")).alias("best"))
    solved = dealt.join(best, "shard").select("shard", F.explode(F.arrays_zip("items", "best")).alias("_i"))
    rows = solved.select("shard", "_i.items.*", F.col("_i.best").alias("bin"))
    return rows.withColumn("fill", F.sum("tokens").over(Window.partitionBy("shard", "bin")))


def _containers(numbers: Sequence[int]) -> dict[int, list[int]]:
    bins: dict[int, list[int]] = {}
    for i, k in enumerate(numbers):
        bins.setdefault(k, []).append(i)
    return bins


def _numbered(bins: Solution, n: int) -> list[int]:
    at = [0] * n
    for k, b in enumerate(bins):
        for i in b:
            at[i] = k
    return at


def pack(documents: DataFrame, key: str, size: str, capacity: int = CAPACITY) -> DataFrame:
    """``key, part, start, tokens, container`` of every document with a size.

    A document up to the capacity is one part.  A longer one has parts of ``capacity`` from its start on, each alone in a container, and a
    last part that shares one.  Documents of size null or 0 take no room: one row with part 0, tokens 0 and a null container.
    Negative sizes are an error of the caller and count as 0.  Rows that repeat are packed each.  An empty table gives none.
    The containers depend on the keys and sizes alone, not on files or partitions.
    """
    if capacity < 1:
        raise ValueError("the capacity must be positive")
    copies = shared_checkpoint(_copies(documents, key, size))
    parts = as_items(copies.withColumn("_id", F.struct("_key", "_n", "_copy")).select("_id", "_n"), "_id", "_n", capacity)
    parts = parts.select(F.col("_id._key").alias("_key"), "part", "start", "tokens", "whole", F.xxhash64("_id._key", "_id._n", "_id._copy", "part", F.lit(SEED)).alias("deal"))
    named = [F.col("_key").alias(key), "part", "start", "tokens"]
    whole = parts.where("whole").select(*named, F.concat_ws(":", F.lit("full"), F.hex("deal"), F.col("part").cast("string")).alias("container"))
    items = parts.where("not whole").drop("whole")
    done = [whole]
    for round_ in range(2):
        # Counting reads the sizes from the checkpoint, not the texts.
        number = items.count()
        packed = shared_checkpoint(_solve(items, capacity, round_, number))
        kept = packed.where(F.col("fill") >= capacity * WELL_FILLED) if round_ == 0 else packed
        done.append(kept.select(*named, F.concat_ws(":", F.lit(f"mixed{round_}"), F.col("shard").cast("string"), F.col("bin").cast("string")).alias("container")))
        items = packed.where(F.col("fill") < capacity * WELL_FILLED).select("_key", "part", "start", "tokens", "deal")
    empty = copies.where("_n = 0").select(F.col("_key").alias(key), F.lit(0).alias("part"), F.lit(0).cast("bigint").alias("start"), F.lit(0).cast("bigint").alias("tokens"), F.lit(None).cast("string").alias("container"))
    for part in done[1:]:
        done[0] = done[0].unionByName(part)
    return done[0].unionByName(empty)


def invariants(packed: DataFrame, sized: DataFrame, key: str, size: str, capacity: int = CAPACITY) -> DataFrame:
    """``key, kept, fits, unsplit`` of each key: whether the parts hold all of its tokens, whether no container of theirs holds more than the capacity,
    and whether it has no more parts than its size makes necessary.  Keys that repeat are judged together; null keys are left out."""
    fills = packed.where(F.col("container").isNotNull()).groupBy("container").agg(F.sum("tokens").alias("_fill"))
    parts = packed.join(fills, "container", "left").groupBy(key).agg(F.sum("tokens").alias("_packed"), F.max("_fill").alias("_most"), F.count(F.lit(1)).alias("_parts"))
    whole = F.greatest(F.coalesce(F.col(size), F.lit(0)), F.lit(0))
    wanted = sized.groupBy(key).agg(F.sum(whole).alias("_size"), F.sum(F.greatest(F.ceil(whole / capacity), F.lit(1))).alias("_needed"))
    return wanted.join(parts, key, "left").where(F.col(key).isNotNull()).select(
        key,
        F.coalesce(F.col("_packed") == F.col("_size"), F.lit(False)).alias("kept"),
        (F.coalesce("_most", F.lit(0)) <= capacity).alias("fits"),
        F.coalesce(F.col("_parts") == F.col("_needed"), F.lit(False)).alias("unsplit"),
    )
