"""Jaccard join of shingle sets by universe partition and pigeonhole.

Sets are distinct hashes of five-word shingles. Two sets of sizes r >= s have a Jaccard similarity of 3/4 or more exactly
when they differ in at most (r + s) / 7 elements. Documents with equal sets are one class, and one document stands for
it from here on.

1. A bitmap tells which elements occur in at least two classes. An element of one class only differs from every partner, so
   a class's own elements count against what may differ, and a pair's add up. A class that has more of them than may
   differ ends here; of the others what is left, the shared part, is kept, and only shared parts are joined.
2. The universe of hashes is split into segments, more of them the larger the sizes of the band (sizes from a power of two up
   to the next). A class indexes its subset of each segment, and each subset of two or more also without each one of its
   elements (one-deletion neighbourhood). A picked subset that finds no equal key in a partner differs by one element
   at least, by two with its deletions. If the picked ones together exceed what may still differ, similar sets share a key.
3. Allocation by cost: a segment whose keys nobody else wrote surely differs and costs nothing. The others are picked
   as long as needed, those with frequent keys last, and of the rest those with most elements first. Below FINE each
   element is a segment.
4. Rounds of leaders: each class is compared with one leader, the class with the fewest elements of its own that shares a
   key with it, as the original of many copies is. Those that do not link go on to the next round among themselves.
   Large groups of near copies are connected by one comparison each.
5. Classes that share a picked key and are still apart are compared, unless their odd sketches already tell that they differ
   too much. An odd sketch has a bit for each of 256 slots, whether an odd number of a shared part's elements falls into
   it; the sketches of two parts differ in no more bits than the parts differ in elements. Within a key, the members
   of its largest component never meet each other, nor do two deletions. Every comparison is exact, on the sets.

A link between different sets is never lost: the pigeonhole holds for every class with enough parts, and the few whose
hashes fall into too few segments are compared with all classes, in blocks of ``BLOCK``.

Classes have 128 bits, elements 64. Two different shingles of the same two compared sets take one hash with a chance of
about 10^-13 for sets of a thousand shingles; a comparison is wrong only then. Defined cases: null texts and texts without words
have no set and link with nothing; fewer than five words are one shingle; null ids count as documents, a component of
null ids only has a null id; repeated rows are equal sets; an empty table gives an empty result; other columns, of any
names, are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sommelix.llm.bitmap import BITS, PACKED, bitmaps, known, n_bits, n_buckets, pack
from sommelix.llm.common import cut, maybe_in, per_text, saved, small as _small
from sommelix.llm.components import components
from sommelix.llm.hashing import ODD, RunHasher, WordHasher, mix, sorted_distinct

SHINGLE = 5
#: Sets of up to so many elements have only equal partners: 2 of 3 is below 3/4, 3 of 4 is not.
ALONE = 2
#: Sizes below FINE: each element is a segment.
FINE = 32
BLOCK = 1000
#: Of keys written so often, or so much more often, the rarer are picked first; small bitmaps tell each of these levels.
OFTEN = (8, 32, 128, 512)
ROUNDS = 3
#: Words of 64 bits in an odd sketch.
SKETCH = 4
#: Keys of a component that are held at once.
CHUNK = 500_000
#: Keys by which a class looks for its leader, the first ones in one order for all classes.
LEAD_KEYS = 16


_EVEN = ~np.uint64(1)


class Shingles:
    """Makes a text's set: sorted distinct hashes of its shingles."""

    def __init__(self, k: int = SHINGLE):
        self.k, self.words, self.runs = k, WordHasher(lower=True), RunHasher()

    def __call__(self, text: str | None) -> np.ndarray:
        words = self.words(text)
        if not len(words):
            return np.zeros(0, np.uint64)
        self.runs.load(words)
        starts = np.arange(max(1, len(words) - self.k + 1))
        return sorted_distinct(self.runs(starts, np.minimum(starts + self.k, len(words))))


def class_of(tokens: np.ndarray) -> bytes:
    """128 bits for the set."""
    import xxhash

    return xxhash.xxh3_128_digest(tokens.tobytes())


def band_of(size: int) -> int:
    return size.bit_length() - 1


def n_segments(band: int, spread: float = 1.0) -> int:
    """So many segments that their worth, two for most, exceeds what may differ with room to spare."""
    return int(spread * (((2 << band) - 1) // 5 + 2))


class Parts:
    """The non-empty segments of a set's shared part in a band: keys, the segment of each, and each segment's size and worth."""

    def __init__(self, tokens: np.ndarray, band: int, spread: float = 1.0):
        salt = np.uint64((band + 1) * 0x1000003)
        tokens = mix(tokens ^ salt)
        if (2 << band) - 1 < FINE:
            self.keys = tokens & _EVEN
            self.owner = np.arange(len(tokens))
            self.sizes = self.worth = np.ones(len(tokens), np.int64)
            return
        tokens = np.sort(tokens)  # by segment too, as segments are ranges of hashes
        segment = ((tokens >> np.uint64(32)) * np.uint64(n_segments(band, spread))) >> np.uint64(32)
        starts = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
        self.sizes = np.diff(np.append(starts, len(tokens)))
        sums = np.add.reduceat(tokens, starts)
        at = segment[starts] * ODD + salt
        of = np.repeat(np.arange(len(starts)), self.sizes)
        more = self.sizes[of] >= 2  # these also stand for what is left without an element
        # the lowest bit tells deletions: they meet subsets only, not each other
        self.keys = np.concatenate([mix(sums ^ at) & _EVEN, mix(((sums[of] - tokens) ^ at[of])[more]) | np.uint64(1)])
        self.owner = np.concatenate([np.arange(len(starts)), of[more]])
        self.worth = np.where(self.sizes >= 2, 2, 1)

    def pick(self, open_: np.ndarray, need: int, often: np.ndarray | None = None) -> np.ndarray:
        """Segments to pick, of those open: the least frequent, then largest ones first until their worth is enough."""
        if need <= 0:
            return np.zeros(0, np.int64)
        chosen = np.flatnonzero(open_)
        often = np.zeros(len(chosen), np.int64) if often is None else often[chosen]
        chosen = chosen[np.lexsort((-self.sizes[chosen], often))]
        return chosen[: int(np.searchsorted(np.cumsum(self.worth[chosen]), need)) + 1]

    def only(self, segments: np.ndarray) -> np.ndarray:
        """Which keys belong to these segments."""
        on = np.zeros(len(self.sizes), bool)
        on[segments] = True
        return on[self.owner]


def odd_sketch(tokens: np.ndarray) -> np.ndarray:
    """SKETCH words whose bits tell which slots an odd number of elements falls into."""
    slots = np.bincount((tokens >> np.uint64(8)) % np.uint64(64 * SKETCH), minlength=64 * SKETCH)
    return np.packbits((slots & 1).astype(np.uint8)).view(np.int64)


def may_differ(r: int, s: int) -> int:
    """Elements in which linked sets of these sizes differ at most."""
    return (r + s) // 7


def below(r: int, own: int, tokens: np.ndarray, spread: float) -> tuple[Parts, np.ndarray, int] | None:
    """If a smaller partner of a set of r elements, own of which nobody else has, may be in the band below: parts there,
    the picked segments, and how many of their elements may differ."""
    low = band_of(-(-3 * r // 4))
    if low == band_of(r):
        return None
    parts, left = Parts(tokens, low, spread), may_differ(r, (2 << low) - 1) - own
    return parts, parts.pick(np.ones(len(parts.sizes), bool), left + 1), left


def written(r: int, own: int, tokens: np.ndarray, spread: float = 1.0) -> np.ndarray:
    """All keys that a set writes: those of its own band, and the picked ones of the band below."""
    keys, low = Parts(tokens, band_of(r), spread).keys, below(r, own, tokens, spread)
    return keys if low is None else np.concatenate([keys, low[0].keys[low[0].only(low[1])]])


class Looker:
    """Allocation by cost: which of a set's keys others have written, and which to look for."""

    def __init__(self, seen: np.ndarray, often: list[np.ndarray], spread: float = 1.0):
        self.seen, self.often, self.spread = seen, often, spread

    def _ask(self, parts: Parts, among: np.ndarray | None, left: int):
        """Keys others have, the first of these for finding a leader, the worth of segments that surely differ, the picked keys,
        and whether the segments were too few."""
        hit = known(self.seen, parts.keys)
        level = sum(known(o, parts.keys[hit]).astype(np.int64) for o in self.often)
        frequent = level > 0
        open_ = np.zeros(len(parts.sizes), bool)
        open_[parts.owner[hit]] = True
        allowed = np.ones(len(parts.sizes), bool)
        if among is not None:
            allowed[:] = False
            allowed[among] = True
        sure = int(parts.worth[~open_ & allowed].sum())
        often = np.zeros(len(parts.sizes), np.int64)
        np.maximum.at(often, parts.owner[hit], level)
        picked = parts.pick(open_ & allowed, left + 1 - sure, often)
        short = int(parts.worth[picked].sum()) < left + 1 - sure
        if among is not None:  # of the others nothing was written
            on = parts.only(among)
            frequent, hit = frequent[on[hit]], hit & on
        lead = parts.keys[hit][np.lexsort((parts.keys[hit], ~frequent))[:LEAD_KEYS]]
        return hit, lead, sure, parts.keys[hit & parts.only(picked)], short

    def __call__(self, r: int, own: int, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool, int]:
        """Keys under which the set may be found, those it looks for, those by which it finds a leader, whether it is too
        short of segments, and how many elements and parts surely are its own."""
        parts = Parts(tokens, band_of(r), self.spread)
        hit, lead, sure, picked, short = self._ask(parts, None, may_differ(r, r) - own)
        if may_differ(r, r) == 0:  # a different set of this size or less differs too much
            picked, short = picked[:0], False
        # a partner in the band above has written its picked parts only, so there the others prove nothing
        most = 4 * r // 3
        kept = parts.keys[hit]
        if band_of(most) == band_of(r) and own + sure > may_differ(r, most):
            kept = kept[:0]
        low = below(r, own, tokens, self.spread)
        if low is not None:
            _, first, _, more, short_low = self._ask(*low)
            picked, short, lead = np.concatenate([picked, more]), short or short_low, np.concatenate([lead, first])
        return kept, picked, lead, short, own + sure


def classes_of(docs: DataFrame) -> DataFrame:
    """kd, doc_id, n_shingles and class (null without a set) of every document."""

    def make():
        shingles = Shingles()

        def work(texts):
            sets = [shingles(t) for t in texts]
            return [list(map(len, sets)), [class_of(s) if len(s) else None for s in sets]]

        return work

    fields = {"n_shingles": ("bigint", pa.int64()), "class": ("binary", pa.binary())}
    return per_text(docs, make, fields, ("doc_id", "kd")).select("row.*", *fields)


def one_of_each(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """docs without all but one document of each class. Only documents that may be such copies are moved."""
    least = classes.where("class IS NOT NULL").groupBy("class").agg(F.min("kd").alias("least"), F.max("kd").alias("most"))
    copies = cut(classes.join(least.where("least <> most"), "class").where("kd <> least").select("kd").distinct())
    again = classes.groupBy("kd").count().where("count > 1").select("kd")  # repeated rows
    special = cut(copies.union(again))
    moved = maybe_in(docs, ["kd"], special).dropDuplicates(["kd"])
    return maybe_in(docs, ["kd"], special, "left_anti").union(moved.join(copies, "kd", "left_anti").select(docs.columns))


def _bitmaps(rows: DataFrame, keys: Callable, n_keys: int, most_bits: int, often: tuple[int, ...] = ()) -> list[np.ndarray]:
    """Bitmaps of the keys that all rows write at least twice, and smaller ones of those written so often; keys() gives a
    function of a batch. More than the largest number of one key among some are not told apart."""
    buckets, bits = n_buckets(n_keys), n_bits(n_keys, most_bits)

    def packing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = keys()
        for packed in pack((x for batch in _small(batches) for x in of(batch)), buckets, max((2, *often))):
            yield pa.RecordBatch.from_pandas(packed, pa.schema([("bucket", pa.int32()), ("keys", pa.binary())]), preserve_index=False)

    return bitmaps(rows.mapInArrow(packing, PACKED), buckets, ((2, bits), *((n, bits // min(16, n // 2)) for n in often)))


def shared_parts(docs: DataFrame, n_elements: int, bits: int) -> DataFrame:
    """id, class, n (set size), own (elements nobody else has), part (the packed rest) of classes that may have a partner.
    docs has one document of each class."""

    def elements():
        shingles = Shingles()
        return lambda batch: (s for text in batch.column("text").to_pylist() if len(s := shingles(text)) > ALONE)

    context = docs.sparkSession.sparkContext
    shared = context.broadcast(_bitmaps(docs.select("text"), elements, n_elements, bits)[0])

    def make():
        shingles = Shingles()

        def work(texts):
            columns: list[list] = [[] for _ in fields]
            for text in texts:
                tokens, row = shingles(text), [None] * len(fields)
                if (r := len(tokens)) > ALONE:
                    part = tokens[known(shared.value, tokens)]
                    if r - len(part) <= may_differ(r, 4 * r // 3):
                        row = [class_of(tokens), r, r - len(part), part.tobytes()]
                for column, value in zip(columns, row):
                    column.append(value)
            return columns

        return work

    fields = {"class": ("binary", pa.binary()), "n": ("int", pa.int32()), "own": ("int", pa.int32()), "part": ("binary", pa.binary())}
    rows = per_text(docs, make, fields, ()).where("class IS NOT NULL").select(F.monotonically_increasing_id().alias("id"), *fields)
    out = saved(rows)
    shared.destroy()
    return out


def _sets(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray]]:
    for r, own, part in zip(batch.column("n").to_pylist(), batch.column("own").to_pylist(), batch.column("part").to_pylist()):
        yield r, own, np.frombuffer(part, np.uint64)


_SKETCHES = [f"s{k}" for k in range(SKETCH)]


def described(parts: DataFrame, bits: int, spread: float) -> DataFrame:
    """id, n, own and the packed keys kept, picked and lead, short, and rank of each class that may have a partner."""

    def keys():
        return lambda batch: (written(*x, spread) for x in _sets(batch))

    context = parts.sparkSession.sparkContext
    n_keys = 2 * (parts.agg(F.sum("n")).first()[0] or 0)
    shared = context.broadcast(_bitmaps(parts.select("n", "own", "part"), keys, n_keys, bits, OFTEN))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, *often = shared.value
        look = Looker(seen, often, spread)
        for batch in _small(batches):
            made = [look(*x) for x in _sets(batch)]
            columns = [pa.array([k.tobytes() for k in x], pa.binary()) for x in list(zip(*made))[:3]]
            short, rank = pa.array([m[3] for m in made], pa.bool_()), pa.array([m[4] for m in made], pa.int32())
            sketches = np.stack([odd_sketch(p) for _, _, p in _sets(batch)])
            columns += [short, rank, *[pa.array(x) for x in sketches.T.copy()]]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in same], *columns], names=[*same, "kept", "picked", "lead", "short", "rank", *_SKETCHES])

    same = ("id", "n", "own")
    schema = "id bigint, n int, own int, kept binary, picked binary, lead binary, short boolean, rank int, "
    schema += ", ".join(f"{s} bigint" for s in _SKETCHES)
    out = saved(parts.select(*same, "part").mapInArrow(describe, schema).where("length(kept) + length(picked) > 0 OR short"))
    shared.destroy()
    return out


def _exploded(rows: DataFrame, column: str, *same: str) -> DataFrame:
    """The given columns, key and deletion (whether it is one): a row for each key in a packed column."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches, 200):
            keys = [np.frombuffer(k, np.int64) for k in batch.column(column).to_pylist()]
            of = pa.array(np.repeat(np.arange(len(keys)), list(map(len, keys))))
            keys = np.concatenate(keys)
            new = [pa.array(keys & -2), pa.array(keys & 1 == 1)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c).take(of) for c in same], *new], names=[*same, "key", "deletion"])

    types = dict(rows.dtypes)
    schema = ", ".join([*[f"{c} {types[c]}" for c in same], "key bigint, deletion boolean"])
    return rows.where(F.length(column) > 0).select(*same, column).mapInArrow(explode, schema)


def _fit(n: Column, own: Column, m: Column, other: Column) -> Column:
    """Sizes n, m of different sets that may link, with elements of their own that do not exceed what may differ."""
    return (100 * F.least(n, m) >= 75 * F.greatest(n, m)) & (7 * (own + other) <= n + m) & ((n != m) | (n >= 7))


def compared(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """a, b, d (elements in which the sets differ) and link of the pairs a, b, which are compared on their sets."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches):
            d = []
            for x, y, own in zip(*(batch.column(c).to_pylist() for c in ("x", "y", "own"))):
                d.append(own + 2 * len(sorted_distinct(np.frombuffer(x + y, np.uint64))) - (len(x) + len(y)) // 8)
            d = np.array(d, np.int32)
            link = 7 * d <= batch.column("n").to_numpy()
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(d), pa.array(link)], names=["a", "b", "d", "link"])

    some = lambda i: maybe_in(parts, ["id"], pairs.select(F.col(i).alias("id")))
    of = lambda i, p: some(i).select(F.col("id").alias(i), F.col("n").alias(f"n_{i}"), F.col("own").alias(f"own_{i}"), F.col("part").alias(p))
    full = pairs.select("a", "b").join(of("a", "x"), "a").join(of("b", "y"), "b")
    full = full.select("a", "b", (F.col("own_a") + F.col("own_b")).alias("own"), (F.col("n_a") + F.col("n_b")).alias("n"), "x", "y")
    return cut(full.mapInArrow(check, "a bigint, b bigint, d int, link boolean"))


def _short_links(parts: DataFrame, rows: DataFrame, block: int) -> list[DataFrame]:
    """Links a, b of sets with too few segments: a stated query set, compared with every class in blocks."""
    short = cut(parts.join(rows.where("short").select("id"), "id", "left_semi").select("id", "n", "own", "part"))
    n = short.count()
    out = []
    for k in range(-(-n // block)):
        asked = short.where(F.pmod(F.xxhash64("id"), F.lit(-(-n // block))) == k).collect()
        shared = parts.sparkSession.sparkContext.broadcast([(r["id"], r["n"], r["own"], bytes(r["part"])) for r in asked])

        def compare(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            asked = [(i, n, own, np.frombuffer(p, np.uint64)) for i, n, own, p in shared.value]
            for batch in batches:
                a, b = [], []
                for i, (n, own, p) in zip(batch.column("id").to_pylist(), _sets(batch)):
                    for j, m, other, q in asked:
                        if i != j and 7 * abs(n - m) <= n + m:
                            d = own + other + 2 * len(sorted_distinct(np.concatenate([p, q]))) - len(p) - len(q)
                            if 7 * d <= n + m:
                                a.append(j)
                                b.append(i)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        out.append(cut(parts.select("id", "n", "own", "part").mapInArrow(compare, "a bigint, b bigint")))
    return out


def led(rows: DataFrame, parts: DataFrame) -> DataFrame | None:
    """a, b, d, link: each class of rows compared with a leader among them, if any has one."""
    rank = F.struct("rank", (-F.col("n")).alias("size"), "id", "own")
    leaders = _exploded(rows, "lead", "id", "n", "own", "rank").groupBy("key").agg(F.min(rank).alias("lead"), F.min("id").alias("one"), F.max("id").alias("last")).where("one <> last")
    leaders = leaders.select("key", F.col("lead.id").alias("b"), (-F.col("lead.size")).alias("m"), F.col("lead.own").alias("other"))
    asking = _exploded(rows, "lead", "id", "n", "own").drop("deletion")
    votes = asking.join(leaders, "key").where((F.col("id") != F.col("b")) & _fit(*map(F.col, ("n", "own", "m", "other")))).groupBy("id", "b").count()
    first = cut(votes.groupBy(F.col("id").alias("a")).agg(F.max_by("b", F.struct("count", "b")).alias("b")))
    return None if first.isEmpty() else compared(first, parts)


def in_several(rows: DataFrame, bits: int) -> DataFrame:
    """rows without the packed keys that occur in one component only. rows come sorted by component; a component larger
    than a chunk of CHUNK keys may count as several, so some more keys may stay."""

    def keys():
        held: list[np.ndarray] = []
        last = [None, 0]  # the component at hand and its keys held

        def of(batch):
            for component, *packed in zip(*(batch.column(c).to_pylist() for c in ("component", "kept", "picked"))):
                if held and (component != last[0] or last[1] > CHUNK):
                    yield sorted_distinct(np.concatenate(held))
                    held.clear()
                    last[1] = 0
                last[0] = component
                held.extend(np.frombuffer(p, np.uint64) for p in packed)
                last[1] += sum(map(len, packed)) // 8
            if held:  # what follows in another batch counts once more
                yield sorted_distinct(np.concatenate(held))
                held.clear()
                last[1] = 0

        return of

    context = rows.sparkSession.sparkContext
    n_keys = (rows.agg(F.sum(F.length("kept") + F.length("picked"))).first()[0] or 0) // 8
    shared = context.broadcast(_bitmaps(rows.select("component", "kept", "picked"), keys, n_keys, bits)[0])

    def only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches):
            for c in ("kept", "picked"):
                keys = (np.frombuffer(k, np.uint64) for k in batch.column(c).to_pylist())
                some = pa.array([k[known(shared.value, k)].tobytes() for k in keys], pa.binary())
                batch = batch.set_column(batch.schema.get_field_index(c), c, some)
            yield batch

    out = saved(rows.mapInArrow(only, rows.schema).where("length(kept) + length(picked) > 0"))
    shared.destroy()
    return out


def linked(parts: DataFrame, bits: int = BITS, spread: float = 1.0, rounds: int = ROUNDS, block: int = BLOCK) -> DataFrame:
    """node and component: of the ids of classes that link with another one, the smallest id they are connected with."""
    rows = described(parts, bits, spread)
    spark = parts.sparkSession
    links = spark.createDataFrame([], "a bigint, b bigint")
    for more in _short_links(parts, rows, block):
        links = links.union(more)

    apart = rows
    for _ in range(rounds):
        if (answers := led(apart, parts)) is None:
            break
        links = links.union(answers.where("link").select("a", "b"))
        in_link = answers.where("link").select(F.explode(F.array("a", "b")).alias("id")).distinct()
        apart = saved(apart.join(in_link, "id", "left_anti"))
    groups = components(links)

    # pairs that share a picked key and are still apart
    placed = rows.drop("lead", "rank", "short").join(groups.withColumnRenamed("node", "id"), "id", "left")
    placed = placed.withColumn("component", F.coalesce("component", "id"))
    rows = saved(placed.repartitionByRange("component", "id").sortWithinPartitions("component"))
    rows = in_several(rows, bits)
    # narrow rows: ids with the mark of deletions, sizes with own elements
    rows = rows.withColumn("sizes", F.shiftleft(F.col("n").cast("long"), 32).bitwiseOR(F.col("own").cast("long")))
    same = ("id", "sizes", "component", *_SKETCHES)
    one_row = [(2 * F.col("id") + F.col("deletion").cast("long")).alias("who"), "sizes", "component", *_SKETCHES]
    places = _exploded(rows, "kept", "component").union(_exploded(rows, "picked", "component"))
    counts = places.groupBy("key", "component").count()
    split = counts.groupBy("key").agg(F.max_by("component", F.struct("count", "component")).alias("major"), F.count("*").alias("several"))
    split = cut(split.where("several > 1").drop("several"))
    if split.isEmpty():
        return groups
    mine = maybe_in(_exploded(rows, "picked", *same).select("key", *one_row), ["key"], split).join(split, "key")
    theirs = maybe_in(_exploded(rows, "kept", *same).select("key", *one_row), ["key"], split).join(split, "key")
    theirs = theirs.select("key", "major", *[F.col(c).alias(f"{c}_") for c in ("who", "sizes", "component", *_SKETCHES)])
    parts_of = lambda x: (F.shiftright(x, 32), x.bitwiseAND(F.lit((1 << 32) - 1)))
    (n, own), (m, other) = parts_of(F.col("sizes")), parts_of(F.col("sizes_"))
    odd = sum((F.bit_count(F.col(s).bitwiseXOR(F.col(f"{s}_"))) for s in _SKETCHES), own + other)
    deletions = F.col("who").bitwiseAND(F.col("who_")).bitwiseAND(F.lit(1)) == 1
    fits = (F.col("component") != F.col("component_")) & ~deletions & _fit(n, own, m, other) & (7 * odd <= n + m)
    theirs = theirs.drop("major")
    is_major = F.col("component") == F.col("major")
    one = mine.where(~is_major).join(theirs, "key")
    other = mine.where(is_major).join(theirs, "key").where("component_ <> major")
    ids = (F.shiftright("who", 1), F.shiftright("who_", 1))
    pairs = [x.where(fits).select(F.least(*ids).alias("a"), F.greatest(*ids).alias("b")).distinct() for x in (one, other)]
    left = cut(pairs[0].union(pairs[1]).distinct())
    if left.isEmpty():
        return groups
    late = compared(left, parts).where("link").select("a", "b")
    return groups if late.isEmpty() else components(links.union(late))


def jaccard_groups(docs: DataFrame, bits: int = BITS, spread: float = 1.0, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles and component (equal for documents that are linked, null without a set). ``spread`` below 1 makes fewer
    segments, for tests of sets that have too few."""
    kd = F.struct(F.xxhash64("doc_id", "text").alias("a"), F.xxhash64(F.lit(1), "text", "doc_id").alias("b"))
    docs = docs.select("doc_id", "text", kd.alias("kd"))
    classes = cut(classes_of(docs))
    n_elements = classes.agg(F.sum("n_shingles")).first()[0] or 0
    parts = shared_parts(one_of_each(docs, classes), n_elements, bits)
    groups = linked(parts, bits, spread, block=block)
    named = parts.select("id", "class").join(groups, F.col("id") == F.col("node")).select("class", F.col("component").cast("string"))
    return classes.join(named, "class", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", F.lower(F.hex("class"))).alias("component")
    )


def with_component_ids(groups: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id: the smallest id of the component; documents without a set are their own."""
    least = groups.where("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return groups.join(least, "component", "left").select(
        "doc_id", "n_shingles", F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )


def op9_jaccard_join(spark, sf_dir) -> DataFrame:
    return with_component_ids(jaccard_groups(spark.read.parquet(f"{sf_dir}/documents.parquet")))


OP9_SQL = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x20\x09-\x0D]+') AS w FROM documents
),
s AS (
  SELECT DISTINCT r, array_to_string(w[i : i + 4], ' ') AS g
  FROM (SELECT r, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM d WHERE len(w) > 0)
),
n AS (SELECT r, count(*) AS n, hash(string_agg(g, chr(10) ORDER BY g)) AS h FROM s GROUP BY r),
c AS (SELECT h, min(r) AS r FROM n GROUP BY h),
t AS (SELECT s.r, g FROM s JOIN c USING (r)),
df AS (SELECT g, count(*) AS k FROM t GROUP BY g HAVING count(*) > 1),
o AS (
  SELECT t.r, t.g, row_number() OVER (PARTITION BY t.r ORDER BY coalesce(k, 1), t.g) AS p FROM t LEFT JOIN df USING (g)
),
pre AS (SELECT o.r, g FROM o JOIN n USING (r) WHERE p <= n.n - ceil(0.75 * n.n) + 1),
cand AS (SELECT DISTINCT a.r AS x, b.r AS y FROM pre a JOIN pre b USING (g) WHERE a.r < b.r),
e AS (
  SELECT x, y FROM (
    SELECT x, y, count(*) AS i FROM cand JOIN t a ON a.r = x JOIN t b ON b.r = y AND a.g = b.g GROUP BY x, y)
  JOIN n a ON a.r = x JOIN n b ON b.r = y WHERE 100 * i >= 75 * (a.n + b.n - i)
),
sym AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
reach AS (SELECT r AS x, r AS y FROM c UNION SELECT reach.x, sym.y FROM reach JOIN sym ON reach.y = sym.x),
rep AS (SELECT c.h, min(y) AS y FROM c JOIN reach ON reach.x = c.r GROUP BY c.h),
least AS (SELECT rep.y, min(doc_id) AS component_id FROM rep JOIN n USING (h) JOIN d ON d.r = n.r GROUP BY rep.y)
SELECT doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles,
  CASE WHEN n.r IS NULL THEN doc_id ELSE component_id END AS component_id
FROM d LEFT JOIN n USING (r) LEFT JOIN rep USING (h) LEFT JOIN least USING (y)
"""
