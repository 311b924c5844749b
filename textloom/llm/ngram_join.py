"""N-gram Jaccard join with set-relation skipping: documents whose sets of word shingles are alike, and their components.

1. Sets. Every text becomes the set of its shingles' 64-bit hashes. Equal sets are one: only the first row of each takes part further.
2. Similar sets. Sets that agree in the least hash under one of several permutations, and in size class, meet the first of them, copies mostly
   coming after their original. A set whose sketch of least hashes agrees in half with that one's belongs to its star, whether the two are alike or not, and a leader
   that has a leader takes along the members close to that one too. Stars only deal out the work: a dense group is one star, though many of its members are not alike with the first.
3. Answers within a star. Every two members are judged by how each differs from their leader, without their whole sets: with D the
   shingles that one of leader and member lacks, members a and b share |leader| - |leader without a| - |leader without b| + |D(a) and D(b)|.
   Members are dealt into blocks; a task gets two blocks, judges all their pairs at once by a matrix product over the differences that both
   blocks have, and returns one count a member, and one edge that leads to where its links lead. No pair becomes a row, and a star of any size is many bounded tasks.
4. Index lists by size and position. All sets share one order of shingles: by hash, but very frequent ones last. Alike sets share a
   shingle among their first (1 - t) * n + 1, and a shingle at position i leaves room for n - i shared ones. Lists are cut into blocks by size class, and
   an entry meets, as the smaller set, only the blocks that its position leaves room for; the others are skipped whole, and so is every block for entries beyond a
   ninth of their set. Within blocks, entries whose size or position rules a link out are skipped, and so are those of one star. What is left is held against the first shingles of both
   sets, which bound the overlap again, and then verified on the whole sets.
5. Components of all links, by alternating star steps.

Where components alone are asked for, steps 2 and 3 only hold sets against the first ones and keep those found alike, and step 4 skips the entries of one component, whose further links join nothing more.

Which shingles are called frequent only orders the lists and can't change the result; they are counted in every task, summed over all and the most
frequent ``max_hot`` broadcast (a size known beforehand). Whole sets are fetched for the texts of candidate pairs alone; their list is broadcast only if
it is counted to be small, and joined by shuffle otherwise. Hot lists and hot sets are keys of inner joins or of minima.

Defined results: null texts and texts without words have an empty set, linked with nothing; fewer words than a shingle make one shingle
of them all; repeated rows share a component; a null key never names a component unless no other does; an empty table gives an empty result;
other columns of the input are ignored. Sets are named by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import PLAIN, Words, grams, mix, slices, text_bytes, written
from textloom.llm.components import components

#: Similarity of at least NUM / DEN.
NUM, DEN = 4, 5
#: Permutations under which sets are held against the first set with the same least hash where components alone are asked for.
STARS = 3
#: Bins of a sketch, and the keys taken from it under which sets meet the leader of a star.
BINS, KEYS = 32, 8
_U = np.uint64
BROADCAST_BYTES = 32 << 20


def sets(column: pa.Array, n: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, end row, bounds, sorted distinct shingle hashes, sizes) slice by slice."""
    data, offsets = text_bytes(column)
    for lo, hi in slices(offsets):
        words = Words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], PLAIN, lower=True)
        hashes = words.hashes()
        found, row = grams(hashes, words.row, n)
        counts = words.counts()
        short = np.flatnonzero((counts > 0) & (counts < n))
        if len(short):
            first = np.cumsum(counts) - counts
            whole = [mix(np.array([sum(int(h) * (2 * k + 3) ** 9 for k, h in enumerate(hashes[first[r] : first[r] + counts[r]])) + int(counts[r]) & (2**64 - 1)], _U))[0] for r in short]
            found, row = np.concatenate((found, np.array(whole, _U))), np.concatenate((row, short))
        order = np.lexsort((found, row))
        found, row = found[order], row[order]
        new = np.concatenate(([True], (found[1:] != found[:-1]) | (row[1:] != row[:-1]))) if len(row) else np.zeros(0, bool)
        found, row = found[new], row[new]
        size = np.bincount(row, minlength=hi - lo)
        yield lo, hi, np.concatenate(([0], np.cumsum(size))), found, size


def names(bounds: np.ndarray, found: np.ndarray) -> np.ndarray:
    """A name of each set that depends on its members alone; 0 for empty sets."""
    total = np.concatenate((np.zeros(1, _U), np.cumsum(mix(found ^ _U(0x5DEECE66D)))))
    return np.where(np.diff(bounds) > 0, mix(total[bounds[1:]] - total[bounds[:-1]] + np.diff(bounds).astype(_U)), _U(0))


def sketches(bounds: np.ndarray, found: np.ndarray) -> np.ndarray:
    """32 bits of each set's least shingle in each of ``BINS`` bins; 0 where a bin is empty. Shingles of a set come in order."""
    out = np.zeros((len(bounds) - 1, BINS), np.uint32)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    out[row[::-1], (found & _U(BINS - 1)).astype(np.int64)[::-1]] = ((found >> _U(5)).astype(np.uint32) | np.uint32(1))[::-1]
    return out


def prefix_length(size: np.ndarray) -> np.ndarray:
    return size - (NUM * size + DEN - 1) // DEN + 1


def small_side(df: DataFrame, row_bytes: int) -> DataFrame:
    """``df`` marked for broadcast if its rows are counted to fit in ``BROADCAST_BYTES``, else as it is, for a shuffled join."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def hot_shingles(documents: DataFrame, text: str, n: int, least: int = 16, max_hot: int = 1 << 20) -> np.ndarray:
    """Sorted shingles that documents have often: seen twice and more in a task's share, ``least`` times over such shares; the most frequent ``max_hot`` of them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[np.ndarray] = []

        def often() -> pa.RecordBatch:
            value, times = np.unique(np.concatenate(seen), return_counts=True)
            seen.clear()
            return pa.RecordBatch.from_arrays([pa.array(value[times > 1].view(np.int64)), pa.array(times[times > 1])], ["t", "n"])

        for batch in batches:
            for _, _, _, found, _ in sets(batch.column(0), n):
                seen.append(found)
                if sum(map(len, seen)) > 1 << 20:
                    yield often()
        if seen:
            yield often()

    each = documents.select(F.col(text).alias("text")).mapInArrow(count, "t long, n long").groupBy("t").agg(F.sum("n").alias("n"))
    top = each.filter(F.col("n") >= least).orderBy(F.desc("n"), "t").limit(max_hot).select("t").toArrow()
    return np.sort(top.column("t").to_numpy().view(_U))


def ordered(bounds: np.ndarray, found: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """The shingles of each set in the order shared by all: 63 bits of the hash, below a bit for the frequent ones."""
    key = found >> _U(1)
    if len(hot):
        is_hot = hot[np.minimum(np.searchsorted(hot, found), len(hot) - 1)] == found
        key |= is_hot.astype(_U) << _U(63)
        key = key[np.lexsort((key, np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))))]
    return key


def describe(documents: DataFrame, key: str, text: str, n: int, hot: np.ndarray, sketched: bool = True) -> DataFrame:
    """A written table of (rid, key, size, name, m0, m1, ..., sketch, prefix) per document; ``sketch`` is empty unless ``sketched``; ``prefix`` holds the size, then the first shingles in order."""
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    stars = [f"m{k}" for k in range(STARS)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, bounds, found, size in sets(batch.column(1), n):
                name = names(bounds, found)
                some = size > 0
                least = [np.zeros(hi - lo, _U) for _ in range(STARS)]
                if some.any():
                    starts = bounds[:-1][some]
                    least[0][some] = found[starts]
                    for k in range(1, STARS):
                        least[k][some] = np.minimum.reduceat(mix(found + _U(77 * k)), starts)
                # Size classes by steps of a quarter. Their bounds differ by permutation, so that a group that one bound cuts is whole under others.
                grade = np.log(np.maximum(size, 1)) / np.log(1.25)
                buckets = [mix(x ^ (np.floor(grade + k / STARS).astype(_U) + _U(k << 32))).view(np.int64) for k, x in enumerate(least)]
                key, keep = ordered(bounds, found, hot), np.where(some, prefix_length(size), 0)
                prefix = [size[i].astype(np.int64).tobytes() + key[b : b + k].tobytes() for i, (b, k) in enumerate(zip(bounds[:-1].tolist(), keep.tolist(), strict=True))]
                sketch = pa.array([x.tobytes() for x in sketches(bounds, found)] if sketched else [b""] * (hi - lo), pa.binary())
                columns = [batch.column(0).slice(lo, hi - lo), pa.array(size), pa.array(name.view(np.int64)), *map(pa.array, buckets), sketch, pa.array(prefix, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["key", "size", "name", *stars, "sketch", "prefix"])

    schema = f"key {kind}, size long, name long, {', '.join(f'{m} long' for m in stars)}, sketch binary, prefix binary"
    return written(rows.mapInArrow(work, schema).withColumn("rid", F.monotonically_increasing_id()), "sets")


def spelled(documents: DataFrame, key: str, text: str, n: int, wanted: DataFrame, pairs: DataFrame) -> DataFrame:
    """A written table of (name, members) of the sets in ``pairs`` (a, b). ``wanted``: (key, name) of a document for each set."""
    needed = pairs.select(F.explode(F.array("a", "b")).alias("name")).distinct().join(wanted, "name").select("key", "name")
    needed = written(needed, "needed")
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    keys = small_side(needed.select(F.col("key").alias("wanted")).distinct(), 48)
    texts = rows.join(keys, F.col("key").eqNullSafe(F.col("wanted")), "left_semi").select("text")

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, bounds, found, _ in sets(batch.column(0), n):
                members = [found[a:b].tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(names(bounds, found).view(np.int64)), pa.array(members, pa.binary())], ["name", "members"])

    found = texts.mapInArrow(spell, "name long, members binary").join(small_side(needed.select("name").distinct(), 48), "name", "left_semi")
    return written(found.dropDuplicates(["name"]), "spelled")


def paired(pairs: DataFrame, members: DataFrame, test: Callable[[pa.Array, pa.Array], pa.Array]) -> DataFrame:
    """The (a, b) of ``pairs`` whose ``members`` (name, members) pass the test. Only the members of sets in pairs move."""
    pairs = small_side(pairs.select("a", "b"), 48)
    x = members.join(pairs, members["name"] == pairs["a"]).select("a", "b", F.col("members").alias("x"))
    y = members.join(pairs, members["name"] == pairs["b"]).select("a", "b", F.col("members").alias("y"))
    return x.join(y, ["a", "b"]).filter(F.arrow_udf(test, "boolean")(F.col("x"), F.col("y"))).select("a", "b").distinct()


def _shared(p: np.ndarray, q: np.ndarray) -> int:
    both = np.sort(np.concatenate((p, q)))
    return int((both[1:] == both[:-1]).sum())


def alike(a: pa.Array, b: pa.Array) -> pa.Array:
    """Whether whole sets are alike."""
    out = []
    for x, y in zip(a, b, strict=True):
        p, q = np.frombuffer(x.as_buffer(), _U), np.frombuffer(y.as_buffer(), _U)
        shared = _shared(p, q)
        out.append(shared * DEN >= NUM * (len(p) + len(q) - shared))
    return pa.array(out, pa.bool_())


def maybe_alike(a: pa.Array, b: pa.Array) -> pa.Array:
    """False where two sets can't be alike, going by their sizes and the shingles up to a place in the order to which both lists are whole."""
    out = []
    for x, y in zip(a, b, strict=True):
        p, q = np.frombuffer(x.as_buffer(), _U), np.frombuffer(y.as_buffer(), _U)
        n, m, p, q = int(p[0]), int(q[0]), p[1:], q[1:]
        limit = min(p[-1], q[-1])
        p, q = p[: np.searchsorted(p, limit, "right")], q[: np.searchsorted(q, limit, "right")]
        most = _shared(p, q) + min(n - len(p), m - len(q))
        out.append(most * (NUM + DEN) >= NUM * (n + m))
    return pa.array(out, pa.bool_())


def close(a: pa.Array, b: pa.Array) -> pa.Array:
    """Whether sketches agree in half of the bins in which one of both has a shingle."""
    p, q = (text_bytes(x)[0].view(np.uint32).reshape(-1, BINS) for x in (a, b))
    return pa.array(2 * ((p == q) & (p > 0)).sum(axis=1) >= ((p > 0) | (q > 0)).sum(axis=1))


def keyed(reps: DataFrame) -> DataFrame:
    """(bucket, name, first, rid): ``KEYS`` buckets of each of ``reps``, which sets with the same least shingles and of similar sizes share."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sketch = text_bytes(batch.column(4))[0].view(np.uint32).reshape(-1, BINS).copy()
            for k in (*range(BINS - 2, -1, -1), BINS - 1, *range(BINS - 2, -1, -1)):  # empty bins are lent the next one's shingle
                sketch[:, k] = np.where(sketch[:, k], sketch[:, k], sketch[:, (k + 1) % BINS])
            grade = np.log2(batch.column(3).to_numpy())
            buckets = [mix(sketch[:, k * BINS // KEYS].astype(_U) ^ (np.floor(grade + k / KEYS).astype(_U) << _U(40)) ^ _U(k << 56)) for k in range(KEYS)]
            row = np.repeat(np.arange(batch.num_rows), KEYS)
            yield pa.RecordBatch.from_arrays([pa.array(np.stack(buckets, 1).ravel().view(np.int64)), *[batch.column(c).take(pa.array(row)) for c in range(3)]], ["bucket", "name", "first", "rid"])

    kind = reps.schema["first"].dataType.simpleString()
    return reps.select("name", "first", "rid", "size", "sketch").mapInArrow(work, f"bucket long, name long, first {kind}, rid long")


def loose_stars(reps: DataFrame, jumps: int = 2) -> DataFrame:
    """A written table of (a, b) for each set a that shares a star with others: b is its leader, close to a by their sketches. A leader is in its own star unless it is in another."""
    sketch = reps.select("name", "sketch")

    def close_ones(pairs: DataFrame) -> DataFrame:
        """Those of ``pairs`` (a, b), with b a struct (first, rid, name), that are close."""
        x = pairs.join(sketch.select(F.col("name").alias("a"), F.col("sketch").alias("x")), "a")
        y = sketch.select(F.col("name").alias("to"), F.col("sketch").alias("y"))
        return x.join(y, x["b.name"] == y["to"]).filter(F.arrow_udf(close, "boolean")("x", "y")).select("a", "b")

    buckets = keyed(reps)
    leaders = buckets.groupBy("bucket").agg(F.min(F.struct("first", "rid", "name")).alias("b"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    met = buckets.select("bucket", F.col("name").alias("a")).join(leaders, "bucket").filter("a != b.name").select("a", "b").distinct()
    best = written(close_ones(met).groupBy("a").agg(F.min("b").alias("b")), "leaders")
    for _ in range(jumps):
        # Leaders follow leaders of their own; their members go along where these are close to them too.
        on = best.select(F.col("a").alias("via"), F.col("b").alias("c"))
        further = close_ones(best.join(on, best["b.name"] == on["via"]).select("a", F.col("c").alias("b")))
        best = written(best.join(further.withColumnRenamed("b", "c"), "a", "left").select("a", F.coalesce("c", "b").alias("b")), "leaders")
    own = best.select(F.col("b.name").alias("a")).distinct().join(best.select("a"), "a", "left_anti")
    return written(best.select("a", F.col("b.name").alias("b")).unionByName(own.select("a", F.col("a").alias("b"))), "stars")


def differences(x: pa.Array, y: pa.Array) -> pa.Array:
    """For each member x of the leader y: the leader's size, how many of its shingles the member lacks, and then the shingles that one of both lacks, sorted."""
    out = []
    for one, other in zip(x, y, strict=True):
        p, q = np.frombuffer(one.as_buffer(), _U), np.frombuffer(other.as_buffer(), _U)
        out.append(np.array([len(q), len(q) - _shared(p, q)]).astype(_U).tobytes() + np.setxor1d(p, q, assume_unique=True).tobytes())
    return pa.array(out, pa.binary())


def alike_members(left: list[np.ndarray], right: list[np.ndarray], same: bool) -> np.ndarray:
    """Which of the ``differences`` of one list are alike with which of the other, all being of one leader; with ``same`` both are one list, and none is alike with itself."""
    shared = np.zeros((len(left), len(right)), np.float32)
    values = [np.concatenate([p[2:] for p in m]) for m in (left, right)]
    both = np.intersect1d(*values)
    places = []
    for members, value in zip((left, right), values, strict=True):
        row = np.repeat(np.arange(len(members)), [len(p) - 2 for p in members])
        at = np.searchsorted(both, value)
        has = np.flatnonzero(both[np.minimum(at, len(both) - 1)] == value) if len(both) else at[:0]
        has = has[np.argsort(at[has], kind="stable")]
        places.append((row[has], at[has]))
    for lo in range(0, len(both), 2048):
        sides = []
        for members, (row, at) in zip((left, right), places, strict=True):
            i, j = np.searchsorted(at, (lo, lo + 2048))
            has = np.zeros((len(members), min(2048, len(both) - lo)), np.float32)
            has[row[i:j], at[i:j] - lo] = 1
            sides.append(has)
        shared += sides[0] @ sides[1].T
    leader = int(left[0][0])
    lack = [np.array([int(p[1]) for p in m]) for m in (left, right)]
    size = [leader - k + (np.array([len(p) - 2 for p in m]) - k) for k, m in zip(lack, (left, right), strict=True)]
    shared = leader - lack[0][:, None] - lack[1][None, :] + shared.astype(np.int64)
    yes = shared * DEN >= NUM * (size[0][:, None] + size[1][None, :] - shared)
    if same:
        np.fill_diagonal(yes, False)
    return yes


def reached(yes: np.ndarray, same: bool) -> np.ndarray:
    """For each row, and then for each column unless they are the rows, the number of a row that links lead to; -1 without links."""
    rows, columns = np.full(yes.shape[0], -1), np.full(yes.shape[1], -1)
    if same:
        columns = rows
    for start in np.flatnonzero(yes.any(axis=1)):
        if rows[start] >= 0:
            continue
        new = np.array([start])
        rows[start] = start
        while len(new):
            met = np.flatnonzero(yes[new].any(axis=0) & (columns < 0))
            columns[met] = start
            new = met
            if not same:
                new = np.flatnonzero(yes[:, met].any(axis=1) & (rows < 0))
                rows[new] = start
    return rows if same else np.concatenate((rows, columns))


def within_stars(star: DataFrame, members: DataFrame, block_members: int = 1024, block_bytes: int = 1 << 23) -> DataFrame:
    """A written table of (name, links, root), some rows a set: ``links`` sum to how many other members of its star it is alike with, and links lead from it to each ``root``. ``star``: (a, b) of one leader b for each member a."""
    x = star.join(members, star["a"] == members["name"]).select("a", "b", F.col("members").alias("x"))
    both = x.join(members, x["b"] == members["name"]).select("a", "b", "x", F.col("members").alias("y"))
    each = written(both.select("b", "a", F.arrow_udf(differences, "binary")("x", "y").alias("d")), "differences")
    # Blocks of a star, so that two of them fit in a task; every member goes to each pair of blocks that its own is one of.
    blocks = each.groupBy("b").agg(F.greatest(F.ceil(F.count(F.lit(1)) / block_members), F.ceil(F.sum(F.octet_length("d")) / block_bytes)).alias("blocks"), F.count(F.lit(1)).alias("n"))
    dealt = each.join(blocks.filter("n > 1").drop("n"), "b").withColumn("own", F.pmod(F.xxhash64("a"), F.col("blocks")))
    dealt = dealt.select("b", "a", "d", "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.select(F.xxhash64("b", F.least("own", "other"), F.greatest("own", "other")).alias("task"), "a", "d", (F.col("own") <= F.col("other")).alias("is_left"), (F.col("own") == F.col("other")).alias("same"))

    def count(rows: pa.Table) -> pa.Table:
        name, same = rows.column("a").to_numpy(), rows.column("same")[0].as_py()
        lists = [np.frombuffer(d.as_buffer(), _U) for d in rows.column("d").combine_chunks()]
        is_left = rows.column("is_left").to_numpy(zero_copy_only=False)
        left, right = np.flatnonzero(is_left), np.flatnonzero(is_left) if same else np.flatnonzero(~is_left)
        if not len(left) or not len(right):
            return pa.table({"name": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "root": pa.array([], pa.int64())})
        yes = alike_members([lists[i] for i in left], [lists[i] for i in right], same)
        links = yes.sum(axis=1) if same else np.concatenate((yes.sum(axis=1), yes.sum(axis=0)))
        some, root = np.flatnonzero(links), reached(yes, same)
        own = name[left] if same else np.concatenate((name[left], name[right]))
        return pa.table({"name": own[some], "links": links[some].astype(np.int64), "root": name[left][root[some]]})

    return written(dealt.groupBy("task").applyInArrow(count, "name long, links long, root long"), "within")


def size_class(size: Column) -> Column:
    """Classes by powers of two; the sizes of alike sets are of one class or of neighbouring ones."""
    return F.floor(F.log2(size.cast("double"))).cast("int")


def entries(table: DataFrame) -> DataFrame:
    """(shingle, name, size, place, part) of each prefix shingle of the sets in ``table`` (name, part, prefix)."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                name, part, prefix = (c.slice(at, 2048) for c in batch.columns)
                lists = [np.frombuffer(x.as_buffer(), _U) for x in prefix]
                lengths = np.array([len(x) - 1 for x in lists])
                row = np.repeat(np.arange(len(lists)), lengths)
                size = np.array([int(x[0]) for x in lists], np.int32)[row]
                place = (np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)).astype(np.int32)
                shingle = np.concatenate([x[1:] for x in lists]).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(shingle), pa.array(name.to_numpy()[row]), pa.array(size), pa.array(place), pa.array(part.to_numpy()[row])], ["shingle", "name", "size", "place", "part"])

    return table.select("name", "part", "prefix").mapInArrow(emit, "shingle long, name long, size int, place int, part long")


def candidates(index: DataFrame) -> DataFrame:
    """(a, b): pairs of different parts that neither sizes nor positions rule out."""
    own = size_class(F.col("size"))
    x = index.select("shingle", own.alias("class"), *[F.col(c).alias(f"x_{c}") for c in ("name", "size", "place", "part")])
    # The smaller set of a pair meets, with a shingle at this place, sets of at most so many shingles: only blocks up to that size, and none from a ninth of its places on.
    most = F.floor((F.col("size") - F.col("place")) * (NUM + DEN) / NUM) - F.col("size")
    reach = F.when(size_class(most) > own, F.array(own, own + 1)).otherwise(F.array(own))
    y = index.filter(most >= F.col("size")).select("shingle", F.explode(reach).alias("class"), *[F.col(c).alias(f"y_{c}") for c in ("name", "size", "place", "part")])
    both = F.col("x_size").cast("long") + F.col("y_size")

    def room(side: str) -> Column:
        # Alike sets share at least NUM / (NUM + DEN) of both sizes.
        return (F.col(f"{side}_size") - F.col(f"{side}_place")) * (NUM + DEN) >= both * NUM

    larger = (F.col("x_size") > F.col("y_size")) | ((F.col("x_size") == F.col("y_size")) & (F.col("x_name") > F.col("y_name")))
    near = F.col("y_size") * F.lit(DEN) >= F.col("x_size") * F.lit(NUM)
    met = x.join(y, [x["shingle"] == y["shingle"], x["class"] == y["class"], larger, near, F.col("x_part") != F.col("y_part"), room("x"), room("y")])
    return met.select(F.col("x_name").alias("a"), F.col("y_name").alias("b")).distinct()


def join(documents: DataFrame, key: str = "doc_id", text: str = "text", n: int = 5, count_links: bool = True) -> DataFrame:
    """(key, n_shingles, component_id, n_links) per document; ``n_links`` counts the other different sets that are alike, and is left out without ``count_links``."""
    docs = describe(documents, key, text, n, hot_shingles(documents, text, n), sketched=count_links)
    full = docs.filter("size > 0")
    reps = full.groupBy("name").agg(F.min("rid").alias("rid"), F.min("key").alias("first"))
    reps = written(full.drop("prefix", "name").join(reps, "rid"), "reps")
    wanted = reps.select("key", "name")

    prefixes = docs.join(small_side(reps.select("rid"), 32), "rid", "left_semi").select("name", F.col("prefix").alias("members"))
    if count_links:
        part = loose_stars(reps)
        inside = within_stars(part, spelled(documents, key, text, n, wanted, part))
        near, part = inside.select(F.col("name").alias("a"), F.col("root").alias("b")), part.select(F.col("a").alias("node"), F.col("b").alias("root"))
    else:
        stars = []
        for m in (f"m{k}" for k in range(STARS)):
            leader = reps.groupBy(m).agg(F.min_by("name", F.struct("first", "rid")).alias("b"), F.count(F.lit(1)).alias("n")).filter("n > 1").select(m, "b")
            stars.append(reps.select(F.col("name").alias("a"), m).join(leader, m).filter("a != b").select("a", "b"))
        stars = paired(written(reduce(DataFrame.unionByName, stars).distinct(), "stars"), prefixes, maybe_alike)
        stars = written(stars, "stars")
        near = written(paired(stars, spelled(documents, key, text, n, wanted, stars), alike), "near")
        part = components(near)

    parts = reps.select("rid", "name").join(part.withColumnRenamed("node", "name"), "name", "left")
    parts = small_side(written(parts.select("rid", F.coalesce("root", "name").alias("part")), "parts"), 48)
    index = entries(docs.select("rid", "name", "prefix").join(parts, "rid"))
    pairs = written(paired(written(candidates(index), "met"), prefixes, maybe_alike), "pairs")
    far = written(paired(pairs, spelled(documents, key, text, n, wanted, pairs), alike), "links")

    links = near.unionByName(far)
    roots = components(links)
    placed = docs.select("rid", "key", "size", "name").join(roots.withColumnRenamed("node", "name"), "name", "left").withColumn("root", F.coalesce("root", "name"))
    if count_links:
        ends = far.select(F.explode(F.array("a", "b")).alias("name")).groupBy("name").agg(F.count(F.lit(1)).alias("links"))
        degree = ends.unionByName(inside.select("name", "links")).groupBy("name").agg(F.sum("links").alias("links"))
        placed = placed.join(degree, "name", "left")
    least = placed.filter("size > 0").groupBy("root").agg(F.min("key").alias("least"))
    out = placed.join(least, "root", "left")
    return out.select(
        F.col("key").alias(key),
        F.col("size").alias("n_shingles"),
        F.when(F.col("size") > 0, F.col("least")).otherwise(F.col("key")).alias("component_id"),
        *([F.coalesce("links", F.lit(0)).alias("n_links")] if count_links else []),
    )


def firsts(documents: DataFrame, key: str = "doc_id", text: str = "text", n: int = 5) -> DataFrame:
    """The documents that are the first of their component, and those with an empty set, with their columns. Rows repeated whole go too; so does a null key where others share the set."""
    found = join(documents, key, text, n, count_links=False)
    later = found.filter(~F.col(key).eqNullSafe(F.col("component_id"))).select(F.col(key).alias("later")).distinct()
    later = small_side(later, 32)
    return documents.join(later, documents[key].eqNullSafe(later["later"]), "left_anti")
