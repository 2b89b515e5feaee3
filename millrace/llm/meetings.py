"""Candidate search for similarity joins: items that share a signature meet, and some that meet are linked.

Signatures travel packed: a slice of the input sends each part of the hash
space one row with 30 bits of every signature and the item's number in the
slice. Items that meet are compared by a lower bound of their difference, the
number of bits in which their parity sketches differ, and then exactly. Small
meetings are a plain join. Large ones are cut into pairs of blocks of bounded
size, which pass on only each item's hub and its nearest partner; once those are
verified, what may still be linked across components is looked at, so a large
group of near copies costs a few links an item and loses none that connects.
Where links are counted, blocks judge every pair once, in the largest meeting
that it shares, and pass on each item's number of links and those that connect.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from millrace.llm.components import components
from millrace.llm.frames import written

# Items in a meeting that are compared by a plain join, and the size of blocks beyond.
SMALL_GROUP = 24
BLOCK = 600
# Sum of the sizes of a block's items, unless a single one is larger.
BLOCK_SIZES = 1 << 20
# Hubs of a block at first, and the meetings of an item that are looked at for them.
HUBS = 64
FIRST_MEETINGS = 2
INDEX, PROBE = 1, 2
# Items whose sketches are counted together.
ITEMS_AT_ONCE = 512
PACKED = "bucket int, chunk long, kind int, keys binary, items binary, tags binary"
_NAMES = ["bucket", "chunk", "kind", "keys", "items", "tags"]
_KINDS = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]


def _parts(bits: int) -> list[str]:
    return [f"s{k}" for k in range(bits // 64)]


@dataclass(frozen=True)
class Bound:
    """Sketches have ``bits`` bits. Linked items of sizes x and y differ in at most (per_size * (x + y) + fixed) / scale bits, and their sizes by ``sizes``."""

    bits: int
    scale: int
    per_size: int
    fixed: int
    sizes: int | None = None

    def fits(self, differ, one, two):
        return differ * self.scale <= (one + two) * self.per_size + self.fixed


def sketches(hashes: np.ndarray, owner: np.ndarray, items: int, bits: int) -> np.ndarray:
    """Parity of each item's hashes in each of ``bits`` parts, packed."""
    out = []
    for start in range(0, items, ITEMS_AT_ONCE):
        end = min(items, start + ITEMS_AT_ONCE)
        a, b = np.searchsorted(owner, [start, end])
        place = (hashes[a:b] >> np.uint64(7)).astype(np.int64)
        # The remainder by a power of two is its lowest bits.
        place = place % bits if bits & (bits - 1) else place & (bits - 1)
        place += (owner[a:b] - start) * bits
        parity = np.bincount(place, minlength=(end - start) * bits).astype(np.uint8) & 1
        out.append(np.packbits(parity.reshape(-1, bits), axis=1))
    return np.concatenate(out) if out else np.zeros((0, bits // 8), np.uint8)


def packed(chunk: int, buckets: int, ids, sizes, sketch, names, owner, role, tags=None):
    """Rows of one slice: a head with all items, and the signatures by part of the hash space.

    ``tags`` tell equal items of different slices: of entries with one
    signature and one tag a single one takes part.
    """
    head = np.asarray(ids, np.int64).tobytes() + np.asarray(sizes, np.int64).tobytes() + sketch.tobytes()
    yield pa.record_batch([pa.array([x], k) for x, k in zip([chunk % buckets, chunk, 0, head, b"", b""], _KINDS)], _NAMES)
    if not len(names):
        return
    bucket = ((names >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)
    short = (names.astype(np.uint32) & np.uint32(0xFFFFFFFC)) | role
    # Numbers of 16 bits are sorted by their digits.
    order = np.argsort(bucket.astype(np.uint16) if buckets <= 2**16 else bucket, kind="stable")
    bucket, short = bucket[order], short[order]
    owner = owner[order]
    tag = tags[owner] if tags is not None else None
    owner = owner.astype(np.uint16 if len(ids) < 2**16 else np.uint32)
    cuts = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket))
    parts = list(zip(cuts[:-1], cuts[1:]))
    columns = [
        bucket[cuts[:-1]],
        np.full(len(parts), chunk, np.int64),
        np.ones(len(parts), np.int32),
        [short[a:b].tobytes() for a, b in parts],
        [owner[a:b].tobytes() for a, b in parts],
        [tag[a:b].tobytes() if tag is not None else b"" for a, b in parts],
    ]
    yield pa.record_batch([pa.array(x, k) for x, k in zip(columns, _KINDS)], _NAMES)


def _wide(data: bytes, count: int) -> np.ndarray:
    return np.frombuffer(data, np.uint16 if len(data) == 2 * count else np.uint32).astype(np.int64)


def _meet(table: pa.Table) -> pa.Table:
    """Signatures that an index entry of one item and a probe of another share, by slice; heads pass through."""
    chunks, kinds, keys, items, tags = (table[c].to_pylist() for c in ("chunk", "kind", "keys", "items", "tags"))
    bucket = table["bucket"][0].as_py()
    out = [(chunks[k], 0, keys[k], b"") for k in range(len(kinds)) if kinds[k] == 0]
    rows = [k for k in range(len(kinds)) if kinds[k] == 1]
    if rows:
        held = [np.frombuffer(keys[k], np.uint32) for k in rows]
        node = np.concatenate([_wide(items[k], len(h)) + (r << 32) for r, (k, h) in enumerate(zip(rows, held))])
        every = np.concatenate(held)
        short, roles = every >> np.uint32(2), (every & np.uint32(3)).astype(np.uint8)
        tag = np.concatenate([np.frombuffer(tags[k], np.uint32) for k in rows]).astype(np.int64) if tags[rows[0]] else node
        order = np.argsort(short, kind="stable")
        short, roles, node, tag = short[order], roles[order], node[order], tag[order]
        begin = np.flatnonzero(np.append(True, short[1:] != short[:-1]))
        sizes = np.diff(np.append(begin, len(short)))
        met = (np.bitwise_or.reduceat(roles, begin) == INDEX | PROBE) & (np.minimum.reduceat(tag, begin) != np.maximum.reduceat(tag, begin))
        hit = np.repeat(met, sizes)
        name, node, tag = (short[hit].astype(np.int64) << 24) | (bucket & 0xFFFFFF), node[hit], tag[hit]
        # One entry of each different item.
        order = np.lexsort((node, tag, name))
        name, node, tag = name[order], node[order], tag[order]
        if len(name):
            new = np.append(True, (name[1:] != name[:-1]) | (tag[1:] != tag[:-1]))
            name, node = name[new], node[new]
            order = np.argsort(node >> 32, kind="stable")
            name, node = name[order], node[order]
            row = node >> 32
            cuts = np.append(np.flatnonzero(np.append(True, row[1:] != row[:-1])), len(row))
            for a, b in zip(cuts[:-1], cuts[1:]):
                out.append((chunks[rows[row[a]]], 1, name[a:b].tobytes(), (node[a:b] & 0xFFFFFFFF).astype(np.uint32).tobytes()))
    columns = zip(*out) if out else [[]] * 4
    return pa.table([pa.array(c, k) for c, k in zip(columns, _KINDS[1:5])], ["chunk", "kind", "keys", "items"])


def _members(bits: int):
    """Meetings of one slice by item, and size and sketch of each item that meets another."""

    def run(table: pa.Table) -> pa.Table:
        kinds, keys, items = (table[c].to_pylist() for c in ("kind", "keys", "items"))
        head = keys[kinds.index(0)]
        width = bits // 8
        count = len(head) // (16 + width)
        ids, sizes = np.frombuffer(head, np.int64, count), np.frombuffer(head, np.int64, count, 8 * count)
        sketch = np.frombuffer(head, np.int64, count * width // 8, 16 * count).reshape(count, width // 8)
        rows = [k for k, kind in enumerate(kinds) if kind == 1]
        name = np.concatenate([np.frombuffer(keys[k], np.int64) for k in rows] or [np.zeros(0, np.int64)])
        at = np.concatenate([np.frombuffer(items[k], np.uint32) for k in rows] or [np.zeros(0, np.uint32)]).astype(np.int64)
        some = np.unique(at)
        none = np.zeros(len(at), np.int64)
        columns = {"meeting": np.concatenate([name, np.full(len(some), -1)]), "item": np.concatenate([ids[at], ids[some]])}
        columns["n"] = np.concatenate([sizes[at], sizes[some]])
        for k, part in enumerate(_parts(bits)):
            columns[part] = np.concatenate([none, sketch[some, k]])
        return pa.table({column: pa.array(values, pa.int64()) for column, values in columns.items()})

    return run


def _crossing(bound: Bound, linked: Callable[[bytes, bytes], bool] | None = None):
    """Pairs of a block that may be linked and are not yet connected.

    Without ``linked``, few of them: hubs are chosen that most others may be
    linked with, and every item gets its hub and its nearest partner. With it,
    all are judged by their contents and those that connect are given.
    """

    def run(table: pa.Table) -> pa.Table:
        items, sizes, known, part = (table[c].to_numpy() for c in ("item", "n", "component", "part"))
        sketch = np.stack([table[c].to_numpy() for c in _parts(bound.bits)], axis=1).view(np.uint64)
        count = len(items)
        pairs = np.zeros((0, 2), np.int64)
        if known.min() != known.max():
            ok, nearest = np.zeros((count, count), bool), np.full(count, -1)
            for k in range(count):
                differ = np.bitwise_count(sketch ^ sketch[k]).sum(axis=1, dtype=np.int64)
                row = bound.fits(differ, sizes, sizes[k]) & (known != known[k]) & (items != items[k])
                if bound.sizes is not None:
                    row &= np.abs(sizes - sizes[k]) <= bound.sizes
                ok[k] = row
                if row.any():
                    nearest[k] = np.where(row, differ, 2**40).argmin()
            if part.min() != part.max():
                ok &= part[:, None] != part[None, :]
            if linked is None:
                a, b = _by_hubs(ok)
                own = np.flatnonzero((nearest >= 0) & ok[np.arange(count), nearest])
                a, b = np.concatenate([a, own]), np.concatenate([b, nearest[own]])
            else:
                a, b = _connecting(np.triu(ok), known, table["content"], linked)
            one, two = items[a], items[b]
            pairs = np.unique(np.stack([np.minimum(one, two), np.maximum(one, two)], axis=1), axis=0)
        return pa.table({"a": pa.array(pairs[:, 0], pa.int64()), "b": pa.array(pairs[:, 1], pa.int64())})

    return run


def _connecting(ok: np.ndarray, known: np.ndarray, contents: pa.ChunkedArray, linked: Callable[[bytes, bytes], bool]):
    """Linked pairs that connect components of the block."""
    label = np.unique(known, return_inverse=True)[1]
    held: dict[int, bytes] = {}
    a, b = [], []
    for x in range(len(ok)):
        for y in np.flatnonzero(ok[x]).tolist():
            if label[x] == label[y]:
                continue
            for k in (x, y):
                if k not in held:
                    held[k] = contents[k].as_py()
            if linked(held[x], held[y]):
                a.append(x)
                b.append(y)
                label[label == label[y]] = label[x]
    return np.array(a, np.int64), np.array(b, np.int64)


def _by_hubs(ok: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each item with the hub that covers it; hubs are taken by the number of items that they still cover."""
    open_items = ok.any(axis=1)
    a, b = [], []
    for _ in range(HUBS):
        gain = ok[open_items].sum(axis=0) if open_items.any() else np.zeros(1)
        if gain.max() < 2:
            break
        hub = int(gain.argmax())
        covered = np.flatnonzero(ok[hub] & open_items)
        a.append(covered)
        b.append(np.full(len(covered), hub))
        open_items[covered] = open_items[hub] = False
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *a]), np.concatenate([none, *b])


def _counted(bound: Bound, judged: Callable[[pa.ChunkedArray, np.ndarray, np.ndarray], np.ndarray]):
    """Of a block, the number of linked pairs of each item (a, null, n), and links that connect the same items (a, b, null).

    ``before`` names the larger meetings of an item; pairs that share one of them are judged there.
    """

    def run(table: pa.Table) -> pa.Table:
        items, sizes, part = (table[c].to_numpy() for c in ("item", "n", "part"))
        sketch = np.stack([table[c].to_numpy() for c in _parts(bound.bits)], axis=1).view(np.uint64)
        count = len(items)
        ok = np.zeros((count, count), bool)
        for k in range(count - 1):
            differ = np.bitwise_count(sketch[k + 1 :] ^ sketch[k]).sum(axis=1, dtype=np.int64)
            ok[k, k + 1 :] = bound.fits(differ, sizes[k + 1 :], sizes[k])
            if bound.sizes is not None:
                ok[k, k + 1 :] &= np.abs(sizes[k + 1 :] - sizes[k]) <= bound.sizes
        if table["i"][0].as_py() != table["j"][0].as_py():
            ok &= part[:, None] != part[None, :]
        ok &= ~_sharing(table["before"].to_pylist())
        a, b = np.nonzero(ok)
        yes = judged(table["content"], a, b)
        ok[a[~yes], b[~yes]] = False
        ok |= ok.T
        number = ok.sum(axis=1)
        some = np.flatnonzero(number)
        one, two = _tree(ok)
        none = np.zeros(len(one), np.int64)
        columns = {
            "a": pa.array(np.concatenate([items[some], items[one]]), pa.int64()),
            "b": pa.array(np.concatenate([number[some], items[two]]), pa.int64(), mask=np.arange(len(some) + len(one)) < len(some)),
            "n": pa.array(np.concatenate([number[some], none]), pa.int64(), mask=np.arange(len(some) + len(one)) >= len(some)),
        }
        return pa.table(columns)

    return run


def _sharing(lists: list[list[int]]) -> np.ndarray:
    """Which pairs of lists have an entry in common."""
    shared = np.zeros((len(lists), len(lists)), bool)
    owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    names, code, times = np.unique(np.array([x for part in lists for x in part], np.int64), return_inverse=True, return_counts=True)
    several = np.flatnonzero(times > 1)
    place = np.full(len(names), -1)
    place[several] = np.arange(len(several))
    column = place[code]
    for start in range(0, len(several), 1024):
        now = (column >= start) & (column < start + 1024)
        has = np.zeros((len(lists), min(1024, len(several) - start)), np.float32)
        has[owner[now], column[now] - start] = 1
        shared |= has @ has.T > 0
    return shared


def _tree(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that reach from the first item of each component to all others."""
    seen = ~linked.any(axis=1)
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for root in range(len(linked)):
        ahead = [] if seen[root] else [root]
        seen[root] = True
        while ahead:
            at = ahead.pop()
            new = np.flatnonzero(linked[at] & ~seen)
            seen[new] = True
            a.append(np.full(len(new), at))
            b.append(new)
            ahead += new.tolist()
    return np.concatenate(a), np.concatenate(b)


def _blocks(members: DataFrame) -> DataFrame:
    """Members of a meeting dealt to pairs of blocks of bounded size."""
    parts = F.greatest(F.ceil(F.col("n_items") / BLOCK), F.ceil(F.col("n_all") / BLOCK_SIZES)).cast("int")
    dealt = members.withColumn("part", F.pmod(F.xxhash64("item"), parts).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    return dealt.withColumn("i", F.least("part", "other")).withColumn("j", F.greatest("part", "other")).drop("other")


def _verified(pairs: DataFrame, contents: DataFrame, linked: Callable[[bytes, bytes], bool]) -> DataFrame:
    def run(batches):
        for batch in batches:
            ok = [linked(x.as_py(), y.as_py()) for x, y in zip(batch["one"], batch["two"])]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    left = contents.select(F.col("item").alias("a"), F.col("content").alias("one"))
    right = contents.select(F.col("item").alias("b"), F.col("content").alias("two"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "one", "two").mapInArrow(run, "a long, b long")


def _candidates(rows: DataFrame, bound: Bound) -> tuple[DataFrame, DataFrame]:
    """Members of large meetings, and the close pairs of small ones."""
    met = rows.groupBy("bucket").applyInArrow(_meet, "chunk long, kind int, keys binary, items binary")
    columns = ", ".join(f"{c} long" for c in ["meeting", "item", "n", *_parts(bound.bits)])
    members = written(met.groupBy("chunk").applyInArrow(_members(bound.bits), columns), "members")
    named = members.filter("meeting >= 0").select("meeting", "item", "n")
    known = members.filter("meeting < 0").drop("meeting").dropDuplicates(["item"])
    # Meetings of the very same items are looked at once.
    groups = named.groupBy("meeting").agg(
        F.count("*").alias("n_items"), F.sum("n").alias("n_all"), F.bit_xor(F.xxhash64("item")).alias("x"), F.bit_xor(F.xxhash64("item", F.lit(1))).alias("y")
    )
    groups = groups.groupBy("n_items", "n_all", "x", "y").agg(F.min("meeting").alias("meeting")).select("meeting", "n_items", "n_all")
    members = written(named.drop("n").join(groups, "meeting").join(known, "item"), "meetings")
    small = members.filter(F.col("n_items") <= SMALL_GROUP)
    left, right = small.alias("l"), small.alias("r")
    differ = sum((F.bit_count(F.col(f"l.{c}").bitwiseXOR(F.col(f"r.{c}"))) for c in _parts(bound.bits)), F.lit(0))
    close = bound.fits(differ, F.col("l.n"), F.col("r.n"))
    if bound.sizes is not None:
        close &= F.abs(F.col("l.n") - F.col("r.n")) <= bound.sizes
    pairs = left.join(right, (F.col("l.meeting") == F.col("r.meeting")) & (F.col("l.item") < F.col("r.item")) & close)
    pairs = written(pairs.select(F.col("l.item").alias("a"), F.col("r.item").alias("b")).distinct(), "pairs")
    return members.filter(F.col("n_items") > SMALL_GROUP), pairs


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("item")).union(pairs.select("b"))


def _held(items: DataFrame, contents: Callable[[DataFrame], DataFrame]) -> DataFrame:
    return written(contents(written(items.distinct(), "wanted")), "contents")


def links(
    rows: DataFrame,
    bound: Bound,
    contents: Callable[[DataFrame], DataFrame],
    linked: Callable[[bytes, bytes], bool],
) -> DataFrame:
    """(a, b): verified links between items that connect all items that are linked.

    ``rows`` are PACKED; ``contents`` gives (item, content binary) of the
    wanted items; ``linked`` judges two contents. Small meetings give all
    their links, large ones a set that connects the same items.
    """
    large, pairs = _candidates(rows, bound)
    some = not large.isEmpty()
    if some:
        # These links need not be complete, so an item's largest meetings will do.
        largest = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("n_items"), "meeting"))
        joined = large.withColumn("place", largest).filter(F.col("place") <= FIRST_MEETINGS).drop("place")
        joined = joined.withColumn("component", F.col("item"))
        across = _blocks(joined).groupBy("meeting", "i", "j").applyInArrow(_crossing(bound), "a long, b long")
        pairs = written(pairs.union(across).distinct(), "pairs")
    found = written(_verified(pairs, _held(_ends(pairs), contents), linked), "links")
    if not some:
        return found
    # Meetings that hold items of several components are compared whole; the settled ones move no contents.
    known = components(found).select(F.col("node").alias("item"), "component")
    joined = written(large.join(known, "item", "left").withColumn("component", F.coalesce("component", "item")), "known")
    apart = joined.groupBy("meeting").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y")
    joined = written(joined.join(written(apart.select("meeting"), "apart"), "meeting"), "open")
    if joined.isEmpty():
        return found
    held = _held(joined.select("item"), contents)
    across = _blocks(joined.join(held, "item")).groupBy("meeting", "i", "j").applyInArrow(_crossing(bound, linked), "a long, b long")
    return found.union(written(across.distinct(), "links"))


def counted_links(
    rows: DataFrame,
    bound: Bound,
    contents: Callable[[DataFrame], DataFrame],
    linked: Callable[[bytes, bytes], bool],
    judged: Callable[[pa.ChunkedArray, np.ndarray, np.ndarray], np.ndarray],
) -> tuple[DataFrame, DataFrame]:
    """Links as of ``links``, and (item, n): with how many items each item is linked, however large its meetings.

    ``judged`` is ``linked`` for many pairs: it gets contents and the places
    of either end and tells which pairs are linked.
    """
    large, pairs = _candidates(rows, bound)
    some = not large.isEmpty()
    if some:
        # Pairs that also share a large meeting are judged there.
        shared = written(large.groupBy("item").agg(F.collect_set("meeting").alias("m")), "shared")
        left, right = shared.select(F.col("item").alias("a"), F.col("m").alias("x")), shared.select(F.col("item").alias("b"), F.col("m").alias("y"))
        pairs = pairs.join(left, "a", "left").join(right, "b", "left").filter(~F.coalesce(F.arrays_overlap("x", "y"), F.lit(False)))
        pairs = written(pairs.select("a", "b"), "pairs")
    held = _held(_ends(pairs).union(large.select("item")), contents)
    found = written(_verified(pairs, held, linked), "links")
    ends = found.select(F.col("a").alias("item")).union(found.select("b")).withColumn("n", F.lit(1).cast("long"))
    if some:
        larger = Window.partitionBy("item").orderBy(F.desc("n_items"), "meeting").rowsBetween(Window.unboundedPreceding, -1)
        joined = _blocks(large.withColumn("before", F.collect_list("meeting").over(larger)).join(held, "item"))
        across = joined.groupBy("meeting", "i", "j").applyInArrow(_counted(bound, judged), "a long, b long, n long")
        across = written(across, "counted")
        found = found.union(across.filter("n IS NULL").select("a", "b"))
        ends = ends.union(across.filter("n IS NOT NULL").select("a", "n"))
    return found, ends.groupBy("item").agg(F.sum("n").alias("n"))
