"""Substring deduplication by fixed-block anchors.

Any 50 consecutive words hold a whole block of 25 words that begins at a
multiple of 25 of its document. So every document's non-overlapping blocks are
the index, and every rolling window of 25 words of every document is a probe.
A block that is met in two documents anchors the repeats around it: the
windows of 50 words that touch an anchor are compared exactly (by two hashes)
across documents, and the runs of windows that an earlier document also has are
the maximal repeats that are removed.

Probes travel packed: a slice of documents sends each part of the hash space
one row with its different hashes, so a passage that stands in a third of all
documents costs one entry a slice, and no group holds more than one entry of a
hash for each slice. Texts travel once, and only documents with anchors are
kept for the second step. Documents whose words all repeat another's are
settled before by a digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from millrace.llm import ragged
from millrace.llm.frames import map_texts, named_inside, only_wanted, written

WINDOW = 50
# Words that one part of the hash space receives on average.
WORDS_PER_BUCKET = 250_000
# Bytes of text of one slice of the second step.
SLICE_BYTES = 4 << 20
# Bytes of text of one slice of probes; larger slices repeat fewer hashes.
PROBE_BYTES = 4 << 20
_ROLL = (0x9FB21C651E98DF25, 0xC6A4A7935BD1E995, 0x8EBC6AF09C88C6E3)
_PROBES = "bucket int, chunk long, kind int, keys binary, places binary"


def word_digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, sha256 of the words joined by one space) of every row."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        buf, offsets = ragged.column_bytes(batch["text"])
        counts = np.diff(ragged.words(buf, offsets)[2])
        raw = buf.tobytes()
        sums = [hashlib.sha256(b" ".join(raw[offsets[k] : offsets[k + 1]].split())).hexdigest() for k in range(batch.num_rows)]
        return pa.record_batch([batch["id"], pa.array(counts), pa.array(sums, pa.string())], ["doc_id", "n_words", "sha"])

    return map_texts(_by_id(docs, doc_id), {"id": doc_id, "text": text}, run, "doc_id long, n_words long, sha string")


def _by_id(docs: DataFrame, doc_id: str) -> DataFrame:
    return docs.withColumn(doc_id, F.col(f"`{doc_id}`").cast("long"))


def _chunk_ids() -> Iterator[int]:
    first = TaskContext.get().partitionId() << 32
    while True:
        yield first
        first += 1


def _probes(docs: DataFrame, doc_id: str, text: str, block: int, buckets: int) -> DataFrame:
    """Packed probes of every slice, with a row that tells places from documents."""
    chosen = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text")).filter("id IS NOT NULL")

    def run(batches):
        chunk = _chunk_ids()
        for batch in ragged.slices(batches, "text", PROBE_BYTES):
            own = next(chunk)
            buf, offsets = ragged.column_bytes(batch["text"])
            starts, ends, firsts = ragged.words(buf, offsets)
            good = np.flatnonzero(ragged.within(firsts, block))
            if not len(good):
                continue
            ids = batch["id"].to_numpy(zero_copy_only=False)
            hashes = ragged.window_hashes(ragged.span_hashes(buf, starts, ends), block, _ROLL[0])[good]
            owner = np.searchsorted(firsts, good, "right") - 1
            order = np.argsort(hashes, kind="stable")
            sorted_hashes = hashes[order]
            new = np.append(True, sorted_hashes[1:] != sorted_hashes[:-1])
            group = np.flatnonzero(new)
            aligned = ((good - firsts[owner]) % block == 0)[order]
            several = np.maximum.reduceat(owner[order], group) != owner[order[group]]
            flags = np.logical_or.reduceat(aligned, group) * 2 + several
            first = order[group]
            again = order[~new]
            origin = first[np.cumsum(new) - 1][~new]
            yield _row(
                own % buckets, own, 0, ids.astype(np.int64).tobytes() + firsts.astype(np.int64).tobytes(),
                np.stack([good[again], good[origin]]).astype(np.uint32).tobytes(),
            )
            key = sorted_hashes[group]
            bucket = (key >> np.uint64(32)) % np.uint64(buckets)
            short = (key.astype(np.uint32) & np.uint32(0xFFFFFFFC)) | flags.astype(np.uint32)
            place = good[first]
            # By bucket, and by place within it.
            order = np.argsort(place)
            order = order[np.argsort(bucket[order].astype(np.int32), kind="stable")]
            bucket, short, place = bucket[order].astype(np.int64), short[order], place[order]
            cuts = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket))
            names = bucket[cuts[:-1]]
            yield pa.record_batch(
                [
                    pa.array(names, pa.int32()),
                    pa.array(np.full(len(names), own)),
                    pa.array(np.ones(len(names)), pa.int32()),
                    pa.array([short[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary()),
                    pa.array([_steps(place[a:b]) for a, b in zip(cuts[:-1], cuts[1:])], pa.binary()),
                ],
                ["bucket", "chunk", "kind", "keys", "places"],
            )

    return chosen.mapInArrow(run, _PROBES)


def _row(bucket, chunk, kind, keys, places):
    return pa.record_batch(
        [pa.array([bucket], pa.int32()), pa.array([chunk], pa.int64()), pa.array([kind], pa.int32()), pa.array([keys], pa.binary()), pa.array([places], pa.binary())],
        ["bucket", "chunk", "kind", "keys", "places"],
    )


def _steps(places: np.ndarray) -> bytes:
    """Ascending places as steps of two bytes, or of four if one is wide."""
    steps = np.diff(places, prepend=0)
    if steps.max() < 2**16:
        return steps.astype(np.uint16).tobytes()
    return steps.astype(np.uint32).tobytes()


def _places(data: bytes, count: int) -> np.ndarray:
    return np.cumsum(np.frombuffer(data, np.uint16 if len(data) == 2 * count else np.uint32).astype(np.int64))


def _meet(table: pa.Table) -> pa.Table:
    """Probes that meet another document's at an index block; the rows about documents pass through."""
    chunks, kinds = table["chunk"].to_pylist(), table["kind"].to_pylist()
    keys, places = table["keys"].to_pylist(), table["places"].to_pylist()
    out = [(chunks[k], 0, keys[k], places[k], 0) for k in range(len(kinds)) if kinds[k] == 0]
    rows = [k for k in range(len(kinds)) if kinds[k] == 1]
    if rows:
        held = [np.frombuffer(keys[k], np.uint32) for k in rows]
        bounds = np.concatenate([[0], np.cumsum([len(h) for h in held])])
        every = np.concatenate(held)
        order = np.argsort(every >> np.uint32(2), kind="stable")
        short, flags = every[order] >> np.uint32(2), every[order] & np.uint32(3)
        group = np.flatnonzero(np.append(True, short[1:] != short[:-1]))
        sizes = np.diff(np.append(group, len(short)))
        some = np.bitwise_or.reduceat(flags, group)
        live = ((some & 2) > 0) & (((some & 1) > 0) | (sizes > 1))
        hit = np.zeros(len(every), bool)
        hit[order] = np.repeat(live, sizes)
        for n, k in enumerate(rows):
            mine = hit[bounds[n] : bounds[n + 1]]
            if mine.any():
                at = _places(places[k], len(mine))[mine]
                out.append((chunks[k], 1, b"", _steps(at), len(at)))
    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int32()]
    columns = zip(*out) if out else [[]] * 5
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], ["chunk", "kind", "keys", "places", "n"])


def _anchors(table: pa.Table) -> pa.Table:
    """Anchored places of one slice, by document."""
    head = next(k for k, kind in enumerate(table["kind"].to_pylist()) if kind == 0)
    keys, places = table["keys"].to_pylist(), table["places"].to_pylist()
    numbers = np.frombuffer(keys[head], np.int64)
    documents = (len(numbers) - 1) // 2
    ids, firsts = numbers[:documents], numbers[documents:]
    live = np.zeros(int(firsts[-1]), bool)
    for k, (kind, count) in enumerate(zip(table["kind"].to_pylist(), table["n"].to_pylist())):
        if kind == 1:
            live[_places(places[k], count)] = True
    again = np.frombuffer(places[head], np.uint32).reshape(2, -1).astype(np.int64)
    live[again[0]] = live[again[1]]
    at = np.flatnonzero(live)
    owner = np.searchsorted(firsts, at, "right") - 1
    some = np.unique(owner)
    cuts = np.append(np.searchsorted(owner, some), len(at))
    marks = []
    for n, k in enumerate(some):
        own = at[cuts[n] : cuts[n + 1]] - firsts[k]
        begin = np.append(True, own[1:] != own[:-1] + 1)
        end = np.append(begin[1:], True)
        marks.append(np.stack([own[begin], own[end]]).astype(np.int32).tobytes())
    return pa.table({"doc_id": pa.array(ids[some], pa.int64()), "marks": pa.array(marks, pa.binary())})


def anchored(docs: DataFrame, doc_id: str, text: str, window: int, buckets: int) -> DataFrame:
    """(doc_id, marks): runs of places where a block begins that another document may share."""
    block = window // 2
    met = (
        _probes(docs, doc_id, text, block, buckets)
        .groupBy("bucket")
        .applyInArrow(_meet, "chunk long, kind int, keys binary, places binary, n int")
    )
    marks = met.groupBy("chunk").applyInArrow(_anchors, "doc_id long, marks binary")
    return marks.groupBy("doc_id").agg(F.collect_list("marks").alias("marks"))


def _window_keys(ids, texts, marks, window):
    """Different candidate windows of a slice: hashes, owners and places of all, number of its like, words."""
    buf, offsets = ragged.column_bytes(texts)
    starts, ends, firsts = ragged.words(buf, offsets)
    block = window // 2
    steps = np.zeros(int(firsts[-1]) + 2, np.int64)
    for k, runs in enumerate(marks):
        last = firsts[k + 1] - firsts[k] - window
        for part in runs:
            begin, end = np.frombuffer(part, np.int32).reshape(2, -1).astype(np.int64)
            begin, end = np.maximum(begin - (window - block), 0), np.minimum(end, last)
            fits = begin <= end
            np.add.at(steps, firsts[k] + begin[fits], 1)
            np.add.at(steps, firsts[k] + end[fits] + 1, -1)
    at = np.flatnonzero(np.cumsum(steps) > 0)
    values = ragged.span_hashes(buf, starts, ends)
    one = ragged.window_hashes(values, window, _ROLL[1])[at] if len(at) else np.zeros(0, np.uint64)
    two = ragged.window_hashes(values, window, _ROLL[2])[at] if len(at) else np.zeros(0, np.uint64)
    two = (two >> np.uint64(32)).astype(np.uint32)
    owner = ids[np.searchsorted(firsts, at, "right") - 1] if len(at) else np.zeros(0, np.int64)
    order = np.lexsort((owner, two, one))
    a, b = one[order], two[order]
    new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])) if len(a) else np.zeros(0, bool)
    like = np.zeros(len(a), np.int64)
    like[order] = np.cumsum(new) - 1
    group = np.flatnonzero(new)
    return (a[group], b[group], owner[order[group]], like, owner, at, (buf, starts, ends, firsts))


def _bucket_cuts(one, buckets):
    """Order of hashes by part of the hash space, the parts, and where each begins."""
    bucket = ((one >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    begin = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, np.int64)
    return order, bucket[begin], np.append(begin, len(bucket))


def _earliest(table: pa.Table) -> pa.Table:
    """Entries of a part of the hash space whose window an earlier document of another slice has."""
    one = [np.frombuffer(x, np.uint64) for x in table["one"].to_pylist()]
    two = np.concatenate([np.frombuffer(x, np.uint32) for x in table["two"].to_pylist()])
    docs = np.concatenate([np.frombuffer(x, np.int64) for x in table["docs"].to_pylist()])
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in one])])
    one = np.concatenate(one)
    order = np.lexsort((docs, two, one))
    a, b = one[order], two[order]
    new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
    least = np.zeros(len(docs), np.int64)
    least[order] = docs[order[np.flatnonzero(new)]][np.cumsum(new) - 1]
    chunks, at, found, named, buckets = table["chunk"].to_pylist(), [], [], [], table["bucket"].to_pylist()
    for k in range(len(chunks)):
        own = slice(bounds[k], bounds[k + 1])
        lower = np.flatnonzero(least[own] < docs[own])
        if len(lower):
            named.append(k)
            at.append(lower.astype(np.uint32).tobytes())
            found.append(least[own][lower].tobytes())
    return pa.table(
        {
            "chunk": pa.array([chunks[k] for k in named], pa.int64()),
            "bucket": pa.array([buckets[k] for k in named], pa.int32()),
            "at": pa.array(at, pa.binary()),
            "least": pa.array(found, pa.binary()),
        }
    )


def repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW
) -> tuple[DataFrame, DataFrame]:
    """Digests of all rows, and the repeats to remove of those that have some.

    The first table is (doc_id, n_words, sha, copy): ``copy`` marks documents
    of which an earlier one has the very same words. The second is (doc_id,
    sha, spans, n_removed, kept_sha256) for other documents with repeats;
    ``spans`` are [start, end) numbers of removed words. A word is removed if a
    window of ``window`` words covers it that also stands in a document with a
    smaller id. Rows with a null id are left alone; rows with equal
    ids do not repeat each other; null and short texts have no window.
    """
    spark = docs.sparkSession
    digests = written(word_digests(docs, doc_id, text), "digests")
    total = digests.agg(F.coalesce(F.sum("n_words"), F.lit(0)).alias("n")).first().n
    buckets = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), total // WORDS_PER_BUCKET)
    first = digests.filter(f"n_words >= {window} AND doc_id IS NOT NULL").groupBy("sha").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    # Written, so that the join has a shuffle on either side and Spark can split a text with very many copies.
    first = written(first.filter("n > 1").drop("n"), "firsts")
    flagged = digests.join(first, "sha", "left").select(
        "doc_id", "n_words", "sha", F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).alias("copy")
    )
    flagged = written(flagged, "copies")
    settled = flagged.groupBy("doc_id").agg(F.min("copy").alias("copy")).filter("copy").select("doc_id")
    marks = written(anchored(docs, doc_id, text, window, buckets).join(settled, "doc_id", "left_anti"), "marks")
    texts = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    joined = only_wanted(texts, marks)

    def gathered(batches):
        chunk = _chunk_ids()
        for batch in ragged.slices(batches, "text", SLICE_BYTES):
            row = [[next(chunk)], [batch["doc_id"].to_pylist()], [batch["text"].to_pylist()], [batch["marks"].to_pylist()]]
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.list_(pa.binary()))]
            yield pa.record_batch([pa.array(x, k) for x, k in zip(row, kinds)], ["chunk", "ids", "texts", "marks"])

    slices = written(joined.mapInArrow(gathered, "chunk long, ids array<long>, texts array<string>, marks array<array<binary>>"), "anchored")

    def entries(batches):
        for batch in batches:
            for n in range(batch.num_rows):
                row = batch.slice(n, 1).to_pylist()[0]
                one, two, owner, *_ = _window_keys(np.array(row["ids"], np.int64), pa.array(row["texts"], pa.string()), row["marks"], window)
                order, names, cuts = _bucket_cuts(one, buckets)
                one, two, owner = one[order], two[order], owner[order]
                parts = list(zip(cuts[:-1], cuts[1:]))
                yield pa.record_batch(
                    [
                        pa.array(names, pa.int32()),
                        pa.array(np.full(len(names), row["chunk"], np.int64)),
                        pa.array([one[a:b].tobytes() for a, b in parts], pa.binary()),
                        pa.array([two[a:b].tobytes() for a, b in parts], pa.binary()),
                        pa.array([owner[a:b].tobytes() for a, b in parts], pa.binary()),
                    ],
                    ["bucket", "chunk", "one", "two", "docs"],
                )

    answers = (
        slices.mapInArrow(entries, "bucket int, chunk long, one binary, two binary, docs binary")
        .groupBy("bucket")
        .applyInArrow(_earliest, "chunk long, bucket int, at binary, least binary")
    )

    def removed(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], [], []]
        for row in left.to_pylist():
            ids = np.array(row["ids"], np.int64)
            one, _, least, like, owner, at, (buf, starts, ends, firsts) = _window_keys(
                ids, pa.array(row["texts"], pa.string()), row["marks"], window
            )
            order, names, cuts = _bucket_cuts(one, buckets)
            where = {int(name): order[a:b] for name, a, b in zip(names, cuts[:-1], cuts[1:])}
            least = least.copy()
            for answer in right.to_pylist():
                mine = where[answer["bucket"]][np.frombuffer(answer["at"], np.uint32)]
                least[mine] = np.frombuffer(answer["least"], np.int64)
            covered = np.zeros(int(firsts[-1]) + window + 1, np.int64)
            gone = at[least[like] < owner]
            np.add.at(covered, gone, 1)
            np.add.at(covered, gone + window, -1)
            covered = np.cumsum(covered)[: int(firsts[-1])] > 0
            raw = buf.tobytes()
            for k in range(len(ids)):
                mask = covered[firsts[k] : firsts[k + 1]]
                if not mask.any():
                    continue
                a, b = starts[firsts[k] : firsts[k + 1]].tolist(), ends[firsts[k] : firsts[k + 1]].tolist()
                words = [raw[x:y] for x, y in zip(a, b)]
                kept = b" ".join([w for w, x in zip(words, mask.tolist()) if not x])
                edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
                out[0].append(int(ids[k]))
                out[1].append(hashlib.sha256(b" ".join(words)).hexdigest())
                out[2].append(edges.reshape(-1, 2).tolist())
                out[3].append(int(mask.sum()))
                out[4].append(hashlib.sha256(kept).hexdigest())
        kinds = [pa.int64(), pa.string(), pa.list_(pa.list_(pa.int32())), pa.int64(), pa.string()]
        names = ["doc_id", "sha", "spans", "n_removed", "kept_sha256"]
        return pa.table([pa.array(x, k) for x, k in zip(out, kinds)], names)

    changed = (
        slices.groupBy("chunk")
        .cogroup(answers.groupBy("chunk"))
        .applyInArrow(removed, "doc_id long, sha string, spans array<array<int>>, n_removed long, kept_sha256 string")
    )
    return flagged, changed.dropDuplicates(["doc_id", "sha"])


def digests_after(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row."""
    flagged, changed = repeats(docs, doc_id, text, window)
    empty = hashlib.sha256(b"").hexdigest()
    return flagged.join(changed.drop("spans"), ["doc_id", "sha"], "left").select(
        "doc_id",
        "n_words",
        F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(F.col("copy"), F.lit(empty)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    )


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without repeated words; what stands between kept words stays as it is.

    Rows of which every word goes are left out.
    """
    flagged, changed = repeats(docs, doc_id, text, window)
    whole = F.array(F.array(F.lit(0), F.col("n_words").cast("int")))
    gone = changed.select("doc_id", "sha", "spans").union(flagged.filter("copy").select("doc_id", "sha", whole.alias("spans")).distinct())
    of, spans_of = named_inside("of"), named_inside("gone")
    gone = gone.groupBy(F.col("doc_id").alias(of)).agg(F.collect_list(F.struct("sha", "spans")).alias(spans_of))
    joined = docs.join(gone, F.col(f"`{doc_id}`").cast("long") == F.col(of), "left").select(*[F.col(f"`{c}`") for c in docs.columns], spans_of)
    names = docs.columns

    def run(batches):
        for batch in ragged.slices(batches, text):
            buf, offsets = ragged.column_bytes(batch[text])
            starts, _, firsts = ragged.words(buf, offsets)
            raw, texts, kept = buf.tobytes(), batch[text].to_pylist(), np.ones(batch.num_rows, bool)
            for k, known in enumerate(batch[spans_of].to_pylist()):
                if known is None:
                    continue
                own = raw[offsets[k] : offsets[k + 1]]
                sha = hashlib.sha256(b" ".join(own.split())).hexdigest()
                spans = next((x["spans"] for x in known if x["sha"] == sha), [])
                begins = np.append(starts[firsts[k] : firsts[k + 1]] - offsets[k], len(own)).tolist()
                parts, at = [], 0
                for first, end in spans:
                    parts.append(own[at : begins[first]])
                    at = begins[end]
                left = b"".join([*parts, own[at:]])
                texts[k] = left.decode("utf-8")
                kept[k] = bool(left.split()) or not own.split()
            columns = [pa.array(texts, batch[name].type) if name == text else batch[name] for name in names]
            yield pa.record_batch(columns, names).filter(pa.array(kept))

    return joined.mapInArrow(run, docs.schema)
