"""Toxicity of texts behind simple disguises.

A word may be written in leetspeak, with repeated letters, or letter by letter.
Each suspicious word becomes a lattice: a symbol may be a letter that it looks
like, a separator, or nothing; a run of equal letters may be one or two; single
letters in a row may belong together. The best path by a noisy channel (a cost
for each disguise) and a character trigram model of the whole corpus is the
restored text. Its words and their beginnings are scored by a logistic model.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm import ragged
from millrace.llm.frames import map_texts
from millrace.llm.language import held_out

# Labelled texts of either class from which the model is learned, about.
FIT_TOXIC, FIT_CLEAN = 3000, 6000
# Words and beginnings of words that the model weighs, at most.
FEATURES = 1024
BEGINNINGS = (4, 5, 6, 7, 8)
# Letters that a symbol may stand for (fixed values).
LOOKS_LIKE = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l",
}
# Costs of the channel, in nats. A digit or a symbol within or before a word hardly ever means nothing,
# since leaving it out also saves what the character model asks for a letter.
AS_LETTER, SHORTENED, HALVED, BROKEN, PARTED, JOINED = 1.0, 0.3, 4.0, 1.0, 3.0, 0.5
DROPPED, DROPPED_AT_EDGE, LETTER_DROPPED, SYMBOL_AFTER, SYMBOLS_AFTER = 1.0, 0.2, 8.0, 3.0, 1.0
# Marks that also end sentences and part columns; after a word they are dropped like any other mark.
MARKS = "!|"
# Symbols of the character model: 0 is the border of a word, 1-26 a-z, then the accented letters of Latin-1, then any other.
SYMBOLS = 64
REMEMBERED = 300_000


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters (0 for anything else), and their symbol in the character model."""
    letters = ragged.char_classes() == ragged.LETTER
    low = np.zeros(0x110000, np.uint32)
    for point in np.flatnonzero(letters).tolist():
        other = chr(point).lower()
        low[point] = ord(other) if len(other) == 1 else point
    symbol = np.zeros(0x110000, np.uint8)
    symbol[letters] = SYMBOLS - 1
    symbol[97:123] = np.arange(1, 27)
    symbol[0xDF:0xFF] = np.arange(27, 59)
    return low, symbol


def symbol_of(letter: str) -> int:
    return int(_tables()[1][ord(letter)])


class Words:
    """The different words of a batch, and where they stand."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray):
        starts, ends, self.firsts = ragged.words(buf, offsets)
        place, self.like = ragged.distinct_spans(buf, starts, ends)
        self.size = len(place)
        inner = np.zeros(self.size + 1, np.int64)
        np.cumsum(ends[place] - starts[place], out=inner[1:])
        held = buf[np.arange(inner[-1]) + np.repeat(starts[place] - inner[:-1], np.diff(inner))]
        self.points, self.bounds, _ = ragged.code_points(held, inner)
        low, _ = _tables()
        self.letters = low[self.points]
        letter = self.letters > 0
        at = np.arange(len(letter))
        begin = self.bounds[:-1]
        if self.size:
            # The core of a word goes from its first to its last letter.
            self.first = np.minimum.reduceat(np.where(letter, at, len(letter)), begin)
            self.last = np.maximum.reduceat(np.where(letter, at, -1), begin) + 1
            self.some = self.last > 0
            inside = letter.astype(np.int64)
            count = np.add.reduceat(inside, begin)
            disguise = np.isin(self.points, [ord(c) for c in LOOKS_LIKE])
            thrice = np.zeros(len(letter), bool)
            thrice[2:] = letter[2:] & (self.letters[2:] == self.letters[1:-1]) & (self.letters[2:] == self.letters[:-2])
            owner = np.repeat(np.arange(self.size), np.diff(self.bounds))
            thrice[2:] &= owner[2:] == owner[:-2]
            odd = np.add.reduceat((disguise | thrice).astype(np.int64), begin) > 0
            # What has no letter may be written wholly in symbols.
            self.odd = np.where(self.some, odd | (count < self.last - self.first), odd & (np.diff(self.bounds) > 1))
            # A word of one character that can be read as a letter, and of marks around it.
            mark = np.isin(self.points, [ord(c) for c in MARKS])
            read, marks = letter | (disguise & ~mark), np.add.reduceat(mark.astype(np.int64), begin)
            reads = np.add.reduceat(read.astype(np.int64), begin)
            self.single = (reads == 1) | ((reads == 0) & (marks == 1))
            chosen = np.where(np.repeat(reads == 1, np.diff(self.bounds)), read, mark)
            self.sole = np.maximum.reduceat(np.where(chosen, at, -1), begin)
        else:
            self.first = self.last = self.sole = np.zeros(0, np.int64)
            self.some = self.odd = self.single = np.zeros(0, bool)

    def text(self, k: int) -> str:
        return self.points[self.bounds[k] : self.bounds[k + 1]].tobytes().decode("utf-32-le")

    def letter(self, k: int) -> str:
        """The character of a single word that can be read as a letter."""
        return chr(self.points[self.sole[k]])


def trigrams(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts of symbol trigrams over the plain words of some texts, borders included."""
    words = Words(buf, offsets)
    plain = np.flatnonzero(words.some & ~words.odd)
    total = np.zeros(SYMBOLS**3, np.int64)
    if not len(plain):
        return total
    times = np.bincount(words.like, minlength=words.size)[plain]
    lengths = words.last[plain] - words.first[plain]
    bounds = np.zeros(len(plain) + 1, np.int64)
    np.cumsum(lengths + 3, out=bounds[1:])
    symbols = np.zeros(bounds[-1], np.int64)
    at = np.arange(int(lengths.sum()))
    offset = np.cumsum(lengths) - lengths
    held = words.letters[at + np.repeat(words.first[plain] - offset, lengths)]
    symbols[at + np.repeat(bounds[:-1] + 2 - offset, lengths)] = _tables()[1][held]
    grams = symbols[:-2] * SYMBOLS**2 + symbols[1:-1] * SYMBOLS + symbols[2:]
    weight = np.repeat(times, lengths + 3)[:-2].astype(np.float64)
    inner = np.ones(len(symbols), bool)
    inner[bounds[1:] - 1] = inner[bounds[1:] - 2] = False
    inner = inner[:-2]
    return np.bincount(grams[inner], weight[inner], SYMBOLS**3).astype(np.int64)


def character_model(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Log probabilities of a symbol after two others, from the plain words of all texts."""

    def run(batches):
        total = np.zeros(SYMBOLS**3, np.int64)
        for batch in ragged.slices(batches, "text"):
            total += trigrams(*ragged.column_bytes(batch["text"]))
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some, pa.int32()), pa.array(total[some])], ["gram", "n"])

    found = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(run, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    counts = np.zeros(SYMBOLS**3)
    for row in found.collect():
        counts[row.gram] = row.n
    cube = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    pairs = cube.sum(axis=0)
    single = (pairs.sum(axis=0) + 1) / (pairs.sum() + SYMBOLS)
    after_one = (pairs + 5 * single) / (pairs.sum(axis=1, keepdims=True) + 5)
    return np.log((cube + 5 * after_one) / (cube.sum(axis=2, keepdims=True) + 5)).astype(np.float32)


class Restorer:
    """Viterbi decoding of disguised words under a character model."""

    def __init__(self, logs: np.ndarray):
        self.logs = logs.ravel().tolist()
        self.known: dict[str, tuple[str, ...]] = {}

    def restore(self, word: str) -> tuple[str, ...]:
        """Restored words of one written word; several letters in a row may be given with blanks between."""
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            found = self.known[word] = tuple(self._decode(word.lower()).split())
        return found

    def _decode(self, word: str) -> str:
        runs: list[tuple[str, int]] = []
        for char in word:
            if runs and runs[-1][0] == char:
                runs[-1] = (char, runs[-1][1] + 1)
            else:
                runs.append((char, 1))
        logs = self.logs
        # In a word without letters the last symbol is as much a letter as the others.
        bare = not any(_tables()[0][ord(char)] for char, _ in runs)
        # A path is its last letters and the path before them, so that a long run costs no copies.
        states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        for n, (char, times) in enumerate(runs):
            place = _place(n, len(runs))
            if bare and place == "last" and char not in MARKS:
                place = "inside"
            options = _options(char, times, place)
            after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (x, y), (score, path) in states.items():
                for letters, cost in options:
                    a, b, total = x, y, score - cost
                    for letter in letters:
                        if letter == " ":
                            if b:
                                total += logs[(a * SYMBOLS + b) * SYMBOLS]
                            a = b = 0
                        else:
                            c = symbol_of(letter)
                            total += logs[(a * SYMBOLS + b) * SYMBOLS + c]
                            a, b = b, c
                    held = after.get((a, b))
                    if held is None or held[0] < total:
                        after[a, b] = (total, (letters, path))
            states = after
        ended = [(score + (logs[(a * SYMBOLS + b) * SYMBOLS] if b else 0.0), path) for (a, b), (score, path) in states.items()]
        path = max(ended, key=lambda end: end[0])[1]
        parts = []
        while path is not None:
            letters, path = path
            parts.append(letters)
        return "".join(reversed(parts))


@lru_cache(maxsize=100_000)
def _options(char: str, times: int, place: str) -> tuple[tuple[str, float], ...]:
    """Readings of a run of one character ``first``, ``inside`` or ``last`` in its word, each with its cost."""
    if _tables()[0][ord(char)]:
        if times == 1:
            return ((char, 0.0),)
        if times == 2:
            return ((char * 2, 0.0), (char, HALVED))
        return ((char, SHORTENED), (char * 2, SHORTENED))
    if char == " ":
        # Single letters in a row: the blank falls away or parts two words.
        return (("", JOINED), (" ", PARTED))
    letters = LOOKS_LIKE.get(char, "")
    if not letters or (place == "last" and char in MARKS):
        dropped = DROPPED if place == "inside" else DROPPED_AT_EDGE
    elif place == "last" and not char.isdigit():
        dropped = SYMBOL_AFTER if times == 1 else SYMBOLS_AFTER
    else:
        dropped = LETTER_DROPPED
    out = [("", dropped)]
    if place == "inside":
        out.append((" ", BROKEN + (LETTER_DROPPED if letters else 0)))
    for letter in letters:
        out.append((letter, AS_LETTER + (SHORTENED if times > 1 else 0)))
        if times > 1:
            out.append((letter * 2, AS_LETTER + SHORTENED))
    return tuple(out)


def _place(n: int, runs: int) -> str:
    return "first" if n == 0 else "last" if n == runs - 1 else "inside"


def restored_words(words: Words, restorer: Restorer) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case letters of all different restored words with bounds, and for every text its words.

    Returns (letters, bounds, text, word): pairs (text, word) run over all words of all texts.
    """
    plain = np.flatnonzero(words.some & ~words.odd)
    lengths = words.last[plain] - words.first[plain]
    offset = np.cumsum(lengths) - lengths
    letters = [words.letters[np.arange(int(lengths.sum())) + np.repeat(words.first[plain] - offset, lengths)]]
    sizes = [lengths]
    number = np.full(words.size, -1)
    number[plain] = np.arange(len(plain))
    text_of = np.repeat(np.arange(len(words.firsts) - 1), np.diff(words.firsts))
    usual = number[words.like]
    texts, which = [text_of[usual >= 0]], [usual[usual >= 0]]
    count = len(plain)
    fresh: dict[str, int] = {}

    def add(word: str) -> int:
        nonlocal count
        if word not in fresh:
            fresh[word] = count
            count += 1
        return fresh[word]

    odd = np.flatnonzero(words.odd)
    parts = [[add(w) for w in restorer.restore(words.text(k))] for k in odd]
    flat, cuts = ragged.flattened(parts)
    row = np.full(words.size, -1)
    row[odd] = np.arange(len(odd))
    at = np.flatnonzero(row[words.like] >= 0)
    ids, inner = ragged.taken(flat, cuts, row[words.like[at]])
    texts.append(np.repeat(text_of[at], np.diff(inner)))
    which.append(ids)
    for text, spelled in spelled_out(words, text_of):
        for w in restorer.restore(spelled):
            texts.append(np.array([text]))
            which.append(np.array([add(w)]))
    for word in fresh:
        points = np.frombuffer(word.encode("utf-32-le"), np.uint32)
        letters.append(points)
        sizes.append(np.array([len(points)]))
    bounds = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
    return np.concatenate(letters), bounds, np.concatenate(texts), np.concatenate(which)


def spelled_out(words: Words, text_of: np.ndarray, least: int = 2) -> list[tuple[int, str]]:
    """Runs of ``least`` or more single characters that may be letters in a text, as (text, characters with blanks)."""
    single = words.single[words.like] if words.size else np.zeros(0, bool)
    if not single.any():
        return []
    begin = single.copy()
    begin[1:] &= ~single[:-1] | (text_of[1:] != text_of[:-1])
    end = single.copy()
    end[:-1] &= ~single[1:] | (text_of[1:] != text_of[:-1])
    out = []
    for a, b in zip(np.flatnonzero(begin), np.flatnonzero(end) + 1):
        if b - a >= least:
            out.append((int(text_of[a]), " ".join(words.letter(k) for k in words.like[a:b])))
    return out


def features(letters: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word, feature): a hash of each word and of its beginnings."""
    lengths = np.diff(bounds)
    if not len(lengths):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    place = np.arange(len(letters)) - np.repeat(bounds[:-1], lengths)
    values = ragged.mixed(letters.astype(np.uint64) + np.uint64(77)) * ragged.powers(0x9E3779B97F4A7C15, int(lengths.max()) + 1)[place]
    total = np.zeros(len(letters) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    word, feature = [np.arange(len(lengths))], [ragged.mixed(total[bounds[1:]] - total[bounds[:-1]])]
    for size in BEGINNINGS:
        longer = np.flatnonzero(lengths > size)
        word.append(longer)
        feature.append(ragged.mixed(total[bounds[longer] + size] - total[bounds[longer]] + np.uint64(size)))
    return np.concatenate(word), np.concatenate(feature).view(np.int64)


@dataclass(frozen=True)
class Model:
    logs: np.ndarray
    chosen: np.ndarray
    weights: np.ndarray
    bias: float

    def counts(self, batch: pa.RecordBatch, restorer: Restorer) -> np.ndarray:
        """How often each chosen feature stands in each restored text."""
        texts, width = batch.num_rows, len(self.chosen)
        letters, bounds, text, word = restored_words(Words(*ragged.column_bytes(batch["text"])), restorer)
        owner, feature = features(letters, bounds)
        at = np.minimum(np.searchsorted(self.chosen, feature), max(0, width - 1))
        hit = self.chosen[at] == feature if width else np.zeros(len(feature), bool)
        owner, at = owner[hit], at[hit]
        order = np.argsort(owner, kind="stable")
        owner, at = owner[order], at[order]
        cuts = np.searchsorted(owner, np.arange(len(bounds)))
        some = cuts[word + 1] > cuts[word]
        ids, inner = ragged.taken(at, cuts, word[some])
        rows = np.repeat(text[some], np.diff(inner))
        return np.bincount(rows * width + ids, minlength=texts * width).reshape(texts, width)

    def score(self, counts: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(np.log1p(counts) @ self.weights + self.bias)))


def _sample(labels: DataFrame, doc_id: str, label: str) -> tuple[DataFrame, float]:
    """A bounded number of labelled ids of either class, and the share of label 1 among all."""
    rows = labels.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{label}`").cast("int").alias("label"))
    rows = rows.filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out())
    sizes = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    ones, zeros = sizes.get(1, 0), sizes.get(0, 0)
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / 1_000_003
    share = F.when(F.col("label") == 1, FIT_TOXIC / max(1, ones)).otherwise(FIT_CLEAN / max(1, zeros))
    return rows.filter(draw < share).dropDuplicates(["doc_id"]), (ones + 1) / (ones + zeros + 2)


def fit(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", labels_id: str = "doc_id"
) -> Model:
    """Learn the character model from all texts and the weights from a sample of labelled ones.

    Held-out ids are never learned from. The sample has about FIT_TOXIC and
    FIT_CLEAN texts, chosen by a hash of the id; without labels every text gets
    the same score.
    """
    logs = character_model(docs, text)
    wanted, share = _sample(labels, labels_id, label)
    texts = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    # The sample has a fixed size, so the texts need not be shuffled.
    texts = texts.join(F.broadcast(wanted), "doc_id").select("text", "label")

    def found(batches):
        restorer = Restorer(logs)
        for batch in ragged.slices(batches, "text"):
            letters, bounds, owner, word = restored_words(Words(*ragged.column_bytes(batch["text"])), restorer)
            of, feature = features(letters, bounds)
            order = np.argsort(of, kind="stable")
            cuts = np.searchsorted(of[order], np.arange(len(bounds)))
            pairs = np.unique(np.stack([owner, word], axis=1), axis=0) if len(owner) else np.zeros((0, 2), np.int64)
            ids, inner = ragged.taken(feature[order], cuts, pairs[:, 1])
            rows = np.repeat(pairs[:, 0], np.diff(inner))
            order = np.lexsort((ids, rows))
            ids, rows = ids[order], rows[order]
            new = np.append(True, (ids[1:] != ids[:-1]) | (rows[1:] != rows[:-1])) if len(ids) else np.zeros(0, bool)
            of_label = np.array(batch["label"].to_pylist(), np.int64)[rows[new]] if len(ids) else np.zeros(0, np.int64)
            yield pa.record_batch([pa.array(ids[new], pa.int64()), pa.array(of_label)], ["feature", "label"])

    sizes = {r.label: r["count"] for r in texts.groupBy("label").count().collect()}
    ones, zeros = sizes.get(1, 0), sizes.get(0, 0)
    if not ones or not zeros:
        return Model(logs, np.zeros(0, np.int64), np.zeros(0), math.log(share / (1 - share)))
    counted = texts.mapInArrow(found, "feature long, label long").groupBy("feature").agg(F.sum("label").alias("a"), F.count("*").alias("n"))
    a, n = F.col("a"), F.col("n")
    pooled = (n + 1) / (ones + zeros + 2)
    gain = (a / ones - (n - a) / zeros) / F.sqrt(pooled * (1 - pooled) * (1 / ones + 1 / zeros))
    best = counted.filter("a >= 3").select("feature", gain.alias("gain")).filter("gain > 3").orderBy(F.desc("gain"), "feature").limit(FEATURES)
    chosen = np.sort(np.array([r.feature for r in best.collect()], np.int64))
    blank = Model(logs, chosen, np.zeros(len(chosen)), 0.0)

    def counts(batches):
        restorer = Restorer(logs)
        for batch in ragged.slices(batches, "text"):
            rows = blank.counts(batch, restorer).clip(0, 65535).astype(np.uint16)
            yield pa.record_batch([pa.array([r.tobytes() for r in rows], pa.binary()), batch["label"]], ["counts", "label"])

    held = texts.mapInArrow(counts, "counts binary, label int").toArrow().to_pydict()
    rows = np.stack([np.frombuffer(x, np.uint16) for x in held["counts"]]).astype(np.float32)
    return _logistic(logs, chosen, np.log1p(rows), np.array(held["label"], np.float32), share)


def _logistic(logs, chosen, rows, label, share, steps: int = 400, decay: float = 0.02) -> Model:
    """Logistic regression with a quadratic penalty, by momentum steps; the bias is moved to the share of label 1."""
    weights, bias = np.zeros(rows.shape[1], np.float32), np.float32(0)
    mean_w, mean_b, square_w, square_b = weights.copy(), bias, weights.copy(), bias
    balance = np.where(label > 0, 0.5 / max(1, label.sum()), 0.5 / max(1, len(label) - label.sum())).astype(np.float32)
    for step in range(1, steps + 1):
        error = (1 / (1 + np.exp(-(rows @ weights + bias))) - label) * balance
        slope_w, slope_b = rows.T @ error + decay / len(weights) * weights if len(weights) else weights, error.sum()
        mean_w, mean_b = 0.9 * mean_w + 0.1 * slope_w, 0.9 * mean_b + 0.1 * slope_b
        square_w, square_b = 0.99 * square_w + 0.01 * slope_w**2, 0.99 * square_b + 0.01 * slope_b**2
        rate, a, b = 0.05, 1 - 0.9**step, 1 - 0.99**step
        weights = weights - rate * (mean_w / a) / (np.sqrt(square_w / b) + 1e-8)
        bias = bias - rate * (mean_b / a) / (np.sqrt(square_b / b) + 1e-8)
    # Fitted as if both classes were equally frequent.
    return Model(logs, chosen, weights.astype(np.float64), float(bias) + 0.5 * math.log(share / (1 - share)))


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score, predicted) of every row; a null or empty text has the score of a text without words.

    Repeated ids stay one row each; other columns are not read. No shuffle.
    """

    def run(batch: pa.RecordBatch, restorer: Restorer) -> pa.RecordBatch:
        out = model.score(model.counts(batch, restorer))
        return pa.record_batch([batch["id"], pa.array(out), pa.array((out >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return map_texts(docs, {"id": doc_id, "text": text}, run, f"doc_id {kind}, score double, predicted int", setup=lambda: Restorer(model.logs))


def restored(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, restored): the words of every text as they were decoded, in no order of importance."""

    def run(batch: pa.RecordBatch, restorer: Restorer) -> pa.RecordBatch:
        letters, bounds, owner, word = restored_words(Words(*ragged.column_bytes(batch["text"])), restorer)
        names = [letters[a:b].tobytes().decode("utf-32-le") for a, b in zip(bounds[:-1], bounds[1:])]
        parts: list[list[str]] = [[] for _ in range(batch.num_rows)]
        for text_number, word_number in zip(owner.tolist(), word.tolist()):
            parts[text_number].append(names[word_number])
        return pa.record_batch([batch["id"], pa.array([" ".join(p) for p in parts], pa.string())], ["doc_id", "restored"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return map_texts(docs, {"id": doc_id, "text": text}, run, f"doc_id {kind}, restored string", setup=lambda: Restorer(model.logs))
