"""Operators that look at one text at a time, against the libraries and against plain Python."""

import base64
import hashlib
import random
import re
from collections import Counter

import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from millrace.llm import quality, token_counts, tree_bpe

SPECIAL = "<|endoftext|>"
ALPHABET = list("ab st'''  \n\t12!?é 　rvmdle中aaaa\x1c\x85\U0001f600") + [SPECIAL, "the", "'ll", "'re", "<|endof"]


def texts():
    rng = random.Random(7)
    out = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    return [*out, None, "", " ", "\n", "a" * 20_000, "ab " * 20_000, "中" * 5_000, out[0], out[0], SPECIAL * 3]


ROWS = [(k if k % 50 else None, t) for k, t in enumerate(texts())] + [(7, "again"), (7, "again")]


def test_token_counts_equal_the_library(frame):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    got = token_counts.count_tokens(frame(ROWS), path, limit=100).collect()
    expected = []
    for doc_id, text in ROWS:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        expected.append((doc_id, len((text or "").encode()), n, n > 100))
    assert Counter(map(tuple, got)) == Counter(expected)


def test_tree_bpe_equals_the_library_and_round_trips(frame):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as source:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, source)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = Counter((i, tuple(library.encode_ordinary(t or ""))) for i, t in ROWS)
    encoded = tree_bpe.encode(frame(ROWS), path)
    assert Counter((r.doc_id, tuple(r.token_ids)) for r in encoded.collect()) == expected
    decoded = tree_bpe.decode(encoded, path)
    assert Counter((r.doc_id, bytes(r.bytes)) for r in decoded.collect()) == Counter((i, (t or "").encode()) for i, t in ROWS)
    digests = Counter((r.doc_id, r.n_tokens, r.decoded_sha256) for r in tree_bpe.round_trip_digests(frame(ROWS), path).collect())
    assert digests == Counter(
        (i, len(library.encode_ordinary(t or "")), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in ROWS
    )


def test_seams_grow_until_tokens_are_stable():
    codec = tree_bpe.codec(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    rng = random.Random(3)
    for _ in range(200):
        word = "".join(rng.choice("thenigrsaé ") for _ in range(rng.randint(2, 60))).encode()
        cut = rng.randrange(1, len(word))
        whole = codec._window(tuple(codec.ranks[bytes([b])] for b in word))
        assert codec.join(codec.encode(word[:cut]), codec.encode(word[cut:])) == whole


def plain_signals(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {k + d for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for d in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def quality_rows():
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(4000)]
    prose = [" ".join(rng.choice(vocabulary) for _ in range(n)) for n in (10, 49, 50, 200, 3000)]
    noise = " ".join("".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(8)) for _ in range(900))
    lines = "\n".join(["one two three", "four", "", "four", " ", "one two three", "é#*$|<>"])
    repeated = "\n".join([prose[3]] * 30)
    rows = [*prose, noise, lines, repeated, None, "", "\n\n", "x" * 30_000, "a b c a b c"]
    return list(enumerate([*rows, prose[3]]))


def test_quality_signals_equal_plain_python(frame):
    got = {r.doc_id: r for r in quality.judge(frame(quality_rows())).collect()}
    for doc_id, text in quality_rows():
        r = got[doc_id]
        own = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert own == plain_signals(text), doc_id


def test_quality_verdicts(frame):
    got = {r.doc_id: r for r in quality.judge(frame(quality_rows())).collect()}
    assert got[3].kept and got[4].kept
    assert not got[5].base_failed and not got[5].kept and got[5].ratio < 1.6
    assert not any(got[k].kept for k in (0, 1, 7, 8, 9, 10, 11))


@pytest.mark.parametrize("run", ["count", "encode", "judge"])
def test_empty_tables(frame, run):
    empty = frame([])
    path = public_tokenizers.path
    made = {
        "count": lambda: token_counts.count_tokens(empty, path("byte_bpe_50k.json")),
        "encode": lambda: tree_bpe.round_trip_digests(empty, path("byte_bpe_multi_50k.tiktoken")),
        "judge": lambda: quality.judge(empty),
    }
    assert made[run]().collect() == []
