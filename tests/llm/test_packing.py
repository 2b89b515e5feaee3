import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from millrace.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def rows():
    rng = random.Random(5)
    alphabet = list("ab st'''  \n\t12!?é　rvmdleABSTİßÉ\x85中") + ["<|endoftext|>", "the", "é"]
    out = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 200))) for _ in range(200)]
    out += [None, "", "long words here " * 2_000, "x" * 9_000, "the " * 2047, "the " * 2048]
    return [(k if k % 40 else None, t) for k, t in enumerate(out)] + [(3, "same"), (3, "same")]


def test_pieces_places_and_ids(frame):
    library = Tokenizer.from_file(PATH)
    got = packing.pack_documents(frame(rows()), PATH, with_ids=True).collect()
    expected = Counter()
    for doc_id, text in rows():
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        for n, start in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[start : start + 2048], "<u4")
            expected[doc_id, n, start, len(part), zlib.crc32(part.tobytes()), tuple(part.tolist())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, tuple(r.token_ids)) for r in got) == expected
    held = defaultdict(list)
    for r in got:
        held[r.sequence_id].append((r.offset, r.length))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(held) <= math.ceil(sum(r.length for r in got) / 2048) + 1


def test_sequences_hold_their_pieces(frame):
    packed = packing.pack_documents(frame(rows()), PATH, with_ids=True)
    total = sum(r.length for r in packed.collect())
    assert sum(len(r.token_ids) for r in packing.sequences(packed).collect()) == total


def test_fullest_is_the_best_combination():
    rng = random.Random(2)
    for _ in range(300):
        lengths = [rng.randint(1, 30) for _ in range(rng.randint(1, 9))]
        first = max(lengths)
        rest = list(lengths)
        rest.remove(first)
        sums = {0}
        for n in rest:
            sums |= {s + n for s in sums if s + n <= 40 - first}
        chosen = packing.fullest(dict(Counter(lengths)), 40)
        assert chosen[first] >= 1
        assert sum(k * n for k, n in chosen.items()) == first + max(sums)
        assert all(n <= Counter(lengths)[k] for k, n in chosen.items())


def test_one_length_for_a_third_of_all_rows_and_no_rows(frame):
    many = frame([(k, "the the the") for k in range(3000)] + [(9000 + k, "the " * (k % 90)) for k in range(900)])
    got = packing.pack_documents(many, PATH).collect()
    assert len(got) == 3900
    assert len({(r.sequence_id, r.offset) for r in got}) == 3900
    assert len({r.sequence_id for r in got}) == math.ceil(sum(r.length for r in got) / 2048)
    assert packing.pack_documents(frame([]), PATH).collect() == []
