"""Language and toxicity: held-out accuracy, edge cases and the pieces of the method."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import language, toxicity

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(llm):
    return llm.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="module")
def speaker(docs):
    return language.fit(docs.filter(~language.held_out()))


@pytest.fixture(scope="module")
def judge(llm, docs):
    return toxicity.fit(docs, llm.read.parquet(f"{FOLDER}/labels.parquet"))


def test_language_accuracy_on_held_out_rows(docs, speaker):
    got = language.predict(docs, speaker).join(docs.filter(language.held_out()).select("doc_id", "lang"), "doc_id").collect()
    assert len(got) > 100
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.98
    assert np.mean([r.rejected for r in got]) < 0.02


def test_language_edge_cases(frame, speaker):
    rows = [(1, None), (2, ""), (3, "12 34 !!"), (4, "中" * 400), (None, "the and of that this with"), (4, "the of")]
    got = {(r.doc_id, r.lang_pred): r for r in language.predict(frame(rows), speaker).collect()}
    for k in (1, 2, 3):
        assert got[k, "und"].score == 0 and got[k, "und"].rejected
    foreign = [r for r in got.values() if r.doc_id == 4 and r.rejected]
    assert len(foreign) == 1 and foreign[0].lang_pred in speaker.languages
    assert got[None, "en"].score > 0
    assert [r.doc_id for r in language.accepted(frame(rows), speaker).collect()] == [None, 4]
    assert language.predict(frame([]), speaker).collect() == []


def test_nothing_to_learn_from(frame):
    model = language.fit(frame([]))
    assert [r.lang_pred for r in language.predict(frame([(1, "the")]), model).collect()] == ["und"]


def test_toxicity_on_held_out_rows(llm, docs, judge):
    labels = llm.read.parquet(f"{FOLDER}/labels.parquet")
    got = toxicity.score(docs, judge).join(labels, "doc_id").filter(language.held_out()).collect()
    right = [r.predicted == r.toxic for r in got]
    assert np.mean(right) > 0.95
    toxic = [r.predicted for r in got if r.toxic]
    assert np.mean(toxic) >= 0.6
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)


@pytest.mark.parametrize(
    "written", ["1d10t", "idi0t", "iiiidiot", "idioooot", "i d i o t", "i.d.i.o.t", "i-d-i-o-t", "!d!ot", "idiot$"]
)
def test_disguises_are_restored(judge, written):
    words = toxicity.Restorer(judge.logs).restore(written)
    assert words[0].startswith("idiot") or "idiot" in "".join(words)


def test_plain_words_stay(judge):
    restorer = toxicity.Restorer(judge.logs)
    for word in ("the", "thing", "enß", "réeuxment"):
        assert restorer.restore(word) == (word,)


def test_disguised_texts_score_like_plain_ones(frame, judge):
    clean = "the thing that is and of for with this " * 6
    rows = [(1, clean), (2, clean + "idiot moron scum"), (3, clean + "1d10t mor0n $cum"), (4, clean + "i d i o t"), (5, None), (6, "")]
    got = {r.doc_id: r.score for r in toxicity.score(frame(rows), judge).collect()}
    assert got[2] > 0.5 and got[3] > 0.5 and got[4] > got[1]
    assert got[1] < 0.5 and got[5] == got[6] < 0.5
    assert toxicity.score(frame([]), judge).collect() == []


def test_disguises_reach_the_decoder(frame, judge):
    """Spaced leetspeak, spaced words of few letters, attached marks, symbols only, and marks at either end."""
    clean = "the thing that is and of for with this " * 6
    forms = ["1 d 1 0 t", "$ c u m", "i. d. i. o. t.", "!diot", "|diot"]
    rows = [(k, clean + " ".join([x + " the"] * 3)) for k, x in enumerate(forms)] + [(100, clean), (101, clean + "the! thing!! | this!")]
    got = {r.doc_id: r for r in toxicity.score(frame(rows), judge).collect()}
    assert [x for k, x in enumerate(forms) if got[k].score <= got[100].score] == []
    assert got[101].predicted == 0
    more = [(1, "455"), (2, "4$$"), (3, "a s s"), (4, "the! thing!!"), (5, "7"), (6, "0 1 " * 20_000)]
    words = {r.doc_id: r.restored.split() for r in toxicity.restored(frame(more), judge).collect()}
    assert words[1] and words[2] and set(words[1] + words[2]) <= {"as", "ass", "asss"}
    assert any(len(x) > 1 for x in words[3]) and words[4] == ["the", "thing"] and words[5] == [] and words[6]


def test_viterbi_is_the_best_path(judge):
    """Against all readings of short words."""
    restorer = toxicity.Restorer(judge.logs)
    logs = judge.logs

    def total(path, cost):
        a = b = 0
        score = -cost
        for letter in path + " ":
            if letter == " ":
                if b:
                    score += float(logs[a, b, 0])
                a = b = 0
            else:
                c = toxicity.symbol_of(letter)
                score += float(logs[a, b, c])
                a, b = b, c
        return score

    for word in ("1d10t", "m0r0n", "b4d", "a$$", "th1$"):
        paths = [("", 0.0)]
        for k, char in enumerate(word):
            if k and word[k - 1] == char:
                continue
            times = 2 if word[k : k + 2] == char * 2 else 1
            place = "first" if k == 0 else "last" if k + times == len(word) else "inside"
            paths = [(p + x, c + y) for p, c in paths for x, y in toxicity._options(char, times, place)]
        best = max(total(p, c) for p, c in paths)
        found = [p for p, c in paths if total(p, c) > best - 1e-6]
        assert " ".join(restorer.restore(word)) in {" ".join(p.split()) for p in found}


def test_no_labels(llm, docs):
    none = llm.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(docs, none)
    assert {r.predicted for r in toxicity.score(docs.limit(3), model).collect()} <= {0, 1}
    assert docs.filter(F.col("doc_id").isNull()).count() == 0
