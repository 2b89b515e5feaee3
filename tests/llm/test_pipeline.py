"""The pipeline on a small folder: every stage's decisions take effect, and run() is the stages in turn."""

import random
import re

import corpus_pipeline
import pytest

from tests.llm.test_near_copies import WORD, components, left


@pytest.fixture(scope="module")
def folder(llm, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    docs = llm.read.parquet("/root/testdata/sf0.001/documents.parquet")
    base = docs.filter("n_chars > 600").orderBy("doc_id").first()
    rng = random.Random(1)
    passage = " ".join("".join(rng.choice("etaoinshr") for _ in range(5)) for _ in range(70))
    words = base.text.split(" ")
    near = " ".join(["the", *words[1:]])
    extra = [
        (900, None, "en", "x", 0),
        (901, "12 34 ?!", "en", "x", 8),
        (902, base.text, "en", "x", len(base.text)),
        (903, near.replace("\n", " "), "en", "x", len(near)),
        (904, f"the thing is of this and that {passage}", "en", "x", 400),
        (905, f"for the one with that\n{passage} and this is the other part of it that they have with all of the others and of the", "en", "x", 400),
    ]
    docs.union(llm.createDataFrame(extra, docs.schema)).write.parquet(f"{path}/documents.parquet")
    return path


def test_stages(llm, folder):
    docs = llm.read.parquet(f"{folder}/documents.parquet")
    held = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(llm, held[-1], folder)
        if name != "packing":
            assert out.columns == docs.columns and out.schema == docs.schema
            out = llm.createDataFrame(out.collect(), docs.schema)
        held.append(out)
    texts = [{r.doc_id: r.text for r in frame.collect()} for frame in held[:-1]]
    raw, spoken, lines, near, passages = texts
    assert {900, 901} & set(spoken) == set() and len(spoken) > 0.95 * len(raw) - 2
    assert all(spoken[k] == raw[k] for k in spoken)
    assert 902 not in lines and set(lines) <= set(spoken)
    found = components(list(lines.items()))
    assert set(near) == {i for i, c in found.items() if i == c}
    kept = {i: " ".join(re.findall(WORD, t)) for i, t in passages.items()}
    import hashlib

    for i, _, _, sha in left(list(near.items())):
        if i in kept:
            assert hashlib.sha256(kept[i].encode()).hexdigest() == sha
        else:
            assert sha == hashlib.sha256(b"").hexdigest()
    assert "and of the" in passages[905] and "and of the" in passages[905][-12:]
    assert {r.doc_id for r in held[-1].collect()} == set(passages)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_any_columns_and_rows(llm, name, stage):
    """Null, repeated and negative ids, null, empty and very long texts, columns called as the operators' own, no rows."""
    known = [(r.doc_id, r.text, r.lang) for r in llm.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").limit(40).collect()]
    long = " ".join(f"{w} {k}" for k in range(4000) for w in ("the", "of", "and", "that"))
    rows = known + known[:2] + [(None, known[0][1], "en"), (-3, long, "en"), (-4, None, "en"), (-5, "", "en"), (known[0][0], known[3][1], "en")]
    docs = llm.createDataFrame([(*row, "x", 1, 2, 3.0, "y") for row in rows], "doc_id long, text string, lang string, source string, _of int, _gone long, score double, sha string")
    out = stage(llm, docs, "")
    if name != "packing":
        assert out.schema == docs.schema
    ids = [r.doc_id for r in out.collect()]
    assert ids and set(ids) <= {row[0] for row in rows}
    none = stage(llm, docs.limit(0), "")
    assert none.schema == out.schema and none.collect() == []


def test_run_equals_the_stages(llm, folder):
    docs = llm.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = llm.createDataFrame(stage(llm, docs, folder).collect(), docs.schema)
    expected = {(r.doc_id, r.piece, r.ids_crc32) for r in corpus_pipeline.STAGES[-1][1](llm, docs, folder).collect()}
    assert {(r.doc_id, r.piece, r.ids_crc32) for r in corpus_pipeline.run(llm, folder).collect()} == expected


def test_every_stage_bounds_the_texts_that_a_reader_holds(llm, folder):
    """4096 texts, Spark's own number, filled the executors' heaps with buffers that doubled as they grew."""
    key = "spark.sql.parquet.columnarReaderBatchSize"
    docs = llm.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        llm.conf.unset(key)
        stage(llm, docs, folder)
        assert int(llm.conf.get(key)) <= 1024
