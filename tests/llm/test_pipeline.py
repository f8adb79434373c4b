"""Each stage of the pipeline against a plain version, on the small tables."""

import corpus_pipeline
import pytest
import public_tokenizers

from kbvec.llm import contamination, linededup, pieces, quality
from kbvec.llm.tables import table
from tests.llm.test_jaccard import brute as groups
from tests.llm.test_linededup import brute as repeats

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def outputs(spark, tmp_path_factory):
    """docs before the first stage and after each, through files as in a run."""
    docs, out = table(spark, SF, "documents"), []
    folder = tmp_path_factory.mktemp("stages")
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, SF).write.parquet(str(folder / name))
        docs = spark.read.parquet(str(folder / name))
        out.append((name, before.toPandas(), docs.toPandas()))
    return out


def test_stages_and_columns(outputs):
    assert [n for n, _, _ in outputs] == ["quality", "line_dedup", "ngram_jaccard", "decontamination", "sentencepiece"]
    for name, before, after in outputs[:-1]:
        assert list(after.columns) == list(before.columns) and 0 < len(after) <= len(before)


def test_quality(spark, outputs):
    _, before, after = outputs[0]
    docs = table(spark, SF, "documents")
    model = quality.train(docs, table(spark, SF, "labels"))
    keep = {r["doc_id"] for r in quality.score(docs, model).collect() if r["keep"]}
    assert set(after["doc_id"]) == keep and len(keep) <= len(before)


def test_line_dedup(outputs):
    _, before, after = outputs[1]
    gone = {}
    for d, i, _, _ in repeats(list(zip(before["doc_id"], before["text"]))):
        gone.setdefault(d, set()).add(i)
    want = {}
    for d, text in zip(before["doc_id"], before["text"]):
        lines = text.split("\n")
        part = {i for i, x in enumerate(lines) if len(x.encode().split()) >= linededup.LEAST_WORDS}
        if not part or part - gone.get(d, set()):
            want[d] = "\n".join(x for i, x in enumerate(lines) if i not in gone.get(d, ()))
    assert dict(zip(after["doc_id"], after["text"])) == want
    assert all(n == len(t) for n, t in zip(after["n_chars"], after["text"]))


def test_one_of_each_group(outputs):
    _, before, after = outputs[2]
    found = groups(list(zip(before["doc_id"], before["text"])))
    assert set(after["doc_id"]) == {d for d, (_, component, _) in found.items() if d == component}


def test_decontamination(spark, outputs):
    _, before, after = outputs[3]
    items = [" ".join(t.split()) for t in table(spark, SF, "benchmark").toPandas()["text"]]
    for d, text in zip(before["doc_id"], before["text"]):
        plain = " ".join(text.split())
        assert not (d in set(after["doc_id"]) and any(i in plain for i in items))
    bad = contamination.contaminated(spark.createDataFrame(before), table(spark, SF, "benchmark"))
    assert set(before["doc_id"]) - set(after["doc_id"]) == {r["doc_id"] for r in bad.collect()}


def test_sentencepiece(spark, outputs):
    _, before, after = outputs[4]
    assert list(after["doc_id"].sort_values()) == list(before["doc_id"].sort_values()) and after["exact"].all()
    back = pieces.decode(spark.createDataFrame(after[["doc_id", "pieces"]]), public_tokenizers.path("piece_bpe_32k.model"))
    assert {r["doc_id"]: r["decoded"] for r in back.collect()} == dict(zip(before["doc_id"], before["text"]))


def test_run(spark, outputs):
    got = corpus_pipeline.run(spark, SF).toPandas()
    assert set(got["doc_id"]) == set(outputs[-1][2]["doc_id"])


LONG = "many different words stand in this one line of the text"
ODD = [(1, LONG, "en", "s", 10), (2, None, None, None, None), (3, "", "", "", 0), (None, LONG, "en", "s", 1), (1, LONG, "en", "s", 10),
       (4, "word " * 30_000, "en", "s", 5), (5, f"{LONG} again\nthe second line is not like any other", None, "s", 2), (6, " \n\t", "x", "y", 3)]


@pytest.mark.parametrize("number", range(5))
def test_odd_rows_and_clashing_columns(spark, number):
    names = ("rep", "row", "gone", "scraps", "pieces", "component_id", "label", "hash")
    docs = spark.createDataFrame([(*r, *range(len(names))) for r in ODD],
                                 "doc_id long, text string, lang string, source string, n_chars long, "
                                 + ", ".join(f"{n} int" for n in names))
    stage = corpus_pipeline.STAGES[number][1]
    got = stage(spark, docs, SF)
    if number < 4:
        assert got.columns == docs.columns
    kept = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got.collect())
    everything = sorted((r[0] is None, r[0] or 0) for r in ODD)
    if number == 1:  # one row of a repeated one, and no copy without an id; a line of the fifth repeats the first
        everything = [(False, d) for d in (1, 2, 3, 4, 5, 6)]
    assert kept == everything or number == 0
    assert stage(spark, docs.limit(0), SF).collect() == []
