import random

import public_tokenizers
import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from kbvec.llm import pieces, tokencounts

BPE = public_tokenizers.path("byte_bpe_50k.json")
SPM = public_tokenizers.path("piece_bpe_32k.model")


def texts(seed, n):
    rng = random.Random(seed)
    alphabet = "ab cd'sllre123²½ \n\t\r\x0b\x1c\x85\xa0éßñ漢字☃😀_-!?▁ 　́"
    out = [None, "", " ", "  hi ▁x\n\ty é ☃", "\n\n a", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<0x41>\x00",
           "the " * 500, "x" * 3000, "é" * 2000, " " * 100, "\n" * 50]
    return out + ["".join(rng.choice(alphabet + chr(rng.randrange(32, 0x3000))) for _ in range(rng.randrange(80)))
                  for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "k") for r in rows], "doc_id long, text string, n_tokens int, pieces string")


def test_counts_match_the_library(spark):
    rows = [*enumerate(texts(1, 400)), (3, texts(1, 0)[3]), (None, "abc")]
    library = Tokenizer.from_file(BPE)
    want = sorted((str(d), len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for d, t in rows)
    got = tokencounts.count_tokens(frame(spark, rows), BPE, limit=100).collect()
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"]) for r in got) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 100) for r in got)
    assert tokencounts.count_tokens(frame(spark, rows).limit(0), BPE).collect() == []


def test_counts_do_not_depend_on_what_is_kept():
    vocabulary = tokencounts.load_vocabulary(BPE)
    fresh, kept = tokencounts.MergeCounter(*vocabulary), tokencounts.MergeCounter(*vocabulary)
    for t in texts(2, 100):
        fresh.clear()
        assert fresh.count(t or "") == kept.count(t or "") == kept.count(t or "")


def test_pieces_are_reproducible_and_lossless(spark):
    rows = [*enumerate(texts(3, 300)), (5, texts(3, 0)[5]), (None, "abc def")]
    docs = frame(spark, rows)
    first = pieces.encode(docs.repartition(5), SPM)
    assert first.columns == ["doc_id", "text", "n_tokens", "pieces", "n_pieces", "exact"]
    got = sorted(((r["doc_id"], r["text"], r["pieces"], r["n_pieces"]) for r in first.collect()), key=repr)
    assert got == sorted(((r["doc_id"], r["text"], r["pieces"], r["n_pieces"]) for r in pieces.encode(
        docs.repartition(2), SPM).collect()), key=repr)
    back = pieces.decode(first, SPM).collect()
    assert all(r["decoded"] == r["text"] and r["exact"] for r in back)
    assert all(r["n_pieces"] == (None if r["text"] is None else len(r["pieces"])) for r in back)
    library = sentencepiece.SentencePieceProcessor(model_file=SPM)
    # The library decodes the same ids to the same text, but for its own space mark.
    assert all(library.decode(list(r["pieces"])) == r["text"] for r in back if r["text"] and "▁" not in r["text"]
               and "\x00" not in r["text"])
    assert pieces.encode(docs.limit(0), SPM).collect() == []


def every_segmentation(lattices, chars):
    """Weight of all segmentations of a unit, by enumeration."""
    model = lattices.model
    names = {model.surface[i].decode(): i for i in range(len(model.surface)) if model.normal[i]}

    def go(at):
        if at == len(chars):
            return {(): 1.0}
        out = {}
        for end in range(at + 1, len(chars) + 1):
            if (i := names.get(chars[at:end])) is not None:
                for rest, w in go(end).items():
                    out[(i, *rest)] = w * 2.718281828459045 ** model.weight[i]
        return out

    found = go(0)
    total = sum(found.values())
    return {k: v / total for k, v in found.items()}


def test_draws_follow_the_weights_of_segmentations(spark):
    n = 20_000
    docs = spark.range(n).selectExpr("id as doc_id", "'tests' as text")
    lattices = pieces.Lattices(pieces.load_model(SPM))
    want = every_segmentation(lattices, " tests")
    got = {}
    for r in pieces.encode(docs, SPM).collect():
        got[tuple(r["pieces"])] = got.get(tuple(r["pieces"]), 0) + 1
    assert set(got) <= set(want) and len(got) > 5
    for seg, p in want.items():
        assert got.get(seg, 0) / n == pytest.approx(p, abs=5 * (p * (1 - p) / n) ** 0.5 + 2e-4)


def test_sharpness(spark):
    docs = spark.range(200).selectExpr("id as doc_id", "'international relations' as text")
    assert len({tuple(r["pieces"]) for r in pieces.encode(docs, SPM, sharpness=60.0).collect()}) == 1
    assert len({tuple(r["pieces"]) for r in pieces.encode(docs, SPM, sharpness=0.0).collect()}) > 150


def test_few_stretches_are_searched():
    """The sift lets every piece pass and nearly no other stretch."""
    lattices = pieces.Lattices(pieces.load_model(SPM))
    other = np.random.RandomState(4).randint(0, 1 << 63, 20_000).astype(np.uint64) * np.uint64(2)
    for values, _, seen in lattices.tables.values():
        assert seen[pieces._sift(values)].all() and seen[pieces._sift(other)].mean() < 0.05
