import numpy as np
import pytest

from codalith.llm import merge_dropout

from cases import documents

UNIT = "international"


@pytest.mark.parametrize("one_document", [True, False])
def test_each_occurrence_is_drawn_for_itself(spark, one_document):
    pytest.importorskip("sentencepiece")
    texts = [(1, " ".join([UNIT] * 400))] if one_document else [(d, UNIT) for d in range(400)]
    path = merge_dropout.default_model()
    coder = merge_dropout.MergeCoder(path)
    found = {}
    for r in merge_dropout.encode(documents(spark, texts), path, rate=0.3).collect():
        pieces = [bytes(coder.decoded([i])).decode() for i in r.ids]
        for unit in "|".join(pieces).split(" ")[1:]:
            found[unit] = found.get(unit, 0) + 1
    assert sum(found.values()) == 400 and {u.replace("|", "") for u in found} == {UNIT} and len(found) > 20


def test_kept_units_change_nothing():
    pytest.importorskip("sentencepiece")
    coder = merge_dropout.MergeCoder(merge_dropout.default_model(), rate=0.3)
    texts = [f"some words number {k} of {UNIT} texts " + "x" * 60 for k in range(20)]
    together, edges, _, _ = coder.encode(texts, np.arange(20))
    for k in (3, 19):
        coder.pool.clear()
        assert coder.encode(texts[k : k + 1], np.array([k]))[0].tolist() == together[edges[k] : edges[k + 1]].tolist()
        anew = merge_dropout.MergeCoder(merge_dropout.default_model(), rate=0.3)
        anew._undropped = lambda units: (np.full(len(units), merge_dropout.LONG_MARK, np.uint64), np.ones(len(units), np.int64))
        assert anew.encode(texts[k : k + 1], np.array([k]))[0].tolist() == together[edges[k] : edges[k + 1]].tolist()
