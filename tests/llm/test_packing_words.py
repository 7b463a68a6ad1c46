"""Words that the packing encoder has met are not encoded again."""
import numpy as np
import public_tokenizers
import pytest

from chartgrid.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_a_worker_remembers_its_words():
    memo = packing.ByteLevelIds(PATH).memo
    met = []
    memo.encode = lambda word: met.append(word) or [1]
    words = [f" w{k}" for k in range(700_000)]
    for _ in range(2):
        for w in words:
            memo[w]
    assert len(met) == len(words)


def test_the_memory_is_bounded():
    memo = packing._Memo(lambda word: [len(word)], 10)
    for k in range(95):
        assert memo[str(k)] == np.array([len(str(k))], "<u4").tobytes()
        assert len(memo) <= 10


@pytest.mark.parametrize("text", [" plain words, and 12 more.", "tab\tand\x7fdelete\n\n  two", "don't  Ünïcode ß\xa0é",
                                  "", " ", "a\x00b !\"#$%&'()*+~ £"])
def test_ascii_and_other_words_are_as_the_library_has_them(text):
    ids = packing.ByteLevelIds(PATH)
    assert np.frombuffer(ids(text), "<u4").tolist() == ids.library.encode(text, add_special_tokens=False).ids
