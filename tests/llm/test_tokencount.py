import random

import public_tokenizers
import pytest
from odd import empty, frame, rows

from riskloom.llm.tokencount import MARK, UnigramModel, model, token_counts

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.mark.parametrize("pieces", [["a", "b", "ab", "aba", "▁a", "日", "ba"], ["abc"], ["▁"]])
def test_trie_equals_the_plain_recurrence(pieces):
    rng = random.Random(len(pieces))
    unigram = UnigramModel(pieces)
    words = list({"".join(rng.choice("▁abc日\U0001f600é") for _ in range(rng.randint(1, 90))) for _ in range(400)})
    assert unigram.count_words(words).tolist() == [unigram.count_alone(w) for w in words]


def test_counts_equal_brute_force(spark):
    own = model(PATH)
    got = token_counts(frame(spark), PATH).collect()
    plain = lambda t: sum(own.count_alone(MARK + w) for w in t.split())
    want = [(k, len((t or "").split()), plain(t or "")) for k, t in rows()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert token_counts(empty(spark), PATH).count() == 0
