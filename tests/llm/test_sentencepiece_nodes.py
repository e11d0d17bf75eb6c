import os

import numpy as np
import pytest

from cinderframe.llm import sentencepiece_sampling as S

pytestmark = pytest.mark.skipif(not os.path.exists(S.MODEL_FILE), reason="no vocabulary file")


def searched(texts, keys, k=3):
    v = S.vocabulary()
    parts = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(parts), np.uint8)
    codes, edges, first_byte = S.marked(data, np.r_[0, np.cumsum([len(p) for p in parts])], v.prefix)
    s, draws, after = S.search(v, v.lookup(), codes, np.array(keys, np.uint64), edges, k)
    return v, s, draws, after, data, first_byte


def test_chunks_share_the_nodes_of_equal_endings():
    # 400 different chunks of 24 characters, the last 20 of which are the same: the edges of these are made once, not 400 times.
    words = [f"{i:03d}" + "interestingworldwide" for i in range(400)]
    _, s, *_ = searched([" ".join(words)], [1])
    alone = len(searched([words[0]], [1])[1].lattice.length)
    assert len(s.lattice.length) < 400 * alone / 3


def test_draws_do_not_depend_on_the_slice():
    rng = np.random.default_rng(1)
    texts = ["", "of a naïve kind", "日本語 " * 9, "x" * 200, *(" ".join("".join(map(chr, rng.integers(97, 123, rng.integers(1, 12)))) for _ in range(40)) for _ in range(30))]
    keys = rng.integers(0, 2**63, len(texts))
    v, s, draws, after, data, first_byte = searched(texts, keys)
    for i, text in enumerate(texts):
        _, t, own, own_after, own_data, own_byte = searched([text], keys[i : i + 1])
        assert own_after[0] == after[i]
        for (path, has, log_p, key), (own_path, own_has, own_log_p, own_key) in zip(draws, own, strict=True):
            assert has[i] == own_has[0] and key[i] == own_key[0]
            if has[i]:
                assert log_p[i] == own_log_p[0]
                ids, count = S.piece_ids(v, s, path, data, first_byte)
                ends = np.r_[0, np.cumsum(count)][path[2]]
                assert ids[ends[i] : ends[i + 1]].tolist() == S.piece_ids(v, t, own_path, own_data, own_byte)[0].tolist()


def test_representatives_when_upper_bits_meet():
    rng = np.random.default_rng(2)
    hashes = rng.choice(np.r_[np.arange(50, dtype=np.uint64), rng.integers(0, 2**63, 500).astype(np.uint64)], 5000)
    same = S.representatives(hashes)
    assert (hashes[same] == hashes).all() and (same[same] == same).all()
    assert len(S.representatives(hashes[:0])) == 0
