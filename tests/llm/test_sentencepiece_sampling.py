import itertools
import os
import zlib
from collections import Counter

import numpy as np
import pytest

from cinderframe.llm import sentencepiece_sampling as S

pytestmark = pytest.mark.skipif(not os.path.exists(S.MODEL_FILE), reason="no vocabulary file")


@pytest.fixture(scope="module")
def model():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=S.MODEL_FILE)


def brute(model, v, text):
    """{piece ids: probability} of all segmentations."""
    marked = "▁" + text.replace(" ", "▁")
    known = {model.id_to_piece(int(i)): int(i) for i in v.ids}

    def ways(i):
        if i == len(marked):
            yield (), 0.0
            return
        for j in range(i + 1, min(len(marked), i + v.longest) + 1):
            piece = marked[i:j]
            if piece in known:
                ids, w = (known[piece],), v.weights[known[piece]]
            elif j == i + 1:
                ids = tuple(v.first_byte + b for b in piece.encode())
                w = v.weights[v.first_byte] * len(ids)
            else:
                continue
            for rest, more in ways(j):
                yield ids + rest, w + more

    found = dict(ways(0))
    total = np.logaddexp.reduce(list(found.values()))
    return {k: float(np.exp(x - total)) for k, x in found.items()}


def drawn(spark, texts, k, parts=3):
    df = spark.createDataFrame([(i, t, b"x", 1) for i, t in enumerate(texts)], "doc_id long, text string, pieces binary, sample int").repartition(parts)
    out = {}
    for r in S.segmentations(df, k).collect():
        out.setdefault(r.doc_id, []).append((r["sample"], tuple(np.frombuffer(r.pieces, "<i4").tolist()), r.log_prob, r.key, r.inclusion))
    return {i: sorted(x) for i, x in out.items()}


def test_draws_follow_the_distribution(spark, model):
    v = S.vocabulary()
    text = "the é"
    p = brute(model, v, text)
    n = 6000
    got = drawn(spark, [text] * n, 2)
    first = Counter(x[0][1] for x in got.values())
    pairs = Counter((x[0][1], x[1][1]) for x in got.values())
    assert all(len(x) == 2 for x in got.values())
    for s, q in p.items():
        assert abs(first[s] / n - q) < 4.5 * np.sqrt(q / n) + 1e-3
    for a, b in itertools.permutations(p, 2):
        q = p[a] * p[b] / (1 - p[a])
        assert abs(pairs[a, b] / n - q) < 4.5 * np.sqrt(q / n) + 1e-3
    # Each draw weighted by its inclusion estimates a sum over all segmentations without bias.
    estimate = np.mean([sum(np.exp(x[2]) / x[4] for x in xs) for xs in got.values()])
    assert abs(estimate - 1) < 0.05


def test_all_segmentations_once(spark, model):
    v = S.vocabulary()
    for text in ("ab", "of a", "日本"):
        p = brute(model, v, text)
        (xs,) = drawn(spark, [text], len(p) + 3).values()
        assert {x[1] for x in xs} == set(p) and len(xs) == len(p)
        assert all(abs(np.exp(x[2]) - p[x[1]]) < 1e-8 for x in xs)  # log_prob is rounded to 8 places
        assert all(x[4] == 1 for x in xs)
        keys = [x[3] for x in xs]
        assert keys == sorted(keys, reverse=True)


TEXTS = ["Plain words, some of them long-ish.", "  two   spaces \n\t lines ", "日本語 und ßärger 🎉🎉", None, "", " ", "x" * 3000, "many words here " * 40_000, "a", "▁ mark"]


def test_round_trip_and_repeatable(spark):
    rows = drawn(spark, TEXTS, 3)
    assert rows == drawn(spark, TEXTS, 3, parts=1)
    assert [len(rows[i]) for i in (3, 4)] == [1, 1] and rows[3][0][1] == () and rows[4][0][2] == 0
    for i, xs in rows.items():
        assert len({x[1] for x in xs}) == len(xs) and all(0 < x[4] <= 1 or x[2] < -30 for x in xs)
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(TEXTS)], "doc_id long, text string, sample int")
    texts = {(r.doc_id, r["sample"]): r.text for r in S.decode(S.segmentations(df, 2)).collect()}
    for (i, _), t in texts.items():
        assert t == (TEXTS[i] or "").replace("▁", " ")


def test_encode_and_decode(spark, model):
    df = spark.createDataFrame([(i, t, 7) for i, t in enumerate(TEXTS)], "doc_id long, text string, pieces int")
    coded = S.encode(df)
    assert coded.columns == ["doc_id", "text", "pieces"]
    for r in coded.collect():
        assert r.pieces == (None if TEXTS[r.doc_id] is None else model.encode(TEXTS[r.doc_id]))
    back = {r.doc_id: r.text for r in S.decode(coded).collect()}
    assert all(back[i] == (t if t is None else t.replace("▁", " ")) for i, t in enumerate(TEXTS))
    assert S.segmentations(df.limit(0)).count() == 0 and S.encode(df.limit(0)).count() == 0


def test_segmentations_of_tiny_mass_are_not_lost(spark, model):
    # One piece holds all but 1e-13 of the mass of its text.
    v = S.vocabulary()
    weights = v.weights.copy()
    weights[model.piece_to_id("▁the")] += 40
    sharp = S.Vocabulary(weights, v.hashes, v.ids, v.prefixes, v.longest, v.first_byte, v.unknown, v.prefix, v.proto)
    p = brute(model, sharp, "the")
    data = np.frombuffer("the".encode() * 4, np.uint8)
    codes, edges, _ = S.marked(data, np.array([0, 3, 6, 9, 12]), True)
    k = len(p) + 1
    _, draws, _ = S.search(sharp, sharp.lookup(), codes, np.arange(4, dtype=np.uint64), edges, k)
    assert max(p.values()) > 1 - 1e-12 and len(p) > 4
    assert [int(has.sum()) for _, has, _, _ in draws] == [4] * len(p) + [0]


def test_decoding_of_any_bytes(spark, model):
    v = S.vocabulary()
    ids = [[v.first_byte + 0xC3], [v.first_byte + 0xE2, v.first_byte + 0x82], [], None, model.encode("ok then"), [v.unknown, 5]]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(ids)], "n int, pieces array<int>").repartition(1)
    assert {r.n: r.text for r in S.decode(df).collect()} == {i: None if x is None else model.decode(x) for i, x in enumerate(ids)}


def test_query_round_trip(spark, model, tmp_path):
    texts = [t.replace("▁", "_") if t else t for t in TEXTS]
    spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(0, texts[0], 1)], "doc_id long, text string, sample int").write.parquet(f"{tmp_path}/documents.parquet")
    rows = S.op2_sentencepiece(spark, str(tmp_path)).collect()
    assert Counter(r.doc_id for r in rows)[0] == 6
    for r in rows:
        ids = np.frombuffer(r.pieces, "<i4").tolist()
        assert model.decode(ids) == (texts[r.doc_id] or "") and len(ids) == r.n_pieces
        assert r.text_crc32 == zlib.crc32((texts[r.doc_id] or "").encode()) and r.pieces_crc32 == zlib.crc32(r.pieces)
