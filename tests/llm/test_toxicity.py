import random
import zlib

import numpy as np
import pytest

from cinderframe.llm import automaton as A
from cinderframe.llm import toxicity as X


def osa(a, b):
    """Edit distance with swaps of neighbours."""
    d = [[max(i, j) if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def brute(word, entries):
    word = word.lower()
    if any(not e.stem and e.text == word for e in entries):
        return A.EXACT
    if any(e.stem and word.startswith(e.text) for e in entries):
        return A.STEM
    return A.FUZZY if any(osa(e.text, word) <= e.edits for e in entries if e.edits) else A.NONE


@pytest.mark.parametrize("seed", range(4))
def test_automaton_is_edit_distance(seed):
    rng = random.Random(seed)
    make = lambda k: "".join(rng.choices("abcdé", k=k))
    entries = [A.Entry(make(rng.randint(3, 10))) for _ in range(6)] + [A.Entry(make(4) + "z", stem=True)]
    words = [make(rng.randint(1, 12)) for _ in range(300)]
    for e in entries:
        for _ in range(120):
            w = list(e.text)
            for _ in range(rng.randint(0, 3)):
                i = rng.randrange(len(w) + 1)
                kind = rng.random()
                if kind < 0.3:
                    w.insert(i, rng.choice("abx0日"))
                elif kind < 0.6 and len(w) > 1:
                    w.pop(min(i, len(w) - 1))
                elif kind < 0.8 and w:
                    w[min(i, len(w) - 1)] = rng.choice("abéZ")
                elif len(w) > 1:
                    i = min(i, len(w) - 2)
                    w[i], w[i + 1] = w[i + 1], w[i]
            words.append("".join(w) + rng.choice(["", "", "end"]))
    words = [w for w in words if w]
    codes = np.array([ord(c) for w in words for c in w], np.uint32)
    ends = np.cumsum([len(w) for w in words])
    got = A.build(entries).run(codes, ends - [len(w) for w in words], ends)
    assert got.tolist() == [brute(w, entries) for w in words]


def test_no_entries():
    assert A.build([]).run(np.array([97], np.uint32), np.array([0]), np.array([1])).tolist() == [A.NONE]


def counts(documents, texts, entries, **more):
    return {r.id: tuple(r[k] for k in X.KINDS) for r in X.hits(documents(texts), entries, **more).collect()}


def test_quotation_marks_pair_within_a_line(documents):
    entries = [A.Entry("idiot"), A.Entry("идиот")]
    texts = [
        'The 5" pipe broke. You idiot, you are an idiot.', 'an open " mark and idiot\nidiot" here', '"Fine," she thought, idiot, "fine."', "„idiot“ «idiot» “idiot” « idiot »",
        '("idiot")', "Ты ИДИОТ идиот „идиот“", 'he growled idiot', '"one idiot" idiot "two idiot"', "»idiot« idiot",
    ]
    quoted = {0: (2, 0), 1: (2, 0), 2: (1, 0), 3: (0, 4), 4: (0, 1), 5: (2, 1), 6: (1, 0), 7: (1, 2), 8: (2, 0)}
    got = counts(documents, texts, entries)
    assert {i: (x[0], x[3]) for i, x in got.items() if i != 8} == {i: x for i, x in quoted.items() if i != 8}
    assert counts(documents, texts, entries, saying=("growled",))[6] == (0, 0, 0, 1)
    assert counts(documents, ["he said idiot"], entries, saying=())[0] == (1, 0, 0, 0)


def test_every_count_weighs(spark, documents):
    """3 and 300 hits, and short and long texts, do not score alike."""
    rng = random.Random(3)
    rows = [("idiot " * k + "word " * n, y) for y in (0, 1) for _ in range(60) for k, n in [(rng.choice([1, 2, 3]) if y == 0 else rng.choice([40, 300]), 400)]]
    texts = [t for t, _ in rows] + ["idiot " * 3 + "word " * 400, "idiot " * 300 + "word " * 400, "idiot " * 3]
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)], "id long, label int")
    lexicon = [A.Entry("idiot")]
    found = X.durable(X.hits(documents(texts), lexicon))
    w = X.fit(found, labels)
    levels = np.array([[int(np.log2(r[k] + 1)) for k in (*X.KINDS, "words")] for r in found.orderBy("id").collect()])
    z = X._inputs(levels) @ w
    assert z[-3] < -1 < 1 < z[-2] and z[-1] != z[-3]


def test_hits_and_quotation(documents):
    entries = [A.Entry("idiot"), A.Entry("worthless"), A.Entry("lowe", stem=True)]
    texts = [
        "you IDIOT, you!", "an idoit and a wortless one", "loweischaft lower", 'the "idiot" line', "he said idiot to us", "“You worthless” idiot",
        None, "", "... !!", "clean words only", "x " * 40_000 + "idiot***", 'said',
    ]
    assert counts(documents, texts, entries) == {
        0: (1, 0, 0, 0), 1: (0, 2, 0, 0), 2: (0, 0, 2, 0), 3: (0, 0, 0, 1), 4: (0, 0, 0, 1), 5: (1, 0, 0, 1),
        6: (0, 0, 0, 0), 7: (0, 0, 0, 0), 8: (0, 0, 0, 0), 9: (0, 0, 0, 0), 10: (1, 0, 0, 0), 11: (0, 0, 0, 0),
    }


def corpus(n, seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 7)))
    out = []
    for _ in range(n):
        words = [word() for _ in range(rng.randint(5, 150))]
        toxic = rng.random() < 0.3
        for _ in range(rng.randint(1, 3) * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(["moron", "worthless", "vequ" + word()]))
        out.append((" ".join(words), int(toxic)))
    return out


def test_learns_words_and_stems(spark, documents):
    data, new = corpus(500, 1), corpus(200, 2)
    copies = [(data[3][0] + " end", data[3][1])] * 20  # a much copied document must not make its words entries
    texts = [t for t, _ in data + copies + new]
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(data + copies)] + [(None, 1), (0, None)], "id long, label int")
    lexicon = X.learn_lexicon(documents(texts), labels.where("id is not null and label is not null"))
    assert {("moron", False), ("worthless", False), ("vequ", True)} <= {(e.text, e.stem) for e in lexicon} and len(lexicon) <= 5
    got = {r.doc_id: r.score for r in X.toxicity(documents(texts), labels).collect()}
    base = len(data) + len(copies)
    assert np.mean([(got[base + i] >= X.THRESHOLD) == y for i, (_, y) in enumerate(new)]) > 0.98


def test_without_labels(spark, documents):
    none = spark.createDataFrame([], "id long, label int")
    for label in (0, 1):
        one = spark.createDataFrame([(0, label), (1, label)], "id long, label int")
        assert {r.score for r in X.toxicity(documents(["a", None, ""]), one).collect()} == {float(label)}
    assert {r.score for r in X.toxicity(documents(["a", None, ""]), none).collect()} == {0.5}
    assert X.toxicity(documents(["a"]).limit(0), none).count() == 0


def test_lexicon_has_no_cap(spark, documents):
    """300 words of 8 toxic documents each are all learned."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=9))
    terms = [word() for _ in range(300)]
    texts = [f"{terms[i % 300]} {word()} {word()}" for i in range(2400)] + [f"{word()} {word()} {word()}" for _ in range(20_000)]
    labels = spark.createDataFrame([(i, int(i < 2400)) for i in range(len(texts))], "id long, label int")
    lexicon = X.learn_lexicon(documents(texts), labels)
    covered = [t for t in terms if any(e.text == t or e.stem and t.startswith(e.text) for e in lexicon)]
    assert len(covered) == len(terms)


def test_query_columns_folds_and_held_out_accuracy(spark, documents, tmp_path):
    data = corpus(900, 5)
    texts = [t for t, _ in data] + [None, "", "moron " * 50_000]
    documents(texts).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, y) for i, (_, y) in enumerate(data)] + [(None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    rows = {r.doc_id: r for r in X.op8_toxicity(spark, str(tmp_path)).collect()}
    assert sorted(rows) == list(range(len(texts))) and set(rows[0].asDict()) == {"doc_id", "held_out", "score", "predicted"}
    for i, r in rows.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1
    held = [i for i in range(len(data)) if rows[i].held_out]
    assert np.mean([rows[i].predicted == data[i][1] for i in held]) > 0.97
    assert rows[len(texts) - 1].predicted == 1 and rows[len(texts) - 2].predicted == rows[len(texts) - 3].predicted == 0


def distances(words, word):
    """Edit distances with swaps of one word to many of one length."""
    a = np.array([[ord(c) for c in w] for w in words])
    d = [[np.full(len(a), max(i, j)) for j in range(len(word) + 1)] for i in range(a.shape[1] + 1)]
    for i in range(1, a.shape[1] + 1):
        for j in range(1, len(word) + 1):
            d[i][j] = np.minimum(np.minimum(d[i - 1][j], d[i][j - 1]) + 1, d[i - 1][j - 1] + (a[:, i - 1] != ord(word[j - 1])))
            if i > 1 and j > 1:
                swap = (a[:, i - 1] == ord(word[j - 2])) & (a[:, i - 2] == ord(word[j - 1]))
                d[i][j] = np.where(swap, np.minimum(d[i][j], d[i - 2][j - 2] + 1), d[i][j])
    return d[-1][-1]


@pytest.mark.parametrize("room", [A.ROOM, 100_000])
def test_large_lexicon_in_bounded_memory(room, monkeypatch):
    """5,000 entries of nine letters, with misspelt and other words; a small room is emptied many times and gives the same."""
    import time
    import tracemalloc

    monkeypatch.setattr(A, "WORDS", 1 << 14 if room == A.ROOM else 64)
    rng = random.Random(7)
    letters = "abcdefghijklmnopqrstuvwxyz"
    make = lambda k: "".join(rng.choices(letters, k=k))
    entries = sorted({make(9) for _ in range(5000)})
    words = [make(rng.randint(1, 12)) for _ in range(100)]
    for e in rng.sample(entries, 200):
        w = list(e)
        for _ in range(rng.randint(0, 3)):
            i, kind = rng.randrange(len(w) - 1), rng.random()
            if kind < 0.25:
                w.insert(i, rng.choice(letters))
            elif kind < 0.5:
                w.pop(i)
            elif kind < 0.75:
                w[i] = rng.choice(letters)
            else:
                w[i], w[i + 1] = w[i + 1], w[i]
        words.append("".join(w))
    codes = np.array([ord(c) for w in words for c in w], np.uint32)
    ends = np.cumsum([len(w) for w in words])
    tracemalloc.start()
    began = time.monotonic()
    terms = A.build([A.Entry(e) for e in entries], room)
    got = terms.run(codes, ends - [len(w) for w in words], ends)
    peak, took = tracemalloc.get_traced_memory()[1], time.monotonic() - began
    tracemalloc.stop()
    print(f"{peak / 1e6:.0f} MB, {took:.1f} s, {len(terms.places)} states")
    least = [distances(entries, w).min() for w in words]
    assert got.tolist() == [A.EXACT if n == 0 else A.FUZZY if n <= 2 else A.NONE for n in least]
    assert {A.EXACT, A.FUZZY, A.NONE} <= set(got.tolist())
    assert peak < 1e9 and took < 30
