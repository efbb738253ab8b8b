import random
import zlib

from stripeline.llm import toxicity as tx


def corpus(n=400, seed=1):
    rng = random.Random(seed)
    words = [f"{a}{b}{c}" for a in ("ba", "ko", "mi", "tu") for b in ("ner", "dal", "vis") for c in ("o", "as", "en")]
    rows, labels = [], []
    for k in range(n):
        own = [rng.choice(words) for _ in range(rng.randint(5, 80))]
        bad = k % 8 == 0
        if bad:
            for w in rng.sample(["grumpface", "snottling", "wretchy"], 2):
                own.insert(rng.randrange(len(own)), w)
        rows.append((k, " ".join(own)))
        labels.append((k, 1, int(bad)))
    return rows, labels


def test_learns_and_scores(frame, labels):
    rows, marks = corpus()
    lexicon = tx.learn(frame(rows), labels(marks))
    assert {w[:5] for w in lexicon.weights} == {"grump", "snott", "wretc"}
    toxic = {i: t for i, _, t in marks}
    for r in tx.score(frame(rows), lexicon).collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert r.predicted == toxic[r.doc_id] and 0 <= r.score <= 1


def test_held_out_labels_are_not_seen(frame, labels):
    rows, marks = corpus()
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, q, t in marks]
    assert tx.learn(frame(rows), labels(marks)) == tx.learn(frame(rows), labels(flipped))


def test_folding_and_exceptions():
    lexicon = tx.Lexicon({tx.fold("idiot"): 3.0, tx.fold("trash"): 2.0}, calibration=(-3.0, 3.0, 1.0))
    for text in ("you idiot", "1D10T!", "іdіоt", "ｉｄｉｏｔ", "id​iot", "an idiotic one"):
        assert lexicon.hits(text)[1] == 1, text
    assert lexicon.hits("put it in the trash can, please")[1] == 0 and lexicon.hits("trash, trash can")[1] == 1
    assert lexicon.hits("videotape antitrash")[1] == 0
    assert lexicon.score(3.0, 10) > lexicon.score(3.0, 1000) > lexicon.score(0.0, 10)  # by length


def test_odd_rows(frame, labels, odd_rows):
    rows, marks = corpus()
    lexicon = tx.learn(frame(rows), labels(marks))
    got = tx.score(frame(odd_rows), lexicon).collect()
    assert len(got) == len(odd_rows) and all(r.predicted == 0 and 0 <= r.score < 0.3 for r in got)
    assert tx.score(frame(odd_rows).where("false"), lexicon).count() == 0


def test_no_labels(frame, labels, odd_rows):
    got = tx.toxicity(frame(odd_rows), labels([(1, 1, 0), (2, None, None), (None, 1, 1)])).collect()
    assert len({r.score for r in got}) == 1


def test_keep_clean(frame, labels):
    rows, marks = corpus()
    docs = frame(rows)
    got = tx.keep_clean(docs, labels(marks))
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == [i for i, _, t in marks if not t]


def test_held_out_accuracy(spark, sf):
    """On the tables at hand: no clean document is called toxic, and English insults are found."""
    big = sf.replace("sf0.001", "sf0.01")
    docs, marks = spark.read.parquet(f"{big}/documents.parquet"), spark.read.parquet(f"{big}/labels.parquet")
    rows = tx.toxicity(docs, marks).join(marks, "doc_id").join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert not [r for r in rows if r.predicted and not r.toxic]
    english = [r.predicted for r in rows if r.toxic and r.lang == "en"]
    assert sum(english) >= 0.9 * len(english)


def test_words_that_differ_late(frame, labels):
    """Toxic and clean words that share their first six letters, and a toxic word that is the stem of clean ones."""
    rows, marks = [], []
    for k in range(400):
        bad = k % 8 == 0
        own = ["common", "words"] + (["grumpfish", "snot"] if bad else ["grumpfer", "snotten"])
        rows.append((k, " ".join(own)))
        marks.append((k, 1, int(bad)))
    lexicon = tx.learn(frame(rows), labels(marks))
    assert set(lexicon.weights) == {"grumpfish", tx.fold("snot") + " "}
    assert lexicon.hits("a grumpfishes snot")[1] == 2 and lexicon.hits("grumpfer snotten")[1] == 0
    assert all(r.predicted == int(r.doc_id % 8 == 0) for r in tx.score(frame(rows), lexicon).collect())


def test_held_out_recall_by_language(spark, sf):
    big = sf.replace("sf0.001", "sf0.1")
    docs, marks = spark.read.parquet(f"{big}/documents.parquet"), spark.read.parquet(f"{big}/labels.parquet")
    got = tx.toxicity(docs, marks).join(marks, "doc_id").join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    for lang in ("en", "de", "fr", "es"):
        found = [r.predicted for r in got if r.toxic and r.lang == lang]
        print(lang, sum(found), "of", len(found), "toxic found;", sum(r.predicted for r in got if not r.toxic and r.lang == lang), "of", sum(not r.toxic and r.lang == lang for r in got), "clean rejected")
        assert found and sum(found) >= 0.9 * len(found), lang


def plain_hits(lexicon, text):
    """Every word against every entry, and every place against every phrase."""
    flat = " " + tx.fold(text) + " "
    spared = [(k, k + len(own)) for p in lexicon.exceptions if (own := tx.fold(p).strip()) for k in range(len(flat)) if flat.startswith(f" {own} ", k - 1) and k]
    total, n = 0.0, 0
    for k in range(1, len(flat)):
        if flat[k - 1] == " " and not any(a <= k < b for a, b in spared):
            entries = [t for t in lexicon.weights if flat.startswith(t, k)]
            if entries:
                total, n = total + lexicon.weights[max(entries, key=len)], n + 1
    return total, n, len(flat.split())


def test_matching_is_that_of_brute_force():
    rng = random.Random(11)
    bits = ["idiot", "1diot", "idi", "trash", "can", "bag", "trash can", "cannot", "a", " ", ", ", "\n", "é", "ıd", "СІown", "clown", "fish", "fisherman", "s", "!", "\u200b", "ｔrash"]
    for _ in range(60):
        weights = {tx.fold(w) + rng.choice(["", "", " "]): rng.uniform(0.5, 4) for w in rng.sample(["idiot", "idi", "trash", "clown", "tra", "can", "fish"], 4)}
        lexicon = tx.Lexicon(weights, exceptions=tuple(rng.sample(["trash can", "clown fish", "can a trash", "fish", "trash bag", "a can"], 3)))
        for _ in range(60):
            text = "".join(rng.choice(bits) + rng.choice(["", " ", " "]) for _ in range(rng.randint(0, 12)))
            got, want = lexicon.hits(text), plain_hits(lexicon, text)
            assert got[1:] == want[1:] and abs(got[0] - want[0]) < 1e-9, (text, weights, lexicon.exceptions)


def test_exceptions_have_boundaries():
    lexicon = tx.Lexicon({tx.fold("trash"): 2.0, tx.fold("clown"): 2.0})
    assert lexicon.hits("trash cannot")[1] == 1 and lexicon.hits("clown fisherman")[1] == 1 and lexicon.hits("you are trash, can you")[1] == 1
    assert lexicon.hits("a trash can and clown fish")[1] == 0 and lexicon.hits("trash can trash")[1] == 1


def test_exceptions_are_learned(frame, labels):
    """A word that is an insult but for one phrase."""
    rows, marks = [], []
    for k in range(600):
        bad, mild = k % 6 == 0, k % 60 == 1
        rows.append((k, f"some plain words {'you grumpface' if bad else 'the grumpface statue' if mild else ''} and number {k}"))
        marks.append((k, 1, int(bad)))
    lexicon = tx.learn(frame(rows), labels(marks))
    assert "grumpface statue" in lexicon.exceptions
    assert lexicon.hits("see the grumpface statue")[1] == 0 and lexicon.hits("you grumpface")[1] == 1
    assert all(r.predicted == int(r.doc_id % 6 == 0) for r in tx.score(frame(rows), lexicon).collect())


def test_long_texts_are_linear():
    import time

    lexicon = tx.Lexicon({tx.fold("trash"): 2.0})
    began = time.perf_counter()
    assert lexicon.hits("trash can " * 200_000)[1] == 0 and lexicon.hits("trash trash can " * 100_000)[1] == 100_000
    assert time.perf_counter() - began < 20


def test_repeated_ids_give_one_labelled_row(frame, labels, spark):
    rows = [(1, f"text {k}") for k in range(2000)] + [(3, "other")]
    docs = frame(rows)
    assert sorted(map(tuple, tx.labelled(docs, labels([(1, 1, 1), (3, 1, 0)])).select("doc_id", "text", "toxic").collect())) == [(1, "text 0", 1), (3, "other", 0)]
