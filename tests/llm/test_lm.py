import math
import zlib
from collections import Counter

import numpy as np
import pytest

from riskstream.llm import lm
from riskstream.llm.queries import RANKS, op3_lm_scoring

SF = "/root/testdata/sf0.001"


def brute(rows):
    tokens = [((i, t), (t or "").encode().lower().split() + [b" "]) for i, t in rows]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    counts = Counter(w for (i, _), ws in tokens if not held(i) for w in ws)
    n, v = sum(counts.values()), len(counts)
    return sorted(((i, held(i), len(ws), sum(counts[w] > 0 for w in ws), n,
                    round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), 6)) for (i, _), ws in tokens), key=repr)


def plain(found):
    return sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found), key=repr)


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = op3_lm_scoring(spark, SF).collect()
    assert plain(found) == brute(rows)
    assert all(r.score < 0 and math.isfinite(r.score) for r in found)
    tokens = sum(r.n_tokens for r in found if r.held_out)
    assert sum(r.score for r in found if r.held_out) / tokens > -6


def test_odd_rows_in_small_chunks(spark, odd_docs, docs_of, monkeypatch):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    monkeypatch.setattr(lm, "CHUNK_WORDS", 5)
    found = lm.scored(odd_docs, RANKS).collect()
    assert plain(found) == brute(rows)
    assert lm.scored(docs_of([]), RANKS).count() == 0


def toy_model(seed=1):
    rng = np.random.default_rng(seed)
    rows, draw = lm.FREQUENT + 1, lambda *s: rng.normal(0, 1, s).astype(np.float32)
    return {"classes": rng.integers(0, lm.CLASSES, lm.IDS), "symbols": rng.integers(0, rows, lm.IDS), "rare": draw(lm.IDS) * 0,
            "within": draw(rows, rows), "bigram": draw(rows, lm.CLASSES), "query": draw(rows, lm.DIM), "key": draw(rows, lm.DIM),
            "value": draw(rows, lm.DIM), "query_at": draw(lm.STEP, lm.DIM), "key_at": draw(lm.PAST + lm.STEP - 1, lm.DIM),
            "value_at": draw(lm.PAST + lm.STEP - 1, lm.DIM), "out": draw(lm.DIM, lm.CLASSES)}


def test_batched_attention_is_that_of_single_ids():
    model, ids = toy_model(), np.random.default_rng(2).integers(0, lm.IDS, (3, lm.PAST + lm.STEP))
    found = lm.log_likelihood(model, ids)
    for w in range(3):
        s = model["symbols"][ids[w]]
        for j in range(lm.STEP):
            at = lm.PAST + j - 1                        # the id before asks
            q = model["query"][s[at]] + model["query_at"][j]
            k, v = (model[n][s[:at + 1]] + model[f"{n}_at"][:at + 1] for n in ("key", "value"))
            weights = np.exp(k @ q)
            logits = model["bigram"][s[at]] + (weights / weights.sum()) @ v @ model["out"]
            logits = logits.astype(float)
            target = ids[w, lm.PAST + j]
            log_p = logits[model["classes"][target]] - np.log(np.exp(logits).sum()) + model["within"][s[at], s[at + 1]]
            assert found[w, j] == pytest.approx(log_p, rel=1e-3, abs=1e-3)


def test_each_id_is_scored_once_and_sees_what_is_before_it():
    sequences = [np.arange(n) + 1000 * n for n in (1, 15, 16, 17, 100)]
    ids, scored, owner = lm.windows(sequences)
    for i, s in enumerate(sequences):
        assert np.array_equal(ids[owner == i][:, lm.PAST:][scored[owner == i]], s)
    second = ids[owner == 4][1]
    assert np.array_equal(second[:lm.PAST], sequences[4][lm.STEP - lm.PAST:lm.STEP])


def test_probabilities_of_ids_sum_to_one(spark, docs_of):
    docs = lm.learned(docs_of([(i, "the cat sat on the mat and the dog sat too " * 3) for i in range(20)]))
    model = lm.learn(docs.select("doc_id", "text", "learn"), RANKS)
    ids = np.full((1, lm.PAST + lm.STEP), lm.END_ID)
    ids[0, :lm.PAST] = lm.word_ids(RANKS).sequence(b"the cat sat on the mat and the dog sat on a mat or a dog sat on it".split())[:lm.PAST]
    total = 0.0
    for first in range(0, lm.IDS, 4096):
        many = np.repeat(ids, min(4096, lm.IDS - first), axis=0)
        many[:, lm.PAST] = np.arange(first, first + len(many))
        total += np.exp(lm.log_likelihood(model, many)[:, 0].astype(float)).sum()
    assert total == pytest.approx(1, abs=1e-3)


def test_training_slopes_lower_the_loss():
    rng = np.random.default_rng(0)
    sequences = [np.tile(rng.integers(0, 50, 8), 12) for _ in range(40)]
    model = toy_model()
    model["symbols"] = np.minimum(np.arange(lm.IDS), lm.FREQUENT)
    model["classes"] = np.arange(lm.IDS) % lm.CLASSES
    for name in ("bigram", "out", "within"):
        model[name] *= 0
    ids, scored, _ = lm.windows(sequences)
    before = lm.log_likelihood(model, ids)[scored].mean()
    lm.train(model, sequences)
    assert lm.log_likelihood(model, ids)[scored].mean() > before + 0.5


def test_an_id_that_opens_a_window_sees_the_16_before_it():
    model, sequence = toy_model(), np.random.default_rng(3).integers(0, lm.IDS, 32)
    other = sequence.copy()
    other[0] = (other[0] + 1) % lm.IDS
    model["symbols"][[sequence[0], other[0]]] = 5, 6
    at, before = (lm.log_likelihood(model, lm.windows([s])[0])[1, 0] for s in (sequence, other))
    assert at != before
    assert model["query"].shape[1] == 16 and model["out"].shape[1] == 48


def test_words_and_pairs_outside_the_sample_count(spark, docs_of, monkeypatch):
    """The sample that classes and weights come from has none of the texts that hold `zyzzyva quokka`."""
    rare = [(i, "zyzzyva quokka " * 5 + "y" * 100) for i in range(1000, 1060)]
    rows = [(i, "the cat sat on the mat") for i in range(60)] + rare
    tried = next(i for i in range(5000, 6000) if zlib.crc32(str(i).encode()) % 7 == 2)
    monkeypatch.setattr(lm, "SAMPLE_CHARS", 50)

    def score(rows):
        found = lm.scored(docs_of([*rows, (tried, "zyzzyva quokka zyzzyva quokka")]), RANKS).collect()
        return next(r.score for r in found if r.doc_id == tried)

    half = sum(zlib.crc32(str(i).encode()) % 7 != 2 for i, _ in rare) * 5      # learned occurrences of each
    total = sum(len(t.split()) + 1 for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2)
    assert score(rows) > 4 * math.log10(0.5 * half / total) - 3                 # its share of all words, and the end
    monkeypatch.setattr(lm, "OWN_SHARE", 1 - 1e-9)                              # ids alone
    apart = [(i, ("zyzzyva " if i % 2 else "quokka ") * 10 + "y" * 100) for i, _ in rare]
    assert score(rows) > score([*rows[:60], *apart]) + 0.5                      # the pairs


def test_shares_by_counted_pairs_sum_to_one():
    model, rng = toy_model(), np.random.default_rng(4)
    model["out"] *= 0
    model["symbols"] = np.minimum(np.arange(lm.IDS), lm.FREQUENT)
    share = np.bincount(model["classes"], minlength=lm.CLASSES).astype(float)
    model["within"] = np.zeros_like(model["within"])
    model["rare"] = -np.log(share)[model["classes"]].astype(np.float32)         # even within a class
    keys = np.unique(lm.pair_keys(np.full(500, 40_000), rng.integers(0, lm.IDS, 500)))
    n = rng.integers(1, 50, len(keys))
    model["follow"] = np.zeros((lm.IDS, lm.CLASSES), np.float32)
    np.add.at(model["follow"], (40_000, model["classes"][keys & 0xffff]), n)
    ids = np.full((lm.IDS, lm.PAST + lm.STEP), 40_000)
    ids[:, lm.PAST] = np.arange(lm.IDS)
    total = sum(np.exp(lm.log_likelihood(model, ids[at:at + 4096], (keys, n))[:, 0].astype(float)).sum() for at in range(0, lm.IDS, 4096))
    assert total == pytest.approx(1, abs=1e-3)


def test_classes_and_weights_come_from_every_learned_text(docs_of):
    """Also from texts of more than 20,000 characters, and from none that is held out."""
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    rows = [(i, f"the cat sat on the mat and the dog sat too w{i} " * 500) for i in range(20) if not held(i)]
    docs = lm.learned(docs_of(rows))
    model = lm.learn(docs, RANKS)
    assert model["out"].any() and np.isfinite(model["out"]).all()
    ids = np.unique(np.concatenate([lm.word_ids(RANKS).sequence(t.encode().split()) for _, t in rows]))
    assert (model["symbols"][ids] < lm.FREQUENT).all()
    apart = next(i for i in range(5000, 6000) if held(i))
    same = lm.learn(lm.learned(docs_of([*rows, (apart, "zyzzyva quokka " * 3000)])), RANKS)
    assert np.array_equal(same["symbols"], model["symbols"]) and np.array_equal(same["classes"], model["classes"])


def test_a_task_learns_from_each_window_once(monkeypatch):
    seen = []
    monkeypatch.setattr(lm.Trainer, "step", lambda self, ids, scored: seen.append(ids[:, lm.PAST:][scored]))
    rng = np.random.default_rng(5)
    texts = [rng.integers(0, lm.END_ID, n) for n in (1, 40, 33, 500, 16)]
    lm.Trainer(toy_model()).over(texts, rng)
    assert np.array_equal(np.sort(np.concatenate(seen)), np.sort(np.concatenate(texts)))


def test_new_words_of_many_texts_are_encoded_at_once(monkeypatch):
    encoder, calls = lm.word_ids(RANKS), []
    monkeypatch.setattr(lm.WordEncoder, "words", lambda self, words, f=lm.WordEncoder.words: (calls.append(len(words)), f(self, words))[1])
    texts = [f"The cat no{i} sat on mat{i * i}" .encode() for i in range(50)] + [b"", b" \n", "ünï 😀 the".encode()]
    found = lm.Numbered(encoder).sequences(texts)
    assert len(calls) == 1
    assert len(found) == len(texts)
    assert all(np.array_equal(x, encoder.sequence(t.lower().split())) for x, t in zip(found, texts))


def test_chunks_keep_the_ids_of_texts_and_count_words_and_pairs_once(docs_of, monkeypatch):
    """Training reads the ids; nothing is encoded again. Counts travel in buckets, not in a row for each word and pair."""
    monkeypatch.setattr(lm, "CHUNK_WORDS", 40)
    texts = {i: f" The cat no{i % 3} sat\x1con mat \t ünï 😀\x0bthe\n" * (i % 4) for i in range(30)}
    docs = lm.learned(docs_of([*texts.items(), (30, None)]))
    learn = {r.doc_id: r.learn for r in docs.collect()}
    rows, encoder = lm._chunks(docs, RANKS).collect(), lm.word_ids(RANKS)
    sequences = {i: encoder.sequence((texts.get(i) or "").encode().lower().split()) for i in learn}
    found = {r.doc_id: np.frombuffer(r.ids, "<u2") for r in rows if r.kind == 1}
    assert found.keys() == learn.keys() and all(np.array_equal(found[i], sequences[i]) for i in found)
    assert len({r.chunk for r in rows}) > 1

    words, pairs = Counter(), Counter()
    for r in rows:
        if r.kind == 0:
            cuts = np.cumsum(np.frombuffer(r.sizes, "<u4"))[:-1]
            for ids, n in zip(np.split(np.frombuffer(r.ids, "<u2"), cuts), np.frombuffer(r.n, "<i8")):
                words[tuple(ids.tolist())] += int(n)
        elif r.kind == 2:
            for pair, n in zip(np.frombuffer(r.pairs, "<i8").tolist(), np.frombuffer(r.n, "<i8").tolist()):
                pairs[pair] += n
    spell = lambda w: tuple(encoder.sequence([w])[:-1].tolist())
    used = [i for i in learn if learn[i]]
    assert +words == Counter([(lm.END_ID,)] * len(used) + [spell(w) for i in used for w in (texts.get(i) or "").encode().lower().split()])
    assert +pairs == Counter(a << 16 | b for i in used for a, b in zip([lm.END_ID, *sequences[i].tolist()], sequences[i].tolist()))
    assert any(len(r.n) > 8 for r in lm._chunks(docs_of([(1, " ".join(map(str, range(3000))))]).selectExpr("*", "true AS learn"), RANKS).collect() if r.kind == 0)


def test_scores_that_look_up_pairs_by_word_are_those_by_place():
    model, encoder, rng = toy_model(), lm.word_ids(RANKS), np.random.default_rng(6)
    model["follow"] = rng.integers(0, 90, (lm.IDS, lm.CLASSES)).astype(np.float32)
    model["symbols"] = np.minimum(np.arange(lm.IDS), lm.FREQUENT)
    texts = [b"the unforgettable cat sat on the mat", b"", b"zyzzyva quokka zyzzyva the", b"x" * 50]
    numbered = lm.Numbered(encoder)
    sequences = numbered.sequences(texts)
    number = {w: i for i, w in enumerate([lm.END_WORD, *dict.fromkeys(w for t in texts for w in t.split())])}
    numbers = [np.array([*(number[w] for w in t.split()), 0]) for t in texts]
    keys = np.unique(np.concatenate([lm.pair_keys(np.append(lm.END_ID, s[:-1]).astype(np.int64), s) for s in sequences]))
    n, c = rng.integers(0, 20, len(keys)), rng.integers(0, 5, len(number))
    mixed, back = rng.permutation(len(number)), rng.permutation(len(keys))         # buckets come in any order
    flat, sizes = numbered.ids(mixed)
    found = lm.Known(model, 100, mixed, flat, sizes, c[mixed], keys[back], n[back]).scores(numbers)
    for text, own, score in zip(sequences, numbers, found):
        ids, scored, _ = lm.windows([text])
        places = lm.log_likelihood(model, ids, (keys, n))[scored].astype(float)
        by_word = np.add.reduceat(places, np.cumsum(numbered.sizes[own]) - numbered.sizes[own])
        share = np.where((c[own] > 0) & (own > 0), np.log(np.maximum(c[own], 1) / 100), lm.NEVER)
        assert score == pytest.approx(np.logaddexp(by_word, share).sum() / math.log(10) + len(own) * math.log10(0.5), rel=1e-5)


def test_slopes_of_rows_are_sums_over_all_their_places():
    rng = np.random.default_rng(7)
    rows, change = rng.integers(0, 9, (5, 31)), rng.normal(0, 1, (lm.DIM, 5, 31)).astype(np.float32)
    to, sums = np.full((12, lm.DIM), 7, np.float32), np.zeros((12, lm.DIM))
    lm._row_sums(rows, change, to)
    np.add.at(sums, rows.ravel(), change.reshape(lm.DIM, -1).T)
    assert to == pytest.approx(sums, abs=1e-4)
