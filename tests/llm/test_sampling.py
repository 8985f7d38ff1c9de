import hashlib
from collections import Counter

import numpy as np
import xxhash

from riskstream.llm import sampling
from riskstream.llm.queries import op8_weighted_sampling
from riskstream.llm.sampling import Sampler, compared_with_next, fingerprinted

SF = "/root/testdata/sf0.001"


def edits(rows):
    """doc_id: (n_chars, edited text, next text), by descending doc_id."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0]), reverse=True)
    texts = [t or "" for _, t in rows]
    return {i: (len(t), t[:len(t) - len(t) // 2] + after[:len(t) // 2], after)
            for (i, _), t, after in zip(rows, texts, texts[1:] + texts[:1])}


def jaccard(a, b):
    a, b = Counter(a.encode().lower().split()), Counter(b.encode().lower().split())
    both = a.keys() | b.keys()
    return sum(min(a[w], b[w]) for w in both) / sum(max(a[w], b[w]) for w in both) if both else 1.0


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    expected, texts, errors = edits(rows), dict(rows), []
    found = op8_weighted_sampling(spark, SF).collect()
    assert sorted(r.doc_id for r in found) == sorted(texts)
    for r in found:
        n, edited, after = expected[r.doc_id]
        assert r.n_chars == n and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        errors += [r.near_edited - jaccard(texts[r.doc_id] or "", edited), r.near_next - jaccard(texts[r.doc_id] or "", after)]
    assert abs(np.mean(errors)) < 0.02 and np.sqrt(np.mean(np.square(errors))) < 0.08
    prints = {r.doc_id: r.fingerprint for r in found}
    for a in texts:
        for b in texts:
            if texts[a] == texts[b]:
                assert prints[a] == prints[b]


def test_collisions_estimate_generalised_jaccard():
    sampler = Sampler(4096)
    a, b = "x x x x y y z w", "x x y y y y z v v"
    found = sampler.signatures([a, b, a, ""])
    assert abs((found[0] == found[1]).mean() - jaccard(a, b)) < 0.03
    assert (found[0] == found[2]).all() and not found[3].any()


def test_terms_in_blocks_give_the_same(monkeypatch):
    text = " ".join(f"w{i % 700}" for i in range(1500))
    whole = Sampler().signatures([text])
    sampler = Sampler()
    sampler.signatures(["other words first"])
    sampler._learn([Counter(text.encode().split())])
    monkeypatch.setattr(sampling, "MOST_TERMS", 50)
    count = Counter(text.encode().split())
    places = np.array([sampler.places[w] for w in count])
    assert (sampler._sample(places, np.array(list(count.values()), np.float32)) == whole[0]).all()


def test_odd_rows(odd_docs, docs_of):
    found = compared_with_next(odd_docs).collect()
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    expected = edits(rows)
    assert sorted((repr(r.doc_id), r.n_chars) for r in found) == sorted((repr(i), len(t or "")) for i, t in rows)
    for r in found:
        if r.doc_id not in (3,):
            assert r.edited_sha256 == hashlib.sha256(expected[r.doc_id][1].encode()).hexdigest()
    assert fingerprinted(odd_docs).count() == len(rows)
    assert compared_with_next(docs_of([])).count() == 0
    alone = compared_with_next(docs_of([(9, "a b c d e f")])).collect()
    assert len(alone) == 1 and alone[0].near_next == 1


def plain_signature(text, samples=64):
    """Each word by itself, its numbers by Python's integers."""
    mask = (1 << 64) - 1

    def uniform(x, number):
        out = []
        for sample in range(samples):
            z = (x + (5 * sample + number + 1) * 0x9E3779B97F4A7C15) & mask
            z = (z ^ z >> 30) * 0xBF58476D1CE4E5B9 & mask
            z = (z ^ z >> 27) * 0x94D049BB133111EB & mask
            out.append((z ^ z >> 31) >> 40)
        return (np.array(out, np.float32) + np.float32(0.5)) * np.float32(2.0 ** -24)

    rows = []
    for word, times in Counter(text.encode().lower().split()).items():
        x = xxhash.xxh64_intdigest(word)
        u = [uniform(x, k) for k in range(5)]
        r, log_c = -np.log(u[0] * u[1]), np.log(-np.log(u[2] * u[3]))
        steps = np.floor(np.log(np.full(samples, times, np.float32)) / r + u[4])
        codes = [((x ^ (int(t) * 0x9E3779B97F4A7C15 & mask)) * 0xBF58476D1CE4E5B9 & mask) >> 48 for t in steps]
        rows.append((log_c - r * (steps - u[4]) - r, codes))
    if not rows:
        return [0] * samples
    best = np.argmin([values for values, _ in rows], axis=0)
    return [rows[b][1][i] for i, b in enumerate(best)]


def test_fingerprints_equal_the_plain_sampler(monkeypatch):
    texts = [f"A b b c {'d ' * k} word{k} word{k % 7} B" for k in range(40)] + ["", " \t", "one"]
    texts.append(" ".join(f"t{i % 333}" for i in range(1000)))
    expected = [plain_signature(t) for t in texts]
    assert Sampler().signatures(texts).tolist() == expected
    # Tables that are full again and again, blocks of few words, a text of more words than a block and a table hold.
    for name, most in (("MOST_TERMS", 60), ("MOST_WEIGHED", 5), ("WORDS_AT_ONCE", 100)):
        monkeypatch.setattr(sampling, name, most)
    sampler = Sampler()
    assert sampler.signatures(texts).tolist() == expected
    assert sampler.signatures(texts[::-1]).tolist() == expected[::-1]
