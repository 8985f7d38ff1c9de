from collections import defaultdict

import numpy as np
import pytest
import xxhash

from riskstream.llm.graph import components
from riskstream.llm.queries import op7_simhash
from riskstream.llm.simhash import _forest, fingerprint, near_components, near_edges, one_of_each

SF = "/root/testdata/sf0.001"


def plain_fingerprint(text, width=4):
    words = text.encode().lower().split()
    shingles = [b" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows, most=4):
    """rows: (doc_id, fingerprint)"""
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(rows):
        for j in range(i):
            if (a ^ rows[j][1]).bit_count() <= most:
                parent[find(i)] = find(j)
    groups = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        groups[find(i)].append(doc)
    return {doc: min(g) for g in groups.values() for doc in g}


def test_fingerprint_is_the_plain_one():
    for text in ("", "a", "A b", "A b c d", "the Quick brown fox Jumps over the lazy dog", "ä ö ü ß x y z " * 50):
        assert fingerprint(text.encode()) & (2 ** 64 - 1) == plain_fingerprint(text)


def test_query_equals_brute_force(spark):
    rows = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    expected = brute_components([(i, plain_fingerprint(t)) for i, t in rows.items()])
    found = op7_simhash(spark, SF).collect()
    assert {r.doc_id: r.component_id for r in found} == expected
    assert all(int(r.fingerprint, 16) == plain_fingerprint(rows[r.doc_id]) and len(r.fingerprint) == 16 for r in found)


@pytest.mark.parametrize("bucket", [20_000, 7])
def test_links_at_exactly_four_bits_survive_and_chains_join(spark, bucket):
    rng = np.random.default_rng(3)
    values = [int(x) for x in rng.integers(0, 2 ** 63, 60, dtype=np.uint64)]
    for v in values[:40]:
        for bits in (4, 4, 5, 1):
            values.append(v ^ sum(1 << int(b) for b in rng.choice(64, bits, replace=False)))
    values = list(dict.fromkeys(values))
    signed = [v - 2 ** 64 if v >= 2 ** 63 else v for v in values]
    edges = near_edges(spark.createDataFrame([(v,) for v in signed], "fp long"), 4, bucket)
    roots = {r.node: r.root for r in components(edges).collect()}
    expected = brute_components(list(zip(signed, values)))
    groups, found = defaultdict(set), defaultdict(set)
    for v in signed:
        groups[expected[v]].add(v)
        found[roots.get(v, v)].add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, found.values()))


def test_dense_bucket_gives_a_forest_not_all_pairs():
    fps = np.arange(16, dtype=np.uint64)
    edges = _forest(fps, 4, 4)
    assert len(edges) == 15


def test_odd_rows(odd_docs, docs_of):
    found = near_components(odd_docs).collect()
    assert len(found) == odd_docs.count()
    empty = {r.component_id for r in found if r.fp == 0}
    assert empty == {1}                                  # null, empty and blank texts are linked
    kept = one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id for r in kept.where("doc_id IS NOT NULL").collect()) == [1, 3, 5, 6, 7]
    assert kept.where("doc_id IS NULL").count() == 1
    assert near_components(docs_of([])).count() == 0
    assert one_of_each(docs_of([])).count() == 0


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + k) for k in range(1, 200)]
    roots = {r.node: r.root for r in components(spark.createDataFrame(path + star, "a long, b long")).collect()}
    assert set(roots) == set(range(61)) | set(range(1000, 1200))
    assert all(root == (0 if node < 1000 else 1000) for node, root in roots.items())
