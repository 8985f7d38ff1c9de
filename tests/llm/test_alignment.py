import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from riskstream.llm import alignment
from riskstream.llm.alignment import (
    Aligner, aligned, alignment_report, grouped, merged_postings, packed_postings, pair_counts, partial_postings, unpacked)
from riskstream.llm.queries import PIECES, RANKS, op12_tokenizer_alignment

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def byte_signs():
    """The sign that the vocabulary's file writes for each byte."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in visible]
    return {**{chr(byte): byte for byte in visible}, **{chr(256 + n): byte for n, byte in enumerate(others)}}


class Plain:
    """Whole texts through both tokenizers, cut where offsets meet."""

    def __init__(self):
        self.a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=PIECES)
        self.signs = byte_signs()

    def groups(self, text):
        """(n_a, n_b, groups)"""
        if not text:
            return 0, 0, []
        whole = (" " + text).encode()
        found = self.a.encode(" " + text, add_special_tokens=False)
        a = [(i, bytes(self.signs[c] for c in token)) for i, token in zip(found.ids, found.tokens)]
        b = [(i, bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("\u2581", " ").encode())
             for i in self.b.encode(text)]
        if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
            return 0, 0, []
        ends_a, ends_b = (np.cumsum([len(x) for _, x in side]).tolist() for side in (a, b))
        groups, i, j = [], 0, 0
        for cut in sorted({*ends_a} & {*ends_b}):
            i2, j2 = ends_a.index(cut) + 1, ends_b.index(cut) + 1
            groups.append(([x for x, _ in a[i:i2]], [x for x, _ in b[j:j2]]))
            i, j = i2, j2
        return len(a), len(b), groups

    def report(self, rows):
        found = [self.groups(text) for _, text in rows]
        linked = [[(a, b) for x, y in groups for a in x for b in y] for _, _, groups in found]
        counts, best = Counter(p for links in linked for p in set(links)), defaultdict(int)
        for (a, _), n in counts.items():
            best[a] = max(best[a], n)
        out = []
        for (doc_id, _), (n_a, n_b, groups), links in zip(rows, found, linked):
            text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
            out.append((doc_id, n_a, n_b, len(groups), len(links), sum(counts[p] == best[p[0]] for p in links),
                        sum(counts[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if n_a else ""))
        return sorted(out, key=repr)


@pytest.fixture(scope="module")
def plain():
    return Plain()


def found(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()), key=repr)


def test_query_equals_brute_force(spark, plain):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert found(op12_tokenizer_alignment(spark, SF)) == plain.report(rows)


ODD_TEXTS = ["a  b", " a", "a ", "\n\nx", "é😀", "<s> x </s> <unk>", "\u2581x y", "a \u2581b", "a\x00b", "x\u3000y z", "<|endoftext|> in <|endoftext|>",
             "don't we'll I'm", "tab\tand\x1cfs \x1f us", "\u200b \u200b", " ", "\n", "e\u0301 e \u0301e", "1 234 567,89", "<0x41> A", "\u2028 \u2029x",
             "ａｂｃ ﬁ ½", "\U0001f468\u200d\U0001f469 ok", "x" * 5000, "x " * 5000, "\u0085 a\u0085b \u00a0c"]


def test_odd_texts_equal_brute_force(docs_of, plain):
    rows = list(enumerate(ODD_TEXTS + ODD_TEXTS[:3]))
    assert found(alignment_report(docs_of(rows), RANKS, PIECES)) == plain.report(rows)


def test_random_texts_equal_whole_tokenisation(plain):
    draw, aligner = random.Random(5), Aligner(RANKS, PIECES)
    signs = [" ", " ", " ", "\n", "\t", "a", "The", "é", "ing", "'s", "1", "23", ".", ",", "😀", "\u00a0", "\u3000", "ß", "漢字", "\x1d", "\r", "<s>"]
    for _ in range(1500):
        text = "".join(draw.choices(signs, k=draw.randint(1, 25)))
        n_a, n_b, groups = plain.groups(text)
        row = alignment._row(aligner, text)
        assert row[:4] == (n_a, n_b, len(groups), sum(len(x) * len(y) for x, y in groups)), repr(text)
        written = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        assert row[4] == (hashlib.sha256(written.encode()).hexdigest() if n_a else "")


def test_both_files_of_the_first_vocabulary_give_the_same_ids(plain):
    aligner = Aligner(RANKS, PIECES)
    for start in range(0, 0x3100, 64):
        text = "".join(f" a{c}b {c} {c}1{c}'s\n{c} " for c in map(chr, range(start, start + 64)))
        assert plain.a.encode(text, add_special_tokens=False).ids == aligner.a.encode_ordinary(text), hex(start)


def test_groups():
    ends = np.array([2, 3, 4]), np.array([1, 3, 4])
    assert [x.tolist() for x in grouped(*ends)] == [[0, 0, 1], [0, 0, 1]]


def test_large_groups_link_the_same(monkeypatch):
    found = alignment.Groups(np.array([1, 2, 1, 5]), np.array([7, 7, 8, 7]), np.array([0, 0, 0, 1]), np.array([0, 0, 0, 1]))
    expected = [(1 << 32 | 7, 4), (1 << 32 | 8, 2), (2 << 32 | 7, 2), (2 << 32 | 8, 1), (5 << 32 | 7, 1)]
    assert list(zip(*(x.tolist() for x in found.links()))) == expected
    monkeypatch.setattr(alignment, "MOST_IN_GROUP", 2)
    assert list(zip(*(x.tolist() for x in found.links()))) == expected


def test_postings_pack_and_unpack():
    draw = np.random.default_rng(2)
    sets = {(7, 0, 0): range(4096), (7, 0, 2): [5], (7, 3, 0): sorted(draw.choice(4096, 255, False).tolist()),
            (9, 1, 0): sorted(draw.choice(4096, 256, False).tolist()), (9, 1, 1): [0, 4095]}
    flat = [np.array(x) for x in zip(*[(*key, low) for key, lows in sets.items() for low in lows])]
    batches = list(packed_postings(*flat))
    assert sum(len(b) for b in batches) == len(sets)
    table = pa.Table.from_batches(batches)
    keys = list(zip(*(table.column(c).to_pylist() for c in ("pair", "block", "plane"))))
    row, low = unpacked(table.column("bits").combine_chunks())
    assert {k: sorted(low[row == i].tolist()) for i, k in enumerate(keys)} == {k: list(v) for k, v in sets.items()}
    assert max(len(b) for b in table.column("bits").to_pylist()) == 512
    assert not list(packed_postings(*(np.zeros(0, np.int64) for _ in range(4))))


def test_parts_of_a_block_are_merged(spark, plain, docs_of, monkeypatch):
    rows = [(i, t) for i, t in enumerate(["so so so it is", "it is so", "is it", "so so"] * 20)]
    expected = plain.report(rows)
    monkeypatch.setattr(alignment, "MOST_LINKS", 5)
    docs = docs_of(rows)
    links = aligned(docs, RANKS, PIECES).cache()
    parts = partial_postings(links).cache()
    merged = merged_postings(parts).cache()
    assert parts.count() > merged.count()
    groups = [plain.groups(t)[2] for _, t in rows]
    per = [Counter((a, b) for x, y in g for a in x for b in y) for g in groups]
    for r in pair_counts(merged).collect():
        assert r.n_docs == sum((r.a, r.b) in p for p in per) and r.n_links == sum(p[r.a, r.b] for p in per)
    again = merged_postings(parts.drop("n").unionByName(parts))     # repeated parts change nothing
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, merged.collect()))
    assert found(alignment_report(docs, RANKS, PIECES)) == expected


def test_a_pair_in_all_documents_over_several_blocks(spark, plain, monkeypatch):
    rows = [(i, "common words" if i % 3 else f"common n{i}") for i in range(900)]
    monkeypatch.setattr(alignment, "BLOCK_BITS", 5)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(alignment_report(docs, RANKS, PIECES)) == plain.report(rows)


def test_odd_rows(odd_docs, docs_of, plain):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert found(alignment_report(odd_docs.selectExpr("*", "'x' AS number", "'y' AS pairs", "1 AS n_a"), RANKS, PIECES)) == plain.report(rows)
    assert alignment_report(docs_of([]), RANKS, PIECES).count() == 0
    assert found(alignment_report(docs_of([(1, None), (None, "")]), RANKS, PIECES)) == plain.report([(1, None), (None, "")])
