import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from riskstream.llm.packing import SumOfSquares, packed_documents
from riskstream.llm.queries import RANKS, op5_best_fit_packing
from riskstream.llm.subwords import Encoder

SF = "/root/testdata/sf0.001"
REFERENCE = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
ENCODER = Encoder(RANKS)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet=" \n\t\x1c  a'sZ1.é<|endoftext|>", max_size=60))
def test_ids_are_those_of_the_tokenizer(text):
    assert ENCODER.text_ids(text).tolist() == REFERENCE.encode(text, add_special_tokens=False).ids


def test_special_string():
    text = "a <|endoftext|> b"
    assert ENCODER.text_ids(text).tolist() == REFERENCE.encode(text, add_special_tokens=False).ids


def test_places_where_the_sum_of_squares_is_smallest():
    rng = np.random.default_rng(0)
    bins, gaps = SumOfSquares(20), {}
    for size in rng.integers(1, 20, 300).tolist():
        counts = np.bincount(list(gaps.values()), minlength=21)[:21] if gaps else np.zeros(21, int)

        def after(gap):
            changed = counts.copy()
            if gap < 20:
                changed[gap] -= 1
            changed[gap - size] += gap > size
            return int((changed[1:20].astype(int) ** 2).sum())

        choices = [g for g in range(size, 20) if counts[g]] + [20]
        which, offset = bins.place(size)
        gap = gaps.get(which, 20)
        assert offset == 20 - gap and after(gap) == min(map(after, choices))
        gaps[which] = gap - size


def check(rows, texts, capacity=1024):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(texts)
    for doc, pieces in by_doc.items():
        ids = np.array(REFERENCE.encode(texts[doc] or "", add_special_tokens=False).ids + [2], "<u4")
        pieces.sort(key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(len(pieces))) and sum(r.length for r in pieces) == len(ids)
        assert all(r.length == capacity for r in pieces[1:]) and 1 <= pieces[0].length <= capacity
        for r in pieces:
            assert zlib.crc32(ids[r.start:r.start + r.length].tobytes()) == r.ids_crc32
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op5_best_fit_packing(spark, SF).collect()
    used = check(rows, texts)
    assert used <= 1.06 * sum(r.length for r in rows) / 1024 + 1


def test_odd_rows(odd_docs, docs_of):
    rows = packed_documents(odd_docs.where("doc_id <> 3 AND doc_id IS NOT NULL"), RANKS).collect()
    check(rows, {1: None, 2: "", 4: "  \n\t ", 5: "word " * 30_000, 6: "x" * 200_000, 7: "ünïcödé 😀 text, with marks."})
    assert packed_documents(odd_docs, RANKS).where("doc_id = 3 OR doc_id IS NULL").count() == 3
    assert packed_documents(docs_of([]), RANKS).count() == 0
